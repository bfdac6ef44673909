"""Delimited inputs: stop words, sensor readings, labelled records, movies, surveys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexigear.shared import through_table
from lexigear.sources.quoted import read_quoted

# The columns of the delimited inputs.
MOVIE_SCHEMA = T.StructType(
    [
        T.StructField(name, T.StringType())
        for name in (
            "Release Year", "Title", "Origin/Ethnicity", "Director",
            "Cast", "Genre", "Wiki Page", "Plot",
        )
    ]
)
SURVEY_NUMBERS = ("BMI", "PhysicalHealth", "MentalHealth", "SleepTime")
SURVEY_COLUMNS = (
    "HeartDisease", "BMI", "Smoking", "AlcoholDrinking", "Stroke", "PhysicalHealth",
    "MentalHealth", "DiffWalking", "Sex", "AgeCategory", "Race", "Diabetic",
    "PhysicalActivity", "GenHealth", "SleepTime", "Asthma", "KidneyDisease", "SkinCancer",
)
SURVEY_CATEGORIES = tuple(c for c in SURVEY_COLUMNS if c not in SURVEY_NUMBERS)
SURVEY_SCHEMA = T.StructType(
    [
        T.StructField(c, T.DoubleType() if c in SURVEY_NUMBERS else T.StringType())
        for c in SURVEY_COLUMNS
    ]
)


def read_stopwords(spark: SparkSession, path: str) -> DataFrame:
    """Distinct lines of the file, taken verbatim, as ``term``."""
    return spark.read.text(path).select(F.col("value").alias("term")).distinct()


def sensor_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c.startswith("sensor_")]


def read_sensors(spark: SparkSession, path: str | list[str], schema: T.StructType | None = None) -> DataFrame:
    """Header-less CSV as ``sensor_1..sensor_m`` plus ``source_file``.

    ``path`` is a file, a folder or a glob.  Types are inferred from one extra pass
    over the data unless ``schema`` is given.
    """
    reader = spark.read.option("header", False).option("pathGlobFilter", "*.csv")
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    raw = reader.csv(path)
    names = [f"sensor_{i + 1}" for i in range(len(raw.columns))]
    return with_source_file(raw, [F.col(old).alias(new) for old, new in zip(raw.columns, names)])


def with_source_file(scan: DataFrame, columns: list | None = None) -> DataFrame:
    """Add the originating file of each row of a file scan."""
    kept = columns if columns is not None else ["*"]
    return scan.select(*kept, F.col("_metadata.file_path").alias("source_file"))


def with_point_id(df: DataFrame) -> DataFrame:
    """A unique long per row.  It changes with the partitioning of the input."""
    return df.withColumn("point_id", F.monotonically_increasing_id())


def with_stable_id(df: DataFrame, rows_per_task: int = 1_000_000) -> DataFrame:
    """A unique ``point_id`` string that depends on the rows alone.

    The id is a hash of the row and of its number among equal rows.  Equal rows cannot
    be told apart, so they are counted (combined before the shuffle) and written out
    again from the count.  The writing out is itself cut into chunks and spread, since
    one row may have any number of copies.
    """
    columns = df.columns
    # Read by both branches below: written out, the rows are shuffled once.
    counted = through_table(df.groupBy(*columns).agg(F.count("*").alias("_copies")), "copies")

    def numbered(rows: DataFrame, first, last) -> DataFrame:
        each = rows.select(*columns, F.explode(F.sequence(first, last)).alias("_copy"))
        row_text = F.concat_ws("#", F.to_json(F.struct(*columns)), F.col("_copy").cast("string"))
        return each.select(F.md5(row_text).alias("point_id"), *columns)

    few = counted.where(F.col("_copies") <= rows_per_task)
    last_chunk = F.floor((F.col("_copies") - 1) / rows_per_task).cast("long")
    chunks = (
        counted.where(F.col("_copies") > rows_per_task)
        .withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("long"), last_chunk)))
        .repartition(*columns, "_chunk")
    )
    first = F.col("_chunk") * rows_per_task + 1
    last = F.least(first + rows_per_task - 1, F.col("_copies"))
    return numbered(few, F.lit(1).cast("long"), F.col("_copies")).unionByName(
        numbered(chunks, first, last)
    )


def read_labelled(spark: SparkSession, path: str, width: int) -> DataFrame:
    """Comma-separated records of ``width`` fields: one number, three categories,
    numbers, and the label last.

    A number that is none, or a missing one, is an error that names its field and value;
    so is a record of more or fewer fields.
    """
    names = ["number_0", "protocol", "service", "state", *[f"number_{i}" for i in range(4, width - 1)], "label"]
    fields = spark.read.schema(", ".join(f"{n} string" for n in [*names, "more"])).option("header", False).csv(path)

    def number(name: str) -> Column:
        found = F.expr(f"try_cast({name} AS double)")
        message = F.concat(F.lit(f"no number in {name}: "), F.coalesce(F.col(name), F.lit("nothing")))
        return F.when(found.isNull(), F.raise_error(message).cast("double")).otherwise(found).alias(name)

    whole = F.col("label").isNotNull() & F.col("more").isNull()
    label = F.when(whole, F.col("label")).otherwise(F.raise_error(F.lit(f"a record has not {width} fields")).cast("string"))
    return fields.select(*[number(n) if n.startswith("number_") else F.col(n) for n in names[:-1]], label.alias("label"))


def read_movies(spark: SparkSession, path: str) -> DataFrame:
    """``Title, Genre, Plot`` of a movie CSV whose quoted plots may span lines."""
    return read_quoted(spark, path, MOVIE_SCHEMA).select("Title", "Genre", "Plot")


def read_survey(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SURVEY_SCHEMA).option("header", True).csv(path)
