"""Document quality from weak labels.

Heuristic labellers vote good, bad or nothing on every document.  Spark counts the vote
patterns of the whole corpus (there are at most 3**10, however many documents), and
expectation-maximisation on those counts estimates each labeller's accuracy and every
pattern's posterior.  Junk comes in kinds that trip different labellers (marks between
words, repetition), so the latent class is good or one of these kinds.  The posteriors of a bounded sample train a linear scorer over hashed
byte trigrams and word features; the scorer then judges every document by its whole text.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexigear.llm.common import few, texts

TRAIN_ROWS = 4_000  # documents that the scorer is fitted on, those with the smallest id hashes
BUCKETS = 1 << 15
THRESHOLD = 0.5
BAD, NONE, GOOD = 0, 1, 2
LABELLERS = ("marks", "letters", "endings", "dominance", "capitals", "word length", "repeats", "variety", "lines", "sentences")
#: The labellers that know each kind of junk; class 0 is good.
KINDS = ((0, 1, 2, 3, 4), (6, 7, 8))

# ---------------------------------------------------------------- labellers


def _vote(value: float, good: float, bad: float) -> int:
    """Good up to ``good``, bad from ``bad`` on, no vote between."""
    return GOOD if value <= good else BAD if value >= bad else NONE


@dataclass
class Measures:
    """What labellers and scorer read off a text in one pass."""

    data: np.ndarray
    words: list[bytes]
    counts: np.ndarray = field(init=False)
    repeated: float = field(init=False)
    distinct: float = field(init=False)

    def __post_init__(self) -> None:
        self.counts = np.bincount(self.data, minlength=256)
        n = max(len(self.words), 1)
        self.repeated = sum(map(bytes.__eq__, self.words, self.words[1:])) / n
        self.distinct = len(set(self.words)) / n


def measure(text: bytes) -> Measures:
    return Measures(np.frombuffer(text, dtype=np.uint8), text.split())


SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LETTER = np.zeros(256, dtype=bool)
LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
PLAIN = np.zeros(256, dtype=bool)  # marks of ordinary prose
PLAIN[[ord(c) for c in ".,?;:'\"()-"]] = True
MARK = ~(SPACE | LETTER | PLAIN)
MARK[: ord(" ")] = False
MARK[ord("0") : ord("9") + 1] = False
ENDS = [ord(c) for c in ".?!"]


def votes(text: bytes, m: Measures) -> list[int]:
    """One vote of each labeller."""
    c, n = m.counts, max(len(m.words), 1)
    upper, lower = int(c[65:91].sum()), int(c[97:123].sum())
    lines = [x for x in text.split(b"\n") if x.strip()]
    again = 1 - sum(map(len, set(lines))) / max(sum(map(len, lines)), 1)
    letters, marks, plain = int(c[LETTER].sum()), int(c[MARK].sum()), int(c[PLAIN].sum())
    spaces = int(c[SPACE].sum())
    ink = max(len(text) - spaces, 1)
    gap = SPACE[m.data]
    last = m.data[:-1][gap[1:] & ~gap[:-1]]
    odd = int(MARK[last].sum()) / max(len(last), 1)
    return [
        _vote(marks / n, 0.06, 0.3),
        _vote(-letters / ink, -0.92, -0.88) if ink >= 20 else NONE,
        _vote(odd, 0.06, 0.3) if len(last) >= 5 else NONE,
        _vote(marks / (marks + plain), 0.3, 0.6) if marks + plain >= 3 else NONE,
        _vote(upper / (upper + lower), 0.3, 0.6) if upper + lower >= 20 else NONE,
        _vote(abs(ink / n - 6), 4, 9),
        _vote(m.repeated, 0.04, 0.2),
        _vote(-m.distinct, -0.4, -0.2) if n >= 60 else NONE,
        _vote(again, 0.1, 0.4) if len(lines) >= 4 else NONE,
        (GOOD if int(c[ENDS].sum()) >= n / 60 else BAD) if n >= 120 else NONE,
    ]


def with_votes(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, pattern): the votes as a number in base 3."""

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = 3 ** np.arange(len(LABELLERS))
        for batch in few(batches):
            found = [int(base @ votes(t, measure(t))) for t in (x.encode() for x in texts(batch.column(1)))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.int32())], names=["doc_id", "pattern"])

    return _narrow(docs, id_col, text_col).mapInArrow(label, "doc_id long, pattern int")


def _narrow(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


# ---------------------------------------------------------------- label model


@dataclass
class LabelModel:
    """prior[y] of good and the kinds of junk; table[j, y, v], the chance of labeller j's
    vote v on a document of class y, given that it votes."""

    prior: np.ndarray
    table: np.ndarray

    def classes(self, pattern: np.ndarray) -> np.ndarray:
        """Chance of each class (columns) for each pattern (rows)."""
        given = unpack(pattern)
        logs = np.log(self.table)
        logs[:, :, NONE] = 0  # no vote says nothing about the class
        score = np.log(self.prior)[None, :] + sum(logs[j][:, given[:, j]].T for j in range(given.shape[1]))
        score = np.exp(score - score.max(axis=1, keepdims=True)) if len(score) else score
        return score / score.sum(axis=1, keepdims=True) if len(score) else score

    def posterior(self, pattern: np.ndarray) -> np.ndarray:
        """Chance that a document with these votes is good."""
        return self.classes(pattern)[:, 0]

    def accuracies(self) -> dict[str, tuple[float, float]]:
        """Of each labeller: how often its votes are right on good and on bad documents."""
        bad = self.prior[1:] / self.prior[1:].sum()
        return {name: (float(self.table[j, 0, GOOD]), float(self.table[j, 1:, BAD] @ bad)) for j, name in enumerate(LABELLERS)}


def unpack(pattern: np.ndarray) -> np.ndarray:
    return np.asarray(pattern)[:, None] // 3 ** np.arange(len(LABELLERS)) % 3


def fit_labels(pattern: np.ndarray, count: np.ndarray, steps: int = 300) -> LabelModel:
    """Expectation-maximisation on vote pattern counts.

    It starts from the guess that a document is junk of the kind of which most labellers
    vote bad.  Without documents all votes say nothing and the classes are as likely.
    """
    given, weight = unpack(pattern), np.asarray(count, dtype=float)
    bad = np.stack([(given[:, kind] == BAD).mean(axis=1) for kind in map(list, KINDS)], axis=1)
    share = np.full((len(given), 1 + len(KINDS)), 0.02)
    if len(given):
        share[np.arange(len(given)), np.where(bad.max(axis=1) > 0.3, bad.argmax(axis=1) + 1, 0)] = 1
        share /= share.sum(axis=1, keepdims=True)
    model = LabelModel(np.full(share.shape[1], 1 / share.shape[1]), np.full((len(LABELLERS), share.shape[1], 3), 0.5))
    for _ in range(steps):
        mass = share * weight[:, None]
        prior = (mass.sum(axis=0) + 1) / (mass.sum() + share.shape[1])
        table = model.table.copy()
        for j in range(len(LABELLERS)):
            hits = np.stack([mass[given[:, j] == v].sum(axis=0) + 0.5 for v in (BAD, GOOD)])
            table[j, :, BAD], table[j, :, GOOD] = hits / hits.sum(axis=0)
        done = np.abs(table - model.table).max() < 1e-9
        model = LabelModel(prior, table)
        share = model.classes(pattern)
        if done:
            break
    return model


# ---------------------------------------------------------------- scorer

TRIGRAMS = BUCKETS - 1024  # the last buckets hold word features


def features(text: bytes, m: Measures | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, value) of a text: shares of hashed trigrams, then hashed word features."""
    m = m or measure(text)
    data = m.data.astype(np.uint32)
    if len(data) >= 3:
        hashed = (data[:-2] * np.uint32(0x9E3779B1) ^ data[1:-1] * np.uint32(0x85EBCA77) ^ data[2:] * np.uint32(0xC2B2AE3D)) >> np.uint32(7)
        counts = np.bincount(hashed % np.uint32(TRIGRAMS), minlength=TRIGRAMS)
        bucket = np.flatnonzero(counts)
        value = counts[bucket] / np.sqrt((counts[bucket].astype(float) ** 2).sum())
    else:
        bucket, value = np.zeros(0, dtype=np.int64), np.zeros(0)
    names = [f"repeated {round(m.repeated * 20)}", f"distinct {round(m.distinct * 10)} {min(len(m.words).bit_length(), 10)}"]
    words = np.array([TRIGRAMS + zlib.crc32(x.encode()) % 1024 for x in names])
    return np.concatenate((bucket, words)), np.concatenate((value, [0.5, 0.5]))


@dataclass
class Scorer:
    weights: np.ndarray
    bias: float

    def score(self, text: bytes) -> float:
        bucket, value = features(text)
        return float(1 / (1 + np.exp(-np.clip(self.weights[bucket] @ value + self.bias, -500, 500))))


def fit_scorer(rows: list[tuple[np.ndarray, np.ndarray]], target: np.ndarray, epochs: int = 30, rate: float = 1.0, decay: float = 1e-5) -> Scorer:
    """Logistic regression on soft labels by adaptive gradient steps over shuffled rows."""
    weights, bias = np.zeros(BUCKETS), 2.0
    if not len(rows):
        return Scorer(weights, bias)
    squares, bias_square = np.full(BUCKETS, 1e-3), 1e-3
    random = np.random.default_rng(7)
    # both classes weigh the same, so that rare junk is learnt as well as the rest
    mass = np.array([(1 - target).sum(), target.sum()]) + 1
    weight = (1 - target) / mass[0] + target / mass[1]
    weight *= len(rows) / weight.sum()
    for _ in range(epochs):
        for i in random.permutation(len(rows)):
            bucket, value = rows[i]
            p = 1 / (1 + np.exp(-np.clip(weights[bucket] @ value + bias, -30, 30)))
            slope = weight[i] * (p - target[i])
            step = slope * value + decay * weights[bucket]
            squares[bucket] += step**2
            weights[bucket] -= rate * step / np.sqrt(squares[bucket])
            bias_square += slope**2
            bias -= 0.1 * slope / np.sqrt(bias_square)
    return Scorer(weights, bias)


# ---------------------------------------------------------------- the operator


@dataclass
class QualityModel:
    labels: LabelModel
    scorer: Scorer


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", train_rows: int = TRAIN_ROWS) -> QualityModel:
    """The label model over all documents, and the scorer on at most ``train_rows`` of them.

    The sample takes the documents with the smallest hash of their id and text, so it is the
    same on each run, and as many as there are up to ``train_rows``: without ids, with one id
    for all rows and with repeated rows too.  What comes to the driver is one row per vote pattern and the features
    of the sample.
    """
    counts = with_votes(docs, id_col, text_col).groupBy("pattern").count().toPandas()
    labels = fit_labels(counts["pattern"].to_numpy(), counts["count"].to_numpy())

    def featurize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = 3 ** np.arange(len(LABELLERS))
        for batch in few(batches):
            rows = []
            for t in (x.encode() for x in texts(batch.column(0))):
                m = measure(t)
                bucket, value = features(t, m)
                rows.append({"pattern": int(base @ votes(t, m)), "bucket": bucket.astype(np.int32), "value": value.astype(np.float32)})
            yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    arrow = pa.schema([("pattern", pa.int32()), ("bucket", pa.list_(pa.int32())), ("value", pa.list_(pa.float32()))])
    # the rows up to the hash of the last one wanted; equal rows share a hash, so there may be more
    hashed = _narrow(docs, id_col, text_col).withColumn("order", F.xxhash64("doc_id", "text"))
    last = hashed.select("order").orderBy("order").limit(train_rows).agg(F.max("order")).first()[0]
    near = hashed.where(F.col("order") <= F.lit(last if last is not None else 0))
    sample = near.orderBy("order", "text").limit(train_rows).select("text")
    got = sample.mapInArrow(featurize, "pattern int, bucket array<int>, value array<float>").toPandas()
    rows = [(np.asarray(b), np.asarray(v, dtype=float)) for b, v in zip(got["bucket"], got["value"])]
    target = labels.posterior(got["pattern"].to_numpy(dtype=np.int64)) if rows else np.zeros(0)
    return QualityModel(labels, fit_scorer(rows, target))


def scored(docs: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score, label_posterior): one row per row of ``docs``; null text counts as empty."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = 3 ** np.arange(len(LABELLERS))
        for batch in few(batches):
            score, pattern = [], []
            for t in (x.encode() for x in texts(batch.column(1))):
                score.append(model.scorer.score(t))
                pattern.append(int(base @ votes(t, measure(t))))
            weak = model.labels.posterior(np.array(pattern)) if pattern else []
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score, pa.float64()), pa.array(weak, pa.float64())], names=["doc_id", "score", "label_posterior"])

    return _narrow(docs, id_col, text_col).mapInArrow(judge, "doc_id long, score double, label_posterior double")


def score_column(text: str, model: QualityModel):
    """The scorer as a column over a text column."""

    @F.arrow_udf("double")
    def apply(column: pa.Array) -> pa.Array:
        parts = (column.slice(at, 500) for at in range(0, len(column), 500))
        return pa.array([model.scorer.score(t.encode()) for part in parts for t in texts(part)], pa.float64())

    return apply(F.col(text).cast("string"))


def keep_good(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The documents that a scorer fitted on them takes for good, columns as they are."""
    model = fit(docs, id_col, text_col)
    return docs.where(score_column(text_col, model) >= threshold)
