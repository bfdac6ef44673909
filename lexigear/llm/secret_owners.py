"""Secret scans judged by who owns a value, over the whole corpus.

Every text is scanned for assignments, access keys and long hex runs (the base kinds, which
always count), and for candidates of wider shapes: private key blocks, web tokens, passwords
in addresses and random-looking runs.  A candidate alone says little, since documentation,
licences and forks carry the same example into many repositories.  So the hashes of all
values, never the values themselves, are counted by distinct repositories and owners.  A
value that many owners hold is a copied example; one that a single owner holds and that looks
random is live, and its wider span is reported beside the base ones.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from math import log2

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexigear.llm.common import few, materialize, small, texts

#: The base kinds in their order, with their patterns and least lengths.
BASE = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
LEAST_ASSIGN = 6
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")  # runs below 20 characters can't match, nor a part of one
HEX = re.compile(r"[0-9a-f]{24,}")  # the same below 24
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

#: Wider kinds, in the order in which they claim characters.
WIDE = ("block", "web", "address", "run")
BLOCK = re.compile(r"-----BEGIN ([A-Z0-9 ]*PRIVATE KEY)-----(?:[^-]+|-(?!----))*+-----END \1-----")
WEB = re.compile(r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}")
ADDRESS = re.compile(r"://[^\s/:@]+:([^\s/@]{6,})@")
RUN = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}")

#: A value looks random with so many bits a character, and none of these words in it.
BITS = 3.0
PLACEHOLDERS = ("example", "sample", "dummy", "changeme", "placeholder", "your", "xxxx", "1234567", "abcdef", "password", "secret", "redacted")

OWNERS = 3  # a value of so many owners is a copied example

Span = tuple[str, int, int]


# ---------------------------------------------------------------- one text


def base_spans(text: str) -> list[tuple[Span, str]]:
    """(span, value) of the base kinds, by start and then kind."""
    found: list[tuple[Span, str]] = []
    low = text.lower()
    if any(k in low for k in KEYWORDS):
        found += [(("assign", *m.span()), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGN]
    if "AKIA" in text:
        found += [(("access", *m.span()), m[0]) for m in ACCESS.finditer(text)]
    found += [(("hex", *m.span()), m[0]) for m in HEX.finditer(text)]
    return sorted(found, key=lambda x: (x[0][1], BASE.index(x[0][0])))


def wide_spans(text: str, taken: list[Span]) -> list[tuple[Span, str]]:
    """(span, value) of the wider kinds that look random and overlap none of ``taken``."""
    found: list[tuple[Span, str]] = []
    if "-----BEGIN " in text:
        found += [(("block", *m.span()), m[0]) for m in BLOCK.finditer(text)]
    if "eyJ" in text:
        found += [(("web", *m.span()), m[0]) for m in WEB.finditer(text)]
    if "://" in text:
        found += [(("address", *m.span(1)), m[1]) for m in ADDRESS.finditer(text)]
    found += [(("run", *m.span()), m[0]) for m in RUN.finditer(text)]
    if not found:
        return []
    claimed, out = bytearray(len(text)), []
    for _, a, b in taken:
        claimed[a:b] = b"\1" * (b - a)
    for (kind, a, b), value in found:
        if random_looking(value) and claimed.find(1, a, b) < 0:
            claimed[a:b] = b"\1" * (b - a)
            out.append(((kind, a, b), value))
    return out


def random_looking(value: str) -> bool:
    """Digits and letters, no placeholder, and the spread of characters of a random string."""
    if not any(c.isdigit() for c in value) or not any(c.isalpha() for c in value):
        return False
    low = value.lower()
    if any(word in low for word in PLACEHOLDERS):
        return False
    return -sum(n / len(value) * log2(n / len(value)) for n in Counter(value).values()) >= BITS


def value_hash(value: str) -> bytes:
    return hashlib.sha256(value.encode()).digest()[:16]


def joined(spans: list[Span]) -> str:
    """``kind:start:end`` by start, then kind, comma-joined."""
    order = {kind: i for i, kind in enumerate((*BASE, *WIDE))}
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (s[1], order[s[0]], s[2])))


# ---------------------------------------------------------------- the corpus

FOUND = "array<struct<kind:string,start:long,end:long,hash:binary,random:boolean>>"
FOUND_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("hash", pa.binary()), ("random", pa.bool_())]))


def scanned(docs: DataFrame, id_col: str, text_col: str, repo: Column, owner: Column) -> DataFrame:
    """(row, doc_id, repo, owner, found): the candidates of every row, by start."""
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), repo.alias("repo"), owner.alias("owner"), F.col(f"`{text_col}`").cast("string").alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in few(batches):
            out = []
            for text in texts(batch.column("text")):
                base = base_spans(text)
                every = base + wide_spans(text, [span for span, _ in base])
                out.append([{"kind": k, "start": a, "end": b, "hash": value_hash(v), "random": random_looking(v)} for (k, a, b), v in sorted(every, key=lambda x: x[0][1])])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("repo"), batch.column("owner"), pa.array(out, FOUND_ARROW)], names=["doc_id", "repo", "owner", "found"])

    found = rows.mapInArrow(work, f"doc_id long, repo string, owner string, found {FOUND}")
    return materialize(found.withColumn("row", F.monotonically_increasing_id()), "scanned")


def ownership(scan: DataFrame, owners: int = OWNERS) -> DataFrame:
    """(hash, n_spans, n_repos, n_owners, verdict): one row per value, written out.

    The verdict is ``example`` with ``owners`` owners or more, ``shared`` with several,
    ``live`` with one if the value looks random, else ``plain``.  A repository counts within
    its owner; rows without a repository, or without an owner, have one unknown one.
    """
    spans = scan.where(F.size("found") > 0).select("repo", "owner", F.explode("found").alias("s"))
    # each step is combined within the tasks first, so a value of any number of copies is a few rows
    repos = spans.groupBy("s.hash", "owner", "repo").agg(F.count("*").alias("n"), F.bool_or("s.random").alias("random"))
    each = repos.groupBy("hash", "owner").agg(F.sum("n").alias("n"), F.count("*").alias("repos"), F.bool_or("random").alias("random"))
    all_ = each.groupBy("hash").agg(F.sum("n").alias("n_spans"), F.sum("repos").alias("n_repos"), F.count("*").alias("n_owners"), F.bool_or("random").alias("random"))
    verdict = F.when(F.col("n_owners") >= owners, "example").when(F.col("n_owners") > 1, "shared").when(F.col("random"), "live").otherwise("plain")
    return materialize(all_.select("hash", "n_spans", "n_repos", "n_owners", verdict.alias("verdict")), "ownership")


def scan_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", repo: Column | str = "source", owner: Column | str | None = None, owners: int = OWNERS) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_spans, spans, n_live, n_shared, n_example), one
    row per row.

    ``base_spans`` and ``spans`` list ``kind:start:end`` in code points.  ``spans`` adds the
    wider candidates of live values; the counts at the end are of all candidates by verdict.
    ``owner`` defaults to the part of the repository before its first slash.

    Null text counts as empty and has no spans.  Rows that repeat an id, or have none, are
    rows of their own; their copies count as one repository.
    """
    repo = F.col(f"`{repo}`") if isinstance(repo, str) else repo
    owner = F.col(f"`{owner}`") if isinstance(owner, str) else owner
    repo = repo.cast("string")
    owner = F.split_part(repo, F.lit("/"), F.lit(1)) if owner is None else owner.cast("string")
    scan = scanned(docs, id_col, text_col, repo, owner)
    known = ownership(scan, owners)
    spans = scan.where(F.size("found") > 0).select("row", F.explode("found").alias("s")).select("row", "s.*")
    # the values' table is written, so the join can split a value of many rows
    judged = spans.join(small(known.select("hash", "verdict")), "hash")
    judged = materialize(judged.select("row", "kind", "start", "end", "verdict"), "judged")
    base = F.col("kind").isin(*BASE)
    extra = F.collect_list(F.when(~base & (F.col("verdict") == "live"), F.struct("kind", "start", "end"))).alias("extra")
    by_row = judged.groupBy("row").agg(extra, *[F.count_if(F.col("verdict") == v).alias(f"n_{v}") for v in ("live", "shared", "example")])
    rows = scan.join(small(materialize(by_row, "by-row")).withColumnRenamed("row", "r"), F.col("row") == F.col("r"), "left")

    def listed(spans: Column) -> Column:
        """By start, then kind as listed, then end."""
        order = F.create_map(*[F.lit(x) for i, k in enumerate((*BASE, *WIDE)) for x in (k, i)])
        keyed = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("a"), order[s["kind"]].alias("o"), s["end"].alias("b"), s["kind"].alias("k"))))
        return F.array_join(F.transform(keyed, lambda s: F.concat_ws(":", s["k"], s["a"].cast("string"), s["b"].cast("string"))), ",")

    plain = F.transform(F.filter("found", lambda s: s["kind"].isin(*BASE)), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    every = F.concat(plain, F.coalesce("extra", F.expr("cast(array() as array<struct<kind:string,start:bigint,end:bigint>>)")))
    counts = [F.size(F.expr(f"filter(found, s -> s.kind = '{k}')")).cast("long").alias(f"n_{k}") for k in BASE]
    verdicts = [F.coalesce(f"n_{v}", F.lit(0)).cast("long").alias(f"n_{v}") for v in ("live", "shared", "example")]
    return rows.select("doc_id", *counts, listed(plain).alias("base_spans"), listed(every).alias("spans"), *verdicts)
