"""Exact dedup, SimHash covering, collision counting and repeat removal against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from lexigear.llm import collision_counts, column_bwt, simhash_cover, stream_dedup
from lexigear.llm.components import connected_components

DOCS = "doc_id long, text string, digest string, gone_id long, row long"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "clash", 1, 2) for i, t in rows], DOCS)


# ---------------------------------------------------------------- components


def test_components_of_paths_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(200, 200), (None, 3), (300, 299), (299, 300)]
    found = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert found == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 160)} | {299: 299, 300: 299}


def test_components_of_nothing(spark):
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


# ---------------------------------------------------------------- exact dedup

EXACT = [(1, "a"), (5, "a"), (3, "a"), (2, ""), (4, None), (6, "b"), (None, "b"), (7, "A"), (8, "x" * 100_000), (9, "x" * 100_000), (9, "x" * 100_000), (None, "n"), (None, "n")]


def expected_members(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    keep = {t: max((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    return Counter((i, keep[t or ""], len(groups[t or ""])) for i, t in rows), keep


@pytest.mark.parametrize("weak", [False, True])
def test_members(spark, weak):
    """Also where the digest clashes: then the bytes decide."""
    digest = (lambda t: F.lit("one")) if weak else stream_dedup.sha256
    expected, keep = expected_members(EXACT)
    rows = stream_dedup.members(docs(spark, EXACT), digest=digest).collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size) for r in rows) == expected
    assert all(r.doc_id == r.keep_id for r in rows if r.kept)
    assert sum(r.kept for r in rows) == len(keep)


def test_later_ingests_meet_earlier_ones(spark, folder):
    """State, winners and locators of an ingest serve the next one, in another object."""
    first, second = docs(spark, [(1, "a"), (2, "b"), (None, "n")]), docs(spark, [(5, "a"), (6, "c"), (7, "a"), (None, "n")])
    stream_dedup.Deduplicator(spark, folder).add(first, 0)
    later = stream_dedup.Deduplicator(spark, folder)
    later.add(second, 1)
    later.add(second, 1)  # as after a failure: nothing is counted twice
    found = Counter((r.doc_id, r.keep_id, r.group_size, r.kept) for r in later.members().collect())
    kept_null = [k for k in found if k[0] is None]
    assert found == Counter([(1, 7, 3, False), (5, 7, 3, False), (7, 7, 3, True), (2, 2, 1, True), (6, 6, 1, True), (None, None, 2, True), (None, None, 2, False)])
    assert len(kept_null) == 2


@pytest.mark.parametrize("plain", [True, False])
def test_clash_across_ingests(spark, folder, plain):
    """A weak digest: a new text meets an old winner's bytes, read where its locator says."""
    weak = lambda t: F.substring(t, 1, 1)
    batches = [[(1, "ax"), (2, "bx"), (9, "cx")], [(3, "ay"), (4, "bx")], [(5, "ax"), (6, "dx")]]
    one = stream_dedup.Deduplicator(spark, folder, digest=weak)
    for i, batch in enumerate(batches):
        frame = docs(spark, batch)
        if plain:  # files that hold the documents as they are
            frame.write.parquet(f"{folder}-in/{i}")
            frame = spark.read.parquet(f"{folder}-in/{i}")
        one.add(frame, i)
    assert one._is_there(f"{folder}/contents/0") is not plain
    found = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in one.members().collect()}
    assert found == {1: (5, 2, False), 5: (5, 2, True), 3: (3, 1, True), 2: (4, 2, False), 4: (4, 2, True), 9: (9, 1, True), 6: (6, 1, True)}
    assert [r.digest for r in spark.read.parquet(f"{folder}/clashes").collect()].count("a") >= 1
    changed = one._findable(docs(spark, batches[0]).withColumn("text", F.upper("text")), 7)
    assert {r.text for r in changed.collect()} == {"AX", "BX", "CX"}


def test_exact_keep_one(spark):
    kept = stream_dedup.keep_one(docs(spark, EXACT))
    assert kept.columns == ["doc_id", "text", "digest", "gone_id", "row"]
    _, keep = expected_members(EXACT)
    assert Counter((r.doc_id, r.text or "") for r in kept.collect()) == Counter((i, t) for t, i in keep.items())


def test_exact_of_nothing(spark):
    assert stream_dedup.members(docs(spark, [])).count() == 0
    assert stream_dedup.keep_one(docs(spark, [])).count() == 0


# ---------------------------------------------------------------- SimHash


def slow_fingerprint(text):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ").split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(len(words) - 2, 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints():
    texts = ["", " \n", "One", "one two", "One Two THREE four", "É a\x0bb\x0cc d e", "x y z " * 500, "a\x1cb c d"]
    assert [simhash_cover.fingerprint(t) for t in texts] == [slow_fingerprint(t) for t in texts]


def test_anchors_cover_every_word():
    words = np.random.default_rng(3).integers(0, 1 << 32, 20_000, dtype=np.uint32)
    found = simhash_cover.anchor(words)
    assert np.bitwise_count(found ^ words).max() <= 4
    assert (simhash_cover.anchor(found) == found).all()


def linked(fps, ids):
    label = dict(zip(range(len(fps)), range(len(fps))))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for a in range(len(fps)):
        for b in range(a):
            if bin(fps[a] ^ fps[b]).count("1") <= 3:
                x, y = sorted((root(a), root(b)), key=lambda r: ids[r])
                label[y] = x
    return [ids[root(i)] for i in range(len(fps))]


@pytest.mark.parametrize("hot", [20_000, 5])
def test_links_are_complete(spark, hot):
    """Random fingerprints with planted neighbours of 1 to 4 bits, and a dense ball."""
    r = random.Random(11)
    fps = [r.getrandbits(64) for _ in range(150)]
    for f in fps[:60]:
        fps.append(f ^ sum(1 << b for b in r.sample(range(64), r.randint(1, 4))))
    fps += [fps[0] ^ 1 << b for b in range(40)]
    fps = list(dict.fromkeys(fps))
    ids = list(range(1000, 1000 + len(fps)))
    r.shuffle(ids)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    classes = spark.createDataFrame(list(zip(signed, ids)), "fp long, rep long")
    found = connected_components(simhash_cover.links(simhash_cover.covered(classes), hot_rows=hot))
    known = {x.node: x.component for x in found.collect()}
    assert [known.get(i, i) for i in ids] == linked(fps, ids)


def test_near_duplicates(spark):
    rows = [(9, "the cat sat on the mat"), (4, "The CAT sat on the mat"), (2, None), (3, ""), (5, "other words altogether here"), (None, "the cat sat on the mat"), (4, "The CAT sat on the mat"), (8, "w " * 50_000)]
    found = simhash_cover.near_duplicates(docs(spark, rows)).collect()
    assert Counter((r.doc_id, r.component_id) for r in found) == Counter([(9, 4), (4, 4), (4, 4), (2, 2), (3, 2), (5, 5), (None, None), (8, 8)])
    kept = simhash_cover.keep_one(docs(spark, rows))
    assert kept.columns == ["doc_id", "text", "digest", "gone_id", "row"]
    assert Counter(r.doc_id for r in kept.collect()) == Counter([4, 4, 2, 5, 8, None])
    assert simhash_cover.near_duplicates(docs(spark, [])).count() == 0


# ---------------------------------------------------------------- vectors


def test_collision_counts(spark):
    r = np.random.default_rng(4)
    rows, size = [], 24
    for label in (0, 1, None):
        for _ in range(60):
            base = r.standard_normal(size)
            rows.append((label, base))
            for noise in (0.05, 0.2, 0.38, 0.42):
                rows.append((label, base + noise * r.standard_normal(size)))
        rows += [(label, rows[-1][1]), (label, 3 * rows[-1][1]), (label, np.zeros(size))]
    vectors = [(i, [float(x) for x in v], label) for i, (label, v) in enumerate(rows)]
    vectors += [(2000, None, 1), (2001, [1.0, None] + [0.0] * (size - 2), 1), (2002, [float("nan")] * size, 1), (2003, [float("inf")] * size, 1), (2004, [], 1), (2005, [1.0, 2.0], 1), (2006, [1.0, 2.0], 1), (None, [1.0, 2.0], 1)]
    frame = spark.createDataFrame([(*v, 7) for v in vectors], "vec_id long, embedding array<double>, label int, cell int")
    x = {i: np.array(v) / np.linalg.norm(v) for i, v, label in vectors if i is not None and label is not None and v and None not in v and np.isfinite(v).all() and any(v)}
    label = {i: la for i, _, la in vectors}
    near = {i: {j for j in x if j != i and label[i] == label[j] and len(x[i]) == len(x[j]) and x[i] @ x[j] >= 0.93} for i in x}
    total = sum(map(len, near.values()))
    assert total > 300
    for most in (4096, 16):
        classes = frame.where(collision_counts.usable(F.col("embedding")) & F.col("label").isNotNull() & F.col("vec_id").isNotNull())
        classes = classes.groupBy(F.col("label").cast("string").alias("label"), F.col("embedding").alias("vector")).agg(F.min("vec_id").alias("rep"), F.count("*").alias("n"))
        got = collision_counts.links(classes, most=most).groupBy("node").agg(F.sum("links").alias("links"))
        found = {r.node: r.links for r in got.collect()}
        assert all(found[i] <= len(near[i]) for i in found)
        assert sum(found.values()) >= 0.97 * total - 8
    result = {r.vec_id: r for r in collision_counts.near_duplicates(frame).collect()}
    assert len(result) == len(vectors)
    assert sum(r.n_links for r in result.values()) >= 0.97 * total
    assert all(result[i].n_links <= len(near.get(i, ())) for i in result)
    for i in (2000, 2001, 2002, 2003, 2004):
        assert (result[i].n_links, result[i].component_id, result[i].kept) == (0, i, True)
    assert (result[2005].n_links, result[2006].component_id, result[2006].kept) == (1, 2005, False)
    assert (result[None].n_links, result[None].component_id, result[None].kept) == (0, None, False)


def test_collision_counts_of_nothing(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert collision_counts.near_duplicates(empty).count() == 0


# ---------------------------------------------------------------- repeats


def brute(texts):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + 200] for d in data for i in range(len(d) - 199))
    out = []
    for d in data:
        mask = np.zeros(len(d), dtype=bool)
        for i in range(len(d) - 199):
            if seen[d[i : i + 200]] > 1:
                mask[i : i + 200] = True
        kept = bytes(b for b, m in zip(d, mask) if not m)
        out.append((len(d), int(mask.sum()), int((np.diff(np.concatenate(([0], mask.astype(int)))) == 1).sum()), kept))
    return out


@pytest.mark.parametrize("hot", [20_000, 20, 3])
def test_repeats(spark, hot):
    """Also where keys of many excerpts are divided once and twice."""
    r = random.Random(5)

    def word(n):
        return "".join(r.choice("abcdefgh ij é") for _ in range(n))

    passage, line, exact = word(260), word(190), word(200)
    texts = [word(500) + passage + word(300), word(100) + passage[:230] + word(400), passage, passage[10:], word(150) + exact + word(10), exact, line + word(300), word(300) + line]
    texts += ["a" * 1000, "ab" * 400, "x" * 199, "", None, word(50) * 30]
    texts += [word(r.randint(0, 60)) + line + r.choice("xyz") + exact[: r.randint(0, 200)] + word(200) for _ in range(40)] + ["same " * 80] * 3
    rows = list(enumerate(texts)) + [(70, "twice " * 60), (70, "twice " * 60), (None, passage)]
    found = column_bwt.remove_repeats(docs(spark, rows), hot_rows=hot).collect()
    expected = Counter((i, *e) for (i, _), e in zip(rows, brute([t for _, t in rows])))
    assert Counter((f.doc_id, f.n_bytes, f.n_removed, f.n_spans, bytes(f.kept)) for f in found) == expected


def test_repeats_in_texts_longer_than_a_block():
    r = np.random.default_rng(8)
    data = r.integers(97, 123, 2_500_000, dtype=np.uint8)
    data[2_300_000:2_300_400] = data[100:500]
    seen, runs = {}, []
    for doc, h, place, first, last in column_bwt.excerpts([data.tobytes()]):
        for x, p, a, b in zip(h.tolist(), place.tolist(), first.tolist(), last.tolist()):
            assert a <= p <= a + 136 and b <= p <= b + 136
            runs.append((a, b))
            seen.setdefault(x, []).append((p, a, b))
    runs.sort()
    assert runs[0][0] == 0 and runs[-1][1] == len(data) - 200
    assert all(b + 1 == c or b >= c - 1 for (_, b), (c, _) in zip(runs, runs[1:]))
    assert any(len(v) > 1 for v in seen.values())


def test_repeats_of_nothing(spark):
    assert column_bwt.remove_repeats(docs(spark, [])).count() == 0
    one = column_bwt.remove_repeats(docs(spark, [(1, None)])).first()
    assert (one.n_bytes, one.n_removed, hashlib.sha256(bytes(one.kept)).hexdigest()) == (0, 0, hashlib.sha256(b"").hexdigest())
