"""SQL for DuckDB that repeats the registered queries where SQL can express them."""

from __future__ import annotations

DEDUP = """
    SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
           doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
    FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))"""

CHAT = r"""
    WITH turns AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
        UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
    escaped AS (
        SELECT *, length(replace(replace(replace(text, '\', '\\'), '###', '\###'), '</turn>', '\</turn>'))
            + length(replace(replace(replace(replace(role, '\', '\\'), '###', '\###'), '</turn>', '\</turn>'), ':', '\:'))
            + length('### ' || ':' || chr(10) || '</turn>' || chr(10)) AS chars
        FROM turns)
    SELECT conv_id, count(*) AS n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
           coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
           sum(chars)::BIGINT AS formatted_chars
    FROM escaped GROUP BY conv_id"""


LINKS = """
    WITH RECURSIVE vectors AS MATERIALIZED (
        SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
    usable AS MATERIALIZED (
        SELECT vec_id, label, e, sqrt(list_dot_product(e, e)) AS size FROM vectors
        WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(e) > 0 AND len([x FOR x IN e IF x IS NOT NULL AND isfinite(x)]) = len(e)),
    pairs AS MATERIALIZED (
        SELECT a.vec_id AS u, b.vec_id AS v FROM usable a JOIN usable b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
        WHERE a.size > 0 AND b.size > 0 AND list_dot_product(a.e, b.e) / (a.size * b.size) >= 0.93),
    reach AS (
        SELECT vec_id AS node, vec_id AS other FROM vectors
        UNION SELECT r.node, p.v FROM reach r JOIN pairs p ON p.u = r.other)
    SELECT vec_id, (SELECT count(*) FROM pairs p WHERE p.u = vec_id) AS n_links, least AS component_id, vec_id = least AS kept
    FROM vectors JOIN (SELECT node, min(other) AS least FROM reach GROUP BY node) ON node = vec_id"""


def clustering(k: int = 40, rounds: int = 5) -> str:
    """Centroid rounds with one row per component in place of bit planes."""
    parts = ["""
    kept AS MATERIALIZED (
        SELECT row_number() OVER () AS row, vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
        FROM embeddings
        WHERE len(embedding) = 64 AND len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x)]) = 64),
    points AS MATERIALIZED (SELECT row, unnest(range(64)) AS j, unnest(v) AS x FROM kept),
    starts AS (
        SELECT v, row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1 AS c FROM kept
        WHERE vec_id IS NOT NULL QUALIFY c < """ + str(k) + """),
    c0 AS MATERIALIZED (SELECT CAST(c AS INT) AS c, unnest(range(64)) AS j, unnest(v) AS x FROM starts)"""]
    for i in range(rounds + 1):
        parts.append(f"""
    a{i} AS MATERIALIZED (
        SELECT row, arg_min(c, (d, c)) AS c, min(d) AS d
        FROM (SELECT row, c, CAST(sum((p.x - q.x) * (p.x - q.x)) AS BIGINT) AS d FROM points p JOIN c{i} q USING (j) GROUP BY row, c)
        GROUP BY row)""")
        if i < rounds:
            parts.append(f"""
    c{i + 1} AS MATERIALIZED (
        SELECT o.c, o.j, coalesce(m.x, o.x) AS x
        FROM c{i} o LEFT JOIN (
            SELECT a.c, p.j, CAST((sum(p.x) - ((sum(p.x) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS x
            FROM a{i} a JOIN points p USING (row) GROUP BY a.c, p.j) m ON o.c = m.c AND o.j = m.j)""")
    return "WITH" + ",".join(parts) + f"""
    SELECT k.vec_id, a.c AS cluster, a.d AS distance,
           CAST(sum(a.d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia, CAST(sum(a.d) OVER () AS BIGINT) AS inertia,
           s.sha AS centroid_sha256
    FROM a{rounds} a JOIN kept k USING (row)
    JOIN (SELECT c, sha256(string_agg(x, ',' ORDER BY j)) AS sha FROM c{rounds} GROUP BY c) s ON s.c = a.c"""


def _field(value: str) -> str:
    return f"coalesce(CAST(octet_length(encode(CAST({value} AS VARCHAR))) AS VARCHAR) || ':' || CAST({value} AS VARCHAR), '-')"


def _crc32(text: str) -> str:
    """The bits of each byte from the lowest up; the byte enters with its first bit."""
    octets = f"flatten([[ord(c), 0, 0, 0, 0, 0, 0, 0] FOR c IN string_split({text}, '')])"
    step = "xor(xor(s, x) >> 1, CASE WHEN xor(s, x) & 1 = 1 THEN 3988292384 ELSE 0 END)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, CAST({octets} AS BIGINT[])), lambda s, x: {step}), 4294967295)"


def manifest(levels: int = 8, upper: int = 3) -> str:
    """The tree of up to 8**levels rows of a language and 8**upper languages, level by level."""
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    leaf = " || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars", "text"))
    other = " || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars", lower))
    run = "PARTITION BY lang, pos // 8 ORDER BY pos ROWS BETWEEN"
    sides = f"""coalesce(string_agg(d, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
               coalesce(string_agg(d, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r"""
    parts = [f"""
    leaves AS MATERIALIZED (
        SELECT doc_id, lang, sha256({leaf}) AS leaf,
               CASE WHEN {_crc32("CAST(doc_id AS VARCHAR)")} % 3 = 0 THEN sha256({other}) ELSE sha256({leaf}) END AS other,
               row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS pos
        FROM documents),
    n0 AS MATERIALIZED (SELECT lang, pos, leaf AS d, count(*) OVER (PARTITION BY lang) AS n FROM leaves)"""]

    def climb(name: str, count: int) -> None:
        for i in range(count):
            parts.append(f"""
    s{name}{i} AS MATERIALIZED (SELECT lang, pos, n, {sides} FROM {name}{i}),
    {name}{i + 1} AS MATERIALIZED (
        SELECT lang, pos // 8 AS pos, CASE WHEN n > 1 THEN sha256(string_agg(d, '' ORDER BY pos)) ELSE min(d) END AS d, (n + 7) // 8 AS n
        FROM {name}{i} GROUP BY lang, pos // 8, n)""")

    climb("n", levels)
    parts.append(f"""
    u0 AS MATERIALIZED (
        SELECT NULL::VARCHAR AS lang, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, d, count(*) OVER () AS n, lang AS own FROM n{levels})""")
    climb("u", upper)
    parts.append(f"""
    f0 AS (SELECT l.*, u.pos AS number, u.d AS subroot, l.other AS f, '' AS p FROM leaves l JOIN u0 u ON u.own IS NOT DISTINCT FROM l.lang)""")
    now = 0
    for name, count, place, lang in (("n", levels, "pos", "t.lang"), ("u", upper, "number", "NULL")):
        for i in range(count):
            parts.append(f"""
    f{now + 1} AS MATERIALIZED (
        SELECT t.* EXCLUDE (f, p), CASE WHEN s.n > 1 THEN sha256(s.l || t.f || s.r) ELSE t.f END AS f, t.p || s.l || s.r AS p
        FROM f{now} t JOIN s{name}{i} s ON s.lang IS NOT DISTINCT FROM {lang} AND s.pos = t.{place} // {8**i})""")
            now += 1
    return "WITH" + ",".join(parts) + f"""
    SELECT doc_id, leaf, subroot, u.d AS root, sha256(p) AS proof_sha256, f AS folded_root, f = u.d AS verified
    FROM f{now}, u{upper} u"""


ORACLE_SQL: dict[str, str] = {
    "op2_stream_dedup": DEDUP,
    "op7_collision_counts": LINKS,
    "op10_chat_masks": CHAT,
    "op12_bit_planes": clustering(),
    "op13_bitmap_manifest": manifest(),
}
