"""SQL that DuckDB runs on the same tables, one statement per registered query."""

from __future__ import annotations

from lexigear.functions.stopwords import ENGLISH
from lexigear.operators.tokens import NOUN_SUFFIXES

# Parameters shared with the Spark side.
NUM_FREQ, WIDE_FREQ = 60, 1000
QUERY = ("ing", "ble", "ther", "ing", "zzzzz")
TERM, DOC = "ing", 5
K, STEPS = 3, 4
SENSORS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
SHORT_DOC = 1500

STOP = ", ".join(f"'{w}'" for w in ENGLISH)
WORDS = r"regexp_extract_all(lower(text), '[a-z]+|\p{Nd}+')"
DECIMALS = r"regexp_extract_all(lower(text), '[a-z]+|[0-9]+(\.[0-9]*)?', 0)"
LETTERS = r"regexp_extract_all(lower(text), '\p{L}+')"


def kept(tokens: str) -> str:
    return f"list_filter({tokens}, lambda t: length(t) > 2 AND t NOT IN ({STOP}))"


def token_rows(tokens: str, table: str = "documents", key: str = "doc_id") -> str:
    """``key, features``."""
    return f"SELECT {key}, {tokens} AS features FROM {table}"


def token_report(features: str, key: str = "doc_id") -> str:
    return (
        f"SELECT {key}, CAST(len(features) AS BIGINT) AS n_tokens, "
        f"array_to_string(features, ' ') AS tokens FROM ({features})"
    )


REGEX = token_rows(kept(WORDS))
DUMP_URL = "'https://example.org/' || doc_id"


def weights(num_freq: int, features: str = REGEX) -> str:
    """CTEs ``tok, tf, dfs, vocab, a``."""
    return f"""
WITH tok AS MATERIALIZED ({features}),
tf AS MATERIALIZED (
  SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(features) AS term FROM tok) GROUP BY ALL),
dfs AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
vocab AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY df DESC, term) - 1 AS term_id, term, df,
         ln((SELECT count(*) FROM tok) / df) AS idf
  FROM (SELECT * FROM dfs ORDER BY df DESC, term LIMIT {num_freq})),
a AS MATERIALIZED (
  SELECT tf.doc_id, term_id, term, idf * tf.tf / len(tok.features) AS w
  FROM tf JOIN vocab USING (term) JOIN tok USING (doc_id))
"""


DOC_NORM = "SELECT doc_id, sqrt(sum(w * w)) AS size FROM a GROUP BY doc_id HAVING sum(w * w) > 0"
TERM_NORM = "SELECT term_id, sqrt(sum(w * w)) AS size FROM a GROUP BY term_id HAVING sum(w * w) > 0"
QUERY_ROWS = ", ".join(f"('{t}')" for t in QUERY)
QUERY_VECTOR = f"SELECT term_id, sum(idf) AS q FROM (VALUES {QUERY_ROWS}) v(term) JOIN vocab USING (term) GROUP BY term_id"


def best(scores: str, key: str = "doc_id", name: str = "title") -> str:
    label = "'doc ' || doc_id AS title" if key == "doc_id" else name
    return (
        f"SELECT {key}, {label}, round(score, 9) + 0.0 AS score FROM ({scores}) "
        f"ORDER BY round(score, 9) DESC, {key} LIMIT 10"
    )


SEARCH = weights(NUM_FREQ) + best(
    f"SELECT tok.doc_id, coalesce(s, 0) AS score FROM tok LEFT JOIN "
    f"(SELECT doc_id, sum(w * q) AS s FROM a JOIN ({QUERY_VECTOR}) USING (term_id) GROUP BY doc_id) USING (doc_id)"
)
SEARCH_COSINE = weights(NUM_FREQ) + best(
    f"SELECT n.doc_id, coalesce(s, 0) / n.size / (SELECT sqrt(sum(q * q)) FROM ({QUERY_VECTOR})) AS score "
    f"FROM ({DOC_NORM}) n LEFT JOIN "
    f"(SELECT doc_id, sum(w * q) AS s FROM a JOIN ({QUERY_VECTOR}) USING (term_id) GROUP BY doc_id) USING (doc_id)"
)
SIMILAR_DOCS = weights(NUM_FREQ) + best(
    f"SELECT n.doc_id, coalesce(s, 0) / n.size / m.size AS score FROM ({DOC_NORM}) n "
    f"CROSS JOIN (SELECT size FROM ({DOC_NORM}) WHERE doc_id = {DOC}) m LEFT JOIN "
    f"(SELECT a.doc_id, sum(a.w * b.w) AS s FROM a JOIN (SELECT * FROM a WHERE doc_id = {DOC}) b USING (term_id) "
    f"GROUP BY a.doc_id) USING (doc_id)"
)
SIMILAR_TERMS = weights(NUM_FREQ) + best(
    f"SELECT n.term_id, vocab.term, coalesce(s, 0) / n.size / m.size AS score FROM ({TERM_NORM}) n "
    f"JOIN vocab USING (term_id) "
    f"CROSS JOIN (SELECT size FROM ({TERM_NORM}) JOIN vocab USING (term_id) WHERE term = '{TERM}') m LEFT JOIN "
    f"(SELECT a.term_id, sum(a.w * b.w) AS s FROM a JOIN (SELECT * FROM a WHERE term = '{TERM}') b USING (doc_id) "
    f"GROUP BY a.term_id) USING (term_id)",
    "term_id", "term",
)
DOCS_FOR_TERM = weights(NUM_FREQ) + best(
    f"SELECT n.doc_id, coalesce(w, 0) / n.size AS score FROM ({DOC_NORM}) n "
    f"LEFT JOIN (SELECT doc_id, w FROM a WHERE term = '{TERM}') USING (doc_id)"
)
QUERIES = (
    "qv AS MATERIALIZED (SELECT query_id, term_id, term, sum(idf) AS q FROM ("
    f"SELECT item_id AS query_id, unnest({kept(WORDS)}) AS term FROM benchmark) JOIN vocab USING (term) GROUP BY ALL)"
)


def batch(cosine: bool) -> str:
    docs = DOC_NORM if cosine else "SELECT doc_id, 1.0 AS size FROM tok"
    size = "sqrt(sum(q * q))" if cosine else "1.0"
    where = "WHERE qsize > 0" if cosine else ""
    return weights(NUM_FREQ) + f""", {QUERIES},
qn AS (SELECT query_id, {size} AS qsize FROM qv GROUP BY query_id),
dot AS MATERIALIZED (SELECT query_id, doc_id, sum(w * q) AS s FROM a JOIN qv USING (term_id) GROUP BY ALL),
scores AS (
  SELECT query_id, d.doc_id, round(coalesce(s, 0) / d.size / qsize, 9) + 0.0 AS score
  FROM qn CROSS JOIN ({docs}) d LEFT JOIN dot USING (query_id, doc_id) {where})
SELECT query_id, CAST(rank AS BIGINT) AS rank, doc_id, 'doc ' || doc_id AS title, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM scores)
WHERE rank <= 10"""


def lemma_tokens(table: str, key: str) -> str:
    """CTEs up to ``lem(key, features)``: lemmas in token order, filtered."""
    rules = " UNION ALL ".join(
        f"SELECT form, left(form, length(form) - {len(old)}) || '{new}' AS candidate FROM forms "
        f"WHERE suffix(form, '{old}')"
        for old, new in NOUN_SUFFIXES
    )
    return f"""
WITH words AS MATERIALIZED (SELECT {key}, {LETTERS} AS ws FROM {table}),
pos AS MATERIALIZED (SELECT {key}, unnest(ws) AS form, generate_subscripts(ws, 1) AS p FROM words),
forms AS MATERIALIZED (SELECT DISTINCT form FROM pos),
options AS (SELECT form, form AS candidate FROM forms UNION ALL {rules}),
best AS (SELECT form, candidate AS lemma FROM (
  SELECT o.form, o.candidate, row_number() OVER (PARTITION BY o.form ORDER BY length(o.candidate), o.candidate) AS r
  FROM options o WHERE o.candidate IN (SELECT form FROM forms)) WHERE r = 1),
good AS (SELECT {key}, p, lemma FROM pos JOIN best USING (form)
  WHERE length(lemma) > 2 AND lemma NOT IN ({STOP})),
lem AS MATERIALIZED (SELECT words.{key}, coalesce(features, []) AS features FROM words LEFT JOIN
  (SELECT {key}, list(lemma ORDER BY p) AS features FROM good GROUP BY {key}) USING ({key}))
"""


EMBEDDED = "SELECT vec_id AS id, label, CAST(embedding AS DOUBLE[]) AS f FROM embeddings"
MOMENTS = ", ".join(f"avg({c}) AS m{i}, stddev_samp({c}) AS s{i}, stddev_pop({c}) AS q{i}" for i, c in enumerate(SENSORS))
SCALED = ", ".join(f"({c} - m{i}) / s{i}" for i, c in enumerate(SENSORS))
READINGS = (
    f"SELECT row_number() OVER () AS id, l_orderkey, l_linenumber, l_partkey, l_returnflag AS label, [{SCALED}] AS f "
    f"FROM lineitem, (SELECT {MOMENTS} FROM lineitem)"
)
FIRST_IDS = "SELECT row_number() OVER (ORDER BY id) - 1 AS cluster, f AS c FROM (SELECT * FROM {p} ORDER BY id LIMIT {k})"
BY_LABEL = """SELECT dense_rank() OVER (ORDER BY label) - 1 AS cluster, list(m ORDER BY d) AS c FROM (
  SELECT label, d, avg(v) AS m FROM (
    SELECT label, unnest(f) AS v, generate_subscripts(f, 1) AS d FROM {p}) GROUP BY label, d) GROUP BY label"""


def lloyd(k: int = K, steps: int = STEPS, points: str = EMBEDDED, start: str = FIRST_IDS, name: str = "s") -> str:
    """CTEs up to ``{name}(id, prediction, distance)`` and centers ``{name}c{steps}``."""
    p = f"{name}p"
    parts = [f"{p} AS MATERIALIZED ({points})", f"{name}c0 AS MATERIALIZED ({start.format(p=p, k=k)})"]
    for i in range(steps + 1):
        out = name if i == steps else f"{name}a{i}"
        parts.append(
            f"{out} AS MATERIALIZED (SELECT {p}.*, n.prediction, n.distance FROM {p} JOIN ("
            f"SELECT id, arg_min(cluster, dist) AS prediction, min(dist) AS distance FROM ("
            f"SELECT id, cluster, list_distance(f, c) AS dist FROM {p} CROSS JOIN {name}c{i}) GROUP BY id) n USING (id))"
        )
        if i < steps:
            parts.append(
                f"{name}c{i + 1} AS MATERIALIZED (SELECT cluster, list(m ORDER BY d) AS c FROM ("
                f"SELECT prediction AS cluster, d, avg(v) AS m FROM ("
                f"SELECT prediction, unnest(f) AS v, generate_subscripts(f, 1) AS d FROM {out}) GROUP BY ALL) GROUP BY cluster)"
            )
    return ", ".join(parts)


LLOYD = "WITH " + lloyd()
KS = (2, 3, 4)
LLOYDS = "WITH " + ", ".join(lloyd(k=k, name=f"s{k}_") for k in KS)
ALL_SCORED = " UNION ALL ".join(f"SELECT {k} AS k, * FROM s{k}_" for k in KS)
TOPS = (
    f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY distance DESC, id) AS r FROM ({ALL_SCORED})) WHERE r <= 25"
)
SCORES = f"SELECT k, avg(distance) AS avg_distance FROM ({ALL_SCORED}) GROUP BY k"
DRAW = "CAST(('0x' || substr(md5('{seed}:' || {key}), 1, 8)) AS BIGINT) / 4294967296.0"
ORDER_42 = "md5('42:' || {key})"
JOINED = "SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic FROM labels l JOIN documents d USING (doc_id)"


def class_rows(prediction: str) -> str:
    return f"""SELECT label, support, CASE WHEN predicted > 0 THEN hit / predicted ELSE 0.0 END AS precision,
  CASE WHEN support > 0 THEN hit / support ELSE 0.0 END AS recall FROM (
  SELECT label, sum(actual) AS support, sum(predicted) AS predicted, sum(hit) AS hit FROM (
    SELECT quality AS label, 1 AS actual, 0 AS predicted, CAST(quality = p AS INT) AS hit FROM (SELECT *, {prediction} AS p FROM ({JOINED}))
    UNION ALL SELECT {prediction}, 0, 1, 0 FROM ({JOINED})) GROUP BY label)"""


LONG, CLEAN = f"CAST(n_chars > {SHORT_DOC} AS INT)", "1 - toxic"


def overall(prediction: str) -> str:
    return (
        "SELECT sum(recall * support) / sum(support) AS accuracy, sum(precision * support) / sum(support) AS weighted_precision, "
        f"sum(recall * support) / sum(support) AS weighted_recall FROM ({class_rows(prediction)})"
    )


ROC = f"""WITH c AS (SELECT n_chars AS s, sum(toxic) AS p, sum(1 - toxic) AS n FROM ({JOINED}) GROUP BY n_chars),
t AS (SELECT *, sum(p) OVER w AS tp, sum(n) OVER w AS fp FROM c
  WINDOW w AS (ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
r AS (SELECT *, tp / (tp + fp) AS pr, lag(tp / (tp + fp)) OVER (ORDER BY s DESC) AS before FROM t)
SELECT round(sum(n * (tp - p / 2)) / sum(p) / sum(n), 6) AS area_under_roc,
       round(sum(p * (pr + coalesce(before, pr)) / 2) / sum(p), 6) AS area_under_pr FROM r"""

SURVEY = """SELECT CASE WHEN toxic = 1 THEN 'Yes' ELSE 'No' END AS "HeartDisease", CAST(n_chars * 0.5 AS DOUBLE) AS "BMI",
  CASE WHEN quality = 1 THEN 'Yes' ELSE 'No' END AS "Smoking", lang AS "AgeCategory", source AS "Race",
  CAST(doc_id AS DOUBLE) AS "SleepTime", CASE WHEN n_chars > {limit} THEN 'Good' ELSE 'Poor' END AS "GenHealth"
  FROM ({joined})""".format(limit=SHORT_DOC, joined=JOINED)

MONTH = "strftime(l_shipdate, '%m')"
CATEGORIES = ("l_returnflag", "l_linestatus", MONTH)


def flags(category: str) -> str:
    return f"list_transform((SELECT list(DISTINCT {category} ORDER BY {category}) FROM lineitem), lambda c: CAST(c = l.v{CATEGORIES.index(category)} AS INT))"


ONE_HOT = f"""SELECT l_orderkey, l_linenumber, l_extendedprice, array_to_string(list_concat(
  [CAST(l_quantity AS INT)], {flags(CATEGORIES[0])}, {flags(CATEGORIES[1])}, {flags(CATEGORIES[2])},
  [CAST(round(l_discount * 100) AS INT), CAST(round(l_tax * 100) AS INT)]), ',') AS features
FROM (SELECT *, {', '.join(f'{c} AS v{i}' for i, c in enumerate(CATEGORIES))} FROM lineitem) l"""


SPARSE = f"""WITH r AS (SELECT DISTINCT CAST(l_returnflag AS VARCHAR) AS v FROM lineitem), s AS (SELECT DISTINCT CAST(l_linestatus AS VARCHAR) AS v FROM lineitem),
d AS (SELECT DISTINCT strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS v FROM lineitem),
rn AS (SELECT v, row_number() OVER (ORDER BY v) AS i FROM r), sn AS (SELECT v, row_number() OVER (ORDER BY v) + (SELECT count(*) FROM r) AS i FROM s),
dn AS (SELECT v, row_number() OVER (ORDER BY v) + (SELECT count(*) FROM r) + (SELECT count(*) FROM s) AS i FROM d),
n AS (SELECT 1 + (SELECT count(*) FROM r) + (SELECT count(*) FROM s) + (SELECT count(*) FROM d) AS n)
SELECT l_orderkey, l_linenumber, l_extendedprice, '0:' || CAST(round(l_quantity * 100) AS INT) || ',' || rn.i || ':100,' || sn.i || ':100,' || dn.i || ':100,'
  || n.n || ':' || CAST(round(l_discount * 100) AS INT) || ',' || (n.n + 1) || ':' || CAST(round(l_tax * 100) AS INT) AS entries, CAST(n.n + 2 AS INT) AS size
FROM lineitem JOIN rn ON rn.v = l_returnflag JOIN sn ON sn.v = l_linestatus JOIN dn ON dn.v = strftime(l_shipdate, '%Y-%m-%d %H:%M:%S'), n"""


def oracle_sql() -> dict[str, str]:
    w60, w1000 = weights(NUM_FREQ), weights(WIDE_FREQ)
    sql = {
        "a1_read_dump": f"SELECT CAST(count(*) AS BIGINT) AS blocks, CAST(sum(length('<doc id=\"' || doc_id || '\" url=\"' || {DUMP_URL} || "
        "'\" title=\"doc ' || doc_id || '\">' || text) + 9) AS BIGINT) AS chars FROM documents",
        "a2_sample": f"SELECT doc_id FROM documents WHERE {DRAW.format(seed=0, key='doc_id')} < 0.3",
        "a3_parse_documents": f"SELECT doc_id, {DUMP_URL} AS url, 'doc ' || doc_id AS title, md5(text || chr(10)) AS content_md5 FROM documents",
        "a4_read_stopwords": r"SELECT DISTINCT unnest(regexp_split_to_array(lower(text), '\s')) AS term FROM benchmark",
        "a5_read_sensors": "SELECT l_quantity AS sensor_1, l_extendedprice AS sensor_2, l_discount AS sensor_3, l_tax AS sensor_4 FROM lineitem",
        "a6_source_file": "SELECT l_returnflag AS source, CAST(count(*) AS BIGINT) AS n, round(sum(l_tax), 4) AS sum_tax FROM lineitem GROUP BY 1",
        "a7_point_id": "SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(count(*) AS BIGINT) AS n_ids, CAST(count(*) AS BIGINT) AS n_stable_ids, "
        "round(sum(l_extendedprice), 2) AS price FROM lineitem",
        "a8_read_labelled": f"SELECT l_quantity AS number_0, l_returnflag AS protocol, l_linestatus AS service, {MONTH} AS state, "
        "l_extendedprice AS number_4, l_discount AS number_5, l_tax AS number_6, l_linestatus || l_returnflag AS label FROM lineitem",
        "a9_read_movies": "SELECT 'doc ' || doc_id AS \"Title\", lang || ', ' || source AS \"Genre\", md5(text) AS plot_md5 FROM documents",
        "a10_read_survey": SURVEY,
        "b1_write_outliers": f"{LLOYDS} SELECT CAST(k AS INT) AS k, CAST(id AS BIGINT) AS point_id, CAST(label AS VARCHAR) AS source_file, "
        f"CAST(prediction AS INT) AS prediction, round(distance, 6) AS distance FROM ({TOPS})",
        "b2_write_scores": f"{LLOYDS} SELECT CAST(k AS INT) AS k, round(avg_distance, 6) AS avg_distance FROM ({SCORES})",
        "b3_write_scored_sample": f"{LLOYD} SELECT CAST(id AS BIGINT) AS point_id, CAST(prediction AS INT) AS prediction, round(distance, 6) AS distance "
        f"FROM s ORDER BY {ORDER_42.format(key='id')} LIMIT 5000",
        "b5_saved_model_search": SEARCH,
        "b6_dump_clusters": f"{LLOYD} SELECT CAST(prediction AS INT) AS cluster, CAST(count(*) AS BIGINT) AS n, "
        "CAST(sum(len(f)) AS BIGINT) AS n_values, round(sum(list_sum(f)), 4) AS total FROM s GROUP BY 1",
        "c1_tokens_regex": token_report(REGEX),
        "c2_tokens_exercise": token_report(token_rows(kept(DECIMALS))),
        "c3_tokens_lemma": lemma_tokens("documents", "doc_id") + token_report("SELECT * FROM lem"),
        "c4_tokens_split": token_report(token_rows(r"regexp_split_to_array(lower(text), '[^\p{L}\p{N}_]+')")),
        "c5_filter_terms": r"WITH stop AS (SELECT list(DISTINCT t) AS ws FROM (SELECT unnest(regexp_split_to_array(lower(text), '\s')) AS t FROM benchmark)) "
        + "SELECT conv_id, turn, array_to_string(list_filter(" + LETTERS
        + ", lambda t: length(t) > 3 AND NOT list_contains(ws, t)), ' ') AS tokens FROM conversations, stop",
        "c6_with_features": lemma_tokens("documents", "doc_id")
        + "SELECT 'doc ' || doc_id AS title, lang || ', ' || source AS genre, md5(array_to_string(features, ' ')) AS features_md5 "
        "FROM lem JOIN documents USING (doc_id)",
        "c7_compare_vocabularies": lemma_tokens("documents", "doc_id")
        + f""", l AS (SELECT term, count(*) AS df FROM (SELECT doc_id, unnest(list_distinct(features)) AS term FROM ({REGEX})) GROUP BY term),
r AS (SELECT term, count(*) AS df FROM (SELECT doc_id, unnest(list_distinct(features)) AS term FROM lem) GROUP BY term)
SELECT coalesce(l.term, r.term) AS term, CAST(coalesce(l.df, 0) AS BIGINT) AS left_df, CAST(coalesce(r.df, 0) AS BIGINT) AS right_df,
CASE WHEN r.df IS NULL THEN 'left' WHEN l.df IS NULL THEN 'right' ELSE 'both' END AS found_in
FROM l FULL OUTER JOIN r ON l.term = r.term""",
        "d1_term_freqs": w60 + "SELECT tf.doc_id, term, CAST(tf.tf AS BIGINT) AS tf, CAST(len(features) AS BIGINT) AS doc_len FROM tf JOIN tok USING (doc_id)",
        "d2_doc_length": f"SELECT doc_id, CAST(len(features) AS BIGINT) AS doc_len FROM ({REGEX})",
        "d3_doc_freqs": w60 + "SELECT term, CAST(df AS BIGINT) AS df FROM dfs",
        "d4_vocabulary": w1000 + "SELECT term, CAST(df AS BIGINT) AS df FROM vocab",
        "d5_idf": w1000 + "SELECT term, round(idf, 9) AS idf FROM vocab",
        "d6_term_ids": w1000 + "SELECT CAST(term_id AS BIGINT) AS term_id, term FROM vocab",
        "d7_doc_ids": f"SELECT doc_id, 'doc ' || doc_id AS title FROM ({REGEX})",
        "d8_tfidf": w1000 + "SELECT doc_id, CAST(term_id AS BIGINT) AS term_id, term, round(w, 9) + 0.0 AS weight FROM a",
        "d9_doc_term_matrix": w1000 + "SELECT tok.doc_id, CAST(count(term_id) AS BIGINT) AS stored, round(coalesce(sum(w), 0), 9) + 0.0 AS total "
        "FROM tok LEFT JOIN a USING (doc_id) GROUP BY tok.doc_id",
        "d9_matrix_entries": w1000 + "SELECT doc_id, CAST(term_id AS BIGINT) AS term_id, round(w, 9) + 0.0 AS weight FROM a",
        "d10_corpus_stats": w1000 + """SELECT CAST(count(*) AS BIGINT) AS num_docs, CAST(sum(len(features)) AS BIGINT) AS num_tokens,
CAST(sum(CAST(len(features) = 0 AS INT)) AS BIGINT) AS empty_docs, (SELECT CAST(count(*) AS BIGINT) FROM dfs) AS num_terms,
(SELECT CAST(count(*) AS BIGINT) FROM vocab) AS vocabulary_size, CAST(count(*) AS BIGINT) AS matrix_rows,
(SELECT CAST(count(*) AS BIGINT) FROM vocab) AS matrix_cols FROM tok""",
        "e1_svd_energy": w60 + "SELECT round(sum(w * w), 9) AS energy FROM a",
        "e2_scale_docs": w60 + "SELECT tok.doc_id, round(coalesce(sum(w * w), 0), 9) + 0.0 AS squared FROM tok LEFT JOIN a USING (doc_id) GROUP BY tok.doc_id",
        "e3_scale_terms": w60 + "SELECT CAST(term_id AS BIGINT) AS term_id, term, round(sum(w * w), 9) + 0.0 AS squared FROM a GROUP BY ALL",
        "e4_normalize_rows": w60 + f"SELECT doc_id, CAST(1.0 AS DOUBLE) AS length FROM ({DOC_NORM})",
        "f4_genre_labels": r"""SELECT doc_id, array_to_string(list_filter(regexp_split_to_array(lang || ' / ' || source || ', a,b/c,d', '\s*[,/]\s*'), lambda g: g <> '')[1:5], '|') AS genres FROM documents""",
        "f5_query_terms": token_report(token_rows(kept(WORDS), "benchmark", "item_id"), "item_id"),
        "f6_query_vector": w60 + f", {QUERIES} SELECT query_id, CAST(term_id AS BIGINT) AS term_id, term, round(q, 9) AS weight FROM qv",
        "f7_search": SEARCH,
        "f8_search_cosine": SEARCH_COSINE,
        "f9_similar_docs": SIMILAR_DOCS,
        "f10_similar_terms": SIMILAR_TERMS,
        "f11_docs_for_term": DOCS_FOR_TERM,
        "f12_batch_search": batch(False),
        "f12_batch_search_cosine": batch(True),
        "g1_assemble": "SELECT l_orderkey, l_linenumber, " + ", ".join(f"{c} AS f{i}" for i, c in enumerate(SENSORS)) + " FROM lineitem",
        "g2_standardize": "SELECT l_orderkey, l_linenumber, "
        + ", ".join(f"round(({c} - m{i}) / s{i}, 6) + 0.0 AS f{i}" for i, c in enumerate(SENSORS))
        + f" FROM lineitem, (SELECT {MOMENTS} FROM lineitem)",
        "g3_normalize_pop": "SELECT l_orderkey, l_linenumber, "
        + ", ".join(f"round(({c} - m{i}) / q{i}, 6) + 0.0 AS f{i}" for i, c in enumerate(SENSORS))
        + f" FROM lineitem, (SELECT {MOMENTS} FROM lineitem)",
        "g4_one_hot": ONE_HOT,
        "g5_drop_categoricals": "SELECT l_orderkey, l_linenumber, l_quantity AS f0, l_discount AS f1, l_tax AS f2 FROM lineitem",
        "h3_lloyd": f"{LLOYD} SELECT CAST(id AS BIGINT) AS vec_id, CAST(prediction AS INT) AS prediction, round(distance, 6) AS distance FROM s",
        "h3_lloyd_readings": "WITH " + lloyd(points=READINGS, start=BY_LABEL)
        + " SELECT l_orderkey, l_partkey, l_linenumber, CAST(prediction AS INT) AS prediction, round(distance, 6) AS distance FROM s",
        "h4_centers": f"{LLOYD} SELECT CAST(cluster AS INT) AS cluster, CAST(generate_subscripts(c, 1) - 1 AS INT) AS dim, round(unnest(c), 6) + 0.0 AS value FROM sc{STEPS}",
        "h7_avg_distance": f"{LLOYD} SELECT round(avg(distance), 6) AS avg_distance FROM s",
        "h8_sweep_scores": f"{LLOYDS} SELECT CAST(k AS INT) AS k, round(avg_distance, 6) AS avg_distance FROM ({SCORES})",
        "h9_elbow_deltas": f"""{LLOYDS}, sc AS ({SCORES}), dr AS (SELECT k, avg_distance, lag(avg_distance) OVER (ORDER BY k) - avg_distance AS fall FROM sc)
SELECT CAST(k AS INT) AS k, round(avg_distance, 6) AS avg_distance, round(fall, 6) AS drop, k = (SELECT arg_max(k, fall) FROM dr) AS largest_drop FROM dr""",
        "h10_label_counts": "SELECT label, CAST(count(*) AS BIGINT) AS n FROM embeddings GROUP BY label",
        "h10_event_counts": "SELECT event_type AS label, CAST(count(*) AS BIGINT) AS n FROM events GROUP BY event_type",
        "h11_cluster_label_counts": f"{LLOYD} SELECT CAST(prediction AS INT) AS prediction, label, CAST(count(*) AS BIGINT) AS n FROM s GROUP BY 1, 2",
        "h12_cluster_entropy": f"""{LLOYD}, c AS (SELECT prediction, label, count(*) AS n FROM s GROUP BY ALL),
p AS (SELECT *, n / sum(n) OVER (PARTITION BY prediction) AS p FROM c)
SELECT round(sum(-n * ln(p)) / sum(n), 6) AS entropy FROM p""",
        "h13_top_outliers": f"{LLOYD} SELECT CAST(id AS BIGINT) AS point_id, CAST(prediction AS INT) AS prediction, round(distance, 6) AS distance FROM s ORDER BY s.distance DESC, id LIMIT 25",
        "h14_anomaly_threshold": f"{LLOYD} SELECT round(min(distance), 6) AS threshold FROM (SELECT distance FROM s ORDER BY distance DESC LIMIT 100)",
        "h15_anomalies": f"{LLOYD} SELECT CAST(id AS BIGINT) AS point_id, round(distance, 6) AS distance FROM s WHERE distance > (SELECT min(distance) FROM (SELECT distance FROM s ORDER BY distance DESC LIMIT 100))",
        "h15_anomaly_share": f"""{LLOYD}, t AS (SELECT min(distance) AS threshold FROM (SELECT distance FROM s ORDER BY distance DESC LIMIT 100))
SELECT round(threshold, 6) AS threshold, CAST(count(*) AS BIGINT) AS total, CAST(count(*) FILTER (distance > threshold) AS BIGINT) AS anomalies,
round(CAST(100.0 * count(*) FILTER (distance > threshold) / count(*) AS DOUBLE), 6) AS percent FROM s, t GROUP BY threshold""",
        "h16_fixed_sample": f"SELECT event_id, event_type, value FROM events ORDER BY {ORDER_42.format(key='event_id')}, event_id LIMIT 5000",
        "h18_outlier_sources": f"{LLOYDS} SELECT CAST(k AS INT) AS k, CAST(label AS VARCHAR) AS source_file, CAST(count(*) AS BIGINT) AS n FROM ({TOPS}) GROUP BY k, label",
        "h18_outlier_overlap": f"{LLOYDS}, tops AS MATERIALIZED ({TOPS}) SELECT CAST(x.k AS INT) AS k, CAST(y.k AS INT) AS other_k, CAST(count(*) AS BIGINT) AS shared FROM tops x JOIN tops y ON x.id = y.id AND x.k < y.k GROUP BY x.k, y.k",
        "h21_relative_distance": f"{LLOYD} SELECT CAST(id AS BIGINT) AS point_id, round(distance / sqrt(avg(distance * distance) OVER (PARTITION BY prediction)), 6) AS relative FROM s",
        "j1_clean_labels": f"SELECT doc_id, CASE WHEN toxic = 1 THEN 'Yes' ELSE 'No' END AS answer FROM documents JOIN labels USING (doc_id)",
        "j2_hash_split": f"SELECT doc_id, CASE WHEN {DRAW.format(seed=42, key='doc_id')} < 0.8 THEN 'train' ELSE 'test' END AS part FROM ({JOINED})",
        "j3_index_categories": f"""WITH j AS ({JOINED}),
x AS (SELECT lang, row_number() OVER (ORDER BY count(*) DESC, lang) - 1 AS i FROM j GROUP BY lang),
y AS (SELECT source, row_number() OVER (ORDER BY count(*) DESC, source) - 1 AS i FROM j GROUP BY source)
SELECT doc_id, CAST(x.i AS INT) AS lang_indexed, CAST(y.i AS INT) AS source_indexed FROM j JOIN x USING (lang) JOIN y USING (source)""",
        "j7_binary_metrics": ROC,
        "j8_class_metrics": f"SELECT CAST(label AS INT) AS label, CAST(support AS BIGINT) AS support, round(precision, 6) AS precision, round(recall, 6) AS recall FROM ({class_rows(LONG)})",
        "j11_compare_models": f"""WITH m AS ({overall(LONG)}), n AS ({overall(CLEAN)})
SELECT 'accuracy' AS metric, round(m.accuracy, 6) AS by_length, round(n.accuracy, 6) AS by_toxicity FROM m, n UNION ALL
SELECT 'weighted_precision', round(m.weighted_precision, 6), round(n.weighted_precision, 6) FROM m, n UNION ALL
SELECT 'weighted_recall', round(m.weighted_recall, 6), round(n.weighted_recall, 6) FROM m, n""",
    }
    sql["g4_one_hot_sparse"] = SPARSE
    sql["d9_doc_term_matrix_joined"] = sql["d9_doc_term_matrix"]
    sql["a3_read_documents"] = sql["a3_parse_documents"]
    sql["a4_stopword_join"] = sql["c5_filter_terms"]
    sql["h5_assign"] = f"{LLOYD} SELECT CAST(id AS BIGINT) AS vec_id, CAST(prediction AS INT) AS prediction FROM s"
    sql["h6_distance_to_centroid"] = f"{LLOYD} SELECT CAST(id AS BIGINT) AS vec_id, round(distance, 6) AS distance FROM s"
    return sql
