"""One registered query per operator, and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brimline.llm import collocations, differencing, id_store, line_rules, mixing, negatives, packing, pseudonyms, quality_model, secret_scan, sharding, simhash, topk
from brimline.llm.common import prepared, settled, table
from brimline.llm.tokens import VOCABULARY
from brimline.session import scratch_path

QUERIES = {}
ORACLE = {}


def query(fn):
    QUERIES[fn.__name__] = lambda spark, sf_dir: fn(prepared(spark), sf_dir)
    return fn


@query
def op10_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    out = line_rules.with_verdict(docs, "v")
    figures = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "left_words", "kept"]
    return out.select("doc_id", *[F.col("v")[c].alias(c) for c in figures])


_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

ORACLE["op10_line_rules"] = rf"""
WITH d AS (
  SELECT doc_id, source AS host, coalesce(text, '') AS t, {_WORDS} AS w FROM documents
),
pairs AS (
  SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS win
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5)
),
again AS (
  SELECT doc_id, i FROM pairs QUALIFY count(*) OVER (PARTITION BY doc_id, win) > 1
),
covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM again, range(0, 5) r(k) GROUP BY doc_id
),
l AS (
  SELECT doc_id, host, x, len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')) AS n,
         lower(trim(regexp_replace(x, '[\x20\x09-\x0D]+', ' ', 'g'), ' ')) AS norm
  FROM (SELECT doc_id, host, unnest(string_split(t, chr(10))) AS x FROM d)
  WHERE regexp_matches(x, '[^\x20\x09-\x0D]')
),
dup AS (SELECT doc_id, count(*) - count(DISTINCT x) AS n FROM l GROUP BY doc_id),
size AS (SELECT host, count(DISTINCT t) AS n FROM d GROUP BY host),
freq AS (
  SELECT f.host, f.norm FROM (
    SELECT l.host, norm, count(DISTINCT t) AS n FROM l JOIN d USING (doc_id) GROUP BY ALL
  ) f JOIN size s ON f.host IS NOT DISTINCT FROM s.host
  WHERE f.n > {line_rules.MIN_DOCS} AND f.n > {line_rules.MAX_SHARE} * least(s.n, sqrt(s.n * {line_rules.WIDE_HOST}))
),
gone AS (
  SELECT doc_id, sum(n) AS n FROM l JOIN freq f ON l.host IS NOT DISTINCT FROM f.host AND l.norm = f.norm GROUP BY doc_id
),
o AS (
  SELECT d.doc_id, len(w)::BIGINT AS n_words,
         length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         coalesce(dup.n, 0)::BIGINT AS n_dup_lines, coalesce(covered.n, 0)::BIGINT AS n_repeat_words,
         (len(w) - coalesce(gone.n, 0))::BIGINT AS left_words
  FROM d LEFT JOIN dup USING (doc_id) LEFT JOIN covered USING (doc_id) LEFT JOIN gone USING (doc_id)
)
SELECT *, n_words < {line_rules.MIN_WORDS} OR 100 * n_repeat_words > {line_rules.REPEAT_PERCENT} * n_words AS base_failed,
       NOT base_failed AND left_words >= {line_rules.MIN_LEFT_WORDS} AND left_words >= {line_rules.MIN_LEFT_SHARE} * n_words AS kept
FROM o
"""


@query
def op2_extendible_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.place(table(spark, sf_dir, "documents"))


# Depths up to 32 are enough for the tables SQL is run on; ids and texts are parted before.
ORACLE["op2_extendible_shards"] = f"""
WITH d AS (
  SELECT doc_id, strlen(coalesce(text, ''))::BIGINT AS n_bytes,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null')), 1, 15))::BIGINT AS h
  FROM documents
),
a AS (
  SELECT doc_id, n_bytes, k AS depth, substr(lpad(bin(h), 60, '0'), 1, k) AS shard
  FROM d, range(0, 33) r(k)
),
n AS (SELECT depth, shard, sum(n_bytes)::BIGINT AS shard_bytes, count(*) AS n FROM a GROUP BY ALL)
SELECT doc_id, shard, depth::INTEGER AS depth, n_bytes, shard_bytes
FROM a JOIN n USING (depth, shard)
WHERE shard_bytes <= {sharding.LIMIT_BYTES} OR n = 1
QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY depth) = 1
"""


@query
def op9_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = settled(mixing.weighed(table(spark, sf_dir, "documents")), "weighed")
    out = mixing.drawn(rows, mixing.chances(rows)).withColumnRenamed("_id", "doc_id")
    return out.withColumns({c: F.round(c, 6) + F.lit(0.0) for c in ("probability", *[f"short_{m}" for m in mixing.MARGINS])})


def _raking_sql() -> str:
    w = "SELECT *, now AS w FROM cells"
    for i in range(mixing.ROUNDS):
        for m in mixing.MARGINS:
            w = (
                f"SELECT source, lang, topic, now, goal_source, goal_lang, goal_topic, "
                f"w * goal_{m} / sum(w) OVER (PARTITION BY {m}) AS w FROM ({w})"
            )
    return w


ORACLE["op9_source_mix"] = rf"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS source, coalesce(lang, '') AS lang, coalesce(text, '') AS t,
         len({_WORDS})::BIGINT AS n_tokens FROM documents
),
r AS (
  SELECT doc_id, source, lang, n_tokens, CASE
    WHEN (length(t) - length(translate(t, '|' || chr(9), ''))) / greatest(length(t), 1) > 0.02 THEN 'table'
    WHEN (length(t) - length(translate(t, '0123456789', ''))) / greatest(length(t), 1) > 0.1 THEN 'numeric'
    WHEN length(t) < 500 THEN 'note' ELSE 'prose' END AS topic
  FROM d
),
c0 AS (SELECT source, lang, topic, sum(n_tokens)::DOUBLE AS now FROM r GROUP BY ALL HAVING sum(n_tokens) > 0),
gs AS (SELECT source, pow(sum(now), {mixing.TEMPER["source"]}) AS s FROM c0 GROUP BY source),
gl AS (SELECT lang, pow(sum(now), {mixing.TEMPER["lang"]}) AS s FROM c0 GROUP BY lang),
gt AS (SELECT topic, pow(sum(now), {mixing.TEMPER["topic"]}) AS s FROM c0 GROUP BY topic),
cells AS (
  SELECT c0.*, gs.s / (SELECT sum(s) FROM gs) AS goal_source, gl.s / (SELECT sum(s) FROM gl) AS goal_lang,
         gt.s / (SELECT sum(s) FROM gt) AS goal_topic
  FROM c0 JOIN gs USING (source) JOIN gl USING (lang) JOIN gt USING (topic)
),
raked AS ({_raking_sql()}),
s AS (SELECT *, w / now AS s, sum(now) OVER () AS total FROM raked),
o AS (
  SELECT *, sum(now) OVER falling AS above, sum(now * s) OVER () - sum(now * s) OVER falling AS others, lead(s, 1, 0.0) OVER falling AS next
  FROM s WINDOW falling AS (ORDER BY s DESC, source, lang, topic ROWS UNBOUNDED PRECEDING)
),
divisor AS (
  SELECT CASE WHEN sum(now * s) / max(s) >= {mixing.KEPT} * sum(now) THEN max(s) ELSE min(
    CASE WHEN {mixing.KEPT} * total > above AND others / ({mixing.KEPT} * total - above) <= s AND others / ({mixing.KEPT} * total - above) >= next
         THEN others / ({mixing.KEPT} * total - above) END) END AS d FROM o
),
p AS (SELECT source, lang, topic, now, w, least(1.0, s / d) AS probability FROM s CROSS JOIN divisor),
{", ".join(f"""short_{m} AS (
  SELECT {m}, 1 - (sum(now * probability) / (SELECT sum(now * probability) FROM p)) / (sum(w) / (SELECT sum(w) FROM p)) AS short_{m}
  FROM p GROUP BY {m}
)""" for m in mixing.MARGINS)}
SELECT doc_id, source, lang, topic, n_tokens, round(pr, 6) + 0.0 AS probability,
       {", ".join(f"round(coalesce(short_{m}, 0.0), 6) + 0.0 AS short_{m}" for m in mixing.MARGINS)},
       ('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null')), 1, {mixing.DRAW_DIGITS}))::BIGINT / {float(16 ** mixing.DRAW_DIGITS)} < pr AS kept
FROM (
  SELECT r.*, coalesce(probability, CASE WHEN n_tokens = 0 THEN 1.0 ELSE 0.0 END) AS pr,
         {", ".join(f"CASE WHEN probability IS NOT NULL THEN short_{m} END AS short_{m}" for m in mixing.MARGINS)}
  FROM r LEFT JOIN p USING (source, lang, topic) LEFT JOIN short_source USING (source) LEFT JOIN short_lang USING (lang) LEFT JOIN short_topic USING (topic)
)
"""


@query
def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return secret_scan.scan(docs, secret_scan.train(secret_scan.labelled_tokens(docs)))


#: A key for the registered query only; real runs pass their own.
DEMONSTRATION_KEY = "brimline"


@query
def op5_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pseudonyms.replace(table(spark, sf_dir, "documents"), DEMONSTRATION_KEY)
    return out.select(
        "doc_id", "text", *[F.col("pii_counts")[i].alias(f"n_{k}") for i, k in enumerate(pseudonyms.KINDS)]
    )


@query
def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), VOCABULARY)


END_ID = 2


@query
def op8_id_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "ids")
    id_store.write_ids(table(spark, sf_dir, "documents"), path, VOCABULARY, END_ID)
    return id_store.read_ids(spark, path)


@query
def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_copies(table(spark, sf_dir, "documents"))
    return out.select("doc_id", simhash.hexadecimal("fp").alias("fingerprint"), "component_id")


@query
def op3_norm_bucket_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


ORACLE["op3_norm_bucket_top_k"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0
)
SELECT query_id, (row_number() OVER w)::INTEGER AS rank, vec_id, score FROM s
WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER w <= 10
"""


@query
def op1_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_model.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.withColumns({c: F.round(c, 4) for c in ("perplexity", "threshold")})


@query
def op13_differenced_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return differencing.pack(table(spark, sf_dir, "documents"), VOCABULARY)


@query
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    other = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, other)


ORACLE["op12_hard_negatives"] = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_inner_product(a.e, c.e)::BIGINT AS score
  FROM v a JOIN v c ON a.vec_id <> c.vec_id WHERE a.vec_id % 100 = 0
),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id, (row_number() OVER w)::INTEGER AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER w <= 10
"""


@query
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def _phrases_sql() -> str:
    return " UNION ALL ".join(
        f"SELECT lang, w[i:i + {n - 1}] AS p FROM (SELECT lang, w, unnest(range(1, len(w) - {n - 2})) AS i FROM w WHERE len(w) >= {n})"
        for n in range(1, collocations.LONGEST + 1)
    )


ORACLE["op11_collocations"] = rf"""
WITH t AS (
  SELECT coalesce(lang, 'und') AS lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
),
w AS (
  SELECT lang, regexp_extract_all(piece, '[^ 	]+') AS w
  FROM (SELECT lang, unnest(string_split_regex(t, '[.,;:!?
-
]')) AS piece FROM t)
),
size AS (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY lang),
f AS (SELECT lang, p, count(*) AS f FROM ({_phrases_sql()}) GROUP BY ALL HAVING count(*) >= {collocations.LEAST}),
cut AS (SELECT lang, p, f AS a, unnest(range(1, len(p))) AS k FROM f WHERE len(p) > 1),
s AS (
  SELECT c.lang, c.p, c.a, k, l.f AS l, r.f AS r, ({collocations.SCORE_SCALE}::HUGEINT * c.a) // (l.f + r.f) AS score
  FROM cut c JOIN f l ON l.lang = c.lang AND l.p = c.p[:k] JOIN f r ON r.lang = c.lang AND r.p = c.p[k + 1:]
  QUALIFY row_number() OVER (PARTITION BY c.lang, c.p ORDER BY score, k) = 1
),
sub AS (
  SELECT lang, p[i:i + n - 1] AS p, max(f) AS f
  FROM (SELECT lang, p, f, n, unnest(range(1, len(p) - n + 2)) AS i
        FROM (SELECT lang, p, f, unnest(range(2, len(p))) AS n FROM f WHERE len(p) > 2))
  GROUP BY ALL
),
best AS (
  SELECT s.lang, array_to_string(s.p, ' ') AS phrase, a, l, r, score::BIGINT AS score
  FROM s LEFT JOIN sub ON s.lang = sub.lang AND s.p = sub.p
  WHERE sub.f IS NULL OR 100 * sub.f < {collocations.COVERED_PERCENT} * a
)
SELECT lang, row_number() OVER o AS rank, phrase, a, l, r, n, score FROM best JOIN size USING (lang)
WINDOW o AS (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) QUALIFY row_number() OVER o <= {collocations.TOP}
"""
