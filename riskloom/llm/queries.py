"""The registered queries of this subpackage: each applies an operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from riskloom.llm import (
    bpe_codec, clustering, html, line_dedup, merkle, mixing, quality, secrets, simhash, sketch, token_count, topk, toxicity,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(sql: str | None = None):
    def register(build):
        QUERIES[build.__name__] = build
        if sql:
            ORACLES[build.__name__] = sql
        return build

    return register


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@_query()
def op1_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    counted = token_count.count_tokens(
        _table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)
    return counted.withColumn("over_limit", F.col("n_tokens") > 512)


@_query("""
WITH v AS (SELECT vec_id, unnest(range(0, len(embedding))) AS i, CAST(floor(256 * CAST(unnest(embedding) AS DOUBLE)) AS BIGINT) AS x
           FROM embeddings),
s AS (SELECT q.vec_id AS query_id, d.vec_id, sum(q.x * d.x) AS score
      FROM v q JOIN v d ON q.i = d.i AND q.vec_id <> d.vec_id WHERE q.vec_id % 50 = 0 GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS k FROM s)
SELECT query_id, CAST(k AS INTEGER) AS rank, vec_id, CAST(score AS BIGINT) AS score FROM r WHERE k <= 5""")
def op2_cover_tree_search(spark: SparkSession, folder: str) -> DataFrame:
    return topk.top_k(_table(spark, folder, "embeddings"), k=5, every=50)


@_query()
def op3_main_text(spark: SparkSession, folder: str) -> DataFrame:
    return html.extract(_table(spark, folder, "pages"))


def _crossing(name: str, keeps: str) -> str:
    """The exponent in [0, 1] up to which a condition holds, by three grids of a thousand points each."""
    steps = []
    for k, width in enumerate((1e-3, 1e-6, 1e-9)):
        low = f"(SELECT a FROM {name}{k - 1})" if k else "0.0"
        steps.append(f"""{name}{k} AS (
    SELECT coalesce(max(a), {low}) AS a FROM (
        SELECT g.a, sum(pow(p, g.a)) AS z, sum(pow(p, g.a) * ln(p)) AS s, min(p) AS least
        FROM p CROSS JOIN (SELECT {low} + i * {width:.9f} AS a FROM range(0, 1000) r(i)) g GROUP BY 1)
    WHERE {keeps})""")
    return ",\n".join(steps)


_TARGET = mixing.Target()
_MIX_SQL = f"""
WITH d AS (SELECT doc_id, source, concat_ws(':', CAST(doc_id AS VARCHAR), md5(text)) AS name,
                  len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS words FROM documents),
t AS (SELECT source, sum(words) AS tokens, count(*) AS docs FROM d GROUP BY 1 HAVING sum(words) > 0),
c AS (SELECT sum(tokens) AS whole, count(*) AS n FROM t),
p AS (SELECT source, tokens, docs, CAST(tokens AS DOUBLE) / whole AS p FROM t, c),
own AS (SELECT -sum(p * ln(p)) AS h FROM p),
{_crossing("e", f"ln(z) - a * s / z > {_TARGET.entropy} * ln((SELECT n FROM c))")},
{_crossing("m", f"pow(least, a - 1) / z > {_TARGET.max_repeats}")},
x AS (SELECT CASE WHEN h >= {_TARGET.entropy} * ln((SELECT n FROM c)) THEN 1.0
                  ELSE greatest(round((SELECT a FROM e2), 6), round((SELECT a FROM m2), 6)) END AS a FROM own),
w AS (SELECT source, tokens, docs, pow(p, a) AS q FROM p, x),
b AS (SELECT source, tokens, CAST(ceil(docs / {float(mixing.BLOCK_DOCS)}) AS BIGINT) AS blocks,
             CAST(round(q / (SELECT sum(q) FROM w) * whole) AS BIGINT) AS budget FROM w, c),
plan AS (SELECT source, blocks, CAST(floor(budget / tokens) AS BIGINT) AS whole, budget - CAST(floor(budget / tokens) AS BIGINT) * tokens AS rest FROM b),
dealt AS (SELECT d.*, plan.whole, plan.rest,
                 CAST('0x' || substr(md5('1:block:' || name), 1, 7) AS BIGINT) % blocks AS block FROM d JOIN plan ON d.source IS NOT DISTINCT FROM plan.source),
sizes AS (SELECT source, block, sum(words) AS size FROM dealt GROUP BY 1, 2),
starts AS (SELECT source, block,
                  sum(size) OVER (PARTITION BY source ORDER BY md5('1:order:1' || source || ':' || CAST(block AS VARCHAR)), block) - size AS start FROM sizes),
placed AS (SELECT dealt.*, start + sum(words) OVER (PARTITION BY dealt.source, dealt.block ORDER BY md5('1:row:' || name), name) - words AS before
           FROM dealt JOIN starts ON dealt.source = starts.source AND dealt.block = starts.block),
passes AS (SELECT doc_id, source, words, whole + CASE WHEN before < rest THEN 1 ELSE 0 END AS passes FROM placed)
SELECT doc_id, source, CAST(words AS BIGINT) AS n_words, CAST(i AS BIGINT) AS "pass" FROM passes JOIN range(0, 10) r(i) ON i < passes"""


@_query(_MIX_SQL)
def op4_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    mixed = mixing.mix(docs.select("doc_id", "source", "text"), pass_as="pass", tokens_as="n_words")
    return mixed.select("doc_id", "source", "n_words", "pass")


@_query()
def op5_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.assess(_table(spark, folder, "documents"))


@_query()
def op6_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.scan_secrets(_table(spark, folder, "documents"), owner=F.col("source"))


@_query()
def op7_simhash_groups(spark: SparkSession, folder: str) -> DataFrame:
    groups = simhash.simhash_groups(_table(spark, folder, "documents"), shingle=4, distance=4)
    return groups.select("doc_id", "fingerprint", "component_id")


@_query()
def op8_bpe_encoding(spark: SparkSession, folder: str) -> DataFrame:
    return bpe_codec.encode_decode(
        _table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@_query()
def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """``held_out`` is NULL for a NULL id, whose remainder is unknown; such a row is never learned from."""
    docs = _table(spark, folder, "documents")
    scored = toxicity.score(docs, toxicity.train(docs, _table(spark, folder, "labels")), threshold=0.7)
    return scored.select("doc_id", (toxicity.fold(F.col("doc_id")) == 1).alias("held_out"), "score", "predicted")


@_query()
def op10_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs, count_as="n_cut")


_FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def _leaf_sql(fields: dict[str, str]) -> str:
    parts = [f"CASE WHEN {e} IS NULL THEN '-' ELSE CAST(strlen(CAST({e} AS VARCHAR)) AS VARCHAR) || ':' || CAST({e} AS VARCHAR) END"
             for e in fields.values()]
    return f"sha256({' || '.join(parts)})"


def _levels_sql(name: str, leaves: str) -> str:
    """All nodes of the trees over ``leaves (g, i, n, d)``, and of each node its siblings."""
    return f"""{name} AS (
    SELECT 0 AS level, g, i, n, d FROM {leaves}
    UNION ALL
    SELECT level + 1, g, i // 8, (n + 7) // 8, sha256(string_agg(d, '' ORDER BY i)) FROM {name} WHERE n > 1 GROUP BY level, g, i // 8, (n + 7) // 8, n),
{name}_path AS (
    SELECT a.level, a.g, a.i, coalesce(string_agg(b.d, '' ORDER BY b.i) FILTER (WHERE b.i < a.i), '') AS l,
           coalesce(string_agg(b.d, '' ORDER BY b.i) FILTER (WHERE b.i > a.i), '') AS r
    FROM {name} a JOIN {name} b ON a.level = b.level AND a.g = b.g AND a.i // 8 = b.i // 8 WHERE a.n > 1 GROUP BY ALL)"""


_CRC_SQL = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: ascii(x)::BIGINT)),
    lambda a, x: list_reduce([xor(a, x)::BIGINT, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END)::BIGINT)))"""
_EDITED_SQL = "CASE WHEN doc_id IS NOT NULL AND crc % 3 = 0 THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END"
_MERKLE_SQL = f"""
WITH RECURSIVE told AS (SELECT *, {_CRC_SQL} AS crc FROM documents),
leaf AS (SELECT doc_id, CASE WHEN lang IS NULL THEN '0' ELSE '1' || lang END AS g, {_leaf_sql({c: c for c in _FIELDS})} AS d,
                {_leaf_sql({**{c: c for c in _FIELDS}, "text": "(" + _EDITED_SQL + ")"})} AS claimed FROM told),
low AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, d) - 1 AS i, count(*) OVER (PARTITION BY g) AS n FROM leaf),
{_levels_sql("t", "low")},
tops AS (SELECT g AS name, d, '' AS g, row_number() OVER (ORDER BY g) - 1 AS i, count(*) OVER () AS n FROM t WHERE n = 1),
{_levels_sql("u", "tops")},
climb AS (
    SELECT doc_id, g, i, n, d, claimed AS f, '' AS proof, 0 AS level FROM low
    UNION ALL
    SELECT doc_id, c.g, c.i // 8, (c.n + 7) // 8, d, sha256(l || f || r), proof || l || r, c.level + 1
    FROM climb c JOIN t_path p ON c.level = p.level AND c.g = p.g AND c.i = p.i WHERE c.n > 1),
on_top AS (SELECT doc_id, c.d, t.d AS subroot, f, proof, t.i, t.n, 0 AS level FROM climb c JOIN tops t ON c.g = t.name WHERE c.n = 1),
over AS (
    SELECT * FROM on_top
    UNION ALL
    SELECT doc_id, d, subroot, sha256(l || f || r), proof || l || r, o.i // 8, (o.n + 7) // 8, o.level + 1
    FROM over o JOIN u_path p ON o.level = p.level AND o.i = p.i WHERE o.n > 1)
SELECT doc_id, o.d AS leaf, subroot, u.d AS root, sha256(proof) AS proof_sha256, f AS folded_root, f = u.d AS verified
FROM over o JOIN u ON u.n = 1 WHERE o.n = 1"""


@_query(_MERKLE_SQL)
def op11_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    fields = {c: F.col(c) for c in _FIELDS}
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    edited = merkle.leaf(*{**fields, "text": merkle.lower_ascii(F.col("text"))}.values())
    return merkle.manifest(docs, list(_FIELDS), arity=8, claimed=F.when(tampered, edited))


_CLUSTERS, _ROUNDS, _DIMS = 40, 5, 64


def _lloyd_sql() -> str:
    steps = []
    for r in range(_ROUNDS + 1):
        steps.append(f"""a{r} AS MATERIALIZED (
    SELECT row_id, arg_min(cluster, (distance, cluster)) AS cluster, min(distance) AS distance
    FROM (SELECT row_id, cluster, sum((v.x - c.x) * (v.x - c.x)) AS distance FROM v JOIN c{r} c USING (j) GROUP BY 1, 2) GROUP BY 1)""")
        if r < _ROUNDS:
            steps.append(f"""c{r + 1} AS MATERIALIZED (
    SELECT c.cluster, c.j, coalesce(m.x, c.x) AS x FROM c{r} c LEFT JOIN (
        SELECT cluster, j, CAST((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS x FROM v JOIN a{r} USING (row_id) GROUP BY 1, 2) m USING (cluster, j))""")
    chain = ",\n".join(steps)
    return f"""
WITH kept AS MATERIALIZED (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e, row_number() OVER () AS row_id
    FROM embeddings WHERE len(embedding) = {_DIMS} AND list_bool_and(list_transform(embedding, lambda x: coalesce(isfinite(x), false)))),
v AS MATERIALIZED (SELECT row_id, unnest(range(0, {_DIMS})) AS j, unnest(e) AS x FROM kept),
named AS (SELECT e, row_number() OVER (ORDER BY sha256('2:' || CAST(vec_id AS VARCHAR)) NULLS LAST, e) - 1 AS cluster FROM kept),
c0 AS MATERIALIZED (SELECT CAST(cluster AS INTEGER) AS cluster, unnest(range(0, {_DIMS})) AS j, unnest(e) AS x FROM named WHERE cluster < {_CLUSTERS}),
{chain},
told AS (SELECT cluster, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY j)) AS centroid_sha256 FROM c{_ROUNDS} GROUP BY 1)
SELECT vec_id, cluster, CAST(distance AS BIGINT) AS distance, CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(distance) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM a{_ROUNDS} JOIN kept USING (row_id) JOIN told USING (cluster)"""


@_query(_lloyd_sql())
def op12_centroid_clusters(spark: SparkSession, folder: str) -> DataFrame:
    return clustering.lloyd(_table(spark, folder, "embeddings"), k=_CLUSTERS, rounds=_ROUNDS, dims=_DIMS, scale=256, seed="2")


@_query()
def op13_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return sketch.compare_edits(_table(spark, folder, "documents"))
