"""The queries of this package and, where SQL can express them, their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import ann, exact_dedup, langid, line_dedup, lm_scoring, mixing, packing, sharding, simhash_dedup, warc

BUDGETS = (0.25, 0.5, 1.0)
#: Target weights of sources; others weigh DEFAULT_WEIGHT.
WEIGHTS, DEFAULT_WEIGHT = {"src0": 3.0, "src1": 2.0, "src2": 0.5}, 1.0
SHARDS, SHARDS_AFTER = 1024, 1152


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_levels(table(spark, sf_dir, "documents"), BUDGETS, WEIGHTS, DEFAULT_WEIGHT)


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op3_jump_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.reshard(table(spark, sf_dir, "documents"), SHARDS, SHARDS_AFTER)


def op4_bm25_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op5_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.export_pages(table(spark, sf_dir, "pages"))


def op6_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "benchmark")
    return lm_scoring.score_texts(table(spark, sf_dir, "documents"), items).drop("text")


def op7_fuzzy_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.label_documents(table(spark, sf_dir, "documents"))


def language_id_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.label_pages(table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents"))


def op9_one_bit_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return ann.nearest(vectors, vectors.filter("vec_id % 20 = 0"))


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.near_dedup(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_mix_sources, op2_exact_dedup, op3_jump_shards, op4_bm25_packing, op5_warc_index, op6_lm_scores, op7_fuzzy_line_dedup, op8_language_id, op9_one_bit_neighbours, op10_simhash_near_dedup, language_id_pages,
    )

}


def _jump(n: int, name: str) -> str:
    return f"""{name} AS (
      SELECT doc_id, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null')), 1, 15))::BIGINT::HUGEINT AS k, -1::BIGINT AS b, 0::BIGINT AS j FROM documents
      UNION ALL
      SELECT doc_id, k2, j, CAST(floor((j + 1) * (2147483648.0::DOUBLE / ((k2 // 8589934592) + 1)::DOUBLE)) AS BIGINT)
      FROM (SELECT doc_id, j, (k * 2862933555777941757::HUGEINT + 1) % 18446744073709551616::HUGEINT AS k2 FROM {name} WHERE j < {n}))"""


ORACLE: dict[str, str] = {
    "op1_mix_sources": """
WITH c AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^ \\t\\r\\n]+')), 0)::BIGINT AS n_tokens,
                  ('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'text:' || text, 'null')), 1, 15))::BIGINT AS h FROM documents),
     w AS (SELECT source, (CASE source WHEN 'src0' THEN 3.0 WHEN 'src1' THEN 2.0 WHEN 'src2' THEN 0.5 ELSE 1.0 END)::DOUBLE AS weight FROM c GROUP BY source),
     t AS (SELECT (SELECT sum(n_tokens)::DOUBLE FROM c) AS total, (SELECT sum(weight) FROM w) AS k),
     r AS (SELECT doc_id, source, n_tokens, sum(n_tokens) OVER (PARTITION BY source ORDER BY h RANGE UNBOUNDED PRECEDING) AS up_to FROM c),
     x AS (SELECT r.*, weight, total, k FROM r JOIN w ON r.source IS NOT DISTINCT FROM w.source, t)
SELECT doc_id, source, n_tokens,
       CASE WHEN up_to <= floor(total * 0.25::DOUBLE * weight / k) THEN 0 WHEN up_to <= floor(total * 0.5::DOUBLE * weight / k) THEN 1 ELSE 2 END::INTEGER AS level
FROM x WHERE up_to <= floor(total * 1.0::DOUBLE * weight / k)""",
    "op2_exact_dedup": """
SELECT * FROM documents QUALIFY text IS NULL OR row_number() OVER (PARTITION BY text ORDER BY doc_id NULLS LAST) = 1""",
    "op3_jump_shards": f"""
WITH RECURSIVE {_jump(SHARDS, 'one')}, {_jump(SHARDS_AFTER, 'two')},
     f1 AS (SELECT doc_id, b::INTEGER AS b FROM one WHERE j >= {SHARDS}), f2 AS (SELECT doc_id, b::INTEGER AS b FROM two WHERE j >= {SHARDS_AFTER})
SELECT f1.doc_id, f1.b AS shard_before, f2.b AS shard, f1.b <> f2.b AS moved FROM f1 JOIN f2 USING (doc_id)""",
    "op9_one_bit_neighbours": """
SELECT a.vec_id, row_number() OVER (PARTITION BY a.vec_id ORDER BY list_dot_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) DESC, b.vec_id)::INTEGER AS rank,
       b.vec_id AS neighbour, round(list_dot_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 5) AS similarity
FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id WHERE a.vec_id % 20 = 0 QUALIFY rank <= 10""",
}
