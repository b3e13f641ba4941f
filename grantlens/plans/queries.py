"""Registered queries over the driver's tables, each with its DuckDB twin."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions import similarity as S
from ..functions import text as T
from ..operators import relational as R
from ..operators import retrieval as X
from .registry import ORACLE, QUERIES, WORKS, query, table, works  # noqa: F401

_PARAS = WORKS + r""",
 parts AS (SELECT doc_id, list_filter(list_transform(string_split_regex(text, '\n[ \t\r\f]*\n'), lambda p: regexp_replace(p, '^\s+|\s+$', '', 'g')), lambda p: p <> '') AS ps FROM works),
 paras AS (SELECT doc_id, unnest(ps) AS paragraph, unnest(range(len(ps))) AS para_idx FROM parts)"""


def _rx(column: str, patterns: Sequence[str]) -> str:
    """RE2 has no look-ahead: for patterns with one, what must not follow is taken out of the text first."""
    plain, ahead = [x for x in patterns if "%NOFIG" not in x], [x.replace("%NOFIG", "") for x in patterns if "%NOFIG" in x]
    q = lambda x: x.replace("'", "''")
    out = [f"regexp_matches({column}, '(?i){q(P.either(plain))}')"]
    if ahead:
        out.append(rf"regexp_matches(regexp_replace({column}, '(?i)(by|from|through)(\s+(?:eq\.|equation|fig\.|figure|section|table))', 'xx\2', 'g'), '(?i){q(P.either(ahead))}')")
    return "(" + " OR ".join(out) + ")"


_PREFILTER = _PARAS + f""",
 hits AS (SELECT *, {_rx("paragraph", P.BROAD)}::INT AS hit FROM paras),
 kept AS (SELECT doc_id, para_idx, paragraph FROM (SELECT *, max(hit) OVER (PARTITION BY doc_id ORDER BY para_idx ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS near FROM hits) WHERE near = 1)"""
_SCORES = _PREFILTER + ", queries(q_pos, query, words) AS (VALUES " + ", ".join(f"({i}, '{n}', [{', '.join(repr(w) for w in dict.fromkeys(t.lower().split()))}])" for i, (n, t) in enumerate(P.QUERIES.items())) + rf"""),
 worded AS (SELECT *, list_distinct(string_split(lower(regexp_replace(paragraph, '[^A-Za-z0-9]+', ' ', 'g')), ' ')) AS ws FROM kept),
 scores AS (SELECT doc_id, para_idx, paragraph, q_pos, query, len(list_intersect(ws, words)) * ({X.FULL_SCORE}::DOUBLE / len(words)) AS score FROM worded, queries),
 ranked AS (SELECT *, row_number() OVER (PARTITION BY doc_id, q_pos ORDER BY score DESC, para_idx) AS rank FROM scores QUALIFY rank <= {X.TOP_K})"""
_GATE = f"(CASE WHEN score > {X.HIGH} THEN true WHEN score <= 11 THEN false WHEN {_rx('paragraph', P.NEGATIVE)} THEN false ELSE {_rx('paragraph', P.POSITIVE)} END)"
_CONF = lambda c: "greatest(0, " + " + ".join(f"CASE WHEN {_rx(f'lower({c})', p)} THEN {w} ELSE 0 END" for _, w, p in P.MARKERS) + ")::INTEGER"
_HITS = lambda c, kws: f"(CASE WHEN regexp_matches(lower({c}), '{'|'.join(kws)}') THEN list_filter(range(1, length({c}) + 1), lambda i: regexp_matches(substr(lower({c}), i, {max(map(len, kws))}), '^(?:{'|'.join(kws)})')) ELSE [] END)"


def _texts(source: str) -> str:
    """CTE ``cut`` adds (whole, sentences, window_) to the columns of ``source`` (paragraph, score)."""
    return rf""" measured AS (SELECT *, {_HITS("paragraph", X.DENSITY_WORDS)} AS dense_at, {_HITS("paragraph", X.KEYWORDS)} AS key_at, list_filter(string_split_regex(lower(paragraph), '\s+'), lambda w: w <> '') AS ws,
  list_filter(string_split(regexp_replace(paragraph, '([.!?])\s+([A-Z])', '\1' || chr(1) || '\2', 'g'), chr(1)), lambda s: regexp_matches(s, '{X.SENTENCE}')) AS ss FROM {source}),
 placed AS (SELECT *, greatest(key_at[1] - 101, 0) AS s0, least(key_at[len(key_at)] + 199, length(paragraph)) AS e0 FROM measured),
 sides AS (SELECT *, substr(paragraph, greatest(s0 - 50, 0) + 1, s0 - greatest(s0 - 50, 0)) AS before, substr(paragraph, e0 + 1, 100) AS after FROM placed),
 ends AS (SELECT *, CASE WHEN regexp_matches(before, '[.!?\n]') THEN s0 - length(regexp_replace(before, '(?s)^.*[.!?\n]', '')) ELSE s0 END AS s1, CASE WHEN regexp_matches(after, '[.!?]') THEN e0 + length(regexp_extract(after, '(?s)^([^.!?]*[.!?])', 1)) ELSE e0 END AS e1 FROM sides),
 cut AS (SELECT *, (score > {X.HIGH} OR length(paragraph) < 500 OR len(list_filter(ws, lambda w: regexp_matches(w, '{"|".join(X.DENSITY_WORDS)}'))) / len(ws) > 0.05 OR len(list_filter(range(1, len(dense_at) - 1), lambda i: dense_at[i + 2] - dense_at[i] < 300)) > 0) AS whole,
  CASE WHEN len(ss) > 0 THEN array_to_string(list_transform(ss, lambda s: regexp_replace(s, '^\s+|\s+$', '', 'g')), ' ') END AS sentences, CASE WHEN len(key_at) > 0 THEN regexp_replace(substr(paragraph, s1 + 1, e1 - s1), '^\s+|\s+$', '', 'g') ELSE paragraph END AS window_ FROM ends)"""


_FOUND = f"""{_SCORES}, accepted AS (SELECT * FROM ranked WHERE {_GATE}), {_texts("accepted")},
 stated AS (SELECT *, CASE WHEN whole THEN paragraph WHEN length(paragraph) > 1000 THEN window_ ELSE sentences END AS statement FROM cut),
 found AS (SELECT * FROM stated WHERE length(statement) > 20 QUALIFY row_number() OVER (PARTITION BY doc_id, statement ORDER BY q_pos, rank) = 1)"""


@query(f"WITH {_FOUND} SELECT doc_id, para_idx::INTEGER AS para_idx, query, score, {_CONF('statement')} AS confidence, statement FROM found")
def extract_statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.extract_statements(works(spark, sf_dir))


@query(f"WITH {_PARAS} SELECT doc_id, para_idx::INTEGER AS para_idx, paragraph FROM paras")
def paragraph_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.split_documents(works(spark, sf_dir))


@query(r"SELECT doc_id, unnest(range(len(l)))::INTEGER AS para_idx, unnest(l) AS paragraph FROM (SELECT doc_id, list_filter(list_transform(string_split(text, chr(10)), lambda p: regexp_replace(p, '^\s+|\s+$', '', 'g')), lambda p: p <> '') AS l FROM documents)")
def line_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.split_documents(table(spark, sf_dir, "documents"), "\n")


@query(f"WITH {_PREFILTER} SELECT doc_id, para_idx::INTEGER AS para_idx, paragraph FROM kept")
def prefilter_neighbors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.prefilter(works(spark, sf_dir))


@query(f"WITH {_SCORES} SELECT doc_id, para_idx::INTEGER AS para_idx, query, score, rank::INTEGER AS rank FROM ranked")
def maxsim_lexical_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.ranked_paragraphs(works(spark, sf_dir)).select("doc_id", "para_idx", "query", "score", "rank")


@query("""WITH t AS (SELECT label AS doc_id, vec_id % 7 AS para_idx, embedding FROM embeddings), q AS (SELECT vec_id AS tok, vec_id // 4 AS q_pos, embedding AS e FROM embeddings WHERE vec_id < 12),
 m AS (SELECT doc_id, para_idx, q_pos, tok, max(list_dot_product(embedding::DOUBLE[], e::DOUBLE[])) AS best FROM t, q GROUP BY ALL) SELECT doc_id, para_idx, q_pos, round(sum(best), 5) AS score FROM m GROUP BY ALL""")
def maxsim_dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors of one label are the tokens of one document's seven paragraphs; the first twelve are three queries of four tokens."""
    e = table(spark, sf_dir, "embeddings")
    tokens = e.groupBy(F.col("label").alias("doc_id"), (F.col("vec_id") % 7).alias("para_idx")).agg(F.collect_list("embedding").alias("vectors"))
    asked = e.filter("vec_id < 12").groupBy(F.expr("vec_id div 4").alias("q_pos")).agg(F.collect_list("embedding").alias("vectors"))
    return X.max_similarity(tokens, asked).withColumn("score", F.round("score", 5))


@query(f"WITH {_SCORES} SELECT doc_id, para_idx::INTEGER AS para_idx, query, {_GATE} AS accepted FROM ranked")
def gate_decision(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.ranked_paragraphs(works(spark, sf_dir)).select("doc_id", "para_idx", "query", X.gate(F.col("score"), F.col("paragraph"), X.score_floor(True)).alias("accepted"))


_ALL_CUT = f"{_PARAS}, scored AS (SELECT *, 0.0::DOUBLE AS score FROM paras), {_texts('scored')}"


@query(f"WITH {_ALL_CUT} SELECT doc_id, para_idx::INTEGER AS para_idx, coalesce(whole, false) AS whole FROM cut")
def full_paragraph_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.split_documents(works(spark, sf_dir)).select("doc_id", "para_idx", X.takes_whole(F.col("paragraph"), F.lit(0.0)).alias("whole"))


@query(f"WITH {_ALL_CUT} SELECT doc_id, para_idx::INTEGER AS para_idx, sentences FROM cut")
def funding_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.split_documents(works(spark, sf_dir)).select("doc_id", "para_idx", X.funding_sentences(F.col("paragraph")).alias("sentences"))


@query(f"WITH {_ALL_CUT} SELECT doc_id, para_idx::INTEGER AS para_idx, window_ AS part FROM cut")
def long_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.split_documents(works(spark, sf_dir)).select("doc_id", "para_idx", X.long_window(F.col("paragraph")).alias("part"))


_KEEP = "CASE WHEN confidence >= 30 THEN 1 WHEN score >= 12 AND confidence >= 10 THEN 2 WHEN confidence < 10 THEN 3 WHEN confidence >= 20 THEN 4 WHEN score >= 12 THEN 5 ELSE 6 END"


@query(f"WITH {_FOUND}, c AS (SELECT doc_id, para_idx, query, score, {_CONF('statement')} AS confidence FROM found), k AS (SELECT *, {_KEEP} AS rule FROM c) SELECT doc_id, para_idx::INTEGER AS para_idx, query, confidence, rule IN (1, 2, 4, 5) AS keep, CASE rule WHEN 1 THEN 'high_confidence (' || confidence || ')' WHEN 2 THEN 'high_semantic (' || printf('%.1f', score) || ') + markers' WHEN 3 THEN 'low_confidence (' || confidence || ')' WHEN 4 THEN 'medium_confidence (' || confidence || ')' WHEN 5 THEN 'medium_confidence + semantic (' || printf('%.1f', score) || ')' ELSE 'insufficient_confidence (' || confidence || ')' END AS reason FROM k")
def post_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = X.extract_statements(works(spark, sf_dir))
    keep, why = X.keep_statement(F.col("confidence"), F.col("score"))
    return found.select("doc_id", "para_idx", "query", "confidence", keep.alias("keep"), why.alias("reason"))


@query(f"WITH {_PARAS} SELECT doc_id, para_idx::INTEGER AS para_idx, {_CONF('paragraph')} AS confidence, array_to_string(list_filter([" + ", ".join(f"CASE WHEN {_rx('lower(paragraph)', p)} THEN '{n}' END" for n, _, p in P.MARKERS) + "], lambda x: x IS NOT NULL), ',') AS markers FROM paras")
def confidence_markers(spark: SparkSession, sf_dir: str) -> DataFrame:
    score, names = X.confidence(F.col("paragraph"))
    return X.split_documents(works(spark, sf_dir)).select("doc_id", "para_idx", score.alias("confidence"), F.array_join(names, ",").alias("markers"))


_STRONG = " + ".join(_rx("lower(paragraph)", [x]) + "::INT" for x in P.STRONG)


@query(f"WITH {_PARAS}, h AS (SELECT *, ({_STRONG}) AS strong, 0.0::DOUBLE AS score FROM paras), marked AS (SELECT * FROM h WHERE NOT {_rx('lower(paragraph)', P.NEGATIVE)} AND (strong >= 2 OR (strong >= 1 AND {_rx('lower(paragraph)', P.POSITIVE)}))), {_texts('marked')}, r AS (SELECT *, CASE WHEN length(paragraph) < 500 THEN paragraph ELSE coalesce(sentences, CASE WHEN length(paragraph) > 1000 THEN window_ ELSE paragraph END) END AS statement FROM cut) SELECT doc_id, para_idx::INTEGER AS para_idx, 'pattern_rescue' AS query, 0.0::DOUBLE AS score, statement FROM r WHERE length(statement) >= 20 QUALIFY row_number() OVER (PARTITION BY doc_id, lower(statement) ORDER BY para_idx) = 1")
def pattern_rescue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.rescue(works(spark, sf_dir))


@query(rf"WITH {_PARAS} SELECT doc_id, para_idx::INTEGER AS para_idx, (contains(paragraph, '|---') OR regexp_matches(paragraph, '\|\s*[0-9]+\s*\|') OR length(paragraph) - length(replace(paragraph, '|', '')) > 4 OR len(list_filter(string_split(paragraph, chr(10)), lambda s: contains(s, '|'))) > 3) AS table_like FROM paras")
def table_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.split_documents(works(spark, sf_dir)).select("doc_id", "para_idx", T.is_table_like(F.col("paragraph")).alias("table_like"))


@query(r"""SELECT page_id, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(coalesce(html, ''), '[‘’]', '''', 'g'), '[“”]', '"', 'g'), '``|''''', '"', 'g'), '[*•]', '', 'g'), '\s+', ' ', 'g'), ' ') AS text FROM pages""")
def normalize_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", T.normalize_text(F.col("html")).alias("text"))


@query(r"SELECT doc_id, trim(regexp_replace(replace(replace(replace(replace(replace(replace(replace(regexp_replace(regexp_replace(text, '-\n([a-z])', '\1', 'g'), '\n', ' ', 'g'), 'ﬀ', 'ff'), 'ﬁ', 'fi'), 'ﬂ', 'fl'), 'ﬃ', 'ffi'), 'ﬄ', 'ffl'), 'ﬅ', 'st'), 'ﬆ', 'st'), ' {2,}', ' ', 'g'), ' ') AS text FROM documents")
def preprocess_statement(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", T.preprocess_statement(F.col("text")).alias("text"))


@query(r"SELECT p_partkey, regexp_replace('in/' || p_partkey || '-' || p_name || '-x', '^.*/([^-]*)-', '\1.') || '.md' AS name, regexp_replace(upper(trim(p_brand)), '[\s/-]', '', 'g') AS award FROM part")
def canonical_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.concat(F.lit("in/"), "p_partkey", F.lit("-"), "p_name", F.lit("-x.md"))
    return table(spark, sf_dir, "part").select("p_partkey", T.canonical_filename(path).alias("name"), T.normalize_award_id(F.col("p_brand")).alias("award"))


@query(r"WITH b AS (SELECT DISTINCT p_brand AS x FROM part), n AS (SELECT x, regexp_replace(upper(trim(x)), '[\s/-]', '', 'g') AS k FROM b) SELECT a.x AS a, b.x AS b, (CASE WHEN a.k = b.k THEN 1.0 WHEN length(a.k) >= 6 AND length(b.k) >= 6 AND levenshtein(a.k, b.k) = 1 THEN 0.5 ELSE 0.0 END)::DOUBLE AS score FROM n a, n b")
def soft_award_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    brands = table(spark, sf_dir, "part").select("p_brand").distinct()
    pairs = brands.select(F.col("p_brand").alias("a")).crossJoin(brands.select(F.col("p_brand").alias("b")))
    return pairs.withColumn("score", T.soft_award_score(F.col("a"), F.col("b")))


_MULTI = """WITH g AS (SELECT l_orderkey, l_partkey % 7 AS item, count(*) AS g FROM lineitem WHERE l_returnflag <> 'R' GROUP BY ALL), p AS (SELECT l_orderkey, l_partkey % 7 AS item, count(*) AS p FROM lineitem WHERE l_returnflag <> 'A' GROUP BY ALL),
 c AS (SELECT l_orderkey, coalesce(g, 0) AS g, coalesce(p, 0) AS p FROM g FULL JOIN p USING (l_orderkey, item)), m AS (SELECT l_orderkey, sum(g)::BIGINT AS gold, sum(p)::BIGINT AS predicted, sum(least(g, p))::BIGINT AS matched FROM c GROUP BY l_orderkey)"""


def _multiset(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", (F.col("l_partkey") % 7).alias("item"), "l_returnflag")
    return R.multiset_matches(lines.filter("l_returnflag <> 'R'"), lines.filter("l_returnflag <> 'A'"), "l_orderkey", "item")


@query(_MULTI + " SELECT * FROM m")
def award_id_multiset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _multiset(spark, sf_dir)


_F = lambda b: f"round(CASE WHEN {b * b} * p + r > 0 THEN (1 + {b * b}) * p * r / ({b * b} * p + r) ELSE 0 END, 6)"


@query(_MULTI + f", s AS (SELECT sum(gold)::BIGINT AS gold, sum(predicted)::BIGINT AS predicted, sum(matched)::BIGINT AS matched FROM m), v AS (SELECT *, matched / predicted AS p, matched / gold AS r FROM s) SELECT gold, predicted, matched, round(p, 6) AS precision, round(r, 6) AS recall, {_F(1.0)} AS f1, {_F(0.5)} AS f0_5, {_F(1.5)} AS f1_5 FROM v")
def level_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.level_metrics(_multiset(spark, sf_dir).agg(*[F.sum(c).alias(c) for c in ("gold", "predicted", "matched")]))


@query("SELECT coalesce(lang, 'overall') AS lang, count(*) AS docs, count(*) FILTER (quality = 1) AS gold, count(*) FILTER (n_chars > 1000) AS predicted, count(*) FILTER (quality = 1 AND n_chars > 1000) AS matched, round(quantile_cont(n_chars, 0.95), 4) AS p95 FROM documents JOIN labels USING (doc_id) GROUP BY GROUPING SETS ((lang), ())")
def bucket_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars").join(table(spark, sf_dir, "labels"), "doc_id")
    gold, said = F.col("quality") == 1, F.col("n_chars") > 1000
    return R.bucket_and_overall(rows, "lang", F.count("*").alias("docs"), F.count_if(gold).alias("gold"), F.count_if(said).alias("predicted"), F.count_if(gold & said).alias("matched"), F.round(F.percentile("n_chars", 0.95), 4).alias("p95"))


@query("SELECT user_id, round(list_reduce(list(value ORDER BY event_id), lambda a, x: a * 0.7::DOUBLE + x * 0.3::DOUBLE), 6) AS ema FROM events GROUP BY user_id")
def ema_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.ema(table(spark, sf_dir, "events"), "user_id", "event_id", "value")


@query("SELECT o_orderkey, o_custkey FROM orders o WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND l.l_returnflag = 'R')")
def resume_antijoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = table(spark, sf_dir, "lineitem").filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return R.resume(table(spark, sf_dir, "orders"), done, ["o_orderkey"]).select("o_orderkey", "o_custkey")


@query("SELECT doc_id, md5(doc_id::VARCHAR) AS checkpoint FROM documents WHERE md5(doc_id::VARCHAR) NOT IN (SELECT md5(doc_id::VARCHAR) FROM labels)")
def checkpoint_antijoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.md5(F.col("doc_id").cast("string")).alias("checkpoint")
    return R.resume(table(spark, sf_dir, "documents").select("doc_id", key), table(spark, sf_dir, "labels").select(key), ["checkpoint"])


@query("SELECT conv_id, len(list(turn)) AS turns, array_to_string(list(replace(text, ' ', '_') ORDER BY turn), chr(10)) AS joined FROM conversations GROUP BY conv_id")
def flatten_regroup(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations").withColumn("text", F.replace("text", F.lit(" "), F.lit("_")))
    one = c.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "text"))).alias("xs"))
    return one.select("conv_id", F.size("xs").cast("bigint").alias("turns"), F.array_join("xs.text", "\n").alias("joined"))


@query("SELECT conv_id, arg_min(text, turn) AS text FROM conversations WHERE role = 'assistant' GROUP BY conv_id")
def first_assistant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").filter("role = 'assistant'").groupBy("conv_id").agg(F.min_by("text", "turn").alias("text"))


@query("SELECT user_id, event_id, event_type, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1")
def upsert_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.wins(table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value"), ["user_id"], [F.desc("event_id")])


@query("WITH g AS (SELECT l_suppkey, l_orderkey, l_linenumber FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber) = 1) SELECT s_suppkey, l_orderkey, l_linenumber FROM supplier LEFT JOIN g ON s_suppkey = l_suppkey")
def gold_join_first_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    gold = R.wins(table(spark, sf_dir, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber"), ["l_suppkey"], [F.col("l_orderkey"), F.col("l_linenumber")])
    return table(spark, sf_dir, "supplier").join(gold, F.col("s_suppkey") == F.col("l_suppkey"), "left").select("s_suppkey", "l_orderkey", "l_linenumber")


@query("SELECT o_orderstatus AS status, count(*) AS files, round(sum(o_totalprice), 2) AS seconds, round(sum(o_totalprice) / 3600 * 5, 4) AS cost FROM orders GROUP BY ALL")
def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.sum("o_totalprice")
    return table(spark, sf_dir, "orders").groupBy(F.col("o_orderstatus").alias("status")).agg(F.count("*").alias("files"), F.round(s, 2).alias("seconds"), F.round(s / 3600 * 5, 4).alias("cost"))


@query("WITH w AS (SELECT o_custkey, o_orderkey, row_number() OVER v AS rn, sum(o_totalprice) OVER (v ROWS UNBOUNDED PRECEDING) AS running FROM orders WINDOW v AS (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey)) SELECT o_custkey, o_orderkey, rn::INTEGER AS rn FROM w WHERE rn = 1 OR (running <= 500000 AND rn <= 5)")
def pack_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.next_batch(table(spark, sf_dir, "orders"), "o_custkey", "o_totalprice", "o_orderkey", 500_000.0, 5).select("o_custkey", "o_orderkey", "rn")


@query("""WITH l AS (SELECT 'in/' || o_orderkey || '.parquet' AS input_file, o_totalprice AS size_bytes FROM orders), m AS (SELECT 'in/' || o_orderkey || '.parquet' AS input_file, o_totalprice AS size_bytes, 1.0::DOUBLE AS est_seconds, 'assigned' AS status FROM orders WHERE o_orderstatus = 'F'),
 a AS (SELECT * FROM m UNION ALL SELECT input_file, size_bytes, size_bytes * 9e-7, 'pending' FROM l WHERE input_file NOT IN (SELECT input_file FROM m)), d AS (SELECT DISTINCT l_orderkey || '.parquet' AS base FROM lineitem WHERE l_linestatus = 'F')
 SELECT input_file, size_bytes, round(est_seconds, 6) AS est_seconds, CASE WHEN base IS NOT NULL THEN 'done' ELSE status END AS status FROM a LEFT JOIN d ON split_part(input_file, '/', 2) = base""")
def manifest_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(F.concat(F.lit("in/"), "o_orderkey", F.lit(".parquet")).alias("input_file"), F.col("o_totalprice").alias("size_bytes"), "o_orderstatus")
    old = orders.filter("o_orderstatus = 'F'").select("input_file", "size_bytes", F.lit(1.0).alias("est_seconds"), F.lit("assigned").alias("status"))
    merged = R.merge_manifest(old, orders)
    outputs = table(spark, sf_dir, "lineitem").filter("l_linestatus = 'F'").select(F.concat(F.lit("out/"), "l_orderkey", F.lit(".parquet")).alias("path"))
    return R.reconcile(merged, outputs).select("input_file", "size_bytes", F.round("est_seconds", 6).alias("est_seconds"), "status")


@query("""WITH a AS (SELECT l_orderkey, list(l_partkey ORDER BY l_linenumber, l_partkey) AS a FROM lineitem WHERE l_returnflag <> 'R' GROUP BY 1), b AS (SELECT l_orderkey, list(l_partkey ORDER BY l_linenumber, l_partkey) AS b FROM lineitem WHERE l_returnflag <> 'A' GROUP BY 1)
 SELECT l_orderkey, CASE WHEN b IS NULL THEN 'missing' WHEN a IS NULL THEN 'new' WHEN a = b THEN 'equal' ELSE 'changed' END AS verdict, CASE WHEN a IS NULL OR b IS NULL THEN 0 ELSE len(list_filter(list_distinct(a), lambda x: NOT list_contains(b, x))) END::INTEGER AS removed,
  CASE WHEN a IS NULL OR b IS NULL THEN 0 ELSE len(list_filter(list_distinct(b), lambda x: NOT list_contains(a, x))) END::INTEGER AS added FROM a FULL JOIN b USING (l_orderkey)""")
def prediction_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    def lists(flag: str) -> DataFrame:
        rows = table(spark, sf_dir, "lineitem").filter(F.col("l_returnflag") != flag)
        return rows.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey")))["l_partkey"].alias("xs"))

    return R.set_diff(lists("R"), lists("A"), "l_orderkey", "xs")


@query("SELECT doc_id, coalesce(quality, -1)::INTEGER AS gold, CASE WHEN quality IS NULL THEN 'ungraded' WHEN toxic = 1 THEN 'toxic' ELSE 'graded' END AS side FROM documents LEFT JOIN labels USING (doc_id)")
def doi_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = table(spark, sf_dir, "documents").select("doc_id").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    side = F.when(F.col("quality").isNull(), "ungraded").when(F.col("toxic") == 1, "toxic").otherwise("graded")
    return joined.select("doc_id", F.coalesce("quality", F.lit(-1)).alias("gold"), side.alias("side"))


@query("SELECT doc_id, CASE WHEN ('0x' || substr(md5(doc_id::VARCHAR), 1, 8))::BIGINT < 429496729 THEN 'test' ELSE 'train' END AS split FROM documents")
def id_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = F.conv(F.substring(F.md5(F.col("doc_id").cast("string")), 1, 8), 16, 10).cast("bigint")
    return table(spark, sf_dir, "documents").select("doc_id", F.when(h < 429496729, "test").otherwise("train").alias("split"))


@query()
def name_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation").select("n_name")
    pairs = n.select(F.col("n_name").alias("a")).crossJoin(n.select(F.col("n_name").alias("b")))
    return pairs.select("a", "b", *[F.round(S.similarity_udf(k)("a", "b"), 6).alias(k) for k in S.RATIOS])


@query()
def hungarian_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One-to-one matches of the names of nations of neighbouring regions."""

    def match(pdf: pd.DataFrame) -> pd.DataFrame:
        import numpy as np

        gold, said = (sorted(pdf.loc[pdf.side == s, "n_name"]) for s in ("gold", "said"))
        score = np.array([[S.token_sort_ratio(a.lower(), b.lower()) for b in said] for a in gold]).reshape(len(gold), len(said))
        return pd.DataFrame([(int(pdf.region.iloc[0]), gold[i], said[j], round(score[i, j], 6)) for i, j in S.assign(score, 0.2)], columns=["region", "gold", "said", "score"])

    n = table(spark, sf_dir, "nation")
    both = n.select(F.col("n_regionkey").cast("int").alias("region"), "n_name", F.lit("gold").alias("side")).unionByName(n.select(F.pmod(F.col("n_regionkey") + 1, F.lit(5)).cast("int").alias("region"), "n_name", F.lit("said").alias("side")))
    return both.groupBy("region").applyInPandas(match, "region int, gold string, said string, score double")
