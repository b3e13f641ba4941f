"""Queries of the scalar functions of records, of sources and sinks, of metrics, error analysis and the fleet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import sources
from ..functions import funders as J
from ..functions import similarity as S
from ..functions import text as T
from ..operators import entities as E
from ..operators import errors as X
from ..operators import fleet as K
from ..operators import relational as R
from .. import sinks
from .registry import PLACE, placed, query, table

# ---- scalar functions


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE (o_orderkey % 50) * CASE o_orderkey % 4 WHEN 1 THEN 60 WHEN 2 THEN 3600 ELSE 1 END END::BIGINT AS seconds FROM orders")
def retry_hint(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    log = F.when(k % 4 == 0, F.concat(F.lit("Retry after "), k % 50, F.lit(" minutes"))).when(k % 4 == 1, F.concat(F.lit("please retry this in about "), k % 50, F.lit(" minutes"))).when(k % 4 == 2, F.concat(F.lit("Retry in "), k % 50, F.lit(" hours."))).otherwise(F.concat(F.lit("retry in "), k % 50, F.lit(" second")))
    return table(spark, sf_dir, "orders").select("o_orderkey", T.retry_seconds(log).alias("seconds"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 > 0 THEN 'in/' || o_orderkey || '.parquet' END AS file, CASE WHEN o_orderkey % 3 > 0 THEN o_custkey END::BIGINT AS rows, CASE WHEN o_orderkey % 3 > 0 THEN (o_orderkey % 100) + 0.5 END::DOUBLE AS elapsed_s FROM orders")
def parse_done_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    line = F.when(k % 3 > 0, F.concat(F.lit("2024-01-01 INFO [done file=in/"), k, F.lit(".parquet rows="), "o_custkey", F.lit(" elapsed_s="), k % 100, F.lit(".5] ok"))).otherwise("nothing")
    return table(spark, sf_dir, "orders").select("o_orderkey", T.done_line(line).alias("d")).select("o_orderkey", "d.*")


@query("""SELECT o_orderkey, CASE o_orderkey % 4 WHEN 1 THEN (o_orderkey % 9 + 1)::INTEGER END AS open_start, CASE o_orderkey % 4 WHEN 0 THEN array_to_string(range(1, o_orderkey % 7 + 2), ',') WHEN 2 THEN array_to_string(list_sort(list_distinct(list_concat(range(o_orderkey % 9 + 1, o_orderkey % 9 + 4), [12, 3]))), ',') WHEN 3 THEN (o_orderkey % 30)::VARCHAR END AS pages FROM orders""")
def parse_page_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    text = F.when(k % 4 == 0, F.concat(F.lit("-"), k % 7 + 1)).when(k % 4 == 1, F.concat(F.lit("2, "), k % 9 + 1, F.lit("-,4"))).when(k % 4 == 2, F.concat(k % 9 + 1, F.lit("-"), k % 9 + 3, F.lit(",12, 3"))).otherwise((k % 30).cast("string"))
    return table(spark, sf_dir, "orders").select("o_orderkey", T.page_range(text).alias("r")).select("o_orderkey", "r.open_start", F.array_join("r.pages", ",").alias("pages"))


@query("SELECT p_partkey, 'team/fund-' || lower(replace(p_name, ' ', '_')) || '-grpo-step' || p_size AS repo FROM part")
def build_repo_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = F.concat(F.lit("Org/Sub/"), F.replace(F.upper("p_name"), F.lit(" "), F.lit("_")))
    return table(spark, sf_dir, "part").select("p_partkey", T.repo_id(F.lit("team/fund"), model, F.col("p_size").cast("string")).alias("repo"))


_NAME = "(CASE p_partkey % 3 WHEN 0 THEN p_name || ' (' || upper(substr(p_brand, 1, 5)) || ')' WHEN 1 THEN p_name || '/' || p_name || ', Council' ELSE p_name || ' (not one)' END)"


def _names(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey") % 3
    name = F.when(k == 0, F.concat("p_name", F.lit(" ("), F.upper(F.substring("p_brand", 1, 5)), F.lit(")"))).when(k == 1, F.concat("p_name", F.lit("/"), "p_name", F.lit(", Council"))).otherwise(F.concat("p_name", F.lit(" (not one)")))
    return table(spark, sf_dir, "part").select("p_partkey", "p_name", name.alias("name"))


@query(rf"WITH n AS (SELECT p_partkey, p_name, {_NAME} AS name FROM part), t AS (SELECT *, list_filter(list_transform(regexp_extract_all(name, '\(([^)]+)\)', 1), lambda m: trim(m)), lambda m: length(m) <= 10 AND upper(m) = m AND lower(m) <> m) AS acr, list_distinct(list_filter(string_split_regex(lower(p_name), '[\s,/-]+'), lambda t: t <> '')) AS a, list_distinct(list_filter(string_split_regex(lower(name), '[\s,/-]+'), lambda t: t <> '')) AS b FROM n) SELECT p_partkey, array_to_string(acr, ',') AS acronyms, len(b)::INTEGER AS tokens, len(list_intersect(a, b)) / len(a) AS contained FROM t")
def name_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = _names(spark, sf_dir)
    return n.select("p_partkey", F.array_join(T.acronyms(F.col("name")), ",").alias("acronyms"), F.size(T.name_tokens(F.col("name"))).alias("tokens"), T.containment(F.col("p_name"), F.col("name")).alias("contained"))


@query(r"SELECT doc_id, lower(trim(regexp_replace(trim(regexp_replace(regexp_replace(regexp_replace(replace(text, 'the ', '\the '), '[‘’]', '''', 'g'), '[“”]', '\"', 'g'), '\s+', ' ', 'g')), '\\([a-z])', '\1', 'g'))) AS text FROM (SELECT doc_id, regexp_replace(regexp_replace(text, '``|''''', '\"', 'g'), '[*•⋆]', '', 'g') AS text FROM documents)".replace('\\"', '"'))
def normalize_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", T.normalize_for_errors(F.replace("text", F.lit("the "), F.lit("\\the "))).alias("text"))


@query(r"SELECT page_id, trim(regexp_replace(trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(coalesce(html, ''), '[‘’]', '''', 'g'), '``|''''', chr(34), 'g'), '[*•⋆]', '', 'g'), '\s+', ' ', 'g')), '\\([a-z])', '\1', 'g')) AS text FROM pages")
def normalize_statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", T.normalize_text(F.col("html"), fix_double_quotes=False).alias("text"))


@query()
def normalize_funding(spark: SparkSession, sf_dir: str) -> DataFrame:
    broken = F.regexp_replace(F.replace("text", F.lit("e"), F.lit("e´ ")), r"\.", " 7\n8\n9\n")
    return table(spark, sf_dir, "documents").select("doc_id", T.normalize_funding_statement(broken).alias("text"))


@query("SELECT doc_id, doc_id % 4 = 1 AS open_thinking, CASE WHEN length(text) > 2000 THEN 'InputTooLong: ' || length(text) || ' chars > 2000' END AS error, CASE WHEN doc_id % 5 = 0 THEN 'clean' WHEN doc_id % 5 = 1 THEN 'clean_relocated' WHEN doc_id % 5 = 2 THEN 'unknown' ELSE 'tier' || doc_id % 5 END AS bucket FROM documents")
def row_guards(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("doc_id")
    said = F.when(k % 4 == 1, "<think> so").when(k % 4 == 2, "<think> so </think> []").otherwise("[]")
    tier, cats = F.when(k % 5 > 2, F.concat(F.lit("tier"), k % 5)), F.when(k % 5 == 1, F.array(F.lit("clean_relocated"))).otherwise(F.array(F.lit("other")))
    return table(spark, sf_dir, "documents").select("doc_id", T.open_thinking(said).alias("open_thinking"), T.over_long(F.col("text"), 2000).alias("error"), T.bucket(tier, k % 5 > 0, cats).alias("bucket"))


# ---- funders of records: built from orders, so that gold and prediction differ in every way


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doi, funders, predicted_funders) of each order: a funder for each part of its lines, its supplier the award; returned lines are gold's alone, accepted ones predicted alone."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag")
    parts = table(spark, sf_dir, "part").select("p_partkey", F.when(F.col("p_partkey") % 10 > 0, F.col("p_name")).alias("name"))
    named = lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
    none = F.array().cast("array<string>")
    # lines are collected once and flat; funders are made of them after the shuffle
    line = F.struct("l_linenumber", "name", F.concat(F.lit("AB-"), F.format_string("%06d", F.col("l_suppkey"))).alias("id"), (F.col("l_suppkey") % 3 == 0).alias("scheme"), F.col("l_returnflag").alias("flag"))
    award = lambda x: F.struct(F.array(x["id"]).alias("award_ids"), F.when(x["scheme"], F.array(F.lit("Starting Grant"))).otherwise(none).alias("funding_scheme"), none.alias("award_title"))
    side = lambda flag: F.transform(F.filter("ls", lambda x: x["flag"] != flag), lambda x: F.struct(x["name"].alias("funder_name"), F.array(award(x)).alias("awards")))
    one = named.groupBy(F.col("l_orderkey").alias("doi")).agg(F.array_sort(F.collect_list(line)).alias("ls"))
    return one.select("doi", side("A").alias("funders"), side("R").alias("predicted_funders"))


_FLAT = """lines AS (SELECT l_orderkey AS doi, l_linenumber, CASE WHEN l_partkey % 10 > 0 THEN p_name END AS name, 'AB-' || printf('%06d', l_suppkey) AS id, CASE WHEN l_suppkey % 3 = 0 THEN 'Starting Grant' END AS scheme, l_returnflag AS flag FROM lineitem JOIN part ON l_partkey = p_partkey),
 gold AS (SELECT doi, coalesce(lower(name), '__NULL__') AS funder, id, scheme FROM lines WHERE flag <> 'A'), said AS (SELECT doi, coalesce(lower(name), '__NULL__') AS funder, id, scheme FROM lines WHERE flag <> 'R'), dois AS (SELECT DISTINCT doi FROM lines)"""
_ERRORS = _FLAT + """, counts AS (SELECT coalesce(a.doi, b.doi) AS doi, coalesce(a.funder, b.funder) AS funder, coalesce(g, 0) AS g, coalesce(p, 0) AS p FROM (SELECT doi, funder, count(*) AS g FROM gold GROUP BY ALL) a FULL JOIN (SELECT doi, funder, count(*) AS p FROM said GROUP BY ALL) b ON a.doi = b.doi AND a.funder = b.funder),
 both_ AS (SELECT doi, funder FROM counts WHERE g > 0 AND p > 0),
 gv AS (SELECT DISTINCT doi, funder, 'award_ids' AS field, 'award_id' AS name, lower(id) AS value FROM gold UNION SELECT DISTINCT doi, funder, 'funding_scheme', 'scheme', lower(scheme) FROM gold WHERE scheme IS NOT NULL),
 pv AS (SELECT DISTINCT doi, funder, 'award_ids' AS field, 'award_id' AS name, lower(id) AS value FROM said UNION SELECT DISTINCT doi, funder, 'funding_scheme', 'scheme', lower(scheme) FROM said WHERE scheme IS NOT NULL),
 errs AS (
  SELECT doi, 'missing_funder' AS error_type, 'funder_name' AS field, funder AS gold_value, '' AS pred_value, funder FROM counts WHERE p = 0 AND funder <> '__NULL__'
  UNION ALL SELECT doi, 'extra_funder', 'funder_name', '', funder, funder FROM counts WHERE g = 0 AND funder <> '__NULL__'
  UNION ALL SELECT doi, 'missing_' || name, field, value, '', funder FROM gv SEMI JOIN both_ USING (doi, funder) WHERE NOT EXISTS (SELECT 1 FROM pv WHERE pv.doi = gv.doi AND pv.funder = gv.funder AND pv.field = gv.field AND pv.value = gv.value)
  UNION ALL SELECT doi, 'extra_' || name, field, '', value, funder FROM pv SEMI JOIN both_ USING (doi, funder) WHERE NOT EXISTS (SELECT 1 FROM gv WHERE pv.doi = gv.doi AND pv.funder = gv.funder AND pv.field = gv.field AND pv.value = gv.value)
  UNION ALL SELECT doi, 'award_count_mismatch', 'awards', g::VARCHAR, p::VARCHAR, funder FROM counts WHERE g > 0 AND p > 0 AND g <> p
  UNION ALL SELECT doi, 'null_funder_count_mismatch', 'funder_name', g || ' null funders', p || ' null funders', NULL FROM counts WHERE funder = '__NULL__' AND g <> p
  UNION ALL SELECT doi, 'funder_count_mismatch', 'funders', sum(g)::BIGINT::VARCHAR, sum(p)::BIGINT::VARCHAR, NULL FROM counts GROUP BY doi HAVING sum(g) <> sum(p))"""


@query(f"WITH {_ERRORS} SELECT doi, error_type, field, gold_value, pred_value, CASE WHEN funder = '__NULL__' THEN '(null funder)' ELSE funder END AS funder FROM errs")
def record_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.compare_exact(_records(spark, sf_dir))


@query(f"WITH {_ERRORS}, t AS (SELECT count(*) AS total FROM errs) SELECT CASE WHEN error_type LIKE 'missing%' THEN 'missing' WHEN error_type LIKE 'extra%' THEN 'extra' ELSE 'mismatch' END AS kind, error_type, field, count(*) AS n, count(DISTINCT doi) AS documents, round(100.0::DOUBLE * count(*) / any_value(total), 4) AS percent FROM errs, t GROUP BY ALL")
def error_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.type_summary(X.compare_exact(_records(spark, sf_dir)))


@query(f"WITH {_ERRORS}, e AS (SELECT doi, count(*) AS n, array_to_string(list_sort(list_distinct(list(error_type))), ';') AS types FROM errs GROUP BY doi) SELECT doi, coalesce(n, 0) AS error_count, coalesce(types, '') AS error_types FROM dois LEFT JOIN e USING (doi)")
def error_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _records(spark, sf_dir)
    return X.document_summary(r, X.compare_exact(r)).withColumn("error_types", F.array_join("error_types", ";"))


_LIST = lambda t, v, n: f"array_to_string(list_sort(list({v}) FILTER (error_type = '{t}')), '; ') AS {n}"


@query(f"WITH {_ERRORS}, e AS (SELECT doi, count(*) AS n, {_LIST('missing_funder', 'gold_value', 'missing_funders')}, {_LIST('extra_funder', 'pred_value', 'extra_funders')}, {_LIST('missing_award_id', 'gold_value', 'missing_award_ids')}, {_LIST('extra_award_id', 'pred_value', 'extra_award_ids')}, {_LIST('missing_scheme', 'gold_value', 'missing_schemes')}, {_LIST('extra_scheme', 'pred_value', 'extra_schemes')} FROM errs GROUP BY doi) SELECT doi, coalesce(n, 0) AS error_count, coalesce(missing_funders, '') AS missing_funders, coalesce(extra_funders, '') AS extra_funders, coalesce(missing_award_ids, '') AS missing_award_ids, coalesce(extra_award_ids, '') AS extra_award_ids, coalesce(missing_schemes, '') AS missing_schemes, coalesce(extra_schemes, '') AS extra_schemes, '' AS missing_award_titles, '' AS extra_award_titles FROM dois LEFT JOIN e USING (doi)")
def error_side_by_side(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _records(spark, sf_dir)
    return X.side_by_side(r, X.compare_exact(r)).drop("error_types")


@query(f"WITH {_ERRORS} SELECT count(*) AS documents, count(*) FILTER (doi NOT IN (SELECT doi FROM errs)) AS perfect FROM dois")
def error_perfect(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _records(spark, sf_dir)
    return X.perfect_count(r, X.compare_exact(r))


@query()
def record_errors_fuzzy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.compare_fuzzy(_records(spark, sf_dir))


@query(f"WITH {_FLAT} SELECT doi, CASE WHEN funder = '__NULL__' THEN NULL ELSE funder END AS funder, id AS award_id, coalesce(scheme, '') AS scheme FROM gold")
def flatten_awards(spark: SparkSession, sf_dir: str) -> DataFrame:
    each = _records(spark, sf_dir).select("doi", F.explode(J.flat_awards(F.col("funders"))).alias("a"))
    return each.select("doi", F.lower("a.funder_name").alias("funder"), F.array_join("a.award_ids", ",").alias("award_id"), F.array_join("a.funding_scheme", ",").alias("scheme"))


@query(f"WITH {_FLAT}, m AS (SELECT doi, funder, list_sort(list(id)) AS ids FROM gold GROUP BY ALL) SELECT doi, funder, len(ids) AS n, array_to_string(ids, ',') AS ids FROM m")
def awards_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    each = X._awards(_records(spark, sf_dir), "funders")
    one = each.groupBy("doi", "funder").agg(F.array_sort(F.flatten(F.collect_list("award_ids"))).alias("ids"))
    return one.select("doi", "funder", F.size("ids").cast("bigint").alias("n"), F.array_join("ids", ",").alias("ids"))


@query(f"WITH {_FLAT}, g AS (SELECT DISTINCT doi, funder, id, coalesce(scheme, '') AS s FROM gold), p AS (SELECT DISTINCT doi, funder, id, coalesce(scheme, '') AS s FROM said), n AS (SELECT doi, (SELECT count(*) FROM g WHERE g.doi = d.doi) AS a, (SELECT count(*) FROM p WHERE p.doi = d.doi) AS b, (SELECT count(*) FROM g JOIN p USING (doi, funder, id, s) WHERE doi = d.doi) AS c FROM dois d) SELECT doi, a, b, c, round(CASE WHEN a + b = 0 THEN 1.0 WHEN c = 0 THEN 0.0 ELSE 2.0 * c / (a + b) END, 6)::DOUBLE AS f1 FROM n")
def set_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    none = F.array().cast("array<string>")
    key = lambda c: F.array_distinct(F.transform(J.flat_awards(F.coalesce(F.col(c), F.array().cast(J.FUNDERS))), lambda a: F.concat_ws("|", F.lower(F.coalesce(a["funder_name"], F.lit("__NULL__"))), F.array_join(a["award_ids"], ","), F.array_join(F.coalesce(a["funding_scheme"], none), ","))))
    sets = _records(spark, sf_dir).select("doi", key("funders").alias("g"), key("predicted_funders").alias("p"))
    a, b, c = (F.size(x).cast("bigint") for x in ("g", "p", F.array_intersect("g", "p")))
    return sets.select("doi", a.alias("a"), b.alias("b"), c.alias("c")).withColumn("f1", F.round(F.when(F.col("a") + F.col("b") == 0, 1.0).when(F.col("c") == 0, 0.0).otherwise(2.0 * F.col("c") / (F.col("a") + F.col("b"))), 6))


@query()
def entity_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.entity_counts(_records(spark, sf_dir)).drop("funders", "predicted_funders")


@query()
def entity_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.micro_average(E.entity_counts(_records(spark, sf_dir), "strict"))


@query()
def similarity_deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.similarity_deltas(_records(spark, sf_dir), ("balanced", "strict"))


@query()
def rewards(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _records(spark, sf_dir)
    one = E.rewards(r).select(*r.columns, F.col("reward").alias("one"), F.col("association_gap").alias("gap"))
    return E.rewards(one, True).select("doi", F.col("one").alias("reward"), F.col("gap").alias("association_gap"), F.col("reward").alias("shaped"))


@query()
def funder_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions as a model writes them: plain, fenced, wrapped, single or broken."""
    k, j = F.col("doi") % 5, F.to_json("predicted_funders")
    raw = F.when(k == 0, j).when(k == 1, F.concat(F.lit("```json\n"), j, F.lit("\n```"))).when(k == 2, F.concat(F.lit('{"funders": '), j, F.lit("}"))).when(k == 3, F.concat(F.lit("Here: "), j)).otherwise(F.to_json(F.get("predicted_funders", F.lit(0))))
    rows = _records(spark, sf_dir).select("doi", raw.alias("raw"))
    return rows.select("doi", J.strict_funders(F.col("raw")).alias("s"), J.lenient_funders(F.col("raw")).alias("l")).select("doi", F.size("s.funders").alias("strict"), "s.error", F.size("l").alias("lenient"))


@query("SELECT conv_id, turn, '[{\"role\":\"system\",\"content\":\"Extract.\"},{\"role\":\"user\",\"content\":' || to_json(text) || '}]' AS messages FROM conversations")
def chat_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", F.to_json(J.messages("Extract.", F.col("text"))).alias("messages"))


# ---- statements against gold


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, lang, gold, predicted): a document's first sentences, and those of it that survive a cut."""
    parts = F.filter(F.slice(F.split("text", r"\.\s+"), 1, 3), lambda s: F.length(s).between(10, 120))
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", parts.alias("gold"))
    return docs.withColumn("predicted", F.transform(F.filter("gold", lambda s, i: (i + F.col("doc_id")) % 3 > 0), lambda s: F.when(F.length(s) % 2 == 0, F.substring(s, 4, 200)).otherwise(s)))


@query()
def statement_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.statement_metrics(E.statement_scores(_pairs(spark, sf_dir), least=0.75), 0.75, by="lang")


@query("WITH k AS (SELECT DISTINCT 'in/' || doc_id || '.md' AS name FROM labels) SELECT doc_id FROM documents WHERE 'in/' || doc_id || '.md' IN (SELECT name FROM k)")
def known_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.concat(F.lit("in/"), "doc_id", F.lit(".md"))
    return E.keep_known(table(spark, sf_dir, "documents").select("doc_id"), table(spark, sf_dir, "labels"), T.canonical_filename(path), T.canonical_filename(path))[0]


@query("WITH g AS (SELECT lower(trim(' K' || l_suppkey || ' ')) AS k, arg_max(l_partkey, (l_orderkey, l_linenumber)) AS part FROM lineitem GROUP BY 1) SELECT s_suppkey, part FROM supplier LEFT JOIN g ON 'k' || s_suppkey = k")
def gold_join_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    gold = placed(spark, sf_dir, "lineitem").select(F.concat(F.lit(" K"), "l_suppkey", F.lit(" ")).alias("key"), F.col("l_partkey").alias("part"), "l_orderkey", "l_linenumber", *PLACE)
    said = table(spark, sf_dir, "supplier").select("s_suppkey", F.concat(F.lit("k"), "s_suppkey").alias("key"))
    return E.join_gold(said, gold, "key", ["l_orderkey", "l_linenumber"], last=True, fold=True, ties=PLACE).select("s_suppkey", "part")


@query("SELECT CASE WHEN d IS NULL THEN 'gold_only' WHEN g IS NULL THEN 'predicted_only' ELSE 'both' END AS side, count(*) AS n FROM (SELECT doc_id AS d FROM documents WHERE doc_id % 3 > 0) FULL JOIN (SELECT DISTINCT doc_id AS g FROM labels) ON d = g GROUP BY 1")
def doi_sides(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.coverage(table(spark, sf_dir, "documents").filter("doc_id % 3 > 0"), table(spark, sf_dir, "labels"), "doc_id")


# ---- metrics and summaries


@query("SELECT event_type, round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.95), 6) AS p95, round(quantile_cont(value, 0.99), 6) AS p99, round(list_sort(list(value))[(floor(0.95 * (count(value) - 1)) + 1)::INT], 6) AS floor_p95 FROM events GROUP BY event_type")
def latency_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    exact = e.groupBy("event_type").agg(*[F.round(F.percentile("value", q), 6).alias(n) for n, q in (("p50", 0.5), ("p95", 0.95), ("p99", 0.99))])
    return exact.join(R.floor_percentile(e, "event_type", "value", 0.95, "floor_p95").withColumn("floor_p95", F.round("floor_p95", 6)), "event_type")


@query("WITH p AS (SELECT event_type, count(value) AS n, sum(value) AS total, avg(value) AS mean, quantile_cont(value, 0.5) AS median, list_sort(list(value))[(floor(0.95 * (count(value) - 1)) + 1)::INT] AS p95 FROM events GROUP BY 1) SELECT event_type, n, round(total, 4) AS total, round(mean, 6) AS mean, round(median, 6) AS median, round(p95, 6) AS p95, round(100 * total / sum(total) OVER (), 6) AS percent FROM p")
def phase_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = R.phase_summary(table(spark, sf_dir, "events"), "event_type", "value")
    return got.select("event_type", "n", F.round("total", 4).alias("total"), *[F.round(c, 6).alias(c) for c in ("mean", "median", "p95", "percent")])


@query("""WITH e AS (SELECT event_type, event_id, value, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS rn, event_id > min(event_id) OVER () AS warm FROM events),
 b AS (SELECT event_type, count(*) AS docs, avg(value) FILTER (rn > 1) AS mean, quantile_cont(value, 0.5) FILTER (rn > 1) AS p50, quantile_cont(value, 0.95) FILTER (rn > 1) AS p95, quantile_cont(value, 0.99) FILTER (rn > 1) AS p99, count(*) / sum(value) AS rate FROM e GROUP BY 1
 UNION ALL SELECT 'overall', count(*), avg(value) FILTER (warm), quantile_cont(value, 0.5) FILTER (warm), quantile_cont(value, 0.95) FILTER (warm), quantile_cont(value, 0.99) FILTER (warm), count(*) / 100.0 FROM e) SELECT event_type, docs, round(mean, 6) AS mean, round(p50, 6) AS p50, round(p95, 6) AS p95, round(p99, 6) AS p99, round(rate, 6)::DOUBLE AS docs_per_second FROM b""")
def run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = R.run_metrics(table(spark, sf_dir, "events"), "event_type", "event_id", "value", 100.0)
    return got.select("event_type", "docs", *[F.round(c, 6).alias(c) for c in ("mean", "p50", "p95", "p99", "docs_per_second")])


@query("WITH c AS (SELECT event_id AS step FROM events WHERE event_id % 50 = 0), v AS (SELECT event_id AS step, value AS metric FROM events WHERE event_id % 7 = 0), b AS (SELECT c.step, max(metric) AS best FROM c LEFT JOIN v ON v.step <= c.step GROUP BY 1) SELECT step, best, step = (SELECT step FROM b ORDER BY best DESC NULLS LAST, step LIMIT 1) AS chosen FROM b")
def best_checkpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return R.checkpoint_scores(e.filter("event_id % 50 = 0").select(F.col("event_id").alias("step")), e.filter("event_id % 7 = 0").select(F.col("event_id").alias("step"), F.col("value").alias("metric")), "step", "metric")


@query("WITH r AS (SELECT doc_id, len(regexp_extract_all(text, 'the ')) AS n FROM documents) SELECT count(*) AS files, count(*) FILTER (n > 0) AS files_with_funding, sum(n)::BIGINT AS statements FROM r")
def result_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.result_summary(table(spark, sf_dir, "documents").select("doc_id", F.regexp_count("text", F.lit("the ")).cast("bigint").alias("n_statements")))


@query("SELECT event_type, count(*) AS n, count(*) FILTER (value > 10) AS parsed, round(count(*) FILTER (value > 10) / count(*), 6) AS parse_rate, round(avg(value), 6) AS mean_tokens, max(value) AS most_tokens FROM events GROUP BY 1")
def inference_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    ok = F.count_if(F.col("value") > 10)
    return table(spark, sf_dir, "events").groupBy("event_type").agg(F.count("*").alias("n"), ok.alias("parsed"), F.round(ok / F.count("*"), 6).alias("parse_rate"), F.round(F.avg("value"), 6).alias("mean_tokens"), F.max("value").alias("most_tokens"))


@query("SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def most_common(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.most_common(table(spark, sf_dir, "events"), "event_type", "event_id")


# ---- sets, positions, splits


@query("SELECT doc_id, text, lang, NULL::VARCHAR AS html FROM documents UNION ALL SELECT page_id, NULL, NULL, html FROM pages")
def union_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.union_all([table(spark, sf_dir, "documents").select("doc_id", "text", "lang"), table(spark, sf_dir, "pages").select(F.col("page_id").cast("int").alias("doc_id"), "html")])


@query("WITH a AS (SELECT doc_id FROM documents WHERE doc_id % 2 = 0), b AS (SELECT doc_id FROM labels) SELECT (SELECT count(*) FROM (SELECT * FROM a INTERSECT SELECT * FROM b)) AS common, (SELECT count(*) FROM (SELECT * FROM a UNION SELECT * FROM b)) AS either")
def id_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = table(spark, sf_dir, "documents").filter("doc_id % 2 = 0").select("doc_id"), table(spark, sf_dir, "labels").select("doc_id")
    return a.intersect(b).agg(F.count("*").alias("common")).crossJoin(a.union(b).distinct().agg(F.count("*").alias("either")))


@query("SELECT conv_id, len(list_distinct(list(lower(trim(role))))) AS roles, array_to_string(list_sort(list_distinct(list(lower(trim(role))))), ',') AS names FROM conversations GROUP BY 1")
def normalized_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_set(F.lower(F.trim("role")))).alias("r"))
    return one.select("conv_id", F.size("r").cast("bigint").alias("roles"), F.array_join("r", ",").alias("names"))


@query("SELECT doc_id, printf('shard-%05d', (row_number() OVER (ORDER BY source, doc_id) - 1) // 100) AS shard FROM documents")
def global_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sinks.sharded(table(spark, sf_dir, "documents").select("source", "doc_id"), ["source", "doc_id"], 100).select("doc_id", "shard")


@query("WITH n AS (SELECT doc_id, row_number() OVER (ORDER BY lang, doc_id) - 1 AS i FROM (SELECT * FROM documents WHERE doc_id % 4 > 0 ORDER BY lang, doc_id LIMIT 500)) SELECT doc_id FROM n WHERE floor(i / ceil((SELECT count(*) FROM n) / 3.0)) = 1")
def contiguous_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sources.benchmark_sample(table(spark, sf_dir, "documents").select("doc_id", "lang"), ["lang", "doc_id"], F.col("doc_id") % 4 == 0, 500, 1, 3).select("doc_id")


@query("WITH h AS (SELECT doc_id, row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id) - 1 AS i, count(*) OVER () AS n FROM documents) SELECT doc_id, CASE WHEN i < floor(n * 0.7::DOUBLE) THEN 'sft' WHEN i < floor(n * 0.7::DOUBLE) + floor(n * 0.2::DOUBLE) THEN 'rl' ELSE 'rl_eval' END AS split FROM h")
def id_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.split_by_id(table(spark, sf_dir, "documents").select("doc_id"), "doc_id", (("sft", 0.7), ("rl", 0.2)), "rl_eval")


@query("SELECT doc_id FROM documents ORDER BY md5('7:' || doc_id), doc_id LIMIT 100")
def seeded_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sources.seeded_sample(table(spark, sf_dir, "documents").select("doc_id"), "doc_id", 100, 7)


@query("SELECT doc_id, unnest([1, 2]) AS k, lang FROM documents WHERE doc_id % 3 = 0 UNION ALL SELECT doc_id, 0, lang FROM documents WHERE doc_id % 3 = 1")
def upsampled(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", "lang")
    real = d.filter("doc_id % 3 = 0").withColumn("k", F.explode(F.array(F.lit(1), F.lit(2))))
    return R.upsampled(real, d.filter("doc_id % 3 = 1").withColumn("k", F.lit(0)), 1).select("doc_id", "k", "lang")


# ---- sources


@query(r"SELECT doc_id::VARCHAR AS document_id, regexp_replace(text, '^\s+|\s+$', '', 'g') AS content FROM documents WHERE regexp_replace(text, '^\s+|\s+$', '', 'g') <> ''")
def parquet_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sources.parquet_documents(spark, f"{sf_dir}/documents.parquet").select("document_id", "content")


@query("SELECT count(*) AS seen, count(*) FILTER (lang <> 'en') AS not_ok, count(*) FILTER (lang = 'en' AND n_chars % 7 = 0) AS empty FROM documents")
def skip_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select(F.when(F.col("lang") == "en", "ok").otherwise("bad").alias("status"), F.when(F.col("n_chars") % 7 == 0, "").otherwise(F.col("text")).alias("text"))
    return sources.skip_counts(d)


@query("SELECT doc_id::VARCHAR AS doc_key FROM documents WHERE lang = 'en' AND n_chars % 7 > 0 AND doc_id > 0")
def usable_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").filter("doc_id > 0").select(F.col("doc_id").alias("id"), F.when(F.col("lang") == "en", "ok").otherwise("bad").alias("status"), F.when(F.col("n_chars") % 7 == 0, "").otherwise(F.col("text")).alias("text"))
    return sources.usable_rows(d).select("doc_key")


@query("SELECT conv_id FROM conversations GROUP BY conv_id HAVING count(*) FILTER (role = 'user') > 0 AND sum(length(text)) FILTER (role = 'user') <= 600")
def funded_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = F.collect_list(F.when(F.col("role") == "user", F.col("text")))
    return table(spark, sf_dir, "conversations").groupBy("conv_id").agg(said.alias("predicted_statements")).filter(sources.funded(most=600)).select("conv_id")


@query("SELECT conv_id, arg_min(text, turn) FILTER (role = 'assistant') AS said FROM conversations GROUP BY conv_id HAVING count(*) FILTER (role = 'assistant') = 0 OR NOT json_valid(arg_min(text, turn) FILTER (role = 'assistant'))")
def rollout_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", F.col("text").alias("content")))).alias("m"))
    chat = rows.select(F.col("conv_id").alias("line"), F.concat(F.lit("d"), "conv_id").alias("doi"), F.transform("m", lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content"))).alias("messages"))
    bad = sources.rollouts(chat)[1]
    first = table(spark, sf_dir, "conversations").filter("role = 'assistant'").groupBy("conv_id").agg(F.min_by("text", "turn").alias("said"))
    return bad.select(F.col("line").alias("conv_id")).join(first, "conv_id", "left")


@query("SELECT l_suppkey, arg_min(l_partkey, (l_orderkey, l_linenumber)) AS l_partkey, count(*) - 1 AS duplicates FROM lineitem GROUP BY 1")
def gold_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = placed(spark, sf_dir, "lineitem").select("l_suppkey", "l_partkey", "l_orderkey", "l_linenumber", *PLACE)
    return sources.gold_lookup(rows, "l_suppkey", ("l_orderkey", "l_linenumber", *PLACE)).select("l_suppkey", "l_partkey", "duplicates")


# ---- the fleet


def _manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = F.col("o_orderkey")
    status = F.when(o % 5 == 0, "pending").when(o % 5 == 4, "done").otherwise("assigned")
    return table(spark, sf_dir, "orders").select(F.concat(F.lit("in/2024/"), o, F.lit(".parquet")).alias("input_file"), F.col("o_totalprice").alias("size_bytes"), status.alias("status"), F.concat(F.lit("j"), o % 7).alias("job_id"), (o % 3).cast("int").alias("attempts"), F.lit(None).cast("bigint").alias("rows"), F.lit(None).cast("double").alias("elapsed_s"), F.lit(None).cast("string").alias("output_path"), F.lit(None).cast("string").alias("error"))


_MANIFEST = "m AS (SELECT o_orderkey AS o, 'in/2024/' || o_orderkey || '.parquet' AS input_file, CASE o_orderkey % 5 WHEN 0 THEN 'pending' WHEN 4 THEN 'done' ELSE 'assigned' END AS status, 'j' || o_orderkey % 7 AS job_id, (o_orderkey % 3)::INTEGER AS attempts FROM orders)"


@query(f"WITH {_MANIFEST} SELECT input_file, CASE WHEN status = 'assigned' AND o % 2 = 0 AND o % 7 < 5 THEN 'done' ELSE status END AS status, CASE WHEN status = 'assigned' AND o % 2 = 0 AND o % 7 < 5 THEN 3::BIGINT END AS rows, CASE WHEN status = 'assigned' AND o % 2 = 0 AND o % 7 < 5 THEN 'predictions/2024/' || o || '.parquet' END AS output_path FROM m")
def fleet_done(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = _manifest(spark, sf_dir)
    job = F.when(F.substring("job_id", 2, 1).cast("int") < 5, F.col("job_id")).otherwise("other")
    number = F.regexp_extract("input_file", r"(\d+)\.parquet", 1).cast("bigint")
    logs = m.filter(number % 2 == 0).select(job.alias("job_id"), F.lit(1).alias("ts"), F.concat(F.lit("[done file="), "input_file", F.lit(" rows=3 elapsed_s=2.0]")).alias("line"))
    return K.apply_done(m, K.done_events(logs)).select("input_file", "status", "rows", "output_path")


@query(f"WITH {_MANIFEST}, r AS (SELECT *, CASE o % 7 WHEN 0 THEN 'ERROR' WHEN 1 THEN 'RUNNING' WHEN 2 THEN 'RUNNING' WHEN 3 THEN 'SCHEDULING' WHEN 4 THEN 'COMPLETED' END AS stage, CASE o % 7 WHEN 2 THEN 'silent-stuck' WHEN 3 THEN 'sched-stuck' END AS reason FROM m), h AS (SELECT *, status = 'assigned' AND stage IS NOT NULL AND (reason IS NOT NULL OR stage IN ('ERROR', 'COMPLETED')) AS hit, attempts + CASE WHEN reason IS NULL THEN 1 ELSE 0 END AS tried FROM r) SELECT input_file, CASE WHEN hit THEN CASE WHEN reason IS NULL AND tried >= 3 THEN 'failed' ELSE 'pending' END ELSE status END AS status, (CASE WHEN hit THEN tried ELSE attempts END)::INTEGER AS attempts, CASE WHEN hit THEN CASE WHEN reason IS NOT NULL THEN 'job ' || job_id || ' cancelled (infra: ' || reason || ')' ELSE 'job ' || job_id || ' stage=' || stage END END AS error FROM h")
def fleet_release(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = [("j0", "ERROR", 0, 0), ("j1", "RUNNING", 3000, 0), ("j2", "RUNNING", 100, 0), ("j3", "SCHEDULING", 3000, 100), ("j4", "COMPLETED", 0, 0)]
    jobs = spark.createDataFrame(rows, "job_id string, stage string, last_log int, submitted int")
    return K.release(_manifest(spark, sf_dir), K.stuck(jobs, F.lit(3100), 30)).select("input_file", "status", "attempts", "error")


@query("WITH w AS (SELECT l_orderkey, l_partkey % 2 AS col, list(l_linenumber ORDER BY l_linenumber) AS v FROM lineitem GROUP BY ALL) SELECT l_orderkey, col FROM w WHERE len(v) >= 3 AND len(list_distinct(v)) = len(v) AND (v[len(v)] - v[1]) / (len(v) - 1) <= 1.5 AND len(v) / (v[len(v)] - v[1] + 1) >= 0.7")
def number_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = table(spark, sf_dir, "lineitem").select("l_orderkey", (F.col("l_partkey") % 2).alias("col"), "l_linenumber")
    return K.valid_number_columns(words, ["l_orderkey", "col"], "l_linenumber", "l_linenumber", 3)


@query("WITH h AS (SELECT l_suppkey AS file, 'text ' || l_partkey % 5 AS text, l_linenumber AS page FROM lineitem), p AS (SELECT l_suppkey AS file, count(DISTINCT l_linenumber) * 6 AS page_count FROM lineitem GROUP BY 1) SELECT file, text, count(DISTINCT page) AS pages FROM h JOIN p USING (file) GROUP BY file, text, page_count HAVING count(DISTINCT page) >= greatest(2, floor(page_count * 0.1))")
def repeating_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("file"), F.concat(F.lit("text "), F.col("l_partkey") % 5).alias("text"), F.col("l_linenumber").alias("page"))
    return K.repeating_headers(lines, lines.groupBy("file").agg((F.countDistinct("page") * 6).alias("page_count")))


@query()
def header_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").filter("l_suppkey <= 20").join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return K.clustered_headers(lines.select(F.col("l_suppkey").cast("string").alias("file"), F.col("l_linenumber").alias("page"), F.col("p_name").alias("text")))


@query()
def name_similarities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each part's name against its written-out form, under every similarity."""
    n = _names(spark, sf_dir)
    return n.select("p_partkey", *[F.round(S.similarity_udf(f)("p_name", "name"), 6).alias(k) for k, f in S.SIMILARITIES.items()])
