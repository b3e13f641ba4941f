"""Queries of the text mending functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import healing as H
from .registry import WORKS, query, table, works

_STRIP = lambda c: rf"regexp_replace({c}, '^\s+|\s+$', '', 'g')"
_LINES = rf"""{WORKS}, arrays AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM works), l AS (SELECT doc_id, unnest(range(len(ls))) AS no, unnest(ls) AS line FROM arrays), t AS (SELECT *, {_STRIP("line")} AS s FROM l)"""


def _healed(spark: SparkSession, sf_dir: str, f) -> DataFrame:
    return works(spark, sf_dir).select("doc_id", f(F.col("text")).alias("text"))


@query(rf"""WITH {WORKS}, q AS (SELECT doc_id, text, string_split(text, chr(10)) AS l FROM works), m AS (SELECT *, len(list_filter(l, lambda s: length(s) > 1000)) AS long_, len(regexp_extract_all(text, '\s')) / length(text) AS blanks FROM q)
 SELECT doc_id, CASE WHEN text IS NULL OR {_STRIP("text")} = '' THEN 'Empty file' WHEN long_ / len(l) > 0.2 THEN 'Contains ' || long_ || ' extremely long lines (' || printf('%.1f%%', 100 * long_ / len(l)) || ' of file, max: ' || list_max(list_transform(l, lambda s: length(s))) || ' chars)'
 WHEN blanks < 0.05 THEN 'Very low whitespace ratio (' || printf('%.1f%%', 100 * blanks) || ') - likely malformed extraction' WHEN length(text) / len(l) > 1000 THEN 'Unusually long average line length (' || printf('%.0f', length(text) / len(l)) || ' chars)' ELSE 'OK' END AS message FROM m""")
def heal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return works(spark, sf_dir).select("doc_id", H.quality_message(F.col("text")).alias("message"))


_MESSAGES = ("OK", "Very low whitespace ratio (1.0%)", "Contains 3 extremely long lines", "Bad encoding", "Structure is lost", "malformed", "Something else")


@query("WITH m AS (SELECT doc_id, list_value(" + ", ".join(f"'{m}'" for m in _MESSAGES) + ")[doc_id % 8 + 1] AS m, CASE WHEN doc_id % 5 > 0 THEN doc_id % 5 - 1 END AS r FROM documents), c AS (SELECT *, CASE WHEN m IS NULL OR m = 'OK' THEN 'success' WHEN doc_id % 8 IN (1, 2) THEN CASE WHEN r >= 2 THEN 'partial' WHEN r IS NULL THEN 'no_spaces' ELSE 'unrecoverable' END WHEN doc_id % 8 = 3 THEN 'encoding' WHEN doc_id % 8 IN (4, 5) THEN 'malformed' ELSE 'review' END AS category FROM m) SELECT doc_id, category, category IN ('success', 'partial', 'encoding', 'review') AS recoverable FROM c")
def heal_failure_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("doc_id")
    message = F.get(F.array(*map(F.lit, _MESSAGES)), (k % 8).cast("int"))
    return table(spark, sf_dir, "documents").select("doc_id", H.failure_category(message, F.when(k % 5 > 0, k % 5 - 1)).alias("c")).select("doc_id", "c.*")


def _repeated(least: int) -> str:
    return rf"""short AS (SELECT doc_id, s, count(*) AS n FROM t WHERE length(s) >= 4 AND len(string_split_regex(s, '\s+')) <= 12 GROUP BY ALL), size AS (SELECT doc_id, greatest(greatest(1.0, len(ls) / 50.0) * 0.8, {least}) AS cut FROM arrays), gone AS (SELECT doc_id, s FROM short JOIN size USING (doc_id) WHERE n >= ceil(cut))"""


@query(f"WITH {_LINES}, {_repeated(2)} SELECT doc_id, coalesce((SELECT array_to_string(list(s ORDER BY s), chr(10)) FROM gone g WHERE g.doc_id = a.doc_id), '') AS removed FROM arrays a")
def heal_repeated_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return works(spark, sf_dir).select("doc_id", F.array_join(H.repeated_lines(F.col("text"), least_count=2), "\n").alias("removed"))


@query(f"WITH {_LINES}, {_repeated(1)}, k AS (SELECT doc_id, string_agg(line, chr(10) ORDER BY no) AS text FROM t WHERE NOT EXISTS (SELECT 1 FROM gone g WHERE g.doc_id = t.doc_id AND g.s = t.s) GROUP BY doc_id) SELECT doc_id, coalesce(text, '') AS text FROM arrays LEFT JOIN k USING (doc_id)")
def heal_strip_repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _healed(spark, sf_dir, H.strip_repeated_lines)


@query(rf"WITH {WORKS} SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(text, '(?m)^[ \t]*[0-9]+[ \t]*$', '', 'g'), '(?m)^[ \t]*(?:Page|Pg\.?)[ \t]*[0-9]+(?:[ \t]*of[ \t]*[0-9]+)?[ \t]*$', '', 'g'), '(?m)^.*?\|[ \t]*[0-9]+[ \t]*$', '', 'g') AS text FROM works")
def heal_footers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _healed(spark, sf_dir, H.remove_footers)


@query(rf"SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(replace(replace(text, 'the ', '(cid:12)the '), 'a ', '[3] a '), '\(cid:[0-9]+\)', '', 'g'), '\[[0-9]+\]', '', 'g'), '(?m)^[A-Za-z0-9+/=]{{40,}}[ \t]*$', '', 'g') AS text FROM documents")
def heal_noise(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = F.replace(F.replace(F.col("text"), F.lit("the "), F.lit("(cid:12)the ")), F.lit("a "), F.lit("[3] a "))
    return table(spark, sf_dir, "documents").select("doc_id", H.remove_noise(marked, True).alias("text"))


@query(rf"WITH w AS (SELECT doc_id, concat_ws(chr(10), CASE WHEN doc_id % 3 = 0 THEN '12' END, CASE WHEN doc_id % 2 = 0 THEN '--' END, text) AS text FROM documents), a AS (SELECT doc_id, text, string_split(text, chr(10)) AS ls FROM w), c AS (SELECT *, list_min(list_filter(range(len(ls)), lambda i: regexp_matches(ls[i + 1], '[A-Za-z]{{4}}') OR starts_with({_STRIP('ls[i + 1]')}, '#'))) AS cut FROM a) SELECT doc_id, CASE WHEN coalesce(cut, 0) = 0 THEN text ELSE array_to_string(ls[cut + 1:], chr(10)) END AS text FROM c")
def heal_leading_noise(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("doc_id")
    text = F.concat_ws("\n", F.when(k % 3 == 0, "12"), F.when(k % 2 == 0, "--"), "text")
    return table(spark, sf_dir, "documents").select("doc_id", H.trim_leading_noise(text).alias("text"))


@query(f"WITH {_LINES}, f AS (SELECT *, length(s) <= 3 AS short, no - row_number() OVER (PARTITION BY doc_id, length(s) <= 3 ORDER BY no) AS island FROM t), r AS (SELECT *, count(*) OVER (PARTITION BY doc_id, short, island) AS run FROM f), k AS (SELECT doc_id, string_agg(line, chr(10) ORDER BY no) AS text FROM r WHERE NOT (short AND run >= 5) GROUP BY doc_id) SELECT doc_id, coalesce(text, '') AS text FROM arrays LEFT JOIN k USING (doc_id)")
def heal_short_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _healed(spark, sf_dir, H.drop_short_line_runs)


@query(f"WITH {_LINES}, n AS (SELECT *, coalesce(length(lag(s) OVER w), 0) AS p, coalesce(length(lead(s) OVER w), 0) AS q FROM t WINDOW w AS (PARTITION BY doc_id ORDER BY no)) SELECT doc_id, string_agg(line, chr(10) ORDER BY no) AS text FROM n WHERE NOT (s = '' AND p BETWEEN 1 AND 24 AND q BETWEEN 1 AND 24) GROUP BY doc_id")
def heal_blank_between(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _healed(spark, sf_dir, H.remove_blank_between_short)


@query(rf"WITH x AS (SELECT doc_id, replace(text, '. ', '.  ' || repeat(chr(10), (doc_id % 5)::INT)) AS text FROM documents), l AS (SELECT doc_id, unnest(range(len(string_split(text, chr(10))))) AS no, unnest(string_split(text, chr(10))) AS line FROM x), t AS (SELECT *, {_STRIP('line')} AS s FROM l), n AS (SELECT *, coalesce(lag(s, 1) OVER w = '', false) AS p, coalesce(lag(s, 2) OVER w = '', false) AS q FROM t WINDOW w AS (PARTITION BY doc_id ORDER BY no)) SELECT doc_id, string_agg(regexp_replace(line, '\s+$', ''), chr(10) ORDER BY no) AS text FROM n WHERE NOT (s = '' AND p AND q) GROUP BY doc_id")
def heal_collapse_blanks(spark: SparkSession, sf_dir: str) -> DataFrame:
    broken = F.replace(F.col("text"), F.lit(". "), F.concat(F.lit(".  "), F.repeat(F.lit("\n"), (F.col("doc_id") % 5).cast("int"))))
    return table(spark, sf_dir, "documents").select("doc_id", H.collapse_blank_lines(broken).alias("text"))


@query(r"SELECT doc_id, regexp_replace(regexp_replace(replace(replace(text, '. ', '-' || chr(10)), 'The ', '• The '), '(?m)^([ \t]*)[•●◦▪▫·‣]+[ \t]*', '\1- ', 'g'), '([A-Za-z]{2,})-\s*[\r\n]\s*([a-z][0-9A-Za-z_-]*)', '\1\2', 'g') AS text FROM documents")
def heal_bullets(spark: SparkSession, sf_dir: str) -> DataFrame:
    broken = F.replace(F.replace(F.col("text"), F.lit(". "), F.lit("-\n")), F.lit("The "), F.lit("• The "))
    return table(spark, sf_dir, "documents").select("doc_id", H.fix_hyphenation(H.normalize_bullets(broken)).alias("text"))


_CAPITAL = lambda c: f"(upper({c}[1]) = {c}[1] AND lower({c}[1]) <> {c}[1])"
_HEADER = rf"""(s <> '' AND length(s) <= 100 AND (lower(s) IN ({", ".join(f"'{h}'" for h in H.HEADERS)}) OR regexp_matches(s, '^[0-9]+\.([0-9]+\.?)?\s+[A-Z]') OR (upper(s) = s AND lower(s) <> s AND length(s) < 50)
 OR (len(list_filter(string_split_regex(s, '\s+'), lambda w: w <> '')) <= 6 AND len(list_filter(string_split_regex(s, '\s+'), lambda w: w <> '' AND {_CAPITAL("w")})) / greatest(len(list_filter(string_split_regex(s, '\s+'), lambda w: w <> '')), 1) > 0.6)))"""


@query(f"WITH {_LINES} SELECT doc_id, no::INTEGER AS no, {_HEADER} AS header, regexp_matches(s, '[.!?]$') AND NOT (ends_with(s, '.') AND length(s) < 10) AS sentence, (length(line) - length(replace(line, '|', '')) >= 2 OR regexp_matches(line, '\\S\\s{{2,}}\\S')) AS table_line FROM t")
def heal_line_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    each = works(spark, sf_dir).select("doc_id", F.posexplode(F.split("text", "\n")).alias("no", "line"))
    x: Column = F.col("line")
    return each.select("doc_id", "no", H.is_section_header(x).alias("header"), H.is_complete_sentence(x).alias("sentence"), H.is_table_line(x).alias("table_line"))


@query(f"WITH {_LINES}, h AS (SELECT *, {_HEADER} AS header, regexp_matches(s, '[.!?]$') AND NOT (ends_with(s, '.') AND length(s) < 10) AS done FROM t), n AS (SELECT *, lead(line) OVER w AS nl, lead(s) OVER w AS ns, lead(header) OVER w AS nh FROM h WINDOW w AS (PARTITION BY doc_id ORDER BY no)) SELECT doc_id, no::INTEGER AS no, (line = '' OR nl = '' OR header OR nh OR length(s) < 50 OR (done AND length(s) > 40) OR (done AND {_CAPITAL('ns')})) AS keeps FROM n WHERE nl IS NOT NULL")
def heal_keeps_blank(spark: SparkSession, sf_dir: str) -> DataFrame:
    ls = F.split("text", "\n")
    pairs = works(spark, sf_dir).select("doc_id", F.posexplode(F.arrays_zip(F.slice(ls, 1, F.size(ls) - 1).alias("a"), F.slice(ls, 2, F.size(ls)).alias("b"))).alias("no", "p"))
    return pairs.filter("p.b is not null").select("doc_id", "no", H.keeps_blank(F.col("p.a"), F.col("p.b")).alias("keeps"))


@query()
def heal_merge_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _healed(spark, sf_dir, lambda x: H.by_rows(H.merge_broken_lines)(H.by_rows(H.merge_fragments)(x)))


@query()
def heal_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _healed(spark, sf_dir, H.by_rows(H.repair_tables))


@query()
def heal_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blanks are taken out of every second document's first lines, then looked for."""
    packed = F.when(F.col("doc_id") % 2 == 0, F.replace("text", F.lit(" "), F.lit(""))).otherwise(F.col("text"))
    rows = table(spark, sf_dir, "documents").select("doc_id", H.by_rows(H.recover_words, "text string, confidence int, changed int")(packed).alias("r"))
    return rows.select("doc_id", "r.*")


@query()
def heal_restore(spark: SparkSession, sf_dir: str) -> DataFrame:
    return H.restored(works(spark, sf_dir), least_count=2).select("doc_id", "text", F.array_join("warnings", "; ").alias("warnings"))


@query(f"WITH {WORKS}, c AS (SELECT doc_id, CASE WHEN doc_id % 11 = 0 THEN 'unrecoverable' WHEN doc_id % 7 = 0 THEN 'partial' WHEN doc_id % 5 = 0 THEN 'excluded' ELSE 'success' END AS c FROM documents) SELECT count(*) FILTER (c = 'success') AS success, count(*) FILTER (c = 'partial') AS partial, count(*) FILTER (c = 'unrecoverable') AS unrecoverable, count(*) FILTER (c = 'excluded') AS excluded FROM c")
def heal_tally(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("doc_id")
    c = F.when(k % 11 == 0, "unrecoverable").when(k % 7 == 0, "partial").when(k % 5 == 0, "excluded").otherwise("success")
    return table(spark, sf_dir, "documents").select(c.alias("c")).agg(*[F.count_if(F.col("c") == n).alias(n) for n in ("success", "partial", "unrecoverable", "excluded")])
