"""Which values of predicted funders differ from gold, and how often."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import similarity as S
from ..functions.funders import FIELDS, FUNDERS, flat_awards, records
from ..functions.text import normalize_for_errors

#: field -> (name in error types, name in value lists)
NAMES = {"funder_name": ("funder", "funders"), "award_ids": ("award_id", "award_ids"), "funding_scheme": ("scheme", "schemes"), "award_title": ("award_title", "award_titles")}
COLUMNS = ("doi", "error_type", "field", "gold_value", "pred_value", "funder")
_NULL = "__NULL__"


def _awards(rows: DataFrame, column: str) -> DataFrame:
    """(doi, funder, award fields): one row for each funder and award, names normalised, none as __NULL__."""
    one = rows.select("doi", F.explode(flat_awards(F.col(column).cast(FUNDERS))).alias("a"))
    name = F.when(F.col("a.funder_name").isNull(), F.lit(_NULL)).otherwise(normalize_for_errors(F.col("a.funder_name")))
    return one.select("doi", name.alias("funder"), *[F.col(f"a.{f}").alias(f) for f in FIELDS])


def compare_exact(rows: DataFrame) -> DataFrame:
    """(doi, error_type, field, gold_value, pred_value, funder) of each difference; ``rows``: (doi, funders, predicted_funders).

    Eight kinds of values on one side only, inside the funders that both have, and three of unlike counts.  All values of
    both sides are exploded once and counted once, by (doi, funder, field, value): no joins, and no record is compared in
    Python.  Rows that are divided by ``doi`` are not shuffled.
    """
    fields = ("funder_name", *FIELDS)  # of an item: its place, 0 the funder's own; -1 counts a record's awards
    text = "string"

    def items(column: str, g: int, p: int) -> Column:
        flat = flat_awards(F.col(column).cast(FUNDERS))
        item = lambda k, funder, value: F.struct(F.lit(k).alias("k"), funder.cast(text).alias("funder"), value.cast(text).alias("value"), F.lit(g).alias("g"), F.lit(p).alias("p"))

        def each(a: Column) -> Column:
            own = F.array(item(0, a["funder"], F.lit("")), item(-1, F.lit(None), F.lit("")))
            value = lambda k: lambda v: item(k, a["funder"], normalize_for_errors(v))
            return F.concat(own, *[F.transform(F.filter(a[f], lambda v: v != ""), value(k)) for k, f in enumerate(fields) if k])

        name = lambda a: F.when(a["funder_name"].isNull(), F.lit(_NULL)).otherwise(normalize_for_errors(a["funder_name"]))
        named = F.transform(flat, lambda a: F.struct(name(a).alias("funder"), *[a[f].alias(f) for f in FIELDS]))
        return F.flatten(F.transform(named, each))

    one = rows.select("doi", F.explode(F.concat(items("funders", 1, 0), items("predicted_funders", 0, 1))).alias("i")).select("doi", "i.*")
    counts = one.groupBy("doi", "funder", "k", "value").agg(F.sum("g").alias("g"), F.sum("p").alias("p"))
    k, g, p, null = F.col("k"), F.col("g"), F.col("p"), F.col("funder") == _NULL
    both = F.max((k == 0) & (g > 0) & (p > 0)).over(Window.partitionBy("doi", "funder"))
    counts = counts.withColumn("both", both).filter((g != p) & ((k <= 0) | F.col("both")))
    shown = F.when(null, "(null funder)").otherwise(F.col("funder"))

    def error(kind: Column, field: Column, gold: Column, said: Column, funder: Column) -> Column:
        return F.struct(*[c.cast(text).alias(n) for n, c in zip(COLUMNS[1:], (kind, field, gold, said, funder))])

    of = lambda names: F.element_at(F.array(*map(F.lit, names)), k + 1)
    value = F.when(k == 0, F.col("funder")).otherwise(F.col("value"))
    side = error(F.concat(F.when(p == 0, "missing_").otherwise("extra_"), of([NAMES[f][0] for f in fields])), of(fields), F.when(p == 0, value).otherwise(""), F.when(p == 0, "").otherwise(value), shown)
    awards = error(F.lit("award_count_mismatch"), F.lit("awards"), g, p, shown)
    nulls = error(F.lit("null_funder_count_mismatch"), F.lit("funder_name"), F.concat(g, F.lit(" null funders")), F.concat(p, F.lit(" null funders")), F.lit(None))
    total = error(F.lit("funder_count_mismatch"), F.lit("funders"), g, p, F.lit(None))
    found = F.array(
        F.when(k == -1, total).when((g == 0) | (p == 0), F.when((k > 0) | ~null, side)).when(k == 0, awards),
        F.when((k == 0) & null, nulls),
    )
    return counts.select("doi", F.explode(F.array_compact(found)).alias("e")).select("doi", "e.*")


def fuzzy_errors(gold: Iterable[dict], said: Iterable[dict], least: float = 90.0) -> list[tuple[str, str, str, str, str | None]]:
    """The errors of one record where values match by similarity; funders are paired anew, each gold one with its best remaining name."""
    def flat(side: Iterable[dict]) -> dict[str, list[dict]]:
        out: dict[str, list[dict]] = {}
        for f in side:
            for a in list(f["awards"] if f["awards"] is not None else []) or [dict.fromkeys(FIELDS, ())]:
                out.setdefault(S.plain(f["funder_name"]).lower() if f["funder_name"] else _NULL, []).append(a)
        return out

    g, p = flat(gold), flat(said)
    names_g, names_p = sorted(set(g) - {_NULL}), sorted(set(p) - {_NULL})
    out: list[tuple[str, str, str, str, str | None]] = []

    def differ(a: Iterable[str], b: Iterable[str], field: str, funder: str | None) -> list[str]:
        pairs = S.greedy_match(a, b, least)
        left, right = {x for x, _, _ in pairs}, {y for _, y, _ in pairs}
        out.extend((f"missing_{NAMES[field][0]}", field, v, "", funder or v) for v in sorted(set(a) - left))
        out.extend((f"extra_{NAMES[field][0]}", field, "", v, funder or v) for v in sorted(set(b) - right))
        return sorted(left)

    matched, rest, pairs = differ(names_g, names_p, "funder_name", None), list(names_p), []
    for name in matched:
        best = max(rest, key=lambda x: (S.fuzzy(name, x), x))
        rest.remove(best)
        pairs.append((name, best))
    pairs += [(_NULL, _NULL)] if _NULL in g and _NULL in p else []
    for a, b in pairs:
        shown = "(null funder)" if a == _NULL else a
        for field in FIELDS:
            clean = lambda side: {S.plain(v).lower() for x in side for v in (x[field] if x[field] is not None else ()) if v}  # noqa: B023, E731
            differ(clean(g[a]), clean(p[b]), field, shown)
        if len(g[a]) != len(p[b]):
            out.append(("award_count_mismatch", "awards", str(len(g[a])), str(len(p[b])), shown))
    nulls = len(g.get(_NULL, [])), len(p.get(_NULL, []))
    if nulls[0] != nulls[1]:
        out.append(("null_funder_count_mismatch", "funder_name", f"{nulls[0]} null funders", f"{nulls[1]} null funders", None))
    n, m = sum(map(len, g.values())), sum(map(len, p.values()))
    return out + ([("funder_count_mismatch", "funders", str(n), str(m), None)] if n != m else [])


def compare_fuzzy(rows: DataFrame, least: float = 90.0) -> DataFrame:
    """As :func:`compare_exact`, values matched by similarity; a record is one Python call, in Arrow batches."""

    @F.arrow_udf("array<struct<error_type: string, field: string, gold_value: string, pred_value: string, funder: string>>")
    def compare(gold: pa.Array, said: pa.Array) -> pa.Array:
        made = [fuzzy_errors(g, p, least) for g, p in zip(records(gold), records(said))]
        flat = list(zip(*[e for errors in made for e in errors])) or [()] * 5
        items = pa.StructArray.from_arrays([pa.array(c, pa.string()) for c in flat], list(COLUMNS[1:]))
        return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, made)]), pa.int32()), items)

    made = rows.select("doi", F.explode(compare(F.col("funders").cast(FUNDERS), F.col("predicted_funders").cast(FUNDERS))).alias("e"))
    return made.select("doi", "e.*")


def _of_all(rows: DataFrame, errors: DataFrame, *more: Column) -> DataFrame:
    """(doi, error_count, error_types, ...) of every document, the aggregates ``more`` NULL where there are no errors."""
    by = errors.groupBy("doi").agg(F.count("*").alias("error_count"), F.array_sort(F.collect_set("error_type")).alias("error_types"), *more)
    none = F.array().cast("array<string>")
    rest = [c for c in by.columns if c not in ("doi", "error_count", "error_types")]
    return rows.select("doi").join(by, "doi", "left").select("doi", F.coalesce("error_count", F.lit(0)).alias("error_count"), F.coalesce("error_types", none).alias("error_types"), *rest)


def document_summary(rows: DataFrame, errors: DataFrame) -> DataFrame:
    """(doi, error_count, error_types) of every document, worst first, ties by DOI; documents without errors count 0."""
    return _of_all(rows, errors).orderBy(F.desc("error_count"), "doi")


def type_summary(errors: DataFrame) -> DataFrame:
    """(error_type, field, n, documents, percent), most frequent first, ties by name; missing_ and extra_ kinds also summed (kind)."""
    total = errors.agg(F.count("*").alias("total"))
    one = errors.groupBy("error_type", "field").agg(F.count("*").alias("n"), F.countDistinct("doi").alias("documents"))
    kind = F.when(F.col("error_type").startswith("missing_"), "missing").when(F.col("error_type").startswith("extra_"), "extra").otherwise("mismatch")
    return one.crossJoin(F.broadcast(total)).select(kind.alias("kind"), "error_type", "field", "n", "documents", F.round(100.0 * F.col("n") / F.col("total"), 4).alias("percent")).orderBy(F.desc("n"), "error_type")


def side_by_side(rows: DataFrame, errors: DataFrame) -> DataFrame:
    """One row a document: its counts and, for each of eight kinds of value errors, the values joined by '; '."""
    lists = []
    for name, plural in NAMES.values():
        for kind, value in (("missing", "gold_value"), ("extra", "pred_value")):
            lists.append(F.array_join(F.array_sort(F.collect_list(F.when(F.col("error_type") == f"{kind}_{name}", F.col(value)))), "; ").alias(f"{kind}_{plural}"))
    return _of_all(rows, errors, *lists).fillna("", [f"{kind}_{plural}" for _, plural in NAMES.values() for kind in ("missing", "extra")])


def perfect_count(rows: DataFrame, errors: DataFrame) -> DataFrame:
    """(documents, perfect)."""
    return document_summary(rows, errors).agg(F.count("*").alias("documents"), F.count_if(F.col("error_count") == 0).alias("perfect"))
