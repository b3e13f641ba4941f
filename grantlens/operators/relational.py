"""Joins, aggregations and windows of batch runs: resume, manifests, metrics, summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import f_beta
from ..sources import with_position


def resume(rows: DataFrame, done: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose composite key, NULLs equal, is not in ``done``."""
    d = done.select(*[F.col(k).alias(f"d_{k}") for k in keys])
    on: Column = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"d_{k}"))
    return rows.join(d, on, "left_anti")


def wins(rows: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in ``order`` (reverse it for the last)."""
    return rows.withColumn("rn", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).filter("rn = 1").drop("rn")


def multiset_matches(gold: DataFrame, predicted: DataFrame, group: str, item: str) -> DataFrame:
    """(group, gold, predicted, matched): one-to-one matches by equality."""
    g = gold.groupBy(group, item).agg(F.count("*").alias("g"))
    p = predicted.groupBy(group, item).agg(F.count("*").alias("p"))
    both = g.join(p, [group, item], "full").fillna(0, ["g", "p"])
    return both.groupBy(group).agg(F.sum("g").alias("gold"), F.sum("p").alias("predicted"), F.sum(F.least("g", "p")).alias("matched"))


def level_metrics(counts: DataFrame, gold: str = "gold", predicted: str = "predicted", matched: str = "matched") -> DataFrame:
    """Adds precision, recall, F1, F0.5 and F1.5, all 0 where undefined."""
    m = F.col(matched)
    p, r = F.when(F.col(predicted) > 0, m / F.col(predicted)).otherwise(0.0), F.when(F.col(gold) > 0, m / F.col(gold)).otherwise(0.0)
    return counts.withColumns({"precision": F.round(p, 6), "recall": F.round(r, 6), "f1": F.round(f_beta(p, r, 1), 6), "f0_5": F.round(f_beta(p, r, 0.5), 6), "f1_5": F.round(f_beta(p, r, 1.5), 6)})


def bucket_and_overall(rows: DataFrame, bucket: str, *aggs: Column) -> DataFrame:
    """Aggregates for each bucket and, as 'overall', for all rows, from one pass."""
    return rows.rollup(bucket).agg(F.grouping(bucket).alias("all_rows"), *aggs).withColumn(bucket, F.when(F.col("all_rows") == 1, "overall").otherwise(F.col(bucket))).drop("all_rows")


def floor_percentile(rows: DataFrame, key: str, value: str, q: float, name: str) -> DataFrame:
    """(key, name): of each key the value at place floor(q (n - 1)) of its sorted values; sorted over a shuffle, no lists."""
    w = Window.partitionBy(key)
    placed = rows.filter(F.col(value).isNotNull()).withColumns({"__rn": F.row_number().over(w.orderBy(value)), "__n": F.count("*").over(w)})
    return placed.filter(F.col("__rn") == F.floor(F.lit(q) * (F.col("__n") - 1)) + 1).select(key, F.col(value).alias(name))


def phase_summary(rows: DataFrame, phase: str, value: str) -> DataFrame:
    """(phase, n, total, mean, median, p95 by floor, percent of all phases' total)."""
    one = rows.groupBy(phase).agg(F.count(value).alias("n"), F.sum(value).alias("total"), F.avg(value).alias("mean"), F.percentile(value, 0.5).alias("median"))
    whole = one.agg(F.sum("total").alias("__all"))
    share = F.when(F.col("__all") > 0, 100 * F.col("total") / F.col("__all")).otherwise(0.0)
    return one.join(floor_percentile(rows, phase, value, 0.95, "p95"), phase).crossJoin(F.broadcast(whole)).withColumn("percent", share).drop("__all")


def ema(rows: DataFrame, key: str, order: str, value: str, alpha: float = 0.3) -> DataFrame:
    """(key, ema): the exponential average of each key's values in order, the first value its start.

    The fold is a weighted sum: of n values the k-th weighs alpha (1 - alpha)^(n - k), the first (1 - alpha)^(n - 1).
    """
    w = Window.partitionBy(key)
    placed = rows.withColumns({"__k": F.row_number().over(w.orderBy(order)), "__n": F.count("*").over(w)})
    weight = F.pow(F.lit(1 - alpha), F.col("__n") - F.col("__k")) * F.when(F.col("__k") == 1, 1.0).otherwise(alpha)
    return placed.groupBy(key).agg(F.round(F.sum(F.col(value) * weight), 6).alias("ema"))


def next_batch(rows: DataFrame, group: str, cost: str, tie: str, target: float, most: int) -> DataFrame:
    """Longest first: the first row always, then as long as neither ``target`` nor ``most`` is passed."""
    w = Window.partitionBy(group).orderBy(F.desc(cost), tie)
    running = rows.withColumns({"rn": F.row_number().over(w), "running": F.sum(cost).over(w.rowsBetween(Window.unboundedPreceding, 0))})
    return running.filter((F.col("rn") == 1) | ((F.col("running") <= target) & (F.col("rn") <= most)))


def running_best(rows: DataFrame, group: str, order: Sequence[str], value: str) -> DataFrame:
    w = Window.partitionBy(group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("best_so_far", F.max(value).over(w))


def merge_manifest(old: DataFrame, listing: DataFrame, key: str = "input_file", seconds_per_byte: float = 9e-7) -> DataFrame:
    """Known rows as they are; unseen files as pending with an estimate."""
    new = listing.join(old.select(key), key, "left_anti").select(key, "size_bytes", (F.col("size_bytes") * seconds_per_byte).alias("est_seconds"), F.lit("pending").alias("status"))
    return old.select(key, "size_bytes", "est_seconds", "status").unionByName(new)


def reconcile(manifest: DataFrame, outputs: DataFrame) -> DataFrame:
    """Marks rows done whose base name is among the outputs."""
    names = outputs.select(F.element_at(F.split("path", "/"), -1).alias("base")).distinct()
    joined = manifest.withColumn("base", F.element_at(F.split("input_file", "/"), -1)).join(names.withColumn("there", F.lit(True)), "base", "left")
    return joined.withColumn("status", F.when((F.col("status") != "done") & F.col("there"), "done").otherwise(F.col("status"))).drop("base", "there")


def set_diff(old: DataFrame, new: DataFrame, key: str, items: str) -> DataFrame:
    """(key, verdict, removed, added): missing on a side, equal, or the differences of the distinct items."""
    a, b = old.select(key, F.col(items).alias("a")), new.select(key, F.col(items).alias("b"))
    both = a.join(b, key, "full")
    verdict = F.when(F.col("b").isNull(), "missing").when(F.col("a").isNull(), "new").when(F.col("a") == F.col("b"), "equal").otherwise("changed")
    return both.select(key, verdict.alias("verdict"), F.coalesce(F.size(F.array_except("a", "b")), F.lit(0)).alias("removed"), F.coalesce(F.size(F.array_except("b", "a")), F.lit(0)).alias("added"))


def run_metrics(rows: DataFrame, bucket: str, order: str, latency: str, seconds: float) -> DataFrame:
    """(bucket, docs, mean, p50, p95, p99, docs_per_second) of each bucket and, as 'overall', of all rows.

    Each group's first row in ``order`` is the warm-up and has no latency; a bucket's rate is by its summed latency, the
    overall one by the wall clock.
    """
    first = rows.agg(F.min(order).alias("__first"))  # one row: no window over all rows
    numbered = rows.select(F.col(bucket).alias("__b"), order, latency).withColumn("__rn", F.row_number().over(Window.partitionBy("__b").orderBy(order)))
    numbered = numbered.crossJoin(F.broadcast(first)).select("__b", latency, F.when(F.col("__rn") > 1, F.col(latency)).alias("warm"), F.when(F.col(order) > F.col("__first"), F.col(latency)).alias("all_warm"))
    stats = lambda c: [F.avg(c).alias("mean"), *[F.percentile(c, q).alias(n) for n, q in (("p50", 0.5), ("p95", 0.95), ("p99", 0.99))]]
    each = numbered.groupBy(F.col("__b").alias(bucket)).agg(F.count("*").alias("docs"), *stats("warm"), (F.count("*") / F.sum(latency)).alias("docs_per_second"))
    overall = numbered.agg(F.lit("overall").alias(bucket), F.count("*").alias("docs"), *stats("all_warm"), (F.count("*") / F.lit(seconds)).alias("docs_per_second"))
    return each.unionByName(overall)


def checkpoint_scores(checkpoints: DataFrame, evals: DataFrame, step: str, metric: str) -> DataFrame:
    """(step, best, chosen): the best metric among evaluations up to each checkpoint, and whether it is the best of all, the earliest of equals.

    A running maximum over both tables instead of a join of ranges; these are as many rows as one training evaluates.
    """
    both = checkpoints.select(step, F.lit(None).cast("double").alias("m"), F.lit(1).alias("is_checkpoint")).unionByName(evals.select(step, F.col(metric).cast("double").alias("m"), F.lit(0).alias("is_checkpoint")))
    running = both.withColumn("best", F.max("m").over(Window.orderBy(step, "is_checkpoint").rowsBetween(Window.unboundedPreceding, 0)))
    kept = running.filter("is_checkpoint = 1").select(step, "best")
    top = kept.agg(F.min_by(step, F.struct((-F.col("best")).alias("less"), F.col(step))).alias("__top"))
    return kept.crossJoin(F.broadcast(top)).select(step, "best", (F.col(step) == F.col("__top")).alias("chosen"))


def result_summary(results: DataFrame, statements: str = "n_statements") -> DataFrame:
    """(files, files_with_funding, statements)."""
    return results.agg(F.count("*").alias("files"), F.count_if(F.col(statements) > 0).alias("files_with_funding"), F.coalesce(F.sum(statements), F.lit(0)).alias("statements"))


def split_by_id(ids: DataFrame, key: str, fractions: Sequence[tuple[str, float]], rest: str, seed: int = 42) -> DataFrame:
    """``ids`` with ``split``: by the place of each distinct id in a seeded hash order, sizes cut off to whole ids, what is left over to ``rest``.

    Rows of one id share a split.
    """
    h = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")))
    placed = with_position(ids.select(key).distinct().withColumn("__h", h), ["__h", key], "__n")
    n = placed.count()
    name, end = F.lit(None).cast("string"), 0
    for split, share in fractions:
        end += int(n * share)
        name = F.coalesce(name, F.when(F.col("__n") < end, split))
    return ids.join(placed.select(key, F.coalesce(name, F.lit(rest)).alias("split")), key)


def upsampled(real: DataFrame, synthetic: DataFrame, times: int = 2) -> DataFrame:
    """All synthetic rows and each real row ``times`` times."""
    many = real.withColumn("__k", F.explode(F.sequence(F.lit(1), F.lit(times)))).drop("__k")
    return many.unionByName(synthetic, allowMissingColumns=True)


def union_all(tables: Sequence[DataFrame]) -> DataFrame:
    """All rows; columns by name, those that a table lacks NULL, types promoted."""
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    return out


def most_common(rows: DataFrame, value: str, order: str) -> DataFrame:
    """(value, n), most frequent first, ties by first occurrence in ``order``."""
    return rows.groupBy(value).agg(F.count("*").alias("n"), F.min(order).alias("__first")).orderBy(F.desc("n"), "__first").drop("__first")


def short_runs(lines: DataFrame, key: str, order: str, line: str, longest: int = 40, least: int = 5) -> DataFrame:
    """Lines in runs of ``least`` or more short ones (gaps and islands)."""
    w = Window.partitionBy(key).orderBy(order)
    flagged = lines.withColumn("short", F.length(F.trim(line)) < longest)
    island = flagged.filter("short").withColumn("island", F.col(order) - F.row_number().over(w))
    return island.withColumn("run", F.count("*").over(Window.partitionBy(key, "island"))).filter(F.col("run") >= least).select(key, order, "run")
