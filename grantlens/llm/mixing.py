"""Mixing sources to target weights by hash thresholds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import hash60, materialise, small_side, spare, word_count

BITS = 60  # of the hash
#: Bits below a bucket in each round: 4,096 buckets, then 4,096 in the boundary bucket, then the hashes in that one's boundary bucket.
SHIFTS = (48, 36, 0)


def document_sizes(docs: DataFrame, id_col: str, source_col: str, text_col: str) -> DataFrame:
    """(id, source, n_tokens, h) of each row; rows without an id are placed by their text."""
    key = F.coalesce(F.col(id_col).cast("string"), F.concat(F.lit("text:"), F.col(text_col)), F.lit("null"))
    return docs.select(
        F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), word_count(F.col(text_col)).alias("n_tokens"), hash60(key).alias("h")
    )


def budget_thresholds(sizes: DataFrame, budgets: Sequence[float], weights: dict[str, float] | None, default: float = 0.0) -> DataFrame:
    """(source, level, threshold): rows of a source with ``h < threshold`` hold as many tokens as its share of the budget allows.

    Tokens are summed by source and bucket of the leading 12 bits of the hash; the first bucket that would exceed the
    target is the only one looked into.  Only its rows (one in 4,096 for each source and budget) are kept for the next
    rounds: 12 bits more, then single hashes.  No row is sorted: windows run over bucket sums.
    """
    spark = sizes.sparkSession
    totals = sizes.groupBy("source").agg(F.sum("n_tokens").alias("tokens"))
    if weights is None:
        weighted = totals.withColumn("weight", F.lit(1.0))
    else:
        pairs = spark.createDataFrame([(k, float(v)) for k, v in weights.items()], "w_source string, weight double")
        weighted = totals.join(F.broadcast(pairs), F.col("source").eqNullSafe(F.col("w_source")), "left").drop("w_source").fillna(float(default), ["weight"])  # as long as the given weights
    everything = weighted.agg(F.sum("tokens").alias("all_tokens"), F.sum("weight").alias("all_weight"))
    levels = F.explode(F.array(*[F.struct(F.lit(i).alias("level"), F.lit(float(b)).alias("budget")) for i, b in enumerate(budgets)]))
    share = F.when(F.col("all_weight") > 0, F.floor(F.col("all_tokens") * F.col("budget") * F.col("weight") / F.col("all_weight"))).otherwise(F.lit(0).cast("bigint"))
    state = (
        weighted.crossJoin(F.broadcast(everything))  # one row
        .select("source", levels.alias("l"), "all_tokens", "all_weight", "weight")
        .select("source", F.col("l.level").alias("level"), F.col("l.budget").alias("budget"), "all_tokens", "all_weight", "weight")
        .select("source", "level", share.alias("target"), F.lit(0).cast("bigint").alias("prefix"), F.lit(0).cast("bigint").alias("below"))
    )
    state = materialise(state, "mix-targets")
    order = Window.partitionBy("source", "level").orderBy("bucket")
    done, above, rows = [], BITS, sizes.select("source", "h", "n_tokens")
    for shift in SHIFTS:
        wanted = small_side(state.select(F.col("source").alias("s"), "level", "target", "prefix", "below"))
        if above < BITS:
            inside = small_side(state.select(F.col("source").alias("s"), "prefix").distinct())
            rows = materialise(rows.join(inside, F.col("source").eqNullSafe(F.col("s")) & (F.shiftright("h", above) == F.col("prefix")), "left_semi"), "mix-inside")
        sums = rows.groupBy("source", F.shiftright("h", shift).alias("bucket")).agg(F.sum("n_tokens").alias("tokens"))
        over = (
            sums.join(wanted, F.col("source").eqNullSafe(F.col("s")) & (F.shiftright("bucket", above - shift) == F.col("prefix")))
            .withColumn("up_to", F.col("below") + F.sum("tokens").over(order))
            .filter(F.col("up_to") > F.col("target"))
            .groupBy("source", "level", "target")
            .agg(F.min_by(F.struct("bucket", (F.col("up_to") - F.col("tokens")).alias("below")), "bucket").alias("b"))
        )
        found = over.select("source", "level", "target", F.col("b.bucket").alias("prefix"), F.col("b.below").alias("below"))
        found = materialise(found, "mix-boundary")
        if above == BITS:  # sources that fit whole have no boundary
            whole = state.join(small_side(found.select(F.col("source").alias("s"), F.col("level").alias("l"))), F.col("source").eqNullSafe(F.col("s")) & (F.col("level") == F.col("l")), "left_anti")
            done.append(whole.select("source", "level", F.lit(1 << BITS).cast("bigint").alias("threshold")))
        state, above = found, shift
    done.append(state.select("source", "level", F.col("prefix").alias("threshold")))
    return materialise(done[0].unionByName(done[1]), "mix-thresholds")


def mix_levels(docs: DataFrame, budgets: Sequence[float], weights: dict[str, float] | None = None, default: float = 0.0, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """(id, source, n_tokens, level) of the rows that belong to the mix.

    ``budgets`` are growing fractions of all tokens; source ``s`` may fill ``budget * weight_s / sum(weights)``.  A row
    belongs to the nested subsets from ``level`` on.  ``weights`` None: all sources alike; a source without a weight has
    the weight ``default``, by which it gets nothing.  A source that has less than its share is kept whole.  Rows whose hashes tie (repeated ids) come or go
    together; NULL sources form one source; NULL texts have no tokens; an empty table gives an empty one.
    Texts of any length count whole.  Other columns play no part.
    """
    sizes = materialise(document_sizes(docs, id_col, source_col, text_col), "mix-sizes")
    limits = budget_thresholds(sizes, budgets, weights, default)
    kept = _levels(sizes, limits, "source", "h", "level")
    return kept.select(F.col("id").alias(id_col), F.col("source").alias(source_col), "n_tokens", "level")


def mix_filter(docs: DataFrame, budget: float = 1.0, weights: dict[str, float] | None = None, default: float = 0.0, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that belong to the mix of one budget; as :func:`mix_levels` otherwise.

    The text is read once for its size and once for the filter; it is never shuffled.
    """
    sizes = materialise(document_sizes(docs, id_col, source_col, text_col), "mix-sizes")
    limits = budget_thresholds(sizes, [budget], weights, default)
    h, s, level = spare(docs, "h", "source", "level")
    key = F.coalesce(F.col(id_col).cast("string"), F.concat(F.lit("text:"), F.col(text_col)), F.lit("null"))
    tagged = docs.withColumns({h: hash60(key), s: F.col(source_col).cast("string")})
    return _levels(tagged, limits, s, h, level).select(*[F.col(f"`{c}`") for c in docs.columns])


def _levels(df: DataFrame, limits: DataFrame, source: str, h: str, level: str) -> DataFrame:
    """The rows of ``df`` that belong to the mix, with ``level``, a name that ``df`` doesn't have."""
    other, bounds = spare(df, "mix_source", "mix_limits")
    wide = limits.groupBy(F.col("source").alias(other)).agg(F.array_sort(F.collect_list(F.struct("level", "threshold"))).alias(bounds))
    joined = df.join(small_side(wide), F.col(source).eqNullSafe(F.col(other)))
    fits = F.filter(F.col(bounds), lambda x: F.col(h) < x["threshold"])
    return joined.withColumn(level, F.get(fits, F.lit(0))["level"]).filter(F.col(level).isNotNull())
