"""Exact deduplication by content hash."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, small_side, spare


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each text: that of the smallest id; all columns.

    Texts are grouped by their 128-bit MD5.  Rows whose hash is unique (most) are kept where they are; only rows of hashes
    that occur again are shuffled, with their bytes, and grouped by hash and text, so that two texts that merely collide
    both stay.  NULL ids come after all others; among rows of one id and text the first by its other columns' JSON stays.
    NULL texts are not copies of anything: all such rows stay.  The empty text is a text like others.
    """
    key, n, row = spare(docs, "md5", "n", "row")
    hashed = docs.withColumn(key, F.unhex(F.md5(F.col(text_col).cast("string"))))
    again = materialise(
        hashed.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias(n)).filter(F.col(n) > 1).select(key), "exact-again"
    )
    rows = again.count()
    single = hashed.join(small_side(again, rows), key, "left_anti")
    several = hashed.join(small_side(again, rows), key, "left_semi")
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in (text_col, id_col)]
    order = F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), (F.to_json(F.struct(*rest)) if rest else F.lit("")).alias("rest"))
    kept = several.groupBy(key, text_col).agg(F.min_by(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col]) if len(docs.columns) > 1 else F.lit(1), order).alias(row))
    back = kept.select(*[F.col(text_col) if c == text_col else F.col(row)[c].alias(c) for c in docs.columns])
    return single.drop(key).unionByName(back)
