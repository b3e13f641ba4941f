"""Documents as a stream: bounded micro-batches, error rows, keyed upserts, resumption; the same rows as in one batch."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sinks import replace_path
from ..sources import exists


def document_stream(spark: SparkSession, path: str, schema: str, files_per_trigger: int = 1) -> DataFrame:
    """Parquet files as they come, ``files_per_trigger`` in a micro-batch: what keeps a slow consumer from being flooded."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def guarded(f: Callable[[str], str], kind: str = "string") -> Callable[[Column], Column]:
    """(value, error) of a Python function of one text, in Arrow batches: a failed row has an error instead of a value, and no row is lost."""
    def apply(x: Column) -> Column:
        @F.pandas_udf(f"value {kind}, error string")
        def run(s: pd.Series) -> pd.DataFrame:
            out = []
            for v in s:
                try:
                    out.append((f(v), None))
                except Exception as e:  # any failure of the row's own function is the row's result
                    out.append((None, f"{type(e).__name__}: {e}"))
            return pd.DataFrame(out, columns=["value", "error"])

        return run(x)

    return apply


def upsert(batch: DataFrame, path: str, key: str, order: str) -> None:
    """Merges rows into a keyed table of results: of each key the last in ``order`` stays; a repeated batch changes nothing.

    The table is written anew beside the old one, which it then replaces.
    """
    spark = batch.sparkSession
    rows = batch.unionByName(spark.read.schema(batch.schema).parquet(path)) if exists(spark, path) else batch
    rest = [c for c in rows.columns if c != key]
    kept = rows.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(order, *[c for c in rest if c != order])).alias("r")).select(key, *[F.col("r")[c].alias(c) for c in rest])
    staged = f"{path}.tmp-{uuid.uuid4().hex}"
    kept.select(*batch.columns).write.parquet(staged)
    replace_path(spark, staged, path)


def process_stream(
    stream: DataFrame, transform: Callable[[DataFrame], DataFrame], output: str, checkpoint: str, key: str, order: str, done: DataFrame | None = None,
) -> StreamingQuery:
    """Runs ``transform`` on every micro-batch until all input that is there now is done, and upserts its rows into ``output``.

    The checkpoint names the files that are done: after a restart only new ones are read, and a batch that was broken off
    is repeated, which the keyed upsert makes harmless.  Rows whose key is in ``done`` are passed over.
    """

    def each(batch: DataFrame, _: int) -> None:
        rows = batch if done is None else batch.join(done.select(F.col(key).alias("__done")).distinct(), F.col(key) == F.col("__done"), "left_anti")
        upsert(transform(rows), output, key, order)

    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def running_summary(stream: DataFrame, key: str, order: str, statements: str) -> DataFrame:
    """(key, statements) with the last row of each key by ``order``, as a stateful aggregation for update mode; sums over it are the run's summary."""
    return stream.groupBy(key).agg(F.max_by(statements, order).alias("statements"))


def observed(rows: DataFrame, name: str, **metrics: Column) -> DataFrame:
    """``rows`` with named metrics of each batch (QueryProgressEvent.observedMetrics): counts and sums without a job of their own."""
    return rows.observe(name, *[c.alias(k) for k, c in metrics.items()])
