"""Writing results: atomically, resumably, in shards and routed folders."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import MANIFEST, _fs, exists, with_position


def replace_path(spark: SparkSession, staged: str, final: str) -> None:
    """Moves a finished folder or file to its final name, over what was there."""
    fs, new = _fs(spark, final)
    _, old = _fs(spark, staged)
    fs.delete(new, True)
    if not fs.rename(old, new):
        raise OSError(f"{staged} could not be renamed to {final}")


def save_results(rows: DataFrame, path: str, form: str = "json") -> None:
    """Writes to a folder beside ``path`` and renames it when all of it is there."""
    staged = f"{path}.tmp-{uuid.uuid4().hex}"
    rows.write.format(form).save(staged)
    replace_path(rows.sparkSession, staged, path)


def save_checkpoint(done: DataFrame, path: str) -> int:
    """Writes (checkpoint, last_update, ...) of processed keys atomically; returns how many there are."""
    save_results(done.dropDuplicates(["checkpoint"]), path, "parquet")
    return done.sparkSession.read.parquet(path).count()


def write_rows(rows: DataFrame, path: str, row_group_bytes: int = 64 << 20, mode: str = "error") -> None:
    """zstd Parquet of an explicit schema with row groups of ``row_group_bytes``; an empty table leaves a file with the schema."""
    rows.write.option("compression", "zstd").option("parquet.block.size", row_group_bytes).mode(mode).parquet(path)


def resume_into(rows: DataFrame, path: str, keys: Sequence[str], resume: bool = True) -> int:
    """Adds the rows whose keys, NULLs equal, ``path`` lacks, and returns how many; without ``resume`` an existing output is refused.

    Old and new rows are written to one staged folder that then takes the output's place.
    """
    spark = rows.sparkSession
    if not exists(spark, path):
        write_rows(rows, path)
        return rows.count()
    if not resume:
        raise FileExistsError(path)
    old = spark.read.parquet(path)
    done = old.select(*[F.col(k).alias(f"d_{k}") for k in keys]).distinct()
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"d_{k}"))
    fresh = rows.join(done, on, "left_anti")
    before, staged = old.count(), f"{path}.partial-{uuid.uuid4().hex}"
    old.unionByName(fresh, allowMissingColumns=True).write.option("compression", "zstd").parquet(staged)
    replace_path(spark, staged, path)
    return spark.read.parquet(path).count() - before


def write_by_year(rows: DataFrame, path: str, year: str = "year", mode: str = "append") -> None:
    """``<path>/<year>=<y>/``: no folder gets the files of all years; one task writes a year's rows of a partition."""
    rows.write.partitionBy(year).option("compression", "zstd").mode(mode).parquet(path)


def sharded(rows: DataFrame, order: Sequence[str | Column], size: int = 10_000) -> DataFrame:
    """``rows`` with ``shard``, by position in ``order``: ``size`` rows each, the last fewer."""
    return with_position(rows, order, "__n").withColumn("shard", F.format_string("shard-%05d", F.floor(F.col("__n") / size))).drop("__n")


def write_shards(rows: DataFrame, path: str, order: Sequence[str | Column], size: int = 10_000) -> None:
    """``<path>/shard=shard-<k>/``, each of ``size`` rows in ``order``."""
    sharded(rows, order, size).write.partitionBy("shard").option("compression", "zstd").parquet(path)


def commit_groups(shards: DataFrame, per_commit: int, name: str = "shard") -> DataFrame:
    """(commit, shards): groups of ``per_commit`` shards in the order of their names."""
    numbered = with_position(shards.select(name).distinct(), [name], "__n")
    return numbered.groupBy(F.floor(F.col("__n") / per_commit).alias("commit")).agg(F.array_sort(F.collect_list(name)).alias("shards"))


def typed_manifest(rows: DataFrame) -> DataFrame:
    """``rows`` under the manifest's fixed schema, missing columns NULL, others dropped."""
    empty = rows.sparkSession.createDataFrame([], MANIFEST)
    return empty.unionByName(rows, allowMissingColumns=True).select(*empty.columns)


def write_manifest(rows: DataFrame, path: str) -> None:
    """The manifest under its fixed schema, also where it is empty, atomically."""
    save_results(typed_manifest(rows), path, "parquet")


def write_run_summary(manifest: DataFrame, path: str, cost_per_hour: float = 5.0) -> dict:
    """One JSON object of the run: files by status, rows, seconds, cost and failed files; and the manifest beside it."""
    manifest = typed_manifest(manifest)
    by = {r["status"]: r["n"] for r in manifest.groupBy("status").agg(F.count("*").alias("n")).collect()}
    done = F.col("status") == "done"
    total = manifest.agg(F.sum(F.when(done, F.col("rows"))).alias("rows"), F.sum(F.when(done, F.col("elapsed_s"))).alias("seconds")).first()
    seconds = total["seconds"] or 0.0
    failed = manifest.filter("status = 'failed'").select("input_file", "error", "attempts").orderBy("input_file")
    out = {"files": sum(by.values()), "by_status": by, "rows": total["rows"] or 0, "seconds": seconds, "cost": round(seconds / 3600 * cost_per_hour, 4)}
    one = manifest.sparkSession.createDataFrame([(json.dumps(out),)], "value string")
    save_results(one.coalesce(1), f"{path}/summary", "text")
    save_results(failed, f"{path}/failed", "json")  # as many as failed: a table, not a list in the summary
    write_manifest(manifest, f"{path}/manifest")
    return out


def write_routed(rows: DataFrame, path: str, category: str = "category", ok: Sequence[str] = ("success", "partial")) -> None:
    """``<path>/cleaned`` and ``<path>/failed/<category>=<c>/``: no row is in both."""
    good = F.coalesce(F.col(category).isin(*ok), F.lit(False))
    save_results(rows.filter(good), f"{path}/cleaned", "parquet")
    staged = f"{path}/failed.tmp-{uuid.uuid4().hex}"
    rows.filter(~good).write.partitionBy(category).parquet(staged)
    replace_path(rows.sparkSession, staged, f"{path}/failed")


def write_error_tables(errors: DataFrame, summary: DataFrame, path: str) -> None:
    """The errors as CSV (text quoted, line breaks kept) and JSON lines, and the summary by document as CSV."""
    flat = errors.select(*[F.array_join(c, "; ").alias(c) if t.startswith("array") else F.col(c) for c, t in errors.dtypes])
    options = {"header": True, "escape": '"', "quoteAll": True, "emptyValue": ""}
    flat.write.options(**options).mode("overwrite").csv(f"{path}/errors_csv")
    errors.write.mode("overwrite").json(f"{path}/errors_jsonl")
    short = summary.select(*[F.array_join(c, "; ").alias(c) if t.startswith("array") else F.col(c) for c, t in summary.dtypes])
    short.write.options(**options).mode("overwrite").csv(f"{path}/summary_csv")


def write_jsonl(rows: DataFrame, path: str, mode: str = "append") -> None:
    """JSON lines; a record of a failed row is a row like others."""
    rows.write.mode(mode).json(path)
