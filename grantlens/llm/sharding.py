"""Sharding by jump consistent hashing (Lamping and Veach, 2014)."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import hash60


def jump_hash(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each 64-bit key.  All keys jump together; those that have passed ``shards`` rest."""
    key = keys.astype(np.uint64)
    b, j = np.full(len(key), -1, np.int64), np.zeros(len(key), np.int64)
    live = np.arange(len(key))
    with np.errstate(over="ignore"):
        while len(live):
            b[live] = j[live]
            k = key[live] * np.uint64(2862933555777941757) + np.uint64(1)
            key[live] = k
            j[live] = ((b[live] + 1) * (2147483648.0 / ((k >> np.uint64(33)) + np.uint64(1)).astype(np.float64))).astype(np.int64)
            live = live[j[live] < shards]
    return b.astype(np.int32)


def shard_of(key: Column, shards: int) -> Column:
    """Shard of a non-negative BIGINT key; only the key goes through Arrow."""
    if shards < 1:
        raise ValueError("at least one shard")

    @F.pandas_udf("int")
    def jump(k: pd.Series) -> pd.Series:
        return pd.Series(jump_hash(k.to_numpy(), shards))

    return jump(key)


def assign_shards(df: DataFrame, shards: int, key_col: str = "doc_id", out: str = "shard") -> DataFrame:
    """Adds ``out``, the shard of each row, from the 60-bit hash of its stable key.  No shuffle, no ring table.

    A NULL key is the key ``'null'``; repeated keys share a shard.  A column called ``out`` is replaced.
    """
    return df.withColumn(out, shard_of(hash60(F.coalesce(F.col(key_col).cast("string"), F.lit("null"))), shards))


def reshard(df: DataFrame, before: int, after: int, key_col: str = "doc_id") -> DataFrame:
    """(key, shard_before, shard, moved) for growth from ``before`` to ``after`` shards: moved rows go to new shards only."""
    one = assign_shards(df.select(F.col(key_col)), before, key_col, "shard_before")
    both = assign_shards(one, after, key_col, "shard")
    return both.withColumn("moved", F.col("shard") != F.col("shard_before"))


def write_shards(df: DataFrame, path: str, shards: int, key_col: str = "doc_id", files: int | None = None) -> None:
    """Writes ``path/shard=k/``; each shard is written by one task."""
    assign_shards(df, shards, key_col).repartition(files or shards, "shard").write.partitionBy("shard").parquet(path)
