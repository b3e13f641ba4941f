"""Connected groups of an undirected edge list."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_path, fresh_path

#: Edges that one task joins in memory (16 bytes each); more are first contracted by many tasks, round by round.
LOCAL_EDGES = 3_000_000


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, root) of every node of the edges; the root is the smallest node of its group."""
    nodes, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = flat[: len(a)], flat[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[x], root[y])
        hooked = root.copy()
        np.minimum.at(hooked, root[x], low)
        np.minimum.at(hooked, root[y], low)
        while True:  # pointer jumping
            jumped = hooked[hooked]
            if (jumped == hooked).all():
                break
            hooked = jumped
        if (hooked == root).all():
            return nodes, nodes[root]
        root = hooked
        open_ = root[x] != root[y]
        x, y = x[open_], y[open_]
        if not len(x):
            return nodes, nodes[root]


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    a, b, n = [], [], 0
    for batch in batches:
        a.append(batch.column(0).to_numpy())
        b.append(batch.column(1).to_numpy())
        n += batch.num_rows
        if n > LOCAL_EDGES:  # dense groups have many more edges than nodes
            node, root = forest(np.concatenate(a), np.concatenate(b))
            a, b, n = [node], [root], len(node)
            if n > LOCAL_EDGES // 2:  # no room left to join more
                yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(root)], ["node", "root"])
                a, b, n = [], [], 0
    if a and sum(map(len, a)):
        node, root = forest(np.concatenate(a), np.concatenate(b))
        yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(root)], ["node", "root"])


def connected_groups(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b BIGINT); the root is the smallest node of the group.

    Each task contracts its edges to a spanning forest.  Where more edges remain than one task may hold, rounds of
    large-star and small-star (Kiveris et al., 2014) run until nothing changes, each cut off by a written table in the
    shared folder; below that a single task finishes.  Loops and repeated edges are harmless; no edges, no rows.
    """
    spark = edges.sparkSession

    def write(df: DataFrame) -> tuple[DataFrame, str]:
        df.write.parquet(path := fresh_path(spark, "groups"))
        return spark.read.schema(df.schema).parquet(path), path

    pairs = edges.select(F.col("a").cast("bigint"), F.col("b").cast("bigint"))
    now, path = write(pairs.mapInArrow(_contract, "node bigint, root bigint").filter("node <> root"))
    n = now.count()
    while n > LOCAL_EDGES:
        both = now.union(now.select("root", "node"))
        least = both.groupBy("node").agg(F.min("root").alias("least")).withColumn("least", F.least("node", "least"))
        large = both.filter("root > node").join(least, "node").select(F.col("root").alias("node"), F.col("least").alias("root")).distinct()
        least = large.groupBy("node").agg(F.min("root").alias("least"))
        small = large.join(least, "node").select(F.explode(F.array(F.struct("node", F.col("least").alias("root")), F.struct(F.col("root").alias("node"), F.col("least").alias("root")))).alias("e")).select("e.*").filter("node <> root").distinct()
        new, new_path = write(small)
        m, changed = new.count(), new.exceptAll(now).limit(1).count()
        drop_path(spark, path)
        now, path, n = new, new_path, m
        if not changed:
            done, _ = write(now.union(now.select(F.col("root").alias("node"), "root")).distinct())
            return done
    done, _ = write(now.coalesce(1).mapInArrow(_contract, "node bigint, root bigint"))
    drop_path(spark, path)
    return done
