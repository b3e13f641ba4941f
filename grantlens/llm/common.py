"""Shared helpers: scratch tables, size-checked joins, Arrow text chunks and word hashing."""

from __future__ import annotations

import atexit
import ctypes
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side of a join is broadcast only when it was counted and its files have at most so many rows and bytes.
BROADCAST_ROWS, BROADCAST_BYTES = 400_000, 24 << 20
#: Bytes of text that a Python worker holds as word arrays at a time; one longer document is a chunk of its own.
CHUNK_BYTES = 4 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir`` of the session.

    Where it is unset, local sessions (tests) get a temporary folder; on a cluster that is an error.
    """
    conf = spark.sparkContext.getConf()
    at = conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if at:
        return at.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    made = tempfile.mkdtemp(prefix="grantlens-")
    atexit.register(shutil.rmtree, made, ignore_errors=True)
    spark.conf.set("spark.checkpoint.dir", f"file://{made}")
    return f"file://{made}"


def fresh_path(spark: SparkSession, tag: str) -> str:
    return f"{shared_dir(spark)}/grantlens-{tag}-{uuid.uuid4().hex}"


def drop_path(spark: SparkSession, path: str) -> None:
    """Deletes a scratch folder through Spark's own file system layer."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def materialise(df: DataFrame, tag: str) -> DataFrame:
    """Writes a compact intermediate once into the shared folder and reads it back: no recomputation, no lineage."""
    path = fresh_path(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, rows: int | None = None) -> DataFrame:
    """Hints how to join with ``df`` (a materialised table or a projection of one): broadcast if counted small, else a shuffled hash join."""
    n = df.count() if rows is None else rows
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))  # of its files, as written
    return F.broadcast(df) if n <= BROADCAST_ROWS and size <= BROADCAST_BYTES else df.hint("shuffle_hash")


def integral(df: DataFrame, name: str) -> Column:
    """The column as BIGINT; a ValueError where its type is not an integer one (or void, whose values are all NULL)."""
    kind = dict(df.dtypes)[next(c for c in df.columns if c.lower() == name.lower())]
    if kind not in ("tinyint", "smallint", "int", "bigint", "void"):
        raise ValueError(f"column {name} must hold integers, not {kind}")
    return F.col(name).cast("bigint")


def spare(df: DataFrame, *names: str) -> list[str]:
    """Names derived from ``names`` that no column of ``df`` has (case-insensitively)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        got = f"__{name}"
        while got.lower() in taken:
            got += "_"
        taken.add(got.lower())
        out.append(got)
    return out


def hash60(key: Column) -> Column:
    """60 bits of MD5, as a non-negative BIGINT: the same value in any engine."""
    return F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("bigint")


def word_count(text: Column) -> Column:
    """Number of runs without blanks; NULL counts 0."""
    return F.coalesce(F.regexp_count(text, F.lit("[^ \\t\\r\\n]+")), F.lit(0)).cast("bigint")


# ---- inside Python workers


def tidy(work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``work`` for mapInArrow, after which the worker, which waits for its next task, gives its free memory back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from work(batches)
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL(None).malloc_trim(0)
        except (AttributeError, OSError):  # another C library
            pass

    return run


def fixed(x: np.ndarray) -> pa.Array:
    """Each row of ``x`` as its bytes."""
    width = x.dtype.itemsize * (x.shape[1] if x.ndim > 1 else 1)
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(width), len(x), [None, pa.py_buffer(np.ascontiguousarray(x))]).cast(pa.binary())


def chunks(batches: Iterator[pa.RecordBatch], text: str, most: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cuts record batches so that each piece has about ``most`` bytes of text at most (whole rows, always one at least)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        part = (np.cumsum(sizes) - sizes) // most
        cuts = np.flatnonzero(np.diff(part)) + 1
        for a, b in zip([0, *cuts], [*cuts, batch.num_rows]):
            yield batch.slice(a, b - a)


def split_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Words of each row: (row of each word, code of each word, distinct words).  NULL has no words."""
    lists = pc.utf8_split_whitespace(pc.fill_null(texts, ""))
    rows = np.repeat(np.arange(len(lists), dtype=np.int32), np.diff(lists.offsets.to_numpy()))
    coded = lists.flatten().dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False)
    blank = np.flatnonzero(pc.equal(coded.dictionary, "").to_numpy(zero_copy_only=False))
    if len(blank):
        keep = codes != blank[0]
        rows, codes = rows[keep], codes[keep]
    return rows, codes, coded.dictionary


def hash_strings(words: pa.Array, seed: int = 0) -> np.ndarray:
    """64-bit hashes of distinct strings."""
    h = xxhash.xxh3_64_intdigest
    return np.fromiter((h(w, seed) for w in words.to_pylist()), np.uint64, len(words))


def mix64(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijective scrambler of 64-bit integers (splitmix64's finaliser)."""
    with np.errstate(over="ignore"):
        x = x.astype(np.uint64) + np.uint64((salt * 0x9E3779B97F4A7C15 + 0x9E3779B97F4A7C15) & (2**64 - 1))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))
