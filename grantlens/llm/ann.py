"""Nearest neighbours by randomly rotated one-bit codes with error bounds."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import integral, materialise, tidy

K = 10
BITS = 256  # bits of a code, at least: shorter vectors are padded by zeros before they are rotated
EPSILON = 2.4  # half-width of the bounds in standard errors: a true neighbour is lost with a chance of under 1 %
LEVELS = 4  # bits of a query's coordinate
QUERY_ROWS, CODE_ROWS = 16_384, 16_384  # rows of a block that is moved
STEP_QUERIES, STEP_ROWS = 128, 8192  # of one step inside a task


def rotation(dim: int, bits: int, seed: int = 7) -> np.ndarray:
    """(dim, width): the first rows of a random orthogonal matrix; the width is a multiple of 64."""
    width = -(-max(dim, bits) // 64) * 64
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((width, width)))
    return (q * np.sign(np.diag(r)))[:dim].astype(np.float32)


def encode(x: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(packed bits, scale, error) of each row.

    With o the rotated unit vector and s its signs over sqrt(width), <s, q> / <s, o> estimates <o, q> without bias, and
    its standard error is ``|q| * sqrt((1 - <s,o>^2) / <s,o>^2 / (width - 1))``.  ``scale`` is |x| / <s, o>.
    """
    norm = np.linalg.norm(x.astype(np.float64), axis=1)
    o = (x / np.maximum(norm, 1e-30)[:, None]).astype(np.float32) @ turn
    width = turn.shape[1]
    align = np.maximum(np.abs(o).sum(axis=1) / np.sqrt(width), 1e-6)
    error = norm * np.sqrt(np.maximum(0.0, 1 - align**2) / align**2 / max(1, width - 1))
    return np.packbits(o > 0, axis=1, bitorder="little").view("<u8"), (norm / align).astype(np.float32), error.astype(np.float32)


def planes(q: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bit planes, low, step, sum) of each rotated query: coordinates are ``low + step * u`` with u of LEVELS bits."""
    turned = q @ turn
    low = turned.min(axis=1)
    step = np.maximum((turned.max(axis=1) - low) / (2**LEVELS - 1), 1e-30)
    u = np.rint((turned - low[:, None]) / step[:, None]).astype(np.uint8)
    bits = np.stack([np.packbits(u >> j & 1, axis=1, bitorder="little").view("<u8") for j in range(LEVELS)], axis=1)
    return bits, low, step, turned.sum(axis=1)


def bit_products(codes: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """(queries, codes): the sum of u over the set bits of each code; ands and population counts of packed words only."""
    total = np.zeros((len(bits), len(codes)), np.uint32)
    for w in range(codes.shape[1]):
        word = np.ascontiguousarray(codes[:, w])[None, :]
        for j in range(LEVELS):
            total += np.bitwise_count(word & bits[:, j, w, None]).astype(np.uint32) << np.uint32(j)
    return total


class Best:
    """The ``k`` best neighbours so far of each query of a block."""

    def __init__(self, n: int, k: int):
        self.k, self.value, self.ids = k, np.full((n, k), -np.inf), np.full((n, k), -1, np.int64)

    def add(self, at: slice, row: np.ndarray, ids: np.ndarray, value: np.ndarray) -> None:
        """Merges exact values into the rows ``at``; ties go to the smaller id, a neighbour counts once."""
        old_value, old_ids = self.value[at], self.ids[at]
        i, j = np.nonzero(np.isfinite(old_value))
        row, ids, value = np.concatenate([i, row]), np.concatenate([old_ids[i, j], ids]), np.concatenate([old_value[i, j], value])
        order = np.lexsort((ids, -value, row))
        row, ids, value = row[order], ids[order], value[order]
        new = np.r_[True, (row[1:] != row[:-1]) | (ids[1:] != ids[:-1])][: len(row)]
        row, ids, value = row[new], ids[new], value[new]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        top = place < self.k
        old_value[:], old_ids[:] = -np.inf, -1
        old_value[row[top], place[top]], old_ids[row[top], place[top]] = value[top], ids[top]


def search_block(q_id: np.ndarray, q: np.ndarray, ids: np.ndarray, x: np.ndarray, codes: tuple[np.ndarray, np.ndarray, np.ndarray], turn: np.ndarray, best: Best, epsilon: float) -> None:
    """Takes the vectors of one block into ``best``, each query itself excluded.

    Inner products are estimated from the packed codes.  Those with the ``k`` best estimates are looked at exactly first;
    then every other whose upper bound reaches the k-th best exact value.
    """
    packed, scale, error = codes
    width, k = turn.shape[1], best.k
    for a in range(0, len(q), STEP_QUERIES):
        at = slice(a, a + STEP_QUERIES)
        bits, low, step, total = planes(q[at], turn)
        norm = np.linalg.norm(q[at].astype(np.float64), axis=1).astype(np.float32)
        spread = 0.41 * step  # standard error by the queries' rounding
        for b in range(0, len(ids), STEP_ROWS):
            part = slice(b, b + STEP_ROWS)
            ones = np.bitwise_count(packed[part]).sum(axis=1).astype(np.float32)
            inner = (2 * (low[:, None] * ones + step[:, None] * bit_products(packed[part], bits)) - total[:, None]) / np.float32(np.sqrt(width))
            guess = inner * scale[part]
            other = q_id[at, None] != ids[part]
            guess[~other] = -np.inf
            most = guess + np.float32(epsilon) * (norm[:, None] * error[part] + spread[:, None] * scale[part])
            first = np.argpartition(guess, -k, axis=1)[:, -k:] if guess.shape[1] > k else np.broadcast_to(np.arange(guess.shape[1]), guess.shape)
            row, col = np.repeat(np.arange(len(guess)), first.shape[1]), first.ravel()
            row, col = row[other[row, col]], col[other[row, col]]
            self_value = np.einsum("nd,nd->n", q[at][row].astype(np.float64), x[part][col].astype(np.float64))
            best.add(at, row, ids[part][col], self_value)
            done = np.zeros(guess.shape, bool)
            done[row, col] = True
            row, col = np.nonzero((most >= best.value[at, -1][:, None] - 1e-6) & other & ~done)
            for r in range(0, len(row), 1 << 16):
                i, j = row[r : r + (1 << 16)], col[r : r + (1 << 16)]
                best.add(at, i, ids[part][j], np.einsum("nd,nd->n", q[at][i].astype(np.float64), x[part][j].astype(np.float64)))


def nearest(vectors: DataFrame, queries: DataFrame | None = None, k: int = K, id_col: str = "vec_id", vector_col: str = "embedding", bits: int = BITS, epsilon: float = EPSILON) -> DataFrame:
    """(id, rank, neighbour, similarity): for every query the ``k`` of ``vectors`` of largest inner product but itself.

    ``queries`` (None: all of ``vectors``) has the same columns.  Every vector is encoded once, and every query meets
    every code: no cell is skipped, so recall depends on ``epsilon`` alone.  Blocks of queries meet blocks of codes in one
    task each, without a shuffle; a task keeps the ``k`` best of each of its queries over all blocks that it sees, and
    these few rows are merged by one ranking.

    Ties go to the smaller id.  Rows with a NULL id, a NULL or empty vector or a NULL, NaN or infinity in it are left out;
    repeated ids are one vector, the smallest; vectors of unlike length and ids that are not integers raise a ValueError;
    fewer than ``k`` others give fewer rows; an empty table gives none.  Other columns play no part.
    """

    def valid(df: DataFrame) -> DataFrame:
        one = df.select(integral(df, id_col).alias("id"), F.col(vector_col).cast("array<float>").alias("v"))
        inf = float("inf")
        one = one.filter("id is not null and size(v) > 0").filter(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (x > -inf) & (x < inf)))
        return one.groupBy("id").agg(F.min("v").alias("v"))

    each = materialise(valid(vectors), "ann-vectors")
    asked = each if queries is None else materialise(valid(queries), "ann-queries")
    low, high = each.select("v").unionByName(asked.select("v")).agg(F.min(F.size("v")), F.max(F.size("v"))).first()
    if low != high:
        raise ValueError("vectors of unlike length")
    dim = low or 1

    def blocks(df: DataFrame, rows: int, name: str, with_codes: bool) -> DataFrame:
        names = [f"{name}_id", f"{name}_v"] + (["packed", "scale", "error"] if with_codes else [])

        def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            turn, ids, values = rotation(dim, bits), [], []

            def out() -> pa.RecordBatch:
                i, v = np.concatenate(ids), np.concatenate(values).reshape(-1, dim)
                made = [i, v, *(encode(v, turn) if with_codes else ())]
                return pa.RecordBatch.from_arrays([pa.array([c.tobytes()], pa.binary()) for c in made], names)

            for batch in batches:
                for a in range(0, batch.num_rows, rows):
                    part = batch.slice(a, rows)
                    if sum(map(len, ids)) + part.num_rows > rows:
                        yield out()
                        ids, values = [], []
                    ids.append(part.column("id").to_numpy())
                    values.append(part.column("v").flatten().to_numpy(zero_copy_only=False).astype("<f4"))
            if sum(map(len, ids)):
                yield out()

        return materialise(df.mapInArrow(tidy(make), ", ".join(f"{n} binary" for n in names)), f"ann-{name}")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = rotation(dim, bits)
        now, q_id, q, best = b"", np.zeros(0, np.int64), np.zeros((0, dim), np.float32), Best(0, k)

        def out() -> pa.RecordBatch:
            i, j = np.nonzero(np.isfinite(best.value))
            return pa.RecordBatch.from_arrays([pa.array(q_id[i]), pa.array(best.ids[i, j]), pa.array(best.value[i, j])], ["id", "neighbour", "similarity"])

        for batch in batches:
            for one in range(batch.num_rows):
                row = {c: batch.column(c)[one].as_buffer() for c in batch.schema.names}
                if row["q_id"].to_pybytes() != now:  # the blocks of codes follow one another for each block of queries
                    if len(q_id):
                        yield out()
                    now = row["q_id"].to_pybytes()
                    q_id, q = np.frombuffer(now, "<i8"), np.frombuffer(row["q_v"].to_pybytes(), "<f4").reshape(-1, dim)
                    best = Best(len(q_id), k)
                ids, x = np.frombuffer(row["x_id"], "<i8"), np.frombuffer(row["x_v"], "<f4").reshape(-1, dim)
                codes = np.frombuffer(row["packed"], "<u8").reshape(len(ids), -1), np.frombuffer(row["scale"], "<f4"), np.frombuffer(row["error"], "<f4")
                search_block(q_id, q, ids, x, codes, turn, best, epsilon)
        if len(q_id):
            yield out()

    pairs = blocks(asked, QUERY_ROWS, "q", False).crossJoin(blocks(each, CODE_ROWS, "x", True))
    found = materialise(pairs.mapInArrow(tidy(search), "id bigint, neighbour bigint, similarity double"), "ann-found")
    rank = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("similarity"), "neighbour"))
    ranked = found.withColumn("rank", rank).filter(F.col("rank") <= k)
    return ranked.select(F.col("id").alias(id_col), "rank", "neighbour", F.round("similarity", 5).alias("similarity"))
