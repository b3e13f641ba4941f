"""SimHash fingerprints and the search for all close ones."""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import hash_strings, mix64, split_words, tidy

PUNCTUATION = string.punctuation + "«»“”‘’„…–—¿¡"
#: Bit j of a byte moved to byte lane j of a 64-bit integer, so that adding integers counts eight bits at once.
LANES = np.packbits(np.zeros((256, 8, 8), np.uint8), axis=2)[:, :, 0].astype(np.uint8)
for _b in range(256):
    for _j in range(8):
        LANES[_b, _j] = _b >> _j & 1
LANES = LANES.view("<u8")[:, 0]
#: Fingerprints in one block of the comparison of all pairs, at least, and blocks at most.
BLOCK_ROWS, MOST_BLOCKS = 1 << 15, 32


def normal_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, code, hash of each code) of lower-case words without outer punctuation; words of punctuation alone are dropped."""
    rows, codes, words = split_words(texts)
    if not len(words):
        return rows, codes, np.zeros(0, np.uint64)
    plain = pc.utf8_trim(pc.utf8_lower(words), characters=PUNCTUATION)
    hashes, back = np.unique(hash_strings(plain), return_inverse=True)
    codes = back[codes]
    empty = np.searchsorted(hashes, hash_strings(pa.array([""]))[0])
    if empty < len(hashes) and hashes[empty] == hash_strings(pa.array([""]))[0]:
        keep = codes != empty
        rows, codes = rows[keep], codes[keep]
    return rows, codes, hashes


def simhash(rows: np.ndarray, codes: np.ndarray, hashes: np.ndarray, n_rows: int, words: int) -> np.ndarray:
    """(n_rows, words) uint64: SimHash over the set of codes of each row, ``64 * words`` bits.  Rows ascend; one without features is 0.

    A bit is set where more than half of the features have it.
    """
    out = np.zeros((n_rows, words), np.uint64)
    if not len(rows):
        return out
    pair = np.unique(rows.astype(np.int64) << 32 | codes.astype(np.int64))
    row, code = (pair >> 32).astype(np.int32), (pair & 0xFFFFFFFF).astype(np.int32)
    place = np.arange(len(row)) - np.searchsorted(row, row)  # within the row
    starts = np.flatnonzero(place % 255 == 0)  # a byte lane counts to 255
    lanes = np.empty((len(starts), 8 * words), np.uint64)
    for w in range(words):
        octets = mix64(hashes, w + 1).view(np.uint8).reshape(-1, 8)
        for k in range(8):
            lanes[:, 8 * w + k] = np.add.reduceat(LANES[octets[:, k]][code], starts)
    counts = lanes.view(np.uint8).reshape(len(starts), 64 * words)
    owner = row[starts]
    firsts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
    if len(firsts) != len(owner):
        counts = np.add.reduceat(counts.astype(np.uint32), firsts, axis=0)
    total = np.bincount(row, minlength=n_rows)[owner[firsts]]
    bits = 2 * counts.astype(np.int32) > total[:, None]
    out[owner[firsts]] = np.packbits(bits, axis=1, bitorder="little").view("<u8")
    return out


def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).sum(axis=1, dtype=np.int32)


def near_pairs(a: np.ndarray, b: np.ndarray, most: int, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(i, j, bits) of all columns i of ``a`` and j of ``b`` that differ in ``most`` bits at most; ``i < j`` only where both are the ``same``.

    ``a`` and ``b`` are (words, n) fingerprints.  The first words are compared for every pair: their distance is a lower
    bound of the whole one, which is computed where the bound doesn't exceed ``most``.
    """
    first = min(len(a), 3)  # their distance fits a byte
    rows, columns = 16, 4096
    both, bits, more, near = (np.empty((rows, columns), t) for t in (np.uint64, np.uint8, np.uint8, bool))
    for at in range(0, a.shape[1], rows):
        x = a[:, at : at + rows]
        n = x.shape[1]
        for low in range(at if same else 0, b.shape[1], columns):
            y = b[:, low : low + columns]
            cut = np.s_[:n, : y.shape[1]]
            np.bitwise_count(np.bitwise_xor(x[0, :, None], y[0], out=both[cut]), out=bits[cut])
            for w in range(1, first):
                np.bitwise_count(np.bitwise_xor(x[w, :, None], y[w], out=both[cut]), out=more[cut])
                np.add(bits[cut], more[cut], out=bits[cut])
            if not np.less_equal(bits[cut], most, out=near[cut]).any():
                continue
            hit = np.flatnonzero(near[cut])
            i, j = hit // y.shape[1] + at, hit % y.shape[1] + low
            if same:
                i, j = i[i < j], j[i < j]
            whole = np.bitwise_count(a[:, i] ^ b[:, j]).sum(axis=0, dtype=np.int32)
            yield i[whole <= most], j[whole <= most], whole[whole <= most]


def all_pairs(fps: DataFrame, n_rows: int, words: int, most: int) -> DataFrame:
    """(a, b, bits), a <= b: every pair of the ``n_rows`` rows of ``fps`` (node BIGINT, fp BINARY) that differs in ``most`` bits at most.

    Nothing is left out: rows are dealt to blocks by their node, and each pair of blocks, and each block with itself, is
    one task that compares all pairs between them.  Fingerprints are moved in binary, each once for a block; the work
    is quadratic in the rows.
    """
    n_blocks = -(-max(1, n_rows) // max(BLOCK_ROWS, -(-n_rows // MOST_BLOCKS)))
    tiles = [(p, q) for p in range(n_blocks) for q in range(p, n_blocks)]
    number = {pq: k for k, pq in enumerate(tiles)}
    width = 8 * words

    def block_of(node: np.ndarray) -> np.ndarray:
        return (mix64(node) % np.uint64(n_blocks)).astype(np.int64)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            node = batch.column("node").to_numpy()
            fp = np.frombuffer(b"".join(batch.column("fp").to_pylist()), np.uint8).reshape(-1, width)
            to = block_of(node)
            tile, blob = [], []
            for p in np.unique(to).tolist():
                at = np.flatnonzero(to == p)
                bytes_ = np.concatenate([node[at].view(np.uint8).reshape(-1, 8), fp[at]], axis=1).tobytes()
                tile += [number[min(p, q), max(p, q)] for q in range(n_blocks)]
                blob += [bytes_] * n_blocks
            yield pa.RecordBatch.from_arrays([pa.array(tile, pa.int32()), pa.array(blob, pa.binary())], ["tile", "block"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[bytes]] = {}
        for batch in batches:
            for k, x in zip(batch.column("tile").to_pylist(), batch.column("block").to_pylist()):
                if k not in held and held:
                    yield from search(*held.popitem())
                held.setdefault(k, []).append(x)
        if held:
            yield from search(*held.popitem())

    def search(tile: int, blocks: list[bytes]) -> Iterator[pa.RecordBatch]:
        p, q = tiles[tile]
        raw = np.frombuffer(b"".join(blocks), np.uint8).reshape(-1, 8 + width)
        node = np.ascontiguousarray(raw[:, :8]).view("<i8")[:, 0]
        fp = np.ascontiguousarray(np.ascontiguousarray(raw[:, 8:]).view("<u8").reshape(-1, words).T)
        to = block_of(node)
        left, right = np.flatnonzero(to == p), np.flatnonzero(to == q)
        found: list[tuple] = []
        n = 0
        for i, j, bits in near_pairs(fp[:, left], fp[:, right], most, p == q):
            found.append((node[left[i]], node[right[j]], bits))
            n += len(bits)
            if n > 1 << 16 or len(found) > 1 << 12:
                yield pairs(found)
                found, n = [], 0
        if found:
            yield pairs(found)

    def pairs(found: list[tuple]) -> pa.RecordBatch:
        a, b, bits = (np.concatenate(x) for x in zip(*found))
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b)), pa.array(bits)], ["a", "b", "bits"])

    spread_out = fps.select("node", "fp").mapInArrow(tidy(spread), "tile int, block binary")
    together = spread_out.repartitionById(len(tiles), "tile").sortWithinPartitions("tile")
    return together.mapInArrow(tidy(compare), "a bigint, b bigint, bits int")
