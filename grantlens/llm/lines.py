"""Normal forms, SimHash fingerprints and word-trigram sketches of many lines at once, over code points in numpy."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa

from .common import mix64
from .fingerprints import LANES

SKETCHES = 8
_BLANK, _LETTER, _DIGIT, _BREAK = 0, 1, 2, 3


@lru_cache(1)
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """(class << 24 | lower case, random value) of each code point of the basic plane; all digits are 0."""
    kind, low = np.zeros(1 << 16, np.uint32), np.arange(1 << 16, dtype=np.uint32)
    for i in range(1 << 16):
        kind[i], low[i] = _of(chr(i))
    kind[48:58], kind[10] = _DIGIT, _BREAK
    low[48:58] = 48
    value = mix64(np.arange(1 << 16).astype(np.uint64), 99)
    value[[10, 32]] = 0
    return kind << np.uint32(24) | low, value


def _of(c: str) -> tuple[int, int]:
    small = c.lower()
    return (_LETTER if unicodedata.category(c)[0] in "LNM" else _BLANK), ord(small) if len(small) == 1 else ord(c)


def _normal_points(lines: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(code points of the normal lines with a break after each, where words start, line of each word)."""
    table, _ = _tables()
    flat = np.frombuffer(("\n".join(lines) + "\n").encode("utf-32-le", "surrogatepass"), "<u4")
    both = table.take(flat, mode="clip")
    if int(flat.max()) >= 1 << 16:
        at = np.flatnonzero(flat >= 1 << 16)
        far, back = np.unique(flat[at], return_inverse=True)
        both[at] = np.array([k << 24 | c for k, c in map(_of, map(chr, far))], np.uint32)[back]
    digit = both >> np.uint32(24) == _DIGIT
    both = both[np.r_[True, ~(digit[1:] & digit[:-1])]]  # of a run of digits one stays
    kind, point = (both >> np.uint32(24)).astype(np.uint8), both & np.uint32(0xFFFFFF)
    keep = kind != _BLANK
    word = keep & (kind != _BREAK)
    starts = word.copy()
    starts[1:] = word[1:] > word[:-1]
    at, breaks = np.flatnonzero(starts), np.flatnonzero(kind == _BREAK)
    owner = np.repeat(np.arange(len(breaks)), np.diff(np.searchsorted(at, breaks), prepend=0))
    gap = at[np.r_[False, owner[1:] == owner[:-1]]] - 1 if len(at) else at  # the one blank before each word but the first of a line
    keep[gap], point[gap] = True, 32
    place = np.cumsum(keep, dtype=np.int32 if len(keep) < 1 << 31 else np.int64)[at] - 1
    return point[keep], place, owner


class _Powers:
    """Powers of an odd number modulo 2**64, as many as were asked for so far, and those of its inverse."""

    base = 0x9E3779B97F4A7C15
    up, down = np.ones(1, np.uint64), np.ones(1, np.uint64)

    @classmethod
    def of(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            with np.errstate(over="ignore"):
                cls.up, cls.down = (np.cumprod(np.r_[np.uint64(1), np.full(n + n // 4, b, np.uint64)]) for b in (cls.base, pow(cls.base, -1, 1 << 64)))
        return cls.up, cls.down


def normal_lines(lines: pa.Array) -> pa.Array:
    """Lower case, every run of ASCII digits one 0, every run of other characters than letters, numbers and marks one blank."""
    if not len(lines):
        return pa.array([], pa.string())
    points, _, _ = _normal_points(["" if x is None else x for x in lines.to_pylist()])
    return pa.array(points.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass").split("\n")[:-1], pa.string())


def features(lines: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(normal lines, (n, 2) uint64 fingerprints, (n, SKETCHES) uint32 sketches) of lines without line breaks.

    A fingerprint is the 128-bit SimHash of the set of words.  Sketches are one-permutation minima: the hashes of a
    line's word trigrams, two marks at either end included, fall into SKETCHES bins, and each bin keeps its least; 0 is an
    empty bin.  Lines without words have zeros.
    """
    points, start, owner = _normal_points(lines)
    normal = points.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass").split("\n")[:-1]
    n = len(lines)
    fp, sketch = np.zeros((n, 2), np.uint64), np.zeros((n, SKETCHES), np.uint32)
    if not len(start):
        return normal, fp, sketch
    up, down = _Powers.of(len(points))
    with np.errstate(over="ignore"):
        value = _tables()[1].take(points & 0xFFFF)  # 0 for blanks and breaks
        words = mix64(np.add.reduceat(value * up[: len(points)], start) * down[start])
        # SimHash over the set of words
        key = np.sort(owner.astype(np.uint64) << np.uint64(40) | words >> np.uint64(24))
        key = key[np.r_[True, key[1:] != key[:-1]]]
        row = (key >> np.uint64(40)).astype(np.int64)
        seed = key & np.uint64((1 << 40) - 1)
        _simhash(fp, row, seed)
        # trigrams with two marks on each side of a line: word count + 2 of them
        count = np.bincount(owner, minlength=n)
        full = np.flatnonzero(count)
        size = count[full] + 4
        ends = np.cumsum(size)
        padded = np.full(int(ends[-1]), 0x1234567, np.uint64)
        inner = np.ones(len(padded), bool)
        for k in (0, 1):
            inner[ends - size + k] = False
            inner[ends - 1 - k] = False
        padded[inner] = words
        grams = mix64(padded[:-2] * np.uint64(3) + mix64(padded[1:-1] * np.uint64(5) + mix64(padded[2:] * np.uint64(7))))
        line = np.repeat(full, size)
        whole = line[:-2] == line[2:]
        grams, line = grams[whole], line[:-2][whole].astype(np.uint64)
    key = np.sort(line << np.uint64(40) | grams >> np.uint64(24))  # the three highest bits of a hash are its bin
    first = key[np.r_[True, (key[1:] >> np.uint64(37)) != (key[:-1] >> np.uint64(37))]]
    sketch[(first >> np.uint64(40)).astype(np.int64), (first >> np.uint64(37) & np.uint64(SKETCHES - 1)).astype(np.int64)] = (first & np.uint64(0xFFFFFFFF)).astype(np.uint32) | np.uint32(1)
    return normal, fp, sketch


def _simhash(out: np.ndarray, row: np.ndarray, seed: np.ndarray) -> None:
    """Sets ``out`` (n, words) to the SimHash of the seeds of each row; rows ascend."""
    heads = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
    place = np.arange(len(row)) - np.repeat(heads, np.diff(np.r_[heads, len(row)]))
    starts = np.flatnonzero(place % 255 == 0)  # a byte lane counts to 255
    words = out.shape[1]
    lanes = np.empty((len(starts), 8 * words), np.uint64)
    for w in range(words):
        octets = mix64(seed, w + 1).view(np.uint8).reshape(-1, 8)
        for k in range(8):
            lanes[:, 8 * w + k] = np.add.reduceat(LANES[octets[:, k]], starts)
    counts = lanes.view(np.uint8).reshape(len(starts), 64 * words)
    owner = row[starts]
    firsts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
    if len(firsts) != len(owner):
        counts = np.add.reduceat(counts.astype(np.uint32), firsts, axis=0)
    total = np.bincount(row)[owner[firsts]]
    out[owner[firsts]] = np.packbits(2 * counts.astype(np.int32) > total[:, None], axis=1, bitorder="little").view("<u8")
