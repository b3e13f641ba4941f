"""Whether two strings are within an edit distance: cheap bounds first, then bit-parallel dynamic programming."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

#: Words of a band, at most: pairs that need a wider one are computed one by one.
WIDEST = 12

def _common(x: str, y: str) -> int:
    """Length of the common prefix, by bisection over slices."""
    low, high = 0, min(len(x), len(y))
    while low < high:
        mid = (low + high + 1) // 2
        if x[low:mid] == y[low:mid]:
            low = mid
        else:
            high = mid - 1
    return low


def _common_end(x: str, y: str) -> int:
    low, high = 0, min(len(x), len(y))
    while low < high:
        mid = (low + high + 1) // 2
        if x[len(x) - mid : len(x) - low] == y[len(y) - mid : len(y) - low]:
            low = mid
        else:
            high = mid - 1
    return low


def script_cost(x: str, y: str, most: int, ahead: int = 4) -> int:
    """The cost of one edit script found by walking over the words: never less than the distance; gives up above ``most``."""
    a, b = x.split(" "), y.split(" ")
    i = j = cost = 0
    while i < len(a) and j < len(b):
        if a[i] == b[j]:
            i, j = i + 1, j + 1
            continue
        for skip in range(1, 2 * ahead + 1):
            for p in range(max(0, skip - ahead), min(skip, ahead) + 1):
                q = skip - p
                if i + p < len(a) and j + q < len(b) and a[i + p] == b[j + q]:
                    break
            else:
                continue
            break
        else:
            p = q = 1
        left, right = sum(map(len, a[i : i + p])) + p, sum(map(len, b[j : j + q])) + q  # with one blank each
        cost += max(left, right) - (p > 0 and q > 0)
        if cost > most:
            return cost
        i, j = i + p, j + q
    left, right = sum(map(len, a[i:])) + len(a) - i, sum(map(len, b[j:])) + len(b) - j
    return cost + max(left, right)


def distance(x: str, y: str) -> int:
    """Levenshtein distance (Myers, 1999; the vertical differences of a column are the bits of one integer)."""
    if len(x) > len(y):
        x, y = y, x
    if not x:
        return len(y)
    place: dict[str, int] = {}
    for i, c in enumerate(x):
        place[c] = place.get(c, 0) | 1 << i
    full, top = (1 << len(x)) - 1, 1 << (len(x) - 1)
    up, down, score = full, 0, len(x)
    for c in y:
        eq = place.get(c, 0)
        zero = (((eq & up) + up) ^ up) | eq | down
        plus, minus = down | (full & ~(zero | up)), up & zero
        score += bool(plus & top) - bool(minus & top)
        plus, minus = (plus << 1 | 1) & full, minus << 1 & full
        up, down = minus | (full & ~(zero | plus)), plus & zero
    return score


def _stripped(x: str, y: str) -> tuple[str, str]:
    """Both without their common prefix and suffix."""
    n = _common(x, y)
    x, y = x[n:], y[n:]
    n = _common_end(x, y)
    return x[: len(x) - n], y[: len(y) - n]


def within(x: str, y: str, most: int) -> bool:
    """``distance(x, y) <= most``."""
    if abs(len(x) - len(y)) > most:
        return False
    x, y = _stripped(x, y)
    if max(len(x), len(y)) <= most:
        return True
    return script_cost(x, y, most) <= most or distance(x, y) <= most


#: Pairs of one band width that are computed together.
TOGETHER = 4096


class Verifier:
    """Which of many pairs are within an edit distance; those that no cheap bound decides wait until TOGETHER can be computed at once."""

    def __init__(self) -> None:
        self.open: dict[int, list[tuple[object, str, str, int]]] = {}

    def add(self, name: object, x: str, y: str, most: int) -> bool:
        """Whether the pair is surely within; others may be named by :meth:`ready` or :meth:`rest` later."""
        if abs(len(x) - len(y)) > most:
            return False
        x, y = _stripped(x, y)
        if max(len(x), len(y)) <= most or script_cost(x, y, most) <= most:
            return True
        width = -(-(2 * most + 1) // 64)
        if min(len(x), len(y)) <= most or width > WIDEST:
            return distance(x, y) <= most
        self.open.setdefault(width, []).append((name, x, y, most))
        return False

    def ready(self, least: int = TOGETHER) -> list:
        """Names of pairs that are within, of the widths of which ``least`` wait."""
        out = []
        for width in [w for w, rows in self.open.items() if len(rows) >= least]:
            rows = sorted(self.open.pop(width), key=lambda r: len(r[2]))
            for a in range(0, len(rows), TOGETHER):
                part = rows[a : a + TOGETHER]
                near = _banded([r[1] for r in part], [r[2] for r in part], np.array([r[3] for r in part]), width)
                out += [part[i][0] for i in np.flatnonzero(near)]
        return out

    def rest(self) -> list:
        return self.ready(1)


def within_all(xs: Sequence[str], ys: Sequence[str], most: Sequence[int]) -> np.ndarray:
    """:func:`within` of each pair."""
    work, out = Verifier(), np.zeros(len(xs), bool)
    for i, (x, y, m) in enumerate(zip(xs, ys, most)):
        out[i] = work.add(i, x, y, m)
    out[work.rest()] = True
    return out


def _codes(texts: Sequence[str]) -> np.ndarray:
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")


def _banded(xs: Sequence[str], ys: Sequence[str], most: np.ndarray, width: int) -> np.ndarray:
    """Whether each distance is within ``most``, for many pairs at once (Hyyro, 2003: bit-parallel along a diagonal band).

    A band has ``64 * width`` bits, at least ``2 * most + 1``; ``most`` is below both lengths.  The lowest bit row follows
    the diagonal until it meets the end of ``x``, then the score is followed along the last row.
    """
    n, m = np.array([len(x) for x in xs]), np.array([len(y) for y in ys])
    size, pairs, bits = len(xs), np.arange(len(xs)), 64 * width
    points = np.concatenate([_codes(xs), _codes(ys)])
    alphabet = np.flatnonzero(np.bincount(points))
    small = np.zeros(int(alphabet[-1]) + 1, np.uint8 if len(alphabet) < 254 else np.uint32)
    small[alphabet] = np.arange(2, len(alphabet) + 2)  # 0 and 1 match nothing
    codes = small[points]
    left = np.zeros((size, int(max(n.max(), m.max())) + 2 * bits), codes.dtype)
    right = np.ones((size, int(m.max())), codes.dtype)
    row = np.repeat(pairs, n)
    left[row, np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n) + (bits - 1 - most)[row]] = codes[: len(row)]
    codes = codes[len(row) :]
    row = np.repeat(pairs, m)
    right[row, np.arange(len(row)) - np.repeat(np.cumsum(m) - m, m)] = codes
    right = np.ascontiguousarray(right.T)
    one, top = np.uint64(1), np.uint64(63)
    first = (bits - 1 - most)[None, :] - 64 * np.arange(width)[:, None]  # bits of a word from here on are set
    up = np.where(first >= 64, np.uint64(0), np.where(first <= 0, ~np.uint64(0), ~np.uint64(0) << np.clip(first, 0, 63).astype(np.uint64)))
    down = np.zeros((width, size), np.uint64)
    score, turn, limit = most.copy(), n - most, 2 * most + m - n
    live, result, gone = pairs, np.zeros(size, bool), np.zeros(size, bool)
    for j in range(int(m.max())):
        equal = np.packbits(left[:, j : j + bits] == right[j][:, None], axis=1, bitorder="little").view("<u8").T
        summed, carry = np.empty_like(up), None
        for w in range(width):
            a = equal[w] & up[w]
            s = a + up[w]
            over = s < a
            if carry is not None:
                t = s + carry
                over |= t < s
                s = t
            summed[w], carry = s, over.astype(np.uint64)
        zero = (summed ^ up) | equal | down
        plus, minus = down | ~(zero | up), zero & up
        along = j < turn
        score = score + np.where(along, (zero[-1] >> top) == 0, 0)
        if not along.all():
            bit = np.clip(bits - 2 - (j - turn), 0, bits - 1)
            at, shift = (bit >> 6), (bit & 63).astype(np.uint64)
            cols = np.arange(len(live))
            step = (plus[at, cols] >> shift & one).astype(np.int64) - (minus[at, cols] >> shift & one).astype(np.int64)
            score = score + np.where(along, 0, step)
        slid = zero >> one
        if width > 1:
            slid[:-1] |= zero[1:] << top
        up, down = minus | ~(slid | plus), slid & plus
        ended = m == j + 1
        result[live[ended]] = score[ended] <= most[ended]
        gone |= ended | (along & (score > limit))
        if j % 8 == 7 and np.count_nonzero(gone) * 6 > len(live):  # else they are carried on, to no effect
            keep = ~gone
            if not keep.any():
                break
            gone = gone[keep]
            live, left, right, up, down = live[keep], left[keep], np.ascontiguousarray(right[:, keep]), np.ascontiguousarray(up[:, keep]), np.ascontiguousarray(down[:, keep])
            n, m, most, score, turn, limit = n[keep], m[keep], most[keep], score[keep], turn[keep], limit[keep]
    return result
