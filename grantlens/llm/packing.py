"""Packing documents into windows with lexical neighbours (BM25)."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, drop_path, fresh_path, integral, hash_strings, materialise, split_words, tidy

WINDOW = 2048  # tokens (words)
#: Tokens of the pieces of one shard, about, and pieces of one block of the index at most.
SHARD_TOKENS = 1_000_000
SHARD_PIECES, BLOCK_PIECES = 1 << 16, 8_000
#: Neighbours of one size class that the driver gets in one round, of all seeds and blocks, and that it gets for one seed.
NEIGHBOURS, KEEP = 400_000, 256
#: Words of the smallest pieces that the driver holds, to score these itself where a list of a window's last ones ends.
SMALL_WORDS = 1_500_000
#: Seeds are asked ahead as long as their windows will take a small part of the free pieces: one of so many is a seed asked.
AHEAD = 20
#: Pieces of similar size whose best score is looked at first, and seeds that are scored together.
GROUP, TOGETHER = 16, 32
#: Terms in so many of a block's free pieces are summed as columns of a matrix, the others by postings.
DENSE = 1 / 6
K1, B = 1.2, 0.75


def piece_table(docs: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """(part, local, id, tie, start, n_tokens, terms) of each piece.

    A document of more than ``window`` words is cut after every ``window``; full pieces need no neighbours and have NULL
    ``local`` and terms.  The last piece has its distinct words as ``terms`` (uint32 hashes, then uint16 counts) and is
    named by ``part``, the task that made it, and ``local``, from 0 in each.
    """

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = 0
        for part in chunks(batches, "text"):
            rows, codes, words = split_words(part.column("text"))
            n = np.bincount(rows, minlength=part.num_rows) if len(rows) else np.zeros(part.num_rows, np.int64)
            tail = np.where(n > 0, (n - 1) // window * window, 0)  # start of the last piece
            place = np.arange(len(rows)) - (np.cumsum(n) - n)[rows]
            mine = place >= tail[rows]
            hashes = (hash_strings(words) >> np.uint64(32)).astype(np.uint32)
            pair, count = np.unique(rows[mine].astype(np.int64) << 32 | hashes[codes[mine]].astype(np.int64), return_counts=True)
            row, term = pair >> 32, (pair & 0xFFFFFFFF).astype(np.uint32)
            ends = np.searchsorted(row, np.arange(part.num_rows + 1))
            count = count.astype(np.uint16)
            out: list[list] = [[], [], [], []]
            owner = []
            for i in range(part.num_rows):
                a, b = ends[i], ends[i + 1]
                for start in range(0, int(tail[i]), window):
                    owner.append(i), out[0].append(start), out[1].append(window), out[2].append(None), out[3].append(None)
                owner.append(i), out[0].append(int(tail[i])), out[1].append(int(n[i] - tail[i])), out[2].append(term[a:b].tobytes() + count[a:b].tobytes()), out[3].append(seen + i)
            seen += part.num_rows
            yield pa.RecordBatch.from_arrays(
                [pa.array([TaskContext.get().partitionId()] * len(owner), pa.int32()), pa.array(out[3], pa.int64()), part.column("id").take(pa.array(owner, pa.int64())), part.column("tie").take(pa.array(owner, pa.int64())), pa.array(out[0], pa.int64()), pa.array(out[1], pa.int32()), pa.array(out[2], pa.binary())],
                ["part", "local", "id", "tie", "start", "n_tokens", "terms"],
            )

    text = F.col(text_col).cast("string")
    one = docs.select(integral(docs, id_col).alias("id"), F.conv(F.substring(F.md5(F.coalesce(text, F.lit(""))), 1, 15), 16, 10).cast("bigint").alias("tie"), text.alias("text"))
    return one.mapInArrow(tidy(make), "part int, local bigint, id bigint, tie bigint, start bigint, n_tokens int, terms binary")


FOUND = np.dtype([("score", "<i8"), ("num", "<i8"), ("size", "<i4")])


def size_classes(window: int) -> np.ndarray:
    """Bounds of the nested size classes: 0, 1, 2, 4 and so on up to ``window``."""
    return np.array([0, *(1 << k for k in range(window.bit_length()) if 1 << k < window), window])


def best_of(found: np.ndarray, classes: np.ndarray, keep: int) -> np.ndarray:
    """``found`` by score, ties by number: those among the first ``keep`` of some size class."""
    found = found[np.lexsort((found["num"], -found["score"]))]
    inside = found["size"][None, :] <= classes[:, None]
    return found[(inside & (np.cumsum(inside, axis=1) <= keep)).any(axis=0)]


def exact_scale(window: int, n: int) -> float:
    """A power of two, by which weights are whole numbers whose sums a float holds exactly: scores depend on no order of adding."""
    return 2.0 ** (52 - math.ceil(math.log2(window * (K1 + 1) * math.log(2 * n + 2))))


def postings(nums: np.ndarray, terms: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, ...]:
    """(vocabulary, postings of each of its terms, document, count): a block of up to 65,536 pieces, inverted."""
    doc, term = np.repeat(np.arange(len(nums)), [len(x) for x in terms]).astype(np.uint16), np.concatenate([np.zeros(0, np.uint32), *terms])
    order = np.argsort(term, kind="stable")
    vocabulary, lengths = np.unique(term, return_counts=True)
    return vocabulary, lengths.astype(np.uint32), doc[order], np.concatenate([np.zeros(0, np.uint16), *counts])[order]


class Block:
    """The free pieces of one block of the index, ready to be scored; ``known`` (ascending) are the terms that will be asked for."""

    def __init__(self, nums: np.ndarray, sizes: np.ndarray, index: tuple[np.ndarray, ...], free: np.ndarray, known: np.ndarray, idf: np.ndarray, mean: float, classes: np.ndarray, scale: float, dense: float = DENSE):
        vocabulary, lengths, doc, count = index
        self.scale, self.known, self.classes, some = scale, known, classes, np.flatnonzero(free)
        some = some[np.argsort(sizes[some], kind="stable")]
        # columns by size; each class is filled up to whole groups
        held = np.diff(np.searchsorted(sizes[some], classes, "right"), prepend=0)
        self.groups = np.cumsum(-(-held // GROUP))  # up to each class
        self.width = int(self.groups[-1]) * GROUP
        shift = np.r_[0, self.groups[:-1]] * GROUP - (np.cumsum(held) - held)
        column = np.arange(len(some)) + np.repeat(shift, held)
        self.num, self.size = np.full(self.width, -1, np.int64), np.repeat(classes, np.diff(self.groups, prepend=0) * GROUP)
        self.num[column], self.size[column] = nums[some], sizes[some]
        self.class_of = np.repeat(np.arange(len(classes)), np.diff(self.groups, prepend=0))
        place = np.full(len(nums), -1, np.int64)
        place[some] = column
        at = np.minimum(np.searchsorted(known, vocabulary), max(0, len(known) - 1))
        asked = known[at] == vocabulary if len(known) else np.zeros(len(vocabulary), bool)
        mark = np.repeat(asked, lengths) & free[doc]
        code, doc, tf = np.repeat(at.astype(np.int32), lengths)[mark], doc[mark], count[mark].astype(np.float64)
        n, weight = np.bincount(code, minlength=len(known)), idf[code]
        del mark, code
        weight *= tf  # in place: a block's postings are most of a worker's memory
        weight *= K1 + 1
        tf += (K1 * (1 - B + B * sizes / max(mean, 1e-9)))[doc]
        weight /= tf
        del tf
        weight *= scale
        np.rint(weight, out=weight)
        doc = place[doc]
        self.start = np.r_[0, np.cumsum(n)]
        dense = np.flatnonzero(n > max(8.0, dense * len(some)))
        self.dense = np.full(len(known), -1)
        self.dense[dense] = np.arange(len(dense))
        self.matrix = np.zeros((len(dense), self.width))
        for k, x in enumerate(dense.tolist()):
            a, b = self.start[x], self.start[x + 1]
            self.matrix[k, doc[a:b]] = weight[a:b]
        self.doc, self.weight, self.filled = doc, weight, n > 0

    def search(self, asked: list[np.ndarray], rooms: np.ndarray, keep: int) -> tuple[np.ndarray, np.ndarray]:
        """(pieces found for each query, all of them by score): the best ``keep`` of every size class, of those that score and fit.

        The ``keep``-th largest of the groups' best is a bound that ``keep`` pieces reach; what reaches it is looked at.
        """
        if not self.width:
            return np.zeros(len(asked), np.int32), np.zeros(0, FOUND)
        counts, out = [], []
        for low in range(0, len(asked), TOGETHER):
            some = asked[low : low + TOGETHER]
            take = np.zeros((len(some), len(self.matrix)))
            for i, want in enumerate(some):
                take[i, self.dense[want[self.dense[want] >= 0]]] = 1
            score = take @ self.matrix
            for i, want in enumerate(some):
                want = want[self.filled[want] & (self.dense[want] < 0)]
                if len(want):  # one seed's postings at a time: they stay in the cache
                    cuts = list(zip(self.start[want].tolist(), self.start[want + 1].tolist()))
                    score[i] += np.bincount(np.concatenate([self.doc[a:b] for a, b in cuts]), np.concatenate([self.weight[a:b] for a, b in cuts]), self.width)
            for i, room in enumerate(rooms[low : low + TOGETHER].tolist()):
                score[i, int(np.searchsorted(self.size, room, "right")) :] = 0
            parts = score.reshape(len(some), -1, GROUP)
            best = parts.max(axis=2)
            bound, least = np.zeros((len(some), len(self.groups))), 0.5e-9 * self.scale
            for k, g in enumerate(self.groups.tolist()):
                if g >= keep:
                    bound[:, k] = np.partition(best[:, :g], g - keep, axis=1)[:, g - keep]
            bound = np.maximum(bound - 2e-9 * self.scale, least)  # scores that are equal when rounded all count
            bound = bound[:, self.class_of]
            row, group = np.nonzero(best >= bound)
            inside = parts[row, group]
            at, lane = np.nonzero(inside >= bound[row, group][:, None])
            found = np.empty(len(at), FOUND)
            column = group[at] * GROUP + lane
            found["score"], found["num"], found["size"] = np.rint(inside[at, lane] / self.scale * 1e9), self.num[column], self.size[column]
            row = row[at]
            order = np.lexsort((found["num"], -found["score"], row))
            found, row = found[order], row[order]
            first, good = np.searchsorted(row, np.arange(len(some))), np.zeros(len(row), bool)
            for most in self.classes.tolist():
                inside = found["size"] <= most
                before = np.cumsum(inside) - inside  # in this and all earlier queries
                good |= inside & (before - np.append(before, 0)[first][row] < keep)
            counts.append(np.bincount(row[good], minlength=len(some)))
            out.append(found[good])
        return np.concatenate(counts).astype(np.int32), np.concatenate(out)


class Filler:
    """The greedy fill: each seed, in order, takes its best unused neighbours that fit.

    The seed is the first unused piece.  Neighbours follow by score, ties by number; those that score nothing come last,
    by number, so that windows are filled all the same: these need no search.  A piece that does not fit is passed over
    for this window.  Lists stay good while pieces are taken, since no piece becomes free again; they are used only as far
    as they surely hold the next best piece.  Where one ends too early, its seed is asked again, with the room it has left
    and a longer list, and so are those of which much is used up; the other seeds' lists wait for their turn.  Where only
    pieces of ``small`` words or less fit, ``near`` names all of these that score.
    """

    def __init__(self, sizes: np.ndarray, window: int):
        self.sizes, self.window, self.classes = sizes, window, size_classes(window)
        self.free = np.ones(len(sizes), bool)
        self.by_size = np.argsort(sizes, kind="stable")
        self.head = np.searchsorted(sizes[self.by_size], np.arange(window + 1))
        self.ends = np.append(self.head[1:], len(sizes))
        self.least = np.full(window + 1, len(sizes))  # the first unused piece of each size
        some = self.head < self.ends
        self.least[some] = self.by_size[self.head[some]]
        self.next, self.left, self.asking = 0, len(sizes), 128
        self.held: dict[int, tuple[np.ndarray, np.ndarray, int]] = {}  # lists of seeds to come
        self.small, self.near = -1, lambda seed: np.zeros(0, FOUND)
        self.open: list[int] = []  # the window being filled
        self.room, self.stuck, self.done = 0, 0, []

    def hold(self, small: int, near: Callable[[int], np.ndarray]) -> None:
        """Lists need no classes of pieces below ``small`` words from here on."""
        self.small, self.near, self.classes = small, near, self.classes[np.searchsorted(self.classes, small) :]

    def take(self, num: int) -> None:
        size = int(self.sizes[num])
        self.free[num] = False
        self.left -= 1
        self.open.append(num)
        self.room -= size
        if num == self.least[size]:
            k, end = int(self.head[size]), int(self.ends[size])
            while k < end and not self.free[self.by_size[k]]:
                k += 1
            self.head[size] = k
            self.least[size] = self.by_size[k] if k < end else len(self.sizes)

    def seeds(self, most: int) -> tuple[np.ndarray, np.ndarray]:
        """The seeds to ask for next, ``most`` at most, and their room."""
        nums = self.next + np.flatnonzero(self.free[self.next :])[: max(1, min(most, self.asking, 64 + self.left // AHEAD))]
        if self.open:
            worn = [k for k in nums.tolist() if k not in self.held or self._worn(*self.held[k])] if self.stuck < 3 else []
            nums = np.array([self.open[0], *worn[: max(0, most - 1)]])
            return nums, np.append(self.room, self.window - self.sizes[nums[1:]])
        return nums, self.window - self.sizes[nums]

    def _worn(self, found: np.ndarray, owner: np.ndarray, keep: int) -> bool:
        mine = found["num"][found["size"] <= self.classes[np.searchsorted(self.classes, self.room)]]
        return 2 * np.count_nonzero(self.free[mine]) < len(mine)

    def fill(self, seeds: np.ndarray, lists: list[list[np.ndarray]], keep: int) -> None:
        """``lists`` has for each seed what each task found, by score: the first ``keep`` of each size class at least."""
        for seed, each in zip(seeds.tolist(), lists):
            found, owner = np.concatenate([np.zeros(0, FOUND), *each]), np.repeat(np.arange(len(each)), [len(x) for x in each])
            order = np.lexsort((found["num"], -found["score"]))
            self.held[seed] = found[order], owner[order], keep
        while True:
            if not self.open:
                while self.next < len(self.free) and not self.free[self.next]:
                    self.held.pop(self.next, None)
                    self.next += 1
                if self.next not in self.held:
                    self.asking *= 2  # the lists lasted
                    return
                self.room = self.window
                self.take(self.next)
            if not self._one(*self.held[self.open[0]]):
                self.stuck += 1
                return
            self.held.pop(self.open[0])
            self.done.append(self.open)
            self.open, self.stuck = [], 0

    def _one(self, found: np.ndarray, owner: np.ndarray, keep: int) -> bool:
        size, num = found["size"], found["num"]
        known = -1
        at = 0
        while (first := int(self.least[: self.room + 1].min())) < len(self.sizes):  # some piece fits
            if (now := int(np.searchsorted(self.classes, self.room))) != known:  # as far as the first list that may end too early
                inside, known = np.flatnonzero(size <= self.classes[now]), now
                by = np.argsort(owner[inside], kind="stable")
                n = np.bincount(owner[inside], minlength=1)
                full = (np.cumsum(n) - n)[n >= keep] + keep - 1
                whole, sure = not len(full), int(inside[by[full]].min()) + 1 if len(full) else len(size)
            fits = at + np.flatnonzero((size[at:sure] <= self.room) & self.free[num[at:sure]])
            if len(fits):
                at = int(fits[0]) + 1
                self.take(int(num[at - 1]))
            elif whole:  # whatever scores and fits is taken: the others score nothing
                self.take(first)
            elif self.room <= self.small:
                found = self.near(self.open[0])
                found = found[np.lexsort((found["num"], -found["score"]))]
                size, num, owner, known, at, keep = found["size"], found["num"], np.zeros(len(found), np.int64), -1, 0, len(found) + 1
            else:
                return False
        return True


def _terms(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    k = len(blob) // 6
    return np.frombuffer(blob, "<u4", k), np.frombuffer(blob, "<u2", k, 4 * k)


def _frequencies(pieces: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(terms of two pieces or more, ascending, in how many each is): eight bytes a term on the driver."""

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def summed() -> pa.RecordBatch:
            term, count = np.unique(np.concatenate([np.zeros(0, np.uint32), *held]), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(term.view(np.int32)), pa.array(count.astype(np.int32))], ["term", "n"])

        for batch in batches:
            for blob in batch.column("terms").to_pylist():
                held.append(_terms(blob)[0])
                n += len(held[-1])
            if n > 1 << 23:
                yield summed()
                held, n = [], 0
        yield summed()

    part = pieces.select("terms").mapInArrow(tidy(local), "term int, n int")
    got = part.groupBy("term").agg(F.sum("n").cast("int").alias("n")).filter("n > 1").toArrow()
    term, n = got.column("term").to_numpy().view(np.uint32), got.column("n").to_numpy()
    order = np.argsort(term)
    return term[order], n[order]


BLOBS = {"nums": "<i8", "sizes": "<i4", "vocabulary": "<u4", "lengths": "<u4", "doc": "<u2", "count": "<u2"}


def _indexed(placed: DataFrame) -> DataFrame:
    """One row of blobs for each block of ``placed``, which has a block's pieces together and by number."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows = None, []
        for batch in batches:
            for block, *row in zip(*(batch.column(c).to_pylist() for c in ("block", "num", "n_tokens", "terms"))):
                if block != now and now is not None:
                    yield one(rows)
                    rows = []
                now = block
                rows.append(row)
        if now is not None:
            yield one(rows)

    def one(rows: list[list]) -> pa.RecordBatch:
        both, nums = [_terms(r[2]) for r in rows], np.array([r[0] for r in rows], np.int64)
        blobs = [nums, np.array([r[1] for r in rows], np.int32), *postings(nums, [x for x, _ in both], [x for _, x in both])]
        return pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in blobs], list(BLOBS))

    return materialise(placed.mapInArrow(tidy(build), ", ".join(f"{c} binary" for c in BLOBS)), "pack-index")


def _idf(known: np.ndarray, counted: tuple[np.ndarray, np.ndarray], n: int) -> np.ndarray:
    """The idf of Robertson and Sparck Jones, floored at 0; 0 too for terms of one piece, which add nothing to another."""
    at = np.minimum(np.searchsorted(counted[0], known), max(0, len(counted[0]) - 1))
    df = np.where(counted[0][at] == known, counted[1][at], n) if len(counted[0]) else np.full(len(known), n)
    return np.maximum(0.0, np.log((n - df + 0.5) / (df + 0.5)))


class Smallest:
    """The smallest pieces, as many as have SMALL_WORDS words together, scored on the driver."""

    def __init__(self, placed: DataFrame, filler: Filler, counted: tuple[np.ndarray, np.ndarray]):
        sizes = np.sort(filler.sizes)
        n = int(np.searchsorted(np.cumsum(sizes), SMALL_WORDS, "right"))
        self.most = int(filler.window if n == len(sizes) else sizes[n] - 1)  # all of the sizes up to this one
        got = placed.filter(F.col("n_tokens") <= self.most).select("num", "n_tokens", "terms").toArrow().sort_by("num")
        both = [_terms(x) for x in got.column("terms").to_pylist()]
        self.nums, self.sizes = got.column("num").to_numpy(), got.column("n_tokens").to_numpy().astype(np.int64)
        self.terms, self.counts, self.filler, self.counted = [x for x, _ in both], [x for _, x in both], filler, counted
        self.words: dict[int, np.ndarray] = {}  # of the seeds asked
        self.blocks: list[Block] = []
        self.left = len(self.nums) + 1

    def near(self, seed: int) -> np.ndarray:
        filler = self.filler
        free = filler.free[self.nums]
        if 2 * np.count_nonzero(free) < self.left or not self.blocks:
            some = np.flatnonzero(free)
            self.nums, self.sizes, self.terms, self.counts = self.nums[some], self.sizes[some], [self.terms[i] for i in some], [self.counts[i] for i in some]
            self.left, self.blocks = len(some), []
            for a in range(0, len(some), SHARD_PIECES):
                b = a + SHARD_PIECES
                index = postings(self.nums[a:b], self.terms[a:b], self.counts[a:b])
                known = index[0]
                self.blocks.append(Block(self.nums[a:b], self.sizes[a:b], index, np.ones(len(self.nums[a:b]), bool), known, _idf(known, self.counted, len(filler.sizes)), float(filler.sizes.mean()), filler.classes, exact_scale(filler.window, len(filler.sizes)), 2.0))
        out = [np.zeros(0, FOUND)]
        for x in self.blocks:
            want = self.words[seed]
            at = np.minimum(np.searchsorted(x.known, want), max(0, len(x.known) - 1))
            at = at[x.known[at] == want] if len(x.known) else at[:0]
            out.append(x.search([at], np.array([filler.room]), x.width + 1)[1])
        return np.concatenate(out)


def _lists(index: DataFrame, placed: DataFrame, filler: Filler, seeds: np.ndarray, rooms: np.ndarray, keep: int, counted: tuple[np.ndarray, np.ndarray], words: dict[int, np.ndarray]) -> list[list[np.ndarray]]:
    """The best free pieces of every size class for each seed, from each block of the index; ``words`` gets the seeds' terms."""
    sc, classes, n, mean = index.sparkSession.sparkContext, filler.classes, len(filler.sizes), float(filler.sizes.mean())
    wanted = index.sparkSession.createDataFrame(pa.table({"num": seeds}))
    got = placed.filter(F.col("num").between(int(seeds.min()), int(seeds.max()))).join(F.broadcast(wanted), "num").select("num", "terms").toArrow()
    terms = dict(zip(got.column("num").to_pylist(), got.column("terms").to_pylist()))
    each = [_terms(terms[x])[0] for x in seeds.tolist()]
    known, code = np.unique(np.concatenate(each), return_inverse=True)
    for seed in [x for x in words if x not in filler.held and x not in filler.open]:
        del words[seed]
    words.update(zip(seeds.tolist(), each))
    idf = _idf(known, counted, n)
    use = idf > 0  # the others add exactly nothing
    back = np.cumsum(use) - 1
    asked = [back[x[use[x]]].astype(np.int32) for x in np.split(code, np.cumsum([len(x) for x in each])[:-1])]
    sent = sc.broadcast((np.packbits(filler.free), asked, rooms, known[use], idf[use], mean, exact_scale(filler.window, n)))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, asked, room, known, idf, mean, scale = sent.value
        for batch in batches:
            for k in range(batch.num_rows):
                nums, sizes, *index = (np.frombuffer(batch.column(c)[k].as_buffer(), t) for c, t in BLOBS.items())
                free = (bits[nums >> 3] >> (7 - (nums & 7)) & 1).astype(bool)
                if free.any():
                    held, found = Block(nums, sizes, index, free, known, idf, mean, classes, scale).search(asked, room, keep)
                    yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in (held, found)], ["held", "found"])

    got = index.mapInArrow(tidy(look), "held binary, found binary").toArrow()
    sent.destroy()
    lists: list[list[np.ndarray]] = [[] for _ in seeds]
    for held, found in zip(*(got.column(c).to_pylist() for c in ("held", "found"))):
        ends, found = np.cumsum(np.frombuffer(held, "<i4")).tolist(), np.frombuffer(found, FOUND)
        for mine, a, b in zip(lists, [0, *ends], ends):
            mine.append(found[a:b])
    return lists


def pack_documents(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """(shard, window, position, id, start, n_tokens): every word of every document in exactly one window.

    ``start`` is the piece's first word.  Pieces are numbered by (id, text hash, start), NULL ids last; a shard has about
    ``shard_tokens`` words of them, ``shard`` is the seed's, and ``window`` counts over all shards.  Document frequencies and
    mean length are those of all last pieces, and every seed's words are sent to every block of the index, so windows
    depend neither on shards nor on blocks.  Rounds of seeds are asked at once and filled in order as one seed after
    another would be.  NULL, empty and blank texts are pieces of no words, packed like others; repeated rows are packed as
    often as they occur; an empty table gives none.  Full pieces of a long document are windows of their own, in shard -1,
    named by (id, start).  Ids must be integers (ValueError).  The cost is windows times pieces; the driver holds some
    numbers of each piece and of each term of two pieces.
    """
    if not 0 < window <= 65_535:
        raise ValueError("a window holds 1 to 65,535 words")
    spark = docs.sparkSession
    sc = spark.sparkContext
    pieces = materialise(piece_table(docs, id_col, text_col, window), "pack-pieces")
    last = pieces.filter("local is not null")
    got = last.orderBy(F.col("id").asc_nulls_last(), "tie", "start", "part", "local").select("part", "local", "n_tokens").toArrow()
    part, local, sizes = (got.column(c).to_numpy().astype(np.int64) for c in ("part", "local", "n_tokens"))
    held = np.bincount(part, minlength=1)
    offset = np.cumsum(held) - held
    numbers = np.empty(len(sizes), np.int64)
    numbers[offset[part] + local] = np.arange(len(sizes))
    shard_of = np.maximum((np.cumsum(sizes + 1) - 1) // shard_tokens, np.arange(len(sizes)) // SHARD_PIECES) if len(sizes) else sizes
    firsts = np.flatnonzero(np.r_[True, shard_of[1:] != shard_of[:-1]] | (np.arange(len(sizes)) % SHARD_PIECES == 0)) if len(sizes) else sizes
    to = fresh_path(spark, "pack-windows")
    schema = "part int, local bigint, shard int, window bigint, position int"
    spark.createDataFrame([], schema).write.parquet(to)

    def flush(windows: list[list[int]], first: int) -> None:
        flat = np.array([x for w in windows for x in w], np.int64)
        lengths = np.array([len(w) for w in windows])
        seed = np.repeat([w[0] for w in windows], lengths)
        shard = np.searchsorted(firsts, seed, "right") - 1
        position = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        spark.createDataFrame(pa.table({"part": part[flat].astype(np.int32), "local": local[flat], "shard": shard.astype(np.int32), "window": np.repeat(np.arange(first, first + len(windows)), lengths), "position": position.astype(np.int32)})).write.mode("append").parquet(to)

    if len(sizes):
        cores = sc.defaultParallelism
        n_blocks = cores * -(-len(sizes) // (cores * BLOCK_PIECES))
        sent = sc.broadcast((offset, numbers))

        def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            offset, numbers = sent.value
            for batch in batches:
                num = numbers[offset[batch.column("part").to_numpy()] + batch.column("local").to_numpy()]
                yield pa.RecordBatch.from_arrays([pa.array((num % n_blocks).astype(np.int32)), pa.array(num), batch.column("n_tokens"), batch.column("terms")], ["block", "num", "n_tokens", "terms"])

        placed = last.select("part", "local", "n_tokens", "terms").mapInArrow(place, "block int, num bigint, n_tokens int, terms binary")
        placed = materialise(placed.repartitionById(n_blocks, "block").sortWithinPartitions("block", "num"), "pack-placed")
        names = pieces.select("part", "local", "id", "start", "n_tokens")
        rows = materialise(names, "pack-names")
        drop_path(spark, pieces.inputFiles()[0].rsplit("/", 1)[0])
        sent.destroy()
        counted, index = _frequencies(placed), _indexed(placed)
        filler, written = Filler(sizes, window), 0
        smallest = Smallest(placed, filler, counted)
        filler.hold(smallest.most, smallest.near)
        while filler.open or filler.left:
            keep = max(8, KEEP // n_blocks) << min(filler.stuck, 20)
            seeds, rooms = filler.seeds(max(8, NEIGHBOURS // (n_blocks * keep)))
            filler.fill(seeds, _lists(index, placed, filler, seeds, rooms, keep, counted, smallest.words), keep)
            if len(filler.done) > 100_000 or not (filler.open or filler.left):
                flush(filler.done, written)
                written, filler.done = written + len(filler.done), []
    else:
        rows = pieces.select("part", "local", "id", "start", "n_tokens")
    packed = rows.join(spark.read.schema(schema).parquet(to), ["part", "local"]).select("shard", "window", "position", "id", "start", "n_tokens")
    whole = rows.filter("local is null").select(F.lit(-1).alias("shard"), (F.col("start") / window).cast("bigint").alias("window"), F.lit(0).alias("position"), "id", "start", "n_tokens")
    return packed.unionByName(whole).withColumnRenamed("id", id_col)
