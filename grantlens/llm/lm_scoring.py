"""Unbounded n-gram scores from sharded suffix arrays of a corpus."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, hash_strings, materialise, spare, split_words, tidy

#: Tokens of one suffix array.
SHARD_TOKENS = 2_000_000
#: Tokens of scored texts that go through the corpus in one pass; more take more passes.
PASS_TOKENS = 2_000_000
MU = 1.0  # weight of the word's own frequency against the continuation counts of the longest context


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Positions of ``text`` (codes from 0) in the order of their suffixes' first ``depth`` codes; prefix doubling.

    The first sort takes as many codes at once as fit in 63 bits; only runs that are still equal are sorted again, with
    twice the length.
    """
    n = len(text)
    width = max(1, int(text.max()).bit_length()) if n else 1
    at_once = min(n, 63 // width, 8) if n else 1
    padded = np.concatenate([text, np.zeros(at_once)]).astype(np.int64)
    key = np.zeros(n, np.int64)
    for k in range(at_once):
        key = key << width | padded[k : k + n]
    order = np.argsort(key)
    ordered = key[order]
    fresh = np.concatenate([[True], ordered[1:] != ordered[:-1]])[:n]
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1
    rank[order] = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    length = at_once
    open_ = np.flatnonzero(~fresh | ~np.concatenate([fresh[1:], [True]])[:n])  # places in runs of several
    while len(open_) and length < depth:
        at = order[open_]
        mine = rank[at]
        second = rank[np.minimum(at + length, n)] + 1
        by = np.lexsort((second, mine))
        at, mine, second = at[by], mine[by], second[by]
        order[open_] = at
        new = np.concatenate([[True], (mine[1:] != mine[:-1]) | (second[1:] != second[:-1])])
        rank[at] = open_[np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))]
        several = ~new | ~np.concatenate([new[1:], [True]])
        open_, length = open_[several], 2 * length
    return order


def context_sizes(text: np.ndarray, order: np.ndarray, start: np.ndarray, size: np.ndarray, codes: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Of each query (``codes[start]``, ``codes[start - 1]`` ... ``size`` of them) and depth 1, 2, ...: (queries that occur, how often).

    Each step narrows the interval of the suffix array by binary search for the next code, for all queries at once.
    """
    n = len(text)
    live = np.flatnonzero(size > 0)
    lo, hi = np.zeros(len(live), np.int64), np.full(len(live), len(order), np.int64)
    out = []
    depth = 0
    while len(live):
        want = codes[start[live] - depth].astype(np.int64)
        ends = []
        for target in (want, want + 1):
            a, b = lo.copy(), hi.copy()
            while True:
                open_ = np.flatnonzero(a < b)
                if not len(open_):
                    break
                mid = (a[open_] + b[open_]) >> 1
                at = order[mid] + depth
                less = np.where(at < n, text[np.minimum(at, n - 1)], 0) < target[open_]
                a[open_[less]] = mid[less] + 1
                b[open_[~less]] = mid[~less]
            ends.append(a)
        some = (ends[1] > ends[0]) & (want > 0)
        live, lo, hi = live[some], ends[0][some], ends[1][some]
        out.append((live, hi - lo))
        depth += 1
        more = size[live] > depth
        live, lo, hi = live[more], lo[more], hi[more]
    return out


class Counts:
    """(longest, context count, continuation count, count) of each query word over the shards so far."""

    def __init__(self, n: int):
        self.longest, self.context, self.joined, self.single = (np.zeros(n, np.int64) for _ in range(4))

    def add(self, longest: np.ndarray, context: np.ndarray, joined: np.ndarray, single: np.ndarray) -> None:
        longer, same = longest > self.longest, longest == self.longest
        for mine, new in ((self.context, context), (self.joined, joined)):
            mine[longer], mine[same] = new[longer], mine[same] + new[same]
        self.longest = np.maximum(self.longest, longest)
        self.single += single


def shard_counts(corpus: list[tuple[np.ndarray, int, int]], words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(longest, context count, continuation count, count) of each query word in one shard.

    ``corpus``: (word hashes, lead, tail) blocks, each one text or a piece of one, whose first ``lead`` and last ``tail``
    words belong to the pieces before and after; ``words``: the query texts' hashes, one after the other; ``first``: for
    each word the place of its text's first word.  The corpus is reversed, so that a context is read backwards from its
    last word and one descent finds every context length.  A context is counted where its last word is, and its
    continuation with it.
    """
    hashes = np.concatenate([x for x, _, _ in corpus])
    vocabulary, codes = np.unique(hashes, return_inverse=True)
    size = np.array([len(x) for x, _, _ in corpus])
    at = np.arange(len(hashes)) - np.repeat(np.cumsum(size) - size, size)
    lead, tail = (np.repeat([x[k] for x in corpus], size) for k in (1, 2))
    mine = (at >= lead) & (at < np.repeat(size, size) - tail)
    cut = np.cumsum(size)[:-1]  # a 0 between texts matches nothing
    text = np.insert(codes.astype(np.int64) + 1, cut, 0)[::-1].copy()
    own = np.insert(mine, cut, False)
    place = np.minimum(np.searchsorted(vocabulary, words), len(vocabulary) - 1)
    query = np.where(vocabulary[place] == words, place + 1, -1)  # -1: not in this shard
    n, index = len(words), np.arange(len(words))
    order = suffix_array(text, int((index - first).max()) + 2)
    # context j: words up to and with j, backwards
    found = after_own = context_sizes(text, order[own[::-1][order]], index, index - first + 1, query)
    if not own.sum() == len(hashes):  # a continuation is counted with the word before it, which another piece may have
        later = np.r_[False, own[:-1]][::-1]
        after_own = context_sizes(text, order[later[order]], index, index - first + 1, query)
    longest, context, joined = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
    for d, (live, size) in enumerate(found, 1):
        after = live + 1
        inside = after < n
        inside[inside] &= first[after[inside]] == first[live[inside]]
        longest[after[inside]], context[after[inside]] = d, size[inside]
    single = np.zeros(n, np.int64)
    if found:
        single[found[0][0]] = found[0][1]
    for d, (live, size) in enumerate(after_own, 1):
        same = (longest[live] + 1 == d) & (d > 1)
        joined[live[same]] = size[same]
    return longest, context, joined, single


def word_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row number, word hash) of every word, row numbers growing over all batches."""
    rows_before = 0
    for part in chunks(batches, "text"):
        rows, codes, distinct = split_words(part.column("text"))
        if len(rows):
            yield rows.astype(np.int64) + rows_before, hash_strings(distinct)[codes]
        rows_before += part.num_rows


def score_texts(
    corpus: DataFrame, items: DataFrame, id_col: str = "item_id", item_text: str = "text", corpus_text: str = "text", mu: float = MU, shard_tokens: int = SHARD_TOKENS, pass_tokens: int = PASS_TOKENS,
) -> DataFrame:
    """``items``' rows with (n_tokens, log_prob, perplexity, mean_match, longest_match) under the whole corpus.

    For each word the longest preceding context, within its text, that occurs anywhere in the corpus is found, its count c
    and the count of its continuation by the word are summed over all shards, and the word has the probability
    ``(continued + mu * p0) / (c + mu)``, where ``p0`` is the word's share of the corpus with one added to each count,
    for all V words of the corpus and one unknown.  Each task takes the rows of its corpus partition as they come and makes
    suffix arrays of ``shard_tokens`` words; a longer text is cut, each piece with as many words of the one
    before as the longest scored text has and one of the next, so that no context is lost and none counts twice.  How rows are divided
    does not change the result.  A task gives one row for each query word that it has seen, and these are summed; the
    corpus' vocabulary is counted apart.

    A text without words (NULL, empty, blank) has 0 words, NULL probabilities and matches; repeated rows of ``items`` are
    scored alike; an empty corpus leaves every word at ``p0 = 1``.  Columns of ``items`` with the result's names are replaced.
    """
    (key,) = spare(items, "key")
    keyed = items.withColumn(key, F.unhex(F.md5(F.coalesce(F.col(item_text).cast("string"), F.lit("")))))
    texts = materialise(keyed.select(key, F.col(item_text).cast("string").alias("text")).filter("text is not null").dropDuplicates([key]).withColumnRenamed(key, "key"), "lm-items")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, "text"):
            rows, codes, distinct = split_words(part.column("text"))
            ends = np.searchsorted(rows, np.arange(part.num_rows + 1))
            hashed = hash_strings(distinct)[codes] if len(rows) else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays([part.column("key"), pa.array([hashed[a:b].tobytes() for a, b in zip(ends, ends[1:])], pa.binary()), pa.array(np.diff(ends).astype(np.int64))], ["key", "words", "n"])

    coded = materialise(texts.mapInArrow(encode, "key binary, words binary, n bigint").filter("n > 0"), "lm-coded")
    n_words = coded.agg(F.sum("n")).first()[0] or 0
    passes = max(1, -(-n_words // pass_tokens))
    docs = corpus.select(F.col(corpus_text).cast("string").alias("text")).filter("text is not null")
    each = []
    for k in range(passes):
        block = coded.filter(F.pmod(F.xxhash64("key"), F.lit(passes)) == k).orderBy("key").toArrow()  # about pass_tokens words
        each.append(docs.mapInArrow(tidy(_counter(block, shard_tokens, k == 0)), "key binary, place int, longest int, context bigint, joined bigint, single bigint, word bigint, tokens bigint"))
    counted = each[0]
    for more in each[1:]:
        counted = counted.unionByName(more)
    counted = materialise(counted, "lm-counts")
    whole = counted.filter("key is null")
    vocabulary = whole.filter("word is not null").select("word").distinct().agg(F.count("*").alias("v"))
    tokens = whole.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("t"))
    sums = [F.sum(c).alias(c) for c in ("context", "joined", "single")]
    lengths = counted.filter("key is not null").groupBy("key", "place", "longest").agg(*sums)
    best = lengths.groupBy("key", "place").agg(F.max("longest").alias("longest"), F.max_by(F.struct("context", "joined"), "longest").alias("one"), F.sum("single").alias("single"))
    found = best.crossJoin(F.broadcast(vocabulary)).crossJoin(F.broadcast(tokens))  # one row each
    none = F.col("longest") == 0  # the context is empty: it occurs before every word
    context, joined = F.when(none, F.col("t")).otherwise(F.col("one.context")), F.when(none, F.col("single")).otherwise(F.col("one.joined"))
    p = (joined + mu * (F.col("single") + 1) / (F.col("t") + F.col("v") + 1)) / (context + mu)
    scores = found.groupBy("key").agg(F.sum(F.log(p)).alias("seen_log"), F.count("*").alias("seen"), F.sum("longest").alias("matches"), F.max("longest").alias("longest_match"))
    names = ["n_tokens", "log_prob", "perplexity", "mean_match", "longest_match"]
    unseen = F.log(F.lit(mu) / (F.col("t") + F.col("v") + 1) / (F.col("t") + mu))  # words of no count and no context
    right = coded.select("key", "n").join(scores, "key", "left").crossJoin(F.broadcast(vocabulary)).crossJoin(F.broadcast(tokens)).select(
        F.col("key").alias(key), F.col("n").alias("n_tokens"), (F.coalesce("seen_log", F.lit(0.0)) + (F.col("n") - F.coalesce("seen", F.lit(0))) * unseen).alias("log_prob"),
        (F.coalesce("matches", F.lit(0)) / F.col("n")).alias("mean_match"), F.coalesce("longest_match", F.lit(0)).alias("longest_match"),
    )
    left = keyed.drop(*[c for c in items.columns if c.lower() in names])
    out = left.join(right, key, "left").drop(key)
    return out.withColumn("n_tokens", F.coalesce("n_tokens", F.lit(0).cast("bigint"))).withColumn("perplexity", F.round(F.exp(-F.col("log_prob") / F.col("n_tokens")), 4)).withColumns(
        {"log_prob": F.round("log_prob", 6), "mean_match": F.round("mean_match", 6)}
    )


def _counter(block: pa.Table, shard_tokens: int, vocabulary_too: bool):
    """The mapInArrow function that counts one block of query texts in the suffix arrays of a partition."""
    keys, blobs = block.column("key").to_pylist(), block.column("words").to_pylist()
    sizes = np.array([len(x) // 8 for x in blobs], np.int64)
    words = np.frombuffer(b"".join(blobs), "<u8")
    first = np.repeat(np.cumsum(sizes) - sizes, sizes)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    overlap = int(sizes.max()) if len(sizes) else 0
    names = ["key", "place", "longest", "context", "joined", "single", "word", "tokens"]
    types = [pa.binary(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]

    def rows(n: int, **columns: pa.Array) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([columns.get(c, pa.nulls(n, t)) for c, t in zip(names, types)], names)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, int, int]]:
        for number, hashes in word_hashes(batches):
            edges = np.flatnonzero(np.diff(number)) + 1
            for a, b in zip([0, *edges], [*edges, len(number)]):
                for start in range(a, b, shard_tokens):
                    low, tail = max(a, start - overlap), int(start + shard_tokens < b)
                    yield hashes[low : min(b, start + shard_tokens + tail)], start - low, tail

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, int, int]] = []
        n, all_tokens, total = 0, 0, Counts(len(words))
        for piece in pieces(batches):
            own = len(piece[0]) - piece[1] - piece[2]
            if n and n + own > shard_tokens:
                yield from one(held, total)
                held, n = [], 0
            held.append(piece)
            n, all_tokens = n + own, all_tokens + own
        if held:
            yield from one(held, total)
        if vocabulary_too:
            yield rows(1, tokens=pa.array([all_tokens], pa.int64()))
        at = np.flatnonzero((total.longest > 0) | (total.single > 0))
        if len(at):
            yield rows(
                len(at), key=pa.array(keys, pa.binary()).take(pa.array(owner[at])), place=pa.array((at - first[at]).astype(np.int32)), longest=pa.array(total.longest[at].astype(np.int32)),
                context=pa.array(total.context[at]), joined=pa.array(total.joined[at]), single=pa.array(total.single[at]),
            )

    def one(held: list[tuple[np.ndarray, int, int]], total: Counts) -> Iterator[pa.RecordBatch]:
        if vocabulary_too:
            distinct = np.unique(np.concatenate([x for x, _, _ in held])).view(np.int64)
            yield rows(len(distinct), word=pa.array(distinct))
        if len(words):
            total.add(*shard_counts(held, words, first))

    return count
