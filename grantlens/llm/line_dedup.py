"""Fuzzy line deduplication."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import chunks, integral, materialise, mix64, small_side, spare, tidy
from .components import connected_groups
from .edits import Verifier
from .fingerprints import distance
from .lines import SKETCHES, features, normal_lines

MOST_BITS = 28
SIMILARITY = 0.9
CHUNK = 512 << 10  # bytes of lines that are worked on at once
#: Rows of one cell from which it is divided over several tasks, and rows that one task compares, about.
HOT_ROWS, PART_ROWS, SAMPLED = 20_000, 1_000_000, 64
NODE_BITS = 63


#: A node's features as they are moved and grouped: two words of the fingerprint, four of the sketch (eight minima).
FEATURES = [*(f"f{k}" for k in range(2)), *(f"s{k}" for k in range(SKETCHES // 2))]


def _pieces(lines: pa.Array) -> Iterator[list[str]]:
    sizes = pc.fill_null(pc.binary_length(lines), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 16
    part = (np.cumsum(sizes) - sizes) // CHUNK
    cuts = np.flatnonzero(np.diff(part)) + 1
    for a, b in zip([0, *cuts], [*cuts, len(lines)]):
        yield lines[a:b].to_pylist()


def _doc(df: DataFrame, id_col: str, text: Column) -> Column:
    """Names a row by its id and text."""
    return F.struct(F.col(id_col).isNull().alias("none"), integral(df, id_col).alias("id"), F.unhex(F.md5(text)).alias("md5"))


def line_table(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc, line, at, key, len, *FEATURES) of every line that is not blank when normalised.

    ``doc`` names the row by id and text, ``line`` counts from 0, ``at`` sorts as (id, NULLs last, text hash, line),
    ``key`` is a 128-bit hash of the normalised line, ``len`` its length.
    """
    names = ["key", "len", *FEATURES]

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        h = xxhash.xxh3_128_digest
        for part in chunks(batches, "text", CHUNK):
            lists = pc.split_pattern(part.column("text"), "\n")
            counts = np.diff(lists.offsets.to_numpy())
            owner = np.repeat(np.arange(part.num_rows), counts)
            number = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
            coded = lists.flatten().dictionary_encode()
            if not len(coded):
                continue
            keys, made = [], []
            for some in _pieces(coded.dictionary):
                norm, fp, sketch = features(some)
                keys += [h(x) for x in norm]
                made.append(np.column_stack([np.array([len(x) for x in norm], np.int64), fp.view(np.int64), sketch.view(np.int64)]))
            rows = np.concatenate(made)
            code = coded.indices.to_numpy(zero_copy_only=False)
            at = np.flatnonzero(rows[code, 0] > 0)
            code = code[at]
            columns = [pa.array(rows[code, k].astype(np.int32) if k == 0 else rows[code, k]) for k in range(rows.shape[1])]
            where = _order(part.column("doc"), owner[at], number[at])
            yield pa.RecordBatch.from_arrays([part.column("doc").take(pa.array(owner[at])), pa.array(number[at].astype(np.int32)), where, pa.array(keys, pa.binary()).take(pa.array(code)), *columns], ["doc", "line", "at", *names])

    text = F.col(text_col).cast("string")
    one = docs.select(_doc(docs, id_col, text).alias("doc"), text.alias("text"))
    wide = ", ".join(f"{c} bigint" for c in FEATURES)
    return one.filter("text is not null").mapInArrow(tidy(make), f"doc struct<none: boolean, id: bigint, md5: binary>, line int, at decimal(38,0), key binary, len int, {wide}")


def _order(doc: pa.StructArray, owner: np.ndarray, line: np.ndarray) -> pa.Array:
    """Where a line stands: one number that sorts as (id, NULLs last, text hash, line), for a hash aggregation.

    It has 65 bits of the id, 24 of the text's hash and 31 of the line's number.
    """
    none = doc.field("none").to_numpy(zero_copy_only=False)
    number = pc.fill_null(doc.field("id"), 0).to_numpy().view(np.uint64) ^ np.uint64(1 << 63)
    text = np.frombuffer(b"".join(x[:3] + b"\0" for x in doc.field("md5").to_pylist()), ">u4").astype(np.uint64) >> np.uint64(8)
    high = np.where(none, np.uint64(1 << 55), number >> np.uint64(9))
    low = np.where(none, np.uint64(0), number << np.uint64(55)) | text << np.uint64(31)
    both = np.column_stack([low[owner] | line.astype(np.uint64), high[owner]])
    return pa.Array.from_buffers(pa.decimal128(38, 0), len(both), [None, pa.py_buffer(np.ascontiguousarray(both))])


def _features(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """(fingerprints, sketches)."""
    both = [np.column_stack([batch.column(c).to_numpy() for c in FEATURES if c[0] == kind and c in batch.schema.names] or [np.zeros((batch.num_rows, 0), np.int64)]) for kind in "fs"]
    return both[0].view(np.uint64), both[1].view(np.uint32)


def _hot(nodes: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(cells, parts of each) of the cells of more than HOT_ROWS rows, as estimated from every 64th node.

    The estimate decides only how a cell's work is divided.  At most one cell in HOT_ROWS rows is hot.
    """

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sketch = _features(batch)[1].astype(np.int64)
            cell = (sketch | np.arange(SKETCHES) << 32)[sketch > 0]
            yield pa.RecordBatch.from_arrays([pa.array(cell)], ["cell"])

    some = nodes.filter(F.pmod(F.xxhash64("node"), F.lit(SAMPLED)) == 0).select(*FEATURES[2:]).mapInArrow(keys, "cell bigint")
    hot = some.groupBy("cell").agg(F.count("*").alias("n")).filter(F.col("n") > HOT_ROWS // SAMPLED).orderBy("cell").toArrow()
    return hot.column("cell").to_numpy(), -(-hot.column("n").to_numpy() * SAMPLED // HOT_ROWS)


def sketch_pairs(nodes: DataFrame, n_rows: int, ratio: float, most: int = MOST_BITS) -> DataFrame:
    """(a, b, bits), a < b, distinct: nodes that share a sketch, whose shorter is ``ratio`` of the longer at least, within ``most`` bits.

    A cell is one bin's value; its rows are sorted by length and compared as far as lengths allow.  A hot cell of c parts is
    divided into c * c / 2 tasks, one for each two of its parts, so that no task gets all of it and no pair is missed.
    """
    hot, parts_of = _hot(nodes)
    parts = max(int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-SKETCHES * n_rows // PART_ROWS))
    record = np.dtype([("node", "<i8"), ("fp", "<u8", 2), ("len", "<i4"), ("cell", "<u4")])

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            node, length = batch.column("node").to_numpy(), batch.column("len").to_numpy()
            fp, sketch = _features(batch)
            row, band = np.nonzero(sketch)
            cell = sketch[row, band].astype(np.int64) | band.astype(np.int64) << 32
            place = np.zeros(len(cell), np.uint64)
            if len(hot):
                at = np.minimum(np.searchsorted(hot, cell), len(hot) - 1)
                times = np.where(hot[at] == cell, parts_of[at], 1)
                mine = (mix64(node[row].view(np.uint64), 5) % times.astype(np.uint64)).astype(np.int64)
                again = np.repeat(np.arange(len(cell)), times)
                other = np.arange(len(again)) - np.repeat(np.cumsum(times) - times, times)
                row, cell, mine = row[again], cell[again], mine[again]
                place = (np.minimum(mine, other) << 32 | np.maximum(mine, other)).astype(np.uint64)
            group = mix64(mix64(cell.astype(np.uint64), 3) ^ place, 4)
            out = np.empty(len(row), record)
            out["node"], out["fp"], out["len"], out["cell"] = node[row], fp[row], length[row], (group >> np.uint64(32)).astype(np.uint32)
            held.append(((group % np.uint64(parts)).astype(np.int32), out))
            n += len(out)
            if n > 500_000:
                yield blocks(held)
                held, n = [], 0
        if n:
            yield blocks(held)

    def blocks(held: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        part, rows = np.concatenate([p for p, _ in held]), np.concatenate([r for _, r in held])
        order = np.argsort(part, kind="stable")
        part, rows = part[order], rows[order]
        cuts = np.r_[0, np.flatnonzero(np.diff(part)) + 1, len(part)]
        return pa.RecordBatch.from_arrays([pa.array(part[cuts[:-1]]), pa.array([rows[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary())], ["part", "block"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [x for batch in batches for x in batch.column("block").to_pylist()]  # one part: PART_ROWS records, about
        if not got:
            return
        rows = np.frombuffer(b"".join(got), record)
        del got
        rows = rows[np.lexsort((rows["len"], rows["cell"]))]
        node, fp, length = rows["node"].copy(), np.ascontiguousarray(rows["fp"]), rows["len"].astype(np.int64)
        run = rows["cell"].astype(np.int64) << 31
        last = np.searchsorted(run | length, run | (length / ratio + 1e-6).astype(np.int64), "right")
        live, step = np.arange(len(node)), 1
        while len(live := live[live + step < last[live]]):
            for at in range(0, len(live), 1 << 18):
                i = live[at : at + (1 << 18)]
                bits = distance(fp[i], fp[i + step])
                near = np.flatnonzero((bits <= most) & (node[i] != node[i + step]))
                if len(near):
                    x, y = node[i[near]], node[i[near] + step]
                    yield pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y)), pa.array(bits[near])], ["a", "b", "bits"])
            step += 1

    moved = nodes.select("node", "len", *FEATURES).mapInArrow(tidy(spread), "part int, block binary").repartitionById(parts, "part")
    return moved.mapInArrow(tidy(compare), "a bigint, b bigint, bits int").distinct()


def _texts(docs: DataFrame, text_col: str, ends: DataFrame) -> DataFrame:
    """(node, norm) of ``ends`` (node, md5, line), from the documents' texts."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, "text", CHUNK):
            nodes, raw = [], []
            for text, wanted in zip(part.column("text").to_pylist(), part.column("wanted").to_pylist()):
                lines = text.split("\n")
                nodes += [w["node"] for w in wanted]
                raw += [lines[w["line"]] for w in wanted]
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), normal_lines(pa.array(raw, pa.string()))], ["node", "norm"])

    wanted = materialise(ends.groupBy("md5").agg(F.collect_list(F.struct("node", "line")).alias("wanted")), "line-wanted")  # of one text: its lines at most
    text = F.col(text_col).cast("string")
    texts = docs.select(F.unhex(F.md5(text)).alias("md5"), text.alias("text")).join(small_side(wanted), "md5")
    found = texts.select("text", "wanted").mapInArrow(tidy(make), "node bigint, norm string")
    return materialise(found.dropDuplicates(["node"]), "line-texts")


def _verified(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """The pairs whose texts' edit distance is ``1 - similarity`` of the longer at most."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = Verifier()

        def out(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1)], ["a", "b"])

        for batch in batches:
            near = []
            for a, b, x, y in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "x", "y"))):
                if work.add((a, b), x, y, int(max(len(x), len(y)) * (1 - similarity) + 1e-9)):
                    near.append((a, b))
            yield out(near + work.ready())
        yield out(work.rest())

    left, right = texts.select(F.col("node").alias("a"), F.col("norm").alias("x")), texts.select(F.col("node").alias("b"), F.col("norm").alias("y"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(tidy(check), "a bigint, b bigint")


def _numbered(keyed: DataFrame, bits: int) -> DataFrame:
    """``keyed`` with ``node``, the leading ``bits`` of the key; where keys share them, negative numbers of their own."""
    one = materialise(keyed.withColumn("node", F.shiftright(F.conv(F.substring(F.hex("key"), 1, 16), 16, -10).cast("bigint"), 1).bitwiseAND((1 << bits) - 1)), "line-keyed")
    twins = materialise(one.groupBy("node").agg(F.count("*").alias("c")).filter("c > 1").select("node"), "line-twins")
    if not twins.count():
        return one
    several = one.join(small_side(twins), "node", "left_semi").select("key")
    named = materialise(several.select("key", (-1 - F.monotonically_increasing_id()).alias("other")), "line-renamed")
    return materialise(one.join(small_side(named), "key", "left").withColumn("node", F.coalesce("other", "node")).drop("other"), "line-nodes")


def dropped_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY, node_bits: int = NODE_BITS) -> DataFrame:
    """(doc, lines): for each document the numbers of its lines that occur before, or are close to one that does.

    Lines with one normalised form are one node.  Candidates share the least word trigram of one of eight bins of trigram
    hashes, have lengths that the similarity allows and 128-bit SimHashes that differ in 28 bits at most.  They are
    verified: the edit distance of the normalised lines may be ``1 - similarity`` of the longer at most.  Of each group
    that verified pairs connect, the first occurrence by (id, text hash, line number) stays; NULL ids come last.  Blank
    lines are never dropped.
    """
    lines = materialise(line_table(docs, id_col, text_col), "lines")
    # one hash aggregation of fixed-width values; lines of one key have equal features
    keyed = lines.groupBy("key").agg(F.first("len").alias("len"), *[F.first(c).alias(c) for c in FEATURES], F.min("at").alias("first"), F.count("*").alias("n"))
    nodes = _numbered(keyed, node_bits)
    pairs = materialise(sketch_pairs(nodes, nodes.count(), similarity), "line-pairs")
    ends = materialise(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "line-ends")
    places = nodes.select("node", "first").join(small_side(ends), "node", "left_semi").select("node", F.col("first").alias("at"))
    places = materialise(places, "line-places")
    found = lines.select("at", "doc.md5", "line").join(small_side(places), "at").select("node", "md5", "line")
    texts = _texts(docs, text_col, materialise(found.dropDuplicates(["node"]), "line-found"))
    # pairs within a group that verified pairs connect need no look: each node's pair with its smallest partner goes first
    soon = materialise(pairs.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"), "line-soon")
    early = materialise(_verified(soon, texts, similarity), "line-early")
    known = connected_groups(early)
    one, two = known.select(F.col("node").alias("a"), F.col("root").alias("root_a")), known.select(F.col("node").alias("b"), F.col("root").alias("root_b"))
    apart = F.coalesce("root_a", "a") != F.coalesce("root_b", "b")
    rest = pairs.join(small_side(one), "a", "left").join(small_side(two), "b", "left").filter(apart).select("a", "b")
    late = _verified(rest.join(soon, ["a", "b"], "left_anti"), texts, similarity)
    groups = connected_groups(early.unionByName(late))
    rooted = nodes.select("node", "key", "first", "n").join(small_side(groups), "node", "left").filter("n > 1 or root is not null")
    touched = materialise(rooted.select("key", "first", F.coalesce("root", "node").alias("root")), "line-touched")
    kept = touched.groupBy("root").agg(F.min("first").alias("kept"))
    by_key = materialise(touched.join(kept, "root").select("key", "kept"), "line-kept")
    occurrences = lines.select("doc", "line", "key", "at").join(small_side(by_key), "key")
    return occurrences.filter(F.col("at") != F.col("kept")).groupBy("doc").agg(F.array_sort(F.collect_set("line")).alias("lines"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY, node_bits: int = NODE_BITS) -> DataFrame:
    """``docs`` with each repeated or nearly repeated line removed from the text but for its first occurrence, and ``lines_removed``.

    All rows and columns stay, but a column called ``lines_removed`` is replaced.  A NULL text stays NULL, a text of which
    every line goes becomes empty; an empty table stays empty.  Rows that repeat id and text are one document: they lose
    the same lines.  NULL ids come after all others; ids must be integers (ValueError).  Texts and lines of any length
    are compared whole.
    """
    doc, lines = spare(docs, "doc", "lines")
    gone = materialise(dropped_lines(docs, id_col, text_col, similarity, node_bits).select(F.col("doc").alias(doc), F.col("lines").alias(lines)), "line-gone")
    text = F.col(text_col).cast("string")
    tagged = docs.withColumn(doc, _doc(docs, id_col, text))
    joined = tagged.withColumn(doc, F.to_json(doc)).join(small_side(gone.withColumn(doc, F.to_json(doc))), doc, "left")
    left = F.array_join(F.filter(F.split(text, "\n"), lambda x, i: ~F.array_contains(F.col(lines), i)), "\n")
    return joined.withColumns({text_col: F.when(F.col(lines).isNull(), text).otherwise(left), "lines_removed": F.coalesce(F.size(lines), F.lit(0))}).select(
        *[F.col(f"`{c}`") for c in docs.columns if c.lower() != "lines_removed"], "lines_removed"
    )
