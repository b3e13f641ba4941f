"""Language identification by Bayesian fusion of text, declared language, address suffix and host priors."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import chunks, hash60, materialise, small_side, spare, tidy

LANGS = ("de", "en", "es", "fr")
#: Rows of each language that the text model is fitted on, at most: those of the smallest key hashes.
FIT_ROWS = 1500
SLOTS = 1 << 18  # hashed byte trigrams
#: Trigrams overlap and repeat, so n of them count as n * FULL / (n + FULL) independent ones.
FULL = 150.0
CHUNK = 512 << 10  # bytes of text that are worked on at once
KAPPA = 20.0  # pseudo-counts that a parent's prior adds to its child's counts
LEAST = 0.5  # least posterior of an accepted language


def trigrams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, slot) of every byte trigram of the lower-case text, every run of blanks one, padded by one blank on each side."""
    flat = pc.replace_substring_regex(pc.utf8_lower(pc.fill_null(texts, "")), r"\s+", " ")
    padded = pc.binary_join_element_wise(" ", pc.utf8_trim_whitespace(flat), " ", "")
    data = np.frombuffer(padded.buffers()[2] or b"", np.uint8)
    offsets = np.frombuffer(padded.buffers()[1], np.int32)[padded.offset : padded.offset + len(padded) + 1].astype(np.int64)
    lengths = np.maximum(np.diff(offsets) - 2, 0)
    lengths[lengths <= 1] = 0  # two blanks around nothing
    rows = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)
    at = np.arange(len(rows)) - np.repeat(np.cumsum(lengths) - lengths, lengths) + np.repeat(offsets[:-1], lengths)
    code = data[at].astype(np.uint32) << 16 | data[at + 1].astype(np.uint32) << 8 | data[at + 2]
    return rows, (code * np.uint32(2654435761)) >> np.uint32(14)


@dataclass
class TextModel:
    """log P(trigram slot | language); the last row is the uniform distribution: text of no known language."""

    langs: tuple[str, ...]
    table: np.ndarray  # (SLOTS, len(langs) + 1) float32

    def score(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """((n, langs + 1) summed log-likelihoods, trigrams of each row)."""
        rows, slots = trigrams(texts)
        n = np.bincount(rows, minlength=len(texts))
        cols = [np.bincount(rows, np.ascontiguousarray(self.table[:, k])[slots], len(texts)) for k in range(self.table.shape[1])]
        return np.stack(cols, axis=1), n


def fit(labelled: DataFrame, text_col: str, label_col: str, key_col: str, langs: Sequence[str] = LANGS, rows: int = FIT_ROWS) -> TextModel:
    """Counts trigrams on the ``rows`` labelled rows of each language whose key hashes are smallest (a bounded sample)."""
    one = labelled.select(F.col(label_col).alias("label"), F.col(text_col).cast("string").alias("text"), hash60(F.coalesce(F.col(key_col).cast("string"), F.lit("null"))).alias("h"))
    one = one.filter(F.col("label").isin(*langs) & F.col("text").isNotNull())
    few = materialise(one.groupBy("label").agg(F.count("*").alias("n")), "langid-labels")
    limit = few.select("label", F.when(F.col("n") <= 2 * rows, F.lit(1 << 60)).otherwise(F.floor(F.lit(float(1 << 60)) * rows / F.col("n"))).cast("bigint").alias("most"))
    sample = one.join(F.broadcast(limit), "label").filter("h < most")  # a row for each language

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(langs), SLOTS), np.int64)
        for part in chunks(batches, "text", CHUNK):
            row, slot = trigrams(part.column("text"))
            lab = np.array([langs.index(x) for x in part.column("label").to_pylist()])
            np.add.at(total, (lab[row], slot), 1) if len(row) < 1000 else total.__iadd__(np.bincount(lab[row] * SLOTS + slot.astype(np.int64), minlength=total.size).reshape(total.shape))
        lab, slot = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(lab.astype(np.int32)), pa.array(slot.astype(np.int32)), pa.array(total[lab, slot])], ["lang", "slot", "n"])

    counted = sample.select("label", "text").mapInArrow(tidy(count), "lang int, slot int, n bigint").groupBy("lang", "slot").agg(F.sum("n").alias("n"))
    got = counted.toArrow()  # at most len(langs) * SLOTS rows
    counts = np.zeros((SLOTS, len(langs)))
    counts[got.column("slot").to_numpy(), got.column("lang").to_numpy()] = got.column("n").to_numpy()
    smooth = counts + 0.1
    table = np.full((SLOTS, len(langs) + 1), -np.log(SLOTS))
    table[:, :-1] = np.log(smooth / smooth.sum(axis=0))
    return TextModel(tuple(langs), table.astype(np.float32))


def host_of(url: Column) -> Column:
    """Lower-case host of an address; NULL where there is none."""
    host = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1))
    return F.when(host != "", host)


def suffix_of(host: Column) -> Column:
    return F.when(host.isNotNull(), F.substring_index(host, ".", -1))


def declared_in(html: Column) -> Column:
    """Two-letter code of the ``lang`` attribute of the root element; NULL where there is none."""
    got = F.lower(F.regexp_extract(F.coalesce(html, F.lit("")), r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z]{2,3})", 1))
    return F.when(got != "", got)


def visible_text(html: Column) -> Column:
    """The text of a page without comments, scripts, styles, tags and entities."""
    bare = F.regexp_replace(html, r"(?is)<!--.*?-->|<(script|style)\b.*?</\1\s*>", " ")
    return F.regexp_replace(F.regexp_replace(bare, r"<[^>]*>", " "), r"&[#\w]+;", " ")


def evidence(rows: DataFrame, model: TextModel, key: Column, text: Column, declared: Column, suffix: Column, host: Column) -> DataFrame:
    """(key, declared, suffix, host, ll array, p array) of each row: tempered log-likelihoods and the posterior from text alone."""
    width = len(model.langs) + 1

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, "text", CHUNK):
            total, n = model.score(part.column("text"))
            ll = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None] * (n * FULL / (n + FULL))[:, None], 0.0)
            ll -= ll.max(axis=1, keepdims=True)
            p = np.exp(ll)
            p /= p.sum(axis=1, keepdims=True)
            p[n == 0] = np.eye(width)[-1]
            ll[n == 0] = np.where(np.arange(width) == width - 1, 0.0, -1e3)  # no text: no language
            lists = [pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), width).cast(pa.list_(pa.float64())) for x in (ll, p)]
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("key", "declared", "suffix", "host")), *lists], ["key", "declared", "suffix", "host", "ll", "p"])

    one = rows.select(key.alias("key"), declared.cast("string").alias("declared"), suffix.cast("string").alias("suffix"), host.cast("string").alias("host"), text.cast("string").alias("text"))
    return one.mapInArrow(tidy(score), "key binary, declared string, suffix string, host string, ll array<double>, p array<double>")


def _sums(df: DataFrame, by: list[str], name: str, width: int) -> DataFrame:
    return df.groupBy(*by).agg(F.array(*[F.sum(F.col("p")[k]) for k in range(width)]).alias(name))


def fuse(scored: DataFrame, langs: Sequence[str], least: float = LEAST) -> DataFrame:
    """(key, lang, posterior, accepted) of each row of :func:`evidence`.

    Counts are sums of the text posteriors over all rows.  The prior of a row is that of its host without the row itself,
    smoothed by that of its suffix, that by all rows; a declared language counts by how often it is declared for rows of
    each language (``P(declared | language)``, add-one), a suffix is evidence through the prior.  A NULL declaration,
    suffix or host says nothing.  ``lang`` is the largest posterior, ``und`` where no language explains the text better
    than chance; accepted are languages other than ``und`` of at least ``least``.
    """
    width = len(langs) + 1
    every = _sums(scored, [], "all_p", width)
    suffixes = materialise(_sums(scored.filter("suffix is not null"), ["suffix"], "suffix_p", width), "langid-suffix")
    hosts = materialise(_sums(scored.filter("host is not null"), ["host"], "host_p", width), "langid-host")
    declared = materialise(_sums(scored.filter("declared is not null"), ["declared"], "said_p", width), "langid-declared")
    said_all = declared.agg(F.array(*[F.sum(F.col("said_p")[k]) for k in range(width)]).alias("said_all"), F.count("*").alias("kinds"))
    rows = scored.crossJoin(F.broadcast(every)).crossJoin(F.broadcast(said_all))  # one row each
    for side, key in ((suffixes, "suffix"), (hosts, "host"), (declared, "declared")):
        rows = rows.join(small_side(side), key, "left")

    def less(counts: str, k: int) -> Column:
        return F.greatest(F.coalesce(F.col(counts)[k], F.lit(0.0)) - F.when(F.col(counts).isNull(), 0.0).otherwise(F.col("p")[k]), F.lit(0.0))

    def normal(parts: list[Column]) -> list[Column]:
        total = sum(parts[1:], parts[0])
        return [x / total for x in parts]

    prior = normal([less("all_p", k) + 1.0 for k in range(width)])
    rows = rows.withColumn("prior", F.array(*prior))
    for counts in ("suffix_p", "host_p"):
        rows = rows.withColumn("prior", F.array(*normal([less(counts, k) + KAPPA * F.col("prior")[k] for k in range(width)])))
    said = [F.when(F.col("declared").isNull(), 0.0).otherwise(F.log((less("said_p", k) + 1.0) / (less("said_all", k) + F.col("kinds")))) for k in range(width)]
    rows = rows.withColumn("logp", F.array(*[F.col("ll")[k] + F.log(F.col("prior")[k]) + said[k] for k in range(width)]))
    top = F.array_max("logp")
    total = sum((F.exp(F.col("logp")[k] - top) for k in range(1, width)), F.exp(F.col("logp")[0] - top))
    names = F.array(*[F.lit(x) for x in (*langs, "und")])
    out = rows.select("key", names[(F.array_position("logp", top) - 1).cast("int")].alias("lang"), (F.lit(1.0) / total).alias("posterior"))
    return out.withColumn("accepted", (F.col("lang") != "und") & (F.col("posterior") >= least))


def row_key(*cols: Column) -> Column:
    """16 bytes that name a row by its columns' values."""
    parts = [F.coalesce(F.concat(F.lit("v"), c.cast("string")), F.lit("n")) for c in cols]
    return F.unhex(F.md5(F.concat_ws("\x1f", *parts)))


def identify(
    rows: DataFrame, model: TextModel, id_col: str, text: Column, declared: Column | None = None, suffix: Column | None = None, host: Column | None = None, least: float = LEAST,
) -> DataFrame:
    """(key, lang, posterior, accepted) of each distinct :func:`row_key` of id and text; repeated rows are one."""
    none = F.lit(None).cast("string")
    host = none if host is None else host
    scored = evidence(rows, model, row_key(F.col(id_col), text), text, none if declared is None else declared, suffix_of(host) if suffix is None else suffix, host)
    found = fuse(materialise(scored, "langid-evidence"), model.langs, least)
    return materialise(found.groupBy("key").agg(F.max(F.struct("accepted", "posterior", "lang")).alias("x")).select("key", "x.*"), "langid-found")


def identify_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", declared_col: str = "lang", host_col: str = "source") -> DataFrame:
    """:func:`identify` for documents: the declared language is a column, the source takes the host's place, there are no suffixes."""
    model = fit(docs, text_col, declared_col, id_col)
    return identify(docs, model, id_col, F.col(text_col).cast("string"), F.col(declared_col), F.lit(None).cast("string"), F.col(host_col))


def keep_identified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", declared_col: str = "lang", host_col: str = "source") -> DataFrame:
    """The rows of ``docs``, all columns, whose language is accepted.

    A NULL, empty or blank text has no language and goes.  NULL ids, sources and declarations are legal; an empty table
    stays empty.  Texts of any length count whole.  The text goes through Python once, for its score, and is never shuffled.
    """
    found = identify_documents(docs, id_col, text_col, declared_col, host_col)
    (key,) = spare(docs, "key")
    gone = materialise(found.filter("not accepted").select(F.col("key").alias(key)), "langid-gone")
    return docs.withColumn(key, row_key(F.col(id_col), F.col(text_col).cast("string"))).join(small_side(gone), key, "left_anti").drop(key)


def label_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", declared_col: str = "lang", host_col: str = "source") -> DataFrame:
    """(id, declared, detected, posterior, accepted) of every row.

    Texts that are NULL, empty, blank or like no known language are ``und`` and not accepted.  NULL ids, sources and
    declarations are legal, a NULL one says nothing; rows that repeat id and text are labelled alike; among equal
    posteriors the language that comes first wins; a text of any length counts whole; an empty table gives an empty one.
    """
    found = identify_documents(docs, id_col, text_col, declared_col, host_col)
    (key,) = spare(docs, "key")
    tagged = docs.select(F.col(id_col), F.col(declared_col).alias("declared"), row_key(F.col(id_col), F.col(text_col).cast("string")).alias(key))
    right = found.select(F.col("key").alias(key), F.col("lang").alias("detected"), F.round("posterior", 6).alias("posterior"), "accepted")
    return tagged.join(small_side(right), key).select(F.col(id_col), "declared", "detected", "posterior", "accepted")


def label_pages(pages: DataFrame, labelled: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, host, declared, detected, posterior, accepted) of every page; the text model is fitted on ``labelled`` documents.

    Pages without visible text (NULL, empty, markup alone) are ``und`` and not accepted.  A NULL or odd address has no
    host and no suffix; rows that repeat id and text are labelled alike; no pages, no rows.
    """
    model = fit(labelled, "text", "lang", "doc_id")
    one = pages.select(F.col(id_col).alias("id"), visible_text(F.col(html_col)).alias("text"), declared_in(F.col(html_col)).alias("declared"), host_of(F.col(url_col)).alias("host"))
    found = identify(one, model, "id", F.col("text"), F.col("declared"), None, F.col("host"))
    right = found.select(F.col("key").alias("k"), F.col("lang").alias("detected"), F.round("posterior", 6).alias("posterior"), "accepted")
    left = one.select(F.col("id").alias(id_col), "host", "declared", row_key(F.col("id"), F.col("text")).alias("k"))
    return left.join(small_side(right), "k").drop("k")
