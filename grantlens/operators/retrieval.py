"""From documents to funding statements: split, prefilter, score, gate, cut to the statement, deduplicate, rescue, filter.

A document's paragraphs lie in one row, so all of it is done inside the row's arrays: no step shuffles text.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions import text as T

TOP_K = 5
#: Scores above it need no pattern; a lexical score, as a late interaction of 32 query tokens, goes up to FULL_SCORE.
HIGH, FULL_SCORE = 14.0, 32.0
KEYWORDS = ("acknowledg", "award", "fellowship", "financial", "foundation", "fund", "grant", "scholarship", "sponsor", "support")
DENSITY_WORDS = (*KEYWORDS, "thank")
SENTENCE = r"(?i)\b(?:acknowledg|award|facilities|fellowship|fund|grant|hospitality|project|scholarship|support|thanks?)\w*\b"


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    return F.element_at(F.transform(F.array(value), use), 1)


def _has_any(low: Column, words: Sequence[str]) -> Column:
    out = low.contains(words[0])
    for w in words[1:]:
        out = out | low.contains(w)
    return out


def matches(x: Column, patterns: Sequence[str]) -> Column:
    """Whether a pattern matches; the expression is tried only where a word that it needs is in the text.

    Letters that Java folds to ASCII ones but lower case does not (long s, dotless and dotted i, the Kelvin sign) have it tried too.
    """
    needs = {p: P.required(p) for p in patterns}
    guarded, others = [p for p in patterns if needs[p]], [p for p in patterns if not needs[p]]
    out = None
    if guarded:
        words = sorted(frozenset().union(*(needs[p] for p in guarded)), key=lambda w: (len(w), w))
        words = [w for i, w in enumerate(words) if not any(v in w for v in words[:i])]
        there = _once(F.lower(x), lambda low: _has_any(low, words)) | _has_any(x, ["\u017f", "\u0131", "\u0130", "\u212a"])
        out = there & x.rlike(P.FLAGS + P.either(guarded))
    if others:
        rest = x.rlike(P.FLAGS + P.either(others))
        out = rest if out is None else out | rest
    return out


def score_floor(prefiltered: bool, given: float | None = None) -> float:
    """The least score of a paragraph with a positive pattern: 11 after the prefilter, else 3."""
    return given if given is not None else 11.0 if prefiltered else 3.0


def split_documents(docs: DataFrame, delimiter: str = T.BLANK_LINES) -> DataFrame:
    """(doc_id, para_idx, paragraph): positions count the paragraphs that are not blank."""
    return docs.select("doc_id", F.posexplode(T.paragraphs(F.col("text"), delimiter)).alias("para_idx", "paragraph"))


def _numbered(text: Column, prefilter_by: Sequence[str] | None) -> Column:
    """Array of (para_idx, paragraph); with patterns, only paragraphs that match or stand next to one that does."""
    parts = T.paragraphs(text)
    if prefilter_by is None:
        return F.transform(parts, lambda p, i: F.struct(i.alias("para_idx"), p.alias("paragraph")))
    flagged = F.transform(parts, lambda p: F.struct(p.alias("p"), matches(p, prefilter_by).alias("hit")))

    def near(xs: Column) -> Column:
        side = lambda i: F.coalesce(F.get(xs, i)["hit"], F.lit(False))
        marked = F.transform(xs, lambda x, i: F.struct(i.alias("para_idx"), x["p"].alias("paragraph"), (x["hit"] | side(i - 1) | side(i + 1)).alias("keep")))
        return F.transform(F.filter(marked, lambda x: x["keep"]), lambda x: F.struct(x["para_idx"].alias("para_idx"), x["paragraph"].alias("paragraph")))

    return F.element_at(F.transform(F.array(flagged), near), 1)


def prefilter(docs: DataFrame, patterns: Sequence[str] = P.BROAD) -> DataFrame:
    """(doc_id, para_idx, paragraph) of paragraphs that match or stand next to one that does."""
    return docs.select("doc_id", F.explode(_numbered(F.col("text"), patterns)).alias("x")).select("doc_id", "x.para_idx", "x.paragraph")


def ranked_paragraphs(docs: DataFrame, k: int = TOP_K, queries: Mapping[str, str] = P.QUERIES, patterns: Sequence[str] | None = P.BROAD) -> DataFrame:
    """(doc_id, q_pos, query, rank, para_idx, paragraph, score): the ``k`` best paragraphs of each document and query, ties by position.

    The encoder is lexical: late interaction of one-hot word vectors, a query's words weighing FULL_SCORE together.
    Paragraphs are first cut down to the words that any query has.
    """
    lists = _ranked(docs, k, queries, patterns).select("doc_id", "ps", F.explode("qs").alias("q"))
    # only places are exploded; a paragraph's text is taken from its row
    rows = lists.select("doc_id", "ps", "q.q_pos", "q.query", "q.n", F.posexplode("q.best").alias("rank", "b"))
    return rows.select(
        "doc_id", "q_pos", "query", (F.col("rank") + 1).alias("rank"), "b.para_idx", F.get("ps", F.col("b.at"))["paragraph"].alias("paragraph"), (-F.col("b.less") * (F.lit(FULL_SCORE) / F.col("n"))).alias("score")
    )


def _ranked(docs: DataFrame, k: int, queries: Mapping[str, str], patterns: Sequence[str] | None) -> DataFrame:
    """(doc_id, ps, qs): a document's paragraphs, and for each query the places of its ``k`` best."""
    vocabulary = F.array(*[F.lit(w) for w in sorted({w for t in queries.values() for w in t.lower().split()})])
    words = lambda p: F.array_intersect(F.split(F.lower(F.regexp_replace(p, r"[^A-Za-z0-9]+", " ")), " "), vocabulary)
    made = F.array(*[F.struct(F.lit(i).alias("q_pos"), F.lit(n).alias("query"), F.array(*[F.lit(w) for w in dict.fromkeys(t.lower().split())]).alias("words")) for i, (n, t) in enumerate(queries.items())])
    parts = F.transform(_numbered(F.col("text"), patterns), lambda x: F.struct(x["para_idx"].alias("para_idx"), x["paragraph"].alias("paragraph"), words(x["paragraph"]).alias("words")))

    def best(ps: Column, q: Column) -> Column:
        scored = F.transform(ps, lambda p, i: F.struct((-F.size(F.array_intersect(p["words"], q["words"]))).alias("less"), p["para_idx"].alias("para_idx"), i.alias("at")))
        return F.slice(F.array_sort(scored), 1, k)

    qs = lambda ps: F.transform(made, lambda q: F.struct(q["q_pos"].alias("q_pos"), q["query"].alias("query"), F.size(q["words"]).alias("n"), best(ps, q).alias("best")))
    # bound in one expression: as a column of its own, the optimizer may put the paragraphs' expression into each query
    return docs.select("doc_id", _once(parts, lambda ps: F.struct(ps.alias("ps"), qs(ps).alias("qs"))).alias("r")).select("doc_id", "r.ps", "r.qs")


def max_similarity(paragraph_tokens: DataFrame, query_tokens: DataFrame) -> DataFrame:
    """(doc_id, para_idx, q_pos, score): for each query token the largest inner product with any paragraph token, summed.

    ``paragraph_tokens``: (doc_id, para_idx, vectors), ``query_tokens``: (q_pos, vectors), both ARRAY<ARRAY<FLOAT>>, not
    padded.  The queries are as many as the configuration names: they are broadcast.  A paragraph without tokens scores 0.
    """
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)
    pairs = paragraph_tokens.withColumnRenamed("vectors", "tokens").crossJoin(F.broadcast(query_tokens.withColumnRenamed("vectors", "asked")))
    total = F.aggregate(F.transform("asked", lambda q: F.array_max(F.transform("tokens", lambda t: dot(q, t)))), F.lit(0.0), lambda s, x: s + F.coalesce(x, F.lit(0.0)))
    return pairs.select("doc_id", "para_idx", "q_pos", total.alias("score"))


def encoded(paragraphs: DataFrame, encode: Callable[[Sequence[str]], Sequence[np.ndarray]], text_col: str = "paragraph", batch: int = 512) -> DataFrame:
    """``paragraphs`` with ``vectors``, the token vectors by an encoder function (Arrow batches, texts sorted by length).

    Where the encoder runs out of memory (MemoryError) the batch is halved, down to one text, for which the error is raised.
    """

    def run(texts: list[str], size: int) -> list[np.ndarray]:
        out: list[np.ndarray] = []
        at = 0
        while at < len(texts):
            try:
                out += list(encode(texts[at : at + size]))
                at += size
            except MemoryError:
                if size == 1:
                    raise
                size = max(1, size // 2)
        return out

    @F.pandas_udf("array<array<float>>")
    def vectors(x: pd.Series) -> pd.Series:
        texts = x.fillna("")
        order = np.argsort(texts.str.len().to_numpy(), kind="stable")  # least padding within a batch
        made = run([texts.iloc[i] for i in order], batch)
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        return pd.Series([np.asarray(made[j], np.float32).tolist() for j in back])

    return paragraphs.withColumn("vectors", vectors(text_col))


def top_k(scores: DataFrame, k: int = TOP_K) -> DataFrame:
    """The ``k`` best paragraphs of each document and query of a table of scores, ties by position."""
    w = Window.partitionBy("doc_id", "q_pos").orderBy(F.desc("score"), "para_idx")
    return scores.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def gate(score: Column, paragraph: Column, floor: float, positive: Sequence[str] = P.POSITIVE, negative: Sequence[str] = P.NEGATIVE) -> Column:
    """Accept high scores; reject negatives; accept positives above the floor.  Patterns are only tried where they can decide."""
    return F.when(score > HIGH, True).when(score <= floor, False).when(matches(paragraph, negative), False).otherwise(matches(paragraph, positive))


def _hits(p: Column, keywords: Sequence[str]) -> Column:
    """Places, from 1, where a keyword begins; no keyword begins with another or overlaps itself."""
    shape = "(?:" + "|".join(keywords) + ")"

    def places(low: Column) -> Column:
        # each piece but the first begins with a keyword, so ends of pieces are the places of the next
        step = lambda a, n: F.struct((a["at"] + n).alias("at"), F.array_append(a["all"], a["at"] + n).alias("all"))
        first = F.when(low.rlike("^" + shape), F.array(F.lit(1))).otherwise(F.array().cast("array<int>"))
        ends = lambda xs: F.aggregate(F.slice(xs, 1, F.size(xs) - 1), F.struct(F.lit(1).alias("at"), first.alias("all")), step, lambda a: a["all"])
        found = _once(F.transform(F.split(low, f"(?={shape})"), F.length), ends)
        return F.when(_has_any(low, keywords), F.filter(found, lambda i: i <= F.length(p))).otherwise(F.array().cast("array<int>"))

    return _once(F.lower(p), places)


def takes_whole(p: Column, score: Column) -> Column:
    """Whether the statement is the full paragraph: a high score, a short one, dense keywords, or three within 300 characters."""
    words = F.filter(F.split(F.lower(p), r"(?U)\s+"), lambda w: w != "")
    dense = F.size(F.filter(words, lambda w: w.rlike("|".join(DENSITY_WORDS)))) / F.size(words)
    close = lambda xs: F.exists(F.transform(xs, lambda x, i: F.get(xs, i + 2) - x), lambda d: d < 300)
    near = F.element_at(F.transform(F.array(_hits(p, DENSITY_WORDS)), close), 1)
    return F.when((score > HIGH) | (F.length(p) < 500), True).otherwise((dense > 0.05) | F.coalesce(near, F.lit(False)))


def funding_sentences(p: Column) -> Column:
    """The sentences that name funding, one blank between them; NULL where none does."""
    kept = F.filter(F.split(p, r"(?U)(?<=[.!?])\s+(?=[A-Z])"), lambda s: s.rlike(SENTENCE))
    return F.when(F.size(kept) > 0, F.array_join(F.transform(kept, T.strip), " "))


def long_window(p: Column) -> Column:
    """From 100 characters before the first keyword to 200 after the last begins, moved to sentence ends nearby."""

    def cut(xs: Column) -> Column:
        first, last = xs[0] - 1, F.element_at(xs, -1) - 1  # from 0
        start, end = F.greatest(first - 100, F.lit(0)), F.least(last + 200, F.length(p))
        low = F.greatest(start - 50, F.lit(0))
        before = F.substring(p, low + 1, start - low)
        start = F.when(before.rlike(r"[.!?\n]"), start - F.length(F.regexp_replace(before, r"(?s)^.*[.!?\n]", ""))).otherwise(start)
        after = F.substring(p, end + 1, F.lit(100))
        end = F.when(after.rlike("[.!?]"), end + F.length(F.regexp_extract(after, r"(?s)^([^.!?]*[.!?])", 1))).otherwise(end)
        return T.strip(F.substring(p, start + 1, end - start))

    return F.element_at(F.transform(F.array(_hits(p, KEYWORDS)), lambda xs: F.when(F.size(xs) > 0, cut(xs)).otherwise(p)), 1)


def statement_text(p: Column, score: Column) -> Column:
    """The statement of an accepted paragraph; NULL where no sentence names funding."""
    return F.when(takes_whole(p, score), p).when(F.length(p) > 1000, long_window(p)).otherwise(funding_sentences(p))


def confidence(x: Column) -> tuple[Column, Column]:
    """(score, markers) of a statement: what its wording says, whatever its retrieval score."""
    hit = [matches(F.lower(x), p) for _, _, p in P.MARKERS]
    score = F.greatest(F.lit(0), sum((F.when(h, w).otherwise(0) for h, (_, w, _) in list(zip(hit, P.MARKERS))[1:]), F.when(hit[0], P.MARKERS[0][1]).otherwise(0)))
    return score, F.array_compact(F.array(*[F.when(h, n) for h, (n, _, _) in zip(hit, P.MARKERS)]))


def keep_statement(conf: Column, score: Column, high: float = 30.0, low: float = 10.0, boost: float = 12.0) -> tuple[Column, Column]:
    """(keep, reason) by the ordered table of the post filter."""
    c, s = F.format_string("%.0f", conf.cast("double")), F.format_string("%.1f", score.cast("double"))
    rules = (
        (conf >= high, True, F.concat(F.lit("high_confidence ("), c, F.lit(")"))), ((score >= boost) & (conf >= 10), True, F.concat(F.lit("high_semantic ("), s, F.lit(") + markers"))),
        (conf < low, False, F.concat(F.lit("low_confidence ("), c, F.lit(")"))), (conf >= 20, True, F.concat(F.lit("medium_confidence ("), c, F.lit(")"))),
        (score >= 12.0, True, F.concat(F.lit("medium_confidence + semantic ("), s, F.lit(")"))), (F.lit(True), False, F.concat(F.lit("insufficient_confidence ("), c, F.lit(")"))),
    )
    keep, why = F.when(rules[0][0], F.lit(rules[0][1])), F.when(rules[0][0], rules[0][2])
    for test, verdict, reason in rules[1:]:
        keep, why = keep.when(test, F.lit(verdict)), why.when(test, reason)
    return keep, why


def apply_post_filter(statements: DataFrame, high: float = 30.0, low: float = 10.0, boost: float = 12.0) -> DataFrame:
    """``statements`` (statement, score, ...) that the post filter keeps, with ``confidence`` and ``reason``."""
    keep, why = keep_statement(F.col("confidence"), F.col("score"), high, low, boost)
    return statements.withColumn("confidence", confidence(F.col("statement"))[0]).withColumns({"__keep": keep, "reason": why}).filter("__keep").drop("__keep")


def first_statements(rows: DataFrame, least: int = 20) -> DataFrame:
    """The first occurrence of each statement of a document in query and rank order; ``least`` characters or fewer go."""
    w = Window.partitionBy("doc_id", "statement").orderBy("q_pos", "rank")
    return rows.filter(F.length("statement") > least).withColumn("rn", F.row_number().over(w)).filter("rn = 1").drop("rn")


def extract_statements(
    docs: DataFrame, k: int = TOP_K, queries: Mapping[str, str] = P.QUERIES, use_prefilter: bool = True, floor: float | None = None, rescue_too: bool = False, post_filter: bool = False,
) -> DataFrame:
    """(doc_id, para_idx, query, score, confidence, statement)."""
    least = score_floor(use_prefilter, floor)
    parts = _ranked(docs, k, queries, P.BROAD if use_prefilter else None)
    # a paragraph is taken from its row once, with the queries that may accept it; patterns and texts are tried once for it
    hit = lambda q: F.transform(q["best"], lambda b, i: F.struct(b["at"].alias("at"), q["q_pos"].alias("q_pos"), q["query"].alias("query"), (i + 1).alias("rank"), (-b["less"] * (F.lit(FULL_SCORE) / q["n"])).alias("score")))
    hits = F.filter(F.flatten(F.transform("qs", hit)), lambda h: (h["score"] > HIGH) | (h["score"] > least))
    several = lambda hs: F.transform(F.array_distinct(F.transform(hs, lambda h: h["at"])), lambda at: F.struct(F.get("ps", at).alias("p"), F.filter(hs, lambda h: h["at"] == at).alias("hits")))
    each = parts.select("doc_id", F.explode(_once(hits, several)).alias("x")).select("doc_id", "x.p.para_idx", "x.p.paragraph", "x.hits")
    p, low = F.col("paragraph"), F.exists("hits", lambda h: h["score"] <= HIGH)
    judged = each.withColumn("passes", F.when(low, gate(F.lit(HIGH), p, -1.0))).withColumn("cut", F.when(F.col("passes"), statement_text(p, F.lit(0.0))))
    one = judged.select("doc_id", "para_idx", "paragraph", "passes", "cut", F.explode("hits").alias("h")).select("*", "h.*").filter((F.col("score") > HIGH) | F.col("passes"))
    found = first_statements(one.select("doc_id", "para_idx", "q_pos", "query", "rank", "score", F.when(F.col("score") > HIGH, F.col("paragraph")).otherwise(F.col("cut")).alias("statement")))
    rows = found.select("doc_id", "para_idx", "query", "score", "statement")
    if rescue_too:
        rows = rows.unionByName(rescue(docs, rows))
    rows = apply_post_filter(rows).drop("reason") if post_filter else rows.withColumn("confidence", confidence(F.col("statement"))[0])
    return rows.select("doc_id", "para_idx", "query", "score", "confidence", "statement")


def rescue(docs: DataFrame, existing: DataFrame | None = None, least: int = 20) -> DataFrame:
    """(doc_id, para_idx, query, score, statement) of paragraphs that strong patterns mark, whatever their score.

    Two strong patterns, or one and a positive one, and no negative one.  Paragraphs and statements that ``existing``
    (doc_id, statement) has, but for case, are passed over; of equal ones of a document the first stays.
    """
    p, low = F.col("paragraph"), F.lower("paragraph")
    strong = sum((matches(low, [x]).cast("int") for x in P.STRONG[1:]), matches(low, [P.STRONG[0]]).cast("int"))
    rows = split_documents(docs).withColumn("strong", strong)
    rows = rows.filter(~matches(low, P.NEGATIVE) & ((F.col("strong") >= 2) | ((F.col("strong") >= 1) & matches(low, P.POSITIVE))))
    whole = F.when(F.length(p) < 500, p).otherwise(F.coalesce(funding_sentences(p), F.when(F.length(p) > 1000, long_window(p)).otherwise(p)))
    rows = rows.withColumn("statement", whole).filter(F.length("statement") >= least)
    same = lambda x: F.lower(T.strip(x))
    if existing is not None:
        old = existing.select(F.col("doc_id").alias("e_doc"), same(F.col("statement")).alias("e_text")).distinct()
        rows = rows.join(old, (F.col("doc_id") == F.col("e_doc")) & ((same(F.col("statement")) == F.col("e_text")) | (same(p) == F.col("e_text"))), "left_anti")
    first = Window.partitionBy("doc_id", same(F.col("statement"))).orderBy("para_idx")
    kept = rows.withColumn("rn", F.row_number().over(first)).filter("rn = 1")
    return kept.select("doc_id", "para_idx", F.lit("pattern_rescue").alias("query"), F.lit(0.0).alias("score"), "statement")
