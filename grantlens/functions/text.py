"""Text functions: Column in, Column out, native expressions only."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

BLANK_LINES = r"\n[ \t\r\f]*\n"
LIGATURES = {"ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl", "ﬃ": "ffi", "ﬄ": "ffl", "ﬅ": "st", "ﬆ": "st"}


def strip(x: Column) -> Column:
    return F.regexp_replace(x, r"^\s+|\s+$", "")


def paragraphs(text: Column, delimiter: str = BLANK_LINES) -> Column:
    """Stripped paragraphs, blank ones dropped; NULL gives none."""
    parts = F.transform(F.split(F.coalesce(text, F.lit("")), delimiter), strip)
    return F.filter(parts, lambda p: p != "")


def normalize_text(x: Column, fix_double_quotes: bool = True) -> Column:
    """Straight quotes, no LaTeX quotes, emphasis or bullet marks, single blanks; NULL gives ''."""
    y = F.regexp_replace(F.coalesce(x.cast("string"), F.lit("")), "[‘’]", "'")
    if fix_double_quotes:
        y = F.regexp_replace(y, "[“”]", '"')
    y = F.regexp_replace(F.regexp_replace(y, "``|''", '"'), "[*•⋆]", "")
    return F.trim(F.regexp_replace(F.trim(F.regexp_replace(y, r"\s+", " ")), r"\\([a-z])", "$1"))


#: What :func:`normalize_text` changes.
_UNEVEN = r"[‘’“”*•⋆\\\t\n\x0b\f\r]|``|''|^ |  | $"


def normalize_for_errors(x: Column) -> Column:
    """:func:`normalize_text` in lower case; a text in which it would change nothing is looked through once."""
    return F.lower(F.when(x.isNotNull() & ~x.rlike(_UNEVEN), x).otherwise(normalize_text(x)))


#: Loose accents in the order of their repair.
_ACCENTS = ((r"C´\s*aceres", "Cáceres"), (r"([A-Za-z])´\s*([a-z])", r"\1\2"), ("a`", "à"), ("e`", "è"), ("e´", "é"), ("a´", "á"), ("o´", "ó"), ("u´", "ú"), ("n~", "ñ"), ("N~", "Ñ"))


def integer_runs(numbers: list[int], least: int = 3) -> list[tuple[int, int]]:
    """(first, after last) of the maximal runs of ``least`` or more numbers that grow by one."""
    out, start = [], 0
    for k in range(1, len(numbers) + 1):
        if k == len(numbers) or numbers[k] != numbers[k - 1] + 1:
            if k - start >= least:
                out.append((start, k))
            start = k
    return out


def plain_funding_statement(x: str) -> str:
    """One blank for white space, Markdown escapes undone, loose accents joined to their letters, NFC, line numbers removed.

    Line numbers are runs of three or more consecutive integers that all end lines of the text, or that all stand before a
    hyphen, at the end, or after 'and' and at a line's end.
    """
    at_ends = {int(m[1]) for line in x.split("\n") if (m := re.search(r"\b(\d+)\s*$", line))}
    y = re.sub(r"\\([]_*[])", r"\1", re.sub(r"\s+", " ", x))
    for sign, letter in _ACCENTS:
        y = re.sub(sign, letter, y)
    y = unicodedata.normalize("NFC", y)
    spots = [(int(m[0]), m.start(), m.end()) for m in re.finditer(r"\b\d+\b", y)]

    def lone(n: int, a: int, b: int) -> bool:
        return (n in at_ends and re.search(r"and\s+$", y[max(0, a - 10) : a]) is not None) or re.match(r"\s*-", y[b : b + 10]) is not None or b == len(y)

    cuts = []
    for i, j in integer_runs([n for n, _, _ in spots]):
        run = spots[i:j]
        if all(n in at_ends for n, _, _ in run) or all(lone(*s) for s in run):
            cuts += [(a, b) for _, a, b in run]
    for a, b in reversed(cuts):
        low = len(y[:a].rstrip(" "))
        a = low if low == 0 or y[low - 1].isalnum() else min(a, low)
        b += 2 if b < len(y) - 1 and y[b : b + 2] in ("- ", " -") else 0
        glue = " " if a > 0 and b < len(y) and y[a - 1].isalnum() and y[b].isalnum() else ""
        y = y[:a] + glue + y[b:]
    return " ".join(y.split())


def normalize_funding_statement(x: Column) -> Column:
    """Column form of :func:`plain_funding_statement`, in Arrow batches; NULL stays NULL."""

    @F.pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        return s.map(plain_funding_statement, na_action="ignore")

    return run(x)


def acronyms(x: Column) -> Column:
    """Upper-case parts in parentheses of ten characters at most."""
    found = F.transform(F.regexp_extract_all(x, F.lit(r"\(([^)]+)\)"), F.lit(1)), lambda m: F.trim(m))
    return F.filter(found, lambda m: (F.length(m) <= 10) & (F.upper(m) == m) & (F.lower(m) != m))


def name_tokens(x: Column) -> Column:
    """Distinct lower-case parts between blanks, slashes, hyphens and commas."""
    return F.array_distinct(F.filter(F.split(F.lower(x), r"[\s,/-]+"), lambda t: t != ""))


def containment(a: Column, b: Column) -> Column:
    """The share of the tokens of ``a`` that ``b`` has; 0 without tokens."""
    n = F.size(name_tokens(a))
    return F.when(n > 0, F.size(F.array_intersect(name_tokens(a), name_tokens(b))) / n).otherwise(0.0)


def done_line(x: Column) -> Column:
    """(file, rows, elapsed_s) of a worker's log line of a finished file; NULL for others."""
    shape = r"\[done file=(\S+) rows=(\d+) elapsed_s=([\d.]+)\]"
    part = lambda k: F.regexp_extract(x, shape, k)
    return F.when(x.rlike(shape), F.struct(part(1).alias("file"), part(2).cast("bigint").alias("rows"), part(3).cast("double").alias("elapsed_s")))


def page_range(x: Column) -> Column:
    """(open_start, pages) of '1-5,8,-3': sorted distinct pages; an open end ('10-') gives its first page alone; NULL where there is no page."""
    parts = F.filter(F.transform(F.split(x, ","), lambda p: F.trim(p)), lambda p: p != "")
    low, high = lambda p: F.split(p, "-")[0].try_cast("int"), lambda p: F.split(p, "-")[1].try_cast("int")
    one = lambda p: F.when(p.startswith("-"), F.sequence(F.lit(1), high(p))).when(p.contains("-"), F.sequence(low(p), high(p))).otherwise(F.array(p.try_cast("int")))
    opens = F.get(F.filter(parts, lambda p: p.endswith("-")), F.lit(0))
    listed = F.array_sort(F.array_distinct(F.flatten(F.transform(F.filter(parts, lambda p: ~p.endswith("-")), one))))
    none = F.lit(None)
    return F.when(opens.isNotNull(), F.struct(low(opens).alias("open_start"), none.cast("array<int>").alias("pages"))).when(F.size(parts) > 0, F.struct(none.cast("int").alias("open_start"), listed.alias("pages")))


def repo_id(prefix: Column, model: Column, step: Column) -> Column:
    """``<prefix>-<last part of the model's name, lower case>-grpo-step<step>``."""
    return F.concat(prefix, F.lit("-"), F.lower(F.element_at(F.split(model, "/"), -1)), F.lit("-grpo-step"), step)


def open_thinking(x: Column) -> Column:
    """A think tag is opened and never closed."""
    return x.contains("<think>") & ~x.contains("</think>")


def over_long(x: Column, most: int = 8000) -> Column:
    """The error of a statement that is too long to be sent; NULL for others."""
    return F.when(F.length(x) > most, F.format_string("InputTooLong: %d chars > %d", F.length(x), F.lit(most)))


def bucket(tier: Column, augmented: Column, categories: Column) -> Column:
    """clean without augmentation, clean_relocated by its category, else the tier of the augmentation, or unknown."""
    moved = F.coalesce(F.array_contains(categories, "clean_relocated"), F.lit(False))
    return F.when(~F.coalesce(augmented, F.lit(False)), "clean").when(moved, "clean_relocated").otherwise(F.coalesce(tier, F.lit("unknown")))


def preprocess_statement(x: Column) -> Column:
    """Joins words broken by a hyphen before a lower-case letter, unfolds lines and ligatures, collapses blanks."""
    y = F.regexp_replace(F.regexp_replace(x, r"-\n([a-z])", "$1"), r"\n", " ")
    for glyph, letters in LIGATURES.items():
        y = F.replace(y, F.lit(glyph), F.lit(letters))
    return F.trim(F.regexp_replace(y, " {2,}", " "))


def is_table_like(x: Column) -> Column:
    """Separator rows, cells of digits alone, more than four pipes or more than three lines with pipes."""
    pipes = F.length(x) - F.length(F.replace(x, F.lit("|"), F.lit("")))
    lines = F.size(F.filter(F.split(x, "\n"), lambda s: s.contains("|")))
    return x.contains("|---") | x.rlike(r"\|\s*[0-9]+\s*\|") | (pipes > 4) | (lines > 3)


def canonical_filename(path: Column) -> Column:
    """Base name without .md, its first hyphen a dot, .md put back."""
    base = F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\.md$", "")
    return F.concat(F.regexp_replace(base, r"^([^-]*)-", "$1."), F.lit(".md"))


def normalize_award_id(x: Column) -> Column:
    return F.regexp_replace(F.upper(F.trim(x)), r"[\s/-]", "")


def soft_award_score(a: Column, b: Column) -> Column:
    """1 for equal normalised ids, 0.5 for two of six characters or more that are one edit apart, else 0."""
    x, y = normalize_award_id(a), normalize_award_id(b)
    close = (F.length(x) >= 6) & (F.length(y) >= 6) & (F.levenshtein(x, y) == 1)
    return F.when(x == y, 1.0).when(close, 0.5).otherwise(0.0)


def retry_seconds(x: Column) -> Column:
    """Seconds named by 'retry ... in [about] N unit'; NULL without such a hint."""
    shape = r"(?i)retry.*?in\s+(?:about\s+)?(\d+)\s+(second|minute|hour)s?"
    n, unit = F.regexp_extract(x, shape, 1), F.lower(F.regexp_extract(x, shape, 2))
    return F.when(n != "", n.cast("bigint") * F.when(unit == "hour", 3600).when(unit == "minute", 60).otherwise(1))


def f_beta(p: Column, r: Column, beta: float) -> Column:
    b = beta * beta
    return F.when(b * p + r > 0, (1 + b) * p * r / (b * p + r)).otherwise(0.0)
