"""Mending text that was taken from page images or PDF files: Column in, Column out; a fold over lines where a rule needs its own past."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import strip

HEADERS = (
    "abstract acknowledgements acknowledgments affiliation affiliations appendix approach author authors background bibliography conclusion conclusions discussion experiments implementation introduction keywords "
    "method methodology methods references results"
).split() + ["related work"]
#: Words that count as known in text without blanks; a fixed list, so that results do not depend on the machine.
WORDS = frozenset(
    "a about after all also an analysis and any are as at based be been between both but by can case data different do each effect even first for from further had has have high how however if in into is it its large less "
    "may method methods model more most new no not of on one only or other our paper present research results same section show shown since some study such system than that the their then there these they this those "
    "through time to two under up use used using value values was we well were when where which while will with within without work would".split()
)
#: Texts of which a Python worker holds copies at once.
SLICE_ROWS = 256
_LENGTHS = sorted({len(w) for w in WORDS}, reverse=True)


def lines(x: Column) -> Column:
    return F.split(x, "\n")


def _join(xs: Column) -> Column:
    return F.array_join(xs, "\n")


def _once(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


# ---- quality and failures


def fixed_point(v: Column, places: int = 0) -> Column:
    """A DOUBLE, not negative and under 2^53, with ``places`` digits as C's printf writes it: by its exact binary value, halves to even.

    Java's formatter rounds the shortest decimal form, halves up.  The fraction is cut in two, so that products are exact.
    """
    s = 10**places
    n = F.floor(v)
    f = v - n
    high = F.floor(f * (1 << 26)) / F.lit(float(1 << 26))
    m = F.floor(f * s)
    over = (high * s - m - 0.5) + (f - high) * s
    whole = n * s + m
    whole = whole + F.when((over > 0) | ((over == 0) & (whole % 2 == 1)), 1).otherwise(0)
    digits = F.floor(whole / s).cast("string") if places else whole.cast("string")
    return F.concat(digits, F.lit("."), F.lpad((whole % s).cast("string"), places, "0")) if places else digits


def quality_message(x: Column) -> Column:
    """'OK', or why a text is not fit for healing."""
    ls = lines(x)
    long_ = F.size(F.filter(ls, lambda s: F.length(s) > 1000))
    longest = F.array_max(F.transform(ls, F.length))
    blanks = F.regexp_count(x, F.lit(r"(?U)\s")) / F.length(x)
    mean = F.length(x) / F.size(ls)
    percent = lambda v: F.concat(fixed_point(v, 1), F.lit("%"))
    return (
        F.when(x.isNull() | (strip(x) == ""), "Empty file")
        .when(long_ / F.size(ls) > 0.2, F.concat(F.lit("Contains "), long_, F.lit(" extremely long lines ("), percent(long_ * 100 / F.size(ls)), F.lit(" of file, max: "), longest, F.lit(" chars)")))
        .when(blanks < 0.05, F.concat(F.lit("Very low whitespace ratio ("), percent(blanks * 100), F.lit(") - likely malformed extraction")))
        .when(mean > 1000, F.concat(F.lit("Unusually long average line length ("), fixed_point(mean), F.lit(" chars)")))
        .otherwise("OK")
    )


def failure_category(message: Column, recovered: Column | None = None) -> Column:
    """(category, recoverable) of a quality message; ``recovered``: the confidence of word recovery, 0 to 3, NULL where it was not tried."""
    m = F.lower(message)
    spaces = m.contains("whitespace ratio") | m.contains("extremely long lines")
    tried = F.lit(None).cast("int") if recovered is None else recovered
    category = (
        F.when(message.isNull() | (message == "OK"), "success").when(spaces & (tried >= 2), "partial").when(spaces & tried.isNotNull(), "unrecoverable").when(spaces, "no_spaces")
        .when(m.contains("encoding"), "encoding").when(m.contains("structure") | m.contains("malformed"), "malformed").otherwise("review")
    )
    return F.struct(category.alias("category"), category.isin("success", "partial", "encoding", "review").alias("recoverable"))


# ---- whole lines


def repeated_lines(x: Column, page: int = 50, share: float = 0.8, most_words: int = 12, least_count: int = 1) -> Column:
    """Lines of four characters and up to ``most_words`` words that occur on ``share`` of the pages, as estimated from the number of lines.

    With ``least_count`` 2, single lines of a short text are not taken for repeated ones.
    """
    def find(ls: Column) -> Column:
        plain = F.transform(ls, strip)
        short = F.filter(plain, lambda s: (F.length(s) >= 4) & (F.size(F.split(s, r"(?U)\s+")) <= most_words))
        cut = F.ceil(F.greatest(F.greatest(F.lit(1.0), F.size(ls) / F.lit(float(page))) * share, F.lit(float(least_count)))).cast("int")
        # in a sorted array a line occurs c times or more where it still stands c - 1 places on
        often = lambda xs: F.filter(F.transform(xs, lambda s, i: F.when(F.get(xs, i + cut - 1) == s, s)), lambda s: s.isNotNull())
        return F.array_distinct(_once(F.array_sort(short), often))

    return _once(lines(x), find)


def strip_repeated_lines(x: Column, page: int = 50, share: float = 0.8, most_words: int = 12, least_count: int = 1) -> Column:
    gone = repeated_lines(x, page, share, most_words, least_count)
    return _once(gone, lambda g: F.when(F.size(g) == 0, x).otherwise(_join(F.filter(lines(x), lambda s: ~F.array_contains(g, strip(s))))))


def remove_footers(x: Column) -> Column:
    """Empties lines of a number, of 'Page n of m', and of any text before a last pipe and number."""
    for shape in (r"^[ \t]*[0-9]+[ \t]*$", r"^[ \t]*(?:Page|Pg\.?)[ \t]*[0-9]+(?:[ \t]*of[ \t]*[0-9]+)?[ \t]*$", r"^.*?\|[ \t]*[0-9]+[ \t]*$"):
        x = F.regexp_replace(x, "(?md)" + shape, "")
    return x


def remove_noise(x: Column, citations: bool = False) -> Column:
    """Without character marks of PDF fonts and lines of encoded bytes; with ``citations``, without [n]."""
    y = F.regexp_replace(x, r"\(cid:[0-9]+\)", "")
    y = F.regexp_replace(y, r"\[[0-9]+\]", "") if citations else y
    return F.regexp_replace(y, r"(?md)^[A-Za-z0-9+/=]{40,}[ \t]*$", "")


def trim_leading_noise(x: Column) -> Column:
    """From the first line that has four letters in a row or begins with #; as it is where no line does."""
    def cut(ls: Column) -> Column:
        good = F.filter(F.transform(ls, lambda s, i: F.when(s.rlike("[A-Za-z]{4}") | strip(s).startswith("#"), i)), lambda i: i.isNotNull())
        return F.when(F.coalesce(F.array_min(good), F.lit(0)) == 0, x).otherwise(_join(F.slice(ls, F.array_min(good) + 1, F.size(ls))))

    return _once(lines(x), cut)


def drop_short_line_runs(x: Column, longest: int = 3, least: int = 5) -> Column:
    """Without runs of ``least`` or more lines of ``longest`` characters at most, blank ones included.

    A letter stands for each line, s or l, so that runs are parts of one short text; those that go become x.
    """
    def cut(ls: Column) -> Column:
        letters = F.array_join(F.transform(ls, lambda s: F.when(F.length(strip(s)) <= longest, "s").otherwise("l")), "")
        runs = F.transform(F.regexp_extract_all(letters, F.lit("s+|l+"), F.lit(0)), lambda r: F.when(r.startswith("s") & (F.length(r) >= least), F.repeat(F.lit("x"), F.length(r))).otherwise(r))
        return _once(F.split(F.array_join(runs, ""), ""), lambda marks: _join(F.filter(ls, lambda s, i: F.get(marks, i) != "x")))

    return _once(lines(x), cut)


def remove_blank_between_short(x: Column, longest: int = 24) -> Column:
    """Without blank lines between two short ones."""
    def cut(ls: Column) -> Column:
        at = lambda i: F.length(strip(F.coalesce(F.get(ls, i), F.lit(""))))
        return _join(F.filter(ls, lambda s, i: ~((strip(s) == "") & at(i - 1).between(1, longest) & at(i + 1).between(1, longest))))

    return _once(lines(x), cut)


def collapse_blank_lines(x: Column, most: int = 2) -> Column:
    """Ends of lines stripped; of a run of blank lines two stay, empty."""
    def cut(ls: Column) -> Column:
        blank = lambda i: F.coalesce(strip(F.get(ls, i)) == "", F.lit(False))
        kept = F.filter(F.transform(ls, lambda s, i: F.struct(F.regexp_replace(s, r"(?U)\s+$", "").alias("s"), i.alias("i"))), lambda t: (t["s"] != "") | ~(blank(t["i"] - 1) & blank(t["i"] - 2)))
        return _join(F.transform(kept, lambda t: t["s"]))

    if most != 2:
        raise ValueError("two blank lines are what the rule keeps")
    return _once(lines(x), cut)


def normalize_bullets(x: Column) -> Column:
    return F.regexp_replace(x, r"(?mU)^(\s*)[•●◦▪▫·‣]+\s*", "$1- ")


def fix_hyphenation(x: Column) -> Column:
    """Joins a word of two letters or more, a hyphen at the line's end and what begins in lower case on the next line."""
    return F.regexp_replace(x, r"([A-Za-z]{2,})-\s*[\r\n]\s*([a-z][\w-]*)", "$1$2")


# ---- kinds of lines


def is_section_header(x: Column) -> Column:
    """A known heading, a numbered one, capitals alone, or six words at most of which most are capitalised."""
    s = strip(x)
    words = F.filter(F.split(s, r"\s+"), lambda w: w != "")
    capital = lambda w: (F.upper(F.substring(w, 1, 1)) == F.substring(w, 1, 1)) & (F.lower(F.substring(w, 1, 1)) != F.substring(w, 1, 1))
    loud = (F.upper(s) == s) & (F.lower(s) != s) & (F.length(s) < 50)
    return (s != "") & (F.length(s) <= 100) & (
        F.lower(s).isin(*HEADERS) | s.rlike(r"^[0-9]+\.([0-9]+\.?)?\s+[A-Z]") | loud | ((F.size(words) <= 6) & (F.size(F.filter(words, capital)) / F.greatest(F.size(words), F.lit(1)) > 0.6))
    )


def is_complete_sentence(x: Column) -> Column:
    """Ends with . ! or ?, and with a full stop only from ten characters on."""
    s = strip(x)
    return s.rlike(r"[.!?]$") & ~(s.endswith(".") & (F.length(s) < 10))


def keeps_blank(before: Column, after: Column) -> Column:
    """Whether a blank line between two lines stands for a break."""
    b, a = strip(before), strip(after)
    begins = (F.upper(F.substring(a, 1, 1)) == F.substring(a, 1, 1)) & (F.lower(F.substring(a, 1, 1)) != F.substring(a, 1, 1))
    return (
        (F.coalesce(before, F.lit("")) == "") | (F.coalesce(after, F.lit("")) == "") | is_section_header(b) | is_section_header(a) | (F.length(b) < 50) | (is_complete_sentence(b) & (F.length(b) > 40)) | (is_complete_sentence(b) & begins)
    )


def is_table_line(x: Column) -> Column:
    return (F.length(x) - F.length(F.replace(x, F.lit("|"), F.lit(""))) >= 2) | x.rlike(r"\S\s{2,}\S")


def fences_unbalanced(x: Column) -> Column:
    return F.regexp_count(x, F.lit("```")) % 2 != 0


# ---- folds over lines (Arrow-batched)


def _header(s: str) -> bool:
    if not s or len(s) > 100:
        return False
    words = s.split()
    return s.lower() in HEADERS or bool(re.match(r"\d+\.(\d+\.?)?\s+[A-Z]", s)) or (s.isupper() and len(s) < 50) or (len(words) <= 6 and sum(w[0].isupper() for w in words) / len(words) > 0.6)


def _sentence(s: str) -> bool:
    return s[-1:] in ("!", "?") or (s[-1:] == "." and len(s) >= 10)


def _break(before: str, after: str) -> bool:
    b, a = before.strip(), after.strip()
    return not b or not a or _header(b) or _header(a) or len(b) < 50 or (_sentence(b) and (len(b) > 40 or a[0].isupper()))


def merge_fragments(text: str, longest: int = 12, least: int = 6) -> str:
    """``least`` or more short lines in a row, blank ones between them passed over, become one."""
    ls, out, i = text.split("\n"), [], 0
    while i < len(ls):
        if not 0 < len(ls[i].strip()) <= longest:
            out.append(ls[i])
            i += 1
            continue
        start = i
        while i < len(ls) and len(ls[i].strip()) <= longest:
            i += 1
        parts = [s.strip() for s in ls[start:i] if s.strip()]
        out += [" ".join(parts)] if len(parts) >= least else ls[start:i]
    return "\n".join(out)


def merge_broken_lines(text: str) -> str:
    """Lines of a paragraph become one; code, lists, quotes and headings keep their lines, breaks their blank line."""
    out: list[str] = []
    held, blanks, code = "", 0, False

    def flush() -> None:
        nonlocal held
        if held:
            out.append(held)
        held = ""

    for line in text.split("\n"):
        s = line.strip()
        if s.startswith("```"):
            flush()
            out.extend([""] * min(blanks, 2))
            out.append(s)
            code, blanks = not code, 0
        elif code:
            out.append(line.rstrip())
        elif not s:
            blanks += 1
        else:
            block = s[0] in "#>" or bool(re.match(r"(?:\d+\.|[A-Za-z]\.|[-*+])\s", s))
            if blanks > 1 or (blanks and (block or (held and _break(held, s)))):
                flush()
                out.append("")
            blanks = 0
            if block:
                flush()
                out.append(s)
            elif held:
                held = held[:-1] + s if held.endswith("-") else f"{held} {s}"
            else:
                held = s
    flush()
    return "\n".join(out)


def split_words(line: str) -> tuple[str, int]:
    """(line with blanks, how many): the cheapest division into words of 15 letters at most, known ones cheap; refused where under five words or 40 % known."""
    n, low = len(line), line.lower()
    cost, back = [0.0] * (n + 1), [0] * (n + 1)
    for j in range(1, n + 1):
        # the first place of the least cost wins; 4 to 15 letters cost 5, three 10, fewer 100, known words 1
        best, at = float("inf"), 0
        if j > 3:
            first = max(0, j - 15)
            window = cost[first : j - 3]
            best = min(window) + 5
            at = first + window.index(best - 5)
        for i, c in ((j - 3, 10), (j - 2, 100), (j - 1, 100)):
            if i >= 0 and cost[i] + c < best:
                best, at = cost[i] + c, i
        for k in _LENGTHS:
            i = j - k
            if i >= 0 and low[i:j] in WORDS and (cost[i] + 1 < best or (cost[i] + 1 == best and i < at)):
                best, at = cost[i] + 1, i
        cost[j], back[j] = best, at
    words, at = [], n
    while at:
        words.append(line[back[at] : at])
        at = back[at]
    words.reverse()
    if len(words) < 5 or sum(w.lower() in WORDS for w in words) / len(words) < 0.4:
        return line, 0
    return " ".join(words), len(words) - 1


def recover_words(text: str, least: int = 2) -> tuple[str, int, int]:
    """(text, confidence 0 to 3, lines changed) of a text without blanks; unchanged where confidence is under ``least``."""
    if len(text.split()) > 10:
        return text, 0, 0
    ls, changed = text.split("\n"), 0
    out = []
    for line in ls:
        s = line.strip()
        made, n = (line, 0) if len(s) < 20 or " " in s else split_words(s)
        changed += n > 0
        out.append(made if n else line)
    sure = 0 if not changed else 1 if changed < 0.3 * len(ls) else 2 if changed < 0.7 * len(ls) else 3
    return ("\n".join(out), sure, changed) if sure >= least else (text, sure, 0)


def _cells(block: list[str], sep: str) -> list[list[str]] | None:
    rows = [[c.strip() for c in re.split(sep, line)] for line in block]
    if len({len(r) for r in rows}) != 1 or len(rows[0]) < 2:
        return None
    keep = [k for k in range(len(rows[0])) if any(r[k] for r in rows)]
    rows = [[r[k] for k in keep] for r in rows if any(r)]
    return [r for r in rows if not all(re.fullmatch(r":?-+:?", c) for c in r)] or None


def repair_tables(text: str) -> str:
    """Blocks of two or more lines with pipes or wide gaps become Markdown tables; the first row is the head, empty names are col_n."""
    ls, out, i = text.split("\n"), [], 0
    like = lambda s: s.count("|") >= 2 or re.search(r"\S\s{2,}\S", s) is not None
    while i < len(ls):
        start = i
        while i < len(ls) and like(ls[i]):
            i += 1
        block = ls[start:i]
        rows = (_cells(block, r"\|") or _cells([s.strip() for s in block], r"\s{2,}")) if len(block) > 1 else None
        if rows:
            head = [c or f"col_{k}" for k, c in enumerate(rows[0])]
            widths = [max(len(r[k]) for r in [head, *rows[1:]]) for k in range(len(head))]
            show = lambda r: "| " + " | ".join(c.ljust(w) for c, w in zip(r, widths)) + " |"
            out += [show(head), "|" + "|".join(":" + "-" * (w + 1) for w in widths) + "|", *map(show, rows[1:])]
        else:
            out += block
        if i == start:
            out.append(ls[i])
            i += 1
    return "\n".join(out)


def finish(text: str, tables: bool = True) -> str:
    """The steps from merged fragments to tables; bullets, hyphens and blank lines as the Column functions of their names."""
    y = re.sub(r"(?m)^(\s*)[•●◦▪▫·‣]+\s*", r"\1- ", merge_fragments(text))
    y = merge_broken_lines(re.sub(r"([A-Za-z]{2,})-\s*[\r\n]\s*([a-z][\w-]*)", r"\1\2", y))
    out: list[str] = []
    for line in y.split("\n"):
        if line.strip() or out[-2:] != ["", ""]:
            out.append(line.rstrip())
    return repair_tables("\n".join(out)) if tables else "\n".join(out)


def by_rows(f, kind: str = "string"):
    """A Column function of a Python function of one text, in Arrow batches; NULL stays NULL."""

    def apply(x: Column) -> Column:
        if kind == "string":

            @F.pandas_udf("string")
            def run(s: pd.Series) -> pd.Series:
                return s.map(f, na_action="ignore")
        else:

            @F.pandas_udf(kind)
            def run(s: pd.Series) -> pd.DataFrame:
                return pd.DataFrame([(None,) * kind.count(",") + (None,) if v is None else f(v) for v in s], columns=[c.split()[0] for c in kind.split(", ")])

        return run(x)

    return apply


def restored(rows: DataFrame, column: str = "text", page: int = 50, share: float = 0.8, most_words: int = 12, tables: bool = True, citations: bool = False, least_count: int = 1) -> DataFrame:
    """``rows`` with the text after all steps in their fixed order and ``warnings``; one Python call a text."""
    x = F.col(column)
    trimmed = trim_leading_noise(x)
    gone = repeated_lines(trimmed, page, share, most_words, least_count)
    y = drop_short_line_runs(remove_footers(strip_repeated_lines(trimmed, page, share, most_words, least_count)))
    y = remove_blank_between_short(remove_noise(y, citations))
    notes = F.array(F.when(trimmed != x, "Trimmed leading noise before first paragraph"), F.when(F.size(gone) > 0, F.concat(F.lit("Removed repeated lines: "), F.array_join(F.slice(gone, 1, 5), ", "))))
    others = [c for c in rows.columns if c != column]
    before = rows.select(*others, y.alias("__text"), notes.alias("__notes"))  # the text as it was does not go to Python

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a slice at a time, so that few texts are Python strings at once and results leave early
        for whole in batches:
            for i in range(0, whole.num_rows, SLICE_ROWS):
                batch = whole.slice(i, SLICE_ROWS)
                done = [None if t is None else finish(t, tables) for t in batch.column("__text").to_pylist()]
                k = batch.schema.get_field_index("__text")
                yield pa.RecordBatch.from_arrays([pa.array(done, pa.string()) if j == k else c for j, c in enumerate(batch.columns)], batch.schema.names)

    made = before.mapInArrow(work, before.schema)
    odd = F.when(fences_unbalanced(F.col("__text")), "Detected unbalanced code fences")
    out = made.withColumn("warnings", F.array_compact(F.array_append("__notes", odd)))
    return out.select(*[F.col("__text").alias(c) if c == column else c for c in rows.columns], "warnings")
