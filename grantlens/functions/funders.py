"""Funders and awards: types, strict and lenient parsing of what a model said, flattening."""

from __future__ import annotations

import json
import re
from collections.abc import Iterable

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

AWARD = "struct<award_ids: array<string>, funding_scheme: array<string>, award_title: array<string>>"
FUNDERS = f"array<struct<funder_name: string, awards: array<{AWARD}>>>"
FIELDS = ("award_ids", "funding_scheme", "award_title")


def records(x: pa.Array) -> list[list[dict]]:
    """The funders of each element of an Arrow array of :data:`FUNDERS`, NULL lists as empty ones.

    Nested Arrow values cost far more to convert one by one than their flat columns and offsets do.
    """

    def split(a: pa.Array, items: list) -> list[list]:
        if not len(a):
            return []
        at, there = a.offsets.to_pylist(), [True] * len(a) if not a.null_count else a.is_valid().to_pylist()
        return [items[i:j] if ok else [] for i, j, ok in zip(at, at[1:], there)]

    funders = x.values
    awards = funders.field("awards")
    fields = [split(a, a.values.to_pylist()) for a in (awards.values.field(f) for f in FIELDS)]
    made = [dict(zip(FIELDS, v)) for v in zip(*fields)]
    names = funders.field("funder_name").to_pylist()
    return split(x, [{"funder_name": n, "awards": a} for n, a in zip(names, split(awards, made))])


def strip_fence(text: str) -> str:
    """What stands inside a code fence that is all of the text; else the text."""
    got = re.fullmatch(r"\s*```(?:json)?\s*(.*?)\s*```\s*", text, re.S)
    return got[1] if got else text


def _strict_award(x: object) -> dict:
    if not isinstance(x, dict):
        raise TypeError("an award is no object")
    out = {}
    for k in FIELDS:
        value = x.get(k, [])
        if not isinstance(value, list) or not all(isinstance(v, str) for v in value):
            raise TypeError(f"{k} is no list of strings")
        out[k] = value
    return out


def _strict_funder(x: object) -> dict:
    if not isinstance(x, dict):
        raise TypeError("a funder is no object")
    name, awards = x.get("funder_name"), x.get("awards", [])
    if name is not None and not isinstance(name, str):
        raise TypeError("funder_name is no string")
    if not isinstance(awards, list):
        raise TypeError("awards is no list")
    return {"funder_name": name, "awards": [_strict_award(a) for a in awards]}


def parse_strict(raw: str | None) -> tuple[list[dict] | None, str | None]:
    """(funders, error): a list of objects with strings in the right places, or why not."""
    try:
        got = json.loads(strip_fence(raw or "").strip())
    except json.JSONDecodeError as e:
        return None, f"ParseError: invalid JSON: {e.msg} at pos {e.pos}"
    if not isinstance(got, list):
        return None, f"ParseError: expected JSON array, got {type(got).__name__}"
    try:
        return [_strict_funder(x) for x in got], None
    except TypeError as e:
        return None, f"ParseError: schema mismatch: {e}"


def as_list(x: object) -> list[str]:
    """A list without NULLs and empty strings; one value is a list of one."""
    items = x if isinstance(x, list) else [x]
    return [v if isinstance(v, str) else json.dumps(v) for v in items if v is not None and v != ""]


def _award(x: dict) -> dict:
    return {k: as_list(x.get(k)) for k in FIELDS}


def as_funder(x: dict) -> dict:
    """A funder of an object with a list of awards or with award fields of its own."""
    awards = x.get("awards")
    if isinstance(awards, list):
        made = [_award(a) for a in awards if isinstance(a, dict)]
    else:
        made = [_award(x)] if "award_ids" in x and "awards" not in x else []
    name = x.get("funder_name")
    return {"funder_name": name if name is None or isinstance(name, str) else json.dumps(name), "awards": made}


def as_funders(x: object) -> list[dict]:
    """Funders of a list (what is no object is dropped), an object, or JSON text of either."""
    if isinstance(x, str):
        x = json.loads(x) if x else []
    return [as_funder(f) for f in ([x] if isinstance(x, dict) else x if isinstance(x, list) else []) if isinstance(f, dict)]


def parse_lenient(text: str | None) -> list[dict]:
    """Funders of a list, a wrapper with ``funders`` or one object, in a code fence anywhere or not; none on any failure."""
    if not text or not text.strip():
        return []
    fenced = re.search(r"```(?:json)?\s*\n?(.*?)\n?\s*```", text, re.S)
    try:
        got = json.loads((fenced[1] if fenced else text).strip())
        return as_funders(got["funders"] if isinstance(got, dict) and "funders" in got else got)
    except json.JSONDecodeError:
        return []


def strict_funders(raw: Column) -> Column:
    """Column form of :func:`parse_strict`: a struct of funders and error."""

    @F.pandas_udf(f"funders {FUNDERS}, error string")
    def parse(x: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([parse_strict(v) for v in x], columns=["funders", "error"])

    return parse(raw)


def lenient_funders(raw: Column) -> Column:
    """Column form of :func:`parse_lenient`."""

    @F.pandas_udf(FUNDERS)
    def parse(x: pd.Series) -> pd.Series:
        return pd.Series([parse_lenient(v) for v in x])

    return parse(raw)


def collected(funder: Column, field: str) -> Column:
    """All values of one field over a funder's awards."""
    return F.flatten(F.transform(funder["awards"], lambda a: F.coalesce(a[field], F.array().cast("array<string>"))))


def flat_awards(funders: Column) -> Column:
    """One element for each funder and award; a funder without awards has one of empty lists; an empty name is NULL."""
    none = F.array().cast("array<string>")

    def each(f: Column) -> Column:
        name = F.nullif(f["funder_name"], F.lit("")).alias("funder_name")
        empty = F.array(F.struct(name, *[none.alias(k) for k in FIELDS]))
        some = F.transform(f["awards"], lambda a: F.struct(F.nullif(f["funder_name"], F.lit("")).alias("funder_name"), *[F.coalesce(a[k], none).alias(k) for k in FIELDS]))
        return F.when(F.coalesce(F.size(f["awards"]), F.lit(0)) > 0, some).otherwise(empty)

    return F.flatten(F.transform(F.coalesce(funders, F.array().cast(FUNDERS)), each))


def messages(system: str, user: Column, assistant: Column | None = None) -> Column:
    """Chat messages: the system's, the user's and, for training, the assistant's answer."""
    one = lambda role, text: F.struct(F.lit(role).alias("role"), text.alias("content"))
    return F.array(one("system", F.lit(system)), one("user", user), *([] if assistant is None else [one("assistant", assistant)]))


def names_of(funders: Iterable[dict]) -> list[str]:
    return [f["funder_name"] for f in funders if f["funder_name"]]
