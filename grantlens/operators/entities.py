"""Measuring extracted funders and statements against gold: matching, counts, metrics, rewards."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import similarity as S
from ..functions.funders import FIELDS, FUNDERS, records
from .relational import level_metrics, wins

LEVELS = ("funder", "award_id", "scheme", "title")
THRESHOLD = 0.8
Score = Callable[[str, str], float]


def normal_id(x: str, exact: bool = False) -> str:
    y = x.strip().upper()
    return y if exact else "".join(y.split()).replace("-", "").replace("/", "")


def match(gold: Sequence[str], said: Sequence[str], score: Score, least: float) -> list[tuple[int, int, float]]:
    """One-to-one pairs of the largest total score, each ``least`` at least."""
    if not gold or not said:
        return []
    table = [[float(score(g, p)) for p in said] for g in gold]
    return [(i, j, table[i][j]) for i, j in S.assign(table, least)]


def match_ids(gold: Sequence[str], said: Sequence[str], exact: bool = False, soft: bool = False) -> list[tuple[int, int, float]]:
    """Equal ids one to one; with ``soft``, what is left over pairs at 0.5 where ids of six characters or more are one edit apart."""
    x, y = [normal_id(g, exact) for g in gold], [normal_id(p, exact) for p in said]
    free: dict[str, list[int]] = {}
    for j, p in enumerate(y):
        free.setdefault(p, []).append(j)
    out = [(i, free[g].pop(0), 1.0) for i, g in enumerate(x) if free.get(g)]
    if soft and len(out) < len(x) and len(out) < len(y):
        a, b = [i for i in range(len(x)) if i not in {m[0] for m in out}], [j for j in range(len(y)) if j not in {m[1] for m in out}]
        near = lambda g, p: 0.5 if min(len(g), len(p)) >= 6 and _one_edit(g, p) else 0.0
        out += [(a[i], b[j], s) for i, j, s in match([x[i] for i in a], [y[j] for j in b], near, 0.5)]
    return out


def _one_edit(x: str, y: str) -> bool:
    if len(x) > len(y):
        x, y = y, x
    if len(y) - len(x) > 1 or x == y:
        return False
    k = next((i for i, (a, b) in enumerate(zip(x, y)) if a != b), len(x))
    return x[k + 1 :] == y[k + 1 :] if len(x) == len(y) else x[k:] == y[k + 1 :]


def _values(funder: dict, field: str) -> list[str]:
    awards = _items(funder["awards"])
    return _items(awards[0][field]) if len(awards) == 1 else [v for a in awards for v in _items(a[field])]


def _items(x: Any) -> list:
    return x if type(x) is list else [] if x is None else list(x)


def merge_funders(funders: Iterable[dict], least: float = THRESHOLD, score: Score = S.balanced) -> list[dict]:
    """Funders of like names as one: rounds of optimal self-matching until nothing pairs; awards without a name come last, together."""
    named = [(f["funder_name"], _items(f["awards"])) for f in funders if f["funder_name"]]
    nameless = [a for f in funders if not f["funder_name"] for a in _items(f["awards"])]
    while len(named) > 1:
        n = len(named)
        table = [[0.0] * n for _ in range(n)]
        for i in range(n):
            for j in range(i):
                s = score(named[j][0], named[i][0])
                table[i][j] = table[j][i] = s if s >= least else 0.0
        pairs, used = [], set()
        for i, j in S.assign(table, least):
            if i < j and not {i, j} & used:
                pairs.append((i, j))
                used |= {i, j}
        if not pairs:
            break
        named = [(named[i][0], named[i][1] + named[j][1]) for i, j in pairs] + [g for k, g in enumerate(named) if k not in used]
    out = [{"funder_name": name, "awards": awards} for name, awards in named]
    return out + ([{"funder_name": None, "awards": nameless}] if nameless else [])


def evaluate_funders(gold: Iterable[dict], said: Iterable[dict], funder_least: float = THRESHOLD, least: float = THRESHOLD, exact_ids: bool = False, score: Score = S.balanced, soft_ids: bool = False) -> list[tuple[float, float, float]]:
    """(gold, predicted, matched) of each of LEVELS: awards count as matched only inside matched funders; funders without a name form one pair."""
    a, b = merge_funders(gold, funder_least, score), merge_funders(said, funder_least, score)
    x, y = [i for i, f in enumerate(a) if f["funder_name"]], [j for j, f in enumerate(b) if f["funder_name"]]
    pairs = [(x[i], y[j]) for i, j, _ in match([a[i]["funder_name"] for i in x], [b[j]["funder_name"] for j in y], score, funder_least)]
    counts = [(float(len(x)), float(len(y)), float(len(pairs)))]
    if len(x) < len(a) and len(y) < len(b):
        pairs.append((len(a) - 1, len(b) - 1))
    for field in FIELDS:
        left, right = [_values(f, field) for f in a], [_values(f, field) for f in b]
        hits = 0.0
        for i, j in pairs:
            g, p = left[i], right[j]
            hits += sum(m[2] for m in match_ids(g, p, exact_ids, soft_ids)) if field == "award_ids" else _matched(g, p, score, least)
        counts.append((float(sum(map(len, left))), float(sum(map(len, right))), hits))
    return counts


def _matched(gold: Sequence[str], said: Sequence[str], score: Score, least: float) -> int:
    """How many pairs :func:`match` makes; all of the shorter side where each value is the same one."""
    if gold and said and len({*gold, *said}) == 1:
        s = score(gold[0], gold[0])
        return min(len(gold), len(said)) if s >= least and s > 0 else 0
    return len(match(gold, said, score, least))


def _f(counts: tuple[float, float, float], beta: float = 0.5) -> float:
    """F-beta; 1 where both sides are empty."""
    gold, said, hits = counts
    if not gold and not said:
        return 1.0
    p, r, b = hits / said if said else 0.0, hits / gold if gold else 0.0, beta * beta
    return (1 + b) * p * r / (b * p + r) if b * p + r else 0.0


def reward(gold: Sequence[dict], said: Sequence[dict], weights: Sequence[float] = (0.5, 0.5, 0.0, 0.0), flat_weight: float = 0.0, soft_ids: bool = False, least: float = THRESHOLD) -> dict[str, float]:
    """The hierarchical reward, or with ``flat_weight`` and ``soft_ids`` the shaped one, and its parts.

    Fields that neither side has inherit funder times id where there are funders at all.
    """
    counts = evaluate_funders(gold, said, least, least, soft_ids=soft_ids)
    ids = [[v for f in side for v in _values(f, "award_ids")] for side in (gold, said)]
    flat = _f((len(ids[0]), len(ids[1]), sum(m[2] for m in match_ids(*ids, soft=soft_ids))))
    f = [_f(c) for c in counts]
    if len(gold) or len(said):
        f[2:] = [f[0] * f[1] if not c[0] and not c[1] else v for c, v in zip(counts[2:], f[2:])]
    value = sum(w * v for w, v in zip(weights, f)) + flat_weight * flat
    return {"reward": value, **{f"{n}_f0_5": v for n, v in zip(LEVELS, f)}, "flat_award_id_f0_5": flat, "association_gap": flat - f[1]}


def shaped_reward(gold: Sequence[dict], said: Sequence[dict]) -> dict[str, float]:
    return reward(gold, said, (0.5, 0.4, 0.0, 0.0), 0.1, True)


def set_f1(gold: Iterable[dict], said: Iterable[dict]) -> tuple[float, str]:
    """(F1, feedback) of the sets of (name, scheme, ids)."""
    def keys(side: Iterable[dict]) -> set:
        return {(f["funder_name"] or "", tuple(sorted(_items(a["funding_scheme"]))), tuple(sorted(_items(a["award_ids"])))) for f in side for a in _items(f["awards"]) or [{"funding_scheme": [], "award_ids": []}]}

    a, b = keys(gold), keys(said)
    f = _f((len(a), len(b), len(a & b)), 1.0)
    missing, extra = sorted(x[0] for x in a - b), sorted(x[0] for x in b - a)
    return f, "correct" if a == b else f"missing: {', '.join(missing) or 'none'}; extra: {', '.join(extra) or 'none'}"


COUNTS = ", ".join(f"{n}_{k} double" for n in LEVELS for k in ("gold", "predicted", "matched"))


def entity_counts(rows: DataFrame, score: str = "balanced", funder_least: float = THRESHOLD, least: float = THRESHOLD, exact_ids: bool = False, soft_ids: bool = False) -> DataFrame:
    """``rows`` (funders, predicted_funders: ARRAY of funders) with twelve counts; one record is one Python call, in Arrow batches."""
    made = _counted(score, funder_least, least, exact_ids, soft_ids)
    return rows.withColumn("__c", made).select(*rows.columns, "__c.*")


def _counted(score: str, funder_least: float = THRESHOLD, least: float = THRESHOLD, exact_ids: bool = False, soft_ids: bool = False) -> Column:
    f, names = S.SIMILARITIES[score], [c.split()[0] for c in COUNTS.split(", ")]

    @F.arrow_udf(f"struct<{COUNTS.replace(' double', ': double')}>")
    def count(gold: pa.Array, said: pa.Array) -> pa.Array:
        made = [[x for c in evaluate_funders(g, p, funder_least, least, exact_ids, f, soft_ids) for x in c] for g, p in zip(records(gold), records(said))]
        return _struct(made, names)

    return count(F.col("funders").cast(FUNDERS), F.col("predicted_funders").cast(FUNDERS))


def _struct(rows: Sequence[Sequence[float]], names: Sequence[str]) -> pa.Array:
    columns = np.array(rows, float).reshape(len(rows), len(names)).T
    return pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(c)) for c in columns], list(names))


def micro_average(counts: DataFrame) -> DataFrame:
    """(level, gold, predicted, matched, precision, recall, f1, f0_5, f1_5) of all records together."""
    sums = counts.agg(*[F.coalesce(F.sum(f"{n}_{k}"), F.lit(0.0)).alias(f"{n}_{k}") for n in LEVELS for k in ("gold", "predicted", "matched")])
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("level"), *[F.col(f"{n}_{k}").alias(k) for k in ("gold", "predicted", "matched")]) for n in LEVELS]))
    return level_metrics(sums.select(each.alias("x")).select("x.*"))


def similarity_deltas(rows: DataFrame, kinds: Sequence[str] = ("permissive", "balanced", "strict")) -> DataFrame:
    """(level, f1_<kind>..., delta_<kind>...): F1 under each similarity and how far it is above the last one's."""
    parts = ("gold", "predicted", "matched")
    counted = rows.select(*[_counted(k).alias(k) for k in kinds])  # one pass for all kinds
    sums = counted.agg(*[F.coalesce(F.sum(f"{k}.{n}_{c}"), F.lit(0.0)).alias(f"{k}_{n}_{c}") for k in kinds for n in LEVELS for c in parts])
    each = F.array(*[F.struct(F.lit(n).alias("level"), *[F.col(f"{k}_{n}_{c}").alias(f"{k}_{c}") for k in kinds for c in parts]) for n in LEVELS])
    out = sums.select(F.explode(each).alias("x")).select("x.*")
    for k in kinds:
        out = level_metrics(out, *[f"{k}_{c}" for c in parts]).withColumn(f"f1_{k}", F.col("f1"))
    out = out.select("level", *[f"f1_{k}" for k in kinds])
    return out.withColumns({f"delta_{k}": F.round(F.col(f"f1_{k}") - F.col(f"f1_{kinds[-1]}"), 6) for k in kinds[:-1]})


def rewards(rows: DataFrame, shaped: bool = False) -> DataFrame:
    """``rows`` (funders, predicted_funders) with the reward and its parts."""
    names = ["reward", *(f"{n}_f0_5" for n in LEVELS), "flat_award_id_f0_5", "association_gap"]
    f = shaped_reward if shaped else reward

    @F.arrow_udf(f"struct<{', '.join(f'{n}: double' for n in names)}>")
    def value(gold: pa.Array, said: pa.Array) -> pa.Array:
        made = [f(g, p) for g, p in zip(records(gold), records(said))]
        return _struct([[r[n] for n in names] for r in made], names)

    return rows.withColumn("__r", value(F.col("funders").cast(FUNDERS), F.col("predicted_funders").cast(FUNDERS))).select(*rows.columns, "__r.*")


def statement_scores(rows: DataFrame, score: str = "permissive", least: float = 0.0) -> DataFrame:
    """``rows`` (gold, predicted: ARRAY<STRING>) with ``gold_best`` and ``predicted_best``, each statement's best score on the other side.

    A document's statements are compared with that document's alone.  Scores are exact from ``least`` on; those under it
    stay under it, which is all that a count of matches needs.
    """
    f = S.SIMILARITIES[score]
    if least and score in S.BOUNDED:
        f = lambda a, b: S.SIMILARITIES[score](a, b, least)

    @F.arrow_udf("struct<gold_best: array<double>, predicted_best: array<double>>")
    def best(gold: pa.Array, said: pa.Array) -> pa.Array:
        made = [([S.best_score(g, _items(b), f) for g in _items(a)], [S.best_score(p, _items(a), f) for p in _items(b)]) for a, b in zip(gold.to_pylist(), said.to_pylist())]
        kind = pa.list_(pa.float64())
        return pa.StructArray.from_arrays([pa.array([m[k] for m in made], kind) for k in (0, 1)], ["gold_best", "predicted_best"])

    return rows.withColumn("__b", best("gold", "predicted")).select(*rows.columns, "__b.*")


def statement_metrics(scored: DataFrame, least: float = 0.75, by: str | None = None) -> DataFrame:
    """Counts, precision, recall and F of scored statements; both sides are matched on their own, many to many.

    With ``by``, for each of its values and, as 'overall', for all rows.
    """
    hit = lambda c: F.coalesce(F.size(F.filter(c, lambda x: x >= least)), F.lit(0))
    sums: list[Column] = [
        F.sum(F.coalesce(F.size("gold"), F.lit(0))).alias("gold_n"), F.sum(F.coalesce(F.size("predicted"), F.lit(0))).alias("predicted_n"), F.sum(hit("gold_best")).alias("gold_matched"), F.sum(hit("predicted_best")).alias("predicted_matched"),
    ]
    out = scored.agg(*sums) if by is None else scored.rollup(by).agg(F.grouping(by).alias("__all"), *sums).withColumn(by, F.when(F.col("__all") == 1, "overall").otherwise(F.col(by))).drop("__all")
    p = F.when(F.col("predicted_n") > 0, F.col("predicted_matched") / F.col("predicted_n")).otherwise(0.0)
    r = F.when(F.col("gold_n") > 0, F.col("gold_matched") / F.col("gold_n")).otherwise(0.0)
    f = lambda b: F.round(F.when(b * b * p + r > 0, (1 + b * b) * p * r / (b * b * p + r)).otherwise(0.0), 6)
    return out.withColumns({"precision": F.round(p, 6), "recall": F.round(r, 6), "f1": f(1.0), "f0_5": f(0.5), "f1_5": f(1.5)})


def keep_known(predictions: DataFrame, gold: DataFrame, key: Column, gold_key: Column) -> tuple[DataFrame, DataFrame]:
    """(predictions whose key gold has, (discarded) how many have not)."""
    keys = gold.select(gold_key.alias("__key")).distinct()
    kept = predictions.join(keys, key == F.col("__key"), "left_semi")
    return kept, predictions.join(keys, key == F.col("__key"), "left_anti").agg(F.count("*").alias("discarded"))


def join_gold(predictions: DataFrame, gold: DataFrame, key: str, order: Sequence[str], last: bool = False, fold: bool = False, ties: Sequence[str] = ()) -> DataFrame:
    """``predictions`` with the gold columns of the first, or last, gold row of their key; with ``fold``, keys without outer blanks and case.

    Of rows that are equal in ``order`` the first in ``ties`` counts.
    """
    shape = (lambda c: F.lower(F.trim(c))) if fold else (lambda c: c)
    rest = [c for c in gold.columns if c != key and c not in order and c not in ties]
    by = [F.desc(c) if last else F.asc(c) for c in order] + [F.asc(c) for c in ties]
    one = wins(gold.withColumn("__key", shape(F.col(key))), ["__key"], by).select("__key", F.struct(*rest).alias("__g"))
    return predictions.join(one, shape(F.col(key)) == F.col("__key"), "left").select(*predictions.columns, *[F.col("__g")[c].alias(c) for c in rest])


def coverage(predictions: DataFrame, gold: DataFrame, key: str) -> DataFrame:
    """(side, n): keys on both sides, only predicted, only in gold."""
    a, b = predictions.select(key).distinct(), gold.select(key).distinct()
    sides = a.withColumn("p", F.lit(1)).join(b.withColumn("g", F.lit(1)), key, "full")
    side = F.when(F.col("p").isNull(), "gold_only").when(F.col("g").isNull(), "predicted_only").otherwise("both")
    return sides.groupBy(side.alias("side")).agg(F.count("*").alias("n"))
