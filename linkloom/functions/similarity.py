"""Pairwise similarities as column expressions; all are 0 if a side is blank.

The measures that Spark lacks (Jaro, longest common subsequence, matching blocks) run in Arrow-batched
functions that take all pairs of a batch; equal pairs of a batch are computed once.
"""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .text import tokens

# ---------------------------------------------------------------- built-in measures


def guarded(a: Column, b: Column, value: Column) -> Column:
    """value where both texts are there, else 0 (P5)."""
    return F.when((a != "") & (b != ""), value.cast("double")).otherwise(F.lit(0.0))


def exact(a: Column, b: Column) -> Column:
    return guarded(a, b, a == b)


def levenshtein_similarity(a: Column, b: Column) -> Column:
    return guarded(a, b, 1 - F.levenshtein(a, b) / F.greatest(F.length(a), F.length(b), F.lit(1)))


def length_ratio(a: Column, b: Column) -> Column:
    return guarded(a, b, F.least(F.length(a), F.length(b)) / F.greatest(F.length(a), F.length(b), F.lit(1)))


def common_prefix(a: Column, b: Column) -> Column:
    """Length of the common prefix: the place before the first at which the characters differ."""
    same = F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: x.eqNullSafe(y))
    differs = F.array_position(same, False)
    return F.when(differs == 0, F.least(F.length(a), F.length(b))).otherwise(differs - 1)


def prefix_similarity(a: Column, b: Column) -> Column:
    return guarded(a, b, common_prefix(a, b) / F.greatest(F.least(F.length(a), F.length(b)), F.lit(1)))


def _of_sets(a: Column, b: Column, value: Column) -> Column:
    return F.when((F.size(a) > 0) & (F.size(b) > 0), value.cast("double")).otherwise(F.lit(0.0))


def jaccard(a: Column, b: Column) -> Column:
    """Of two arrays as sets."""
    return _of_sets(a, b, F.size(F.array_intersect(a, b)) / F.greatest(F.size(F.array_union(a, b)), F.lit(1)))


def overlap_coefficient(a: Column, b: Column) -> Column:
    fewer = F.least(F.size(F.array_distinct(a)), F.size(F.array_distinct(b)))
    return _of_sets(a, b, F.size(F.array_intersect(a, b)) / F.greatest(fewer, F.lit(1)))


def containment(a: Column, b: Column) -> Column:
    return _of_sets(a, b, (F.size(F.array_except(a, b)) == 0) | (F.size(F.array_except(b, a)) == 0))


def disjoint(a: Column, b: Column) -> Column:
    """Whether both sets have elements but share none."""
    return _of_sets(a, b, F.size(F.array_intersect(a, b)) == 0)


# ---------------------------------------------------------------- measures outside SQL


def jaro_of(a: str, b: str) -> float:
    if not a or not b:
        return 0.0
    if a == b:
        return 1.0
    reach = max(max(len(a), len(b)) // 2 - 1, 0)
    taken = bytearray(len(b))
    left = []
    for i, c in enumerate(a):
        at = b.find(c, max(0, i - reach), i + reach + 1)
        while at >= 0 and taken[at]:
            at = b.find(c, at + 1, i + reach + 1)
        if at >= 0:
            taken[at] = 1
            left.append(c)
    if not left:
        return 0.0
    m = len(left)
    right = [c for c, t in zip(b, taken, strict=True) if t]
    moved = sum(x != y for x, y in zip(left, right, strict=True)) // 2
    return (m / len(a) + m / len(b) + (m - moved) / m) / 3


def jaro_winkler_of(a: str, b: str, score: float | None = None) -> float:
    """score: the pair's Jaro similarity, if it is known."""
    score = jaro_of(a, b) if score is None else score
    if score > 0.7:
        same = 0
        for x, y in zip(a[:4], b[:4], strict=False):
            if x != y:
                break
            same += 1
        score += 0.1 * same * (1 - score)
    return score


def common_subsequence(a: str, b: str) -> int:
    """Length of the longest common subsequence, by bit-parallel rows."""
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for c in b:
        hit = row & places.get(c, 0)
        row = (row + hit | row - hit) & full
    return len(a) - row.bit_count()


def indel_of(a: str, b: str) -> float:
    return 2 * common_subsequence(a, b) / (len(a) + len(b)) if a or b else 1.0


def token_sort_of(a: str, b: str) -> float:
    return indel_of(" ".join(sorted(a.split())), " ".join(sorted(b.split()))) if a and b else 0.0


def token_set_of(a: str, b: str) -> float:
    if not a or not b:
        return 0.0
    x, y = set(a.split()), set(b.split())
    shared, only_x, only_y = " ".join(sorted(x & y)), " ".join(sorted(x - y)), " ".join(sorted(y - x))
    if shared and not (only_x and only_y):
        return 1.0
    gap = bool(shared)
    whole_x, whole_y = len(shared) + gap + len(only_x), len(shared) + gap + len(only_y)
    distance = len(only_x) + len(only_y) - 2 * common_subsequence(only_x, only_y)
    best = 1 - distance / (whole_x + whole_y)
    if shared:
        best = max(best, 2 * len(shared) / (len(shared) + whole_x), 2 * len(shared) / (len(shared) + whole_y))
    return best


def sequence_of(a: str, b: str) -> float:
    return SequenceMatcher(None, a, b, autojunk=False).ratio() if a and b else 0.0


def _per_pair(function, a: pd.Series, b: pd.Series) -> pd.Series:
    known: dict[tuple[str, str], float] = {}
    out = []
    for pair in zip(a.fillna(""), b.fillna(""), strict=True):
        if pair not in known:
            known[pair] = function(*pair)
        out.append(known[pair])
    return pd.Series(out, dtype="float64", index=a.index)


@F.pandas_udf(DoubleType())
def jaro(a: pd.Series, b: pd.Series) -> pd.Series:
    return _per_pair(jaro_of, a, b)


@F.pandas_udf(DoubleType())
def jaro_winkler(a: pd.Series, b: pd.Series) -> pd.Series:
    return _per_pair(jaro_winkler_of, a, b)


@F.pandas_udf(DoubleType())
def token_sort(a: pd.Series, b: pd.Series) -> pd.Series:
    return _per_pair(token_sort_of, a, b)


@F.pandas_udf(DoubleType())
def token_set(a: pd.Series, b: pd.Series) -> pd.Series:
    return _per_pair(token_set_of, a, b)


@F.pandas_udf(DoubleType())
def sequence_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    return _per_pair(sequence_of, a, b)


@F.pandas_udf(StructType([StructField(name, DoubleType()) for name in ("jaro", "jaro_winkler", "token_set", "token_sort")]))
def outside_sql(a: pd.Series, b: pd.Series) -> pd.DataFrame:
    """The four measures of one field in one crossing to Python."""
    a, b = a.fillna(""), b.fillna("")
    near = _per_pair(jaro_of, a, b)
    return pd.DataFrame({"jaro": near, "jaro_winkler": [jaro_winkler_of(*x) for x in zip(a, b, near, strict=True)], "token_set": _per_pair(token_set_of, a, b), "token_sort": _per_pair(token_sort_of, a, b)})


def text_statistics(prefix: str, a: Column, b: Column) -> dict[str, Column]:
    """The twelve statistics of a text field of a pair, in their contractual order."""
    far = outside_sql(a, b)
    ta, tb = tokens(a), tokens(b)
    values = {
        "exact": exact(a, b),
        "levenshtein": levenshtein_similarity(a, b),
        "jaro": far["jaro"],
        "jaro_winkler": far["jaro_winkler"],
        "jaccard": jaccard(ta, tb),
        "overlap": overlap_coefficient(ta, tb),
        "containment": containment(ta, tb),
        "token_set": far["token_set"],
        "token_sort": far["token_sort"],
        "prefix": prefix_similarity(a, b),
        "length_ratio": length_ratio(a, b),
        "missing": ((a == "") | (b == "")).cast("double"),
    }
    return {f"{prefix}_{k}": v for k, v in values.items()}
