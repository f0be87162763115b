"""Profiles of sources and labels: counts, distributions, tokens, percentages."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import character_flags, is_missing, script_label, tokens
from ..sources.staging import spread, stage


def distribution(rows: DataFrame, value: str, by: str | None = None) -> DataFrame:
    """count, min, max, mean and discrete median and p95 of an integer column.

    Values are counted first, so the running sum sees one row per distinct value.
    """
    keys = [by] if by else []
    counts = rows.groupBy(*keys, F.col(value).cast("long").alias("v")).agg(F.count(F.lit(1)).alias("c")).withColumn("all", F.lit(0))
    w = Window.partitionBy(*(keys or ["all"]))
    upto = w.orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counts = counts.withColumns({"running": F.sum("c").over(upto), "total": F.sum("c").over(w)})
    reached = lambda p: F.min(F.when(F.col("running") >= F.greatest(F.lit(1), F.ceil(F.col("total") * p)), F.col("v")))
    return counts.groupBy(*keys).agg(F.sum("c").alias("count"), F.min("v").alias("min"), F.max("v").alias("max"), F.round(F.sum(F.col("v") * F.col("c")) / F.sum("c"), 6).alias("mean"), reached(0.5).alias("median"), reached(0.95).alias("p95"))


def token_counts(rows: DataFrame, *columns: str) -> DataFrame:
    """token, n over some columns (A5)."""
    each = F.explode(F.concat(*(tokens(F.col(c)) for c in columns))).alias("token")
    return rows.select(each).groupBy("token").agg(F.count(F.lit(1)).alias("n"))


def common_tokens(counts: DataFrame, k: int = 30) -> DataFrame:
    return counts.orderBy(F.desc("n"), "token").limit(k)


def rare_tokens(counts: DataFrame, k: int = 30) -> DataFrame:
    return counts.orderBy("n", "token").limit(k)


def unique_nonblank(rows: DataFrame, *columns: str) -> DataFrame:
    """Exact distinct non-blank values per column (A3)."""
    return rows.agg(*(F.count_distinct(F.when(F.col(c) != "", F.col(c))).alias(f"unique_{c}") for c in columns))


def duplicates(rows: DataFrame, id_col: str, by: str) -> DataFrame:
    """Rows beyond the first of their id (A2)."""
    per_id = rows.groupBy(by, id_col).agg(F.count(F.lit(1)).alias("n"))
    return per_id.groupBy(by).agg(F.sum("n").alias("n_rows"), (F.sum("n") - F.count(F.lit(1))).alias("n_duplicates"))


def flag_percentages(rows: DataFrame, flags: dict[str, Column]) -> DataFrame:
    """Count and percentage of each flag, a row per flag; null percentages without rows."""
    n = F.count(F.lit(1))
    one = rows.agg(n.alias("n"), *(F.count_if(v).alias(k) for k, v in flags.items()))
    each = F.explode(F.array(*(F.struct(F.lit(k).alias("flag"), F.col(k).alias("n_true")) for k in flags)))
    return one.select("n", each.alias("x")).select("x.flag", "x.n_true", F.round(F.try_divide(100 * F.col("x.n_true"), F.col("n")), 6).alias("percentage"))


def source_flags(name: Column, address: Column, country: Column) -> dict[str, Column]:
    """Missing fields and character flags of a record."""
    joined = F.concat_ws(" ", name, address)
    return {"missing_name": is_missing(name), "missing_address": is_missing(address), "missing_country": is_missing(country)} | character_flags(joined)


def group_counts(rows: DataFrame, key: Column, name: str) -> DataFrame:
    return rows.groupBy(key.alias(name)).agg(F.count(F.lit(1)).alias("n"))


def script_counts(rows: DataFrame, *columns: str) -> DataFrame:
    return group_counts(rows, script_label(F.concat_ws(" ", *columns)), "script")


def repeated_values(rows: DataFrame, column: str) -> DataFrame:
    """Number of non-blank values that occur more than once."""
    return rows.filter(F.col(column) != "").groupBy(column).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").agg(F.count(F.lit(1)).alias("n_repeated"))


def truth_cardinality(queries: DataFrame, links: DataFrame) -> DataFrame:
    """Singletons, one, two, three and more matches, and links per source (A20); links (qid, tid)."""
    per_link = links.select("qid", "tid").distinct().groupBy("qid").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("tid").startswith("S2-")).alias("s2"), F.count_if(F.col("tid").startswith("S3-")).alias("s3"))
    every = queries.select("qid").join(per_link, "qid", "left").fillna(0)
    n = F.col("n")
    return every.agg(
        F.count(F.lit(1)).alias("n_queries"), F.round(100 * F.try_divide(F.count_if(n == 0), F.count(F.lit(1))), 6).alias("singleton_percentage"), F.count_if(n == 1).alias("one_match"), F.count_if(n == 2).alias("two_matches"), F.count_if(n >= 3).alias("three_plus"),
        F.sum("n").alias("total_links"), F.sum("s2").alias("source2_links"), F.sum("s3").alias("source3_links"), F.round(F.avg("n"), 6).alias("average_matches"),
    )


CELLS = 4096
#: Rows that are sent to all tasks at most.
FEW = 250_000


def exact_quantiles(rows: DataFrame, value: str, keys: list[str], shares: tuple[float, ...]) -> DataFrame:
    """keys, n, mean and q0, q1, ...: the interpolated quantiles of each group (A8); nulls are left out.

    Values are counted in CELLS cells between a group's smallest and largest one. Only the cells in which the
    wanted ranks lie are counted by value and sorted, so no group is ever sorted or held as a whole.
    """
    rows = rows.select(*(F.col(k).alias(f"g{i}") for i, k in enumerate(keys)), F.col(value).cast("double").alias("v")).filter("v is not null")
    by = [f"g{i}" for i in range(len(keys))] or ["one"]
    rows = rows if keys else rows.withColumn("one", F.lit(0))
    spans = stage(rows.groupBy(*by).agg(F.min("v").alias("low"), F.max("v").alias("high"), F.count(F.lit(1)).alias("n"), F.avg("v").alias("mean")), "quantile-spans")
    width = F.col("high") - F.col("low")
    cell = F.when(width > 0, F.least(F.floor((F.col("v") - F.col("low")) / width * CELLS), F.lit(CELLS - 1))).otherwise(F.lit(0)).cast("int")
    placed = _rest(rows.join(F.broadcast(spans) if spans.count() <= FEW else spans, _same(rows, spans, by)), spans, by).withColumn("cell", cell)
    counts = stage(placed.groupBy(*by, "cell").agg(F.count(F.lit(1)).alias("c")), "quantile-cells")
    inside = lambda cells: placed.join(cells, _same(placed, cells, [*by, "cell"]), "left_semi").groupBy(*by, "cell", "v").agg(F.count(F.lit(1)).alias("c"))
    out = _interpolated(spans, counts, inside, by, shares)
    return out.select(*(F.col(f"g{i}").alias(k) for i, k in enumerate(keys)), "n", "mean", *(f"q{i}" for i in range(len(shares))))


def _same(a: DataFrame, b: DataFrame, columns: list[str]) -> list[Column]:
    return [a[c].eqNullSafe(b[c]) for c in columns]


def _rest(df: DataFrame, other: DataFrame, columns: list[str]) -> DataFrame:
    return df.drop(*(other[c] for c in columns))


def _interpolated(spans: DataFrame, counts: DataFrame, inside: Callable[[DataFrame], DataFrame], by: list[str], shares: tuple[float, ...]) -> DataFrame:
    """The columns by, n, mean and q0, q1, ... from spans (by, n, mean), counts (by, cell, c), and the numbers c of each value v inside some cells (by, cell)."""
    upto = Window.partitionBy(*by).orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("before", F.coalesce(F.sum("c").over(upto), F.lit(0)))
    each = F.array(*(F.struct(F.lit(i).alias("i"), F.lit(up).alias("up"), (F.ceil if up else F.floor)((F.col("n") - 1) * F.lit(p)).alias("rank")) for i, p in enumerate(shares) for up in (False, True)))
    wanted = spans.select(*by, F.explode(each).alias("x")).select(*by, "x.*")
    found = _rest(wanted.join(counts, [*_same(wanted, counts, by), F.col("rank") >= F.col("before"), F.col("rank") < F.col("before") + F.col("c")]), counts, by).drop("c")
    found = stage(found, "quantile-ranks")
    inside = inside(found.select(*by, "cell").distinct())
    ordered = Window.partitionBy(*by, "cell").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = inside.withColumn("upto", F.sum("c").over(ordered))
    at = F.col("rank") - F.col("before")
    hits = found.join(inside, [*_same(found, inside, [*by, "cell"]), at >= F.col("upto") - F.col("c"), at < F.col("upto")]).select(*(found[c] for c in by), "i", "up", "v")
    values = hits.groupBy(*by).agg(*(F.max(F.when((F.col("i") == i) & (F.col("up") == up), F.col("v"))).alias(f"v{i}_{int(up)}") for i in range(len(shares)) for up in (False, True)))
    out = spans.join(values, _same(spans, values, by))
    place = lambda p: (F.col("n") - 1) * F.lit(p)
    lines = [(F.col(f"v{i}_0") + (F.col(f"v{i}_1") - F.col(f"v{i}_0")) * (place(p) - F.floor(place(p)))).alias(f"q{i}") for i, p in enumerate(shares)]
    return out.select(*(spans[c] for c in by), "n", "mean", *lines)


def quantiles(rows: DataFrame, value: str, by: str) -> DataFrame:
    """Mean and interpolated median and p95 by group."""
    found = exact_quantiles(rows, value, [by], (0.5, 0.95))
    return found.select(by, F.round("mean", 6).alias("mean"), F.round("q0", 6).alias("p50"), F.round("q1", 6).alias("p95"))


def feature_summary(pairs: DataFrame, names: list[str], by: str = "sample_type") -> DataFrame:
    """Mean, median and p95 of each feature in each sample, one row per sample and feature."""
    found = column_quantiles(pairs, names, by, (0.5, 0.95))
    return found.select(by, "feature", F.round("mean", 6).alias("mean"), F.round("q0", 6).alias("p50"), F.round("q1", 6).alias("p95"))


#: Groups whose cells a task counts, and values that it holds, before they are passed on.
HELD_GROUPS, HELD_VALUES = 16, 1 << 21


def column_quantiles(rows: DataFrame, names: list[str], by: str, shares: tuple[float, ...]) -> DataFrame:
    """by, feature, n, mean and q0, q1, ... of each named column in each group: exact_quantiles of all columns at once.

    Three passes over the rows give the spans, the counts of cells and the values in the wanted cells, as arrays of all
    columns; no row is multiplied by the columns. Nulls are left out.
    """
    kind, width = dict(rows.dtypes)[by], len(names)
    table = spread(rows.select(F.col(by).alias("g0"), *(F.col(k).cast("double") for k in names)))

    def groups(batch: pa.RecordBatch) -> Iterator[tuple]:
        """Each group, and its values as rows by columns; a null is no number."""
        x = np.column_stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns[1:]])
        codes = pc.dictionary_encode(batch.column(0), null_encoding="encode")
        at = codes.indices.to_numpy()
        for k, g in enumerate(codes.dictionary.to_pylist()):
            yield g, x[at == k]

    def out(g, column: np.ndarray, more: dict[str, np.ndarray], of: pa.DataType) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([g] * len(column), of), pa.array(column.astype(np.int32)), *map(pa.array, more.values())], names=["g0", "g1", *more])

    def span(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for g, x in groups(batch):
                has = ~np.isnan(x)
                n = has.sum(axis=0)
                some = np.flatnonzero(n)
                values = {"low": np.where(has, x, np.inf).min(axis=0), "high": np.where(has, x, -np.inf).max(axis=0), "n": n, "total": np.where(has, x, 0).sum(axis=0)}
                yield out(g, some, {k: v[some] for k, v in values.items()}, batch.column(0).type)

    spans = table.mapInArrow(span, f"g0 {kind}, g1 int, low double, high double, n long, total double").groupBy("g0", "g1").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("n").alias("n"), (F.sum("total") / F.sum("n")).alias("mean"))
    spans = stage(spans, "quantile-spans")
    if spans.count() > FEW:
        each = F.explode(F.array(*(F.struct(F.lit(k).alias("feature"), F.col(k).cast("double").alias("value")) for k in names)))
        return exact_quantiles(rows.select(by, each.alias("x")).select(by, "x.feature", "x.value"), "value", [by, "feature"], shares)
    low_high: dict = {}
    for r in spans.collect():  # at most FEW rows
        low_high.setdefault(r.g0, np.zeros((2, width)))[:, r.g1] = r.low, r.high

    def placed(batch: pa.RecordBatch) -> Iterator[tuple]:
        """Each group, the place (column, cell) of each value, and the values."""
        for g, x in groups(batch):
            low, high = low_high.get(g, np.zeros((2, width)))
            has = ~np.isnan(x)
            cell = np.minimum(np.floor((np.where(has, x, low) - low) / np.where(high > low, high - low, 1) * CELLS), CELLS - 1).astype(np.int64)
            yield g, (cell + np.arange(width) * CELLS)[has], x[has]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        for batch in batches:
            of = batch.column(0).type
            for g, place, _ in placed(batch):
                held[g] = held.get(g, 0) + np.bincount(place, minlength=width * CELLS)
                if len(held) > HELD_GROUPS:
                    yield from passed(held, of)
        if held:
            yield from passed(held, of)

    def passed(held: dict, of: pa.DataType) -> Iterator[pa.RecordBatch]:
        for g, c in held.items():
            at = np.flatnonzero(c)
            yield out(g, at // CELLS, {"cell": (at % CELLS).astype(np.int32), "c": c[at]}, of)
        held.clear()

    counts = stage(table.mapInArrow(count, f"g0 {kind}, g1 int, cell int, c long").groupBy("g0", "g1", "cell").agg(F.sum("c").alias("c")), "quantile-cells")

    def inside(cells: DataFrame) -> DataFrame:
        wanted: dict = {}
        for r in cells.collect():  # a few rows for each of spans
            wanted.setdefault(r.g0, []).append(r.g1 * CELLS + r.cell)
        wanted = {g: np.sort(np.array(x)) for g, x in wanted.items()}

        def distinct(g, parts: list[tuple], of: pa.DataType) -> pa.RecordBatch:
            place, v = (np.concatenate(x) for x in zip(*parts, strict=True))
            order = np.lexsort((v, place))
            place, v = place[order], v[order]
            first = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (v[1:] != v[:-1])])) if len(v) else np.zeros(0, np.int64)
            return out(g, place[first] // CELLS, {"cell": (place[first] % CELLS).astype(np.int32), "v": v[first], "c": np.diff(np.append(first, len(v)))}, of)

        def values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: dict = {}
            waiting = 0
            for batch in batches:
                of = batch.column(0).type
                for g, place, v in placed(batch):
                    chosen = np.zeros(width * CELLS, bool)
                    chosen[wanted.get(g, np.zeros(0, np.int64))] = True
                    held.setdefault(g, []).append((place[chosen[place]], v[chosen[place]]))
                    waiting += len(held[g][-1][0])
                if waiting > HELD_VALUES:
                    yield from (distinct(g, parts, of) for g, parts in held.items())
                    held, waiting = {}, 0
            yield from (distinct(g, parts, of) for g, parts in held.items())

        return table.mapInArrow(values, f"g0 {kind}, g1 int, cell int, v double, c long").groupBy("g0", "g1", "cell", "v").agg(F.sum("c").alias("c"))

    found = _interpolated(spans, counts, inside, ["g0", "g1"], shares)
    return found.select(F.col("g0").alias(by), F.get(F.array(*map(F.lit, names)), F.col("g1")).alias("feature"), "n", "mean", *(f"q{i}" for i in range(len(shares))))


TRIES = 20


def pair_samples(queries: DataFrame, links: DataFrame, candidates: DataFrame, targets: DataFrame, seed: int = 42) -> DataFrame:
    """Per query up to two true pairs, two best-ranked wrong candidates and one random wrong target.

    candidates has best_rank. Targets are hashed into as many places as there are targets, and each query tries
    TRIES hashed places; its random target is the first that is not a true one. No query meets all targets, and
    one misses all tries with a probability of about exp(-TRIES).
    """
    true = links.select("qid", "tid").distinct()
    top = lambda df, order, n: df.withColumn("r", F.row_number().over(Window.partitionBy("qid").orderBy(*order))).filter(F.col("r") <= n).select("qid", "tid")
    wrong = candidates.join(true, ["qid", "tid"], "left_anti")
    n = F.lit(max(targets.count(), 1))
    tries = queries.select("qid", F.explode(F.sequence(F.lit(0), F.lit(TRIES - 1))).alias("try")).withColumn("place", F.pmod(F.xxhash64(F.lit(seed), "qid", "try"), n))
    near = tries.join(targets.select("tid", F.pmod(F.xxhash64("tid"), n).alias("place")), "place").join(true, ["qid", "tid"], "left_anti")
    kinds = {"true_positive": top(true, ["tid"], 2), "hard_negative": top(wrong, ["best_rank", "tid"], 2), "random_negative": top(near, ["try", "tid"], 1)}
    out = None
    for kind, rows in kinds.items():
        rows = rows.withColumn("sample_type", F.lit(kind))
        out = rows if out is None else out.unionByName(rows)
    return out


def cardinality_histogram(queries: DataFrame, links: DataFrame) -> DataFrame:
    """n_matches, n_queries: how many queries have how many links (A20); links (qid, tid)."""
    per_query = queries.select("qid").join(links.select("qid", "tid").distinct().groupBy("qid").agg(F.count(F.lit(1)).alias("n")), "qid", "left")
    return per_query.groupBy(F.coalesce("n", F.lit(0)).cast("long").alias("n_matches")).agg(F.count(F.lit(1)).alias("n_queries"))


def first_rows(rows: DataFrame, n: int, file: str = "file", place: str = "n") -> DataFrame:
    """The first n rows of each file, by their place in it, as a report over a file's head has it.

    At most n places are kept of each part of a file before they are ranked, so no file is ranked as a whole.
    """
    parted = Window.partitionBy(file, F.shiftright(F.col(place), 16)).orderBy(place)
    few = rows.withColumn("_r", F.row_number().over(parted)).filter(F.col("_r") <= n)
    return few.withColumn("_r", F.row_number().over(Window.partitionBy(file).orderBy(place))).filter(F.col("_r") <= n).drop("_r")
