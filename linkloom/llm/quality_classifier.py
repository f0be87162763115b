"""Quality classifier: random Fourier features, ridge regression by partition sums, isotonic calibration.

A text becomes about twenty statistics of its bytes, words and lines. Standardised and projected on random
directions, their cosines approximate a Gaussian kernel. Each task sums the normal equations of its rows;
the sums, of fixed size, are added in two levels, and the driver solves one system of FEATURES unknowns.
Ridge scores of the labelled rows that the solution did not see are counted on a grid of fixed size, and
isotonic regression of these counts turns scores into probabilities. Every labelled row that may be
learned from is used; there is no sample.

Defined cases: a null text is scored as an empty one, and every text gets a score. A very long text is measured
whole, in a chunk of its own. Labels are averaged per
doc_id, so repeated labels count once; a null label is no label. Without any label to learn from, or with
one class only, the score is the mean label, or 0.5 if there is none. Repeated rows each get their score.
Other columns are never read. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import stage
from ._shingles import chunks, word_hashes, words

FEATURES, SEED, RIDGE = 256, 7, 1.0
#: The kernel's width in standard deviations, times the square root of the number of statistics.
WIDTH = 0.7
FOLDS, HELD_OUT, CALIBRATION = 5, 0, 4
THRESHOLD = 0.3
#: Scores are counted in so many cells between -0.5 and 1.5.
GRID = 2000
#: Sums of partitions meet in so many tasks before they reach the driver.
FAN_IN = 16

_CLASSES = {"lower": b"abcdefghijklmnopqrstuvwxyz", "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digit": b"0123456789", "blank": b" ", "line": b"\n", "point": b".,;:?'\"()-", "mark": b"!", "bar": b"|", "symbol": b"#*$%&<>=+@~^_\\/[]{}`"}
_KIND = np.full(256, len(_CLASSES), np.uint8)
for _k, _bytes in enumerate(_CLASSES.values()):
    _KIND[list(_bytes)] = _k
STATISTICS = len(_CLASSES) + 1 + 11


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of statistics for each text."""
    n = len(offsets) - 1
    size = np.diff(offsets)
    text = np.repeat(np.arange(n), size)
    kinds = len(_CLASSES) + 1
    shares = np.bincount(text * kinds + _KIND[data], minlength=n * kinds).reshape(n, kinds) / np.maximum(size, 1)[:, None]
    row, starts, ends = words(data, offsets)
    count = np.bincount(row, minlength=n)
    per = np.maximum(count, 1)
    length = ends - starts
    folded = word_hashes(data, starts, ends)
    mean = lambda x: np.bincount(row, weights=x, minlength=n) / per
    inside = np.zeros(len(row), bool)
    inside[1:] = row[1:] == row[:-1]
    repeated = np.zeros(len(row), bool)
    repeated[1:] = inside[1:] & (folded[1:] == folded[:-1])
    order = np.lexsort((folded, row))
    new = np.ones(len(row), bool)
    new[1:] = (row[order][1:] != row[order][:-1]) | (folded[order][1:] != folded[order][:-1])
    distinct = np.bincount(row[order][new], minlength=n) / per
    upper = _KIND[data] == 1
    uppers = np.concatenate([[0], np.cumsum(upper)])
    capital = (uppers[ends] - uppers[starts]) * 2 > length
    last = _KIND[data[ends - 1]] if len(ends) else np.zeros(0, np.uint8)
    odd_end = last >= list(_CLASSES).index("mark")
    odd_end &= last < len(_CLASSES)
    lone = (length == 1) & odd_end
    deviation = np.sqrt(np.maximum(mean(length.astype(float) ** 2) - mean(length) ** 2, 0))
    # Lines as words of the text whose blanks are line ends only.
    lined = np.where(data == 10, np.uint8(10), np.maximum(data, np.uint8(33)))
    line_row, line_starts, line_ends = words(lined, offsets)
    lines = np.bincount(line_row, minlength=n)
    line_hash = word_hashes(lined, line_starts, line_ends)
    order = np.lexsort((line_hash, line_row))
    first = np.ones(len(line_row), bool)
    first[1:] = (line_row[order][1:] != line_row[order][:-1]) | (line_hash[order][1:] != line_hash[order][:-1])
    line_share = np.bincount(line_row[order][first], minlength=n) / np.maximum(lines, 1)
    # Distinct words of a long text are fewer; the excess over a common curve says more than the share.
    expected = np.log1p(count)
    return np.column_stack([shares, np.log1p(size), expected, mean(length), deviation, distinct, distinct * expected, mean(repeated), mean(capital), mean(odd_end), mean(lone), line_share]).astype(np.float64)


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, end, data, offsets in chunks(batch.column(1)):
            x = statistics(data, offsets).astype(np.float32)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, STATISTICS, dtype=np.int32)), pa.array(x.reshape(-1)))
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, end - first), lists], names=["doc_id", "x"])


def remainder(doc_id: Column, folds: int = FOLDS) -> Column:
    """crc32 of the id as text, modulo folds; an id that is null counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(folds).cast("long")).cast("int")


class Kernel:
    """The map from statistics to Fourier features."""

    def __init__(self, mean: np.ndarray, deviation: np.ndarray):
        rng = np.random.Generator(np.random.PCG64(SEED))
        self.mean, self.deviation = mean, np.where(deviation > 1e-9, deviation, 1.0)
        self.directions = rng.standard_normal((STATISTICS, FEATURES)) / (WIDTH * np.sqrt(STATISTICS))
        self.phases = rng.uniform(0, 2 * np.pi, FEATURES)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.deviation, -6, 6)
        return np.column_stack([np.sqrt(2 / FEATURES) * np.cos(z @ self.directions + self.phases), np.ones(len(x))])


def _matrix(lists: pa.Array) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(lists), STATISTICS)


def _sums(kernel: Kernel):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = np.zeros((FEATURES + 1, FEATURES + 1)), np.zeros(FEATURES + 1)
        for batch in batches:
            z, y = kernel(_matrix(batch.column("x"))), batch.column("y").to_numpy(zero_copy_only=False)
            a += z.T @ z
            b += z.T @ y
        yield pa.RecordBatch.from_arrays([pa.array([a.tobytes()], pa.binary()), pa.array([b.tobytes()], pa.binary())], names=["a", "b"])

    return run


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    a, b = np.zeros((FEATURES + 1) ** 2), np.zeros(FEATURES + 1)
    for batch in batches:
        for x, y in zip(batch.column("a"), batch.column("b"), strict=True):
            a += np.frombuffer(x.as_py())
            b += np.frombuffer(y.as_py())
    yield pa.RecordBatch.from_arrays([pa.array([a.tobytes()], pa.binary()), pa.array([b.tobytes()], pa.binary())], names=["a", "b"])


def isotonic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Pool adjacent violators: the non-decreasing values nearest to y; x is sorted."""
    blocks: list[list[float]] = []
    for value, w in zip(y, weight, strict=True):
        blocks.append([value, w, 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            v2, w2, n2 = blocks.pop()
            v1, w1, n1 = blocks.pop()
            blocks.append([(v1 * w1 + v2 * w2) / (w1 + w2), w1 + w2, n1 + n2])
    return np.repeat([b[0] for b in blocks], [int(b[2]) for b in blocks])


class Model:
    def __init__(self, kernel: Kernel | None, solution: np.ndarray | None, grid: np.ndarray, values: np.ndarray, prior: float):
        self.kernel, self.solution, self.grid, self.values, self.prior = kernel, solution, grid, values, prior

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.solution is None:
            return np.full(len(x), self.prior)
        raw = self.kernel(x) @ self.solution
        even = np.interp(raw, self.grid, self.values) if len(self.grid) else np.clip(raw, 0, 1)
        # A trace of the raw score keeps the order within a step.
        return np.clip(0.999 * even + 0.001 * np.clip((raw + 0.5) / 2, 0, 1), 0, 1)


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the statistics x of each text, written to the shared folder."""
    kind = dict(docs.dtypes)[id_col]
    return stage(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(_measured, f"doc_id {kind}, x array<float>"), "quality-statistics")


def fit(stats: DataFrame, labels: DataFrame, label_col: str = "quality") -> Model:
    """Learns from labels (doc_id, label_col) whose remainder is not HELD_OUT."""
    y = labels.filter(F.col(label_col).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.avg(label_col).cast("double").alias("y"))
    known = stats.join(y, "doc_id").withColumn("part", remainder(F.col("doc_id"))).filter(F.col("part") != HELD_OUT)
    known = stage(known.select("x", "y", "part"), "quality-known")
    each = [F.col("x")[k].cast("double") for k in range(STATISTICS)]
    moments = known.agg(F.count(F.lit(1)), F.avg("y"), F.min("y"), F.max("y"), *map(F.avg, each), *map(F.stddev_pop, each)).first()
    prior = 0.5 if moments[1] is None else moments[1]
    if not moments[0] or moments[2] == moments[3]:
        return Model(None, None, np.empty(0), np.empty(0), prior)
    kernel = Kernel(np.array(moments[4 : 4 + STATISTICS]), np.array(moments[4 + STATISTICS :]))
    sums = known.filter(F.col("part") != CALIBRATION).select("x", "y").mapInArrow(_sums(kernel), "a binary, b binary")
    added = sums.repartition(FAN_IN, F.pmod(F.spark_partition_id(), F.lit(FAN_IN))).mapInArrow(_added, "a binary, b binary").collect()
    a = sum(np.frombuffer(r.a) for r in added).reshape(FEATURES + 1, FEATURES + 1)
    solution = np.linalg.solve(a + RIDGE * np.eye(FEATURES + 1) * np.append(np.ones(FEATURES), 1e-6), sum(np.frombuffer(r.b) for r in added))

    def ridge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell = np.clip(np.round((kernel(_matrix(batch.column("x"))) @ solution + 0.5) / 2 * GRID), 0, GRID).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(cell), batch.column("y")], names=["cell", "y"])

    cells = known.filter(F.col("part") == CALIBRATION).select("x", "y").mapInArrow(ridge, "cell int, y double").groupBy("cell").agg(F.avg("y").alias("y"), F.count(F.lit(1)).alias("n")).orderBy("cell").collect()
    grid = np.array([r.cell for r in cells]) / GRID * 2 - 0.5
    values = isotonic(grid, np.array([r.y for r in cells]), np.array([r.n for r in cells], float)) if cells else np.empty(0)
    return Model(kernel, solution, grid, values, prior)


def score(stats: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted of each row of the statistics."""
    shared = stats.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(shared.value.scores(_matrix(batch.column("x"))))], names=["doc_id", "score"])

    out = stats.select("doc_id", "x").mapInArrow(run, f"doc_id {dict(stats.dtypes)['doc_id']}, score double")
    return out.select("doc_id", (remainder(F.col("doc_id")) == HELD_OUT).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    stats = measured(docs)
    return score(stats, fit(stats, labels))
