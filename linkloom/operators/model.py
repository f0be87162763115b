"""Pair classifiers: standardised logistic regression, grouped out-of-fold scores, and spark.ml's boosted trees.

The logistic models are fitted by Newton's method on sums over all pairs, whose size depends on the features only.
Models that leave out one fold each are fitted in the same passes, of which there are some tens.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.files import dump_json, read_json
from ..sources.staging import spread
from .evaluate import validate_threshold

FORMAT = "linkloom-model-1"


class OneClassError(ValueError):
    """The training pairs have one class only (M7)."""


def require_both_classes(pairs: DataFrame) -> tuple[int, int]:
    row = pairs.agg(F.count_if(F.col("y") == 1).alias("pos"), F.count_if(F.col("y") == 0).alias("neg")).first()
    if not row.pos or not row.neg:
        raise OneClassError(f"positives: {row.pos}, negatives: {row.neg}")
    return row.pos, row.neg


#: So many pairs are one task of a fit; each pass over fewer pairs would cost more in tasks than in work.
FIT_ROWS = 50_000


def _training(pairs: DataFrame) -> DataFrame:
    """pairs kept in memory, in as many partitions as their counted number is worth."""
    pos, neg = require_both_classes(pairs)
    return pairs.repartition(max(1, -(-(pos + neg) // FIT_ROWS))).persist(StorageLevel.MEMORY_AND_DISK)


def _fit(pipeline: Pipeline, pairs: DataFrame) -> PipelineModel:
    known = _training(pairs)
    try:
        return pipeline.fit(known)
    finally:
        known.unpersist()


def _assembled(names) -> VectorAssembler:
    return VectorAssembler(inputCols=list(names), outputCol="raw", handleInvalid="error")


@dataclass(frozen=True)
class Linear:
    """A logistic model of named columns."""

    names: tuple[str, ...]
    weights: tuple[float, ...]
    intercept: float


#: A Newton step that lowers the loss by less than this ends a fit; a step is halved so often at most.
ENOUGH, HALVINGS = 1e-13, 30


def _matrix(batch: pa.RecordBatch, names: list[str]) -> np.ndarray:
    x = np.column_stack([batch.column(c).to_numpy(zero_copy_only=False).astype(float) for c in names])
    if not np.isfinite(x).all():
        raise ValueError("a feature is missing")
    return x


def _summed(blocks: DataFrame, width: int, of_block: Callable[[int, np.ndarray, np.ndarray], dict[int, np.ndarray]]) -> dict[int, np.ndarray]:
    """The sums of of_block's arrays (model: width numbers) over all blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for fold, y, x in zip(*(batch.column(c) for c in range(3)), strict=True):
                labels = np.frombuffer(y.as_buffer())
                for model, value in of_block(fold.as_py(), labels, np.frombuffer(x.as_buffer()).reshape(len(labels), -1)).items():
                    total[model] = total[model] + value if model in total else value
        for model, value in total.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(width, model, np.int32)), pa.array(np.arange(width, dtype=np.int32)), pa.array(value)], names=["model", "place", "value"])

    sums = blocks.mapInArrow(run, "model int, place int, value double").groupBy("model", "place").agg(F.sum("value").alias("value")).toArrow()  # models by width
    model, place, value = (sums.column(c).to_numpy() for c in ("model", "place", "value"))
    out = {int(m): np.zeros(width) for m in np.unique(model)}
    for m, array in out.items():
        array[place[model == m]] = value[model == m]
    return out


def _fit_linear(pairs: DataFrame, names, penalty: Callable[[int], float], max_iter: int, left_out: list[int] | None = None) -> list[Linear]:
    """Models that minimise mean log loss + penalty(pairs) / 2 * squared weights of standardised features, one for each left out fold (None: of all pairs)."""
    names = list(names)
    d, folds = len(names), [-1] if left_out is None else left_out
    fold = F.lit(-2) if left_out is None else F.col("fold")

    def to_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y, f = _matrix(batch, names), batch.column("y").to_numpy(zero_copy_only=False).astype(float), batch.column("_fold").to_numpy(zero_copy_only=False)
            parts = [(int(one), y[f == one].tobytes(), x[f == one].tobytes()) for one in np.unique(f)]
            yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in parts], pa.int32()), pa.array([p[1] for p in parts], pa.binary()), pa.array([p[2] for p in parts], pa.binary())], names=["fold", "y", "x"])

    blocks = spread(pairs.select(*names, "y", fold.cast("int").alias("_fold"))).mapInArrow(to_blocks, "fold int, y binary, x binary").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        # Of each fold: pairs, positives, and the features' sums; then their squares about the mean of all.
        about = _summed(blocks, 2 + d, lambda f, y, x: {f: np.concatenate([[len(y), y.sum()], x.sum(axis=0)])})
        whole = sum(about.values(), np.zeros(2 + d))
        centre = whole[2:] / max(whole[0], 1)
        squares = _summed(blocks, d, lambda f, y, x: {f: ((x - centre) ** 2).sum(axis=0)})
        own, means, scales = [], [], []
        for k in folds:
            n, pos, *sums = whole - about.get(k, 0)
            if not pos or pos == n:
                raise OneClassError(f"positives: {int(pos)}, negatives: {int(n - pos)}")
            mean = np.array(sums) / n
            spread_ = np.sqrt(np.maximum(sum(squares.values()) - squares.get(k, 0) - n * (mean - centre) ** 2, 0) / max(n - 1, 1))
            own.append(n)
            means.append(mean)
            # A constant feature has no weight.
            scales.append(np.divide(1, spread_, out=np.zeros(d), where=spread_ > 1e-12 * (1 + np.abs(mean))))
        strength = [penalty(int(n)) for n in own]
        at, step = [np.zeros(d + 1) for _ in folds], [np.zeros(d + 1) for _ in folds]
        loss, open_ = [np.inf] * len(folds), list(range(len(folds)))
        halved = [0] * len(folds)
        for _ in range(max_iter):
            # The tasks multiply centred features; a model's own means and scales are an affine change of them.
            tried = {m: at[m] + step[m] for m in open_}
            change = {m: np.diag(np.append(scales[m], 1.0)) for m in open_}
            for m in open_:
                change[m][d, :d] = (centre - means[m]) * scales[m]
            raw = {m: change[m] @ tried[m] for m in open_}

            def derivatives(f: int, y: np.ndarray, x: np.ndarray, raw=raw) -> dict[int, np.ndarray]:
                out, z = {}, np.column_stack([x - centre, np.ones(len(x))])
                for m, w in raw.items():
                    if f != folds[m]:
                        margin = z @ w
                        more = np.logaddexp(0, margin)
                        p = np.exp(margin - more)
                        out[m] = np.concatenate([[(more - y * margin).sum()], z.T @ (p - y), (z.T @ (z * (p * (1 - p))[:, None])).ravel()])
                return out

            sums = _summed(blocks, 1 + (d + 1) + (d + 1) ** 2, derivatives)
            for m in list(open_):
                ridge = np.append(np.full(d, strength[m]), 0.0)
                value = sums[m][0] / own[m] + (ridge * tried[m] ** 2).sum() / 2
                if value > loss[m]:
                    halved[m] += 1
                    step[m] = step[m] / 2
                    if halved[m] > HALVINGS:
                        open_.remove(m)
                    continue
                at[m], loss[m], halved[m] = tried[m], value, 0
                slope = change[m].T @ sums[m][1 : d + 2] / own[m] + ridge * at[m]
                curve = change[m].T @ sums[m][d + 2 :].reshape(d + 1, d + 1) @ change[m] / own[m] + np.diag(ridge)
                step[m] = -np.linalg.lstsq(curve, slope, rcond=None)[0]
                if -(slope @ step[m]) / 2 < ENOUGH:
                    open_.remove(m)
            if not open_:
                break
    finally:
        blocks.unpersist()
    out = []
    for m in range(len(folds)):
        weights = at[m][:d] * scales[m]
        out.append(Linear(tuple(names), tuple(weights.tolist()), float(at[m][d] - weights @ means[m])))
    return out


def fit_logistic(pairs: DataFrame, names, c: float = 1.0, max_iter: int = 1000) -> Linear:
    """Logistic regression on standardised features whose penalty is that of strength 1/c on the summed loss (M3)."""
    return _fit_linear(pairs, names, lambda n: 1 / (c * n), max_iter)[0]


def fit_reference(pairs: DataFrame, names, alpha: float = 1e-4, max_iter: int = 200) -> Linear:
    """The linear reference model: the same loss and penalty as averaged stochastic descent, solved exactly (M4)."""
    return _fit_linear(pairs, names, lambda n: alpha, max_iter)[0]


def fit_trees(pairs: DataFrame, names, rounds: int = 200, depth: int = 5, rate: float = 0.05, min_rows: int = 20, seed: int = 42) -> PipelineModel:
    """Boosted trees, the primary model (M5)."""
    model = GBTClassifier(labelCol="y", featuresCol="raw", maxIter=rounds, maxDepth=depth, stepSize=rate, minInstancesPerNode=min_rows, seed=seed, maxMemoryInMB=512)
    return _fit(Pipeline(stages=[_assembled(names), model]), pairs)


def _linear_score(models: list[Linear], which: Column) -> Column:
    """The score of the model at a place (from 0) of models."""
    lists = lambda values: F.get(F.array(*values), which.cast("int"))
    weights = lists([F.array(*map(F.lit, m.weights)) for m in models])
    products = F.zip_with(F.array(*(F.col(c).cast("double") for c in models[0].names)), weights, lambda x, w: x * w)
    margin = F.aggregate(products, lists([F.lit(m.intercept) for m in models]), lambda total, x: total + x)
    score = 1 / (1 + F.exp(-margin))
    return F.when(score.isNull() | F.isnan(score), F.raise_error(F.lit("a feature is missing")).cast("double")).otherwise(score)


def scored(model: PipelineModel | Linear, pairs: DataFrame) -> DataFrame:
    """Adds score, the probability of a match (M6)."""
    if isinstance(model, Linear):
        return pairs.withColumn("score", _linear_score([model], F.lit(0)))
    out = model.transform(pairs).withColumn("score", vector_to_array("probability")[1])
    return out.drop("raw", "rawPrediction", "probability", "prediction")


def out_of_fold(pairs: DataFrame, names, c: float = 1.0) -> DataFrame:
    """Scores each pair by a model fitted without its fold; pairs has fold, constant in a component (M2)."""
    present = [r.fold for r in pairs.select("fold").distinct().orderBy("fold").collect()]  # at most the number of folds
    if len(present) < 2:
        raise ValueError("at least two folds must have pairs")
    models = _fit_linear(pairs, names, lambda n: 1 / (c * n), 1000, present)
    return pairs.withColumn("score", _linear_score(models, F.array_position(F.array(*map(F.lit, present)), F.col("fold")) - 1))


_SPLIT = re.compile(r"If \(feature (\d+) ")


def importances(model: PipelineModel, names) -> list[tuple[str, float, int]]:
    """Features by their gain, with the number of splits on each (K8)."""
    trees = model.stages[-1]
    splits = Counter(int(k) for tree in trees.trees for k in _SPLIT.findall(tree.toDebugString))
    rows = [(name, float(gain), splits[k]) for k, (name, gain) in enumerate(zip(names, trees.featureImportances.toArray(), strict=True))]
    return sorted(rows, key=lambda x: (-x[1], x[0]))


# ---------------------------------------------------------------- artifacts


def save_model(model: PipelineModel, folder: str, names, threshold: float, config: dict) -> None:
    """The model and its sidecars (K7)."""
    model.write().overwrite().save(f"{folder}/model")
    dump_json(f"{folder}/model.json", {"format": FORMAT, "features": list(names), "threshold": validate_threshold(threshold), "config": config})
    dump_json(f"{folder}/threshold.json", {"threshold": threshold})
    dump_json(f"{folder}/features.json", list(names))


def load_model(spark: SparkSession, folder: str, names) -> tuple[PipelineModel, float, dict]:
    """The saved model, refused if format, feature order or threshold do not agree (M8)."""
    about = read_json(f"{folder}/model.json")
    if about.get("format") != FORMAT:
        raise ValueError(f"unknown model format {about.get('format')!r}")
    if about["features"] != list(names) or read_json(f"{folder}/features.json") != list(names):
        raise ValueError("the model was trained on other features")
    if read_json(f"{folder}/threshold.json")["threshold"] != about["threshold"]:
        raise ValueError("the threshold file differs from the model's")
    return PipelineModel.load(f"{folder}/model"), validate_threshold(about["threshold"]), about["config"]
