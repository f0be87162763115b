"""Logistic models against their own optimality conditions in plain NumPy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from linkloom.operators import model

NAMES = ["a", "b", "copy", "still"]


def table(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 2)) * [1.0, 30.0] + [5.0, -2.0]
    y = (x[:, 0] - 5 + 0.02 * x[:, 1] + rng.normal(size=400) > 0).astype(int)
    rows = [(k, k % 3, float(a), float(b), float(a), 7.0, int(v)) for k, ((a, b), v) in enumerate(zip(x, y, strict=True))]
    return spark.createDataFrame(rows, "qid bigint, fold int, a double, b double, copy double, still double, y int")


def slope(fitted, rows, strength):
    """The gradient of mean log loss and penalty over standardised features, the constant one left out."""
    x, y = np.array([[r[c] for c in NAMES[:3]] for r in rows]), np.array([r.y for r in rows])
    z = (x - x.mean(axis=0)) / x.std(axis=0, ddof=1)
    p = 1 / (1 + np.exp(-(x @ fitted.weights[:3] + fitted.intercept)))
    return np.append(z.T @ (p - y) / len(y) + strength * np.array(fitted.weights[:3]) * x.std(axis=0, ddof=1), (p - y).mean())


def test_fits_are_exact_optima(spark):
    pairs = table(spark)
    rows = pairs.collect()
    for fitted, strength in ((model.fit_logistic(pairs, NAMES), 1 / len(rows)), (model.fit_reference(pairs, NAMES), 1e-4)):
        assert np.abs(slope(fitted, rows, strength)).max() < 1e-7
        assert fitted.weights[3] == 0 and fitted.weights[0] == pytest.approx(fitted.weights[2], abs=1e-6)
        scores = {r.qid: r.score for r in model.scored(fitted, pairs).collect()}
        assert all(scores[r.qid] == pytest.approx(1 / (1 + np.exp(-(sum(w * r[c] for w, c in zip(fitted.weights, NAMES, strict=True)) + fitted.intercept)))) for r in rows)


def test_folds_are_scored_by_models_without_them(spark):
    pairs = table(spark)
    together = {r.qid: r.score for r in model.out_of_fold(pairs, NAMES).collect()}
    assert len(together) == 400
    for fold in range(3):
        one = model.fit_logistic(pairs.filter(F.col("fold") != fold), NAMES)
        for r in model.scored(one, pairs.filter(F.col("fold") == fold)).collect():
            assert together[r.qid] == pytest.approx(r.score, abs=1e-6)


def test_missing_features_are_refused(spark):
    pairs = table(spark)
    fitted = model.fit_logistic(pairs, NAMES)
    with pytest.raises(Exception, match="a feature is missing"):
        model.scored(fitted, pairs.withColumn("a", F.lit(None).cast("double"))).collect()
    with pytest.raises(Exception, match="a feature is missing"):
        model.fit_logistic(pairs.withColumn("a", F.lit(float("nan"))), NAMES)
