import pytest
from pyspark.sql import functions as F

from linkloom.operators import evaluate as ev
from linkloom.operators import exact, graph, model, profile, retrieval
from linkloom.operators.features import FEATURE_NAMES
from linkloom.operators.fusion import fused_topk


def test_feature_names():
    assert len(FEATURE_NAMES) == len(set(FEATURE_NAMES)) == 91


@pytest.mark.parametrize("true,predicted,hit,value", [(2, 3, 2, 5 / 7), (0, 0, 0, 1), (0, 1, 0, 0), (1, 0, 0, 0), (2, 2, 2, 1)])
def test_f_half(spark, true, predicted, hit, value):
    row = spark.range(1).select(ev.f_half(F.lit(true), F.lit(predicted), F.lit(hit))).first()
    assert row[0] == pytest.approx(value)


def test_metric_with_singletons_and_missing_candidates(spark):
    queries = spark.createDataFrame([(0,), (1,), (2,)], "qid int")
    links = spark.createDataFrame([(0, "a"), (0, "b"), (2, "c")], "qid int, tid string")
    scored = spark.createDataFrame([(0, "a", 0.9), (0, "x", 0.2), (1, "y", 0.1)], "qid int, tid string, score double")
    counts = ev.query_counts(queries, links, scored.filter("score >= 0.5"), scored)
    row = ev.evaluate(counts).first()
    assert row.macro_f05 == pytest.approx((1.25 / 1.5 + 1) / 3, abs=1e-6) and row.candidate_micro_recall == pytest.approx(1 / 3, abs=1e-6)


def test_threshold_trace_against_brute_force(spark):
    queries = spark.createDataFrame([(i,) for i in range(5)], "qid int")
    true = {0: {"a", "b"}, 2: {"c"}, 4: {"d"}}
    links = spark.createDataFrame([(q, t) for q, ts in true.items() for t in ts], "qid int, tid string")
    scores = [(0, "a", 0.9), (0, "b", 0.305), (0, "x", 0.3), (1, "y", 0.1), (2, "c", 1.0), (3, "z", 0.0), (2, "w", 0.55)]
    trace = {r.step: r.macro_f05 for r in ev.threshold_trace(queries, links, spark.createDataFrame(scores, "qid int, tid string, score double")).collect()}
    for step, t in enumerate(ev.threshold_grid()):
        total = 0.0
        for q in range(5):
            predicted = {i for k, i, s in scores if k == q and s >= t}
            want = true.get(q, set())
            total += (not predicted) if not want else 1.25 * len(want & predicted) / (0.25 * len(want) + len(predicted))
        assert trace[step] == pytest.approx(total / 5, abs=1e-6), t


@pytest.mark.parametrize("bad", [-0.01, 1.1, float("nan"), float("inf"), "x", None])
def test_thresholds(bad):
    with pytest.raises(ValueError):
        ev.validate_threshold(bad)
    assert ev.validate_threshold("0.5") == 0.5


def test_components_go_through_unsampled_queries(spark):
    links = spark.createDataFrame([("a", "x"), ("b", "x"), ("b", "y"), ("c", "y"), ("d", "z")], "qid string, tid string")
    sample = spark.createDataFrame([("a",), ("c",), ("d",), ("e",)], "qid string")
    whole = {r.qid: r.component for r in graph.components_of(links, sample).collect()}
    assert whole == {"a": "a", "c": "a", "d": "d", "e": "e"}
    own = {r.qid: r.component for r in graph.components_of(links, sample, whole_graph=False).collect()}
    assert own["a"] != own["c"]


def test_a_long_chain_is_one_component(spark):
    links = spark.range(40).selectExpr("id as qid", "id as tid").union(spark.range(39).selectExpr("id + 1 as qid", "id as tid"))
    assert {r.component for r in graph.components(links).collect()} == {0}


def test_splits_keep_components_together(spark):
    groups = spark.range(3000).selectExpr("id as qid", "id div 3 as component")
    split = graph.grouped_split(groups)
    assert split.groupBy("component").agg(F.count_distinct("split").alias("n")).filter("n > 1").count() == 0
    share = {r.split: r["count"] / 3000 for r in split.groupBy("split").count().collect()}
    assert abs(share["train"] - 0.6) < 0.05 and abs(share["holdout"] - 0.2) < 0.05


def test_hash_sample_is_stable_and_exact(spark):
    import hashlib

    rows = spark.range(50).selectExpr("concat('S1-', id) as id")
    exact_ids = [r.id for r in graph.hash_sample(rows, "id", 5, exact=True).collect()]
    key = lambda x: hashlib.blake2b(f"42:{x}".encode(), digest_size=8).digest()
    assert set(exact_ids) == set(sorted((f"S1-{i}" for i in range(50)), key=key)[:5])


def test_retrieval_of_empty_sides(spark):
    queries = spark.createDataFrame([(1, "orchid books"), (2, "")], "qid bigint, text string")
    targets = spark.createDataFrame([(1, "orchid books", 2), (2, "orchid bookz", 2), (3, None, 0)], "rid bigint, text string, row_size int")
    found = retrieval.tfidf_topk(queries, targets.select("rid", "text"), analyzer=retrieval.Analyzer(min_df=1)).collect()
    assert {r.qid for r in found} == {1} and [(r.rid, r.score) for r in found if r["rank"] == 1] == [(1, 1.0)] and len(found) == 2
    assert retrieval.tfidf_topk(queries, targets.select("rid", "text").limit(0)).count() == 0
    assert retrieval.bm25_topk(queries, targets.limit(0)).count() == 0
    assert {r.qid for r in retrieval.bm25_topk(queries, targets).collect()} == {1}


def test_equal_texts_expand_to_their_smallest_rows(spark):
    queries = spark.createDataFrame([(1, "a b"), (2, "a b")], "qid bigint, text string")
    targets = spark.createDataFrame([(i, "a b" if i % 2 else "a c", 2) for i in range(100)], "rid bigint, text string, row_size int")
    found = retrieval.bm25_topk(queries, targets, k=3).orderBy("qid", "rank").collect()
    assert [(r.qid, r.rid) for r in found] == [(1, 1), (1, 3), (1, 5), (2, 1), (2, 3), (2, 5)]


def test_fusion_caps_and_breaks_ties(spark):
    rows = [(1, 5, "bm25_name", -1.0, 1), (1, 4, "tfidf_name", 0.5, 1), (1, 3, "bm25_name", -0.5, 2)]
    channels = spark.createDataFrame(rows, "qid bigint, rid bigint, channel string, score double, rank bigint")
    assert [(r.rid, r.global_rank) for r in fused_topk(channels, 2).orderBy("global_rank").collect()] == [(4, 1), (5, 2)]
    for bad in (0, -1, 1.5, True):
        with pytest.raises(ValueError):
            fused_topk(channels, bad)


def test_exact_blocking_is_asymmetric(spark):
    q = spark.createDataFrame([(1, "a", "fr"), (2, "a", ""), (3, "", "fr")], "qid bigint, name string, country string")
    t = spark.createDataFrame([(1, "a", "fr"), (2, "a", ""), (3, "", "fr")], "tid bigint, name string, country string")
    assert sorted(tuple(r) for r in exact.exact_matches(q, t).collect()) == [(1, 1), (2, 1), (2, 2)]


def test_models_need_both_classes(spark):
    pairs = spark.createDataFrame([(1.0, 1), (2.0, 1)], "x double, y int")
    with pytest.raises(model.OneClassError):
        model.fit_logistic(pairs, ["x"])


def test_distribution(spark):
    df = spark.createDataFrame([(v,) for v in [1, 1, 2, 3, 10]], "v int")
    assert tuple(profile.distribution(df, "v").first()) == (5, 1, 10, 3.4, 2, 10)


def test_pair_samples(spark):
    q = spark.range(20).selectExpr("id as qid")
    t = spark.range(200).selectExpr("id as tid")
    links = spark.range(20).selectExpr("id as qid", "id as tid")
    cand = spark.range(20).selectExpr("id as qid", "explode(sequence(id, id + 5)) as tid").withColumn("best_rank", F.col("tid") - F.col("qid") + 1)
    kinds = {r.sample_type: r["count"] for r in profile.pair_samples(q, links, cand, t).groupBy("sample_type").count().collect()}
    assert kinds["true_positive"] == 20 and kinds["hard_negative"] == 40 and kinds["random_negative"] > 0


def test_quantiles_of_many_columns_do_not_multiply_rows(spark, monkeypatch):
    """3,000 rows of 12 columns in three groups, one of them null: NumPy's quantiles, and no row a row and column."""
    import numpy as np

    rng = np.random.default_rng(3)
    kinds = ["a", "b", None]
    rows = [(kinds[i % 3], *(None if rng.random() < 0.1 and k else float(v) for k, v in enumerate([1.0, i % 2, *rng.normal(size=8), 10 ** rng.normal(0, 5), float(i == 7)]))) for i in range(3000)]
    names = [f"f{k}" for k in range(12)]
    table = spark.createDataFrame(rows, "sample_type string, " + ", ".join(f"{n} double" for n in names)).repartition(5)
    monkeypatch.setattr(profile, "exact_quantiles", None)
    monkeypatch.setattr(profile, "HELD_VALUES", 50)
    found = {(r.sample_type, r.feature): (r["mean"], r.p50, r.p95) for r in profile.feature_summary(table, names).collect()}
    assert len(found) == 36
    for (kind, name), got in found.items():
        x = np.array([r[1 + names.index(name)] for r in rows if r[0] == kind and r[1 + names.index(name)] is not None])
        assert got == pytest.approx((x.mean(), *np.quantile(x, [0.5, 0.95])), rel=1e-9, abs=1e-6)
