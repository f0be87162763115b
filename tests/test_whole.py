"""Queries that must use whole texts and all rows, on small tables made here."""

import pytest

import __spark_entry__ as driver
from linkloom.plans import queries as plans


@pytest.fixture
def tables(spark, tmp_path):
    """Writes small tables to a folder and gives it."""

    def write(**tables):
        for name, (rows, schema) in tables.items():
            spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return write


DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def documents(texts):
    return [(k, x, "en", "src0", len(x)) for k, x in texts.items()], DOCUMENTS


def test_records_hold_whole_texts(spark, tables):
    name, body = " ".join(f"first{i}" for i in range(60)), [" ".join(f"line{k}word{i}" for i in range(80)) for k in range(3)]
    d = tables(documents=documents({1: "\n".join([name, *body]), 2: "only line", 3: name + " end"}))
    found = {r.doc_id: (r.name, r.address) for r in driver.queries()["clean_text"](spark, d).collect()}
    whole = "\n".join([name, *body])
    assert found == {1: (name, f"{' '.join(body)} {len(whole)}"), 2: ("only line", "9"), 3: (name + " end", str(len(name) + 4))}
    assert driver.queries()["repeated_names"](spark, d).first().n_repeated == 0


@pytest.mark.parametrize("name", ["bm25_topk", "tfidf_char_topk", "tfidf_word_topk", "tfidf_legacy_topk"])
def test_parts_divisible_by_twenty_are_searched(spark, tables, name):
    d = tables(part=([(k, f"word{k} common") for k in range(1, 101)], "p_partkey bigint, p_name string"))
    assert {r.qid for r in driver.queries()[name](spark, d).collect()} == {20, 40, 60, 80, 100}


@pytest.mark.parametrize("name", ["bm25_topk_two_field", "channel_scores"])
def test_documents_divisible_by_twenty_are_searched_in_all(spark, tables, name):
    d = tables(documents=documents({k: f"same{k % 20}x text\nbody{k} more" for k in range(1, 81)}))
    found = {(r.qid, r.rid) for r in driver.queries()[name](spark, d).collect()}
    assert {q for q, _ in found} == {20, 40, 60, 80}
    # The copies' ids are divisible by 5, and the row itself is a target too.
    assert {(q, r) for q in (20, 40, 60, 80) for r in (20, 40, 60, 80)} <= found


def copies(n=60):
    """n copies of one text, of which those whose id is divisible by 5 are queries."""
    return documents({k: "one name\none body" for k in range(1, n + 1)})


def test_recall_goes_to_rank_fifty(spark, tables):
    d = tables(documents=copies())
    row = driver.queries()["recall_at_k"](spark, d).first()
    assert (row.recall_at_20, row.recall_at_30, row.recall_at_50) == (round(20 / 48, 6), round(30 / 48, 6), 1.0)


def test_pilot_has_its_own_caps(spark, tables):
    assert {r.k for r in driver.queries()["cap_pilot"](spark, tables(documents=copies(30))).collect()} == {20, 50}


@pytest.fixture
def labelled_pairs(spark, monkeypatch):
    """Stands in for the features: 40 queries, of which each two share a target; the first feature is the label."""
    digests = [(k, f"digest{k // 2}") for k in range(40)]
    q, t_ = spark.createDataFrame(digests, "qid bigint, digest string"), spark.createDataFrame([(100 + k, f"digest{k}") for k in range(20)], "rid bigint, digest string")
    rows = [(k, 100 + (k // 2 if right else (k // 2 + 1) % 20), float(right), 0.0) for k in range(40) for right in (True, False)]
    monkeypatch.setattr(plans.feat, "FEATURE_NAMES", ("a", "b"))
    monkeypatch.setattr(plans, "_features", lambda spark, d: (q, t_, spark.createDataFrame(rows, "qid bigint, rid bigint, a double, b double")))


def test_folds_are_those_of_the_components(spark, labelled_pairs):
    found = driver.queries()["logistic_oof"](spark, "").select("qid", "fold").distinct().collect()
    fold = {r.qid: r.fold for r in found}
    assert len(found) == len(fold) == 40 and all(fold[k] == fold[k + 1] for k in range(0, 40, 2)) and max(fold.values()) >= 3


def test_trees_score_what_they_were_not_fitted_on(spark, labelled_pairs, monkeypatch):
    fitted = {}

    def fit(pairs, names, rounds=200, **options):
        fitted.update(qids={r.qid for r in pairs.select("qid").collect()}, rounds=rounds)
        return None

    monkeypatch.setattr(plans.m, "fit_trees", fit)
    monkeypatch.setattr(plans.m, "scored", lambda model, pairs: pairs.selectExpr("*", "0.5D as score"))
    scored = {r.qid for r in driver.queries()["gbt_score"](spark, "").collect()}
    assert fitted["rounds"] == 200 and fitted["qids"] | scored == set(range(40)) and not fitted["qids"] & scored and fitted["qids"] and scored
