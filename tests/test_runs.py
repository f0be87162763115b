import json
import zipfile

import pytest

from linkloom.operators.model import load_model
from linkloom.operators.validate import IntegrityError, validate_files
from linkloom.plans import linkage
from linkloom.sources.files import Config
from linkloom.sources.tables import write_fixture
from linkloom.streaming.resumable import rows_of, run_available

SMALL = Config(min_df=1, sample_size=100, trees=5, min_rows=1, final_k=3, tfidf_k=3, bm25_k=3)


def test_training_and_inference_end_to_end(spark, tmp_path):
    data, work = str(tmp_path / "data"), str(tmp_path / "work")
    write_fixture(spark, data, "train", 24)
    write_fixture(spark, data, "test", 12)
    report = linkage.train(spark, data, work, SMALL)
    assert report["trees"]["train"]["all"]["macro_f05"] > 0.9
    assert report["timing"]["candidates_rows"] == report["timing"]["features_rows"] > 0 and set(report["classes"]) <= {"positive", "hard_negative", "normal_negative"}
    importance = [x.split("\t") for x in (tmp_path / "work" / "importance.tsv").read_text().splitlines()]
    assert importance[0][:3] == ["feature", "gain", "splits"] and len(importance) == 92 and abs(sum(float(x[1]) for x in importance[1:]) - 1) < 1e-6 and int(importance[1][2]) > 0
    pairs = (tmp_path / "work" / "holdout_pairs.tsv").read_text().splitlines()
    assert pairs[0] == "source1_entity_id\ttarget_entity_id\tlabel\tscore\tpredicted" and len(pairs) > 1
    # The second run finds the tables of the first, another configuration is refused.
    again = linkage.train(spark, data, work, SMALL)
    assert again["thresholds"] == report["thresholds"]
    with pytest.raises(ValueError, match="another input or configuration"):
        linkage.train(spark, data, work, Config(min_df=1, sample_size=100, trees=6, min_rows=1, final_k=3, tfidf_k=3, bm25_k=3))
    assert linkage.infer(spark, data, work, str(tmp_path / "out")) == 12
    lines = (tmp_path / "out" / "matching_results.tsv").read_text().splitlines()
    assert lines[0] == "source1_entity_id\tmatched_entity_ids" and len(lines) == 13 and lines[1].startswith("S1-000\t")
    from linkloom.operators.features import FEATURE_NAMES

    try:
        load_model(spark, f"{work}/model", FEATURE_NAMES[:-1])
        raise AssertionError("other features must be refused")
    except ValueError:
        pass


def test_exact_baseline(spark, tmp_path):
    data = str(tmp_path / "data")
    write_fixture(spark, data)
    assert linkage.exact_baseline(spark, data, "train", str(tmp_path / "work"), str(tmp_path / "out"), SMALL) == 12
    rows = dict(x.split("\t") for x in (tmp_path / "out" / "matching_results.tsv").read_text().splitlines()[1:])
    assert rows["S1-001"] == "S2-001" and rows["S1-000"] == ""


def test_files_are_validated_as_written_and_packed(spark, tmp_path):
    data, out = str(tmp_path / "data"), str(tmp_path / "out")
    write_fixture(spark, data)
    linkage.exact_baseline(spark, data, "train", str(tmp_path / "work"), out, SMALL)
    catalog = linkage.build_catalog(spark, data, "train", str(tmp_path / "work" / "catalog-train"), SMALL)
    assert sorted(p.name for p in (tmp_path / "out").iterdir() if not p.name.startswith(".")) == ["candidate_pairs.tsv", "matching_results.tsv"]
    (tmp_path / "model").mkdir()
    (tmp_path / "model" / "m.json").write_text("{}")
    (tmp_path / "c.json").write_text("{}")
    made = {mode: linkage.package(spark, out, str(tmp_path / f"zip-{mode}"), "team-1", catalog, mode, None if mode == "lists" else str(tmp_path / "model"), [str(tmp_path / "c.json")]) for mode in ("lists", "model", "hybrid")}
    names = {mode: set(zipfile.ZipFile(path).namelist()) for mode, path in made.items()}
    lists = {"output/matching_results.tsv", "output/candidate_pairs.tsv"}
    assert made["hybrid"].endswith("/submission.zip") and made["lists"].endswith("/team-1_submission.zip")
    assert names == {"lists": lists, "model": lists | {"code/solution/artifacts/m.json"}, "hybrid": lists | {"code/solution/artifacts/m.json", "code/solution/configs/c.json"}}
    for bad in ({"team": "a/b"}, {"mode": "other"}, {"mode": "model"}):
        with pytest.raises(ValueError):
            linkage.package(spark, out, str(tmp_path / "zips"), catalog=catalog, **({"team": "t"} | bad))
    path = tmp_path / "out" / "matching_results.tsv"
    lines = path.read_text().splitlines()
    queries, targets = catalog["queries"].select("qid"), catalog["targets"].withColumnRenamed("rid", "tid").select("tid")
    files = (str(path), str(tmp_path / "out" / "candidate_pairs.tsv"))
    for wrong, message in (([lines[0], lines[2], lines[1], *lines[3:]], "order"), (lines[:-1], "order"), ([*lines[:-1], lines[-1].split("\t")[0] + "\tS2-999"], "match_not_candidate")):
        path.write_text("\n".join(wrong) + "\n")
        with pytest.raises(IntegrityError, match=message):
            validate_files(spark, *files, queries, targets)
        with pytest.raises(IntegrityError):
            linkage.package(spark, out, str(tmp_path / "zips"), "team", catalog)


def test_a_pair_that_is_not_valid_replaces_nothing(spark, tmp_path):
    queries, targets = spark.createDataFrame([("S1-1",)], "qid string"), spark.createDataFrame([("S2-1",)], "tid string")
    good, bad = (spark.createDataFrame([("S1-1", ids)], "qid string, ids array<string>") for ids in (["S2-1"], ["S2-1", "S2-2"]))
    assert linkage.write_pair(spark, good, good, queries, targets, str(tmp_path)) == 1
    with pytest.raises(IntegrityError):
        linkage.write_pair(spark, bad, bad, queries, targets, str(tmp_path))
    assert (tmp_path / "matching_results.tsv").read_text().endswith("S1-1\tS2-1\n") and not list(tmp_path.glob("staged-*"))


def test_reports_of_the_example(spark, tmp_path):
    data, work, out = (str(tmp_path / x) for x in ("data", "work", "out"))
    write_fixture(spark, data, "train", 24)
    report = linkage.evaluate_retrieval(spark, data, work, out, SMALL)
    assert {"A_tfidf", "B_bm25", "C_hybrid", "D_hybrid_transliteration", "cap_pilot", "decision", "attribution", "timing"} <= set(report)
    assert report["D_hybrid_transliteration"][0]["recall_at_50"] == 1.0 and report["decision"][0]["decision"] == "select_k20" and report["timing"]["queries"] > 0
    assert json.loads((tmp_path / "out" / "metrics.json").read_text())["cap_pilot"]
    eda = linkage.explore(spark, data, "train", out, SMALL)
    assert eda["source2"]["rows"] == 24 and eda["truth"]["total_links"] == 36 and eda["cardinality"] == {0: 6, 2: 18}
    assert linkage.explore(spark, data, "train", out, SMALL, max_rows=5)["source3"]["rows"] == 5
    summary = linkage.pair_sample(spark, data, work, out, SMALL)
    assert set(summary) == {"true_positive", "hard_negative", "random_negative"} and all(len(x) == 91 for x in summary.values())
    rows = (tmp_path / "out" / "pair_samples.tsv").read_text().splitlines()
    assert rows[0].startswith("sample_type\tsource1_entity_id\tcandidate_entity_id\tname_exact") and len(rows) > 20


def test_a_sample_is_complete(spark, tmp_path):
    data, out = str(tmp_path / "data"), str(tmp_path / "out")
    write_fixture(spark, data, "train", 24)
    manifest = linkage.make_sample(spark, data, out, 8, 3)
    assert manifest["sample_rows"]["source1"] == manifest["sample_rows"]["ground_truth"] == 8
    lines = {n: (tmp_path / "out" / f"train_{n}.tsv").read_text().splitlines() for n in ("source1", "source2", "source3", "ground_truth")}
    ids = {x.split("\t")[0] for n in ("source2", "source3") for x in lines[n][1:]}
    wanted = {i for x in lines["ground_truth"][1:] for i in x.split("\t")[1].split(",") if i}
    assert wanted <= ids and len(ids) == len(wanted) + 6 and [x.split("\t")[0] for x in lines["source1"]] == [x.split("\t")[0].replace("source1_entity_id", "entity_id") for x in lines["ground_truth"]]
    assert linkage.make_sample(spark, data, out, 8, 3) == manifest
    path = tmp_path / "data" / "train_source2.tsv"
    path.write_text("\n".join(x for x in path.read_text().splitlines() if not x.startswith(f"{sorted(i for i in wanted if i.startswith('S2'))[0]}\t")) + "\n")
    with pytest.raises(IntegrityError, match="missing"):
        linkage.make_sample(spark, data, out, 8, 3)


def test_resumed_scoring_handles_new_files_once(spark, tmp_path):
    source, out, state = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state")
    score = lambda df: df.selectExpr("id", "id * 2 as score")
    spark.range(10).coalesce(1).write.parquet(source)
    assert run_available(spark, source, "id long", state, out, {"model": 1}, score) == 1
    spark.range(10, 15).coalesce(1).write.mode("append").parquet(source)
    assert run_available(spark, source, "id long", state, out, {"model": 1}, score) == 1
    assert run_available(spark, source, "id long", state, out, {"model": 1}, score) == 0
    assert sorted(r.id for r in rows_of(spark, out).collect()) == list(range(15))
    try:
        run_available(spark, source, "id long", state, out, {"model": 2}, score)
        raise AssertionError("another model must be refused")
    except ValueError:
        pass
