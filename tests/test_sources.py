import json
import zipfile

import pytest
from pyspark.sql import functions as F

from linkloom.operators.validate import IntegrityError, audit
from linkloom.sources import files, storage, tables

HEADER = "\t".join(tables.FIELDS)


def put(folder, name, *lines):
    path = folder / name
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(path)


def test_strict_reader_rejects(spark, tmp_path):
    ok = put(tmp_path, "ok.tsv", "﻿" + HEADER, "S1-1\tA\tB\tC", "S1-2\t\t\t")
    assert [tuple(r) for r in tables.read_strict(spark, ok).collect()] == [("S1-1", "A", "B", "C"), ("S1-2", "", "", "")]
    for k, bad in enumerate((["S1-1\tA\tB"], ["S1-1\tA\tB\tC\tD"], ["S1-1\tA\tB\tC"] * 2, ["\tA\tB\tC"], [" S1-1\tA\tB\tC"])):
        with pytest.raises(tables.TableError):
            tables.read_strict(spark, put(tmp_path, f"bad{k}.tsv", HEADER, *bad))
    with pytest.raises(tables.TableError):
        tables.read_strict(spark, put(tmp_path, "head.tsv", "a\tb", "1\t2"))


def test_repairing_reader(spark, tmp_path):
    path = put(tmp_path, "r.tsv", HEADER, "S1-1\tA\tB", "S1-2\tA\tB1\t\tB2\tFR", "S1-3\tA\tB\tC")
    rows, repairs = tables.read_repairing(spark, path)
    assert [tuple(r) for r in rows.orderBy("entity_id").collect()] == [("S1-1", "A", "B", ""), ("S1-2", "A", "B1 B2", "FR"), ("S1-3", "A", "B", "C")]
    assert [tuple(r) for r in repairs.orderBy("entity_id").collect()] == [(2, "S1-1", tables.MISSING_COUNTRY), (3, "S1-2", tables.EXTRA_TABS)]
    for k, line in enumerate(("S1-1\tA", "")):
        with pytest.raises(tables.TableError):
            tables.read_repairing(spark, put(tmp_path, f"b{k}.tsv", HEADER, line))


@pytest.mark.parametrize("text,bad", [("", False), ("a", False), ("a,b", False), ("a,a", True), ("a,", True), (" a", True), ("a, b", True)])
def test_id_lists(spark, text, bad):
    df = spark.createDataFrame([(text,)], "x string")
    assert df.select(tables.bad_id_list(F.col("x"))).first()[0] is bad


def test_fixture_and_truth(spark, tmp_path):
    tables.write_fixture(spark, str(tmp_path))
    first, others = tables.read_sources(spark, str(tmp_path), "train")
    assert (first.count(), others.count()) == (12, 24)
    lists = tables.read_truth(spark, str(tmp_path / "train_ground_truth.tsv"), first, others)
    assert tables.links_of(lists).count() == 18 and lists.filter(F.size("ids") == 0).count() == 3
    report = audit(spark, str(tmp_path), "train", str(tmp_path / "report.json"))
    assert report["status"] == "pass" and report["ground_truth"]["total_positive_links"] == 18


def test_audit_fails_after_writing_its_report(spark, tmp_path):
    tables.write_fixture(spark, str(tmp_path))
    path = tmp_path / "train_ground_truth.tsv"
    lines = path.read_text().splitlines()
    path.write_text("\n".join([*lines, lines[1], "S1-999\tS2-999"]) + "\n")
    with pytest.raises(IntegrityError):
        audit(spark, str(tmp_path), "train", str(tmp_path / "report.json"))
    truth = json.loads((tmp_path / "report.json").read_text())["ground_truth"]
    assert (truth["duplicate_source1_labels"], truth["unknown_source1"], truth["unknown_targets"]) == (1, 1, 1)
    assert truth["unknown_target_examples"] == ["S2-999"]


def test_lists_are_written_in_order(spark, tmp_path):
    lists = spark.createDataFrame([("b", ["S3-1", "S2-1"]), ("a", [])], "qid string, ids array<string>")
    queries = spark.createDataFrame([("b", 0), ("a", 1), ("c", 2)], "qid string, place int")
    path = tmp_path / "out.tsv"
    tables.write_lists(lists, queries, str(path), "matched_entity_ids")
    assert path.read_text() == "source1_entity_id\tmatched_entity_ids\nb\tS2-1,S3-1\na\t\nc\t\n"


def test_prepare_from_zip_and_changed_input(tmp_path, spark):
    data = tmp_path / "data"
    tables.write_fixture(spark, str(data))
    with zipfile.ZipFile(tmp_path / "in.zip", "w") as z:
        for p in data.glob("*.tsv"):
            z.write(p, f"deep/er/{p.stem}(1).tsv")
    out = str(tmp_path / "out")
    manifest = files.prepare(str(tmp_path / "in.zip"), out)
    assert manifest == files.prepare(str(data), out) and manifest["train_source1.tsv"]["physical_lines"] == 13
    with (data / "train_source2.tsv").open("a") as f:
        f.write("S2-900\tx\ty\tz\n")
    with pytest.raises(ValueError, match="differs from input"):
        files.prepare(str(data), out)


def test_manifests_and_configuration(tmp_path):
    path = str(tmp_path / "m.json")
    assert files.require_same_manifest(path, {"a": 1}) is False and files.require_same_manifest(path, {"a": 1}) is True
    with pytest.raises(ValueError):
        files.require_same_manifest(path, {"a": 2})
    files.dump_json(str(tmp_path / "c.json"), {"version": "hybrid-v1"})
    with pytest.raises(ValueError):
        files.load_config(str(tmp_path / "c.json"))
    with pytest.raises(ValueError):
        files.pack(str(tmp_path), "a/b", "lists", [])


def test_quoted_fields(spark, tmp_path):
    path = put(tmp_path, "q.tsv", HEADER, 'S1-1\t"A ""B"""\t"C\tD"\tE', 'S1-2\tx"y\t""\t')
    assert [tuple(r) for r in tables.read_strict(spark, path).orderBy("entity_id").collect()] == [("S1-1", 'A "B"', "C\tD", "E"), ("S1-2", 'x"y', "", "")]


def test_line_numbers_of_a_file_of_many_tasks(spark, tmp_path):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    path = put(tmp_path, "n.tsv", HEADER, *(f"S1-{i:05}\tA\tB" + ("\tC" if i % 50 else "") for i in range(3000)))
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        assert spark.read.text(path).rdd.getNumPartitions() > 4
        _, repairs = tables.read_repairing(spark, path)
        assert [tuple(r)[:2] for r in repairs.orderBy("line").collect()] == [(i + 2, f"S1-{i:05}") for i in range(0, 3000, 50)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_files_through_the_file_systems_of_spark(spark, tmp_path, monkeypatch):
    """The way that paths of distributed file systems take, tried on this machine's."""
    monkeypatch.setattr(storage, "_local", lambda path: None)
    folder = f"file://{tmp_path}/deep"
    files.dump_json(f"{folder}/a.json", {"x": "é"})
    files.dump_json(f"{folder}/a.json", {"x": "ü"})
    assert files.read_json(f"{folder}/a.json") == {"x": "ü"} and storage.exists(f"{folder}/a.json") and not storage.exists(f"{folder}/b.json")
    big = bytes(range(256)) * 10_000
    storage.write(f"{folder}/big", [big, b"end"])
    assert storage.read(f"{folder}/big") == big + b"end" and files.file_stats(f"{folder}/big")["bytes"] == len(big) + 3
    assert files.require_same_manifest(f"{folder}/m.json", {"a": 1}) is False and files.require_same_manifest(f"{folder}/m.json", {"a": 1}) is True
    lists = spark.createDataFrame([("b", ["S3-1", "S2-1"]), ("a", [])], "qid string, ids array<string>")
    tables.write_lists(lists, lists.selectExpr("qid", "qid as place"), f"{folder}/out.tsv", "matched_entity_ids")
    assert storage.read(f"{folder}/out.tsv") == b"source1_entity_id\tmatched_entity_ids\na\t\nb\tS2-1,S3-1\n"
    names = [x.rsplit("/", 1)[-1] for x in storage.files(folder)]
    assert {"a.json", "big", "m.json", "out.tsv"} <= set(names)
    storage.remove(f"{folder}/big")
    assert not storage.exists(f"{folder}/big")


def test_prefixes_of_files(spark):
    from linkloom.operators.profile import first_rows

    rows = spark.range(200_000).selectExpr("id % 2 as file", "id as n")
    assert sorted((r.file, r.n) for r in first_rows(rows, 3).collect()) == [(0, 0), (0, 2), (0, 4), (1, 1), (1, 3), (1, 5)]
