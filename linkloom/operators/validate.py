"""Integrity audit of inputs and validation of outputs, as anti-joins and counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.files import dump_json, file_stats
from ..sources.tables import FIELDS, TRUTH_FIELDS, bad_id_list, id_list, read_lines, read_lists, read_repairing, well_formed

EXAMPLES = 25


def unknown_targets(links: DataFrame, targets: DataFrame) -> DataFrame:
    """Linked ids (tid) that are no target."""
    return links.select("tid").distinct().join(targets.select("tid"), "tid", "left_anti")


def missing_labels(queries: DataFrame, labels: DataFrame) -> DataFrame:
    """Queries without a label row."""
    return queries.select("qid").distinct().join(labels.select("qid"), "qid", "left_anti")


def unknown_by_source(links: DataFrame, targets: DataFrame) -> DataFrame:
    """Links to unknown targets by the prefix of the id."""
    bad = links.join(targets.select("tid"), "tid", "left_anti")
    name = F.when(F.col("tid").startswith("S2-"), "S2").when(F.col("tid").startswith("S3-"), "S3").otherwise("other")
    return bad.groupBy(name.alias("source")).agg(F.count(F.lit(1)).alias("n_links"))


def examples(ids: DataFrame, column: str, n: int = EXAMPLES) -> DataFrame:
    return ids.select(column).distinct().orderBy(column).limit(n)


def status(failures: DataFrame, repairs: DataFrame) -> DataFrame:
    """One row: fail, pass_with_repairs or pass; both inputs have one column n."""
    n = failures.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("failures"))
    r = repairs.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("repairs"))
    both = n.select(F.struct(F.lit(1).alias("at"), F.col("failures").alias("v")).alias("x")).unionByName(r.select(F.struct(F.lit(2).alias("at"), F.col("repairs").alias("v")).alias("x")))
    one = both.agg(F.sum(F.when(F.col("x.at") == 1, F.col("x.v"))).alias("failures"), F.sum(F.when(F.col("x.at") == 2, F.col("x.v"))).alias("repairs"))
    return one.select("failures", "repairs", F.when(F.col("failures") > 0, "fail").when(F.col("repairs") > 0, "pass_with_repairs").otherwise("pass").alias("status"))


class IntegrityError(ValueError):
    """An input or output is not what it must be."""


def audit(spark, folder: str, split: str, output: str) -> dict:
    """Checks a split's files, writes the report, and raises if anything fails."""
    rows, duplicate, repairs, stats, ids = {}, {}, {}, {}, None
    for n in (1, 2, 3):
        name = f"{split}_source{n}.tsv"
        table, fixed = read_repairing(spark, f"{folder}/{name}")
        if bad := table.filter(~well_formed(F.col(FIELDS[0]), n)).limit(1).collect():
            raise IntegrityError(f"{name}: malformed id {bad[0][0]!r}")
        counts = table.agg(F.count(F.lit(1)).alias("n"), F.count_distinct(FIELDS[0]).alias("d")).first()
        rows[name], duplicate[name] = counts.n, counts.n - counts.d
        repairs[name] = {r.repair: r["count"] for r in fixed.groupBy("repair").count().collect()}  # two kinds at most
        stats[name] = file_stats(f"{folder}/{name}")
        part = table.select(F.col(FIELDS[0]).alias("id"), F.lit(n).alias("source"))
        ids = part if ids is None else ids.unionByName(part)
    truth = {}
    if split == "train":
        name = "train_ground_truth.tsv"
        lines = read_lines(spark, f"{folder}/{name}", TRUTH_FIELDS).filter("line <> ''").select(F.split("line", "\t", -1).alias("p"))
        if lines.filter(F.size("p") != 2).limit(1).count():
            raise IntegrityError(f"{name}: wrong number of fields")
        labels = lines.select(F.col("p")[0].alias("qid"), F.col("p")[1].alias("list"))
        if labels.filter(bad_id_list(F.col("list"))).limit(1).count():
            raise IntegrityError(f"{name}: bad id list")
        links = labels.select("qid", F.explode(id_list(F.col("list"))).alias("tid"))
        queries, targets = ids.filter("source = 1").select(F.col("id").alias("qid")), ids.filter("source > 1").select(F.col("id").alias("tid"))
        count = labels.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("qid").alias("d")).first()
        strange, absent, unknown = labels.select("qid").distinct().join(queries, "qid", "left_anti"), missing_labels(queries, labels), unknown_targets(links, targets)
        truth = {
            "rows": count.n, "duplicate_source1_labels": count.n - count.d, "total_positive_links": links.count(), "unknown_source1": strange.count(), "missing_source1_labels": absent.count(), "unknown_targets": unknown.count(),
            "unknown_source1_examples": [r[0] for r in examples(strange, "qid").collect()], "unknown_target_examples": [r[0] for r in examples(unknown, "tid").collect()],
        }
        rows[name], stats[name] = count.n, file_stats(f"{folder}/{name}")
    failures = sum(duplicate.values()) + sum(truth.get(k, 0) for k in ("duplicate_source1_labels", "unknown_source1", "missing_source1_labels", "unknown_targets"))
    report = {"status": "fail" if failures else "pass_with_repairs" if any(map(bool, repairs.values())) else "pass", "split": split, "files": stats, "logical_rows": rows, "duplicate_ids": duplicate, "repairs": repairs, "ground_truth": truth}
    dump_json(output, report)
    if failures:
        raise IntegrityError(f"{failures} failures; see {output}")
    return report


# ---------------------------------------------------------------- outputs


def output_problems(matches: DataFrame, candidates: DataFrame, queries: DataFrame, targets: DataFrame) -> DataFrame:
    """problem, n over two list tables (qid, ids): 0 everywhere for a valid output."""
    pairs = lambda df: df.select("qid", F.explode("ids").alias("tid"))
    m, c, q = pairs(matches), pairs(candidates), queries.select("qid")

    def counted(name: str, df: DataFrame) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("problem"), "n")

    parts = [
        counted("repeated_query", matches.groupBy("qid").count().filter("count > 1").select("qid").unionByName(candidates.groupBy("qid").count().filter("count > 1").select("qid"))),
        counted("unknown_query", matches.select("qid").unionByName(candidates.select("qid")).distinct().join(q, "qid", "left_anti")),
        counted("query_without_row", q.join(matches.select("qid"), "qid", "left_anti").unionByName(q.join(candidates.select("qid"), "qid", "left_anti")).distinct()),
        counted("match_not_candidate", m.join(c, ["qid", "tid"], "left_anti")),
        counted("unknown_target", m.unionByName(c).select("tid").distinct().join(targets.select("tid"), "tid", "left_anti")),
        counted("bad_list", matches.unionByName(candidates).filter(F.size(F.array_distinct("ids")) != F.size("ids")).select("qid")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def validate_output(matches: DataFrame, candidates: DataFrame, queries: DataFrame, targets: DataFrame) -> int:
    """The number of queries of a valid output; raises otherwise."""
    bad = output_problems(matches, candidates, queries, targets).filter("n > 0").collect()  # six rows at most
    if bad:
        raise IntegrityError(", ".join(f"{r.problem}: {r.n}" for r in bad))
    return queries.count()


def same_order(a: DataFrame, b: DataFrame) -> bool:
    """Whether two tables (place, qid) list the same queries at the same places."""
    both = a.select("place", F.col("qid").alias("qa")).join(b.select("place", F.col("qid").alias("qb")), "place", "full_outer")
    return not both.filter(~F.col("qa").eqNullSafe(F.col("qb"))).limit(1).count()


def validate_files(spark, matches: str, candidates: str, queries: DataFrame, targets: DataFrame) -> int:
    """The number of queries of two list files that are valid and in the same order; raises otherwise."""
    m, c = read_lists(spark, matches, TRUTH_FIELDS[1]), read_lists(spark, candidates, "candidate_entity_ids")
    if not same_order(m, c):
        raise IntegrityError("the files list their queries in different order")
    return validate_output(m, c, queries, targets)
