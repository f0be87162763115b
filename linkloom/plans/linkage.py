"""Whole runs: catalog, retrieval, features, training, inference, evaluation, reports, exact baseline, packaging.

Rows are keyed by their entity id throughout, so ties go to the smaller id. Tables are written at three points
only, after normalisation, retrieval and featurisation, as later steps read each of them several times.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import asdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.similarity import jaro_winkler, token_set
from ..functions.text import normalized_record, numbers, tokens
from ..operators import evaluate as ev
from ..operators import model as m
from ..operators import profile
from ..operators.exact import exact_matches
from ..operators.features import FEATURE_NAMES, FIELDS, labelled, pair_features, target_vocabularies
from ..operators.fusion import budgeted, fused_topk, restricted
from ..operators.graph import components_of, grouped_split, hash_sample, label_complete_sample, missing_positives
from ..operators.retrieval import Analyzer, channels
from ..operators.validate import IntegrityError, validate_files, validate_output
from ..sources import storage
from ..sources.files import Config, check_team, dump_json, fingerprint, pack, require_same_manifest
from ..sources.staging import spread, stage
from ..sources.tables import FIELDS as COLUMNS
from ..sources.tables import TRUTH_FIELDS, links_of, read_lists, read_repairing, write_lists, write_table, write_tsv

Catalog = dict[str, DataFrame]


def normalized(rows: DataFrame, key: str, config: Config) -> DataFrame:
    """key, the raw columns and those of normalized_record."""
    columns = normalized_record(F.col("business_name"), F.col("business_address"), F.col("country"), config.transliterate, config.street, config.name_mappings, config.address_mappings, config.suffixes)
    return rows.select(F.col("entity_id").alias(key), "*").withColumns(columns)


def cached(spark: SparkSession, path: str, manifest: dict, make: Callable[[], DataFrame]) -> DataFrame:
    """A table that is made once per manifest; another manifest at the same place is refused."""
    if not (require_same_manifest(f"{path}.json", manifest) and storage.exists(f"{path}/_SUCCESS")):
        make().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def timed(timing: dict, name: str, make: Callable[[], DataFrame]) -> DataFrame:
    """make()'s table, with the seconds that it took and its rows added to timing."""
    began = time.perf_counter()
    table = make()
    timing[f"{name}_rows"] = table.count()
    timing[f"{name}_seconds"] = round(time.perf_counter() - began, 3)
    return table


def build_catalog(spark: SparkSession, data: str, split: str, folder: str, config: Config) -> Catalog:
    """queries, targets and (train) links as Parquet, built once per input and configuration (K4, K5)."""
    manifest = {"split": split, "files": fingerprint(data, split), "config": config.digest()}
    sources = lambda *wanted: [read_repairing(spark, f"{data}/{split}_source{n}.tsv")[0].withColumn("source", F.lit(n)) for n in wanted]

    def targets() -> DataFrame:
        second, third = sources(2, 3)
        return normalized(second.unionByName(third), "rid", config)

    def links() -> DataFrame:
        return links_of(read_lists(spark, f"{data}/train_ground_truth.tsv", TRUTH_FIELDS[1])).withColumnRenamed("tid", "rid")

    makers = {"queries": lambda: normalized(sources(1)[0], "qid", config), "targets": targets} | ({"links": links} if split == "train" else {})
    return {name: cached(spark, f"{folder}/{name}", manifest, make) for name, make in makers.items()}


def analyzers(config: Config) -> tuple[Analyzer, Analyzer]:
    """The character and the word model."""
    sample = config.vocabulary_rows or None
    return Analyzer(low=config.ngrams[0], high=config.ngrams[1], min_df=config.min_df, max_features=config.max_features, vocabulary_rows=sample), Analyzer(kind="word", sublinear=False, min_df=1, max_features=config.max_features, vocabulary_rows=sample)


def retrieve(queries: DataFrame, targets: DataFrame, config: Config, k: int | None = None) -> DataFrame:
    """qid, rid, channel, score, rank of all channels: eight, or four without transliteration."""
    fields = {f: c for f, c in FIELDS.items() if config.transliterate or not f.startswith("t")}
    named = lambda df, key: df.select(key, *(F.col(c).alias(f) for f, c in fields.items()))
    return stage(channels(named(queries, "qid"), named(targets, "rid"), list(fields), k or max(config.tfidf_k, config.bm25_k), analyzers(config)[0], config.max_tokens), "channels")


def candidates(found: DataFrame, config: Config) -> DataFrame:
    return fused_topk(budgeted(found, config.tfidf_k, config.bm25_k), config.final_k)


def featurized(pairs: DataFrame, catalog: Catalog, queries: DataFrame, config: Config) -> DataFrame:
    return pair_features(pairs, queries, catalog["targets"], target_vocabularies(catalog["targets"], *analyzers(config)))


def sampled(catalog: Catalog, config: Config) -> tuple[DataFrame, DataFrame]:
    """The sampled queries, and (qid, split) of them by components of the whole label graph (Q1, G1, M1)."""
    queries = stage(hash_sample(catalog["queries"], "entity_id", config.sample_size, config.seed), "sample")
    groups = components_of(catalog["links"].withColumnRenamed("rid", "tid"), queries)
    return queries, stage(grouped_split(groups, config.seed).select("qid", "split"), "split")


def train(spark: SparkSession, data: str, work: str, config: Config) -> dict:
    """Fits both models on the training groups, picks thresholds on calibration groups, reports on all three."""
    catalog = build_catalog(spark, data, "train", f"{work}/catalog-train", config)
    links, timing = catalog["links"], {}
    queries, split = sampled(catalog, config)
    manifest = {"files": fingerprint(data, "train"), "config": config.digest(), "features": list(FEATURE_NAMES)}
    found = timed(timing, "candidates", lambda: cached(spark, f"{work}/candidates", manifest, lambda: candidates(retrieve(queries, catalog["targets"], config), config)))
    feats = timed(timing, "features", lambda: cached(spark, f"{work}/features", manifest, lambda: labelled(featurized(found, catalog, queries, config), links).join(split, "qid")))
    training = feats.filter("split = 'train'")
    fitted = {"trees": m.fit_trees(training, FEATURE_NAMES, config.trees, rate=config.learning_rate, min_rows=config.min_rows, seed=config.seed), "linear": m.fit_reference(training, FEATURE_NAMES)}
    truth, report, thresholds, holdout = links.withColumnRenamed("rid", "tid"), {}, {}, None
    about = queries.select("qid", "country", "script").join(split, "qid")
    for name, model in fitted.items():
        scores = stage(m.scored(model, feats).select("qid", F.col("rid").alias("tid"), "y", "score", "split"), "scores")
        calibration = about.filter("split = 'calibration'")
        best = ev.best_threshold(ev.threshold_trace(calibration, truth, scores.filter("split = 'calibration'"), config.threshold_steps)).first()
        thresholds[name] = best.threshold
        report[name] = {}
        for part in ("train", "calibration", "holdout"):
            some = about.filter(F.col("split") == part)
            scored = scores.filter(F.col("split") == part)
            counts = ev.query_counts(some, truth, scored.filter(F.col("score") >= best.threshold), scored)
            report[name][part] = {r["slice"]: {k: v for k, v in r.asDict().items() if k != "slice"} for r in ev.breakdown(counts).collect()}  # a row per slice
        holdout = scores.filter("split = 'holdout'") if holdout is None else holdout
    m.save_model(fitted["trees"], f"{work}/model", FEATURE_NAMES, thresholds["trees"], asdict(config))
    importance = spark.createDataFrame([(place, *row) for place, row in enumerate(m.importances(fitted["trees"], FEATURE_NAMES))], "place int, feature string, gain double, splits long")
    write_table(importance.select("feature", "gain", "splits", "place"), f"{work}/importance.tsv", "place")
    predicted = (F.col("score") >= thresholds["trees"]).cast("int").alias("predicted")
    write_table(holdout.select(F.col("qid").alias("source1_entity_id"), F.col("tid").alias("target_entity_id"), F.col("y").alias("label"), "score", predicted), f"{work}/holdout_pairs.tsv", "source1_entity_id")
    errors = judged_errors(about.filter("split = 'holdout'").select("qid"), catalog, queries, truth, holdout, thresholds["trees"], found)
    write_tsv(errors, f"{work}/errors", "error_class")
    kinds = ev.class_counts(found.join(split.filter("split = 'train'"), "qid").withColumnRenamed("rid", "tid"), truth)
    report["classes"] = {r["class"]: r.n_pairs for r in kinds.collect()}  # three rows
    report["thresholds"], report["timing"] = thresholds, timing
    dump_json(f"{work}/report.json", report)
    return report


def judged_errors(about: DataFrame, catalog: Catalog, queries: DataFrame, truth: DataFrame, scored: DataFrame, threshold: float, found: DataFrame) -> DataFrame:
    """The error classes of the true and the predicted pairs of some queries."""
    own = truth.join(about, "qid", "left_semi").withColumn("yes", F.lit(True))
    channels_of = found.select("qid", F.col("rid").alias("tid"), F.map_keys("scores").alias("channels"))
    pairs = scored.select("qid", "tid", (F.col("score") >= threshold).alias("selected"), F.lit(True).alias("retrieved")).join(channels_of, ["qid", "tid"], "left")
    judged = own.join(pairs, ["qid", "tid"], "full_outer").fillna(False, ["yes", "selected", "retrieved"]).filter("yes or selected")
    side = lambda df, key, name, mark: df.select(F.col(key).alias(name), *(F.col(c).alias(f"{c}_{mark}") for c in ("name_norm", "address_norm", "script")))
    judged = judged.join(side(queries, "qid", "qid", "q"), "qid").join(side(catalog["targets"], "rid", "tid", "t"), "tid")
    judged = judged.join(own.groupBy("qid").agg(F.count(F.lit(1)).alias("n_true")), "qid", "left").fillna(0, ["n_true"])
    a, b = F.col("address_norm_q"), F.col("address_norm_t")
    return ev.error_classes(judged.withColumns({"channels": F.coalesce("channels", F.array().cast("array<string>")), "numbers_q": numbers(a), "numbers_t": numbers(b), "address_sim": token_set(a, b), "name_sim": jaro_winkler(F.col("name_norm_q"), F.col("name_norm_t"))}))


# ---------------------------------------------------------------- outputs


def write_pair(spark: SparkSession, matches: DataFrame, capped: DataFrame, queries: DataFrame, targets: DataFrame, output: str) -> int:
    """Both lists, staged and validated as written before either replaces its file."""
    placed = queries.select("qid").withColumn("place", F.col("qid"))
    names = {"matching_results.tsv": (matches, TRUTH_FIELDS[1]), "candidate_pairs.tsv": (capped, "candidate_entity_ids")}
    for name, (lists, column) in names.items():
        write_lists(lists, placed, f"{output}/staged-{name}", column)
    try:
        count = validate_files(spark, *(f"{output}/staged-{name}" for name in names), queries, targets)
    except Exception:
        for name in names:
            storage.remove(f"{output}/staged-{name}")
        raise
    for name in names:
        storage.rename(f"{output}/staged-{name}", f"{output}/{name}")
    return count


def infer(spark: SparkSession, data: str, work: str, output: str) -> int:
    """Scores the test split with the saved model and configuration, and writes and validates both lists."""
    model, threshold, saved = m.load_model(spark, f"{work}/model", FEATURE_NAMES)
    config = Config(**{k: tuple(v) if isinstance(v, list) else v for k, v in saved.items()})
    catalog = build_catalog(spark, data, "test", f"{work}/catalog-test", config)
    found = stage(candidates(retrieve(catalog["queries"], catalog["targets"], config), config), "candidates")
    scores = stage(m.scored(model, featurized(found, catalog, catalog["queries"], config)).select("qid", F.col("rid").alias("tid"), "score"), "scores")
    queries, targets = catalog["queries"].select("qid"), catalog["targets"].select(F.col("rid").alias("tid"))
    lists = lambda df: queries.join(df.groupBy("qid").agg(F.collect_set("tid").alias("ids")), "qid", "left").select("qid", F.coalesce("ids", F.array().cast("array<string>")).alias("ids"))
    matches, capped = lists(scores.filter(F.col("score") >= threshold)), lists(scores)
    validate_output(matches, capped, queries, targets)
    return write_pair(spark, matches, capped, queries, targets, output)


def exact_baseline(spark: SparkSession, data: str, split: str, work: str, output: str, config: Config) -> int:
    """Exact name and country matches as both lists."""
    catalog = build_catalog(spark, data, split, f"{work}/catalog-{split}", config)
    side = lambda df, key, name: df.select(F.col(key).alias(name), F.col("name_norm").alias("name"), F.col("country_norm").alias("country"))
    queries, targets = side(catalog["queries"], "qid", "qid"), side(catalog["targets"], "rid", "tid")
    found = exact_matches(queries, targets).groupBy("qid").agg(F.collect_set("tid").alias("ids"))
    lists = queries.select("qid").join(found, "qid", "left").select("qid", F.coalesce("ids", F.array().cast("array<string>")).alias("ids"))
    validate_output(lists, lists, queries, targets)
    return write_pair(spark, lists, lists, queries, targets, output)


def package(spark: SparkSession, output: str, destination: str, team: str, catalog: Catalog, mode: str = "lists", model: str | None = None, configs: list[str] = (), documents: list[str] = ()) -> str:
    """A ZIP of both lists, which are validated as they are on disk first."""
    check_team(team)
    results = [f"{output}/{name}" for name in ("matching_results.tsv", "candidate_pairs.tsv")]
    validate_files(spark, *results, catalog["queries"].select("qid"), catalog["targets"].select(F.col("rid").alias("tid")))
    return pack(destination, team, mode, results, storage.files(model) if model else [], list(configs), list(documents))


# ---------------------------------------------------------------- reports


def compare(queries: DataFrame, targets: DataFrame, links: DataFrame, config: Config) -> dict[str, DataFrame]:
    """Recall of each mode, the cap pilot and its decision, and attribution, retrieved with room for recall at 50."""
    found = retrieve(queries, targets, config, max(50, config.tfidf_k, config.bm25_k))
    as_tid = lambda df: df.withColumnRenamed("rid", "tid")
    truth = as_tid(links).join(queries.select("qid"), "qid", "left_semi")
    modes = ev.MODES | ({"D_hybrid_transliteration": None} if config.transliterate else {})
    lists = lambda df, names: as_tid(fused_topk(df if names is None else restricted(df, list(names)), None))
    out = {mode: ev.recall_at(queries, truth, lists(found, names)) for mode, names in modes.items()}
    within = budgeted(found, config.tfidf_k, config.bm25_k)
    n = targets.count()
    out |= {f"{mode}_sizes": ev.candidate_sizes(queries, lists(within, names), n) for mode, names in modes.items()}
    pilot = stage(ev.cap_pilot(queries, truth, lists(within, None), config.pilot_caps), "pilot")
    out["cap_pilot"] = pilot
    out["decision"] = ev.cap_decision(pilot, config.pilot_caps[0], config.pilot_caps[-1], config.recall_floor)
    out["attribution"] = ev.attribution(truth, as_tid(within))
    return out


def evaluate_retrieval(spark: SparkSession, data: str, work: str, output: str, config: Config) -> dict:
    """The comparison of modes over the training groups, as a report."""
    catalog = build_catalog(spark, data, "train", f"{work}/catalog-train", config)
    queries, split = sampled(catalog, config)
    queries = queries.join(split.filter("split = 'train'").select("qid"), "qid", "left_semi")
    began = time.perf_counter()
    tables = compare(stage(queries, "train-queries"), catalog["targets"], catalog["links"], config)
    report = {name: [r.asDict() for r in table.collect()] for name, table in tables.items()}  # a few rows each
    seconds, n = time.perf_counter() - began, queries.count()
    report["timing"] = {"seconds": round(seconds, 3), "queries": n, "queries_per_second": round(n / max(seconds, 1e-9), 3)}
    dump_json(f"{output}/metrics.json", report)
    return report


def explore(spark: SparkSession, data: str, split: str, output: str, config: Config, max_rows: int = 0) -> dict:
    """Profiles of the sources (the first max_rows of each, if given) and of the labels, as a report."""
    report: dict = {"split": split, "max_rows": max_rows}
    for n in (1, 2, 3):
        rows, _ = read_repairing(spark, f"{data}/{split}_source{n}.tsv")
        if max_rows:
            rows = profile.first_rows(rows.withColumns({"file": F.lit(n), "n": F.monotonically_increasing_id()}), max_rows).drop("file", "n")
        rows = stage(rows.withColumnsRenamed({"business_name": "name", "business_address": "address"}), "explored")
        counts = profile.token_counts(rows.withColumns({c: F.lower(c) for c in ("name", "address")}), "name", "address")
        one = lambda df: [r.asDict() for r in df.collect()]  # noqa: E731  a few rows
        lengths = rows.select(F.length("name").alias("name"), F.length("address").alias("address"), F.size(tokens(F.col("name"))).alias("name_tokens"))
        report[f"source{n}"] = {
            "rows": rows.count(),
            "unique": one(profile.unique_nonblank(rows, "name", "address")),
            "repeated_names": profile.repeated_values(rows, "name").first()[0],
            "flags": one(profile.flag_percentages(rows, profile.source_flags(F.col("name"), F.col("address"), F.col("country")))),
            "countries": one(profile.group_counts(rows, F.col("country"), "country").orderBy(F.desc("n"), "country").limit(300)),
            "scripts": one(profile.script_counts(rows, "name", "address")),
            "lengths": {c: one(profile.distribution(lengths, c)) for c in lengths.columns},
            "common_tokens": one(profile.common_tokens(counts)), "rare_tokens": one(profile.rare_tokens(counts)),
        }
    if split == "train":
        queries = read_repairing(spark, f"{data}/{split}_source1.tsv")[0].select(F.col("entity_id").alias("qid"))
        links = links_of(read_lists(spark, f"{data}/train_ground_truth.tsv", TRUTH_FIELDS[1]))
        report["truth"] = profile.truth_cardinality(queries, links).first().asDict()
        report["cardinality"] = {r.n_matches: r.n_queries for r in profile.cardinality_histogram(queries, links).collect()}  # a row a number of matches
    dump_json(f"{output}/eda.json", report)
    return report


def pair_sample(spark: SparkSession, data: str, work: str, output: str, config: Config, n_queries: int = 100) -> dict:
    """Features of true, hard and random pairs of some training queries, as a table and their distributions."""
    catalog = build_catalog(spark, data, "train", f"{work}/catalog-train", config)
    queries, split = sampled(catalog, config)
    some = stage(hash_sample(queries.join(split.filter("split = 'train'").select("qid"), "qid", "left_semi"), "qid", n_queries, config.seed), "some-queries")
    found = stage(candidates(retrieve(some, catalog["targets"], config), config).withColumnRenamed("rid", "tid"), "candidates")
    truth = catalog["links"].withColumnRenamed("rid", "tid").join(some.select("qid"), "qid", "left_semi")
    kinds = stage(profile.pair_samples(some.select("qid"), truth, found, catalog["targets"].select(F.col("rid").alias("tid")), config.seed), "pair-kinds")
    hard = F.when(F.col("sample_type") == "hard_negative", F.col("scores"))
    pairs = kinds.join(found.select("qid", "tid", "scores"), ["qid", "tid"], "left").withColumn("scores", F.coalesce(hard, F.create_map().cast("map<string,double>"))).withColumnRenamed("tid", "rid")
    # A random pair may be a hard one as well.
    feats = featurized(pairs.groupBy("qid", "rid").agg(F.max_by("scores", F.size("scores")).alias("scores")), catalog, some, config)
    table = stage(kinds.withColumnRenamed("tid", "rid").join(feats, ["qid", "rid"]), "pair-sample")
    write_table(table.select("sample_type", F.col("qid").alias("source1_entity_id"), F.col("rid").alias("candidate_entity_id"), *FEATURE_NAMES), f"{output}/pair_samples.tsv", "source1_entity_id")
    report: dict = {}
    for r in profile.feature_summary(table, list(FEATURE_NAMES)).collect():  # a row a kind and feature
        report.setdefault(r.sample_type, {})[r.feature] = {"mean": r["mean"], "p50": r.p50, "p95": r.p95}
    dump_json(f"{output}/similarity_distributions.json", report)
    return report


def make_sample(spark: SparkSession, data: str, output: str, n_queries: int = 2000, n_distractors: int = 100_000, seed: int = 42) -> dict:
    """A label-complete sample of the training split as four files and a manifest."""
    sources = {n: read_repairing(spark, f"{data}/train_source{n}.tsv")[0].withColumn("source", F.lit(n)) for n in (1, 2, 3)}
    queries = stage(hash_sample(sources[1], "entity_id", n_queries, seed, exact=True), "sample-queries")
    lists = read_lists(spark, f"{data}/train_ground_truth.tsv", TRUTH_FIELDS[1])
    own = stage(lists.join(queries.select(F.col("entity_id").alias("qid")), "qid", "left_semi"), "sample-lists")
    if own.count() != queries.count():
        raise IntegrityError("sampled queries lack labels")
    links = links_of(own)
    targets = sources[2].unionByName(sources[3]).withColumnRenamed("entity_id", "tid")
    if absent := missing_positives(targets, links).count():
        raise IntegrityError(f"{absent} labelled targets are missing")
    chosen = stage(label_complete_sample(spread(targets), links, n_distractors, seed), "sample-targets").withColumnRenamed("tid", "entity_id")
    manifest: dict = {"seed": seed, "distractors_per_source": n_distractors, "full_rows": {f"source{n}": df.count() for n, df in sources.items()} | {"ground_truth": lists.count()}, "sample_rows": {}}
    parts = {1: queries} | {n: chosen.filter(F.col("source") == n) for n in (2, 3)}
    for n, df in parts.items():
        manifest["sample_rows"][f"source{n}"] = write_table(df.select(*COLUMNS), f"{output}/train_source{n}.tsv", "entity_id")
    write_lists(own.select("qid", "ids"), own.select("qid", F.col("qid").alias("place")), f"{output}/train_ground_truth.tsv", TRUTH_FIELDS[1])
    manifest["sample_rows"]["ground_truth"] = own.count()
    manifest["positive_targets"] = {r.source: r["count"] for r in chosen.filter("role = 'positive'").groupBy(F.concat(F.lit("source"), "source").alias("source")).count().collect()}  # two rows
    dump_json(f"{output}/sample_manifest.json", manifest)
    return manifest
