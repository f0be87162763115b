"""One query per operator over the driver's tables. Their SQL is in ``oracles``.

The business sources are not among the tables. Text, retrieval and evaluation run on records made of the
documents: every fifth document is of source 1, the others of sources 2 and 3; the name is the whole first line,
the address all text after it. Links are equal texts. Searches take every row whose id is divisible by 20 as a
query, and all rows as targets. Pairwise features and models run on companies made of the customers, since edit
distances of whole documents are not what these are for: each customer is a target, each whose id is divisible
by 20 also a query under another form of its name and address, linked to the target of its id.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import similarity as s
from ..functions import text as t
from ..operators import evaluate as ev
from ..operators import exact, graph, profile, retrieval, validate
from ..operators import features as feat
from ..operators import model as m
from ..operators.fusion import budgeted, fused_topk, restricted
from ..sources import files, storage, tables
from ..sources.staging import shared_path, spread, stage
from ..streaming import resumable
from . import linkage

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def read(spark: SparkSession, d: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{table}.parquet")


def long(c: Column) -> Column:
    return c.cast("bigint")


# ---------------------------------------------------------------- surrogate records


def records(spark: SparkSession, d: str) -> DataFrame:
    """entity_id, source, doc_id, name, address, country, digest."""
    source = F.when(F.col("doc_id") % 5 == 0, 1).when(F.col("doc_id") % 2 == 0, 2).otherwise(3)
    name = F.substring_index("text", "\n", 1)
    body = F.trim(F.replace(F.substr(F.col("text"), F.length(name) + 2), F.lit("\n"), F.lit(" ")))
    return spread(read(spark, d, "documents")).select(
        F.concat(F.lit("S"), source, F.lit("-"), "doc_id").alias("entity_id"), source.alias("source"), "doc_id",
        name.alias("name"), F.concat(body, F.lit(" "), F.col("n_chars").cast("string")).alias("address"),
        F.col("lang").alias("country"), F.md5("text").alias("digest"),
    )


def sides(spark: SparkSession, d: str, query: str = "source = 1", target: str = "source > 1") -> tuple[DataFrame, DataFrame]:
    """queries (qid, name, address, country) and targets (rid, ...), cleaned."""
    rows = records(spark, d).withColumns({"name": t.clean(F.col("name")), "address": t.clean(F.col("address"))})
    rows = stage(rows, "records")
    side = lambda cond, key: rows.filter(cond).select(F.col("doc_id").alias(key), "entity_id", "name", "address", "country", "digest")
    return side(query, "qid"), side(target, "rid")


def search_sides(spark: SparkSession, d: str, fields: tuple[str, ...] = ("name", "address")) -> tuple[DataFrame, DataFrame]:
    """queries (qid) and targets (rid) with the fields that are searched, cleaned; others are neither cleaned nor written."""
    rows = stage(records(spark, d).select("doc_id", *(t.clean(F.col(f)).alias(f) for f in fields)), "records")
    return rows.filter("doc_id % 20 = 0").withColumnRenamed("doc_id", "qid"), rows.withColumnRenamed("doc_id", "rid")


def true_links(queries: DataFrame, targets: DataFrame) -> DataFrame:
    return queries.select("qid", "digest").join(targets.select("rid", "digest"), "digest").select("qid", "rid")


def part_sides(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    names = read(spark, d, "part").select("p_partkey", t.clean_ascii(F.col("p_name")).alias("text"))
    size = F.size(retrieval.search_tokens(F.col("text"))).alias("row_size")
    return names.filter("p_partkey % 20 = 0").select(F.col("p_partkey").alias("qid"), "text"), names.select(F.col("p_partkey").alias("rid"), "text", size)


def part_pairs(spark: SparkSession, d: str) -> DataFrame:
    """p_partkey and the names a, b of a part and the next one."""
    p = read(spark, d, "part").select("p_partkey", t.clean_ascii(F.col("p_name")).alias("a"))
    return p.join(p.select((F.col("p_partkey") - 1).alias("p_partkey"), F.col("a").alias("b")), "p_partkey")


# ---------------------------------------------------------------- retrieval


@query
def bm25_topk(spark, d):
    return retrieval.bm25_topk(*part_sides(spark, d))


@query
def tfidf_char_topk(spark, d):
    q, t_ = part_sides(spark, d)
    return retrieval.tfidf_topk(q, t_)


@query
def tfidf_word_topk(spark, d):
    q, t_ = part_sides(spark, d)
    return retrieval.tfidf_topk(q, t_, analyzer=retrieval.WORD)


@query
def tfidf_legacy_topk(spark, d):
    q, t_ = part_sides(spark, d)
    return retrieval.tfidf_topk(q, t_, analyzer=retrieval.LEGACY)


@query
def bm25_topk_two_field(spark, d):
    return retrieval.bm25_union(*search_sides(spark, d), ["name", "address"])


def _channels(spark, d, fields=("name", "address"), kinds=("tfidf", "bm25")):
    return retrieval.channels(*search_sides(spark, d, tuple(fields)), list(fields), kinds=kinds)


def _searched(spark, d):
    """doc_id, source, digest and the columns of normalized_record that the eight channels search; others are neither made nor written."""
    plain = records(spark, d).withColumns({k: v for k, v in t.normalized_record(F.col("name"), F.col("address"), F.col("country")).items() if k in ("name_norm", "address_norm")})
    latin = {k: t.clean(t.transliterate(F.col(c))) for k, c in (("name_translit", "name_norm"), ("address_translit", "address_norm"))}
    return stage(plain.select("doc_id", "source", "digest", "name_norm", "address_norm").withColumns(latin), "normalized")


def _all_channels(queries, targets, k=retrieval.TOP_K):
    """The lists of all eight channels; queries has qid, targets rid, both the columns of normalized_record."""
    named = lambda df, key: df.select(key, *(F.col(c).alias(f) for f, c in feat.FIELDS.items()))
    return retrieval.channels(named(queries, "qid"), named(targets, "rid"), list(feat.FIELDS), k)


@query
def hybrid_rrf_topk(spark, d):
    return _fused_documents(spark, d).select("qid", "rid", F.round("rrf", 8).alias("rrf"), "n_channels", "best_rank", "global_rank")


def _fused_documents(spark, d):
    rows = _searched(spark, d)
    return fused_topk(_all_channels(rows.filter("doc_id % 20 = 0").withColumnRenamed("doc_id", "qid"), rows.withColumnRenamed("doc_id", "rid")))


@query
def budget_recut(spark, d):
    """Lists of 50 cut again at 20 per TF-IDF channel and 10 per BM25 channel."""
    q, t_ = part_sides(spark, d)
    found = retrieval.channels(q, t_, ["text"], 50)
    return budgeted(found, 20, 10).select("qid", "rid", "channel", "rank")


@query
def rrf_mode_subset(spark, d):
    """Only the channels of the mode are searched; the mode's rule then restricts what was found."""
    mode = list(ev.MODES["A_tfidf"])
    kinds = tuple(kind for kind in ("tfidf", "bm25") if any(c.startswith(kind) for c in mode))
    return fused_topk(restricted(_channels(spark, d, kinds=kinds), mode), None).select("qid", "rid", F.round("rrf", 8).alias("rrf"), "global_rank")


@query
def channel_scores(spark, d):
    found = fused_topk(_channels(spark, d, ["name"]), None)
    return found.select("qid", "rid", F.try_element_at("scores", F.lit("tfidf_name")).alias("tfidf"), F.try_element_at("scores", F.lit("bm25_name")).alias("bm25"), long(F.size("ranks")).alias("n_ranks"))


@query
def tfidf_pair_cosine(spark, d):
    return retrieval.tfidf_cosine(part_pairs(spark, d), part_sides(spark, d)[1].select("rid", "text")).select("p_partkey", "cosine")


@query
def embedding_cosine_topk(spark, d):
    v = read(spark, d, "embeddings")
    return retrieval.dense_topk(v.filter("vec_id % 20 = 0").select(F.col("vec_id").alias("qid"), F.col("embedding").alias("vec")), v.select(F.col("vec_id").alias("rid"), F.col("embedding").alias("vec")))


# ---------------------------------------------------------------- exact blocking


def _blocked(spark, d):
    number = lambda c: F.element_at(F.split(c, "#"), -1)
    blank = lambda k, c: F.when(k % 10 == 0, "").otherwise(F.col(c).cast("string"))  # noqa: E731  some queries have no country
    q = read(spark, d, "supplier").select(F.concat(F.lit("S1-"), "s_suppkey").alias("qid"), F.coalesce(number("s_name"), F.lit("")).alias("name"), blank(F.col("s_suppkey"), "s_nationkey").alias("country"))
    c = read(spark, d, "customer").select(F.concat(F.lit("S2-"), "c_custkey").alias("tid"), F.coalesce(number("c_name"), F.lit("")).alias("name"), F.col("c_nationkey").cast("string").alias("country"))
    return q, c


@query
def exact_name_country(spark, d):
    return exact.exact_matches(*_blocked(spark, d))


@query
def exact_list_output(spark, d):
    q, c = _blocked(spark, d)
    return exact.as_lists(q, exact.exact_matches(q, c), "matched_entity_ids")


@query
def exact_unmatched(spark, d):
    q, c = _blocked(spark, d)
    return exact.without_candidates(q.select("qid"), exact.exact_matches(q, c))


# ---------------------------------------------------------------- text


@query
def clean_text(spark, d):
    r = records(spark, d)
    return r.select("doc_id", t.clean(F.col("name")).alias("name"), t.clean(F.col("address")).alias("address"))


@query
def clean_ascii(spark, d):
    return read(spark, d, "part").select("p_partkey", t.clean_ascii(F.concat(F.col("p_name"), F.lit(" & "), F.col("p_type"))).alias("text"))


@query
def normalize_legacy(spark, d):
    return records(spark, d).select("doc_id", t.normalize_legacy(F.col("name")).alias("name"))


@query
def transliterated(spark, d):
    return records(spark, d).select("doc_id", t.transliterate(F.col("name")).alias("name"))


#: Letters of each script whose Latin forms are those of LATIN_KEYS, in order.
LATIN_KEYS = "abdegiklmnoprstuv"
SCRIPT_LETTERS = {"CYRILLIC": "абдегиклмнопрстув", "GREEK": "αβδεγικλμνοπρστυβ", "HEBREW": "אבדאגיקלמנופרסטבו"}


@query
def transliterated_scripts(spark, d):
    """Part names written in other scripts, and back."""
    p = read(spark, d, "part").select("p_partkey", F.regexp_replace("p_name", f"[^{LATIN_KEYS} ]", "").alias("name"))
    return p.select("p_partkey", *(t.transliterate(F.translate("name", LATIN_KEYS, letters)).alias(script.lower()) for script, letters in SCRIPT_LETTERS.items()))


def _companies(spark, d):
    suffix = F.get(F.array(*map(F.lit, ("", " pvt ltd", " inc", " company", " llc co", " corporation limited", " ltda"))), F.pmod("c_custkey", F.lit(7)).cast("int"))
    return read(spark, d, "customer").select("c_custkey", F.concat(F.lower("c_mktsegment"), suffix).alias("name"), F.concat(F.col("c_custkey").cast("string"), F.lit(" st mary rd apt "), (F.col("c_nationkey") * 997 + 10000).cast("string"), F.when(F.col("c_custkey") % 3 == 0, F.lit(" 12ab 7b")).otherwise(""), F.when(F.col("c_custkey") % 4 == 0, F.lit(" hwy 123456")).otherwise("")).alias("address"))


@query
def token_mapping(spark, d):
    c = _companies(spark, d)
    return c.select("c_custkey", t.map_tokens(F.col("name"), t.NAME_MAPPINGS).alias("name"), t.map_tokens(F.col("address"), t.ADDRESS_MAPPINGS).alias("address"), t.map_tokens(F.col("address"), t.ADDRESS_MAPPINGS | t.STREET_MAPPING).alias("street"))


@query
def suffix_strip(spark, d):
    return _companies(spark, d).select("c_custkey", t.strip_suffixes(t.map_tokens(F.col("name"), t.NAME_MAPPINGS)).alias("core"))


@query
def first_distinct_tokens(spark, d):
    return records(spark, d).select("doc_id", F.array_join(t.first_tokens(t.clean(F.col("address"))), " ").alias("tokens"))


@query
def script_label(spark, d):
    return records(spark, d).select("doc_id", t.script_label(F.col("name")).alias("script"))


@query
def numbers_postal_house(spark, d):
    a = F.col("address")
    joined = lambda c: F.array_join(F.array_sort(c), ",")
    return _companies(spark, d).select("c_custkey", joined(t.numbers(a)).alias("numbers"), joined(t.postal_codes(a)).alias("postal"), t.house_number(a).alias("house"))


@query
def char_flags(spark, d):
    flags = t.character_flags(F.concat_ws(" ", "name", "address"))
    return records(spark, d).select("doc_id", *(long(v).alias(k) for k, v in flags.items()))


@query
def char_ngram_counts(spark, d):
    names = read(spark, d, "part").select(F.explode(retrieval.char_ngrams(t.clean_ascii(F.col("p_name")))).alias("gram"))
    return names.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- ingest and integrity


def _lines(spark, d):
    """Lines with a missing country, extra tabs, or as they should be."""
    k = F.col("c_custkey")
    line = F.when(k % 5 == 0, F.concat_ws("\t", F.concat(F.lit("S2-"), k), "c_name", "c_mktsegment")).when(k % 7 == 0, F.concat_ws("\t", F.concat(F.lit("S2-"), k), "c_name", F.lit("Unit 4"), F.lit(""), "c_mktsegment", F.lit("FR")))
    return read(spark, d, "customer").select("c_custkey", line.otherwise(F.concat_ws("\t", F.concat(F.lit("S2-"), k), "c_name", "c_mktsegment", F.lit("DE"))).alias("line"))


@query
def repair_rows(spark, d):
    return tables.repaired(_lines(spark, d)).select("c_custkey", *tables.FIELDS)


@query
def repair_audit(spark, d):
    return tables.repaired(_lines(spark, d)).filter("repair is not null").groupBy("repair").agg(F.count(F.lit(1)).alias("n"))


@query
def id_list_validate(spark, d):
    forms = F.array(*map(F.lit, ("", "a", "a,b", "a,a", "a,", " a,b", "a, b", "b,,c")))
    lists = read(spark, d, "customer").select("c_custkey", F.get(forms, F.pmod("c_custkey", F.lit(8)).cast("int")).alias("list"))
    return lists.select("c_custkey", long(F.size(tables.id_list(F.col("list")))).alias("n_ids"), long(tables.bad_id_list(F.col("list"))).alias("bad"))


@query
def id_well_formed(spark, d):
    k = F.col("c_custkey")
    made = F.when(k % 4 == 0, F.concat(F.lit("S2-"), k)).when(k % 4 == 1, F.concat(F.lit("S3-"), k)).when(k % 4 == 2, F.concat(F.lit(" S2-"), k)).otherwise(F.concat(F.lit("S2-"), k, F.lit(",1")))
    return read(spark, d, "customer").select("c_custkey", long(tables.well_formed(made, 2)).alias("ok"))


def _guessed(spark, d):
    """Queries, targets, and links that are partly wrong; every ninth query has no label, every eighth two rows."""
    r = records(spark, d)
    q = r.filter("source = 1").select(F.col("entity_id").alias("qid"), "doc_id")
    targets = r.filter("source > 1").select(F.col("entity_id").alias("tid"), "source")
    links = q.filter("doc_id % 9 <> 0").select("qid", F.concat(F.lit("S"), F.pmod(F.col("doc_id") + 1, F.lit(2)) + 2, F.lit("-"), F.col("doc_id") + F.pmod("doc_id", F.lit(4))).alias("tid"))
    labels = q.filter("doc_id % 9 <> 0").select("qid").unionByName(q.filter("doc_id % 8 = 0 and doc_id % 9 <> 0").select("qid"))
    return q.select("qid"), targets, links, labels


@query
def truth_unknown_targets(spark, d):
    _, targets, links, _ = _guessed(spark, d)
    return validate.unknown_targets(links, targets)


@query
def truth_missing_labels(spark, d):
    q, _, _, labels = _guessed(spark, d)
    return validate.missing_labels(q, labels)


@query
def truth_examples(spark, d):
    _, targets, links, _ = _guessed(spark, d)
    return validate.examples(validate.unknown_targets(links, targets), "tid")


@query
def unknown_by_prefix(spark, d):
    _, targets, links, _ = _guessed(spark, d)
    return validate.unknown_by_source(links, targets)


@query
def duplicate_ids(spark, d):
    _, _, _, labels = _guessed(spark, d)
    return profile.duplicates(labels.withColumn("file", F.lit("truth")), "qid", "file")


@query
def integrity_status(spark, d):
    q, targets, links, labels = _guessed(spark, d)
    n = lambda df: df.agg(F.count(F.lit(1)).alias("n"))
    failures = n(validate.unknown_targets(links, targets)).unionByName(n(validate.missing_labels(q, labels))).unionByName(profile.duplicates(labels.withColumn("file", F.lit("t")), "qid", "file").select(F.col("n_duplicates").alias("n")))
    return validate.status(failures, n(tables.repaired(_lines(spark, d)).filter("repair is not null")))


@query
def validate_output(spark, d):
    q, targets, links, _ = _guessed(spark, d)
    lists = links.groupBy("qid").agg(F.collect_set("tid").alias("ids"))
    capped = links.join(targets.select("tid"), "tid", "left_semi").groupBy("qid").agg(F.collect_set("tid").alias("ids"))
    return validate.output_problems(lists, capped, q, targets)


# ---------------------------------------------------------------- files


def _file(spark, d, tag, n=2, fields=tables.FIELDS):
    """The path of a TSV file of all customers as a source, ordered by id."""
    k = F.col("c_custkey")
    line = F.concat_ws("\t", F.concat(F.lit(f"S{n}-"), F.lpad(k.cast("string"), 9, "0")), "c_name", "c_mktsegment", F.col("c_nationkey").cast("string"))
    return _written(spark, read(spark, d, "customer").select(k.alias("place"), line.alias("value")), tag, fields)


def _written(spark, lines, tag, fields):
    path = shared_path(spark, tag) + ".tsv"
    head = spark.range(1).select(F.lit(-1).cast("bigint").alias("place"), F.lit("\t".join(fields)).alias("value"))
    storage.one_file(head.unionByName(lines).orderBy("place").select("value"), path)
    return path


@query
def strict_read(spark, d):
    return tables.read_strict(spark, _file(spark, d, "strict"))


@query
def repair_lines(spark, d):
    """Which lines of a file were mended, by number."""
    lines = _lines(spark, d).select(F.col("c_custkey").alias("place"), F.col("line").alias("value"))
    return tables.read_repairing(spark, _written(spark, lines, "repair", tables.FIELDS))[1]


@query
def source_set(spark, d):
    folder = shared_path(spark, "sources")
    for n in (1, 2, 3):
        storage.rename(_file(spark, d, f"source{n}", n), f"{folder}/train_source{n}.tsv")
    first, others = tables.read_sources(spark, folder, "train")
    every = first.select(F.lit(1).alias("source"), "entity_id", "country").unionByName(others.select("source", "entity_id", "country"))
    return every.groupBy("source", "country").agg(F.count(F.lit(1)).alias("n"), F.min("entity_id").alias("first_id")).withColumn("source", long(F.col("source")))


@query
def file_statistics(spark, d):
    stats = files.file_stats(_file(spark, d, "stats"))
    return spark.createDataFrame([(stats["sha256"], stats["bytes"], stats["physical_lines"])], "sha256 string, bytes bigint, physical_lines bigint")


def _lists(spark, d):
    q, links = _truth(spark, d)
    lists = links.groupBy("qid").agg(F.collect_set("tid").alias("ids"))
    return q.join(lists, "qid", "left").select("qid", F.coalesce("ids", F.array().cast("array<string>")).alias("ids"))


@query
def list_file(spark, d):
    """Truth written as a list file and read back, with each query's line."""
    path, lists = shared_path(spark, "lists") + ".tsv", _lists(spark, d)
    tables.write_lists(lists, lists.select("qid", F.col("qid").alias("place")), path, tables.TRUTH_FIELDS[1])
    found = tables.read_lists(spark, path, tables.TRUTH_FIELDS[1])
    return found.select("qid", F.array_join("ids", ",").alias("ids"), F.col("place").alias("line"))


@query
def truth_read(spark, d):
    """Links of a truth file that names known queries and targets only."""
    path, lists = shared_path(spark, "truth") + ".tsv", _lists(spark, d)
    tables.write_lists(lists, lists.select("qid", F.col("qid").alias("place")), path, tables.TRUTH_FIELDS[1])
    r = records(spark, d)
    return tables.links_of(tables.read_truth(spark, path, r.filter("source = 1"), r.filter("source > 1")))


@query
def files_validated(spark, d):
    """The number of queries of two list files, staged, validated and put in their places."""
    lists, r = stage(_lists(spark, d), "file-lists"), records(spark, d)
    n = linkage.write_pair(spark, lists, lists, lists.select("qid"), r.filter("source > 1").select(F.col("entity_id").alias("tid")), shared_path(spark, "pair"))
    return spark.createDataFrame([(n,)], "n_queries bigint")


@query
def manifest_guard(spark, d):
    """What a manifest says to the same run, and to a run over other tables."""
    path = shared_path(spark, "manifest") + ".json"
    manifest = {"rows": read(spark, d, "customer").count()}
    out = [("first", str(files.require_same_manifest(path, manifest)).lower()), ("same", str(files.require_same_manifest(path, manifest)).lower())]
    try:
        files.require_same_manifest(path, {"rows": manifest["rows"] + 1})
    except ValueError:
        out.append(("other", "refused"))
    return spark.createDataFrame(out, "run string, answer string")


@query
def resumed_scores(spark, d):
    """Orders scored as files that come in two lots, each file once."""
    orders, base = read(spark, d, "orders").select("o_orderkey", "o_totalprice"), shared_path(spark, "resumed")
    score = lambda df: df.select("o_orderkey", F.floor("o_totalprice").alias("score"))
    for lot in (0, 1):
        orders.filter(F.pmod("o_orderkey", F.lit(2)) == lot).write.mode("append").parquet(f"{base}/in")
        for _ in range(2):  # the second run finds nothing new
            resumable.run_available(spark, f"{base}/in", "o_orderkey bigint, o_totalprice double", f"{base}/state", f"{base}/out", {"model": 1}, score)
    return resumable.rows_of(spark, f"{base}/out")


@query
def first_of_each(spark, d):
    rows = read(spark, d, "customer").select(F.col("c_nationkey").alias("file"), F.col("c_custkey").alias("n"), "c_name")
    return profile.first_rows(rows, 5)


@query
def threshold_validity(spark, d):
    value = F.col("c_acctbal") / 5000
    return read(spark, d, "customer").select("c_custkey", long(ev.valid_threshold(value)).alias("valid"))


@query
def tfidf_empty_vocabulary(spark, d):
    """No term is in so many rows, so the channel is silently empty."""
    names = read(spark, d, "nation").select(F.col("n_nationkey").cast("bigint").alias("rid"), t.clean_ascii(F.col("n_name")).alias("text"))
    return retrieval.tfidf_topk(names.withColumnRenamed("rid", "qid"), names, analyzer=retrieval.Analyzer(min_df=1000))


# ---------------------------------------------------------------- profiles


@query
def distribution_disc(spark, d):
    docs = read(spark, d, "documents").select("lang", F.length("text").alias("chars"))
    return profile.distribution(docs, "chars", "lang")


@query
def quantile_linear(spark, d):
    return profile.quantiles(read(spark, d, "lineitem"), "l_extendedprice", "l_returnflag")


def _token_counts(spark, d):
    cleaned = records(spark, d).select(t.clean(F.col("name")).alias("name"), t.clean(F.col("address")).alias("address"))
    return profile.token_counts(cleaned, "name", "address")


@query
def token_top30(spark, d):
    return profile.common_tokens(_token_counts(spark, d))


@query
def token_rare30(spark, d):
    return profile.rare_tokens(_token_counts(spark, d))


@query
def unique_nonblank(spark, d):
    return profile.unique_nonblank(records(spark, d), "name", "address")


@query
def missing_percentages(spark, d):
    name = F.when(F.col("doc_id") % 11 == 0, F.lit("  ")).otherwise(F.col("name"))
    return profile.flag_percentages(records(spark, d), profile.source_flags(name, F.col("address"), F.col("country")))


@query
def group_counts(spark, d):
    return profile.group_counts(records(spark, d), F.col("country"), "country")


@query
def script_counts(spark, d):
    return profile.script_counts(records(spark, d), "name", "address")


@query
def repeated_names(spark, d):
    return profile.repeated_values(records(spark, d), "name")


def _truth(spark, d):
    r = records(spark, d)
    q = r.filter("source = 1").select(F.col("entity_id").alias("qid"), "digest")
    return q.select("qid"), q.join(r.filter("source > 1").select(F.col("entity_id").alias("tid"), "digest"), "digest").select("qid", "tid")


@query
def truth_cardinality(spark, d):
    return profile.truth_cardinality(*_truth(spark, d))


@query
def cardinality_histogram(spark, d):
    return profile.cardinality_histogram(*_truth(spark, d))


@query
def feature_summary(spark, d):
    p = part_pairs(spark, d).withColumn("sample_type", F.concat(F.lit("k"), (F.col("p_partkey") % 3).cast("string")))
    a, b = F.col("a"), F.col("b")
    values = p.select("sample_type", s.levenshtein_similarity(a, b).alias("levenshtein"), s.jaccard(t.tokens(a), t.tokens(b)).alias("jaccard"))
    return profile.feature_summary(values, ["levenshtein", "jaccard"])


# ---------------------------------------------------------------- sampling, graph, splits


@query
def hash_sample(spark, d):
    return graph.hash_sample(read(spark, d, "orders").select("o_orderkey", "o_totalprice"), "o_orderkey", 100)


@query
def hash_sample_blake(spark, d):
    return graph.hash_sample(read(spark, d, "orders").select("o_orderkey"), "o_orderkey", 100, exact=True)


@query
def label_complete_sample(spark, d):
    _, links = _truth(spark, d)
    targets = records(spark, d).filter("source > 1").select(F.col("entity_id").alias("tid"), "source")
    return graph.label_complete_sample(targets, links, 50).select("tid", long(F.col("source")).alias("source"), "role")


def _shared_lines(spark, d):
    docs = read(spark, d, "documents")
    return docs.select(F.col("doc_id").alias("qid"), F.md5(F.split("text", "\n")[0]).alias("tid")).unionByName(docs.select(F.col("doc_id").alias("qid"), F.md5("text").alias("tid")))


@query
def components(spark, d):
    return graph.components(_shared_lines(spark, d))


@query
def components_of_sample(spark, d):
    """Components of the queries divisible by 20, over their own links only."""
    links = _shared_lines(spark, d)
    sample = links.filter("qid % 20 = 0").select("qid").distinct()
    return graph.components_of(links, sample, whole_graph=False)


@query
def grouped_split(spark, d):
    return graph.grouped_split(graph.components(_shared_lines(spark, d)))


@query
def grouped_folds(spark, d):
    return graph.folds(graph.components(_shared_lines(spark, d))).select("qid", "component", long(F.col("fold")).alias("fold"))


# ---------------------------------------------------------------- similarities and features


@query
def levenshtein_sim(spark, d):
    return part_pairs(spark, d).select("p_partkey", F.round(s.levenshtein_similarity(F.col("a"), F.col("b")), 6).alias("sim"))


@query
def jaro_winkler_sim(spark, d):
    a, b = F.col("a"), F.col("b")
    return part_pairs(spark, d).select("p_partkey", F.round(s.jaro(a, b), 6).alias("jaro"), F.round(s.jaro_winkler(a, b), 6).alias("jaro_winkler"))


@query
def token_set_features(spark, d):
    a, b = t.tokens(F.col("a")), t.tokens(F.col("b"))
    return part_pairs(spark, d).select("p_partkey", F.round(s.jaccard(a, b), 6).alias("jaccard"), F.round(s.overlap_coefficient(a, b), 6).alias("overlap"), s.containment(a, b).alias("containment"), s.exact(F.col("a"), F.col("b")).alias("exact"))


@query
def token_ratio_features(spark, d):
    a, b = F.col("a"), F.col("b")
    return part_pairs(spark, d).select("p_partkey", F.round(s.token_set(a, b), 6).alias("token_set"), F.round(s.token_sort(a, b), 6).alias("token_sort"), F.round(s.sequence_ratio(a, b), 6).alias("sequence"))


@query
def prefix_length(spark, d):
    a, b = F.col("a"), F.col("b")
    return part_pairs(spark, d).select("p_partkey", F.round(s.prefix_similarity(a, b), 6).alias("prefix"), F.round(s.length_ratio(a, b), 6).alias("length_ratio"))


@query
def numeric_features(spark, d):
    c = _companies(spark, d).select("c_custkey", "address")
    pairs = c.join(c.select((F.col("c_custkey") - 1).alias("c_custkey"), F.col("address").alias("other")), "c_custkey")
    return pairs.select("c_custkey", *(F.round(v, 6).alias(k) for k, v in feat.numeric_features(F.col("address"), F.col("other")).items()))


def _candidates(spark, d):
    """queries, targets, links and BM25 candidates (qid, tid, best_rank, global_rank, score) of the records."""
    q, t_ = sides(spark, d)
    found = retrieval.bm25_topk(q.select("qid", F.col("name").alias("text")), t_.select("rid", F.col("name").alias("text"), F.size(retrieval.search_tokens(F.col("name"))).alias("row_size")))
    found = found.select("qid", F.col("rid").alias("tid"), F.col("rank").alias("best_rank"), F.col("rank").alias("global_rank"))
    side = lambda df, key, mark: df.select(F.col(key).alias("qid" if mark == "q" else "tid"), F.col("name").alias(f"name_{mark}"), F.col("address").alias(f"address_{mark}"))
    pairs = found.join(side(q, "qid", "q"), "qid").join(side(t_, "rid", "t"), "tid")
    score = (s.jaccard(t.tokens(F.col("name_q")), t.tokens(F.col("name_t"))) + s.jaccard(t.tokens(F.col("address_q")), t.tokens(F.col("address_t")))) / 2
    pairs = stage(pairs.withColumn("score", F.round(score, 6)), "candidates")
    return q, t_, true_links(q, t_).withColumnRenamed("rid", "tid"), pairs


def _retrieved(spark, d, linked=False):
    """queries, links (qid, tid), and the lists of all eight channels (qid, tid) with room for recall at 50.

    Measures that count found links only (linked) need no list of a query without a link, so these are not searched for.
    """
    rows = _searched(spark, d)
    q, t_ = rows.filter("source = 1").withColumnRenamed("doc_id", "qid"), rows.filter("source > 1").withColumnRenamed("doc_id", "rid")
    as_tid = lambda df: df.withColumnRenamed("rid", "tid")
    searched = stage(q.join(t_.select("digest").distinct(), "digest", "left_semi"), "linked-queries") if linked else q
    return q, as_tid(true_links(q, t_)), as_tid(stage(_all_channels(searched, t_, 50), "channels"))


def _fused(found):
    return fused_topk(found.withColumnRenamed("tid", "rid"), None).withColumnRenamed("rid", "tid")


@query
def label_join(spark, d):
    _, _, links, pairs = _candidates(spark, d)
    return feat.labelled(pairs.withColumnRenamed("tid", "rid"), links.withColumnRenamed("tid", "rid")).select("qid", "rid", "score", long(F.col("y")).alias("y"))


@query
def class_counts(spark, d):
    _, _, links, pairs = _candidates(spark, d)
    return ev.class_counts(pairs, links)


CUT = 0.6


def _counts(spark, d):
    q, _, links, pairs = _candidates(spark, d)
    about = q.select("qid", "country", t.script_label(F.col("name")).alias("script"))
    return ev.query_counts(about, links, pairs.filter(F.col("score") >= CUT), pairs)


@query
def macro_f05(spark, d):
    return ev.evaluate(_counts(spark, d)).select("s1_count", "macro_f05")


@query
def micro_metrics(spark, d):
    return ev.evaluate(_counts(spark, d)).drop("macro_f05")


@query
def slice_breakdown(spark, d):
    return ev.breakdown(_counts(spark, d))


@query
def threshold_trace(spark, d):
    q, _, links, pairs = _candidates(spark, d)
    return ev.threshold_trace(q, links, pairs).select(long(F.col("step")).alias("step"), F.round("threshold", 6).alias("threshold"), "macro_f05")


@query
def threshold_search(spark, d):
    q, _, links, pairs = _candidates(spark, d)
    return ev.best_threshold(ev.threshold_trace(q, links, pairs)).select(F.round("threshold", 6).alias("threshold"), "macro_f05")


@query
def recall_at_k(spark, d):
    q, links, found = _retrieved(spark, d, linked=True)
    return ev.recall_at(q, links, _fused(found))


@query
def candidate_sizes(spark, d):
    q, t_, _, pairs = _candidates(spark, d)
    return ev.candidate_sizes(q, pairs, t_.count())


def _pilot(spark, d, linked=False):
    q, links, found = _retrieved(spark, d, linked)
    return ev.cap_pilot(q, links, _fused(budgeted(found)))


@query
def cap_pilot(spark, d):
    return _pilot(spark, d)  # its candidate pairs are those of all queries


@query
def cap_decision(spark, d):
    return ev.cap_decision(_pilot(spark, d, linked=True))


@query
def attribution(spark, d):
    _, links, found = _retrieved(spark, d, linked=True)
    return ev.attribution(links, budgeted(found))


@query
def error_classes(spark, d):
    q, t_, links, pairs = _candidates(spark, d)
    judged = links.withColumn("yes", F.lit(True)).join(pairs.select("qid", "tid", (F.col("score") >= CUT).alias("selected"), F.lit(True).alias("retrieved"), F.array(F.lit("bm25_name")).alias("channels")), ["qid", "tid"], "full_outer")
    judged = judged.fillna(False, ["yes", "selected", "retrieved"]).withColumn("channels", F.coalesce("channels", F.array().cast("array<string>")))
    ascii_only = lambda c: t.squeeze(F.regexp_replace(c, "[^ -~]", ""))
    side = lambda df, key, mark: df.select(F.col(key).alias("qid" if mark == "q" else "tid"), ascii_only(F.col("name")).alias(f"name_{mark}"), F.col("address").alias(f"address_{mark}"), t.script_label(F.col("name")).alias(f"script_{mark}"))
    judged = judged.join(side(q, "qid", "q"), "qid").join(side(t_, "rid", "t"), "tid").join(links.groupBy("qid").agg(F.count(F.lit(1)).alias("n_true")), "qid", "left").fillna(0, ["n_true"])
    a, b = F.col("address_q"), F.col("address_t")
    judged = judged.withColumns({"numbers_q": t.numbers(a), "numbers_t": t.numbers(b), "address_sim": s.jaccard(t.tokens(a), t.tokens(b)), "name_sim": F.round(s.jaro_winkler(F.col("name_q"), F.col("name_t")), 6)})
    return ev.error_classes(judged)


@query
def pair_sample_kinds(spark, d):
    q, t_, links, pairs = _candidates(spark, d)
    return profile.pair_samples(q, links, pairs, t_.withColumnRenamed("rid", "tid"))


# ---------------------------------------------------------------- feature vectors and models


@query
def pair_features_12(spark, d):
    q, t_ = _company_sides(spark, d)
    found = retrieval.bm25_topk(q.select("qid", F.col("business_name").alias("text")), t_.select("rid", F.col("business_name").alias("text"), F.size(retrieval.search_tokens(F.col("business_name"))).alias("row_size")))
    side = lambda df, key, mark: df.select(key, *(F.col(c).alias(f"{n}_{mark}") for n, c in (("name", "business_name"), ("address", "business_address"), ("country", "country"))))
    return feat.legacy_features(found.select("qid", "rid").join(side(q, "qid", "q"), "qid").join(side(t_, "rid", "t"), "rid"))


def _company_sides(spark, d):
    """queries (qid) and targets (rid) with the columns of a source; a query's true target has its id."""
    k = F.col("c_custkey")
    pick = lambda n, *values: F.get(F.array(*map(F.lit, values)), n.cast("int"))
    words = F.transform(F.split(k.cast("string"), ""), lambda c: F.get(F.array(*map(F.lit, tables.NAMES[:10])), c.cast("int")))
    form = F.pmod(F.floor(k / 20), F.lit(4))
    zip_code, nation = (F.col("c_nationkey") * 997 + 10000).cast("string"), F.concat(F.lit("Nation "), F.col("c_nationkey").cast("string"))
    rows = stage(spread(read(spark, d, "customer")).select(
        "c_custkey",
        F.concat_ws(" ", F.array_join(words, " "), F.lit("Pvt Ltd")).alias("query_name"),
        F.concat_ws(" ", F.when(form == 1, F.array_join(words, "")).otherwise(F.array_join(words, " ")), pick(F.pmod(k, F.lit(3)), "", "Ltd", "Private Limited")).alias("target_name"),
        F.concat(k.cast("string"), F.lit(" St Mary Rd, Apt "), zip_code).alias("query_address"),
        F.when(form == 2, F.concat(F.lit("9"), k.cast("string"), F.lit(" Market Ln"))).otherwise(F.concat(k.cast("string"), F.lit(" St. Mary Road "), zip_code)).alias("target_address"),
        nation.alias("query_country"), F.when(form == 3, "").otherwise(nation).alias("target_country"), F.md5(k.cast("string")).alias("digest"),
    ), "companies")
    side = lambda df, key, mark: df.select(F.col("c_custkey").alias(key), F.col(f"{mark}_name").alias("business_name"), F.col(f"{mark}_address").alias("business_address"), F.col(f"{mark}_country").alias("country"), "digest")
    return side(rows.filter("c_custkey % 20 = 0"), "qid", "query"), side(rows, "rid", "target")


def _normalized_companies(spark, d):
    q, t_ = _company_sides(spark, d)
    normal = lambda df, tag: stage(df.withColumns(t.normalized_record(F.col("business_name"), F.col("business_address"), F.col("country"))), tag)
    return normal(q, "query-companies"), normal(t_, "target-companies")


@query
def hybrid_companies_topk(spark, d):
    """All eight channels over short records, as the business sources have them."""
    found = fused_topk(_all_channels(*_normalized_companies(spark, d)))
    return found.select("qid", "rid", F.round("rrf", 8).alias("rrf"), "n_channels", "best_rank", "global_rank")


@query
def normalized_companies(spark, d):
    rows = _normalized_companies(spark, d)[1]
    return rows.select("rid", "name_norm", "address_norm", "name_core", "name_translit", "address_translit", "country_norm", "script")


def _features(spark, d):
    q, t_ = _normalized_companies(spark, d)
    return q, t_, feat.pair_features(fused_topk(_all_channels(q, t_)).select("qid", "rid", "scores"), q, t_)


@query
def pair_features_91(spark, d):
    return _features(spark, d)[2]


def _training(spark, d):
    """Labelled pairs, and the component (qid, component) of every query in the graph of links."""
    q, t_, pairs = _features(spark, d)
    links = true_links(q, t_)
    groups = graph.components_of(links.withColumnRenamed("rid", "tid"), q)
    return stage(feat.labelled(pairs, links), "training"), groups


@query
def logistic_oof(spark, d):
    pairs, groups = _training(spark, d)
    return m.out_of_fold(pairs.join(graph.folds(groups).select("qid", "fold"), "qid"), feat.FEATURE_NAMES).select("qid", "rid", "fold", "y", "score")


@query
def gbt_score(spark, d):
    """Scores of the pairs outside the training split."""
    pairs, groups = _training(spark, d)
    pairs = stage(pairs.join(graph.grouped_split(groups).select("qid", "split"), "qid"), "split-pairs")
    return m.scored(m.fit_trees(pairs.filter("split = 'train'"), feat.FEATURE_NAMES), pairs.filter("split <> 'train'")).select("qid", "rid", "y", "score")


@query
def linear_score(spark, d):
    """The linear reference model's scores of the pairs outside the training split."""
    pairs, groups = _training(spark, d)
    pairs = stage(pairs.join(graph.grouped_split(groups).select("qid", "split"), "qid"), "split-pairs")
    return m.scored(m.fit_reference(pairs.filter("split = 'train'"), feat.FEATURE_NAMES), pairs.filter("split <> 'train'")).select("qid", "rid", "y", "score")


@query
def feature_distributions(spark, d):
    """Mean, median and p95 of all features, by label."""
    pairs, _ = _training(spark, d)
    return profile.feature_summary(pairs.withColumn("sample_type", F.when(F.col("y") == 1, "true").otherwise("wrong")), list(feat.FEATURE_NAMES))


def queries() -> dict[str, Query]:
    return dict(QUERIES)
