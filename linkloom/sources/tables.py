"""Tab-separated sources: a strict reader, a repairing one, id lists, labels, and the fixture.

Lines are read as text and split with all their empty fields, so a wrong number of fields is seen instead
of being cut or filled. A header must equal the schema. Reading with the CSV reader would hide both.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import storage

# The columns of the files, and the names of repairs.
FIELDS = ("entity_id", "business_name", "business_address", "country")
TRUTH_FIELDS = ("source1_entity_id", "matched_entity_ids")
MISSING_COUNTRY, EXTRA_TABS = "missing_trailing_country", "extra_tabs_in_address"


class TableError(ValueError):
    """An input breaks its contract."""


# ---------------------------------------------------------------- lines


def read_lines(spark: SparkSession, path: str, fields: tuple[str, ...]) -> DataFrame:
    """line and n, its number in the file, of the lines after the header, which must equal fields; no carriage returns.

    A large file is read by several tasks, which see their own lines only, so the lines of each are counted first.
    """
    lines = spark.read.text(path).withColumn("id", F.monotonically_increasing_id())
    head = lines.limit(1).collect()
    first = head[0].value.removeprefix("\ufeff").removesuffix("\r") if head else ""
    if first.split("\t") != list(fields):
        raise TableError(f"{path}: header {first!r} is not {fields}")
    part = F.shiftrightunsigned("id", 33)
    own = F.col("id").bitwiseAND((1 << 33) - 1)
    if spark.read.text(path).rdd.getNumPartitions() > 1:
        counts = lines.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("c")).orderBy("part").collect()  # a row a task
        starts, total = [], 0
        for r in counts:
            starts.append((r.part, total))
            total += r.c
        lines = lines.withColumn("part", part).join(F.broadcast(spark.createDataFrame(starts, "part long, start long")), "part")
        own = own + F.col("start")
    numbered = lines.select(F.regexp_replace("value", "\r$", "").alias("line"), (own + 1).alias("n"))
    # The header is the first line of the file; an equal line further down is a malformed row of its own.
    return numbered.filter("n > 1")


def _reject(bad: DataFrame, path: str, what: str) -> None:
    if found := bad.limit(3).collect():
        raise TableError(f"{path}: {what}: " + "; ".join(str(r[0])[:80] for r in found))


def split_fields(line: Column) -> Column:
    """The fields of a line. One in quotes loses them, a doubled quote in it is one, and a tab in it is text."""
    field = F.regexp_extract_all(F.concat(F.lit("\t"), line), F.lit(r'\t("(?:[^"]|"")*"(?=\t|$)|[^\t]*)'), F.lit(1))
    return F.transform(field, lambda x: F.when(x.rlike(r'^"(?:[^"]|"")*"$'), F.replace(x.substr(F.lit(2), F.length(x) - 2), F.lit('""'), F.lit('"'))).otherwise(x))


def read_strict(spark: SparkSession, path: str, fields: tuple[str, ...] = FIELDS, numbered: bool = False) -> DataFrame:
    """A table whose rows all have every field, and whose ids are neither blank, padded nor repeated (R1); n is the line's number."""
    parts = read_lines(spark, path, fields).filter("line <> ''").select("line", "n", split_fields(F.col("line")).alias("p"))
    _reject(parts.filter(F.size("p") != len(fields)).select("line"), path, "wrong number of fields")
    rows = parts.select(*(F.col("p")[k].alias(f) for k, f in enumerate(fields)), *(["n"] if numbered else []))
    key = fields[0]
    _reject(rows.filter((F.trim(key) == "") | (F.trim(key) != F.col(key))).select(key), path, "blank or padded id")
    _reject(rows.groupBy(key).count().filter("count > 1").select(key), path, "repeated id")
    return rows


def repaired(lines: DataFrame) -> DataFrame:
    """lines (line): the four fields, and repair, what was mended or null; `broken` where nothing can be (R2)."""
    p, n = F.col("p"), F.size("p")
    parts = lines.withColumn("p", F.split("line", "\t", -1))
    inner = F.array_join(F.filter(F.slice(p, 3, F.greatest(n - 3, F.lit(0))), lambda x: F.trim(x) != ""), " ")
    repair = F.when(n == 4, F.lit(None)).when(n == 3, F.lit(MISSING_COUNTRY)).when(n > 4, F.lit(EXTRA_TABS)).otherwise(F.lit("broken"))
    values = (F.get(p, F.lit(0)), F.get(p, F.lit(1)), F.when(n > 4, inner).otherwise(F.get(p, F.lit(2))), F.when(n > 4, F.element_at(p, -1)).when(n == 4, F.get(p, F.lit(3))).otherwise(F.lit("")))
    kept = [c for c in lines.columns if c != "line"]
    return parts.select(*kept, "line", *(v.alias(f) for v, f in zip(values, FIELDS, strict=True)), repair.alias("repair"))


def read_repairing(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Rows and the audit of repairs (line, entity_id, repair); line numbers begin with 2 after the header."""
    lines = read_lines(spark, path, FIELDS)
    rows = repaired(lines)
    _reject(rows.filter("repair = 'broken'").select("line"), path, "cannot be repaired")
    audit = rows.filter("repair is not null").select(F.col("n").alias("line"), "entity_id", "repair")
    return rows.select(*FIELDS), audit


def well_formed(entity_id: Column, source: int) -> Column:
    """S{n}- in front, not padded, no comma."""
    return entity_id.startswith(f"S{source}-") & (F.trim(entity_id) == entity_id) & ~F.contains(entity_id, F.lit(","))


def read_sources(spark: SparkSession, folder: str, split: str) -> tuple[DataFrame, DataFrame]:
    """Source 1, and sources 2 and 3 together with their number."""
    tables = []
    for n in (1, 2, 3):
        path = f"{folder}/{split}_source{n}.tsv"
        rows = read_strict(spark, path)
        _reject(rows.filter(~well_formed(F.col("entity_id"), n)).select("entity_id"), path, "malformed id")
        tables.append(rows.withColumn("source", F.lit(n)))
    return tables[0], tables[1].unionByName(tables[2])


# ---------------------------------------------------------------- id lists and labels


def id_list(text: Column) -> Column:
    """The ids of a comma-joined list; none for '' (R5)."""
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, ",", -1))


def bad_id_list(text: Column) -> Column:
    """Whether a list has blank, padded or repeated ids."""
    ids = id_list(text)
    return F.exists(ids, lambda x: (x == "") | (F.trim(x) != x)) | (F.size(F.array_distinct(ids)) != F.size(ids))


def read_lists(spark: SparkSession, path: str, column: str) -> DataFrame:
    """qid, ids and place (the line's number) of a list file."""
    rows = read_strict(spark, path, (TRUTH_FIELDS[0], column), numbered=True)
    _reject(rows.filter(bad_id_list(F.col(column))).select(column), path, "bad id list")
    return rows.select(F.col(TRUTH_FIELDS[0]).alias("qid"), id_list(F.col(column)).alias("ids"), F.col("n").alias("place"))


def links_of(lists: DataFrame) -> DataFrame:
    """qid, tid of lists (qid, ids)."""
    return lists.select("qid", F.explode("ids").alias("tid")).distinct()


def read_truth(spark: SparkSession, path: str, queries: DataFrame, targets: DataFrame) -> DataFrame:
    """Labels whose queries are exactly the given ones and whose targets are known."""
    lists = read_lists(spark, path, TRUTH_FIELDS[1])
    ids = queries.select(F.col("entity_id").alias("qid"))
    _reject(lists.join(ids, "qid", "left_anti").select("qid"), path, "unknown query")
    _reject(ids.join(lists, "qid", "left_anti").select("qid"), path, "query without label")
    _reject(links_of(lists).join(targets.select(F.col("entity_id").alias("tid")), "tid", "left_anti").select("tid"), path, "unknown target")
    return lists


# ---------------------------------------------------------------- sinks


def write_lists(lists: DataFrame, queries: DataFrame, path: str, column: str) -> None:
    """One TSV of all queries in their order with sorted ids, written aside and renamed (K1).

    queries has qid and place. The file is one by contract, so its rows pass one task; they are ids only.
    """
    ids = F.array_join(F.array_sort(F.coalesce("ids", F.array().cast("array<string>"))), ",")
    rows = queries.select("qid", "place").join(lists.select("qid", "ids"), "qid", "left").select(F.lit(1).alias("part"), "place", F.concat_ws("\t", "qid", ids).alias("value"))
    head = queries.sparkSession.range(1).select(F.lit(0).alias("part"), F.lit(None).cast(dict(rows.dtypes)["place"]).alias("place"), F.lit(f"{TRUTH_FIELDS[0]}\t{column}").alias("value"))
    storage.one_file(head.unionByName(rows).orderBy("part", "place").select("value"), path)


def write_table(rows: DataFrame, path: str, order: str) -> int:
    """One TSV file with header, sorted (K9, K14); a report or a bounded sample, which passes one task. Gives the number of rows."""
    text = F.concat_ws("\t", *(F.regexp_replace(F.coalesce(F.col(c).cast("string"), F.lit("")), "[\t\r\n]", " ") for c in rows.columns))
    body = rows.select(F.lit(1).alias("part"), F.col(order).alias("o"), text.alias("value"))
    head = rows.sparkSession.range(1).select(F.lit(0).alias("part"), F.lit(None).cast(dict(body.dtypes)["o"]).alias("o"), F.lit("\t".join(rows.columns)).alias("value"))
    storage.one_file(head.unionByName(body).orderBy("part", "o", "value").select("value"), path)
    return rows.count()


def write_tsv(rows: DataFrame, path: str, by: str | None = None) -> None:
    """A folder of TSV files with header, one subfolder per value of by."""
    writer = rows.write.mode("overwrite").option("header", True).option("sep", "\t").option("emptyValue", "").option("quote", "\u0000")
    (writer.partitionBy(by) if by else writer).csv(path)


# ---------------------------------------------------------------- fixture

# The names of the example.
NAMES = ("Orchid", "Maple", "Falcon", "Cedar", "Lotus", "Amber", "River", "Coral", "Silver", "Olive", "Banyan", "Pearl")


def fixture(spark: SparkSession, split: str = "train", n: int = 12) -> dict[str, DataFrame]:
    """The synthetic three-source example: every fourth record has no match."""
    base = spark.range(n).select(F.col("id").cast("int").alias("i"))
    name = F.get(F.array(*map(F.lit, NAMES)), F.pmod("i", F.lit(len(NAMES))))
    country = F.lit("France") if split == "test" else F.when(F.col("i") % 2 == 1, "India").otherwise("US")
    base = base.select("i", name.alias("name"), country.alias("country"), (F.col("i") % 4 == 0).alias("alone"))
    three = F.lpad(F.col("i").cast("string"), 3, "0")
    address = F.concat((F.col("i") + 10).cast("string"), F.lit(" "), "name", F.lit(" Road"))

    def rows(source: int, name: Column, address: Column) -> DataFrame:
        lone_name, lone_address = F.concat(F.lit("Unrelated "), "i", F.lit(" Bakery")), F.concat((F.col("i") + 900).cast("string"), F.lit(" Market Lane"))
        other = F.col("alone") if source > 1 else F.lit(False)
        return base.select(F.concat(F.lit(f"S{source}-"), three).alias("entity_id"), F.when(other, lone_name).otherwise(name).alias("business_name"), F.when(other, lone_address).otherwise(address).alias("business_address"), "country")

    books = F.concat("name", F.lit(" Books"))
    out = {"source1": rows(1, books, address), "source2": rows(2, books, address), "source3": rows(3, F.concat("name", F.lit(" books ltd")), F.replace(address, F.lit("Road"), F.lit("Rd")))}
    matched = F.when(F.col("alone"), "").otherwise(F.concat(F.lit("S2-"), three, F.lit(",S3-"), three))
    if split == "train":
        out["ground_truth"] = base.select(F.concat(F.lit("S1-"), three).alias(TRUTH_FIELDS[0]), matched.alias(TRUTH_FIELDS[1]))
    return out


def write_fixture(spark: SparkSession, folder: str, split: str = "train", n: int = 12) -> None:
    """The fixture as TSV files; a handful of rows."""
    for name, df in fixture(spark, split, n).items():
        lines = ["\t".join(df.columns), *("\t".join(r) for r in df.orderBy(df.columns[0]).collect())]
        storage.write(f"{folder}/{split}_{name}.tsv", [("\n".join(lines) + "\n").encode()])
