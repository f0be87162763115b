"""What the operators share: tables in the shared folder, joins with a small side, id-based dropping."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space as the contracts define it, for Java's and DuckDB's regular expressions.
WHITE = r"[\x20\x09-\x0D]+"

#: A table of at most so many rows may be broadcast. Its rows are a few numbers, so this is some tens of MB.
BROADCAST_ROWS = 250_000


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; in local mode, where it is unset, a temporary one is set."""
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir") or context._jsc.sc().getCheckpointDir().getOrElse(None)
    if folder is None:
        if not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="linkloom-")
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


def shared_path(spark: SparkSession, tag: str) -> str:
    """A new path in the shared folder, deleted when the application ends."""
    path = f"{shared_folder(spark)}/linkloom/{spark.sparkContext.applicationId}/{tag}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(at)
    return path


def stage(df: DataFrame, tag: str) -> DataFrame:
    """Writes df as Parquet to the shared folder and reads it: its lineage ends, and a lost executor costs nothing."""
    spark = df.sparkSession
    path = shared_path(spark, tag)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_side(staged: DataFrame, bound: int = BROADCAST_ROWS) -> DataFrame:
    """Marks a staged table for broadcast if its counted rows are within bound; beyond it the join shuffles."""
    return F.broadcast(staged) if staged.count() <= bound else staged


def drop_ids(docs: DataFrame, ids: DataFrame, key: str = "doc_id") -> DataFrame:
    """Rows of docs whose key is not in ids (one column named key); a null key is never dropped."""
    return docs.join(small_side(stage(ids.distinct(), "dropped")), key, "left_anti")


def fresh(df: DataFrame, name: str) -> str:
    """A column name that df does not have."""
    while name in df.columns:
        name += "_"
    return name


def row_key(*values: Column) -> Column:
    """128 bits that stand for some values; null is a value of its own."""
    apart = [x for v in values for x in (v.isNull(), F.coalesce(v.cast("string"), F.lit("")))]
    return F.struct(F.xxhash64(*apart).alias("h1"), F.xxhash64(F.lit(1), *apart).alias("h2"))


def drop_rows(docs: DataFrame, key: Column, keys: DataFrame) -> DataFrame:
    """Rows of docs whose row_key is not in keys (one column, key)."""
    name = fresh(docs, "key")
    keys = small_side(stage(keys.distinct().withColumnRenamed("key", name), "dropped"))
    return docs.withColumn(name, key).join(keys, name, "left_anti").drop(name)


def joined_by_key(many: DataFrame, one: DataFrame, key: str, hot: DataFrame, row: str) -> DataFrame:
    """The inner join of two sides; a key of hot (key, parts) is parts tasks' work: many is dealt by row, one is repeated."""
    hot = stage(hot, "hot-keys")
    if not hot.limit(1).count():
        return many.join(one, key)
    hot = small_side(hot)
    parts = F.coalesce(F.col("parts"), F.lit(1)).cast("long")
    left = many.join(hot, key, "left").withColumn("part", F.pmod(F.xxhash64(row), parts)).drop("parts")
    right = one.join(hot, key, "left").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1))).drop("parts")
    return left.join(right, [key, "part"]).drop("part")


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")
