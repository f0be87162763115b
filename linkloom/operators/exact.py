"""Exact blocking join on normalised name and country."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.staging import stage


#: Targets with one key beyond so many are split into parts of about this size.
HOT = 10_000


def split_join(queries: DataFrame, targets: DataFrame, keys: list[str], hot: int = HOT) -> DataFrame:
    """The inner join on keys, in which a key of many targets is several tasks' work: its queries meet each part."""
    many = targets.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / hot).alias("parts")).filter("parts > 1")
    many = stage(many, "hot-keys")
    many = F.broadcast(many) if many.count() <= 250_000 else many
    parts = F.coalesce(F.col("parts"), F.lit(1).cast("long"))
    left = queries.join(many, keys, "left").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1))).drop("parts")
    right = targets.join(many, keys, "left").withColumn("part", F.pmod(F.xxhash64("tid"), parts)).drop("parts")
    return left.join(right, [*keys, "part"]).drop("part")


def exact_matches(queries: DataFrame, targets: DataFrame) -> DataFrame:
    """queries (qid, name, country), targets (tid, name, country): equal names, and equal countries unless the query has none.

    Two equi-joins instead of one with an `or`, so that each can hash on all of its keys; frequent keys are split.
    """
    named, targets = queries.filter("name <> ''"), targets.filter("name <> ''")
    with_country = split_join(named.filter("country <> ''"), targets, ["name", "country"]).select("qid", "tid")
    without = split_join(named.filter("country = ''").drop("country"), targets.select("tid", "name"), ["name"]).select("qid", "tid")
    return with_country.unionByName(without)


def as_lists(queries: DataFrame, pairs: DataFrame, column: str) -> DataFrame:
    """One row per query with its sorted, comma-joined ids; '' without any."""
    lists = pairs.groupBy("qid").agg(F.array_join(F.array_sort(F.collect_set("tid")), ",").alias(column))
    return queries.select("qid").join(lists, "qid", "left").select("qid", F.coalesce(column, F.lit("")).alias(column))


def without_candidates(queries: DataFrame, pairs: DataFrame) -> DataFrame:
    """Queries that have no pair."""
    return queries.join(pairs.select("qid").distinct(), "qid", "left_anti")
