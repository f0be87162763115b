"""Connected components of the label graph, hash samples and grouped splits."""

from __future__ import annotations

import hashlib
import math

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType
from pyspark.sql.window import Window

from ..sources.staging import stage


def components(links: DataFrame) -> DataFrame:
    """links (qid, tid): (qid, component), the smallest qid reachable over shared targets (G1).

    Labels move to targets and back, then jump to their label's label, until none changes; each round is
    written to the shared folder, so neither lineage nor driver memory grows. A bipartite graph needs no
    second copy of its edges.
    """
    links = stage(links.select("qid", "tid").distinct(), "links")
    labels = stage(links.select("qid", F.col("qid").alias("component"), F.lit(True).alias("moved")).distinct(), "labels")
    while labels.filter("moved").limit(1).count():
        at_target = links.join(labels, "qid").groupBy("tid").agg(F.min("component").alias("near"))
        near = links.join(at_target, "tid").groupBy("qid").agg(F.min("near").alias("near"))
        step = labels.join(near, "qid").select("qid", F.col("component").alias("was"), F.least("component", "near").alias("via"))
        jump = labels.select(F.col("qid").alias("via"), F.col("component").alias("far"))
        step = step.join(jump, "via").select("qid", F.least("via", "far").alias("component"), (F.least("via", "far") < F.col("was")).alias("moved"))
        labels = stage(step, "labels")
    return labels.select("qid", "component")


def components_of(links: DataFrame, queries: DataFrame, whole_graph: bool = True) -> DataFrame:
    """Components of the given queries (qid), over all links or only their own (G2); one without links is its own."""
    used = links if whole_graph else links.join(queries.select("qid"), "qid", "left_semi")
    found = queries.select("qid").join(components(used), "qid", "left")
    return found.select("qid", F.coalesce("component", "qid").alias("component"))


# ---------------------------------------------------------------- sampling


@F.pandas_udf(DecimalType(20, 0))
def _blake_key(text: pd.Series) -> pd.Series:
    from decimal import Decimal

    return text.map(lambda x: Decimal(int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "big")))


def sample_key(entity_id: Column, seed: int | str, exact: bool = False) -> Column:
    """A seeded order of ids: SHA-256 in the JVM, or exactly the 64-bit BLAKE2b key."""
    text = F.concat(F.lit(f"{seed}:"), entity_id.cast("string"))
    return _blake_key(text) if exact else F.sha2(text, 256)


def hash_sample(rows: DataFrame, id_col: str, n: int, seed: int = 42, exact: bool = False) -> DataFrame:
    """The n rows with the smallest keys; a bounded heap per task, then one merge (Q1)."""
    key = sample_key(F.col(id_col), seed, exact)
    return rows.withColumn("sample_key", key).orderBy("sample_key", id_col).limit(n).drop("sample_key")


def label_complete_sample(targets: DataFrame, links: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """All linked targets (tid, source) and n sampled others of each source, seeded by seed + source (Q2).

    A bounded heap per task and source; a handful of sources is expected.
    """
    positives = targets.join(links.select("tid").distinct(), "tid", "left_semi").withColumn("role", F.lit("positive"))
    rest = targets.join(links.select("tid").distinct(), "tid", "left_anti")
    seeded = F.sha2(F.concat((F.col("source") + seed).cast("string"), F.lit(":"), F.col("tid").cast("string")), 256)
    rest = stage(rest.withColumn("sample_key", seeded), "sample-keys")
    out = positives
    for row in rest.select("source").distinct().orderBy("source").collect():  # the sources of the data model
        chosen = rest.filter(F.col("source") == row.source).orderBy("sample_key", "tid").limit(n)
        out = out.unionByName(chosen.drop("sample_key").withColumn("role", F.lit("distractor")))
    return out


def missing_positives(targets: DataFrame, links: DataFrame) -> DataFrame:
    """Linked ids that the targets lack; a label-complete sample must have none."""
    return links.select("tid").distinct().join(targets.select("tid"), "tid", "left_anti")


# ---------------------------------------------------------------- splits


MIN_GROUPS = 5


def grouped_split(groups: DataFrame, seed: int = 42, holdout: float = 0.4) -> DataFrame:
    """groups (qid, component): train, calibration and holdout, 60/20/20 of the components, none divided (M1).

    Components are ranked by a hash, so the shares are exact: the rest takes the ceiling of its share, and so
    does the holdout of the rest. The rank is the sum of cells of leading hash digits and a place within the
    cell, so no task sorts all components.
    """
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("component").cast("string")), 256)
    distinct = stage(groups.select("component").distinct().withColumn("key", key).withColumn("cell", F.substring("key", 1, 4)), "split-groups")
    cells = stage(distinct.groupBy("cell").agg(F.count(F.lit(1)).alias("c")), "split-cells")
    total = cells.agg(F.sum("c")).first()[0] or 0
    if total < MIN_GROUPS:
        raise ValueError(f"at least {MIN_GROUPS} groups are needed, there are {total}")
    rest = math.ceil(round(total * holdout, 9))
    held = math.ceil(rest / 2)
    # At most 65,536 cells.
    before = cells.withColumn("before", F.coalesce(F.sum("c").over(Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    place = F.col("before") + F.row_number().over(Window.partitionBy("cell").orderBy("key", "component"))
    ranked = distinct.join(F.broadcast(before), "cell").withColumn("place", place)
    split = F.when(F.col("place") <= total - rest, "train").when(F.col("place") <= total - held, "calibration").otherwise("holdout")
    return groups.join(ranked.select("component", split.alias("split")), "component").select("qid", "component", "split")


def folds(groups: DataFrame, k: int = 5, seed: int = 42) -> DataFrame:
    """The fold of each query, by its component (M2)."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("component").cast("string")), 256)
    return groups.withColumn("fold", F.pmod(F.conv(F.substring(key, 1, 8), 16, 10).cast("long"), F.lit(k)).cast("int"))
