"""Exact dedup by progressive refinement: length, then a prefix hash, then the full hash.

Only ids, lengths and hashes are shuffled, never texts. A text whose length no other text has leaves
after the first step, one whose prefix no other has after the second; only groups that survive both are
grouped by their full SHA-256. The filter, `exact_dedup`, reads and hashes whole texts of these groups only.
`exact_groups` gives the full hash of every row, so it computes all of them in its first scan, and there the
first two steps only keep rows out of the grouping. Every count is combined before its shuffle, so a group
that holds a third of all rows arrives as one row per task, and the joins back have the hot key on one side
only, where adaptive execution can split it.

Defined cases: a null text counts as empty, and all empty texts are copies of each other. Repeated rows
with one doc_id and one text are the same document and get the same verdict; rows with one doc_id and different
texts get their own. A row without doc_id keeps only if its whole group has no doc_id; the filter never drops
such a row. A very long text is hashed as a whole by its own task. Other columns of the input are never read.
An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import WHITE, drop_rows, row_key, small_side, stage

PREFIX_CHARS = 64


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), WHITE, " ")


def _slim(docs: DataFrame, prefix_chars: int, id_col: str, text_col: str, *more: Column) -> DataFrame:
    """doc_id, len, prefix_hash and more of each row; more may use the normalised text, norm."""
    norm = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("raw"), normalised(F.col(text_col)).alias("norm"))
    return norm.select("doc_id", F.length("norm").alias("len"), F.xxhash64(F.length("norm"), F.substring("norm", 1, prefix_chars)).alias("prefix_hash"), *more)


def _several(slim: DataFrame) -> DataFrame:
    """prefix_hash of the groups that survive length and prefix, staged."""
    several = F.col("count") > 1
    lengths = stage(slim.groupBy("len").count().filter(several).select("len"), "exact-lengths")
    by_length = slim.join(lengths, "len", "left_semi")
    return stage(by_length.groupBy("prefix_hash").count().filter(several).select("prefix_hash"), "exact-prefixes")


def _same(rows: DataFrame) -> DataFrame:
    """full_hash, first_id and size of the groups of several rows."""
    groups = rows.groupBy("full_hash").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("size"))
    return stage(groups.filter("size > 1"), "exact-groups")


def _full() -> Column:
    return F.unhex(F.sha2("norm", 256)).alias("full_hash")


def exact_groups(docs: DataFrame, prefix_chars: int = PREFIX_CHARS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, keep_id, group_size, kept, text_sha256."""
    slim = stage(_slim(docs, prefix_chars, id_col, text_col, _full()), "exact-slim")
    groups = _same(slim.join(_several(slim), "prefix_hash", "left_semi"))
    keep = F.when(F.col("size").isNull(), F.col("doc_id")).otherwise(F.col("first_id"))
    return slim.join(groups, "full_hash", "left").select(
        "doc_id",
        keep.alias("keep_id"),
        F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"),
        F.lower(F.hex("full_hash")).alias("text_sha256"),
    )


def exact_dedup(docs: DataFrame, prefix_chars: int = PREFIX_CHARS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that stay, with all their columns."""
    several = _several(stage(_slim(docs, prefix_chars, id_col, text_col), "exact-slim"))
    # The second scan: the prefix tells whose full text is hashed.
    own = row_key(F.col("doc_id"), F.col("raw")).alias("key")
    slim = _slim(docs, prefix_chars, id_col, text_col, F.col("norm"), own).join(small_side(several), "prefix_hash", "left_semi")
    slim = stage(slim.select("doc_id", "key", _full()), "exact-full")
    drop = slim.join(_same(slim), "full_hash").filter(F.col("doc_id").isNotNull() & (F.col("doc_id") != F.col("first_id")))
    return drop_rows(docs, row_key(F.col(id_col), F.col(text_col)), drop.select("key"))
