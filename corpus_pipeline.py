"""A corpus pipeline of five stages over the table documents, each written as Parquet and read again.

The stages, in order: quality rules, exact dedup, MinHash near-dedup, mixing of sources to target weights, and
encoding. All but the last return the columns that they get; the last one gives each row's ids, ready to train
on, with its language, source, token count and digests, instead of its text.

Defined cases, as the stages' operators have them: a null or blank text fails the quality rules and goes. Rows
are judged by the rules each on its own, also those that share a doc_id. Of equal texts the smallest doc_id stays;
repeated rows of one doc_id and text stay together through the dedup stages, and a row without doc_id passes
both. The mixture takes rows with one doc_id, language and source as often as each other, up to MIX_EPOCHS times.
Very long texts pass every stage whole. Columns of any other name are kept up to the last stage. An empty table
gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from linkloom.llm._common import read, stage
from linkloom.llm.exact_dedup import exact_dedup
from linkloom.llm.minhash_dedup import near_dedup
from linkloom.llm.piece_codec import encode_decode
from linkloom.llm.quality_rules import quality_filter
from linkloom.llm.queries import piece_model
from linkloom.llm.source_mixing import MAX_EPOCHS as MIX_EPOCHS
from linkloom.llm.source_mixing import SHARE as MIX_SHARE
from linkloom.llm.source_mixing import mixed


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_filter(docs)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed(docs, share=MIX_SHARE, max_epochs=MIX_EPOCHS)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return encode_decode(docs, piece_model(), results=("n_tokens", "ids", "ids_sha256", "decoded_sha256"), keep=("lang", "source"))


STAGES = [
    ("quality rules", quality_rules),
    ("exact dedup", drop_exact_copies),
    ("near dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("sentencepiece", encode_pieces),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)


#: MinHash and SentencePiece have no SQL form; the tests hold the rows against a brute-force version.
ORACLE_SQL = None
