"""The queries of this subpackage: one per operator, over whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import oracles
from ._common import read
from .exact_dedup import exact_groups
from .html_extract import extract
from .language_id import languages
from .minhash_dedup import near_groups
from .piece_codec import encode_decode
from .quality_classifier import quality_scores
from .quality_rules import quality_verdicts
from .source_mixing import mixture
from .tool_linking import linked_turns
from .warc_bundles import round_trip


def piece_model() -> str:
    """The place of the public tokenizer's file; the operator takes any path."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(read(spark, sf_dir, "documents"))


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(read(spark, sf_dir, "pages"))


def op4_warc_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(read(spark, sf_dir, "pages"))


def op5_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(read(spark, sf_dir, "documents"))


def op6_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_decode(read(spark, sf_dir, "documents"), piece_model(), results=("n_tokens", "ids_sha256", "decoded_sha256"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languages(read(spark, sf_dir, "documents")).drop("spans")


def op8_tool_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linked_turns(read(spark, sf_dir, "conversations")).selectExpr("conv_id", "position", "kind", "call_id", "seq", "link", "cyclic", "array_join(errors, ',') AS errors", "json", "repeats")


def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture(read(spark, sf_dir, "documents"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    verdicts = quality_verdicts(read(spark, sf_dir, "documents"))
    return verdicts.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


OPERATORS = (op1_quality_classifier, op2_exact_dedup, op3_html_extraction, op4_warc_bundles, op5_minhash_dedup, op6_piece_codec, op7_language_id, op8_tool_linking, op9_source_mixing, op10_quality_rules)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in OPERATORS}


def oracle_sql() -> dict[str, str]:
    return oracles.SQL
