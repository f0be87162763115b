"""Queries against their SQL, on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as driver

QUICK = ("bm25_topk", "tfidf_word_topk", "exact_list_output", "clean_text", "token_mapping", "suffix_strip", "repair_rows", "id_list_validate", "integrity_status", "distribution_disc", "token_top30", "truth_cardinality", "components", "grouped_split", "levenshtein_sim", "token_set_features", "numeric_features", "embedding_cosine_topk")


def test_every_sql_has_a_query():
    assert set(driver.oracle_sql()) <= set(driver.queries())


def plain(rows):
    return sorted(tuple(str(round(x, 9)) if isinstance(x, float) else str(x) for x in r) for r in rows)


@pytest.mark.parametrize("name", QUICK)
def test_query_equals_its_sql(spark, sf_dir, name):
    db = duckdb.connect()
    for f in os.listdir(sf_dir):
        db.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{sf_dir}/{f}'")
    found = driver.queries()[name](spark, sf_dir)
    columns = sorted(found.columns)
    expected = db.sql(f"SELECT {', '.join(chr(34) + c + chr(34) for c in columns)} FROM ({driver.oracle_sql()[name]})").fetchall()
    assert plain(map(tuple, found.select(*columns).collect())) == plain(expected)


def test_entry(spark):
    assert driver.entry(spark).limit(1).count() == 1
