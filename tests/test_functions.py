import pytest
from pyspark.sql import functions as F

from linkloom.functions import similarity as s
from linkloom.functions import text as t


def one(spark, column, **values):
    schema = ", ".join(f"{k} string" for k in values)
    return spark.createDataFrame([tuple(values.values())], schema).select(column).first()[0]


@pytest.mark.parametrize(
    "text,expected",
    [("ＡＢＣ Straße & Co.", "abc strasse and co"), ("  a_b\tc ", "a b c"), ("", ""), ("श्री बालाजी", "श्री बालाजी"), ("Café", "café"), ("...", "")],
)
def test_clean(spark, text, expected):
    assert one(spark, t.clean(F.col("x")), x=text) == expected


@pytest.mark.parametrize("text,expected", [("Café & CO.", "cafe and co"), ("A_b", "a_b"), ("", "")])
def test_normalize_legacy(spark, text, expected):
    assert one(spark, t.normalize_legacy(F.col("x")), x=text) == expected


def test_record(spark):
    df = spark.createDataFrame([("ACME Pvt Ltd", "St Mary Rd", "IN"), ("Company", "", "")], "n string, a string, c string")
    first, second = df.select(*(v.alias(k) for k, v in t.normalized_record(F.col("n"), F.col("a"), F.col("c")).items())).collect()
    assert (first.name_norm, first.name_core, first.address_norm, first.script) == ("acme private limited", "acme", "st mary road", "LATIN")
    assert (second.name_core, second.address_norm, second.country_norm) == ("", "", "")


def test_numbers(spark):
    text = "12ab 7b 560001 9 12345 9"
    assert one(spark, t.numbers(F.col("x")), x=text) == ["560001", "9", "12345"]
    assert one(spark, t.postal_codes(F.col("x")), x=text) == ["560001", "12345"]
    assert one(spark, t.house_number(F.col("x")), x=text) == "7b"
    assert one(spark, t.numbers(F.col("x")), x="१२ 3") == ["१२", "3"]


@pytest.mark.parametrize("text,label", [("abc", "LATIN"), ("123 !", "NONE"), ("abc श्री", "DEVANAGARI+LATIN"), ("漢字 かな カナ", "HAN+HIRAGANA+KATAKANA"), ("ქართული", "OTHER"), ("Привет α", "CYRILLIC+GREEK")])
def test_scripts(spark, text, label):
    assert one(spark, t.script_label(F.col("x")), x=text) == label


def test_first_tokens(spark):
    assert one(spark, t.first_tokens(F.col("x"), 2), x="b a b c") == ["b", "a"]


def test_similarity_constants(spark):
    tokens = lambda c: t.tokens(F.col(c))
    assert one(spark, s.jaccard(tokens("a"), tokens("b")), a="a b", b="b c") == pytest.approx(1 / 3)
    assert one(spark, s.overlap_coefficient(tokens("a"), tokens("b")), a="a b", b="b") == 1
    assert one(spark, s.containment(tokens("a"), tokens("b")), a="a b", b="b") == 1
    assert one(spark, s.levenshtein_similarity(F.col("a"), F.col("b")), a="né", b="ne") == 0.5
    assert one(spark, s.prefix_similarity(F.col("a"), F.col("b")), a="abx", b="abyz") == pytest.approx(2 / 3)


@pytest.mark.parametrize("function", [s.exact, s.levenshtein_similarity, s.length_ratio, s.prefix_similarity, s.jaro, s.jaro_winkler, s.token_set, s.token_sort, s.sequence_ratio])
def test_blank_sides_are_no_evidence(spark, function):
    for a, b in (("", "x"), ("x", ""), ("", "")):
        assert one(spark, function(F.col("a"), F.col("b")), a=a, b=b) == 0


def test_measures_outside_sql():
    assert s.jaro_of("martha", "marhta") == pytest.approx(0.944444, abs=1e-6)
    assert s.jaro_winkler_of("martha", "marhta") == pytest.approx(0.961111, abs=1e-6)
    assert s.jaro_winkler_of("abcdefgh", "abzzzzzz") == pytest.approx(0.5)
    assert s.token_sort_of("a b c", "c b a") == 1 and s.token_set_of("x y", "y x z") == 1
    assert s.common_subsequence("abcbdab", "bdcaba") == 4
    assert s.indel_of("abc", "abd") == pytest.approx(2 / 3)
    assert s.sequence_of("abcd", "bcde") == 0.75
