"""Small tables with the awkward rows that every operator must stand."""

LONG = " ".join(f"word{i % 4999}" for i in range(30_000))

#: Nulls in every column, empty and blank texts, a very long text, repeated rows and ties.
ODD_ROWS = [
    (1, "alpha beta gamma delta epsilon zeta", "en", "src0"),
    (2, "alpha  beta\tgamma delta\nepsilon zeta", "en", "src0"),
    (3, None, "en", "src1"),
    (4, "", None, None),
    (5, " \t\n", "de", "src1"),
    (6, LONG, "en", "src2"),
    (7, "alpha beta gamma delta epsilon zeta", "fr", "src2"),
    (7, "alpha beta gamma delta epsilon zeta", "fr", "src2"),
    (8, "ein Wort", None, "src3"),
    (None, "alpha beta gamma delta epsilon zeta", "en", "src0"),
    (9, "İstanbul ß ▁ \x00 日本語 🙂 $$$ ###", "es", "src3"),
]
SCHEMA = "doc_id bigint, text string, lang string, source string"


def odd_docs(spark):
    """ODD_ROWS with columns whose names operators use inside."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(ODD_ROWS, SCHEMA).withColumn("n_chars", F.length("text"))
    for name in ("w", "n", "count", "size", "kept", "component", "hub", "tok", "score", "rest", "cell", "leaf", "host", "payload", "ids"):
        df = df.withColumn(name, F.lit("clash"))
    return df


def no_docs(spark):
    return odd_docs(spark).limit(0)


def rows(df, *columns):
    key = lambda r: tuple((x is not None, str(x)) for x in r)
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=key)
