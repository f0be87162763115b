"""The work of a search: equal texts once, n-grams by distinct word, scores by matrices and lists."""

from collections import Counter

import numpy as np
import pytest
from test_retrieval import brute_tfidf, corpus, grams, result, same

from linkloom.functions.terms import Places, Points, gram_counts, summed
from linkloom.operators import retrieval as rt


@pytest.mark.parametrize("low,high", [(3, 5), (2, 5), (4, 6)])
def test_gram_counts_are_those_of_all_windows(low, high):
    texts = ["abc de abc", "", "a  bb ", "é", "x" * 20, "a a a", " ", "abc"]
    row, term, n = gram_counts(texts, low, high)
    every = Counter(zip(*(x.tolist() for x in Points(texts).grams(low, high)), strict=True))
    assert dict(zip(zip(row.tolist(), term.tolist(), strict=True), n.tolist(), strict=True)) == every
    assert [sorted(n[row == k].tolist()) for k in range(len(texts))] == [sorted(Counter(grams(x, low, high)).values()) for x in texts]
    known = np.unique(term)[::2]
    r, at, m = gram_counts(texts, low, high, Places(known))
    assert {(a, int(known[b])): c for a, b, c in zip(r.tolist(), at.tolist(), m.tolist(), strict=True)} == {k: c for k, c in every.items() if k[1] in set(known.tolist())}


def test_places_and_sums():
    terms = np.unique(np.random.default_rng(1).integers(0, 1 << 63, 1000).astype(np.uint64) * np.uint64(2))
    at, has = Places(terms).of(np.concatenate([terms, terms + np.uint64(1), np.array([0, 2**64 - 1], np.uint64)]))
    assert (at[: len(terms)] == np.arange(len(terms))).all() and has[: len(terms)].all() and not has[len(terms) :].any()
    for big in (1, 1 << 20):
        assert [x.tolist() for x in summed(np.array([5, 3, 5]), np.array([1, 2, big]))] == [[3, 5], [2, 1 + big]]


def test_equal_texts_are_searched_once(spark):
    """2,000 queries and 6,000 targets of 12 texts: only the texts' best rows leave the tasks."""
    t = spark.range(6000).selectExpr("id AS rid", "concat('common word', id % 12) AS text", "2 AS row_size").repartition(4)
    q = t.filter("rid % 3 = 0").selectExpr("rid AS qid", "text")
    found = rt.channels(q, t.drop("row_size"), ["text"], 5)
    files = [f for f in found.inputFiles() if "best" in f]
    assert files and spark.read.parquet(*files).count() <= 2 * 12 * 5 * 4
    rows = found.filter("channel = 'tfidf_text'").groupBy("qid").agg({"rid": "max", "rank": "max"}).collect()
    assert len(rows) == 2000 and all(r["max(rid)"] == r.qid % 12 + 48 and r["max(rank)"] == 5 for r in rows)


def test_lists_matrices_and_word_order(spark, monkeypatch):
    texts = [x.replace("  ", " ") for x in corpus(120, 3)]
    targets = [(i, x) for i, x in enumerate(texts)] + [(500 + i, " ".join(reversed(x.split()))) for i, x in enumerate(texts)]
    queries = [(i, texts[i]) for i in range(0, 120, 5)]
    q, t = spark.createDataFrame(queries, "qid bigint, text string"), spark.createDataFrame(targets, "rid bigint, text string").repartition(3)
    for share in (0.0, 0.1, 2.0):
        monkeypatch.setattr(rt, "DENSE_SHARE", share)
        same(result(rt.tfidf_topk(q, t, 7)), {k: [(r, -s) for r, s in v] for k, v in brute_tfidf(queries, targets, 7).items()})


def test_fields_with_the_same_texts_share_a_channel(spark):
    rows = spark.createDataFrame([(i, f"word{i % 7} and {i}", f"word{i % 7} and {i}", f"other {i}") for i in range(60)], "rid bigint, a string, b string, c string")
    q = rows.filter("rid % 4 = 0").withColumnRenamed("rid", "qid")
    assert rt.alike([q, rows], ["a", "b", "c"]) == {"a": "a", "b": "a", "c": "c"}
    found = {c: sorted(map(tuple, r)) for c, r in rt.channels(q, rows, ["a", "b", "c"], 4).groupBy("channel").agg({"*": "count"}).rdd.map(lambda r: (r[0], [(r[1],)])).collect()}
    assert found.keys() == {f"{k}_{f}" for k in ("tfidf", "bm25") for f in "abc"}
    lists = rt.channels(q, rows, ["a", "b", "c"], 4)
    for kind in ("tfidf", "bm25"):
        one, two = (sorted(map(tuple, lists.filter(lists.channel == f"{kind}_{f}").drop("channel").collect())) for f in "ab")
        assert one == two and one


def test_features_of_equal_fields_are_made_once(spark):
    """A plan with two text fields has half the Python steps, with the same values."""
    from pyspark.sql import functions as F

    from linkloom.functions import text as t
    from linkloom.operators import features as feat

    def found(name):
        rows = spark.createDataFrame([(i, name.format(i % 5), f"{i} Main Street 1234{i % 3}", "DE") for i in range(20)], "id bigint, name string, address string, country string")
        rows = rows.withColumns(t.normalized_record(F.col("name"), F.col("address"), F.col("country")))
        pairs = spark.createDataFrame([(i, (3 * i) % 20, {"tfidf_name": 0.5}) for i in range(20)], "qid bigint, rid bigint, scores map<string,double>")
        return feat.pair_features(pairs, rows.withColumnRenamed("id", "qid"), rows.withColumnRenamed("id", "rid"))

    plain, marked = found("Alpha Beta {}"), found("Alphä Beta {}")
    steps = [df._jdf.queryExecution().executedPlan().toString().count("outside_sql(") for df in (plain, marked)]
    assert 0 < steps[0] < steps[1]
    for r in plain.collect():
        for x in (*feat.STATISTICS, "char_cosine", "word_cosine"):
            assert r[f"tname_{x}"] == r[f"name_{x}"] and r[f"taddress_{x}"] == r[f"address_{x}"]
    columns = [c for c in feat.FEATURE_NAMES if c.startswith(("tname", "taddress"))]
    assert sorted(map(tuple, plain.select("qid", *columns).collect())) == sorted(map(tuple, marked.select("qid", *columns).collect()))


def test_a_mode_searches_its_own_channels(spark, sf_dir, monkeypatch):
    from linkloom.plans import queries as q

    searched, old = [], rt.search
    monkeypatch.setattr(rt, "search", lambda queries, targets, channels, *more, **named: searched.extend(c.name for c in channels) or old(queries, targets, channels, *more, **named))
    assert q.rrf_mode_subset(spark, sf_dir).count() > 0
    assert sorted(searched) == ["tfidf_address", "tfidf_name"]


@pytest.mark.parametrize(("name", "expected"), [("attribution", ("multiple_families", 3)), ("recall_at_k", (8, 1.0, 1.0, 0.666667, 1.0, 1.0, 1.0, 1.0)), ("cap_decision", ("select_k20",))])
def test_queries_without_links_are_not_searched_for(spark, tmp_path, monkeypatch, name, expected):
    """Of the eight queries, 5 and 25 have an equal text among the targets; all eight are counted."""
    from linkloom.plans import queries as q

    like = {51: 5, 52: 5, 53: 25}
    rows = [(k, f"name {like.get(k, k)}\nbody common {like.get(k, k) % 7}", "en", "src0", 20) for k in (*range(1, 41), *like)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{tmp_path}/documents.parquet")
    searched, old = [], rt.search
    monkeypatch.setattr(rt, "search", lambda queries, *more, **named: searched.append(sorted(r.qid for r in queries.select("qid").collect())) or old(queries, *more, **named))
    assert [tuple(r) for r in q.QUERIES[name](spark, str(tmp_path)).collect()] == [expected]
    assert searched == [[5, 25]]


def test_texts_of_several_fields_are_taken_apart_once(spark, monkeypatch):
    """Vocabularies are each field's own, though equal texts of two fields are counted together."""
    taken, old = [], rt.Analyzer.counts
    monkeypatch.setattr(rt.Analyzer, "counts", lambda self, texts, known=None: taken.extend(texts) or old(self, texts, known))
    monkeypatch.setattr(rt, "spread", lambda df: Rows(df))

    class Rows:
        """Counts in this process, as a task does."""

        def __init__(self, df):
            self.df = df

        def mapInArrow(self, run, schema):  # noqa: N802
            return self.df.sparkSession.createDataFrame([r for b in run(iter(self.df.coalesce(1).toArrow().to_batches())) for r in map(lambda x: tuple(x.values()), b.to_pylist())], schema)

    rows = spark.createDataFrame([("alpha beta", "alpha beta"), ("alpha beta", "alpha gamma"), ("gamma delta", "gamma delta"), (None, "beta")], "a string, b string")
    found = rt.vocabularies(rows, {"x": ("a", rt.WORD), "y": ("b", rt.WORD)})
    assert Counter(taken) == {"alpha beta": 1, "alpha gamma": 1, "gamma delta": 1, "beta": 1, "": 1}
    for name, dfs in (("x", [2, 2, 1, 1]), ("y", [2, 2, 2, 1])):
        words = Points(["alpha beta gamma delta"]).words("LN_")[1]
        v = found[name]
        assert np.allclose(v.idf[v.places.of(words)[0]], np.log(5 / (1 + np.array(dfs))) + 1) and len(v.terms) == 4


def test_equal_vectors_are_multiplied_once():
    """Texts with the same entries are one row with their k smallest ids; others keep their own."""
    entries = {0: [(1, 0.5), (2, 1.0)], 1: [(1, 0.5), (2, 1.0)], 2: [(1, 0.5)], 3: [(1, 0.5), (2, 1.0)], 5: [(1, 0.5), (2, 2.0)], 6: [(1, 0.5)], 7: [(1, 0.5)]}
    row, term, w = (np.array(x) for x in zip(*((r, t, v) for r, e in entries.items() for t, v in e), strict=True))
    begin, number, ids = np.array([0, 2, 3, 4, 6, 7, 8, 9]), np.array([2, 1, 1, 2, 1, 1, 1, 1]), np.array([7, 9, 1, 4, 2, 8, 3, 5, 6, 0])
    vectors, begin, number, ids = rt._grouped((row, term, w), begin, number, ids, 3)
    lists = {tuple(zip(vectors[1][vectors[0] == k].tolist(), vectors[2][vectors[0] == k].tolist(), strict=True)): ids[begin[k] : begin[k] + number[k]].tolist() for k in np.unique(vectors[0])}
    # Row 4 has no entry and is in no list.
    assert lists == {((1, 0.5), (2, 1.0)): [1, 2, 7], ((1, 0.5),): [0, 4, 6], ((1, 0.5), (2, 2.0)): [5]}


def test_bm25_multiplies_what_queries_ask_for(spark, monkeypatch):
    """6,000 targets with words of their own differ for no query."""
    rows, old = [], rt._product
    monkeypatch.setattr(rt, "_product", lambda block, dense, row, term, w, n: rows.append(n) or old(block, dense, row, term, w, n))
    block = rt.Block(rt.Channel("bm25_text", "text", "bm25"), ["a"], [np.array([3, 5], np.uint64)], [np.ones(2)])
    block.set_weights(np.array([1.0, 2.0]))
    block.set_shares(np.array([0.5, 0.5]))
    best, n = rt.Best(1, 4), 6000
    vectors = np.arange(n), np.arange(n) % 2, np.ones(n)
    rt._offer(block, block.dense(), vectors, n, best, np.arange(n), np.ones(n, np.int64), np.arange(n)[::-1].copy())
    best.settle()
    assert sum(rows) == 2 and best.target.tolist() == [0, 2, 4, 6] and best.score.tolist() == [2.0] * 4


def test_repeated_query_ids_have_one_list(spark):
    t = spark.createDataFrame([(i, f"common word{i % 9}") for i in range(90)], "rid bigint, text string")
    q = spark.createDataFrame([(1, "common word1"), (1, "common word2"), (2, "common word3")], "qid bigint, text string")
    found = rt.tfidf_topk(q, t, 6).orderBy("qid", "rank").collect()
    assert [r["rank"] for r in found] == [*range(1, 7), *range(1, 7)]
    assert [r.rid for r in found if r.qid == 1] == [1, 2, 10, 11, 19, 20] and [r.rid for r in found if r.qid == 2] == [3, 12, 21, 30, 39, 48]
    # Without repeated ids no row a query and target is ranked again.
    once = rt.tfidf_topk(q.filter("text <> 'common word2'"), t, 6)
    assert "Window" not in once._jdf.queryExecution().executedPlan().toString()


def test_equal_texts_are_taken_apart_once(spark):
    """Vocabularies and query vectors of 4,000 rows of 8 texts, with the numbers of all rows."""
    tally = rt._Tally()
    tally.add(np.array([5, 7, 5], np.uint64), np.array([2, 1, 1]), np.array([3, 3, 4]))
    assert [x.tolist() for x in tally.taken()] == [[5, 7], [7, 3], [10, 3]]
    rows = spark.range(4000).selectExpr("id AS qid", "concat('common word', id % 8) AS text").coalesce(1)
    v = rt.vocabularies(rows, {"x": ("text", rt.CHAR)})["x"]
    assert np.isclose(v.idf.min(), 1) and np.isclose(v.idf.max(), np.log(4001 / 501) + 1)
    vectors = rt._query_vectors(rows, [rt.Channel("x", "text", "tfidf")], {"x": v})
    assert vectors.count() == 4000 and vectors.select("terms", "weights").distinct().count() == 8
    assert vectors.selectExpr("count(distinct qid % 8, md5(terms))").first()[0] == 8


def test_long_texts_are_multiplied_in_tiles_of_like_texts(monkeypatch):
    """Three languages share one word in fifty: tiles give the lists that whole vectors give, and few terms are dense between two languages."""
    rng = np.random.default_rng(5)
    said = lambda n: {(k, t): float(v) for k in range(n) for t, v in zip(np.where(rng.random(150) < 0.02, rng.integers(9000, 9050, 150), k % 3 * 3000 + rng.integers(0, 600, 150)), rng.random(150) + 0.1, strict=True)}
    queries, texts = said(90), said(240)
    entries = lambda x: tuple(np.array(c) for c in zip(*((k, t, v) for (k, t), v in sorted(x.items())), strict=True))
    row, term, w = entries(queries)
    monkeypatch.setattr(rt, "TILE", 40)
    block = rt.Block(rt.Channel("tfidf_text", "text", "tfidf"), [f"q{k}" for k in range(90)], [term[row == k].astype(np.uint64) for k in range(90)], [w[row == k] for k in range(90)])
    row, term, w = entries(texts)
    at, known = block.places.of(term.astype(np.uint64))
    block.set_shares(np.bincount(at[known], minlength=len(block.terms)) / 240)
    assert sorted(x for part in block.parts for x in part.ids) == sorted(f"q{k}" for k in range(90))
    assert all(len(part.ids) <= 40 for part in block.parts) and sum(len({int(x[1:]) % 3 for x in part.ids}) == 1 for part in block.parts) >= len(block.parts) - 2 > 0
    bests, dense, old = [rt.Best(len(part.ids), 7) for part in block.parts], [], rt._add_lists
    monkeypatch.setattr(rt, "_add_lists", lambda part, sizes, scores, row, term, w: dense.append(scores.size) or old(part, sizes, scores, row, term, w))
    rt._offer_tiles(block, (row[known], at[known], w[known]), bests, np.arange(240), np.ones(240, np.int64), np.arange(240))
    assert len(dense) >= 2 * len(block.parts) and max(dense) <= 40 * 40
    for part, best in zip(block.parts, bests, strict=True):
        best.settle()
        for k, name in enumerate(part.ids):
            scores = {r: round(sum(v * queries.get((int(name[1:]), t), 0.0) for (x, t), v in texts.items() if x == r), 6) for r in range(int(name[1:]) % 3, 240, 3)}
            want = sorted(scores.items(), key=lambda x: (-x[1], x[0]))[:7]
            own = best.query == k
            assert best.target[own].tolist() == [r for r, _ in want] and best.score[own].tolist() == pytest.approx([s for _, s in want], abs=2e-6)


def test_most_of_many_equal_scores_are_not_sorted():
    best = rt.Best(1, 4)
    for first in range(0, 6000, 10):
        best.add(np.zeros(10, np.int64), np.ones(10), np.arange(first, first + 10))
    assert best.pending == 0 and best.target.tolist() == [0, 1, 2, 3]
    best.add(np.zeros(2, np.int64), np.array([1.0, 2.0]), np.array([-1, 9000]))
    best.settle()
    assert best.target.tolist() == [9000, -1, 0, 1]


def test_a_search_of_names_writes_no_addresses(spark, sf_dir):
    from linkloom.plans import queries as q

    queries, targets = q.search_sides(spark, sf_dir, ("name",))
    assert queries.columns == ["qid", "name"] and targets.columns == ["rid", "name"]
    assert targets.count() == q.read(spark, sf_dir, "documents").count()
    assert q.search_sides(spark, sf_dir)[1].columns == ["rid", "name", "address"]
