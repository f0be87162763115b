"""Blocked retrieval against plain Python, with small blocks and in many partitions."""

import math
import random
import re
from collections import Counter

import pytest

from linkloom.functions.terms import Points, phrases
from linkloom.functions.text import without_marks
from linkloom.operators import retrieval as rt


def grams(text, low, high):
    out = []
    for w in text.split(" "):
        p = f" {w} "
        if w and len(p) < low:
            out.append(p)
        out += [p[i : i + n] for n in range(low, high + 1) for i in range(len(p) - n + 1)] if w else []
    return out


@pytest.mark.parametrize("low,high", [(3, 5), (2, 5), (4, 6), (5, 5)])
def test_gram_hashes_count_as_the_grams_do(low, high):
    texts = ["abc de", "", "a  bb ", "é", "x" * 20, "a a a", " "]
    row, h = Points(texts).grams(low, high)
    for k, x in enumerate(texts):
        assert sorted(Counter(grams(x, low, high)).values()) == sorted(Counter(h[row == k].tolist()).values()), x
    # A gram has one hash wherever it stands.
    row, h = Points(["zz", "abc"]).grams(low, high)
    assert sorted(h[row == 1].tolist()) == sorted(Points(["abc"]).grams(low, high)[1].tolist())


def test_phrases_stay_within_a_text():
    row, words = Points(["a b c", "b c", "c"]).words("LN")
    r, h = phrases(row, words, 2)
    assert r.tolist() == [0, 0, 1] and h[1] == h[2] != h[0]


def ranked(scores, k):
    return [(r, s) for s, r in sorted(((-round(s, 6), r) for r, s in scores.items() if round(s, 6) > 0))[:k]]


def brute_bm25(queries, targets, k, fold=False):
    tokens = lambda x: re.findall(r"[^\W_]+", without_marks(x) if fold else x)
    marks = lambda x: re.sub(r"[ऀ-ःऺ-ॏ]", " ", x)
    docs = {r: tokens(marks(x)) for r, x, _ in targets}
    sizes = {r: n for r, _, n in targets}
    mean, out = sum(sizes.values()) / len(sizes), {}
    times = lambda d, p: sum(d[i : i + len(p)] == p for i in range(len(d) - len(p) + 1))
    for q, x in queries:
        words = list(dict.fromkeys((without_marks(x) if fold else x).split()))[:16]
        wanted = {tuple(p) for p in (tokens(marks(w)) for w in words) if p}
        scores = Counter()
        for p in wanted:
            f = {r: times(d, list(p)) for r, d in docs.items()}
            n = sum(v > 0 for v in f.values())
            idf = max(math.log((len(docs) - n + 0.5) / (n + 0.5)), 1e-6)
            for r, v in f.items():
                if v:
                    scores[r] += idf * v * 2.2 / (v + 1.2 * (0.25 + 0.75 * sizes[r] / mean))
        out[q] = ranked(scores, k)
    return out


def brute_tfidf(queries, targets, k, low=3, high=5, sublinear=True, min_df=2):
    df = Counter(g for _, x in targets for g in set(grams(x, low, high)))
    idf = {g: math.log((1 + len(targets)) / (1 + n)) + 1 for g, n in df.items() if n >= min_df}

    def vector(x):
        v = {g: ((1 + math.log(n)) if sublinear else n) * idf[g] for g, n in Counter(grams(x, low, high)).items() if g in idf}
        norm = math.sqrt(sum(w * w for w in v.values())) or 1.0
        return {g: w / norm for g, w in v.items()}

    known = [(r, vector(x)) for r, x in targets]
    return {q: ranked({r: sum(w * b.get(g, 0.0) for g, w in vector(x).items()) for r, b in known}, k) for q, x in queries}


def corpus(n, seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(30)] + ["बालाजी", "café", "the", "the", "the"]
    return [" ".join(rng.choice(words) for _ in range(rng.choice([0, 1, 3, 8, 20]))) for _ in range(n)]


def result(df):
    out = {}
    for r in df.orderBy("qid", "rank").collect():
        out.setdefault(r.qid, []).append((r.rid, r.score))
        assert r["rank"] == len(out[r.qid])
    return out


def same(found, expected):
    expected = {q: x for q, x in expected.items() if x}
    assert found.keys() == expected.keys()
    for q, want in expected.items():
        assert [r for r, _ in found[q]] == [r for r, _ in want], q
        assert [s for _, s in found[q]] == pytest.approx([s for _, s in want], abs=2e-6)


@pytest.mark.parametrize("limits", [{}, {"block_entries": 200, "block_queries": 7}])
@pytest.mark.parametrize("parts", [1, 5])
def test_bm25_and_tfidf(spark, monkeypatch, limits, parts):
    texts = corpus(150, 1)
    targets = [(i, x, len(x.split()) + i % 3) for i, x in enumerate(texts)]
    queries = [(i, texts[i]) for i in range(0, 150, 4)] + [(1000, "बालाजी x"), (1001, "the"), (1002, "")]
    q, t = spark.createDataFrame(queries, "qid bigint, text string"), spark.createDataFrame(targets, "rid bigint, text string, row_size int").repartition(parts)
    if limits:
        monkeypatch.setattr(rt, "DENSE_CELLS", 64)
        monkeypatch.setattr(rt, "GATHERED", 16)
    wanted = [rt.Channel("bm25", "text", "bm25"), rt.Channel("tfidf", "text", "tfidf")]
    found = rt.search(q, t, wanted, 9, **limits).cache()
    # Ranked scores are negative in both: those of BM25 by contract.
    same(result(found.filter("channel = 'bm25'")), brute_bm25(queries, targets, 9))
    same(result(found.filter("channel = 'tfidf'")), {k: [(r, -s) for r, s in v] for k, v in brute_tfidf(queries, [x[:2] for x in targets], 9).items()})


def test_tokens_without_diacritics(spark):
    targets = [(1, "cafe noir", 2), (2, "café noir", 2), (3, "the noir", 2), (4, "other", 1)]
    queries = [(1, "café")]
    q, t = spark.createDataFrame(queries, "qid bigint, text string"), spark.createDataFrame(targets, "rid bigint, text string, row_size int")
    assert [r for r, _ in result(rt.bm25_topk(q, t))[1]] == [2]
    assert [r for r, _ in result(rt.bm25_topk(q, t, fold=True))[1]] == [1, 2]


def test_string_ids_and_ties(spark):
    q = spark.createDataFrame([("S1-a", "same text"), ("S1-b", "same text")], "qid string, text string")
    t = spark.createDataFrame([(f"S2-{i:03}", "same text", 2) for i in range(40)], "rid string, text string, row_size int").repartition(4)
    found = result(rt.tfidf_topk(q, t.drop("row_size"), 3))
    assert found == {x: [(f"S2-{i:03}", 1.0) for i in range(3)] for x in ("S1-a", "S1-b")}


def test_vocabulary_limits(spark):
    rows = spark.createDataFrame([("aa bb",), ("aa bb",), ("aa cc",), ("aa dd",)], "text string")
    sizes = {name: len(v.terms) for name, v in rt.vocabularies(rows, {"all": ("text", rt.WORD), "twice": ("text", rt.Analyzer(kind="word", min_df=2)), "rare": ("text", rt.Analyzer(kind="word", min_df=1, max_df=2)), "one": ("text", rt.Analyzer(kind="word", min_df=1, max_features=1))}).items()}
    assert sizes == {"all": 4, "twice": 2, "rare": 3, "one": 1}
    sample = rt.vocabularies(rows, {"x": ("text", rt.Analyzer(kind="word", min_df=1, vocabulary_rows=2))})["x"]
    assert len(sample.terms) in (2, 3)


def test_only_the_best_rows_are_shuffled(spark):
    """However many pairs share a term, k rows a query and task leave the tasks."""
    t = spark.createDataFrame([(i, f"common word{i % 50}") for i in range(4000)], "rid bigint, text string").repartition(4)
    q = spark.createDataFrame([(i, f"common word{i}") for i in range(50)], "qid bigint, text string")
    plan = rt.tfidf_topk(q, t, 5)
    files = plan.inputFiles()
    assert files and spark.read.parquet(*files).count() <= 50 * 5 * 4


def test_dense_blocks(spark):
    import numpy as np

    rng = np.random.default_rng(0)
    vectors = rng.normal(size=(60, 8)).astype(np.float32)
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "id bigint, vec array<float>")
    q, t = rows.filter("id % 5 = 0").withColumnRenamed("id", "qid"), rows.withColumnRenamed("id", "rid")
    unit = vectors.astype(float) / np.linalg.norm(vectors.astype(float), axis=1, keepdims=True)
    scores = np.round(unit @ unit.T, 6)
    expected = {i: [(int(j), float(scores[i, j])) for j in sorted(range(60), key=lambda j: (-scores[i, j], j)) if scores[i, j] > 0][:6] for i in range(0, 60, 5)}
    for limit in (3, 4096):
        found = result(rt.dense_topk(q, t, 6, block_queries=limit, rows=7))
        assert {k: [r for r, _ in v] for k, v in found.items()} == {k: [r for r, _ in v] for k, v in expected.items()}
