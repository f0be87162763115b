import re
import zlib
from collections import Counter

import numpy as np
from helpers import no_docs, odd_docs, rows

from linkloom.llm import quality_classifier as qc
from linkloom.llm._common import read
from linkloom.llm.quality_rules import quality_filter, quality_verdicts

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_counts(text):
    text = text or ""
    w = WORD.findall(text)
    windows = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    n = Counter(windows)
    covered = {i + k for i, x in enumerate(windows) if n[x] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    failed = len(w) < 10 or 100 * len(covered) > 20 * len(w)
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), failed)


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def test_base_counts_of_the_table(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    expected = sorted((r.doc_id, *brute_counts(r.text)) for r in docs.collect())
    assert sorted(tuple(r) for r in quality_verdicts(docs).select("doc_id", *COUNTS).collect()) == expected


def test_base_counts_of_odd_rows(spark):
    docs = odd_docs(spark)
    found = quality_verdicts(docs)
    key = lambda r: tuple((x is not None, str(x)) for x in r)
    assert rows(found, "doc_id", *COUNTS) == sorted(((r.doc_id, *brute_counts(r.text)) for r in docs.collect()), key=key)
    assert not [r for r in found.collect() if r.base_failed and r.kept]
    assert quality_verdicts(no_docs(spark)).count() == 0


def test_clean_documents_stay_and_junk_goes(spark, sf_dir):
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    joined = quality_verdicts(docs).join(labels, "doc_id").collect()
    good = [r.kept for r in joined if r.quality == 1 and not r.base_failed]
    bad = [r.kept for r in joined if r.quality == 0]
    assert np.mean(good) > 0.97 and np.mean(bad) < 0.1


def test_divergence_against_numpy(spark):
    from pyspark.sql import functions as F

    from linkloom.llm.quality_rules import js_distance

    p, q = [3.0, 0.0, 5.0, 2.0], [1.0, 4.0, 0.0, 5.0]
    df = spark.createDataFrame([(p, q), (p, p), (p, [0.0] * 4), ([0.0] * 4, p)], "p array<double>, q array<double>")
    found = [r[0] for r in df.select(js_distance(F.col("p"), F.col("q"))).collect()]
    a, b = np.array(p) / sum(p), np.array(q) / sum(q)
    mid = (a + b) / 2
    half = lambda x: sum(v * np.log2(v / m) for v, m in zip(x, mid, strict=True) if v)
    assert abs(found[0] - np.sqrt((half(a) + half(b)) / 2)) < 1e-12 and found[1] == 0 and found[2] is None and found[3] == 1


def test_filter_keeps_columns(spark):
    docs = odd_docs(spark)
    assert quality_filter(docs).columns == docs.columns


def test_filter_judges_each_row_by_its_own_verdict(spark, sf_dir):
    from pyspark.sql import functions as F

    known = read(spark, sf_dir, "documents")
    fine = quality_verdicts(known).filter("kept and n_words > 150").select("doc_id").join(known.filter("lang = 'en'"), "doc_id").orderBy("doc_id").first()
    good, bad = fine.text + " end", "### $$$ " * 50
    rows_in = [(1, good, "en"), (1, bad, "en"), (None, bad, "en"), (None, good, "en"), (2, None, None), (3, good, "en"), (3, good, "en"), (4, bad, None)]
    docs = spark.createDataFrame([(i, t, x, "s") for i, t, x in rows_in], "doc_id bigint, text string, lang string, source string")
    table = read(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source").withColumn("doc_id", F.col("doc_id") + 1000)
    both = docs.unionByName(table).withColumns({c: F.lit("clash") for c in ("key", "h1", "classes", "lang_key", "ref_words")})
    kept = quality_filter(both)
    assert kept.columns == both.columns
    verdicts = rows(quality_verdicts(both).filter("kept and (doc_id is null or doc_id < 1000)"), "doc_id")
    own = kept.filter("doc_id is null or doc_id < 1000")
    assert rows(own, "doc_id") == verdicts == [(None,), (1,), (3,), (3,)] and {r.text for r in own.collect()} == {good}
    assert kept.filter("doc_id >= 1000").count() == quality_verdicts(both).filter("kept and doc_id >= 1000").count()


def test_a_long_text_without_common_words_fails(spark, sf_dir):
    import random

    rng = random.Random(2)
    strange = " ".join("".join(rng.choice("etaoinshrdlucmfwypvbgk") for _ in range(rng.choice([3, 5, 7]))) for _ in range(300)) + "."
    table = read(spark, sf_dir, "documents")
    docs = table.unionByName(table.limit(1).selectExpr("-1L as doc_id", f"'{strange}' as text", "'en' as lang", "source", "n_chars"))
    row = quality_verdicts(docs).filter("doc_id = -1").first()
    assert row.word_distance == 1.0 and not row.base_failed and not row.kept


# ---------------------------------------------------------------- classifier


def test_held_out_accuracy(spark, sf_dir):
    big = sf_dir.replace("sf0.001", "sf0.01")
    docs, labels = read(spark, big, "documents"), read(spark, big, "labels")
    scored = {r.doc_id: r for r in qc.quality_scores(docs, labels).collect()}
    assert len(scored) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for i, r in scored.items())
    pairs = [(scored[r.doc_id].score, r.quality) for r in labels.collect() if scored[r.doc_id].held_out]
    good, bad = [s for s, y in pairs if y == 1], [s for s, y in pairs if y == 0]
    assert np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad]) > 0.95


def test_partition_sums_are_the_normal_equations(spark, sf_dir):
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    model = qc.fit(qc.measured(docs), labels)
    stats = {r.doc_id: np.array(r.x) for r in qc.measured(docs).collect()}
    learned = [(r.doc_id, r.quality) for r in labels.collect() if zlib.crc32(str(r.doc_id).encode()) % 5 not in (0, 4)]
    z, y = model.kernel(np.array([stats[i] for i, _ in learned])), np.array([v for _, v in learned], float)
    ridge = qc.RIDGE * np.diag(np.append(np.ones(qc.FEATURES), 1e-6))
    assert np.allclose(model.solution, np.linalg.solve(z.T @ z + ridge, z.T @ y), atol=1e-6)


def test_isotonic_is_monotone_and_nearest():
    x, y, w = np.arange(6.0), np.array([0.1, 0.4, 0.2, 0.3, 0.9, 0.8]), np.array([1.0, 1, 1, 1, 1, 3])
    assert np.allclose(qc.isotonic(x, y, w), [0.1, 0.3, 0.3, 0.3, 0.825, 0.825])


def test_classifier_on_odd_rows_and_without_labels(spark):
    docs = odd_docs(spark)
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    assert {r.score for r in qc.quality_scores(docs, none).collect()} == {0.5}
    some = spark.createDataFrame([(i, i % 2) for i in range(1, 10)] + [(3, None), (None, 1), (1, 1)], "doc_id bigint, quality int")
    out = qc.quality_scores(docs, some).collect()
    assert len(out) == 11 and all(0 <= r.score <= 1 for r in out)
    assert qc.quality_scores(no_docs(spark), some).count() == 0


# ---------------------------------------------------------------- the classifier's whole way in plain Python


def plain_statistics(text):
    data = (text or "").encode()
    point = dict(qc._CLASSES)
    kinds = list(point)
    kind = lambda c: next((k for k in kinds if c in point[k]), "other")
    counts = Counter(kind(c) for c in data)
    w = re.findall(rb"[^\x20\x09-\x0D]+", data)
    fold = [x.lower() for x in w]
    n = max(len(w), 1)
    lengths = [len(x) for x in w]
    mean = sum(lengths) / n
    deviation = max(sum(x * x for x in lengths) / n - mean**2, 0) ** 0.5
    distinct = len(set(fold)) / n
    capital = sum(2 * sum(65 <= c <= 90 for c in x) > len(x) for x in w) / n
    odd = [kind(x[-1]) in ("mark", "bar", "symbol") for x in w]
    lines = [bytes(max(c, 33) for c in x).lower() for x in data.split(b"\n") if x]
    expected = np.log1p(len(w))
    return [*(counts[k] / max(len(data), 1) for k in kinds), counts["other"] / max(len(data), 1), np.log1p(len(data)), expected, mean, deviation, distinct, distinct * expected, sum(a == b for a, b in zip(fold, fold[1:], strict=False)) / n, capital, sum(odd) / n, sum(o and len(x) == 1 for o, x in zip(odd, w, strict=True)) / n, len(set(lines)) / max(len(lines), 1)]


def pool(y, weight):
    """Isotonic values by the definition: the largest mean of intervals that end, the smallest that begin."""
    n = len(y)
    mean = lambda i, j: np.dot(y[i : j + 1], weight[i : j + 1]) / weight[i : j + 1].sum()
    return np.array([max(min(mean(i, j) for j in range(k, n)) for i in range(k + 1)) for k in range(n)])


def test_scores_of_the_table_against_plain_python(spark, sf_dir):
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    found = {r.doc_id: r for r in qc.quality_scores(docs, labels).collect()}
    x = {r.doc_id: np.array(plain_statistics(r.text), np.float32).astype(float) for r in docs.collect()}
    part = lambda i: zlib.crc32(str(i).encode()) % 5
    given = {}
    for r in labels.collect():
        given.setdefault(r.doc_id, []).append(r.quality)
    known = {i: np.mean(v) for i, v in given.items() if i in x and part(i) != 0}
    stats = np.array([x[i] for i in known])
    mean, deviation = stats.mean(0), stats.std(0)
    deviation[deviation <= 1e-9] = 1.0
    rng = np.random.Generator(np.random.PCG64(qc.SEED))
    directions = rng.standard_normal((qc.STATISTICS, qc.FEATURES)) / (qc.WIDTH * np.sqrt(qc.STATISTICS))
    phases = rng.uniform(0, 2 * np.pi, qc.FEATURES)

    def fourier(v):
        z = np.clip((v - mean) / deviation, -6, 6)
        return np.append(np.sqrt(2 / qc.FEATURES) * np.cos(z @ directions + phases), 1.0)

    learned, held = [i for i in known if part(i) != 4], [i for i in known if part(i) == 4]
    z, y = np.array([fourier(x[i]) for i in learned]), np.array([known[i] for i in learned])
    solution = np.linalg.solve(z.T @ z + qc.RIDGE * np.diag(np.append(np.ones(qc.FEATURES), 1e-6)), z.T @ y)
    cells = {}
    for i in held:
        cells.setdefault(int(np.clip(np.round((fourier(x[i]) @ solution + 0.5) / 2 * qc.GRID), 0, qc.GRID)), []).append(known[i])
    grid = np.array(sorted(cells))
    values = pool(np.array([np.mean(cells[c]) for c in grid]), np.array([len(cells[c]) for c in grid], float))
    assert len(found) == len(x)
    for i, v in x.items():
        raw = fourier(v) @ solution
        score = np.clip(0.999 * np.interp(raw, grid / qc.GRID * 2 - 0.5, values) + 0.001 * np.clip((raw + 0.5) / 2, 0, 1), 0, 1)
        assert abs(found[i].score - score) < 2e-3 and found[i].held_out == (part(i) == 0), i
