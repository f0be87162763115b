"""All 91 features of pairs against plain Python, and the size of their plan."""

import math
import re
import unicodedata
from collections import Counter

import pytest
from pyspark.sql import functions as F

from linkloom.functions import text as t
from linkloom.operators import features as feat
from linkloom.operators import retrieval

RECORDS = [
    (1, "Orchid Books Pvt Ltd", "12 Rd, Apt 4b 560001", "India"),
    (2, "Orchid books", "12 road 560001", "india"),
    (3, "Cedar Café & Co", "7 Market Ln 75001", "France"),
    (4, "cafe cedar company", "9 Market lane 75002", ""),
    (5, "", "1 Main", "US"),
    (6, "श्री बालाजी ट्रेडर्स", "4 MG Rd 400001", "India"),
    (7, "Shri Balaji Traders", "", "India"),
    (8, "Maple Maple Maple", "12 12 5 road", "US"),
    (9, "Orchid Bookz Private Limited", "121 rd 560001", "India"),
]
SCORES = [{}, {"tfidf_name": 0.5}, {"bm25_taddress": -2.5, "tfidf_tname": 0.25, "bm25_name": -1.0}]


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def subsequence(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


def jaro(a, b):
    if not a or not b:
        return 0.0
    reach = max(0, max(len(a), len(b)) // 2 - 1)
    used, pairs = set(), []
    for i, x in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if j not in used and b[j] == x:
                used.add(j)
                pairs.append((i, j))
                break
    if not pairs:
        return 0.0
    m, order = len(pairs), sorted(j for _, j in pairs)
    moved = sum(a[i] != b[j] for (i, _), j in zip(pairs, order, strict=True)) / 2
    return (m / len(a) + m / len(b) + (m - math.floor(moved)) / m) / 3


def winkler(a, b):
    score, same = jaro(a, b), 0
    while same < min(4, len(a), len(b)) and a[same] == b[same]:
        same += 1
    return score + 0.1 * same * (1 - score) if score > 0.7 else score


def indel(a, b):
    return 2 * subsequence(a, b) / (len(a) + len(b)) if a or b else 1.0


def token_set(a, b):
    if not a or not b:
        return 0.0
    x, y = set(a.split()), set(b.split())
    both, left, right = " ".join(sorted(x & y)), " ".join(sorted(x - y)), " ".join(sorted(y - x))
    joined = lambda p, q: (p + " " + q).strip()
    if both and not (left and right):
        return 1.0
    whole = joined(both, left), joined(both, right)
    found = [1 - (len(left) + len(right) - 2 * subsequence(left, right)) / (len(whole[0]) + len(whole[1]))]
    return max(found + [2 * len(both) / (len(both) + len(w)) for w in whole if both])


def sets(a, b):
    x, y = set(a), set(b)
    if not x or not y:
        return 0.0, 0.0, 0.0
    return len(x & y) / len(x | y), len(x & y) / min(len(x), len(y)), float(x <= y or y <= x)


def statistics(a, b):
    if not a or not b:
        return [0.0] * 11 + [1.0]
    same = 0
    while same < min(len(a), len(b)) and a[same] == b[same]:
        same += 1
    longest, shortest = max(len(a), len(b)), min(len(a), len(b))
    jac, over, cont = sets(a.split(), b.split())
    sort = indel(" ".join(sorted(a.split())), " ".join(sorted(b.split())))
    return [float(a == b), 1 - distance(a, b) / longest, jaro(a, b), winkler(a, b), jac, over, cont, token_set(a, b), sort, same / shortest, shortest / longest, 0.0]


def grams(text):
    return [f" {w} "[i : i + n] for w in text.split() for n in (3, 4, 5) for i in range(len(w) + 3 - n)]


def cosine(corpus, terms, sublinear, min_df):
    df = Counter(x for text in corpus for x in set(terms(text)))
    idf = {x: math.log((1 + len(corpus)) / (1 + n)) + 1 for x, n in df.items() if n >= min_df}

    def vector(text):
        v = {x: ((1 + math.log(n)) if sublinear else n) * idf[x] for x, n in Counter(terms(text)).items() if x in idf}
        norm = math.sqrt(sum(w * w for w in v.values()))
        return {x: w / norm for x, w in v.items()}

    return lambda a, b: sum(w * vector(b).get(x, 0.0) for x, w in vector(a).items()), idf


def expected(q, r, scores, corpora):
    out = []
    for field in ("name_norm", "name_translit", "address_norm", "address_translit"):
        out += statistics(q[field], r[field])
    out.append(float(q.name_core == r.name_core and q.name_core != ""))
    for field in ("name_norm", "address_norm", "name_translit", "address_translit"):
        out += [corpora[field, kind][0](q[field], r[field]) for kind in ("char", "word")]
    idf = corpora["name_norm", "word"][1]
    ordered = sorted(idf.values())
    at = 0.75 * (len(ordered) - 1)
    cut = ordered[math.floor(at)] + (at - math.floor(at)) * (ordered[math.ceil(at)] - ordered[math.floor(at)])
    out.append(float(len(set(q.name_norm.split()) & set(r.name_norm.split()) & {x for x, v in idf.items() if v >= cut})))
    number = lambda x, size="+": set(re.findall(rf"\b\d{size}\b", x))
    a, b = q.address_norm, r.address_norm
    na, nb, pa, pb = number(a), number(b), number(a, "{5,6}"), number(b, "{5,6}")
    house = [(re.findall(r"\b\d+[a-z]?\b", x) or [""])[0] for x in (a, b)]
    out += [sets(na, nb)[0], len(na & nb), float(bool(na and nb) and not na & nb), float(house[0] == house[1] != ""), float(bool(pa & pb)), float(bool(pa and pb) and not pa & pb), float(not pa or not pb)]
    ca, cb, sa, sb = q.country_norm, r.country_norm, q.script, r.script
    out += [float(ca == cb != ""), float(bool(ca and cb) and ca != cb), float(not ca or not cb), float(sa == sb != "NONE"), float(sa != sb and "NONE" not in (sa, sb))]
    name, address = winkler(q.name_norm, r.name_norm), token_set(a, b)
    out += [float(name >= 0.85 and address >= 0.8), float(name >= 0.85 and address < 0.4), float(name < 0.4 and address >= 0.8)]
    for channel in feat.CHANNELS:
        out += [scores.get(channel, 0.0), float(channel in scores)]
    return [*out, float(len(scores)), float(len(scores) > 1)]


@pytest.fixture(scope="module")
def sides(spark):
    raw = spark.createDataFrame(RECORDS, "id bigint, name string, address string, country string")
    rows = raw.select("id", *(v.alias(k) for k, v in t.normalized_record(F.col("name"), F.col("address"), F.col("country")).items())).cache()
    return rows.withColumnRenamed("id", "qid"), rows.withColumnRenamed("id", "rid")


def test_all_features_against_plain_python(spark, sides):
    q, r = sides
    rows = {x.qid: x for x in q.collect()}
    pairs = [(a, b, SCORES[(a + b) % 3]) for a in rows for b in rows]
    found = feat.pair_features(spark.createDataFrame(pairs, "qid bigint, rid bigint, scores map<string,double>"), q, r)
    assert found.columns == ["qid", "rid", *feat.FEATURE_NAMES]
    corpora = {}
    for field in ("name_norm", "address_norm", "name_translit", "address_translit"):
        corpus = [x[field] for x in rows.values()]
        corpora[field, "char"] = cosine(corpus, grams, True, 2)
        corpora[field, "word"] = cosine(corpus, lambda x: re.findall(r"\w+", x), False, 1)
    values = {(x.qid, x.rid): x for x in found.collect()}
    assert len(values) == len(pairs)
    for a, b, scores in pairs:
        for name, want in zip(feat.FEATURE_NAMES, expected(rows[a], rows[b], scores, corpora), strict=True):
            assert values[a, b][name] == pytest.approx(want, abs=2e-6), (a, b, name)


def test_the_plan_does_not_grow_with_the_fields(spark, sides):
    q, r = sides
    pairs = spark.createDataFrame([(1, 2, {"bm25_name": -1.0})], "qid bigint, rid bigint, scores map<string,double>")
    plan = feat.pair_features(pairs, q, r)._jdf.queryExecution().analyzed()
    assert plan.collectLeaves().size() == 1


def test_normalised_text_keeps_marks_and_finds_latin_forms(sides):
    q, _ = sides
    row = {x.qid: x for x in q.collect()}[6]
    assert row.name_norm == "श्री बालाजी ट्रेडर्स" and row.name_translit == "shri balaji tredrs" and row.script == "DEVANAGARI" and row.address_norm == "4 mg road 400001"


def test_a_name_in_another_script_is_found_through_its_latin_form(sides):
    q, r = sides
    named = lambda df, key: df.select(key, *(F.col(c).alias(f) for f, c in feat.FIELDS.items()))
    found = retrieval.channels(named(q.filter("qid = 7"), "qid"), named(r, "rid"), list(feat.FIELDS), 3, retrieval.Analyzer(min_df=1)).collect()
    assert {x.channel for x in found if x.rid == 6} >= {"tfidf_tname"} and not [x for x in found if x.rid == 6 and x.channel.endswith("_name")]


@pytest.mark.parametrize("text,latin", [("Москва", "moskva"), ("Αθήνα", "athena"), ("カタカナ", "katakana"), ("한국", "hangug"), ("مرحبا", "mrhba"), ("ÀÉßØŁ", "aessol"), ("١٢", "12"), ("ABC", "abc"), ("中文", "中文"), ("a—b", "a—b")])
def test_latin_forms(text, latin):
    assert t.to_latin(text) == latin


def test_configured_normalisation(spark):
    row = spark.createDataFrame([("Foo GmbH KG", "Haupt Str 5", "DE")], "n string, a string, c string")
    made = t.normalized_record(F.col("n"), F.col("a"), F.col("c"), translit=False, name_mappings={"foo": "bar"}, address_mappings={"str": "strasse"}, suffixes=("gmbh", "kg"))
    x = row.select(*(v.alias(k) for k, v in made.items())).first()
    assert (x.name_norm, x.name_core, x.address_norm, x.name_translit) == ("bar gmbh kg", "bar", "haupt strasse 5", "")
    plain = row.select(*(v.alias(k) for k, v in t.normalized_record(F.col("n"), F.col("a"), F.col("c"), name_mappings={}, suffixes=()).items())).first()
    assert plain.name_core == plain.name_norm == unicodedata.normalize("NFKC", "foo gmbh kg")


def test_legacy_features_against_plain_python(spark):
    from difflib import SequenceMatcher

    rows = [(a[0], b[0], *a[1:], *b[1:]) for a in RECORDS for b in RECORDS]
    columns = [f"{c}_{side}" for side in "qt" for c in ("name", "address", "country")]
    df = spark.createDataFrame(rows, "qid bigint, rid bigint, " + ", ".join(f"{c} string" for c in columns))

    def plain(x):
        x = "".join(c for c in unicodedata.normalize("NFKD", x.casefold()) if not unicodedata.combining(c)).replace("&", " and ")
        return " ".join("".join(c if c == "_" or c.isspace() or unicodedata.category(c)[0] in "LN" else " " for c in x).split())

    found = {(r.qid, r.rid): r for r in feat.legacy_features(df).collect()}
    for q, r, *values in rows:
        nq, aq, cq, nt, at, ct = map(plain, values)
        want = []
        for a, b in ((nq, nt), (aq, at)):
            want += [SequenceMatcher(None, a, b, autojunk=False).ratio() if a and b else 0.0, sets(a.split(), b.split())[0], float(a == b != "")]
        na, nb = set(re.findall(r"\d+", aq)), set(re.findall(r"\d+", at))
        want += [sets(na, nb)[0], float(bool(na and nb) and not na & nb), float(cq == ct != ""), float(bool(cq and ct) and cq != ct), float(not nq or not nt), float(not aq or not at)]
        assert [found[q, r][k] for k in feat.LEGACY_NAMES] == pytest.approx(want, abs=1e-9), (q, r)


@pytest.mark.parametrize("a,b,n", [("", "", 0), ("a", "", 0), ("abc", "abd", 2), ("abc", "abc", 3), ("ab", "abc", 2), ("x", "y", 0), ("é🙂a", "é🙂b", 2)])
def test_common_prefixes(spark, a, b, n):
    from linkloom.functions.similarity import common_prefix

    assert spark.createDataFrame([(a, b)], "a string, b string").select(common_prefix(F.col("a"), F.col("b"))).first()[0] == n


def test_token_ratios_of_the_table(spark, sf_dir):
    from difflib import SequenceMatcher

    from linkloom.plans import queries as plans

    pairs = {r.p_partkey: (r.a, r.b) for r in plans.part_pairs(spark, sf_dir).collect()}
    found = plans.QUERIES["token_ratio_features"](spark, sf_dir).collect()
    assert len(found) == len(pairs)
    for r in found:
        a, b = pairs[r.p_partkey]
        want = (token_set(a, b), indel(" ".join(sorted(a.split())), " ".join(sorted(b.split()))), SequenceMatcher(None, a, b, autojunk=False).ratio())
        assert (r.token_set, r.token_sort, r.sequence) == pytest.approx(want, abs=2e-6)
