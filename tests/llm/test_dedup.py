import hashlib
import re
from collections import defaultdict

import pytest
from helpers import no_docs, odd_docs, rows

from linkloom.llm._common import read
from linkloom.llm.exact_dedup import exact_dedup, exact_groups
from linkloom.llm.minhash_dedup import near_dedup, near_groups


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def brute_exact(docs):
    groups = defaultdict(list)
    for i, t in docs:
        groups[normal(t)].append(i)
    out = []
    for i, t in docs:
        ids = groups[normal(t)]
        known = [x for x in ids if x is not None]
        keep = min(known) if known else None
        out.append((i, keep, len(ids), i == keep, hashlib.sha256(normal(t).encode()).hexdigest()))
    return sorted(out, key=lambda r: tuple((x is not None, str(x)) for x in r))


COLUMNS = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def test_exact_groups_of_the_table(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    assert rows(exact_groups(docs), *COLUMNS) == brute_exact([(r.doc_id, r.text) for r in docs.collect()])


def test_exact_groups_of_odd_rows(spark):
    docs = odd_docs(spark)
    assert rows(exact_groups(docs), *COLUMNS) == brute_exact([(r.doc_id, r.text) for r in docs.collect()])
    assert exact_groups(no_docs(spark)).count() == 0


def test_exact_dedup_keeps_columns(spark):
    docs = odd_docs(spark)
    kept = exact_dedup(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {1, 3, 5, 6, 8, 9, None}  # a row without id is never dropped by id


def shingles(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", lower)
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute_near(docs, percent=85):
    sets = {i: shingles(t) for i, t in docs}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            x, y = sets[a], sets[b]
            if x and y and 100 * min(len(x), len(y)) >= percent * max(len(x), len(y)):
                both = len(x & y)
                if 100 * both >= percent * (len(x) + len(y) - both):
                    p, q = root(a), root(b)
                    parent[max(p, q)] = min(p, q)
    return sorted((i, len(sets[i]), root(i), root(i) == i) for i in ids)


NEAR = ("doc_id", "n_shingles", "component_id", "kept")


def test_near_groups_of_the_table(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    found = [tuple(r) for r in near_groups(docs).select(*NEAR).orderBy("doc_id").collect()]
    assert found == brute_near([(r.doc_id, r.text) for r in docs.collect()])


def chain(n, words=200, step=3):
    """Texts that each differ a little from the one before: links only along the chain, one component."""
    base = [f"w{i}" for i in range(words)]
    out = []
    for k in range(n):
        out.append(" ".join(base))
        for j in range(step):
            base[(k * 7 + j) % words] = f"x{k}-{j}"
    return out


def test_a_chain_is_one_component_and_decoys_stay_apart(spark):
    texts = chain(12)
    decoys = [" ".join(f"d{k}-{i}" for i in range(100)) + " the shared passage of five words and more" for k in range(20)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts + decoys)], "doc_id bigint, text string")
    found = [tuple(r) for r in near_groups(docs).select(*NEAR).orderBy("doc_id").collect()]
    assert found == brute_near(list(enumerate(texts + decoys)))


def test_a_large_group_of_near_copies_loses_no_link(spark):
    base = [f"w{i}" for i in range(150)]
    docs = []
    for k in range(300):
        own = list(base)
        own[k % 150] = f"y{k}"
        docs.append((k, " ".join(own)))
    docs += [(1000 + k, " ".join(base[:100] + [f"z{k}-{i}" for i in range(60)])) for k in range(5)]  # half alike only
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    assert [tuple(r) for r in near_groups(df).select(*NEAR).orderBy("doc_id").collect()] == brute_near(docs)


def test_near_groups_of_odd_rows(spark):
    found = rows(near_groups(odd_docs(spark)), *NEAR)
    sets = {r[0]: r[1:] for r in found}
    assert len(found) == 11
    assert sets[3] == (0, 3, True) and sets[4] == (0, 4, True) and sets[5] == (0, 5, True)
    assert sets[1] == (2, 1, True) and sets[2] == (2, 1, False) and sets[7] == (2, 1, False)
    assert sets[8] == (1, 8, True) and sets[None] == (2, None, True)
    assert near_groups(no_docs(spark)).count() == 0


def test_near_dedup_keeps_one_of_each_group(spark):
    docs = odd_docs(spark)
    kept = near_dedup(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {1, 3, 4, 5, 6, 8, 9, None}


@pytest.mark.parametrize("matches", [1, 11])
def test_thresholds_of_matches_change_no_result_on_clear_copies(spark, matches):
    docs = spark.createDataFrame([(k, " ".join(f"w{i}" for i in range(60)) + (" end" if k % 2 else "")) for k in range(6)], "doc_id bigint, text string")
    assert {r.component_id for r in near_groups(docs, matches=matches).collect()} == {0}


def test_variants_that_hardly_link_are_all_compared(spark):
    """Most variants of one text are too far apart to link; some do, and only with each other."""
    base = [f"w{i}" for i in range(120)]
    docs = []
    for k in range(160):
        own = list(base)
        for j in range(1 + k % 5):
            own[(k * 13 + j * 29) % 120] = f"v{k % 40}-{j}"
        docs.append((1000 - k, " ".join(own)))
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    found = [tuple(r) for r in near_groups(df).select(*NEAR).orderBy("doc_id").collect()]
    expected = brute_near(docs)
    assert found == expected and 1 < sum(r[3] for r in expected) < len(docs)


def test_hot_values_and_small_blocks_change_no_result(spark, monkeypatch):
    """Groups of several sizes and lengths that share most of a text, with every bound far below their size."""
    from linkloom.llm import minhash_dedup as md

    rng = __import__("random").Random(1)
    docs = []
    for k in range(220):
        own = [f"w{i}" for i in range(rng.choice([60, 90, 150]))]
        for _ in range(rng.choice([0, 1, 2, 4])):
            own[rng.randrange(len(own))] = f"v{rng.randrange(30)}"
        docs.append((k, " ".join(own)))
    for name, value in {"HOT": 5, "HOT_BLOCKS": 2, "BLOCK": 4, "BLOCK_SHINGLES": 400}.items():
        monkeypatch.setattr(md, name, value)
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    assert [tuple(r) for r in near_groups(df).select(*NEAR).orderBy("doc_id").collect()] == brute_near(docs)


def test_rows_of_one_id_are_dropped_by_their_own_text(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "a  b"), (2, "c"), (3, "d"), (3, "d"), (None, "c"), (4, None), (5, "")], "doc_id bigint, text string")
    assert rows(exact_dedup(docs), "doc_id", "text") == rows(docs.filter("not (doc_id = 2 and text = 'a  b') and not (doc_id is not null and doc_id = 5) or doc_id is null"), "doc_id", "text")
