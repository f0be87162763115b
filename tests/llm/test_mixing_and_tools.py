import hashlib
import json
from collections import defaultdict

import pytest
from helpers import no_docs, odd_docs

from linkloom.llm import source_mixing as sm
from linkloom.llm import tool_linking as tl
from linkloom.llm._common import read


def shared(budget, children):
    """Water filling by repetition: children is {name: (weight, capacity)}."""
    out, open_names, left = {}, set(children), float(budget)
    while open_names:
        total = sum(children[c][0] for c in open_names)
        full = [c for c in open_names if left * children[c][0] / total >= children[c][1]]
        if not full:
            return out | {c: left * children[c][0] / total for c in open_names}
        for c in full:
            out[c] = float(children[c][1])
            open_names.remove(c)
        left -= sum(children[c][1] for c in full)
    return out


def brute(docs, share, epochs, weights, seed=sm.SEED):
    """docs: (doc_id, domain, lang, source, tokens) -> copies by doc_id."""
    leaves = defaultdict(list)
    for d in docs:
        leaves[d[1:4]].append(d)
    capacity = lambda prefix: sum(d[4] for d in docs if d[1 : 1 + len(prefix)] == prefix) * epochs
    budgets = {(): int(sum(d[4] for d in docs) * share + 1e-9)}
    for depth, level in enumerate(sm.LEVELS):
        down = {}
        for prefix, b in budgets.items():
            names = {k[depth] for k in leaves if k[:depth] == prefix}
            parts = shared(b, {n: (weights.get(level, {}).get(n, 1.0), capacity((*prefix, n))) for n in names})
            down |= {(*prefix, n): int(v + 1e-6) for n, v in parts.items()}
        budgets = down
    copies = {}
    for leaf, members in leaves.items():
        tokens = sum(d[4] for d in members)
        whole, rest = divmod(budgets[leaf], tokens) if tokens else (epochs, 0)
        run = 0
        for d in sorted(members, key=lambda d: (hashlib.md5(f"{seed}:{whole}:{d[0]}".encode()).hexdigest(), d[0])):
            run += d[4]
            copies[d[0]] = whole + (rest > 0 and run <= rest)
    return copies


@pytest.mark.parametrize("share,epochs", [(0.6, 2), (0.9, 1), (1.7, 2), (3.0, 2), (0.0, 2), (0.05, 3)])
def test_mixture_of_the_table(spark, sf_dir, share, epochs):
    weights = {"domain": sm.DOMAIN_WEIGHTS, "lang": sm.LANG_WEIGHTS, "source": {}}
    out = sm.mixture(read(spark, sf_dir, "documents"), share=share, max_epochs=epochs).collect()
    docs = [(r.doc_id, r.domain, r.lang, r.source, r.n_tokens) for r in out]
    assert {r.doc_id: r.copies for r in out} == brute(docs, share, epochs, weights)
    taken = sum(r.n_tokens * r.copies for r in out)
    assert taken <= share * sum(d[4] for d in docs) + 1e-6


def test_small_cells_change_nothing(spark, sf_dir, monkeypatch):
    docs = read(spark, sf_dir, "documents")
    before = {r.doc_id: r.copies for r in sm.mixture(docs).collect()}
    monkeypatch.setattr(sm, "CELL_DOCS", 2)
    assert {r.doc_id: r.copies for r in sm.mixture(docs).collect()} == before


def test_shortages_go_to_siblings_first(spark):
    rows = [(i, "w " * 10, "en", "a1") for i in range(2)] + [(10 + i, "w " * 10, "en", "a5") for i in range(20)] + [(50 + i, "w " * 10, "en", "b2") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    out = sm.mixture(docs, share=0.5, max_epochs=1, weights={}).select("source", "leaf_budget").distinct().collect()
    assert {r.source: r.leaf_budget for r in out} == {"a1": 20, "a5": 85, "b2": 105}


def test_mixture_of_odd_rows(spark):
    out = sm.mixture(odd_docs(spark)).collect()
    assert len(out) == 11 and all(r.copies >= 0 for r in out)
    assert sm.mixture(no_docs(spark)).count() == 0
    mixed = sm.mixed(odd_docs(spark), share=2.0, max_epochs=2)
    assert mixed.columns == odd_docs(spark).columns and mixed.filter("doc_id = 6").count() == 2
    with pytest.raises(ValueError):
        sm.mixture(odd_docs(spark), weights={"lang": {"en": 0}})


def test_many_siblings_are_shared_alike(spark, sf_dir):
    """Running sums of ranges give what one window gives."""
    docs = read(spark, sf_dir, "documents")
    leaves = docs.selectExpr("concat('d', doc_id % 3) as domain", "lang", "concat('s', doc_id % 60) as source", "size(split(text, ' ')) as tokens").groupBy("domain", "lang", "source").agg({"tokens": "sum"}).withColumnRenamed("sum(tokens)", "tokens")
    weights = {"domain": {"d0": 3}, "lang": {"en": 2}}
    found = [{(r.domain, r.lang, r.source): r.budget for r in sm.leaf_budgets(leaves, 0.7, 1, weights, few=few).collect()} for few in (0, 10**6)]
    assert found[0] == found[1] and len(found[0]) == leaves.count()


def test_mixed_keeps_columns_of_any_name(spark, sf_dir):
    from pyspark.sql import functions as F

    docs = read(spark, sf_dir, "documents")
    wide = docs.withColumns({c: F.lit("clash") for c in ("key", "copies", "time", "_time", "_copies", "_more_id", "h1", "leaf", "order", "cell", "domain", "used", "range")})
    wide = wide.unionByName(wide.filter("doc_id % 7 = 0")).unionByName(wide.filter("doc_id < 3").withColumn("doc_id", F.lit(None).cast("bigint")))
    out = sm.mixed(wide)
    assert out.columns == wide.columns
    taken = {}
    for r in sm.mixture(wide).collect():
        taken.setdefault((r.doc_id, r.lang, r.source), []).append(r.copies)
    got = defaultdict(int)
    for r in out.collect():
        got[r.doc_id, r.lang, r.source] += 1
    assert dict(got) == {k: sum(v) for k, v in taken.items() if sum(v)}


# ---------------------------------------------------------------- tools

CALLS = "conv_id bigint, call_id string, seq bigint, name string, arguments string, after array<string>"
RESULTS = "conv_id bigint, call_id string, seq bigint, content string"
SCHEMAS = {"add": {"a": (("integer", "number"), True), "b": (("integer", "number"), True), "note": (("string", "null"), False)}, "say": {"x": (("object", "array", "boolean"), True)}}


def linked(spark, calls, results, **options):
    return tl.link(spark.createDataFrame(calls, CALLS), spark.createDataFrame(results, RESULTS), SCHEMAS, **options).orderBy("conv_id", "position").collect()


def test_links_order_and_canonical_json(spark):
    calls = [(1, "c", 1, "add", ' {"b": 2, "a" : 1.50}', ["b"]), (1, "b", 5, "add", '{"a":1,"b":2,"note":null}', ["a"]), (1, "a", 9, "say", '{"x":{"z":1,"y":[2, "é\\n"]}}', []), (2, "a", 1, "add", '{"a":1,"b":1}', None)]
    results = [(1, "a", 10, "done"), (1, "zz", 3, "lost"), (2, "a", 2, 'say "x"'), (1, "a", 11, None)]
    out = linked(spark, calls, results)
    assert [(r.kind, r.call_id, r.link) for r in out if r.conv_id == 1] == [("result", "zz", "orphan"), ("call", "a", "linked"), ("result", "a", "linked"), ("result", "a", "linked"), ("call", "b", "unanswered"), ("call", "c", "unanswered")]
    assert [r.position for r in out if r.conv_id == 1] == [1, 2, 3, 4, 5, 6]
    text = {(r.kind, r.call_id, r.conv_id): r.json for r in out}
    assert text["call", "a", 1] == '{"arguments":{"x":{"y":[2,"é\\n"],"z":1}},"call_id":"a","name":"say","role":"tool_call"}'
    assert text["result", "a", 2] == '{"call_id":"a","content":"say \\"x\\"","role":"tool_result"}'
    assert all(json.loads(r.json) is not None and not r.errors for r in out)


def test_cycles_are_marked(spark):
    out = linked(spark, [(1, "a", 1, "add", "{}", ["b"]), (1, "b", 2, "add", "{}", ["a"]), (1, "c", 3, "add", "{}", ["b"]), (1, "d", 4, "add", "{}", [])], [])
    assert {r.call_id: r.cyclic for r in out} == {"a": True, "b": True, "c": True, "d": False}
    assert out[0].call_id == "d"


def test_arguments_are_checked(spark):
    given = {"ok": '{"a":1,"b":2.5}', "missing": '{"a":1}', "type": '{"a":"1","b":2}', "extra": '{"a":1,"b":2,"z":0,"y":0}', "broken": '{"a":', "list": "[1]", "none": None}
    out = linked(spark, [(1, k, i, "add", v, []) for i, (k, v) in enumerate(given.items())] + [(1, "tool", 9, "fly", "{}", []), (1, "notool", 10, None, "{}", [])], [])
    assert {r.call_id: list(r.errors) for r in out} == {"ok": [], "missing": ["missing:b"], "type": ["type:a"], "extra": ["unexpected:y", "unexpected:z"], "broken": ["not_json"], "list": ["not_object"], "none": ["not_json"], "tool": ["unknown_tool"], "notool": ["unknown_tool"]}


def test_odd_messages(spark):
    calls = [(1, "a", 1, "add", "{}", []), (1, "a", 1, "add", "{}", []), (1, "a", 0, "add", "{}", []), (None, "a", 1, "add", "{}", []), (1, None, 1, "add", "{}", []), (1, "n", None, "add", "{}", [])]
    results = [(1, "a", 5, "x"), (1, "a", 5, "x"), (None, "a", 2, "y"), (1, None, 2, "z")]
    out = linked(spark, calls, results)
    assert sum(r.repeats for r in out) == len(calls) + len(results) and len(out) == 8
    assert sorted(r.link for r in out if r.kind == "call" and r.call_id == "a" and r.conv_id == 1) == ["linked", "repeated"]
    assert {r.link for r in out if r.conv_id is None} == {"unanswered", "orphan"}
    for conv in (1, None):
        own = [r.position for r in out if r.conv_id == conv]
        assert sorted(own) == list(range(1, len(own) + 1))
    assert linked(spark, [], []) == []


def brute_order(calls):
    """Levels of calls {id: (seq, parents)} by peeling; None on or behind a cycle."""
    level, left = {}, dict(calls)
    while True:
        ready = [c for c, (_, up) in left.items() if all(p in level for p in up if p in calls and p != c)]
        if not ready:
            return level | dict.fromkeys(left)
        level |= {c: max((level[p] + 1 for p in left[c][1] if p in calls and p != c), default=0) for c in ready}
        left = {c: v for c, v in left.items() if c not in level}


@pytest.mark.parametrize("small", [0, 256])
def test_levels_against_peeling(spark, small):
    import random

    rng = random.Random(3)
    graphs, calls = {}, []
    for conv in range(12):
        n = rng.choice([1, 3, 8, 30])
        forward = rng.choice([0.0, 0.1, 0.5])
        graphs[conv] = {str(i): (i, [str(rng.randrange(n) if rng.random() < forward else rng.randrange(i + 1)) for _ in range(rng.choice([0, 1, 1, 1, 2, 3]))]) for i in range(n)}
        calls += [(conv, c, seq, "add", "{}", up) for c, (seq, up) in graphs[conv].items()]
    out = linked(spark, calls, [], small=small)
    for conv, graph in graphs.items():
        level = brute_order(graph)
        odd = any(graph[p][0] >= graph[c][0] for c, (_, up) in graph.items() for p in up if p != c)
        order = [r.call_id for r in out if r.conv_id == conv]
        key = lambda c: (level[c] is None, level[c] or 0, graph[c][0]) if odd else (False, 0, graph[c][0])  # noqa: B023, E731
        assert order == sorted(graph, key=key), conv
        assert {r.call_id for r in out if r.conv_id == conv and r.cyclic} == {c for c in graph if level[c] is None}


def test_a_long_chain_backwards_takes_few_rounds(spark):
    n = 3000
    calls = [(1, str(i), i, "add", "{}", [str(i + 1)]) for i in range(n)] + [(2, str(i), i, "add", "{}", [str((i + 1) % n)]) for i in range(n)]
    newest = lambda: max(spark.sparkContext.statusTracker().getJobIdsForGroup(), default=0)
    before = newest()
    out = linked(spark, calls, [])
    assert [int(r.call_id) for r in out if r.conv_id == 1] == list(range(n - 1, -1, -1)) and all(r.cyclic for r in out if r.conv_id == 2)
    assert 0 < newest() - before < 300


def test_messages_at_one_place_are_numbered(spark):
    calls = [(1, f"c{i}", 5, "add", "{}", []) for i in range(50)]
    results = [(1, "c0", 6, f"answer {i}") for i in range(70)]
    out = linked(spark, calls, results)
    assert [r.position for r in out] == list(range(1, 121)) and {r.kind for r in out[:50]} == {"call"}


def test_very_long_arguments_and_contents(spark):
    long = "x" * (tl.MAX_ARGUMENTS + 1)
    out = linked(spark, [(1, "a", 1, "add", long, []), (1, "b", 2, "add", '{"a":1,"b":2,"note":"' + "y" * 1_000_000 + '"}', [])], [(1, "a", 3, long)])
    assert [(r.kind, list(r.errors), len(r.json) > 1_000_000) for r in out] == [("call", ["too_long"], True), ("result", [], True), ("call", [], True)]
    assert json.loads(out[0].json)["arguments"] == long == json.loads(out[1].json)["content"]


def test_extra_columns_are_not_read(spark):
    from pyspark.sql import functions as F

    wide = lambda rows, schema: spark.createDataFrame(rows, schema).withColumns({c: F.lit("clash") for c in ("level", "at", "part", "tie", "position", "parents", "head_seq", "answered")})
    out = tl.link(wide([(1, "a", 1, "add", "{}", ["b"]), (1, "b", 2, "add", "{}", [])], CALLS), wide([(1, "a", 3, "x")], RESULTS), SCHEMAS).collect()
    assert sorted((r.position, r.kind, r.call_id) for r in out) == [(1, "call", "b"), (2, "call", "a"), (3, "result", "a")]


def test_turns_exercise_order_cycles_and_errors(spark, sf_dir):
    turns = read(spark, sf_dir.replace("sf0.001", "sf0.01"), "conversations")
    out = tl.linked_turns(turns).collect()
    assert len(out) == turns.count()
    assert {e.split(":")[0] for r in out for e in r.errors} == {"unknown_tool", "missing", "type", "unexpected", "not_json", "not_object"}
    assert 0 < sum(r.cyclic for r in out) < len(out)
    by_conv = defaultdict(list)
    for r in sorted(out, key=lambda r: (r.conv_id, r.position)):
        by_conv[r.conv_id].append(r)
    moved = [c for c, rows in by_conv.items() if [r.seq for r in rows] != sorted(r.seq for r in rows) and not any(r.cyclic for r in rows)]
    assert moved
