import hashlib
import struct
import zlib

import pytest
import sentencepiece
from helpers import LONG, no_docs, odd_docs

from linkloom.llm import language_id as li
from linkloom.llm._common import read
from linkloom.llm.piece_codec import PieceCodec, encode_decode
from linkloom.llm.queries import piece_model

TEXTS = ["", " ", "a", "  a  b ", "a\nb\tc", "▁a▁▁b", "x▁", "日本語 テスト 🙂", "a" * 500, "é " * 40, "<s> </s> <unk>", "\x00 \x7f", "1234567890 12 3", LONG[:5000], "   ", "İstanbul ﬁ"]


@pytest.fixture(scope="module")
def codec():
    with open(piece_model(), "rb") as f:
        return PieceCodec(f.read())


def test_chunks_give_the_library_s_ids(codec):
    library = sentencepiece.SentencePieceProcessor(model_file=piece_model())
    assert codec.chunked
    for text in TEXTS * 2:
        ids = library.encode(text, add_bos=True, add_eos=True)
        assert codec.encode(text).tolist() == ids, text
        assert codec.decode(codec.encode(text)) == library.decode(ids)


def test_without_chunks_whole_texts_are_encoded(codec):
    with open(piece_model(), "rb") as f:
        other = PieceCodec(f.read())
    other.chunked = False
    assert all(other.encode(x) == codec.encode(x) for x in TEXTS)


def test_a_full_table_is_emptied(codec, monkeypatch):
    monkeypatch.setattr("linkloom.llm.piece_codec.TABLE_CHUNKS", 3)
    with open(piece_model(), "rb") as f:
        small = PieceCodec(f.read())
    assert small.encode(LONG[:3000]) == codec.encode(LONG[:3000]) and len(small.table) <= 3


def test_encoding_of_tables(spark, sf_dir):
    library = sentencepiece.SentencePieceProcessor(model_file=piece_model())
    for docs in (read(spark, sf_dir, "documents"), odd_docs(spark)):
        found = encode_decode(docs, piece_model(), results=("n_tokens", "ids_sha256", "decoded_sha256")).collect()
        key = lambda r: (r[0] is not None, str(r))
        expected = []
        for r in docs.collect():
            ids = library.encode(r.text or "", add_bos=True, add_eos=True)
            expected.append((r.doc_id, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest()))
        assert sorted(map(tuple, found), key=key) == sorted(expected, key=key)
    assert encode_decode(no_docs(spark), piece_model()).count() == 0
    assert encode_decode(odd_docs(spark), piece_model()).columns == ["doc_id", "ids", "decoded"]
    kept = encode_decode(odd_docs(spark), piece_model(), keep=("lang", "ids", "n_chars"))
    assert kept.columns == ["doc_id", "lang", "ids_in", "n_chars", "ids", "decoded"]
    assert {(r.doc_id, r.lang, r.n_chars) for r in kept.collect()} == {(r.doc_id, r.lang, r.n_chars) for r in odd_docs(spark).collect()} and {r.ids_in for r in kept.collect()} == {"clash"}
    by_other = encode_decode(odd_docs(spark).selectExpr("n_chars as ids", "text"), piece_model(), id_col="ids")
    assert by_other.columns == ["doc_id", "ids", "decoded"] and by_other.count() == 11


# ---------------------------------------------------------------- languages


def test_held_out_accuracy(spark, sf_dir):
    big = sf_dir.replace("sf0.001", "sf0.01")
    docs = read(spark, big, "documents")
    langs = {r.doc_id: r.lang for r in docs.collect()}
    found = li.languages(docs).collect()
    assert len(found) == len(langs)
    held = [r for r in found if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in found)
    assert sum(r.lang_pred == langs[r.doc_id] for r in held) > 0.97 * len(held)


def learned(spark):
    train = [(i, t, lang) for i in range(40) if zlib.crc32(str(i).encode()) % 4 != 2 for t, lang in [("the house and the garden of this town " * 5, "en"), ("der Garten und das Haus in dieser Stadt " * 5, "de"), ("Привет как дела сегодня вечером " * 5, "ru")]]
    return li.learn(spark.createDataFrame(train, "doc_id bigint, text string, lang string"))


def test_mixed_text_has_spans(spark):
    model = learned(spark)
    text = "the house and the garden of this town der Garten und das Haus in dieser Stadt"
    docs = spark.createDataFrame([(1, text), (2, "Привет 12 как"), (3, "12 34 !!"), (4, None), (5, "日本語")], "doc_id bigint, text string")
    out = {r.doc_id: r for r in li.identify(docs, model).collect()}
    assert [(s.first, s.end, s.lang) for s in out[1].spans] == [(0, 8, "en"), (8, 16, "de")]
    assert out[2].lang_pred == "ru" and out[2].score == 1.0
    assert (out[3].lang_pred, out[3].score, out[3].spans) == ("und", 0.0, []) and out[4].lang_pred == "und"
    assert out[5].lang_pred in model.langs


def test_viterbi_is_the_best_path(spark):
    import itertools

    import numpy as np

    model = learned(spark)
    w = li.Words(["the der und house Stadt", "", "garden", "и the"])
    emitted = np.stack([w.per_word(row[w.gram]) for row in model.logs], axis=1)
    allowed = model.scripts.T[w.script]
    emitted[~allowed & allowed.any(1, keepdims=True)] = -1e9
    found = model.label(w)
    for text in range(4):
        at = np.flatnonzero(w.text == text)
        value = lambda path: sum(emitted[i, s] for i, s in zip(at, path, strict=True)) - li.PENALTY * sum(a != b for a, b in zip(path, path[1:], strict=False))  # noqa: B023, E731
        if len(at):
            best = max(value(p) for p in itertools.product(range(len(model.langs)), repeat=len(at)))
            assert abs(value(tuple(found[at])) - best) < 1e-3


def test_languages_of_odd_rows(spark):
    out = li.languages(odd_docs(spark)).collect()
    assert len(out) == 11 and all(0 <= r.score <= 1 for r in out)
    assert li.languages(no_docs(spark)).count() == 0
    unlabelled = odd_docs(spark).selectExpr("doc_id", "text", "cast(null as string) lang")
    assert {r.lang_pred for r in li.languages(unlabelled).collect()} == {"und"}


def test_marks_alone_are_no_letters(spark):
    model = learned(spark)
    docs = spark.createDataFrame([(1, "\u0301\u0302 \u093e"), (2, "e\u0301 the house"), (3, "\u0301the")], "doc_id bigint, text string")
    out = {r.doc_id: r for r in li.identify(docs, model).collect()}
    assert (out[1].lang_pred, out[1].score, out[1].spans) == ("und", 0.0, [])
    assert out[2].lang_pred == "en" and out[3].lang_pred in model.langs


# ---------------------------------------------------------------- language ID's whole way in plain Python


def plain_words(text):
    """Runs of letters and marks with a letter, as (start, end) in the lower-cased text."""
    import unicodedata

    out, begin = [], None
    for k, c in enumerate(text + " "):
        if unicodedata.category(c)[0] in "LM":
            begin = k if begin is None else begin
        elif begin is not None:
            if any(unicodedata.category(x)[0] == "L" for x in text[begin:k]):
                out.append((begin, k))
            begin = None
    return out


def plain_script(c):
    return li.SCRIPTS.index("Latin" if ord(c) < li.SCRIPT_RANGES[0][0] else [name for start, name in li.SCRIPT_RANGES if start <= ord(c)][-1])


def plain_cells(word):
    """The cells of a word's letter trigrams, with a blank before and after it."""
    p = [32, *map(ord, word), 32]
    out = []
    for a, b, c in zip(p, p[1:], p[2:], strict=False):
        h = (a * 0x1F35 + b * 0x5BD1E995 + c * 0x27D4EB2F) & 0xFFFFFFFF
        out.append((h * 0x9E3779B1 & 0xFFFFFFFF) >> 17)
    return out


def test_languages_of_the_table_against_plain_python(spark, sf_dir):
    import math
    import unicodedata
    from collections import Counter

    docs = read(spark, sf_dir, "documents")
    rows = [(r.doc_id, (r.text or "").lower(), r.lang) for r in docs.collect()]
    rows += [(100_001, "the end der anfang " * 30 + "и the", None), (100_002, "", None), (100_003, "12 \u0301", None)]
    both = docs.select("doc_id", "text", "lang").unionByName(spark.createDataFrame([(i, t, lang) for i, t, lang in rows[-3:]], "doc_id bigint, text string, lang string"))
    found = {r.doc_id: r for r in li.languages(both).collect()}
    grams, scripts = {}, {}
    for i, text, lang in rows:
        if lang is not None and zlib.crc32(str(i).encode()) % 4 != 2:
            for a, e in plain_words(text):
                word = text[a:e]
                grams.setdefault(lang, Counter()).update(plain_cells(word))
                scripts.setdefault(lang, Counter())[plain_script(next(c for c in word if unicodedata.category(c)[0] == "L"))] += len(word)
    langs = sorted(grams)
    total = {x: sum(grams[x].values()) + 0.5 * li.BUCKETS for x in langs}
    logs = {x: (lambda cell, x=x: math.log((grams[x][cell] + 0.5) / total[x])) for x in langs}
    for i, text, _ in rows:
        spans, words = [], plain_words(text)
        best, back = None, []
        for a, e in words:
            word = text[a:e]
            script = plain_script(next(c for c in word if unicodedata.category(c)[0] == "L"))
            allowed = [scripts[x][script] >= li.SCRIPT_SHARE * sum(scripts[x].values()) for x in langs]
            own = [sum(map(logs[x], plain_cells(word))) if ok or not any(allowed) else -1e9 for x, ok in zip(langs, allowed, strict=True)]
            if best is None:
                best = own
                continue
            top = max(range(len(langs)), key=lambda k: best[k])
            back.append([top if best[top] - li.PENALTY > best[k] else k for k in range(len(langs))])
            best = [max(best[k], best[top] - li.PENALTY) + own[k] for k in range(len(langs))]
        r = found[i]
        if not words:
            assert (r.lang_pred, r.score, r.spans) == ("und", 0.0, [])
            continue
        state = max(range(len(langs)), key=lambda k: best[k])
        path = [state]
        for row in reversed(back):
            state = row[state]
            path.append(state)
        path.reverse()
        share = Counter()
        for (a, e), k in zip(words, path, strict=True):
            share[langs[k]] += e - a
        top = max(sorted(share), key=lambda x: share[x])
        assert r.lang_pred == top and abs(r.score - share[top] / sum(share.values())) < 1e-9, i
        for k, x in enumerate(path):
            if not spans or spans[-1][2] != langs[x]:
                spans.append([k, k + 1, langs[x]])
            spans[-1][1] = k + 1
        assert [[s.first, s.end, s.lang] for s in r.spans] == spans, i
