"""Language ID: scripts narrow the candidates, then Viterbi labels words and so spans of mixed text.

Per-language counts of hashed letter trigrams, with word boundaries, are learned in one pass: each task
counts, Spark adds. A word's score in a language is the sum of its trigrams' log probabilities. Ranges of
code points give each word's script; languages never seen in that script are no candidates for it. Over
the words of a text, Viterbi finds the best labels when every switch costs a penalty; runs of one label
are the spans. The text's language is the one with most letters, its score their share. The recursion runs
over positions for all texts of a chunk together, so that no Python loop runs over words.

The model has BUCKETS numbers a language and a script table; its size depends on the number of languages
only.

Defined cases: a null text, or one without a letter, is `und` with score 0 and has no span, also if it has
combining marks. A very long text is a chunk of its own. A text with
letters in scripts that no language was learned in is judged with all languages as candidates. If nothing
can be learned, every text is `und`. Ties go to the language that sorts first. Repeated rows each get
their result. Other columns are never read. An empty table gives no rows.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import stage
from .quality_classifier import remainder

BUCKETS = 1 << 15
#: More languages than that are refused, so that the learned table, BUCKETS numbers a language, stays some hundred MB.
MAX_LANGUAGES = 500
#: What a switch of language costs, in natural logarithms.
PENALTY = 8.0
#: A script is a language's if so large a share of its letters is in it.
SCRIPT_SHARE = 0.001
FOLDS, HELD_OUT = 4, 2
CHUNK_CHARS = 1 << 19
UNKNOWN = "und"

# First code points of script ranges. Letters before the first range are Latin.
SCRIPT_RANGES = ((0x0370, "Greek"), (0x0400, "Cyrillic"), (0x0530, "Armenian"), (0x0590, "Hebrew"), (0x0600, "Arabic"), (0x0900, "Devanagari"), (0x0980, "Indic"), (0x0E00, "Thai"), (0x0E80, "Asian"), (0x10A0, "Georgian"), (0x1100, "Hangul"), (0x1200, "Other"), (0x1E00, "Latin"), (0x1F00, "Greek"), (0x2000, "Other"), (0x2C60, "Latin"), (0x2C80, "Other"), (0x3040, "Kana"), (0x3100, "Han"), (0xA000, "Other"), (0xAC00, "Hangul"), (0xD7B0, "Other"), (0xF900, "Han"), (0xFB00, "Latin"), (0xFB13, "Other"), (0xFF21, "Latin"), (0xFF66, "Kana"), (0xFFA0, "Hangul"), (0x10000, "Other"), (0x20000, "Han"), (0x32000, "Other"))
SCRIPTS = ("Latin", *sorted({name for _, name in SCRIPT_RANGES} - {"Latin"}))
_STARTS = np.array([0, *(start for start, _ in SCRIPT_RANGES)])
_SCRIPT = np.array([0, *(SCRIPTS.index(name) for _, name in SCRIPT_RANGES)], np.uint8)
_tables: list[np.ndarray] = []


def _of_kind(points: np.ndarray, kind: str) -> np.ndarray:
    """Whether the code points' general category begins with kind: L for letters, M for marks."""
    if not _tables:
        first = [unicodedata.category(chr(c))[0] for c in range(0x10000)]
        _tables.extend([np.array([x == k for x in first]) for k in "LM"])
    out = _tables["LM".index(kind)][np.minimum(points, 0xFFFF)]
    high = np.flatnonzero(points > 0xFFFF)
    if len(high):
        out[high] = [unicodedata.category(chr(c))[0] == kind for c in points[high].tolist()]
    return out


class Words:
    """Words of letters in several texts: text and span of each, and its script."""

    def __init__(self, texts: list[str]):
        lowered = [x.lower() for x in texts]
        size = np.array([len(x) for x in lowered])
        # A blank after each text ends its last word.
        points = np.frombuffer((" ".join(lowered) + " ").encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        begin = np.concatenate([[0], np.cumsum(size + 1)[:-1]])
        # A word is a run of letters and marks with a letter in it; marks alone are none.
        real = _of_kind(points, "L")
        letter = real | _of_kind(points, "M")
        edges = np.diff(np.concatenate([[False], letter, [False]]).astype(np.int8))
        self.starts, self.ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        before = np.concatenate([[0], np.cumsum(real)])
        letters = before[self.ends] - before[self.starts]
        for a, e in zip(self.starts[letters == 0].tolist(), self.ends[letters == 0].tolist(), strict=True):
            letter[a:e] = False
        self.starts, self.ends = self.starts[letters > 0], self.ends[letters > 0]
        self.text = np.searchsorted(begin, self.starts, "right") - 1
        self.length = self.ends - self.starts
        padded = np.where(letter, points, 32)
        previous, following = np.concatenate([[32], padded[:-1]]), np.concatenate([padded[1:], [32]])
        hashed = (previous * 0x1F35 + padded * 0x5BD1E995 + following * 0x27D4EB2F) & 0xFFFFFFFF
        self.gram = ((hashed * 0x9E3779B1 & 0xFFFFFFFF) >> 17).astype(np.int64)
        self.letter = letter
        # The script is that of the word's first letter; a mark may stand before it.
        first = np.flatnonzero(real)
        first = first[np.searchsorted(first, self.starts)] if len(self.starts) else self.starts
        self.script = _SCRIPT[np.searchsorted(_STARTS, points[first], "right") - 1]

    def per_word(self, values: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0.0], np.cumsum(np.where(self.letter, values, 0.0))])
        return sums[self.ends] - sums[self.starts]


def _grouped(texts: list[str]) -> Iterator[tuple[int, int]]:
    first = 0
    while first < len(texts):
        end, chars = first + 1, len(texts[first])
        while end < len(texts) and chars + len(texts[end]) <= CHUNK_CHARS:
            chars += len(texts[end])
            end += 1
        yield first, end
        first = end


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, np.ndarray] = {}
    for batch in batches:
        texts, langs = [x or "" for x in batch.column(0).to_pylist()], batch.column(1).to_pylist()
        for first, end in _grouped(texts):
            w = Words(texts[first:end])
            names = sorted(set(langs[first:end]))
            code = np.array([names.index(x) for x in langs[first:end]])
            lang_of = np.zeros(len(w.letter), np.int64)
            lang_of[w.starts] = code[w.text] + 1
            word_lang = np.repeat(code[w.text], w.length)
            grams = w.gram[w.letter]
            cells = np.bincount(word_lang * BUCKETS + grams, minlength=len(names) * BUCKETS).reshape(len(names), BUCKETS)
            scripts = np.bincount(code[w.text] * len(SCRIPTS) + w.script, weights=w.length, minlength=len(names) * len(SCRIPTS)).reshape(len(names), len(SCRIPTS))
            for k, name in enumerate(names):
                counts.setdefault(name, np.zeros(BUCKETS + len(SCRIPTS)))
                counts[name][:BUCKETS] += cells[k]
                counts[name][BUCKETS:] += scripts[k]
    for name, row in counts.items():
        at = np.flatnonzero(row)
        yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(row[at].astype(np.int64))], names=["lang", "cell", "n"])


class Model:
    def __init__(self, langs: list[str], counts: np.ndarray):
        self.langs = langs
        grams, scripts = counts[:, :BUCKETS], counts[:, BUCKETS:]
        self.logs = np.log((grams + 0.5) / (grams.sum(1, keepdims=True) + 0.5 * BUCKETS)).astype(np.float32) if langs else np.empty((0, BUCKETS))
        self.scripts = scripts >= SCRIPT_SHARE * np.maximum(scripts.sum(1, keepdims=True), 1)

    def label(self, w: Words) -> np.ndarray:
        """The language of each word."""
        emitted = np.stack([w.per_word(row[w.gram]) for row in self.logs], axis=1)
        allowed = self.scripts.T[w.script]
        emitted[~allowed & allowed.any(1, keepdims=True)] = -1e9
        per_text = np.bincount(w.text)
        at = np.concatenate([[0], np.cumsum(per_text)])[:-1]
        order = np.argsort(-per_text, kind="stable")
        order = order[per_text[order] > 0]
        size, at = per_text[order], at[order]
        back = np.zeros(emitted.shape, np.int8 if len(self.langs) < 128 else np.int32)
        stay = np.arange(len(self.langs))
        best = emitted[at].copy()
        # Texts are sorted by their number of words: those that go on are the first ones.
        going = np.searchsorted(-size, -np.arange(size[0] + 1) if len(size) else [], "left")
        for k in range(1, size[0] if len(size) else 0):
            m = going[k]
            now = best[:m]
            top = now.argmax(1)
            switched = now[np.arange(m), top] - PENALTY
            take = switched[:, None] > now
            back[at[:m] + k] = np.where(take, top[:, None], stay)
            best[:m] = np.where(take, switched[:, None], now) + emitted[at[:m] + k]
        label = np.zeros(len(emitted), np.int64)
        state = best.argmax(1) if len(size) else np.empty(0, np.int64)
        for k in range((size[0] if len(size) else 0) - 1, -1, -1):
            m = going[k]
            label[at[:m] + k] = state[:m]
            state[:m] = back[at[:m] + k, state[:m]]
        return label


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """Learns from the rows with a language whose remainder is not HELD_OUT."""
    known = docs.filter(F.col(lang_col).isNotNull() & (remainder(F.col(id_col), FOLDS) != HELD_OUT))
    cells = known.select(F.col(text_col), F.col(lang_col)).mapInArrow(_counted, "lang string, cell int, n long").groupBy("lang", "cell").agg(F.sum("n").alias("n"))
    cells = stage(cells, "language-counts")
    if cells.select("lang").distinct().count() > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    rows = cells.toPandas()  # at most BUCKETS rows a language, and MAX_LANGUAGES languages
    langs = sorted(set(rows["lang"]))
    counts = np.zeros((len(langs), BUCKETS + len(SCRIPTS)))
    if len(rows):
        counts[np.searchsorted(langs, rows["lang"].to_numpy()), rows["cell"].to_numpy()] = rows["n"].to_numpy()
    return Model(langs, counts)


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score and spans: runs of words in one language, by their first and end word among the words of letters."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = dict(docs.dtypes)[id_col]
    span = pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32()), ("lang", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            texts = [x or "" for x in batch.column(1).to_pylist()]
            for first, end in _grouped(texts):
                n = end - first
                preds, scores, spans = [UNKNOWN] * n, np.zeros(n), [[] for _ in range(n)]
                w = Words(texts[first:end])
                if m.langs and len(w.text):
                    label = m.label(w)
                    weight = np.bincount(w.text * len(m.langs) + label, weights=w.length, minlength=n * len(m.langs)).reshape(n, -1)
                    total, top = weight.sum(1), weight.argmax(1)
                    scores = np.where(total > 0, weight.max(1) / np.maximum(total, 1), 0.0)
                    preds = [m.langs[t] if s else UNKNOWN for t, s in zip(top, total, strict=True)]
                    begins = np.flatnonzero(np.concatenate([[True], (w.text[1:] != w.text[:-1]) | (label[1:] != label[:-1])]))
                    stops = np.append(begins[1:], len(label))
                    zero = np.searchsorted(w.text, np.arange(n))
                    for b, e in zip(begins.tolist(), stops.tolist(), strict=True):
                        t = int(w.text[b])
                        spans[t].append({"first": b - int(zero[t]), "end": e - int(zero[t]), "lang": m.langs[label[b]]})
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, n), pa.array(preds, pa.string()), pa.array(scores), pa.array(spans, span)], names=["doc_id", "lang_pred", "score", "spans"])

    out = docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, f"doc_id {kind}, lang_pred string, score double, spans array<struct<first:int,end:int,lang:string>>")
    return out.select("doc_id", (remainder(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "lang_pred", "score", "spans")


def languages(docs: DataFrame) -> DataFrame:
    return identify(docs, learn(docs))
