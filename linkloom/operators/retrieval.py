"""Top-k text retrieval as a blocked product: TF-IDF cosine and BM25 of stated queries against all targets.

A query is a sparse vector over hashed terms, and so is a target's field; a score is their product. Queries
with the same vector are searched for once. The distinct vectors of a channel are dealt into blocks of a counted
number of entries (BLOCK_ENTRIES, whatever the number of queries), which are sent to all tasks. Each task brings
its targets with equal texts together, multiplies the texts' vectors with a block - the terms that are frequent on
both sides as matrices, the others by lists - and keeps the k best targets of each query. Where many terms are
frequent, as in long texts, queries and texts are dealt into groups of like ones first, and a pair of groups has its
own frequent terms, which are few where the languages differ. Only the best targets, k rows a
query and task, are shuffled to one last rank. So no term, however frequent, is a key of any shuffle, no pair
of texts becomes a row, and the work is the same for a target wherever it lies. Channels over fields that agree in
every row have one list.

What a TF-IDF channel must know beforehand, its vocabulary, is counted over all targets in one pass (tasks
add up their own counts first) and has at most max_features terms. BM25 needs the document frequencies of a
block's own terms only.

Scores are rounded to six places before they are ranked, so the order of sums cannot change a rank. Ties go
to the smaller target id.

Defined cases: a null text is an empty one; an empty query text finds nothing; targets without a shared term
are not found; an empty vocabulary leaves a channel without rows. Repeated rows of an id are each scored and
ranked. Other columns are never read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field, replace
from functools import cached_property, lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.terms import Places, Points, chunks, counted, gram_counts, mix, phrases
from ..functions.text import without_marks
from ..sources.staging import append_stages, spread, stage

PLACES = 6
K1, B, IDF_FLOOR = 1.2, 0.75, 1e-6
TOP_K, MAX_TOKENS = 20, 16
MAX_FEATURES = 150_000
#: Entries of query vectors and queries that are sent to the tasks at once: at most some 100 MB.
BLOCK_ENTRIES, BLOCK_QUERIES = 1 << 23, 1 << 13
#: Cells of the dense part of a block, cells of scores (few, so they stay in a processor's cache and the least scores rise early; more with a
#: large dense part), and pairs of entries that a task multiplies at a time.
DENSE_CELLS, SCORE_CELLS, MOST_CELLS, GATHERED = 1 << 23, 1 << 17, 1 << 20, 1 << 20
#: A term is multiplied densely if its queries and targets are more than this share of all pairs.
DENSE_SHARE = 0.004
#: A block with more of such terms is multiplied in tiles of like queries and like texts, each with its own dense terms: at most so many queries or texts
#: and dense terms a tile, from so many entries of texts at a time. Queries are grouped about so many centres by the terms that tell most.
WIDE_TERMS, TILE, TILE_TERMS, TILE_ENTRIES, CENTRES, TELLING = 256, 1 << 10, 1 << 13, 6 << 20, 8, 2048
#: Mixes terms with weights.
_ODD = np.uint64(0x9E3779B97F4A7C15)
#: Characters of distinct texts that a task brings together, and the length up to which order of words is ignored.
POOL_CHARS, POOL_ORDERED = 1 << 24, 256


# ---------------------------------------------------------------- terms


def char_ngrams(text: Column, low: int = 3, high: int = 5) -> Column:
    """n-grams inside each word padded by a blank on both sides (V1); a word not longer than n gives itself once."""

    def of_word(w: Column) -> Column:
        padded, size = F.concat(F.lit(" "), w, F.lit(" ")), F.length(w) + 2
        lengths = F.sequence(F.lit(low), F.least(F.lit(high), F.greatest(size, F.lit(low))))
        return F.flatten(F.transform(lengths, lambda n: F.transform(F.sequence(F.lit(1), F.greatest(size - n + 1, F.lit(1))), lambda at: F.substring(padded, at, n))))

    return F.flatten(F.transform(F.array_remove(F.split(text, " "), ""), of_word))


def search_tokens(text: Column) -> Column:
    """Runs of letters and digits (V6)."""
    return F.array_remove(F.split(text, r"[^\p{L}\p{N}]+"), "")


@dataclass(frozen=True)
class Analyzer:
    """How a text becomes weighted terms (V1, V2, V3). vocabulary_rows takes the vocabulary from a sample (Q3)."""

    kind: str = "char"
    low: int = 3
    high: int = 5
    sublinear: bool = True
    min_df: int = 2
    max_features: int = MAX_FEATURES
    max_df: int | None = None
    vocabulary_rows: int | None = None

    def counts(self, texts: list[str], known: Places | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, term and number of each distinct (row, term), ordered by both (a word is a run of letters, digits and underscores).

        Terms are hashes, or places among the known ones; others are left out then.
        """
        if self.kind == "char":
            return gram_counts(texts, self.low, self.high, known)
        row, h = Points(texts).words("LN_")
        if known is None:
            return counted(row, h)
        at, has = known.of(h)
        width = len(known.terms)
        key, n = np.unique(row[has] * width + at[has], return_counts=True)
        row, at = np.divmod(key, width)
        return row, at, n


#: The retrieval channel, the word model of the features, and the oldest generation's channel.
CHAR, WORD, LEGACY = Analyzer(), Analyzer(kind="word", sublinear=False, min_df=1), Analyzer(low=2, high=5, sublinear=False, min_df=1, max_features=200_000)


@dataclass(frozen=True)
class Channel:
    """One retriever over one field. BM25's tokens lose their diacritics if fold is set, as the oldest generation's did."""

    name: str
    field: str
    kind: str
    analyzer: Analyzer = CHAR
    max_tokens: int = MAX_TOKENS
    fold: bool = False


@dataclass
class Vocabulary:
    """Sorted term hashes and their inverse document frequencies; at most max_features of them."""

    analyzer: Analyzer
    terms: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    idf: np.ndarray = field(default_factory=lambda: np.zeros(0))

    @cached_property
    def places(self) -> Places:
        return Places(self.terms)

    def equals(self, other: Vocabulary) -> bool:
        return self is other or self.analyzer == other.analyzer and np.array_equal(self.terms, other.terms) and np.array_equal(self.idf, other.idf)

    @property
    def shares(self) -> np.ndarray:
        """The share of rows that have each term."""
        return np.exp(1 - self.idf)

    def vectors(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, term (place in the vocabulary) and weight of the unit vectors, ordered by row."""
        if not len(self.terms):
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        row, at, tf = self.analyzer.counts(texts, self.places)
        w = (1 + np.log(tf) if self.analyzer.sublinear else tf.astype(float)) * self.idf[at]
        norm = np.sqrt(np.bincount(row, w * w, len(texts)))
        return row, at, w / norm[row]


def _strings(column: pa.Array) -> list[str]:
    return [x or "" for x in column.to_pylist()]


class _Tally:
    """Rows and frequency of terms; what comes in is merged once it is as much as what is there."""

    def __init__(self):
        self.size, self.waiting, self.pending = 0, [], 0

    def add(self, term: np.ndarray, tf: np.ndarray, times: np.ndarray) -> None:
        """Entries of texts, each of which stands for so many rows."""
        self.waiting.append((term, times, tf * times))
        self.pending += len(term)
        if self.pending > max(1 << 18, 2 * self.size):
            self._merge()

    def _merge(self) -> None:
        if len(self.waiting) > 1 or self.pending:
            term, df, cf = (np.concatenate(x) for x in zip(*self.waiting, strict=True))
            h, inverse = np.unique(term, return_inverse=True)
            self.waiting = [(h, np.bincount(inverse, df, len(h)).astype(np.int64), np.bincount(inverse, cf, len(h)).astype(np.int64))]
            self.size, self.pending = len(h), 0

    def taken(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        self._merge()
        out = self.waiting[0] if self.waiting else (np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))
        self.size, self.waiting, self.pending = 0, [], 0
        return out


def alike(tables: list[DataFrame], fields: list[str]) -> dict[str, str]:
    """For each field the first one that has the same text in every row of the tables."""
    pairs = [(a, b) for at, b in enumerate(fields) for a in fields[:at]]
    text = lambda f: F.coalesce(F.col(f), F.lit(""))
    out = {f: f for f in fields}
    if pairs:
        counts = [df.agg(*(F.count_if(text(a) != text(b)).alias(f"{n}") for n, (a, b) in enumerate(pairs))).first() for df in tables]
        for n, (a, b) in reversed(list(enumerate(pairs))):
            if not any(row[n] for row in counts):
                out[b] = a
    return out


def vocabularies(rows: DataFrame, wanted: dict[str, tuple[str, Analyzer]]) -> dict[str, Vocabulary]:
    """The vocabulary of each wanted name: (field of rows, analyzer), all counted in one pass over rows."""
    fields = list(dict.fromkeys(f for f, _ in wanted.values()))
    limits = {a.vocabulary_rows for _, a in wanted.values()} - {None}
    if len(limits) > 1:
        raise ValueError("one sample of rows serves all vocabularies")
    if limits:
        rows = rows.withColumn("_order", F.xxhash64(F.lit(42), *fields)).orderBy("_order", *fields).limit(limits.pop())
    # Fields with the same texts have one vocabulary.
    first_of = alike([rows], fields)
    same = {name: (first_of[f], a) for name, (f, a) in wanted.items()}
    wanted = {name: x for x, name in {x: name for name, x in reversed(same.items())}.items()}
    fields = list(dict.fromkeys(f for f, _ in wanted.values()))
    places = [(fields.index(f), a) for f, a in wanted.values()]
    by_analyzer: dict[Analyzer, list[tuple[int, int]]] = {}
    for k, (place, a) in enumerate(places):
        by_analyzer.setdefault(a, []).append((k, place))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tallies, n = [_Tally() for _ in places], 0
        names = ["channel", "term", "df", "cf"]

        def out(k: int) -> pa.RecordBatch:
            h, df, cf = tallies[k].taken()
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(h), k, np.int32)), pa.array(h.view(np.int64)), pa.array(df), pa.array(cf)], names=names)

        for batch in batches:
            n += batch.num_rows
            texts = [Counter(_strings(c)) for c in batch.columns]
            for analyzer, own in by_analyzer.items():
                # A text that several rows or fields have is taken apart once.
                known = list(dict.fromkeys(x for _, place in own for x in texts[place]))
                for first, end in chunks(known):
                    row, term, tf = analyzer.counts(known[first:end])
                    for k, place in own:
                        times = np.fromiter((texts[place][x] for x in known[first:end]), np.int64, end - first)[row]
                        has = slice(None) if times.all() else times > 0
                        tallies[k].add(term[has], tf[has], times[has])
                        if tallies[k].size > 1 << 20:
                            yield out(k)
        for k in range(len(places)):
            yield out(k)
        yield pa.RecordBatch.from_arrays([pa.array([-1], pa.int32()), pa.array([0], pa.int64()), pa.array([n], pa.int64()), pa.array([0], pa.int64())], names=names)

    counts = spread(rows.select(*fields)).mapInArrow(count, "channel int, term long, df long, cf long")
    counts = stage(counts.groupBy("channel", "term").agg(F.sum("df").alias("df"), F.sum("cf").alias("cf")), "term-counts")
    n_rows = counts.filter("channel = -1").agg(F.sum("df")).first()[0] or 0
    out = {}
    for k, (name, (_, a)) in enumerate(wanted.items()):
        df = counts.filter((F.col("channel") == k) & (F.col("df") >= a.min_df))
        if a.max_df is not None:
            df = df.filter(F.col("df") <= a.max_df)
        table = df.orderBy(F.desc("cf"), "term").limit(a.max_features).select("term", "df").toArrow()  # at most max_features rows
        terms = table.column("term").to_numpy().view(np.uint64)
        order = np.argsort(terms)
        out[name] = Vocabulary(a, terms[order], np.log((1 + n_rows) / (1 + table.column("df").to_numpy()[order])) + 1)
    own = {x: out[name] for name, x in wanted.items()}
    return {name: own[x] for name, x in same.items()}


# ---------------------------------------------------------------- query vectors


def query_phrases(text: str, max_tokens: int) -> list[list[str]]:
    """The first max_tokens distinct words of a query, each as its tokens: a word of several tokens is a phrase."""
    words = (_word_tokens(word) for word in list(dict.fromkeys(text.split()))[:max_tokens])
    return [list(x) for x in words if x]


@lru_cache(1 << 16)
def _word_tokens(word: str) -> tuple[str, ...]:
    starts, ends = Points([word]).runs(_search_letters())
    return tuple(word[s - 1 : e - 1] for s, e in zip(starts.tolist(), ends.tolist(), strict=True))


def _search_letters() -> np.ndarray:
    from ..functions.terms import letters

    return letters("LN")


def _folded(channel: Channel, texts: list[str]) -> list[str]:
    return [without_marks(x) for x in texts] if channel.fold else texts


def _query_terms(channel: Channel, vocabulary: Vocabulary | None, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, term and weight of the queries. A BM25 term is a phrase's hash, its weight the phrase's length."""
    if channel.kind == "tfidf":
        row, at, w = vocabulary.vectors(texts)
        return row, vocabulary.terms[at] if len(at) else np.zeros(0, np.uint64), w
    found = [(k, phrase) for k, x in enumerate(_folded(channel, texts)) for phrase in query_phrases(x, channel.max_tokens)]
    row, words = Points([" ".join(phrase) for _, phrase in found]).words("LN") if found else (np.zeros(0, np.int64), np.zeros(0, np.uint64))
    size = np.bincount(row, minlength=len(found)).astype(np.int64) if found else np.zeros(0, np.int64)
    h = np.zeros(len(found), np.uint64)
    at = np.concatenate([[0], np.cumsum(size)])
    for length in np.unique(size).tolist():
        pick = np.flatnonzero(size == length)
        for k in pick.tolist():
            h[k] = phrases(np.zeros(length, np.int64), words[at[k] : at[k] + length], length)[1][0]
    owner = np.array([k for k, _ in found], np.int64)
    # Two phrases of a query with one hash are one term.
    _, first = np.unique(np.column_stack([owner.astype(np.uint64), h]), axis=0, return_index=True) if len(h) else (None, np.zeros(0, np.int64))
    first = first[np.lexsort((h[first], owner[first]))]
    return owner[first], h[first], size[first].astype(float)


def _query_vectors(queries: DataFrame, channels: list[Channel], vocabulary: dict[str, Vocabulary]) -> DataFrame:
    """qid, channel, terms, weights (both as bytes) and their number, a row per query and channel that has any."""
    kind = dict(queries.dtypes)["qid"]
    fields = list(dict.fromkeys(c.field for c in channels))
    shared = queries.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            texts = {f: _strings(batch.column(1 + k)) for k, f in enumerate(fields)}
            for number, channel in enumerate(channels):
                for first, end in chunks(texts[channel.field]):
                    # A text that several queries have is taken apart once.
                    known: dict[str, int] = {}
                    of = np.array([known.setdefault(x, len(known)) for x in texts[channel.field][first:end]], np.int64)
                    row, term, w = _query_terms(channel, shared.value.get(channel.name), list(known))
                    has, start, size = np.unique(row, return_index=True, return_counts=True)
                    parts = [(term[a : a + n].tobytes(), w[a : a + n].tobytes()) for a, n in zip(start, size, strict=True)]
                    place = np.full(len(known), -1)
                    place[has] = np.arange(len(has))
                    found = np.flatnonzero(place[of] >= 0)
                    at = pa.array(place[of][found])
                    yield pa.RecordBatch.from_arrays(
                        [ids.take(pa.array(found + first)), pa.array(np.full(len(found), number, np.int32)), pa.array([t for t, _ in parts], pa.binary()).take(at), pa.array([v for _, v in parts], pa.binary()).take(at), pa.array(size.astype(np.int64)).take(at)],
                        names=["qid", "channel", "terms", "weights", "size"],
                    )

    rows = spread(queries.select("qid", *fields)).mapInArrow(run, f"qid {kind}, channel int, terms binary, weights binary, size long")
    return stage(rows, "query-vectors")


# ---------------------------------------------------------------- the product


class Block:
    """The distinct vectors of some queries of one channel, by term."""

    def __init__(self, channel: Channel, ids: list, terms: list[np.ndarray], weights: list[np.ndarray]):
        self.channel, self.ids, self.parts = channel, ids, []
        owner = np.repeat(np.arange(len(ids), dtype=np.int32), [len(x) for x in terms])
        self.terms, at = np.unique(np.concatenate(terms), return_inverse=True)
        order = np.argsort(at, kind="stable")
        self.query, self.value = owner[order], np.concatenate(weights)[order]
        self.sizes = np.bincount(at, minlength=len(self.terms))
        self.begin = np.cumsum(self.sizes) - self.sizes

    def set_weights(self, by_term: np.ndarray) -> None:
        """BM25: every query's weight of a term is the term's."""
        self.value = np.repeat(by_term, self.sizes)

    def set_shares(self, shares: np.ndarray) -> None:
        """Chooses the terms that are multiplied densely, by the shares of targets that have them."""
        worth = shares * self.sizes / len(self.ids)
        if np.count_nonzero(worth > DENSE_SHARE) > WIDE_TERMS:
            self._deal()
            return
        most = np.argsort(-worth, kind="stable")[: DENSE_CELLS // len(self.ids)]
        most = most[worth[most] > DENSE_SHARE]
        self.column = np.full(len(self.terms), -1, np.int32)
        self.column[most] = np.arange(len(most), dtype=np.int32)

    def _deal(self) -> None:
        """Deals the queries into parts of like ones."""
        n, term = len(self.ids), np.repeat(np.arange(len(self.terms)), self.sizes)
        count = lambda x: np.bincount(term, x, len(self.terms)) / n
        telling = np.argsort(count(self.value) ** 2 - count(self.value**2), kind="stable")[:TELLING]
        self.telling = np.full(len(self.terms), -1, np.int32)
        self.telling[telling] = np.arange(len(telling), dtype=np.int32)
        self.centres = _centres(_telling(self, self.query, term, self.value, n))
        own = _nearest(self, self.query, term, self.value, n)
        group, place = np.zeros(n, np.int64), np.zeros(n, np.int32)
        for number, some in enumerate(_runs(own)):
            group[some], place[some] = number, np.arange(len(some))
            self.parts.append(Part([self.ids[k] for k in some.tolist()]))
        entry = group[self.query]
        order = np.argsort(entry, kind="stable")
        ends = np.cumsum(np.bincount(entry, minlength=len(self.parts)))
        for part, some in zip(self.parts, np.split(order, ends[:-1]), strict=True):
            part.query, part.value = place[self.query[some]], self.value[some]
            part.sizes = np.bincount(term[some], minlength=len(self.terms))
            part.begin = np.cumsum(part.sizes) - part.sizes
        self.query = self.value = self.sizes = self.begin = None  # the parts have them

    @cached_property
    def places(self) -> Places:
        return Places(self.terms)

    def dense(self) -> np.ndarray:
        """The frequent terms' weights, a row a term and a column a query."""
        column = np.repeat(self.column, self.sizes)
        used = column >= 0
        out = np.zeros((int(self.column.max(initial=-1)) + 1, len(self.ids)))
        out[column[used], self.query[used]] = self.value[used]
        return out


@dataclass
class Part:
    """Like queries of a block: their entries ordered by the block's terms, and where each term's begin."""

    ids: list
    query: np.ndarray | None = None
    value: np.ndarray | None = None
    sizes: np.ndarray | None = None
    begin: np.ndarray | None = None

    def dense(self) -> tuple[np.ndarray, np.ndarray]:
        """The weights of the terms that may be frequent, a row a term and a column a query, and each term's row or -1."""
        n = len(self.ids)
        most = np.argsort(-self.sizes, kind="stable")[:TILE_TERMS]
        most = np.sort(most[self.sizes[most] > DENSE_SHARE * n])
        place = np.full(len(self.sizes), -1, np.int32)
        place[most] = np.arange(len(most), dtype=np.int32)
        size = self.sizes[most]
        at = np.arange(size.sum()) + np.repeat(self.begin[most] - (np.cumsum(size) - size), size)
        out = np.zeros((len(most), n))
        out[np.repeat(np.arange(len(most)), size), self.query[at]] = self.value[at]
        return out, place


def _telling(block: Block, row: np.ndarray, term: np.ndarray, w: np.ndarray, rows: int) -> np.ndarray:
    """Vectors over the telling terms only."""
    column = block.telling[term]
    used = column >= 0
    out = np.zeros((rows, int(block.telling.max()) + 1), np.float32)
    out[row[used], column[used]] = w[used]
    return out


def _centres(x: np.ndarray) -> np.ndarray:
    """Unit vectors, as columns, about which the rows of x lie.

    Four times as many begin at rows drawn by a fixed seed and move to the means of their rows; then the two whose rows lose least by it are joined
    again and again, so few odd rows do not hold a centre that many need.
    """
    x = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
    sums = x[np.random.default_rng(0).permutation(len(x))[: 4 * CENTRES]]
    for _ in range(6):
        near = np.argmax(x @ (sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)).T, axis=1)
        own = near == np.arange(len(sums))[:, None]
        sums = (own @ x)[own.any(axis=1)]
    n = np.bincount(near, minlength=len(own))[own.any(axis=1)].astype(float)
    while len(sums) > CENTRES:
        unit = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
        loss = (1 - unit @ unit.T) * np.outer(n, n) / np.add.outer(n, n) + np.diag(np.full(len(n), np.inf))
        a, b = np.unravel_index(np.argmin(loss), loss.shape)
        sums[a] += sums[b]
        n[a] += n[b]
        sums, n = np.delete(sums, b, axis=0), np.delete(n, b)
    return (sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)).T


def _nearest(block: Block, row: np.ndarray, term: np.ndarray, w: np.ndarray, rows: int) -> np.ndarray:
    return np.argmax(_telling(block, row, term, w, rows) @ block.centres, axis=1)


def _runs(group: np.ndarray) -> list[np.ndarray]:
    """The places of all rows, at most TILE at a time and one group's where that has a quarter of a tile."""
    order = np.argsort(group, kind="stable")
    sizes = np.bincount(group)
    out, first, end = [], 0, 0
    for size in sizes.tolist():
        end += size
        if end - first >= TILE // 4 or end == len(order) and end > first:
            out += np.array_split(order[first:end], -(-(end - first) // TILE))
            first = end
    return out


class Best:
    """The k best targets of each query of a block so far, by falling score and rising id."""

    def __init__(self, n: int, k: int):
        self.n, self.k = n, k
        self.query, self.score, self.target = np.zeros(0, np.int64), np.zeros(0), None
        self.least, self.last = np.zeros(n), None
        self.waiting: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.pending = 0

    def hits(self, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, query and rounded score of what may be among the best; scores has a column a query."""
        slack = 10.0**-PLACES
        least = np.maximum(self.least - slack, 0.4 * slack)
        hit = scores > least
        if len(scores) > 2 * self.k and np.count_nonzero(hit) > 2 * self.n * self.k:
            # What is not among the k best of these targets is not among those of all.
            place = len(scores) - self.k
            hit = scores > np.maximum(least, np.partition(scores, place, axis=0)[place] - slack)
        at = np.flatnonzero(hit)
        row, query = np.divmod(at, self.n)
        score = np.round(scores.reshape(-1)[at], PLACES)
        keep = (score > 0) & (score >= self.least[query])
        return row[keep], query[keep], score[keep]

    def add(self, query: np.ndarray, score: np.ndarray, target: np.ndarray) -> None:
        if self.last is not None:
            # Of equal scores the smaller ids stay, so most of many equal ones need no sorting.
            keep = (score > self.least[query]) | (target < self.last[query])
            query, score, target = query[keep], score[keep], target[keep]
        self.waiting.append((query, score, target))
        self.pending += len(query)
        if self.pending > 2 * self.n * self.k:
            self.settle()

    def settle(self) -> None:
        if not self.waiting:
            return
        parts = self.waiting if self.target is None else [(self.query, self.score, self.target), *self.waiting]
        query, score, target = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.lexsort((target, -score, query))
        query, score, target = query[order], score[order], target[order]
        begin = np.searchsorted(query, np.arange(self.n))
        rank = np.arange(len(query)) - begin[query]
        keep = rank < self.k
        last = rank == self.k - 1
        self.least[query[last]] = score[last]
        self.last = np.empty(self.n, target.dtype)
        self.last[query[last]] = target[last]
        self.query, self.score, self.target = query[keep], score[keep], target[keep]
        self.waiting, self.pending = [], 0


class Pool:
    """Distinct texts of a channel's targets, each with the k smallest ids that have it.

    BM25 scores also depend on the row's size, so there a text is one of its size. Words that stand in another order
    give the same vector if they are not too many to be sorted, unless phrases count.
    """

    def __init__(self, ordered: bool, k: int):
        self.ordered, self.k = ordered, k
        self.clear()

    def clear(self) -> None:
        self.known: dict[tuple[str, float], int] = {}
        self.places: list[np.ndarray] = []
        self.ids: list[np.ndarray] = []

    def add(self, texts: list[str], sizes: list[float], ids: np.ndarray) -> int:
        """Takes the targets in; the characters that came with them."""
        known, before = self.known, len(self.known)
        if not self.ordered:
            texts = [" ".join(sorted(x.split(" "))) if len(x) <= POOL_ORDERED else x for x in texts]
        self.places.append(np.array([known.setdefault(x, len(known)) for x in zip(texts, sizes, strict=True)], np.int64))
        self.ids.append(ids)
        return sum(len(x[0]) for x in islice(reversed(known), len(known) - before))

    def taken(self) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Texts, their sizes, and of each the beginning and number of its ids, which come last."""
        place, ids = np.concatenate(self.places), np.concatenate(self.ids)
        order = np.lexsort((ids, place))
        place, ids = place[order], ids[order]
        number = np.bincount(place, minlength=len(self.known))
        begin = np.cumsum(number) - number
        out = [x for x, _ in self.known], np.array([n for _, n in self.known], float), begin, np.minimum(number, self.k), ids
        self.clear()
        return out


def _product(block: Block, dense: np.ndarray, row: np.ndarray, term: np.ndarray, w: np.ndarray, rows: int) -> np.ndarray:
    """Scores of target vectors (row, place among the block's terms, weight) with a column a query."""
    column = block.column[term]
    if len(dense):
        used = column >= 0
        left = np.zeros((rows, len(dense)))
        left[row[used], column[used]] = w[used]
        scores = left @ dense
        row, term, w = row[~used], term[~used], w[~used]
    else:
        scores = np.zeros((rows, len(block.ids)))
    _add_lists(block, block.sizes, scores, row, term, w)
    return scores


def _add_lists(block: Block, sizes: np.ndarray, scores: np.ndarray, row: np.ndarray, term: np.ndarray, w: np.ndarray) -> None:
    """Adds the products of targets' entries with those of all queries that have their term; sizes are the lists'."""
    flat, size = scores.reshape(-1), sizes[term]
    ends, first = np.cumsum(size), 0
    # Some entries of targets at a time, each with the entries of all queries that have its term.
    while first < len(size):
        low = ends[first] - size[first]
        stop = max(first + 1, int(np.searchsorted(ends, low + GATHERED, "right")))
        n = size[first:stop]
        at = np.arange(ends[stop - 1] - low) + np.repeat(block.begin[term[first:stop]] - (ends[first:stop] - n - low), n)
        np.add.at(flat, np.repeat(row[first:stop] * scores.shape[1], n) + block.query[at], np.repeat(w[first:stop], n) * block.value[at])
        first = stop


def _grouped(vectors: tuple[np.ndarray, np.ndarray, np.ndarray], begin: np.ndarray, number: np.ndarray, ids: np.ndarray, k: int) -> tuple:
    """The same arguments with one row for all texts (ordered by row) that have the same vector, and the k smallest ids of it."""
    row, term, w = vectors
    has, start, size = np.unique(row, return_index=True, return_counts=True)
    if not len(has):
        return vectors, begin, number, ids
    bits = mix(term.astype(np.uint64) * _ODD + np.ascontiguousarray(w, np.float64).view(np.uint64))
    _, first, group = np.unique(np.add.reduceat(bits, start), return_index=True, return_inverse=True)
    if 2 * len(first) > len(has):
        return vectors, begin, number, ids
    # A hash may lie: what differs from its group's first vector stays on its own.
    like, at = first[group], np.arange(len(row)) - np.repeat(start, size)
    other = np.minimum(np.repeat(start[like], size) + at, len(row) - 1)
    same = (size == size[like]) & np.logical_and.reduceat((term == term[other]) & (w == w[other]), start)
    like = np.where(same, like, np.arange(len(has)))
    leads = like == np.arange(len(has))
    entries = np.repeat(leads, size)
    group = (np.cumsum(leads) - 1)[like]
    n = number[has]
    owner, ids = np.repeat(group, n), ids[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n - begin[has], n)]
    order = np.lexsort((ids, owner))
    owner, ids = owner[order], ids[order]
    number = np.bincount(owner, minlength=int(leads.sum()))
    begin = np.cumsum(number) - number
    return (np.repeat(group, size)[entries], term[entries], w[entries]), begin, np.minimum(number, k), ids


def _tile(part: Part, dense: np.ndarray, place: np.ndarray, row: np.ndarray, term: np.ndarray, w: np.ndarray, rows: int, counts: np.ndarray) -> np.ndarray:
    """Scores of some texts (row, place among the block's terms, weight; counts by term) with a column a query of the part."""
    pick = np.flatnonzero((place >= 0) & (counts * part.sizes > DENSE_SHARE * rows * len(part.ids)))
    column = np.full(len(place), -1, np.int32)
    column[pick] = np.arange(len(pick), dtype=np.int32)
    own = column[term]
    used = own >= 0
    left = np.zeros((rows, len(pick)))
    left[row[used], own[used]] = w[used]
    scores = left @ (dense if len(pick) == len(dense) else dense[place[pick]])
    rest = np.flatnonzero(~used & (part.sizes > 0)[term])
    _add_lists(part, part.sizes, scores, row[rest], term[rest], w[rest])
    return scores


def _keep(best: Best, found: tuple[np.ndarray, np.ndarray, np.ndarray], text: np.ndarray, begin: np.ndarray, number: np.ndarray, ids: np.ndarray) -> None:
    """Adds the ids of the texts that were found; text has the texts of the rows."""
    hit, query, score = found
    if len(hit):
        n = number[text[hit]]
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(begin[text[hit]], n)
        best.add(np.repeat(query, n), np.repeat(score, n), ids[at])


def _offer_tiles(block: Block, vectors: tuple[np.ndarray, np.ndarray, np.ndarray], bests: list[Best], begin: np.ndarray, number: np.ndarray, ids: np.ndarray) -> None:
    """Multiplies the vectors of some texts (ordered by row) with the parts of a block, like texts at a time, and keeps the best of their ids."""
    (row, term, w), begin, number, ids = _grouped(vectors, begin, number, ids, bests[0].k)
    has, row, size = np.unique(row, return_inverse=True, return_counts=True)
    start = np.cumsum(size) - size
    runs = []
    for some in _runs(_nearest(block, row, term, w, len(has))):
        n = size[some]
        at = np.arange(n.sum()) + np.repeat(start[some] - (np.cumsum(n) - n), n)
        runs.append((has[some], (np.repeat(np.arange(len(some)), n), term[at], w[at], len(some), np.bincount(term[at], minlength=len(block.terms)))))
    for part, best in zip(block.parts, bests, strict=True):
        dense, place = part.dense()
        for text, tile in runs:
            _keep(best, best.hits(_tile(part, dense, place, *tile)), text, begin, number, ids)


def _offer(block: Block, dense: np.ndarray, vectors: tuple[np.ndarray, np.ndarray, np.ndarray], rows: int, best: Best, begin: np.ndarray, number: np.ndarray, ids: np.ndarray) -> None:
    """Multiplies the vectors of some texts (ordered by row) with the block and keeps the best of their ids."""
    (row, term, w), begin, number, ids = _grouped(vectors, begin, number, ids, best.k)
    # A large dense part is read as a whole for each run of texts, so that runs are longer then.
    height = max(1, max(SCORE_CELLS, min(dense.size >> 3, MOST_CELLS)) // len(block.ids))
    # Texts without any term of the block are passed over.
    has, row = np.unique(row, return_inverse=True)
    for first in range(0, len(has), height):
        low, high = np.searchsorted(row, [first, first + height])
        _keep(best, best.hits(_product(block, dense, row[low:high] - first, term[low:high], w[low:high], min(height, len(has) - first))), has[first : first + height], begin, number, ids)


def _ids(column: pa.Array) -> np.ndarray:
    return np.array(column.to_pylist()) if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else column.to_numpy(zero_copy_only=False)


def _phrase_counts(block: Block, lengths: list[int], texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, place among the block's terms, and frequency of the block's phrases in the texts."""
    row, words = Points(_folded(block.channel, texts)).words("LN")
    rows, places = [], []
    for length in lengths:
        r, h = phrases(row, words, length)
        at, known = block.places.of(h)
        rows.append(r[known])
        places.append(at[known])
    key, f = np.unique(np.concatenate(rows) * len(block.terms) + np.concatenate(places), return_counts=True)
    row, at = np.divmod(key, len(block.terms))
    return row, at, f


def _frequencies(targets: DataFrame, blocks: list[tuple[Block, list[int]]], fields: list[str]) -> None:
    """Sets the BM25 weights of the blocks: inverse document frequencies of their own phrases."""
    shared = targets.sparkSession.sparkContext.broadcast(blocks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, n = [np.zeros(len(b.terms), np.int64) for b, _ in shared.value], 0
        for batch in batches:
            n += batch.num_rows
            for k, (block, lengths) in enumerate(shared.value):
                texts = _strings(batch.column(fields.index(block.channel.field)))
                for first, end in chunks(texts):
                    _, at, _ = _phrase_counts(block, lengths, texts[first:end])
                    counts[k] += np.bincount(at, minlength=len(block.terms))
        for k, c in enumerate([np.array([n]), *counts]):
            at = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), k, np.int32)), pa.array(at.astype(np.int64)), pa.array(c[at].astype(np.int64))], names=["block", "place", "df"])

    counts = targets.select(*fields).mapInArrow(run, "block int, place long, df long").groupBy("block", "place").agg(F.sum("df").alias("df")).toArrow()  # one row a term of the blocks
    number, place, df = (counts.column(c).to_numpy() for c in ("block", "place", "df"))
    n = int(df[number == 0].sum())
    for k, (block, _) in enumerate(blocks):
        own = number == k + 1
        total = np.zeros(len(block.terms))
        total[place[own]] = df[own]
        block.set_weights(np.maximum(np.log((n - total + 0.5) / (total + 0.5)), IDF_FLOOR))
        block.set_shares(total / max(n, 1))
    shared.unpersist()


def search(queries: DataFrame, targets: DataFrame, channels: list[Channel], k: int = TOP_K, block_entries: int = BLOCK_ENTRIES, block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """qid, rid, channel, score, rank: the k best targets of each query in each channel.

    queries: qid and the channels' fields. targets: rid, the fields, and row_size (number of tokens of all
    indexed fields) if a channel is BM25, whose scores are negative.
    """
    spark = queries.sparkSession
    fields = list(dict.fromkeys(c.field for c in channels))
    has_bm25 = any(c.kind == "bm25" for c in channels)
    targets = spread(targets.select("rid", *fields, *(["row_size"] if has_bm25 else [])))
    # A channel that differs from an earlier one only in a field of the same texts has that one's lists.
    first_of = alike([queries, targets], fields)
    searched: dict[Channel, list[str]] = {}
    for c in channels:
        searched.setdefault(replace(c, name="", field=first_of[c.field]), []).append(c.name)
    channels = [replace(c, name=names[0]) for c, names in searched.items()]
    vocabulary = vocabularies(targets, {c.name: (c.field, c.analyzer) for c in channels if c.kind == "tfidf"}) if any(c.kind == "tfidf" for c in channels) else {}
    vectors = _query_vectors(queries, channels, vocabulary).withColumn("vector", F.md5(F.concat("terms", "weights")))
    mean = float(targets.agg(F.avg("row_size")).first()[0] or 1.0) if has_bm25 else 1.0
    kinds = {c: dict(df.dtypes)[c] for df, c in ((queries, "qid"), (targets, "rid"))}
    schema = f"vector string, rid {kinds['rid']}, channel int, score double"
    distinct = stage(vectors.dropDuplicates(["channel", "vector"]).select("channel", "vector", "terms", "weights", "size"), "distinct-vectors")
    totals = {r.channel: r for r in distinct.groupBy("channel").agg(F.sum("size").alias("entries"), F.count(F.lit(1)).alias("n")).collect()}  # a row a channel
    parts = []
    for c in sorted(totals):
        n = max(1, -(-totals[c].entries // block_entries), -(-totals[c].n // block_queries))
        parts += [(c, number, n, totals[c].entries / n) for number in range(n)]
    passes: list[list[tuple]] = []
    for part in parts:
        if passes and sum(x[3] for x in passes[-1]) + part[3] <= block_entries and part[1] == 0:
            passes[-1].append(part)
        else:
            passes.append([part])
    words = {c.name: spark.sparkContext.broadcast(vocabulary[c.name]) for c in channels if c.kind == "tfidf"}

    def scored(wanted: list[tuple]) -> DataFrame:
        blocks: list[tuple[int, Block, list[int]]] = []
        for c, number, n, _ in wanted:
            rows = distinct.filter((F.col("channel") == c) & (F.pmod(F.xxhash64("vector"), F.lit(n)) == number)).select("vector", "terms", "weights").toArrow()  # about block_entries entries
            if rows.num_rows:
                terms = [np.frombuffer(x.as_buffer(), np.uint64) for x in rows.column("terms")]
                weights = [np.frombuffer(x.as_buffer()) for x in rows.column("weights")]
                lengths = np.unique(np.concatenate(weights)).astype(int).tolist() if channels[c].kind == "bm25" else []
                blocks.append((c, Block(channels[c], rows.column("vector").to_pylist(), terms, weights), lengths))
        used = list(dict.fromkeys(b.channel.field for _, b, _ in blocks))
        sized = any(b.channel.kind == "bm25" for _, b, _ in blocks)
        if bm25 := [(b, lengths) for _, b, lengths in blocks if b.channel.kind == "bm25"]:
            _frequencies(targets, bm25, used)
        for _, b, _ in blocks:
            if b.channel.kind == "tfidf":
                v = vocabulary[b.channel.name]
                b.set_shares(v.shares[v.places.of(b.terms)[0]])
        shared = spark.sparkContext.broadcast(blocks)
        known = {b.channel.name: words[b.channel.name] for _, b, _ in blocks if b.channel.kind == "tfidf"}

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            mine = shared.value
            best = [[Best(len(part.ids), k) for part in b.parts or [b]] for _, b, _ in mine]
            pools = [Pool(lengths not in ([], [1]) or b.channel.fold, k) for _, b, lengths in mine]

            def flush() -> None:
                for (_, block, lengths), pool, top in zip(mine, pools, best, strict=True):
                    own, sizes, begin, number, ids = pool.taken()
                    dense = None if block.parts else block.dense()
                    held, low, entries = [], 0, 0
                    for first, end in chunks(own):
                        if block.channel.kind == "bm25":
                            row, at, f = _phrase_counts(block, lengths, own[first:end])
                            w = f * (K1 + 1) / (f + K1 * (1 - B + B * sizes[first:end][row] / mean))
                        else:
                            v = known[block.channel.name].value
                            row, at, w = v.vectors(own[first:end])
                            at, shared_terms = block.places.of(v.terms[at]) if len(row) else (at, np.zeros(0, bool))
                            row, at, w = row[shared_terms], at[shared_terms], w[shared_terms]
                        if not block.parts:
                            _offer(block, dense, (row, at, w), end - first, top[0], begin[first:end], number[first:end], ids)
                            continue
                        held.append(((row + (first - low)).astype(np.int32), at.astype(np.int32), w))
                        entries += len(row)
                        if entries >= TILE_ENTRIES or end == len(own):
                            _offer_tiles(block, tuple(map(np.concatenate, zip(*held, strict=True))), top, begin[low:end], number[low:end], ids)
                            held, low, entries = [], end, 0

            waiting = 0
            for batch in batches:
                ids = _ids(batch.column(0))
                sizes = batch.column(len(used) + 1).to_pylist() if sized else None
                texts = {f: _strings(batch.column(1 + at)) for at, f in enumerate(used)}
                for (_, block, _), pool in zip(mine, pools, strict=True):
                    waiting += pool.add(texts[block.channel.field], sizes if block.channel.kind == "bm25" else [0.0] * len(ids), ids)
                if waiting > POOL_CHARS:
                    flush()
                    waiting = 0
            if pools and pools[0].places:
                flush()
            for number, kind, part, top in [(number, b.channel.kind, part, top) for (number, b, _), tops in zip(mine, best, strict=True) for part, top in zip(b.parts or [b], tops, strict=True)]:
                top.settle()
                if top.target is not None:
                    score = -top.score if kind == "bm25" else top.score
                    columns = [pa.array(part.ids).take(pa.array(top.query)), pa.array(top.target), pa.array(np.full(len(score), number, np.int32)), pa.array(score)]
                    yield pa.RecordBatch.from_arrays(columns, names=["vector", "rid", "channel", "score"])

        return targets.select("rid", *used, *(["row_size"] if sized else [])).mapInArrow(run, schema)

    found = append_stages(spark, (scored(x) for x in passes), "channel-bests", schema) if passes else spark.createDataFrame([], schema)
    best = Window.partitionBy("channel", "vector").orderBy(F.desc(F.abs("score")), "rid")
    found = stage(found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k), "vector-bests")
    ranked = vectors.select("qid", "channel", "vector").join(found, ["channel", "vector"])
    if not vectors.groupBy("channel", "qid").count().filter("count > 1").isEmpty():
        # Rows with the same qid have one list; any other list is its vector's.
        best = Window.partitionBy("channel", "qid").orderBy(F.desc(F.abs("score")), "rid")
        ranked = ranked.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    names = F.get(F.array(*(F.array(*map(F.lit, x)) for x in searched.values())), F.col("channel"))
    return ranked.select("qid", "rid", F.explode(names).alias("channel"), "score", F.col("rank").cast("long").alias("rank"))


# ---------------------------------------------------------------- one channel, and all of them


def tfidf_topk(queries: DataFrame, targets: DataFrame, k: int = TOP_K, analyzer: Analyzer = CHAR) -> DataFrame:
    """queries (qid, text), targets (rid, text): the k most similar targets of each query by cosine."""
    return search(queries, targets, [Channel("tfidf_text", "text", "tfidf", analyzer)], k).drop("channel")


def bm25_topk(queries: DataFrame, targets: DataFrame, k: int = TOP_K, max_tokens: int = MAX_TOKENS, fold: bool = False) -> DataFrame:
    """queries (qid, text), targets (rid, text, row_size): the k best targets by BM25, whose scores are negative.

    row_size is the number of tokens of all indexed fields of the row; frequencies are the field's own (V5).
    """
    return search(queries, targets, [Channel("bm25_text", "text", "bm25", max_tokens=max_tokens, fold=fold)], k).drop("channel")


def sized(targets: DataFrame, fields: list[str]) -> DataFrame:
    """rid, the fields and row_size, written once, as all channels need it."""
    size = sum((F.size(search_tokens(F.coalesce(F.col(f), F.lit("")))) for f in fields), F.lit(0))
    return stage(spread(targets.select("rid", *fields)).withColumn("row_size", size), "sized")


def bm25_union(queries: DataFrame, targets: DataFrame, fields: list[str], k: int = TOP_K) -> DataFrame:
    """Distinct (qid, rid) that any field's BM25 list has."""
    return search(queries, sized(targets, fields), [Channel(f"bm25_{f}", f, "bm25") for f in fields], k).select("qid", "rid").distinct()


def tfidf_union(queries: DataFrame, targets: DataFrame, fields: list[str], k: int = TOP_K, analyzer: Analyzer = LEGACY) -> DataFrame:
    return search(queries, targets, [Channel(f"tfidf_{f}", f, "tfidf", analyzer) for f in fields], k).select("qid", "rid").distinct()


def channels(queries: DataFrame, targets: DataFrame, fields: list[str], k: int = TOP_K, analyzer: Analyzer = CHAR, max_tokens: int = MAX_TOKENS, kinds: tuple[str, ...] = ("tfidf", "bm25")) -> DataFrame:
    """qid, rid, channel, score, rank of every retriever and field (D7). Row sizes are counted for BM25 only."""
    wanted = [Channel(f"{kind}_{f}", f, kind, analyzer, max_tokens) for f in fields for kind in kinds]
    return search(queries, sized(targets, fields) if "bm25" in kinds else targets, wanted, k)


def pair_cosines(pairs: DataFrame, wanted: dict[str, tuple[str, str, Vocabulary]]) -> DataFrame:
    """pairs with a column per wanted name: the cosine of two text columns under a vocabulary, 0 where nothing is shared."""
    shared = pairs.sparkSession.sparkContext.broadcast(wanted)
    columns = list(dict.fromkeys(c for a, b, _ in wanted.values() for c in (a, b)))
    plain = pairs.drop(*columns).columns
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in pairs.schema.fields), *(f"`{name}` double" for name in wanted)])

    def cosine(texts: list[str], other: list[str], vocabulary: Vocabulary) -> np.ndarray:
        out = np.zeros(len(texts))
        for first, end in chunks([a + b for a, b in zip(texts, other, strict=True)]):
            n = len(vocabulary.terms) or 1
            (ra, ta, wa), (rb, tb, wb) = vocabulary.vectors(texts[first:end]), vocabulary.vectors(other[first:end])
            _, x, y = np.intersect1d(ra * n + ta, rb * n + tb, assume_unique=True, return_indices=True)
            out[first:end] = np.bincount(ra[x], wa[x] * wb[y], end - first)
        return np.round(out, PLACES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = {c: _strings(batch.column(c)) for c in columns}
            found = [pa.array(cosine(texts[a], texts[b], v)) for a, b, v in shared.value.values()]
            yield pa.RecordBatch.from_arrays([*batch.columns, *found], names=[*batch.schema.names, *shared.value])

    assert set(plain) <= set(pairs.columns)
    return pairs.mapInArrow(run, schema)


def tfidf_cosine(pairs: DataFrame, targets: DataFrame, analyzer: Analyzer = CHAR) -> DataFrame:
    """pairs (a, b and other columns) with their cosine under the vocabulary of targets (text)."""
    vocabulary = vocabularies(targets, {"text": ("text", analyzer)})["text"]
    return pair_cosines(pairs, {"cosine": ("a", "b", vocabulary)})


# ---------------------------------------------------------------- dense vectors


def dense_topk(queries: DataFrame, targets: DataFrame, k: int = TOP_K, block_queries: int = 4096, rows: int = 1024) -> DataFrame:
    """queries (qid, vec), targets (rid, vec): most similar vectors by cosine, in blocks.

    About block_queries queries are sent to the tasks at a time; each task multiplies rows of its targets with
    them and keeps k a query.
    """
    spark = queries.sparkSession
    n_blocks = max(1, -(-queries.count() // block_queries))
    unit = lambda m: m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-12)
    matrix = lambda column: column.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
    targets = spread(targets.select("rid", "vec"))

    def scored(number: int) -> DataFrame:
        part = queries.select("qid", "vec").filter(F.pmod(F.xxhash64("qid"), F.lit(n_blocks)) == number).toArrow()  # about block_queries rows
        ids = part.column("qid").to_numpy()
        shared = spark.sparkContext.broadcast(unit(matrix(part.column("vec"))) if len(ids) else None)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            best = Best(len(ids), k)
            for batch in batches:
                for first in range(0, batch.num_rows if len(ids) else 0, rows):
                    some = batch.slice(first, rows)
                    score = np.round(unit(matrix(pa.chunked_array([some.column(1)]))) @ shared.value.T, PLACES)
                    t, q = np.nonzero((score > 0) & (score >= best.least))
                    best.add(q, score[t, q], some.column(0).to_numpy()[t])
            best.settle()
            if best.target is not None:
                yield pa.RecordBatch.from_arrays([pa.array(ids[best.query]), pa.array(best.target), pa.array(best.score)], names=["qid", "rid", "score"])

        return targets.mapInArrow(run, "qid long, rid long, score double")

    found = append_stages(spark, (scored(number) for number in range(n_blocks)), "dense-bests", "qid long, rid long, score double")
    best = Window.partitionBy("qid").orderBy(F.desc("score"), "rid")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).withColumn("rank", F.col("rank").cast("long"))
