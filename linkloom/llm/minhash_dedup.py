"""MinHash near-dedup: a signature-coordinate inverted join with exact confirmation.

A document is posted under each (coordinate, value) pair of its MinHash signature. Two documents that
agree in at least MATCHES of COORDINATES coordinates are candidates; each candidate pair is confirmed on
the full shingle sets. At a similarity of 0.85 a pair has fewer matches with a probability of 1.5e-7, at 0.9 of
2e-12, and is then still joined if other documents connect it.

* Prefix: coordinate-value pairs are ordered by their number of documents, rare ones first. Documents
  with m shared pairs agree in MATCHES of them only if they meet in the first m - MATCHES + 1 of each,
  so only these are posted. Pairs that one document alone has are never posted. With so high a share of
  matches a prefix is the rarest third of a signature, so groups that share a passage meet in few lists.
* Skip: documents with equal sets are one representative from the start. First each list links one hub,
  its document with the most frequent coordinate values, with its other documents; near a group's middle,
  it is the hub of many lists and connects most of the group at once. It then leaves its lists, and lists
  whose documents are all connected are done.
* Merging: the documents of the lists that remain are dealt into blocks, a large component into blocks of
  its own and others by the hub they met, and each by the size of its set, so that blocks whose sizes are too
  far apart to link are never compared. Lists are merged block by block: two blocks that share a list
  and hold different components are compared once, however many lists they share, on full sets. So every
  pair that meets in a list is tested or already connected, and no pair of documents becomes a row.
* Connection is kept by label propagation with pointer jumping over the confirmed links.

Blocks are bounded by documents and by shingles, so a hot group is many tasks' work. A hub's members are
confirmed in blocks too, with the same bounds. A coordinate value of more than HOT documents, or of more than
HOT_BLOCKS blocks, is dealt among several tasks. Counts and minima are combined before they are shuffled.
Signatures, lists and links are written to the shared folder between steps.

Defined cases: a null text, and one without words, has an empty set and is linked with nothing. A text of
one to four words is one shingle, its whole sequence. Words are compared after lower-casing A-Z. Repeated
rows with one doc_id and one text are one document; of rows with one doc_id and different texts each links as its
own text does, under the one id. A row without doc_id is linked with nothing: its component_id is null and it is
kept. Ids are integers, or text that reads as one. A very long text is hashed alone and is a block of its own if it
has more shingles than a block. Other columns are never read. An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import BROADCAST_ROWS, drop_ids, joined_by_key, stage
from ._shingles import chunks, shingle_sets

COORDINATES, MATCHES = 64, 38
MIN_PERCENT = 85
#: Members of a hub, or documents of a block, that are compared together, and the shingles that a block aims at.
BLOCK, BLOCK_SHINGLES = 128, 1 << 19
#: Documents of a coordinate value, and blocks of one, that are one task's work.
HOT, HOT_BLOCKS = 1024, 256
#: Shingles that are counted at once when two blocks are compared.
_COLUMNS = 1 << 13

_SEEDS = np.random.Generator(np.random.PCG64(11)).integers(0, 1 << 63, (2, COORDINATES), dtype=np.uint64)
_ODD = _SEEDS[1] * np.uint64(2) + np.uint64(1)
_SIGNATURE = "doc_id long, n_shingles long, d1 long, d2 long, sig array<int>"


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, end, data, offsets in chunks(batch.column(1)):
            rows, h = shingle_sets(data, offsets)
            n = end - first
            size = np.bincount(rows, minlength=n)
            has = np.flatnonzero(size)
            at = np.searchsorted(rows, has)
            digests, sig = np.zeros((2, n), np.uint64), np.zeros((n, COORDINATES), np.uint32)
            if len(has):
                for d in range(2):
                    digests[d, has] = np.add.reduceat((h ^ (h >> np.uint64(29))) * _ODD[d] ^ (h >> np.uint64(17)), at)
                for k in range(COORDINATES):
                    v = (h ^ _SEEDS[0, k]) * _ODD[k]
                    # The low half of a minimum is as random as a hash; the high half is near 0 in large sets.
                    sig[has, k] = np.minimum.reduceat(v ^ (v >> np.uint64(32)), at).astype(np.uint32)
            values = pa.array(sig[has].reshape(-1).view(np.int32))
            ends = np.concatenate([[0], np.cumsum((size > 0) * COORDINATES)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(first, n), pa.array(size.astype(np.int64)), *(pa.array(d.view(np.int64)) for d in digests), pa.ListArray.from_arrays(pa.array(ends), values)],
                names=["doc_id", "n_shingles", "d1", "d2", "sig"],
            )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replaces the text, the first column, by its sorted set of hashes."""
    for batch in batches:
        for first, end, data, offsets in chunks(batch.column(0)):
            rows, h = shingle_sets(data, offsets)
            ends = np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=end - first))]).astype(np.int64) * 8
            sets = pa.LargeBinaryArray.from_buffers(pa.large_binary(), end - first, [None, pa.py_buffer(ends), pa.py_buffer(h)]).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([sets, *(c.slice(first, end - first) for c in batch.columns[1:])], names=batch.schema.names)


def _confirm(min_percent: int):
    def confirm(table: pa.Table) -> pa.Table:
        ids, hub = table.column("doc_id").to_pylist(), table.column("is_hub").to_pylist()
        sets = [np.frombuffer(x, np.uint64) for x in table.column("shingles").to_pylist()]
        at = hub.index(True) if True in hub else -1
        a, b = [], []
        for k in range(len(ids)):
            if at >= 0 and not hub[k] and ids[k] != ids[at]:
                x, y = (sets[at], sets[k]) if len(sets[at]) >= len(sets[k]) else (sets[k], sets[at])
                if 100 * len(y) < min_percent * len(x):
                    continue
                place = np.searchsorted(x, y)
                both = int(np.count_nonzero(x[np.minimum(place, len(x) - 1)] == y))
                if 100 * both >= min_percent * (len(x) + len(y) - both):
                    a.append(ids[at])
                    b.append(ids[k])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return confirm


def _parts(n_shingles: Column) -> Column:
    """The number of blocks for a group of documents."""
    return F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum(n_shingles) / BLOCK_SHINGLES))


def _size_class(min_percent: int) -> Column:
    """Sets that are similar enough are of one size class or of neighbouring ones."""
    return F.floor(F.log(F.col("n_shingles").cast("double")) / (math.log(100 / min_percent) * (1 + 1e-9)) if min_percent < 100 else F.col("n_shingles")).cast("long")


def confirmed(docs: DataFrame, pairs: DataFrame, min_percent: int) -> DataFrame:
    """The pairs (a a hub, b) whose full sets are similar enough. pairs (a, b, n shingles of b) is staged, docs has doc_id and text."""
    blocks = pairs.groupBy("a").agg(_parts(F.col("n")).alias("blocks"))
    spread = pairs.join(blocks, "a").select("a", "b", F.pmod(F.xxhash64("b"), "blocks").alias("block"))
    members = spread.select(F.col("b").alias("doc_id"), "a", "block", F.lit(False).alias("is_hub"))
    hubs = blocks.select(F.col("a").alias("doc_id"), "a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"), F.lit(True).alias("is_hub"))
    roles = members.unionByName(hubs)
    # There are at most twice as many roles as pairs.
    roles = F.broadcast(roles) if 2 * pairs.count() <= BROADCAST_ROWS else roles
    texts = docs.join(roles, "doc_id").select("text", "doc_id", "a", "block", "is_hub")
    sets = texts.mapInArrow(_sets, "shingles binary, doc_id long, a long, block long, is_hub boolean")
    return sets.groupBy("a", "block").applyInArrow(_confirm(min_percent), "a long, b long")


def _merge(min_percent: int):
    def merge(table: pa.Table) -> pa.Table:
        """Links that span the components of the two sides; both sides are the same block if there is one side."""
        ids, comp, side = (table.column(c).to_numpy() for c in ("doc_id", "comp", "side"))
        sets = [np.frombuffer(x, np.uint64) for x in table.column("shingles").to_pylist()]
        size = np.array([len(x) for x in sets])
        left = np.flatnonzero(side == 0)
        right = np.flatnonzero(side == 1) if side.any() else left
        _, column, uses = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        row = np.repeat(np.arange(len(sets)), size)[uses[column] > 1]
        column = (np.cumsum(uses > 1) - 1)[column[uses[column] > 1]]
        order = np.argsort(column, kind="stable")
        row, column = row[order], column[order]
        both = np.zeros((len(left), len(right)), np.int64)
        for first in range(0, int(column[-1]) + 1 if len(column) else 0, _COLUMNS):
            low, high = np.searchsorted(column, [first, first + _COLUMNS])
            has = np.zeros((len(sets), _COLUMNS), np.float32)
            has[row[low:high], column[low:high] - first] = 1
            both += (has[left] @ has[right].T).astype(np.int64)
        union = size[left][:, None] + size[right][None, :] - both
        near = (100 * both >= min_percent * union) & (comp[left][:, None] != comp[right][None, :])
        parent: dict[int, int] = {}

        def top(x: int) -> int:
            while parent.get(x, x) != x:
                x = parent[x]
            return x

        a, b = [], []
        for i, j in np.argwhere(near):
            x, y = top(int(comp[left[i]])), top(int(comp[right[j]]))
            if x != y:
                parent[max(x, y)] = min(x, y)
                a.append(ids[left[i]])
                b.append(ids[right[j]])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return merge


def merged(docs: DataFrame, rest: DataFrame, met: DataFrame, min_percent: int) -> DataFrame:
    """Links between the components of the documents that share a list of rest (tok, doc, n_shingles, comp), staged.

    met (a a hub, b) says which documents are dealt into blocks together.
    """
    own = stage(rest.select("doc", "n_shingles", "comp").distinct(), "minhash-rest-docs")
    degree = met.groupBy("a").agg(F.count(F.lit(1)).alias("degree"))
    anchors = met.join(degree, "a").groupBy(F.col("b").alias("doc")).agg(F.max(F.struct("degree", "a"))["a"].alias("anchor"))
    large = own.groupBy("comp").count().filter(F.col("count") >= BLOCK // 2).select("comp", F.col("comp").alias("large"))
    keyed = own.join(anchors, "doc", "left").join(large, "comp", "left").withColumns({"key": F.coalesce("large", "anchor", "doc"), "class": _size_class(min_percent)})
    keyed = stage(keyed, "minhash-keyed")
    dealt = keyed.join(keyed.groupBy("key", "class").agg(_parts(F.col("n_shingles")).alias("parts")), ["key", "class"])
    members = stage(dealt.select("doc", "comp", "class", F.xxhash64("key", "class", F.pmod(F.xxhash64("doc"), "parts")).alias("block")), "minhash-blocks")
    posts = rest.select("tok", "doc").join(members, "doc").groupBy("tok", "block", "class").agg(F.min("comp").alias("low"), F.max("comp").alias("high"))
    posts = stage(posts, "minhash-block-posts")
    sides = [posts.select("tok", *(F.col(c).alias(n) for c, n in (("block", x), ("low", f"low_{x}"), ("high", f"high_{x}"), ("class", f"class_{x}")))) for x in "ab"]
    hot = posts.groupBy("tok").agg(F.ceil(F.count(F.lit(1)) / HOT_BLOCKS).alias("parts")).filter("parts > 1")
    meet = joined_by_key(sides[0], sides[1], "tok", hot, "a").filter("a <= b and abs(class_a - class_b) <= 1 and least(low_a, low_b) < greatest(high_a, high_b)").select("a", "b").distinct()
    meet = stage(meet, "minhash-block-pairs")
    sets = docs.join(members.select(F.col("doc").alias("doc_id")), "doc_id", "left_semi").select("text", "doc_id")
    sets = stage(sets.mapInArrow(_sets, "shingles binary, doc_id long").dropDuplicates(["doc_id"]), "minhash-sets")
    full = members.join(sets, members["doc"] == sets["doc_id"]).select("block", "doc_id", "comp", "shingles")
    roles = meet.select("a", "b", F.col("a").alias("block"), F.lit(0).alias("side"))
    roles = roles.unionByName(meet.filter("a < b").select("a", "b", F.col("b").alias("block"), F.lit(1).alias("side")))
    return stage(roles.join(full, "block").groupBy("a", "b").applyInArrow(_merge(min_percent), "a long, b long"), "minhash-links")


def components(edges: DataFrame) -> DataFrame:
    """(node, comp) for the nodes of staged edges (a, b): comp is the smallest node that is reachable."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    labels = stage(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("comp")).select(F.col("a").alias("node"), "comp", F.lit(True).alias("moved")), "minhash-labels")
    while labels.filter("moved").limit(1).count():
        near = both.join(labels.select(F.col("node").alias("b"), "comp"), "b").groupBy(F.col("a").alias("node")).agg(F.min("comp").alias("near"))
        step = labels.join(near, "node").select("node", F.col("comp").alias("was"), F.least("comp", "near").alias("via"))
        # A jump: the label of the node that gave the label.
        jump = labels.select(F.col("node").alias("via"), F.col("comp").alias("far"))
        labels = step.join(jump, "via").select("node", F.least("via", "far").alias("comp"), (F.least("via", "far") < F.col("was")).alias("moved"))
        labels = stage(labels, "minhash-labels")
    return labels.select("node", "comp")


def _posted(sig: DataFrame, reps: DataFrame, matches: int) -> DataFrame:
    """(doc, n_shingles, tokens of all shared coordinates, prefix, weight) of each representative; the weight is high for the middle of a group."""
    own = sig.join(reps.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi").dropDuplicates(["doc_id"])
    tokens = own.select(F.col("doc_id").alias("doc"), "n_shingles", F.posexplode("sig").alias("k", "v")).select("doc", "n_shingles", F.xxhash64("k", "v").alias("tok"))
    shared = stage(tokens.groupBy("tok").count().filter("count > 1").withColumnRenamed("count", "df"), "minhash-shared")
    hot = shared.select("tok", F.ceil(F.col("df") / HOT).alias("parts")).filter("parts > 1")
    lists = joined_by_key(tokens, shared, "tok", hot, "doc").groupBy("doc", "n_shingles").agg(F.sort_array(F.collect_list(F.struct("df", "tok"))).alias("toks"))
    lists = lists.filter(F.size("toks") >= matches)
    all_toks = F.sort_array(F.transform("toks", lambda x: x["tok"])).alias("all_toks")
    weight = F.aggregate("toks", F.lit(0).cast("long"), lambda total, x: total + x["df"]).alias("weight")
    return lists.select("doc", "n_shingles", weight, all_toks, F.slice("toks", 1, F.size("toks") - (matches - 1)).alias("prefix"))


def near_groups(docs: DataFrame, min_percent: int = MIN_PERCENT, matches: int = MATCHES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, n_shingles, component_id, kept."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    sig = stage(docs.mapInArrow(_signatures, _SIGNATURE), "minhash-signatures")
    digest = ["d1", "d2", "n_shingles"]
    reps = stage(sig.filter("n_shingles > 0 and doc_id is not null").groupBy(digest).agg(F.min("doc_id").alias("rep")), "minhash-reps")
    posted = stage(_posted(sig, reps, matches), "minhash-posted")
    lists = posted.select("doc", "n_shingles", "weight", F.explode("prefix.tok").alias("tok"))
    hubs = lists.groupBy("tok").agg(F.max(F.struct("weight", "doc"))["doc"].alias("hub"), F.count(F.lit(1)).alias("n"))
    hubs = stage(hubs.filter("n > 1"), "minhash-hubs")
    hot, hubs = hubs.select("tok", F.ceil(F.col("n") / HOT).alias("parts")).filter("parts > 1"), hubs.select("tok", "hub")
    listed = joined_by_key(lists, hubs, "tok", hot, "doc")
    met = listed.filter("doc != hub").select(F.col("hub").alias("a"), F.col("doc").alias("b")).distinct()
    met = stage(met, "minhash-met")
    side = lambda name: posted.select(F.col("doc").alias(name), F.col("n_shingles").alias(f"n_{name}"), F.col("all_toks").alias(f"toks_{name}"))
    similar: Column = (100 * F.least("n_a", "n_b") >= min_percent * F.greatest("n_a", "n_b")) & (F.size(F.array_intersect("toks_a", "toks_b")) >= matches)
    candidates = stage(met.join(side("a"), "a").join(side("b"), "b").filter(similar).select("a", "b", F.col("n_b").alias("n")), "minhash-candidates")
    links = stage(confirmed(docs, candidates, min_percent), "minhash-links")
    labels = components(links)
    placed = listed.filter("doc != hub").join(labels, F.col("doc") == labels["node"], "left")
    placed = stage(placed.select("tok", "doc", "n_shingles", F.coalesce("comp", "doc").alias("comp")), "minhash-placed")
    several = placed.groupBy("tok").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).filter("low < high").select("tok")
    more = merged(docs, stage(placed.join(several, "tok", "left_semi"), "minhash-rest"), met, min_percent)
    if more.limit(1).count():
        labels = components(stage(links.unionByName(more), "minhash-links"))
    classes = reps.join(labels, reps["rep"] == labels["node"], "left").select(*digest, F.coalesce("comp", "rep").alias("component"))
    classes = stage(classes, "minhash-classes")
    out = sig.join(classes, digest, "left").select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def near_dedup(docs: DataFrame, **options) -> DataFrame:
    """The rows of docs that stay, one document of each group, with all their columns."""
    groups = stage(near_groups(docs, **options), "minhash-verdicts")
    return drop_ids(docs, groups.filter("not kept").select("doc_id"))
