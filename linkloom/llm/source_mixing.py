"""Mixing sources to target weights by hierarchical budgeting.

Documents are leaves' rows in a tree of domain, language and source. A budget of tokens enters at the root.
At each node it is shared among the children by weight; a child that cannot use its share, because its
documents are fewer even when repeated max_epochs times, takes what it can, and the rest is shared among
its siblings by weight. Only when all siblings are full does a shortage remain for the level above, where
the node's capacity is the sum of its leaves': so shortages move to siblings before ancestors. Running sums over
the siblings give the water level in closed form, so neither a loop nor the driver sees the tree. Where a level
has more than FEW nodes, its running sums are those of the ranges of one sort and of the rows within a range, so
millions of sources under one language are many tasks' work.

A leaf with budget A and T tokens takes A div T whole epochs. The rest is a prefix of the next epoch's
order, which is by a hash of seed, epoch and doc_id: documents are taken while the running sum of their
tokens is at most the rest. A leaf may hold a third of all rows, so its running sum is not one task's work:
documents are counted in cells of leading hash digits, cells are summed up per leaf, and only the cell in
which the budget ends is sorted by document. The number of digits follows the number of documents.

Only DataFrame functions are used; texts are not shuffled.

Defined cases: null domain, language or source are values of their own. A null or blank text has no tokens
and is taken with every epoch and every prefix that reaches it. Weights that a table does not name are 1.
Ties of the hash go by doc_id; repeated rows with one doc_id in one leaf are taken or left together, and count
each. A row without doc_id hashes as an empty id. A budget of more than the root's capacity takes all documents
max_epochs times. A very long text is one document like any other; one that is longer than its leaf's rest ends
the prefix. `mixed` finds rows again by doc_id, domain, language and source, and other columns may have any name.
An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ._common import WHITE, fresh, row_key, small_side, stage

SEED, MAX_EPOCHS, SHARE = 17, 2, 0.6
#: At most about so many documents are in a cell of a leaf.
CELL_DOCS = 64
#: A level of the tree with at most so many nodes has its running sums from one window a parent.
FEW = 100_000
DIGITS = 12
DOMAINS = 4
LANG_WEIGHTS = {"en": 4, "de": 2, "fr": 2, "es": 2}
DOMAIN_WEIGHTS = {"d0": 3, "d1": 2, "d2": 2, "d3": 1}
LEVELS = ("domain", "lang", "source")


def domain_of(source: Column) -> Column:
    """A stand-in for a table of domains: the source's number modulo DOMAINS."""
    digits = F.regexp_extract(F.coalesce(source, F.lit("")), "([0-9]{1,9})$", 1)
    return F.when(digits != "", F.concat(F.lit("d"), F.pmod(digits.cast("long"), F.lit(DOMAINS)).cast("string"))).otherwise("none")


def tokens_of(text: Column) -> Column:
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), WHITE), "")).cast("long")


def _weight(column: Column, weights: dict[str, float]) -> Column:
    out = F.lit(1.0)
    for name, weight in weights.items():
        out = F.when(column == name, F.lit(float(weight))).otherwise(out)
    return out


def _before(nodes: DataFrame, parent: list[str], few: int) -> DataFrame:
    """Adds used and gone: capacity and weight of the siblings that are full before a row."""
    order = [*parent, "ratio", "key"]
    if nodes.count() <= few:
        before = Window.partitionBy(*parent).orderBy("ratio", "key").rowsBetween(Window.unboundedPreceding, -1)
        return nodes.withColumns({"used": F.coalesce(F.sum("capacity").over(before), F.lit(0)), "gone": F.coalesce(F.sum("weight").over(before), F.lit(0.0))})
    ordered = nodes.orderBy(*order).withColumn("id", F.monotonically_increasing_id())
    ordered = stage(ordered.withColumn("range", F.shiftrightunsigned("id", 33)), "mix-ordered")
    ranges = ordered.groupBy(*parent, "range").agg(F.sum("capacity").alias("in_capacity"), F.sum("weight").alias("in_weight"))
    # A parent has at most as many ranges as the sort has tasks.
    upto = Window.partitionBy(*parent).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranges.select(*parent, "range", F.coalesce(F.sum("in_capacity").over(upto), F.lit(0)).alias("start_used"), F.coalesce(F.sum("in_weight").over(upto), F.lit(0.0)).alias("start_gone"))
    within = Window.partitionBy(*parent, "range").orderBy("id").rowsBetween(Window.unboundedPreceding, -1)
    own = ordered.withColumns({"used": F.coalesce(F.sum("capacity").over(within), F.lit(0)), "gone": F.coalesce(F.sum("weight").over(within), F.lit(0.0))})
    joined = own.join(stage(starts, "mix-starts"), [*parent, "range"])
    return joined.withColumns({"used": F.col("used") + F.col("start_used"), "gone": F.col("gone") + F.col("start_gone")}).drop("id", "range", "start_used", "start_gone")


def _shared(nodes: DataFrame, parent: list[str], budget: str, out: str, few: int) -> DataFrame:
    """Shares each parent's budget among its rows of nodes (weight, capacity, key): min(capacity, level * weight)."""
    nodes = stage(nodes.withColumn("ratio", F.col("capacity") / F.col("weight")), "mix-nodes")
    weights = nodes.groupBy(*parent).agg(F.sum("weight").alias("weights"))
    # The level if all rows before this one are full and this one and the later ones are not.
    level = (F.col(budget) - F.col("used")) / (F.col("weights") - F.col("gone"))
    nodes = _before(nodes, parent, few).join(small_side(stage(weights, "mix-weights")), parent).withColumn("level", level)
    nodes = nodes.withColumn("is_full", F.col("level") * F.col("weight") >= F.col("capacity"))
    water = nodes.filter("not is_full").groupBy(*parent).agg(F.min(F.struct("ratio", "key", "level"))["level"].alias("water"))
    nodes = nodes.join(small_side(stage(water, "mix-water")), parent, "left")
    # Rows before the first that is not full are full; without any such row all are.
    share = F.when(F.col("water").isNull() | F.col("is_full"), F.col("capacity").cast("double")).otherwise(F.least(F.col("capacity").cast("double"), F.col("water") * F.col("weight")))
    return nodes.withColumn(out, F.floor(share + F.lit(1e-6)).cast("long")).drop("level", "is_full", "ratio", "water", "used", "gone", "weights")


def leaf_budgets(leaves: DataFrame, share: float, max_epochs: int, weights: dict[str, dict[str, float]], few: int = FEW) -> DataFrame:
    """Adds budget to leaves (domain, lang, source as non-null text, tokens). share is of all tokens."""
    if any(not w > 0 for level in weights.values() for w in level.values()):
        raise ValueError("weights must be positive")
    name = F.concat_ws("\x1f", *LEVELS)
    leaves = leaves.withColumn("cap", F.col("tokens") * max_epochs)
    # One number; the root has no siblings to share with.
    budget = leaves.agg(F.floor(F.coalesce(F.sum("tokens"), F.lit(0)) * F.lit(float(share))).cast("long")).first()[0]
    budgeted, parent = None, []
    for depth, level in enumerate(LEVELS):
        path = [*parent, level]
        nodes = leaves.groupBy(*path).agg(F.sum("cap").alias("capacity"))
        nodes = nodes.withColumn("b0", F.lit(budget).cast("long")) if budgeted is None else nodes.join(budgeted, parent)
        nodes = nodes.withColumn("weight", _weight(F.col(level), weights.get(level, {}))).withColumn("key", F.col(level)).withColumn("root", F.lit(0))
        budgeted = _shared(nodes, parent or ["root"], f"b{depth}", f"b{depth + 1}", few).select(*path, f"b{depth + 1}")
        parent = path
    return leaves.join(budgeted.withColumnRenamed(f"b{len(LEVELS)}", "budget"), list(LEVELS)).drop("cap").withColumn("leaf", name)


def mixture(docs: DataFrame, share: float = SHARE, max_epochs: int = MAX_EPOCHS, seed: int = SEED, weights: dict[str, dict[str, float]] | None = None, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source", domain: Column | None = None) -> DataFrame:
    """One row per row of docs: doc_id, domain, lang, source, n_tokens, leaf_tokens, leaf_budget, copies."""
    weights = {"domain": DOMAIN_WEIGHTS, "lang": LANG_WEIGHTS, "source": {}} if weights is None else weights
    text = lambda c: F.coalesce(c.cast("string"), F.lit("\x00"))  # noqa: E731  keeps null apart from every value
    slim = docs.select(
        F.col(id_col).alias("doc_id"), text(domain_of(F.col(source_col)) if domain is None else domain).alias("domain"), text(F.col(lang_col)).alias("lang"), text(F.col(source_col)).alias("source"), tokens_of(F.col(text_col)).alias("n_tokens"),
    )
    slim = stage(slim, "mix-slim")
    leaves = slim.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("docs"))
    leaves = leaf_budgets(stage(leaves, "mix-leaves"), share, max_epochs, weights)
    epochs = F.when(F.col("tokens") > 0, F.expr("budget div tokens")).otherwise(F.lit(max_epochs)).cast("long")
    leaves = leaves.withColumn("epochs", epochs).withColumn("rest", F.when(F.col("tokens") > 0, F.col("budget") - F.col("epochs") * F.col("tokens")).otherwise(F.lit(0).cast("long")))
    digits = F.least(F.lit(DIGITS), F.greatest(F.lit(1), F.ceil(F.log(16.0, F.col("docs") / CELL_DOCS)))).cast("int")
    leaves = stage(leaves.select("leaf", *LEVELS, "tokens", "budget", "epochs", "rest", digits.alias("digits")), "mix-budgets")
    order = F.md5(F.concat_ws(":", F.lit(seed), "epochs", F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))
    placed = slim.join(leaves, list(LEVELS)).withColumn("order", order).withColumn("cell", F.substring("order", F.lit(1), F.col("digits")))
    placed = stage(placed.drop("digits"), "mix-placed")
    cells = stage(placed.groupBy("leaf", "cell", "rest").agg(F.sum("n_tokens").alias("inside")), "mix-cells")
    running = F.sum("inside").over(Window.partitionBy("leaf").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1))
    ended = cells.withColumn("before", F.coalesce(running, F.lit(0))).withColumn("whole", F.col("before") + F.col("inside") <= F.col("rest"))
    # The first cell that does not fit whole is the one in which the prefix ends.
    last = stage(ended.filter("not whole").groupBy("leaf").agg(F.min_by("before", "cell").alias("before"), F.min("cell").alias("last_cell")), "mix-ends")
    marked = placed.join(last, "leaf", "left")
    inside = marked.filter(F.col("cell") == F.col("last_cell")).withColumn("spot", F.concat_ws("\x1f", "leaf", "cell"))
    upto = Window.partitionBy("spot").orderBy("order", "doc_id").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    taken = inside.withColumn("upto", F.col("before") + F.sum("n_tokens").over(upto)).withColumn("more", (F.col("upto") <= F.col("rest")).cast("long"))
    whole = marked.filter(F.col("last_cell").isNull() | (F.col("cell") != F.col("last_cell"))).withColumn("more", (F.col("last_cell").isNull() | (F.col("cell") < F.col("last_cell"))).cast("long"))
    # Leaves that take all their epochs have no next one.
    copies = F.when(F.col("rest") > 0, F.col("epochs") + F.col("more")).otherwise(F.col("epochs"))
    back = lambda c: F.when(F.col(c) != "\x00", F.col(c)).alias(c)
    columns = ["doc_id", *map(back, LEVELS), "n_tokens", F.col("tokens").alias("leaf_tokens"), F.col("budget").alias("leaf_budget"), copies.alias("copies")]
    return whole.select(*columns).unionByName(taken.select(*columns))


def mixed(docs: DataFrame, id_col: str = "doc_id", lang_col: str = "lang", source_col: str = "source", domain: Column | None = None, **options) -> DataFrame:
    """The rows of docs as often as the mixture takes them, with all their columns."""
    own = domain_of(F.col(source_col)) if domain is None else domain
    found = mixture(docs, id_col=id_col, lang_col=lang_col, source_col=source_col, domain=own, **options)
    key, copies, time = (fresh(docs, x) for x in ("key", "copies", "time"))
    others = found.filter("copies <> 1").select(row_key(F.col("doc_id"), F.col("domain"), F.col("lang"), F.col("source")).alias(key), F.col("copies").alias(copies)).distinct()
    others = small_side(stage(others, "mix-copies"))
    marked = docs.withColumn(key, row_key(F.col(id_col), own, F.col(lang_col), F.col(source_col))).join(others, key, "left")
    times = F.sequence(F.lit(1).cast("long"), F.coalesce(copies, F.lit(1)))
    return marked.filter(F.coalesce(copies, F.lit(1)) > 0).withColumn(time, F.explode(times)).select(*docs.columns)
