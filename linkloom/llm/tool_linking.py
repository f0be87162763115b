"""Tool-call linking for chat data: calls and results joined, ordered, validated and serialised.

Calls and results of a conversation are joined by (conv_id, call_id). Calls may name calls that they come
after. Most conversations name only earlier ones, so their sequence numbers already are a topological order.
The others are given levels, a call's level being one more than the highest of the calls that it names:

* a conversation of at most SMALL calls in one expression over its calls, whatever its depth;
* a larger one by pointer jumping, which passes over chains of calls that name one call each in a logarithm of
  their length; what remains, calls that name several, takes a round for each level of such calls.

Calls on or behind a cycle get no level; they are marked and come last. A result follows its call. Arguments
are parsed and checked against the tool's schema, and each message becomes one canonical JSON object: keys
sorted, no blanks outside strings.

The output is one row per message, not one per conversation, as a conversation may hold a third of all
rows. Positions come from one sort of all messages by conversation, level, place and a hash: its ranges divide a
conversation, a sequence number or a call of any size among tasks, rows are numbered within their range, and the
ranges' counts are added up. Equal messages are counted together first. Texts are written once, as JSON, and
joined back by row id; digests stand for them in every other step. Only DataFrame functions are used.

Defined cases: `link` of a call is `linked` or `unanswered`, of a result `linked` or `orphan`. Several
calls with one id in a conversation: the one with the smallest (seq, name, MD5 of arguments, after) is the call,
the others are `repeated`. Several results of a call are all linked. Equal messages are one row with `repeats`.
Messages at one place are ordered by a hash. Named calls that the conversation does not have, and a call's own
id, are ignored. Null conv_id, call_id or seq: such a message links with nothing (null never equals); its
position is counted among messages with the same conv_id, null seq first. Null or broken arguments give the
error `not_json`; an unknown or null tool `unknown_tool`. Very long contents are only copied; arguments of more
than MAX_ARGUMENTS characters are not parsed, they have the error `too_long` and become a JSON string. A null
content is JSON null. Other columns are never read. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ._common import small_side, stage

#: Conversations of at most so many calls get their levels in one expression.
SMALL = 256
#: Longer arguments are not parsed.
MAX_ARGUMENTS = 1 << 22
#: The place of what lies on or behind a cycle.
LAST = 1 << 30
#: Per tool: field to (kinds of JSON value, required).
SCHEMAS: dict[str, dict[str, tuple[tuple[str, ...], bool]]] = {
    "ask": {"prompt": (("string",), True), "turn": (("integer",), True), "chars": (("integer",), False)},
    "configure": {"prompt": (("string",), True), "turn": (("integer",), True), "chars": (("integer",), False)},
}
# What schema_of_variant calls the kinds of JSON value.
KINDS = {"string": "STRING", "integer": "BIGINT", "number": "(BIGINT|DECIMAL.*|DOUBLE|FLOAT)", "boolean": "BOOLEAN", "object": "OBJECT.*", "array": "ARRAY.*", "null": "VOID"}


def json_scalar(value: Column) -> Column:
    """A value as JSON."""
    listed = F.to_json(F.array(value))
    return listed.substr(F.lit(2), F.length(listed) - 2)


def canonical(text: Column) -> Column:
    """JSON with sorted keys and no blanks; null if text is no JSON."""
    return F.to_json(_parsed(text))


def _parsed(text: Column) -> Column:
    return F.try_parse_json(F.when(F.length(text) <= MAX_ARGUMENTS, text))


def argument_errors(name: Column, arguments: Column, schemas: dict = SCHEMAS) -> Column:
    """An array of what the arguments break; empty if they are valid."""
    parsed = _parsed(arguments)
    known_keys = F.json_object_keys(F.when(F.length(arguments) <= MAX_ARGUMENTS, arguments))
    out = F.array(F.lit("unknown_tool"))
    for tool, fields in schemas.items():
        checks = []
        for field, (kinds, required) in fields.items():
            value = F.try_variant_get(parsed, f"$['{field}']", "variant")
            kind = F.schema_of_variant(value)
            pattern = "^(" + "|".join(KINDS[k] for k in kinds) + ")$"
            absent = F.lit(f"missing:{field}") if required else F.lit(None).cast("string")
            checks.append(F.when(value.isNull(), absent).when(~kind.rlike(pattern), F.lit(f"type:{field}")))
        extra = F.transform(F.array_sort(F.array_except(F.coalesce(known_keys, F.array().cast("array<string>")), F.array(*map(F.lit, fields)))), lambda k: F.concat(F.lit("unexpected:"), k))
        found = F.concat(F.filter(F.array(*checks), lambda e: e.isNotNull()), extra)
        is_object = F.schema_of_variant(parsed).startswith("OBJECT")
        found = F.when(F.length(arguments) > MAX_ARGUMENTS, F.array(F.lit("too_long"))).when(parsed.isNull(), F.array(F.lit("not_json"))).when(~is_object, F.array(F.lit("not_object"))).otherwise(found)
        out = F.when(name == tool, found).otherwise(out)
    return out


def _levels_in_one(nodes: DataFrame) -> DataFrame:
    """conv_id, call_id, level of small conversations; nodes has call_id and parents. Level is null on or behind a cycle."""
    whole = nodes.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("call_id", "parents"))).alias("nodes"))
    ids = whole.withColumn("ids", F.transform("nodes", lambda x: x["call_id"]))
    places = ids.withColumn("up", F.transform("nodes", lambda x: F.transform(x["parents"], lambda p: (F.array_position("ids", p) - 1).cast("int"))))
    start = F.transform("up", lambda ps: F.when(F.size(ps) == 0, F.lit(0)))

    def step(levels: Column, _: Column) -> Column:
        def one(ps: Column, i: Column) -> Column:
            of = F.transform(ps, lambda p: F.get(levels, p))
            return F.coalesce(F.get(levels, i), F.when(F.forall(of, lambda v: v.isNotNull()), F.array_max(of) + 1))

        return F.transform("up", one)

    levels = places.select("conv_id", "ids", F.aggregate(F.sequence(F.lit(1), F.size("ids")), start, step).alias("levels"))
    each = levels.select("conv_id", F.explode(F.arrays_zip("ids", "levels")).alias("x"))
    return each.select("conv_id", F.col("x.ids").alias("call_id"), F.col("x.levels").alias("level"))


def _levels_by_jumps(nodes: DataFrame) -> DataFrame:
    """The same for large conversations: chains are passed over by pointer jumping, then levels of calls with several parents."""
    key = ["conv_id", "call_id"]
    n = nodes.count()
    if not n:
        return nodes.select(*key, F.lit(None).cast("int").alias("level"))
    single = F.size("parents") == 1
    at = stage(nodes.select(*key, F.when(single, F.col("parents")[0]).otherwise(F.col("call_id")).alias("to"), single.cast("int").alias("far")), "tools-jumps")
    # Nodes that chains end in: those with no parent or several.
    for _ in range(max(1, (n - 1).bit_length())):
        on = at.select("conv_id", F.col("call_id").alias("to"), F.col("to").alias("next"), F.col("far").alias("more"))
        at = stage(at.join(on, ["conv_id", "to"]).select(*key, F.col("next").alias("to"), (F.col("far") + F.col("more")).alias("far")), "tools-jumps")
    # A jump of an end leads to itself; what still points at a chain lies on a cycle.
    ends = nodes.filter(~single).select(*key, "parents")
    known = stage(ends.filter(F.size("parents") == 0).select(*key, F.lit(0).alias("level")), "tools-known-levels")
    several = ends.filter(F.size("parents") > 1).select(*key, F.explode("parents").alias("parent"))
    via = at.select("conv_id", F.col("call_id").alias("parent"), "to", "far")
    several = stage(several.join(via, ["conv_id", "parent"]).select(*key, "to", (F.col("far") + 1).alias("far")), "tools-several")
    while True:
        reached = several.join(known.select("conv_id", F.col("call_id").alias("to"), F.col("level").alias("of")), ["conv_id", "to"], "left")
        placed = reached.groupBy(*key).agg(F.count_if(F.col("of").isNull()).alias("open"), F.max(F.col("of") + F.col("far")).cast("int").alias("level")).filter("open = 0")
        new = stage(placed.join(known, key, "left_anti").select(*key, "level"), "tools-new-levels")
        if not new.limit(1).count():
            break
        known = stage(known.unionByName(new), "tools-known-levels")
    ended = at.join(known.select("conv_id", F.col("call_id").alias("to"), "level"), ["conv_id", "to"], "left")
    return ended.select(*key, (F.col("level") + F.col("far")).cast("int").alias("level"))


def _levels(heads: DataFrame, edges: DataFrame, small: int = SMALL) -> DataFrame:
    """(conv_id, call_id, level) of the calls in conversations with an edge from a later call; LAST on or behind a cycle."""
    odd = stage(edges.filter("parent_seq >= seq").select("conv_id").distinct(), "tools-odd")
    parents = edges.join(odd, "conv_id", "left_semi").groupBy("conv_id", "call_id").agg(F.collect_set("parent").alias("parents"))
    nodes = heads.join(odd, "conv_id", "left_semi").select("conv_id", "call_id").join(parents, ["conv_id", "call_id"], "left")
    nodes = stage(nodes.withColumn("parents", F.coalesce("parents", F.array().cast("array<string>"))), "tools-nodes")
    sizes = stage(nodes.groupBy("conv_id").agg((F.count(F.lit(1)) <= small).alias("is_small")), "tools-sizes")
    nodes = nodes.join(sizes, "conv_id")
    found = _levels_in_one(nodes.filter("is_small")).unionByName(_levels_by_jumps(stage(nodes.filter("not is_small").drop("is_small"), "tools-large")))
    return stage(found.select("conv_id", "call_id", F.coalesce("level", F.lit(LAST)).alias("level")), "tools-levels")


def _messages(calls: DataFrame, results: DataFrame, schemas: dict) -> DataFrame:
    """All messages with their JSON, an id for the row, and the digest of arguments or content, written once."""
    given = F.coalesce(canonical(F.col("arguments")), json_scalar(F.col("arguments")))
    call_json = F.concat(F.lit('{"arguments":'), given, F.lit(',"call_id":'), json_scalar(F.col("call_id")), F.lit(',"name":'), json_scalar(F.col("name")), F.lit(',"role":"tool_call"}'))
    result_json = F.concat(F.lit('{"call_id":'), json_scalar(F.col("call_id")), F.lit(',"content":'), json_scalar(F.col("content")), F.lit(',"role":"tool_result"}'))
    none = F.array().cast("array<string>")
    rows = calls.select("conv_id", "call_id", "seq", F.lit("call").alias("kind"), "name", "after", F.md5("arguments").alias("digest"), argument_errors(F.col("name"), F.col("arguments"), schemas).alias("errors"), call_json.alias("json"))
    more = results.select("conv_id", "call_id", "seq", F.lit("result").alias("kind"), F.lit(None).cast("string").alias("name"), none.alias("after"), F.md5("content").alias("digest"), none.alias("errors"), result_json.alias("json"))
    return stage(rows.unionByName(more).withColumn("id", F.monotonically_increasing_id()), "tools-messages")


def link(calls: DataFrame, results: DataFrame, schemas: dict = SCHEMAS, small: int = SMALL) -> DataFrame:
    """calls: conv_id, call_id, seq, name, arguments, after (array of call ids). results: conv_id, call_id, seq, content.

    Gives conv_id, position (from 1), kind, call_id, seq, link, cyclic, errors, json, repeats. Texts are written once
    and joined back by row id; all other steps move ids and digests.
    """
    messages = _messages(calls, results, schemas)
    same = ["kind", "conv_id", "call_id", "seq", "name", "after", "digest"]
    distinct = stage(messages.groupBy(*same).agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("repeats")), "tools-distinct")
    calls, results = distinct.filter("kind = 'call'"), distinct.filter("kind = 'result'")
    key = ["conv_id", "call_id"]
    first = F.min(F.struct("seq", "name", "digest", "after"))
    heads = calls.filter("conv_id is not null and call_id is not null and seq is not null").groupBy(*key).agg(first.alias("head"))
    heads = stage(heads.select(*key, "head.seq", "head.name", "head.digest", "head.after"), "tools-heads")
    edges = heads.select(*key, "seq", F.explode(F.array_distinct("after")).alias("parent")).filter("parent != call_id")
    edges = stage(edges.join(heads.select("conv_id", F.col("call_id").alias("parent"), F.col("seq").alias("parent_seq")), ["conv_id", "parent"]), "tools-known")
    levels = _levels(heads, edges, small)
    heads = heads.select(*key, *(F.col(c).alias(f"head_{c}") for c in ("seq", "name", "digest", "after")))
    heads = stage(heads.join(levels, key, "left").withColumn("level", F.coalesce("level", F.lit(0))), "tools-placed")
    answered = stage(results.select(*key).distinct().withColumn("answered", F.lit(True)), "tools-answered")

    is_head = F.lit(True)
    for c in ("seq", "name", "digest", "after"):
        is_head = is_head & F.col(c).eqNullSafe(F.col(f"head_{c}"))
    level, tie = F.coalesce("level", F.lit(0)).alias("level"), F.md5(F.concat_ws(":", "call_id", "name", "digest")).alias("tie")
    call_rows = calls.join(heads, key, "left").join(answered, key, "left").select(
        "id", "conv_id", "seq", level, F.col("seq").alias("at"), F.lit(0).alias("part"), tie,
        F.when(F.col("head_seq").isNotNull() & ~is_head, "repeated").when(F.col("answered"), "linked").otherwise("unanswered").alias("link"), "repeats",
    )
    has_call = F.col("head_seq").isNotNull()
    result_rows = results.join(heads, key, "left").select(
        "id", "conv_id", "seq", level, F.coalesce("head_seq", "seq").alias("at"), F.when(has_call, 1).otherwise(2).alias("part"), tie,
        F.when(has_call, "linked").otherwise("orphan").alias("link"), "repeats",
    )
    numbered = small_side(_numbered(stage(call_rows.unionByName(result_rows), "tools-rows")))
    return messages.join(numbered, "id").select("conv_id", "position", "kind", "call_id", "seq", "link", "cyclic", "errors", "json", "repeats")


def _numbered(rows: DataFrame) -> DataFrame:
    """id, position in the conversation, link, cyclic and repeats of the rows."""
    ordered = rows.orderBy("conv_id", "level", "at", "part", "seq", "tie", "id").withColumn("at_id", F.monotonically_increasing_id())
    # The number of a row within its range of the sort, and of the range.
    ordered = stage(ordered.select("id", "conv_id", "level", "link", "repeats", F.shiftrightunsigned("at_id", 33).alias("range"), F.col("at_id").bitwiseAND((1 << 33) - 1).alias("own")), "tools-ordered")
    ranges = ordered.groupBy("range").agg(F.count(F.lit(1)).alias("inside"))
    # A row a range; there are as many as tasks of the sort.
    upto = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stage(ranges.select("range", F.coalesce(F.sum("inside").over(upto), F.lit(0)).alias("before")), "tools-ranges")
    placed = ordered.join(F.broadcast(offsets), "range").withColumn("place", F.col("before") + F.col("own"))
    starts = small_side(stage(placed.groupBy("conv_id").agg(F.min("place").alias("start")).withColumnRenamed("conv_id", "of"), "tools-starts"))
    position = (F.col("place") - F.col("start") + 1).cast("long").alias("position")
    found = placed.join(starts, placed["conv_id"].eqNullSafe(starts["of"])).select("id", position, "link", (F.col("level") == LAST).alias("cyclic"), "repeats")
    return stage(found, "tools-numbered")


def from_turns(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results from plain turns (conv_id, turn, role, text).

    A user's or system's turn is a call whose id is made of conversation and turn; any other role's turn is the
    result of the turn before it. The turns have no tool calls, so the rest follows by rule from the number n of
    characters of the whole text (a null text counts as none):

    * tool: `configure` for the system; for a user `browse`, which has no schema, if n mod 13 is 5, else `ask`;
    * calls it comes after: the next two turns if n mod 5 is 0, none if it is 1, else the two turns before it, so
      that some name later calls, and some name each other;
    * arguments, by n mod 7: without `turn` (0), with `turn` as a string (1), with one field too many (2), a JSON
      text that breaks off (3), a list (4), else as the schema wants them.
    """
    of_turn = lambda t: F.concat_ws("-", F.col("conv_id").cast("string"), t.cast("string"))
    t, n = F.col("turn"), F.coalesce(F.length("text"), F.lit(0))
    is_call = F.coalesce(F.col("role").isin("user", "system"), F.lit(False))
    text, chars, form = F.col("text").alias("prompt"), n.alias("chars"), n % 7
    arguments = (
        F.when(form == 0, F.to_json(F.struct(text, chars)))
        .when(form == 1, F.to_json(F.struct(t.cast("string").alias("turn"), text, chars)))
        .when(form == 2, F.to_json(F.struct(t.alias("turn"), text, chars, t.cast("string").alias("note"))))
        .when(form == 3, F.concat(F.lit('{"prompt":'), json_scalar(F.col("text"))))
        .when(form == 4, F.to_json(F.array("text")))
        .otherwise(F.to_json(F.struct(t.alias("turn"), text, chars)))
    )
    name = F.when(F.col("role") == "system", "configure").when(n % 13 == 5, "browse").otherwise("ask")
    after = F.when(n % 5 == 0, F.array(of_turn(t + 1), of_turn(t + 2))).when(n % 5 == 1, F.array().cast("array<string>")).otherwise(F.array(of_turn(t - 2), of_turn(t - 1)))
    calls = turns.filter(is_call).select("conv_id", of_turn(t).alias("call_id"), t.alias("seq"), name.alias("name"), arguments.alias("arguments"), after.alias("after"))
    results = turns.filter(~is_call).select("conv_id", of_turn(t - 1).alias("call_id"), t.alias("seq"), F.col("text").alias("content"))
    return calls, results


def linked_turns(turns: DataFrame) -> DataFrame:
    return link(*from_turns(turns.select("conv_id", "turn", "role", "text")))
