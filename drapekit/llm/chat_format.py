"""Operator 5, chat formatting with tool-call linking.

Messages (conversation, turn, role, text) hold tool calls as JSON: an assistant's
``{"tool_calls": [{"id", "name", "arguments", "after"}]}``, where ``after`` names the call whose
result this one uses, and a tool's ``{"tool_call_id", "content"}``.

* **Linking.** The calls and the results of an identifier are numbered by turn and joined on
  (conversation, identifier, number); what has no partner is a row of its own.  Counts tell how
  many there were.  Without ``every`` only the earliest call and the earliest result are rows.
* **Order.** A call's depth is the number of calls it builds on, found by pointer doubling, so a
  chain of n calls takes log2(n) joins.  (conversation, depth, turn) is a topological order.
  Calls on a cycle have no depth.  Of repeated identifiers ``after`` names the latest call before
  this one, else the first.
* **Validation.** Arguments are parsed once and checked against the tool's schema: required
  parameters, types, unknown parameters.
* **Canonical JSON.** Keys sorted, no white space, absent fields left out: one line per call, per
  result without a call, and per plain message.  Arguments that are no JSON object, or repeat a key,
  stand as they came in ``raw_arguments``.  A number without fraction (1.0) is an integer.

One row never holds more than a call and its result, so a conversation of any length is dealt
out over tasks by identifier; numbering sorts the rows of one identifier in one task.  All of it is
built-in column functions, windows and joins.

Messages whose text is no such JSON are plain messages, as are those with a null role or an empty
list of calls; a null text is left out of the JSON.  What an assistant says beside its calls
(``content``) is a plain message too.  Calls or results without identifier are not linked: each is a row
with status "no_id".  Null conversations form one conversation.  Empty table: empty result.
Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from drapekit.llm.common import written

#: tool -> parameter -> (type, required); types as Spark names those of JSON values
TOOLS: dict[str, dict[str, tuple[str, bool]]] = {
    "count_words": {"text": ("STRING", True), "unit": ("STRING", False)},
    "fetch_turn": {"deep": ("BOOLEAN", False), "turn": ("BIGINT", True)},
    "search": {"limit": ("BIGINT", False), "query": ("STRING", True)},
}

_CALLS = "tool_calls array<struct<id:string,name:string,arguments:string,after:string>>, content string"
_RESULT = "tool_call_id string, content string"


def extract(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(calls, results, plain messages)."""
    m = messages.select(F.col(conv_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"), F.col(role_col).alias("role"), F.col(text_col).alias("text"))
    said = F.when(F.col("role") == "assistant", F.from_json("text", _CALLS))
    calls = F.when(F.size(said["tool_calls"]) > 0, said["tool_calls"])
    found = F.when(F.col("role") == "tool", F.from_json("text", _RESULT))
    m = m.withColumn("calls", calls).withColumn("beside", F.when(calls.isNotNull(), said["content"])).withColumn("result", F.when(found["tool_call_id"].isNotNull() | found["content"].isNotNull(), found))
    own = m.where("calls is not null").select("conv", "turn", F.posexplode("calls").alias("at", "c"))
    own = own.select("conv", "turn", "at", F.col("c.id").alias("id"), F.col("c.name").alias("name"), F.col("c.arguments").alias("arguments"), F.col("c.after").alias("after"))
    answers = m.where("result is not null").select("conv", "turn", F.col("result.tool_call_id").alias("id"), F.col("result.content").alias("content"))
    plain = m.where("calls is null and result is null or beside is not null").select("conv", "turn", "role", F.coalesce("beside", "text").alias("text"))
    return own, answers, plain


def errors(tools: dict[str, dict[str, tuple[str, bool]]] = TOOLS) -> Column:
    """What is wrong with a call (name, arguments, parsed arguments ``args``): sorted codes."""

    def of_tool(parameters: dict[str, tuple[str, bool]]) -> Column:
        checks = []
        for p, (kind, required) in parameters.items():
            held = F.array_contains("keys", p)
            value = F.schema_of_variant(F.variant_get("args", f"$.{p}", "variant"))
            whole = value.rlike(r"^DECIMAL\(\d+,0\)$") if kind == "BIGINT" else F.lit(False)
            checks.append(F.when(held & (value != kind) & ~whole, F.lit(f"type:{p}")))
            if required:
                checks.append(F.when(~held, F.lit(f"missing:{p}")))
        known = F.array(*[F.lit(p) for p in parameters])
        unknown = F.transform(F.array_except("keys", known), lambda k: F.concat(F.lit("unknown:"), k))
        return F.concat(F.filter(F.array(*checks), lambda e: e.isNotNull()), unknown)

    out = F.when(F.col("name").isNull() | ~F.col("name").isin(*tools), F.array(F.lit("unknown_tool")))
    out = out.when(F.col("keys").isNull(), F.array(F.lit("arguments")))
    for tool, parameters in tools.items():
        out = out.when(F.col("name") == tool, of_tool(parameters))
    return F.array_sort(out)


def depths(calls: DataFrame) -> DataFrame:
    """(conv, id, depth) of calls (conv, id, after): how many calls it builds on, null on a cycle
    or behind one.  A call that builds on an identifier that does not exist builds on none."""
    nodes = calls.select("conv", "id", "after")
    ids = nodes.select(F.col("conv").alias("c"), F.col("id").alias("i"))
    state = nodes.join(ids, F.col("conv").eqNullSafe(F.col("c")) & (F.col("after") == F.col("i")), "left")
    state = written(state.select("conv", "id", F.col("i").alias("up"), F.when(F.col("i").isNotNull(), 1).otherwise(0).cast("long").alias("depth")), "op5-depth")
    total, open_rows = state.agg(F.count(F.lit(1)), F.count("up")).first()
    reach = 1
    while open_rows and reach < 2 * total:
        above = state.select(F.col("conv").alias("c"), F.col("id").alias("i"), F.col("up").alias("up2"), F.col("depth").alias("more"))
        done, going = state.where("up is null"), state.where("up is not null")
        going = going.join(above, F.col("conv").eqNullSafe(F.col("c")) & (F.col("up") == F.col("i")))
        going = going.select("conv", "id", F.col("up2").alias("up"), (F.col("depth") + F.col("more")).alias("depth"))
        state = written(done.unionByName(going), "op5-depth")
        reach *= 2
        open_rows = state.agg(F.count("up")).first()[0]
    return state.select("conv", "id", F.when(F.col("up").isNull(), F.col("depth")).alias("depth"))


def _first(rows: DataFrame, fields: list[str], count: str) -> DataFrame:
    """The earliest row per (conv, id), and how many there are."""
    out = rows.groupBy("conv", "id").agg(F.min(F.struct(*fields)).alias("r"), F.count(F.lit(1)).alias(count))
    return out.select("conv", "id", "r.*", count, F.lit(1).alias("number"))


def _numbered(rows: DataFrame, fields: list[str], count: str) -> DataFrame:
    """Every row, numbered per (conv, id) from the earliest, and how many there are."""
    key = Window.partitionBy("conv", "id")
    return rows.select("conv", "id", *fields, F.count(F.lit(1)).over(key).alias(count), F.row_number().over(key.orderBy(*fields)).alias("number"))


def _key(name: str, number: str) -> Column:
    """A name of its own for each call of an identifier."""
    return F.concat(F.col(name), F.lit("#"), F.col(number))


def _builds_on(calls: DataFrame) -> DataFrame:
    """(conv, id, after) of numbered calls, named by ``_key``."""
    none = F.lit(None)
    places = calls.select("conv", F.col("id").alias("k"), "turn", "at", "number", none.cast("string").alias("id"), none.cast("int").alias("own"))
    asks = calls.where("after is not null").select("conv", F.col("after").alias("k"), "turn", "at", none.cast("int").alias("number"), "id", F.col("number").alias("own"))
    key = Window.partitionBy("conv", "k")
    before = key.orderBy("turn", "at", F.col("number").isNotNull(), "number").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    up = F.coalesce(F.last("number", ignorenulls=True).over(before), F.min("number").over(key))
    found = places.unionByName(asks).withColumn("up", up).where("own is not null")
    found = found.select("conv", _key("id", "own").alias("id"), _key("k", "up").alias("after"))
    return found.unionByName(calls.where("after is null").select("conv", _key("id", "number").alias("id"), none.cast("string").alias("after")))


def format_chats(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", tools: dict[str, dict[str, tuple[str, bool]]] = TOOLS, every: bool = False) -> DataFrame:
    """One row per call (``every``: all calls and results of repeated identifiers), unlinked result and plain message: conversation, kind, turn,
    result_turn, call_id, depth, status, errors (comma-joined), n_calls, n_results, json.

    status: linked; early (the result comes before the call); pending (no result); orphan (a
    result without call); extra (a result beyond the calls of its identifier); no_id; message."""
    calls, results, plain = extract(messages, conv_col, turn_col, role_col, text_col)
    pick = _numbered if every else _first
    single = written(pick(calls.where("id is not null"), ["turn", "at", "name", "arguments", "after"], "n_calls"), "op5-calls")
    answers = pick(results.where("id is not null"), ["turn", "content"], "n_results").withColumnRenamed("turn", "result_turn")
    nodes = _builds_on(single) if every else single.select("conv", _key("id", "number").alias("id"), F.concat("after", F.lit("#1")).alias("after"))
    a, r, d = single.withColumn("key", _key("id", "number")).alias("a"), answers.alias("r"), depths(nodes).alias("d")

    def same(x: str, y: str, *names: tuple[str, str]) -> Column:
        out = F.col(f"{x}.conv").eqNullSafe(F.col(f"{y}.conv"))
        for p, q in names:
            out = out & (F.col(f"{x}.{p}") == F.col(f"{y}.{q}"))
        return out

    linked = a.join(r, same("a", "r", ("id", "id"), ("number", "number")), "full_outer").join(d, same("a", "d", ("key", "id")), "left")
    linked = linked.select(
        F.when(F.col("a.id").isNotNull(), F.col("a.conv")).otherwise(F.col("r.conv")).alias("conv"),
        F.coalesce("a.id", "r.id").alias("id"),
        F.when(F.col("a.id").isNotNull(), "call").otherwise("result").alias("kind"),
        *[F.col(c) for c in ("turn", "result_turn", "name", "arguments", "after", "content", "depth")],
        F.coalesce("n_calls", F.lit(0)).alias("n_calls"),
        F.coalesce("n_results", F.lit(0)).alias("n_results"),
        F.when(F.col("a.id").isNull(), "orphan").when(F.col("r.id").isNull(), "pending").when(F.col("result_turn") <= F.col("turn"), "early").otherwise("linked").alias("status"),
    )
    if every:
        key = Window.partitionBy("conv", "id")
        linked = linked.withColumns({c: F.max(c).over(key) for c in ("n_calls", "n_results")})
        linked = linked.withColumn("status", F.when((F.col("kind") == "result") & (F.col("n_calls") > 0), "extra").otherwise(F.col("status")))
    loose = calls.where("id is null").select("conv", "turn", "name", "arguments", "after", F.lit("call").alias("kind"), F.lit(1).alias("n_calls"), F.lit("no_id").alias("status"))
    loose = loose.unionByName(results.where("id is null").select("conv", F.col("turn").alias("result_turn"), "content", F.lit("result").alias("kind"), F.lit(1).alias("n_results"), F.lit("no_id").alias("status")), allowMissingColumns=True)
    linked = linked.unionByName(loose, allowMissingColumns=True)
    linked = linked.withColumn("args", F.try_parse_json("arguments")).withColumn("keys", F.when(F.schema_of_variant("args").startswith("OBJECT"), F.map_keys(F.from_json("arguments", "map<string,string>"))))
    linked = linked.withColumn("errors", F.when(F.col("kind") == "call", errors(tools)))
    call = F.struct("after", F.col("args").alias("arguments"), F.col("content"), F.col("conv").alias("conversation"), "depth", F.when(F.size("errors") > 0, F.col("errors")).alias("errors"), "id", "name", F.when(F.col("keys").isNull(), F.col("arguments")).alias("raw_arguments"), "result_turn", "status", "turn")
    linked = linked.withColumn("json", F.to_json(call))
    message = F.to_json(F.struct(F.col("text").alias("content"), F.col("conv").alias("conversation"), "role", "turn"))
    plain = plain.select("conv", F.lit("message").alias("kind"), "turn", F.lit("message").alias("status"), message.alias("json"))
    out = linked.drop("name", "arguments", "after", "content", "args", "keys").withColumn("errors", F.array_join("errors", ",")).unionByName(plain, allowMissingColumns=True)
    return out.select(
        F.col("conv").alias(conv_col), "kind", "turn", "result_turn", F.col("id").alias("call_id"), "depth", "status", "errors",
        F.coalesce("n_calls", F.lit(0)).cast("long").alias("n_calls"), F.coalesce("n_results", F.lit(0)).cast("long").alias("n_results"), "json",
    )
