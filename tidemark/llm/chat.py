"""Chat formatting: tool-call linking in DataFrame functions only.

Calls and results meet by a hash join on (conversation, call id), after repeated ids are reduced by a
partial aggregate.  Arguments are parsed as variants and checked against the tool's schema; everything
is serialised as canonical JSON (keys in order, no blanks).

Order: a call comes after the calls it names in ``after``.  Every call of every conversation gets its depth, the
number of calls in the longest chain of named calls before it; calls on a cycle, or behind one, get depth and level
null and status ``cyclic``.  The level is the depth where a call of the conversation names a later or the same turn, or
where a turn is missing; elsewhere the turn order already is a topological order and every call has level 0.
Sorting by (level, turn, call_id) replays a conversation; calls of one depth do not need each other.

Depths are found in rounds (stored): calls whose named calls are all done are done, and a named call that waits for one
other call only is replaced by that one, with the way to it.  Names that the latest named call names as well are left
out first, as the way over it is longer.  So a chain of n calls takes about log2 n rounds, also where calls name all
before them or the branches since the last common one; where they keep naming several in other ways, it can take as many
rounds as the chain is long.

Tables: calls (conv_id, turn, call_id, name, arguments JSON, after array of call ids), results (conv_id,
turn, call_id, content).

Defined results: rows without conv_id or call_id are ignored; of repeated ids the earliest turn counts
(ties: smallest payload) and ``n_calls`` / ``n_results`` tell how often the id was seen; a result without
call has status ``orphan_result``, a call without result ``missing_result``; ids in ``after`` that no call
has are listed in ``errors`` and do not hold the call back; unreadable arguments make the call invalid.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.tables import BROADCAST_ROWS, cut, few_files, remove, shared_folder


@dataclass(frozen=True)
class Parameter:
    """One argument of a tool: JSON type (string, integer, number, boolean, array, object) and limits."""

    type: str
    required: bool = True
    minimum: float | None = None
    maximum: float | None = None
    max_length: int | None = None
    choices: tuple[str, ...] = ()


Schemas = dict[str, dict[str, Parameter]]

# Pattern of Spark's variant type name for each JSON type.
_TYPES = {"string": "^STRING$", "integer": r"^BIGINT$|^DECIMAL\(\d+,0\)$", "number": "^(BIGINT|DOUBLE|DECIMAL.*)$",
          "boolean": "^BOOLEAN$", "array": "^ARRAY", "object": "^OBJECT"}


def _parameter_errors(arguments: Column, name: str, p: Parameter) -> list[Column]:
    path = "$['" + name.replace("'", "\\'") + "']"
    value = F.try_variant_get(arguments, path, "variant")
    kind = F.schema_of_variant(value)
    text, number = F.try_variant_get(arguments, path, "string"), F.try_variant_get(arguments, path, "double")
    absent = value.isNull()
    right = kind.rlike(_TYPES[p.type])
    out = [F.when(absent, F.lit(f"missing:{name}")) if p.required else F.lit(None).cast("string"),
           F.when(~absent & ~right, F.lit(f"type:{name}"))]
    if p.minimum is not None:
        out.append(F.when(right & (number < p.minimum), F.lit(f"minimum:{name}")))
    if p.maximum is not None:
        out.append(F.when(right & (number > p.maximum), F.lit(f"maximum:{name}")))
    if p.max_length is not None:
        out.append(F.when(right & (F.length(text) > p.max_length), F.lit(f"length:{name}")))
    if p.choices:
        out.append(F.when(right & ~text.isin(*p.choices), F.lit(f"choice:{name}")))
    return out


def argument_errors(name: Column, raw: Column, arguments: Column, schemas: Schemas) -> Column:
    """Sorted error codes of one call; empty if it fits its schema."""
    keys = F.coalesce(F.json_object_keys(raw), F.array().cast("array<string>"))
    known = F.lit(False)
    found = F.array(F.lit("unknown_tool"))
    for tool, parameters in schemas.items():
        own = [e for n, p in parameters.items() for e in _parameter_errors(arguments, n, p)]
        extra = F.transform(F.array_except(keys, F.array(*map(F.lit, parameters)).cast("array<string>")),
                            lambda k: F.concat(F.lit("unknown:"), k))
        found = F.when(name == tool, F.concat(F.array_compact(F.array(*own).cast("array<string>")), extra)).otherwise(found)
        known = known | (name == tool)
    is_object = F.schema_of_variant(arguments).startswith("OBJECT")
    return F.array_sort(F.when(arguments.isNull() | ~is_object, F.array(F.lit("invalid_json"))).otherwise(found))


#: No way is longer than this; only on a cycle would ways grow without end.
_FAR = 1 << 40


def _without_short_ways(needs: DataFrame) -> DataFrame:
    """``needs`` less those that the latest named call has too.  The name of the latest stays, so what is on a cycle or
    behind one still is."""
    key = ["conv_id", "call_id"]
    several = needs.groupBy(*key).agg(F.max(F.struct("dep_turn", "dep"))["dep"].alias("latest"), F.count("*").alias("n")).where("n > 1").drop("n")
    if several.isEmpty():
        return needs
    longer = needs.select("conv_id", F.col("call_id").alias("latest"), "dep", F.lit(True).alias("longer"))
    return needs.join(several, key, "left").join(longer, ["conv_id", "latest", "dep"], "left").where("longer is null or dep = latest")


def _levels(needs: DataFrame) -> DataFrame:
    """(conv_id, call_id, depth) of the calls that name others; depth null on a cycle or behind one.

    ``needs``: (conv_id, call_id, dep, dep_turn) of dependencies on existing calls.  A round has a row (conv_id, call_id, b,
    edges) for each call not done: its depth is the largest of b (from calls that are done) and depth(dep) + w of its edges."""
    key, needs = ["conv_id", "call_id"], _without_short_ways(needs)
    spark, root = needs.sparkSession, f"{shared_folder(needs.sparkSession)}/tables/{uuid.uuid4().hex}"

    def merged(ways: DataFrame) -> DataFrame:  # (conv_id, call_id, dep or null, w)
        ways = ways.groupBy(*key, "dep").agg(F.max("w").alias("w"))
        return ways.groupBy(*key).agg(F.max(F.when(F.col("dep").isNull(), F.col("w"))).alias("b"),
                                      F.collect_list(F.when(F.col("dep").isNotNull(), F.struct("dep", "w"))).alias("edges"))

    def write(rows: DataFrame, k: int, n: int) -> DataFrame:
        path = f"{root}/round={k}"
        few_files(rows.withColumn("open", (F.size("edges") > 0).cast("int")), n).write.partitionBy("open").parquet(path)
        return spark.read.schema(schema).parquet(path)

    def sizes(rows: DataFrame) -> dict[int, int]:
        return {r["open"]: r["count"] for r in rows.groupBy("open").count().collect()}  # at most two rows

    waiting = needs.select("conv_id", F.col("call_id").alias("dep"), F.lit(True).alias("waits")).distinct()
    first = merged(needs.join(waiting, ["conv_id", "dep"], "left").select(*key, F.when(F.col("waits"), F.col("dep")).alias("dep"), F.lit(1).cast("long").alias("w")))
    schema = T.StructType([*first.schema.fields, T.StructField("open", T.IntegerType())])
    k, n = 0, needs.count()
    rows = write(first, k, n)
    count = sizes(rows)
    while count.get(0) and count.get(1):  # as long as a round finishes calls; the rest is on cycles, or behind one
        done, held = rows.where("open = 0"), rows.where("open = 1")
        single = held.where(F.size("edges") == 1).select("conv_id", "call_id", "b", F.col("edges")[0]["dep"].alias("to"), F.col("edges")[0]["w"].alias("way"))
        last = done.select("conv_id", F.col("call_id").alias("to"), F.col("b").alias("end"))
        single = single.join(last, ["conv_id", "to"], "left").select(
            "conv_id", F.col("call_id").alias("dep"), F.greatest("b", F.col("end") + F.col("way")).alias("own"),
            F.when(F.col("end").isNull(), F.col("to")).alias("to"), F.when(F.col("end").isNull(), F.col("way")).alias("way"))
        seen = single.unionByName(done.select("conv_id", F.col("call_id").alias("dep"), F.col("b").alias("own")), allowMissingColumns=True) \
            .withColumn("seen", F.lit(True))
        ways = held.select(*key, F.explode("edges").alias("e")).select(*key, "e.*").join(seen, ["conv_id", "dep"], "left")
        way = lambda dep, w: F.struct(dep.alias("dep"), F.least(w, F.lit(_FAR)).alias("w"))
        none = F.lit(None).cast(first.schema["edges"].dataType.elementType["dep"].dataType)
        ways = ways.select(*key, F.explode(F.array_compact(F.array(
            F.when(F.col("seen").isNull(), way(F.col("dep"), F.col("w"))),
            F.when(F.col("to").isNotNull(), way(F.col("to"), F.col("w") + F.col("way"))),
            F.when(F.col("own").isNotNull(), way(none, F.col("w") + F.col("own")))))).alias("e")).select(*key, "e.*")
        ways = ways.unionByName(held.where("b is not null").select(*key, none.alias("dep"), F.col("b").alias("w")))
        rows = write(merged(ways), k + 1, count[1])
        remove(spark, f"{root}/round={k}/open=1")
        k, count = k + 1, sizes(rows)
    found = spark.read.schema(T.StructType([*schema.fields, T.StructField("round", T.IntegerType())])).parquet(root)
    return found.select(*key, F.when(F.col("open") == 0, F.col("b").cast("int")).alias("depth"))


def link(calls: DataFrame, results: DataFrame, schemas: Schemas) -> DataFrame:
    """One row per call id: status, order (level and depth), validity and the canonical message."""
    key = ["conv_id", "call_id"]
    asked = calls.where("conv_id is not null and call_id is not null").groupBy(*key).agg(
        F.min(F.struct("turn", "name", "arguments", "after")).alias("c"), F.count("*").alias("n_calls"))
    asked = cut(asked.select(*key, "c.*", "n_calls"))
    given = results.where("conv_id is not null and call_id is not null").groupBy(*key).agg(
        F.min(F.struct("turn", "content")).alias("r"), F.count("*").alias("n_results"))
    given = given.select(*key, F.col("r.turn").alias("result_turn"), F.col("r.content").alias("content"), "n_results")

    named = asked.select("conv_id", "call_id", "turn", F.explode("after").alias("dep")).where("dep is not null").distinct()
    found = cut(named.join(asked.select("conv_id", F.col("call_id").alias("dep"), F.col("turn").alias("dep_turn"), F.lit(True).alias("known")),
                           ["conv_id", "dep"], "left"))
    unknown = found.where("known is null").groupBy(*key).agg(F.array_sort(F.collect_set(F.concat(F.lit("after:"), "dep"))).alias("lost"))
    needs = found.where("known")
    levels = _levels(needs.select(*key, "dep", "dep_turn")).withColumn("leveled", F.lit(True))
    odd = cut(needs.where("turn is null or dep_turn is null or dep_turn >= turn").select("conv_id").distinct())
    n_odd = odd.count()
    odd = F.broadcast(odd) if n_odd <= BROADCAST_ROWS else odd

    rows = asked.withColumn("parsed", F.try_parse_json("arguments")) \
        .withColumn("wrong", argument_errors(F.col("name"), F.col("arguments"), F.col("parsed"), schemas))
    rows = rows.join(unknown, key, "left").join(levels, key, "left")
    if n_odd:
        rows = rows.join(odd.withColumn("odd", F.lit(True)), "conv_id", "left")
    rows = rows.join(given, key, "full")
    cyclic = F.col("leveled") & F.col("depth").isNull()
    depth = F.when(F.col("n_calls").isNull() | cyclic, F.lit(None)).otherwise(F.coalesce("depth", F.lit(0)))
    status = F.when(F.col("n_calls").isNull(), "orphan_result").when(cyclic, "cyclic") \
        .when(F.col("n_results").isNull(), "missing_result").otherwise("linked")
    message = F.to_json(F.struct(F.col("parsed").alias("arguments"), "content", F.col("call_id").alias("id"), "name"))
    errors = F.concat(F.coalesce("wrong", F.array().cast("array<string>")), F.coalesce("lost", F.array().cast("array<string>")))
    return rows.select(
        *key, "name", "turn", "result_turn", status.alias("status"),
        (F.when(F.col("odd") | depth.isNull(), depth).otherwise(F.lit(0)) if n_odd else F.when(depth.isNotNull(), F.lit(0))).alias("level"),
        depth.alias("depth"),
        F.when(F.col("n_calls").isNotNull(), F.size("wrong") == 0).alias("valid"), errors.alias("errors"),
        F.coalesce("n_calls", F.lit(0)).alias("n_calls"), F.coalesce("n_results", F.lit(0)).alias("n_results"),
        message.alias("message"))


# Binding of plain conversations: the tools that the derived calls use.
CONVERSATION_TOOLS: Schemas = {
    "lookup": {"query": Parameter("string", max_length=200), "limit": Parameter("integer", minimum=1, maximum=50)},
    "reply": {"prompt": Parameter("string", max_length=2000), "max_words": Parameter("integer", minimum=1),
              "style": Parameter("string", required=False, choices=("plain", "list"))},
}


def conversation_calls(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results that the turns of plain conversations stand for.

    A user turn is a call (a short one a lookup, a longer one a reply) that follows the call two turns
    before; the assistant turn after it is its result."""
    def call_id(turn):
        return F.concat(F.lit("call_"), F.col("conv_id").cast("string"), F.lit("_"), turn.cast("string"))

    asked = conversations.where("role = 'user'")
    n_words = F.size(F.array_remove(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), ""))
    short = F.length(F.coalesce("text", F.lit(""))) < 160
    arguments = F.when(short, F.to_json(F.struct(F.col("text").alias("query"), n_words.alias("limit")))).otherwise(
        F.to_json(F.struct(F.col("text").alias("prompt"), n_words.alias("max_words"),
                           F.when(F.contains("text", F.lit("\n")), "list").otherwise("plain").alias("style"))))
    calls = asked.select(
        "conv_id", "turn", call_id(F.col("turn")).alias("call_id"), F.when(short, "lookup").otherwise("reply").alias("name"),
        arguments.alias("arguments"),
        F.when(F.col("turn") >= 2, F.array(call_id(F.col("turn") - 2))).otherwise(F.array().cast("array<string>")).alias("after"))
    results = conversations.where("role = 'assistant'").select(
        "conv_id", "turn", call_id(F.col("turn") - 1).alias("call_id"), F.col("text").alias("content"))
    return calls, results


def link_conversations(conversations: DataFrame) -> DataFrame:
    calls, results = conversation_calls(conversations.select("conv_id", "turn", "role", "text"))
    return link(calls, results, CONVERSATION_TOOLS)
