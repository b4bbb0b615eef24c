"""Chat formatting: tool-call linking, in DataFrame functions.

Input: messages (conv_id, turn, role, text). An assistant's text may be an envelope
``{"content": ..., "tool_calls": [{"id", "name", "arguments", "after"}]}`` (arguments an
object, or a string that holds one; ``after``: ids of calls that must come first), a
tool's text ``{"tool_call_id": ..., "content": ...}``.

Output: one row per event, an event being a plain message, a call or a result:

* calls and results are hash-joined by (conv_id, identifier). ``status``: message,
  linked, unanswered (call), orphan (result without its call), duplicate (of an
  identifier's calls or results all but the first), cycle (calls that wait for each other);
* sorting a conversation by (place, level, step, turn, idx) is a topological order: every
  event after the calls it waits for, a result after its call, and otherwise by turn. Only
  conversations in which an event precedes one it waits for are reordered (chains by
  doubling pointers, so in few rounds); the others' places are their turns;
* ``errors``: arguments held against the tool's schema, empty if valid;
* ``message_json``: canonical JSON: no white space, keys sorted at every depth, numbers in
  shortest form.

No conversation is gathered into one task: rows stay rows, and windows are not used.

Defined cases: null text is an empty message; a null role is `user`; events with a null
conv_id or identifier are linked with nothing (call: unanswered, result: orphan); a text
that starts like an envelope but is none is a plain message (a tool's: an orphan result);
repeated rows are duplicates if they carry identifiers; an empty table gives an empty
result; extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paddock.llm._common import staged

#: tool -> parameter -> (type, required); types: string, integer, number, boolean, object, array
Schemas = dict[str, dict[str, tuple[str, bool]]]

KEY = ("conv_id", "call_id")


def events(messages: DataFrame) -> DataFrame:
    """One row per event: conv_id, turn, row, idx, role, kind, call_id, name, arguments
    (variant), after, content."""
    m = (messages.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.monotonically_increasing_id().alias("row"), F.coalesce("role", F.lit("user")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"))
        .withColumn("box", F.when(F.col("role").isin("assistant", "tool") & F.col("text").startswith("{"),
                                  F.try_parse_json("text")))
        .withColumn("calls", F.when(F.col("role") == "assistant",
                                    F.try_variant_get("box", "$.tool_calls", "array<variant>"))))

    def text_of(part: Column, path: str) -> Column:
        """A string as it is, anything else as JSON."""
        return F.coalesce(F.try_variant_get(part, path, "string"),
                          F.to_json(F.try_variant_get(part, path, "variant")))

    plain = F.struct(F.lit(0).alias("idx"), F.lit("message").alias("kind"),
                     F.lit(None).cast("string").alias("call_id"), F.lit(None).cast("string").alias("name"),
                     F.lit(None).cast("variant").alias("arguments"),
                     F.array().cast("array<string>").alias("after"),
                     F.when(F.col("calls").isNotNull(), text_of(F.col("box"), "$.content"))
                     .otherwise(F.col("text")).alias("content"))
    result = F.struct(F.lit(0).alias("idx"), F.lit("result").alias("kind"),
                      F.try_variant_get("box", "$.tool_call_id", "string").alias("call_id"),
                      F.lit(None).cast("string").alias("name"),
                      F.lit(None).cast("variant").alias("arguments"),
                      F.array().cast("array<string>").alias("after"),
                      F.when(F.try_variant_get("box", "$.tool_call_id", "string").isNull(), F.col("text"))
                      .otherwise(text_of(F.col("box"), "$.content")).alias("content"))

    def call(c: Column, i: Column) -> Column:
        inner = F.try_variant_get(c, "$.arguments", "variant")
        as_text = F.when(F.schema_of_variant(inner) == "STRING",
                         F.try_parse_json(F.try_variant_get(c, "$.arguments", "string")))
        return F.struct((i + 1).alias("idx"), F.lit("call").alias("kind"),
                        F.try_variant_get(c, "$.id", "string").alias("call_id"),
                        F.try_variant_get(c, "$.name", "string").alias("name"),
                        F.when(F.schema_of_variant(inner) == "STRING", as_text).otherwise(inner)
                        .alias("arguments"),
                        F.coalesce(F.try_variant_get(c, "$.after", "array<string>"),
                                   F.array().cast("array<string>")).alias("after"),
                        F.lit(None).cast("string").alias("content"))

    found = F.when(F.col("role") == "tool", F.array(result)).when(
        F.col("calls").isNull(), F.array(plain)).otherwise(F.concat(
            F.when(plain["content"] != "", F.array(plain)).otherwise(F.array_repeat(plain, 0)),
            F.transform("calls", call)))
    return (m.select("conv_id", "turn", "row", "role", F.explode(found).alias("e"))
            .select("conv_id", "turn", "row", "role", "e.*"))


def linked(parts: DataFrame) -> DataFrame:
    """Adds ``status`` and, for results, the call's turn (``call_turn``)."""
    place = F.struct("turn", "row", "idx")
    named = parts.filter("kind <> 'message' AND conv_id IS NOT NULL AND call_id IS NOT NULL")
    first = (named.groupBy(*KEY, "kind").agg(F.min(place).alias("first")))
    calls = first.filter("kind = 'call'").select(*KEY, F.col("first").alias("call"))
    results = first.filter("kind = 'result'").select(*KEY, F.col("first").alias("result"))
    pairs = calls.join(results.hint("shuffle_hash"), list(KEY), "full_outer")   # unique keys
    own = F.when(F.col("kind") == "call", F.col("call")).otherwise(F.col("result"))
    status = (F.when(F.col("kind") == "message", "message")
              .when((F.col("kind") == "result") & F.col("call").isNull(), "orphan")
              .when((F.col("kind") == "call") & F.col("call").isNull(), "unanswered")
              .when(own != place, "duplicate")
              .when(F.col("result").isNull(), "unanswered").otherwise("linked"))
    return (parts.join(pairs, list(KEY), "left")
            .select(parts["*"], status.alias("status"),
                    F.when(F.col("kind") == "result", F.col("call.turn")).alias("call_turn")))


def schema_table(spark, schemas: Schemas) -> DataFrame:
    """One row a tool: name, params; as long as the caller's schemas."""
    rows = [(tool, [(p, kind, need) for p, (kind, need) in sorted(params.items())])
            for tool, params in sorted(schemas.items())]
    return spark.createDataFrame(
        rows, "name string, params array<struct<param:string,type:string,required:boolean>>")


def _fits(value: Column, kind: Column) -> Column:
    """Whether a variant has a JSON type."""
    seen = F.schema_of_variant(value)
    whole = (seen == "BIGINT") | seen.rlike(r"^DECIMAL\(\d+,0\)$")
    return (F.when(kind == "string", seen == "STRING").when(kind == "integer", whole)
            .when(kind == "number", whole | seen.startswith("DECIMAL") | seen.isin("DOUBLE", "FLOAT"))
            .when(kind == "boolean", seen == "BOOLEAN")
            .when(kind == "object", seen.startswith("OBJECT"))
            .when(kind == "array", seen.startswith("ARRAY")).otherwise(F.lit(False)))


def validated(parts: DataFrame, schemas: Schemas) -> DataFrame:
    """Adds ``errors`` (sorted) to calls; null for other events."""
    table = F.broadcast(schema_table(parts.sparkSession, schemas))
    known = (parts.join(table, "name", "left")
             .withColumn("args", F.try_variant_get("arguments", "$", "map<string,variant>")))

    def check(p: Column) -> Column:
        there = F.array_contains(F.map_keys("args"), p["param"])
        value = F.try_element_at(F.col("args"), p["param"])
        return (F.when(~there & p["required"], F.concat(F.lit("missing "), p["param"]))
                .when(there & ~F.coalesce(_fits(value, p["type"]), F.lit(False)),
                      F.concat(F.lit("not "), p["type"], F.lit(": "), p["param"])))

    odd = F.transform(F.array_except(F.map_keys("args"), F.col("params.param")),
                      lambda k: F.concat(F.lit("unexpected "), k))
    errors = (F.when(F.col("kind") != "call", None)
              .when(F.col("params").isNull(), F.array(F.lit("unknown tool")))
              .when(F.col("args").isNull(), F.array(F.lit("arguments are no object")))
              .otherwise(F.array_sort(F.concat(F.filter(F.transform("params", check),
                                                        lambda e: e.isNotNull()), odd))))
    unnamed = F.when((F.col("kind") == "call") & F.col("call_id").isNull(),
                     F.array(F.lit("no identifier"))).otherwise(F.array().cast("array<string>"))
    return (known.withColumn("errors", F.concat(errors, unnamed)).drop("params", "args"))


def placed(parts: DataFrame) -> DataFrame:
    """Adds ``place`` and ``level``; calls that wait for each other get status cycle."""
    calls = parts.filter("kind = 'call' AND status IN ('linked', 'unanswered') "
                         "AND conv_id IS NOT NULL AND call_id IS NOT NULL")
    waits = (calls.filter(F.size("after") > 0)
             .select("conv_id", "call_id", "turn", "idx", F.explode(F.array_distinct("after")).alias("dep")))
    target = calls.select("conv_id", F.col("call_id").alias("dep"), F.col("turn").alias("dep_turn"),
                          F.col("idx").alias("dep_idx"))
    edges = staged(waits.join(target, ["conv_id", "dep"]), "chat_edges")
    odd = staged(edges.filter(F.struct("dep_turn", "dep_idx") >= F.struct("turn", "idx"))
                 .select("conv_id").distinct(), "chat_reordered")
    todo = staged(calls.select("conv_id", "call_id", "turn").join(odd, "conv_id", "left_semi"),
                  "chat_calls")
    arcs = staged(edges.join(odd, "conv_id", "left_semi").select("conv_id", "call_id", "dep"),
                  "chat_arcs")
    done = _waited(todo, arcs)
    stuck = todo.join(done, list(KEY), "left_anti").select(*KEY, F.lit(True).alias("stuck"))
    moved = done.withColumn("stuck", F.lit(False)).unionByName(
        stuck.withColumn("place", F.lit(None).cast("long")).withColumn("level", F.lit(None).cast("long")))
    own = (F.col("kind") != "message") & F.col("status").isin("linked", "unanswered")
    # an event of the same identifier stands where its call stands, or later
    joined = parts.join(moved.hint("shuffle_hash"), list(KEY), "left")
    base = F.when(F.col("kind") == "result", F.greatest("turn", "call_turn")).otherwise(F.col("turn"))
    return joined.select(
        parts["*"], F.when(own, F.greatest(base, "place")).otherwise(F.col("turn")).alias("at"),
        F.when(own, F.coalesce("level", F.lit(0))).otherwise(F.lit(0)).cast("long").alias("level"),
        (own & (F.col("kind") == "call") & F.coalesce("stuck", F.lit(False))).alias("stuck")
    ).select(*[F.when(F.col("stuck"), F.lit("cycle")).otherwise(F.col("status")).alias("status")
               if c == "status" else F.col(c) for c in parts.columns],
             F.col("at").alias("place"), "level")


def _waited(todo: DataFrame, arcs: DataFrame) -> DataFrame:
    """(conv_id, call_id, place, level) of every call that waits for no cycle: one more
    than the highest level it waits for, and the last turn on the way.

    A call that waits for one other points to it; pointers are doubled until they reach a
    call that waits for none or for several (``anchor``), which takes the logarithm of the
    longest chain in rounds. Only calls that wait for several are then placed in rounds.
    """
    count = arcs.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n"), F.min("dep").alias("dep"))
    single = count.filter("n = 1").select(*KEY, "dep")
    jumps = staged(single.join(todo, list(KEY)).select(
        *KEY, F.col("dep").alias("anchor"), F.lit(1).cast("long").alias("hops"),
        F.col("turn").alias("high")), "chat_jumps")
    rounds = max(1, jumps.count()).bit_length() + 1      # beyond that, only cycles still jump
    for _ in range(rounds):
        ahead = jumps.select("conv_id", F.col("call_id").alias("anchor"), F.col("anchor").alias("to"),
                             F.col("hops").alias("more"), F.col("high").alias("top"))
        jumped = staged(jumps.join(ahead, ["conv_id", "anchor"], "left").select(
            *KEY, F.coalesce("to", "anchor").alias("anchor"),
            (F.col("hops") + F.coalesce("more", F.lit(0))).alias("hops"),
            F.greatest("high", "top").alias("high"), F.col("to").isNotNull().alias("moved")),
            "chat_jumps")
        jumps = jumped.drop("moved")
        if not jumped.filter("moved").limit(1).count():
            break
    # what is still pointing at a call with a pointer of its own is in, or waits for, a cycle
    jumps = staged(jumps.join(single.select("conv_id", F.col("call_id").alias("anchor")),
                              ["conv_id", "anchor"], "left_anti"), "chat_jumps")
    done = staged(todo.join(arcs, list(KEY), "left_anti")
                  .select(*KEY, F.col("turn").alias("place"), F.lit(0).cast("long").alias("level")),
                  "chat_places")
    # calls that wait for several: their arcs lead to anchors, over some hops
    several = arcs.join(count.filter("n > 1").select(*KEY), list(KEY), "left_semi")
    over = jumps.select("conv_id", F.col("call_id").alias("dep"), "anchor", "hops", "high")
    far = staged(several.join(over, ["conv_id", "dep"], "left").select(
        *KEY, F.coalesce("anchor", "dep").alias("dep"),
        F.coalesce("hops", F.lit(0)).alias("hops"), "high"), "chat_far")
    held = done.count() if far.limit(1).count() else None
    while held is not None:
        state = far.join(done.select(*KEY), list(KEY), "left_anti").join(
            done.select("conv_id", F.col("call_id").alias("dep"), "place", "level"),
            ["conv_id", "dep"], "left")
        ready = (state.groupBy(*KEY).agg(
            F.count(F.lit(1)).alias("n"), F.count("level").alias("have"),
            F.max(F.greatest("place", "high")).alias("before"),
            F.max(F.col("level") + F.col("hops")).alias("under"))
            .filter("n = have").join(todo, list(KEY))
            .select(*KEY, F.greatest("turn", "before").alias("place"),
                    (F.col("under") + 1).alias("level")))
        done = staged(done.unionByName(ready), "chat_places")
        now = done.count()
        held = None if now == held else now
    chained = jumps.join(done.select("conv_id", F.col("call_id").alias("anchor"), "place", "level"),
                         ["conv_id", "anchor"])
    return staged(done.unionByName(chained.select(
        *KEY, F.greatest("place", "high").alias("place"),
        (F.col("level") + F.col("hops")).alias("level"))), "chat_places")


def message_json() -> Column:
    """Canonical JSON of an event."""
    plain = F.to_json(F.struct("content", "role"))
    call = F.to_json(F.struct(
        "role", F.array(F.struct("arguments", F.col("call_id").alias("id"), "name")).alias("tool_calls")))
    result = F.to_json(F.struct("content", "role", F.col("call_id").alias("tool_call_id")))
    return F.when(F.col("kind") == "call", call).when(F.col("kind") == "result", result).otherwise(plain)


def format_chats(messages: DataFrame, schemas: Schemas) -> DataFrame:
    """One row per event: conv_id, turn, idx, role, kind, call_id, status, valid, errors
    (joined by '; '; null unless a call), place, level, step (message 0, call 1, result 2),
    message_json."""
    parts = validated(linked(events(messages)), schemas)
    # arguments go into the JSON now: variants need not travel further
    parts = parts.withColumn("message_json", message_json()).drop("arguments", "content", "name")
    parts = staged(parts, "chat_events")
    step = F.when(F.col("kind") == "message", 0).when(F.col("kind") == "call", 1).otherwise(2)
    return placed(parts).select(
        "conv_id", "turn", F.col("idx").cast("long").alias("idx"), "role", "kind", "call_id", "status",
        (F.size("errors") == 0).alias("valid"), F.array_join("errors", "; ").alias("errors"),
        "place", "level", step.cast("long").alias("step"), "message_json")
