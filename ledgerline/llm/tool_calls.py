"""Tool-call linking for chat records, with DataFrame functions only.

Calls and results are joined by conversation and identifier, ordered topologically (a result after its call, a call after the
results of the calls it depends on), their arguments validated against schemas, and each is serialised as canonical JSON
(keys sorted, no white space).

Scale: both sides are first aggregated to one row an identifier, so a repeated identifier is one row of the join, and
messages meet it in a join whose hot keys can be split. Levels are found in rounds on written tables, a round for each step of
the longest chain of dependencies. Positions within a conversation come from chunks of ``CHUNK`` turns, so that a
conversation of any length is no single group.

Defined results: repeated rows are one message. A message without a conversation, turn or identifier is ``unidentified``; a
call without a result is ``unanswered``, a result without a call an ``orphan``; an identifier used by several calls or results
is ``ambiguous``, and one that waits for itself ``cyclic`` (no level; ordered last). A dependency on an unknown
call is an error of the call and no constraint. Null and unreadable arguments are errors, and have no canonical form.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import save

CHUNK = 256
CALL, RESULT = "call", "result"
#: Parameter types that a schema may name, and the types of JSON values that fit.
TYPES = {
    "string": "^STRING$",
    "integer": "^(TINYINT|SMALLINT|INT|BIGINT)$",
    "number": r"^(TINYINT|SMALLINT|INT|BIGINT|DOUBLE|FLOAT|DECIMAL\(.*\))$",
    "boolean": "^BOOLEAN$",
    "object": "^OBJECT<.*>$",
    "array": "^ARRAY<.*>$",
}


def errors_of(tool: Column, arguments: Column, schemas: dict[str, dict[str, dict]]) -> Column:
    """What is wrong with the parsed ``arguments`` of a call. ``schemas``: by tool and parameter, ``type``, ``required``,
    ``enum``, ``minimum``, ``maximum``, ``min_length`` and ``max_length``."""
    by_tool = F.array(F.lit("unknown tool"))
    for name, parameters in schemas.items():
        found = []
        for parameter, rule in parameters.items():
            value = F.try_variant_get(arguments, f"$.{parameter}", "variant")
            text = F.try_variant_get(arguments, f"$.{parameter}", "string")
            number = F.try_variant_get(arguments, f"$.{parameter}", "double")
            fits = F.schema_of_variant(value).rlike(TYPES[rule["type"]])
            tests = [(~fits, f"not of type {rule['type']}")]
            if "enum" in rule:
                tests.append((~text.isin(*rule["enum"]), "not one of the values"))
            if "minimum" in rule:
                tests.append((number < rule["minimum"], "too small"))
            if "maximum" in rule:
                tests.append((number > rule["maximum"], "too large"))
            if "min_length" in rule:
                tests.append((F.length(text) < rule["min_length"], "too short"))
            if "max_length" in rule:
                tests.append((F.length(text) > rule["max_length"], "too long"))
            missing = F.lit(f"{parameter}: missing") if rule.get("required") else F.lit(None).cast("string")
            outcome = F.when(value.isNull() | F.is_variant_null(value), missing)
            for wrong, says in tests:
                outcome = outcome.when(wrong, F.lit(f"{parameter}: {says}"))
            found.append(outcome)
        by_tool = F.when(tool == name, F.array_compact(F.array(*found)) if found else F.array().cast("array<string>")).otherwise(by_tool)
    return F.when(arguments.isNull(), F.array(F.lit("arguments are not JSON"))).otherwise(by_tool)


def levels(calls: DataFrame) -> DataFrame:
    """``conv_id, call_id, level`` of every distinct call (``conv_id, call_id, depends_on``): 0 without dependencies, else
    two more than the highest it depends on (its result stands between); null where it waits for itself."""
    named = calls.filter("conv_id is not null and call_id is not null")
    every = save(named.select("conv_id", "call_id").distinct(), "calls")
    waits = (
        named.select("conv_id", "call_id", F.explode("depends_on").alias("on"))
        .distinct()
        .join(every.select("conv_id", F.col("call_id").alias("on")), ["conv_id", "on"], "left_semi")
    )
    waits = save(waits, "waits")
    ready = every.join(waits, ["conv_id", "call_id"], "left_anti").withColumn("level", F.lit(0))
    known = save(ready, "levels")
    while not waits.isEmpty():
        step = waits.join(known.select("conv_id", F.col("call_id").alias("on"), "level"), ["conv_id", "on"], "left")
        ready = (
            step.groupBy("conv_id", "call_id")
            .agg(F.max("level").alias("level"), F.count(F.when(F.col("level").isNull(), 1)).alias("open"))
            .filter("open = 0")
            .select("conv_id", "call_id", (F.col("level") + 2).alias("level"))
        )
        ready = save(ready, "ready")
        if ready.isEmpty():
            known = known.unionByName(waits.select("conv_id", "call_id", F.lit(None).cast("int").alias("level")).distinct())
            break
        known = save(known.unionByName(ready), "levels")
        waits = save(waits.join(ready, ["conv_id", "call_id"], "left_anti"), "waits")
    return known


def link(messages: DataFrame, schemas: dict[str, dict[str, dict]]) -> DataFrame:
    """Links, orders, validates and serialises ``messages``: ``conv_id, turn, kind`` (``call`` or ``result``), ``call_id, tool,
    body`` (a call's arguments as JSON, a result's text) and ``depends_on`` (identifiers).

    Adds ``status, level, position, valid, errors`` and ``canonical``."""
    rows = messages.select("conv_id", "turn", "kind", "call_id", "tool", "body", "depends_on").distinct()
    rows = save(rows, "messages")
    identified = F.col("conv_id").isNotNull() & F.col("turn").isNotNull() & F.col("call_id").isNotNull()
    uses = (
        rows.filter(identified)
        .groupBy(F.col("conv_id").alias("c"), F.col("call_id").alias("i"))
        .agg(F.count(F.when(F.col("kind") == CALL, 1)).alias("calls"), F.count(F.when(F.col("kind") == RESULT, 1)).alias("results"))
    )
    level = levels(rows.filter(identified & (F.col("kind") == CALL)))
    level = level.select(F.col("conv_id").alias("lc"), F.col("call_id").alias("li"), F.col("level").alias("call_level"))
    used = uses.join(level, (F.col("c") == F.col("lc")) & (F.col("i") == F.col("li")), "left")
    linked = rows.join(used, (F.col("conv_id") == F.col("c")) & (F.col("call_id") == F.col("i")), "left")
    is_call = F.col("kind") == CALL
    linked = linked.withColumn(
        "status",
        F.when(~identified | F.col("calls").isNull(), "unidentified")
        .when((F.col("calls") > 1) | (F.col("results") > 1), "ambiguous")
        .when(is_call & F.col("call_level").isNull(), "cyclic")
        .when(is_call & (F.col("results") == 0), "unanswered")
        .when(~is_call & (F.col("calls") == 0), "orphan")
        .otherwise("linked"),
    ).withColumn("level", F.when(is_call, F.col("call_level")).otherwise(F.col("call_level") + 1))

    known = rows.filter(identified & is_call).select(F.col("conv_id").alias("c"), F.col("call_id").alias("on")).distinct()
    unknown = (
        rows.filter(identified & is_call)
        .select(F.col("conv_id").alias("c"), F.col("call_id").alias("i"), F.explode("depends_on").alias("on"))
        .distinct()
        .join(known, ["c", "on"], "left_anti")
        .groupBy("c", "i")
        .agg(F.sort_array(F.collect_list(F.concat(F.lit("unknown call "), "on"))).alias("unknown"))
        .select(F.col("c").alias("uc"), F.col("i").alias("ui"), "unknown")
    )
    linked = linked.join(unknown, is_call & (F.col("conv_id") == F.col("uc")) & (F.col("call_id") == F.col("ui")), "left")
    parsed = F.try_parse_json("body")
    none = F.array().cast("array<string>")
    wrong = F.when(is_call, F.concat(errors_of(F.col("tool"), F.col("parsed"), schemas), F.coalesce("unknown", none))).otherwise(none)
    result = F.when(F.col("body").isNotNull(), F.to_json(F.struct(F.col("body").alias("content"))))
    out = (
        linked.withColumn("parsed", F.when(is_call, parsed))
        .withColumn("errors", F.array_join(wrong, "; "))
        .withColumn("canonical", F.when(is_call, F.to_json("parsed")).otherwise(result))
        .withColumn("valid", F.col("errors") == "")
    )
    return _positions(out.drop("c", "i")).select(
        "conv_id", "turn", "kind", "call_id", "tool", "status", "level", "position", "valid", "errors", "canonical"
    )


def _positions(rows: DataFrame) -> DataFrame:
    """Adds ``position``: the place in the conversation by level, turn, kind, identifier and content."""
    last = F.coalesce("level", F.lit(1 << 30))
    rows = save(rows.withColumn("_level", last).withColumn("_chunk", F.floor(F.col("turn") / CHUNK)), "linked")
    sizes = rows.groupBy("conv_id", "_level", "_chunk").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("conv_id").orderBy("_level", "_chunk").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(
        F.col("conv_id").alias("c"), F.col("_level").alias("l"), F.col("_chunk").alias("k"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first")
    )
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("_level") == F.col("l")) & F.col("_chunk").eqNullSafe(F.col("k"))
    within = Window.partitionBy("conv_id", "_level", "_chunk").orderBy("turn", "kind", "call_id", "tool", "body")
    ranked = rows.withColumn("_place", F.row_number().over(within))
    return ranked.join(sizes, same).withColumn("position", F.col("first") + F.col("_place"))


#: The tools that ``messages_of`` speaks of.
SCHEMAS = {
    "answer": {
        "prompt": {"type": "string", "required": True, "min_length": 40},
        "turn": {"type": "integer", "required": True, "minimum": 0, "maximum": 1000},
    },
    "configure": {"instructions": {"type": "string", "required": True, "max_length": 400}},
}
FOLLOWS = 8  # a prompt goes on with the one before it, within blocks of so many turns


def messages_of(conversations: DataFrame) -> DataFrame:
    """Calls and results of a conversation table (``conv_id, turn, role, text``): a user's turn calls the tool ``answer``, the
    assistant's next turn is its result, and a system turn calls ``configure``. Other roles are no messages."""
    turn = F.col("turn").cast("long")
    conv = F.col("conv_id").cast("long")

    def name(at: Column) -> Column:
        return F.concat(F.lit("call_"), conv, F.lit("_"), at)

    prompt = F.to_json(F.struct(turn.alias("turn"), F.col("text").alias("prompt")))
    instructions = F.to_json(F.struct(F.col("text").alias("instructions")))
    goes_on = (F.col("role") == "user") & (F.pmod(turn, F.lit(FOLLOWS)) >= 2)
    return conversations.filter(F.col("role").isin("user", "assistant", "system")).select(
        conv.alias("conv_id"),
        turn.alias("turn"),
        F.when(F.col("role") == "assistant", RESULT).otherwise(CALL).alias("kind"),
        F.when(F.col("role") == "assistant", name(turn - 1)).otherwise(name(turn)).alias("call_id"),
        F.when(F.col("role") == "user", "answer").when(F.col("role") == "system", "configure").alias("tool"),
        F.when(F.col("role") == "user", prompt).when(F.col("role") == "system", instructions).otherwise(F.col("text")).alias("body"),
        F.when(goes_on, F.array(name(turn - 2))).otherwise(F.array().cast("array<string>")).alias("depends_on"),
    )
