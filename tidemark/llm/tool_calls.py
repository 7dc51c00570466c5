"""Chat formatting: tool-call linking, in DataFrame and SQL functions only.

Calls and results are hash-joined by conversation and identifier, put in an order
that respects what each call waits for, checked against the tools' schemas, and
written as canonical JSON: keys sorted, no white space.
"""

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.runtime import stored

# JSON schema types and the names that schema_of_variant gives their values.
TYPES = {
    "string": "^STRING$",
    "integer": "^BIGINT$",
    "number": "^(BIGINT|DOUBLE|DECIMAL.*)$",
    "boolean": "^BOOLEAN$",
    "array": "^ARRAY<.*",
    "object": "^OBJECT<.*",
}


def canonical(text: str | Column) -> Column:
    """JSON text with sorted keys and without white space; null if it isn't JSON."""
    return F.to_json(F.try_parse_json(F.col(text) if isinstance(text, str) else text))


def schema_errors(name: Column, arguments: Column, schemas: Mapping[str, Mapping]) -> Column:
    """Sorted complaints about each call's arguments.

    A schema has ``properties`` (name to type) and ``required`` (names). Arguments
    that aren't a JSON object, unknown tools, missing, unknown and wrongly typed
    properties are reported; a property that is null counts as missing.
    """
    value = F.try_parse_json(arguments)
    none = F.array().cast("array<string>")
    checks = F.when(
        ~F.coalesce(F.schema_of_variant(value).rlike("^OBJECT<"), F.lit(False)), F.array(F.lit("arguments: no object"))
    )
    keys = F.map_keys(F.from_json(arguments, "map<string,string>"))
    for tool, schema in schemas.items():
        types = schema.get("properties", {})
        found = [none]
        for field, kind in sorted(types.items()):
            part = F.try_variant_get(value, f"$.{field}", "variant")
            actual = F.coalesce(F.schema_of_variant(part), F.lit("VOID"))
            wrong = (actual != "VOID") & ~actual.rlike(TYPES[kind])
            found.append(F.when(wrong, F.array(F.lit(f"{field}: no {kind}"))).otherwise(none))
            if field in schema.get("required", ()):
                found.append(F.when(actual == "VOID", F.array(F.lit(f"{field}: missing"))).otherwise(none))
        known = F.array(*(F.lit(f) for f in types)).cast("array<string>")
        unknown = F.transform(F.array_except(keys, known), lambda k: F.concat(k, F.lit(": unknown")))
        found.append(F.coalesce(unknown, none))
        checks = checks.when(name == tool, F.sort_array(F.concat(*found)))
    return checks.otherwise(F.array(F.lit("tool: unknown")))


def ordered(calls: DataFrame) -> DataFrame:
    """``conv``, ``call_id`` and ``stage`` for calls with ``after`` (ids waited for).

    Sorting by stage, then position, is a topological order. Where every awaited
    call stands before its waiter, position alone is one and the stage is 0. Only in
    other conversations stages are found, round by round: a call comes one stage
    after the last that it waits for. Calls on a cycle have none. Ids that don't
    occur in the conversation are not waited for.
    """
    waits = calls.select("conv", "call_id", "position", F.explode("after").alias("awaited")).distinct()
    there = calls.select("conv", F.col("call_id").alias("awaited"), F.col("position").alias("awaited_at"))
    waits = stored(waits.join(there, ["conv", "awaited"]), "waits")
    odd = stored(waits.where("awaited_at >= position").select("conv").distinct(), "out-of-order")
    if odd.isEmpty():
        return calls.select("conv", "call_id", F.lit(0).alias("stage"))
    plain = calls.join(odd, "conv", "left_anti").select("conv", "call_id", F.lit(0).alias("stage"))
    left = stored(calls.join(odd, "conv", "left_semi").select("conv", "call_id"), "unplaced")
    links = stored(waits.join(odd, "conv", "left_semi").select("conv", "call_id", "awaited"), "waits")
    placed, stage = plain, 0
    while True:
        free = stored(left.join(links.select("conv", "call_id").distinct(), ["conv", "call_id"], "left_anti"), "placed")
        if free.isEmpty():
            return placed.unionByName(left.withColumn("stage", F.lit(None).cast("int")))
        placed = placed.unionByName(free.withColumn("stage", F.lit(stage)))
        done = free.withColumnRenamed("call_id", "awaited")
        left = stored(left.join(free, ["conv", "call_id"], "left_anti"), "unplaced")
        links = stored(links.join(done, ["conv", "awaited"], "left_anti"), "waits")
        stage += 1


def linked(calls: DataFrame, results: DataFrame, schemas: Mapping[str, Mapping]) -> DataFrame:
    """Calls with their results.

    ``calls``: ``conv``, ``call_id``, ``position``, ``name``, ``arguments`` (JSON
    text), ``after`` (array of ids). ``results``: ``conv``, ``call_id``, ``position``,
    ``content``. Equal rows are one, with their number in ``copies``.

    One row per result, ``linked`` to its call or an ``orphan``, one per call that is
    ``unanswered``, and one per further call under an id that an earlier one has
    (``duplicate``; results belong to the first by position and arguments). A null
    conversation or id links to nothing. Further columns are ignored; empty tables
    give no rows.
    """
    key = ["conv", "call_id"]
    calls = calls.groupBy(*key, "position", "name", "arguments", "after").agg(F.count("*").alias("copies"))
    results = results.groupBy(*key, "position", "content").agg(F.count("*").alias("copies"))
    calls, results = stored(calls, "calls"), stored(results, "results")
    detail = F.struct("position", "name", "arguments", "after", "copies")
    first = stored(calls.groupBy(*key).agg(F.min(detail).alias("first")).select(*key, "first.*"), "first-calls")
    stages = stored(ordered(first.where("conv is not null and call_id is not null")), "stages")
    errors = schema_errors(F.col("name"), F.col("arguments"), schemas)
    # The rows on the left may have a hot id; the right sides have one row per id.
    described = stored(first.join(stages, key, "left").withColumn("errors", errors), "described-calls")
    replies = results.select(*key, F.col("position").alias("result_position"), "content", F.col("copies").alias("n"))
    answered = replies.join(described.drop("copies"), key, "left").withColumn(
        "status", F.when(F.col("position").isNull(), "orphan").otherwise("linked")
    )
    silent = described.join(replies.select(*key).distinct(), key, "left_anti")
    silent = silent.withColumn("status", F.lit("unanswered")).withColumnRenamed("copies", "n")
    same = F.lit(True)
    for column in ("position", "name", "arguments", "after"):
        same = same & F.col(column).eqNullSafe(F.col(f"first.{column}"))
    firsts = first.select(*key, F.struct("position", "name", "arguments", "after").alias("first"))
    further = calls.join(firsts, key, "left").where("first is not null").where(~same).drop("first")
    further = further.withColumn("errors", errors).withColumn("status", F.lit("duplicate")).withColumnRenamed("copies", "n")
    rows = answered.unionByName(silent, allowMissingColumns=True).unionByName(further, allowMissingColumns=True)
    parts = F.struct(
        F.coalesce(F.try_parse_json("arguments"), F.parse_json(F.lit("null"))).alias("arguments"),
        F.col("call_id").alias("id"),
        "name",
        F.col("content").alias("result"),
    )
    return rows.select(
        *key, "position", "result_position", "name", "stage", "status",
        F.array_join("errors", "; ").alias("errors"),
        F.to_json(parts, {"ignoreNullFields": "false"}).alias("json"),
        F.col("n").alias("copies"),
    )
