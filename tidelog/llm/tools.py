"""Tool-call linking: calls joined with their results, in dependency order, checked
and written as canonical JSON.

Calls and results are hash-joined by conversation and identifier. The level of a call
is the length of the longest chain of calls that it depends on; ordering by level is a
topological order. Arguments are checked against the schema of the named tool, and
every call becomes one line of JSON with sorted keys and no blanks.

No conversation is gathered: all steps are joins and partial aggregates by
identifier, and levels are found in rounds that double the length of the chains.

Cases: of calls with the same identifier the first (by turn, then content) is linked, the
others are rows with the error ``duplicate_id``, no level and no result; of results of a
call the first is linked and the call has the error ``multiple_results``; results that
are not linked are given by ``unlinked_results``; a null identifier cannot be linked or depended on, the call is kept with
level 0; a dependency that is not a call of the conversation is an error of the call and
otherwise ignored; calls on a cycle, or behind one, have no level; arguments that are null or not a JSON object (a
key repeated further inside counts as that) are invalid and written as null; so are those that repeat a key, with the
error ``duplicate_key``; whole numbers of up to 38 digits are integers, 1.0 too; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import materialize
from tidelog.storage import scratch


@dataclass(frozen=True)
class Field:
    """A field of a tool's arguments: string, integer, number, boolean, array or object."""

    name: str
    kind: str
    required: bool = True


@dataclass(frozen=True)
class Tool:
    name: str
    fields: tuple[Field, ...]


def _is_kind(kind: str, schema: Column) -> Column:
    if kind == "number":
        return schema.isin("BIGINT", "DOUBLE", "FLOAT") | schema.startswith("DECIMAL")
    if kind in ("array", "object"):
        return schema.startswith(kind.upper())
    if kind == "integer":
        return (schema == "BIGINT") | schema.rlike(r"^DECIMAL\(\d+,0\)$")
    return schema == {"string": "STRING", "boolean": "BOOLEAN"}[kind]


def argument_errors(tools: tuple[Tool, ...], name: Column, arguments: Column, parsed: Column) -> Column:
    """What is wrong with the arguments: an array of short codes, empty if nothing."""
    not_object = ~F.coalesce(F.schema_of_variant(parsed).startswith("OBJECT"), F.lit(False))
    per_tool = F.lit(None).cast("array<string>")
    for tool in tools:
        checks = []
        for field in tool.fields:
            kind = F.schema_of_variant(F.try_variant_get(parsed, f"$.{field.name}", "variant"))
            if field.required:
                checks.append(F.when(kind.isNull(), F.lit(f"missing:{field.name}")))
            checks.append(F.when(kind.isNotNull() & ~_is_kind(field.kind, kind), F.lit(f"type:{field.name}")))
        names = F.array(*[F.lit(f.name) for f in tool.fields])
        unknown = F.transform(
            F.array_sort(F.array_except(F.json_object_keys(arguments), names)), lambda k: F.concat(F.lit("unexpected:"), k)
        )
        errors = F.concat(F.array_compact(F.array(*checks)), F.coalesce(unknown, F.array().cast("array<string>")))
        per_tool = F.when(name == tool.name, errors).otherwise(per_tool)
    keys = F.json_object_keys(arguments)
    repeated = not_object & F.coalesce(F.size(keys) > F.size(F.array_distinct(keys)), F.lit(False))
    return F.when(repeated, F.array(F.lit("duplicate_key"))).when(not_object, F.array(F.lit("not_an_object"))).otherwise(
        F.coalesce(per_tool, F.array(F.lit("unknown_tool")))
    )


def _first(rows: DataFrame, *values: str) -> DataFrame:
    """The first row by turn of every conversation and identifier, and the number of rows."""
    return (
        rows.filter(F.col("call_id").isNotNull())
        .groupBy("conv_id", "call_id").agg(F.min(F.struct("turn", *values)).alias("first"), F.count(F.lit(1)).alias("n_rows"))
        .select("conv_id", "call_id", "first.*", "n_rows")
    )


def _later(rows: DataFrame, first: DataFrame, *values: str) -> DataFrame:
    """All rows but the ``first`` of every conversation and identifier. Equal rows are counted."""
    row = F.struct("turn", *values)
    several = first.filter("n_rows > 1").select("conv_id", "call_id", row.alias("first"))
    counts = (
        rows.join(several, ["conv_id", "call_id"])
        .groupBy("conv_id", "call_id", "turn", *values, row.eqNullSafe(F.col("first")).alias("is_first"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    times = F.col("n") - F.col("is_first").cast("long")
    return counts.filter(times > 0).select("conv_id", "call_id", "turn", *values, F.explode(F.sequence(F.lit(1), times)).alias("copy")).drop("copy")


def _keyed(rows: DataFrame, *columns: str) -> DataFrame:
    """Null conversations are one more conversation; a key without nulls keeps the joins plain."""
    key = F.struct(F.col("conv_id").isNull().alias("none"), F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("id"))
    return rows.select(key.alias("conv_id"), F.col("conv_id").alias("conv"), "turn", "call_id", *columns)


def _same(left: str, right: str) -> Column:
    return F.col(left).eqNullSafe(F.col(right))


def levels(calls: DataFrame, links: DataFrame) -> DataFrame:
    """``conv_id, call_id, level`` of all calls but those on or behind a cycle.

    ``links`` has ``conv_id, call_id, needs`` for dependencies between known calls. Round ``k``
    knows the calls that lie exactly ``2 ** k`` dependencies away, and with them the levels
    below ``2 ** (k + 1)``: rounds grow with the logarithm of the longest chain. Where many
    paths make these pairs many more than the links, levels are found one after the other.
    """
    key = ["conv_id", "call_id"]
    reach = materialize(links, "links")
    most = 4 * reach.count() + 1000
    known = materialize(calls.select(*key, F.lit(0).alias("level")), "levels")
    total, step = known.count(), 1
    while n_pairs := reach.count():
        if n_pairs > most:
            return _levels_one_by_one(calls, links)
        if step > total:
            # A path longer than there are calls goes round a cycle.
            return known.join(reach.select(*key).distinct(), key, "left_anti")
        below = known.select("conv_id", F.col("call_id").alias("needs"), F.col("level").alias("below"))
        longest = reach.join(below, ["conv_id", "needs"]).groupBy(*key).agg((F.max("below") + step).alias("longer"))
        known = materialize(
            known.join(longest, key, "left").select(*key, F.greatest("level", F.coalesce("longer", F.lit(0))).alias("level")), "levels"
        )
        onward = reach.select("conv_id", F.col("call_id").alias("needs"), F.col("needs").alias("far"))
        reach = materialize(reach.join(onward, ["conv_id", "needs"]).select(*key, F.col("far").alias("needs")).distinct(), "links")
        step *= 2
    return known


def _levels_one_by_one(calls: DataFrame, links: DataFrame) -> DataFrame:
    """The same in as many rounds as the longest chain, each over what is still open."""
    spark, key = links.sparkSession, ["conv_id", "call_id"]
    folder = scratch(spark, "levels")
    open_links = materialize(links, "open-links")
    calls.join(open_links, key, "left_anti").select(*key, F.lit(0).alias("level")).write.parquet(f"{folder}/0")
    schema, level = calls.select(*key, F.lit(0).alias("level")).schema, 0

    def read(*numbers: int) -> DataFrame:
        return spark.read.schema(schema).parquet(*[f"{folder}/{k}" for k in numbers])

    while open_links.limit(1).count():
        met = read(level).select("conv_id", F.col("call_id").alias("needs"))
        left = materialize(open_links.join(met, ["conv_id", "needs"], "left_anti"), "open-links")
        level += 1
        ready = open_links.select(*key).distinct().join(left.select(*key).distinct(), key, "left_anti")
        ready.withColumn("level", F.lit(level)).write.parquet(f"{folder}/{level}")
        if not read(level).limit(1).count():
            break
        open_links = left
    # One scan of all folders: the plan does not grow with the levels.
    return read(*range(level + 1))


def link_calls(calls: DataFrame, results: DataFrame, tools: tuple[Tool, ...]) -> DataFrame:
    """One row per call: ``conv_id, turn, call_id, name, level, linked, errors, message``.

    ``calls`` has ``conv_id, turn, call_id, name, arguments, needs`` (JSON text, array of
    identifiers), ``results`` has ``conv_id, turn, call_id, content``.
    """
    calls, results = _keyed(calls, "name", "arguments", "needs"), _keyed(results, "content")
    named = materialize(_first(calls, "conv", "name", "arguments", "needs"), "calls")
    needs = named.select("conv_id", "call_id", F.explode("needs").alias("needs")).distinct()
    known = named.select("conv_id", F.col("call_id").alias("needs"))
    missing = (
        needs.filter(F.col("needs").isNotNull()).join(known, ["conv_id", "needs"], "left_anti")
        .groupBy("conv_id", "call_id").agg(F.count(F.lit(1)).alias("n_missing"))
    )
    level = levels(named, needs.join(known, ["conv_id", "needs"], "left_semi").select("conv_id", "call_id", "needs"))
    answers = _first(results, "content").select("conv_id", "call_id", "content", F.lit(True).alias("answered"), "n_rows")
    answers = answers.withColumnRenamed("n_rows", "n_results")
    linked = (
        named.withColumn("duplicate", F.lit(False)).join(level, ["conv_id", "call_id"], "left")
        .join(answers, ["conv_id", "call_id"], "left")
        .join(missing, ["conv_id", "call_id"], "left")
    )
    nameless = calls.filter(F.col("call_id").isNull()).select(
        "conv", "turn", "call_id", "name", "arguments", F.lit(0).alias("level"),
        F.lit(None).cast("string").alias("content"), F.lit(None).cast("boolean").alias("answered"),
        F.lit(None).cast("long").alias("n_missing"), F.lit(None).cast("long").alias("n_results"),
        F.lit(False).alias("duplicate"),
    )
    later = _later(calls, named, "conv", "name", "arguments", "needs").withColumn("duplicate", F.lit(True))
    rows = later.drop("conv_id", "needs").unionByName(linked.select(*nameless.columns), allowMissingColumns=True)
    rows = rows.unionByName(nameless).withColumn("parsed", F.try_parse_json("arguments"))
    errors = F.concat(
        argument_errors(tools, F.col("name"), F.col("arguments"), F.col("parsed")),
        F.when(F.col("n_missing") > 0, F.array(F.lit("missing_dependency"))).otherwise(F.array().cast("array<string>")),
        F.when(F.col("n_results") > 1, F.array(F.lit("multiple_results"))).otherwise(F.array().cast("array<string>")),
        F.when(F.col("duplicate"), F.array(F.lit("duplicate_id"))).otherwise(F.array().cast("array<string>")),
    )
    is_object = F.schema_of_variant("parsed").startswith("OBJECT")
    message = F.to_json(
        F.struct(
            F.when(is_object, F.col("parsed")).alias("arguments"), F.col("call_id").alias("id"), "name",
            F.col("content").alias("result"),
        ),
        {"ignoreNullFields": "false"},
    )
    return rows.select(
        F.col("conv").alias("conv_id"), "turn", "call_id", "name", "level",
        F.coalesce("answered", F.lit(False)).alias("linked"), errors.alias("errors"), message.alias("message"),
    )


def unlinked_results(calls: DataFrame, results: DataFrame) -> DataFrame:
    """``conv_id, turn, call_id, content, reason`` of the results that no call of
    ``link_calls`` has: ``no_identifier``, ``no_call`` or ``later_result``."""
    calls, results = _keyed(calls), _keyed(results, "content")
    known = calls.filter(F.col("call_id").isNotNull()).select("conv_id", "call_id").distinct()
    columns = ["conv", "turn", "call_id", "content"]
    nameless = results.filter(F.col("call_id").isNull()).select(*columns, F.lit("no_identifier").alias("reason"))
    named = results.filter(F.col("call_id").isNotNull())
    orphans = named.join(known, ["conv_id", "call_id"], "left_anti").select(*columns, F.lit("no_call").alias("reason"))
    answers = named.join(known, ["conv_id", "call_id"], "left_semi")
    later = _later(answers, _first(answers, "conv", "content"), "conv", "content")
    later = later.select(*columns, F.lit("later_result").alias("reason"))
    return nameless.unionByName(orphans).unionByName(later).withColumnRenamed("conv", "conv_id")
