"""Registered Avro record schemas compiled to column expressions.

The schema text of a registry, in any number of versions, becomes one SQL expression
that reads the frames of all of them into the fields of a reader schema: fields that the
reader does not have are read over, missing ones get their default, and numbers are
widened. Records may be nested and hold null, boolean, int, long, float, double, bytes,
string, enum, fixed, arrays, and unions of null with one of these.

Everything is built-in expressions. An expression reads one value at a position and gives
the value ``v``, the next position ``p`` and an error ``e``; the position is null after an
error, so what follows reads nothing, and the first error is the frame's. Values are
bound to names by a transform over an array of one.
"""

from __future__ import annotations

import itertools
import json
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.functions.frames import (
    BAD_LENGTH, BAD_MAGIC, BAD_TEXT, HEADER_BYTES, MAGIC_HEX, TRUNCATED, UNKNOWN_SCHEMA, _varint_sql,
)

BAD_BRANCH, BAD_NUMBER, NULL_VALUE, UNSUPPORTED = "bad_branch", "bad_number", "null_value", "unsupported_schema"

# Fixed values of the format: Spark types, and what a writer's number may be read as.
TYPES = {"null": "void", "boolean": "boolean", "int": "int", "long": "bigint", "float": "float", "double": "double",
         "bytes": "binary", "string": "string", "enum": "string", "fixed": "binary"}
# Bytes of the longest number.
MOST_BYTES = 10
WIDER = {"int": ("long", "float", "double"), "long": ("float", "double"), "float": ("double",), "string": ("bytes",), "bytes": ("string",)}


class SchemaError(ValueError):
    """The schema cannot be read here, or not into the reader's."""


@dataclass(frozen=True)
class Node:
    """A type of a schema; ``nullable`` with the number of the null branch if it is a union."""

    kind: str
    fields: tuple[tuple[str, Node, Any, bool], ...] = ()
    item: Node | None = None
    symbols: tuple[str, ...] = ()
    size: int = 0
    null_branch: int | None = None
    aliases: tuple[tuple[str, str], ...] = ()

    @property
    def ddl(self) -> str:
        if self.kind == "record":
            return "struct<" + ", ".join(f"`{name}`: {node.ddl}" for name, node, _, _ in self.fields) + ">"
        return f"array<{self.item.ddl}>" if self.kind == "array" else TYPES[self.kind]


def parse_schema(text: str) -> Node:
    """The record schema of a JSON text."""
    try:
        node = _node(json.loads(text), {}, ())
    except (json.JSONDecodeError, KeyError, TypeError) as error:
        raise SchemaError(f"not a schema: {error}") from error
    if node.kind != "record" or node.null_branch is not None:
        raise SchemaError("the schema is not a record")
    return node


def _node(schema: Any, named: dict[str, Node], inside: tuple[str, ...]) -> Node:
    if isinstance(schema, list):
        others = [s for s in schema if s != "null"]
        if len(others) != 1 or len(schema) > 2:
            raise SchemaError("a union has null and one other type")
        node = _node(others[0], named, inside)
        branch = schema.index("null") if "null" in schema else None
        return Node(**{**node.__dict__, "null_branch": branch}) if branch is not None else _one_branch(node)
    if isinstance(schema, str):
        if schema in inside:
            raise SchemaError(f"{schema} holds itself")
        if schema in named:
            return named[schema]
        if schema not in TYPES or schema in ("enum", "fixed"):
            raise SchemaError(f"unknown type {schema!r}")
        return Node(schema)
    kind = schema["type"]
    if kind == "record":
        name = schema["name"]
        fields, aliases = [], []
        for field in schema["fields"]:
            child = _node(field["type"], named, (*inside, name))
            fields.append((field["name"], child, field.get("default"), "default" in field))
            aliases += [(alias, field["name"]) for alias in field.get("aliases", ())]
        named[name] = Node("record", tuple(fields), aliases=tuple(aliases))
        return named[name]
    if kind == "enum":
        named[schema["name"]] = Node("enum", symbols=tuple(schema["symbols"]))
        return named[schema["name"]]
    if kind == "fixed":
        named[schema["name"]] = Node("fixed", size=schema["size"])
        return named[schema["name"]]
    if kind == "array":
        return Node("array", item=_node(schema["items"], named, inside))
    if kind == "map":
        raise SchemaError("maps are not read")
    return _node(kind, named, inside)


def _one_branch(node: Node) -> Node:
    """A union of a single type still has the number of its branch in front."""
    return Node(**{**node.__dict__, "null_branch": -1})


# --- expressions ----------------------------------------------------------------


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _literal(value: Any, node: Node) -> str:
    """A default as SQL."""
    if value is None or node.kind == "null":
        return f"cast(NULL AS {node.ddl})"
    if node.kind == "record":
        parts = [f"{_text(name)}, {_literal(value.get(name, default), child)}" for name, child, default, _ in node.fields]
        return f"named_struct({', '.join(parts)})"
    if node.kind == "array":
        return f"cast(array({', '.join(_literal(v, node.item) for v in value)}) AS {node.ddl})"
    if node.kind in ("bytes", "fixed"):
        return f"X'{value.encode('latin-1').hex()}'"
    if node.kind in ("string", "enum"):
        return _text(value)
    return f"cast({_text(str(value).lower())} AS {node.ddl})"


class _Compiler:
    def __init__(self, column: str):
        self.b = f"`{column}`"
        self._numbers = itertools.count()

    def name(self) -> str:
        return f"x{next(self._numbers)}"

    def let(self, value: str, body) -> str:
        name = self.name()
        return f"get(transform(array({value}), {name} -> {body(name)}), 0)"

    @staticmethod
    def result(v: str, p: str, e: str = "cast(NULL AS string)") -> str:
        return f"named_struct('v', {v}, 'p', cast({p} AS bigint), 'e', {e})"

    def bytes_at(self, p: str, n: str) -> str:
        return f"substring({self.b}, cast({p} AS int), cast({n} AS int))"

    def long(self, p: str) -> str:
        """A zigzag number: seven bits a byte, lowest first, 0x80 on all but the last."""
        s, k, f = self.name(), self.name(), self.name()
        byte = f"cast(conv(hex(substring({self.b}, cast({s}.p AS int), 1)), 16, 10) AS bigint)"
        start = f"named_struct('v', 0L, 'p', cast({p} AS bigint), 'm', {p} IS NOT NULL)"
        step = (f"IF({s}.m AND {s}.p <= octet_length({self.b}), named_struct('v', {s}.v | shiftleft({byte} & 127, 7 * {k}), "
                f"'p', {s}.p + 1, 'm', {byte} >= 128), {s})")
        number = f"shiftrightunsigned({f}.v, 1) ^ (-({f}.v & 1L))"
        error = f"CASE WHEN NOT {f}.m THEN NULL WHEN {f}.p > octet_length({self.b}) THEN '{TRUNCATED}' ELSE '{BAD_LENGTH}' END"
        end = self.result(f"CASE WHEN NOT {f}.m AND {f}.p IS NOT NULL THEN {number} END", f"CASE WHEN NOT {f}.m THEN {f}.p END", error)
        return f"aggregate(sequence(0, {MOST_BYTES - 1}), {start}, ({s}, {k}) -> {step}, {f} -> {end})"

    def lacking(self, p: str, n: str) -> str:
        """Why ``n`` bytes at ``p`` cannot be read."""
        return f"CASE WHEN {n} < 0 THEN '{BAD_LENGTH}' WHEN {p} + {n} - 1 > octet_length({self.b}) THEN '{TRUNCATED}' END"

    def block(self, p: str, n: str, value) -> str:
        """``n`` bytes at ``p``, if they are there; ``value`` makes a result of bytes, next position and error."""
        e = self.lacking(p, n)
        return value(f"CASE WHEN {e} IS NULL THEN {self.bytes_at(p, n)} END", f"CASE WHEN {e} IS NULL THEN {p} + {n} END", e)

    def sized(self, p: str, value) -> str:
        def body(size: str) -> str:
            return self.block(f"{size}.p", f"{size}.v", lambda raw, after, e: value(raw, after, f"coalesce({size}.e, {e})"))

        return self.let(self.long(p), body)

    def string(self, p: str) -> str:
        def value(raw: str, after: str, e: str) -> str:
            return self.let(f"cast({raw} AS string)", lambda t: self.result(
                f"CASE WHEN is_valid_utf8({t}) THEN {t} END", after, f"coalesce({e}, CASE WHEN NOT is_valid_utf8({t}) THEN '{BAD_TEXT}' END)"))

        return self.sized(p, value)

    def real(self, p: str, size: int) -> str:
        """Sign, exponent and fraction of a little-endian number; every step is exact."""
        exponent_bits = 8 if size == 4 else 11
        fraction_bits = size * 8 - exponent_bits - 1
        bias, top = 2 ** (exponent_bits - 1) - 1, 2**exponent_bits - 1
        # Of a double, the fraction's bits among the first 32.
        inside = fraction_bits - 32 if size == 8 else fraction_bits

        def number(raw: str, first: int, last: int) -> str:
            digits = ", ".join(f"substring(hex({raw}), {2 * k + 1}, 2)" for k in reversed(range(first, last)))
            return f"cast(conv(concat({digits}), 16, 10) AS bigint)"

        def of(n: str) -> str:
            exponent = f"(shiftright({n}.a, {inside}) & {top})"
            first = f"cast(({n}.a & {2**inside - 1}) AS double)"
            fraction = f"({first} * 4294967296D + cast({n}.b AS double))" if size == 8 else first
            sign = f"CASE WHEN ({n}.a & {2**31}L) <> 0 THEN -1D ELSE 1D END"
            value = (
                f"CASE WHEN {exponent} = {top} THEN CASE WHEN {fraction} = 0D THEN {sign} * double('Infinity') ELSE double('NaN') END "
                f"WHEN {exponent} = 0 THEN {sign} * ({fraction} * power(2D, {1 - bias - fraction_bits}D)) "
                f"ELSE {sign} * ((1D + {fraction} * power(2D, -{fraction_bits}D)) * power(2D, cast({exponent} - {bias} AS double))) END"
            )
            return f"cast({value} AS {'float' if size == 4 else 'double'})"

        def value(raw: str, after: str, e: str) -> str:
            bits = f"named_struct('a', {number(raw, size - 4, size)}, 'b', {number(raw, 0, 4)})"
            return self.let(bits, lambda n: self.result(f"CASE WHEN {n}.a IS NOT NULL THEN {of(n)} END", after, e))

        return self.block(p, f"{size}", value)

    def array(self, writer: Node, reader: Node, p: str) -> str:
        """Blocks of a count and as many items, until a count of 0. Every step reads a count or an item."""
        kind = f"array<{reader.item.ddl}>"

        def state(p: str, left: str, v: str, e: str, done: str) -> str:
            return f"named_struct('p', cast({p} AS bigint), 'n', cast({left} AS bigint), 'v', cast({v} AS {kind}), 'e', cast({e} AS string), 'done', {done})"

        def step(s: str) -> str:
            def counted(c: str) -> str:
                # A negative count is followed by the bytes of the block.
                size = self.let(self.long(f"{c}.p"), lambda z: state(f"{z}.p", f"-{c}.v", f"{s}.v", f"{z}.e", "false"))
                return (f"CASE WHEN {c}.v IS NULL THEN {state('NULL', '0', f'{s}.v', f'{c}.e', 'true')} "
                        f"WHEN {c}.v < 0 THEN {size} ELSE {state(f'{c}.p', f'{c}.v', f'{s}.v', f'{c}.e', f'{c}.v = 0')} END")

            def added(i: str) -> str:
                return state(f"{i}.p", f"{s}.n - 1", f"concat({s}.v, array({i}.v))", f"{i}.e", f"{i}.e IS NOT NULL OR {i}.p IS NULL")

            head = self.let(self.long(f"{s}.p"), counted)
            item = self.let(self.value(writer.item, reader.item, f"{s}.p"), added)
            return f"CASE WHEN {s}.done OR {s}.e IS NOT NULL THEN {s} WHEN {s}.n = 0 THEN {head} ELSE {item} END"

        s, i = self.name(), self.name()
        steps = f"sequence(1, cast(greatest(octet_length({self.b}) - {p} + 2, 1) AS int))"
        walked = f"aggregate({steps}, {state(p, '0', 'array()', 'NULL', 'false')}, ({s}, {i}) -> {step(s)})"
        return self.let(f"CASE WHEN {p} IS NOT NULL THEN {walked} END", lambda w: self.result(
            f"{w}.v", f"CASE WHEN {w}.done AND {w}.e IS NULL THEN {w}.p END",
            f"coalesce({w}.e, CASE WHEN NOT {w}.done THEN '{TRUNCATED}' END)"))

    @staticmethod
    def resolved(writer: Node, reader: Node) -> tuple[list[tuple[Node, Node]], list[tuple[int, str]]]:
        """Pairs of written and wanted type in the writer's order, and the reader's fields: the
        place among the written ones, or -1 and the default."""
        renamed = dict(reader.aliases)
        wanted = {name: node for name, node, _, _ in reader.fields}
        pairs, places = [], {}
        for k, (name, node, _, _) in enumerate(writer.fields):
            name = name if name in wanted else renamed.get(name, name)
            pairs.append((node, wanted.get(name, node)))
            places[name] = k
        fields = []
        for name, node, default, has_default in reader.fields:
            if name not in places and not has_default:
                raise SchemaError(f"field {name!r} has no default and is not written")
            fields.append((places[name], "") if name in places else (-1, _literal(default, node)))
        return pairs, fields

    def gathered(self, reader: Node, fields: list[tuple[int, str]], results: list[str], p: str) -> str:
        """The record of the results of its written fields."""
        whole = ", ".join(
            f"{_text(name)}, {f'{results[k]}.v' if k >= 0 else default}" for (name, _, _, _), (k, default) in zip(reader.fields, fields)
        )
        errors = f"coalesce({', '.join(f'{r}.e' for r in results)}, NULL)" if results else "cast(NULL AS string)"
        return self.result(f"named_struct({whole})", f"{results[-1]}.p" if results else p, errors)

    def record(self, writer: Node, reader: Node, p: str) -> str:
        pairs, fields = self.resolved(writer, reader)
        results = [self.name() for _ in pairs]
        body = self.gathered(reader, fields, results, p)
        for k in reversed(range(len(results))):
            before = f"{results[k - 1]}.p" if k else p
            body = f"get(transform(array({self.value(*pairs[k], before)}), {results[k]} -> {body}), 0)"
        return body

    def value(self, writer: Node, reader: Node, p: str) -> str:
        if writer.null_branch is None:
            return self.plain(writer, reader, p)
        kind = reader.ddl

        def branch(u: str) -> str:
            # Readers that do not know null refuse it.
            refused = "cast(NULL AS string)" if reader.null_branch is not None else f"'{NULL_VALUE}'"
            null = self.result(f"cast(NULL AS {kind})", f"{u}.p", refused)
            other = self.plain(writer, reader, f"{u}.p")
            wrong = self.result(f"cast(NULL AS {kind})", "NULL", f"coalesce({u}.e, CASE WHEN {u}.v IS NOT NULL THEN '{BAD_BRANCH}' END)")
            number = 0 if writer.null_branch else 1
            return f"CASE WHEN {u}.v = {writer.null_branch} THEN {null} WHEN {u}.v = {number} THEN {other} ELSE {wrong} END"

        return self.let(self.long(p), branch)

    def plain(self, writer: Node, reader: Node, p: str) -> str:
        if writer.kind != reader.kind and reader.kind not in WIDER.get(writer.kind, ()):
            raise SchemaError(f"{writer.kind} cannot be read as {reader.kind}")
        if writer.kind == "record":
            return self.record(writer, reader, p)
        if writer.kind == "array":
            return self.array(writer, reader, p)

        def cast(read: str) -> str:
            if writer.kind == reader.kind:
                return read
            return self.let(read, lambda r: self.result(f"cast({r}.v AS {reader.ddl})", f"{r}.p", f"{r}.e"))

        if writer.kind == "null":
            return self.result("NULL", p)
        if writer.kind == "long":
            return cast(self.long(p))
        if writer.kind == "int":
            return self.let(self.long(p), lambda r: self.result(
                f"cast(try_cast({r}.v AS int) AS {reader.ddl})", f"{r}.p",
                f"coalesce({r}.e, CASE WHEN {r}.v IS NOT NULL AND try_cast({r}.v AS int) IS NULL THEN '{BAD_NUMBER}' END)"))
        if writer.kind in ("float", "double"):
            return cast(self.real(p, 4 if writer.kind == "float" else 8))
        if writer.kind == "string":
            return cast(self.string(p))
        if writer.kind == "bytes":
            if reader.kind == "string":
                return self.string(p)
            return self.sized(p, lambda raw, after, e: self.result(raw, after, e))
        if writer.kind == "fixed":
            if writer.size != reader.size:
                raise SchemaError("fixed types have different sizes")
            return self.block(p, f"{writer.size}", lambda raw, after, e: self.result(raw, after, e))
        if writer.kind == "boolean":
            return self.block(p, "1", lambda raw, after, e: self.result(
                f"CASE hex({raw}) WHEN '01' THEN true WHEN '00' THEN false END", after,
                f"coalesce({e}, CASE WHEN {raw} IS NOT NULL AND hex({raw}) NOT IN ('00', '01') THEN '{BAD_NUMBER}' END)"))
        symbols = ", ".join(map(_text, writer.symbols))
        return self.let(self.long(p), lambda r: self.result(
            f"get(array({symbols}), cast({r}.v AS int))", f"{r}.p",
            f"coalesce({r}.e, CASE WHEN {r}.v < 0 OR {r}.v >= {len(writer.symbols)} THEN '{BAD_NUMBER}' END)"))


def decode_versions(df: DataFrame, column: str, schemas: dict[int, str], reader: str) -> DataFrame:
    """Add ``schema_id``, the fields of the schema ``reader`` and ``error``.

    ``schemas`` has the text of each registered schema id. ``error`` is null for a good
    frame; otherwise the fields are null and it is the reason. Every frame is read once:
    filters on the result stay above the reading, and each field of the outer record is a
    column of its own until all are read.
    """
    target, compiler = parse_schema(reader), _Compiler(column)
    none = f"cast(NULL AS {target.ddl})"
    header = f"""CASE WHEN octet_length(`{column}`) IS NULL OR octet_length(`{column}`) < {HEADER_BYTES} THEN '{TRUNCATED}'
                      WHEN hex(substring(`{column}`, 1, 1)) <> '{MAGIC_HEX}' THEN '{BAD_MAGIC}' END"""
    found = df.selectExpr(
        "*", f"cast(conv(hex(substring(`{column}`, 2, 4)), 16, 10) AS bigint) AS _id", f"{header} AS _header"
    )
    cases, stages = [], []
    for schema_id, text in sorted(schemas.items()):
        try:
            writer = parse_schema(text)
            pairs, fields = compiler.resolved(writer, target)
            names = [f"_field_{schema_id}_{k}" for k in range(len(pairs))]
            reads = []
            for k, (node, wanted) in enumerate(pairs):
                before = f"`{names[k - 1]}`.p" if k else f"{HEADER_BYTES + 1}L"
                reads.append(f"CASE WHEN _header IS NULL AND _id = {schema_id} THEN {compiler.value(node, wanted, before)} END AS `{names[k]}`")
            whole = compiler.gathered(target, fields, [f"`{n}`" for n in names], f"{HEADER_BYTES + 1}L")
        except SchemaError:
            reads, whole = [], compiler.result(none, "NULL", f"'{UNSUPPORTED}'")
        stages.append(reads)
        cases.append(f"WHEN _id = {schema_id} THEN {whole}")
    for stage in itertools.zip_longest(*stages):
        found = found.selectExpr("*", *[read for read in stage if read])
    unknown = compiler.result(none, "NULL", f"'{UNKNOWN_SCHEMA}'")
    known = f"CASE {' '.join(cases)} ELSE {unknown} END" if cases else unknown
    found = found.selectExpr("*", f"CASE WHEN _header IS NULL THEN {known} END AS _read")
    good = "_header IS NULL AND _read.e IS NULL"
    values = [f"'schema_id', CASE WHEN {good} THEN _id END"]
    values += [f"{_text(name)}, CASE WHEN {good} THEN _read.v.`{name}` END" for name, _, _, _ in target.fields]
    values.append("'error', coalesce(_header, _read.e)")
    # A generated row keeps a filter on the result from being written out in terms of the reading.
    return found.select(*df.columns, F.expr(f"inline(array(named_struct({', '.join(values)})))"))


def registered_schemas(registry: DataFrame, subject: str) -> tuple[dict[int, str], str]:
    """The schema texts of a subject by id, and the newest one. The versions of a subject are few."""
    rows = registry.filter(F.col("subject") == subject).select("version", "schema_id", "schema").collect()
    if not rows:
        raise SchemaError(f"no schema of {subject!r}")
    newest = max(rows, key=lambda r: r["version"])
    return {int(r["schema_id"]): r["schema"] for r in rows}, newest["schema"]


def with_dead_letters(decoded: DataFrame) -> DataFrame:
    """Add ``dead`` (0 or 1): to be written by that column, so that good and bad rows come from one reading."""
    return decoded.withColumn("dead", F.col("error").isNotNull().cast("int"))


# --- writing ----------------------------------------------------------------------


def _written(node: Node, value: str, names) -> str:
    if node.null_branch is not None:
        if node.null_branch < 0:
            return f"concat(X'00', {_written(Node(**{**node.__dict__, 'null_branch': None}), value, names)})"
        null, other = ("X'00'", "X'02'") if node.null_branch == 0 else ("X'02'", "X'00'")
        return f"CASE WHEN {value} IS NULL THEN {null} ELSE concat({other}, {_written(Node(**{**node.__dict__, 'null_branch': None}), value, names)}) END"
    if node.kind in ("int", "long"):
        return _varint_sql(f"(shiftleft(cast({value} AS bigint), 1) ^ shiftright(cast({value} AS bigint), 63))")
    if node.kind == "string":
        return f"concat({_varint_sql(f'(2L * octet_length({value}))')}, encode({value}, 'UTF-8'))"
    if node.kind == "boolean":
        return f"CASE WHEN {value} THEN X'01' ELSE X'00' END"
    if node.kind == "record":
        return f"concat({', '.join(_written(child, f'{value}.`{name}`', names) for name, child, _, _ in node.fields)})"
    if node.kind == "array":
        x, total = next(names), next(names)
        items = f"aggregate({value}, X'', ({total}, {x}) -> concat({total}, {_written(node.item, x, names)}))"
        return f"CASE WHEN size({value}) = 0 THEN X'00' ELSE concat({_varint_sql(f'(2L * size({value}))')}, {items}, X'00') END"
    raise SchemaError(f"{node.kind} is not written")


def encode_record(schema_id: int, schema: str) -> Column:
    """Frame of a record whose fields are columns of these names. Numbers need less than 35 bits
    after zigzag; null, int, long, string, boolean, records and arrays are written."""
    names = (f"y{k}" for k in itertools.count())
    parts = [_written(child, f"`{name}`", names) for name, child, _, _ in parse_schema(schema).fields]
    return F.expr(f"concat(X'{MAGIC_HEX}{schema_id:08X}', {', '.join(parts)})")
