"""Nested records as related flat tables.

The children of nested arrays leave as Arrow buffers: list offsets give each
child its parent and its position, and the record's key follows by a
vectorised take. No row is visited in Python.

Text bodies get their nested type in the JVM first (:func:`parse_documents`):
envelopes and doubly encoded bodies are opened, a lone object becomes an array
of one, leaves stay strings so that no wrong type loses a child.

Defined results: a null list or record has no children; a null element gives
no row but takes a position; an element that is no object likewise; a body
that is null, empty, cut off, followed by anything else, or no JSON object has
no children; envelopes and quoting are opened however deep they lie. Fields that are not asked for are never read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_STRICT = {"allowSingleQuotes": "false"}
#: Layers of a body that are opened in one block of steps.
_LAYERS = 16


def list_children(lists: pa.Array) -> tuple[pa.Array, pa.Array, pa.Array]:
    """Parent index, position in the parent, and value of every element, nulls among them."""
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    parents = pc.list_parent_indices(lists).cast(pa.int64())
    lengths = pc.fill_null(pc.list_value_length(lists), 0).cast(pa.int64())
    before = pc.subtract(pc.cumulative_sum(lengths), lengths) if len(lists) else lengths
    values = pc.list_flatten(lists)
    pos = pc.subtract(pa.array(np.arange(len(values), dtype=np.int64)), pc.take(before, parents))
    return parents, pos, values


def descend(keys: Sequence[pa.Array], lists: pa.Array, parent_pos: pa.Array | None = None) -> tuple[list[pa.Array], pa.Array, pa.Array, pa.Array]:
    """Keys, position of the parent (-1 at the top), own position and value of the non-null children."""
    parents, pos, values = list_children(lists)
    here = pc.is_valid(values)
    parents, pos, values = parents.filter(here), pos.filter(here), values.filter(here)
    up = pc.take(parent_pos, parents) if parent_pos is not None else pa.array(np.full(len(pos), -1))
    return [pc.take(k, parents) for k in keys], up, pos, values


def flatten(df: DataFrame, key: str, emit: Callable[[pa.Array, pa.StructArray], Iterator[pa.RecordBatch]], doc: str, schema: str) -> DataFrame:
    """Run ``emit`` over the key and the nested column of every Arrow batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                yield from emit(b.column(0), b.column(1))

    return df.select(key, doc).mapInArrow(run, schema)


def node_rows(nodes: dict[str, tuple[str, ...]], key_type: pa.DataType) -> Callable[[pa.Array, pa.StructArray], Iterator[pa.RecordBatch]]:
    """Emitter of (key, node, parent_pos, pos) for paths of one or two lists below the document."""

    def emit(key: pa.Array, doc: pa.StructArray) -> Iterator[pa.RecordBatch]:
        first: dict[str, tuple] = {}
        for node, path in nodes.items():
            if path[0] not in first:
                first[path[0]] = descend([key], pc.struct_field(doc, path[0]))
            ks, up, pos, values = first[path[0]]
            if len(path) == 2:
                ks, up, pos, values = descend(ks, pc.struct_field(values, path[1]), pos)
            yield pa.record_batch([ks[0].cast(key_type), pa.array(np.full(len(pos), node), pa.string()), up.cast(pa.int32()), pos.cast(pa.int32())], names=["key", "node", "parent_pos", "pos"])

    return emit


def child_table(df: DataFrame, key: str, doc: str, path: Sequence[str], fields: Sequence[tuple[str, str]]) -> DataFrame:
    """The typed children at ``path`` (one or two lists below the struct ``doc``) as a flat table.

    ``fields`` are (name, Spark type). Columns: the key, parent_pos, pos, the fields.
    """
    key_type = dict(df.dtypes)[key]

    def emit(k: pa.Array, d: pa.StructArray) -> Iterator[pa.RecordBatch]:
        ks, up, pos, values = descend([k], pc.struct_field(d, path[0]))
        if len(path) == 2:
            ks, up, pos, values = descend(ks, pc.struct_field(values, path[1]), pos)
        cols = [pc.struct_field(values, n) for n, _ in fields]
        yield pa.record_batch([ks[0], up.cast(pa.int32()), pos.cast(pa.int32()), *cols], names=["_key", "parent_pos", "pos", *[n for n, _ in fields]])

    schema = f"_key {key_type}, parent_pos int, pos int, " + ", ".join(f"`{n}` {t}" for n, t in fields)
    return flatten(df, key, emit, doc, schema).withColumnRenamed("_key", key)


def _once(col: Column, f: Callable[[Column], Column]) -> Column:
    """``f`` of a column that is evaluated once, however often ``f`` uses it."""
    return F.get(F.transform(F.array(col), f), F.lit(0))


def _array_of(text: Column, struct: str) -> Column:
    """A JSON array of objects, a lone object, or an array with other things in it; else null."""
    plain = F.from_json(text, f"array<{struct}>", _STRICT)
    mixed = F.transform(F.from_json(text, "array<string>", _STRICT), lambda e: F.when(e.startswith("{"), F.from_json(e, struct, _STRICT)))
    return F.coalesce(plain, F.when(text.startswith("["), mixed))


def _only(text: Column, of: str) -> Column:
    """The one complete JSON value of ``text``; null where there is none, or more than one."""
    return _once(F.from_json(F.concat(F.lit('{"d":['), text, F.lit("]}")), f"struct<d:array<{of}>,_bad:string>", _STRICT | {"columnNameOfCorruptRecord": "_bad"}), lambda a: F.when(F.size(a["d"]) == 1, a["d"][0]))


def _strings(names: Sequence[str]) -> str:
    return "struct<" + ", ".join(f"`{n}`: string" for n in names) + ">"


def opened(text: Column, names: Sequence[str], envelope: str) -> Column:
    """The innermost document of a body: quoting and envelopes are opened until there is none left.

    An envelope is an object with the field ``envelope`` and none of ``names``.
    Each layer takes two characters at least, which bounds the steps of the
    fold. They go in blocks, and blocks after the last layer do nothing.
    """
    def quoted(t: Column) -> Column:
        return F.regexp_like(t, F.lit(r'\A\s*"'))

    def layer(text: Column, more: Column) -> Column:
        return F.struct(text.alias("text"), more.alias("more"))

    def open_object(t: Column) -> Column:
        def inner(d: Column) -> Column:
            wrapped = d[envelope].isNotNull()
            for n in names:
                wrapped = wrapped & d[n].isNull()
            return F.when(wrapped, layer(d[envelope], F.lit(True))).otherwise(layer(t, F.lit(False)))

        return _once(_only(t, _strings([envelope, *names])), inner)

    def step(s: Column, _: Column) -> Column:
        t = s["text"]
        return F.when(~s["more"] | t.isNull(), s).when(quoted(t), layer(_only(t, "string"), F.lit(True))).otherwise(open_object(t))

    def block(s: Column, _: Column) -> Column:
        return F.when(s["more"] & s["text"].isNotNull(), F.aggregate(F.sequence(F.lit(1), F.lit(_LAYERS)), s, step)).otherwise(s)

    blocks = F.sequence(F.lit(1), F.floor(F.length(text) / (2 * _LAYERS)).cast("int") + 1)
    # a field's name may be written with escapes, so a text with escapes of ASCII letters is looked into
    may = quoted(text) | text.contains(f'"{envelope}"') | F.regexp_like(text, F.lit(r"\\u00[4-7]"))
    return F.when(may, F.aggregate(blocks, layer(text, F.lit(True)), block, lambda s: s["text"])).otherwise(text)


def parent_table(df: DataFrame, key: str, body: str, lists: Sequence[str], fields: Sequence[str], envelope: str = "payload") -> DataFrame:
    """The documents' own ``fields`` as strings, a row for each body that holds a document.

    Envelopes are opened as in :func:`parse_documents` with these ``lists``.
    """
    got = df.select(F.col(key).alias("_key"), _only(opened(F.col(body), lists, envelope), _strings(fields)).alias("_got"))
    # as the element of an array the document is made once and not once a field
    return got.select("_key", F.explode(F.array("_got")).alias("_got")).where("_got IS NOT NULL").select(F.col("_key").alias(key), *[F.col("_got")[n].alias(n) for n in fields])


def parse_documents(df: DataFrame, key: str, body: str, lists: dict[str, dict[str, str]], leaf: dict[str, str], envelope: str = "payload") -> DataFrame:
    """Columns: the key and ``doc``, a struct of lists of structs of lists.

    ``lists`` names the document's lists and, for each, its own child lists
    with their type array<struct<...>>; ``leaf`` gives the scalar fields of each list's
    elements as a DDL fragment. All layers of envelopes and quoting are opened.

    A document is parsed once to its full type. Where the parser reports
    something of another shape (a lone object for a list, an element that is no
    object), it is parsed again level by level.
    """
    names = list(lists)
    kinds = {n: f"array<struct<{', '.join([*([leaf[n]] if leaf.get(n) else []), *[f'`{c}`: {t}' for c, t in lists[n].items()]])}>>" for n in names}
    full = "struct<" + ", ".join(f"`{n}`: {t}" for n, t in kinds.items()) + ">"

    def slowly(t: Column) -> Column:
        return _once(_only(t, _strings(names)), lambda g: F.struct(*[_children(g[n], lists[n], leaf.get(n, "")).alias(n) for n in names]))

    def document(t: Column) -> Column:
        got = F.from_json(F.concat(F.lit('{"d":['), t, F.lit("]}")), f"struct<d:array<{full}>,_bad:string>", _STRICT | {"columnNameOfCorruptRecord": "_bad"})
        good = lambda g: g["_bad"].isNull() & (F.size(g["d"]) == 1) & F.get(g["d"], F.lit(0)).isNotNull()
        return _once(got, lambda g: F.when(good(g), F.get(g["d"], F.lit(0))).otherwise(slowly(t)))

    return df.select(F.col(key).alias(key), _once(opened(F.col(body), names, envelope), document).alias("doc"))


def _children(text: Column, kids: dict[str, str], leaf: str) -> Column:
    if not kids:
        return _array_of(text, f"struct<{leaf}>")
    scalars = [f.split(":")[0].strip(" `") for f in leaf.split(",") if f.strip()]
    fields = ", ".join([*([leaf] if leaf else []), *[f"`{c}`: string" for c in kids]])
    arr = _array_of(text, f"struct<{fields}>")

    def typed(s: Column) -> Column:
        return F.when(s.isNotNull(), F.struct(*[s[x].alias(x) for x in scalars], *[_array_of(s[c], t.removeprefix("array<").removesuffix(">")).alias(c) for c, t in kids.items()]))

    return F.transform(arr, typed)
