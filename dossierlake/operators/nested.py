"""Deeply nested records as related flat tables.

The general part, `flatten_records`, takes any column of JSON records. It infers one schema merged over all records
(`schema_of_variant_agg`, a distributed aggregate whose result is one string) and walks it: every array of objects
becomes a child table by `posexplode`, with the parent's surrogate key and the ordinal in the array. Objects inside
objects are flattened into dotted columns. Keys are paths of ordinals (`7/sec[0]/p[2]`), so they need neither a
shuffle nor a counter and are the same in every run.

The XML part turns a file into such a record: elements of the kinds asked for, nested under the nearest enclosing
section, each with its number in document order. A file that is not well-formed gives no record but a reason.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from html.entities import html5
from xml.parsers import expat

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from dossierlake.session import cut_lineage

#: The entities XML itself defines.
XML_ENTITIES = ("amp", "lt", "gt", "quot", "apos")
ENTITY = re.compile(r"&([A-Za-z][A-Za-z0-9]*);")
KINDS = ("sec", "title", "p")
#: Sections nested deeper than this go into a record of their own, at any depth.
LEVELS_A_ROUND = 12


def resolve_entities(text: str) -> str:
    """HTML named entities as numeric references; XML's own and unknown ones stay, so the parser judges them."""

    def one(m: re.Match) -> str:
        if m[1] in XML_ENTITIES:
            return m[0]
        chars = html5.get(m[1] + ";")
        return m[0] if chars is None else "".join(f"&#{ord(c)};" for c in chars)

    return ENTITY.sub(one, text)


def xml_record(content: str | None, with_text: bool = True) -> tuple[list[tuple[int, str]] | None, str | None]:
    """([(number of the section above, or 0; record as JSON)], None), or (None, reason) for a file that is empty or not well-formed."""
    if content is None or not content.strip("\ufeff \t\r\n"):
        return None, "empty"
    parser = expat.ParserCreate("utf-8", "}")
    parser.buffer_text = True
    counts = dict.fromkeys(KINDS, 0)
    root: dict = {}
    sections, opened = [root], []  # opened: an entry for each open element; None for kinds that are passed over

    def start(name: str, _: dict) -> None:
        kind = name.rpartition("}")[2]
        if kind not in counts:
            opened.append(None)
            return
        counts[kind] += 1
        item: dict = {"no": counts[kind]}
        if with_text and kind != "sec":
            item["text"] = []
        sections[-1].setdefault(kind, []).append(item)
        opened.append(item)
        if kind == "sec":
            sections.append(item)

    def end(name: str) -> None:
        item = opened.pop()
        if item is not None and name.rpartition("}")[2] == "sec":
            sections.pop()

    def data(chars: str) -> None:
        for item in reversed(opened):
            if item is not None:
                if "text" in item:
                    item["text"].append(chars)
                return

    parser.StartElementHandler, parser.EndElementHandler = start, end
    if with_text:
        parser.CharacterDataHandler = data
    try:
        parser.Parse(resolve_entities(content.removeprefix("\ufeff")).encode("utf-8", "surrogatepass"), True)
    except expat.ExpatError as e:
        return None, f"{expat.errors.messages.get(e.code, 'not well-formed')} at line {e.lineno}"
    return _records(root, with_text), None


def _records(root: dict, with_text: bool) -> list[tuple[int, str]]:
    """The root's record, and one for the sections below each section at LEVELS_A_ROUND levels, twice as many, and so on; texts as single strings."""
    found, stack = [(0, root)], [(root, 0)]
    while stack:
        item, depth = stack.pop()
        for kind in ("title", "p"):
            for x in item.get(kind, ()) if with_text else ():
                x["text"] = " ".join("".join(x["text"]).split())
        stack += [(s, depth + 1) for s in item.get("sec", ())]
        if depth and depth % LEVELS_A_ROUND == 0 and "sec" in item:
            found.append((item["no"], {"sec": item.pop("sec")}))
    return [(parent, json.dumps(record, ensure_ascii=False)) for parent, record in found]


def xml_records(df: DataFrame, id_col: str, content: str, with_text: bool = True) -> DataFrame:
    """(id, parent, record, error): each file parsed once, in Arrow batches; a row for each of its records, or one with the error."""
    entry = T.StructType([T.StructField("parent", T.IntegerType()), T.StructField("record", T.StringType())])
    schema = T.StructType([T.StructField("records", T.ArrayType(entry)), T.StructField("error", T.StringType())])

    @F.pandas_udf(schema)
    def parse(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            parsed = [xml_record(x, with_text) for x in batch]
            yield pd.DataFrame({"records": [r and [{"parent": n, "record": x} for n, x in r] for r, _ in parsed], "error": [e for _, e in parsed]}, dtype=object)

    files = df.select(F.col(id_col).alias("id"), parse(F.col(content)).alias("x"))
    return files.select("id", F.explode_outer("x.records").alias("r"), "x.error").select("id", "r.parent", "r.record", "error")


def merged_schema(df: DataFrame, record: str) -> T.StructType:
    """The schema that holds every record: one distributed aggregate, whose result has the size of the schema."""
    found = df.select(F.expr(f"schema_of_variant_agg(try_parse_json({record}))").alias("s")).first()["s"]
    if not found or not found.startswith("OBJECT"):
        return T.StructType([])
    return _struct(T._parse_datatype_string(found.replace("OBJECT<", "STRUCT<").replace("VOID", "STRING")))


def _struct(t: T.DataType) -> T.DataType:
    """Integers of records are BIGINT; what records disagree on (VARIANT) is kept as its JSON text."""
    if isinstance(t, T.StructType):
        return T.StructType([T.StructField(f.name, _struct(f.dataType)) for f in t.fields])
    if isinstance(t, T.ArrayType):
        return T.ArrayType(_struct(t.elementType))
    if isinstance(t, T.DecimalType):
        return T.DoubleType() if t.scale else T.LongType()
    return T.StringType() if isinstance(t, T.VariantType) else t


def _leaves(t: T.StructType, at: Column, name: str = "") -> Iterator[tuple[str, Column]]:
    for f in t.fields:
        if isinstance(f.dataType, T.StructType):
            yield from _leaves(f.dataType, at.getField(f.name), f"{name}{f.name}.")
        elif not _is_child(f.dataType):
            yield name + f.name, at.getField(f.name)


def _is_child(t: T.DataType) -> bool:
    return isinstance(t, T.ArrayType) and isinstance(t.elementType, T.StructType)


def _children(t: T.StructType, at: Column, name: str = "") -> Iterator[tuple[str, Column, T.StructType]]:
    for f in t.fields:
        if isinstance(f.dataType, T.StructType):
            yield from _children(f.dataType, at.getField(f.name), f"{name}{f.name}.")
        elif _is_child(f.dataType):
            yield name + f.name, at.getField(f.name), f.dataType.elementType


def flatten_records(df: DataFrame, id_col: str, record: str, schema: T.StructType | None = None) -> dict[str, DataFrame]:
    """Flat tables by path: '' holds a row for each record, 'a.b' a row for each object of the array a.b, at any depth.

    Columns: id, key (the row's surrogate key), parent_key, pos (ordinal in the array, from 1), then the scalar fields,
    whose names a record may choose freely, behind a `v_` so that none clashes. Null or unreadable records have a row in
    the table '' with null fields and none below; empty or missing arrays have no child rows.
    """
    schema = schema or merged_schema(df, record)
    parsed = F.from_json(F.col(record), schema) if schema.fields else F.lit(None)
    base = df.select(F.col(id_col).alias("id"), F.col(id_col).cast("string").alias("key"), F.lit(None).cast("string").alias("parent_key"), F.lit(1).alias("pos"), parsed.alias("v"))
    tables: dict[str, DataFrame] = {}

    def walk(path: str, rows: DataFrame, t: T.StructType) -> None:
        tables[path] = rows.select("id", "key", "parent_key", "pos", *(c.alias("v_" + n) for n, c in _leaves(t, F.col("v"))))
        for name, array, element in _children(t, F.col("v")):
            one = rows.select("id", F.col("key").alias("parent_key"), F.posexplode(array).alias("at", "v"))
            keyed = one.select("id", F.concat_ws("", "parent_key", F.lit(f"/{name}["), "at", F.lit("]")).alias("key"), "parent_key", (F.col("at") + 1).alias("pos"), "v")
            walk(f"{path}.{name}" if path else name, keyed, element)

    walk("", base, schema)
    return tables


ELEMENT = "kind: string, node_no: int, parent_sec_no: int, pos: int, text: string"


def _elements(t: T.StructType, v: Column, parent: Column, with_text: bool) -> tuple[Column, T.StructType | None]:
    """(array, type): the elements directly in a section v of type t, as structs of ELEMENT and `v`, the section itself where it may hold more (null for other kinds); the type is that of `v`, or null if there is nothing below."""
    arrays = {n: (c, e) for n, c, e in _children(t, v) if n in KINDS}
    below = arrays["sec"][1] if "sec" in arrays and any(n in KINDS for n in arrays["sec"][1].fieldNames()) else None

    def one(kind: str):
        return lambda e, at: F.struct(
            F.lit(kind).alias("kind"), e["no"].cast("int").alias("node_no"), parent.alias("parent_sec_no"), (at + 1).cast("int").alias("pos"),
            (e["text"] if with_text and kind != "sec" else F.lit(None).cast("string")).alias("text"), *([(e if kind == "sec" else F.lit(None).cast(below)).alias("v")] if below else []),
        )

    found = [F.coalesce(F.transform(c, one(kind)), F.array()) for kind, (c, _) in arrays.items()]
    return F.concat(*found) if found else F.array(), below


def section_tables(df: DataFrame, id_col: str, content: str, with_text: bool = True) -> tuple[DataFrame, DataFrame]:
    """(elements, rejects) of XML files.

    elements: id, kind, node_no, parent_sec_no (0 without an enclosing section), pos (ordinal among its siblings of that
    kind) and text (null for sections and without with_text). rejects: id, error. Null, empty and damaged contents are
    rejects; a repeated id keeps the rows of both files; an empty table gives two empty tables.

    Every record is parsed once. Each level of the merged schema is one explode: a section becomes its own row and a row for each
    element in it, with its number as the parent's key, and rows of upper levels pass through; no joins and no shuffles.
    """
    records = cut_lineage(xml_records(df, id_col, content, with_text))
    rejects = records.where("error is not null").select("id", "error")
    good = records.where("record is not null").select("id", "record", "parent")
    t = merged_schema(good, "record")
    if not any(n in KINDS for n in t.fieldNames()):
        return records.select("id", F.explode(F.array().cast(f"array<struct<{ELEMENT}>>")).alias("e")).select("id", "e.*"), rejects
    parsed = good.select("id", "parent", F.from_json("record", t).alias("v"))
    found, below = _elements(t, F.col("v"), F.col("parent"), with_text)
    level = parsed.select("id", F.explode(found).alias("e"))
    while below is not None:
        inside, deeper = _elements(below, F.col("e.v"), F.col("e.node_no"), with_text)
        own = F.struct(*(F.col(f"e.{n}").alias(n) for n in ("kind", "node_no", "parent_sec_no", "pos", "text")), *([F.lit(None).cast(deeper).alias("v")] if deeper else []))
        level, below = level.select("id", F.explode(F.concat(F.array(own), inside)).alias("e")), deeper
    return level.select("id", "e.kind", "e.node_no", "e.parent_sec_no", "e.pos", "e.text"), rejects
