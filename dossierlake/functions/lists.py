"""Lists and JSON kept in cells."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

from dossierlake.functions.text import clean_text, strip, strip_fences


def parse_list(value: Column) -> Column:
    """A list literal as an array of text; a plain value is a list of one; blank and null are empty."""
    t = clean_text(value)
    inner = F.regexp_extract(t, r"(?s)^\[(.*)\]$", 1)
    quoted = F.regexp_extract_all(inner, F.lit(r"""'((?:[^'\\]|\\.)*)'(?=\s*(?:,|$))|"((?:[^"\\]|\\.)*)"(?=\s*(?:,|$))|([^,'"\s][^,]*)"""), F.lit(0))
    bare = F.transform(quoted, lambda q: F.regexp_replace(F.regexp_replace(strip(q), r"""^['"]|['"]$""", ""), r"\\(.)", "$1"))
    return F.when(t.rlike(r"(?s)^\[.*\]$"), F.filter(bare, lambda x: x != "")).when(t == "", F.array().cast("array<string>")).otherwise(F.array(t))


def safe_list(value: Column) -> Column:
    """A list in a cell as distinct lower-case entries; without brackets it is split at commas."""
    t = clean_text(value)
    loose = F.transform(F.split(t, ","), lambda x: F.lower(strip(x)))
    strict = F.transform(parse_list(value), lambda x: F.lower(strip(x)))
    return F.array_distinct(F.filter(F.when(t.rlike(r"^\["), strict).otherwise(loose), lambda x: x != ""))


def jaccard(a: Column, b: Column) -> Column:
    """Size of the common part over the whole; two empty lists are equal."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / union)


def categories_in(value: Column, keywords: dict[str, list[str]]) -> Column:
    """The categories with any keyword as a substring, without case, in the order of the dictionary."""
    t = F.lower(F.coalesce(value, F.lit("")))
    hits = []
    for name, words in keywords.items():
        hit = F.lit(False)
        for w in words:
            hit = hit | F.contains(t, F.lit(w.lower()))
        hits.append(F.when(hit, F.lit(name)))
    return F.array_compact(F.array(*hits))


def flatten_any(value: Column, depth: int) -> Column:
    """Arrays of arrays, depth levels deep, as one."""
    for _ in range(depth):
        value = F.flatten(value)
    return value


LABEL = T.StructType([T.StructField("topic", T.StringType()), T.StructField("confidence", T.IntegerType())])
TOPICS = T.StructType([T.StructField("reasoning", T.StringType()), T.StructField("topic_labels", T.ArrayType(LABEL))])


def topic_map(value: Column) -> Column:
    """topic -> score from a label in any shape: a name, a list of names, an object of scores, or a list of objects with topic and confidence. What cannot be read gives an empty map."""
    t = strip_fences(F.coalesce(value, F.lit("")))
    v = F.try_parse_json(t)
    objects = F.try_variant_get(v, "$", "array<struct<topic:string,confidence:double>>")
    names = F.try_variant_get(v, "$", "array<string>")
    scores = F.try_variant_get(v, "$", "map<string,double>")
    as_map = lambda items: F.map_from_entries(F.filter(items, lambda e: e["key"].isNotNull()))
    from_objects = as_map(F.transform(objects, lambda o: F.struct(o["topic"].alias("key"), F.coalesce(o["confidence"], F.lit(100.0)).alias("value"))))
    from_names = as_map(F.transform(F.array_distinct(names), lambda n: F.struct(n.alias("key"), F.lit(100.0).alias("value"))))
    from_name = F.when((t != "") & ~t.rlike(r"^[\[{]"), F.create_map(F.regexp_replace(t, '^"|"$', ""), F.lit(100.0)))
    empty = F.create_map().cast("map<string,double>")
    return F.when(t.rlike(r"^\{"), F.coalesce(scores, empty)).when(t.rlike(r"(?s)^\[\s*\{"), F.coalesce(from_objects, empty)).when(t.rlike(r"^\["), F.coalesce(from_names, empty)).otherwise(F.coalesce(from_name, empty))


def recover(label: Column, error: Column, field: str) -> Column:
    """The label, or the field of the JSON in the error text where the label is missing."""
    return F.coalesce(label, F.get_json_object(strip_fences(error), f"$.{field}"))


def reply_text(line: Column) -> Column:
    """The text of a model's reply in a batch result line, in either body shape, or null."""
    paths = ("$.response.body", "$.result.body", "$.result", "$.body")
    texts = [F.get_json_object(line, p + tail) for p in paths for tail in (".choices[0].message.content", ".output[0].content[0].text", ".output[1].content[0].text")]
    return F.coalesce(*texts)


def reply_id(line: Column) -> Column:
    return F.coalesce(F.get_json_object(line, "$.custom_id"), F.get_json_object(line, "$.id"))


def reply_error(line: Column) -> Column:
    """Why a line has no usable reply, or null."""
    said = F.coalesce(F.get_json_object(line, "$.error.message"), F.get_json_object(line, "$.error"))
    return F.when(F.try_parse_json(line).isNull(), "not JSON").when(said.isNotNull(), said).when(reply_text(line).isNull(), "no reply")
