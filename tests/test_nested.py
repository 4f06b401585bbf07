import json
from xml.etree import ElementTree as ET

import pytest

from dossierlake.operators.nested import KINDS, LEVELS_A_ROUND, flatten_records, resolve_entities, section_tables, xml_record
from dossierlake.session import table


def elements(spark, rows, **kw):
    df = spark.createDataFrame(rows, "file_id bigint, content string, kind string, text string")
    found, rejects = section_tables(df, "file_id", "content", **kw)
    return found.collect(), {r["id"]: r["error"] for r in rejects.collect()}


def expected(content):
    """(kind, node_no, parent) by a walk of the tree."""
    seen, out = {}, set()

    def walk(e, sec):
        kind = e.tag.rpartition("}")[2]
        if kind in KINDS:
            seen[kind] = seen.get(kind, 0) + 1
            out.add((kind, seen[kind], sec))
            sec = seen[kind] if kind == "sec" else sec
        for c in e:
            walk(c, sec)

    walk(ET.fromstring(resolve_entities(content.removeprefix("﻿"))), 0)
    return out


GOOD = "<a><sec><title>A&nbsp;b</title><p>one<fn><p>in</p></fn></p><sec><p>two</p></sec></sec><!-- <sec/> --><p><![CDATA[<sec>]]>x</p></a>"


def test_sections_titles_and_paragraphs(spark):
    found, rejects = elements(spark, [(1, GOOD, "x", "y")])
    assert {(r["kind"], r["node_no"], r["parent_sec_no"]) for r in found} == expected(GOOD)
    assert not rejects
    texts = {(r["kind"], r["node_no"]): r["text"] for r in found if r["kind"] != "sec"}
    assert texts[("title", 1)] == "A b" and texts[("p", 2)] == "in" and texts[("p", 4)] == "<sec>x"


@pytest.mark.parametrize("content, ok", [
    (None, False), ("", False), ("  ", False), ("<a><sec></a>", False), ("<a>&unknown;</a>", False), ("<a>&LT;&rsquo;</a>", True), ("﻿<a/>", True),
    ("<n:a xmlns:n='u'><n:sec/></n:a>", True), ("<a><b:c/></a>", False), ('<?xml version="1.0" encoding="ISO-8859-1"?><a>é</a>', True), ("<a><article-title>t</article-title></a>", True),
])
def test_which_files_are_readable(content, ok):
    record, error = xml_record(content)
    assert (record is not None) == ok and (error is None) == ok


def test_other_title_elements_do_not_count(spark):
    found, _ = elements(spark, [(1, "<a><article-title>t</article-title><title/></a>", None, None)], with_text=False)
    assert [(r["kind"], r["node_no"]) for r in found] == [("title", 1)]


def test_nulls_repeats_and_empty_tables(spark):
    found, rejects = elements(spark, [(1, None, None, None), (2, GOOD, None, None), (2, GOOD, None, None)])
    assert list(rejects) == [1] and len(found) == 2 * len(expected(GOOD))
    assert elements(spark, []) == ([], {})
    assert elements(spark, [(1, "<a/>", None, None)]) == ([], {})


def test_deep_sections(spark):
    deep = "<a>" + "<sec>" * (LEVELS_A_ROUND + 3) + "<p>x</p>" + "</sec>" * (LEVELS_A_ROUND + 3) + "</a>"
    found, _ = elements(spark, [(1, deep, None, None)], with_text=False)
    assert {(r["kind"], r["node_no"], r["parent_sec_no"]) for r in found} == expected(deep)


def test_whole_table(spark, small):
    df = table(spark, small, "articleiv_xml_updated")
    found, rejects = section_tables(df, "file_id", "content", with_text=False)
    got, bad = {(r["id"], r["kind"], r["node_no"], r["parent_sec_no"]) for r in found.collect()}, {r["id"] for r in rejects.collect()}
    want = set()
    for r in df.collect():
        try:
            want |= {(r["file_id"], *x) for x in expected(r["content"] or "")}
            assert r["file_id"] not in bad
        except ET.ParseError:
            assert r["file_id"] in bad
    assert got == want


def test_any_json_records(spark):
    rows = [(1, json.dumps({"a": 1, "o": {"x": "u"}, "items": [{"n": 1, "sub": [{"k": "a"}, {"k": "b"}]}, {"n": 2}]})), (2, json.dumps({"a": None, "items": []})), (3, "broken"), (4, None)]
    tables = flatten_records(spark.createDataFrame(rows, "id bigint, r string"), "id", "r")
    assert set(tables) == {"", "items", "items.sub"}
    assert {(r["id"], r["v_a"], r["v_o.x"]) for r in tables[""].collect()} == {(1, 1, "u"), (2, None, None), (3, None, None), (4, None, None)}
    items = {r["key"]: (r["parent_key"], r["pos"], r["v_n"]) for r in tables["items"].collect()}
    assert items == {"1/items[0]": ("1", 1, 1), "1/items[1]": ("1", 2, 2)}
    assert {(r["parent_key"], r["pos"], r["v_k"]) for r in tables["items.sub"].collect()} == {("1/items[0]", 1, "a"), ("1/items[0]", 2, "b")}


def test_sections_at_any_depth(spark):
    """A chain of 1,500 sections, a paragraph in each; records grow with the file, and no depth is refused."""
    n = 1500
    deep = "<a>" + "".join(f"<sec><p>t{i}</p>" for i in range(1, n + 1)) + "</sec>" * n + "</a>"
    records, error = xml_record(deep)
    assert error is None and sum(len(r) for _, r in records) < 100 * n
    found, rejects = elements(spark, [(1, deep, None, None), (2, GOOD, None, None), (3, "<a>", None, None)])
    assert list(rejects) == [3]
    got = {(r["kind"], r["node_no"], r["parent_sec_no"], r["pos"], r["text"]) for r in found if r["id"] == 1}
    assert got == {("sec", i, i - 1, 1, None) for i in range(1, n + 1)} | {("p", i, i, 1, f"t{i}") for i in range(1, n + 1)}
    assert len(found) == 2 * n + len(expected(GOOD))
