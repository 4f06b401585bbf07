import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from dossierlake.operators import aggregate as agg, chat, evaluation as ev, lines, models, relational as rel, reports, tables
from dossierlake.plans import reference
from dossierlake.sources import files, office
from dossierlake.streaming.merge import merge_stream, windowed_counts


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_keep_first_and_numbers(spark):
    df = spark.createDataFrame([("a", 3, "x"), ("a", 1, "y"), (None, 2, "z"), (None, 5, "w")], "k string, o int, v string")
    assert {(r["k"], r["v"]) for r in rel.keep_first(df, ["k"], [F.col("o")]).collect()} == {("a", "y"), (None, "z")}
    many = spark.createDataFrame([(i * 8 % 1001,) for i in range(1001)], "x int")
    assert {(r["x"], r["id"]) for r in rel.number_rows(many, [F.col("x")]).collect()} == {(i, i) for i in range(1001)}


def test_merge_is_idempotent(spark):
    main = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    more = spark.createDataFrame([(2, 9), (3, 8), (3, 7)], "k int, w int")
    once = rel.merge_incremental(main, more, ["k"])
    assert sorted(r["k"] for r in once.collect()) == [1, 2, 3, 3] == sorted(r["k"] for r in rel.merge_incremental(once, more, ["k"]).collect())


def test_required_columns(spark):
    with pytest.raises(ValueError, match="x: missing columns b"):
        rel.require_columns(spark.createDataFrame([(1,)], "a int"), ["a", "b"], "x")


def test_names_first_entry_wins(spark):
    ref = spark.createDataFrame([(2, "Chad", "Republic of Chad", "B"), (1, "The Chad", "Chad Republic", "A")], "ref_id int, country string, long string, code string")
    df = spark.createDataFrame([("chad",), ("Republic of  Chad",), ("Bahamas, The",), (None,)], "n string")
    assert {r["n"]: r["code"] for r in rel.resolve_names(df, "n", ref, ["country", "long"], "ref_id", ["code"]).collect()} == {"chad": "A", "Republic of  Chad": "B", "Bahamas, The": None, None: None}


def test_lag_needs_the_year_before(spark):
    df = spark.createDataFrame([("a", 2010, 2.0), ("a", 2011, 3.0), ("a", 2013, 4.0)], "c string, y int, v double")
    assert {r["y"]: (r["lagged"], r["growth"]) for r in rel.lag_by_year(df, "c", "y", "v").collect()} == {2010: (None, None), 2011: (2.0, 0.5), 2013: (None, None)}


def test_next_event(spark):
    df = spark.createDataFrame([("a", 2010), ("a", 2014), ("b", 2010)], "c string, y int")
    events = spark.createDataFrame([("a", 2012), ("a", 2013)], "c string, e int")
    assert {(r["c"], r["y"]): r["until"] for r in rel.next_event(df, events, "c", "y", "e", 4).collect()} == {("a", 2010): 2, ("a", 2014): None, ("b", 2010): None}


def test_shares_and_counts(spark):
    df = spark.createDataFrame([(2010, "a"), (2010, "a"), (2010, "b"), (2010, "other"), (None, "a"), (2011, "b")], "y int, c string")
    assert rows(agg.share_by(df, "y", "c", ["a", "b"])) == [(2010, "a", 2, 0.666667), (2010, "b", 1, 0.333333), (2011, "b", 1, 1.0)]
    assert rows(agg.year_group_counts(df, "y", "c", ["a", "b"])) == [(2010, 2, 1), (2011, 0, 1)]


def test_texts_in_order(spark):
    df = spark.createDataFrame([("k", "x", 2, "two"), ("k", "x", 1, "one"), ("k", "y", 3, " "), ("k", "y", 4, None), (None, "x", 1, "n")], "k string, t string, o int, b string")
    assert [tuple(r) for r in agg.pivot_text(df, ["k"], "t", ["x", "y"], "b", "o").collect()] == [("k", "one two", None)]
    assert rows(agg.text_by_topic(df.where("k is not null"), ["k"], {"all": F.lit(True), "null": F.lit(None).cast("boolean")}, "b", "o")) == [("k", "all", "one\n\ntwo")]


def test_metrics_match_brute_force(spark):
    rng = random.Random(1)
    pairs = [(rng.choice("abc"), rng.choice("abd")) for _ in range(200)]
    table = ev.confusion(spark.createDataFrame(pairs, "g string, p string"), "g", "p")
    got = {r["label"]: r for r in ev.label_metrics(table).collect()}
    for x in "abcd":
        hit, said, gold = sum(g == p == x for g, p in pairs), sum(p == x for _, p in pairs), sum(g == x for g, _ in pairs)
        p, r = hit / said if said else 0, hit / gold if gold else 0
        assert got[x]["precision"] == pytest.approx(p, abs=1e-6) and got[x]["recall"] == pytest.approx(r, abs=1e-6) and got[x]["support"] == gold
        assert got[x]["f1"] == pytest.approx(2 * p * r / (p + r) if p + r else 0, abs=1e-6)
    assert ev.overall_metrics(table).first()["accuracy"] == pytest.approx(sum(g == p for g, p in pairs) / 200)


def test_report_parts(spark):
    xml = """<article><front><article-title>X</article-title></front><body><sec><title>Contents</title><p>c</p></sec>
    <sec><title>Outlook</title><p>s1</p><p><bold>Authorities' views</bold></p><p>v1</p><fig><p>f</p></fig><p>s2</p></sec><sec><title>The Authorities</title><p>v2</p></sec>
    <sec><title>Staff Apraisal</title><p>1. one</p><p>two</p><p>3. three</p><p>note</p></sec></body></article>"""
    statement = "<article><article-title>Statement by Mr. X</article-title><body><p>a</p><p>b</p></body></article>"
    found = {r["id"]: r for r in reports.report_parts(spark.createDataFrame([(1, xml), (2, statement), (3, "<a>"), (4, None)], "id bigint, content string"), "id", "content").collect()}
    assert found[1]["appraisal"] == ["1. one", "two", "3. three"] and found[1]["views"] == ["v1", "v2"] and found[1]["staff"] == ["s1", "s2"] and not found[1]["uncertain"]
    assert found[2]["statement"] == ["a", "b"] and found[3]["error"] and found[4]["error"] and found[3]["uncertain"]


def test_lines(spark):
    text = "Date: 1 May 2019\n\nThe first paragraph goes on\nover two lines of text.\n12 34 56\nTable 1. Numbers\n1/ See the annex for\nmore about it.\nSource: staff"
    df = spark.createDataFrame([(1, text), (2, ""), (3, None), (4, "1\n2")], "id bigint, t string")
    got = {r["id"]: r for r in lines.process_documents(df, "id", "t").collect()}
    assert got[1]["text"] == "<para> The first paragraph goes on over two lines of text.\n<footnote> 1/ See the annex for more about it." and got[1]["status"] == "success"
    assert got[2]["status"] == got[3]["status"] == "empty" and got[4]["status"] == "problem"


def test_tables(spark):
    html = "<table><tr><th>Risk</th><th>Likelihood</th></tr><tr><td>War</td><td>High</td></tr></table><table><tr><td>x</td></tr></table>"
    cells = tables.table_cells(spark.createDataFrame([(1, html), (2, None)], "id bigint, h string"), "id", "h")
    assert (1, 1, 2, 2, "High") in rows(cells) and cells.count() == 5
    assert {r["table_no"]: r["standard"] for r in tables.standard_tables(cells).collect()} == {1: True, 2: False}
    text = spark.createDataFrame([(1, "Risk: War || Impact: High\nRisk: 12 || Impact: x\nnothing")], "id bigint, t string")
    assert rows(tables.rows_from_text(text, "id", "t", ["Risk", "Impact"], "Risk")) == [(1, 0, "War", "High")]


def test_failing_rows_have_errors(spark):
    def classify(texts):
        if "bad" in texts:
            raise RuntimeError("no")
        return [t.upper() for t in texts]

    got = {r["t"]: (r["reply"], r["error"]) for r in chat.call(spark.createDataFrame([("a",), ("bad",), ("b",)], "t string").coalesce(1), "t", classify, tries=2, wait=0.0).collect()}
    assert got == {"a": ("A", None), "b": ("B", None), "bad": (None, "RuntimeError: no")}
    first = spark.createDataFrame([(1, "x", None), (2, None, "e")], "id int, reply string, error string")
    again = spark.createDataFrame([(1, "z", None), (2, "y", None)], "id int, reply string, error string")
    assert rows(chat.patch_errors(first, again, "id").select("id", "reply")) == [(1, "x"), (2, "y")]


def test_models(spark):
    rng = np.random.default_rng(2)
    x, u = rng.normal(size=2000), rng.integers(0, 20, 2000)
    y = 1.5 + 2 * x + u * 0.3
    df = spark.createDataFrame([(float(a), float(b), int(c), float(d > 0)) for a, b, c, d in zip(y, x, u, 0.5 + x + rng.normal(size=2000))], "y double, x double, u int, z double")
    assert models.fixed_effects(df, "y", ["x"], "u")["x"] == pytest.approx(2) and models.least_squares(df, "y", ["x"], "u")["const"] == pytest.approx(1.5)
    fit = models.probit(df, "z", ["x"])
    assert fit["x"] == pytest.approx(1, abs=0.12) and fit["const"] == pytest.approx(0.5, abs=0.1)


def test_files(spark, tmp_path):
    df = spark.createDataFrame([("a\nb", ["x"], {"k": 1})], "t string, l array<string>, m map<string,int>")
    files.write_csv(df, str(tmp_path / "c"))
    assert [tuple(r) for r in files.read_csv(spark, str(tmp_path / "c")).collect()] == [("a\\nb", '["x"]', '{"k":1}')]
    (tmp_path / "j.jsonl").write_text('{"a": 1}\nbroken\n\n')
    assert sorted((r["a"], r["broken"]) for r in files.read_jsonl(spark, str(tmp_path / "j.jsonl"), "a int").collect() if r["a"]) == [(1, None)]
    assert {r["broken"] for r in files.read_jsonl(spark, str(tmp_path / "j.jsonl"), "a int").collect()} == {None, "broken"}
    (tmp_path / "r" / "p1").mkdir(parents=True)
    (tmp_path / "r" / "p1" / "a.xml").write_text("<a>\n</a>")
    assert [(r["package_id"], r["file"], r["content"]) for r in files.read_packages(spark, str(tmp_path / "r")).collect()] == [("p1", "a.xml", "<a>\n</a>")]
    (tmp_path / "p.md").write_text("---\nx: 1\n---\n## system\nHi {A}\n\n## user\nYo\n")
    assert files.load_prompt(str(tmp_path / "p.md")) == {"system": "Hi {A}", "user": "Yo"}
    assert files.sheet_name("a/b" * 20, {("a_b" * 20)[:31]}) == ("a_b" * 20)[:29] + "_2"
    assert "| a |" in files.markdown_report(spark.createDataFrame([(1.5,)], "a double"), "T")


@pytest.mark.parametrize("scheme", ["", "file://"])
def test_stream_merges_each_key_once(spark, tmp_path, scheme):
    source, target, state = (scheme + str(tmp_path / x) for x in ("in", "out", "state"))
    one = spark.createDataFrame([(1, "a"), (2, "b"), (2, "bb"), (None, "n"), (None, "n")], "k int, v string")
    one.coalesce(1).write.mode("append").parquet(source)
    run = lambda: merge_stream(spark, source, one.schema, target, state, ["k"])
    run()
    spark.createDataFrame([(2, "z"), (3, "c")], "k int, v string").coalesce(1).write.mode("append").parquet(source)
    run()
    run()
    assert sorted((r["k"] or 0, r["v"]) for r in spark.read.parquet(target).collect()) == [(0, "n"), (0, "n"), (1, "a"), (2, "b"), (3, "c")]


def test_windows_of_a_stream(spark, tmp_path):
    import datetime as dt

    rows = [(dt.datetime(2020, 1, 1, h), "a") for h in (1, 2)] + [(dt.datetime(2020, 1, 2, 1), "a"), (dt.datetime(2020, 1, 9), "b")]
    spark.createDataFrame(rows, "ts timestamp, k string").coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("ts timestamp, k string").parquet(str(tmp_path / "in"))
    query = windowed_counts(stream, "ts", "k").writeStream.outputMode("append").format("memory").queryName("windows").option("checkpointLocation", str(tmp_path / "s")).trigger(availableNow=True).start()
    query.awaitTermination()
    got = {(r["window_start"].day, r["k"], r["n"]) for r in spark.table("windows").collect()}
    assert got == {(1, "a", 2), (2, "a", 1)}  # the last day stays open until the watermark has passed it


def test_shared_tables_are_dropped(spark):
    from dossierlake.session import drop_shared, subfolders, write_shared, _tables

    write_shared(spark.range(3))
    assert subfolders(spark, _tables(spark))
    drop_shared(spark)
    assert not subfolders(spark, _tables(spark))


def test_carry_forward_fills_gaps_only(spark):
    rows = [("a", 2020, 1), ("a", 2021, 2), ("a", 2023, 3), ("b", 2021, 4), ("c", 2022, 5), ("d", 2020, 6), ("b", 2026, 7)]
    got = rel.carry_forward(spark.createDataFrame(rows, "country string, year int, n bigint"), "country", "year", 2021, 2024)
    assert sorted(map(tuple, got.collect())) == sorted([*rows, ("a", 2022, 2), ("a", 2024, 2), ("b", 2022, 4), ("b", 2023, 4), ("b", 2024, 4)])
    assert dict(got.dtypes)["year"] == "int"


def test_carried_forward_keeps_later_years(spark, small):
    """As the reference does it: copies are appended to the whole panel, and of each year and country the first row stays."""
    panel = {(r["country"], r["year"]): r["n"] for r in reference.panel(spark, small, "df", "mon_agreement", "n").collect()}
    want = dict(panel)
    for (country, year), n in panel.items():
        for later in (2022, 2023, 2024) if year == 2021 else ():
            want.setdefault((country, later), n)
    assert any(year > 2021 for _, year in panel)
    got = [tuple(r) for r in reference.carried_forward(spark, small).select("country", "year", "n").collect()]
    assert sorted(got) == sorted((*k, n) for k, n in want.items())


def test_workbooks_there_and_back(spark, tmp_path):
    one = spark.createDataFrame([(1, "a & <b>", 1.5), (2, None, None), (3, " two\nlines ", -2.0)], "n int, t string, x double")
    names = office.write_workbook_file({"A/B": one, "A?B": one.limit(0), "Other": one.select("t")}, str(tmp_path / "w.xlsx"))
    assert names == ["A_B", "A_B_2", "Other"]
    (tmp_path / "bad.xlsx").write_bytes(b"no zip")
    rows = office.read_workbooks(spark, "file://" + str(tmp_path))
    assert [r["path"].endswith("bad.xlsx") for r in rows.where("error is not null").collect()] == [True]
    got = {(r["sheet"], r["row_no"]): (r["n"], r["t"], r["missing"]) for r in office.sheet_table(rows, ["n", "t", "missing"]).collect()}
    assert got == {("A_B", 2): ("1", "a & <b>", None), ("A_B", 3): ("2", None, None), ("A_B", 4): ("3", " two\nlines ", None), ("Other", 2): (None, "a & <b>", None), ("Other", 4): (None, " two\nlines ", None)}


def test_workbook_with_shared_strings():
    import io
    import zipfile

    buffer, main = io.BytesIO(), 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    with zipfile.ZipFile(buffer, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {main} xmlns:r="u"><sheets><sheet name="S" sheetId="1" r:id="x"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships><Relationship Id="x" Target="/xl/worksheets/s.xml"/></Relationships>')
        z.writestr("xl/sharedStrings.xml", f"<sst {main}><si><t>one</t></si><si><r><t>t</t></r><r><t>wo</t></r></si></sst>")
        z.writestr("xl/worksheets/s.xml", f'<worksheet {main}><sheetData><row r="1"><c r="A1" t="s"><v>0</v></c><c r="C1" t="s"><v>1</v></c></row><row r="2"/><row r="3"><c r="B3" t="b"><v>1</v></c><c r="AA3"><v>2.5</v></c></row></sheetData></worksheet>')
    assert list(office.sheet_rows(buffer.getvalue())) == [("S", 1, ["one", None, "two"]), ("S", 3, [None, "TRUE", *[None] * 24, "2.5"])]


def test_word_processor_files(spark, tmp_path):
    import zipfile

    w = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
    body = "<w:p><w:r><w:t>Hello </w:t></w:r><w:r><w:t>there</w:t></w:r></w:p><w:tbl><w:tr><w:tc><w:p><w:r><w:t>Risk</w:t></w:r></w:p></w:tc><w:tc><w:p/></w:tc></w:tr></w:tbl><w:p/>"
    with zipfile.ZipFile(tmp_path / "d.docx", "w") as z:
        z.writestr("word/document.xml", f"<w:document {w}><w:body>{body}</w:body></w:document>")
    with zipfile.ZipFile(tmp_path / "e.docx", "w") as z:
        z.writestr("x", "")
    got = sorted(((r["block_no"] or 0, r["kind"], r["text"], r["cells"], r["error"] is None) for r in office.read_documents(spark, str(tmp_path)).collect()))
    assert got == [(0, None, None, None, False), (1, "p", "Hello there", None, True), (2, "table", None, [["Risk", ""]], True), (3, "p", "", None, True)]


def test_results_of_many_files(spark, tmp_path):
    for n, rows in (("a", 'x,disagreement_areas\n1,[]\n2,"[\'t\']"\n'), ("b", "x,disagreement_areas\n3,\n")):
        (tmp_path / n).mkdir()
        (tmp_path / n / f"{n}.csv").write_text(rows)
    assert sorted((r["x"], r["source_file"]) for r in files.read_results(spark, str(tmp_path)).collect()) == [("2", "a.csv"), ("3", "b.csv")]


def test_lag_of_change(spark):
    df = spark.createDataFrame([("a", 2010, 1), ("a", 2011, 3), ("a", 2012, 4), ("a", 2014, 9)], "c string, y int, v int")
    assert {r["y"]: (r["change"], r["change_lagged"]) for r in rel.lag_of_change(df, "c", "y", "v").collect()} == {2010: (None, None), 2011: (2, None), 2012: (1, 2), 2014: (None, None)}


def test_long_documents_and_contents(spark):
    text = "Table of Contents\nIntroduction ....... 1\nOutlook 2\n" + "A paragraph that runs on and on without an end here\n" * 400 + "CONTENTS\nLast part of it 9\nThe end of the text is here at last."
    got = lines.process_documents(spark.createDataFrame([(1, text), (1, text)], "id bigint, t string"), "id", "t").collect()
    assert len(got) == 2 and got[0]["n_lines"] == 406 and "Introduction" not in got[0]["text"] and "Last part" not in got[0]["text"]
    assert got[0]["n_kept"] == 14 and got[0]["text"].endswith("The end of the text is here at last.")  # thirty lines a paragraph


def test_ever_and_after(spark):
    df = spark.createDataFrame([("a", 1, 0), ("a", 2, 1), ("a", 3, 0), ("b", 1, 0), (None, 1, 1), ("c", None, 1)], "k string, y int, f int")
    got = {(r["k"], r["y"]): (r["f_ever"], r["f_after"]) for r in rel.ever_and_after(df, "k", "y", "f").collect()}
    assert got == {("a", 1): (1, 0), ("a", 2): (1, 0), ("a", 3): (1, 1), ("b", 1): (0, 0), (None, 1): (0, 0), ("c", None): (0, 0)}


def test_stances_wide_and_own_buckets(spark):
    df = spark.createDataFrame([(1, "k", "STAFF!", None), (2, "k", "staff", "x"), (3, "k", "staff", "y"), (4, "k", "Gov", "z"), (5, "k", "other", "w"), (6, None, "staff", "v")], "o int, k string, who string, s string")
    got = {r["k"]: (r["staff_s"], r["buff_s"]) for r in agg.pivot_stances(df, ["k"], "who", ["s"], "o", {"Gov": "buff"}).collect()}
    assert got == {"k": ("x", "z"), None: ("v", None)}
    diffs = spark.createDataFrame([(1, 2.0), (1, -1.0), (1, None), (2, 0.0)], "y int, d double")
    shares = agg.compare_shares(diffs, "y", "d", lambda d: F.when(d > 0, "up").otherwise("not up"), ("up", "not up"))
    assert rows(shares) == [(1, "not up", 1, 0.5), (1, "up", 1, 0.5), (2, "not up", 1, 1.0)]


def test_first_rows_are_cut_before_they_meet(spark, small):
    """Each task keeps the first rows of a group before the shuffle, so a hot group sends a few rows from each."""
    plan = reference.latest_per_source(spark, small)._jdf.queryExecution().optimizedPlan().toString()
    assert "WindowGroupLimit" in plan
    assert "WindowGroupLimit" in reference.both_annotated(spark, small)._jdf.queryExecution().optimizedPlan().toString()
