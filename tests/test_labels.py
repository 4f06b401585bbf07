"""Rules on labels: the golden rows of FIXTURES.md, and cases the tables do not hold."""

import json

import pytest
from pyspark.sql import functions as F

from dossierlake.functions import stance
from dossierlake.operators import assembly, evaluation as ev, stages

c = F.col


def value(spark, expr):
    return spark.range(1).select(expr.alias("v")).first()["v"]


def lit(*xs):
    return [F.lit(x).cast("double" if isinstance(x, (int, float)) else "string") for x in xs]


@pytest.mark.parametrize("current, future, said, areas, diff, want", [
    (None, None, None, None, None, "mostly agree"), ("irrelevant", "irrelevant", None, None, None, "irrelevant"), ("irrelevant", "irrelevant", "irrelevant", None, None, "irrelevant"),
    ("mostly agree", "mostly agree", "disagreement exists", "Future Policy Direction", 1, "mostly agree"), ("mostly agree", "mostly agree", "disagreement exists", "future policy direction", 1, "disagreement exists"),
    ("mostly agree", "mostly agree", "disagreement exists", None, 0, "disagreement exists"), ("disagreement exists", "mostly agree", "mostly agree", None, 0, "disagreement exists"),
    ("mostly agree", "disagreement exists", "mostly agree", "Future Policy Direction", -2, "disagreement exists"), ("irrelevant", "mostly agree", None, None, 0, "mostly agree"),
])
def test_monetary_verdict(spark, current, future, said, areas, diff, want):
    assert value(spark, stance.general_agreement(*lit(current, future, said, areas), F.lit(diff).cast("double"))) == want


@pytest.mark.parametrize("near, said, areas, diff, want", [
    (None, None, None, None, "mostly agree"), ("irrelevant", None, None, None, "irrelevant"), ("mostly agree", "disagreement exists", "['near-term policy direction']", 1, "mostly agree"),
    ("mostly agree", "disagreement exists", "near-term policy direction", 1, "disagreement exists"), ("disagreement exists", "mostly agree", None, 2, "disagreement exists"), ("irrelevant", "mostly agree", None, None, "mostly agree"),
])
def test_fiscal_verdict(spark, near, said, areas, diff, want):
    assert value(spark, stance.fiscal_agreement(*lit(near, said, areas), F.lit(diff).cast("double"))) == want


def test_sizes_directions_and_buckets(spark):
    rows = spark.createDataFrame([(x,) for x in (4.0, 3.0, 2.0, 1.0, 0.0, -1.0, -2.0, -3.0, -4.0, None)], "d double")
    got = {r["d"]: tuple(r)[1:] for r in rows.select("d", stance.size_of_difference(c("d")), stance.direction_of_difference(c("d")), stance.bucket(c("d"))).collect()}
    assert got[-3.0][0] == "major difference" and got[2.0][0] == "some difference" and got[1.0][0] == "minor difference" and got[0.0][0] == "no difference" and got[None][:2] == ("irrelevant", "irrelevant")
    assert [got[x][1] for x in (4.0, 2.0, 1.0, 0.0, -1.0, -2.0, -4.0)] == ["significantly tighter", "tighter", "moderately tighter", "same", "moderately looser", "looser", "significantly looser"]
    assert [got[x][2] for x in (4.0, 2.0, 1.0, 0.0, -1.0, -2.0, -4.0)] == ["significantly tighter", "tighter", "moderately tighter", "same", "moderately looser", "looser", "looser"]


@pytest.mark.parametrize("a, b, scale, want", [("x", "x", None, "mostly agree"), ("odd", "no change", stance.FUTURE, "irrelevant"), ("n", "no change", None, "irrelevant"), (None, "no change", None, "irrelevant"), ("tightening", "tightening bias", stance.FUTURE, "mostly agree"), ("tightening", "no change", stance.FUTURE, "disagreement exists")])
def test_agreement_of_labels(spark, a, b, scale, want):
    assert value(spark, stance.agree(*lit(a, b), scale, 1)) == want


def test_reconciliation(spark):
    pairs = [("unclear", "irrelevant", "current", "unclear"), ("neutral", "irrelevant", "current", "irrelevant"), ("neutral", "irrelevant", "future", "neutral"), ("unclear", "neutral", "future", "neutral"), ("unclear", "neutral", "current", "unclear"),
             ("tightening tendency", "tightening", "future", "tightening tendency"), ("tightening", "loosening", "future", None), ("a", "a", "current", "a"), (None, None, "current", None), ("unrelated", "mostly agree", "agreement", "mostly agree"), (None, "unclear", "current", None)]
    for a, b, field, want in pairs:
        assert value(spark, stance.reconcile(*lit(a, b), field)) == want


def test_repair(spark):
    for current, future, want in [("neutral", "unclear", ("neutral", "no change")), ("irrelevant", "tightening tendency", ("unclear", "tightening bias")), ("irrelevant", "irrelevant", ("irrelevant", "irrelevant")), (None, "unclear", (None, "unclear")), ("irrelevant", None, ("irrelevant", None)), ("unclear", "neutral", ("unclear", "no change"))]:
        assert tuple(value(spark, x) for x in stance.repair(*lit(current, future))) == want


def test_best_topics(spark):
    flags = stance.topic_dummies({"a": F.lit(70), "b": F.lit(70), "c": F.lit(None).cast("int")})
    assert {n: value(spark, x) for n, x in flags.items()} == {"a": True, "b": True, "c": False}
    assert not any(value(spark, x) for x in stance.topic_dummies({"a": F.lit(69), "b": F.lit(3)}).values())


def test_final_dataset_without_matches(spark):
    base = spark.createDataFrame([("1", 2019, "x"), ("2", 2020, "y"), (None, 2021, "z")], "print_isbn string, year int, extra string")
    said = spark.createDataFrame([("1", "disagreement exists", "Future Policy Direction"), ("1", "mostly agree", None)], "print_isbn string, agreement string, disagreement_areas string")
    wide = spark.createDataFrame([("1", "restrictive", "moderately tight", "tightening", "tightening bias")], "print_isbn string, staff_current string, buff_current string, staff_future string, buff_future string")
    near = spark.createDataFrame([("1", "loosening", "appropriately agree")], "print_isbn string, staff_near_term string, buff_near_term string")
    rows = stages.final_dataset(base, said, said.limit(0), wide, near).collect()
    assert len(rows) == 4  # a repeated key multiplies its report
    one = [r for r in rows if r["print_isbn"] == "1"]
    assert {r["mon_agreement_general"] for r in one} == {"mostly agree"} and {r["mon_agreement_current"] for r in one} == {"mostly agree"} and {r["fis_agreement_near_term"] for r in one} == {"irrelevant"}
    other = next(r for r in rows if r["print_isbn"] == "2")
    assert other["mon_agreement_general"] == other["fis_agreement_general"] == "mostly agree" and other["policy_mix_staff"] is None and other["agreement_overall"] and other["extra"] == "y"


def test_sector_texts_fall_back(spark):
    rows = [("r", "staff", "a monetary text", 1, 80, 0), ("r", "staff_a", "appraisal", 2, 60, 0), ("r", "buff", "weak", 3, 10, 0), ("r", "buff", "of monetary kind", 4, 0, 0), ("r", None, "no kind", 5, 90, 90), (None, "staff", "no key", 6, 90, 90), ("s", "buff", "Monetary only", 7, 0, 0), ("s", "staff", " ", 8, 90, 0)]
    df = spark.createDataFrame(rows, "k string, kind string, t string, o int, m int, f int")
    got = {(r["k"], r["sector"]): (r["staff"], r["buff"]) for r in assembly.sector_texts(df, "k", "kind", "t", "o", {"Monetary": c("m"), "Fiscal": c("f")}).collect()}
    assert got == {("r", "Monetary"): ("appraisal\na monetary text", "\nweak"), ("r", "Fiscal"): ("\n", "\n"), ("s", "Monetary"): ("\n", "\nMonetary only"), ("s", "Fiscal"): ("\n", "\n")}
    assert assembly.sector_texts(df.limit(0), "k", "kind", "t", "o", {"Monetary": c("m")}).collect() == []


def test_sector_scores(spark):
    good = json.dumps({"Agreement_General": 3, "Agreement_Monetary": 99, "Agreement_Fiscal": -2, "Fiscal Sector": {"debt": -3}, "other_areas": {"climate": -1}})
    df = spark.createDataFrame([(f"```json\n{good}\n```",), ("no JSON",), (None,), ("[1]",)], "r string")
    rows = df.select(*(x.alias(n) for n, x in assembly.sector_scores(c("r")).items())).collect()
    assert rows[0]["general"] == 3 and rows[0]["Monetary"] is None and rows[0]["Fiscal"] == -2 and rows[0]["Fiscal_areas"] == {"debt": -3} and rows[0]["other_areas"] == {"climate": -1} and rows[0]["error"] is None
    assert [r["error"] for r in rows[1:]] == ["no JSON", "no reply", "[1]"] and rows[1]["Monetary_areas"] == {}


def test_seasons_and_years(spark):
    df = spark.createDataFrame([("2019-07-01", 2019), ("2019-07-02", 2019), (None, 2020), ("2019-01-01", None)], "d string, y int")
    assert [r[0] for r in df.select(assembly.season_name(F.to_date("d"), c("y"))).collect()] == ["Spring 2019", "Fall 2019", "Spring 2020", None]
    wide = spark.createDataFrame([("a", 2.0, 3.0), ("b", 0.0, 1.0)], "k string, y2019 double, y2020 double")
    rows = spark.createDataFrame([("a", 2020), ("a", 2019), ("b", 2020), ("c", 2020), (None, 2020)], "k string, y int")
    got = {(r["k"], r["y"]): (r["n"], r["d_n"]) for r in assembly.lookup_year(rows, wide, "k", "y", {"y2019": 2019, "y2020": 2020}, "n").collect()}
    assert got == {("a", 2020): (3.0, 0.5), ("a", 2019): (2.0, None), ("b", 2020): (1.0, None), ("c", 2020): (None, None), (None, 2020): (None, None)}


def test_accuracies_average_the_folded_ones_too(spark):
    df = spark.createDataFrame([("tightening", "tightening bias"), ("unclear", "irrelevant"), ("no change", "no change"), ("x", None)], "g string, p string")
    m = ev.field_accuracies(df, {"f": ("g", "p")})
    assert {r["metric"]: r["value"] for r in m.collect()} == {"f_accuracy": pytest.approx(1 / 3, abs=1e-6), "f_accuracy_merge_unclear": 1.0}
    assert ev.average_metric(m).first()[0] == pytest.approx(2 / 3, abs=1e-5)


def test_unresolved(spark):
    a, b = (spark.createDataFrame([(x,) for x in xs], "k string") for xs in (("1", "2", "2", None), ("2", "3", None)))
    assert {tuple(r) for r in stages.unresolved(a, b, "k").collect()} == {("1", "missing"), ("3", "unmatched")}
