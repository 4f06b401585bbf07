import pytest
from pyspark.sql import functions as F

from dossierlake.functions import lists, stance, text


def one(spark, expr, *values, schema=None):
    names = [f"c{i}" for i in range(len(values))]
    kinds = schema or ", ".join(f"{n} string" for n in names)
    return spark.createDataFrame([values], kinds).select(expr(*(F.col(n) for n in names)).alias("v")).first()["v"]


@pytest.mark.parametrize("value, want", [("978.0", None), ("9790000000766.0", "9790000000766"), ("ISBN: 979-0000000063", "9790000000063"), ("  979 0 0000 0017 9\t", "9790000000179"), ("nan", None), ("n/a", None), ("", None), (None, None)])
def test_isbn(spark, value, want):
    assert one(spark, text.isbn_digits, value) == want


@pytest.mark.parametrize("value, want", [("2019", 2019), ("2019.0", 2019), ("FY2019", 2019), ("2019 AIV", 2019), (" 2019 ", 2019), ("n/a", None), ("", None), (None, None), ("20190", None)])
def test_year(spark, value, want):
    assert one(spark, text.read_year, value) == want


@pytest.mark.parametrize("value, want", [("Chad: 2017 Article IV", 2017), ("No year", None), ("x1999", None), (None, None)])
def test_year_in_text(spark, value, want):
    assert one(spark, text.year_in_text, value) == want


@pytest.mark.parametrize("value, want", [("2012-06-20", "2012-06-20"), ("2018-08", "2018-08"), ("2018", "2018"), ("24/01/2013", "2013-01-24"), ("5 March 2019", "2019-03-05"), ("March 5, 2019", "2019-03-05"), ("March 2019", "2019-03"), ("soon", None), (None, None)])
def test_partial_dates(spark, value, want):
    assert one(spark, text.partial_date, value) == want


def test_titles_lists_and_fences(spark):
    assert tuple(one(spark, text.split_title, "A: b: c")) == ("A", "b: c")
    assert one(spark, text.name_aliases, "Bahamas, The") == ["bahamas, the", "the bahamas", "the bahamas, the", "bahamas"]
    assert one(spark, text.strip_fences, '```json\n{"a":1}\n```') == '{"a":1}'
    assert one(spark, text.numbered_items, "1) a\n2) b c") == ["a", "b c"]
    assert one(spark, text.pairs_to_map, "a: 1 || b : x: y||  || a: 2") == {"a": "2", "b": "x: y"}
    assert one(spark, text.first_of_list, "x | y") == "x" and one(spark, text.first_of_list, None) == ""
    assert one(spark, lambda c: text.fill_placeholders("{A}-{B}", {"A": c, "B": F.lit(None)}), "v") == "v-"
    assert one(spark, text.drop_upper_words, "The NATO Board G20 said") == "The Board said"
    assert one(spark, lambda c: text.keep_tagged(F.split(c, ";"), ["<p>"], True), "<p>a;b;<p> c") == ["a", "c"]


@pytest.mark.parametrize("value, want", [("['a', \"b's\"]", ["a", "b's"]), ("plain", ["plain"]), ("", []), (None, []), ("[]", [])])
def test_parse_list(spark, value, want):
    assert one(spark, lists.parse_list, value) == want


@pytest.mark.parametrize("value, want", [('{"fiscal": 80}', {"fiscal": 80.0}), ('["fiscal"]', {"fiscal": 100.0}), ('[{"topic": "fiscal", "confidence": 30}]', {"fiscal": 30.0}), ("fiscal", {"fiscal": 100.0}), ("", {}), (None, {}), ("{oops", {})])
def test_topic_shapes(spark, value, want):
    assert one(spark, lists.topic_map, value) == want


def test_jaccard_of_empty_lists(spark):
    split = lambda c: F.filter(F.split(c, ";"), lambda x: x != "")
    assert one(spark, lambda a, b: lists.jaccard(split(a), split(b)), "", "") == 1.0
    assert one(spark, lambda a, b: lists.jaccard(split(a), split(b)), "x;y", "y;z") == pytest.approx(1 / 3)


def test_replies(spark):
    chat = '{"custom_id":"1","response":{"body":{"choices":[{"message":{"content":"hi"}}]}}}'
    other = '{"id":"2","result":{"output":[{"type":"message","content":[{"type":"output_text","text":"yo"}]}]}}'
    assert [one(spark, lists.reply_text, x) for x in (chat, other, "oops", None)] == ["hi", "yo", None, None]
    assert [one(spark, lists.reply_error, x) for x in (chat, "oops", '{"id":"3","error":{"message":"bad"}}', '{"id":"4"}')] == [None, "not JSON", "bad", "no reply"]


@pytest.mark.parametrize("value, want", [("disagreement exists", 0), ("irrelevant", 1), (None, 1)])
def test_no_disagreement(spark, value, want):
    assert one(spark, stance.no_disagreement, value) == want


@pytest.mark.parametrize("diff, bucket, size", [(4.0, "significantly tighter", "major difference"), (2.0, "tighter", "some difference"), (1.0, "moderately tighter", "minor difference"), (0.0, "same", "no difference"), (-1.0, "moderately looser", "minor difference"), (-3.0, "looser", "major difference"), (None, "looser", "irrelevant")])
def test_differences(spark, diff, bucket, size):
    assert one(spark, stance.bucket, diff, schema="c0 double") == bucket and one(spark, stance.size_of_difference, diff, schema="c0 double") == size


@pytest.mark.parametrize("parts, want", [
    ((None, None, None, None, None), "mostly agree"), (("irrelevant", "irrelevant", None, None, None), "irrelevant"), (("mostly agree", "mostly agree", "disagreement exists", "Future Policy Direction", 1.0), "mostly agree"),
    (("mostly agree", "mostly agree", "disagreement exists", "other", 1.0), "disagreement exists"), (("disagreement exists", "disagreement exists", None, None, None), "disagreement exists"),
])
def test_general_agreement(spark, parts, want):
    assert one(spark, stance.general_agreement, *parts, schema="c0 string, c1 string, c2 string, c3 string, c4 double") == want


@pytest.mark.parametrize("m, f, want", [("tightening bias", "no change", "MtFn"), ("irrelevant", "loosening", None), (None, "loosening", None)])
def test_policy_mix(spark, m, f, want):
    assert one(spark, stance.policy_mix, m, f) == want


@pytest.mark.parametrize("a, b, want", [(1.0, 1.0, True), (1.0, None, True), (None, None, False), (1.0, 0.0, False)])
def test_overall(spark, a, b, want):
    assert one(spark, stance.overall, a, b, schema="c0 double, c1 double") == want


@pytest.mark.parametrize("c, want", [(30, 0), (31, 1), (None, 0)])
def test_dummy(spark, c, want):
    assert one(spark, stance.dummy, c, schema="c0 int") == want
