import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from dossierlake.llm.pieces import RangeMax, boundaries, cut, cut_texts, sides


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 4), min_size=1, max_size=60), st.data())
def test_range_max(values, data):
    lo = data.draw(st.integers(0, len(values) - 1))
    hi = data.draw(st.integers(lo + 1, len(values)))
    want = max(range(lo, hi), key=lambda i: (values[i], i))
    assert RangeMax(np.array(values)).query(lo, hi) == want


def check(text, limit, overlap):
    spans = cut(text, limit, overlap)
    assert all(0 < b - a <= limit for a, b in spans)
    if len(text) > limit:
        assert all(y[0] == x[1] - overlap for x, y in zip(spans, spans[1:])) and spans[0][0] == 0 and spans[-1][1] == len(text)
        assert text == text[: spans[0][1]] + "".join(text[x[1] : y[1]] for x, y in zip(spans, spans[1:]))
    return spans


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab .\ńé📈", max_size=400), st.integers(20, 60), st.integers(0, 9))
def test_nothing_is_lost(text, limit, overlap):
    check(text, limit, overlap)


def strongest(text, begin, limit, overlap):
    """By looking at every boundary of the window."""
    at, s = boundaries(text)
    window = [(s[i], at[i]) for i in range(len(at)) if begin + max(overlap + 1, limit // 2) <= at[i] <= begin + limit]
    return max(window)[1] if window else None


def test_cuts_are_the_strongest_and_rightmost():
    text = ("One sentence here. Another one there; with a clause, and words. " * 9 + "\n\n") * 12
    for a, b in check(text, 400, 30)[:-1]:
        assert b == strongest(text, a, 400, 30)


def test_paragraph_before_sentence():
    text = "a" * 60 + ".\n\n" + "B b. " * 10 + "x" * 100
    assert cut(text, 100, 10)[0] == (0, 63)


def test_no_boundary_and_marks():
    assert [b - a for a, b in check("x" * 1000, 100, 10)[:-1]] == [100] * 10
    text = "é" * 300
    assert all(text[b] != "́" for _, b in check(text, 101, 10)[:-1])


def test_table(spark):
    rows = [(1, "w " * 3000, None, 7), (1, "w " * 3000, None, 7), (2, "", "x" * 4000, 7), (3, None, "y" * 4001, 7)]
    df = sides(spark.createDataFrame(rows, "row_id bigint, staff string, buff string, piece int"), "row_id", ["staff", "buff"])
    got = cut_texts(df, ["row_id", "side"], "text").collect()
    assert sorted({(r["row_id"], r["side"]) for r in got}) == [(1, "staff"), (3, "buff")]
    assert all(r["n_chars"] <= 4000 and len(r["piece"]) == r["n_chars"] for r in got)
    assert cut_texts(df.limit(0), ["row_id", "side"], "text").collect() == []
    assert {r["side"] for r in cut_texts(df, ["row_id", "side"], "text", oversized_only=False).collect() if r["row_id"] == 2} == {"buff"}
    with pytest.raises(ValueError):
        cut_texts(df, ["row_id"], "text", limit=100, overlap=60)
