import math
import random

import pytest

from dossierlake.llm.mixing import mix


def frame(spark, rows):
    return spark.createDataFrame(rows, "id bigint, source string, n bigint")


def targets(spark, rows):
    return spark.createDataFrame(rows, "source string, target_share double, max_repeats int")


def tokens(seed=1, counts={"big": 800, "mid": 300, "small": 60, "tiny": 5}):  # noqa: B006
    rng, rows = random.Random(seed), []
    for s, c in counts.items():
        rows += [(len(rows) + i, s, max(1, int(rng.lognormvariate(4, 0.6)))) for i in range(c)]
    return rows


GOALS = [("big", 0.4, 1), ("mid", 0.3, 2), ("small", 0.2, 8), ("tiny", 0.05, 3), ("none", 0.05, 2)]


def test_targets_caps_and_report(spark):
    rows = tokens() + [(90_001, "other", 50), (90_002, None, 50), (90_003, "big", 0), (90_004, "big", None)]
    copies, report = mix(frame(spark, rows), targets(spark, GOALS))
    got, said = copies.collect(), {r["source"]: r for r in report.collect()}
    caps, longest = {s: m for s, _, m in GOALS}, max(n or 0 for *_, n in rows)
    assert {r["id"] for r in got} == {i for i, s, n in rows if s in caps and n}
    assert all(0 <= r["copies"] <= caps[r["source"]] for r in got)
    for s, r in said.items():
        assert r["tokens_reached"] == sum(x["n"] * x["copies"] for x in got if x["source"] == s)
        if not r["short"]:
            assert abs(r["tokens_reached"] - r["tokens_wanted"]) <= longest
    assert said["none"]["short"] and said["none"]["tokens_reached"] == 0 and said["tiny"]["short"]
    assert all(x["copies"] == 3 for x in got if x["source"] == "tiny")
    assert sum(r["share_reached"] for r in said.values()) == pytest.approx(1)


def test_rates_solve_the_dual(spark):
    """Rates of the form min(cap, exp(lambda n)): found by bisection, they give about the copies of each length."""
    rows = tokens(3, {"a": 2000})
    copies, _ = mix(frame(spark, rows), targets(spark, [("a", 1.0, 3)]), total=int(1.5 * sum(n for *_, n in rows)))
    lo, hi, goal = 0.0, 1.0, 1.5 * sum(n for *_, n in rows)
    for _ in range(100):
        x = (lo + hi) / 2
        lo, hi = (x, hi) if sum(n * min(3, math.exp(x * n)) for *_, n in rows) < goal else (lo, x)
    short = [r for r in copies.collect() if r["n"] < 40]
    assert sum(r["copies"] for r in short) == pytest.approx(sum(min(3, math.exp(lo * r["n"])) for r in short), rel=0.05)


def test_empty_and_wrong_targets(spark):
    copies, report = mix(frame(spark, []), targets(spark, GOALS))
    assert copies.collect() == [] and {r["tokens_reached"] for r in report.collect()} == {0}
    with pytest.raises(ValueError):
        mix(frame(spark, []), targets(spark, [("a", 0.5, 1), ("a", 0.5, 1)]))
    with pytest.raises(ValueError):
        mix(frame(spark, []), targets(spark, [("a", 0.5, 0)]))


def test_same_in_every_run(spark):
    run = lambda: sorted(map(tuple, mix(frame(spark, tokens()), targets(spark, GOALS))[0].collect()))
    assert run() == run()


def test_shares_are_kept_in_a_smaller_mix(spark):
    rows = tokens(5, {"a": 900, "b": 300, "c": 20})
    goals = [("a", 0.5, 1), ("b", 0.3, 2), ("c", 0.15, 3), ("none", 0.05, 2)]
    full = {r["source"]: r for r in mix(frame(spark, rows), targets(spark, goals))[1].collect()}
    kept = {r["source"]: r for r in mix(frame(spark, rows), targets(spark, goals), keep_shares=True)[1].collect()}
    longest = max(n for *_, n in rows)
    assert full["c"]["short"] and full["a"]["share_reached"] > 0.55  # the others take what c lacks
    assert kept["none"]["short"] and not any(kept[s]["short"] for s in "abc")
    for s, share, _ in goals[:3]:
        assert kept[s]["tokens_reached"] == pytest.approx(kept[s]["tokens_in_shares"], abs=longest) and full[s]["tokens_in_shares"] == kept[s]["tokens_in_shares"]
        assert kept[s]["share_reached"] == pytest.approx(share / 0.95, abs=0.03)
