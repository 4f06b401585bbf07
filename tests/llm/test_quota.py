import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from dossierlake.llm.quota import draw, plan, random_counts, swap_repair


@pytest.mark.parametrize("seed", range(12))
def test_swaps_reach_the_least_deviation(seed):
    rng = random.Random(seed)
    have = {(k,): rng.randrange(0, 6) for k in "abcd"}
    floor = {k: rng.randrange(0, 3) for k in have}
    size = rng.randrange(0, sum(have.values()) + 1)
    wanted = {k: rng.random() * 5 for k in have}
    low = {k: min(have[k], floor[k]) for k in have}
    take = swap_repair(have, floor, size, wanted)
    total = max(size, sum(low.values()))
    assert sum(take.values()) == total and all(low[k] <= take[k] <= have[k] for k in have)
    cost = lambda t: sum((t[k] - wanted[k]) ** 2 for k in have)
    best = min(cost(dict(zip(have, c))) for c in itertools.product(*(range(low[k], have[k] + 1) for k in have)) if sum(c) == total)
    assert cost(take) == pytest.approx(best)


def test_plan_and_draw(spark):
    rows = [(i, "A", 2020) for i in range(3000)] + [(5000 + i, "B", 2020) for i in range(40)] + [(9000 + i, "C", 2020) for i in range(2)] + [(9100 + i, "D", 2020) for i in range(500)]
    df = spark.createDataFrame(rows, "row_id bigint, grp string, yr int").withColumns({"take": F.lit("x"), "have": F.lit(1)})
    targets = spark.createDataFrame([("A", 2020, 500, 5), ("B", 2020, 400, 5), ("C", 2020, 100, 5), ("E", 2020, 0, 1)], "grp string, yr int, target_permille int, min_rows int")
    planned = plan(df, ["grp", "yr"], targets, "target_permille", "min_rows")
    got = {r["grp"]: (r["have"], r["needed"], r["take"], r["met"]) for r in planned.collect()}
    size = 3542 // 5
    assert got["A"][1:2] == (-(-size * 500 // 1000),) and got["B"][2] == 40 and not got["B"][3] and got["C"] == (2, 71, 2, False) and got["E"] == (0, 1, 0, False)
    assert sum(x[2] for x in got.values()) == size and got["A"][3]
    drawn = draw(df, ["grp", "yr"], planned, "row_id")
    assert {r["grp"]: r["n"] for r in drawn.groupBy("grp").agg(F.count("*").alias("n")).collect()} == {g: x[2] for g, x in got.items() if x[2]}
    assert drawn.select("row_id").distinct().count() == size and set(drawn.columns) == set(df.columns)
    assert {r["row_id"] for r in drawn.collect()} == {r["row_id"] for r in draw(df, ["grp", "yr"], planned, "row_id").collect()}


def test_empty_and_repeated_ids(spark):
    df = spark.createDataFrame([(1, "A")] * 50, "row_id bigint, grp string")
    targets = spark.createDataFrame([("A", 1000, 1)], "grp string, target_permille int, min_rows int")
    assert draw(df, ["grp"], plan(df, ["grp"], targets, "target_permille", "min_rows"), "row_id").count() == 10
    empty = plan(df.limit(0), ["grp"], targets, "target_permille", "min_rows")
    assert [(r["have"], r["needed"], r["met"]) for r in empty.collect()] == [(0, 1, False)] and draw(df.limit(0), ["grp"], empty, "row_id").count() == 0


def test_every_need_as_a_floor(spark):
    """A target with just enough rows is reached, one with a row less is not, whatever the rounding of the others adds up to."""
    df = spark.createDataFrame([(i, "A") for i in range(700)] + [(i, "B") for i in range(1000, 1067)] + [(i, "C") for i in range(2000, 2066)] + [(i, "D") for i in range(3000, 3167)], "row_id bigint, grp string")
    targets = spark.createDataFrame([("A", 333, 1), ("B", 333, 1), ("C", 334, 1)], "grp string, target_permille int, min_rows int")
    got = {r["grp"]: r for r in plan(df, ["grp"], targets, "target_permille", "min_rows", whole=True).collect()}
    assert [got[g]["needed"] for g in "ABC"] == [67, 67, 67] and [got[g]["reached"] for g in "ABC"] == [got[g]["met"] for g in "ABC"] == [True, True, False] and got["D"]["reached"] is None


def test_the_start_is_a_random_sample():
    free = {("a",): 600, ("b",): 300, ("c",): 100}
    drawn = [random_counts(free, 100, np.random.default_rng(s)) for s in range(300)]
    assert all(sum(x.values()) == 100 and all(0 <= x[k] <= free[k] for k in free) for x in drawn) and len({tuple(x.values()) for x in drawn}) > 50
    assert abs(sum(x[("a",)] for x in drawn) / 300 - 60) < 1.5
    big = random_counts({("a",): 10**12, ("b",): 10**12}, 10**9, np.random.default_rng(1))
    assert sum(big.values()) == 10**9 and abs(big[("a",)] - 5 * 10**8) < 10**6
    assert random_counts({}, 5, np.random.default_rng(1)) == {} and random_counts({("a",): 3}, 9, np.random.default_rng(1)) == {("a",): 3}
