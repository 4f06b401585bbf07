import random

import pytest
from pyspark.sql import functions as F

from dossierlake.llm import splits

def keys():
    return {"a": F.col("a"), "b": F.col("b")}


def brute(rows):
    """Least id of each row's group."""
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a, b in rows:
        for k in (("a", a), ("b", b)):
            if k[1] is not None:
                x, y = root(("id", i)), root(k)
                parent[x] = y
    least = {}
    for i, _, _ in rows:
        r = root(("id", i))
        least[r] = min(least.get(r, i), i)
    return {i: least[root(("id", i))] for i, _, _ in rows}


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "row_id bigint, a string, b string, component string, id int")


@pytest.mark.parametrize("seed", [1, 2])
def test_components_match_brute_force(spark, seed):
    rng = random.Random(seed)
    rows = [(i, rng.choice([None, f"a{rng.randrange(25)}"]), rng.choice([None, f"b{rng.randrange(20)}"])) for i in range(80)]
    _, got, _ = splits.update_components(frame(spark, rows), "row_id", keys())
    assert {r["id"]: r["component"] for r in got.collect()} == brute(rows)


def test_chain_and_nulls(spark):
    rows = [(i, f"a{i // 2}", f"b{(i + 1) // 2}") for i in range(40)] + [(100, None, None), (101, None, None)]
    _, got, _ = splits.update_components(frame(spark, rows), "row_id", keys())
    found = {r["id"]: r["component"] for r in got.collect()}
    assert {found[i] for i in range(40)} == {0} and found[100] == 100 and found[101] == 101


def test_empty(spark):
    components, got, merges = splits.update_components(frame(spark, []), "row_id", keys())
    assert not components.collect() and not got.collect() and not merges.collect()
    assert splits.assign_splits(got).collect() == []


def test_deliveries_keep_splits_and_quarantine_conflicts(spark):
    first = [(i, f"a{i}", f"b{i}") for i in range(300)]
    components, rows, _ = splits.update_components(frame(spark, first), "row_id", keys())
    before = splits.assign_splits(rows)
    held = {r["component"]: r["split"] for r in before.collect()}
    assert set(held.values()) == {"train", "validation", "test"}
    x = next(c for c, s in held.items() if s == "train")
    y = next(c for c, s in held.items() if s == "test")
    z = [c for c, s in held.items() if s == "train" and c != x][:2]
    second = [(1000, f"a{x}", f"b{y}"), (1001, f"a{z[0]}", f"b{z[1]}"), (1002, f"a{z[0]}", None), (1003, "new", None)]
    components2, rows2, merges = splits.update_components(frame(spark, second), "row_id", keys(), components)
    assert {r["id"]: r["component"] for r in rows2.collect()} == {1000: min(x, y), 1001: min(z), 1002: min(z), 1003: 1003}
    after = {r["component"]: (r["split"], r["n_rows"]) for r in splits.assign_splits(rows2, known=before, merges=merges).collect()}
    assert after[min(x, y)] == ("quarantine", 3) and after[min(z)] == ("train", 4) and max(x, y) not in after
    assert all(after[c][0] == s for c, s in held.items() if c not in (x, y, *z))
    all_rows = {r["id"]: r["component"] for r in splits.update_components(frame(spark, first + second), "row_id", keys())[1].collect()}
    assert all_rows == brute(first + second)
    assert {(r["kind"], r["key"]) for r in components2.collect()} >= {("a", "new"), ("b", "b1")}


def test_shares(spark):
    rows = spark.createDataFrame([(i, i // 3) for i in range(30_000)], "id bigint, component bigint")
    report = {r["split"]: r["share"] for r in splits.split_report(splits.assign_splits(rows)).collect()}
    assert report == pytest.approx({"train": 0.8, "validation": 0.1, "test": 0.1}, abs=0.002)


def test_a_third_in_one_component(spark):
    rows = spark.createDataFrame([(i, 0 if i < 3000 else i) for i in range(9000)], "id bigint, component bigint")
    report = {r["split"]: r["share"] for r in splits.split_report(splits.assign_splits(rows)).collect()}
    assert report == pytest.approx({"train": 0.8, "validation": 0.1, "test": 0.1}, abs=0.01)


def test_known_tables_in_a_later_session(spark, tmp_path):
    """A delivery in another session that has only the stored tables gives what one with the frames at hand gives."""
    path = str(tmp_path / "first")
    one = [(1, "x", None), (2, "x", "p"), (3, "y", None), (4, None, "q")]
    two = [(5, "x", None), (6, "y", "q"), (7, "z", None)]
    schema = "id bigint, a string, b string"
    components, rows, _ = splits.update_components(spark.createDataFrame(one, schema), "id", keys())
    assigned = splits.assign_splits(rows)
    splits.store(components, assigned, path)
    known, before = splits.load(spark.newSession(), path)
    assert sorted(map(tuple, known.collect())) == sorted(map(tuple, components.collect())) and sorted(map(tuple, before.collect())) == sorted(map(tuple, assigned.collect()))

    def deliver(known, before):
        _, rows, merges = splits.update_components(known.sparkSession.createDataFrame(two, schema), "id", keys(), known)
        return sorted(map(tuple, rows.collect())), sorted(map(tuple, splits.assign_splits(rows, known=before, merges=merges).collect()))

    assert deliver(known, before) == deliver(components, assigned)
    with pytest.raises(Exception, match="(?i)already exists"):
        splits.store(components, assigned, path)
