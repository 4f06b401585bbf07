import pytest

from dossierlake.operators.packed import split_packed


@pytest.mark.parametrize("cell, areas", [
    (None, []), ("", []), ("   ", []), ("[]", []), ("[ ]", []), ("nan", []), ("None", []), ("N/A", []),
    ("wage bill", ["wage bill"]), ("a; b ;; c;", ["a", "b", "c"]), ("a, b\nc | d", ["a", "b", "c", "d"]), ("a / b/c / d", ["a", "b/c", "d"]), ("a\tb", ["a", "b"]), ("a、b，c；d", ["a", "b", "c", "d"]), ("a || b", ["a", "b"]), ("a\r\nb", ["a", "b"]),
    ('"x, y", z', ["x, y", "z"]), ('"so-called ""neutral"" rate"; b', ['so-called "neutral" rate', "b"]), ("“x; y”、z", ["x; y", "z"]), ('"a | b",c', ["a | b", "c"]),
    ("['a b', \"authorities' capacity\", 'c, d']", ["a b", "authorities' capacity", "c, d"]), ('["pol\\u00edtica", "so \\"n\\" r", ""]', ["política", 'so "n" r']), ("['x']", ["x"]),
    ("(1) a (2) b", ["a", "b"]), ("1. a 2. b", ["a", "b"]), ("1) a\n2) b", ["a", "b"]), ("(i) a; (ii) b; (iii) c", ["a", "b", "c"]), ("• a • b", ["a", "b"]), ("- state-owned x\n- b", ["state-owned x", "b"]), ("* a", ["a"]),
    ("authorities' capacity; b", ["authorities' capacity", "b"]), ("a; a", ["a", "a"]), ("R&D tax credit", ["R&D tax credit"]), ('"2025 budget, second reading"', ["2025 budget, second reading"]), ("near-term x, debt/financing mix", ["near-term x", "debt/financing mix"]),
])
def test_cells(cell, areas):
    import dossierlake.operators.packed as packed

    assert cells_of(packed, [cell])[0] == areas


_cache = {}


def cells_of(packed, cells):
    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession()
    df = spark.createDataFrame(list(enumerate(cells)), "row_id bigint, cell string")
    out = {i: [] for i in range(len(cells))}
    for r in sorted(split_packed(df, "row_id", "cell").collect(), key=lambda r: (r["id"], r["pos"])):
        assert r["pos"] == len(out[r["id"]]) + 1
        out[r["id"]].append(r["value"])
    return out


@pytest.fixture(autouse=True)
def _session(spark):
    return spark


def test_repeats_clashing_columns_and_empty(spark):
    df = spark.createDataFrame([(1, "a;b", "p", 5), (1, "a;b", "q", 6)], "row_id bigint, cell string, value string, pos int")
    assert sorted((r["id"], r["pos"], r["value"]) for r in split_packed(df, "row_id", "cell").collect()) == [(1, 1, "a"), (1, 1, "a"), (1, 2, "b"), (1, 2, "b")]
    assert split_packed(df.limit(0), "row_id", "cell").collect() == []


def test_shuffled_rules_give_the_same(spark):
    df = spark.createDataFrame([(i, "; ".join(["x y"] * (i % 7 + 1))) for i in range(50)], "row_id bigint, cell string")
    rows = lambda **k: sorted(map(tuple, split_packed(df, "row_id", "cell", **k).collect()))
    assert rows() == rows(broadcast_bytes=0) and len(rows()) == sum(i % 7 + 1 for i in range(50))


def test_long_cell(spark):
    df = spark.createDataFrame([(1, ", ".join(f"area {i}" for i in range(5000)))], "row_id bigint, cell string")
    assert split_packed(df, "row_id", "cell").count() == 5000


def test_round_trip_of_random_notations(spark):
    """Random areas written in every notation come back as they were."""
    import json
    import random

    import dossierlake.operators.packed as packed

    rng = random.Random(11)
    plain = ["wage bill", "R&D tax credit", "debt/financing mix", "near-term policy", "authorities' capacity", "VAT threshold", "política cambiaria", "size of the output gap", "G20 rules"]
    special = ["a, b and c", "rates | corridor width", "energy; costs", 'so-called "neutral" rate', "tax policy (VAT, excises)", "x / y", "2025 budget, second reading"]
    roman = ["i", "ii", "iii", "iv", "v", "vi"]

    def csv(x):
        return '"' + x.replace('"', '""') + '"' if x in special or rng.random() < 0.2 else x

    cells, want = [], []
    for _ in range(400):
        areas = [rng.choice(plain + special) for _ in range(rng.randrange(1, 7))]
        how = rng.randrange(9)
        if how == 0:
            cells.append(json.dumps(areas, ensure_ascii=rng.random() < 0.5))
        elif how == 1:
            cells.append(repr(areas))
        elif how < 5:
            seps = [rng.choice([", ", ",", "; ", " ; ", " | ", "|", "\n", "\t", " / ", " || ", "、", "；", ";; "]) for _ in areas]
            cells.append("".join(csv(a) + s for a, s in zip(areas, seps[:-1] + [rng.choice(["", ";", " "])])))
        else:
            areas = [rng.choice(plain) for _ in areas]
            mark = [lambda i: f"({i + 1}) ", lambda i: f"{i + 1}. ", lambda i: f"({roman[i]}) ", lambda i: "• "][how - 5]
            sep = rng.choice([" ", "\n"] + (["; "] if how == 7 else []))
            cells.append(sep.join(mark(i) + a for i, a in enumerate(areas)))
        want.append(areas)
    got = cells_of(packed, cells)
    wrong = [(cells[i], got[i], want[i]) for i in range(len(cells)) if got[i] != want[i]]
    assert not wrong, wrong[:5]
