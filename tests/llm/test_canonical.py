import random

import pytest
from pyspark.sql import functions as F

from dossierlake.llm.canonical import Trie, alias_forms, allowed, build_trie, map_names, map_to_reference, normalize, title_subject

ENTRIES = [(1, "Morsavia", "Morsavia Federation", "XMR"), (2, "Morvostan", "Commonwealth of Morvostan", "XMO"), (3, "South Navmark", "Democratic Republic of South Navmark", "XST"), (4, "The Kahamels", "Union of Kahamels", "XTM"), (5, "Ostch and Galmar", "Union of Ostch and Galmar", "XOD"), (6, "Saint Jorkul", "Federal Republic of Saint Jorkul", "XSO"), (7, "Tãtuleth", "Federal Republic of Tãtuleth", "XTT")]


def distance(a, b):
    """Edits with transposed neighbours as one."""
    d = [[max(i, j) if not i or not j else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
    return d[-1][-1]


def test_automaton_finds_all_within_distance():
    rng = random.Random(4)
    words = ["".join(rng.choice("abcd") for _ in range(rng.randrange(1, 10))) for _ in range(120)]
    trie = Trie(list(zip(words, range(len(words)))))
    for _ in range(300):
        q = "".join(rng.choice("abcd") for _ in range(rng.randrange(0, 11)))
        want = {i: d for i, w in enumerate(words) if (d := distance(q, w)) <= allowed(len(w))}
        assert trie.search(q) == want


@pytest.fixture(scope="module")
def trie(spark):
    return build_trie(spark.createDataFrame(ENTRIES, "ref_id bigint, country string, long string, code string"), "ref_id", "country", "long", "code")


@pytest.mark.parametrize("name, ref", [
    ("Morsavia", 1), ("MORASVIA", 1), ("Morsavia*", 1), ("Morsavia 1/", 1), ("morsavia (the)", 1), ("Morsavia (Morsavia Federation)", 1), ("xmr", 1), ("Commonwealth of Morvostan", 2), ("Morvostan, Commonwealth of", 2), ("Morvostan (Commonwealth)", 2), ("The Commonwealth of Morvostan", 2),
    ("S. Navmark", 3), ("South  Nvamark", 3), ("Dem. Republic of South Navmark", 3), ("Te Kahamels", 4), ("Kahamels, The", 4), ("Ostch/Galmar", 5), ("Ostch & Galmar", 5), ("St. Jorkul", 6), ("Tatuleth", 7), ("Tâtueth", 7), ("World", 0), ("n/a", 0), ("xmq", 0), ("Mor", 0),
])
def test_names(spark, trie, name, ref):
    df = spark.createDataFrame([(1, name, 9, "x")], "row_id bigint, name string, ref_id int, candidates string")
    assert [r["ref_id"] for r in map_to_reference(df, "row_id", "name", trie).collect()] == [ref]


def test_blank_null_repeated_long_and_empty(spark, trie):
    df = spark.createDataFrame([(1, None), (2, "  "), (3, "Morsavia"), (3, "Morsavia"), (4, "x" * 20_000)], "row_id bigint, name string")
    assert sorted((r["id"], r["ref_id"]) for r in map_to_reference(df, "row_id", "name", trie).collect()) == [(3, 1), (3, 1), (4, 0)]
    assert map_to_reference(df.limit(0), "row_id", "name", trie).collect() == []


def test_ties_need_a_hint(spark):
    trie = Trie([("abcdefg", 1), ("abcdefh", 2)])
    df = spark.createDataFrame([(1, "abcdefi", None), (2, "abcdefi", 2), (3, "abcdefi", 7)], "row_id bigint, name string, hint bigint")
    assert {r["id"]: r["ref_id"] for r in map_to_reference(df, "row_id", "name", trie, hint="hint").collect()} == {1: 0, 2: 2, 3: 0}


@pytest.mark.parametrize("title, subject", [
    ("Morsavia: Selected Issues", "Morsavia"), ("Morsavia - 2011 Art. IV consultation", "Morsavia"), ("Morsavia—Debt Analysis 2020 (with comparison to Pradesh)", "Morsavia"), ("Morsavia; Request for an Arrangement", "Morsavia"), ("Press Release No. 19/202 on Morsavia", "Morsavia"),
    ("Country Report No. 15/247: Morvostan, Commonwealth of", "Morvostan, Commonwealth of"), ("Staff Report for the 2020 Article IV Consultation with Morsavia", "Morsavia"), ("2012 ARTICLE IV CONSULTATION – Morsavia", "Morsavia"), ("Limgoland-Tãlan: Selected Issues—Trade Links with Taslique", "Limgoland-Tãlan"), ("Harbour Bloc: 2014 Discussion on Common Policies", "Harbour Bloc"),
])
def test_titles(spark, title, subject):
    assert spark.createDataFrame([(title,)], "t string").select(title_subject(F.col("t"))).first()[0] == subject


def test_normalize():
    assert normalize("  The  Ostch & Galmar* ") == "ostch and galmar" and "union of kahamels" in alias_forms("The Kahamels", "Union of Kahamels", "XTM")


def test_all_entries_within_the_distance(spark):
    """An exact hit does not hide the others; the nearest still wins."""
    ref = spark.createDataFrame([(1, "Nigera", None, None), (2, "Nigerai", None, None), (3, "Alg eria", None, None)], "ref_id bigint, country string, long string, code string")
    trie = build_trie(ref, "ref_id", "country", "long", "code")
    got = {r["name"]: [(c["ref_id"], c["distance"]) for c in r["candidates"]] for r in map_names(spark.createDataFrame([("nigera",), ("Nigera ",), ("algeria",), ("al geria",), ("zzz",)], "n string"), "n", trie).collect()}
    assert got == {"nigera": [(1, 0), (2, 1)], "Nigera ": [(1, 0), (2, 1)], "algeria": [(3, 1)], "al geria": [(3, 1)], "zzz": []}
    df = spark.createDataFrame([(1, "nigera")], "row_id bigint, name string")
    assert [r["ref_id"] for r in map_to_reference(df, "row_id", "name", trie).collect()] == [1]


def test_names_are_spread_over_tasks(spark):
    """Few bytes, much work: the look-ups stay in as many tasks as there are slots."""
    trie = Trie([("abc", 1)])
    names = spark.range(300).select(F.concat(F.lit("n"), "id").alias("n"))
    found = map_names(names, "n", trie)
    assert found.select(F.spark_partition_id().alias("p")).distinct().count() >= 4
    assert found._jdf.queryExecution().executedPlan().toString().count("REPARTITION_BY_NUM") == 1
