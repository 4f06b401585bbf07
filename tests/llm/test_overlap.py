import random

from pyspark.sql import functions as F

from dossierlake.llm import overlap

WORDS = [f"w{i}" for i in range(40)]
BOILERPLATE = "this statement reflects the position of the authorities at the time of issue and has not been altered since"


def plain(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(row[j - 1] if x == y else 1 + min(row[j - 1], row[j], new[-1]))
        row = new
    return row[-1]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, k, 0) for i, t, k in rows], "row_id bigint, staff string, isbn string, cls int")


def pairs(spark, train, test, **kw):
    found = overlap.cross_split_pairs(frame(spark, train), frame(spark, test), "row_id", "staff", F.col("isbn"), **kw).collect()
    assert len(found) == len(set(found))
    return {(r["train_id"], r["test_id"]) for r in found}


def edited(rng, words, n):
    out = list(words)
    for _ in range(n):
        i, how = rng.randrange(len(out)), rng.randrange(3)
        if how == 0:
            out[i] = rng.choice(WORDS)
        elif how == 1:
            out.insert(i, rng.choice(WORDS))
        elif len(out) > 12:
            del out[i]
    return out


def test_brute_force(spark):
    """Texts of few words, so that many share seeds by chance, with edits spread from none to over the limit."""
    rng = random.Random(3)
    train, test = [], []
    for i in range(60):
        base = ([*BOILERPLATE.split()] if i % 3 == 0 else []) + [rng.choice(WORDS) for _ in range(rng.randrange(12, 90))]
        train.append((i, " ".join(base), None))
        test.append((1000 + i, " ".join(edited(rng, base, rng.randrange(0, len(base) // 6 + 1))), None))
    want = {(a, b) for a, x, _ in train for b, y, _ in test if len(y.split()) >= 12 and plain(x.split(), y.split()) < max(len(x.split()), len(y.split())) / 8}
    assert 20 < len(want) < 60 and pairs(spark, train, test) == want


def test_evenly_spread_edits(spark):
    """The hardest case: no more unchanged words between edits than there must be."""
    rng = random.Random(5)
    base = [f"u{i}" for i in range(120)]
    changed = [f"c{i}" if i % 9 == 4 else w for i, w in enumerate(base)]
    noise = [(10 + i, " ".join(rng.choice(WORDS) for _ in range(60)), None) for i in range(20)]
    assert pairs(spark, [(1, " ".join(base), None), *noise], [(100, " ".join(changed), None)]) == {(1, 100)}


def test_form_does_not_matter(spark):
    t = "The authorities broadly agreed that inflation, at 5 percent, had peaked; risks remain tilted to the downside overall."
    assert pairs(spark, [(1, t, None)], [(2, "12.  THE AUTHORITIES broadly agreed that\ninflation at 5 percent had peaked - risks remain tilted to the downside overall", None)]) == {(1, 2)}


def test_keys_short_null_copies_and_empty(spark):
    t = " ".join(WORDS[:20])
    train = [(1, "too short", "k"), (2, None, None), (3, t, None), (4, t, "k")]
    test = [(11, "too short", "k"), (12, None, None), (13, t, "k"), (14, "", None)]
    assert pairs(spark, train, test) == {(1, 11), (4, 11), (1, 13), (4, 13), (3, 13)}
    assert pairs(spark, train, []) == set() and pairs(spark, [], test) == set()


def test_shuffled_index_gives_the_same(spark):
    rng = random.Random(8)
    base = [[rng.choice(WORDS) for _ in range(40)] for _ in range(20)]
    train, test = ([(i + k, " ".join(edited(rng, b, k and 2)), None) for i, b in enumerate(base)] for k in (0, 100))
    _, left = overlap.classes(frame(spark, test), "row_id", "staff")
    _, right = overlap.classes(frame(spark, train), "row_id", "staff")
    rows = lambda n: {(r["l"], r["r"], r["edits"]) for r in overlap.near_classes(left, right, n).collect()}
    assert rows(0) == rows(1 << 30) and len(rows(0)) >= 20


def test_very_long_text(spark):
    rng = random.Random(9)
    base = [rng.choice(WORDS) + str(rng.randrange(500)) for _ in range(5000)]
    assert pairs(spark, [(1, " ".join(base), None)], [(2, " ".join(edited(rng, base, 40)), None)]) == {(1, 2)}


def test_same_number_in_both_sets(spark):
    """A training row and a testing row that carry the same number are still a pair."""
    t = " ".join(WORDS[:29])
    assert pairs(spark, [(5, t, None)], [(5, t.replace("w7 ", "x "), None)]) == {(5, 5)}


def test_edit_distance_and_alignment():
    rng = random.Random(2)
    for _ in range(300):
        a = [rng.randrange(6) for _ in range(rng.randrange(0, 25))]
        b = edited(rng, a, rng.randrange(0, 6)) if a else []
        b = [x if isinstance(x, int) else 9 for x in b]
        most, want = rng.randrange(0, 7), plain(a, b)
        assert overlap.edit_distance(a, b, most) == min(want, most + 1)
        anchors = overlap.chain([(rng.randrange(1, len(a) + 1), rng.randrange(1, len(b) + 1)) for _ in range(5)]) if a and b else []
        got = overlap.align(a, b, anchors, most)
        assert (got <= most) == (want <= most) and got >= min(want, most + 1)


def test_chains_rise_in_both():
    assert overlap.chain([(1, 9), (2, 1), (3, 2), (3, 3), (4, 3), (5, 1)]) == [(2, 1), (3, 2), (4, 3)]
    assert overlap.chain([(3, 1), (2, 2), (1, 3)]) in ([(1, 3)], [(2, 2)], [(3, 1)]) and overlap.chain([]) == []
    rng = random.Random(4)
    for _ in range(50):
        seeds = [(rng.randrange(8), rng.randrange(8)) for _ in range(8)]
        best = 0
        for mask in range(256):
            s = sorted({seeds[i] for i in range(8) if mask >> i & 1})
            if all(p[0] < q[0] and p[1] < q[1] for p, q in zip(s, s[1:])):
                best = max(best, len(s))
        assert len(overlap.chain(seeds)) == best


def test_seeds_in_the_wrong_order_are_no_match(spark):
    """The same passages in another order share seeds, but no chain and no alignment."""
    a, b = [f"a{i}" for i in range(30)], [f"b{i}" for i in range(30)]
    assert pairs(spark, [(1, " ".join(a + b), None)], [(2, " ".join(b + a), None)]) == set()


def test_coverage(spark):
    rng = random.Random(6)
    passage = [f"p{i}" for i in range(40)]
    own = lambda k, n: [f"{k}x{i}" for i in range(n)]
    near = own("n", 50)
    train = [(1, " ".join(own("t", 100) + passage + own("u", 60)), "k1"), (2, " ".join(near), None), (3, " ".join(near), "k2"), (4, "short", "k2"), (6, None, None)]
    test = [(11, " ".join(own("v", 20) + passage + own("w", 20)), None), (12, " ".join(edited(rng, near, 2)), "k2"), (13, " ".join(own("z", 30)), "k1"), (14, None, "k2"), (15, " ".join(own("y", 30)), None)]
    got = {r["test_id"]: r for r in overlap.cross_split_coverage(frame(spark, train), frame(spark, test), "row_id", "staff", F.col("isbn")).collect()}
    assert set(got) == {11, 12, 13, 14, 15}
    assert {i: r["n_pairs"] for i, r in got.items()} == {11: 0, 12: 3, 13: 1, 14: 2, 15: 0}  # 12: two copies by text, one of them also by key, and the short one by key
    assert 0.35 <= got[11]["passage_share"] <= 0.5 and got[11]["aligned_share"] == 0  # 40 of 80 words, less what the passage's ends select elsewhere
    assert got[12]["aligned_share"] >= 0.95 and got[13]["passage_share"] == got[15]["passage_share"] == 0.0 and got[14]["n_words"] is None
    assert overlap.cross_split_coverage(frame(spark, train), frame(spark, []), "row_id", "staff", F.col("isbn")).collect() == []
    counted = pairs(spark, train, test)
    assert {i: r["n_pairs"] for i, r in got.items() if r["n_pairs"]} == {i: sum(b == i for _, b in counted) for i in (12, 13, 14)}
