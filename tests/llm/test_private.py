import random
import re

import pytest

from dossierlake.llm import private, spans

GIVEN = frozenset({"orlio", "jobel", "grant", "will", "mark", "bill"})


def found(text, kind):
    return [text[c.begin : c.end] for c in spans.candidates(text, GIVEN) if c.kind == kind]


@pytest.mark.parametrize("text, kind, want", [
    ("write to mailto:a.b@mof.gov.test; or c_d@x-y.invalid.", "email", ["a.b@mof.gov.test", "c_d@x-y.invalid"]), ("reached a-b [at] mof (dot) test after", "email", ["a-b [at] mof (dot) test"]), ("yield 4.25 @ 90 days", "email", []),
    ("Tel: (784) 555-0145 / 00999 69 92 27 05", "phone", ["784) 555-0145", "00999 69 92 27 05"]), ("Phone +999 (82) 208 503, x3", "phone", ["+999 (82) 208 503"]),
    ("passport no. L7033948, of", "identity", ["L7033948"]), ("national ID 751214-5907;", "identity", ["751214-5907"]), ("social insurance number EN 57 10 67 A, of", "identity", ["EN 57 10 67 A"]), ("carte d’identité n° HT-4332-138, l’agent", "identity", ["HT-4332-138"]),
    ("of No. 361 Bellweather Avenue.", "address", ["No. 361 Bellweather Avenue"]), ("to 217, rue des Moulins, Portmere", "address", ["217, rue des Moulins"]), ("at Calle del Puerto 165.", "address", ["Calle del Puerto 165"]), ("to Old Mill Lane 100\nX", "address", ["Old Mill Lane 100"]), ("404a Saltmarsh Rd, Flat 3", "address", ["404a Saltmarsh Rd"]), ("Some 87 street vendors along the Lantern Road corridor", "address", []),
    ("Prepared by Noneth Varova and T. Quileru (all staff).", "name", ["Noneth Varova", "T. Quileru"]), ("Name: Haskérez, Ellassa; x", "name", ["Haskérez, Ellassa"]), ("and Minister Varova.", "name", ["Varova"]), ("Dr. Van Zoroglu said", "name", ["Van Zoroglu"]), ("STATEMENT BY MR. ÁRWALA ON BEHALF OF", "name", ["ÁRWALA"]), ("Déclaration de M. Árami, administrateur", "name", ["Árami"]), ("Statement by M. Bremami, Executive", "name", ["M. Bremami"]), ("by B. de la Drayvik,", "name", ["B. de la Drayvik"]),
])
def test_candidates(text, kind, want):
    got = found(text, kind)
    for w in want:
        assert any(g.rstrip(".") == w for g in got), got
    if not want:
        assert not got


def corpus(seed=1, n=400):
    """Texts with known mentions among expressions that look like names."""
    rng, rows, truth = random.Random(seed), [], set()
    given, fam = ["Orlio", "Jobel", "Kith", "Quilla", "Nodor", "Saska"], [a + b for a in ("Var", "Osk", "Wex", "Pell", "Tol") for b in ("ova", "ulu", "mere", "hald")]
    for i in range(n):
        text = "Growth was strong. "
        name = f"{rng.choice(given)} {rng.choice(fam)}"
        lead, tail = rng.choice([("Prepared by ", " (all staff). "), ("According to ", ", growth was weak. "), ("Contact: ", ", tel. +999 123 4567. ")])
        truth.add((i, "name", len(text) + len(lead) + 1))
        text += lead + name + tail
        if "tel." in tail:
            truth.add((i, "phone", text.index("+") + 1))
        text += rng.choice(["Grant Element calculations and Bill Auctions resumed. ", "The Central Bank and the Monetary Board met in Osmund Bay. ", "Table 3: 101 555 012 334. "])
        if rng.random() < 0.5:
            truth.add((i, "email", len(text) + 4 + 1))
            text += f"cc: {rng.choice(fam).lower()}@mof.test. "
        rows.append((i, text))
    return rows, truth


def expected(rows):
    """The texts of corpus() with placeholders, made from how they were put together, not from what was found."""
    out = {}
    for i, t in rows:
        t = re.sub(r"(Prepared by|According to|Contact:) [A-Z]\w+ [A-Z]\w+", r"\1 [NAME]", t)
        t = re.sub(r"[a-z]+@mof\.test", "[EMAIL]", t)
        out[i] = t.replace("+999 123 4567", "[PHONE]")
    return out


def test_mentions_and_placeholders(spark):
    rows, truth = corpus()
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id bigint, text string, kind string, begin_at int")
    hits = private.find_private(df, "doc_id", "text", GIVEN)
    got = {(r["id"], r["kind"], r["begin_at"]) for r in hits.collect()}
    assert len(got & truth) >= 0.98 * len(truth) and len(got - truth) <= 0.02 * len(truth)
    texts = dict(rows)
    clean = {r["id"]: r["text"] for r in private.redact(df, "doc_id", "text", hits).collect()}
    wanted = expected(rows)
    assert len(clean) == len(rows) and sum(clean[i] == wanted[i] for i in texts) >= 0.98 * len(rows)


def test_nulls_empty_long_and_repeated(spark):
    long = "Nothing here. " * 5000 + "Prepared by Orlio Varova (all staff)."
    df = spark.createDataFrame([(1, None), (2, ""), (3, long), (4, long), (5, "📈 mail a@b.test")], "doc_id bigint, text string")
    hits = private.find_private(df, "doc_id", "text", GIVEN).collect()
    assert {(r["id"], r["begin_at"]) for r in hits if r["kind"] == "name"} == {(3, len(long) - 24), (4, len(long) - 24)}
    assert [(r["id"], r["begin_at"]) for r in hits if r["kind"] == "email"] == [(5, 8)]
    clean = {r["id"]: r["text"] for r in private.redact(df, "doc_id", "text", private.find_private(df, "doc_id", "text", GIVEN)).collect()}
    assert clean[1] is None and clean[2] == "" and clean[5] == "📈 mail [EMAIL]"


def test_empty_table(spark):
    assert private.find_private(spark.createDataFrame([], "doc_id bigint, text string"), "doc_id", "text", GIVEN).collect() == []


def test_reliabilities():
    """One labeler that is always right, one that guesses: the patterns follow the first."""
    q = private.estimate([("++", 300), ("+-", 250), ("-+", 260), ("--", 310), ("+0", 400), ("-0", 400)])
    assert q["++"] > 0.5 > q["--"] and q["+0"] > q["-0"]
    assert private.estimate([]) == {}


def test_titled_names_behind_many_pairs():
    """A titled name is not taken again as a plain pair, however many spans were accepted before it."""
    pairs = " and ".join(f"{a}{b} {c}" for a in ("Alor", "Belt", "Corv", "Dast", "Elm") for b in ("in", "er", "on", "is", "ut") for c in ("Varova", "Oskula", "Wexma", "Pellha", "Tolba"))
    text = pairs + ". Mr. Adam Smith agreed. President Ana Varova spoke. Secretary Oskulu left, and Orlio Tolba spoke."
    got = {text[c.begin : c.end]: c.votes for c in spans.candidates(text, GIVEN) if c.begin > len(pairs)}
    assert list(got) == ["Adam Smith", "Ana Varova", "Oskulu", "Orlio Tolba"]
    assert all(got[n][1] == "+" for n in ("Adam Smith", "Ana Varova", "Oskulu")) and got["Orlio Tolba"][1] == "0"
    assert len(spans.candidates(text, GIVEN)) == 125 + 4


@pytest.mark.parametrize("lead, strong, weak", [
    ("x (statement by ", "+", "+"), ('x "prepared by ', "+", "+"), ("x (contact: ", "+", "+"), ("x /by ", "0", "+"), ("x contacts : ", "0", "+"), ("prepared by ", "+", "+"),
    ("x standby ", "0", "0"), ("x restatement by ", "0", "+"), ("x prepared-by ", "0", "+"), ("x _by ", "0", "0"), ("x ", "0", "0"),
])
def test_leads_begin_a_word(lead, strong, weak):
    c = next(c for c in spans.candidates(lead + "Noneth Varova", GIVEN) if c.begin == len(lead))
    assert c.votes[2:4] == strong + weak


@pytest.mark.parametrize("text, kind, want", [
    ("Prepared by Orlio Varova Oskulu and Jobel Wexova.", "name", ["Orlio Varova Oskulu", "Jobel Wexova"]), ("According to Jobel Pellmere de la Tolhald, it rose", "name", ["Jobel Pellmere de la Tolhald"]),
    ("Mr. Orlio B. Varova Oskulu noted", "name", ["Orlio B. Varova Oskulu"]), ("STATEMENT BY MR. ORLIO VAROVA OSKULU ON BEHALF OF X", "name", ["ORLIO VAROVA OSKULU"]), ("Prepared by Orlio Varova Executive Director", "name", ["Orlio Varova"]),
    ("Governor Varova March 2019", "name", ["Varova"]), ("met 张伟先生 today", "name", ["张伟"]),
    ("sent to 217, rue des Moulins, Portmere. Then", "address", ["217, rue des Moulins, Portmere"]), ("at 404a Saltmarsh Road, Flat 3, 53138 Lower Tarn.", "address", ["404a Saltmarsh Road, Flat 3, 53138 Lower Tarn"]), ("to Old Mill Road 100, Kell, as agreed", "address", ["Old Mill Road 100, Kell"]),
])
def test_ends_of_mentions(text, kind, want):
    """A mention ends where a reader would end it: with all names, the flat and the town."""
    got = [text[c.begin : c.stop or c.end] for c in spans.candidates(text, GIVEN) if c.kind == kind]
    for w in want:
        assert w in got, got


#: Phrases that no list of the labelers has. The labelers over the corpus were worked out with the first six in sight; the rest came later.
HELD_OUT = ["Questions were put to our colleague {} in spring. ", "Minutes were kept; {} chaired the panel. ", "An earlier note, drafted jointly, thanks {} for comments. ", "It was {} who signed the memorandum. ", "The desk, headed since May by economist {}, revised it. ", "Slides: {}, for the seminar. ", "Thanks are due to {}, who hosted the workshop. ", "{} replied that the numbers were final. ", "Both {} and the desk were absent. ", "Last year {} left the department. ", "Earlier {} had asked for the same table. ", "What {} saw in the ledger was unclear. "]


def test_held_out_phrases(spark):
    """Recall of names in phrases that none of the lists knows, among texts as they are."""
    rows, truth = corpus(seed=4)
    rng, held = random.Random(12), set()
    known = [(m[1], m[2]) for _, t in rows for m in re.finditer(r"(?:Prepared by|According to|Contact:) ([A-Z]\w+) ([A-Z]\w+)", t)]
    for k in range(120):
        given, family = rng.choice(known)[0], rng.choice(known)[1]
        lead, tail = rng.choice(HELD_OUT).split("{}")
        text = "Growth was strong. " + lead + f"{given} {family}" + tail + "The Monetary Board met."
        held.add((10_000 + k, "name", len("Growth was strong. " + lead) + 1))
        rows.append((10_000 + k, text))
    hits = private.find_private(spark.createDataFrame(rows, "doc_id bigint, text string"), "doc_id", "text", GIVEN).collect()
    got = {(r["id"], r["kind"], r["begin_at"]) for r in hits}
    recall, wrong = len(got & held) / len(held), len([g for g in got if g[0] >= 10_000 and g not in held])
    print("recall in held-out phrases", recall, "wrong", wrong)
    assert recall >= 0.9 and wrong <= 0.1 * len(held)


def test_no_part_of_a_mention_stays(spark):
    rows = [(i, f"Growth was strong. Prepared by Orlio Varova Oskulu{i % 7}x and kept. ".replace(f"{i % 7}x", "abcdefg"[i % 7]) + f"Letters may be sent to {i + 100} Saltmarsh Road, Flat {i % 9 + 1}, 53138 Lower Tarn. cc: varova{i}@mof.test") for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    clean = [r["text"] for r in private.redact(df, "doc_id", "text", private.find_private(df, "doc_id", "text", GIVEN)).collect()]
    assert sum(any(w in t for w in ("Orlio", "Varova", "Oskulu", "Saltmarsh", "Tarn", "53138", "Flat", "@")) for t in clean) <= 1
    assert all(t.startswith("Growth was strong. Prepared by [NAME] and kept. Letters may be sent to [ADDRESS]. cc: [EMAIL]") for t in clean[:1])


def test_first_words_of_sentences(spark):
    """'Earlier Jane Doe': both pairs are candidates; a given name known to the gazetteer keeps its three words."""
    at = lambda t: [t[c.begin : c.end] for c in spans.candidates(t, GIVEN) if c.kind == "name"]
    assert at("It rose. Earlier Kith Varova spoke.") == ["Earlier Kith", "Kith Varova"] and at("It rose. Both Kith Varova spoke.") == ["Kith Varova"]
    assert at("It rose. Orlio Kith Varova spoke.") == ["Orlio Kith"] and at("then Earlier Kith Varova spoke.") == ["Earlier Kith"]
    assert "VAN TOLERU" not in at("Approved By\nFITH VAN TOLERU and T. Oskul")
