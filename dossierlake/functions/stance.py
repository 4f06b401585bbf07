"""Ordinal labels of stance and agreement, with explicit nulls: a comparison with a missing value is false, not null."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from dossierlake.functions.text import squash

#: Label scales.
CURRENT = {"restrictive": 1.0, "neutral": 0.0, "accommodative": -1.0}
FUTURE = {"tightening": 2.0, "tightening bias": 1.0, "no change": 0.0, "loosening bias": -1.0, "loosening": -2.0}
UNCLEAR = ("unclear", "irrelevant")


def nn(condition: Column) -> Column:
    """A condition that is false where it is unknown."""
    return F.coalesce(condition, F.lit(False))


def label(value: Column) -> Column:
    """A label without case and stray blanks; missing ones are 'irrelevant'."""
    return F.coalesce(F.regexp_replace(F.lower(squash(value)), "^(?:nan|none|null)?$", "irrelevant"), F.lit("irrelevant"))  # the value is named once: rules are put together of labels


def score(value: Column, scale: dict[str, float]) -> Column:
    return F.try_element_at(F.create_map(*(F.lit(x) for kv in scale.items() for x in kv)), value)


def size_of_difference(diff: Column) -> Column:
    d = F.abs(diff)
    return F.when(nn(d >= 3), "major difference").when(nn(d == 2), "some difference").when(nn(d == 1), "minor difference").when(nn(d == 0), "no difference").otherwise("irrelevant")


def direction_of_difference(diff: Column) -> Column:
    """Seven labels from 'significantly tighter' to 'significantly looser'; null and anything between whole steps is irrelevant."""
    steps = ((2, "tighter"), (1, "moderately tighter"), (0, "same"), (-1, "moderately looser"), (-2, "looser"))
    out = F.when(nn(diff >= 3), "significantly tighter").when(nn(diff <= -3), "significantly looser")
    for step, name in steps:
        out = out.when(nn(diff == step), name)
    return out.otherwise("irrelevant")


def bucket(diff: Column) -> Column:
    """Six buckets; null falls through to the last, so drop nulls before."""
    return F.when(nn(diff >= 3), BUCKETS[0]).when(nn(diff == 2), BUCKETS[1]).when(nn(diff == 1), BUCKETS[2]).when(nn(diff == 0), BUCKETS[3]).when(nn(diff == -1), BUCKETS[4]).otherwise(BUCKETS[5])


#: The buckets in order.
BUCKETS = ("significantly tighter", "tighter", "moderately tighter", "same", "moderately looser", "looser")
#: Labels that are no view.
NO_VIEW = ("", "nan", "n", "unclear", "irrelevant")


def agree(a: Column, b: Column, scale: dict[str, float] | None = None, within: float = 0.0) -> Column:
    """'irrelevant' if either side has no view, else whether they are equal or, on a scale, within a distance; a label off the scale is irrelevant too."""
    none = nn(a.isin(*NO_VIEW)) | nn(b.isin(*NO_VIEW)) | a.isNull() | b.isNull()
    if not scale:
        return F.when(none, "irrelevant").when(a == b, "mostly agree").otherwise("disagreement exists")
    far = F.abs(score(a, scale) - score(b, scale))
    return F.when(none | far.isNull(), "irrelevant").when(far <= within, "mostly agree").otherwise("disagreement exists")


#: The cells of disagreement areas that excuse a disagreement in the text, as they are written.
MONETARY_EXCUSE, FISCAL_EXCUSE = "Future Policy Direction", "['near-term policy direction']"


def verdict(parts: list[Column], clash: Column, text: Column, areas: Column, excuse: str) -> Column:
    """'irrelevant' if all parts and the text are (a missing text is, a missing part is not); else a disagreement if the
    parts clash or the text disagrees about anything but the excused area; else agreement."""
    no_text = text.isNull() | nn(text == "irrelevant")
    nothing = no_text
    for p in parts:
        nothing = nothing & nn(p == "irrelevant")
    in_text = nn(text == "disagreement exists") & ~nn(areas == excuse)
    return F.when(nothing, "irrelevant").when(nn(clash) | in_text, "disagreement exists").otherwise("mostly agree")


def general_agreement(current: Column, future: Column, text: Column, areas: Column, diff: Column) -> Column:
    """The monetary verdict: a disagreement on the current stance, or future stances more than one step apart, or the text decides."""
    return verdict([current, future], nn(current == "disagreement exists") | nn(F.abs(diff) > 1), text, areas, MONETARY_EXCUSE)


def fiscal_agreement(near_term: Column, text: Column, areas: Column, diff: Column) -> Column:
    """The fiscal verdict: near-term stances more than one step apart, or the text decides."""
    return verdict([near_term], nn(F.abs(diff) > 1), text, areas, FISCAL_EXCUSE)


def policy_mix(monetary: Column, fiscal: Column) -> Column:
    """'M' and 'F' with t, l or n each, by substring, tightening first; null if either has no direction."""
    way = lambda c: F.when(nn(F.contains(c, F.lit("tightening"))), "t").when(nn(F.contains(c, F.lit("loosening"))), "l").when(nn(F.contains(c, F.lit("no change"))), "n")
    return F.concat(F.lit("M"), way(monetary), F.lit("F"), way(fiscal))


def binary(agreement: Column) -> Column:
    return F.when(agreement == "mostly agree", 1.0).when(agreement == "disagreement exists", 0.0)


def overall(a: Column, b: Column) -> Column:
    """Whether the parts that are known agree, at least one being known."""
    return nn((a == 1) & (b == 1)) | (a.isNull() & nn(b == 1)) | (b.isNull() & nn(a == 1))


def no_disagreement(agreement: Column) -> Column:
    """1 unless there is a disagreement; missing and irrelevant count as 1."""
    return (~agreement.eqNullSafe(F.lit("disagreement exists"))).cast("int")


def dummy(confidence: Column, above: int = 30) -> Column:
    return nn(confidence > above).cast("int")


def disagree_economic(*areas: Column) -> Column:
    """Whether any of the cells names the economic assessment."""
    out = F.lit(False)
    for c in areas:
        out = out | nn(F.contains(F.lower(c), F.lit("economic assessment")))
    return out


def topic_dummies(scores: dict[str, Column], least: float = 70) -> dict[str, Column]:
    """name -> whether the topic has the greatest score of all and that is at least `least`; ties are all true, a missing score counts 0."""
    known = {n: F.coalesce(c, F.lit(0)) for n, c in scores.items()}
    top = F.greatest(*known.values()) if len(known) > 1 else next(iter(known.values()))
    return {n: (c == top) & (c >= least) for n, c in known.items()}


#: How labels are written another way, by field; topics; words for the two sides.
CURRENT_FIXES = {"moderately tight": "restrictive", "tightening bias": "restrictive", "close to neutral": "neutral"}
FUTURE_UNCLEAR = {"unclear": "no change / unclear", "no change": "no change / unclear", "gradual normalization": "no change / unclear"}
NEAR_TERM_UNCLEAR = {"unclear": "no change / unclear", "no change": "no change / unclear"}
AGREEMENT_FIXES = {"Micah mostly agree": "mostly agree", "appropriately agree": "mostly agree", "валлийский": "mostly agree"}
TOPIC_RENAME = {"Economic Outlook": "Real", "Monetary Policy": "Monetary", "Fiscal Stance": "Fiscal", "Financial Stability": "Financial", "External Stance": "External"}
TYPES = {"staff_a": "staff", "buff_a": "buff"}
VERBS = {"staff": "recommended", "buff": "planned"}
AGREEMENTS = ("irrelevant", "disagreement exists", "mostly agree")
CURRENT_LABELS = ("restrictive", "neutral", "accommodative", "unclear", "irrelevant")
FUTURE_LABELS = ("tightening", "tightening bias", "no change", "loosening bias", "loosening", "unclear", "irrelevant")
#: What two annotators' labels, in order of the alphabet, come to if they differ, by field.
ANY_FIELD = {("irrelevant", "unclear"): "unclear", ("tightening", "tightening tendency"): "tightening tendency", ("loosening", "loosening tendency"): "loosening tendency"}
MERGED = {
    "current": ANY_FIELD | {("neutral", "unclear"): "unclear", ("irrelevant", "neutral"): "irrelevant"},
    "future": ANY_FIELD | {("neutral", "unclear"): "neutral", ("irrelevant", "neutral"): "neutral"},
    "agreement": {("mostly agree", "unrelated"): "mostly agree"},
}


def reconcile(a: Column, b: Column, field: str) -> Column:
    """One label of two annotators': the common one, or what the pair in any order comes to, or null: somebody has to look. A missing label counts as an empty one."""
    x, y = F.coalesce(a, F.lit("")), F.coalesce(b, F.lit(""))
    pair = F.concat_ws("\u0001", F.least(x, y), F.greatest(x, y))
    known = F.create_map(*(F.lit(v) for k, label in MERGED[field].items() for v in ("\u0001".join(k), label)))
    return F.when(nn(a == b), a).otherwise(F.try_element_at(known, pair))


def repair(current: Column, future: Column) -> tuple[Column, Column]:
    """(current, future) with each repaired by the other: a known current view makes an unknown future 'neutral', then a
    known future makes an irrelevant current 'unclear'; at last a 'tendency' is a bias and a neutral future no change."""
    unknown = lambda c: nn(c.isin(*UNCLEAR))
    filled = F.when(current.isNotNull() & ~unknown(current) & unknown(future), "neutral").otherwise(future)
    now = F.when(nn(current == "irrelevant") & filled.isNotNull() & ~unknown(filled), "unclear").otherwise(current)
    return now, F.replace(F.replace(filled, F.lit("tendency"), F.lit("bias")), F.lit("neutral"), F.lit("no change"))


def fold_stance(value: Column) -> Column:
    """Stances as they are scored: irrelevant is unclear, and a bias counts as its direction."""
    return F.when(value == "irrelevant", "unclear").otherwise(F.replace(value, F.lit(" bias"), F.lit("")))


def fold_agreement(value: Column) -> Column:
    return F.when(value == "irrelevant", "mostly agree").otherwise(value)


def is_label(value: Column, allowed: tuple[str, ...]) -> Column:
    """Whether it is exactly one of the labels; null is none."""
    return nn(value.isin(*allowed))


def recode(value: Column, mapping: dict[str, str]) -> Column:
    """Mapped labels; others stay."""
    if not mapping:
        return value
    known = F.create_map(*(F.lit(x) for kv in mapping.items() for x in kv))
    return F.coalesce(F.try_element_at(known, value), value)
