"""Runs compared with each other, and predictions with gold labels."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from dossierlake.functions.stance import fold_stance
from dossierlake.functions.text import squash


def _same(a: Column, b: Column) -> Column:
    return F.lower(squash(a.cast("string"))) == F.lower(squash(b.cast("string")))


def category_match(df: DataFrame, pairs: dict[str, tuple[str, str]], by: list[str] = ()) -> DataFrame:
    """(by…, variable, valid, matches, rate): rows where both sides are known, and how many agree without case and blanks."""
    long = df.select(*by, F.explode(F.array(*(F.struct(F.lit(v).alias("variable"), F.col(a).cast("string").alias("a"), F.col(b).cast("string").alias("b")) for v, (a, b) in pairs.items()))).alias("x")).select(*by, "x.*")
    known = long.where("a is not null and b is not null")
    return known.groupBy(*by, "variable").agg(F.count("*").alias("valid"), F.count_if(_same(F.col("a"), F.col("b"))).alias("matches"), F.round(F.avg(_same(F.col("a"), F.col("b")).cast("int")), 6).alias("rate"))


def overall_rate(matches: DataFrame, by: list[str]) -> DataFrame:
    """The mean of the variables' rates."""
    return matches.groupBy(*by).agg(F.round(F.avg("rate"), 6).alias("overall"))


def numeric_comparison(df: DataFrame, a: str, b: str, by: list[str] = ()) -> DataFrame:
    """Means, mean difference, mean absolute and root mean square error, correlation, percent equal, and the limits within which 95 % of the differences lie."""
    known = df.where(F.col(a).isNotNull() & F.col(b).isNotNull()).select(*by, F.col(a).cast("double").alias("a"), F.col(b).cast("double").alias("b"), (F.col(b) - F.col(a)).cast("double").alias("d"))
    r = lambda c, n: F.round(c, 6).alias(n)
    return known.groupBy(*by).agg(
        F.count("*").alias("n"), r(F.avg("a"), "mean_a"), r(F.avg("b"), "mean_b"), r(F.avg("d"), "mean_diff"), r(F.avg(F.abs("d")), "mae"), r(F.sqrt(F.avg(F.col("d") * F.col("d"))), "rmse"),
        r(F.corr("a", "b"), "pearson"), r(100.0 * F.avg((F.col("d") == 0).cast("int")), "exact_pct"), r(F.avg("d") - 1.96 * F.stddev_samp("d"), "lower_limit"), r(F.avg("d") + 1.96 * F.stddev_samp("d"), "upper_limit"),
    )


def transitions(df: DataFrame, a: str, b: str, k: int = 5) -> DataFrame:
    """The k most frequent changes from one label to another, with their percent of all changes."""
    changed = df.where(F.col(a).isNotNull() & F.col(b).isNotNull() & ~_same(F.col(a), F.col(b))).groupBy(F.col(a).alias("old"), F.col(b).alias("new")).agg(F.count("*").alias("n"))
    total = changed.agg(F.sum("n").alias("total"))
    return changed.crossJoin(F.broadcast(total)).select("old", "new", "n", F.round(100.0 * F.col("n") / F.col("total"), 6).alias("pct")).orderBy(F.desc("n"), "old", "new").limit(k)


def confusion(df: DataFrame, gold: str, predicted: str, merge: dict[str, str] | None = None) -> DataFrame:
    """(gold, predicted, n) of rows with both labels; labels may be merged first."""
    put = lambda c: reduce(lambda out, kv: F.when(F.col(c) == kv[0], F.lit(kv[1])).otherwise(out), (merge or {}).items(), F.col(c))
    return df.select(put(gold).alias("gold"), put(predicted).alias("predicted")).where("gold is not null and predicted is not null").groupBy("gold", "predicted").agg(F.count("*").alias("n"))


def label_metrics(table: DataFrame) -> DataFrame:
    """(label, support, precision, recall, f1) from a confusion table; 0 where undefined. Labels that only one side has count."""
    gold = table.groupBy(F.col("gold").alias("label")).agg(F.sum("n").alias("support"))
    said = table.groupBy(F.col("predicted").alias("label")).agg(F.sum("n").alias("said"))
    hit = table.where("gold = predicted").select(F.col("gold").alias("label"), F.col("n").alias("hit"))
    joined = gold.join(said, "label", "full").join(hit, "label", "left").na.fill(0)
    p, r = F.coalesce(F.col("hit") / F.nullif("said", F.lit(0)), F.lit(0.0)), F.coalesce(F.col("hit") / F.nullif("support", F.lit(0)), F.lit(0.0))
    f1 = F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(0.0)
    return joined.select("label", "support", F.round(p, 6).alias("precision"), F.round(r, 6).alias("recall"), F.round(f1, 6).alias("f1"))


def overall_metrics(table: DataFrame) -> DataFrame:
    """One row: accuracy, and macro and weighted precision, recall and F1."""
    per = label_metrics(table)
    w = lambda c: F.round(F.sum(F.col(c) * F.col("support")) / F.sum("support"), 5).alias("weighted_" + c)
    m = lambda c: F.round(F.avg(c), 5).alias("macro_" + c)
    accuracy = table.agg(F.round(F.sum(F.when(F.col("gold") == F.col("predicted"), F.col("n")).otherwise(0)) / F.sum("n"), 6).alias("accuracy"), F.sum("n").alias("n"))
    return accuracy.crossJoin(per.agg(*(f(c) for c in ("precision", "recall", "f1") for f in (m, w))))


def membership_accuracy(df: DataFrame, gold: str, predicted: str) -> DataFrame:
    return df.where(F.col(gold).isNotNull()).agg(F.count("*").alias("n"), F.round(F.avg(F.coalesce(F.array_contains(predicted, F.col(gold)), F.lit(False)).cast("int")), 6).alias("accuracy"))


def example_errors(df: DataFrame, messages: str) -> DataFrame:
    """Counts of what is wrong with chat examples: no messages, no answer, an unknown role, a missing key, an empty content."""
    m = F.col(messages)
    roles = F.transform(m, lambda x: x["role"])
    checks = {
        "missing_messages": m.isNull() | (F.size(m) == 0),
        "no_assistant": ~F.array_contains(roles, "assistant"),
        "unknown_role": F.exists(roles, lambda r: ~r.isin("system", "user", "assistant", "function") | r.isNull()),
        "empty_content": F.exists(m, lambda x: x["content"].isNull() | (x["content"] == "")),
    }
    return df.agg(F.count("*").alias("n_examples"), *(F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in checks.items()))


def same_label_order(a: DataFrame, b: DataFrame, label: str) -> DataFrame:
    """One row: whether two samples rank their labels by frequency alike."""
    ranked = lambda t: t.groupBy(label).agg(F.count("*").alias("n")).agg(F.transform(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("n"), F.col(label).alias("l")))), lambda x: x["l"]).alias("o"))
    return ranked(a).select(F.col("o").alias("left_order")).crossJoin(ranked(b).select(F.col("o").alias("right_order"))).withColumn("same", F.col("left_order") == F.col("right_order"))


def bottom_matrix(rates: DataFrame, key: str, at: str, rate: str, years: list[int], k: int = 30) -> DataFrame:
    """key × year means of the k keys with the lowest mean (a report, so the limit is the feature)."""
    worst = rates.groupBy(key).agg(F.avg(rate).alias("_m")).orderBy("_m", key).limit(k).select(key)
    return rates.join(F.broadcast(worst), key, "left_semi").groupBy(key).pivot(at, years).agg(F.round(F.avg(rate), 6))


def field_accuracies(df: DataFrame, fields: dict[str, tuple[str, str]]) -> DataFrame:
    """(metric, value): for each field (gold, predicted) the accuracy, and the accuracy after folding (`fold_stance`) as '…_merge_unclear'. Rows without either label count nowhere."""
    parts = []
    for name, (gold, said) in fields.items():
        for tail, put in (("", lambda c: c), ("_merge_unclear", fold_stance)):
            parts.append(F.struct(F.lit(f"{name}_accuracy{tail}").alias("metric"), (put(F.col(gold)) == put(F.col(said))).cast("int").alias("hit")))
    return df.select(F.explode(F.array(*parts)).alias("x")).where("x.hit is not null").groupBy("x.metric").agg(F.round(F.avg("x.hit"), 6).alias("value"))


def average_metric(metrics: DataFrame, part: str = "accuracy") -> DataFrame:
    """The mean of all metrics whose name has the part in it, so folded ones count as well."""
    return metrics.where(F.contains("metric", F.lit(part))).agg(F.round(F.avg("value"), 5).alias(f"average_{part}"))
