"""Aggregates, shares and reshaping. Pivots always name their values, so none needs a pass to find them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from dossierlake.functions.stance import BUCKETS, bucket, nn, no_disagreement, recode
from dossierlake.functions.text import strip


def ordered_join(text: Column, order: Column, sep: str) -> Column:
    """The non-blank texts of a group in order, joined. Grows with one document, not with the corpus."""
    kept = F.collect_list(F.when(strip(text) != "", F.struct(order.alias("o"), text.alias("t"))))
    return F.array_join(F.transform(F.array_sort(kept), lambda x: x["t"]), sep)


def year_group_counts(df: DataFrame, year: str, group: str, order: list[str]) -> DataFrame:
    return df.where(F.col(year).isNotNull()).groupBy(year).pivot(group, order).agg(F.count(F.lit(1))).na.fill(0)


def no_disagreement_by_year(df: DataFrame, year: str, group: str, agreement: str, order: list[str]) -> DataFrame:
    """Percent without disagreement for each year, over all and per group."""
    flag = no_disagreement(F.col(agreement))
    one = lambda cond, name: F.round(100.0 * F.sum(F.when(cond, flag)) / F.nullif(F.sum(F.when(cond, F.lit(1))), F.lit(0)), 6).alias(name)
    return df.where(F.col(year).isNotNull()).groupBy(year).agg(one(F.lit(True), "ALL"), *(one(F.col(group) == g, g) for g in order))


def grouping_rollup(df: DataFrame, year: str, group: str, agreement: str) -> DataFrame:
    """The same in long form, by grouping sets: (year), (year, group)."""
    flagged = df.where(F.col(year).isNotNull() & F.col(group).isNotNull()).select(F.col(year).alias("year"), F.col(group).alias("grp"), no_disagreement(F.col(agreement)).alias("flag"))
    sets = flagged.groupingSets([[F.col("year")], [F.col("year"), F.col("grp")]], F.col("year"), F.col("grp"))
    return sets.agg(F.count("*").alias("n"), F.round(100.0 * F.avg("flag"), 6).alias("pct")).select("year", F.coalesce("grp", F.lit("ALL")).alias("grp"), "n", "pct")


def category_percentage_by_year(df: DataFrame, year: str, categories: str, order: list[str]) -> DataFrame:
    """Percent of a year's rows that have each category, rounded half to even; years come from all rows, with or without categories."""
    pct = lambda c: F.bround(100.0 * F.sum(nn(F.array_contains(categories, c)).cast("int")) / F.count("*"), 2).alias(c)
    return df.where(F.col(year).isNotNull()).groupBy(year).agg(*(pct(c) for c in order))


def share_by(df: DataFrame, by: str, category: str, order: list[str]) -> DataFrame:
    """(by, category, n, share): shares within `by` of the categories in the list; others are left out before the whole is summed."""
    counted = df.where(F.col(by).isNotNull() & F.col(category).isin(*order)).groupBy(by, category).agg(F.count("*").alias("n"))
    whole = F.sum("n").over(Window.partitionBy(by))
    return counted.withColumn("share", F.round(F.col("n") / whole, 6))


def slug(value: Column) -> Column:
    """A name as part of a column name: lower case, other signs than letters and digits as single underscores."""
    return F.regexp_replace(F.regexp_replace(F.lower(strip(value)), r"[^\p{L}\p{N}]+", "_"), "^_|_$", "")


def pivot_stances(df: DataFrame, keys: list[str], author: str, fields: list[str], order: str, author_map: dict[str, str] | None = None, authors: tuple[str, ...] = ("staff", "buff")) -> DataFrame:
    """One row for each key with <author>_<field>: the first label that is there, by `order`. author_map renames authors before they become part of a name; authors outside the list are left out."""
    put = df.withColumn("_author", slug(recode(F.col(author), author_map or {})))
    first = lambda a, f: F.min_by(F.col(f), F.when((F.col("_author") == a) & F.col(f).isNotNull(), F.col(order))).alias(f"{a}_{f}")
    return put.where(F.col("_author").isin(*authors)).groupBy(*keys).agg(*(first(a, f) for a in authors for f in fields))


def compare_shares(df: DataFrame, by: str, diff: str, bucket: Callable[[Column], Column] = bucket, order: tuple[str, ...] = BUCKETS) -> DataFrame:
    """(by, bucket, n, share): how differences fall into buckets, which the caller may name otherwise; unknown differences are left out."""
    return share_by(df.where(F.col(diff).isNotNull()).select(by, bucket(F.col(diff)).alias("bucket")), by, "bucket", list(order))


def crosstab(df: DataFrame, rows: str, columns: str) -> DataFrame:
    """Counts by row and column with margins, as a cube; margins are 'All'."""
    named = df.where(F.col(rows).isNotNull() & F.col(columns).isNotNull()).select(F.col(rows).alias("r"), F.col(columns).alias("c"))
    return named.cube("r", "c").agg(F.count("*").alias("n")).select(F.coalesce("r", F.lit("All")).alias("row_label"), F.coalesce("c", F.lit("All")).alias("col_label"), "n")


def crosstab_pct(df: DataFrame, rows: str, columns: str) -> DataFrame:
    counted = df.where(F.col(rows).isNotNull() & F.col(columns).isNotNull()).groupBy(F.col(rows).alias("row_label"), F.col(columns).alias("col_label")).agg(F.count("*").alias("n"))
    total = counted.agg(F.sum("n").alias("total"))
    return counted.crossJoin(F.broadcast(total)).select("row_label", "col_label", F.round(100.0 * F.col("n") / F.col("total"), 6).alias("pct"))


def value_counts(df: DataFrame, column: str, normalize: bool = False) -> DataFrame:
    counted = df.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
    if not normalize:
        return counted
    return counted.crossJoin(F.broadcast(counted.agg(F.sum("n").alias("total")))).select("value", "n", F.round(F.col("n") / F.col("total"), 6).alias("share"))


def top_per_group(df: DataFrame, by: list[str], order: list[Column], k: int) -> DataFrame:
    """The first k rows of each group (a report, so the limit is the feature)."""
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= k)


def pivot_labels(long: DataFrame, key: list[str], topic: str, confidence: str, topics: list[str]) -> DataFrame:
    """One row for each key with the greatest confidence of every topic, 0 where it has none; topics outside the list are dropped, keys stay."""
    return long.groupBy(*key).pivot(topic, topics).agg(F.max(confidence)).na.fill(0, topics)


def pivot_text(df: DataFrame, keys: list[str], kind: str, kinds: list[str], text: str, order: str, sep: str = " ") -> DataFrame:
    """Texts of each kind as columns, joined in order; rows with a null key are dropped."""
    known = df.where(F.lit(True) if not keys else ~F.exists(F.array(*(F.col(k).cast("string") for k in keys)), lambda x: x.isNull()))
    return known.groupBy(*keys).agg(*(F.nullif(ordered_join(F.when(F.col(kind) == k, F.col(text)), F.col(order), sep), F.lit("")).alias(k) for k in kinds))


def text_by_topic(df: DataFrame, keys: list[str], topics: dict[str, Column], text: str, order: str, sep: str = "\n\n") -> DataFrame:
    """(keys…, topic, text): the texts of each group that belong to a topic, in order. A text may belong to several; groups without text are left out."""
    hit = F.array_compact(F.array(*(F.when(nn(c), F.lit(t)) for t, c in topics.items())))
    long = df.select(*keys, F.col(order).alias("_o"), F.col(text).alias("_t"), F.explode(hit).alias("topic")).where(strip(F.col("_t")) != "")
    return long.groupBy(*keys, "topic").agg(ordered_join(F.col("_t"), F.col("_o"), sep).alias("text"))


def first_filled(df: DataFrame, key: str, columns: list[str], priority: list[Column], lists: dict[str, str] | None = None) -> DataFrame:
    """Per key, the first non-blank value of each column by priority, and the distinct values of list columns in that order, joined."""
    rank = F.struct(*priority)
    firsts = [F.min_by(F.col(c), F.when(F.col(c).isNotNull() & (strip(F.col(c)) != ""), rank)).alias(c) for c in columns]
    joined = []
    for name, column in (lists or {}).items():
        items = F.transform(F.array_sort(F.collect_list(F.when(strip(F.col(column)) != "", F.struct(rank.alias("o"), F.col(column).alias("t"))))), lambda x: x["t"])
        joined.append(F.array_join(F.array_distinct(items), " | ").alias(name))
    return df.groupBy(key).agg(F.count("*").alias("n_rows"), *firsts, *joined)


def flag_counts(df: DataFrame, flags: dict[str, Column]) -> DataFrame:
    """One row: all rows, and those for which each condition holds."""
    return df.agg(F.count("*").alias("n_rows"), *(F.count_if(nn(c)).alias(n) for n, c in flags.items()))


def summary(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """count, mean, median, and the tenth and ninetieth percentile, linearly interpolated."""
    q = lambda p: F.round(F.percentile(value, p), 6)
    return df.groupBy(*by).agg(F.count(value).alias("n"), F.round(F.avg(value), 6).alias("mean"), q(0.5).alias("median"), q(0.1).alias("p10"), q(0.9).alias("p90"))


def mean_and_deviation(df: DataFrame, by: list[str], value: str) -> DataFrame:
    return df.groupBy(*by).agg(F.round(F.avg(value), 6).alias("mean"), F.round(F.stddev_samp(value), 6).alias("deviation"))
