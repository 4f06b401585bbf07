"""Joins, merges, windows and set operations of the report pipeline."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from dossierlake.functions.text import name_aliases, name_key
from dossierlake.session import write_shared


def require_columns(df: DataFrame, columns: list[str], context: str) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{context}: missing columns {', '.join(missing)}")
    return df


def keep_first(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in a total order; null keys are a key of their own. One shuffle on the keys, with a combine before it."""
    others = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.min_by(F.struct(*others), F.struct(*order)).alias("_first"))
    return picked.select(*(F.col(c) if c in keys else F.col(f"_first.{c}") for c in df.columns))


def with_match_flag(left: DataFrame, right: DataFrame, on: list[str], flag: str) -> DataFrame:
    """Left join with a column that says whether there was a match."""
    return left.join(right.withColumn(flag, F.lit(True)), on, "left").withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))


def merge_incremental(main: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """main, and the incoming rows whose key it does not have. Repeated keys within either stay; null keys never match, so they are appended."""
    return main.unionByName(incoming.join(main.select(*keys).distinct(), keys, "left_anti"), allowMissingColumns=True)


def missing_from(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    return left.join(right.select(*on), on, "left_anti")


def present_in(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    return left.join(right.select(*on), on, "left_semi")


def resolve_names(df: DataFrame, name: str, reference: DataFrame, columns: list[str], order: str, carry: list[str]) -> DataFrame:
    """df with the carried columns of the reference entry that has the name as an alias; the first entry by `order` that claims an alias has it."""
    spelled = reduce(DataFrame.unionByName, (reference.select(F.explode(name_aliases(F.col(c))).alias("_alias"), order, *carry) for c in columns))
    first = spelled.groupBy("_alias").agg(F.min_by(F.struct(*carry), F.col(order)).alias("_entry"))
    return df.withColumn("_alias", name_key(F.col(name))).join(first, "_alias", "left").select(*df.columns, *(F.col(f"_entry.{c}") for c in carry))


def overlap_ratio(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """How much of the smaller side's distinct keys the sides share: decides by which key two runs are compared."""
    a, b = left.select(*on).dropna().distinct(), right.select(*on).dropna().distinct()
    counts = a.join(b, on).agg(F.count("*").alias("both")).crossJoin(a.agg(F.count("*").alias("l"))).crossJoin(b.agg(F.count("*").alias("r")))
    return counts.select("both", (F.col("both") / F.nullif(F.least("l", "r"), F.lit(0))).alias("ratio"))


def panel_join(left: DataFrame, right: DataFrame, how: str = "outer", keys: tuple[str, str] = ("country", "year"), lead: int = 0) -> DataFrame:
    """Country-year panels side by side; with lead, the right side of so many years later is attached."""
    other = right.withColumn(keys[1], F.col(keys[1]) - lead) if lead else right
    return left.join(other, list(keys), how)


def wide_to_long(df: DataFrame, ids: list[str], columns: list[str], name: str, value: str) -> DataFrame:
    return df.unpivot([F.col(c) for c in ids], [F.col(c) for c in columns], name, value)


def lookup_wide(df: DataFrame, wide: DataFrame, ids: list[str], columns: list[str], name: str, value: str) -> DataFrame:
    """The value that a wide table has in the column named by a row: the table is turned long and joined."""
    return df.join(wide_to_long(wide, ids, columns, name, value), [*ids, name], "left")


def next_event(df: DataFrame, events: DataFrame, key: str, at: str, event_at: str, horizon: int) -> DataFrame:
    """(df…, until): years to the next event of the key, 0 if it is in the same year; null if none is within the horizon.

    A row is set out to every year of the horizon and joined by equality, so there is no range join."""
    ahead = df.select(*df.columns, F.explode(F.sequence(F.lit(0), F.lit(horizon))).alias("_step")).withColumn("_year", F.col(at) + F.col("_step"))
    hits = ahead.join(events.select(F.col(key), F.col(event_at).alias("_year")).distinct(), [key, "_year"])
    nearest = hits.groupBy(*df.columns).agg(F.min("_step").alias("until"))
    return df.join(nearest.select(key, at, "until").distinct(), [key, at], "left")


def ever_and_after(df: DataFrame, key: str, at: str, flag: str) -> DataFrame:
    """flag_ever: whether the key ever has the flag (1); flag_after: whether it had it at an earlier time. The first time of each key is aggregated and joined, so no key gathers in a window; null keys have 0 and 0."""
    first = df.where(F.col(flag) == 1).groupBy(key).agg(F.min(at).alias("_first"))
    as_int = lambda c: F.coalesce(c, F.lit(False)).cast("int")
    return df.join(first, key, "left").withColumns({f"{flag}_ever": F.col("_first").isNotNull().cast("int"), f"{flag}_after": as_int(F.col(at) > F.col("_first"))}).select(*df.columns, f"{flag}_ever", f"{flag}_after")


def lag_by_year(df: DataFrame, key: str, at: str, value: str) -> DataFrame:
    """The value one year before, its difference and growth; null where that year is missing."""
    w = Window.partitionBy(key).orderBy(at)
    before = F.when(F.lag(at).over(w) == F.col(at) - 1, F.lag(value).over(w))
    return df.withColumn("lagged", before).withColumns({"change": F.col(value) - F.col("lagged"), "growth": F.when(F.col("lagged") != 0, F.col(value) / F.col("lagged") - 1)})


def lag_of_change(df: DataFrame, key: str, at: str, value: str) -> DataFrame:
    """lag_by_year, and the change of the year before as change_lagged; null where one of the three years is missing."""
    w = Window.partitionBy(key).orderBy(at)
    changed = lag_by_year(df, key, at, value)
    return changed.withColumn("change_lagged", F.when(F.lag(at).over(w) == F.col(at) - 1, F.lag("change").over(w)))


def first_and_second(df: DataFrame, key: str, order: list[Column], value: str) -> DataFrame:
    """(key, first, second): the first two values of each key, such as two annotators' labels."""
    w = Window.partitionBy(key).orderBy(*order)
    numbered = df.select(key, value, F.row_number().over(w).alias("_n")).where("_n <= 2")
    return numbered.groupBy(key).agg(F.max(F.when(F.col("_n") == 1, F.col(value))).alias("first"), F.max(F.when(F.col("_n") == 2, F.col(value))).alias("second"))


def carry_forward(df: DataFrame, key: str, at: str, source_year: int, until: int) -> DataFrame:
    """df, a row for each key and year, and the rows of one year repeated for those of the years after it in which their key has no row."""
    later = df.where(F.col(at) == source_year).withColumn(at, F.explode(F.sequence(*(F.lit(y).cast(df.schema[at].dataType) for y in (source_year + 1, until)))))
    taken = df.where(F.col(at).between(source_year + 1, until)).select(F.col(key).alias("_key"), F.col(at).alias("_at")).distinct()
    missing = later.join(taken, F.col(key).eqNullSafe(F.col("_key")) & (F.col(at) == F.col("_at")), "left_anti")
    return df.unionByName(missing)


def number_rows(df: DataFrame, order: list[Column], name: str = "id", cells: int = 64) -> DataFrame:
    """Positional numbers from 0 in a total order, without one task seeing all rows: rows are sorted by range, and the sizes of the ranges before are added."""
    ranked = write_shared(df.repartitionByRange(cells, *order).withColumn("_part", F.spark_partition_id()))  # ranges are drawn once
    local = ranked.withColumn("_at", F.row_number().over(Window.partitionBy("_part").orderBy(*order)) - 1)
    sizes = ranked.groupBy("_part").agg(F.count("*").alias("_n"))
    before = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("_part", "_before")
    return local.join(F.broadcast(before), "_part").withColumn(name, F.col("_before") + F.col("_at")).drop("_part", "_at", "_before")


def hash_sample(df: DataFrame, id_col: str, n: int, seed: int = 42) -> DataFrame:
    """n rows by a hash of the id: the same in every run and on every cluster."""
    return df.orderBy(F.xxhash64(F.col(id_col), F.lit(seed)), id_col).limit(n)


def folds(df: DataFrame, id_col: str, k: int, seed: int = 42) -> DataFrame:
    """A fold from 0 to k - 1 by a hash of the id; no shuffle."""
    return df.withColumn("fold", F.pmod(F.xxhash64(F.col(id_col), F.lit(seed)), F.lit(k)).cast("int"))


def grid(spark, **axes: list) -> DataFrame:
    """Every combination of the values of the axes: a product of a few short lists."""
    frames = (spark.createDataFrame([(v,) for v in values], [name]) for name, values in axes.items())
    return reduce(DataFrame.crossJoin, frames)
