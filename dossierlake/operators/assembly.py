"""Texts by sector with a fall-back, scores by sector, and look-ups by the name of a season or year."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from dossierlake.functions.stance import nn
from dossierlake.functions.text import has_keywords, strip_fences
from dossierlake.operators.aggregate import ordered_join

SECTORS = ("Monetary", "Fiscal", "External", "Financial", "Real")
#: The least score a paragraph of a sector needs, and words that stand in for a score.
LEAST = {"Monetary": 50, "Fiscal": 70, "External": 50, "Financial": 70, "Real": 70}
WORDS = {"Monetary": ["monetary"], "Fiscal": ["fiscal"], "Financial": ["financial"], "External": ["external", "current account", "exchange rate", "capital flow", "foreign reserve"]}


def sector_texts(df: DataFrame, key: str, kind: str, text: str, order: str, scores: dict[str, Column]) -> DataFrame:
    """(key, sector, staff, buff): the paragraphs of each sector and side, those of the appraisal (kind 'staff_a', 'buff_a') first.

    Paragraphs with the sector's least score; where a side has none, those with any score; where it has none either, those
    with the sector's words. Texts are joined by line breaks; one break stands between the two kinds, also if both are empty.
    Every key has a row for every sector of `scores`. One shuffle, by key and sector; rows without a key or kind are left out.
    """
    sector = F.explode(F.array(*(F.struct(F.lit(s).alias("sector"), F.coalesce(c.cast("double"), F.lit(0.0)).alias("score"), F.lit(float(LEAST[s])).alias("least"), (has_keywords(F.col(text), WORDS[s]) if s in WORDS else F.lit(False)).alias("word")) for s, c in scores.items())))
    long = df.where(F.col(key).isNotNull()).select(key, F.col(kind).alias("_k"), F.col(text).alias("_t"), F.col(order).alias("_o"), sector.alias("s")).select(key, "_k", "_t", "_o", "s.*")
    levels = {"sure": F.col("score") >= F.col("least"), "any": F.col("score") > 0, "word": F.col("word")}

    def body(side: str, condition: Column) -> Column:
        one = lambda k: F.coalesce(ordered_join(F.when(condition & nn(F.col("_k") == k), F.col("_t")), F.col("_o"), "\n"), F.lit(""))
        return F.concat(one(side + "_a"), F.lit("\n"), one(side))

    found = long.groupBy(key, "sector").agg(*(body(w, c).alias(f"{w}_{n}") for w in ("staff", "buff") for n, c in levels.items()))
    pick = lambda w: F.when(F.col(f"{w}_sure") != "\n", F.col(f"{w}_sure")).when(F.col(f"{w}_any") != "\n", F.col(f"{w}_any")).otherwise(F.col(f"{w}_word"))
    return found.select(key, "sector", pick("staff").alias("staff"), pick("buff").alias("buff"))


def sector_scores(reply: Column) -> dict[str, Column]:
    """general, a score for each sector (-5 to 5; 99 is none) and its areas, other_areas and error, from a reply in JSON, fenced or not. What is not an object with a general score is an error, whose text is kept."""
    bare = strip_fences(reply)
    number = lambda name: F.get_json_object(bare, f"$.{name}").try_cast("double")
    areas = lambda path: F.coalesce(F.from_json(F.get_json_object(bare, path), "map<string,double>"), F.create_map().cast("map<string,double>"))
    out = {"general": number("Agreement_General")}
    for s in SECTORS:
        score = number(f"Agreement_{s}")
        out[s], out[f"{s}_areas"] = F.when(score != 99, score), areas(f"$['{s} Sector']")
    out["other_areas"] = areas("$.other_areas")
    out["error"] = F.when(out["general"].isNull(), F.coalesce(bare, F.lit("no reply")))
    return out


def scores_by_year(df: DataFrame, year: str, scores: list[str]) -> DataFrame:
    """The mean of each score by year; a null score counts nowhere."""
    return df.where(F.col(year).isNotNull()).groupBy(year).agg(*(F.round(F.avg(s), 6).alias(s) for s in scores))


def score_histogram(df: DataFrame, scores: list[str]) -> DataFrame:
    """(score, one count for each column): how often each column has the score, 0 where never."""
    long = df.select(F.explode(F.array(*(F.struct(F.lit(s).alias("name"), F.col(s).cast("double").alias("score")) for s in scores))).alias("x")).select("x.*").where("score is not null")
    return long.groupBy("score").pivot("name", scores).agg(F.count(F.lit(1))).na.fill(0)


def share_with_areas(df: DataFrame, areas: dict[str, Column]) -> DataFrame:
    """One row: the share of rows that have any entry in each map."""
    return df.agg(*(F.round(F.avg((F.size(c) > 0).cast("int")), 6).alias(n) for n, c in areas.items()))


def season_name(day: Column, year: Column, turn: str = "07-01") -> Column:
    """'Fall Y' after the turn of the year Y, else 'Spring Y'; null without a year, and 'Spring' without a day."""
    after = nn(F.date_format(day, "yyyy-MM-dd") > F.concat(year.cast("string"), F.lit(f"-{turn}")))
    return F.concat(F.when(after, "Fall ").otherwise("Spring "), year.cast("string"))


def lookup_year(df: DataFrame, wide: DataFrame, key: str, year: str, years: dict[str, int], name: str) -> DataFrame:
    """df with the value that wide (key, a column for each year) has for its year, and its growth on the year before. wide has one row for each key."""
    long = wide.unpivot([F.col(key)], [F.col(c) for c in years], "_name", name)
    at = F.create_map(*(F.lit(x) for kv in years.items() for x in kv))
    long = long.select(F.col(key), F.element_at(at, F.col("_name")).alias(year), name).where(F.col(name).isNotNull())
    before = long.select(key, (F.col(year) + 1).alias(year), F.col(name).alias("_before"))
    both = long.join(before, [key, year], "left").withColumn(f"d_{name}", F.when(F.col("_before") != 0, F.col(name) / F.col("_before") - 1)).drop("_before")
    return df.join(both, [key, year], "left")


def first_packages(files: DataFrame, package: str, limit: int) -> DataFrame:
    """The files of the first packages by name: a limit that is asked for. Null packages are none."""
    names = files.where(F.col(package).isNotNull()).select(package).distinct().orderBy(package).limit(limit)
    return files.join(F.broadcast(names), package, "left_semi") if limit <= 100_000 else files.join(names, package, "left_semi")
