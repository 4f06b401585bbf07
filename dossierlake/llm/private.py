"""Personal data in free text, found by weak supervision and replaced by typed placeholders.

Labelers vote on candidate spans (`spans`); two more know all texts: whether a pair of capitalized words is a fixed
expression (its second word follows only that first one) or a name (its second word follows many), and whether either
word stands elsewhere where only names stand, so that a name is known in phrases no list has. Per kind,
expectation-maximisation over the vote patterns, whose counts cover every candidate, estimates how reliable each labeler
is and how likely each pattern is a mention. A logistic model over votes, form, affixes and neighbouring words is then
trained on those likelihoods, on a bounded sample of candidates (TRAIN_ROWS), and decides every span.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from dossierlake.llm import spans
from dossierlake.session import write_shared

TRAIN_ROWS = 40_000
CELLS = 1 << 16
MAX_NAMES = 100_000
BROADCAST_BYTES = 4 << 20
#: A second word is a fixed expression if it occurs FIXED_LEAST times and follows one word in FIXED_SHARE of them, and a family name if it occurs NAME_LEAST times and no first word has more than NAME_SHARE.
FIXED_LEAST, FIXED_SHARE, NAME_LEAST, NAME_SHARE = 8, 0.9, 4, 0.6
#: A second word is backed if so large a share of its places has a title, a strong lead or an initial, and is not if so small a share has.
BACKED_SHARE, BACKED_LEAST = 0.4, 0.02

CANDIDATE = T.ArrayType(T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("begin_at", T.IntegerType()), T.StructField("end_at", T.IntegerType()), T.StructField("votes", T.StringType()),
    T.StructField("first", T.StringType()), T.StructField("second", T.StringType()), T.StructField("cells", T.ArrayType(T.IntegerType())),
]))


@lru_cache(500_000)
def _cell(feature: str) -> int:
    return zlib.crc32(feature.encode()) % CELLS


def given_names(df: DataFrame, column: str, most: int = MAX_NAMES) -> frozenset[str]:
    """The gazetteer, whose size is checked: it goes to every task."""
    rows = df.select(column).limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"a gazetteer of more than {most} names")
    return frozenset(r[0].casefold() for r in rows if r[0])


def find_candidates(df: DataFrame, id_col: str, text: str, names: frozenset[str]) -> DataFrame:
    """(id, text_hash, kind, begin_at, end_at, votes, first, second, cells): every candidate of every text; begin_at from 1."""
    shared = df.sparkSession.sparkContext.broadcast(names)

    @F.pandas_udf(CANDIDATE)
    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        gazetteer = shared.value
        for batch in batches:
            yield pd.Series([[{"kind": c.kind, "begin_at": c.begin + 1, "end_at": c.stop or c.end, "votes": c.votes, "first": c.given.casefold(), "second": c.family.casefold(), "cells": [_cell(f) for f in spans.features(t, c)]} for c in spans.candidates(t, gazetteer)] for t in batch])

    picked = df.select(F.col(id_col).alias("id"), F.col(text).alias("text")).where("text is not null and text != ''")
    return picked.select("id", F.xxhash64("text").alias("text_hash"), F.explode(scan("text")).alias("c")).select("id", "text_hash", "c.*")


def _of_places(n: Column, backed: Column) -> Column:
    return F.when((n >= FIXED_LEAST) & (backed / n <= BACKED_LEAST), "-").when((n >= NAME_LEAST) & (backed / n >= BACKED_SHARE), "+").otherwise("0")


def expression_votes(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((second, vote), (first, vote)): what all different texts say of the words of a pair. Two votes for each second word: it
    follows one first word only (-) or many (+), and it mostly stands where names stand (+) or hardly ever (-). One vote
    for each first word: the latter."""
    names = found.where("kind = 'name' and first != ''").select("second", "first", "text_hash", F.concat(F.substring("votes", 2, 2), F.substring("votes", 6, 1)).contains("+").alias("backed"))
    pairs = names.groupBy("second", "first", "text_hash").agg(F.max("backed").alias("backed"))
    counted = write_shared(pairs.groupBy("second", "first").agg(F.count("*").alias("n"), F.count_if("backed").alias("b")))
    seconds = counted.groupBy("second").agg(F.sum("n").alias("n"), F.max("n").alias("most"), F.sum("b").alias("b"))
    share = F.col("most") / F.col("n")
    of_words = F.when((F.col("n") >= FIXED_LEAST) & (share >= FIXED_SHARE), "-").when((F.col("n") >= NAME_LEAST) & (share <= NAME_SHARE), "+").otherwise("0")
    firsts = counted.groupBy("first").agg(F.sum("n").alias("n"), F.sum("b").alias("b"))
    by_second = seconds.select("second", F.concat(of_words, _of_places(F.col("n"), F.col("b"))).alias("vote")).where("vote != '00'")
    return by_second, firsts.select("first", _of_places(F.col("n"), F.col("b")).alias("vote")).where("vote != '0'")


def with_expressions(found: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """The candidates, names with three votes more, which the model sees as well."""
    names = found.where("kind = 'name'")
    for word, votes, name, none in zip(("second", "first"), expression_votes(found), ("_of_second", "_of_first"), ("00", "0")):
        table = write_shared(votes.withColumnRenamed("vote", name))
        size = table.agg(F.sum(F.length(word) * 2 + 48)).first()[0] or 0
        names = names.join(F.broadcast(table) if size <= broadcast_bytes else table, word, "left").withColumn(name, F.coalesce(name, F.lit(none)))
    at, more = spans.LABELERS["name"], F.concat("_of_second", "_of_first")
    marks = F.array(*(F.concat(F.lit(f"name|v{at + i}"), F.substring(more, i + 1, 1)) for i in range(3)))
    cells = F.transform(F.filter(marks, lambda m: ~F.endswith(m, F.lit("0"))), lambda m: F.pmod(F.crc32(m.cast("binary")), F.lit(CELLS)).cast("int"))
    voted = names.withColumns({"votes": F.concat("votes", more), "cells": F.concat("cells", cells)}).drop("_of_second", "_of_first")
    return found.where("kind != 'name'").unionByName(voted)


def estimate(patterns: list[tuple[str, int]], rounds: int = 200) -> dict[str, float]:
    """The likelihood that a candidate with a pattern of votes is a mention.

    Two classes, labelers independent within a class and free to abstain. Starts from the balance of the votes; a prior
    of a twentieth of the candidates keeps each labeler's votes on the side they are cast for.
    """
    if not patterns:
        return {}
    votes = np.array([["-0+".index(v) for v in p] for p, _ in patterns])
    n = np.array([c for _, c in patterns], dtype=float)
    balance = (votes - 1).sum(axis=1)
    q = 1 / (1 + np.exp(-2.0 * np.clip(balance, -3, 3)))
    weight = max(1.0, 0.05 * n.sum())
    prior = {1: np.array([0.02, 0.3, 0.68]) * weight, 0: np.array([0.5, 0.45, 0.05]) * weight}
    for _ in range(rounds):
        logs = {}
        for y, w in ((1, n * q), (0, n * (1 - q))):
            total = np.log((w.sum() + 0.5 * weight) / (n.sum() + weight))
            logs[y] = np.full(len(n), total)
            for j in range(votes.shape[1]):
                table = np.bincount(votes[:, j], weights=w, minlength=3) + prior[y]
                logs[y] += np.log(table / table.sum())[votes[:, j]]
        new = 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -50, 50)))
        if np.abs(new - q).max() < 1e-6:
            break
        q = new
    return {p: float(x) for (p, _), x in zip(patterns, q)}


def train(rows: list, likelihood: dict[tuple[str, str], float], epochs: int = 6, rate: float = 0.3, seed: int = 7) -> np.ndarray:
    """Weights of a logistic model over the cells, by adaptive gradient steps in small batches."""
    w, g2, rng = np.zeros(CELLS), np.full(CELLS, 1e-6), np.random.default_rng(seed)
    sample = [(np.array(r["cells"]), likelihood[(r["kind"], r["votes"])]) for r in rows]
    for _ in range(epochs if sample else 0):
        for batch in np.array_split(rng.permutation(len(sample)), max(1, len(sample) // 64)):
            at = np.concatenate([sample[i][0] for i in batch])
            owner = np.repeat(np.arange(len(batch)), [len(sample[i][0]) for i in batch])
            p = 1 / (1 + np.exp(-np.clip(np.bincount(owner, weights=w[at], minlength=len(batch)), -30, 30)))
            grad = np.bincount(at, weights=(p - np.array([sample[i][1] for i in batch]))[owner], minlength=CELLS)
            hit = np.unique(at)
            step = grad[hit] / len(batch) + 1e-6 * w[hit]
            g2[hit] += step**2
            w[hit] -= rate * step / np.sqrt(g2[hit])
    return w


def find_private(df: DataFrame, id_col: str, text: str, names: frozenset[str], train_rows: int = TRAIN_ROWS, least: float = 0.5) -> DataFrame:
    """(id, kind, begin_at, end_at, likelihood): the mentions; begin_at and end_at count code points from 1, both included.

    Null and empty texts have none; repeated texts and ids are judged alike, each on its own row.
    """
    spark = df.sparkSession
    found = with_expressions(write_shared(find_candidates(df, id_col, text, names)))
    counts: dict[str, list[tuple[str, int]]] = {}
    for r in found.groupBy("kind", "votes").agg(F.count("*").alias("n")).collect():  # vote patterns, not candidates
        counts.setdefault(r["kind"], []).append((r["votes"], r["n"]))
    likelihood = {(k, p): x for k, patterns in counts.items() for p, x in estimate(patterns).items()}
    sample = found.select("kind", "votes", "cells", F.xxhash64("id", "begin_at", F.lit(7)).alias("h")).orderBy("h").limit(train_rows).collect()
    weights = spark.sparkContext.broadcast(train(sample, likelihood))

    @F.pandas_udf(T.DoubleType())
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        w = weights.value
        for cells in batches:
            yield pd.Series(1 / (1 + np.exp(-np.clip(np.array([w[c].sum() for c in cells]), -30, 30))))

    return found.select("id", "kind", "begin_at", "end_at", judge("cells").alias("likelihood")).where(F.col("likelihood") >= least)


def redact(df: DataFrame, id_col: str, text: str, found: DataFrame) -> DataFrame:
    """(id, text): every text, its mentions replaced by [EMAIL], [PHONE], [IDENTITY], [ADDRESS] and [NAME]; the rest stays as it is. Ids must be unique."""
    marks = found.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("begin_at", "end_at", F.upper("kind").alias("kind")))).alias("marks"))  # grows with one text, not with the corpus
    joined = df.select(F.col(id_col).alias("id"), F.col(text).alias("text")).join(marks, "id", "left")
    start = F.struct(F.lit("").alias("done"), F.lit(1).alias("at"))

    def step(acc: Column, m: Column) -> Column:
        kept = F.concat(acc["done"], F.substring(F.col("text"), acc["at"], m["begin_at"] - acc["at"]), F.lit("["), m["kind"], F.lit("]"))
        return F.when(m["begin_at"] < acc["at"], acc).otherwise(F.struct(kept.alias("done"), (m["end_at"] + 1).alias("at")))

    rest = lambda acc: F.concat(acc["done"], F.substr(F.col("text"), acc["at"]))
    return joined.select("id", F.when(F.col("marks").isNull(), F.col("text")).otherwise(F.aggregate("marks", start, step, rest)).alias("text"))
