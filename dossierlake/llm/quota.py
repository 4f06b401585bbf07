"""A sample whose shares by category match targets, with a floor for each category.

Only counts decide: records are grouped by category signature, a random sample that meets the floors gives the starting
counts, and swap repair moves counts from the signature that is most over its target to the one that is most under
while that lowers the deviation. The counts are then drawn: a record's rank is a hash of its id, and the cut of a
category is found from sums over hash cells, so that only the one cell the cut falls into is sorted, never a category.
"""

from __future__ import annotations

import heapq

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

#: Hash cells of a category, from which its cut is found.
CELLS = 4096
MAX_SIGNATURES = 100_000


def random_counts(free: dict[tuple, int], n: int, rng: np.random.Generator) -> dict[tuple, int]:
    """How many of n rows drawn at random, without putting back, fall to each signature that has so many free ones.

    One signature after the other, each by its hypergeometric number; where the numbers are beyond what numpy draws
    (10^9), by the binomial one, held to what is possible.
    """
    out, rest = {}, sum(free.values())
    n = min(n, rest)
    for k, have in free.items():
        rest -= have
        if have + rest < 1_000_000_000:
            got = int(rng.hypergeometric(have, rest, n)) if n else 0
        else:
            got = min(have, max(n - rest, int(rng.binomial(n, have / (have + rest)))))
        out[k], n = got, n - got
    return out


def swap_repair(have: dict[tuple, int], floor: dict[tuple, int], size: int, wanted: dict[tuple, float], seed: int = 7) -> dict[tuple, int]:
    """Counts by signature that sum to size, or to all there is, and deviate least from wanted.

    Starts from a random sample that satisfies the floors, then exchanges counts between the signature that is most
    over and the one that is most under its target, as many as lower the squared deviation most, until none does.
    Floors hold before size does: if they sum to more, so does the result.
    """
    low = {k: min(n, floor.get(k, 0)) for k, n in have.items()}
    free = {k: have[k] - low[k] for k in sorted(have, key=str)}
    drawn = random_counts(free, max(0, size - sum(low.values())), np.random.default_rng(seed))
    take = {k: low[k] + drawn[k] for k in have}
    off = {k: take[k] - wanted.get(k, 0.0) for k in have}
    over, under = [(-d, k) for k, d in off.items()], [(d, k) for k, d in off.items()]
    heapq.heapify(over)
    heapq.heapify(under)
    while over and under:
        (a, give), (b, get) = over[0], under[0]
        if -a != off[give] or take[give] <= low[give]:
            heapq.heappop(over)
        elif b != off[get] or take[get] >= have[get]:
            heapq.heappop(under)
        elif off[give] - off[get] <= 1:
            break
        else:
            move = max(1, min(int((off[give] - off[get]) / 2), take[give] - low[give], have[get] - take[get]))
            for k, m in ((give, -move), (get, move)):
                take[k], off[k] = take[k] + m, off[k] + m
                heapq.heappush(over, (-off[k], k))
                heapq.heappush(under, (off[k], k))
    return take


def plan(usable: DataFrame, by: list[str], targets: DataFrame, permille: str, min_rows: str, one_in: int = 5, whole: bool = False, max_signatures: int = MAX_SIGNATURES) -> DataFrame:
    """(by…, have, needed, take, met, reached): for every target, how many rows there are, are needed and are taken; met: whether
    there are so many rows; reached: whether so many are taken.

    The sample has one row in `one_in` of the usable rows, rounded down; a target needs the larger of min_rows and its
    share of that, rounded up. Its floor is min_rows: as shares are rounded up for every target, all needs together may be
    a few rows more than the sample has, and a target with enough rows may miss its need by one. With `whole` every need is a
    floor and the sample grows by those rows, so that a target is reached exactly if there are enough rows for it. Rows without a
    target are taken only where targets fall short. The plan is a small table: one row per signature, whose number is
    checked. Null or negative goals need nothing; an empty table takes nothing.
    """
    counts = usable.groupBy(*by).agg(F.count("*").alias("have")).limit(max_signatures + 1).collect()
    if len(counts) > max_signatures:
        raise ValueError(f"more than {max_signatures} signatures")
    goals = targets.select(*by, permille, min_rows).limit(max_signatures + 1).collect()
    if len(goals) > max_signatures:
        raise ValueError(f"more than {max_signatures} targets")
    key = lambda r: tuple(r[c] for c in by)
    have = {key(r): r["have"] for r in counts}
    for r in goals:
        have.setdefault(key(r), 0)
    size = sum(have.values()) // one_in
    needed = {key(r): max(r[min_rows] or 0, -(-size * (r[permille] or 0) // 1000)) for r in goals}
    wanted = {key(r): size * (r[permille] or 0) / 1000 for r in goals}
    floor = needed if whole else {key(r): r[min_rows] or 0 for r in goals}
    take = swap_repair(have, floor, size, wanted)
    spark = usable.sparkSession
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in usable.select(*by).schema)
    at_least = lambda n, k: None if k not in needed else n >= needed[k]
    rows = [(*k, have[k], needed.get(k), take[k], at_least(have[k], k), at_least(take[k], k)) for k in have]
    return spark.createDataFrame(rows, f"{kinds}, have bigint, needed bigint, take bigint, met boolean, reached boolean")


def draw(usable: DataFrame, by: list[str], quotas: DataFrame, id_col: str, seed: int = 7) -> DataFrame:
    """The rows of usable that make up the planned counts, drawn at random by a hash of their id (and, for repeated ids, any of them)."""
    rank = F.xxhash64(F.col(id_col), F.lit(seed))
    cell: Column = F.pmod(F.shiftright(rank, 20), F.lit(CELLS)).cast("int")
    ranked = usable.withColumns({"_rank": rank, "_cell": cell})
    sums = ranked.groupBy(*by, "_cell").agg(F.count("*").alias("_n"))  # CELLS rows for each signature
    upto = F.sum("_n").over(Window.partitionBy(*by).orderBy("_cell").rowsBetween(Window.unboundedPreceding, 0))
    cuts = sums.withColumn("_upto", upto).join(F.broadcast(quotas.select(*by, "take")), by)
    cuts = cuts.where(F.col("_upto") - F.col("_n") < F.col("take")).select(*by, "_cell", (F.col("take") - F.col("_upto") + F.col("_n")).alias("_left"), "_n")
    kept = ranked.join(cuts, [*by, "_cell"])
    whole = kept.where(F.col("_left") >= F.col("_n"))
    last = kept.where(F.col("_left") < F.col("_n")).withColumn("_no", F.row_number().over(Window.partitionBy(*by, "_cell").orderBy("_rank", id_col)))
    return whole.unionByName(last.where(F.col("_no") <= F.col("_left")).drop("_no")).drop("_rank", "_cell", "_left", "_n")
