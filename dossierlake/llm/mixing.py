"""Sources mixed to target weights by entropy balancing.

Every record gets a rate, the number of times it is used: the rates nearest to 1 in relative entropy under which each
source has its tokens, with no rate above the source's cap. They have the form min(cap, exp(lambda * tokens)), and the
dual is one convex problem in a lambda for each source. Newton's steps need sums over the records, which come from the
counts of records by source and length, summed again in every step by one distributed aggregate; a bracket keeps a step
from leaving the interval that holds the solution. Rates become copies: the whole part, and one more for the records
whose fraction, set against a hash of the id, is largest, up to the token where the target is reached.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from dossierlake.session import cut_lineage

STEPS, TOLERANCE = 60, 1e-9
CELLS = 4096
MAX_SOURCES = 10_000


def goals(tokens: DataFrame, targets: DataFrame, total: int | None = None, keep_shares: bool = False, max_sources: int = MAX_SOURCES) -> dict[str, dict]:
    """Per source: share, cap, tokens there are, tokens wanted (its share of the total) and tokens aimed at (no more than cap times what there is).

    total is the size of the mix; None takes all tokens of the sources in the targets. With keep_shares it is no more than
    the total at which every source that is there fills its share within its cap ('whole', which every source has). A null or
    repeated source, a null share and a cap under 1 are errors of the target list.
    """
    rows = targets.limit(max_sources + 1).collect()
    if len(rows) > max_sources:
        raise ValueError(f"more than {max_sources} sources")
    wanted = {r["source"]: r for r in rows}
    if None in wanted or len(wanted) < len(rows) or any(r["target_share"] is None or (r["max_repeats"] or 0) < 1 for r in rows):
        raise ValueError("targets need one row for each source, with a share and a cap of at least 1")
    sums = tokens.where(F.col("source").isin(*wanted)).groupBy("source").agg(F.sum("n").alias("n"), F.count("*").alias("c")).collect() if wanted else []
    have = {r["source"]: (r["n"] or 0, r["c"]) for r in sums}
    size = total if total is not None else sum(n for n, _ in have.values())
    reach = [r["max_repeats"] * have[s][0] / r["target_share"] for s, r in wanted.items() if r["target_share"] > 0 and have.get(s, (0, 0))[0]]
    whole = min(reach, default=0.0)
    size = min(size, whole) if keep_shares else size
    return {
        s: {"share": r["target_share"], "cap": r["max_repeats"], "have": have.get(s, (0, 0))[0], "records": have.get(s, (0, 0))[1], "wanted": r["target_share"] * size, "whole": r["target_share"] * whole, "aim": min(r["target_share"] * size, r["max_repeats"] * have.get(s, (0, 0))[0])}
        for s, r in wanted.items()
    }


def _with(df: DataFrame, values: dict[str, tuple], columns: str) -> DataFrame:
    """df with numbers of its source; sources without are left out. They come as a table of one row for each source, so that every step has the same plan and code."""
    rows = [(s, *map(float, v)) for s, v in values.items()]
    return df.join(F.broadcast(df.sparkSession.createDataFrame(rows, f"source string, {columns}")), "source")


def solve(lengths: DataFrame, plan: dict[str, dict], steps: int = STEPS) -> dict[str, float]:
    """The lambda of each source, for lengths (source, n, records); infinite where the cap binds for all records."""
    scale = {s: g["have"] / g["records"] for s, g in plan.items() if g["have"]}
    at, low, high, done = {}, {}, {}, {}
    for s, g in plan.items():
        if not g["have"] or g["aim"] <= 0:
            done[s] = float("-inf")
        elif g["aim"] >= g["cap"] * g["have"] * (1 - 1e-12):
            done[s] = float("inf")
        else:
            at[s], low[s], high[s] = 0.0, None, None
    for _ in range(steps):
        if not at:
            break
        z = F.col("n") / F.col("scale")
        rate = F.exp(F.least(F.col("at") * z, F.lit(50.0)))
        sums = _with(lengths, {s: (x, scale[s], plan[s]["cap"]) for s, x in at.items()}, "at double, scale double, cap double").groupBy("source").agg(
            F.sum(F.col("records") * F.col("n") * F.least(rate, F.col("cap"))).alias("f"),
            F.sum(F.when(rate < F.col("cap"), F.col("records") * F.col("n") * z * rate).otherwise(0.0)).alias("d"),
        )
        for r in sums.collect():
            s = r["source"]
            x, off = at[s], r["f"] - plan[s]["aim"]
            if abs(off) <= TOLERANCE * plan[s]["aim"]:
                done[s] = at.pop(s) / scale[s]
                continue
            low[s], high[s] = (x, high[s]) if off < 0 else (low[s], x)
            step = x - off / r["d"] if r["d"] else None
            inside = step is not None and (low[s] is None or step > low[s]) and (high[s] is None or step < high[s])
            if not inside:
                step = (low[s] + high[s]) / 2 if low[s] is not None and high[s] is not None else (2 * high[s] - 1 if low[s] is None else 2 * low[s] + 1)
            at[s] = step
    return done | {s: x / scale[s] for s, x in at.items()}


def mix(tokens: DataFrame, targets: DataFrame, total: int | None = None, keep_shares: bool = False, seed: int = 7) -> tuple[DataFrame, DataFrame]:
    """(copies, report) for tokens (id, source, n) and targets (source, target_share, max_repeats).

    copies: id, source, n, copies, for every record of a source in the targets; copies may be 0 and never exceeds
    max_repeats. report: source, target_share, max_repeats, tokens_available, tokens_wanted, tokens_reached,
    share_reached (of all tokens in the mix), short (whether the source cannot fill its share) and tokens_in_shares (what
    it would have in the largest mix in which no source that is there falls short), also for absent sources. Where sources
    fall short, the others keep their tokens and their shares rise; with keep_shares the mix is made smaller instead.
    Records of other or no sources are left out, as are those with null or no tokens. Ids may repeat; copies are by row.
    """
    spark = tokens.sparkSession
    usable = tokens.where("n > 0")
    plan = goals(usable, targets, total, keep_shares)
    known = usable.where(F.col("source").isin(*plan))
    lengths = cut_lineage(known.groupBy("source", "n").agg(F.count("*").alias("records")))
    found = solve(lengths, plan)
    # lambda, cap; a source without a target has rate 0 and no lambda
    rates = _with(known, {s: (max(min(x, 1e6), -1e6), g["cap"] if found[s] > float("-inf") else 0) for s, g in plan.items() for x in [found[s]]}, "lambda double, cap double")
    u = F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(1 << 40)) / float(1 << 40)
    rated = rates.withColumn("rate", F.least(F.exp(F.least(F.col("lambda") * F.col("n"), F.lit(50.0))), F.col("cap"))).withColumns({"whole": F.floor("rate"), "order": F.col("rate") - F.floor("rate") - u})
    # the fraction beats the hash at about the target; the exact place is found from sums over cells of `order`
    cell = F.greatest(F.lit(0), F.least(F.lit(CELLS - 1), F.floor((1 - F.col("order")) * (CELLS / 2)))).cast("int")
    placed = rated.select("id", "source", "n", "whole", "order", F.when(F.col("rate") > F.col("whole"), cell).alias("cell"))
    sums = placed.groupBy("source", "cell").agg(F.sum("n").alias("t"), F.sum(F.col("whole") * F.col("n")).alias("w")).collect()  # CELLS rows for each source
    by: dict[str, dict] = {}
    for r in sums:
        by.setdefault(r["source"], {})[r["cell"]] = (r["t"], r["w"])
    edge: dict[str, tuple[float, float]] = {}
    for s, cells in by.items():
        rest = plan[s]["aim"] - sum(w for _, w in cells.values())
        edge[s] = (CELLS, 0.0)
        for c in sorted(c for c in cells if c is not None):
            if cells[c][0] > rest:
                edge[s] = (c, max(0.0, rest))
                break
            rest -= cells[c][0]
    cut = _with(placed, edge, "edge double, room double")
    upto = F.sum("n").over(Window.partitionBy("source").orderBy(F.desc("order"), "id").rowsBetween(Window.unboundedPreceding, 0))
    last = cut.where(F.col("cell") == F.col("edge")).withColumn("upto", upto)  # one cell of each source
    in_edge = last.select("id", "source", "n", (F.col("whole") + (F.col("upto") - F.col("n") / 2 <= F.col("room")).cast("int")).cast("int").alias("copies"))
    others = cut.where(F.col("cell").isNull() | (F.col("cell") != F.col("edge")))
    outside = others.select("id", "source", "n", (F.col("whole") + F.coalesce((F.col("cell") < F.col("edge")).cast("int"), F.lit(0))).cast("int").alias("copies"))
    copies = outside.unionByName(in_edge)
    reached = copies.groupBy("source").agg(F.sum(F.col("n") * F.col("copies")).alias("tokens_reached"))
    kinds = "source string, target_share double, max_repeats int, tokens_available bigint, tokens_wanted double, short boolean, tokens_in_shares double"
    rows = [(s, float(g["share"]), int(g["cap"]), int(g["have"]), float(g["wanted"]), g["aim"] < g["wanted"] * (1 - 1e-12), float(g["whole"])) for s, g in plan.items()]
    report = spark.createDataFrame(rows, kinds).join(F.broadcast(reached), "source", "left").withColumn("tokens_reached", F.coalesce("tokens_reached", F.lit(0)))
    all_tokens = F.sum("tokens_reached").over(Window.partitionBy(F.lit(1)))  # over one row for each source
    report = report.withColumn("share_reached", F.when(all_tokens > 0, F.col("tokens_reached") / all_tokens).otherwise(0.0))
    return copies, report.select("source", "target_share", "max_repeats", "tokens_available", "tokens_wanted", "tokens_reached", "share_reached", "short", "tokens_in_shares")
