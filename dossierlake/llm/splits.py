"""Splits that keep related records together.

Records that share a key (a report, a consultation) form components. The component table is persisted and grows with
each delivery: a known key brings its component, new keys begin one, and links between components merge them. Merging
works on a graph of components only: every vertex hooks onto its least neighbour, pointer jumping flattens the trees,
and the edges are drawn again between the roots, until none is left.

Splits are given to components. A known component keeps its split; new ones fill what is missing; a component merged
from different splits is quarantined, so that nothing known to one split leaks into another.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from dossierlake.session import cut_lineage

SHARES = {"train": 0.8, "validation": 0.1, "test": 0.1}
QUARANTINE = "quarantine"
#: Components above this share of the new rows are placed one by one; there are at most 1 / GIANT of them.
GIANT = 0.001
#: Smaller components are placed by a hash in so many cells, whose sums are exact.
CELLS = 4096


def connected(edges: DataFrame) -> DataFrame:
    """(vertex, root): the least vertex each vertex is connected to, for edges (u, v) of numbers.

    Hooking and pointer jumping; every round at least halves the vertices that still have edges.
    """
    both = lambda e: e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    e = cut_lineage(edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    roots = both(e).select(F.col("u").alias("vertex")).distinct().withColumn("root", F.col("vertex"))
    while not e.isEmpty():
        parent = cut_lineage(both(e).groupBy("u").agg(F.min("v").alias("p")).where("p < u"))
        while True:
            up = parent.select(F.col("u").alias("p"), F.col("p").alias("q"))
            jumped = cut_lineage(parent.join(up, "p", "left").select("u", F.coalesce("q", "p").alias("p"), F.col("q").isNotNull().alias("moved")))
            parent = jumped.select("u", "p")
            if jumped.where("moved").isEmpty():
                break
        at = lambda c: parent.select(F.col("u").alias(c), F.col("p").alias(c + "_root"))  # noqa: E731, B023
        roots = cut_lineage(roots.join(at("root"), "root", "left").select("vertex", F.coalesce("root_root", "root").alias("root")))
        e = e.join(at("u"), "u", "left").join(at("v"), "v", "left").select(F.coalesce("u_root", "u").alias("u"), F.coalesce("v_root", "v").alias("v"))
        e = cut_lineage(e.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    return roots


def _with_component(rows: DataFrame, keys: list[str], components: DataFrame) -> DataFrame:
    """The rows with their component: by the first key they have; a row without keys is its own."""
    parts, before = [], F.lit(True)
    for k in keys:
        own = rows.where(before & F.col(k).isNotNull())
        parts.append(own.join(components.where(F.col("kind") == k).select(F.col("key").alias(k), "component"), k).select("id", "component"))
        before = before & F.col(k).isNull()
    parts.append(rows.where(before).select("id", F.col("id").alias("component")))
    return reduce(DataFrame.unionByName, parts)


def update_components(df: DataFrame, id_col: str, keys: dict[str, Column], known: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(components, rows, merges) after a delivery df.

    keys: name and expression of each key; null links nothing. known: the components of earlier deliveries as returned
    here, (kind, key, component). components: the same with the new keys; rows: (id, component) of df; merges:
    (component, merged_into) of known components that became part of another. A component's number is the least id in it.
    Repeated ids are allowed, ids must not be null; an empty df changes nothing.
    """
    names = list(keys)
    rows = df.select(F.col(id_col).cast("long").alias("id"), *(e.cast("string").alias(n) for n, e in keys.items()))
    pairs = cut_lineage(rows.groupBy(*names).agg(F.min("id").alias("id")))  # before any join, so that hot keys shrink
    own = reduce(DataFrame.unionByName, (pairs.where(F.col(n).isNotNull()).groupBy(F.lit(n).alias("kind"), F.col(n).alias("key")).agg(F.min("id").alias("least")) for n in names))
    if known is not None:
        own = own.join(known.select("kind", "key", "component"), ["kind", "key"], "left").select("kind", "key", F.coalesce("component", "least").alias("least"))
    own = cut_lineage(own)
    labelled = pairs
    for n in names:
        labelled = labelled.join(own.where(F.col("kind") == n).select(F.col("key").alias(n), F.col("least").alias(n + "_at")), n, "left")
    first = F.coalesce(*(F.col(n + "_at") for n in names))
    edges = reduce(DataFrame.unionByName, (labelled.where(F.col(n + "_at").isNotNull()).select(first.alias("u"), F.col(n + "_at").alias("v")) for n in names))
    roots = connected(edges)
    fresh = own.join(roots, F.col("least") == F.col("vertex"), "left").select("kind", "key", F.coalesce("root", "least").alias("component"))
    if known is None:
        components, merges = cut_lineage(fresh), roots.limit(0).select(F.col("vertex").alias("component"), F.col("root").alias("merged_into"))
    else:
        moved = known.join(roots, F.col("component") == F.col("vertex"), "left").select("kind", "key", F.coalesce("root", "component").alias("component"))
        components = cut_lineage(moved.join(fresh, ["kind", "key"], "left_anti").unionByName(fresh))
        merges = known.select("component").distinct().join(roots.where("root != vertex"), F.col("component") == F.col("vertex")).select("component", F.col("root").alias("merged_into"))
    return components, _with_component(rows, names, components), merges


def store(components: DataFrame, assigned: DataFrame, path: str) -> None:
    """Keep what a later session needs: components (kind, key, component) and what assign_splits returned. A folder for each delivery; one that is there is never replaced."""
    components.select("kind", "key", "component").write.parquet(f"{path}/components")
    assigned.select("component", "split", "n_rows", "n_new").write.parquet(f"{path}/splits")


def load(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(components, splits) as stored, to be the known ones of the next delivery."""
    return spark.read.parquet(f"{path}/components"), spark.read.parquet(f"{path}/splits")


def assign_splits(rows: DataFrame, shares: dict[str, float] = SHARES, known: DataFrame | None = None, merges: DataFrame | None = None, seed: int = 7) -> DataFrame:
    """(component, split, n_rows, n_new): the split of every component.

    rows: (id, component) of the delivery. known: what this returned for earlier deliveries; merges as from
    update_components. Rows with null components are left out; an empty delivery returns what was known.
    """
    sizes = rows.where("component is not null").groupBy("component").agg(F.count("*").alias("n_new"))
    if known is None:
        current = sizes.select("component", F.lit(None).cast("string").alias("split"), F.lit(0).cast("long").alias("before"), "n_new")
    else:
        into = known if merges is None else known.join(merges, "component", "left").withColumn("component", F.coalesce("merged_into", "component"))
        held = into.groupBy("component").agg(F.when(F.min("split") == F.max("split"), F.min("split")).otherwise(F.lit(QUARANTINE)).alias("split"), F.sum("n_rows").alias("before"))
        current = held.join(sizes, "component", "full").select("component", "split", F.coalesce("before", F.lit(0)).alias("before"), F.coalesce("n_new", F.lit(0)).alias("n_new"))
    current = cut_lineage(current.select("component", "split", (F.col("before") + F.col("n_new")).alias("n_rows"), "n_new"))
    held = {r["split"]: r["n"] for r in current.groupBy("split").agg(F.sum("n_rows").alias("n")).collect()}
    fresh = held.pop(None, 0) or 0
    total = sum(n for s, n in held.items() if s != QUARANTINE) + fresh
    missing = {s: share * total - held.get(s, 0) for s, share in shares.items()}
    open_ = current.where("split is null")
    giants: dict[int, str] = {}
    for r in open_.where(F.col("n_rows") > GIANT * max(fresh, 1)).orderBy(F.desc("n_rows"), "component").collect():
        goal = max(missing, key=lambda s: missing[s])
        giants[r["component"]] = goal
        missing[goal] -= r["n_rows"]
    cell = F.pmod(F.xxhash64("component", F.lit(seed)), F.lit(CELLS)).cast("int")
    cells = {r["cell"]: r["n"] for r in open_.where(F.col("n_rows") <= GIANT * max(fresh, 1)).groupBy(cell.alias("cell")).agg(F.sum("n_rows").alias("n")).collect()}
    by_cell: list[str] = []
    for i in range(CELLS):
        goal = max(missing, key=lambda s: missing[s] / shares[s])
        by_cell.append(goal)
        missing[goal] -= cells.get(i, 0)
    giant = F.lit(None).cast("string")
    if giants:
        giant = F.try_element_at(F.create_map(*(F.lit(x) for kv in giants.items() for x in kv)), F.col("component"))
    small = F.element_at(F.split(F.lit(",".join(by_cell)), ","), cell + 1)
    return current.select("component", F.coalesce("split", giant, small).alias("split"), "n_rows", "n_new")


def split_report(splits: DataFrame, shares: dict[str, float] = SHARES) -> DataFrame:
    """(split, n_components, n_rows, share, target): the shares reached."""
    total = splits.agg(F.sum("n_rows").alias("all_rows"))
    wanted = F.create_map(*(F.lit(x) for kv in shares.items() for x in kv))
    return (
        splits.groupBy("split").agg(F.count("*").alias("n_components"), F.sum("n_rows").alias("n_rows")).crossJoin(F.broadcast(total))
        .select("split", "n_components", "n_rows", (F.col("n_rows") / F.col("all_rows")).alias("share"), F.coalesce(F.try_element_at(wanted, F.col("split")), F.lit(0.0)).alias("target"))
    )
