"""The same or nearly the same texts in two sets of records, such as training and evaluation.

Texts are compared as words, without case, punctuation and a leading paragraph number; a word is its 64-bit hash. Two
texts match when fewer than one word in EDITS of the longer is added, dropped or changed. Equal texts are one class, so
copies cost nothing.

Seeds are winnowing fingerprints: of the rolling hashes of GRAM words in every window of WINDOW the least is selected, in
an order that puts rare hashes first (counts over all texts, in a sketch of fixed size). Both texts select the same hash
from a run of GRAM + WINDOW - 1 unchanged words. A text of n words has n / 5 disjoint runs of that length, and a matching
text spoils at most n / 7 of them. So one side looks up only the n / 7 + CHAIN runs with the rarest seeds, and a matching
text shares CHAIN of them at least (fewer only if the text has too few runs), in the same order in both: no match is lost,
while a boilerplate paragraph, however common, is looked up only by texts that hold little else.

Seeds that meet are kept if their shift and the words of the two texts, in a bitmap, allow so few edits. The seeds of a pair
are chained: the longest sequence that rises in both texts, which must have as many seeds as a match shares. From the
chain the texts are extended word by word and aligned in between; where that takes too many edits, both are aligned whole,
so the result does not depend on the chain.

Hashes, selection and bitmaps are computed on whole Arrow batches, and counts for the sketch in the same way.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from dossierlake.session import task_slots, write_shared

GRAM, WINDOW, EDITS, LEAST_WORDS, CHAIN = 4, 2, 8, 12, 3
RUN = GRAM + WINDOW - 1
SKETCH = 1 << 17
SHIFT_CELL = 32
#: An index of lookups of up to this many bytes is broadcast; beyond it, seeds are shuffled to it.
BROADCAST_BYTES, LOOKUP_BYTES = 48 << 20, 96
#: Multipliers of the rolling hash and of its mixing.
ROLL, MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def normal_words(text: Column) -> Column:
    """The words that are compared; null texts have none."""
    bare = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"(?U)^\s*(?:§|¶)?\s*[(\[]?[0-9]{1,3}[.)\]]+\s*", "")
    return F.filter(F.split(bare, r"(?U)[^\p{L}\p{N}\p{M}]+"), lambda w: w != "")


def classes(df: DataFrame, id_col: str, text: str, least_words: int = LEAST_WORDS) -> tuple[DataFrame, DataFrame]:
    """(members, texts): members (id, cls) of the texts long enough; texts (cls, words, n, h1, h2), one row for equal texts, with hashes for words. cls is the least id with the text."""
    words = df.select(F.col(id_col).cast("long").alias("id"), F.transform(normal_words(F.col(text)), lambda w: F.xxhash64(w)).alias("words")).where(F.size("words") >= least_words)
    rows = write_shared(words.select("id", F.xxhash64("words").alias("h1"), F.xxhash64(F.reverse("words"), F.lit(1)).alias("h2"), "words"))
    texts = write_shared(rows.groupBy("h1", "h2").agg(F.min("id").alias("cls"), F.first("words").alias("words")).withColumn("n", F.size("words")))
    members = write_shared(rows.select("id", "h1", "h2").join(texts.select("h1", "h2", "cls"), ["h1", "h2"]).select("id", "cls"))
    return members, texts.select("cls", "words", "n", "h1", "h2")


class Grams:
    """The rolling hashes of a batch of texts, one after the other; those of a text follow each other without gaps."""

    def __init__(self, batch: pa.RecordBatch):
        self.cls = batch.column("cls").to_numpy(zero_copy_only=False)
        words = batch.column("words")
        self.size = np.diff(words.offsets.to_numpy()).astype(np.int64)
        self.words = words.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
        self.begin = np.concatenate(([0], np.cumsum(self.size)[:-1])).astype(np.int64) if len(self.size) else self.size
        self.owner = np.repeat(np.arange(len(self.size)), self.size)
        self.left = (self.begin + self.size)[self.owner] - np.arange(len(self.words))  # words from here to the end of the text
        h = np.zeros(len(self.words), np.uint64)
        for k in range(GRAM):
            h = h * ROLL + np.concatenate((self.words[k:], np.zeros(min(k, len(self.words)), np.uint64)))
        h ^= h >> np.uint64(29)
        h *= MIX
        self.hash = h ^ (h >> np.uint64(32))

    def ranks(self, sketch: np.ndarray) -> np.ndarray:
        """Rare hashes first: the level of a hash in the high bits, the hash below. Positive as a signed number."""
        level = sketch[(self.hash % np.uint64(SKETCH)).astype(np.int64)].astype(np.uint64)
        return ((level << np.uint64(55)) | (self.hash >> np.uint64(9))).astype(np.int64)

    def bitmaps(self) -> tuple[np.ndarray, np.ndarray]:
        """Two numbers for each text, with a bit for each of 128 cells that a word falls into."""
        bit = self.words & np.uint64(127)
        one = np.uint64(1) << (bit & np.uint64(63))
        halves = (np.where(bit < 64, one, np.uint64(0)), np.where(bit >= 64, one, np.uint64(0)))
        return tuple(np.bitwise_or.reduceat(h, self.begin).view(np.int64) if len(self.begin) else np.zeros(0, np.int64) for h in halves)

    def window_least(self, rank: np.ndarray) -> np.ndarray:
        """The least rank of the window that begins at each place; a place too near to a text's end has the greatest number."""
        most = np.iinfo(np.int64).max
        least = rank.copy()
        for k in range(1, WINDOW):
            least = np.minimum(least, np.concatenate((rank[k:], np.full(min(k, len(rank)), most))))
        return np.where(self.left >= RUN, least, most)


def _seed_batch(g: Grams, at: np.ndarray, rank: np.ndarray, place: np.ndarray, names: list[str]) -> pa.RecordBatch:
    """Rows (class, words, rank, place from 1, two bitmaps) for seeds of the texts `at`."""
    b1, b2 = g.bitmaps()
    return pa.RecordBatch.from_arrays([pa.array(g.cls[at]), pa.array(g.size[at].astype(np.int32)), pa.array(rank), pa.array(place.astype(np.int32)), pa.array(b1[at]), pa.array(b2[at])], names)


def _seeds(texts: DataFrame, sketch, pick, names: str) -> DataFrame:
    columns = [c.split()[0] for c in names.split(", ")]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                g = Grams(batch)
                yield _seed_batch(g, *pick(g, g.ranks(sketch.value)), columns)

    return texts.select("cls", "words").mapInArrow(scan, names)


def _winnow(g: Grams, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, rank, place) of the selected hashes of all windows."""
    least = g.window_least(rank)
    chosen = np.zeros(len(rank), bool)
    for k in range(WINDOW):
        chosen[k:] |= (least[: len(rank) - k] == rank[k:]) & (g.owner[: len(rank) - k] == g.owner[k:])
    i = np.flatnonzero(chosen)
    return g.owner[i], rank[i], i - g.begin[g.owner[i]] + 1


def _rarest_runs(g: Grams, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, rank, place) of the n / 7 + CHAIN disjoint runs of each text whose seeds are rarest."""
    least = g.window_least(rank)
    at, place = [], []
    for t, (b, n) in enumerate(zip(g.begin, g.size)):
        runs = b + RUN * np.arange(n // RUN)
        runs = runs[np.argsort(least[runs], kind="stable")[: n // (EDITS - 1) + CHAIN]]
        at.append(np.full(len(runs), t))
        place.append(runs)
    start = np.concatenate(place) if place else np.zeros(0, np.int64)
    best = start.copy()
    for k in range(1, WINDOW):
        best = np.where(rank[np.minimum(start + k, len(rank) - 1)] < rank[best], start + k, best)
    owner = np.concatenate(at) if at else start
    return owner, rank[best], best - g.begin[owner] + 1


def rarity_sketch(texts: DataFrame):
    """A broadcast array of the log2 of how often the hashes of each of SKETCH cells occur in all texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(SKETCH, np.int64)
        for batch in batches:
            g = Grams(batch)
            n += np.bincount((g.hash[g.left >= GRAM] % np.uint64(SKETCH)).astype(np.int64), minlength=SKETCH)
        hit = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(hit.astype(np.int32)), pa.array(n[hit])], ["c", "n"])

    counted = texts.select("cls", "words").mapInArrow(count, "c int, n long").groupBy("c").agg(F.log2(F.sum("n")).cast("int").alias("n")).toPandas()  # SKETCH rows at most
    levels = np.zeros(SKETCH, np.int8)
    levels[counted["c"].to_numpy(np.int64)] = counted["n"].to_numpy(np.int8)
    return texts.sparkSession.sparkContext.broadcast(levels)


def edit_distance(a: list, b: list, most: int) -> int:
    """Words added, dropped or changed between a and b, or most + 1 if more; in a band of that width."""
    lo, hi = 0, 0
    while lo < len(a) and lo < len(b) and a[lo] == b[lo]:
        lo += 1
    while hi < len(a) - lo and hi < len(b) - lo and a[-1 - hi] == b[-1 - hi]:
        hi += 1
    a, b = a[lo : len(a) - hi], b[lo : len(b) - hi]
    far = most + 1
    if abs(len(a) - len(b)) > most:
        return far
    if not a or not b:
        return len(a) + len(b)
    row = [far] * most + list(range(most + 1)) + [far]  # row[k]: distance of a[:i] and b[: i + k - most]
    for i, x in enumerate(a, 1):
        new = [far] * (2 * most + 2)
        for k in range(max(0, most - i), min(2 * most, len(b) - i + most) + 1):
            j = i + k - most
            if not j:
                new[k] = i
            else:
                best = row[k] + (x != b[j - 1])
                if row[k + 1] < best:
                    best = row[k + 1] + 1
                if k and new[k - 1] < best:
                    best = new[k - 1] + 1
                new[k] = best if best < far else far
        if min(new) > most:
            return far
        row = new
    return row[len(b) - len(a) + most]


def chain(seeds: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest sequence of seeds (place in one text, in the other) whose places rise in both."""
    ends: list[int] = []
    last: list[int] = []
    before: list[int] = []
    order = sorted(set(seeds), key=lambda s: (s[0], -s[1]))
    for i, (_, y) in enumerate(order):
        k = bisect_left(ends, y)
        before.append(last[k - 1] if k else -1)
        if k == len(ends):
            ends.append(y)
            last.append(i)
        else:
            ends[k], last[k] = y, i
    out, i = [], last[-1] if last else -1
    while i >= 0:
        out.append(order[i])
        i = before[i]
    return out[::-1]


def align(a: list, b: list, anchors: list[tuple[int, int]], most: int) -> int:
    """Edits between a and b, or most + 1 if more: along the chain, extended word by word, and aligned whole where that way takes too many."""
    i = j = total = 0
    for x, y in anchors:
        x, y = x - 1, y - 1
        if x < i or y < j or a[x] != b[y]:
            continue
        while x > i and y > j and a[x - 1] == b[y - 1]:
            x, y = x - 1, y - 1
        total += edit_distance(a[i:x], b[j:y], most - total)
        if total > most:
            return edit_distance(a, b, most)
        while x < len(a) and y < len(b) and a[x] == b[y]:
            x, y = x + 1, y + 1
        i, j = x, y
    total += edit_distance(a[i:], b[j:], most - total)
    return total if total <= most else edit_distance(a, b, most)


def allowed_edits(longer: Column) -> Column:
    """The greatest number of edits that is fewer than one word in EDITS."""
    return F.ceil(longer / EDITS).cast("int") - 1


def near_classes(left: DataFrame, right: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """(l, r, edits, n_seeds, longer) for the pairs of classes of two sets of texts that match; equal texts with 0 edits.

    left should be the smaller set: its lookups are few. The two sets number their classes on their own; a number may
    stand for different texts in them.
    """
    spark = left.sparkSession
    sketch = rarity_sketch(left.select("cls", "words").unionByName(right.select("cls", "words")))
    most = F.floor(F.col("ln") / (EDITS - 1)).cast("int")
    least = F.greatest(F.lit(1), F.least(F.floor(F.col("ln") / RUN).cast("int"), most + CHAIN) - most)
    looked = write_shared(_seeds(left, sketch, _rarest_runs, "l long, ln int, h long, la int, l1 long, l2 long"))
    seeds_of = lambda t: _seeds(t, sketch, _winnow, "r long, rn int, h long, ra int, r1 long, r2 long")
    unlike = F.bit_count(F.col("l1").bitwiseXOR(F.col("r1"))) + F.bit_count(F.col("l2").bitwiseXOR(F.col("r2")))  # an edit changes two cells at most
    close = (F.abs(F.col("la") - F.col("ra")) <= most + 1) & (F.abs(F.col("ln") - F.col("rn")) <= most + 1) & (unlike <= 2 * allowed_edits(F.greatest("ln", "rn")))
    seeds = seeds_of(right.select("cls", "words").repartition(task_slots(spark)))
    if looked.count() * LOOKUP_BYTES <= broadcast_bytes:
        met = seeds.join(F.broadcast(looked), "h").where(close)
    else:
        cells = F.sequence(F.floor((F.col("la") - most - 1) / SHIFT_CELL), F.floor((F.col("la") + most + 1) / SHIFT_CELL))
        met = seeds.withColumn("cell", F.floor(F.col("ra") / SHIFT_CELL)).join(looked.withColumn("cell", F.explode(cells)), ["h", "cell"]).where(close)
    # a pair has no more seeds than lookups times the places of one hash within the shift: it grows with two texts, not with the corpus
    pairs = met.groupBy("r", "l", "ln", "rn").agg(F.collect_list(F.struct("la", "ra")).alias("seeds"), least.alias("least")).where(F.size("seeds") >= F.col("least"))
    pairs = write_shared(pairs.select("l", "r", "seeds", "least", F.greatest("ln", "rn").alias("longer")))
    lw, rw = left.select(F.col("cls").alias("l"), F.col("words").alias("lw")), right.select(F.col("cls").alias("r"), F.col("words").alias("rw"))

    @F.pandas_udf("edits int, chained int")
    def judge(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for a, b, seeds, least, most in zip(*batch):
                anchors = chain([(s["la"], s["ra"]) for s in seeds])
                rows.append((align(a.tolist(), b.tolist(), anchors, most) if len(anchors) >= least else most + 1, len(anchors)))
            yield pd.DataFrame(rows, columns=["edits", "chained"]).astype("int32")

    wide = pairs.join(rw, "r").join(lw, "l").withColumn("most", allowed_edits(F.col("longer"))).repartition(task_slots(spark))
    judged = wide.select("l", "r", "longer", "most", judge("lw", "rw", "seeds", "least", "most").alias("j"))
    near = judged.where("j.edits > 0 and j.edits <= most").select("l", "r", "j.edits", F.col("j.chained").alias("n_seeds"), "longer")
    equal = left.select("h1", "h2", F.col("cls").alias("l"), F.col("n").alias("longer")).join(right.select("h1", "h2", F.col("cls").alias("r")), ["h1", "h2"])
    return near.unionByName(equal.select("l", "r", F.lit(0).alias("edits"), F.floor(F.col("longer") / RUN).cast("int").alias("n_seeds"), "longer"))


def shared_passages(left: DataFrame, right: DataFrame) -> DataFrame:
    """(l, passage_words): for each class of left, its words in passages that right has somewhere, however long the rest is.

    A passage is a run of selected hashes, each of which some text of right selects too, of CHAIN at least. Linear: the
    hashes of right are made distinct and joined to those of left, and no pair of texts is built. Classes without a
    passage have no row.
    """
    sketch = rarity_sketch(left.select("cls", "words").unionByName(right.select("cls", "words")))
    mine = _seeds(left, sketch, _winnow, "l long, ln int, h long, la int, l1 long, l2 long").select("l", "ln", "h", "la")
    theirs = _seeds(right, sketch, _winnow, "r long, rn int, h long, ra int, r1 long, r2 long").select("h").distinct().withColumn("known", F.lit(True))
    marked = mine.join(theirs, "h", "left").groupBy("l").agg(F.array_sort(F.collect_list(F.struct("la", F.coalesce("known", F.lit(False)).alias("known")))).alias("seeds"))  # grows with one text

    @F.pandas_udf(T.IntegerType())
    def covered(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            out = []
            for seeds in batch:
                total, run = 0, []
                for at, known in [*((s["la"], s["known"]) for s in seeds), (0, False)]:
                    if known:
                        run.append(at)
                        continue
                    if len(run) >= CHAIN:
                        total += run[-1] + GRAM - run[0]
                    run = []
                out.append(total)
            yield pd.Series(out, dtype="int32")

    return marked.select("l", covered("seeds").alias("passage_words")).where("passage_words > 0")


def _keyed(df: DataFrame, id_col: str, key: Column | None) -> DataFrame:
    return df.select(F.col(id_col).cast("long").alias("id"), (key if key is not None else F.lit(None)).cast("string").alias("k"))


def cross_split_pairs(train: DataFrame, test: DataFrame, id_col: str, text: str, key: Column | None = None) -> DataFrame:
    """(train_id, test_id): pairs that share the key or have the same or nearly the same text.

    Null keys and texts under LEAST_WORDS words match nothing; a pair that matches both ways comes once. Empty tables
    give no pairs. For counts without the pairs themselves, see cross_split_coverage.
    """
    m1, t1 = classes(train, id_col, text)
    m2, t2 = classes(test, id_col, text)
    near = near_classes(t2, t1)
    by_text = near.join(m2.select(F.col("id").alias("test_id"), F.col("cls").alias("l")), "l").join(m1.select(F.col("id").alias("train_id"), F.col("cls").alias("r")), "r").select("train_id", "test_id")
    if key is None:
        return by_text.distinct()
    a, b = (_keyed(df, id_col, key).where("k is not null") for df in (train, test))
    return by_text.unionByName(a.select(F.col("id").alias("train_id"), "k").join(b.select(F.col("id").alias("test_id"), "k"), "k").select("train_id", "test_id")).distinct()


def cross_split_coverage(train: DataFrame, test: DataFrame, id_col: str, text: str, key: Column | None = None) -> DataFrame:
    """One row for each row of test: (test_id, n_words, n_pairs, aligned_share, passage_share).

    n_pairs: rows of train with the same or nearly the same text or the same key, as in cross_split_pairs, counted from
    classes and keys, so no pair of rows is built. aligned_share: the share of words that the best match leaves unchanged.
    passage_share: the share of words in passages that train has anywhere. Texts under LEAST_WORDS words have null
    n_words and shares of 0. Ids of train should be unique: repeated ones count as often as they are there.
    """
    m1, t1 = classes(train, id_col, text)
    m2, t2 = classes(test, id_col, text)
    near = write_shared(near_classes(t2, t1))
    k1, k2 = (_keyed(df, id_col, key) for df in (train, test))
    in_class = m1.groupBy("cls").agg(F.count("*").alias("n"))
    by_text = near.join(in_class, near["r"] == in_class["cls"]).groupBy("l").agg(F.sum("n").alias("n_text"), F.max(1 - F.col("edits") / F.col("longer")).alias("aligned_share"))
    by_key = k1.where("k is not null").groupBy("k").agg(F.count("*").alias("n_key"))
    # rows that match both ways are counted once: classes and keys together
    both1 = m1.join(k1.where("k is not null"), "id").groupBy(F.col("cls").alias("r"), "k").agg(F.count("*").alias("n"))
    both2 = m2.join(k2.where("k is not null"), "id").select(F.col("cls").alias("l"), "k").distinct()
    twice = near.select("l", "r").join(both2, "l").join(both1, ["r", "k"]).groupBy("l", "k").agg(F.sum("n").alias("n_both"))
    rows = k2.withColumnRenamed("id", "test_id").join(m2.select(F.col("id").alias("test_id"), F.col("cls").alias("l")).distinct(), "test_id", "left")
    sized = rows.join(t2.select(F.col("cls").alias("l"), F.col("n").alias("n_words")), "l", "left").join(by_text, "l", "left").join(shared_passages(t2, t1), "l", "left").join(by_key, "k", "left").join(twice, ["l", "k"], "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    share = lambda c: F.coalesce(c, F.lit(0.0))
    return sized.select("test_id", "n_words", (zero("n_text") + zero("n_key") - zero("n_both")).alias("n_pairs"), share(F.col("aligned_share")).alias("aligned_share"), share(F.col("passage_words") / F.col("n_words")).alias("passage_share"))
