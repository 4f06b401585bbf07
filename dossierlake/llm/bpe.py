"""Byte-level BPE of whole texts with a public vocabulary, inside the JVM.

A text is cut into words by the tokenizer's pattern. A word's ids come from a fold over its bytes: `aggregate` merges
the adjacent pair with the least rank until none is left, with the ranks in a literal map whose buckets make a lookup
short. The most frequent distinct words of the corpus, a bounded number, are folded once and become a second literal map;
a word that is not in it is folded where it stands, so the result does not depend on that bound. Single words of more than
LONG_WORD bytes, whose fold would be quadratic, are merged by a heap in an Arrow batch; the other words of their texts
are folded as everywhere.

Pieces are kept as hexadecimal strings. Decoding joins the pieces of the ids and reads them as UTF-8.
"""

from __future__ import annotations

import base64
import heapq
import json
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from dossierlake.session import task_slots

TOKENIZERS = "/opt/tokenizers"
#: Fixed value: the pattern that splits text before the merges, in Java's dialect; its alternatives begin with different characters, so their order is that of their frequency.
PATTERN = r"(?U) ?+\p{IsL}++|'(?:s|t|re|ve|m|ll|d)| ?+\p{IsN}++| ?+[^\s\p{IsL}\p{IsN}]++|\s+(?!\S)|\s+"
BUCKETS = 16_384
DICTIONARY = 20_000
DICTIONARY_WORD = 64
LONG_WORD = 256
#: Characters of a plan that are printed and kept, where the session has Spark's own bound.
PLAN_TEXT, UNBOUND = 100_000, "2147483632"


@lru_cache(4)
def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: a line for each piece, in base64, and its rank, which is its id."""
    with open(path, "rb") as f:
        return {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, f)}


def vocabulary_path(name: str = "byte_bpe_50k", folder: str = TOKENIZERS) -> str:
    return f"{folder}/{name}.tiktoken"


def spark_hash(data: bytes, seed: int = 42) -> int:
    """Spark's `hash` of a string: Murmur3 over words of four bytes, the bytes left over one by one as signed numbers."""
    mask, h, n = 0xFFFFFFFF, seed, len(data)
    words = [int.from_bytes(data[i : i + 4], "little") for i in range(0, n - n % 4, 4)]
    for k in words + [x - 256 if x > 127 else x for x in data[n - n % 4 :]]:
        k = (k * 0xCC9E2D51) & mask
        k = (((k << 15) | (k >> 17)) * 0x1B873593) & mask
        h ^= k
        h = (((h << 13) | (h >> 19)) * 5 + 0xE6546B64) & mask
    h ^= n
    h = ((h ^ (h >> 16)) * 0x85EBCA6B) & mask
    h = ((h ^ (h >> 13)) * 0xC2B2AE35) & mask
    h ^= h >> 16
    return h - (1 << 32) if h >> 31 else h


def _bucketed(pairs: dict[str, object], kind: str, buckets: int) -> Column:
    """A literal array of small maps; the bucket of a key is its hash, which Python and Spark compute alike."""
    cells: list[dict] = [{} for _ in range(buckets)]
    for k, v in pairs.items():
        cells[spark_hash(k.encode()) % buckets][k] = v
    return F.from_json(F.lit(json.dumps(cells, separators=(",", ":"))), f"array<map<string,{kind}>>")


def _look_up(maps: Column, key: Column, buckets: int) -> Column:
    return F.try_element_at(F.get(maps, F.pmod(F.hash(key), F.lit(buckets))), key)


def _let(value: Column, body) -> Column:
    """body with value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def fold_word(hexed: Column, ranks: Column, buckets: int = BUCKETS) -> Column:
    """The ids of one word, given as hexadecimal."""
    n = F.length(hexed) / 2
    pieces = F.transform(F.sequence(F.lit(1), n.cast("int")), lambda i: F.substr(hexed, i * 2 - 1, F.lit(2)))
    rank = lambda piece: _look_up(ranks, piece, buckets)

    def step(p: Column, _: Column) -> Column:
        pairs = F.transform(F.slice(p, F.lit(2), F.greatest(F.size(p) - 1, F.lit(0))), lambda x, i: F.concat(F.get(p, i), x))
        at = lambda r: F.array_position(r, F.array_min(r)).cast("int")
        merged = lambda k: F.concat(F.slice(p, F.lit(1), k - 1), F.array(F.concat(F.get(p, k - 1), F.get(p, k))), F.slice(p, k + 2, F.size(p)))
        return _let(F.transform(pairs, rank), lambda r: F.when(F.array_min(r).isNull(), p).otherwise(_let(at(r), merged)))

    done = F.aggregate(F.sequence(F.lit(1), F.greatest(F.size(pieces) - 1, F.lit(1))), pieces, step)
    whole = rank(hexed)
    return F.when(whole.isNotNull(), F.array(whole)).otherwise(F.transform(done, rank))


def heap_merge(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same ids as fold_word, in n log n."""
    n = len(word)
    nxt, prev, end = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
    alive = [True] * n

    def pair(i: int) -> tuple[int, int, int] | None:
        j = nxt[i]
        if j >= n:
            return None
        r = ranks.get(word[i : end[j]])
        return None if r is None else (r, i, end[j])

    heap = [x for i in range(n) if (x := pair(i))]
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        if not alive[i] or nxt[i] >= n or end[nxt[i]] != stop or end[i] == stop:
            continue
        j = nxt[i]
        alive[j], end[i], nxt[i] = False, end[j], nxt[j]
        if nxt[i] < n:
            prev[nxt[i]] = i
        for k in (prev[i], i):
            if k >= 0 and (x := pair(k)):
                heapq.heappush(heap, x)
    return [ranks[word[i : end[i]]] for i in range(n) if alive[i]]


def words_of(text: Column) -> Column:
    """The words of a text, in order; null and empty texts have none."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(PATTERN), F.lit(0))


def frequent_words(words: DataFrame, column: str, most: int = DICTIONARY) -> DataFrame:
    """(word): the most frequent words of the corpus that are short enough for the dictionary, counted over all texts."""
    counted = words.select(F.explode(column).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    return counted.where((F.octet_length("word") <= DICTIONARY_WORD) & (F.col("n") > 1)).orderBy(F.desc("n"), "word").limit(most).select("word")


def encode(df: DataFrame, id_col: str, text: str, path: str | None = None, most: int = DICTIONARY) -> DataFrame:
    """(id, ids): the token ids of every text; an empty list for null and empty texts. Repeated ids and texts stay."""
    spark = df.sparkSession
    if spark.conf.get("spark.sql.maxPlanStringLength", UNBOUND).rstrip("b") == UNBOUND:
        spark.conf.set("spark.sql.maxPlanStringLength", PLAN_TEXT)  # a printed plan would hold the literal maps, and Spark keeps it for every execution
    ranks = read_ranks(path or vocabulary_path())
    rank_map = _bucketed({k.hex().upper(): v for k, v in ranks.items()}, "int", BUCKETS)
    texts = df.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    fold = lambda w, maps: fold_word(F.hex(F.encode(w, "UTF-8")), maps)
    frequent = frequent_words(texts.select(words_of(F.col("text")).alias("words")), "words", most).repartition(task_slots(spark))
    folded = frequent.select("word", _let(rank_map, lambda m: fold(F.col("word"), m)).alias("ids"))
    word_map = _bucketed({r["word"]: r["ids"] for r in folded.collect()}, "array<int>", BUCKETS)  # at most `most` words of DICTIONARY_WORD bytes
    # each literal is named once, so that a plan holds it once; the ranks are bound only where a word has to be folded
    ids_of = lambda w: F.coalesce(_look_up(word_map, w, BUCKETS), _let(rank_map, lambda m: fold(w, m)))
    is_long = lambda w: F.octet_length(w) > LONG_WORD
    any_long = lambda words: F.exists(words, is_long)
    # words are cut once for each text: what holds a long word has null ids here and goes the other way
    here = _let(words_of(F.col("text")), lambda words: F.when(~any_long(words), F.flatten(F.transform(words, ids_of))))
    near = texts.select("id", F.explode(F.array_compact(F.array(here))).alias("ids"))  # a filter would be pushed below and cut the words twice
    shared = spark.sparkContext.broadcast(ranks)

    @F.pandas_udf(T.ArrayType(T.ArrayType(T.IntegerType())))
    def by_heap(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = shared.value
        for batch in batches:
            yield pd.Series([[heap_merge(x, own) if len(x := w.encode()) > LONG_WORD else None for w in words] for words in batch])

    cut = texts.where(F.octet_length("text") > LONG_WORD).select("id", words_of(F.col("text")).alias("words")).where(any_long(F.col("words")))
    far = cut.select("id", F.flatten(F.zip_with("words", by_heap("words"), lambda w, h: F.coalesce(h, ids_of(w)))).alias("ids"))
    return near.unionByName(far)


def decode(ids: Column, path: str | None = None) -> Column:
    """The text of a list of ids."""
    ranks = read_ranks(path or vocabulary_path())
    by_id = {v: k.hex().upper() for k, v in ranks.items()}
    pieces = F.split(F.lit(",".join(by_id[i] for i in range(len(by_id)))), ",")
    return F.decode(F.unhex(F.array_join(F.transform(ids, lambda i: F.get(pieces, i)), "")), "UTF-8")


def message_tokens(df: DataFrame, id_col: str, messages: str, path: str | None = None, per_message: int = 3, reply: int = 3) -> DataFrame:
    """(id, n_tokens, n_answer) for chats, arrays of (role, content): tokens of all roles and contents with a fixed number more for
    each message and for the reply that follows, and tokens of the assistant's contents alone. A null or empty chat has the
    reply's tokens only; null contents have none. Ids must be unique."""
    parts = df.select(F.col(id_col).alias("id"), F.posexplode(messages).alias("no", "m"))
    words = parts.select(F.struct("id", F.lit(False).alias("answer")).alias("k"), F.col("m.role").alias("t")).unionByName(parts.select(F.struct("id", (F.col("m.role") == "assistant").alias("answer")).alias("k"), F.col("m.content").alias("t")))
    sums = encode(words, "k", "t", path).select("id.id", F.size("ids").cast("long").alias("n"), F.col("id.answer").alias("answer"))
    per = sums.groupBy("id").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("answer"), F.col("n")).otherwise(0)).alias("n_answer"))
    chats = df.select(F.col(id_col).alias("id"), F.greatest(F.size(messages), F.lit(0)).alias("n_messages"))
    return chats.join(per, "id", "left").select("id", (F.coalesce("n", F.lit(0)) + per_message * F.col("n_messages") + reply).alias("n_tokens"), F.coalesce("n_answer", F.lit(0)).alias("n_answer"))
