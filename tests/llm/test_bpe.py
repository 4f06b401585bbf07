import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from dossierlake.llm import bpe

tiktoken = pytest.importorskip("tiktoken")
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@pytest.fixture(scope="module")
def encoding():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=bpe.read_ranks(bpe.vocabulary_path()), special_tokens={})


def encoded(spark, texts, **kw):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").withColumns({"ids": F.lit("x"), "words": F.lit(1)})
    return {r["id"]: r["ids"] for r in bpe.encode(df, "doc_id", "text", **kw).collect()}


TEXTS = [None, "", " ", "Hello  world's 123 ½ —x!", "tab\tand\n\nlines\r\n", " nbsp  em", "📈 émigré ß 中文 ไทย", "<|endoftext|>", "a" * 3000, " " * 500, "x" * 70 + " y", "they'LL we'll", "aaaa aaaa aaaa", "é"]


def test_ids_match(spark, encoding):
    got = encoded(spark, TEXTS)
    for i, t in enumerate(TEXTS):
        assert got[i] == encoding.encode_ordinary(t or ""), t


def test_dictionary_does_not_matter(spark):
    assert encoded(spark, TEXTS, most=2) == encoded(spark, TEXTS)


def test_empty_table(spark):
    assert bpe.encode(spark.createDataFrame([], "doc_id bigint, text string"), "doc_id", "text").collect() == []


def test_whole_table_and_round_trip(spark, small, encoding):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    ids = bpe.encode(docs, "doc_id", "text")
    rows = ids.join(docs, F.col("id") == F.col("doc_id")).select("id", "ids", "text", bpe.decode(F.col("ids")).alias("back")).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r["ids"] == encoding.encode_ordinary(r["text"] or "") and r["back"] == (r["text"] or "")


@settings(max_examples=200, deadline=None)
@given(st.text(min_size=1, max_size=300))
def test_heap(encoding, text):
    assert bpe.heap_merge(text.encode(), bpe.read_ranks(bpe.vocabulary_path())) == encoding._encode_single_piece(text.encode()) if len(text) else True


def test_hash_is_sparks(spark):
    words = ["", "a", " the", "é", "日本語", "abcd", "abcde", "abcdefg\u00ff", "F0A1", "x" * 63]
    rows = spark.createDataFrame([(w,) for w in words], "w string").select("w", F.hash("w").alias("h")).collect()
    assert {r["w"]: r["h"] for r in rows} == {w: bpe.spark_hash(w.encode()) for w in words}


def test_tokens_of_chats(spark, encoding):
    chats = {1: [("system", "Judge it."), ("user", "Growth  was strong"), ("assistant", "mostly agree")], 2: [("user", None)], 3: [], 4: None}
    df = spark.createDataFrame([(i, m) for i, m in chats.items()], "doc_id bigint, messages array<struct<role:string,content:string>>")
    n = lambda t: len(encoding.encode_ordinary(t or ""))
    want = {i: (sum(3 + n(r) + n(t) for r, t in m or []) + 3, sum(n(t) for r, t in m or [] if r == "assistant")) for i, m in chats.items()}
    assert {r["id"]: (r["n_tokens"], r["n_answer"]) for r in bpe.message_tokens(df, "doc_id", "messages").collect()} == want
