"""Requests to models, their replies, and the operators that call a classifier on every row.

A classifier is any function from a list of texts to a list of JSON replies. Offline there are two: keyword rules, and
the replay of recorded replies. Errors become rows with an error, never a failed stage.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from dossierlake.functions.lists import TOPICS, reply_error, reply_id, reply_text
from dossierlake.functions.text import fill_placeholders, strip_fences

MESSAGE = "array<struct<role:string,content:string>>"
REPLY = T.StructType([T.StructField("reply", T.StringType()), T.StructField("error", T.StringType())])


def messages(system: Column | str, user: Column | str, values: dict[str, Column], schema: str | None = None, schema_in: str = "system") -> Column:
    """The messages of a request: templates with placeholders filled, the reply's schema at the end of one of them."""
    tail = F.lit(f"\nReply with JSON of this schema: {schema}" if schema else "")
    s, u = fill_placeholders(system, values), fill_placeholders(user, values)
    if schema_in == "system":
        s = F.concat(s, tail)
    else:
        u = F.concat(u, tail)
    return F.array(F.struct(F.lit("system").alias("role"), s.alias("content")), F.struct(F.lit("user").alias("role"), u.alias("content"))).cast(MESSAGE)


def batch_line(custom_id: Column, parts: Column, model: str, endpoint: str = "/v1/chat/completions") -> Column:
    """One line of a batch file; the body takes 'messages' or 'input', as the endpoint does."""
    field = "messages" if endpoint.endswith("completions") else "input"
    body = F.struct(F.lit(model).alias("model"), parts.alias(field))
    return F.to_json(F.struct(custom_id.cast("string").alias("custom_id"), F.lit("POST").alias("method"), F.lit(endpoint).alias("url"), body.alias("body")))


def read_replies(lines: DataFrame, line: str) -> DataFrame:
    """(id, text, error) of batch result lines in either body shape; a line is never dropped."""
    c = F.col(line)
    return lines.select(reply_id(c).alias("id"), strip_fences(reply_text(c)).alias("text"), reply_error(c).alias("error"))


def topic_labels(text: Column) -> Column:
    """The labels of a reply with topics; an unreadable one has none."""
    return F.coalesce(F.from_json(strip_fences(text), TOPICS)["topic_labels"], F.array().cast("array<struct<topic:string,confidence:int>>"))


def training_example(system: Column | str, user: Column, answer: Column) -> Column:
    """A chat example as JSON, or null where the text or the answer is missing."""
    put = lambda role, c: F.struct(F.lit(role).alias("role"), (F.lit(c) if isinstance(c, str) else c).alias("content"))
    return F.when(user.isNotNull() & answer.isNotNull(), F.to_json(F.struct(F.array(put("system", system), put("user", user), put("assistant", answer)).alias("messages"))))


def keyword_classifier(keywords: dict[str, list[str]]) -> Callable[[list[str]], list[str]]:
    """Topics by keyword counts, as the JSON a model would reply."""

    def classify(texts: list[str]) -> list[str]:
        out = []
        for t in texts:
            low = (t or "").lower()
            out.append(json.dumps({"reasoning": "keywords", "topic_labels": [{"topic": k, "confidence": min(100, 20 * sum(map(low.count, words)))} for k, words in keywords.items()]}))
        return out

    return classify


def call(df: DataFrame, text: str, classifier: Callable[[list[str]], list[str]], tries: int = 3, wait: float = 1.0) -> DataFrame:
    """df with reply and error. A batch that fails is tried again after 1, 2, 4… times the wait, then row by row; a row that fails has its error."""

    def attempt(texts: list[str]) -> list[str]:
        for k in range(tries):
            try:
                found = classifier(texts)
                if len(found) != len(texts):
                    raise ValueError(f"{len(found)} replies to {len(texts)} texts")
                return found
            except Exception:
                if k == tries - 1:
                    raise
                time.sleep(wait * 2**k)
        return []

    @F.pandas_udf(REPLY)
    def ask(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = list(batch)
            try:
                rows = [(r, None) for r in attempt(texts)]
            except Exception:
                rows = []
                for t in texts:
                    try:
                        rows.append((attempt([t])[0], None))
                    except Exception as e:
                        rows.append((None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(rows, columns=["reply", "error"])

    return df.withColumn("_r", ask(text)).select(*df.columns, "_r.reply", "_r.error")


def replay(df: DataFrame, id_col: str, recorded: DataFrame) -> DataFrame:
    """df with the recorded reply and error of its id; ids without a record say so."""
    joined = df.join(recorded.select(F.col("id").alias(id_col), F.col("text").alias("reply"), F.col("error").alias("_e")), id_col, "left")
    return joined.withColumn("error", F.coalesce("_e", F.when(F.col("reply").isNull(), "no record"))).drop("_e")


def patch_errors(results: DataFrame, again: DataFrame, id_col: str) -> DataFrame:
    """Results whose failed rows are replaced by a second run's rows where that has them."""
    failed = results.where("error is not null").select(id_col)
    better = again.join(failed, id_col, "left_semi").where("error is null")
    return results.join(better.select(id_col), id_col, "left_anti").unionByName(better, allowMissingColumns=True)


def chat_fields(df: DataFrame, messages_col: str) -> DataFrame:
    """system, user and assistant contents of chat rows, and the country, year and a preview of 500 characters of the user's text."""
    at = lambda role: F.get(F.filter(F.col(messages_col), lambda m: m["role"] == role), F.lit(0))["content"]
    u = at("user")
    preview = F.when(F.length(u) > 500, F.concat(F.substring(u, 1, 500), F.lit("…"))).otherwise(u)
    field = lambda name: F.nullif(F.trim(F.regexp_extract(u, rf"(?im)^{name}\s*:\s*(.+)$", 1)), F.lit(""))
    return df.withColumns({"system": at("system"), "user": u, "assistant": at("assistant"), "country": field("country"), "year": field("year").try_cast("int"), "preview": preview})
