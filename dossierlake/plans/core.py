"""Queries p2 and p5: nested records and packed cells."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from dossierlake.operators.nested import section_tables
from dossierlake.operators.packed import split_packed
from dossierlake.session import table, text_table


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    elements, _ = section_tables(text_table(spark, d, "articleiv_xml_updated"), "file_id", "content", with_text=False)
    return elements.select(F.col("id").alias("file_id"), "kind", "node_no", "parent_sec_no")


def p2_texts(spark: SparkSession, d: str) -> DataFrame:
    """Titles and paragraphs with their texts."""
    elements, _ = section_tables(text_table(spark, d, "articleiv_xml_updated"), "file_id", "content")
    return elements.where("kind != 'sec'").select(F.col("id").alias("file_id"), "kind", "node_no", "parent_sec_no", "pos", "text")


def p2_rejects(spark: SparkSession, d: str) -> DataFrame:
    """Unreadable files and why."""
    _, rejects = section_tables(text_table(spark, d, "articleiv_xml_updated"), "file_id", "content", with_text=False)
    return rejects.select(F.col("id").alias("file_id"), "error")


def packed_cells(spark: SparkSession, d: str) -> DataFrame:
    by_people = table(spark, d, "labelled_monetary_v6").select("row_id", F.col("disagreement_areas").alias("cell"))
    return by_people.unionByName(table(spark, d, "df_agree").select("row_id", F.col("disagreement_areas_gpt0").alias("cell")))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return split_packed(packed_cells(spark, d), "row_id", "cell").select(F.col("id").alias("row_id"), "pos", F.col("value").alias("area"))


def queries() -> dict:
    return {f.__name__: f for f in (p2_found, p2_texts, p2_rejects, p5_found)}
