"""Readers and writers. Every reader takes explicit schemas or none at all; nothing is inferred from data."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T


def read_csv(spark: SparkSession, path: str | list[str], schema: T.StructType | str | None = None, source_column: str | None = None) -> DataFrame:
    """CSV with quoted line breaks; without a schema every column is text."""
    reader = spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("mode", "PERMISSIVE")
    df = (reader.schema(schema) if schema else reader).csv(path)
    return df.withColumn(source_column, F.col("_metadata.file_name")) if source_column else df


def read_results(spark: SparkSession, root: str, suffix: str = ".csv", label: str = "disagreement_areas") -> DataFrame:
    """All CSV files below a folder as one table of text, with their name as source_file; rows whose label is an empty list are left out, those without the label stay."""
    files = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", f"*{suffix}").option("header", True).option("multiLine", True).option("escape", '"').csv(root)
    return files.withColumn("source_file", F.col("_metadata.file_name")).where(F.coalesce(F.trim(label) != "[]", F.lit(True)))


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """One JSON value for each line: (line) without a schema; with one, its fields and `broken`, the text of lines that do not parse."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    if schema is None:
        return lines.withColumnRenamed("value", "line")
    kind = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    parsed = lines.select("value", F.from_json("value", kind).alias("v"), F.try_parse_json("value").isNull().alias("bad"))
    return parsed.select(*(F.col(f"v.{f.name}") for f in kind.fields), F.when(F.col("bad"), F.col("value")).alias("broken"))


def read_packages(spark: SparkSession, root: str, suffix: str = ".xml") -> DataFrame:
    """(package_id, path, file, content) of the files with a suffix below a folder; the package is the file's own folder."""
    files = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", f"*{suffix}").text(root, wholetext=True)
    path = F.col("_metadata.file_path")
    return files.select(F.regexp_extract(path, r"([^/]+)/[^/]+$", 1).alias("package_id"), path.alias("path"), F.regexp_extract(path, r"([^/]+)$", 1).alias("file"), F.col("value").alias("content"))


def list_files(spark: SparkSession, root: str, suffix: str = "") -> DataFrame:
    """(path, file, length, modified) of the files with a suffix; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", f"*{suffix}").load(root)
    return files.select("path", F.regexp_extract("path", r"([^/]+)$", 1).alias("file"), "length", F.col("modificationTime").alias("modified"))


def preferred_roots(files: DataFrame, path: str, package: str, roots: list[str], skip: str = r"spr_isr") -> DataFrame:
    """One path for each package: of several roots the later wins; names with the skipped pattern are left out."""
    rank = F.lit(-1)
    for i, r in enumerate(roots):
        rank = F.when(F.contains(F.col(path), F.lit(r)), i).otherwise(rank)
    kept = files.where(~F.col(package).rlike(skip)).withColumn("_rank", rank).where("_rank >= 0")
    return kept.groupBy(package).agg(F.max_by(path, F.struct("_rank", path)).alias(path))


def by_year_in_name(files: DataFrame, file: str, first: int, last: int) -> DataFrame:
    """Files with a year between underscores in their name, within a range."""
    year = F.regexp_extract(file, r"_([0-9]{4})_", 1).try_cast("int")
    return files.withColumn("year", year).where(F.col("year").between(first, last))


def load_prompt(path: str) -> dict[str, str]:
    """The sections of a prompt file: '## name' headings, after optional front matter."""
    with open(path, encoding="utf-8") as f:
        text = re.sub(r"\A---\n.*?\n---\n", "", f.read(), flags=re.S)
    parts = re.split(r"(?m)^##[ \t]*(\w+)[ \t]*$", text)
    return {name.lower(): body.strip() for name, body in zip(parts[1::2], parts[2::2])}


def flat_cell(column: Column, kind: T.DataType) -> Column:
    """A cell fit for CSV: arrays, maps and structs as JSON (maps by key), line breaks spelled out."""
    if isinstance(kind, T.MapType):
        column = F.to_json(F.map_from_entries(F.array_sort(F.map_entries(column))))
    elif isinstance(kind, (T.ArrayType, T.StructType)):
        column = F.to_json(column)
    return F.regexp_replace(F.regexp_replace(column.cast("string"), "\r\n|\r", "\n"), "\n", r"\\n")


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """All cells quoted and flat."""
    df.select(*(flat_cell(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema)).write.mode(mode).option("header", True).option("quoteAll", True).option("escape", '"').csv(path)


def write_jsonl(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).json(path)


def write_lines(df: DataFrame, column: str, path: str, mode: str = "errorifexists") -> None:
    df.select(F.col(column).alias("value")).write.mode(mode).text(path)


def sheet_name(name: str, taken: set[str] = frozenset(), most: int = 31) -> str:
    """A name without the characters sheets refuse, cut to their length, numbered if it is taken."""
    base = re.sub(r"[\[\]:*?/\\]", "_", name).strip() or "sheet"
    out, k = base[:most], 1
    while out.lower() in {t.lower() for t in taken}:
        k += 1
        out = base[: most - len(str(k)) - 1] + f"_{k}"
    return out


def write_workbook(sheets: dict[str, DataFrame], path: str, mode: str = "errorifexists") -> list[str]:
    """Several tables under one folder, one for each sheet; the names they got."""
    names: list[str] = []
    for name, df in sheets.items():
        names.append(sheet_name(name, set(names)))
        df.write.mode(mode).parquet(f"{path}/{names[-1]}")
    return names


def markdown_report(metrics: DataFrame, title: str, most: int = 1000) -> str:
    """A small table of metrics as text."""
    rows = metrics.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"a report of more than {most} rows")
    show = lambda v: "" if v is None else f"{v:.4f}" if isinstance(v, float) else str(v)
    line = lambda cells: "| " + " | ".join(cells) + " |"
    return "\n".join([f"# {title}", "", line(metrics.columns), line(["---"] * len(metrics.columns)), *(line(map(show, r)) for r in rows)]) + "\n"


def read_pdf_pages(spark: SparkSession, root: str) -> DataFrame:
    """(path, page, body) of the pages of PDF files, extracted in the tasks. Needs pypdf."""
    try:
        import pypdf  # noqa: F401
    except ImportError as e:
        raise RuntimeError("reading PDF files needs pypdf") from e
    from collections.abc import Iterator

    import pandas as pd

    def pages(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import io

        import pypdf

        for batch in batches:
            rows = [(p, i + 1, page.extract_text() or "") for p, c in zip(batch["path"], batch["content"]) for i, page in enumerate(pypdf.PdfReader(io.BytesIO(c)).pages)]
            yield pd.DataFrame(rows, columns=["path", "page", "body"])

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.pdf").load(root)
    return files.select("path", "content").mapInPandas(pages, "path string, page int, body string")
