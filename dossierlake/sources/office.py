"""Workbooks and word-processor files, which are zipped XML: read in the tasks with the standard library, one row for each row or block."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree as ET
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from dossierlake.session import hadoop_path
from dossierlake.sources.files import sheet_name

ROWS = "path string, sheet string, row_no int, cells array<string>, error string"
BLOCKS = "path string, block_no int, kind string, text string, cells array<array<string>>, error string"
#: Fixed value: rows a sheet can have.
SHEET_ROWS = 1_048_576


def _local(e: ET.Element) -> str:
    return e.tag.rpartition("}")[2]


def _all(e: ET.Element, name: str) -> Iterator[ET.Element]:
    return (x for x in e.iter() if _local(x) == name)


def _text(e: ET.Element) -> str:
    return "".join(x.text or "" for x in _all(e, "t"))


def _column(ref: str) -> int:
    """The column of a reference such as 'AB12', from 0."""
    n = 0
    for c in ref:
        if not c.isalpha():
            break
        n = n * 26 + ord(c.upper()) - 64
    return n - 1


def sheet_rows(data: bytes) -> Iterator[tuple[str, int, list[str | None]]]:
    """(sheet, row number, cells) of a workbook; cells are as stored, empty ones null, rows without cells left out."""
    z = zipfile.ZipFile(io.BytesIO(data))
    names = set(z.namelist())
    shared = [_text(s) for s in ET.fromstring(z.read("xl/sharedStrings.xml")) if _local(s) == "si"] if "xl/sharedStrings.xml" in names else []
    targets = {r.get("Id"): r.get("Target") for r in ET.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
    for s in _all(ET.fromstring(z.read("xl/workbook.xml")), "sheet"):
        target = targets[next(v for k, v in s.attrib.items() if k.endswith("}id"))]
        root = ET.fromstring(z.read(target.lstrip("/") if target.startswith("/") else f"xl/{target}"))
        for i, row in enumerate(_all(root, "row"), 1):
            cells: dict[int, str] = {}
            for at, c in enumerate(x for x in row if _local(x) == "c"):
                value = next((v.text for v in c if _local(v) == "v"), None)
                kind = c.get("t")
                text = shared[int(value)] if kind == "s" and value is not None else _text(c) if kind == "inlineStr" else {"1": "TRUE", "0": "FALSE"}.get(value, value) if kind == "b" else value
                if text is not None:
                    cells[_column(c.get("r")) if c.get("r") else at] = text
            if cells:
                yield s.get("name", ""), int(row.get("r") or i), [cells.get(k) for k in range(max(cells) + 1)]


def document_blocks(data: bytes) -> Iterator[tuple[str, str | None, list[list[str]] | None]]:
    """('p', text, null) and ('table', null, rows) of a word-processor file in order; tables in tables count with the outer one's cell."""
    body = next(_all(ET.fromstring(zipfile.ZipFile(io.BytesIO(data)).read("word/document.xml")), "body"))
    for e in body:
        if _local(e) == "p":
            yield "p", _text(e), None
        elif _local(e) == "tbl":
            yield "table", None, [["\n".join(_text(p) for p in _all(cell, "p")) for cell in row if _local(cell) == "tc"] for row in e if _local(row) == "tr"]


def _files(spark: SparkSession, root: str, suffix: str) -> DataFrame:
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", f"*{suffix}").load(root)
    return files.select("path", "content")


def read_workbooks(spark: SparkSession, root: str, suffix: str = ".xlsx") -> DataFrame:
    """(path, sheet, row_no, cells, error) of all workbooks below a folder; one that cannot be read is a row with its error."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                try:
                    found = [(path, s, n, cells, None) for s, n, cells in sheet_rows(content)]
                except (zipfile.BadZipFile, KeyError, ET.ParseError, StopIteration, IndexError, ValueError) as e:
                    found = [(path, None, None, None, f"{type(e).__name__}: {e}")]
                yield pd.DataFrame(found, columns=["path", "sheet", "row_no", "cells", "error"], dtype=object)

    return _files(spark, root, suffix).mapInPandas(rows, ROWS)


def sheet_table(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Rows of read_workbooks under the given column names, with path, sheet and row_no; the first row of each sheet is its heading, by which cells are found. A column a sheet lacks is null; of repeated headings the last counts."""
    heads = rows.where("error is null").groupBy("path", "sheet").agg(F.min_by(F.struct("row_no", "cells"), "row_no").alias("head"))
    joined = rows.where("error is null").join(heads, ["path", "sheet"]).where(F.col("row_no") > F.col("head.row_no"))

    def cell(name: str):
        last = F.aggregate(F.transform("head.cells", lambda h, i: F.when(F.trim(h) == name, i)), F.lit(-1), lambda acc, i: F.coalesce(i, acc))
        return F.get("cells", F.nullif(last, F.lit(-1))).alias(name)

    return joined.select("path", "sheet", "row_no", *(cell(n) for n in columns))


def read_documents(spark: SparkSession, root: str, suffix: str = ".docx") -> DataFrame:
    """(path, block_no, kind, text, cells, error): paragraphs and tables of word-processor files in order."""

    def blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                try:
                    found = [(path, i, kind, text, cells, None) for i, (kind, text, cells) in enumerate(document_blocks(content), 1)]
                except (zipfile.BadZipFile, KeyError, ET.ParseError, StopIteration) as e:
                    found = [(path, None, None, None, None, f"{type(e).__name__}: {e}")]
                yield pd.DataFrame(found, columns=["path", "block_no", "kind", "text", "cells", "error"], dtype=object)

    return _files(spark, root, suffix).mapInPandas(blocks, BLOCKS)


def _sheet_xml(header: list[str], rows: Iterator[tuple]) -> Iterator[bytes]:
    def line(n: int, values: list) -> bytes:
        cells = []
        for v in values:
            if v is None:
                cells.append("<c/>")
            elif isinstance(v, (int, float)) and not isinstance(v, bool):
                cells.append(f"<c><v>{v!r}</v></c>")
            else:
                bare = re.sub(r"[\x00-\x08\x0b\x0c\x0e-\x1f￾￿]", "", str(v))
                cells.append(f'<c t="inlineStr"><is><t xml:space="preserve">{escape(bare)}</t></is></c>')
        return f'<row r="{n}">{"".join(cells)}</row>'.encode("utf-8", "replace")

    yield b'<?xml version="1.0" encoding="UTF-8"?><worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>' + line(1, header)
    for n, row in enumerate(rows, 2):
        if n > SHEET_ROWS:
            raise ValueError(f"a sheet has {SHEET_ROWS} rows at most; write a table instead")
        yield line(n, list(row))
    yield b"</sheetData></worksheet>"


def write_workbook_file(sheets: dict[str, DataFrame], path: str) -> list[str]:
    """Several tables as the sheets of one workbook, for reports: rows come to the driver a partition at a time, and a table over a sheet's rows is refused. The names the sheets got."""
    names: list[str] = []
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as z:
        for k, (name, df) in enumerate(sheets.items(), 1):
            names.append(sheet_name(name, set(names)))
            with z.open(f"xl/worksheets/sheet{k}.xml", "w") as f:
                for part in _sheet_xml(df.columns, map(tuple, df.toLocalIterator())):
                    f.write(part)
        quoted = {'"': "&quot;"}
        listed = "".join(f'<sheet name="{escape(n, quoted)}" sheetId="{k}" r:id="rId{k}"/>' for k, n in enumerate(names, 1))
        links = "".join(f'<Relationship Id="rId{k}" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/worksheet" Target="worksheets/sheet{k}.xml"/>' for k in range(1, len(names) + 1))
        kinds = "".join(f'<Override PartName="/xl/worksheets/sheet{k}.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>' for k in range(1, len(names) + 1))
        head = '<?xml version="1.0" encoding="UTF-8"?>'
        z.writestr("xl/workbook.xml", f'{head}<workbook xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets>{listed}</sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", f'{head}<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">{links}</Relationships>')
        z.writestr("_rels/.rels", f'{head}<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        z.writestr("[Content_Types].xml", f'{head}<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>{kinds}</Types>')
    if sheets:
        spark = next(iter(sheets.values())).sparkSession
        fs, p = hadoop_path(spark, path)
        out = fs.create(p, True)
        out.write(bytearray(buffer.getvalue()))
        out.close()
    return names
