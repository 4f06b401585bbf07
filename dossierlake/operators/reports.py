"""Parts and metadata of report files: ordered tree logic, in Arrow batches, one parse for each file."""

from __future__ import annotations

import re
from collections.abc import Iterator
from xml.etree import ElementTree as ET

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from dossierlake.operators.nested import resolve_entities

LEFT_OUT = ("fig", "table-wrap", "table")
APPRAISAL, STATEMENT = re.compile(r"staff\s+app?rai?sal", re.I), re.compile(r"\bstatement\s+(?:by|on)\b", re.I)
VIEWS = re.compile(r"authorit\w*[’']?\s+views?", re.I)
TEXTS = T.ArrayType(T.StringType())
PARTS = T.StructType([T.StructField("appraisal", TEXTS), T.StructField("staff", TEXTS), T.StructField("views", TEXTS), T.StructField("statement", TEXTS), T.StructField("uncertain", T.BooleanType()), T.StructField("error", T.StringType())])
FIELDS = ("root", "title", "subtitle", "document_type", "pub_year", "pub_month", "pub_day", "abstract")
LISTS = ("identifiers", "isbns", "authors", "editors", "subjects", "keywords")
META = T.StructType([*(T.StructField(n, T.StringType()) for n in FIELDS), *(T.StructField(n, TEXTS) for n in LISTS), T.StructField("custom", T.MapType(T.StringType(), TEXTS)), T.StructField("error", T.StringType())])


def local(e: ET.Element) -> str:
    return e.tag.rpartition("}")[2].lower() if isinstance(e.tag, str) else ""


def text_of(e: ET.Element | None) -> str:
    return " ".join("".join(e.itertext()).split()) if e is not None else ""


def children(e: ET.Element, *names: str) -> list[ET.Element]:
    return [c for c in e if local(c) in names]


def walk(e: ET.Element, skip: tuple[str, ...] = ()) -> Iterator[ET.Element]:
    """e and what is in it, in document order, without what is in the skipped elements."""
    stack = [e]
    while stack:
        x = stack.pop()
        if local(x) in skip:
            continue
        yield x
        stack += reversed(list(x))


def find(e: ET.Element, *names: str) -> ET.Element | None:
    return next((x for x in walk(e) if local(x) in names), None)


def parse(content: str | None) -> ET.Element:
    """The root; ET.ParseError for empty and damaged content."""
    return ET.fromstring(resolve_entities((content or "").removeprefix("\ufeff")))


def title_of(sec: ET.Element) -> str:
    own = children(sec, "title")
    return text_of(own[0]) if own else ""


def paragraphs_of(sec: ET.Element) -> list[str]:
    return [t for x in walk(sec, LEFT_OUT) if local(x) == "p" and (t := text_of(x))]


def appraisal(root: ET.Element) -> list[str]:
    """Paragraphs of the first section titled as the staff appraisal, up to the last numbered one if any is numbered."""
    sec = next((s for s in walk(root) if local(s) == "sec" and APPRAISAL.search(title_of(s))), None)
    if sec is None:
        return []
    found = paragraphs_of(sec)
    numbered = [i for i, p in enumerate(found) if p[0].isdigit()]
    return found[: numbered[-1] + 1] if numbered else found


def staff_and_views(root: ET.Element) -> tuple[list[str], list[str], bool]:
    """(staff paragraphs, authorities' views, uncertain) of the sections between the contents and the appraisal.

    Views are: sections whose title names the authorities; paragraphs whose bold lead does, with the one after a lead that
    is only a heading; failing these, the last paragraph of each section, which is uncertain.
    """
    body = find(root, "body")
    staff, views, last = [], [], []
    for sec in children(body if body is not None else root, "sec"):
        if APPRAISAL.search(title_of(sec)):
            break
        if "contents" in title_of(sec).lower():
            continue
        for s in (x for x in walk(sec, LEFT_OUT) if local(x) == "sec"):
            own = [x for c in s if local(c) != "sec" for x in walk(c, (*LEFT_OUT, "sec")) if local(x) == "p" and text_of(x)]
            if "authorit" in title_of(s).lower():
                views += map(text_of, own)
                continue
            take = False
            for p in own:
                bold = text_of(find(p, "bold"))
                whole = bold and len(bold) >= len(text_of(p)) - 1
                if take or (bold.lower().startswith("authorit") and not whole):
                    views.append(text_of(p))
                elif not (whole and VIEWS.search(bold)):
                    staff.append(text_of(p))
                take = bool(whole and VIEWS.search(bold))
            last += [text_of(own[-1])] if own else []
    if views or not last:
        return staff, views, False
    return [p for p in staff if p not in last], last, True


def statement(root: ET.Element) -> list[str]:
    """All body paragraphs of a file titled as a statement; else those after the first paragraph that begins as one."""
    body = find(root, "body")
    found = paragraphs_of(body if body is not None else root)
    if STATEMENT.search(text_of(find(root, "article-title"))):
        return found
    at = next((i for i, p in enumerate(found) if p.lower().startswith("statement by")), None)
    return [] if at is None else found[at + 1 :]


def report_parts(df: DataFrame, id_col: str, content: str) -> DataFrame:
    """(id, appraisal, staff, views, statement, uncertain, error). Unreadable files have empty parts, are uncertain, and say why."""

    @F.pandas_udf(PARTS)
    def take(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for x in batch:
                try:
                    root = parse(x)
                    rows.append((appraisal(root), *(v := staff_and_views(root))[:2], statement(root), v[2], None))
                except ET.ParseError as e:
                    rows.append(([], [], [], [], True, str(e)))
            yield pd.DataFrame(rows, columns=PARTS.fieldNames())

    return df.select(F.col(id_col).alias("id"), take(F.col(content)).alias("x")).select("id", "x.*")


def metadata(root: ET.Element) -> tuple:
    titles = [t for n in ("article-title", "issue-title", "book-title", "title") if (t := text_of(find(root, n)))]
    date = next((d for d in sorted((x for x in walk(root) if local(x) in ("pub-date", "publication-date")), key=lambda d: d.get("pub-type") != "ppub")), None)
    part = lambda n: text_of(find(date, n)) if date is not None else ""
    ids = {f"{x.get('pub-id-type') or x.get('book-id-type') or local(x)}:{text_of(x)}" for x in walk(root) if local(x) in ("article-id", "book-id", "issue-id", "object-id") and text_of(x)}
    people = {"author": [], "editor": []}
    for x in walk(root):
        if local(x) == "contrib" and (name := find(x, "name", "string-name", "collab")) is not None:
            people.setdefault(x.get("contrib-type") or "author", []).append(text_of(name))
    custom: dict[str, list[str]] = {}
    for x in walk(root):
        if local(x) == "custom-meta":
            custom.setdefault(text_of(find(x, "meta-name")).lower(), []).append(text_of(find(x, "meta-value")))
    texts = lambda *n: [t for x in walk(root) if local(x) in n and (t := text_of(x))]
    head, _, tail = (titles[0] if titles else "").partition(":")
    subtitle = text_of(find(root, "subtitle")) or tail.strip()
    kind = root.get("article-type") or text_of(find(root, "document-type")) or None
    month, day = part("month"), part("day")
    return (
        local(root), head.strip() or None, subtitle or None, kind, part("year") or None, month.zfill(2) if month.isdigit() else month or None, day.zfill(2) if day else None, text_of(find(root, "abstract")) or None,
        sorted(ids), texts("isbn"), people["author"], people["editor"], texts("subject"), texts("kwd"), custom, None,
    )


def report_metadata(df: DataFrame, id_col: str, content: str) -> DataFrame:
    """(id, fields…, lists…, custom, error): one record for each file."""

    @F.pandas_udf(META)
    def take(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for x in batch:
                try:
                    rows.append(metadata(parse(x)))
                except ET.ParseError as e:
                    rows.append((*[None] * len(FIELDS), *[[]] * len(LISTS), {}, str(e)))
            yield pd.DataFrame(rows, columns=META.fieldNames())

    return df.select(F.col(id_col).alias("id"), take(F.col(content)).alias("x")).select("id", "x.*")


def file_role(name: Column) -> Column:
    """What a file of a package is, by its name."""
    return (
        F.when(name.rlike(r"(?i)manifest"), "manifest").when(name.rlike(r"(?i)-a[0-9]{3}\b"), "article").when(name.rlike(r"(?i)^A[0-9]{2}_"), "article")
        .when(name.rlike(r"(?i)front"), "front_matter").when(name.rlike(r"(?i)issue"), "issue").when(name.rlike(r"(?i)book"), "book").otherwise("other")
    )


def file_order(name: Column) -> Column:
    """Files of a package in order of importance: struct(rank, number, name)."""
    role = file_role(name)
    rank = F.when(role == "issue", 0).when(role == "book", 1).when(role == "article", 2).when(role == "front_matter", 3).otherwise(4)
    number = F.coalesce(F.nullif(F.regexp_extract(name, r"(?i)(?:-a|^A)([0-9]{2,3})", 1), F.lit("")).cast("int"), F.lit(999))
    return F.struct(rank.alias("rank"), number.alias("number"), name.alias("name"))


def discover_packages(files: DataFrame, package: str, path: str) -> DataFrame:
    """(package, first_path, n_files, other_paths): the least path of each package, the others reported."""
    return files.groupBy(package).agg(F.min(path).alias("first_path"), F.count("*").alias("n_files"), F.array_sort(F.collect_set(path)).alias("paths")).select(package, "first_path", "n_files", F.slice("paths", 2, F.greatest(F.size("paths") - 1, F.lit(1))).alias("other_paths"))


def package_metadata(records: DataFrame, package: str, name: str) -> DataFrame:
    """One row for each package: the first filled field by importance of the file, the lists united in that order, and how many files could be read."""
    order = file_order(F.col(name))
    first = [F.min_by(F.col(c), F.when(F.coalesce(F.col(c), F.lit("")) != "", order)).alias(c) for c in FIELDS]
    united = [F.array_distinct(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct(order.alias("o"), F.col(c).alias("v")))), lambda x: x["v"]))).alias(c) for c in LISTS]
    merged = records.groupBy(package).agg(F.count("*").alias("xml_file_count"), F.count_if(F.col("error").isNull()).alias("parsed_xml_count"), *first, *united)
    status = F.when(F.col("parsed_xml_count") == F.col("xml_file_count"), "ok").when(F.col("parsed_xml_count") > 0, "partial").otherwise("failed")
    return merged.withColumns({"failed_xml_count": F.col("xml_file_count") - F.col("parsed_xml_count"), "parse_status": status})


TITLE_PAGE_END = re.compile(r"^(?:approved|prepared)\b", re.I)
DATE_LINE = re.compile(r"\b(?:(?:19|20)\d{2}|jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)\w*\b.*\b(?:\d{1,2}|(?:19|20)\d{2})\b", re.I)
FRONT = T.StructType([T.StructField("title_lines", TEXTS), T.StructField("board_date", T.StringType())])


def title_page(root: ET.Element) -> list[str]:
    """The lines of the front matter up to the first that approves, prepares or dates the report."""
    front = find(root, "front", "book-front", "titlepage")
    out: list[str] = []
    for x in walk(front if front is not None else root, (*LEFT_OUT, "sec", "abstract")):
        own = " ".join((x.text or "").split())
        if not own:
            continue
        if TITLE_PAGE_END.search(own) or (out and DATE_LINE.fullmatch(own)):
            break
        out.append(own)
    return out


def board_date(root: ET.Element) -> str | None:
    """The first line with a date in a section on key issues or the board's discussion; failing that, of the front matter."""
    for sec in (s for s in walk(root) if local(s) == "sec" and re.search(r"key issues|board|discussion", title_of(s), re.I)):
        for p in paragraphs_of(sec):
            if m := DATE_LINE.search(p):
                return m[0]
    return next((m[0] for x in title_page(root) if (m := DATE_LINE.search(x))), None)


def front_matter(df: DataFrame, id_col: str, content: str) -> DataFrame:
    """(id, title_lines, board_date); unreadable files have no lines and no date."""

    @F.pandas_udf(FRONT)
    def take(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for x in batch:
                try:
                    rows.append((title_page(root := parse(x)), board_date(root)))
                except ET.ParseError:
                    rows.append(([], None))
            yield pd.DataFrame(rows, columns=FRONT.fieldNames())

    return df.select(F.col(id_col).alias("id"), take(F.col(content)).alias("x")).select("id", "x.*")
