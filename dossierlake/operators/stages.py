"""Stages of the report pipeline, composed of the other operators."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from dossierlake.functions import stance, text
from dossierlake.operators import chat, evaluation as ev, relational as rel

UNAFFECTED = r"does not (?:alter|change)"


def load_metadata(df: DataFrame, isbn: str = "print_isbn", order: str = "row_id", title: str = "title", lists: tuple[str, ...] = ("regions",)) -> DataFrame:
    """One row for each report: keys trimmed, the first row kept, the title cut at its colon, the first entry of list cells taken. Rows without a key are left out."""
    rel.require_columns(df, [isbn, order, title, *lists], "metadata")
    trimmed = df.withColumn(isbn, text.blank_to_null(F.col(isbn))).where(F.col(isbn).isNotNull())
    first = rel.keep_first(trimmed, [isbn], [F.col(order)])
    parts = text.split_title(F.col(title))
    return first.withColumns({"head": parts["title"], "tail": parts["subtitle"], **{f"first_{c}": text.first_of_list(F.col(c)) for c in lists}})


def enrich_metadata(df: DataFrame, reference: DataFrame, title: str = "title") -> DataFrame:
    """Year and kind from the title, and the country its head names in the reference."""
    named = df.withColumns({"name_in_title": text.split_title(F.col(title))["title"], "year_in_title": text.year_in_text(F.col(title)), "is_article_iv": text.mentions_article_iv(F.col(title))})
    return rel.resolve_names(named, "name_in_title", reference, ["country", "country_1"], "ref_id", ["iso3", "income"])


def project_or_null(df: DataFrame, columns: dict[str, str], kind: str = "string") -> DataFrame:
    """The columns under new names; those that df lacks are null."""
    return df.select(*((F.col(c) if c in df.columns else F.lit(None).cast(kind)).alias(name) for c, name in columns.items()))


def drop_unaffected(body: Column, title: Column) -> Column:
    """A statement that says it does not alter the report, and is not titled as a statement, is none."""
    gone = F.coalesce(F.lower(body).rlike(UNAFFECTED), F.lit(False)) & ~F.coalesce(F.lower(title).rlike(r"statement (?:by|on)"), F.lit(False))
    return F.when(~gone, body)


def apply_overrides(df: DataFrame, overrides: dict[str, object], key: str, column: str) -> DataFrame:
    """Values set by hand for single keys."""
    if not overrides:
        return df
    known = F.create_map(*(F.lit(x) for kv in overrides.items() for x in kv))
    return df.withColumn(column, F.coalesce(F.try_element_at(known, F.col(key)), F.col(column)))


def build_documents(parts: DataFrame, files: DataFrame, metadata: DataFrame, overrides: dict[str, object] | None = None) -> DataFrame:
    """One row for each report: its parts over all its files, what is known about it, and whether anything is.

    parts: as from reports.report_parts; files: (file_id, print_isbn, file); metadata: one row for each print_isbn with
    title and year. Of several files with a part, the first by name has it.
    """
    located = parts.join(files, F.col("id") == F.col("file_id"))
    order = F.struct("file", "file_id")
    first = lambda c: F.coalesce(F.min_by(c, F.when(F.size(c) > 0, order)), F.array().cast("array<string>")).alias(c)
    docs = located.groupBy("print_isbn").agg(*(first(c) for c in ("appraisal", "staff", "views", "statement")), F.max("uncertain").alias("av_uncertain"), F.count("*").alias("n_files"))
    joined = rel.with_match_flag(docs, metadata.select("print_isbn", "title", "year"), ["print_isbn"], "metadata_matched")
    body = F.array_join("statement", " ")
    kept = joined.withColumns({"text_buff": drop_unaffected(F.nullif(body, F.lit("")), F.col("title")), "text_staff": F.nullif(F.array_join("staff", "\n\n"), F.lit(""))})
    flagged = kept.withColumns({"buff_verified": F.col("text_buff").isNotNull(), "staff_verified": F.col("text_staff").isNotNull()})
    return apply_overrides(flagged, overrides or {}, "print_isbn", "year")


def sides_long(df: DataFrame, keys: list[str], labels: dict[str, str]) -> DataFrame:
    """(keys…, author, text, labels…): staff and buff rows from wide rows; labels maps a new name to a column's suffix."""
    one = lambda w: df.select(*keys, F.lit(w).alias("author"), F.col(w).alias("text"), *(F.col(f"{w}_{suffix}").alias(n) for n, suffix in labels.items()))
    return one("staff").unionByName(one("buff"))


def refresh_labels(df: DataFrame, fresh: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Labels replaced where a newer table has them; the newest table has one row for each key at most."""
    newer = fresh.select(*keys, *(F.col(c).alias(f"_new_{c}") for c in columns))
    joined = df.join(newer, keys, "left")
    return joined.withColumns({c: F.coalesce(f"_new_{c}", c) for c in columns}).drop(*(f"_new_{c}" for c in columns))


def annotator_differences(df: DataFrame, key: str, annotator: str, labels: list[str]) -> DataFrame:
    """(key, first, second, differs…): every pair of annotators of a record, each once; equal missing labels do not differ."""
    other = df.select(F.col(key), F.col(annotator).alias("second"), *(F.col(c).alias(f"_{c}") for c in labels))
    pairs = df.withColumnRenamed(annotator, "first").join(other, key).where("first < second")
    return pairs.select(key, "first", "second", *((~F.col(c).eqNullSafe(F.col(f"_{c}"))).alias(f"{c}_differs") for c in labels))


def compare_runs(metrics: dict[str, DataFrame], sort_by: str = "accuracy") -> DataFrame:
    """The metrics of several runs, best first."""
    frames = [m.withColumn("run", F.lit(name)) for name, m in metrics.items()]
    every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return every.select("run", *(c for c in every.columns if c != "run")).orderBy(F.desc(sort_by), "run") if sort_by in every.columns else every


def evaluate_grid(df: DataFrame, body: str, gold: str, classifiers: dict[str, Callable[[list[str]], list[str]]], field: str) -> DataFrame:
    """Overall metrics of every classifier on the same rows; replies that fail count as no prediction."""
    runs = {}
    for name, classify in classifiers.items():
        said = chat.call(df, body, classify, tries=1, wait=0.0).withColumn("_said", F.get_json_object("reply", f"$.{field}"))
        runs[name] = ev.overall_metrics(ev.confusion(said, gold, "_said"))
    return compare_runs(runs)


def example_statistics(df: DataFrame, body: str, label: str) -> DataFrame:
    """Per label: rows, and mean, median, least and greatest length of the text; the label 'ALL' stands for the whole set."""
    n = F.char_length(body)
    rows = df.select(F.explode(F.array(F.col(label), F.lit("ALL"))).alias("label"), n.alias("n"))
    return rows.groupBy("label").agg(F.count("*").alias("n"), F.round(F.avg("n"), 6).alias("mean_length"), F.round(F.percentile("n", 0.5), 6).alias("median_length"), F.min("n").alias("min_length"), F.max("n").alias("max_length"))


def verify_results(expected: DataFrame, results: DataFrame, key: str, label: str) -> DataFrame:
    """One row: keys expected, missing, found with an empty label, and their percent."""
    names = expected.select(key).distinct()
    missing = names.join(results.select(key), key, "left_anti").agg(F.count("*").alias("n_missing"))
    empty = F.coalesce(text.clean_text(F.col(label)), F.lit("")).isin("", "[]")
    found = results.agg(F.count("*").alias("n_results"), F.count_if(empty).alias("n_empty"))
    return names.agg(F.count("*").alias("n_expected")).crossJoin(missing).crossJoin(found).withColumn("empty_pct", F.round(F.coalesce(100.0 * F.col("n_empty") / F.nullif("n_results", F.lit(0)), F.lit(0.0)), 6))


def unresolved(expected: DataFrame, results: DataFrame, key: str) -> DataFrame:
    """(key, problem): keys without a result ('missing') and results nobody asked for ('unmatched')."""
    a, b = expected.select(key).where(F.col(key).isNotNull()).distinct(), results.select(key).where(F.col(key).isNotNull()).distinct()
    return a.join(b, key, "left_anti").withColumn("problem", F.lit("missing")).unionByName(b.join(a, key, "left_anti").withColumn("problem", F.lit("unmatched")))


def harmonize_topics(df: DataFrame, label: str, mapping: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(df with topic, labels the mapping lacks): labels are matched without case; mapping: (label, topic), one row for each label."""
    keyed = df.withColumn("_k", text.name_key(F.col(label)))
    known = mapping.select(text.name_key(F.col("label")).alias("_k"), "topic")
    lacking = keyed.where("_k != ''").select("_k").distinct().join(known, "_k", "left_anti").withColumnRenamed("_k", "label")
    return keyed.join(known, "_k", "left").drop("_k"), lacking


def stance_parts(wide: DataFrame, prefix: str, fields: dict[str, dict[str, float]]) -> DataFrame:
    """wide (key, staff_<field>, buff_<field>…) as key and, for each field, both labels, both scores, their difference, its
    two names and the agreement: on the current stance by equality, on others within a step. Missing labels are irrelevant."""
    c, key = F.col, wide.columns[0]
    clean = wide.select(key, *(stance.label(c(f"{w}_{f}")).alias(f"{prefix}_{f}_{w}") for f in fields for w in ("staff", "buff")))
    if "current" in fields:
        clean = clean.withColumns({f"{prefix}_current_{w}": stance.recode(c(f"{prefix}_current_{w}"), stance.CURRENT_FIXES) for w in ("staff", "buff")})
    scored = clean.withColumns({f"{prefix}_{f}_{w}_num": stance.score(c(f"{prefix}_{f}_{w}"), scale) for f, scale in fields.items() for w in ("staff", "buff")})
    diff = scored.withColumns({f"{prefix}_{f}_num": c(f"{prefix}_{f}_staff_num") - c(f"{prefix}_{f}_buff_num") for f in fields})
    both = lambda f: (c(f"{prefix}_{f}_staff"), c(f"{prefix}_{f}_buff"))
    named = {}
    for f, scale in fields.items():
        named[f"{prefix}_agreement_{f}"] = stance.agree(*both(f)) if f == "current" else stance.agree(*both(f), scale, 1)
        named[f"{prefix}_{f}_size"], named[f"{prefix}_{f}_direction"] = stance.size_of_difference(c(f"{prefix}_{f}_num")), stance.direction_of_difference(c(f"{prefix}_{f}_num"))
    return diff.withColumns(named)


def final_dataset(reports: DataFrame, monetary: DataFrame, fiscal: DataFrame, monetary_stances: DataFrame, fiscal_stances: DataFrame, key: str = "print_isbn") -> DataFrame:
    """One row for each report (more if a joined table repeats its key): four left joins by key, verdicts, policy mix and binary labels.

    monetary and fiscal: key, agreement, disagreement_areas. monetary_stances: key and staff_/buff_ current and future;
    fiscal_stances: key and staff_/buff_ near_term. A report without a row in any of them has null parts, which are not
    irrelevant, so its verdicts follow the rule for missing parts.
    """
    c = F.col
    text = lambda df, p: df.select(key, c("agreement").alias(f"{p}_agreement"), c("disagreement_areas").alias(f"{p}_disagreement_areas"))
    cleaned = text(fiscal, "fis").withColumn("fis_agreement", stance.recode(c("fis_agreement"), stance.AGREEMENT_FIXES))
    joined = reports.join(text(monetary, "mon"), key, "left").join(cleaned, key, "left")
    joined = joined.join(stance_parts(monetary_stances, "mon", {"current": stance.CURRENT, "future": stance.FUTURE}), key, "left")
    joined = joined.join(stance_parts(fiscal_stances, "fis", {"near_term": stance.FUTURE}), key, "left")
    judged = joined.withColumns({
        "mon_agreement_general": stance.general_agreement(c("mon_agreement_current"), c("mon_agreement_future"), c("mon_agreement"), c("mon_disagreement_areas"), c("mon_future_num")),
        "fis_agreement_general": stance.fiscal_agreement(c("fis_agreement_near_term"), c("fis_agreement"), c("fis_disagreement_areas"), c("fis_near_term_num")),
        "disagree_economic": stance.disagree_economic(c("mon_disagreement_areas"), c("fis_disagreement_areas")),
        **{f"mon_future_{w}": stance.recode(c(f"mon_future_{w}"), stance.FUTURE_UNCLEAR) for w in ("staff", "buff")},
        **{f"fis_near_term_{w}": stance.recode(c(f"fis_near_term_{w}"), stance.NEAR_TERM_UNCLEAR) for w in ("staff", "buff")},
    })
    mixed = judged.withColumns({f"policy_mix_{w}": stance.policy_mix(c(f"mon_future_{w}"), c(f"fis_near_term_{w}")) for w in ("staff", "buff")})
    binary = mixed.withColumns({f"{n}_bin": stance.binary(c(n)) for n in ("mon_agreement", "fis_agreement", "mon_agreement_general", "fis_agreement_general")})
    return binary.withColumn("agreement_overall", stance.overall(c("mon_agreement_general_bin"), c("fis_agreement_general_bin")))
