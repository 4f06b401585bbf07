"""The operators of the report pipeline on the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from dossierlake.functions import lists, stance, text
from dossierlake.operators import aggregate as agg, evaluation as ev, relational as rel
from dossierlake.session import table, text_table

GROUPS = ["AEs", "EMDEs", "LICs"]
YEARS = list(range(2010, 2025))
#: Keywords of the areas of disagreement, monetary and fiscal.
MONETARY_AREAS = {
    "future policy direction": ["future policy direction", "forward guidance", "policy path"],
    "monetary policy operations": ["monetary policy operations", "policy operations"],
    "monetary policy framework": ["monetary policy framework", "policy framework"],
    "current policy stance": ["current policy stance", "policy stance"],
    "central bank communication": ["monetary policy communication", "central bank communication", "communication"],
    "institutions": ["institutions", "independence", "governance"],
    "economic assessment": ["economic assessment"],
    "exchange rate policy": ["exchange rate policy", "exchange rate regime", "exchange rate flexibility"],
    "reserve requirements": ["reserve requirements"],
    "inflation target": ["inflation target"],
}
FISCAL_AREAS = {
    "near-term policy direction": ["near-term", "short term", "frontload", "front-loaded", "immediate", "next year", "this year", "fiscal tightening", "fiscal easing", "pace of"],
    "medium-term fiscal stance": ["medium-term", "medium term", "over the medium term", "fiscal stance", "fiscal adjustment path", "gradual", "consolidation path", "trajectory"],
    "fiscal revenue": ["revenue", "tax", "vat", "gst", "income tax", "corporate tax", "tax base", "tax administration", "collection", "customs"],
    "fiscal expenditure": ["expenditure", "spending", "current spending", "wage bill", "public wage", "subsid", "transfer", "social spending", "pension", "capital spending", "public investment", "infrastructure"],
    "government debt & financing": ["debt", "borrowing", "financing", "rollover", "refinancing", "debt sustainability", "debt dynamics", "gross financing needs", "bond", "issuance"],
    "economic assessment": ["economic outlook", "growth", "inflation", "output gap", "macroeconomic", "baseline", "downside risk", "risk", "shock", "forecast"],
    "fiscal framework": ["fiscal rule", "framework", "mtbf", "medium-term budget framework", "fiscal responsibility", "escape clause", "budget process", "transparency"],
    "political commitment": ["political", "commitment", "ownership", "parliament", "election", "public support", "social consensus", "implementation"],
}
TOPICS = {"fiscal": ["fiscal", "budget", "tax"], "monetary": ["inflation", "policy rate", "central bank"], "external": ["exchange rate", "reserves"]}


def dataset(spark: SparkSession, d: str) -> DataFrame:
    """df with readable group and year."""
    df = rel.require_columns(table(spark, d, "df"), ["classification", "year"], "dataset")
    put = stance.recode(F.upper(text.squash(F.col("classification"))), {"AES": "AEs", "EMDES": "EMDEs", "LICS": "LICs", "LC": "LICs", "LIC": "LICs", "AE": "AEs", "EMDE": "EMDEs"})
    return df.withColumns({"grp": F.when(put.isin(*GROUPS), put), "yr": text.read_year(F.col("year"))})


def labelled(spark: SparkSession, d: str) -> DataFrame:
    """training with clean stance labels and their scores."""
    names = {f"{w}_{t}": stance.label(F.col(f"{w}_stance_{t}")) for w in ("staff", "buff") for t in ("current", "future")}
    t = table(spark, d, "training").select("row_id", "country", text.read_year(F.col("year")).alias("yr"), "agreement_general", "label_source", "loaded_at", *(c.alias(n) for n, c in names.items()))
    scores = {f"{w}_{k}_num": stance.score(F.col(f"{w}_{k}"), s) for w in ("staff", "buff") for k, s in (("current", stance.CURRENT), ("future", stance.FUTURE))}
    return t.withColumns(scores).withColumns({"cur_diff": F.col("staff_current_num") - F.col("buff_current_num"), "fut_diff": F.col("staff_future_num") - F.col("buff_future_num")})


def year_group_counts(spark, d):
    return agg.year_group_counts(dataset(spark, d), "yr", "grp", GROUPS)


def no_disagreement_by_year(spark, d):
    return agg.no_disagreement_by_year(dataset(spark, d), "yr", "grp", "mon_agreement", GROUPS)


def no_disagreement_rollup(spark, d):
    return agg.grouping_rollup(dataset(spark, d), "yr", "grp", "fis_agreement")


def category_percentage_by_year(spark, d):
    cells = table(spark, d, "df_agree").select("year", lists.categories_in(F.col("disagreement_areas_gpt0"), FISCAL_AREAS).alias("areas"))
    return agg.category_percentage_by_year(cells, "year", "areas", list(FISCAL_AREAS))


def area_frequency(spark, d):
    cells = table(spark, d, "df_agree").select("row_id", "year", F.explode(lists.categories_in(F.col("disagreement_areas_gpt0"), FISCAL_AREAS)).alias("area"))
    return agg.share_by(cells, "year", "area", list(FISCAL_AREAS))


def areas_per_row(spark, d):
    """Category counts of cells with two areas or more."""
    cells = table(spark, d, "df_agree").select("row_id", lists.categories_in(F.col("disagreement_areas_gpt0"), FISCAL_AREAS).alias("areas"))
    return cells.where(F.size("areas") >= 2).select("row_id", F.explode("areas").alias("area")).groupBy("area").agg(F.count("*").alias("n"))


def stance_share_by_year(spark, d):
    return agg.share_by(labelled(spark, d), "yr", "staff_current", ["restrictive", "neutral", "accommodative", "unclear"])


def stance_compare_share(spark, d):
    return agg.compare_shares(labelled(spark, d), "yr", "fut_diff")


def stance_agreement(spark, d):
    t = labelled(spark, d)
    return t.select(
        "row_id", stance.size_of_difference(F.col("fut_diff")).alias("size_label"), stance.direction_of_difference(F.col("fut_diff")).alias("direction_label"),
        stance.agree(F.col("staff_current"), F.col("buff_current")).alias("agree_current"), stance.agree(F.col("staff_future"), F.col("buff_future"), stance.FUTURE, 1).alias("agree_future"),
    )


def policy_mix(spark, d):
    t = labelled(spark, d).select("yr", stance.policy_mix(F.col("staff_future"), F.col("buff_future")).alias("mix"))
    return t.groupBy("yr", "mix").agg(F.count("*").alias("n"))


def agreement_overall(spark, d):
    t = table(spark, d, "df").select("row_id", stance.binary(F.col("mon_agreement")).alias("mon"), stance.binary(F.col("fis_agreement")).alias("fis"))
    return t.select("row_id", "mon", "fis", stance.overall(F.col("mon"), F.col("fis")).alias("agreement_overall"))


def stance_wide(spark, d):
    """The first stances there are of each consultation, by author and time, wide."""
    t = table(spark, d, "training").select("row_id", text.present(F.col("country")).alias("c"), text.read_year(F.col("year")).alias("yr"), *(F.lower(text.blank_to_null(F.col(f"{w}_stance_{k}"))).alias(f"{w}_{k}") for w in ("staff", "buff") for k in ("current", "future")))
    sides = F.explode(F.array(*(F.struct(F.lit(name).alias("author"), F.col(f"{w}_current").alias("current"), F.col(f"{w}_future").alias("future")) for w, name in (("staff", "Staff "), ("buff", "Authorities")))))
    long = t.where("c is not null and yr is not null").select("row_id", "c", "yr", sides.alias("s")).select("row_id", "c", "yr", "s.*")
    return agg.pivot_stances(long, ["c", "yr"], "author", ["current", "future"], "row_id", {"Authorities": "buff"})


def agreement_pivot(spark, d):
    docs = table(spark, d, "documents")
    return agg.pivot_text(docs.where(F.col("source").isin("staff_report", "buff_statement")), ["print_isbn", "country", "year"], "source", ["staff_report", "buff_statement"], "text", "doc_id")


def text_by_topic(spark, d):
    conditions = {t: text.has_keywords(F.col("text"), any_of=w) for t, w in TOPICS.items()}
    return agg.text_by_topic(text_table(spark, d, "documents").where("source is not null and print_isbn is not null"), ["print_isbn", "source"], conditions, "text", "doc_id")


def paragraphs(df: DataFrame) -> DataFrame:
    """Paragraphs of both sides over 100 characters, the first of equal ones of a report kept."""
    sides = F.explode(F.array(F.struct(F.lit(0).alias("side_no"), F.lit("buff").alias("kind"), F.col("buff").alias("body")), F.struct(F.lit(1).alias("side_no"), F.lit("staff").alias("kind"), F.col("staff").alias("body"))))
    long = df.select("row_id", "print_isbn", sides.alias("s")).select("row_id", "print_isbn", "s.*")
    parts = long.select("row_id", "print_isbn", "side_no", "kind", F.posexplode(F.split("body", "\n\n")).alias("ord", "paragraph")).where(F.char_length("paragraph") > 100)
    return rel.keep_first(parts, ["print_isbn", "kind", "paragraph"], [F.col("row_id"), F.col("side_no"), F.col("ord")])


def paragraph_explode(spark, d):
    return paragraphs(table(spark, d, "df_documents")).select("row_id", "print_isbn", "kind", "ord", "paragraph")


def topic_wide(spark, d):
    """Keyword confidence per document and topic, wide, with dummies."""
    docs = text_table(spark, d, "documents").where("text is not null")
    hits = F.explode(F.array(*(F.struct(F.lit(t).alias("topic"), F.least(F.lit(100), 20 * sum((F.regexp_count(F.lower("text"), F.lit(w)) for w in words), F.lit(0))).alias("confidence")) for t, words in TOPICS.items())))
    wide = agg.pivot_labels(docs.select("doc_id", hits.alias("h")).select("doc_id", "h.*"), ["doc_id"], "topic", "confidence", list(TOPICS))
    return wide.withColumns({f"{t}_dummy": stance.dummy(F.col(t)) for t in TOPICS}).withColumn("best", F.greatest(*TOPICS))


def incremental_merge(spark, d):
    t = table(spark, d, "training").select("row_id", "print_isbn", "label_source", "loaded_at")
    main = t.where(F.col("label_source") != "pilot_round").drop("loaded_at")
    incoming = t.where(F.col("label_source") == "pilot_round").drop("label_source", "loaded_at")
    return rel.merge_incremental(main, incoming, ["print_isbn"])


def missing_reports(spark, d):
    return rel.missing_from(table(spark, d, "testing").select("row_id", "print_isbn"), table(spark, d, "training"), ["print_isbn"])


def selected_reports(spark, d):
    return rel.present_in(table(spark, d, "df_meta").select("row_id", "print_isbn", "title"), table(spark, d, "df_documents"), ["print_isbn"])


def matched_flag(spark, d):
    meta = table(spark, d, "df_meta").groupBy("print_isbn").agg(F.min("row_id").alias("meta_id"))
    return rel.with_match_flag(table(spark, d, "df_documents").select("row_id", "print_isbn"), meta, ["print_isbn"], "metadata_matched")


def shared_keys(spark, d):
    keys = lambda t: table(spark, d, t).select("print_isbn").where("print_isbn is not null")
    return keys("training").intersect(keys("testing"))


def unshared_keys(spark, d):
    keys = lambda t: table(spark, d, t).select("print_isbn").where("print_isbn is not null")
    return keys("df_meta").subtract(keys("training"))


def overlap_ratio(spark, d):
    return rel.overlap_ratio(table(spark, d, "training"), table(spark, d, "testing"), ["print_isbn"]).select("both", F.round("ratio", 6).alias("ratio"))


def country_resolve(spark, d):
    meta = table(spark, d, "df_meta").select("row_id", text.split_title(F.col("title"))["title"].alias("prefix"))
    return rel.resolve_names(meta, "prefix", table(spark, d, "country_reference"), ["country", "country_1"], "ref_id", ["iso3", "income"])


def title_fields(spark, d):
    t = F.col("title")
    s = text.split_title(t)
    return table(spark, d, "df_meta").select("row_id", s["title"].alias("head"), s["subtitle"].alias("tail"), text.year_in_text(t).alias("title_year"), text.mentions_article_iv(t).alias("is_aiv"), text.first_of_list(F.col("regions")).alias("first_region"), text.looks_like_date(F.col("publication_date")).alias("dated"))


def publication_dates(spark, d):
    return table(spark, d, "df_meta").select("row_id", text.partial_date(F.col("publication_date")).alias("published"))


def regions_joined(spark, d):
    meta = table(spark, d, "df_meta").where("print_isbn is not null")
    return meta.groupBy("series_name").agg(text.join_unique(F.array_sort(F.collect_set("regions"))).alias("regions"), F.count("*").alias("n"))


def fence_recover(spark, d):
    return table(spark, d, "df_agree").select("row_id", lists.recover(F.col("agreement_gpt0"), F.col("error_gpt0"), "agreement").alias("agreement"), text.strip_fences(F.col("error_gpt0")).alias("bare"))


def isbn_numbers(spark, d):
    return table(spark, d, "training").select("row_id", text.isbn_digits(F.col("print_isbn")).alias("isbn"))


def panel(spark, d, name: str, value: str, label: str) -> DataFrame:
    return table(spark, d, name).where("country is not null").select("country", text.read_year(F.col("year")).alias("year"), F.col(value).alias("v")).where("year is not null").groupBy("country", "year").agg(F.count("v").alias(label))


def panel_outer(spark, d):
    return rel.panel_join(panel(spark, d, "df", "mon_agreement", "n_df"), panel(spark, d, "df_agree", "agreement_gpt0", "n_agree"))


def panel_lead(spark, d):
    return rel.panel_join(panel(spark, d, "df", "mon_agreement", "n_now"), panel(spark, d, "df", "mon_agreement", "n_next"), "left", lead=1)


def panel_right(spark, d):
    return rel.panel_join(panel(spark, d, "df", "mon_agreement", "n_df"), panel(spark, d, "training", "agreement_general", "n_training"), "right")


def growth_lag(spark, d):
    t = rel.lag_by_year(panel(spark, d, "df", "mon_agreement", "n"), "country", "year", "n")
    return t.select("country", "year", "n", "lagged", "change", F.round("growth", 6).alias("growth"))


def ever_after(spark, d):
    per = dataset(spark, d).where("country is not null and yr is not null").groupBy("country", "yr").agg(F.max((~F.coalesce(F.col("mon_agreement") != "disagreement exists", F.lit(True))).cast("int")).alias("clash"))
    return rel.ever_and_after(per, "country", "yr", "clash")


def years_until(spark, d):
    here = panel(spark, d, "training", "agreement_general", "n").select("country", "year")
    events = panel(spark, d, "testing", "agreement_general", "n").select("country", F.col("year").alias("event_year"))
    return rel.next_event(here, events, "country", "year", "event_year", 4)


def monthly_mean(spark, d):
    e = table(spark, d, "events").select(F.date_trunc("month", "ts").cast("date").alias("month"), "value")
    return agg.mean_and_deviation(e, ["month"], "value")


def value_summary(spark, d):
    return agg.summary(table(spark, d, "events"), ["event_type"], "value")


def wide_lookup(spark, d):
    """The greatest charge of an order of the kind its least flag names, from wide columns."""
    orders = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.min("l_returnflag").alias("name"), F.max("l_quantity").alias("A"), F.max("l_extendedprice").alias("N"), F.max("l_discount").alias("R"))
    return rel.lookup_wide(orders.select("l_orderkey", "name"), orders.drop("name"), ["l_orderkey"], ["A", "N", "R"], "name", "value")


def within_group_pct(spark, d):
    return agg.share_by(table(spark, d, "events").withColumn("day", F.to_date("ts")), "day", "event_type", ["click", "error", "purchase", "signup", "view"])


def crosstab_margins(spark, d):
    return agg.crosstab(table(spark, d, "df"), "mon_agreement", "fis_agreement")


def crosstab_pct(spark, d):
    return agg.crosstab_pct(table(spark, d, "df"), "mon_agreement", "fis_agreement")


def value_shares(spark, d):
    return agg.value_counts(table(spark, d, "df"), "policy_mix_staff", normalize=True)


def mean_by_year(spark, d):
    t = dataset(spark, d).where("yr is not null")
    return t.groupBy("yr").agg(F.round(F.avg("mon_diff_num"), 6).alias("all_groups"), *(F.round(F.avg(F.when(F.col("grp") == g, F.col("mon_diff_num"))), 6).alias(g) for g in GROUPS))


def category_match(spark, d):
    return ev.category_match(labelled(spark, d), {"current": ("staff_current", "buff_current"), "future": ("staff_future", "buff_future")}, ["yr"])


def overall_match(spark, d):
    t = labelled(spark, d)
    return ev.overall_rate(ev.category_match(t, {"current": ("staff_current", "buff_current"), "future": ("staff_future", "buff_future")}, ["label_source"]), ["label_source"])


def numeric_comparison(spark, d):
    return ev.numeric_comparison(labelled(spark, d), "staff_future_num", "buff_future_num", ["label_source"])


def country_errors(spark, d):
    t = labelled(spark, d).where("country is not null and fut_diff is not null")
    per = t.groupBy("country").agg(F.avg(F.abs("fut_diff")).alias("m"))
    return per.select("country", F.round("m", 6).alias("mae"))


def transitions_top(spark, d):
    return ev.transitions(labelled(spark, d), "staff_future", "buff_future")


def match_matrix(spark, d):
    t = labelled(spark, d).where("country is not null and yr is not null").withColumn("m", (F.col("staff_current") == F.col("buff_current")).cast("double"))
    wide = ev.bottom_matrix(t, "country", "yr", "m", YEARS)
    return wide.select("country", *(F.col(str(y)).alias(f"y{y}") for y in YEARS))


def areas_jaccard(spark, d):
    """How alike the areas of a report are in the two tables, over all its rows."""
    found = lambda name, cell: table(spark, d, name).where("print_isbn is not null").select("print_isbn", F.explode_outer(lists.categories_in(F.col(cell), MONETARY_AREAS)).alias("area")).groupBy("print_isbn").agg(F.collect_set("area").alias(cell))
    joined = found("labelled_monetary_v6", "disagreement_areas").join(found("df_agree", "disagreement_areas_gpt0"), "print_isbn")
    return joined.select("print_isbn", F.round(lists.jaccard(F.col("disagreement_areas"), F.col("disagreement_areas_gpt0")), 6).alias("similarity"))


def confusion_table(spark, d):
    return ev.confusion(table(spark, d, "df_agree"), "agreement_general", "agreement_gpt0")


def label_metrics(spark, d):
    return ev.label_metrics(ev.confusion(table(spark, d, "df_agree"), "agreement_general", "agreement_gpt0"))


def overall_metrics(spark, d):
    return ev.overall_metrics(ev.confusion(table(spark, d, "df_agree"), "agreement_general", "agreement_gpt0"))


def membership_accuracy(spark, d):
    t = table(spark, d, "df_agree").select(F.when(F.col("agreement_general") == "disagreement exists", "fiscal expenditure").alias("gold"), lists.categories_in(F.col("disagreement_areas_gpt0"), FISCAL_AREAS).alias("said"))
    return ev.membership_accuracy(t, "gold", "said")


def first_filled(spark, d):
    meta = table(spark, d, "df_meta").where("print_isbn is not null")
    return agg.first_filled(meta, "print_isbn", ["title", "subtitle", "language"], [F.col("aiv").cast("int"), F.col("row_id")], {"series": "series_name"})


def metadata_counts(spark, d):
    return agg.flag_counts(table(spark, d, "df_meta"), {"n_aiv": F.col("aiv"), "n_no_code": F.col("primary_country_code").isNull(), "n_no_year": F.col("year_from_title").isNull(), "n_blank_subtitle": text.clean_text(F.col("subtitle")) == ""})


def both_annotated(spark, d):
    """Reports with exactly two rows, and the labels of both."""
    t = table(spark, d, "training").where("print_isbn is not null")
    twice = t.groupBy("print_isbn").agg(F.count("*").alias("n")).where("n = 2").select("print_isbn")
    return rel.first_and_second(t.join(twice, "print_isbn", "left_semi"), "print_isbn", [F.col("row_id")], "agreement_general")


def carried_forward(spark, d):
    return rel.carry_forward(panel(spark, d, "df", "mon_agreement", "n"), "country", "year", 2021, 2024)


def latest_per_source(spark, d):
    docs = table(spark, d, "documents").where("source is not null").select("source", "doc_id", "loaded_at")
    return agg.top_per_group(docs, ["source"], [F.desc("loaded_at"), F.col("doc_id")], 3).drop("loaded_at")


def numbered_rows(spark, d):
    return rel.number_rows(table(spark, d, "df").select("row_id", "print_isbn"), [F.col("print_isbn"), F.col("row_id")])


def range_filter(spark, d):
    t = dataset(spark, d)
    return t.where(F.col("yr").between(2015, 2023) & F.col("staff_verified")).select("row_id", "yr", "grp")


def domain_filter(spark, d):
    docs = table(spark, d, "documents")
    return docs.where(text.has_keywords(F.col("text"), any_of=["fiscal"], all_of=["inflation"])).select("doc_id", "source")


def keyword_flags(spark, d):
    docs = text_table(spark, d, "documents").where("text is not null")
    return docs.select("doc_id", *(text.has_keywords(F.col("text"), any_of=w).alias(f"has_{t}") for t, w in TOPICS.items()), text.count_words(F.col("text")).alias("n_words"))


def json_props(spark, d):
    return table(spark, d, "events").select("event_id", F.get_json_object("props", "$.k").cast("bigint").alias("k"))


def chat_requests(spark, d):
    """The prompt of each labelled statement, built by literal replacement."""
    t = table(spark, d, "labelled_monetary_v6")
    prompt = text.fill_placeholders("Country: {COUNTRY}\nYear: {YEAR}\nStatement: {TEXT}", {"COUNTRY": F.col("country"), "YEAR": F.col("year"), "TEXT": text.strip(F.coalesce(F.col("staff"), F.lit("")))})
    return t.select("row_id", F.concat(F.lit("row-"), F.col("row_id").cast("string")).alias("custom_id"), prompt.alias("prompt"))


def experiment_grid(spark, d):
    return rel.grid(spark, domain=["monetary", "fiscal"], task=["agreement", "stance"], variant=["simple", "few_shot"])


def label_order(spark, d):
    t = table(spark, d, "training").select(stance.label(F.col("agreement_general")).alias("label"))
    s = table(spark, d, "testing").select(stance.label(F.col("agreement_general")).alias("label"))
    return ev.same_label_order(t, s, "label").select(F.array_join("left_order", ",").alias("left_order"), F.array_join("right_order", ",").alias("right_order"), "same")


def sampled(spark, d):
    return rel.hash_sample(table(spark, d, "documents").select("doc_id", "source"), "doc_id", 100)


def fold_sizes(spark, d):
    return rel.folds(table(spark, d, "documents").select("doc_id"), "doc_id", 5).groupBy("fold").agg(F.count("*").alias("n"))


def readability(spark, d):
    c = text.complexity(F.col("text"))
    names = ["words", "distinct_words", "sentences", "type_token_ratio", "sentence_length", "flesch_ease", "flesch_grade", "fog", "smog", "automated_index", "coleman_liau"]
    return text_table(spark, d, "documents").where("text is not null").select("doc_id", c.alias("c")).select("doc_id", *(F.col(f"c.{n}") for n in names))


ROWS_ONLY = ("sampled", "fold_sizes", "readability")


def queries() -> dict:
    skip = {"dataset", "labelled", "paragraphs", "panel", "table", "text_table", "queries"}
    return {k: f for k, f in globals().items() if callable(f) and getattr(f, "__module__", "") == __name__ and k not in skip}
