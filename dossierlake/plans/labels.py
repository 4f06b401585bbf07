"""Queries on labels: verdicts, the final dataset, reconciliation, repair, scores by sector, look-ups by season and year.

Their SQL states the rules a second time, with its own constants; it takes nothing from the functions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from dossierlake.functions import stance, text
from dossierlake.operators import assembly, evaluation as ev, relational as rel, stages
from dossierlake.operators.nested import flatten_records
from dossierlake.plans.oracle import LABEL, LABELLED, PANEL, YEAR
from dossierlake.plans.reference import YEARS, country_errors, labelled, panel
from dossierlake.session import table

c = F.col


def monetary_sheet(spark: SparkSession, d: str) -> DataFrame:
    """The labelled sheet with the parts of its monetary verdict."""
    sheet = table(spark, d, "labelled_monetary_v6")
    wide = sheet.select("row_id", *(c(f"{w}_stance_{t}").alias(f"{w}_{t}") for w in ("staff", "buff") for t in ("current", "future")))
    return stages.stance_parts(wide, "mon", {"current": stance.CURRENT, "future": stance.FUTURE}).join(sheet.select("row_id", "agreement_general", "disagreement_areas"), "row_id")


def general_agreement(spark, d):
    return monetary_sheet(spark, d).select("row_id", stance.general_agreement(c("mon_agreement_current"), c("mon_agreement_future"), c("agreement_general"), c("disagreement_areas"), c("mon_future_num")).alias("verdict"))


def fiscal_agreement(spark, d):
    """The fiscal verdict, with the future stances of training as near-term ones and the areas of df_agree."""
    areas = rel.keep_first(table(spark, d, "df_agree").select("print_isbn", "row_id", "agreement_gpt0", "disagreement_areas_gpt0").where("print_isbn is not null"), ["print_isbn"], [c("row_id")]).drop("row_id")
    wide = table(spark, d, "training").select("row_id", c("staff_stance_future").alias("staff_near_term"), c("buff_stance_future").alias("buff_near_term"))
    parts = stages.stance_parts(wide, "fis", {"near_term": stance.FUTURE}).join(table(spark, d, "training").select("row_id", "print_isbn"), "row_id").join(areas, "print_isbn", "left")
    return parts.select("row_id", stance.fiscal_agreement(c("fis_agreement_near_term"), c("agreement_gpt0"), c("disagreement_areas_gpt0"), c("fis_near_term_num")).alias("verdict"))


def final_dataset(spark, d):
    """The reports of df_meta with monetary labels of df_agree, fiscal ones of the labelled sheet, monetary stances of training and near-term ones of testing."""
    first = lambda name, **columns: rel.keep_first(table(spark, d, name).where("print_isbn is not null").select("print_isbn", "row_id", *(c(old).alias(new) for new, old in columns.items())), ["print_isbn"], [c("row_id")]).drop("row_id")
    base = first("df_meta", year="year_from_title", title="title")
    stances = {f"{w}_{t}": f"{w}_stance_{t}" for w in ("staff", "buff") for t in ("current", "future")}
    near = {f"{w}_near_term": f"{w}_stance_future" for w in ("staff", "buff")}
    monetary = first("df_agree", agreement="agreement_gpt0", disagreement_areas="disagreement_areas_gpt0")
    fiscal = first("labelled_monetary_v6", agreement="agreement_general", disagreement_areas="disagreement_areas")
    full = stages.final_dataset(base, monetary, fiscal, first("training", **stances), first("testing", **near))
    kept = ("mon_agreement_current", "mon_agreement_future", "mon_future_size", "mon_future_direction", "fis_agreement_near_term", "mon_agreement_general", "fis_agreement_general", "policy_mix_staff", "policy_mix_buff", "mon_agreement_general_bin", "fis_agreement_general_bin", "agreement_overall", "disagree_economic")
    return full.select("print_isbn", "year", *kept)


#: Topics of the test documents by keywords, under their long names.
LONG_TOPICS = {"Fiscal Stance": "fiscal", "Monetary Policy": "inflation", "External Stance": "reserves"}


def _scores() -> dict:
    return {n: F.least(F.lit(100), 20 * F.regexp_count(F.lower(F.coalesce("text", F.lit(""))), F.lit(w))) for n, w in LONG_TOPICS.items()}


def topic_best(spark, d):
    """Whether a topic is a document's best and scores 70 or more."""
    flags = stance.topic_dummies(_scores())
    return table(spark, d, "documents").select("doc_id", *(f.alias(text_name) for text_name, f in zip(("fiscal", "monetary", "external"), flags.values())))


def topics_renamed(spark, d):
    """How many documents have each topic, under its short name."""
    long = F.explode(F.array(*(F.when(s > 0, F.lit(n)) for n, s in _scores().items())))
    return table(spark, d, "documents").select(long.alias("t")).where("t is not null").select(stance.recode(c("t"), stance.TOPIC_RENAME).alias("topic")).groupBy("topic").agg(F.count("*").alias("n"))


def side_words(spark, d):
    """The verb of each side's stance; a side without one 'stated'."""
    kinds = F.explode(F.array(F.lit("staff_a"), F.lit("buff"), F.lit("other")))
    rows = table(spark, d, "training").select("row_id", kinds.alias("kind")).withColumn("author", stance.recode(c("kind"), stance.TYPES))
    known = F.create_map(*(F.lit(x) for kv in stance.VERBS.items() for x in kv))
    return rows.select("row_id", "kind", "author", F.coalesce(F.try_element_at(known, c("author")), F.lit("stated")).alias("verb"))


def reconciled_labels(spark, d):
    """One label for reports that two annotators have labelled, null where somebody has to look."""
    names = {"current": "staff_stance_current", "future": "staff_stance_future", "agreement": "agreement_general"}
    t = table(spark, d, "training").where("print_isbn is not null").select("print_isbn", "row_id", *(stance.label(c(n)).alias(f) for f, n in names.items()))
    # the bias of this data is a tendency in the annotators' sheets
    t = t.withColumn("future", F.replace(F.replace("future", F.lit("bias"), F.lit("tendency")), F.lit("no change"), F.lit("neutral")))
    pair = t.groupBy("print_isbn").agg(F.count("*").alias("n"), F.min_by(F.struct(*names), "row_id").alias("a"), F.max_by(F.struct(*names), "row_id").alias("b")).where("n = 2")
    return pair.select("print_isbn", *(stance.reconcile(c(f"a.{f}"), c(f"b.{f}"), f).alias(f) for f in names))


def repaired_labels(spark, d):
    t = labelled(spark, d)
    out = {}
    for w in ("staff", "buff"):
        out[f"{w}_current"], out[f"{w}_future"] = stance.repair(c(f"{w}_current"), c(f"{w}_future"))
    return t.select("row_id", *(x.alias(n) for n, x in out.items()))


def label_validity(spark, d):
    """Labels as they are written that no list of labels has, by field."""
    checks = {"staff_stance_current": stance.CURRENT_LABELS, "staff_stance_future": stance.FUTURE_LABELS, "agreement_general": stance.AGREEMENTS}
    long = F.explode(F.array(*(F.struct(F.lit(n).alias("field"), stance.is_label(c(n), allowed).alias("valid")) for n, allowed in checks.items())))
    return table(spark, d, "training").select(long.alias("x")).select("x.*").groupBy("field").agg(F.count("*").alias("n"), F.count_if(~c("valid")).alias("n_invalid"))


FIELDS = {"current": ("staff_current", "buff_current"), "future": ("staff_future", "buff_future")}


def field_accuracies(spark, d):
    return ev.field_accuracies(labelled(spark, d), FIELDS)


def average_accuracy(spark, d):
    return ev.average_metric(ev.field_accuracies(labelled(spark, d), FIELDS))


def folded_metrics(spark, d):
    """Metrics of the agreement labels after 'irrelevant' is folded into agreement."""
    t = table(spark, d, "df_agree").select(stance.fold_agreement(c("agreement_general")).alias("gold"), stance.fold_agreement(c("agreement_gpt0")).alias("said"))
    return ev.label_metrics(ev.confusion(t, "gold", "said"))


#: The kind of paragraph each source of the test documents stands for.
KINDS = {"staff_report": "staff", "mission_memo": "staff_a", "authorities_views": "buff", "buff_statement": "buff_a"}


def sector_texts(spark, d):
    """The texts of each report by sector, with the fall-back, as a hash and a length of each side."""
    kinds = F.create_map(*(F.lit(x) for kv in KINDS.items() for x in kv))
    docs = table(spark, d, "documents").where("text is not null").withColumn("kind", F.try_element_at(kinds, c("source"))).where("kind is not null")
    counts = {"Fiscal": "fiscal", "Monetary": "inflation", "External": "reserves"}
    scores = {s: F.least(F.lit(100), 20 * F.regexp_count(F.lower("text"), F.lit(w))) for s, w in counts.items()}
    found = assembly.sector_texts(docs, "print_isbn", "kind", "text", "doc_id", scores)
    return found.select("print_isbn", "sector", F.md5("staff").alias("staff"), F.md5("buff").alias("buff"))


def _replies(spark, d):
    """df's labels as the JSON of a reply with scores by sector."""
    body = F.to_json(F.struct(c("mon_diff_num").alias("Agreement_General"), c("mon_diff_num").alias("Agreement_Monetary"), F.when(c("fis_agreement").isNull(), 99).otherwise(1).alias("Agreement_Fiscal"), F.when(c("mon_agreement") == "disagreement exists", F.create_map(F.lit("rates"), F.lit(-2.0))).otherwise(F.create_map().cast("map<string,double>")).alias("Monetary Sector")))
    rows = table(spark, d, "df").select("row_id", text.read_year(c("year")).alias("year"), F.concat(F.lit("```json\n"), body, F.lit("\n```")).alias("reply"))
    return rows.select("row_id", "year", *(x.alias(n) for n, x in assembly.sector_scores(c("reply")).items()))


def sector_scores(spark, d):
    return _replies(spark, d).select("row_id", "general", c("Monetary").alias("monetary"), c("Fiscal").alias("fiscal"), F.size("Monetary_areas").alias("n_areas"), c("error").isNotNull().alias("failed"))


def sector_means(spark, d):
    return assembly.scores_by_year(_replies(spark, d), "year", ["general", "Monetary", "Fiscal"])


def score_histogram(spark, d):
    return assembly.score_histogram(_replies(spark, d), ["Monetary", "Fiscal"])


def areas_share(spark, d):
    return assembly.share_with_areas(_replies(spark, d), {"monetary": c("Monetary_areas"), "fiscal": c("Fiscal_areas")})


def season_lookup(spark, d):
    """For rows of testing, how many rows of training their country has in their season, found by the season's name."""
    season = assembly.season_name(c("loaded_at"), F.year("loaded_at"))
    names = [f"{s} {y}" for y in range(2018, 2024) for s in ("Spring", "Fall")]
    wide = table(spark, d, "training").where("country is not null").withColumn("s", season).groupBy("country").pivot("s", names).agg(F.count(F.lit(1)))
    rows = table(spark, d, "testing").select("row_id", "country", season.alias("season"))
    return rel.lookup_wide(rows, wide, ["country"], names, "season", "n_training")


def year_lookup(spark, d):
    """For rows of training, the rows of df of their country and year from wide columns, and the growth on the year before."""
    years = {f"y{y}": y for y in YEARS}
    counts = table(spark, d, "df").where("country is not null").select("country", F.concat(F.lit("y"), text.read_year(c("year"))).alias("y")).groupBy("country").pivot("y", list(years)).agg(F.count(F.lit(1)))
    rows = labelled(spark, d).select("row_id", "country", c("yr").alias("year"))
    found = assembly.lookup_year(rows, counts, "country", "year", years, "n_df")
    return found.select("row_id", "n_df", F.round("d_n_df", 6).alias("growth"))


def first_packages(spark, d):
    return assembly.first_packages(table(spark, d, "articleiv_xml_updated").select("file_id", "package_id"), "package_id", 20)


def unresolved_reports(spark, d):
    return stages.unresolved(table(spark, d, "df_meta"), table(spark, d, "df_agree"), "print_isbn")


def change_lag(spark, d):
    t = rel.lag_of_change(panel(spark, d, "df", "mon_agreement", "n"), "country", "year", "n")
    return t.select("country", "year", "n", "change", "change_lagged")


def average_error(spark, d):
    """The mean over countries of the mean absolute difference."""
    return country_errors(spark, d).agg(F.round(F.avg("mae"), 5).alias("average_mae"), F.count("*").alias("n_countries"))


def missing_countries(spark, d):
    """Countries as df has them that are no name of the reference."""
    names = table(spark, d, "df").where("country is not null").select("country").distinct()
    return rel.missing_from(names, table(spark, d, "country_reference"), ["country"])


def nested_orders(spark, d):
    """Orders as JSON records with their lines in an array, flattened again: the lines with their order's key and their place."""
    lines = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct(c("l_linenumber").alias("line"), c("l_partkey").alias("part"), c("l_quantity").cast("double").alias("quantity"), F.struct(c("l_returnflag").alias("flag")).alias("state")))).alias("lines"))
    records = table(spark, d, "orders").join(lines, c("o_orderkey") == c("l_orderkey"), "left").select("o_orderkey", F.to_json(F.struct(c("o_orderstatus").alias("status"), "lines")).alias("record"))
    schema = T._parse_datatype_string("status string, lines array<struct<line: bigint, part: bigint, quantity: double, state: struct<flag: string>>>")
    flat = flatten_records(records, "o_orderkey", "record", schema)["lines"]
    return flat.select(c("id").alias("o_orderkey"), "parent_key", "pos", c("v_line").alias("line"), c("v_part").alias("part"), c("v_quantity").alias("quantity"), c("`v_state.flag`").alias("flag"))


SCALE = lambda x: f"case {x} when 'tightening' then 5 when 'tightening bias' then 4 when 'no change' then 3 when 'loosening bias' then 2 when 'loosening' then 1 end"
NONE = "('', 'nan', 'n', 'unclear', 'irrelevant')"
FIRST = lambda t, cols: f"(select print_isbn, {cols} from (select *, row_number() over (partition by print_isbn order by row_id) as rn from {t} where print_isbn is not null) where rn = 1)"
NOW = lambda x: f"case {LABEL(x)} when 'moderately tight' then 'restrictive' when 'tightening bias' then 'restrictive' when 'close to neutral' then 'neutral' else {LABEL(x)} end"


def _equal(a: str, b: str) -> str:
    return f"case when {a} is null or {b} is null or {a} in {NONE} or {b} in {NONE} then 'irrelevant' when {a} = {b} then 'mostly agree' else 'disagreement exists' end"


def _near(a: str, b: str) -> str:
    return f"case when {a} is null or {b} is null or {a} in {NONE} or {b} in {NONE} or {SCALE(a)} - {SCALE(b)} is null then 'irrelevant' when abs({SCALE(a)} - {SCALE(b)}) <= 1 then 'mostly agree' else 'disagreement exists' end"


def _monetary(now: str, later: str, diff: str, said: str, areas: str) -> str:
    return f"case when {now} = 'irrelevant' and {later} = 'irrelevant' and ({said} is null or {said} = 'irrelevant') then 'irrelevant' when {now} = 'disagreement exists' then 'disagreement exists' when abs({diff}) > 1 then 'disagreement exists' when {said} = 'disagreement exists' and {areas} is distinct from 'Future Policy Direction' then 'disagreement exists' else 'mostly agree' end"


def _fiscal(near: str, diff: str, said: str, areas: str) -> str:
    return f"case when {near} = 'irrelevant' and ({said} is null or {said} = 'irrelevant') then 'irrelevant' when abs({diff}) > 1 then 'disagreement exists' when {said} = 'disagreement exists' and {areas} is distinct from '[''near-term policy direction'']' then 'disagreement exists' else 'mostly agree' end"


def _final() -> str:
    stances = f"select print_isbn, {NOW('staff_stance_current')} as sc, {NOW('buff_stance_current')} as bc, {LABEL('staff_stance_future')} as sf, {LABEL('buff_stance_future')} as bf from "
    mon = f"(select *, {_equal('sc', 'bc')} as ac, {_near('sf', 'bf')} as af, {SCALE('sf')} - {SCALE('bf')} as fd from ({stances}{FIRST('training', 'staff_stance_current, buff_stance_current, staff_stance_future, buff_stance_future')}))"
    fis = f"(select *, {_near('sn', 'bn')} as an, {SCALE('sn')} - {SCALE('bn')} as nd from (select print_isbn, {LABEL('staff_stance_future')} as sn, {LABEL('buff_stance_future')} as bn from {FIRST('testing', 'staff_stance_future, buff_stance_future')}))"
    way = lambda x, extra: f"case when contains({x}, 'tightening') then 't' when contains({x}, 'loosening') then 'l' when {x} in ('unclear', 'no change'{extra}) then 'n' end"
    bits = lambda x: f"cast(case {x} when 'mostly agree' then 1 when 'disagreement exists' then 0 end as double)"
    names = "'significantly tighter' when fd = 2 then 'tighter' when fd = 1 then 'moderately tighter' when fd = 0 then 'same' when fd = -1 then 'moderately looser' when fd = -2 then 'looser' when fd <= -3 then 'significantly looser' else 'irrelevant'"
    joined = f"select b.print_isbn, b.year_from_title as year, ac, af, an, fd, nd, sf, bf, sn, bn, m.agreement_gpt0 as ma, m.disagreement_areas_gpt0 as mr, f.agreement_general as fa, f.disagreement_areas as fr from {FIRST('df_meta', 'year_from_title')} b left join {FIRST('df_agree', 'agreement_gpt0, disagreement_areas_gpt0')} m using (print_isbn) left join {FIRST('labelled_monetary_v6', 'agreement_general, disagreement_areas')} f using (print_isbn) left join {mon} using (print_isbn) left join {fis} using (print_isbn)"
    judged = f"select *, {_monetary('ac', 'af', 'fd', 'ma', 'mr')} as mg, {_fiscal('an', 'nd', 'fa', 'fr')} as fg from ({joined})"
    gradual = ", 'gradual normalization'"
    return (
        f"select print_isbn, year, ac as mon_agreement_current, af as mon_agreement_future, case when ac is null then null when abs(fd) >= 3 then 'major difference' when abs(fd) = 2 then 'some difference' when abs(fd) = 1 then 'minor difference' when fd = 0 then 'no difference' else 'irrelevant' end as mon_future_size,"
        f" case when ac is null then null when fd >= 3 then {names} end as mon_future_direction, an as fis_agreement_near_term, mg as mon_agreement_general, fg as fis_agreement_general,"
        f" 'M' || {way('sf', gradual)} || 'F' || {way('sn', '')} as policy_mix_staff, 'M' || {way('bf', gradual)} || 'F' || {way('bn', '')} as policy_mix_buff, {bits('mg')} as mon_agreement_general_bin, {bits('fg')} as fis_agreement_general_bin,"
        f" case when mg = 'mostly agree' and fg = 'mostly agree' then true when mg = 'irrelevant' and fg = 'mostly agree' then true when fg = 'irrelevant' and mg = 'mostly agree' then true else false end as agreement_overall,"
        f" contains(lower(coalesce(mr, '')), 'economic assessment') or contains(lower(coalesce(fr, '')), 'economic assessment') as disagree_economic from ({judged})"
    )


COUNT = lambda w: f"least(100, 20 * len(regexp_extract_all(lower(coalesce(text, '')), '{w}')))"
PAIRED = f"""(select print_isbn, max(cur) filter (rn = 1) as c1, max(cur) filter (rn = 2) as c2, max(fut) filter (rn = 1) as f1, max(fut) filter (rn = 2) as f2, max(agr) filter (rn = 1) as a1, max(agr) filter (rn = 2) as a2 from (
 select print_isbn, {LABEL('staff_stance_current')} as cur, case {LABEL('staff_stance_future')} when 'tightening bias' then 'tightening tendency' when 'loosening bias' then 'loosening tendency' when 'no change' then 'neutral' else {LABEL('staff_stance_future')} end as fut, {LABEL('agreement_general')} as agr,
 row_number() over (partition by print_isbn order by row_id) as rn, count(*) over (partition by print_isbn) as k from training where print_isbn is not null) where k = 2 group by 1)"""
BOTH = lambda a, b, x, y: f"(({a} = '{x}' and {b} = '{y}') or ({a} = '{y}' and {b} = '{x}'))"
ALWAYS = lambda a, b: f"when {a} = {b} then {a} when {BOTH(a, b, 'irrelevant', 'unclear')} then 'unclear' when {BOTH(a, b, 'tightening', 'tightening tendency')} then 'tightening tendency' when {BOTH(a, b, 'loosening', 'loosening tendency')} then 'loosening tendency'"
MENDED = lambda w: f"case when {w}_current not in ('unclear','irrelevant') and {w}_future in ('unclear','irrelevant') then 'neutral' else {w}_future end"
FOLD = lambda x: f"case when {x} = 'irrelevant' then 'unclear' else replace({x}, ' bias', '') end"
HITS = lambda a, b: f"round(avg(case when {a} = {b} then 1.0::double else 0.0::double end), 6)"
ACCURACIES = "(" + " union all ".join(f"select '{f}_accuracy' as metric, {HITS(f'staff_{f}', f'buff_{f}')} as value from {LABELLED} union all select '{f}_accuracy_merge_unclear', {HITS(FOLD(f'staff_{f}'), FOLD(f'buff_{f}'))} from {LABELLED}" for f in ("current", "future")) + ")"
FOLDED = "(select replace(agreement_general, 'irrelevant', 'mostly agree') as g, replace(agreement_gpt0, 'irrelevant', 'mostly agree') as p from df_agree where agreement_general is not null and agreement_gpt0 is not null)"
SEASON = "case when cast(loaded_at as date) > make_date(cast(year(loaded_at) as int), 7, 1) then 'Fall ' else 'Spring ' end || year(loaded_at)"
SCORES = f"(select row_id, {YEAR} as year, mon_diff_num as general, mon_diff_num as monetary, case when fis_agreement is not null then 1.0::double end as fiscal, case when mon_agreement = 'disagreement exists' then 1 else 0 end as n_areas from df)"


def _sector_texts() -> str:
    level = lambda n, least, word: f"select print_isbn, '{n}' as sector, kind, doc_id, text, score >= {least} as sure, score > 0 as anyhit, {word} as word from (select print_isbn, doc_id, text, case source when 'staff_report' then 'staff' when 'mission_memo' then 'staff_a' when 'authorities_views' then 'buff' when 'buff_statement' then 'buff_a' end as kind, {COUNT({'Fiscal': 'fiscal', 'Monetary': 'inflation', 'External': 'reserves'}[n])} as score from documents where text is not null and print_isbn is not null) where kind is not null"
    has = lambda *words: "(" + " or ".join(f"contains(lower(text), '{w}')" for w in words) + ")"
    rows = " union all ".join((level("Fiscal", 70, has("fiscal")), level("Monetary", 50, has("monetary")), level("External", 50, has("external", "current account", "exchange rate", "capital flow", "foreign reserve"))))
    filled = "trim(text, E' \\n\\r\\t\\u00a0\\u2009\\u202f') <> ''"
    body = lambda w, flag: f"coalesce(string_agg(text, E'\\n' order by doc_id) filter (kind = '{w}_a' and {flag} and {filled}), '') || E'\\n' || coalesce(string_agg(text, E'\\n' order by doc_id) filter (kind = '{w}' and {flag} and {filled}), '')"
    levels = ", ".join(f"{body(w, f)} as {w}_{f}" for w in ("staff", "buff") for f in ("sure", "anyhit", "word"))
    pick = lambda w: f"md5(case when {w}_sure <> E'\\n' then {w}_sure when {w}_anyhit <> E'\\n' then {w}_anyhit else {w}_word end) as {w}"
    return f"select print_isbn, sector, {pick('staff')}, {pick('buff')} from (select print_isbn, sector, {levels} from ({rows}) group by 1, 2)"


ORACLE = {
    "general_agreement": f"select row_id, {_monetary('ac', 'af', 'fd', 'said', 'areas')} as verdict from (select row_id, said, areas, {_equal('sc', 'bc')} as ac, {_near('sf', 'bf')} as af, {SCALE('sf')} - {SCALE('bf')} as fd from (select row_id, agreement_general as said, disagreement_areas as areas, {NOW('staff_stance_current')} as sc, {NOW('buff_stance_current')} as bc, {LABEL('staff_stance_future')} as sf, {LABEL('buff_stance_future')} as bf from labelled_monetary_v6))",
    "fiscal_agreement": f"select row_id, {_fiscal('an', 'nd', 'said', 'areas')} as verdict from (select row_id, said, areas, {_near('sn', 'bn')} as an, {SCALE('sn')} - {SCALE('bn')} as nd from (select row_id, agreement_gpt0 as said, disagreement_areas_gpt0 as areas, {LABEL('staff_stance_future')} as sn, {LABEL('buff_stance_future')} as bn from training left join {FIRST('df_agree', 'agreement_gpt0, disagreement_areas_gpt0')} using (print_isbn)))",
    "final_dataset": _final(),
    "topic_best": f"select doc_id, f >= 70 and f >= m and f >= e as fiscal, m >= 70 and m >= f and m >= e as monetary, e >= 70 and e >= f and e >= m as external from (select doc_id, {COUNT('fiscal')} as f, {COUNT('inflation')} as m, {COUNT('reserves')} as e from documents)",
    "topics_renamed": " union all ".join(f"select '{n}' as topic, count(*) as n from documents where contains(lower(text), '{w}')" for n, w in (("Fiscal", "fiscal"), ("Monetary", "inflation"), ("External", "reserves"))),
    "side_words": "select row_id, kind, author, verb from training, (values ('staff_a', 'staff', 'recommended'), ('buff', 'buff', 'planned'), ('other', 'other', 'stated')) v(kind, author, verb)",
    "reconciled_labels": f"select print_isbn, case {ALWAYS('c1', 'c2')} when {BOTH('c1', 'c2', 'neutral', 'unclear')} then 'unclear' when {BOTH('c1', 'c2', 'irrelevant', 'neutral')} then 'irrelevant' end as current, case {ALWAYS('f1', 'f2')} when {BOTH('f1', 'f2', 'neutral', 'unclear')} or {BOTH('f1', 'f2', 'irrelevant', 'neutral')} then 'neutral' end as future, case when a1 = a2 then a1 when {BOTH('a1', 'a2', 'mostly agree', 'unrelated')} then 'mostly agree' end as agreement from {PAIRED}",
    "repaired_labels": "select row_id, " + ", ".join(f"case when {w}_current = 'irrelevant' and {MENDED(w)} not in ('unclear','irrelevant') then 'unclear' else {w}_current end as {w}_current, replace(replace({MENDED(w)}, 'tendency', 'bias'), 'neutral', 'no change') as {w}_future" for w in ("staff", "buff")) + f" from {LABELLED}",
    "label_validity": " union all ".join(f"select '{n}' as field, count(*) as n, count(*) filter ({n} is null or {n} not in ({allowed})) as n_invalid from training" for n, allowed in (("staff_stance_current", "'restrictive','neutral','accommodative','unclear','irrelevant'"), ("staff_stance_future", "'tightening','tightening bias','no change','loosening bias','loosening','unclear','irrelevant'"), ("agreement_general", "'irrelevant','disagreement exists','mostly agree'"))),
    "field_accuracies": f"select * from {ACCURACIES}",
    "average_accuracy": f"select round(avg(value), 5) as average_accuracy from {ACCURACIES}",
    "folded_metrics": f"select label, support, round(p, 6) as precision, round(r, 6) as recall, round(case when p + r > 0 then 2 * p * r / (p + r) else 0 end, 6) as f1 from (select l as label, count(*) filter (g = l) as support, coalesce(count(*) filter (g = l and p = l) / nullif(count(*) filter (p = l), 0), 0) as p, coalesce(count(*) filter (g = l and p = l) / nullif(count(*) filter (g = l), 0), 0) as r from {FOLDED}, (select distinct g as l from {FOLDED} union select p from {FOLDED}) group by l)",
    "sector_texts": _sector_texts(),
    "sector_scores": f"select row_id, general, monetary, fiscal, cast(n_areas as int) as n_areas, general is null as failed from {SCORES}",
    "sector_means": f"select year, round(avg(general), 6) as general, round(avg(monetary), 6) as \"Monetary\", round(avg(fiscal), 6) as \"Fiscal\" from {SCORES} where year is not null group by 1",
    "score_histogram": f"select score, count(*) filter (k = 'm') as \"Monetary\", count(*) filter (k = 'f') as \"Fiscal\" from (select monetary as score, 'm' as k from {SCORES} union all select fiscal, 'f' from {SCORES}) where score is not null group by 1",
    "areas_share": f"select round(avg(n_areas::double), 6) as monetary, 0.0::double as fiscal from {SCORES}",
    "season_lookup": f"select row_id, country, season, n as n_training from (select row_id, country, {SEASON} as season from testing) left join (select country, {SEASON} as season, count(*) as n from training where country is not null group by 1, 2) using (country, season)",
    "year_lookup": f"with w as (select country, {YEAR} as y, count(*) as n from df where country is not null and {YEAR} between 2010 and 2024 group by 1, 2) select row_id, a.n as n_df, round(a.n / b.n - 1, 6) as growth from (select row_id, country, {YEAR} as y from training) t left join w a on a.country = t.country and a.y = t.y left join w b on b.country = a.country and b.y = a.y - 1",
    "first_packages": "select file_id, package_id from articleiv_xml_updated where package_id in (select distinct package_id from articleiv_xml_updated where package_id is not null order by 1 limit 20)",
    "change_lag": f"with p as {PANEL('df', 'mon_agreement')} select a.country, a.year, a.n, a.n - b.n as change, b.n - e.n as change_lagged from p a left join p b on b.country = a.country and b.year = a.year - 1 left join p e on e.country = b.country and e.year = b.year - 1",
    "average_error": f"select round(avg(m), 5) as average_mae, count(*) as n_countries from (select country, avg(abs(fut_diff)) as m from {LABELLED} where country is not null and fut_diff is not null group by 1)",
    "missing_countries": "select distinct country from df where country is not null except select country from country_reference",
    "nested_orders": "select l_orderkey as o_orderkey, cast(l_orderkey as varchar) as parent_key, cast(row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_quantity, l_returnflag) as int) as pos, cast(l_linenumber as bigint) as line, cast(l_partkey as bigint) as part, cast(l_quantity as double) as quantity, l_returnflag as flag from lineitem where l_orderkey in (select o_orderkey from orders)",
    "unresolved_reports": "select print_isbn, case when a and not b then 'missing' else 'unmatched' end as problem from (select print_isbn, max(a) as a, max(b) as b from (select print_isbn, true as a, false as b from df_meta where print_isbn is not null union all select print_isbn, false, true from df_agree where print_isbn is not null) group by 1) where a <> b",
}


def queries() -> dict:
    skip = {"monetary_sheet", "queries", "oracle_sql", "labelled", "table"}
    return {k: f for k, f in globals().items() if callable(f) and getattr(f, "__module__", "") == __name__ and k not in skip and k[0] != "_" and k.islower()}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
