"""Queries over files, lines, tables and requests; most need Python on document trees, so they have no SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from dossierlake.functions import lists, stance, text
from dossierlake.operators import chat, evaluation as ev, lines, models, reports, stages, tables
from dossierlake.plans.oracle import CLEAN, LABELLED, WS, aliases
from dossierlake.plans.reference import TOPICS, labelled
from dossierlake.session import table, text_table
from dossierlake.streaming.merge import windowed_counts


def xml_files(spark: SparkSession, d: str) -> DataFrame:
    return text_table(spark, d, "articleiv_xml_updated")


def report_parts(spark, d):
    """Staff appraisal, staff report, authorities' views and statement of each file."""
    return reports.report_parts(xml_files(spark, d), "file_id", "content")


def report_paragraphs(spark, d):
    """The parts as paragraphs in order, over 100 characters."""
    parts = report_parts(spark, d)
    kinds = F.explode(F.array(*(F.struct(F.lit(k).alias("kind"), F.col(k).alias("items")) for k in ("statement", "appraisal", "views", "staff"))))
    long = parts.select("id", "uncertain", kinds.alias("k")).select("id", "k.kind", (F.col("uncertain") & (F.col("k.kind") == "views")).alias("uncertain"), F.posexplode("k.items").alias("ord", "paragraph"))
    return long.where(F.char_length("paragraph") > 100)


def report_metadata(spark, d):
    return reports.report_metadata(xml_files(spark, d), "file_id", "content").drop("custom")


def package_metadata(spark, d):
    files = xml_files(spark, d).select("file_id", "package_id", "file")
    records = reports.report_metadata(xml_files(spark, d), "file_id", "content")
    return reports.package_metadata(records.join(files, F.col("id") == F.col("file_id")), "package_id", "file")


def file_roles(spark, d):
    f = xml_files(spark, d)
    order = reports.file_order(F.col("file"))
    return f.select("file_id", "package_id", reports.file_role(F.col("file")).alias("role"), order["rank"].alias("file_rank"), order["number"].alias("number"))


def packages(spark, d):
    return reports.discover_packages(xml_files(spark, d), "package_id", "file").select("package_id", "first_path", "n_files")


def processed_documents(spark, d):
    return lines.process_documents(text_table(spark, d, "df_documents"), "row_id", "staff")


def line_labels(spark, d):
    found = lines.document_lines(text_table(spark, d, "documents"), "doc_id", "text").withColumn("label", lines.line_label(F.col("line")))
    return found.groupBy("label").agg(F.count("*").alias("n"))


def table_cells(spark, d):
    return tables.table_cells(xml_files(spark, d), "file_id", "content")


def table_rules(spark, d):
    return tables.standard_tables(table_cells(spark, d))


def page_range(spark, d):
    """Paragraphs of documents as pages: from the first that mentions risks to four pages on."""
    pages = table(spark, d, "df_documents").select("row_id", F.posexplode(F.split("staff", "\n\n")).alias("page", "body"))
    return tables.page_range(pages, "row_id", "page", "body", "risks are tilted")


def classified(spark, d):
    """Topics of labelled statements by the keyword classifier, read back from its JSON."""
    rows = table(spark, d, "labelled_monetary_v6").select("row_id", "staff")
    replies = chat.call(rows.repartition(8), "staff", chat.keyword_classifier(TOPICS), wait=0.1)
    labels = chat.topic_labels(F.col("reply"))
    return replies.select("row_id", F.explode(labels).alias("l"), "error").select("row_id", "l.topic", "l.confidence", stance.dummy(F.col("l.confidence")).alias("dummy"))


def batch_lines(spark, d):
    t = table(spark, d, "labelled_monetary_v6")
    parts = chat.messages("You read statements.", "{COUNTRY} {YEAR}: {TEXT}", {"COUNTRY": F.col("country"), "YEAR": F.col("year"), "TEXT": text.strip(F.coalesce(F.col("staff"), F.lit("")))}, schema="{agreement: string}")
    return t.select("row_id", chat.batch_line(F.concat(F.lit("row-"), "row_id"), parts, "any").alias("line"))


def batch_replies(spark, d):
    """The cells of df_agree.error_gpt0 as result lines of a batch, read back with errors kept."""
    t = table(spark, d, "df_agree")
    body = F.to_json(F.struct(F.col("row_id").cast("string").alias("custom_id"), F.struct(F.struct(F.array(F.struct(F.struct(F.col("error_gpt0").alias("content")).alias("message"))).alias("choices")).alias("body")).alias("response")))
    return chat.read_replies(t.select(body.alias("line")), "line").withColumn("agreement", F.get_json_object("text", "$.agreement"))


def training_examples(spark, d):
    t = table(spark, d, "training")
    return t.select("row_id", chat.training_example("Judge the agreement.", F.col("staff"), F.col("agreement_general")).alias("example")).where("example is not null")


def example_errors(spark, d):
    t = training_examples(spark, d).select(F.from_json("example", f"messages {chat.MESSAGE}")["messages"].alias("messages"))
    return ev.example_errors(t, "messages")


def topic_shapes(spark, d):
    """Topics of event properties, whatever their shape."""
    return table(spark, d, "events").select("event_id", F.size(lists.topic_map(F.col("props"))).alias("n_topics"))


def daily_counts(spark, d):
    return windowed_counts(table(spark, d, "events"), "ts", "event_type")


def front_matter(spark, d):
    return reports.front_matter(xml_files(spark, d), "file_id", "content")


def enriched_metadata(spark, d):
    loaded = stages.load_metadata(table(spark, d, "df_meta"))
    return stages.enrich_metadata(loaded, table(spark, d, "country_reference")).select("print_isbn", "row_id", "head", "tail", "first_regions", "year_in_title", "is_article_iv", "iso3")


def built_documents(spark, d):
    """One row for each package: parts of its files, metadata, flags."""
    files = xml_files(spark, d).select("file_id", text.isbn_digits(F.col("package_id")).alias("print_isbn"), "file")
    meta = stages.load_metadata(table(spark, d, "df_meta").withColumn("print_isbn", text.isbn_digits(F.col("print_isbn")))).select("print_isbn", "title", F.col("year_from_title").alias("year"))
    docs = stages.build_documents(report_parts(spark, d), files, meta)
    return docs.select("print_isbn", "n_files", "av_uncertain", "metadata_matched", "buff_verified", "staff_verified", "title", "year", F.size("views").alias("n_views"))


def sides_long(spark, d):
    return stages.sides_long(table(spark, d, "training"), ["row_id"], {"stance_current": "stance_current", "stance_future": "stance_future"})


def refreshed_labels(spark, d):
    """Agreement of df_agree, replaced where the labelled sheet has the report."""
    fresh = table(spark, d, "labelled_monetary_v6").where("print_isbn is not null").groupBy("print_isbn").agg(F.min_by("agreement_general", F.when(F.col("agreement_general").isNotNull(), F.col("row_id"))).alias("agreement_general"))
    return stages.refresh_labels(table(spark, d, "df_agree").select("row_id", "print_isbn", "agreement_general"), fresh, ["print_isbn"], ["agreement_general"])


def annotator_differences(spark, d):
    """Pairs of label sources that have judged the same report."""
    t = table(spark, d, "training").where("print_isbn is not null")
    one = t.groupBy("print_isbn", "label_source").agg(F.min_by("agreement_general", "row_id").alias("agreement"))
    return stages.annotator_differences(one, "print_isbn", "label_source", ["agreement"])


def example_statistics(spark, d):
    return stages.example_statistics(table(spark, d, "training").where("staff is not null"), "staff", "agreement_general")


def verified_results(spark, d):
    return stages.verify_results(table(spark, d, "df_meta").where("print_isbn is not null"), table(spark, d, "df_agree"), "print_isbn", "disagreement_areas_gpt0")


def harmonized_topics(spark, d):
    """Sources of documents mapped to topics; the rest stays without."""
    mapping = spark.createDataFrame([("Staff_Report", "report"), ("press_release", "news"), ("mission_memo", "memo")], "label string, topic string")
    return stages.harmonize_topics(table(spark, d, "documents").select("doc_id", "source"), "source", mapping)[0]


def _coefficients(spark, found: dict) -> DataFrame:
    return spark.createDataFrame([(k, round(v, 6)) for k, v in found.items()], "term string, coefficient double")


def linear_model(spark, d):
    return _coefficients(spark, models.least_squares(labelled(spark, d), "staff_future_num", ["buff_future_num"], "yr"))


def panel_model(spark, d):
    return _coefficients(spark, models.fixed_effects(labelled(spark, d), "staff_future_num", ["buff_future_num"], "country"))


def probit_model(spark, d):
    t = labelled(spark, d).withColumn("agrees", stance.binary(F.col("agreement_general")))
    return _coefficients(spark, models.probit(t, "agrees", ["staff_future_num", "buff_future_num"]))


ORACLE = {
    "readability": f"""with t as (select doc_id, lower({CLEAN('text')}) as t from documents where text is not null),
 w as (select doc_id, t, list_filter(regexp_split_to_array(t, '[^\\p{{L}}\\p{{N}}'']+'), lambda x: x <> '') as w from t),
 c as (select doc_id, len(w) as n, len(list_distinct(w)) as d, greatest(len(regexp_extract_all(t, '[.!?]+(?:\\s|$)')), 1) as s, greatest(len(regexp_extract_all(t, '[aeiouyáéíóúàèùâêîôû]+')), 1) as v, len(list_filter(w, lambda x: regexp_matches(x, '[aeiouy]+[^aeiouy]+[aeiouy]+[^aeiouy]+[aeiouy]'))) as h, length(regexp_replace(t, '[^\\p{{L}}\\p{{N}}]+', '', 'g')) as l from w)
 select doc_id, cast(n as int) as words, cast(d as int) as distinct_words, cast(s as int) as sentences, d / nullif(n, 0) as type_token_ratio, n / nullif(s, 0) as sentence_length,
 206.835::double - 1.015::double * (n / s) - 84.6::double * (v / nullif(n, 0)) as flesch_ease, 0.39::double * (n / s) + 11.8::double * (v / nullif(n, 0)) - 15.59::double as flesch_grade,
 0.4::double * (n / s + 100 * (h / nullif(n, 0))) as fog, 1.043::double * sqrt(h * 30 / s) + 3.1291::double as smog, 4.71::double * (l / nullif(n, 0)) + 0.5::double * (n / s) - 21.43::double as automated_index,
 5.88::double * (l / nullif(n, 0)) - 29.6::double * (s / nullif(n, 0)) - 15.8::double as coleman_liau from c""",
    "enriched_metadata": f"""with f as (select *, row_number() over (partition by trim(regexp_replace(print_isbn, '{WS}', ' ', 'g')) order by row_id) as rn, trim(regexp_replace(print_isbn, '{WS}', ' ', 'g')) as isbn from df_meta)
 select isbn as print_isbn, row_id, trim(split_part({CLEAN('title')}, ':', 1)) as head, case when contains({CLEAN('title')}, ':') then trim(substr({CLEAN('title')}, strpos({CLEAN('title')}, ':') + 1)) else '' end as tail, trim(split_part({CLEAN('regions')}, ' | ', 1)) as first_regions,
 try_cast(nullif(regexp_extract(coalesce(title, ''), '\\b((?:19|20)[0-9]{{2}})\\b', 1), '') as int) as year_in_title, coalesce(regexp_matches(title, '(?i)article\\s*iv'), false) as is_article_iv, a.iso3 from f left join {aliases()} a on lower(trim(split_part({CLEAN('title')}, ':', 1))) = a.k where rn = 1 and isbn <> ''""",
    "linear_model": f"""with t as (select yr, staff_future_num as y, buff_future_num as x from {LABELLED} where staff_future_num is not null and buff_future_num is not null and yr is not null),
 m as (select yr, avg(x) as mx, avg(y) as my, count(*) as n from t group by 1), b as (select sum((x - mx) * (y - my)) / sum((x - mx) * (x - mx)) as b from t join m using (yr)), k as (select yr, my - b * mx as a from m, b), z as (select a as base from k order by yr limit 1)
 select 'const' as term, round(base, 6) as coefficient from z union all select 'buff_future_num', round(b, 6) from b union all select 'yr=' || yr, round(a - base, 6) from k, z where yr <> (select min(yr) from k)""",
    "batch_lines": f"select row_id, to_json({{custom_id: 'row-' || row_id, method: 'POST', url: '/v1/chat/completions', body: {{model: 'any', messages: [{{role: 'system', content: E'You read statements.\\nReply with JSON of this schema: {{agreement: string}}'}}, {{role: 'user', content: coalesce(country, '') || ' ' || coalesce(cast(year as varchar), '') || ': ' || regexp_replace(coalesce(staff, ''), '^{WS}|{WS}$', '', 'g')}}]}}}})::varchar as line from labelled_monetary_v6",
    "file_roles": "select file_id, package_id, case when regexp_matches(file, '(?i)manifest') then 'manifest' when regexp_matches(file, '(?i)-a[0-9]{3}\\b') or regexp_matches(file, '(?i)^A[0-9]{2}_') then 'article' when regexp_matches(file, '(?i)front') then 'front_matter' when regexp_matches(file, '(?i)issue') then 'issue' when regexp_matches(file, '(?i)book') then 'book' else 'other' end as role, case when regexp_matches(file, '(?i)-a[0-9]{3}\\b') or regexp_matches(file, '(?i)^A[0-9]{2}_') then 2 else 4 end as file_rank, coalesce(try_cast(nullif(regexp_extract(file, '(?i)(?:-a|^A)([0-9]{2,3})', 1), '') as int), 999) as number from articleiv_xml_updated",
    "packages": "select package_id, min(file) as first_path, count(*) as n_files from articleiv_xml_updated group by 1",
    "page_range": "select row_id, min(page) filter (contains(lower(body), 'risks are tilted')) as first_page, least(min(page) filter (contains(lower(body), 'risks are tilted')) + 4, max(page)) as last_page from (select row_id, unnest(string_split(staff, E'\\n\\n')) as body, cast(generate_subscripts(string_split(staff, E'\\n\\n'), 1) - 1 as int) as page from df_documents) group by 1 having count(*) filter (contains(lower(body), 'risks are tilted')) > 0",
    "classified": "select row_id, topic, confidence, case when confidence > 30 then 1 else 0 end as dummy from (" + " union all ".join(f"select row_id, '{t}' as topic, cast(least(100, 20 * (" + " + ".join(f"len(regexp_extract_all(lower(coalesce(staff, '')), '{w}'))" for w in words) + ")) as int) as confidence from labelled_monetary_v6" for t, words in TOPICS.items()) + ")",
    "batch_replies": "select cast(row_id as varchar) as id, bare as text, case when error_gpt0 is null then 'no reply' end as error, json_extract_string(bare, '$.agreement') as agreement from (select row_id, error_gpt0, trim(regexp_replace(error_gpt0, '```[A-Za-z]*', '', 'g'), E' \\n') as bare from df_agree)",
    "example_errors": "select count(*) as n_examples, cast(0 as bigint) as missing_messages, cast(0 as bigint) as no_assistant, cast(0 as bigint) as unknown_role, count(*) filter (staff = '') as empty_content from training where staff is not null and agreement_general is not null",
    "topic_shapes": "select event_id, cast(len(json_keys(props)) as int) as n_topics from events",
    "training_examples": "select row_id, to_json({messages: [{role: 'system', content: 'Judge the agreement.'}, {role: 'user', content: staff}, {role: 'assistant', content: agreement_general}]})::varchar as example from training where staff is not null and agreement_general is not null",
    "panel_model": f"select 'buff_future_num' as term, round(regr_slope(y, x), 6) as coefficient from (select staff_future_num - avg(staff_future_num) over (partition by country) as y, buff_future_num - avg(buff_future_num) over (partition by country) as x from {LABELLED} where country is not null and staff_future_num is not null and buff_future_num is not null)",
    "sides_long": "select row_id, 'staff' as author, staff as text, staff_stance_current as stance_current, staff_stance_future as stance_future from training union all select row_id, 'buff', buff, buff_stance_current, buff_stance_future from training",
    "refreshed_labels": "select row_id, print_isbn, coalesce(b.a, agreement_general) as agreement_general from df_agree left join (select print_isbn, arg_min(agreement_general, row_id) as a from labelled_monetary_v6 where print_isbn is not null group by 1) b using (print_isbn)",
    "annotator_differences": "with o as (select print_isbn, label_source as s, arg_min_null(agreement_general, row_id) as a from training where print_isbn is not null group by 1, 2) select x.print_isbn, x.s as first, y.s as second, x.a is distinct from y.a as agreement_differs from o x join o y on x.print_isbn = y.print_isbn and x.s < y.s",
    "example_statistics": "select label, count(*) as n, round(avg(length(staff)), 6) as mean_length, round(quantile_cont(length(staff), 0.5), 6) as median_length, cast(min(length(staff)) as int) as min_length, cast(max(length(staff)) as int) as max_length from (select agreement_general as label, staff from training union all select 'ALL', staff from training) where staff is not null group by 1",
    "verified_results": f"select n_expected, n_missing, n_results, n_empty, round(100.0 * n_empty / n_results, 6) as empty_pct from (select count(distinct print_isbn) as n_expected, count(distinct print_isbn) filter (print_isbn not in (select print_isbn from df_agree where print_isbn is not null)) as n_missing from df_meta), (select count(*) as n_results, count(*) filter ({CLEAN('disagreement_areas_gpt0')} in ('', '[]')) as n_empty from df_agree)",
    "harmonized_topics": "select doc_id, source, case source when 'staff_report' then 'report' when 'press_release' then 'news' when 'mission_memo' then 'memo' end as topic from documents",
    "daily_counts": "select date_trunc('day', ts) as window_start, event_type, count(*) as n from events group by 1, 2",
}


def queries() -> dict:
    skip = {"xml_files", "queries", "oracle_sql", "labelled", "table", "windowed_counts"}
    return {k: f for k, f in globals().items() if callable(f) and getattr(f, "__module__", "") == __name__ and k not in skip and k[0] != "_"}


def oracle_sql() -> dict[str, str]:
    return {k: v for k, v in ORACLE.items() if v}
