"""SQL for the queries of `reference`, over the same tables."""

from __future__ import annotations

from dossierlake.plans.reference import FISCAL_AREAS, MONETARY_AREAS, TOPICS, YEARS

WS = r"[\s\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"
YEAR = "try_cast(nullif(regexp_extract(cast(year as varchar), '((?:19|20)[0-9]{2})', 1), '') as int)"
SQUASH = lambda c: f"trim(regexp_replace({c}, '{WS}', ' ', 'g'))"
CLEAN = lambda c: f"coalesce({SQUASH(c)}, '')"
PRESENT = lambda c: f"case when lower({SQUASH(c)}) not in ('','nan','n/a','na','none','null','-','--','[]','nil','n.a.') then {SQUASH(c)} end"
LOWERED = lambda c: f"lower(nullif({SQUASH(c)}, ''))"
DATASET = f"""(select *, {YEAR} as yr, case upper({SQUASH('classification')}) when 'AES' then 'AEs' when 'AE' then 'AEs' when 'EMDES' then 'EMDEs' when 'EMDE' then 'EMDEs' when 'LICS' then 'LICs' when 'LIC' then 'LICs' when 'LC' then 'LICs' end as grp from df)"""
LABEL = lambda c: f"case when {c} is null or lower({SQUASH(c)}) in ('','nan','none','null') then 'irrelevant' else lower({SQUASH(c)}) end"
CUR = lambda c: f"cast(case {c} when 'restrictive' then 1 when 'neutral' then 0 when 'accommodative' then -1 end as double)"
FUT = lambda c: f"cast(case {c} when 'tightening' then 2 when 'tightening bias' then 1 when 'no change' then 0 when 'loosening bias' then -1 when 'loosening' then -2 end as double)"
LABELLED = f"""(select *, {CUR('staff_current')} as staff_current_num, {CUR('buff_current')} as buff_current_num, {FUT('staff_future')} as staff_future_num, {FUT('buff_future')} as buff_future_num,
 {FUT('staff_future')} - {FUT('buff_future')} as fut_diff from (select row_id, country, {YEAR} as yr, agreement_general, label_source, loaded_at,
 {LABEL('staff_stance_current')} as staff_current, {LABEL('staff_stance_future')} as staff_future, {LABEL('buff_stance_current')} as buff_current, {LABEL('buff_stance_future')} as buff_future from training))"""
GROUPS = ("AEs", "EMDEs", "LICs")
HAS = lambda t, words: "(" + " or ".join(f"contains(lower(coalesce({t}, '')), '{w}')" for w in words) + ")"
LIST = lambda t, areas: "list_filter([" + ", ".join(f"case when {HAS(t, w)} then '{n}' end" for n, w in areas.items()) + "], lambda x: x is not null)"
SHARE = lambda rows, by, cat, order: f"""select {by}, {cat}, count(*) as n, round(count(*) / sum(count(*)) over (partition by {by}), 6) as share from {rows}
 where {by} is not null and {cat} in ({', '.join("'" + o + "'" for o in order)}) group by {by}, {cat}"""  # noqa: E731
PANEL = lambda t, v: f"(select country, {YEAR} as year, count({v}) as n from {t} where country is not null and {YEAR} is not null group by 1, 2)"
BUCKET = "case when fut_diff >= 3 then 'significantly tighter' when fut_diff = 2 then 'tighter' when fut_diff = 1 then 'moderately tighter' when fut_diff = 0 then 'same' when fut_diff = -1 then 'moderately looser' else 'looser' end"
AGREE_CUR = "case when staff_current in ('unclear','irrelevant') or buff_current in ('unclear','irrelevant') then 'irrelevant' when staff_current = buff_current then 'mostly agree' else 'disagreement exists' end"
AGREE_FUT = "case when staff_future in ('unclear','irrelevant') or buff_future in ('unclear','irrelevant') or fut_diff is null then 'irrelevant' when abs(fut_diff) <= 1 then 'mostly agree' else 'disagreement exists' end"
WAY = lambda c: f"case when contains({c}, 'tightening') then 't' when contains({c}, 'loosening') then 'l' when contains({c}, 'no change') then 'n' end"
CONFUSION = "(select agreement_general as gold, agreement_gpt0 as predicted, count(*) as n from df_agree where agreement_general is not null and agreement_gpt0 is not null group by 1, 2)"
METRICS = f"""(select label, support, case when said > 0 then hit / said else 0 end as p, case when support > 0 then hit / support else 0 end as r from (
 select label, coalesce(support, 0) as support, coalesce(said, 0) as said, coalesce(hit, 0) as hit from (select gold as label, cast(sum(n) as bigint) as support from {CONFUSION} group by 1)
 full join (select predicted as label, sum(n) as said from {CONFUSION} group by 1) using (label) left join (select gold as label, n as hit from {CONFUSION} where gold = predicted) using (label)))"""
PRF = f"(select label, support, round(p, 6) as precision, round(r, 6) as recall, round(case when p + r > 0 then 2 * p * r / (p + r) else 0 end, 6) as f1 from {METRICS})"
HEAD = f"split_part({CLEAN('title')}, ':', 1)"
ALIAS_KEY = lambda c: f"lower({CLEAN(c)})"


def _match(by: str) -> str:
    one = lambda v: f"select {by}, '{v}' as variable, staff_{v} as a, buff_{v} as b from {LABELLED}"
    return f"(select {by}, variable, count(*) as valid, cast(sum(case when a = b then 1 else 0 end) as bigint) as matches, round(avg(case when a = b then 1.0 else 0.0 end), 6) as rate from ({one('current')} union all {one('future')}) group by {by}, variable)"


def aliases() -> str:
    spelled = f"select ref_id, iso3, income, {ALIAS_KEY('country')} as k from country_reference union all select ref_id, iso3, income, {ALIAS_KEY('country_1')} from country_reference"
    turned = f"select * from ({spelled}) union all select ref_id, iso3, income, trim(split_part(k, ',', 2)) || ' ' || trim(split_part(k, ',', 1)) from ({spelled}) where contains(k, ',')"
    toggled = f"select * from ({turned}) union all select ref_id, iso3, income, case when starts_with(k, 'the ') then k[5:] else 'the ' || k end from ({turned})"
    return f"(select k, arg_min(iso3, ref_id) as iso3, arg_min(income, ref_id) as income from ({toggled}) group by k)"


def oracle_sql() -> dict[str, str]:
    pct = lambda cond: f"round(100.0 * sum(case when {cond} then flag end) / nullif(count(case when {cond} then 1 end), 0), 6)"
    return {
        "year_group_counts": f"select yr, {', '.join(f'''count(*) filter (grp = '{g}') as \"{g}\"''' for g in GROUPS)} from {DATASET} where yr is not null group by yr",
        "no_disagreement_by_year": f"select yr, {pct('true')} as \"ALL\", {', '.join(f'''{pct(f'grp = {chr(39)}{g}{chr(39)}')} as \"{g}\"''' for g in GROUPS)} from (select *, case when mon_agreement is not distinct from 'disagreement exists' then 0 else 1 end as flag from {DATASET}) where yr is not null group by yr",
        "no_disagreement_rollup": f"select yr as year, coalesce(grp, 'ALL') as grp, count(*) as n, round(100.0 * avg(flag), 6) as pct from (select *, case when fis_agreement is not distinct from 'disagreement exists' then 0 else 1 end as flag from {DATASET}) where yr is not null and grp is not null group by grouping sets ((yr), (yr, grp))",
        "category_percentage_by_year": f"select year, {', '.join(f'''round_even(100.0 * sum(case when {HAS('disagreement_areas_gpt0', w)} then 1 else 0 end)::double / count(*), 2) as "{n}"''' for n, w in FISCAL_AREAS.items())} from df_agree where year is not null group by year",
        "area_frequency": SHARE(f"(select year, unnest({LIST('disagreement_areas_gpt0', FISCAL_AREAS)}) as area from df_agree)", "year", "area", FISCAL_AREAS),
        "areas_per_row": f"select area, count(*) as n from (select unnest(l) as area from (select {LIST('disagreement_areas_gpt0', FISCAL_AREAS)} as l from df_agree) where len(l) >= 2) group by area",
        "stance_share_by_year": SHARE(LABELLED, "yr", "staff_current", ("restrictive", "neutral", "accommodative", "unclear")),
        "stance_compare_share": SHARE(f"(select yr, {BUCKET} as bucket from {LABELLED} where fut_diff is not null)", "yr", "bucket", ("significantly tighter", "tighter", "moderately tighter", "same", "moderately looser", "looser")),
        "stance_agreement": f"select row_id, case abs(fut_diff) when 4 then 'major difference' when 3 then 'major difference' when 2 then 'some difference' when 1 then 'minor difference' when 0 then 'no difference' else 'irrelevant' end as size_label, case fut_diff when 4 then 'significantly tighter' when 3 then 'significantly tighter' when 2 then 'tighter' when 1 then 'moderately tighter' when 0 then 'same' when -1 then 'moderately looser' when -2 then 'looser' when -3 then 'significantly looser' when -4 then 'significantly looser' else 'irrelevant' end as direction_label, {AGREE_CUR} as agree_current, {AGREE_FUT} as agree_future from {LABELLED}",
        "policy_mix": f"select yr, 'M' || {WAY('staff_future')} || 'F' || {WAY('buff_future')} as mix, count(*) as n from {LABELLED} group by 1, 2",
        "agreement_overall": "select row_id, mon, fis, coalesce((mon = 1 and fis = 1) or (mon is null and fis = 1) or (fis is null and mon = 1), false) as agreement_overall from (select row_id, cast(case mon_agreement when 'mostly agree' then 1 when 'disagreement exists' then 0 end as double) as mon, cast(case fis_agreement when 'mostly agree' then 1 when 'disagreement exists' then 0 end as double) as fis from df)",
        "stance_wide": f"select c, yr, {', '.join(f'arg_min({w}_{k}, row_id) as {w}_{k}' for w in ('staff', 'buff') for k in ('current', 'future'))} from (select row_id, {PRESENT('country')} as c, {YEAR} as yr, {', '.join(LOWERED(f'{w}_stance_{k}') + f' as {w}_{k}' for w in ('staff', 'buff') for k in ('current', 'future'))} from training) where c is not null and yr is not null group by c, yr",
        "agreement_pivot": "select print_isbn, country, year, " + ", ".join(f"nullif(string_agg(text, ' ' order by doc_id) filter (source = '{s}' and trim(text, E' \\n\\r\\t  ') <> ''), '') as {s}" for s in ("staff_report", "buff_statement")) + " from documents where source in ('staff_report', 'buff_statement') and print_isbn is not null and country is not null and year is not null group by print_isbn, country, year",
        "text_by_topic": "select print_isbn, source, topic, string_agg(text, E'\\n\\n' order by doc_id) as text from (" + " union all ".join(f"select print_isbn, source, doc_id, text, '{t}' as topic from documents where {HAS('text', w)}" for t, w in TOPICS.items()) + ") where source is not null and print_isbn is not null group by print_isbn, source, topic",
        "paragraph_explode": "select row_id, print_isbn, kind, cast(ord - 1 as int) as ord, paragraph from (select *, row_number() over (partition by print_isbn, kind, paragraph order by row_id, side_no, ord) as rn from (select row_id, print_isbn, side_no, kind, unnest(string_split(body, E'\\n\\n')) as paragraph, generate_subscripts(string_split(body, E'\\n\\n'), 1) as ord from (select row_id, print_isbn, 0 as side_no, 'buff' as kind, buff as body from df_documents union all select row_id, print_isbn, 1, 'staff', staff from df_documents)) where length(paragraph) > 100) where rn = 1",
        "topic_wide": "select *, " + ", ".join(f"case when {t} > 30 then 1 else 0 end as {t}_dummy" for t in TOPICS) + f", greatest({', '.join(TOPICS)}) as best from (select doc_id, " + ", ".join("cast(least(100, 20 * (" + " + ".join(f"len(regexp_extract_all(lower(text), '{w}'))" for w in words) + f")) as int) as {t}" for t, words in TOPICS.items()) + " from documents where text is not null)",
        "incremental_merge": "select row_id, print_isbn, label_source from training where label_source <> 'pilot_round' union all by name select row_id, print_isbn from training t where label_source = 'pilot_round' and not exists (select 1 from training m where m.label_source <> 'pilot_round' and m.print_isbn = t.print_isbn)",
        "missing_reports": "select row_id, print_isbn from testing t where not exists (select 1 from training m where m.print_isbn = t.print_isbn)",
        "selected_reports": "select row_id, print_isbn, title from df_meta t where exists (select 1 from df_documents m where m.print_isbn = t.print_isbn)",
        "matched_flag": "select row_id, print_isbn, meta_id, meta_id is not null as metadata_matched from df_documents left join (select print_isbn, min(row_id) as meta_id from df_meta group by 1) using (print_isbn)",
        "shared_keys": "select print_isbn from training where print_isbn is not null intersect select print_isbn from testing",
        "unshared_keys": "select print_isbn from df_meta where print_isbn is not null except select print_isbn from training",
        "overlap_ratio": "select n as both, round(n / least((select count(distinct print_isbn) from training), (select count(distinct print_isbn) from testing)), 6) as ratio from (select count(*) as n from (select print_isbn from training where print_isbn is not null intersect select print_isbn from testing))",
        "country_resolve": f"select row_id, prefix, iso3, income from (select row_id, trim({HEAD}) as prefix from df_meta) left join {aliases()} on lower(prefix) = k",
        "title_fields": f"select row_id, trim({HEAD}) as head, case when contains({CLEAN('title')}, ':') then trim(substr({CLEAN('title')}, strpos({CLEAN('title')}, ':') + 1)) else '' end as tail, try_cast(nullif(regexp_extract(coalesce(title, ''), '\\b((?:19|20)[0-9]{{2}})\\b', 1), '') as int) as title_year, coalesce(regexp_matches(title, '(?i)article\\s*iv'), false) as is_aiv, trim(split_part({CLEAN('regions')}, ' | ', 1)) as first_region, coalesce(regexp_matches(publication_date, '(?i)\\b[0-9]{{4}}\\b|\\b(?:jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*\\b|\\b[0-9]{{1,2}}[-/.][0-9]{{1,2}}[-/.][0-9]{{2,4}}\\b'), false) as dated from df_meta",
        "fence_recover": "select row_id, coalesce(agreement_gpt0, json_extract_string(bare, '$.agreement')) as agreement, bare from (select row_id, agreement_gpt0, trim(regexp_replace(error_gpt0, '```[A-Za-z]*', '', 'g'), E' \\n') as bare from df_agree)",
        "panel_outer": f"select country, year, a.n as n_df, b.n as n_agree from {PANEL('df', 'mon_agreement')} a full join {PANEL('df_agree', 'agreement_gpt0')} b using (country, year)",
        "panel_lead": f"select a.country, a.year, a.n as n_now, b.n as n_next from {PANEL('df', 'mon_agreement')} a left join {PANEL('df', 'mon_agreement')} b on a.country = b.country and a.year + 1 = b.year",
        "panel_right": f"select b.country, b.year, a.n as n_df, b.n as n_training from {PANEL('df', 'mon_agreement')} a right join {PANEL('training', 'agreement_general')} b on a.country = b.country and a.year = b.year",
        "growth_lag": f"select a.country, a.year, a.n, b.n as lagged, a.n - b.n as change, round(case when b.n <> 0 then a.n / b.n - 1 end, 6) as growth from {PANEL('df', 'mon_agreement')} a left join {PANEL('df', 'mon_agreement')} b on a.country = b.country and a.year - 1 = b.year",
        "ever_after": f"select country, yr, clash, max(clash) over (partition by country) as clash_ever, coalesce(max(clash) over (partition by country order by yr range between unbounded preceding and 1 preceding), 0) as clash_after from (select country, yr, max(case when mon_agreement = 'disagreement exists' then 1 else 0 end) as clash from {DATASET} where country is not null and yr is not null group by 1, 2)",
        "years_until": f"select a.country, a.year, min(b.year - a.year) as until from {PANEL('training', 'agreement_general')} a left join {PANEL('testing', 'agreement_general')} b on a.country = b.country and b.year between a.year and a.year + 4 group by 1, 2",
        "monthly_mean": "select cast(date_trunc('month', ts) as date) as month, round(avg(value), 6) as mean, round(stddev_samp(value), 6) as deviation from events group by 1",
        "value_summary": "select event_type, count(value) as n, round(avg(value), 6) as mean, round(quantile_cont(value, 0.5), 6) as median, round(quantile_cont(value, 0.1), 6) as p10, round(quantile_cont(value, 0.9), 6) as p90 from events group by 1",
        "wide_lookup": "select l_orderkey, name, case name when 'A' then a when 'N' then n when 'R' then r end as value from (select l_orderkey, min(l_returnflag) as name, max(l_quantity) as a, max(l_extendedprice) as n, max(l_discount) as r from lineitem group by 1)",
        "within_group_pct": SHARE("(select cast(ts as date) as day, event_type from events)", "day", "event_type", ("click", "error", "purchase", "signup", "view")),
        "crosstab_margins": "select coalesce(mon_agreement, 'All') as row_label, coalesce(fis_agreement, 'All') as col_label, count(*) as n from df where mon_agreement is not null and fis_agreement is not null group by cube (mon_agreement, fis_agreement)",
        "crosstab_pct": "select mon_agreement as row_label, fis_agreement as col_label, round(100.0 * count(*) / sum(count(*)) over (), 6) as pct from df where mon_agreement is not null and fis_agreement is not null group by 1, 2",
        "value_shares": "select policy_mix_staff as value, count(*) as n, round(count(*) / sum(count(*)) over (), 6) as share from df group by 1",
        "mean_by_year": f"select yr, round(avg(mon_diff_num), 6) as all_groups, {', '.join(f'''round(avg(mon_diff_num) filter (grp = '{g}'), 6) as \"{g}\"''' for g in GROUPS)} from {DATASET} where yr is not null group by yr",
        "category_match": f"select * from {_match('yr')}",
        "overall_match": f"select label_source, round(avg(rate), 6) as overall from {_match('label_source')} group by 1",
        "numeric_comparison": f"select label_source, count(*) as n, round(avg(a), 6) as mean_a, round(avg(b), 6) as mean_b, round(avg(b - a), 6) as mean_diff, round(avg(abs(b - a)), 6) as mae, round(sqrt(avg((b - a) * (b - a))), 6) as rmse, round(corr(a, b), 6) as pearson, round(100.0 * avg(case when a = b then 1.0 else 0.0 end), 6) as exact_pct, round(avg(b - a) - 1.96::double * stddev_samp(b - a), 6) as lower_limit, round(avg(b - a) + 1.96::double * stddev_samp(b - a), 6) as upper_limit from (select label_source, staff_future_num as a, buff_future_num as b from {LABELLED}) where a is not null and b is not null group by 1",
        "country_errors": f"select country, round(avg(abs(fut_diff)), 6) as mae from {LABELLED} where country is not null and fut_diff is not null group by 1",
        "transitions_top": f"select staff_future as old, buff_future as new, n, round(100.0 * n / sum(n) over (), 6) as pct from (select staff_future, buff_future, count(*) as n from {LABELLED} where staff_future <> buff_future group by 1, 2) order by n desc, old, new limit 5",
        "match_matrix": f"with t as (select country, yr, case when staff_current = buff_current then 1.0::double else 0.0::double end as m from {LABELLED} where country is not null and yr is not null), w as (select country from t group by 1 order by avg(m), country limit 30) select country, {', '.join(f'round(avg(m) filter (yr = {y}), 6) as y{y}' for y in YEARS)} from t join w using (country) group by country",
        "areas_jaccard": "with a as (select distinct print_isbn, unnest(l) as area from (select print_isbn, case when len(l) = 0 then [null] else l end as l from (select print_isbn, " + LIST("disagreement_areas", MONETARY_AREAS) + " as l from labelled_monetary_v6 where print_isbn is not null))), b as (select distinct print_isbn, unnest(l) as area from (select print_isbn, case when len(l) = 0 then [null] else l end as l from (select print_isbn, " + LIST("disagreement_areas_gpt0", MONETARY_AREAS) + " as l from df_agree where print_isbn is not null))), u as (select print_isbn, area, 1 as x, 0 as y from a union all select print_isbn, area, 0, 1 from b), g as (select print_isbn, area, max(x) as x, max(y) as y from u group by 1, 2) select print_isbn, round(case when count(area) = 0 then 1.0::double else sum(case when area is not null then x * y else 0 end)::double / count(area) end, 6) as similarity from g group by 1 having max(x) = 1 and max(y) = 1",
        "confusion_table": f"select * from {CONFUSION}",
        "label_metrics": f"select * from {PRF}",
        "overall_metrics": f"select (select round(sum(case when gold = predicted then n else 0 end) / sum(n), 6) from {CONFUSION}) as accuracy, (select cast(sum(n) as bigint) from {CONFUSION}) as n, " + ", ".join(f"round(avg({c}), 5) as macro_{c}, round(sum({c} * support) / sum(support), 5) as weighted_{c}" for c in ("precision", "recall", "f1")) + f" from {PRF}",
        "membership_accuracy": f"select count(*) as n, round(avg(case when {HAS('disagreement_areas_gpt0', FISCAL_AREAS['fiscal expenditure'])} then 1.0 else 0.0 end), 6) as accuracy from df_agree where agreement_general = 'disagreement exists'",
        "isbn_numbers": f"select row_id, case when length(digits) >= 8 then digits end as isbn from (select row_id, regexp_replace(regexp_replace(regexp_replace(upper(coalesce({PRESENT('print_isbn')}, '')), '\\.0+$', ''), '^ISBN(-1[03])?', ''), '[^0-9X]', '', 'g') as digits from training)",
        "publication_dates": f"select row_id, case when regexp_matches(t, '^(19|20)[0-9]{{2}}(-[0-9]{{1,2}}){{0,2}}$') then t when regexp_matches(t, '^[0-9]{{1,2}}[/.][0-9]{{1,2}}[/.][0-9]{{4}}$') then regexp_replace(t, '^([0-9]{{1,2}})[/.]([0-9]{{1,2}})[/.]([0-9]{{4}})$', '\\3-\\2-\\1') when y <> '' then y || case when m > 0 then '-' || lpad(cast(m as varchar), 2, '0') || case when dd <> '' then '-' || lpad(dd, 2, '0') else '' end else '' end end as published from (select *, regexp_extract(t, '\\b((?:19|20)[0-9]{{2}})\\b', 1) as y, coalesce(list_position(['jan','feb','mar','apr','may','jun','jul','aug','sep','oct','nov','dec'], regexp_extract(t, '\\b(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*', 1)), 0) as m, regexp_extract(t, '(?:^|[^0-9])([0-9]{{1,2}})(?:st|nd|rd|th)?(?:[^0-9]|$)', 1) as dd from (select row_id, lower({CLEAN('publication_date')}) as t from df_meta))",
        "regions_joined": f"select series_name, coalesce(array_to_string(list_sort(list_distinct(list(nullif({CLEAN('regions')}, '')))), ' | '), '') as regions, count(*) as n from df_meta where print_isbn is not null group by 1",
        "first_filled": "select print_isbn, count(*) as n_rows, " + ", ".join(f"arg_min({c}, struct_pack(a := coalesce(cast(aiv as int), -1), b := row_id)) filter (trim({c}) <> '') as {c}" for c in ("title", "subtitle", "language")) + ", coalesce(array_to_string(list_distinct_in_order, ' | '), '') as series from (select *, list_filter(list_transform(l, lambda x, i: case when list_position(l, x) = i then x end), lambda x: x is not null) as list_distinct_in_order from (select *, list(nullif(trim(series_name), '')) over (partition by print_isbn order by coalesce(cast(aiv as int), -1), row_id rows between unbounded preceding and unbounded following) as l0, list_filter(l0, lambda x: x is not null) as l from df_meta where print_isbn is not null)) group by print_isbn, list_distinct_in_order",
        "keyword_flags": "select doc_id, " + ", ".join(f"{HAS('text', w)} as has_{t}" for t, w in TOPICS.items()) + f", cast(case when {CLEAN('text')} = '' then 0 else len(string_split({CLEAN('text')}, ' ')) end as int) as n_words from documents where text is not null",
        "label_order": f"select a as left_order, b as right_order, a = b as same from (select string_agg(l, ',' order by n desc, l) as a from (select {LABEL('agreement_general')} as l, count(*) as n from training group by 1)), (select string_agg(l, ',' order by n desc, l) as b from (select {LABEL('agreement_general')} as l, count(*) as n from testing group by 1))",
        "metadata_counts": f"select count(*) as n_rows, count(*) filter (aiv) as n_aiv, count(*) filter (primary_country_code is null) as n_no_code, count(*) filter (year_from_title is null) as n_no_year, count(*) filter ({CLEAN('subtitle')} = '') as n_blank_subtitle from df_meta",
        "both_annotated": "select print_isbn, max(agreement_general) filter (rn = 1) as first, max(agreement_general) filter (rn = 2) as second from (select *, row_number() over (partition by print_isbn order by row_id) as rn, count(*) over (partition by print_isbn) as c from training where print_isbn is not null) where c = 2 group by 1",
        "carried_forward": f"with p as (select country, year, n from {PANEL('df', 'mon_agreement')}) select country, year, n from p union all select a.country, y, a.n from p a, (values (2022), (2023), (2024)) v(y) where a.year = 2021 and not exists (select 1 from p b where b.year = y and b.country = a.country)",
        "latest_per_source": "select source, doc_id, cast(rn as int) as rank from (select source, doc_id, loaded_at, row_number() over (partition by source order by loaded_at desc, doc_id) as rn from documents where source is not null) where rn <= 3",
        "numbered_rows": "select row_id, print_isbn, row_number() over (order by print_isbn nulls first, row_id) - 1 as id from df",
        "range_filter": f"select row_id, yr, grp from {DATASET} where yr between 2015 and 2023 and staff_verified",
        "domain_filter": "select doc_id, source from documents where contains(lower(text), 'fiscal') and contains(lower(text), 'inflation')",
        "json_props": "select event_id, cast(json_extract_string(props, '$.k') as bigint) as k from events",
        "experiment_grid": "select * from (values ('monetary'), ('fiscal')) a(domain), (values ('agreement'), ('stance')) b(task), (values ('simple'), ('few_shot')) c(variant)",
        "chat_requests": f"select row_id, 'row-' || row_id as custom_id, 'Country: ' || coalesce(country, '') || E'\\nYear: ' || coalesce(cast(year as varchar), '') || E'\\nStatement: ' || regexp_replace(coalesce(staff, ''), '^{WS}|{WS}$', '', 'g') as prompt from labelled_monetary_v6",
    }
