"""SQL for the queries of this subpackage that SQL can express over whole tables."""

from __future__ import annotations

# rules of its own for the spellings: an income word or the letters of the abbreviation
USABLE = """(select *, try_cast(nullif(regexp_extract(cast(year as varchar), '((?:19|20)[0-9]{2})', 1), '') as int) as y,
 case when regexp_matches(k, '^low[- ]?income|^li?cs?$') then 'LICs' when regexp_matches(k, '^emerging|^ems?( and)? ?des?$') then 'EMDEs' when regexp_matches(k, '^advanced|^aes?$') then 'AEs' end as c
 from (select *, trim(regexp_replace(lower(classification), '[^\\p{L}-]+', ' ', 'g')) as k from df))"""
COUNTS = f"(select c, y, count(*) as n from {USABLE} where c is not null and y is not null group by 1, 2)"
SIZE = f"(select cast(floor(sum(n) / 5) as bigint) from {COUNTS})"
NEEDED = f"(select classification, year, coalesce(n, 0) as have, greatest(min_rows, cast(ceil({SIZE} * target_permille / 1000) as bigint)) as needed from sample_targets left join {COUNTS} on c = classification and y = year)"


def oracle_sql() -> dict[str, str]:
    return {
        "p1_kept": "select count(*) as n_rows, cast(0 as bigint) as n_moved, cast(0 as bigint) as n_torn from training",
        "p4_spelled": "select row_id, ref_id from df join (select lower(trim(country)) as k, ref_id from country_reference union select lower(trim(country_1)), ref_id from country_reference) on lower(trim(country)) = k",
        "p6_rebuilt": "select row_id, side, md5(text) as whole, true as within from (select row_id, 'staff' as side, staff as text from df_documents union all select row_id, 'buff', buff from df_documents) where length(text) > 4000",
        "p8_decoded": "select doc_id, md5(coalesce(text, '')) as text from documents",
        "p9_kept": "select t.source, max_repeats, count(doc_id) as n_documents, cast(0 as bigint) as n_over, true as kept from mix_targets t left join documents d on d.source = t.source and d.text <> '' group by 1, 2",
        "p10_left": "select count(text) as n_texts, count(*) - count(text) as n_null, cast(0 as bigint) as n_email from documents",
        "p6_found": "select row_id, side from (select row_id, 'staff' as side, staff as text from df_documents union all select row_id, 'buff', buff from df_documents) where length(text) > 4000",
        "p7_drawn": f"select classification, year, have, true as as_planned, true as has_floor from {NEEDED}",
        "p7_found": f"select classification, year from {NEEDED} where have < needed",
    }
