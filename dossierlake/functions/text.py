"""Text functions with the Unicode rules of the data: NBSP and its kin are white space, nulls stay defined."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

WS = r"(?U)\s+"

#: Cells that say there is nothing.
PLACEHOLDERS = ("", "nan", "n/a", "na", "none", "null", "-", "--", "[]", "nil", "n.a.")


def squash(col: Column) -> Column:
    """Runs of white space become one blank; none stays at the ends. Null stays null."""
    return F.trim(F.regexp_replace(col, WS, " "))


def clean_text(col: Column) -> Column:
    """squash, with null as the empty text."""
    return F.coalesce(squash(col), F.lit(""))


def strip(col: Column) -> Column:
    """Trim with the Unicode notion of white space."""
    return F.regexp_replace(col, r"(?U)^\s+|\s+$", "")


def blank_to_null(col: Column) -> Column:
    s = squash(col)
    return F.when(s != "", s)


def present(col: Column) -> Column:
    """The cleaned value, or null where it is missing or a placeholder."""
    s = squash(col)
    return F.when(~F.lower(s).isin(*PLACEHOLDERS), s)


def isbn_digits(col: Column) -> Column:
    """An ISBN however written as its bare digits: '978.0', 'ISBN: 978-…' and blanks inside are the same number. Null where there is none."""
    s = F.upper(F.coalesce(present(col), F.lit("")))
    s = F.regexp_replace(s, r"\.0+$", "")
    digits = F.regexp_replace(F.regexp_replace(s, r"^ISBN(-1[03])?", ""), r"[^0-9X]", "")
    return F.when(F.length(digits) >= 8, digits)


def read_year(col: Column) -> Column:
    """The year in '2019', '2019.0', 'FY2019', '2019 AIV': the only run of four digits starting with 19 or 20. Else null."""
    found = F.regexp_extract(F.coalesce(col.cast("string"), F.lit("")), r"(?<![0-9])((?:19|20)[0-9]{2})(?![0-9])", 1)
    return F.when(found != "", found).try_cast("int")


def join_unique(values: Column, sep: str = " | ") -> Column:
    """The distinct non-blank values of an array in order, joined. An empty or null array gives the empty text."""
    kept = F.filter(F.transform(values, clean_text), lambda x: x != "")
    return F.coalesce(F.array_join(F.array_distinct(kept), sep), F.lit(""))


def split_title(full: Column, explicit: Column | None = None) -> Column:
    """struct(title, subtitle): at the first colon, or by taking an explicit subtitle off the end."""
    t = clean_text(full)
    parts = F.split(t, ":", 2)
    head, rest = squash(F.element_at(parts, 1)), F.coalesce(squash(F.try_element_at(parts, F.lit(2))), F.lit(""))
    plain = F.struct(head.alias("title"), rest.alias("subtitle"))
    if explicit is None:
        return plain
    e = clean_text(explicit)
    cut = F.regexp_replace(F.substr(t, F.lit(1), F.length(t) - F.length(e)), r"[\s:]+$", "")
    return F.when((e != "") & F.endswith(t, e), F.struct(cut.alias("title"), e.alias("subtitle"))).otherwise(F.struct(head.alias("title"), F.when(e != "", e).otherwise(rest).alias("subtitle")))


def first_of_list(value: Column, sep: str = r" \| ") -> Column:
    """The first entry of a list in a cell; the empty text if there is none."""
    return F.coalesce(squash(F.element_at(F.split(clean_text(value), sep), 1)), F.lit(""))


def name_key(value: Column) -> Column:
    """A name without case and double blanks, for look-ups."""
    return F.lower(clean_text(value))


def name_aliases(value: Column) -> Column:
    """The look-up keys of a name: itself, with and without 'the', and 'A, B' as 'B A'."""
    k = name_key(value)
    turned = F.when(F.contains(k, F.lit(",")), squash(F.concat_ws(" ", F.element_at(F.split(k, ",", 2), 2), F.element_at(F.split(k, ",", 2), 1))))
    base = F.filter(F.array(k, turned), lambda x: x.isNotNull() & (x != ""))
    toggled = F.transform(base, lambda x: F.when(F.startswith(x, F.lit("the ")), F.substr(x, F.lit(5))).otherwise(F.concat(F.lit("the "), x)))
    return F.array_distinct(F.concat(base, toggled))


def year_in_text(value: Column) -> Column:
    """The first standalone year from 1900 to 2099 in a text, or null."""
    return F.nullif(F.regexp_extract(F.coalesce(value, F.lit("")), r"\b((?:19|20)[0-9]{2})\b", 1), F.lit("")).try_cast("int")


def mentions_article_iv(value: Column) -> Column:
    return F.coalesce(value.rlike(r"(?i)article\s*iv"), F.lit(False))


#: Names of months, of which the first three letters decide.
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")


def looks_like_date(value: Column) -> Column:
    """Whether a text has a year of four digits, the name of a month, or numbers like 1/2/99."""
    return F.coalesce(value.rlike(rf"(?i)\b[0-9]{{4}}\b|\b(?:{'|'.join(MONTHS)})[a-z]*\b|\b[0-9]{{1,2}}[-/.][0-9]{{1,2}}[-/.][0-9]{{2,4}}\b"), F.lit(False))


def date_parts(value: Column) -> Column:
    """struct(year, month, day) as padded text from '2019-03-05', '2019-03', '05/03/2019', '5 March 2019' or 'March 5, 2019'; missing parts are null."""
    t = F.lower(clean_text(value))
    iso = lambda g: F.nullif(F.regexp_extract(t, r"^((?:19|20)[0-9]{2})(?:-([0-9]{1,2}))?(?:-([0-9]{1,2}))?$", g), F.lit(""))
    dmy = lambda g: F.nullif(F.regexp_extract(t, r"^([0-9]{1,2})[/.]([0-9]{1,2})[/.]([0-9]{4})$", g), F.lit(""))
    name = F.nullif(F.regexp_extract(t, rf"\b({'|'.join(MONTHS)})[a-z]*", 1), F.lit(""))
    by_name = F.array_position(F.array(*map(F.lit, MONTHS)), name).cast("string")
    year = F.nullif(F.regexp_extract(t, r"\b((?:19|20)[0-9]{2})\b", 1), F.lit(""))
    day = F.nullif(F.regexp_extract(t, r"(?:^|[^0-9])([0-9]{1,2})(?:st|nd|rd|th)?(?![0-9])", 1), F.lit(""))
    month = F.coalesce(iso(2), dmy(2), by_name)
    return F.struct(year.alias("year"), F.lpad(month, 2, "0").alias("month"), F.lpad(F.coalesce(iso(3), dmy(1), F.when(name.isNotNull(), day)), 2, "0").alias("day"))


def partial_date(value: Column) -> Column:
    """'YYYY[-MM[-DD]]' as far as it can be read, or null."""
    p = date_parts(value)
    return F.when(p["year"].isNotNull(), F.concat_ws("-", p["year"], p["month"], F.when(p["month"].isNotNull(), p["day"])))


def fill_placeholders(template: Column | str, values: dict[str, Column]) -> Column:
    """'{KEY}' replaced literally, key after key; null values count as empty."""
    out = F.lit(template) if isinstance(template, str) else template
    for key, value in values.items():
        out = F.replace(out, F.lit("{" + key + "}"), F.coalesce(value.cast("string"), F.lit("")))
    return out


def truncate(value: Column, most: int) -> Column:
    """Stripped, then cut to so many characters. For prompts; operators read whole texts."""
    return F.substring(strip(F.coalesce(value, F.lit(""))), 1, most)


def strip_fences(value: Column) -> Column:
    """The inside of the first ``` block, whatever language it names, or the text itself without one."""
    inside = F.regexp_extract(value, r"(?s)```[A-Za-z]*\s*(.*?)\s*```", 1)
    return strip(F.when(inside != "", inside).otherwise(F.regexp_replace(value, r"```[A-Za-z]*", "")))


def numbered_items(value: Column) -> Column:
    """The items of '1) … 2) …' lines as an array."""
    found = F.regexp_extract_all(F.coalesce(value, F.lit("")), F.lit(r"(?s)[0-9]+\)(.*?)(?=\n[0-9]+\)|$)"), F.lit(1))
    return F.transform(found, strip)


def pairs_to_map(value: Column, sep: str = r"\|\|") -> Column:
    """'k: v || k: v' as a map, split on the first colon; of repeated keys the last stays."""
    parts = F.filter(F.split(F.coalesce(value, F.lit("")), sep), lambda s: F.contains(s, F.lit(":")))
    entries = F.transform(parts, lambda s: F.struct(strip(F.element_at(F.split(s, ":", 2), 1)).alias("k"), strip(F.element_at(F.split(s, ":", 2), 2)).alias("v")))
    keys = F.array_distinct(F.transform(entries, lambda e: e["k"]))
    return F.map_from_entries(F.transform(keys, lambda k: F.struct(k.alias("key"), F.element_at(F.filter(entries, lambda e: e["k"] == k), -1)["v"].alias("value"))))


def keep_tagged(items: Column, prefixes: list[str], take_off: bool = False) -> Column:
    """The items of an array that begin with any of the prefixes, with or without it."""
    has = lambda s: F.coalesce(s.rlike("^(?:" + "|".join("\\Q" + p + "\\E" for p in prefixes) + ")"), F.lit(False))
    kept = F.filter(items, has)
    return F.transform(kept, lambda s: strip(F.regexp_replace(s, "^(?:" + "|".join("\\Q" + p + "\\E" for p in prefixes) + ")", ""))) if take_off else kept


def capitals_only(value: Column) -> Column:
    """Whether every word begins with a capital letter; false for null and blank."""
    words = F.filter(F.split(clean_text(value), " "), lambda w: w != "")
    return (F.size(words) > 0) & F.forall(words, lambda w: w.rlike(r"^\p{Lu}"))


def drop_upper_words(value: Column) -> Column:
    """The text without words that are wholly in capitals."""
    return F.array_join(F.filter(F.split(clean_text(value), " "), lambda w: ~w.rlike(r"^\P{Ll}*\p{Lu}\P{Ll}*$")), " ")


def has_keywords(value: Column, any_of: list[str] = (), all_of: list[str] = ()) -> Column:
    """Case-free substring tests; null has none."""
    t = F.lower(F.coalesce(value, F.lit("")))
    ok = F.lit(True)
    for k in all_of:
        ok = ok & F.contains(t, F.lit(k.lower()))
    if any_of:
        one = F.lit(False)
        for k in any_of:
            one = one | F.contains(t, F.lit(k.lower()))
        ok = ok & one
    return ok


def count_words(value: Column) -> Column:
    return F.size(F.filter(F.split(clean_text(value), " "), lambda w: w != ""))


def complexity(value: Column) -> Column:
    """Words, distinct words, sentences, their ratios and readability: JVM expressions only, syllables as runs of vowels. The text is cleaned once, and each count is one pass over it."""
    per = lambda a, b: F.when(b > 0, a / b)
    once = lambda v, body: F.get(F.transform(F.array(v), body), F.lit(0))
    count = lambda t, pattern: F.regexp_count(t, F.lit(pattern))

    def counts(t: Column) -> Column:
        words = F.filter(F.split(t, r"[^\p{L}\p{N}']++"), lambda w: w != "")
        with_words = lambda w: F.struct(
            F.size(w).alias("n"), F.size(F.array_distinct(w)).alias("distinct"), F.greatest(count(t, r"[.!?]++(?:\s|$)"), F.lit(1)).alias("sentences"),
            F.greatest(count(t, r"[aeiouyáéíóúàèùâêîôû]++"), F.lit(1)).alias("syllables"),
            count(t, r"(?<![\p{L}\p{N}'])[\p{L}\p{N}'&&[^aeiouy]]*+(?:[aeiouy]++[\p{L}\p{N}'&&[^aeiouy]]++){2}[aeiouy]").alias("hard"),
            (F.length(t) - F.length(F.regexp_replace(t, r"[\p{L}\p{N}]++", ""))).alias("letters"),
        )
        return once(words, with_words)

    def indices(c: Column) -> Column:
        n, s, hard, letters = c["n"], c["sentences"], c["hard"], c["letters"]
        return F.struct(
            n.alias("words"), c["distinct"].alias("distinct_words"), s.alias("sentences"), per(c["distinct"], n).alias("type_token_ratio"), per(n, s).alias("sentence_length"),
            (206.835 - 1.015 * per(n, s) - 84.6 * per(c["syllables"], n)).alias("flesch_ease"), (0.39 * per(n, s) + 11.8 * per(c["syllables"], n) - 15.59).alias("flesch_grade"),
            (0.4 * (per(n, s) + 100 * per(hard, n))).alias("fog"), (1.043 * F.sqrt(hard * 30 / s) + 3.1291).alias("smog"),
            (4.71 * per(letters, n) + 0.5 * per(n, s) - 21.43).alias("automated_index"), (5.88 * per(letters, n) - 29.6 * per(s, n) - 15.8).alias("coleman_liau"),
        )

    return once(once(F.lower(clean_text(value)), counts), indices)
