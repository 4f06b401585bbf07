"""Queries p1, p3, p4, p6 to p10."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from dossierlake.functions.text import isbn_digits, present, read_year, strip
from dossierlake.llm import bpe, canonical, mixing, overlap, pieces, private, quota, splits
from dossierlake.session import cut_lineage, shared_path, table, text_table, write_shared


def country_trie(spark: SparkSession, d: str) -> canonical.Trie:
    return canonical.build_trie(table(spark, d, "country_reference"), "ref_id", "country", "country_1", "iso3")


def consultation_keys(spark: SparkSession, df: DataFrame, d: str) -> DataFrame:
    """(row_id, report, consultation): the keys that link rows of training; null where unknown."""
    picked = df.select("row_id", isbn_digits(F.col("print_isbn")).alias("report"), read_year(F.col("year")).alias("year"), present(F.col("country")).alias("country"))
    found = canonical.map_names(picked, "country", country_trie(spark, d))
    best = F.filter("candidates", lambda c: c["distance"] == F.col("candidates")[0]["distance"])
    ids = found.select(F.col("name").alias("country"), F.when(F.size(best) == 1, best[0]["ref_id"]).alias("ref_id")).where("ref_id is not null")
    joined = picked.where("country is not null").join(ids, "country", "left").unionByName(picked.where("country is null").withColumn("ref_id", F.lit(None).cast("long")))
    return joined.select("row_id", "report", F.concat_ws("/", "ref_id", "year").alias("c"), "ref_id", "year").select("row_id", "report", F.when(F.col("ref_id").isNotNull() & F.col("year").isNotNull(), F.col("c")).alias("consultation"))


def p1_components(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    keyed = cut_lineage(consultation_keys(spark, table(spark, d, "training"), d))
    return splits.update_components(keyed, "row_id", {"report": F.col("report"), "consultation": F.col("consultation")})


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    _, rows, _ = p1_components(spark, d)
    return rows.select(F.col("id").alias("row_id"), F.col("component").alias("group_row_id"))


def p1_shares(spark: SparkSession, d: str) -> DataFrame:
    """The splits of training and the shares they reach."""
    _, rows, _ = p1_components(spark, d)
    return splits.split_report(splits.assign_splits(rows))


def deliveries(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    """training in two deliveries by time of arrival, the second with what the first has stored: keyed rows, rows with components, merges, and the splits before and after."""
    training = table(spark, d, "training")
    keyed = cut_lineage(consultation_keys(spark, training, d).join(training.select("row_id", "loaded_at"), "row_id"))
    middle = training.select(F.percentile_approx("loaded_at", 0.5).alias("m")).first()["m"]
    keys = {"report": F.col("report"), "consultation": F.col("consultation")}
    first, rows, _ = splits.update_components(keyed.where(F.col("loaded_at") <= F.lit(middle)), "row_id", keys)
    stored = shared_path(spark)
    splits.store(first, splits.assign_splits(rows), stored)
    known, before = splits.load(spark, stored)
    _, later, merges = splits.update_components(keyed.where(F.coalesce(F.col("loaded_at") > F.lit(middle), F.lit(True))), "row_id", keys, known)
    after = cut_lineage(splits.assign_splits(later, known=before, merges=merges))
    return {"keyed": keyed, "first": rows, "later": later, "merges": cut_lineage(merges), "before": before, "after": after}


def p1_incremental(spark: SparkSession, d: str) -> DataFrame:
    """The splits of two deliveries: the second keeps those of the first and quarantines conflicts."""
    return splits.split_report(deliveries(spark, d)["after"])


def p1_kept(spark: SparkSession, d: str) -> DataFrame:
    """One row: the rows of both deliveries, the known components that changed their split, and the keys whose rows are in two splits; the last two are to be 0."""
    t = deliveries(spark, d)
    moved_to = t["before"].select("component", F.col("split").alias("was")).join(t["merges"], "component", "left").withColumn("component", F.coalesce("merged_into", "component"))
    moved = moved_to.join(t["after"], "component").where((F.col("split") != F.col("was")) & (F.col("split") != splits.QUARANTINE))
    rows = t["first"].join(t["merges"], "component", "left").select("id", F.coalesce("merged_into", "component").alias("component")).unionByName(t["later"].select("id", "component"))
    placed = rows.join(t["after"].select("component", "split"), "component").join(t["keyed"], F.col("id") == F.col("row_id"))
    keyed = placed.select("split", F.explode(F.array(F.struct(F.lit("report").alias("kind"), F.col("report").alias("key")), F.struct(F.lit("consultation").alias("kind"), F.col("consultation").alias("key")))).alias("k")).where("k.key is not null")
    torn = keyed.groupBy("k").agg(F.min("split").alias("a"), F.max("split").alias("b")).where("a != b")
    one = lambda df, name: df.agg(F.count("*").alias(name))
    return one(placed, "n_rows").crossJoin(one(moved, "n_moved")).crossJoin(one(torn, "n_torn"))  # three single rows


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    pairs = overlap.cross_split_pairs(text_table(spark, d, "training"), text_table(spark, d, "testing"), "row_id", "staff", isbn_digits(F.col("print_isbn")))
    return pairs.select(F.col("train_id").alias("train_row_id"), F.col("test_id").alias("test_row_id"))


def p3_coverage(spark: SparkSession, d: str) -> DataFrame:
    """How much of each row of testing training has: pairs, the share of words its best match leaves unchanged, and the share in shared passages."""
    testing = text_table(spark, d, "testing")
    found = overlap.cross_split_coverage(text_table(spark, d, "training"), testing, "row_id", "staff", isbn_digits(F.col("print_isbn")))
    return found.withColumnRenamed("test_id", "test_row_id").join(testing.select(F.col("row_id").alias("test_row_id"), "split", "label_source"), "test_row_id")


def p3_report(spark: SparkSession, d: str) -> DataFrame:
    """Pairs, rows of testing that overlap with training, and how much of the words of all rows training has, by split and label source."""
    words = F.coalesce("n_words", F.lit(0))
    share = lambda c: F.coalesce(F.sum(words * F.col(c)) / F.nullif(F.sum(words), F.lit(0)), F.lit(0.0)).alias(c)
    return p3_coverage(spark, d).groupBy("split", "label_source").agg(F.count("*").alias("n_rows"), F.count_if(F.col("n_pairs") > 0).alias("n_overlapping"), F.sum("n_pairs").alias("n_pairs"), share("aligned_share"), share("passage_share"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    trie = country_trie(spark, d)
    df = table(spark, d, "df").select("row_id", F.col("country").alias("name"))
    title = F.when(F.trim(F.regexp_replace("title", r"(?U)\s+", " ")) != "", F.coalesce(F.nullif(canonical.title_subject(F.col("title")), F.lit("")), F.col("title")))
    meta = table(spark, d, "df_meta").select("row_id", title.alias("name"))
    found = canonical.map_to_reference(df.unionByName(meta), "row_id", "name", trie)
    return found.select(F.col("id").alias("row_id"), "ref_id")


def p4_spelled(spark: SparkSession, d: str) -> DataFrame:
    """The entries of the rows of df whose country is spelled as the reference spells it, but for case and outer blanks."""
    ref, name = table(spark, d, "country_reference"), lambda c: F.lower(strip(F.col(c)))
    spelled = ref.select(name("country").alias("k")).unionByName(ref.select(name("country_1").alias("k"))).distinct()
    rows = table(spark, d, "df").select("row_id", name("country").alias("k")).join(spelled, "k", "left_semi").select("row_id")
    return p4_found(spark, d).join(rows, "row_id", "left_semi")


def p4_unmatched(spark: SparkSession, d: str) -> DataFrame:
    """The values of df.country that fit no entry, and how often each occurs."""
    df = table(spark, d, "df").select("row_id", "country")
    found = canonical.map_to_reference(df, "row_id", "country", country_trie(spark, d))
    return found.where("ref_id = 0").join(df, F.col("id") == F.col("row_id")).groupBy("country").agg(F.count("*").alias("n"))


def document_pieces(spark: SparkSession, d: str) -> DataFrame:
    both = pieces.sides(text_table(spark, d, "df_documents"), "row_id", ["staff", "buff"])
    return pieces.cut_texts(both, ["row_id", "side"], "text")


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return document_pieces(spark, d).where("piece_no = 1").select("row_id", "side")


def p6_pieces(spark: SparkSession, d: str) -> DataFrame:
    return document_pieces(spark, d)


def p6_rebuilt(spark: SparkSession, d: str) -> DataFrame:
    """Every cut text put together again from its pieces without their overlaps, as a hash, and whether its pieces keep the limit and the overlap."""
    p = document_pieces(spark, d).withColumn("end_at", F.col("begin_at") + F.col("n_chars") - 1)
    whole = p.groupBy("row_id", "side").agg(F.array_sort(F.collect_list(F.struct("piece_no", "begin_at", "end_at", "n_chars", "piece"))).alias("a"))  # grows with one text
    rest = F.transform("a", lambda x, i: F.when(i == 0, x["piece"]).otherwise(F.substr(x["piece"], F.lit(pieces.OVERLAP + 1))))
    steps = F.forall(F.transform("a", lambda x, i: (i == 0) | (x["begin_at"] == F.get(F.col("a"), i - 1)["end_at"] + 1 - pieces.OVERLAP)), lambda ok: ok)
    return whole.select("row_id", "side", F.md5(F.array_join(rest, "")).alias("whole"), (steps & F.forall("a", lambda x: x["n_chars"] <= pieces.LIMIT)).alias("within"))


#: Spellings of the groups of countries, without case, blanks and punctuation.
GROUPS = {
    "AEs": ("ae", "aes", "advanced", "advancedeconomy", "advancedeconomies"),
    "EMDEs": ("emde", "emdes", "emsdes", "emdevelopingeconomies", "emergingdeveloping", "emerginganddeveloping", "emergingmarkets", "emergingmarketanddevelopingeconomies", "emsanddes"),
    "LICs": ("lic", "lics", "lc", "lcs", "lowincome", "lowincomecountry", "lowincomecountries"),
}


def usable_rows(spark: SparkSession, d: str) -> DataFrame:
    """Rows of df with a readable group and year."""
    key = F.regexp_replace(F.lower("classification"), r"[^\p{L}]+", "")
    spelled = F.create_map(*(F.lit(x) for group, forms in GROUPS.items() for form in forms for x in (form, group)))
    df = table(spark, d, "df").withColumns({"classification": F.try_element_at(spelled, key), "year": read_year(F.col("year"))})
    return df.where("classification is not null and year is not null")


def quota_plan(spark: SparkSession, d: str, whole: bool = False) -> DataFrame:
    return quota.plan(usable_rows(spark, d), ["classification", "year"], table(spark, d, "sample_targets"), "target_permille", "min_rows", whole=whole)


def p7_plan(spark: SparkSession, d: str) -> DataFrame:
    """Rows there are, are needed and are taken by group and year, and whether the data and the sample have as many as are needed."""
    return quota_plan(spark, d)


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    """The targets that swap repair cannot reach even where every need is a floor."""
    return quota_plan(spark, d, whole=True).where("reached = false").select("classification", "year")


def p7_sample(spark: SparkSession, d: str) -> DataFrame:
    """The sample itself."""
    return quota.draw(usable_rows(spark, d), ["classification", "year"], quota_plan(spark, d), "row_id")


def p7_drawn(spark: SparkSession, d: str) -> DataFrame:
    """Whether the sample has as many different rows of each target as planned, and the target's floor as far as there are rows."""
    drawn = p7_sample(spark, d).groupBy("classification", "year").agg(F.count_distinct("row_id").alias("n_drawn"))
    planned = quota_plan(spark, d).where("needed is not null")
    floors = table(spark, d, "sample_targets").select("classification", "year", "min_rows")
    joined = planned.join(drawn, ["classification", "year"], "left").join(floors, ["classification", "year"], "left").withColumn("n_drawn", F.coalesce("n_drawn", F.lit(0)))
    return joined.select("classification", "year", "have", (F.col("n_drawn") == F.col("take")).alias("as_planned"), (F.col("n_drawn") >= F.least("have", F.coalesce("min_rows", F.lit(0)))).alias("has_floor"))


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    return bpe.encode(text_table(spark, d, "documents"), "doc_id", "text").select(F.col("id").alias("doc_id"), "ids")


def p8_decoded(spark: SparkSession, d: str) -> DataFrame:
    """Every document's ids decoded again, as a hash of the text."""
    return p8_ids(spark, d).select("doc_id", F.md5(bpe.decode(F.col("ids"))).alias("text"))


def source_tokens(spark: SparkSession, d: str) -> DataFrame:
    """(id, source, n): the tokens of each document. The counts are written first: a join's plan, which is kept in many versions, then holds no vocabulary."""
    counts = write_shared(bpe.encode(text_table(spark, d, "documents"), "doc_id", "text").select("id", F.size("ids").cast("long").alias("n")))
    sources = table(spark, d, "documents").select(F.col("doc_id").alias("id"), "source").where("source is not null")
    return write_shared(sources.join(counts, "id").select("id", "source", "n"))


def p9_mix(spark: SparkSession, d: str) -> DataFrame:
    """How often each document of the sources in mix_targets is used."""
    copies, _ = mixing.mix(source_tokens(spark, d), table(spark, d, "mix_targets"))
    return copies.select(F.col("id").alias("doc_id"), "source", F.col("n").alias("n_tokens"), "copies")


def p9_report(spark: SparkSession, d: str) -> DataFrame:
    """The shares reached, also of sources that fall short or are absent, and the tokens of a mix in which no source that is there falls short."""
    _, report = mixing.mix(source_tokens(spark, d), table(spark, d, "mix_targets"))
    return report


def p9_true_shares(spark: SparkSession, d: str) -> DataFrame:
    """The same for the largest mix in which the sources that are there keep their shares to each other."""
    _, report = mixing.mix(source_tokens(spark, d), table(spark, d, "mix_targets"), keep_shares=True)
    return report


def p9_kept(spark: SparkSession, d: str) -> DataFrame:
    """For each target source its documents with tokens, those used more than allowed (0), and whether it has its tokens but for one document."""
    tokens = source_tokens(spark, d)
    copies, report = mixing.mix(tokens, table(spark, d, "mix_targets"))
    caps = table(spark, d, "mix_targets").select("source", "max_repeats")
    per = copies.join(F.broadcast(caps), "source").groupBy("source").agg(F.count("*").alias("n_documents"), F.count_if(F.col("copies") > F.col("max_repeats")).alias("n_over"), F.max("n").alias("longest"), F.sum(F.col("n") * F.col("copies")).alias("sum"))
    close = F.col("short") | (F.abs(F.col("tokens_reached") - F.col("tokens_wanted")) <= F.coalesce("longest", F.lit(0)))
    same = F.coalesce(F.col("sum"), F.lit(0)) == F.col("tokens_reached")
    return report.join(per, "source", "left").select("source", "max_repeats", F.coalesce("n_documents", F.lit(0)).alias("n_documents"), F.coalesce("n_over", F.lit(0)).alias("n_over"), (close & same).alias("kept"))


def mentions(spark: SparkSession, d: str) -> DataFrame:
    names = private.given_names(table(spark, d, "given_names"), "given_name")
    return private.find_private(text_table(spark, d, "documents"), "doc_id", "text", names)


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return mentions(spark, d).select(F.col("id").alias("doc_id"), "kind", F.col("begin_at").alias("start_at"))


def p10_redacted(spark: SparkSession, d: str) -> DataFrame:
    """The texts with placeholders."""
    return private.redact(table(spark, d, "documents"), "doc_id", "text", mentions(spark, d)).select(F.col("id").alias("doc_id"), "text")


def p10_left(spark: SparkSession, d: str) -> DataFrame:
    """One row: the redacted texts, the null ones, and those in which an email address can still be read (0)."""
    text = F.col("text")
    return p10_redacted(spark, d).agg(F.count("text").alias("n_texts"), F.count_if(text.isNull()).alias("n_null"), F.count_if(text.rlike(r"[A-Za-z0-9]@[A-Za-z0-9-]+\.[A-Za-z]{2}")).alias("n_email"))


def queries() -> dict:
    return {k: f for k, f in globals().items() if k[0] == "p" and k[1].isdigit() and k != "p1_components" and callable(f)}
