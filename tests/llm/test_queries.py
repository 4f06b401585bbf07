import pytest

from dossierlake.llm.queries import queries

FOUND = {
    "p1_found": ["row_id", "group_row_id"], "p3_found": ["train_row_id", "test_row_id"], "p4_found": ["row_id", "ref_id"], "p6_found": ["row_id", "side"],
    "p7_found": ["classification", "year"], "p8_ids": ["doc_id", "ids"], "p10_found": ["doc_id", "kind", "start_at"],
}


@pytest.mark.parametrize("name", sorted(FOUND))
def test_columns(spark, small, name):
    df = queries()[name](spark, small)
    assert df.columns == FOUND[name]
    assert dict(df.dtypes).get("start_at", "int") == "int" and dict(df.dtypes).get("year", "int") == "int"
    df.collect()


@pytest.mark.parametrize("name", sorted(set(queries()) - set(FOUND)))
def test_others_run(spark, small, name):
    assert queries()[name](spark, small).collect() is not None


def test_every_row_is_mapped(spark, small):
    df, meta = (spark.read.parquet(f"{small}/{t}.parquet") for t in ("df", "df_meta"))
    want = {r[0] for r in df.where("trim(country) != ''").select("row_id").collect()} | {r[0] for r in meta.where("trim(title) != ''").select("row_id").collect()}
    rows = [r["row_id"] for r in queries()["p4_found"](spark, small).collect()]
    assert len(rows) == len(set(rows)) and set(rows) <= want and len(want - set(rows)) <= 3


def test_every_row_has_a_group(spark, small):
    rows = queries()["p1_found"](spark, small).collect()
    ids = {r["row_id"] for r in rows}
    assert len(ids) == len(rows) == spark.read.parquet(f"{small}/training.parquet").count()
    assert all(r["group_row_id"] <= r["row_id"] and r["group_row_id"] in ids for r in rows)
