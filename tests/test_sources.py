import json

import pytest

from kinfold.operators import blocking as B
from kinfold.sources import io, store

ROWS = [("S1-1", 'Ott "and" Sons', "12 High\tStreet", "US"), ("S1-2", "", "NA", "null"), ("S1-3", "Żubr", "", "PL")]
COLUMNS = "entity_id string, business_name string, business_address string, country string"


def test_tsv_columns_and_limit(spark, tmp_path):
    path = str(tmp_path / "t")
    io.write_tsv(spark.createDataFrame(ROWS, COLUMNS), path)
    read = lambda *c, **k: sorted(tuple(r) for r in io.read_tsv(spark, path, *c, **k).collect())
    assert read() == ROWS
    assert read(("country", "entity_id")) == sorted((r[3], r[0]) for r in ROWS)
    assert read(("business_name",), multi_line=True) == sorted((r[1],) for r in ROWS)
    assert len(read(limit=2)) == 2
    with pytest.raises(Exception, match="nowhere"):
        io.read_tsv(spark, path, ("nowhere",)).collect()


def test_ids_parquet_and_reports(spark, tmp_path):
    df = spark.createDataFrame(ROWS, COLUMNS)
    io.write_ids(df.select("entity_id").filter("entity_id <> 'S1-3'"), str(tmp_path / "ids"))
    ids = io.read_ids(spark, str(tmp_path / "ids"))
    assert sorted(r.entity_id for r in io.only_ids(df, ids.unionByName(ids), "entity_id").collect()) == ["S1-1", "S1-2"]
    for name in ("a", "b"):
        io.write_parquet(df, str(tmp_path / "deep" / f"x_{name}.parquet"))
        io.write_parquet(df.limit(1), str(tmp_path / "deep" / f"x_{name}.parquet"))
    assert io.find_parquet(spark, str(tmp_path / "deep"), "*.parquet").count() == 2
    got = io.read_columns(spark, [str(tmp_path / "deep" / f"x_{name}.parquet") for name in ("a", "b")], ["country"])
    assert got.columns == ["country"] and got.count() == 2
    io.write_report(df.select("entity_id"), str(tmp_path / "report"))
    assert io.count_rows(spark, str(tmp_path / "ids")).first().n_rows == 1
    settings = {"rare_df": 7, "thresholds": {"US": 0.5}}
    io.write_settings(settings, str(tmp_path / "s.json"))
    assert io.read_settings(str(tmp_path / "s.json")) == settings == json.loads((tmp_path / "s.json").read_text())


def test_lists_order_by_score(spark):
    pairs = spark.createDataFrame([("a", "x", 0.2), ("a", "y", 0.9), ("b", "z", 0.1)], "s1_entity_id string, candidate_entity_id string, score double")
    got = {r[0]: r[1] for r in io.id_lists(pairs, spark.createDataFrame([("a",), ("b",), ("c",)], "id string")).collect()}
    assert got == {"a": "y,x", "b": "z", "c": ""}


def test_store_is_read_again(spark):
    assert store.stored(spark.range(5).toDF("id"), "five").count() == 5


@pytest.mark.parametrize("most", [1, 2, 3])
def test_keys_take_the_first_numbers_only(spark, most):
    """Passes that use two numbers take them from the first `max_nums`, longest first."""
    norm = spark.createDataFrame([("S1-1", "US", "ott sons", "7 alpha 19821 bravo charlie 305", "7 19821 305", "30415")], "entity_id string, country string, name_core string, addr_norm string, addr_nums string, postcode string")
    ranks = B.ranked(norm, B.frequencies(norm))
    got = {r.key.split("|", 1)[1] for r in B.keys(ranks, B.Settings(max_nums=most)).collect()}
    assert len([k for k in got if k.startswith("pn|")]) == min(most, 2)
    assert {k.split("|")[1] for k in got if k.startswith("ad|")} == {"19821", "305", "7"} & set(["19821", "305", "7"][:most])
