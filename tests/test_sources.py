from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from tests.conftest import values
from tidemark.sources import (
    export_csv,
    export_formats,
    load_csv,
    load_json,
    load_parquet,
    load_regional_csv,
    load_typed_csv,
    save_bucketed,
    save_by_region,
    save_csv,
    save_parquet,
)
from tidemark.operators.joins import join_on_index


def test_csv_round_trip_infers_types(spark, frame, tmp_path):
    save_csv(frame({"A": [1, 2], "B": [3, 4]}), str(tmp_path / "t.csv"))
    back = load_csv(str(tmp_path / "t.csv"), spark=spark).orderBy("A")
    assert values(back, "A", "B") == [(1, 3), (2, 4)]


def test_csv_creates_parent_folders(spark, frame, tmp_path):
    target = tmp_path / "a" / "b" / "t.csv"
    export_csv(frame({"X": [1, 2, 3]}), str(target))
    assert target.exists() and load_csv(str(target), spark=spark).count() == 3


def test_csv_with_dates_and_nan(spark, tmp_path):
    (tmp_path / "t.csv").write_text("d,x\n31/12/2023,NaN\n01/02/2024,1.5\n")
    df = load_typed_csv(str(tmp_path / "t.csv"), "d date, x double", date_format="dd/MM/yyyy", spark=spark)
    assert [(str(d), x) for d, x in values(df.orderBy("d"), "d", "x")] == [("2023-12-31", None), ("2024-02-01", 1.5)]


def test_parquet_round_trip(spark, frame, tmp_path):
    save_parquet(frame({"col1": [1, 2, 3], "col2": ["a", "b", "c"], "col3": [1.1, 2.2, 3.3]}), str(tmp_path / "p"))
    back = load_parquet(str(tmp_path / "p"), spark).orderBy("col1")
    assert values(back, "col1", "col2", "col3") == [(1, "a", 1.1), (2, "b", 2.2), (3, "c", 3.3)]


def test_parquet_nan_as_null(spark, tmp_path):
    spark.sql("SELECT double('NaN') AS x UNION ALL SELECT 1.0D").write.parquet(str(tmp_path / "n"))
    assert load_parquet(str(tmp_path / "n"), spark, nan_as_null=True).filter("x IS NULL").count() == 1


def test_json_array_and_lines(spark, tmp_path):
    rows = [{"name": "Ann", "age": 30}, {"name": "Bo", "age": 25}]
    (tmp_path / "a.json").write_text(json.dumps(rows, indent=2))
    (tmp_path / "l.json").write_text("\n".join(json.dumps(r) for r in rows))
    (tmp_path / "m.json").write_text(json.dumps(rows[:1]) + "\n" + json.dumps(rows[1:]))
    for name, lines in (("a.json", False), ("l.json", True), ("m.json", True)):
        df = load_json(str(tmp_path / name), "name string, age int", lines=lines, spark=spark)
        assert values(df, "name", "age") == [("Ann", 30), ("Bo", 25)]


@pytest.mark.parametrize("load", [load_csv, load_json, load_parquet])
def test_missing_file(spark, tmp_path, load):
    with pytest.raises(FileNotFoundError):
        load(str(tmp_path / "nothing"), spark=spark)


def test_regional_files_of_unequal_length(spark, tmp_path):
    (tmp_path / "loan_final_east.csv").write_text("id,v\n1,10\n2,20\n3,30\n")
    (tmp_path / "loan_final_west.csv").write_text("id,v\n4,40\n")
    df = load_regional_csv(str(tmp_path / "loan_final_*.csv"), "id long, v long", spark=spark).orderBy("id")
    assert values(df, "id", "region") == [(1, "east"), (2, "east"), (3, "east"), (4, "west")]


def test_regional_files_keep_their_own_column(spark, tmp_path):
    (tmp_path / "loan_x.csv").write_text("id,region\n1,North\n")
    assert values(load_regional_csv(str(tmp_path / "loan_*.csv"), spark=spark), "region") == ["North"]


def test_fan_out_by_region(spark, frame, tmp_path):
    save_by_region(frame({"region": ["e", "w", "e"], "v": [1, 2, 3]}), str(tmp_path / "r"))
    assert {p.name for p in (tmp_path / "r").iterdir() if p.is_dir()} == {"region=e", "region=w"}
    assert load_parquet(str(tmp_path / "r"), spark).filter(F.col("region") == "e").count() == 2


def test_export_formats(spark, frame, tmp_path):
    paths = export_formats(frame({"a": [1, 2]}), str(tmp_path / "rep"))
    assert [load_csv(paths[0], spark=spark).count(), load_parquet(paths[1], spark).count()] == [2, 2]


def test_bucketed_tables_join_without_shuffle(spark, frame):
    save_bucketed(frame({"k": [1, 2, 3], "a": [1, 2, 3]}), "bucketed_left", "k", 4)
    save_bucketed(frame({"k": [2, 3, 4], "b": [5, 6, 7]}), "bucketed_right", "k", 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        joined = join_on_index(spark.table("bucketed_left"), spark.table("bucketed_right"), "k")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan
        assert values(joined.orderBy("k"), "k", "b") == [(1, None), (2, 5), (3, 6)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
