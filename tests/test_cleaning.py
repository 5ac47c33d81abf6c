from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.conftest import values
from tidemark.operators.cleaning import (
    align_customer_ids, clean_dataframe, drop_duplicates, fill_nulls, forward_fill, standardize_strings,
)
from tidemark.operators.filters import (
    count_outliers_iqr, detect_outliers_iqr, equals, is_member, search_text,
)
from tidemark.operators import profile


def test_drop_null_rows(frame):
    df = frame({"A": [1.0, 2.0, None, 4.0], "B": [5.0, None, 7.0, 8.0], "C": ["x", "y", "z", "w"]})
    cleaned = clean_dataframe(df, drop_na_cols=["A"])
    assert cleaned.count() == 3 and cleaned.filter("A IS NULL").count() == 0


def test_dedupe(frame):
    assert clean_dataframe(frame({"A": [1, 2, 2, 3], "B": [4, 5, 5, 6]})).count() == 3


def test_strings_are_normalised_before_dedupe(frame):
    df = frame({"Name": ["  Alice  ", "alice", "BOB \t X"], "City": ["NEW  YORK", "new york", "chicago "]})
    assert values(clean_dataframe(df).orderBy("Name"), "Name", "City") == [("alice", "new york"), ("bob x", "chicago")]


def test_null_strings(frame):
    df = frame({"s": ["A", None]}, "s string")
    assert values(clean_dataframe(df), "s").count(None) == 1
    assert "nan" in values(clean_dataframe(df, null_token="nan"), "s")


def test_no_cleaning_asked(frame):
    df = frame({"s": [" A", " A"]})
    assert values(clean_dataframe(df, dedupe=False, clean_strings=False), "s") == [" A", " A"]


def test_standardize_leaves_numbers(frame):
    df = standardize_strings(frame({"Name": ["  ALICE  ", "bob", "CHARLIE  "], "Number": [1, 2, 3]}))
    assert values(df, "Name", "Number") == [("alice", 1), ("bob", 2), ("charlie", 3)]


def test_empty_table(spark):
    empty = spark.createDataFrame([], "a int, s string")
    assert clean_dataframe(empty).count() == 0
    assert drop_duplicates(empty).columns == ["a", "s"]


def test_missing_column(frame):
    with pytest.raises(KeyError):
        clean_dataframe(frame({"A": [1]}), drop_na_cols=["Z"])


def test_align_ids(frame):
    assert values(align_customer_ids(frame({"customer_id": [1001, 1002]})), "customer_id") == ["1001", "1002"]
    assert align_customer_ids(frame({"x": [1]})).columns == ["x"]


def test_fills(frame):
    df = frame({"t": [1, 2, 3, 4, 5], "v": [None, 1.0, None, None, 2.0]})
    assert values(fill_nulls(df).orderBy("t"), "v") == [0.0, 1.0, 0.0, 0.0, 2.0]
    for small in (True, False):
        filled = forward_fill(df, "v", "t", small_groups=small)
        assert values(filled.orderBy("t"), "v") == [None, 1.0, 1.0, 1.0, 2.0]


def test_outliers(frame):
    df = frame({"values": [1, 2, 3, 4, 5, 6, 7, 8, 9, 100], "flat": [1] * 10})
    assert values(detect_outliers_iqr(df, "values"), "values") == [100]
    assert dict(values(count_outliers_iqr(df, ["values", "flat"]), "column", "outliers")) == {"values": 1, "flat": 0}


def test_outliers_of_no_values(frame):
    assert detect_outliers_iqr(frame({"x": [None, None]}, "x double"), "x").count() == 0


def test_outlier_filter_reaches_the_scan(spark, frame, tmp_path):
    frame({"x": [1.0, 2.0, 3.0, 50.0]}).write.parquet(str(tmp_path / "t"))
    found = detect_outliers_iqr(spark.read.parquet(str(tmp_path / "t")), "x")
    assert "PushedFilters: [Or(LessThan(x" in found._jdf.queryExecution().executedPlan().toString()


def test_membership_and_search(frame):
    df = frame({"s": ["Alpha", "beta", None], "n": [1, 2, 3]})
    assert values(df.select(is_member("s", ["beta"]).alias("m")), "m") == [False, True, False]
    assert values(search_text(df, "ALP|zz"), "n") == [1]
    assert values(equals(df, "n", 3), "s") == [None]


def test_profile(frame):
    df = frame({"a": [1.0, None, 1.0], "s": ["x", "y", "x"]})
    assert values(profile.missing_values(df), "column", "missing") == [("a", 1)]
    assert values(profile.count_duplicates(df), "duplicates") == [1]
    assert values(profile.shape(df), "rows", "columns") == [(3, 2)]
    assert values(profile.value_counts(df, "s"), "s", "count") == [("x", 2), ("y", 1)]
    assert dict(values(profile.distinct_counts(df), "column", "distinct")) == {"a": 1, "s": 2}
    assert dict(values(profile.distinct_counts(df, approximate=True), "column", "distinct")) == {"a": 1, "s": 2}
    assert values(profile.column_info(df).orderBy("position"), "column", "dtype", "non_null", "nulls") == [
        ("a", "double", 2, 1), ("s", "string", 3, 0)
    ]
    assert values(profile.distinct_values(df, "s"), "s") == ["x", "y"]
    assert profile.load_dataset_summary(df, rows=2).count() == 2


def test_describe_matches_pandas(frame):
    import pandas as pd

    data = pd.DataFrame({"v": [3.0, 1.0, 4.0, 1.0, 5.0, 9.0, 2.0, 6.0]})
    got = profile.describe(frame(data)).first().asDict()
    want = data["v"].describe()
    for mine, theirs in {"count": "count", "mean": "mean", "std": "std", "min": "min", "q25": "25%", "q50": "50%", "q75": "75%", "max": "max"}.items():
        assert got[mine] == pytest.approx(want[theirs])
