from __future__ import annotations

import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import functions as F, types as T

from tests.conftest import values
from tidemark import functions as fn
from tidemark.functions.expressions import spark_text
from tidemark.functions import evaluate, query
from tidemark.operators import columns as ops
from tidemark.operators.profile import distinct_counts
from tidemark.operators.selection import slice_rows
from tidemark.operators.narrowing import narrow_types, optimize_dataframe


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()[0]


def test_names(frame):
    df = frame({" Order ID": [1], "Sub-Category": [2]})
    assert ops.normalize_names(df).columns == ["order_id", "sub_category"]
    with pytest.raises(ValueError):
        ops.normalize_names(frame({"a b": [1], "A-B": [2]}))


def test_column_edits(frame):
    df = frame({"A": [1, -1], "B": [5, 6]})
    assert values(ops.update_where(df, F.col("A") > 0, "B", 100), "B") == [100, 6]
    assert values(ops.assign(df, c=lambda d: d.A + d.B, d=lambda d: d.c * 2), "d") == [12, 10]
    assert ops.rename_columns(df, {"A": "z"}).columns == ["z", "B"]
    assert ops.drop_columns(df, ["A"]).columns == ["B"]
    assert values(ops.cast_columns(df, {"A": "string"}), "A") == ["1", "-1"]
    assert values(ops.apply_to_column(df, "A", F.abs), "A") == [1, 1]
    with pytest.raises(KeyError):
        ops.select_columns(df, ["nope"])


def test_one_hot(frame):
    df = ops.one_hot(frame({"k": ["a", "b", None]}, "k string"), "k")
    assert df.columns == ["k_a", "k_b"]
    assert values(df, "k_a", "k_b") == [(True, False), (False, True), (False, False)]


def test_pandas_function_on_elements(frame):
    double = F.pandas_udf(lambda s: s * 2, "long")
    assert values(ops.apply_to_column(frame({"a": [1, 2]}), "a", double), "a") == [2, 4]


@pytest.mark.parametrize("text, want", [
    ("a / b", "a / nullif(b, 0)"),
    ("a / (b - c) * 2", "a / nullif((b - c), 0) * 2"),
    ("a / abs(b) + 1", "a / nullif(abs(b), 0) + 1"),
    ("s == 'a/b' and x/y > 1", "s == 'a/b' and x/ nullif(y, 0) > 1"),
    ("x / 1e-3", "x / nullif(1e-3, 0)"),
    ("x / case when a > 1 then 2 else 3 end + 1", "x / nullif(case when a > 1 then 2 else 3 end, 0) + 1"),
    ("k % z", "k % nullif(z, 0)"),
    ("a * b // c + 1", "floor(a * b / nullif(c, 0)) + 1"),
    ("f(a, b) // g(c)[1]", "floor(f(a, b) / nullif(g(c)[1], 0))"),
    ("a ** 2 + `b/c` / -m['k']", "power(a, 2) + `b/c` / nullif(-m['k'], 0)"),
    ("(a > 1) & (b in ['x', 'y']) | (c == 'p&q')", "(a > 1)  AND  (b in ('x', 'y'))  OR  (c == 'p&q')"),
    ("a || b", "a || b"),
    ("a / (b / c)", "a / nullif((b / nullif(c, 0)), 0)"),
])
def test_divisor_rewrite(text, want):
    assert spark_text(text) == want


def test_string_expressions(frame):
    df = frame({"A": [11, 12, 5], "B": [0, 4, 1], "C": ["value", "value", "x"]})
    assert values(fn.query(df, 'A > 10 and B < 20 and C == "value"'), "A") == [11, 12]
    assert values(fn.evaluate(df, "r = A / B"), "r") == [None, 3.0, 5.0]
    assert values(fn.evaluate(df, "r = A / 1e-1"), "r") == [110.0, 120.0, 50.0]
    assert values(fn.evaluate(df, "r = A % B"), "r") == [None, 0, 0]
    assert values(fn.evaluate(df, "r = A // B"), "r") == [None, 3, 5]
    assert values(fn.query(df, '(C in ["x", "y"]) | (A ** 2 > 130) & (B < 9)'), "A") == [12, 5]
    with pytest.raises(ValueError):
        fn.evaluate(df, "A == B")


def test_bins(frame):
    df = frame({"age": [19, 20, 29, 30, 70, 69]})
    got = values(df.select(fn.cut("age", [20, 30, 40, 50, 60, 70]).alias("b")), "b")
    assert got == [None, "[20, 30)", "[20, 30)", "[30, 40)", None, "[60, 70)"]
    with pytest.raises(ValueError):
        fn.cut("age", [3, 2])


def test_parsing(spark):
    text = F.lit
    assert one(spark, fn.parse_date(text("2024-02-30"))) is None
    assert one(spark, fn.parse_date(text("29.02.2024"), "dd.MM.yyyy")) == dt.date(2024, 2, 29)
    assert one(spark, fn.parse_timestamp(text("nonsense"))) is None
    assert one(spark, fn.parse_number(text("1e3"))) == 1000.0
    assert one(spark, fn.parse_number(text("n/a"))) is None


def test_dictionary_map(frame):
    df = frame({"c": ["USA", "India", "Mars", None]}, "c string")
    assert values(df.select(fn.map_values("c", {"USA": "West", "India": "East"}).alias("r")), "r") == ["West", "East", None, None]


def test_text(spark):
    assert one(spark, fn.trim(F.lit("\t a b \n"))) == "a b"
    assert one(spark, fn.normalize(F.lit("  NEW \t  York "))) == "new york"
    assert one(spark, fn.extract(F.lit("ab12"), r"(\d+)")) == "12"
    assert one(spark, fn.extract(F.lit("ab"), r"(\d+)")) is None
    assert one(spark, fn.last_part(F.lit("loan_final_east.csv"), "_", ".csv")) == "east"
    assert one(spark, fn.contains(F.lit(None).cast("string"), "x")) is False
    assert one(spark, fn.contains(F.lit("a+b"), "A+B", case=False, regex=False)) is True
    assert one(spark, fn.replace_literal(F.lit("a b"), " ", "_")) == "a_b"


def test_dates(spark):
    d = F.lit(dt.date(2024, 2, 10))  # a Saturday
    assert [one(spark, f(d)) for f in (fn.year, fn.month, fn.day, fn.weekday_number)] == [2024, 2, 10, 5]
    assert one(spark, fn.day_name(d)) == "Saturday" and one(spark, fn.is_weekend(d)) is True
    assert one(spark, fn.month_start(d)) == dt.date(2024, 2, 1) and one(spark, fn.month_end(d)) == dt.date(2024, 2, 29)
    assert one(spark, fn.month_text(d)) == "2024-02" and one(spark, fn.month_label(d)) == "Feb 2024"


def test_numbers(spark):
    assert one(spark, fn.currency(F.lit(1234.5))) == "$1,234.50"
    assert one(spark, fn.thousands(F.lit(1234567))) == "1,234,567"
    assert one(spark, fn.ratio(F.lit(1), F.lit(0))) is None
    assert one(spark, fn.percent(F.lit(1), F.lit(4))) == 25.0
    assert one(spark, fn.case_rate(F.lit(5), F.lit(1000))) == 500.0
    assert one(spark, fn.absolute(F.lit(-3))) == 3


def test_narrowing_keeps_values(frame):
    data = pd.DataFrame({
        "small": [1, -128, 127], "mid": [1, 40_000, 2], "big": [2**40, 0, 1], "f": [1.1, 2.2, 3.3],
        "wide": [1e300, 1.0, 2.0], "fine": [123456.78, 1.01, 2.02], "s": ["a", "b", "c"],
    })
    df = frame(data)
    kinds = {c: t.simpleString() for c, t in narrow_types(df).items()}
    assert kinds == {"small": "tinyint", "mid": "int", "f": "float"}
    # the same columns keep double precision in pandas
    for c in ("f", "wide", "fine"):
        assert (pd.to_numeric(data[c], downcast="float").dtype == "float32") == (c in kinds)
    out = optimize_dataframe(df, ["s"], verbose=False).toPandas()
    for c in ("small", "mid", "big", "f", "wide", "fine"):
        assert out[c].astype(float).tolist() == pytest.approx(data[c].astype(float).tolist(), rel=1e-5)


def test_narrowing_warns_on_unknown_category(frame):
    with pytest.warns(UserWarning, match="Ship Mode"):
        optimize_dataframe(frame({"a": [1]}), ["Ship Mode"])


def test_narrowing_large_table_is_smaller(spark, tmp_path):
    df = spark.range(100_000).select((F.col("id") % 100).alias("n"), (F.col("id") % 7 * 0.5).alias("x"), F.lit("k").alias("s"))
    slim = optimize_dataframe(df, verbose=False)
    width = {"bigint": 8, "double": 8, "float": 4, "tinyint": 1, "string": 0}
    size = lambda d: sum(width[f.dataType.simpleString()] for f in d.schema.fields)
    assert size(slim) < 0.9 * size(df)
    assert isinstance(slim.schema["n"].dataType, T.ByteType)


def test_powers_group_from_the_right_and_negation(frame):
    df = frame({"x": [2, 3], "flag": [True, False]})
    assert values(evaluate(df, "y = 2 ** 3 ** 2"), "y") == [512.0, 512.0]
    assert values(evaluate(df, "y = -x ** 2 + 1"), "y") == [-3.0, -8.0]
    assert values(evaluate(df, "y = x ** -1 ** 2"), "y") == [0.5, pytest.approx(1 / 3)]
    assert values(query(df, "~(x > 2)"), "x") == [2]
    assert values(query(df, "~flag & x == 3"), "x") == [3]
    assert values(query(df, "~~flag | ~(x < 10)"), "x") == [2]


def test_slice_sorts_only_what_is_near(spark, frame, monkeypatch):
    from tidemark.operators import selection

    monkeypatch.setattr(selection, "LITTLE", 50)
    sorted_rows = []
    monkeypatch.setattr(selection, "row_positions", lambda rows, *a, keep=selection.row_positions: sorted_rows.append(rows.count()) or keep(rows, *a))
    rows = [(None if i % 50 == 0 else float(i * 7919 % 1000), f"k{i:05d}" if i % 3 else None, i) for i in range(5000)]
    df = spark.createDataFrame(rows, "x double, s string, i int")
    want = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] is None, r[1] or "", r[2]))
    for start, stop in ((0, 10), (2000, 2030), (4990, 5000), (4999, 9000), (100, 3000), (7000, 7001), (5, 5)):
        got = slice_rows(df, start, stop, ["x", "s", "i"], ["i", "x"])
        assert sorted(values(got, "i")) == sorted(r[2] for r in want[start:stop])
    assert sorted_rows[1] < 500  # of 5,000
    same = frame({"x": [1] * 300, "i": range(300)})
    assert values(slice_rows(same, 299, 300, ["x", "i"], ["i"]), "i") == [299]


def test_distinct_counts_read_once(spark, frame):
    df = frame({"a": [1.0, 1.0, None, 2.0], "b": ["x", None, None, "x"], "c": [0.0, -0.0, 1.5, None], "d": [None] * 4}, "a double, b string, c double, d int")
    found = distinct_counts(df)
    assert {r.column: r.distinct for r in found.collect()} == {"a": 2, "b": 1, "c": 2, "d": 0}
    assert {r.column: r.distinct for r in distinct_counts(df, ["b"]).collect()} == {"b": 1}
    assert {r.distinct for r in distinct_counts(df.limit(0)).collect()} == {0}
