"""Grouped, binned and calendar aggregation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.catalog.base import first_of_month, month_of, over, register, round_columns, rounded, sql_rounded as r
from tidemark.operators.aggregation import (
    binned_summary,
    compute_approval_rate,
    groupby_summary,
    grouped_totals,
    named_summary,
    rate_of,
    table_summary,
)
from tidemark.operators.calendar import by_day, by_month_start, by_month_text, resample_daily, resample_monthly
from tidemark.operators.quantiles import quantile_columns
from tidemark.operators.reshape import melt_summary, pivot_table_summary, stacked_groupby_unstack
from tidemark.operators.selection import sort_values
from tidemark.plans.jobs import loan_summary
from tidemark.plans.views import activity, loans, sales, table


@register("G1 O1", over("sales", f"""
    SELECT region, segment, {r('sum(sales)', 2)} AS sales, {r('avg(profit)', 4)} AS profit
    FROM sales GROUP BY region, segment"""))
def group_by_two_keys(spark: SparkSession, path: str) -> DataFrame:
    df = groupby_summary(
        sales(spark, path, ["region", "segment", "sales", "profit"]),
        ["region", "segment"], {"sales": "sum", "profit": "mean"},
    )
    return sort_values(round_columns(df, sales=2, profit=4), "sales", False)


@register("G2 G16", over("sales", f"""
    SELECT category, count(sales) AS sales_count, {r('sum(sales)', 2)} AS sales_sum,
           {r('avg(discount)')} AS discount_mean
    FROM sales GROUP BY category"""))
def group_many_aggregates(spark: SparkSession, path: str) -> DataFrame:
    df = groupby_summary(
        sales(spark, path, ["category", "sales", "discount"]),
        "category", {"sales": ["count", "sum"], "discount": "mean"},
    )
    return round_columns(df, sales_sum=2, discount_mean=6)


@register("G3", over("sales", f"""
    SELECT customer_id, {r('sum(sales)', 2)} AS total_sales, {r('avg(profit)', 4)} AS avg_profit
    FROM sales GROUP BY customer_id"""))
def group_named_aggregates(spark: SparkSession, path: str) -> DataFrame:
    df = named_summary(
        sales(spark, path, ["customer_id", "sales", "profit"]),
        "customer_id", total_sales=("sales", "sum"), avg_profit=("profit", "mean"),
    )
    return round_columns(df, total_sales=2, avg_profit=4)


@register("G4", over("loans", f"""
    SELECT loan_purpose, {r("avg(CASE WHEN approved = 'yes' THEN 1.0 ELSE 0.0 END)")} AS approval_rate
    FROM loans GROUP BY loan_purpose"""))
def approval_rate_by_purpose(spark: SparkSession, path: str) -> DataFrame:
    return round_columns(compute_approval_rate(loans(spark, path), "loan_purpose"), approval_rate=6)


@register("G5 D1", over("loans", f"""
    SELECT segment, {r('avg(loan_amount)', 4)} AS loan_amount,
           {r("avg(CASE WHEN approved = 'yes' THEN 1.0 ELSE 0.0 END)")} AS approved,
           count(customer_id) AS customer_id,
           {r('max(income) - min(income)', 4)} AS income
    FROM loans GROUP BY segment"""))
def group_user_aggregates(spark: SparkSession, path: str) -> DataFrame:
    df = groupby_summary(loans(spark, path), "segment", {
        "loan_amount": "mean",
        "approved": rate_of("yes"),
        "customer_id": "count",
        "income": lambda c: F.max(c) - F.min(c),
    })
    return round_columns(df, loan_amount=4, approved=6, income=4)


@register("G6", over("sales", f"""
    SELECT {r('sum(sales)', 2)} AS sales, {r('sum(profit)', 2)} AS profit, {r('avg(discount)')} AS discount
    FROM sales"""))
def whole_table_kpis(spark: SparkSession, path: str) -> DataFrame:
    df = table_summary(
        sales(spark, path, ["sales", "profit", "discount"]), {"sales": "sum", "profit": "sum", "discount": "mean"}
    )
    return round_columns(df, sales=2, profit=2, discount=6)


@register("G7", over("sales", f"""
    SELECT category, {r('sum(sales)', 2)} AS sales, {r('sum(profit)', 2)} AS profit,
           sum(quantity) AS quantity
    FROM sales GROUP BY category"""))
def group_column_totals(spark: SparkSession, path: str) -> DataFrame:
    df = grouped_totals(
        sales(spark, path, ["category", "sales", "profit", "quantity"]), "category", ["sales", "profit", "quantity"]
    )
    return round_columns(df, sales=2, profit=2)


@register("G7", over("sales", f"""
    SELECT region, {r('avg(profit)', 4)} AS profit FROM sales GROUP BY region"""))
def group_column_means(spark: SparkSession, path: str) -> DataFrame:
    df = grouped_totals(sales(spark, path, ["region", "profit"]), "region", ["profit"], "mean")
    return round_columns(df, profit=4)


@register("G8", over("sales", f"""
    SELECT region, {r('quantile_cont(sales, 0.1)', 4)} AS p10, {r('quantile_cont(sales, 0.5)', 4)} AS p50,
           {r('quantile_cont(sales, 0.9)', 4)} AS p90
    FROM sales GROUP BY region"""))
def quantiles_by_region(spark: SparkSession, path: str) -> DataFrame:
    df = quantile_columns(
        sales(spark, path, ["region", "sales"]), "sales", {"p10": 0.1, "p50": 0.5, "p90": 0.9}, "region"
    )
    return round_columns(df.drop("column"), p10=4, p50=4, p90=4)


@register("G9", over("activity", """
    , purchases AS (SELECT date, sum(new_cases) AS n FROM activity GROUP BY date)
    SELECT last_day(m) AS date, CAST(coalesce(sum(n), 0) AS BIGINT) AS new_cases
    FROM (SELECT CAST(unnest(generate_series(min(date_trunc('month', date)), max(date_trunc('month', date)),
                 INTERVAL 1 MONTH)) AS DATE) AS m FROM activity)
    LEFT JOIN purchases ON date_trunc('month', date) = m GROUP BY m"""))
def resample_events_monthly(spark: SparkSession, path: str) -> DataFrame:
    return resample_monthly(activity(spark, path), "date", {"new_cases": "sum"})


@register("G9", f"""
    WITH o AS (SELECT date_trunc('month', o_orderdate) AS m, o_totalprice AS v FROM orders
               WHERE month(o_orderdate) NOT IN (7, 8))
    SELECT last_day(CAST(s AS DATE)) AS order_date, {r('coalesce(sum(v), 0)', 2)} AS o_totalprice_sum,
           count(v) AS o_totalprice_count, {r('avg(v)', 4)} AS o_totalprice_mean
    FROM (SELECT unnest(generate_series(min(m), max(m), INTERVAL 1 MONTH)) AS s FROM o)
    LEFT JOIN o ON o.m = s GROUP BY s""")
def resample_monthly_with_gaps(spark: SparkSession, path: str) -> DataFrame:
    """Orders outside the summer months: the series has gaps to fill."""
    orders = table(spark, path, "orders").withColumn("order_date", F.col("o_orderdate").cast("date"))
    df = resample_monthly(
        orders.filter(~F.month("order_date").isin(7, 8)), "order_date", {"o_totalprice": ["sum", "count", "mean"]}
    )
    return round_columns(df, o_totalprice_sum=2, o_totalprice_mean=4)


@register("G10 C5", f"""
    WITH o AS (SELECT CAST(o_orderdate AS DATE) AS d, o_totalprice AS v FROM orders
               WHERE dayofweek(o_orderdate) NOT IN (0, 6))
    SELECT CAST(s AS DATE) AS order_date, {r('coalesce(sum(v), 0)', 2)} AS o_totalprice
    FROM (SELECT unnest(generate_series(min(d), max(d), INTERVAL 1 DAY)) AS s FROM o)
    LEFT JOIN o ON o.d = s GROUP BY s""")
def resample_workdays_daily(spark: SparkSession, path: str) -> DataFrame:
    """Orders of working days only: weekends are the gaps."""
    orders = table(spark, path, "orders").withColumn("order_date", F.col("o_orderdate").cast("date"))
    df = resample_daily(orders.filter(F.weekday("order_date") < 5), "order_date", {"o_totalprice": "sum"})
    return round_columns(df.fillna(0), o_totalprice=2)


@register("G11 X11", over("sales", f"""
    SELECT {first_of_month('order_date')} AS month, {r('sum(sales)', 2)} AS sales, {r('sum(profit)', 2)} AS profit
    FROM sales GROUP BY 1"""))
def group_by_month_start(spark: SparkSession, path: str) -> DataFrame:
    df = by_month_start(
        sales(spark, path, ["order_date", "sales", "profit"]), "order_date", {"sales": "sum", "profit": "sum"}
    )
    return round_columns(df, sales=2, profit=2)


@register("G12 V5", over("sales", f"""
    SELECT {month_of('order_date')} AS month, {r('sum(sales)', 2)} AS sales, {r('sum(profit)', 2)} AS profit
    FROM sales GROUP BY 1"""))
def group_by_month_text(spark: SparkSession, path: str) -> DataFrame:
    df = by_month_text(
        sales(spark, path, ["order_date", "sales", "profit"]), "order_date", {"sales": "sum", "profit": "sum"}
    )
    return round_columns(df, sales=2, profit=2)


@register("G13", over("sales", f"""
    SELECT order_date, {r('sum(sales)', 2)} AS sales FROM sales GROUP BY order_date"""))
def group_by_day(spark: SparkSession, path: str) -> DataFrame:
    df = by_day(sales(spark, path, ["order_date", "sales"]), "order_date", {"sales": "sum"})
    return round_columns(df, sales=2)


@register("G14", over("sales", f"""
    SELECT region, {month_of('order_date')} AS month, {r('sum(sales)', 2)} AS sales, {r('sum(profit)', 2)} AS profit
    FROM sales GROUP BY 1, 2"""))
def group_by_region_month(spark: SparkSession, path: str) -> DataFrame:
    df = by_month_text(
        sales(spark, path, ["region", "order_date", "sales", "profit"]),
        "order_date", {"sales": "sum", "profit": "sum"}, also_by="region",
    )
    return round_columns(df, sales=2, profit=2)


@register("G15 R12", f"""
    WITH bins AS (SELECT * FROM (VALUES (1, 10), (10, 20), (20, 30), (30, 40), (40, 50), (50, 60), (60, 70)) v(lo, hi))
    SELECT '[' || lo || ', ' || hi || ')' AS size_bracket, {r('avg(p_retailprice)', 4)} AS avg_price,
           count(p_partkey) AS parts
    FROM bins LEFT JOIN part ON p_size >= lo AND p_size < hi GROUP BY lo, hi""")
def group_by_bins(spark: SparkSession, path: str) -> DataFrame:
    """The last bin holds no part and is listed all the same."""
    df = binned_summary(
        table(spark, path, "part"), "p_size", [1, 10, 20, 30, 40, 50, 60, 70], "size_bracket",
        avg_price=("p_retailprice", "mean"), parts=("p_partkey", "count"),
    )
    return round_columns(df, avg_price=4)


@register("G16", """
    SELECT c_mktsegment, count(nullif(c_acctbal > 5000, false)) AS rich_count, count(*) AS customers
    FROM customer GROUP BY c_mktsegment""")
def group_count_non_null(spark: SparkSession, path: str) -> DataFrame:
    customer = table(spark, path, "customer").withColumn("rich", F.when(F.col("c_acctbal") > 5000, True))
    return named_summary(
        customer, "c_mktsegment", rich_count=("rich", "count"), customers=("c_custkey", "size")
    )


@register("G1 G2", f"""
    SELECT l_returnflag, l_linestatus, {r('median(l_extendedprice)', 4)} AS l_extendedprice_median,
           first(l_extendedprice ORDER BY l_shipdate, l_orderkey, l_linenumber) AS l_extendedprice_first,
           last(l_extendedprice ORDER BY l_shipdate, l_orderkey, l_linenumber) AS l_extendedprice_last,
           count(*) AS l_quantity_count, CAST(sum(l_quantity) AS BIGINT) AS l_quantity_sum, {r('median(l_quantity)', 4)} AS l_quantity_median
    FROM lineitem GROUP BY 1, 2""")
def group_order_statistics(spark: SparkSession, path: str) -> DataFrame:
    """Medians, first and last values beside a sum and a count."""
    df = groupby_summary(
        table(spark, path, "lineitem"), ["l_returnflag", "l_linestatus"],
        {"l_extendedprice": ["median", "first", "last"], "l_quantity": ["count", "sum", "median"]},
        order_by=["l_shipdate", "l_orderkey", "l_linenumber"],
    )
    df = round_columns(df, l_extendedprice_median=4, l_quantity_median=4)
    return df.withColumn("l_quantity_sum", F.col("l_quantity_sum").cast("long"))


TWO_COLUMNS = [(status, number) for status in "FO" for number in range(1, 8)]


@register("G17", "SELECT l_returnflag, " + ", ".join(
    f"""sum(l_quantity) FILTER (l_linestatus = '{s}' AND l_linenumber = {n}) AS "{s}_{n}" """ for s, n in TWO_COLUMNS) + " FROM lineitem GROUP BY 1")
def pivot_by_two_columns(spark: SparkSession, path: str) -> DataFrame:
    """One column for every combination that occurs; the lines are read once."""
    return pivot_table_summary(table(spark, path, "lineitem"), "l_returnflag", ["l_linestatus", "l_linenumber"], "l_quantity", "sum")


@register("G17", over("sales", f"""
    SELECT region, {', '.join(f"{r(f"avg(CASE WHEN category = '{c}' THEN sales END)", 4)} AS {c}"
                              for c in ('ECONOMY', 'LARGE', 'MEDIUM', 'PROMO', 'SMALL', 'STANDARD'))}
    FROM sales GROUP BY region"""))
def pivot_region_by_category(spark: SparkSession, path: str) -> DataFrame:
    df = pivot_table_summary(sales(spark, path, ["region", "category", "sales"]), "region", "category", "sales", "mean")
    return df.select("region", *[rounded(c, 4).alias(c) for c in df.columns if c != "region"])


@register("G18", over("sales", f"""
    SELECT region, segment, {', '.join(f"{r(f"coalesce(sum(CASE WHEN category = '{c}' THEN sales END), 0)", 2)} AS {c}"
                                       for c in ('ECONOMY', 'LARGE', 'MEDIUM', 'PROMO', 'SMALL', 'STANDARD'))}
    FROM sales GROUP BY region, segment"""))
def stack_and_unstack(spark: SparkSession, path: str) -> DataFrame:
    df = stacked_groupby_unstack(
        sales(spark, path, ["region", "segment", "category", "sales"]), ["region", "segment", "category"],
        "sales", "category",
    )
    keys = ["region", "segment"]
    return df.select(*keys, *[rounded(c, 2).alias(c) for c in df.columns if c not in keys])


@register("G19", over("sales", f"""
    SELECT region, category, {r('sum(sales)', 2)} AS sales FROM sales GROUP BY region, category"""))
def melt_pivot(spark: SparkSession, path: str) -> DataFrame:
    wide = pivot_table_summary(sales(spark, path, ["region", "category", "sales"]), "region", "category", "sales", "sum")
    return round_columns(melt_summary(wide.fillna(0), "region", "category", "sales"), sales=2)


@register("G20", """
    SELECT l_returnflag, sum(l_quantity) AS l_quantity_sum, """ + r("avg(l_quantity)") + """ AS l_quantity_mean
    FROM lineitem GROUP BY l_returnflag""")
def group_without_sort(spark: SparkSession, path: str) -> DataFrame:
    df = groupby_summary(table(spark, path, "lineitem"), "l_returnflag", {"l_quantity": ["sum", "mean"]})
    return round_columns(df, l_quantity_mean=6)


@register("G1 J5", over("loans", f"""
    SELECT loan_purpose, {r('sum(loan_amount)', 2)} AS total_loan, {r('avg(income)', 4)} AS avg_income,
           {r("avg(CASE WHEN approved = 'yes' THEN 1.0 ELSE 0.0 END)")} AS approval_rate
    FROM loans GROUP BY loan_purpose"""))
def loan_purpose_summary(spark: SparkSession, path: str) -> DataFrame:
    return round_columns(loan_summary(loans(spark, path)), total_loan=2, avg_income=4, approval_rate=6)


NAN_LINES = "SELECT l_returnflag AS flag, CASE WHEN l_linenumber = 1 THEN NULL WHEN l_linenumber = 2 THEN NULL ELSE l_quantity END AS quantity FROM lineitem"


@register("G1 G2", f"""
    SELECT flag, coalesce(sum(quantity), 0) AS total, max(quantity) AS most, count(quantity) AS n FROM ({NAN_LINES}) GROUP BY flag""")
def group_with_nan_and_null(spark: SparkSession, path: str) -> DataFrame:
    """NaN counts as missing, as NULL does."""
    lines = table(spark, path, "lineitem").select(
        F.col("l_returnflag").alias("flag"),
        F.expr("CASE WHEN l_linenumber = 1 THEN NULL WHEN l_linenumber = 2 THEN double('NaN') ELSE l_quantity END").alias("quantity"),
    )
    return groupby_summary(lines, "flag", {"quantity": ["sum", "max", "count"]}).toDF("flag", "total", "most", "n")
