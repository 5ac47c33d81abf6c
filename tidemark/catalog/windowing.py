"""Windows, ranks, sorts and limits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.catalog.base import first_of_month, month_of, over, register, round_columns, sql_rounded as r
from tidemark.operators.aggregation import groupby_summary, named_summary
from tidemark.operators.calendar import by_month_start, by_month_text, resample_daily
from tidemark.operators.ranking import rank_values
from tidemark.operators.selection import head, nlargest, sort_values, tail, top_groups_detail
from tidemark.operators.windows import (
    cumulative_sum, forward_fill, grouped_eval, grouped_transform, growth, pct_change, rolling_apply, rolling_mean, rolling_rank,
)
from tidemark.plans.views import sales, shipments, table

MONTHLY = f""", m AS (SELECT {month_of('order_date')} AS month, sum(sales) AS sales, sum(profit) AS profit
    FROM sales GROUP BY 1)"""
REGIONAL = f""", m AS (SELECT region, {month_of('order_date')} AS month, sum(sales) AS sales, sum(profit) AS profit
    FROM sales GROUP BY 1, 2)"""


def _monthly(spark: SparkSession, path: str) -> DataFrame:
    return by_month_text(
        sales(spark, path, ["order_date", "sales", "profit"]), "order_date", {"sales": "sum", "profit": "sum"}
    )


def _regional(spark: SparkSession, path: str, group: str = "region") -> DataFrame:
    return by_month_text(
        sales(spark, path, [group, "order_date", "sales", "profit"]),
        "order_date", {"sales": "sum", "profit": "sum"}, also_by=group,
    )


@register("W1", over("sales", MONTHLY + f"""
    SELECT month, CASE WHEN count(profit) OVER w >= 3 THEN {r('avg(profit) OVER w', 2)} END AS rolling_profit
    FROM m WINDOW w AS (ORDER BY month ROWS 2 PRECEDING)"""))
def rolling_mean_full_windows(spark: SparkSession, path: str) -> DataFrame:
    df = rolling_mean(_monthly(spark, path), "profit", 3, "month", small_groups=True)
    return round_columns(df.select("month", "rolling_profit"), rolling_profit=2)


@register("W1", """
    SELECT o_orderkey, CASE WHEN count(*) OVER w >= 50 THEN """ + r("avg(o_totalprice) OVER w", 2) + """ END AS rolling_price
    FROM orders WINDOW w AS (ORDER BY o_orderdate, o_orderkey ROWS 49 PRECEDING)""")
def rolling_mean_over_orders(spark: SparkSession, path: str) -> DataFrame:
    """Every order in date order, with no partition key: computed over tiles."""
    orders = table(spark, path, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    df = rolling_mean(orders, "o_totalprice", 50, ["o_orderdate", "o_orderkey"], new_col="rolling_price")
    return round_columns(df.select("o_orderkey", "rolling_price"), rolling_price=2)


@register("W2", over("sales", REGIONAL + f"""
    SELECT region, month, {r('avg(profit) OVER (PARTITION BY region ORDER BY month ROWS 2 PRECEDING)', 2)} AS rolling_profit
    FROM m"""))
def rolling_mean_by_region(spark: SparkSession, path: str) -> DataFrame:
    df = rolling_mean(_regional(spark, path), "profit", 3, "month", "region", min_periods=1, small_groups=True)
    return round_columns(df.select("region", "month", "rolling_profit"), rolling_profit=2)


@register("W2 D2", """
    SELECT event_id, """ + r("avg(value) OVER (PARTITION BY event_type ORDER BY ts, event_id ROWS 9 PRECEDING)", 4) + """ AS rolling_value
    FROM events""")
def rolling_mean_by_event_type(spark: SparkSession, path: str) -> DataFrame:
    """Few, large groups: tiles cut each of them."""
    events = table(spark, path, "events").select("event_id", "event_type", "ts", "value")
    df = rolling_mean(events, "value", 10, ["ts", "event_id"], "event_type", min_periods=1, tile_rows=1_000)
    return round_columns(df.select("event_id", "rolling_value"), rolling_value=4)


@register("W3 G10", over("sales", f"""
    , d AS (SELECT order_date, sum(sales) AS sales FROM sales GROUP BY 1),
      g AS (SELECT CAST(s AS DATE) AS order_date, coalesce(sales, 0) AS sales
            FROM (SELECT unnest(generate_series(min(order_date), max(order_date), INTERVAL 1 DAY)) AS s FROM d)
            LEFT JOIN d ON order_date = s)
    SELECT order_date, CASE WHEN count(sales) OVER w >= 7 THEN {r('avg(sales) OVER w', 2)} END AS sales
    FROM g WINDOW w AS (ORDER BY order_date ROWS 6 PRECEDING)"""))
def seven_day_mean(spark: SparkSession, path: str) -> DataFrame:
    daily = resample_daily(sales(spark, path, ["order_date", "sales"]), "order_date", {"sales": "sum"})
    df = rolling_mean(daily, "sales", 7, "order_date", new_col="smooth", small_groups=True)
    return round_columns(df.select("order_date", F.col("smooth").alias("sales")), sales=2)


@register("W4", over("sales", MONTHLY + f"""
    SELECT month, {r('sum(sales) OVER (ORDER BY month)', 2)} AS cumulative_sales FROM m"""))
def cumulative_monthly_sales(spark: SparkSession, path: str) -> DataFrame:
    df = cumulative_sum(_monthly(spark, path), "sales", "month", new_col="cumulative_sales", small_groups=True)
    return round_columns(df.select("month", "cumulative_sales"), cumulative_sales=2)


@register("W4", """
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity,
           sum(l_quantity) OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice ROWS UNBOUNDED PRECEDING) AS running
    FROM lineitem""")
def cumulative_quantity(spark: SparkSession, path: str) -> DataFrame:
    """Every order line in one table-wide order: computed over range blocks."""
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    df = cumulative_sum(table(spark, path, "lineitem").select(*keys), "l_quantity", keys, new_col="running")
    return df.drop("l_extendedprice")


RANKED = """(SELECT *, rank() OVER ({part} ORDER BY {value} DESC) + (count(*) OVER (PARTITION BY {ties}) - 1) / 2.0 AS {name} FROM {source})"""


@register("W5", """
    SELECT s_suppkey, CAST(price_rank AS DOUBLE) AS price_rank FROM """ + RANKED.format(
        part="", value="q", ties="q", name="price_rank",
        source="(SELECT l_suppkey AS s_suppkey, sum(l_quantity) AS q FROM lineitem GROUP BY 1)"))
def rank_suppliers(spark: SparkSession, path: str) -> DataFrame:
    totals = table(spark, path, "lineitem").groupBy(F.col("l_suppkey").alias("s_suppkey")).agg(F.sum("l_quantity").alias("q"))
    return rank_values(totals, "q", ascending=False, new_col="price_rank").select("s_suppkey", "price_rank")


@register("W5", """
    SELECT l_orderkey, l_linenumber, l_partkey, CAST(quantity_rank AS DOUBLE) AS quantity_rank FROM """ + RANKED.format(
        part="", value="l_quantity", ties="l_quantity", name="quantity_rank", source="lineitem"))
def rank_lines_with_ties(spark: SparkSession, path: str) -> DataFrame:
    """Fifty distinct quantities: ties share the average rank."""
    df = table(spark, path, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    return rank_values(df, "l_quantity", ascending=False, new_col="quantity_rank", stored=True).drop("l_quantity")


@register("W6", over("sales", """
    SELECT region, customer_id, CAST(sales_rank AS DOUBLE) AS sales_rank FROM """ + RANKED.format(
        part="PARTITION BY region", value="quantity", ties="region, quantity", name="sales_rank",
        source="(SELECT region, customer_id, sum(quantity) AS quantity FROM sales GROUP BY 1, 2)")))
def rank_customers_in_region(spark: SparkSession, path: str) -> DataFrame:
    """Five groups however many customers there are."""
    totals = groupby_summary(
        sales(spark, path, ["region", "customer_id", "quantity"]), ["region", "customer_id"], {"quantity": "sum"}
    )
    ranked = rank_values(totals, "quantity", "region", ascending=False, new_col="sales_rank")
    return ranked.select("region", "customer_id", "sales_rank")


@register("W7 D3", """
    WITH e AS (SELECT event_id, event_type, ts, floor(value) AS value FROM events),
         f AS (SELECT *, list(value) OVER (PARTITION BY event_type ORDER BY ts, event_id ROWS 4 PRECEDING) AS recent FROM e)
    SELECT event_id, CAST(1 + len(list_filter(recent, lambda x: x > value))
           + (len(list_filter(recent, lambda x: x = value)) - 1) / 2.0 AS DOUBLE) AS rolling_rank_value
    FROM f""")
def rank_in_trailing_window(spark: SparkSession, path: str) -> DataFrame:
    events = table(spark, path, "events").select("event_id", "event_type", "ts", F.floor("value").cast("double").alias("value"))
    df = rolling_rank(events, "event_type", "value", 5, order_col=["ts", "event_id"], tile_rows=1_000)
    return df.select("event_id", "rolling_rank_value")


@register("D3 W1", """
    SELECT event_id, CASE WHEN count(value) OVER w >= 5 THEN """ + r("(sum(value) OVER w - min(value) OVER w - max(value) OVER w) / 3", 4) + """ END AS trimmed_mean
    FROM events WINDOW w AS (ORDER BY ts, event_id ROWS 4 PRECEDING)""")
def trimmed_mean_in_window(spark: SparkSession, path: str) -> DataFrame:
    """A function of the last five values, all events in one order, over tiles of 1,000 rows."""
    def trimmed(recent: Column) -> Column:
        total = F.aggregate(recent, F.lit(0.0), lambda a, x: a + x)
        return (total - F.array_min(recent) - F.array_max(recent)) / 3

    events = table(spark, path, "events").select("event_id", "ts", "value")
    df = rolling_apply(events, "value", 5, trimmed, ["ts", "event_id"], new_col="trimmed_mean", tile_rows=1_000)
    return round_columns(df.select("event_id", "trimmed_mean"), trimmed_mean=4)


@register("W11 D2", """
    SELECT event_id, """ + r("(value - avg(value) OVER ()) / stddev_samp(value) OVER ()", 6) + """ AS score,
           """ + r("value / max(value) OVER (PARTITION BY event_type)", 6) + """ AS share_of_best
    FROM events""")
def user_transform_in_large_groups(spark: SparkSession, path: str) -> DataFrame:
    """Transforms made of group aggregates and a row part: all events as one group, then few large groups."""
    events = table(spark, path, "events").select("event_id", "event_type", "value", F.when(F.col("event_id").isNotNull(), "all").alias("everything"))
    state = {"mean": F.avg("value"), "std": F.stddev_samp("value")}
    df = grouped_transform(events, "everything", "score", state, lambda g: (F.col("value") - g["mean"]) / g["std"])
    df = grouped_transform(df, "event_type", "share_of_best", {"best": F.max("value")}, lambda g: F.try_divide(F.col("value"), g["best"]))
    return round_columns(df.select("event_id", "score", "share_of_best"), score=6, share_of_best=6)


@register("W8", over("sales", MONTHLY + f"""
    SELECT month, {r('sales / lag(sales) OVER (ORDER BY month) - 1')} AS sales_pct_change FROM m"""))
def monthly_growth(spark: SparkSession, path: str) -> DataFrame:
    df = pct_change(_monthly(spark, path), "sales", "month", small_groups=True)
    return round_columns(df.select("month", "sales_pct_change"), sales_pct_change=6)


@register("W8", """
    WITH f AS (SELECT d.doc_id, n_chars AS v
               FROM documents d)
    SELECT doc_id, """ + r("CAST(v AS DOUBLE) / nullif(lag(v) OVER (ORDER BY doc_id), 0) - 1") + """ AS n_chars_pct_change FROM f""")
def growth_over_documents(spark: SparkSession, path: str) -> DataFrame:
    """Table-wide order over every document: range blocks and tiles."""
    df = pct_change(table(spark, path, "documents").select("doc_id", "n_chars"), "n_chars", "doc_id")
    return round_columns(df.select("doc_id", "n_chars_pct_change"), n_chars_pct_change=6)


@register("W9 W11 D2", over("sales", f"""
    , m AS (SELECT category, {month_of('order_date')} AS month, sum(sales) AS sales FROM sales GROUP BY 1, 2)
    SELECT category, month, {r('sales / lag(sales) OVER (PARTITION BY category ORDER BY month) - 1')} AS pct_change
    FROM m"""))
def growth_by_category(spark: SparkSession, path: str) -> DataFrame:
    df = grouped_eval(_regional(spark, path, "category"), "category", "sales", "pct_change", growth, order_by="month")
    return round_columns(df.select("category", "month", "pct_change"), pct_change=6)


@register("W9", over("sales", REGIONAL + f"""
    SELECT region, month, {r('sales / lag(sales) OVER (PARTITION BY region ORDER BY month) - 1')} AS growth FROM m"""))
def growth_by_region(spark: SparkSession, path: str) -> DataFrame:
    df = pct_change(_regional(spark, path), "sales", "month", "region", "growth", small_groups=True)
    return round_columns(df.select("region", "month", "growth"), growth=6)


@register("W10 W11", over("sales", REGIONAL + """
    , g AS (SELECT region, month, sales / lag(sales) OVER (PARTITION BY region ORDER BY month) - 1 AS growth FROM m)
    SELECT region, month, CASE WHEN growth IS NOT NULL THEN
        CAST(rank() OVER (PARTITION BY region ORDER BY growth DESC NULLS LAST) + (count(*) OVER (PARTITION BY region, growth) - 1) / 2.0 AS DOUBLE)
        END AS sales_growth_rank
    FROM g"""))
def rank_of_growth(spark: SparkSession, path: str) -> DataFrame:
    """A window over a window: two steps."""
    grown = grouped_eval(_regional(spark, path), "region", "sales", "growth", growth, order_by="month")
    df = rank_values(grown, "growth", "region", ascending=False, new_col="sales_growth_rank", small_groups=True)
    return df.select("region", "month", "sales_growth_rank")


@register("W11 D2", over("sales", REGIONAL + f"""
    SELECT region, month, {r('profit - avg(profit) OVER (PARTITION BY region)', 2)} AS above_mean FROM m"""))
def user_transform_in_groups(spark: SparkSession, path: str) -> DataFrame:
    df = grouped_eval(_regional(spark, path), "region", "profit", "above_mean", lambda c, w: c - F.avg(c).over(w))
    return round_columns(df.select("region", "month", "above_mean"), above_mean=2)


@register("C6 W9", """
    SELECT event_id, last_value(CASE WHEN value > 80 THEN value END IGNORE NULLS)
           OVER (PARTITION BY event_type ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS last_peak
    FROM events""")
def fill_forward_in_groups(spark: SparkSession, path: str) -> DataFrame:
    events = table(spark, path, "events").select(
        "event_id", "event_type", "ts", F.when(F.col("value") > 80, F.col("value")).alias("peak")
    )
    df = forward_fill(events, "peak", ["ts", "event_id"], "event_type", "last_peak")
    return df.select("event_id", "last_peak")


@register("O1", "SELECT c_custkey, c_mktsegment, c_acctbal FROM customer")
def sort_two_keys(spark: SparkSession, path: str) -> DataFrame:
    df = table(spark, path, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    return sort_values(df, ["c_mktsegment", "c_acctbal"], [True, False])


@register("O2", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 100")
def first_hundred(spark: SparkSession, path: str) -> DataFrame:
    """The first hundred rows are the feature."""
    return head(table(spark, path, "orders").select("o_orderkey", "o_totalprice"), 100, ["o_totalprice", "o_orderkey"])


@register("O3 D4", over("sales", f"""
    SELECT customer_id, {r('sum(sales)', 2)} AS total_sales FROM sales GROUP BY customer_id
    ORDER BY sum(sales) DESC, customer_id LIMIT 5"""))
def five_best_customers(spark: SparkSession, path: str) -> DataFrame:
    """Top five as a table function in a chain."""
    df = named_summary(sales(spark, path, ["customer_id", "sales"]), "customer_id", total_sales=("sales", "sum"))
    return round_columns(df.transform(nlargest, 5, "total_sales", "customer_id"), total_sales=2)


@register("O4", over("sales", f"""
    , best AS (SELECT category FROM sales GROUP BY category ORDER BY sum(profit) DESC, category LIMIT 3)
    SELECT category, {month_of('order_date')} AS month, {r('sum(profit)', 2)} AS profit
    FROM sales WHERE category IN (SELECT category FROM best) GROUP BY 1, 2"""))
def detail_of_best_groups(spark: SparkSession, path: str) -> DataFrame:
    lines = sales(spark, path, ["category", "order_date", "profit"])
    detail = top_groups_detail(lines, "category", "profit", 3)
    return round_columns(by_month_text(detail, "order_date", {"profit": "sum"}, "category"), profit=2)


@register("O5", over("sales", f"""
    SELECT month, {r('sales', 2)} AS sales FROM (SELECT {first_of_month('order_date')} AS month, sum(sales) AS sales
    FROM sales GROUP BY 1) ORDER BY month DESC LIMIT 5"""))
def last_five_months(spark: SparkSession, path: str) -> DataFrame:
    monthly = by_month_start(sales(spark, path, ["order_date", "sales"]), "order_date", {"sales": "sum"})
    return tail(round_columns(monthly, sales=2), 5, "month")


@register("W1 W4 G11", over("shipments", f"""
    , m AS (SELECT {first_of_month('date')} AS month, sum(hospitalized) AS quantity FROM shipments GROUP BY 1)
    SELECT month, quantity, sum(quantity) OVER (ORDER BY month) AS cumulative,
           CASE WHEN count(*) OVER w >= 3 THEN {r('avg(quantity) OVER w', 4)} END AS rolling_avg_3mo
    FROM m WINDOW w AS (ORDER BY month ROWS 2 PRECEDING)"""))
def cumulative_and_rolling(spark: SparkSession, path: str) -> DataFrame:
    monthly = by_month_start(
        shipments(spark, path).withColumnRenamed("hospitalized", "quantity"), "date", {"quantity": "sum"}
    )
    df = cumulative_sum(monthly, "quantity", "month", new_col="cumulative", small_groups=True)
    df = rolling_mean(df, "quantity", 3, "month", new_col="rolling_avg_3mo", small_groups=True)
    return round_columns(df, rolling_avg_3mo=4)
