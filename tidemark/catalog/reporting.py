"""Chart tables, reports and end-to-end jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark import functions as fn
from tidemark.catalog.base import first_of_month, month_of, over, register, round_columns, rounded, sql_normalize, sql_rounded as r
from tidemark.operators import reports
from tidemark.operators.aggregation import grouped_totals
from tidemark.operators.calendar import by_month_text
from tidemark.operators.filters import equals
from tidemark.operators.selection import sort_values
from tidemark.plans import jobs
from tidemark.plans.views import loans, sales, shipments, table
from tidemark.session import scratch_path
from tidemark.sources import load_csv, load_parquet


@register("V1", f"""
    WITH e AS (SELECT min(value) AS lo, max(value) AS hi FROM events)
    SELECT bin, {r('lo + bin * ((hi - lo) / 20)', 4)} AS bin_start, coalesce(n, 0) AS "count"
    FROM (SELECT range AS bin FROM range(20)) CROSS JOIN e LEFT JOIN (SELECT bin, count(*) AS n FROM (
    SELECT CAST(least(floor((value - lo) / ((hi - lo) / 20)), 19) AS BIGINT) AS bin FROM events, e WHERE value IS NOT NULL) GROUP BY bin) USING (bin)""")
def histogram_of_values(spark: SparkSession, path: str) -> DataFrame:
    return round_columns(reports.histogram(table(spark, path, "events"), "value", 20), bin_start=4)


@register("V2", over("sales", f"""
    , q AS (SELECT category, quantile_cont(profit, 0.25) AS q1, quantile_cont(profit, 0.5) AS median,
                   quantile_cont(profit, 0.75) AS q3 FROM sales GROUP BY category)
    SELECT category, {r('q1', 3)} AS q1, {r('median', 3)} AS median, {r('q3', 3)} AS q3,
           {r('min(CASE WHEN profit BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) THEN profit END)', 4)} AS lower_whisker,
           {r('max(CASE WHEN profit BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) THEN profit END)', 4)} AS upper_whisker,
           CAST(count_if(profit < q1 - 1.5 * (q3 - q1) OR profit > q3 + 1.5 * (q3 - q1)) AS BIGINT) AS outliers
    FROM sales JOIN q USING (category) GROUP BY category, q1, median, q3"""))
def box_of_profit(spark: SparkSession, path: str) -> DataFrame:
    df = reports.box_stats(sales(spark, path, ["category", "profit"]), "profit", "category")
    return round_columns(df, q1=3, median=3, q3=3, lower_whisker=4, upper_whisker=4)


@register("V2", """
    WITH q AS (SELECT event_type, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
                   quantile_cont(value, 0.75) AS q3 FROM events GROUP BY event_type)
    SELECT event_type, """ + f"{r('q1', 3)} AS q1, {r('median', 3)} AS median, {r('q3', 3)} AS q3," + """
           min(CASE WHEN value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) THEN value END) AS lower_whisker,
           max(CASE WHEN value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) THEN value END) AS upper_whisker,
           CAST(count_if(value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)) AS BIGINT) AS outliers
    FROM events JOIN q USING (event_type) GROUP BY event_type, q1, median, q3""")
def box_of_event_values(spark: SparkSession, path: str) -> DataFrame:
    """Skewed values, so there are outliers."""
    return round_columns(reports.box_stats(table(spark, path, "events"), "value", "event_type"), q1=3, median=3, q3=3)


@register("V3 V8", over("sales", f"SELECT region, {r('sum(sales)', 2)} AS sales FROM sales GROUP BY region"))
def sales_by_region(spark: SparkSession, path: str) -> DataFrame:
    df = grouped_totals(sales(spark, path, ["region", "sales"]), "region", ["sales"])
    return sort_values(round_columns(df, sales=2), "sales", False)


@register("V4", f"""
    SELECT c_mktsegment, count(*) AS "count", {r('count(*) * 100.0 / (SELECT count(*) FROM customer)')} AS percent
    FROM customer GROUP BY c_mktsegment""")
def segment_share(spark: SparkSession, path: str) -> DataFrame:
    return round_columns(reports.value_share(table(spark, path, "customer"), "c_mktsegment"), percent=6)


@register("V5 O1", over("sales", f"""
    SELECT {month_of('order_date')} AS month, {r('sum(profit)', 2)} AS profit FROM sales GROUP BY 1"""))
def monthly_profit_trend(spark: SparkSession, path: str) -> DataFrame:
    df = by_month_text(sales(spark, path, ["order_date", "profit"]), "order_date", {"profit": "sum"})
    return sort_values(round_columns(df, profit=2), "month")


@register("V6 F4", over("sales", f"""
    SELECT region, {month_of('order_date')} AS month, {r('sum(sales)', 2)} AS sales FROM sales
    WHERE region = 'ASIA' GROUP BY 1, 2"""))
def monthly_sales_of_one_region(spark: SparkSession, path: str) -> DataFrame:
    lines = equals(sales(spark, path, ["region", "order_date", "sales"]), "region", "ASIA")
    return sort_values(round_columns(by_month_text(lines, "order_date", {"sales": "sum"}, "region"), sales=2), "month")


@register("V7 R15", over("sales", f"""
    SELECT order_date, category, region, sub_category, {r('sales', 4)} AS sales, {r('profit', 4)} AS profit,
           {r('abs(profit)', 4)} AS size
    FROM sales"""))
def sales_scatter(spark: SparkSession, path: str) -> DataFrame:
    points = sales(spark, path, ["order_date", "category", "region", "sub_category", "sales", "profit"])
    points = points.withColumns({"order_date": F.col("order_date").cast("date"), "size": fn.absolute("profit")})
    return round_columns(points, sales=4, profit=4, size=4)


@register("V8", over("sales", f"""
    SELECT 'sales by segment' AS panel, segment AS name, {r('sum(sales)', 2)} AS amount FROM sales GROUP BY segment
    UNION ALL SELECT 'profit by region', region, {r('sum(profit)', 2)} FROM sales GROUP BY region"""))
def executive_overview(spark: SparkSession, path: str) -> DataFrame:
    lines = sales(spark, path, ["segment", "region", "sales", "profit"])
    both = reports.totals_by_each(lines, {"sales by segment": ("segment", "sales"), "profit by region": ("region", "profit")})
    return round_columns(both, amount=2)


@register("V9", """
    WITH m AS (SELECT l_shipdate, sum(l_quantity) AS quantity, count(*) AS lines FROM lineitem GROUP BY 1)
    SELECT CAST(l_shipdate AS DATE) AS date, quantity, lines, quantity = (SELECT max(quantity) FROM m) AS is_max_quantity,
           lines = (SELECT max(lines) FROM m) AS is_max_lines
    FROM m""")
def flag_maxima(spark: SparkSession, path: str) -> DataFrame:
    daily = table(spark, path, "lineitem").groupBy(F.col("l_shipdate").cast("date").alias("date")).agg(
        F.sum("l_quantity").alias("quantity"), F.count(F.lit(1)).alias("lines")
    )
    return reports.highlight_max(daily, ["quantity", "lines"])


@register("V10", f"""
    SELECT o_orderkey, {r('(o_totalprice - (SELECT min(o_totalprice) FROM orders)) / ((SELECT max(o_totalprice) FROM orders) - (SELECT min(o_totalprice) FROM orders))')} AS o_totalprice_intensity
    FROM orders""")
def gradient_of_prices(spark: SparkSession, path: str) -> DataFrame:
    df = reports.gradient(table(spark, path, "orders").select("o_orderkey", "o_totalprice"), ["o_totalprice"])
    return round_columns(df.select("o_orderkey", "o_totalprice_intensity"), o_totalprice_intensity=6)


@register("Q1", """
    SELECT o_orderkey AS order_key, CAST(o_orderdate AS DATE) AS order_date,
           CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS total_price FROM orders""")
def load_and_type_orders(spark: SparkSession, path: str) -> DataFrame:
    raw = table(spark, path, "orders").select(
        F.col("o_orderkey").alias("Order Key"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("Order-Date"),
        F.when(F.col("o_orderstatus") == "P", "open").otherwise(F.col("o_totalprice").cast("string")).alias("Total Price"),
    )
    return jobs.load_and_type(raw, dates=["order_date"], numbers=["total_price"])


@register("Q2 C1", f"""
    SELECT DISTINCT {sql_normalize('role')} AS role, {sql_normalize('text')} AS text, turn FROM conversations""")
def clean_conversations(spark: SparkSession, path: str) -> DataFrame:
    turns = table(spark, path, "conversations").select("role", "text", "turn")
    return jobs.clean_job(turns, ["text"], ["turn"]).cleaned


@register("Q3 G1", over("sales", f"""
    SELECT category, count(sales) AS sales_count, {r('sum(sales)', 2)} AS sales_sum, {r('avg(discount)')} AS discount_mean
    FROM sales GROUP BY category"""))
def category_statistics(spark: SparkSession, path: str) -> DataFrame:
    lines = sales(spark, path)
    tables = jobs.sales_aggregates(lines, ["category_stats"])
    return round_columns(tables["category_stats"], sales_sum=2, discount_mean=6)


@register("Q3 G17", over("sales", f"""
    SELECT segment, {', '.join(f"""{r(f"sum(CASE WHEN sub_category = 'Brand#{i}' THEN sales END)", 2)} AS "Brand#{i}" """ for i in range(1, 26))}
    FROM sales GROUP BY segment"""))
def segment_by_brand(spark: SparkSession, path: str) -> DataFrame:
    df = jobs.sales_aggregates(sales(spark, path), ["segment_by_sub_category"])["segment_by_sub_category"]
    return df.select("segment", *[rounded(F.col(f"`{c}`"), 2).alias(c) for c in df.columns if c != "segment"])


REPORT = f""", s AS (SELECT {month_of('order_date')} AS month, sum(sales) AS sales, sum(profit) AS profit FROM sales GROUP BY 1),
    c AS (SELECT {month_of('date')} AS month, sum(new_cases) AS new_cases, avg(hospitalized) AS hospitalized FROM shipments GROUP BY 1),
    rep AS (SELECT month, sales, profit, CAST(new_cases AS BIGINT) AS new_cases, hospitalized,
            CASE WHEN count(*) OVER w >= 3 THEN avg(profit) OVER w END AS rolling_profit,
            sales / lag(sales) OVER (ORDER BY month) - 1 AS sales_pct_change
            FROM s JOIN c USING (month) WINDOW w AS (ORDER BY month ROWS 2 PRECEDING))"""


def report(spark: SparkSession, path: str) -> DataFrame:
    return jobs.final_report(sales(spark, path, ["order_date", "sales", "profit"]), shipments(spark, path))


@register("Q3 O1 G1", over("sales", f"""
    SELECT region, segment, {r('sum(sales)', 2)} AS sales, {r('avg(profit)', 4)} AS profit FROM sales GROUP BY 1, 2"""))
def region_segment_summary(spark: SparkSession, path: str) -> DataFrame:
    df = jobs.sales_aggregates(sales(spark, path), ["region_segment"])["region_segment"]
    return round_columns(df, sales=2, profit=4)


@register("Q3 G7", over("sales", f"""
    SELECT category, {r('sum(sales)', 2)} AS sales, {r('sum(profit)', 2)} AS profit, sum(quantity) AS quantity FROM sales GROUP BY 1"""))
def category_totals(spark: SparkSession, path: str) -> DataFrame:
    df = jobs.sales_aggregates(sales(spark, path), ["category_totals"])["category_totals"]
    return round_columns(df, sales=2, profit=2)


@register("Q3 G9", over("sales", f"""
    SELECT last_day(m) AS order_date, {r('coalesce(sum(sales), 0.0)', 2)} AS sales, {r('coalesce(sum(profit), 0.0)', 2)} AS profit
    FROM (SELECT CAST(unnest(generate_series(date_trunc('month', min(order_date)), max(order_date), INTERVAL 1 MONTH)) AS DATE) AS m FROM sales)
    LEFT JOIN sales ON date_trunc('month', order_date) = m GROUP BY m"""))
def monthly_sales_and_profit(spark: SparkSession, path: str) -> DataFrame:
    df = jobs.sales_aggregates(sales(spark, path), ["monthly"])["monthly"]
    return round_columns(df.withColumn("order_date", F.col("order_date").cast("date")), sales=2, profit=2)


@register("Q3 G18", over("sales", """
    SELECT region, segment, category, round(sum(sales) + 1e-5, 2) AS sales FROM sales GROUP BY 1, 2, 3"""))
def stacked_sales(spark: SparkSession, path: str) -> DataFrame:
    """The stacked table in long form again; it has no empty cell."""
    wide = jobs.sales_aggregates(sales(spark, path), ["stacked"])["stacked"]
    long = wide.unpivot(["region", "segment"], [c for c in wide.columns if c not in ("region", "segment")], "category", "sales")
    return round_columns(long.where("sales <> 0"), sales=2)


@register("Q3 G17", over("sales", """
    SELECT region, category, round(sum(sales) + 1e-5, 2) AS sales FROM sales GROUP BY 1, 2"""))
def region_by_category(spark: SparkSession, path: str) -> DataFrame:
    wide = jobs.sales_aggregates(sales(spark, path), ["region_by_category"])["region_by_category"]
    long = wide.unpivot(["region"], [c for c in wide.columns if c != "region"], "category", "sales")
    return round_columns(long.where("sales <> 0"), sales=2)


@register("Q3 G15", over("loans", f"""
    , b AS (SELECT *, CASE WHEN income >= -1000 AND income < 0 THEN '[-1000, 0)' WHEN income >= 0 AND income < 5000 THEN '[0, 5000)'
                           WHEN income >= 5000 AND income < 10000 THEN '[5000, 10000)' END AS age_bracket FROM loans)
    SELECT * FROM (SELECT age_bracket, {r('avg(loan_amount)', 4)} AS avg_loan_amount, {r("avg(CASE WHEN approved = 'yes' THEN 1.0 ELSE 0.0 END)")} AS approval_rate
    FROM b WHERE age_bracket IS NOT NULL GROUP BY 1)"""))
def loans_by_bracket(spark: SparkSession, path: str) -> DataFrame:
    df = jobs.loan_by_bracket(loans(spark, path), "income", [-1000, 0, 5000, 10000])
    return round_columns(df, avg_loan_amount=4, approval_rate=6)


@register("Q2 P3", """
    WITH c AS (SELECT nullif(o_orderpriority, '1-URGENT') AS priority, nullif(o_orderstatus, 'P') AS status, o_totalprice AS price FROM orders)
    SELECT 'priority' AS "column", count(*) - count(priority) AS missing, round((count(*) - count(priority)) / count(*) * 100, 6) AS missing_pct FROM c
    UNION ALL SELECT 'status', count(*) - count(status), round((count(*) - count(status)) / count(*) * 100, 6) FROM c""")
def clean_job_missing(spark: SparkSession, path: str) -> DataFrame:
    """What was missing before cleaning; columns that miss nothing aren't listed."""
    return round_columns(jobs.clean_job(_gappy_orders(spark, path), ["status"], ["price"]).missing, missing_pct=6)


@register("Q2 F9 C1", """
    WITH c AS (SELECT DISTINCT lower(o_orderpriority) AS priority, lower(o_orderstatus) AS status, o_totalprice AS price FROM orders WHERE o_orderstatus <> 'P'),
         q AS (SELECT quantile_cont(price, 0.25) AS a, quantile_cont(price, 0.75) AS b FROM c)
    SELECT 'price' AS "column", CAST(count_if(price < a - 1.5 * (b - a) OR price > b + 1.5 * (b - a)) AS BIGINT) AS outliers FROM c, q""")
def clean_job_outliers(spark: SparkSession, path: str) -> DataFrame:
    """Outliers of the cleaned rows."""
    return jobs.clean_job(_gappy_orders(spark, path), ["status"], ["price"]).outliers


def _gappy_orders(spark: SparkSession, path: str) -> DataFrame:
    return table(spark, path, "orders").select(
        F.nullif("o_orderpriority", F.lit("1-URGENT")).alias("priority"), F.nullif("o_orderstatus", F.lit("P")).alias("status"),
        F.col("o_totalprice").alias("price"),
    )


@register("Q8 K4 K5", over("sales shipments", REPORT + f"""
    , t AS (SELECT month, {r('sales', 2)} AS sales, {r('profit', 2)} AS profit, new_cases FROM rep)
    SELECT 'csv' AS format, * FROM t UNION ALL SELECT 'parquet', * FROM t"""))
def exported_monthly_report(spark: SparkSession, path: str) -> DataFrame:
    """The files that the reporting job writes, read back."""
    base = scratch_path(spark, "monthly-report")
    rows = round_columns(report(spark, path), sales=2, profit=2).select("month", "sales", "profit", "new_cases")
    jobs.formatted_report(rows, base)
    back = load_csv(f"{base}.csv", rows.schema, spark).withColumn("format", F.lit("csv"))
    return back.unionByName(load_parquet(f"{base}.parquet", spark).withColumn("format", F.lit("parquet")))


@register("Q10 K4", over("loans", f"""
    SELECT loan_purpose, count(*) AS loans, {r('sum(loan_amount) / count(*)', 2)} AS mean_amount FROM loans GROUP BY 1"""))
def exported_optimized_loans(spark: SparkSession, path: str) -> DataFrame:
    """The narrowed loans that the job writes, read back."""
    base = scratch_path(spark, "optimized")
    jobs.optimize_job(sales(spark, path, ["region", "profit", "sales"]), loans(spark, path), output_path=base)
    back = load_csv(f"{base}/loan_optimized", spark=spark)
    df = back.groupBy("loan_purpose").agg(F.count(F.lit(1)).alias("loans"), F.avg("loan_amount").alias("mean_amount"))
    return round_columns(df, mean_amount=2)


@register("Q4", over("sales shipments", f"""
    , s AS (SELECT {first_of_month('order_date')} AS m, sum(sales) AS sales, sum(profit) AS profit FROM sales GROUP BY 1),
      c AS (SELECT {first_of_month('date')} AS m, sum(new_cases) AS new_cases, sum(new_deaths) AS new_deaths FROM shipments GROUP BY 1)
    SELECT s.m AS order_month, {r('sales', 2)} AS sales, {r('profit', 2)} AS profit, CAST(new_cases AS BIGINT) AS new_cases,
           CAST(new_deaths AS BIGINT) AS new_deaths, {r('sum(sales) OVER (ORDER BY s.m)', 2)} AS cum_sales,
           CASE WHEN count(*) OVER w >= 3 THEN {r('avg(profit) OVER w', 2)} END AS rolling_profit
    FROM s JOIN c ON s.m = c.m WINDOW w AS (ORDER BY s.m ROWS 2 PRECEDING)"""))
def sales_beside_shipments(spark: SparkSession, path: str) -> DataFrame:
    df = jobs.sales_with_outside_series(
        sales(spark, path, ["order_date", "sales", "profit"]), shipments(spark, path)
    )
    df = df.withColumn("order_month", F.col("order_month").cast("date"))
    return round_columns(df, sales=2, profit=2, cum_sales=2, rolling_profit=2)


# Which region each supplier site serves; other sites serve none.
SITES = {"NATION_0": "AFRICA", "NATION_1": "AMERICA", "NATION_2": "ASIA", "NATION_3": "EUROPE", "NATION_4": "MIDDLE EAST"}


@register("Q5 R10 J6", over("sales shipments", f"""
    , s AS (SELECT region, {month_of('order_date')} AS order_month, sum(sales) AS sales, sum(profit) AS profit FROM sales GROUP BY 1, 2),
      c AS (SELECT CASE site {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in SITES.items())} END AS region,
                   {month_of('date')} AS order_month, avg(hospitalized) AS hospitalized FROM shipments GROUP BY 1, 2)
    SELECT region, order_month, {r('sales', 2)} AS sales, {r('profit', 2)} AS profit, {r('hospitalized', 4)} AS hospitalized
    FROM s JOIN c USING (region, order_month)"""))
def region_month_with_sites(spark: SparkSession, path: str) -> DataFrame:
    df = jobs.region_month_summary(
        sales(spark, path, ["region", "order_date", "sales", "profit"]), shipments(spark, path, with_site=True), SITES
    )
    return round_columns(df, sales=2, profit=2, hospitalized=4)


@register("Q6 W5 F2 G3", over("sales", f"""
    , t AS (SELECT customer_id, sum(sales) AS total_sales, avg(profit) AS avg_profit FROM sales
            WHERE order_date >= DATE '2000-01-01' GROUP BY 1)
    SELECT customer_id, {r('total_sales', 2)} AS total_sales, {r('avg_profit', 4)} AS avg_profit,
           CAST(rank() OVER (ORDER BY total_sales DESC) + (count(*) OVER (PARTITION BY total_sales) - 1) / 2.0 AS DOUBLE) AS sales_rank
    FROM t"""))
def customers_ranked_since(spark: SparkSession, path: str) -> DataFrame:
    df = jobs.customers_since(sales(spark, path, ["customer_id", "order_date", "sales", "profit"]), "2000-01-01")
    return round_columns(df, total_sales=2, avg_profit=4)


@register("Q7 J1 W1 W8 G12 C2 C3", over("sales shipments", REPORT + f"""
    SELECT month, {r('sales', 2)} AS sales, {r('profit', 2)} AS profit, new_cases, {r('hospitalized')} AS hospitalized,
           {r('rolling_profit', 2)} AS rolling_profit, {r('sales_pct_change')} AS sales_pct_change FROM rep"""))
def final_monthly_report(spark: SparkSession, path: str) -> DataFrame:
    df = round_columns(report(spark, path), sales=2, profit=2, hospitalized=6, rolling_profit=2, sales_pct_change=6)
    return sort_values(df, "month")


@register("Q8 X13 V9", over("sales shipments", REPORT + f"""
    SELECT month, '$' || format('{{:,.2f}}', {r('sales', 2)}) AS sales, '$' || format('{{:,.2f}}', {r('profit', 2)}) AS profit,
           sales = (SELECT max(sales) FROM rep) AS is_max_sales, profit = (SELECT max(profit) FROM rep) AS is_max_profit,
           new_cases = (SELECT max(new_cases) FROM rep) AS is_max_new_cases
    FROM rep"""))
def formatted_monthly_report(spark: SparkSession, path: str) -> DataFrame:
    df = jobs.formatted_report(round_columns(report(spark, path), sales=2, profit=2))
    return df.select("month", "sales", "profit", "is_max_sales", "is_max_profit", "is_max_new_cases")


@register("Q9 G6", over("sales shipments", REPORT + f"""
    SELECT {r('sum(sales)', 2)} AS sales, {r('sum(profit)', 2)} AS profit, CAST(sum(new_cases) AS BIGINT) AS new_cases,
           {r('avg(hospitalized)')} AS avg_hospitalized
    FROM rep"""))
def dashboard_kpis(spark: SparkSession, path: str) -> DataFrame:
    df = jobs.dashboard(report(spark, path), "2000-03", "1999").kpis
    return round_columns(df, sales=2, profit=2, avg_hospitalized=6)


@register("Q9 V5 X12", over("sales shipments", REPORT + f"""
    SELECT month, strftime(CAST(month || '-01' AS DATE), '%b %Y') AS label, {r('sales', 2)} AS sales, {r('profit', 2)} AS profit
    FROM rep"""))
def dashboard_trend(spark: SparkSession, path: str) -> DataFrame:
    return round_columns(jobs.dashboard(report(spark, path), "2000-03", "1999").trend, sales=2, profit=2)


@register("Q9 F5 O2", over("sales shipments", REPORT + f"""
    SELECT month, {r('sales', 2)} AS sales, new_cases FROM rep WHERE regexp_matches(month, '(?i)1999')"""))
def dashboard_search(spark: SparkSession, path: str) -> DataFrame:
    df = jobs.dashboard(report(spark, path), "2000-03", "1999").matches.select("month", "sales", "new_cases")
    return round_columns(df, sales=2)


@register("Q9 F4", over("sales shipments", REPORT + f"""
    SELECT month, {r('sales', 2)} AS sales, new_cases FROM rep WHERE month = '2000-03'"""))
def dashboard_month(spark: SparkSession, path: str) -> DataFrame:
    df = jobs.dashboard(report(spark, path), "2000-03", "1999").month_rows.select("month", "sales", "new_cases")
    return round_columns(df, sales=2)


@register("Q10 R14 F2", over("sales", f"""
    SELECT category, count(*) AS lines, sum(quantity) AS quantity FROM sales WHERE sales > 50000 GROUP BY category"""))
def optimized_high_sales(spark: SparkSession, path: str) -> DataFrame:
    high = jobs.optimize_job(sales(spark, path), loans(spark, path), 50_000).high_sales
    return high.groupBy("category").agg(
        F.count(F.lit(1)).alias("lines"), F.sum(F.col("quantity").cast("double")).alias("quantity")
    )


@register("Q10 R6", over("loans", f"""
    SELECT loan_id, {r('loan_amount / nullif(CAST(income AS FLOAT), 0)', 4)} AS loan_to_income_ratio FROM loans"""))
def optimized_loan_ratio(spark: SparkSession, path: str) -> DataFrame:
    """The ratio is taken after narrowing, which stores incomes in single precision."""
    tables = jobs.optimize_job(sales(spark, path, ["region", "profit", "sales"]), loans(spark, path))
    return round_columns(tables.loans.select(F.col("loan_id").cast("long"), "loan_to_income_ratio"), loan_to_income_ratio=4)


@register("Q10 G7", over("sales", f"SELECT region, {r('avg(profit)', 3)} AS profit FROM sales GROUP BY region"))
def optimized_profit_by_region(spark: SparkSession, path: str) -> DataFrame:
    tables = jobs.optimize_job(sales(spark, path, ["region", "profit", "sales"]), loans(spark, path))
    return round_columns(tables.profit_by_region, profit=3)


@register("Q9 F5", over("sales", f"""
    SELECT CAST(order_date AS VARCHAR) AS month, {r('sum(sales)', 2)} AS sales FROM sales
    WHERE strftime(order_date, '%Y') = '1999' GROUP BY order_date"""))
def dashboard_daily_search(spark: SparkSession, path: str) -> DataFrame:
    """A daily report: a search matches hundreds of rows, and all of them are returned."""
    daily = sales(spark, path, ["order_date", "sales", "profit"]).groupBy(F.col("order_date").cast("date").cast("string").alias("month")).agg(
        F.sum("sales").alias("sales"), F.sum("profit").alias("profit"), F.count(F.lit(1)).alias("new_cases"), F.lit(0.0).alias("hospitalized"),
    )
    return round_columns(jobs.dashboard(daily, "1999-03-01", "^1999").matches.select("month", "sales"), sales=2)
