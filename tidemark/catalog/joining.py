"""Joins and concatenation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.catalog.base import first_of_month, month_of, over, register, round_columns, sql_rounded as r
from tidemark.operators.aggregation import groupby_summary
from tidemark.operators.calendar import by_month_start, by_month_text, resample_monthly
from tidemark.operators.joins import check_merge_key_overlap, join_on_index, safe_merge
from tidemark.operators.stacking import concat_all, safe_concat
from tidemark.plans.views import loans, sales, shipments, table
from tidemark.sources import store_bucketed


@register("J1 J2 J3 J5", f"""
    SELECT o_orderkey, c_name, {r('o_totalprice', 2)} AS o_totalprice
    FROM orders JOIN customer ON o_custkey = c_custkey""")
def merge_with_key_types(spark: SparkSession, path: str) -> DataFrame:
    """The right key is text and takes the left key's type."""
    orders = table(spark, path, "orders").withColumnRenamed("o_custkey", "customer_id")
    customer = table(spark, path, "customer").withColumn("customer_id", F.col("c_custkey").cast("string"))
    merged = safe_merge(orders, customer, on="customer_id")
    return round_columns(merged.select("o_orderkey", "c_name", "o_totalprice"), o_totalprice=2)


@register("J1", """
    WITH f AS (SELECT l_orderkey, nullif(l_returnflag, 'N') AS flag FROM lineitem),
         t AS (SELECT nullif(l_returnflag, 'N') AS flag, count(*) AS lines FROM lineitem GROUP BY 1)
    SELECT l_orderkey, f.flag, lines FROM f JOIN t ON f.flag IS NOT DISTINCT FROM t.flag""")
def merge_null_keys(spark: SparkSession, path: str) -> DataFrame:
    """NULL keys match NULL keys; one row per key on the right."""
    flags = table(spark, path, "lineitem").select(
        "l_orderkey", F.nullif("l_returnflag", F.lit("N")).alias("flag")
    )
    counts = flags.groupBy("flag").agg(F.count(F.lit(1)).alias("lines"))
    return safe_merge(flags, counts, "flag")


SKEWED_KEY = "CASE WHEN l_orderkey % 10 < 3 THEN NULL WHEN l_orderkey % 10 < 6 THEN 7 ELSE l_suppkey END"


@register("J1 J7", f"""
    WITH a AS (SELECT {SKEWED_KEY} AS k, l_orderkey, l_linenumber FROM lineitem),
         b AS (SELECT s_suppkey AS k, s_name FROM supplier UNION ALL SELECT NULL, 'nobody' UNION ALL SELECT -1, 'no lines')
    SELECT coalesce(a.k, b.k) AS k, l_orderkey, CAST(l_linenumber AS INTEGER) AS l_linenumber, s_name
    FROM a FULL JOIN b ON a.k IS NOT DISTINCT FROM b.k""")
def merge_frequent_keys(spark: SparkSession, path: str) -> DataFrame:
    """One key and NULL hold three tenths of the lines each; their rows are dealt over many tasks."""
    lines = table(spark, path, "lineitem").select(F.expr(SKEWED_KEY).alias("k"), "l_orderkey", "l_linenumber")
    supplier = table(spark, path, "supplier").select(F.col("s_suppkey").alias("k"), "s_name")
    extra = spark.range(2).select(F.when(F.col("id") == 0, F.lit(-1).cast("long")).alias("k"), F.when(F.col("id") == 0, "no lines").otherwise("nobody").alias("s_name"))
    return safe_merge(lines, supplier.union(extra), "k", "outer", spread=True)


@register("J4", over("sales shipments", f"""
    , s AS (SELECT {first_of_month('order_date')} AS m, sum(sales) AS sales FROM sales GROUP BY 1),
      c AS (SELECT {first_of_month('date')} AS m, sum(new_cases) AS new_cases FROM shipments GROUP BY 1)
    SELECT s.m AS month, {r('sales', 2)} AS sales, CAST(new_cases AS BIGINT) AS new_cases
    FROM s JOIN c ON s.m = c.m"""))
def merge_on_parsed_dates(spark: SparkSession, path: str) -> DataFrame:
    """A date key and a text key, both read as timestamps."""
    left = by_month_start(sales(spark, path, ["order_date", "sales"]), "order_date", {"sales": "sum"})
    right = by_month_start(shipments(spark, path), "date", {"new_cases": "sum"})
    left = left.withColumn("month", F.col("month").cast("string"))
    right = right.withColumn("month", F.col("month").cast("string"))
    merged = safe_merge(left, right, "month", parse_dates=True)
    return round_columns(merged.withColumn("month", F.col("month").cast("date")), sales=2)


@register("J5", over("sales loans", f"""
    , s AS (SELECT segment, sum(sales) AS sales FROM sales GROUP BY segment),
      l AS (SELECT segment, sum(loan_amount) AS loan_amount FROM loans GROUP BY segment)
    SELECT segment, {r('sales', 2)} AS sales, {r('loan_amount', 2)} AS loan_amount FROM s JOIN l USING (segment)"""))
def merge_aggregates(spark: SparkSession, path: str) -> DataFrame:
    merged = safe_merge(
        groupby_summary(sales(spark, path, ["segment", "sales"]), "segment", {"sales": "sum"}),
        groupby_summary(loans(spark, path), "segment", {"loan_amount": "sum"}),
        on="segment",
    )
    return round_columns(merged, sales=2, loan_amount=2)


@register("J6", over("sales", f"""
    , a AS (SELECT region, {month_of('order_date')} AS month, sum(sales) AS sales FROM sales GROUP BY 1, 2),
      b AS (SELECT region, {month_of('ship_date')} AS month, sum(quantity) AS quantity FROM sales GROUP BY 1, 2)
    SELECT region, month, {r('sales', 2)} AS sales, quantity FROM a JOIN b USING (region, month)"""))
def merge_on_two_keys(spark: SparkSession, path: str) -> DataFrame:
    ordered = by_month_text(sales(spark, path, ["region", "order_date", "sales"]), "order_date", {"sales": "sum"}, "region")
    shipped = by_month_text(sales(spark, path, ["region", "ship_date", "quantity"]), "ship_date", {"quantity": "sum"}, "region")
    return round_columns(safe_merge(ordered, shipped, on=["region", "month"]), sales=2)


def _labelled(spark: SparkSession, path: str, how: str) -> DataFrame:
    documents = table(spark, path, "documents").select("doc_id", "lang")
    graded = table(spark, path, "labels").select((F.col("doc_id") + 1).alias("doc_id"), "quality")
    return safe_merge(documents, graded, "doc_id", how)


LABELLED = """SELECT doc_id, lang, quality FROM (SELECT doc_id, lang FROM documents)
    {} JOIN (SELECT doc_id + 1 AS doc_id, quality FROM labels) USING (doc_id)"""


@register("J7", LABELLED.format("LEFT"))
def merge_left(spark: SparkSession, path: str) -> DataFrame:
    return _labelled(spark, path, "left")


@register("J7", LABELLED.format("RIGHT"))
def merge_right(spark: SparkSession, path: str) -> DataFrame:
    return _labelled(spark, path, "right")


@register("J7", LABELLED.format("FULL"))
def merge_outer(spark: SparkSession, path: str) -> DataFrame:
    return _labelled(spark, path, "outer")


@register("J8", f"""
    SELECT o.o_custkey AS customer_id, {r('o.total', 2)} AS sales_store, {r('c_acctbal', 2)} AS sales_loan
    FROM (SELECT o_custkey, sum(o_totalprice) AS total FROM orders GROUP BY 1) o JOIN customer ON o_custkey = c_custkey""")
def merge_with_suffixes(spark: SparkSession, path: str) -> DataFrame:
    store = groupby_summary(
        table(spark, path, "orders").select(F.col("o_custkey").alias("customer_id"), F.col("o_totalprice").alias("sales")),
        "customer_id", {"sales": "sum"},
    )
    account = table(spark, path, "customer").select(F.col("c_custkey").alias("customer_id"), F.col("c_acctbal").alias("sales"))
    merged = safe_merge(store, account, "customer_id", suffixes=("_store", "_loan"))
    return round_columns(merged, sales_store=2, sales_loan=2)


@register("J9", """
    SELECT 'cust-' || c_custkey AS customer_id, c_name, o_totalprice FROM customer JOIN orders
    ON 'cust-' || c_custkey = CAST(o_custkey AS VARCHAR)""")
def merge_without_matches(spark: SparkSession, path: str) -> DataFrame:
    """Keys written differently never match: an empty table with all columns."""
    left = table(spark, path, "customer").select(F.concat(F.lit("cust-"), "c_custkey").alias("customer_id"), "c_name")
    right = table(spark, path, "orders").select(F.col("o_custkey").cast("string").alias("customer_id"), "o_totalprice")
    return safe_merge(left, right, "customer_id")


@register("J10", """
    SELECT 'doc_id' AS "column", (SELECT count(doc_id) FROM documents) AS left_values,
           (SELECT count(doc_id) FROM labels) AS right_values""")
def shared_columns(spark: SparkSession, path: str) -> DataFrame:
    """Join candidates of two tables, with the values each side has for them."""
    documents, labels = table(spark, path, "documents"), table(spark, path, "labels")
    shared = check_merge_key_overlap(documents, labels)

    def filled(df: DataFrame, name: str) -> DataFrame:
        return df.agg(*[F.count(c).alias(c) for c in shared]).unpivot([], shared, "column", name)

    return filled(documents, "left_values").join(filled(labels, "right_values"), "column")


@register("J11", """
    SELECT o_orderkey, o_totalprice, n FROM orders LEFT JOIN
    (SELECT l_orderkey AS k, count(*) AS n FROM lineitem GROUP BY 1) ON o_orderkey = k""")
def join_by_index(spark: SparkSession, path: str) -> DataFrame:
    orders = table(spark, path, "orders").select("o_orderkey", "o_totalprice")
    lines = table(spark, path, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count(F.lit(1)).alias("n"))
    return join_on_index(orders, lines, "o_orderkey")


@register("J11 K2", """
    SELECT o_orderkey, o_totalprice, o_orderpriority, quantity, lines FROM orders LEFT JOIN
    (SELECT l_orderkey AS k, sum(l_quantity) AS quantity, count(*) AS lines FROM lineitem GROUP BY 1) ON o_orderkey = k""")
def join_where_stored(spark: SparkSession, path: str) -> DataFrame:
    """Both tables are stored in buckets of the key: they are grouped and joined where they lie."""
    orders = store_bucketed(table(spark, path, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority"), "o_orderkey", 8)
    lines = store_bucketed(table(spark, path, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_quantity"), "o_orderkey", 8)
    totals = lines.groupBy("o_orderkey").agg(F.sum("l_quantity").alias("quantity"), F.count(F.lit(1)).alias("lines"))
    return join_on_index(orders, totals.hint("merge"), "o_orderkey")


@register("G9 J5", over("activity", """
    , m AS (SELECT last_day(CAST(l_shipdate AS DATE)) AS date, sum(l_quantity) AS quantity FROM lineitem GROUP BY 1),
      o AS (SELECT last_day(CAST(o_orderdate AS DATE)) AS date, count(*) AS orders FROM orders GROUP BY 1),
      ms AS (SELECT last_day(CAST(d AS DATE)) AS date FROM (SELECT unnest(generate_series(
             date_trunc('month', min(l_shipdate)), max(l_shipdate), INTERVAL 1 MONTH)) AS d FROM lineitem)),
      os AS (SELECT last_day(CAST(d AS DATE)) AS date FROM (SELECT unnest(generate_series(
             date_trunc('month', min(o_orderdate)), max(o_orderdate), INTERVAL 1 MONTH)) AS d FROM orders))
    SELECT date, coalesce(quantity, 0.0) AS quantity, coalesce(orders, 0) AS orders
    FROM ms JOIN os USING (date) LEFT JOIN m USING (date) LEFT JOIN o USING (date)"""))
def merge_monthly_trends(spark: SparkSession, path: str) -> DataFrame:
    shipped = table(spark, path, "lineitem").select(F.col("l_shipdate").alias("date"), F.col("l_quantity").alias("quantity"))
    ordered = table(spark, path, "orders").select(F.col("o_orderdate").alias("date"), F.col("o_orderkey").alias("orders"))
    return safe_merge(
        resample_monthly(shipped, "date", {"quantity": "sum"}), resample_monthly(ordered, "date", {"orders": "count"}), "date"
    )


@register("U1", """
    SELECT s_suppkey AS id, s_name AS name, s_acctbal AS balance FROM supplier
    UNION ALL SELECT c_custkey, c_name, c_acctbal FROM customer""")
def stack_same_columns(spark: SparkSession, path: str) -> DataFrame:
    """Columns match by name, whatever their order."""
    supplier = table(spark, path, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance")
    )
    customer = table(spark, path, "customer").select(
        F.col("c_acctbal").alias("balance"), F.col("c_name").alias("name"), F.col("c_custkey").alias("id")
    )
    return safe_concat([supplier, customer])


@register("U2", """
    SELECT s_suppkey AS id, s_name AS name, CAST(NULL AS VARCHAR) AS segment FROM supplier
    UNION ALL SELECT c_custkey, c_name, c_mktsegment FROM customer""")
def stack_different_columns(spark: SparkSession, path: str) -> DataFrame:
    supplier = table(spark, path, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    customer = table(spark, path, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")
    )
    return safe_concat([supplier, customer], check_columns=False)


@register("U3", """
    WITH p AS (SELECT row_number() OVER (ORDER BY p_partkey) - 1 AS position, p_partkey, p_name FROM part),
         c AS (SELECT row_number() OVER (ORDER BY c_custkey) - 1 AS position, c_custkey, c_name FROM customer)
    SELECT position, p_partkey, p_name, c_custkey, c_name FROM p FULL JOIN c USING (position)""")
def glue_side_by_side(spark: SparkSession, path: str) -> DataFrame:
    """The shorter table leaves NULLs at the end."""
    part = table(spark, path, "part").select("p_partkey", "p_name")
    customer = table(spark, path, "customer").select("c_custkey", "c_name")
    return safe_concat([part, customer], axis=1, check_columns=False, order_by=["p_partkey", "c_custkey"])


@register("U4", """
    SELECT r_name AS name, 'region' AS kind FROM region UNION ALL SELECT n_name, 'nation' FROM nation
    UNION ALL SELECT s_name, 'supplier' FROM supplier""")
def stack_list_of_tables(spark: SparkSession, path: str) -> DataFrame:
    return concat_all([
        table(spark, path, t).select(F.col(c).alias("name"), F.lit(t).alias("kind"))
        for t, c in (("region", "r_name"), ("nation", "n_name"), ("supplier", "s_name"))
    ])


@register("J3 J5", """
    SELECT day, orders, lines
    FROM (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS orders FROM orders WHERE o_orderkey % 5 <> 0 GROUP BY 1)
    JOIN (SELECT CAST(l_shipdate AS DATE) AS day, count(*) AS lines FROM lineitem WHERE l_orderkey % 3 <> 0 GROUP BY 1) USING (day)""")
def merge_unreadable_dates(spark: SparkSession, path: str) -> DataFrame:
    """A fifth of the keys on one side and a third on the other cannot be read as dates: they match nothing."""
    def per_day(name: str, date: str, key: str, every: int, count: str) -> DataFrame:
        readable = F.col(date).cast("date").cast("string")
        day = F.when(F.col(key) % every != 0, readable).otherwise(F.concat(F.lit("no date "), F.col(key).cast("string")))
        return table(spark, path, name).groupBy(day.alias("day")).agg(F.count(F.lit(1)).alias(count))

    orders, lines = per_day("orders", "o_orderdate", "o_orderkey", 5, "orders"), per_day("lineitem", "l_shipdate", "l_orderkey", 3, "lines")
    return safe_merge(orders, lines, "day", parse_dates=True).withColumn("day", F.col("day").cast("date"))
