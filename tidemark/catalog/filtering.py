"""Filters, cleaning and profiling."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark import functions as fn
from tidemark.catalog.base import over, register, round_columns, sql_normalize, sql_rounded as r, sql_trim
from tidemark.operators import cleaning, filters, profile
from tidemark.operators.aggregation import named_summary
from tidemark.plans.views import activity, sales, table
from tidemark.session import materialize


@register("F1", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_totalprice < 200000")
def filter_by_comparison(spark: SparkSession, path: str) -> DataFrame:
    df = filters.where(table(spark, path, "orders"), (F.col("o_orderstatus") == "F") & (F.col("o_totalprice") < 200000))
    return df.select("o_orderkey", "o_totalprice")


@register("F2", over("sales", f"""
    SELECT order_id, line_number, {r('sales', 4)} AS sales FROM sales WHERE sales > 50000"""))
def filter_by_text(spark: SparkSession, path: str) -> DataFrame:
    df = fn.query(sales(spark, path, ["order_id", "line_number", "sales"]), "sales > 50000")
    return round_columns(df, sales=4)


@register("F3", """
    SELECT p_partkey FROM part WHERE p_size > 10 AND p_retailprice < 950 AND p_type = 'PROMO'""")
def filter_by_conjunction(spark: SparkSession, path: str) -> DataFrame:
    df = fn.query(table(spark, path, "part"), 'p_size > 10 and p_retailprice < 950 and p_type == "PROMO"')
    return df.select("p_partkey")


@register("F4", "SELECT c_custkey, c_name FROM customer WHERE c_mktsegment = 'BUILDING'")
def filter_chosen_value(spark: SparkSession, path: str) -> DataFrame:
    return filters.equals(table(spark, path, "customer"), "c_mktsegment", "BUILDING").select("c_custkey", "c_name")


@register("F5", """
    SELECT doc_id, lang, source FROM documents
    WHERE regexp_matches(text, '(?i)TION|license') OR regexp_matches(lang, '(?i)TION|license')
       OR regexp_matches(source, '(?i)TION|license')""")
def search_keyword(spark: SparkSession, path: str) -> DataFrame:
    return filters.search_text(table(spark, path, "documents"), "TION|license").select("doc_id", "lang", "source")


@register("F6", """
    SELECT event_id, coalesce(event_type IN ('purchase', 'signup'), false) AS is_goal FROM events""")
def flag_members(spark: SparkSession, path: str) -> DataFrame:
    return table(spark, path, "events").select(
        "event_id", filters.is_member("event_type", ["purchase", "signup"]).alias("is_goal")
    )


@register("F7", "SELECT l.doc_id FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE l.quality IS NOT NULL")
def drop_null_rows(spark: SparkSession, path: str) -> DataFrame:
    """Documents without labels have NULLs after the left join."""
    joined = table(spark, path, "documents").select("doc_id").join(table(spark, path, "labels"), "doc_id", "left")
    return cleaning.drop_nulls(joined, ["quality"]).select("doc_id")




@register("F8", """
    SELECT event_id, event_type, value FROM events, (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events)
    WHERE value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)""")
def outlier_rows(spark: SparkSession, path: str) -> DataFrame:
    return filters.detect_outliers_iqr(table(spark, path, "events").select("event_id", "event_type", "value"), "value")


@register("F8", over("sales", """
    SELECT order_id, line_number FROM sales, (SELECT quantile_cont(profit, 0.25) AS q1, quantile_cont(profit, 0.75) AS q3 FROM sales)
    WHERE profit < q1 - 1.5 * (q3 - q1) OR profit > q3 + 1.5 * (q3 - q1)"""))
def profit_outliers(spark: SparkSession, path: str) -> DataFrame:
    """No line lies outside the fences: an empty table."""
    df = filters.detect_outliers_iqr(sales(spark, path, ["order_id", "line_number", "profit"]), "profit")
    return df.select("order_id", "line_number")


CUSTOMERS = """, c AS (SELECT customer_id, sum(quantity) AS quantity, CAST(count(*) AS DOUBLE) AS lines, max(quantity) AS largest
    FROM sales GROUP BY customer_id)"""


@register("F9", over("sales", CUSTOMERS + " UNION ALL ".join(f"""
    SELECT '{c}' AS "column", CAST(count_if({c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1)) AS BIGINT) AS outliers
    FROM c, (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM c)"""
    for c in ("quantity", "lines", "largest"))))
def outlier_counts(spark: SparkSession, path: str) -> DataFrame:
    """Per customer: total quantity, number of lines, largest quantity."""
    customers = named_summary(
        sales(spark, path, ["customer_id", "quantity"]), "customer_id",
        quantity=("quantity", "sum"), lines=("quantity", "count"), largest=("quantity", "max"),
    )
    return filters.count_outliers_iqr(materialize(customers), ["quantity", "lines", "largest"])


@register("C1", f"""
    SELECT DISTINCT {sql_normalize('text')} AS text, lower(lang) AS lang, lower(source) AS source FROM documents""")
def clean_documents(spark: SparkSession, path: str) -> DataFrame:
    """Whole texts normalised, then copies dropped."""
    return cleaning.clean_dataframe(table(spark, path, "documents").select("text", "lang", "source"), ["text"])


@register("C2", f"""
    SELECT conv_id, turn, lower({sql_trim('role')}) AS role, lower({sql_trim('text')}) AS text FROM conversations""")
def standardize_all_strings(spark: SparkSession, path: str) -> DataFrame:
    return cleaning.standardize_strings(table(spark, path, "conversations"))


@register("C3", "SELECT CAST(o_custkey AS VARCHAR) AS customer_id, o_orderkey FROM orders")
def align_ids(spark: SparkSession, path: str) -> DataFrame:
    df = table(spark, path, "orders").select(F.col("o_custkey").alias("customer_id"), "o_orderkey")
    return cleaning.align_customer_ids(df)


@register("C4", "SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem")
def distinct_pairs(spark: SparkSession, path: str) -> DataFrame:
    return cleaning.drop_duplicates(table(spark, path, "lineitem").select("l_orderkey", "l_suppkey"))


@register("C5", """
    SELECT d.doc_id, coalesce(quality, 0) AS quality, coalesce(toxic, 0) AS toxic
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def fill_missing_labels(spark: SparkSession, path: str) -> DataFrame:
    joined = table(spark, path, "documents").select("doc_id").join(table(spark, path, "labels"), "doc_id", "left")
    return cleaning.fill_nulls(joined, 0)


@register("C6", """
    SELECT d.doc_id, last_value(quality IGNORE NULLS) OVER (ORDER BY d.doc_id) AS quality
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def fill_labels_forward(spark: SparkSession, path: str) -> DataFrame:
    """A table-wide fill, so it runs over range blocks."""
    joined = table(spark, path, "documents").select("doc_id").join(
        table(spark, path, "labels").select("doc_id", "quality"), "doc_id", "left"
    )
    return cleaning.forward_fill(joined, "quality", "doc_id")


@register("P1 O2", "SELECT c_custkey, c_name FROM customer ORDER BY c_custkey LIMIT 5")
def dataset_summary(spark: SparkSession, path: str) -> DataFrame:
    """The first five rows are the feature."""
    return profile.load_dataset_summary(table(spark, path, "customer").select("c_custkey", "c_name").orderBy("c_custkey"))


@register("P2", """
    SELECT 0 AS position, 'doc_id' AS "column", 'bigint' AS dtype, count(doc_id) AS non_null, count(*) - count(doc_id) AS nulls FROM (SELECT d.doc_id, quality, toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
    UNION ALL SELECT 1, 'quality', 'int', count(quality), count(*) - count(quality) FROM (SELECT d.doc_id, quality, toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
    UNION ALL SELECT 2, 'toxic', 'int', count(toxic), count(*) - count(toxic) FROM (SELECT d.doc_id, quality, toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)""")
def column_types_and_nulls(spark: SparkSession, path: str) -> DataFrame:
    joined = table(spark, path, "documents").select("doc_id").join(table(spark, path, "labels"), "doc_id", "left")
    return profile.column_info(joined)


@register("P3", f"""
    WITH j AS (SELECT d.doc_id, quality, toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
    SELECT 'quality' AS "column", count(*) - count(quality) AS missing, {r('(count(*) - count(quality)) / count(*) * 100')} AS missing_pct FROM j
    UNION ALL SELECT 'toxic', count(*) - count(toxic), {r('(count(*) - count(toxic)) / count(*) * 100')} FROM j""")
def missing_per_column(spark: SparkSession, path: str) -> DataFrame:
    joined = table(spark, path, "documents").select("doc_id").join(table(spark, path, "labels"), "doc_id", "left")
    return round_columns(profile.missing_values(joined), missing_pct=6)


@register("P4", """
    SELECT CAST(sum(n - 1) AS BIGINT) AS duplicates
    FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)""")
def duplicate_rows(spark: SparkSession, path: str) -> DataFrame:
    return profile.count_duplicates(table(spark, path, "lineitem").select("l_orderkey", "l_linenumber"))


@register("P5 G8", " UNION ALL ".join(f"""
    SELECT '{c}' AS "column", CAST(count({c}) AS DOUBLE) AS "count", {r(f'avg({c})', 4)} AS mean, {r(f'stddev_samp({c})', 4)} AS std,
           min({c}) AS min, {r(f'quantile_cont({c}, 0.25)', 4)} AS q25, {r(f'quantile_cont({c}, 0.5)', 4)} AS q50,
           {r(f'quantile_cont({c}, 0.75)', 4)} AS q75, max({c}) AS max FROM lineitem"""
    for c in ("l_quantity", "l_extendedprice", "l_tax")))
def describe_lineitem(spark: SparkSession, path: str) -> DataFrame:
    df = profile.describe(table(spark, path, "lineitem"), ["l_quantity", "l_extendedprice", "l_tax"])
    return round_columns(df.withColumn("count", F.col("count").cast("double")), mean=4, std=4, q25=4, q50=4, q75=4)


@register("P6", 'SELECT source, count(*) AS "count" FROM documents WHERE source IS NOT NULL GROUP BY source')
def frequencies(spark: SparkSession, path: str) -> DataFrame:
    return profile.value_counts(table(spark, path, "documents"), "source")


@register("P7", " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(DISTINCT {c}) AS "distinct" FROM lineitem"""
    for c in ("l_orderkey", "l_suppkey", "l_returnflag", "l_shipdate")))
def distinct_per_column(spark: SparkSession, path: str) -> DataFrame:
    return profile.distinct_counts(
        table(spark, path, "lineitem"), ["l_orderkey", "l_suppkey", "l_returnflag", "l_shipdate"]
    )


@register("P8", "SELECT DISTINCT p_brand FROM part WHERE p_brand IS NOT NULL ORDER BY p_brand")
def sorted_values(spark: SparkSession, path: str) -> DataFrame:
    return profile.distinct_values(table(spark, path, "part"), "p_brand")


@register("P9", 'SELECT count(*) AS "rows", CAST(11 AS BIGINT) AS "columns" FROM lineitem')
def table_shape(spark: SparkSession, path: str) -> DataFrame:
    return profile.shape(table(spark, path, "lineitem"))


@register("F4 P9", over("activity", "SELECT count(*) AS \"rows\", CAST(5 AS BIGINT) AS \"columns\" FROM activity WHERE kind = 'purchase'"))
def filtered_shape(spark: SparkSession, path: str) -> DataFrame:
    return profile.shape(filters.equals(activity(spark, path), "kind", "purchase"))
