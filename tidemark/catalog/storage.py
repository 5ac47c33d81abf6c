"""Sources and sinks: the given tables written by Spark, then read back.

Files go to a new folder under the shared folder of the session.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.catalog.base import over, register, round_columns, sql_normalize, sql_trim
from tidemark.operators.cleaning import clean_dataframe
from tidemark.operators.filters import search_text
from tidemark.operators.joins import join_on_index
from tidemark.plans.jobs import load_job
from tidemark.plans.views import activity, table
from tidemark.session import scratch_path
from tidemark.sources import (
    export_formats, load_csv, load_json, load_parquet, load_regional_csv, load_typed_csv, save_by_region, save_csv,
    save_parquet,
)
from tidemark.streaming import ingest_files, read_files, summarize_new_files

ORDERS_SQL = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate FROM orders"


def _orders(spark: SparkSession, path: str) -> DataFrame:
    return table(spark, path, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", F.col("o_orderdate").cast("date").alias("o_orderdate")
    )


@register("S1 K1", ORDERS_SQL)
def csv_with_inferred_types(spark: SparkSession, path: str) -> DataFrame:
    out = scratch_path(spark, "orders-csv")
    save_csv(_orders(spark, path), out)
    df = load_csv(out, spark=spark)
    return df.withColumns({c: F.col(c).cast("long") for c in ("o_orderkey", "o_custkey")})


@register("S2", "SELECT event_id, CAST(ts AS DATE) AS date, event_type, value FROM events")
def json_array_files(spark: SparkSession, path: str) -> DataFrame:
    """Every line is a JSON array of some rows, so files can be split between lines."""
    out = scratch_path(spark, "events-json")
    row = F.struct("event_id", F.col("ts").cast("date").alias("date"), "event_type", "value")
    chunk = F.floor(F.col("event_id") / 500)  # bounds an array
    arrays = table(spark, path, "events").groupBy(chunk.alias("chunk")).agg(F.to_json(F.collect_list(row)).alias("value"))
    arrays.select("value").write.text(out)
    return load_json(out, "event_id long, date date, event_type string, value double", lines=True, spark=spark)


@register("S3 K2", "SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer")
def parquet_round_trip(spark: SparkSession, path: str) -> DataFrame:
    out = scratch_path(spark, "customer")
    save_parquet(table(spark, path, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment"), out)
    return load_parquet(out, spark)


@register("S4", "SELECT event_id, value, event_type AS region FROM events")
def regional_files(spark: SparkSession, path: str) -> DataFrame:
    """Files under ``…values_<type>.csv``; the type comes from that name alone."""
    out = scratch_path(spark, "regional")
    named = table(spark, path, "events").select(
        "event_id", "value", F.concat(F.lit("values_"), "event_type", F.lit(".csv")).alias("file")
    )
    save_by_region(named, out, "file", "csv")
    return load_regional_csv(f"{out}/*.csv", "event_id long, value double", spark=spark)


@register("S5", """
    SELECT CAST(o_orderdate AS DATE) AS order_date, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents, count(*) AS orders
    FROM orders GROUP BY 1""")
def chunked_ingest(spark: SparkSession, path: str) -> DataFrame:
    """CSV files taken a few at a time, typed and appended, then grouped."""
    source, out = scratch_path(spark, "chunks"), scratch_path(spark, "ingested")
    save_csv(_orders(spark, path).repartition(16, "o_orderkey"), source)
    stream = read_files(
        spark, source, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate date",
        files_per_batch=4,
    )
    ingested = ingest_files(
        stream, out, scratch_path(spark, "progress"), lambda df: clean_dataframe(df, ["o_orderdate"], dedupe=False)
    )
    return ingested.groupBy(F.col("o_orderdate").alias("order_date")).agg(
        F.sum(F.round(F.col("o_totalprice") * 100).cast("long")).alias("cents"), F.count(F.lit(1)).alias("orders")
    )


@register("S5 G1", """
    SELECT event_type, count(value) AS value_count, max(value) AS value_max, round(avg(value) + 1e-9, 6) AS value_mean,
           round(stddev_samp(value) + 1e-9, 6) AS value_std, CAST(sum(user_id) AS BIGINT) AS user_id_sum
    FROM events GROUP BY event_type""")
def running_summary(spark: SparkSession, path: str) -> DataFrame:
    """Grouped totals of all files taken in so far: the second run merges the new files into the stored state."""
    source, folder = scratch_path(spark, "event-files"), scratch_path(spark, "running")
    events = table(spark, path, "events").select("event_type", "value", "user_id")
    late = F.col("user_id") % 4 == 0
    for part in (events.where(~late), events.where(late)):
        save_parquet(part.repartition(6), source, mode="append")
        stream = read_files(spark, source, events.schema, "parquet", files_per_batch=4)
        totals = summarize_new_files(stream, folder, "event_type", {"value": ["count", "max", "mean", "std"], "user_id": ["sum"]})
    return round_columns(totals, value_mean=6, value_std=6)


@register("S6", ORDERS_SQL)
def csv_with_given_types(spark: SparkSession, path: str) -> DataFrame:
    out = scratch_path(spark, "orders-typed")
    save_csv(_orders(spark, path), out, dateFormat="dd/MM/yyyy")
    schema = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate date"
    return load_typed_csv(out, schema, date_format="dd/MM/yyyy", spark=spark)


@register("K3", "SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders")
def partitioned_by_value(spark: SparkSession, path: str) -> DataFrame:
    out = scratch_path(spark, "by-priority")
    save_by_region(table(spark, path, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority"), out, "o_orderpriority")
    return load_parquet(out, spark)


@register("K4 F5", "SELECT s_suppkey, s_name FROM supplier WHERE regexp_matches(s_name, '(?i)supplier#0000000[1-4]')")
def export_search_result(spark: SparkSession, path: str) -> DataFrame:
    out = scratch_path(spark, "snapshot")
    found = search_text(table(spark, path, "supplier").select("s_suppkey", "s_name"), "supplier#0000000[1-4]")
    save_csv(found, out)
    return load_csv(out, "s_suppkey long, s_name string", spark)


@register("K5", over("activity", """
    , t AS (SELECT kind, CAST(sum(new_cases) AS BIGINT) AS new_cases FROM activity GROUP BY kind)
    SELECT 'csv' AS format, kind, new_cases FROM t UNION ALL SELECT 'parquet', kind, new_cases FROM t"""))
def export_two_formats(spark: SparkSession, path: str) -> DataFrame:
    result = activity(spark, path).groupBy("kind").agg(F.sum("new_cases").alias("new_cases"))
    csv_path, parquet_path = export_formats(result, scratch_path(spark, "report"))
    from_csv = load_csv(csv_path, result.schema, spark).withColumn("format", F.lit("csv"))
    return from_csv.unionByName(load_parquet(parquet_path, spark).withColumn("format", F.lit("parquet")))


@register("Q1 K3", """
    SELECT c_custkey AS customer_key, c_acctbal AS account_balance, c_mktsegment AS segment FROM customer""")
def load_job_by_segment(spark: SparkSession, path: str) -> DataFrame:
    raw = table(spark, path, "customer").select(
        F.col("c_custkey").alias("Customer Key"), F.col("c_acctbal").cast("string").alias("Account-Balance"),
        F.col("c_mktsegment").alias("Segment"),
    )
    out = scratch_path(spark, "typed")
    load_job(raw, out, numbers=["account_balance"], by_region="segment")
    return load_parquet(out, spark)


@register("J11 K2", """
    SELECT o_orderkey, o_totalprice, n FROM orders JOIN
    (SELECT l_orderkey AS k, count(*) AS n FROM lineitem GROUP BY 1) ON o_orderkey = k""")
def join_saved_tables(spark: SparkSession, path: str) -> DataFrame:
    """Both sides saved first, then joined by key."""
    left, right = scratch_path(spark, "left"), scratch_path(spark, "right")
    save_parquet(table(spark, path, "orders").select("o_orderkey", "o_totalprice"), left)
    lines = table(spark, path, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count(F.lit(1)).alias("n"))
    save_parquet(lines, right)
    return join_on_index(load_parquet(left, spark), load_parquet(right, spark), "o_orderkey", "inner")


@register("C1 S2", f"""
    SELECT conv_id, turn, {sql_normalize('text')} AS text, lower({sql_trim('role')}) AS role FROM conversations""")
def json_lines_cleaned(spark: SparkSession, path: str) -> DataFrame:
    """One object per line, so Spark splits the files."""
    out = scratch_path(spark, "conversations")
    table(spark, path, "conversations").write.json(out)
    df = load_json(out, "conv_id long, turn long, role string, text string", lines=True, spark=spark)
    return clean_dataframe(df, dedupe=False)
