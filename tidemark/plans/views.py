"""Business views over the star-schema tables.

Each view takes the columns a job needs and joins only the tables that hold
them: dimension keys always resolve, so leaving a join out changes no row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.sources.readers import load_parquet

# Which tables each column of the sales view needs beyond lineitem.
SALES_TABLES = {
    "order_id": (),
    "line_number": (),
    "ship_date": (),
    "sales": (),
    "quantity": (),
    "discount": (),
    "order_date": ("orders",),
    "customer_id": ("orders",),
    "category": ("part",),
    "sub_category": ("part",),
    "profit": ("part",),
    "segment": ("orders", "customer"),
    "customer_name": ("orders", "customer"),
    "region": ("orders", "customer", "nation", "region"),
}

# Join keys of the dimension tables, in join order.
SALES_JOINS = {
    "orders": ("l_orderkey", "o_orderkey"),
    "part": ("l_partkey", "p_partkey"),
    "customer": ("o_custkey", "c_custkey"),
    "nation": ("c_nationkey", "n_nationkey"),
    "region": ("n_regionkey", "r_regionkey"),
}


# Table schemas. Given ones save the job that reads them from a footer.
TABLE_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "pages": "page_id long, url string, html string",
    "labels": "doc_id long, quality int, toxic int",
    "conversations": "conv_id long, turn long, role string, text string",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return load_parquet(f"{folder}/{name}.parquet", spark, schema=TABLE_SCHEMAS.get(name))


def _sales_columns() -> dict[str, Column]:
    price = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return {
        "order_id": F.col("l_orderkey"),
        "line_number": F.col("l_linenumber").cast("long"),
        # kept as stored: a cast would stop date filters from reaching the scan
        "order_date": F.col("o_orderdate"),
        "ship_date": F.col("l_shipdate"),
        "customer_id": F.col("o_custkey"),
        "customer_name": F.col("c_name"),
        "segment": F.col("c_mktsegment"),
        "region": F.col("r_name"),
        "category": F.col("p_type"),
        "sub_category": F.col("p_brand"),
        "sales": price,
        "quantity": F.col("l_quantity"),
        # + 0.0 turns a negative zero into zero
        "discount": F.col("l_discount") + F.lit(0.0),
        "profit": price - F.col("l_quantity") * F.col("p_retailprice"),
    }


def sales(spark: SparkSession, folder: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Order lines with customer, product and region."""
    wanted = list(columns) if columns else list(SALES_TABLES)
    needed = {t for c in wanted for t in SALES_TABLES[c]}
    df = table(spark, folder, "lineitem")
    for name, (left, right) in SALES_JOINS.items():
        if name in needed:
            df = df.join(table(spark, folder, name), F.col(left) == F.col(right))
    made = _sales_columns()
    return df.select(*[made[c].alias(c) for c in wanted])


def loans(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as loans: purpose, approval, amount, and the customer's income and region key."""
    orders = table(spark, folder, "orders")
    customer = table(spark, folder, "customer")
    return orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").alias("loan_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderpriority").alias("loan_purpose"),
        F.when(F.col("o_orderstatus") == "F", "yes").otherwise("no").alias("approved"),
        F.col("o_totalprice").alias("loan_amount"),
        F.col("c_acctbal").alias("income"),
        F.col("c_mktsegment").alias("segment"),
    )


def activity(spark: SparkSession, folder: str) -> DataFrame:
    """Daily activity from events: date, kind, one case per event, its value."""
    events = table(spark, folder, "events")
    return events.select(
        F.col("ts").cast("date").alias("date"),
        F.col("event_type").alias("kind"),
        F.col("user_id"),
        F.lit(1).cast("long").alias("new_cases"),
        F.col("value").alias("hospitalized"),
    )


def shipments(spark: SparkSession, folder: str, with_site: bool = False) -> DataFrame:
    """Shipped lines by day, in the role of an outside daily series; optionally with the supplier's nation."""
    lines = table(spark, folder, "lineitem")
    columns = [
        F.col("l_shipdate").cast("date").alias("date"),
        F.lit(1).cast("long").alias("new_cases"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).cast("long").alias("new_deaths"),
        F.col("l_quantity").alias("hospitalized"),
    ]
    if with_site:
        supplier, nation = table(spark, folder, "supplier"), table(spark, folder, "nation")
        lines = lines.join(supplier, F.col("l_suppkey") == F.col("s_suppkey")).join(
            nation, F.col("s_nationkey") == F.col("n_nationkey")
        )
        columns.append(F.col("n_name").alias("site"))
    return lines.select(*columns)
