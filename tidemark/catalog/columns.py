"""Column operations and scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark import functions as fn
from tidemark.catalog.base import SPACE, over, register, round_columns, sql_rounded as r, sql_trim
from tidemark.operators import columns as ops
from tidemark.operators.aggregation import groupby_summary
from tidemark.operators.narrowing import optimize_dataframe, schema_table
from tidemark.operators.selection import slice_rows
from tidemark.plans.views import loans, sales, shipments, table


@register("R1", """
    SELECT c_custkey AS customer_id, c_name AS customer_name, c_mktsegment AS sub_segment FROM customer""")
def normalize_column_names(spark: SparkSession, path: str) -> DataFrame:
    raw = table(spark, path, "customer").select(
        F.col("c_custkey").alias(" Customer ID"), F.col("c_name").alias("Customer Name "),
        F.col("c_mktsegment").alias("Sub-Segment"),
    )
    return ops.normalize_names(raw)


@register("R2", "SELECT p_partkey, p_name FROM part")
def select_two_columns(spark: SparkSession, path: str) -> DataFrame:
    return ops.select_columns(table(spark, path, "part"), ["p_partkey", "p_name"])


@register("R3", "SELECT n_nationkey AS nation_id, n_name AS nation, n_regionkey FROM nation")
def rename_two_columns(spark: SparkSession, path: str) -> DataFrame:
    return ops.rename_columns(table(spark, path, "nation"), {"n_nationkey": "nation_id", "n_name": "nation"})


@register("R4", "SELECT s_suppkey, s_name, s_nationkey FROM supplier")
def drop_one_column(spark: SparkSession, path: str) -> DataFrame:
    return ops.drop_columns(table(spark, path, "supplier"), ["s_acctbal"])


@register("R5", f"""
    SELECT l_orderkey, l_linenumber, {r('l_extendedprice * (1 - l_discount)', 4)} AS net,
           {r('l_extendedprice * (1 - l_discount) * (1 + l_tax)', 4)} AS charge
    FROM lineitem""")
def assign_in_chain(spark: SparkSession, path: str) -> DataFrame:
    df = ops.assign(
        table(spark, path, "lineitem"),
        net=lambda d: d.l_extendedprice * (1 - d.l_discount),
        charge=lambda d: d.net * (1 + d.l_tax),
    )
    return round_columns(df.select("l_orderkey", "l_linenumber", "net", "charge"), net=4, charge=4)


@register("R6 X14", over("loans", f"""
    SELECT loan_id, {r('loan_amount / nullif(income, 0)')} AS loan_to_income_ratio FROM loans"""))
def evaluate_ratio(spark: SparkSession, path: str) -> DataFrame:
    df = fn.evaluate(loans(spark, path), "loan_to_income_ratio = loan_amount / income")
    return round_columns(df.select("loan_id", "loan_to_income_ratio"), loan_to_income_ratio=6)


@register("R6 X14", f"""
    SELECT l_orderkey, l_linenumber, {r('l_quantity + l_tax * l_extendedprice', 4)} AS result,
           {r('l_tax / nullif(l_discount + 0.0, 0) * 100', 6)} AS tax_pct_of_discount
    FROM lineitem""")
def evaluate_arithmetic(spark: SparkSession, path: str) -> DataFrame:
    df = fn.evaluate(table(spark, path, "lineitem"), "result = l_quantity + l_tax * l_extendedprice")
    df = fn.evaluate(df, "tax_pct_of_discount = l_tax / (l_discount + 0.0) * 100")
    return round_columns(
        df.select("l_orderkey", "l_linenumber", "result", "tax_pct_of_discount"), result=4, tax_pct_of_discount=6
    )


@register("R6 F2 F3", """
    SELECT l_orderkey, l_linenumber, CAST(pow(l_linenumber + 1, 4) AS DOUBLE) AS score FROM lineitem
    WHERE NOT (l_quantity > 25) AND l_discount > 0.05""")
def evaluate_powers_and_negation(spark: SparkSession, path: str) -> DataFrame:
    """Powers group from the right, ``~`` negates a condition."""
    lines = fn.query(table(spark, path, "lineitem"), "~(l_quantity > 25) & l_discount > 0.05")
    return fn.evaluate(lines, "score = (l_linenumber + 1) ** 2 ** 2").select("l_orderkey", "l_linenumber", "score")


@register("R7", """
    SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_totalprice AS BIGINT) AS o_totalprice,
           CAST(o_orderdate AS DATE) AS o_orderdate
    FROM (SELECT o_orderkey, floor(o_totalprice) AS o_totalprice, o_orderdate FROM orders)""")
def cast_column_types(spark: SparkSession, path: str) -> DataFrame:
    df = table(spark, path, "orders").select("o_orderkey", F.floor("o_totalprice").alias("o_totalprice"), "o_orderdate")
    return ops.cast_columns(df, {"o_orderkey": "string", "o_totalprice": "bigint", "o_orderdate": "date"})


@register("R8", """
    SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) END AS order_date FROM orders""")
def parse_dates_or_null(spark: SparkSession, path: str) -> DataFrame:
    """Dates as text, unreadable for pending orders."""
    text = F.when(F.col("o_orderstatus") == "P", "pending").otherwise(F.date_format("o_orderdate", "dd.MM.yyyy"))
    return table(spark, path, "orders").select("o_orderkey", fn.parse_date(text, "dd.MM.yyyy").alias("order_date"))


@register("R9", """
    SELECT p_partkey, try_cast(CASE WHEN p_size > 40 THEN 'n/a' ELSE CAST(p_size AS VARCHAR) END AS DOUBLE) AS size
    FROM part""")
def parse_numbers_or_null(spark: SparkSession, path: str) -> DataFrame:
    text = F.when(F.col("p_size") > 40, "n/a").otherwise(F.col("p_size").cast("string"))
    return table(spark, path, "part").select("p_partkey", fn.parse_number(text).alias("size"))


# A partial lookup from event kind to channel.
CHANNELS = {"view": "web", "click": "web", "purchase": "shop", "signup": "web"}


@register("R10", """
    SELECT event_id, CASE event_type WHEN 'view' THEN 'web' WHEN 'click' THEN 'web' WHEN 'purchase' THEN 'shop'
                     WHEN 'signup' THEN 'web' END AS channel
    FROM events""")
def map_through_dictionary(spark: SparkSession, path: str) -> DataFrame:
    return table(spark, path, "events").select("event_id", fn.map_values("event_type", CHANNELS).alias("channel"))


@register("R11 D5", """
    SELECT p_partkey, upper(p_name) || ' (' || p_size || ')' AS label FROM part""")
def apply_to_elements(spark: SparkSession, path: str) -> DataFrame:
    df = ops.apply_to_column(
        table(spark, path, "part"), "p_name", lambda c: F.concat(F.upper(c), F.lit(" ("), F.col("p_size"), F.lit(")")),
        "label",
    )
    return df.select("p_partkey", "label")


@register("R12", """
    SELECT p_partkey, CASE WHEN p_size >= 1 AND p_size < 10 THEN '[1, 10)' WHEN p_size >= 10 AND p_size < 20 THEN '[10, 20)'
        WHEN p_size >= 20 AND p_size < 30 THEN '[20, 30)' WHEN p_size >= 30 AND p_size < 40 THEN '[30, 40)'
        WHEN p_size >= 40 AND p_size < 50 THEN '[40, 50)' END AS bracket
    FROM part""")
def cut_into_bins(spark: SparkSession, path: str) -> DataFrame:
    """Size 50 lies outside the last half-open bin."""
    return table(spark, path, "part").select("p_partkey", fn.cut("p_size", [1, 10, 20, 30, 40, 50]).alias("bracket"))


@register("R13", """
    SELECT c_custkey, c_mktsegment = 'AUTOMOBILE' AS c_mktsegment_AUTOMOBILE, c_mktsegment = 'BUILDING' AS c_mktsegment_BUILDING,
           c_mktsegment = 'FURNITURE' AS c_mktsegment_FURNITURE, c_mktsegment = 'HOUSEHOLD' AS c_mktsegment_HOUSEHOLD,
           c_mktsegment = 'MACHINERY' AS c_mktsegment_MACHINERY
    FROM customer""")
def one_hot_segments(spark: SparkSession, path: str) -> DataFrame:
    return ops.one_hot(table(spark, path, "customer").select("c_custkey", "c_mktsegment"), "c_mktsegment")


@register("R14", f"""
    SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag, {r('l_tax', 4)} AS l_tax FROM lineitem""")
def narrow_column_types(spark: SparkSession, path: str) -> DataFrame:
    """Same values after narrowing; compared as the wide types."""
    df = table(spark, path, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", "l_tax")
    narrow = optimize_dataframe(df, ["l_returnflag"], verbose=False)
    wide = ops.cast_columns(narrow, {f.name: f.dataType.simpleString() for f in df.schema.fields})
    return round_columns(wide, l_tax=4)


@register("R14", """
    WITH s AS (SELECT max(l_orderkey) AS k, max(l_linenumber) AS n, max(l_quantity) AS q,
                      max(abs(CAST(CAST(l_extendedprice AS FLOAT) AS DOUBLE) - l_extendedprice)) AS moved FROM lineitem)
    SELECT 'l_orderkey' AS "column", CASE WHEN k <= 127 THEN 'tinyint' WHEN k <= 32767 THEN 'smallint'
           WHEN k <= 2147483647 THEN 'int' ELSE 'bigint' END AS dtype FROM s
    UNION ALL SELECT 'l_linenumber', CASE WHEN n <= 127 THEN 'tinyint' ELSE 'int' END FROM s
    UNION ALL SELECT 'l_quantity', 'float' FROM s
    UNION ALL SELECT 'l_extendedprice', CASE WHEN moved <= 0.0005 THEN 'float' ELSE 'double' END FROM s""")
def narrowed_schema(spark: SparkSession, path: str) -> DataFrame:
    df = table(spark, path, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    return schema_table(optimize_dataframe(df, verbose=False))


@register("R15", over("sales", f"""
    SELECT order_id, line_number, {r('abs(profit)', 4)} AS size FROM sales"""))
def absolute_profit(spark: SparkSession, path: str) -> DataFrame:
    df = sales(spark, path, ["order_id", "line_number", "profit"])
    return round_columns(df.select("order_id", "line_number", fn.absolute("profit").alias("size")), size=4)


@register("R16", """
    SELECT c_custkey, c_acctbal, CASE WHEN c_acctbal < 0 THEN 'DEBTOR' ELSE c_mktsegment END AS c_mktsegment
    FROM customer""")
def update_on_condition(spark: SparkSession, path: str) -> DataFrame:
    df = table(spark, path, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    return ops.update_where(df, F.col("c_acctbal") < 0, "c_mktsegment", "DEBTOR")


@register("R17", """
    SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 500 OFFSET 1000""")
def slice_by_position(spark: SparkSession, path: str) -> DataFrame:
    """Positions are the feature: rows 1000 up to 1500 of the whole table by price."""
    return slice_rows(
        table(spark, path, "orders"), 1000, 1500, ["o_totalprice", "o_orderkey"], ["o_orderkey", "o_totalprice"]
    )


@register("R18", """
    SELECT l_returnflag, l_linestatus, sum(l_quantity) AS l_quantity FROM lineitem GROUP BY ALL""")
def keys_stay_columns(spark: SparkSession, path: str) -> DataFrame:
    """``reset=False`` gives the same table: there is no index to hide the keys in."""
    return groupby_summary(
        table(spark, path, "lineitem"), ["l_returnflag", "l_linestatus"], {"l_quantity": "sum"}, reset=False
    )


@register("R19", over("shipments", f"""
    SELECT site, {r('sum(new_deaths) / nullif(sum(new_cases), 0) * 100')} AS death_rate,
           {r('sum(new_cases) / nullif(sum(hospitalized), 0) * 100000', 4)} AS case_rate
    FROM shipments GROUP BY site"""))
def documented_rates(spark: SparkSession, path: str) -> DataFrame:
    totals = groupby_summary(
        shipments(spark, path, with_site=True), "site", {"new_deaths": "sum", "new_cases": "sum", "hospitalized": "sum"}
    )
    rates = totals.select(
        "site",
        fn.death_rate("new_deaths", "new_cases").alias("death_rate"),
        fn.case_rate("new_cases", "hospitalized").alias("case_rate"),
    )
    return round_columns(rates, death_rate=6, case_rate=4)


@register("R19", over("loans", f"""
    SELECT loan_id, {r('loan_amount / nullif(income, 0)')} AS loan_to_income FROM loans"""))
def loan_income_ratio(spark: SparkSession, path: str) -> DataFrame:
    df = loans(spark, path).select("loan_id", fn.loan_to_income("loan_amount", "income").alias("loan_to_income"))
    return round_columns(df, loan_to_income=6)


@register("X1", rf"""
    SELECT doc_id, {sql_trim("chr(9) || ' ' || text || chr(160) || chr(10)")} AS text FROM documents""")
def trim_text(spark: SparkSession, path: str) -> DataFrame:
    """Whole texts with a tab, a blank, a no-break space and a line end put around them."""
    padded = F.concat(F.lit("\t "), F.col("text"), F.lit(" \n"))
    return table(spark, path, "documents").select("doc_id", fn.trim(padded).alias("text"))


@register("X2", "SELECT p_partkey, lower(p_name) AS low, upper(p_name) AS up FROM part")
def change_case(spark: SparkSession, path: str) -> DataFrame:
    return table(spark, path, "part").select("p_partkey", fn.lower("p_name").alias("low"), fn.upper("p_name").alias("up"))


@register("X3", f"""
    SELECT conv_id, turn, regexp_replace(text, '{SPACE}+', ' ', 'g') AS text FROM conversations""")
def collapse_white_space(spark: SparkSession, path: str) -> DataFrame:
    return table(spark, path, "conversations").select("conv_id", "turn", fn.collapse_spaces("text").alias("text"))


@register("X4", "SELECT p_partkey, replace(p_name, ' ', '_') AS name FROM part")
def replace_literal_text(spark: SparkSession, path: str) -> DataFrame:
    return table(spark, path, "part").select("p_partkey", fn.replace_literal("p_name", " ", "_").alias("name"))


@register("X5", """
    SELECT page_id, regexp_matches(html, '(?i)</SCRIPT>') AS has_script FROM pages""")
def match_pattern(spark: SparkSession, path: str) -> DataFrame:
    return table(spark, path, "pages").select("page_id", fn.contains("html", "</SCRIPT>", case=False).alias("has_script"))


@register("X6", r"""
    SELECT page_id, nullif(regexp_extract(url, 'page=(\d+)', 1), '') AS page_number FROM pages""")
def extract_group(spark: SparkSession, path: str) -> DataFrame:
    return table(spark, path, "pages").select("page_id", fn.extract("url", r"page=(\d+)").alias("page_number"))


@register("X7", """
    SELECT c_custkey, replace(list_extract(string_split(c_name || '_' || c_mktsegment || '.csv', '_'), -1), '.csv', '') AS part
    FROM customer""")
def last_piece_of_name(spark: SparkSession, path: str) -> DataFrame:
    name = F.concat("c_name", F.lit("_"), "c_mktsegment", F.lit(".csv"))
    return table(spark, path, "customer").select("c_custkey", fn.last_part(name, "_", ".csv").alias("part"))


@register("X8 X9 X10", """
    SELECT o_orderkey, year(o_orderdate) AS year, month(o_orderdate) AS month, day(o_orderdate) AS day,
           dayname(o_orderdate) AS weekday, isodow(o_orderdate) - 1 AS weekday_number,
           isodow(o_orderdate) >= 6 AS is_weekend
    FROM orders""")
def date_parts(spark: SparkSession, path: str) -> DataFrame:
    d = "o_orderdate"
    return table(spark, path, "orders").select(
        "o_orderkey",
        fn.year(d).cast("long").alias("year"), fn.month(d).cast("long").alias("month"),
        fn.day(d).cast("long").alias("day"), fn.day_name(d).alias("weekday"),
        fn.weekday_number(d).cast("long").alias("weekday_number"), fn.is_weekend(d).alias("is_weekend"),
    )


@register("X11 X12", """
    SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month_start,
           last_day(CAST(o_orderdate AS DATE)) AS month_end, strftime(o_orderdate, '%Y-%m') AS month_text,
           strftime(o_orderdate, '%b %Y') AS month_label
    FROM orders""")
def month_labels(spark: SparkSession, path: str) -> DataFrame:
    d = "o_orderdate"
    return table(spark, path, "orders").select(
        "o_orderkey", fn.month_start(d).alias("month_start"), fn.month_end(d).alias("month_end"),
        fn.month_text(d).alias("month_text"), fn.month_label(d).alias("month_label"),
    )


@register("X13", """
    SELECT o_orderkey, '$' || format('{:,.2f}', o_totalprice) AS price,
           format('{:,}', o_orderkey) AS number
    FROM orders""")
def money_text(spark: SparkSession, path: str) -> DataFrame:
    return table(spark, path, "orders").select(
        "o_orderkey", fn.currency("o_totalprice").alias("price"), fn.thousands("o_orderkey").alias("number")
    )


@register("R15 F1", """
    SELECT l_orderkey AS order_id, CAST(l_linenumber AS BIGINT) AS line, CAST(l_quantity % nullif(l_linenumber - 3, 0) AS DOUBLE) AS rest,
           CAST(floor(l_quantity * 2 / nullif(l_linenumber - 3, 0)) AS BIGINT) AS whole
    FROM lineitem WHERE (l_returnflag IN ('A', 'R') OR l_tax / 1e-3 > 70) AND l_quantity * l_quantity > 100""")
def evaluate_string_operators(spark: SparkSession, path: str) -> DataFrame:
    """Membership lists, ``&``, ``|``, exponents in numbers, ``**``, ``//`` and ``%`` with zero divisors."""
    lines = table(spark, path, "lineitem").withColumn("step", F.col("l_linenumber") - 3)
    kept = fn.query(lines, "(l_returnflag in ['A', 'R'] | l_tax / 1e-3 > 70) & l_quantity ** 2 > 100")
    made = fn.evaluate(fn.evaluate(kept, "rest = l_quantity % step"), "whole = l_quantity * 2 // step")
    return made.select(F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").cast("long").alias("line"), "rest", F.col("whole").cast("long").alias("whole"))
