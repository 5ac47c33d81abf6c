"""Query registry and the SQL form of the dataset views."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    name: str
    covers: tuple[str, ...]
    run: Run
    sql: str | None


ENTRIES: dict[str, Entry] = {}


def register(covers: str, sql: str | None = None) -> Callable[[Run], Run]:
    """Register a query under its function name; ``covers`` lists the inventory ids it shows."""

    def keep(run: Run) -> Run:
        if run.__name__ in ENTRIES:
            raise ValueError(f"two queries are named {run.__name__}")
        ENTRIES[run.__name__] = Entry(run.__name__, tuple(covers.split()), run, sql and " ".join(sql.split("\n")))
        return run

    return keep


def rounded(column: Column | str, digits: int = 6) -> Column:
    """Round a float result for comparison.

    Sums of the same numbers in another order differ in the last bits. A shift
    far below the rounding step keeps exact halves from falling either way.
    """
    c = F.col(column) if isinstance(column, str) else column
    return F.round(c + F.lit(10.0 ** -(digits + 3)), digits)


def sql_rounded(expression: str, digits: int = 6) -> str:
    return f"ROUND({expression} + 1e-{digits + 3}, {digits})"


def round_columns(df: DataFrame, **digits: int) -> DataFrame:
    return df.withColumns({c: rounded(c, n) for c, n in digits.items()})


VIEWS = {
    "sales": """
        SELECT l_orderkey AS order_id, CAST(l_linenumber AS BIGINT) AS line_number,
               CAST(o_orderdate AS DATE) AS order_date, CAST(l_shipdate AS DATE) AS ship_date,
               o_custkey AS customer_id, c_name AS customer_name, c_mktsegment AS segment,
               r_name AS region, p_type AS category, p_brand AS sub_category,
               l_extendedprice * (1 - l_discount) AS sales, l_quantity AS quantity,
               l_discount + 0.0 AS discount,
               l_extendedprice * (1 - l_discount) - l_quantity * p_retailprice AS profit
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
        JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey""",
    "loans": """
        SELECT o_orderkey AS loan_id, o_custkey AS customer_id, o_orderpriority AS loan_purpose,
               CASE WHEN o_orderstatus = 'F' THEN 'yes' ELSE 'no' END AS approved,
               o_totalprice AS loan_amount, c_acctbal AS income, c_mktsegment AS segment
        FROM orders JOIN customer ON o_custkey = c_custkey""",
    "activity": """
        SELECT CAST(ts AS DATE) AS date, event_type AS kind, user_id, CAST(1 AS BIGINT) AS new_cases,
               value AS hospitalized
        FROM events""",
    "shipments": """
        SELECT CAST(l_shipdate AS DATE) AS date, CAST(1 AS BIGINT) AS new_cases,
               CAST(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS BIGINT) AS new_deaths,
               l_quantity AS hospitalized, n_name AS site
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey""",
}


def over(views: str, body: str) -> str:
    """SQL body with the named views in front; further CTEs may open the body with a comma."""
    parts = ", ".join(f"{name} AS ({VIEWS[name]})" for name in views.split())
    return f"WITH {parts}{body}" if body.lstrip().startswith(",") else f"WITH {parts} {body}"


MONTH = "strftime({0}, '%Y-%m')"


def month_of(expression: str) -> str:
    return MONTH.format(expression)


def first_of_month(expression: str) -> str:
    return f"CAST(date_trunc('month', {expression}) AS DATE)"


# White space as Unicode defines it, as an SQL regular expression class.
SPACE = r"[\t-\r\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


def sql_trim(expression: str) -> str:
    return f"regexp_replace(regexp_replace({expression}, '^{SPACE}+', ''), '{SPACE}+$', '')"


def sql_normalize(expression: str) -> str:
    return f"regexp_replace(lower({sql_trim(expression)}), '{SPACE}+', ' ', 'g')"
