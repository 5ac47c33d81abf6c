"""Column builders: text, dates, numbers and string expressions."""

from tidemark.functions.dates import (
    day,
    day_name,
    is_weekend,
    month,
    month_end,
    month_label,
    month_start,
    month_text,
    parse_date,
    parse_timestamp,
    weekday_number,
    year,
)
from tidemark.functions.expressions import evaluate, query
from tidemark.functions.numbers import (
    absolute,
    case_rate,
    cut,
    cut_labels,
    currency,
    death_rate,
    loan_to_income,
    map_values,
    nan_to_null,
    parse_number,
    percent,
    ratio,
    thousands,
    when_update,
)
from tidemark.functions.text import (
    collapse_spaces,
    contains,
    extract,
    last_part,
    lower,
    normalize,
    replace_literal,
    trim,
    upper,
)

__all__ = [
    "absolute", "case_rate", "collapse_spaces", "contains", "currency", "cut", "cut_labels",
    "day", "day_name", "death_rate", "evaluate", "extract", "is_weekend", "last_part",
    "loan_to_income", "lower", "map_values", "month", "month_end", "month_label", "month_start",
    "month_text", "nan_to_null", "normalize", "parse_date", "parse_number", "parse_timestamp",
    "percent", "query", "ratio", "replace_literal", "thousands", "trim", "upper",
    "weekday_number", "when_update", "year",
]
