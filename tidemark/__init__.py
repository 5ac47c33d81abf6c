"""PySpark-native operators for tables and time series."""

from tidemark.functions import evaluate, query
from tidemark.operators.aggregation import (
    binned_summary,
    compute_approval_rate,
    groupby_summary,
    grouped_totals,
    named_summary,
    rate_of,
    table_summary,
)
from tidemark.operators.calendar import (
    by_day,
    by_month_start,
    by_month_text,
    resample_daily,
    resample_monthly,
)
from tidemark.operators.cleaning import (
    align_customer_ids,
    clean_dataframe,
    drop_duplicates,
    drop_nulls,
    fill_nulls,
    standardize_strings,
)
from tidemark.operators.columns import normalize_names, one_hot, update_where
from tidemark.operators.filters import count_outliers_iqr, detect_outliers_iqr, search_text
from tidemark.operators.joins import check_merge_key_overlap, join_on_index, safe_merge
from tidemark.operators.narrowing import optimize_dataframe
from tidemark.operators.profile import describe, load_dataset_summary, missing_values, value_counts
from tidemark.operators.quantiles import quantiles
from tidemark.operators.ranking import rank_values
from tidemark.operators.reports import box_stats, gradient, highlight_max, histogram, totals_by_each
from tidemark.operators.reshape import melt_summary, pivot_cells, pivot_table_summary, stacked_groupby_unstack
from tidemark.operators.selection import head, nlargest, slice_rows, sort_values, tail, top_groups_detail
from tidemark.operators.stacking import concat_all, safe_concat
from tidemark.operators.windows import (
    cumulative_sum,
    forward_fill,
    grouped_eval,
    grouped_transform,
    pct_change,
    rolling_apply,
    rolling_mean,
    rolling_rank,
)
from tidemark.session import get_session
from tidemark.sources import (
    export_csv,
    export_formats,
    load_csv,
    load_json,
    load_parquet,
    load_regional_csv,
    load_typed_csv,
    save_by_region,
    save_csv,
    save_parquet,
    store_bucketed,
)
from tidemark.streaming import summarize_new_files
