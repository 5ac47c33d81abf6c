"""Reading and writing tables."""

from tidemark.sources.readers import (
    load_csv,
    load_json,
    load_parquet,
    load_regional_csv,
    load_typed_csv,
)
from tidemark.sources.writers import (
    export_csv,
    export_formats,
    save_bucketed,
    save_by_region,
    save_csv,
    save_parquet,
    store_bucketed,
)

__all__ = [
    "export_csv", "export_formats", "load_csv", "load_json", "load_parquet", "load_regional_csv",
    "load_typed_csv", "save_bucketed", "save_by_region", "save_csv", "save_parquet",
    "store_bucketed",
]
