"""File readers. A missing path raises ``FileNotFoundError``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, DataFrameReader, SparkSession, functions as F, types as T

from tidemark.functions.numbers import nan_to_null

# Fixed value: the last underscore-separated part of a CSV file or folder name.
REGION_IN_PATH = r"_([^_/]+)\.csv(?:/[^/]*)?$"

Schema = "T.StructType | str | None"


def _session(spark: SparkSession | None) -> SparkSession:
    return spark or SparkSession.active()


def _read(load: Callable[[], DataFrame], path: str) -> DataFrame:
    try:
        return load()
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "_LEGACY_ERROR_TEMP_1152"):
            raise FileNotFoundError(str(path)) from error
        raise


def _reader(spark: SparkSession | None, schema: Schema, options: dict) -> DataFrameReader:
    reader = _session(spark).read.options(**options)
    return reader.schema(schema) if schema is not None else reader


def load_csv(path: str, schema: Schema = None, spark: SparkSession | None = None, **options) -> DataFrame:
    """CSV with a header line. Without a schema the types are inferred, at the price of one more pass."""
    settings = {"header": True, "inferSchema": schema is None, **options}
    return nan_to_null(_read(lambda: _reader(spark, schema, settings).csv(str(path)), path))


def load_typed_csv(
    path: str,
    schema: T.StructType | str,
    date_format: str | None = None,
    timestamp_format: str | None = None,
    spark: SparkSession | None = None,
    **options,
) -> DataFrame:
    """CSV with fixed types and date formats: one pass, nothing inferred."""
    formats = {"dateFormat": date_format, "timestampFormat": timestamp_format}
    given = {k: v for k, v in formats.items() if v}
    return load_csv(path, schema, spark, **given, **options)


def load_json(
    path: str, schema: Schema = None, lines: bool = False, spark: SparkSession | None = None, **options
) -> DataFrame:
    """JSON array files, or with ``lines`` one object, or one array of objects, on each line.

    A file that is one array over many lines is read by one task, so large
    data should come as lines, which Spark can split.
    """
    settings = {"multiLine": not lines, **options}
    return nan_to_null(_read(lambda: _reader(spark, schema, settings).json(str(path)), path))


def load_parquet(
    path: str, spark: SparkSession | None = None, nan_as_null: bool = False, schema: Schema = None, **options
) -> DataFrame:
    """Parquet. ``nan_as_null`` is off so that filters still reach the scan."""
    df = _read(lambda: _reader(spark, schema, options).parquet(str(path)), path)
    return nan_to_null(df) if nan_as_null else df


def load_regional_csv(
    pattern: str,
    schema: Schema = None,
    region_col: str = "region",
    spark: SparkSession | None = None,
    **options,
) -> DataFrame:
    """All files ``…_<region>.csv`` of a pattern as one table.

    The region comes from each row's own file name (or the folder of that
    name, as Spark writes) where the files lack the column, so files may
    differ in length.
    """
    df = load_csv(pattern, schema, spark, **options)
    if region_col in df.columns:
        return df
    return df.withColumn(region_col, F.regexp_extract("_metadata.file_path", REGION_IN_PATH, 1))
