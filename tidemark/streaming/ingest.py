"""Files larger than memory, taken in bounded batches.

Each run reads the files that arrived since the last one (``availableNow``),
a few per batch, and remembers its progress in a checkpoint folder, so a
restarted job neither skips nor repeats a file.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, types as T

from tidemark.operators.aggregation import groupby_summary
from tidemark.operators.ordering import as_list


def read_files(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    fmt: str = "csv",
    files_per_batch: int = 50,
    **options,
) -> DataFrame:
    """Streaming table over a folder or pattern of files."""
    settings = {"header": True, **options} if fmt == "csv" else options
    return (
        spark.readStream.format(fmt).schema(schema).options(maxFilesPerTrigger=files_per_batch, **settings).load(path)
    )


def ingest_files(
    stream: DataFrame,
    output_path: str,
    checkpoint_path: str,
    transform: Callable[[DataFrame], DataFrame] = lambda df: df,
    partition_by: str | Sequence[str] | None = None,
) -> DataFrame:
    """Transform each batch and append it to a Parquet table; return that table.

    ``transform`` must be row-wise (cleaning without dedupe, casts, filters).
    The file sink's own log makes every batch appear exactly once.
    """
    result = transform(stream)
    writer = result.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint_path)
    if partition_by:
        writer = writer.partitionBy(*as_list(partition_by))
    query = writer.trigger(availableNow=True).start(output_path)
    query.awaitTermination()
    return stream.sparkSession.read.schema(result.schema).parquet(output_path)


def summarize_files(
    stream: DataFrame,
    output_path: str,
    checkpoint_path: str,
    group_col: str | Sequence[str],
    agg_dict: Mapping,
    transform: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> DataFrame:
    """Take in the new files, then group all rows taken in so far.

    Only new files are parsed; the grouping reads just the columns it needs
    from the Parquet table and combines before its shuffle.
    """
    return groupby_summary(ingest_files(stream, output_path, checkpoint_path, transform), group_col, agg_dict)
