"""File writers. Parent folders are created; a table is a folder of part files."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame

from tidemark.session import delete_at_exit, materialize, scratch_path


def save_csv(df: DataFrame, output_path: str, mode: str = "overwrite", **options) -> None:
    df.write.mode(mode).options(header=True, **options).csv(str(output_path))


def export_csv(df: DataFrame, path: str) -> None:
    """``save_csv`` with a note on where the result went."""
    save_csv(df, path)
    print(f"exported CSV to {path}")


def save_parquet(df: DataFrame, output_path: str, mode: str = "overwrite", **options) -> None:
    df.write.mode(mode).options(**options).parquet(str(output_path))


def save_by_region(
    df: DataFrame, output_path: str, by: str | Sequence[str] = "region", fmt: str = "parquet", mode: str = "overwrite"
) -> None:
    """One folder per value of ``by``.

    Rebalancing first gives each value few, evenly sized files: small values
    share a task, and adaptive execution splits a hot one over several.
    """
    keys = [by] if isinstance(by, str) else list(by)
    writer = df.hint("rebalance", *keys).write.mode(mode).partitionBy(*keys)
    (writer.option("header", True) if fmt == "csv" else writer).format(fmt).save(str(output_path))


def save_bucketed(df: DataFrame, table: str, key: str, buckets: int, mode: str = "overwrite") -> None:
    """Save as a table bucketed and sorted by a join key.

    Tables bucketed alike join on the key without a shuffle.
    """
    df.write.mode(mode).bucketBy(buckets, key).sortBy(key).format("parquet").saveAsTable(table)


def store_bucketed(df: DataFrame, keys: str | Sequence[str], buckets: int, path: str | None = None) -> DataFrame:
    """Store ``df`` bucketed and sorted by ``keys``, and read it back.

    Tables stored in as many buckets of the same keys join and group on them without a shuffle, as often as they
    are used. Spark knows buckets of catalog tables only, so the files are entered under a name of their own; once
    read, the table knows its layout and the entry goes again, the files stay at ``path`` (by default in the shared
    folder, until the session ends).
    """
    names = [keys] if isinstance(keys, str) else list(keys)
    spark = df.sparkSession
    name = f"bucketed_{uuid.uuid4().hex}"
    if path is None:
        path = scratch_path(spark, "bucketed")
        delete_at_exit(spark, path)
    df.write.mode("overwrite").bucketBy(buckets, *names).sortBy(*names).format("parquet").option("path", path).saveAsTable(name)
    try:
        stored = spark.table(name)
        stored.schema  # resolved now, while the entry is there
        return stored
    finally:
        spark.sql(f"DROP TABLE {name}")


def export_formats(df: DataFrame, base_path: str, formats: Sequence[str] = ("csv", "parquet")) -> list[str]:
    """Write one result in several formats, computing it once: it is stored in the shared folder first."""
    kept = materialize(df)
    paths = []
    for fmt in formats:
        path = f"{base_path}.{fmt}"
        if fmt == "csv":
            save_csv(kept, path)
        else:
            kept.write.mode("overwrite").format(fmt).save(path)
        paths.append(path)
    return paths
