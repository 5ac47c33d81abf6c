from __future__ import annotations

import pandas as pd
import pytest
from pyspark.sql import DataFrame, SparkSession

from tidemark.session import get_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory) -> SparkSession:
    session = get_session("tests", **{
        "spark.master": "local[4]",
        "spark.sql.shuffle.partitions": "4",
        # keep several blocks even on small tables
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "4g",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """Spark table from pandas, NaN turned into NULL."""

    def make(data, schema=None) -> DataFrame:
        pdf = data if isinstance(data, pd.DataFrame) else pd.DataFrame(data)

        def plain(v):
            if v is None or v != v:
                return None
            return v.to_pydatetime() if isinstance(v, pd.Timestamp) else v

        rows = [tuple(plain(v) for v in row) for row in pdf.astype(object).itertuples(index=False)]
        if schema is None:
            kinds = {"i": "long", "f": "double", "b": "boolean", "M": "timestamp"}
            schema = ", ".join(f"`{c}` {kinds.get(pdf[c].dtype.kind, 'string')}" for c in pdf.columns)
        return spark.createDataFrame(rows, schema)

    return make


def values(df: DataFrame, *columns: str) -> list:
    """Rows as tuples, or a flat list for one column, in table order."""
    rows = df.select(*columns).collect()
    return [r[0] for r in rows] if len(columns) == 1 else [tuple(r) for r in rows]
