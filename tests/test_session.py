from __future__ import annotations

import os
from types import SimpleNamespace

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.session import arrow_batches, materialize, release, scratch_path, shared_folder


def test_shared_folder_is_the_configured_one(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x").startswith(shared_folder(spark))
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def fake(master: str, current: str | None = None):
    made = []
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: current, setCheckpointDir=made.append)
    return SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: d), sparkContext=context, made=made)


def test_no_machine_local_folder_on_a_cluster():
    with pytest.raises(RuntimeError):
        shared_folder(fake("yarn"))
    assert shared_folder(fake("yarn", "hdfs://shared")) == "hdfs://shared"
    local = fake("local[2]")
    assert shared_folder(local) == local.made[0]


def test_materialized_rows_are_fixed(spark):
    df = materialize(spark.range(50).withColumn("r", F.rand()))
    assert df.join(df.withColumnRenamed("r", "s"), "id").filter("r <> s").count() == 0
    plan = df.select("id")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<id:bigint>" in plan  # only the columns asked for


def test_stored_tables_can_be_released(spark):
    table = materialize(spark.range(10))
    path = table.inputFiles()[0].removeprefix("file://").rpartition("/")[0]
    assert os.path.isdir(path) and table.count() == 10
    release(table)
    assert not os.path.exists(path)
    release(spark.range(1))  # nothing stored, nothing to do


def test_batches_for_workers_are_small_inside(spark):
    def sizes():
        counted = spark.range(1000, numPartitions=1).mapInArrow(lambda batches: (pa.record_batch([[b.num_rows]], ["id"]) for b in batches), "id long")
        return [r["id"] for r in materialize(counted).collect()]

    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    usual = spark.conf.get(name)
    with pytest.raises(ValueError), arrow_batches(spark, 100):
        assert max(sizes()) == 100
        raise ValueError
    assert spark.conf.get(name) == usual and sizes() == [1000]
