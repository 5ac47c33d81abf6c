from __future__ import annotations

import shutil

import pytest

from tests.conftest import values
from tidemark.operators.aggregation import groupby_summary
from tidemark.operators.cleaning import clean_dataframe
from tidemark.streaming import GroupState, ingest_files, read_files, summarize_files, summarize_new_files


def clean_dataframe_rows(df):
    return clean_dataframe(df, dedupe=False)


def write(folder, name, rows):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("k,v\n" + "".join(f"{k},{v}\n" for k, v in rows))


def test_ingest_in_chunks_and_resume(spark, tmp_path):
    source, out, progress = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "progress")
    for i in range(5):
        write(source, f"{i}.csv", [(" A", i), ("b", i)])

    def run():
        stream = read_files(spark, str(source), "k string, v long", files_per_batch=2)
        return ingest_files(stream, out, progress, lambda df: clean_dataframe(df, dedupe=False))

    assert run().groupBy("k").count().orderBy("k").collect()[0].asDict() == {"k": "a", "count": 5}
    write(source, "late.csv", [("c", 7)])
    assert run().count() == 11  # only the new file is taken
    assert run().count() == 11


def test_running_summary_over_batches(spark, tmp_path):
    source = tmp_path / "in"
    for i in range(4):
        write(source, f"{i}.csv", [("a", 1), ("b", 10)] if i else [("a", 1)])
    args = (str(tmp_path / "out"), str(tmp_path / "progress"), "k", {"v": ["sum", "count"]})
    stream = lambda: read_files(spark, str(source), "k string, v long", files_per_batch=1)
    first = summarize_files(stream(), *args, transform=clean_dataframe_rows).orderBy("k")
    assert values(first, "k", "v_sum", "v_count") == [("a", 4, 4), ("b", 30, 3)]
    write(source, "late.csv", [("b", 5)])
    second = summarize_files(stream(), *args, transform=clean_dataframe_rows).orderBy("k")
    assert values(second, "k", "v_sum", "v_count") == [("a", 4, 4), ("b", 35, 4)]


STATES = {"v": ["sum", "count", "mean", "std", "var", "min", "max", "prod", "size", "any", "all"]}


def take(spark, source, folder, aggregates=None):
    stream = read_files(spark, str(source), "k string, v double", files_per_batch=2)
    return summarize_new_files(stream, str(folder), "k", aggregates or STATES)


def test_new_files_are_merged_into_the_state(spark, tmp_path):
    source, folder = tmp_path / "in", tmp_path / "out"
    rounds = [
        [("a", 1.5), ("b", 10), ("", 3)], [("a", ""), ("c", "")], [("a", -2), ("b", 10), ("b", 11)], [("c", 0)],
    ]
    every = []
    for i, rows in enumerate(rounds):
        write(source, f"{i}.csv", rows)
        every += rows
        found = take(spark, source, folder)
        want = groupby_summary(spark.read.schema("k string, v double").option("header", True).csv(str(source)), "k", STATES)
        assert found.columns == want.columns
        got, expected = ({r.k: r for r in df.collect()} for df in (found, want))
        assert got.keys() == expected.keys()
        for k in got:
            for x, y in zip(got[k], expected[k]):
                assert x == y or x == pytest.approx(y, rel=1e-12)


def test_old_rows_are_not_read_again(spark, tmp_path):
    source, folder = tmp_path / "in", tmp_path / "out"
    write(source, "0.csv", [("a", 1), ("a", 2)])
    take(spark, source, folder, {"v": "sum"})
    shutil.rmtree(folder / "rows" / "__run=1")
    write(source, "1.csv", [("a", 4)])
    assert values(take(spark, source, folder, {"v": "sum"}), "k", "v") == [("a", 7.0)]
    assert values(take(spark, source, folder, {"v": "sum"}), "k", "v") == [("a", 7.0)]  # nothing new


@pytest.mark.parametrize("cut_off", ["no success mark", "no state"])
def test_a_run_cut_off_is_done_again_once(spark, tmp_path, cut_off):
    source, folder = tmp_path / "in", tmp_path / "out"
    write(source, "0.csv", [("a", 1)])
    take(spark, source, folder, {"v": "sum"})
    write(source, "1.csv", [("a", 10)])
    take(spark, source, folder, {"v": "sum"})
    # rows and progress are there, the state isn't
    if cut_off == "no state":
        shutil.rmtree(folder / "state" / "2")
    else:
        (folder / "state" / "2" / "_SUCCESS").unlink()
    write(source, "2.csv", [("b", 100)])
    assert sorted(values(take(spark, source, folder, {"v": "sum"}), "k", "v")) == [("a", 11.0), ("b", 100.0)]


def test_aggregates_that_need_all_values_are_refused(spark, tmp_path):
    with pytest.raises(ValueError, match="nunique"):
        GroupState("k", {"v": ["sum", "nunique"]})
