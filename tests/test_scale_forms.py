"""Forms for large inputs: sketched thresholds, bucketed joins, observed
reports, compacted stream output. Each gives the rows of its plain form."""

from __future__ import annotations

import datetime as dt
import os
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quarry.operators import sketch
from quarry.operators import weblog as L
from quarry.operators.aggregates import count_by, more_than
from quarry.plans import weblog as PW
from quarry.plans.catalog import QUERIES
from quarry.session import list_folder, scratch_path
from quarry.sources.bucketed import bucket_together
from quarry.streaming import compaction
from quarry.streaming.runner import start_to_files
from tests.conftest import conf, local_dir, rows

SF = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


# --- thresholds behind a sketch ------------------------------------------------

@pytest.fixture(scope="module")
def many_keys(spark):
    rng = random.Random(1)
    keys = [f"rare{i}" for i in range(3000)] + ["hot"] * 3000 + [f"mid{i % 40}" for i in range(600)]
    keys += [None] * 30 + [""] * 5
    rng.shuffle(keys)
    return spark.createDataFrame([(k,) for k in keys], "k string").repartition(6).cache()


@pytest.mark.parametrize("width,hashes", [(1, 1), (8, 2), (64, 1), (1024, 2), (1 << 16, 3)])
@pytest.mark.parametrize("threshold", [0, 4, 14, 15, 2999, 3000])
def test_any_size_of_the_sketch_gives_the_same_rows(many_keys, width, hashes, threshold):
    plain = more_than(count_by(many_keys, "k"), "count", threshold)
    got = sketch.frequent_keys(many_keys, "k", threshold, width, hashes)
    assert rows(got) == rows(plain)


def _shuffled_rows(df) -> int:
    """Rows written into the exchanges of the plan that ran."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    found, todo = 0, [plan]
    while todo:
        p = todo.pop()
        name = p.nodeName()
        if name == "AdaptiveSparkPlan":
            todo.append(p.executedPlan())
            continue
        if "QueryStage" in name:
            todo.append(p.plan())
            continue
        if name == "Exchange":
            found += p.metrics().apply("shuffleRecordsWritten").value()
        children = p.children()
        todo += [children.apply(i) for i in range(children.size())]
    return found


def test_the_sketch_keeps_rare_keys_out_of_the_shuffle(many_keys):
    plain = more_than(count_by(many_keys, "k"), "count", 10)
    got = sketch.frequent_keys(many_keys, "k", 10, 1 << 14)
    assert _shuffled_rows(plain) > 3000
    assert _shuffled_rows(got) < 600  # the 42 frequent keys in 6 tasks, and few by chance


def test_the_broadcast_is_bounded_by_the_width(spark, many_keys):
    heavy = sketch.heavy_counters(many_keys, "k", 0, 16, 2)
    assert heavy.count() == 32
    plan = sketch.frequent_keys(many_keys, "k", 4)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") == 2 and "partial_count" in plan


def test_an_empty_input(spark):
    none = spark.createDataFrame([], "k string")
    assert sketch.frequent_keys(none, "k", 1).collect() == []


# --- bucketed joins ------------------------------------------------------------

def _exchanges_under_joins(df) -> int:
    plan = df._jdf.queryExecution().executedPlan().toString()
    return len(re.findall(r"Exchange ", plan))


@needs_data
def test_a_bucketed_join_has_no_exchange(spark):
    with conf(spark, spark__sql__autoBroadcastJoinThreshold="-1",
              spark__sql__adaptive__enabled="false"):
        df = QUERIES["bucketed_join"](spark, SF)
        assert _exchanges_under_joins(df) == 0
        assert "SortMergeJoin" in df._jdf.queryExecution().executedPlan().toString()
        assert _exchanges_under_joins(QUERIES["inner_join"](spark, SF)) == 2


LEFT = [(i, f"u{i}") for i in range(50)] + [(3, "again"), (None, "nobody")]
RIGHT = [(i % 70, i) for i in range(400)] + [(7, i) for i in range(2000)] + [(None, -1), (None, -2)]


@pytest.mark.parametrize("how", ["inner", "right"])
@pytest.mark.parametrize("buckets", [1, 4, 16])
def test_bucketed_joins_with_a_hot_key_and_nulls(spark, how, buckets):
    left = spark.createDataFrame(LEFT, "id bigint, name string")
    right = spark.createDataFrame(RIGHT, "user bigint, n bigint")
    pair = bucket_together(left, right, "id", "user", buckets)
    want = left.join(right, F.col("id") == F.col("user"), how)
    assert rows(pair.join(how)) == rows(want)
    assert pair.hot_right is not None
    if buckets > 1:
        assert pair.right.where("user = 7").isEmpty()  # not held in one bucket
    files = [f for f in os.listdir(local_dir(pair.right.inputFiles()[0].rpartition("/")[0]))
             if f.startswith("part-")]
    assert len(files) <= buckets
    pair.drop()
    assert not any(spark.catalog.tableExists(t) for t in pair.tables)


def test_bucketed_joins_without_hot_keys_and_of_empty_tables(spark):
    left = spark.createDataFrame(LEFT[:50], "id bigint, name string")
    for rows_ in ([(i % 50, i) for i in range(200)], []):
        right = spark.createDataFrame(rows_, "user bigint, n bigint")
        pair = bucket_together(left, right, "id", "user", 4)
        assert pair.hot_right is None
        assert pair.join().count() == len(rows_)
        pair.drop()


def test_keys_must_be_of_one_type(spark):
    left = spark.createDataFrame([(1,)], "id int")
    with pytest.raises(TypeError):
        bucket_together(left, spark.createDataFrame([(1,)], "user bigint"), "id", "user")
    good = bucket_together(left, spark.createDataFrame([(1,)], "user int"), "id", "user", 2)
    with pytest.raises(ValueError):
        good.join("left")
    good.drop()


# --- the batch log report in one pass ------------------------------------------

def _line(i, size):
    return f'10.0.0.{i % 5} - - [01/Jan/2024:00:00:00 +0000] "GET /{i % 3} HTTP/1.1" 200 {size}'


def test_observed_reports_equal_scanned_ones(spark, tmp_path):
    for n in (0, 1, 300):
        lines = spark.createDataFrame(
            [(_line(i, i * 7),) for i in range(n)] + [("junk",)], "value string").repartition(5)
        got = {}
        for how in ("table", "cache"):
            paths = PW.log_report(lines, str(tmp_path / f"{how}{n}"), 10, 3, materialize=how)
            got[how] = {k: rows(spark.read.parquet(p)) for k, p in paths.items()}
            types = {k: spark.read.parquet(p).dtypes for k, p in paths.items()}
            got[how]["types"] = types
        assert got["table"] == got["cache"]
        logs = L.parse_access_log(lines)
        assert got["table"]["log_stats"] == rows(L.log_stats(logs))


def test_totals_cost_no_scan_of_the_records(spark, tmp_path):
    from quarry.session import scratch

    lines = spark.createDataFrame([(_line(i, i),) for i in range(50)], "value string")
    with scratch(spark):
        totals = PW._write_observed(L.parse_access_log(lines), scratch_path(spark, "t-observed"))
        for df in totals.values():
            assert "FileScan" not in df._jdf.queryExecution().executedPlan().toString()
        assert totals["response_code_total"].first()[0] == 50


# --- compaction ----------------------------------------------------------------

@pytest.fixture
def day_table(spark, tmp_path):
    """A day-partitioned table of the file sink, written in many batches."""
    feed, out = tmp_path / "feed", str(tmp_path / "out")
    feed.mkdir()
    for i in range(6):
        base = 1704067200 + i * 43200  # two files a day
        text = "".join(f'{{"window_start_epoch": {base + j}, "n": {j}}}\n' for j in range(4))
        (feed / f"{i}.json").write_text(text)
    stream = spark.readStream.schema("window_start_epoch bigint, n bigint").option(
        "maxFilesPerTrigger", "1").json(str(feed))
    q = start_to_files(compaction.with_day(stream), out, str(tmp_path / "ck"), partition_by="day")
    q.awaitTermination()
    return out


def test_compacted_days_keep_every_row(spark, tmp_path, day_table):
    done = str(tmp_path / "done")
    whole = rows(spark.read.parquet(day_table))
    assert rows(compaction.read_days(spark, day_table, done)) == whole and len(whole) == 24
    days = compaction.compact_days(spark, day_table, done, dt.date(2024, 1, 3))
    assert days == [dt.date(2024, 1, 1), dt.date(2024, 1, 2)]
    got = compaction.read_days(spark, day_table, done)
    assert rows(got) == whole
    files = Counter(os.path.dirname(f) for f in got.inputFiles())
    assert all(n == 1 for d, n in files.items() if "/done/" in d)
    # again: nothing to do; later: the next day
    assert compaction.compact_days(spark, day_table, done, dt.date(2024, 1, 3)) == []
    assert compaction.compact_days(spark, day_table, done, dt.date(2025, 1, 1)) == [dt.date(2024, 1, 3)]
    assert rows(compaction.read_days(spark, day_table, done)) == whole


def test_reads_are_pruned_to_their_days(spark, tmp_path, day_table):
    done = str(tmp_path / "done")
    compaction.compact_days(spark, day_table, done, dt.date(2024, 1, 3))
    got = compaction.read_days(spark, day_table, done).where("day = date'2024-01-02'")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan
    assert got.count() == 8
    # a compacted day's small files are not opened: they may be gone
    for path, _ in list_folder(spark, day_table):
        if path.endswith("2024-01-02"):
            for f in os.listdir(local_dir(path)):
                os.unlink(os.path.join(local_dir(path), f))
    assert got.count() == 8
    assert compaction.read_days(spark, day_table, done).count() == 24


def test_uncommitted_files_are_not_compacted(spark, tmp_path, day_table):
    done = str(tmp_path / "done")
    whole = spark.read.parquet(day_table).count()
    folder = os.path.join(day_table, "day=2024-01-01")
    name = next(f for f in os.listdir(folder) if f.endswith(".parquet"))
    with open(os.path.join(folder, name), "rb") as f:
        data = f.read()
    with open(os.path.join(folder, "part-99999-of-a-failed-task.snappy.parquet"), "wb") as f:
        f.write(data)
    compaction.compact_days(spark, day_table, done, dt.date(2024, 1, 2))
    assert compaction.read_days(spark, day_table, done).count() == whole


def test_a_failed_run_is_finished_by_the_next(spark, tmp_path, day_table, monkeypatch):
    done = str(tmp_path / "done")
    whole = rows(spark.read.parquet(day_table))
    moved, move = [], compaction.move_folder

    def once(spark, source, target):
        if moved:
            raise OSError("lost")
        moved.append(target)
        move(spark, source, target)

    monkeypatch.setattr(compaction, "move_folder", once)
    with pytest.raises(OSError):
        compaction.compact_days(spark, day_table, done, dt.date(2025, 1, 1))
    assert rows(compaction.read_days(spark, day_table, done)) == whole
    monkeypatch.setattr(compaction, "move_folder", move)
    assert len(compaction.compact_days(spark, day_table, done, dt.date(2025, 1, 1))) == 2
    assert rows(compaction.read_days(spark, day_table, done)) == whole
