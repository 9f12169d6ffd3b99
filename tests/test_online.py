"""Streaming state over many batches: equal to one batch, restarts, late rows, summaries."""

import datetime
import os
import random
from collections import Counter

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from freqscope.operators import summary
from freqscope.streaming import online, store


@pytest.fixture(autouse=True)
def few_partitions(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", "8")


def write_files(rows, folder, first=0):
    """One file per list of (seconds, type, user); files arrive in order."""
    os.makedirs(f"{folder}/events.parquet", exist_ok=True)
    base = datetime.datetime(2024, 1, 1)
    for k, part in enumerate(rows, first):
        path = f"{folder}/events.parquet/part-{k:04d}.parquet"
        pq.write_table(pa.table({"event_id": pa.array(range(len(part)), pa.int64()),
                                 "ts": pa.array([base + datetime.timedelta(seconds=r[0]) for r in part], pa.timestamp("us")),
                                 "user_id": pa.array([r[2] for r in part], pa.int64()),
                                 "event_type": [r[1] for r in part]}), path)
        os.utime(path, (1_700_000_000 + k, 1_700_000_000 + k))


def events(spark, parts):
    """The events of the smallest table, nearly in time order, in ``parts`` lists."""
    base = datetime.datetime(2024, 1, 1)
    rows = spark.read.parquet(f"{SF_SMALL}/events.parquet").select("ts", "event_type", "user_id").collect()
    rng = random.Random(1)
    out = [(int((r["ts"] - base).total_seconds()), r["event_type"], r["user_id"]) for r in rows]
    out.sort(key=lambda r: r[0] + rng.randint(0, 200 * 3600))
    return [out[k * len(out) // parts:(k + 1) * len(out) // parts] for k in range(parts)]


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("part", [online.Cells, online.Bursts, online.Hitters, online.Snapshots, online.Loss])
def test_many_batches_equal_one(spark, tmp_path, monkeypatch, part):
    monkeypatch.setattr(store, "FAN", 2)
    parts = events(spark, 5)
    write_files(parts[:3], str(tmp_path))
    job = online.Online(spark, str(tmp_path), part, max_files=1)
    assert job.run() == 3
    early = rows_of(job.result(3))
    write_files(parts[3:], str(tmp_path), 3)
    again = online.Online(spark, str(tmp_path), part, max_files=1)  # a driver that starts again
    assert again.run() == 5
    late = rows_of(again.result(5))
    assert early and late != early
    assert again.run() == 5 and rows_of(again.result(5)) == late
    write_files([sum(parts, [])], f"{tmp_path}/one")
    one = online.Online(spark, f"{tmp_path}/one", part)
    assert one.run() == 1 and rows_of(one.result(1)) == late


def test_a_batch_that_breaks_counts_once(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(store, "FAN", 2)
    parts = events(spark, 5)
    write_files(parts, str(tmp_path))
    job = online.Online(spark, str(tmp_path), online.Bursts, max_files=1)
    whole, broken = job.part.step, []

    def step(batch):
        whole(batch)
        if batch.number == 3 and not broken:
            broken.append(1)
            raise RuntimeError("lost")

    job.part.step = step
    with pytest.raises(Exception, match="lost"):
        job.run()
    assert job.batches() == 3
    again = online.Online(spark, str(tmp_path), online.Bursts, max_files=1)
    assert again.run() == 5
    write_files([sum(parts, [])], f"{tmp_path}/one")
    one = online.Online(spark, f"{tmp_path}/one", online.Bursts)
    assert rows_of(again.result(5)) == rows_of(one.result(one.run()))


def test_late_rows_are_counted_over_all_batches(spark, tmp_path):
    hour = 3600
    parts = [[(2000 * hour, "a", 1)]] + [[((2000 + k) * hour, "a", 1), (k * hour, "b", k)] for k in range(1, 104)]
    parts.append([(1900 * hour, "c", 1), (10 * hour, "b", 1)])
    write_files(parts, str(tmp_path))
    job = online.Online(spark, str(tmp_path), online.Loss, max_files=1)
    n = job.run()
    assert n == 105
    got = job.result(n).first()
    epoch = int((datetime.datetime(2024, 1, 1) - datetime.datetime(1970, 1, 1)).total_seconds()) // hour
    assert tuple(got) == (1 + 2 * 103 + 2, 104, epoch + 2103)
    late = {(r["hour"] - epoch, r["item"]): r["cnt"] for r in job.late.read(n).collect()}
    assert late[(10, "b:10")] == 1 and late[(10, "b:1")] == 1 and sum(late.values()) == 104
    assert len(job.late.live(n)) <= 3 * store.FAN


def test_late_rows_change_no_state(spark, tmp_path):
    hour = 3600
    write_files([[(2000 * hour, "a", 1)], [(1000 * hour, "a", 1), (1999 * hour, "a", 1)]], str(tmp_path))
    job = online.Online(spark, str(tmp_path), online.Cells, max_files=1)
    n = job.run()
    total = job.result(n).where("level = 0").agg(F.sum("cnt")).first()[0]
    assert (n, total) == (2, 2 * 4)  # two rows in time, depth four


def test_empty_and_null_events(spark, tmp_path):
    os.makedirs(f"{tmp_path}/events.parquet")
    spark.createDataFrame([(1, None, 5, "a"), (2, datetime.datetime(2024, 1, 1), None, "a")],
                          "event_id long, ts timestamp_ntz, user_id long, event_type string").coalesce(1) \
        .write.mode("overwrite").parquet(f"{tmp_path}/events.parquet")
    for job in (online.online_cells, online.online_bursts, online.online_hitters, online.online_snapshots):
        assert job(spark, str(tmp_path)).count() == 0
    assert [tuple(r) for r in online.online_loss(spark, str(tmp_path)).collect()] in ([], [(0, 0, None)])


def test_summary_bounds_and_merging(spark):
    rng = random.Random(9)
    items = [f"i{int(rng.paretovariate(0.6)) % 5000}" for _ in range(20_000)] + ["hot"] * 9000
    rng.shuffle(items)
    exact = Counter(items)
    for parts in (1, 6):
        df = spark.createDataFrame([(x,) for x in items], "token string").repartition(parts)
        for k in (5, 50, 10_000):
            rows = summary.summarise(df, "token", None, k).collect()
            head = next(r for r in rows if r["item"] is None)
            held = {r["item"]: r["cnt"] for r in rows if r["item"] is not None}
            assert head["n"] == len(items) and head["lost"] * (k + 1) <= head["n"] and len(held) <= k
            for item, n in exact.items():
                low = held.get(item, 0)
                assert low <= n <= low + head["lost"]
                assert n * (k + 1) <= len(items) or item in held
    none = summary.summarise(df.limit(0), "token", None, 5).collect()
    assert [tuple(r) for r in none] == [(None, 0, 0, 0)]
