"""Text readers, sinks and streams on small files (S1-S5, K1-K5, P4, P5, ST4, ST5)."""

import datetime
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from freqscope import params
from freqscope.functions.text import tokenize
from freqscope.operators import metrics
from freqscope.plans import reports, tokens
from freqscope.sources import files, sinks
from freqscope.streaming import jobs


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


def test_query_log_skips_every_header(spark, tmp_path):
    for k in (1, 2):
        write(tmp_path / "log" / f"part{k}.tsv", f"id\tquery\tClickURL\n{k}\tFoo-bar 12\thttp://x\nonly\n9\t\"quoted word\t\n")
    got = sorted(r.token for r in files.read_query_log_tokens(spark, str(tmp_path / "log")).collect())
    assert got == sorted(["foo", "bar", "12", "quoted", "word"] * 2)


def test_url_list_drops_malformed_lines(spark, tmp_path):
    path = write(tmp_path / "urls.tsv", "id\tClickURL\n1\thttp://a\n2\tbadrow\textra\n3\n4\thttp://a\n5\t\n6\thttp://b\n")
    assert sorted(r.url for r in files.read_url_list(spark, path).collect()) == ["http://a", "http://b"]
    with pytest.raises(ValueError):
        files.read_url_list(spark, path, "Missing")


def test_event_limits(spark, tmp_path):
    rows = "".join(f"2019-05-01T00:0{k}:00Z,a{k}\n" for k in range(6))
    path = write(tmp_path / "e.csv", "timestamp,ngram\n" + rows)
    items = lambda **kw: sorted(r.item for r in files.read_events_csv(spark, path, 60, **kw).collect())
    assert items(max_seconds=120) == ["a0", "a1", "a2"]
    assert items(max_events=2) == ["a0", "a1"]
    assert len(items()) == 6
    quoted = write(tmp_path / "q.csv", '"slot","ngram"\n5,"x, y"\n7,z\n')
    assert [(r.item, r.slot) for r in files.read_events_csv(spark, quoted).orderBy("slot").collect()] == [("x, y", 0), ("z", 2)]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a", 1.25, None), ("b", 0.5, 2.0)], "target string, est double, p double")
    sinks.write_json(df, str(tmp_path / "j"))
    assert sorted(r.target for r in spark.read.json(str(tmp_path / "j")).collect()) == ["a", "b"]
    sinks.write_tsv(df, str(tmp_path / "t"), digits=2)
    lines = sorted(x.value for x in spark.read.text(str(tmp_path / "t")).collect())
    assert "a\t1.25\tNaN" in lines and "target\test\tp" in lines


def test_report_jobs(spark, tmp_path):
    reports.write_core(spark, SF_SMALL, str(tmp_path / "core"))
    core = spark.read.json(str(tmp_path / "core"))
    assert set(core.columns) == {"target", "window_slots", "true", "est"} and core.count() > 0
    reports.write_metrics(spark, SF_SMALL, str(tmp_path / "metrics"))
    assert spark.read.json(str(tmp_path / "metrics")).count() == 1
    reports.write_bursts(spark, SF_SMALL, str(tmp_path / "burst"))
    assert {"bucket", "target", "true_burst", "est_burst"} <= set(spark.read.json(str(tmp_path / "burst")).columns)
    reports.write_token_report(spark, SF_SMALL, str(tmp_path / "tokens"))
    assert spark.read.json(str(tmp_path / "tokens" / "errors")).count() > 0


def test_token_report_states_statistics_and_intersection(spark, tmp_path):
    reports.write_token_report(spark, SF_SMALL, str(tmp_path))
    docs = [r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("text").collect()]
    words = spark.createDataFrame([(t,) for t in docs], "text string").select(F.explode(tokenize(F.col("text"))).alias("t"))
    counts = {r.t: r["count"] for r in words.groupBy("t").count().collect()}
    (stats,) = spark.read.json(str(tmp_path / "statistics")).collect()
    assert (stats.total_tokens, stats.unique_tokens) == (sum(counts.values()), len(counts))
    assert stats.dict_bytes == sum(len(t.encode()) + 8 for t in counts)
    assert stats.depth == params.TOKEN_DEPTH and list(stats.widths) == list(params.TOKEN_WIDTHS)
    table = spark.read.option("sep", "\t").option("header", True).option("inferSchema", True).csv(str(tmp_path / "intersection"))
    rows = {r.R: r for r in table.collect()}
    assert sorted(rows) == sorted(params.TOKEN_WIDTHS) and set(table.columns) == {"R", "cm", "cmedian", "csketch"}
    want = {(r.sketch, r.R): r.overlap for r in tokens.topk_overlap(spark, SF_SMALL).collect()}
    assert all(rows[w][k] == n for (k, w), n in want.items())


def test_percentiles_and_histogram(spark):
    rows = [(float(k), float(k) + k) for k in range(10)]
    df = spark.createDataFrame(rows, "true_count double, est_count double")
    m = metrics.accuracy_metrics(df, []).first()
    rel = sorted(0.0 if t == 0 else abs(e - t) / t for t, e in rows)
    assert m.median_relative_error == rel[4] and m.p90_relative_error == rel[8]
    h = metrics.error_histogram(spark.range(100).select((F.col("id") / 10).alias("rel_error")), bins=10).orderBy("bin").collect()
    assert [r.n for r in h] == [10] * 10


def events(spark, rows):
    at = datetime.datetime(2024, 1, 1)
    return spark.createDataFrame([(k, at + datetime.timedelta(hours=h), "t", u) for k, (h, u) in enumerate(rows)],
                                 "event_id long, ts timestamp_ntz, event_type string, user_id long")


def add_file(df, sf, name):
    """One more file of the events table, newer than those before."""
    tmp = f"{sf}/tmp-{name}"
    df.coalesce(1).write.parquet(tmp)
    part = next(f for f in os.listdir(tmp) if f.endswith(".parquet"))
    os.makedirs(f"{sf}/events.parquet", exist_ok=True)
    os.rename(f"{tmp}/{part}", f"{sf}/events.parquet/{name}.parquet")


def test_stream_reads_a_directory_and_resumes(spark, tmp_path):
    sf = str(tmp_path)
    add_file(events(spark, [(0, 1), (0, 1), (1, 2)]), sf, "a")
    add_file(events(spark, [(1, 2), (2, 1)]), sf, "b")
    want = {(0, "t:1", 2), (1, "t:2", 2), (2, "t:1", 1)}
    base = 473352  # hours from the epoch to 2024-01-01
    got = {(r.hour - base, r.item, r.cnt) for r in jobs.stream_slot_counts(spark, sf).collect()}
    assert got == want
    # stopped after one batch: the folder stays, the next run goes on from it
    agg = jobs.slot_counts_of(jobs.event_stream(spark, sf, max_files=1))
    folder = jobs.progress_folder(spark, "slots", sf)
    seen = []

    def sink(batch, batch_id):
        if batch_id:
            raise RuntimeError("driver lost")
        seen.append(batch_id)
        batch.write.mode("overwrite").parquet(f"{folder}/out/batch={batch_id}")

    q = agg.writeStream.outputMode("update").foreachBatch(sink).option("checkpointLocation", f"{folder}/checkpoint") \
        .trigger(availableNow=True).start()
    with pytest.raises(Exception):
        q.awaitTermination()
    assert seen == [0] and os.path.isdir(f"{folder}/out/batch=0")
    got = {(r.hour - base, r.item, r.cnt) for r in jobs.stream_slot_counts(spark, sf).collect()}
    assert got == want and not os.path.exists(folder)


def test_late_rows_are_dropped_and_counted(spark, tmp_path):
    sf = str(tmp_path)
    days = 24 * 60
    add_file(events(spark, [(0, 1), (days, 1)]), sf, "a")
    add_file(events(spark, [(days + 1, 2)]), sf, "b")
    add_file(events(spark, [(3, 9), (days + 2, 2), (days - 1, 2)]), sf, "c")  # hour 3 is past the retention
    late = []
    agg = jobs.slot_counts_of(jobs.event_stream(spark, sf, max_files=1))
    got = {r.item for r in jobs.run_to_table(spark, agg, "slots", ["hour", "item"], sf, late=late).collect()}
    assert got == {"t:1", "t:2"} and late == [1]


def test_decayed_state_over_batches(spark, tmp_path):
    sf = str(tmp_path)
    add_file(events(spark, [(0, 1), (5, 1), (5, 2)]), sf, "a")
    add_file(events(spark, [(9, 1), (4, 1)]), sf, "b")
    import math
    from freqscope import params
    out = jobs.decayed_of(jobs.event_stream(spark, sf, max_files=1))
    got = {r.item: r for r in jobs.run_to_table(spark, out, "decayed", ["item"], sf).collect()}
    want = sum(math.exp(-params.DECAY_LAMBDA * (9 - h)) for h in (0, 5, 9, 4))
    assert abs(got["t:1"].decayed - want) < 1e-9 and abs(got["t:2"].decayed - 1) < 1e-9
