"""Row order and partition count never change a linear sketch,
and sketches built on any split of the input merge to the whole."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from freqscope.operators.sketch import event_cells, merge_cells

events = st.lists(st.tuples(st.sampled_from(["a", "b", "c", "d", "e"]), st.integers(0, 5)),
                  min_size=1, max_size=40)


def _cells(df):
    counts = df.groupBy("item", "slot").agg(F.count(F.lit(1)).alias("cnt"))
    return {(r.slot, r.row, r.col, r.cnt) for r in event_cells(counts, ["slot"], 3, 8, 42).collect()}


@settings(max_examples=5, deadline=None)
@given(rows=events, parts=st.integers(1, 6), split=st.integers(0, 40))
def test_cells_ignore_order_partitions_and_split(spark, rows, parts, split):
    df = spark.createDataFrame(rows, "item string, slot long")
    whole = _cells(df)
    assert _cells(df.repartition(parts).orderBy(F.rand(7))) == whole
    a = spark.createDataFrame(rows[:split] or rows[:0], "item string, slot long")
    b = spark.createDataFrame(rows[split:] or rows[:0], "item string, slot long")

    def raw(d):
        c = d.groupBy("item", "slot").agg(F.count(F.lit(1)).alias("cnt"))
        return event_cells(c, ["slot"], 3, 8, 42)
    merged = merge_cells(raw(a), raw(b), keys=["slot"])
    assert {(r.slot, r.row, r.col, r.cnt) for r in merged.collect()} == whole
