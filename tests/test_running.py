"""Running totals against a plain unpartitioned window."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from gridflow.operators.running import running_totals


def plain(df):
    order = Window.orderBy("seq").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.select("seq", F.sum("v").over(order).alias("total"), F.count(F.lit(1)).over(order).alias("n"))


def ours(df, **options):
    rows = running_totals(df, "seq", {"total": F.col("v"), "n": F.lit(1).cast("long")}, **options)
    return rows.select("seq", "total", "n")


def numbers(spark, seqs):
    rng = random.Random(5)
    rows = [(s, rng.randrange(100)) for s in seqs]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "seq bigint, v bigint").repartition(5)


@pytest.mark.parametrize("seqs", [
    list(range(500)),
    [i * i for i in range(300)],                                       # ever wider gaps
    list(range(200)) + [10 ** 12 + i for i in range(200)],             # two dense stretches far apart
    list(range(-100, 100)),                                            # below zero
    [7],
])
@pytest.mark.parametrize("bits", [2, 4, 17])
def test_equals_one_window(spark, seqs, bits):
    df = numbers(spark, seqs)
    wanted = {r.seq: (r.total, r.n) for r in plain(df).collect()}
    found = {r.seq: (r.total, r.n) for r in ours(df, bits=bits).collect()}
    assert found == wanted and len(found) == len(seqs)


def test_empty(spark):
    assert ours(spark.createDataFrame([], "seq bigint, v bigint")).isEmpty()


def test_rows_are_windowed_inside_buckets(spark, plan_of):
    plan = plan_of(ours(numbers(spark, range(100))))
    specifications = [part.split(",")[0] for part in plan.split("windowspecdefinition(")[1:]]
    assert any(s.startswith("_bucket#") for s in specifications)
    # Rows have one shuffle, that of the window; the few totals are broadcast.
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
