"""Late readings against a loop over their windows."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from gridflow.streaming.late import LateRows, in_time, late

START = dt.datetime(2024, 1, 1)


def rows_at(spark, seconds):
    return spark.createDataFrame([(n, START + dt.timedelta(seconds=s)) for n, s in enumerate(seconds)],
                                 "n int, event_timestamp timestamp")


@pytest.mark.parametrize("window, slide", [(60, 30), (60, 60), (50, 20), (10, 30)])
def test_windows_lost(spark, tmp_path, window, slide):
    rng = random.Random(window + slide)
    split = LateRows(spark, str(tmp_path), "10 seconds", f"{window} seconds", f"{slide} seconds")
    batches = [[rng.randrange(at, at + 200) for _ in range(40)] for at in (0, 250, 100)]
    base, seen, told = int(START.replace(tzinfo=dt.timezone.utc).timestamp()), None, []
    for number, seconds in enumerate(batches):
        marked = split.mark(rows_at(spark, seconds), number)
        watermark = None if seen is None else seen - 10
        lost_windows = 0
        for row in marked.collect():
            at = base + seconds[row.n]
            starts = range((at // slide - window // slide - 1) * slide, at + 1, slide)
            ends = [s + window for s in starts if s <= at < s + window]
            lost = sum(watermark is not None and e <= base + watermark for e in ends)
            assert (row.windows, row.lost_windows) == (len(ends), lost)
            assert row.lag_seconds == (watermark - seconds[row.n] if watermark is not None and seconds[row.n] < watermark else None)
            lost_windows += lost
        if window >= slide:
            assert in_time(marked).count() + late(marked).count() == len(seconds)
        told.append((number, in_time(marked).count(), late(marked).count(), lost_windows))
        split.advance(marked, number)
        split.advance(split.mark(rows_at(spark, [9999]), number), number)   # the batch runs again: nothing changes
        seen = max([*([seen] if seen is not None else []), *seconds])
    assert sorted(map(tuple, split.counts().collect())) == told


def test_a_batch_without_rows_hands_the_watermark_on(spark, tmp_path):
    split = LateRows(spark, str(tmp_path), "1 minute", "1 minute", "30 seconds")
    for number, seconds in enumerate([[], [300], [], [100]]):
        marked = split.mark(rows_at(spark, seconds), number)
        split.advance(marked, number)
    assert split.watermark(0) is split.watermark(1) is None
    expected = int((START + dt.timedelta(seconds=240)).replace(tzinfo=dt.timezone.utc).timestamp()) * 10 ** 6
    assert split.watermark(2) == split.watermark(3) == split.watermark(4) == expected
    assert late(split.mark(rows_at(spark, [100]), 3)).select("lag_seconds").first()[0] == 140.0
    again = LateRows(spark, str(tmp_path), "1 minute", "1 minute", "30 seconds")   # after a restart
    assert again.mark(rows_at(spark, [100]), 3).where(F.col("lost_windows") == 2).count() == 1
