"""Running totals over a whole table, in parallel.

A window without a partition runs in one task. Here the sequence is cut into buckets of
2**17 consecutive numbers: buckets are totalled, the totals are summed up along the
sequence, and each row adds what precedes its bucket to a window inside its bucket. Should
there be more bucket totals than fit one window, they are summed up the same way. A sequence
number occurs once, so no window anywhere holds more than 2**17 rows, however the numbers
are spread.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..session import shared_dir

BUCKET_BITS = 17


def running_totals(df, seq, measures, bits=BUCKET_BITS):
    """`df` with an inclusive running sum for each of `measures` (name -> column).

    `seq` is the arrival order, a unique non-null whole number. `measures` must not be null.
    `df` is read twice, for the bucket totals and for the rows. The totals are checkpointed:
    they are used several times, and a lost executor must not cost another pass.
    """
    names = list(measures)
    shared_dir(df.sparkSession)  # where the checkpoint goes
    rows = df.withColumns({**measures, "_bucket": F.shiftright(F.col(seq).cast("long"), bits)})
    totals = rows.groupBy("_bucket").agg(*[F.sum(n).alias(n) for n in names]).checkpoint()
    buckets = totals.count()
    offsets = _preceding(totals, buckets, "_bucket", names, bits)
    offsets = offsets.withColumnsRenamed({n: f"_before_{n}" for n in names})
    if buckets <= 1 << bits:
        offsets = F.broadcast(offsets)
    inside = Window.partitionBy("_bucket").orderBy(seq).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = rows.withColumns({n: F.sum(n).over(inside) for n in names})
    total = {n: F.col(n) + F.coalesce(F.col(f"_before_{n}"), F.lit(0)) for n in names}
    return local.join(offsets, "_bucket", "left").select(*df.columns, *[c.alias(n) for n, c in total.items()])


def _preceding(totals, count, key, names, bits):
    """For each key the sum over all smaller keys."""
    if count <= 1 << bits:
        before = Window.orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
        return totals.select(key, *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(n) for n in names])
    upper = f"{key}_up"
    grouped = totals.withColumn(upper, F.shiftright(key, bits))
    above = grouped.groupBy(upper).agg(*[F.sum(n).alias(n) for n in names]).checkpoint()
    above = _preceding(above, above.count(), upper, names, bits)
    above = above.withColumnsRenamed({n: f"_above_{n}" for n in names})
    before = Window.partitionBy(upper).orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    local = grouped.withColumns({n: F.coalesce(F.sum(n).over(before), F.lit(0)) for n in names})
    return local.join(above, upper).select(key, *[(F.col(n) + F.col(f"_above_{n}")).alias(n) for n in names])
