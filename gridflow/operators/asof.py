"""As-of join: each fact with the last change of its key that is not later than the fact."""

from pyspark.sql import Window
from pyspark.sql import functions as F

#: A key is hot if it has this share of the facts, and at least so many of them; it is cut into slots of about that size.
HOT_SHARE, HOT_ROWS = 1 / 4096, 100_000
#: Slots of the facts without a key, which have no change.
KEYLESS_SLOTS = 4096


def as_of(facts, changes, key, at, since, values, share=HOT_SHARE, least=HOT_ROWS):
    """`facts` with the columns `since` and `values` of the change in force at the time `at`; null where there is none.

    `changes` has one row per key and time (see `latest_wins`); one at the very time of a fact is in force. Facts without
    a key or time get nulls, changes without them are left out. Both are tables; enrich a stream inside `foreachBatch`.

    Facts and changes are brought together by one shuffle, sorted by time, and the last change is carried along: no change
    meets a fact it does not concern. A hot key's time is cut into slots that are sorted apart, and the last change before
    a slot is carried over its border, one row per slot. For that the keys and times of the facts are read once before;
    there are at most 1 / `share` hot keys, so they are broadcast.
    """
    taken = {since, *values} & set(facts.columns)
    if taken:
        raise ValueError(f"columns on both sides: {sorted(taken)}")
    hot = hot_keys(facts, key, at, share, least)
    change = F.struct(since, *values).alias("_change")
    known = changes.where(F.col(key).isNotNull() & F.col(since).isNotNull()).select(
        F.col(key).alias("_key"), F.unix_micros(since).alias("_time"), change)
    known = known.join(F.broadcast(hot), "_key", "left").withColumn("_slot", _slot())
    rows = facts.select(F.col(key).alias("_key"), F.unix_micros(at).alias("_time"), F.struct(*facts.columns).alias("_fact"))
    rows = rows.join(F.broadcast(hot), "_key", "left").withColumn("_slot", _slot())
    place = ["_key", "_slot", "_time"]
    both = (known.select(*place, "_change", F.lit(None).alias("_fact"))
            .unionByName(_carried(known, change).select(*place, "_change", F.lit(None).alias("_fact")))
            .unionByName(rows.select(*place, F.lit(None).alias("_change"), "_fact")))
    by_time = Window.partitionBy("_key", "_slot").orderBy("_time", F.col("_fact").isNotNull())
    last = F.last("_change", ignorenulls=True).over(by_time.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    found = both.withColumn("_change", last).where(F.col("_fact").isNotNull())
    return found.select("_fact.*", f"_change.{since}", *[f"_change.{v}" for v in values])


def hot_keys(facts, key, at, share=HOT_SHARE, least=HOT_ROWS):
    """(_key, _first, _width, _slots) of the keys whose facts are cut by time."""
    total = facts.agg((F.count(F.lit(1)) * share).alias("n")).scalar()
    limit = F.greatest(F.lit(float(least)), total)
    keys = facts.where(F.col(key).isNotNull() & F.col(at).isNotNull()).groupBy(F.col(key).alias("_key")).agg(
        F.count(F.lit(1)).alias("n"), F.min(F.unix_micros(at)).alias("_first"), F.max(F.unix_micros(at)).alias("_last"))
    slots = F.ceil(F.col("n") / limit)
    return keys.where(F.col("n") > limit).select(
        "_key", "_first", F.ceil((F.col("_last") - F.col("_first") + 1) / slots).alias("_width"), slots.alias("_slots"))


def _slot():
    spread = F.pmod(F.xxhash64("_time"), F.lit(KEYLESS_SLOTS))
    number = F.expr("greatest(0, least(_slots - 1, cast(floor((_time - _first) / _width) as bigint)))")
    return F.when(F.col("_key").isNull(), spread).otherwise(F.coalesce(number, F.lit(0))).cast("long")


def _carried(known, change):
    """For every slot of a hot key the last change before it, where there is one."""
    last = known.where("_slots > 1").groupBy("_key", "_slot", "_slots").agg(
        F.max_by(F.struct("_time", "_change"), "_time").alias("last"))
    until = F.coalesce(F.lead("_slot").over(Window.partitionBy("_key").orderBy("_slot")), F.col("_slots") - 1)
    behind = last.withColumn("_until", until).where(F.col("_slot") < F.col("_until"))
    return behind.select("_key", F.explode(F.sequence(F.col("_slot") + 1, F.col("_until").cast("long"))).alias("_slot"),
                         "last._time", "last._change")
