"""The newest rows of a stream, kept from batch to batch: a bounded heap per key that takes corrections and retractions."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from .. import storage
from ..sinks.files import write_once
from ..sinks.manifest import Manifest
from .zones import trigger_of

#: Rows kept beyond those asked for, so that a few retractions need no look into the log.
SPARE = 20


class RecentRows:
    """The `count` newest rows, in all or per `keys`, by the greatest `order`.

    A row is known by `identity`: one that comes again replaces the one before, and one with `retracted` takes it back. A batch
    merges with what the batch before it left, at most count + spare rows per key, into folders of its own: a restarted query and
    a batch that runs again start from the same rows. Every task keeps that many of each key before anything is shuffled.

    Rows that were pushed out are not kept here, nor are rows that come later and are older than those. Where retractions leave
    fewer than `count` rows of a key that has lost some, it is filled up from `log`, a function that gives all rows that hold, this
    batch's among them; `refills` counts that.
    """

    def __init__(self, spark, root, count, order, keys=(), identity="seq", spare=SPARE, log=None):
        self.spark, self.root, self.count, self.order, self.keys = spark, root, count, order, list(keys)
        self.identity, self.most, self.log, self.refills = identity, count + spare, log, 0
        self.manifest = Manifest(spark, root)

    def _keyed(self, rows):
        return rows.withColumn("_key", F.to_json(F.struct(*self.keys)) if self.keys else F.lit(""))

    def _placed(self, rows, most):
        newest = Window.partitionBy("_key").orderBy(F.desc(self.order), F.desc(self.identity))
        return rows.withColumn("_place", F.row_number().over(newest)).where(F.col("_place") <= most)

    def _left(self, kind, batch):
        """What a batch left: its own merge, or that with some keys filled up."""
        filled = f"{self.root}/filled-{kind}/{batch}"
        return self.spark.read.parquet(filled if storage.is_published(self.spark, filled) else f"{self.root}/{kind}/{batch}")

    def _store(self, rows, kind, batch):
        write_once(rows, f"{self.root}/{kind}", batch, keep_empty=True)
        return self.spark.read.schema(rows.schema).parquet(f"{self.root}/{kind}/{batch}")

    def _age(self):
        return F.struct(F.col(self.order).alias("order"), F.col(self.identity).alias("identity"))

    def _pushed(self, placed):
        """(_key, floor) of the keys that lose rows, from one row more than is kept: the newest one lost."""
        return placed.where(F.col("_place") > self.most).select("_key", self._age().alias("floor"))

    def write(self, batch_df, batch_id):
        """Merge a batch: the same columns every time, and a boolean `retracted`."""
        batch, before = f"batch={batch_id}", f"batch={batch_id - 1}"
        columns = [c for c in batch_df.columns if c != "retracted"]
        fresh = self._keyed(batch_df.withColumn("_gone", F.coalesce("retracted", F.lit(False))))
        held = fresh.where("not _gone").select(*columns, "_key")
        lost = self._pushed(held.withColumn("_place", F.lit(0)))
        if batch_id:
            named, lost = fresh.select(self.identity).distinct(), self._left("lost", before)
            held = self._left("merged", before).join(named, self.identity, "left_anti").select(*columns, "_key").unionByName(held)
            held = held.join(lost, "_key", "left").where(F.col("floor").isNull() | (self._age() > F.col("floor"))).drop("floor")
        placed = self._store(self._placed(held, self.most + 1), "placed", batch)
        lost = lost.union(self._pushed(placed)).groupBy("_key").agg(F.max("floor").alias("floor"))
        lost = self._store(lost, "lost", batch)
        merged = self._store(placed.where(F.col("_place") <= self.most).drop("_place"), "merged", batch)
        sizes = merged.groupBy("_key").agg(F.count(F.lit(1)).alias("n"))
        short = lost.join(sizes, "_key", "left").where(F.coalesce("n", F.lit(0)) < self.count).select("_key")
        if self.log is not None and not short.isEmpty():
            self.refills += 1
            more = self._placed(self._keyed(self.log()).join(short, "_key", "left_semi"), self.most + 1)
            more = self._store(more.select(*columns, "_key", "_place"), "more", batch)
            others = lambda rows: rows.join(short, "_key", "left_anti")
            self._store(others(lost).select("_key", "floor").unionByName(self._pushed(more)), "filled-lost", batch)
            self._store(others(merged).select(*columns, "_key").unionByName(
                more.where(F.col("_place") <= self.most).drop("_place")), "filled-merged", batch)
        current = (self.manifest.live() or [None])[-1]
        if current != batch:
            self.manifest.replace(current, batch)
        for kind in ("placed", "lost", "merged", "more", "filled-lost", "filled-merged") if batch_id > 1 else ():
            storage.remove(self.spark, f"{self.root}/{kind}/batch={batch_id - 2}")

    def read(self):
        """The newest rows as the last batch left them."""
        newest = self._placed(self._left("merged", self.manifest.live()[-1]), self.count)
        return newest.drop("_key", "_place")


def start_recent(rows, recent, checkpoint, trigger):
    return (rows.writeStream.foreachBatch(recent.write).option("checkpointLocation", checkpoint)
            .trigger(**trigger_of(trigger)).start())
