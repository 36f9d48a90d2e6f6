"""A keyed table fed by streaming updates: an append-only log read latest-wins.

Layout: log/run=R/batch=N holds what batch N of run R emitted, table/<date> the compacted
rows, _manifest which batches count. A run is one checkpoint; batch numbers start again with
a new one, so rows are ordered by (run, batch). Run names must sort by time.
"""

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import storage
from ..operators.upsert import latest_wins
from ..operators.zones import flatten_window
from .files import write_once
from .manifest import Manifest

KEYS = ("window_start", "window_end", "grid_zone")
PLACE = ("run", "batch")


class CompactionRunning(RuntimeError):
    """Somebody else is folding the log."""


class ChangeLog:
    def __init__(self, spark, root, schema, keys=KEYS, date_column="window_start"):
        """`schema` is that of the rows without the log's own run and batch."""
        self.spark, self.root, self.keys, self.date_column = spark, root, list(keys), date_column
        self.schema, self.manifest = schema, Manifest(spark, root)
        place = [T.StructField("run", T.StringType()), T.StructField("batch", T.LongType())]
        self._stored = T.StructType(list(schema.fields) + place)
        self._dated = T.StructType(self._stored.fields + [T.StructField("_date", T.DateType())])

    def write(self, rows, run, batch_id):
        """Write a batch and commit it. A rerun commits what a lost driver had written and not committed, and changes nothing else."""
        folder = f"run={run}/batch={batch_id}"
        fresh = write_once(rows.select(*self.schema.fieldNames()), f"{self.root}/log", folder)
        if fresh or storage.is_published(self.spark, f"{self.root}/log/{folder}"):
            self.manifest.add(folder)
        return fresh

    def writer(self, run):
        """For `foreachBatch` on windowed metrics in update mode."""
        def write_batch(batch_df, batch_id):
            rows = flatten_window(batch_df, batch_id).withColumn("updated_at", F.current_timestamp())
            self.write(rows, run, batch_id)
        return write_batch

    def batches(self):
        """The committed batches that are not compacted yet, as run=R/batch=N."""
        return self.manifest.live()

    def _log(self, batches):
        folders = [f"{self.root}/log/{b}" for b in batches]
        return self.spark.read.schema(self._stored).option("basePath", f"{self.root}/log").parquet(*folders)

    def _table(self, dates=None):
        """The compacted rows; with `dates`, a list, only those folders are read."""
        if not storage.exists(self.spark, f"{self.root}/table"):
            return self.spark.createDataFrame([], self._dated)
        rows = self.spark.read.schema(self._dated).parquet(f"{self.root}/table")
        return rows if dates is None else rows.where(F.col("_date").isin(*dates))

    def _newest(self, rows):
        return latest_wins(rows, self.keys, list(PLACE))

    def latest(self, since=None, until=None):
        """The table as it stands; with bounds, the rows of those dates, reading no others."""
        batches = self.batches()
        rows = self._table()
        if batches:
            rows = rows.unionByName(self._log(batches).withColumn("_date", F.to_date(self.date_column)))
        if since is not None:
            rows = rows.where(F.col("_date") >= F.lit(since).cast("date"))
        if until is not None:
            rows = rows.where(F.col("_date") <= F.lit(until).cast("date"))
        return self._newest(rows.drop("_date")).select(*self.schema.fieldNames())

    def compact(self, who=None):
        """Fold the log into the table, reading and rewriting only the dates it touches.

        Those dates are few, and as values they let the scan skip all other folders. Each step can be repeated: the merged
        rows are written aside before the dates are replaced, and the batches are removed last. The work is claimed in the
        manifest under the name `who`: a second one raises CompactionRunning, and after a lost driver the same name goes on.
        The folders of removed batches are deleted by a later `compact` or `sweep`, once all named readers have passed them, so
        that a frame made before still finds its files.
        """
        who = who or uuid.uuid4().hex
        if not self.manifest.begin("compaction", who):
            raise CompactionRunning(self.manifest.state()["tasks"].get("compaction"))
        try:
            self.sweep()
            batches = self.batches()
            if batches:
                self._fold(batches)
                self.manifest.remove(batches)
            return len(batches)
        finally:
            self.manifest.end("compaction", who)

    def _fold(self, batches):
        log = self._log(batches).withColumn("_date", F.to_date(self.date_column))
        touched = [r["_date"] for r in log.select("_date").distinct().collect()]
        merged = self._newest(self._table(touched).unionByName(log))
        staging = f"{self.root}/_staging/{uuid.uuid4().hex}"
        merged.write.parquet(staging)
        (self.spark.read.schema(self._dated).parquet(staging)
         .hint("rebalance", F.col("_date"))  # a date with most of the rows is split over tasks
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("_date").parquet(f"{self.root}/table"))
        storage.remove(self.spark, staging)

    def sweep(self):
        """Delete the folders of removed batches that every named reader has passed."""
        return self.manifest.sweep(lambda batch: f"{self.root}/log/{batch}")

    def passed(self, reader):
        """A named reader is through with all it made its frames from; without names, nobody is waited for."""
        self.manifest.passed(reader, self.manifest.state()["version"])

    def adopt(self):
        """Commit the batches of a log from before it had a manifest; lists the log, once."""
        for run in storage.child_names(self.spark, f"{self.root}/log"):
            for batch in storage.child_names(self.spark, f"{self.root}/log/{run}"):
                if storage.is_published(self.spark, f"{self.root}/log/{run}/{batch}"):
                    self.manifest.add(f"{run}/{batch}")
