"""Readings and tariffs stored in buckets of their household, so that they are joined where they lie."""

import uuid

from pyspark.sql import functions as F

#: A household is hot if it has this share of the readings; its readings and its tariff are dealt over `SALTS` buckets.
HOT_SHARE, SALTS = 1 / 1024, 64


class BucketedTables:
    """A table of facts and a dimension with one row per key, bucketed alike by key and salt.

    A key's salt is 0 unless it is hot: then its facts take one of `SALTS` by a hash, and its row of the dimension stands in
    each of them, so that no bucket holds more of one key than a share. There are at most 1 / `HOT_SHARE` hot keys, so
    they are broadcast when facts are stored. The tables are entered in the session's catalog until `forget`.
    """

    def __init__(self, spark, root, key, buckets, share=HOT_SHARE, salts=SALTS):
        self.spark, self.root, self.key, self.buckets, self.share, self.salts = spark, root, key, buckets, share, salts
        self.names = []

    def _save(self, rows, name):
        table = f"{name}_{uuid.uuid4().hex}"
        # One file per bucket: rows are dealt out as the buckets are.
        rows = rows.repartition(self.buckets, self.key, "_salt")
        (rows.write.bucketBy(self.buckets, self.key, "_salt").sortBy(self.key, "_salt")
         .option("path", f"{self.root}/{name}").format("parquet").saveAsTable(table))
        self.names.append(table)
        return self.spark.table(table)

    def store(self, facts, dimension):
        """Store both; the readings' keys are counted once before."""
        limit = facts.agg((F.count(F.lit(1)) * self.share).alias("n")).scalar()
        hot = facts.where(F.col(self.key).isNotNull()).groupBy(self.key).agg(F.count(F.lit(1)).alias("n"))
        hot = F.broadcast(hot.where(F.col("n") > F.greatest(limit, F.lit(1.0))).select(self.key, F.lit(True).alias("_hot")))
        spread = F.pmod(F.xxhash64(*facts.columns), F.lit(self.salts)).cast("int")
        salt = F.when(F.col("_hot") | F.col(self.key).isNull(), spread).otherwise(0).alias("_salt")
        self.facts = self._save(facts.join(hot, self.key, "left").select(*facts.columns, salt), "facts")
        every = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(self.salts - 1))).otherwise(F.array(F.lit(0)))
        self.dimension = self._save(dimension.join(hot, self.key, "left").select(
            *dimension.columns, F.explode(every).alias("_salt")), "dimension")
        return self

    def joined(self):
        """Facts with their row of the dimension, by a merge join of the buckets: nothing is exchanged."""
        return self.facts.join(self.dimension.hint("merge"), [self.key, "_salt"], "left").drop("_salt")

    def forget(self):
        for name in self.names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
