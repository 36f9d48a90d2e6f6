"""The lookup join: all three plans give the rows of a plain left join, whatever the skew."""

from pyspark.sql import functions as F

from gridflow.operators.lookup import lookup, measured_bytes


def facts(spark, rows=3000):
    """A third of the rows on one key, a tenth without a key, the rest spread."""
    n = F.col("id")
    key = F.when(n % 3 == 0, "hot").when(n % 10 == 1, None).otherwise(F.concat(F.lit("k"), (n % 700).cast("string")))
    return spark.range(rows).select(key.alias("household_id"), n.alias("n"))


def dimension(spark):
    """Some keys of the facts have no row here."""
    rows = spark.range(500).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("household_id"),
                                   F.col("id").alias("rate"))
    return rows.unionByName(spark.createDataFrame([("hot", 10 ** 6)], "household_id string, rate bigint"))


def rows_of(df):
    return sorted((r.n, r.household_id, r.rate) for r in df.select("n", "household_id", "rate").collect())


def test_plans_agree(spark):
    left, right = facts(spark), dimension(spark)
    wanted = rows_of(left.join(right, "household_id", "left"))
    assert len(wanted) == 3000
    assert rows_of(lookup(left, right, "household_id")) == wanted
    assert rows_of(lookup(left, right, "household_id", max_broadcast_bytes=0)) == wanted
    assert rows_of(lookup(left, right, "household_id", dim_bytes=10 ** 12)) == wanted


def test_size_decides(spark, plan_of):
    left, right = facts(spark), dimension(spark)
    size = measured_bytes(right)
    assert 500 * 20 < size < 500 * 200
    small = plan_of(lookup(left, right, "household_id", max_broadcast_bytes=size))
    large = plan_of(lookup(left, right, "household_id", max_broadcast_bytes=size - 1))
    assert "BroadcastHashJoin" in small and "SortMergeJoin" not in small
    assert "SortMergeJoin" in large and "BroadcastHashJoin" not in large


def test_large_plan_reads_the_facts_once_and_splits_the_hot_key(spark, tmp_path):
    """The plan that ran: one scan of the facts, a shuffled join, a skewed partition in parts; rows as a plain join's."""
    facts(spark, 60_000).repartition(8).write.parquet(str(tmp_path / "facts"))
    dimension(spark).write.parquet(str(tmp_path / "dim"))
    left, right = (spark.read.parquet(str(tmp_path / n)) for n in ("facts", "dim"))
    small = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
             "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
             "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k) for k in small}
    for k, v in small.items():
        spark.conf.set(k, v)
    try:
        joined = lookup(left, right, "household_id", max_broadcast_bytes=0)
        found = rows_of(joined)
        joined.write.format("noop").mode("overwrite").save()
        executed = joined.select("n", "household_id", "rate")
        executed.collect()
        plan = executed._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    final = plan[:plan.index("Initial Plan")] if "Initial Plan" in plan else plan
    assert final.count("Scan parquet") == 2 and "SortMergeJoin(skew=true)" in final
    assert found == rows_of(left.join(right, "household_id", "left"))


def test_hot_key_without_a_dimension_row(spark):
    left, right = facts(spark), dimension(spark).where("household_id <> 'hot'")
    assert rows_of(lookup(left, right, "household_id", max_broadcast_bytes=0)) == \
        rows_of(left.join(right, "household_id", "left"))


def test_salted_stream_lookup(spark, tmp_path):
    folder = str(tmp_path / "facts")
    facts(spark).repartition(3).write.parquet(folder)
    stream = spark.readStream.schema("household_id string, n bigint").parquet(folder)
    joined = lookup(stream, dimension(spark), "household_id", max_broadcast_bytes=0, salts=7)
    query = joined.writeStream.format("memory").queryName("salted").trigger(availableNow=True).start()
    query.awaitTermination()
    assert rows_of(spark.table("salted")) == rows_of(facts(spark).join(dimension(spark), "household_id", "left"))


def test_stream_lookup_is_not_broadcast(spark, tmp_path, plan_of):
    """Also where Spark's estimate of a dimension beyond the limit is small, as for well packed files."""
    facts(spark, 300).write.parquet(str(tmp_path / "facts"))
    dimension(spark).write.parquet(str(tmp_path / "dim"))
    stream = spark.readStream.schema("household_id string, n bigint").parquet(str(tmp_path / "facts"))
    plan = plan_of(lookup(stream, spark.read.parquet(str(tmp_path / "dim")), "household_id", max_broadcast_bytes=0))
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
