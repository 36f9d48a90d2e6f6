"""Bucketed tables: no exchange, hot households in many buckets, rows as a plain join's."""

from pyspark.sql import functions as F

from gridflow.sources.bucketed import BucketedTables
from test_lookup import dimension, facts, rows_of


def test_join_without_an_exchange(spark, tmp_path, plan_of):
    left, right = facts(spark, 6000), dimension(spark)
    stored = BucketedTables(spark, str(tmp_path), "household_id", 6, share=0.01, salts=8).store(left, right)
    try:
        joined = stored.joined()
        plan = plan_of(joined)
        assert "SortMergeJoin" in plan and "Exchange" not in plan and "Bucketed: true" in plan
        assert sorted(joined.columns) == ["household_id", "n", "rate"]
        assert rows_of(joined) == rows_of(left.join(right, "household_id", "left"))
        salts = stored.facts.groupBy("household_id").agg(F.count_distinct("_salt").alias("n")).collect()
        assert {r.n for r in salts if r.household_id in ("hot", None)} == {8}
        assert {r.n for r in salts if r.household_id not in ("hot", None)} == {1}
        assert stored.dimension.where("household_id = 'hot'").count() == 8 and stored.dimension.count() == 501 + 7
    finally:
        stored.forget()
    assert not spark.catalog.listTables()


def test_empty_tables(spark, tmp_path):
    stored = BucketedTables(spark, str(tmp_path), "household_id", 3).store(facts(spark, 10).limit(0), dimension(spark))
    assert stored.joined().isEmpty()
    stored.forget()
