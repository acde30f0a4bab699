"""Joins of edits: any key may be hot."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from swipeledger.operators.skew import join_account
from swipeledger.operators.updates import rejected_updates


def both(spark):
    left = spark.range(9000).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 == 0, None).otherwise(F.concat(F.lit("k"), (F.col("id") % 50).cast("string"))).alias("a"),
        (F.col("id") % 2).alias("b"),
    )
    right = left.filter("id % 5 < 3").groupBy("a", "b").agg(F.max("id").alias("most"))
    return left, right


@pytest.mark.parametrize("how", ["inner", "left", "left_anti"])
def test_equals_the_plain_join(spark, how):
    left, right = both(spark)
    columns = ["id", "a", "b", *(["most"] if how != "left_anti" else [])]
    assert rows(join_account(left, right, ["a", "b"], how), *columns) == rows(left.join(right, ["a", "b"], how), *columns)


def test_hot_keys_are_split(spark, conf, plan_of):
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__advisoryPartitionSizeInBytes="8k",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="8k", spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
    )
    left, right = both(spark)
    left = left.repartition(20).withColumn("text", F.sha2(F.col("id").cast("string"), 512))
    joined = join_account(left, right, ["a", "b"], "left")
    joined.collect()
    assert "isSkew=true" in joined._jdf.queryExecution().executedPlan().toString() or "skew" in plan_of(joined, "simple").lower()


def test_edits_scan_customers_for_names_and_for_ssns(spark, tmp_path, plan_of):
    """And the batch for its names, its edits, and the SSNs it claims."""
    customers = spark.range(50).selectExpr("id AS SSN", "concat('f', id % 20) AS FIRST_NAME", "concat('l', id % 20) AS LAST_NAME", "'x' AS CUST_CITY")
    updates = spark.range(90).selectExpr("id AS seq", "concat('f', id % 20) AS FIRST_NAME", "concat('l', id % 20) AS LAST_NAME", "if(id % 2 = 0, 'SSN', 'CUST_CITY') AS field", "lpad(string(id), 9, '0') AS new_value")
    customers.write.parquet(f"{tmp_path}/customers")
    updates.write.parquet(f"{tmp_path}/updates")
    stored = spark.read.parquet(f"{tmp_path}/customers"), spark.read.parquet(f"{tmp_path}/updates")
    plan = plan_of(rejected_updates(*stored), "simple")
    # Accounts by name twice, as claims need them before edits are judged, and holders of SSNs once.
    assert plan.count("/customers") <= 3
    assert "Union" not in plan and "explode" not in plan
