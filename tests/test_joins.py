import fixtures
import pytest
from conftest import rows
from pyspark.sql import functions as F

from swipeledger.operators import joins, skew


def plain(owners, facts, key, output, owner_columns):
    o, f = owners.alias("o"), facts.alias("f")
    joined = o.join(f, F.col(f"o.{key}") == F.col(f"f.{key}"), "left")
    return joined.select(
        *(F.col(("o." if c in owner_columns else "f.") + c).alias(c) for c in output)
    )


def test_customer_join_is_a_left_join(spark):
    customers, facts = fixtures.customers(spark), fixtures.transactions(spark)
    joined = joins.join_customer_transactions(customers, facts)
    expected = plain(
        customers, facts, "CREDIT_CARD_NO", joined.columns, ["CUST_ZIP", "FIRST_NAME", "LAST_NAME"]
    )
    assert joined.dtypes == expected.dtypes
    assert rows(joined) == rows(expected)
    idle = joined.filter("TIMEID IS NULL")
    assert rows(idle, "LAST_NAME", "CREDIT_CARD_NO") == [("Holman", None), ("Null", None)]


def test_branch_join_is_a_left_join(spark):
    branches, facts = fixtures.branches(spark), fixtures.transactions(spark)
    joined = joins.join_branch_transactions(branches, facts)
    expected = plain(branches, facts, "BRANCH_CODE", joined.columns, ["BRANCH_STATE"])
    assert joined.dtypes == expected.dtypes
    assert rows(joined) == rows(expected)
    assert rows(joined.filter("BRANCH_CODE IS NULL"), "BRANCH_STATE") == [("MA",)]


def test_duplicate_cards_multiply(spark):
    customers = fixtures.customers(spark)
    twice = customers.union(customers)
    facts = fixtures.transactions(spark)
    single = joins.join_customer_transactions(customers, facts).count()
    assert joins.join_customer_transactions(twice, facts).count() == 2 * single


def test_no_transactions_at_all(spark):
    joined = joins.join_customer_transactions(
        fixtures.customers(spark), fixtures.transactions(spark).limit(0)
    )
    assert joined.count() == 5
    assert joined.filter("TIMEID IS NOT NULL").count() == 0


def skewed(spark, n=60_000):
    """A third of the rows on one card."""
    card = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 2000).cast("string")
    filler = [c for c in fixtures.transactions(spark).columns if c not in ("CREDIT_CARD_NO", "TIMEID")]
    return spark.range(0, n, 1, 8).select(
        card.alias("CREDIT_CARD_NO"),
        F.lit("20180101").alias("TIMEID"),
        *(F.col("id").alias(c) for c in filler),
    )


def test_hot_card_is_split(spark, conf, plan_of):
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="20KB",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="40KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__coalescePartitions__enabled="false",
    )
    customers = spark.range(0, 3000).select(
        F.col("id").cast("string").alias("CREDIT_CARD_NO"),
        F.col("id").cast("int").alias("CUST_ZIP"),
        F.lit("F").alias("FIRST_NAME"),
        F.lit("L").alias("LAST_NAME"),
    )
    joined = joins.join_customer_transactions(customers, skewed(spark))
    assert len(joined.collect()) == 60_000 + 1000
    assert "isSkew=true" in plan_of(joined, "simple") or "skewed" in plan_of(joined, "simple")


def test_small_branches_are_broadcast_and_transactions_not_shuffled(spark, plan_of, tmp_path):
    fixtures.transactions(spark).write.parquet(f"{tmp_path}/t")
    fixtures.branches(spark).write.parquet(f"{tmp_path}/b")
    joined = joins.join_branch_transactions(
        spark.read.parquet(f"{tmp_path}/b"), spark.read.parquet(f"{tmp_path}/t")
    )
    matched = plan_of(joined.filter("TIMEID IS NOT NULL"), "simple")
    assert "Inner, BuildRight" in matched and "Exchange hashpartitioning" not in matched


def test_filter_on_transactions_leaves_the_inner_join_only(spark, plan_of, tmp_path):
    fixtures.transactions(spark).write.parquet(f"{tmp_path}/t")
    facts = spark.read.parquet(f"{tmp_path}/t")
    joined = joins.join_customer_transactions(fixtures.customers(spark), facts)
    plan = plan_of(joined.filter(F.col("TIMEID").startswith("201802")), "simple")
    assert "LeftAnti" not in plan and "Inner" in plan
    assert "StringStartsWith(TIMEID,201802)" in plan


@pytest.mark.parametrize("how", ["inner", "left", "left_anti", "left_semi"])
def test_join_unique_is_the_plain_join(spark, how):
    a = F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 7 != 0, F.col("id") % 50)
    left = spark.range(0, 3000, 1, 6).select("id", a.alias("a"), (F.col("id") % 2).alias("b"))
    right = spark.range(0, 40).select(
        F.col("id").alias("a"), (F.col("id") % 2).alias("b"), (F.col("id") * 10).alias("r")
    )
    salted = skew.join_unique(left, right, ["a", "b"], how, hot_rows=100)
    expected = left.join(right, ["a", "b"], how)
    assert salted.columns == expected.columns
    assert rows(salted) == rows(expected)


def test_join_unique_spreads_a_hot_key(spark, conf):
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__coalescePartitions__enabled="false",
    )
    left = spark.range(0, 30_000, 1, 16).select("id", F.when(F.col("id") % 3 > 0, 1).alias("k"))
    right = spark.range(0, 5).withColumnRenamed("id", "k").withColumn("r", F.lit(True))
    joined = skew.join_unique(left, right, ["k"], "left", hot_rows=1000)
    per_task = joined.groupBy(F.spark_partition_id().alias("p")).count()
    assert joined.count() == 30_000
    assert per_task.agg(F.max("count")).first()[0] < 30_000 / 3
