import json
from collections import Counter
from pathlib import Path

import fixtures
import pytest
from conftest import rows
from pyspark.sql import functions as F

from swipeledger.sinks.files import write_clean
from swipeledger.sinks.jdbc import CUSTOMER_TABLE, Database, write_jdbc
from swipeledger.sources.readers import read_clean


@pytest.mark.parametrize("file_format", ["parquet", "json"])
@pytest.mark.parametrize("table", ["customers", "branches", "transactions"])
def test_round_trip(spark, tmp_path, table, file_format):
    df = getattr(fixtures, table)(spark)
    path = f"{tmp_path}/t"
    for _ in range(2):
        write_clean(df, path, file_format)
    back = read_clean(spark, table, path, file_format).select(df.columns)
    assert back.dtypes == df.dtypes
    assert rows(back) == rows(df)


def test_json_keeps_null_fields(spark, tmp_path):
    df = fixtures.customers(spark)
    write_clean(df, f"{tmp_path}/t", "json")
    lines = [json.loads(x) for f in Path(tmp_path, "t").glob("*.json") for x in f.open()]
    assert len(lines) == 5
    assert all(set(line) == set(df.columns) for line in lines)


def test_months_are_folders_and_pruned(spark, tmp_path, plan_of):
    path = f"{tmp_path}/t"
    write_clean(fixtures.transactions(spark), path)
    assert len(list(Path(path).glob("YEAR_MONTH=*"))) == 5
    month = read_clean(spark, "transactions", path).filter("YEAR_MONTH = '201802'")
    assert month.count() == 6
    assert "PartitionFilters: [isnotnull(YEAR_MONTH" in plan_of(month)


def test_rows_without_a_day_are_kept(spark, tmp_path):
    df = fixtures.transactions(spark).withColumn("TIMEID", F.lit(None).cast("string"))
    write_clean(df, f"{tmp_path}/t")
    assert read_clean(spark, "transactions", f"{tmp_path}/t").count() == 11


def test_hot_month_gets_several_files_and_others_one(spark, tmp_path, conf):
    conf(spark__sql__adaptive__advisoryPartitionSizeInBytes="100KB")
    day = F.when(F.col("id") % 3 == 0, "20180101").otherwise(
        F.concat(F.lit("2017"), F.lpad((F.col("id") % 12 + 1).cast("string"), 2, "0"), F.lit("01"))
    )
    df = spark.range(0, 300_000, 1, 8).select(
        F.col("id").alias("TRANSACTION_ID"), F.xxhash64("id").alias("CUST_SSN"), day.alias("TIMEID")
    )
    write_clean(df, f"{tmp_path}/t", sort_by=["CUST_SSN"])
    files = Counter(f.parent.name for f in Path(tmp_path, "t").glob("YEAR_MONTH=*/*.parquet"))
    assert files["YEAR_MONTH=201801"] >= 4
    assert sum(files.values()) < 8 * 13
    assert read_clean(spark, "transactions", f"{tmp_path}/t").count() == 300_000


class Recorder:
    """Stands for a DataFrame and its writer; no database is started here."""

    def __init__(self):
        self.said = {}
        self.write = self

    def format(self, name):
        self.said["format"] = name
        return self

    def mode(self, name):
        self.said["mode"] = name
        return self

    def option(self, name, value):
        self.said[name] = value
        return self

    def options(self, **given):
        self.said.update(given)
        return self

    def save(self):
        self.said["saved"] = True


def test_jdbc_append():
    df = Recorder()
    write_jdbc(df, CUSTOMER_TABLE, Database("jdbc:x:y", user="u", password="p", driver="d"))
    assert df.said == {
        "format": "jdbc", "mode": "append", "url": "jdbc:x:y", "user": "u", "password": "p",
        "driver": "d", "dbtable": "cdw_sapp_customer", "numPartitions": "16", "batchsize": "10000",
        "saved": True,
    }


def test_jdbc_overwrite_keeps_the_column_types():
    df = Recorder()
    write_jdbc(df, CUSTOMER_TABLE, Database("jdbc:x:y"), mode="overwrite")
    assert df.said["mode"] == "overwrite" and df.said["truncate"] == "true"
    assert not {"user", "password", "driver"} & set(df.said)


def test_credentials_are_not_shown():
    shown = repr(Database("jdbc:x:y", user="alice", password="secret"))
    assert "alice" not in shown and "secret" not in shown
