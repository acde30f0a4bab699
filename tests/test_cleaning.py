import datetime
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import rows
from swipeledger import schemas
from swipeledger.operators import cleaning


@pytest.fixture(scope="module")
def raw(spark):
    data = [
        (1, "ALEC", "Wm", "o'neil", "4210", "656", "Main St", "Natchez", "MS", "US", "06511", 1237818, "a@x.c"),
        (2, None, None, "mary-ann", "4211", None, "Elm", "Natchez", "MS", "US", "abc", None, None),
        (3, "zoe", "B", None, None, "3", "Elm", "Natchez", "MS", "US", None, 1237819, None),
    ]
    return spark.createDataFrame(data, schemas.CUSTOMER_RAW).withColumn("NOTE", F.lit("kept"))


def test_clean_customers(raw):
    clean = cleaning.clean_customers(raw)
    got = rows(
        clean, "SSN", "FIRST_NAME", "MIDDLE_NAME", "LAST_NAME", "CUST_ZIP", "CUST_PHONE",
        "FULL_STREET_ADDRESS", "NOTE",
    )
    assert got == [
        (1, "Alec", "wm", "O'Neil", 6511, "(516)123-7818", "656 , Main St", "kept"),
        (2, None, None, "Mary-Ann", None, None, None, "kept"),
        (3, "Zoe", "b", None, None, "(516)123-7819", "3 , Elm", "kept"),
    ]
    assert set(clean.columns) == {*schemas.CUSTOMER_CLEAN.fieldNames(), "NOTE"}
    assert all(clean.schema[f.name].dataType == f.dataType for f in schemas.CUSTOMER_CLEAN)


def test_rejected_zips(raw):
    assert rows(cleaning.rejected_zips(raw), "SSN", "CUST_ZIP") == [(2, "abc"), (3, None)]


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize("ssn", [2, 3])
def test_strict_zip_fails(raw, conf, ssn, ansi):
    conf(spark__sql__ansi__enabled=ansi)
    with pytest.raises(PySparkException, match="not a zip"):
        cleaning.clean_customers(raw.filter(F.col("SSN") == ssn), strict_zip=True).collect()


def test_strict_zip_passes(raw):
    good = cleaning.clean_customers(raw.filter("SSN = 1"), strict_zip=True)
    assert rows(good, "CUST_ZIP") == [(6511,)]


def test_clean_branches(spark):
    raw = spark.createDataFrame(
        [(1, "CT", "1234565276", 6511), (2, "CT", None, None)], schemas.BRANCH_RAW
    )
    assert rows(cleaning.clean_branches(raw)) == [
        (1, "CT", "(123)456-5276", "06511"),
        (2, "CT", None, "00000"),
    ]
    assert rows(cleaning.clean_branches(raw, "99999"), "BRANCH_ZIP") == [("06511",), ("99999",)]


def test_zip_default_without_ansi(spark, conf):
    conf(spark__sql__ansi__enabled="false")
    raw = spark.createDataFrame([(2, "CT", None, None)], schemas.BRANCH_RAW)
    assert rows(cleaning.clean_branches(raw), "BRANCH_ZIP") == [("00000",)]


def test_clean_transactions(spark):
    raw = spark.createDataFrame(
        [(1, "4210", 5, 7, "Bills", 78.9, 14, 2, 2018), (2, "4210", 5, 7, "Gas", None, 31, 12, 2018)],
        schemas.TRANSACTION_RAW,
    )
    clean = cleaning.clean_transactions(raw)
    assert clean.columns == schemas.TRANSACTION_CLEAN.fieldNames()
    assert rows(clean, "TRANSACTION_ID", "TRANSACTION_VALUE", "TIMEID") == [
        (1, Decimal("78.90"), "20180214"),
        (2, None, "20181231"),
    ]


def test_dates_and_parts(spark):
    df = spark.createDataFrame([("20180214",), ("20180231",)], "TIMEID string")
    assert rows(cleaning.with_date(df)) == [
        ("20180214", datetime.date(2018, 2, 14)),
        ("20180231", None),
    ]
    assert rows(cleaning.with_date_parts(df))[0] == ("20180214", "2018", "02", "14", "201802")
