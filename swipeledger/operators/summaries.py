"""Partial aggregates of transactions, with counts and exact sums that merge.

A summary has the columns by which reports group, ``TRANSACTIONS`` (how many have an id) and ``TRANSACTION_VALUE`` (their sum). Reports and
lookups that only count and add take a summary in place of the transactions, and summaries of parts together are one of the whole."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from swipeledger.functions.dates import year_month
from swipeledger.functions.money import exact_total
from swipeledger.schemas import CARD_MONTHS, DAILY_TOTALS, MONTH


def daily_totals(transactions: DataFrame) -> DataFrame:
    """By day, type and branch: as many rows as these have combinations, whatever the number of transactions. For the reports
    by type, month and, beside ``with_branches``, branch."""
    return _summary(transactions, ["TIMEID", "TRANSACTION_TYPE", "BRANCH_CODE"], DAILY_TOTALS)


def card_months(transactions: DataFrame) -> DataFrame:
    """By month, card and customer: for bills and what customers spent."""
    return _summary(transactions, ["CREDIT_CARD_NO", "CUST_SSN"], CARD_MONTHS)


def with_branches(daily: DataFrame, branches: DataFrame) -> DataFrame:
    """The daily totals of known branches with their state, for reports that take transactions joined to branches. Branches without
    transactions have no row, as they add nothing."""
    return daily.join(branches.select("BRANCH_CODE", "BRANCH_STATE"), "BRANCH_CODE")


def _summary(transactions: DataFrame, keys: list[str], layout: StructType) -> DataFrame:
    if "YEAR_MONTH" not in transactions.columns:
        transactions = transactions.withColumn("YEAR_MONTH", year_month(F.col("TIMEID")))
    totals = transactions.groupBy(*keys, "YEAR_MONTH").agg(
        F.count("TRANSACTION_ID").alias("TRANSACTIONS"), exact_total(F.col("TRANSACTION_VALUE")).alias("TRANSACTION_VALUE")
    )
    columns = {f.name: f.dataType for f in [*layout, MONTH]}
    return totals.select(*(F.col(name).cast(kind).alias(name) for name, kind in columns.items()))
