"""Amounts and percentages.

Amounts are added as decimals: the sum is exact and does not depend on the order
in which partitions arrive. Results leave as doubles."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from swipeledger.schemas import MONEY, TOTAL


def money(amount: Column) -> Column:
    """Null for an amount that does not fit."""
    return amount.try_cast(MONEY)


def exact_total(amount: Column) -> Column:
    """Sum of amounts, or of sums of amounts; 0 where there is nothing to add."""
    return F.coalesce(F.sum(amount.try_cast(TOTAL)), F.lit(0).cast(TOTAL))


def transaction_count(transactions: DataFrame) -> Column:
    """How many transactions have an id; a summary has counts of its own."""
    if "TRANSACTIONS" in transactions.columns:
        return F.coalesce(F.sum("TRANSACTIONS"), F.lit(0))
    return F.count("TRANSACTION_ID")


def percent(part: Column, whole: Column) -> Column:
    """``part / whole * 100``; null where ``whole`` is 0."""
    return F.try_divide(part.cast("double"), whole.cast("double")) * 100
