"""The numbers behind the transaction and customer charts.

Every aggregate is combined within each task before its shuffle. ``highlight``
marks the bars drawn in the accent colour. Ties are ordered by the key. In place of transactions, reports take a summary of them
(``operators.summaries``) that has the columns they group by."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from swipeledger.functions.dates import timeid_date
from swipeledger.functions.money import exact_total, transaction_count


def type_counts(transactions: DataFrame) -> DataFrame:
    """Transactions of each type, fewest first."""
    return _type_counts(transactions).orderBy("transactions", "TRANSACTION_TYPE")


def top_type(transactions: DataFrame) -> DataFrame:
    """The most frequent type."""
    return _type_counts(transactions).orderBy(F.desc("transactions"), "TRANSACTION_TYPE").limit(1)


def customers_per_state(customers: DataFrame) -> DataFrame:
    """Customers with a card in each state, fewest first."""
    return _mark_largest(_state_counts(customers), "customers").orderBy("customers", "CUST_STATE")


def top_state(customers: DataFrame) -> DataFrame:
    """The state with the most customers."""
    return _state_counts(customers).orderBy(F.desc("customers"), "CUST_STATE").limit(1)


def customer_totals(transactions: DataFrame) -> DataFrame:
    """What each customer spent, most first."""
    totals = _totals(transactions, "CUST_SSN").orderBy(F.desc("total_value"), "CUST_SSN")
    return _as_double(totals)


def top_customers(transactions: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` customers who spent most; the first is highlighted."""
    order = [F.desc("total_value"), F.asc("CUST_SSN")]
    best = _totals(transactions, "CUST_SSN").orderBy(*order).limit(n)
    # The window sees the n rows of the report only.
    first = F.row_number().over(Window.orderBy(*order)) == 1
    return _as_double(best.withColumn("highlight", first))


def top_customer(transactions: DataFrame) -> DataFrame:
    """The customer who spent most."""
    best = _totals(transactions, "CUST_SSN").orderBy(F.desc("total_value"), "CUST_SSN").limit(1)
    return _as_double(best)


def month_totals(transactions: DataFrame, highlighted: int = 3) -> DataFrame:
    """Value per month of the year over all years, largest first; the largest
    ``highlighted`` months are marked."""
    order = [F.desc("total_value"), F.asc("month")]
    # The window sees the twelve months of the year only.
    place = F.row_number().over(Window.orderBy(*order))
    totals = _month_totals(transactions).withColumn("highlight", place <= highlighted)
    return _as_double(totals.orderBy(*order))


def top_months(transactions: DataFrame, n: int = 3) -> DataFrame:
    """The ``n`` months of the year with the largest value."""
    best = _month_totals(transactions).orderBy(F.desc("total_value"), "month").limit(n)
    return _as_double(best)


def rejected_days(transactions: DataFrame) -> DataFrame:
    """What the month reports leave out: days that do not exist, and a missing day, with the number of their
    transactions and their value."""
    days = transactions.groupBy("TIMEID").agg(
        F.count("*").alias("transactions"), exact_total(F.col("TRANSACTION_VALUE")).alias("total_value")
    )
    return _as_double(days.withColumn("day", timeid_date(F.col("TIMEID"))).filter(F.col("day").isNull()).drop("day"))


def branch_totals_for_type(
    branch_transactions: DataFrame, transaction_type: str = "Healthcare"
) -> DataFrame:
    """Value of one transaction type per branch, largest first; every branch with
    the largest value is highlighted."""
    totals = _branch_totals(branch_transactions, transaction_type)
    marked = _mark_largest(totals, "total_value")
    return _as_double(marked.orderBy(F.desc("total_value"), "BRANCH_CODE"))


def top_branch_for_type(
    branch_transactions: DataFrame, transaction_type: str = "Healthcare"
) -> DataFrame:
    """The branch, or all tied branches, with the largest value of one type."""
    totals = _branch_totals(branch_transactions, transaction_type)
    largest = totals.agg(F.max("total_value")).scalar()
    return _as_double(totals.filter(F.col("total_value") == largest))


def _type_counts(transactions: DataFrame) -> DataFrame:
    return _counts(transactions, "TRANSACTION_TYPE", transaction_count(transactions), "transactions")


def _state_counts(customers: DataFrame) -> DataFrame:
    return _counts(customers, "CUST_STATE", F.count("CREDIT_CARD_NO"), "customers")


def _counts(df: DataFrame, key: str, counted: Column, name: str) -> DataFrame:
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(counted.alias(name))


def _totals(transactions: DataFrame, key: str) -> DataFrame:
    return (
        transactions.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(exact_total(F.col("TRANSACTION_VALUE")).alias("total_value"))
    )


def _month_totals(transactions: DataFrame) -> DataFrame:
    """Totals per day first, so that only distinct days are parsed as dates. Days that
    do not exist are dropped by a count: Spark would move a test of the month itself
    down to every transaction."""
    days = _totals(transactions, "TIMEID").withColumn("month", F.month(timeid_date(F.col("TIMEID"))))
    return (
        days.groupBy("month")
        .agg(F.sum("total_value").alias("total_value"), F.count("month").alias("days"))
        .filter(F.col("days") > 0)
        .drop("days")
    )


def _branch_totals(branch_transactions: DataFrame, transaction_type: str) -> DataFrame:
    of_type = branch_transactions.filter(F.col("TRANSACTION_TYPE") == transaction_type)
    return _totals(of_type, "BRANCH_CODE")


def _mark_largest(df: DataFrame, column: str) -> DataFrame:
    """The largest value is a scalar subquery on the same aggregate, whose shuffle
    Spark runs once and uses twice."""
    return df.withColumn("highlight", F.col(column) == df.agg(F.max(column)).scalar())


def _as_double(df: DataFrame) -> DataFrame:
    return df.withColumn("total_value", F.col("total_value").cast("double"))
