"""Parameterised lookups. A lookup that finds nothing returns no rows, or a count
and total of 0."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from swipeledger.functions import dates
from swipeledger.functions.money import exact_total, transaction_count

NAME = ["FIRST_NAME", "LAST_NAME"]


def transactions_by_zip_month(
    customer_transactions: DataFrame, zip_code: int, month: str | int, year: str | int
) -> DataFrame:
    """Transactions of one zip code in one month, newest day first."""
    return customer_transactions.filter(
        (F.col("CUST_ZIP") == int(zip_code)) & dates.in_month(customer_transactions, year, month)
    ).orderBy(F.desc("TIMEID"), "TRANSACTION_ID")


def transactions_between(
    customer_transactions: DataFrame, first_name: str, last_name: str, start: str, end: str
) -> DataFrame:
    """Transactions of one customer from ``start`` to ``end`` (``YYYYMMDD``, both
    inclusive), newest first."""
    return customer_transactions.filter(
        _named(first_name, last_name) & dates.between_days(customer_transactions, start, end)
    ).orderBy(F.desc("TIMEID"), "TRANSACTION_ID")


def type_count_total(transactions: DataFrame, transaction_type: str) -> DataFrame:
    """Count and total of one transaction type, in any letter case."""
    wanted = F.upper("TRANSACTION_TYPE") == F.upper(F.lit(transaction_type))
    return transactions.filter(wanted).agg(*_count_and_total(transactions))


def type_count_total_all(transactions: DataFrame) -> DataFrame:
    return _count_and_total_by(transactions, "TRANSACTION_TYPE")


def state_count_total(branch_transactions: DataFrame, state: str) -> DataFrame:
    """Count and total over all branches of one state. Branches without transactions add nothing,
    so the key test only spares looking for them."""
    used = _in_state(state) & F.col("BRANCH_CODE").isNotNull()
    return branch_transactions.filter(used).agg(*_count_and_total(branch_transactions))


def branch_count_total_by_state(branch_transactions: DataFrame, state: str) -> DataFrame:
    """Count and total for each branch of one state."""
    return _count_and_total_by(branch_transactions.filter(_in_state(state)), "BRANCH_CODE")


def monthly_bill(
    transactions: DataFrame, card: str, month: str | int, year: str | int
) -> DataFrame:
    """What one card spent in one month."""
    return transactions.filter(
        (F.col("CREDIT_CARD_NO") == card) & dates.in_month(transactions, year, month)
    ).agg(_total())


def monthly_bills_all(transactions: DataFrame) -> DataFrame:
    """The bill of every card for every month."""
    if "YEAR_MONTH" not in transactions.columns:
        transactions = transactions.withColumn("YEAR_MONTH", dates.year_month(F.col("TIMEID")))
    return (
        transactions.filter(F.col("CREDIT_CARD_NO").isNotNull())
        .groupBy("CREDIT_CARD_NO", "YEAR_MONTH")
        .agg(_total())
    )


def account_details(customers: DataFrame, first_name: str, last_name: str) -> DataFrame:
    """The customer of that name; of several, the one with the lowest SSN."""
    return (
        customers.filter(_named(first_name, last_name))
        .orderBy(F.asc_nulls_last("SSN"), "CREDIT_CARD_NO")
        .limit(1)
    )


def account_details_all(customers: DataFrame) -> DataFrame:
    """``account_details`` for every name at once. An aggregate rather than a
    window: a name held by very many customers is reduced within each task
    before the shuffle."""
    rest = [c for c in customers.columns if c not in ("SSN", "CREDIT_CARD_NO", *NAME)]
    first = F.min(F.struct(F.col("SSN").isNull().alias("no_ssn"), "SSN", "CREDIT_CARD_NO", *rest))
    return (
        customers.filter(F.col("FIRST_NAME").isNotNull() & F.col("LAST_NAME").isNotNull())
        .groupBy(*NAME)
        .agg(first.alias("account"))
        .select(*(F.col(c) if c in NAME else F.col(f"account.{c}") for c in customers.columns))
    )


def account_details_view(accounts: DataFrame) -> DataFrame:
    """The lines shown for an account."""
    return accounts.select(
        F.concat_ws(" ", "FIRST_NAME", "MIDDLE_NAME", "LAST_NAME").alias("CUSTOMER_NAME"),
        "CUST_PHONE",
        "CUST_EMAIL",
        "CREDIT_CARD_NO",
        "CUST_COUNTRY",
        F.concat_ws(" ", "FULL_STREET_ADDRESS", "CUST_CITY", "CUST_STATE", "CUST_ZIP").alias(
            "CUSTOMER_ADDRESS"
        ),
        "SSN",
    )


def _named(first_name: str, last_name: str) -> Column:
    return (F.col("FIRST_NAME") == first_name) & (F.col("LAST_NAME") == last_name)


def _in_state(state: str) -> Column:
    return F.col("BRANCH_STATE") == state.upper()


def _total() -> Column:
    return exact_total(F.col("TRANSACTION_VALUE")).cast("double").alias("total_value")


def _count_and_total(transactions: DataFrame) -> list[Column]:
    return [transaction_count(transactions).alias("transactions"), _total()]


def _count_and_total_by(transactions: DataFrame, key: str) -> DataFrame:
    return transactions.filter(F.col(key).isNotNull()).groupBy(key).agg(*_count_and_total(transactions))
