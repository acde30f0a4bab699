"""Transactions joined to their customers and branches, keeping customers and
branches without any transaction.

Written as a LEFT JOIN, the big transaction table would be the side that Spark
can neither spare the shuffle (only the right side of a left join can be
broadcast) nor split when one key is hot (adaptive execution splits only the
preserved side). So the join is put together from two parts that are free of
both limits:

* matched: an inner join. A customer or branch table below Spark's broadcast
  threshold is broadcast and the transactions are not shuffled at all; above it,
  adaptive execution splits a hot card or branch on either side.
* idle: an anti join against the distinct keys of the transactions. The keys are
  made distinct within each task before they are shuffled, so a hot key arrives
  once per task; customers without a card do not meet in one task either.

A filter on a transaction column removes the idle part from the plan."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from swipeledger.operators.skew import join_unique
from swipeledger.schemas import BRANCH_TRANSACTIONS, CUSTOMER_TRANSACTIONS


def join_customer_transactions(customers: DataFrame, transactions: DataFrame) -> DataFrame:
    """customers LEFT JOIN transactions on the card. The card is taken from the
    transactions, so it is null for an idle customer."""
    return _keeping_idle(
        customers, transactions, "CREDIT_CARD_NO", ["CUST_ZIP", "FIRST_NAME", "LAST_NAME"],
        CUSTOMER_TRANSACTIONS.fieldNames(),
    )


def join_branch_transactions(branches: DataFrame, transactions: DataFrame) -> DataFrame:
    """branches LEFT JOIN transactions on the branch code. The code is taken from
    the transactions, so it is null for an idle branch."""
    return _keeping_idle(
        branches, transactions, "BRANCH_CODE", ["BRANCH_STATE"],
        BRANCH_TRANSACTIONS.fieldNames(),
    )


def _keeping_idle(
    owners: DataFrame, transactions: DataFrame, key: str, owner_columns: list[str], output: list[str]
) -> DataFrame:
    matched = _matched(owners, transactions, key, owner_columns, output)
    return matched.union(_idle(owners, transactions, key, owner_columns, matched))


def _matched(owners: DataFrame, transactions: DataFrame, key: str, owner_columns: list[str], output: list[str]) -> DataFrame:
    return transactions.join(owners.select(key, *owner_columns), key).select(*output)


def _idle(owners: DataFrame, transactions: DataFrame, key: str, owner_columns: list[str], matched: DataFrame) -> DataFrame:
    used_keys = transactions.select(key).filter(F.col(key).isNotNull()).distinct()
    return join_unique(owners.select(key, *owner_columns), used_keys, [key], "left_anti").select(
        *(
            F.col(field.name)
            if field.name in owner_columns
            else F.lit(None).cast(field.dataType).alias(field.name)
            for field in matched.schema
        )
    )


def customer_parts(customers: DataFrame, transactions: DataFrame, new: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """The two parts of ``join_customer_transactions``: of the ``new`` transactions (all, if there are none) those with a customer, and the
    customers without any of the ``transactions``."""
    return _parts(customers, transactions, new, "CREDIT_CARD_NO", ["CUST_ZIP", "FIRST_NAME", "LAST_NAME"], CUSTOMER_TRANSACTIONS.fieldNames())


def branch_parts(branches: DataFrame, transactions: DataFrame, new: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """The two parts of ``join_branch_transactions``."""
    return _parts(branches, transactions, new, "BRANCH_CODE", ["BRANCH_STATE"], BRANCH_TRANSACTIONS.fieldNames())


def _parts(
    owners: DataFrame, transactions: DataFrame, new: DataFrame | None, key: str, owner_columns: list[str], output: list[str]
) -> tuple[DataFrame, DataFrame]:
    matched = _matched(owners, transactions if new is None else new, key, owner_columns, output)
    return matched, _idle(owners, transactions, key, owner_columns, matched)
