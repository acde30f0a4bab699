"""Temp views for SQL over the tables."""

from pyspark.sql import DataFrame

# The view names that existing SQL uses.
RAW_BRANCH_VIEW = "branch_table"
TRANSACTION_VIEW = "credit_table"
CUSTOMER_VIEW = "customer_table"
BRANCH_VIEW = "branches_table"


def register_views(
    customers: DataFrame,
    transactions: DataFrame,
    branches: DataFrame,
    raw_branches: DataFrame | None = None,
) -> None:
    """Can be called again in the same session; the views are replaced."""
    customers.createOrReplaceTempView(CUSTOMER_VIEW)
    transactions.createOrReplaceTempView(TRANSACTION_VIEW)
    branches.createOrReplaceTempView(BRANCH_VIEW)
    if raw_branches is not None:
        raw_branches.createOrReplaceTempView(RAW_BRANCH_VIEW)
