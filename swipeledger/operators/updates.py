"""Edits of customer accounts, as a batch.

An edit names a customer (first and last name), one field and its new value; ``seq``
gives the order of the edits. Of several customers with one name, the edit
goes to the lowest SSN of the table as it was before the batch. Names cannot be
edited and every edit touches one field, so the last valid edit of each field
gives the same table as the edits made one by one. SSN is the key of the table: an edit cannot give an account
the SSN that another has at that point of the batch, so a number that its holder gave up by an earlier edit is free again; and an account
without SSN cannot be edited. Every edit is applied, followed by a later one of its field, or
rejected with a reason.

What a batch costs follows the batch: only customers whose names are edited go beyond the scan, and these come
down to one row per name, within each task and then across tasks. The edits meet these rows in
``join_account``, so neither a common name nor a name with very many edits gathers
its rows in one task."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from swipeledger.operators.lookups import NAME
from swipeledger.operators.ownership import judged_claims
from swipeledger.operators.skew import join_account
from swipeledger.plans.shared_folder import written

EDITABLE = [
    "CUST_PHONE",
    "CUST_EMAIL",
    "CREDIT_CARD_NO",
    "FULL_STREET_ADDRESS",
    "CUST_CITY",
    "CUST_STATE",
    "CUST_ZIP",
    "SSN",
]


def _problem() -> Column:
    """Why the value of an edit cannot be used; null if it can."""
    field, value = F.col("field"), F.col("new_value")
    return (
        F.when(field.isNull() | ~field.isin(EDITABLE), "unknown field")
        .when(value.isNull(), "missing value")
        .when((field == "CUST_STATE") & (F.length(value) != 2), "state must have 2 characters")
        .when(
            (field == "CUST_ZIP") & value.try_cast("int").isNull(), "zip must be a whole number"
        )
        .when((field == "SSN") & ~value.rlike("^[0-9]{9}$"), "SSN must have 9 digits")
    )


def edited_accounts(customers: DataFrame, updates: DataFrame) -> DataFrame:
    """The SSN that an edit goes to: one row per name that is edited and exists."""
    names = updates.select(*NAME).distinct()
    named = customers.join(names, NAME, "left_semi")
    return named.groupBy(*NAME).agg(F.min("SSN").alias("SSN"))


def match_updates(customers: DataFrame, updates: DataFrame) -> DataFrame:
    """Edits whose name exists, with the SSN they go to; null if the account has none."""
    return join_account(updates, edited_accounts(customers, updates), NAME, "inner")


def unmatched_updates(customers: DataFrame, updates: DataFrame) -> DataFrame:
    """Edits whose name does not exist."""
    return join_account(updates, edited_accounts(customers, updates), NAME, "left_anti")


def judged_updates(customers: DataFrame, updates: DataFrame) -> DataFrame:
    """All edits with the ``SSN`` they go to and the ``reason`` why they change nothing, null if they do."""
    known = edited_accounts(customers, updates).withColumn("known", F.lit(True))
    reason = (
        F.when(F.col("known").isNull(), "name not found")
        .when(_problem().isNotNull(), _problem())
        .when(F.col("SSN").isNull(), "account has no SSN")
    )
    judged = join_account(updates, known, NAME, "left").withColumn("reason", reason).drop("known")
    wanted = F.when(F.col("reason").isNull() & (F.col("field") == "SSN"), F.col("new_value").try_cast("bigint"))
    # Read five times from here on; a batch of edits is small beside the customers.
    judged = written(judged.withColumn("wanted", wanted).withColumn("at", F.coalesce("seq", F.lit(-(2**63)))))
    numbers, refused = judged_claims(judged.filter(F.col("wanted").isNotNull()).select("at", "SSN", "wanted"), customers.select("SSN"))
    judged = join_account(judged, numbers, ["wanted"], "left")
    in_use = F.col("never_free")
    if refused is not None:
        judged = join_account(judged, refused.withColumn("refused", F.lit(True)), ["at", "SSN", "wanted"], "left").withColumn("never_free", F.col("never_free") | F.col("refused"))
    return judged.withColumn("reason", F.when(in_use, "SSN already in use").otherwise(F.col("reason"))).drop("at", "wanted", "never_free", "refused")


def rejected_updates(customers: DataFrame, updates: DataFrame) -> DataFrame:
    """Edits that change nothing, with the reason."""
    return judged_updates(customers, updates).filter(F.col("reason").isNotNull()).drop("SSN")


def accepted_accounts(customers: DataFrame, updates: DataFrame) -> DataFrame:
    """The accounts that change: name, SSN and the last valid value of every edited field. Unusable
    values go first, or a late one would hide an earlier good one."""
    value = F.struct("seq", "new_value")
    return (
        judged_updates(customers, updates)
        .filter(F.col("reason").isNull())
        .groupBy(*NAME, "SSN")
        .agg(
            *(F.max(F.when(F.col("field") == f, value))["new_value"].alias(f"new_{f}") for f in EDITABLE)
        )
    )


def apply_updates(customers: DataFrame, updates: DataFrame) -> DataFrame:
    """The customer table after the edits. Transactions keep their card."""
    return change_accounts(customers, accepted_accounts(customers, updates))


def change_accounts(customers: DataFrame, accepted: DataFrame) -> DataFrame:
    """The customer table with the values of ``accepted_accounts``."""
    edited = {
        f: F.coalesce(F.col(f"new_{f}").cast(customers.schema[f].dataType), F.col(f))
        for f in EDITABLE
    }
    return (
        customers.join(accepted, [*NAME, "SSN"], "left").withColumns(edited).select(customers.columns)
    )
