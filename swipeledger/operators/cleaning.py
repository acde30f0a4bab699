"""Raw tables to clean tables: one narrow projection each, no shuffle.

Columns that are not named here pass through unchanged."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from swipeledger.functions import dates, text
from swipeledger.functions.money import money
from swipeledger.schemas import MONEY


def clean_customers(raw: DataFrame, area: str = "516", strict_zip: bool = False) -> DataFrame:
    """Name casing, one address column, formatted phone, numeric zip.

    A zip that is no whole number becomes null and is listed by
    ``rejected_zips``; with ``strict_zip`` it fails the job instead."""
    zip_number = text.strict_zip_number if strict_zip else text.zip_number
    return raw.withColumns(
        {
            "CUST_ZIP": zip_number(F.col("CUST_ZIP")),
            "FIRST_NAME": text.title_case(F.col("FIRST_NAME")),
            "MIDDLE_NAME": F.lower("MIDDLE_NAME"),
            "LAST_NAME": text.title_case(F.col("LAST_NAME")),
            "FULL_STREET_ADDRESS": text.street_address(F.col("APT_NO"), F.col("STREET_NAME")),
            "CUST_PHONE": text.local_phone(F.col("CUST_PHONE"), area),
        }
    ).drop("STREET_NAME", "APT_NO")


def rejected_zips(raw: DataFrame) -> DataFrame:
    """Raw customers whose zip is missing or no whole number."""
    return raw.filter(text.zip_number(F.col("CUST_ZIP")).isNull())


def clean_branches(raw: DataFrame, default_zip: str = "00000") -> DataFrame:
    return raw.withColumns(
        {
            "BRANCH_PHONE": text.full_phone(F.col("BRANCH_PHONE")),
            "BRANCH_ZIP": text.zip_text(F.col("BRANCH_ZIP"), default_zip),
        }
    )


def rejected_amounts(raw: DataFrame) -> DataFrame:
    """Raw transactions whose amount is changed by storing it in cents: it has parts of a cent, or is no number that
    fits."""
    value = F.col("TRANSACTION_VALUE")
    return raw.filter(value.isNotNull() & ~F.coalesce(value.try_cast(MONEY).cast("double") == value, F.lit(False)))


def clean_transactions(raw: DataFrame) -> DataFrame:
    """One TIMEID in place of the three date columns; amounts in exact cents. ``rejected_amounts`` lists those that
    this changes."""
    return raw.withColumns(
        {
            "TRANSACTION_VALUE": money(F.col("TRANSACTION_VALUE")),
            "TIMEID": dates.timeid(F.col("YEAR"), F.col("MONTH"), F.col("DAY")),
        }
    ).drop("DAY", "MONTH", "YEAR")


def with_date_parts(transactions: DataFrame) -> DataFrame:
    """Year, month, day and year-month text of every TIMEID."""
    value = F.col("TIMEID")
    return transactions.withColumns(
        {
            "YEAR": dates.year_text(value),
            "MONTH": dates.month_text(value),
            "DAY": dates.day_text(value),
            "YEAR_MONTH": dates.year_month(value),
        }
    )


def with_date(transactions: DataFrame) -> DataFrame:
    """TIMEID as a date; null where the day does not exist."""
    return transactions.withColumn("TRANSACTION_DATE", dates.timeid_date(F.col("TIMEID")))
