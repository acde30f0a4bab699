"""Declared layouts. Readers use these instead of inference, so no extra pass
over the input is spent and no column changes type between two loads."""

from pyspark.sql.types import (
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

MONEY = DecimalType(18, 2)
#: Sums of amounts; what sums of these add up to still fits.
TOTAL = DecimalType(28, 2)
#: The month that stored tables are divided or summed by.
MONTH = StructField("YEAR_MONTH", StringType())


def _layout(**columns) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in columns.items()])


CUSTOMER_RAW = _layout(
    SSN=LongType(),
    FIRST_NAME=StringType(),
    MIDDLE_NAME=StringType(),
    LAST_NAME=StringType(),
    CREDIT_CARD_NO=StringType(),
    APT_NO=StringType(),
    STREET_NAME=StringType(),
    CUST_CITY=StringType(),
    CUST_STATE=StringType(),
    CUST_COUNTRY=StringType(),
    CUST_ZIP=StringType(),
    CUST_PHONE=LongType(),
    CUST_EMAIL=StringType(),
)

CUSTOMER_CLEAN = _layout(
    SSN=LongType(),
    FIRST_NAME=StringType(),
    MIDDLE_NAME=StringType(),
    LAST_NAME=StringType(),
    CREDIT_CARD_NO=StringType(),
    CUST_CITY=StringType(),
    CUST_STATE=StringType(),
    CUST_COUNTRY=StringType(),
    CUST_ZIP=IntegerType(),
    CUST_PHONE=StringType(),
    CUST_EMAIL=StringType(),
    FULL_STREET_ADDRESS=StringType(),
)

BRANCH_RAW = _layout(
    BRANCH_CODE=IntegerType(),
    BRANCH_STATE=StringType(),
    BRANCH_PHONE=StringType(),
    BRANCH_ZIP=StringType(),
)

BRANCH_CLEAN = _layout(
    BRANCH_CODE=IntegerType(),
    BRANCH_STATE=StringType(),
    BRANCH_PHONE=StringType(),
    BRANCH_ZIP=StringType(),
)

TRANSACTION_RAW = _layout(
    TRANSACTION_ID=LongType(),
    CREDIT_CARD_NO=StringType(),
    CUST_SSN=LongType(),
    BRANCH_CODE=IntegerType(),
    TRANSACTION_TYPE=StringType(),
    TRANSACTION_VALUE=DoubleType(),
    DAY=IntegerType(),
    MONTH=IntegerType(),
    YEAR=IntegerType(),
)

TRANSACTION_CLEAN = _layout(
    TRANSACTION_ID=LongType(),
    CREDIT_CARD_NO=StringType(),
    CUST_SSN=LongType(),
    BRANCH_CODE=IntegerType(),
    TRANSACTION_TYPE=StringType(),
    TRANSACTION_VALUE=MONEY,
    TIMEID=StringType(),
)

CUSTOMER_TRANSACTIONS = _layout(
    CUST_ZIP=IntegerType(),
    FIRST_NAME=StringType(),
    LAST_NAME=StringType(),
    BRANCH_CODE=IntegerType(),
    CREDIT_CARD_NO=StringType(),
    CUST_SSN=LongType(),
    TIMEID=StringType(),
    TRANSACTION_ID=LongType(),
    TRANSACTION_TYPE=StringType(),
    TRANSACTION_VALUE=MONEY,
)

BRANCH_TRANSACTIONS = _layout(
    BRANCH_STATE=StringType(),
    BRANCH_CODE=IntegerType(),
    CREDIT_CARD_NO=StringType(),
    CUST_SSN=LongType(),
    TIMEID=StringType(),
    TRANSACTION_ID=LongType(),
    TRANSACTION_TYPE=StringType(),
    TRANSACTION_VALUE=MONEY,
)

LOAN_APPLICATION = _layout(
    Gender=StringType(),
    Married=StringType(),
    Self_Employed=StringType(),
    Application_Status=StringType(),
)

CUSTOMER_UPDATES = _layout(
    seq=LongType(),
    FIRST_NAME=StringType(),
    LAST_NAME=StringType(),
    field=StringType(),
    new_value=StringType(),
)

#: A summary of transactions; it comes with ``MONTH``, as all tables with a TIMEID do.
DAILY_TOTALS = _layout(
    TIMEID=StringType(),
    TRANSACTION_TYPE=StringType(),
    BRANCH_CODE=IntegerType(),
    TRANSACTIONS=LongType(),
    TRANSACTION_VALUE=TOTAL,
)

CARD_MONTHS = _layout(
    CREDIT_CARD_NO=StringType(),
    CUST_SSN=LongType(),
    YEAR_MONTH=StringType(),
    TRANSACTIONS=LongType(),
    TRANSACTION_VALUE=TOTAL,
)

CLEAN_TABLES = {
    "customers": CUSTOMER_CLEAN,
    "branches": BRANCH_CLEAN,
    "transactions": TRANSACTION_CLEAN,
    "customer_transactions": CUSTOMER_TRANSACTIONS,
    "branch_transactions": BRANCH_TRANSACTIONS,
    "daily_totals": DAILY_TOTALS,
    "card_months": CARD_MONTHS,
}
