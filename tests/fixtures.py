"""Small tables with the awkward cases."""

from decimal import Decimal

from swipeledger import schemas


def customers(spark):
    """Clean customers: a shared name, an unmatched and a missing card."""
    data = [
        # SSN, first, middle, last, card, city, state, country, zip, phone, email, address
        (100000003, "Alec", "wm", "Hooper", "4210", "Natchez", "MS", "US", 39120, "(516)123-7818", "a@x.c", "656 , Main"),
        (100000001, "Alec", "m", "Hooper", "4211", "Natchez", "MS", "US", 39121, "(516)123-7819", "b@x.c", None),
        (100000002, "Mary-Ann", None, "O'Neil", "4212", "Hartford", "CT", "US", 6511, None, "c@x.c", "1 , Elm"),
        (100000004, "Etta", "b", "Holman", "4999", "Hartford", "CT", "US", 6511, "(516)123-7820", "d@x.c", "2 , Elm"),
        (100000005, "Zoe", "b", "Null", None, "Boston", "MA", "US", None, "(516)123-7821", None, "3 , Elm"),
    ]
    return spark.createDataFrame(
        [dict(zip(_CUSTOMER_ORDER, row)) for row in data], schemas.CUSTOMER_CLEAN
    )


_CUSTOMER_ORDER = [
    "SSN", "FIRST_NAME", "MIDDLE_NAME", "LAST_NAME", "CREDIT_CARD_NO", "CUST_CITY", "CUST_STATE",
    "CUST_COUNTRY", "CUST_ZIP", "CUST_PHONE", "CUST_EMAIL", "FULL_STREET_ADDRESS",
]


def branches(spark):
    """Clean branches; the last has no transactions."""
    return spark.createDataFrame(
        [(1, "CT", None, "06511"), (2, "CT", None, "00000"), (3, "MS", None, "39120"), (9, "MA", None, "00000")],
        schemas.BRANCH_CLEAN,
    )


def transactions(spark):
    """Clean transactions: an unknown card and branch, missing keys, a missing amount,
    an impossible day, a type in mixed case, tied branches."""
    data = [
        # id, card, ssn, branch, type, value, day
        (1, "4210", 100000003, 1, "Healthcare", "0.10", "20180214"),
        (2, "4210", 100000003, 2, "Healthcare", "0.20", "20180201"),
        (3, "4210", 100000003, 1, "Bills", "10.00", "20180302"),
        (4, "4211", 100000001, 3, "Gas", "5.50", "20180228"),
        (5, "4212", 100000002, 2, "Healthcare", "0.10", "20180215"),
        (6, "4212", 100000002, 2, "healthcare", "1.00", "20170215"),
        (7, "7777", 200000000, 3, "Healthcare", "0.30", "20181231"),
        (8, None, None, None, "Bills", "2.00", "20180101"),
        (9, "4212", 100000002, 77, None, "4.00", "20180231"),
        (None, "4211", 100000001, 3, "Gas", None, "20180215"),
        (11, "4212", 100000002, 1, "Healthcare", "0.20", "20181201"),
    ]
    return spark.createDataFrame(
        [(*row[:5], None if row[5] is None else Decimal(row[5]), row[6]) for row in data],
        schemas.TRANSACTION_CLEAN,
    )
