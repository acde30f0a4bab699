import fixtures
import pytest
from conftest import rows

from swipeledger.functions.dates import year_month
from swipeledger.operators import joins, lookups


@pytest.fixture(scope="module")
def customers(spark):
    return fixtures.customers(spark)


@pytest.fixture(scope="module")
def transactions(spark):
    return fixtures.transactions(spark)


@pytest.fixture(scope="module")
def customer_transactions(customers, transactions):
    return joins.join_customer_transactions(customers, transactions)


@pytest.fixture(scope="module")
def branch_transactions(spark, transactions):
    return joins.join_branch_transactions(fixtures.branches(spark), transactions)


def ids(df):
    return [r.TRANSACTION_ID for r in df.collect()]


def test_zip_and_month(customer_transactions):
    find = lookups.transactions_by_zip_month
    assert ids(find(customer_transactions, 39120, "02", "2018")) == [1, 2]
    assert ids(find(customer_transactions, "39120", 2, 2018)) == [1, 2]
    assert ids(find(customer_transactions, 39120, "11", "2018")) == []


def test_zip_and_month_on_a_stored_table(customer_transactions):
    stored = customer_transactions.withColumn("YEAR_MONTH", year_month(customer_transactions.TIMEID))
    assert ids(lookups.transactions_by_zip_month(stored, 39120, "02", "2018")) == [1, 2]
    assert ids(lookups.transactions_between(stored, "Alec", "Hooper", "20180201", "20180302")) == [
        3, 4, None, 1, 2,
    ]


def test_between_is_inclusive_and_newest_first(customer_transactions):
    find = lookups.transactions_between
    assert ids(find(customer_transactions, "Mary-Ann", "O'Neil", "20180215", "20181201")) == [11, 9, 5]
    assert ids(find(customer_transactions, "mary-ann", "O'Neil", "20180215", "20181201")) == []
    assert ids(find(customer_transactions, "Etta", "Holman", "00000000", "99999999")) == []


@pytest.mark.parametrize("kind", ["Healthcare", "HEALTHCARE", "healthcare"])
def test_type_in_any_case(transactions, kind):
    assert rows(lookups.type_count_total(transactions, kind)) == [(6, 1.9)]


def test_misses_are_zero(transactions, branch_transactions):
    assert rows(lookups.type_count_total(transactions, "Nothing")) == [(0, 0.0)]
    assert rows(lookups.state_count_total(branch_transactions, "ZZ")) == [(0, 0.0)]
    assert rows(lookups.monthly_bill(transactions, "none", 1, 2018)) == [(0.0,)]


def test_all_types(transactions):
    assert rows(lookups.type_count_total_all(transactions)) == [
        ("Bills", 2, 12.0),
        ("Gas", 1, 5.5),
        ("Healthcare", 5, 0.9),
        ("healthcare", 1, 1.0),
    ]


def test_state_totals(branch_transactions):
    assert rows(lookups.state_count_total(branch_transactions, "ct")) == [(6, 11.6)]
    # The idle branch neither counts nor adds.
    assert rows(lookups.state_count_total(branch_transactions, "MA")) == [(0, 0.0)]


def test_branches_of_a_state(branch_transactions):
    assert rows(lookups.branch_count_total_by_state(branch_transactions, "CT")) == [
        (1, 3, 10.3),
        (2, 3, 1.3),
    ]
    assert rows(lookups.branch_count_total_by_state(branch_transactions, "MA")) == []


def test_account_is_the_lowest_ssn(customers):
    found = lookups.account_details(customers, "Alec", "Hooper")
    assert rows(found, "SSN", "CREDIT_CARD_NO") == [(100000001, "4211")]
    assert rows(lookups.account_details(customers, "alec", "Hooper")) == []


def test_accounts_of_all_names(customers):
    every = lookups.account_details_all(customers)
    assert every.dtypes == customers.dtypes
    names = [(r.FIRST_NAME, r.LAST_NAME) for r in customers.collect()]
    expected = [
        row for name in set(names) for row in rows(lookups.account_details(customers, *name))
    ]
    assert rows(every) == sorted(expected)


def test_account_lines(customers):
    lines = lookups.account_details_view(customers.filter("SSN IN (100000003, 100000001)"))
    assert rows(lines, "CUSTOMER_NAME", "CUSTOMER_ADDRESS") == [
        ("Alec m Hooper", "Natchez MS 39121"),
        ("Alec wm Hooper", "656 , Main Natchez MS 39120"),
    ]


def test_monthly_bill(transactions):
    assert rows(lookups.monthly_bill(transactions, "4210", "02", "2018")) == [(0.3,)]


def test_every_monthly_bill(transactions):
    bills = rows(lookups.monthly_bills_all(transactions))
    assert ("4210", "201802", 0.3) in bills
    assert ("4211", "201802", 5.5) in bills
    assert len(bills) == 7 and all(card is not None for card, _, _ in bills)
    for card, month, total in bills:
        assert rows(lookups.monthly_bill(transactions, card, month[4:], month[:4])) == [(total,)]


def test_month_filters_reach_the_scan(transactions, plan_of, tmp_path, spark):
    transactions.write.parquet(f"{tmp_path}/t")
    plan = plan_of(lookups.monthly_bill(spark.read.parquet(f"{tmp_path}/t"), "4210", 2, 2018))
    assert "StringStartsWith(TIMEID,201802)" in plan
    assert "EqualTo(CREDIT_CARD_NO,4210)" in plan
    assert "ReadSchema: struct<CREDIT_CARD_NO:string,TRANSACTION_VALUE:decimal(18,2),TIMEID:string>" in plan
