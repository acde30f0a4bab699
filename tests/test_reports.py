from decimal import Decimal

import fixtures
import pytest
from conftest import rows
from pyspark.sql import functions as F

from swipeledger import schemas
from swipeledger.operators import joins, loans, reports


@pytest.fixture(scope="module")
def transactions(spark):
    return fixtures.transactions(spark)


def ordered(df):
    return [tuple(r) for r in df.collect()]


def test_type_counts(transactions):
    assert ordered(reports.type_counts(transactions)) == [
        ("Gas", 1), ("healthcare", 1), ("Bills", 2), ("Healthcare", 5),
    ]
    assert ordered(reports.top_type(transactions)) == [("Healthcare", 5)]


def test_customers_per_state_marks_ties(spark):
    customers = fixtures.customers(spark)
    assert ordered(reports.customers_per_state(customers)) == [
        ("MA", 0, False), ("CT", 2, True), ("MS", 2, True),
    ]
    assert ordered(reports.top_state(customers)) == [("CT", 2)]


def test_customer_totals(transactions):
    expected = [(100000003, 10.3), (100000001, 5.5), (100000002, 5.3), (200000000, 0.3)]
    assert ordered(reports.customer_totals(transactions)) == expected
    assert ordered(reports.top_customer(transactions)) == expected[:1]
    assert ordered(reports.top_customers(transactions, 2)) == [
        (100000003, 10.3, True), (100000001, 5.5, False),
    ]


def test_tie_at_the_cut_takes_the_lower_key(spark, transactions):
    tied = spark.createDataFrame(
        [(i, None, ssn, 1, "Gas", Decimal("1.00"), "20180101") for i, ssn in enumerate([9, 3, 7, 5])],
        schemas.TRANSACTION_CLEAN,
    )
    assert [r[0] for r in ordered(reports.top_customers(tied, 3))] == [3, 5, 7]


def test_amounts_that_are_all_missing_total_zero(spark):
    df = spark.createDataFrame(
        [(1, None, 5, 1, "Gas", None, "20180101")], schemas.TRANSACTION_CLEAN
    )
    assert ordered(reports.customer_totals(df)) == [(5, 0.0)]


def test_month_totals_merge_years_and_skip_impossible_days(transactions):
    assert ordered(reports.month_totals(transactions)) == [
        (3, 10.0, True), (2, 6.9, True), (1, 2.0, True), (12, 0.5, False),
    ]
    assert ordered(reports.top_months(transactions)) == [(3, 10.0), (2, 6.9), (1, 2.0)]


def test_dates_are_parsed_after_the_days_are_totalled(transactions, plan_of):
    plan = plan_of(reports.top_months(transactions), "simple")
    _, below = plan.split("HashAggregate(keys=[TIMEID", 1)
    # A date test moved down to the transactions would show up in their filter.
    assert "Filter isnotnull(TIMEID" in below and "yyyyMMdd" not in below


def test_branch_totals_mark_ties(spark, transactions):
    joined = joins.join_branch_transactions(fixtures.branches(spark), transactions)
    assert ordered(reports.branch_totals_for_type(joined)) == [
        (1, 0.3, True), (2, 0.3, True), (3, 0.3, True),
    ]
    assert rows(reports.top_branch_for_type(joined)) == [(1, 0.3), (2, 0.3), (3, 0.3)]
    assert rows(reports.top_branch_for_type(joined, "Bills")) == [(1, 10.0)]
    assert rows(reports.top_branch_for_type(joined, "None")) == []


def test_largest_total_reuses_the_aggregate(spark, transactions, plan_of):
    df = reports.top_branch_for_type(
        transactions.withColumn("BRANCH_STATE", F.lit("CT")), "Healthcare"
    )
    df.collect()
    assert "ReusedExchange" in plan_of(df, "formatted")


@pytest.fixture(scope="module")
def applications(spark):
    return spark.createDataFrame(
        [
            ("Male", "Yes", "Yes", "Y"),
            ("Male", "Yes", "No", "N"),
            ("Male", "Yes", "No", "N"),
            ("Male", "No", "Yes", "N"),
            ("Female", "Yes", None, "Y"),
            (None, "Yes", "Yes", "Y"),
            ("Male", "Yes", "No", "Y"),
            ("Female", "No", "No", "Y"),
        ],
        schemas.LOAN_APPLICATION,
    )


def test_loan_shares(applications):
    assert rows(loans.pct_self_employed_approved(applications)) == [(25.0, 75.0)]
    assert rows(loans.approval_rate_self_employed(applications)) == [
        (pytest.approx(200 / 3), pytest.approx(100 / 3))
    ]
    assert rows(loans.pct_rejected_married_male(applications)) == [(50.0, 50.0)]


def test_shares_of_nothing_are_null(applications):
    women = applications.filter("Gender = 'Female' AND Self_Employed IS NULL")
    assert rows(loans.pct_rejected_married_male(women)) == [(None, None)]
    assert rows(loans.approval_rate_self_employed(women)) == [(None, None)]
    assert rows(loans.pct_self_employed_approved(women.limit(0))) == [(None, None)]
