"""Versions of stored tables, and loads that add to them."""

import json
from pathlib import Path

import pytest
from conftest import rows
from test_plans import BRANCHES, CUSTOMERS, TRANSACTIONS

from swipeledger import schemas
from swipeledger.operators import lookups, reports, summaries
from swipeledger.operators.joins import join_customer_transactions
from swipeledger.plans import load, publish
from swipeledger.sinks import versions
from swipeledger.sources.readers import read_clean


def put(folder, name, data):
    path = Path(folder, f"{name}.json")
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(json.dumps(data))
    return str(path)


@pytest.fixture
def raw(tmp_path):
    return {
        "customers": put(tmp_path, "raw/customers", CUSTOMERS),
        "branches": put(tmp_path, "raw/branches", BRANCHES),
        "transactions": put(tmp_path, "raw/transactions/1", TRANSACTIONS),
    }


def bought(number, day, card="4210", value=1.0, **more):
    return TRANSACTIONS[0] | {"TRANSACTION_ID": number, "CREDIT_CARD_NO": card, "TRANSACTION_VALUE": value, "DAY": day, "MONTH": 2} | more


def tables(spark, paths):
    return {n: rows(read_clean(spark, n, paths[n])) for n in ("customers", "branches", "transactions", "customer_transactions", "branch_transactions")}


@pytest.mark.parametrize("step", [2, 7])
def test_a_load_that_fails_leaves_the_old_tables(spark, raw, tmp_path, monkeypatch, step):
    paths = load.load_tables(spark, **raw, target=f"{tmp_path}/s")
    before, write, calls = tables(spark, paths), load.write_clean, []

    def failing(*args, **kwargs):
        calls.append(args)
        if len(calls) == step:
            raise OSError("lost")
        return write(*args, **kwargs)

    monkeypatch.setattr(load, "write_clean", failing)
    more = raw | {"customers": put(tmp_path, "raw2/c", CUSTOMERS[:1])}
    with pytest.raises(OSError):
        load.load_tables(spark, **more, target=f"{tmp_path}/s")
    assert tables(spark, paths) == before
    monkeypatch.undo()
    load.load_tables(spark, **more, target=f"{tmp_path}/s")
    assert len(tables(spark, paths)["customers"]) == 1


def test_of_two_jobs_one_is_refused(spark, raw, tmp_path):
    store = f"{tmp_path}/s"
    paths = load.load_tables(spark, **raw, target=store)
    began = versions.current(spark, store)
    other = versions.commit(spark, store, began, {"customers": began.tables["customers"]})
    assert other.number == began.number + 1
    with pytest.raises(versions.Outdated):
        versions.commit(spark, store, began, {})
    assert versions.current(spark, store).number == other.number
    assert not [p for p in Path(store, "_versions").iterdir() if p.name.startswith(".") and not p.name.endswith(".crc")]
    assert len(tables(spark, paths)["customers"]) == 2


def test_old_versions_go(spark, raw, tmp_path):
    store = f"{tmp_path}/s"
    for _ in range(4):
        paths = load.load_tables(spark, **raw, target=store)
    assert len([p for p in Path(store, "_versions").iterdir() if p.suffix == ".json" and not p.name.startswith(".")]) == 2
    assert len(list(Path(paths["customers"]).glob("version=*"))) == 2
    assert len(tables(spark, paths)["transactions"]) == 3


def test_a_file_that_is_loaded_twice_counts_once(spark, raw, tmp_path):
    store, folder = f"{tmp_path}/s", f"{tmp_path}/raw/transactions"
    paths = load.load_tables(spark, **raw, target=store)
    first = tables(spark, paths)
    assert load.load_more(spark, folder, store) == 0
    assert tables(spark, paths) == first
    put(folder, "2", [*TRANSACTIONS, bought(10, 3), bought(11, 4, card="4211"), bought(10, 3), bought(12, 3, CARD="x")])
    assert load.load_more(spark, folder, store) == 3
    once = tables(spark, paths)
    assert load.load_more(spark, folder, store) == 0
    # Another name, the same records.
    put(folder, "3", [bought(10, 3), bought(11, 4, card="4211")])
    assert load.load_more(spark, folder, store) == 0
    assert tables(spark, paths) == once
    whole = load.load_tables(spark, **raw | {"transactions": put(tmp_path, "raw2/all", [*TRANSACTIONS, bought(10, 3), bought(11, 4, card="4211"), bought(12, 3, CARD="x")])}, target=f"{tmp_path}/whole")
    assert once == tables(spark, whole)
    # The second customer is idle no longer.
    assert rows(read_clean(spark, "customer_transactions", paths["customer_transactions"]).filter("TRANSACTION_ID is null")) == []


def test_other_months_stay_as_they_are(spark, raw, tmp_path):
    store = f"{tmp_path}/s"
    paths = load.load_tables(spark, **raw, target=store)
    files = {p: p.stat().st_mtime_ns for p in Path(paths["transactions"]).rglob("*.parquet")}
    assert load.load_more(spark, put(tmp_path, "more/2", [bought(20, 5)]), store) == 1
    after = {p: p.stat().st_mtime_ns for p in Path(paths["transactions"]).rglob("*.parquet")}
    assert files.items() <= after.items()
    assert {p.parent.name for p in after.keys() - files.keys()} == {"YEAR_MONTH=201802"}


def test_a_failed_addition_can_be_repeated(spark, raw, tmp_path, monkeypatch):
    store = f"{tmp_path}/s"
    paths = load.load_tables(spark, **raw, target=store)
    before, more = tables(spark, paths), put(tmp_path, "more/2", [bought(20, 5), bought(None, 6), bought(None, 6), bought(21, 6, DAY="x")])
    write = versions.commit

    def lost(*args):
        raise OSError("lost")

    monkeypatch.setattr(versions, "commit", lost)
    with pytest.raises(OSError):
        load.load_more(spark, more, store)
    assert tables(spark, paths) == before
    monkeypatch.setattr(versions, "commit", write)
    # Rows without id cannot be told apart.
    assert load.load_more(spark, more, store) == 3
    assert len(tables(spark, paths)["transactions"]) == 6
    with pytest.raises(ValueError, match="bad record in transactions"):
        load.load_more(spark, put(tmp_path, "more/3", [bought(22, 5, YEAR="x")]), store, fail_on_bad=True)


def test_what_cleaning_changes_is_listed(spark, raw, tmp_path):
    more = raw | {
        "customers": put(tmp_path, "odd/c", [CUSTOMERS[0], CUSTOMERS[1] | {"CUST_ZIP": "n/a"}]),
        "transactions": put(tmp_path, "odd/t", [bought(1, 1, value=1e30), bought(2, 1, value=0.125), bought(3, 1, value=0.5)]),
    }
    paths = load.load_tables(spark, **more, target=f"{tmp_path}/s")
    assert rows(spark.read.parquet(paths["rejected_zips"]), "SSN", "CUST_ZIP") == [(2, "n/a")]
    assert rows(spark.read.parquet(paths["rejected_amounts"]), "TRANSACTION_ID", "TRANSACTION_VALUE") == [(1, 1e30), (2, 0.125)]
    assert [r[0] for r in rows(read_clean(spark, "transactions", paths["transactions"]).filter("TRANSACTION_VALUE is null"), "TRANSACTION_ID")] == [1]
    for part in ("customers", "transactions"):
        with pytest.raises(ValueError, match="bad record in (zips|amounts)"):
            load.load_tables(spark, **raw | {part: more[part]}, target=f"{tmp_path}/strict", fail_on_bad=True)
    assert not Path(tmp_path, "strict").exists()


def test_reports_of_summaries_equal_those_of_the_transactions(spark, raw, tmp_path, plan_of):
    """Also after a load that adds; none of them scans the transactions."""
    store = f"{tmp_path}/s"
    paths = load.load_tables(spark, **raw, target=store)
    odd = [bought(30, 9, BRANCH_CODE=77), bought(None, 9), bought(31, 31), bought(32, 9, value=None), bought(33, 9, card=None, CUST_SSN=None)]
    assert load.load_more(spark, put(tmp_path, "more/2", odd), store) == 5
    every, branches, daily, cards = (read_clean(spark, n, f"{store}/{n}") for n in ("transactions", "branches", "daily_totals", "card_months"))
    with_branch = read_clean(spark, "branch_transactions", paths["branch_transactions"])
    of_branches = summaries.with_branches(daily, branches)
    for report, summary, direct in (
        (reports.type_counts, daily, every), (reports.top_type, daily, every), (reports.month_totals, daily, every), (reports.top_months, daily, every),
        (lookups.type_count_total_all, daily, every), (lambda t: lookups.type_count_total(t, "gas"), daily, every),
        (reports.customer_totals, cards, every), (reports.top_customers, cards, every), (lookups.monthly_bills_all, cards, every),
        (lambda t: lookups.monthly_bill(t, "4210", 2, 2018), cards, every), (reports.branch_totals_for_type, of_branches, with_branch),
        (lambda t: lookups.state_count_total(t, "ct"), of_branches, with_branch), (lambda t: lookups.branch_count_total_by_state(t, "ct"), of_branches, with_branch),
    ):
        assert rows(report(summary)) == rows(report(direct))
        assert "/transactions/" not in plan_of(report(summary)) and "branch_transactions" not in plan_of(report(summary))


def test_sums_of_sums_do_not_overflow(spark):
    large = spark.range(40).selectExpr("id AS TRANSACTION_ID", "'20180101' AS TIMEID", "'a' AS TRANSACTION_TYPE", "1 AS BRANCH_CODE", "cast(9999999999999999.99 as decimal(18,2)) AS TRANSACTION_VALUE")
    assert rows(lookups.type_count_total_all(summaries.daily_totals(large))) == rows(lookups.type_count_total_all(large)) == [("a", 40, 4e17)]


def edits(spark, *data):
    return spark.createDataFrame([(i, *d) for i, d in enumerate(data)], schemas.CUSTOMER_UPDATES)


def joined_again(spark, paths):
    return rows(
        join_customer_transactions(read_clean(spark, "customers", paths["customers"]), load.without_month(read_clean(spark, "transactions", paths["transactions"])))
    )


def stored_join(spark, paths):
    return rows(load.without_month(read_clean(spark, "customer_transactions", paths["customer_transactions"])))


def test_edits_reach_the_stored_join(spark, raw, tmp_path):
    store = f"{tmp_path}/s"
    paths = load.load_tables(spark, **raw, target=store)
    files = {p: p.stat().st_mtime_ns for p in Path(paths["customer_transactions"]).rglob("*.parquet")}
    assert not publish.publish_edits(spark, edits(spark, ("Alec", "O'Neil", "CUST_STATE", "Ohio")), store)
    for batch in (
        [("Alec", "O'Neil", "CUST_ZIP", "10001")],
        [("Zoe", "Idle", "CREDIT_CARD_NO", "4210"), ("Alec", "O'Neil", "CUST_CITY", "Bath")],
        [("Alec", "O'Neil", "CREDIT_CARD_NO", "9999"), ("Zoe", "Idle", "SSN", "123456789")],
        [("Alec", "O'Neil", "CREDIT_CARD_NO", "4210"), ("Zoe", "Idle", "CREDIT_CARD_NO", "4211")],
    ):
        assert publish.publish_edits(spark, edits(spark, *batch), store)
        assert stored_join(spark, paths) == joined_again(spark, paths)
    # A load that adds goes on from there.
    assert load.load_more(spark, put(tmp_path, "more/2", [bought(40, 9), bought(41, 9, card="4211", MONTH=7)]), store) == 2
    assert stored_join(spark, paths) == joined_again(spark, paths)
    assert files.items() <= {p: p.stat().st_mtime_ns for p in Path(paths["customer_transactions"]).rglob("*.parquet")}.items()
    load.join_tables(spark, paths)
    assert stored_join(spark, paths) == joined_again(spark, paths)


def test_one_edit_replaces_only_files_that_hold_its_card(spark, raw, tmp_path):
    store = f"{tmp_path}/a b%20c é"
    many = [bought(100 + k, 1, card=str(4210 + k % 2), MONTH=1 + k % 12) for k in range(24)]
    load.load_tables(spark, **raw | {"transactions": put(tmp_path, "many/t", many)}, target=store)
    assert publish.publish_edits(spark, edits(spark, ("Zoe", "Idle", "CUST_ZIP", "10001")), store)
    dropped = versions.current(spark, store).dropped["customer_transactions"]
    paths = {n: f"{store}/{n}" for n in ("customers", "transactions", "customer_transactions")}
    assert stored_join(spark, paths) == joined_again(spark, paths)
    # The second card has bought in every other month.
    assert sorted(f.split("YEAR_MONTH=")[1][:6] for f in dropped) == [f"2018{m:02d}" for m in range(2, 13, 2)]
