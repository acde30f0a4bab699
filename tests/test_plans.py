import json
from pathlib import Path

import fixtures
import pytest
from conftest import rows
from pyspark.sql.types import StringType, StructField

from swipeledger import schemas
from swipeledger.operators import lookups, reports
from swipeledger.plans import load, publish
from swipeledger.plans.shared_folder import new_folder
from swipeledger.sinks.files import write_clean
from swipeledger.sinks.jdbc import Database
from swipeledger.sources.readers import read_clean

CUSTOMERS = [
    {"SSN": 1, "FIRST_NAME": "ALEC", "MIDDLE_NAME": "WM", "LAST_NAME": "o'neil", "CREDIT_CARD_NO": "4210",
     "APT_NO": "6", "STREET_NAME": "Main", "CUST_CITY": "Avon", "CUST_STATE": "CT", "CUST_COUNTRY": "US",
     "CUST_ZIP": "06511", "CUST_PHONE": 1237818, "CUST_EMAIL": "a@x.c", "LAST_UPDATED": "2018-04-21"},
    {"SSN": 2, "FIRST_NAME": "zoe", "MIDDLE_NAME": "B", "LAST_NAME": "IDLE", "CREDIT_CARD_NO": "4211",
     "APT_NO": "7", "STREET_NAME": "Elm", "CUST_CITY": "Avon", "CUST_STATE": "CT", "CUST_COUNTRY": "US",
     "CUST_ZIP": "06001", "CUST_PHONE": 1237819, "CUST_EMAIL": "z@x.c", "LAST_UPDATED": "2018-04-22"},
]
BRANCHES = [
    {"BRANCH_CODE": 1, "BRANCH_STATE": "CT", "BRANCH_PHONE": "1234565276", "BRANCH_ZIP": 6511},
    {"BRANCH_CODE": 2, "BRANCH_STATE": "MS", "BRANCH_PHONE": "1234565277", "BRANCH_ZIP": None},
]
TRANSACTIONS = [
    {"TRANSACTION_ID": i, "CREDIT_CARD_NO": "4210", "CUST_SSN": 1, "BRANCH_CODE": 1, "TRANSACTION_TYPE": kind,
     "TRANSACTION_VALUE": value, "DAY": day, "MONTH": month, "YEAR": 2018}
    for i, (kind, value, day, month) in enumerate(
        [("Healthcare", 0.1, 1, 2), ("Healthcare", 0.2, 14, 2), ("Gas", 5.0, 31, 12)]
    )
]


@pytest.fixture(scope="module")
def raw(tmp_path_factory):
    folder = tmp_path_factory.mktemp("raw")
    paths = {}
    for name, data in [("customers", CUSTOMERS), ("branches", BRANCHES), ("transactions", TRANSACTIONS)]:
        Path(folder, f"{name}.json").write_text("\n".join(map(json.dumps, data)))
        paths[name] = f"{folder}/{name}.json"
    return paths


@pytest.fixture
def loads(monkeypatch):
    """What would be written to the database; none is started here."""
    said = []

    def record(df, table, database, mode="append"):
        said.append((table, mode, df.columns, df.count()))

    monkeypatch.setattr(load, "write_jdbc", record)
    monkeypatch.setattr(publish, "write_jdbc", record)
    return said


@pytest.fixture
def paths(spark, raw, tmp_path):
    return load.load_tables(spark, **raw, target=f"{tmp_path}/stored")


def test_load_then_ask(spark, paths):
    customers = read_clean(spark, "customer_transactions", paths["customer_transactions"])
    branches = read_clean(spark, "branch_transactions", paths["branch_transactions"])
    assert rows(customers, "LAST_NAME", "CREDIT_CARD_NO", "TIMEID", "YEAR_MONTH") == [
        ("Idle", None, None, None),
        ("O'Neil", "4210", "20180201", "201802"),
        ("O'Neil", "4210", "20180214", "201802"),
        ("O'Neil", "4210", "20181231", "201812"),
    ]
    found = lookups.transactions_by_zip_month(customers, 6511, "02", "2018")
    assert [r.TIMEID for r in found.collect()] == ["20180214", "20180201"]
    found = lookups.transactions_between(customers, "Alec", "O'Neil", "20180214", "20181231")
    assert [r.TIMEID for r in found.collect()] == ["20181231", "20180214"]
    assert rows(lookups.state_count_total(branches, "ct")) == [(3, 5.3)]
    assert rows(reports.branch_totals_for_type(branches)) == [(1, 0.3, True)]


def test_stored_lookups_read_one_month(spark, paths, plan_of):
    customers = read_clean(spark, "customer_transactions", paths["customer_transactions"])
    plan = plan_of(lookups.transactions_by_zip_month(customers, 6511, "02", "2018"))
    assert "PartitionFilters: [isnotnull(YEAR_MONTH" in plan
    assert "EqualTo(CUST_ZIP,6511)" in plan
    assert "Join" not in plan


def test_load_can_be_repeated(spark, raw, paths, tmp_path):
    again = load.load_tables(spark, **raw, target=f"{tmp_path}/stored")
    assert again == paths
    assert read_clean(spark, "transactions", paths["transactions"]).count() == 3


def test_rejects_are_stored_beside_the_tables(spark, raw, tmp_path):
    bad = f"{tmp_path}/bad.json"
    Path(bad).write_text(json.dumps([*CUSTOMERS, CUSTOMERS[0] | {"SSN": "x"}], indent=3))
    paths = load.load_tables(spark, **raw | {"customers": bad}, target=f"{tmp_path}/s")
    assert read_clean(spark, "customers", paths["customers"]).count() == 2
    assert rows(spark.read.parquet(paths["rejected_customers"]), "SSN", "bad_columns") == [("x", ["SSN"])]
    assert spark.read.parquet(paths["rejected_transactions"]).count() == 0
    with pytest.raises(ValueError, match="bad record in customers"):
        load.load_tables(spark, **raw | {"customers": bad}, target=f"{tmp_path}/strict", fail_on_bad=True)
    assert not Path(tmp_path, "strict").exists()


def test_nothing_is_left_in_the_shared_folder(spark, raw, tmp_path):
    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(shared.glob("*"))
    paths = load.load_tables(spark, **raw, target=f"{tmp_path}/s")
    table = edits(spark, (1, "Alec", "O'Neil", "CUST_CITY", "Avon"))
    publish.publish_customers(spark, paths["customers"], table, f"{tmp_path}/v2")
    with pytest.raises(Exception):
        publish.publish_customers(spark, paths["customers"], table, f"{tmp_path}/v2")
    assert set(shared.glob("*")) == before


def test_stored_branch_join_shuffles_no_transactions(spark, paths, plan_of):
    branches = read_clean(spark, "branches", paths["branches"])
    transactions = load.without_month(read_clean(spark, "transactions", paths["transactions"]))
    plan = plan_of(load.join_branch_transactions(load.F.broadcast(branches), transactions))
    assert "BroadcastHashJoin" in plan and "rebalance" not in plan.lower()


def test_state_total_scans_the_transactions_once(spark, paths, plan_of):
    branches = read_clean(spark, "branches", paths["branches"])
    transactions = read_clean(spark, "transactions", paths["transactions"])
    joined = load.join_branch_transactions(branches, transactions)
    plan = plan_of(lookups.state_count_total(joined, "ct"), "simple")
    assert plan.count("FileScan") == 2


def test_extra_fields_reach_the_store_and_the_database(spark, raw, tmp_path, loads):
    extra = {"customers": [StructField("LAST_UPDATED", StringType())]}
    paths = load.load_tables(
        spark, **raw, target=f"{tmp_path}/s", database=Database("jdbc:x"), extra_fields=extra
    )
    stored = read_clean(spark, "customers", paths["customers"])
    assert rows(stored, "SSN", "LAST_UPDATED") == [(1, "2018-04-21"), (2, "2018-04-22")]
    assert [(table, mode, n) for table, mode, _, n in loads] == [
        ("cdw_sapp_branch", "append", 2),
        ("cdw_sapp_credit_card", "append", 3),
        ("cdw_sapp_customer", "append", 2),
    ]
    assert loads[1][2] == schemas.TRANSACTION_CLEAN.fieldNames()
    assert "LAST_UPDATED" in loads[2][2]


def test_loans_to_the_database(spark, tmp_path, loads):
    Path(tmp_path, "l.json").write_text(json.dumps([{"Gender": "Male", "Application_ID": "LP1"}, {"Gender": "Female"}]))
    load.load_loans(spark, f"{tmp_path}/l.json", Database("jdbc:x"))
    assert [(t, m, n) for t, m, _, n in loads] == [("cdw_sapp_loan_application", "append", 2)]
    assert loads[0][2] == [*schemas.LOAN_APPLICATION.fieldNames(), "Application_ID"]


def edits(spark, *data):
    return spark.createDataFrame(list(data), schemas.CUSTOMER_UPDATES)


def test_publish_writes_a_new_table_and_the_database(spark, tmp_path, loads):
    current, target = f"{tmp_path}/v1", f"{tmp_path}/v2"
    write_clean(fixtures.customers(spark), current)
    table = edits(spark, (1, "Etta", "Holman", "CUST_CITY", "Avon"))
    assert publish.publish_customers(spark, current, table, target, Database("jdbc:x")) == target
    assert rows(read_clean(spark, "customers", target).filter("SSN = 100000004"), "CUST_CITY") == [("Avon",)]
    assert rows(read_clean(spark, "customers", current).filter("SSN = 100000004"), "CUST_CITY") == [("Hartford",)]
    assert [(t, m, n) for t, m, _, n in loads] == [("cdw_sapp_customer", "overwrite", 5)]


def test_publish_writes_nothing_without_an_accepted_edit(spark, tmp_path, loads):
    current, target = f"{tmp_path}/v1", f"{tmp_path}/v2"
    write_clean(fixtures.customers(spark), current)
    table = edits(spark, (1, "Etta", "Holman", "CUST_STATE", "Ohio"), (2, "No", "Body", "CUST_CITY", "X"))
    assert publish.publish_customers(spark, current, table, target, Database("jdbc:x")) == current
    assert not Path(target).exists() and loads == []


def test_joins_follow_an_edit(spark, paths, tmp_path):
    table = edits(spark, (1, "Alec", "O'Neil", "CUST_ZIP", "10001"))
    target = f"{tmp_path}/edited"
    paths = {**paths, "customers": publish.publish_customers(spark, paths["customers"], table, target)}
    load.join_tables(spark, paths)
    joined = read_clean(spark, "customer_transactions", paths["customer_transactions"])
    assert rows(joined.filter("CREDIT_CARD_NO = '4210'"), "CUST_ZIP") == [(10001,)] * 3


class Session:
    """A session that only has settings."""

    def __init__(self, **settings):
        self.conf = self
        self.settings = settings

    def get(self, name, default=None):
        return self.settings.get(name.replace(".", "_"), default)


def test_shared_folder_is_the_one_the_session_names(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = new_folder(spark), new_folder(spark)
    assert first.startswith(f"{shared}/") and first != second
    assert new_folder(Session(spark_master="yarn", spark_checkpoint_dir="s3a://b/c/")).startswith(
        "s3a://b/c/swipeledger-"
    )


def test_machine_folder_only_in_a_local_session():
    assert new_folder(Session(spark_master="local[2]")).startswith("/")
    for master in ("yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            new_folder(Session(spark_master=master))
