import random

import fixtures
import pytest
from conftest import rows
from pyspark.sql import functions as F

from swipeledger import schemas
from swipeledger.operators import ownership, updates


@pytest.fixture(scope="module")
def customers(spark):
    return fixtures.customers(spark)


def edits(spark, *data):
    return spark.createDataFrame(
        [(seq, *name.split(" "), field, value) for seq, name, field, value in data],
        schemas.CUSTOMER_UPDATES,
    )


def after(customers, table, ssn, column):
    edited = updates.apply_updates(customers, table)
    assert edited.dtypes == customers.dtypes
    return rows(edited.filter(F.col("SSN") == ssn), column)[0][0]


@pytest.mark.parametrize(
    ("field", "value", "stored"),
    [
        ("CUST_PHONE", "(212)555-0000", "(212)555-0000"),
        ("CUST_EMAIL", "new@x.c", "new@x.c"),
        ("CREDIT_CARD_NO", "9999", "9999"),
        ("FULL_STREET_ADDRESS", "5 , Oak", "5 , Oak"),
        ("CUST_CITY", "Avon", "Avon"),
        ("CUST_STATE", "NY", "NY"),
        ("CUST_ZIP", "06001", 6001),
    ],
)
def test_each_field(spark, customers, field, value, stored):
    table = edits(spark, (1, "Etta Holman", field, value))
    assert after(customers, table, 100000004, field) == stored
    unchanged = [c for c in customers.columns if c != field]
    assert rows(updates.apply_updates(customers, table), *unchanged) == rows(customers, *unchanged)


def test_ssn(spark, customers):
    edited = updates.apply_updates(customers, edits(spark, (1, "Etta Holman", "SSN", "999999999")))
    assert rows(edited.filter("LAST_NAME = 'Holman'"), "SSN") == [(999999999,)]


@pytest.mark.parametrize(
    ("field", "value", "reason"),
    [
        ("CUST_STATE", "Ohio", "state must have 2 characters"),
        ("CUST_ZIP", "abc", "zip must be a whole number"),
        ("CUST_ZIP", "1.5", "zip must be a whole number"),
        ("SSN", "12345678", "SSN must have 9 digits"),
        ("SSN", "12345678x", "SSN must have 9 digits"),
        ("FAX", "1", "unknown field"),
        (None, "1", "unknown field"),
        ("FIRST_NAME", "Bob", "unknown field"),
        ("CUST_CITY", None, "missing value"),
    ],
)
def test_rejects(spark, customers, field, value, reason):
    table = edits(spark, (1, "Etta Holman", field, value))
    assert rows(updates.rejected_updates(customers, table), "seq", "reason") == [(1, reason)]
    assert rows(updates.apply_updates(customers, table)) == rows(customers)


def test_unknown_names(spark, customers):
    table = edits(spark, (1, "Etta Holman", "CUST_CITY", "Avon"), (2, "etta Holman", "CUST_CITY", "X"))
    assert rows(updates.unmatched_updates(customers, table), "seq") == [(2,)]
    assert rows(updates.match_updates(customers, table), "seq", "SSN") == [(1, 100000004)]
    assert rows(updates.rejected_updates(customers, table), "seq", "reason") == [(2, "name not found")]


def test_missing_names_match_nobody(spark, customers):
    table = spark.createDataFrame([(1, None, "Null", "CUST_CITY", "X")], schemas.CUSTOMER_UPDATES)
    assert rows(updates.rejected_updates(customers, table), "reason") == [("name not found",)]
    assert rows(updates.apply_updates(customers, table)) == rows(customers)


def test_an_account_without_ssn_cannot_be_edited(spark, customers):
    nameless = customers.limit(1).withColumn("SSN", F.lit(None).cast("bigint")).withColumn("FIRST_NAME", F.lit("No"))
    nameless = nameless.withColumn("LAST_NAME", F.lit("Number"))
    table = edits(spark, (1, "No Number", "CUST_CITY", "Avon"), (2, "No Number", "FAX", "1"))
    everyone = customers.union(nameless)
    assert rows(updates.rejected_updates(everyone, table), "seq", "reason") == [
        (1, "account has no SSN"),
        (2, "unknown field"),
    ]
    assert rows(updates.match_updates(everyone, table), "seq", "SSN") == [(1, None), (2, None)]
    assert rows(updates.apply_updates(everyone, table)) == rows(everyone)


def test_an_ssn_in_use_is_rejected(spark, customers):
    table = edits(
        spark,
        (1, "Etta Holman", "SSN", "100000001"),
        (2, "Mary-Ann O'Neil", "SSN", "900000009"),
        (3, "Etta Holman", "SSN", "900000009"),
        (4, "Zoe Null", "SSN", "100000005"),
    )
    assert rows(updates.rejected_updates(customers, table), "seq", "reason") == [
        (1, "SSN already in use"),
        (3, "SSN already in use"),
    ]
    edited = rows(updates.apply_updates(customers, table), "SSN")
    assert len(set(edited)) == 5 and (900000009,) in edited


@pytest.mark.parametrize("seed", range(2))
def test_every_edit_is_applied_or_rejected(spark, customers, seed):
    choose = random.Random(seed)
    values = ["NY", "06001", "abc", "900000001", "900000002", "100000001", "100000004", None]
    names = ["Alec Hooper", "Mary-Ann O'Neil", "Etta Holman", "Zoe Null", "No Body"]
    fields = [*updates.EDITABLE, "SSN", "SSN", "FAX"]
    table = edits(spark, *((k, choose.choice(names), choose.choice(fields), choose.choice(values)) for k in range(60)))
    rejected = {r.seq for r in updates.rejected_updates(customers, table).collect()}
    judged = [r for r in updates.judged_updates(customers, table).collect() if r.reason is None]
    last = {(r.SSN, r.field): r.seq for r in sorted(judged, key=lambda r: r.seq)}
    superseded = {r.seq for r in judged} - set(last.values())
    assert rejected | superseded | set(last.values()) == set(range(60))
    assert len(rejected) + len(judged) == 60
    edited = updates.apply_updates(customers, table)
    assert edited.select("SSN").distinct().count() == 5


def test_one_edit_does_not_shuffle_the_customers(spark, customers, tmp_path, plan_of):
    customers.write.parquet(f"{tmp_path}/customers")
    stored = spark.read.parquet(f"{tmp_path}/customers")
    edits(spark, (1, "Etta Holman", "CUST_CITY", "Avon")).write.parquet(f"{tmp_path}/edits")
    table = spark.read.parquet(f"{tmp_path}/edits")
    matched = updates.match_updates(stored, table)
    matched.collect()
    plan = plan_of(matched, "simple")
    assert "BroadcastHashJoin [FIRST_NAME" in plan and "LeftSemi, BuildRight" in plan


def test_shared_name_goes_to_the_lowest_ssn(spark, customers):
    table = edits(
        spark, (1, "Alec Hooper", "SSN", "900000000"), (2, "Alec Hooper", "CUST_CITY", "Avon")
    )
    edited = updates.apply_updates(customers, table).filter("LAST_NAME = 'Hooper'")
    assert rows(edited, "SSN", "CUST_CITY") == [(100000003, "Natchez"), (900000000, "Avon")]


def test_last_valid_edit_wins(spark, customers):
    table = edits(
        spark,
        (3, "Etta Holman", "CUST_STATE", "Ohio"),
        (1, "Etta Holman", "CUST_STATE", "NY"),
        (2, "Etta Holman", "CUST_STATE", "NJ"),
    )
    assert after(customers, table, 100000004, "CUST_STATE") == "NJ"


def one_by_one(customers, table):
    """The edits made in order on plain rows."""
    accounts = sorted((r.asDict() for r in customers.collect()), key=lambda r: r["SSN"])
    keys = [r["SSN"] for r in accounts]
    for edit in sorted(table.collect(), key=lambda r: r.seq):
        name = (edit.FIRST_NAME, edit.LAST_NAME)
        row = next((a for a in accounts if (a["FIRST_NAME"], a["LAST_NAME"]) == name), None)
        value = edit.new_value
        if row is None or edit.field not in updates.EDITABLE:
            continue
        if edit.field == "CUST_STATE" and len(value) != 2:
            continue
        if edit.field == "CUST_ZIP" and not value.isdigit():
            continue
        if edit.field == "SSN" and not (len(value) == 9 and value.isdigit()):
            continue
        row[edit.field] = int(value) if edit.field in ("CUST_ZIP", "SSN") else value
    assert len(keys) == len(accounts)
    return accounts


@pytest.mark.parametrize("seed", range(3))
def test_random_batch_equals_edits_one_by_one(spark, customers, seed):
    choose = random.Random(seed)
    names = ["Alec Hooper", "Mary-Ann O'Neil", "Etta Holman", "Zoe Null", "No Body"]
    data = [
        (
            seq,
            choose.choice(names),
            choose.choice([*updates.EDITABLE, "FAX"]),
            choose.choice(["NY", "06001", "abc", f"9{seq:08d}", f"text {seq}"]),
        )
        for seq in range(80)
    ]
    table = edits(spark, *data)
    expected = one_by_one(customers, table)
    assert rows(updates.apply_updates(customers, table)) == sorted(
        (tuple(r[c] for c in customers.columns) for r in expected),
        key=lambda r: [(v is None, str(v)) for v in r],
    )


def claims_one_by_one(claims, held):
    """Whether each claim succeeds, made in order on a plain table of owners."""
    owner = {s: s for s in held}
    has = {s: s for s in held}
    out = {}
    for at, account, wanted in sorted(set(claims)):
        out[at, account, wanted] = owner.get(wanted, account) == account
        if out[at, account, wanted]:
            owner.pop(has[account], None)
            owner[wanted], has[account] = account, wanted
    return out


@pytest.mark.parametrize("seed", range(2))
def test_ssns_change_hands_in_order(spark, seed):
    choose = random.Random(seed)
    held = list(range(1, 9))
    claims = [(choose.randrange(40), choose.choice(held if choose.random() < 0.6 else [1]), choose.randrange(1, 13)) for _ in range(50)]
    expected = claims_one_by_one(claims, held)
    table = spark.createDataFrame(claims, "at long, SSN long, wanted long")
    accounts = spark.createDataFrame([(s,) for s in [*held, None]], "SSN long")
    numbers, refused = ownership.judged_claims(table, accounts)
    never = {r.wanted for r in numbers.collect() if r.never_free}
    wrong = {tuple(r) for r in refused.collect()} | {c for c in expected if c[2] in never}
    assert wrong == {c for c, ok in expected.items() if not ok}
    assert {False, True} == set(expected.values())


def test_a_chain_of_claims_takes_its_rounds(spark):
    # Each account takes the number that the one before it has just given up; backwards in time, none could.
    table = spark.createDataFrame([(k, k, k - 1) for k in range(1, 8)], "at long, SSN long, wanted long")
    held = spark.createDataFrame([(k,) for k in range(1, 8)], "wanted long")
    assert {r.ok for r in ownership.verdicts(table, held).collect()} == {True}
    back = spark.createDataFrame([(-k, k, k - 1) for k in range(1, 8)], "at long, SSN long, wanted long")
    assert rows(ownership.verdicts(back, held).filter("ok"), "SSN") == [(1,)]


def test_a_number_given_up_earlier_is_free(spark, customers):
    table = edits(
        spark,
        (1, "Zoe Null", "SSN", "100000004"),
        (2, "Etta Holman", "SSN", "900000001"),
        (3, "Zoe Null", "SSN", "100000004"),
        (3, "Zoe Null", "SSN", "100000004"),
    )
    assert rows(updates.rejected_updates(customers, table), "seq", "reason") == [(1, "SSN already in use")]
    edited = updates.apply_updates(customers, table)
    assert rows(edited.filter("LAST_NAME IN ('Null', 'Holman')"), "SSN", "LAST_NAME") == [(100000004, "Null"), (900000001, "Holman")]


def test_claims_of_none(spark):
    empty = spark.createDataFrame([], "at long, SSN long, wanted long")
    numbers, refused = ownership.judged_claims(empty, spark.createDataFrame([(1,)], "SSN long"))
    assert numbers.count() == 0 and refused is None
