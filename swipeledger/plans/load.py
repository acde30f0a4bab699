"""From raw JSON to stored clean and joined tables."""

from collections.abc import Mapping, Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField

from swipeledger import schemas
from swipeledger.functions.dates import year_month
from swipeledger.operators.cleaning import clean_branches, clean_customers, clean_transactions, rejected_amounts, rejected_zips
from swipeledger.operators.joins import branch_parts, customer_parts, join_branch_transactions  # noqa: F401 (part of this module's names)
from swipeledger.operators.summaries import card_months, daily_totals
from swipeledger.plans.shared_folder import passing_folder
from swipeledger.sinks import versions
from swipeledger.sinks.files import write_clean
from swipeledger.sinks.jdbc import (
    BRANCH_TABLE,
    CUSTOMER_TABLE,
    LOAN_TABLE,
    TRANSACTION_TABLE,
    Database,
    write_jdbc,
)
from swipeledger.sources.readers import file_states, read_clean, read_folders, read_loans, read_records

CUSTOMER_ORDER = ["LAST_NAME", "FIRST_NAME"]
JOIN_ORDER = ["CUST_ZIP", "LAST_NAME", "FIRST_NAME"]
#: Up to so many branches are sent to every task of the join, which spares the transactions the shuffle.
FEW_BRANCHES = 100_000

_JOINED = ("customer_transactions", "branch_transactions")
#: What is stored of transactions for reports that count and add.
_SUMMARIES = {"daily_totals": daily_totals, "card_months": card_months}
_RAW = {
    "customers": (schemas.CUSTOMER_RAW, clean_customers, CUSTOMER_ORDER),
    "branches": (schemas.BRANCH_RAW, clean_branches, []),
    "transactions": (schemas.TRANSACTION_RAW, clean_transactions, ["CREDIT_CARD_NO"]),
}


def load_tables(
    spark: SparkSession,
    customers: str,
    branches: str,
    transactions: str,
    target: str,
    database: Database | None = None,
    database_mode: str = "append",
    extra_fields: Mapping[str, Sequence[StructField]] | None = None,
    fail_on_bad: bool = False,
) -> dict[str, str]:
    """Cleans the three raw JSON inputs, stores them below ``target``, joins the
    stored tables and stores the joins. Each step reads what the step before has
    written, so a lost executor costs at most one step. All tables are new versions, which become valid together at the end; the versions
    before the last one are removed.

    All columns of the input are kept; ``extra_fields`` gives types to those that are not declared, by table. Records that
    cannot be read, or that hold a value of the wrong type, are stored as they came in ``rejected_<table>``; what cleaning changes,
    customers whose zip is missing or no number and transactions whose amount is no number of cents, in ``rejected_zips`` and ``rejected_amounts``. With
    ``fail_on_bad`` the load fails before it stores anything if there is any of these. Returns the path of
    every table."""
    extra = dict(extra_fields or {})
    paths = {name: f"{target}/{name}" for name in (*_RAW, *_JOINED, *_SUMMARIES)}
    paths |= {f"rejected_{name}": f"{target}/rejected_{name}" for name in (*_RAW, "zips", "amounts")}
    began = versions.current(spark, target)
    inputs = file_states(spark, transactions)
    with passing_folder(spark) as parsed_path:
        parsed = {}
        for name, source in (("customers", customers), ("branches", branches), ("transactions", transactions)):
            parsed[name] = read_records(spark, source, _RAW[name][0], extra.get(name, ()), parsed_path=f"{parsed_path}/{name}")
        changed = {"zips": rejected_zips(parsed["customers"].good), "amounts": rejected_amounts(parsed["transactions"].good)}
        if fail_on_bad:
            _fail_on({**{name: records.bad for name, records in parsed.items()}, **changed})
        new = {name: versions.new_version_folder(paths[name]) for name in _RAW}
        for name, (_, clean, order) in _RAW.items():
            write_clean(clean(parsed[name].good), new[name], sort_by=order)
            parsed[name].bad.write.mode("overwrite").parquet(paths[f"rejected_{name}"])
        for name, rows in changed.items():
            rows.write.mode("overwrite").parquet(paths[f"rejected_{name}"])
    stored = {name: read_folders(spark, schemas.CLEAN_TABLES[name].fields, paths[name], [new[name]]) for name in _RAW}
    joined = _write_joins(stored["customers"], stored["branches"], stored["transactions"], None, paths)
    joined |= _write_summaries(stored["transactions"], paths)
    ledger = _write_ledger(spark, target, inputs)
    versions.commit(spark, target, replace(began, ledgers=[]), {**{name: [f] for name, f in new.items()}, **joined}, [ledger])
    versions.remove_old(spark, target)
    if database is not None:
        for name, table in (
            ("branches", BRANCH_TABLE),
            ("transactions", TRANSACTION_TABLE),
            ("customers", CUSTOMER_TABLE),
        ):
            stored = read_clean(spark, name, paths[name], extra_fields=extra.get(name, ()))
            write_jdbc(without_month(stored), table, database, database_mode)
    return paths


def _fail_on(found: Mapping[str, DataFrame]) -> None:
    for name, rows in found.items():
        first = rows.first()
        if first is not None:
            raise ValueError(f"bad record in {name}: {first.asDict()}")


def load_more(
    spark: SparkSession,
    transactions: str | list[str],
    target: str,
    database: Database | None = None,
    extra_fields: Sequence[StructField] = (),
    fail_on_bad: bool = False,
) -> int:
    """Adds transactions to the tables that ``load_tables`` stored below ``target``, and to the joins. Returns how many were new.

    Of the files below ``transactions`` those that an earlier load has read, with this size and time of change, are left
    out; of the others' records those whose TRANSACTION_ID the table has, or that come again in them (the first by all columns is taken). So
    a load can be repeated, also after a failure, and files may overlap. Ids are looked for in the months that the new records have: a
    record that comes again has its day. Records without id cannot be recognised and are all taken.

    What is stored is not written again: new rows go to files of their own, in the months that they have, and both joins
    get the joined new rows, as the summaries get theirs; of the joins, the customers and branches that are still without transactions are found anew. All
    becomes valid at once. Rejects go to new folders of the ``rejected_`` tables. A ``database`` gets the new rows by ``append``."""
    paths = {name: f"{target}/{name}" for name in (*_RAW, *_JOINED, *_SUMMARIES)}
    began = versions.current(spark, target)
    files = _not_loaded(spark, file_states(spark, transactions), began)
    if not files:
        return 0
    layout, clean, order = _RAW["transactions"]
    with passing_folder(spark) as parsed_path:
        records = read_records(spark, [f for f, *_ in files], layout, extra_fields, parsed_path=f"{parsed_path}/parsed")
        amounts = rejected_amounts(records.good)
        if fail_on_bad:
            _fail_on({"transactions": records.bad, "amounts": amounts})
        known = read_clean(spark, "transactions", paths["transactions"], extra_fields=extra_fields)
        folder = versions.new_version_folder(paths["transactions"])
        write_clean(_not_known(clean(records.good), known), folder, sort_by=order)
        records.bad.write.mode("append").parquet(f"{target}/rejected_transactions")
        amounts.write.mode("append").parquet(f"{target}/rejected_amounts")
    declared = schemas.CLEAN_TABLES["transactions"].fields
    new = read_folders(spark, declared, paths["transactions"], [folder])
    n, tables = new.count(), {}
    if n:
        # Transactions are added only, so none of their files is ever dropped.
        every = [*began.tables["transactions"], folder]
        customers, branches = (read_clean(spark, name, paths[name]) for name in ("customers", "branches"))
        tables = _write_joins(customers, branches, read_folders(spark, declared, paths["transactions"], every), new, paths)
        # The parts of a join are its matched folders and, last, that of the idle ones.
        tables = {name: [*began.tables[name][:-1], *folders] for name, folders in tables.items()}
        tables |= {name: [*began.tables[name], *folders] for name, folders in _write_summaries(new, paths).items()}
        tables["transactions"] = every
    versions.commit(spark, target, began, tables, [_write_ledger(spark, target, files)])
    if database is not None and n:
        write_jdbc(without_month(new), TRANSACTION_TABLE, database, "append")
    return n


def _not_known(found: DataFrame, known: DataFrame) -> DataFrame:
    """The rows of ``found``, one for each id, whose id is not known in their months."""
    month = F.coalesce(year_month(F.col("TIMEID")), F.lit(""))
    # There are as many months as calendars have.
    months = [r[0] for r in found.select(month).distinct().collect()]
    there = known.filter(F.coalesce("YEAR_MONTH", F.lit("")).isin(months)) if None in months or "" in months else known.filter(F.col("YEAR_MONTH").isin(months))
    order = Window.partitionBy("TRANSACTION_ID").orderBy(*found.columns)
    named = found.filter(F.col("TRANSACTION_ID").isNotNull()).withColumn("_n", F.row_number().over(order)).filter("_n = 1").drop("_n")
    named = named.join(there.select("TRANSACTION_ID"), "TRANSACTION_ID", "left_anti").select(found.columns)
    return named.union(found.filter(F.col("TRANSACTION_ID").isNull()))


_LEDGER = "file string, size bigint, modified bigint"


def _write_ledger(spark: SparkSession, target: str, files: Sequence[tuple[str, int, int]]) -> str:
    folder = versions.new_version_folder(f"{target}/_ledger")
    spark.createDataFrame(list(files), _LEDGER).coalesce(1).write.parquet(folder)
    return folder


def _not_loaded(spark: SparkSession, files: Sequence[tuple[str, int, int]], began: versions.Version) -> list[tuple[str, int, int]]:
    """Those that no ledger names. The files of one load are as many as Spark lists for it."""
    if not began.ledgers:
        return list(files)
    loaded = spark.read.schema(_LEDGER).parquet(*began.ledgers)
    listed = spark.createDataFrame(list(files), _LEDGER)
    return sorted(tuple(r) for r in listed.join(loaded, ["file", "size", "modified"], "left_anti").collect())


def join_tables(spark: SparkSession, paths: Mapping[str, str]) -> None:
    """Stores both joins of the stored tables, as new versions. Run again after customers were
    edited."""
    store, _ = versions.split_path(paths["customer_transactions"])
    began = versions.current(spark, store)
    stored = (read_clean(spark, name, paths[name]) for name in ("customers", "branches", "transactions"))
    versions.commit(spark, store, began, _write_joins(*stored, None, paths))


def _write_joins(
    customers: DataFrame, branches: DataFrame, transactions: DataFrame, new: DataFrame | None, paths: Mapping[str, str]
) -> dict[str, list[str]]:
    """Both joins in new folders, by table: the ``new`` transactions (all, if there are none) with their owners, and the owners without any."""
    transactions, new = without_month(transactions), None if new is None else without_month(new)
    few = branches.count() <= FEW_BRANCHES
    # The transactions come from month folders; beside a broadcast they stay as they are.
    parts = {
        "customer_transactions": (customer_parts(customers, transactions, new), JOIN_ORDER, True),
        "branch_transactions": (branch_parts(F.broadcast(branches) if few else branches, transactions, new), ["BRANCH_STATE", "BRANCH_CODE"], not few),
    }
    folders = {}
    for name, ((matched, idle), order, rebalance) in parts.items():
        folders[name] = [versions.new_version_folder(paths[name]) for _ in range(2)]
        write_clean(matched, folders[name][0], sort_by=order, rebalance=rebalance)
        write_clean(idle, folders[name][1], sort_by=order)
    return folders


def load_loans(
    spark: SparkSession,
    loans: str,
    database: Database,
    database_mode: str = "append",
    extra_fields: Sequence[StructField] = (),
) -> None:
    """Landed loan applications, with all their columns, into the database. A record that cannot be read fails the load."""
    write_jdbc(read_loans(spark, loans, extra_fields), LOAN_TABLE, database, database_mode)


def _write_summaries(transactions: DataFrame, paths: Mapping[str, str]) -> dict[str, list[str]]:
    """The summaries of these transactions in new folders, by table."""
    folders = {name: [versions.new_version_folder(paths[name])] for name in _SUMMARIES}
    for name, summary in _SUMMARIES.items():
        summary(transactions).write.parquet(folders[name][0])
    return folders


def without_month(stored: DataFrame) -> DataFrame:
    """A stored table without the column that only names its folders."""
    return stored.drop("YEAR_MONTH")
