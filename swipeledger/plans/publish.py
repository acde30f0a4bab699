"""Account edits into the stored customer table and the database."""

from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField

from swipeledger import schemas
from swipeledger.operators.joins import customer_parts
from swipeledger.operators.lookups import NAME
from swipeledger.operators.updates import accepted_accounts, change_accounts
from swipeledger.plans.load import CUSTOMER_ORDER, JOIN_ORDER
from swipeledger.plans.shared_folder import passing_folder, written
from swipeledger.sinks import versions
from swipeledger.sinks.files import write_clean
from swipeledger.sinks.jdbc import CUSTOMER_TABLE, Database, write_jdbc
from swipeledger.sources.readers import read_clean, read_folders

#: The stored join that edits of customers change.
JOIN = "customer_transactions"


def publish_customers(
    spark: SparkSession,
    current: str,
    updates: DataFrame,
    target: str,
    database: Database | None = None,
    extra_fields: Sequence[StructField] = (),
) -> str:
    """Writes the edited customers of ``current`` to ``target``, a new folder, and
    from there to the database. Returns the path of the table that is valid now:
    ``current`` if no edit was accepted, in which case neither is written.

    The accepted edits are worked out once and written, and their stored size tells Spark whether they can
    be broadcast; a small batch then does not shuffle the customers. What was written of them is removed at the end."""
    customers = read_clean(spark, "customers", current, extra_fields=extra_fields)
    with passing_folder(spark) as passing:
        accepted = written(accepted_accounts(customers, updates), f"{passing}/accepted")
        if accepted.isEmpty():
            return current
        write_clean(change_accounts(customers, accepted), target, mode="errorifexists", sort_by=CUSTOMER_ORDER)
    if database is not None:
        edited = read_clean(spark, "customers", target, extra_fields=extra_fields)
        write_jdbc(edited, CUSTOMER_TABLE, database, mode="overwrite")
    return target


def publish_edits(spark: SparkSession, updates: DataFrame, target: str, database: Database | None = None) -> bool:
    """Applies edits to the customers that ``load_tables`` stored below ``target`` and to their join, as one new version; and to the database.
    Returns whether any edit was accepted; if none was, nothing is written.

    The customers are written anew. Of the join, only files are that hold a card whose owner's card or zip changed, or that an account gets: their
    other rows are kept, and the rows of these cards are joined again, from the transactions of these cards alone. Names cannot be edited, and
    no other column of the join is of the customers. Customers without transactions are found anew. The names of the files that
    are replaced come to the driver, as all names of files do when the table is read."""
    paths = {name: f"{target}/{name}" for name in ("customers", "transactions", JOIN)}
    began = versions.current(spark, target)
    customers, transactions, joined = (read_clean(spark, name, path) for name, path in paths.items())
    with passing_folder(spark) as passing:
        accepted = written(accepted_accounts(customers, updates), f"{passing}/accepted")
        if accepted.isEmpty():
            return False
        new = versions.new_version_folder(paths["customers"])
        write_clean(change_accounts(customers, accepted), new, sort_by=CUSTOMER_ORDER)
        edited = read_folders(spark, schemas.CLEAN_TABLES["customers"].fields, paths["customers"], [new])
        tables, dropped = {"customers": [new]}, {}
        moved = accepted.filter("new_CUST_ZIP IS NOT NULL OR new_CREDIT_CARD_NO IS NOT NULL")
        before = customers.join(moved, [*NAME, "SSN"], "left_semi").select("CREDIT_CARD_NO")
        cards = before.union(moved.select("new_CREDIT_CARD_NO")).filter("CREDIT_CARD_NO IS NOT NULL").distinct()
        cards = written(cards, f"{passing}/cards")
        if not cards.isEmpty():
            held = joined.select("CREDIT_CARD_NO", F.col("_metadata.file_path").alias("file")).join(cards, "CREDIT_CARD_NO", "left_semi")
            files = [unquote(r["file"]) for r in held.select("file").distinct().collect()]
            columns = schemas.CLEAN_TABLES[JOIN].fieldNames()
            matched, _ = customer_parts(
                edited.join(cards, "CREDIT_CARD_NO", "left_semi"), transactions.join(cards, "CREDIT_CARD_NO", "left_semi")
            )
            rows = matched.select(columns)
            if files:
                kept = read_folders(spark, schemas.CLEAN_TABLES[JOIN].fields, paths[JOIN], files).join(cards, "CREDIT_CARD_NO", "left_anti")
                rows = rows.unionByName(kept.select(columns))
            _, idle = customer_parts(edited, transactions)
            folders = [versions.new_version_folder(paths[JOIN]) for _ in range(2)]
            write_clean(rows, folders[0], sort_by=JOIN_ORDER)
            write_clean(idle, folders[1], sort_by=JOIN_ORDER)
            tables[JOIN], dropped[JOIN] = [*began.tables[JOIN][:-1], *folders], files
    versions.commit(spark, target, began, tables, dropped=dropped)
    if database is not None:
        write_jdbc(read_clean(spark, "customers", paths["customers"]), CUSTOMER_TABLE, database, mode="overwrite")
    return True

