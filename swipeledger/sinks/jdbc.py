"""Tables into a relational database."""

from dataclasses import dataclass, field

from pyspark.sql import DataFrame

# The database tables that existing users query.
BRANCH_TABLE = "cdw_sapp_branch"
TRANSACTION_TABLE = "cdw_sapp_credit_card"
CUSTOMER_TABLE = "cdw_sapp_customer"
LOAN_TABLE = "cdw_sapp_loan_application"


@dataclass(frozen=True)
class Database:
    """Where to write. Credentials come from the caller and are not shown."""

    url: str
    user: str | None = field(default=None, repr=False)
    password: str | None = field(default=None, repr=False)
    driver: str | None = None
    connections: int = 16
    """Most tasks that write at a time; the database is the limit, not the cluster."""
    batch_rows: int = 10_000

    def options(self) -> dict[str, str]:
        given = {
            "url": self.url,
            "user": self.user,
            "password": self.password,
            "driver": self.driver,
            "numPartitions": str(self.connections),
            "batchsize": str(self.batch_rows),
        }
        return {name: value for name, value in given.items() if value is not None}


def write_jdbc(df: DataFrame, table: str, database: Database, mode: str = "append") -> None:
    """``append`` adds the rows again on a second load. ``overwrite`` empties the
    table but keeps its column types, and can be repeated.

    Spark commits each partition on its own: after the loss of an executor, an append
    may hold some partitions twice, so repeat such a load with ``overwrite``."""
    writer = df.write.format("jdbc").mode(mode).options(**database.options())
    if mode == "overwrite":
        writer = writer.option("truncate", "true")
    writer.option("dbtable", table).save()
