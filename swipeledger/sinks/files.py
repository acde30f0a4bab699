"""Clean and joined tables as parquet (the stored form) or JSON Lines (for
exchange)."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from swipeledger.functions.dates import year_month


#: Columns that lookups ask for by one value: a scan skips the row groups whose filter has not the value.
LOOKED_UP = ("LAST_NAME", "CREDIT_CARD_NO")


def write_clean(
    df: DataFrame,
    path: str,
    file_format: str = "parquet",
    mode: str = "overwrite",
    sort_by: Sequence[str] = (),
    rebalance: bool = True,
) -> None:
    """Parquet tables with a TIMEID get one folder per month.

    They are rebalanced by month first: adaptive execution gives a month that holds
    much of the data many tasks, and joins small months into one, so files come
    out of even size and their number does not grow with the number of input
    tasks. A table whose tasks hold few months each, as one that was read from such folders, needs no
    ``rebalance``. ``sort_by`` orders the rows: within the files of a month, or over the whole of
    a table without months, so that scans skip row groups."""
    if file_format == "json":
        # Spark leaves null fields out unless told otherwise.
        df.write.mode(mode).option("ignoreNullFields", "false").json(path)
        return
    by_month = "TIMEID" in df.columns
    if by_month:
        df = df.withColumn("YEAR_MONTH", year_month(F.col("TIMEID")))
        df = df.hint("rebalance", "YEAR_MONTH") if rebalance else df
        df = df.sortWithinPartitions("YEAR_MONTH", *sort_by)
    elif sort_by:
        df = df.repartitionByRange(*sort_by).sortWithinPartitions(*sort_by)
    writer = df.write.mode(mode).format(file_format)
    for column in LOOKED_UP:
        if file_format == "parquet" and column in df.columns:
            writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
    if by_month:
        writer = writer.partitionBy("YEAR_MONTH")
    writer.save(path)
