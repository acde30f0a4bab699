"""Joins in which one key may hold much of the rows."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_ROWS = 1_000_000
#: How many keys are salted at most: what is broadcast has this bound.
HOT_KEYS = 10_000


def join_unique(
    left: DataFrame, right: DataFrame, keys: list[str], how: str, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Joins ``left``, where a key (or null) may be very common, to ``right``, where every
    key occurs once. The result is that of the plain join on ``keys``.

    Rows with a null key match nothing; they go past the join. ``right`` comes out of an aggregate here, and behind an
    aggregate Spark's own skew handling does not apply. So keys with more than ``hot_rows`` rows are counted out
    first and salted: their rows take one of several shares, of about ``hot_rows``
    each, by the input partition they come from (the same number when a lost task runs
    again), and the one row of ``right`` is repeated per share. The most common keys, ``HOT_KEYS`` at most, are
    broadcast; any further ones are joined like all other keys."""
    has_null = reduce(lambda a, b: a | b, (F.col(k).isNull() for k in keys))
    keyed = left.filter(~has_null)
    hot = F.broadcast(
        keyed.groupBy(*keys)
        .agg(F.ceil(F.count("*") / hot_rows).cast("int").alias("shares"))
        .filter(F.col("shares") > 1)
        .orderBy(F.desc("shares"))
        .limit(HOT_KEYS)
    )
    share = F.when(F.col("shares") > 1, F.pmod(F.spark_partition_id(), "shares")).otherwise(0)
    every_share = F.explode(F.sequence(F.lit(0), F.coalesce("shares", F.lit(1)) - 1))
    salted = keyed.join(hot, keys, "left").withColumn("share", share).drop("shares")
    repeated = right.join(hot, keys, "left").withColumn("share", every_share).drop("shares")
    return _with_nulls(salted.join(repeated, [*keys, "share"], how).drop("share"), left.filter(has_null), how)


def _with_nulls(joined: DataFrame, without_key: DataFrame, how: str) -> DataFrame:
    if how not in ("left", "left_anti"):
        return joined
    return joined.unionByName(without_key, allowMissingColumns=True)


def join_account(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """The plain join of ``left``, where a key may be very common, to ``right``, where every key occurs once and which comes out of
    an aggregate by the same keys. Nothing is counted or repeated.

    Spark splits a hot partition of ``left`` at run time only if both sides come straight from a shuffle for this join, and an aggregate by the
    keys spares it. As one value, the keys are no longer those of the aggregate; ``right``, a row per key, is shuffled once
    more. Rows with a null key match nothing; a hash of the row, which ``right`` never has, spreads them."""
    has_null = reduce(lambda a, b: a | b, (F.col(k).isNull() for k in keys))
    spread = F.when(has_null, F.xxhash64(*left.columns).bitwiseOR(F.lit(1))).otherwise(F.lit(0)).cast("long")
    one = left.withColumn("_key", F.struct(*keys, spread.alias("_spread")))
    other = right.withColumn("_key", F.struct(*keys, F.lit(0).cast("long").alias("_spread"))).drop(*keys)
    return one.join(other, "_key", how).drop("_key")
