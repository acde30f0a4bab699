"""Mixing of sources to target weights: pivotal rounding of copy counts, up a tree of groups."""

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from swipeledger.llm.common import WORD, stored, uniform

#: The weights of the sources, by code point and repeating.
WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
#: How many roundings of a source's last open rows are tried.
TRIES = 64


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """One row per source: ``source``, ``source_size`` and ``target``.

    The sources share the sum of all sizes by weight, but none gets more than ``most`` times its
    size. All that are below that bound get the same amount per weight; this level is found
    from the sources in order of the level at which each reaches its bound. The windows see
    one row per source."""
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    ordered = F.array(*map(F.lit, weights))
    sources = sources.withColumn("weight", F.element_at(ordered, (rank % len(weights) + 1).cast("int")))
    sources = sources.withColumn("bound", most * F.col("source_size")).withColumn("full_at", F.col("bound") / F.col("weight"))
    by_level = Window.orderBy("full_at", F.col("source").asc_nulls_last())
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    all_rows = Window.partitionBy()
    spread = (
        sources.withColumn("total", F.sum("source_size").over(all_rows))
        .withColumn("open_weight", F.sum("weight").over(all_rows) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
        .withColumn("left", F.col("total") - F.coalesce(F.sum("bound").over(before), F.lit(0)))
        .withColumn("level", F.col("left") / F.col("open_weight"))
    )
    # The first source that the level of its rest does not fill is open, and so are all after it.
    level = F.min(F.when(F.col("full_at") > F.col("level"), F.struct("full_at", "level"))).over(all_rows)
    shared = F.least(F.col("bound").cast("double"), F.col("weight") * F.col("at")["level"])
    target = F.when(F.col("at").isNull() | (F.col("full_at") < F.col("at")["full_at"]), F.col("bound").cast("double")).otherwise(shared)
    return spread.withColumn("at", level).select("source", "source_size", target.alias("target"))


EDGE = 1e-9


def pivot(share: list[float], size: list[int], chance: list[float]) -> tuple[list[float], int]:
    """Rounds shares in (0, 1) in their order: of two open shares one becomes 0 or 1, and the words that it
    gains or loses are taken from or given to the other, by a chance under which both keep their
    expectation. The sum of share times size does not change. Returns the shares, and the place
    of the one that stays open, or -1. Rows without words are rounded by their chance."""
    share = list(share)
    held = -1
    for i, u in enumerate(chance):
        if not 0.0 < share[i] < 1.0:
            continue
        if not size[i]:
            share[i] = float(u < share[i])
            continue
        if held < 0:
            held = i
            continue
        p, q, m, n = share[held], share[i], size[held], size[i]
        up, down = min((1 - p) * m, q * n), min(p * m, (1 - q) * n)
        moved = up if u * (up + down) < down else -down
        p, q = p + moved / m, q - moved / n
        share[held], share[i] = (round(x) if x < EDGE or x > 1 - EDGE else x for x in (p, q))
        if 0 < share[i] < 1:
            held = i
        elif not 0 < share[held] < 1:
            held = -1
    return share, held


def settled(share: list[float], size: list[int], draw) -> list[float]:
    """All shares rounded: of ``TRIES`` random roundings the one whose words come nearest to what the shares amount to."""
    words = sum(p * n for p, n in zip(share, size))
    best = None
    for k in range(TRIES):
        chance = draw(k)
        tried, held = pivot(share, size, chance)
        if held >= 0:
            tried[held] = float(chance[held] < tried[held])
        off = abs(sum(p * n for p, n in zip(tried, size)) - words)
        if best is None or off < best[0]:
            best = off, tried
    return best[1]


def copies(documents: DataFrame, seed: int = 7, group_rows: int = 1024, fan_in: int = 64) -> DataFrame:
    """``documents`` (``source``, ``size`` and any columns that tell rows apart; simple types) with ``source_size``,
    ``target`` and ``copies``, the whole number of times that the mix takes the row.

    A row's copies are its source's target over its size: the whole part is certain, and the
    rest is a chance that is rounded within groups of about ``group_rows`` rows of one source and
    similar size, longest first, so that mass moves between rows of nearly the same size.
    What stays open, one row per group at most, goes up a tree: ``fan_in`` groups at a time, then
    the size class, then the source, whose last open rows, one per size class, are rounded
    ``TRIES`` times, and the nearest to the target is taken. A source of any size is thus many groups. The same rows give the same result."""
    columns = documents.columns
    # Stored, as the sizes go into the sums and into the rows.
    keyed = stored(
        documents.groupBy(*columns).agg(F.count("*").alias("repeats"))
        .withColumn("repeat", F.explode(F.sequence(F.lit(1), F.col("repeats").cast("int")))).drop("repeats")
        .withColumn("key", F.xxhash64(*columns, "repeat", F.lit(seed))).drop("repeat")
    )
    targets = source_targets(keyed)
    same = F.col("source").eqNullSafe(F.col("t_source"))
    targets = targets.withColumnRenamed("source", "t_source")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    shared = (
        keyed.join(targets, same).drop("t_source")
        .withColumn("copies", F.floor(rate).cast("long")).withColumn("share", rate - F.floor(rate))
        .withColumn("class", F.floor(2 * F.log2(F.col("size") + 1)).cast("int"))
    )
    # How many groups a size class of a source needs.
    classes = (
        shared.groupBy(F.col("source").alias("c_source"), F.col("class").alias("c_class")).agg(F.count("*").alias("n"))
        .withColumn("groups", F.ceil(F.col("n") / group_rows))
    ).drop("n")
    same_class = F.col("source").eqNullSafe(F.col("c_source")) & (F.col("class") == F.col("c_class"))
    open_rows = stored(
        shared.join(classes, same_class)
        .withColumn("group", F.pmod(F.xxhash64("key"), F.col("groups")))
        .drop("c_source", "c_class", "groups")
    )
    schema = open_rows.withColumn("open", F.lit(False)).schema

    def rounded(level: int, last: bool):
        def round_group(rows: pd.DataFrame) -> pd.DataFrame:
            rows = rows.sort_values(["size", "key"], ascending=False, ignore_index=True)
            keys = rows["key"].to_numpy(np.int64).view(np.uint64)
            draw = lambda k: uniform(seed + 1000 * level + k, keys).tolist()
            share, size, held = rows["share"].tolist(), rows["size"].tolist(), -1
            if last:
                share = settled(share, size, draw)
            else:
                share, held = pivot(share, size, draw(0))
            share = np.array(share)
            rows["copies"] += (share == 1.0).astype(np.int64)
            rows["share"] = np.where(share == 1.0, 0.0, share)
            rows["open"] = np.arange(len(rows)) == held
            return rows

        return round_group

    # The tree: groups of a class, bundles of groups, the class, the source.
    steps = [("group", F.floor(F.col("group") / fan_in)), ("group", F.lit(0).cast("long")), ("class", F.lit(0))]
    done = []
    for level in range(len(steps) + 1):
        last = level == len(steps)
        out = stored(open_rows.groupBy("source", "class", "group").applyInPandas(rounded(level, last), schema))
        done.append(out.where(~F.col("open")).drop("open"))
        if not last:
            name, value = steps[level]
            open_rows = out.where("open").drop("open").withColumn(name, value)
    result = done[0]
    for more in done[1:]:
        result = result.unionByName(more)
    return result.drop("key", "share", "class", "group")


def mixed_sizes(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source") -> DataFrame:
    """One row per document: ``doc_id``, ``size`` (its words), ``source_size``, ``target`` (its source's) and ``taken``,
    the words that the mix takes: the size times the copies, at most three times the size.

    A null or empty text has size 0 and nothing is taken of it, whatever its copies; null is a source of its own, the last.
    Repeated rows are rows of their own. A source without words has target 0. Other columns
    are left out; an empty table gives an empty result."""
    sized = documents.select(F.col(id_column).alias("doc_id"), F.col(source_column).alias("source"), size_of(F.col(text_column)).alias("size"))
    return copies(sized).select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def mixed(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source") -> DataFrame:
    """``documents`` as the mix takes them: every row as many times as it has copies, none to three times, with all its columns.

    Rows with equal id, source and text share the copies that such rows got together, as evenly as
    whole numbers allow. Null and empty texts are copied as their source's rate says."""
    text_id = F.md5(F.coalesce(F.col(f"`{text_column}`"), F.lit("")))
    keys = {"_m_id": F.col(f"`{id_column}`"), "_m_source": F.col(f"`{source_column}`"), "_m_text": text_id}
    sized = documents.select(
        F.col(f"`{id_column}`").alias("id"), F.col(f"`{source_column}`").alias("source"), size_of(F.col(f"`{text_column}`")).alias("size"), text_id.alias("text_id")
    )
    totals = copies(sized).groupBy("id", "source", "text_id").agg(F.sum("copies").alias("_m_copies"), F.count("*").alias("_m_rows"))
    keyed = documents.withColumns(keys)
    same = F.col("_m_id").eqNullSafe(F.col("id_")) & F.col("_m_source").eqNullSafe(F.col("source_")) & (F.col("_m_text") == F.col("text_id_"))
    totals = totals.select(F.col("id").alias("id_"), F.col("source").alias("source_"), F.col("text_id").alias("text_id_"), "_m_copies", "_m_rows").where("_m_copies > 0")
    number = F.row_number().over(Window.partitionBy(*keys).orderBy(*keys))
    rest = F.when(number <= F.col("_m_copies") % F.col("_m_rows"), 1).otherwise(0)
    taken = keyed.join(totals, same).withColumn("_m_times", (F.floor(F.col("_m_copies") / F.col("_m_rows")) + rest).cast("int"))
    repeated = taken.where("_m_times > 0").withColumn("_m_time", F.explode(F.sequence(F.lit(1), F.col("_m_times"))))
    return repeated.select(*[F.col(f"`{c}`") for c in documents.columns])
