"""JSON arrays without line breaks between records, read in many tasks.

A file is read in byte ranges, as pieces that end at closing braces; UTF-8 has that byte nowhere else. A piece, or a range, changes the state of the
reading: whether it is inside a string, and how deep. What it does to either state at its start is worked out without knowing that state, and
the ranges' changes are put together in the order of the file. Then every range knows its start, and records are cut where the
depth comes back to that of the array."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_RANGE = ["file", "block"]


def array_records(spark: SparkSession, files: Sequence[str]) -> DataFrame:
    """(text, whole, raw): the elements of the arrays in ``files``, one file each, without the commas and brackets around them. ``whole`` is false
    where an element is no object, or what follows the last whole one is more than the end of the array.

    The files are scanned twice: first only numbers leave the scan, a few per brace, then the pieces go once to the task of
    their range. A record may stretch over any number of ranges. A brace or quote that is missing spoils the rest of its file, as it does for
    any reader of such a file."""
    pieces = _pieces(spark, files)
    starts = _starts(pieces)
    reached = _after(pieces.join(starts, _RANGE), F.col("start_quoted"), F.col("start_depth"))
    # The last piece of a file ends where the file does, not at a brace.
    last = (F.col("block") == F.col("last_block")) & (F.lead("at").over(_in_range()).isNull()) & F.col("open_end")
    ends = ~F.col("quoted_after") & (F.col("depth_after") == 1) & ~F.coalesce(last, F.lit(False))
    marked = reached.withColumn("last", F.coalesce(last, F.lit(False))).withColumn("ends", ends)
    number = F.coalesce(F.sum(F.col("ends").cast("int")).over(_in_range().rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    part = F.struct("at", F.concat("value", F.when(F.col("last"), "").otherwise("}")).alias("text"))
    joined = F.array_join(F.transform(F.sort_array(F.collect_list("part")), lambda p: p["text"]), "")
    cut = marked.withColumn("number", number).withColumn("part", part).groupBy(*_RANGE, "first_block", "number").agg(joined.alias("text"), F.max("ends").alias("ends"))
    # Only the first part of a range can belong to a record that began before, and only its last to one that goes on.
    inside = cut.where(F.col("ends") & ((F.col("number") > 0) | (F.col("block") == F.col("first_block"))))
    outside = cut.where(~F.col("ends") | ((F.col("number") == 0) & (F.col("block") != F.col("first_block"))))
    before = Window.partitionBy("file").orderBy("block", "number").rowsBetween(Window.unboundedPreceding, -1)
    record = F.coalesce(F.sum(F.col("ends").cast("int")).over(before), F.lit(0)).alias("record")
    fragments = outside.select("file", record, "ends", F.struct("block", "number", "text").alias("part"))
    crossing = fragments.groupBy("file", "record").agg(joined.alias("text"), F.max("ends").alias("ends"))
    found = inside.select("text", "ends").unionByName(crossing.select("text", "ends"))
    text = F.regexp_replace("text", r"^\s*[\[,]?\s*", "")
    found = found.select(text.alias("text"), "ends", F.trim("text").alias("raw"))
    found = found.where(F.col("ends") | ~F.col("text").rlike(r"^\s*\]?\s*$"))
    return found.select("text", (F.col("ends") & F.col("text").startswith("{")).alias("whole"), "raw")


def _in_range():
    return Window.partitionBy(*_RANGE).orderBy("at")


def _pieces(spark: SparkSession, files: Sequence[str]) -> DataFrame:
    """(file, block, at, value, size, quotes, plain, quoted): the text before each closing brace, its range, its place in there, the size of
    the file; whether it has an odd number of quotes; and how much deeper it leads, without that brace, if it begins
    outside a string, and if it begins inside one."""
    meta = F.col("_metadata")
    pieces = spark.read.text(list(files), lineSep="}").select(
        meta["file_path"].alias("file"), meta["file_block_start"].alias("block"), meta["file_size"].alias("size"),
        F.monotonically_increasing_id().alias("at"), "value",
    )
    # A backslash and what it stands before are no part of the structure.
    parts = F.split(F.regexp_replace("value", r"(?s)\\.", ""), '"')

    def depth(odd: int) -> Column:
        text = F.array_join(F.filter("parts", lambda _, i: i % 2 == odd), "")
        return sum(sign * (F.length(text) - F.length(F.replace(text, F.lit(c)))) for c, sign in (("{", 1), ("[", 1), ("]", -1)))

    return pieces.withColumn("parts", parts).select(
        *_RANGE, "at", "size", "value", (F.size("parts") % 2 == 0).alias("quotes"), depth(0).alias("plain"), depth(1).alias("quoted")
    )


def _after(pieces: DataFrame, start_quoted: Column, start_depth: Column) -> DataFrame:
    """``pieces`` with the state after each, ``quoted_after`` and ``depth_after``, its brace included, if their range starts in this state."""
    upto = _in_range().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seen = F.sum(F.col("quotes").cast("int")).over(upto)
    out = pieces.withColumn("quoted_after", (seen + start_quoted.cast("int")) % 2 == 1)
    quoted_before = F.col("quoted_after") != F.col("quotes")
    change = F.when(quoted_before, F.col("quoted")).otherwise(F.col("plain")) - (~F.col("quoted_after")).cast("int")
    return out.withColumn("change", change).withColumn("depth_after", start_depth + F.sum("change").over(upto))


def _starts(pieces: DataFrame) -> DataFrame:
    """(file, block, start_quoted, start_depth, first_block, last_block, open_end) of each range. What a range does is one row, whatever its
    size; the rows of a file are put together in order."""
    numbers = pieces.withColumn("bytes", F.octet_length("value") + 1).drop("value")
    both = None
    for quoted, name in ((False, "from_plain"), (True, "from_quoted")):
        changed = _after(numbers if both is None else both, F.lit(quoted), F.lit(0))
        both = changed.withColumn(name, F.col("change")).drop("quoted_after", "change", "depth_after")
    ranges = both.groupBy(*_RANGE).agg(
        F.sum(F.col("quotes").cast("int")).alias("quotes"), F.sum("from_plain").alias("from_plain"), F.sum("from_quoted").alias("from_quoted"),
        F.sum("bytes").alias("bytes"), F.first("size").alias("size"),
    )
    whole = Window.partitionBy("file")
    before = whole.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    quoted = F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1
    change = F.when(F.col("start_quoted"), F.col("from_quoted")).otherwise(F.col("from_plain"))
    placed = ranges.withColumn("start_quoted", quoted).withColumn("change", change)
    return placed.select(
        *_RANGE, "start_quoted", F.coalesce(F.sum("change").over(before), F.lit(0)).alias("start_depth"),
        F.min("block").over(whole).alias("first_block"), F.max("block").over(whole).alias("last_block"),
        (F.sum("bytes").over(whole) != F.col("size")).alias("open_end"),
    )
