"""Raw JSON and stored tables.

Raw input is read record by record, whatever form a file has: JSON Lines, arrays on one line, arrays with a
record per line, and indented arrays of any indent, which the beginning of each file tells. Large files of all
forms are split across tasks. All values are read as text and cast, so a value of the wrong
type or a broken record spoils that record only (in an array on one line, what follows it too), and none is lost: what
cannot be read is in ``bad``. The input is parsed once, into a table in the shared folder, from which
good and bad rows and the names of all columns are taken."""

import re
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import Any, NamedTuple
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from swipeledger import schemas
from swipeledger.plans.shared_folder import new_folder
from swipeledger.sinks.versions import FOLDER, parts_of, within
from swipeledger.sources.json_stream import array_records

CORRUPT = "_corrupt_record"
BAD_COLUMNS = "bad_columns"


def read_customers(spark: SparkSession, path: str, extra_fields: Sequence[StructField] = ()) -> DataFrame:
    """All columns of the input: the declared ones, ``extra_fields`` with their types, any other as
    text. A record that cannot be read fails the job; so it is for the next three."""
    return strictly(read_records(spark, path, schemas.CUSTOMER_RAW, extra_fields))


def read_branches(spark: SparkSession, path: str, extra_fields: Sequence[StructField] = ()) -> DataFrame:
    return strictly(read_records(spark, path, schemas.BRANCH_RAW, extra_fields))


def read_transactions(spark: SparkSession, path: str, extra_fields: Sequence[StructField] = ()) -> DataFrame:
    return strictly(read_records(spark, path, schemas.TRANSACTION_RAW, extra_fields))


def read_loans(spark: SparkSession, path: str, extra_fields: Sequence[StructField] = ()) -> DataFrame:
    return strictly(read_records(spark, path, schemas.LOAN_APPLICATION, extra_fields))


def read_clean(
    spark: SparkSession,
    table: str,
    path: str,
    file_format: str = "parquet",
    extra_fields: Sequence[StructField] = (),
) -> DataFrame:
    """A table written by ``write_clean``. Stored transactions come with the
    ``YEAR_MONTH`` they are partitioned by. JSON may have any of the raw forms and is read with all its columns; a record that
    cannot be read fails the job (``read_records`` with a layout of ``CLEAN_TABLES`` gives good and bad ones)."""
    if file_format == "json":
        return strictly(read_records(spark, path, schemas.CLEAN_TABLES[table], extra_fields))
    declared = [*schemas.CLEAN_TABLES[table].fields, *extra_fields]
    if file_format != "parquet":
        return spark.read.schema(StructType(declared)).format(file_format).load(path)
    return read_folders(spark, declared, path, *parts_of(spark, path))


def read_folders(
    spark: SparkSession, declared: Sequence[StructField], path: str, folders: Sequence[str], dropped: Sequence[str] = ()
) -> DataFrame:
    """The stored table at ``path`` that these folders (or files) make up without the ``dropped`` files, with the further columns that it
    came with."""
    reader = spark.read if list(folders) == [path] else spark.read.option("basePath", path)
    known, month = {f.name for f in declared}, StructField("YEAR_MONTH", StringType())
    try:
        # The last folder may lack columns that an older one has.
        stored = list(reader.option("mergeSchema", str(len(folders) > 1).lower()).parquet(*folders).schema)
    except AnalysisException as error:
        if error.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        # A table by months that has no rows has no files.
        stored = []
    extras = [f for f in stored if f.name not in (*known, month.name, FOLDER)]
    layout = [*declared, *extras, *([month] if "TIMEID" in known else [])]
    if dropped:
        gone, files = {within(f) for f in dropped}, reader.schema(StructType(layout)).parquet(*folders).inputFiles()
        folders = [unquote(f) for f in files if within(f) not in gone] or folders[-1:]
    return reader.schema(StructType(layout)).parquet(*folders).drop(FOLDER)


class PermissiveRead(NamedTuple):
    good: DataFrame
    """Rows whose values all have the declared types."""
    bad: DataFrame
    """The others, all columns as text, with the names of the offending columns
    in ``bad_columns`` and an unreadable record in ``_corrupt_record``."""


class Records(NamedTuple):
    """Records of raw input, parsed once."""

    rows: DataFrame
    """A row per record: all columns as text, ``bad_columns``, ``_corrupt_record`` and whether it is ``_good``."""
    layout: StructType
    """The columns with the types that good rows have."""

    @property
    def checked(self) -> DataFrame:
        return self.rows.drop(_GOOD)

    def typed(self, rows: DataFrame) -> DataFrame:
        return rows.select(*(F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in self.layout))

    @property
    def good(self) -> DataFrame:
        return self.typed(self.rows.filter(_GOOD))

    @property
    def bad(self) -> DataFrame:
        return self.rows.filter(f"NOT {_GOOD}").drop(_GOOD)


def read_permissive(
    spark: SparkSession, path: str, layout: StructType, extra_fields: Sequence[StructField] = (), keep_undeclared: bool = True
) -> PermissiveRead:
    """Good and bad records of JSON files that may hold values of the wrong type."""
    records = read_records(spark, path, layout, extra_fields, keep_undeclared)
    return PermissiveRead(records.good, records.bad)


def strictly(records: Records) -> DataFrame:
    """The good rows; a bad record fails the job when it is met."""
    shown = F.coalesce(F.col(CORRUPT), F.concat_ws(", ", BAD_COLUMNS))
    met = F.when(F.col(_GOOD), True).otherwise(F.raise_error(F.concat(F.lit("bad record: "), shown)).cast("boolean"))
    return records.typed(records.rows.filter(met))


def read_records(
    spark: SparkSession,
    path: str | list[str],
    layout: StructType,
    extra_fields: Sequence[StructField] = (),
    keep_undeclared: bool = True,
    parsed_path: str | None = None,
) -> Records:
    """The records of all files below ``path`` (or several), with the columns of ``layout`` and ``extra_fields`` and, as text, every
    other column that any record has. The input is parsed here and now, into ``parsed_path`` or a fresh folder of the shared one;
    the records are read from there. Declared values are stored as columns and judged then, once; only others stay in a map, whose names are those of
    the further columns."""
    parsed_path = parsed_path or new_folder(spark)
    declared = StructType([*layout.fields, *extra_fields])
    stored = _columns(_parsed(_pieces(spark, path)), declared)
    stored.write.parquet(parsed_path)
    parsed, more = spark.read.schema(stored.schema).parquet(parsed_path), []
    if keep_undeclared:
        names = parsed.select(F.explode(F.map_keys(_OTHERS)).alias("name")).distinct()
        more = sorted(r["name"] for r in names.collect() if r["name"] not in (CORRUPT, BAD_COLUMNS))
    values = [F.col(_value(i)).alias(f.name) for i, f in enumerate(declared)]
    values += [F.element_at(_OTHERS, n).alias(n) for n in more]
    bad = F.coalesce(BAD_COLUMNS, F.array().cast(ArrayType(StringType()))).alias(BAD_COLUMNS)
    return Records(parsed.select(*values, CORRUPT, bad, _GOOD), StructType([*declared.fields, *(StructField(n, StringType()) for n in more)]))


#: Whether a stored record is good, by which row groups are skipped, and its values that are not declared.
_GOOD, _OTHERS = "_good", "_others"


def _value(i: int) -> str:
    return f"_value_{i}"


def _columns(parsed: DataFrame, declared: StructType) -> DataFrame:
    """The values of the ``parsed`` records as columns by their place in ``declared``, the others, and the verdict; what is empty is null."""
    known = F.array(*(F.lit(f.name) for f in declared)).cast(ArrayType(StringType()))
    others = F.map_filter("record", lambda name, _: ~F.array_contains(known, name))
    others = F.when(F.size(F.array_except(F.map_keys("record"), known)) > 0, others)
    rows = parsed.select(*(F.element_at("record", f.name).alias(_value(i)) for i, f in enumerate(declared)), others.alias("others"), CORRUPT)
    offending = F.array_compact(F.array(*(_offends(_value(i), f) for i, f in enumerate(declared)))).cast(ArrayType(StringType()))
    rows = rows.withColumn("offending", offending)
    values = [_value(i) for i in range(len(declared))]
    return rows.select(
        *values, F.col("others").alias(_OTHERS), CORRUPT, F.when(F.size("offending") > 0, F.col("offending")).alias(BAD_COLUMNS),
        ((F.size("offending") == 0) & F.col(CORRUPT).isNull()).alias(_GOOD),
    )


def _offends(value: str, field: StructField) -> Column:
    return F.when(F.col(value).isNotNull() & F.col(value).try_cast(field.dataType).isNull(), field.name)


def _pieces(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(text, whole, raw): JSON texts of one or more records, without the commas and brackets around them;
    not ``whole`` where the text cannot be what the file's form demands; and what stands in the file.

    An indented array is cut where its records begin: at a line break, the indent of its first record and a
    brace. A line break cannot occur inside a JSON text, so this is no part of a value. Only where the indent is
    nothing at all can an object within a record look like one; that record then is bad."""
    by_form: dict[str | None, list[str]] = {}
    for file, form in _forms(spark, path):
        by_form.setdefault(form, []).append(file)
    pieces = []
    for form, files in by_form.items():
        if form == ON_ONE_LINE:
            pieces.append(array_records(spark, files))
            continue
        if form is None:
            lines = spark.read.text(path if len(by_form) == 1 else files).select(F.trim(F.rtrim("value", F.lit(_SPACE))).alias("v"))
            lines = lines.filter(~F.col("v").isin("", "[", "]", "],", "[]"))
            text = F.when(F.endswith("v", F.lit(",")), F.expr("left(v, length(v) - 1)")).otherwise(F.col("v"))
            pieces.append(lines.select(F.ltrim(text, F.lit(_SPACE)).alias("text"), F.lit(True).alias("whole"), F.col("v").alias("raw")))
            continue
        parts = spark.read.text(files, lineSep=f"\n{form}{{").filter(~F.col("value").rlike(r"^\s*\[\s*$"))
        end = F.locate(f"\n{form}}}", F.col("value"))
        size = len(form) + 2
        body = F.concat(F.lit("{"), F.col("value").substr(F.lit(1), end + size - 1))
        rest = F.col("value").substr(end + size, F.length("value"))
        whole = (end > 0) & rest.rlike(r"^\s*[,\]]?\s*$")
        pieces.append(parts.select(F.when(whole, body).otherwise(F.col("value")).alias("text"), whole.alias("whole"), F.concat(F.lit("{"), "value").alias("raw")))
    if not pieces:
        return spark.range(0).select(F.lit("").alias("text"), F.lit(True).alias("whole"), F.lit("").alias("raw"))
    out = pieces[0]
    for more in pieces[1:]:
        out = out.unionByName(more)
    return out


#: White space around lines.
_SPACE = " \t\n\x0b\f\r"

#: The form of a file whose array begins with a record on the line of its bracket.
ON_ONE_LINE = "["
#: How much of a file is looked at for its form, and how many files at a time.
HEAD, AT_ONCE = 1 << 16, 32


def _forms(spark: SparkSession, path: str | list[str]) -> Iterator[tuple[str, str | None]]:
    """The files below ``path``, as Spark lists them, each with its form: the indent of an indented array, ``ON_ONE_LINE``, or none for
    records that are whole lines. Only the beginning of each file is read, many at a time."""

    def head(files, at, conf) -> str:
        stream = files.open(at)
        try:
            codec = spark._jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(at)
            return bytes((codec.createInputStream(stream) if codec else stream).readNBytes(HEAD)).decode("utf-8", "ignore")
        finally:
            stream.close()

    for file, begin in _of_each_file(spark, path, head):
        yield file, form_of(begin)


def file_states(spark: SparkSession, path: str | list[str]) -> list[tuple[str, int, int]]:
    """The files below ``path``, as Spark lists them, with their size and time of change."""

    def state(files, at, conf) -> tuple[int, int]:
        status = files.getFileStatus(at)
        return status.getLen(), status.getModificationTime()

    return [(file, *found) for file, found in _of_each_file(spark, path, state)]


def _of_each_file(spark: SparkSession, path: str | list[str], ask: Callable) -> list[tuple[str, Any]]:
    conf, jvm = spark._jsparkSession.sessionState().newHadoopConf(), spark._jvm

    def of(file: str) -> Any:
        at = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(file))
        return ask(at.getFileSystem(conf), at, conf)

    files = spark.read.text(path).inputFiles()
    with ThreadPoolExecutor(AT_ONCE) as pool:
        return list(zip(map(unquote, files), pool.map(of, files)))


def form_of(head: str) -> str | None:
    """The form of a file that begins like this."""
    array = re.match(r"\ufeff?\s*\[(\s*)\{([ \t\r]*\n)?", head)
    if array is None:
        return None
    if "\n" not in array[1]:
        return ON_ONE_LINE
    return array[1].rsplit("\n", 1)[1] if array[2] else None


def _parsed(pieces: DataFrame) -> DataFrame:
    """(record, _corrupt_record): a map per record, or the text that is none. The text is parsed inside one more pair of
    brackets, because what follows a complete JSON text would be overlooked."""
    array = F.when(F.col("text").startswith("["), F.col("text")).otherwise(F.concat(F.lit("["), "text", F.lit("]")))
    parsed = F.from_json(F.concat(F.lit("["), array, F.lit("]")), "array<array<map<string,string>>>")
    usable = F.col("whole") & (F.size("all") == 1) & ~F.exists(F.col("all")[0], lambda r: r.isNull())
    none = F.array(F.lit(None).cast("map<string,string>"))
    records = pieces.withColumn("all", parsed).withColumn("ok", F.coalesce(usable, F.lit(False)))
    return records.select(F.explode(F.when(F.col("ok"), F.col("all")[0]).otherwise(none)).alias("record"), F.when(~F.col("ok"), F.col("raw")).alias(CORRUPT))
