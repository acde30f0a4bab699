"""Versions of stored tables that lie in one folder.

A table is a list of folders below its path, without the files that are dropped of them. What a job writes goes to new folders, and becomes valid, for all tables at once, by
one rename of a small file to the next number in ``_versions`` beside the tables. So a job that fails on the way changes nothing, readers
see one version of all tables, and of two jobs that began with the same version, one is refused."""

import json
import uuid
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

_VERSIONS = "_versions"
#: Names the folders of a table; as a partition column, so that several can be read as one.
FOLDER = "version"


class Outdated(Exception):
    """Another job has stored a newer version meanwhile."""


@dataclass(frozen=True)
class Version:
    """``number`` is 0 if there is none. ``tables``: the folders of each table. ``ledgers``: folders that name the input files that were loaded.
    ``dropped``: files in the folders of a table that are no part of it any more."""

    number: int = 0
    tables: Mapping[str, list[str]] = field(default_factory=dict)
    ledgers: list[str] = field(default_factory=list)
    dropped: Mapping[str, list[str]] = field(default_factory=dict)


def split_path(path: str) -> tuple[str, str]:
    """The folder that tables lie in, and the name of one."""
    store, _, name = path.rstrip("/").rpartition("/")
    return store or ".", name


def new_version_folder(path: str) -> str:
    return f"{path.rstrip('/')}/{FOLDER}={uuid.uuid4().hex}"


def current(spark: SparkSession, store: str) -> Version:
    numbers = _numbers(spark, store)
    return _read(spark, store, max(numbers)) if numbers else Version()


def parts_of(spark: SparkSession, path: str) -> tuple[list[str], list[str]]:
    """The folders of a table, and the files that are dropped of them; the path itself if it has no versions."""
    store, name = split_path(path)
    version = current(spark, store)
    return version.tables.get(name) or [path], version.dropped.get(name) or []


def within(file: str) -> str:
    """The folder and the rest of a file's path, which is the same however Spark writes what stands before."""
    return unquote(file)[unquote(file).index(f"/{FOLDER}=") :]


def commit(
    spark: SparkSession,
    store: str,
    began: Version,
    tables: Mapping[str, Iterable[str]],
    ledgers: Iterable[str] = (),
    dropped: Mapping[str, Iterable[str]] | None = None,
) -> Version:
    """The next version after ``began``: its tables, with the folders of some of them replaced, its ledgers with more of them, and more files
    ``dropped`` of some tables. Raises ``Outdated`` if there is a newer one."""
    every = {**began.tables, **{n: list(f) for n, f in tables.items()}}
    gone = {n: [*began.dropped.get(n, ()), *(dropped or {}).get(n, ())] for n in every}
    # Of folders that have gone themselves nothing has to be named.
    gone = {n: [f for f in files if any(folder.rsplit("/", 1)[1] in f.split("/") for folder in every[n])] for n, files in gone.items()}
    version = Version(began.number + 1, every, [*began.ledgers, *ledgers], {n: f for n, f in gone.items() if f})
    files, folder = _files(spark, store), f"{store}/{_VERSIONS}"
    draft, final = _path(spark, f"{folder}/.{uuid.uuid4().hex}"), _path(spark, f"{folder}/{version.number:012d}.json")
    stream = files.create(draft, False)
    stream.write(bytearray(json.dumps({"tables": version.tables, "ledgers": version.ledgers, "dropped": version.dropped}).encode()))
    stream.close()
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.makeQualified(draft).toUri(), _conf(spark))
    try:
        context.rename(draft, final, spark._sc._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 0))
    except Py4JJavaError as error:
        files.delete(draft, False)
        if files.exists(final):
            raise Outdated(f"{store} has a version {version.number} already") from error
        raise
    return version


def remove_old(spark: SparkSession, store: str, keep: int = 2) -> None:
    """Removes all but the newest ``keep`` versions and the folders that only older ones have. Whoever still reads an older version loses it."""
    numbers, files = sorted(_numbers(spark, store)), _files(spark, store)
    kept = {f for n in numbers[-keep:] for v in [_read(spark, store, n)] for fs in [*v.tables.values(), v.ledgers] for f in fs}
    for number in numbers[:-keep]:
        old = _read(spark, store, number)
        for folder in {f for fs in [*old.tables.values(), old.ledgers] for f in fs} - kept:
            files.delete(_path(spark, folder), True)
        files.delete(_path(spark, f"{store}/{_VERSIONS}/{number:012d}.json"), False)


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _conf(spark: SparkSession):
    return spark._jsparkSession.sessionState().newHadoopConf()


def _files(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(_conf(spark))


def _numbers(spark: SparkSession, store: str) -> list[int]:
    folder = _path(spark, f"{store}/{_VERSIONS}")
    files = folder.getFileSystem(_conf(spark))
    if not files.exists(folder):
        return []
    names = (status.getPath().getName() for status in files.listStatus(folder))
    return [int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith(".")]


def _read(spark: SparkSession, store: str, number: int) -> Version:
    stream = _files(spark, store).open(_path(spark, f"{store}/{_VERSIONS}/{number:012d}.json"))
    try:
        content = json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()
    return Version(number, content["tables"], content["ledgers"], content.get("dropped", {}))
