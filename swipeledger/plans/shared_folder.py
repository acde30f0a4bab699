"""A place for tables that all executors can reach."""

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


#: The innermost ``passing_folder`` that is open.
_passing: ContextVar[str | None] = ContextVar("passing", default=None)


def new_folder(spark: SparkSession) -> str:
    """A fresh path in the folder named by ``spark.checkpoint.dir``, or in the ``passing_folder`` that is open, with which it goes. Only a local
    session without that setting gets a temporary folder of this machine."""
    shared = _passing.get() or spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.conf.get("spark.master", "")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="swipeledger-")
    return f"{shared.rstrip('/')}/swipeledger-{uuid.uuid4().hex}"


@contextmanager
def passing_folder(spark: SparkSession) -> Iterator[str]:
    """A ``new_folder`` that is gone afterwards, also after a failure."""
    path = new_folder(spark)
    outer = _passing.set(path)
    try:
        yield path
    finally:
        _passing.reset(outer)
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)


def written(df: DataFrame, path: str | None = None) -> DataFrame:
    """``df`` written, to a ``new_folder`` if no path is given, and read again: what follows repeats none of its work, and Spark knows its size."""
    path = path or new_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
