import contextlib
import io

import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[*]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def conf(spark):
    """Sets session options for one test."""
    before = {}

    def change(**options):
        for name, value in options.items():
            name = name.replace("__", ".")
            before.setdefault(name, spark.conf.get(name, None))
            spark.conf.set(name, value)

    yield change
    for name, value in before.items():
        if value is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, value)


@pytest.fixture
def plan_of():
    def text(df, mode="formatted"):
        out = io.StringIO()
        with contextlib.redirect_stdout(out):
            df.explain(mode)
        return out.getvalue()

    return text


def rows(df, *columns):
    """Rows as a sorted list of tuples."""
    return sorted(
        (tuple(r) for r in df.select(*(columns or df.columns)).collect()),
        key=lambda r: [(v is None, str(v)) for v in r],
    )
