import datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from swipeledger.functions import dates, money, text

LETTERS = "abzABZéÉñÑüÜøØłŁçÇдДжЖωΩßﬁﬀǆǅǄǰİıᾳΐ"
NAMES = st.text(alphabet=LETTERS + "'-_ .,09\t’中", max_size=12)


def one(spark, values, kind, expression):
    df = spark.createDataFrame([(v,) for v in values], f"v {kind}")
    return [r[0] for r in df.select(expression(F.col("v"))).collect()]


@settings(max_examples=15, deadline=None)
@given(names=st.lists(NAMES, min_size=50, max_size=50))
def test_title_case_is_that_of_python(spark, names):
    assert one(spark, names, "string", text.title_case) == [n.title() for n in names]


def test_title_case_of_known_names(spark):
    names = ["ALEC", "o'neil mary-ann", "a_b", "mcdonald 3rd", "", None, "ßa", "ﬁn", "ǆx", "İstanbul"]
    assert one(spark, names, "string", text.title_case) == [
        "Alec", "O'Neil Mary-Ann", "A_B", "Mcdonald 3Rd", "", None, "Ssa", "Fin", "ǅx", "İstanbul",
    ]


def test_street_address(spark):
    df = spark.createDataFrame([("656", "Main St"), (None, "Elm"), ("1", None)], "a string, s string")
    got = [r[0] for r in df.select(text.street_address(F.col("a"), F.col("s"))).collect()]
    assert got == ["656 , Main St", None, None]


def test_local_phone(spark):
    got = one(spark, [1237818, None, 12378189, 12], "bigint", text.local_phone)
    assert got == ["(516)123-7818", None, "(516)123-78189", "(516)12-"]
    got = one(spark, [1237818], "bigint", lambda c: text.local_phone(c, "212"))
    assert got == ["(212)123-7818"]


def test_full_phone(spark):
    got = one(spark, ["1234565276", None, "12345"], "string", text.full_phone)
    assert got == ["(123)456-5276", None, "(123)45-"]


def test_zip_number(spark):
    got = one(spark, ["06511", " 6511 ", "abc", "6511.0", "", None], "string", text.zip_number)
    assert got == [6511, 6511, None, None, None, None]


def test_zip_text(spark):
    assert one(spark, [6511, 39120, None], "int", text.zip_text) == ["06511", "39120", "00000"]
    got = one(spark, [None], "int", lambda c: text.zip_text(c, "99999"))
    assert got == ["99999"]


def test_timeid(spark):
    df = spark.createDataFrame([(2018, 2, 1), (2018, 12, 31), (None, 1, 1)], "y int, m int, d int")
    value = dates.timeid(F.col("y"), F.col("m"), F.col("d"))
    assert [r[0] for r in df.select(value).collect()] == ["20180201", "20181231", None]


def test_timeid_date(spark):
    got = one(spark, ["20180214", "20180231", "2018", None], "string", dates.timeid_date)
    assert got == [datetime.date(2018, 2, 14), None, None, None]


@given(day=st.dates(datetime.date(1, 1, 1), datetime.date(9999, 12, 31)))
def test_month_key_matches_timeid(day):
    timeid = f"{day.year:04d}{day.month:02d}{day.day:02d}"
    assert dates.month_key(day.year, day.month) == timeid[:6]
    assert dates.month_key(timeid[:4], timeid[4:6]) == timeid[:6]


def test_date_parts(spark):
    for part, expected in [
        (dates.year_text, "2018"),
        (dates.month_text, "02"),
        (dates.day_text, "14"),
        (dates.year_month, "201802"),
    ]:
        assert one(spark, ["20180214", None], "string", part) == [expected, None]


def test_sums_are_exact(spark):
    df = spark.createDataFrame([(0.10,), (0.20,), (None,)], "v double")
    assert df.agg(money.exact_total(F.col("v")).cast("string")).first()[0] == "0.30"
    assert df.limit(0).agg(money.exact_total(F.col("v")).cast("string")).first()[0] == "0.00"


def test_percent(spark):
    df = spark.createDataFrame([(1, 4), (0, 3), (2, 0)], "a bigint, b bigint")
    got = [r[0] for r in df.select(money.percent(F.col("a"), F.col("b"))).collect()]
    assert got == [pytest.approx(25.0), 0.0, None]
