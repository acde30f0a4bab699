"""Arrays on one line, cut into records over any number of byte ranges."""

import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from swipeledger import schemas
from swipeledger.sources import readers
from swipeledger.sources.json_stream import array_records

RECORDS = [
    {"SSN": 1, "FIRST_NAME": 'a "quoted\\" }, {"SSN": 9} ] name', "NOTE": {"a": [{"b": "}"}, {}], "c": {"d": {}}}},
    {},
    {"SSN": 2, "FIRST_NAME": "\\\\", "\\\"}": "é€𝄞 {", "NOTE": [[], [{}]]},
    {"SSN": 3, "FIRST_NAME": "", "LAST": "\u007d\\u007d \n tab\t"},
]


@pytest.fixture
def ranges(conf):
    def of(size):
        conf(
            spark__sql__files__maxPartitionBytes=str(size), spark__sql__files__openCostInBytes="1",
            spark__sql__files__minPartitionNum="1", spark__sql__shuffle__partitions="4",
        )

    return of


def read(spark, folder):
    """The records of each file below the folder, by file, without the order; all have to be whole."""
    out = {}
    for path in folder.iterdir():
        found = array_records(spark, [str(path)]).collect()
        assert all(r["whole"] for r in found)
        out[path.name] = sorted(json.dumps(json.loads(r["text"]), sort_keys=True) for r in found)
    return out


def as_text(records):
    return sorted(json.dumps(r, sort_keys=True) for r in records)


@pytest.mark.parametrize("ascii", [True, False])
def test_every_split_point(spark, tmp_path, ranges, ascii):
    """The array moves by a byte from file to file, so that the bounds of ranges fall on every byte of it."""
    text = json.dumps(RECORDS, ensure_ascii=ascii, separators=(",", ":"))
    size = 37
    for k in range(size):
        (tmp_path / f"{k}.json").write_text("[" + " " * k + text[1:])
    ranges(size)
    found = array_records(spark, [str(tmp_path)]).collect()
    assert all(r["whole"] for r in found)
    assert sorted(as_text(RECORDS) * size) == sorted(json.dumps(json.loads(r["text"]), sort_keys=True) for r in found)


values = st.recursive(
    st.none() | st.booleans() | st.integers(-9, 9) | st.text(alphabet='a"\\{}[],:é\n', max_size=6),
    lambda inner: st.lists(inner, max_size=3) | st.dictionaries(st.text(alphabet='k"\\}{', max_size=3), inner, max_size=3),
    max_leaves=6,
)
documents = st.lists(st.dictionaries(st.text(alphabet='k"\\}{', max_size=3), values, max_size=3), max_size=5)


@settings(max_examples=5, deadline=None)
@given(st.lists(documents, min_size=4, max_size=12), st.integers(8, 60))
def test_any_documents(spark, tmp_path_factory, many, size):
    folder = tmp_path_factory.mktemp("any")
    for k, records in enumerate(many):
        (folder / f"{k}.json").write_text(json.dumps(records))
    keep = {c: spark.conf.get(c) for c in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        found = array_records(spark, [str(folder)]).collect()
    finally:
        for c, v in keep.items():
            spark.conf.set(c, v)
    assert all(r["whole"] for r in found)
    assert as_text(r for records in many for r in records) == sorted(json.dumps(json.loads(r["text"]), sort_keys=True) for r in found)


def test_a_line_is_read_in_many_tasks(spark, tmp_path, ranges):
    records = [{"SSN": i, "FIRST_NAME": f"name {i} }},{{"} for i in range(3000)]
    (tmp_path / "c.json").write_text(json.dumps(records))
    ranges(4096)
    assert spark.read.text(str(tmp_path), lineSep="}").rdd.getNumPartitions() > 20
    df = readers.read_customers(spark, str(tmp_path))
    assert [tuple(r) for r in df.selectExpr("count(*)", "sum(SSN)", "max(FIRST_NAME)").collect()] == [(3000, sum(range(3000)), "name 999 },{")]


def test_a_record_longer_than_many_ranges(spark, tmp_path, ranges):
    records = [{"SSN": 1}, {"SSN": 2, "NOTE": [{"x": "}" * 50}] * 40}, {"SSN": 3}]
    (tmp_path / "c.json").write_text(json.dumps(records))
    ranges(100)
    assert read(spark, tmp_path) == {"c.json": as_text(records)}


@pytest.mark.parametrize(
    ("text", "good"),
    [
        ('[{"SSN": 1}, {"SSN": 2}', [1, 2]),
        ('[{"SSN": 1}, {"SSN": 2', [1]),
        ('[{"SSN": 1}, {"SSN": "2}, {"SSN": 3}]', [1]),
        ('[{"SSN": 1}, 7, {"SSN": 2}]', [1]),
        ('[{"SSN": 1}, {"SSN": 2}] x', [1, 2]),
        ('[{"SSN": 1},\n{"SSN": 2}\n]\n', [1, 2]),
        ("[{}]", [None]),
    ],
)
def test_what_is_broken_is_bad(spark, tmp_path, ranges, text, good):
    (tmp_path / "c.json").write_text(text)
    ranges(9)
    found = readers.read_permissive(spark, str(tmp_path), schemas.CUSTOMER_RAW)
    assert sorted((r["SSN"] for r in found.good.collect()), key=str) == good
    whole = text.strip().endswith("]") and "7" not in text and '"2}' not in text
    assert (found.bad.count() == 0) == (whole or text.endswith("2}"))
    assert "Python" not in "".join(readers.read_permissive(spark, str(tmp_path), schemas.CUSTOMER_RAW).good._jdf.queryExecution().toString())


@pytest.mark.parametrize(
    ("head", "form"),
    [
        ("", None), ("[]", None), ('{"a": 1}\n', None), ('[\n{"a": 1},\n', None), ("[\n  {\n", "  "), ("[\r\n\t{\r\n", "\t"),
        ('[{"a"', "["), ('\ufeff [ {"a"', "["), ("[\n{\n", ""), ("[1, {", None),
    ],
)
def test_forms(head, form):
    assert readers.form_of(head) == form


def test_names_of_files_may_have_any_letters(spark, tmp_path):
    folder = tmp_path / "a b%20c é"
    folder.mkdir()
    for name, indent in (("x y.json", None), ("50%.json", 2)):
        (folder / name).write_text(json.dumps(RECORDS[:1], indent=indent))
    assert readers.read_permissive(spark, str(folder), schemas.CUSTOMER_RAW).good.count() == 2


def test_compressed_files_are_read(spark, tmp_path):
    import gzip

    for name, text in (("a", json.dumps(RECORDS[:1])), ("b", json.dumps(RECORDS[:1], indent=2)), ("c", json.dumps(RECORDS[0]))):
        with gzip.open(tmp_path / f"{name}.json.gz", "wt") as file:
            file.write(text)
    found = readers.read_permissive(spark, str(tmp_path), schemas.CUSTOMER_RAW)
    assert [r["FIRST_NAME"] for r in found.good.collect()] == [RECORDS[0]["FIRST_NAME"]] * 3
    assert found.bad.count() == 0
