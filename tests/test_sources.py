import json

import fixtures
import pytest
from conftest import rows
from pyspark.sql.types import DoubleType, StructField

from swipeledger import schemas
from swipeledger.sources import readers
from swipeledger.sources.views import register_views

CUSTOMERS = [
    {"SSN": 1, "FIRST_NAME": "ALEC", "CUST_ZIP": "06511", "CUST_PHONE": 1237818, "NOTE": "x"},
    {"SSN": 2, "FIRST_NAME": None, "CUST_ZIP": None, "CUST_PHONE": None, "NOTE": None},
]


def write(path, text):
    path.write_text(text)
    return str(path)


@pytest.fixture(params=["lines", "array"])
def customer_file(request, tmp_path):
    if request.param == "lines":
        return write(tmp_path / "c.json", "\n".join(json.dumps(c) for c in CUSTOMERS))
    return write(tmp_path / "c.json", json.dumps(CUSTOMERS))


def test_read_customers(spark, customer_file):
    df = readers.read_customers(spark, customer_file)
    assert df.schema.fields[:-1] == schemas.CUSTOMER_RAW.fields
    assert rows(df, "SSN", "FIRST_NAME", "CUST_ZIP", "CUST_PHONE", "NOTE") == [
        (1, "ALEC", "06511", 1237818, "x"),
        (2, None, None, None, None),
    ]


def test_extra_fields_have_their_type(spark, tmp_path):
    path = write(tmp_path / "c.json", '{"SSN": 1, "SCORE": 1.5}\n{"SSN": 2}')
    df = readers.read_customers(spark, path, [StructField("SCORE", DoubleType())])
    assert rows(df, "SSN", "SCORE") == [(1, 1.5), (2, None)]


def test_columns_that_few_records_have_are_kept(spark, tmp_path):
    lines = ['{"SSN": %d}' % i for i in range(3000)] + ['{"SSN": 3000, "RARE": [1, {"x": 2}]}']
    df = readers.read_customers(spark, write(tmp_path / "c.json", "\n".join(lines)))
    assert rows(df.filter("RARE is not null"), "SSN", "RARE") == [(3000, '[1,{"x":2}]')]
    assert df.count() == 3001


def test_read_branches_and_transactions(spark, tmp_path):
    data = [
        {"BRANCH_CODE": 1, "BRANCH_STATE": "CT", "BRANCH_PHONE": "1234565276", "BRANCH_ZIP": 6511},
        {"BRANCH_CODE": 2, "BRANCH_STATE": "CT", "BRANCH_PHONE": "1234565277", "BRANCH_ZIP": "06512"},
    ]
    path = write(tmp_path / "b.json", json.dumps(data))
    assert rows(readers.read_branches(spark, path)) == [(1, "CT", "1234565276", "6511"), (2, "CT", "1234565277", "06512")]
    bought = {"TRANSACTION_ID": 1, "CREDIT_CARD_NO": "4210", "CUST_SSN": 5, "BRANCH_CODE": 1,
              "TRANSACTION_TYPE": "Bills", "TRANSACTION_VALUE": 78.9, "DAY": 14, "MONTH": 2, "YEAR": 2018}
    path = write(tmp_path / "t.json", json.dumps([bought, bought | {"TRANSACTION_VALUE": "78.90"}]))
    assert rows(readers.read_transactions(spark, path)) == [tuple(bought.values())] * 2


LOANS = [
    {"Application_ID": "LP1", "Gender": "Male", "Married": "Yes", "Self_Employed": "No", "Application_Status": "Y"},
    {"Application_ID": "LP2", "Gender": "Female", "Married": "No", "Self_Employed": "Yes", "Application_Status": "N"},
]


@pytest.mark.parametrize("indent", [None, 0, 1, 2, 4, "\t"])
def test_read_loans(spark, tmp_path, indent):
    path = write(tmp_path / "l.json", json.dumps(LOANS, indent=indent))
    df = readers.read_loans(spark, path)
    assert rows(df, "Application_ID", "Gender", "Application_Status") == [
        ("LP1", "Male", "Y"),
        ("LP2", "Female", "N"),
    ]


AWKWARD = [
    {"SSN": 1, "CUST_ZIP": 6511, "FIRST_NAME": "brace }, {\n    }\n and [quote\""},
    {"SSN": "12345678x", "CUST_ZIP": 6511, "FIRST_NAME": "Etta"},
    {"SSN": "123456789", "CUST_ZIP": None, "FIRST_NAME": "Zoe"},
    {"SSN": "x", "CUST_ZIP": "y", "FIRST_NAME": "Bob", "NOTE": {"a": [{"b": 1}]}},
]
FORMS = {
    "lines": lambda data: "\n".join(map(json.dumps, data)),
    "one line": json.dumps,
    "line per record": lambda data: "[\n" + ",\n".join(map(json.dumps, data)) + "\n]\n",
    "indent 0": lambda data: json.dumps(data, indent=0),
    "indent 1": lambda data: json.dumps(data, indent=1),
    "indent 2": lambda data: json.dumps(data, indent=2),
    "indent 4": lambda data: json.dumps(data, indent=4),
    "tabs": lambda data: json.dumps(data, indent="\t"),
}


@pytest.mark.parametrize("newline", ["\n", "\r\n"])
@pytest.mark.parametrize("form", FORMS)
def test_every_form_gives_the_same_records(spark, tmp_path, form, newline):
    awkward = [r if form != "indent 0" or "NOTE" not in r else r | {"NOTE": [1]} for r in AWKWARD]
    for data in (awkward, awkward[:1], []):
        path = tmp_path / f"c{len(data)}.json"
        with path.open("w", newline=newline) as file:
            file.write(FORMS[form](data))
        read = readers.read_permissive(spark, str(path), schemas.CUSTOMER_CLEAN)
        assert read.good.count() + read.bad.count() == len(data)
    read = readers.read_permissive(spark, str(tmp_path / "c4.json"), schemas.CUSTOMER_CLEAN)
    assert rows(read.good, "SSN", "CUST_ZIP", "FIRST_NAME") == [
        (1, 6511, AWKWARD[0]["FIRST_NAME"]),
        (123456789, None, "Zoe"),
    ]
    assert rows(read.bad, "SSN", "NOTE", "bad_columns") == [
        ("12345678x", None, ["SSN"]),
        ("x", "[1]" if form == "indent 0" else '{"a":[{"b":1}]}', ["SSN", "CUST_ZIP"]),
    ]


def test_files_of_different_forms_side_by_side(spark, tmp_path):
    for k, form in enumerate(FORMS):
        write(tmp_path / f"{k}.json", FORMS[form]([{"SSN": 10 * k}, {"SSN": 10 * k + 1}]))
    read = readers.read_permissive(spark, str(tmp_path), schemas.CUSTOMER_RAW)
    assert [r[0] for r in sorted(read.good.select("SSN").collect())] == [10 * k + i for k in range(len(FORMS)) for i in (0, 1)]
    assert read.bad.count() == 0


@pytest.mark.parametrize("indent", [2, 4])
def test_indented_array_is_split(spark, tmp_path, conf, indent):
    conf(spark__sql__files__maxPartitionBytes="4KB", spark__sql__files__openCostInBytes="1KB")
    data = [{"SSN": i, "FIRST_NAME": f"name {i}"} for i in range(2000)]
    path = write(tmp_path / "c.json", json.dumps(data, indent=indent))
    read = readers.read_permissive(spark, path, schemas.CUSTOMER_CLEAN)
    assert read.good.rdd.getNumPartitions() > 4
    assert rows(read.good.selectExpr("count(*)", "sum(SSN)")) == [(2000, sum(range(2000)))]


@pytest.mark.parametrize("form", FORMS)
def test_a_broken_record_spoils_itself_only(spark, tmp_path, form):
    if form == "one line":
        return
    text = FORMS[form]([{"SSN": i, "CUST_ZIP": 1} for i in range(5)]).replace('"SSN": 2,', '"SSN": ,')
    read = readers.read_permissive(spark, write(tmp_path / "c.json", text), schemas.CUSTOMER_CLEAN)
    assert rows(read.good, "SSN") == [(0,), (1,), (3,), (4,)]
    assert read.bad.count() == 1


@pytest.mark.parametrize("form", [f for f in FORMS if "indent" in f or f == "tabs"])
@pytest.mark.parametrize("lost", [2, 3])
def test_a_file_cut_off_between_lines_has_a_bad_record(spark, tmp_path, form, lost):
    text = "\n".join(FORMS[form]([{"SSN": i, "CUST_ZIP": 1} for i in range(5)]).split("\n")[:-lost])
    read = readers.read_permissive(spark, write(tmp_path / "c.json", text), schemas.CUSTOMER_CLEAN)
    assert rows(read.good, "SSN") == [(0,), (1,), (2,), (3,)]
    assert read.bad.count() == 1


def test_several_records_in_one_place(spark, tmp_path):
    text = '{"SSN": 1} {"SSN": 2}\n{"SSN": 3}, {"SSN": 4}\n{"SSN": 5} x\n[{"SSN": 6}] x\n'
    read = readers.read_permissive(spark, write(tmp_path / "c.json", text), schemas.CUSTOMER_CLEAN)
    assert rows(read.good, "SSN") == [(3,), (4,)]
    assert read.bad.count() == 3


def test_permissive_read_of_a_broken_document(spark, tmp_path):
    write(tmp_path / "bad.json", '[{"SSN": 1,')
    write(tmp_path / "good.json", json.dumps([{"SSN": 2}], indent=4))
    read = readers.read_permissive(spark, str(tmp_path), schemas.CUSTOMER_CLEAN)
    assert rows(read.good, "SSN") == [(2,)]
    assert rows(read.bad, "_corrupt_record") == [('[{"SSN": 1,',)]


def test_a_bad_record_fails_the_plain_readers(spark, tmp_path):
    path = write(tmp_path / "c.json", '{"SSN": 1}\n{"SSN": \n')
    with pytest.raises(Exception, match="bad record"):
        readers.read_customers(spark, path).count()


def test_views_can_be_registered_twice(spark):
    for _ in range(2):
        register_views(
            fixtures.customers(spark),
            fixtures.transactions(spark),
            fixtures.branches(spark),
            fixtures.branches(spark),
        )
    counts = [
        spark.sql(f"SELECT count(*) FROM {v}").first()[0]
        for v in ("customer_table", "credit_table", "branches_table", "branch_table")
    ]
    assert counts == [5, 11, 4, 4]


def test_double_columns_survive_the_raw_layout():
    assert schemas.TRANSACTION_RAW["TRANSACTION_VALUE"].dataType == DoubleType()


def test_declared_values_are_parsed_once_into_columns(spark, tmp_path):
    """What follows the parse reads columns, not the map of a record, which it would go through for every value."""
    lines = ['{"BRANCH_CODE": 1, "BRANCH_ZIP": "x", "branch_note": "n"}', ' {"BRANCH_CODE": "a"},\t', '{"BRANCH_CODE": 2', "", '\t{"BRANCH_CODE": null}']
    (tmp_path / "b.json").write_text("\n".join(lines))
    read = readers.read_records(spark, str(tmp_path / "b.json"), schemas.BRANCH_RAW, parsed_path=str(tmp_path / "parsed"))
    kinds = dict(spark.read.parquet(str(tmp_path / "parsed")).dtypes)
    assert sorted(kinds.values()) == sorted(["string"] * (len(schemas.BRANCH_RAW) + 1) + ["map<string,string>", "array<string>", "boolean"])
    good = sorted(read.good.select("BRANCH_CODE", "BRANCH_ZIP", "branch_note").collect(), key=str)
    assert [tuple(r) for r in good] == [(1, "x", "n"), (None, None, None)]
    bad = {(r.BRANCH_CODE, tuple(r.bad_columns), r._corrupt_record) for r in read.bad.collect()}
    assert bad == {("a", ("BRANCH_CODE",), None), (None, (), '{"BRANCH_CODE": 2')}
    assert read.checked.columns == read.bad.columns == [*schemas.BRANCH_RAW.fieldNames(), "branch_note", "_corrupt_record", "bad_columns"]
