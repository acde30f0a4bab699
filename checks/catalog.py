"""Every operator of the library as a query over the driver's tables."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import standins
from swipeledger import schemas
from swipeledger.functions import dates, text
from swipeledger.operators import cleaning, joins, loans, lookups, reports, summaries, updates
from swipeledger.plans.load import load_more, load_tables
from swipeledger.plans.publish import publish_customers as publish
from swipeledger.plans.publish import publish_edits
from swipeledger.plans.shared_folder import new_folder
from swipeledger.sinks.files import write_clean
from swipeledger.sources import readers
from swipeledger.sources.views import register_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def _customers(spark, sf_dir):
    return cleaning.clean_customers(standins.raw_customers(spark, sf_dir))


def _branches(spark, sf_dir):
    return cleaning.clean_branches(standins.raw_branches(spark, sf_dir))


def _orders(spark, sf_dir):
    return cleaning.clean_transactions(standins.order_transactions(spark, sf_dir))


def _lines(spark, sf_dir):
    return cleaning.clean_transactions(standins.line_transactions(spark, sf_dir))


def _customer_transactions(spark, sf_dir):
    return joins.join_customer_transactions(_customers(spark, sf_dir), _orders(spark, sf_dir))


def _branch_transactions(spark, sf_dir):
    return joins.join_branch_transactions(_branches(spark, sf_dir), _lines(spark, sf_dir))


def _updates(spark, sf_dir):
    return standins.updates(spark, sf_dir, _customers(spark, sf_dir))


def _value_as_double(df):
    return df.withColumn("TRANSACTION_VALUE", F.col("TRANSACTION_VALUE").cast("double"))


# Column transforms


@query
def customer_zip_int(spark, sf_dir):
    raw = standins.raw_customers(spark, sf_dir)
    return raw.select("SSN", text.zip_number(F.col("CUST_ZIP")).alias("CUST_ZIP"))


@query
def customer_rejected_zips(spark, sf_dir):
    raw = standins.raw_customers(spark, sf_dir)
    return cleaning.rejected_zips(raw).select("SSN", "CUST_ZIP")


@query
def customer_first_title(spark, sf_dir):
    raw = standins.raw_customers(spark, sf_dir)
    return raw.select("SSN", text.title_case(F.col("FIRST_NAME")).alias("FIRST_NAME"))


@query
def customer_middle_lower(spark, sf_dir):
    return _customers(spark, sf_dir).select("SSN", "MIDDLE_NAME")


@query
def customer_last_title(spark, sf_dir):
    raw = standins.raw_customers(spark, sf_dir)
    return raw.select("SSN", text.title_case(F.col("LAST_NAME")).alias("LAST_NAME"))


@query
def part_name_title(spark, sf_dir):
    parts = standins.table(spark, sf_dir, "part")
    label = F.concat("p_name", F.lit("'"), "p_type", F.lit("-"), "p_brand")
    return parts.select("p_partkey", text.title_case(label).alias("title"))


@query
def customer_full_address(spark, sf_dir):
    raw = standins.raw_customers(spark, sf_dir)
    address = text.street_address(F.col("APT_NO"), F.col("STREET_NAME"))
    return raw.select("SSN", address.alias("FULL_STREET_ADDRESS"))


@query
def customer_phone_format(spark, sf_dir):
    raw = standins.raw_customers(spark, sf_dir)
    return raw.select("SSN", text.local_phone(F.col("CUST_PHONE")).alias("CUST_PHONE"))


@query
def clean_customers(spark, sf_dir):
    return _customers(spark, sf_dir)


@query
def branch_phone_format(spark, sf_dir):
    raw = standins.raw_branches(spark, sf_dir)
    return raw.select("BRANCH_CODE", text.full_phone(F.col("BRANCH_PHONE")).alias("BRANCH_PHONE"))


@query
def branch_zip_default(spark, sf_dir):
    raw = standins.raw_branches(spark, sf_dir)
    return raw.select("BRANCH_CODE", text.zip_text(F.col("BRANCH_ZIP")).alias("BRANCH_ZIP"))


@query
def clean_branches(spark, sf_dir):
    return _branches(spark, sf_dir)


@query
def transaction_pad_date_parts(spark, sf_dir):
    raw = standins.order_transactions(spark, sf_dir)
    return raw.select(
        "TRANSACTION_ID",
        dates.two_digits(F.col("DAY")).alias("DAY"),
        dates.two_digits(F.col("MONTH")).alias("MONTH"),
    )


@query
def transaction_timeid(spark, sf_dir):
    raw = standins.order_transactions(spark, sf_dir)
    value = dates.timeid(F.col("YEAR"), F.col("MONTH"), F.col("DAY"))
    return raw.select("TRANSACTION_ID", value.alias("TIMEID"))


@query
def transaction_date(spark, sf_dir):
    return cleaning.with_date(_orders(spark, sf_dir)).select("TRANSACTION_ID", "TRANSACTION_DATE")


@query
def transaction_date_parts(spark, sf_dir):
    parts = cleaning.with_date_parts(_orders(spark, sf_dir))
    return parts.select("TRANSACTION_ID", "YEAR", "MONTH", "DAY", "YEAR_MONTH")


@query
def clean_transactions(spark, sf_dir):
    return _value_as_double(_lines(spark, sf_dir))


# Joins


@query
def join_customer_transactions(spark, sf_dir):
    return _value_as_double(_customer_transactions(spark, sf_dir))


@query
def join_customer_transactions_idle(spark, sf_dir):
    events = cleaning.clean_transactions(standins.event_transactions(spark, sf_dir))
    joined = joins.join_customer_transactions(_customers(spark, sf_dir), events)
    return _value_as_double(joined)


@query
def join_branch_transactions(spark, sf_dir):
    return _value_as_double(_branch_transactions(spark, sf_dir))


# Lookups


@query
def transactions_by_zip_month(spark, sf_dir):
    joined = _customer_transactions(spark, sf_dir)
    return _value_as_double(lookups.transactions_by_zip_month(joined, 7, "11", "1998"))


@query
def type_count_total(spark, sf_dir):
    return lookups.type_count_total(_orders(spark, sf_dir), "1-Urgent")


@query
def type_count_total_all(spark, sf_dir):
    return lookups.type_count_total_all(_lines(spark, sf_dir))


@query
def state_count_total(spark, sf_dir):
    return lookups.state_count_total(_branch_transactions(spark, sf_dir), "nation_15")


@query
def branch_count_total_by_state(spark, sf_dir):
    return lookups.branch_count_total_by_state(_branch_transactions(spark, sf_dir), "nation_15")


@query
def account_details(spark, sf_dir):
    accounts = lookups.account_details(_customers(spark, sf_dir), "Household", "Nation_2-O'Household0")
    return accounts


@query
def account_details_all(spark, sf_dir):
    return lookups.account_details_all(_customers(spark, sf_dir))


@query
def account_details_view(spark, sf_dir):
    return lookups.account_details_view(_customers(spark, sf_dir))


@query
def monthly_bill(spark, sf_dir):
    return lookups.monthly_bill(_orders(spark, sf_dir), "330", "01", "1999")


@query
def monthly_bills_all(spark, sf_dir):
    return lookups.monthly_bills_all(_orders(spark, sf_dir))


@query
def transactions_between(spark, sf_dir):
    joined = _customer_transactions(spark, sf_dir)
    found = lookups.transactions_between(
        joined, "Household", "Nation_2-O'Household0", "19960101", "20001231"
    )
    return _value_as_double(found)


# Updates


@query
def match_updates(spark, sf_dir):
    return updates.match_updates(_customers(spark, sf_dir), _updates(spark, sf_dir))


@query
def unmatched_updates(spark, sf_dir):
    return updates.unmatched_updates(_customers(spark, sf_dir), _updates(spark, sf_dir))


@query
def rejected_updates(spark, sf_dir):
    return updates.rejected_updates(_customers(spark, sf_dir), _updates(spark, sf_dir))


@query
def apply_updates(spark, sf_dir):
    return updates.apply_updates(_customers(spark, sf_dir), _updates(spark, sf_dir))


# Reports


@query
def type_counts(spark, sf_dir):
    return reports.type_counts(_orders(spark, sf_dir))


@query
def top_type(spark, sf_dir):
    return reports.top_type(_orders(spark, sf_dir))


@query
def customers_per_state(spark, sf_dir):
    return reports.customers_per_state(_customers(spark, sf_dir))


@query
def top_state(spark, sf_dir):
    return reports.top_state(_customers(spark, sf_dir))


@query
def customer_totals(spark, sf_dir):
    return reports.customer_totals(_orders(spark, sf_dir))


@query
def top_customers(spark, sf_dir):
    return reports.top_customers(_orders(spark, sf_dir))


@query
def top_customer(spark, sf_dir):
    return reports.top_customer(_orders(spark, sf_dir))


@query
def month_totals(spark, sf_dir):
    return reports.month_totals(_lines(spark, sf_dir))


@query
def top_months(spark, sf_dir):
    return reports.top_months(_lines(spark, sf_dir))


@query
def rejected_days(spark, sf_dir):
    """Every line moved to the 31st, which not all months have."""
    moved = standins.line_transactions(spark, sf_dir).withColumn("DAY", F.lit(31))
    return reports.rejected_days(cleaning.clean_transactions(moved))


@query
def rejected_amounts(spark, sf_dir):
    """Events with an eighth of their value as amount."""
    raw = standins.event_transactions(spark, sf_dir)
    parts = raw.withColumn("TRANSACTION_VALUE", F.round("TRANSACTION_VALUE", 2) / 8)
    return cleaning.rejected_amounts(parts).select("TRANSACTION_ID", "TRANSACTION_VALUE")


@query
def branch_totals_for_type(spark, sf_dir):
    return reports.branch_totals_for_type(_branch_transactions(spark, sf_dir), "R")


@query
def top_branch_for_type(spark, sf_dir):
    return reports.top_branch_for_type(_branch_transactions(spark, sf_dir), "R")


@query
def pct_self_employed_approved(spark, sf_dir):
    return loans.pct_self_employed_approved(standins.loans(spark, sf_dir))


@query
def approval_rate_self_employed(spark, sf_dir):
    return loans.approval_rate_self_employed(standins.loans(spark, sf_dir))


@query
def pct_rejected_married_male(spark, sf_dir):
    return loans.pct_rejected_married_male(standins.loans(spark, sf_dir))


# Sources and sinks


_LOADED: dict[tuple, dict[str, str]] = {}


def _loaded(spark, sf_dir):
    """The whole load from raw JSON files made of the driver's tables, once for a session and a folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _LOADED:
        folder = new_folder(spark)
        raw = {
            "customers": standins.raw_customers(spark, sf_dir),
            "branches": standins.raw_branches(spark, sf_dir),
            "transactions": standins.order_transactions(spark, sf_dir),
        }
        for name, df in raw.items():
            write_clean(df, f"{folder}/raw/{name}", "json")
        _LOADED[key] = load_tables(
            spark, *(f"{folder}/raw/{name}" for name in raw), target=f"{folder}/stored"
        )
    return _LOADED[key]


def _stored(spark, sf_dir, name):
    return readers.read_clean(spark, name, _loaded(spark, sf_dir)[name])


@query
def json_round_trip(spark, sf_dir):
    folder = new_folder(spark)
    write_clean(_orders(spark, sf_dir), folder, "json")
    return _value_as_double(readers.read_clean(spark, "transactions", folder, "json"))


def _through_json(spark, df, table):
    folder = new_folder(spark)
    write_clean(df, folder, "json")
    return readers.read_clean(spark, table, folder, "json")


@query
def customers_json(spark, sf_dir):
    return _through_json(spark, _customers(spark, sf_dir), "customers")


@query
def branches_json(spark, sf_dir):
    return _through_json(spark, _branches(spark, sf_dir), "branches")


@query
def customer_transactions_json(spark, sf_dir):
    joined = _customer_transactions(spark, sf_dir)
    return _value_as_double(_through_json(spark, joined, "customer_transactions"))


@query
def branch_transactions_json(spark, sf_dir):
    joined = _branch_transactions(spark, sf_dir)
    return _value_as_double(_through_json(spark, joined, "branch_transactions"))


@query
def json_permissive(spark, sf_dir):
    """Raw customers with their zip declared as a number, so those in debt do not
    fit."""
    folder = new_folder(spark)
    write_clean(_for_permissive_read(spark, sf_dir), folder, "json")
    return _good_and_bad(readers.read_permissive(spark, folder, schemas.CUSTOMER_CLEAN))


@query
def json_indented_array(spark, sf_dir):
    """The same rows as the indented records of arrays."""
    folder = new_folder(spark)
    records = _for_permissive_read(spark, sf_dir).withColumn("id", F.col("SSN"))
    standins.write_arrays(records, folder, indent=4)
    return _good_and_bad(readers.read_permissive(spark, folder, schemas.CUSTOMER_CLEAN))


@query
def json_array_multiline(spark, sf_dir):
    return _damaged_array(spark, sf_dir, 4)


@query
def json_array_indent2(spark, sf_dir):
    return _damaged_array(spark, sf_dir, 2)


def _damaged_array(spark, sf_dir, indent):
    """Arrays in which some records lack their closing brace and some have an SSN that is no number."""
    folder = new_folder(spark)
    standins.write_arrays(standins.damaged_customers(spark, sf_dir), folder, indent, broken="broken")
    read = readers.read_permissive(spark, folder, schemas.CUSTOMER_RAW)
    good = read.good.select(F.col("SSN").cast("string"), "LAST_UPDATED", F.lit("").alias("problem"))
    in_text = F.regexp_extract("_corrupt_record", '"SSN" : "([0-9]+)"', 1)
    problem = F.when(F.col("_corrupt_record").isNotNull(), "broken").otherwise(F.concat_ws(",", "bad_columns"))
    return good.union(read.bad.select(F.coalesce("SSN", in_text), "LAST_UPDATED", problem))


@query
def json_array_one_line(spark, sf_dir):
    """Arrays on one line each, with strings that look like the ends of records and objects within records."""
    folder = new_folder(spark)
    standins.write_one_line_arrays(standins.tricky_customers(spark, sf_dir), folder)
    read = readers.read_permissive(spark, folder, schemas.CUSTOMER_RAW)
    columns = ("CUST_ZIP", "NOTE", "SEEN")
    good = read.good.select(F.col("SSN").cast("string"), *columns, F.lit("").alias("problem"))
    return good.union(read.bad.select("SSN", *columns, F.concat_ws(",", "bad_columns")))


@query
def json_all_columns(spark, sf_dir):
    """Clean customers as JSON with a column that is not declared, read back as that table."""
    return _through_json(spark, _customers(spark, sf_dir).withColumn("SINCE", F.concat(F.lit("day "), F.col("SSN").cast("string"))), "customers")


@query
def load_changed_values(spark, sf_dir):
    """What a load lists of the values that cleaning changes: zips that are no numbers, amounts with parts of a cent or too large. No part is half
    a cent, which engines round differently."""
    folder = new_folder(spark)
    amount = F.expr("CASE WHEN TRANSACTION_ID % 50 = 7 THEN 1e30 WHEN TRANSACTION_ID % 10 = 7 THEN TRANSACTION_VALUE + 0.003 ELSE TRANSACTION_VALUE END")
    write_clean(standins.raw_customers(spark, sf_dir), f"{folder}/customers", "json")
    write_clean(standins.raw_branches(spark, sf_dir), f"{folder}/branches", "json")
    write_clean(standins.order_transactions(spark, sf_dir).withColumn("TRANSACTION_VALUE", amount), f"{folder}/transactions", "json")
    paths = load_tables(spark, *(f"{folder}/{n}" for n in ("customers", "branches", "transactions")), target=f"{folder}/stored")
    stored = readers.read_clean(spark, "transactions", paths["transactions"]).select("TRANSACTION_ID", "TRANSACTION_VALUE")
    amounts = spark.read.parquet(paths["rejected_amounts"]).select("TRANSACTION_ID", F.col("TRANSACTION_VALUE").alias("value"))
    amounts = amounts.join(stored, "TRANSACTION_ID").select(
        F.lit("amount").alias("kind"), F.col("TRANSACTION_ID").alias("id"), "value", F.col("TRANSACTION_VALUE").cast("double").alias("stored")
    )
    zips = spark.read.parquet(paths["rejected_zips"])
    nothing = F.lit(None).cast("double")
    return amounts.union(zips.select(F.lit("zip"), "SSN", nothing, nothing))


def _stored_twice(spark, sf_dir):
    """The store after three loads: of some of the transactions, of all, and of all once more. Two of three files come again
    in the second. Loaded once for a session and a folder."""
    key = (spark.sparkContext.applicationId, sf_dir, "twice")
    if key in _LOADED:
        return _LOADED[key]
    folder = new_folder(spark)
    raw = standins.order_transactions(spark, sf_dir)
    for name, df in (("customers", standins.raw_customers(spark, sf_dir)), ("branches", standins.raw_branches(spark, sf_dir))):
        write_clean(df, f"{folder}/raw/{name}", "json")
    write_clean(raw.filter("YEAR < 1999"), f"{folder}/raw/first/old", "json")
    paths = load_tables(spark, *(f"{folder}/raw/{n}" for n in ("customers", "branches", "first/old")), target=f"{folder}/stored")
    write_clean(raw.filter("YEAR >= 1998"), f"{folder}/raw/more/new", "json")
    write_clean(raw.filter("YEAR >= 2000"), f"{folder}/raw/more/again", "json")
    for _ in range(2):
        load_more(spark, [f"{folder}/raw/first/old", f"{folder}/raw/more/new", f"{folder}/raw/more/again"], f"{folder}/stored")
    _LOADED[key] = paths
    return paths


@query
def incremental_load(spark, sf_dir):
    """The transactions of repeated and overlapping loads: each once."""
    return _value_as_double(readers.read_clean(spark, "transactions", _stored_twice(spark, sf_dir)["transactions"]))


@query
def incremental_load_join(spark, sf_dir):
    """The join of customers that the loads have kept up to date."""
    return _value_as_double(readers.read_clean(spark, "customer_transactions", _stored_twice(spark, sf_dir)["customer_transactions"]))


def _edited_store(spark, sf_dir):
    """A store of its own, whose customers are edited."""
    folder = new_folder(spark)
    raw = {"customers": standins.raw_customers(spark, sf_dir), "branches": standins.raw_branches(spark, sf_dir), "transactions": standins.order_transactions(spark, sf_dir)}
    for name, df in raw.items():
        write_clean(df, f"{folder}/raw/{name}", "json")
    paths = load_tables(spark, *(f"{folder}/raw/{name}" for name in raw), target=f"{folder}/stored")
    publish_edits(spark, _updates(spark, sf_dir), f"{folder}/stored")
    return paths


@query
def publish_joined(spark, sf_dir):
    """The stored join of customers after a batch of edits."""
    return _value_as_double(readers.read_clean(spark, "customer_transactions", _edited_store(spark, sf_dir)["customer_transactions"]))


@query
def load_rejects(spark, sf_dir):
    """What a load of damaged customers stores as rejected."""
    folder = new_folder(spark)
    records = standins.damaged_customers(spark, sf_dir)
    columns = [c for c in records.columns if c not in ("id", "broken")]
    line = F.to_json(F.struct(*columns))
    records.select(F.when(F.col("broken"), F.substring(line, 1, 20)).otherwise(line)).write.text(f"{folder}/customers")
    write_clean(standins.raw_branches(spark, sf_dir), f"{folder}/branches", "json")
    write_clean(standins.order_transactions(spark, sf_dir), f"{folder}/transactions", "json")
    names = ("customers", "branches", "transactions")
    paths = load_tables(spark, *(f"{folder}/{n}" for n in names), target=f"{folder}/stored")
    rejected = [
        spark.read.parquet(paths[f"rejected_{n}"]).select(
            F.lit(n).alias("rejected_from"), F.concat_ws(",", "bad_columns").alias("bad_columns"), "_corrupt_record",
            (F.col("SSN") if n == "customers" else F.lit(None).cast("string")).alias("SSN"),
        )
        for n in names
    ]
    return rejected[0].union(rejected[1]).union(rejected[2])


@query
def clean_customers_all_columns(spark, sf_dir):
    """Raw customers with a column that is not declared, from JSON to the clean table."""
    folder = new_folder(spark)
    raw = standins.raw_customers(spark, sf_dir)
    write_clean(raw.withColumn("LAST_UPDATED", F.concat(F.lit("day "), F.col("SSN").cast("string"))), folder, "json")
    return cleaning.clean_customers(readers.read_customers(spark, folder))


@query
def loans_all_columns(spark, sf_dir):
    """Loan applications with their number and quantity, as arrays of records."""
    folder = new_folder(spark)
    applications = standins.loans(spark, sf_dir, "concat('LP', l_orderkey, '-', l_linenumber) AS Application_ID", "l_quantity AS Quantity", "l_orderkey AS id")
    standins.write_arrays(applications, folder, indent=4)
    return readers.read_loans(spark, folder).withColumn("Quantity", F.col("Quantity").cast("double"))


def _for_permissive_read(spark, sf_dir):
    return standins.raw_customers(spark, sf_dir).drop("APT_NO", "STREET_NAME")


def _good_and_bad(read):
    good = read.good.select("SSN", "CUST_ZIP", F.lit(None).cast("string").alias("bad_column"))
    bad = read.bad.select(
        F.col("SSN").cast("bigint"),
        F.lit(None).cast("int").alias("CUST_ZIP"),
        F.concat_ws(",", "bad_columns").alias("bad_column"),
    )
    return good.union(bad)


@query
def loans_json(spark, sf_dir):
    folder = new_folder(spark)
    write_clean(standins.loans(spark, sf_dir), folder, "json")
    kinds = readers.read_loans(spark, folder).groupBy(*schemas.LOAN_APPLICATION.fieldNames())
    return kinds.agg(F.count("*").alias("applications"))


@query
def temp_view_sql(spark, sf_dir):
    register_views(
        _customers(spark, sf_dir),
        _orders(spark, sf_dir),
        _branches(spark, sf_dir),
        standins.raw_branches(spark, sf_dir),
    )
    return spark.sql(
        """
        SELECT customer_table.CUST_STATE, count(credit_table.TRANSACTION_ID) AS transactions,
               cast(sum(credit_table.TRANSACTION_VALUE) AS double) AS total_value
        FROM customer_table
        JOIN credit_table ON customer_table.CREDIT_CARD_NO = credit_table.CREDIT_CARD_NO
        GROUP BY customer_table.CUST_STATE
        """
    )


@query
def stored_customer_transactions(spark, sf_dir):
    return _value_as_double(_stored(spark, sf_dir, "customer_transactions"))


@query
def stored_branch_transactions(spark, sf_dir):
    return _value_as_double(_stored(spark, sf_dir, "branch_transactions"))


@query
def stored_transactions_by_zip_month(spark, sf_dir):
    stored = _stored(spark, sf_dir, "customer_transactions")
    return _value_as_double(lookups.transactions_by_zip_month(stored, 7, "11", "1998").drop("YEAR_MONTH"))


@query
def stored_transactions_between(spark, sf_dir):
    stored = _stored(spark, sf_dir, "customer_transactions")
    found = lookups.transactions_between(stored, "Household", "Nation_2-O'Household0", "19960101", "20001231")
    return _value_as_double(found.drop("YEAR_MONTH"))


@query
def stored_monthly_bill(spark, sf_dir):
    return lookups.monthly_bill(_stored(spark, sf_dir, "transactions"), "330", "01", "1999")


@query
def stored_state_count_total(spark, sf_dir):
    return lookups.state_count_total(_stored(spark, sf_dir, "branch_transactions"), "nation_15")


# Reports of stored summaries


@query
def stored_type_count_total_all(spark, sf_dir):
    return lookups.type_count_total_all(_stored(spark, sf_dir, "daily_totals"))


@query
def stored_type_counts(spark, sf_dir):
    return reports.type_counts(_stored(spark, sf_dir, "daily_totals"))


@query
def stored_month_totals(spark, sf_dir):
    return reports.month_totals(_stored(spark, sf_dir, "daily_totals"))


@query
def stored_branch_totals_for_type(spark, sf_dir):
    daily = summaries.with_branches(_stored(spark, sf_dir, "daily_totals"), _stored(spark, sf_dir, "branches"))
    return reports.branch_totals_for_type(daily, "1-URGENT")


@query
def stored_monthly_bills_all(spark, sf_dir):
    return lookups.monthly_bills_all(_stored(spark, sf_dir, "card_months"))


@query
def stored_customer_totals(spark, sf_dir):
    return reports.customer_totals(_stored(spark, sf_dir, "card_months"))


@query
def stored_account_details(spark, sf_dir):
    stored = _stored(spark, sf_dir, "customers")
    return lookups.account_details(stored, "Household", "Nation_2-O'Household0")


@query
def publish_customers(spark, sf_dir):
    folder = new_folder(spark)
    current = f"{folder}/current"
    write_clean(_customers(spark, sf_dir), current)
    valid = publish(spark, current, _updates(spark, sf_dir), f"{folder}/edited")
    return readers.read_clean(spark, "customers", valid)
