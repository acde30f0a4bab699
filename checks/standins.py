"""The driver's tables in the layouts of the library. ``oracle.py`` states the same in
SQL of its own. Every table is used whole."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Declared, so that no job is spent on reading the layout of each file.
LAYOUTS = {
    "nation": "n_nationkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double,"
    " c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,"
    " l_quantity double, l_extendedprice double, l_returnflag string, l_linestatus string,"
    " l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(LAYOUTS[name]).parquet(f"{sf_dir}/{name}.parquet")


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some names are shared by several customers; customers in debt lack a usable
    zip and an apartment."""
    return table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS SSN",
        "c_mktsegment AS FIRST_NAME",
        "c_name AS MIDDLE_NAME",
        "concat('NATION_', c_nationkey, '-O\\'', c_mktsegment, c_custkey div 100) AS LAST_NAME",
        "string(c_custkey) AS CREDIT_CARD_NO",
        "if(c_acctbal >= 0, string(c_nationkey), null) AS APT_NO",
        "concat(c_mktsegment, ' Street') AS STREET_NAME",
        "concat('City of NATION_', c_nationkey) AS CUST_CITY",
        "concat('NATION_', c_nationkey) AS CUST_STATE",
        "'United States' AS CUST_COUNTRY",
        "if(c_acctbal < 0, 'n/a', lpad(string(c_nationkey), 5, '0')) AS CUST_ZIP",
        "c_custkey + 1000000 AS CUST_PHONE",
        "concat(lower(c_mktsegment), '@example.com') AS CUST_EMAIL",
    )


def damaged_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw customers as JSON text with undeclared columns: in one of ten the SSN is no number, and one of ten, ``broken``, is
    to be cut off."""
    raw = raw_customers(spark, sf_dir)
    more = {
        "id": F.col("SSN"),
        "broken": F.col("SSN") % 10 == 7,
        "SSN": F.when(F.col("SSN") % 10 == 3, F.concat(F.lit("S"), F.col("SSN").cast("string"))).otherwise(F.col("SSN").cast("string")),
        "LAST_UPDATED": F.concat(F.lit("day "), F.col("SSN").cast("string")),
    }
    return raw.withColumns(more)


IN_FILE = 20_000


def write_one_line_arrays(records: DataFrame, path: str) -> None:
    """Records as JSON arrays of up to ``IN_FILE``, each on one line of a file of its own, as pandas writes them."""
    columns = [c for c in records.columns if c not in ("id", "broken")]
    text = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
    joined = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("id", text.alias("text")))), lambda r: r["text"]), ",")
    arrays = records.groupBy(F.floor(F.col("id") / IN_FILE).alias("part")).agg(F.concat(F.lit("["), joined, F.lit("]")).alias("value"))
    arrays.write.partitionBy("part").option("lineSep", " ").text(path)


def write_arrays(records: DataFrame, path: str, indent: int, broken: str | None = None) -> None:
    """Records as JSON arrays of up to ``IN_FILE``, one file each, with brackets and commas; indented by ``indent``. Those for which
    ``broken`` holds lack their closing brace."""
    columns = [c for c in records.columns if c not in ("id", "broken")]
    text = F.regexp_replace(F.to_json(F.struct(*columns), {"pretty": "true"}), r"\r?\n", "\n" + " " * indent)
    text = F.concat(F.lit(" " * indent), text)
    if broken:
        text = F.when(F.expr(broken), F.regexp_replace(text, r"\s*\}$", "")).otherwise(text)
    group = F.floor(F.col("id") / IN_FILE).alias("part")
    joined = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("id", text.alias("text")))), lambda r: r["text"]), ",\n")
    arrays = records.groupBy(group).agg(F.concat(F.lit("[\n"), joined, F.lit("\n]")).alias("value"))
    arrays.write.partitionBy("part").text(path)


def tricky_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw customers whose notes hold what divides records, and an object: in one of ten the SSN is no number."""
    raw = damaged_customers(spark, sf_dir).drop("broken", "LAST_UPDATED")
    note = F.concat(F.lit('say "x\\" }, {"SSN": 0 }] '), F.col("id").cast("string"))
    return raw.withColumns({"NOTE": note, "SEEN": F.struct(F.col("id").alias("BY"), F.array(F.struct(note.alias("}")))
                            .alias("IN"))})


def raw_branches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers, and a head office per nation that has no transactions."""
    suppliers = table(spark, sf_dir, "supplier").selectExpr(
        "int(s_suppkey) AS BRANCH_CODE",
        "concat('NATION_', s_nationkey) AS BRANCH_STATE",
        "lpad(string(s_suppkey), 10, '5') AS BRANCH_PHONE",
        "if(s_acctbal >= 0, lpad(string(s_suppkey), 5, '0'), null) AS BRANCH_ZIP",
    )
    head_offices = table(spark, sf_dir, "nation").selectExpr(
        "-1 - n_nationkey AS BRANCH_CODE",
        "concat('NATION_', n_nationkey) AS BRANCH_STATE",
        "string(null) AS BRANCH_PHONE",
        "string(null) AS BRANCH_ZIP",
    )
    return suppliers.unionByName(head_offices)


def order_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw transactions of the customers."""
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS TRANSACTION_ID",
        "string(o_custkey) AS CREDIT_CARD_NO",
        "o_custkey AS CUST_SSN",
        "int(o_orderkey % 1000) AS BRANCH_CODE",
        "o_orderpriority AS TRANSACTION_TYPE",
        "o_totalprice AS TRANSACTION_VALUE",
        *_date_columns("o_orderdate"),
    )


def event_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw transactions of few customers; most customers have none."""
    return table(spark, sf_dir, "events").selectExpr(
        "event_id AS TRANSACTION_ID",
        "string(user_id) AS CREDIT_CARD_NO",
        "user_id AS CUST_SSN",
        "int(event_id % 1000) AS BRANCH_CODE",
        "event_type AS TRANSACTION_TYPE",
        "value AS TRANSACTION_VALUE",
        *_date_columns("ts"),
    )


def line_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw transactions of the branches."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey AS TRANSACTION_ID",
        "string(l_partkey) AS CREDIT_CARD_NO",
        "l_partkey AS CUST_SSN",
        "int(l_suppkey) AS BRANCH_CODE",
        "l_returnflag AS TRANSACTION_TYPE",
        "l_extendedprice AS TRANSACTION_VALUE",
        *_date_columns("l_shipdate"),
    )


def loans(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(
        "if(l_linenumber % 2 = 1, 'Male', 'Female') AS Gender",
        "if(l_quantity > 25, 'Yes', 'No') AS Married",
        "if(l_linestatus = 'O', 'Yes', 'No') AS Self_Employed",
        "if(l_returnflag = 'R', 'N', 'Y') AS Application_Status",
        *more,
    )


def updates(spark: SparkSession, sf_dir: str, customers: DataFrame) -> DataFrame:
    """One edit per clean customer, in turn of every kind, valid or not, some for the SSN of another, and one per
    supplier for a name that does not exist. Shared names get several edits."""
    of_customers = customers.selectExpr(
        "SSN AS seq",
        "FIRST_NAME",
        "LAST_NAME",
        """
        CASE SSN % 12
          WHEN 0 THEN 'CUST_PHONE' WHEN 1 THEN 'CUST_EMAIL' WHEN 2 THEN 'CREDIT_CARD_NO'
          WHEN 3 THEN 'FULL_STREET_ADDRESS' WHEN 4 THEN 'CUST_CITY' WHEN 5 THEN 'CUST_STATE'
          WHEN 6 THEN 'CUST_ZIP' WHEN 7 THEN 'SSN' WHEN 8 THEN 'CUST_STATE'
          WHEN 9 THEN 'CUST_ZIP' WHEN 10 THEN 'SSN' ELSE 'FAX' END AS field
        """,
        """
        CASE SSN % 12
          WHEN 0 THEN concat('(212)555-', lpad(string(SSN), 9, '0'))
          WHEN 1 THEN concat('new', SSN, '@example.com')
          WHEN 2 THEN lpad(string(SSN), 16, '4')
          WHEN 3 THEN concat(SSN, ' , Main Street')
          WHEN 4 THEN concat('New ', CUST_CITY)
          WHEN 5 THEN 'NY'
          WHEN 6 THEN lpad(string(SSN % 100000), 5, '0')
          WHEN 7 THEN concat('9', lpad(string(SSN), 8, '0'))
          WHEN 8 THEN 'Ohio'
          WHEN 9 THEN 'n/a'
          WHEN 10 THEN if(SSN % 24 = 10, '12345', lpad(string(SSN - 1), 9, '0'))
          ELSE 'none' END AS new_value
        """,
    )
    of_strangers = table(spark, sf_dir, "supplier").selectExpr(
        "-1 - s_suppkey AS seq",
        "'Nobody' AS FIRST_NAME",
        "s_name AS LAST_NAME",
        "'CUST_CITY' AS field",
        "'Nowhere' AS new_value",
    )
    return of_customers.unionByName(of_strangers)


def _date_columns(timestamp: str) -> list[str]:
    return [f"day({timestamp}) AS DAY", f"month({timestamp}) AS MONTH", f"year({timestamp}) AS YEAR"]
