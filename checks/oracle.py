"""The SQL of every query, for DuckDB on the driver's tables."""

RAW_CUSTOMERS = """
raw_customers AS (
  SELECT c_custkey AS SSN,
         c_mktsegment AS FIRST_NAME,
         c_name AS MIDDLE_NAME,
         n_name || '-O''' || c_mktsegment || CAST(c_custkey // 100 AS VARCHAR) AS LAST_NAME,
         CAST(c_custkey AS VARCHAR) AS CREDIT_CARD_NO,
         CASE WHEN c_acctbal >= 0 THEN CAST(c_nationkey AS VARCHAR) END AS APT_NO,
         c_mktsegment || ' Street' AS STREET_NAME,
         'City of ' || n_name AS CUST_CITY,
         n_name AS CUST_STATE,
         'United States' AS CUST_COUNTRY,
         CASE WHEN c_acctbal < 0 THEN 'n/a'
              ELSE lpad(CAST(c_nationkey AS VARCHAR), 5, '0') END AS CUST_ZIP,
         c_custkey + 1000000 AS CUST_PHONE,
         lower(c_mktsegment) || '@example.com' AS CUST_EMAIL
  FROM customer
  JOIN nation ON c_nationkey = n_nationkey
)"""


def title(text: str) -> str:
    """Runs of letters and of other characters; the first character of each in
    upper case."""
    return (
        f"array_to_string(list_transform(regexp_extract_all(lower({text}), '[a-z]+|[^a-z]+'),"
        " lambda w: upper(w[1]) || w[2:]), '')"
    )


def phone(number: str) -> str:
    digits = f"CAST({number} AS VARCHAR)"
    return f"'(516)' || substr({digits}, 1, 3) || '-' || substr({digits}, 4)"


CUSTOMERS = f"""{RAW_CUSTOMERS},
customers AS (
  SELECT SSN,
         {title('FIRST_NAME')} AS FIRST_NAME,
         lower(MIDDLE_NAME) AS MIDDLE_NAME,
         {title('LAST_NAME')} AS LAST_NAME,
         CREDIT_CARD_NO, CUST_CITY, CUST_STATE, CUST_COUNTRY,
         TRY_CAST(CUST_ZIP AS INTEGER) AS CUST_ZIP,
         {phone('CUST_PHONE')} AS CUST_PHONE,
         CUST_EMAIL,
         APT_NO || ' , ' || STREET_NAME AS FULL_STREET_ADDRESS
  FROM raw_customers
)"""

RAW_BRANCHES = """
raw_branches AS (
  SELECT CAST(s_suppkey AS INTEGER) AS BRANCH_CODE,
         n_name AS BRANCH_STATE,
         lpad(CAST(s_suppkey AS VARCHAR), 10, '5') AS BRANCH_PHONE,
         CASE WHEN s_acctbal >= 0 THEN lpad(CAST(s_suppkey AS VARCHAR), 5, '0') END AS BRANCH_ZIP
  FROM supplier JOIN nation ON s_nationkey = n_nationkey
  UNION ALL
  SELECT CAST(-1 - n_nationkey AS INTEGER), n_name, NULL, NULL FROM nation
)"""

BRANCHES = f"""{RAW_BRANCHES},
branches AS (
  SELECT BRANCH_CODE, BRANCH_STATE,
         '(' || substr(BRANCH_PHONE, 1, 3) || ')' || substr(BRANCH_PHONE, 4, 3)
             || '-' || substr(BRANCH_PHONE, 7, 10) AS BRANCH_PHONE,
         coalesce(BRANCH_ZIP, '00000') AS BRANCH_ZIP
  FROM raw_branches
)"""


def transactions(name: str, source: str, key: str, owner: str, branch: str, kind: str,
                 amount: str, day: str) -> str:
    return f"""
{name} AS (
  SELECT {key} AS TRANSACTION_ID,
         CAST({owner} AS VARCHAR) AS CREDIT_CARD_NO,
         {owner} AS CUST_SSN,
         CAST({branch} AS INTEGER) AS BRANCH_CODE,
         {kind} AS TRANSACTION_TYPE,
         CAST({amount} AS DECIMAL(18,2)) AS TRANSACTION_VALUE,
         strftime({day}, '%Y%m%d') AS TIMEID
  FROM {source}
)"""


ORDERS = transactions("orders_t", "orders", "o_orderkey", "o_custkey", "o_orderkey % 1000",
                      "o_orderpriority", "o_totalprice", "o_orderdate")
EVENTS = transactions("events_t", "events", "event_id", "user_id", "event_id % 1000",
                      "event_type", "value", "ts")
LINES = transactions("lines_t", "lineitem", "l_orderkey", "l_partkey", "l_suppkey",
                     "l_returnflag", "l_extendedprice", "l_shipdate")


def customer_join(facts: str) -> str:
    return f"""
cust_t AS (
  SELECT c.CUST_ZIP, c.FIRST_NAME, c.LAST_NAME, t.BRANCH_CODE, t.CREDIT_CARD_NO, t.CUST_SSN,
         t.TIMEID, t.TRANSACTION_ID, t.TRANSACTION_TYPE, t.TRANSACTION_VALUE
  FROM customers c LEFT JOIN {facts} t ON c.CREDIT_CARD_NO = t.CREDIT_CARD_NO
)"""


def branch_join(facts: str) -> str:
    return f"""
branch_t AS (
  SELECT b.BRANCH_STATE, t.BRANCH_CODE, t.CREDIT_CARD_NO, t.CUST_SSN,
         t.TIMEID, t.TRANSACTION_ID, t.TRANSACTION_TYPE, t.TRANSACTION_VALUE
  FROM branches b LEFT JOIN {facts} t ON b.BRANCH_CODE = t.BRANCH_CODE
)"""


LOANS = """
loans AS (
  SELECT CASE WHEN l_linenumber % 2 = 1 THEN 'Male' ELSE 'Female' END AS Gender,
         CASE WHEN l_quantity > 25 THEN 'Yes' ELSE 'No' END AS Married,
         CASE WHEN l_linestatus = 'O' THEN 'Yes' ELSE 'No' END AS Self_Employed,
         CASE WHEN l_returnflag = 'R' THEN 'N' ELSE 'Y' END AS Application_Status
  FROM lineitem
)"""

UPDATES = f"""{CUSTOMERS},
updates AS (
  SELECT SSN AS seq, FIRST_NAME, LAST_NAME,
         ['CUST_PHONE', 'CUST_EMAIL', 'CREDIT_CARD_NO', 'FULL_STREET_ADDRESS', 'CUST_CITY',
          'CUST_STATE', 'CUST_ZIP', 'SSN', 'CUST_STATE', 'CUST_ZIP', 'SSN', 'FAX'
         ][SSN % 12 + 1] AS field,
         CASE SSN % 12
           WHEN 0 THEN '(212)555-' || lpad(CAST(SSN AS VARCHAR), 9, '0')
           WHEN 1 THEN 'new' || CAST(SSN AS VARCHAR) || '@example.com'
           WHEN 2 THEN lpad(CAST(SSN AS VARCHAR), 16, '4')
           WHEN 3 THEN CAST(SSN AS VARCHAR) || ' , Main Street'
           WHEN 4 THEN 'New ' || CUST_CITY
           WHEN 5 THEN 'NY'
           WHEN 6 THEN lpad(CAST(SSN % 100000 AS VARCHAR), 5, '0')
           WHEN 7 THEN '9' || lpad(CAST(SSN AS VARCHAR), 8, '0')
           WHEN 8 THEN 'Ohio'
           WHEN 9 THEN 'n/a'
           WHEN 10 THEN CASE WHEN SSN % 24 = 10 THEN '12345' ELSE lpad(CAST(SSN - 1 AS VARCHAR), 9, '0') END
           ELSE 'none' END AS new_value
  FROM customers
  UNION ALL
  SELECT -1 - s_suppkey, 'Nobody', s_name, 'CUST_CITY', 'Nowhere' FROM supplier
),
firsts AS (
  SELECT FIRST_NAME, LAST_NAME, min(SSN) AS SSN FROM customers GROUP BY ALL
),
judged AS (
  SELECT u.*, f.SSN AS SSN,
         CASE WHEN f.SSN IS NULL THEN 'name not found'
              WHEN field = 'FAX' THEN 'unknown field'
              WHEN field = 'CUST_STATE' AND length(new_value) <> 2
                THEN 'state must have 2 characters'
              WHEN field = 'CUST_ZIP' AND TRY_CAST(new_value AS INTEGER) IS NULL
                THEN 'zip must be a whole number'
              WHEN field = 'SSN' AND NOT regexp_full_match(new_value, '[0-9]{{9}}')
                THEN 'SSN must have 9 digits'
              WHEN field = 'SSN' AND TRY_CAST(new_value AS BIGINT) <> f.SSN
                   AND TRY_CAST(new_value AS BIGINT) IN (SELECT SSN FROM customers)
                THEN 'SSN already in use' END AS reason
  FROM updates u LEFT JOIN firsts f USING (FIRST_NAME, LAST_NAME)
),
latest AS (
  SELECT SSN, field, arg_max(new_value, seq) AS new_value
  FROM judged WHERE reason IS NULL GROUP BY ALL
),
edited AS (
  SELECT coalesce(TRY_CAST(max(new_value) FILTER (l.field = 'SSN') AS BIGINT), c.SSN) AS SSN,
         any_value(c.FIRST_NAME) AS FIRST_NAME,
         any_value(c.MIDDLE_NAME) AS MIDDLE_NAME,
         any_value(c.LAST_NAME) AS LAST_NAME,
         coalesce(max(new_value) FILTER (l.field = 'CREDIT_CARD_NO'),
                  any_value(c.CREDIT_CARD_NO)) AS CREDIT_CARD_NO,
         coalesce(max(new_value) FILTER (l.field = 'CUST_CITY'),
                  any_value(c.CUST_CITY)) AS CUST_CITY,
         coalesce(max(new_value) FILTER (l.field = 'CUST_STATE'),
                  any_value(c.CUST_STATE)) AS CUST_STATE,
         any_value(c.CUST_COUNTRY) AS CUST_COUNTRY,
         coalesce(TRY_CAST(max(new_value) FILTER (l.field = 'CUST_ZIP') AS INTEGER),
                  any_value(c.CUST_ZIP)) AS CUST_ZIP,
         coalesce(max(new_value) FILTER (l.field = 'CUST_PHONE'),
                  any_value(c.CUST_PHONE)) AS CUST_PHONE,
         coalesce(max(new_value) FILTER (l.field = 'CUST_EMAIL'),
                  any_value(c.CUST_EMAIL)) AS CUST_EMAIL,
         coalesce(max(new_value) FILTER (l.field = 'FULL_STREET_ADDRESS'),
                  any_value(c.FULL_STREET_ADDRESS)) AS FULL_STREET_ADDRESS
  FROM customers c LEFT JOIN latest l ON l.SSN = c.SSN
  GROUP BY c.SSN
)"""

EDITED = f"WITH {UPDATES} SELECT * FROM edited"


def as_double(source: str) -> str:
    return f"SELECT * REPLACE (CAST(TRANSACTION_VALUE AS DOUBLE) AS TRANSACTION_VALUE) FROM {source}"


CUST_T = f"{CUSTOMERS}, {ORDERS}, {customer_join('orders_t')}"
BRANCH_T = f"{BRANCHES}, {LINES}, {branch_join('lines_t')}"
TOTAL = "CAST(coalesce(sum(TRANSACTION_VALUE), 0) AS DOUBLE) AS total_value"
COUNT_TOTAL = f"count(TRANSACTION_ID) AS transactions, {TOTAL}"

GOOD_AND_BAD = f"""
        WITH {RAW_CUSTOMERS}
        SELECT SSN, TRY_CAST(CUST_ZIP AS INTEGER) AS CUST_ZIP,
               CASE WHEN TRY_CAST(CUST_ZIP AS INTEGER) IS NULL THEN 'CUST_ZIP' END AS bad_column
        FROM raw_customers"""

DAMAGED = f"""
        WITH {RAW_CUSTOMERS}
        SELECT CASE WHEN SSN % 10 = 3 THEN 'S' || SSN ELSE CAST(SSN AS VARCHAR) END AS SSN,
               CASE WHEN SSN % 10 <> 7 THEN 'day ' || SSN END AS LAST_UPDATED,
               CASE SSN % 10 WHEN 3 THEN 'SSN' WHEN 7 THEN 'broken' ELSE '' END AS problem
        FROM raw_customers"""

ORACLE = {
    "customer_zip_int": f"""
        WITH {RAW_CUSTOMERS}
        SELECT SSN, TRY_CAST(CUST_ZIP AS INTEGER) AS CUST_ZIP FROM raw_customers""",
    "customer_rejected_zips": f"""
        WITH {RAW_CUSTOMERS}
        SELECT SSN, CUST_ZIP FROM raw_customers WHERE TRY_CAST(CUST_ZIP AS INTEGER) IS NULL""",
    "customer_first_title": f"""
        WITH {RAW_CUSTOMERS}
        SELECT SSN, {title('FIRST_NAME')} AS FIRST_NAME FROM raw_customers""",
    "customer_middle_lower": f"""
        WITH {RAW_CUSTOMERS} SELECT SSN, lower(MIDDLE_NAME) AS MIDDLE_NAME FROM raw_customers""",
    "customer_last_title": f"""
        WITH {RAW_CUSTOMERS}
        SELECT SSN, {title('LAST_NAME')} AS LAST_NAME FROM raw_customers""",
    "part_name_title": f"""
        WITH labels_of_parts AS (
          SELECT p_partkey, p_name || '''' || p_type || '-' || p_brand AS label FROM part)
        SELECT p_partkey, {title('label')} AS title FROM labels_of_parts""",
    "customer_full_address": f"""
        WITH {RAW_CUSTOMERS}
        SELECT SSN, APT_NO || ' , ' || STREET_NAME AS FULL_STREET_ADDRESS FROM raw_customers""",
    "customer_phone_format": f"""
        WITH {RAW_CUSTOMERS} SELECT SSN, {phone('CUST_PHONE')} AS CUST_PHONE FROM raw_customers""",
    "clean_customers": f"WITH {CUSTOMERS} SELECT * FROM customers",
    "branch_phone_format": f"WITH {BRANCHES} SELECT BRANCH_CODE, BRANCH_PHONE FROM branches",
    "branch_zip_default": f"WITH {BRANCHES} SELECT BRANCH_CODE, BRANCH_ZIP FROM branches",
    "clean_branches": f"WITH {BRANCHES} SELECT * FROM branches",
    "transaction_pad_date_parts": """
        SELECT o_orderkey AS TRANSACTION_ID, strftime(o_orderdate, '%d') AS "DAY",
               strftime(o_orderdate, '%m') AS "MONTH"
        FROM orders""",
    "transaction_timeid": f"WITH {ORDERS} SELECT TRANSACTION_ID, TIMEID FROM orders_t",
    "transaction_date": """
        SELECT o_orderkey AS TRANSACTION_ID, CAST(o_orderdate AS DATE) AS TRANSACTION_DATE
        FROM orders""",
    "transaction_date_parts": """
        SELECT o_orderkey AS TRANSACTION_ID, strftime(o_orderdate, '%Y') AS "YEAR",
               strftime(o_orderdate, '%m') AS "MONTH", strftime(o_orderdate, '%d') AS "DAY",
               strftime(o_orderdate, '%Y%m') AS YEAR_MONTH
        FROM orders""",
    "clean_transactions": f"WITH {LINES} {as_double('lines_t')}",
    "join_customer_transactions": f"WITH {CUST_T} {as_double('cust_t')}",
    "join_customer_transactions_idle": f"""
        WITH {CUSTOMERS}, {EVENTS}, {customer_join('events_t')} {as_double('cust_t')}""",
    "join_branch_transactions": f"WITH {BRANCH_T} {as_double('branch_t')}",
    "transactions_by_zip_month": f"""
        WITH {CUST_T} {as_double('cust_t')}
        WHERE CUST_ZIP = 7 AND substr(TIMEID, 5, 2) = '11' AND substr(TIMEID, 1, 4) = '1998'
        ORDER BY substr(TIMEID, 7, 2) DESC, TRANSACTION_ID""",
    "type_count_total": f"""
        WITH {ORDERS} SELECT {COUNT_TOTAL} FROM orders_t WHERE TRANSACTION_TYPE = '1-URGENT'""",
    "type_count_total_all": f"""
        WITH {LINES} SELECT TRANSACTION_TYPE, {COUNT_TOTAL} FROM lines_t GROUP BY 1""",
    "state_count_total": f"""
        WITH {BRANCH_T} SELECT {COUNT_TOTAL} FROM branch_t WHERE BRANCH_STATE = 'NATION_15'""",
    "branch_count_total_by_state": f"""
        WITH {BRANCH_T}
        SELECT BRANCH_CODE, {COUNT_TOTAL} FROM branch_t
        WHERE BRANCH_STATE = 'NATION_15' AND BRANCH_CODE IS NOT NULL GROUP BY 1""",
    "account_details": f"""
        WITH {CUSTOMERS}
        SELECT * FROM customers
        WHERE FIRST_NAME = 'Household' AND LAST_NAME = 'Nation_2-O''Household0'
        ORDER BY SSN LIMIT 1""",
    "account_details_all": f"""
        WITH {CUSTOMERS}
        SELECT * FROM customers
        QUALIFY row_number() OVER (PARTITION BY FIRST_NAME, LAST_NAME ORDER BY SSN) = 1""",
    "account_details_view": f"""
        WITH {CUSTOMERS}
        SELECT concat_ws(' ', FIRST_NAME, MIDDLE_NAME, LAST_NAME) AS CUSTOMER_NAME,
               CUST_PHONE, CUST_EMAIL, CREDIT_CARD_NO, CUST_COUNTRY,
               concat_ws(' ', FULL_STREET_ADDRESS, CUST_CITY, CUST_STATE, CUST_ZIP)
                 AS CUSTOMER_ADDRESS,
               SSN
        FROM customers""",
    "monthly_bill": f"""
        WITH {ORDERS}
        SELECT {TOTAL} FROM orders_t
        WHERE CREDIT_CARD_NO = '330' AND substr(TIMEID, 1, 6) = '199901'""",
    "monthly_bills_all": f"""
        WITH {ORDERS}
        SELECT CREDIT_CARD_NO, substr(TIMEID, 1, 6) AS YEAR_MONTH, {TOTAL}
        FROM orders_t GROUP BY 1, 2""",
    "transactions_between": f"""
        WITH {CUST_T} {as_double('cust_t')}
        WHERE FIRST_NAME = 'Household' AND LAST_NAME = 'Nation_2-O''Household0'
          AND TIMEID BETWEEN '19960101' AND '20001231'
        ORDER BY substr(TIMEID, 1, 6) DESC""",
    "match_updates": f"""
        WITH {UPDATES}
        SELECT FIRST_NAME, LAST_NAME, seq, field, new_value, SSN
        FROM judged WHERE SSN IS NOT NULL""",
    "unmatched_updates": f"""
        WITH {UPDATES}
        SELECT FIRST_NAME, LAST_NAME, seq, field, new_value FROM judged WHERE SSN IS NULL""",
    "rejected_updates": f"""
        WITH {UPDATES}
        SELECT FIRST_NAME, LAST_NAME, seq, field, new_value, reason
        FROM judged WHERE reason IS NOT NULL""",
    "apply_updates": EDITED,
    "type_counts": f"""
        WITH {ORDERS}
        SELECT TRANSACTION_TYPE, count(TRANSACTION_ID) AS transactions
        FROM orders_t GROUP BY 1 ORDER BY 2, 1""",
    "top_type": f"""
        WITH {ORDERS}
        SELECT TRANSACTION_TYPE, count(TRANSACTION_ID) AS transactions
        FROM orders_t GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1""",
    "customers_per_state": f"""
        WITH {CUSTOMERS},
        counts AS (SELECT CUST_STATE, count(CREDIT_CARD_NO) AS customers FROM customers GROUP BY 1)
        SELECT CUST_STATE, customers, customers = (SELECT max(customers) FROM counts) AS highlight
        FROM counts ORDER BY 2, 1""",
    "top_state": f"""
        WITH {CUSTOMERS}
        SELECT CUST_STATE, count(CREDIT_CARD_NO) AS customers
        FROM customers GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1""",
    "customer_totals": f"""
        WITH {ORDERS}
        SELECT CUST_SSN, {TOTAL} FROM orders_t GROUP BY 1 ORDER BY 2 DESC, 1""",
    "top_customers": f"""
        WITH {ORDERS}
        SELECT CUST_SSN, {TOTAL},
               row_number() OVER (ORDER BY sum(TRANSACTION_VALUE) DESC, CUST_SSN) = 1 AS highlight
        FROM orders_t GROUP BY 1 ORDER BY sum(TRANSACTION_VALUE) DESC, 1 LIMIT 10""",
    "top_customer": f"""
        WITH {ORDERS}
        SELECT CUST_SSN, {TOTAL} FROM orders_t GROUP BY 1
        ORDER BY sum(TRANSACTION_VALUE) DESC, 1 LIMIT 1""",
    "month_totals": f"""
        WITH {LINES}
        SELECT CAST(substr(TIMEID, 5, 2) AS INTEGER) AS "month", {TOTAL},
               row_number() OVER (ORDER BY sum(TRANSACTION_VALUE) DESC) <= 3 AS highlight
        FROM lines_t GROUP BY 1 ORDER BY 2 DESC""",
    "top_months": f"""
        WITH {LINES}
        SELECT CAST(substr(TIMEID, 5, 2) AS INTEGER) AS "month", {TOTAL}
        FROM lines_t GROUP BY 1 ORDER BY sum(TRANSACTION_VALUE) DESC LIMIT 3""",
    "branch_totals_for_type": f"""
        WITH {BRANCH_T},
        totals AS (SELECT BRANCH_CODE, sum(TRANSACTION_VALUE) AS total FROM branch_t
                   WHERE TRANSACTION_TYPE = 'R' GROUP BY 1)
        SELECT BRANCH_CODE, CAST(total AS DOUBLE) AS total_value,
               total = (SELECT max(total) FROM totals) AS highlight
        FROM totals ORDER BY 2 DESC, 1""",
    "top_branch_for_type": f"""
        WITH {BRANCH_T},
        totals AS (SELECT BRANCH_CODE, sum(TRANSACTION_VALUE) AS total FROM branch_t
                   WHERE TRANSACTION_TYPE = 'R' GROUP BY 1)
        SELECT BRANCH_CODE, CAST(total AS DOUBLE) AS total_value
        FROM totals WHERE total = (SELECT max(total) FROM totals)""",
    "pct_self_employed_approved": f"""
        WITH {LOANS},
        share AS (SELECT CAST(count(*) FILTER (Self_Employed = 'Yes' AND Application_Status = 'Y')
                              AS DOUBLE) / count(*) * 100 AS approved_pct FROM loans)
        SELECT approved_pct, 100 - approved_pct AS other_pct FROM share""",
    "approval_rate_self_employed": f"""
        WITH {LOANS},
        share AS (SELECT CAST(count(*) FILTER (Application_Status = 'Y') AS DOUBLE)
                         / nullif(count(*), 0) * 100 AS approved_pct
                  FROM loans WHERE Self_Employed = 'Yes')
        SELECT approved_pct, 100 - approved_pct AS other_pct FROM share""",
    "pct_rejected_married_male": f"""
        WITH {LOANS},
        share AS (SELECT CAST(count(*) FILTER (Application_Status = 'N') AS DOUBLE)
                         / nullif(count(*), 0) * 100 AS rejected_pct
                  FROM loans WHERE Gender = 'Male' AND Married = 'Yes')
        SELECT rejected_pct, 100 - rejected_pct AS other_pct FROM share""",
    "rejected_days": f"""
        WITH {LINES},
        moved AS (SELECT substr(TIMEID, 1, 6) || '31' AS TIMEID, TRANSACTION_VALUE FROM lines_t)
        SELECT TIMEID, count(*) AS transactions, {TOTAL} FROM moved
        WHERE substr(TIMEID, 5, 2) IN ('02', '04', '06', '09', '11') GROUP BY 1""",
    "rejected_amounts": """
        SELECT event_id AS TRANSACTION_ID, round(value, 2) / 8 AS TRANSACTION_VALUE FROM events
        WHERE CAST(CAST(round(value, 2) / 8 AS DECIMAL(18,2)) AS DOUBLE) <> round(value, 2) / 8""",
    "customers_json": f"WITH {CUSTOMERS} SELECT * FROM customers",
    "branches_json": f"WITH {BRANCHES} SELECT * FROM branches",
    "customer_transactions_json": f"WITH {CUST_T} {as_double('cust_t')}",
    "branch_transactions_json": f"WITH {BRANCH_T} {as_double('branch_t')}",
    "json_array_multiline": DAMAGED,
    "json_array_indent2": DAMAGED,
    "json_array_one_line": f"""
        WITH {RAW_CUSTOMERS}, noted AS (
          SELECT *, 'say "x\\" }}, {{"SSN": 0 }}] ' || SSN AS NOTE FROM raw_customers
        )
        SELECT CASE WHEN SSN % 10 = 3 THEN 'S' || SSN ELSE CAST(SSN AS VARCHAR) END AS SSN, CUST_ZIP, NOTE,
               '{{"BY":' || SSN || ',"IN":[{{"}}":' || to_json(NOTE) || '}}]}}' AS SEEN,
               CASE WHEN SSN % 10 = 3 THEN 'SSN' ELSE '' END AS problem
        FROM noted""",
    "json_all_columns": f"""
        WITH {CUSTOMERS} SELECT *, 'day ' || SSN AS SINCE FROM customers""",
    "load_changed_values": f"""
        WITH {RAW_CUSTOMERS}, amounts AS (
          SELECT o_orderkey AS id, CASE WHEN o_orderkey % 50 = 7 THEN 1e30 WHEN o_orderkey % 10 = 7 THEN o_totalprice + 0.003 ELSE o_totalprice END AS value
          FROM orders
        ), stored AS (
          SELECT *, CAST(CASE WHEN value < 1e16 THEN CAST(value AS DECIMAL(18, 2)) END AS DOUBLE) AS stored FROM amounts
        )
        SELECT 'amount' AS kind, id, value, stored FROM stored WHERE stored IS DISTINCT FROM value
        UNION ALL
        SELECT 'zip', SSN, NULL, NULL FROM raw_customers WHERE TRY_CAST(CUST_ZIP AS INTEGER) IS NULL""",
    "incremental_load": f"""
        WITH {ORDERS}, stored AS (SELECT *, substr(TIMEID, 1, 6) AS YEAR_MONTH FROM orders_t)
        {as_double('stored')}""",
    "incremental_load_join": f"""
        WITH {CUST_T}, stored AS (SELECT *, substr(TIMEID, 1, 6) AS YEAR_MONTH FROM cust_t)
        {as_double('stored')}""",
    "load_rejects": f"""
        WITH {RAW_CUSTOMERS}
        SELECT 'customers' AS rejected_from, CASE WHEN SSN % 10 = 3 THEN 'SSN' ELSE '' END AS bad_columns,
               CASE WHEN SSN % 10 = 7 THEN left('{{"SSN":"' || SSN || '","FIRST_NAME":"' || FIRST_NAME, 20) END
                 AS _corrupt_record,
               CASE WHEN SSN % 10 = 3 THEN 'S' || SSN END AS SSN
        FROM raw_customers WHERE SSN % 10 IN (3, 7)""",
    "clean_customers_all_columns": f"""
        WITH {CUSTOMERS} SELECT *, 'day ' || SSN AS LAST_UPDATED FROM customers""",
    "loans_all_columns": """
        SELECT CASE WHEN l_linenumber % 2 = 1 THEN 'Male' ELSE 'Female' END AS Gender,
               CASE WHEN l_quantity > 25 THEN 'Yes' ELSE 'No' END AS Married,
               CASE WHEN l_linestatus = 'O' THEN 'Yes' ELSE 'No' END AS Self_Employed,
               CASE WHEN l_returnflag = 'R' THEN 'N' ELSE 'Y' END AS Application_Status,
               'LP' || l_orderkey || '-' || l_linenumber AS Application_ID, l_quantity AS Quantity
        FROM lineitem""",
    "json_round_trip": f"WITH {ORDERS} {as_double('orders_t')}",
    "json_permissive": GOOD_AND_BAD,
    "json_indented_array": GOOD_AND_BAD,
    "loans_json": f"""
        WITH {LOANS}
        SELECT Gender, Married, Self_Employed, Application_Status, count(*) AS applications
        FROM loans GROUP BY ALL""",
    "temp_view_sql": f"""
        WITH {CUSTOMERS}, {ORDERS}
        SELECT c.CUST_STATE, count(t.TRANSACTION_ID) AS transactions,
               CAST(sum(t.TRANSACTION_VALUE) AS DOUBLE) AS total_value
        FROM customers c JOIN orders_t t ON c.CREDIT_CARD_NO = t.CREDIT_CARD_NO GROUP BY 1""",
    "stored_customer_transactions": f"""
        WITH {CUST_T},
        stored AS (SELECT *, substr(TIMEID, 1, 6) AS YEAR_MONTH FROM cust_t)
        {as_double('stored')}""",
    "stored_branch_transactions": f"""
        WITH {BRANCHES}, {ORDERS}, {branch_join('orders_t')},
        stored AS (SELECT *, substr(TIMEID, 1, 6) AS YEAR_MONTH FROM branch_t)
        {as_double('stored')}""",
    "publish_customers": EDITED,
}

_KEPT = ("transactions_by_zip_month", "transactions_between", "monthly_bill", "account_details", "monthly_bills_all", "customer_totals", "type_counts")
for _name in _KEPT:
    ORACLE[f"stored_{_name}"] = ORACLE[_name]
ORACLE["stored_state_count_total"] = f"""
        WITH {BRANCHES}, {ORDERS}, {branch_join('orders_t')}
        SELECT {COUNT_TOTAL} FROM branch_t WHERE BRANCH_STATE = 'NATION_15'"""

ORACLE["stored_type_count_total_all"] = f"WITH {ORDERS} SELECT TRANSACTION_TYPE, {COUNT_TOTAL} FROM orders_t GROUP BY 1"
ORACLE["stored_month_totals"] = f"""
        WITH {ORDERS}
        SELECT CAST(substr(TIMEID, 5, 2) AS INTEGER) AS "month", {TOTAL},
               row_number() OVER (ORDER BY sum(TRANSACTION_VALUE) DESC) <= 3 AS highlight
        FROM orders_t GROUP BY 1"""
ORACLE["stored_branch_totals_for_type"] = f"""
        WITH {BRANCHES}, {ORDERS}, {branch_join('orders_t')},
        totals AS (SELECT BRANCH_CODE, sum(TRANSACTION_VALUE) AS total FROM branch_t
                   WHERE TRANSACTION_TYPE = '1-URGENT' GROUP BY 1)
        SELECT BRANCH_CODE, CAST(total AS DOUBLE) AS total_value, total = (SELECT max(total) FROM totals) AS highlight
        FROM totals"""
ORACLE["publish_joined"] = f"""
        WITH {UPDATES}, {ORDERS}, {customer_join('orders_t').replace('FROM customers c', 'FROM edited c')},
        stored AS (SELECT *, substr(TIMEID, 1, 6) AS YEAR_MONTH FROM cust_t)
        {as_double('stored')}"""
