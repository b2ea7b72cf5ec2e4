"""The same results in plain SQL, written without the package's operators."""

from __future__ import annotations

from .tables import DATA_DATE, LOAD_DAYS

ORACLES: dict[str, str] = {}

DAY1, DAY2, DAY3 = LOAD_DAYS
MONEY = "DECIMAL(12,2)"
NEVER = "CAST(NULL AS TIMESTAMP)"
BOOK_COLUMNS = "o_orderkey, o_custkey, o_orderpriority, total_price, stage, settled_on"


def _book(day: str) -> str:
    age = f"date_diff('day', CAST(o_orderdate AS DATE), DATE '{day}')"
    return f"""(
        SELECT o_orderkey, o_custkey, o_orderpriority,
               CAST(CAST(o_totalprice AS {MONEY}) AS DOUBLE) AS total_price,
               CASE WHEN {age} <= 30 THEN 'NEW' WHEN {age} > 120 THEN 'SETTLED'
                    ELSE 'DUE' END AS stage,
               CASE WHEN {age} > 120 THEN CAST(o_orderdate AS DATE) + 120 END AS settled_on
        FROM orders
        WHERE o_orderdate < DATE '{day}' + INTERVAL 1 DAY
          AND o_orderdate >= DATE '{day}' - INTERVAL 72 MONTH)"""


_BOOKS = f"WITH old AS {_book(DAY1)}, new AS {_book(DAY2)}, third AS {_book(DAY3)}"


def _row(side: str) -> str:
    return ", ".join(f"{side}.{c.strip()}" for c in BOOK_COLUMNS.split(","))


def _differ(a: str, b: str) -> str:
    columns = [c.strip() for c in BOOK_COLUMNS.split(",")][1:]
    return "(" + " OR ".join(f"{a}.{c} IS DISTINCT FROM {b}.{c}" for c in columns) + ")"


# -- sources and sinks --------------------------------------------------------

ORACLES["src_csv"] = "SELECT * FROM orders"
ORACLES["src_columnar"] = "SELECT * FROM orders"
ORACLES["src_table"] = "SELECT * FROM part"
ORACLES["src_cached"] = """
    SELECT c_mktsegment, count(*) AS customers, (SELECT count(*) FROM customer) AS total
    FROM customer GROUP BY c_mktsegment"""
ORACLES["sink_overwrite"] = "SELECT * FROM part"
ORACLES["sink_append"] = "SELECT * FROM part UNION ALL SELECT * FROM part"
ORACLES["sink_table"] = "SELECT * FROM part"
ORACLES["sink_rerun"] = f"""
    SELECT *, DATE '{DAY1}' AS data_date FROM orders
    UNION ALL SELECT *, DATE '{DAY2}' FROM orders WHERE o_orderstatus = 'F'"""
ORACLES["sink_partitioned"] = f"SELECT *, DATE '{DAY2}' AS data_date FROM orders"
ORACLES["sink_text_partitions"] = """
    SELECT p_partkey, p_name,
           CASE WHEN p_size % 7 = 0 THEN '' ELSE lpad(CAST(p_size AS VARCHAR), 4, '0') END AS p_code
    FROM part"""
ORACLES["pipeline_config"] = f"""
    SELECT c_mktsegment, count(*) AS orders,
           CAST(sum(CAST(o_totalprice AS {MONEY})) AS DOUBLE) AS value
    FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY c_mktsegment"""

# -- filters, expressions -----------------------------------------------------

ORACLES["filter_prev_day"] = """
    SELECT event_id, ts, user_id, event_type FROM events
    WHERE CAST(ts AS DATE) = DATE '2024-01-16' - 1"""
ORACLES["filter_month"] = f"""
    SELECT o_orderkey, o_custkey, o_orderdate FROM orders
    WHERE date_trunc('month', o_orderdate) = date_trunc('month', DATE '{DATA_DATE}' - 1)"""
ORACLES["filter_compare"] = """
    SELECT * FROM customer
    WHERE c_acctbal > 5000 AND (c_mktsegment = 'BUILDING' OR c_nationkey <= 4)"""
ORACLES["filter_like"] = "SELECT * FROM part WHERE p_name LIKE '%ing%'"
ORACLES["filter_in"] = "SELECT * FROM part WHERE p_type IN ('ECONOMY', 'PROMO')"
ORACLES["month_bounds"] = """
    SELECT DISTINCT CAST(o_orderdate AS DATE) AS order_day,
           CAST(o_orderdate AS DATE) - 1 AS previous_day,
           CAST(date_trunc('month', CAST(o_orderdate AS DATE) - 1) AS DATE) AS month_start,
           last_day(CAST(o_orderdate AS DATE) - 1) AS month_end
    FROM orders"""
ORACLES["row_hash"] = f"""
    SELECT c_custkey, sha256(concat_ws('.', c_name, c_mktsegment, c_nationkey,
                                       CAST(c_acctbal AS {MONEY}))) AS hash_data
    FROM customer"""
_ACCOUNT_TYPE = """CASE c_mktsegment WHEN 'BUILDING' THEN 'Premium'
    WHEN 'MACHINERY' THEN 'Standard' ELSE c_mktsegment END"""
ORACLES["customer_category"] = f"""
    WITH spent AS (
        SELECT o_custkey, sum(CAST(o_totalprice AS {MONEY})) AS spent,
               max(CAST(o_totalprice AS {MONEY})) AS loaned
        FROM orders GROUP BY o_custkey),
    who AS (SELECT c_custkey, {_ACCOUNT_TYPE} AS t FROM customer)
    SELECT c_custkey AS "CustomerID", t AS "AccountType", CAST(spent AS DOUBLE) AS spent,
           CASE WHEN t = 'Premium' THEN 'High Value Customer'
                WHEN t = 'Standard' AND (spent > 1000 OR loaned > 50000)
                THEN 'Potential High Value Customer'
                ELSE 'Regular Customer' END AS "CustomerCategory"
    FROM who LEFT JOIN spent ON c_custkey = o_custkey"""

# -- joins, unions ------------------------------------------------------------

ORACLES["join_customer_orders"] = """
    SELECT c_custkey AS customer_id, customer.* EXCLUDE (c_custkey), orders.* EXCLUDE (o_custkey)
    FROM customer JOIN orders ON c_custkey = o_custkey"""
_SIDES = """
    WITH l AS (SELECT c_custkey AS key, c_name FROM customer),
         r AS (SELECT user_id AS key, event_id, event_type FROM events)"""
for _how in ("inner", "left", "right", "full"):
    ORACLES[f"join_generic_{_how}"] = f"""{_SIDES}
    SELECT l.key AS left_key, c_name, r.key AS right_key, event_id, event_type
    FROM l {_how.upper()} JOIN r ON l.key = r.key"""
ORACLES["join_generic_semi"] = f"{_SIDES} SELECT * FROM l WHERE key IN (SELECT key FROM r)"
ORACLES["join_generic_anti"] = f"""{_SIDES}
    SELECT * FROM l WHERE NOT EXISTS (SELECT 1 FROM r WHERE r.key = l.key)"""
ORACLES["union_by_name"] = f"""
    SELECT c_name AS name, c_nationkey AS nation, c_mktsegment AS segment,
           CAST(NULL AS DOUBLE) AS balance FROM customer
    UNION ALL
    SELECT s_name, s_nationkey, NULL, CAST(CAST(s_acctbal AS {MONEY}) AS DOUBLE) FROM supplier"""

# -- reports ------------------------------------------------------------------

_TOTALS = f"""
    SELECT l_orderkey AS "OrderID",
           sum(CAST(l_quantity AS DECIMAL(5,2)) * CAST(l_extendedprice AS {MONEY})) AS total
    FROM lineitem GROUP BY l_orderkey"""
ORACLES["order_totals"] = f"""
    SELECT "OrderID", CAST(total AS DOUBLE) AS "TotalOrderValue" FROM ({_TOTALS})"""
ORACLES["orders_value_range"] = f"""
    SELECT "OrderID", CAST(total AS DOUBLE) AS "TotalOrderValue"
    FROM orders JOIN ({_TOTALS}) ON o_orderkey = "OrderID"
    WHERE total BETWEEN 100000 AND 500000"""
ORACLES["customers_multi_city"] = """
    SELECT c_name AS "CustomerName", count(DISTINCT s_nationkey) AS "DistinctCitiesCount"
    FROM customer JOIN orders ON c_custkey = o_custkey
    JOIN lineitem ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey
    GROUP BY c_custkey, c_name HAVING count(DISTINCT s_nationkey) >= 3"""
ORACLES["products_above_avg"] = f"""
    WITH p AS (SELECT p_name, CAST(p_retailprice AS {MONEY}) AS price FROM part)
    SELECT p_name AS "ProductName", CAST(price AS DOUBLE) AS "Price" FROM p
    WHERE CAST(price AS DOUBLE) > (SELECT CAST(sum(price) AS DOUBLE) / count(price) FROM p)"""

_LOANS = f"""
    SELECT o_orderkey AS loan, o_custkey AS cust, CAST(o_totalprice AS {MONEY}) AS amount,
           CAST(substr(o_orderpriority, 1, 1) AS DECIMAL(4,2)) AS rate, o_orderdate AS started
    FROM orders"""
_IN_MONTH = f"""date_trunc('month', {{}}) = date_trunc('month', DATE '{DATA_DATE}' - 1)"""
_PAID_IN_MONTH = f"""CASE WHEN {_IN_MONTH.format("l_shipdate")}
    THEN CAST(l_extendedprice AS {MONEY}) ELSE 0 END"""
_SUMMARY = """
    SELECT cust AS "CustomerID", CAST(sum(amount) AS DOUBLE) AS "TotalLoanAmount",
           CAST(sum(rate) AS DOUBLE) / count(rate) AS "AverageInterestRate",
           CAST(coalesce(sum(paid), 0) AS DOUBLE) AS "TotalLoanPayments",
           CAST(sum(amount) - coalesce(sum(paid), 0) AS DOUBLE) AS "RemainingLoanAmount",
           count(loan) AS "TotalLoans"
    FROM {source} GROUP BY cust"""
_PER_LOAN = f"(SELECT l_orderkey, sum({_PAID_IN_MONTH}) AS paid FROM lineitem GROUP BY l_orderkey)"
ORACLES["loan_summary"] = _SUMMARY.format(
    source=f"({_LOANS}) LEFT JOIN {_PER_LOAN} ON loan = l_orderkey"
)
ORACLES["loan_summary_fanout"] = _SUMMARY.format(
    source=f"({_LOANS}) LEFT JOIN (SELECT l_orderkey, {_PAID_IN_MONTH} AS paid FROM lineitem) "
    "ON loan = l_orderkey"
)
_MONTHLY = f"""
    WITH cust AS (
        SELECT c_custkey, c_name, {_ACCOUNT_TYPE} AS account_type, n_name, r_name,
               CAST(c_acctbal AS {MONEY}) AS balance
        FROM customer JOIN nation ON c_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey
        WHERE r_name LIKE '%A%' AND CAST(c_acctbal AS {MONEY}) > 1000
          AND (SELECT min(o_orderdate) FROM orders WHERE o_custkey = c_custkey)
              < DATE '{DATA_DATE}' + INTERVAL 1 DAY),
    loans AS ({_LOANS}),
    owed AS (
        SELECT cust, sum(amount) AS amount, CAST(sum(rate) AS DOUBLE) / count(rate) AS rate,
               coalesce(sum(paid), 0) AS paid
        FROM (SELECT * FROM loans WHERE amount > 5000
                AND CAST(started AS DATE)
                    BETWEEN date_trunc('month', DATE '{DATA_DATE}' - 1) AND DATE '{DATA_DATE}' - 1)
        LEFT JOIN {_PER_LOAN} ON loan = l_orderkey
        GROUP BY cust),
    joined AS (
        SELECT c_custkey, c_name, account_type, n_name, r_name, balance, p_brand,
               owed.amount AS loaned, owed.rate, owed.paid, o_orderkey,
               CAST(l_extendedprice AS {MONEY}) AS spent
        FROM cust JOIN orders ON o_custkey = c_custkey
        JOIN lineitem ON l_orderkey = o_orderkey
        JOIN part ON l_partkey = p_partkey
        LEFT JOIN owed ON owed.cust = c_custkey
        WHERE {_IN_MONTH.format("o_orderdate")}
          AND CAST(l_extendedprice AS {MONEY}) > 100 AND p_type IN ('ECONOMY', 'PROMO')),
    grouped AS (
        SELECT c_custkey, c_name, account_type, n_name, r_name, balance, p_brand,
               loaned, rate, paid, sum(spent) AS spent, count(DISTINCT o_orderkey) AS transactions
        FROM joined GROUP BY ALL)
    SELECT c_custkey AS "CustomerID", c_name AS "Name",
           lower(c_name) || '@example.com' AS "Email", account_type AS "AccountType",
           n_name AS "BranchName", r_name AS "Location", CAST(balance AS DOUBLE) AS "Balance",
           p_brand AS "ServiceName", CAST(loaned AS DOUBLE) AS "TotalLoanAmount",
           rate AS "AverageInterestRate", CAST(paid AS DOUBLE) AS "TotalLoanPayments",
           CAST(loaned - paid AS DOUBLE) AS "RemainingLoanAmount",
           CAST(spent AS DOUBLE) AS "TotalTransactionAmount", transactions AS "TotalTransactions",
           CASE WHEN account_type = 'Premium' THEN 'High Value Customer'
                WHEN account_type = 'Standard' AND (spent > 1000 OR loaned > 50000)
                THEN 'Potential High Value Customer'
                ELSE 'Regular Customer' END AS "CustomerCategory"
    FROM grouped"""
ORACLES["monthly_customer_loans"] = _MONTHLY
_PAYMENTS = f"""(SELECT l_orderkey, {_PAID_IN_MONTH} AS paid FROM lineitem
    WHERE CAST(l_extendedprice AS {MONEY}) > 0)"""
ORACLES["monthly_customer_loans_literal"] = _MONTHLY.replace(
    "r_name LIKE '%A%' AND ", ""
).replace(_PER_LOAN, _PAYMENTS)

# -- slowly changing dimensions -----------------------------------------------

ORACLES["scd1_init"] = f"{_BOOKS} SELECT {BOOK_COLUMNS} FROM old"
ORACLES["scd1_merge"] = f"""{_BOOKS}
    SELECT {_row("new")} FROM new
    UNION ALL
    SELECT {_row("old")} FROM old
    WHERE NOT EXISTS (SELECT 1 FROM new WHERE new.o_orderkey = old.o_orderkey)"""
ORACLES["scd1_composite"] = """
    SELECT conv_id, turn, role,
           CASE WHEN role = 'assistant' THEN '[reviewed] ' || text ELSE text END AS text
    FROM conversations
    UNION ALL
    SELECT conv_id, max(turn) + 1, 'system', count(*) || ' turns'
    FROM conversations GROUP BY conv_id"""
ORACLES["scd1_evolve"] = """
    WITH a AS (SELECT o_custkey, max(o_orderpriority) AS top, count(*) AS n
               FROM orders GROUP BY o_custkey)
    SELECT coalesce(c_custkey, o_custkey) AS c_custkey, c_name,
           CASE WHEN o_custkey IS NULL THEN c_mktsegment ELSE top END AS c_mktsegment,
           n AS order_count
    FROM customer FULL JOIN a ON c_custkey = o_custkey"""

ORACLES["scd1_map"] = """
    WITH a AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey)
    SELECT coalesce(c_custkey, o_custkey) AS c_custkey,
           CASE WHEN o_custkey IS NULL THEN c_mktsegment END AS segment,
           CAST(n AS VARCHAR) AS orders
    FROM customer FULL JOIN a ON c_custkey = o_custkey"""
ORACLES["scd1_stored"] = ORACLES["scd1_merge"]

_CHANGED = f"(SELECT old.o_orderkey FROM old JOIN new USING (o_orderkey) WHERE {_differ('old', 'new')})"


def _version(side: str, start: str, end: str, current: str) -> str:
    return (
        f"SELECT {_row(side)}, {start} AS start_date, {end} AS end_date, "
        f"{current} AS is_current FROM {side}"
    )


def _at(day: str) -> str:
    return f"TIMESTAMP '{day}'"


def _second_load(insert_new: bool = True, expire_missing: bool = False) -> str:
    """Versions after two loads."""
    closed = f"old.o_orderkey IN {_CHANGED}"
    if expire_missing:
        closed = f"({closed} OR old.o_orderkey NOT IN (SELECT o_orderkey FROM new))"
    opened = f"new.o_orderkey IN {_CHANGED}"
    if insert_new:
        opened = f"({opened} OR new.o_orderkey NOT IN (SELECT o_orderkey FROM old))"
    return f"""
        {_version("old", _at(DAY1), _at(DAY2), "FALSE")} WHERE {closed}
        UNION ALL
        {_version("old", _at(DAY1), NEVER, "TRUE")} WHERE NOT ({closed})
        UNION ALL
        {_version("new", _at(DAY2), NEVER, "TRUE")} WHERE {opened}"""


ORACLES["scd2_init"] = f"{_BOOKS} {_version('old', _at(DAY1), NEVER, 'TRUE')}"
ORACLES["scd2_changed"] = f"{_BOOKS} SELECT o_orderkey FROM {_CHANGED}"
ORACLES["scd2_merge"] = f"{_BOOKS} {_second_load()}"
ORACLES["scd2_expire_missing"] = f"{_BOOKS} {_second_load(expire_missing=True)}"
ORACLES["scd2_no_new_keys"] = f"{_BOOKS} {_second_load(insert_new=False)}"
_THIRD = f"""{_BOOKS}, second AS ({_second_load()}),
    moved AS (SELECT s.o_orderkey FROM second s JOIN third USING (o_orderkey)
              WHERE s.is_current AND {_differ("s", "third")})
    SELECT {_row("second")}, start_date,
           CASE WHEN is_current AND o_orderkey IN (SELECT * FROM moved)
                THEN {_at(DAY3)} ELSE end_date END AS end_date,
           is_current AND o_orderkey NOT IN (SELECT * FROM moved) AS is_current
    FROM second
    UNION ALL
    {_version("third", _at(DAY3), NEVER, "TRUE")}
    WHERE o_orderkey IN (SELECT * FROM moved)
       OR o_orderkey NOT IN (SELECT o_orderkey FROM second)"""
ORACLES["scd2_third_load"] = _THIRD
ORACLES["scd2_stored"] = _THIRD


def _plain(side: str, start: str, end: str) -> str:
    return f"SELECT {_row(side)}, {start} AS start_date, {end} AS end_date FROM {side}"


_GONE = "o_orderkey NOT IN (SELECT o_orderkey FROM new)"
_FRESH = "o_orderkey NOT IN (SELECT o_orderkey FROM old)"
ORACLES["scd4_init"] = f"{_BOOKS} {_plain('old', _at(DAY1), NEVER)}"
ORACLES["scd4_history"] = f"""{_BOOKS}
    {_plain("old", _at(DAY1), NEVER)}
    UNION ALL
    {_plain("old", _at(DAY1), _at(DAY2))} WHERE {_GONE} OR o_orderkey IN {_CHANGED}"""
ORACLES["scd4_current"] = f"""{_BOOKS}
    {_plain("new", _at(DAY2), NEVER)} WHERE {_FRESH} OR o_orderkey IN {_CHANGED}
    UNION ALL
    {_plain("new", _at(DAY1), NEVER)} WHERE NOT ({_FRESH} OR o_orderkey IN {_CHANGED})"""
_LABELS = f"""
    SELECT coalesce(old.o_orderkey, new.o_orderkey) AS o_orderkey,
           CASE WHEN old.o_orderkey IS NULL THEN 'insert'
                WHEN new.o_orderkey IS NULL THEN 'delete'
                WHEN {_differ("old", "new")} THEN 'update' ELSE 'unchanged' END AS change
    FROM old FULL JOIN new ON old.o_orderkey = new.o_orderkey"""
ORACLES["scd4_classify"] = f"{_BOOKS} {_LABELS}"
ORACLES["scd_change_counts"] = f"""{_BOOKS}
    SELECT change, count(*) AS row_count FROM ({_LABELS}) GROUP BY change"""
_FEED = f"""
    SELECT {_row("old")}, 'delete' AS _change_type FROM old WHERE {_GONE}
    UNION ALL
    SELECT {_row("old")}, 'update_preimage' FROM old WHERE o_orderkey IN {_CHANGED}
    UNION ALL
    SELECT {_row("new")}, 'update_postimage' FROM new WHERE o_orderkey IN {_CHANGED}
    UNION ALL
    SELECT {_row("new")}, 'insert' FROM new WHERE {_FRESH}"""
ORACLES["change_feed"] = f"{_BOOKS} {_FEED}"
ORACLES["change_feed_apply"] = f"{_BOOKS} SELECT {BOOK_COLUMNS} FROM new"
ORACLES["change_feed_history"] = f"""{_BOOKS}
    SELECT {BOOK_COLUMNS}, {NEVER} AS end_date FROM old
    UNION ALL
    SELECT {BOOK_COLUMNS}, {_at(DAY2)} FROM ({_FEED})
    WHERE _change_type IN ('delete', 'update_preimage')"""

_SECOND_CHANGED = f"""(SELECT new.o_orderkey FROM new JOIN third USING (o_orderkey)
    WHERE {_differ('new', 'third')})"""
ORACLES["change_feed_versions"] = f"{_BOOKS} SELECT {BOOK_COLUMNS} FROM third"
ORACLES["change_feed_versions_history"] = f"""{_BOOKS}
    SELECT {BOOK_COLUMNS}, {_at(DAY3)} AS end_date FROM ({_FEED})
    WHERE _change_type IN ('delete', 'update_preimage')
    UNION ALL
    SELECT {_row("new")}, {_at(DAY3)} FROM new
    WHERE o_orderkey NOT IN (SELECT o_orderkey FROM third) OR o_orderkey IN {_SECOND_CHANGED}"""


def _pair(current: str, history: str) -> str:
    return f"""{_BOOKS},
    current AS ({current.removeprefix(_BOOKS)}),
    history AS ({history.removeprefix(_BOOKS)})
    SELECT *, 'current' AS part FROM current UNION ALL SELECT *, 'history' FROM history"""


ORACLES["change_feed_stored"] = _pair(ORACLES["scd4_current"], ORACLES["scd4_history"])
ORACLES["scd4_stored"] = ORACLES["change_feed_stored"]
ORACLES["change_feed_first"] = _pair(ORACLES["scd4_init"], ORACLES["scd4_init"])
ORACLES["scd2_unchanged"] = f"SELECT *, 1 AS loads FROM ({ORACLES['scd2_init']})"
ORACLES["scd4_unchanged"] = f"SELECT *, 1 AS loads FROM ({ORACLES['change_feed_first']})"

# -- readiness ----------------------------------------------------------------

ORACLES["gate_dependencies"] = """
    WITH log AS (SELECT 'job_' || user_id AS job_name, CAST(ts AS DATE) AS data_date, event_type FROM events),
         span AS (SELECT min(data_date) AS a, max(data_date) AS b FROM log),
         days AS (SELECT CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS data_date FROM span)
    SELECT job_name, data_date FROM (SELECT DISTINCT job_name FROM log), days
    EXCEPT SELECT job_name, data_date FROM log WHERE event_type = 'purchase'"""
ORACLES["gate_inputs"] = """
    WITH counted AS (
        SELECT 'events' AS input_name,
               count(*) FILTER (CAST(ts AS DATE) = DATE '2001-08-15') AS row_count FROM events
        UNION ALL
        SELECT 'orders', count(*) FILTER (CAST(o_orderdate AS DATE) = DATE '2001-08-15')
        FROM orders
        UNION ALL
        SELECT 'lineitem', count(*) FILTER (CAST(l_shipdate AS DATE) = DATE '2001-08-15')
        FROM lineitem)
    SELECT input_name, row_count, row_count > 0 AS ready FROM counted"""
