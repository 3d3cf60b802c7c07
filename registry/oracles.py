"""The expected result of each registered query, as SQL over the given tables.

The texts are written from the rules, not from the Spark code; averages are rounded half up in
integer arithmetic, and money leaves as double.
"""

from __future__ import annotations


NOW = "TIMESTAMP '2002-01-01 00:00:00'"
QUALITY_AS_OF = "TIMESTAMP '2001-11-04 12:00:00'"


def avg(total: str, count: str) -> str:
    """total / count rounded half up to two decimals; both are never negative."""
    cents = f"CAST({total} * 100 AS HUGEINT)"
    n = f"CAST({count} AS HUGEINT)"
    return f"CAST((2 * {cents} + {n}) // (2 * {n}) AS DOUBLE) / 100"


def pct(part: str, whole: str) -> str:
    """part / whole in percent, rounded half up to two decimals, 0 without a whole."""
    p, w = f"CAST({part} AS HUGEINT)", f"CAST({whole} AS HUGEINT)"
    return f"CASE WHEN {whole} = 0 THEN 0.0 ELSE CAST((20000 * {p} + {w}) // (2 * {w}) AS DOUBLE) / 100 END"


SALES_COLUMNS = [
    "transaction_id", "sale_date", "sale_hour", "customer_id", "customer_name", "product_id",
    "product_name", "category", "sub_category", "quantity", "unit_price", "discount_percentage",
    "discount_amount", "gross_amount", "net_amount", "profit_margin", "payment_method",
    "payment_category", "store_location", "region", "is_weekend", "is_holiday", "ingest_date",
]
MONEY = {"unit_price", "discount_percentage", "discount_amount", "gross_amount", "net_amount", "profit_margin"}
WHOLE = {"sale_hour", "quantity"}


def shown(columns, flags: str = "BIGINT") -> str:
    """Select list with the types results are compared in."""
    out = []
    for c in columns:
        kind = "DOUBLE" if c in MONEY else "BIGINT" if c in WHOLE else flags if c in ("is_weekend", "is_holiday") else None
        out.append(f"CAST({c} AS {kind}) AS {c}" if kind else c)
    return ", ".join(out)


CTES = {}

CTES["priced"] = """
SELECT *, CAST(p_retailprice AS DECIMAL(10,2)) AS unit_price,
  CAST(l_quantity AS INTEGER) AS real_quantity,
  CAST(CAST(p_retailprice AS DECIMAL(10,2)) * CAST(l_quantity AS INTEGER) AS DECIMAL(10,2)) AS gross_amount
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN part ON l_partkey = p_partkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
"""

CTES["bronze"] = """
SELECT 'TXN-' || l_orderkey || '-' || l_linenumber AS transaction_id,
  CAST(o_orderdate AS DATE) AS sale_date, CAST(l_orderkey % 24 AS INTEGER) AS sale_hour,
  CASE WHEN l_orderkey % 10 <> 0 THEN 'CUST' || c_custkey END AS customer_id, c_name AS customer_name,
  'PROD' || p_partkey AS product_id, p_name AS product_name, p_type AS category, p_brand AS sub_category,
  CASE WHEN l_orderkey % 20 = 1 THEN -999 ELSE real_quantity END AS quantity, unit_price,
  CAST(l_discount * 100 AS DECIMAL(5,2)) AS discount_percentage,
  CAST(round(gross_amount * CAST(l_discount AS DECIMAL(4,2)), 2) AS DECIMAL(10,2)) AS discount_amount,
  gross_amount,
  CAST(gross_amount - CAST(round(gross_amount * CAST(l_discount AS DECIMAL(4,2)), 2) AS DECIMAL(10,2)) AS DECIMAL(10,2)) AS net_amount,
  CAST(l_tax * 100 AS DECIMAL(5,2)) AS profit_margin, o_orderpriority AS payment_method,
  CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') THEN 'Online' ELSE 'Offline' END AS payment_category,
  n_name AS store_location, r_name AS region,
  CASE WHEN isodow(o_orderdate) >= 6 THEN 1 ELSE 0 END AS is_weekend, 0 AS is_holiday,
  CAST(l_shipdate AS DATE) AS ingest_date,
  'sales/ingest_date=' || strftime(l_shipdate, '%Y-%m-%d') || '/sales_' || r_name || '.parquet' AS source_file,
  l_orderkey * 8 + l_linenumber AS record_id,
  md5(strftime(l_shipdate, '%Y-%m-%d')) AS run_hash,
  'CUST' || c_custkey AS real_customer_id, real_quantity,
  l_shipdate, l_partkey, l_suppkey, l_extendedprice
FROM priced
"""

CTES["tagged"] = """
SELECT *, nullif(concat_ws(';', CASE WHEN customer_id IS NULL THEN 'null:customer_id' END,
  CASE WHEN quantity < 1 OR quantity > 1000 THEN 'range:quantity' END), '') AS error_reason,
  substr(run_hash, 1, 8) || '-' || substr(run_hash, 9, 4) || '-' || substr(run_hash, 13, 4) || '-'
    || substr(run_hash, 17, 4) || '-' || substr(run_hash, 21, 12) AS run_id
FROM bronze
"""

LATEST = "PARTITION BY transaction_id ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC"
EARLIEST = "PARTITION BY transaction_id ORDER BY l_shipdate, l_partkey, l_suppkey, l_extendedprice"

CTES["good"] = "SELECT *, CAST(ingest_date AS TIMESTAMP) AS processed_at FROM tagged WHERE error_reason IS NULL"
CTES["silver"] = f"SELECT * FROM good QUALIFY row_number() OVER ({LATEST}) = 1"


def json_text(customer: str, quantity: str) -> str:
    """A payload as JSON text, column by column."""
    parts = []
    for c in SALES_COLUMNS:
        source = {"customer_id": customer, "quantity": quantity}.get(c, c)
        if c in MONEY or c in WHOLE or c in ("is_weekend", "is_holiday"):
            value = f"CAST({source} AS VARCHAR)"
        else:
            value = f"'\"' || CAST({source} AS VARCHAR) || '\"'"
        parts.append(f"'\"{c}\":' || coalesce({value}, 'null')")
    return "'{' || " + " || ',' || ".join(parts) + " || '}'"


CTES["failed"] = f"""
SELECT *, l_suppkey % 3 = 0 AS corrected, l_suppkey % 11 = 5 AS broken, l_suppkey % 13 = 1 AS done,
  l_suppkey % 17 = 2 AS legacy, CAST((record_id % 8) % 5 AS INTEGER) AS retry_count,
  CAST(ingest_date AS TIMESTAMP) AS failed_at,
  CASE WHEN l_suppkey % 3 = 0 THEN real_customer_id ELSE customer_id END AS fixed_customer,
  CASE WHEN l_suppkey % 3 = 0 THEN real_quantity ELSE quantity END AS fixed_quantity
FROM tagged WHERE error_reason IS NOT NULL
"""

CTES["quarantine"] = f"""
SELECT *, record_id AS id, CASE WHEN broken THEN '{{' ELSE '' END || {json_text('fixed_customer', 'fixed_quantity')} AS payload,
  CASE WHEN done THEN 'remediation_dag' WHEN corrected THEN 'analyst' END AS corrected_by,
  CASE WHEN corrected THEN failed_at + INTERVAL 1 HOUR END AS corrected_at,
  done OR legacy AS replayed,
  CASE WHEN done THEN failed_at + INTERVAL 2 HOUR END AS replayed_at,
  CASE WHEN done THEN 'remediated' ELSE 'pending' END AS stored_status,
  CASE WHEN done OR legacy THEN 'remediated' ELSE 'pending' END AS remediation_status
FROM failed
"""

CTES["judged"] = """
SELECT *, remediation_status = 'pending' AND retry_count < 3 AS is_open,
  CASE WHEN broken THEN 'Parse error: malformed payload'
    WHEN fixed_customer IS NULL THEN 'Missing fields: [''customer_id'']'
    WHEN fixed_quantity <= 0 THEN 'Invalid quantity (<= 0)' END AS reject_reason
FROM quarantine
"""

CTES["settled"] = f"""
SELECT id, source_file, is_open, reject_reason, retry_count,
  is_open AND reject_reason IS NULL AS fixed, is_open AND reject_reason IS NOT NULL AS rejected,
  remediation_status = 'pending' AND retry_count >= 3 AS dead,
  CASE WHEN is_open AND reject_reason IS NOT NULL THEN error_reason || ' | Rejected: ' || reject_reason
    WHEN remediation_status = 'pending' AND retry_count >= 3
    THEN error_reason || ' | Dead-lettered after ' || retry_count || ' retries' ELSE error_reason END AS error_reason,
  CASE WHEN is_open AND reject_reason IS NULL THEN 'remediation_dag' WHEN is_open THEN 'auto_rejected'
    WHEN remediation_status = 'pending' THEN 'dead_letter_escalation' ELSE corrected_by END AS corrected_by,
  corrected_at,
  CASE WHEN remediation_status = 'pending' THEN TRUE ELSE replayed END AS replayed,
  CASE WHEN remediation_status = 'pending' THEN {NOW} ELSE replayed_at END AS replayed_at,
  CASE WHEN is_open AND reject_reason IS NULL THEN 'remediated' WHEN is_open THEN 'rejected'
    WHEN remediation_status = 'pending' THEN 'dead_letter' ELSE remediation_status END AS remediation_status
FROM judged
"""


def top_by(key: str, value: str, weight: str, table: str = "silver") -> str:
    """Heaviest value per key, the first name among equals."""
    return (
        f"SELECT {key}, {value} FROM (SELECT {key}, {value}, {weight} AS w FROM {table} GROUP BY 1, 2) "
        f"QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY w DESC, {value} ASC NULLS LAST) = 1"
    )


CTES["day_top"] = top_by("sale_date", "category", "sum(net_amount)")
CTES["store_top"] = top_by("store_location", "category", "sum(net_amount)")
CTES["cust_cat"] = top_by("customer_id", "category", "count(*)")
CTES["cust_pay"] = top_by("customer_id", "payment_method", "count(*)")
CTES["cust_store"] = top_by("customer_id", "store_location", "count(*)")

CTES["daily"] = f"""
SELECT s.*, t.category AS top_category FROM (
  SELECT sale_date, count(*) AS total_transactions, CAST(sum(quantity) AS BIGINT) AS total_quantity_sold,
    CAST(sum(gross_amount) AS DOUBLE) AS gross_revenue, CAST(sum(discount_amount) AS DOUBLE) AS total_discounts,
    CAST(sum(net_amount) AS DOUBLE) AS net_revenue, sum(net_amount) AS exact_net,
    {avg('sum(net_amount)', 'count(*)')} AS average_order_value,
    count(DISTINCT customer_id) AS unique_customers, count(DISTINCT product_id) AS unique_products
  FROM silver GROUP BY sale_date) s LEFT JOIN day_top t ON s.sale_date = t.sale_date
"""
CTES["products"] = f"""
SELECT product_id, max(product_name) AS product_name, max(category) AS category,
  CAST(sum(quantity) AS BIGINT) AS total_quantity_sold, CAST(sum(net_amount) AS DOUBLE) AS total_revenue,
  {avg('sum(unit_price)', 'count(*)')} AS average_unit_price,
  CAST(sum(discount_amount) AS DOUBLE) AS total_discount_given, count(*) AS number_of_transactions,
  {avg('sum(quantity)', 'count(*)')} AS average_quantity_per_transaction
FROM silver GROUP BY product_id
"""
CTES["stores"] = f"""
SELECT s.*, t.category AS top_selling_category FROM (
  SELECT store_location, max(region) AS region, count(*) AS total_transactions,
    CAST(sum(net_amount) AS DOUBLE) AS total_revenue, {avg('sum(net_amount)', 'count(*)')} AS average_order_value,
    count(DISTINCT customer_id) AS total_customers_served
  FROM silver GROUP BY store_location) s LEFT JOIN store_top t ON s.store_location = t.store_location
"""


def tiers(column: str, bounds) -> str:
    cases = " ".join(f"WHEN {column} > {b} THEN '{n}'" for n, b in bounds)
    return f"CASE {cases} ELSE 'Bronze' END"


DEFAULT_TIERS = [("Platinum", 10000), ("Gold", 5000), ("Silver", 1000)]
SCALED_TIERS = [("Platinum", 1000000), ("Gold", 600000), ("Silver", 300000)]

CTES["customers"] = f"""
SELECT s.*, c.category AS favorite_category, p.payment_method AS favorite_payment_method,
  v.store_location AS most_visited_store
FROM (SELECT customer_id, max(customer_name) AS customer_name, count(*) AS total_purchases,
    CAST(sum(net_amount) AS DOUBLE) AS total_revenue, sum(net_amount) AS exact_net,
    {avg('sum(net_amount)', 'count(*)')} AS average_order_value,
    {tiers('sum(net_amount)', SCALED_TIERS)} AS customer_tier
  FROM silver WHERE customer_id IS NOT NULL GROUP BY customer_id) s
LEFT JOIN cust_cat c USING (customer_id) LEFT JOIN cust_pay p USING (customer_id)
LEFT JOIN cust_store v USING (customer_id)
"""
CTES["categories"] = f"""
SELECT category, CAST(sum(quantity) AS BIGINT) AS total_products_sold, CAST(sum(net_amount) AS DOUBLE) AS total_revenue,
  {avg('sum(discount_percentage)', 'count(*)')} AS average_discount_percentage,
  count(*) AS number_of_transactions, {avg('sum(net_amount)', 'count(*)')} AS average_order_value
FROM silver GROUP BY category
"""

CTES["file_rows"] = """
SELECT source_file, run_id, ingest_date, region, count(*) AS rows_read,
  count(*) FILTER (WHERE error_reason IS NULL) AS good, count(*) FILTER (WHERE error_reason IS NOT NULL) AS bad
FROM tagged GROUP BY ALL
"""
CTES["outcomes"] = """
SELECT source_file, run_id, ingest_date, rows_read, status,
  CASE WHEN status = 'PROCESSED' THEN good ELSE 0 END AS good_rows,
  CASE WHEN status = 'PROCESSED' THEN bad ELSE 0 END AS bad_rows,
  CASE status WHEN 'FAILED' THEN 'unreadable' WHEN 'SCHEMA_DRIFT' THEN 'Schema drift' END AS error_message
FROM (SELECT *, CASE WHEN region = 'EUROPE' AND day(ingest_date) = 29 THEN 'FAILED'
    WHEN region = 'AFRICA' AND day(ingest_date) = 13 THEN 'SCHEMA_DRIFT' ELSE 'PROCESSED' END AS status FROM file_rows)
"""
CTES["runs"] = """
SELECT run_id AS ingestion_run_id, string_agg(source_file, ', ' ORDER BY source_file) AS files_scanned,
  CAST(sum(rows_read) AS BIGINT) AS rows_read, CAST(sum(good_rows) AS BIGINT) AS rows_written_silver,
  CAST(sum(bad_rows) AS BIGINT) AS rows_quarantined,
  CASE WHEN count(*) FILTER (WHERE status <> 'PROCESSED') > 0 THEN 'COMPLETED_WITH_ERRORS' ELSE 'COMPLETED' END AS status,
  count(*) FILTER (WHERE status = 'SCHEMA_DRIFT') AS drifted_files, count(*) FILTER (WHERE status = 'FAILED') AS failed_files
FROM outcomes GROUP BY run_id
"""

NEEDS = {
    "bronze": ["priced"], "tagged": ["bronze"], "good": ["tagged"], "silver": ["good"], "failed": ["tagged"],
    "quarantine": ["failed"], "judged": ["quarantine"], "settled": ["judged"],
    "day_top": ["silver"], "store_top": ["silver"], "cust_cat": ["silver"], "cust_pay": ["silver"], "cust_store": ["silver"],
    "daily": ["day_top"], "products": ["silver"], "stores": ["store_top"],
    "customers": ["cust_cat", "cust_pay", "cust_store"], "categories": ["silver"],
    "file_rows": ["tagged"], "outcomes": ["file_rows"], "runs": ["outcomes"],
}


def with_ctes(select: str, *names: str, extra: str = "", recursive: bool = False, silver: str | None = None) -> str:
    """Select over the named tables and what they need; `silver` takes the place of that table."""
    wanted: list[str] = []

    def add(name: str) -> None:
        for need in NEEDS.get(name, []):
            add(need)
        if name not in wanted:
            wanted.append(name)

    for name in names:
        add(name)
    ctes = CTES if silver is None else {**CTES, "silver": silver}
    parts = [f"{n} AS ({ctes[n].strip()})" for n in wanted] + ([extra] if extra else [])
    if not parts:
        return select
    return ("WITH RECURSIVE " if recursive else "WITH ") + ",\n".join(parts) + "\n" + select


ORACLES: dict[str, str] = {}


def add(name: str, select: str, *ctes: str, **kw) -> None:
    ORACLES[name] = with_ctes(select, *ctes, **kw)


# --- scans, sources, sinks ----------------------------------------------------------------------

add("bronze_sales", f"SELECT {shown(SALES_COLUMNS)}, source_file FROM bronze", "bronze")
add("scan_project", "SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_quantity FROM lineitem")
add("adhoc_filter_group", """SELECT o_orderpriority, count(*) AS cnt, CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS total,
  max(o_totalprice) AS largest FROM orders WHERE o_orderstatus = 'F' GROUP BY o_orderpriority""")
add("adhoc_sql", """SELECT l_returnflag, l_linestatus, count(*) AS cnt, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity
  FROM lineitem WHERE l_shipdate < TIMESTAMP '2000-01-01' GROUP BY 1, 2""")
add("ingest_dates", "SELECT DISTINCT CAST(l_shipdate AS DATE) AS ingest_date FROM lineitem")
add("dataset_preview", """SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal, c_mktsegment
  FROM customer ORDER BY c_custkey LIMIT 100""")
add("describe", """SELECT column_name, CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int'
  WHEN 'DOUBLE' THEN 'double' WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' END AS column_type
  FROM (DESCRIBE lineitem)""")
add("bronze_by_category", "SELECT category, count(*) AS cnt, CAST(sum(net_amount) AS DOUBLE) AS total FROM bronze GROUP BY 1", "bronze")
add("bronze_daily_revenue", "SELECT sale_date, CAST(sum(net_amount) AS DOUBLE) AS daily_revenue FROM bronze GROUP BY 1", "bronze")
add("bronze_by_date", f"SELECT {shown(SALES_COLUMNS)} FROM bronze WHERE sale_date = DATE '1998-10-03'", "bronze")
_values = " || ".join(f"coalesce(length(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), 'N')" for c in SALES_COLUMNS)
_word = lambda start: f"CAST(sum(CAST('0x' || substr(h, {start}, 8) AS BIGINT)) AS VARCHAR)"
add("file_checksum", f"""SELECT source_file, count(*) AS record_count, {_word(1)} || '-' || {_word(9)} AS checksum
  FROM (SELECT source_file, md5({_values}) AS h FROM bronze) GROUP BY source_file""", "bronze")
add("max_watermark", "SELECT max(processed_at) AS max_value, count(*) AS row_count FROM silver", "silver")

TABLES = ["benchmark", "conversations", "customer", "documents", "embeddings", "events", "labels", "lineitem",
          "nation", "orders", "pages", "part", "region", "supplier"]
_expected = ", ".join(f"('{c}')" for c in SALES_COLUMNS if c != "ingest_date")
_given = " UNION ALL ".join(f"SELECT '{t}.parquet' AS file_name, column_name FROM (DESCRIBE {t})" for t in TABLES)
add("list_files", " UNION ALL ".join(f"SELECT '{t}.parquet' AS file_name, count(*) AS row_count, TRUE AS has_bytes FROM {t}" for t in TABLES))
add("partitioned_write", """SELECT CAST(date_trunc('month', ingest_date) AS DATE) AS ingest_date, count(*) AS row_count,
  CAST(sum(net_amount) AS DOUBLE) AS total FROM bronze GROUP BY 1""", "bronze")
add("truncate_table", """SELECT o_orderstatus, count(*) AS row_count, 'written' AS state FROM orders GROUP BY 1
  UNION ALL SELECT o_orderstatus, count(*), 'appended' FROM orders WHERE o_orderstatus IN ('F', 'O') GROUP BY 1""")
add("dataset_list", " UNION ALL ".join(f"SELECT '{t}.parquet' AS dataset_name" for t in TABLES))
add("schema_drift", """SELECT file_name, TRUE AS has_drift, missing_columns, extra_columns,
  'Missing columns: ' || missing_columns || '. Extra columns: ' || extra_columns || '.' AS drift_details
  FROM (SELECT file_name, (SELECT string_agg(c, ', ' ORDER BY c) FROM expected e
      WHERE NOT EXISTS (SELECT 1 FROM given g WHERE g.file_name = f.file_name AND g.column_name = e.c)) AS missing_columns,
    (SELECT string_agg(column_name, ', ' ORDER BY column_name) FROM given g WHERE g.file_name = f.file_name
      AND column_name NOT IN (SELECT c FROM expected)) AS extra_columns
  FROM (SELECT DISTINCT file_name FROM given) f)""",
    extra=f"expected(c) AS (VALUES {_expected}), given AS ({_given})")


# --- validation ---------------------------------------------------------------------------------

_wanted = "('o_orderkey', 'integer'), ('o_totalprice', 'string'), ('o_orderdate', 'date'), ('l_shipdate', 'datetime'), ('text', 'string')"
_columns = " UNION ALL ".join(f"SELECT '{t}.parquet' AS file_name, column_name, column_type FROM (DESCRIBE {t})" for t in TABLES)
add("stored_types", f"""SELECT f.file_name, w.c AS column_name, CASE WHEN d.column_name IS NULL THEN format('Column ''{{}}'' not found', w.c)
    ELSE format('Column ''{{}}'': expected {{}}, got {{}}', w.c, w.kind, d.stored) END AS message
  FROM (SELECT DISTINCT file_name FROM described) f CROSS JOIN (VALUES {_wanted}) AS w(c, kind)
  LEFT JOIN described d ON d.file_name = f.file_name AND d.column_name = w.c
  WHERE d.column_name IS NULL OR d.kind <> w.kind AND NOT (d.kind = 'date' AND w.kind = 'datetime')""",
    extra=f"""described AS (SELECT *, CASE column_type WHEN 'BIGINT' THEN 'integer' WHEN 'INTEGER' THEN 'integer' WHEN 'DOUBLE' THEN 'float'
  WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'date' ELSE 'other' END AS kind,
  CASE column_type WHEN 'BIGINT' THEN 'int64' WHEN 'INTEGER' THEN 'int32' WHEN 'DOUBLE' THEN 'double' WHEN 'VARCHAR' THEN 'string' ELSE column_type END AS stored
  FROM ({_columns}))""")
add("odd_value_tags", """SELECT tags, count(*) AS row_count FROM (SELECT CASE WHEN k % 30 = 7 THEN 'check:quantity'
    ELSE coalesce(nullif(concat_ws(';', CASE WHEN customer_id IS NULL THEN 'null:customer_id' END, CASE WHEN k % 30 = 11 THEN 'null:unit_price' END,
      CASE WHEN CASE WHEN k % 40 = 10 THEN -5 ELSE quantity END NOT BETWEEN 1 AND 1000 THEN 'range:quantity' END), ''), 'good') END AS tags
  FROM (SELECT *, CAST(split_part(transaction_id, '-', 2) AS BIGINT) AS k FROM bronze)) GROUP BY tags""", "bronze")
REQUIRED = ["transaction_id", "sale_date", "customer_id", "product_id", "quantity", "unit_price", "net_amount"]
RANGES = [("quantity", 1, 1000), ("unit_price", 0, 100000), ("discount_percentage", 0, 100)]


def each(rows) -> str:
    return " UNION ALL ".join(rows)


add("required_nulls", each(
    f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_count FROM bronze" for c in REQUIRED), "bronze")
add("value_range", each(
    f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} < {lo}) AS below_min, count(*) FILTER (WHERE {c} > {hi}) AS above_max FROM bronze"
    for c, lo, hi in RANGES), "bronze")
DUPLICATES = "(SELECT transaction_id, count(*) AS n FROM bronze GROUP BY 1 HAVING count(*) > 1)"
add("uniqueness_rows", f"SELECT CAST(coalesce(sum(n), 0) AS BIGINT) AS duplicate_rows, count(*) AS duplicate_keys FROM {DUPLICATES}", "bronze")
_report = ["SELECT 'row_count' AS \"check\", '*' AS column_name, count(*) AS failed_count, TRUE AS passed FROM bronze",
           "SELECT 'missing_columns', '', 0, TRUE", "SELECT 'extra_columns', '', 0, TRUE"]
_report += [f"SELECT 'not_null', '{c}', count(*) FILTER (WHERE {c} IS NULL), count(*) FILTER (WHERE {c} IS NULL) = 0 FROM bronze" for c in REQUIRED]
for _c, _lo, _hi in RANGES:
    _report.append(f"SELECT 'range_min', '{_c}', count(*) FILTER (WHERE {_c} < {_lo}), count(*) FILTER (WHERE {_c} < {_lo}) = 0 FROM bronze")
    _report.append(f"SELECT 'range_max', '{_c}', count(*) FILTER (WHERE {_c} > {_hi}), count(*) FILTER (WHERE {_c} > {_hi}) = 0 FROM bronze")
_report.append(f"SELECT 'unique', 'transaction_id', CAST(coalesce(sum(n), 0) AS BIGINT), count(*) = 0 FROM {DUPLICATES}")
add("full_validation", each(_report), "bronze")
add("row_tagging", "SELECT record_id, source_file, transaction_id, error_reason FROM tagged", "tagged")
add("good_bad_split", """SELECT count(*) AS rows_read, count(*) FILTER (WHERE error_reason IS NULL) AS good_rows,
  count(*) FILTER (WHERE error_reason IS NOT NULL) AS bad_rows FROM tagged""", "tagged")
add("error_reason_counts", "SELECT error_reason, count(*) AS row_count FROM tagged WHERE error_reason IS NOT NULL GROUP BY 1", "tagged")
CONSTRAINTS = {
    "transaction_id": "IS NULL", "sale_date": "IS NULL", "sale_hour": "NOT BETWEEN 0 AND 23", "customer_id": "IS NULL",
    "product_id": "IS NULL", "quantity": "<= 0", "unit_price": "< 0", "discount_percentage": "NOT BETWEEN 0 AND 100",
    "discount_amount": "< 0", "gross_amount": "< 0", "net_amount": "< 0",
}
add("constraint_violations", each(
    f"SELECT 'check:{c}' AS constraint_name, count(*) FILTER (WHERE {c} IS NULL OR {c} {t}) AS violations FROM bronze"
    for c, t in CONSTRAINTS.items()), "bronze")

_types = {"sale_date": "date", "ingest_date": "date", "sale_hour": "int", "quantity": "int", "is_weekend": "boolean",
          "is_holiday": "boolean", "processed_at": "timestamp_ntz", "unit_price": "decimal(10,2)",
          "discount_percentage": "decimal(5,2)", "discount_amount": "decimal(10,2)", "gross_amount": "decimal(10,2)",
          "net_amount": "decimal(10,2)", "profit_margin": "decimal(5,2)"}
_stats = []
for _c in [*SALES_COLUMNS, "source_file", "processed_at"]:
    if _c in MONEY | WHOLE:
        _num = f"CAST(min({_c}) AS DOUBLE), CAST(max({_c}) AS DOUBLE), CAST(sum({_c}) AS DOUBLE) / count({_c})"
    else:
        _num = "CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE)"
    _stats.append(f"SELECT '{_c}', '{_types.get(_c, 'string')}', count(*) - count({_c}), count(DISTINCT {_c}), {_num} FROM silver")
add("column_stats", f"SELECT * FROM ({each(_stats)}) AS t(column_name, dtype, null_count, unique_count, min_value, max_value, mean_value)", "silver")
_off = "((2 * CAST(unit_price * 100 AS BIGINT) * CAST(discount_percentage * 100 AS BIGINT) + 10000) // 20000)"
_gross = "(CAST(unit_price * 100 AS BIGINT) * quantity)"
add("derive_amounts", f"""SELECT record_id, source_file, {_off} / 100.0 AS discount_amount, {_gross} / 100.0 AS gross_amount,
  ({_gross} - {_off}) / 100.0 AS net_amount,
  CASE WHEN payment_method IN ('Credit Card', 'Debit Card', 'Digital Wallet') THEN 'Online' ELSE 'Offline' END AS payment_category,
  CAST(isodow(sale_date) >= 6 AS BIGINT) AS is_weekend FROM bronze""", "bronze")


# --- check templates ----------------------------------------------------------------------------

add("null_check", "SELECT count(*) AS null_count FROM bronze WHERE customer_id IS NULL", "bronze")
add("unique_check", """SELECT transaction_id, count(*) AS cnt FROM bronze GROUP BY 1 HAVING count(*) > 1
  ORDER BY cnt DESC, transaction_id LIMIT 10""", "bronze")
add("value_range_check", "SELECT count(*) AS out_of_range FROM bronze WHERE quantity < 1 OR quantity > 1000", "bronze")
add("bad_record_sources", """SELECT ingest_date, count(*) AS cnt FROM bronze WHERE quantity < 0 GROUP BY 1
  ORDER BY cnt DESC, ingest_date LIMIT 3""", "bronze")
add("failure_sources", """SELECT 'bronze.sales.' || column_name AS source_key,
  string_agg(CAST(ingest_date AS VARCHAR) || ' (' || bad || ' bad)', ', ' ORDER BY bad DESC, ingest_date) AS sources
  FROM (SELECT * FROM (
    SELECT 'customer_id' AS column_name, ingest_date, count(*) AS bad FROM bronze WHERE customer_id IS NULL GROUP BY 2
    UNION ALL SELECT 'quantity', ingest_date, count(*) FROM bronze WHERE quantity < 0 GROUP BY 2)
    QUALIFY row_number() OVER (PARTITION BY column_name ORDER BY bad DESC, ingest_date) <= 3) GROUP BY 1""", "bronze")


# --- upsert, ledger, audit, quarantine ----------------------------------------------------------

_sides = f"""target AS (SELECT * FROM good WHERE ingest_date < DATE '1999-01-01' QUALIFY row_number() OVER ({LATEST}) = 1),
newest AS (SELECT * FROM good WHERE ingest_date >= DATE '1999-01-01' QUALIFY row_number() OVER ({LATEST}) = 1),
oldest AS (SELECT * FROM good WHERE ingest_date >= DATE '1999-01-01' QUALIFY row_number() OVER ({EARLIEST}) = 1)"""
_taken = lambda c, side: f"CASE WHEN {side}.transaction_id IS NOT NULL THEN {side}.{c} ELSE t.{c} END"
_kept = lambda c, side: f"CASE WHEN t.transaction_id IS NOT NULL THEN t.{c} ELSE {side}.{c} END"
add("upsert_merge", f"""SELECT transaction_id, {_taken('sale_date', 'n')} AS sale_date, {_taken('product_id', 'n')} AS product_id,
  CAST({_taken('quantity', 'n')} AS BIGINT) AS quantity, CAST({_taken('net_amount', 'n')} AS DOUBLE) AS net_amount,
  {_taken('ingest_date', 'n')} AS ingest_date, {_kept('source_file', 'o')} AS source_file, {_kept('processed_at', 'o')} AS processed_at
  FROM target t FULL JOIN newest n USING (transaction_id) FULL JOIN oldest o USING (transaction_id)""", "good", extra=_sides)
_shown = "transaction_id, sale_date, product_id, CAST(quantity AS BIGINT) AS quantity, CAST(net_amount AS DOUBLE) AS net_amount, ingest_date, source_file, processed_at"
add("upsert_do_nothing", f"""SELECT {_shown} FROM target UNION ALL
  SELECT {_shown} FROM oldest WHERE transaction_id NOT IN (SELECT transaction_id FROM target)""", "good", extra=_sides)
add("dedup_latest", f"SELECT {shown(SALES_COLUMNS, 'BOOLEAN')}, source_file, processed_at FROM silver", "silver")
add("file_status", "SELECT source_file, rows_read, good_rows, bad_rows, status, error_message FROM outcomes", "outcomes")
add("ledger_upsert", f"""SELECT source_file AS file_path, 'sales' AS dataset_name,
  CASE WHEN year(ingest_date) < 2000 THEN 'a' ELSE 'b' END || rows_read AS checksum, ingest_date,
  CASE WHEN year(ingest_date) >= 1998 THEN status ELSE 'PROCESSING' END AS status, good_rows AS record_count,
  CASE WHEN year(ingest_date) >= 1998 THEN {NOW} ELSE CAST(ingest_date AS TIMESTAMP) END AS processed_at,
  run_id, error_message, CAST(ingest_date AS TIMESTAMP) AS created_at FROM outcomes""", "outcomes")
add("pending_files", """SELECT source_file AS file_path, ingest_date FROM outcomes
  WHERE year(ingest_date) >= 2000 OR day(ingest_date) = 1""", "outcomes")
add("recent_source_files", """SELECT source_file AS file_path, ingest_date, CAST(ingest_date AS TIMESTAMP) AS processed_at
  FROM outcomes WHERE status = 'PROCESSED' ORDER BY processed_at DESC, file_path LIMIT 10""", "outcomes")
add("audit_run", "SELECT * FROM runs", "runs")
add("run_severity", """SELECT ingestion_run_id, rows_quarantined / rows_read * 100.0::DOUBLE AS quarantine_rate,
  CASE WHEN drifted_files > 0 THEN 'SCHEMA DRIFT' WHEN failed_files > 0 THEN 'COMPLETED WITH ERRORS'
    WHEN rows_quarantined / rows_read * 100.0::DOUBLE > 50 THEN 'HIGH QUARANTINE' WHEN rows_quarantined > 0 THEN 'PARTIAL SUCCESS'
    ELSE 'SUCCESS' END AS status_text,
  CASE WHEN drifted_files > 0 THEN 'critical' WHEN failed_files > 0 OR rows_quarantined > 0 THEN 'warning' ELSE 'info' END AS severity
  FROM runs""", "runs")
add("quarantine_payload", f"""SELECT record_id AS id, {json_text('customer_id', 'quantity')} AS payload, error_reason,
  CAST(ingest_date AS TIMESTAMP) AS failed_at, run_id AS ingestion_run_id, source_file FROM tagged WHERE error_reason IS NOT NULL""", "tagged")
add("alert_throttle", """SELECT a.event_id, a.alert_key, a.severity, a.ts,
  CASE WHEN severity = 'critical' OR f.event_id IS NOT NULL THEN 'sent' ELSE 'throttled' END AS decision
  FROM alerts a LEFT JOIN (SELECT min(a.event_id) AS event_id FROM alerts a JOIN sent s ON a.alert_key = s.alert_key AND a.sec = s.sec
    GROUP BY a.alert_key, a.sec) f ON a.event_id = f.event_id""", recursive=True,
    extra="""alerts AS (SELECT event_id, event_type AS alert_key, ts, CAST(floor(epoch(ts)) AS BIGINT) AS sec,
  CASE WHEN event_type = 'error' THEN 'critical' WHEN event_type IN ('purchase', 'signup') THEN 'warning' ELSE 'info' END AS severity,
  CASE WHEN event_type IN ('purchase', 'signup') THEN 3600 ELSE 21600 END AS wait FROM events),
sent AS (SELECT alert_key, min(sec) AS sec FROM alerts GROUP BY alert_key
  UNION ALL SELECT s.alert_key, min(a.sec) FROM sent s JOIN alerts a ON a.alert_key = s.alert_key AND a.sec > s.sec + a.wait GROUP BY s.alert_key)""")


# --- silver dimensions and gold -----------------------------------------------------------------

add("dim_customers", f"""SELECT customer_id, max(customer_name) AS customer_name, min(sale_date) AS first_purchase_date,
  count(*) AS total_purchases, CAST(sum(net_amount) AS DOUBLE) AS total_revenue,
  {avg('sum(net_amount)', 'count(*)')} AS average_order_value, {tiers('sum(net_amount)', DEFAULT_TIERS)} AS customer_segment,
  max(sale_date) AS last_purchase_date, CAST(DATE '2002-01-01' - max(sale_date) AS BIGINT) AS days_since_last_purchase
  FROM silver WHERE customer_id IS NOT NULL GROUP BY customer_id""", "silver")
add("dim_products", f"""SELECT product_id, max(product_name) AS product_name, max(category) AS category, max(sub_category) AS sub_category,
  CAST(min(unit_price) AS DOUBLE) AS min_unit_price, CAST(max(unit_price) AS DOUBLE) AS max_unit_price,
  {avg('sum(unit_price)', 'count(*)')} AS avg_unit_price, CAST(sum(quantity) AS BIGINT) AS total_quantity_sold,
  CAST(sum(net_amount) AS DOUBLE) AS total_revenue FROM silver WHERE product_id IS NOT NULL GROUP BY product_id""", "silver")
add("daily_sales", "SELECT * EXCLUDE (exact_net) FROM daily", "daily")
add("product_performance", "SELECT * FROM products", "products")
add("store_performance", "SELECT * FROM stores", "stores")
add("customer_analytics", "SELECT * EXCLUDE (exact_net) FROM customers", "customers")
add("category_insights", "SELECT * FROM categories", "categories")
add("monthly_sales", """SELECT CAST(date_trunc('month', sale_date) AS DATE) AS month, count(*) AS total_transactions,
  CAST(sum(quantity) AS BIGINT) AS total_quantity, CAST(sum(gross_amount) AS DOUBLE) AS gross_revenue,
  CAST(sum(discount_amount) AS DOUBLE) AS total_discounts, CAST(sum(net_amount) AS DOUBLE) AS net_revenue,
  CAST(sum(net_amount) AS DOUBLE) / count(*) AS avg_order_value FROM silver GROUP BY 1""", "silver")
add("regional_sales", """SELECT region, store_location, count(*) AS total_transactions, CAST(sum(net_amount) AS DOUBLE) AS total_revenue,
  count(DISTINCT customer_id) AS unique_customers, CAST(sum(net_amount) AS DOUBLE) / count(*) AS avg_order_value
  FROM silver GROUP BY 1, 2""", "silver")


# --- data quality -------------------------------------------------------------------------------

_dims = """silver_customers AS (SELECT customer_id, max(customer_name) AS customer_name FROM silver GROUP BY 1),
silver_products AS (SELECT product_id, max(product_name) AS product_name, max(category) AS category FROM silver GROUP BY 1),
orphan_customers AS (SELECT count(DISTINCT customer_id) AS orphan_count FROM silver WHERE customer_id NOT IN
  (SELECT CASE WHEN c_custkey % 50 = 7 THEN 'FORMER-CUST' ELSE 'CUST' END || c_custkey FROM customer)),
orphan_products AS (SELECT count(DISTINCT product_id) AS orphan_count FROM silver WHERE product_id NOT IN
  (SELECT CASE WHEN p_partkey % 40 = 3 THEN 'FORMER-PROD' ELSE 'PROD' END || p_partkey FROM part)),
profiled AS (SELECT 'sales' AS table_name, count(*) AS row_count FROM silver
  UNION ALL SELECT 'customers', count(*) FROM silver_customers UNION ALL SELECT 'products', count(*) FROM silver_products),
baseline AS (SELECT count(*) AS b FROM silver WHERE ingest_date = (SELECT max(ingest_date) FROM silver
  WHERE CAST(ingest_date AS TIMESTAMP) < """ + QUALITY_AS_OF + """ - INTERVAL 24 HOUR)),
drifted AS (SELECT 'sales' AS table_name, row_count AS current_count, b AS baseline_count,
  abs(CAST(row_count AS DOUBLE) - b) / b * 100 AS change FROM profiled, baseline WHERE table_name = 'sales'),
completed(table_name, column_name, total, non_null) AS (""" + " UNION ALL ".join(
    f"SELECT '{t}', '{c}', count(*), count({c}) FROM {src}" for t, src, cs in (
        ("bronze.sales", "bronze", ["transaction_id", "customer_id", "product_id", "sale_date", "net_amount"]),
        ("silver.customers", "silver_customers", ["customer_id", "customer_name"]),
        ("silver.products", "silver_products", ["product_id", "product_name", "category"])) for c in cs) + f"""),
complete AS (SELECT *, {pct('non_null', 'total')} AS completeness_pct, {pct('non_null', 'total')} >= 95 AS passes_threshold FROM completed),
fresh AS (SELECT max(sale_date) AS latest_sale_date, max(processed_at) AS latest_processed,
  round(date_diff('microsecond', max(processed_at), {QUALITY_AS_OF}) / 3600000000.0::DOUBLE, 2) AS hours_since_update,
  date_diff('microsecond', max(processed_at), {QUALITY_AS_OF}) / 3600000000.0::DOUBLE <= 24 AS is_fresh FROM silver)"""
_dq = ("silver", "quarantine", "bronze")
_status = "CASE WHEN change > 10 THEN 'drift_alert' ELSE 'normal' END"
add("dq_quarantine", """SELECT count(*) AS total_rows, count(*) FILTER (WHERE id IS NULL) AS null_ids,
  count(*) FILTER (WHERE payload IS NULL) AS null_payloads, count(*) FILTER (WHERE error_reason IS NULL) AS null_errors,
  count(*) FILTER (WHERE id IS NULL OR payload IS NULL OR error_reason IS NULL) = 0 AS success FROM quarantine""", "quarantine")
add("dq_profile", "SELECT table_name, row_count, row_count > 0 AS populated FROM profiled", *_dq, extra=_dims)
add("dq_drift", f"""SELECT table_name, current_count, baseline_count, round(change, 2) AS change_pct, change > 10 AS drift_detected,
  {_status} AS status FROM drifted""", *_dq, extra=_dims)
add("dq_completeness", "SELECT * FROM complete", *_dq, extra=_dims)
add("dq_freshness", "SELECT *, CASE WHEN is_fresh THEN 'ok' ELSE 'stale_data_alert' END AS status FROM fresh", *_dq, extra=_dims)
add("dq_orphan_customers", "SELECT * FROM orphan_customers", *_dq, extra=_dims)
add("dq_orphan_products", "SELECT * FROM orphan_products", *_dq, extra=_dims)
add("dq_summary", """SELECT *, quarantine_issues OR profiling_issues OR drift_issues OR completeness_issues OR freshness_issues
  OR integrity_issues AS has_issues FROM (SELECT
  (SELECT count(*) FROM quarantine WHERE stored_status = 'pending') > 0 AS quarantine_issues, FALSE AS profiling_issues,
  (SELECT bool_or(change > 10) FROM drifted) AS drift_issues, (SELECT bool_or(NOT passes_threshold) FROM complete) AS completeness_issues,
  (SELECT NOT is_fresh FROM fresh) AS freshness_issues,
  (SELECT orphan_count FROM orphan_customers) + (SELECT orphan_count FROM orphan_products) > 0 AS integrity_issues,
  (SELECT count(*) FROM quarantine) AS total, (SELECT count(*) FROM quarantine WHERE stored_status = 'pending') AS pending,
  (SELECT count(*) FROM quarantine WHERE stored_status = 'remediated') AS remediated,
  CAST(0 AS BIGINT) AS rejected, CAST(0 AS BIGINT) AS dead_letter)""", *_dq, extra=_dims)
add("dq_report", f"""SELECT 'quarantine' AS section, 'total_rows' AS metric, CAST(count(*) AS VARCHAR) AS value, 'ok' AS status FROM quarantine
  UNION ALL SELECT 'quarantine', m, '0', 'ok' FROM (VALUES ('null_ids'), ('null_payloads'), ('null_errors')) AS v(m)
  UNION ALL SELECT 'profiling', table_name, CAST(row_count AS VARCHAR), CASE WHEN row_count > 0 THEN 'populated' ELSE 'empty' END FROM profiled
  UNION ALL SELECT 'drift', table_name, baseline_count || ' -> ' || current_count, {_status} FROM drifted
  UNION ALL SELECT 'completeness', table_name || '.' || column_name, non_null || '/' || total, CASE WHEN passes_threshold THEN 'pass' ELSE 'fail' END FROM complete
  UNION ALL SELECT 'freshness', 'latest_sale_date', CAST(latest_sale_date AS VARCHAR), CASE WHEN is_fresh THEN 'ok' ELSE 'stale_data_alert' END FROM fresh
  UNION ALL SELECT 'integrity', 'orphan customer_id', CAST(orphan_count AS VARCHAR), CASE WHEN orphan_count = 0 THEN 'valid' ELSE 'invalid' END FROM orphan_customers
  UNION ALL SELECT 'integrity', 'orphan product_id', CAST(orphan_count AS VARCHAR), CASE WHEN orphan_count = 0 THEN 'valid' ELSE 'invalid' END FROM orphan_products""",
    *_dq, extra=_dims)


# --- remediation --------------------------------------------------------------------------------

add("pending_batch", """SELECT id, run_id AS ingestion_run_id, payload, error_reason, source_file, failed_at, CAST(retry_count AS BIGINT) AS retry_count
  FROM judged WHERE is_open ORDER BY failed_at, id, source_file, payload LIMIT 1000""", "judged")
add("remediation_validate", """SELECT id, source_file, reject_reason, reject_reason IS NULL AS is_valid FROM judged WHERE is_open""", "judged")
_state = "id, source_file, error_reason, corrected_by, corrected_at, replayed, replayed_at, remediation_status, CAST(retry_count AS BIGINT) AS retry_count"
add("quarantine_state", f"SELECT {_state} FROM settled", "settled")
add("remediation_reject", f"SELECT {_state} FROM settled WHERE rejected", "settled")
add("dead_letter", f"SELECT {_state} FROM settled WHERE dead", "settled")
add("retry_increment", """SELECT id, source_file, CAST(retry_count + CASE WHEN EXISTS (SELECT 1 FROM judged f
    WHERE f.id = j.id AND f.source_file = j.source_file AND f.is_open AND f.corrected_by IS NULL) THEN 1 ELSE 0 END AS BIGINT) AS retry_count
  FROM judged j""", "judged")
add("quarantine_stats", """SELECT count(*) AS total, count(*) FILTER (WHERE stored_status = 'pending') AS pending,
  count(*) FILTER (WHERE stored_status = 'remediated') AS remediated, CAST(0 AS BIGINT) AS rejected, CAST(0 AS BIGINT) AS dead_letter
  FROM quarantine""", "quarantine")
add("quarantine_migrate", "SELECT id, source_file, replayed, remediation_status, CAST(retry_count AS BIGINT) AS retry_count FROM quarantine", "quarantine")
add("remediation_run", """SELECT count(*) FILTER (WHERE fixed) AS fixed, CAST(0 AS BIGINT) AS failed, count(*) FILTER (WHERE rejected) AS rejected,
  count(*) FILTER (WHERE dead) AS dead_lettered, count(*) AS total,
  count(*) FILTER (WHERE remediation_status = 'pending') AS now_pending,
  count(*) FILTER (WHERE remediation_status = 'remediated') AS now_remediated,
  count(*) FILTER (WHERE remediation_status = 'rejected') AS now_rejected,
  count(*) FILTER (WHERE remediation_status = 'dead_letter') AS now_dead_letter FROM settled""", "settled")
# the discount is recomputed from the percentage; a transaction's sale-independent columns come
# from its first replayed record, the others from its last
_disc = "CAST(round(unit_price * fixed_quantity * discount_percentage / 100, 2) AS DECIMAL(10,2))"
_replayed = f"""fixed AS (SELECT *, CAST(unit_price * fixed_quantity AS DECIMAL(10,2)) AS g,
  CAST((CAST(unit_price * 100 AS BIGINT) * fixed_quantity * CAST(discount_percentage * 100 AS BIGINT) * 2 + 10000) // 20000 AS BIGINT) AS d
  FROM judged WHERE is_open AND reject_reason IS NULL),
firsts AS (SELECT * FROM fixed QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY failed_at, id) = 1),
lasts AS (SELECT * FROM fixed QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY failed_at DESC, id DESC) = 1)"""
add("remediation_replay", f"""SELECT {shown(SALES_COLUMNS, 'BOOLEAN')}, source_file, processed_at FROM silver
    WHERE transaction_id NOT IN (SELECT transaction_id FROM fixed)
  UNION ALL SELECT f.transaction_id, l.sale_date, CAST(f.sale_hour AS BIGINT), f.fixed_customer, f.customer_name, f.product_id,
    f.product_name, f.category, f.sub_category, CAST(l.fixed_quantity AS BIGINT), CAST(l.unit_price AS DOUBLE),
    CAST(l.discount_percentage AS DOUBLE), l.d / 100.0, CAST(l.g AS DOUBLE), (CAST(l.g * 100 AS BIGINT) - l.d) / 100.0,
    CAST(f.profit_margin AS DOUBLE), f.payment_method, f.payment_category, f.store_location, f.region,
    CAST(f.is_weekend AS BOOLEAN), CAST(f.is_holiday AS BOOLEAN), f.ingest_date, '', {NOW}
  FROM firsts f JOIN lasts l USING (transaction_id)""", "silver", "judged", extra=_replayed)


# --- incremental forms --------------------------------------------------------------------------

# none of the given tables has the sales columns
add("stream_file_gate", " UNION ALL ".join(f"SELECT '{t}.parquet' AS file_name, 'SCHEMA_DRIFT' AS status" for t in TABLES))
add("stream_dedup", "SELECT DISTINCT user_id || '-' || event_type AS key FROM events")
add("stream_daily", """SELECT CAST(ts AS DATE) AS event_date, count(*) AS events,
  CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total_value FROM events GROUP BY 1""")
_landed = """landed AS (SELECT *, 'set=' || kind || '/ingest_date=' || strftime(date_trunc('month', ingest_date), '%Y-%m-%d') AS folder,
  kind = 'clean' AS is_clean FROM (SELECT *, CASE month(ingest_date) WHEN 10 THEN 'missing' WHEN 11 THEN 'types' WHEN 12 THEN 'extra'
  ELSE 'clean' END AS kind FROM tagged)),
stored AS (SELECT * FROM landed WHERE is_clean AND error_reason IS NULL QUALIFY row_number() OVER (""" + LATEST + """) = 1)"""
add("ingest_silver", f"""SELECT {shown([c for c in SALES_COLUMNS if c != 'ingest_date'], 'BOOLEAN')}, folder, {NOW} AS processed_at
  FROM stored""", "tagged", extra=_landed)
add("ingest_quarantine", """SELECT folder, error_reason, 'pending' AS remediation_status, count(*) AS records FROM landed
  WHERE is_clean AND error_reason IS NOT NULL GROUP BY 1, 2""", "tagged", extra=_landed)
add("ingest_ledger", f"""SELECT *, 'sales' AS dataset_name, status = 'PROCESSED' AS has_checksum, {NOW} AS processed_at FROM (
  SELECT folder, CASE WHEN is_clean THEN 'PROCESSED' ELSE 'SCHEMA_DRIFT' END AS status,
    count(*) FILTER (WHERE is_clean AND error_reason IS NULL) AS record_count,
    CASE kind WHEN 'missing' THEN 'Schema drift: Missing columns: category, region.' WHEN 'extra' THEN 'Schema drift: Extra columns: note.'
      WHEN 'types' THEN 'Schema drift: Unusable types: is_weekend, quantity.' END AS error_message
  FROM landed GROUP BY folder, is_clean, kind
  UNION ALL VALUES ('set=empty/ingest_date=2001-01-01', 'FAILED', 0, 'No data found'), ('set=broken/ingest_date=2001-01-01', 'FAILED', 0, 'Unreadable file'))""",
    "tagged", extra=_landed)
add("ingest_audit", f"""SELECT 'first-0000' AS ingestion_run_id, 'COMPLETED_WITH_ERRORS' AS status, count(DISTINCT folder) + 2 AS files, count(*) AS rows_read,
  count(*) FILTER (WHERE is_clean AND error_reason IS NULL) AS rows_written_silver,
  count(*) FILTER (WHERE is_clean AND error_reason IS NOT NULL) AS rows_quarantined, {NOW} AS started_at FROM landed""", "tagged", extra=_landed)
add("ingest_severity", """SELECT 'first-0000' AS ingestion_run_id, 'SCHEMA DRIFT' AS status_text, 'critical' AS severity,
  count(*) FILTER (WHERE is_clean AND error_reason IS NOT NULL) / CAST(count(*) AS DOUBLE) * 100.0::DOUBLE AS quarantine_rate FROM landed""",
    "tagged", extra=_landed)
for _name in ("silver", "ledger", "quarantine"):
    ORACLES[f"stream_ingest_{_name}"] = ORACLES[f"ingest_{_name}"]
add("stream_daily_users", """SELECT CAST(ts AS DATE) AS period, count(*) AS events,
  CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total_value, count(DISTINCT user_id) AS users FROM events GROUP BY 1""")
add("stream_monthly_users", """SELECT CAST(date_trunc('month', ts) AS DATE) AS period, count(*) AS events,
  CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total_value, count(DISTINCT user_id) AS users, TRUE AS sketch_is_close
  FROM events GROUP BY 1""")
ORACLES["stream_throttle"] = ORACLES["throttle_in_batches"] = ORACLES["alert_throttle"]


# --- stored tables after merges and runs --------------------------------------------------------

ORACLES["merge_stored"] = ORACLES["upsert_merge"]

# silver before the later arrivals, and with some sales still in wrong groups
_early = f"SELECT * FROM good WHERE ingest_date < DATE '1999-01-01' QUALIFY row_number() OVER ({LATEST}) = 1"
_order = "CAST(split_part(transaction_id, '-', 2) AS BIGINT)"
_wrong = lambda c: f"CASE WHEN {_order} % 50 = 3 THEN 'WRONG-' || ({_order} // 50 % 40) ELSE {c} END AS {c}"
_misplaced = f"""SELECT * REPLACE ({', '.join(_wrong(c) for c in ('customer_id', 'product_id', 'store_location', 'category'))},
  CASE WHEN {_order} % 50 = 3 THEN DATE '1980-01-01' + CAST({_order} // 50 % 28 AS INTEGER) ELSE sale_date END AS sale_date) FROM ({_early})"""
_gold = {
    "daily": ("sale_date", "SELECT * EXCLUDE (exact_net) FROM daily", "daily"),
    "customers": ("customer_id", f"""SELECT customer_id, max(customer_name) AS customer_name, min(sale_date) AS first_purchase_date,
  count(*) AS total_purchases, CAST(sum(net_amount) AS DOUBLE) AS total_revenue,
  {avg('sum(net_amount)', 'count(*)')} AS average_order_value, {tiers('sum(net_amount)', SCALED_TIERS)} AS customer_segment,
  max(sale_date) AS last_purchase_date, CAST(DATE '2002-01-01' - max(sale_date) AS BIGINT) AS days_since_last_purchase
  FROM silver WHERE customer_id IS NOT NULL GROUP BY customer_id""", "silver"),
    "products": ("product_id", ORACLES["dim_products"].rsplit(")\n", 1)[1], "silver"),
    "product_performance": ("product_id", "SELECT * FROM products", "products"),
    "stores": ("store_location", "SELECT * FROM stores", "stores"),
    "customer_analytics": ("customer_id", "SELECT * EXCLUDE (exact_net) FROM customers", "customers"),
    "categories": ("category", "SELECT * FROM categories", "categories"),
}
for _name, (_key, _select, _cte) in _gold.items():
    add(f"gold_after_merge_{_name}", _select, _cte)
    _variants = [with_ctes(_select, _cte, silver=s) for s in (None, _early, _misplaced)]
    _absent = lambda t, k=_key: f"NOT EXISTS (SELECT 1 FROM {t} WHERE {t}.{k} IS NOT DISTINCT FROM x.{k})"
    ORACLES[f"gold_kept_{_name}"] = f"""WITH now_there AS ({_variants[0]}), early_there AS ({_variants[1]}), first_there AS ({_variants[2]})
  SELECT * FROM now_there UNION ALL SELECT * FROM early_there AS x WHERE {_absent('now_there')}
  UNION ALL SELECT * FROM first_there AS x WHERE {_absent('now_there')} AND {_absent('early_there')}"""

# payloads of ids that 7 divides fail on replay: they are counted up in both runs, and leave when out of retries
_runs_of = f"""tried AS (SELECT *, is_open AND reject_reason IS NULL AND id % 7 = 0 AS fails,
  is_open AND reject_reason IS NULL AND id % 7 <> 0 AS fixed, is_open AND reject_reason IS NOT NULL AS rejected,
  remediation_status = 'pending' AS was_pending FROM judged),
ended AS (SELECT *, CASE WHEN fails THEN retry_count + least(2, 3 - retry_count) ELSE retry_count END AS tries,
  was_pending AND retry_count >= 3 OR fails AND retry_count = 2 AS dead_first, fails AND retry_count = 1 AS dead_second FROM tried)"""
add("remediated_quarantine", f"""SELECT id, source_file,
  CASE WHEN rejected THEN error_reason || ' | Rejected: ' || reject_reason
    WHEN dead_first OR dead_second THEN error_reason || ' | Dead-lettered after ' || tries || ' retries' ELSE error_reason END AS error_reason,
  CASE WHEN fixed THEN 'remediation_dag' WHEN rejected THEN 'auto_rejected' WHEN dead_first OR dead_second THEN 'dead_letter_escalation'
    ELSE corrected_by END AS corrected_by, corrected_at,
  CASE WHEN fixed OR rejected OR dead_first OR dead_second THEN TRUE ELSE replayed END AS replayed,
  CASE WHEN fixed OR rejected OR dead_first THEN {NOW} WHEN dead_second THEN {NOW} + INTERVAL 1 DAY ELSE replayed_at END AS replayed_at,
  CASE WHEN fixed THEN 'remediated' WHEN rejected THEN 'rejected' WHEN dead_first OR dead_second THEN 'dead_letter'
    ELSE remediation_status END AS remediation_status, CAST(tries AS BIGINT) AS retry_count FROM ended""", "judged", extra=_runs_of)
_counted = lambda run, test: f"""SELECT '{run}' AS run, count(*) FILTER (WHERE {test['fixed']}) AS fixed, count(*) FILTER (WHERE {test['failed']}) AS failed,
  count(*) FILTER (WHERE {test['rejected']}) AS rejected, count(*) FILTER (WHERE {test['dead']}) AS dead_lettered, count(*) AS total,
  count(*) FILTER (WHERE {test['pending']}) AS now_pending,
  count(*) FILTER (WHERE fixed OR remediation_status = 'remediated') AS now_remediated,
  count(*) FILTER (WHERE rejected) AS now_rejected, count(*) FILTER (WHERE {test['gone']}) AS now_dead_letter FROM ended"""  # noqa: E731
add("remediated_totals", _counted("first", {
    "fixed": "fixed", "failed": "fails", "rejected": "rejected", "dead": "dead_first", "pending": "fails AND retry_count < 2", "gone": "dead_first",
}) + " UNION ALL " + _counted("second", {
    "fixed": "FALSE", "failed": "fails AND retry_count < 2", "rejected": "FALSE", "dead": "dead_second", "pending": "fails AND retry_count = 0",
    "gone": "dead_first OR dead_second",
}), "judged", extra=_runs_of)
ORACLES["remediated_silver"] = ORACLES["remediation_replay"].replace(
    "FROM judged WHERE is_open AND reject_reason IS NULL)", "FROM judged WHERE is_open AND reject_reason IS NULL AND id % 7 <> 0)"
)

_sizes = f"""early AS ({_early}), sizes AS (SELECT 0 AS run, (SELECT count(*) FROM early) AS n UNION ALL SELECT 1, (SELECT count(*) FROM silver))"""
add("quality_baselines", f"""SELECT 'sales' AS table_name, 'row_count' AS metric_name, CAST(n AS DOUBLE) AS metric_value,
  {NOW} + INTERVAL 25 HOUR * run AS recorded_at FROM sizes""", "silver", extra=_sizes)
add("quality_runs", """SELECT CAST(run AS BIGINT) AS run, (SELECT count(*) FROM quarantine WHERE stored_status = 'pending') > 0 AS quarantine_issues,
  FALSE AS profiling_issues, run = 1 AND abs(n - lag(n) OVER (ORDER BY run)) * 100.0 / lag(n) OVER (ORDER BY run) > 10 AS drift_issues,
  FALSE AS completeness_issues, TRUE AS freshness_issues, FALSE AS integrity_issues, TRUE AS has_issues,
  (SELECT count(*) FROM quarantine) AS total, (SELECT count(*) FROM quarantine WHERE stored_status = 'pending') AS pending,
  (SELECT count(*) FROM quarantine WHERE stored_status = 'remediated') AS remediated,
  CAST(0 AS BIGINT) AS rejected, CAST(0 AS BIGINT) AS dead_letter FROM sizes""", "silver", "quarantine", extra=_sizes)


# --- dashboards ---------------------------------------------------------------------------------

add("kpi_total_revenue", "SELECT CAST(sum(exact_net) AS DOUBLE) AS total_revenue FROM daily", "daily")
add("kpi_total_transactions", "SELECT CAST(sum(total_transactions) AS BIGINT) AS total_transactions FROM daily", "daily")
add("kpi_total_customers", "SELECT count(DISTINCT customer_id) AS total_customers FROM silver", "silver")
add("kpi_avg_order_value", """SELECT CAST(sum(CAST(round(average_order_value * 100) AS BIGINT)) AS DOUBLE) / 100 / count(*) AS avg_order_value
  FROM daily""", "daily")
add("kpi_total_products", "SELECT count(DISTINCT product_id) AS total_products FROM silver", "silver")
add("kpi_quarantined", "SELECT count(*) AS total_failed FROM failed", "failed")
add("daily_trend", "SELECT sale_date, total_transactions, net_revenue FROM daily ORDER BY sale_date DESC LIMIT 30", "daily")
add("daily_growth", """SELECT sale_date, net_revenue, CAST(prev AS DOUBLE) AS prev_revenue, CAST(exact_net - prev AS DOUBLE) AS growth
  FROM (SELECT *, lag(exact_net) OVER (ORDER BY sale_date) AS prev FROM daily) ORDER BY sale_date DESC LIMIT 30""", "daily")
add("revenue_by_dow", """SELECT strftime(sale_date, '%A') AS day_of_week, CAST(sum(exact_net) AS DOUBLE) AS revenue, count(*) AS transactions
  FROM daily GROUP BY 1""", "daily")
add("monthly_trend", """SELECT strftime(sale_date, '%Y-%m') AS month, CAST(sum(exact_net) AS DOUBLE) AS revenue,
  CAST(sum(total_transactions) AS BIGINT) AS transactions FROM daily GROUP BY 1""", "daily")


def listed(name: str, cte: str, columns: str, key: str, limit: int | None = None) -> None:
    tail = f" ORDER BY total_revenue DESC, {key} LIMIT {limit}" if limit else ""
    add(name, f"SELECT {columns} FROM {cte}{tail}", cte)


listed("top_products", "products", "product_name, category, total_revenue, number_of_transactions", "product_id", 20)
listed("top_products_detail", "products", "product_name, category, total_revenue, number_of_transactions, total_quantity_sold, average_unit_price", "product_id", 20)
listed("products_by_category", "products", "product_name, category, total_revenue, total_quantity_sold, number_of_transactions", "product_id")
listed("category_list", "categories", "category, total_revenue, total_products_sold, average_order_value", "category")
listed("category_breakdown", "categories", "category, total_revenue, total_products_sold, average_order_value, number_of_transactions, average_discount_percentage", "category")
listed("category_detail", "categories", "category, total_revenue, total_products_sold, average_order_value, number_of_transactions", "category")
listed("category_chart", "categories", "category, total_revenue, total_products_sold", "category")
listed("store_list", "stores", "store_location, region, total_revenue, total_transactions", "store_location")
listed("store_overview", "stores", "store_location, region, total_revenue, total_transactions, average_order_value, total_customers_served, top_selling_category", "store_location")
listed("store_comparison", "stores", "store_location, region, total_revenue, total_transactions, total_customers_served, top_selling_category", "store_location")
listed("store_detail", "stores", "store_location, region, total_revenue, total_transactions, total_customers_served, top_selling_category", "store_location")
listed("store_metrics", "stores", "store_location, region, total_revenue, total_transactions, average_order_value, total_customers_served", "store_location")
listed("top_customers", "customers", "customer_name, customer_tier, total_revenue, total_purchases", "customer_id", 20)
listed("customer_overview", "customers", "customer_name, customer_tier, total_revenue, total_purchases, average_order_value, favorite_category, favorite_payment_method", "customer_id", 20)
listed("top15_customers", "customers", "customer_name, customer_tier, total_revenue, total_purchases, favorite_category", "customer_id", 15)
listed("customer_details", "customers", "customer_id, customer_name, customer_tier, total_revenue, total_purchases, favorite_category, favorite_payment_method, most_visited_store", "customer_id")
add("tier_distribution", """SELECT customer_tier, count(*) AS count, CAST(sum(exact_net) AS DOUBLE) AS total_revenue,
  CAST(sum(exact_net) AS DOUBLE) / count(*) AS avg_revenue FROM customers GROUP BY 1""", "customers")
add("tier_pie", "SELECT customer_tier, count(*) AS count, CAST(sum(exact_net) AS DOUBLE) AS total_revenue FROM customers GROUP BY 1", "customers")
add("quality_score", f"""SELECT {pct('s', '(s + q)')} AS quality_score FROM (SELECT (SELECT count(*) FROM silver) AS s,
  (SELECT count(*) FROM failed) AS q)""", "silver", "failed")
add("records_processed", "SELECT count(*) AS total FROM silver UNION ALL SELECT count(*) FROM failed", "silver", "failed")
add("pending_remediation", "SELECT count(*) AS pending FROM quarantine WHERE replayed = FALSE", "quarantine")
add("errors_by_type", "SELECT left(error_reason, 50) AS error_type, count(*) AS count FROM failed GROUP BY error_reason", "failed")
add("failed_trend", "SELECT CAST(failed_at AS DATE) AS date, count(*) AS failed_count FROM failed GROUP BY 1", "failed")
add("errors_by_file", "SELECT source_file, count(*) AS failed_count FROM failed GROUP BY 1", "failed")
add("recent_failures", """SELECT id, error_reason, failed_at, source_file, corrected_by, corrected_at, replayed, replayed_at FROM quarantine
  ORDER BY failed_at DESC, id, source_file, error_reason, corrected_by NULLS FIRST, replayed LIMIT 20""", "quarantine")
add("remediation_status", "SELECT CASE WHEN replayed THEN 'Replayed' ELSE 'Pending' END AS status, count(*) AS count FROM quarantine GROUP BY 1", "quarantine")
