"""Oracles for staging, normalisation, payments, aging, risk and lookups."""

from oracles.core import money

SQL = {}

SQL["eligible_transactions"] = f"""
SELECT transaction_id, invoice_no, stock_code, description, CAST(quantity AS DOUBLE) AS quantity,
       invoice_date, {money('unit_price', 'unit_price')}, customer_id, country FROM good"""

SQL["build_customers"] = """
SELECT DISTINCT customer_id, 'Retail Customer ' || CAST(customer_id AS VARCHAR) AS customer_name,
  'RETAIL' AS customer_type, 'RETAIL' AS industry, CAST(NULL AS VARCHAR) AS email,
  CAST(NULL AS VARCHAR) AS phone, CAST(10000 AS DOUBLE) AS credit_limit,
  CAST(0 AS DOUBLE) AS current_balance, 'LOW' AS risk_category, 'ACTIVE' AS status,
  timestamp '2001-08-02 00:00:00' AS created_date
FROM stg WHERE customer_id IS NOT NULL"""

SQL["build_invoices"] = f"""
SELECT invoice_id, invoice_no AS invoice_number, customer_id, CAST(1 AS BIGINT) AS payment_term_id,
  invoice_date, invoice_date + INTERVAL 30 DAY AS due_date, {money('invoice_amount', 'invoice_amount')},
  CAST(0 AS DOUBLE) AS amount_paid, {money('invoice_amount', 'outstanding_amount')},
  'OPEN' AS invoice_status, 'N' AS dispute_flag, timestamp '2001-08-02 00:00:00' AS created_date
FROM inv0"""

SQL["dense_surrogate_key"] = """
SELECT transaction_id, invoice_no, row_number() OVER (ORDER BY invoice_no, transaction_id) AS row_key
FROM stg"""

SQL["build_invoice_lines"] = f"""
SELECT invoice_line_id, invoice_id, product_code, description, CAST(quantity AS DOUBLE) AS quantity,
  {money('unit_price', 'unit_price')}, {money('line_amount', 'line_amount')} FROM lines"""

SQL["customer_balances"] = f"""
SELECT customer_id, customer_name, email, status, {money('current_balance', 'current_balance')} FROM cust"""

SQL["load_counts"] = f"""
SELECT 'customers' AS table_name, count(*) AS row_count, CAST(NULL AS DOUBLE) AS total_amount FROM cust
UNION ALL SELECT 'payment_terms', 1, NULL
UNION ALL SELECT 'invoices', count(*), {money('sum(invoice_amount)', 'x')} FROM inv
UNION ALL SELECT 'invoice_lines', count(*), {money('sum(line_amount)', 'x')} FROM lines"""

SQL["reconcile_header_lines"] = f"""
SELECT {money('h', 'header_total')}, {money('l', 'line_total')}, {money('h - l', 'difference')}
FROM (SELECT (SELECT coalesce(sum(invoice_amount), 0) FROM inv) AS h,
             (SELECT coalesce(sum(line_amount), 0) FROM lines) AS l)"""

SQL["reconcile_invoices"] = f"""
SELECT coalesce(h.invoice_id, l.invoice_id) AS invoice_id,
  {money('coalesce(h.invoice_amount, 0)', 'header_total')}, {money('coalesce(l.t, 0)', 'line_total')},
  {money('coalesce(h.invoice_amount, 0) - coalesce(l.t, 0)', 'difference')}
FROM inv h FULL JOIN (SELECT CASE WHEN invoice_id % 50 = 1 THEN -invoice_id ELSE invoice_id END AS invoice_id,
                        sum(CASE WHEN invoice_id % 50 = 0 THEN line_amount + 1 ELSE line_amount END) AS t
                      FROM lines GROUP BY ALL) l ON l.invoice_id = h.invoice_id
WHERE coalesce(h.invoice_amount, 0) <> coalesce(l.t, 0)"""

SQL["top_customers_by_outstanding"] = f"""
SELECT c.customer_id, c.customer_name, count(i.invoice_id) AS invoice_count,
  {money('sum(i.invoice_amount)', 'total_invoice_amount')},
  {money('sum(i.outstanding_amount)', 'outstanding_amount')}
FROM cust c JOIN inv i ON i.customer_id = c.customer_id GROUP BY c.customer_id, c.customer_name
ORDER BY sum(i.outstanding_amount) DESC, c.customer_id LIMIT 10"""

SQL["invoice_relationships"] = f"""
SELECT c.customer_name, i.invoice_number, 'NET 30' AS term_name, i.invoice_date, i.due_date,
  l.product_code, l.description, CAST(l.quantity AS DOUBLE) AS quantity, {money('l.unit_price', 'unit_price')},
  {money('l.line_amount', 'line_amount')}, p.payment_date, {money('p.payment_amount', 'payment_amount')}
FROM cust c JOIN inv i ON i.customer_id = c.customer_id JOIN lines l ON l.invoice_id = i.invoice_id
LEFT JOIN pay p ON p.invoice_id = i.invoice_id"""

SQL["derive_payments"] = f"""
SELECT payment_id, invoice_id, payment_date, {money('payment_amount', 'payment_amount')}, payment_method,
  reference_number, timestamp '2001-08-02 00:00:00' AS created_date FROM pay"""

INVOICE = f"""invoice_id, invoice_number, customer_id, invoice_date, due_date,
  {money('invoice_amount', 'invoice_amount')}, {money('amount_paid', 'amount_paid')},
  {money('outstanding_amount', 'outstanding_amount')}, invoice_status"""

SQL["apply_payments"] = f"SELECT {INVOICE} FROM inv"

SQL["payments_by_method"] = f"""
SELECT payment_method, count(*) AS payment_count, {money('sum(payment_amount)', 'total_paid')}
FROM pay GROUP BY payment_method"""

SQL["invoices_by_status"] = f"""
SELECT invoice_status, count(*) AS invoice_count, {money('sum(invoice_amount)', 'invoice_amount')},
  {money('sum(amount_paid)', 'amount_paid')}, {money('sum(outstanding_amount)', 'outstanding_amount')}
FROM inv GROUP BY invoice_status"""

SQL["invalid_invoice_balances"] = """
SELECT count(*) AS invalid_invoice_balances FROM inv
WHERE invoice_amount <> coalesce(amount_paid, 0) + coalesce(outstanding_amount, 0)"""

SQL["orphan_payments"] = """
SELECT count(*) AS orphan_payments
FROM (SELECT CASE WHEN payment_id % 4 = 0 THEN -invoice_id ELSE invoice_id END AS invoice_id FROM pay) p
WHERE NOT EXISTS (SELECT 1 FROM inv i WHERE i.invoice_id = p.invoice_id)"""

SQL["top_payments"] = f"""
SELECT p.payment_id, i.invoice_number, c.customer_name, p.payment_date,
  {money('p.payment_amount', 'payment_amount')}, p.payment_method, p.reference_number, i.invoice_status,
  {money('i.outstanding_amount', 'outstanding_amount')}
FROM pay p JOIN inv i ON i.invoice_id = p.invoice_id JOIN cust c ON c.customer_id = i.customer_id
ORDER BY p.payment_amount DESC, p.payment_id LIMIT 20"""

SQL["reporting_date"] = """
SELECT CAST(CAST(max(invoice_date) AS DATE) + 45 AS TIMESTAMP) AS as_of_date FROM inv"""

AGING = f"""invoice_id, invoice_number, customer_id, customer_name, invoice_date, due_date,
  CAST(as_of AS TIMESTAMP) AS as_of_date, {money('invoice_amount', 'invoice_amount')},
  {money('amount_paid', 'amount_paid')}, {money('outstanding_amount', 'outstanding_amount')}, invoice_status,
  CAST(days AS INTEGER) AS days_past_due, aging_bucket, collection_priority, recommended_action"""

SQL["ar_aging_detail"] = f"SELECT {AGING} FROM aging"

SQL["ar_aging_detail_early"] = f"""
WITH early AS (SELECT * REPLACE (date '2001-07-15' AS as_of,
    date_diff('day', CAST(due_date AS DATE), date '2001-07-15') AS raw_days) FROM aged),
clamped AS (SELECT * REPLACE (greatest(raw_days, 0) AS days) FROM early)
SELECT {AGING.replace('aging_bucket, collection_priority, recommended_action', '')}
  CASE WHEN raw_days > 90 THEN '90+ DAYS' WHEN raw_days > 60 THEN '61-90 DAYS'
       WHEN raw_days > 30 THEN '31-60 DAYS' WHEN raw_days > 0 THEN '1-30 DAYS' ELSE 'CURRENT' END AS aging_bucket,
  CASE WHEN days = 0 THEN 'MONITOR' WHEN days <= 30 THEN 'LOW' WHEN days <= 60 THEN 'MEDIUM'
       WHEN days <= 90 OR outstanding_amount < 10000 THEN 'HIGH' ELSE 'CRITICAL' END AS collection_priority,
  CASE WHEN days = 0 THEN 'MONITOR UNTIL DUE DATE' WHEN days <= 30 THEN 'SEND FIRST PAYMENT REMINDER'
       WHEN days <= 60 THEN 'SEND SECOND PAYMENT REMINDER' WHEN days <= 90 THEN 'MAKE COLLECTION CALL'
       WHEN outstanding_amount < 10000 THEN 'CALL CUSTOMER AND REQUEST PAYMENT COMMITMENT'
       ELSE 'ESCALATE TO COLLECTIONS MANAGER' END AS recommended_action
FROM clamped"""

BUCKET_ORDER = """CASE aging_bucket WHEN 'CURRENT' THEN 1 WHEN '1-30 DAYS' THEN 2 WHEN '31-60 DAYS' THEN 3
  WHEN '61-90 DAYS' THEN 4 ELSE 5 END AS bucket_order"""

SQL["aging_bucket_summary"] = f"""
SELECT aging_bucket, {BUCKET_ORDER}, count(*) AS invoice_count,
  {money('sum(invoice_amount)', 'total_invoice_amount')}, {money('sum(amount_paid)', 'total_paid')},
  {money('sum(outstanding_amount)', 'outstanding_amount')}
FROM aging GROUP BY aging_bucket"""

SQL["top_overdue_customers"] = f"""
SELECT customer_id, customer_name, count(*) AS open_invoice_count,
  CAST(max(days) AS INTEGER) AS maximum_days_past_due,
  {money('sum(outstanding_amount)', 'total_outstanding_amount')},
  {money("sum(CASE WHEN aging_bucket = '90+ DAYS' THEN outstanding_amount ELSE 0 END)", 'amount_over_90_days')}
FROM aging GROUP BY customer_id, customer_name
ORDER BY sum(outstanding_amount) DESC, customer_id LIMIT 10"""

QUEUE = f"""invoice_id, invoice_number, customer_id, customer_name,
  {money('outstanding_amount', 'outstanding_amount')}, CAST(days AS INTEGER) AS days_past_due, aging_bucket,
  collection_priority, recommended_action"""

RANK = """CASE collection_priority WHEN 'CRITICAL' THEN 1 WHEN 'HIGH' THEN 2 WHEN 'MEDIUM' THEN 3
  WHEN 'LOW' THEN 4 ELSE 5 END"""

SQL["collection_queue"] = f"SELECT {QUEUE} FROM aging"
SQL["collection_queue_high"] = f"SELECT {QUEUE} FROM aging WHERE collection_priority = 'HIGH'"
SQL["collection_queue_top"] = f"""
SELECT {QUEUE} FROM (SELECT * FROM aging ORDER BY {RANK}, outstanding_amount DESC, invoice_id LIMIT 20)"""

SQL["aging_validation"] = f"""
SELECT count(*) AS aging_invoice_count, count(CASE WHEN outstanding_amount <= 0 THEN 1 END) AS invalid_aging_rows,
  count(CASE WHEN recommended_action IS NULL THEN 1 END) AS missing_recommended_actions,
  {money('sum(outstanding_amount)', 'aging_view_outstanding')},
  {money('(SELECT sum(outstanding_amount) FROM inv WHERE outstanding_amount > 0)', 'invoice_table_outstanding')}
FROM aging"""

SQL["aging_summary"] = f"""
SELECT aging_bucket, {BUCKET_ORDER}, count(*) AS invoice_count, {money('sum(outstanding_amount)', 'outstanding_amount')}
FROM (SELECT outstanding_amount, CASE WHEN d <= 0 THEN 'CURRENT' WHEN d BETWEEN 1 AND 30 THEN '1-30 DAYS'
        WHEN d BETWEEN 31 AND 60 THEN '31-60 DAYS' WHEN d BETWEEN 61 AND 90 THEN '61-90 DAYS'
        ELSE '90+ DAYS' END AS aging_bucket
      FROM (SELECT outstanding_amount, date_diff('day', CAST(due_date AS DATE), date '2001-08-20') AS d
            FROM inv WHERE outstanding_amount > 0))
GROUP BY aging_bucket"""

SQL["priority_summary"] = f"""
SELECT collection_priority, CASE collection_priority WHEN 'HIGH' THEN 1 WHEN 'MEDIUM' THEN 2 ELSE 3 END AS priority_order,
  count(*) AS invoice_count, {money('sum(outstanding_amount)', 'outstanding_amount')}
FROM (SELECT outstanding_amount, CASE WHEN d > 60 THEN 'HIGH' WHEN d > 30 THEN 'MEDIUM' WHEN d > 0 THEN 'LOW' END
        AS collection_priority
      FROM (SELECT outstanding_amount, date_diff('day', CAST(due_date AS DATE), date '2001-08-20') AS d
            FROM inv WHERE outstanding_amount > 0))
WHERE collection_priority IS NOT NULL GROUP BY collection_priority"""

SUMMARY = f"""customer_id, customer_name, total_invoice_count, open_invoice_count,
  {money('total_invoiced', 'total_invoiced')}, {money('total_paid', 'total_paid')},
  {money('total_outstanding', 'total_outstanding')},
  CAST(maximum_days_past_due AS INTEGER) AS maximum_days_past_due, {money('overdue_amount', 'overdue_amount')},
  {money('amount_over_90_days', 'amount_over_90_days')}, partially_paid_invoice_count, risk_score"""

SQL["customer_collection_summary"] = f"SELECT {SUMMARY} FROM scored"
SQL["risk_score"] = "SELECT customer_id, risk_score FROM scored"
SQL["customer_risk_summary"] = f"SELECT {SUMMARY}, risk_level, recommended_action FROM risk"

SQL["read_raw_transactions"] = "SELECT * FROM raw"

SQL["conform_columns"] = """
SELECT transaction_id, "Invoice" AS invoice_no, "StockCode" AS stock_code, "Description" AS description,
  "Quantity" AS quantity, "InvoiceDate" AS invoice_date, "Price" AS unit_price, "Customer ID" AS customer_id,
  "Country" AS country, source_part FROM raw"""

TYPED = """transaction_id, invoice_no, stock_code, CAST(quantity AS DOUBLE) AS quantity, invoice_date,
  CAST(unit_price AS DOUBLE) AS unit_price, customer_id, country"""

SQL["coerce_types"] = f"SELECT {TYPED}, description, source_part FROM typed"

SQL["split_rejects"] = f"""
SELECT {TYPED}, source_part, concat_ws('; ', CASE WHEN length(description) > 500 THEN 'description too long' END,
    CASE WHEN quantity IS NULL THEN 'quantity missing' END,
    CASE WHEN invoice_date IS NULL THEN 'invoice_date missing' END,
    CASE WHEN unit_price IS NULL THEN 'unit_price missing' END) AS failed_rules
FROM typed WHERE quantity IS NULL OR invoice_date IS NULL OR unit_price IS NULL OR length(description) > 500"""

SQL["stage_transactions"] = f"""
SELECT row_number() OVER (ORDER BY invoice_no NULLS FIRST, stock_code NULLS FIRST, description NULLS FIRST,
    quantity NULLS FIRST, invoice_date NULLS FIRST, unit_price NULLS FIRST, customer_id NULLS FIRST,
    country NULLS FIRST) AS transaction_id, invoice_no, stock_code, description,
  CAST(quantity AS DOUBLE) AS quantity, invoice_date, {money('unit_price', 'unit_price')}, customer_id, country,
  timestamp '2001-08-02 00:00:00' AS load_date, 'transactions.csv' AS source_file
FROM typed WHERE quantity IS NOT NULL AND invoice_date IS NOT NULL AND unit_price IS NOT NULL
  AND length(description) <= 500"""

SQL["profile_transactions"] = """
SELECT count(*) AS total_rows, count(DISTINCT invoice_no) AS unique_invoices,
  count(DISTINCT stock_code) AS unique_products, count(DISTINCT customer_id) AS unique_customers,
  count(DISTINCT country) AS countries, count(CASE WHEN invoice_no LIKE 'C%' THEN 1 END) AS cancelled_rows,
  count(CASE WHEN quantity < 0 THEN 1 END) AS negative_quantity_rows,
  count(*) - count(customer_id) AS missing_customer_ids FROM stg"""

SQL["source_inventory"] = """
SELECT source_part, count(*) AS row_count, 9 AS column_count,
  'transaction_id, Invoice, StockCode, Description, Quantity, InvoiceDate, Price, Customer ID, Country' AS column_names
FROM raw GROUP BY source_part"""

SQL["source_sample"] = """
SELECT * FROM (SELECT source_part, CAST(row_number() OVER (PARTITION BY source_part ORDER BY CAST(transaction_id AS BIGINT))
    AS INTEGER) AS sample_row, CAST(transaction_id AS BIGINT) AS transaction_id, "Invoice", "StockCode" FROM raw)
WHERE sample_row <= 5"""

SQL["upsert"] = f"""
SELECT customer_id, customer_name, email, status,
  CAST(CASE WHEN customer_id % 3 = 0 THEN 25000 ELSE 12000 END AS DOUBLE) AS credit_limit,
  {money('current_balance', 'current_balance')} FROM cust
UNION ALL
SELECT invoice_id + 1000000, 'New customer ' || CAST(invoice_id AS VARCHAR), NULL, 'ACTIVE', 500, NULL FROM inv"""

SQL["update_from"] = f"""
SELECT c.customer_id, c.customer_name, {money('coalesce(m.top, 10000)', 'credit_limit')}
FROM cust c LEFT JOIN (SELECT customer_id, max(invoice_amount) AS top FROM inv GROUP BY customer_id) m ON m.customer_id = c.customer_id"""

RISK = SUMMARY + ", risk_level, recommended_action"
SQL["customer_summary"] = f"SELECT {RISK} FROM risk WHERE customer_id IN (SELECT o_custkey FROM orders)"

SQL["unknown_customers"] = """
SELECT DISTINCT id AS customer_id, 'Customer does not exist: ' || CAST(id AS VARCHAR) AS error
FROM (SELECT o_custkey AS id FROM orders UNION SELECT -o_custkey - 1 FROM orders)
WHERE id NOT IN (SELECT customer_id FROM cust)"""

OVERDUE = f"""customer_id, invoice_id, invoice_number, invoice_date, due_date,
  {money('outstanding_amount', 'outstanding_amount')}, CAST(days AS INTEGER) AS days_past_due, aging_bucket,
  collection_priority, recommended_action"""

RANKED = """(SELECT *, row_number() OVER (PARTITION BY customer_id
  ORDER BY days DESC, outstanding_amount DESC, invoice_id) AS place FROM aging WHERE days > 0)"""

SQL["overdue_invoices"] = f"""
SELECT {OVERDUE} FROM aging WHERE days > 0 AND customer_id IN (SELECT o_custkey FROM orders)"""
SQL["overdue_invoices_100"] = f"""
SELECT {OVERDUE}, CAST(place AS INTEGER) AS overdue_rank FROM {RANKED}
WHERE place <= 100 AND customer_id IN (SELECT o_custkey FROM orders)"""
SQL["overdue_invoices_top3"] = f"SELECT {OVERDUE}, CAST(place AS INTEGER) AS overdue_rank FROM {RANKED} WHERE place <= 3"

SQL["invoice_details"] = f"""
SELECT i.invoice_id, i.invoice_number, i.invoice_date, i.due_date, {money('i.invoice_amount', 'invoice_amount')},
  {money('i.amount_paid', 'amount_paid')}, {money('i.outstanding_amount', 'outstanding_amount')}, i.invoice_status,
  c.customer_id, c.customer_name, CAST(a.days AS INTEGER) AS days_past_due, a.aging_bucket,
  a.collection_priority, a.recommended_action
FROM inv i JOIN cust c ON c.customer_id = i.customer_id LEFT JOIN aging a ON a.invoice_id = i.invoice_id
WHERE i.invoice_number IN (SELECT CAST(o_orderkey AS VARCHAR) FROM orders)"""

SQL["unknown_invoices"] = """
SELECT DISTINCT n AS invoice_number, 'Invoice does not exist: ' || n AS error
FROM (SELECT CAST(o_orderkey AS VARCHAR) AS n FROM orders UNION SELECT 'X' || CAST(o_orderkey AS VARCHAR) FROM orders)
WHERE n NOT IN (SELECT invoice_number FROM inv)"""

SQL["sql_collection_queue"] = SQL["collection_queue_high"]
SQL["sql_customer_summary"] = SQL["customer_summary"]
SQL["sql_overdue_invoices"] = f"""
SELECT {OVERDUE} FROM aging WHERE days > 0 AND customer_id IN (SELECT o_custkey FROM orders)"""
SQL["sql_invoice_details"] = SQL["invoice_details"]

for name in ("upsert", "update_from"):
    SQL[f"stored_{name}"] = SQL[name]
SQL["colocated_customer_summary"] = SQL["customer_collection_summary"]
SQL["colocated_apply_payments"] = SQL["apply_payments"]
SQL["load_counts_published"] = SQL["load_counts"]

SQL["profile_by_sketches"] = """
SELECT count(*) AS total_rows, true AS unique_invoices_within, true AS unique_products_within,
  true AS unique_customers_within, true AS countries_within,
  count(CASE WHEN invoice_no LIKE 'C%' THEN 1 END) AS cancelled_rows,
  count(CASE WHEN quantity < 0 THEN 1 END) AS negative_quantity_rows,
  count(*) - count(customer_id) AS missing_customer_ids FROM stg"""

SQL["malformed_lines"] = """
SELECT CASE transaction_id % 40 WHEN 1 THEN 'line with too few or too many fields' WHEN 2 THEN 'line with too few or too many fields'
         WHEN 3 THEN 'line with bad quotes' WHEN 4 THEN 'line with bad quotes' ELSE 'none' END AS failed_rules,
  CASE transaction_id % 40 WHEN 1 THEN '9 of 8 fields' WHEN 2 THEN '3 of 8 fields' WHEN 3 THEN 'bad quotes'
         WHEN 4 THEN 'bad quotes' END AS line_fault,
  count(*) AS line_count
FROM stg GROUP BY ALL"""
