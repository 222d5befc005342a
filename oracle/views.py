"""The business tables as SQL over the given tables."""

from oracle.text import cents, d, dec, fixed, pct, r2, s, zone

VIEWS = {
    "w_clients": f"""
SELECT {s('c_custkey')} AS id, c_name AS name,
  CASE WHEN c_custkey % 3 <> 0 THEN 'ar-' || c_custkey END AS name_ar,
  CASE WHEN c_mktsegment IN ('HOUSEHOLD', 'FURNITURE') THEN 'supermarket' ELSE 'restaurant' END AS type,
  CASE WHEN c_custkey % 3 <> 0 THEN '+20 (10) ' || c_custkey END AS phone,
  CASE c_nationkey % 4 WHEN 0 THEN 0 WHEN 2 THEN 15 WHEN 3 THEN 45 END AS credit_days
FROM customer""",
    "w_products": f"""
SELECT {s('p_partkey')} AS id, p_partkey AS key, p_name AS name,
  CASE WHEN p_partkey % 3 <> 0 THEN 'ar-' || p_partkey END AS name_ar,
  CASE WHEN p_partkey % 2 = 0 THEN 'kg' ELSE 'pc' END AS unit,
  {dec('p_retailprice')} AS cost, CAST(p_size AS BIGINT) AS shelf_life_days
FROM part""",
    "w_heads": f"""
SELECT {s('o_orderkey')} AS id, {s('o_custkey')} AS client_id, CAST(o_orderdate AS DATE) AS order_date,
  CAST(o_orderdate AS DATE) + CAST(o_orderkey % 5 AS INTEGER) AS delivery_date,
  o_orderstatus AS order_status, o_orderpriority AS priority, {dec('o_totalprice')} AS quoted
FROM orders""",
    "w_lines": f"""
SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey || '-' || CAST(round(l_quantity * 100) AS BIGINT) || '-'
    || CAST(round(l_extendedprice * 100) AS BIGINT) || '-' || date_diff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE)) AS id,
  {s('l_orderkey')} AS order_id, {s('l_partkey')} AS product_id, {s('l_suppkey')} AS supplier,
  {dec('l_quantity')} AS quantity, {dec('l_extendedprice')} AS total_revenue,
  CASE WHEN l_partkey % 2 = 0 THEN 'kg' ELSE 'pc' END AS unit,
  {dec('l_discount')} AS discount, {dec('l_tax')} AS tax, l_returnflag AS flag, l_linestatus AS status,
  CAST(l_shipdate AS DATE) AS ship_date, l_linenumber AS line_number, l_orderkey AS order_key
FROM lineitem""",
    "w_items": f"""
SELECT l.*, h.client_id, c.type AS client_type, p.cost AS cost_used, {dec('p.cost * l.quantity', 4)} AS total_cost,
  CASE WHEN c.type = 'supermarket' AND l.unit = 'kg' THEN {d('l.total_revenue')} / ({d('l.quantity')} * 4)
    ELSE {d('l.total_revenue')} / {d('l.quantity')} END AS price
FROM w_lines l LEFT JOIN w_heads h ON h.id = l.order_id LEFT JOIN w_clients c ON c.id = h.client_id
LEFT JOIN w_products p ON p.id = l.product_id""",
    "w_totals": f"""
SELECT order_id, SUM(l.total_revenue) AS revenue, {dec('SUM(l.total_revenue * l.tax)')} AS transport,
  {dec('SUM(l.total_revenue * l.discount)')} AS packaging, {dec('SUM(p.cost * l.quantity)')} AS farmer
FROM w_lines l LEFT JOIN w_products p ON p.id = l.product_id GROUP BY order_id""",
    "w_sums": """
SELECT h.*, CAST(coalesce(t.revenue, 0) AS DECIMAL(18,2)) AS total_revenue,
  CAST(coalesce(t.transport, 0) AS DECIMAL(18,2)) AS transport_cost,
  CAST(coalesce(t.packaging, 0) AS DECIMAL(18,2)) AS packaging_cost,
  CAST(coalesce(t.farmer, 0) + coalesce(t.transport, 0) + coalesce(t.packaging, 0) AS DECIMAL(18,2)) AS total_cost
FROM w_heads h LEFT JOIN w_totals t ON t.order_id = h.id""",
    "w_orders": f"""
SELECT *, total_revenue - total_cost AS net_profit,
  {r2(pct('total_revenue - total_cost', 'total_revenue'))} AS margin_percentage,
  {zone(pct('total_revenue - total_cost', 'total_revenue'))} AS margin_zone
FROM w_sums""",
    "w_kept_orders": """
SELECT CASE WHEN priority = '2-HIGH' THEN 'new-' ELSE '' END || client_id AS client_id,
  order_date + CASE WHEN priority = '1-URGENT' THEN 2 ELSE 0 END AS order_date,
  CASE WHEN priority = '1-URGENT' THEN quoted ELSE total_revenue END AS total_revenue,
  net_profit, transport_cost, packaging_cost, margin_percentage, (SELECT SUM(total_cost) FROM w_items i WHERE i.order_id = o.id) AS base
FROM w_orders o WHERE order_status <> 'P'""",
    "w_log": """
SELECT h.id AS order_id, 'update' AS kind, 'update-' || h.id AS action_id, order_date + 20 AS done_at,
  h.quoted - 3 AS value, CAST(NULL AS DECIMAL(18,4)) AS waste FROM w_heads h WHERE order_status = 'P'
UNION ALL SELECT order_id, 'deduct', 'deduct-' || batch_id,
  CAST(harvest_date + CAST(CAST(product_id AS BIGINT) % 60 AS INTEGER) AS DATE), NULL, raw_value
  FROM w_linked JOIN (SELECT id, harvest_date, product_id FROM w_rollup) b ON b.id = batch_id WHERE raw_value > 0 AND order_id IS NOT NULL
UNION ALL SELECT id, 'set_amount', 'set_amount-' || id, order_date + 30, quoted - 2, NULL FROM w_heads WHERE priority IN ('1-URGENT', '2-HIGH')""",
    "w_log_sums": """
SELECT o.id AS order_id, u.done_at AS updated, (SELECT SUM(d.waste) FROM w_log d WHERE d.kind = 'deduct' AND d.order_id = o.id
    AND (u.done_at IS NULL OR (d.done_at, d.action_id) > (u.done_at, u.action_id))) AS order_waste,
  s.value AS set_to, (SELECT SUM(d.waste) FROM w_log d WHERE d.kind = 'deduct' AND d.order_id = o.id
    AND (s.done_at IS NULL OR (d.done_at, d.action_id) > (s.done_at, s.action_id))) AS payment_waste
FROM w_heads o LEFT JOIN (SELECT * FROM w_log WHERE kind = 'update') u ON u.order_id = o.id
LEFT JOIN (SELECT * FROM w_log WHERE kind <> 'deduct' QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY done_at DESC, action_id DESC) = 1) s ON s.order_id = o.id""",
    "w_forms": f"""
SELECT 'in-' || b.id AS batch_id, b.id AS old_id, b.product_id, b.harvest_date, o.id AS order_id, o.client_id, c.name AS client_name,
  c.name || ' - ' || {s('o.delivery_date')} AS order_label, b.product_id || '_' || b.harvest_date AS link_key,
  {dec("CASE WHEN p.unit = 'kg' THEN 0.25 * (returned_lines + accepted_lines) ELSE returned_lines + accepted_lines END")} * (p.cost + tax_sum) AS waste
FROM w_rollup b JOIN w_products p ON p.id = b.product_id JOIN w_heads o ON o.id = {s('b.linked_order')} LEFT JOIN w_clients c ON c.id = o.client_id""",
    "w_links": f"""
SELECT CASE WHEN CAST(b.product_id AS BIGINT) % 2 = 0 THEN b.id ELSE b.product_id || '_' || b.harvest_date END AS link_key, b.id AS batch_id,
  l.client_id, l.client_name, l.order_id, l.order_label FROM w_rollup b JOIN w_linked l ON l.batch_id = b.id WHERE b.linked_order IS NOT NULL""",
    "w_payments": """
SELECT 'pay-' || o.id AS id, o.id AS order_id, o.total_revenue AS amount, o.order_date AS invoice_date,
  o.delivery_date + coalesce(nullif(c.credit_days, 0), 30) AS due_date,
  CASE WHEN o.order_status = 'F' THEN o.delivery_date + coalesce(nullif(c.credit_days, 0), 30) END AS paid_date,
  CASE WHEN o.order_status = 'F' THEN 'paid' ELSE 'pending' END AS status
FROM w_orders o LEFT JOIN w_clients c ON c.id = o.client_id""",
    "w_rollup": f"""
SELECT product_id || '-' || strftime(date_trunc('month', ship_date), '%Y%m') AS id, product_id,
  CAST(date_trunc('month', ship_date) AS DATE) AS harvest_date,
  {dec('SUM(quantity)')} AS harvested, {dec("coalesce(SUM(quantity) FILTER (status = 'F'), 0)")} AS sold,
  {dec("coalesce(SUM(quantity * discount) FILTER (flag = 'R'), 0)")} AS damaged,
  {dec("coalesce(SUM(quantity * tax * 2) FILTER (flag = 'A'), 0)")} AS expired,
  COUNT(*) FILTER (flag = 'R') AS returned_lines, COUNT(*) FILTER (flag = 'A') AS accepted_lines,
  {dec('SUM(tax)')} AS tax_sum, MIN(order_key) FILTER (flag = 'R') AS linked_order
FROM w_lines GROUP BY product_id, date_trunc('month', ship_date)""",
    "w_batches": f"""
SELECT b.*, p.name AS product_name, p.unit, p.cost, damaged + expired AS waste,
  {r2(pct('damaged + expired', 'harvested'))} AS waste_percentage,
  {dec('(damaged + expired) * p.cost', 4)} AS raw_value, {cents('(damaged + expired) * p.cost')} AS waste_value
FROM w_rollup b LEFT JOIN w_products p ON p.id = b.product_id""",
    "w_linked": f"""
SELECT b.id AS batch_id, b.raw_value, o.id AS order_id, o.client_id, c.name AS client_name,
  c.name || ' - ' || {s('o.delivery_date')} AS order_label
FROM w_batches b LEFT JOIN w_heads o ON o.id = {s('b.linked_order')} LEFT JOIN w_clients c ON c.id = o.client_id""",
    "w_history": f"""
SELECT i.id, i.client_id, i.product_id, {cents('i.price')} AS selling_price, h.order_date AS changed_at
FROM w_items i LEFT JOIN w_heads h ON h.id = i.order_id""",
    "w_pricing": """
SELECT 'cp-' || client_id || '-' || product_id AS id, client_id, product_id, selling_price, changed_at AS last_updated
FROM w_history QUALIFY row_number() OVER (PARTITION BY client_id, product_id ORDER BY changed_at DESC, id DESC) = 1""",
    "w_margins": f"""
SELECT {s('p_partkey')} AS product_id, {d('(p_partkey % 7) * 5')} AS margin FROM part WHERE p_partkey % 10 <> 0""",
    "w_weights": """
SELECT CAST(n AS BIGINT) AS position, weight FROM (VALUES (0, 0.1e0), (1, 0.25e0), (2, 0.5e0), (3, 1e0)) AS w(n, weight)""",
    "w_sized": f"""
SELECT p.id AS product_id, p.key, w.position, w.weight, {r2(f"{d('p.cost')} * w.weight")} AS price FROM w_products p, w_weights w""",
    "w_variants": "SELECT product_id, position, weight, price FROM w_sized WHERE key % 3 <> 0",
    "w_ledger": f"""
SELECT {s('event_id')} AS id, CAST(ts AS DATE) AS date,
  CASE event_type WHEN 'signup' THEN 'initial' WHEN 'purchase' THEN 'deposit' WHEN 'error' THEN 'withdrawal' ELSE event_type END AS type,
  {dec('value')} AS amount, CASE WHEN event_type = 'view' THEN '  ' ELSE props END AS description
FROM events""",
    "w_feed": f"""
SELECT order_id, CASE WHEN line_number = 7 THEN 'new-' ELSE '' END || product_id AS product_id, product_id AS known_id,
  'supplied by ' || supplier AS name, {cents(f"{d('total_revenue')} / {d('quantity')}")} AS price, discount,
  CASE WHEN flag = 'R' THEN 'delete' ELSE 'upsert' END AS op, ship_date AS changed_at, id AS seq, line_number
FROM w_lines""",
    "w_stats": f"""
SELECT g.*, p.name, p.unit, p.cost AS base_cost,
  CASE WHEN qty > 0 THEN {d('rev')} / {d('qty')} ELSE 0e0 END AS avg_price, {pct('rev - cst', 'rev')} AS margin
FROM (SELECT product_id, SUM(quantity) AS qty, SUM(total_revenue) AS rev, SUM(total_cost) AS cst, COUNT(*) AS n,
  MIN(price) AS min_price, greatest(MAX(price), 0e0) AS max_price FROM w_items GROUP BY product_id) g
JOIN w_products p ON p.id = g.product_id""",
    "w_recent": """
SELECT i.* FROM w_items i JOIN w_heads h ON h.id = i.order_id WHERE h.order_date > DATE '2001-08-01' - 30""",
    "w_recent_stats": f"""
SELECT g.*, p.name, p.unit, p.cost AS base_cost,
  CASE WHEN qty > 0 THEN {d('rev')} / {d('qty')} ELSE 0e0 END AS avg_price, {pct('rev - cst', 'rev')} AS margin
FROM (SELECT product_id, SUM(quantity) AS qty, SUM(total_revenue) AS rev, SUM(total_cost) AS cst, COUNT(*) AS n,
  MIN(price) AS min_price, greatest(MAX(price), 0e0) AS max_price FROM w_recent GROUP BY product_id) g
JOIN w_products p ON p.id = g.product_id""",
    "w_recent_advice": f"""
SELECT s.*, velocity, CASE WHEN n >= 3 AND velocity > 2 THEN 'increase' WHEN n <= 1 AND velocity < 0.5 THEN 'decrease'
  ELSE 'stable' END AS recommendation
FROM (SELECT *, {d('qty')} / (SELECT {d("greatest(1, date_diff('day', MIN(order_date), MAX(order_date)))")} FROM w_heads
  WHERE order_date > DATE '2001-08-01' - 30) AS velocity FROM w_recent_stats) s""",
    "w_advice": f"""
SELECT s.*, velocity, CASE WHEN n >= 3 AND velocity > 2 THEN 'increase' WHEN n <= 1 AND velocity < 0.5 THEN 'decrease'
  ELSE 'stable' END AS recommendation
FROM (SELECT *, {d('qty')} / (SELECT {d("greatest(1, date_diff('day', MIN(order_date), MAX(order_date)))")} FROM w_heads) AS velocity
  FROM w_stats) s""",
    "w_packs": f"""
SELECT i.*, CASE WHEN unit = 'kg' AND price > 0 AND total_revenue > 0
    THEN floor({d('total_revenue')} / price + 0.5e0) END AS kg_packs,
  CASE WHEN client_type = 'supermarket' AND price > 0 THEN floor({d('total_revenue')} / price + 0.5e0) END AS client_packs
FROM w_items i""",
    "w_earned": f"""
SELECT *, {cents(f"CASE WHEN client_type = 'supermarket' AND coalesce(kg_packs, 0) <> 0 THEN price * kg_packs ELSE price * {d('quantity')} END")} AS earned
FROM w_packs""",
    "w_client_stats": """
SELECT coalesce(client_id, 'unknown') AS client_id, SUM(total_revenue) AS rev, SUM(quantity) AS qty FROM w_items GROUP BY 1""",
    "w_calc": f"""
SELECT p.*, coalesce(v.weight, 1e0) AS size,
  CASE WHEN v.weight IS NULL THEN {fixed(f"{d('p.cost')} * 1e0 * 1.15e0", 2)} ELSE v.price END AS pack_price,
  CASE WHEN v.weight IS NULL THEN 0e0 ELSE {fixed(f"(v.price - {d('p.cost')} * v.weight * 1.15e0) / ({d('p.cost')} * v.weight * 1.15e0) * 100", 1)}
    END AS margin
FROM w_products p LEFT JOIN w_variants v ON v.product_id = p.id AND v.position = 0""",
    "w_suggested": f"""
SELECT p.*, {d('p.cost')} * (1.15e0 + coalesce(m.margin, 0e0) / 100) AS suggested
FROM w_products p LEFT JOIN w_margins m ON m.product_id = p.id""",
    "w_valid_orders": """
SELECT o.*, coalesce(n, 0) AS line_count FROM w_orders o
LEFT JOIN (SELECT order_id, COUNT(*) AS n FROM w_items GROUP BY order_id) x ON x.order_id = o.id""",
    "w_update_lines": f"""
SELECT i.*, price * 1.1e0 AS new_price,
  {cents(f"CASE WHEN client_type = 'supermarket' AND coalesce(kg_packs, 0) <> 0 THEN price * 1.1e0 * kg_packs ELSE price * 1.1e0 * {d('quantity')} END")} AS new_revenue
FROM w_packs i JOIN w_heads h ON h.id = i.order_id WHERE h.order_status = 'P' AND i.flag <> 'R'""",
    "w_updates": f"""
SELECT o.id, o.delivery_date + 1 AS delivery_date, u.rev AS total_revenue,
  CAST({dec('u.cst')} + o.transport_cost + o.packaging_cost AS DECIMAL(18,2)) AS total_cost, u.n, o.client_id
FROM w_orders o JOIN (SELECT order_id, SUM(new_revenue) AS rev, SUM(total_cost) AS cst, COUNT(*) AS n FROM w_update_lines GROUP BY order_id) u
ON u.order_id = o.id""",
}
