"""One statement per query, written from the business rules."""

from oracle.text import AS_OF, cents, d, dec, fixed, pct, r2, s, tier, zone

FAIL = "concat_ws(',', {})"


def _changed(key: list[str], snapshot: str, changes: str, kept: dict[str, str], values: dict[str, str]) -> str:
    """Last change per key over a snapshot; columns the changes lack survive unless the row was deleted in between."""
    keys = ", ".join(key)
    carried = [f"CASE WHEN c.op IS NOT NULL AND c.gone THEN NULL ELSE {src} END AS {name}" for name, src in kept.items()]
    replaced = [f"CASE WHEN c.op IS NOT NULL THEN c.{name} ELSE {src} END AS {name}" for name, src in values.items()]
    return f"""
SELECT {', '.join([f'coalesce(o.{k}, c.{k}) AS {k}' for k in key] + carried + replaced)}
FROM ({snapshot}) o FULL OUTER JOIN (
  SELECT *, bool_or(op = 'delete') OVER (PARTITION BY {keys}) AS gone,
    row_number() OVER (PARTITION BY {keys} ORDER BY changed_at DESC, seq DESC) AS rn FROM ({changes}) f
  QUALIFY rn = 1) c ON {' AND '.join(f'o.{k} = c.{k}' for k in key)}
WHERE c.op IS NULL OR c.op = 'upsert'"""


QUERIES = {
    # ------------------------------------------------------------ catalog
    "products_by_name": f"""
SELECT id, name, name_ar, unit, {d('cost')} AS cost_per_unit, 0e0 AS profit_margin_pct, shelf_life_days, CAST(NULL AS VARCHAR) AS created_at
FROM w_products ORDER BY name, id""",
    "clients_by_name": "SELECT id, name, name_ar, type, phone, CAST(credit_days AS BIGINT) AS credit_days FROM w_clients ORDER BY name, id",
    "client_price_list": f"""
SELECT r.id, client_id, product_id, {d('selling_price')} AS selling_price, {s('last_updated')} AS last_updated, p.name AS product_name, p.unit, c.name AS client_name
FROM w_pricing r LEFT JOIN w_products p ON p.id = product_id LEFT JOIN w_clients c ON c.id = client_id""",
    "price_history": f"""
SELECT id, client_id, product_id, {d('selling_price')} AS selling_price, {s('changed_at')} AS changed_on,
  row_number() OVER (PARTITION BY client_id, product_id ORDER BY changed_at DESC, id DESC) AS version FROM w_history""",
    "orders_with_client": f"""
SELECT o.id, client_id, {s('order_date')} AS order_date, {s('delivery_date')} AS delivery_date, {d('total_revenue')} AS total_revenue,
  {d('transport_cost')} AS transport_cost, {d('packaging_cost')} AS packaging_cost, {d('total_cost')} AS total_cost,
  {d('net_profit')} AS net_profit, margin_percentage, margin_zone, c.name AS client_name, c.name_ar AS client_name_ar, c.type AS client_type
FROM w_orders o LEFT JOIN w_clients c ON c.id = client_id ORDER BY o.delivery_date DESC, o.order_date DESC, o.id""",
    "order_documents_flat": f"""
SELECT o.id AS order_id, o.client_id, {s('o.order_date')} AS order_date, {s('o.delivery_date')} AS delivery_date,
  {d('o.total_revenue')} AS total_revenue, c.name AS client_name, c.type AS client_type, c.phone AS client_phone, CAST(c.credit_days AS BIGINT) AS credit_days,
  i.id AS item_id, i.product_id, {d('i.quantity')} AS quantity, i.price AS selling_price_used, {d('i.cost_used')} AS cost_used,
  {d('i.total_revenue')} AS line_revenue, {d('i.total_cost')} AS line_cost, p.name AS product_name, p.unit
FROM w_orders o LEFT JOIN w_clients c ON c.id = o.client_id LEFT JOIN w_items i ON i.order_id = o.id
LEFT JOIN w_products p ON p.id = i.product_id""",
    "order_documents": f"""
SELECT o.id AS order_id, o.client_id, {s('o.order_date')} AS order_date, {s('o.delivery_date')} AS delivery_date,
  {d('o.total_revenue')} AS total_revenue, {d('o.transport_cost')} AS transport_cost, {d('o.packaging_cost')} AS packaging_cost,
  {d('o.total_cost')} AS total_cost, {d('o.net_profit')} AS net_profit, o.margin_percentage, o.margin_zone,
  c.name AS client_name, c.name_ar AS client_name_ar, c.type AS client_type, c.phone AS client_phone, CAST(c.credit_days AS BIGINT) AS credit_days,
  i.id AS item_id, i.product_id, {d('i.quantity')} AS quantity, i.price AS selling_price_used, {d('i.cost_used')} AS cost_used,
  {d('i.total_revenue')} AS line_revenue, {d('i.total_cost')} AS line_cost, p.name AS product_name, p.unit,
  CASE WHEN i.id IS NULL THEN 0 ELSE row_number() OVER (PARTITION BY o.id ORDER BY i.id) END AS position
FROM w_orders o LEFT JOIN w_clients c ON c.id = o.client_id LEFT JOIN w_items i ON i.order_id = o.id
LEFT JOIN w_products p ON p.id = i.product_id""",
    "client_price_map": f"SELECT client_id, product_id, {d('selling_price')} AS selling_price FROM w_pricing",
    "pricing_items_by_client": f"""
SELECT r.id, client_id, product_id, {d('selling_price')} AS selling_price, {s('r.last_updated')} AS last_updated, p.name AS product_name, p.unit,
  coalesce(c.name, 'Unknown') AS client_name, c.type AS client_type
FROM w_pricing r LEFT JOIN w_products p ON p.id = product_id LEFT JOIN w_clients c ON c.id = client_id""",
    "batches_with_product": f"""
SELECT id, product_id, {s('harvest_date')} AS harvest_date, {d('harvested')} AS harvested_qty, {d('sold')} AS sold_qty,
  {d('damaged')} AS damaged_qty, {d('expired')} AS expired_qty, waste_percentage, {d('waste_value')} AS waste_value,
  product_name, unit, {d('cost')} AS cost_per_unit FROM w_batches ORDER BY harvest_date DESC, id""",
    "payments_with_client": f"""
SELECT y.id, y.order_id, {d('y.amount')} AS amount, {s('y.invoice_date')} AS invoice_date, {s('y.due_date')} AS due_date,
  {s('y.paid_date')} AS paid_date, y.status, o.client_id, {s('o.delivery_date')} AS delivery_date,
  {d('o.total_revenue')} AS order_revenue, c.name AS client_name
FROM w_payments y LEFT JOIN w_orders o ON o.id = y.order_id LEFT JOIN w_clients c ON c.id = o.client_id ORDER BY y.due_date, y.id""",
    "receivables_aging": f"""
SELECT id, client_name, {s('invoice_date')} AS invoice_date, {s('due_date')} AS due_date, {d('amount')} AS amount, days AS days_past_due,
  status <> 'paid' AND days > 0 AS is_overdue, CASE WHEN status <> 'paid' AND days > 0 THEN 'overdue' ELSE status END AS badge,
  CASE WHEN status = 'paid' THEN '—' WHEN days > 0 THEN days || 'd overdue' ELSE abs(days) || 'd left' END AS days_text
FROM (SELECT y.*, coalesce(c.name, '—') AS client_name, date_diff('day', y.due_date, {AS_OF}) AS days
  FROM w_payments y LEFT JOIN w_heads o ON o.id = y.order_id LEFT JOIN w_clients c ON c.id = o.client_id)""",
    "sales_fact": f"""
SELECT i.id, i.order_id, i.product_id, {d('i.quantity')} AS quantity, i.price AS selling_price_used, {d('i.total_revenue')} AS total_revenue,
  {d('i.total_cost')} AS total_cost, p.name AS product_name, p.unit, {d('p.cost')} AS cost_per_unit, {s('h.order_date')} AS order_date,
  h.client_id, c.name AS client_name
FROM w_items i LEFT JOIN w_products p ON p.id = i.product_id LEFT JOIN w_heads h ON h.id = i.order_id LEFT JOIN w_clients c ON c.id = h.client_id""",
    "client_order_count": """
SELECT c.id AS client_id, COUNT(h.id) AS order_count FROM w_clients c LEFT JOIN w_heads h ON h.client_id = c.id GROUP BY c.id""",
    "client_orders": f"""
SELECT o.id, o.client_id, {s('order_date')} AS order_date, {s('delivery_date')} AS delivery_date, {d('total_revenue')} AS total_revenue,
  c.name || ' — ' || {s('delivery_date')} || ' — ' || {s('total_revenue')} || ' EGP' AS option_text
FROM w_orders o JOIN w_clients c ON c.id = o.client_id""",
    "pricing_by_client": """
SELECT client_id, coalesce(c.name, 'Unknown') AS client_name, CASE WHEN c.type = 'supermarket' THEN 'Supermarket' ELSE 'Restaurant' END AS badge,
  COUNT(*) AS product_count FROM w_pricing r LEFT JOIN w_clients c ON c.id = client_id GROUP BY ALL ORDER BY client_name, client_id""",
    "client_price_margin": f"""
SELECT id, client_name, product_label, {d('selling_price')} AS selling_price, {d('cost')} AS base_cost, margin, {tier('margin', 30, 15)} AS margin_tier
FROM (SELECT r.id, c.name AS client_name, p.name || ' (' || p.unit || ')' AS product_label, selling_price, p.cost,
  {pct('selling_price - p.cost', 'selling_price')} AS margin
  FROM w_pricing r LEFT JOIN w_products p ON p.id = product_id LEFT JOIN w_clients c ON c.id = client_id)""",
    # ---------------------------------------------------------- documents
    "settings_resolved": f"""
SELECT {s('c_custkey')} AS owner, CASE WHEN c_nationkey % 4 >= 2 THEN {d('c_nationkey')} ELSE 15e0 END AS overhead_pct,
  CASE WHEN c_nationkey % 4 = 3 THEN 2.5e0 ELSE 0e0 END AS labor_pct FROM customer""",
    "product_margins_table": "SELECT product_id, margin AS profit_margin_pct FROM w_margins",
    "weight_variants_table": "SELECT product_id, position, weight, price FROM w_variants",
    "ledger_entries": f"""
SELECT id, {s('date')} AS date, type, {d('amount')} AS amount, description FROM w_ledger WHERE type <> 'click'""",
    "ledger_bad_documents": "SELECT COUNT(*) AS documents, COUNT(*) FILTER (type = 'click') AS unreadable FROM w_ledger",
    # ------------------------------------------------------------- orders
    "order_margin_zone": f"""
SELECT id AS order_id, margin_percentage, {zone('margin_percentage')} AS zone FROM w_orders""",
    "line_revenue": f"SELECT id AS item_id, kg_packs AS packs, {d('earned')} AS revenue FROM w_earned",
    "line_quantity": f"""
SELECT item_id, size, packs, quantity, quantity > 0 AS accepted FROM (
  SELECT id AS item_id, CASE WHEN unit = 'kg' THEN size END AS size, CASE WHEN unit = 'kg' THEN n END AS packs,
    CASE WHEN unit = 'kg' THEN size * n ELSE CASE WHEN flag <> 'N' THEN n ELSE n END END AS quantity
  FROM (SELECT *, CASE flag WHEN 'R' THEN 0.25e0 WHEN 'A' THEN 0.5e0 ELSE 0e0 END AS size, floor({d('quantity')}) AS n
    FROM (SELECT id, unit, flag, quantity FROM w_lines)))""",
    "pack_recovery_kg": f"""
SELECT id AS item_id, kg_packs AS packs, CASE WHEN kg_packs > 0 THEN {d('quantity')} / kg_packs END AS pack_size FROM w_packs""",
    "pack_recovery_client": f"""
SELECT id AS item_id, client_packs AS packs, CASE WHEN client_packs > 0 THEN {d('quantity')} / client_packs END AS pack_size FROM w_packs""",
    "order_economics": f"""
SELECT order_id, {d('rev')} AS revenue, {d('farmer')} AS farmer_cost, {d('log')} AS logistics, {d('farmer + log')} AS cost,
  {d('rev - farmer - log')} AS profit, {r2(pct('rev - farmer - log', 'rev'))} AS margin, {zone(pct('rev - farmer - log', 'rev'))} AS zone
FROM (SELECT o.id AS order_id, coalesce(rev, 0) AS rev, {dec('coalesce(cst, 0)')} AS farmer, o.transport_cost + o.packaging_cost AS log
  FROM w_orders o LEFT JOIN (SELECT order_id, SUM(earned) AS rev, SUM(total_cost) AS cst FROM w_earned GROUP BY order_id) e ON e.order_id = o.id)""",
    "order_cost_breakdown": f"""
SELECT o.id AS order_id, {d('coalesce(b.base, 0)')} AS base_cost, {d('o.transport_cost')} AS transport_cost, {d('o.packaging_cost')} AS packaging_cost,
  {d('coalesce(b.base, 0) + o.transport_cost + o.packaging_cost')} AS total_cost, {d('o.total_revenue')} AS total_revenue, {d('o.net_profit')} AS net_profit
FROM w_orders o LEFT JOIN (SELECT order_id, SUM(total_cost) AS base FROM w_items GROUP BY order_id) b ON b.order_id = o.id""",
    "orders_by_delivery_date": f"""
SELECT coalesce({s('delivery_date')}, 'Unknown') AS delivery_day, COUNT(*) AS order_count, {d('SUM(total_revenue)')} AS total_revenue,
  {d('SUM(net_profit)')} AS net_profit, {d('SUM(transport_cost)')} AS transport_cost, {d('SUM(packaging_cost)')} AS packaging_cost
FROM w_orders GROUP BY 1 ORDER BY 1 DESC""",
    "client_order_number": """
SELECT id AS order_id, client_id, row_number() OVER (PARTITION BY client_id ORDER BY order_date, id) AS order_number FROM w_heads""",
    "invoice_due_dates": f"""
SELECT h.id AS order_id, {s('delivery_date')} AS delivery_date,
  {s('delivery_date + CASE WHEN c.credit_days IS NULL OR c.credit_days = 0 THEN 30 ELSE c.credit_days END')} AS due_date
FROM w_heads h LEFT JOIN w_clients c ON c.id = client_id""",
    "invoice_lines": f"""
SELECT i.order_id, i.id AS item_id, c.name AS client_name, {s('o.order_date')} AS order_date, {s('o.delivery_date')} AS delivery_date,
  CASE WHEN i.client_type = 'supermarket' THEN 'packs' ELSE 'quantity' END AS layout, p.name AS product,
  coalesce(nullif(i.client_packs, 0), {d('i.quantity')}) AS shown_quantity, CASE WHEN i.client_type <> 'supermarket' THEN i.unit END AS shown_unit,
  {r2('i.price')} AS price, {d('i.total_revenue')} AS total, {d('o.total_revenue')} AS order_total
FROM w_packs i JOIN w_orders o ON o.id = i.order_id JOIN w_clients c ON c.id = o.client_id JOIN w_products p ON p.id = i.product_id""",
    "delivery_note_lines": f"""
SELECT i.order_id, i.id AS item_id, c.name AS client_name, {s('o.delivery_date')} AS delivery_date, p.name AS product,
  CASE WHEN i.client_type = 'supermarket' AND i.client_packs > 0
    THEN CASE WHEN {d('i.quantity')} / i.client_packs = floor({d('i.quantity')} / i.client_packs)
      THEN {s(f"CAST({d('i.quantity')} / i.client_packs AS BIGINT)")} ELSE {s(f"{d('i.quantity')} / i.client_packs")} END || 'kg'
    ELSE i.unit END AS size_or_unit,
  coalesce(nullif(i.client_packs, 0), {d('i.quantity')}) AS shown_quantity, {d('i.cost_used')} AS base_cost, {d('i.total_cost')} AS total_base_cost,
  {d('SUM(i.total_cost) OVER (PARTITION BY i.order_id)')} AS note_total
FROM w_packs i JOIN w_heads o ON o.id = i.order_id JOIN w_clients c ON c.id = o.client_id JOIN w_products p ON p.id = i.product_id""",
    "contact_links": f"""
SELECT h.id AS order_id, 'https://wa.me/' || regexp_replace(coalesce(c.phone, ''), '[^0-9]', '', 'g') || '?text=' ||
  url_encode('Dear ' || coalesce(c.name, 'Client') || ', please find attached your invoice for ' || {s('h.delivery_date')} || '.') AS link
FROM w_heads h LEFT JOIN w_clients c ON c.id = h.client_id""",
    "order_labels": f"""
SELECT i.id AS item_id, c.name || ' - ' || {s('o.delivery_date')} AS order_label,
  p.name || CASE WHEN i.kg_packs > 0 THEN ' (' || CASE WHEN {d('i.quantity')} / i.kg_packs = floor({d('i.quantity')} / i.kg_packs)
      THEN {s(f"CAST({d('i.quantity')} / i.kg_packs AS BIGINT)")} ELSE {s(f"{d('i.quantity')} / i.kg_packs")} END
      || 'kg × ' || CAST(i.kg_packs AS BIGINT) || ')' ELSE '' END AS line_label,
  c.name AS client_or_unknown, c.name AS client_or_dash
FROM w_packs i JOIN w_heads o ON o.id = i.order_id JOIN w_clients c ON c.id = o.client_id JOIN w_products p ON p.id = i.product_id""",
    "order_drafts": f"""
SELECT i.id AS item_id, i.order_id, i.product_id,
  p.name || CASE WHEN i.kg_packs > 0 THEN ' (' || CASE WHEN {d('i.quantity')} / i.kg_packs = floor({d('i.quantity')} / i.kg_packs)
      THEN {s(f"CAST({d('i.quantity')} / i.kg_packs AS BIGINT)")} ELSE {s(f"{d('i.quantity')} / i.kg_packs")} END
      || 'kg × ' || CAST(i.kg_packs AS BIGINT) || ')' ELSE '' END AS product_label,
  i.unit, {d('i.quantity')} AS quantity, i.price AS selling_price, {d('i.cost_used')} AS cost,
  CASE WHEN i.kg_packs > 0 THEN {d('i.quantity')} / i.kg_packs END AS package_size, i.kg_packs AS num_packages,
  o.client_id, {s('o.order_date')} AS order_date, {s('o.delivery_date')} AS delivery_date, {d('o.transport_cost')} AS transport_cost,
  {d('o.packaging_cost')} AS packaging_cost
FROM w_packs i JOIN w_orders o ON o.id = i.order_id JOIN w_products p ON p.id = i.product_id""",
    "reprice_lines_for_client": f"""
SELECT i.id AS item_id, i.supplier AS new_client_id, i.product_id, coalesce({d('r.selling_price')}, i.price) AS price,
  r.selling_price IS NOT NULL AS repriced
FROM w_items i LEFT JOIN w_pricing r ON r.client_id = i.supplier AND r.product_id = i.product_id""",
    "dq_orders": """
SELECT id AS order_id, client_id IS NOT NULL AND line_count > 0 AND NOT late AND transport_cost >= 0 AND bad = 0 AS is_valid,
  concat_ws(',', CASE WHEN client_id IS NULL THEN 'client_missing' END, CASE WHEN line_count = 0 THEN 'no_items' END,
    CASE WHEN late THEN 'delivery_before_order' END, CASE WHEN transport_cost < 0 THEN 'transport_negative' END,
    CASE WHEN bad > 0 THEN 'bad_line' END) AS failures
FROM (SELECT v.*, v.delivery_date < v.order_date AS late, coalesce(b.bad, 0) AS bad FROM w_valid_orders v LEFT JOIN
  (SELECT order_id, COUNT(*) AS bad FROM w_items WHERE coalesce(price, 0) = 0 OR quantity <= 0 GROUP BY order_id) b ON b.order_id = v.id)""",
    # ------------------------------------------------------------ pricing
    "suggested_price": "SELECT id AS product_id, suggested AS suggested_price FROM w_suggested",
    "suggested_pack_price": f"""
SELECT v.product_id, v.position, v.weight,
  {fixed("(CASE WHEN g.unit = 'kg' THEN g.suggested * v.weight ELSE g.suggested END)", 2)} AS suggested_price
FROM w_variants v JOIN w_suggested g ON g.id = v.product_id""",
    "pricing_rows": "SELECT id AS product_id, size AS pack_size, pack_price, margin AS profit_margin FROM w_calc",
    "pricing_rows_valid": """
SELECT id AS product_id, size AS weight, pack_price AS price FROM w_calc WHERE size > 0 AND pack_price > 0""",
    "pack_cost": f"SELECT id AS product_id, size AS pack_size, {d('cost')} * size * 1.15e0 AS pack_cost FROM w_calc",
    "margin_from_price": f"""
SELECT product_id, price AS pack_price, {fixed('((price - tc) / tc * 100)', 1)} AS profit_margin
FROM (SELECT c.id AS product_id, {r2('p_retailprice * p_size / 10')} AS price, {d('c.cost')} * c.size * 1.15e0 AS tc
  FROM w_calc c JOIN part ON p_partkey = c.key)""",
    "price_from_margin": f"""
SELECT product_id, m AS profit_margin, {fixed('(tc * (1e0 + m / 100))', 2)} AS pack_price
FROM (SELECT c.id AS product_id, {d('p_size')} AS m, {d('c.cost')} * c.size * 1.15e0 AS tc FROM w_calc c JOIN part ON p_partkey = c.key)""",
    "reprice_pack_size": f"""
SELECT product_id, size AS pack_size, {fixed(f"({d('cost')} * size * 1.15e0 * (1e0 + margin / 100))", 2)} AS pack_price
FROM (SELECT c.id AS product_id, c.cost, c.margin, CASE WHEN p_size < 5 THEN 1e0 ELSE {d('p_size')} / 10 END AS size
  FROM w_calc c JOIN part ON p_partkey = c.key)""",
    "reprice_scenario": f"""
SELECT id AS product_id, oh AS overhead_pct, lb AS labor_pct, size AS pack_size,
  {fixed(f"({d('cost')} * size * (1e0 + oh / 100 + lb / 100) * (1e0 + margin / 100))", 2)} AS pack_price
FROM w_calc, (VALUES (10e0, 5e0), (15e0, 0e0), (20e0, 2.5e0)) AS o(oh, lb)""",
    "price_per_kg": "SELECT id AS product_id, pack_price / size AS price_per_kg FROM w_calc",
    "default_variants": "SELECT product_id, position, weight, price FROM w_sized",
    "price_list_export": f"""
SELECT id AS product_id, name AS product, coalesce(name_ar, '') AS product_ar, {d('cost')} AS base_cost_per_kg, size AS pack_size_kg,
  {fixed(f"({d('cost')} * size)", 2)} AS raw_cost_per_pack, 15e0 AS overhead_pct, 0e0 AS labor_pct,
  {fixed(f"({d('cost')} * size * 1.15e0)", 2)} AS total_cost_per_pack, margin AS profit_margin_pct, pack_price,
  {fixed('(pack_price / size)', 2)} AS price_per_kg FROM w_calc""",
    # -------------------------------------------------------------- stock
    "batch_waste": f"""
SELECT id AS batch_id, {d('waste')} AS waste_qty, waste_percentage, {d('waste_value')} AS waste_value FROM w_batches""",
    "waste_tiers": """
SELECT id AS batch_id, waste_percentage,
  CASE WHEN waste_percentage > 10 THEN 'red' WHEN waste_percentage > 5 THEN 'yellow' ELSE 'green' END AS tier FROM w_batches""",
    "batch_order_links": "SELECT batch_id, client_id, client_name, order_id, order_label FROM w_linked",
    "dq_batches": """
SELECT id AS batch_id, harvested >= 0 AND damaged >= 0 AND expired >= 0 AS is_valid,
  concat_ws(',', CASE WHEN harvested < 0 THEN 'harvested_negative' END, CASE WHEN damaged < 0 THEN 'damaged_negative' END,
    CASE WHEN expired < 0 THEN 'expired_negative' END) AS failures FROM w_batches""",
    "dq_ledger": """
SELECT id AS entry_id, amount > 0 AND trim(description) <> '' AS is_valid,
  concat_ws(',', CASE WHEN amount <= 0 THEN 'amount_not_positive' END, CASE WHEN trim(description) = '' THEN 'description_blank' END) AS failures
FROM w_ledger""",
    "dq_master_data": """
SELECT 'products' AS table_name, COUNT(*) AS row_count, COUNT(*) FILTER (coalesce(name, '') = '' OR cost IS NULL) AS rejected_count FROM w_products
UNION ALL SELECT 'clients', COUNT(*), COUNT(*) FILTER (coalesce(name, '') = '') FROM w_clients
UNION ALL SELECT 'prices', COUNT(*), COUNT(*) FILTER (client_id IS NULL OR product_id IS NULL OR selling_price IS NULL) FROM w_pricing
UNION ALL SELECT 'payments', COUNT(*), COUNT(*) FILTER (coalesce(amount, 0) <= 0) FROM w_payments""",
    # ---------------------------------------------------------- dashboard
    "weekly_kpis": f"""
SELECT orders, {d('revenue')} AS revenue, {d('profit')} AS profit, avg_margin, {zone('avg_margin')} AS avg_margin_zone, {d('base')} AS base_cost,
  {d('tr')} AS transport_cost, {d('pk')} AS packaging_cost, {d('base + tr + pk')} AS total_cost, {pct('base', 'revenue')} AS base_pct,
  {pct('tr', 'revenue')} AS transport_pct, {pct('pk', 'revenue')} AS packaging_pct, {pct('base + tr + pk', 'revenue')} AS total_cost_pct
FROM (SELECT COUNT(*) AS orders, coalesce(SUM(total_revenue), 0) AS revenue, coalesce(SUM(net_profit), 0) AS profit,
    CASE WHEN COUNT(*) > 0 THEN {d(f"SUM({dec('margin_percentage')})")} / COUNT(*) ELSE 0e0 END AS avg_margin,
    coalesce(SUM(transport_cost), 0) AS tr, coalesce(SUM(packaging_cost), 0) AS pk,
    (SELECT coalesce(SUM(i.total_cost), 0) FROM w_items i JOIN w_heads h ON h.id = i.order_id WHERE h.order_date >= {AS_OF} - 7) AS base
  FROM w_orders WHERE order_date >= {AS_OF} - 7)""",
    "waste_totals": f"""
SELECT {d('SUM(harvested)')} AS harvested, {d('SUM(waste)')} AS waste, {d('SUM(waste_value)')} AS waste_value,
  {pct('SUM(waste)', 'SUM(harvested)')} AS waste_pct, {pct('SUM(waste)', 'SUM(harvested)')} > 10 AS alert FROM w_batches""",
    "receivables_totals": f"""
SELECT {d("coalesce(SUM(amount) FILTER (status <> 'paid'), 0)")} AS outstanding, {d("coalesce(SUM(amount) FILTER (status = 'paid'), 0)")} AS collected
FROM w_payments""",
    "base_cost_collected": f"""
SELECT {d('coalesce(SUM(i.total_cost), 0)')} AS base_cost_collected FROM w_payments y JOIN w_items i ON i.order_id = y.order_id WHERE y.status = 'paid'""",
    "top_client_share": f"""
SELECT {pct('top', 'whole')} AS top_client_pct, {pct('top', 'whole')} > 50 AS alert
FROM (SELECT greatest(MAX(r), 0) AS top, SUM(r) AS whole FROM (SELECT client_id, SUM(total_revenue) AS r FROM w_orders GROUP BY client_id))""",
    "cash_position": f"""
SELECT {d('cash')} AS manual_cash, {d('got')} AS collected, {d('due')} AS expected_in, {d('owed')} AS farmer_owed,
  {d('cash + got')} AS cash_in_hand, {d('cash + got + due - owed')} AS projected
FROM (SELECT (SELECT SUM(CASE WHEN type IN ('initial', 'deposit') THEN amount WHEN type = 'withdrawal' THEN -amount ELSE 0 END) FROM w_ledger) AS cash,
  (SELECT SUM(amount) FROM w_payments WHERE status = 'paid') AS got, (SELECT SUM(amount) FROM w_payments WHERE status <> 'paid') AS due,
  (SELECT coalesce(SUM(i.total_cost), 0) FROM w_items i JOIN w_heads h ON h.id = i.order_id WHERE h.order_date >= {AS_OF} - 7) AS owed)""",
    "kept_weekly_kpis": f"""
SELECT orders, {d('revenue')} AS revenue, {d('profit')} AS profit, avg_margin, {zone('avg_margin')} AS avg_margin_zone, {d('base')} AS base_cost,
  {d('tr')} AS transport_cost, {d('pk')} AS packaging_cost, {d('base + tr + pk')} AS total_cost, {pct('base', 'revenue')} AS base_pct,
  {pct('tr', 'revenue')} AS transport_pct, {pct('pk', 'revenue')} AS packaging_pct, {pct('base + tr + pk', 'revenue')} AS total_cost_pct,
  top_client_pct, top_client_pct > 50 AS top_client_alert
FROM (SELECT COUNT(*) AS orders, coalesce(SUM(total_revenue), 0) AS revenue, coalesce(SUM(net_profit), 0) AS profit,
    CASE WHEN COUNT(*) > 0 THEN {d(f"SUM({dec('margin_percentage')})")} / COUNT(*) ELSE 0e0 END AS avg_margin,
    coalesce(SUM(transport_cost), 0) AS tr, coalesce(SUM(packaging_cost), 0) AS pk, coalesce(SUM(base), 0) AS base
  FROM w_kept_orders WHERE order_date >= {AS_OF} - 7),
  (SELECT coalesce({pct('greatest(MAX(r), 0)', 'SUM(r)')}, 0e0) AS top_client_pct
   FROM (SELECT client_id, SUM(total_revenue) AS r FROM w_kept_orders GROUP BY client_id))""",
    "kept_receivables": f"""
SELECT {d("coalesce(SUM(amount) FILTER (status <> 'paid'), 0)")} AS outstanding, {d("coalesce(SUM(amount) FILTER (status = 'paid'), 0)")} AS collected
FROM (SELECT y.status, CASE WHEN h.priority = '2-HIGH' THEN h.quoted - 2 ELSE y.amount END AS amount
  FROM w_payments y JOIN w_heads h ON h.id = y.order_id WHERE h.priority <> '5-LOW')""",
    "kept_waste_totals": f"""
SELECT {d('SUM(h)')} AS harvested, {d('SUM(w)')} AS waste, {d('SUM(v)')} AS waste_value, {pct('SUM(w)', 'SUM(h)')} AS waste_pct, {pct('SUM(w)', 'SUM(h)')} > 10 AS alert
FROM (SELECT harvested + CASE WHEN damaged > 0 THEN 1 ELSE 0 END AS h, CASE WHEN damaged > 0 THEN damaged ELSE waste END AS w,
    CASE WHEN damaged > 0 THEN {cents('damaged * cost')} ELSE waste_value END AS v
  FROM w_batches WHERE CAST(product_id AS BIGINT) % 7 <> 0)""",
    # ---------------------------------------------------------- analytics
    "product_performance": f"""
SELECT product_id, {d('qty')} AS total_qty, {d('rev')} AS total_revenue, {d('cst')} AS total_cost, n AS order_count, min_price, max_price, name, unit,
  {d('base_cost')} AS base_cost, avg_price, margin, share AS revenue_share, {tier('margin', 30, 15)} AS margin_tier, {tier('share', 15, 5, '>')} AS share_tier
FROM (SELECT *, {pct('rev', '(SUM(rev) OVER ())')} AS share FROM w_stats) ORDER BY rev DESC, product_id""",
    "product_trend": f"""
SELECT product_id, name, {d('recent')} AS recent_revenue, {d('previous')} AS previous_revenue, t AS trend_pct,
  CASE WHEN t > 0 THEN 'up' WHEN t < 0 THEN 'down' ELSE 'flat' END AS trend
FROM (SELECT *, CASE WHEN previous > 0 THEN ({d('recent')} - {d('previous')}) / {d('previous')} * 100 WHEN recent > 0 THEN 100e0 ELSE 0e0 END AS t
  FROM (SELECT i.product_id, p.name, coalesce(SUM(total_revenue) FILTER (h.order_date > {AS_OF} - 7), 0) AS recent,
      coalesce(SUM(total_revenue) FILTER (h.order_date > {AS_OF} - 14 AND h.order_date <= {AS_OF} - 7), 0) AS previous
    FROM w_items i JOIN w_products p ON p.id = i.product_id LEFT JOIN w_heads h ON h.id = i.order_id GROUP BY ALL))""",
    "client_performance": f"""
SELECT x.client_id, coalesce(c.name, 'Unknown') AS client_name, {d('rev')} AS total_revenue, {d('qty')} AS total_qty,
  (SELECT COUNT(*) FROM w_heads h WHERE h.client_id = x.client_id) AS total_orders, {pct('rev', '(SELECT SUM(rev) FROM w_stats)')} AS revenue_share
FROM w_client_stats x LEFT JOIN w_clients c ON c.id = x.client_id ORDER BY rev DESC, x.client_id""",
    "analytics_summary": f"""
SELECT (SELECT {d('SUM(rev)')} FROM w_stats) AS total_revenue, (SELECT COUNT(*) FROM w_heads) AS total_orders,
  (SELECT COUNT(*) FROM w_stats) AS products_sold, (SELECT COUNT(*) FROM w_client_stats) AS active_clients""",
    "stock_recommendations": f"""
SELECT product_id, name, unit, recommendation, CAST(CASE recommendation WHEN 'increase' THEN 0 WHEN 'decrease' THEN 1 ELSE 2 END AS BIGINT) AS rank_pos, velocity,
  n AS order_count, {d('qty')} AS total_qty, {d('rev')} AS total_revenue FROM w_advice""",
    "stock_rec_counts": """
SELECT COUNT(*) FILTER (recommendation <> 'stable') AS to_act_on, COUNT(*) FILTER (recommendation = 'stable') AS stable FROM w_advice""",
    "price_suggestions": f"""
SELECT product_id, name, 'raise_price' AS rule, 'increase' AS kind, margin AS metric, avg_price * 1.1e0 AS target_price
FROM w_stats WHERE n >= 3 AND margin < 25
UNION ALL SELECT product_id, name, 'lower_price', 'decrease', margin, NULL FROM w_stats WHERE n <= 1 AND margin > 40
UNION ALL SELECT product_id, name, 'standardise', 'info', (max_price - min_price) / min_price * 100, NULL
FROM w_stats WHERE max_price > 0 AND min_price > 0 AND (max_price - min_price) / min_price * 100 > 20
UNION ALL SELECT r.product_id, r.name, 'underpriced', 'increase', avg_price, g.suggested
FROM w_stats r JOIN w_suggested g ON g.id = r.product_id WHERE g.suggested > 0 AND avg_price > 0 AND avg_price < g.suggested * 0.9e0""",
    "stock_recommendations_last_30_days": f"""
SELECT product_id, name, unit, recommendation, CAST(CASE recommendation WHEN 'increase' THEN 0 WHEN 'decrease' THEN 1 ELSE 2 END AS BIGINT) AS rank_pos, velocity,
  n AS order_count, {d('qty')} AS total_qty, {d('rev')} AS total_revenue FROM w_recent_advice""",
    "stock_rec_counts_last_30_days": """
SELECT COUNT(*) FILTER (recommendation <> 'stable') AS to_act_on, COUNT(*) FILTER (recommendation = 'stable') AS stable FROM w_recent_advice""",
    "price_suggestions_last_30_days": f"""
SELECT product_id, name, 'raise_price' AS rule, 'increase' AS kind, margin AS metric, avg_price * 1.1e0 AS target_price
FROM w_recent_stats WHERE n >= 3 AND margin < 25
UNION ALL SELECT product_id, name, 'lower_price', 'decrease', margin, NULL FROM w_recent_stats WHERE n <= 1 AND margin > 40
UNION ALL SELECT product_id, name, 'standardise', 'info', (max_price - min_price) / min_price * 100, NULL
FROM w_recent_stats WHERE max_price > 0 AND min_price > 0 AND (max_price - min_price) / min_price * 100 > 20
UNION ALL SELECT r.product_id, r.name, 'underpriced', 'increase', avg_price, g.suggested
FROM w_recent_stats r JOIN w_suggested g ON g.id = r.product_id WHERE g.suggested > 0 AND avg_price > 0 AND avg_price < g.suggested * 0.9e0""",
    "variant_sales_summary": f"""
SELECT product_id, name, unit, {d('rev')} AS total_revenue, avg_price FROM w_stats
WHERE product_id IN (SELECT product_id FROM w_variants) ORDER BY rev DESC, product_id LIMIT 6""",
    "variant_sales_sizes": """
SELECT place, product_id, v.position, v.weight, v.price FROM (
  SELECT product_id, row_number() OVER (ORDER BY rev DESC, product_id) AS place FROM w_stats WHERE product_id IN (SELECT product_id FROM w_variants))
JOIN w_variants v USING (product_id) WHERE place <= 6""",
    # -------------------------------------------------------- maintenance
    "apply_product_changes": _changed(
        ["id"],
        "SELECT * FROM w_products",
        f"SELECT product_id AS id, name, {d('price')} AS cost_per_unit, op, changed_at, seq FROM w_feed",
        {"unit": "o.unit"},
        {"name": "o.name", "cost_per_unit": d("o.cost")},
    ),
    "apply_client_changes": _changed(
        ["id"],
        "SELECT * FROM w_clients",
        """SELECT CASE WHEN priority = '3-MEDIUM' THEN 'new-' ELSE '' END || client_id AS id, 'renamed by ' || id AS name,
           CAST(CASE WHEN priority = '1-URGENT' THEN 60 END AS BIGINT) AS credit_days, CASE WHEN order_status = 'P' THEN 'delete' ELSE 'upsert' END AS op,
           order_date AS changed_at, id AS seq FROM w_heads""",
        {"type": "o.type"},
        {"name": "o.name", "credit_days": "o.credit_days"},
    ),
    "apply_price_changes": _changed(
        ["client_id", "product_id"],
        "SELECT * FROM w_pricing",
        f"""SELECT h.client_id, f.product_id, {d('f.price')} AS selling_price, f.op, f.changed_at, f.seq
            FROM w_feed f JOIN w_heads h ON h.id = f.order_id""",
        {},
        {"selling_price": d("o.selling_price")},
    ),
    "apply_margin_changes": _changed(
        ["product_id"],
        "SELECT * FROM w_margins",
        f"SELECT known_id AS product_id, {d('discount * 100')} AS profit_margin_pct, 'upsert' AS op, changed_at, seq FROM w_feed",
        {},
        {"profit_margin_pct": "o.margin"},
    ),
    "apply_settings_changes": f"""
SELECT owner, CASE WHEN k IS NULL THEN saved_overhead WHEN k % 5 < 2 THEN {d('k % 30')} WHEN k % 5 = 2 THEN 0e0 ELSE 15e0 END AS overhead_pct,
  CASE WHEN k IS NULL THEN saved_labor WHEN k % 5 IN (0, 2) THEN {d('k % 7')} ELSE 0e0 END AS labor_pct
FROM (SELECT {s('c_custkey')} AS owner, CASE WHEN c_nationkey % 4 >= 2 THEN {d('c_nationkey')} ELSE 15e0 END AS saved_overhead,
    CASE WHEN c_nationkey % 4 = 3 THEN 2.5e0 ELSE 0e0 END AS saved_labor FROM customer)
FULL OUTER JOIN (SELECT {s('o_custkey')} AS owner, o_orderkey AS k FROM orders WHERE o_custkey % 3 <> 0 AND o_orderkey % 5 < 4
  QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1) USING (owner)""",
    "apply_variant_changes": f"""
SELECT * FROM w_variants WHERE product_id NOT IN (SELECT known_id FROM w_feed)
UNION ALL SELECT known_id, position, weight, {r2(f"{d('price')} * weight")} FROM
  (SELECT known_id, price FROM w_feed QUALIFY row_number() OVER (PARTITION BY known_id ORDER BY changed_at DESC, seq DESC) = 1),
  (VALUES (CAST(0 AS BIGINT), 0.5e0), (CAST(1 AS BIGINT), 1e0)) AS w(position, weight)""",
    "price_fanout_clients": f"""
SELECT coalesce(r.client_id, k.client_id) AS client_id, coalesce(r.product_id, k.product_id) AS product_id,
  {d('coalesce(k.price, r.selling_price)')} AS selling_price
FROM w_pricing r FULL OUTER JOIN (SELECT DISTINCT h.client_id, l.supplier AS product_id, {cents('g.suggested')} AS price
  FROM w_lines l JOIN w_heads h ON h.id = l.order_id JOIN w_suggested g ON g.id = l.supplier) k
ON k.client_id = r.client_id AND k.product_id = r.product_id""",
    "price_apply_to_client": f"""
SELECT client_id, product_id, {d('selling_price')} AS selling_price FROM w_pricing WHERE client_id <> '1'
UNION ALL SELECT '1', id, {r2('pack_price / size')} FROM w_calc""",
    "apply_order_deletes": """
SELECT 'orders' AS table_name, COUNT(*) AS rows_left FROM w_heads WHERE order_status <> 'P'
UNION ALL SELECT 'order_items', COUNT(*) FROM w_lines l JOIN w_heads h ON h.id = l.order_id WHERE order_status <> 'P'
UNION ALL SELECT 'payments', COUNT(*) FROM w_payments y JOIN w_heads h ON h.id = y.order_id WHERE order_status <> 'P'""",
    "create_orders_payments": f"""
SELECT 'new-' || o.id AS order_id, o.client_id, {d('rev')} AS total_revenue, {d('cost')} AS total_cost, {d('rev - cost')} AS net_profit,
  {r2(pct('rev - cost', 'rev'))} AS margin_percentage, {zone(pct('rev - cost', 'rev'))} AS margin_zone, n AS item_count, {d('rev')} AS item_revenue,
  {d('rev')} AS amount, {s('o.delivery_date + coalesce(nullif(c.credit_days, 0), 30)')} AS due_date
FROM (SELECT h.*, e.rev, e.n, CAST({dec('e.cst')} + h.transport_cost + h.packaging_cost AS DECIMAL(18,2)) AS cost FROM w_orders h
  JOIN (SELECT order_id, SUM(earned) AS rev, SUM(total_cost) AS cst, COUNT(*) AS n FROM w_earned GROUP BY order_id) e ON e.order_id = h.id) o
LEFT JOIN w_clients c ON c.id = o.client_id""",
    "apply_order_updates": f"""
SELECT o.id AS order_id, o.client_id, {s('coalesce(u.delivery_date, o.delivery_date)')} AS delivery_date,
  {d('coalesce(u.total_revenue, o.total_revenue)')} AS total_revenue, {d('coalesce(u.total_cost, o.total_cost)')} AS total_cost,
  {d('coalesce(u.total_revenue - u.total_cost, o.net_profit)')} AS net_profit,
  CASE WHEN u.id IS NULL THEN o.margin_percentage ELSE {r2(pct('u.total_revenue - u.total_cost', 'u.total_revenue'))} END AS margin_percentage,
  CASE WHEN u.id IS NULL THEN o.margin_zone ELSE {zone(pct('u.total_revenue - u.total_cost', 'u.total_revenue'))} END AS margin_zone,
  coalesce(u.n, o.line_count) AS item_count, {d('coalesce(u.total_revenue, o.total_revenue)')} AS item_revenue,
  {d('coalesce(u.total_revenue, o.total_revenue)')} AS amount,
  {s('coalesce(u.delivery_date, o.delivery_date) + coalesce(nullif(c.credit_days, 0), 30)')} AS due_date
FROM w_valid_orders o LEFT JOIN w_updates u ON u.id = o.id LEFT JOIN w_clients c ON c.id = o.client_id""",
    "deduct_waste": f"""
SELECT o.id AS order_id, {d('greatest(0, o.total_revenue - coalesce(w.waste, 0))')} AS total_revenue,
  {d('o.net_profit - coalesce(w.waste, 0)')} AS net_profit, o.margin_percentage, {d('greatest(0, o.total_revenue - coalesce(w.waste, 0))')} AS amount
FROM w_orders o LEFT JOIN (SELECT order_id, SUM(raw_value) AS waste FROM w_linked WHERE raw_value > 0 GROUP BY order_id) w ON w.order_id = o.id""",
    "batch_intake": f"""
SELECT id, product_id, {s('harvest_date')} AS harvest_date, {d('h')} AS harvested_qty, {d('sold')} AS sold_qty, {d('dm')} AS damaged_qty, {d('ex')} AS expired_qty,
  {r2(pct('dm + ex', 'h'))} AS waste_percentage, {r2(d('(dm + ex) * (cost + packaging)'))} AS waste_value
FROM (SELECT id, product_id, harvest_date, harvested + CASE WHEN damaged > 0 THEN 1 ELSE 0 END AS h, sold, damaged AS dm,
    CASE WHEN damaged > 0 THEN 0 ELSE expired END AS ex, cost, 0 AS packaging FROM w_batches
  UNION ALL SELECT 'in-' || id, product_id, harvest_date, harvested, sold,
    {dec("CASE WHEN unit = 'kg' THEN 0.25 * returned_lines ELSE returned_lines END")},
    {dec("CASE WHEN unit = 'kg' THEN 0.25 * accepted_lines ELSE accepted_lines END")}, cost, tax_sum FROM w_batches)""",
    "apply_payment_changes": f"""
SELECT y.id, y.order_id, {d("CASE h.priority WHEN '1-URGENT' THEN h.quoted - 1 WHEN '2-HIGH' THEN h.quoted - 2 ELSE y.amount END")} AS amount,
  {s('y.due_date')} AS due_date, {s("CASE WHEN h.priority = '1-URGENT' THEN h.order_date + 10 ELSE y.paid_date END")} AS paid_date,
  CASE WHEN h.priority = '1-URGENT' THEN 'paid' ELSE y.status END AS status
FROM w_payments y JOIN w_heads h ON h.id = y.order_id WHERE h.priority <> '5-LOW'""",
    "apply_ledger_changes": f"""
SELECT id, {s('date')} AS date, type, {d('amount')} AS amount, description FROM w_ledger WHERE type <> 'click'
UNION ALL SELECT id, {s('paid_date')}, 'deposit', {d('amount')}, 'invoice paid' FROM w_payments WHERE status = 'paid' AND amount > 0""",
    "intake_deductions": f"""
SELECT batch_id, order_id, {d('waste')} AS waste_value, link_key, client_id, client_name, order_label FROM w_forms WHERE waste > 0""",
    "intake_orders": f"""
SELECT o.id AS order_id, {d('greatest(0, o.total_revenue - coalesce(w.waste, 0))')} AS total_revenue,
  {d('o.net_profit - coalesce(w.waste, 0)')} AS net_profit, {d('greatest(0, o.total_revenue - coalesce(w.waste, 0))')} AS amount
FROM w_orders o LEFT JOIN (SELECT order_id, SUM(waste) AS waste FROM w_forms WHERE waste > 0 GROUP BY order_id) w ON w.order_id = o.id""",
    "intake_links": """
SELECT link_key, client_id, client_name, order_id, order_label FROM w_links WHERE link_key NOT IN (SELECT link_key FROM w_forms WHERE waste > 0)
UNION ALL SELECT link_key, client_id, client_name, order_id, order_label FROM w_forms WHERE waste > 0""",
    "apply_batch_deletes": """
SELECT kind, key, order_id FROM (
  SELECT 'batch' AS kind, id AS key, CAST(NULL AS VARCHAR) AS order_id, id AS batch_id FROM w_rollup UNION ALL SELECT 'link', link_key, order_id, batch_id FROM w_links)
WHERE batch_id NOT IN (SELECT id FROM w_rollup WHERE CAST(product_id AS BIGINT) % 9 < 2 AND month(harvest_date) % 2 = 1)""",
    "rejected_writes": """
WITH forms AS (
  SELECT id, order_status, CASE priority WHEN '1-URGENT' THEN 'client_missing,no_items' WHEN '2-HIGH' THEN 'delivery_before_order'
    WHEN '3-MEDIUM' THEN 'transport_negative' WHEN '4-NOT SPECIFIED' THEN 'price_missing' ELSE 'quantity_not_positive' END AS failures FROM w_heads
)
SELECT 'products' AS write, product_id || '/bad-' || seq AS row_id, CASE line_number WHEN 3 THEN 'name_missing' ELSE 'name_missing,cost_missing' END AS failures
FROM w_feed WHERE op = 'upsert' AND line_number IN (3, 4)
UNION ALL SELECT 'clients', client_id || '/bad-' || id, 'name_missing' FROM w_heads WHERE priority = '4-NOT SPECIFIED' AND order_status = 'O'
UNION ALL SELECT 'prices', CASE line_number WHEN 3 THEN '/' || product_id WHEN 4 THEN h.client_id || '/' ELSE h.client_id || '/' || product_id END || '/bad-' || seq,
  CASE line_number WHEN 3 THEN 'client_missing' WHEN 4 THEN 'product_missing' ELSE 'price_missing' END
FROM w_feed f JOIN w_heads h ON h.id = f.order_id WHERE op = 'upsert' AND line_number IN (3, 4, 5)
UNION ALL SELECT 'new orders', 'new-' || id, 'no_items' FROM w_heads WHERE id NOT IN (SELECT order_id FROM w_lines)
UNION ALL SELECT 'new orders', 'form-' || id, failures FROM forms WHERE order_status = 'P'
UNION ALL SELECT 'order updates', id, failures FROM forms WHERE order_status = 'O'
UNION ALL SELECT 'order updates', id, 'no_items' FROM w_heads WHERE order_status = 'P' AND id NOT IN (SELECT order_id FROM w_lines WHERE flag <> 'R')
UNION ALL SELECT 'batch intake', 'bad-in-' || id, CASE CAST(product_id AS BIGINT) % 40 WHEN 0 THEN 'product_missing' WHEN 1 THEN 'harvested_missing'
  WHEN 2 THEN 'harvested_negative' WHEN 3 THEN 'damaged_negative' ELSE 'expired_negative' END FROM w_rollup WHERE CAST(product_id AS BIGINT) % 40 < 5
UNION ALL SELECT 'payments', 'pay-' || id || CASE priority WHEN '3-MEDIUM' THEN '/5' ELSE '/6' END, 'amount_invalid' FROM w_heads
WHERE priority IN ('3-MEDIUM', '4-NOT SPECIFIED')
UNION ALL SELECT 'ledger', id, concat_ws(',', CASE WHEN amount <= 0 OR (status <> 'paid' AND CAST(order_id AS BIGINT) % 2 = 1) THEN 'amount_not_positive' END,
  CASE WHEN status <> 'paid' THEN 'description_blank' END) FROM w_payments WHERE status <> 'paid' OR amount <= 0""",
    "apply_order_log": f"""
SELECT o.id AS order_id, client_id, {s('CASE WHEN updated IS NULL THEN delivery_date ELSE delivery_date + 3 END')} AS delivery_date,
  {d('CASE WHEN order_waste IS NULL THEN rev ELSE greatest(0, rev - order_waste) END')} AS total_revenue,
  {d('CASE WHEN updated IS NULL THEN total_cost ELSE now_cost END')} AS total_cost,
  {d('CASE WHEN updated IS NULL THEN net_profit ELSE now_revenue - now_cost END - coalesce(order_waste, 0)')} AS net_profit,
  CASE WHEN updated IS NULL THEN margin_percentage ELSE 25e0 END AS margin_percentage, CASE WHEN updated IS NULL THEN margin_zone ELSE 'red' END AS margin_zone,
  {d('CASE WHEN has_payment THEN CASE WHEN payment_waste IS NULL THEN amt ELSE greatest(0, amt - payment_waste) END END')} AS amount,
  {s('CASE WHEN has_payment THEN delivery_date + CASE WHEN updated IS NULL THEN 0 ELSE 3 END + credit END')} AS due_date,
  CASE WHEN has_payment THEN CASE WHEN priority = '1-URGENT' OR order_status = 'F' THEN 'paid' ELSE 'pending' END END AS status,
  {s("CASE WHEN has_payment THEN CASE WHEN priority = '1-URGENT' THEN order_date + 35 WHEN order_status = 'F' THEN delivery_date + credit END END")} AS paid_date
FROM (SELECT o.*, l.* EXCLUDE (order_id), now_revenue, now_cost, coalesce(nullif(c.credit_days, 0), 30) AS credit, priority <> '5-LOW' AS has_payment,
    CASE WHEN updated IS NULL THEN total_revenue ELSE now_revenue END AS rev, coalesce(set_to, total_revenue) AS amt
  FROM (SELECT *, quoted - 3 AS now_revenue, quoted - 103 AS now_cost FROM w_orders) o
  JOIN w_log_sums l ON l.order_id = o.id LEFT JOIN w_clients c ON c.id = o.client_id
  WHERE CAST(o.id AS BIGINT) % 11 <> 0) o""",
    # ------------------------------------------------------------ streams
    "debounced_changes": """
SELECT key, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS changed_at, seq, value FROM (
  SELECT *, lead(ts) OVER (PARTITION BY key ORDER BY ts, seq) AS nxt FROM (
    SELECT *, lag(value) OVER (PARTITION BY key ORDER BY ts, seq) AS before, row_number() OVER (PARTITION BY key ORDER BY ts, seq) AS rn
    FROM (SELECT CAST(user_id AS VARCHAR) AS key, ts, event_id AS seq, value FROM events))
  WHERE rn = 1 OR before IS DISTINCT FROM value)
WHERE nxt IS NULL OR nxt - ts > INTERVAL 30 MINUTE""",
    "daily_ledger_flow": f"SELECT {s('date')} AS day, type, COUNT(*) AS entries, {d('SUM(amount)')} AS amount FROM w_ledger GROUP BY date, type",
    "ledger_totals": f"SELECT type, COUNT(*) AS entries, {d('SUM(amount)')} AS amount FROM w_ledger GROUP BY type",
}

# A stream run to the end of its feed has the rows of its batch form.
QUERIES |= {f"{name}_stream": QUERIES[name] for name in ("debounced_changes", "daily_ledger_flow", "ledger_totals")}
