"""Plain-SQL twins of the registered queries, for comparison on the same tables."""

from __future__ import annotations

import re

# One CTE per derived table (see driver_tables), in dependency order.
_TABLES = {
    "price_batch": """
SELECT CAST(ts AS DATE) AS snapshot_date, user_id * 14 AS id_product, event_id AS seq,
       CASE WHEN event_type <> 'signup' THEN (user_id * 14) % 50
            + CASE WHEN CAST(regexp_extract(props, '"k": ([0-9]+)', 1) AS BIGINT) > 90 THEN 2 ELSE 1 END END AS id_category,
       CASE WHEN event_type <> 'error' THEN value END AS trend,
       CASE WHEN event_type = 'view' THEN value * 1.2::DOUBLE WHEN event_type NOT IN ('error', 'click') THEN value * 0.9::DOUBLE END AS avg30,
       value * 0.5::DOUBLE AS low
FROM events""",
    "prices": """
SELECT snapshot_date, id_product, id_category, trend, avg30, low FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY snapshot_date, id_product ORDER BY seq DESC) AS rn
  FROM price_batch) t WHERE rn = 1""",
    "day": "SELECT MAX(snapshot_date) AS d FROM price_batch",
    "products": """
SELECT p_partkey AS id_product,
       CASE WHEN p_type = 'SMALL' THEN p_name ELSE CONCAT(p_name, ' #', CAST(p_partkey AS VARCHAR)) END AS name,
       p_partkey % 50 + 1 AS id_category, p_type AS category_name,
       CASE WHEN p_type <> 'LARGE' THEN CAST(FLOOR(p_partkey / 19.0::DOUBLE) AS BIGINT) END AS id_expansion,
       CAST(p_size AS BIGINT) AS id_metacard,
       CASE WHEN p_type IN ('PROMO', 'STANDARD', 'ECONOMY') THEN 'single' ELSE 'non_single' END AS product_group,
       CASE WHEN p_type IN ('PROMO', 'STANDARD', 'ECONOMY') THEN 'products_singles_6.json'
            ELSE 'products_nonsingles_6.json' END AS source_file,
       p_size <= 45 AS is_active_in_catalog, DATE '2023-12-10' + p_size AS first_seen,
       DATE '2024-01-25' AS last_seen
FROM part""",
    "known_products": "SELECT * FROM products WHERE id_metacard <= 35",
    "catalog": "SELECT * REPLACE (CONCAT(name, ' v2') AS name) FROM products WHERE id_metacard >= 15",
    "merged_products": """
SELECT COALESCE(c.id_product, k.id_product) AS id_product, COALESCE(c.name, k.name) AS name,
       CASE WHEN c.id_product IS NOT NULL THEN c.id_category ELSE k.id_category END AS id_category,
       CASE WHEN c.id_product IS NOT NULL THEN c.id_expansion ELSE k.id_expansion END AS id_expansion,
       COALESCE(c.product_group, k.product_group) AS product_group, COALESCE(c.source_file, k.source_file) AS source_file,
       c.id_product IS NOT NULL AS is_active_in_catalog,
       COALESCE(k.first_seen, DATE '2024-02-01') AS first_seen,
       CASE WHEN c.id_product IS NOT NULL THEN DATE '2024-02-01' ELSE k.last_seen END AS last_seen,
       CASE WHEN c.id_product IS NOT NULL OR k.is_active_in_catalog THEN DATE '2024-02-01' ELSE k.last_seen END AS updated,
       CASE WHEN k.id_product IS NULL THEN 'inserted' WHEN c.id_product IS NOT NULL THEN 'updated'
            WHEN k.is_active_in_catalog THEN 'deactivated' ELSE 'unchanged' END AS catalog_change
FROM known_products k FULL OUTER JOIN catalog c ON c.id_product = k.id_product""",
    "expansions": """
SELECT s_suppkey AS id_expansion, s_name AS name_en, CONCAT('DE ', s_name) AS name_de,
       CONCAT('Vendor-', SUBSTR(s_name, 10, 9)) AS slug, r_name AS series_en, n_name AS series_de,
       DATE '1999-01-01' + CAST(FLOOR(s_acctbal) AS INTEGER) AS release_date,
       CAST(FLOOR(s_acctbal) AS BIGINT) AS card_count, CONCAT('S', CAST(s_suppkey AS VARCHAR)) AS set_code,
       s_acctbal > 0 AS is_active
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "sets": """
SELECT CONCAT('set', CAST(c_custkey AS VARCHAR)) AS tcg_set_id,
       CASE c_mktsegment WHEN 'MACHINERY' THEN CONCAT('Supplier#', SUBSTR(c_name, 10, 9))
            WHEN 'BUILDING' THEN CONCAT(r_name, ' - SUPPLIER  ', SUBSTR(c_name, 10, 9))
            WHEN 'AUTOMOBILE' THEN CONCAT('Auto & Co ', SUBSTR(c_name, 10, 9))
            WHEN 'HOUSEHOLD' THEN CONCAT('Vendor ', SUBSTR(c_name, 10, 9))
            ELSE CONCAT('Supplier Extra ', SUBSTR(c_name, 10, 9)) END AS name_en,
       CASE WHEN c_nationkey <> 24 THEN r_name END AS series_en,
       CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN CONCAT('s', CAST(c_custkey AS VARCHAR)) END AS ptcgo_code,
       CASE WHEN c_nationkey <> 0 THEN DATE '1999-01-01' + CAST(FLOOR(c_acctbal) AS INTEGER) END AS release_date,
       CAST(FLOOR(ABS(c_acctbal) / 50) AS BIGINT) AS printed_total,
       CAST(FLOOR(ABS(c_acctbal) / 50) AS BIGINT) + c_nationkey - 4 AS total_cards,
       CAST(GREATEST(c_nationkey - 4, 0) AS BIGINT) AS secret_card_count, c_acctbal > 0 AS is_active
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "items": """
SELECT o_orderkey AS collection_item_id,
       CAST(FLOOR(o_custkey / 10.0::DOUBLE) AS BIGINT) * 14 + CASE WHEN o_orderpriority = '5-LOW' THEN 1 ELSE 0 END AS id_product,
       CASE WHEN o_orderpriority = '1-URGENT' THEN 'DE' ELSE 'EN' END AS language,
       CASE WHEN o_orderstatus = 'P' THEN 'Near Mint' ELSE 'Good' END AS condition,
       CASE WHEN o_orderstatus = 'O' THEN 'bought_single' ELSE 'swapped' END AS acquisition_type,
       CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL WHEN o_totalprice < 5000 THEN -1.0::DOUBLE
            ELSE FLOOR(o_totalprice / 50) / 100.0::DOUBLE END AS purchase_price,
       CAST(o_orderdate AS DATE) AS purchase_date, o_orderpriority = '2-HIGH' AS is_sealed,
       o_orderpriority = '1-URGENT' AS is_graded,
       CASE WHEN o_orderpriority = '1-URGENT' AND o_totalprice > 250000 THEN 'PSA' END AS grading_company,
       CASE WHEN o_orderpriority = '1-URGENT' AND o_totalprice > 400000 THEN '10' END AS grade,
       CONCAT('Box ', SUBSTR(o_orderpriority, 1, 1)) AS storage_location, o_orderstatus = 'F' AS is_sold,
       CASE WHEN o_orderstatus = 'F' AND o_totalprice > 100000 THEN FLOOR(o_totalprice / 45) / 100.0::DOUBLE
            WHEN o_orderstatus = 'O' AND o_totalprice > 490000 THEN -2.0::DOUBLE END AS sold_price,
       CASE WHEN o_orderstatus = 'F' AND o_totalprice > 50000 THEN CAST(o_orderdate AS DATE) + 30 END AS sold_date
FROM orders""",
    "staging": """
SELECT c_custkey AS import_row_id, c_mktsegment AS import_batch_id, c_custkey AS record_index,
       CASE WHEN c_nationkey > 15 THEN CONCAT('ext-', CAST(CAST(FLOOR(c_acctbal / 100) AS BIGINT) AS VARCHAR)) END AS external_id,
       CASE WHEN c_nationkey < 8 THEN c_custkey * 2 END AS provided_id_product,
       CASE WHEN c_nationkey = 9 THEN 'no such product' WHEN c_nationkey <> 10 THEN name END AS raw_product_name,
       CASE WHEN c_nationkey = 5 THEN 'XX' WHEN c_nationkey <> 11 THEN 'EN' ELSE 'DE' END AS language,
       CASE WHEN c_nationkey = 6 THEN 'Fresh' ELSE 'Near Mint' END AS condition,
       CASE WHEN c_mktsegment = 'MACHINERY' THEN 'gift' ELSE 'pulled' END AS acquisition_type,
       CASE WHEN c_nationkey NOT IN (12, 13) THEN FLOOR(c_acctbal) END AS purchase_price,
       CASE WHEN c_nationkey <> 14 THEN DATE '2024-01-15' END AS purchase_date,
       c_nationkey = 15 AS is_sealed,
       CONCAT_WS('; ',
         CASE WHEN c_nationkey >= 8 AND (c_nationkey = 10 OR (c_nationkey <> 9 AND name IS NULL)) THEN 'Missing product name and product ID' END,
         CASE WHEN c_nationkey = 12 OR (c_nationkey <> 13 AND FLOOR(c_acctbal) < 0) THEN 'Invalid purchase price' END,
         CASE WHEN c_nationkey = 14 THEN 'Invalid purchase date' END,
         CASE WHEN c_nationkey = 6 THEN 'Unknown condition value' END,
         CASE WHEN c_nationkey = 5 THEN 'Unknown language value' END) AS field_error,
       CONCAT_WS('; ',
         CASE WHEN c_nationkey >= 8 AND (c_nationkey = 10 OR (c_nationkey <> 9 AND name IS NULL)) THEN 'Missing product name and product ID' END,
         CASE WHEN c_nationkey = 12 OR (c_nationkey <> 13 AND FLOOR(c_acctbal) < 0) THEN 'Invalid purchase price' END) AS lasting_error
FROM customer LEFT JOIN (SELECT id_product, name FROM products) p ON id_product = c_custkey""",
    "imported": """
SELECT DISTINCT CONCAT('ext-', CAST(CAST(FLOOR(s_acctbal / 100) AS BIGINT) AS VARCHAR)) AS external_id FROM supplier""",
    "marks": """
SELECT import_row_id, CASE WHEN i.external_id IS NOT NULL THEN 'External id already imported'
       WHEN rn > 1 THEN 'Duplicate external id in this batch' END AS duplicate_error
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY import_batch_id, external_id ORDER BY record_index) AS rn
      FROM staging WHERE external_id IS NOT NULL) s LEFT JOIN imported i ON i.external_id = s.external_id""",
    "matched": """
SELECT s.*, duplicate_error, CASE WHEN provided_id_product IS NOT NULL THEN provided_id_product WHEN hits = 1 THEN named_id END AS matched_id_product,
       CASE WHEN provided_id_product IS NOT NULL THEN CASE WHEN k.id_product IS NOT NULL THEN 'ready_to_import' ELSE 'waiting_for_product' END
            WHEN hits = 1 THEN 'ready_to_import' ELSE 'needs_review' END AS found_status,
       CASE WHEN provided_id_product IS NOT NULL THEN CASE WHEN k.id_product IS NOT NULL THEN 1.0::DOUBLE END
            WHEN hits = 1 THEN 0.9::DOUBLE ELSE 0.0::DOUBLE END AS match_confidence,
       CASE WHEN provided_id_product IS NOT NULL THEN CASE WHEN k.id_product IS NULL THEN 'Product matched, but not yet present in the local catalog' END
            WHEN hits > 1 THEN 'Multiple possible products found' WHEN hits IS NULL THEN 'No matching product found' END AS found_message,
       NULLIF(CONCAT_WS('; ', NULLIF(field_error, ''), duplicate_error), '') AS blocking
FROM staging s LEFT JOIN marks m ON m.import_row_id = s.import_row_id AND m.duplicate_error IS NOT NULL
LEFT JOIN {catalog} k ON k.id_product = s.provided_id_product
LEFT JOIN (SELECT name, COUNT(*) AS hits, MIN(id_product) AS named_id FROM {catalog} GROUP BY name) n
  ON n.name = s.raw_product_name AND s.provided_id_product IS NULL""",
    "judged": """
SELECT *, CASE WHEN blocking IS NOT NULL THEN 'error' ELSE found_status END AS match_status,
       COALESCE(blocking, found_message) AS error_message FROM matched""",
    "listing": """
SELECT DISTINCT CONCAT('guide_', CAST(user_id AS VARCHAR)) AS prefix, CAST(ts AS DATE) AS snapshot_date,
       CASE WHEN hour(ts) > 0 THEN CAST(hour(ts) AS BIGINT) END AS rerun,
       CONCAT('guide_', CAST(user_id AS VARCHAR), '_', strftime(ts, '%Y-%m-%d'),
              CASE WHEN hour(ts) = 0 THEN '' ELSE printf('_rerun-%02d', hour(ts)) END, '.json') AS file_name
FROM events""",
    "latest": """
SELECT id_product, snapshot_date, trend, avg30, low, COALESCE((trend + avg30) / 2, trend, avg30) AS emv FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY id_product ORDER BY snapshot_date DESC) AS rn FROM prices) t WHERE rn = 1""",
    "valued": """
SELECT i.*, p.name, p.product_group, p.id_expansion, p.id_category, emv, emv - purchase_price AS gain
FROM items i LEFT JOIN products p ON p.id_product = i.id_product LEFT JOIN latest l ON l.id_product = i.id_product""",
    "points": """
SELECT l.id_product, l.trend, l.avg30, l.snapshot_date AS latest_date, f.first_date, f.last_usable, d.d,
       (SELECT arg_max(h.trend_or, h.snapshot_date) FROM (SELECT id_product, snapshot_date, {{'v': trend}} AS trend_or FROM prices) h
        WHERE h.id_product = l.id_product AND h.snapshot_date <= d.d - 7).v AS trend_7,
       (SELECT arg_max(h.trend_or, h.snapshot_date) FROM (SELECT id_product, snapshot_date, {{'v': trend}} AS trend_or FROM prices) h
        WHERE h.id_product = l.id_product AND h.snapshot_date <= d.d - 14).v AS trend_14,
       (SELECT arg_max(h.trend_or, h.snapshot_date) FROM (SELECT id_product, snapshot_date, {{'v': trend}} AS trend_or FROM prices) h
        WHERE h.id_product = l.id_product AND h.snapshot_date <= d.d - 28).v AS trend_28
FROM latest l CROSS JOIN day d JOIN (
  SELECT id_product, MIN(snapshot_date) AS first_date,
         MAX(CASE WHEN trend IS NOT NULL OR avg30 IS NOT NULL THEN snapshot_date END) AS last_usable
  FROM prices GROUP BY id_product) f ON f.id_product = l.id_product""",
    "aged": """
SELECT t.*, p.product_group, p.is_active_in_catalog, p.first_seen, d - first_seen AS age
FROM points t JOIN products p ON p.id_product = t.id_product""",
    "growth": """
SELECT 'growth' AS signal_type, id_product, product_group, lookback, previous, trend, (trend - previous) / NULLIF(previous, 0) * 100 AS pct, d
FROM (SELECT *, 7 AS lookback, trend_7 AS previous FROM aged
      UNION ALL SELECT *, 14, trend_14 FROM aged UNION ALL SELECT *, 28, trend_28 FROM aged) g
WHERE age >= 14 AND latest_date - first_date >= 7""",
    "growth_signal": """
SELECT sha256(CONCAT_WS('~', CAST(d AS VARCHAR), 'growth', CAST(id_product AS VARCHAR), '', CAST(lookback AS VARCHAR))) AS signal_id,
       d AS signal_date, id_product, CAST(NULL AS VARCHAR) AS collection_item_id, 'growth' AS signal_type, pct AS signal_value,
       CASE WHEN pct > 25 THEN 'high' WHEN pct >= 10 THEN 'medium' ELSE 'low' END AS signal_strength,
       CAST(lookback AS BIGINT) AS lookback_days, previous AS reference_value, trend AS current_value
FROM growth WHERE pct >= 5""",
    "spike_signal": """
SELECT sha256(CONCAT_WS('~', CAST(d AS VARCHAR), 'price_spike', CAST(id_product AS VARCHAR), '', '')) AS signal_id,
       d AS signal_date, id_product, CAST(NULL AS VARCHAR) AS collection_item_id, 'price_spike' AS signal_type, pct AS signal_value,
       CASE WHEN pct > 40 THEN 'high' WHEN pct >= 20 THEN 'medium' ELSE 'low' END AS signal_strength,
       CAST(NULL AS BIGINT) AS lookback_days, avg30 AS reference_value, trend AS current_value
FROM (SELECT *, (trend - avg30) / NULLIF(avg30, 0) * 100 AS pct FROM aged WHERE age >= 14) s WHERE pct >= 10""",
    "new_signal": """
SELECT sha256(CONCAT_WS('~', CAST(d AS VARCHAR), 'new_product', CAST(id_product AS VARCHAR), '', '')) AS signal_id,
       d AS signal_date, id_product, CAST(NULL AS VARCHAR) AS collection_item_id, 'new_product' AS signal_type,
       CAST(d - first_seen AS DOUBLE) AS signal_value,
       CASE WHEN d - first_seen <= 3 THEN 'high' WHEN d - first_seen <= 14 THEN 'medium' ELSE 'low' END AS signal_strength,
       CAST(NULL AS BIGINT) AS lookback_days, CAST(NULL AS DOUBLE) AS reference_value, CAST(NULL AS DOUBLE) AS current_value
FROM products CROSS JOIN day WHERE d - first_seen BETWEEN 0 AND 30""",
    "item_signal": """
SELECT sha256(CONCAT_WS('~', CAST(d AS VARCHAR), kind, CAST(id_product AS VARCHAR), CAST(collection_item_id AS VARCHAR), '')) AS signal_id,
       d AS signal_date, id_product, CAST(collection_item_id AS VARCHAR) AS collection_item_id, kind AS signal_type,
       ABS(emv - purchase_price) AS signal_value,
       CASE WHEN pct > 40 THEN 'high' WHEN pct >= 15 THEN 'medium' WHEN pct >= 5 THEN 'low' END AS signal_strength,
       CAST(NULL AS BIGINT) AS lookback_days, purchase_price AS reference_value, emv AS current_value
FROM (SELECT i.collection_item_id, i.id_product, i.purchase_price, l.emv, d.d,
             CASE WHEN emv > purchase_price THEN 'collection_gain' ELSE 'collection_loss' END AS kind,
             ABS((emv - purchase_price) / NULLIF(purchase_price, 0) * 100) AS pct
      FROM items i JOIN latest l ON l.id_product = i.id_product CROSS JOIN day d
      WHERE NOT is_sold AND purchase_price IS NOT NULL AND emv <> purchase_price) s""",
    "missing_signal": """
SELECT sha256(CONCAT_WS('~', CAST(d AS VARCHAR), 'missing_price_data', CAST(id_product AS VARCHAR), '', '')) AS signal_id,
       d AS signal_date, id_product, CAST(NULL AS VARCHAR) AS collection_item_id, 'missing_price_data' AS signal_type,
       CAST(NULL AS DOUBLE) AS signal_value,
       CASE WHEN gap > 30 THEN 'high' WHEN gap >= 14 THEN 'medium' ELSE 'low' END AS signal_strength,
       CAST(NULL AS BIGINT) AS lookback_days, CAST(NULL AS DOUBLE) AS reference_value, CAST(NULL AS DOUBLE) AS current_value
FROM (SELECT p.id_product, y.d, y.d - COALESCE(t.last_usable, p.first_seen) AS gap
      FROM products p CROSS JOIN day y LEFT JOIN points t ON t.id_product = p.id_product
      WHERE p.is_active_in_catalog AND t.trend IS NULL AND t.avg30 IS NULL AND p.first_seen < y.d) s""",
    "signals": """
SELECT * FROM growth_signal UNION ALL SELECT * FROM spike_signal UNION ALL SELECT * FROM new_signal
UNION ALL SELECT * FROM item_signal UNION ALL SELECT * FROM missing_signal""",
    "set_words": """
SELECT *, NULLIF(TRIM(regexp_replace(regexp_replace(
         CASE WHEN starts_with(LOWER(name_en), CONCAT(LOWER(series_en), ' - ')) THEN SUBSTR(LOWER(name_en), LENGTH(series_en) + 4)
              ELSE LOWER(name_en) END, '&', ' and ', 'g'), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')), '') AS words
FROM sets""",
    "set_keys": """
SELECT 'exact_name' AS method, name_en AS match_key, tcg_set_id FROM set_words
UNION ALL SELECT 'normalized_name', words, tcg_set_id FROM set_words
UNION ALL SELECT 'code', UPPER(ptcgo_code), tcg_set_id FROM set_words WHERE ptcgo_code IS NOT NULL
UNION ALL SELECT 'slug', words, tcg_set_id FROM set_words
UNION ALL SELECT 'date_name_combo', CONCAT(split_part(words, ' ', 1), '|', strftime(release_date, '%Y-%m-%d')), tcg_set_id
          FROM set_words WHERE release_date IS NOT NULL""",
    "expansion_keys": """
SELECT id_expansion, 'exact_name' AS method, 1 AS pri, 1.0 AS score, 0 AS distance, name_en AS match_key FROM expansions
UNION ALL SELECT id_expansion, 'normalized_name', 2, 0.95, 0, REPLACE(LOWER(name_en), '#', ' ') FROM expansions
UNION ALL SELECT id_expansion, 'code', 3, 0.95, 0, set_code FROM expansions
UNION ALL SELECT id_expansion, 'slug', 4, 0.90, 0, REPLACE(LOWER(slug), '-', ' ') FROM expansions
UNION ALL SELECT id_expansion, 'date_name_combo', 5, 0.75, ABS(o.o), CONCAT('supplier|', strftime(release_date + CAST(o.o AS INTEGER), '%Y-%m-%d'))
          FROM expansions, range(-7, 8) o(o)""",
    "mappings": """
SELECT e.id_expansion, b.tcg_set_id,
       CASE WHEN b.tcg_set_id IS NULL THEN 'unmatched' WHEN b.pos = 1 AND b.conf >= 0.9 THEN 'matched' ELSE 'manual_review' END AS match_status,
       COALESCE(b.method, 'none') AS match_method, CAST(COALESCE(b.conf, 0) AS DOUBLE) AS match_confidence,
       COALESCE(b.pos = 1, FALSE) AS is_primary_mapping, NOT COALESCE(b.pos = 1 AND b.conf >= 0.9, FALSE) AS needs_review,
       COALESCE(b.n, 0) AS candidate_count
FROM expansions e LEFT JOIN (
  SELECT *, CASE WHEN n > 1 THEN LEAST(score, 0.7) ELSE score END AS conf,
         ROW_NUMBER() OVER (PARTITION BY id_expansion ORDER BY pri, distance, tcg_set_id) AS pos FROM (
    SELECT k.*, x.n, x.tcg_set_id, ROW_NUMBER() OVER (PARTITION BY id_expansion, x.tcg_set_id ORDER BY pri, distance) AS dup
    FROM expansion_keys k JOIN (SELECT method, match_key, tcg_set_id, COUNT(*) OVER (PARTITION BY method, match_key) AS n FROM set_keys) x
      ON x.method = k.method AND x.match_key = k.match_key) r WHERE dup = 1) b ON b.id_expansion = e.id_expansion""",
    "counts": """
SELECT DATE '2024-01-20' AS snapshot_date,
  (SELECT COUNT(*) FROM prices WHERE snapshot_date = DATE '2024-01-20') AS rows_loaded,
  (SELECT COUNT(*) FROM prices s WHERE snapshot_date = DATE '2024-01-20'
     AND NOT EXISTS (SELECT 1 FROM products p WHERE p.id_product = s.id_product)) AS missing_products,
  (SELECT COUNT(*) FROM products p LEFT JOIN prices s ON s.id_product = p.id_product AND s.snapshot_date = DATE '2024-01-20'
   WHERE p.is_active_in_catalog AND (s.id_product IS NULL OR (s.trend IS NULL AND s.avg30 IS NULL))) AS products_without_prices,
  (SELECT COUNT(*) FROM prices s JOIN products p ON p.id_product = s.id_product
   WHERE snapshot_date = DATE '2024-01-20' AND s.id_category <> p.id_category) AS category_mismatch,
  (SELECT COUNT(*) FROM prices WHERE snapshot_date = DATE '2024-01-20' AND trend IS NULL AND avg30 IS NULL) AS rows_without_value,
  (SELECT COUNT(*) FROM (SELECT id_product FROM prices WHERE snapshot_date = DATE '2024-01-20' AND id_product IS NOT NULL
     GROUP BY id_product HAVING COUNT(*) > 1) r) AS duplicate_keys,
  (SELECT COUNT(*) FROM prices WHERE snapshot_date = DATE '2024-01-20' AND id_product IS NULL) AS missing_ids,
  (SELECT COUNT(*) FROM prices WHERE snapshot_date = (SELECT MAX(snapshot_date) FROM prices WHERE snapshot_date < DATE '2024-01-20')) AS previous_rows""",
    "check_rows": """
SELECT snapshot_date, 'empty_price_snapshot' AS check_name, 'failure' AS severity, CAST(CASE WHEN rows_loaded = 0 THEN 1 ELSE 0 END AS BIGINT) AS violation_count FROM counts
UNION ALL SELECT snapshot_date, 'missing_products', 'warning', missing_products FROM counts
UNION ALL SELECT snapshot_date, 'products_without_prices', 'warning', products_without_prices FROM counts
UNION ALL SELECT snapshot_date, 'category_mismatch', 'warning', category_mismatch FROM counts
UNION ALL SELECT snapshot_date, 'record_count_drift', 'warning',
  CAST(CASE WHEN previous_rows > 0 AND ABS(rows_loaded - previous_rows) * 100.0 / previous_rows > 20 THEN 1 ELSE 0 END AS BIGINT) FROM counts""",
}


def _sql(body: str, catalog: str = "products") -> str:
    """The statement with the derived tables it reads, directly or through others.
    ``catalog`` names the product table that import rows are matched against."""
    texts = {name: text.format(catalog=catalog) if "{" in text else text for name, text in _TABLES.items()}
    needed: list[str] = []
    text = body
    # A table only reads tables above it, so one walk from the bottom up finds them all.
    for name in reversed(texts):
        if re.search(rf"\b(FROM|JOIN) {name}\b", text):
            needed.insert(0, f"{name} AS ({texts[name].strip()})")
            text += texts[name]
    return f"WITH {', '.join(needed)}\n{body.strip()}" if needed else body.strip()


_R = "ROUND({0}, 4) AS {1}"
_SIGNAL = (
    "SELECT signal_id, signal_date, id_product, collection_item_id, signal_type, ROUND(signal_value, 4) AS signal_value, "
    "signal_strength, lookback_days, ROUND(reference_value, 4) AS reference_value, ROUND(current_value, 4) AS current_value FROM "
)
_VALUE = (
    "SELECT {0}, COUNT(*) AS items, ROUND(SUM(emv), 4) AS estimated_market_value, "
    "ROUND(SUM(gain), 4) AS unrealized_gain_loss FROM valued WHERE NOT is_sold GROUP BY {0}"
)
_PROFILE = """
SELECT field, COUNT(*) AS occurrences, COUNT(*) FILTER (WHERE value IS NULL) AS null_count,
       COUNT(*) FILTER (WHERE kind = 'boolean') AS boolean_count, COUNT(*) FILTER (WHERE kind = 'integer') AS integer_count,
       COUNT(*) FILTER (WHERE kind = 'number') AS number_count, COUNT(*) FILTER (WHERE kind = 'array') AS array_count,
       COUNT(*) FILTER (WHERE kind = 'object') AS object_count, COUNT(*) FILTER (WHERE kind = 'text') AS text_count,
       COUNT(DISTINCT value) AS distinct_values, MIN(value) AS smallest, MAX(value) AS largest
FROM (SELECT *, CASE WHEN value IS NULL THEN 'null' WHEN value IN ('true', 'false') THEN 'boolean'
        WHEN regexp_full_match(value, '-?[0-9]+') THEN 'integer' WHEN regexp_full_match(value, '-?[0-9]+\\.[0-9]+') THEN 'number'
        ELSE 'text' END AS kind FROM ({0}) f) k GROUP BY field"""


def oracle() -> dict[str, str]:
    sql = {
        "latest_prices": f"""SELECT l.id_product, snapshot_date, {_R.format('trend', 'trend')}, {_R.format('avg30', 'avg30')},
            {_R.format('low', 'low')}, {_R.format('emv', 'estimated_market_value')}, p.is_active_in_catalog
            FROM latest l LEFT JOIN products p ON p.id_product = l.id_product""",
        "price_history": f"""SELECT s.id_product, p.name, p.product_group, snapshot_date, {_R.format('trend', 'trend')},
            {_R.format('avg30', 'avg30')}, ROUND(COALESCE((trend + avg30) / 2, trend, avg30), 4) AS estimated_market_value,
            p.is_active_in_catalog FROM prices s LEFT JOIN products p ON p.id_product = s.id_product""",
        "price_batch_dedupe": f"""SELECT snapshot_date, id_product, seq, id_category, {_R.format('trend', 'trend')},
            {_R.format('avg30', 'avg30')}, {_R.format('low', 'low')} FROM (
            SELECT *, ROW_NUMBER() OVER (PARTITION BY snapshot_date, id_product ORDER BY seq DESC) AS rn FROM price_batch) t WHERE rn = 1""",
        "merge_prices_state": f"""SELECT snapshot_date, id_product, id_category, {_R.format('trend', 'trend')}, {_R.format('avg30', 'avg30')},
            {_R.format('low', 'low')}, CASE WHEN snapshot_date < DATE '2024-01-20' THEN DATE '2024-01-25' ELSE DATE '2024-02-01' END AS created_at
            FROM prices""",
        "archive_replay": """SELECT CAST(ts AS DATE) AS snapshot_date, user_id * 14 AS id_product,
            CAST(regexp_extract(props, '"k": ([0-9]+)', 1) AS BIGINT) AS id_category,
            CASE WHEN event_type <> 'error' THEN ROUND(value, 4) END AS trend,
            CASE WHEN event_type NOT IN ('error', 'click') THEN ROUND(value * 0.9::DOUBLE, 4) END AS avg30,
            CASE WHEN event_type = 'view' THEN 0.0::DOUBLE END AS trend_holo,
            CAST(date_trunc('second', ts) - INTERVAL 2 HOUR AS DATE) AS source_date, TRUE AS avg_absent
            FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY CAST(ts AS DATE), user_id ORDER BY event_id DESC) AS rn FROM events) e WHERE rn = 1""",
        "replay_comparison": """SELECT snapshot_date, COUNT(*) AS replayed_rows, COUNT(*) AS stored_rows, TRUE AS equal
            FROM prices GROUP BY snapshot_date""",
        "price_guide_violations": """SELECT CAST(event_id AS VARCHAR) AS file_name,
            CASE WHEN event_type = 'view' THEN CAST(0 AS BIGINT) END AS record_index,
            CASE event_type WHEN 'view' THEN 'missing idProduct' WHEN 'click' THEN 'zero records' WHEN 'error' THEN 'invalid json'
                 ELSE 'no record list' END AS reason
            FROM events WHERE event_type <> 'signup'""",
        "top_movers": f"""SELECT id_product, snapshot_date, {_R.format('trend', 'trend')}, {_R.format('avg30', 'avg30')}, ROUND(move, 4) AS move_percent
            FROM (SELECT *, (trend - avg30) / NULLIF(avg30, 0) * 100 AS move FROM latest) m WHERE move IS NOT NULL
            ORDER BY move DESC, id_product LIMIT 50""",
        "watchlist_overview": f"""SELECT s_suppkey AS watchlist_item_id, w.id_product, p.name, p.product_group, s_name AS reason,
            ROUND(s_acctbal / 100, 4) AS target_price, snapshot_date, {_R.format('trend', 'trend')}, {_R.format('avg30', 'avg30')},
            {_R.format('emv', 'estimated_market_value')}, CASE WHEN l.id_product IS NOT NULL THEN p.is_active_in_catalog END AS is_active_in_catalog
            FROM (SELECT *, CAST(FLOOR(s_suppkey * 1.5::DOUBLE) AS BIGINT) * 14 AS id_product FROM supplier WHERE s_acctbal > 0) w
            LEFT JOIN latest l ON l.id_product = w.id_product LEFT JOIN products p ON p.id_product = w.id_product""",
        "check_missing_products": """SELECT id_product, snapshot_date FROM prices s WHERE snapshot_date = DATE '2024-01-20'
            AND NOT EXISTS (SELECT 1 FROM products p WHERE p.id_product = s.id_product)""",
        "check_products_without_prices": """SELECT p.id_product, name, product_group, category_name, last_seen AS last_seen_at
            FROM products p LEFT JOIN prices s ON s.id_product = p.id_product AND s.snapshot_date = DATE '2024-01-20'
            WHERE p.is_active_in_catalog AND (s.id_product IS NULL OR (s.trend IS NULL AND s.avg30 IS NULL))""",
        "products_without_prices_now": """SELECT p.id_product, name, product_group, category_name, last_seen AS last_seen_at
            FROM products p LEFT JOIN prices s ON s.id_product = p.id_product AND s.snapshot_date = (SELECT MAX(snapshot_date) FROM price_batch)
            WHERE p.is_active_in_catalog AND (s.id_product IS NULL OR (s.trend IS NULL AND s.avg30 IS NULL))""",
        "check_category_mismatch": """SELECT s.id_product, snapshot_date, s.id_category AS price_category, p.id_category AS product_category
            FROM prices s JOIN products p ON p.id_product = s.id_product
            WHERE snapshot_date = DATE '2024-01-20' AND s.id_category <> p.id_category""",
        "check_duplicates": """SELECT snapshot_date, id_product, COUNT(*) AS duplicate_count FROM price_batch
            GROUP BY snapshot_date, id_product HAVING COUNT(*) > 1""",
        "check_empty": """SELECT d + 1 AS snapshot_date, (SELECT COUNT(*) FROM prices WHERE snapshot_date > d) AS row_count FROM day""",
        "check_drift": """SELECT snapshot_date, previous_count, current_count,
            ROUND(ABS(current_count - previous_count) / CAST(previous_count AS DOUBLE) * 100, 2) AS percent,
            COALESCE(ABS(current_count - previous_count) / CAST(previous_count AS DOUBLE) * 100 > 2, FALSE) AS drifted
            FROM (SELECT snapshot_date, COUNT(*) AS current_count, LAG(COUNT(*)) OVER (ORDER BY snapshot_date) AS previous_count
                  FROM price_batch GROUP BY snapshot_date) c""",
        "check_drift_on_date": """SELECT * FROM (SELECT snapshot_date, LAG(COUNT(*)) OVER (ORDER BY snapshot_date) AS previous_count, COUNT(*) AS current_count,
            ROUND(ABS(COUNT(*) - LAG(COUNT(*)) OVER (ORDER BY snapshot_date)) / CAST(LAG(COUNT(*)) OVER (ORDER BY snapshot_date) AS DOUBLE) * 100, 2) AS percent
            FROM price_batch GROUP BY snapshot_date) c WHERE snapshot_date = DATE '2024-01-20' AND percent > 0.5""",
        "daily_checks": "SELECT * FROM check_rows",
        "daily_run_status": """SELECT snapshot_date, CASE WHEN MAX(CASE WHEN severity = 'failure' THEN violation_count END) > 0 THEN 'failed'
            WHEN MAX(CASE WHEN severity = 'warning' THEN violation_count END) > 0 THEN 'success with warnings' ELSE 'success' END AS status
            FROM check_rows GROUP BY snapshot_date""",
        "daily_summary": """SELECT c.*, CASE WHEN rows_loaded = 0 THEN 'failed' WHEN w.warnings <> '' THEN 'success with warnings' ELSE 'success' END AS status,
            w.warnings FROM counts c CROSS JOIN (SELECT CONCAT_WS(', ',
              MAX(CASE WHEN check_name = 'missing_products' AND violation_count > 0 THEN CONCAT('missing_products=', violation_count) END),
              MAX(CASE WHEN check_name = 'products_without_prices' AND violation_count > 0 THEN CONCAT('products_without_prices=', violation_count) END),
              MAX(CASE WHEN check_name = 'category_mismatch' AND violation_count > 0 THEN CONCAT('category_mismatch=', violation_count) END),
              MAX(CASE WHEN check_name = 'record_count_drift' AND violation_count > 0 THEN CONCAT('record_count_drift=', violation_count) END)) AS warnings
              FROM check_rows) w""",
        "daily_summary_with_defects": """SELECT c.snapshot_date, CAST(c.rows_loaded + d.repeated + d.lost AS BIGINT) AS rows_loaded,
            d.repeated AS duplicate_keys, d.lost AS missing_ids, c.missing_products, c.category_mismatch, c.products_without_prices
            FROM counts c CROSS JOIN (SELECT COUNT(*) FILTER (WHERE trend > avg30) AS repeated, COUNT(*) FILTER (WHERE trend < avg30) AS lost
              FROM prices WHERE snapshot_date = DATE '2024-01-20') d""",
        "collection_issues": """SELECT collection_item_id, 'graded item missing grading_company or grade' AS issue FROM items
            WHERE is_graded AND (grading_company IS NULL OR grade IS NULL)
            UNION ALL SELECT collection_item_id, 'sold item missing sold_price or sold_date' FROM items
            WHERE is_sold AND (sold_price IS NULL OR sold_date IS NULL)
            UNION ALL SELECT collection_item_id, 'sold_price/sold_date populated while is_sold = false' FROM items
            WHERE NOT is_sold AND (sold_price IS NOT NULL OR sold_date IS NOT NULL)
            UNION ALL SELECT collection_item_id, 'negative purchase_price' FROM items WHERE purchase_price < 0
            UNION ALL SELECT collection_item_id, 'negative sold_price' FROM items WHERE sold_price < 0
            UNION ALL SELECT collection_item_id, 'purchase_date in the future' FROM items WHERE purchase_date > DATE '2001-07-01'
            UNION ALL SELECT collection_item_id, 'sold_date in the future' FROM items WHERE sold_date > DATE '2001-07-01'""",
        "merge_products_state": "SELECT * FROM merged_products",
        "missing_products": """SELECT id_product, name FROM known_products k WHERE is_active_in_catalog
            AND NOT EXISTS (SELECT 1 FROM catalog c WHERE c.id_product = k.id_product)""",
        "new_product_ids": """SELECT id_product AS record_index, id_product FROM catalog c
            WHERE NOT EXISTS (SELECT 1 FROM known_products k WHERE k.id_product = c.id_product)""",
        "catalog_run_summary": """SELECT COUNT(*) FILTER (WHERE catalog_change IN ('inserted', 'updated') AND product_group = 'single') AS singles_loaded,
            COUNT(*) FILTER (WHERE catalog_change IN ('inserted', 'updated') AND product_group <> 'single') AS non_singles_loaded,
            COUNT(*) FILTER (WHERE is_active_in_catalog) AS active_products, COUNT(*) FILTER (WHERE catalog_change = 'inserted') AS new_products,
            COUNT(*) FILTER (WHERE catalog_change = 'deactivated') AS deactivated_products,
            COUNT(*) FILTER (WHERE catalog_change IN ('inserted', 'updated') AND TRIM(name) = '') AS missing_names FROM merged_products""",
        "cross_file_duplicates": """SELECT id_product, id_metacard = 6 AND UPPER(name) <> name AS conflicting, name AS single_name,
            CASE WHEN id_metacard = 6 THEN UPPER(name) ELSE name END AS non_single_name
            FROM products WHERE product_group = 'single' AND id_metacard <= 6""",
        "catalog_overview": """SELECT COUNT(*) AS row_count, COUNT(*) - COUNT(id_product) AS missing_id,
            COUNT(*) FILTER (WHERE name IS NULL OR TRIM(name) = '') AS missing_name, COUNT(*) - COUNT(id_expansion) AS missing_expansion,
            COUNT(*) - COUNT(id_category) AS missing_category, COUNT(id_product) - COUNT(DISTINCT id_product) AS duplicate_ids FROM products""",
        "products_by_expansion": "SELECT id_expansion, COUNT(*) AS products FROM products GROUP BY id_expansion",
        "products_by_category": "SELECT category_name, COUNT(*) AS products FROM products GROUP BY category_name",
        "products_by_source_file": "SELECT source_file, COUNT(*) AS products FROM products GROUP BY source_file",
        "column_profile": _PROFILE.format(
            "SELECT 'c_custkey' AS field, CAST(c_custkey AS VARCHAR) AS value FROM customer UNION ALL SELECT 'c_name', c_name FROM customer "
            "UNION ALL SELECT 'c_nationkey', CAST(c_nationkey AS VARCHAR) FROM customer UNION ALL SELECT 'c_mktsegment', c_mktsegment FROM customer"
        ),
        "record_profile": _PROFILE.format("SELECT 'k' AS field, regexp_extract(props, '\"k\": ([0-9]+)', 1) AS value FROM events"),
        "products_enriched": """SELECT id_product, p.name AS product_name, p.id_expansion, e.name_en AS expansion_name_en, e.name_de AS expansion_name_de,
            e.slug AS expansion_slug, e.series_en, e.series_de, e.release_date AS expansion_release_date, e.card_count AS expansion_card_count,
            id_category, is_active_in_catalog FROM products p LEFT JOIN expansions e ON e.id_expansion = p.id_expansion""",
        "missing_expansions": """SELECT DISTINCT id_expansion FROM products p WHERE id_expansion IS NOT NULL
            AND NOT EXISTS (SELECT 1 FROM expansions e WHERE e.id_expansion = p.id_expansion)""",
        "products_without_expansion": """SELECT id_product, name AS product_name, id_expansion FROM products p WHERE id_expansion IS NOT NULL
            AND NOT EXISTS (SELECT 1 FROM expansions e WHERE e.id_expansion = p.id_expansion)""",
        "expansion_coverage": """SELECT DISTINCT id_expansion, 'catalog_only' AS side FROM products p WHERE id_expansion IS NOT NULL
            AND NOT EXISTS (SELECT 1 FROM expansions e WHERE e.id_expansion = p.id_expansion)
            UNION ALL SELECT id_expansion, 'reference_only' FROM expansions e
            WHERE NOT EXISTS (SELECT 1 FROM products p WHERE p.id_expansion = e.id_expansion)""",
        "expansion_seed": """SELECT id_expansion, n AS detected_product_count, id_product AS sample_id_product, name AS sample_product_name, source_file
            FROM (SELECT *, COUNT(*) OVER (PARTITION BY id_expansion) AS n,
                         ROW_NUMBER() OVER (PARTITION BY id_expansion ORDER BY source_file, id_product) AS rn
                  FROM products WHERE id_expansion IS NOT NULL) t WHERE rn = 1""",
        "mapping_candidates": """SELECT id_expansion, tcg_set_id, match_status, match_method, match_confidence, is_primary_mapping, needs_review, candidate_count
            FROM mappings""",
        "mapping_keys": "SELECT * FROM set_keys",
        "trusted_mappings": """SELECT m.id_expansion, e.name_en AS market_name_en, e.name_de AS market_name_de, e.slug AS market_slug,
            e.series_en AS market_series_en, e.series_de AS market_series_de, e.release_date AS market_release_date, e.card_count AS market_card_count,
            m.tcg_set_id, s.name_en AS tcg_name, s.series_en AS tcg_series, s.ptcgo_code, s.release_date AS tcg_release_date,
            s.printed_total, s.total_cards, s.secret_card_count, match_status, match_method, match_confidence, is_primary_mapping, needs_review
            FROM mappings m JOIN expansions e ON e.id_expansion = m.id_expansion JOIN sets s ON s.tcg_set_id = m.tcg_set_id
            WHERE match_status = 'matched' AND match_confidence >= 0.9 AND is_primary_mapping AND NOT needs_review AND e.is_active""",
        "mappings_for_review": """SELECT m.id_expansion, e.name_en AS market_name_en, e.name_de AS market_name_de, e.slug AS market_slug,
            e.series_en AS market_series_en, e.release_date AS market_release_date, m.tcg_set_id, s.name_en AS tcg_name, s.series_en AS tcg_series,
            s.release_date AS tcg_release_date, match_status, match_method, match_confidence, is_primary_mapping, needs_review
            FROM mappings m LEFT JOIN expansions e ON e.id_expansion = m.id_expansion LEFT JOIN sets s ON s.tcg_set_id = m.tcg_set_id
            WHERE needs_review OR match_status = 'manual_review' OR match_confidence < 0.9 OR match_confidence IS NULL""",
        "price_report_chain": f"""SELECT x.snapshot_date, x.id_product, p.name AS product_name, p.product_group, {_R.format('trend', 'trend')}, {_R.format('avg30', 'avg30')},
            ROUND(COALESCE((trend + avg30) / 2, trend, avg30), 4) AS estimated_market_value, p.id_expansion, e.name_en AS expansion_name_en,
            m.tcg_set_id, s.name_en AS official_set_name, s.series_en AS series, COALESCE(s.release_date, e.release_date) AS release_date,
            CAST(CASE WHEN COALESCE(s.release_date, e.release_date) <= d.d THEN datesub('month', COALESCE(s.release_date, e.release_date), d.d) ELSE -datesub('month', d.d, COALESCE(s.release_date, e.release_date)) - CASE WHEN day(d.d) = day(COALESCE(s.release_date, e.release_date)) THEN 0 ELSE 1 END END AS BIGINT) AS months_since_release,
            s.printed_total, s.total_cards, s.secret_card_count, m.match_confidence AS mapping_confidence
            FROM prices x CROSS JOIN day d LEFT JOIN products p ON p.id_product = x.id_product LEFT JOIN expansions e ON e.id_expansion = p.id_expansion
            LEFT JOIN mappings m ON m.id_expansion = p.id_expansion AND m.is_primary_mapping LEFT JOIN sets s ON s.tcg_set_id = m.tcg_set_id""",
        "set_issues": """SELECT tcg_set_id, name_en, 'total below printed total' AS issue FROM sets WHERE total_cards < printed_total
            UNION ALL SELECT tcg_set_id, name_en, 'secret count differs' FROM sets WHERE secret_card_count <> total_cards - printed_total
            UNION ALL SELECT tcg_set_id, name_en, 'negative value' FROM sets WHERE printed_total < 0 OR total_cards < 0 OR secret_card_count < 0
            UNION ALL SELECT tcg_set_id, name_en, 'no release date' FROM sets WHERE release_date IS NULL
            UNION ALL SELECT tcg_set_id, name_en, 'no series' FROM sets WHERE series_en IS NULL OR TRIM(series_en) = ''
            UNION ALL SELECT tcg_set_id, name_en, 'no code' FROM sets WHERE ptcgo_code IS NULL OR TRIM(ptcgo_code) = ''""",
        "sets_by_activity": "SELECT is_active, COUNT(*) AS set_count FROM sets GROUP BY is_active ORDER BY is_active DESC",
        "series_overview": """SELECT series_en, COUNT(*) AS set_count, MIN(release_date) AS first_release_date, MAX(release_date) AS latest_release_date
            FROM sets GROUP BY series_en ORDER BY latest_release_date DESC NULLS LAST, series_en NULLS LAST""",
        "latest_sets": """SELECT tcg_set_id, name_en, series_en, ptcgo_code, release_date, printed_total, total_cards, secret_card_count
            FROM sets ORDER BY release_date DESC NULLS LAST, tcg_set_id LIMIT 20""",
        "find_sets": """SELECT tcg_set_id, name_en, series_en, release_date, is_active FROM sets
            WHERE LOWER(name_en) = 'supplier#000000005' OR tcg_set_id = 'set7'""",
        "duplicate_sets": "SELECT series_en AS tcg_set_id, COUNT(*) AS duplicate_count FROM sets GROUP BY series_en HAVING COUNT(*) > 1",
        "normalized_names": "SELECT tcg_set_id, name_en, words AS matching_name FROM set_words",
        "collection_current_value": f"""SELECT collection_item_id, id_product, name, product_group, language, condition,
            {_R.format('purchase_price', 'purchase_price')}, {_R.format('emv', 'estimated_market_value')}, {_R.format('gain', 'estimated_gain_loss')},
            ROUND((emv - purchase_price) / NULLIF(purchase_price, 0) * 100, 4) AS estimated_gain_loss_percent, storage_location
            FROM valued WHERE NOT is_sold""",
        "collection_summary": """SELECT COUNT(*) FILTER (WHERE NOT is_sold) AS active_items, COUNT(*) FILTER (WHERE is_sold) AS sold_items,
            COUNT(*) FILTER (WHERE NOT is_sold AND product_group = 'single') AS single_items, COUNT(*) FILTER (WHERE NOT is_sold AND is_sealed) AS sealed_items,
            ROUND(SUM(purchase_price) FILTER (WHERE NOT is_sold), 4) AS total_purchase_price, ROUND(SUM(emv) FILTER (WHERE NOT is_sold), 4) AS total_estimated_market_value,
            ROUND(SUM(gain) FILTER (WHERE NOT is_sold), 4) AS total_estimated_gain_loss, ROUND(AVG(emv) FILTER (WHERE NOT is_sold), 4) AS average_item_value,
            (SELECT collection_item_id FROM valued WHERE NOT is_sold AND emv IS NOT NULL ORDER BY emv DESC, purchase_date NULLS LAST, collection_item_id LIMIT 1) AS best_item,
            ROUND(MAX(emv) FILTER (WHERE NOT is_sold), 4) AS best_value FROM valued""",
        "value_by_group": _VALUE.format("product_group"),
        "value_by_expansion": _VALUE.format("id_expansion"),
        "value_by_category": _VALUE.format("id_category"),
        "unrealized_gain_loss": """SELECT COUNT(*) AS items, ROUND(SUM(purchase_price), 4) AS purchase_price, ROUND(SUM(emv), 4) AS estimated_market_value,
            ROUND(SUM(gain), 4) AS unrealized_gain_loss FROM valued WHERE NOT is_sold AND gain IS NOT NULL""",
        "signal_growth": _SIGNAL + "growth_signal",
        "signal_price_spike": _SIGNAL + "spike_signal",
        "signal_new_product": _SIGNAL.replace(
            " FROM ", ", CONCAT('Product was first seen ', CAST(CAST(signal_value AS BIGINT) AS VARCHAR), ' days ago.') AS text FROM "
        ) + "new_signal",
        "signal_gain_loss": _SIGNAL + "item_signal",
        "signal_missing_price": _SIGNAL + "missing_signal",
        "signal_sealed_growth": """SELECT sha256(CONCAT_WS('~', CAST(d AS VARCHAR), 'sealed_growth', CAST(id_product AS VARCHAR), '', CAST(lookback AS VARCHAR))) AS signal_id,
            d AS signal_date, id_product, CAST(NULL AS VARCHAR) AS collection_item_id, 'sealed_growth' AS signal_type, ROUND(pct, 4) AS signal_value,
            CASE WHEN pct > 25 THEN 'high' WHEN pct >= 10 THEN 'medium' ELSE 'low' END AS signal_strength, CAST(lookback AS BIGINT) AS lookback_days,
            ROUND(previous, 4) AS reference_value, ROUND(trend, 4) AS current_value FROM growth WHERE pct >= 5 AND product_group = 'non_single'""",
        "signal_buy_opportunity": """SELECT sha256(CONCAT_WS('~', CAST(d AS VARCHAR), 'potential_buy_opportunity', CAST(id_product AS VARCHAR), '', '28')) AS signal_id,
            d AS signal_date, id_product, CAST(NULL AS VARCHAR) AS collection_item_id, 'potential_buy_opportunity' AS signal_type,
            ROUND((trend - avg30) / NULLIF(avg30, 0) * 100, 4) AS signal_value, CAST(NULL AS VARCHAR) AS signal_strength, CAST(28 AS BIGINT) AS lookback_days,
            ROUND(avg30, 4) AS reference_value, ROUND(trend, 4) AS current_value FROM aged
            WHERE trend < avg30 AND (trend - trend_28) / NULLIF(trend_28, 0) * 100 > 0 AND latest_date - first_date >= 28 AND age >= 14""",
        "all_signals": _SIGNAL + "signals",
        "top_growth": """SELECT signal_date, s.id_product, name, product_group, collection_item_id, ROUND(signal_value, 4) AS signal_value, signal_strength,
            lookback_days, ROUND(reference_value, 4) AS reference_value, ROUND(current_value, 4) AS current_value
            FROM growth_signal s LEFT JOIN products p ON p.id_product = s.id_product""",
        "staging_match": """SELECT import_row_id, import_batch_id, external_id, matched_id_product, language, condition, acquisition_type,
            ROUND(purchase_price, 4) AS purchase_price, purchase_date, is_sealed, match_status, match_confidence, error_message FROM judged""",
        "staging_duplicates": "SELECT import_row_id, duplicate_error FROM marks WHERE duplicate_error IS NOT NULL",
        "promoted_items": """SELECT sha256(CONCAT_WS('~', import_batch_id, CAST(import_row_id AS VARCHAR))) AS collection_item_id,
            matched_id_product AS id_product, language, condition, acquisition_type, ROUND(purchase_price, 4) AS purchase_price, purchase_date, is_sealed,
            FALSE AS is_graded, FALSE AS is_sold FROM judged WHERE match_status = 'ready_to_import'""",
        "staging_after_promotion": """SELECT CASE WHEN match_status = 'ready_to_import' THEN 'imported' ELSE match_status END AS match_status,
            COUNT(*) AS import_rows, COUNT(*) FILTER (WHERE match_status = 'ready_to_import') AS stamped FROM judged GROUP BY 1""",
        "possible_duplicates": """SELECT DISTINCT j.import_row_id, j.import_batch_id, matched_id_product AS id_product, language, condition, purchase_date,
            ROUND(CASE WHEN purchase_price > 5000 THEN NULL ELSE purchase_price END, 4) AS purchase_price
            FROM judged j JOIN supplier s ON s.s_suppkey * 2 = j.matched_id_product
            WHERE match_status = 'ready_to_import' AND external_id IS NULL AND language = 'EN' AND condition = 'Near Mint'
              AND purchase_date IS NOT DISTINCT FROM DATE '2024-01-15'
              AND CASE WHEN purchase_price > 5000 THEN NULL ELSE purchase_price END IS NOT DISTINCT FROM
                  CASE WHEN s_nationkey < 12 THEN NULL ELSE FLOOR(s_acctbal) END""",
        "canonical_files": """SELECT prefix, snapshot_date, file_name, rerun IS NOT NULL AS is_rerun, rerun AS rerun_number, n - 1 AS superseded_count
            FROM (SELECT *, COUNT(*) OVER (PARTITION BY prefix, snapshot_date) AS n,
                  ROW_NUMBER() OVER (PARTITION BY prefix, snapshot_date ORDER BY COALESCE(rerun, -1) DESC) AS rn FROM listing) t WHERE rn = 1""",
        "superseded_files": """SELECT prefix, snapshot_date, file_name, rerun, canonical_file_name
            FROM (SELECT *, FIRST_VALUE(file_name) OVER (PARTITION BY prefix, snapshot_date ORDER BY COALESCE(rerun, -1) DESC) AS canonical_file_name
                  FROM listing) t WHERE file_name <> canonical_file_name""",
        "next_archive_name": """SELECT u.prefix, DATE '2024-01-20' AS snapshot_date,
            CASE WHEN h IS NULL THEN CONCAT(u.prefix, '_2024-01-20.json') ELSE CONCAT(u.prefix, printf('_2024-01-20_rerun-%02d.json', CAST(h + 1 AS BIGINT))) END AS next_file_name
            FROM (SELECT DISTINCT prefix FROM listing) u LEFT JOIN (SELECT prefix, MAX(COALESCE(rerun, 0)) AS h FROM listing
            WHERE snapshot_date = DATE '2024-01-20' GROUP BY prefix) x ON x.prefix = u.prefix""",
        "archive_gaps": """SELECT prefix, CAST(day AS DATE) AS snapshot_date FROM (
            SELECT prefix, UNNEST(generate_series(MIN(snapshot_date), MAX(snapshot_date), INTERVAL 1 DAY)) AS day FROM listing GROUP BY prefix) e
            WHERE NOT EXISTS (SELECT 1 FROM listing l WHERE l.prefix = e.prefix AND l.snapshot_date = CAST(e.day AS DATE))""",
        "constraint_violations": """SELECT 'items.acquisition_type' AS constraint_name, CAST(collection_item_id AS VARCHAR) AS key, acquisition_type AS value
            FROM items WHERE acquisition_type = 'swapped'
            UNION ALL SELECT 'expansions.card_count', CAST(id_expansion AS VARCHAR), CAST(card_count AS VARCHAR) FROM expansions WHERE card_count < 0
            UNION ALL SELECT 'expansions.release_date', CAST(id_expansion AS VARCHAR), CAST(release_date AS VARCHAR) FROM expansions WHERE release_date < DATE '1996-01-01'
            UNION ALL SELECT 'sets.total_cards', tcg_set_id, CAST(total_cards AS VARCHAR) FROM sets WHERE total_cards < 0
            UNION ALL SELECT 'items.product_exists', CAST(collection_item_id AS VARCHAR), CAST(id_product AS VARCHAR) FROM items i
              WHERE NOT EXISTS (SELECT 1 FROM products p WHERE p.id_product = i.id_product)
            UNION ALL SELECT 'prices.key', CONCAT_WS('~', CAST(snapshot_date AS VARCHAR), CAST(id_product AS VARCHAR)), CAST(COUNT(*) AS VARCHAR)
              FROM price_batch GROUP BY snapshot_date, id_product HAVING COUNT(*) > 1
            UNION ALL SELECT 'staging.match_status', CAST(c_custkey AS VARCHAR), LOWER(c_mktsegment) FROM customer
            UNION ALL SELECT 'staging.match_confidence', CAST(import_row_id AS VARCHAR), CAST(purchase_price / 1000 AS VARCHAR) FROM staging
              WHERE purchase_price < 0 OR purchase_price > 1000
            UNION ALL SELECT 'items.key', CAST(collection_item_id AS VARCHAR), CAST(COUNT(*) AS VARCHAR) FROM items
              GROUP BY collection_item_id HAVING COUNT(*) > 1
            UNION ALL SELECT 'watchlist.active', CAST(w AS VARCHAR), CAST(COUNT(*) AS VARCHAR) FROM (
              SELECT CAST(FLOOR(CAST(FLOOR(s_suppkey * 1.5::DOUBLE) AS BIGINT) * 14 / 28.0::DOUBLE) AS BIGINT) AS w FROM supplier WHERE s_acctbal > 0) x
              GROUP BY w HAVING COUNT(*) > 1""",
        "page_links": """SELECT href, link_text, COUNT(*) AS occurrences, MIN(page_id) AS first_page_id, MAX(page_id) AS last_page_id
            FROM (SELECT page_id, UNNEST(regexp_extract_all(html, '<a href="([^"]*)"[^>]*>([^<]*)</a>', 1)) AS href,
                         TRIM(regexp_replace(UNNEST(regexp_extract_all(html, '<a href="([^"]*)"[^>]*>([^<]*)</a>', 2)), '\\s+', ' ', 'g')) AS link_text
                  FROM pages) t GROUP BY href, link_text""",
    }
    sql.update(_more())
    queries = {name: _sql(body) for name, body in sql.items()}
    queries["recheck_waiting"] = _sql(
        """SELECT import_row_id, matched_id_product,
        CASE WHEN match_status = 'waiting_for_product' AND k.id_product IS NOT NULL THEN 'ready_to_import' ELSE match_status END AS match_status,
        CASE WHEN match_status = 'waiting_for_product' AND k.id_product IS NOT NULL THEN NULL ELSE error_message END AS error_message
        FROM judged j LEFT JOIN products k ON k.id_product = j.matched_id_product""",
        catalog="known_products",
    )
    return queries


def _view(signal: str) -> str:
    return f"""SELECT signal_date, s.id_product, name, product_group, collection_item_id, ROUND(signal_value, 4) AS signal_value, signal_strength,
        lookback_days, ROUND(reference_value, 4) AS reference_value, ROUND(current_value, 4) AS current_value
        FROM {signal} s LEFT JOIN products p ON p.id_product = s.id_product"""


def _more() -> dict[str, str]:
    """Twins of the source-format queries and of the remaining views."""
    strict = "('STANDARD', 'PROMO', 'ECONOMY', 'SMALL')"
    part_file = "CONCAT('products_', LOWER(p_type), '_6_', CAST(p_partkey AS VARCHAR))"
    release = "(DATE '1999-01-01' + CAST(FLOOR(c_acctbal) AS INTEGER))"
    return {
        "resolved_links": """WITH own AS (SELECT page_id, url AS page_url, UNNEST(regexp_extract_all(html, '<a href="([^"]*)"[^>]*>([^<]*)</a>', 1)) AS href,
                 TRIM(regexp_replace(UNNEST(regexp_extract_all(html, '<a href="([^"]*)"[^>]*>([^<]*)</a>', 2)), '\\s+', ' ', 'g')) AS link_text FROM pages),
            led AS (SELECT page_id, link_text, CASE WHEN regexp_matches(href, '^[a-zA-Z][a-zA-Z0-9+.-]*:') THEN href
                      WHEN starts_with(href, '/') THEN CONCAT(regexp_extract(page_url, '^([a-zA-Z]+://[^/?#]+)', 1), href)
                      ELSE CONCAT(regexp_extract(page_url, '^([a-zA-Z]+://[^?#]*/)', 1), href) END AS url FROM own),
            added AS (SELECT page_id, CONCAT('Café – ☺ ', CAST(page_id AS VARCHAR)) AS link_text,
                             CONCAT(CASE WHEN regexp_matches(regexp_extract(url, '^([a-zA-Z]+://[^?#]*/)', 1), '^[a-zA-Z]+://[^/]+/$')
                                         THEN regexp_extract(url, '^([a-zA-Z]+://[^?#]*/)', 1)
                                         ELSE regexp_replace(regexp_extract(url, '^([a-zA-Z]+://[^?#]*/)', 1), '[^/]+/$', '') END, 'x/y?a=1&b=2#f') AS url FROM pages
                      UNION ALL SELECT page_id, 'Top', CONCAT(string_split(url, '#')[1], '#top') FROM pages
                      UNION ALL SELECT page_id, 'Query', CONCAT(string_split(string_split(url, '#')[1], '?')[1], '?q=1') FROM pages)
            SELECT page_id, url, link_text, COUNT(*) AS occurrences FROM (SELECT page_id, url, link_text FROM led UNION ALL SELECT page_id, url, link_text FROM added) u
            GROUP BY page_id, url, link_text""",
        "card_links": """SELECT card_name, 'Whole site' AS set_name, set_code, '7/9' AS card_number, MIN(url) AS url FROM (
            SELECT *, ROW_NUMBER() OVER (PARTITION BY page_id, url ORDER BY pos DESC) AS rn FROM (
              SELECT page_id, pos, CONCAT('PG', CAST(page_id AS VARCHAR)) AS set_code, TRIM(regexp_replace(link_text, '\\s+', ' ', 'g')) AS card_name,
                     CASE WHEN regexp_matches(href, '^[a-zA-Z][a-zA-Z0-9+.-]*:') THEN href
                          WHEN starts_with(href, '/') THEN CONCAT(regexp_extract(page_url, '^([a-zA-Z]+://[^/?#]+)', 1), href)
                          ELSE CONCAT(regexp_extract(page_url, '^([a-zA-Z]+://[^?#]*/)', 1), href) END AS url
              FROM (SELECT page_id, url AS page_url, UNNEST(generate_series(1, len(regexp_extract_all(html, '<a href="([^"]*)"[^>]*>([^<]*)</a>', 1)))) AS pos,
                           UNNEST(regexp_extract_all(html, '<a href="([^"]*)"[^>]*>([^<]*)</a>', 1)) AS href,
                           UNNEST(regexp_extract_all(html, '<a href="([^"]*)"[^>]*>([^<]*)</a>', 2)) AS link_text FROM pages) l
              WHERE contains(href, '/')) u) r WHERE rn = 1 GROUP BY page_id, url, card_name, set_code""",
        "catalog_rows": f"""SELECT p_partkey AS id_product, CASE WHEN p_size = 2 THEN '' WHEN p_size <> 1 THEN p_name END AS name, p_type AS category_name,
            CASE WHEN p_size <> 3 THEN p_partkey END AS id_category, CAST(FLOOR(p_partkey / 19.0::DOUBLE) AS BIGINT) AS id_expansion,
            CAST(p_size AS BIGINT) AS id_metacard, CASE WHEN p_size <> 4 THEN DATE '2024-01-02' END AS date_added,
            'single' AS product_group, 'products_singles_6.json' AS source_file FROM part WHERE p_type IN {strict}""",
        "catalog_violations": f"""SELECT {part_file} AS file_name, CASE WHEN p_type IN {strict} THEN CAST(0 AS BIGINT) END AS record_index,
            CASE WHEN p_type IN {strict} THEN 'missing name' ELSE 'no record list' END AS reason
            FROM part WHERE p_type NOT IN {strict} OR p_size IN (1, 2)""",
        "date_added_warnings": f"SELECT {part_file} AS file_name FROM part WHERE p_type IN {strict} AND p_size = 4",
        "lenient_expansion_seed": f"""SELECT id_expansion, n AS detected_product_count, CAST(p_partkey AS VARCHAR) AS sample_id_product,
            CASE WHEN p_size = 2 THEN '' WHEN p_size <> 1 THEN p_name END AS sample_product_name, file_name AS source_file FROM (
            SELECT *, COUNT(*) OVER (PARTITION BY id_expansion) AS n, ROW_NUMBER() OVER (PARTITION BY id_expansion ORDER BY file_name) AS rn
            FROM (SELECT *, CAST(FLOOR(p_partkey / 19.0::DOUBLE) AS BIGINT) AS id_expansion, {part_file} AS file_name FROM part) f) t WHERE rn = 1""",
        "set_rows": f"""SELECT CONCAT('set', CAST(c_custkey AS VARCHAR)) AS tcg_set_id, c_name AS name_en, c_mktsegment AS series_en,
            CASE WHEN c_nationkey <> 2 THEN CONCAT('C', CAST(c_custkey AS VARCHAR)) END AS ptcgo_code,
            CASE WHEN c_nationkey <> 3 THEN {release} END AS release_date, CASE WHEN c_nationkey <> 1 THEN printed END AS printed_total,
            printed + c_nationkey - 4 AS total_cards, CASE WHEN c_nationkey <> 1 THEN CAST(GREATEST(c_nationkey - 4, 0) AS BIGINT) END AS secret_card_count,
            CASE WHEN c_nationkey > 9 THEN '{{{{"standard":"Legal"}}}}' ELSE '{{{{}}}}' END AS legalities,
            CASE WHEN c_nationkey <> 4 THEN 'sym' END AS symbol_url, CASE WHEN c_nationkey <> 4 THEN c_name END AS logo_url,
            {release} + TIME '13:45:00' AS source_updated_at, TRUE AS is_active,
            CASE WHEN c_nationkey < 4 AND c_nationkey <> 1
                 THEN 'Source has total_cards lower than printed_total; secret_card_count was normalized to 0.' ELSE '' END AS notes
            FROM (SELECT *, CAST(FLOOR(ABS(c_acctbal) / 50) AS BIGINT) AS printed FROM customer) c""".replace("{{", "{").replace("}}", "}"),
        "expansion_rows": """SELECT s_suppkey AS id_expansion, s_name AS name_en, CASE WHEN s_nationkey <> 3 THEN s_name END AS name_de,
            CASE WHEN s_nationkey <> 4 THEN CONCAT('V-', CAST(s_suppkey AS VARCHAR)) END AS slug,
            CASE WHEN s_nationkey <> 5 THEN DATE '2020-01-01' + s_nationkey END AS release_date,
            CASE WHEN s_nationkey <> 6 THEN CAST(FLOOR(ABS(s_acctbal)) AS BIGINT) END AS card_count, s_nationkey NOT IN (1, 2) AS is_active FROM supplier""",
        "expansion_metadata_errors": """SELECT s_suppkey + 2 AS line_number, CAST(s_suppkey AS VARCHAR) AS id_expansion, 'name_de is empty' AS error
            FROM supplier WHERE s_nationkey = 3""",
        "expansion_file_integrity": """SELECT 'name_de filled' AS rule, CONCAT(' ', CAST(s_suppkey AS VARCHAR), ' ') AS value FROM supplier WHERE s_nationkey = 3
            UNION ALL SELECT 'column present', UNNEST(['series_en', 'series_de', 'source_url_en', 'source_url_de'])""",
        "staged_rows": """SELECT sha256(CONCAT_WS('~', 'upload-1', CAST(c_custkey AS VARCHAR))) AS import_row_id, 'upload-1' AS import_batch_id,
            c_custkey AS record_index, CASE WHEN c_nationkey <> 1 THEN c_name END AS external_id,
            CASE WHEN c_nationkey < 12 THEN CAST(c_custkey * 2 AS VARCHAR) END AS provided_id_product, c_mktsegment AS raw_product_name,
            CASE WHEN c_nationkey IN (2, 3) THEN 'DE' ELSE 'FR' END AS language, 'Near Mint' AS condition, 'pulled' AS acquisition_type,
            CASE WHEN c_nationkey <> 4 THEN CAST(CAST(FLOOR(c_acctbal) AS BIGINT) AS VARCHAR) END AS purchase_price FROM customer""",
        "file_outcomes": """SELECT CAST(o_orderkey AS VARCHAR) AS file_name, CASE WHEN event_id IS NULL THEN 'missing' WHEN event_type = 'error' THEN 'invalid json'
            WHEN event_type = 'click' THEN 'zero records' ELSE 'ok' END AS outcome FROM orders LEFT JOIN events ON event_id = o_orderkey""",
        "archive_names": "SELECT file_name, prefix, snapshot_date, rerun, file_name AS rebuilt FROM listing",
        "pipeline_dates": """SELECT o_orderkey, CAST((o_orderdate + to_hours(CAST(o_custkey % 24 AS INTEGER))) AT TIME ZONE 'UTC' AT TIME ZONE 'Europe/Vienna' AS DATE) AS local_date
            FROM orders""",
        "merge_sets_state": """SELECT tcg_set_id, CASE WHEN printed_total >= 60 THEN UPPER(name_en) ELSE name_en END AS name_en, release_date,
            CASE WHEN printed_total >= 60 THEN TRUE ELSE is_active END AS is_active,
            CASE WHEN printed_total <= 120 THEN DATE '2024-01-25' ELSE DATE '2024-02-01' END AS created,
            CASE WHEN printed_total >= 60 THEN DATE '2024-02-01' ELSE DATE '2024-01-25' END AS updated FROM sets""",
        "merge_expansions_state": """SELECT id_expansion, CASE WHEN card_count >= 3000 THEN UPPER(name_en) ELSE name_en END AS name_en, series_en, is_active,
            CASE WHEN card_count <= 6000 THEN DATE '2024-01-25' ELSE DATE '2024-02-01' END AS created,
            CASE WHEN card_count >= 3000 THEN DATE '2024-02-01' ELSE DATE '2024-01-25' END AS updated FROM expansions""",
        "set_counts": """SELECT COUNT(*) AS total_sets, COUNT(*) FILTER (WHERE is_active) AS active_sets, COUNT(*) FILTER (WHERE NOT is_active) AS inactive_sets,
            COUNT(*) FILTER (WHERE release_date IS NULL) AS rows_missing_created_at,
            COUNT(*) FILTER (WHERE release_date IS NULL OR NOT is_active) AS rows_missing_updated_at FROM sets""",
        "staging_re_evaluated": """SELECT import_row_id, 'FR' AS language, DATE '2024-02-29' AS purchase_date,
            CASE WHEN left_over IS NOT NULL THEN 'error' ELSE found_status END AS match_status, COALESCE(left_over, found_message) AS error_message
            FROM (SELECT *, NULLIF(CONCAT_WS('; ', NULLIF(lasting_error, ''), duplicate_error), '') AS left_over
                  FROM judged WHERE match_status IN ('needs_review', 'error')) j""",
        "recent_price_spikes": _view("spike_signal"),
        "new_products": _view("new_signal"),
        "collection_gains": _view("item_signal") + " WHERE signal_type = 'collection_gain'",
        "collection_losses": _view("item_signal") + " WHERE signal_type = 'collection_loss'",
    }
