"""Stored tables: explicit schemas and the fixed vocabularies of their columns."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 4)
CONFIDENCE = T.DecimalType(4, 3)


def _table(*fields: tuple) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, nullable) for name, dtype, nullable in fields])


# --- Fixed values: enumerations, defaults and thresholds of the data model ---------
PRODUCT_GROUPS = ["single", "non_single"]
SOURCE_FILES = {"products_singles_6.json": "single", "products_nonsingles_6.json": "non_single"}
CATALOG_PREFIX_TO_FILE = {
    "products_singles_6": "products_singles_6.json",
    "products_nonsingles_6": "products_nonsingles_6.json",
}
PRICE_PREFIX = "price_guide_6"
ACQUISITION_TYPES = ["pulled", "bought_single", "bought_sealed", "trade", "gift", "unknown"]
CONDITIONS = [
    "Mint", "Near Mint", "Excellent", "Good", "Light Played", "Played", "Poor", "Unknown",
]
LANGUAGES = ["DE", "EN", "FR", "IT", "ES", "JP", "KR", "CN", "Other", "Unknown"]
MATCH_STATUSES = ["ready_to_import", "needs_review", "waiting_for_product", "error", "imported"]
SIGNAL_TYPES = [
    "growth", "price_spike", "new_product", "collection_gain", "collection_loss",
    "missing_price_data",
]
LATER_SIGNAL_TYPES = ["sealed_growth", "potential_buy_opportunity"]
SIGNAL_STRENGTHS = ["low", "medium", "high"]
MAPPING_STATUSES = ["matched", "manual_review", "unmatched", "not_applicable"]
MAPPING_METHODS = [
    "exact_name", "normalized_name", "slug", "code", "date_name_combo", "manual", "none",
]
COLLECTION_DEFAULTS = {"language": "DE", "condition": "Near Mint", "acquisition_type": "pulled"}
EARLIEST_RELEASE = "1996-01-01"
NEW_PRODUCT_DAYS = 14
MIN_GROWTH_HISTORY_DAYS = 7
GROWTH_LOOKBACKS = (7, 30, 90)
DRIFT_PERCENT = 20.0
TRUSTED_CONFIDENCE = 0.900
PIPELINE_ZONE = "Europe/Vienna"

PLAIN_PRICES = ["avg", "low", "trend", "avg1", "avg7", "avg30"]
HOLO_PRICES = ["avg_holo", "low_holo", "trend_holo", "avg1_holo", "avg7_holo", "avg30_holo"]
PRICE_COLUMNS = PLAIN_PRICES + HOLO_PRICES
# -----------------------------------------------------------------------------------

PRICE_KEYS = ["snapshot_date", "id_product"]
PRICE_VALUES = ["source_created_at", "id_category", *PRICE_COLUMNS]

PRICE_SNAPSHOTS = _table(
    ("snapshot_date", T.DateType(), False),
    ("source_created_at", T.TimestampType(), True),
    ("id_product", T.LongType(), False),
    ("id_category", T.LongType(), True),
    *[(name, MONEY, True) for name in PRICE_COLUMNS],
    ("created_at", T.TimestampType(), False),
)

CATALOG_VALUES = [
    "name", "id_category", "category_name", "id_expansion", "id_metacard", "date_added",
    "product_group", "source_file",
]

PRODUCTS = _table(
    ("id_product", T.LongType(), False),
    ("name", T.StringType(), False),
    ("id_category", T.LongType(), True),
    ("category_name", T.StringType(), True),
    ("id_expansion", T.LongType(), True),
    ("id_metacard", T.LongType(), True),
    ("date_added", T.TimestampType(), True),
    ("product_group", T.StringType(), False),
    ("source_file", T.StringType(), False),
    ("is_active_in_catalog", T.BooleanType(), False),
    ("first_seen_at", T.TimestampType(), False),
    ("last_seen_at", T.TimestampType(), False),
    ("updated_at", T.TimestampType(), False),
)

EXPANSION_VALUES = [
    "name_en", "name_de", "slug", "series_en", "series_de", "release_date", "card_count",
    "source_url_en", "source_url_de", "is_active", "notes",
]

EXPANSIONS = _table(
    ("id_expansion", T.LongType(), False),
    ("name_en", T.StringType(), False),
    ("name_de", T.StringType(), True),
    ("slug", T.StringType(), True),
    ("series_en", T.StringType(), True),
    ("series_de", T.StringType(), True),
    ("release_date", T.DateType(), True),
    ("card_count", T.IntegerType(), True),
    ("source_url_en", T.StringType(), True),
    ("source_url_de", T.StringType(), True),
    ("is_active", T.BooleanType(), False),
    ("notes", T.StringType(), True),
    ("created_at", T.TimestampType(), False),
    ("updated_at", T.TimestampType(), False),
)

# Column order of the normalized set file; the first column is the key.
SET_COLUMNS = [
    "tcg_set_id", "name_en", "series_en", "ptcgo_code", "release_date", "printed_total",
    "total_cards", "secret_card_count", "legalities", "symbol_url", "logo_url",
    "source_updated_at", "is_active", "notes",
]

TCG_SET_FILE = _table(
    ("tcg_set_id", T.StringType(), True),
    ("name_en", T.StringType(), True),
    ("series_en", T.StringType(), True),
    ("ptcgo_code", T.StringType(), True),
    ("release_date", T.DateType(), True),
    ("printed_total", T.IntegerType(), True),
    ("total_cards", T.IntegerType(), True),
    ("secret_card_count", T.IntegerType(), True),
    ("legalities", T.StringType(), True),
    ("symbol_url", T.StringType(), True),
    ("logo_url", T.StringType(), True),
    ("source_updated_at", T.TimestampNTZType(), True),
    ("is_active", T.BooleanType(), True),
    ("notes", T.StringType(), True),
)

TCG_SETS = T.StructType(
    TCG_SET_FILE.fields
    + [
        T.StructField("created_at", T.TimestampType(), False),
        T.StructField("updated_at", T.TimestampType(), False),
    ]
)

SET_MAPPINGS = _table(
    ("id_expansion", T.LongType(), False),
    ("tcg_set_id", T.StringType(), False),
    ("match_status", T.StringType(), False),
    ("match_method", T.StringType(), False),
    ("match_confidence", CONFIDENCE, True),
    ("is_primary_mapping", T.BooleanType(), False),
    ("needs_review", T.BooleanType(), False),
    ("notes", T.StringType(), True),
    ("created_at", T.TimestampType(), False),
    ("updated_at", T.TimestampType(), False),
)

COLLECTION_ITEMS = _table(
    ("collection_item_id", T.StringType(), False),
    ("id_product", T.LongType(), False),
    ("language", T.StringType(), False),
    ("condition", T.StringType(), False),
    ("acquisition_type", T.StringType(), False),
    ("purchase_price", MONEY, True),
    ("purchase_date", T.DateType(), True),
    ("is_sealed", T.BooleanType(), False),
    ("is_graded", T.BooleanType(), False),
    ("grading_company", T.StringType(), True),
    ("grade", T.StringType(), True),
    ("storage_location", T.StringType(), True),
    ("personal_note", T.StringType(), True),
    ("is_sold", T.BooleanType(), False),
    ("sold_price", MONEY, True),
    ("sold_date", T.DateType(), True),
    ("created_at", T.TimestampType(), False),
    ("updated_at", T.TimestampType(), False),
)

STAGING = _table(
    ("import_row_id", T.StringType(), False),
    ("import_batch_id", T.StringType(), False),
    ("external_id", T.StringType(), True),
    ("provided_id_product", T.LongType(), True),
    ("raw_product_name", T.StringType(), True),
    ("matched_id_product", T.LongType(), True),
    ("language", T.StringType(), True),
    ("condition", T.StringType(), True),
    ("acquisition_type", T.StringType(), True),
    ("purchase_price", MONEY, True),
    ("purchase_date", T.DateType(), True),
    ("is_sealed", T.BooleanType(), True),
    ("storage_location", T.StringType(), True),
    ("personal_note", T.StringType(), True),
    ("match_status", T.StringType(), False),
    ("match_confidence", CONFIDENCE, True),
    ("error_message", T.StringType(), True),
    ("created_at", T.TimestampType(), False),
    ("imported_at", T.TimestampType(), True),
)

WATCHLIST = _table(
    ("watchlist_item_id", T.StringType(), False),
    ("id_product", T.LongType(), False),
    ("reason", T.StringType(), True),
    ("target_price", MONEY, True),
    ("is_active", T.BooleanType(), False),
    ("created_at", T.TimestampType(), False),
    ("updated_at", T.TimestampType(), False),
)

SIGNAL_COLUMNS = [
    "signal_id", "signal_date", "id_product", "collection_item_id", "signal_type",
    "signal_value", "signal_strength", "lookback_days", "reference_value", "current_value",
    "signal_description", "created_at",
]

ANALYTICS_SIGNALS = _table(
    ("signal_id", T.StringType(), False),
    ("signal_date", T.DateType(), False),
    ("id_product", T.LongType(), True),
    ("collection_item_id", T.StringType(), True),
    ("signal_type", T.StringType(), False),
    ("signal_value", MONEY, True),
    ("signal_strength", T.StringType(), True),
    ("lookback_days", T.IntegerType(), True),
    ("reference_value", MONEY, True),
    ("current_value", MONEY, True),
    ("signal_description", T.StringType(), True),
    ("created_at", T.TimestampType(), False),
)

TABLES = {
    "products": PRODUCTS,
    "price_snapshots": PRICE_SNAPSHOTS,
    "expansions": EXPANSIONS,
    "tcg_sets": TCG_SETS,
    "expansion_set_mappings": SET_MAPPINGS,
    "collection_items": COLLECTION_ITEMS,
    "collection_import_staging": STAGING,
    "watchlist": WATCHLIST,
    "analytics_signals": ANALYTICS_SIGNALS,
}
