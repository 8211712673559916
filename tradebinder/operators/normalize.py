"""Raw records to table rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradebinder.functions.dates import (
    as_date,
    as_instant,
    slash_date,
    slash_timestamp,
    source_created_at,
)
from tradebinder.functions.money import to_money
from tradebinder.functions.text import (
    blank_to_null,
    first_present,
    id_number,
    optional_int,
    parse_bool,
    strip,
)
from tradebinder.schemas import HOLO_PRICES, PLAIN_PRICES, SET_COLUMNS, SOURCE_FILES

# Record fields of the two source formats and the text of the set note.
PRICE_ID = "idProduct"
PRICE_CATEGORY = "idCategory"
CATALOG_FIELDS = {
    "id_category": "idCategory",
    "id_expansion": "idExpansion",
    "id_metacard": "idMetacard",
}
EXPANSION_ID_NAMES = ["idExpansion", "id_expansion", "expansionId", "Expansion ID"]
PRODUCT_ID_NAMES = ["idProduct", "id_product", "productId", "Product ID"]
PRODUCT_NAME_NAMES = ["name", "Name", "productName", "product_name"]
SET_ANOMALY_NOTE = (
    "Source has total_cards lower than printed_total; secret_card_count was normalized to 0."
)


def _carried(records: DataFrame) -> list[str]:
    """Columns of a record that survive normalization: its place and its judgement."""
    return [c for c in ("file_name", "record_index", "reasons", "raw") if c in records.columns]


def normalize_prices(records: DataFrame, snapshot_date, created_at=None) -> DataFrame:
    """Price records (record map, created_at_text, record_index) to snapshot rows.

    ``snapshot_date`` is a date or a column (for many days in one scan); ``created_at``
    overrides the creation time written in the file.  Absent and malformed prices are
    null, zero stays zero.
    """
    record = F.col("record")
    created = source_created_at(F.col("created_at_text"))
    if created_at is not None:
        created = F.coalesce(as_instant(created_at), created)
    return records.select(
        *_carried(records),
        as_date(snapshot_date).alias("snapshot_date"),
        created.alias("source_created_at"),
        id_number(record[PRICE_ID]).alias("id_product"),
        id_number(record[PRICE_CATEGORY]).alias("id_category"),
        *[to_money(record[name]).alias(name) for name in PLAIN_PRICES],
        *[to_money(record[name.replace("_", "-")]).alias(name) for name in HOLO_PRICES],
    )


def date_added(text: Column) -> Column:
    """Catalog date text as an instant; unreadable text is null."""
    return F.nullif(text, F.lit("")).try_cast("timestamp")


def normalize_catalog(records: DataFrame, source_file: str) -> DataFrame:
    """Catalog records to product rows, with the group that belongs to the file."""
    if source_file not in SOURCE_FILES:
        raise ValueError(f"unknown source file {source_file!r}")
    record = F.col("record")
    numbers = [id_number(record[field]).alias(name) for name, field in CATALOG_FIELDS.items()]
    return records.select(
        *_carried(records),
        id_number(record["idProduct"]).alias("id_product"),
        record["name"].alias("name"),
        record["categoryName"].alias("category_name"),
        *numbers,
        date_added(record["dateAdded"]).alias("date_added"),
        F.lit(SOURCE_FILES[source_file]).alias("product_group"),
        F.lit(source_file).alias("source_file"),
    )


def lenient_products(records: DataFrame) -> DataFrame:
    """(file_name, record_index, id_expansion, id_product, name) from catalog records whose
    field names vary; ids that are no whole number give null."""
    record = F.col("record")
    return records.select(
        "file_name",
        "record_index",
        id_number(first_present(record, EXPANSION_ID_NAMES)).alias("id_expansion"),
        first_present(record, PRODUCT_ID_NAMES).alias("id_product"),
        first_present(record, PRODUCT_NAME_NAMES).alias("name"),
    )


def secret_card_count(printed_total: Column, total_cards: Column) -> Column:
    """Cards beyond the printed total, never negative; null when a total is unknown."""
    surplus = total_cards - printed_total
    return F.when(surplus.isNotNull(), F.greatest(surplus, F.lit(0)))


def signed_secret_card_count(printed_total: Column, total_cards: Column) -> Column:
    return total_cards - printed_total


def set_note(printed_total: Column, total_cards: Column) -> Column:
    return F.when(total_cards < printed_total, SET_ANOMALY_NOTE).otherwise("")


def normalize_sets(raw: DataFrame) -> DataFrame:
    """Set records to the column order of the set file."""
    printed, total = F.col("printedTotal"), F.col("total")
    no_legalities = F.create_map().cast("map<string,string>")
    return raw.select(
        F.col("id").alias("tcg_set_id"),
        F.col("name").alias("name_en"),
        F.col("series").alias("series_en"),
        F.col("ptcgoCode").alias("ptcgo_code"),
        slash_date(F.col("releaseDate")).alias("release_date"),
        printed.alias("printed_total"),
        total.alias("total_cards"),
        secret_card_count(printed, total).alias("secret_card_count"),
        F.to_json(F.coalesce("legalities", no_legalities)).alias("legalities"),
        F.col("images.symbol").alias("symbol_url"),
        F.col("images.logo").alias("logo_url"),
        slash_timestamp(F.col("updatedAt")).alias("source_updated_at"),
        F.lit(True).alias("is_active"),
        set_note(printed, total).alias("notes"),
    ).select(*SET_COLUMNS)


def normalize_expansions(raw: DataFrame) -> DataFrame:
    """Curated expansion file (text columns) to typed rows; a missing optional column
    counts as empty.  An id or a card count that is no whole number raises."""

    def text(name: str) -> Column:
        return blank_to_null(F.col(name)) if name in raw.columns else F.lit(None).cast("string")

    keep = [c for c in ("record_index", "line_number") if c in raw.columns]
    count = optional_int(F.col("card_count")) if "card_count" in raw.columns else F.lit(None).cast("int")
    active = parse_bool(F.col("is_active")) if "is_active" in raw.columns else F.lit(True)
    return raw.select(
        *keep,
        strip(F.col("id_expansion")).cast("bigint").alias("id_expansion"),
        strip(F.col("name_en")).alias("name_en"),
        text("name_de").alias("name_de"),
        text("slug").alias("slug"),
        text("series_en").alias("series_en"),
        text("series_de").alias("series_de"),
        text("release_date").cast("date").alias("release_date"),
        count.alias("card_count"),
        text("source_url_en").alias("source_url_en"),
        text("source_url_de").alias("source_url_de"),
        active.alias("is_active"),
        text("notes").alias("notes"),
    )
