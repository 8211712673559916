"""Business views.  Plain and lazy: each is a function of the tables it reads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradebinder.functions.dates import as_date, months_since
from tradebinder.functions.money import estimated_market_value, percent_change
from tradebinder.operators.keyed import newest_per_key
from tradebinder.operators.lookup import by_shuffle, spread_join
from tradebinder.schemas import TRUSTED_CONFIDENCE


def latest_prices(prices: DataFrame, products: DataFrame) -> DataFrame:
    """Latest price row per product with its estimated value and catalog flag.

    The newest row is an aggregate combined before the shuffle, not a sorted window.
    """
    newest = newest_per_key(
        prices.select("id_product", "snapshot_date", "trend", "avg30", "low"),
        ["id_product"], "snapshot_date", ["snapshot_date", "trend", "avg30", "low"],
    )
    return newest.join(products.select("id_product", "is_active_in_catalog"), "id_product", "left").select(
        "id_product",
        "snapshot_date",
        "trend",
        "avg30",
        "low",
        estimated_market_value(F.col("trend"), F.col("avg30")).alias("estimated_market_value"),
        "is_active_in_catalog",
    )


def product_price_history(prices: DataFrame, products: DataFrame) -> DataFrame:
    """Every price row with product name and group.  Rows of inactive products and of ids
    the catalog does not know stay visible."""
    facts = prices.select("id_product", "snapshot_date", "trend", "avg30")
    names = products.select("id_product", "name", "product_group", "is_active_in_catalog")
    return facts.join(names, "id_product", "left").select(
        "id_product",
        "name",
        "product_group",
        "snapshot_date",
        "trend",
        "avg30",
        estimated_market_value(F.col("trend"), F.col("avg30")).alias("estimated_market_value"),
        "is_active_in_catalog",
    )


def products_enriched(products: DataFrame, expansions: DataFrame) -> DataFrame:
    """Products with the metadata of their expansion."""
    expansion = expansions.select(
        "id_expansion",
        F.col("name_en").alias("expansion_name_en"),
        F.col("name_de").alias("expansion_name_de"),
        F.col("slug").alias("expansion_slug"),
        "series_en",
        "series_de",
        F.col("release_date").alias("expansion_release_date"),
        F.col("card_count").alias("expansion_card_count"),
    )
    return spread_join(products, expansion, ["id_expansion"], "left", ["id_product"]).select(
        "id_product",
        F.col("name").alias("product_name"),
        "id_expansion",
        "expansion_name_en",
        "expansion_name_de",
        "expansion_slug",
        "series_en",
        "series_de",
        "expansion_release_date",
        "expansion_card_count",
        "id_category",
        "date_added",
        "is_active_in_catalog",
        "updated_at",
    )


def products_without_prices(products: DataFrame, prices: DataFrame, date) -> DataFrame:
    """Active products with no price row on the date, or one without trend and avg30.

    Only rows with a usable price are joined against, which turns the rule into one anti
    join and prunes the prices to a single partition.
    """
    usable = prices.filter(
        (F.col("snapshot_date") == as_date(date))
        & (F.col("trend").isNotNull() | F.col("avg30").isNotNull())
    )
    return (
        products.filter("is_active_in_catalog")
        .join(usable.select("id_product"), "id_product", "left_anti")
        .select("id_product", "name", "product_group", "category_name", "last_seen_at")
    )


def products_without_prices_now(products: DataFrame, prices: DataFrame) -> DataFrame:
    """The same for the latest snapshot date there is."""
    latest = prices.select(F.max("snapshot_date")).scalar()
    return products_without_prices(products, prices, latest)


def trusted_mappings(mappings: DataFrame, expansions: DataFrame, sets: DataFrame) -> DataFrame:
    """Expansion to set mappings fit for reports: matched, confident, primary, reviewed
    and of an active expansion."""
    good = mappings.filter(
        (F.col("match_status") == "matched")
        & (F.col("match_confidence") >= TRUSTED_CONFIDENCE)
        & F.col("is_primary_mapping")
        & ~F.col("needs_review")
    )
    market = expansions.filter("is_active").select(
        "id_expansion",
        F.col("name_en").alias("market_name_en"),
        F.col("name_de").alias("market_name_de"),
        F.col("slug").alias("market_slug"),
        F.col("series_en").alias("market_series_en"),
        F.col("series_de").alias("market_series_de"),
        F.col("release_date").alias("market_release_date"),
        F.col("card_count").alias("market_card_count"),
    )
    official = sets.select(
        "tcg_set_id",
        F.col("name_en").alias("tcg_name"),
        F.col("series_en").alias("tcg_series"),
        "ptcgo_code",
        F.col("release_date").alias("tcg_release_date"),
        "printed_total",
        "total_cards",
        "secret_card_count",
        "symbol_url",
        "logo_url",
    )
    return (
        good.join(by_shuffle(market), "id_expansion")
        .join(by_shuffle(official), "tcg_set_id")
        .select(
            *market.columns,
            *official.columns,
            "match_status",
            "match_method",
            "match_confidence",
            "is_primary_mapping",
            "needs_review",
        )
    )


def review_columns(expansions: DataFrame, sets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What the review list shows of an expansion and of a set."""
    market = expansions.select(
        "id_expansion",
        F.col("name_en").alias("market_name_en"),
        F.col("name_de").alias("market_name_de"),
        F.col("slug").alias("market_slug"),
        F.col("series_en").alias("market_series_en"),
        F.col("release_date").alias("market_release_date"),
    )
    official = sets.select(
        "tcg_set_id",
        F.col("name_en").alias("tcg_name"),
        F.col("series_en").alias("tcg_series"),
        F.col("release_date").alias("tcg_release_date"),
    )
    return market, official


def mappings_for_review(mappings: DataFrame, expansions: DataFrame, sets: DataFrame) -> DataFrame:
    """Mappings a person should look at.  Mappings that carry the review columns of both sides
    as lists (market, official) are not joined to them again."""
    doubtful = mappings.filter(
        F.col("needs_review")
        | (F.col("match_status") == "manual_review")
        | (F.col("match_confidence") < TRUSTED_CONFIDENCE)
        | F.col("match_confidence").isNull()
    )
    market, official = review_columns(expansions, sets)
    for rows, key, name in ((market, "id_expansion", "market"), (official, "tcg_set_id", "official")):
        if name in doubtful.columns:
            doubtful = doubtful.select("*", F.inline_outer(name)).drop(name)
        else:
            doubtful = doubtful.join(by_shuffle(rows), key, "left")
    return doubtful.select(
        *market.columns,
        *official.columns,
        "match_status",
        "match_method",
        "match_confidence",
        "is_primary_mapping",
        "needs_review",
        "notes",
    )


def price_report_chain(
    prices: DataFrame, products: DataFrame, expansions: DataFrame, mappings: DataFrame,
    sets: DataFrame, as_of,
) -> DataFrame:
    """Price rows with product, expansion and official set (primary mapping) attached.

    The dimensions are joined among themselves first, from the smallest up, so the large
    price side goes through a single join.
    """
    expansion = expansions.select(
        "id_expansion", F.col("name_en").alias("expansion_name_en"),
        F.col("release_date").alias("_market_release"),
    )
    primary = mappings.filter("is_primary_mapping").select(
        "id_expansion", "tcg_set_id", F.col("match_confidence").alias("mapping_confidence")
    )
    official = sets.select(
        "tcg_set_id",
        F.col("name_en").alias("official_set_name"),
        F.col("series_en").alias("series"),
        F.col("release_date").alias("_official_release"),
        "printed_total", "total_cards", "secret_card_count", "logo_url", "symbol_url",
    )
    era = (
        expansion.join(primary, "id_expansion", "left")
        .join(official, "tcg_set_id", "left")
        .withColumn("release_date", F.coalesce("_official_release", "_market_release"))
        .withColumn("months_since_release", months_since(F.col("release_date"), as_date(as_of)))
        .drop("_official_release", "_market_release")
    )
    named = products.select(
        "id_product", F.col("name").alias("product_name"), "product_group", "id_expansion"
    )
    product = spread_join(named, era, ["id_expansion"], "left", ["id_product"])
    facts = prices.select("id_product", "snapshot_date", "trend", "avg30")
    return facts.join(product, "id_product", "left").select(
        "snapshot_date", "id_product", "product_name", "product_group", "trend", "avg30",
        estimated_market_value(F.col("trend"), F.col("avg30")).alias("estimated_market_value"),
        "id_expansion", "expansion_name_en", "tcg_set_id", "official_set_name", "series",
        "release_date", "months_since_release", "printed_total", "total_cards",
        "secret_card_count", "logo_url", "symbol_url", "mapping_confidence",
    )


def top_movers(latest: DataFrame, k: int) -> DataFrame:
    """The k products whose trend moved most above their 30-day average."""
    move = percent_change(F.col("trend"), F.col("avg30"))
    return (
        latest.select("id_product", "snapshot_date", "trend", "avg30", move.alias("move_percent"))
        .filter(F.col("move_percent").isNotNull())
        .orderBy(F.desc("move_percent"), F.asc("id_product"))
        .limit(k)
    )


def watchlist_overview(watchlist: DataFrame, latest: DataFrame, products: DataFrame) -> DataFrame:
    """Active watchlist rows with the latest price of the product and the target price."""
    value = latest.select(
        "id_product", "snapshot_date", "trend", "avg30", "estimated_market_value", "is_active_in_catalog"
    )
    return (
        watchlist.filter("is_active")
        .select("watchlist_item_id", "id_product", "reason", "target_price")
        .join(value, "id_product", "left")
        .join(products.select("id_product", "name", "product_group"), "id_product", "left")
        .select(
            "watchlist_item_id", "id_product", "name", "product_group", "reason", "target_price",
            "snapshot_date", "trend", "avg30", "estimated_market_value", "is_active_in_catalog",
        )
    )
