"""Signals of a day and exports of the views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradebinder.functions.dates import as_date
from tradebinder.operators import signals, valuation, views
from tradebinder.schemas import ANALYTICS_SIGNALS, TABLES
from tradebinder.session import configure, ensure_checkpoint_dir
from tradebinder.sources.csv_files import write_csv
from tradebinder.sources.tables import clear_partition, read_table, write_partitions


def record_signals(spark: SparkSession, root: str, as_of, run_ts) -> None:
    """Compute all signals of a date and replace that date's partition, so a rerun of the
    date neither adds rows nor leaves any that no longer hold.  The price history is read once: its points, one row per
    product, are checkpointed and feed product and item signals."""
    configure(spark)
    ensure_checkpoint_dir(spark)
    prices = read_table(spark, root, "price_snapshots").filter(F.col("snapshot_date") <= as_date(as_of))
    points = signals.price_points(prices, as_of).checkpoint()
    products = read_table(spark, root, "products")
    items = read_table(spark, root, "collection_items")
    newest = points.agg(F.max("latest_date")).first()[0]
    found = signals.all_signals(
        points, products, items, as_of, run_ts, latest_snapshot=F.lit(newest).cast("date")
    )
    typed = found.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in ANALYTICS_SIGNALS.fields]
    )
    typed = typed.checkpoint()
    if typed.isEmpty():
        clear_partition(spark, root, "analytics_signals", spark.range(1).select(as_date(as_of).cast("string")).first()[0])
    else:
        write_partitions(typed, root, "analytics_signals")


def stored_views(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """All business views over the stored tables, lazily, by name."""
    configure(spark)
    prices, products, items, expansions, sets, mappings, watchlist, found = (
        read_table(spark, root, name)
        for name in (
            "price_snapshots", "products", "collection_items", "expansions", "tcg_sets",
            "expansion_set_mappings", "watchlist", "analytics_signals",
        )
    )
    latest = views.latest_prices(prices, products)
    result = {
        "vw_latest_prices": latest,
        "vw_product_price_history": views.product_price_history(prices, products),
        "vw_products_without_prices": views.products_without_prices_now(products, prices),
        "vw_products_enriched": views.products_enriched(products, expansions),
        "vw_collection_current_value": valuation.collection_current_value(items, products, latest),
        "vw_collection_summary": valuation.collection_summary(items, products, latest),
        "vw_trusted_expansion_set_mappings": views.trusted_mappings(mappings, expansions, sets),
        "vw_expansion_set_mappings_for_review": views.mappings_for_review(mappings, expansions, sets),
        "vw_watchlist_overview": views.watchlist_overview(watchlist, latest, products),
    }
    for name, kind in signals.SIGNAL_VIEWS.items():
        result[f"vw_{name}"] = signals.signal_view(found, products, kind)
    return result


def register_views(spark: SparkSession, root: str) -> None:
    """Make the stored tables and the views available to spark.sql."""
    for name in TABLES:
        read_table(spark, root, name).createOrReplaceTempView(name)
    for name, frame in stored_views(spark, root).items():
        frame.createOrReplaceTempView(name)


def export_view(spark: SparkSession, root: str, name: str, path: str) -> None:
    """One view as CSV; nested columns become JSON text."""
    frame = stored_views(spark, root)[name]
    flat = [
        F.to_json(f.name).alias(f.name) if f.dataType.typeName() in ("struct", "array", "map") else F.col(f.name)
        for f in frame.schema.fields
    ]
    write_csv(frame.select(*flat), path)
