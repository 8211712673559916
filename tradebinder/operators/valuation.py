"""Collection valuation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradebinder.functions.money import percent_change
from tradebinder.operators.lookup import spread_join


def _with_product(items: DataFrame, table: DataFrame) -> DataFrame:
    return spread_join(items, table, ["id_product"], "left", ["collection_item_id"])


def valued_items(items: DataFrame, products: DataFrame, latest: DataFrame) -> DataFrame:
    """Unsold items with product data and the latest estimated value."""
    known = products.select("id_product", "name", "product_group", "id_expansion", "id_category")
    value = latest.select("id_product", "estimated_market_value")
    facts = items.filter(~F.col("is_sold"))
    return (
        _with_product(facts, known.join(value, "id_product", "full_outer"))
        .withColumn("estimated_gain_loss", F.col("estimated_market_value") - F.col("purchase_price"))
    )


def collection_current_value(items: DataFrame, products: DataFrame, latest: DataFrame) -> DataFrame:
    """Current value of every unsold item; the gain is null while the purchase price is
    unknown, its percentage also when the price is zero."""
    return valued_items(items, products, latest).select(
        "collection_item_id",
        "id_product",
        "name",
        "product_group",
        "language",
        "condition",
        "purchase_price",
        "estimated_market_value",
        "estimated_gain_loss",
        percent_change(F.col("estimated_market_value"), F.col("purchase_price")).alias(
            "estimated_gain_loss_percent"
        ),
        "storage_location",
    )


def collection_summary(items: DataFrame, products: DataFrame, latest: DataFrame) -> DataFrame:
    """One row of totals over unsold items, the number of sold ones, and the most valuable
    item (ties: earliest purchase, then lowest id; an unknown date counts as latest)."""
    group_and_value = products.select("id_product", "product_group").join(
        latest.select("id_product", "estimated_market_value"), "id_product", "full_outer"
    )
    rows = _with_product(items, group_and_value)
    unsold = ~F.col("is_sold")
    value = F.when(unsold, F.col("estimated_market_value"))
    rank = F.struct(
        (-F.col("estimated_market_value")).alias("value"),
        F.coalesce("purchase_date", F.lit("9999-12-31").cast("date")).alias("bought"),
        F.col("collection_item_id").alias("id"),
    )
    ranked = F.when(unsold & F.col("estimated_market_value").isNotNull(), rank)
    item = F.struct(
        "collection_item_id", "id_product", "language", "condition", "purchase_price",
        "purchase_date", "estimated_market_value",
    )
    return rows.agg(
        F.count_if(unsold).alias("active_items"),
        F.count_if(F.col("is_sold")).alias("sold_items"),
        F.count_if(unsold & (F.col("product_group") == "single")).alias("single_items"),
        F.count_if(unsold & F.col("is_sealed")).alias("sealed_items"),
        F.sum(F.when(unsold, F.col("purchase_price"))).alias("total_purchase_price"),
        F.sum(value).alias("total_estimated_market_value"),
        F.sum(value - F.col("purchase_price")).alias("total_estimated_gain_loss"),
        F.avg(value).alias("average_item_value"),
        F.min_by(item, ranked).alias("most_valuable_item"),
    )


def value_by(items: DataFrame, products: DataFrame, latest: DataFrame, column: str) -> DataFrame:
    """Value and unrealized gain of unsold items per product_group, id_expansion or
    id_category.  The gain counts items with a known purchase price only."""
    return (
        valued_items(items, products, latest)
        .groupBy(column)
        .agg(
            F.count("*").alias("items"),
            F.sum("estimated_market_value").alias("estimated_market_value"),
            F.sum("estimated_gain_loss").alias("unrealized_gain_loss"),
        )
    )


def unrealized_gain_loss(items: DataFrame, products: DataFrame, latest: DataFrame) -> DataFrame:
    """Total gain or loss over unsold items that have both a purchase price and a value."""
    priced = valued_items(items, products, latest).filter(F.col("estimated_gain_loss").isNotNull())
    return priced.agg(
        F.count("*").alias("items"),
        F.sum("purchase_price").alias("purchase_price"),
        F.sum("estimated_market_value").alias("estimated_market_value"),
        F.sum("estimated_gain_loss").alias("unrealized_gain_loss"),
    )
