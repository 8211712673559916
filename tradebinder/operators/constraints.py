"""Table constraints as data checks: (constraint_name, key, value) rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradebinder import schemas as S
from tradebinder.operators.lookup import spread_join


def _rows(df: DataFrame, name: str | Column, key: Column, value: Column) -> DataFrame:
    label = F.lit(name) if isinstance(name, str) else name
    return df.select(
        label.alias("constraint_name"),
        key.cast("string").alias("key"),
        value.cast("string").alias("value"),
    )


def rule_violations(df: DataFrame, key: str, rules: list[tuple[str, Column, str]]) -> DataFrame:
    """One scan over the table for any number of row rules (name, broken, shown column)."""
    found = F.array(
        *[
            F.when(
                broken,
                F.struct(F.lit(name).alias("name"), F.col(shown).cast("string").alias("value")),
            )
            for name, broken, shown in rules
        ]
    )
    exploded = df.select(
        F.col(key).alias("key"), F.explode(F.filter(found, lambda r: r.isNotNull())).alias("rule")
    )
    return _rows(exploded, F.col("rule.name"), F.col("key"), F.col("rule.value"))


def unique_violations(df: DataFrame, name: str, keys: list[str], condition: Column | None = None) -> DataFrame:
    """Keys that occur more than once, among the rows the condition selects."""
    rows = df if condition is None else df.filter(condition)
    twice = rows.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")
    return _rows(twice, name, F.concat_ws("~", *[F.col(k).cast("string") for k in keys]), F.col("n"))


def foreign_key_violations(
    child: DataFrame, name: str, key: str, column: str, parent: DataFrame, parent_key: str
) -> DataFrame:
    """Child rows whose non-null reference does not exist in the parent."""
    rows = child.filter(F.col(column).isNotNull()).select(key, column)
    known = parent.select(F.col(parent_key).alias(column))
    orphans = spread_join(rows, known, [column], "left_anti", [key])
    return _rows(orphans, name, F.col(key), F.col(column))


def _outside(column: str, allowed: list[str]) -> Column:
    return ~F.col(column).isin(allowed)


def product_rules() -> list[tuple[str, Column, str]]:
    return [
        ("products.name", F.col("name").isNull(), "name"),
        ("products.product_group", _outside("product_group", S.PRODUCT_GROUPS), "product_group"),
        ("products.source_file", _outside("source_file", list(S.SOURCE_FILES)), "source_file"),
    ]


def item_rules() -> list[tuple[str, Column, str]]:
    return [
        ("items.id_product", F.col("id_product").isNull(), "id_product"),
        ("items.acquisition_type", _outside("acquisition_type", S.ACQUISITION_TYPES), "acquisition_type"),
    ]


def staging_rules() -> list[tuple[str, Column, str]]:
    confidence = F.col("match_confidence")
    return [
        ("staging.match_status", _outside("match_status", S.MATCH_STATUSES), "match_status"),
        ("staging.match_confidence", (confidence < 0) | (confidence > 1), "match_confidence"),
    ]


def signal_rules() -> list[tuple[str, Column, str]]:
    per_item = F.col("signal_type").isin("collection_gain", "collection_loss")
    return [
        ("signals.signal_type", _outside("signal_type", S.SIGNAL_TYPES), "signal_type"),
        ("signals.signal_strength", _outside("signal_strength", S.SIGNAL_STRENGTHS), "signal_strength"),
        ("signals.collection_item", per_item & F.col("collection_item_id").isNull(), "signal_type"),
    ]


def expansion_rules() -> list[tuple[str, Column, str]]:
    early = F.col("release_date") < F.lit(S.EARLIEST_RELEASE).cast("date")
    return [
        ("expansions.name_en", F.col("name_en").isNull(), "name_en"),
        ("expansions.card_count", F.col("card_count") < 0, "card_count"),
        ("expansions.release_date", early, "release_date"),
    ]


def set_rules() -> list[tuple[str, Column, str]]:
    return [
        ("sets.printed_total", F.col("printed_total") < 0, "printed_total"),
        ("sets.total_cards", F.col("total_cards") < 0, "total_cards"),
        ("sets.secret_card_count", F.col("secret_card_count") < 0, "secret_card_count"),
    ]


def mapping_rules() -> list[tuple[str, Column, str]]:
    confidence = F.col("match_confidence")
    return [
        ("mappings.match_status", _outside("match_status", S.MAPPING_STATUSES), "match_status"),
        ("mappings.match_method", _outside("match_method", S.MAPPING_METHODS), "match_method"),
        ("mappings.match_confidence", (confidence < 0) | (confidence > 1), "match_confidence"),
    ]


def primary_mapping_violations(mappings: DataFrame) -> DataFrame:
    """At most one primary mapping per expansion."""
    return unique_violations(mappings, "mappings.primary", ["id_expansion"], F.col("is_primary_mapping"))


def active_watch_violations(watchlist: DataFrame) -> DataFrame:
    """At most one active watchlist row per product."""
    return unique_violations(watchlist, "watchlist.active", ["id_product"], F.col("is_active"))


def null_violations(df: DataFrame, table: str, key: str) -> DataFrame:
    """Nulls in the columns the stored schema declares as filled."""
    required = [f.name for f in S.TABLES[table].fields if not f.nullable and f.name in df.columns]
    return rule_violations(df, key, [(f"{table}.{c}", F.col(c).isNull(), c) for c in required])
