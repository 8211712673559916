"""Constraints of all stored tables in one report."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradebinder.operators import constraints as C
from tradebinder.operators.checks import collection_issues
from tradebinder.schemas import TABLES
from tradebinder.session import configure
from tradebinder.sources.tables import read_table

KEYS = {
    "products": ["id_product"],
    "price_snapshots": ["snapshot_date", "id_product"],
    "expansions": ["id_expansion"],
    "tcg_sets": ["tcg_set_id"],
    "expansion_set_mappings": ["id_expansion", "tcg_set_id"],
    "collection_items": ["collection_item_id"],
    "collection_import_staging": ["import_row_id"],
    "watchlist": ["watchlist_item_id"],
    "analytics_signals": ["signal_id"],
}
RULES = {
    "products": C.product_rules,
    "expansions": C.expansion_rules,
    "tcg_sets": C.set_rules,
    "expansion_set_mappings": C.mapping_rules,
    "collection_items": C.item_rules,
    "collection_import_staging": C.staging_rules,
    "analytics_signals": C.signal_rules,
}
# (child, column, parent, parent key)
REFERENCES = [
    ("collection_items", "id_product", "products", "id_product"),
    ("watchlist", "id_product", "products", "id_product"),
    ("analytics_signals", "id_product", "products", "id_product"),
    ("analytics_signals", "collection_item_id", "collection_items", "collection_item_id"),
    ("expansion_set_mappings", "id_expansion", "expansions", "id_expansion"),
    ("expansion_set_mappings", "tcg_set_id", "tcg_sets", "tcg_set_id"),
]


def constraint_report(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, constraint_name, key, value) of every broken constraint: filled columns,
    row rules, unique keys, conditional uniqueness and references."""
    parts = []

    def add(table: str, found: DataFrame) -> None:
        parts.append(found.select(F.lit(table).alias("table_name"), "*"))

    for table, frame in tables.items():
        key = KEYS[table][-1]
        add(table, C.null_violations(frame, table, key))
        add(table, C.unique_violations(frame, f"{table}.key", KEYS[table]))
        if table in RULES:
            add(table, C.rule_violations(frame, key, RULES[table]()))
    add("watchlist", C.active_watch_violations(tables["watchlist"]))
    add("expansion_set_mappings", C.primary_mapping_violations(tables["expansion_set_mappings"]))
    for child, column, parent, parent_key in REFERENCES:
        found = C.foreign_key_violations(
            tables[child], f"{child}.{column}_exists", KEYS[child][-1], column, tables[parent], parent_key
        )
        add(child, found)
    return functools.reduce(DataFrame.unionByName, parts)


def stored_constraint_report(spark: SparkSession, root: str) -> DataFrame:
    configure(spark)
    return constraint_report({name: read_table(spark, root, name) for name in TABLES})


def stored_collection_issues(spark: SparkSession, root: str, as_of) -> DataFrame:
    """The informational check of the collection, to be run after imports."""
    return collection_issues(read_table(configure(spark), root, "collection_items"), as_of)
