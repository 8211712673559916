"""New table state = merge(old state, batch).  Run times are arguments, never the clock."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradebinder.functions.dates import as_instant
from tradebinder.operators.keyed import keyed_upsert, newest_per_key
from tradebinder.operators.lookup import spread_join
from tradebinder.schemas import (
    CATALOG_VALUES,
    EXPANSION_VALUES,
    PRICE_KEYS,
    PRICE_VALUES,
    SET_COLUMNS,
)


def merge_price_snapshots(
    target: DataFrame, batch: DataFrame, run_ts, order: str = "record_index",
    values: list[str] | None = None,
) -> DataFrame:
    """Idempotent price upsert on (snapshot_date, id_product).  The last record of a batch
    wins, all price columns are overwritten, created_at of the first insert is kept.

    Only the dates in the batch change: give it a target restricted to these dates and
    write the result with sources.tables.write_partitions.
    """
    values = PRICE_VALUES if values is None else values
    stamped = batch.withColumn("created_at", as_instant(run_ts))
    state = keyed_upsert(target, stamped, PRICE_KEYS, order, values, first=["created_at"])
    return state.select(*PRICE_KEYS, *values, "created_at")


def merge_products(
    target: DataFrame, batch: DataFrame, run_ts, order: str = "record_index",
    deactivate_missing: bool = True,
) -> DataFrame:
    """Catalog upsert, deactivation of missing products and change flags in one pass.

    Seen products are refreshed, active and last seen now; first_seen_at never changes.
    With ``deactivate_missing`` every active product the batch lacks becomes inactive at
    once (an empty batch deactivates all); nothing is deleted.  ``catalog_change`` is one
    of inserted, updated, deactivated, unchanged.
    """
    now = as_instant(run_ts)
    life = ["is_active_in_catalog", "first_seen_at", "last_seen_at", "updated_at"]
    stamped = batch.select(
        "id_product", *CATALOG_VALUES, order,
        F.lit(True).alias("is_active_in_catalog"),
        now.alias("first_seen_at"), now.alias("last_seen_at"), now.alias("updated_at"),
    )
    state = keyed_upsert(
        target, stamped, ["id_product"], order,
        [*CATALOG_VALUES, *[c for c in life if c != "first_seen_at"]], first=["first_seen_at"],
    )
    dropped = ~F.col("in_batch") & F.col("is_active_in_catalog") & F.lit(deactivate_missing)
    change = (
        F.when(~F.col("in_target"), "inserted")
        .when(F.col("in_batch"), "updated")
        .when(dropped, "deactivated")
        .otherwise("unchanged")
    )
    return state.select(
        "id_product",
        *CATALOG_VALUES,
        (F.col("is_active_in_catalog") & ~dropped).alias("is_active_in_catalog"),
        "first_seen_at",
        "last_seen_at",
        F.when(dropped, now).otherwise(F.col("updated_at")).alias("updated_at"),
        change.alias("catalog_change"),
    )


def missing_products(target: DataFrame, seen: DataFrame) -> DataFrame:
    """Active products whose id is not among the seen ids."""
    return target.filter("is_active_in_catalog").join(
        seen.select("id_product"), "id_product", "left_anti"
    )


def new_product_ids(target: DataFrame, seen: DataFrame) -> DataFrame:
    """Seen rows whose id the target does not know; duplicates and record_index stay."""
    return seen.join(target.select("id_product"), "id_product", "left_anti")


def merge_sets(target: DataFrame, batch: DataFrame, run_ts, order: str = "record_index") -> DataFrame:
    """Set upsert: every column overwritten, is_active defaults to true."""
    now = as_instant(run_ts)
    stamped = batch.withColumns(
        {
            "is_active": F.coalesce("is_active", F.lit(True)),
            "created_at": now,
            "updated_at": now,
        }
    )
    state = keyed_upsert(
        target, stamped, ["tcg_set_id"], order, [*SET_COLUMNS[1:], "updated_at"], first=["created_at"]
    )
    return state.select(*SET_COLUMNS, "created_at", "updated_at")


def merge_expansions(target: DataFrame, batch: DataFrame, run_ts, order: str = "record_index") -> DataFrame:
    """Expansion upsert: every column overwritten, updated_at is the run time."""
    now = as_instant(run_ts)
    stamped = batch.withColumns({"created_at": now, "updated_at": now})
    state = keyed_upsert(
        target, stamped, ["id_expansion"], order, [*EXPANSION_VALUES, "updated_at"], first=["created_at"]
    )
    return state.select("id_expansion", *EXPANSION_VALUES, "created_at", "updated_at")


def combine_catalogs(singles: DataFrame, nonsingles: DataFrame) -> DataFrame:
    """Both catalog files as one batch.  Non-single rows come after all single rows, so an
    id in both keeps its non-single row."""
    offset = F.lit(1 << 40)
    return singles.unionByName(
        nonsingles.withColumn("record_index", F.col("record_index") + offset)
    )


def cross_file_duplicates(singles: DataFrame, nonsingles: DataFrame, order: str = "record_index") -> DataFrame:
    """Ids present in both catalog files.  conflicting = some field other than group and
    source file differs (null equals null).  Per file the last row of an id counts.

    One aggregate over both files: the newest row of each file is picked side by side.
    """
    compared = [c for c in CATALOG_VALUES if c not in ("product_group", "source_file")]
    sides = []
    for name, frame in (("single", singles), ("non_single", nonsingles)):
        rows = frame.select(
            "id_product", F.lit(name).alias("_side"), F.struct(*compared).alias("_row"),
            F.col(order).alias("_order"),
        )
        sides.append(rows)
    both = sides[0].unionByName(sides[1])

    def newest(side):
        return F.max_by("_row", F.when(F.col("_side") == side, F.col("_order")))

    return (
        both.groupBy("id_product")
        .agg(
            newest("single").alias("single_record"),
            newest("non_single").alias("non_single_record"),
            F.count_if(F.col("_side") == "single").alias("_singles"),
            F.count_if(F.col("_side") == "non_single").alias("_non_singles"),
        )
        .filter("_singles > 0 AND _non_singles > 0")
        .select(
            "id_product",
            (~F.col("single_record").eqNullSafe(F.col("non_single_record"))).alias("conflicting"),
            "single_record",
            "non_single_record",
        )
    )


def recheck_waiting(staging: DataFrame, products: DataFrame) -> DataFrame:
    """Waiting rows whose matched product exists by now become ready; others stay.

    One pass: the key is null unless a row waits, and rows without a key are spread like all
    others.
    """
    waits = F.col("match_status") == "waiting_for_product"
    keyed = staging.withColumn("_awaited", F.when(waits, F.col("matched_id_product")))
    known = products.select(F.col("id_product").alias("_awaited"), F.lit(True).alias("_known"))
    looked_up = spread_join(keyed, known, ["_awaited"], "left", ["import_row_id"])
    ready = F.col("_known").isNotNull()
    return looked_up.withColumns(
        {
            "match_status": F.when(ready, "ready_to_import").otherwise(F.col("match_status")),
            "error_message": F.when(~ready, F.col("error_message")),
        }
    ).select(*staging.columns)


def last_record_per_key(batch: DataFrame, keys: list[str], order: str = "record_index") -> DataFrame:
    """Last-writer-wins dedupe inside one batch."""
    return newest_per_key(batch, keys, order)


def replay_comparison(replayed: DataFrame, stored: DataFrame) -> DataFrame:
    """Rows per day from replayed files next to the rows stored for the day."""
    sides = replayed.select("snapshot_date", F.lit(1).alias("_replayed")).unionByName(
        stored.select("snapshot_date", F.lit(0).alias("_replayed"))
    )
    return (
        sides.groupBy("snapshot_date")
        .agg(
            F.count_if(F.col("_replayed") == 1).alias("replayed_rows"),
            F.count_if(F.col("_replayed") == 0).alias("stored_rows"),
        )
        .withColumn("equal", F.col("replayed_rows") == F.col("stored_rows"))
    )
