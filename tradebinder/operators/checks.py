"""Data-quality checks of the daily load and of the collection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradebinder.functions.dates import as_date
from tradebinder.functions.money import usable_price
from tradebinder.functions.text import is_blank
from tradebinder.operators.lookup import spread_join
from tradebinder.schemas import DRIFT_PERCENT

# Check names and severities in report order.
DAILY_CHECKS = [
    ("empty_price_snapshot", "failure"),
    ("missing_products", "warning"),
    ("products_without_prices", "warning"),
    ("category_mismatch", "warning"),
    ("record_count_drift", "warning"),
]
# Issue texts of the collection check.
ISSUE_GRADED = "graded item missing grading_company or grade"
ISSUE_SOLD = "sold item missing sold_price or sold_date"
ISSUE_UNSOLD = "sold_price/sold_date populated while is_sold = false"
ISSUE_PURCHASE_PRICE = "negative purchase_price"
ISSUE_SOLD_PRICE = "negative sold_price"
ISSUE_PURCHASE_DATE = "purchase_date in the future"
ISSUE_SOLD_DATE = "sold_date in the future"


def _on(prices: DataFrame, date) -> DataFrame:
    return prices.filter(F.col("snapshot_date") == as_date(date))


def missing_products_check(prices: DataFrame, products: DataFrame, date) -> DataFrame:
    """Price rows of the date whose product the catalog lacks."""
    rows = _on(prices, date).select("id_product", "snapshot_date")
    return rows.join(products.select("id_product"), "id_product", "left_anti")


def category_mismatch(prices: DataFrame, products: DataFrame, date) -> DataFrame:
    """Rows whose category is known on both sides and differs."""
    rows = _on(prices, date).select(
        "id_product", "snapshot_date", F.col("id_category").alias("price_category")
    )
    catalog = products.select("id_product", F.col("id_category").alias("product_category"))
    return rows.join(catalog, "id_product").filter("price_category <> product_category").select(
        "id_product", "snapshot_date", "price_category", "product_category"
    )


def duplicate_snapshots(prices: DataFrame) -> DataFrame:
    """Keys that occur more than once."""
    return (
        prices.groupBy("snapshot_date", "id_product")
        .agg(F.count("*").alias("duplicate_count"))
        .filter("duplicate_count > 1")
    )


def empty_snapshot_check(prices: DataFrame, date) -> DataFrame:
    """One row with count 0 when the date has no rows, otherwise nothing."""
    return (
        _on(prices, date)
        .agg(F.count("*").alias("row_count"))
        .filter("row_count = 0")
        .select(as_date(date).alias("snapshot_date"), "row_count")
    )


def _drift(current: Column, previous: Column) -> Column:
    """Percent difference; null without a previous count."""
    return F.abs(current - previous) / F.nullif(previous, F.lit(0)) * F.lit(100.0)


def previous_row_count(prices: DataFrame, date, previous_date=None) -> Column:
    """Rows of the most recent earlier date (0 without one), as a scalar subquery.  Pass
    previous_date when it is known, then only that partition is opened."""
    if previous_date is None:
        previous_date = (
            prices.filter(F.col("snapshot_date") < as_date(date)).select(F.max("snapshot_date")).scalar()
        )
    return _on(prices, previous_date).select(F.count("*")).scalar()


def record_count_drift(
    prices: DataFrame, date, threshold: float = DRIFT_PERCENT, previous_date=None
) -> DataFrame:
    """One row when the date's row count is off by more than the threshold."""
    counts = _on(prices, date).agg(F.count("*").alias("current_count")).withColumn(
        "previous_count", previous_row_count(prices, date, previous_date)
    )
    percent = _drift(F.col("current_count"), F.col("previous_count"))
    return counts.withColumn("percent", percent).filter(F.col("percent") > threshold).select(
        as_date(date).alias("snapshot_date"),
        "previous_count",
        "current_count",
        F.round("percent", 2).alias("percent"),
    )


def record_count_series(prices: DataFrame, threshold: float = DRIFT_PERCENT) -> DataFrame:
    """Row count, previous count and drift of every date.

    Counting is distributed; the window sees one row per calendar day.
    """
    days = prices.groupBy("snapshot_date").agg(F.count("*").alias("current_count"))
    earlier = F.lag("current_count").over(Window.orderBy("snapshot_date"))
    percent = _drift(F.col("current_count"), F.col("previous_count"))
    return days.withColumn("previous_count", earlier).select(
        "snapshot_date",
        "previous_count",
        "current_count",
        F.round(percent, 2).alias("percent"),
        F.coalesce(percent > threshold, F.lit(False)).alias("drifted"),
    )


def daily_counts(prices: DataFrame, products: DataFrame, date, previous_date=None) -> DataFrame:
    """All counts of the daily report in one row.

    A single full outer join of one day's prices with the catalog feeds every check, instead
    of one scan and join per check.  The day is first counted per id, on the join's own
    partitioning, so that repeated ids and rows without an id are counted and not multiplied.
    """
    day = _on(prices, date).select(
        "id_product", F.col("id_category").alias("price_category"),
        usable_price(F.col("trend"), F.col("avg30")).alias("usable"),
    )
    day = day.groupBy("id_product").agg(
        F.max("price_category").alias("price_category"), F.max("usable").alias("usable"),
        F.count_if(F.coalesce("usable", F.lit(False))).alias("usable_rows"), F.count("*").alias("rows"),
    ).withColumn("has_price", F.lit(True))
    catalog = products.select(
        "id_product", F.col("id_category").alias("product_category"), "is_active_in_catalog",
        F.lit(True).alias("has_product"),
    )
    both = day.join(catalog, "id_product", "full_outer")
    has_price = F.col("has_price").isNotNull()
    has_product = F.col("has_product").isNotNull()
    usable = F.coalesce("usable", F.lit(False))
    return both.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows_loaded"),
        F.count_if(has_price & F.col("id_product").isNotNull() & ~has_product).alias("missing_products"),
        F.count_if(F.col("is_active_in_catalog") & ~usable).alias("products_without_prices"),
        F.count_if(F.col("price_category") != F.col("product_category")).alias("category_mismatch"),
        F.coalesce(F.sum(F.col("rows") - F.col("usable_rows")), F.lit(0)).alias("rows_without_value"),
        F.count_if(F.col("id_product").isNotNull() & (F.col("rows") > 1)).alias("duplicate_keys"),
        F.coalesce(F.sum(F.when(has_price & F.col("id_product").isNull(), F.col("rows"))), F.lit(0)).alias("missing_ids"),
    ).select(
        as_date(date).alias("snapshot_date"),
        "*",
        previous_row_count(prices, date, previous_date).alias("previous_rows"),
    )


def _violations(threshold: float) -> dict[str, Column]:
    drift = _drift(F.col("rows_loaded"), F.col("previous_rows"))
    return {
        "empty_price_snapshot": F.when(F.col("rows_loaded") == 0, 1).otherwise(0).cast("long"),
        "missing_products": F.col("missing_products"),
        "products_without_prices": F.col("products_without_prices"),
        "category_mismatch": F.col("category_mismatch"),
        "record_count_drift": F.when(drift > threshold, 1).otherwise(0).cast("long"),
    }


def daily_checks(counts: DataFrame, threshold: float = DRIFT_PERCENT) -> DataFrame:
    """(check_name, severity, violation_count) for the counts of one or more days."""
    violations = _violations(threshold)
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("check_name"),
                F.lit(severity).alias("severity"),
                violations[name].alias("violation_count"),
            )
            for name, severity in DAILY_CHECKS
        ]
    )
    return counts.select("snapshot_date", F.inline(rows))


def run_status(checks: DataFrame) -> DataFrame:
    """Status per day: a violated failure check fails the run, a violated warning marks it."""
    violated = F.col("violation_count") > 0
    return checks.groupBy("snapshot_date").agg(
        F.when(F.max(violated & (F.col("severity") == "failure")), "failed")
        .when(F.max(violated & (F.col("severity") == "warning")), "success with warnings")
        .otherwise("success")
        .alias("status")
    )


def daily_summary(counts: DataFrame, threshold: float = DRIFT_PERCENT) -> DataFrame:
    """The run report in one row per day: counts, status and a digest of the warnings."""
    violations = _violations(threshold)
    warnings = [name for name, severity in DAILY_CHECKS if severity == "warning"]
    digest = F.concat_ws(
        ", ",
        *[
            F.when(violations[name] > 0, F.concat(F.lit(f"{name}="), violations[name].cast("string")))
            for name in warnings
        ],
    )
    status = F.when(violations["empty_price_snapshot"] > 0, "failed").when(
        digest != "", "success with warnings"
    ).otherwise("success")
    return counts.select("*", status.alias("status"), digest.alias("warnings"))


def collection_issues(items: DataFrame, as_of) -> DataFrame:
    """(collection_item_id, issue), one row per broken rule, in a single scan."""
    today = as_date(as_of)
    sold, price, date = F.col("is_sold"), F.col("sold_price"), F.col("sold_date")
    rules = [
        (F.col("is_graded") & (F.col("grading_company").isNull() | F.col("grade").isNull()), ISSUE_GRADED),
        (sold & (price.isNull() | date.isNull()), ISSUE_SOLD),
        (~sold & (price.isNotNull() | date.isNotNull()), ISSUE_UNSOLD),
        (F.col("purchase_price") < 0, ISSUE_PURCHASE_PRICE),
        (price < 0, ISSUE_SOLD_PRICE),
        (F.col("purchase_date") > today, ISSUE_PURCHASE_DATE),
        (date > today, ISSUE_SOLD_DATE),
    ]
    issues = F.array(*[F.when(broken, text) for broken, text in rules])
    return items.select(
        "collection_item_id", F.explode(F.filter(issues, lambda i: i.isNotNull())).alias("issue")
    )


def missing_expansions(products: DataFrame, expansions: DataFrame) -> DataFrame:
    """Expansion ids the catalog uses and the reference lacks.  Ids are reduced to distinct
    ones before the join."""
    used = products.filter("id_expansion IS NOT NULL").select("id_expansion").distinct()
    return used.join(expansions.select("id_expansion"), "id_expansion", "left_anti")


def products_without_expansion(products: DataFrame, expansions: DataFrame) -> DataFrame:
    """Products whose expansion id the reference lacks (products without an id excepted)."""
    rows = products.filter("id_expansion IS NOT NULL").select(
        "id_product", F.col("name").alias("product_name"), "id_expansion"
    )
    known = expansions.select("id_expansion")
    return spread_join(rows, known, ["id_expansion"], "left_anti", ["id_product"])


def expansion_coverage(catalog_ids: DataFrame, reference_ids: DataFrame) -> DataFrame:
    """(id_expansion, side): ids only the catalog or only the reference has."""
    sides = catalog_ids.select("id_expansion", F.lit(1).alias("side")).unionByName(
        reference_ids.select("id_expansion", F.lit(2).alias("side"))
    )
    return (
        sides.filter("id_expansion IS NOT NULL")
        .groupBy("id_expansion")
        .agg(F.min("side").alias("low"), F.max("side").alias("high"))
        .filter("low = high")
        .select("id_expansion", F.when(F.col("low") == 1, "catalog_only").otherwise("reference_only").alias("side"))
    )


def expansion_seed(products: DataFrame) -> DataFrame:
    """Product count and first sample per expansion id, in file and record order."""
    place = F.struct("file_name", "record_index")
    sample = F.struct("id_product", "name", "file_name")
    return (
        products.filter("id_expansion IS NOT NULL")
        .groupBy("id_expansion")
        .agg(F.count("*").alias("detected_product_count"), F.min_by(sample, place).alias("sample"))
        .select(
            "id_expansion",
            "detected_product_count",
            F.col("sample.id_product").alias("sample_id_product"),
            F.col("sample.name").alias("sample_product_name"),
            F.col("sample.file_name").alias("source_file"),
        )
    )


# Columns of the seed file that people fill in.
SEED_BLANKS = [
    "name_en", "name_de", "slug", "series_en", "series_de", "release_date", "card_count",
    "source_url_en", "source_url_de", "notes",
]


def expansion_seed_file(seed: DataFrame) -> DataFrame:
    """The seed in the layout of its CSV file, sorted by id."""
    return seed.select("*", *[F.lit("").alias(name) for name in SEED_BLANKS]).orderBy("id_expansion")


# --- official sets -----------------------------------------------------------------


def set_issues(sets: DataFrame) -> DataFrame:
    """(tcg_set_id, name_en, issue), one row per failed rule of the set table."""
    printed, total, secret = F.col("printed_total"), F.col("total_cards"), F.col("secret_card_count")
    negative = F.coalesce(printed < 0, F.lit(False)) | F.coalesce(total < 0, F.lit(False)) | (secret < 0)
    rules = [
        (is_blank(F.col("tcg_set_id")), "missing id"),
        (is_blank(F.col("name_en")), "missing name"),
        (total < printed, "total below printed total"),
        ((total - printed).isNotNull() & ~secret.eqNullSafe(total - printed), "secret count differs"),
        (negative, "negative value"),
        (F.col("release_date").isNull(), "no release date"),
        (is_blank(F.col("series_en")), "no series"),
        (is_blank(F.col("ptcgo_code")), "no code"),
    ]
    issues = F.array(*[F.when(broken, text) for broken, text in rules])
    return sets.select(
        "tcg_set_id", "name_en", F.explode(F.filter(issues, lambda i: i.isNotNull())).alias("issue")
    )


def set_counts(sets: DataFrame) -> DataFrame:
    """Totals of the set table in one row."""
    return sets.agg(
        F.count("*").alias("total_sets"),
        F.count_if("is_active").alias("active_sets"),
        F.count_if(~F.col("is_active")).alias("inactive_sets"),
        F.count_if(F.col("created_at").isNull()).alias("rows_missing_created_at"),
        F.count_if(F.col("updated_at").isNull()).alias("rows_missing_updated_at"),
    )


def sets_by_activity(sets: DataFrame) -> DataFrame:
    return sets.groupBy("is_active").agg(F.count("*").alias("set_count")).orderBy(
        F.desc_nulls_first("is_active")
    )


def duplicate_sets(sets: DataFrame) -> DataFrame:
    return sets.groupBy("tcg_set_id").agg(F.count("*").alias("duplicate_count")).filter(
        "duplicate_count > 1"
    )


def series_overview(sets: DataFrame) -> DataFrame:
    return (
        sets.groupBy("series_en")
        .agg(
            F.count("*").alias("set_count"),
            F.min("release_date").alias("first_release_date"),
            F.max("release_date").alias("latest_release_date"),
        )
        .orderBy(F.desc_nulls_last("latest_release_date"), F.asc_nulls_last("series_en"))
    )


def latest_sets(sets: DataFrame, k: int = 20) -> DataFrame:
    """The k most recent sets; equal dates by id."""
    return (
        sets.select(
            "tcg_set_id", "name_en", "series_en", "ptcgo_code", "release_date", "printed_total",
            "total_cards", "secret_card_count",
        )
        .orderBy(F.desc_nulls_last("release_date"), F.asc("tcg_set_id"))
        .limit(k)
    )


def find_sets(sets: DataFrame, name: str, set_id: str) -> DataFrame:
    """Sets by name, ignoring case, or by id."""
    return sets.filter((F.lower("name_en") == name.lower()) | (F.col("tcg_set_id") == set_id))
