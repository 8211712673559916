"""Collection import, review and promotion."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradebinder.functions.dates import as_instant
from tradebinder.operators.checks import collection_issues
from tradebinder.operators.matching import match_staging, possible_duplicates, promote, re_evaluate
from tradebinder.schemas import STAGING
from tradebinder.session import configure, ensure_checkpoint_dir
from tradebinder.sources.tables import read_table, write_version


def import_collection(spark: SparkSession, root: str, staged: DataFrame, run_ts) -> DataFrame:
    """Match freshly staged rows (see sources.csv_files) and add them to staging.  Returns
    the number of rows per status and possible duplicates of owned items.  Rows that staging
    already holds, from an earlier attempt, are not added again."""
    configure(spark)
    ensure_checkpoint_dir(spark)
    products = read_table(spark, root, "products")
    before = read_table(spark, root, "collection_import_staging")
    staged = staged.join(before.select("import_row_id"), "import_row_id", "left_anti").select(*staged.columns)
    imported = before.filter("match_status = 'imported'")
    matched = match_staging(staged, products, imported).withColumns(
        {"created_at": as_instant(run_ts), "imported_at": F.lit(None).cast("timestamp")}
    ).select(*STAGING.fieldNames())
    after = before.unionByName(matched).checkpoint()
    write_version(after, root, "collection_import_staging", run_ts)
    fresh = after.filter(F.col("created_at") == as_instant(run_ts))
    doubtful = possible_duplicates(fresh, read_table(spark, root, "collection_items"))
    return (
        fresh.join(doubtful.select("import_row_id", F.lit(1).alias("_twin")), "import_row_id", "left")
        .groupBy("match_status")
        .agg(F.count("*").alias("import_rows"), F.count("_twin").alias("possible_duplicates"))
    )


CORRECTABLE = [
    "external_id", "provided_id_product", "raw_product_name", "language", "condition", "acquisition_type",
    "purchase_price", "purchase_date", "is_sealed", "storage_location", "personal_note",
]


def review_staging(spark: SparkSession, root: str, corrections: DataFrame, run_ts) -> DataFrame:
    """Correct open rows (needs_review, error) and judge them again like fresh ones.

    ``corrections`` has import_row_id, once each, and the text columns to change; null changes
    nothing, and rows in other states are left alone.  An external id belongs to a settled row
    before any open one, among open rows to one of them.  Staging is written once, as a whole,
    so a run that dies changes nothing.  Returns the number of rows per status.
    """
    configure(spark)
    ensure_checkpoint_dir(spark)
    fields = [c for c in corrections.columns if c != "import_row_id"]
    if unknown := sorted(set(fields) - set(CORRECTABLE)):
        raise ValueError(f"no columns to correct: {', '.join(unknown)}")
    if not corrections.groupBy("import_row_id").count().where("count > 1").isEmpty():
        raise ValueError("an import row is corrected twice")
    staging = read_table(spark, root, "collection_import_staging")
    new = corrections.select("import_row_id", *[F.col(c).cast("string").alias(f"_new_{c}") for c in fields])
    is_open = F.col("match_status").isin("needs_review", "error")
    text = {c: F.col(c).cast("string") for c in CORRECTABLE}
    changed = {c: F.coalesce(F.when(is_open, F.col(f"_new_{c}")), text[c]) if c in fields else text[c] for c in CORRECTABLE}
    corrected = staging.join(new, "import_row_id", "left").withColumns(changed).select(*staging.columns)
    # Staging does not keep the place in the upload; rows that are settled come before open ones.
    place = F.shiftrightunsigned(F.xxhash64("import_row_id"), 1)
    corrected = corrected.withColumn("record_index", F.when(is_open, place).otherwise(F.lit(-1).cast("long")))
    imported = staging.filter("match_status = 'imported'")
    judged = re_evaluate(corrected, read_table(spark, root, "products"), imported).select(*staging.columns)
    after = staging.filter(~is_open).unionByName(judged).checkpoint()
    write_version(after, root, "collection_import_staging", run_ts)
    return after.groupBy("match_status").agg(F.count("*").alias("import_rows"))


def promote_ready(spark: SparkSession, root: str, run_ts) -> DataFrame:
    """Turn ready rows into items.  Items are written first: a run that dies in between is
    repeated, and the stable item ids make the repetition add nothing twice."""
    configure(spark)
    ensure_checkpoint_dir(spark)
    staging = read_table(spark, root, "collection_import_staging")
    items = read_table(spark, root, "collection_items")
    fresh, after = promote(staging, run_ts)
    fresh = fresh.join(items.select("collection_item_id"), "collection_item_id", "left_anti")
    fresh = fresh.dropDuplicates(["collection_item_id"])
    all_items = items.unionByName(fresh).checkpoint()
    after = after.checkpoint()
    write_version(all_items, root, "collection_items", run_ts)
    write_version(after, root, "collection_import_staging", run_ts)
    return collection_issues(all_items, as_instant(run_ts).cast("date"))
