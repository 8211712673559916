"""Weekly catalog run over both product files."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tradebinder.operators.merge import (
    combine_catalogs,
    cross_file_duplicates,
    merge_products,
    recheck_waiting,
)
from tradebinder.operators.normalize import normalize_catalog
from tradebinder.operators.profile import catalog_run_summary
from tradebinder.operators.validate import (
    ValidationError,
    good_rows,
    judged_catalog,
    judged_split_catalog,
    raise_on_violations,
    violations,
)
from tradebinder.plans.daily import archived_documents
from tradebinder.schemas import CATALOG_PREFIX_TO_FILE, SOURCE_FILES
from tradebinder.session import configure, ensure_checkpoint_dir
from tradebinder.sources.json_files import catalog_documents, read_split_records
from tradebinder.sources.tables import read_table, write_version

SINGLES, NONSINGLES = SOURCE_FILES


def transform_catalog(documents: DataFrame, source_file: str) -> DataFrame:
    """Judged and normalized rows of the documents of one catalog file."""
    return normalize_catalog(judged_catalog(catalog_documents(documents), source_file), source_file)


def date_added_warnings(records: DataFrame) -> DataFrame:
    """Records whose date text could not be read (it is stored as null)."""
    text = F.nullif(F.col("record")["dateAdded"], F.lit(""))
    return records.filter(text.isNotNull() & text.try_cast("timestamp").isNull())


def run_archived_catalog(spark: SparkSession, root: str, archive: str, day, run_ts) -> Row:
    """run_catalog with the canonical files of the day; one missing file fails the run."""
    singles, nonsingles = (
        archived_documents(spark, archive, prefix, day) for prefix in CATALOG_PREFIX_TO_FILE
    )
    return run_catalog(spark, root, singles, nonsingles, run_ts)


def run_catalog(
    spark: SparkSession, root: str, singles: DataFrame, nonsingles: DataFrame, run_ts
) -> Row:
    """Load the documents of both catalog files (see load_catalog)."""
    configure(spark)
    return load_catalog(
        spark, root, transform_catalog(singles, SINGLES), transform_catalog(nonsingles, NONSINGLES), run_ts
    )


def run_large_catalog(spark: SparkSession, root: str, singles: str, nonsingles: str, run_ts) -> Row:
    """run_catalog for two paths whose documents are too large for one task."""
    configure(spark)
    rows = [
        normalize_catalog(judged_split_catalog(read_split_records(spark, path), source), source)
        for path, source in ((singles, SINGLES), (nonsingles, NONSINGLES))
    ]
    return load_catalog(spark, root, *rows, run_ts)


def load_catalog(
    spark: SparkSession, root: str, singles: DataFrame, nonsingles: DataFrame, run_ts
) -> Row:
    """Both files or nothing: validate, gate on conflicting duplicates, merge, recheck the
    waiting import rows, write.  Returns the run summary."""
    ensure_checkpoint_dir(spark)
    judged = [singles.persist(), nonsingles.persist()]
    raise_on_violations(violations(judged[0]).unionByName(violations(judged[1])))
    single_rows, other_rows = (good_rows(frame).drop("file_name") for frame in judged)
    duplicates = cross_file_duplicates(single_rows, other_rows).agg(
        F.count("*").alias("duplicates"),
        F.count_if("conflicting").alias("conflicts"),
        F.min(F.when(F.col("conflicting"), F.col("id_product"))).alias("first_conflict"),
    ).first()
    if duplicates.conflicts:
        raise ValidationError(
            f"{duplicates.conflicts} ids differ between the catalog files, first {duplicates.first_conflict}"
        )
    products = read_table(spark, root, "products")
    merged = merge_products(products, combine_catalogs(single_rows, other_rows), run_ts).checkpoint()
    for frame in judged:
        frame.unpersist()
    staging = read_table(spark, root, "collection_import_staging")
    rechecked = recheck_waiting(staging, merged).checkpoint()
    waiting = F.col("match_status") == "waiting_for_product"
    resolved = (
        staging.filter(waiting).select(F.count("*").alias("n")).scalar()
        - rechecked.filter(waiting).select(F.count("*").alias("n")).scalar()
    )
    summary = catalog_run_summary(merged, resolved).withColumn(
        "duplicate_ids", F.lit(duplicates.duplicates)
    ).first()
    write_version(merged, root, "products", run_ts)
    if summary.staging_resolved:
        write_version(rechecked, root, "collection_import_staging", run_ts)
    return summary
