"""Daily price load and replay of the archive."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tradebinder.functions.dates import as_date
from tradebinder.operators.archive import canonical_files
from tradebinder.operators.checks import daily_counts, daily_summary
from tradebinder.operators.merge import merge_price_snapshots, replay_comparison
from tradebinder.operators.normalize import normalize_prices
from tradebinder.operators.validate import (
    good_rows,
    judged_prices,
    judged_split_prices,
    raise_on_violations,
    violations,
)
from tradebinder.schemas import PRICE_PREFIX
from tradebinder.session import configure, ensure_checkpoint_dir
from tradebinder.sources.archive import archive_listing, parse_archive_names
from tradebinder.sources.json_files import (
    price_documents,
    read_documents,
    read_split_records,
)
from tradebinder.sources.tables import read_table, write_partitions


class LoadFailed(Exception):
    """A failure check was violated; nothing was written."""


def transform_prices(documents: DataFrame, snapshot_date, created_at=None) -> DataFrame:
    """Judged and normalized rows of price documents."""
    return normalize_prices(judged_prices(price_documents(documents)), snapshot_date, created_at)


def latest_date_before(stored: DataFrame, day, recent_days: int = 31) -> datetime.date | None:
    """Most recent stored date before the day.  The last weeks are looked at first; only if
    they are empty are older partitions opened."""
    earlier = stored.filter(F.col("snapshot_date") < day)
    latest = F.max("snapshot_date")
    recent = earlier.filter(F.col("snapshot_date") >= F.date_sub(day, recent_days)).agg(latest).first()[0]
    return recent if recent is not None else earlier.agg(latest).first()[0]


def load_day(
    spark: SparkSession, root: str, documents: DataFrame, snapshot_date, run_ts, created_at=None
) -> Row:
    """Load the price document of one day, all or nothing (see load_rows)."""
    configure(spark)
    rows = transform_prices(documents, snapshot_date, created_at)
    return load_rows(spark, root, rows, snapshot_date, run_ts)


def load_large_day(
    spark: SparkSession, root: str, path: str, snapshot_date, run_ts, created_at=None
) -> Row:
    """load_day for a document that is too large for one task; it is read in splits."""
    configure(spark)
    rows = normalize_prices(
        judged_split_prices(read_split_records(spark, path)), snapshot_date, created_at
    )
    return load_rows(spark, root, rows, snapshot_date, run_ts)


def load_rows(spark: SparkSession, root: str, judged: DataFrame, snapshot_date, run_ts) -> Row:
    """Validate, merge, check, write: all or nothing for one day.

    The merged day is checkpointed to the shared folder before it is checked.  What is
    written is exactly what was checked, and the write no longer depends on the files it
    replaces.  Returns the run summary; a failed check raises and writes nothing.
    """
    ensure_checkpoint_dir(spark)
    judged = judged.persist()
    raise_on_violations(violations(judged))
    records_read = judged.count()
    stored = read_table(spark, root, "price_snapshots")
    day = as_date(snapshot_date)
    today = stored.filter(F.col("snapshot_date") == day)
    merged = merge_price_snapshots(today, good_rows(judged), run_ts).checkpoint()
    judged.unpersist()
    before = stored.filter(F.col("snapshot_date") < day)
    state = before.unionByName(merged)
    products = read_table(spark, root, "products")
    counts = daily_counts(state, products, snapshot_date, latest_date_before(stored, day))
    summary = daily_summary(counts).withColumn("records_read", F.lit(records_read)).first()
    if summary.status == "failed":
        raise LoadFailed(f"no rows for {snapshot_date}")
    write_partitions(merged, root, "price_snapshots")
    return summary


def archived_documents(spark: SparkSession, archive: str, prefix: str, day) -> DataFrame:
    """The canonical archived document of a day; a day without one cannot be loaded."""
    listing = archive_listing(spark, archive)
    found = canonical_files(listing, [prefix]).filter(F.col("snapshot_date") == as_date(day))
    found = _with_paths(found, listing).first()
    if found is None:
        raise LoadFailed(f"no {prefix} file is archived for {day}")
    return read_documents(spark, found.path)


def _with_paths(files: DataFrame, listing: DataFrame) -> DataFrame:
    """Add the full path of each file; of files with one name the first path counts, the others
    are listed (unread)."""
    paths = listing.groupBy("file_name").agg(F.array_sort(F.collect_list("path")).alias("paths"))
    others = F.slice("paths", 2, F.size("paths") - 1)
    others = F.when(F.size("paths") > 1, others).otherwise(F.array().cast("array<string>"))
    return files.join(paths.select("file_name", F.get("paths", F.lit(0)).alias("path"), others.alias("unread")), "file_name")


def load_archived_day(spark: SparkSession, root: str, archive: str, day, run_ts) -> Row:
    """load_day with the canonical price file of the day."""
    return load_day(spark, root, archived_documents(spark, archive, PRICE_PREFIX, day), day, run_ts)


def replay(
    spark: SparkSession, root: str, archive: str, first: datetime.date, last: datetime.date, run_ts
) -> DataFrame:
    """Load the canonical files of a date range again, many days in one scan.

    Days whose file is invalid are left as they are and reported.  Returns one row per day:
    file, rows found in the file, rows stored before, and the reason if it was skipped; and one
    per file that is not read because another has its name.
    The list of files to read has one entry per calendar day.
    """
    configure(spark)
    ensure_checkpoint_dir(spark)
    listing = archive_listing(spark, archive)
    in_range = canonical_files(listing, [PRICE_PREFIX]).filter(
        F.col("snapshot_date").between(as_date(first), as_date(last))
    )
    chosen = _with_paths(in_range, listing).select("snapshot_date", "file_name", "path", "unread").collect()
    if not chosen:
        return spark.createDataFrame([], REPLAY_REPORT)
    files = spark.createDataFrame(chosen, "snapshot_date date, file_name string, path string, unread array<string>")
    unread = files.select("snapshot_date", "file_name", F.explode("unread").alias("path"))
    files = files.select("snapshot_date", "file_name")
    documents = read_documents(spark, [row.path for row in chosen])
    judged = transform_prices(
        parse_archive_names(documents, [PRICE_PREFIX]), F.col("snapshot_date")
    ).persist()
    problems = violations(judged).groupBy("file_name").agg(F.min("reason").alias("reason"))
    problems = problems.checkpoint()
    rows = good_rows(judged).join(problems.select("file_name"), "file_name", "left_anti")
    dates = [row.snapshot_date for row in chosen]
    stored = read_table(spark, root, "price_snapshots").filter(F.col("snapshot_date").isin(dates))
    merged = merge_price_snapshots(stored, rows, run_ts).checkpoint()
    report = (
        files.join(replay_comparison(rows, stored).drop("equal"), "snapshot_date", "left")
        .join(problems, "file_name", "left")
        .select(
            "snapshot_date",
            "file_name",
            F.coalesce("replayed_rows", F.lit(0)).alias("replayed_rows"),
            F.coalesce("stored_rows", F.lit(0)).alias("stored_rows"),
            "reason",
        )
        .unionByName(
            unread.select(
                "snapshot_date", "file_name", F.lit(0).alias("replayed_rows"), F.lit(0).alias("stored_rows"),
                F.concat(F.lit("same name as another file: "), "path").alias("reason"),
            )
        )
        .checkpoint()
    )
    judged.unpersist()
    write_partitions(merged, root, "price_snapshots")
    return report


REPLAY_REPORT = (
    "snapshot_date date, file_name string, replayed_rows bigint, stored_rows bigint, reason string"
)
