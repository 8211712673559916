"""Which archived file counts, what the next one is called, which days are missing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradebinder.functions.dates import archive_name
from tradebinder.operators.lookup import spread_join
from tradebinder.sources.archive import parse_archive_names


def _ranked(listing: DataFrame, prefixes: list[str] | None) -> DataFrame:
    """Parsed listing with the base file ranked below every rerun."""
    return parse_archive_names(listing, prefixes).withColumn(
        "_rank", F.coalesce(F.col("rerun"), F.lit(-1))
    )


def canonical_files(listing: DataFrame, prefixes: list[str] | None = None) -> DataFrame:
    """The file that counts per (prefix, snapshot_date): the highest rerun, or the base
    file when there is no rerun.  A day without a file gives no row; that is a gap, not an
    error.  superseded_files lists what the canonical file replaces."""
    best = F.struct("_rank", "file_name")
    return (
        _ranked(listing, prefixes)
        .groupBy("prefix", "snapshot_date")
        .agg(F.max(best).alias("best"), F.count("*").alias("files"))
        .select(
            "prefix",
            "snapshot_date",
            F.col("best.file_name").alias("file_name"),
            (F.col("best._rank") >= 0).alias("is_rerun"),
            F.when(F.col("best._rank") >= 0, F.col("best._rank")).alias("rerun_number"),
            (F.col("files") - 1).alias("superseded_count"),
        )
    )


def superseded_files(listing: DataFrame, prefixes: list[str] | None = None) -> DataFrame:
    """Archived files that no longer count, one row each, next to the file that does."""
    files = parse_archive_names(listing, prefixes).select("prefix", "snapshot_date", "file_name", "rerun")
    chosen = canonical_files(listing, prefixes).select(
        "prefix", "snapshot_date", F.col("file_name").alias("canonical_file_name")
    )
    return spread_join(files, chosen, ["prefix", "snapshot_date"], "inner", ["file_name"]).filter(
        F.col("file_name") != F.col("canonical_file_name")
    )


def next_archive_names(listing: DataFrame, requested: DataFrame) -> DataFrame:
    """Name of the next upload per requested (prefix, snapshot_date): the base name when
    nothing is archived for the day, else the highest rerun plus one."""
    highest = (
        parse_archive_names(listing)
        .groupBy("prefix", "snapshot_date")
        .agg(F.max(F.coalesce("rerun", F.lit(0))).alias("highest"))
    )
    named = requested.join(highest, ["prefix", "snapshot_date"], "left")
    return named.select(
        "prefix",
        "snapshot_date",
        archive_name(F.col("prefix"), F.col("snapshot_date"), F.col("highest") + 1).alias("next_file_name"),
    )


def archive_gaps(listing: DataFrame, prefixes: list[str] | None = None) -> DataFrame:
    """Calendar days without a file between the first and the last day of each prefix."""
    days = parse_archive_names(listing, prefixes).select("prefix", "snapshot_date").distinct()
    expected = (
        days.groupBy("prefix")
        .agg(F.min("snapshot_date").alias("first"), F.max("snapshot_date").alias("last"))
        .select(
            "prefix",
            F.explode(F.sequence("first", "last", F.expr("interval 1 day"))).alias("snapshot_date"),
        )
    )
    return expected.join(days, ["prefix", "snapshot_date"], "left_anti")


def file_outcomes(parsed: DataFrame, expected: DataFrame) -> DataFrame:
    """(file_name, outcome) per expected file: ok, missing, or the reason it is unusable.
    Files are judged one by one; a bad one never hides the others."""
    found = parsed.select("file_name", F.coalesce("problem", F.lit("ok")).alias("outcome"))
    return expected.select("file_name").join(found, "file_name", "left").select(
        "file_name", F.coalesce("outcome", F.lit("missing")).alias("outcome")
    )
