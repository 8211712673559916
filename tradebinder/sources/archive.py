"""Archive folder listing and file-name parsing."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: prefix, calendar date, optional rerun number.
ARCHIVE_NAME = r"^(.+)_(\d{4}-\d{2}-\d{2})(?:_rerun-(\d+))?\.json$"

LISTING = "file_name string, path string, length bigint, modified_at timestamp"


def archive_listing(spark: SparkSession, path: str) -> DataFrame:
    """Files below a folder, nested ones included, as (file_name, path, length, modified_at);
    contents are not read.  A folder that does not exist is empty; any other failure is raised."""
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LISTING)
    return files.select(
        F.element_at(F.split("path", "/"), -1).alias("file_name"),
        "path",
        "length",
        F.col("modificationTime").alias("modified_at"),
    )


def parse_archive_names(listing: DataFrame, prefixes: list[str] | None = None) -> DataFrame:
    """Add prefix, snapshot_date and rerun (null for the base file) and drop files that do
    not follow the naming rule.  The date is anchored at the end of the name, so a prefix
    may itself contain underscores."""
    # One pattern match per name; a file name has no slash of its own.
    parts = F.split(F.regexp_replace("file_name", ARCHIVE_NAME, "$1/$2/$3"), "/")
    parsed = (
        listing.withColumn("_parts", parts)
        .withColumns(
            {
                "prefix": F.get("_parts", F.lit(0)),
                "snapshot_date": F.get("_parts", F.lit(1)).try_cast("date"),
                "rerun": F.get("_parts", F.lit(2)).try_cast("decimal(38,0)"),
            }
        )
        .filter(F.col("snapshot_date").isNotNull())
        .drop("_parts")
    )
    if prefixes is not None:
        parsed = parsed.filter(F.col("prefix").isin(prefixes))
    return parsed
