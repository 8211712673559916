"""Stored tables: Parquet folders with the schemas of tradebinder.schemas.

Dated tables are partitioned by their date and replaced day by day.  All other tables are
written whole to a folder that no other attempt uses; a one-row commit record appended
afterwards makes it the current version.  A run that dies half way leaves the old state in
force, and the last commit counts, whatever run time it carries.
"""

from __future__ import annotations

import datetime
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tradebinder.schemas import TABLES

PARTITIONED = {"price_snapshots": "snapshot_date", "analytics_signals": "signal_date"}
COMMITS = "name string, version string, sequence long"


def table_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def _absent(problem: AnalysisException) -> bool:
    return problem.getCondition() == "PATH_NOT_FOUND"


def _last_commit(spark: SparkSession, root: str, name: str) -> Row | None:
    """(sequence, version) of the last committed write, or None."""
    try:
        commits = spark.read.schema(COMMITS).parquet(table_path(root, "commits"))
    except AnalysisException as problem:
        if _absent(problem):
            return None
        raise
    own = commits.filter(F.col("name") == name)
    order = F.struct(F.coalesce("sequence", F.lit(0)).alias("sequence"), "version")
    # A commit that met another of its number was taken back (sequence -1).
    per_version = own.groupBy("version").agg(F.max("sequence").alias("sequence"), F.min("sequence").alias("least"))
    return per_version.filter("least IS NULL OR least >= 0").agg(F.max(order)).first()[0]


def current_version(spark: SparkSession, root: str, name: str) -> str | None:
    """Version of the last committed write, or None."""
    last = _last_commit(spark, root, name)
    return last.version if last else None


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A stored table; one that was never written is empty.  A date filter on a
    partitioned table prunes folders before any file is opened."""
    schema = TABLES[name]
    path = table_path(root, name)
    if name not in PARTITIONED:
        version = current_version(spark, root, name)
        if version is None:
            return spark.createDataFrame([], schema)
        path = f"{path}/version={version}"
    try:
        stored = spark.read.schema(schema).parquet(path)
    except AnalysisException as problem:
        if not _absent(problem):
            raise
        return spark.createDataFrame([], schema)
    return stored.select(*schema.fieldNames())


def clear_partition(spark: SparkSession, root: str, name: str, day) -> None:
    """Leave a date without rows; a date that was never written stays so."""
    column = PARTITIONED[name]
    fields = [f for f in TABLES[name].fields if f.name != column]
    path = f"{table_path(root, name)}/{column}={day}"
    spark.createDataFrame([], StructType(fields)).write.mode("overwrite").parquet(path)


def write_partitions(df: DataFrame, root: str, name: str) -> None:
    """Replace exactly the date partitions present in df and leave all others alone.

    Rows are rebalanced by date first: a day gets few, evenly sized files and a very
    large day is split over several tasks.
    """
    column = PARTITIONED[name]
    (
        df.select(*TABLES[name].fieldNames())
        .hint("rebalance", column)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(column)
        .parquet(table_path(root, name))
    )


def version_of(run_ts: datetime.datetime | str) -> str:
    """Sortable version name of a run."""
    if isinstance(run_ts, str):
        run_ts = datetime.datetime.fromisoformat(run_ts)
    if run_ts.tzinfo is not None:
        run_ts = run_ts.astimezone(datetime.timezone.utc)
    return run_ts.strftime("%Y%m%dT%H%M%S%f")


class CommitConflict(Exception):
    """Another run committed the same table at the same time; nothing of this run counts."""


def _commit(spark: SparkSession, root: str, name: str, version: str, sequence: int) -> None:
    commit = spark.createDataFrame([(name, version, sequence)], COMMITS)
    commit.coalesce(1).write.mode("append").parquet(table_path(root, "commits"))


def write_version(df: DataFrame, root: str, name: str, run_ts) -> None:
    """Write a whole table to a new folder, then commit it as the current version.

    Two runs that commit at once take the same number.  Each looks after its own commit, so at
    least the later one sees the other; who does takes its commit back and fails.
    """
    version = f"{version_of(run_ts)}-{uuid.uuid4().hex[:12]}"
    path = f"{table_path(root, name)}/version={version}"
    df.select(*TABLES[name].fieldNames()).write.parquet(path)
    spark = df.sparkSession
    last = _last_commit(spark, root, name)
    sequence = last.sequence + 1 if last else 1
    _commit(spark, root, name, version, sequence)
    commits = spark.read.schema(COMMITS).parquet(table_path(root, "commits")).filter(F.col("name") == name)
    void = commits.filter("sequence < 0").select("version")
    rivals = commits.filter((F.col("sequence") == sequence) & (F.col("version") != version)).join(void, "version", "left_anti")
    if not rivals.isEmpty():
        _commit(spark, root, name, version, -1)
        raise CommitConflict(f"{name} was committed by another run")
