"""Helpers the text operators share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradebinder.session import ensure_checkpoint_dir

# A word is a run of anything but space, tab, line feed, vertical tab, form feed, return.
SPACE = r"[\x20\x09-\x0D]+"
# A table of at most this many rows of fixed width may be broadcast.
BROADCAST_ROWS = 200_000


def scratch_path(spark: SparkSession) -> str:
    """A new folder below the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/text-{uuid.uuid4().hex}"


def stored(df: DataFrame, **options: str) -> DataFrame:
    """Write a frame (with the writer's options) to the shared folder and read it again, which cuts its lineage."""
    spark = df.sparkSession
    path = scratch_path(spark)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def arrow_batches(spark: SparkSession, size: int) -> Iterator[None]:
    """What runs inside hands rows to Python in batches of about so many bytes; for rows of some MB each."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(size))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def free_name(df: DataFrame, name: str) -> str:
    """``name`` with underscores in front until no column of the frame is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def held_out(doc_id: Column, divisor: int, remainder: int) -> Column:
    """Whether crc32 of the id as text leaves the remainder; false without an id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % divisor == remainder, F.lit(False))


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once per row and use it as often as ``body`` likes.

    A column that lambdas mention many times would otherwise be evaluated at every mention.
    """
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    """The words of a text, none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def training_labels(labels: DataFrame, label: str) -> DataFrame:
    """doc_id and label, one row per id; rows without either are ignored, of several the lower counts."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
    return known.groupBy("doc_id").agg(F.min(F.col(label).cast("int")).alias("label"))
