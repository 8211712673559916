"""Price files loaded as they arrive in the archive folder.

The stream carries names and paths; contents are read only for files that count.  Which file
of a day counts so far is state of the stream, one small entry per prefix and date, so no
micro-batch lists the archive.  The upsert is idempotent, so a micro-batch that is repeated
after a failure changes nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tradebinder.operators.lookup import spread_join
from tradebinder.operators.merge import merge_price_snapshots
from tradebinder.operators.normalize import normalize_prices
from tradebinder.operators.validate import good_rows, is_bad, judged_prices
from tradebinder.schemas import PRICE_PREFIX
from tradebinder.session import configure, ensure_checkpoint_dir
from tradebinder.sources.archive import parse_archive_names
from tradebinder.sources.json_files import price_documents, read_documents
from tradebinder.sources.tables import read_table, write_partitions

FILE = "path string, modificationTime timestamp, length long, content binary"
COUNTING = "rank decimal(38,0), file_name string, path string"


def arriving_files(spark: SparkSession, archive: str, files_per_batch: int) -> DataFrame:
    """Names and paths of new price files, nested folders included; contents are not read."""
    return (
        spark.readStream.format("binaryFile")
        .schema(FILE)
        .option("pathGlobFilter", f"{PRICE_PREFIX}_*.json")
        .option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", files_per_batch)
        .load(archive)
        .select(F.element_at(F.split("path", "/"), -1).alias("file_name"), "path")
    )


def _newest(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """The file of a day that counts, if it is another than before.

    The highest rerun counts, the base file ranks below all; of files with one name the smallest
    path counts, as in a replay.
    """
    known = state.get if state.exists else None
    best = known
    for batch in batches:
        for row in batch[["rank", "file_name", "path"]].itertuples(index=False, name=None):
            if best is None or row[:2] > best[:2] or (row[:2] == best[:2] and row[2] < best[2]):
                best = row
    if best != known:
        state.update(best)
        yield pd.DataFrame([(*key, *best[1:])], columns=["prefix", "snapshot_date", "file_name", "path"])


def counting_files(files: DataFrame) -> DataFrame:
    """(prefix, snapshot_date, file_name, path) whenever another file becomes the one that counts."""
    named = parse_archive_names(files, [PRICE_PREFIX])
    ranked = named.select("prefix", "snapshot_date", F.coalesce("rerun", F.lit(-1)).cast("decimal(38,0)").alias("rank"), "file_name", "path")
    return ranked.groupBy("prefix", "snapshot_date").applyInPandasWithState(
        _newest, "prefix string, snapshot_date date, file_name string, path string", COUNTING, "update", GroupStateTimeout.NoTimeout
    )


def load_arrived(files: DataFrame, root: str, run_ts) -> None:
    """Merge one batch of files that count, one per day; a file with violations is left out."""
    spark = files.sparkSession
    # One path per calendar day in the batch, at most files_per_batch.
    paths = [r.path for r in files.select("path").collect()]
    if not paths:
        return
    named = parse_archive_names(read_documents(spark, paths), [PRICE_PREFIX])
    judged = normalize_prices(judged_prices(price_documents(named)), F.col("snapshot_date")).persist()
    try:
        bad = judged.filter(is_bad()).select("file_name").distinct()
        rows = spread_join(good_rows(judged), bad, ["file_name"], "left_anti", ["record_index"])
        # One value per calendar day in the batch: it limits the target to these partitions.
        dates = [r.snapshot_date for r in rows.select("snapshot_date").distinct().collect()]
        if dates:
            stored = read_table(spark, root, "price_snapshots").filter(F.col("snapshot_date").isin(dates))
            merged = merge_price_snapshots(stored, rows, run_ts).checkpoint()
            write_partitions(merged, root, "price_snapshots")
    finally:
        judged.unpersist()


def follow_archive(
    spark: SparkSession, archive: str, root: str, run_ts, files_per_batch: int = 1000,
    checkpoint: str | None = None,
) -> StreamingQuery:
    """Load everything that arrived since the last call, then stop (availableNow)."""
    configure(spark)
    base = ensure_checkpoint_dir(spark)
    return (
        counting_files(arriving_files(spark, archive, files_per_batch))
        .writeStream.outputMode("update")
        .foreachBatch(lambda batch, _: load_arrived(batch, root, run_ts))
        .option("checkpointLocation", checkpoint or f"{base}/price_stream")
        .trigger(availableNow=True)
        .start()
    )
