"""CSV readers and writers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradebinder.functions.text import blank_to_null, surrogate_id
from tradebinder.schemas import COLLECTION_DEFAULTS, TCG_SET_FILE

# Header of the collection import file and the staging column of each name.
IMPORT_HEADERS = {
    "externalId": "external_id",
    "providedIdProduct": "provided_id_product",
    "rawProductName": "raw_product_name",
    "language": "language",
    "condition": "condition",
    "acquisitionType": "acquisition_type",
    "purchasePrice": "purchase_price",
    "purchaseDate": "purchase_date",
    "isSealed": "is_sealed",
    "storageLocation": "storage_location",
    "personalNote": "personal_note",
}
SECONDS = "yyyy-MM-dd HH:mm:ss"


def read_text_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV with header, every column as text; quoted line breaks and doubled quotes allowed."""
    return spark.read.csv(path, header=True, multiLine=True, escape='"')


def with_line_numbers(raw: DataFrame) -> DataFrame:
    """Line number in a single CSV file, header = line 1.

    One multi-line file is read by one task in file order, which makes the running id
    equal to the row position.  Not meant for a folder of files.
    """
    return raw.withColumn("line_number", F.monotonically_increasing_id() + 2)


def read_set_csv(spark: SparkSession, path: str) -> DataFrame:
    """Normalized set file for the set upsert; a malformed cell fails the read."""
    reader = spark.read.option("timestampNTZFormat", SECONDS)
    return reader.csv(
        path, header=True, multiLine=True, escape='"', mode="FAILFAST", schema=TCG_SET_FILE,
        dateFormat="yyyy-MM-dd",
    )


def stage_collection(raw: DataFrame, batch_id: str) -> DataFrame:
    """Import rows under staging names, still as text.  An empty cell and a missing column
    mean the same, and both get the default.  batch_id names one upload event."""
    columns = []
    for header, name in IMPORT_HEADERS.items():
        cell = blank_to_null(F.col(header)) if header in raw.columns else F.lit(None).cast("string")
        if name in COLLECTION_DEFAULTS:
            cell = F.coalesce(cell, F.lit(COLLECTION_DEFAULTS[name]))
        columns.append(cell.alias(name))
    row = F.col("record_index")
    return raw.select(
        surrogate_id(F.lit(batch_id), row).alias("import_row_id"),
        F.lit(batch_id).alias("import_batch_id"),
        row.cast("long").alias("record_index"),
        *columns,
    )


def read_collection_csv(spark: SparkSession, path: str, batch_id: str) -> DataFrame:
    """One uploaded collection file as staging rows (text columns, not yet validated)."""
    raw = read_text_csv(spark, path).withColumn("record_index", F.monotonically_increasing_id())
    return stage_collection(raw, batch_id)


def write_csv(df: DataFrame, path: str, columns: list[str] | None = None) -> None:
    """CSV with header; null and empty text are both written as an empty cell."""
    out = df.select(*columns) if columns else df
    out.write.mode("overwrite").option("timestampNTZFormat", SECONDS).csv(
        path, header=True, nullValue="", emptyValue="", escape='"'
    )


def write_quoted_csv(df: DataFrame, path: str) -> None:
    """Semicolon-separated CSV with every cell quoted."""
    df.write.mode("overwrite").csv(
        path, header=True, sep=";", quoteAll=True, escape='"', nullValue="", emptyValue=""
    )
