"""Source validation.  Problems are rows, so one pass over any number of files finds all
of them; raise_on_violations turns them into a failed run."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradebinder.functions.text import id_number, is_blank, strip
from tradebinder.schemas import SOURCE_FILES

# Columns of the curated expansion file.
EXPANSION_FILE_COLUMNS = [
    "id_expansion", "name_en", "name_de", "slug", "series_en", "series_de", "release_date",
    "card_count", "source_url_en", "source_url_de", "is_active",
]
EXPANSION_REQUIRED = ["id_expansion", "name_en", "name_de"]
# Id fields that must be whole numbers when given.
PRICE_NUMBERS = ["idProduct", "idCategory"]
CATALOG_NUMBERS = ["idProduct", "idCategory", "idExpansion", "idMetacard"]


class ValidationError(Exception):
    """The run fails and nothing is loaded."""


def _missing(record: Column, field: str) -> Column:
    """Absent, null or empty.  Zero is a value."""
    return record[field].isNull() | (record[field] == "")


def _not_whole(record: Column, field: str) -> Column:
    return ~_missing(record, field) & id_number(record[field]).isNull()


def judged_records(parsed: DataFrame, required: list[str], numbers: list[str]) -> DataFrame:
    """One row per record with its position, the list of reasons against it (empty for a
    good record) and, if there are any, its raw text.  A document without usable records
    is one row that carries the problem of the document.

    Parsing is the expensive part of a load; this frame is enough for both the violations
    and the normalized rows, so a document is parsed once.
    """
    others = [c for c in parsed.columns if c not in ("records", "problem")]
    rows = parsed.select(
        *others, "problem", F.posexplode_outer("records").alias("record_index", "record")
    )
    return judge(rows, required, numbers)


def judge(rows: DataFrame, required: list[str], numbers: list[str]) -> DataFrame:
    """Add reasons and raw to rows of (record_index, record, problem of the document)."""
    record = F.col("record")
    checks = [(_missing(record, f), f"missing {f}") for f in required]
    checks += [(_not_whole(record, f), f"{f} is no whole number") for f in numbers]
    clean = ~functools.reduce(lambda x, y: x | y, [broken for broken, _ in checks])
    found = F.array_compact(F.array(*[F.when(broken, reason) for broken, reason in checks]))
    reasons = (
        F.when(F.col("problem").isNotNull(), F.array("problem"))
        .when(clean, F.array().cast("array<string>"))
        .otherwise(found)
    )
    return rows.withColumn("reasons", reasons).withColumn(
        "raw", F.when(is_bad(), F.to_json("record"))
    ).drop("problem")


def is_bad() -> Column:
    """Whether a judged row, raw or normalized, was found faulty."""
    return F.size("reasons") > 0


def judged_prices(parsed: DataFrame) -> DataFrame:
    """Prices themselves are nullable and never validated."""
    return judged_records(parsed, ["idProduct"], PRICE_NUMBERS)


def judged_split_prices(rows: DataFrame) -> DataFrame:
    """The same for records of sources.json_files.read_split_records."""
    return judge(rows, ["idProduct"], PRICE_NUMBERS)


def judged_split_catalog(rows: DataFrame, source_file: str) -> DataFrame:
    _known(source_file)
    return judge(rows, ["idProduct", "name"], CATALOG_NUMBERS)


def _known(source_file: str) -> None:
    if source_file not in SOURCE_FILES:
        raise ValueError(f"unknown source file {source_file!r}")


def judged_catalog(parsed: DataFrame, source_file: str) -> DataFrame:
    _known(source_file)
    return judged_records(parsed, ["idProduct", "name"], CATALOG_NUMBERS)


def violations(judged: DataFrame) -> DataFrame:
    """(file_name, record_index, reason, raw) of the faulty rows."""
    return judged.filter(is_bad()).select(
        "file_name", "record_index", F.explode("reasons").alias("reason"), "raw"
    )


def good_rows(judged: DataFrame) -> DataFrame:
    return judged.filter(~is_bad()).drop("reasons", "raw")


def raise_on_violations(found: DataFrame) -> None:
    """Fail with the first problem by file and position (one row reaches the driver)."""
    first = found.orderBy("file_name", F.asc_nulls_first("record_index"), "reason").first()
    if first is not None:
        raise ValidationError(
            f"{first.file_name}, record {first.record_index}: {first.reason} {first.raw or ''}".strip()
        )


def expansion_metadata_errors(raw: DataFrame) -> DataFrame:
    """Errors of the curated expansion file as (line_number, id_expansion, error): a missing
    required column, or an empty required cell.  Needs line_number (see sources.csv_files)."""
    spark = raw.sparkSession
    absent = [c for c in EXPANSION_REQUIRED if c not in raw.columns]
    columns = spark.createDataFrame(
        [(None, None, f"missing column {c}") for c in absent],
        "line_number long, id_expansion string, error string",
    )
    id_text = strip(F.col("id_expansion")) if "id_expansion" not in absent else F.lit("")

    def empty(name):
        if name in absent:
            return F.lit(True)
        return F.coalesce(strip(F.col(name)), F.lit("")) == ""

    cells = [F.when(empty(c), f"{c} is empty") for c in EXPANSION_REQUIRED]
    rows = raw.select(
        "line_number",
        id_text.alias("id_expansion"),
        F.explode(F.filter(F.array(*cells), lambda e: e.isNotNull())).alias("error"),
    )
    return columns.unionByName(rows)


def expansion_file_integrity(raw: DataFrame) -> DataFrame:
    """Failed rules of the curated file as (rule, value): columns, unique ids, names."""
    spark = raw.sparkSession
    absent = [("column present", c) for c in EXPANSION_FILE_COLUMNS if c not in raw.columns]
    found = spark.createDataFrame(absent, "rule string, value string")
    if "id_expansion" in raw.columns:
        twice = raw.groupBy("id_expansion").count().filter("count > 1")
        found = found.unionByName(
            twice.select(F.lit("id unique").alias("rule"), F.col("id_expansion").alias("value"))
        )
        for name in ("name_en", "name_de"):
            if name in raw.columns:
                blank = raw.filter(is_blank(F.col(name)))
                found = found.unionByName(
                    blank.select(F.lit(f"{name} filled").alias("rule"), F.col("id_expansion").alias("value"))
                )
    return found
