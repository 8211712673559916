"""JSON source documents as tables.

A frame of documents has the columns ``file_name`` and ``content`` (one whole JSON text
per row).  It usually comes from a folder of archived files; any table with these two
columns works, so many small documents are read in parallel in one scan.  Records are
kept as ``map<string,string>``: a map tells an absent key from a null and keeps numbers
exactly as written.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradebinder.operators.lookup import spread_join

RECORDS = "array<map<string,string>>"
PRICE_ROOT = f"createdAt string, priceGuides {RECORDS}"

# Keys under which a catalog document may hold its list, in order.
CATALOG_KEYS = ["products", "data", "items"]
LENIENT_KEYS = ["products", "product", "data", "productList", "product_list"]
CATALOG_GLOB = "products_*_6_*.json"

SET_RECORDS = (
    "array<struct<id string, name string, series string, printedTotal int, total int, "
    "legalities map<string,string>, ptcgoCode string, releaseDate string, "
    "updatedAt string, images struct<symbol string, logo string>>>"
)


def read_documents(spark: SparkSession, path: str | list[str], glob: str | None = None) -> DataFrame:
    """Whole files as (file_name, content)."""
    reader = spark.read.option("wholetext", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.text(path).select(
        F.col("_metadata.file_name").alias("file_name"), F.col("value").alias("content")
    )


def read_catalog_documents(spark: SparkSession, path: str) -> DataFrame:
    """Catalog files of a folder; a folder without any is an error."""
    documents = read_documents(spark, path, CATALOG_GLOB)
    if documents.isEmpty():
        raise FileNotFoundError(f"no product catalog files in {path}")
    return documents


def _is_list(content: Column) -> Column:
    return content.rlike(r"^\s*\[")


def _parsed(documents: DataFrame, root: Column, records: Column, **extra: Column) -> DataFrame:
    """One row per document with its records, or the reason why there are none.

    ``root`` is parsed once into a column of its own that ``records`` and the extra columns
    pick from; other columns of the documents are kept.
    """
    listed = F.when(_is_list(F.col("content")), F.from_json("content", RECORDS))
    problem = (
        F.when(F.col("content").isNull() | F.try_parse_json("content").isNull(), "invalid json")
        .when(F.col("records").isNull(), "no record list")
        .otherwise("zero records")
    )
    others = [c for c in documents.columns if c != "content"]
    rooted = documents.withColumns(
        {"_listed": listed, "_root": F.when(~_is_list(F.col("content")), root)}
    )
    found = rooted.select(
        *others,
        "content",
        *[column.alias(name) for name, column in extra.items()],
        F.coalesce("_listed", records).alias("records"),
    )
    unusable = F.coalesce(F.size("records"), F.lit(0)) < 1
    return found.withColumn("problem", F.when(unusable, problem)).drop("content")


def price_documents(documents: DataFrame) -> DataFrame:
    """(file_name, created_at_text, records, problem) of price-guide documents: a root
    object with ``priceGuides``, or a bare list."""
    return _parsed(
        documents,
        F.from_json("content", PRICE_ROOT),
        F.col("_root.priceGuides"),
        created_at_text=F.col("_root.createdAt"),
    )


def catalog_documents(documents: DataFrame) -> DataFrame:
    """(file_name, records, problem) of catalog documents: a list, or the first list found
    under the known keys."""
    root = F.from_json("content", ", ".join(f"{key} {RECORDS}" for key in CATALOG_KEYS))
    return _parsed(documents, root, F.coalesce(*[F.col(f"_root.{key}") for key in CATALOG_KEYS]))


def lenient_catalog_documents(documents: DataFrame) -> DataFrame:
    """As catalog_documents with more keys, and as a last resort the first value in the
    root object that is a list of objects."""
    root = F.from_json("content", ", ".join(f"{key} {RECORDS}" for key in LENIENT_KEYS))
    values = F.map_values(F.from_json("content", "map<string,string>"))
    object_lists = F.filter(values, lambda v: v.rlike(r"^\[\s*[{\]]"))
    last_resort = F.from_json(F.get(object_lists, F.lit(0)), RECORDS)
    known = [F.col(f"_root.{key}") for key in LENIENT_KEYS]
    return _parsed(documents, root, F.coalesce(*known, last_resort))


def explode_records(parsed: DataFrame) -> DataFrame:
    """One row per record, in document order (record_index from 0).  Columns of the
    document (for example its snapshot_date) are repeated on every record.

    The outer form keeps the optimizer from testing the size of the list first, for which
    it would parse every document a second time.
    """
    others = [c for c in parsed.columns if c not in ("records", "problem")]
    exploded = parsed.select(*others, F.posexplode_outer("records").alias("record_index", "record"))
    return exploded.filter("record_index IS NOT NULL")


def set_documents(documents: DataFrame) -> DataFrame:
    """Set records; a root that is no list raises."""
    content = F.when(_is_list(F.col("content")), F.col("content")).otherwise(
        F.raise_error(F.lit("the source must contain a list of sets"))
    )
    parsed = documents.select(
        "file_name", F.posexplode_outer(F.from_json(content, SET_RECORDS)).alias("position", "set")
    )
    return parsed.filter("position IS NOT NULL").select("file_name", "set.*")


# Text around the flat records of a document.
LIST_OPENS = r"^\s*(\[|\{[^{}\[\]]*\[)\s*$"
BETWEEN_RECORDS = r"^\s*,\s*$"
LIST_CLOSES = r"^\s*\][^\[\]{]*$"
CREATED_AT = r'"createdAt"\s*:\s*"([^"]*)"'


def read_split_records(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """Records of documents too large for one task, as (file_name, created_at_text,
    record_index, record, problem).

    The records are flat objects, so the closing brace ends a line of a text file that
    Spark can split anywhere: a single document is read by as many tasks as it has blocks.
    What stands between the records is checked piece by piece; a document that is not a
    plain list of flat records, or is cut off, has the problem on every row and must be
    read as whole text instead.  record_index grows in document order but has gaps.
    """
    reader = spark.read.option("lineSep", "}")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    # Offset of the split plus position in the task: a task reads at most one split size of
    # bytes and every line has several, so positions never reach the next split.
    position = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    pieces = reader.text(path).select(
        F.col("_metadata.file_name").alias("file_name"),
        (F.col("_metadata.file_block_start") + position).alias("record_index"),
        F.substring_index("value", "{", -1).alias("fields"),
        "value",
    )
    has_record = F.contains(F.col("value"), F.lit("{"))
    before = F.substring(
        "value", F.lit(1), F.length("value") - F.length("fields") - F.when(has_record, 1).otherwise(0)
    )
    pieces = pieces.withColumn("before", before)
    opens = has_record & F.col("before").rlike(LIST_OPENS)
    between = has_record & F.col("before").rlike(BETWEEN_RECORDS)
    closes = ~has_record & F.col("value").rlike(LIST_CLOSES)
    empty = ~has_record & (F.trim(F.regexp_replace("value", r"\s+", "")) == "")
    created = F.when(opens | closes, F.nullif(F.regexp_extract("value", CREATED_AT, 1), F.lit("")))
    files = pieces.groupBy("file_name").agg(
        F.max(created).alias("created_at_text"),
        F.count_if(opens).alias("_opened"),
        F.count_if(closes).alias("_closed"),
        F.count_if(~(opens | between | closes | empty)).alias("_other"),
    )
    plain = (F.col("_opened") == 1) & (F.col("_closed") == 1) & (F.col("_other") == 0)
    judged_files = files.select(
        "file_name", "created_at_text", F.when(~plain, "not a list of flat records").alias("problem")
    )
    records = pieces.filter(has_record).select(
        "file_name",
        "record_index",
        F.from_json(F.concat(F.lit("{"), "fields", F.lit("}")), "map<string,string>").alias("record"),
    )
    return spread_join(records, judged_files, ["file_name"], "left", ["record_index"])
