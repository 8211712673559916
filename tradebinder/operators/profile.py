"""Structure report of raw records and basic checks of the catalog."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradebinder.functions.text import is_blank


def value_kind(value: Column) -> Column:
    """What a value looks like: null, boolean, integer, number, array, object or text."""
    return (
        F.when(value.isNull(), "null")
        .when(value.isin("true", "false"), "boolean")
        .when(value.rlike(r"^-?[0-9]+$"), "integer")
        .when(value.rlike(r"^-?[0-9]+\.[0-9]+([eE][-+]?[0-9]+)?$"), "number")
        .when(value.startswith("["), "array")
        .when(value.startswith("{"), "object")
        .otherwise("text")
    )


def profile_records(records: DataFrame, column: str = "record") -> DataFrame:
    """Per field of a map column: occurrences, nulls, kinds, distinct values and the
    smallest and largest value as samples.  Samples are bounded whatever the input size."""
    fields = records.select(F.explode_outer(column).alias("field", "value")).filter("field IS NOT NULL")
    kind = value_kind(F.col("value"))

    def of(name):
        return F.count_if(kind == name).alias(f"{name}_count")

    return fields.groupBy("field").agg(
        F.count("*").alias("occurrences"),
        F.count_if(F.col("value").isNull()).alias("null_count"),
        of("boolean"), of("integer"), of("number"), of("array"), of("object"), of("text"),
        F.count_distinct("value").alias("distinct_values"),
        F.min("value").alias("smallest"),
        F.max("value").alias("largest"),
    )


def profile_columns(df: DataFrame) -> DataFrame:
    """The same report for the columns of a table."""
    entries = [x for c in df.columns for x in (F.lit(c), F.col(c).cast("string"))]
    return profile_records(df.select(F.create_map(*entries).alias("record")))


def document_report(parsed: DataFrame) -> DataFrame:
    """(file_name, record_count, problem) per source document."""
    return parsed.select(
        "file_name", F.greatest(F.size("records"), F.lit(0)).cast("long").alias("record_count"), "problem"
    )


def catalog_overview(products: DataFrame) -> DataFrame:
    """Row count, missing values and duplicate ids of the catalog in one row."""
    per_id = products.groupBy("id_product").agg(
        F.count("*").alias("n"),
        F.count_if(is_blank(F.col("name"))).alias("no_name"),
        F.count_if(F.col("id_expansion").isNull()).alias("no_expansion"),
        F.count_if(F.col("id_category").isNull()).alias("no_category"),
    )
    total = F.coalesce(F.sum("n"), F.lit(0))
    return per_id.agg(
        total.alias("row_count"),
        F.coalesce(F.sum(F.when(F.col("id_product").isNull(), F.col("n"))), F.lit(0)).alias("missing_id"),
        F.coalesce(F.sum("no_name"), F.lit(0)).alias("missing_name"),
        F.coalesce(F.sum("no_expansion"), F.lit(0)).alias("missing_expansion"),
        F.coalesce(F.sum("no_category"), F.lit(0)).alias("missing_category"),
        F.count_if(F.col("id_product").isNotNull() & (F.col("n") > 1)).alias("duplicate_ids"),
    )


def products_by(products: DataFrame, column: str) -> DataFrame:
    """Product count per category, expansion or source file."""
    return products.groupBy(column).agg(F.count("*").alias("products"))


def catalog_run_summary(merged: DataFrame, staging_resolved: Column | None = None) -> DataFrame:
    """Catalog run report from merge_products output, in one row."""
    seen = F.col("catalog_change").isin("inserted", "updated")
    single = F.col("product_group") == "single"
    summary = merged.agg(
        F.count_if(seen & single).alias("singles_loaded"),
        F.count_if(seen & ~single).alias("non_singles_loaded"),
        F.count_if("is_active_in_catalog").alias("active_products"),
        F.count_if(F.col("catalog_change") == "inserted").alias("new_products"),
        F.count_if(F.col("catalog_change") == "deactivated").alias("deactivated_products"),
        F.count_if(seen & is_blank(F.col("name"))).alias("missing_names"),
    )
    return summary if staging_resolved is None else summary.withColumn("staging_resolved", staging_resolved)
