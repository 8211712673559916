"""Reference layer: curated expansions, official sets and the mapping between them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradebinder.operators.checks import expansion_coverage, expansion_seed, expansion_seed_file
from tradebinder.operators.mapping import mapping_candidates
from tradebinder.operators.merge import merge_expansions, merge_sets
from tradebinder.operators.normalize import lenient_products, normalize_expansions, normalize_sets
from tradebinder.operators.validate import expansion_metadata_errors
from tradebinder.schemas import SET_COLUMNS, SET_MAPPINGS
from tradebinder.session import configure, ensure_checkpoint_dir
from tradebinder.sources.csv_files import read_set_csv, read_text_csv, with_line_numbers, write_csv
from tradebinder.sources.json_files import (
    explode_records,
    lenient_catalog_documents,
    read_catalog_documents,
    read_documents,
    set_documents,
)
from tradebinder.sources.tables import read_table, write_version


def catalog_products(spark: SparkSession, folder: str) -> DataFrame:
    """Products of all catalog files in a folder, whatever their exact layout."""
    parsed = lenient_catalog_documents(read_catalog_documents(spark, folder))
    return lenient_products(explode_records(parsed))


def write_expansion_seed(spark: SparkSession, folder: str, out: str) -> None:
    write_csv(expansion_seed_file(expansion_seed(catalog_products(spark, folder))), out)


def validate_expansions(spark: SparkSession, folder: str, reference_csv: str) -> DataFrame:
    """(kind, detail) of everything wrong with the curated file.  Unused reference ids are
    reported but are no error: kind is missing, unused or metadata."""
    raw = read_text_csv(spark, reference_csv)
    coverage = expansion_coverage(
        catalog_products(spark, folder),
        raw.select(F.nullif("id_expansion", F.lit("")).cast("bigint").alias("id_expansion")),
    ).select(
        F.when(F.col("side") == "catalog_only", "missing").otherwise("unused").alias("kind"),
        F.col("id_expansion").cast("string").alias("detail"),
    )
    errors = expansion_metadata_errors(with_line_numbers(raw)).select(
        F.lit("metadata").alias("kind"),
        F.concat_ws(
            " ", F.concat(F.lit("line "), F.col("line_number").cast("string")), "error",
            F.concat(F.lit("for id "), F.col("id_expansion")),
        ).alias("detail"),
    )
    return coverage.unionByName(errors)


def load_expansions(spark: SparkSession, root: str, reference_csv: str, run_ts) -> DataFrame:
    """Curated file into the expansions table; the last row of an id wins."""
    configure(spark)
    ensure_checkpoint_dir(spark)
    raw = read_text_csv(spark, reference_csv).withColumn("record_index", F.monotonically_increasing_id())
    state = merge_expansions(
        read_table(spark, root, "expansions"), normalize_expansions(raw), run_ts
    ).checkpoint()
    write_version(state, root, "expansions", run_ts)
    return state


def convert_sets(spark: SparkSession, json_path: str, csv_path: str) -> None:
    """Set JSON to the normalized set CSV."""
    write_csv(normalize_sets(set_documents(read_documents(spark, json_path))), csv_path, SET_COLUMNS)


def load_sets(spark: SparkSession, root: str, csv_path: str, run_ts) -> DataFrame:
    """Normalized set CSV into the set table."""
    configure(spark)
    ensure_checkpoint_dir(spark)
    batch = read_set_csv(spark, csv_path).withColumn("record_index", F.monotonically_increasing_id())
    state = merge_sets(read_table(spark, root, "tcg_sets"), batch, run_ts).checkpoint()
    write_version(state, root, "tcg_sets", run_ts)
    return state


def refresh_mappings(spark: SparkSession, root: str, run_ts) -> DataFrame:
    """Recompute the mapping; manual decisions stored before are kept."""
    configure(spark)
    ensure_checkpoint_dir(spark)
    manual = read_table(spark, root, "expansion_set_mappings").filter("match_method = 'manual'")
    candidates = mapping_candidates(
        read_table(spark, root, "expansions"), read_table(spark, root, "tcg_sets"), run_ts,
        manual.filter("is_primary_mapping"),
    )
    found = candidates.filter("tcg_set_id IS NOT NULL").select(*SET_MAPPINGS.fieldNames())
    others = manual.filter("NOT is_primary_mapping")
    state = found.unionByName(others).checkpoint()
    write_version(state, root, "expansion_set_mappings", run_ts)
    return candidates
