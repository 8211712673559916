"""Collection import: validation, matching against the catalog, promotion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradebinder.functions.dates import as_instant
from tradebinder.functions.text import blank_to_null, id_number, surrogate_id
from tradebinder.operators.lookup import by_shuffle, spread_join
from tradebinder.schemas import (
    ACQUISITION_TYPES,
    COLLECTION_DEFAULTS,
    CONDITIONS,
    CONFIDENCE,
    LANGUAGES,
    MONEY,
)

# Confidence of each match outcome and the words shown for a problem.
EXACT_ID, EXACT_NAME, NO_MATCH = 1.00, 0.90, 0.00
MSG_NOTHING = "Missing product name and product ID"
MSG_NO_MATCH = "No matching product found"
MSG_MANY = "Multiple possible products found"
MSG_WAITING = "Product matched, but not yet present in the local catalog"
MSG_PRICE = "Invalid purchase price"
MSG_DATE = "Invalid purchase date"
MSG_CONDITION = "Unknown condition value"
MSG_LANGUAGE = "Unknown language value"
MSG_ACQUISITION = "Unknown acquisition type value"
MSG_SEALED = "Invalid sealed value"
MSG_ID = "Invalid product ID"
MSG_REPEATED = "Duplicate external id in this batch"
MSG_IMPORTED = "External id already imported"


def field_errors(staging: DataFrame) -> Column:
    """Texts of all broken field rules of a staging row (text columns), '; '-separated;
    null when there are none."""

    def invalid(name: str, parsed: Column) -> Column:
        return blank_to_null(F.col(name)).isNotNull() & parsed.isNull()

    price = F.col("purchase_price").try_cast(MONEY)
    nothing = (
        blank_to_null(F.col("provided_id_product")).isNull()
        & blank_to_null(F.col("raw_product_name")).isNull()
    )
    rules = [
        (nothing, MSG_NOTHING),
        (invalid("provided_id_product", id_number(F.col("provided_id_product"))), MSG_ID),
        (invalid("purchase_price", price) | (price < 0), MSG_PRICE),
        (invalid("purchase_date", F.col("purchase_date").try_cast("date")), MSG_DATE),
        (~F.col("condition").isin(CONDITIONS), MSG_CONDITION),
        (~F.col("language").isin(LANGUAGES), MSG_LANGUAGE),
        (~F.col("acquisition_type").isin(ACQUISITION_TYPES), MSG_ACQUISITION),
        (invalid("is_sealed", F.col("is_sealed").try_cast("boolean")), MSG_SEALED),
    ]
    return F.nullif(
        F.concat_ws("; ", *[F.when(F.coalesce(broken, F.lit(False)), text) for broken, text in rules]),
        F.lit(""),
    )


def with_typed_fields(staging: DataFrame) -> DataFrame:
    """Defaults for empty fields, then typed columns; the texts stay in field_error only."""
    filled = staging.withColumns(
        {
            name: F.coalesce(blank_to_null(F.col(name)), F.lit(default))
            for name, default in COLLECTION_DEFAULTS.items()
        }
    )
    typed = filled.withColumn("field_error", field_errors(filled))
    return typed.withColumns(
        {
            "provided_id_product": id_number(F.col("provided_id_product")),
            "raw_product_name": blank_to_null(F.col("raw_product_name")),
            "purchase_price": F.col("purchase_price").try_cast(MONEY),
            "purchase_date": F.col("purchase_date").try_cast("date"),
            "is_sealed": F.coalesce(F.col("is_sealed").try_cast("boolean"), F.lit(False)),
        }
    )


def name_index(products: DataFrame) -> DataFrame:
    """One row per exact product name: how many products have it, and the lowest id."""
    return products.groupBy(F.col("name").alias("raw_product_name")).agg(
        F.count("*").alias("hits"), F.min("id_product").alias("named_id")
    )


def match_products(typed: DataFrame, products: DataFrame) -> DataFrame:
    """Add matched_id_product, match_status, match_confidence, error_message.

    A given id is decisive: known means ready, unknown means waiting, and the name is not
    tried.  Without id the exact name decides.  Both lookup tables are unique on their
    key, so a frequent name cannot multiply rows, and rows without a key are spread like
    all others.
    """
    columns = typed.columns
    known = products.select(F.col("id_product").alias("provided_id_product"), F.lit(True).alias("_known"))
    keyed = typed.withColumn(
        "_name", F.when(F.col("provided_id_product").isNull(), F.col("raw_product_name"))
    )
    names = name_index(products).withColumnRenamed("raw_product_name", "_name")
    looked_up = spread_join(keyed, known, ["provided_id_product"], "left", ["import_row_id"])
    looked_up = spread_join(looked_up, names, ["_name"], "left", ["import_row_id"])

    given, has = F.col("provided_id_product").isNotNull(), F.col("_known").isNotNull()
    one = F.col("hits") == 1
    return looked_up.select(
        *columns,
        F.when(given, F.col("provided_id_product")).when(one, F.col("named_id")).alias("matched_id_product"),
        F.when(has | one, "ready_to_import")
        .when(given, "waiting_for_product")
        .otherwise("needs_review")
        .alias("match_status"),
        F.when(has, F.lit(EXACT_ID))
        .when(one, F.lit(EXACT_NAME))
        .when(~given, F.lit(NO_MATCH))
        .cast(CONFIDENCE)
        .alias("match_confidence"),
        F.when(given & ~has, MSG_WAITING)
        .when(F.col("hits") > 1, MSG_MANY)
        .when(~given & F.col("hits").isNull(), MSG_NO_MATCH)
        .alias("error_message"),
    )


def duplicate_marks(staging: DataFrame, imported: DataFrame) -> DataFrame:
    """(import_row_id, duplicate_error) of rows whose external id occurred earlier in the
    same batch or was imported before.

    The first occurrence per id is an aggregate that is combined before the shuffle; no
    window gathers all copies of an id.
    """
    rows = staging.filter("external_id IS NOT NULL").select(
        "import_row_id", "import_batch_id", "external_id", "record_index"
    )
    first = rows.groupBy("import_batch_id", "external_id").agg(F.min("record_index").alias("first_index"))
    done = imported.filter("external_id IS NOT NULL").select("external_id").distinct()
    # An id such as "1" is in every batch, so the batches of an id are spread as well.
    known = done.withColumn("_imported", F.lit(True))
    firsts = spread_join(first, known, ["external_id"], "left", ["import_batch_id"])
    marked = spread_join(
        rows, firsts, ["import_batch_id", "external_id"], "inner", ["import_row_id"]
    )
    return marked.select(
        "import_row_id",
        F.when(F.col("_imported"), MSG_IMPORTED)
        .when(F.col("record_index") > F.col("first_index"), MSG_REPEATED)
        .alias("duplicate_error"),
    ).filter("duplicate_error IS NOT NULL")


def match_staging(
    staging: DataFrame, products: DataFrame, imported: DataFrame, batch: DataFrame | None = None
) -> DataFrame:
    """Fresh staging rows (text columns) to validated and matched rows.  ``batch`` holds all
    rows of the batches concerned when ``staging`` is only a part of them.

    Field errors and duplicate external ids win over the match result: the status becomes
    error and the messages are combined, while matched id and confidence stay filled.
    """
    typed = with_typed_fields(staging)
    matched = match_products(typed, products)
    marks = duplicate_marks(staging if batch is None else batch, imported)
    judged = matched.join(by_shuffle(marks), "import_row_id", "left")
    blocking = F.nullif(F.concat_ws("; ", "field_error", "duplicate_error"), F.lit(""))
    return judged.withColumns(
        {
            "match_status": F.when(blocking.isNotNull(), "error").otherwise(F.col("match_status")),
            "error_message": F.coalesce(blocking, F.col("error_message")),
        }
    ).drop("field_error", "duplicate_error")


def re_evaluate(corrected: DataFrame, products: DataFrame, imported: DataFrame) -> DataFrame:
    """Staging after correction (text columns plus match_status): needs_review and error
    rows are judged like fresh ones, against all rows of their batch.  Rows in other states
    are left out."""
    open_rows = corrected.filter(F.col("match_status").isin("needs_review", "error"))
    fresh = open_rows.drop("match_status", "matched_id_product", "match_confidence", "error_message")
    return match_staging(fresh, products, imported, batch=corrected)


def possible_duplicates(staging: DataFrame, items: DataFrame) -> DataFrame:
    """Ready rows without external id that equal an existing item in product, language,
    condition, date and price (null equals null).  A warning only."""
    compared = ["id_product", "language", "condition", "purchase_date", "purchase_price"]
    rows = staging.filter(
        (F.col("match_status") == "ready_to_import") & F.col("external_id").isNull()
    ).withColumn("id_product", F.col("matched_id_product"))
    # A null becomes a value of its own next to the column, so that equal means equal.
    keys = [*compared, *[f"_no_{c}" for c in compared]]

    def comparable(df: DataFrame) -> DataFrame:
        filler = {"purchase_price": F.lit(0), "purchase_date": F.lit("1970-01-01").cast("date")}
        return df.withColumns({f"_no_{c}": F.col(c).isNull() for c in compared}).withColumns(
            {c: F.coalesce(c, filler.get(c, F.lit("") if c != "id_product" else F.lit(0))) for c in compared}
        )

    owned = comparable(items.select(*compared)).select(*keys).distinct()
    found = spread_join(comparable(rows), owned, keys, "left_semi", ["import_row_id"])
    return found.select(
        "import_row_id",
        "import_batch_id",
        *[F.when(~F.col(f"_no_{c}"), F.col(c)).alias(c) for c in compared],
    )


def promote(staging: DataFrame, run_ts) -> tuple[DataFrame, DataFrame]:
    """(new items, staging afterwards).  Ready rows become items, one per physical piece;
    their staging rows stay and are marked imported, so they are never promoted again."""
    now = as_instant(run_ts)
    ready = F.col("match_status") == "ready_to_import"
    text, money, date = (F.lit(None).cast(t) for t in ("string", MONEY, "date"))
    items = staging.filter(ready).select(
        surrogate_id(F.col("import_batch_id"), F.col("import_row_id")).alias("collection_item_id"),
        F.col("matched_id_product").alias("id_product"),
        "language", "condition", "acquisition_type", "purchase_price", "purchase_date", "is_sealed",
        F.lit(False).alias("is_graded"),
        text.alias("grading_company"),
        text.alias("grade"),
        "storage_location", "personal_note",
        F.lit(False).alias("is_sold"),
        money.alias("sold_price"),
        date.alias("sold_date"),
        now.alias("created_at"),
        now.alias("updated_at"),
    )
    after = staging.withColumns(
        {
            "imported_at": F.when(ready, now).otherwise(F.col("imported_at")),
            "match_status": F.when(ready, "imported").otherwise(F.col("match_status")),
        }
    )
    return items, after
