"""Registered queries: every operator on the given tables.

Each entry takes (spark, folder) and returns a lazy DataFrame.  Money is rounded to four
digits at the very end, so the results can be compared with plain SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradebinder.functions.dates import archive_name, pipeline_date, zone_date
from tradebinder.functions.text import matching_name
from tradebinder.operators import (
    archive,
    checks,
    constraints,
    mapping,
    matching,
    merge,
    normalize,
    profile,
    signals,
    validate,
    valuation,
    views,
)
from tradebinder.operators.lookup import by_shuffle
from tradebinder.plans.catalog import date_added_warnings as date_warnings
from tradebinder.plans.driver_tables import FIRST_RUN_TS, RUN_TS, DriverTables
from tradebinder.session import configure
from tradebinder.sources import csv_files, json_files, pages
from tradebinder.sources.archive import parse_archive_names

_QUERIES: dict[str, Callable[[DriverTables], DataFrame]] = {}
CHECK_DATE = "2024-01-20"


def query(function: Callable[[DriverTables], DataFrame]):
    _QUERIES[function.__name__] = function
    return function


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bound(function):
        return lambda spark, folder: function(DriverTables(configure(spark), folder))

    return {name: bound(function) for name, function in _QUERIES.items()}


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Money columns as doubles with four digits; -0.0 becomes 0.0."""
    return df.withColumns(
        {c: F.round(F.col(c).cast("double"), 4) + F.lit(0.0) for c in columns}
    )


def _longs(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("bigint") for c in columns})


# --- prices ------------------------------------------------------------------------


@query
def latest_prices(t: DriverTables) -> DataFrame:
    rows = views.latest_prices(t.prices(), t.products())
    return _rounded(rows, "trend", "avg30", "low", "estimated_market_value")


@query
def price_history(t: DriverTables) -> DataFrame:
    rows = views.product_price_history(t.prices(), t.products())
    return _rounded(rows, "trend", "avg30", "estimated_market_value")


@query
def price_batch_dedupe(t: DriverTables) -> DataFrame:
    rows = merge.last_record_per_key(t.price_batch(), ["snapshot_date", "id_product"], "seq")
    return _rounded(rows, "trend", "avg30", "low")


@query
def merge_prices_state(t: DriverTables) -> DataFrame:
    """State from the days before the 20th, then a batch with all days from the 15th on."""
    batch, values = t.price_batch(), t.PRICE_VALUES
    nothing = batch.filter(F.lit(False)).withColumn("created_at", F.lit(None).cast("timestamp"))
    early = batch.filter(F.col("snapshot_date") < "2024-01-20")
    late = batch.filter(F.col("snapshot_date") >= "2024-01-15")
    state = merge.merge_price_snapshots(nothing, early, FIRST_RUN_TS, "seq", values)
    state = merge.merge_price_snapshots(state, late, RUN_TS, "seq", values)
    return _rounded(
        state.withColumn("created_at", F.to_date("created_at")), "trend", "avg30", "low"
    )


@query
def archive_replay(t: DriverTables) -> DataFrame:
    """JSON documents -> canonical file per day -> parse -> normalize -> upsert."""
    documents = t.documents()
    canonical = archive.canonical_files(documents.select("file_name")).select("file_name", "snapshot_date")
    parsed = json_files.price_documents(documents.join(canonical, "file_name"))
    rows = normalize.normalize_prices(json_files.explode_records(parsed), F.col("snapshot_date"))
    nothing = rows.filter(F.lit(False)).withColumn("created_at", F.lit(None).cast("timestamp"))
    state = merge.merge_price_snapshots(nothing, rows, RUN_TS)
    return _rounded(
        state.select(
            "snapshot_date", "id_product", "id_category", "trend", "avg30", "trend_holo",
            zone_date(F.col("source_created_at"), "UTC").alias("source_date"),
            F.col("avg").isNull().alias("avg_absent"),
        ),
        "trend", "avg30", "trend_holo",
    )


@query
def replay_comparison(t: DriverTables) -> DataFrame:
    """Rows per day from replayed documents next to the rows stored for the day."""
    documents = t.documents()
    canonical = archive.canonical_files(documents.select("file_name")).select("file_name", "snapshot_date")
    parsed = json_files.price_documents(documents.join(canonical, "file_name"))
    rows = normalize.normalize_prices(json_files.explode_records(parsed), F.col("snapshot_date"))
    return merge.replay_comparison(rows, t.prices())


@query
def price_guide_violations(t: DriverTables) -> DataFrame:
    """Validation of event payloads as price documents: none of them has the fields."""
    documents = t.given("events").select(
        F.col("event_id").cast("string").alias("file_name"),
        F.when(F.col("event_type") == "view", F.concat(F.lit("["), "props", F.lit("]")))
        .when(F.col("event_type") == "click", F.lit("[]"))
        .when(F.col("event_type") == "error", F.concat(F.lit('{"priceGuides": ['), "props"))
        .when(
            F.col("event_type") == "signup",
            F.concat(F.lit('{"priceGuides": [{"idProduct": '), F.get_json_object("props", "$.k"), F.lit("}]}")),
        )
        .otherwise(F.col("props"))
        .alias("content"),
    )
    parsed = json_files.price_documents(documents)
    found = validate.violations(validate.judged_prices(parsed))
    return found.select("file_name", F.col("record_index").cast("bigint").alias("record_index"), "reason")


@query
def top_movers(t: DriverTables) -> DataFrame:
    latest = views.latest_prices(t.prices(), t.products())
    return _rounded(views.top_movers(latest, 50), "trend", "avg30", "move_percent")


@query
def watchlist_overview(t: DriverTables) -> DataFrame:
    products = t.products()
    latest = views.latest_prices(t.prices(), products)
    rows = views.watchlist_overview(t.watchlist(), latest, products)
    return _rounded(rows, "target_price", "trend", "avg30", "estimated_market_value")


# --- checks ------------------------------------------------------------------------


@query
def check_missing_products(t: DriverTables) -> DataFrame:
    return checks.missing_products_check(t.prices(), t.products(), CHECK_DATE)


@query
def check_products_without_prices(t: DriverTables) -> DataFrame:
    rows = views.products_without_prices(t.products(), t.prices(), CHECK_DATE)
    return rows.withColumn("last_seen_at", F.to_date("last_seen_at"))


@query
def products_without_prices_now(t: DriverTables) -> DataFrame:
    rows = views.products_without_prices(t.products(), t.prices(), t.signal_date())
    return rows.withColumn("last_seen_at", F.to_date("last_seen_at"))


@query
def check_category_mismatch(t: DriverTables) -> DataFrame:
    return checks.category_mismatch(t.prices(), t.products(), CHECK_DATE)


@query
def check_duplicates(t: DriverTables) -> DataFrame:
    return checks.duplicate_snapshots(t.price_batch())


@query
def check_empty(t: DriverTables) -> DataFrame:
    """The day after the last snapshot has no rows."""
    return checks.empty_snapshot_check(t.prices(), F.date_add(t.signal_date(), 1))


@query
def check_drift(t: DriverTables) -> DataFrame:
    return checks.record_count_series(t.price_batch(), 2.0)


@query
def check_drift_on_date(t: DriverTables) -> DataFrame:
    return checks.record_count_drift(t.price_batch(), CHECK_DATE, 0.5)


@query
def daily_checks(t: DriverTables) -> DataFrame:
    counts = checks.daily_counts(t.prices(), t.products(), CHECK_DATE)
    return checks.daily_checks(counts)


@query
def daily_run_status(t: DriverTables) -> DataFrame:
    counts = checks.daily_counts(t.prices(), t.products(), CHECK_DATE)
    return checks.run_status(checks.daily_checks(counts))


@query
def daily_summary(t: DriverTables) -> DataFrame:
    return checks.daily_summary(checks.daily_counts(t.prices(), t.products(), CHECK_DATE))


@query
def daily_summary_with_defects(t: DriverTables) -> DataFrame:
    """The report of a day on which rising prices come twice and falling ones again without an id."""
    prices = t.prices()
    repeated = prices.where("trend > avg30")
    lost = prices.where("trend < avg30").withColumn("id_product", F.lit(None).cast("long"))
    days = prices.unionByName(repeated).unionByName(lost)
    return checks.daily_summary(checks.daily_counts(days, t.products(), CHECK_DATE)).select(
        "snapshot_date", "rows_loaded", "duplicate_keys", "missing_ids", "missing_products", "category_mismatch", "products_without_prices"
    )


@query
def collection_issues(t: DriverTables) -> DataFrame:
    return checks.collection_issues(t.items(), "2001-07-01")


# --- catalog -----------------------------------------------------------------------


@query
def merge_products_state(t: DriverTables) -> DataFrame:
    state = merge.merge_products(t.known_products(), t.catalog(), RUN_TS)
    return state.select(
        "id_product", "name", "id_category", "id_expansion", "product_group", "source_file",
        "is_active_in_catalog",
        F.to_date("first_seen_at").alias("first_seen"),
        F.to_date("last_seen_at").alias("last_seen"),
        F.to_date("updated_at").alias("updated"),
        "catalog_change",
    )


@query
def missing_products(t: DriverTables) -> DataFrame:
    return merge.missing_products(t.known_products(), t.catalog()).select("id_product", "name")


@query
def new_product_ids(t: DriverTables) -> DataFrame:
    return merge.new_product_ids(t.known_products(), t.catalog()).select("record_index", "id_product")


@query
def catalog_run_summary(t: DriverTables) -> DataFrame:
    merged = merge.merge_products(t.known_products(), t.catalog(), RUN_TS)
    return profile.catalog_run_summary(merged)


@query
def cross_file_duplicates(t: DriverTables) -> DataFrame:
    """Every part is in the file of its group; small singles are in the other file too,
    those of size 6 under another name."""
    rows = t.products().withColumn("record_index", F.col("id_product"))
    singles = rows.filter("product_group = 'single'")
    again = singles.filter("id_metacard <= 6").withColumn(
        "name", F.when(F.col("id_metacard") == 6, F.upper("name")).otherwise(F.col("name"))
    )
    nonsingles = rows.filter("product_group = 'non_single'").unionByName(again)
    found = merge.cross_file_duplicates(singles, nonsingles)
    return found.select(
        "id_product", "conflicting",
        F.col("single_record.name").alias("single_name"),
        F.col("non_single_record.name").alias("non_single_name"),
    )


@query
def catalog_overview(t: DriverTables) -> DataFrame:
    return profile.catalog_overview(t.products())


@query
def products_by_expansion(t: DriverTables) -> DataFrame:
    return profile.products_by(t.products(), "id_expansion")


@query
def products_by_category(t: DriverTables) -> DataFrame:
    return profile.products_by(t.products(), "category_name")


@query
def products_by_source_file(t: DriverTables) -> DataFrame:
    return profile.products_by(t.products(), "source_file")


@query
def column_profile(t: DriverTables) -> DataFrame:
    return profile.profile_columns(
        t.given("customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    )


@query
def record_profile(t: DriverTables) -> DataFrame:
    """Structure report of JSON payloads."""
    records = t.given("events").select(F.from_json("props", "map<string,string>").alias("record"))
    return profile.profile_records(records)


# --- expansions and sets -----------------------------------------------------------


@query
def products_enriched(t: DriverTables) -> DataFrame:
    expansions = t.expansions().filter("release_date IS NOT NULL")
    rows = views.products_enriched(t.products(), expansions)
    return _longs(rows.drop("date_added", "updated_at"), "expansion_card_count")


@query
def missing_expansions(t: DriverTables) -> DataFrame:
    return checks.missing_expansions(t.products(), t.expansions())


@query
def products_without_expansion(t: DriverTables) -> DataFrame:
    return checks.products_without_expansion(t.products(), t.expansions())


@query
def expansion_coverage(t: DriverTables) -> DataFrame:
    return checks.expansion_coverage(t.products(), t.expansions())


@query
def expansion_seed(t: DriverTables) -> DataFrame:
    rows = t.products().select(
        "id_expansion", "id_product", "name",
        F.col("source_file").alias("file_name"), F.col("id_product").alias("record_index"),
    )
    return checks.expansion_seed(rows)


@query
def mapping_candidates(t: DriverTables) -> DataFrame:
    rows = mapping.mapping_candidates(t.expansions(), t.sets(), RUN_TS)
    return _rounded(
        rows.select(
            "id_expansion", "tcg_set_id", "match_status", "match_method", "match_confidence",
            "is_primary_mapping", "needs_review", "candidate_count",
        ),
        "match_confidence",
    )


@query
def mapping_keys(t: DriverTables) -> DataFrame:
    return mapping.mapping_keys(t.sets())


@query
def trusted_mappings(t: DriverTables) -> DataFrame:
    mappings = mapping.mapping_candidates(t.expansions(), t.sets(), RUN_TS)
    rows = views.trusted_mappings(mappings, t.expansions(), t.sets())
    return _longs(
        _rounded(rows, "match_confidence").drop("symbol_url", "logo_url"),
        "market_card_count", "printed_total", "total_cards", "secret_card_count",
    )


@query
def mappings_for_review(t: DriverTables) -> DataFrame:
    market, official = views.review_columns(t.expansions(), t.sets())
    mappings = mapping.mapping_candidates(t.expansions(), t.sets(), RUN_TS, market=market, official=official)
    rows = views.mappings_for_review(mappings, t.expansions(), t.sets())
    return _rounded(rows, "match_confidence").drop("notes")


@query
def price_report_chain(t: DriverTables) -> DataFrame:
    mappings = mapping.mapping_candidates(t.expansions(), t.sets(), RUN_TS)
    rows = views.price_report_chain(
        t.prices(), t.products(), t.expansions(), mappings, t.sets(), t.signal_date()
    )
    money = _rounded(rows, "trend", "avg30", "estimated_market_value", "mapping_confidence")
    return _longs(
        money.drop("symbol_url", "logo_url"),
        "months_since_release", "printed_total", "total_cards", "secret_card_count",
    )


@query
def set_issues(t: DriverTables) -> DataFrame:
    return checks.set_issues(t.sets())


@query
def sets_by_activity(t: DriverTables) -> DataFrame:
    return checks.sets_by_activity(t.sets())


@query
def series_overview(t: DriverTables) -> DataFrame:
    return checks.series_overview(t.sets())


@query
def latest_sets(t: DriverTables) -> DataFrame:
    return _longs(checks.latest_sets(t.sets()), "printed_total", "total_cards", "secret_card_count")


@query
def find_sets(t: DriverTables) -> DataFrame:
    found = checks.find_sets(t.sets(), "supplier#000000005", "set7")
    return found.select("tcg_set_id", "name_en", "series_en", "release_date", "is_active")


@query
def duplicate_sets(t: DriverTables) -> DataFrame:
    """The duplicate-id check, run on the codes a set shares with others of its series."""
    return checks.duplicate_sets(t.sets().select(F.col("series_en").alias("tcg_set_id")))


@query
def normalized_names(t: DriverTables) -> DataFrame:
    return t.sets().select(
        "tcg_set_id", "name_en",
        matching_name(F.col("name_en"), F.col("series_en")).alias("matching_name"),
    )


# --- collection --------------------------------------------------------------------


def _valuation(t: DriverTables):
    products = t.products()
    return t.items(), products, views.latest_prices(t.prices(), products)


@query
def collection_current_value(t: DriverTables) -> DataFrame:
    rows = valuation.collection_current_value(*_valuation(t))
    return _rounded(
        rows, "purchase_price", "estimated_market_value", "estimated_gain_loss",
        "estimated_gain_loss_percent",
    )


@query
def collection_summary(t: DriverTables) -> DataFrame:
    rows = valuation.collection_summary(*_valuation(t))
    return _rounded(
        rows.select(
            "*",
            F.col("most_valuable_item.collection_item_id").alias("best_item"),
            F.col("most_valuable_item.estimated_market_value").alias("best_value"),
        ).drop("most_valuable_item"),
        "total_purchase_price", "total_estimated_market_value", "total_estimated_gain_loss",
        "average_item_value", "best_value",
    )


def _value_by(t: DriverTables, column: str) -> DataFrame:
    rows = valuation.value_by(*_valuation(t), column)
    return _rounded(rows, "estimated_market_value", "unrealized_gain_loss")


@query
def value_by_group(t: DriverTables) -> DataFrame:
    return _value_by(t, "product_group")


@query
def value_by_expansion(t: DriverTables) -> DataFrame:
    return _value_by(t, "id_expansion")


@query
def value_by_category(t: DriverTables) -> DataFrame:
    return _value_by(t, "id_category")


@query
def unrealized_gain_loss(t: DriverTables) -> DataFrame:
    rows = valuation.unrealized_gain_loss(*_valuation(t))
    return _rounded(rows, "purchase_price", "estimated_market_value", "unrealized_gain_loss")


# --- signals -----------------------------------------------------------------------

LOOKBACKS = (7, 14, 28)


def _signal_rows(rows: DataFrame) -> DataFrame:
    money = _rounded(rows, "signal_value", "reference_value", "current_value")
    return _longs(money, "lookback_days").drop("created_at", "signal_description")


def _base(t: DriverTables) -> DataFrame:
    points = signals.price_points(t.prices(), t.signal_date(), LOOKBACKS)
    return signals.signal_base(t.products(), points, t.signal_date())


@query
def signal_growth(t: DriverTables) -> DataFrame:
    return _signal_rows(signals.growth(_base(t), t.signal_date(), RUN_TS, LOOKBACKS))


@query
def signal_sealed_growth(t: DriverTables) -> DataFrame:
    return _signal_rows(signals.sealed_growth(_base(t), t.signal_date(), RUN_TS, LOOKBACKS))


@query
def signal_price_spike(t: DriverTables) -> DataFrame:
    return _signal_rows(signals.price_spike(_base(t), t.signal_date(), RUN_TS))


@query
def signal_new_product(t: DriverTables) -> DataFrame:
    rows = signals.new_product(t.products(), t.signal_date(), RUN_TS)
    return _signal_rows(rows.withColumn("text", F.col("signal_description")))


@query
def signal_gain_loss(t: DriverTables) -> DataFrame:
    items, _, latest = _valuation(t)
    return _signal_rows(signals.collection_gain_loss(items, latest, t.signal_date(), RUN_TS))


@query
def signal_missing_price(t: DriverTables) -> DataFrame:
    return _signal_rows(signals.missing_price_data(_base(t), t.signal_date(), RUN_TS))


@query
def signal_buy_opportunity(t: DriverTables) -> DataFrame:
    """The 90-day rule on a 28-day window, as the given history is 30 days long."""
    rows = signals.potential_buy_opportunity(_base(t), t.signal_date(), RUN_TS, history_days=28)
    return _signal_rows(rows)


def _all_signals(t: DriverTables) -> DataFrame:
    points = signals.price_points(t.prices(), t.signal_date(), LOOKBACKS)
    return signals.all_signals(points, t.products(), t.items(), t.signal_date(), RUN_TS, LOOKBACKS)


@query
def all_signals(t: DriverTables) -> DataFrame:
    return _signal_rows(_all_signals(t))


@query
def top_growth(t: DriverTables) -> DataFrame:
    return _signal_view(t, "top_growth_products")


# --- collection import -------------------------------------------------------------


@query
def staging_match(t: DriverTables) -> DataFrame:
    rows = matching.match_staging(t.staging(), t.products(), t.imported())
    return _rounded(
        rows.select(
            "import_row_id", "import_batch_id", "external_id", "matched_id_product", "language",
            "condition", "acquisition_type", "purchase_price", "purchase_date", "is_sealed",
            "match_status", "match_confidence", "error_message",
        ),
        "purchase_price", "match_confidence",
    )


@query
def staging_duplicates(t: DriverTables) -> DataFrame:
    return matching.duplicate_marks(t.staging(), t.imported())


def _promoted(t: DriverTables):
    matched = matching.match_staging(t.staging(), t.products(), t.imported())
    return matching.promote(matched.withColumn("imported_at", F.lit(None).cast("timestamp")), RUN_TS)


@query
def promoted_items(t: DriverTables) -> DataFrame:
    items, _ = _promoted(t)
    return _rounded(items, "purchase_price").select(
        "collection_item_id", "id_product", "language", "condition", "acquisition_type",
        "purchase_price", "purchase_date", "is_sealed", "is_graded", "is_sold",
    )


@query
def staging_after_promotion(t: DriverTables) -> DataFrame:
    _, after = _promoted(t)
    return after.groupBy("match_status").agg(
        F.count("*").alias("import_rows"), F.count("imported_at").alias("stamped")
    )


@query
def recheck_waiting(t: DriverTables) -> DataFrame:
    """Match against the smaller catalog, then recheck after the full one is loaded."""
    matched = matching.match_staging(t.staging(), t.known_products(), t.imported())
    rechecked = merge.recheck_waiting(matched, t.products())
    return rechecked.select("import_row_id", "matched_id_product", "match_status", "error_message")


@query
def possible_duplicates(t: DriverTables) -> DataFrame:
    matched = matching.match_staging(t.staging(), t.products(), t.imported())
    owned = t.given("supplier").select(
        (F.col("s_suppkey") * 2).alias("id_product"),
        F.lit("EN").alias("language"),
        F.lit("Near Mint").alias("condition"),
        F.lit("2024-01-15").cast("date").alias("purchase_date"),
        F.when(F.col("s_nationkey") < 12, F.lit(None)).otherwise(F.floor("s_acctbal")).cast("decimal(18,4)").alias(
            "purchase_price"
        ),
    )
    nullable = matched.withColumn(
        "purchase_price", F.when(F.col("purchase_price") > 5000, F.lit(None)).otherwise(F.col("purchase_price"))
    )
    return _rounded(matching.possible_duplicates(nullable, owned), "purchase_price")


# --- archive and constraints -------------------------------------------------------


@query
def canonical_files(t: DriverTables) -> DataFrame:
    return _longs(archive.canonical_files(t.listing()), "rerun_number")


@query
def superseded_files(t: DriverTables) -> DataFrame:
    return _longs(archive.superseded_files(t.listing()), "rerun")


@query
def next_archive_name(t: DriverTables) -> DataFrame:
    """Next name for every user on the check date, archived or not."""
    requested = t.given("events").select(
        F.concat(F.lit("guide_"), F.col("user_id").cast("string")).alias("prefix"),
        F.lit(CHECK_DATE).cast("date").alias("snapshot_date"),
    ).distinct()
    return archive.next_archive_names(t.listing(), requested)


@query
def archive_gaps(t: DriverTables) -> DataFrame:
    return archive.archive_gaps(t.listing())


@query
def constraint_violations(t: DriverTables) -> DataFrame:
    items, products = t.items(), t.products()
    parts = [
        constraints.rule_violations(items, "collection_item_id", constraints.item_rules()),
        constraints.rule_violations(products, "id_product", constraints.product_rules()),
        constraints.rule_violations(t.expansions(), "id_expansion", constraints.expansion_rules()),
        constraints.rule_violations(t.sets(), "tcg_set_id", constraints.set_rules()),
        constraints.foreign_key_violations(
            items, "items.product_exists", "collection_item_id", "id_product", products, "id_product"
        ),
        constraints.unique_violations(
            t.price_batch(), "prices.key", ["snapshot_date", "id_product"]
        ),
        constraints.rule_violations(
            t.staging().withColumns(
                {"match_status": F.lower("import_batch_id"), "match_confidence": F.col("purchase_price").try_cast("double") / 1000}
            ),
            "import_row_id", constraints.staging_rules(),
        ),
        constraints.unique_violations(t.items(), "items.key", ["collection_item_id"]),
        constraints.active_watch_violations(
            t.watchlist().withColumn("id_product", F.floor(F.col("id_product") / 28).cast("bigint"))
        ),
    ]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return union


@query
def page_links(t: DriverTables) -> DataFrame:
    return pages.distinct_links(pages.page_links(t.given("pages")))


@query
def resolved_links(t: DriverTables) -> DataFrame:
    """Addresses that the links of the given pages lead to, every page with a comment, references and relative links added."""
    given = t.given("pages")
    added = F.concat(
        F.lit('<!-- <a href="/gone">gone</a> -->'), "html",
        F.lit('<a title="a > b" HREF = \'../x/./y?a=1&amp;b=2#f\'>Caf&eacute; &#8211; &#x263A; '), F.col("page_id").cast("string"),
        F.lit('</a><a href="#top">Top</a><a href=?q=1>Query</a><script>"<a href=/s>s</a>"</script>'),
    )
    links = pages.resolved_links(given.withColumn("html", added))
    return links.groupBy("page_id", "url", "link_text").agg(F.count("*").alias("occurrences"))


@query
def card_links(t: DriverTables) -> DataFrame:
    """Cards in links below the site root, over the pages with a card suffix."""
    return pages.card_links(t.card_pages(), "/", "Whole site").drop("place")


# --- source formats ----------------------------------------------------------------


@query
def catalog_rows(t: DriverTables) -> DataFrame:
    records = json_files.explode_records(json_files.catalog_documents(t.catalog_files()))
    rows = normalize.normalize_catalog(records, "products_singles_6.json")
    return rows.withColumn("date_added", F.to_date("date_added")).drop("file_name", "record_index")


@query
def catalog_violations(t: DriverTables) -> DataFrame:
    parsed = json_files.catalog_documents(t.catalog_files())
    found = validate.violations(validate.judged_catalog(parsed, "products_singles_6.json"))
    return found.select("file_name", F.col("record_index").cast("bigint").alias("record_index"), "reason")


@query
def date_added_warnings(t: DriverTables) -> DataFrame:
    records = json_files.explode_records(json_files.catalog_documents(t.catalog_files()))
    return date_warnings(records).select("file_name")


@query
def lenient_expansion_seed(t: DriverTables) -> DataFrame:
    records = json_files.explode_records(json_files.lenient_catalog_documents(t.catalog_files()))
    return checks.expansion_seed(normalize.lenient_products(records))


@query
def set_rows(t: DriverTables) -> DataFrame:
    rows = normalize.normalize_sets(json_files.set_documents(t.set_files()))
    return _longs(rows, "printed_total", "total_cards", "secret_card_count")


@query
def expansion_rows(t: DriverTables) -> DataFrame:
    rows = normalize.normalize_expansions(t.raw_expansions())
    kept = ["id_expansion", "name_en", "name_de", "slug", "release_date", "card_count", "is_active"]
    return _longs(rows.select(*kept), "card_count")


@query
def expansion_metadata_errors(t: DriverTables) -> DataFrame:
    return validate.expansion_metadata_errors(t.raw_expansions())


@query
def expansion_file_integrity(t: DriverTables) -> DataFrame:
    return validate.expansion_file_integrity(t.raw_expansions())


@query
def staged_rows(t: DriverTables) -> DataFrame:
    return csv_files.stage_collection(t.upload(), "upload-1").drop(
        "purchase_date", "is_sealed", "storage_location", "personal_note"
    )


@query
def file_outcomes(t: DriverTables) -> DataFrame:
    """Payload files that are expected under the keys of the orders."""
    documents = t.given("events").select(
        F.col("event_id").cast("string").alias("file_name"),
        F.when(F.col("event_type") == "error", F.lit("{"))
        .when(F.col("event_type") == "click", F.lit('{"priceGuides": []}'))
        .otherwise(F.concat(F.lit("["), "props", F.lit("]")))
        .alias("content"),
    )
    expected = t.given("orders").select(F.col("o_orderkey").cast("string").alias("file_name"))
    return archive.file_outcomes(json_files.price_documents(documents), expected)


@query
def archive_names(t: DriverTables) -> DataFrame:
    """File names taken apart and built again."""
    parsed = parse_archive_names(t.listing())
    rebuilt = archive_name(F.col("prefix"), F.col("snapshot_date"), F.col("rerun"))
    return _longs(parsed.withColumn("rebuilt", rebuilt), "rerun")


@query
def pipeline_dates(t: DriverTables) -> DataFrame:
    """Local calendar date of order instants spread over the hours of the day."""
    hours = F.make_dt_interval(F.lit(0), (F.col("o_custkey") % 24).cast("int"))
    instants = t.given("orders").select(
        "o_orderkey", (F.col("o_orderdate").cast("timestamp") + hours).alias("at")
    )
    return instants.select("o_orderkey", pipeline_date(instants, "at").alias("local_date"))


@query
def merge_sets_state(t: DriverTables) -> DataFrame:
    """Sets up to 120 printed cards are known; the batch renames those from 60 cards on."""
    text = F.lit(None).cast("string")
    full = t.sets().withColumns(
        {
            "legalities": text, "notes": text, "source_updated_at": F.lit(None).cast("timestamp_ntz"),
            "record_index": F.lit(0).cast("bigint"),
        }
    )
    first = F.lit(FIRST_RUN_TS).cast("timestamp")
    target = full.filter("printed_total <= 120").withColumns({"created_at": first, "updated_at": first})
    batch = full.filter("printed_total >= 60").withColumns(
        {"name_en": F.upper("name_en"), "is_active": F.nullif("is_active", F.lit(False))}
    )
    state = merge.merge_sets(target, batch, RUN_TS)
    return state.select(
        "tcg_set_id", "name_en", "release_date", "is_active",
        F.to_date("created_at").alias("created"), F.to_date("updated_at").alias("updated"),
    )


@query
def merge_expansions_state(t: DriverTables) -> DataFrame:
    """Expansions up to 6000 cards are known; the batch renames those from 3000 cards on."""
    text = F.lit(None).cast("string")
    full = t.expansions().withColumns(
        {"source_url_en": text, "source_url_de": text, "notes": text, "record_index": F.lit(0).cast("bigint")}
    )
    first = F.lit(FIRST_RUN_TS).cast("timestamp")
    target = full.filter("card_count <= 6000").withColumns({"created_at": first, "updated_at": first})
    batch = full.filter("card_count >= 3000").withColumn("name_en", F.upper("name_en"))
    state = merge.merge_expansions(target, batch, RUN_TS)
    return state.select(
        "id_expansion", "name_en", "series_en", "is_active",
        F.to_date("created_at").alias("created"), F.to_date("updated_at").alias("updated"),
    )


@query
def set_counts(t: DriverTables) -> DataFrame:
    stamped = t.sets().withColumns(
        {"created_at": F.col("release_date"), "updated_at": F.when(F.col("is_active"), F.col("release_date"))}
    )
    return checks.set_counts(stamped)


@query
def staging_re_evaluated(t: DriverTables) -> DataFrame:
    """Open rows after every condition, language and date was corrected."""
    matched = matching.match_staging(t.staging(), t.products(), t.imported())
    states = by_shuffle(matched.select("import_row_id", "match_status"))
    corrected = t.staging().join(states, "import_row_id").withColumns(
        {"condition": F.lit("Good"), "language": F.lit("FR"), "purchase_date": F.lit("2024-02-29")}
    )
    rows = matching.re_evaluate(corrected, t.products(), t.imported())
    return rows.select("import_row_id", "language", "purchase_date", "match_status", "error_message")


def _signal_view(t: DriverTables, view: str) -> DataFrame:
    kind, date = signals.SIGNAL_VIEWS[view], t.signal_date()
    points = signals.price_points(t.prices(), date, LOOKBACKS)
    rows = signals.signals_of(kind, points, t.products(), t.items(), date, RUN_TS, LOOKBACKS)
    rows = signals.signal_view(rows, t.products(), kind)
    money = _rounded(rows, "signal_value", "reference_value", "current_value")
    return _longs(money, "lookback_days")


@query
def recent_price_spikes(t: DriverTables) -> DataFrame:
    return _signal_view(t, "recent_price_spikes")


@query
def new_products(t: DriverTables) -> DataFrame:
    return _signal_view(t, "new_products")


@query
def collection_gains(t: DriverTables) -> DataFrame:
    return _signal_view(t, "collection_gains")


@query
def collection_losses(t: DriverTables) -> DataFrame:
    return _signal_view(t, "collection_losses")


def flagship(spark: SparkSession, folder: str) -> DataFrame:
    return registered()["latest_prices"](spark, folder)
