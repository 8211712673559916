import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tradebinder import schemas as S
from tradebinder.operators import (
    checks,
    constraints,
    keyed,
    mapping,
    matching,
    merge,
    profile,
    signals,
    valuation,
    views,
)

T1, T2 = "2026-07-01 06:00:00", "2026-07-08 06:00:00"
DAY, PREV = datetime.date(2026, 7, 3), datetime.date(2026, 7, 2)


def price_rows(spark, rows, day=DAY):
    """(id_product, trend, avg30, id_category) tuples to snapshot rows."""
    frame = spark.createDataFrame(
        [(i, r[0], r[1], r[2], r[3], day) for i, r in enumerate(rows)],
        "record_index long, id_product long, trend double, avg30 double, id_category long, snapshot_date date",
    )
    missing = [c for c in S.PRICE_VALUES if c not in frame.columns]
    types = {f.name: f.dataType for f in S.PRICE_SNAPSHOTS.fields}
    frame = frame.withColumns({c: F.lit(None).cast(types[c]) for c in missing})
    return frame.withColumns({c: F.col(c).cast(types[c]) for c in S.PRICE_VALUES})


def empty(spark, name):
    return spark.createDataFrame([], S.TABLES[name])


def catalog(spark, *rows):
    """(id, name) or (id, name, category) tuples to a catalog batch."""
    data = [(i, r[0], r[1], r[2] if len(r) > 2 else 7) for i, r in enumerate(rows)]
    frame = spark.createDataFrame(data, "record_index long, id_product long, name string, id_category long")
    return frame.select(
        "record_index", "id_product", "name", "id_category",
        F.lit("Cards").alias("category_name"), F.lit(3).cast("long").alias("id_expansion"),
        F.lit(None).cast("long").alias("id_metacard"), F.lit(None).cast("timestamp").alias("date_added"),
        F.lit("single").alias("product_group"), F.lit("products_singles_6.json").alias("source_file"),
    )


def products(spark, *rows, run_ts=T1):
    return merge.merge_products(empty(spark, "products"), catalog(spark, *rows), run_ts).drop("catalog_change")


# --- merges ------------------------------------------------------------------------


def test_price_upsert_keeps_first_created_at(spark):
    first = merge.merge_price_snapshots(
        empty(spark, "price_snapshots"), price_rows(spark, [(1, 5.0, None, 9), (2, 6.0, None, 9)]), T1
    )
    again = merge.merge_price_snapshots(first, price_rows(spark, [(1, 7.0, 8.0, 9), (3, 1.0, None, 9)]), T2)
    rows = {r.id_product: r for r in again.collect()}
    assert rows[1].trend == 7 and rows[1].avg30 == 8 and str(rows[1].created_at) == T1
    assert rows[2].trend == 6 and str(rows[3].created_at) == T2


def test_price_upsert_overwrites_with_null(spark):
    first = merge.merge_price_snapshots(empty(spark, "price_snapshots"), price_rows(spark, [(1, 5.0, 4.0, 9)]), T1)
    row = merge.merge_price_snapshots(first, price_rows(spark, [(1, None, 4.0, 9)]), T2).first()
    assert row.trend is None and row.avg30 == 4


def test_last_record_of_a_batch_wins(spark):
    batch = price_rows(spark, [(1, 5.0, None, 9), (1, 6.0, None, 9), (1, None, 2.0, 9)])
    row = merge.merge_price_snapshots(empty(spark, "price_snapshots"), batch, T1).collect()
    assert len(row) == 1 and row[0].trend is None and row[0].avg30 == 2


def test_price_upsert_is_idempotent(spark):
    batch = price_rows(spark, [(1, 5.0, None, 9), (1, 6.0, None, 9), (2, 6.0, 1.0, None)])
    once = merge.merge_price_snapshots(empty(spark, "price_snapshots"), batch, T1)
    twice = merge.merge_price_snapshots(once, batch, T2)
    assert sorted(map(str, once.collect())) == sorted(map(str, twice.collect()))
    nothing = merge.merge_price_snapshots(once, batch.filter("false"), T2)
    assert sorted(map(str, once.collect())) == sorted(map(str, nothing.collect()))


def test_price_merge_aggregates_by_hash(spark):
    batch = price_rows(spark, [(1, 5.0, None, 9)])
    merged = merge.merge_price_snapshots(empty(spark, "price_snapshots"), batch, T1)
    plan = merged._jdf.queryExecution().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan and "Window" not in plan


def test_hot_key_keeps_the_newest_row(spark):
    """A third of all rows share one key."""
    rows = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("key"), F.col("id").alias("seq"),
        (F.col("id") * 2).alias("value"),
    )
    newest = keyed.newest_per_key(rows, ["key"], "seq")
    hot = newest.filter("key = 0").first()
    assert hot.seq == 29997 and hot.value == 59994 and newest.count() == 20001


def test_product_lifecycle(spark):
    before = products(spark, (1, "Old"), (2, "Gone"))
    merged = merge.merge_products(before, catalog(spark, (1, "New"), (3, "Third")), T2)
    rows = {r.id_product: r for r in merged.collect()}
    assert (rows[1].name, rows[1].catalog_change) == ("New", "updated")
    assert str(rows[1].first_seen_at) == T1 and str(rows[1].last_seen_at) == T2
    assert not rows[2].is_active_in_catalog and rows[2].catalog_change == "deactivated"
    assert str(rows[2].last_seen_at) == T1 and str(rows[2].updated_at) == T2
    assert rows[3].catalog_change == "inserted" and rows[3].first_seen_at == rows[3].last_seen_at
    back = merge.merge_products(merged.drop("catalog_change"), catalog(spark, (2, "Back")), "2026-07-15 06:00:00")
    again = {r.id_product: r for r in back.collect()}
    assert again[2].is_active_in_catalog and str(again[2].first_seen_at) == T1
    assert not again[1].is_active_in_catalog


def test_empty_catalog_deactivates_all_and_upsert_alone_none(spark):
    before = products(spark, (1, "A"), (2, "B"))
    none = catalog(spark, (1, "A")).filter("false")
    assert merge.merge_products(before, none, T2).filter("is_active_in_catalog").count() == 0
    kept = merge.merge_products(before, none, T2, deactivate_missing=False)
    assert kept.filter("is_active_in_catalog").count() == 2
    assert merge.missing_products(before, none).count() == 2


def test_new_ids_keep_order_and_duplicates(spark):
    seen = catalog(spark, (5, "x"), (1, "A"), (5, "x"), (4, "y"))
    found = merge.new_product_ids(products(spark, (1, "A")), seen).orderBy("record_index")
    assert [r.id_product for r in found.collect()] == [5, 5, 4]


def test_cross_file_duplicates(spark):
    other = catalog(spark, (1, "A"), (2, "Other"), (9, "nine")).withColumns(
        {"product_group": F.lit("non_single"), "source_file": F.lit("products_nonsingles_6.json")}
    )
    found = merge.cross_file_duplicates(catalog(spark, (1, "first"), (1, "A"), (2, "B"), (3, "C")), other)
    assert {r.id_product: r.conflicting for r in found.collect()} == {1: False, 2: True}


def test_recheck_waiting(spark):
    staging = spark.createDataFrame(
        [(1, 10, "waiting_for_product", "m"), (2, 99, "waiting_for_product", "m"), (3, 10, "error", "e"),
         (4, None, "needs_review", "n"), (5, 10, None, "s")],
        "import_row_id long, matched_id_product long, match_status string, error_message string",
    )
    rows = merge.recheck_waiting(staging, products(spark, (10, "A"))).collect()
    assert {r.import_row_id: (r.match_status, r.error_message) for r in rows} == {
        1: ("ready_to_import", None), 2: ("waiting_for_product", "m"), 3: ("error", "e"), 4: ("needs_review", "n"),
        5: (None, "s"),
    }


def test_set_and_expansion_upserts(spark):
    batch = spark.createDataFrame(
        [(0, "s1", "One", None), (1, "s1", "Uno", None)], "record_index long, tcg_set_id string, name_en string, is_active boolean"
    )
    types = {f.name: f.dataType for f in S.TCG_SETS.fields}
    batch = batch.withColumns({c: F.lit(None).cast(types[c]) for c in S.SET_COLUMNS if c not in batch.columns})
    state = merge.merge_sets(empty(spark, "tcg_sets"), batch, T1)
    row = merge.merge_sets(state, batch.withColumn("name_en", F.lit("Eins")), T2).first()
    assert row.name_en == "Eins" and row.is_active and str(row.created_at) == T1 and str(row.updated_at) == T2


# --- checks ------------------------------------------------------------------------


def daily(spark, prices, catalog_rows, **options):
    counts = checks.daily_counts(prices, catalog_rows, DAY, **options)
    found = {r.check_name: r.violation_count for r in checks.daily_checks(counts).collect()}
    return found, checks.run_status(checks.daily_checks(counts)).first().status, checks.daily_summary(counts).first()


def test_clean_day(spark):
    found, status, summary = daily(spark, price_rows(spark, [(1, 5.0, 5.0, 7)]), products(spark, (1, "A")))
    assert set(found.values()) == {0} and status == summary.status == "success" and summary.warnings == ""


def test_warnings(spark):
    rows = price_rows(spark, [(1, 5.0, None, 8), (2, None, None, 7), (50, 1.0, 1.0, 7)])
    catalog_rows = products(spark, (1, "A"), (2, "B"), (3, "C"))
    found, status, summary = daily(spark, rows, catalog_rows)
    assert found == {
        "empty_price_snapshot": 0, "missing_products": 1, "products_without_prices": 2, "category_mismatch": 1,
        "record_count_drift": 0,
    }
    assert status == "success with warnings" and summary.rows_without_value == 1
    assert summary.warnings == "missing_products=1, products_without_prices=2, category_mismatch=1"
    assert [r.id_product for r in checks.missing_products_check(rows, catalog_rows, DAY).collect()] == [50]
    assert checks.category_mismatch(rows, catalog_rows, DAY).count() == 1
    without = views.products_without_prices(catalog_rows, rows, DAY)
    assert sorted(r.id_product for r in without.collect()) == [2, 3]


def test_empty_day_fails(spark):
    rows = price_rows(spark, [(1, 5.0, 5.0, 7)], PREV)
    found, status, summary = daily(spark, rows, products(spark, (1, "A")))
    assert found["empty_price_snapshot"] == 1 and status == summary.status == "failed"
    assert checks.empty_snapshot_check(rows, DAY).count() == 1
    assert checks.empty_snapshot_check(rows, PREV).count() == 0


@pytest.mark.parametrize("before, now, violated", [(10, 1, 1), (10, 9, 0), (10, 8, 0), (10, 12, 0), (10, 13, 1), (0, 5, 0)])
def test_drift(spark, before, now, violated):
    rows = price_rows(spark, [(i, 1.0, 1.0, 7) for i in range(now)])
    if before:
        rows = rows.unionByName(price_rows(spark, [(i, 1.0, 1.0, 7) for i in range(before)], PREV))
    assert checks.record_count_drift(rows, DAY).count() == violated
    found, _, _ = daily(spark, rows, products(spark, (1, "A")))
    assert found["record_count_drift"] == violated
    if before:
        known, _, _ = daily(spark, rows, products(spark, (1, "A")), previous_date=PREV)
        assert known["record_count_drift"] == violated
    series = {r.snapshot_date: r.drifted for r in checks.record_count_series(rows).collect()}
    assert series[DAY] is bool(violated)


def item_rows(spark, *rows):
    columns = (
        "collection_item_id string, id_product long, is_graded boolean, grading_company string, grade string, "
        "is_sold boolean, sold_price double, sold_date date, purchase_price double, purchase_date date, is_sealed boolean"
    )
    frame = spark.createDataFrame(list(rows), columns)
    return frame.withColumns(
        {"language": F.lit("DE"), "condition": F.lit("Near Mint"), "storage_location": F.lit(None).cast("string"),
         "acquisition_type": F.lit("pulled")}
    )


def item(id_, product=1, price=None, bought=None, sold=False, **other):
    return (
        id_, product, other.get("graded", False), other.get("company"), other.get("grade"), sold,
        other.get("sold_price"), other.get("sold_date"), price, bought, other.get("sealed", False),
    )


def test_collection_issues(spark):
    late = datetime.date(2030, 1, 1)
    rows = item_rows(
        spark,
        item("a", graded=True, sold_price=1.0, price=-3.0),
        item("b", price=2.0, bought=DAY),
        item("c", sold=True, sold_price=-1.0, sold_date=late, bought=late),
        item("d", sold=True),
    )
    found = sorted((r.collection_item_id, r.issue) for r in checks.collection_issues(rows, DAY).collect())
    assert found == sorted([
        ("a", checks.ISSUE_GRADED), ("a", checks.ISSUE_UNSOLD), ("a", checks.ISSUE_PURCHASE_PRICE),
        ("c", checks.ISSUE_SOLD_PRICE), ("c", checks.ISSUE_PURCHASE_DATE), ("c", checks.ISSUE_SOLD_DATE),
        ("d", checks.ISSUE_SOLD),
    ])


def test_set_checks(spark):
    columns = "tcg_set_id string, name_en string, printed_total int, total_cards int, secret_card_count int, release_date date, series_en string, ptcgo_code string"
    rows = spark.createDataFrame(
        [("s1", "One", 307, 304, 0, DAY, "S", "A"), (" ", None, -1, 2, None, None, "", None), ("s3", "T", 10, 12, 2, DAY, "S", "B")],
        columns,
    )
    found = {(r.tcg_set_id, r.issue) for r in checks.set_issues(rows).collect()}
    assert found == {
        ("s1", "total below printed total"), ("s1", "secret count differs"), (" ", "missing id"), (" ", "missing name"),
        (" ", "secret count differs"), (" ", "negative value"), (" ", "no release date"), (" ", "no series"), (" ", "no code"),
    }


# --- views and valuation -----------------------------------------------------------


def test_history_keeps_unknown_and_inactive_products(spark):
    before = products(spark, (1, "A"), (2, "B"))
    state = merge.merge_products(before, catalog(spark, (1, "A")), T2)
    rows = price_rows(spark, [(1, 1.0, 3.0, 7), (2, 2.0, None, 7), (9, None, None, 7)])
    history = {r.id_product: r for r in views.product_price_history(rows, state).collect()}
    assert history[1].estimated_market_value == 2 and history[2].is_active_in_catalog is False
    assert history[9].name is None


def test_collection_value_and_summary(spark):
    catalog_rows = products(spark, (1, "A"), (2, "B"), (3, "C"))
    latest = views.latest_prices(
        price_rows(spark, [(1, 30.0, 30.0, 7), (2, 10.0, None, 7)]).withColumns(
            {c: F.col(c).cast("double") for c in ("trend", "avg30", "low")}
        ),
        catalog_rows,
    )
    rows = item_rows(
        spark,
        item("x", 1, 20.0, datetime.date(2026, 2, 1), sealed=True), item("w", 1, None, None),
        item("v", 1, 0.0, datetime.date(2026, 1, 1)), item("u", 2, 40.0), item("s", 1, 1.0, sold=True), item("t", 3, 5.0),
    )
    value = {r.collection_item_id: r for r in valuation.collection_current_value(rows, catalog_rows, latest).collect()}
    assert set(value) == {"x", "w", "v", "u", "t"}
    assert (value["x"].estimated_gain_loss, value["x"].estimated_gain_loss_percent) == (10, 50)
    assert value["w"].estimated_gain_loss is None and value["v"].estimated_gain_loss_percent is None
    assert value["t"].estimated_market_value is None
    total = valuation.collection_summary(rows, catalog_rows, latest).first()
    assert (total.active_items, total.sold_items, total.sealed_items, total.single_items) == (5, 1, 1, 5)
    assert total.total_purchase_price == 65 and total.total_estimated_market_value == 100
    assert total.most_valuable_item.collection_item_id == "v"
    gain = valuation.unrealized_gain_loss(rows, catalog_rows, latest).first()
    assert gain.items == 3 and gain.unrealized_gain_loss == 10 + 30 - 30


# --- signals -----------------------------------------------------------------------


def history(spark, *rows):
    return spark.createDataFrame(
        [(p, datetime.date.fromisoformat(d), t, a) for p, d, t, a in rows],
        "id_product long, snapshot_date date, trend double, avg30 double",
    )


def old_products(spark, *ids, first="2025-01-01"):
    return products(spark, *[(i, f"P{i}") for i in ids], run_ts=f"{first} 12:00:00")


def test_growth_signal(spark):
    rows = history(
        spark, (1, "2026-06-01", 10.0, None), (1, "2026-07-01", 13.0, None), (2, "2026-06-01", 0.0, None),
        (2, "2026-07-01", 5.0, None), (3, "2026-06-28", 1.0, None), (3, "2026-07-01", 2.0, None),
    )
    aged = signals.signal_base(old_products(spark, 1, 2, 3), signals.price_points(rows, "2026-07-01"), "2026-07-01")
    found = signals.growth(aged, "2026-07-01", T1).collect()
    assert {(r.id_product, r.lookback_days, r.signal_strength) for r in found} == {(1, 7, "high"), (1, 30, "high")}
    month = next(r for r in found if r.lookback_days == 30)
    assert month.signal_value == pytest.approx(30) and (month.reference_value, month.current_value) == (10, 13)
    assert month.signal_description == "Product increased by 30.00% over the last 30 days."


def test_exact_dates_accept_no_older_snapshot(spark):
    rows = history(spark, (1, "2026-06-23", 10.0, None), (1, "2026-07-01", 13.0, None))
    exact = signals.price_points(rows, "2026-07-01", (7, 8), exact_dates=True).first()
    assert exact.trend_7_days_ago is None and exact.trend_8_days_ago == 10
    assert signals.price_points(rows, "2026-07-01", (7,)).first().trend_7_days_ago == 10


def test_new_products_have_no_growth_or_spike(spark):
    rows = history(spark, (1, "2026-06-20", 10.0, 5.0), (1, "2026-07-01", 13.0, 5.0))
    fresh = old_products(spark, 1, first="2026-06-20")
    aged = signals.signal_base(fresh, signals.price_points(rows, "2026-07-01"), "2026-07-01")
    assert signals.growth(aged, "2026-07-01", T1).count() == 0
    assert signals.price_spike(aged, "2026-07-01", T1).count() == 0
    new = signals.new_product(fresh, "2026-07-01", T1).first()
    assert new.signal_strength == "medium" and new.signal_value == 11


def test_spike_signal(spark):
    rows = history(spark, (1, "2026-07-01", 20.0, 15.0), (2, "2026-07-01", 20.0, 0.0))
    aged = signals.signal_base(old_products(spark, 1, 2), signals.price_points(rows, "2026-07-01"), "2026-07-01")
    found = signals.price_spike(aged, "2026-07-01", T1).collect()
    assert len(found) == 1 and found[0].signal_strength == "medium" and found[0].lookback_days is None
    assert found[0].signal_description == "Current trend price is 33.33% above avg30."


def test_gain_and_loss(spark):
    latest = spark.createDataFrame([(1, 30.0)], "id_product long, estimated_market_value double")
    rows = item_rows(
        spark, item("g", 1, 20.0), item("l", 1, 40.0), item("e", 1, 30.0), item("n", 1), item("z", 1, 0.0),
        item("s", 1, 1.0, sold=True),
    )
    found = {r.collection_item_id: r for r in signals.collection_gain_loss(rows, latest, DAY, T1).collect()}
    assert set(found) == {"g", "l", "z"}
    assert (found["g"].signal_type, found["g"].signal_value, found["g"].signal_strength) == ("collection_gain", 10, "high")
    assert (found["l"].signal_type, found["l"].signal_value, found["l"].signal_strength) == ("collection_loss", 10, "medium")
    assert found["z"].signal_strength is None
    assert found["g"].signal_description.endswith("10.00 EUR above its purchase price.")


def test_missing_price_signal(spark):
    rows = history(
        spark, (1, "2026-05-01", 1.0, None), (1, "2026-07-01", None, None), (2, "2026-07-01", None, 2.0),
        (4, "2026-06-25", None, 1.0), (4, "2026-07-01", None, None),
    )
    known = old_products(spark, 1, 2, 3, 4).unionByName(old_products(spark, 5, first="2026-07-01"))
    base = signals.signal_base(known, signals.price_points(rows, "2026-07-01"), "2026-07-01")
    found = signals.missing_price_data(base, "2026-07-01", T1).collect()
    assert {r.id_product: r.signal_strength for r in found} == {1: "high", 3: "high", 4: "low"}
    assert all(r.signal_value is None for r in found)
    later = signals.signal_base(known, signals.price_points(rows, "2026-07-03"), "2026-07-03")
    gap_day = signals.missing_price_data(later, "2026-07-03", T1, latest_snapshot="2026-07-01")
    assert {r.id_product for r in gap_day.collect()} == {1, 3, 4}


def test_buy_opportunity(spark):
    rows = history(spark, (1, "2026-04-01", 8.0, None), (1, "2026-07-01", 10.0, 12.0), (2, "2026-04-10", 8.0, None), (2, "2026-07-01", 10.0, 12.0))
    aged = signals.signal_base(old_products(spark, 1, 2), signals.price_points(rows, "2026-07-01"), "2026-07-01")
    assert [r.id_product for r in signals.potential_buy_opportunity(aged, "2026-07-01", T1).collect()] == [1]


def test_signal_ids_are_stable(spark):
    rows = history(spark, (1, "2026-07-01", 20.0, 15.0))
    aged = signals.signal_base(old_products(spark, 1), signals.price_points(rows, "2026-07-01"), "2026-07-01")
    ids = {signals.price_spike(aged, "2026-07-01", ts).first().signal_id for ts in (T1, T2)}
    assert len(ids) == 1


def test_signals_of_one_type_are_those_of_all(spark):
    rows = history(
        spark, (1, "2026-05-01", 10.0, None), (1, "2026-07-01", 20.0, 15.0), (2, "2026-06-20", 4.0, 9.0),
        (2, "2026-07-01", None, None), (4, "2026-07-01", 3.0, 2.0),
    )
    known = old_products(spark, 1, 2, 3).unionByName(old_products(spark, 4, first="2026-06-28"))
    items = item_rows(spark, item("x", 1, 5.0), item("w", 1, 30.0), item("v", 4, 3.0), item("u", 3, 1.0))
    points = signals.price_points(rows, "2026-07-01")
    everything = signals.all_signals(points, known, items, "2026-07-01", T1)
    assert {r.signal_type for r in everything.select("signal_type").distinct().collect()} == {
        "growth", "price_spike", "new_product", "missing_price_data", "collection_gain", "collection_loss",
    }
    for kind in ("growth", "price_spike", "new_product", "missing_price_data", "collection_gain", "collection_loss"):
        own = signals.signals_of(kind, points, known, items, "2026-07-01", T1)
        wanted = everything.filter(everything.signal_type == kind)
        assert sorted(map(str, own.collect())) == sorted(map(str, wanted.collect()))


# --- matching ----------------------------------------------------------------------

STAGED = (
    "import_row_id string, import_batch_id string, record_index long, external_id string, provided_id_product string, "
    "raw_product_name string, language string, condition string, acquisition_type string, purchase_price string, "
    "purchase_date string, is_sealed string, storage_location string, personal_note string"
)


def staged(spark, *rows):
    base = dict(
        external_id=None, provided_id_product=None, raw_product_name=None, language=None, condition=None,
        acquisition_type=None, purchase_price=None, purchase_date=None, is_sealed=None, storage_location=None, personal_note=None,
    )
    data = [("r%d" % i, r.pop("batch", "b1"), i, *{**base, **r}.values()) for i, r in enumerate(dict(r) for r in rows)]
    return spark.createDataFrame(data, STAGED)


def matched(spark, *rows, imported=()):
    known = products(spark, (1, "Unique"), (2, "Twin"), (3, "Twin"))
    done = spark.createDataFrame([(e,) for e in imported], "external_id string")
    result = matching.match_staging(staged(spark, *rows), known, done)
    return result, {r.import_row_id: r for r in result.collect()}


def test_matching_order(spark):
    _, rows = matched(
        spark, {"provided_id_product": "1", "raw_product_name": "Twin"}, {"provided_id_product": "77", "raw_product_name": "Unique"},
        {"raw_product_name": "Unique"}, {"raw_product_name": "Twin"}, {"raw_product_name": "unique"}, {},
    )
    facts = {k: (r.matched_id_product, r.match_status, None if r.match_confidence is None else float(r.match_confidence)) for k, r in rows.items()}
    assert facts == {
        "r0": (1, "ready_to_import", 1.0), "r1": (77, "waiting_for_product", None), "r2": (1, "ready_to_import", 0.9),
        "r3": (None, "needs_review", 0.0), "r4": (None, "needs_review", 0.0), "r5": (None, "error", 0.0),
    }
    assert rows["r3"].error_message == matching.MSG_MANY and rows["r5"].error_message == matching.MSG_NOTHING
    assert (rows["r2"].language, rows["r2"].condition, rows["r2"].is_sealed) == ("DE", "Near Mint", False)


def test_field_errors_win(spark):
    _, rows = matched(
        spark, {"provided_id_product": "1", "purchase_price": "abc", "purchase_date": "2024-13-01"},
        {"provided_id_product": "1", "purchase_price": "-1", "language": "XX"}, {"provided_id_product": "x1"},
        {"provided_id_product": "1", "condition": "Fresh", "acquisition_type": "stolen", "is_sealed": "perhaps"},
    )
    assert {r.match_status for r in rows.values()} == {"error"}
    assert rows["r0"].error_message == f"{matching.MSG_PRICE}; {matching.MSG_DATE}" and rows["r0"].matched_id_product == 1
    assert rows["r1"].error_message == f"{matching.MSG_PRICE}; {matching.MSG_LANGUAGE}"
    assert matching.MSG_ID in rows["r2"].error_message
    assert rows["r3"].error_message == "; ".join([matching.MSG_CONDITION, matching.MSG_ACQUISITION, matching.MSG_SEALED])


def test_duplicate_external_ids(spark):
    ok = {"provided_id_product": "1"}
    _, rows = matched(
        spark, {**ok, "external_id": "a"}, {**ok, "external_id": "a"}, {**ok, "external_id": "a", "batch": "b2"},
        {**ok, "external_id": "old"}, ok, ok, imported=["old", "old"],
    )
    assert [rows[f"r{i}"].match_status for i in range(6)] == ["ready_to_import", "error", "ready_to_import", "error", "ready_to_import", "ready_to_import"]
    assert rows["r1"].error_message == matching.MSG_REPEATED and rows["r3"].error_message == matching.MSG_IMPORTED


def test_re_evaluation_looks_at_the_whole_batch(spark):
    rows = staged(spark, {"provided_id_product": "1", "external_id": "a"}, {"provided_id_product": "1", "external_id": "a"}, {"raw_product_name": "Unique"})
    state = rows.withColumn(
        "match_status", F.when(F.col("record_index") == 0, "ready_to_import").when(F.col("record_index") == 1, "error").otherwise("needs_review")
    )
    again = matching.re_evaluate(state, products(spark, (1, "Unique")), spark.createDataFrame([], "external_id string"))
    assert {r.import_row_id: r.match_status for r in again.collect()} == {"r1": "error", "r2": "ready_to_import"}


def test_promotion(spark):
    result, _ = matched(spark, {"provided_id_product": "1", "purchase_price": "4.50"}, {"provided_id_product": "77"})
    items, after = matching.promote(result.withColumn("imported_at", F.lit(None).cast("timestamp")), T1)
    row = items.first()
    assert items.count() == 1 and row.id_product == 1 and row.purchase_price == Decimal("4.5000")
    assert row.is_graded is False and row.is_sold is False and row.acquisition_type == "pulled"
    states = {r.import_row_id: (r.match_status, r.imported_at is not None) for r in after.collect()}
    assert states == {"r0": ("imported", True), "r1": ("waiting_for_product", False)}
    again, _ = matching.promote(after, T2)
    assert again.count() == 0


def test_possible_duplicates_compare_nulls(spark):
    result, _ = matched(spark, {"provided_id_product": "1"}, {"provided_id_product": "2", "purchase_price": "3"}, {"provided_id_product": "1", "external_id": "e"})
    items, _ = matching.promote(result.withColumn("imported_at", F.lit(None).cast("timestamp")), T1)
    owned = items.filter("id_product = 1")
    assert [r.import_row_id for r in matching.possible_duplicates(result, owned).collect()] == ["r0"]


# --- mapping -----------------------------------------------------------------------


def test_mapping_methods(spark):
    expansions = spark.createDataFrame(
        [(1, "Lost Origin", "A", "Lost-Origin", None, None), (2, "Sword & Shield - Silver", "Sword & Shield", None, None, None),
         (3, "Nothing", "A", None, "lor", None), (4, "Other", "A", "Crown-Zenith", None, None),
         (5, "Dated Thing", "A", None, None, DAY), (6, "Twins", "A", None, None, None), (7, "Alone", "A", None, None, None)],
        "id_expansion long, name_en string, series_en string, slug string, set_code string, release_date date",
    )
    sets = spark.createDataFrame(
        [("s1", "Lost Origin", "A", "XX", None), ("s2", "Silver", "B", None, None), ("s3", "Zzz", "B", "LOR", None),
         ("s4", "Crown Zenith", "B", None, None), ("s5", "Dated Set", "B", None, DAY + datetime.timedelta(days=5)),
         ("s6", "Twins", "B", None, None), ("s7", "Twins", "C", None, None), ("s8", "Dated Else", "B", None, DAY - datetime.timedelta(days=6))],
        "tcg_set_id string, name_en string, series_en string, ptcgo_code string, release_date date",
    )
    rows = mapping.mapping_candidates(expansions, sets, T1).collect()
    others = sorted((r for r in rows if r.tcg_set_id and not r.is_primary_mapping), key=lambda r: r.id_expansion)
    assert [(r.id_expansion, r.tcg_set_id, r.match_status, r.needs_review) for r in others] == [
        (5, "s8", "manual_review", True), (6, "s7", "manual_review", True)
    ]
    found = {r.id_expansion: r for r in rows if r not in others}
    facts = {k: (r.tcg_set_id, r.match_method, r.match_status, float(r.match_confidence), r.needs_review) for k, r in found.items()}
    assert facts == {
        1: ("s1", "exact_name", "matched", 1.0, False), 2: ("s2", "normalized_name", "matched", 0.95, False),
        3: ("s3", "code", "matched", 0.95, False), 4: ("s4", "slug", "matched", 0.9, False),
        5: ("s5", "date_name_combo", "manual_review", 0.75, True), 6: ("s6", "exact_name", "manual_review", 0.7, True),
        7: (None, "none", "unmatched", 0.0, True),
    }
    assert found[6].candidate_count == 2
    manual = spark.createDataFrame([(7, "s8", "by hand")], "id_expansion long, tcg_set_id string, notes string")
    decided = mapping.mapping_candidates(expansions, sets, T1, manual).filter("id_expansion = 7").first()
    assert (decided.tcg_set_id, decided.match_method, decided.match_status, decided.needs_review) == ("s8", "manual", "matched", False)


# --- constraints and profile -------------------------------------------------------


def test_constraints(spark):
    found = signals.collection_gain_loss(
        item_rows(spark, item("g", 1, 20.0)), spark.createDataFrame([(1, 30.0)], "id_product long, estimated_market_value double"), DAY, T1
    )
    bad = found.withColumns({"collection_item_id": F.lit(None).cast("string"), "signal_strength": F.lit("huge")})
    rules = constraints.rule_violations(bad, "signal_id", constraints.signal_rules())
    assert sorted(r.constraint_name for r in rules.collect()) == ["signals.collection_item", "signals.signal_strength"]
    assert constraints.rule_violations(found, "signal_id", constraints.signal_rules()).count() == 0
    watch = spark.createDataFrame([(1, 5, True), (2, 5, True), (3, 6, True), (4, 6, False)], "watchlist_item_id long, id_product long, is_active boolean")
    assert [(r.key, r.value) for r in constraints.active_watch_violations(watch).collect()] == [("5", "2")]
    orphans = constraints.foreign_key_violations(watch, "watch.product", "watchlist_item_id", "id_product", products(spark, (5, "A")), "id_product")
    assert sorted(r.key for r in orphans.collect()) == ["3", "4"]
    nameless = products(spark, (1, "A")).withColumn("name", F.lit(None).cast("string"))
    assert [r.constraint_name for r in constraints.null_violations(nameless, "products", "id_product").collect()] == ["products.name"]


def test_profile(spark):
    records = spark.createDataFrame(
        [({"a": "1", "b": "x"},), ({"a": "2.5", "b": None},), ({"a": "1"},)], "record map<string,string>"
    )
    rows = {r.field: r for r in profile.profile_records(records).collect()}
    assert (rows["a"].occurrences, rows["a"].integer_count, rows["a"].number_count, rows["a"].distinct_values) == (3, 2, 1, 2)
    assert (rows["b"].occurrences, rows["b"].null_count, rows["b"].text_count) == (2, 1, 1)
    overview = profile.catalog_overview(products(spark, (1, "A"), (2, " ")).unionByName(products(spark, (1, "A")))).first()
    assert (overview.row_count, overview.missing_name, overview.duplicate_ids) == (3, 1, 1)


# --- skew --------------------------------------------------------------------------


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_spread_join_equals_plain_join(spark, how):
    """A third of the facts share a key and some have none."""
    from tradebinder.operators.lookup import spread_join

    facts = spark.range(3000).select(
        F.col("id").alias("row"),
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 7 == 0, None).otherwise(F.col("id") % 50).alias("key"),
    )
    table = spark.range(40).select(F.col("id").alias("key"), (F.col("id") * 10).alias("value"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plain = facts.join(table, "key", how)
        spread = spread_join(facts, table, ["key"], how, ["row"]).select(*plain.columns)
        assert sorted(map(str, plain.collect())) == sorted(map(str, spread.collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_adaptive_split_applies_on_top_of_the_salt(spark):
    """A join with an aggregated lookup table is only split when it is salted."""
    from tradebinder.operators.lookup import spread_join

    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "32",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        facts = spark.range(0, 300000, 1, 8).select(
            F.col("id").alias("row"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 5000).alias("key")
        )
        table = facts.groupBy("key").agg(F.max("row").alias("last"))
        joined = spread_join(facts, table, ["key"], "left", ["row"], salts=4)
        assert len(joined.collect()) == 300000
        final = joined._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        assert "skew=true" in final
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_spread_join_spreads_the_hot_key(spark):
    from tradebinder.operators.lookup import spread_join

    facts = spark.range(6000).select(F.col("id").alias("row"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("key"))
    table = facts.select("key").distinct()
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "8",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        joined = spread_join(facts, table, ["key"], "inner", ["row"])
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 6000 and max(sizes) < 2000
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
