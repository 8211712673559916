import datetime
import json

import pytest
from pyspark.sql import functions as F

from tradebinder.operators.validate import ValidationError
from tradebinder.plans import analytics, catalog, collection, daily, quality, reference
from tradebinder.sources import csv_files, tables
from tradebinder.streaming import archive_stream

T1, T2, T3 = "2026-07-01 06:00:00", "2026-07-08 06:00:00", "2026-07-15 06:00:00"


def guide(*records):
    fields = ("idProduct", "trend", "avg30")
    return json.dumps({"version": 1, "createdAt": "2026-07-01T02:55:18+0200", "priceGuides": [dict(zip(fields, r)) for r in records]})


def documents(spark, *contents):
    return spark.createDataFrame([(f"f{i}.json", c) for i, c in enumerate(contents)], "file_name string, content string")


def products_file(*rows):
    return json.dumps({"products": [{"idProduct": i, "name": n, "idExpansion": 3} for i, n in rows]})


def stored(spark, root, name):
    return tables.read_table(spark, str(root), name)


def run_catalog(spark, root, singles, others, run_ts):
    return catalog.run_catalog(
        spark, str(root), documents(spark, products_file(*singles)), documents(spark, products_file(*others)), run_ts
    )


def test_daily_load(spark, tmp_path):
    root = str(tmp_path)
    run_catalog(spark, root, [(1, "A"), (2, "B")], [(3, "Box")], T1)
    summary = daily.load_day(spark, root, documents(spark, guide((1, 5, 5), (2, 3, None))), "2026-07-02", T1)
    assert summary.status == "success with warnings" and summary.warnings == "products_without_prices=1"
    daily.load_day(spark, root, documents(spark, guide((1, 6, 5), (2, 3, 1), (3, 9, 9))), "2026-07-03", T1)
    again = daily.load_day(spark, root, documents(spark, guide((1, 8, 5), (9, 1, 1), (3, 9, 9))), "2026-07-03", T2)
    assert again.missing_products == 1 and again.rows_loaded == 4
    rows = {(str(r.snapshot_date), r.id_product): r for r in stored(spark, root, "price_snapshots").collect()}
    assert len(rows) == 6 and rows["2026-07-03", 1].trend == 8
    assert str(rows["2026-07-03", 1].created_at) == T1 and str(rows["2026-07-03", 9].created_at) == T2
    assert rows["2026-07-02", 1].trend == 5


def test_invalid_day_writes_nothing(spark, tmp_path):
    root = str(tmp_path)
    for content in (guide((1, 5, 5), (None, 3, None)), "{", '{"priceGuides": []}'):
        with pytest.raises(ValidationError):
            daily.load_day(spark, root, documents(spark, content), "2026-07-02", T1)
    assert stored(spark, root, "price_snapshots").isEmpty()


def test_replay_uses_canonical_files_and_reports_bad_days(spark, tmp_path):
    root, folder = str(tmp_path / "tables"), tmp_path / "archive"
    folder.mkdir()
    files = {
        "price_guide_6_2026-07-01.json": guide((1, 1, 1)),
        "price_guide_6_2026-07-02.json": guide((1, 2, 2)),
        "price_guide_6_2026-07-02_rerun-01.json": guide((1, 3, 3), (2, 3, 3)),
        "price_guide_6_2026-07-03.json": guide((None, 1, 1)),
        "price_guide_6_2026-07-09.json": guide((1, 9, 9)),
    }
    for name, content in files.items():
        (folder / name).write_text(content)
    first, last = datetime.date(2026, 7, 1), datetime.date(2026, 7, 4)
    report = daily.replay(spark, root, str(folder), first, last, T1).orderBy("snapshot_date").collect()
    assert [(r.snapshot_date.day, r.replayed_rows, r.stored_rows, r.reason) for r in report] == [
        (1, 1, 0, None), (2, 2, 0, None), (3, 0, 0, "missing idProduct"),
    ]
    again = daily.replay(spark, root, str(folder), first, last, T2).orderBy("snapshot_date").collect()
    assert [(r.replayed_rows, r.stored_rows) for r in again] == [(1, 1), (2, 2), (0, 0)]
    rows = stored(spark, root, "price_snapshots").orderBy("snapshot_date", "id_product").collect()
    assert [(r.snapshot_date.day, r.id_product, int(r.trend), str(r.created_at)) for r in rows] == [
        (1, 1, 1, T1), (2, 1, 3, T1), (2, 2, 3, T1),
    ]
    assert daily.replay(spark, root, str(tmp_path / "none"), first, last, T1).isEmpty()


def test_stream_loads_new_files_once(spark, tmp_path):
    root, folder, mark = str(tmp_path / "tables"), tmp_path / "archive", str(tmp_path / "mark")
    folder.mkdir()
    (folder / "price_guide_6_2026-07-01.json").write_text(guide((1, 1, 1)))
    (folder / "price_guide_6_2026-07-02.json").write_text("broken")

    def follow(run_ts):
        archive_stream.follow_archive(spark, str(folder), root, run_ts, checkpoint=mark).awaitTermination(120)

    follow(T1)
    assert stored(spark, root, "price_snapshots").count() == 1
    (folder / "price_guide_6_2026-07-01_rerun-01.json").write_text(guide((1, 4, 1), (2, 1, 1)))
    follow(T2)
    rows = stored(spark, root, "price_snapshots").orderBy("id_product").collect()
    assert [(r.id_product, int(r.trend), str(r.created_at)) for r in rows] == [(1, 4, T1), (2, 1, T2)]


def test_stream_follows_nested_folders_and_reruns_in_any_order(spark, tmp_path):
    """The same table as a replay, whatever arrives first; late base files and other folders included."""
    root, other, folder, mark = str(tmp_path / "tables"), str(tmp_path / "replayed"), tmp_path / "archive", str(tmp_path / "mark")
    (folder / "2026" / "07").mkdir(parents=True)

    def arrive(name, *rows):
        (folder / name).write_text(guide(*rows))

    def follow(run_ts, **options):
        archive_stream.follow_archive(spark, str(folder), root, run_ts, checkpoint=mark, **options).awaitTermination(120)

    arrive("price_guide_6_2026-07-01.json", (1, 1, 1))
    arrive("2026/07/price_guide_6_2026-07-02.json", (1, 2, 2))
    arrive("2026/07/price_guide_6_2026-07-03_rerun-02.json", (1, 3, 3), (2, 3, 3))
    follow(T1, files_per_batch=1)
    # Behind the rerun that is loaded: a base file and an older rerun; and a rerun in a subfolder.
    arrive("price_guide_6_2026-07-03.json", (1, 9, 9))
    arrive("price_guide_6_2026-07-03_rerun-01.json", (1, 8, 8))
    arrive("2026/07/price_guide_6_2026-07-01_rerun-01.json", (1, 5, 5))
    follow(T2)
    got = stored(spark, root, "price_snapshots").select("snapshot_date", "id_product", "trend").collect()
    assert sorted((r.snapshot_date.day, r.id_product, int(r.trend)) for r in got) == [(1, 1, 5), (2, 1, 2), (3, 1, 3), (3, 2, 3)]
    daily.replay(spark, other, str(folder), datetime.date(2026, 7, 1), datetime.date(2026, 7, 9), T2)
    again = stored(spark, other, "price_snapshots").select("snapshot_date", "id_product", "trend").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))


def test_replay_reports_files_of_one_name(spark, tmp_path):
    root, folder = str(tmp_path / "tables"), tmp_path / "archive"
    for part, price in (("a", 1), ("b", 2)):
        (folder / part).mkdir(parents=True)
        (folder / part / "price_guide_6_2026-07-01.json").write_text(guide((1, price, 1)))
    report = daily.replay(spark, root, str(folder), datetime.date(2026, 7, 1), datetime.date(2026, 7, 1), T1).collect()
    assert sorted((r.replayed_rows, r.reason.split(":")[0] if r.reason else None) for r in report) == [(0, "same name as another file"), (1, None)]
    assert [r.reason.endswith("/b/price_guide_6_2026-07-01.json") for r in report if r.reason] == [True]


def test_catalog_run(spark, tmp_path):
    root = str(tmp_path)
    first = run_catalog(spark, root, [(1, "A"), (2, "B")], [(3, "Box"), (1, "A")], T1)
    assert (first.new_products, first.active_products, first.duplicate_ids) == (3, 3, 1)
    second = run_catalog(spark, root, [(1, "A2")], [(4, "Box")], T2)
    assert (second.singles_loaded, second.non_singles_loaded, second.new_products, second.deactivated_products) == (1, 1, 1, 2)
    rows = {r.id_product: r for r in stored(spark, root, "products").collect()}
    assert rows[1].name == "A2" and rows[1].product_group == "single" and str(rows[1].first_seen_at) == T1
    assert not rows[2].is_active_in_catalog and not rows[3].is_active_in_catalog


def test_catalog_is_both_files_or_nothing(spark, tmp_path):
    root = str(tmp_path)
    run_catalog(spark, root, [(1, "A")], [(2, "B")], T1)
    with pytest.raises(ValidationError):
        catalog.run_catalog(spark, root, documents(spark, products_file((1, "new"))), documents(spark, "[]"), T2)
    with pytest.raises(ValidationError, match="differ"):
        run_catalog(spark, root, [(1, "A"), (5, "x")], [(5, "y")], T2)
    assert {r.name for r in stored(spark, root, "products").collect()} == {"A", "B"}


def test_unreadable_date_added_is_counted(spark):
    records = spark.createDataFrame([({"dateAdded": "soon"},), ({"dateAdded": "2024-01-01"},), ({},)], "record map<string,string>")
    assert catalog.date_added_warnings(records).count() == 1


def test_collection_import_to_valuation(spark, tmp_path):
    root, upload = str(tmp_path / "tables"), tmp_path / "mine.csv"
    run_catalog(spark, root, [(1, "Card")], [(2, "Box")], T1)
    upload.write_text(
        "externalId,providedIdProduct,rawProductName,purchasePrice,isSealed\n"
        "a,1,,20.00,\nb,,Box,40.00,true\nc,3,,,\nd,,Unknown,,\na,1,,,\n,1,,20.00,\n"
    )
    staged = csv_files.read_collection_csv(spark, str(upload), "up-1")
    report = {r.match_status: r.import_rows for r in collection.import_collection(spark, root, staged, T1).collect()}
    assert report == {"ready_to_import": 3, "waiting_for_product": 1, "needs_review": 1, "error": 1}
    # A retried import adds nothing, whatever its run time.
    for run_ts in (T1, T2):
        collection.import_collection(spark, root, staged, run_ts)
    assert stored(spark, root, "collection_import_staging").count() == 6
    assert collection.promote_ready(spark, root, T2).isEmpty()
    assert stored(spark, root, "collection_items").count() == 3

    summary = run_catalog(spark, root, [(1, "Card"), (3, "Late")], [(2, "Box")], T3)
    assert summary.staging_resolved == 1
    collection.promote_ready(spark, root, "2026-07-16 06:00:00")
    assert stored(spark, root, "collection_items").count() == 4

    second = csv_files.read_collection_csv(spark, str(upload), "up-2")
    report = {r.match_status: r for r in collection.import_collection(spark, root, second, "2026-07-17 06:00:00").collect()}
    assert report["error"].import_rows == 4 and report["ready_to_import"].possible_duplicates == 1

    daily.load_day(spark, root, documents(spark, guide((1, 30, 30), (2, 30, 30))), "2026-07-20", T3)
    views = analytics.stored_views(spark, root)
    total = views["vw_collection_summary"].first()
    assert total.active_items == 4 and total.sealed_items == 1 and total.total_estimated_gain_loss == 10 + 10 - 10

    for run_ts in (T3, "2026-07-20 08:00:00"):
        analytics.record_signals(spark, root, datetime.date(2026, 7, 20), run_ts)
    kinds = {r.signal_type: r["count"] for r in stored(spark, root, "analytics_signals").groupBy("signal_type").count().collect()}
    assert kinds["collection_gain"] == 2 and kinds["collection_loss"] == 1
    assert stored(spark, root, "analytics_signals").select("signal_id").distinct().count() == sum(kinds.values())
    analytics.register_views(spark, root)
    assert spark.sql("SELECT name FROM vw_collection_losses").first().name == "Box"
    assert spark.sql("SELECT count(*) AS n FROM collection_items WHERE is_sealed").first().n == 1
    assert quality.stored_constraint_report(spark, root).isEmpty()
    assert quality.stored_collection_issues(spark, root, "2026-07-20").isEmpty()
    analytics.export_view(spark, root, "vw_collection_summary", str(tmp_path / "out"))
    assert "most_valuable_item" in "".join(p.read_text() for p in (tmp_path / "out").glob("*.csv"))


EXPANSIONS = (
    "id_expansion,name_en,name_de,slug,series_en,series_de,release_date,card_count,source_url_en,source_url_de,is_active,notes\n"
    "3,Lost Origin,Verloren,Lost-Origin,Era,,2022-09-09,266,,,true,\n8,Unused,,,,,,,,,,\n"
)


def test_reference_layer(spark, tmp_path):
    root, folder, csv = str(tmp_path / "tables"), tmp_path / "catalogs", tmp_path / "expansions.csv"
    folder.mkdir()
    csv.write_text(EXPANSIONS)
    (folder / "products_singles_6_2026-07-03.json").write_text(
        json.dumps([{"idProduct": 1, "name": "A", "idExpansion": 3}, {"idProduct": 2, "name": "B", "idExpansion": "x"}])
    )
    (folder / "products_nonsingles_6_2026-07-03.json").write_text(
        json.dumps({"product": [{"idProduct": 5, "name": "Box", "idExpansion": 3}, {"id_product": 6, "expansionId": 4}]})
    )
    (folder / "other.json").write_text("[]")
    found = {(r.kind, r.detail) for r in reference.validate_expansions(spark, str(folder), str(csv)).collect()}
    assert found == {("missing", "4"), ("unused", "8"), ("metadata", "line 3 name_de is empty for id 8")}

    reference.write_expansion_seed(spark, str(folder), str(tmp_path / "seed"))
    seed = csv_files.read_text_csv(spark, str(tmp_path / "seed")).orderBy("id_expansion").collect()
    assert [(r.id_expansion, r.detected_product_count, r.sample_product_name, r.source_file) for r in seed] == [
        ("3", "2", "Box", "products_nonsingles_6_2026-07-03.json"), ("4", "1", None, "products_nonsingles_6_2026-07-03.json"),
    ]
    assert len(seed[0]) == 15
    with pytest.raises(FileNotFoundError):
        reference.write_expansion_seed(spark, str(tmp_path), str(tmp_path / "seed2"))

    reference.load_expansions(spark, root, str(csv), T1)
    csv.write_text(EXPANSIONS.replace("266", "267"))
    reference.load_expansions(spark, root, str(csv), T2)
    row = stored(spark, root, "expansions").filter("id_expansion = 3").first()
    assert row.card_count == 267 and str(row.created_at) == T1 and str(row.updated_at) == T2

    sets = tmp_path / "sets.json"
    sets.write_text(json.dumps([{"id": "s1", "name": "Lost Origin", "series": "Era", "printedTotal": 196, "total": 217}]))
    reference.convert_sets(spark, str(sets), str(tmp_path / "sets"))
    reference.load_sets(spark, root, str(tmp_path / "sets"), T1)
    reference.refresh_mappings(spark, root, T1)
    trusted = analytics.stored_views(spark, root)["vw_trusted_expansion_set_mappings"].collect()
    assert [(r.id_expansion, r.tcg_set_id, r.secret_card_count) for r in trusted] == [(3, "s1", 21)]


def test_failed_write_leaves_the_old_version(spark, tmp_path):
    root = str(tmp_path)
    run_catalog(spark, root, [(1, "A")], [(2, "B")], T1)
    broken = stored(spark, root, "products").withColumn("name", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        tables.write_version(broken, root, "products", T2)
    assert stored(spark, root, "products").count() == 2
    assert tables.current_version(spark, root, "products").startswith(tables.version_of(T1))


def test_equal_and_earlier_run_times_lose_nothing(spark, tmp_path):
    root = str(tmp_path)
    run_catalog(spark, root, [(1, "A")], [(2, "B")], T2)
    broken = stored(spark, root, "products").withColumn("name", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        tables.write_version(broken, root, "products", T2)
    assert stored(spark, root, "products").count() == 2
    tables.write_version(stored(spark, root, "products").filter("id_product = 1"), root, "products", T1)
    assert stored(spark, root, "products").count() == 1


def test_a_date_can_become_empty(spark, tmp_path):
    root = str(tmp_path)
    schema = tables.TABLES["analytics_signals"]
    day = datetime.date(2026, 7, 3)
    values = {"date": day, "timestamp": datetime.datetime(2026, 7, 3), "string": "x", "integer": 1, "long": 1, "boolean": True}
    row = tuple(
        datetime.date(2026, 7, 3) if f.name == "signal_date" else values.get(f.dataType.typeName(), None if f.nullable else 1)
        for f in schema.fields
    )
    frame = spark.createDataFrame([row], schema)
    tables.write_partitions(frame, root, "analytics_signals")
    assert stored(spark, root, "analytics_signals").count() == 1
    tables.clear_partition(spark, root, "analytics_signals", "2026-07-03")
    assert stored(spark, root, "analytics_signals").count() == 0


def test_checks_prune_to_one_day_and_needed_columns(spark, tmp_path):
    from tradebinder.operators import checks

    root = str(tmp_path)
    daily.load_day(spark, root, documents(spark, guide((1, 5, 5))), "2026-07-02", T1)
    daily.load_day(spark, root, documents(spark, guide((1, 5, 5))), "2026-07-03", T1)
    prices, products = stored(spark, root, "price_snapshots"), stored(spark, root, "products")
    found = checks.missing_products_check(prices, products, "2026-07-03")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(snapshot_date" in plan and "ReadSchema: struct<id_product:bigint>" in plan
    assert daily.latest_date_before(prices, F.lit("2026-07-03").cast("date")) == datetime.date(2026, 7, 2)
    assert daily.latest_date_before(prices, F.lit("2026-12-03").cast("date")) == datetime.date(2026, 7, 3)
    assert daily.latest_date_before(prices, F.lit("2026-07-02").cast("date")) is None


def test_registered_queries_have_no_pairwise_or_python_operators(spark):
    from tradebinder.plans import queries

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name, run in queries.registered().items():
            plan = run(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
            for operator in ("NestedLoopJoin", "CartesianProduct", "EvalPython", "MapInPandas"):
                assert operator not in plan, (name, operator)
            assert "Window" not in plan or name == "check_drift", name
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_every_query_has_a_sql_twin():
    from tradebinder.plans import driver_sql, queries

    assert set(queries.registered()) == set(driver_sql.oracle())


def test_constraint_report_finds_every_kind(spark, tmp_path):
    root = str(tmp_path)
    run_catalog(spark, root, [(1, "A")], [(2, "B")], T1)
    frames = {name: stored(spark, root, name) for name in tables.TABLES}
    products = frames["products"]
    frames["products"] = products.unionByName(products.filter("id_product = 1")).withColumn(
        "product_group", F.when(F.col("id_product") == 2, "box").otherwise(F.col("product_group"))
    )
    watch = "watchlist_item_id string, id_product long, reason string, target_price decimal(18,4), is_active boolean, created_at timestamp, updated_at timestamp"
    now = datetime.datetime(2026, 7, 1)
    frames["watchlist"] = spark.createDataFrame(
        [("w1", 1, None, None, True, now, now), ("w2", 1, None, None, True, now, None), ("w3", 9, None, None, False, now, now)], watch
    )
    found = {(r.table_name, r.constraint_name, r.key) for r in quality.constraint_report(frames).collect()}
    assert found == {
        ("products", "products.key", "1"), ("products", "products.product_group", "2"), ("watchlist", "watchlist.active", "1"),
        ("watchlist", "watchlist.updated_at", "w2"), ("watchlist", "watchlist.id_product_exists", "w3"),
    }


def test_runs_from_the_archive(spark, tmp_path):
    root, folder = str(tmp_path / "tables"), tmp_path / "archive"
    folder.mkdir()
    (folder / "products_singles_6_2026-07-03.json").write_text(products_file((1, "A")))
    with pytest.raises(daily.LoadFailed, match="products_nonsingles_6"):
        catalog.run_archived_catalog(spark, root, str(folder), "2026-07-03", T1)
    (folder / "products_nonsingles_6_2026-07-03.json").write_text(products_file((2, "Box")))
    assert catalog.run_archived_catalog(spark, root, str(folder), "2026-07-03", T1).new_products == 2
    (folder / "price_guide_6_2026-07-03.json").write_text(guide((1, 5, 5)))
    (folder / "price_guide_6_2026-07-03_rerun-01.json").write_text(guide((1, 6, 5), (1, 7, 5), (2, 1, 1)))
    summary = daily.load_archived_day(spark, root, str(folder), "2026-07-03", T1)
    assert (summary.status, summary.records_read, summary.rows_loaded) == ("success", 3, 2)
    assert stored(spark, root, "price_snapshots").filter("id_product = 1").first().trend == 7
    with pytest.raises(daily.LoadFailed):
        daily.load_archived_day(spark, root, str(folder), "2026-07-04", T1)


def test_large_day_is_loaded_like_any_other(spark, tmp_path):
    root, path = str(tmp_path / "tables"), tmp_path / "large.json"
    for name, row in (("singles", (1, "A")), ("others", (2, "B"))):
        (tmp_path / name).write_text(products_file(row))
    loaded = catalog.run_large_catalog(spark, root, str(tmp_path / "singles"), str(tmp_path / "others"), T1)
    assert (loaded.singles_loaded, loaded.non_singles_loaded, loaded.new_products) == (1, 1, 2)
    path.write_text(guide((1, 5, 5), (2, 1, 1), (1, 6, 5)))
    summary = daily.load_large_day(spark, root, str(path), "2026-07-03", T1)
    assert (summary.status, summary.records_read, summary.rows_loaded) == ("success", 3, 2)
    assert stored(spark, root, "price_snapshots").filter("id_product = 1").first().trend == 6
    path.write_text(guide((1, 5, 5))[:-3])
    with pytest.raises(ValidationError):
        daily.load_large_day(spark, root, str(path), "2026-07-04", T1)


def test_review_judges_corrected_rows_again_or_changes_nothing(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "tables")
    run_catalog(spark, root, [(1, "Unique"), (2, "Twin"), (3, "Twin")], [(4, "Box")], T1)
    rows = [("a", "Unique", "Good", None), ("b", "Twin", "Good", None), ("c", "Nobody", "Good", None), ("d", "Unique", "odd", None)]
    blank = dict.fromkeys(("external_id", "acquisition_type", "purchase_price", "purchase_date", "is_sealed", "storage_location", "personal_note"))
    staged = spark.createDataFrame(
        [{"record_index": ord(i), "import_row_id": i, "import_batch_id": "x", "raw_product_name": n, "condition": c, "provided_id_product": p, "language": "EN", **blank}
         for i, n, c, p in rows],
        "record_index long, import_row_id string, import_batch_id string, external_id string, provided_id_product string, raw_product_name string, language string, "
        "condition string, acquisition_type string, purchase_price string, purchase_date string, is_sealed string, storage_location string, "
        "personal_note string",
    )
    collection.import_collection(spark, root, staged, T1)

    def statuses():
        found = stored(spark, root, "collection_import_staging").collect()
        return {r.import_row_id: (r.match_status, r.matched_id_product) for r in found}

    before = statuses()
    assert {i for i, (status, _) in before.items() if status in ("needs_review", "error")} >= {"b", "c"}
    fixes = spark.createDataFrame([("b", "3", None), ("c", None, "Unique"), ("a", "2", None)], "import_row_id string, provided_id_product string, raw_product_name string")
    with monkeypatch.context() as patch:
        patch.setattr(collection, "write_version", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            collection.review_staging(spark, root, fixes, T2)
    assert statuses() == before
    collection.review_staging(spark, root, fixes, T2)
    after = statuses()
    assert after["b"] == ("ready_to_import", 3) and after["c"] == ("ready_to_import", 1) and after["a"] == before["a"] and len(after) == 4
    with pytest.raises(ValueError):
        collection.review_staging(spark, root, fixes.unionByName(fixes), T2)
    with pytest.raises(ValueError):
        collection.review_staging(spark, root, fixes.withColumnRenamed("raw_product_name", "match_status"), T2)


def test_of_two_commits_at_once_the_later_fails(spark, tmp_path, monkeypatch):
    from tradebinder.sources import tables

    root = str(tmp_path / "tables")
    run_catalog(spark, root, [(1, "A")], [(2, "B")], T1)
    products = stored(spark, root, "products")
    first, stale = tables.current_version(spark, root, "products"), tables._last_commit(spark, root, "products")
    tables.write_version(products, root, "products", T2)
    second = tables.current_version(spark, root, "products")
    assert second != first
    with monkeypatch.context() as patch:
        # The other run's commit was not there yet when this one looked for the last number.
        patch.setattr(tables, "_last_commit", lambda *a: stale)
        with pytest.raises(tables.CommitConflict):
            tables.write_version(products.limit(0), root, "products", T2)
    assert tables.current_version(spark, root, "products") == second and stored(spark, root, "products").count() == 2
    tables.write_version(products.limit(1), root, "products", T2)
    assert stored(spark, root, "products").count() == 1
