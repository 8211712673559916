import datetime
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tradebinder.operators import archive, normalize, validate
from tradebinder.sources import archive as archive_source
from tradebinder.sources import csv_files, json_files, pages

DAY = datetime.date(2026, 7, 3)


def documents(spark, *contents):
    rows = [(f"f{i}.json", c if isinstance(c, str) else json.dumps(c)) for i, c in enumerate(contents)]
    return spark.createDataFrame(rows, "file_name string, content string")


def prices(spark, content, **options):
    parsed = json_files.price_documents(documents(spark, content))
    return normalize.normalize_prices(json_files.explode_records(parsed), DAY, **options)


SAMPLE = {
    "version": 1,
    "createdAt": "2026-05-11T01:07:09+0200",
    "priceGuides": [
        {"idProduct": 11, "idCategory": 5, "avg": None, "low": 4.25, "trend": None},
        {"idProduct": 12, "idCategory": 51, "avg": 7.77, "trend": 6, "avg30": "6.25", "avg-holo": None, "trend-holo": 0},
    ],
}


def test_price_document_is_normalized(spark):
    first, second = prices(spark, SAMPLE).orderBy("record_index").collect()
    assert (first.id_product, first.id_category, first.low) == (11, 5, Decimal("4.2500"))
    assert first.avg is None and first.trend is None and first.trend_holo is None
    assert second.trend_holo == 0 and second.avg_holo is None and second.avg30 == Decimal("6.2500")
    assert second.snapshot_date == DAY
    stamps = prices(spark, SAMPLE).select(F.col("source_created_at").cast("string")).distinct().collect()
    assert [r[0] for r in stamps] == ["2026-05-10 23:07:09"]


def test_created_at_can_be_overridden(spark):
    rows = prices(spark, SAMPLE, created_at="2026-07-01 00:00:00")
    assert rows.select(F.col("source_created_at").cast("string")).first()[0] == "2026-07-01 00:00:00"


def test_bare_list_is_accepted(spark):
    row = prices(spark, "  \n [{\"idProduct\": \"7\", \"avg\": \"not-a-number\"}]").first()
    assert row.id_product == 7 and row.avg is None and row.source_created_at is None


@pytest.mark.parametrize(
    "content, reason",
    [
        ("{\"priceGuides\": [{\"idProduct\": 1}", "invalid json"),
        ("not json", "invalid json"),
        ({"other": []}, "no record list"),
        ({"priceGuides": {"idProduct": 1}}, "no record list"),
        ([], "zero records"),
        ({"priceGuides": []}, "zero records"),
        ([{"idProduct": 1}, {"idProduct": None}], "missing idProduct"),
        ([{"idProduct": ""}], "missing idProduct"),
        ([{"avg": 1}], "missing idProduct"),
        ([{"idProduct": 12.7}], "idProduct is no whole number"),
        ([{"idProduct": 1, "idCategory": "abc"}], "idCategory is no whole number"),
    ],
)
def test_price_violations(spark, content, reason):
    parsed = json_files.price_documents(documents(spark, content))
    found = validate.violations(validate.judged_prices(parsed))
    assert [r.reason for r in found.collect()] == [reason]
    with pytest.raises(validate.ValidationError, match=reason):
        validate.raise_on_violations(found)


def test_violation_names_record_and_keeps_it(spark):
    parsed = json_files.price_documents(documents(spark, [{"idProduct": 0}, {"low": 2}]))
    row = validate.violations(validate.judged_prices(parsed)).first()
    assert row.record_index == 1 and json.loads(row.raw) == {"low": "2"}


def test_one_bad_file_does_not_hide_the_others(spark):
    parsed = json_files.price_documents(documents(spark, [{"idProduct": 1}], "broken"))
    expected = spark.createDataFrame([("f0.json",), ("f1.json",), ("f2.json",)], "file_name string")
    outcomes = archive.file_outcomes(parsed, expected)
    assert {r.file_name: r.outcome for r in outcomes.collect()} == {
        "f0.json": "ok", "f1.json": "invalid json", "f2.json": "missing",
    }


@pytest.mark.parametrize(
    "content",
    [
        [{"idProduct": 1, "name": "A"}],
        {"products": [{"idProduct": 1, "name": "A"}]},
        {"products": "none", "data": [{"idProduct": 1, "name": "A"}]},
        {"items": [{"idProduct": 1, "name": "A"}]},
    ],
)
def test_catalog_roots(spark, content):
    records = json_files.explode_records(json_files.catalog_documents(documents(spark, content)))
    row = normalize.normalize_catalog(records, "products_singles_6.json").first()
    assert (row.id_product, row.name, row.product_group) == (1, "A", "single")


def test_catalog_violations_and_unknown_file(spark):
    content = [{"idProduct": 1}, {"name": "x"}, {"idProduct": 2, "name": ""}, {"idProduct": 3, "name": "ok"}]
    parsed = json_files.catalog_documents(documents(spark, content))
    records = json_files.explode_records(parsed)
    judged = validate.judged_catalog(parsed, "products_singles_6.json")
    found = validate.violations(judged)
    assert [r.record_index for r in validate.good_rows(judged).collect()] == [3]
    assert sorted((r.record_index, r.reason) for r in found.collect()) == [
        (0, "missing name"), (1, "missing idProduct"), (2, "missing name"),
    ]
    with pytest.raises(ValueError):
        validate.judged_catalog(parsed, "other.json")
    with pytest.raises(ValueError):
        normalize.normalize_catalog(records, "other.json")


def test_catalog_fields(spark):
    content = [{
        "idProduct": 4, "name": "B", "idCategory": "", "categoryName": "Box", "idExpansion": 3,
        "idMetacard": None, "dateAdded": "2024-01-02 03:04:05",
    }]
    records = json_files.explode_records(json_files.catalog_documents(documents(spark, content)))
    row = normalize.normalize_catalog(records, "products_nonsingles_6.json").first()
    assert row.id_category is None and row.id_expansion == 3 and row.id_metacard is None
    assert row.product_group == "non_single" and str(row.date_added) == "2024-01-02 03:04:05"


@pytest.mark.parametrize(
    "content",
    [
        {"productList": [{"expansionId": "9", "Product ID": 5, "Name": "N"}]},
        {"meta": {"a": 1}, "stuff": [{"Expansion ID": 9, "productId": 5, "product_name": "N"}]},
        [{"id_expansion": 9, "id_product": 5, "name": "N"}],
    ],
)
def test_lenient_catalog(spark, content):
    records = json_files.explode_records(json_files.lenient_catalog_documents(documents(spark, content)))
    row = normalize.lenient_products(records).first()
    assert (row.id_expansion, row.id_product, row.name) == (9, "5", "N")


def test_sets(spark):
    content = [
        {
            "id": "s1", "name": "One", "series": "S", "printedTotal": 307, "total": 304, "legalities": {"standard": "Legal"},
            "ptcgoCode": "ONE", "releaseDate": "2022/09/09", "updatedAt": "2022/09/10 13:45:00",
            "images": {"symbol": "u1", "logo": "u2"},
        },
        {"id": "s2", "name": "Two", "printedTotal": 100, "total": 120},
    ]
    rows = normalize.normalize_sets(json_files.set_documents(documents(spark, content)))
    one, two = rows.orderBy("tcg_set_id").collect()
    assert one.secret_card_count == 0 and one.notes == normalize.SET_ANOMALY_NOTE
    assert one.release_date == datetime.date(2022, 9, 9) and json.loads(one.legalities) == {"standard": "Legal"}
    assert (one.symbol_url, one.logo_url) == ("u1", "u2")
    assert two.secret_card_count == 20 and two.notes == "" and two.legalities == "{}" and two.release_date is None
    with pytest.raises(Exception, match="list of sets"):
        json_files.set_documents(documents(spark, {"sets": []})).collect()


def test_expansion_csv(spark, tmp_path):
    path = tmp_path / "expansions.csv"
    path.write_text(
        "id_expansion,name_en,name_de,slug,series_en,series_de,release_date,card_count,source_url_en,source_url_de,is_active,notes\n"
        '7, Lost One ,Verloren,Lost-One,"A, B",,2022-09-09,266,,,no,"two\nlines"\n'
        "8,Two,,,,,,,,,,\n",
        encoding="utf-8",
    )
    raw = csv_files.read_text_csv(spark, str(path))
    first, second = normalize.normalize_expansions(raw).orderBy("id_expansion").collect()
    assert (first.name_en, first.series_en, first.card_count, first.is_active) == ("Lost One", "A, B", 266, False)
    assert first.notes == "two\nlines" and second.is_active is True and second.name_de is None
    errors = validate.expansion_metadata_errors(csv_files.with_line_numbers(raw)).collect()
    assert [(e.line_number, e.id_expansion, e.error) for e in errors] == [(3, "8", "name_de is empty")]
    integrity = validate.expansion_file_integrity(raw).collect()
    assert [(r.rule, r.value) for r in integrity] == [("name_de filled", "8")]


def test_missing_required_column_is_reported(spark, tmp_path):
    path = tmp_path / "broken.csv"
    path.write_text("id_expansion,name_en\n1,A\n1,B\n", encoding="utf-8")
    raw = csv_files.read_text_csv(spark, str(path))
    errors = validate.expansion_metadata_errors(csv_files.with_line_numbers(raw)).collect()
    assert "missing column name_de" in {e.error for e in errors}
    rules = {(r.rule, r.value) for r in validate.expansion_file_integrity(raw).collect()}
    assert ("id unique", "1") in rules and ("column present", "slug") in rules


def test_collection_csv_defaults(spark, tmp_path):
    path = tmp_path / "mine.csv"
    path.write_text(
        "externalId,providedIdProduct,rawProductName,language,purchasePrice\n"
        "e1,,Card A,,4.50\n,12,,EN,\n",
        encoding="utf-8",
    )
    rows = csv_files.read_collection_csv(spark, str(path), "batch-1").orderBy("record_index").collect()
    assert (rows[0].language, rows[0].condition, rows[0].acquisition_type) == ("DE", "Near Mint", "pulled")
    assert rows[1].language == "EN" and rows[1].external_id is None and rows[1].purchase_date is None
    assert {r.import_batch_id for r in rows} == {"batch-1"} and len({r.import_row_id for r in rows}) == 2


def test_csv_round_trip_of_sets(spark, tmp_path):
    content = [{"id": "s1", "name": 'A "quoted", name', "printedTotal": 1, "total": 2, "updatedAt": "2022/09/10 13:45:00"}]
    rows = normalize.normalize_sets(json_files.set_documents(documents(spark, content)))
    csv_files.write_csv(rows, str(tmp_path / "sets"))
    back = csv_files.read_set_csv(spark, str(tmp_path / "sets")).first()
    assert back.name_en == 'A "quoted", name' and back.is_active is True and back.notes is None
    assert back.source_updated_at == datetime.datetime(2022, 9, 10, 13, 45)


def test_quoted_csv(spark, tmp_path):
    frame = spark.createDataFrame([("a;b", "c\"d")], "x string, y string").coalesce(1)
    csv_files.write_quoted_csv(frame, str(tmp_path / "out"))
    text = "".join(p.read_text() for p in (tmp_path / "out").glob("*.csv"))
    assert text == '"x";"y"\n"a;b";"c""d"\n'


NAMES = [
    "price_guide_6_2026-07-03.json", "price_guide_6_2026-07-03_rerun-02.json",
    "price_guide_6_2026-07-03_rerun-01.json", "price_guide_6_2026-07-04.json",
    "products_singles_6_2026-07-03.json", "price_guide_6_2026-07-030.json",
    "price_guide_6_2026-13-03.json", "price_guide_6_2026-07-06_rerun-100.json", "notes.txt",
]


def listing(spark, names=NAMES):
    return spark.createDataFrame([(n,) for n in names], "file_name string")


def test_canonical_files(spark):
    rows = archive.canonical_files(listing(spark), ["price_guide_6"]).orderBy("snapshot_date").collect()
    assert [(r.file_name, r.is_rerun, r.rerun_number, r.superseded_count) for r in rows] == [
        ("price_guide_6_2026-07-03_rerun-02.json", True, 2, 2),
        ("price_guide_6_2026-07-04.json", False, None, 0),
        ("price_guide_6_2026-07-06_rerun-100.json", True, 100, 0),
    ]
    replaced = archive.superseded_files(listing(spark), ["price_guide_6"]).collect()
    assert sorted(r.file_name for r in replaced) == NAMES[:1] + NAMES[2:3]
    assert archive.canonical_files(listing(spark, ["x.json"])).count() == 0


def test_next_names_and_gaps(spark):
    asked = spark.createDataFrame(
        [("price_guide_6", d) for d in (3, 4, 5, 6)], "prefix string, day int"
    ).selectExpr("prefix", "make_date(2026, 7, day) AS snapshot_date")
    names = {r.snapshot_date.day: r.next_file_name for r in archive.next_archive_names(listing(spark), asked).collect()}
    assert names == {
        3: "price_guide_6_2026-07-03_rerun-03.json", 4: "price_guide_6_2026-07-04_rerun-01.json",
        5: "price_guide_6_2026-07-05.json", 6: "price_guide_6_2026-07-06_rerun-101.json",
    }
    gaps = archive.archive_gaps(listing(spark), ["price_guide_6"]).collect()
    assert [g.snapshot_date.day for g in gaps] == [5]


def test_archive_listing(spark, tmp_path):
    (tmp_path / "a.json").write_text("{}")
    (tmp_path / "deep").mkdir()
    (tmp_path / "deep" / "b.json").write_text("[]")
    found = archive_source.archive_listing(spark, str(tmp_path))
    assert sorted((r.file_name, r.length) for r in found.collect()) == [("a.json", 2), ("b.json", 2)]
    assert archive_source.archive_listing(spark, str(tmp_path / "nowhere")).count() == 0


def test_card_links(spark):
    html = (
        '<a href="/x/Set/One">Karte  Eins\n (ABC 001)</a><a href="/other/One">Else (ABC 9)</a>'
        '<a href="/x/Set/One">Karte 1 (ABC 001)</a><a class="n" href="/x/Set/T">No match</a>'
        '<a href="/x/Set/Two">Zwei (ABC 2/10) more</a>'
    )
    table = spark.createDataFrame([(1, "https://h.example/de/p?q=1", html)], "page_id long, url string, html string")
    rows = pages.card_links(table, "/x/Set/", "My Set").orderBy("place").collect()
    assert [(r.card_name, r.set_code, r.card_number, r.url) for r in rows] == [
        ("Karte 1", "ABC", "001", "https://h.example/x/Set/One"),
        ("Zwei", "ABC", "2/10", "https://h.example/x/Set/Two"),
    ]
    assert rows[0].set_name == "My Set"
    counted = pages.distinct_links(pages.page_links(table))
    # The anchor whose address is not its first attribute counts too.
    assert counted.count() == 5


def test_absolute_urls(spark, one):
    def full(href):
        return one(pages.absolute_url(F.lit(href), F.lit("https://h.example/de/p?q=/1")))

    assert full("/a") == "https://h.example/a"
    assert full("b") == "https://h.example/de/b"
    assert full("//cdn.example/c") == "https://cdn.example/c"
    assert full("http://o.example/d") == "http://o.example/d"


def split_rows(spark, path):
    rows = validate.judged_split_prices(json_files.read_split_records(spark, str(path)))
    return normalize.normalize_prices(rows, DAY)


@pytest.mark.parametrize("indent", [None, 2])
@pytest.mark.parametrize("bare", [False, True])
def test_split_reading_equals_whole_reading(spark, tmp_path, indent, bare):
    """A document of several hundred records read by many tasks, in splits of 4 KB."""
    records = [{"idProduct": i % 90, "idCategory": 5, "trend": i / 4, "avg-holo": None} for i in range(700)]
    content = records if bare else {**SAMPLE, "priceGuides": records}
    path = tmp_path / "large.json"
    path.write_text(json.dumps(content, indent=indent) + "\n")
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        split = json_files.read_split_records(spark, str(path))
        assert spark.read.option("lineSep", "}").text(str(path)).rdd.getNumPartitions() > 4
        assert split.filter("problem IS NOT NULL").isEmpty()
        whole = prices(spark, path.read_text()).collect()
        got = split_rows(spark, path).orderBy("record_index").collect()
        kept = ["source_created_at", "id_product", "id_category", "trend", "avg_holo"]
        assert [[r[c] for c in kept] for r in got] == [[r[c] for c in kept] for r in whole]
        assert len({r.record_index for r in got}) == 700
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


@pytest.mark.parametrize(
    "content",
    [
        '{"priceGuides": [{"idProduct": 1}, {"idProduct": 2, "avg": 1',
        '{"priceGuides": [{"idProduct": 1}, {"idProduct": 2}',
        '{"priceGuides": [{"idProduct": 1, "x": {"y": 2}}]}',
        '{"priceGuides": [{"idProduct": 1, "note": "a } b"}]}',
        '{"priceGuides": [{"idProduct": 1}, 5, {"idProduct": 2}]}',
        '{"priceGuides": []}',
        "{}",
    ],
)
def test_split_reading_refuses_other_layouts(spark, tmp_path, content):
    path = tmp_path / "odd.json"
    path.write_text(content)
    found = validate.violations(split_rows(spark, path))
    assert not found.isEmpty()
    with pytest.raises(validate.ValidationError):
        validate.raise_on_violations(found)


def test_a_list_behind_any_white_space_is_found(spark):
    row = prices(spark, " \n" * 200 + "[{\"idProduct\": 7, \"avg\": 1}]").first()
    assert row.id_product == 7


def test_anchors_as_a_browser_sees_them(spark):
    from tradebinder.sources.pages import page_links

    html = (
        "<a href=\"/1\">One</a><A class='x' HREF='/2?a=1&amp;b'>Two  <b>bold</b></A><a id=q href=/3>Th\u00a0ree &amp; me</a>"
        "<a href = \"/4\" target=_blank><img alt=''>  Four&nbsp;</a><a name='none'>no</a><abbr href='/5'>no</abbr>"
    )
    rows = page_links(spark.createDataFrame([(1, "http://h/", html)], "page_id long, url string, html string")).collect()
    got = [(r.href, r.link_text) for r in sorted(rows, key=lambda r: r.position)]
    assert got == [("/1", "One"), ("/2?a=1&b", "Two bold"), ("/3", "Th ree & me"), ("/4", "Four")]


def test_rerun_numbers_of_any_size(spark):
    from tradebinder.operators.archive import canonical_files

    names = [("p_2026-01-02.json",), ("p_2026-01-02_rerun-7.json",), ("p_2026-01-02_rerun-99999999999.json",)]
    row = canonical_files(spark.createDataFrame(names, "file_name string")).first()
    assert row.file_name == "p_2026-01-02_rerun-99999999999.json" and row.superseded_count == 2


def test_links_as_a_browser_resolves_them(spark):
    from tradebinder.sources.pages import resolved_links

    cases = {
        '<!-- <a href="/gone">gone</a> --><a href="#top">T</a>': [("T", "https://h.com/d/e/f.html?z=1#top")],
        "<script>var s=\"<a href='/s'>s</a>\";</script><a href=\"?q=1\">q</a>": [("q", "https://h.com/d/e/f.html?q=1")],
        "<a title='a > b' HREF = '../x/./y?a=1&amp;b=2#f'>Caf&eacute; &#8211; &#x27;q&apos; &copy2024 <b>bo</b>ld</a>": [
            ("Café – 'q' ©2024 bold", "https://h.com/d/x/y?a=1&b=2#f")
        ],
        '<a data-href="no" class=x href=bare/p>b</a><a name="n">none</a><a href="//h.org/p">h</a>': [
            ("b", "https://h.com/d/e/bare/p"), ("h", "https://h.org/p")
        ],
        '<a href="/r/../s/..">u</a><a href=" mailto:a@b.c ">m</a><a href="">e</a>': [
            ("u", "https://h.com/"), ("m", "mailto:a@b.c"), ("e", "https://h.com/d/e/f.html?z=1")
        ],
        '<a href="?x=1&copy=2&lt">cp</a>': [("cp", "https://h.com/d/e/f.html?x=1&copy=2<")],
        '<a href="1">one<a href="2">two': [("one", "https://h.com/d/e/1"), ("two", "https://h.com/d/e/2")],
        '<base href="/b/c/"><a href="d">d</a>': [("d", "https://h.com/b/c/d")],
        '<a title="x href=\'/bad\'" href="/good">g</a><img alt="<a href=1>z</a>">': [("g", "https://h.com/good")],
        "<a href=x>&#128; &#0; &#x110000; &#xD800; &notit; &nosuch; &</a>": [("€ \ufffd \ufffd \ufffd ¬it; &nosuch; &", "https://h.com/d/e/x")],
        "": [], None: [],
    }
    rows = [(n, "https://h.com/d/e/f.html?z=1#frag", text) for n, text in enumerate(cases)]
    found = resolved_links(spark.createDataFrame(rows, "page_id long, url string, html string")).orderBy("page_id", "position").collect()
    got = {n: [(r.link_text, r.url) for r in found if r.page_id == n] for n in range(len(rows))}
    assert got == dict(enumerate(cases.values()))


def test_references_are_decoded_like_the_standard_library_does(spark):
    import html

    from tradebinder.sources.pages import decoded

    names = [f"a&{n} b" for n in html.entities.html5] + [f"&#{n};x" for n in (9, 13, 65, 128, 150, 159, 160, 8364, 55296, 128512, 99999999)]
    names += ["&#x41;&#X1F600;", "&&amp;amp;&", "no reference", "&ampx", "&;", "&#;"]
    got = [r.x for r in spark.createDataFrame([(n,) for n in names], "t string").select(decoded(F.col("t")).alias("x")).collect()]
    want = [html.unescape(n) for n in names]
    assert [(n, g) for n, g, w in zip(names, got, want, strict=True) if g != w] == []
