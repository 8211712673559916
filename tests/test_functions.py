import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tradebinder.functions import dates, money, text


@pytest.mark.parametrize(
    "raw, expected",
    [
        ("13", Decimal("13.0000")), ("0", Decimal("0.0000")), (" 1.5 ", Decimal("1.5000")),
        ("1e2", Decimal("100.0000")), ("", None), ("not-a-number", None), ("NaN", None), (None, None),
    ],
)
def test_to_money(one, raw, expected):
    assert one(money.to_money(F.lit(raw).cast("string"))) == expected


@pytest.mark.parametrize(
    "trend, avg30, expected", [(10.0, 20.0, 15.0), (10.0, None, 10.0), (None, 20.0, 20.0), (None, None, None)]
)
def test_estimated_market_value(one, trend, avg30, expected):
    value = money.estimated_market_value(F.lit(trend).cast("double"), F.lit(avg30).cast("double"))
    assert one(value) == expected


def test_percent_change_ignores_missing_and_zero_reference(one):
    def change(current, reference):
        return one(money.percent_change(F.lit(current).cast("double"), F.lit(reference).cast("double")))

    assert change(13.0, 10.0) == pytest.approx(30)
    assert change(13.0, 0.0) is None
    assert change(13.0, None) is None


@pytest.mark.parametrize(
    "percent, expected", [(4.9, None), (5, "low"), (10, "medium"), (25, "medium"), (25.1, "high")]
)
def test_growth_tiers(one, percent, expected):
    assert one(money.tier(F.lit(percent), money.GROWTH_TIERS)) == expected


@pytest.mark.parametrize("age, expected", [(3, "high"), (14, "medium"), (30, "low"), (31, None)])
def test_newness_tiers(one, age, expected):
    assert one(money.newness_tier(F.lit(age))) == expected


@pytest.mark.parametrize("gap, expected", [(13, "low"), (14, "medium"), (30, "medium"), (31, "high")])
def test_gap_tiers(one, gap, expected):
    assert one(money.gap_tier(F.lit(gap))) == expected


@pytest.mark.parametrize(
    "raw, expected",
    [
        ("2026-06-29T02:55:18+0200", "2026-06-29 00:55:18"),
        ("2026-06-29T02:55:18+02:00", "2026-06-29 00:55:18"),
        ("2026-06-29T02:55:18Z", "2026-06-29 02:55:18"),
        ("2026-06-29T02:55:18", None), ("yesterday", None), ("", None), (None, None),
    ],
)
def test_source_created_at(one, raw, expected):
    value = one(dates.source_created_at(F.lit(raw).cast("string")).cast("string"))
    assert value == expected


@pytest.mark.parametrize(
    "instant, expected",
    [
        ("2026-07-03T12:00:00Z", "2026-07-03"), ("2026-07-03T23:30:00Z", "2026-07-04"),
        ("2026-01-03T22:30:00Z", "2026-01-03"), ("2026-01-03T23:30:00Z", "2026-01-04"),
        ("2026-03-15T10:00:00Z", "2026-03-15"),
    ],
)
def test_pipeline_date_follows_daylight_saving(spark, instant, expected):
    frame = spark.range(1).withColumn("at", F.lit(instant).cast("timestamp"))
    day = frame.select(dates.pipeline_date(frame, "at").alias("d")).first().d
    assert day == datetime.date.fromisoformat(expected)


def test_pipeline_date_refuses_instants_without_zone(spark):
    frame = spark.sql("SELECT TIMESTAMP_NTZ '2026-07-03 12:00:00' AS at")
    with pytest.raises(ValueError):
        dates.pipeline_date(frame, "at")


def test_archive_names(one):
    day = F.lit("2026-07-03").cast("date")

    def name(rerun):
        return one(dates.archive_name(F.lit("price_guide_6"), day, F.lit(rerun).cast("int")))

    assert name(None) == "price_guide_6_2026-07-03.json"
    assert name(1) == "price_guide_6_2026-07-03_rerun-01.json"
    assert name(12) == "price_guide_6_2026-07-03_rerun-12.json"
    with pytest.raises(Exception, match="starts at 1"):
        name(0)


def test_slash_dates(one):
    assert one(dates.slash_date(F.lit("2022/09/09"))) == datetime.date(2022, 9, 9)
    assert one(dates.slash_date(F.lit(""))) is None
    assert one(dates.slash_timestamp(F.lit("2022/09/09 13:45:00"))) == datetime.datetime(2022, 9, 9, 13, 45)
    with pytest.raises(Exception):
        one(dates.slash_date(F.lit("09.09.2022")))


@pytest.mark.parametrize(
    "raw, expected",
    [("true", True), (" YES ", True), ("0", False), ("No", False), ("maybe", True), ("", True), (None, True)],
)
def test_parse_bool(one, raw, expected):
    assert one(text.parse_bool(F.lit(raw).cast("string"))) is expected


def test_strip_and_blank(one):
    assert one(text.strip(F.lit("\t a b \n"))) == "a b"
    assert one(text.blank_to_null(F.lit(" \t"))) is None
    assert one(text.optional_int(F.lit(" 7 "))) == 7
    with pytest.raises(Exception):
        one(text.optional_int(F.lit("seven")))


def test_first_present_prefers_presence_over_value(one):
    record = F.from_json(F.lit('{"b": null, "c": "3"}'), "map<string,string>")
    assert one(text.first_present(record, ["a", "b", "c"])) is None
    assert one(text.first_present(record, ["a", "c"])) == "3"


@pytest.mark.parametrize(
    "name, series",
    [("Sword & Shield - Lost Origin", "Sword & Shield"), ("lost  origin", None), ("Lost-Origin", None)],
)
def test_matching_name(one, name, series):
    label = None if series is None else F.lit(series)
    assert one(text.matching_name(F.lit(name), label)) == "lost origin"


def test_matching_name_spells_out_ampersands(one):
    assert one(text.matching_name(F.lit("Black & White"))) == one(text.matching_name(F.lit("black and white")))


def test_months_since(one):
    def months(release):
        return one(dates.months_since(F.lit(release).cast("date"), F.lit("2024-03-15").cast("date")))

    assert months("2024-01-16") == 1
    assert months("2023-03-15") == 12
