"""Dated analytics signals.

Every price signal starts from one aggregate per product (price_points); all lookback
windows are conditional picks inside that aggregate, so history is read and shuffled once
whatever the number of windows.  The signals of a product are entries of one array that is
unfolded, so a further signal type costs no further pass.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradebinder.functions.dates import as_date, as_instant, price_age_days
from tradebinder.functions.money import (
    GAIN_LOSS_TIERS,
    GROWTH_TIERS,
    SPIKE_TIERS,
    amount_text,
    estimated_market_value,
    gap_tier,
    is_new_product,
    newness_tier,
    percent_change,
    tier,
    usable_price,
)
from tradebinder.functions.text import surrogate_id
from tradebinder.operators.lookup import spread_join
from tradebinder.schemas import (
    GROWTH_LOOKBACKS,
    MIN_GROWTH_HISTORY_DAYS,
    MONEY,
    PIPELINE_ZONE,
    SIGNAL_COLUMNS,
)


def price_points(
    prices: DataFrame, as_of, lookbacks=GROWTH_LOOKBACKS, exact_dates: bool = False
) -> DataFrame:
    """Per product, over snapshots up to the date: the latest row, the first and the last
    usable date, and for every N the trend of the latest snapshot at least N days old
    (with exact_dates: of the snapshot exactly N days old)."""
    day = as_date(as_of)
    date = F.col("snapshot_date")

    def old_enough(n: int) -> Column:
        cutoff = F.date_sub(day, n)
        return date == cutoff if exact_dates else date <= cutoff

    earlier = [
        F.max_by("trend", F.when(old_enough(n), date)).alias(f"trend_{n}_days_ago") for n in lookbacks
    ]
    return (
        prices.filter(date <= day)
        .groupBy("id_product")
        .agg(
            F.max(date).alias("latest_date"),
            F.min(date).alias("first_date"),
            F.max(F.when(usable_price(F.col("trend"), F.col("avg30")), date)).alias("last_usable_date"),
            F.max_by("trend", date).alias("trend"),
            F.max_by("avg30", date).alias("avg30"),
            *earlier,
        )
    )


def signal_base(
    products: DataFrame, points: DataFrame | None, as_of, zone: str = PIPELINE_ZONE
) -> DataFrame:
    """One row per catalog product with its age and, if points are given, its prices.  Both
    sides are unique by id.  Price rows of ids the catalog lacks give no signals."""
    known = products.select("id_product", "product_group", "is_active_in_catalog", "first_seen_at")
    aged = known.withColumn("age_days", price_age_days(F.col("first_seen_at"), as_date(as_of), zone))
    return aged if points is None else aged.join(points, "id_product", "left")


@dataclass(frozen=True)
class Signal:
    """One possible signal of a row: when it applies and what it says."""

    kind: str | Column
    applies: Column
    value: Column | None
    strength: Column
    reference: Column | None
    current: Column | None
    description: Column
    lookback: int | None = None

    def entry(self, money: T.DataType) -> Column:
        def amount(column: Column | None) -> Column:
            return (F.lit(None) if column is None else column).cast(money)

        kind = F.lit(self.kind) if isinstance(self.kind, str) else self.kind
        return F.when(
            self.applies,
            F.struct(
                kind.alias("signal_type"),
                amount(self.value).alias("signal_value"),
                self.strength.cast("string").alias("signal_strength"),
                F.lit(self.lookback).cast("int").alias("lookback_days"),
                amount(self.reference).alias("reference_value"),
                amount(self.current).alias("current_value"),
                self.description.alias("signal_description"),
            ),
        )


def emit(
    rows: DataFrame, candidates: list[Signal], as_of, run_ts, item: Column | None = None,
    money: T.DataType = T.DoubleType(),
) -> DataFrame:
    """Every signal that applies to a row, in the common layout.  All signal types of a row
    come out of one pass over it."""
    day = as_date(as_of)
    item = F.lit(None).cast("string") if item is None else item.cast("string")
    entries = F.array_compact(F.array(*[c.entry(money) for c in candidates]))
    found = rows.select("id_product", item.alias("collection_item_id"), F.inline(entries))
    return found.select(
        surrogate_id(
            day, *[F.col(c) for c in ("signal_type", "id_product", "collection_item_id", "lookback_days")]
        ).alias("signal_id"),
        day.alias("signal_date"),
        "*",
        as_instant(run_ts).alias("created_at"),
    ).select(*SIGNAL_COLUMNS)


def money_type(rows: DataFrame, column: str) -> T.DataType:
    """Amounts of signals are doubles for double prices and MONEY for decimal ones."""
    return MONEY if isinstance(rows.schema[column].dataType, T.DecimalType) else T.DoubleType()


def growth_signals(lookbacks=GROWTH_LOOKBACKS, kind: str = "growth", only: Column | None = None) -> list[Signal]:
    """Trend gained at least 5 percent against N days ago, for products that are no longer
    new and have a week of history."""
    stable = ~is_new_product(F.col("age_days")) & (
        F.datediff("latest_date", "first_date") >= MIN_GROWTH_HISTORY_DAYS
    )
    found = []
    for n in lookbacks:
        previous = F.col(f"trend_{n}_days_ago")
        percent = percent_change(F.col("trend"), previous)
        applies = stable & (percent >= GROWTH_TIERS[0])
        found.append(
            Signal(
                kind, applies if only is None else applies & only, percent, tier(percent, GROWTH_TIERS),
                previous, F.col("trend"),
                F.concat(
                    F.lit("Product increased by "), amount_text(percent),
                    F.lit(f"% over the last {n} days."),
                ),
                n,
            )
        )
    return found


def spike_signal() -> Signal:
    """Latest trend at least 10 percent above the 30-day average; no lookback window."""
    percent = percent_change(F.col("trend"), F.col("avg30"))
    return Signal(
        "price_spike", ~is_new_product(F.col("age_days")) & (percent >= SPIKE_TIERS[0]), percent,
        tier(percent, SPIKE_TIERS), F.col("avg30"), F.col("trend"),
        F.concat(F.lit("Current trend price is "), amount_text(percent), F.lit("% above avg30.")),
    )


def new_product_signal() -> Signal:
    """First seen at most 30 days ago, and not after the signal date."""
    age = F.col("age_days")
    return Signal(
        "new_product", (age >= 0) & (age <= 30), age, newness_tier(age), None, None,
        F.concat(F.lit("Product was first seen "), age.cast("string"), F.lit(" days ago.")),
    )


def missing_price_signal(as_of, latest_snapshot=None) -> Signal:
    """Active products whose most recent price row has neither trend nor 30-day average, or
    that have no price row at all, once a snapshot after their first day exists.  The
    signal date counts as a snapshot date unless latest_snapshot says otherwise.  Strength
    grows with the days since the last usable price."""
    day = as_date(as_of)
    cycle = day if latest_snapshot is None else as_date(latest_snapshot)
    had_a_chance = F.date_sub(day, F.col("age_days")) < cycle
    gap = F.coalesce(F.datediff(day, "last_usable_date"), F.col("age_days"))
    unusable = ~usable_price(F.col("trend"), F.col("avg30"))
    return Signal(
        "missing_price_data", F.col("is_active_in_catalog") & unusable & had_a_chance,
        None, gap_tier(gap), None, None,
        F.lit("No trend or avg30 price available as of this date."),
    )


def buy_opportunity_signal(history_days: int = 90) -> Signal:
    """Trend below its 30-day average although it grew over 90 days, with that much history."""
    trend, average = F.col("trend"), F.col("avg30")
    applies = (
        (trend < average)
        & (percent_change(trend, F.col(f"trend_{history_days}_days_ago")) > 0)
        & (F.datediff("latest_date", "first_date") >= history_days)
        & ~is_new_product(F.col("age_days"))
    )
    return Signal(
        "potential_buy_opportunity", applies, percent_change(trend, average), F.lit(None), average, trend,
        F.lit("Current trend price is below avg30 while long-term growth is positive."), history_days,
    )


def growth(base: DataFrame, as_of, run_ts, lookbacks=GROWTH_LOOKBACKS) -> DataFrame:
    return emit(base, growth_signals(lookbacks), as_of, run_ts, money=money_type(base, "trend"))


def sealed_growth(base: DataFrame, as_of, run_ts, lookbacks=GROWTH_LOOKBACKS) -> DataFrame:
    """Growth of non-single products."""
    sealed = growth_signals(lookbacks, "sealed_growth", F.col("product_group") == "non_single")
    return emit(base, sealed, as_of, run_ts, money=money_type(base, "trend"))


def price_spike(base: DataFrame, as_of, run_ts) -> DataFrame:
    return emit(base, [spike_signal()], as_of, run_ts, money=money_type(base, "trend"))


def new_product(products: DataFrame, as_of, run_ts, zone: str = PIPELINE_ZONE) -> DataFrame:
    return emit(signal_base(products, None, as_of, zone), [new_product_signal()], as_of, run_ts)


def missing_price_data(base: DataFrame, as_of, run_ts, latest_snapshot=None) -> DataFrame:
    return emit(base, [missing_price_signal(as_of, latest_snapshot)], as_of, run_ts)


def potential_buy_opportunity(base: DataFrame, as_of, run_ts, history_days: int = 90) -> DataFrame:
    candidates = [buy_opportunity_signal(history_days)]
    return emit(base, candidates, as_of, run_ts, money=money_type(base, "trend"))


def collection_gain_loss(items: DataFrame, latest: DataFrame, as_of, run_ts) -> DataFrame:
    """One signal per unsold item whose value differs from its known purchase price; the
    sign decides between gain and loss, and the amount is always positive."""
    value, price = F.col("estimated_market_value"), F.col("purchase_price")
    bought = items.filter(~F.col("is_sold") & price.isNotNull()).select(
        "collection_item_id", "id_product", "purchase_price"
    )
    valued = latest.select("id_product", "estimated_market_value")
    rows = spread_join(bought, valued, ["id_product"], "inner", ["collection_item_id"])
    gained, amount = value > price, F.abs(value - price)
    candidate = Signal(
        F.when(gained, "collection_gain").otherwise("collection_loss"), value != price, amount,
        tier(F.abs(percent_change(value, price)), GAIN_LOSS_TIERS), price, value,
        F.concat(
            F.lit("This collection item is currently estimated "), amount_text(amount), F.lit(" EUR "),
            F.when(gained, "above").otherwise("below"), F.lit(" its purchase price."),
        ),
    )
    return emit(
        rows.filter(value != price), [candidate], as_of, run_ts, F.col("collection_item_id"),
        money_type(rows, "purchase_price"),
    )


def all_signals(
    points: DataFrame, products: DataFrame, items: DataFrame, as_of, run_ts,
    lookbacks=GROWTH_LOOKBACKS, latest_snapshot=None,
) -> DataFrame:
    """The six signal types of a date in one table, from price_points of that date.

    All product signals come from one join of catalog and points; the items are valued with
    the same points.
    """
    base = signal_base(products, points, as_of)
    candidates = [
        *growth_signals(lookbacks),
        spike_signal(),
        new_product_signal(),
        missing_price_signal(as_of, latest_snapshot),
    ]
    of_products = emit(base, candidates, as_of, run_ts, money=money_type(base, "trend"))
    value = estimated_market_value(F.col("trend"), F.col("avg30"))
    latest = points.select("id_product", value.alias("estimated_market_value"))
    return of_products.unionByName(collection_gain_loss(items, latest, as_of, run_ts))


def signals_of(
    kind: str, points: DataFrame, products: DataFrame, items: DataFrame, as_of, run_ts,
    lookbacks=GROWTH_LOOKBACKS, latest_snapshot=None,
) -> DataFrame:
    """The rows of all_signals that have one type, without building the others."""
    if kind in ("collection_gain", "collection_loss"):
        value = estimated_market_value(F.col("trend"), F.col("avg30"))
        latest = points.select("id_product", value.alias("estimated_market_value"))
        return collection_gain_loss(items, latest, as_of, run_ts).filter(F.col("signal_type") == kind)
    money = money_type(points, "trend")
    if kind == "new_product":
        return emit(signal_base(products, None, as_of), [new_product_signal()], as_of, run_ts, money=money)
    candidates = {
        "growth": lambda: growth_signals(lookbacks),
        "price_spike": lambda: [spike_signal()],
        "missing_price_data": lambda: [missing_price_signal(as_of, latest_snapshot)],
    }
    return emit(signal_base(products, points, as_of), candidates[kind](), as_of, run_ts, money=money)


# Signal types behind each signal view.
SIGNAL_VIEWS = {
    "top_growth_products": "growth",
    "recent_price_spikes": "price_spike",
    "new_products": "new_product",
    "collection_gains": "collection_gain",
    "collection_losses": "collection_loss",
}


def signal_view(signals: DataFrame, products: DataFrame, kind: str) -> DataFrame:
    """Signals of one type with product name and group, largest value first."""
    names = products.select("id_product", "name", "product_group")
    rows = signals.filter(F.col("signal_type") == kind)
    return (
        spread_join(rows, names, ["id_product"], "left", ["signal_id"])
        .select(
            "signal_date", "id_product", "name", "product_group", "collection_item_id",
            "signal_value", "signal_strength", "lookback_days", "reference_value", "current_value",
        )
        .orderBy(
            F.desc_nulls_last(F.abs("signal_value")), F.asc("id_product"),
            F.asc_nulls_first("collection_item_id"), F.asc_nulls_first("lookback_days"),
        )
    )
