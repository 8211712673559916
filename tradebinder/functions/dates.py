"""Dates, instants and archive file names."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradebinder.schemas import PIPELINE_ZONE

_OFFSET = r"([+-]\d{2}:?\d{2}|Z)$"


def as_date(value: datetime.date | str | Column) -> Column:
    """A date given as literal, ISO text or column (for example a scalar subquery)."""
    return value if isinstance(value, Column) else F.lit(value).cast("date")


def as_instant(value: datetime.datetime | str | Column) -> Column:
    return value if isinstance(value, Column) else F.lit(value).cast("timestamp")


def source_created_at(text: Column) -> Column:
    """File creation instant with offset +0200 or +02:00; anything else is null."""
    instant = F.try_to_timestamp(text, F.lit("yyyy-MM-dd'T'HH:mm:ss[XXX][XX]"))
    return F.when(text.rlike(_OFFSET), instant)


def pipeline_date(df: DataFrame, column: str, zone: str = PIPELINE_ZONE) -> Column:
    """Calendar date of an instant in a named zone.  A column without zone is ambiguous
    and is refused.  Needs a UTC session (see session.configure)."""
    if not isinstance(df.schema[column].dataType, T.TimestampType):
        raise ValueError(f"{column} must be an instant (timestamp with zone)")
    return zone_date(F.col(column), zone)


def zone_date(instant: Column, zone: str = PIPELINE_ZONE) -> Column:
    return F.to_date(F.from_utc_timestamp(instant, zone))


def slash_date(text: Column) -> Column:
    """YYYY/MM/DD; empty is null, malformed raises."""
    return F.to_date(F.nullif(text, F.lit("")), "yyyy/MM/dd")


def slash_timestamp(text: Column) -> Column:
    """YYYY/MM/DD HH:MM:SS without zone; empty is null, malformed raises."""
    return F.to_timestamp_ntz(F.nullif(text, F.lit("")), F.lit("yyyy/MM/dd HH:mm:ss"))


def price_age_days(first_seen_at: Column, as_of: Column, zone: str = PIPELINE_ZONE) -> Column:
    return F.datediff(as_of, zone_date(first_seen_at, zone))


def months_since(release_date: Column, as_of: Column) -> Column:
    """Whole months, rounded down; negative for a release still to come."""
    return F.floor(F.months_between(as_of, release_date)).cast("int")


def archive_name(prefix: Column, date: Column, rerun: Column) -> Column:
    """Base name for rerun null, suffixed name for rerun 1 and up; below 1 raises."""
    day = date.cast("string")
    number = F.concat(F.when(rerun < 10, "0").otherwise(""), rerun.cast("string"))
    base = F.concat(prefix, F.lit("_"), day, F.lit(".json"))
    again = F.concat(prefix, F.lit("_"), day, F.lit("_rerun-"), number, F.lit(".json"))
    return (
        F.when(rerun.isNull(), base)
        .when(rerun >= 1, again)
        .otherwise(F.raise_error(F.lit("a rerun number starts at 1")))
    )
