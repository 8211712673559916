"""Text cleaning, lenient parsing and matching keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spellings of the two truth values in reference files.
TRUE_WORDS = ["true", "1", "yes", "y"]
FALSE_WORDS = ["false", "0", "no", "n"]


def strip(value: Column) -> Column:
    """Remove all leading and trailing whitespace: tabs, line breaks, no-break spaces."""
    return F.regexp_replace(value, r"(?U)^\s+|\s+$", "")


def blank_to_null(value: Column) -> Column:
    return F.nullif(strip(value), F.lit(""))


def is_blank(value: Column) -> Column:
    """SQL view of blank: null, empty or spaces only."""
    return value.isNull() | (F.trim(value) == "")


def parse_bool(value: Column) -> Column:
    """Known spellings of true and false; anything else, null included, counts as true."""
    word = F.lower(strip(value))
    return F.when(word.isin(FALSE_WORDS), False).otherwise(True)


def optional_int(value: Column) -> Column:
    """Blank becomes null; text that is no whole number raises."""
    return blank_to_null(value).cast("int")


def id_number(value: Column) -> Column:
    """Whole-number id, or null.  Callers report a non-null input that gives null."""
    return F.nullif(value, F.lit("")).try_cast("bigint")


def first_present(fields: Column, names: list[str]) -> Column:
    """Value of the first name that exists in the map, even when that value is null."""
    picked = None
    for name in names:
        found = F.map_contains_key(fields, name)
        value = fields[name]
        picked = F.when(found, value) if picked is None else picked.when(found, value)
    return picked


def matching_name(name: Column, series: Column | None = None) -> Column:
    """Key for comparing names: lower case, ampersand as a word, no punctuation, and no
    leading series label.  Stored names keep their spelling."""
    value = F.lower(strip(name))
    if series is not None:
        label = F.concat(F.lower(strip(series)), F.lit(" - "))
        value = F.when(
            F.startswith(value, label), F.substring(value, F.length(label) + 1, F.length(value))
        ).otherwise(value)
    value = F.regexp_replace(value, "&", " and ")
    value = F.regexp_replace(value, r"[^\p{L}\p{N}]+", " ")
    return F.nullif(F.trim(value), F.lit(""))


def surrogate_id(*parts: Column) -> Column:
    """Stable id: the same natural key gives the same id on every retry."""
    texts = [F.coalesce(part.cast("string"), F.lit("")) for part in parts]
    return F.sha2(F.concat_ws("~", *texts), 256)
