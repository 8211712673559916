"""Candidate mapping between market expansions and official sets.

Sets are indexed by one key per method.  Every set behind a key is a candidate, with the
number of sets that share it; so the result has as many rows as there are pairs to review.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradebinder.functions.dates import as_instant
from tradebinder.functions.text import blank_to_null, matching_name
from tradebinder.operators.lookup import by_shuffle, spread_join
from tradebinder.schemas import CONFIDENCE, TRUSTED_CONFIDENCE

# Methods from the most to the least certain, with their confidence.
METHODS = [
    ("exact_name", 1.00),
    ("normalized_name", 0.95),
    ("code", 0.95),
    ("slug", 0.90),
    ("date_name_combo", 0.75),
]
NEAR_DAYS = 7


def _first_word(name: Column) -> Column:
    return F.split(name, " ")[0]


def mapping_keys(sets: DataFrame) -> DataFrame:
    """(method, match_key, tcg_set_id): every key under which a set can be found."""
    words = matching_name(F.col("name_en"), F.col("series_en"))
    day = F.col("release_date").cast("string")
    keys = {
        "exact_name": blank_to_null(F.col("name_en")),
        "normalized_name": words,
        "code": F.upper(blank_to_null(F.col("ptcgo_code"))),
        "slug": words,
        "date_name_combo": F.concat(_first_word(words), F.lit("|"), day),
    }
    entries = F.array(
        *[F.struct(F.lit(m).alias("method"), k.alias("match_key")) for m, k in keys.items()]
    )
    return sets.select("tcg_set_id", F.inline(entries)).filter("match_key IS NOT NULL").select(
        "method", "match_key", "tcg_set_id"
    )


def _entry(method: str, key: Column, distance: Column) -> Column:
    return F.struct(F.lit(method).alias("method"), key.alias("match_key"), distance.alias("distance"))


def _expansion_keys(expansions: DataFrame, near_days: int) -> DataFrame:
    """(id_expansion, method, match_key, distance), all keys of an expansion from one scan.
    Date proximity is an equality on each of the 2 * near_days + 1 neighbouring days, not
    a range join."""
    words = matching_name(F.col("name_en"), F.col("series_en"))
    code = F.col("set_code") if "set_code" in expansions.columns else F.lit(None).cast("string")
    keyed = expansions.select(
        "id_expansion",
        "release_date",
        words.alias("words"),
        F.array(
            _entry("exact_name", blank_to_null(F.col("name_en")), F.lit(0)),
            _entry("normalized_name", words, F.lit(0)),
            _entry("code", F.upper(blank_to_null(code)), F.lit(0)),
            _entry("slug", matching_name(F.col("slug")), F.lit(0)),
        ).alias("direct"),
    )

    def near(offset: Column) -> Column:
        day = F.date_add("release_date", offset).cast("string")
        return _entry(
            "date_name_combo", F.concat(_first_word(F.col("words")), F.lit("|"), day), F.abs(offset)
        )

    nearby = F.transform(F.sequence(F.lit(-near_days), F.lit(near_days)), near)
    entries = keyed.select("id_expansion", F.inline_outer(F.concat("direct", nearby)))
    return entries.filter((F.col("match_key").isNotNull()) | (F.col("method") == "exact_name"))


def _found_by(method: Column, key: Column) -> Column:
    return F.concat(method, F.lit("|"), key)


def _listed(rows: DataFrame, key: str, name: str) -> DataFrame:
    """All rows of a key as one list, for candidates that carry them."""
    values = [c for c in rows.columns if c != key]
    return rows.filter(F.col(key).isNotNull()).groupBy(key).agg(F.collect_list(F.struct(*values)).alias(name))


def _set_index(sets: DataFrame, official: DataFrame | None) -> DataFrame:
    """(method, match_key, tcg_set_id, codes): a set once per key, with all its keys."""
    keys = mapping_keys(sets).filter("tcg_set_id IS NOT NULL")
    own = keys.groupBy("tcg_set_id").agg(F.collect_set(F.struct("method", "match_key")).alias("keys"))
    codes = F.transform("keys", lambda k: _found_by(k["method"], k["match_key"]))
    carried = []
    if official is not None:
        own = own.join(by_shuffle(_listed(official, "tcg_set_id", "official")), "tcg_set_id", "left")
        carried = ["official"]
    return own.select("tcg_set_id", codes.alias("codes"), *carried, F.inline("keys"))


def mapping_candidates(
    expansions: DataFrame, sets: DataFrame, run_ts, manual: DataFrame | None = None,
    near_days: int = NEAR_DAYS, market: DataFrame | None = None, official: DataFrame | None = None,
) -> DataFrame:
    """Every candidate set of an expansion, once, by its most certain method; the first of them
    (method, distance, id) is the primary mapping, the others always need review.

    candidate_count is the number of sets that share the key; more than one is never
    trusted.  Expansions without any candidate are one unmatched row with confidence 0.
    Rows of ``manual`` (id_expansion, tcg_set_id, notes) replace every automatic result.

    There can be far more candidates than expansions and sets, so they come out of the last
    join and are not shuffled.  The primary mapping follows from the least set id per key,
    and a candidate that shares a more certain key as well is dropped where it arises, as
    both sides bring their keys.  For the same reason rows of ``market`` (by id_expansion)
    and ``official`` (by tcg_set_id) can be carried along as lists of these names.
    """
    now = as_instant(run_ts)
    shared = mapping_keys(sets).groupBy("method", "match_key").agg(
        F.count("*").alias("candidate_count"), F.min("tcg_set_id").alias("least_id")
    )
    rank = F.create_map(*[F.lit(x) for pair in [(m, i) for i, (m, _) in enumerate(METHODS)] for x in pair])
    score = F.create_map(*[F.lit(x) for pair in METHODS for x in pair])
    hits = spread_join(
        _expansion_keys(expansions, near_days), shared, ["method", "match_key"], "left", ["id_expansion"]
    )
    hit = F.col("least_id").isNotNull() & F.col("id_expansion").isNotNull()
    place = [rank[F.col("method")].alias("rank"), F.col("distance")]
    known = hits.groupBy("id_expansion").agg(
        F.min(F.when(hit, F.struct(*place, F.col("least_id").alias("id")))).alias("first"),
        F.array_sort(F.collect_set(F.when(hit, F.struct(*place, "match_key", "method", "candidate_count")))).alias("keys"),
    )
    carried = []
    if market is not None:
        known = known.join(by_shuffle(_listed(market, "id_expansion", "market")), "id_expansion", "left")
        carried.append("market")
    if manual is not None:
        known = known.join(by_shuffle(manual.select("id_expansion")), "id_expansion", "left_anti")
    keyed = known.select("id_expansion", "first", "keys", *carried, F.posexplode_outer("keys").alias("at", "key"))
    surer = F.transform(F.slice("keys", 1, F.col("at")), lambda k: _found_by(k["method"], k["match_key"]))
    keyed = keyed.select("id_expansion", "first", *carried, surer.alias("surer"), "key.*")
    if official is not None:
        carried.append("official")
    pairs = spread_join(keyed, _set_index(sets, official), ["method", "match_key"], "left", ["id_expansion"])
    best = pairs.filter(F.col("method").isNull() | ~F.arrays_overlap("surer", "codes"))
    confidence = F.when(
        F.col("candidate_count") > 1, F.least(score[F.col("method")], F.lit(0.70))
    ).otherwise(score[F.col("method")])
    order = F.struct("rank", "distance", F.col("tcg_set_id").alias("id"))
    automatic = best.select(
        "id_expansion",
        "tcg_set_id",
        F.coalesce("method", F.lit("none")).alias("match_method"),
        F.coalesce(confidence, F.lit(0.0)).cast(CONFIDENCE).alias("match_confidence"),
        F.when(F.col("method").isNotNull(), order == F.col("first")).alias("is_primary_mapping"),
        "match_key",
        F.coalesce("candidate_count", F.lit(0)).alias("candidate_count"),
        F.lit(None).cast("string").alias("notes"),
        *carried,
    )
    if manual is not None:
        decided = manual.select(
            "id_expansion",
            "tcg_set_id",
            F.lit("manual").alias("match_method"),
            F.lit(1.0).cast(CONFIDENCE).alias("match_confidence"),
            F.lit(True).alias("is_primary_mapping"),
            F.lit(None).cast("string").alias("match_key"),
            F.lit(1).cast("long").alias("candidate_count"),
            "notes",
        )
        for rows, key, name in ((market, "id_expansion", "market"), (official, "tcg_set_id", "official")):
            if rows is not None:
                decided = decided.join(by_shuffle(_listed(rows, key, name)), key, "left")
        automatic = automatic.unionByName(decided)
    primary = F.coalesce("is_primary_mapping", F.lit(False))
    trusted = primary & (F.col("match_confidence") >= TRUSTED_CONFIDENCE)
    status = (
        F.when(F.col("tcg_set_id").isNull(), "unmatched").when(trusted, "matched").otherwise("manual_review")
    )
    return automatic.select(
        "id_expansion",
        "tcg_set_id",
        status.alias("match_status"),
        "match_method",
        "match_confidence",
        primary.alias("is_primary_mapping"),
        (~trusted).alias("needs_review"),
        "notes",
        "match_key",
        "candidate_count",
        now.alias("created_at"),
        now.alias("updated_at"),
        *carried,
    )
