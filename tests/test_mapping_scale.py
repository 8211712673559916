"""Candidates arise in the last join; repeated and missing ids keep their meaning."""

import datetime

import pytest
from pyspark.sql import functions as F

from tradebinder.operators import mapping, views

DAY = datetime.date(2026, 7, 3)
NOW = "2026-07-01 06:00:00"
EXPANSION = (
    "id_expansion long, name_en string, name_de string, series_en string, series_de string, slug string, set_code string, "
    "release_date date, card_count int, is_active boolean"
)
SET = "tcg_set_id string, name_en string, series_en string, ptcgo_code string, release_date date"


def days(n):
    return DAY + datetime.timedelta(days=n)


def expansion(number, name, slug=None, code=None, day=None):
    return (number, name, f"DE {name}", "A", "DE A", slug, code, day, 5, True)


@pytest.fixture(scope="module")
def both(spark):
    """Repeated ids on both sides, null ids, pairs found under several keys."""
    expansions = [
        expansion(1, "Fire Storm", "Fire-Storm", "FS", DAY), expansion(1, "Fire Rain", None, "FR", days(2)),
        expansion(2, "Fire", None, None, days(1)), expansion(3, "Nothing"), expansion(None, "Fire Storm", None, None, DAY),
        expansion(4, "Fire Storm", None, "XX", days(-3)), expansion(4, "Fire Storm", None, "XX", days(-3)),
    ]
    sets = [
        ("a", "Fire Storm", "B", "FS", DAY), ("a", "Fire Hail", "B", "FR", days(4)), ("b", "fire storm!", "B", None, days(1)),
        ("c", "Fire Ash", "B", None, days(-2)), ("c", "Fire Ash", "B", None, days(-2)), (None, "Fire Storm", "B", "XX", DAY),
        ("d", "Water", "B", "XX", DAY), ("e", "Fire Wall", "B", None, days(9)),
    ]
    return spark.createDataFrame(expansions, EXPANSION), spark.createDataFrame(sets, SET)


def expected(expansions, sets):
    """Pairs by plain comparison of all keys: (expansion, set) to the least (rank, distance, key)."""
    ranks = {m: i for i, (m, _) in enumerate(mapping.METHODS)}
    of_sets = mapping.mapping_keys(sets).collect()
    pairs, numbers = {}, {r.id_expansion for r in expansions.collect()}
    for e in mapping._expansion_keys(expansions, mapping.NEAR_DAYS).collect():
        same = [s for s in of_sets if (s.method, s.match_key) == (e.method, e.match_key)]
        for s in same:
            if e.id_expansion is not None and s.tcg_set_id is not None:
                found = (ranks[e.method], e.distance, e.match_key, e.method, len(same))
                pair = (e.id_expansion, s.tcg_set_id)
                pairs[pair] = min(pairs.get(pair, found), found)
    rows = set()
    for number in numbers:
        own = {s: f for (n, s), f in pairs.items() if n == number}
        if not own:
            rows.add((number, None, "none", None, 0, False))
        first = min(((f[0], f[1], s) for s, f in own.items()), default=None)
        rows |= {(number, s, f[3], f[2], f[4], (f[0], f[1], s) == first) for s, f in own.items()}
    return sorted(rows, key=str)


def test_candidates_of_repeated_and_missing_ids(both):
    found = mapping.mapping_candidates(*both, NOW)
    shown = found.select("id_expansion", "tcg_set_id", "match_method", "match_key", "candidate_count", "is_primary_mapping")
    assert sorted(map(tuple, shown.collect()), key=str) == expected(*both)


def test_review_list_carried_or_joined(spark, both):
    market, official = views.review_columns(*both)
    manual = spark.createDataFrame([(3, "d", "by hand"), (2, "zz", "gone")], "id_expansion long, tcg_set_id string, notes string")
    for chosen in (None, manual):
        joined = views.mappings_for_review(mapping.mapping_candidates(*both, NOW, chosen), *both)
        carrying = mapping.mapping_candidates(*both, NOW, chosen, market=market, official=official)
        carried = views.mappings_for_review(carrying, *both)
        assert carried.columns == joined.columns
        assert sorted(carried.collect(), key=str) == sorted(joined.collect(), key=str)


def test_candidates_are_not_shuffled(spark):
    """200 expansions and 200 sets of one day and first word: 40,000 candidates, few rows moved."""
    number = F.col("id").cast("string")
    expansions = spark.range(200).select(
        F.col("id").alias("id_expansion"), F.concat(F.lit("Fire "), number).alias("name_en"), F.lit("A").alias("series_en"),
        F.lit(None).cast("string").alias("slug"), F.lit(DAY).alias("release_date"),
    )
    sets = spark.range(200).select(
        F.concat(F.lit("s"), number).alias("tcg_set_id"), F.concat(F.lit("Fire x"), number).alias("name_en"),
        F.lit("B").alias("series_en"), F.lit(None).cast("string").alias("ptcgo_code"), F.lit(DAY).alias("release_date"),
    )
    rows = mapping.mapping_candidates(expansions, sets, NOW)
    assert rows.groupBy().agg(F.count("*"), F.count_if("is_primary_mapping")).first() == (40000, 200)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    last = min(i for i, line in enumerate(plan.splitlines()) if "Join" in line)
    assert not any("Exchange" in line for line in plan.splitlines()[:last])
