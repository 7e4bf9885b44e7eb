import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from helpers import day, rows
from regiopanel.operators.allocate import allocate_proportional, allocation_residuals, append_subtotal
from regiopanel.operators.crosswalk import build_crosswalk, crosswalk_report, postal_codes, postal_regions
from regiopanel.operators.doses import (
    add_unknown_place_doses,
    doses_by_status,
    known_places,
    unexpected_levels,
    unknown_places,
)
from regiopanel.operators.enrich import enrich, hospital_incidence, icu_occupancy, inherit_parent
from regiopanel.operators.indicators import indicators
from regiopanel.operators.quality import (
    DataCheckError,
    distinct_counts,
    duplicate_keys,
    missing_days,
    profile_nulls,
    profile_time_series,
    total_lookup,
    unmatched_keys,
)
from regiopanel.operators.rollup import population_by_level, rollup_country, rollup_levels, rollup_state, state_of
from regiopanel.operators.vintage import inherit_vintages, stamp_vintage, stamp_vintages

PANEL = "geo int, day date, cases long, deaths long, population long"


@pytest.fixture(scope="module")
def ramp(spark):
    """14 days, cases 0, 0, 1, 2 ... 12, one death on day 12."""
    data = [(1001, day(d), max(0, d - 2), int(d == 12), 90_000) for d in range(1, 15)]
    return spark.createDataFrame(data, PANEL)


def test_indicators_by_hand(ramp):
    out = {r.day: r for r in indicators(ramp, dose_levels=()).collect()}
    expected = {
        11: (46.7, 2.14, None, 0.0005, 0.0),
        12: (54.4, 1.89, None, 0.0006, 0.0182),
        13: (62.2, 1.73, 1.8, 0.0007, 0.0152),
        14: (70.0, 1.62, 1.36, 0.0009, 0.0128),
    }
    for n, values in expected.items():
        r = out[day(n)]
        assert (r.incidence, r.r4, r.r7, r.infection_rate, r.lethality_rate) == values
    assert all(out[day(n)].r4 is None for n in range(1, 11)) and out[day(11)].r4 is not None
    assert all(out[day(n)].r7 is None for n in range(1, 13))


def test_zero_denominators_and_masks(spark):
    data = [(1, day(d), 3 if d >= 5 else 0, 0, None) for d in range(1, 8)]
    data += [(2, day(d), 0, 0, 100) for d in range(1, 8)]
    panel = spark.createDataFrame(data, PANEL)
    plain = indicators(panel, dose_levels=(), mask=False, missing=None).collect()
    first = {r.day: r for r in plain if r.geo == 1}
    assert first[day(5)].r4 == 0.0 and first[day(1)].r7 == 0.0
    assert first[day(5)].incidence is None and first[day(5)].lethality_rate == 0.0
    filled = indicators(panel, dose_levels=(), missing=0).filter("geo = 1").collect()
    assert all(r.incidence == 0.0 and r.infection_rate == 0.0 for r in filled)
    never = indicators(panel, dose_levels=()).filter("geo = 2").collect()
    assert all(r.r4 == 0.0 and r.r7 == 0.0 for r in never)


def test_doses_and_unknown_place(spark):
    doses = spark.createDataFrame(
        [
            ("01001", day(1), 1, 10), ("01001", day(1), 2, 4), ("01001", day(1), 1, 1), ("11000", day(1), 3, 9),
            ("u", day(2), 1, 5), ("u", day(2), 2, 7), ("01001", day(2), 9, 1), ("01001", day(2), 1, None),
        ],
        "place string, day date, status int, doses int",
    )
    known = doses_by_status(known_places(doses))
    assert rows(known) == [(1001, day(1), 11, 4, 0), (1001, day(2), 0, 0, 0), (11000, day(1), 0, 0, 9)]
    assert rows(unexpected_levels(doses)) == [(9, 1)]
    country = spark.createDataFrame([(0, day(1), 1, 1, 1), (0, day(2), 2, 2, 2)], "geo int, day date, doses_1 long, doses_2 long, doses_3 long")
    unknown = doses_by_status(unknown_places(doses), ("day",))
    out = add_unknown_place_doses(country, unknown)
    assert out.columns == country.columns
    assert rows(out) == [(0, day(1), 1, 1, 1), (0, day(2), 7, 9, 2)]


def test_allocation_keeps_the_total(spark):
    totals = spark.createDataFrame([(11000, day(1), 10)], "parent int, day date, doses_1 long")
    members = spark.createDataFrame([(11000, g, 100) for g in (11001, 11002, 11003)], "parent int, geo int, population long")
    out = allocate_proportional(totals, members, ["doses_1"])
    assert rows(out, "geo", "doses_1") == [(11001, 3), (11002, 3), (11003, 4)]
    assert rows(allocation_residuals(totals, members, ["doses_1"]), "doses_1", "doses_1_shares", "doses_1_residual") == [(10, 9, 1)]


def test_allocation_of_many_parents(spark):
    rng = random.Random(1)
    members = [(p, p * 100 + k, rng.choice([None, 0, 7, rng.randint(1, 900)])) for p in range(5) for k in range(rng.randint(1, 40))]
    totals = [(p, day(d), rng.randint(0, 5000), rng.choice([None, 3])) for p in range(6) for d in range(1, 6)]
    t = spark.createDataFrame(totals, "parent int, day date, a long, b long")
    m = spark.createDataFrame(members, "parent int, geo int, population long")
    out = allocate_proportional(t, m, ["a", "b"])
    sums = out.groupBy("parent", "day").agg(F.sum("a"), F.sum("b"))
    assert rows(sums) == sorted(
        [(p, d, a, b or 0) for p, d, a, b in totals if p < 5], key=lambda r: tuple((v is None, str(v)) for v in r)
    )
    assert out.count() == 5 * len(members)
    weights = {(p, g): w or 0 for p, g, w in members}
    last = {p: max(g for q, g in weights if q == p) for p in range(5)}
    amounts = {(p, d): a for p, d, a, _ in totals}
    for r in out.collect():
        whole = sum(w for (p, _), w in weights.items() if p == r.parent)
        if r.geo != last[r.parent]:
            share = (2 * amounts[r.parent, r.day] * weights[r.parent, r.geo] + whole) // (2 * whole) if whole else 0
            assert r.a == share


def test_subtotal_is_excluded_from_rollups(spark):
    panel = spark.createDataFrame(
        [(11001, day(1), 1, 0, 10), (11002, day(1), 2, 1, 20), (12001, day(1), 4, 0, 30)], PANEL
    ).withColumns({"state": state_of(), "name": F.lit("x")})
    whole = append_subtotal(panel, F.col("geo").between(11000, 11999), 11000, {"name": "City"}, ["cases", "deaths", "population"])
    assert rows(whole.filter("is_subtotal"), "geo", "cases", "deaths", "population", "state", "name") == [(11000, 3, 1, 30, 11, "City")]
    names = spark.createDataFrame([(11, "A"), (11, "A"), (12, "B")], "state int, state_name string")
    assert rows(rollup_state(whole, ["cases", "population"], names)) == [(11, day(1), 3, 30, "A"), (12, day(1), 4, 30, "B")]
    assert rows(rollup_country(whole, ["cases", "population"])) == [(0, day(1), 7, 60)]
    both = rollup_levels(whole, ["cases"])
    assert rows(both) == [("country", None, day(1), 7), ("state", 11, day(1), 3), ("state", 12, day(1), 4)]


def test_population_by_level(spark):
    regions = spark.createDataFrame([(1, 10), (1, 5), (2, 7)], "state int, population long")
    assert rows(population_by_level(regions)) == [(0, 22), (1, 15), (2, 7)]


def test_icu_is_a_ratio_of_sums(spark):
    icu = spark.createDataFrame(
        [(1001, 1, day(1), 1, 1, 0, 4), (1002, 1, day(1), 3, 0, 2, 6), (2001, 2, day(1), 0, 0, 0, 0)],
        "geo int, state int, day date, icu_cases int, icu_ventilated int, beds_free int, beds_occupied int",
    )
    assert rows(icu_occupancy(icu, ("state", "day"))) == [(1, day(1), 0.3333, 4, 1), (2, day(1), None, 0, 0)]
    panel = spark.createDataFrame([(1001, 1, day(1)), (1001, 1, day(2))], "geo int, state int, day date")
    out = inherit_parent(panel, icu_occupancy(icu, ("state", "day")), "state", ["icu_share"])
    assert rows(out, "geo", "day", "icu_share_parent") == [(1001, day(1), 0.3333), (1001, day(2), None)]


def test_hospital_sums_ages_and_knows_the_country(spark):
    hospital = spark.createDataFrame([(1, day(1), 2), (1, day(1), 3), (0, day(1), 7)], "level_id int, day date, hospital_cases int")
    population = spark.createDataFrame([(1, 1000), (0, 3000)], "level_id int, population long")
    assert rows(hospital_incidence(hospital, population)) == [(0, day(1), 233.3333), (1, day(1), 500.0)]


def test_hospital_age_groups_can_be_chosen(spark):
    schema = "level_id int, day date, age_group string, hospital_cases int"
    hospital = spark.createDataFrame([(1, day(1), "00+", 5), (1, day(1), "00-04", 2), (1, day(1), "05-14", 3)], schema)
    population = spark.createDataFrame([(1, 1000)], "level_id int, population long")
    assert rows(hospital_incidence(hospital, population, age_groups=["00+"])) == [(1, day(1), 500.0)]
    assert rows(hospital_incidence(hospital, population)) == [(1, day(1), 1000.0)]


def test_enrich_keeps_rows_and_can_check(spark):
    panel = spark.createDataFrame([(1, day(1)), (1, day(2))], "geo int, day date")
    feed = spark.createDataFrame([(1, day(1), -2.5)], "geo int, day date, m double")
    assert rows(enrich(panel, feed, ("geo", "day"), ["m"], check=True)) == [(1, day(1), -2.5), (1, day(2), None)]
    assert rows(enrich(panel, feed, ("geo", "day"), ["m"], fill=0.0))[1][2] == 0.0
    with pytest.raises(DataCheckError):
        enrich(panel, feed.union(feed), ("geo", "day"), ["m"], check=True)


def crosswalk_inputs(spark):
    regions = spark.createDataFrame(
        [(1001, "DEF01"), (1002, "DEF01"), (3001, "DE901"), (11001, None), (11002, None), (5001, None)],
        "geo int, nuts string",
    )
    codes = spark.createDataFrame(
        [("DE300", "10115"), ("DE300", "10117"), ("DEA01", "50001"), ("DEA01", "50002"), ("DEA01", "50003"), ("DEZ99", "99999")],
        "nuts3 string, code string",
    )
    keys = spark.createDataFrame(
        [(10115, 11000000), (10117, 11000000), (50001, 5001001), (50002, 5001002), (50003, 5001003)], "plz int, ags long"
    )
    needed = spark.createDataFrame([("DEF01",), ("DE300",), ("DEA01",), ("DEZ99",)], "nuts string")
    return regions, codes, keys, needed


def test_crosswalk(spark):
    regions, codes, keys, needed = crosswalk_inputs(spark)
    out = build_crosswalk(regions, postal_codes(codes), postal_regions(keys), needed, (11000, 12000), strict=True)
    assert rows(out, "nuts", "geo") == [
        ("DE300", 11000), ("DE300", 11001), ("DE300", 11002), ("DE901", 3001), ("DEA01", 5001),
        ("DEF01", 1001), ("DEF01", 1002),
    ]
    report = crosswalk_report(out, needed)
    assert rows(report["codes_without_region"]) == [("DEZ99",)]
    assert rows(report["codes_with_several_regions"]) == [("DE300", 3), ("DEF01", 2)]
    assert rows(report["regions_with_several_codes"]) == []


def test_strict_city_code_must_be_single(spark):
    regions, codes, keys, needed = crosswalk_inputs(spark)
    more = codes.union(spark.createDataFrame([("DE301", "10117")], codes.schema))
    with pytest.raises(Exception, match="SCALAR_SUBQUERY_TOO_MANY_ROWS"):
        build_crosswalk(regions, postal_codes(more), postal_regions(keys), needed, (11000, 12000), strict=True).collect()
    loose = build_crosswalk(regions, postal_codes(more), postal_regions(keys), needed, (11000, 12000))
    assert ("DE300", 11001) in rows(loose, "nuts", "geo")


def test_profiles(spark):
    df = spark.createDataFrame([(1, day(1)), (1, day(1)), (2, day(4)), (None, day(3))], "geo int, day date")
    assert rows(profile_time_series(df, "geo")) == [(day(1), day(4), 4, 3, 2, 4)]
    assert rows(missing_days(df)) == [(day(2),)]
    assert rows(profile_nulls(df)) == [("geo", 1)]
    assert rows(distinct_counts(df, "geo", "day")) == [(2, 3)]
    assert rows(duplicate_keys(df, "geo", "day")) == [(1, day(1), 2)]


def test_lookups_must_be_total(spark):
    left = spark.createDataFrame([("a",), ("b",)], "nuts string")
    right = spark.createDataFrame([("a", 1)], "nuts string, geo int")
    assert rows(unmatched_keys(left, right, "nuts")) == [("b",)]
    with pytest.raises(DataCheckError, match="b"):
        total_lookup(left, right, "nuts", "no region")
    assert rows(total_lookup(left.filter("nuts = 'a'"), right, "nuts", "no region")) == [("a", 1)]


def test_vintages(spark):
    df = spark.createDataFrame([(1, day(1)), (2, day(5))], "geo int, day date")
    assert rows(stamp_vintage(df, "day")) == [(1, day(1), day(5)), (2, day(5), day(5))]
    stamped = stamp_vintages(df, {"a": (df, "day"), "b": (df.filter("geo = 1"), "day")})
    assert rows(stamped, "geo", "a", "b") == [(1, day(5), day(1)), (2, day(5), day(1))]
    child = spark.createDataFrame([(7,)], "geo int")
    assert rows(inherit_vintages(child, stamped, ["a", "b"])) == [(7, date(2020, 1, 5), date(2020, 1, 1))]
