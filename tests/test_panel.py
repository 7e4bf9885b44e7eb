import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from helpers import day, rows
from regiopanel.operators.spine import (
    date_spine,
    dense_panel,
    outside_spine,
    spine_grid,
    stack_facts,
    sum_by,
    zero_fill_by_union,
)
from regiopanel.operators.windows import (
    FRAMES,
    cumulate,
    dense_window_sums,
    first_event_day,
    first_event_table,
    window_sums,
)

SCHEMA = "geo int, day date, cases long, deaths long"


def random_facts(seed, n_geo=4, n_days=40, n=150, hot=None):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        geo = hot if hot is not None and rng.random() < 0.4 else rng.randrange(n_geo)
        out.append((geo, day(rng.randint(1, n_days)), rng.randint(-1, 9), rng.randint(0, 2)))
    return out


def brute_panel(facts, lo, hi):
    sums = {}
    for geo, d, c, t in facts:
        a, b = sums.get((geo, d), (0, 0))
        sums[geo, d] = (a + c, b + t)
    out = {}
    for geo in {f[0] for f in facts}:
        d = lo
        while d <= hi:
            out[geo, d] = sums.get((geo, d), (0, 0))
            d += timedelta(days=1)
    return out


def as_rows(panel):
    return sorted(((g, d, *v) for (g, d), v in panel.items()), key=lambda r: tuple((v is None, str(v)) for v in r))


def test_date_spine_includes_both_ends(spark):
    spine = date_spine(spark, "2020-02-27", "2020-03-01")
    assert [str(r[0]) for r in spine.collect()] == ["2020-02-27", "2020-02-28", "2020-02-29", "2020-03-01"]


@pytest.mark.parametrize("seed", range(4))
def test_dense_panel_equals_brute_force(spark, seed):
    facts = random_facts(seed, hot=2)
    df = spark.createDataFrame(facts, SCHEMA)
    lo, hi = min(f[1] for f in facts), max(f[1] for f in facts)
    expected = brute_panel(facts, lo, hi)
    assert rows(dense_panel(df, ["cases", "deaths"])) == as_rows(expected)
    wide = brute_panel(facts, day(-4), day(50))
    assert rows(dense_panel(df, ["cases", "deaths"], start=day(-4), end=day(50))) == as_rows(wide)
    narrow = brute_panel([f if day(10) <= f[1] <= day(20) else (f[0], day(10), 0, 0) for f in facts], day(10), day(20))
    assert rows(dense_panel(df, ["cases", "deaths"], start=day(10), end=day(20))) == as_rows(narrow)
    half = brute_panel([f if f[1] >= day(30) else (f[0], day(30), 0, 0) for f in facts], day(30), hi)
    assert rows(dense_panel(df, ["cases", "deaths"], start=day(30))) == as_rows(half)


def test_dense_panel_drops_null_keys(spark):
    df = spark.createDataFrame([(1, day(1), 1, 0), (None, day(2), 5, 0), (1, None, 5, 0)], SCHEMA)
    assert rows(dense_panel(df, ["cases"])) == [(1, day(1), 1)]


def test_anchor_limits_regions_and_days(spark):
    cases = spark.createDataFrame([(1, day(2), 1, 0), (2, day(4), 2, 0)], SCHEMA)
    doses = spark.createDataFrame([(1, day(1), 9), (1, day(3), 7), (3, day(3), 8)], "geo int, day date, doses long")
    panel = dense_panel(stack_facts(cases, doses), ["cases", "doses"], anchor="is_primary")
    assert rows(panel) == [
        (1, day(2), 1, 0), (1, day(3), 0, 7), (1, day(4), 0, 0),
        (2, day(2), 0, 0), (2, day(3), 0, 0), (2, day(4), 2, 0),
    ]


def test_fact_before_the_spine_is_reported(spark):
    df = spark.createDataFrame([(1, day(1), 3, 0), (1, day(5), 1, 0), (1, day(8), 1, 0)], SCHEMA)
    assert rows(outside_spine(df, day(4), day(8))) == [(1, day(1), 1)]
    panel = dense_panel(df, ["cases"], start=day(4), end=day(8))
    assert [r[2] for r in rows(panel)] == [0, 1, 0, 0, 1]
    kept = zero_fill_by_union(df, ["cases"], day(4), day(8))
    assert [r[2] for r in rows(kept)] == [3, 0, 1, 0, 0, 1]


def test_panel_has_keys_times_days_rows(spark):
    df = spark.createDataFrame(random_facts(9), SCHEMA)
    grid = spine_grid(df.select("geo").distinct(), day(1), day(40))
    panel = dense_panel(df, ["cases"], start=day(1), end=day(40))
    assert panel.count() == grid.count() == 4 * 40
    assert panel.join(grid, ["geo", "day"], "left_anti").count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_frames_equal_brute_force(spark, seed):
    facts = random_facts(seed + 20)
    df = spark.createDataFrame(facts, SCHEMA)
    panel = dense_panel(df, ["cases"])
    lo, hi = min(f[1] for f in facts), max(f[1] for f in facts)
    dense = {k: v[0] for k, v in brute_panel(facts, lo, hi).items()}

    def frame(geo, d, a, b):
        return sum(dense.get((geo, d + timedelta(days=k)), 0) for k in range(a, b + 1))

    expected = sorted(
        (g, d, *[frame(g, d, a, b) for a, b in FRAMES.values()]) for g, d in dense
    )
    by_total = dense_window_sums(cumulate(panel, ["cases"]), "cases_cum")
    assert sorted(tuple(r) for r in by_total.select("geo", "day", *FRAMES).collect()) == expected
    by_range = window_sums(panel, "cases")
    assert sorted(tuple(r) for r in by_range.select("geo", "day", *FRAMES).collect()) == expected
    sparse = window_sums(sum_by(df, ["cases"]), "cases").select("geo", "day", *FRAMES).collect()
    found = {(r[0], r[1]): tuple(r)[2:] for r in sparse}
    assert all(found[k] == tuple(frame(*k, a, b) for a, b in FRAMES.values()) for k in found)


def test_frames_reaching_further_ahead(spark):
    df = spark.createDataFrame([(1, day(i), i) for i in range(1, 8)], "geo int, day date, cases long")
    frames = {"ahead": (1, 3), "far": (-1, 5)}
    out = dense_window_sums(cumulate(df, ["cases"]), "cases_cum", frames)
    got = {r.day: (r.ahead, r.far) for r in out.collect()}
    for i in range(1, 8):
        ahead = sum(k for k in range(i + 1, i + 4) if k <= 7)
        far = sum(k for k in range(i - 1, i + 6) if 1 <= k <= 7)
        assert got[day(i)] == (ahead, far)


def test_last_running_total_is_the_group_sum(spark):
    df = spark.createDataFrame(random_facts(5), SCHEMA)
    totals = cumulate(dense_panel(df, ["cases", "deaths"]), ["cases", "deaths"])
    last = totals.groupBy("geo").agg(F.max_by("cases_cum", "day"), F.max_by("deaths_cum", "day"))
    assert rows(last) == rows(df.groupBy("geo").agg(F.sum("cases"), F.sum("deaths")))


def test_first_event(spark):
    df = spark.createDataFrame([(1, day(1), 0), (1, day(2), 3), (1, day(3), 4), (2, day(1), 0)], "geo int, day date, cases long")
    assert rows(first_event_day(df, "cases"), "geo", "day", "first_day")[0] == (1, day(1), day(2))
    assert {r.geo: r.first_day for r in first_event_day(df, "cases").collect()} == {1: day(2), 2: None}
    assert rows(first_event_table(df, "cases")) == [(1, day(2))]


def test_bounds_in_the_wrong_order_give_no_day(spark):
    from regiopanel.operators.spine import date_spine, spine_grid

    assert date_spine(spark, "2020-01-05", "2020-01-02").count() == 0
    assert date_spine(spark, "2020-01-02", "2020-01-02").count() == 1
    keys = spark.createDataFrame([(1,)], "geo int")
    assert spine_grid(keys, "2020-01-05", "2020-01-02").count() == 0
