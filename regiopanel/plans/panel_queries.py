"""Spines, panels, windows and indicators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regiopanel.functions import int_div
from regiopanel.operators.allocate import allocate_proportional, allocation_residuals, append_subtotal
from regiopanel.operators.crosswalk import build_crosswalk, postal_codes, postal_regions
from regiopanel.operators.doses import add_unknown_place_doses, doses_by_status, known_places, unknown_places
from regiopanel.operators.indicators import indicators
from regiopanel.operators.rollup import attach_attributes, rollup_country, rollup_levels, rollup_state
from regiopanel.operators.spine import (
    date_spine,
    day_bounds,
    dense_panel,
    distinct_keys,
    outside_spine,
    panel_tasks,
    spine_grid,
    sum_by,
    zero_fill_by_union,
)
from regiopanel.operators.windows import FRAMES, cumulate, dense_window_sums, first_event_table, window_sums
from regiopanel.plans.levels import all_levels, country_table, level_feeds, region_level, state_table
from regiopanel.plans.reference_sql import (
    DAY_SERIES,
    PARTS,
    columns_of,
    indicator_columns,
    or_zero,
    rounded,
    with_parts,
)
from regiopanel.plans.registry import register
from regiopanel.plans.standins import CITY, OPTIONS, Standins

COUNTS = ["cases", "deaths"]
DOSES = ["doses_1", "doses_2", "doses_3"]


def peopled_panel(s: Standins) -> DataFrame:
    """Dense case panel with the regions' attributes."""
    panel = dense_panel(s.cases, COUNTS, days_of=s.case_days)
    return s.kept(attach_attributes(panel, s.regions.drop("nuts", "vintage")), "panel")


def case_indicators(s: Standins, **options) -> DataFrame:
    panel = attach_attributes(dense_panel(s.cases, COUNTS, days_of=s.case_days), s.inhabitants)
    return indicators(panel, dose_levels=(), **options)


# --- spines and panels -------------------------------------------------------------------


@register("SRC-06 DAT-04", with_parts("SELECT day FROM days", "days"))
def date_spine_days(s: Standins) -> DataFrame:
    return date_spine(s.spark, *day_bounds(s.case_days))


@register("SRC-07 AGG-07", with_parts("SELECT DISTINCT geo FROM fact", "fact"), "distinct_keys")
def distinct_regions(s: Standins) -> DataFrame:
    return distinct_keys(s.cases, "geo")


@register("JOIN-01 SRC-06 SRC-07", with_parts("SELECT geo, day FROM grid", "grid"))
def spine_by_key(s: Standins) -> DataFrame:
    return spine_grid(distinct_keys(s.cases, "geo"), *day_bounds(s.case_days))


@register("AGG-01", with_parts("SELECT geo, day, cases, deaths FROM counted", "counted"))
def sums_by_region_day(s: Standins) -> DataFrame:
    return sum_by(s.cases, COUNTS)


@register("DOM-01 JOIN-01 JOIN-04 PRJ-09 AGG-01", columns_of("panel", "geo, day, cases, deaths"), "dense_panel")
def dense_case_panel(s: Standins) -> DataFrame:
    return dense_panel(s.cases, COUNTS, days_of=s.case_days)


PANEL_YEAR = ("1996-01-01", "1996-12-31")


@register(
    "DOM-01 SRC-06",
    with_parts(
        f"""SELECT geo, day, coalesce(cases, 0) AS cases, coalesce(deaths, 0) AS deaths
        FROM (SELECT DISTINCT geo FROM fact)
        CROSS JOIN ({DAY_SERIES.format(lo="DATE '1996-01-01'", hi="DATE '1996-12-31'")})
        LEFT JOIN counted USING (geo, day)""",
        "counted",
    ),
)
def dense_panel_given_days(s: Standins) -> DataFrame:
    """Days given: facts before and after do not count, their regions stay."""
    return dense_panel(s.cases, COUNTS, start=PANEL_YEAR[0], end=PANEL_YEAR[1])


@register(
    "SET-03 SET-02 DOM-01",
    with_parts(
        f"""SELECT geo, day, CAST(sum(cases) AS BIGINT) AS cases, CAST(sum(deaths) AS BIGINT) AS deaths FROM (
        SELECT geo, day, cases, deaths FROM counted UNION ALL
        SELECT geo, day, 0, 0 FROM (SELECT DISTINCT geo FROM fact)
        CROSS JOIN ({DAY_SERIES.format(lo="DATE '1996-01-01'", hi="DATE '1996-12-31'")})) GROUP BY geo, day""",
        "counted",
    ),
    store="daily",
)
def zero_fill_union(s: Standins) -> DataFrame:
    """Facts outside the spine are kept here."""
    return zero_fill_by_union(s.kept(sum_by(s.cases, COUNTS), "daily"), COUNTS, *PANEL_YEAR)


@register(
    "DOM-22 FLT-08",
    with_parts(
        """SELECT geo, day, count(*) AS n_rows FROM fact
        WHERE day NOT BETWEEN DATE '1996-01-01' AND DATE '1996-12-31' GROUP BY geo, day""",
        "fact",
    ),
)
def facts_outside_spine(s: Standins) -> DataFrame:
    return outside_spine(s.cases, *PANEL_YEAR)


@register(
    "DOM-02 JOIN-03 PRJ-02",
    with_parts(
        "SELECT geo, day, cases, deaths, population, name, kind, state, state_name FROM peopled", "peopled"
    ),
    "attach_region_attributes",
)
def panel_with_attributes(s: Standins) -> DataFrame:
    return peopled_panel(s)


# --- windows -----------------------------------------------------------------------------


@register(
    "WIN-01 WIN-05 DOM-06 SRT-01",
    with_parts("SELECT geo, day, cases, deaths, cases_cum, deaths_cum FROM peopled_totals", "peopled_totals"),
)
def running_totals(s: Standins) -> DataFrame:
    return cumulate(dense_panel(s.cases, COUNTS, days_of=s.case_days), COUNTS)


FRAMED = """SELECT p.geo, p.day, {columns} FROM peopled_totals p
  JOIN peopled_frames f ON f.g_key = p.geo AND f.g_day = p.day"""


@register(
    "WIN-02 WIN-03 WIN-04 JOIN-13 FLT-11",
    with_parts(
        """SELECT g_key AS geo, g_day AS day, CAST(last_7 AS BIGINT) AS last_7, CAST(recent_4 AS BIGINT) AS recent_4,
        CAST(earlier_4 AS BIGINT) AS earlier_4, CAST(recent_7 AS BIGINT) AS recent_7,
        CAST(earlier_7 AS BIGINT) AS earlier_7 FROM peopled_frames""",
        "peopled_frames",
    ),
    "window_frames",
)
def trailing_sums(s: Standins) -> DataFrame:
    totals = cumulate(dense_panel(s.cases, ["cases"], days_of=s.case_days), ["cases"])
    return dense_window_sums(totals, "cases_cum").select("geo", "day", *FRAMES)


SPARSE_FRAMES = """SELECT a.geo, a.day, a.cases, {sums}
  FROM counted a JOIN counted b ON a.geo = b.geo AND b.day BETWEEN a.day - 9 AND a.day + 1
  GROUP BY a.geo, a.day, a.cases""".format(
    sums=", ".join(
        f"CAST(coalesce(sum(CASE WHEN b.day - a.day BETWEEN {lo} AND {hi} THEN b.cases END), 0) AS BIGINT) AS {n}"
        for n, lo, hi in [
            ("last_7", -6, 0),
            ("recent_4", -3, 0),
            ("earlier_4", -7, -4),
            ("recent_7", -5, 1),
            ("earlier_7", -9, -3),
        ]
    )
)


@register("WIN-02 WIN-03 WIN-04 JOIN-13 FLT-11", with_parts(SPARSE_FRAMES, "counted"))
def window_frames_sparse(s: Standins) -> DataFrame:
    """Range frames over a series with gaps."""
    return window_sums(sum_by(s.cases, ["cases"]), "cases")


@register(
    "DOM-07 WIN-02 MTH-01 MTH-04",
    with_parts(
        FRAMED.format(columns=f"cases, {rounded('last_7', 'population', 1, 100000)} AS incidence"),
        "peopled_totals",
        "peopled_frames",
    ),
)
def incidence_7d(s: Standins) -> DataFrame:
    return case_indicators(s).select("geo", "day", "cases", "incidence")


@register(
    "DOM-08 WIN-03 MTH-03 CND-02",
    with_parts(
        FRAMED.format(columns=f"{or_zero(rounded('recent_4', 'earlier_4', 2))} AS r4"),
        "peopled_totals",
        "peopled_frames",
    ),
)
def r_value_4d(s: Standins) -> DataFrame:
    return case_indicators(s, mask=False).select("geo", "day", "r4")


@register(
    "DOM-09 WIN-04 MTH-03",
    with_parts(
        FRAMED.format(columns=f"{or_zero(rounded('recent_7', 'earlier_7', 2))} AS r7"),
        "peopled_totals",
        "peopled_frames",
    ),
)
def r_value_7d(s: Standins) -> DataFrame:
    return case_indicators(s, mask=False).select("geo", "day", "r7")


@register(
    "DOM-10 WIN-06 PRJ-08 FLT-07",
    with_parts(f"SELECT geo, day, r4, r7 FROM (SELECT geo, day, {indicator_columns(())} FROM peopled_totals "
               "JOIN peopled_frames ON g_key = geo AND g_day = day)", "peopled_totals", "peopled_frames"),
)
def r_masked_onset(s: Standins) -> DataFrame:
    return case_indicators(s).select("geo", "day", "r4", "r7")


@register(
    "AGG-11 FLT-09 WIN-06",
    with_parts("SELECT geo, min(day) AS first_day FROM counted WHERE deaths > 0 GROUP BY geo", "counted"),
)
def first_event(s: Standins) -> DataFrame:
    return first_event_table(s.cases, "deaths")


@register(
    "DOM-11 MTH-01",
    with_parts(
        f"SELECT geo, day, {rounded('cases_cum', 'population', 4)} AS infection_rate FROM peopled_totals",
        "peopled_totals",
    ),
)
def infection_rate(s: Standins) -> DataFrame:
    return case_indicators(s).select("geo", "day", "infection_rate")


@register(
    "DOM-12 PRJ-07 CND-01",
    with_parts(
        f"SELECT geo, day, {or_zero(rounded('deaths_cum', 'cases_cum', 4))} AS lethality_rate FROM peopled_totals",
        "peopled_totals",
    ),
)
def lethality_rate(s: Standins) -> DataFrame:
    return case_indicators(s).select("geo", "day", "lethality_rate")


# --- doses -------------------------------------------------------------------------------


@register("DOM-03 AGG-03 PRJ-05 FLT-01 STR-02", columns_of("dosed", "geo, day, doses_1, doses_2, doses_3"))
def doses_pivot(s: Standins) -> DataFrame:
    return doses_by_status(known_places(s.doses))


@register(
    "DOM-13 PRJ-05 DOM-03 JOIN-04",
    with_parts(
        "SELECT geo, day, dose_quota_1, dose_quota_2, dose_quota_3 FROM (SELECT geo, day, "
        + ", ".join(f"{rounded(f'doses_{i}_cum', 'population', 4)} AS dose_quota_{i}" for i in (1, 2, 3))
        + " FROM region_totals WHERE NOT is_subtotal)",
        "region_totals",
    ),
    store="placed regions span",
)
def dose_quota(s: Standins) -> DataFrame:
    table = indicators(s.counts.filter("not is_subtotal"))
    return table.select("geo", "day", "dose_quota_1", "dose_quota_2", "dose_quota_3")


def _city_parts(s: Standins) -> tuple[DataFrame, DataFrame]:
    whole = s.placed.filter(F.col("geo") == CITY.key)
    return whole.withColumnRenamed("geo", "parent"), CITY.districts(s.regions)


@register(
    "DOM-04 JOIN-02 WIN-07 SRT-04 MTH-01",
    with_parts("SELECT 1000 AS parent, geo, day, doses_1, doses_2, doses_3 FROM allocated", "allocated"),
    "allocate_proportional",
    store="placed regions",
)
def city_doses_by_district(s: Standins) -> DataFrame:
    return allocate_proportional(*_city_parts(s), DOSES)


@register(
    "DOM-04 JOIN-02 WIN-07",
    with_parts(
        """SELECT parent, day, geo, orders FROM (
        SELECT t.parent, t.day, m.geo, CAST(share + CASE WHEN m.geo = max(m.geo) OVER w THEN t.n - sum(share) OVER w
          ELSE 0 END AS BIGINT) AS orders FROM (
          SELECT t.parent, t.day, m.geo, t.n, """
        + or_zero(rounded("t.n * m.population", "m.everyone", 0))
        + """ AS share FROM (SELECT geo // 1000 AS parent, day, count(*) AS n FROM fact GROUP BY 1, 2) t
          JOIN (SELECT state AS parent, geo, population, sum(population) OVER (PARTITION BY state) AS everyone
            FROM reg) m
          ON t.parent = m.parent) AS t JOIN (SELECT geo FROM reg) m ON m.geo = t.geo
        WINDOW w AS (PARTITION BY t.parent, t.day))""",
        "fact",
        "reg",
    ),
    store="totals regions",
)
def allocate_every_parent(s: Standins) -> DataFrame:
    """Totals of every state shared out over its regions."""
    totals = s.cases.groupBy(int_div("geo", 1000).cast("int").alias("parent"), "day").agg(
        F.sum("cases").alias("orders")
    )
    members = s.regions.select(F.col("state").alias("parent"), "geo", "population")
    return allocate_proportional(s.kept(totals, "totals"), members, ["orders"])


@register(
    "AGG-12 WIN-07 AGG-05",
    with_parts(
        "SELECT 1000 AS parent, day, "
        + ", ".join(
            f"""max(t{i}) AS doses_{i}, CAST(sum(s{i}) AS BIGINT) AS doses_{i}_shares,
            CAST(max(t{i}) - sum(s{i}) AS BIGINT) AS doses_{i}_residual"""
            for i in (1, 2, 3)
        )
        + " FROM shares GROUP BY day",
        "shares",
    ),
    "allocation_residuals",
)
def city_share_residuals(s: Standins) -> DataFrame:
    return allocation_residuals(*_city_parts(s), DOSES)


@register(
    "DOM-05 AGG-15 SET-01 SET-02 PRJ-06 FLT-03",
    with_parts(
        """SELECT geo, day, cases, deaths, population, name, kind, state, state_name, FALSE AS is_subtotal FROM peopled
        UNION ALL SELECT 1000, day, CAST(sum(cases) AS BIGINT), CAST(sum(deaths) AS BIGINT),
        CAST(sum(population) AS BIGINT), 'Whole city', 'city', max(state), max(state_name), TRUE
        FROM peopled WHERE CAST(geo AS VARCHAR) LIKE '1%' GROUP BY day""",
        "peopled",
    ),
    "append_subtotal",
    store="panel",
)
def city_row(s: Standins) -> DataFrame:
    is_member = F.col("geo").cast("string").startswith("1")
    return append_subtotal(
        peopled_panel(s), is_member, CITY.key, {"name": CITY.name, "kind": CITY.kind}, [*COUNTS, "population"]
    )


@register(
    "DOM-15 FLT-01 JOIN-05 PRJ-08",
    with_parts("SELECT geo, day, doses_1, doses_2, doses_3, population FROM by_country", "by_country"),
    store="line_days regions span",
)
def unknown_location(s: Standins) -> DataFrame:
    country = rollup_country(s.counts, [*DOSES, "population"])
    return add_unknown_place_doses(country, doses_by_status(unknown_places(s.doses), ("day",)))


# --- roll-ups ----------------------------------------------------------------------------

ROLLED = """CAST(sum(cases) AS BIGINT) AS cases, CAST(sum(deaths) AS BIGINT) AS deaths,
  CAST(sum(population) AS BIGINT) AS population"""


def _level_sql(source: str) -> str:
    key = "state" if source == "state" else "geo"
    label = "state_name, " if source == "state" else ""
    return with_parts(
        f"""SELECT {key}, day, {label}cases, deaths, population, cases_cum, deaths_cum, doses_1_cum, doses_2_cum,
        doses_3_cum, {indicator_columns()} FROM {source}_totals
        JOIN {source}_frames ON g_key = {key} AND g_day = day""",
        f"{source}_totals",
        f"{source}_frames",
    )


ROLLED_COLUMNS = [
    "day", "cases", "deaths", "population", "cases_cum", "deaths_cum", *[d + "_cum" for d in DOSES],
    "incidence", "r4", "r7", "infection_rate", "lethality_rate", "dose_quota_1", "dose_quota_2", "dose_quota_3",
]


@register("DOM-14 AGG-14 JOIN-09 MTH-02 AGG-08 FN-02", _level_sql("state"), "rollup_state", store="placed regions span")
def state_indicators(s: Standins) -> DataFrame:
    rolled = rollup_state(s.counts, [*COUNTS, *DOSES, "population"], s.regions)
    return indicators(rolled, geo="state").select("state", "state_name", *ROLLED_COLUMNS)


@register("DOM-14 AGG-02 AGG-16 FN-02", _level_sql("country"), "rollup_country", store="line_days regions span")
def country_indicators(s: Standins) -> DataFrame:
    rolled = rollup_country(s.counts, [*COUNTS, *DOSES, "population"])
    rolled = add_unknown_place_doses(rolled, doses_by_status(unknown_places(s.doses), ("day",)))
    return indicators(rolled).select("geo", *ROLLED_COLUMNS)


@register(
    "AGG-14 AGG-15",
    with_parts(
        f"""SELECT 'state' AS level, state, day, {ROLLED} FROM peopled GROUP BY state, day UNION ALL
        SELECT 'country', NULL, day, {ROLLED} FROM peopled GROUP BY day""",
        "peopled",
    ),
)
def rollup_grouping_sets(s: Standins) -> DataFrame:
    return rollup_levels(peopled_panel(s), [*COUNTS, "population"])


# --- whole tables ------------------------------------------------------------------------

LEVEL_COLUMNS = ["cases", "deaths", "population", *DOSES, "cases_cum", "deaths_cum", *[d + "_cum" for d in DOSES]]
INDICATOR_COLUMNS = [
    "incidence", "r4", "r7", "infection_rate", "lethality_rate", "dose_quota_1", "dose_quota_2", "dose_quota_3",
]
MOBILITY_COLUMNS = ["mobility_change", "mobility_change_7day_average", "mobility_change_weekly"]
ICU_COLUMNS = ["icu_share", "icu_cases", "icu_ventilated"]


def region_sql(extra: str = "") -> str:
    parents = ", ".join(f"p.{c} AS {c}_parent" for c in ICU_COLUMNS)
    return with_parts(
        f"""SELECT t.geo, t.day, state, name, kind, is_subtotal, {", ".join("t." + c for c in LEVEL_COLUMNS)},
        {indicator_columns().replace("day <=", "t.day <=")}, {", ".join(MOBILITY_COLUMNS)},
        {", ".join("i." + c for c in ICU_COLUMNS)}, {parents}, hospital_incidence{extra}
        FROM region_totals t JOIN region_frames ON g_key = t.geo AND g_day = t.day
        LEFT JOIN (SELECT * FROM mob_region JOIN crosswalk USING (nuts)) m ON m.geo = t.geo AND m.day = t.day
        LEFT JOIN icu_region i ON i.geo = t.geo AND i.day = t.day
        LEFT JOIN icu_state p ON p.state = t.state AND p.day = t.day
        LEFT JOIN hosp h ON h.level_id = t.state AND h.day = t.day""".replace("t.day, state,", "t.day, t.state,"),
        "region_totals", "region_frames", "mob_region", "crosswalk", "icu_region", "icu_state", "hosp",
    )


def state_sql(extra: str = "", *parts: str) -> str:
    return with_parts(
        f"""SELECT t.state, t.day, t.state_name, {", ".join("t." + c for c in LEVEL_COLUMNS)},
        {indicator_columns().replace("day <=", "t.day <=")}, {", ".join(MOBILITY_COLUMNS)},
        {", ".join("i." + c for c in ICU_COLUMNS)}, hospital_incidence{extra}
        FROM state_totals t JOIN state_frames ON g_key = t.state AND g_day = t.day
        LEFT JOIN mob_state m ON m.state_name = t.state_name AND m.day = t.day
        LEFT JOIN icu_state i ON i.state = t.state AND i.day = t.day
        LEFT JOIN hosp h ON h.level_id = t.state AND h.day = t.day""",
        "state_totals", "state_frames", "mob_state", "icu_state", "hosp", *parts,
    )


def country_sql(extra: str = "", *parts: str) -> str:
    return with_parts(
        f"""SELECT t.day, {", ".join("t." + c for c in LEVEL_COLUMNS)},
        {indicator_columns().replace("day <=", "t.day <=")}, {", ".join(MOBILITY_COLUMNS)},
        {", ".join("i." + c for c in ICU_COLUMNS)}, hospital_incidence{extra}
        FROM country_totals t JOIN country_frames ON g_day = t.day
        LEFT JOIN mob_country m ON m.day = t.day LEFT JOIN icu_country i ON i.day = t.day
        LEFT JOIN hosp h ON h.level_id = 0 AND h.day = t.day""",
        "country_totals", "country_frames", "mob_country", "icu_country", "hosp", *parts,
    )


REGION_OUTPUT = [
    "geo", "day", "state", "name", "kind", "is_subtotal", *LEVEL_COLUMNS, *INDICATOR_COLUMNS, *MOBILITY_COLUMNS,
    *ICU_COLUMNS, *[c + "_parent" for c in ICU_COLUMNS], "hospital_incidence",
]
STAMPED_REGION_SQL = region_sql(
    """, (SELECT max(day) FROM fact) AS rki_stand, (SELECT max(day) FROM ld) AS rki_impf_stand,
    (SELECT max(day) FROM mob_region) AS rki_mobilitaet_stand, DATE '2001-12-31' AS einwohner_stand"""
)


def crosswalk_of(s: Standins) -> DataFrame:
    pairs = build_crosswalk(
        s.regions, postal_codes(s.postal_nuts), postal_regions(s.postal_keys), s.mobility_region, (CITY.lo, CITY.hi)
    )
    return s.kept(pairs, "crosswalk")


@register(
    "DOM-01 DOM-02 DOM-03 DOM-04 DOM-05 DOM-06 DOM-07 DOM-08 DOM-09 DOM-10 DOM-11 DOM-12 DOM-13 DOM-16 DOM-18 DOM-19 "
    "DOM-20 DOM-21 FN-01 FN-03 FN-05",
    region_sql(),
    store="line_days by_level regions counts span crosswalk",
)
def affectedness_region(s: Standins) -> DataFrame:
    return affectedness_region_table(s).select(*REGION_OUTPUT)


def affectedness_region_table(s: Standins) -> DataFrame:
    return region_level(s.counts, crosswalk_of(s), s.mobility_region, s.icu, s.hospital, s.regions, OPTIONS)


@register("DOM-14 DOM-18 DOM-19 DOM-21 FN-02 FN-05", state_sql(), store="line_days by_level regions span upper")
def affectedness_state(s: Standins) -> DataFrame:
    rolled = s.upper.filter("level = 'state'")
    table = state_table(rolled, s.mobility_state, s.icu, s.hospital, s.regions, OPTIONS)
    return table.select(
        "state", "day", "state_name", *LEVEL_COLUMNS, *INDICATOR_COLUMNS, *MOBILITY_COLUMNS, *ICU_COLUMNS,
        "hospital_incidence",
    )


@register("DOM-14 DOM-15 DOM-18 DOM-19 DOM-21 FN-02 FN-05", country_sql(), store="line_days by_level regions span upper")
def affectedness_country(s: Standins) -> DataFrame:
    rolled = s.upper.filter("level = 'country'").drop("state", "state_name", "level")
    table = country_table(rolled, s.mobility_country, s.icu, s.hospital, s.regions, OPTIONS)
    return table.select(
        "day", *LEVEL_COLUMNS, *INDICATOR_COLUMNS, *MOBILITY_COLUMNS, *ICU_COLUMNS, "hospital_incidence"
    )


ALL_LEVELS = ["level", *REGION_OUTPUT, "state_name"]


def _all_levels_sql() -> str:
    """The three tables under each other; columns that a level lacks are null."""
    shared = [*LEVEL_COLUMNS, *INDICATOR_COLUMNS, *MOBILITY_COLUMNS, *ICU_COLUMNS, "hospital_incidence"]
    parents = ", ".join(f"NULL AS {c}_parent" for c in ICU_COLUMNS)
    columns = ", ".join(shared)
    tables = [region_sql(), state_sql(), country_sql()]
    used = [name for name in PARTS if any(f"{name} AS MATERIALIZED (" in t for t in tables)]
    parts = ",\n".join(f"{name} AS MATERIALIZED ({PARTS[name]})" for name in used)
    region, state, country = (t[t.rindex("\nSELECT") :] for t in tables)
    own = ", ".join(f"{c}_parent" for c in ICU_COLUMNS)
    return f"""WITH {parts}
    SELECT 'region' AS level, geo, day, state, name, kind, is_subtotal, (SELECT max(state_name) FROM reg WHERE reg.state = r.state)
      AS state_name, {own}, {columns} FROM ({region}) r
    UNION ALL SELECT 'state', state, day, state, NULL, NULL, FALSE, state_name, {parents}, {columns} FROM ({state})
    UNION ALL SELECT 'country', 0, day, NULL, NULL, NULL, FALSE, NULL, {parents}, {columns} FROM ({country})"""


@register(
    "AGG-14 DOM-14 DOM-15 DOM-18 DOM-19 DOM-20 DOM-21 FN-02 FN-05 SET-01",
    _all_levels_sql(),
    store="line_days by_level regions counts span crosswalk upper",
)
def affectedness_all_levels(s: Standins) -> DataFrame:
    """All three tables from one plan: one roll-up for both upper levels, feeds of all levels joined at once."""
    feeds = level_feeds(
        crosswalk_of(s), s.mobility_region, s.mobility_state, s.mobility_country, s.icu, s.hospital, s.regions, OPTIONS
    )
    return all_levels(s.counts, s.upper, feeds, OPTIONS).select(*ALL_LEVELS)


@register(
    "WIN-02 DOM-08 DOM-09 DOM-10",
    with_parts(
        f"""SELECT geo, day, cases, {or_zero(rounded("recent_4", "earlier_4", 2))} AS r4 FROM (
        SELECT a.geo, a.day, a.cases,
        coalesce(sum(CASE WHEN b.day - a.day BETWEEN -3 AND 0 THEN b.cases END), 0) AS recent_4,
        coalesce(sum(CASE WHEN b.day - a.day BETWEEN -7 AND -4 THEN b.cases END), 0) AS earlier_4
        FROM e a JOIN e b ON a.geo = b.geo AND b.day BETWEEN a.day - 7 AND a.day GROUP BY a.geo, a.day, a.cases)"""
    ).replace(
        "SELECT geo, day, cases",
        """WITH e AS (SELECT g.geo, g.day, coalesce(n, 0) AS cases
        FROM (SELECT geo, day FROM (SELECT DISTINCT CAST(user_id % 10 AS INTEGER) AS geo FROM events)
          CROSS JOIN (SELECT CAST(unnest(generate_series((SELECT min(CAST(ts AS DATE)) FROM events),
          (SELECT max(CAST(ts AS DATE)) FROM events), INTERVAL 1 DAY)) AS DATE) AS day)) g
        LEFT JOIN (SELECT CAST(user_id % 10 AS INTEGER) AS geo, CAST(ts AS DATE) AS day, count(*) AS n
          FROM events GROUP BY 1, 2) c ON c.geo = g.geo AND c.day = g.day)
        SELECT geo, day, cases""",
        1,
    ),
)
def event_r_values(s: Standins) -> DataFrame:
    """Short dense series: events per group of users."""
    events = s.table("events").select(
        (F.col("user_id") % 10).cast("int").alias("geo"),
        F.col("ts").cast("date").alias("day"),
        F.lit(1).cast("bigint").alias("cases"),
        F.lit(0).cast("bigint").alias("deaths"),
    )
    panel = dense_panel(events, COUNTS).withColumn("population", F.lit(None).cast("bigint"))
    return indicators(panel, dose_levels=(), mask=False).select("geo", "day", "cases", "r4")


def supplier_panel(s: Standins) -> DataFrame:
    """Dense panel of shipped lines per supplier: its keys grow with the data."""
    lines = s.table("lineitem").select(
        F.col("l_suppkey").alias("geo"),
        F.col("l_shipdate").cast("date").alias("day"),
        F.lit(1).cast("bigint").alias("cases"),
        (F.col("l_returnflag") == "R").cast("bigint").alias("deaths"),
    )
    panel = dense_panel(lines, COUNTS, days_of=lines.select("day"), tasks=panel_tasks(lines))
    size = s.table("supplier").select(
        F.col("s_suppkey").alias("geo"), (F.col("s_nationkey") + 100).cast("bigint").alias("population")
    )
    return attach_attributes(panel, size)


def _over(name: str, frame: str) -> str:
    return f"coalesce(sum(cases) OVER (PARTITION BY geo ORDER BY day {frame}), 0) AS {name}"


@register(
    "DOM-01 DOM-06 DOM-07 DOM-08 DOM-09 DOM-10 DOM-11 DOM-12 WIN-01 WIN-02 WIN-03 WIN-04 FN-01",
    f"""WITH c AS (SELECT l_suppkey AS geo, CAST(l_shipdate AS DATE) AS day, count(*) AS cases,
      count(*) FILTER (l_returnflag = 'R') AS deaths FROM lineitem GROUP BY 1, 2),
    d AS ({DAY_SERIES.format(lo="(SELECT min(day) FROM c)", hi="(SELECT max(day) FROM c)")}),
    p AS (SELECT geo, day, coalesce(cases, 0) AS cases, coalesce(deaths, 0) AS deaths, s_nationkey + 100 AS population
      FROM (SELECT DISTINCT geo FROM c) CROSS JOIN d LEFT JOIN c USING (geo, day) LEFT JOIN supplier ON s_suppkey = geo),
    t AS (SELECT *, {_over("cases_cum", "ROWS UNBOUNDED PRECEDING")},
      coalesce(sum(deaths) OVER (PARTITION BY geo ORDER BY day ROWS UNBOUNDED PRECEDING), 0) AS deaths_cum,
      min(CASE WHEN cases > 0 THEN day END) OVER (PARTITION BY geo) AS first_day,
      {_over("last_7", "RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW")},
      {_over("recent_4", "RANGE BETWEEN INTERVAL 3 DAY PRECEDING AND CURRENT ROW")},
      {_over("earlier_4", "RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND INTERVAL 4 DAY PRECEDING")},
      {_over("recent_7", "RANGE BETWEEN INTERVAL 5 DAY PRECEDING AND INTERVAL 1 DAY FOLLOWING")},
      {_over("earlier_7", "RANGE BETWEEN INTERVAL 9 DAY PRECEDING AND INTERVAL 3 DAY PRECEDING")} FROM p)
    SELECT geo, day, cases, deaths, {indicator_columns(())} FROM t""",
)
def supplier_indicators(s: Standins) -> DataFrame:
    table = indicators(supplier_panel(s), dose_levels=())
    return table.select("geo", "day", *COUNTS, "incidence", "r4", "r7", "infection_rate", "lethality_rate")
