"""Whole runs: stages, exports, vintages and the account of what is read, held and left out."""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regiopanel.functions import day_text, int_div
from regiopanel.operators.corrections import corrected
from regiopanel.operators.indicators import dose_column, indicators
from regiopanel.operators.ledger import LEVELS, NOT_IN_COUNTRY, amounts, held, ledger
from regiopanel.operators.rejects import left_out
from regiopanel.operators.rollup import attach_attributes
from regiopanel.operators.spine import day_bounds, day_span, dense_panel, panel_days, present
from regiopanel.operators.vintage import inherit_vintages, stamp_vintages
from regiopanel.plans.levels import (
    EXTENDED_KEYS,
    VINTAGES,
    Options,
    extended_layout,
    panel_places,
    placed_doses,
    plain_layout,
    region_counts,
    upper_counts,
)
from regiopanel.plans.panel_queries import (
    COUNTS,
    DOSES,
    ICU_COLUMNS,
    INDICATOR_COLUMNS,
    LEVEL_COLUMNS,
    MOBILITY_COLUMNS,
    REGION_OUTPUT,
    STAMPED_REGION_SQL,
    affectedness_region_table,
    country_sql,
    region_sql,
    state_sql,
)
from regiopanel.plans.pipeline import PERCENT, Pipeline
from regiopanel.plans.reference_sql import indicator_columns, with_parts
from regiopanel.plans.registry import register
from regiopanel.plans.standins import OPTIONS, Standins
from regiopanel.session import fresh_path, stored
from regiopanel.sinks.exports import export_levels, read_ordered
from regiopanel.sources.feeds import FEEDS, Feed

STAMPS = f"""(SELECT max(day) FROM fact) AS rki_stand, (SELECT max(day) FROM ld) AS rki_impf_stand,
    (SELECT max(day) FROM mob_region) AS rki_mobilitaet_stand, DATE '2001-12-31' AS einwohner_stand"""


def _published(s: Standins, name: str, df: DataFrame) -> Feed:
    """Write a stand-in feed as the delimited file the published one is."""
    feed = FEEDS[name]
    out = []
    for source, (column, kind) in feed.columns.items():
        value = F.col(column) if column in df.columns else F.lit(None)
        text = day_text(value) if kind == "german_day" else value.cast("string")
        out.append(text.alias(source.upper()))
    path = fresh_path(s.spark, name)
    df.select(*out).write.option("header", True).option("sep", feed.sep).option("quote", feed.quote).csv(path)
    return replace(feed, path=path, member=None)


def _staged(s: Standins, *stages: str) -> dict[str, DataFrame]:
    """All feeds as files, read, checked, stored and built by the stages of a run."""
    cases = s.cases.withColumns({"reference_day": F.col("day"), "vintage": F.lit("2001-12-31").cast("date")})
    feeds = {"cases": cases, **{n: getattr(s, n) for n in FEEDS if n != "cases"}}
    files = {name: _published(s, name, df) for name, df in feeds.items()}
    options = replace(OPTIONS, strict=False)
    return Pipeline(s.spark, files, fresh_path(s.spark, "run"), options).run(stages)


@register(
    "SNK-06 FN-04 FN-05 FN-06 SRC-08 SNK-03 SNK-05 DOM-25 DOM-23",
    STAMPED_REGION_SQL,
    store="line_days by_level regions",
)
def staged_run_region(s: Standins) -> DataFrame:
    return _staged(s, "read", "region")["region"].select(*REGION_OUTPUT, *VINTAGES)


@register(
    "SNK-06 FN-05 FN-06 DOM-14 DOM-24 SNK-05",
    state_sql(", " + STAMPS, "fact", "mob_region"),
    store="line_days by_level regions",
)
def staged_run_state(s: Standins) -> DataFrame:
    table = _staged(s, "read", "region", "state")["state"]
    shared = [*LEVEL_COLUMNS, *INDICATOR_COLUMNS, *MOBILITY_COLUMNS, *ICU_COLUMNS, "hospital_incidence"]
    return table.select("state", "day", "state_name", *shared, *VINTAGES)


@register(
    "SNK-06 FN-05 FN-06 DOM-15 DOM-24 SNK-05",
    country_sql(", " + STAMPS, "fact", "mob_region"),
    store="line_days by_level regions",
)
def staged_run_country(s: Standins) -> DataFrame:
    table = _staged(s, "read", "region", "country")["country"]
    shared = [*LEVEL_COLUMNS, *INDICATOR_COLUMNS, *MOBILITY_COLUMNS, *ICU_COLUMNS, "hospital_incidence"]
    return table.select("day", *shared, *VINTAGES)


@register(
    "DOM-24 SNK-05",
    with_parts(
        """SELECT geo, day, cases, (SELECT max(day) FROM fact) AS rki_stand,
        (SELECT max(CAST(l_shipdate AS DATE)) FROM lineitem) AS rki_impf_stand FROM counted""",
        "counted",
    ),
)
def vintage_inherited(s: Standins) -> DataFrame:
    """Vintages of the sources stored as one row, which every level takes its stamps from."""
    lines = s.table("lineitem").select(F.col("l_shipdate").cast("date").alias("day"))
    one = s.spark.range(1).select(F.lit("vintages").alias("of"))
    vintages = stored(stamp_vintages(one, {"rki_stand": (s.case_days, "day"), "rki_impf_stand": (lines, "day")}), "vintages")
    daily = s.cases.groupBy("geo", "day").agg(F.sum("cases").alias("cases"))
    return inherit_vintages(daily, vintages, ["rki_stand", "rki_impf_stand"])


# --- corrections between snapshots -------------------------------------------------------

# The older snapshot lacks some reports of one state, holds some of another twice, and ends earlier.
OLDER_END, NEWER_END = "2001-06-30", "2001-08-01"

SNAPSHOTS = f"""older AS (SELECT f.* FROM fact f, (SELECT unnest([1, 2]) AS k)
  WHERE (k = 1 AND NOT (geo // 1000 = 3 AND day BETWEEN DATE '1998-06-01' AND DATE '1998-06-20')
    OR k = 2 AND geo // 1000 = 4 AND day BETWEEN DATE '1997-03-01' AND DATE '1997-03-02') AND day <= DATE '{OLDER_END}'),
olds AS (SELECT geo, day, count(*) AS n, sum(deaths) AS deaths FROM older GROUP BY geo, day),
touched AS (SELECT geo, min(day) - 1 AS first_day FROM (
  SELECT geo, day FROM counted LEFT JOIN olds o USING (geo, day) WHERE o.n IS DISTINCT FROM cases OR o.deaths IS DISTINCT FROM counted.deaths
  UNION ALL SELECT geo, DATE '{OLDER_END}' + 1 FROM counted) GROUP BY geo)"""


def _snapshot_sql() -> str:
    sql = with_parts(
        f"""SELECT geo, day, cases, deaths, population, cases_cum, deaths_cum, {indicator_columns(())},
        day >= (SELECT first_day FROM touched WHERE touched.geo = peopled_totals.geo) AS is_recomputed
        FROM peopled_totals JOIN peopled_frames ON g_key = geo AND g_day = day""",
        "peopled_totals",
        "peopled_frames",
    )
    cut = sql.rindex("\nSELECT")
    return f"{sql[:cut]},\n{SNAPSHOTS}{sql[cut:]}"


@register("DOM-01 DOM-06 DOM-07 DOM-08 DOM-09 DOM-10 WIN-02 WIN-03 WIN-04 JOIN-12 SET-05", _snapshot_sql(), store="regions")
def snapshot_rerun(s: Standins) -> DataFrame:
    """The table of a corrected snapshot, made of the one before and the difference between both."""
    state, on = int_div("geo", 1000), F.col("day")
    newer = stored(s.cases, "newer")
    late = (state == 3) & on.between("1998-06-01", "1998-06-20")
    twice = newer.filter((state == 4) & on.between("1997-03-01", "1997-03-02"))
    older = stored(newer.filter(~late).unionByName(twice).filter(on <= F.lit(OLDER_END).cast("date")), "older")
    start = day_bounds(newer)[0]
    panel = attach_attributes(dense_panel(older, COUNTS, start=start, end=OLDER_END), s.inhabitants)
    table = stored(indicators(panel, dose_levels=()), "table")
    found = corrected(table, older, newer, s.inhabitants, COUNTS, start, NEWER_END)
    names = ["incidence", "r4", "r7", "infection_rate", "lethality_rate"]
    return found.select("geo", "day", *COUNTS, "population", "cases_cum", "deaths_cum", *names, "is_recomputed")


# --- exports -----------------------------------------------------------------------------


def _text(column: str, kind: str) -> str:
    """SQL of a column as it is exported."""
    if kind == "percent":
        return f"coalesce(printf('%.2f', {column} * 100) || '%', '')"
    if kind == "day":
        return f"strftime({column}, '%d.%m.%Y')"
    if kind.startswith("key"):
        return f"lpad(CAST({column} AS VARCHAR), {kind[3:]}, '0')"
    if kind == "comma":
        return f"coalesce(replace(CAST({column} AS VARCHAR), '.', ','), '')"
    return f"coalesce(CAST({column} AS VARCHAR), '')"


RATIOS = {*INDICATOR_COLUMNS, *MOBILITY_COLUMNS, "icu_share", "icu_share_parent", "hospital_incidence"}
PLAIN_ORDER = [
    "day", "geo", "cases", "deaths", "population", "name", "kind", "cases_cum", "deaths_cum", *INDICATOR_COLUMNS,
    *MOBILITY_COLUMNS, *ICU_COLUMNS, *[c + "_parent" for c in ICU_COLUMNS], "hospital_incidence",
]
EXTENDED_ORDER = [
    "day", "geo", "name", "kind", "population", "cases", "deaths", *DOSES, "cases_cum", "deaths_cum",
    *[d + "_cum" for d in DOSES], *INDICATOR_COLUMNS, *MOBILITY_COLUMNS, *ICU_COLUMNS,
    *[c + "_parent" for c in ICU_COLUMNS], "hospital_incidence", *VINTAGES,
]
# Header lines of the exported region table.
PLAIN_HEADER = (
    "meldedatum;kgs;anzahlfall;anzahltodesfall;einwohner;kgs_name;kgs_art;anzahlfall_kum;anzahltodesfall_kum;inzidenz;"
    "r_wert_4;r_wert_7;infektionsrate;letalitaetsrate;quote_impfung_1;quote_impfung_2;quote_impfung_3;mobility_change;"
    "mobility_change_7day_average;mobility_change_weekly;intensivbetten;faelle_covid_aktuell;"
    "faelle_covid_aktuell_invasiv_beatmet;intensivbetten_bdl;faelle_covid_aktuell_bdl;"
    "faelle_covid_akt_invasiv_beatmet_bdl;hospitalisierung_inzidenz"
)
EXTENDED_HEADER = (
    "melde_dat;kgs5;kgs_name;kgs_art;einwohner;anz_fall_neu;anz_tote_neu;anz_impfung_1;anz_impfung_2;anz_impfung_3;"
    "anz_fall_kum;anz_tote_kum;anz_impfung_1_kum;anz_impfung_2_kum;anz_impfung_3_kum;inzidenz;r_wert_4;r_wert_7;"
    "infektionsrate;letalitaetsrate;quote_impfung_1;quote_impfung_2;quote_impfung_3;mobility_change;"
    "mobility_change_7day_average;mobility_change_weekly;intensivbetten;faelle_covid_aktuell;invasiv_beatmet;"
    "intensivbetten_bdl;faelle_covid_aktuell_bdl;invasiv_beatmet_bdl;hospitalisierung_inzidenz;rki_stand;"
    "rki_impf_stand;rki_mobilitaet_stand;einwohner_stand"
)


def _lines_sql(source: str, header: str, order: list[str], kinds: dict[str, str]) -> str:
    cut = source.rindex("\nSELECT")
    fields = ", ".join(_text(c, kinds.get(c, "")) for c in order)
    return f"""{source[:cut]}
    SELECT CAST(1 AS BIGINT) AS line_no, '{header}' AS line UNION ALL
    SELECT 1 + row_number() OVER (ORDER BY geo, day), concat_ws(';', {fields}) FROM ({source[cut:]})"""


def _exported(s: Standins, table: DataFrame, layout, **style) -> DataFrame:
    key = "kgs" if layout is plain_layout else EXTENDED_KEYS["region"][1]
    shaped = layout(table, "region")
    paths = export_levels({"region": (shaped, [key, shaped.columns[0]])}, fresh_path(s.spark, "export"), **style)
    return read_ordered(s.spark, paths["region"])


@register(
    "SNK-01 SRT-01 DOM-25 FMT-02",
    _lines_sql(region_sql(), PLAIN_HEADER, PLAIN_ORDER, {c: "comma" for c in RATIOS}),
    store="line_days by_level regions counts span crosswalk",
)
def export_region_plain(s: Standins) -> DataFrame:
    """The region table as exported, line by line in its order: decimal commas, integer keys, one header."""
    return _exported(s, affectedness_region_table(s), plain_layout)


@register(
    "SNK-02 SRT-01 DOM-25 FMT-01 DAT-06 STR-03",
    _lines_sql(
        region_sql(", " + STAMPS),
        EXTENDED_HEADER,
        EXTENDED_ORDER,
        {"infection_rate": "percent", "lethality_rate": "percent", "day": "day", "geo": "key5", **{v: "day" for v in VINTAGES}},
    ),
    store="line_days by_level regions counts span crosswalk",
)
def export_region_extended(s: Standins) -> DataFrame:
    """The same with dose counts, padded keys, German dates, percentages and vintages."""
    stamps = {
        "rki_stand": (s.case_days, "day"),
        "rki_impf_stand": (s.line_days, "day"),
        "rki_mobilitaet_stand": (s.mobility_region, "day"),
        "einwohner_stand": (s.regions, "vintage"),
    }
    table = stamp_vintages(affectedness_region_table(s), stamps)
    return _exported(s, table, extended_layout, decimal_mark=".", german_days=True, percent=PERCENT)


# --- account -----------------------------------------------------------------------------

# First days of the runs that are accounted for: before the first case, and after it.
ACCOUNTED = ("1994-10-01", "1996-03-01")

FAULTY = """fc AS (SELECT CASE WHEN o_orderkey % 19 <> 0 THEN geo END AS geo,
  CASE WHEN o_orderkey % 17 <> 0 THEN CAST(o_orderdate AS DATE) END AS day, 1 AS cases,
  CAST(o_orderstatus = 'F' AS INTEGER) AS deaths
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN places ON c_nationkey = n_nationkey),
fd AS (SELECT CASE WHEN o_orderkey % 17 <> 5 THEN CAST(o_orderdate AS DATE) + CAST((o_orderkey % 9 - 4) * 40 AS INTEGER) END AS day,
  CASE WHEN o_orderkey % 7 = 1 THEN NULL WHEN o_orderkey % 11 = 1 THEN ' ' WHEN o_orderkey % 13 = 1 THEN 'x1'
    WHEN o_orderkey % 5 = 1 THEN 'u' WHEN o_orderkey % 23 = 1 THEN '99999' WHEN n_regionkey = 0 THEN '1000'
    ELSE CAST(geo AS VARCHAR) END AS place, CAST(o_orderkey % 4 + 1 AS INTEGER) AS status, o_custkey AS doses
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN places ON c_nationkey = n_nationkey),
span AS (SELECT max(day) AS hi FROM fc WHERE geo IS NOT NULL),
homes AS (SELECT DISTINCT CAST(geo AS VARCHAR) AS place FROM fc WHERE geo IS NOT NULL AND day IS NOT NULL
  UNION SELECT '1000' FROM places WHERE n_regionkey = 0)"""


def _account_sql(start: str) -> str:
    inside = f"day BETWEEN DATE '{start}' AND (SELECT hi FROM span)"
    cases = f"geo IS NOT NULL AND {inside}"
    doses = f"status <= 3 AND {inside} AND (place IN (SELECT place FROM homes) OR (place = 'u' AND level = 'country'))"
    levels = " UNION ALL ".join(f"SELECT '{x}' AS level" for x in LEVELS)
    rows = " UNION ALL ".join(
        f"""SELECT DATE '{start}' AS first_day, level, '{feed}' AS feed, CAST(sum({amount}) AS BIGINT) AS n_read,
        CAST(coalesce(sum({amount}) FILTER ({condition}), 0) AS BIGINT) AS in_table FROM {source}, ({levels}) GROUP BY level"""
        for feed, amount, source, condition in (
            ("cases", "cases", "fc", cases), ("deaths", "deaths", "fc", cases), ("doses", "doses", "fd", doses),
        )
    )
    return f"SELECT *, n_read - in_table AS left_out, CAST(0 AS BIGINT) AS difference FROM ({rows})"


@register(
    "DOM-22 FLT-08",
    with_parts(" UNION ALL ".join(map(_account_sql, ACCOUNTED)), "places").replace("WITH ", "WITH ", 1).replace(
        ")\nSELECT", f"),\n{FAULTY}\nSELECT", 1
    ),
    store="regions",
)
def conservation(s: Standins) -> DataFrame:
    """Account of feeds with faults, for panels that begin before and after the first case: no difference is left."""
    key = F.col("o_orderkey")
    home = s.table("customer").join(s.nations, F.col("c_nationkey") == F.col("n_nationkey"))
    orders = s.table("orders").join(home, F.col("o_custkey") == F.col("c_custkey"))
    on = F.col("o_orderdate").cast("date")
    cases = orders.select(
        F.when(key % 19 != 0, F.col("geo")).alias("geo"),
        F.when(key % 17 != 0, on).alias("day"),
        F.lit(1).cast("bigint").alias("cases"),
        (F.col("o_orderstatus") == "F").cast("bigint").alias("deaths"),
    )
    place = (
        F.when(key % 7 == 1, None).when(key % 11 == 1, " ").when(key % 13 == 1, "x1").when(key % 5 == 1, "u")
        .when(key % 23 == 1, "99999").when(F.col("n_regionkey") == 0, "1000").otherwise(F.col("geo").cast("string"))
    )
    doses = orders.select(
        F.when(key % 17 != 5, F.date_add(on, ((key % 9 - 4) * 40).cast("int"))).alias("day"),
        place.alias("place"),
        (key % 4 + 1).cast("int").alias("status"),
        F.col("o_custkey").alias("doses"),
    )
    cases, doses = stored(cases, "faulty-cases"), stored(doses, "faulty-doses")
    read = amounts(cases, {"cases": F.col("cases"), "deaths": F.col("deaths")})
    read = stored(read.unionByName(amounts(doses, {"doses": F.col("doses")})), "read")
    rows = [_account(s, cases, doses, read, replace(OPTIONS, start=start)) for start in ACCOUNTED]
    return reduce(DataFrame.unionByName, rows)


def _account(s: Standins, cases: DataFrame, doses: DataFrame, read: DataFrame, options: Options) -> DataFrame:
    """The account of one run's tables at all levels."""
    placed = stored(placed_doses(doses, options), "placed")
    span = stored(day_span(present(cases, "geo")), "span")
    places = panel_places(cases, placed, s.regions, options)
    days = panel_days(options.start, options.end, span)
    left = stored(
        left_out(cases, doses, places, *days, levels=options.dose_levels, no_place=NOT_IN_COUNTRY), "left-out"
    )
    counts = stored(region_counts(cases, placed, s.regions, options, days_of=span), "counts")
    upper = stored(upper_counts(counts, doses, s.regions, options, days_of=span), "upper")
    columns = [dose_column(i) for i in options.dose_levels]
    tables = {"region": counts, **{level: upper.filter(F.col("level") == level) for level in LEVELS[1:]}}
    rows = [ledger(read, held(table, columns), left, level) for level, table in tables.items()]
    first = F.lit(options.start).cast("date").alias("first_day")
    return reduce(DataFrame.unionByName, rows).select(first, "*")
