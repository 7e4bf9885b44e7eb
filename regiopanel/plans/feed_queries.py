"""Crosswalk, enrichments, checks, vintages, sources and exports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regiopanel.functions import (
    day_from_parts,
    day_from_text,
    day_text,
    decimal_comma,
    int_div,
    month_window,
    padded_key,
    percent_text,
    plain_decimal,
    ratio_or_zero,
    round_ratio,
)
from regiopanel.operators.crosswalk import crosswalk_report, one_code_each, pairs_by_postal, postal_codes, postal_regions
from regiopanel.operators.doses import unexpected_levels, unknown_places
from regiopanel.operators.enrich import (
    ICU,
    MOBILITY,
    enrich,
    hospital_incidence,
    icu_occupancy,
    inherit_parent,
    mobility_by_region,
)
from regiopanel.operators.quality import (
    distinct_counts,
    duplicate_keys,
    missing_days,
    missing_days_by_key,
    profile_nulls,
    profile_time_series,
    total_lookup,
    unmatched_keys,
)
from regiopanel.operators.rejects import field_errors, left_out_doses, repeated_keys
from regiopanel.operators.rollup import population_by_level, rollup_country, rollup_state
from regiopanel.operators.spine import dense_panel
from regiopanel.operators.vintage import latest, stamp_vintage, stamp_vintages
from regiopanel.plans.levels import VINTAGES
from regiopanel.plans.panel_queries import (
    case_indicators,
    crosswalk_of,
    peopled_panel,
)
from regiopanel.plans.reference_sql import columns_of, indicator_columns, or_zero, rounded, with_parts
from regiopanel.plans.registry import register
from regiopanel.plans.standins import CITY, Standins
from regiopanel.session import fresh_path
from regiopanel.sinks.exports import formatted, write_delimited
from regiopanel.sinks.tables import replace_table, scan_table
from regiopanel.sources.archives import unzip_rows, zip_partitions
from regiopanel.sources.feeds import Feed
from regiopanel.sources.readers import apply_types, lowercase_columns, read_declared, read_feed

# --- crosswalk ---------------------------------------------------------------------------


@register(
    "DOM-16 JOIN-10 JOIN-11 JOIN-12 SET-01 SET-04 PRJ-10 AGG-08 FLT-02",
    with_parts("SELECT nuts, geo FROM crosswalk", "crosswalk"),
    "crosswalk_build",
)
def crosswalk_pairs(s: Standins) -> DataFrame:
    return crosswalk_of(s)


@register(
    "DOM-17 JOIN-12 SET-05 FLT-05",
    with_parts(
        "SELECT DISTINCT nuts FROM mob_region m WHERE NOT EXISTS (SELECT 1 FROM crosswalk c WHERE c.nuts = m.nuts)",
        "mob_region",
        "crosswalk",
    ),
    store="line_days",
)
def crosswalk_unmatched(s: Standins) -> DataFrame:
    return crosswalk_report(crosswalk_of(s), s.mobility_region)["codes_without_region"]


@register(
    "DOM-17 AGG-09 FLT-10",
    with_parts("SELECT nuts, count(*) AS n_rows FROM crosswalk GROUP BY nuts HAVING count(*) > 1", "crosswalk"),
)
def crosswalk_duplicates(s: Standins) -> DataFrame:
    return crosswalk_report(crosswalk_of(s), s.mobility_region)["codes_with_several_regions"]


@register(
    "JOIN-11 SET-04",
    with_parts("SELECT nuts, geo FROM postal_pairs", "postal_pairs"),
)
def postal_code_pairs(s: Standins) -> DataFrame:
    codes = postal_codes(s.postal_nuts)
    return codes.join(postal_regions(s.postal_keys), "postal").select("nuts", "geo").distinct()


@register(
    "PRJ-10 SRT-03",
    with_parts(
        """SELECT geo, name, CASE WHEN geo >= 1000 AND geo < 2000 THEN
        (SELECT max(nuts) FROM (SELECT DISTINCT nuts FROM postal_pairs WHERE geo >= 1000 AND geo < 2000))
        ELSE nuts END AS nuts FROM reg""",
        "reg",
        "postal_pairs",
    ),
)
def scalar_lookup(s: Standins) -> DataFrame:
    """One looked-up value assigned to some rows; the job fails if there were several."""
    pairs = postal_codes(s.postal_nuts).join(postal_regions(s.postal_keys), "postal")
    code = pairs.filter(CITY.contains()).select("nuts").distinct().scalar()
    return s.regions.select("geo", "name", F.when(CITY.contains(), code).otherwise(F.col("nuts")).alias("nuts"))


# --- enrichments -------------------------------------------------------------------------

MOBILITY_LIST = ", ".join(MOBILITY)


@register(
    "DOM-18 JOIN-04 JOIN-03 JOIN-06",
    with_parts(
        f"""SELECT p.geo, p.day, cases, {MOBILITY_LIST} FROM panel p LEFT JOIN
        (SELECT * FROM mob_region JOIN crosswalk USING (nuts)) m ON m.geo = p.geo AND m.day = p.day""",
        "panel",
        "mob_region",
        "crosswalk",
    ),
    store="line_days",
)
def mobility_join_key_date(s: Standins) -> DataFrame:
    panel = dense_panel(s.cases, ["cases"], days_of=s.case_days)
    return enrich(panel, mobility_by_region(s.mobility_region, crosswalk_of(s)), ("geo", "day"), MOBILITY)


@register(
    "DOM-18 JOIN-04 JOIN-09",
    with_parts(
        f"""SELECT p.state, p.state_name, p.day, CAST(sum(cases) AS BIGINT) AS cases,
        {", ".join(f"any_value({c}) AS {c}" for c in MOBILITY)}
        FROM peopled p LEFT JOIN mob_state m ON m.state_name = p.state_name AND m.day = p.day
        GROUP BY p.state, p.state_name, p.day""",
        "peopled",
        "mob_state",
    ),
    store="line_days",
)
def mobility_join_name_date(s: Standins) -> DataFrame:
    rolled = rollup_state(peopled_panel(s), ["cases"], s.regions)
    return enrich(rolled, s.mobility_state, ("state_name", "day"), MOBILITY)


@register(
    "DOM-18 JOIN-05",
    with_parts(
        f"""SELECT 0 AS geo, p.day, cases, {", ".join(f"coalesce({c}, 0) AS {c}" for c in MOBILITY)} FROM
        (SELECT day, CAST(sum(cases) AS BIGINT) AS cases FROM panel GROUP BY day) p
        LEFT JOIN mob_country m ON m.day = p.day""",
        "panel",
        "mob_country",
    ),
)
def mobility_join_date(s: Standins) -> DataFrame:
    """Unmatched days filled with 0."""
    rolled = rollup_country(dense_panel(s.cases, ["cases"], days_of=s.case_days), ["cases"])
    return enrich(rolled, s.mobility_country, ("day",), MOBILITY, fill=0.0)


@register("DOM-19 JOIN-04 MTH-01", columns_of("icu_region", "geo, day, icu_share, icu_cases, icu_ventilated"))
def icu_ratio_county(s: Standins) -> DataFrame:
    return icu_occupancy(s.icu, ("geo", "day"))


@register("DOM-19 AGG-13 JOIN-08", columns_of("icu_state", "state, day, icu_share, icu_cases, icu_ventilated"))
def icu_ratio_state(s: Standins) -> DataFrame:
    return icu_occupancy(s.icu, ("state", "day"))


@register("DOM-19 AGG-13 AGG-02", columns_of("icu_country", "day, icu_share, icu_cases, icu_ventilated"))
def icu_ratio_country(s: Standins) -> DataFrame:
    return icu_occupancy(s.icu, ("day",))


@register(
    "DOM-20 JOIN-15 JOIN-06 MTH-02",
    with_parts(
        """SELECT p.geo, p.day, CAST(p.geo // 1000 AS INTEGER) AS state, cases, icu_share AS icu_share_parent,
        icu_cases AS icu_cases_parent, icu_ventilated AS icu_ventilated_parent
        FROM panel p LEFT JOIN icu_state i ON i.state = p.geo // 1000 AND i.day = p.day""",
        "panel",
        "icu_state",
    ),
)
def icu_parent_on_child(s: Standins) -> DataFrame:
    panel = dense_panel(s.cases, ["cases"], days_of=s.case_days)
    panel = panel.withColumn("state", int_div("geo", 1000).cast("int"))
    return inherit_parent(panel, icu_occupancy(s.icu, ("state", "day")), "state", ICU)


@register("DOM-21 JOIN-14 AGG-01", columns_of("hosp", "level_id, day, hospital_incidence"), "hospital_incidence")
def hospital_by_level(s: Standins) -> DataFrame:
    return hospital_incidence(s.hospital, population_by_level(s.regions))


@register(
    "JOIN-07 JOIN-08 FLT-01",
    with_parts(
        """SELECT p.day, CAST(sum(cases) AS BIGINT) AS cases, any_value(hospital_incidence) AS hospital_incidence
        FROM panel p LEFT JOIN hosp h ON h.day = p.day AND h.level_id = 0 GROUP BY p.day""",
        "panel",
        "hosp",
    ),
)
def join_constant_predicate(s: Standins) -> DataFrame:
    """Constant condition on the right side, applied before the left join."""
    rolled = rollup_country(dense_panel(s.cases, ["cases"], days_of=s.case_days), ["cases"]).drop("geo")
    overall = hospital_incidence(s.hospital.filter("level_id = 0"), population_by_level(s.regions))
    return enrich(rolled, overall, ("day",), ["hospital_incidence"])


@register(
    "JOIN-14 AGG-05 AGG-16 SET-02 PRJ-06",
    with_parts(
        "SELECT CAST(level_id AS INTEGER) AS level_id, CAST(population AS BIGINT) AS population FROM level_people",
        "level_people",
    ),
)
def denominator_two_sources(s: Standins) -> DataFrame:
    return population_by_level(s.regions)


@register(
    "JOIN-16 JOIN-03",
    with_parts("SELECT geo, name, population, c.day, c.cases FROM counted c JOIN reg USING (geo)", "counted", "reg"),
    store="daily",
)
def total_lookup_check(s: Standins) -> DataFrame:
    """A lookup that must find every key."""
    daily = s.kept(s.cases.groupBy("geo", "day").agg(F.sum("cases").alias("cases")), "daily")
    regions = s.regions.select("geo", "name", "population")
    return total_lookup(daily, regions, "geo", "regions without attributes")


# --- filters -----------------------------------------------------------------------------


@register(
    "FLT-06 DAT-03",
    with_parts(
        """SELECT geo, day, CAST(day(day) AS INTEGER) AS dom, CAST(month(day) AS INTEGER) AS moy,
        CAST(year(day) AS INTEGER) AS yr, cases, deaths FROM counted
        WHERE day(day) >= 10 AND month(day) = 12 AND year(day) = 1996""",
        "counted",
    ),
)
def date_parts_filter(s: Standins) -> DataFrame:
    """Late December of one year, as a range that reaches the scan."""
    orders = s.table("orders").filter(month_window("o_orderdate", 1996, 12, first_day=10))
    home = s.table("customer").join(s.nations, F.col("c_nationkey") == F.col("n_nationkey"))
    rows = orders.join(home, F.col("o_custkey") == F.col("c_custkey")).select(
        "geo", F.col("o_orderdate").cast("date").alias("day"), (F.col("o_orderstatus") == "F").cast("bigint").alias("f")
    )
    daily = rows.groupBy("geo", "day").agg(F.count("*").alias("cases"), F.sum("f").alias("deaths"))
    return daily.withColumns({"dom": F.dayofmonth("day"), "moy": F.month("day"), "yr": F.year("day")})


@register(
    "FLT-02 FLT-04 CND-03",
    with_parts("SELECT geo, day, cases FROM counted WHERE geo >= 2000 AND geo < 3000", "counted"),
)
def key_range_filter(s: Standins) -> DataFrame:
    """Half-open key range in place of a computed key."""
    inside = s.cases.filter((F.col("geo") >= 2000) & (F.col("geo") < 3000))
    return inside.groupBy("geo", "day").agg(F.sum("cases").alias("cases"))


@register(
    "FLT-03 STR-05 STR-01",
    with_parts(
        """SELECT geo, left(CAST(geo AS VARCHAR), 1) AS prefix, CAST(sum(cases) AS BIGINT) AS cases
        FROM counted WHERE CAST(geo AS VARCHAR) LIKE '4%' GROUP BY geo""",
        "counted",
    ),
)
def key_prefix_filter(s: Standins) -> DataFrame:
    text = F.col("geo").cast("string")
    grouped = s.cases.filter(text.startswith("4")).groupBy("geo").agg(F.sum("cases").alias("cases"))
    return grouped.withColumn("prefix", F.substring(text, 1, 1))


@register(
    "FLT-01 DOM-15",
    with_parts(
        """SELECT day, CAST(status AS INTEGER) AS status, CAST(sum(doses) AS BIGINT) AS doses
        FROM dose WHERE place = 'u' GROUP BY day, status""",
        "dose",
    ),
)
def unknown_key_filter(s: Standins) -> DataFrame:
    return unknown_places(s.doses).groupBy("day", "status").agg(F.sum("doses").alias("doses"))


@register(
    "FLT-05 JOIN-12",
    with_parts(
        """SELECT geo, day, cases FROM counted WHERE geo IN (SELECT geo FROM reg WHERE nuts IS NULL)""",
        "counted",
        "reg",
    ),
)
def in_subquery_filter(s: Standins) -> DataFrame:
    without_code = s.regions.filter(F.col("nuts").isNull()).select("geo")
    daily = s.cases.groupBy("geo", "day").agg(F.sum("cases").alias("cases"))
    return daily.join(without_code, "geo", "left_semi")


@register(
    "FLT-08 DAT-04",
    with_parts(
        "SELECT geo, day, cases FROM counted WHERE day <= (SELECT max(CAST(l_shipdate AS DATE)) FROM lineitem) - 400",
        "counted",
    ),
)
def date_bound_filter(s: Standins) -> DataFrame:
    """Upper date bound taken from another feed."""
    lines = s.table("lineitem").select(F.col("l_shipdate").cast("date").alias("day"))
    bound = F.date_add(latest(lines, "day"), -400)
    kept = s.cases.filter(F.col("day") <= bound)
    return kept.groupBy("geo", "day").agg(F.sum("cases").alias("cases"))


# --- projections -------------------------------------------------------------------------


@register(
    "PRJ-01 PRJ-02 PRJ-03 PRJ-04 PRJ-06",
    """SELECT l_orderkey AS order_key, l_linenumber AS line_no, CAST(l_quantity AS BIGINT) AS amount,
    CAST(l_quantity AS BIGINT) * l_linenumber AS weighted, 0 AS level_id FROM lineitem""",
)
def projections(s: Standins) -> DataFrame:
    """Subset, rename, derive, add a literal, drop."""
    lines = s.table("lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    named = lines.withColumnsRenamed({"l_orderkey": "order_key", "l_linenumber": "line_no"})
    amount = F.col("l_quantity").cast("bigint")
    derived = {"amount": amount, "weighted": amount * F.col("line_no"), "level_id": F.lit(0)}
    return named.withColumns(derived).drop("l_quantity")


@register(
    "PRJ-07 PRJ-08 FLT-07 CND-01",
    """SELECT l_orderkey, l_linenumber,
    CASE WHEN l_returnflag = 'R' THEN l_linenumber + 100 ELSE l_linenumber END AS line_no,
    CASE WHEN l_linestatus = 'F' THEN NULL ELSE CAST(l_quantity AS BIGINT) END AS quantity FROM lineitem""",
)
def conditional_update(s: Standins) -> DataFrame:
    lines = s.table("lineitem")
    returned, closed = F.col("l_returnflag") == "R", F.col("l_linestatus") == "F"
    number = F.col("l_linenumber")
    return lines.select(
        "l_orderkey",
        "l_linenumber",
        F.when(returned, number + 100).otherwise(number).alias("line_no"),
        F.when(~closed, F.col("l_quantity").cast("bigint")).alias("quantity"),
    )


@register(
    "PRJ-09 PRJ-05 CND-02",
    with_parts(
        """SELECT p.geo, p.day, coalesce(doses_1, 0) AS doses_1, coalesce(doses_2, 0) AS doses_2,
        coalesce(doses_3, 0) AS doses_3 FROM panel p LEFT JOIN dosed d ON d.geo = p.geo AND d.day = p.day""",
        "panel",
        "dosed",
    ),
)
def fill_defaults(s: Standins) -> DataFrame:
    """Left join and a map of defaults per column."""
    panel = dense_panel(s.cases, ["cases"], days_of=s.case_days).drop("cases")
    joined = panel.join(s.placed, ["geo", "day"], "left")
    return joined.fillna({"doses_1": 0, "doses_2": 0, "doses_3": 0})


# --- checks ------------------------------------------------------------------------------


@register(
    "DOM-22 AGG-04 AGG-06 DAT-05",
    with_parts(
        """SELECT min(day) AS first_day, max(day) AS last_day, max(day) - min(day) + 1 AS expected_days,
        count(DISTINCT day) AS n_days, count(DISTINCT geo) AS n_keys, count(*) AS n_rows FROM fact""",
        "fact",
    ),
    "profile_time_series",
)
def case_profile(s: Standins) -> DataFrame:
    return profile_time_series(s.cases, "geo")


@register(
    "DOM-22 SRC-06 SET-05",
    with_parts("SELECT day FROM days WHERE day NOT IN (SELECT day FROM fact)", "days", "fact"),
    "missing_dates",
)
def days_without_case(s: Standins) -> DataFrame:
    return missing_days(s.case_days)


@register(
    "DOM-23 AGG-10 SRT-02 FLT-10",
    with_parts(
        f"""SELECT * FROM (
        SELECT 'mobility_change' AS column_name, count(*) FILTER (m.mobility_change IS NULL) AS n_nulls FROM
          panel p LEFT JOIN (SELECT * FROM mob_region JOIN crosswalk USING (nuts)) m ON m.geo = p.geo AND m.day = p.day
        UNION ALL SELECT 'r4', count(*) FILTER (r4 IS NULL) FROM (SELECT day, {indicator_columns(())}
          FROM peopled_totals JOIN peopled_frames ON g_key = geo AND g_day = day)
        UNION ALL SELECT 'r7', count(*) FILTER (r7 IS NULL) FROM (SELECT day, {indicator_columns(())}
          FROM peopled_totals JOIN peopled_frames ON g_key = geo AND g_day = day)) WHERE n_nulls > 0""",
        "panel",
        "mob_region",
        "crosswalk",
        "peopled_totals",
        "peopled_frames",
    ),
    "profile_nulls",
    store="line_days",
)
def panel_nulls(s: Standins) -> DataFrame:
    table = case_indicators(s).select("geo", "day", "cases", "r4", "r7")
    mobility = mobility_by_region(s.mobility_region, crosswalk_of(s))
    return profile_nulls(enrich(table, mobility, ("geo", "day"), ["mobility_change"]))


@register(
    "AGG-09 FLT-10 AGG-08",
    "SELECT l_orderkey, l_suppkey, count(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
)
def key_uniqueness(s: Standins) -> DataFrame:
    """Order and supplier pairs found on more than one line."""
    return duplicate_keys(s.table("lineitem"), "l_orderkey", "l_suppkey")


@register(
    "SET-05 JOIN-12 FLT-05",
    "SELECT o_orderkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)",
)
def key_difference(s: Standins) -> DataFrame:
    """Orders without a line."""
    orders = s.table("orders").select("o_orderkey")
    return unmatched_keys(orders, s.table("lineitem").select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey")


@register(
    "AGG-06 AGG-07",
    """SELECT count(DISTINCT l_returnflag) AS n_l_returnflag, count(DISTINCT l_suppkey) AS n_l_suppkey,
    count(DISTINCT l_linenumber) AS n_l_linenumber FROM lineitem""",
    "distinct_counts",
)
def line_cardinalities(s: Standins) -> DataFrame:
    return distinct_counts(s.table("lineitem"), "l_returnflag", "l_suppkey", "l_linenumber")


@register(
    "DOM-17 AGG-10",
    with_parts(
        "SELECT CAST(status AS INTEGER) AS status, count(*) AS n_rows FROM dose WHERE status > 2 GROUP BY status", "dose"
    ),
    "unexpected_levels",
)
def doses_beyond_two(s: Standins) -> DataFrame:
    """Statuses outside a declared list of two."""
    return unexpected_levels(s.doses, levels=(1, 2))


@register(
    "AGG-04 AGG-05 SRT-04",
    with_parts(
        """SELECT min(day) AS first_day, max(day) AS last_day, max(geo) AS last_geo,
        CAST(sum(cases) AS BIGINT) AS cases, CAST(sum(deaths) AS BIGINT) AS deaths FROM fact""",
        "fact",
    ),
)
def global_totals(s: Standins) -> DataFrame:
    return s.cases.agg(
        F.min("day").alias("first_day"),
        F.max("day").alias("last_day"),
        F.max("geo").alias("last_geo"),
        F.sum("cases").alias("cases"),
        F.sum("deaths").alias("deaths"),
    )


@register(
    "SET-01 SET-02 AGG-07",
    """SELECT 'customer' AS side, c_nationkey AS nation, count(*) AS n FROM customer GROUP BY 2
    UNION ALL SELECT 'supplier', s_nationkey, count(*) FROM supplier GROUP BY 2""",
)
def union_by_name(s: Standins) -> DataFrame:
    """Rows put together by column name, whatever their order."""
    buyers = s.table("customer").groupBy(F.col("c_nationkey").alias("nation")).agg(F.count("*").alias("n"))
    sellers = s.table("supplier").groupBy(F.col("s_nationkey").alias("nation")).agg(F.count("*").alias("n"))
    left = buyers.select(F.lit("customer").alias("side"), "nation", "n")
    return left.unionByName(sellers.select("n", "nation", F.lit("supplier").alias("side")))


# --- vintages ----------------------------------------------------------------------------


@register(
    "DOM-24 SNK-04 AGG-04",
    with_parts(
        """SELECT day, place, CAST(status AS INTEGER) AS status, doses,
        (SELECT max(day) FROM dose) AS datenstand FROM dose""",
        "dose",
    ),
    "vintage_stamp",
    store="line_days",
)
def stamped_doses(s: Standins) -> DataFrame:
    return stamp_vintage(s.doses, "day")


@register(
    "DOM-24 SNK-05 JOIN-01",
    with_parts(
        """SELECT geo, day, cases, (SELECT max(day) FROM fact) AS rki_stand,
        (SELECT max(CAST(l_shipdate AS DATE)) FROM lineitem) AS rki_impf_stand,
        (SELECT max(CAST(ts AS DATE)) FROM events) AS rki_mobilitaet_stand, DATE '2001-12-31' AS einwohner_stand
        FROM panel""",
        "panel",
    ),
)
def vintage_stamp_levels(s: Standins) -> DataFrame:
    panel = dense_panel(s.cases, ["cases"], days_of=s.case_days)
    lines = s.table("lineitem").select(F.col("l_shipdate").cast("date").alias("day"))
    events = s.table("events").select(F.col("ts").cast("date").alias("day"))
    return stamp_vintages(
        panel,
        {
            "rki_stand": (s.case_days, "day"),
            "rki_impf_stand": (lines, "day"),
            "rki_mobilitaet_stand": (events, "day"),
            "einwohner_stand": (s.regions, "vintage"),
        },
    )


# --- scalar functions --------------------------------------------------------------------


@register(
    "STR-01 STR-02 STR-03 STR-04 STR-06 FMT-01 FMT-02",
    """SELECT c_custkey, lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS key_text,
    CAST(substr(c_name, 10) AS INTEGER) AS number, trim(c_mktsegment) || '/' || lower(c_mktsegment) AS segment,
    replace(CAST(CAST(c_nationkey AS DOUBLE) / 8 AS VARCHAR), '.', ',') AS comma,
    CAST(CAST(c_nationkey AS DOUBLE) / 16 AS VARCHAR) AS point,
    printf('%.2f', c_nationkey / 4.0 * 100) || '%' AS share FROM customer""",
)
def text_functions(s: Standins) -> DataFrame:
    eighth = F.col("c_nationkey").cast("double") / 8
    return s.table("customer").select(
        "c_custkey",
        padded_key("c_nationkey").alias("key_text"),
        F.expr("substring(c_name, 10)").cast("int").alias("number"),
        F.concat_ws("/", F.trim("c_mktsegment"), F.lower("c_mktsegment")).alias("segment"),
        decimal_comma(eighth).alias("comma"),
        plain_decimal(eighth / 2).alias("point"),
        percent_text(eighth * 2).alias("share"),
    )


@register(
    "DAT-01 DAT-02 DAT-03 DAT-04 DAT-05 DAT-06",
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS from_slashes, CAST(o_orderdate AS DATE) AS from_german,
    CAST(day(o_orderdate) AS INTEGER) AS dom, CAST(month(o_orderdate) AS INTEGER) AS moy,
    CAST(year(o_orderdate) AS INTEGER) AS yr, CAST(o_orderdate AS DATE) + 7 AS week_later,
    CAST(CAST(o_orderdate AS DATE) - DATE '1995-01-01' AS INTEGER) AS age,
    strftime(o_orderdate, '%d.%m.%Y') AS german FROM orders""",
)
def date_functions(s: Standins) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    slashes = F.concat(F.date_format(day, "yyyy/MM/dd"), F.lit(" 00:00:00+00"))
    german = F.concat(day_text(day), F.lit(", 00:00 Uhr"))
    return s.table("orders").select(
        "o_orderkey",
        day_from_text(slashes).alias("from_slashes"),
        day_from_parts(german).alias("from_german"),
        F.dayofmonth(day).alias("dom"),
        F.month(day).alias("moy"),
        F.year(day).alias("yr"),
        F.date_add(day, 7).alias("week_later"),
        F.datediff(day, F.lit("1995-01-01").cast("date")).alias("age"),
        day_text(day).alias("german"),
    )


@register(
    "MTH-01 MTH-02 MTH-03 MTH-04 CND-02",
    f"""SELECT l_orderkey, l_linenumber, CAST(l_suppkey // 10 AS BIGINT) AS parent,
    {rounded("l_partkey", "l_suppkey", 4)} AS ratio, {rounded("l_linenumber - 4", "l_suppkey", 2, 1000)} AS signed,
    {or_zero(rounded("l_suppkey", "l_linenumber - 3", 1))} AS guarded FROM lineitem""",
)
def rounding_functions(s: Standins) -> DataFrame:
    return s.table("lineitem").select(
        "l_orderkey",
        "l_linenumber",
        int_div("l_suppkey", 10).alias("parent"),
        round_ratio("l_partkey", "l_suppkey", 4).alias("ratio"),
        round_ratio("l_linenumber - 4", "l_suppkey", 2, scale=1000).alias("signed"),
        ratio_or_zero("l_suppkey", "l_linenumber - 3", 1).alias("guarded"),
    )


ODD_DOSES = """odd AS (SELECT o_orderkey AS k, o_custkey AS amount, CAST(o_orderdate AS DATE) AS d, CASE WHEN o_orderkey % 7 = 0
  THEN NULL WHEN o_orderkey % 11 = 0 THEN ' ' WHEN o_orderkey % 13 = 0 THEN 'x1' WHEN o_orderkey % 5 = 0 THEN 'u'
  ELSE CAST(o_custkey AS VARCHAR) END AS place FROM orders)"""


@register(
    "DOM-03 DOM-22",
    f"""WITH {ODD_DOSES}, judged AS (SELECT amount, CASE WHEN k % 17 = 0 THEN 'no day' WHEN place IS NULL OR place = ' '
      THEN 'no place' WHEN place = 'x1' THEN 'unreadable place'
      WHEN place <> 'u' AND amount NOT IN (SELECT c_custkey FROM customer WHERE c_nationkey % 3 > 0) THEN 'unlisted place'
      WHEN d NOT BETWEEN DATE '1993-01-01' AND DATE '1996-12-31' THEN 'outside the days' END AS reason FROM odd)
    SELECT reason, CAST(count(*) AS BIGINT) AS n_rows, CAST(sum(amount) AS BIGINT) AS amount
    FROM judged WHERE reason IS NOT NULL GROUP BY reason""",
)
def feed_rejects(s: Standins) -> DataFrame:
    """Doses left out by reason: unreadable days and places, places and days that no panel row has."""
    key = F.col("o_orderkey")
    place = (
        F.when(key % 7 == 0, None)
        .when(key % 11 == 0, " ")
        .when(key % 13 == 0, "x1")
        .when(key % 5 == 0, "u")
        .otherwise(F.col("o_custkey").cast("string"))
    )
    day = F.when(key % 17 != 0, F.col("o_orderdate").cast("date"))
    doses = s.table("orders").select(day.alias("day"), place.alias("place"), F.col("o_custkey").alias("doses"))
    listed = s.table("customer").filter("c_nationkey % 3 > 0").select(F.col("c_custkey").cast("int").alias("geo"))
    return left_out_doses(doses, listed, "1993-01-01", "1996-12-31")


@register(
    "SRC-02 FLT-10",
    """SELECT 'orders' AS feed, CAST(count(*) AS BIGINT) AS n_rows, CAST(sum(CAST(o_orderkey % 11 = 0 AS INTEGER)
      + CAST(o_orderkey % 13 = 0 AS INTEGER)) AS BIGINT) AS n_fields FROM orders
    WHERE o_orderkey % 11 = 0 OR o_orderkey % 13 = 0""",
)
def feed_field_errors(s: Standins) -> DataFrame:
    """Unreadable fields of a written feed, counted where it is read."""
    key = F.col("o_orderkey")
    day = F.when(key % 11 == 0, "02.12.1995").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    status = F.when(key % 13 == 0, "x9").otherwise((key % 3).cast("string"))
    path = fresh_path(s.spark, "faulty")
    s.table("orders").select(day.alias("DAY"), status.alias("STATUS")).write.option("header", True).csv(path)
    feed = Feed(path, {"day": ("day", "day"), "status": ("status", "int")})
    return field_errors({"orders": read_feed(s.spark, feed, "n_errors")})


@register(
    "DOM-18 AGG-09",
    """SELECT 'orders' AS feed, CAST(o_custkey AS VARCHAR) || ' ' || CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS key,
    count(*) AS n_rows FROM orders GROUP BY o_custkey, CAST(o_orderdate AS DATE) HAVING count(*) > 1
    UNION ALL SELECT 'lineitem', CAST(l_orderkey AS VARCHAR), count(*) FROM lineitem GROUP BY l_orderkey
    HAVING count(*) > 1""",
)
def feed_repeated_keys(s: Standins) -> DataFrame:
    """Keys that feeds hold more than once, of all feeds in one report."""
    orders = s.table("orders").withColumn("day", F.col("o_orderdate").cast("date"))
    return repeated_keys(
        {"orders": (orders, ("o_custkey", "day")), "lineitem": (s.table("lineitem"), ("l_orderkey",))}
    )


# --- sources and sinks -------------------------------------------------------------------


@register(
    "SRC-01 SRC-08 SRC-09 FN-04",
    """SELECT c_custkey AS customer, c_name AS name, c_nationkey AS nation, c_acctbal AS balance,
    c_mktsegment AS segment FROM customer""",
)
def csv_comma_scan(s: Standins) -> DataFrame:
    """Comma file whose header is in capitals, read by name into declared types."""
    path = fresh_path(s.spark, "comma")
    table = s.table("customer")
    table.toDF(*[c.upper() for c in table.columns]).write.option("header", True).csv(path)
    layout = {
        "c_custkey": ("customer", "bigint"),
        "c_name": ("name", "string"),
        "c_nationkey": ("nation", "int"),
        "c_acctbal": ("balance", "double"),
        "c_mktsegment": ("segment", "string"),
    }
    return read_feed(s.spark, Feed(path, layout))


DECLARED = {
    "impfdatum": ("day", "day"),
    "landkreisid_impfort": ("place", "string"),
    "altersgruppe": ("age_group", "string"),
    "impfschutz": ("status", "int"),
    "anzahl": ("doses", "bigint"),
}


@register(
    "SRC-02 STR-02 DAT-01",
    """SELECT CASE WHEN o_orderkey % 11 <> 0 THEN CAST(o_orderdate AS DATE) END AS day,
    CASE WHEN o_orderkey % 5 = 0 THEN 'u' ELSE CAST(o_custkey AS VARCHAR) END AS place,
    o_orderpriority || ', ' || CAST(o_orderkey AS VARCHAR) AS age_group,
    CASE WHEN o_orderkey % 13 <> 0 THEN CAST(o_orderkey % 3 AS INTEGER) END AS status,
    CASE WHEN o_orderkey % 7 <> 0 THEN o_custkey END AS doses,
    CAST(o_orderkey % 11 = 0 AS INTEGER) + CAST(o_orderkey % 13 = 0 AS INTEGER) AS n_errors FROM orders""",
)
def csv_declared_scan(s: Standins) -> DataFrame:
    """Positional layout over quoted, short and malformed rows; errors are counted."""
    key = F.col("o_orderkey")
    day = F.when(key % 11 == 0, "1995-13-77").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    place = F.when(key % 5 == 0, "u").otherwise(F.col("o_custkey").cast("string"))
    group = F.concat(F.lit('"'), F.col("o_orderpriority"), F.lit(", "), key.cast("string"), F.lit('"'))
    status = F.when(key % 13 == 0, "none").otherwise((key % 3).cast("string"))
    amount = F.when(key % 7 != 0, F.col("o_custkey").cast("string"))
    # a null amount is left out together with its separator: a short row
    lines = s.table("orders").select(F.concat_ws(",", day, place, group, status, amount).alias("value"))
    path = fresh_path(s.spark, "declared")
    # Written through the CSV writer for its header alone: what follows is a line each, already delimited.
    header = ",".join(c.upper() for c in DECLARED)
    lines.select(F.col("value").alias(header)).write.option("header", True).option("quote", "").option("sep", "\x01").csv(path)
    return read_declared(s.spark, path, DECLARED)


@register(
    "SRC-03",
    """SELECT CASE WHEN s_suppkey % 2 = 0 THEN s_name || ';' || CAST(s_nationkey AS VARCHAR) ELSE s_name END AS nuts3,
    CAST(s_suppkey AS INTEGER) AS code FROM supplier""",
)
def csv_semicolon_quote_scan(s: Standins) -> DataFrame:
    """Semicolon file with single quotes around fields that hold the separator."""
    name = F.when(
        F.col("s_suppkey") % 2 == 0, F.concat_ws(";", "s_name", F.col("s_nationkey").cast("string"))
    ).otherwise(F.col("s_name"))
    path = fresh_path(s.spark, "semicolon")
    writer = s.table("supplier").select(name.alias("NUTS3"), F.col("s_suppkey").alias("CODE")).write
    writer.option("header", True).option("sep", ";").option("quote", "'").csv(path)
    layout = {"nuts3": ("nuts3", "string"), "code": ("code", "int")}
    return read_feed(s.spark, Feed(path, layout, sep=";", quote="'"))


@register(
    "SRC-04 SRC-03",
    "SELECT CAST(c_custkey AS INTEGER) AS code, c_name AS nuts3, c_acctbal AS balance FROM customer",
)
def zip_member_scan(s: Standins) -> DataFrame:
    """Members of zip archives, made from the table partition by partition."""
    rows = s.table("customer").select(
        F.col("c_name").alias("NUTS3"), F.col("c_custkey").alias("CODE"), F.col("c_acctbal").alias("BALANCE")
    )
    archives = zip_partitions(rows, "codes.csv", sep=";", quote="'")
    layout = {"nuts3": ("nuts3", "string"), "code": ("code", "int"), "balance": ("balance", "double")}
    return apply_types(unzip_rows(archives, "codes.csv", list(layout), ";", "'"), layout)


@register(
    "SRC-05 SNK-03 SRC-09",
    with_parts("SELECT geo, day, cases, deaths FROM counted", "counted"),
)
def table_replace_scan(s: Standins) -> DataFrame:
    """A stored table replaced by a newer one and scanned under a name."""
    path = fresh_path(s.spark, "table")
    daily = s.cases.groupBy("geo", "day").agg(F.sum("cases").alias("CASES"), F.sum("deaths").alias("DEATHS"))
    replace_table(s.regions, path)
    replace_table(daily, path)
    lowercase_columns(scan_table(s.spark, path)).createOrReplaceTempView("daily_cases")
    return s.spark.table("daily_cases")


def _exported_lines(s: Standins, table: DataFrame, **style) -> DataFrame:
    path = fresh_path(s.spark, "export")
    write_delimited(formatted(table, **style), path, header=False)
    return s.spark.read.text(path).withColumnRenamed("value", "line")


EXPORTED = f"""SELECT geo, day, cases, {rounded('last_7', 'population', 1, 100000)} AS incidence,
  {rounded('cases_cum', 'population', 4)} AS infection_rate
  FROM peopled_totals JOIN peopled_frames ON g_key = geo AND g_day = day"""


def _exported_panel(s: Standins) -> DataFrame:
    return case_indicators(s, mask=False).select("geo", "day", "cases", "incidence", "infection_rate")


@register(
    "SNK-01 FMT-02 DOM-25",
    with_parts(
        f"""SELECT concat_ws(';', geo, day, cases, replace(CAST(incidence AS VARCHAR), '.', ','),
        replace(CAST(infection_rate AS VARCHAR), '.', ',')) AS line FROM ({EXPORTED})""",
        "peopled_totals",
        "peopled_frames",
    ),
)
def export_decimal_comma(s: Standins) -> DataFrame:
    """Lines of an export with decimal commas, as written."""
    return _exported_lines(s, _exported_panel(s))


@register(
    "SNK-02 FMT-01 DAT-06 STR-03 DOM-25",
    with_parts(
        f"""SELECT concat_ws(';', lpad(CAST(geo AS VARCHAR), 5, '0'), strftime(day, '%d.%m.%Y'), cases,
        CAST(incidence AS VARCHAR), printf('%.2f', infection_rate * 100) || '%') AS line FROM ({EXPORTED})""",
        "peopled_totals",
        "peopled_frames",
    ),
    "format_export",
)
def export_formatted(s: Standins) -> DataFrame:
    """Lines of an export with German dates, padded keys and percentages, as written."""
    style = {"decimal_mark": ".", "german_days": True, "percent": ["infection_rate"], "padded": {"geo": 5}}
    return _exported_lines(s, _exported_panel(s), **style)


SHARED_CODES = """p AS (SELECT DISTINCT 'N' || CAST(s_suppkey % 7 AS VARCHAR) AS nuts, s_suppkey AS postal,
  (n_regionkey + 1) * 1000 + n_nationkey + 1 AS geo FROM supplier JOIN nation ON s_nationkey = n_nationkey),
w AS (SELECT geo, nuts, count(*) AS n_shared FROM p GROUP BY geo, nuts)"""


@register(
    "DOM-16 DOM-17",
    f"""WITH {SHARED_CODES} SELECT geo, nuts, n_shared FROM w
    QUALIFY row_number() OVER (PARTITION BY geo ORDER BY n_shared DESC, nuts) = 1""",
)
def crosswalk_weighted(s: Standins) -> DataFrame:
    """Regions whose postal codes lie in several codes take the one they share most with: one row a region."""
    suppliers = s.table("supplier").join(s.nations, F.col("s_nationkey") == F.col("n_nationkey"))
    code = F.concat(F.lit("N"), (F.col("s_suppkey") % 7).cast("string"))
    codes = suppliers.select(code.alias("nuts"), F.col("s_suppkey").cast("int").alias("postal"))
    postal = suppliers.select(F.col("s_suppkey").cast("int").alias("postal"), "geo")
    none = codes.select("nuts", F.lit(0).alias("geo")).limit(0)
    return one_code_each(pairs_by_postal(codes, postal), none, codes, postal)


@register(
    "DOM-22 AGG-06",
    with_parts(
        """SELECT geo, min(day) AS first_day, max(day) AS last_day, CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_days,
        CAST(max(day) - min(day) + 1 - count(*) AS BIGINT) AS n_missing,
        CAST(count(*) FILTER (step > 1) AS INTEGER) AS n_gaps, CAST(coalesce(max(step), 1) - 1 AS INTEGER) AS longest_gap
        FROM (SELECT geo, day, n, lead(day) OVER (PARTITION BY geo ORDER BY day) - day AS step
          FROM (SELECT geo, day, count(*) AS n FROM fact GROUP BY geo, day)) GROUP BY geo""",
        "fact",
    ),
    "missing_days_by_key",
)
def days_missing_by_region(s: Standins) -> DataFrame:
    """Gaps in the reports of each region, from one map of bits each."""
    return missing_days_by_key(s.cases, "geo")
