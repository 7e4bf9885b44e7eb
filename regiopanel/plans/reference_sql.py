"""Building blocks of the SQL that each registered query is checked against."""

from __future__ import annotations


def rounded(num: str, den: str, digits: int, scale: int = 1) -> str:
    """Ratio rounded half away from zero, on wide integers; null if there is no denominator."""
    n, d, f = f"CAST({num} AS HUGEINT)", f"CAST({den} AS HUGEINT)", 10**digits * scale
    whole = f"sign({n}) * sign({d}) * ((2 * abs({n}) * {f} + abs({d})) // (2 * abs({d})))"
    return f"(CASE WHEN {d} <> 0 THEN CAST({whole} AS DOUBLE) / CAST({10**digits} AS DOUBLE) END)"


def or_zero(sql: str) -> str:
    return f"coalesce({sql}, CAST(0 AS DOUBLE))"


CITY_GEO = "CASE WHEN n_regionkey = 0 THEN 1000 ELSE (n_regionkey + 1) * 1000 + n_nationkey + 1 END"
NUTS = "CASE WHEN n_regionkey = 0 THEN 'N00' ELSE 'N' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') END"


def _mobility(keys: str) -> str:
    lead = f"{keys}, " if keys else ""
    return f"""SELECT {lead}day,
      {rounded("sum(discount)", "sum(n)", 4)} AS mobility_change,
      {rounded("sum(quantity)", "sum(n)", 4)} AS mobility_change_7day_average,
      {rounded("sum(tax)", "sum(n)", 4)} AS mobility_change_weekly"""


ICU_COLUMNS = f"""{rounded("sum(icu_cases)", "sum(beds_free) + sum(beds_occupied)", 4)} AS icu_share,
      CAST(sum(icu_cases) AS BIGINT) AS icu_cases, CAST(sum(icu_ventilated) AS BIGINT) AS icu_ventilated"""


def indicator_parts(source: str, geo: str) -> str:
    """Running totals and frames of a dense series; frames as self-joins on a range of days."""
    frames = {"last_7": (-6, 0), "recent_4": (-3, 0), "earlier_4": (-7, -4), "recent_7": (-5, 1), "earlier_7": (-9, -3)}
    sums = ",\n".join(
        f"coalesce(sum(CASE WHEN b.day - a.day BETWEEN {lo} AND {hi} THEN b.cases END), 0) AS {name}"
        for name, (lo, hi) in frames.items()
    )
    return f"""SELECT a.{geo} AS g_key, a.day AS g_day, {sums}
      FROM {source} a JOIN {source} b ON a.{geo} = b.{geo} AND b.day BETWEEN a.day - 9 AND a.day + 1
      GROUP BY a.{geo}, a.day"""


def indicator_columns(levels: tuple[int, ...] = (1, 2, 3), mask: bool = True) -> str:
    """Indicator columns over a source with totals, frames and first_day."""
    r4 = or_zero(rounded("recent_4", "earlier_4", 2))
    r7 = or_zero(rounded("recent_7", "earlier_7", 2))
    if mask:
        r4 = f"CASE WHEN day <= first_day + 7 THEN NULL ELSE {r4} END"
        r7 = f"CASE WHEN day <= first_day + 9 THEN NULL ELSE {r7} END"
    quotas = "".join(f",\n {rounded(f'doses_{i}_cum', 'population', 4)} AS dose_quota_{i}" for i in levels)
    return f"""{rounded("last_7", "population", 1, 100000)} AS incidence,
      {r4} AS r4, {r7} AS r7,
      {rounded("cases_cum", "population", 4)} AS infection_rate,
      {or_zero(rounded("deaths_cum", "cases_cum", 4))} AS lethality_rate{quotas}"""


def _totals(source: str, geo: str, doses: bool) -> str:
    columns = ["cases", "deaths", *(["doses_1", "doses_2", "doses_3"] if doses else [])]
    running = ", ".join(
        f"CAST(sum({c}) OVER (PARTITION BY {geo} ORDER BY day ROWS UNBOUNDED PRECEDING) AS BIGINT) AS {c}_cum"
        for c in columns
    )
    return f"""SELECT s.*, {running}, min(CASE WHEN cases > 0 THEN day END) OVER (PARTITION BY {geo}) AS first_day
      FROM {source} s"""


DAY_SERIES = "SELECT CAST(unnest(generate_series({lo}, {hi}, INTERVAL 1 DAY)) AS DATE) AS day"

# Named parts; each may use those before it.
PARTS: dict[str, str] = {
    "places": "SELECT *, (n_regionkey + 1) * 1000 + n_nationkey + 1 AS geo FROM nation",
    "fact": """SELECT geo, CAST(o_orderdate AS DATE) AS day, CAST(1 AS BIGINT) AS cases,
      CAST(o_orderstatus = 'F' AS BIGINT) AS deaths
      FROM orders JOIN customer ON o_custkey = c_custkey JOIN places ON c_nationkey = n_nationkey""",
    "counted": """SELECT geo, day, CAST(sum(cases) AS BIGINT) AS cases, CAST(sum(deaths) AS BIGINT) AS deaths
      FROM fact GROUP BY geo, day""",
    "days": DAY_SERIES.format(lo="(SELECT min(day) FROM fact)", hi="(SELECT max(day) FROM fact)"),
    "grid": "SELECT geo, day FROM (SELECT DISTINCT geo FROM fact) CROSS JOIN days",
    "people": "SELECT c_nationkey, count(*) AS population FROM customer GROUP BY c_nationkey",
    "reg": f"""SELECT geo, coalesce(population, 0) AS population, n_name AS name, 'nation' AS kind,
      n_regionkey + 1 AS state, r_name AS state_name,
      CASE WHEN n_nationkey NOT IN (22, 23) AND n_regionkey > 0 THEN {NUTS} END AS nuts
      FROM places JOIN region ON n_regionkey = r_regionkey LEFT JOIN people ON c_nationkey = n_nationkey""",
    "panel": """SELECT geo, day, coalesce(cases, 0) AS cases, coalesce(deaths, 0) AS deaths
      FROM grid LEFT JOIN counted USING (geo, day)""",
    "peopled": "SELECT panel.*, population, state, state_name, name, kind FROM panel LEFT JOIN reg USING (geo)",
    "peopled_totals": _totals("peopled", "geo", False),
    "peopled_frames": indicator_parts("peopled", "geo"),
    "ships": f"SELECT s_suppkey, n_nationkey, n_regionkey, {CITY_GEO} AS geo, {NUTS} AS nuts "
    "FROM supplier JOIN nation ON s_nationkey = n_nationkey",
    "ld": """SELECT n_nationkey, geo, nuts, CAST(l_shipdate AS DATE) AS day, l_returnflag, count(*) AS n,
      count(*) FILTER (l_linestatus = 'O') AS n_open,
      count(*) FILTER (l_linestatus = 'O' AND l_quantity > 25) AS n_heavy,
      sum(CAST(l_quantity AS BIGINT)) AS quantity,
      sum(CAST(round(l_discount * 100) AS BIGINT) - 5) AS discount,
      sum(CAST(round(l_tax * 100) AS BIGINT)) AS tax
      FROM lineitem JOIN ships ON l_suppkey = s_suppkey GROUP BY ALL""",
    "dose": """SELECT day, CASE WHEN n_nationkey = 24 THEN 'u' ELSE CAST(geo AS VARCHAR) END AS place,
      CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 WHEN 'R' THEN 3 END AS status, n AS doses FROM ld""",
    "dosed": """SELECT CAST(place AS INTEGER) AS geo, day,
      CAST(sum(CASE WHEN status = 1 THEN doses ELSE 0 END) AS BIGINT) AS doses_1,
      CAST(sum(CASE WHEN status = 2 THEN doses ELSE 0 END) AS BIGINT) AS doses_2,
      CAST(sum(CASE WHEN status = 3 THEN doses ELSE 0 END) AS BIGINT) AS doses_3
      FROM dose WHERE place <> 'u' GROUP BY 1, 2""",
    "unplaced": """SELECT day,
      sum(CASE WHEN status = 1 THEN doses ELSE 0 END) AS u1,
      sum(CASE WHEN status = 2 THEN doses ELSE 0 END) AS u2,
      sum(CASE WHEN status = 3 THEN doses ELSE 0 END) AS u3
      FROM dose WHERE place = 'u' GROUP BY day""",
    "shares": "SELECT d.day, r.geo, "
    + ", ".join(
        f"d.doses_{i} AS t{i}, "
        f"CAST({or_zero(rounded(f'd.doses_{i} * r.population', 'w.all_people', 0))} AS BIGINT) AS s{i}"
        for i in (1, 2, 3)
    )
    + """ FROM dosed d JOIN (SELECT * FROM reg WHERE geo > 1000 AND geo < 2000) r ON d.geo = 1000
      CROSS JOIN (SELECT sum(population) AS all_people FROM reg WHERE geo > 1000 AND geo < 2000) w""",
    "allocated": "SELECT geo, day, "
    + ", ".join(
        f"""CAST(s{i} + CASE WHEN geo = max(geo) OVER (PARTITION BY day)
      THEN t{i} - sum(s{i}) OVER (PARTITION BY day) ELSE 0 END AS BIGINT) AS doses_{i}"""
        for i in (1, 2, 3)
    )
    + " FROM shares",
    "counts": """SELECT p.*, coalesce(d.doses_1, a.doses_1, 0) AS doses_1, coalesce(d.doses_2, a.doses_2, 0) AS doses_2,
      coalesce(d.doses_3, a.doses_3, 0) AS doses_3
      FROM peopled p LEFT JOIN dosed d USING (geo, day) LEFT JOIN allocated a USING (geo, day)""",
    "with_city": """SELECT geo, day, cases, deaths, population, state, state_name, name, kind,
      doses_1, doses_2, doses_3, FALSE AS is_subtotal FROM counts
      UNION ALL SELECT 1000, day, CAST(sum(cases) AS BIGINT), CAST(sum(deaths) AS BIGINT),
      CAST(sum(population) AS BIGINT), max(state), max(state_name), 'Whole city', 'city', CAST(sum(doses_1) AS BIGINT),
      CAST(sum(doses_2) AS BIGINT), CAST(sum(doses_3) AS BIGINT), TRUE
      FROM counts WHERE geo >= 1000 AND geo < 2000 GROUP BY day""",
    "region_totals": _totals("with_city", "geo", True),
    "region_frames": indicator_parts("with_city", "geo"),
    "by_state": """SELECT state, day, CAST(sum(cases) AS BIGINT) AS cases, CAST(sum(deaths) AS BIGINT) AS deaths,
      CAST(sum(doses_1) AS BIGINT) AS doses_1, CAST(sum(doses_2) AS BIGINT) AS doses_2,
      CAST(sum(doses_3) AS BIGINT) AS doses_3, CAST(sum(population) AS BIGINT) AS population,
      max(state_name) AS state_name FROM counts GROUP BY state, day""",
    "state_totals": _totals("by_state", "state", True),
    "state_frames": indicator_parts("by_state", "state"),
    "by_country": """SELECT 0 AS geo, c.day, CAST(sum(cases) AS BIGINT) AS cases, CAST(sum(deaths) AS BIGINT) AS deaths,
      CAST(sum(doses_1) + coalesce(max(u1), 0) AS BIGINT) AS doses_1,
      CAST(sum(doses_2) + coalesce(max(u2), 0) AS BIGINT) AS doses_2,
      CAST(sum(doses_3) + coalesce(max(u3), 0) AS BIGINT) AS doses_3,
      CAST(sum(population) AS BIGINT) AS population
      FROM counts c LEFT JOIN unplaced u ON c.day = u.day GROUP BY c.day""",
    "country_totals": _totals("by_country", "geo", True),
    "country_frames": indicator_parts("by_country", "geo"),
    "mob_region": _mobility("nuts") + " FROM ld GROUP BY nuts, day",
    "mob_state": _mobility("state_name") + """ FROM ld JOIN (SELECT DISTINCT state, state_name FROM reg) s
      ON ld.geo // 1000 = s.state GROUP BY state_name, day""",
    "mob_country": _mobility("") + " FROM ld GROUP BY day",
    "icu": """SELECT geo, geo // 1000 AS state, day, sum(n_open) AS icu_cases, sum(n_heavy) AS icu_ventilated,
      sum(CASE WHEN l_returnflag = 'A' THEN n ELSE 0 END) AS beds_free,
      sum(CASE WHEN l_returnflag = 'A' THEN 0 ELSE n END) AS beds_occupied FROM ld GROUP BY geo, day""",
    "icu_region": f"SELECT geo, day, {ICU_COLUMNS} FROM icu GROUP BY geo, day",
    "icu_state": f"SELECT state, day, {ICU_COLUMNS} FROM icu GROUP BY state, day",
    "icu_country": f"SELECT day, {ICU_COLUMNS} FROM icu GROUP BY day",
    "level_people": """SELECT state AS level_id, sum(population) AS population FROM reg GROUP BY state
      UNION ALL SELECT 0, sum(population) FROM reg""",
    "hospital": """SELECT geo // 1000 AS level_id, day, sum(quantity) AS hospital_cases FROM ld GROUP BY 1, 2
      UNION ALL SELECT 0, day, sum(quantity) FROM ld GROUP BY day""",
    "hosp": f"""SELECT level_id, day, {rounded("hospital_cases", "population", 4, 100000)} AS hospital_incidence
      FROM hospital LEFT JOIN level_people USING (level_id)""",
    "postal_nuts": "SELECT nuts AS nuts3, s_suppkey AS code FROM ships WHERE n_nationkey <> 22",
    "postal_keys": "SELECT s_suppkey AS plz, geo * 1000 + s_suppkey % 1000 AS ags FROM ships",
    "postal_pairs": """SELECT DISTINCT nuts3 AS nuts, CAST(ags // 1000 AS INTEGER) AS geo
      FROM postal_nuts JOIN postal_keys ON code = plz""",
    "known_pairs": """SELECT nuts, geo FROM reg WHERE nuts IS NOT NULL
      UNION SELECT nuts, geo FROM postal_pairs WHERE geo >= 1000 AND geo < 2000
      UNION SELECT (SELECT min(nuts) FROM postal_pairs WHERE geo >= 1000 AND geo < 2000) AS code, geo FROM reg
      WHERE geo >= 1000 AND geo < 2000 AND code IS NOT NULL""",
    "crosswalk": """SELECT nuts, geo FROM known_pairs
      UNION SELECT p.nuts, p.geo FROM postal_pairs p WHERE p.nuts IN (SELECT nuts FROM mob_region)
      AND NOT EXISTS (SELECT 1 FROM known_pairs k WHERE k.nuts = p.nuts)""",
}

NEEDS: dict[str, tuple[str, ...]] = {
    "fact": ("places",),
    "counted": ("fact",),
    "days": ("fact",),
    "grid": ("fact", "days"),
    "reg": ("places", "people"),
    "panel": ("grid", "counted"),
    "peopled": ("panel", "reg"),
    "peopled_totals": ("peopled",),
    "peopled_frames": ("peopled",),
    "ld": ("ships",),
    "dose": ("ld",),
    "dosed": ("dose",),
    "unplaced": ("dose",),
    "shares": ("dosed", "reg"),
    "allocated": ("shares",),
    "counts": ("peopled", "dosed", "allocated"),
    "with_city": ("counts",),
    "region_totals": ("with_city",),
    "region_frames": ("with_city",),
    "by_state": ("counts",),
    "state_totals": ("by_state",),
    "state_frames": ("by_state",),
    "by_country": ("counts", "unplaced"),
    "country_totals": ("by_country",),
    "country_frames": ("by_country",),
    "mob_region": ("ld",),
    "mob_state": ("ld", "reg"),
    "mob_country": ("ld",),
    "icu": ("ld",),
    "icu_region": ("icu",),
    "icu_state": ("icu",),
    "icu_country": ("icu",),
    "level_people": ("reg",),
    "hospital": ("ld",),
    "hosp": ("hospital", "level_people"),
    "postal_nuts": ("ships",),
    "postal_keys": ("ships",),
    "postal_pairs": ("postal_nuts", "postal_keys"),
    "known_pairs": ("reg", "postal_pairs"),
    "crosswalk": ("known_pairs", "postal_pairs", "mob_region"),
}


def with_parts(select: str, *names: str) -> str:
    """``select`` behind the named parts and all they need."""
    wanted: set[str] = set()

    def add(name: str) -> None:
        if name not in wanted:
            wanted.add(name)
            for needed in NEEDS.get(name, ()):
                add(needed)

    for name in names:
        add(name)
    parts = ",\n".join(f"{name} AS MATERIALIZED ({PARTS[name]})" for name in PARTS if name in wanted)
    return f"WITH {parts}\n{select}" if parts else select


def columns_of(part: str, columns: str) -> str:
    return with_parts(f"SELECT {columns} FROM {part}", part)
