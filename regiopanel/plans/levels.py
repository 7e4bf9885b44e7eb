"""The three indicator tables from feeds under canonical names."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regiopanel.functions import round_ratio
from regiopanel.operators.allocate import allocate_proportional
from regiopanel.operators.doses import add_unknown_place_doses, doses_by_status, known_places, unknown_places
from regiopanel.operators.enrich import (
    ICU,
    ICU_SUMS,
    MOBILITY,
    enrich,
    hospital_incidence,
    icu_occupancy,
    merge_feeds,
    mobility_by_region,
    with_suffix,
)
from regiopanel.operators.indicators import DOSE_LEVELS, dose_column, indicators
from regiopanel.operators.rollup import (
    COUNTRY,
    attach_attributes,
    population_by_level,
    rollup_country,
    rollup_levels,
    rollup_state,
    state_of,
)
from regiopanel.operators.spine import Bound, dense_panel, panel_days, present, stack_facts


@dataclass(frozen=True)
class City:
    """A region published once as a whole and once by district.

    Districts have keys ``lo <= key < hi``; the whole has ``key`` and the labels.
    """

    key: int
    lo: int
    hi: int
    name: str
    kind: str

    def contains(self, geo: str = "geo") -> Column:
        return (F.col(geo) >= self.lo) & (F.col(geo) < self.hi)

    def districts(self, regions: DataFrame) -> DataFrame:
        """The city's districts as members of a parent.

        The parent key depends on the row: joins on a plain literal would lose their key.
        """
        parent = F.when(self.contains(), self.key).alias("parent")
        return regions.select(parent, "geo", "population").filter(self.is_district())

    def is_district(self, geo: str = "geo") -> Column:
        return self.contains(geo) & (F.col(geo) != self.key)

    def with_whole(self, facts: DataFrame) -> DataFrame:
        """The facts of districts once more under the key of the whole, before anything is summed."""
        both = F.when(self.is_district(), F.array("geo", F.lit(self.key).cast(facts.schema["geo"].dataType)))
        rest = [c for c in facts.columns if c != "geo"]
        return facts.select(F.explode(F.coalesce(both, F.array("geo"))).alias("geo"), *rest)

    def attributes(self, regions: DataFrame) -> DataFrame:
        """The regions with one row for the whole; its population is that of all districts."""
        own = {
            "geo": F.lit(self.key).cast(regions.schema["geo"].dataType),
            "name": F.lit(self.name),
            "kind": F.lit(self.kind),
            "population": F.sum("population"),
        }
        whole = regions.filter(self.is_district()).agg(*[own.get(c, F.max(c)).alias(c) for c in regions.columns])
        return regions.filter(F.col("geo") != self.key).unionByName(whole)


# The one city whose districts report cases while doses are published
# for the whole.
BERLIN = City(key=11000, lo=11000, hi=12000, name="Berlin", kind="Kreisfreie Stadt")


@dataclass(frozen=True)
class Options:
    """Choices of a run.

    ``strict`` refuses feeds whose codes do not all lead to a region; ``several_codes`` says what becomes of a
    region that matches several codes: ``refuse`` stops the run, ``weighted`` takes the one it shares most
    postal codes with.  ``age_groups`` are the hospital age rows to sum, all of them by default.
    """

    start: Bound | None = None
    end: Bound | None = None
    dose_levels: Sequence[int] = DOSE_LEVELS
    mask: bool = True
    missing: float | None = None
    fill: float | None = None
    subtotal: bool = True
    strict: bool = True
    several_codes: str = "refuse"
    age_groups: Sequence[str] | None = None
    city: City = field(default=BERLIN)


def measures_of(options: Options) -> list[str]:
    return ["cases", "deaths", *[dose_column(i) for i in options.dose_levels]]


def placed_doses(doses: DataFrame, options: Options = Options()) -> DataFrame:
    """Doses per region, day and status.

    Read several times by ``region_counts``, so worth storing when the feed is large.
    """
    return doses_by_status(known_places(doses), ("geo", "day"), levels=options.dose_levels)


def region_facts(
    cases: DataFrame, placed: DataFrame, regions: DataFrame, options: Options = Options()
) -> DataFrame:
    """Cases and doses by region and day as they enter the panel, still in many rows.

    Doses of the whole city are shared out over its districts by population.  ``is_primary`` marks what
    makes a region part of the panel: its cases, or a share in the city's doses, which would be lost.
    """
    city = options.city
    amounts = [dose_column(i) for i in options.dose_levels]
    whole = placed.filter(F.col("geo") == city.key).withColumnRenamed("geo", "parent")
    shared = allocate_proportional(whole, city.districts(regions), amounts).select("geo", "day", *amounts)
    facts = stack_facts(
        cases.select("geo", "day", "cases", "deaths"), placed.filter(F.col("geo") != city.key), anchor="is_primary"
    )
    shared = present(shared, "geo", "day").withColumn("is_primary", F.lit(True))
    return facts.unionByName(shared, allowMissingColumns=True)


def panel_places(
    cases: DataFrame, placed: DataFrame, regions: DataFrame, options: Options = Options()
) -> DataFrame:
    """Keys under which doses reach the panel: its regions, and the whole city if there are districts to share over."""
    own = present(region_facts(cases, placed, regions, options).filter("is_primary"), "geo", "day").select("geo")
    whole = options.city.districts(regions).select(F.lit(options.city.key).cast("int").alias("geo"))
    return own.unionByName(whole).distinct()


def region_counts(
    cases: DataFrame,
    placed: DataFrame,
    regions: DataFrame,
    options: Options = Options(),
    days_of: DataFrame | None = None,
) -> DataFrame:
    """Dense region panel of cases, deaths and doses with the region's attributes.

    Cases and doses (``placed_doses``) are stacked and summed in one aggregation.  With ``subtotal`` the
    city's districts are also summed under the city's key, in the same aggregation; ``is_subtotal`` marks these
    rows, which every roll-up excludes.  Cases must not be reported under that key as well.
    """
    city = options.city
    facts = region_facts(cases, placed, regions, options)
    if days_of is None:
        days_of = facts.filter("is_primary")
    if options.subtotal:
        facts, regions = city.with_whole(facts), city.attributes(regions)
    panel = dense_panel(
        facts, measures_of(options), start=options.start, end=options.end, anchor="is_primary", days_of=days_of
    )
    # the state follows from the key, also where a region has no attributes
    panel = attach_attributes(panel, regions.drop("nuts", "vintage")).withColumn("state", state_of("geo"))
    return panel.withColumn("is_subtotal", (F.col("geo") == city.key) & F.lit(options.subtotal))


def region_level(
    counts: DataFrame,
    crosswalk: DataFrame,
    mobility: DataFrame,
    icu: DataFrame,
    hospital: DataFrame,
    regions: DataFrame,
    options: Options = Options(),
) -> DataFrame:
    """Region panel with indicators and all enrichments.

    ``icu`` carries the region key and its state; ``counts`` comes from ``region_counts``.
    """
    fill = options.fill
    table = _indicators(counts, options)
    region_feeds = merge_feeds(
        ("geo", "day"), mobility_by_region(mobility, crosswalk), icu_occupancy(icu, ("geo", "day"))
    )
    state_feeds = merge_feeds(
        ("state", "day"),
        with_suffix(icu_occupancy(icu, ("state", "day")), ICU),
        _hospital_by_state(hospital, regions, options),
    )
    table = enrich(table, region_feeds, ("geo", "day"), [*MOBILITY, *ICU], fill)
    parents = [c + "_parent" for c in ICU]
    return enrich(table, state_feeds, ("state", "day"), [*parents, "hospital_incidence"], fill)


def _hospital_by_state(hospital: DataFrame, regions: DataFrame, options: Options) -> DataFrame:
    by_level = hospital_incidence(hospital, population_by_level(regions), age_groups=options.age_groups)
    return by_level.withColumnRenamed("level_id", "state")


def upper_counts(
    counts: DataFrame,
    doses: DataFrame,
    regions: DataFrame,
    options: Options = Options(),
    days_of: DataFrame | None = None,
) -> DataFrame:
    """Sums of the region panel by state and, under key 0, for the country, from one pass over it.

    ``level`` tells them apart, ``geo`` is the key.  Doses without a region join the pass as rows of no
    state, so that they count for the country only.
    """
    measures = measures_of(options)
    lo, hi = panel_days(options.start, options.end, counts if days_of is None else days_of)
    unknown = doses_by_status(unknown_places(doses), ("day",), levels=options.dose_levels)
    unknown = unknown.filter(F.col("day").between(lo, hi))
    # Their days are those of the panel, so each meets rows of it.
    detail = counts.filter(~F.col("is_subtotal")).select("state", "day", *measures, "population")
    rolled = rollup_levels(detail.unionByName(unknown, allowMissingColumns=True), [*measures, "population"])
    rolled = rolled.filter((F.col("level") == "country") | F.col("state").isNotNull())
    names = present(regions.select("state", "state_name"), "state").distinct()
    rolled = rolled.join(names, "state", "left").withColumn("geo", F.coalesce("state", F.lit(COUNTRY)).cast("int"))
    return rolled.select("level", "geo", "state", "state_name", "day", *measures, "population")


def _indicators(counts: DataFrame, options: Options, geo: str = "geo") -> DataFrame:
    return indicators(counts, geo=geo, dose_levels=options.dose_levels, mask=options.mask, missing=options.missing)


def state_table(
    rolled: DataFrame,
    mobility: DataFrame,
    icu: DataFrame,
    hospital: DataFrame,
    regions: DataFrame,
    options: Options = Options(),
) -> DataFrame:
    """State panel from the sums by state; mobility is joined by name."""
    table = _indicators(rolled, options, "state")
    state_feeds = merge_feeds(
        ("state", "day"), icu_occupancy(icu, ("state", "day")), _hospital_by_state(hospital, regions, options)
    )
    table = enrich(table, mobility, ("state_name", "day"), MOBILITY, options.fill)
    return enrich(table, state_feeds, ("state", "day"), [*ICU, "hospital_incidence"], options.fill)


def country_table(
    rolled: DataFrame,
    mobility: DataFrame,
    icu: DataFrame,
    hospital: DataFrame,
    regions: DataFrame,
    options: Options = Options(),
) -> DataFrame:
    """Country panel from the sums by day."""
    table = _indicators(rolled, options)
    overall = hospital.filter(F.col("level_id") == COUNTRY)
    overall = hospital_incidence(overall, population_by_level(regions), age_groups=options.age_groups)
    feeds = merge_feeds(("day",), mobility, icu_occupancy(icu, ("day",)), overall.drop("level_id"))
    return enrich(table, feeds, ("day",), [*MOBILITY, *ICU, "hospital_incidence"], options.fill)


def state_level(
    counts: DataFrame,
    mobility: DataFrame,
    icu: DataFrame,
    hospital: DataFrame,
    regions: DataFrame,
    options: Options = Options(),
) -> DataFrame:
    """State panel straight from the region panel, all indicators recomputed on the sums."""
    rolled = rollup_state(counts, [*measures_of(options), "population"], regions)
    return state_table(rolled, mobility, icu, hospital, regions, options)


def country_level(
    counts: DataFrame,
    doses: DataFrame,
    mobility: DataFrame,
    icu: DataFrame,
    hospital: DataFrame,
    regions: DataFrame,
    options: Options = Options(),
) -> DataFrame:
    """Country panel straight from the region panel; doses without a region count here only."""
    rolled = rollup_country(counts, [*measures_of(options), "population"])
    unknown = doses_by_status(unknown_places(doses), ("day",), levels=options.dose_levels)
    rolled = add_unknown_place_doses(rolled, unknown, levels=options.dose_levels)
    return country_table(rolled, mobility, icu, hospital, regions, options)


@dataclass(frozen=True)
class LevelFeeds:
    """Feeds of all levels under (level, geo, day); ``states`` are those that regions take from their state."""

    own: DataFrame
    states: DataFrame


def level_feeds(
    crosswalk: DataFrame,
    mobility_region: DataFrame,
    mobility_state: DataFrame,
    mobility_country: DataFrame,
    icu: DataFrame,
    hospital: DataFrame,
    regions: DataFrame,
    options: Options = Options(),
) -> LevelFeeds:
    """Mobility, intensive care and hospital series of the three levels under each other.

    Intensive-care sums of all levels come from one aggregation of the feed.
    """
    names = present(regions.select("state", "state_name"), "state").distinct()
    country = F.lit(COUNTRY).cast("int").alias("geo")
    by_state = mobility_state.join(names, "state_name").select(F.col("state").alias("geo"), "day", *MOBILITY)
    mobility = tall = None
    for level, df in (
        ("region", mobility_by_region(mobility_region, crosswalk).select("geo", "day", *MOBILITY)),
        ("state", by_state),
        ("country", mobility_country.select(country, "day", *MOBILITY)),
    ):
        tall = df.select(F.lit(level).alias("level"), "*")
        mobility = tall if mobility is None else mobility.unionByName(tall)
    occupancy = icu_by_level(icu)
    by_level = hospital_incidence(hospital, population_by_level(regions), age_groups=options.age_groups)
    is_country = F.col("level_id") == COUNTRY
    incidence = by_level.select(
        F.when(is_country, "country").otherwise("state").alias("level"), F.col("level_id").alias("geo"), "day",
        "hospital_incidence",
    )
    keys = ("level", "geo", "day")
    parents = with_suffix(occupancy.filter("level = 'state'"), ICU)
    states = merge_feeds(keys, parents, incidence.filter("level = 'state'")).drop("level")
    return LevelFeeds(merge_feeds(keys, mobility, occupancy, incidence), states.withColumnRenamed("geo", "state"))


def icu_by_level(icu: DataFrame) -> DataFrame:
    """Occupancy by region, state and country from one pass over the feed."""
    geo, state, day = F.col("geo"), F.col("state"), F.col("day")
    sums = icu.groupingSets([[geo, state, day], [state, day], [day]], geo, state, day).agg(
        F.grouping(geo).alias("_no_geo"), F.grouping(state).alias("_no_state"),
        *[F.sum(F.col(c).cast("bigint")).alias(c) for c in ICU_SUMS],
    )
    level = F.when(F.col("_no_geo") == 0, "region").when(F.col("_no_state") == 0, "state").otherwise("country")
    key = F.when(F.col("_no_geo") == 0, geo).when(F.col("_no_state") == 0, state).otherwise(COUNTRY).cast("int")
    share = round_ratio("icu_cases", "beds_free + beds_occupied", 4)
    return sums.select(level.alias("level"), key.alias("geo"), "day", share.alias("icu_share"), "icu_cases", "icu_ventilated")


def all_levels(
    counts: DataFrame, upper: DataFrame, feeds: LevelFeeds, options: Options = Options()
) -> DataFrame:
    """The three tables as one, told apart by ``level``; ``geo`` is the key of each level.

    Regions keep the partitioning of their panel for their windows; the sums of the upper levels are few.
    Feeds of all levels are joined once, and once more what regions take from their state.
    """
    regions = _indicators(counts, options).withColumn("level", F.lit("region"))
    # The country's key is no state's, so one pass of windows serves both.
    above = _indicators(upper, options).withColumn("is_subtotal", F.lit(False))
    table = regions.unionByName(above, allowMissingColumns=True)
    own = [*MOBILITY, *ICU, "hospital_incidence"]
    table = enrich(table, feeds.own, ("level", "geo", "day"), own, None)
    inherited = feeds.states.withColumnRenamed("hospital_incidence", "_of_state").withColumn("level", F.lit("region"))
    parents = [c + "_parent" for c in ICU]
    table = enrich(table, inherited, ("level", "state", "day"), [*parents, "_of_state"], None)
    table = table.withColumn("hospital_incidence", F.coalesce("hospital_incidence", "_of_state")).drop("_of_state")
    if options.fill is None:
        return table
    filled = {c: F.when(F.col("level") == "region", F.coalesce(c, F.lit(options.fill))).otherwise(F.col(c)) for c in parents}
    return table.fillna(options.fill, subset=own).withColumns(filled)


# Published column names, by canonical name.  The first layout is the plain
# one, the second also carries the dose counts and the vintages.
PLAIN_NAMES = {
    "day": "meldedatum",
    "cases": "anzahlfall",
    "deaths": "anzahltodesfall",
    "population": "einwohner",
    "name": "kgs_name",
    "kind": "kgs_art",
    "state_name": "bl_name",
    "cases_cum": "anzahlfall_kum",
    "deaths_cum": "anzahltodesfall_kum",
    "incidence": "inzidenz",
    "r4": "r_wert_4",
    "r7": "r_wert_7",
    "infection_rate": "infektionsrate",
    "lethality_rate": "letalitaetsrate",
    "icu_share": "intensivbetten",
    "icu_cases": "faelle_covid_aktuell",
    "icu_ventilated": "faelle_covid_aktuell_invasiv_beatmet",
    "icu_share_parent": "intensivbetten_bdl",
    "icu_cases_parent": "faelle_covid_aktuell_bdl",
    "icu_ventilated_parent": "faelle_covid_akt_invasiv_beatmet_bdl",
    "hospital_incidence": "hospitalisierung_inzidenz",
}
EXTENDED_NAMES = {
    **PLAIN_NAMES,
    "day": "melde_dat",
    "cases": "anz_fall_neu",
    "deaths": "anz_tote_neu",
    "state_name": "bdl_name",
    "cases_cum": "anz_fall_kum",
    "deaths_cum": "anz_tote_kum",
    "icu_ventilated": "invasiv_beatmet",
    "icu_ventilated_parent": "invasiv_beatmet_bdl",
}
PLAIN_KEYS = {"region": ("geo", "kgs"), "state": ("state", "bl"), "country": ("geo", None)}
EXTENDED_KEYS = {"region": ("geo", "kgs5", 5), "state": ("state", "kgs2", 2), "country": ("geo", "kgs", 2)}
VINTAGES = ("rki_stand", "rki_impf_stand", "rki_mobilitaet_stand", "einwohner_stand")
LABELS = {"region": ("name", "kind"), "state": ("state_name",), "country": ()}
RATES = ("incidence", "r4", "r7", "infection_rate", "lethality_rate")


def _named(table: DataFrame, order: Sequence[str], names: Mapping[str, str], dose_levels: Sequence[int]) -> DataFrame:
    """Columns in the given order under published names."""
    full = dict(names)
    for i in dose_levels:
        full[dose_column(i)] = f"anz_impfung_{i}"
        full[dose_column(i) + "_cum"] = f"anz_impfung_{i}_kum"
        full[f"dose_quota_{i}"] = f"quote_impfung_{i}"
    return table.select(*[F.col(c).alias(full.get(c, c)) for c in order])


def plain_layout(table: DataFrame, level: str, dose_levels: Sequence[int] = DOSE_LEVELS) -> DataFrame:
    """Published columns without dose counts; integer keys, none for the country."""
    key, key_name = PLAIN_KEYS[level]
    quotas = [f"dose_quota_{i}" for i in dose_levels]
    parents = [c + "_parent" for c in ICU] if level == "region" else []
    sums = ["cases", "deaths", "population"]
    order = [
        *(["day", key] if level == "region" else [key, "day"] if key_name else ["day"]),
        *sums,
        *LABELS[level],
        "cases_cum",
        "deaths_cum",
        *RATES,
        *quotas,
        *MOBILITY,
        *ICU,
        *parents,
        "hospital_incidence",
    ]
    names = {**PLAIN_NAMES, **({key: key_name} if key_name else {})}
    return _named(table, order, names, dose_levels)


def extended_layout(table: DataFrame, level: str, dose_levels: Sequence[int] = DOSE_LEVELS) -> DataFrame:
    """Published columns with dose counts, padded text keys and vintages."""
    key, key_name, width = EXTENDED_KEYS[level]
    amounts = [dose_column(i) for i in dose_levels]
    parents = [c + "_parent" for c in ICU] if level == "region" else []
    order = [
        "day",
        key,
        *LABELS[level],
        "population",
        "cases",
        "deaths",
        *amounts,
        "cases_cum",
        "deaths_cum",
        *[a + "_cum" for a in amounts],
        *RATES,
        *[f"dose_quota_{i}" for i in dose_levels],
        *MOBILITY,
        *ICU,
        *parents,
        "hospital_incidence",
        *[v for v in VINTAGES if v in table.columns],
    ]
    padded = table.withColumn(key, F.format_string(f"%0{width}d", F.col(key)))
    return _named(padded, order, {**EXTENDED_NAMES, key: key_name}, dose_levels)
