"""Layouts of the ten feeds: file, columns by name, types and canonical names."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, replace


@dataclass(frozen=True)
class Feed:
    """One delimited feed.

    ``columns`` maps a (lower-case) header name to its canonical name and kind; kinds
    are ``string``, ``int``, ``bigint``, ``double``, ``day`` (year first) and
    ``german_day``.
    """

    path: str
    columns: Mapping[str, tuple[str, str]]
    sep: str = ","
    quote: str = '"'
    member: str | None = None
    aliases: Mapping[str, str] = field(default_factory=dict)

    def below(self, folder: str) -> Feed:
        return replace(self, path=f"{folder.rstrip('/')}/{self.path}")


_MOBILITY = {
    "date": ("day", "day"),
    "mobility_change": ("mobility_change", "double"),
    "mobility_change_7day_average": ("mobility_change_7day_average", "double"),
    "mobility_change_weekly": ("mobility_change_weekly", "double"),
}

# File and column names of the published feeds.
FEEDS: dict[str, Feed] = {
    "cases": Feed(
        "rki_covid19.csv",
        {
            "idlandkreis": ("geo", "int"),
            "meldedatum": ("day", "day"),
            "refdatum": ("reference_day", "day"),
            "anzahlfall": ("cases", "bigint"),
            "anzahltodesfall": ("deaths", "bigint"),
            "datenstand": ("vintage", "german_day"),
        },
    ),
    "regions": Feed(
        "RKI_Corona_Landkreise.csv",
        {
            "rs": ("geo", "int"),
            "ewz": ("population", "bigint"),
            "gen": ("name", "string"),
            "bez": ("kind", "string"),
            "bl_id": ("state", "int"),
            "bl": ("state_name", "string"),
            "nuts": ("nuts", "string"),
            "last_update": ("vintage", "german_day"),
        },
    ),
    "doses": Feed(
        "Aktuell_Deutschland_Landkreise_COVID-19-Impfungen.csv",
        {
            "impfdatum": ("day", "day"),
            "landkreisid_impfort": ("place", "string"),
            "altersgruppe": ("age_group", "string"),
            "impfschutz": ("status", "int"),
            "anzahl": ("doses", "bigint"),
        },
    ),
    "mobility_region": Feed("mobility_change_kreise.csv", {"nuts3": ("nuts", "string"), **_MOBILITY}),
    "mobility_state": Feed("mobility_change_bundeslaender.csv", {"name": ("state_name", "string"), **_MOBILITY}),
    "mobility_country": Feed("mobility_change_germany.csv", dict(_MOBILITY)),
    "postal_nuts": Feed(
        "pc2020_DE_NUTS-2021_v3.0.zip",
        {"nuts3": ("nuts3", "string"), "code": ("code", "int")},
        sep=";",
        quote="'",
        member="pc2020_DE_NUTS-2021_v3.0.csv",
    ),
    "postal_keys": Feed(
        "zuordnung_plz_ort_landkreis.csv", {"plz": ("plz", "int"), "ags": ("ags", "bigint")}
    ),
    "icu": Feed(
        "zeitreihe-tagesdaten.csv",
        {
            "date": ("day", "day"),
            "gemeindeschluessel": ("geo", "int"),
            "faelle_covid_aktuell": ("icu_cases", "bigint"),
            "faelle_covid_aktuell_invasiv_beatmet": ("icu_ventilated", "bigint"),
            "betten_frei": ("beds_free", "bigint"),
            "betten_belegt": ("beds_occupied", "bigint"),
        },
        aliases={"faelle_covid_aktuell_invasiv_bea": "faelle_covid_aktuell_invasiv_beatmet"},
    ),
    "hospital": Feed(
        "Aktuell_Deutschland_COVID-19-Hospitalisierungen.csv",
        {
            "datum": ("day", "day"),
            "bundesland": ("state_name", "string"),
            "bundesland_id": ("level_id", "int"),
            "altersgruppe": ("age_group", "string"),
            "7t_hospitalisierung_faelle": ("hospital_cases", "bigint"),
        },
    ),
}


def catalog(folder: str, overrides: Mapping[str, Feed] | None = None) -> dict[str, Feed]:
    """The feeds below one folder; ``overrides`` replaces single entries as they are."""
    return {**{name: feed.below(folder) for name, feed in FEEDS.items()}, **(overrides or {})}
