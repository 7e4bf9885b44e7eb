import zipfile
from dataclasses import replace
from datetime import date, timedelta

import pytest

from helpers import rows
from regiopanel.operators.quality import DataCheckError
from regiopanel.plans.levels import Options, extended_layout, plain_layout
from regiopanel.plans.pipeline import OUTPUTS, Pipeline, StaleError
from regiopanel.sinks.exports import read_ordered
from regiopanel.sources.feeds import catalog

START = date(2021, 12, 1)
DAYS = [START + timedelta(days=i) for i in range(18)]
REGIONS = [(1001, 90_000, "Flensburg", 1, "Schleswig-Holstein", "DEF01"), (11001, 300, "Mitte", 11, "Berlin", ""),
           (11002, 300, "Kreuzberg", 11, "Berlin", ""), (11003, 300, "Pankow", 11, "Berlin", "")]
MOBILITY = "mobility_change,mobility_change_7day_average,mobility_change_weekly"


def write_feeds(folder):
    def put(name, header, lines):
        (folder / name).write_text("\n".join([header, *lines]) + "\n", encoding="utf-8")

    put(
        "rki_covid19.csv", "IdLandkreis,Geschlecht,AnzahlFall,AnzahlTodesfall,Meldedatum,Refdatum,Datenstand",
        [f'{g[0]},M,{i + 1},{int(i == 9)},{d:%Y/%m/%d} 00:00:00+00,{d:%Y/%m/%d} 00:00:00+00,"18.12.2021, 00:00 Uhr"'
         for g in REGIONS for i, d in enumerate(DAYS) if not (g[0] == 1001 and i == 4)],
    )
    put(
        "RKI_Corona_Landkreise.csv", "RS,GEN,BEZ,EWZ,BL_ID,BL,NUTS,last_update",
        [f'{g},{name},Kreis,{ewz},{bl},{state},{nuts},"18.12.2021, 00:00 Uhr"' for g, ewz, name, bl, state, nuts in REGIONS],
    )
    put(
        "Aktuell_Deutschland_Landkreise_COVID-19-Impfungen.csv", "Impfdatum,LandkreisId_Impfort,Altersgruppe,Impfschutz,Anzahl",
        ["2021-12-02,11000,12-17,1,10", "2021-12-02,u,12-17,1,5", "2021-12-02,u,12-17,2,7", "2021-12-03,01001,60+,3,90"],
    )
    put("mobility_change_kreise.csv", "nuts3,date," + MOBILITY, [f"{n},2021-12-02,-0.25,1.5,0" for n in ("DEF01", "DE300")])
    put("mobility_change_bundeslaender.csv", "name,date," + MOBILITY, ["Berlin,2021-12-02,-0.5,1.5,0"])
    put("mobility_change_germany.csv", "date," + MOBILITY, ["2021-12-02,0.125,1.5,0"])
    put("zuordnung_plz_ort_landkreis.csv", "osm_id,ags,ort,plz", ["1,11000000,Berlin,10115", "1,11000000,Berlin,10117"])
    put(
        "zeitreihe-tagesdaten.csv",
        "date,bundesland,gemeindeschluessel,faelle_covid_aktuell,faelle_covid_aktuell_invasiv_beatmet,betten_frei,betten_belegt",
        ["2021-12-02,1,1001,1,1,1,2", "2021-12-02,11,11000,3,0,2,10"],
    )
    put(
        "Aktuell_Deutschland_COVID-19-Hospitalisierungen.csv",
        "Datum,Bundesland,Bundesland_Id,Altersgruppe,7T_Hospitalisierung_Faelle",
        ["2021-12-02,Berlin,11,00-04,1", "2021-12-02,Berlin,11,05-14,2", "2021-12-02,Bundesgebiet,0,00-04,3"],
    )
    with zipfile.ZipFile(folder / "pc2020_DE_NUTS-2021_v3.0.zip", "w") as archive:
        archive.writestr("pc2020_DE_NUTS-2021_v3.0.csv", "NUTS3;CODE\n'DE300';'10115'\n'DE300';'10117'\n")


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("feeds")
    write_feeds(folder)
    pipeline = Pipeline(spark, catalog(str(folder)), str(tmp_path_factory.mktemp("tables")), Options(start=START))
    return pipeline, pipeline.run()


def test_levels_have_their_rows(run):
    _, tables = run
    assert {k: t.count() for k, t in tables.items()} == {"region": 5 * 18, "state": 2 * 18, "country": 18}


def test_region_values(run):
    table = run[1]["region"]
    second = {r.geo: r for r in table.filter("day = '2021-12-02'").collect()}
    assert [second[g].doses_1 for g in (11001, 11002, 11003, 11000)] == [3, 3, 4, 10]
    assert second[11000].cases == 6 and second[11000].population == 900 and second[11000].is_subtotal
    assert second[11000].icu_share == 0.25 and second[11001].icu_share is None
    assert second[11001].icu_share_parent == 0.25 and second[1001].icu_share_parent == 0.3333
    assert {second[g].mobility_change for g in second} == {-0.25}
    assert second[11001].hospital_incidence == 333.3333 and second[1001].hospital_incidence is None
    last = {r.geo: r for r in table.filter("day = '2021-12-18'").collect()}
    assert last[1001].cases_cum == 171 - 5 and last[1001].incidence == 116.7
    assert last[1001].dose_quota_3 == 0.001 and last[1001].doses_3_cum == 90
    assert str(last[1001].rki_impf_stand) == "2021-12-03" and str(last[1001].einwohner_stand) == "2021-12-18"


def test_upper_levels_recompute_on_sums(run):
    state = {r.day: r for r in run[1]["state"].filter("state = 11").collect()}
    assert state[DAYS[1]].doses_1 == 10 and state[DAYS[1]].mobility_change == -0.5
    assert state[DAYS[17]].cases_cum == 3 * 171 and state[DAYS[17]].state_name == "Berlin"
    country = {r.day: r for r in run[1]["country"].collect()}
    assert (country[DAYS[1]].doses_1, country[DAYS[1]].doses_2) == (15, 7)
    assert country[DAYS[1]].population == 90_900 and country[DAYS[1]].icu_share == 0.2667
    assert country[DAYS[1]].hospital_incidence == 3.3003
    assert str(country[DAYS[0]].rki_stand) == "2021-12-18"


def test_reports_are_stored(run):
    pipeline, _ = run
    profiles = {r.feed: r for r in pipeline.table("profiles").collect()}
    assert profiles["cases"].n_keys == 4 and profiles["cases"].n_days == profiles["cases"].expected_days == 18
    assert profiles["doses"].n_rows == 4 and set(profiles) == {"cases", "doses", "mobility_region", "icu", "hospital"}
    assert pipeline.table("facts_outside_spine").count() == 0
    assert pipeline.table("codes_without_region").count() == 0


def exported(spark, path):
    """What an export's parts hold, put together in the order of their lines."""
    lines = [r.line for r in sorted(read_ordered(spark, path).collect())]
    return spark.createDataFrame([x.split(";") for x in lines[1:]], lines[0].split(";"))


def test_exports(run, spark):
    pipeline, _ = run
    plain = exported(spark, f"{pipeline.folder}/plain/{OUTPUTS['region']}.csv")
    keys = [(int(r.kgs), r.meldedatum) for r in plain.collect()]
    assert len(keys) == 90 and keys == sorted(keys)
    assert plain.columns[:5] == ["meldedatum", "kgs", "anzahlfall", "anzahltodesfall", "einwohner"]
    assert plain.columns[-4:-1] == ["intensivbetten_bdl", "faelle_covid_aktuell_bdl", "faelle_covid_akt_invasiv_beatmet_bdl"]
    row = plain.filter("kgs = '1001' and meldedatum = '2021-12-18'").collect()[0]
    assert row.inzidenz == "116,7" and row.quote_impfung_3 == "0,001"
    extended = exported(spark, f"{pipeline.folder}/extended/{OUTPUTS['region']}.csv")
    row = extended.filter("kgs5 = '01001' and melde_dat = '18.12.2021'").collect()[0]
    assert row.infektionsrate == "0.18%" and row.rki_impf_stand == "03.12.2021" and row.anz_impfung_3_kum == "90"
    state = exported(spark, f"{pipeline.folder}/extended/{OUTPUTS['state']}.csv")
    country = exported(spark, f"{pipeline.folder}/extended/{OUTPUTS['country']}.csv").collect()
    assert [r.melde_dat for r in country] == [f"{d:%d.%m.%Y}" for d in DAYS]
    assert "kgs2" in state.columns and rows(state.select("kgs2").distinct()) == [("01",), ("11",)]


def test_layout_columns(run):
    _, tables = run
    assert "anz_impfung_1" not in plain_layout(tables["country"], "country").columns
    assert plain_layout(tables["country"], "country").columns[0] == "meldedatum"
    assert plain_layout(tables["state"], "state").columns[:2] == ["bl", "meldedatum"]
    assert extended_layout(tables["country"], "country").columns[:2] == ["melde_dat", "kgs"]


def test_stages_run_alone(run):
    pipeline, tables = run
    before = rows(tables["state"])
    again = pipeline.run(["state"])
    assert list(again) == ["state"] and rows(again["state"]) == before
    with pytest.raises(ValueError):
        pipeline.run(["nothing"])


def test_bad_feeds_are_refused(spark, tmp_path):
    write_feeds(tmp_path)
    path = tmp_path / "Aktuell_Deutschland_Landkreise_COVID-19-Impfungen.csv"
    path.write_text(path.read_text() + "2021-12-03,01001,60+,7,1\n")
    with pytest.raises(DataCheckError, match="levels"):
        Pipeline(spark, catalog(str(tmp_path)), str(tmp_path / "out")).run(["read"])


def append(folder, name, *lines):
    path = folder / name
    path.write_text(path.read_text() + "".join(line + "\n" for line in lines))


DOSES = "Aktuell_Deutschland_Landkreise_COVID-19-Impfungen.csv"
FACTS = '17000,M,50,0,2021/12/05 00:00:00+00,2021/12/05 00:00:00+00,"18.12.2021, 00:00 Uhr"'


def test_what_is_left_out_is_reported(spark, tmp_path):
    write_feeds(tmp_path)
    append(
        tmp_path, DOSES, "2021-12-03,,60+,1,40", "2021-12-03,x1,60+,1,3", "2021-12-03,17001,60+,1,30",
        "2021-12-30,1001,60+,1,20", "2021-12-30,u,60+,1,2", "02.12.2021,1001,60+,1,100",
    )
    append(tmp_path, "rki_covid19.csv", FACTS.replace("2021/12/05", "05.12.2021", 1), FACTS.replace("17000", ""))
    options = Options(start=START, strict=False)
    pipeline = Pipeline(spark, catalog(str(tmp_path)), str(tmp_path / "out"), options)
    tables = pipeline.run(["read", "region", "state", "country"])
    assert sorted(rows(pipeline.table("left_out")), key=lambda r: tuple(map(str, r))) == sorted([
        ("cases", "no day", 1, 50), ("cases", "no place", 1, 50), ("doses", "no day", 1, 100), ("doses", "no place", 1, 40),
        ("doses", "unreadable place", 1, 3), ("doses", "unlisted place", 1, 30), ("doses", "outside the days", 2, 22),
        ("deaths", "no day", 1, 0), ("deaths", "no place", 1, 0), ("doses", "no known place", 2, 12),
    ], key=lambda r: tuple(map(str, r)))
    assert rows(pipeline.table("field_errors")) == [("cases", 1, 1), ("doses", 1, 1)]
    # what was read is what the tables hold and what was left out
    held = tables["country"].agg({"cases": "sum"}).first()[0]
    held_doses = tables["country"].selectExpr("sum(doses_1 + doses_2 + doses_3)").first()[0]
    account = {(r.level, r.feed): r for level in tables for r in pipeline.table(f"ledger_{level}").collect()}
    assert all(r.difference == 0 for r in account.values()) and len(account) == 9
    assert account["country", "cases"].in_table == held and account["country", "doses"].in_table == held_doses
    assert account["country", "doses"].n_read == 112 + 195 and account["country", "doses"].left_out == 195
    assert account["region", "doses"].left_out == 195 + 12
    strict = replace(options, strict=True)
    with pytest.raises(DataCheckError, match="unreadable"):
        Pipeline(spark, catalog(str(tmp_path)), str(tmp_path / "strict"), strict).run(["read"])


def test_state_follows_from_the_key(spark, tmp_path):
    write_feeds(tmp_path)
    append(tmp_path, "rki_covid19.csv", FACTS.replace("17000", "1002"))
    pipeline = Pipeline(spark, catalog(str(tmp_path)), str(tmp_path / "out"), Options(start=START))
    tables = pipeline.run(["read", "region", "state"])
    assert rows(tables["state"].select("state", "state_name").distinct()) == [(1, "Schleswig-Holstein"), (11, "Berlin")]
    day = tables["state"].filter("state = 1 and day = '2021-12-05'").collect()
    assert [r.cases for r in day] == [50]


def test_repeated_feed_rows_are_refused(spark, tmp_path):
    write_feeds(tmp_path)
    append(tmp_path, "mobility_change_bundeslaender.csv", "Berlin,2021-12-02,-0.5,1.5,0")
    pipeline = Pipeline(spark, catalog(str(tmp_path)), str(tmp_path / "out"))
    with pytest.raises(DataCheckError, match="repeated"):
        pipeline.run(["read"])
    assert rows(pipeline.table("repeated_keys")) == [("mobility_state", "Berlin 2021-12-02", 2)]


def test_days_before_the_first_case_count(spark, tmp_path):
    """The panel and the report of what it leaves out go by the same bounds."""
    write_feeds(tmp_path)
    append(tmp_path, DOSES, "2021-11-28,1001,60+,1,9", "2021-11-20,1001,60+,1,70", "2021-12-30,1001,60+,2,4")
    for name, (start, end, inside) in {
        "early": (date(2021, 11, 25), date(2021, 12, 31), 9 + 4), "late": (date(2021, 12, 3), None, 0),
        "open": (None, None, 0),
    }.items():
        options = Options(start=start, end=end)
        pipeline = Pipeline(spark, catalog(str(tmp_path)), str(tmp_path / name), options)
        table = pipeline.run(["read", "region", "state", "country"])["country"]
        held = table.selectExpr("sum(doses_1 + doses_2 + doses_3)").first()[0]
        base = 112 if name != "late" else 90
        assert held == base + inside
        assert all(r.difference == 0 for l in ("region", "state", "country") for r in pipeline.table(f"ledger_{l}").collect())
        first = table.agg({"day": "min"}).first()[0]
        assert first == (start or DAYS[0])


def test_shares_of_a_district_without_cases_are_kept(spark, tmp_path):
    write_feeds(tmp_path)
    path = tmp_path / "rki_covid19.csv"
    path.write_text("".join(x for x in path.read_text().splitlines(True) if not x.startswith("11003,")))
    pipeline = Pipeline(spark, catalog(str(tmp_path)), str(tmp_path / "out"), Options(start=START))
    tables = pipeline.run(["read", "region", "state", "country"])
    second = {r.geo: r for r in tables["region"].filter("day = '2021-12-02'").collect()}
    assert [second[g].doses_1 for g in (11001, 11002, 11003, 11000)] == [3, 3, 4, 10] and second[11003].cases == 0
    assert {r.difference for r in pipeline.table("ledger_region").collect()} == {0}


def test_cases_under_the_key_of_the_whole_city_are_refused(spark, tmp_path):
    write_feeds(tmp_path)
    append(tmp_path, "rki_covid19.csv", FACTS.replace("17000", "11000"))
    with pytest.raises(DataCheckError, match="whole city"):
        Pipeline(spark, catalog(str(tmp_path)), str(tmp_path / "out"), Options(strict=False)).run(["read"])


def test_unchanged_stages_are_skipped_and_stale_ones_refused(spark, tmp_path):
    write_feeds(tmp_path)
    feeds, folder = catalog(str(tmp_path)), str(tmp_path / "out")
    pipeline = Pipeline(spark, feeds, folder, Options(start=START))
    pipeline.run(["read", "region", "state"])
    before = {n: pipeline.version(n) for n in ("cases", OUTPUTS["region"], OUTPUTS["state"])}
    again = Pipeline(spark, feeds, folder, Options(start=START))
    again.run(["read", "region", "state"])
    assert {n: again.version(n) for n in before} == before
    # other options: what was stored doesn't belong to them
    with pytest.raises(StaleError, match="read"):
        Pipeline(spark, feeds, folder, Options(start=START, mask=False)).run(["state"])
    append(tmp_path, "rki_covid19.csv", FACTS.replace("17000", "1001"))
    with pytest.raises(StaleError):
        again.run(["country"])
    again.run(["read", "region", "country"])
    assert again.version("cases") != before["cases"] and not again.is_current("state")
    # a table replaced by hand is not what the stage made
    again.store("upper_counts", again.table("upper_counts"))
    assert not again.is_current("region")


def test_the_null_profile_is_stored(run):
    pipeline, _ = run
    assert ("regions", "nuts", 3) in rows(pipeline.table("nulls"))
