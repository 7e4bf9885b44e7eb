import zipfile

import pytest
from pyspark.sql import functions as F

from helpers import day, rows
from regiopanel.session import fresh_path, shared_folder, stored
from regiopanel.sinks.exports import export_levels, formatted, read_ordered, write_ordered
from regiopanel.sinks.tables import Buckets, replace_table, scan_table
from regiopanel.sources.archives import read_zip_member
from regiopanel.sources.feeds import FEEDS, Feed, catalog
from regiopanel.sources.readers import read_declared, read_feed

DOSES = {
    "impfdatum": ("day", "day"),
    "landkreisid_impfort": ("place", "string"),
    "altersgruppe": ("age_group", "string"),
    "impfschutz": ("status", "int"),
    "anzahl": ("doses", "bigint"),
}


def test_declared_layout_counts_unreadable_fields_only(spark, tmp_path):
    (tmp_path / "doses.csv").write_text(
        "Impfdatum,LandkreisId_Impfort,Altersgruppe,Impfschutz,Anzahl\n"
        "2020-01-01,01001,12-17,1,5\n"
        '2020-01-02,u,"18,59",2,7\n'
        "2020-01-03,01002,60+,1\n"
        "2020-13-41,01003,60+,3,1\n",
        encoding="utf-8",
    )
    out = read_declared(spark, str(tmp_path / "doses.csv"), DOSES)
    assert rows(out.agg(F.sum("n_errors"))) == [(1,)]
    assert rows(out, "place", "age_group", "doses", "n_errors") == [
        ("01001", "12-17", 5, 0), ("01002", "60+", None, 0), ("01003", "60+", 1, 1), ("u", "18,59", 7, 0),
    ]


def test_feed_columns_are_found_by_name(spark, tmp_path):
    (tmp_path / "rki_covid19.csv").write_text(
        "ObjectId,Altersgruppe,IdLandkreis,Refdatum,Meldedatum,AnzahlTodesfall,AnzahlFall,Datenstand\n"
        '1,A00-A04,1001,2020/01/01 00:00:00+00,2020/01/02 00:00:00+00,0,3,"18.12.2021, 00:00 Uhr"\n',
        encoding="utf-8",
    )
    feed = catalog(str(tmp_path))["cases"]
    out = read_feed(spark, feed)
    assert out.columns == [name for name, _ in FEEDS["cases"].columns.values()]
    assert rows(out, "geo", "day", "reference_day", "cases", "deaths") == [(1001, day(2), day(1), 3, 0)]
    with pytest.raises(ValueError, match="absent_one"):
        read_feed(spark, Feed(feed.path, {"absent_one": ("x", "int")}))


def test_shortened_column_name_is_accepted(spark, tmp_path):
    (tmp_path / "zeitreihe-tagesdaten.csv").write_text(
        "date,gemeindeschluessel,bundesland,faelle_covid_aktuell,faelle_covid_aktuell_invasiv_bea,betten_frei,betten_belegt\n"
        "2020-01-01,1001,1,2,1,3,4.0\n"
    )
    out = read_feed(spark, catalog(str(tmp_path))["icu"])
    assert rows(out, "icu_ventilated", "beds_occupied") == [(1, 4)]


def test_zip_members_over_several_archives(spark, tmp_path):
    for i in range(3):
        with zipfile.ZipFile(tmp_path / f"a{i}.zip", "w") as archive:
            archive.writestr("codes.csv", f"NUTS3;CODE;REST\n'DE{i};0';1000{i};\n'DEX';2000{i};z\n")
            archive.writestr("other.csv", "x\n1\n")
    out = read_zip_member(spark, str(tmp_path / "*.zip"), "codes.csv", ["nuts3", "code", "rest"], ";", "'")
    assert rows(out, "code", "nuts3", "rest") == sorted(
        [(f"1000{i}", f"DE{i};0", None) for i in range(3)] + [(f"2000{i}", "DEX", "z") for i in range(3)]
    )


def test_formats(spark):
    df = spark.createDataFrame([(1001, day(1), 0.0001, 0.0182, None)], "k int, d date, x double, p double, n double")
    german = formatted(df, ",", True, ["p"], {"k": 5})
    assert rows(german) == [("01001", "01.01.2020", "0,0001", "1.82%", None)]
    assert rows(formatted(df, ".")) == [("1001", "2020-01-01", "0.0001", "0.0182", None)]


def test_exported_files(spark, tmp_path):
    df = spark.createDataFrame([(1001, day(1), 46.7, None)], "kgs int, meldedatum date, inzidenz double, r double")
    paths = export_levels({"tab": (df, ["kgs"])}, str(tmp_path))
    assert rows(read_ordered(spark, paths["tab"])) == [(1, "kgs;meldedatum;inzidenz;r"), (2, "1001;2020-01-01;46,7;")]


def test_parts_of_an_export_are_in_order(spark, tmp_path):
    """Many parts, put together by name, are sorted and hold the header once; odd texts are quoted."""
    n = 5000
    df = spark.range(n).select(
        (F.lit(n) - F.col("id")).alias("key"), F.when(F.col("id") % 7 == 0, 'a;"b').when(F.col("id") % 5 > 0, " x ").alias("name")
    )
    text = formatted(df.withColumn("by", F.col("key")), untouched=["by"])
    path = str(tmp_path / "parts")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_ordered(text.repartition(6), path, ["by"], ["key", "name"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    parts = sorted(p for p in tmp_path.joinpath("parts").iterdir() if p.name.startswith("part-"))
    assert len(parts) > 1
    joined = "".join(p.read_text() for p in parts).splitlines()
    assert joined[0] == "key;name" and [int(x.split(";")[0]) for x in joined[1:]] == list(range(1, n + 1))
    assert sorted(read_ordered(spark, path).collect()) == [(i + 1, x) for i, x in enumerate(joined)]
    assert {x.split(";", 1)[1] for x in joined[1:]} == {'"a;\\"b"', " x ", ""}


def test_tables_are_replaced(spark, tmp_path):
    path = str(tmp_path / "t")
    replace_table(spark.range(3), path)
    assert replace_table(spark.range(5).withColumnRenamed("id", "k"), path).count() == 5
    assert scan_table(spark, path).columns == ["k"]


def test_stored_tables_go_to_the_shared_folder(spark):
    out = stored(spark.range(4), "numbers")
    assert out.count() == 4
    assert out.inputFiles()[0].replace("file://", "").startswith(shared_folder(spark))
    assert fresh_path(spark, "a") != fresh_path(spark, "a")


def files_of(path):
    return sorted(p.name for p in path.iterdir() if not p.name.startswith("."))


def test_a_failed_write_leaves_the_table_as_it_was(spark, tmp_path):
    path = str(tmp_path / "t")
    replace_table(spark.range(3), path)
    before = files_of(tmp_path / "t")
    broken = spark.range(100, numPartitions=4).select(F.when(F.col("id") < 99, F.col("id")).otherwise(F.raise_error(F.lit("broken"))))
    with pytest.raises(Exception, match="broken"):
        replace_table(broken, path)
    assert files_of(tmp_path / "t") == before and scan_table(spark, path).count() == 3
    # a run that dies writes no pointer either
    spark.range(9).write.parquet(f"{path}/v-{'0' * 32}")
    assert scan_table(spark, path).count() == 3


def test_runs_side_by_side_publish_whole_versions(spark, tmp_path):
    path = str(tmp_path / "t")
    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(4) as pool:
        out = list(pool.map(lambda n: replace_table(spark.range(n), path, keep=10).count(), range(1, 9)))
    assert out == list(range(1, 9)) and scan_table(spark, path).count() in out
    # a table may be made of itself, and the version before is still there for those who read it
    old = scan_table(spark, path)
    size = old.count()
    replace_table(old.unionByName(old), path)
    assert scan_table(spark, path).count() == 2 * size and old.count() == size
    for _ in range(3):
        replace_table(spark.range(1), path)
    assert sum(n.startswith("v-") for n in files_of(tmp_path / "t")) == 2


def test_a_bucketed_table_is_read_without_exchange(spark, tmp_path):
    from pyspark.sql import Window

    path = str(tmp_path / "t")
    df = spark.range(4000).select((F.col("id") % 37).cast("int").alias("geo"), F.col("id").alias("n"))
    replace_table(df, path, Buckets(4, ("geo",), ("n",)))
    spark.sql(f"drop table {scan_table(spark, path).inputFiles() and spark.catalog.listTables()[-1].name}")
    # a session that never saw the table knows its buckets, too
    again = scan_table(spark, path)
    sums = again.select("geo", F.sum("n").over(Window.partitionBy("geo").orderBy("n")).alias("total"))
    assert "Exchange" not in sums._jdf.queryExecution().executedPlan().toString()
    assert rows(again.groupBy("geo").count().agg(F.count("*"), F.sum("count"))) == [(37, 4000)]


def test_zip_members_with_odd_fields(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as archive:
        archive.writestr("codes.csv", "CODE;NUTS3;REST\r\n1;'two\nlines; ''quoted''';\r\n\r\n2;'';x\r\n3;short")
        archive.writestr("more_codes.csv", "REST;NUTS3;CODE\nr;n;4\n")
    out = read_zip_member(spark, str(tmp_path / "a.zip"), "*codes.csv", ["nuts3", "code", "rest"], ";", "'")
    assert rows(out, "code", "nuts3", "rest") == [
        ("1", "two\nlines; 'quoted'", None), ("2", None, "x"), ("3", "short", None), ("4", "n", "r"),
    ]
    with pytest.raises(ValueError, match="absent"):
        read_zip_member(spark, str(tmp_path / "a.zip"), "codes.csv", ["absent"], ";", "'")
    assert read_zip_member(spark, str(tmp_path / "a.zip"), "none.csv", ["nuts3"], ";", "'").count() == 0
