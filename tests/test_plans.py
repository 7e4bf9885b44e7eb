"""What the physical plans must and must not contain."""

import random

import pytest
from pyspark.sql import functions as F

from helpers import day, rows
from regiopanel.operators import spine
from regiopanel.operators.allocate import allocate_proportional
from regiopanel.operators.indicators import indicators
from regiopanel.operators.spine import dense_panel
from regiopanel.operators.windows import cumulate
from regiopanel.plans.levels import all_levels, level_feeds, upper_counts
from regiopanel.plans.panel_queries import crosswalk_of
from regiopanel.plans.queries import REGISTRY
from regiopanel.plans.standins import OPTIONS, Standins

FOLDER = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_dense_panel_shuffles_sparse_rows_only(spark, tmp_path):
    facts = spark.range(1000).select(
        (F.col("id") % 7).cast("int").alias("geo"),
        F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 90).cast("int")).alias("day"),
        F.lit(1).alias("cases"),
        F.lit(0).alias("deaths"),
    )
    facts.write.parquet(str(tmp_path / "f"))
    facts = spark.read.parquet(str(tmp_path / "f"))
    panel = dense_panel(facts, ["cases", "deaths"], start="2020-01-01", end="2020-03-30")
    plan = plan_of(indicators(panel.withColumn("population", F.lit(100)), dose_levels=()))
    assert plan.count("Exchange hashpartitioning") == 2
    above = plan[: plan.index("Generate explode")]
    assert "Exchange" not in above and "Join" not in above
    assert above.count("Sort [") == 1
    assert "IsNotNull(geo), IsNotNull(day)" in plan


# The country has one row per day, and one key: its window is one bounded group.  Lines of an export are
# numbered over the blocks of its files, one row each.
ONE_KEY = {"rollup_country", "affectedness_country", "export_region_plain", "export_region_extended"}


# Their last plan only scans a stored table; the stages before it are those of staged_run_region.
SAME_STAGES = {"staged_run_state", "staged_run_country"}


@pytest.mark.parametrize("name", sorted(set(REGISTRY) - SAME_STAGES))
def test_no_cartesian_products_or_global_windows(spark, name):
    plan = plan_of(REGISTRY[name].run(spark, FOLDER))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "Window [" in line and name not in ONE_KEY:
            following = "\n".join(lines[i : i + 4])
            assert "Exchange SinglePartition" not in following, name


def test_scans_read_needed_columns_only(spark):
    plan = plan_of(REGISTRY["incidence_7d"].run(spark, FOLDER))
    assert "ReadSchema: struct<o_custkey:bigint,o_orderdate:timestamp_ntz>" in plan
    plan = plan_of(REGISTRY["date_parts_filter"].run(spark, FOLDER))
    assert "GreaterThanOrEqual(o_orderdate,1996-12-10T00:00)" in plan


def test_hot_region_and_hot_parent(spark):
    """A third of all rows under one key: the sums stay right and small before the shuffle."""
    rng = random.Random(7)
    data = [(99 if i % 3 == 0 else rng.randrange(50), day(rng.randint(1, 30)), 1, 0) for i in range(30_000)]
    df = spark.createDataFrame(data, "geo int, day date, cases long, deaths long").repartition(4)
    totals = cumulate(dense_panel(df, ["cases"], start=day(1), end=day(30)), ["cases"])
    final = totals.filter(F.col("day") == day(30))
    expected = {}
    for g, *_ in data:
        expected[g] = expected.get(g, 0) + 1
    assert {r.geo: r.cases_cum for r in final.collect()} == expected

    members = [(1 if k % 3 else 2, k, 1 + k % 11) for k in range(3000)]
    m = spark.createDataFrame(members, "parent int, geo int, population long")
    t = spark.createDataFrame([(p, day(d), 100_003 * p + d) for p in (1, 2) for d in (1, 2)], "parent int, day date, n long")
    sums = allocate_proportional(t, m, ["n"]).groupBy("parent", "day").agg(F.sum("n"), F.count("*"))
    sizes = {p: sum(1 for q, *_ in members if q == p) for p in (1, 2)}
    assert rows(sums) == sorted((p, day(d), 100_003 * p + d, sizes[p]) for p in (1, 2) for d in (1, 2))


def test_skewed_join_is_split(spark, tmp_path):
    """A hot customer without a broadcast: the join splits its partition, results stay the same."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    orders = spark.range(120_000, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 5000).alias("o_custkey"),
        F.date_add(F.lit("1996-01-01").cast("date"), (F.hash("id") % 100).cast("int")).cast("timestamp_ntz").alias("o_orderdate"),
        F.lit("F").alias("o_orderstatus"),
    )
    orders.write.parquet(str(tmp_path / "orders.parquet"))
    spark.range(5000).select(F.col("id").alias("c_custkey"), (F.col("id") % 25).cast("int").alias("c_nationkey")).write.parquet(
        str(tmp_path / "customer.parquet")
    )
    spark.read.parquet(f"{FOLDER}/nation.parquet").write.parquet(str(tmp_path / "nation.parquet"))
    expected = rows(REGISTRY["sums_by_region_day"].run(spark, str(tmp_path)))
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        df = REGISTRY["sums_by_region_day"].run(spark, str(tmp_path))
        assert rows(df) == expected
        df.collect()
        assert "skew=true" in plan_of(df)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_stored_region_counts_need_no_exchange(spark):
    """Windows and attributes of the region table work on the buckets; only feeds are exchanged."""
    s = Standins(spark, FOLDER, ["counts", "regions", "span", "line_days", "by_level"])
    windows = indicators(s.counts)
    assert "Exchange" not in plan_of(windows)
    plan = plan_of(REGISTRY["affectedness_region"].run(spark, FOLDER))
    lines = plan.splitlines()
    last = max(i for i, line in enumerate(lines) if "Window [" in line)
    scan = next(i for i in range(last, len(lines)) if "FileScan" in lines[i])
    assert "SelectedBucketsCount" in lines[scan]
    assert not any("Exchange" in line for line in lines[last:scan])


def test_all_levels_read_the_lines_once(spark):
    s = Standins(spark, FOLDER, "line_days by_level regions counts span crosswalk upper".split())
    paths = s.line_days.inputFiles()
    folder = paths[0].rsplit("/", 1)[0].split("/")[-1]
    feeds = level_feeds(
        crosswalk_of(s), s.mobility_region, s.mobility_state, s.mobility_country, s.icu, s.hospital, s.regions, OPTIONS
    )
    plan = all_levels(s.counts, s.upper, feeds, OPTIONS)._jdf.queryExecution().executedPlan().toString()
    assert plan.count(folder) <= 2  # hospital cases by age, of states and country; the second is a reused exchange


def test_both_upper_levels_come_from_one_pass(spark):
    s = Standins(spark, FOLDER, ["counts", "regions", "span", "line_days"])
    plan = plan_of(upper_counts(s.counts, s.doses, s.regions, OPTIONS, days_of=s.span))
    panel_scans = [line for line in plan.splitlines() if "FileScan" in line and "is_subtotal" in line]
    assert len(panel_scans) == 1 and plan.count("Expand ") == 1


def test_tasks_of_the_supplier_panel_follow_its_rows(spark, monkeypatch):
    query = REGISTRY["supplier_indicators"].run
    before = sorted(map(repr, query(spark, FOLDER).collect()))
    monkeypatch.setattr(spine, "TASK_ROWS", 1000)
    found = query(spark, FOLDER)
    keys, days = (spark.read.parquet(f"{FOLDER}/lineitem.parquet").agg(
        F.countDistinct("l_suppkey"), F.datediff(F.max("l_shipdate"), F.min("l_shipdate")) + 1
    ).first())
    plan = plan_of(found)
    assert "REPARTITION_BY_NUM" in plan
    assert found.rdd.getNumPartitions() >= keys * days * 0.8 / 1000
    assert sorted(map(repr, found.collect())) == before
