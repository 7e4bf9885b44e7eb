"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` is the data folder, ``BENCH_CPUS`` the number of local cores.  Each query
runs twice and the faster run counts, building its plan included.  The ``*_copies`` and
``*_range_join`` entries compute the same three indicators the way they are computed
without windows: by joining shifted copies of the panel, and by range self-joins.
"""

from __future__ import annotations

import json
import os
import re
import time
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regiopanel.functions import ratio_or_zero
from regiopanel.operators.indicators import incidence
from regiopanel.operators.windows import FRAMES
from regiopanel.plans.panel_queries import peopled_panel, supplier_panel
from regiopanel.plans.queries import REGISTRY
from regiopanel.plans.standins import Standins
from regiopanel.session import build_session

HEADLINE = [
    "incidence_7d",
    "r_value_4d",
    "r_value_7d",
    "dense_panel",
    "running_totals",
    "supplier_indicators",
    "doses_pivot",
    "allocate_proportional",
    "allocate_every_parent",
    "rollup_grouping_sets",
    "rollup_state",
    "crosswalk_build",
    "icu_ratio_state",
    "hospital_incidence",
    "profile_time_series",
    "affectedness_region",
    "affectedness_state",
    "affectedness_country",
    "affectedness_all_levels",
]
NAMES = {"incidence_7d": ["last_7"], "r_value_4d": ["recent_4", "earlier_4"], "r_value_7d": ["recent_7", "earlier_7"]}


def frame_by_copies(panel: DataFrame, name: str) -> DataFrame:
    lo, hi = FRAMES[name]
    shifted = [panel.select("geo", "day", F.date_add("day", k).alias("other")) for k in range(lo, hi + 1)]
    stacked = reduce(DataFrame.unionByName, shifted)
    other = panel.select("geo", F.col("day").alias("other"), "cases")
    joined = stacked.join(other, ["geo", "other"], "left")
    return joined.groupBy("geo", "day").agg(F.coalesce(F.sum("cases"), F.lit(0)).alias(name))


def frame_by_range_join(panel: DataFrame, name: str) -> DataFrame:
    lo, hi = FRAMES[name]
    a, b = panel.select("geo", "day").alias("a"), panel.select("geo", "day", "cases").alias("b")
    near = F.col("b.day").between(F.date_add("a.day", lo), F.date_add("a.day", hi))
    joined = a.join(b, (F.col("a.geo") == F.col("b.geo")) & near, "left")
    return joined.groupBy("a.geo", "a.day").agg(F.coalesce(F.sum("b.cases"), F.lit(0)).alias(name))


def supplier_frames_by_copies(s: Standins) -> DataFrame:
    """Only the five trailing sums of ``supplier_indicators``."""
    panel = supplier_panel(s)
    table = panel
    for name in FRAMES:
        table = table.join(frame_by_copies(panel, name), ["geo", "day"], "left")
    return table


def without_windows(s: Standins, query: str, frame) -> DataFrame:
    panel = peopled_panel(s)
    table = panel
    for name in NAMES[query]:
        table = table.join(frame(panel, name), ["geo", "day"], "left")
    if query == "incidence_7d":
        return table.select("geo", "day", "cases", incidence("last_7", "population").alias("incidence"))
    column = "r4" if query == "r_value_4d" else "r7"
    return table.select("geo", "day", ratio_or_zero(*NAMES[query], 2).alias(column))


def timed(build) -> float:
    best = float("inf")
    for _ in range(2):
        start = time.perf_counter()
        build().write.format("noop").mode("overwrite").save()
        best = min(best, time.perf_counter() - start)
    return round(best, 3)


def run(spark: SparkSession, folder: str) -> dict[str, float]:
    seconds = {}
    for name in HEADLINE:
        seconds[name] = timed(lambda: REGISTRY[name].run(spark, folder))
    for name in NAMES:
        for label, frame in (("copies", frame_by_copies), ("range_join", frame_by_range_join)):
            seconds[f"{name}_{label}"] = timed(lambda: without_windows(Standins(spark, folder), name, frame))
    seconds["supplier_frames_copies"] = timed(lambda: supplier_frames_by_copies(Standins(spark, folder)))
    return seconds


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        f"local[{cpus}]", **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "12g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = run(spark, folder)
    spark.stop()
    scale = re.search(r"sf([0-9.]+)", folder)
    total = round(sum(seconds[name] for name in HEADLINE), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": total,
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else None,
            }
        )
    )


if __name__ == "__main__":
    main()
