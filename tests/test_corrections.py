"""Tables brought up to date from two snapshots equal tables made anew."""

import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from helpers import day, rows
from regiopanel.operators.corrections import corrected, snapshot_changes
from regiopanel.operators.indicators import indicators
from regiopanel.operators.rollup import attach_attributes
from regiopanel.operators.spine import dense_panel

SCHEMA = "geo int, day date, cases long, deaths long"


def test_changes_by_kind(spark):
    old = spark.createDataFrame([(1, day(1), 2, 0), (1, day(1), 3, 0), (1, day(2), 1, 0), (2, day(1), 1, 0)], SCHEMA)
    new = spark.createDataFrame([(1, day(1), 3, 0), (1, day(1), 2, 0), (1, day(2), 1, 1), (1, day(3), 1, 0)], SCHEMA)
    assert rows(snapshot_changes(old, new)) == [(1, day(2), "changed"), (1, day(3), "added"), (2, day(1), "withdrawn")]
    assert snapshot_changes(new, new).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_a_corrected_table_equals_a_new_one(spark, seed):
    rng = random.Random(seed)
    facts = [(rng.randrange(1, 7), day(rng.randint(1, 40)), rng.randint(1, 9), rng.randint(0, 1)) for _ in range(120)]
    changed = [f for f in facts if not (f[0] == 2 and rng.random() < 0.2)]  # withdrawn
    added = [(3, day(rng.randint(1, 40)), 5, 1) for _ in range(2)] + [(9, day(30), 4, 0)]  # 9 is a new region
    changed += added
    changed += [(5, day(44), 2, 0)] if seed % 2 else []
    end = 45 if seed > 1 else 40
    size = spark.createDataFrame([(g, 1000 * g) for g in range(1, 10)], "geo int, population long")

    def table(data, until):
        panel = dense_panel(spark.createDataFrame(data, SCHEMA), ["cases", "deaths"], start=day(1), end=day(until))
        return indicators(attach_attributes(panel, size), dose_levels=())

    old = table(facts, 40).cache()
    before, after = (spark.createDataFrame(x, SCHEMA) for x in (facts, changed))
    found = corrected(old, before, after, size, ["cases", "deaths"], day(1), day(end)).cache()
    columns = old.columns
    assert rows(found, *columns) == rows(table(changed, end), *columns)
    again = {r.geo for r in found.filter("is_recomputed").collect()}
    if end == 40:
        assert again <= {2, 3, 9} and 9 in again
        # from the day before the first change of the region
        first = found.filter("geo = 3 and is_recomputed").agg(F.min("day")).first()[0]
        assert first == max(day(1), min(d for g, d, n, x in added if g == 3) - timedelta(days=1))


def test_nothing_changed_nothing_computed(spark):
    facts = spark.createDataFrame([(1, day(1), 1, 0), (1, day(9), 1, 0)], SCHEMA)
    size = spark.createDataFrame([(1, 10)], "geo int, population long")
    table = indicators(attach_attributes(dense_panel(facts, ["cases", "deaths"]), size), dose_levels=())
    found = corrected(table, facts, facts, size, ["cases", "deaths"], day(1), day(9))
    assert found.filter("is_recomputed").count() == 0 and found.count() == 9
