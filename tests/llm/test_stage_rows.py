"""Stages keep the rows and columns they should: clashing names, repeated and null ids."""

import collections
import os
import random
from pathlib import Path

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from regiopanel.llm.components import components
from regiopanel.llm.exact_dedup import keep_first_copies
from regiopanel.llm.jaccard_join import jaccard_classes, keep_one_of_each
from regiopanel.llm.pii import redact
from regiopanel.llm.quality_rules import judge, keep_good
from regiopanel.session import shared_folder

WORDS = [f"word{i}" for i in range(60)]
OTHER = "Please write to a.b@c.de about it. The meeting was moved to the second week of May, as many of us are away."
TEXT = "The quick brown fox jumps over the lazy dog near the old river bank while the sun sets. "


def stored_names(spark):
    """How many steps of each name are stored."""
    return collections.Counter(x.rsplit("-", 1)[0] for x in os.listdir(shared_folder(spark).removeprefix("file:")))


def test_columns_of_reserved_names_stay(spark):
    docs = spark.createDataFrame(
        [(1, TEXT, "a", "b", "c", 0), (1, TEXT, "a", "b", "c", 0), (2, OTHER, "a", "b", "c", 0)],
        "doc_id long, text string, _quality string, _text string, _FOUND string, n_chars long",
    )
    for stage in (keep_good, keep_first_copies, keep_one_of_each, redact):
        out = stage(docs)
        assert out.columns == docs.columns
        rows = out.collect()
        assert {r._quality + r._text + r._FOUND for r in rows} == {"abc"} and {r.doc_id for r in rows} == {1, 2}


def test_one_of_each_goes_by_id_and_text(spark):
    near = [" ".join([*WORDS[:-1], last]) for last in ("one", "two", "three", "four")]
    clean = " ".join(f"other{i}" for i in range(40))
    rows = [(3, near[0]), (7, near[1]), (7, clean), (None, near[2]), (None, near[3]), (8, ""), (8, ""), (9, None), (None, None)]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, t1 string").repartition(3)
    kept = keep_one_of_each(docs).collect()
    assert sorted((str(r.doc_id), r.text) for r in kept if r.text) == [("3", near[0]), ("7", clean)]
    assert sum(not r.text for r in kept) == 4


def test_one_of_each_without_ids(spark):
    near = [" ".join([*WORDS[:-1], last]) for last in ("one", "two")]
    docs = spark.createDataFrame([(None, near[0]), (None, near[1]), (None, near[0])], "doc_id long, text string")
    assert keep_one_of_each(docs).count() == 1
    same = docs.withColumn("doc_id", F.lit(5).cast("long"))
    assert keep_one_of_each(same).count() == 1


def test_quality_stage_stores_no_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    before = stored_names(spark)
    kept = {r.doc_id for r in keep_good(docs).select("doc_id").collect()}
    assert stored_names(spark) == before
    assert kept == {r.doc_id for r in judge(docs).filter("kept").collect()}


def test_stars_need_no_further_turn(spark):
    links = spark.createDataFrame([(i, 0) for i in range(1, 9)] + [(20, 21), (20, 22)], "a long, b long")
    before = stored_names(spark)
    got = {r["node"]: r["component"] for r in components(links).collect()}
    assert got == {**dict.fromkeys(range(9), 0), 20: 20, 21: 20, 22: 20}
    assert stored_names(spark)["links"] - before["links"] == 1


def test_later_rounds_go_through_new_links_only(spark):
    # Chains of near copies: the links of a round join components of the round before.
    chains = [" ".join([f"c{c}w{i}" for i in range(k, k + 60)]) for c in range(6) for k in range(0, 24, 4)]
    docs = spark.createDataFrame(list(enumerate(chains)), "doc_id long, text string")
    before = stored_names(spark)
    rows = jaccard_classes(docs).collect()
    classes = {r.doc_id: r.component for r in rows}
    assert len(set(classes.values())) == 6
    assert all(classes[6 * c] == classes[6 * c + k] for c in range(6) for k in range(6))
    assert stored_names(spark)["links"] - before["links"] <= 4


def near_copies(spark):
    rng, rows = random.Random(3), []
    for _ in range(40):
        words = [f"w{rng.randrange(5000)}" for _ in range(300)]
        for k in range(6):
            rows.append((len(rows), " ".join([*words[: 40 * k], f"copy{k}", *words[40 * k :]])))
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_near_copies_are_joined_without_storing_their_texts_or_sets(spark):
    docs = near_copies(spark)
    before = set(os.listdir(shared_folder(spark).removeprefix("file:")))
    rows = jaccard_classes(docs).collect()
    assert len({(r.doc_id // 6, r.component) for r in rows}) == len({r.component for r in rows}) == 40
    folder = Path(shared_folder(spark).removeprefix("file:"))
    made = [p for name in set(os.listdir(folder)) - before for p in (folder / name).glob("*.parquet")]
    sets = 8 * sum(r.n_shingles for r in rows)
    sizes = collections.Counter()
    for p in made:
        sizes[p.parent.name.split("-")[0]] += pq.read_table(p).nbytes
    # The profile holds tokens that several texts of a batch share, for their order; all else is small.
    assert sum(sizes.values()) - sizes["profile"] < sets / 4


def test_passing_tables_are_removed(spark):
    docs = near_copies(spark)
    before = stored_names(spark)
    assert keep_first_copies(docs).count() == 240
    assert stored_names(spark) - before == {"kept": 1}
    assert keep_one_of_each(docs).count() == 40
    assert set(stored_names(spark) - before) <= {"kept", "classified", "near-copies"}
