"""Line dedup against brute force, and its work on lines of one template."""

import random

from pyspark.sql import functions as F

from regiopanel.llm import line_dedup
from regiopanel.llm.line_dedup import line_classes


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def first_of_class(lines):
    """Number of the first line that links reach, by comparing all pairs."""
    texts = sorted(set(lines))
    parent = {x: x for x in texts}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(texts):
        for b in texts[:i]:
            edits = min(2, min(len(a), len(b)) // 12)
            if abs(len(a) - len(b)) <= edits and edits and edit_distance(a, b) <= edits:
                parent[root(a)] = root(b)
    first = {}
    for k, x in enumerate(lines):
        first.setdefault(root(x), k)
    return [first[root(x)] for x in lines]


def mixed_lines():
    """Templates with numbers and names, edited short lines, runs of one letter, letters beyond ASCII."""
    random.seed(5)
    towns = ["Rome", "Oslo", "Bonn", "Lagos"]
    lines = [f"Order {random.randrange(1000):04d} was shipped to {random.choice(towns)} on time" for _ in range(120)]
    lines += [f"ID {random.randrange(100000)} of the register" for _ in range(100)]
    lines += ["x" * random.randrange(10, 60) + random.choice(["", "y", "yz"]) for _ in range(60)]
    for _ in range(80):
        line = "".join(random.choice("ab ") for _ in range(random.randrange(5, 40))).strip() or "a"
        edited = list(line)
        for _ in range(random.randrange(4)):
            at = random.randrange(len(edited) + 1)
            edited[at : at + random.randrange(2)] = random.choice(["", "a", "b", "é"])
        lines += [line, "".join(edited).strip() or "x"]
    return lines


def test_classes_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "SMALL", 6)  # so that segments are split again on few lines
    lines = mixed_lines()
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    got = {r["doc_id"]: r["keep_id"] for r in line_classes(docs).collect()}
    assert [got[k] for k in range(len(lines))] == first_of_class(lines)


def test_hot_segments_lose_no_line(spark, monkeypatch):
    """Keys that the sample finds hot skip the count; here every key that two lines hold does."""
    monkeypatch.setattr(line_dedup, "SMALL", 1)
    lines = mixed_lines()[::4]
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    got = {r["doc_id"]: r["keep_id"] for r in line_classes(docs).collect()}
    assert [got[k] for k in range(len(lines))] == first_of_class(lines)


def pairs_of_template(spark, count):
    number = F.lpad(F.pmod(F.xxhash64("id"), F.lit(10**8)).cast("string"), 8, "0")
    line = F.concat(F.lit("Order "), number, F.lit(" was shipped to the port of Rotterdam by the usual way"))
    lines = spark.range(count).select(F.xxhash64(line).alias("h"), line.alias("line"))
    bits = line_dedup._parities(line_dedup._counts(F.col("line")))
    state = lines.select(F.lit(0).cast("long").alias("group"), "h", bits.alias("bits"), F.col("line").alias("rest"))
    state = line_dedup.stored(state, "state")
    made = 0
    while not state.isEmpty():
        pairs, state = line_dedup._round(state, 2)
        made += pairs.count()
    return made


def test_pairs_of_a_template_follow_its_lines(spark):
    """All lines share two segments; all pairs would be 1,999,000 and 7,998,000."""
    few, many = pairs_of_template(spark, 2000), pairs_of_template(spark, 4000)
    assert few < 20 * 2000 and many < 20 * 4000


def lines_with_a_word_more(count):
    """One line, with four random letters put in after one of its words: nearly all pairs are no copies."""
    random.seed(7)
    words = [f"{a}{b}" for a in ("pay", "ship", "order", "stock", "claim") for b in ("ing", "ment", "s", "able")]
    out = []
    for _ in range(count):
        at = random.randrange(len(words))
        more = "".join(random.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(4))
        out.append(" ".join([*words[:at], words[at] + more, *words[at + 1 :]]))
    return out


def nodes(plan):
    yield plan
    kind = plan.getClass().getSimpleName()
    if kind == "AdaptiveSparkPlanExec":
        yield from nodes(plan.executedPlan())
    elif kind.endswith("QueryStageExec"):
        yield from nodes(plan.plan())
    for i in range(plan.children().size()):
        yield from nodes(plan.children().apply(i))


def rows_joined(df):
    """Rows that the last join of a plan makes."""
    df.collect()
    joins = [x for x in nodes(df._jdf.queryExecution().executedPlan()) if "Join" in x.nodeName()]
    return joins[0].metrics().apply("numOutputRows").value()


def test_lines_that_share_several_segments_meet_once(spark, monkeypatch):
    """A pair is made at one of the keys that its lines share, not at each and then told to be the same."""
    lines = spark.createDataFrame([(x,) for x in lines_with_a_word_more(400)], "line string").distinct()
    bits = line_dedup._parities(line_dedup._counts(F.col("line")))
    state = lines.select(F.lit(0).cast("long").alias("group"), F.xxhash64("line").alias("h"), bits.alias("bits"), F.col("line").alias("rest"))
    plain, made = line_dedup.stored, []

    def counted(df, name):
        if name == "pairs":
            made.append(rows_joined(df))
        return plain(df, name)

    state = plain(state, "state")
    monkeypatch.setattr(line_dedup, "stored", counted)
    told = 0
    while not state.isEmpty():
        pairs, state = line_dedup._round(state, 2)
        told += pairs.distinct().count()
    assert told > 1000 and sum(made) < 1.05 * told


def test_links_equal_brute_force(spark, monkeypatch):
    """Every link, not only the classes, whichever of two lines looks for the other."""
    monkeypatch.setattr(line_dedup, "SMALL", 4)
    lines = sorted(set(mixed_lines()[::2] + lines_with_a_word_more(40)))
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    of = {r["h"]: r["line"] for r in docs.select("text").toDF("line").withColumn("h", F.xxhash64("line")).collect()}
    got = {tuple(sorted((of[r["a"]], of[r["b"]]))) for r in line_dedup.similar_lines(docs, "doc_id", "text").collect()}
    want = set()
    for i, a in enumerate(lines):
        for b in lines[:i]:
            edits = min(2, min(len(a), len(b)) // 12)
            if edits and abs(len(a) - len(b)) <= edits and edit_distance(a, b) <= edits:
                want.add((b, a))
    assert got == want


def test_counts_of_letters_tell_more_than_their_parities(spark):
    """Two of each of three letters more: no parity differs, but no two lines are copies."""
    more = ["".join(x + x for x in three) for three in ("abc", "def", "ghi", "klm", "nop", "rst", "éèü", "uvw")]
    lines = [f"Order number {x} was shipped to the port of Rotterdam by the usual way" for x in more]
    lines = spark.createDataFrame([(x,) for x in lines], "line string")
    bits = line_dedup._parities(line_dedup._counts(F.col("line")))
    state = lines.select(F.lit(0).cast("long").alias("group"), F.xxhash64("line").alias("h"), bits.alias("bits"), F.col("line").alias("rest"))
    assert line_dedup._round(line_dedup.stored(state, "state"), 2)[0].count() == 0
