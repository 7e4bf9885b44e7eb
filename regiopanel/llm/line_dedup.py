"""Line dedup by a segment-partition edit join.

Lines within a few edits of each other are copies: one edit for every ``CHARS_AN_EDIT`` characters of the
shorter line, ``DISTANCE`` at most.  A line is cut into one segment more than edits are allowed, so a copy
holds at least one of them unchanged, near its place.  The segments are indexed by the line's length and
their number; each line probes the index for its own and shorter lengths, at the places that a shift by the
remaining edits allows.

Lines of one template share a segment without being copies.  Where more than ``SMALL`` lines meet at a
segment, it is taken out of them, with whatever all of them begin and end with, and what is left is cut into
segments again: two lines that share a segment have all their edits in the rest.  So a hot segment is split
until few lines meet or the rest is shorter than the number of segments.  Then pairs are made, each at the first
key that its lines share: their number follows that of the lines, not its square.  Groups of the same lines and
rests go on once.

Pairs are compared by a band of bit vectors, which alone decide; before, pairs whose counts of letters can't be
of copies are left out.  Everything is a built-in expression.  Keys travel first, without text; texts follow
only of lines that meet others, told by a bitmap of bounded size (a full one lets all pass).

Defined results: lines without a word are left out; blanks at the ends don't count; lines too short for an
edit are copies only if equal.  A class is what links reach, its first line by id and number stays; a null
text has no lines, an empty table gives an empty result, repeated rows are copies of which the first in an
arbitrary but fixed order stays.  Only the id and the text are read, so other columns can't clash.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regiopanel.llm.common import let, sifted
from regiopanel.llm.components import components
from regiopanel.session import stored

DISTANCE = 2
CHARS_AN_EDIT = 12
# Keys of lines that meet at one segment and are compared with each other, by bits of counts first: at most SMALL squared bit operations.
SMALL = 256
# Characters whose counts a pair is held against, the last bits of them before its text is read (fixed values).
LETTERS = "etaonirshldcumpgfwybvk0123456789.,-"
BLANKS_IN_LINE = " \t\x0b\x0c\r"
# Documents looked at for segments that a good part of all lines hold, and how many slices such a key gets.
SAMPLE_DOCUMENTS = 20_000
HOT_SHARE = 500
SLICES = 64


def _lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    texts = docs.select(docs[f"`{id_col}`"].alias("doc_id"), docs[f"`{text_col}`"].cast("string").alias("text"))
    # Trimmed before they become rows, so that the many expressions on a line don't trim it again.
    lines = F.transform(F.split("text", "\n"), lambda x: F.btrim(x, F.lit(BLANKS_IN_LINE)))
    lines = texts.select("doc_id", F.posexplode(lines).alias("line_no", "line")).filter("line != ''")
    return lines.select("*", F.xxhash64("line").alias("h"), F.xxhash64(F.lit(1), "line").alias("g"))


def _counts(line: Column) -> Column:
    """How often a line holds each letter, then all others; an edit changes at most two of the counts, by one."""
    whole = F.length(line)
    counts = [whole - F.length(F.replace(line, F.lit(c), F.lit(""))) for c in LETTERS]
    return F.array(*counts, whole - reduce(lambda a, b: a + b, counts))


def _parities(counts: Column) -> Column:
    """The last two bits of each count: all the last ones, and all those before them."""

    def bits(number: int) -> Column:
        one = F.transform(counts, lambda x, i: F.call_function("shiftleft", F.shiftright(x, number).bitwiseAND(F.lit(1)).cast("long"), i))
        return F.aggregate(one, F.lit(0).cast("long"), lambda x, y: x.bitwiseOR(y))

    return F.struct(bits(0).alias("low"), bits(1).alias("high"))


def _apart(a: Column, b: Column) -> Column:
    """By how much the counts differ at least: one where it is odd, two where it is 2 modulo 4."""
    odd = a["low"].bitwiseXOR(b["low"])
    two = a["high"].bitwiseXOR(b["high"]).bitwiseAND(F.bitwise_not(odd))
    return F.bit_count(odd) + 2 * F.bit_count(two)


def _edits(length: Column, distance: int) -> Column:
    """Edits that make a copy of a line of so many characters."""
    return F.least(F.lit(distance), F.floor(length / CHARS_AN_EDIT).cast("int"))


def _segment(length: Column, i: int, parts: int) -> tuple[Column, Column]:
    """Start, from 1, and length of segment i, from 0, of a line of a length; the last ones are longer."""
    short = F.floor(length / parts).cast("int")
    plain = F.lit(parts) - length % parts
    start = short * i + F.greatest(F.lit(i) - plain, F.lit(0)) + 1
    return start, short + F.when(F.lit(i) >= plain, 1).otherwise(0)


def _places(whole: Column, distance: int) -> list[tuple[bool, int, Column, Column, Column, Column]]:
    """(of the index, segment, length looked for, start, size, whether it counts) of a line's keys.

    A place is left out if edits before or after it would exceed the distance.  A line shorter than the number of
    segments has only its first one, which is empty: all such lines meet.
    """
    parts, places = distance + 1, []
    for shorter in range(distance + 1):
        length = whole - shorter
        for i in range(parts):
            start, size = _segment(length, i, parts)
            left, right = i, distance - i
            for shift in range(max(-left, shorter - right), min(left, shorter + right) + 1):
                at = start + shift
                counts = (length >= (parts if i else 0)) & (at >= 1) & (at + size - 1 <= whole)
                places.append((not shorter and not shift, i, length, at, size, counts))
    return places


def within(a: Column, b: Column, distance: int, edits: Column | None = None) -> Column:
    """Whether two arrays of characters are within so many edits, or within ``edits``, at most ``distance``, of them.

    ``rows[d]`` has bit k set where the characters of ``a`` so far and k - distance more of ``b`` are d edits apart
    or fewer; the band is as wide as the edits allow.
    """
    edits = F.lit(distance) if edits is None else edits
    band = 2 * distance + 1
    mask = (1 << band) - 1
    first = F.array(*[F.lit(sum(1 << (distance + j) for j in range(d + 1))).cast("long") for d in range(distance + 1)])

    def step(rows: Column, i: Column) -> Column:
        def moved(same: Column) -> Column:
            old = [F.get(rows, d) for d in range(distance + 1)]
            new = [old[0].bitwiseAND(same)]
            for d in range(1, distance + 1):
                row = old[d].bitwiseAND(same)
                row = row.bitwiseOR(old[d - 1]).bitwiseOR(F.shiftright(old[d - 1], 1))
                new.append(row.bitwiseOR(F.shiftleft(new[d - 1], 1)).bitwiseAND(F.lit(mask).cast("long")))
            return F.array(*new)

        bits = [
            F.when(F.get(b, i + k - distance).eqNullSafe(F.get(a, i)), F.lit(1 << k)).otherwise(0).cast("long")
            for k in range(band)
        ]
        return let(reduce(lambda x, y: x.bitwiseOR(y), bits), moved)

    rows = F.aggregate(F.sequence(F.lit(0), F.size(a) - 1), first, step)
    gap = F.size(b) - F.size(a)
    reached = F.get(rows, edits).bitwiseAND(F.element_at(F.array(*[F.lit(1 << k).cast("long") for k in range(band)]), F.least(F.greatest(gap + distance, F.lit(0)), F.lit(band - 1)) + 1))
    return (F.abs(gap) <= edits) & (reached != 0)


def _characters(line: str) -> Column:
    return F.split(line, "")


def _keys(lines: DataFrame, distance: int) -> tuple[DataFrame, list[Column]]:
    """Lines long enough for an edit as (h, k0, k1, ...), and the keys as structs (key, whether of the index)."""
    line, n = F.col("line"), F.col("n")
    places = _places(n, distance)
    keys = [
        F.when(counts, F.xxhash64(length, F.lit(i), F.substring(line, at, size))).alias(f"k{j}")
        for j, (_, i, length, at, size, counts) in enumerate(places)
    ]
    long = lines.select("h", "line", F.length("line").alias("n")).filter(_edits(n, distance) > 0)
    told = [F.struct(F.col(f"k{j}").alias("key"), F.lit(p[0]).alias("indexed")) for j, p in enumerate(places)]
    return long.select("h", *keys), told


def _hot_keys(docs: DataFrame, id_col: str, text_col: str, distance: int) -> DataFrame:
    """Keys that a good part of a bounded sample's lines hold.

    They only get more slices and skip the count; what is a copy doesn't depend on them.  At most HOT_SHARE times the keys of a line.
    """
    share = min(1.0, SAMPLE_DOCUMENTS / max(1, docs.count()))
    lines, told = _keys(_lines(docs.sample(share, seed=1), id_col, text_col).dropDuplicates(["h"]), distance)
    lines = stored(lines, "sampled")
    least = max(SMALL, lines.count() // HOT_SHARE)
    keys = lines.select(F.explode(F.array(*told)).alias("at")).select("at.key").filter("key is not null")
    return stored(keys.groupBy("key").agg(F.count("*").alias("lines")).filter(F.col("lines") > least).select("key"), "hot")


def _meeting(lines: DataFrame, hot: DataFrame, distance: int) -> DataFrame:
    """Hashes of the lines that share a key with another line, found without text."""
    keys, told = _keys(lines, distance)
    # One of each group of equal lines; most copies are dropped before the shuffle.
    keys = keys.groupBy("h").agg(*[F.first(c).alias(c) for c in keys.columns[1:]])
    rows = keys.select("h", F.explode(F.array(*told)).alias("at")).select("h", "at.*").filter("key is not null")
    flags = F.broadcast(hot.select(F.col("key").alias("hot")))
    rows = rows.join(flags, F.col("key") == F.col("hot"), "left")
    slice_ = F.when(F.col("hot").isNotNull(), F.pmod("h", F.lit(SLICES)) + 1).otherwise(0).cast("int")
    rows = rows.select("h", "key", "indexed", slice_.alias("slice")).repartition("key", "slice")
    sizes = rows.groupBy("key", "slice").agg(F.min("h").alias("low"), F.max("h").alias("high"), F.max("indexed").alias("any"))
    sizes = sizes.filter("slice > 0 or (low != high and any)").select("key", "slice")
    # Few keys are left on the right; a hash of them spares sorting all rows.
    met = rows.join(sizes.hint("shuffle_hash"), ["key", "slice"], "left_semi")
    return stored(met.select("h").distinct(), "meeting")


def _first_difference(low: Column, high: Column) -> Column:
    """Number of characters that two texts have in common at their beginning."""
    shorter = F.least(F.length(low), F.length(high))
    differ = F.zip_with(F.split(low, ""), F.split(high, ""), lambda x, y: F.coalesce(x != y, F.lit(True)))
    place = F.array_position(differ, True).cast("int")
    return F.when(place > 0, F.least(place - 1, shorter)).otherwise(shorter)


def _stripped(members: DataFrame) -> DataFrame:
    """Rests (group, h, bits, rest) without what all of their group begin and end with."""
    back = F.reverse("rest")
    ends = members.groupBy("group").agg(
        F.min("rest").alias("low"), F.max("rest").alias("high"), F.min(back).alias("low_back"),
        F.max(back).alias("high_back"), F.min(F.length("rest")).alias("least"),
    )
    ends = ends.select("group", "least", _first_difference(F.col("low"), F.col("high")).alias("front"), _first_difference(F.col("low_back"), F.col("high_back")).alias("end"))
    ends = ends.withColumn("end", F.least("end", F.col("least") - F.col("front")))
    left = F.substring(F.col("rest"), F.col("front") + 1, F.length("rest") - F.col("front") - F.col("end"))
    return members.join(ends, "group").select("group", "h", "bits", left.alias("rest"))


def _round(state: DataFrame, distance: int) -> tuple[DataFrame, DataFrame]:
    """Pairs (a, b) that meet in groups of few lines, and the rests of those that meet in larger ones."""
    parts = distance + 1
    state = state.withColumn("id", F.xxhash64("group", "h", "rest")).withColumn("n", F.length("rest"))
    places = [
        F.when(
            counts,
            F.struct(
                F.xxhash64("group", length, F.lit(i), F.substring(F.col("rest"), at, size)).alias("key"),
                F.lit(of_index).alias("indexed"), (length < F.col("n")).alias("longer"),
                (length < parts).alias("last"), at.alias("at"), size.alias("size"),
            ),
        )
        for of_index, i, length, at, size, counts in _places(F.col("n"), distance)
    ]
    rows = state.select("id", "h", "bits", F.explode(F.array(*places)).alias("x")).filter("x is not null")
    rows = stored(rows.select("id", "h", "bits", "x.*"), "places")
    sizes = rows.groupBy("key").agg(
        F.count("*").alias("members"), F.max("indexed").alias("any"), F.min("h").alias("low"), F.max("h").alias("high")
    )
    sizes = sizes.filter("low != high and any").select("key", "members")
    met = stored(rows.join(sizes, "key"), "met")
    few = met.filter(F.col("last") | (F.col("members") <= SMALL))
    # A line looks for shorter ones and for lines of its length with a smaller hash, all of whose copies it finds so.
    # Its keys travel with it: a pair is made at the first key where it meets, not at each.
    few = few.groupBy("h", "bits").agg(
        F.collect_set("key").alias("probes"),
        F.collect_set(F.when(F.col("longer"), F.col("key"))).alias("probes_shorter"),
        F.collect_set(F.when(F.col("indexed"), F.col("key"))).alias("index"),
    )
    a = few.select(F.explode("index").alias("key"), F.col("h").alias("a"), F.col("bits").alias("bits_a"), "index")
    few = few.select(F.explode("probes").alias("key"), "h", "bits", "probes", "probes_shorter")
    near = _apart(F.col("bits"), F.col("bits_a")) <= 2 * distance
    shared = F.array_intersect(F.when(F.col("h") > F.col("a"), F.col("probes")).otherwise(F.col("probes_shorter")), F.col("index"))
    pairs = few.join(a, "key").filter((F.col("h") != F.col("a")) & near & (F.array_min(shared) == F.col("key")))
    pairs = pairs.select(F.least("a", "h").alias("a"), F.greatest("a", "h").alias("b"))
    many = met.filter(~F.col("last") & (F.col("members") > SMALL)).select("key", "id", "at", "size")
    rest = F.concat(F.expr("substring(rest, 1, at - 1)"), F.expr("substring(rest, at + size)"))
    many = many.join(state.drop("n"), "id").select(F.col("key").alias("group"), "h", "bits", rest.alias("rest"))
    many = stored(_stripped(many.distinct()), "rests")
    # Of groups of the same lines and rests only one goes on.
    told = many.groupBy("group").agg(
        F.count("*").alias("c"), F.bit_xor(F.xxhash64("h", "rest")).alias("x"), F.bit_xor(F.xxhash64("rest", "h")).alias("y")
    )
    one = told.groupBy("c", "x", "y").agg(F.min("group").alias("group")).select("group")
    return stored(pairs, "pairs"), stored(many.join(one, "group", "left_semi").distinct(), "rests")


def similar_lines(docs: DataFrame, id_col: str, text_col: str, distance: int = DISTANCE) -> DataFrame:
    """Links (a, b) between hashes of different lines within the distance that their length allows."""
    lines = _lines(docs, id_col, text_col)
    wanted = _meeting(lines, _hot_keys(docs, id_col, text_col, distance), distance)
    # Not a semi-join: Spark would do that before the bitmap, and shuffle all texts.
    texts = sifted(lines.select("h", "line"), F.col("h"), wanted, F.col("h")).join(wanted, "h")
    texts = texts.groupBy("h").agg(F.first("line").alias("line"))
    texts = stored(texts.withColumn("counts", _counts(F.col("line"))), "compared")
    first = F.lit(0).cast("long").alias("group")
    state = texts.select(first, "h", _parities(F.col("counts")).alias("bits"), F.col("line").alias("rest"))
    rounds = []
    while not rounds or not state.isEmpty():
        pairs, state = _round(state, distance)
        rounds.append(pairs)
    pairs = reduce(DataFrame.unionByName, rounds).distinct()
    # A few bytes a pair, but much work: spread over all tasks.
    line_a, line_b = texts.toDF("a", "line_a", "counts_a"), texts.toDF("b", "line_b", "counts_b")
    both = pairs.repartition("a", "b").join(line_a, "a").join(line_b, "b")
    both = both.withColumn("edits", _edits(F.least(F.length("line_a"), F.length("line_b")), distance))
    apart = F.zip_with("counts_a", "counts_b", lambda x, y: F.abs(x - y))
    both = both.filter(F.aggregate(apart, F.lit(0), lambda x, y: x + y) <= 2 * F.col("edits"))
    both = both.select("a", "b", "edits", _characters("line_a").alias("x"), _characters("line_b").alias("y"))
    close = let(F.col("x"), lambda x: let(F.col("y"), lambda y: within(x, y, distance, F.col("edits"))))
    return both.filter(close).select("a", "b")


def line_classes(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", distance: int = DISTANCE
) -> DataFrame:
    """One row per line with a word: doc_id, line_no, keep_id, keep_line (of the line that stays), copies, kept."""
    lines = _lines(docs, id_col, text_col)
    found = stored(components(similar_lines(docs, id_col, text_col, distance)), "classes")
    places = stored(lines.select("doc_id", "line_no", "h", "g", F.monotonically_increasing_id().alias("row")), "lines")
    rank = F.struct(F.col("doc_id").isNull(), "doc_id", "line_no", "row")
    # Lines in no link: equal ones by both hashes. Others: by component, summed before rows meet.
    equal = places.groupBy("h", "g").agg(F.min(rank).alias("first"), F.count("*").alias("copies"))
    joined = equal.join(found, equal["h"] == found["node"], "left").drop("node")
    # A line that is alone stays without a join.
    joined = stored(joined.filter("component is not null or copies > 1"), "equal")
    linked = joined.filter("component is not null")
    best = linked.groupBy("component").agg(F.min("first").alias("first"), F.sum("copies").alias("copies"))
    linked = linked.select("h", "g", "component").join(best, "component").select("h", "g", "first", "copies")
    chosen = joined.filter("component is null").select("h", "g", "first", "copies").unionByName(linked)
    alone = F.col("first").isNull()
    return places.join(chosen, ["h", "g"], "left").select(
        "doc_id",
        "line_no",
        F.when(alone, F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("keep_id"),
        F.when(alone, F.col("line_no")).otherwise(F.col("first.line_no")).alias("keep_line"),
        F.coalesce("copies", F.lit(1).cast("long")).alias("copies"),
        (alone | (F.col("row") == F.col("first.row"))).alias("kept"),
    )
