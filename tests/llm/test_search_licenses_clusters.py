"""Ranked search, license scans and centroid clustering against brute force and SQL, and on odd rows."""

import collections
import hashlib
import math
import random
import re

import duckdb
import numpy as np
import pytest

from regiopanel.llm import centroid_clusters, license_scan, ranked_search
from regiopanel.llm.queries import QUERIES, SQL

FOLDER = "/root/testdata/sf0.001"
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
DOCS = "doc_id long, text string, row long, rows string, term string, n long, score long, m long, data string"
LINE = "Licensed under the Apache License, Version 2.0."
ODD = [
    (0, None), (1, ""), (2, " \t\n!? "), (3, "alpha beta"), (3, "alpha beta"), (4, "Alpha, BETA! gamma"), (5, "a"),
    (6, "alpha " * 30000 + "beta"), (None, "alpha beta"), (8, "Größe ÄÖ alpha 漢字 x"), (9, "y" * 40000),
    (10, LINE), (11, "x " + LINE.upper() + " alpha Released under the MIT License. alpha"), (12, None),
]


def docs(spark, rows):
    return spark.createDataFrame([(i, t, k, "r", "t", 1, 2, 3, "d") for k, (i, t) in enumerate(rows)], DOCS)


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in ("documents", "benchmark", "embeddings"):
        con.execute(f"create view {table} as select * from '{FOLDER}/{table}.parquet'")
    return con


@pytest.mark.parametrize("name", ["op11_ranked_search", "op13_centroid_clusters"])
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    result = duck.execute(SQL[name])
    order = [[d[0] for d in result.description].index(c) for c in df.columns]
    assert sorted(map(tuple, df.collect())) == sorted(tuple(r[i] for i in order) for r in result.fetchall())


# --- 11


def ranking(documents, items, top):
    """Every document scored for every item."""
    terms = [re.findall(TERM, lowered(t)) for _, t in documents]
    counts = [collections.Counter(t) for t in terms]
    n_docs, total = sum(map(bool, terms)), sum(map(len, terms))
    df = collections.Counter(w for c in counts for w in c)
    found = []
    for item, text in items:
        scored = []
        for k, c in enumerate(counts):
            m = 50 + 50 * len(terms[k]) * n_docs // total if total else 0
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1)))
                * (1000000000 * c[w] // (1000 * c[w] + 20 * m))
                for w in set(re.findall(TERM, lowered(text)))
                if w in c
            )
            doc = documents[k][0]
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        scored.sort(key=lambda x: x[:3])
        found += [(item, r + 1, doc, -s) for r, (s, _, _, doc) in enumerate(scored[:top])]
    return collections.Counter(found)


ITEMS = [(1, "alpha"), (2, "BETA beta gamma größe Größe"), (2, "x 漢字"), (3, None), (4, "?"), (None, "apache a"), (5, "absent")]


def test_search_on_odd_rows(spark):
    frames = docs(spark, ODD), docs(spark, ITEMS).withColumnRenamed("doc_id", "item_id")
    for options in ({}, {"top": 2, "strata": 1, "block_terms": 2, "segment_postings": 1}):
        found = ranked_search.search(*frames, **options)
        assert collections.Counter(map(tuple, found.collect())) == ranking(ODD, ITEMS, options.get("top", 50))


def test_search_with_one_length_for_most_documents(spark):
    """One stratum holds nearly all; ties, and bounds that leave segments out, change nothing."""
    rng = random.Random(7)
    words = [f"w{i}" for i in range(40)]
    rows = [(k, " ".join(rng.choices(words, k=12))) for k in range(900)]
    rows += [(k, " ".join(rng.choices(words, k=rng.randint(1, 90)))) for k in range(900, 1000)]
    items = [(i, " ".join(rng.choices(words, k=6))) for i in range(20)]
    found = ranked_search.search(
        docs(spark, rows).repartition(5), docs(spark, items), item_id="doc_id", top=10, strata=2, segment_postings=200
    )
    assert collections.Counter(map(tuple, found.collect())) == ranking(rows, items, 10)


def test_search_of_nothing(spark):
    full, none = docs(spark, ODD), docs(spark, [])
    columns = ["item_id", "rank", "doc_id", "score"]
    for a, b in ((full, none), (none, full), (none, none), (docs(spark, [(1, None)]), full)):
        found = ranked_search.search(a, b, item_id="doc_id")
        assert found.columns == columns and found.count() == 0


def test_a_bound_holds_for_every_document_of_its_segment():
    queries = [collections.namedtuple("Q", "row terms")(0, [b"a", b"b"]), collections.namedtuple("Q", "row terms")(1, [b"b"])]
    block = ranked_search.Block.of(queries)
    block.weigh(10, {0: 3, 1: 5})
    a, b = block.vocabulary[b"a"], block.vocabulary[b"b"]
    order = np.argsort([a, b, b], kind="stable")
    terms, tfs = np.array([a, b, b])[order], np.array([2, 1, 4])[order]
    by = dict(zip(block.terms.tolist(), block.weights.tolist()))
    both = by[a] * (2 * 10**9 // (2000 + 20 * 60)) + by[b] * (4 * 10**9 // (4000 + 20 * 60))
    assert ranked_search.segment_bounds(block, 60, terms, tfs).tolist() == [both, by[b] * (4 * 10**9 // (4000 + 20 * 60))]


# --- 12


def pattern(regions):
    """A template as a pattern over words that each end in a blank."""
    out = ""
    for r in regions:
        if isinstance(r, bytes):
            out += re.escape(r.decode()) + " "
        elif isinstance(r, list):
            out += f"(?:{pattern(r)})?"
        else:
            out += rf"(?:\S+ ){{{r[0]},{r[1]}}}"
    return out


PATTERNS = [
    (label, re.compile("(?<!\\S)" + pattern(license_scan.parsed(m))))
    for label, markups in license_scan.TEMPLATES.items()
    for m in markups
]


def scanned(text):
    """What base phrases and templates find, by patterns."""
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(text))
    base = []
    for phrase, label in license_scan.PHRASES.items():
        parts = phrase.split()
        base += [(i, label) for i in range(len(words)) if words[i : i + len(parts)] == parts]
    own = {label for _, label in base}
    line = "".join(w + " " for w in words)
    more = {label for label, p in PATTERNS if p.search(line)}
    places = [i for i, _ in base]
    return (
        len(words), len(base), min(places, default=None), max(places, default=None),
        ",".join(sorted(own)), ",".join(sorted(own | more)),
    )


COLUMNS = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels"]


def test_scan_equals_patterns_on_the_table(spark, duck):
    texts = dict(duck.execute("select doc_id, text from documents").fetchall())
    rows = QUERIES["op12_license_scan"](spark, FOLDER).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert tuple(r[c] for c in COLUMNS) == scanned(texts[r.doc_id])
        assert 0 <= r.score <= 1 and (r.score == 1 or r.labels == r.base_labels)
    assert sum(r.labels != "" for r in rows) > 0


def test_scan_on_odd_rows(spark):
    found = license_scan.scan_licenses(docs(spark, ODD)).collect()
    assert collections.Counter((r.doc_id, *(r[c] for c in COLUMNS)) for r in found) == collections.Counter(
        (i, *scanned(t)) for i, t in ODD
    )
    assert license_scan.scan_licenses(docs(spark, [])).count() == 0
    by_id = {r.doc_id: r for r in found}
    assert by_id[0].score == 0 and by_id[10].score == 1 and by_id[11].labels == "apache,mit"
    assert [(m.label, m.first, m.words) for m in by_id[10].matches] == [("apache", 0, 8)]


def example(regions, rng, whole=True):
    words = []
    for r in regions:
        if isinstance(r, bytes):
            words.append(r.decode())
        elif isinstance(r, list):
            words += example(r, rng) if rng.random() < 0.5 else []
        else:
            words += [f"name{i}" for i in range(rng.randint(*r))]
    return words


def test_templates_accept_their_own_wordings_and_no_changed_ones():
    rng = random.Random(3)
    scanner = license_scan.Scanner(license_scan.TEMPLATES, license_scan.PHRASES)
    for label, markups in license_scan.TEMPLATES.items():
        for markup in markups:
            regions = license_scan.parsed(markup)
            for _ in range(6):
                words = example(regions, rng)
                text = "Some text. " + ", ".join(words).title() + "; more"
                got = scanner(text.encode())
                assert label in got["labels"].split(",") and got["score"] == 1
                assert (got["n_words"], got["labels"]) == (scanned(text)[0], scanned(text)[5])
                # One mandatory word changed: what is found is what patterns find.
                k = rng.randrange(len(words))
                broken = " ".join([*words[:k], "other", *words[k + 1 :]])
                assert scanner(broken.encode())["labels"] == scanned(broken)[5]


def test_scan_of_random_words_of_templates():
    rng = random.Random(5)
    scanner = license_scan.Scanner(license_scan.TEMPLATES, license_scan.PHRASES)
    words = "licensed under the terms of gnu general public license version 3 mit cc by nc 4 0 a apache".split()
    for _ in range(400):
        text = " ".join(rng.choices(words, k=rng.randint(0, 60)))
        got = scanner(text.encode())
        assert tuple(got[c] for c in COLUMNS) == scanned(text)


def test_wrong_markup_is_refused():
    for markup in ("<<beginOptional>>a", "a<<endOptional>>", "<<beginOptional>>a<<endOptional>>"):
        with pytest.raises(ValueError):
            license_scan.Automaton({"x": (markup,)})
    with pytest.raises(ValueError):
        license_scan.Automaton({"x": ('<<var;name="n";words="1-2">> a',)})


# --- 13

VECTORS = "vec_id long, embedding array<float>, label int, cluster int, vector string, raw string, distance long"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, "v", "r", 3) for i, v in rows], VECTORS)


def clustered(rows, k, rounds, size):
    """The same by plain loops."""
    kept = [
        (i, tuple(math.floor(1024 * float(np.float32(x))) for x in v))
        for i, v in rows
        if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)
    ]
    seeds = sorted(
        kept, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1])
    )
    points = [v for _, v in seeds[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, p)), c) for c, p in enumerate(points)) for _, v in kept]

    for _ in range(rounds):
        found = assign()
        for c in range(len(points)):
            mine = [v for (_, v), (_, who) in zip(kept, found) if who == c]
            if mine:
                points[c] = tuple(sum(x) // len(mine) for x in zip(*mine))
    found = assign()
    sums = collections.Counter()
    for d, c in found:
        sums[c] += d
    digest = [hashlib.sha256(",".join(map(str, p)).encode()).hexdigest() for p in points]
    return collections.Counter((i, c, d, sums[c], sum(sums.values()), digest[c]) for (i, _), (d, c) in zip(kept, found))


def test_clusters_on_odd_rows(spark):
    rng = random.Random(11)
    rows = [(i, [rng.uniform(-2, 2) for _ in range(3)]) for i in range(60)]
    rows += [(i % 5, rows[0][1]) for i in range(100, 130)]  # copies, also of ids
    rows += [
        (200, None), (201, []), (202, [1.0, 2.0]), (203, [1.0, None, 2.0]), (204, [1.0, float("nan"), 2.0]),
        (205, [float("inf"), 0.0, 0.0]), (None, [0.5, 0.5, 0.5]), (206, [-0.0, 1e-30, -1e-30]),
    ]
    for k, rounds in ((8, 10), (1, 2), (100, 3)):
        found = centroid_clusters.cluster(vectors(spark, rows), centroids=k, components=3, rounds=rounds)
        if k > len(rows) - 6:
            assert found.count() == len(rows) - 6
        assert collections.Counter(map(tuple, found.collect())) == clustered(rows, k, rounds, 3)


def test_clusters_of_nothing_and_of_what_does_not_fit(spark):
    for rows in ([], [(1, None)]):
        found = centroid_clusters.cluster(vectors(spark, rows))
        assert found.count() == 0 and found.columns[-1] == "centroid_sha256"
    with pytest.raises(Exception, match="64 bits"):
        centroid_clusters.cluster(vectors(spark, [(1, [1e9] * 64), (2, [0.0] * 64)])).collect()


def test_the_tree_finds_what_comparing_all_finds():
    rng = np.random.default_rng(2)
    for size, spread in ((1, 9), (2, 9), (9, 2), (60, 4), (200, 1000)):
        points = rng.integers(-spread, spread, (size, 4))
        queries = np.concatenate([rng.integers(-spread, spread, (500, 4)), points])
        tree = centroid_clusters.VantagePointTree(points)
        who, distance = tree.nearest(queries)
        every = ((queries[:, None] - points[None]) ** 2).sum(axis=2)
        assert (who == every.argmin(axis=1)).all() and (distance == every.min(axis=1)).all()


def test_the_tree_leaves_centroids_out():
    rng = np.random.default_rng(4)
    points = rng.integers(-100_000, 100_000, (256, 2))
    tree, looked = centroid_clusters.VantagePointTree(points), []
    visit = tree._visit
    tree._visit = lambda node, vectors, rows, *rest: (looked.append(len(rows) * len(node.centroids)), visit(node, vectors, rows, *rest))
    tree.nearest(rng.integers(-100_000, 100_000, (200, 2)))
    assert sum(looked) < 200 * 256 / 4
