"""Near copies, repeated passages and benchmark leaks against brute force."""

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from textspark.llm import debruijn, near
from textspark.llm.contamination import contaminated, with_matches
from textspark.llm.debruijn import repeated_paths, without_repeats
from textspark.llm.near import near_duplicates
from textspark.llm.repeats import sliding_min
from textspark.llm.suffixes import without_passages
from textspark.llm.words import shingle_sets, split_words

WORDS = re.compile("[^\x20\x09-\x0d]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text, fold=True):
    return WORDS.findall((text or "").translate(FOLD) if fold else text or "")


def shingles(text):
    w = words(text)
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute_components(rows):
    ids = sorted({i for i, _ in rows if i is not None})
    group = {i: i for i in ids}

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    sets = [(i, shingles(t)) for i, t in rows if i is not None]
    for n, (a, x) in enumerate(sets):
        for b, y in sets[:n]:
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                low, high = sorted((root(a), root(b)))
                group[high] = low
    return {i: root(i) for i in ids}


def brute_cut(rows, k):
    first = {}
    for i, t in rows:
        w = words(t, False)
        for j in range(len(w) - k + 1):
            if i is not None:
                key = tuple(w[j : j + k])
                first[key] = min(first.get(key, i), i)
    out = []
    for i, t in rows:
        w = words(t, False)
        gone = set()
        for j in range(len(w) - k + 1):
            if i is not None and first[tuple(w[j : j + k])] < i:
                gone.update(range(j, j + k))
        left = [x for j, x in enumerate(w) if j not in gone]
        out.append((i, len(w), len(gone), hashlib.sha256(" ".join(left).encode()).hexdigest()))
    return sorted(out, key=str)


def passages(seed, n_docs=60):
    """Texts over a small vocabulary with copied spans, copies of whole texts and a span in a third of all texts."""
    rng = random.Random(seed)
    fresh = lambda n: [f"w{rng.randrange(30)}" for _ in range(n)]
    hot, docs = fresh(20), []
    for i in range(n_docs):
        body = fresh(rng.randrange(0, 60))
        if docs and rng.random() < 0.5:
            other = rng.choice(docs)
            a = rng.randrange(0, max(1, len(other)))
            body = body[:10] + other[a : a + rng.randrange(1, 25)] + body[10:]
        if rng.random() < 0.33:
            body = body[:5] + hot[rng.randrange(3) :] + body[5:]
        if docs and rng.random() < 0.1:
            body = list(rng.choice(docs))
        docs.append(body)
    ids = rng.sample(range(1000), n_docs)
    return [(i, "\n ".join(d)) for i, d in zip(ids, docs)]


def test_words_and_shingles():
    texts = ["", None, " a B\x0bc", "x", "a a a a a a a", "Ä b C d e f"]
    found = split_words(pa.array(texts))
    for i, text in enumerate(texts):
        own = [bytes(found.data[found.start[j] : found.end[j]]).decode() for j in range(found.first[i], found.first[i + 1])]
        assert own == words(text)
    sets = shingle_sets(found, 5)
    assert np.diff([0, *sets.ends]).tolist() == [len(shingles(t)) for t in texts]


@pytest.mark.parametrize("width", [1, 2, 3, 7, 8, 13])
def test_sliding_min(width):
    values = np.random.default_rng(width).integers(0, 1000, 60).astype(np.uint64)
    assert sliding_min(values, width).tolist() == [values[i : i + width].min() for i in range(61 - width)]


def test_near_duplicates_match_brute_force(corpus, edge_rows, monkeypatch):
    """A cloud of near copies, larger than what is compared pair by pair, with copies and edge rows."""
    monkeypatch.setattr(near, "BLOCK", 20)
    rng = random.Random(3)
    base = [f"t{rng.randrange(5000)}" for _ in range(150)]
    rows = list(edge_rows)
    for i in range(70):
        copy = list(base)
        for _ in range(rng.randrange(0, 14)):
            copy[rng.randrange(len(copy))] = f"z{rng.randrange(10**6)}"
        rows.append((100 + i, " ".join(copy)))
    rows += [(300, rows[-1][1]), (301, " ".join(base).upper())]
    got = near_duplicates(corpus(*rows)).collect()
    assert len(got) == len(rows)
    want = brute_components(rows)
    for r in got:
        assert r.component_id == want.get(r.doc_id)
        assert r.kept == (r.doc_id is None or r.doc_id == r.component_id)
    sizes = sorted((str(i), len(shingles(t))) for i, t in rows)
    assert sorted((str(r.doc_id), r.n_shingles) for r in got) == sizes


def test_near_duplicates_of_nothing(corpus):
    assert near_duplicates(corpus()).collect() == []


def test_repeats_match_brute_force(corpus, edge_rows):
    rows = passages(5) + [(i, t) for i, t in edge_rows]
    docs = corpus(*rows)
    out = without_repeats(docs, k=6, gram=3)
    assert [c for c in docs.columns] == out.columns[: len(docs.columns)]
    got = sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in out.collect()), key=str)
    assert got == brute_cut(rows, 6)


def test_paths_cover_each_repeated_window_once(corpus):
    rows = passages(8, 40)
    k = 6
    texts = {i: words(t, False) for i, t in rows}
    holders = defaultdict(set)
    for i, w in texts.items():
        for j in range(len(w) - k + 1):
            holders[tuple(w[j : j + k])].add(i)
    copied = {i for i, t in rows if any(o < i and texts[o] == texts[i] for o in texts)}
    want = {key for key, docs in holders.items() if len(docs - copied) > 1}
    seen = []
    for p in repeated_paths(corpus(*rows), k, 3).collect():
        seen += [tuple(texts[p.owner][j : j + k]) for j in range(p["from"], p["to"])]
    assert len(seen) == len(set(seen)) and set(seen) == want


def _steps(corpus, rows, k=6):
    places, _ = debruijn.repeated_edges(corpus(*rows), k, 3)
    runs = debruijn.occurrences(places)
    return runs, *debruijn.paths(runs)


def test_removed_spans_are_occurrences_of_paths(corpus):
    """A document that ends inside a passage cuts its source, not the path: others hold the path as one span."""
    one, two, w = ([f"{c}{i}" for i in range(30)] for c in "abw")
    joined = " ".join([*one, *two])
    rows = [(1, f"x {' '.join(one)} y"), (2, f"z {joined} q"), (3, f"r {joined} s"), (4, f"u {joined}"), (5, " ".join(["t", *one, *two[:9]]))]
    rows += [(6, " ".join(w)), (7, f"v {' '.join(w[:20])} v"), (8, f"g {' '.join(w)} h")]
    runs, pieces, arcs = _steps(corpus, rows)
    held = lambda placed: debruijn.path_occurrences(runs.filter("doc_id > owner"), debruijn.numbered(placed)).collect()
    got = held(debruijn.compacted(pieces, arcs))
    spans = sorted((r.doc_id, r.start, r.n) for r in got)
    # Windows of 6: documents 3 and 4 leave document 1's passage for that of document 2, where 1 ends: a branch for no one.
    assert [s for s in spans if s[0] in (7, 8)] == [(7, 1, 15), (8, 1, 25)]
    assert len({r.path for r in got if r.doc_id in (7, 8)}) == 1 and {r.at for r in got if r.doc_id in (7, 8)} == {0}
    assert [s for s in spans if s[0] in (3, 4, 5)] == [(3, 1, 55), (4, 1, 55), (5, 1, 34)]
    # Without compaction every piece is a path of its own, and the spans fall apart.
    alone = held(pieces.withColumn("path", F.col("piece")).withColumn("at", F.lit(0).cast("long")))
    assert sum(r.doc_id == 8 for r in alone) == 2 and sum(r.n for r in alone) == sum(r.n for r in got)


def test_removal_follows_the_paths(corpus, monkeypatch):
    """The rows come from the paths: without their places nothing but copies is removed."""
    rows = passages(5)
    honest = debruijn.compacted
    cut = {r.doc_id: r.n_removed for r in without_repeats(corpus(*rows), k=6, gram=3).collect()}
    monkeypatch.setattr(debruijn, "compacted", lambda pieces, arcs: honest(pieces, arcs).limit(0))
    bare = {r.doc_id: r.n_removed for r in without_repeats(corpus(*rows), k=6, gram=3).collect()}
    assert sum(bare.values()) < sum(cut.values())


def test_occurrences_hold_the_words_of_their_path(corpus):
    """Equal edges of a path have equal words in every document, however runs and sources cut it."""
    rows = passages(9, 40)
    k = 6
    texts = {i: words(t, False) for i, t in rows}
    runs, pieces, arcs = _steps(corpus, rows, k)
    placed = debruijn.numbered(debruijn.compacted(pieces, arcs))
    edge = {}
    for p in debruijn.stretches(placed).collect():
        for j in range(p["from"], p["to"]):
            assert edge.setdefault((p.path, p.at + j - p["from"]), tuple(texts[p.owner][j : j + k])) == tuple(texts[p.owner][j : j + k])
    covered = set()
    for r in debruijn.path_occurrences(runs, placed).collect():
        for j in range(r.n):
            assert edge[r.path, r.at + j] == tuple(texts[r.doc_id][r.start + j : r.start + j + k])
            covered.add((r.doc_id, r.start + j))
    want = {(r.doc_id, r.start + j) for r in runs.collect() for j in range(r.n)}
    assert covered == want


def test_passages_match_brute_force(corpus, edge_rows):
    rows = passages(6) + list(edge_rows)
    got = sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in without_passages(corpus(*rows), span=9, gram=3).collect()), key=str)
    assert got == brute_cut(rows, 9)


def test_spans_leave_other_text_alone(corpus):
    span = " ".join(f"p{i}" for i in range(50))
    rows = [(1, f"a\n{span}  z"), (2, f"Keep  this\n{span} tail\tend"), (3, "nothing  here\n")]
    out = {r.doc_id: r.text for r in without_passages(corpus(*rows)).collect()}
    assert out == {1: rows[0][1], 2: "Keep  this tail\tend", 3: rows[2][1]}
    assert without_passages(corpus()).collect() == []


def test_contamination_matches_brute_force(spark, corpus, edge_rows):
    rng = random.Random(2)
    item = lambda n: " ".join(f"q{rng.randrange(3000)}" for _ in range(n))
    items = [(i, item(n)) for i, n in enumerate([6, 9, 14, 20, 33, 60, 130])] + [(50, None), (51, ""), (52, "one two"), (None, item(20))]
    filler = lambda n: " ".join(f"f{rng.randrange(3000)}" for _ in range(n))
    rows = list(edge_rows)
    for i, (_, text) in enumerate(items[:7]):
        w = text.split()
        rows.append((100 + i, f"{filler(rng.randrange(3000))} {text.upper()} {filler(40)}"))
        rows.append((200 + i, f"{filler(30)} {' '.join(w[: len(w) * 3 // 4])} {filler(900)}"))
        rows.append((300 + i, f"{filler(30)} {' '.join(w[: len(w) // 3])} {filler(30)}"))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id, r.n_item, r.n_shared) for r in contaminated(corpus(*rows), bench).collect()}
    want = set()
    for i, t in rows:
        for j, x in items:
            s = shingles(x)
            n = len(s & shingles(t))
            if j is not None and s and 2 * n >= len(s):
                want.add((i, j, len(s), n))
    assert got == want
    docs = corpus(*rows)
    split = with_matches(docs, bench, portion=60)
    assert {(r.doc_id, m.item) for r in split.collect() for m in r._matches} == {x[:2] for x in want}
    assert split.columns == [*docs.columns, "_matches"]
    assert contaminated(corpus(*rows), bench.limit(0)).collect() == []
