"""Scores, filters, encoding and search against slow versions of the same definitions."""

import math
import random
import textwrap
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2

from textspark.llm import encoding, langid, licenses, mixing, quality
from textspark.llm.graph_search import meetings, nearest
from textspark.llm.storage import python_remainder
from textspark.llm.words import split_words


def test_encoding_equals_the_library(corpus, edge_rows):
    theirs = sentencepiece.SentencePieceProcessor(model_file=encoding.DEFAULT_MODEL)
    rows = [*edge_rows, (20, " lead  two   three\n\ttab  "), (21, "a\x00b 🎉<s></s><unk><0x41> "), (22, "x" * 3000), (23, " ")]
    docs = corpus(*rows)
    out = encoding.encoded(docs)
    assert out.columns == [*docs.columns, "n_tokens", "token_sha256", "parity", "round_trip", "token_ids"]
    for r in encoding.decoded(out).collect():
        assert r.token_ids == theirs.encode(r.text or "") and r.parity and r.n_tokens == len(r.token_ids)
        assert r.round_trip == ("▁" not in (r.text or "")) and (r.decoded == (r.text or "")) == r.round_trip
    assert encoding.encoded(corpus()).collect() == []


@pytest.mark.parametrize("squeeze", [False, True])
def test_unigram_models(tmp_path, corpus, squeeze):
    model = sentencepiece_model_pb2.ModelProto()
    model.trainer_spec.model_type = 1
    model.trainer_spec.byte_fallback = True
    model.normalizer_spec.name = "identity"
    model.normalizer_spec.remove_extra_whitespaces = squeeze
    for piece, score, kind in [("<unk>", 0, 2), ("<s>", 0, 3), ("</s>", 0, 3), *((f"<0x{i:02X}>", 0, 6) for i in range(256))]:
        model.pieces.add(piece=piece, score=score, type=kind)
    for piece, score in {"▁": -2, "▁the": -3, "th": -4, "e": -4.5, "he": -4.2, "▁th": -3.7, "t": -6, "h": -6, "cat": -5, "▁c": -5.5, "at": -4, "a": -6, "c": -6}.items():
        model.pieces.add(piece=piece, score=score, type=1)
    path = tmp_path / "unigram.model"
    path.write_bytes(model.SerializeToString())
    theirs = sentencepiece.SentencePieceProcessor(model_file=str(path))
    texts = ["the cat", "thethe  cat hat", "", "日 the", " the "]
    for r in encoding.encoded(corpus(*enumerate(texts)), str(path)).collect():
        assert r.token_ids == theirs.encode(r.text) and r.parity


def test_quality_scores_are_gaussian_densities():
    rng = np.random.default_rng(0)
    d = len(quality.FEATURES)
    x = [rng.normal(size=(300, d)) @ rng.normal(size=(d, d)) + k for k in (0, 1)]
    moments = np.stack([np.concatenate([[len(a)], a.sum(axis=0), (a.T @ a).ravel()]) for a in x])
    model = quality.fitted(moments)
    probe = np.concatenate([x[0][:5], x[1][:5]])
    pooled = np.diag(sum(((a - a.mean(axis=0)) ** 2).sum(axis=0) for a in x) / 600)
    weight = max(quality.SHRINKAGE, d / (d + 300))
    logs = []
    for a in x:
        cov = (1 - weight) * np.cov(a.T, bias=True) + weight * pooled
        gap = probe - a.mean(axis=0)
        logs.append(-0.5 * np.einsum("ij,ij->i", gap @ np.linalg.inv(cov), gap) - 0.5 * np.linalg.slogdet(cov)[1])
    assert np.allclose(model.score(probe), 1 / (1 + np.exp(logs[0] - logs[1])))


def test_quality_on_documents(spark, corpus, edge_rows):
    rng = random.Random(4)
    good = lambda: " ".join(rng.choice(["the", "of", "a", "tree", "river", "stone,", "house."]) for _ in range(80))
    bad = lambda: " ".join(rng.choice(["BUY", "NOW", "WIN"]) + "!!" for _ in range(80))
    rows = [(i, good() if i % 2 else bad()) for i in range(1000, 1200)]
    labels = spark.createDataFrame([(i, i % 2, None) for i, _ in rows] + [(1000, None, 1), (None, 1, 1), (1001, 5, 0)], "doc_id long, quality int, toxic int")
    out = quality.quality_scores(corpus(*edge_rows, *rows), labels).collect()
    assert len(out) == len(edge_rows) + len(rows)
    for r in out:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        if r.doc_id is not None:
            assert r.held_out == (python_remainder(r.doc_id, 3) == 1)
            assert r.doc_id < 1000 or r.predicted == r.doc_id % 2
    assert {r.score for r in quality.quality_scores(corpus(*rows[:3]), labels.limit(0)).collect()} == {0.5}
    assert quality.quality_scores(corpus(), labels).collect() == []


def test_language_profiles(corpus, edge_rows):
    rng = random.Random(5)
    kinds = {"xx": "lo la lu mi ma".split(), "yy": "kra ktu grz bro".split()}
    text = lambda k: " ".join("".join(rng.choice(kinds[k]) for _ in range(3)) for _ in range(40))
    rows = [(i, text(k), k) for i in range(200, 260) for k in [("xx", "yy")[i % 2]]]
    rows += [(500, "lo la", None), (501, None, "xx"), (502, "12 34 !", "yy"), *edge_rows]
    out = langid.languages(corpus(*rows)).collect()
    assert len(out) == len(rows)
    for r in out:
        assert 0 <= r.score <= 1
        if r.doc_id is not None and 200 <= r.doc_id < 260:
            assert r.lang_pred == ("xx", "yy")[r.doc_id % 2] and r.held_out == (python_remainder(r.doc_id, 5) == 0)
        if r.doc_id in (1, 2, 3, 501, 502):
            assert (r.lang_pred, r.score) == ("und", 0.0)
    assert {(r.lang_pred, r.score) for r in langid.languages(corpus((1, "abc"))).collect()} == {("und", 0.0)}


def test_ngrams_and_profile():
    codes, ends = langid.ngrams(["", "aB, bab", "12", "é"])
    show = lambda x: "".join(chr(x >> s & 0x1FFFFF) for s in (42, 21, 0) if x >> s & 0x1FFFFF)
    own = [show(int(c)) for c in codes[ends[0] : ends[1]]]
    want = Counter()
    for word in ("_ab_", "_bab_"):
        want.update(c for c in word if c != "_")
        want.update(word[i : i + 2] for i in range(len(word) - 1))
        want.update(word[i : i + 3] for i in range(len(word) - 2))
    assert Counter(own) == want and ends.tolist() == [0, len(own), len(own), len(codes)]
    top = langid.profile(codes[ends[0] : ends[1]].copy(), 4)
    code = {show(int(c)): int(c) for c in codes}
    assert top.tolist() == [code[g] for g in sorted(want, key=lambda g: (-want[g], code[g]))][:4]


def slow_score(u, code, odds, n_texts):
    """The mixing model one bit at a time."""
    out = np.zeros(n_texts)
    unit, bit, slots = mixing.bit_slots(u, code)
    block = [0 if u.place[i] < mixing.FIRST_BLOCK else int(math.log2(u.place[i] / mixing.FIRST_BLOCK)) + 1 for i in unit]
    for t in range(n_texts):
        w = mixing.WEIGHTS.astype(float).copy()
        mine = [i for i in range(len(unit)) if u.text[unit[i]] == t]
        for k in sorted({block[i] for i in mine}):
            step, n = np.zeros_like(w), np.zeros(len(w))
            for i in (i for i in mine if block[i] == k):
                x = np.array([odds[j][slots[j][i]] for j in range(3)], float)
                g = (2 if x[2] else 1 if x[1] else 0) + 3 * int(u.spelled[unit[i]])
                p = 1 / (1 + math.exp(-max(-16, min(16, w[g] @ x))))
                out[t] += math.log10(p if bit[i] else 1 - p)
                step[g] += (bit[i] - p) * x
                n[g] += 1
            w += mixing.RATE * step / np.sqrt(n + 1)[:, None]
    return out


def test_mixing_is_what_it_says():
    rng = random.Random(6)
    texts = ["", *(" ".join(rng.choice(["the", "of", "cat", f"r{rng.randrange(99)}"]) for _ in range(n)) for n in (1, 15, 16, 70))]
    words = split_words(pa.array(texts))
    tokens, n = np.unique(words.hash.view(np.int64), return_counts=True)
    order = np.argsort(-n, kind="stable")[:10]
    vocab = mixing.vocabulary(tokens[order], n[order], int(n.sum()) + len(texts), np.ones(256, np.int64))
    u = mixing.units(words, vocab)
    odds = np.random.default_rng(1).normal(size=(3, 1 << mixing.SLOT_BITS)).astype(np.float32)
    odds[2][::2] = 0
    odds[1][::3] = 0
    assert np.allclose(mixing.text_scores(u, vocab.code, odds, len(texts)), slow_score(u, vocab.code, odds, len(texts)), rtol=1e-4)


def test_codes_are_complete():
    code = mixing.huffman([5, 0, 9, 1, 1, 30])
    assert abs(sum(2.0**-n for n in code.length.tolist()) - 1) < 1e-12
    paths = {tuple(code.bit[s : s + n]) for s, n in zip(code.start.tolist(), code.length.tolist())}
    assert len(paths) == 6


def test_language_scores(corpus, edge_rows, monkeypatch):
    monkeypatch.setattr(mixing, "FREQUENT", 50)
    rng = random.Random(7)
    rows = [*edge_rows, *((i, " ".join(rng.choice(["The", "of", "cat", f"r{rng.randrange(400)}"]) for _ in range(30))) for i in range(50, 90))]
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tokens = [(t or "").translate(fold).split() + [None] for _, t in rows]
    held = [i is not None and python_remainder(i, 7) == 2 for i, _ in rows]
    counts = Counter(w for t, h in zip(tokens, held) if not h for w in t)
    total, distinct = sum(counts.values()), len(counts)
    want = sorted(
        (str(i), h, len(t), sum(counts[w] > 0 for w in t), total, round(sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in t), 4))
        for (i, _), t, h in zip(rows, tokens, held)
    )
    got = mixing.language_scores(corpus(*rows)).collect()
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in got) == want
    assert all(r.score <= 0 and r.bits_per_byte >= 0 for r in got)
    assert mixing.language_scores(corpus()).collect() == []


def test_nearest_against_brute_force(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(600, 16)).astype(np.float32)
    x[300:340] = x[300]
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)] + [(5, x[5].tolist(), 1)]
    rows += [(700, None, 0), (701, [0.0] * 16, 0), (702, [float("nan")] * 16, 0), (703, [None] + [1.0] * 15, 0), (None, x[0].tolist(), 0), (800, [1.0, 2.0], 0)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank int")
    got = nearest(frame, frame.filter("vec_id % 100 = 0")).collect()
    hits, total = 0, 0
    for q in range(0, 600, 100):
        own = sorted((r for r in got if r.query_id == q), key=lambda r: r["rank"])
        d = np.sqrt(((x.astype(float) - x[q].astype(float)) ** 2).sum(axis=1))
        order = [int(i) for i in np.lexsort((np.arange(600), d)) if i != q][:10]
        assert [r["rank"] for r in own] == list(range(1, 11))
        assert np.allclose([r.score for r in own], [d[r.vec_id] for r in own])
        hits, total = hits + len(set(order) & {r.vec_id for r in own}), total + 10
        if q == 300:
            assert [r.vec_id for r in own] == order
    assert hits / total >= 0.9
    assert {r.query_id for r in got} == set(range(0, 600, 100))
    assert nearest(frame.limit(0), frame.limit(0)).collect() == []


def test_copies_of_query_blocks_are_not_broadcast(spark):
    packed = spark.range(3).selectExpr("1 AS dim", "id AS block", "array(id) AS asked", "explode(sequence(0L, 4L)) AS shard")
    graphs = spark.range(5).selectExpr("1 AS dim", "id AS shard", "id AS ids", "id AS vectors", "id AS nodes", "id AS edges", "id AS starts")
    met = meetings(packed, graphs)
    assert met.count() == 15
    assert "Broadcast" not in met._jdf.queryExecution().toString()


def test_license_notices(corpus, edge_rows):
    mit = licenses.TEMPLATES["MIT"]
    rows = [
        (10, f"code\nCopyright 2020 Someone\n{mit}\nmore"),
        (11, "a\nReleased under the MIT license\nb\nAll rights reserved."),
        (12, mit.replace("merge, publish,", "join, print,")),
        (13, "a licence to print money is not a notice"),
        (14, mit[: len(mit) // 2]),
        *edge_rows,
    ]
    got = sorted((r.doc_id, r.line, r.license, r.n_different) for r in licenses.notices(corpus(*rows, rows[1])).collect())
    assert got == [(10, 3, "MIT", 0), (11, 2, "MIT-line", 0), (11, 2, "MIT-line", 0), (11, 4, "All-Rights-Reserved", 0), (11, 4, "All-Rights-Reserved", 0), (12, 1, "MIT", 2)]
    assert licenses.notices(corpus()).collect() == []


def test_every_context_counts_and_answers_are_exact(corpus):
    """Log-odds from pair counts against a dictionary, and contexts beyond the common words."""
    rng = random.Random(9)
    texts = [" ".join(f"w{min(rng.randrange(9000), rng.randrange(9000))}" for _ in range(400)) for _ in range(60)]
    words = split_words(pa.array(texts))
    tokens, n = np.unique(words.hash.view(np.int64), return_counts=True)
    order = np.argsort(-n, kind="stable")[:5000]
    vocab = mixing.vocabulary(tokens[order], n[order], int(n.sum()) + len(texts), np.ones(256, np.int64))
    u = mixing.units(words, vocab)
    before = {}
    hashes = np.insert(words.hash, words.first[1:], 1)
    for i in np.flatnonzero(~u.spelled):
        before.setdefault(int(u.contexts[1][i]), set()).add(int(hashes[i - 1]) if u.place[i] else None)
    assert len(before) > 5000 and all(len(x) == 1 for x in before.values())
    keys, asked, which = mixing.pairs(u, vocab)
    counts = np.bincount(which)
    odds = mixing.path_odds(keys, keys, np.concatenate([[0], np.cumsum(counts)]), vocab)
    _, symbol, ends = mixing.pair_paths(keys, vocab)
    code, went = vocab.code, Counter()
    for key, s, c in zip((keys >> np.uint64(mixing.LEAF_BITS)).tolist(), symbol.tolist(), counts.tolist()):
        for k in range(code.start[s], code.start[s] + code.length[s]):
            went[key, int(code.node[k]), int(code.bit[k])] += c
    for p in rng.sample(range(len(keys)), 3000):
        s, key = symbol[p], int(keys[p] >> np.uint64(mixing.LEAF_BITS))
        own = odds[ends[p] - code.length[s] : ends[p]]
        nodes = code.node[code.start[s] : code.start[s] + code.length[s]].tolist()
        want = [math.log((went[key, d, 1] + mixing.PRIOR) / (went[key, d, 0] + mixing.PRIOR)) for d in nodes]
        assert np.allclose(own, np.clip(want, -mixing.CLIP, mixing.CLIP), atol=1e-5)


def test_rare_contexts_predict(corpus):
    """What follows a word beyond the first 4,096 is known from the rows that held it."""
    partner = lambda k: f"a{k} b{k * 7919 % 6000}"
    train = [i for i in range(4000) if python_remainder(i, 7) != 2]
    held = [i for i in range(4000) if python_remainder(i, 7) == 2][:2]
    rows = [(i, " ".join(partner((j * 40 + k) % 6000) for k in range(40))) for j, i in enumerate(train[:600])]
    rows += [(held[0], " ".join(partner(k) for k in range(5000, 5030))), (held[1], " ".join(f"a{k} b{k * 7919 % 6000 + 1}" for k in range(5000, 5030)))]
    got = {r.doc_id: r for r in mixing.language_scores(corpus(*rows)).collect()}
    assert got[held[0]].score > 0.2 * got[held[1]].score and got[held[0]].score > 0.2 * got[held[0]].base_score


def broken(text, width, mark):
    """Lines of at most `width` characters, each after a comment mark."""
    return "\n".join(f"{mark}{line}" for line in textwrap.wrap(text, width, break_long_words=False, break_on_hyphens=False))


@pytest.mark.parametrize("mark", ["", " * ", "// ", "# "])
@pytest.mark.parametrize("width", [32, 50, 62, 72])
def test_notices_in_their_line_breaks(mark, width):
    scanner = licenses._Scanner(licenses.TEMPLATES)
    for name, template in licenses.TEMPLATES.items():
        text = f"code = 1\n{mark}\n{broken(template, width, mark)}\n{mark}\nmore = 2"
        got = [(line, found, n) for line, found, _, _, _, n, _ in scanner.scan(text)]
        assert got == [(3, name, 0)], (name, got)


def test_published_line_breaks():
    scanner = licenses._Scanner(licenses.TEMPLATES)
    go = "// Use of this source code is governed by a BSD-style\n// license that can be found in the LICENSE file."
    isc = "/*\n * Permission to use, copy, modify, and/or distribute this software for any\n * purpose with or without fee is hereby granted, provided that the above\n * copyright notice and this permission notice appear in all copies.\n */"
    mpl = "This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy of the MPL was not distributed with this\nfile, You can obtain one at http://mozilla.org/MPL/2.0/."
    found = [[(line, name, n) for line, name, _, _, _, n, _ in scanner.scan(t)] for t in (go, isc, mpl)]
    assert found == [[(1, "BSD-line", 0)], [(2, "ISC", 0)], [(1, "MPL-2.0", 0)]]


def test_notices_that_share_a_line():
    scanner = licenses._Scanner(licenses.TEMPLATES)
    names = lambda text: sorted(name for _, name, *_ in scanner.scan(text))
    rights, lines = "Copyright 2020 Jane Doe. All rights reserved. ", ["Apache-2.0-line", "CC-BY-4.0", "GPL-3.0-line"]
    for name in lines:
        assert names(rights + licenses.TEMPLATES[name]) == sorted(["All-Rights-Reserved", name])
    text = " ".join(["All rights reserved.", *(licenses.TEMPLATES[n] for n in [*lines, "MIT", "ISC", "Unlicense"]), "All rights reserved."])
    assert names(text) == sorted(["All-Rights-Reserved"] * 2 + [*lines, "MIT", "ISC", "Unlicense"])


def test_templates_without_usual_words(corpus):
    """The gate comes from the templates: one in other words is found, with up to a tenth of its words missing."""
    own = "You may bake this cake on Sundays if every guest receives a slice and nobody counts the candles before midnight today"
    text = f"recipe\n{own.replace('guest', 'friend').replace('Sundays', 'Mondays')}\nend"
    got = licenses.notices(corpus((1, text), (2, own[:60]), (3, None)), {"Cake": own}).collect()
    assert [(r.doc_id, r.line, r.license, r.rank, r.n_different) for r in got] == [(1, 2, "Cake", 1, 2)]
    assert licenses.notices(corpus((1, text)), {}).collect() == []


def test_every_match_holds_an_anchor():
    rng = random.Random(4)
    for name, template in licenses.TEMPLATES.items():
        words = licenses.words_of(template)
        marks = licenses.anchors(words)
        most = int(licenses.DIFFERENT * len(words))
        assert sum(w in marks for w in words) > most
        for _ in range(20):
            gone = set(rng.sample(range(len(words)), most))
            assert any(w in marks for i, w in enumerate(words) if i not in gone), name


def test_compression_ranks_choose_the_winner(monkeypatch):
    """Equally many words differ; the template that saves more bytes of the block wins, whatever its name."""
    wording = "the holder of this sheet may copy lend or print it for {} and pass it on to any other reader without asking"
    near, far = wording.format("noncommercialities"), wording.format("zzqqxxjjkkvvwwyypp")
    text = wording.format("noncommercialitiez")
    for names in (("a", "b"), ("b", "a")):
        scanner = licenses._Scanner({names[0]: near, names[1]: far})
        assert [(name, rank, n) for _, name, rank, _, _, n, _ in scanner.scan(text)] == [(names[0], 1, 1)]
        ranked = scanner.ranked(licenses.words_of(text))
        assert [r[0] for r in ranked] == list(names) and ranked[0][1] > ranked[1][1]
        monkeypatch.setattr(scanner, "ranked", lambda block: ranked[::-1])
        assert [name for _, name, *_ in scanner.scan(text)] == [names[1]]


def test_notices_across_blocks():
    """One line of many blocks: each notice is found once, those that a block's edge cuts too."""
    scanner = licenses._Scanner(licenses.TEMPLATES)
    rng = random.Random(12)
    for _ in range(5):
        put, text = [], []
        for _ in range(40):
            name = rng.choice(list(licenses.TEMPLATES))
            put.append(name)
            text += [licenses.TEMPLATES[name], " ".join(f"w{rng.randrange(99)}" for _ in range(rng.randrange(1, 60)))]
        found = [(name, n) for _, name, _, _, _, n, _ in scanner.scan(" ".join(text))]
        assert sorted(found) == sorted((name, 0) for name in put)
    for size, reach in ((1, 5), (5, 5), (6, 5), (39, 5), (40, 5), (41, 5), (400, 7)):
        cut = list(licenses.blocks(3, 3 + size, reach))
        assert all(any(a <= i and min(i + reach, 3 + size) <= b for a, b in cut) for i in range(3, 3 + size))


def test_distances_against_the_matrix():
    rng = random.Random(10)
    for _ in range(200):
        a, b = ([rng.choice("abcd") for _ in range(n)] for n in (rng.randrange(1, 9), rng.randrange(1, 14)))

        def slow(x, y):
            row = list(range(len(y) + 1))
            for i, c in enumerate(x, 1):
                row, old = [i], row
                for j, d in enumerate(y, 1):
                    row.append(min(old[j - 1] + (c != d), old[j] + 1, row[-1] + 1))
            return row[-1]

        assert list(licenses.distances(a, b, True)) == [slow(a, b[:e]) for e in range(1, len(b) + 1)]
        assert list(licenses.distances(a, b, False)) == [min(slow(a, b[s:e]) for s in range(e + 1)) for e in range(1, len(b) + 1)]
        most = rng.randrange(3)
        for low, high, n in licenses.laid_on(a, b, most):
            assert slow(a, b[low:high]) == n <= most and len(licenses.differing(a, b[low:high])) >= n
