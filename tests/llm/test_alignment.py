import hashlib
import json
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from textspark.llm import alignment
from textspark.llm.alignment import BYTE_LEVEL, PIECES, Pair, aligned_groups, aligned_pairs, ranked, tokenizer_alignment


@pytest.fixture(scope="module")
def slow():
    """The contract token by token with the two libraries themselves."""
    a, b = Tokenizer.from_file(BYTE_LEVEL), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    a.encode_special_tokens = True
    letters = alignment.byte_letters()

    def tokens(text):
        if not text:
            return [], []
        whole = (" " + text).encode()
        left = [(i, bytes(letters[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
        right = [(i, alignment.piece_bytes(b.id_to_piece(i))) for i in b.encode(text)]
        if b"".join(x for _, x in left) != whole or b"".join(x for _, x in right) != whole:
            return [], []
        return left, right

    def groups(text):
        left, right = tokens(text)
        ends = [set(np.cumsum([len(x) for _, x in side]).tolist()) for side in (left, right)]
        shared = sorted(ends[0] & ends[1])
        out = [([], []) for _ in shared]
        for k, side in enumerate((left, right)):
            at, g = 0, 0
            for i, x in side:
                out[g][k].append(i)
                at += len(x)
                g += at == shared[g]
        return out

    def report(rows):
        cut = [(doc_id, groups(text)) for doc_id, text in rows]
        held = Counter(p for _, gs in cut for p in {(x, y) for g in gs for x in g[0] for y in g[1]})
        most = Counter()
        for (x, _), n in held.items():
            most[x] = max(most[x], n)
        out = []
        for doc_id, gs in cut:
            links = [(x, y) for g in gs for x in g[0] for y in g[1]]
            said = ";".join(",".join(map(str, g[0])) + "|" + ",".join(map(str, g[1])) for g in gs)
            out.append(
                (doc_id, sum(len(g[0]) for g in gs), sum(len(g[1]) for g in gs), len(gs), len(links), sum(held[p] == most[p[0]] for p in links),
                 sum(held[p] for p in links), hashlib.sha256(said.encode()).hexdigest() if gs else "")
            )
        return out, held

    return report


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
TEXTS = [
    "The tokenizer's words don't align; <|endoftext|> <s> <0x41> is plain text.",
    "Überraschung – naïve façade, 日本語の文章 and 👩‍👩‍👧 emoji\n\n\n\ttabs   and    runs of spaces  ",
    " leading space", "trailing space ", "   ", "a", "▁ a marker", "x" * 300, "é combining, \x00 control \x7f,   no-break", "12345 67.8e9 0x1F",
]


def result(rows):
    return sorted((tuple(r[c] for c in COLUMNS) for r in rows), key=repr)


def test_equals_the_slow_version(corpus, edge_rows, slow):
    rows = [*edge_rows, *((100 + i, t) for i, t in enumerate(TEXTS)), *((200 + i, TEXTS[i % 3]) for i in range(9)), (100, TEXTS[0])]
    expected, held = slow(rows)
    docs = corpus(*rows)
    assert result(tokenizer_alignment(docs.repartition(3)).collect()) == sorted(expected, key=repr)
    pairs = aligned_pairs(docs).collect()
    assert {(r.a, r.b): r.n_docs for r in pairs} == dict(held)


def test_many_links_are_made_in_portions(monkeypatch, slow):
    texts = [t for t in TEXTS if "▁" not in t]
    monkeypatch.setattr(alignment, "LINKS", 3)
    with open(BYTE_LEVEL) as a, open(PIECES, "rb") as b:
        pair = Pair(a.read(), b.read())
    found = alignment.align(pair, texts)
    _, held = slow(list(enumerate(texts)))
    assert found["pairs"].num_rows == sum(held.values())
    assert sum(found["pairs"]["times"].to_pylist()) == found["n_links"].sum()


def test_groups_cover_the_same_bytes(corpus):
    with open(BYTE_LEVEL) as a, open(PIECES, "rb") as b:
        pair = Pair(a.read(), b.read())
    rows = aligned_groups(corpus(*((i, t) for i, t in enumerate(TEXTS)))).collect()
    for r in rows:
        left, right = Counter(), Counter()
        for side, ids, groups, table in ((left, r.a_ids, r.a_groups, pair.a_bytes), (right, r.b_ids, r.b_groups, pair.b_bytes)):
            for i, g in zip(ids, groups):
                side[g] += len(table[i].as_py())
        assert left == right and sorted(left) == list(range(len(left)))


def test_the_fast_core_has_the_ids_of_the_file():
    with open(BYTE_LEVEL) as a, open(PIECES, "rb") as b:
        spec, model = a.read(), b.read()
    assert ranked(json.loads(spec))
    tokenizer = Tokenizer.from_str(spec)
    tokenizer.encode_special_tokens = True
    points = [c for c in range(1, 0x30000, 7) if not 0xD800 <= c < 0xE000]
    texts = [f"a{chr(c)}b 1{chr(c)}2 {chr(c)} {chr(c)}{chr(c)}!" for c in points]
    assert Pair(spec, model).a(texts) == [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    other = json.loads(spec)
    other["model"]["merges"] = other["model"]["merges"][::-1]
    assert not ranked(other)
    assert Pair(json.dumps(other), model).a(["left to the library"]) == [Tokenizer.from_str(json.dumps(other)).encode("left to the library").ids]


def test_empty_table(corpus):
    assert tokenizer_alignment(corpus()).collect() == []
