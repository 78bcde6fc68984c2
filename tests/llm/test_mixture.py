import re
from collections import Counter, defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F

from textspark.llm.mixture import mixed, mixed_texts, permuted, taken_words

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def water_level(sizes, weights=(5, 2, 1), share=1.5, most=2):
    """Targets by resharing the excess again and again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, excess, open_ = {s: 0.0 for s in names}, share * sum(sizes.values()), set(names)
    while excess > 1e-6 and open_:
        total = sum(weight[s] for s in open_)
        for s in open_:
            target[s] += excess * weight[s] / total
        over = {s for s in open_ if target[s] > most * sizes[s]}
        excess = sum(target[s] - most * sizes[s] for s in over)
        target.update({s: float(most * sizes[s]) for s in over})
        open_ -= over
    return target


def spark_hash(seed, *values):
    """Spark's xxhash64 of ints (given as ints) and longs (given as 1-tuples)."""
    h = 42
    for v in values:
        data = v[0].to_bytes(8, "little", signed=True) if isinstance(v, tuple) else v.to_bytes(4, "little", signed=True)
        h = xxhash.xxh64_intdigest(data, h)
    return h - (1 << 64) if h >> 63 else h


def slow_mix(rows, block, seed=11, weights=(5, 2, 1)):
    """Words taken of each row (doc_id, text, source), slot by slot in one process, without Spark."""
    streams = defaultdict(list)
    sized = [(r[2], r[0], spark_text_hash(r[1]), len(WORDS.findall(r[1] or "")), i) for i, r in enumerate(rows)]
    for source, _, _, size, i in sorted(sized, key=lambda r: (r[0] is None, (r[0] or "").encode(), r[1] is not None, r[1] or 0, r[2])):
        streams[source] += [i] * size
    sizes = {s: 0 for s, *_ in sized} | {s: len(v) for s, v in streams.items()}
    target = water_level(sizes, weights)
    names = list(target)
    plan = []
    for s in names:
        n = -(-sizes[s] // block)
        whole = int(target[s] + 1e-9) // sizes[s] if sizes[s] else 0
        rest = int(target[s] + 1e-9) - whole * sizes[s]
        plan.append((n, whole, rest, whole * n + -(-rest // block)))
    total = sum(p[3] for p in plan)
    owner = [i for i, p in enumerate(plan) for _ in range(p[3])]
    drawn = Counter(owner[spark_hash(0, seed, (t,)) % total] for t in range(total))
    assert sum(drawn.values()) == total  # and what is over a quota fills the others, so each source has its quota of turns
    taken = [0] * len(rows)
    for i, (s, (n, whole, rest, quota)) in enumerate(zip(names, plan)):
        for turn in range(quota):
            round_, at = divmod(turn, n)
            number = n - 1 if at == n - 1 else walk(at, n - 1, seed, i, round_)
            words = streams[s][number * block : (number + 1) * block]
            if turn == quota - 1 and rest:
                words = words[: (rest - 1) % block + 1]
            for j in words:
                taken[j] += 1
    return taken, {s: (sizes[s], target[s]) for s in names}


def spark_text_hash(text):
    if text is None:
        return 42
    h = xxhash.xxh64_intdigest(text.encode(), 42)
    return h - (1 << 64) if h >> 63 else h


def walk(x, n, seed, source, round_):
    if n <= 1:
        return 0
    a = 1
    while a * a < n:
        a += 1
    b = -(-n // a)
    while True:
        left, right = divmod(x, b)
        for k in range(2):
            left = (left + spark_hash(0, seed, (source,), (round_,), 2 * k, (right,)) % a) % a
            right = (right + spark_hash(0, seed, (source,), (round_,), 2 * k + 1, (left,)) % b) % b
        x = left * b + right
        if x < n:
            return x


def table(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_equals_a_slow_mix(spark):
    words = lambda n, i: " ".join(f"w{i}-{k}" for k in range(n))
    rows = [(i, words((i * 37) % 90, i), [None, "hot", "hot", "b", "é", "hot", ""][i % 7]) for i in range(160)]
    rows += [(500, words(2000, 500), "hot"), (None, "no id here", "hot"), (3, None, "b"), (4, " \t", "only blank"), (7, "a b", "tiny"), (7, "a b", "tiny")]
    expected, facts = slow_mix(rows, 16)
    got = taken_words(table(spark, rows), block=16, shard=32).collect()
    sources = {}
    for (doc_id, text, source), n in zip(rows, expected):
        sources.setdefault((doc_id, len(WORDS.findall(text or "")), facts[source][0]), Counter())[n] += 1
    found = {}
    for r in got:
        found.setdefault((r.doc_id, r["size"], r.source_size), Counter())[r.taken] += 1
    assert found == sources
    assert len(got) == len(rows)
    assert all(r.taken <= 2 * r["size"] for r in got)
    for r in got:
        assert any(r.target == pytest.approx(t, abs=1e-6) for s, t in facts.values() if s == r.source_size)


def test_each_source_takes_its_target(spark):
    rows = [(i, " ".join(["x"] * (5 + i % 40)), f"s{i % 4 if i % 3 else 0}") for i in range(300)]
    got = taken_words(table(spark, rows), block=8, shard=16).toPandas()
    for target, part in got.groupby("target"):
        assert part.taken.sum() == int(target + 1e-9)


@pytest.mark.parametrize("n", [1, 2, 3, 7, 16, 17, 100, 1000])
def test_permutations_are_whole(spark, n):
    rows = spark.range(n).select(permuted(F.col("id"), F.lit(n).cast("long"), F.ceil(F.sqrt(F.lit(n))), F.lit(1), F.lit(2)).alias("to"))
    assert sorted(r.to for r in rows.collect()) == list(range(n))


def test_reruns_agree_whatever_the_partitions(spark):
    docs = table(spark, [(i, "a b c " * (i % 30), f"s{i % 3}") for i in range(120)])
    one = sorted(map(tuple, taken_words(docs.repartition(7), block=16).collect()))
    assert one == sorted(map(tuple, taken_words(docs.coalesce(1), block=16).collect()))


def test_shards_hold_multinomial_counts(spark):
    docs = table(spark, [(i, "a b c d e f g h " * 4, f"s{i % 3}") for i in range(300)])
    slots = mixed(docs, block=8, shard=50).slots
    counts = slots.groupBy("shard", "idx").count().toPandas()
    assert slots.groupBy("shard").count().filter("count > 50").count() == 0
    assert counts[counts.idx == 0]["count"].std() > 1  # draws, not equal portions


def test_texts_of_the_mix(spark):
    rows = [(i, " ".join(f"{i}.{k}" for k in range(i % 23)), "ab"[i % 2]) for i in range(60)] + [(5, " ".join(f"5.{k}" for k in range(5)), "b")]
    docs = table(spark, rows)
    texts = mixed_texts(docs, block=8).collect()
    uses = Counter(w.split(".")[0] for r in texts for w in r.text.split())
    taken = Counter()
    for r in taken_words(docs, block=8).collect():
        taken[str(r.doc_id)] += r.taken
    assert uses == +taken
    assert all(len(r.text.split()) <= 8 for r in texts)


def test_edge_rows_and_empty_table(corpus, edge_rows):
    got = taken_words(corpus(*edge_rows)).collect()
    assert len(got) == len(edge_rows)
    assert all(r.taken == 0 for r in got if r["size"] == 0)
    assert {r.source_size for r in got} == {sum(len(WORDS.findall(t or "")) for _, t in edge_rows)}
    assert taken_words(corpus()).collect() == []
    assert taken_words(corpus((1, None), (2, " "))).collect()[0].taken == 0
