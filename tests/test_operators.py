"""Operators against small rows and plain-Python references."""

import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from textspark.functions import clean, tokens
from textspark.functions.udf import map_column
from textspark.operators import (
    bayes, clusters, corpus, dense, evaluate, gradient, hierarchy, lexicon, phrases, sampling, sparse,
)
from textspark.operators.components import components
from textspark.plans import (
    durable, heavy_keys, lookup_join, row_index, split_join, top_k_per_group, union_rows,
)
from textspark.plans.ranking import group_index


def words(c):
    return tokens.word_tokens(c)


# Plans -------------------------------------------------------------------------------------------------------
def test_row_index_counts_in_order_with_ties_and_hot_values(spark):
    df = spark.range(1000).select(F.col("id"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("v"))
    rows = row_index(df, [F.col("v"), F.col("id")], "i").orderBy("i").collect()
    assert [r.i for r in rows] == list(range(1000))
    assert [(r.v, r.id) for r in rows] == sorted((r.v, r.id) for r in rows)


def test_group_index_splits_a_hot_group(spark):
    df = spark.range(500).select("id", F.when(F.col("id") < 400, "hot").otherwise("cold").alias("g"))
    rows = group_index(df, ["g"], [F.desc("id")], "i", size="n").collect()
    for group, size in (("hot", 400), ("cold", 100)):
        mine = sorted((r.i, -r.id, r.n) for r in rows if r.g == group)
        assert [m[0] for m in mine] == list(range(size)) and {m[2] for m in mine} == {size}
        assert mine == sorted(mine, key=lambda m: m[1])


@pytest.mark.parametrize("k", [3, 1500])
def test_top_k_per_group(spark, k):
    df = spark.range(4000).select(F.col("id"), (F.col("id") % 2).alias("g"))
    rows = top_k_per_group(df, ["g"], [F.desc("id")], k).collect()
    for g in (0, 1):
        mine = sorted(((r["rank"], r.id) for r in rows if r.g == g))
        want = sorted((i for i in range(4000) if i % 2 == g), reverse=True)[:k]
        assert mine == [(n, i) for n, i in enumerate(want, 1)]


def test_small_k_is_trimmed_before_the_shuffle(spark):
    df = spark.range(100).select("id", (F.col("id") % 2).alias("g"))
    plan = top_k_per_group(df, ["g"], [F.desc("id")], 3)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_lookup_join_gives_the_same_rows_either_way(spark):
    left = spark.range(3000).select("id", F.when(F.col("id") < 1000, "hot").otherwise(F.concat(F.lit("t"), F.col("id") % 700)).alias("k"))
    right = durable(spark.createDataFrame([("hot", 1)] + [(f"t{i}", i) for i in range(0, 700, 2)], "k string, v int"))
    counts = left.groupBy("k").agg(F.count("*").alias("n"))
    heavy = heavy_keys(counts, ["k"], "n", max_keys=3)
    assert [r.k for r in heavy.collect()] == ["hot"]
    for how in ("inner", "left"):
        want = sorted(map(str, left.join(right, "k", how).select("id", "k", "v").collect()))
        assert sorted(map(str, split_join(left, right, ["k"], heavy, how).select("id", "k", "v").collect())) == want
        assert sorted(map(str, lookup_join(left, right, ["k"], heavy, how).select("id", "k", "v").collect())) == want
        assert sorted(map(str, lookup_join(left, right, ["k"], heavy, how, max_bytes=0).select("id", "k", "v").collect())) == want


def test_union_of_equally_partitioned_inputs_groups_correctly(spark):
    a = spark.range(100).select((F.col("id") % 5).alias("k"), F.lit(1).alias("v")).repartition(4, "k")
    rows = union_rows(a, a).groupBy("k").agg(F.sum("v").alias("n")).collect()
    assert {r.k: r.n for r in rows} == {k: 40 for k in range(5)}


# Sparse ------------------------------------------------------------------------------------------------------
def _tfidf(spark, texts_, norm=None):
    df = spark.createDataFrame(list(enumerate(texts_)), "id bigint, text string")
    bow = sparse.bag_of_words(df, "id", words(F.col("text")))
    rows = sparse.tfidf(bow, sparse.fit_terms(bow), sparse.row_count(df))
    return sparse.normalize(rows, "id", norm)


def test_tfidf_example(spark):
    rows = _tfidf(spark, ["ha ha det var morsomt", "det var veldig veldig veldig bra"]).collect()
    got = {(r.id, r.term): round(r.value, 6) for r in rows}
    assert got == {
        (0, "ha"): 2.81093, (0, "det"): 1.0, (0, "var"): 1.0, (0, "morsomt"): 1.405465,
        (1, "det"): 1.0, (1, "var"): 1.0, (1, "veldig"): 4.216395, (1, "bra"): 1.405465,
    }


@pytest.mark.parametrize("norm,size", [("l2", lambda v: math.sqrt(sum(x * x for x in v))), ("l1", sum), ("max", max)])
def test_norms_are_one(spark, norm, size):
    per = defaultdict(list)
    for r in _tfidf(spark, ["aa bb bb", "bb cc dd", "aa"], norm).collect():
        per[r.id].append(r.value)
    assert all(abs(size(v) - 1) < 1e-12 for v in per.values())


def test_title_counts_twice(spark):
    df = spark.createDataFrame([(1, "Regn", "Mye regn faller nå")], "id int, title string, body string")
    rows = sparse.weighted_bag(df, "id", [(words(F.col("title")), 2), (words(F.col("body")), 1)]).collect()
    assert {r.term: r.n for r in rows} == {"regn": 3, "mye": 1, "faller": 1, "nå": 1}


def test_synonyms_fold_before_counting(texts):
    df = texts("Et foredrag om NLP", "Et foredrag om språkprosessering")
    text = clean.replace_patterns(F.col("text"), {"språkprosessering": "NLP"})
    stats = sparse.term_stats(sparse.bag_of_words(df, "id", words(text))).collect()
    assert {r.term: r.total for r in stats} == {"et": 2, "foredrag": 2, "om": 2, "nlp": 2}


def test_cosine_examples(texts):
    df = texts("språkprossesering", "prosessering av språk", "språkprosesering")
    pairs = df.sparkSession.createDataFrame([(0, 1), (0, 2)], "a bigint, b bigint")

    def cosines(t):
        rows = sparse.tf(sparse.bag_of_words(df, "id", t))
        return [round(r.cosine, 6) for r in sparse.cosine_pairs(rows, "id", pairs).orderBy("b").collect()]

    assert cosines(words(F.col("text"))) == [0.0, 0.0]
    assert cosines(tokens.char_ngrams(F.col("text"), 4, 4)) == [0.377964, 0.815374]


def test_prune_bounds_are_inclusive(spark):
    stats = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3), ("d", 4)], "term string, df bigint")
    kept = lambda lo, hi: sorted(r.term for r in sparse.prune(stats, F.lit(4), lo, hi).collect())
    assert kept(2, 1.0) == ["b", "c", "d"] and kept(1, 0.5) == ["a", "b"] and kept(0.5, 3) == ["b", "c"]


def test_vocabulary_ignores_unknown_terms(texts):
    bow = sparse.bag_of_words(texts("bb aa", "cc aa"), "id", words(F.col("text")))
    vocabulary = sparse.Vocabulary.fit(bow)
    new = sparse.bag_of_words(texts("aa zz cc cc"), "id", words(F.col("text")))
    assert {(r.term, r.idx, r.n) for r in vocabulary.transform(new).collect()} == {("aa", 0, 1), ("cc", 2, 2)}


# Phrases -----------------------------------------------------------------------------------------------------
COMMON = ["of", "the"]


def _greedy(words_, accepted):
    """Left-to-right merge over content words, in plain Python."""
    out, i = [], 0
    content = [j for j, w in enumerate(words_) if w not in COMMON]
    starts = {p: (p, q) for p, q in zip(content, content[1:]) if tuple(words_[p : q + 1]) in accepted}
    while i < len(words_):
        if i in starts:
            out.append("_".join(words_[i : starts[i][1] + 1]))
            i = starts[i][1] + 1
        else:
            out.append(words_[i])
            i += 1
    return out


def test_phrases_apply_like_a_greedy_scan(spark):
    rng = random.Random(5)
    sents = [[rng.choice("a b c d of the".split()) for _ in range(rng.randint(0, 14))] for _ in range(400)]
    accepted = {("a", "b"), ("b", "c"), ("c", "of", "d"), ("a", "a"), ("d", "the", "of", "a"), ("b", "b")}
    table = spark.createDataFrame([(phrases.JOINT.join(p), p[0], p[-1], 9) for p in accepted], "span string, a string, b string, n bigint")
    df = spark.createDataFrame([(i, 0, s) for i, s in enumerate(sents)], "id bigint, sent int, tokens array<string>")
    got = phrases.apply_phrases(df, "id", table, COMMON).orderBy("id").collect()
    shown = [[t.replace(phrases.JOINT, "_") for t in r.tokens] for r in got]
    assert shown == [_greedy(s, accepted) for s in sents]


def test_sentences_do_not_move_to_meet_phrases(spark, monkeypatch):
    """Looked up in the row, without a shuffle; a larger table is joined, with the same rows."""
    sents = [["a", "b"] * 60, ["a", "of", "b", "a", "b"], [], ["b", "a"], None]
    table = spark.createDataFrame([(phrases.JOINT.join(p), p[0], p[-1], 9) for p in (("a", "b"), ("b", "a"))], "span string, a string, b string, n bigint")
    df = spark.createDataFrame([(i, 0, s) for i, s in enumerate(sents)], "id bigint, sent int, tokens array<string>")
    inside = phrases.apply_phrases(df, "id", table, COMMON)
    plan = inside._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    monkeypatch.setattr(phrases, "MAX_KNOWN", 1)
    joined = phrases.apply_phrases(df, "id", table, COMMON)
    assert sorted(map(tuple, inside.collect()), key=lambda r: r[0]) == sorted(map(tuple, joined.collect()), key=lambda r: r[0])


def test_phrase_scores(spark):
    sents = ["new york is big", "new york of york", "bank of norway", "bank of norway new york"]
    df = spark.createDataFrame([(i, 0, s.split()) for i, s in enumerate(sents)], "id bigint, sent int, tokens array<string>")
    rows = phrases.learn_phrases(df, ["of"], min_count=1, threshold=0.5).collect()
    # words: new 3, york 4, is, big, bank 2, norway 2; pairs: new york 3, york is, is big, york of york, bank of norway 2, norway new
    assert {r.span.replace(phrases.JOINT, "_"): (r.n, round(r.score, 6)) for r in rows} == {
        "new_york": (3, round(2 * 12 / 12, 6)), "bank_of_norway": (2, round(1 * 12 / 4, 6))
    }


def test_sub_tokens(spark):
    j = phrases.JOINT
    df = spark.createDataFrame([(["a", "the", f"b{j}of{j}c", f"x{j}y{j}z", "raw_token"],)], "t array<string>")
    run = lambda lo, hi: [
        t.replace(j, "+") for t in df.select(phrases.sub_tokens(F.col("t"), COMMON, lo, hi, COMMON)).first()[0]
    ]
    assert run(1, 2) == ["a", "b", "c", "b+of+c", "x", "y", "z", "raw_token"]
    assert run(2, 3) == ["b+of+c", "x+y+z"]
    assert run(3, 3) == ["x+y+z"]


def test_trigrams_grow_from_bigrams(spark):
    df = spark.createDataFrame(
        [(i, 0, ["the", "new", "york", "times", f"w{i}"]) for i in range(10)], "id bigint, sent int, tokens array<string>"
    )
    model = phrases.PhraseModel(COMMON, min_count=2, threshold=0.1).fit(df, "id", max_n=3)
    counts = phrases.ngram_counts(model.transform(df, "id"), COMMON, 3).collect()
    assert {r.term: r.n for r in counts} == {"new_york_times": 10}


# Statistics and sampling -------------------------------------------------------------------------------------
def test_contrast_terms_against_python(spark):
    rows = [(True, "aa aa bb cc"), (False, "bb bb dd"), (True, "dd ee")]
    df = spark.createDataFrame(rows, "c boolean, text string")
    got = corpus.contrast_terms(df, F.col("c"), words(F.col("text"))).collect()
    inside, outside = Counter(), Counter()
    for c, t in rows:
        (inside if c else outside).update(t.split())
    terms = sorted(set(inside) | set(outside))
    precision = {t: inside[t] / (inside[t] + outside[t]) for t in terms}
    rank = lambda v, t: sum(v[o] < v[t] for o in terms) / (len(terms) - 1)
    for r in got:
        p, f = rank(precision, r.term), rank({t: inside[t] for t in terms}, r.term)
        want = 2 * p * f / (p + f) if p + f else 0.0
        assert abs(r.score - want) < 1e-12, r.term


def test_split_keeps_class_totals(spark):
    df = spark.range(1000).select("id", F.when(F.col("id") % 10 == 0, "rare").otherwise("often").alias("label"))
    rows = sampling.stratified_split(df, "label", "id", 0.1, 1).groupBy("label").agg(
        F.count("*").alias("n"), F.count_if("is_test").alias("t")
    ).collect()
    assert {r.label: (r.n, r.t) for r in rows} == {"rare": (100, 10), "often": (900, 90)}


def test_sample_drops_unlabelled_rows(spark):
    df = spark.createDataFrame([(i, None if i < 5 else "x") for i in range(20)], "id bigint, label string")
    assert sampling.stratified_sample(df, "label", "id", 8, 1).count() == 8
    assert sampling.stratified_sample(df, "label", "id", 80, 1).count() == 15


def test_batches(spark):
    rows = sampling.batch_numbers(spark.range(250), [F.col("id")], 100).groupBy("batch_no").count().collect()
    assert {r.batch_no: r["count"] for r in rows} == {0: 100, 1: 100, 2: 50}


def test_tree_paths_prune_subtrees_and_reject_cycles(spark):
    schema = "node_id int, parent_id int, name string"
    nodes = spark.createDataFrame([(1, None, "A"), (2, 1, "B"), (3, 2, "C"), (4, 1, "skip"), (5, 4, "D")], schema)
    rows = hierarchy.tree_paths(nodes, F.col("name") != "skip").collect()
    assert {r.path for r in rows} == {"A", "A > B", "A > B > C"}
    ring = spark.createDataFrame([(1, None, "A"), (2, 1, "B"), (1, 2, "A")], schema)
    with pytest.raises(ValueError):
        hierarchy.tree_paths(ring)


def test_change_audit(texts):
    df = texts("a b b c")
    rows = lexicon.change_audit(df, "id", F.split("text", " "), F.array(F.lit("b"), F.lit("d"))).collect()
    assert {r.term: r.delta for r in rows} == {"a": -1, "b": -1, "c": -1, "d": 1}


def test_texts_without_tokens_stay(texts):
    df = texts("x yy", "", "!!", None)
    rows = lexicon.token_positions(df, "id", F.split(F.regexp_replace("text", "[^a-z ]", ""), " "))
    rows = rows.filter("token IS NULL OR token <> ''").unionByName(lexicon.token_positions(df.filter("text = '!!'"), "id", F.array().cast("array<string>")))
    assert sorted((r.id, r.text) for r in lexicon.join_tokens(rows, "id").collect()) == [(0, "x yy"), (2, ""), (3, "")]


def test_names_keep_their_capital(texts):
    df = texts("I dag kom Ola hjem. Han sa hei til Kari.", "Er Ola her? Nei, han er ute.")
    names = durable(lexicon.proper_names(df, F.col("text")))
    out = lexicon.join_tokens(lexicon.lower_keep_names(df, "id", F.col("text"), names), "id").orderBy("id").collect()
    assert [r.text for r in out] == ["i dag kom Ola hjem han sa hei til Kari", "er Ola her nei han er ute"]


def test_python_function_over_a_column(texts):
    rows = map_column(texts("ab", None), "text", lambda s: len(s), "int", "n", partitions=2).orderBy("id").collect()
    assert [r.n for r in rows] == [2, None]


# Dense -------------------------------------------------------------------------------------------------------
@pytest.fixture
def vectors(spark):
    rows = [("king", [1.0, 1.0]), ("man", [1.0, 0.0]), ("woman", [0.0, 1.0]), ("zero", [0.0, 0.0]), ("queen", [0.1, 1.0])]
    return durable(spark.createDataFrame(rows, "word string, embedding array<float>"))


def test_most_similar_leaves_the_word_out(vectors):
    rows = dense.most_similar(vectors, ["woman"], 2).orderBy("rank").collect()
    assert [(r.query, r.word) for r in rows] == [("woman", "queen"), ("woman", "king")]


def test_analogy_and_unknown_words(vectors):
    rows = dense.analogy(vectors, ["king", "woman"], ["man"], 1).collect()
    assert [r.word for r in rows] == ["queen"]
    with pytest.raises(Exception, match="no embedding"):
        dense.analogy(vectors, ["king", "nobody"], [], 1).collect()


def test_unknown_seed_is_reported(vectors):
    rows = dense.neighbourhoods(vectors, ["man", "nobody"], 2).collect()
    assert sorted((r.grp, r["rank"], r.found) for r in rows) == [(0, 0, True), (0, 1, True), (0, 2, True), (1, 0, False)]


def test_pooling_and_document_vectors(spark, vectors):
    weights = spark.createDataFrame([(1, "man", 2), (1, "king", 1), (1, "nope", 9), (2, "nope", 1)], "id int, word string, weight int")
    pooled = dense.pool(weights, vectors, "id", ["sum", "max", "min"]).collect()
    assert [(r.id, r["sum"], r["max"], r["min"]) for r in pooled] == [(1, [3.0, 1.0], [1.0, 1.0], [1.0, 0.0])]
    docs = spark.createDataFrame([(1,), (2,)], "id int")
    rows = {r.id: r.vector for r in dense.document_vectors(weights, vectors, docs, "id").collect()}
    assert rows[2] == [0.0, 0.0] and abs(rows[1][0] - 3 / math.sqrt(10)) < 1e-12


def _dbscan(points, eps, m):
    near = [[j for j, q in enumerate(points) if (p[0] - q[0]) ** 2 + (p[1] - q[1]) ** 2 <= eps * eps] for p in points]
    core = [len(n) >= m for n in near]
    label = {i: i for i, c in enumerate(core) if c}
    changed = True
    while changed:
        changed = False
        for i in label:
            low = min(label[j] for j in near[i] if core[j])
            if low < label[i]:
                label[i], changed = low, True
    out = {i: (c, True) for i, c in label.items()}
    for i, n in enumerate(near):
        if not core[i] and any(core[j] for j in n):
            out[i] = (min(label[j] for j in n if core[j]), False)
    return out


@pytest.mark.parametrize("direct,hot", [(4096, 10_000), (4, 5)])
def test_density_clusters_against_brute_force(spark, monkeypatch, direct, hot):
    """The second case forces box splitting and slicing of crowded cells; a third of all points are copies."""
    monkeypatch.setattr(clusters, "_DIRECT_PAIRS", direct)
    monkeypatch.setattr(clusters, "_HOT_CELL", hot)
    rng = random.Random(3)
    points = [(rng.gauss(cx, 0.3), rng.gauss(0, 0.3)) for cx in (0, 1.2, 6) for _ in range(35)]
    points += [(rng.uniform(-3, 9), rng.uniform(-3, 3)) for _ in range(30)] + [(0.5, 0.5)] * 60
    df = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(points)], "id bigint, x double, y double")
    rows = clusters.density_clusters(df, 0.3, 5).collect()
    assert len(rows) == len({r.id for r in rows})
    assert {r.id: (r.cluster, r.is_core) for r in rows} == _dbscan(points, 0.3, 5)


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, j) for j in range(101, 120)]
    nodes = spark.createDataFrame([(i,) for i in sorted({x for e in edges for x in e} | {500})], "node bigint")
    rows = components(nodes, spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    assert {r.node: r.component for r in rows} == {
        **{i: 0 for i in range(31)}, **{i: 100 for i in range(100, 120)}, 500: 500
    }


# Models ------------------------------------------------------------------------------------------------------
def test_report_and_confusion(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b"), ("c", "a")], "label string, prediction string")
    report = {r.cls: r for r in evaluate.class_report(df).collect()}
    assert (report["a"].precision, report["a"].recall, report["a"].support) == (0.5, 0.5, 2)
    assert (report["c"].precision, report["c"].recall, report["c"].f1) == (0.0, 0.0, 0.0)
    assert abs(report["macro avg"].recall - 0.5) < 1e-12 and report["weighted avg"].support == 4
    cells = {(r.label, r.prediction): r.share for r in evaluate.confusion(df).collect()}
    assert len(cells) == 9 and cells[("a", "b")] == 0.5 and cells[("c", "b")] == 0.0


def test_report_agrees_with_mllib(spark):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator

    df = spark.range(200).select((F.col("id") % 3).cast("double").alias("label"), (F.col("id") % 7 % 3).cast("double").alias("prediction"))
    report = {r.cls: r for r in evaluate.class_report(df).collect()}
    weighted = MulticlassClassificationEvaluator(metricName="weightedPrecision").evaluate(df)
    assert abs(report["weighted avg"].precision - weighted) < 1e-9


def test_bayes_explanations_add_up(texts):
    df = texts("aa bb bb", "aa cc", "dd bb", "")
    labels = df.select("id", F.when(F.col("id") < 2, "x").otherwise("y").alias("label"))
    bow = sparse.bag_of_words(df, "id", words(F.col("text")))
    model = bayes.NaiveBayes.fit(bow, labels, "id")
    scores = {(r.id, r.label): r.score for r in model.scores(bow, df, "id").collect()}
    sums = defaultdict(float)
    for r in model.explain(bow, df, "id", 2).collect():
        sums[r.id, r.label] += r.contribution
    assert scores.keys() == sums.keys() and all(abs(scores[k] - sums[k]) < 1e-9 for k in scores)
    # V = 4, class x: 5 tokens, class y: 2
    assert abs(scores[0, "x"] - (math.log(0.5) + math.log(3 / 9) + 2 * math.log(3 / 9))) < 1e-9


def test_gradient_descent_matches_plain_loop(spark):
    points = [(0.1, 0.9, 0.0), (0.8, 0.2, 1.0), (0.4, 0.6, 0.0), (0.9, 0.5, 1.0)]
    df = spark.createDataFrame(points, "x double, y double, t double")
    seen = []
    got = gradient.fit(df, ["x", "y"], "t", lr=0.5, w=[0.1, -0.2, 0.0], max_iter=4, callback=lambda i, w, g: seen.append(i))
    w = [0.1, -0.2, 0.0]
    for _ in range(4):
        grad = [0.0, 0.0, 0.0]
        for x, y, t in points:
            p = 1 / (1 + math.exp(-(w[0] * x + w[1] * y + w[2])))
            for j, v in enumerate((x, y, 1.0)):
                grad[j] += (p - t) * p * (1 - p) * v / len(points)
        w = [a - 0.5 * g for a, g in zip(w, grad)]
    assert seen == [0, 1, 2, 3] and all(abs(a - b) < 1e-12 for a, b in zip(got, w))
    assert gradient.boundary([1.0, -1.0, 0.0]) == (1.0, 0.0)


def test_python_results_are_made_slice_by_slice():
    """An Arrow batch of long texts is not answered at once."""
    import pandas as pd

    from textspark.functions import udf

    values = pd.Series([None if i % 7 == 0 else f"t{i}" for i in range(udf.SLICE_ROWS * 2 + 5)])
    out = list(udf.sliced(lambda t: [t])(iter([values, values.iloc[:0]])))
    assert [len(o) for o in out] == [udf.SLICE_ROWS, udf.SLICE_ROWS, 5, 0]
    assert [None if v is None else v[0] for o in out for v in o] == list(values)


def test_phrases_are_merged_and_counted_over_arrays(spark):
    """Merging and the bag run over whole batches, not in a lambda a word; nulls, bridges and merged tokens of a first level."""
    j = phrases.JOINT
    rows = [(1, 0, ["new", "york", "of", "new", "york", "city"]), (1, 1, ["new", "york"]), (2, 0, None), (2, 1, ["bank", None, "of", "oslo", "new"]), (2, 2, []), (3, 0, ["york", "new", f"new{j}york", "city"])]
    sents = spark.createDataFrame(rows, "id bigint, sent int, tokens array<string>").coalesce(1)
    table = [(f"new{j}york", "new", "york", 9), (f"bank{j}of{j}oslo", "bank", "oslo", 7), (f"york{j}of{j}new", "york", "new", 6), (f"new{j}york{j}city", f"new{j}york", "city", 5)]
    found = spark.createDataFrame(table, "span string, a string, b string, n long").localCheckpoint()
    merged = phrases.apply_phrases(sents, "id", found, ["of"])
    assert {(r.id, r.sent): r.tokens for r in merged.collect()} == {
        (1, 0): [f"new{j}york", "of", f"new{j}york", "city"], (1, 1): [f"new{j}york"], (2, 0): None,
        (2, 1): [f"bank{j}of{j}oslo", "new"], (2, 2): [], (3, 0): ["york", "new", f"new{j}york{j}city"],
    }
    bag = phrases.phrase_bag(merged, "id", ["of"], (1, 2), stop=["of"])
    want = {(1, "new"): 3, (1, "york"): 3, (1, "new_york"): 3, (1, "city"): 1, (2, "bank"): 1, (2, "oslo"): 1, (2, "bank_of_oslo"): 1, (2, "new"): 1, (3, "york"): 2, (3, "new"): 2, (3, "city"): 1}
    assert {(r.id, r.term): r.n for r in bag.collect()} == want
    assert "lambda" not in bag._jdf.queryExecution().toString()
