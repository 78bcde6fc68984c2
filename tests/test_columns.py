"""Cleaners, labels and tokenisers on literal rows."""

import re

import pytest
from pyspark.sql import functions as F

from textspark.functions import clean, labels, patterns, tokens
from textspark.functions.arrays import cosine, unit, value_counts

EDGES = [None, "", "   ", "x", "é", "x²", "a b", "a_b", "$1 \\ $"]


def test_keywords_are_replaced_once_longest_first(column):
    table = {"sea": "lake", "fog": "sea", "salt water": "SW", "salt water pool": "SWP"}
    text = "Sea fog! Seaside, öfog, Salt Water pools and salt water pool"
    got = column(lambda c: clean.replace_keywords(c, table), text)
    assert got == ["lake sea! Seaside, öfog, SW pools and SWP"]


def test_keywords_case_sensitive_and_symbols(column):
    got = column(lambda c: clean.replace_keywords(c, {"Rain": "wet", "->": "to"}, case_sensitive=True), "rain Rain -> !->")
    assert got == ["rain wet to !to"]


def test_keyword_output_is_literal(column):
    assert column(lambda c: clean.replace_keywords(c, {"a": "$1\\"}), "a b") == ["$1\\ b"]


def test_pattern_groups_run_in_first_seen_order(column):
    rules = [("a", "b"), ("c", "d"), ("b", "c"), ("z", "b")]
    # a and z become b together, then c becomes d, then every b becomes c
    assert column(lambda c: clean.replace_patterns(c, rules), "abcz") == ["ccdc"]


def test_pattern_backreference_is_translated(column):
    assert column(lambda c: clean.replace_patterns(c, [(r"(\d+)-(\d+)", r"\2$\g<1>")]), "12-34") == ["34$12"]


def test_stop_patterns(column):
    got = column(lambda c: clean.remove_stop_patterns(c, [r"sten\p{L}*"]), "To stener, stenen; ny sten")
    assert got == ["To  ,  ; ny  "]


def test_stopwords_become_spaces(column):
    assert column(lambda c: clean.remove_stopwords(c, ["og", "på"]), "På tak og mur.") == ["  tak   mur."]


def test_punctuation(column):
    assert column(clean.strip_punctuation, "Regn?? Ja, mye!") == ["Regn   Ja  mye "]


def test_whitespace_matches_python_split(column):
    values = [v for v in EDGES if v is not None] + ["a b\x1cc\x85d\n e "]
    assert column(clean.squeeze_whitespace, *values) == [" ".join(v.split()) for v in values]


def test_tidy_body_matches_the_rule(column):
    values = ["  a \n\n\n\n b\n\nc ", "a\n \n\n\nb", "\n\n\n"]
    want = [re.sub(r"\s*\n{3,}\s*", "\n\n", v.strip()) for v in values]
    assert column(clean.tidy_body, *values) == want


def test_urls_functions_and_marks(column):
    assert column(clean.mask_urls, "kart på https://a.no/x?y=1 i dag") == ["kart på [URL BLOCKED] i dag"]
    assert column(lambda c: clean.replace_by_function(c, "is", F.upper), "grus, gris og isis") == [
        "grus, grIS og ISIS"
    ]
    assert column(lambda c: clean.mark_matches(c, "a.b"), "a.b axb") == ["«a.b» axb"]
    assert column(lambda c: clean.mark_matches(c, "a.b", True, "[$", "]"), "a.b axb") == ["[$a.b] [$axb]"]


@pytest.mark.parametrize(
    "cleaner",
    [
        lambda c: clean.replace_keywords(c, {"q": "r"}),
        lambda c: clean.replace_patterns(c, {"q": "r"}),
        clean.lowercase,
        lambda c: clean.replace_by_function(c, "q", F.upper),
        lambda c: clean.mark_matches(c, "q"),
    ],
)
def test_edge_rows_pass_through(column, cleaner):
    assert column(cleaner, *EDGES) == EDGES


def test_several_columns_are_cleaned_and_others_left(spark):
    df = spark.createDataFrame([(1, "A", "B")], "n int, a string, b string")
    got = clean.clean_columns(df, ["n", "a", "b"], clean.lowercase).first()
    assert tuple(got) == (1, "a", "b")


def test_label_paths(spark):
    df = spark.createDataFrame([(["A", "B", "C"],)], "labels array<string>")
    path = lambda n: df.select(labels.label_path(F.col("labels"), n)).first()[0]
    assert [path(0), path(1), path(-1), path(None)] == ["A", "A > B", "A > B > C", ["A", "B", "C"]]
    deep = spark.createDataFrame([([str(i) for i in range(25)],)], "labels array<string>")
    assert deep.select(labels.label_path(F.col("labels"), -1)).first()[0].count(" > ") == 24


def test_matching_and_skipping(column):
    url = r"https?://\S+"
    texts = ("https://a.b", "se https://a.b nå", "ingen")
    assert column(lambda c: labels.starts_with_pattern(c, url), *texts) == [True, False, False]
    assert column(lambda c: labels.first_match(c, url), *texts) == ["https://a.b", "https://a.b", None]
    names = ("Old stock", "Tools [moved]", "Tools")
    keep = lambda c: labels.allowed_name(c, ["Old stock"], [r".*\[moved\]$"])
    assert column(keep, *names) == [False, False, True]


def test_prefix_category_last_rule_wins(column):
    assert column(lambda c: labels.prefix_category(c, {"a": "1", "ab": "2"}), "abc", "ac", "x") == ["2", "1", None]


def test_tokenisers(column):
    assert column(tokens.symbol_tokens, "Båten går nå ->") == [["båten", "går", "nå", "->"]]
    assert column(tokens.word_tokens, "språk på x² i") == [["språk", "på", "x²"]]
    assert column(tokens.alnum_tokens, "a_b c-D") == [["a", "b", "c", "D"]]
    assert column(tokens.raw_tokens, None, "") == [None, []]


def test_sentences_keep_abbreviations_together(column):
    text = "Toget kom sent. Hvorfor det? Det var bl.a. is på sporet."
    assert column(tokens.sentences, text) == [["Toget kom sent.", "Hvorfor det?", "Det var bl.a. is på sporet."]]
    assert column(tokens.sentences, "", "  ", "a") == [[], [], ["a"]]


def test_word_ngrams_against_loop(column):
    def loop(words, low, high):
        return [" ".join(words[i : i + n]) for n in range(low, high + 1) for i in range(len(words) - n + 1)]

    values = ["", "aa", "aa bb", "aa bb cc dd ee"]
    for low, high in [(1, 1), (1, 3), (2, 2), (2, 4)]:
        got = column(lambda c: tokens.word_ngrams(tokens.word_tokens(c), low, high), *values)
        assert got == [loop(v.split(), low, high) for v in values]


def test_ngrams_stay_inside_sentences(column):
    text = "Vi ror hjem. Vinden snur."
    assert "hjem vinden" in column(lambda c: tokens.word_ngrams(tokens.word_tokens(c), 2, 2), text)[0]
    assert "hjem vinden" not in column(lambda c: tokens.sentence_ngrams(c, tokens.word_tokens, 2, 2), text)[0]


def test_char_ngrams(column):
    assert column(lambda c: tokens.char_ngrams(c, 4, 4), "Ny, Kari?", "nye", None) == [
        ["ny, ", "y, k", ", ka", " kar", "kari", "ari?"], [], None,
    ]
    assert column(lambda c: tokens.char_ngrams(c, 2, 2), "a😀b")[0] == ["a😀", "😀b"]
    assert column(lambda c: tokens.char_wb_ngrams(c, 4, 5), "a bcd") == [[" a ", " bcd", "bcd ", " bcd "]]


def test_value_counts_against_python(column):
    from collections import Counter

    values = ["", "a", "b a b c b a", "x x x"]
    got = column(lambda c: value_counts(F.filter(F.split(c, " "), lambda t: t != "")), *values)
    assert [{r.term: r.n for r in rows} for rows in got] == [dict(Counter(v.split())) for v in values]


def test_vectors(spark):
    row = spark.createDataFrame([([3.0, 4.0], [0.0, 0.0])], "a array<double>, b array<double>").select(
        unit(F.col("a")), unit(F.col("b")), cosine(F.col("a"), F.col("a")), cosine(F.col("a"), F.col("b"))
    ).first()
    assert list(row) == [[0.6, 0.8], [0.0, 0.0], 1.0, None]


def test_text_features(column):
    row = column(labels.text_features, "HEI du, tall 42!")[0]
    assert (row.n_chars, row.n_words) == (16, 4)
    assert (row.caps_share, row.punct_share, row.digit_share) == (0.25, 0.5, 0.5)


def test_quoting():
    assert patterns.quote("a.b(c)") == r"a\.b\(c\)"
    assert patterns.java_replacement(r"\1-\\-$") == r"$1-\\-\$"
