import os
import subprocess
import sys

import corpus_pipeline
from pyspark.sql import functions as F

from textspark.llm import contamination, debruijn, encoding, langid, quality, suffixes

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SCRIPT = """
import sys
sys.path.insert(0, {root!r})
from textspark.session import local_session
from textspark.llm import alignment, collocations, contamination, mixing, quality
spark = local_session(2, "bare")
docs = spark.createDataFrame([(i, f"some plain words about number {{i}} and one more line of text", "en", "s") for i in range(30)],
                             "doc_id long, text string, lang string, source string")
labels = spark.createDataFrame([(i, i % 2) for i in range(30)], "doc_id long, quality int")
items = spark.createDataFrame([(1, "some plain words about number 7 and one more line of text")], "item_id long, text string")
print(quality.quality_scores(docs, labels).count(), contamination.contaminated(docs, items).count() > 0, mixing.language_scores(docs).count(),
      alignment.tokenizer_alignment(docs).count(), collocations.collocations(docs, least=5).count() > 0)
"""


def test_executors_need_not_have_the_package(tmp_path):
    """Workers of a session that only the driver's sys.path leads to the package."""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", SCRIPT.format(root=ROOT)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert done.stdout.split() == ["30", "True", "30", "30", "True"], done.stderr[-2000:]


def test_columns_with_the_names_used_inside(corpus):
    rows = corpus(*((i, f"a text of some words that is number {i}") for i in range(12)))
    docs = rows.withColumns({c: F.lit(5) for c in ("_text_read", "_new", "_matches_new", "_TEXT_READ_")})
    labels = rows.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"))
    model = quality.fit(quality.features(rows), labels)
    items = rows.filter("doc_id = 3").select(F.col("doc_id").alias("item_id"), "text")
    for out in (quality.with_quality(docs, model), contamination.with_matches(docs, items), encoding.encoded(docs)):
        got = out.collect()
        assert set(docs.columns) <= set(out.columns) and len(got) == 12
        assert all(r["_text_read"] == 5 and r["_new"] == 5 for r in got)


def test_span_operators_keep_columns_with_the_names_used_inside(corpus):
    span = " ".join(f"p{i}" for i in range(50))
    rows = corpus((1, f"a {span} b"), (2, f"c {span} d"), (3, None))
    names = ("_fp", "_text_read", "_spans", "_id", "_fp_cut", "_FP_")
    docs = rows.withColumns({c: F.lit(5) for c in names})
    for out in (suffixes.without_passages(docs), debruijn.without_repeats(docs)):
        got = {r.doc_id: r for r in out.collect()}
        assert out.columns == [*docs.columns, "n_words", "n_removed", "kept_sha256"]
        assert [got[i].n_removed for i in (1, 2, 3)] == [0, 50, 0] and got[2].text == "c d"
        assert all(r[c] == 5 for r in got.values() for c in names)
    mixed = corpus((1, "one two three", "en"), (2, "eins zwei drei", "de"), (5, "one more", "en")).withColumns({c: F.lit(5) for c in names})
    got = langid.predict(mixed, langid.learn(mixed))
    assert got.columns == [*(c for c in mixed.columns if c != "score"), "lang_pred", "score"] and {r._text_read for r in got.collect()} == {5}


def test_stage_keeps_the_columns_of_its_input(spark, corpus):
    span = " ".join(f"p{i}" for i in range(50))
    docs = corpus((1, f"a {span} b"), (2, f"c {span} d")).withColumns({c: F.lit(5) for c in ("n_words", "n_removed", "kept_sha256", "_fp", "_n_removed")})
    out = corpus_pipeline.without_repeated_passages(spark, docs, "")
    got = {r.doc_id: r for r in out.collect()}
    assert out.columns == docs.columns and (got[2].text, got[2].n_chars) == ("c d", 3)
    assert all(r[c] == 5 for r in got.values() for c in ("n_words", "n_removed", "kept_sha256", "_fp", "_n_removed"))
