"""The five stages one after another on the smallest tables, each against what it promises."""

import corpus_pipeline
import sentencepiece

from textspark.llm import contamination, encoding, near, quality
from textspark.sources.tables import read_table

SMALL = "/root/testdata/sf0.001"


def test_pipeline_keeps_and_rejects(spark):
    docs = read_table(spark, SMALL, "documents")
    out = corpus_pipeline.run(spark, SMALL)
    columns = docs.columns
    assert out.columns[: len(columns)] == columns
    rows = {r.doc_id: r for r in out.collect()}
    labels = read_table(spark, SMALL, "labels")
    model = quality.fit(quality.features(docs.filter(~quality.held_out())), labels)
    good = quality.with_quality(docs, model).filter("quality_score >= 0.5").select(*columns)
    groups = {r.doc_id: r.kept for r in near.near_duplicates(good).collect()}
    unique = {i for i, kept in groups.items() if kept}
    leaks = {r.doc_id for r in contamination.contaminated(docs, read_table(spark, SMALL, "benchmark")).collect()}
    # A leaked passage that an earlier document holds as well may have been cut out before.
    assert set(rows) <= unique and unique - set(rows) <= leaks
    theirs = sentencepiece.SentencePieceProcessor(model_file=encoding.DEFAULT_MODEL)
    assert all(r.parity and r.round_trip and r.token_ids == theirs.encode(r.text) and r.n_chars == len(r.text) for r in rows.values())


def test_stages_take_edge_rows(spark, corpus, edge_rows):
    for rows in (edge_rows, []):
        docs = corpus(*rows)
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SMALL)
            assert out.columns[: len(docs.columns)] == docs.columns, name
            assert out.count() <= docs.count()
