"""Readers, pages, ingest, ML pipelines, and plan checks."""

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from textspark.catalog import QUERIES, SQL, load_all
from textspark.functions import tokens
from textspark.operators import learn
from textspark.plans.stages import CleanerStage, ColumnStage, TokenStage
from textspark.sources import pages, posts
from textspark.streaming import ingest

SF = "/root/testdata/sf0.001"


def test_posts_round_trip(spark, tmp_path):
    rows = [(1, "2020-01-02T03:04:05+00:00", "a", "T", "B", ["X", "Y"], "bad time")]
    posts.append_posts(spark.createDataFrame(rows, posts.POST), f"{tmp_path}/p", "json")
    got = posts.read_posts(spark, f"{tmp_path}/p", -1).first()
    assert (got.label, got.text, got.create_time.year, got.scrape_time) == ("X > Y", "T\n\nB", 2020, None)
    assert [r.topic_id for r in posts.read_ledger(spark, f"{tmp_path}/p", "json").collect()] == [1]


def test_missing_ledgers_are_empty(spark, tmp_path):
    assert posts.read_ledger(spark, f"{tmp_path}/none").count() == 0
    assert posts.read_id_file(spark, f"{tmp_path}/none.txt").count() == 0


def test_id_file_of_space_separated_ids(spark, tmp_path):
    (tmp_path / "ids.txt").write_text("1 22 333 ")
    assert sorted(r.topic_id for r in posts.read_id_file(spark, f"{tmp_path}/ids.txt").collect()) == [1, 22, 333]


def test_dump_finds_nested_files_by_name(spark, tmp_path):
    for folder, name in (("AA", "wiki_00"), ("AB/x", "wiki_01"), ("AB", "other")):
        (tmp_path / folder).mkdir(parents=True, exist_ok=True)
        (tmp_path / folder / name).write_text('{"id": "%s", "text": "t"}\n' % name)
    assert sorted(r.id for r in posts.read_dump(spark, str(tmp_path)).collect()) == ["wiki_00", "wiki_01"]


def test_malformed_embedding_lines_are_counted(spark):
    lines = spark.createDataFrame([("a 1 2.5",), ("b 1",), ("c 1 x",), ("d 1 2 3",)], "value string")
    rows = {r.word: (r.embedding, r.malformed) for r in posts.parse_embedding_lines(lines, 2).collect()}
    assert rows == {"a": ([1.0, 2.5], False), "b": (None, True), "c": (None, True), "d": (None, True)}


HTML = (
    "<h1>T</h1><article>start<!-- no --><p>one <b>bold</b> two<br>three</p><div>gone</div>"
    "<ol><li>x</li><li>y <em>z</em></li></ol><span><b>only bold</b></span><p class='edit'>edited</p>&amp; end</article>"
)
BODY = "start" + "one  two\nthree" + "1. x\n2. y z\n\n" + "only bold" + "& end"


def test_pages(spark):
    odd = "<article>a<h2>H2</h2><h1>H1</h1><p><b>only</b></p><p class='x edit'>ED</p><i>it</i><code>co</code><nav><ul><li>n</li></ul></nav>&copy;&#233;&#x1F600;&nope;</article>"
    df = spark.createDataFrame(
        [(1, "http://a.b/c/7", HTML), (2, "x", None), (3, "y", odd), (4, "z", "<p>no container</p>")], "page_id bigint, url string, html string"
    )
    rows = {r.page_id: r for r in pages.page_posts(df).collect()}
    assert (rows[1].title, rows[1].body, rows[1].topic_id, rows[1].host) == ("T", BODY, 7, "a.b")
    assert rows[2].body is None and rows[4].body == ""
    assert rows[3].body == "aH2H1only\xa9\xe9\U0001f600&nope;"


def test_pages_nest_to_any_depth(column):
    deep = lambda n, tag="div": "".join(f"<{tag}>{i}" for i in range(n)) + f"</{tag}>" * n
    pages_of = {
        f"<article>x{deep(5)}y{deep(40)}z</article>": "xyz",
        f"<article><p>{deep(12, 'b')}</p></article>": "".join(map(str, range(12))),
        "<article><span>a<span>b<span>c<span>d<span>e<span>f</span></span></span></span></span></span></article>": "abcdef",
        "<article>x<div class='edit'>a<div>b</div>c</div>y</article>": "xy",
        "<article><ul><li>a<ul><li>b</li></ul></li><li>c</li></ul>z</article>": "1. ab\n2. b\n3. c\n\nz",
        "<article>x<article>in</article><div>open<p>q</div>y<a title='1>0'>w</a><script>if (a<b) {}</script> 1 < 2</article>": "xyw 1 < 2",
    }
    assert column(pages.body_text, *pages_of) == list(pages_of.values())


def test_ids_from_urls(column):
    urls = ("http://a/index.php?showforum=12&page=3", "http://a/x")
    assert column(pages.query_id, *urls) == [12, None]
    assert column(pages.last_piece_id, "tid-link-345", "none") == [345, None]


def test_ingest_is_restartable(spark, tmp_path):
    inbox, out, progress = (f"{tmp_path}/{n}" for n in ("inbox", "out", "progress"))
    rows = lambda lo, hi: spark.range(lo, hi).select("id", F.lit("X").alias("v"))
    rows(0, 50).write.parquet(f"{inbox}/a")
    run = lambda: ingest.ingest_stream(
        spark, f"{inbox}/*", rows(0, 1).schema, out, progress, "id", [F.col("id")],
        clean=lambda df: df.withColumn("v", F.lower("v")), files_per_batch=2,
    )
    progressed = run()
    assert sum(p["rows"] for p in progressed) == 50
    run()
    rows(40, 60).write.parquet(f"{inbox}/b")
    run()
    got = spark.read.parquet(out)
    assert got.count() == 60 and got.select("id").distinct().count() == 60 and got.filter("v <> 'x'").count() == 0


def test_every_batch_is_reported(spark, tmp_path):
    """More batches than the query itself remembers."""
    for i in range(4):
        spark.range(3 * i, 3 * i + 3).coalesce(1).write.parquet(f"{tmp_path}/in/{i}")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "1")
    try:
        batches = ingest.ingest_stream(
            spark, f"{tmp_path}/in/*", spark.range(1).schema, f"{tmp_path}/out", f"{tmp_path}/at", "id", [F.col("id")], files_per_batch=1
        )
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    assert [b["rows"] for b in batches] == [3, 3, 3, 3] and [b["batch_id"] for b in batches] == [0, 1, 2, 3]


def test_repeating_a_batch_changes_nothing(spark, tmp_path):
    for _ in range(2):
        ingest.ingest_batch(spark.range(5), f"{tmp_path}/t", "id", [F.col("id")], batch_id=0)
    ingest.ingest_batch(spark.range(8), f"{tmp_path}/t", "id", [F.col("id")], batch_id=1)
    rows = spark.read.parquet(f"{tmp_path}/t").groupBy("batch_id").count().collect()
    assert {r.batch_id: r["count"] for r in rows} == {0: 5, 1: 3}


def test_first_seen_and_quota(spark):
    df = spark.createDataFrame([(1, 5, "b"), (1, 3, "a"), (2, 1, "c"), (3, 1, "c")], "k int, t int, g string")
    assert sorted(tuple(r) for r in ingest.first_seen(df, "k", [F.col("t")]).collect()) == [(1, 3, "a"), (2, 1, "c"), (3, 1, "c")]
    ledger = spark.createDataFrame([(2,)], "k int")
    rows = ingest.ingest_once(df, ledger, "k", [F.col("t")], "g", 1)
    assert sorted(r.k for r in rows.collect()) == [1, 3]


def test_streaming_first_seen_with_a_watermark(spark, tmp_path):
    rows = spark.range(10).select((F.col("id") % 4).alias("k"), F.timestamp_seconds("id").alias("ts"))
    rows.write.parquet(f"{tmp_path}/in")
    stream = ingest.first_seen_stream(spark.readStream.schema(rows.schema).parquet(f"{tmp_path}/in"), "k", "ts", "1 hour")
    query = stream.writeStream.format("memory").queryName("firsts").trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.table("firsts").count() == 4


# ML pipelines ------------------------------------------------------------------------------------------------
@pytest.fixture(scope="module")
def fitted(spark):
    data = spark.createDataFrame(
        [(i, t, l) for i, (t, l) in enumerate([("aa bb http://x.y", "p"), ("aa cc", "p"), ("dd ee", "q"), ("dd bb", "q"), ("ff gg", "r"), ("ff bb", "r")])],
        "id bigint, text string, label string",
    )
    cleaning = [CleanerStage(inputCols=["text"], outputCols=["text"], steps=[["mask_urls", {"mask": " "}], ["lowercase", {}]])]
    stage = TokenStage(inputCol="text", outputCol="tokens", analyzer="word")
    model = learn.text_classifier(data, cleaning, learn.tfidf_stages(stage), learn.logistic_regression(6))
    return data, model


def test_pipeline_predicts_and_survives_saving(spark, fitted, tmp_path):
    data, model = fitted
    first = {r.id: r.predicted for r in learn.predict(model, data).collect()}
    assert first == {r.id: r.label for r in data.collect()}
    model.write().overwrite().save(f"{tmp_path}/m")
    again = PipelineModel.load(f"{tmp_path}/m")
    assert {r.id: r.predicted for r in learn.predict(again, data).collect()} == first
    assert learn.predict(again, spark.createDataFrame([("zz dd",)], "text string")).first().predicted == "q"


def test_linear_explanations_add_up_to_the_raw_score(spark, fitted):
    data, model = fitted
    cleaned = model.stages[0].transform(data)
    rows = learn.explain_linear(model, cleaned, "id", tokens.word_tokens(F.col("text")), 3)
    sums = {(r.id, r.label): r.s for r in rows.groupBy("id", "label").agg(F.sum("contribution").alias("s")).collect()}
    raw = model.transform(data).select("id", "rawPrediction").collect()
    labels = ["p", "q", "r"]
    assert len(sums) == 18
    assert all(abs(sums[r.id, l] - r.rawPrediction[i]) < 1e-9 for r in raw for i, l in enumerate(labels))


def test_top_classes_are_kept_whole(spark, fitted):
    data, model = fitted
    rows = learn.explain_linear(model, model.stages[0].transform(data), "id", tokens.word_tokens(F.col("text")), 2)
    assert {r.n for r in rows.groupBy("id").agg(F.count_distinct("label").alias("n")).collect()} == {2}


def test_rows_to_fit_are_bounded_per_class(spark):
    df = spark.createDataFrame([(i, "ab"[i % 2] if i < 30 else None) for i in range(40)], "id int, label string")
    assert learn.fit_rows(df, "label", "id").count() == 30
    counts = learn.fit_rows(df, "label", "id", per_class=4).groupBy("label").count().collect()
    assert {r.label: r["count"] for r in counts} == {"a": 4, "b": 4}
    assert [learn.embedding_partitions(n) for n in (0, 20_000, 20_001)] == [1, 1, 2]


def test_smooth_idf_equals_the_long_form(spark, fitted):
    data, model = fitted
    idf = {r.term: r.idf for r in learn.fitted_idf(model, data).collect()}
    import math

    assert abs(idf["bb"] - (math.log(7 / 4) + 1)) < 1e-12 and abs(idf["ee"] - (math.log(7 / 2) + 1)) < 1e-12


def test_column_stage_runs_user_code(texts):
    out = ColumnStage(lambda c: F.reverse(c), ["text"], ["back"]).transform(texts("abc")).first()
    assert out.back == "cba"


def test_fits_show_predictions_and_explanations(spark, tmp_path):
    """Every held-out row is predicted, every document explained, and a label without held-out rows is not called accurate."""
    words = {"xx": "aa bb cc dd", "yy": "ee ff gg hh", "zz": "ii jj kk ll"}
    rows = [(i, f"{w} {w.split()[i % 4]}", k) for k, (lang, w) in enumerate(words.items()) for i in range(20 * k, 20 * k + (4 if lang == "zz" else 20))]
    rows = [(i, t, list(words)[k]) for i, t, k in rows]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    docs.withColumns({"source": F.lit("s"), "n_chars": F.length("text").cast("bigint")}).write.parquet(f"{tmp_path}/documents.parquet")
    run = lambda name: QUERIES[name](spark, str(tmp_path)).collect()
    assert {r.label: r.accurate for r in run("logreg_fit")} == {"xx": True, "yy": True, "zz": None}
    assert sorted((r.label, r.predicted) for r in run("logreg_fit_predictions")) == [("xx", "xx")] * 2 + [("yy", "yy")] * 2
    report = sorted(tuple(r) for r in run("logreg_fit_report"))
    assert report == [("xx", 18, 2, 1.0, "xx", 2), ("yy", 18, 2, 1.0, "yy", 2), ("zz", 4, 0, None, None, None)]
    sums = run("explain_sums")
    assert len({r.doc_id for r in sums}) == len(rows) and len(sums) == 3 * len(rows)
    assert all(abs(r["sum"] - r.score) < 1e-6 for r in sums)
    assert {r.doc_id for r in run("explain_terms")} == {i for i, _, _ in rows}


# Queries and plans -------------------------------------------------------------------------------------------
load_all()
PYTHON_QUERIES = {"custom_tokenizer", "map_column"}
PLANNED = ["bow", "tfidf_l2", "sentences", "keyword_replace", "page_posts", "label_terms", "phrase_apply", "pool_sum", "cosine_sparse"]


@pytest.mark.parametrize("name", PLANNED)
def test_no_python_workers_in_core_queries(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_scans_read_only_what_they_need(spark):
    plan = QUERIES["label_isin"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<doc_id:bigint,lang:string>" in plan and "PushedFilters: [In(lang" in plan


def test_every_sql_twin_has_a_query():
    assert set(SQL) <= set(QUERIES) and len(QUERIES) > 110
