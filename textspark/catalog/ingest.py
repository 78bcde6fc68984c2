"""Ledgers, first sight and incremental ingest."""

from __future__ import annotations

from pyspark.sql import functions as F

from textspark.catalog.fixtures import documents, table
from textspark.catalog.registry import query
from textspark.functions import clean
from textspark.plans import shared_dir
from textspark.plans.union import union_rows
from textspark.streaming import ingest


@query("unseen_ids", "SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def unseen_ids(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang")
    return ingest.unseen(docs, table(spark, sf, "labels"), "doc_id")


@query(
    "first_seen",
    """SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS r
    FROM events) WHERE r = 1""",
)
def first_seen(spark, sf):
    events = table(spark, sf, "events").select("user_id", "event_id", "event_type", "ts")
    return ingest.first_seen(events, "user_id", [F.col("ts"), F.col("event_id")]).drop("ts")


@query(
    "ingest_once",
    """SELECT doc_id, lang FROM (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS r
    FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)) WHERE r <= 50""",
)
def ingest_once(spark, sf):
    """Every document is offered twice; the quota counts new ones only."""
    docs = table(spark, sf, "documents").select("doc_id", "lang")
    ledger = table(spark, sf, "labels").select("doc_id")
    return ingest.ingest_once(union_rows(docs, docs), ledger, "doc_id", [F.col("doc_id")], "lang", 50)


@query(
    "stream_ingest",
    "SELECT event_id, user_id, upper(event_type) AS event_type FROM events",
)
def stream_ingest(spark, sf):
    """Event files by day, every row delivered twice, drained by a stream that is started two times."""
    inbox, posts, checkpoint = (shared_dir(spark, n) for n in ("inbox", "posts", "progress"))
    events = table(spark, sf, "events")
    by_day = events.withColumn("day", F.to_date("ts")).withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2))))
    by_day.repartition("day").write.partitionBy("day").parquet(f"{inbox}/a")
    options = dict(
        schema=events.schema, posts_path=posts, checkpoint=checkpoint, key="event_id", order=[F.col("ts")],
        clean=lambda df: df.withColumn("event_type", F.upper("event_type")), files_per_batch=8,
    )
    ingest.ingest_stream(spark, f"{inbox}/*/*", **options)
    events.write.parquet(f"{inbox}/b/day=later")
    ingest.ingest_stream(spark, f"{inbox}/*/*", **options)
    return spark.read.parquet(posts).select("event_id", "user_id", "event_type")


@query("clean_ingest", "SELECT doc_id, trim(lower(lang)) AS lang FROM documents")
def clean_ingest(spark, sf):
    """One batch stored through the ledger-backed writer."""
    path = shared_dir(spark, "once")
    docs = documents(spark, sf).select("doc_id", "lang")
    lower = lambda df: clean.clean_columns(df, ["lang"], clean.chain(clean.lowercase, clean.squeeze_whitespace))
    ingest.ingest_batch(docs, path, "doc_id", [F.col("doc_id")], lower, 0)
    ingest.ingest_batch(docs, path, "doc_id", [F.col("doc_id")], lower, 1)
    return spark.read.parquet(path).select("doc_id", "lang")
