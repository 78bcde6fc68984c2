"""Mixing sources to target weights, in DataFrame functions only.

The words of each source, documents in order of doc_id, are one stream that is packed into blocks of a fixed length.
The mix is a row of slots cut into output shards. Every slot of a shard draws its source, so the counts of a shard are
multinomial with the sources' shares. What a source is drawn over its quota goes to the sources that were drawn too
rarely, so the whole mix holds each target to the word. The k-th slot of a source takes the block that a pseudorandom
permutation of the source's block numbers has at k; when all blocks are used up another permutation begins. The short
block at a stream's end closes each round, and the last slot of a source is cut at its target.

Targets: sources in code point order, null last, weigh `weights` in turn and share `share` times all words; no target
passes `most` times its source's words, the rest is shared by weight among the others.

Defined results: null, empty and blank texts have size 0 and are taken 0 times. Rows with a null doc_id come first in
their source; rows that repeat an id are ordered by their text's hash, and rows equal in both are exchangeable. An empty
table gives an empty mix. A very long text only has more blocks. Other columns of `docs` are not read, so their names are
free. Equal input gives an equal mix: every draw hashes a place and `seed`, none depends on how rows lie in partitions.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textspark.llm.storage import kept
from textspark.plans.ranking import row_index

WORD = r"[^\x20\x09-\x0D]+"
BLOCK_WORDS = 128
SHARD_SLOTS = 16_384
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
#: Rows whose running sum one window makes, and least number of cells that slots look their source up in.
GROUP_ROWS = 4096
CELLS = 4096
#: A round of the permutation that leaves the domain is repeated. Outside lie fewer places than the shorter side `a` of
#: the domain, at most one in `a`, so this many repeats end inside for a <= 64 and with 1 - 2^-384 beyond.
WALKS = 64


def running_totals(df: DataFrame, values: Sequence[str], index: str = "idx") -> DataFrame:
    """Adds `<value>_before` to rows numbered by `index`: the sum of each value over all rows of a smaller index.

    Windows hold GROUP_ROWS rows each; one row a group is summed in one place.
    """
    cell = F.floor(F.col(index) / GROUP_ROWS)
    sums = df.groupBy(cell.alias("_cell")).agg(*(F.sum(v).alias(f"_{v}") for v in values))
    before = Window.orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = kept(sums.select("_cell", *(F.coalesce(F.sum(f"_{v}").over(before), F.lit(0)).alias(f"_{v}") for v in values)), "starts")
    inside = Window.partitionBy("_cell").orderBy(index).rowsBetween(Window.unboundedPreceding, -1)
    summed = df.withColumn("_cell", cell).withColumns({f"_in_{v}": F.coalesce(F.sum(v).over(inside), F.lit(0)) for v in values})
    return summed.join(starts, "_cell").select(*df.columns, *((F.col(f"_in_{v}") + F.col(f"_{v}")).alias(f"{v}_before") for v in values))


def permuted(x: Column, n: Column, a: Column, *key: Column) -> Column:
    """Where a keyed permutation of 0 .. n - 1 takes x; `a` is about the root of n.

    Rounds that add a hash of one coordinate to the other permute a rectangle of sides a and ceil(n / a); what lands
    outside n goes on until it is inside, which keeps it a permutation of 0 .. n - 1.
    """
    b = F.ceil(n / a).cast("long")

    def turn(y: Column) -> Column:
        left, right = F.floor(y / b), y % b
        for i in range(2):
            left = F.pmod(left + F.pmod(F.xxhash64(*key, F.lit(2 * i), right), a), a)
            right = F.pmod(right + F.pmod(F.xxhash64(*key, F.lit(2 * i + 1), left), b), b)
        return left * b + right

    again = lambda y: F.aggregate(F.sequence(F.lit(1), F.lit(WALKS)), y, lambda v, _: F.when(v < n, v).otherwise(turn(v)))
    once = turn(x)
    return F.when(n <= 1, F.lit(0).cast("long")).when(once < n, once).otherwise(again(once))


@dataclass
class Mix:
    """sources: (key, source, idx, source_size, target, ...); slots: (shard, slot, idx, block, n_words);
    pieces: (row, doc_id, tie, size, idx, block, low, high, first), the part [low, high) of a block that a document
    fills with its words from `first` on, one piece without a block for a document without words."""

    sources: DataFrame
    slots: DataFrame
    pieces: DataFrame


def _sized(docs: DataFrame, *others: str) -> DataFrame:
    """(key, source, doc_id, tie, size, others): keys order as sources do, null last."""
    source, text = F.col("source").cast("string"), F.col("text").cast("string")
    return docs.select(
        F.when(source.isNull(), "1").otherwise(F.concat(F.lit("0"), source)).alias("key"),
        source.alias("source"),
        F.col("doc_id"),
        F.xxhash64(text).alias("tie"),
        F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        *others,
    )


def targets(sources: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """(key, idx, source_size) with `target`, words the mix should take from each source.

    All sources below their limit get the same words per weight. That level is found in a few rounds, each an
    aggregate over the sources; a round puts the sources that it lifts over their limit at it.
    """
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("idx") % len(weights) + 1).cast("int"))
    limit = F.col("source_size") * most
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    level, stopped = 0.0, -1
    over = F.lit(False)
    while True:
        row = sources.agg(F.sum(F.when(over, limit)), F.sum(F.when(~over, weight)), F.count(F.when(over, 1))).first()
        if row[2] == stopped or not row[1]:
            break
        level, stopped = (share * total - (row[0] or 0)) / row[1], row[2]
        over = weight * F.lit(level) > limit
    return sources.withColumn("target", F.least(weight * F.lit(level), limit.cast("double")))


def _quotas(sources: DataFrame, block: int) -> DataFrame:
    """Blocks and slots of each source: whole rounds over its stream, and the words and slots of a last round."""
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    rest = F.floor("target") - F.col("whole") * F.col("source_size")
    return (
        sources.withColumn("blocks", F.ceil(F.col("source_size") / block).cast("long"))
        .withColumn("whole", whole.cast("long"))
        .withColumn("rest", rest.cast("long"))
        .withColumn("quota", F.col("whole") * F.col("blocks") + F.ceil(F.col("rest") / block).cast("long"))
        .withColumn("side", F.greatest(F.lit(1), F.ceil(F.sqrt(F.col("blocks") - 1))).cast("long"))
    )


def _drawn(sources: DataFrame, total: int, shard: int, seed: int) -> DataFrame:
    """(slot, shard, idx): each slot draws a place among all quotas and takes the source whose quota lies there."""
    spark = sources.sparkSession
    n = sources.count()
    width = -(-total // max(CELLS, n))
    low, high = F.col("quota_before"), F.col("quota_before") + F.col("quota") - 1
    cells = F.explode(F.sequence(F.floor(low / width), F.floor(high / width)))
    places = sources.filter("quota > 0").select("idx", low.alias("low"), high.alias("high"), cells.alias("cell"))
    parts = max(spark.sparkContext.defaultParallelism, total >> 20)
    slots = spark.range(0, total, 1, parts).select(F.col("id").alias("slot"), F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(total)).alias("place"))
    found = slots.withColumn("cell", F.floor(F.col("place") / width)).join(places, "cell").filter(F.col("place").between(F.col("low"), F.col("high")))
    return found.select("slot", F.floor(F.col("slot") / shard).alias("shard"), "idx")


def _numbered(drawn: DataFrame, sources: DataFrame) -> DataFrame:
    """(slot, shard, idx, turn): the turn of each slot among its source's, with draws over a quota moved elsewhere."""
    in_shard = Window.partitionBy("shard", "idx").orderBy("slot")
    ranked = kept(drawn.withColumn("turn", F.row_number().over(in_shard) - 1), "drawn")
    counts = ranked.groupBy("shard", "idx").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("idx").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    counts = kept(counts.withColumn("start", F.coalesce(F.sum("n").over(earlier), F.lit(0))), "counts")
    sums = counts.groupBy("idx").agg(F.sum("n").alias("drawn"))
    ledger = sources.select("idx", "quota").join(sums, "idx", "left").withColumn("drawn", F.coalesce("drawn", F.lit(0)))
    ledger = ledger.withColumn("more", F.greatest(F.col("drawn") - F.col("quota"), F.lit(0))).withColumn("less", F.greatest(F.col("quota") - F.col("drawn"), F.lit(0)))
    ledger = kept(running_totals(kept(ledger, "ledger"), ["more", "less"]), "ledger")
    turns = ranked.join(counts.select("shard", "idx", "start"), ["shard", "idx"]).withColumn("turn", F.col("turn") + F.col("start"))
    turns = turns.join(ledger.select("idx", "quota", "more_before"), "idx")
    free = ledger.filter("less > 0").select(
        F.col("idx"), F.col("drawn"), F.col("less_before"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("less") - 1)).alias("at")
    )
    free = free.select("idx", (F.col("drawn") + F.col("at")).alias("turn"), (F.col("less_before") + F.col("at")).alias("unit"))
    moved = turns.filter("turn >= quota").select("slot", "shard", (F.col("more_before") + F.col("turn") - F.col("quota")).alias("unit"))
    return turns.filter("turn < quota").select("slot", "shard", "idx", "turn").unionByName(
        moved.join(free, "unit").select("slot", "shard", "idx", "turn")
    )


def mixed(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    most: int = MOST,
    block: int = BLOCK_WORDS,
    shard: int = SHARD_SLOTS,
    seed: int = 11,
) -> Mix:
    """The mix of `docs` (doc_id, text, source): its sources with their targets, its slots, and the blocks' pieces."""
    sized = kept(_sized(docs), "sized")
    sources = sized.groupBy("key").agg(F.first("source").alias("source"), F.sum("size").alias("source_size"))
    sources = targets(row_index(sources, [F.col("key")]), weights, share, most)
    sources = kept(running_totals(kept(_quotas(sources, block), "quotas"), ["source_size", "quota"]), "sources")
    total = sources.agg(F.sum("quota")).first()[0] or 0

    numbered = _numbered(_drawn(sources, total, shard, seed), sources) if total else _no_slots(docs)
    facts = sources.select("idx", "blocks", "whole", "rest", "quota", "side", "source_size")
    rows = numbered.join(facts, "idx")
    at, last = F.col("turn") % F.col("blocks"), F.col("blocks") - 1
    number = F.when(at == last, last).otherwise(permuted(at, last, F.col("side"), F.lit(seed), F.col("idx"), F.floor(F.col("turn") / F.col("blocks"))))
    rows = rows.withColumn("block", number.cast("long"))
    length = F.when(F.col("block") == last, F.col("source_size") - last * block).otherwise(block)
    cut = F.when((F.col("turn") == F.col("quota") - 1) & (F.col("rest") > 0), (F.col("rest") - 1) % block + 1)
    slots = rows.select("shard", "slot", "idx", "block", F.coalesce(cut, length).cast("long").alias("n_words"))

    order = [F.col("key"), F.col("doc_id"), F.col("tie")]
    placed = running_totals(row_index(sized.drop("source"), order, "row"), ["size"], "row")
    placed = placed.join(sources.select("key", "idx", "source_size_before"), "key")
    begin = F.col("size_before") - F.col("source_size_before")
    spans = placed.select("row", "doc_id", "tie", "size", "idx", begin.alias("begin"), (begin + F.col("size")).alias("end"))
    numbers = F.when(F.col("size") > 0, F.sequence(F.floor(F.col("begin") / block), F.floor((F.col("end") - 1) / block)))
    pieces = spans.withColumn("block", F.explode_outer(numbers))
    low = F.greatest(F.col("begin") - F.col("block") * block, F.lit(0))
    high = F.least(F.col("end") - F.col("block") * block, F.lit(block))
    first = F.col("block") * block + low - F.col("begin")
    pieces = pieces.select("row", "doc_id", "tie", "size", "idx", "block", low.alias("low"), high.alias("high"), first.alias("first"))
    return Mix(sources, kept(slots, "slots"), pieces)


def _no_slots(docs: DataFrame) -> DataFrame:
    return docs.sparkSession.createDataFrame([], "slot long, shard long, idx long, turn long")


def taken_words(docs: DataFrame, **how) -> DataFrame:
    """(doc_id, size, source_size, target, taken) of every document: how many of its words the mix takes, with repeats."""
    mix = mixed(docs, **how)
    used = mix.pieces.join(mix.slots.select("idx", "block", "n_words"), ["idx", "block"], "left")
    words = F.when(F.col("n_words") > F.col("low"), F.least("high", "n_words") - F.col("low"))
    sums = used.groupBy("row", "idx", "doc_id", "size").agg(F.coalesce(F.sum(words), F.lit(0)).alias("taken"))
    facts = mix.sources.select("idx", "source_size", "target")
    return kept(sums.join(facts, "idx").select("doc_id", "size", "source_size", "target", "taken"), "taken")


def mixed_texts(docs: DataFrame, **how) -> DataFrame:
    """(shard, slot, source, text): the mix itself, the words of each slot's block joined by one space."""
    mix = mixed(docs, **how)
    filled = mix.slots.join(mix.pieces, ["idx", "block"]).withColumn("n", F.least("high", "n_words") - F.col("low")).filter("n > 0")
    texts = _sized(docs, "text").dropDuplicates(["key", "doc_id", "tie"])
    filled = filled.join(mix.sources.select("idx", "key", "source"), "idx").alias("f")
    same = (F.col("f.key") == F.col("t.key")) & F.col("f.doc_id").eqNullSafe(F.col("t.doc_id")) & (F.col("f.tie") == F.col("t.tie"))
    words = F.slice(F.regexp_extract_all("t.text", F.lit(f"({WORD})")), (F.col("f.first") + 1).cast("int"), F.col("f.n").cast("int"))
    parts = filled.join(texts.alias("t"), same).select("shard", "slot", "f.source", "low", words.alias("words"))
    joined = F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("low", "words"))), lambda p: p["words"]))
    return parts.groupBy("shard", "slot", "source").agg(F.array_join(joined, " ").alias("text"))
