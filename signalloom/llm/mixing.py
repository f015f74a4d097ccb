"""Mixing sources to target weights with a low-discrepancy schedule of equal-token blocks."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from signalloom.llm.common import whole_text
from signalloom.operators.staging import staged

WORD = r"[^\x20\x09-\x0D]+"
#: 2^32 over the square of the golden ratio, made odd: multiples of it modulo 2^32 are the golden-ratio sequence.
GOLDEN = 1640531527
UNIT = 1 << 32
#: Slots and documents are ranked within pieces of about this many rows, then pieces are chained.
PIECE = 1 << 16


def source_targets(sizes: DataFrame, weights=(1, 2, 3), repeats: int = 3) -> DataFrame:
    """(source, source_size, target) from (source, size): words each source should give.

    Sources in code point order, null last, weigh ``weights`` in turn and share all words. No target
    passes ``repeats`` times its source's size; the excess goes to the others by weight until none is
    above. Each round is one aggregate; only a count and three sums reach the driver. The ranking of sources
    is one window over a row per source, not per document. A source of no words gets 0.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    totals = staged(
        totals.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (rank % len(weights) + 1).cast("int")))
        .withColumn("rank", rank),
        "sources",
    )
    whole = totals.agg(F.coalesce(F.sum("source_size"), F.lit(0)).alias("n")).first()["n"]
    ceiling = F.col("source_size") * F.lit(repeats)
    level, capped_before = 0.0, -1
    while True:
        capped = ceiling <= F.col("weight") * F.lit(level)
        now = totals.agg(
            F.count_if(capped).alias("n"),
            F.coalesce(F.sum(F.when(capped, ceiling)), F.lit(0)).alias("given"),
            F.coalesce(F.sum(F.when(~capped, F.col("weight"))), F.lit(0)).alias("free"),
        ).first()
        if now["n"] == capped_before or not now["free"]:
            break
        capped_before, level = now["n"], max(level, (whole - now["given"]) / now["free"])
    return totals.select(
        "source", "source_size", "rank", F.least(ceiling.cast("double"), F.col("weight") * F.lit(level)).alias("target")
    )


def schedule(targets: DataFrame, slots: int) -> DataFrame:
    """(rank, turn, slot): golden-ratio points mapped through the sources' cumulative targets.

    Point k of the sequence falls into the share of one source; ``turn`` counts that source's slots in
    order. Turns are counted inside pieces of consecutive slots and the pieces' counts are chained, so no
    source's slots meet in one task. The table of shares has a row per source.
    """
    spark = targets.sparkSession
    total = targets.agg(F.sum("target")).first()[0] or 0.0
    if not slots or not total:
        return spark.createDataFrame([], "rank int, turn long, slot long")
    running = F.sum("target").over(W.orderBy("rank").rowsBetween(W.unboundedPreceding, 0))
    edge = F.least(F.lit(UNIT), F.round(running / F.lit(total) * UNIT)).cast("long")
    shares = (
        targets.select("rank", edge.alias("end"))
        .withColumn("start", F.lag("end", 1, 0).over(W.orderBy("rank")))
        .where("end > start")
    )
    shares = staged(shares, "shares")
    point = F.pmod(F.pmod(F.col("slot"), F.lit(UNIT)) * GOLDEN, F.lit(UNIT))
    # The shares cut the unit into ranges: a coarse cell of the unit meets few of them, so this is an equi-join.
    cell = UNIT >> 10
    cells = shares.withColumn("cell", F.explode(F.sequence(F.expr(f"start div {cell}"), F.expr(f"(end - 1) div {cell}"))))
    points = spark.range(slots).select(F.col("id").alias("slot")).withColumn("point", point)
    placed = (
        points.withColumn("cell", F.expr(f"point div {cell}"))
        .join(cells, "cell")
        .where("point >= start and point < end")
        .select("rank", "slot", F.expr(f"slot div {PIECE}").alias("piece"))
    )
    counts = placed.groupBy("rank", "piece").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(W.partitionBy("rank").orderBy("piece").rowsBetween(W.unboundedPreceding, -1))
    offsets = counts.select("rank", "piece", F.coalesce(before, F.lit(0)).alias("before"))
    inside = F.row_number().over(W.partitionBy("rank", "piece").orderBy("slot")) - 1
    return (
        placed.withColumn("inside", inside)
        .join(offsets, ["rank", "piece"])
        .select("rank", (F.col("before") + F.col("inside")).alias("turn"), "slot")
    )


def shuffled_positions(docs: DataFrame, n_docs: int, seed: int) -> DataFrame:
    """Add ``start``: the words of the document's source that come before it in a keyed random order.

    The order is by a hash of seed and doc_id. Its leading bits cut each source into pieces; words are
    summed inside a piece and the pieces' sums are chained, so a hot source is spread over tasks. The number
    of pieces follows the number of documents.
    """
    bits = max(0, math.ceil(math.log2(max(1, n_docs) / PIECE)))
    order = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))
    docs = docs.withColumn("order", order).withColumn(
        "piece", F.shiftright(F.conv(F.substring("order", 1, 8), 16, 10).cast("long"), 32 - bits)
    )
    before = F.sum("n").over(W.partitionBy("rank").orderBy("piece").rowsBetween(W.unboundedPreceding, -1))
    offsets = (
        docs.groupBy("rank", "piece").agg(F.sum("size").alias("n"))
        .select("rank", "piece", F.coalesce(before, F.lit(0)).alias("before"))
    )
    in_piece = (
        W.partitionBy("rank", "piece").orderBy("order", "doc_id", "size").rowsBetween(W.unboundedPreceding, -1)
    )
    return (
        docs.withColumn("inside", F.coalesce(F.sum("size").over(in_piece), F.lit(0)))
        .join(offsets, ["rank", "piece"])
        .withColumn("start", F.col("before") + F.col("inside"))
        .drop("order", "piece", "inside", "before")
    )


def mixed(
    documents: DataFrame, weights=(1, 2, 3), repeats: int = 3, block_words: int = 4096, seed: int = 7
) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken, first_slot.

    ``taken`` is the number of its words that the mix takes, repeats counted. Each source's documents are
    put in keyed random order and cut into blocks of ``block_words``; after the last word the order starts
    again, ``repeats`` times at most. Slot k of the schedule belongs to the source whose share of the
    targets holds the k-th golden-ratio point, and takes that source's next block. ``first_slot`` is the
    slot in which the document first appears (null: in none).

    Null text has size 0; documents without words are kept with taken 0. A null source is a source of its
    own, last in order. Repeated rows are documents of their own. Any two runs give the same rows. An empty
    table gives no rows.
    """
    sized = documents.select("doc_id", "source", F.regexp_count(whole_text(), F.lit(WORD)).cast("long").alias("size"))
    sized = staged(sized, "sized")
    targets = staged(source_targets(sized, weights, repeats), "targets")
    totals = sized.agg(F.count(F.lit(1)).alias("docs"), F.coalesce(F.sum("size"), F.lit(0)).alias("words")).first()
    # Small inputs get smaller blocks, so that a block is a small part of any share.
    block = max(1, min(block_words, totals["words"] // 16384))
    slots = schedule(targets, totals["words"] // block)
    ranked = sized.withColumn("key", F.coalesce("source", F.lit(""))).withColumn("none", F.col("source").isNull())
    keyed = targets.withColumn("key", F.coalesce("source", F.lit(""))).withColumn("none", F.col("source").isNull())
    docs = ranked.join(keyed.drop("source"), ["key", "none"]).drop("key", "none")
    docs = staged(shuffled_positions(docs, totals["docs"], seed), "positions")

    # A block is a stretch of the source's repeated order; it is cut where the order starts again.
    ends = F.col("turn") * block + block
    limit = F.col("source_size") * repeats
    blocks = (
        slots.join(targets.select("rank", "source_size"), "rank")
        .withColumn("a", F.col("turn") * block)
        .withColumn("b", F.least(ends, limit))
        .where("a < b")
        .withColumn("round", F.explode(F.expr("sequence(a div source_size, (b - 1) div source_size)")))
        .select(
            "rank", "slot",
            F.greatest(F.lit(0), F.expr("a - round * source_size")).alias("a"),
            F.least("source_size", F.expr("b - round * source_size")).alias("b"),
        )
    )
    # Both sides name the grid cells of the source's order that they touch, and meet in them.
    in_cells = lambda x, a, b: x.withColumn("cell", F.explode(F.expr(f"sequence({a} div {block}, ({b} - 1) div {block})")))
    stretch = docs.where("size > 0").select("doc_id", "rank", "size", "start", (F.col("start") + F.col("size")).alias("end"))
    pieces = in_cells(stretch, "start", "end").withColumns(
        {"p": F.greatest("start", F.col("cell") * block), "q": F.least("end", (F.col("cell") + 1) * block)}
    )
    taken = (
        pieces.join(in_cells(blocks, "a", "b"), ["rank", "cell"])
        .withColumn("n", F.least("q", "b") - F.greatest("p", "a"))
        .where("n > 0")
        .groupBy("rank", "start", "end")
        .agg(F.sum("n").alias("taken"), F.min("slot").alias("first_slot"))
    )
    return (
        docs.withColumn("end", F.when(F.col("size") > 0, F.col("start") + F.col("size")))
        .join(taken, ["rank", "start", "end"], "left")
        .select(
            "doc_id", "source", "size", "source_size", "target",
            F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "first_slot",
        )
    )
