"""Sharding by balanced label propagation: equal texts meet in one shard, shards hold the same bytes."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from signalloom.llm.common import whole_text
from signalloom.operators.staging import staged

#: Rows are numbered and summed up within pieces of about this many, then the pieces are chained.
PIECE = 1 << 16
#: Share of a shard's even size that linked documents may fill; the rest leaves room for evening out.
FILL = 0.98
ROUNDS = 24
#: Shards are even once they differ from the mean by this share of it, or once no document is small enough to help.
EVEN = 1e-3


def _below(key: Column, seed: int) -> Column:
    """A number from 0 up to 1 that depends on ``key`` and ``seed`` alone."""
    return F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(1 << 30)) / F.lit(float(1 << 30))


def _by_shard(values: list, shard: str | Column = "shard") -> Column:
    """The value of the row's shard; ``values`` has one per shard."""
    column = F.col(shard) if isinstance(shard, str) else shard
    return F.element_at(F.array(*map(F.lit, values)), column.cast("int") + 1)


def running(df: DataFrame, within: list[str], order: str, value: str, rows: int, name: str) -> DataFrame:
    """Add ``name``: the sum of ``value`` over the rows of the same ``within`` that come before in ``order``.

    ``order`` is a 64-bit hash; its leading bits cut each group into pieces of about ``PIECE`` rows that are
    summed on their own, and the pieces' sums are chained. Equal hashes are put in order by ``row``.
    """
    bits = max(0, math.ceil(math.log2(max(1, rows) / PIECE)))
    pieces = df.withColumn("_piece", F.shiftright(order, 64 - bits) if bits else F.lit(0).cast("long"))
    before = W.partitionBy(*within).orderBy("_piece").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        pieces.groupBy(*within, "_piece").agg(F.sum(value).alias("_sum"))
        .select(*within, "_piece", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_offset"))
    )
    inside = W.partitionBy(*within, "_piece").orderBy(order, "row").rowsBetween(W.unboundedPreceding, -1)
    return (
        pieces.withColumn("_inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
        .join(offsets, [*within, "_piece"])
        .withColumn(name, F.col("_offset") + F.col("_inside"))
        .drop("_piece", "_inside", "_offset")
    )


def quotas(demand: dict[tuple[int, int], int], load: list[int], capacity: float) -> dict[tuple[int, int], float]:
    """Share of the wished moves from shard to shard that may take place.

    Moves both ways between two shards cancel out; what is left is cut to the room of the shard it goes to.
    """
    swapped = {(a, b): min(n, demand.get((b, a), 0)) for (a, b), n in demand.items()}
    inflow = [0] * len(load)
    for (a, b), n in demand.items():
        inflow[b] += n - swapped[a, b]
    room = [min(1.0, max(0.0, capacity - x) / y) if y else 0.0 for x, y in zip(load, inflow)]
    return {(a, b): (swapped[a, b] + (n - swapped[a, b]) * room[b]) / n for (a, b), n in demand.items() if n}


def propagated(cells: DataFrame, shards: int, capacity: float, rounds: int = ROUNDS, seed: int = 7) -> DataFrame:
    """Move the rows of ``cells`` (hub, start, shard, mass) towards the shard that most of their hub is in.

    A cell is what a hub has in one shard at the start; cells of a hub that have met move as one. Each round
    every hub names a shard: of those with room for what it has elsewhere the one that holds most of it, without
    any the one with most room. The joined cells then move there with the probability that ``quotas`` leaves
    their pair of shards. Hubs that no shard has room for, and after two rounds all, sit out every other round at
    random, so that they don't chase each other. Only sums per shard and per pair of shards reach the driver. Ends when no
    cell wishes to move, or after ``rounds``.
    """
    label = F.sequence(F.lit(0), F.lit(shards - 1))
    idle = 0
    for turn in range(rounds):
        held = {r["shard"]: r["n"] for r in cells.groupBy("shard").agg(F.sum("mass").alias("n")).collect()}
        load = [int(held.get(s, 0)) for s in range(shards)]
        room = F.array(*[F.lit(float(capacity - x)) for x in load])
        own = cells.groupBy("hub", "shard").agg(F.sum("mass").alias("mass"))
        hubs = own.groupBy("hub").agg(
            F.sum("mass").alias("whole"),
            F.map_from_entries(F.collect_list(F.struct("shard", "mass"))).alias("own"),
        )

        def choice(s: Column) -> Column:
            mine = F.coalesce(F.try_element_at("own", s), F.lit(0)).cast("double")
            left = F.element_at(room, s + 1) + mine
            fits = left >= F.col("whole")
            return F.struct(
                fits.cast("int").alias("fits"), F.when(fits, mine).otherwise(left).alias("value"),
                F.xxhash64("hub", s).alias("tie"), s.alias("shard"),
            )

        best = F.array_max(F.transform(label, choice))
        named = hubs.select("hub", best.alias("best")).select("hub", F.col("best.fits").alias("fits"), F.col("best.shard").alias("to"))
        wishes = staged(cells.join(named, "hub"), "wishes")
        awake = _below(F.col("hub"), seed - turn - 1) < 0.5
        moving = (F.col("shard") != F.col("to")) & (awake | ((F.col("fits") == 1) & F.lit(turn < 2)))
        wished = wishes.groupBy("shard", "to").agg(F.coalesce(F.sum(F.when(moving, F.col("mass"))), F.lit(0)).alias("n")).collect()
        demand = {(r["shard"], r["to"]): int(r["n"]) for r in wished if r["shard"] != r["to"]}
        share = quotas(demand, load, capacity)
        idle = 0 if any(share.values()) else idle + 1
        if not demand or idle > 4:
            break
        table = [share.get((a, b), 0.0) for a in range(shards) for b in range(shards)]
        allowed = F.element_at(F.array(*map(F.lit, table)), (F.col("shard") * shards + F.col("to") + 1).cast("int"))
        go = moving & (_below(F.col("hub"), seed + turn) < allowed)
        cells = wishes.select("hub", "start", F.when(go, F.col("to")).otherwise(F.col("shard")).alias("shard"), "mass")
    return cells


def _loads(docs: DataFrame, shards: int) -> list[int]:
    held = {r["shard"]: int(r["n"]) for r in docs.groupBy("shard").agg(F.sum("size").alias("n")).collect()}
    return [held.get(s, 0) for s in range(shards)]


def _placed(moved: DataFrame, room: list[float], rows: int) -> DataFrame:
    """Lay the rows of ``moved`` end to end in the order of their hash, and the rooms of the shards beside them.

    A row goes to the shard whose stretch holds its middle.
    """
    laid = running(moved.withColumn("_all", F.lit(0)), ["_all"], "order", "size", rows, "_at").drop("_all")
    middle = F.col("_at") + F.col("size") / 2
    edges, upto = [], 0.0
    for x in room:
        upto += max(0.0, x)
        edges.append(upto)
    last = max((s for s, x in enumerate(room) if x > 0), default=0)
    shard = F.coalesce(*[F.when(middle < F.lit(e), F.lit(s)) for s, e in enumerate(edges) if room[s] > 0], F.lit(last))
    return laid.withColumn("shard", shard).drop("_at")


def evened(docs: DataFrame, shards: int, rows: int, total: int, rounds: int = 12) -> DataFrame:
    """Move documents (order, linked, size, shard, ...) out of shards above the mean into those below it.

    In each round a shard that is too large takes the largest band of sizes (2^n to 2^(n+1)) below its excess that
    it has documents of, unlinked ones if it can, and gives away as many of them as fit its excess, in the order
    of their hash. What is left over is less than one such document, so excesses shrink with each round.
    """
    mean = total / shards
    for _ in range(rounds):
        band = F.floor(F.log2(F.col("size").cast("double"))).cast("int")
        sums = docs.groupBy("shard", "linked", band.alias("band")).agg(F.sum("size").alias("n")).collect()
        load = [0] * shards
        for r in sums:
            load[r["shard"]] += int(r["n"])
        excess = [x - mean for x in load]
        if max(map(abs, excess)) <= max(1.0, EVEN * mean):
            break
        widest = max(-x for x in excess)
        given = {}
        for s, x in enumerate(excess):
            fitting = [(r["linked"], -r["band"]) for r in sums if r["shard"] == s and 2 ** (r["band"] + 1) <= min(x, widest)]
            if x > 0 and fitting:
                given[s] = min(fitting)
        if not given:
            break
        bands = [(s, bool(linked), -b) for s, (linked, b) in given.items()]
        chosen = F.lit(False)
        for s, linked, b in bands:
            chosen = chosen | ((F.col("shard") == s) & (F.col("linked") == F.lit(linked)) & (band == b))
        candidates = running(docs.where(chosen), ["shard"], "order", "size", rows, "_before")
        limit = _by_shard([max(0.0, x) for x in excess])
        gives = F.col("_before") + F.col("size") <= limit
        moved = staged(candidates.where(gives).drop("_before"), "moved")
        if moved.isEmpty():
            break
        placed = _placed(moved, [-x for x in excess], rows).select("row", F.col("shard").alias("_to"))
        docs = staged(
            docs.join(staged(placed, "placed"), "row", "left")
            .withColumn("shard", F.coalesce("_to", "shard")).drop("_to"),
            "evened",
        )
    return docs


def sharded(documents: DataFrame, shards: int = 16, rounds: int = ROUNDS, seed: int = 7) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard, copies.

    Law ``bytes``: shards hold nearly the same sum of sizes (bytes of the text, plus 1). Documents of equal text are
    linked through their text, a hub; no pairs are made. Linked documents start in a shard by hash, and labels are
    propagated over the hubs under the capacity of a shard until copies have met. A text whose copies hold more
    than a shard is split by hash into as few hubs as fit. Documents without copies fill what is left, and the rest
    is evened out by small documents. ``slot`` numbers a shard's documents without gaps; ``grown_shard`` is null.

    A null text counts as empty, and null and empty texts are copies of each other. Repeated rows are documents of
    their own. Null ids are kept. An empty table gives no rows, and a table of fewer documents than shards leaves
    shards empty. Any columns besides doc_id and text are ignored. Reruns over the same files agree.
    """
    text = whole_text()
    nodes = staged(
        documents.select(
            "doc_id",
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.md5(text.cast("binary")).alias("digest"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "nodes",
    )
    totals = nodes.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes")).first()
    rows, total = totals["rows"], int(totals["bytes"])
    capacity = FILL * total / shards

    # Copies: one row for each text that occurs twice or more.
    texts = nodes.groupBy("digest").agg(F.count(F.lit(1)).alias("copies"), F.sum("size").alias("bytes")).where("copies > 1")
    texts = staged(texts.withColumn("parts", F.greatest(F.lit(1), F.ceil(F.col("bytes") / F.lit(max(capacity, 1.0))))), "texts")
    hashed = F.xxhash64("digest", "doc_id", "row")
    docs = nodes.join(texts.drop("bytes"), "digest", "left").select(
        "doc_id", "size", "text_crc32", "row",
        F.coalesce("copies", F.lit(1)).alias("copies"),
        F.col("copies").isNotNull().alias("linked"),
        # Copies follow each other, so that a prefix of this order cuts few texts; not those of a text with very many.
        F.when(F.col("copies") <= PIECE, F.xxhash64("digest")).otherwise(hashed).alias("order"),
        F.when(F.col("copies").isNotNull(), F.xxhash64("digest", F.pmod(hashed, F.col("parts")))).alias("hub"),
        F.pmod(F.xxhash64("digest", "row", F.lit(seed)), F.lit(shards)).cast("int").alias("start"),
    )
    docs = staged(docs, "linked")
    cells = (
        docs.where("linked").groupBy("hub", "start").agg(F.sum("size").alias("mass"))
        .select("hub", "start", F.col("start").alias("shard"), "mass")
    )
    met = propagated(staged(cells, "cells"), shards, capacity, rounds, seed)
    linked = docs.where("linked").join(staged(met, "met").select("hub", "start", "shard"), ["hub", "start"])
    linked = staged(linked.drop("hub", "start"), "placed-linked")
    alone = docs.where("not linked").drop("hub", "start")
    filled = _placed(alone, [max(0.0, total / shards - x) for x in _loads(linked, shards)], rows)
    everyone = staged(linked.unionByName(filled.select(*linked.columns)), "filled")
    everyone = evened(everyone, shards, rows, total)

    numbered = everyone.withColumns({"one": F.lit(1).cast("long"), "at": F.xxhash64("row", F.lit(seed))})
    numbered = running(numbered, ["shard"], "at", "one", math.ceil(rows / shards), "slot")
    return numbered.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"),
        F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
        F.col("copies").cast("long").alias("copies"),
    )
