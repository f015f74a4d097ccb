"""One document of each group of near copies: SimHash neighbours and min-hash bands propose, exact similarity decides.

Texts whose five-word shingles are 0.8 alike differ in about ten bits of a SimHash, more than complete Golay keys
can reach. Their neighbours are therefore joined by bands of min-hashes, and every link is verified on the shingles.
"""

from __future__ import annotations

import functools
import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalloom.llm.common import free_name, map_batches, whole_text
from signalloom.llm.components import components
from signalloom.llm.simhash import SEED, fingerprint_groups, majority
from signalloom.operators.staging import broadcast_if_small, staged, staging_area, staging_path

WORDS = 5
THRESHOLD = 0.8
#: Two texts at the threshold share no band in 0.02 % of cases: (1 - 0.8 ** ROWS) ** BANDS.
BANDS, ROWS = 36, 7
#: Min-hashes that are compared before the shingles are, and how many have to agree. At the threshold 51 of 64 do
#: on average; fewer than 35 do once in a million pairs.
SKETCH, AGREE = 64, 35
#: Bytes of a text whose words are hashed at once.
BLOCK_BYTES = 1 << 16
#: Bytes of shingles that one piece of a group holds; pieces are compared in pairs.
PIECE_BYTES = 4 << 20

_RANDOM = np.random.default_rng(SEED)
_FLIP = _RANDOM.integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint32)
_FACTOR = _RANDOM.integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint32) | np.uint32(1)
#: Of the word hash: a number for each byte, the factor of places, and the factors that spread bits.
_CODE = _RANDOM.integers(0, 1 << 64, 256, dtype=np.uint64)
_BASE, *_SPREAD = _RANDOM.integers(0, 1 << 64, 3, dtype=np.uint64) | np.uint64(1)
_IN_WORD = bytes(b not in b" \t\n\v\f\r" for b in range(256))


@functools.lru_cache(maxsize=2)
def _places(size: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers of the base, and their inverses."""
    inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
    return tuple(np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size, x)])) for x in (_BASE, inverse))


def word_hashes(data: bytes) -> np.ndarray:
    """A hash of each word, A-Z in lower case; long texts are worked on in blocks that end between words."""
    data, found, start = data.lower(), [np.empty(0, np.uint64)], 0
    while start < len(data):
        end = min(len(data), start + BLOCK_BYTES)
        while end < len(data) and _IN_WORD[data[end]]:
            end += 1
        block = data[start:end]
        start = end
        powers, inverses = _places(BLOCK_BYTES if len(block) <= BLOCK_BYTES else len(block))
        inside = np.frombuffer(b"\0" + block.translate(_IN_WORD) + b"\0", np.uint8)
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        first, last = edges[::2], edges[1::2]
        sums = np.zeros(len(block) + 1, np.uint64)
        np.cumsum(_CODE[np.frombuffer(block, np.uint8)] * powers[: len(block)], out=sums[1:])
        found.append(_mixed((sums[last] - sums[first]) * inverses[first]))
    return np.concatenate(found)


def _mixed(x: np.ndarray) -> np.ndarray:
    """Spread the differences of 64-bit numbers over all bits, one to one."""
    for factor in _SPREAD:
        x = (x ^ (x >> np.uint64(32))) * factor
    return x ^ (x >> np.uint64(32))


def shingle_hashes(data: bytes, words: int = WORDS) -> np.ndarray:
    """A hash of each shingle, repeats included; shorter texts are one shingle, wordless ones have none."""
    each = word_hashes(data)
    wide = min(words, len(each))
    out = np.zeros(len(each) - wide + 1 if wide else 0, np.uint64)
    for i in range(wide):
        out = out * _BASE + each[i : i + len(out)]
    return _mixed(out)


def shingle_set(data: bytes, words: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the shingles."""
    return np.unique(shingle_hashes(data, words))


def min_hashes(shingles: np.ndarray) -> np.ndarray:
    out = np.full(BANDS * ROWS, 0xFFFFFFFF, np.uint32)
    high = (shingles >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(high), 256):
        block = high[at : at + 256, None] ^ _FLIP
        block *= _FACTOR
        np.minimum(out, block.min(axis=0), out=out)
    return out


def described(documents: DataFrame) -> DataFrame:
    """(doc_id, text_hash, fp, node, keys, sketch, shingles) of every row; ``node`` names the set of shingles."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        fps, nodes, keys, sketches, sets = [], [], [], [], []
        for text in batch.column("text").to_pylist():
            data = text.encode("utf-8", "surrogatepass")
            hashed = shingle_hashes(data)
            found = np.unique(hashed)
            least = min_hashes(found)
            bands = least.reshape(BANDS, ROWS)
            fps.append(majority(hashed.astype(">u8").tobytes()))
            nodes.append(xxhash.xxh64_digest(found.tobytes(), SEED))
            keys.append([xxhash.xxh64_digest(b.tobytes(), n) for n, b in enumerate(bands)] if len(found) else [])
            sketches.append(least[:SKETCH].astype(np.uint8).tobytes())
            sets.append(found.tobytes())
        offsets = np.cumsum([0, *map(len, keys)]).astype(np.int32)
        flat = np.frombuffer(b"".join(itertools.chain.from_iterable(keys)), ">i8").astype(np.int64)
        return pa.record_batch(
            {
                "doc_id": batch.column("doc_id"),
                "text_hash": batch.column("text_hash"),
                "fp": np.frombuffer(b"".join(fps), ">i8").astype(np.int64),
                "node": np.frombuffer(b"".join(nodes), ">i8").astype(np.int64),
                "keys": pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
                "sketch": pa.array(sketches, pa.binary()),
                "shingles": pa.array(sets, pa.binary()),
            }
        )

    text = whole_text()
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    fields = "doc_id long, text_hash long, fp long, node long, keys array<long>, sketch binary, shingles binary"
    return map_batches(docs, run, fields)


def similar_links(nodes: np.ndarray, sketches: np.ndarray, sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Links that connect exactly what pairs of ``THRESHOLD`` or more connect, each group as a star.

    Searches breadth first; what is reached isn't compared again, so that close groups cost little.
    """
    sizes = np.array([len(x) for x in sets])
    rest, near, size, out = np.arange(len(nodes)), sketches, sizes, []
    while len(rest) > 1:
        group, todo = [], [rest[0]]
        rest, near, size = rest[1:], near[1:], size[1:]
        while todo:
            x = todo.pop()
            group.append(x)
            alike = (near == sketches[x]).sum(axis=1) >= AGREE
            alike &= np.minimum(size, sizes[x]) >= THRESHOLD * np.maximum(size, sizes[x]) - 1e-9
            at = [i for i in np.flatnonzero(alike) if _similar(sets[x], sets[rest[i]])]
            if at:
                todo.extend(rest[at])
                rest, near, size = (np.delete(v, at, axis=0) for v in (rest, near, size))
        if len(group) > 1:
            first = nodes[group].min()
            out += [(int(first), int(n)) for n in nodes[group] if n != first]
    return out


def _similar(a: np.ndarray, b: np.ndarray) -> bool:
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common >= THRESHOLD * (len(a) + len(b) - common) - 1e-9


def _compared(cell: pa.Table) -> pa.Table:
    """The links within one cell, a pair of pieces of one group."""
    sketches = np.frombuffer(b"".join(cell.column("sketch").to_pylist()), np.uint8).reshape(-1, SKETCH)
    sets = [np.frombuffer(x, np.uint64) for x in cell.column("shingles").to_pylist()]
    links = similar_links(cell.column("node").to_numpy(), sketches, sets)
    return pa.table({"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())})


def verified_links(rows: DataFrame, piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """(a, b) links that connect the sets of shingles of ``described`` rows which are similar and share a key.

    Keys are the bands and the group of the SimHash. Those filed under one key hang on the smallest of them; what
    hangs together that way is a candidate group, whose sets travel once each. A group larger than a piece is
    compared pair of pieces by pair of pieces, in groups of their own, so its cost grows with the square of its
    pieces while its rows, and the memory of a task, stay bounded.
    """
    groups = fingerprint_groups(rows.select("doc_id", "fp")).select("fp", F.col("root").alias("key"))
    some = rows.where("size(keys) > 0")
    by_bits = some.select("node", "fp").distinct().join(groups, "fp").select("node", "key")
    by_bands = some.select("node", "keys").dropDuplicates(["node"]).select("node", F.explode("keys").alias("key"))
    filed = staged(by_bands.union(by_bits), "filed")
    ranges = filed.groupBy("key").agg(F.min("node").alias("a"), F.max("node").alias("z"))
    shared = staged(ranges.where("a < z").select("key", "a"), "shared")
    candidates = staged(components(filed.join(shared, "key").select("a", F.col("node").alias("b"))), "candidates")

    # Most sets are no candidates; while the nodes of those that are can be broadcast, the others never travel.
    nodes = candidates.select("node")
    bounded = broadcast_if_small(nodes)
    if bounded is not nodes:
        some = some.join(bounded, "node", "left_semi")
    # Hashing the short side spares sorting all shingles.
    sets = some.select("node", "sketch", "shingles").join(candidates.hint("shuffle_hash"), "node").dropDuplicates(["node"])
    members = staged(sets, "members")
    pieces = F.ceil(F.sum(F.length("shingles") + SKETCH) / piece_bytes).cast("int")
    counts = staged(members.groupBy("root").agg(pieces.alias("pieces")), "pieces")
    piece = F.pmod(F.xxhash64("node"), F.col("pieces")).cast("int")
    cells = (
        members.join(counts, "root")
        .withColumn("piece", piece)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
        .select("root", F.least("piece", "other").alias("lo"), F.greatest("piece", "other").alias("hi"), "node", "sketch", "shingles")
    )
    return cells.groupBy("root", "lo", "hi").applyInArrow(_compared, "a long, b long")


def deduplicated(documents: DataFrame, piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """One row of ``documents`` for each group of near copies, that of the smallest id, with all its columns.

    Near copies have five-word shingles (lower-cased, as sets) whose Jaccard similarity is 0.8 or more; groups are
    what such links connect. Null and wordless texts are copies of each other and of nothing else; texts under five
    words are one shingle. Of repeated rows one stays, and one of a group without ids. An empty table gives no rows.
    """
    path = staging_path(documents.sparkSession, "kept")
    # Shingles take more room than texts: they are deleted before the texts are shuffled.
    with staging_area(documents.sparkSession, "near-copies"):
        rows = staged(described(documents), "described")
        roots = staged(components(verified_links(rows, piece_bytes)), "roots")
        rooted = rows.select("doc_id", "text_hash", "node").join(roots, "node", "left")
        group = F.coalesce("root", "node").alias("group")
        first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash", "n")).alias("first")
        firsts = (
            rooted.groupBy(group, "doc_id", "text_hash")
            .agg(F.count(F.lit(1)).alias("n"))
            .groupBy("group")
            .agg(first)
            .select(F.col("first.doc_id").alias("kept_id"), F.col("first.text_hash").alias("kept_hash"), F.col("first.n").alias("n"))
        )
        firsts.write.parquet(path)
    kept = documents.sparkSession.read.schema(firsts.schema).parquet(path)
    own = free_name(documents, "text_hash_of_row")
    marked = documents.withColumn(own, F.xxhash64(whole_text()))

    def among(kept: DataFrame) -> DataFrame:
        same = (marked[own] == kept["kept_hash"]) & marked["doc_id"].cast("long").eqNullSafe(kept["kept_id"])
        return marked.join(kept.hint("shuffle_hash"), same, "left_semi")

    # Only rows that are there more than once need their texts sorted.
    once, repeated = among(kept.where("n = 1")), kept.where("n > 1")
    if repeated.isEmpty():
        return once.drop(own)
    return once.union(among(repeated).dropDuplicates(["doc_id", own])).drop(own)
