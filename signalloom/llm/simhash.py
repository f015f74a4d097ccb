"""SimHash fingerprints, and near copies found by Golay-code fuzzy hashing."""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from signalloom.llm.common import free_name, map_batches, shuffle_partitions, slices, whole_text
from signalloom.llm.components import components
from signalloom.operators.staging import staged

SHINGLE = 4
SEED = 42
#: Most differing bits of linked fingerprints; the key tables below are complete for this radius.
RADIUS = 4
#: Fingerprints of one key that a task compares at once; more are compared piece by piece in tasks of their own.
PIECE = 1 << 16

#: Generator of the binary Golay code of length 23: x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1.
GENERATOR = 0b110001110101
#: (first bit, width) of the segments of a fingerprint; the last one is a shortened code word.
SEGMENTS = ((0, 23), (23, 23), (46, 18))


def fingerprint(data: bytes, shingle: int = SHINGLE) -> bytes:
    """Eight bytes, most significant bit first: a bit is 1 if set in over half of the shingle hashes."""
    words = data.lower().split()
    if not words:
        return bytes(8)
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_digest(joined, SEED)
    starts = [0, *itertools.accumulate(len(w) + 1 for w in words)]
    digest = xxhash.xxh64_digest
    return majority(b"".join([digest(joined[a : b - 1], SEED) for a, b in zip(starts, starts[shingle:])]))


def majority(hashed: bytes) -> bytes:
    """The bits that are set in over half of the hashes, of eight bytes each; zero without any."""
    rows = np.frombuffer(hashed, np.uint8).reshape(-1, 8)
    counts = np.zeros(64, np.int64)
    for at in range(0, len(rows), 8192):
        counts += np.unpackbits(rows[at : at + 8192], axis=1).sum(axis=0, dtype=np.int32)
    return np.packbits(counts * 2 > len(rows)).tobytes()


def fingerprinted(documents: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp): the fingerprint as a long. Null text and text without words have fingerprint zero."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        data = (x.encode("utf-8", "surrogatepass") for x in batch.column("text").to_pylist())
        fps = np.frombuffer(b"".join(fingerprint(x, shingle) for x in data), ">i8").astype(np.int64)
        return pa.record_batch({"doc_id": batch.column("doc_id"), "fp": pa.array(fps)})

    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    return map_batches(docs, run, "doc_id long, fp long")


def _remainder(v: int) -> int:
    for bit in range(22, 10, -1):
        if v >> bit & 1:
            v ^= GENERATOR << (bit - 11)
    return v


class Golay:
    """Code words near 23-bit vectors, named by the 12 message bits.

    Every vector is within 3 bits of one code word; those at distance 3 have five more code words at
    distance 4. Two vectors that differ in two bits at most share one of the code words within 4 bits of
    each: the one nearest to a point between them. If they differ in one bit, the nearest code word of either
    is among those within 4 bits of the other.
    """

    def __init__(self):
        self.high = np.array([_remainder(v << 11) for v in range(1 << 12)], np.int64)
        found: list[list[int]] = [[] for _ in range(1 << 11)]
        for weight in range(5):
            for bits in itertools.combinations(range(23), weight):
                pattern = sum(1 << b for b in bits)
                near = found[int(self.high[pattern >> 11]) ^ (pattern & 0x7FF)]
                if weight < 4 or near[0].bit_count() == 3:
                    near.append(pattern)
        # Patterns short of six repeat the first one; the repeats are skipped.
        self.patterns = np.array([x + [x[0]] * (6 - len(x)) for x in found], np.int64)
        self.counts = np.array([len(x) for x in found])

    def near(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Indices of the code words within 4 bits, nearest first, in six columns, and which columns count."""
        syndrome = self.high[v >> 11] ^ (v & 0x7FF)
        return (v[:, None] ^ self.patterns[syndrome]) >> 11, np.arange(6) < self.counts[syndrome][:, None]


def fuzzy_keys(fps: np.ndarray, golay: Golay) -> tuple[np.ndarray, np.ndarray]:
    """(key, position in ``fps``): any two fingerprints within ``RADIUS`` bits share a key.

    Of four differing bits over three segments, either two segments have one at most each, or the bits lie
    two, two and none. For the first case there is a table per pair of segments: a fingerprint is filed
    under the nearest code word of one segment with every near code word of the other, both ways round. For
    the second case there is a table per segment: its exact bits with the near code words of the next one.
    """
    bits = fps.view(np.uint64)
    parts = [((bits >> np.uint64(a)) & np.uint64((1 << w) - 1)).astype(np.int64) for a, w in SEGMENTS]
    near = [golay.near(p) for p in parts]
    keys, at = [], []

    def file(number: int, key: np.ndarray, use: np.ndarray) -> None:
        where, column = np.nonzero(use)
        keys.append(key[where, column] | number << 36)
        at.append(where)

    for number, (x, y) in enumerate(itertools.combinations(range(3), 2)):
        (kx, ux), (ky, uy) = near[x], near[y]
        file(number, kx[:, :1] << 12 | ky, uy)
        file(number, kx << 12 | ky[:, :1], ux & (np.arange(6) > 0))
    for x in range(3):
        kx, ux = near[(x + 1) % 3]
        file(3 + x, parts[x][:, None] << 12 | kx, ux)
    return np.concatenate(keys), np.concatenate(at)


def links_within(fps: np.ndarray, radius: int = RADIUS) -> list[tuple[int, int]]:
    """Edges that connect exactly what is connected by fingerprints within ``radius`` bits.

    Searches breadth first; what is reached isn't compared again, so close groups cost little, and each
    group comes out as a star around its smallest fingerprint.
    """
    rest, out = fps.view(np.uint64), []
    while len(rest) > 1:
        group, todo, rest = [], [rest[0]], rest[1:]
        while todo:
            x = todo.pop()
            group.append(x)
            if len(rest):
                close = np.bitwise_count(rest ^ x) <= radius
                if close.any():
                    todo.extend(rest[close])
                    rest = rest[~close]
        if len(group) > 1:
            signed = np.array(group, np.uint64).view(np.int64)
            least = signed.min()
            out += [(int(least), int(x)) for x in signed if x != least]
    return out


def _small_runs(key: np.ndarray, fp: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """All links inside runs of equal keys that are short, by comparing rows that lie d apart."""
    a, b = [], []
    for d in range(1, longest):
        same = np.flatnonzero(key[d:] == key[:-d])
        if not len(same):
            break
        x, y = fp[same], fp[same + d]
        close = np.bitwise_count((x ^ y).view(np.uint64)) <= RADIUS
        a.append(x[close])
        b.append(y[close])
    return (np.concatenate(a), np.concatenate(b)) if a else (fp[:0], fp[:0])


SHORT = 8
_LINKS = "a long, b long, key long, piece int"


def _linked(batches, piece: int):
    """Links within sorted runs of (key, fp). Runs over ``piece`` rows also come out row by row, numbered by piece."""

    def emit(key: np.ndarray, fp: np.ndarray):
        if not len(key):
            return
        edges = np.flatnonzero(np.diff(key)) + 1
        starts, ends = np.concatenate([[0], edges]), np.concatenate([edges, [len(key)]])
        long = ends - starts > SHORT
        keep = np.repeat(~long, ends - starts)
        a, b = _small_runs(key[keep], fp[keep], SHORT)
        more = [x for s, e in zip(starts[long], ends[long]) for x in links_within(fp[s:e])]
        a = np.concatenate([a, np.array([x[0] for x in more], np.int64)])
        b = np.concatenate([b, np.array([x[1] for x in more], np.int64)])
        if len(a):
            none = pa.nulls(len(a))
            yield pa.record_batch({"a": a, "b": b, "key": none.cast(pa.int64()), "piece": none.cast(pa.int32())})

    def overflow(key: int, fp: np.ndarray, number: int):
        n = len(fp)
        yield pa.record_batch(
            {"a": fp, "b": pa.nulls(n, pa.int64()), "key": np.full(n, key), "piece": np.full(n, number, np.int32)}
        )

    held: list[tuple[np.ndarray, np.ndarray]] = []
    size, number, running = 0, 0, None
    for batch in itertools.chain(batches, [None]):
        if batch is not None:
            held.append(tuple(batch.column(c).to_numpy() for c in ("key", "fp")))
            size += batch.num_rows
            if size < piece:
                continue
        if not size:
            continue
        key, fp = (np.concatenate(x) for x in zip(*held))
        cut = len(key) if batch is None else int(np.searchsorted(key, key[-1]))
        if running is not None and (first := int(np.searchsorted(key, running, "right"))):
            # The run that filled a whole piece before goes on.
            for at in range(0, first, piece):
                part = fp[at : min(first, at + piece)]
                number += 1
                yield from emit(np.full(len(part), running), part)
                yield from overflow(running, part, number)
            key, fp, cut = key[first:], fp[first:], max(0, cut - first)
            if not len(key) and batch is not None:
                held, size = [], 0
                continue
        running = None
        if len(key) - cut >= piece:
            tail = fp[cut:]
            running, number = int(key[-1]), -1
            for at in range(0, len(tail), piece):
                part = tail[at : at + piece]
                number += 1
                yield from emit(np.full(len(part), running), part)
                yield from overflow(running, part, number)
            yield from emit(key[:cut], fp[:cut])
            key, fp = key[:0], fp[:0]
        else:
            yield from emit(key[:cut], fp[:cut])
            key, fp = key[cut:], fp[cut:]
        held, size = [(key, fp)], len(key)


def fingerprint_links(fps: DataFrame, piece: int = PIECE) -> DataFrame:
    """(a, b) links that connect what pairs of distinct fingerprints (fp) within ``RADIUS`` bits connect.

    Rows shuffled are some 45 keys a distinct fingerprint. A key's fingerprints are compared in one task up
    to ``piece`` of them; the pieces of a larger group are compared pair of pieces by pair of pieces, each
    pair in a group of its own.
    """
    spark = fps.sparkSession
    parts = shuffle_partitions(spark)

    def keyed(batches):
        golay = Golay()
        for batch in batches:
            fp = batch.column("fp").to_numpy()
            for at in range(0, len(fp), 4096):
                some = np.ascontiguousarray(fp[at : at + 4096])
                keys, where = fuzzy_keys(some, golay)
                yield pa.record_batch({"key": keys, "fp": some[where]})

    def link(batches):
        return _linked(batches, piece)

    keys = fps.mapInArrow(keyed, "key long, fp long")
    found = staged(keys.repartition(parts, "key").sortWithinPartitions("key").mapInArrow(link, _LINKS), "links")

    large = found.where("key is not null").select("key", "piece", F.col("a").alias("fp"))
    counts = large.groupBy("key").agg(F.max("piece").alias("last"))
    cells = (
        large.join(counts, "key")
        .where("last > 0")
        .withColumn("other", F.explode(F.sequence(F.lit(0), "last")))
        .where("other <> piece")
        .select(F.xxhash64("key", F.least("piece", "other"), F.greatest("piece", "other")).alias("key"), "fp")
    )

    def link_cells(batches):
        return _linked(batches, 2 * piece + 1)

    across = cells.repartition(parts, "key").sortWithinPartitions("key").mapInArrow(link_cells, _LINKS)
    return found.where("key is null").union(across.where("key is null")).select("a", "b").distinct()


def grouped(documents: DataFrame, shingle: int = SHINGLE, piece: int = PIECE) -> tuple[DataFrame, DataFrame]:
    """(doc_id, fp) of all rows, and (fp, root, component_id) of all distinct fingerprints, both written."""
    docs = staged(fingerprinted(documents, shingle), "fingerprints")
    return docs, fingerprint_groups(docs, piece)


def fingerprint_groups(docs: DataFrame, piece: int = PIECE) -> DataFrame:
    """(fp, root, component_id) of the distinct fingerprints in the written ``docs`` (doc_id, fp), written as well."""
    least = staged(docs.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    linked = components(fingerprint_links(least.select("fp"), piece))
    rooted = least.join(linked.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return staged(rooted.join(ids, "root").select("fp", "root", "component_id"), "mapping")


def near_duplicates(documents: DataFrame, shingle: int = SHINGLE, piece: int = PIECE) -> DataFrame:
    """(doc_id, fp, root, component_id) for every row of ``documents``.

    Documents link if their fingerprints differ in ``RADIUS`` bits at most; ``component_id`` is the
    smallest doc_id that is reachable, ``root`` names the component. Only distinct fingerprints are compared.
    Null and wordless texts share fingerprint zero, which is linked like any other. Repeated rows stay rows. Null
    doc_ids are never the smallest; a component of null ids only has a null id. An empty table gives no rows.
    """
    docs, mapping = grouped(documents, shingle, piece)
    return docs.join(mapping, "fp").select("doc_id", "fp", "root", "component_id")


def deduplicated(documents: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """One row of ``documents`` for each component, one of the smallest id, with all its columns.

    Of rows that share that id and the fingerprint one is kept; a component without ids keeps one row too.
    """
    docs, mapping = grouped(documents, shingle)
    kept = (
        docs.join(mapping, "fp")
        .where("doc_id <=> component_id")
        .groupBy("root")
        .agg(F.min("fp").alias("kept_fp"), F.first("component_id").alias("kept_id"))
        .drop("root")
    )
    own = free_name(documents, "fingerprint_of_row")

    def run(batches):
        for batch in slices(batches):
            data = ((x or "").encode("utf-8", "surrogatepass") for x in batch.column("text").to_pylist())
            fps = np.frombuffer(b"".join(fingerprint(x, shingle) for x in data), ">i8").astype(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(fps)], [*batch.schema.names, own])

    schema = T.StructType([*documents.schema.fields, T.StructField(own, T.LongType())])
    rows = documents.mapInArrow(run, schema)
    same = (rows[own] == kept["kept_fp"]) & rows["doc_id"].cast("long").eqNullSafe(kept["kept_id"])
    return rows.join(kept, same, "left_semi").dropDuplicates(["doc_id", own]).drop(own)


def digest(documents: DataFrame) -> DataFrame:
    """The columns that the registered query returns."""
    return near_duplicates(documents).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
