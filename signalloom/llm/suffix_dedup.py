"""Repeated byte strings across documents, removed exactly by prefix doubling on sampled suffixes.

A full suffix array would sort every byte position in every round. Here names of growing prefixes are ranked
instead, only where they can matter:

* Names of 24 bytes. In every window of 50 bytes the position whose 24 bytes have the least hash is kept.
  Equal windows keep the same place, so a repeated string can't be missed, and one position in 14 remains.
  Spark sorts (name, position) and drops names that are in one document only.
* Names of the doubled reach: all the bytes of the windows that share a kept position, 50 to 76 of them. If that is
  repeated too, all its windows are, and the suffix is settled.
* Names of 50 bytes, the threshold, window by window, for the rest: the edges of copies.

Within a document a longer name is made of the prefix sums of shorter ones, so only the ranking across
documents moves data: sorted, compressed columns of (name, document), one row per pair of map chunk and bucket.
Each chunk first settles what it can see itself and sends a name once, from its smallest document.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalloom.llm.common import shuffle_partitions, slices, whole_text

LENGTH = 50
GRAM = 24
#: Positions of a gram in a window.
REACH = LENGTH - GRAM + 1
#: Window starts that are worked on at once; a longer document is done piece by piece.
PIECE = 1 << 20
_PLACE = np.uint64((1 << 21) - 1)
#: Names that a map task holds before it settles and sends them.
CHUNK = 1 << 21
#: Different surroundings of one gram that a chunk sends to be ranked; beyond, they go window by window.
SURROUNDINGS = 8
#: Stands for a null doc_id, which is larger than any other.
NO_ID = (1 << 63) - 1

_rng = np.random.default_rng(2024)
_BYTES = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = int(_rng.integers(1 << 40, 1 << 62)) * 8 + 5
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out)


class Names:
    """Hashes of any substring of a piece of text, from prefix sums of byte values times powers."""

    _up = _down = np.ones(1, np.uint64)

    def __init__(self, piece: np.ndarray):
        n = len(piece)
        if len(Names._up) < n + 1:
            size = min(PIECE + 2 * LENGTH, max(2 * n, 1 << 14)) + 1
            Names._up, Names._down = _powers(_BASE, size), _powers(_INVERSE, size)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTES[piece] * Names._up[:n], out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return _mixed((self.sums[ends] - self.sums[starts]) * Names._down[starts])

    def every(self, length: int) -> np.ndarray:
        n = len(self.sums) - length
        return _mixed((self.sums[length:] - self.sums[:n]) * Names._down[:n])


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def kept_positions(names: Names) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first, last, gram, reach): runs of windows that share a kept position, and its names.

    ``gram`` has 40 bits, as it only sorts out; ``reach`` has 48 bits more, for the windows' bytes and the place of
    the kept position among them.
    """
    grams = names.every(GRAM)
    key = (grams & ~_PLACE) | np.arange(len(grams), dtype=np.uint64)
    for step in (1, 2, 4, 8):
        key = np.minimum(key[:-step], key[step:])
    key = np.minimum(key[: len(key) - (REACH - 16)], key[REACH - 16 :])
    first = np.concatenate([[0], np.flatnonzero(key[1:] != key[:-1]) + 1])
    last = np.append(first[1:] - 1, len(key) - 1)
    place = (key[first] & _PLACE).astype(np.int64)
    shape = ((place - first) * 64 + (last - first)).astype(np.uint64)
    reach = _mixed(names.of(first, last + LENGTH) + shape) >> np.uint64(16)
    return first, last, grams[place] >> np.uint64(24), reach


def pieces(data: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(offset, bytes) of pieces that hold all windows of a document, each once."""
    for start in range(0, len(data) - LENGTH + 1, PIECE):
        yield start, data[start : start + PIECE + LENGTH - 1]


def packed(*columns: np.ndarray) -> bytes:
    """Columns of 64-bit numbers as compressed planes of bytes; the first, which is sorted, as differences."""
    columns = [c.astype(np.uint64) for c in columns]
    columns[0] = np.diff(columns[0], prepend=np.uint64(0))
    planes = np.concatenate([c.view(np.uint8).reshape(-1, 8).T.ravel() for c in columns])
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpacked(blobs: list[bytes], n: int) -> list[np.ndarray]:
    out: list[list[np.ndarray]] = [[] for _ in range(n)]
    for blob in blobs:
        planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8).reshape(n, 8, -1)
        for i, p in enumerate(planes):
            column = np.ascontiguousarray(p.T).view(np.uint64).ravel()
            out[i].append(np.cumsum(column, dtype=np.uint64) if i == 0 else column)
    return [np.concatenate(c) if c else np.empty(0, np.uint64) for c in out]


def bucket_of(x: np.ndarray, parts: int) -> np.ndarray:
    return (_mixed(x.astype(np.uint64) ^ np.uint64(0x5851F42D4C957F2D)) % np.uint64(parts)).astype(np.int32)


# Kinds of rows, in the order in which a task meets them.
NAMES, SETTLED, OPEN, RANGES, REPEATED, TEXT = range(6)
_ROWS = "dest int, kind int, doc long, blob binary"


def _batch(rows: list[tuple[int, int, int, bytes]]) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.int32(), pa.int64(), pa.binary())
    return pa.record_batch({n: pa.array(c, k) for n, c, k in zip(("dest", "kind", "doc", "blob"), zip(*rows), kinds)})


def _sent(kind: int, dest: np.ndarray, *columns: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows of ``columns``, grouped by destination and sorted by the first one."""
    if not len(dest):
        return
    order = np.lexsort((columns[0], dest))
    dest, columns = dest[order], [c[order] for c in columns]
    starts = np.concatenate([[0], np.flatnonzero(np.diff(dest)) + 1, [len(dest)]])
    rows, size = [], 0
    for a, b in zip(starts, starts[1:]):
        blob = packed(*[c[a:b] for c in columns])
        rows.append((int(dest[a]), kind, None, blob))
        size += len(blob)
        if size >= 4 << 20:
            yield _batch(rows)
            rows, size = [], 0
    if rows:
        yield _batch(rows)


def _marks(kind: int, doc: np.ndarray, name: np.ndarray, parts: int, *more: np.ndarray) -> Iterator[pa.RecordBatch]:
    """What a document's own task should know, sent to where the document will be."""
    yield from _sent(kind, bucket_of(doc, parts), doc, name, *more)


def _groups(*columns: np.ndarray) -> np.ndarray:
    """Whether each row of sorted columns begins a new combination."""
    new = np.zeros(len(columns[0]), bool)
    if len(new):
        new[0] = True
        for c in columns:
            new[1:] |= c[1:] != c[:-1]
    return new


def _ids(doc: np.ndarray) -> np.ndarray:
    """Doc ids as unsigned numbers in the same order."""
    return doc.astype(np.int64).view(np.uint64) ^ np.uint64(1 << 63)


def settle(gram: np.ndarray, reach: np.ndarray, doc: np.ndarray, parts: int, whole: bool) -> Iterator[pa.RecordBatch]:
    """Rank (gram, reach) and send on what follows from it.

    A reach that a smaller document has too is settled. Where one gram has several surroundings in several
    documents, the smallest document of each is open, to be ranked window by window. In a chunk (not ``whole``)
    the smallest document of each (gram, reach) goes on to be ranked with those of other chunks; of grams with very
    many surroundings only the smallest one does, which tells others that the gram is repeated.
    """
    order = np.lexsort((doc, reach, gram))
    gram, reach, doc = gram[order], reach[order], doc[order]
    new = _groups(gram, reach, doc)
    gram, reach, doc = gram[new], reach[new], doc[new]
    head = _groups(gram, reach)
    least = doc[np.flatnonzero(head)[np.cumsum(head) - 1]]
    later = doc > least
    yield from _marks(SETTLED, doc[later], reach[later], parts)
    gram, reach, doc = gram[head], reach[head], doc[head]
    starts = np.flatnonzero(_groups(gram))
    if not len(starts):
        return
    sizes = np.diff(np.append(starts, len(gram)))
    low, high = np.minimum.reduceat(doc, starts), np.maximum.reduceat(doc, starts)
    spread = np.repeat((sizes > (1 if whole else SURROUNDINGS)) & (high > low), sizes)
    yield from _marks(OPEN, doc[spread], reach[spread], parts)
    if not whole:
        smallest = np.repeat(low, sizes) == doc
        goes = ~spread | smallest
        yield from _sent(NAMES, bucket_of(gram[goes], parts), gram[goes], reach[goes], doc[goes])


def settle_windows(window: np.ndarray, doc: np.ndarray, parts: int, whole: bool) -> Iterator[pa.RecordBatch]:
    """The same for windows: those that a smaller document has are repeated, the rest of a chunk goes on."""
    order = np.lexsort((doc, window))
    window, doc = window[order], doc[order]
    new = _groups(window, doc)
    window, doc = window[new], doc[new]
    head = _groups(window)
    if not len(head):
        return
    later = doc > doc[np.flatnonzero(head)[np.cumsum(head) - 1]]
    yield from _marks(REPEATED, doc[later], window[later], parts)
    if not whole:
        yield from _sent(NAMES, bucket_of(window[head], parts), window[head], doc[head])


def _bytes_of(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass")


def _by_dest(batches) -> Iterator[tuple[int, Iterator[tuple[int, int | None, bytes]]]]:
    def rows():
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                yield from zip(*[part.column(c).to_pylist() for c in ("dest", "kind", "doc", "blob")])

    for dest, group in itertools.groupby(rows(), key=lambda r: r[0]):
        yield dest, (r[1:] for r in group)


def _ranked(df: DataFrame, parts: int, columns: int) -> DataFrame:
    """Settle names where they meet; marks that pass through stay as they are."""

    def run(batches):
        for dest, rows in _by_dest(batches):
            names = []
            for kind, _, blob in rows:
                if kind == NAMES:
                    names.append(blob)
                else:
                    yield _batch([(dest, kind, None, blob)])
            if names:
                found = unpacked(names, columns)
                yield from settle(*found, parts, True) if columns == 3 else settle_windows(*found, parts, True)

    return df.repartition(parts, "dest").sortWithinPartitions("dest").mapInArrow(run, _ROWS)


def _beside_marks(documents: DataFrame, marks: DataFrame, parts: int) -> DataFrame:
    """Compressed texts and marks by destination, the marks first."""

    def run(batches):
        pack = zstandard.ZstdCompressor(level=3).compress
        for batch in slices(batches):
            ids = batch.column("doc_id").to_pylist()
            dest = bucket_of(_ids(np.array([NO_ID if i is None else i for i in ids], np.int64)), parts).tolist()
            yield _batch([(d, TEXT, i, pack(_bytes_of(t))) for d, i, t in zip(dest, ids, batch.column("text").to_pylist())])

    texts = documents.mapInArrow(run, _ROWS)
    return marks.union(texts).repartition(parts, "dest").sortWithinPartitions("dest", "kind", "doc")


class MarkTable:
    """Marks of one kind by document."""

    def __init__(self, blobs: list[bytes], columns: int):
        doc, *rest = unpacked(blobs, columns)
        order = np.argsort(doc, kind="stable")
        self.doc, self.rest = doc[order], [c[order] for c in rest]

    def of(self, doc: int) -> list[np.ndarray]:
        a, b = np.searchsorted(self.doc, np.array([doc], np.uint64), "left")[0], np.searchsorted(self.doc, np.array([doc], np.uint64), "right")[0]
        return [c[a:b] for c in self.rest]


def _document_id(doc: int | None) -> int:
    return (NO_ID if doc is None else doc) + (1 << 63)


def _windows(df: DataFrame, parts: int) -> DataFrame:
    """From settled and open reaches: byte ranges that are repeated, and the names of windows still open."""

    def run(batches):
        windows: list[np.ndarray] = []
        docs: list[np.ndarray] = []
        ranges: list[tuple[int, int, int, int]] = []
        size = 0

        def out():
            if windows:
                yield from settle_windows(np.concatenate(windows), np.concatenate(docs), parts, False)
            if ranges:
                doc, a, b, own = (np.array(c, np.uint64) for c in zip(*ranges))
                yield from _marks(RANGES, doc, a, parts, b, own)

        for _, rows in _by_dest(batches):
            blobs: dict[int, list[bytes]] = {SETTLED: [], OPEN: []}
            tables = None
            for kind, i, blob in rows:
                if kind != TEXT:
                    blobs[kind].append(blob)
                    continue
                if tables is None:
                    tables = [MarkTable(blobs[k], 2) for k in (SETTLED, OPEN)]
                doc = _document_id(i)
                (settled,), (opened,) = tables[0].of(doc), tables[1].of(doc)
                if not len(settled) and not len(opened):
                    continue
                data = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
                own = xxhash.xxh64_intdigest(data)
                for offset, piece in pieces(data):
                    names = Names(piece)
                    first, last, _, reach = kept_positions(names)
                    done = np.isin(reach, settled)
                    for a, b in zip(first[done].tolist(), last[done].tolist()):
                        if ranges and ranges[-1][0] == doc and ranges[-1][3] == own and ranges[-1][1] <= a + offset <= ranges[-1][2]:
                            ranges[-1] = (doc, ranges[-1][1], max(ranges[-1][2], b + offset + LENGTH), own)
                        else:
                            ranges.append((doc, a + offset, b + offset + LENGTH, own))
                    todo = np.isin(reach, opened) & ~done
                    if todo.any():
                        inside = np.zeros(int(last[-1]) + 2, np.int32)
                        np.add.at(inside, first[todo], 1)
                        np.add.at(inside, last[todo] + 1, -1)
                        starts = np.flatnonzero(np.cumsum(inside) > 0)
                        windows.append(names.of(starts, starts + LENGTH))
                        docs.append(np.full(len(starts), doc, np.uint64))
                        size += len(starts)
                if size >= CHUNK or len(ranges) >= CHUNK:
                    yield from out()
                    windows, docs, ranges, size = [], [], [], 0
        yield from out()

    return df.mapInArrow(run, _ROWS)


_RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _removed(df: DataFrame) -> DataFrame:
    def run(batches):
        for _, rows in _by_dest(batches):
            blobs: dict[int, list[bytes]] = {RANGES: [], REPEATED: []}
            tables, out = None, []
            for kind, i, blob in rows:
                if kind != TEXT:
                    blobs[kind].append(blob)
                    continue
                if tables is None:
                    tables = MarkTable(blobs[RANGES], 4), MarkTable(blobs[REPEATED], 2)
                data = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
                doc = _document_id(i)
                (a, b, own), (repeated,) = tables[0].of(doc), tables[1].of(doc)
                n = len(data)
                edge = np.zeros(n + 1, np.int32)
                # Another row may share the id; ranges are of one text, repeated windows are found by their bytes.
                mine = own == np.uint64(xxhash.xxh64_intdigest(data))
                a, b = a[mine], b[mine]
                np.add.at(edge, a.astype(np.int64), 1)
                np.add.at(edge, b.astype(np.int64), -1)
                if len(repeated):
                    for offset, piece in pieces(data):
                        starts = np.flatnonzero(np.isin(Names(piece).every(LENGTH), repeated)) + offset
                        np.add.at(edge, starts, 1)
                        np.add.at(edge, starts + LENGTH, -1)
                gone = np.cumsum(edge[:n]) > 0
                spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()) if n else 0
                out.append((i, n, int(gone.sum()), spans, hashlib.sha256(data[~gone].tobytes()).hexdigest()))
                if len(out) >= 1024:
                    yield _result(out)
                    out = []
            if out:
                yield _result(out)

    return df.mapInArrow(run, _RESULT)


def _result(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string())
    names = [x.split()[0] for x in _RESULT.split(", ")]
    return pa.record_batch({n: pa.array(c, k) for n, c, k in zip(names, zip(*rows), kinds)})


def without_repeats(documents: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) for every row of ``documents``.

    A byte goes if a string of ``LENGTH`` bytes around it also starts in a document of a smaller doc_id; all is judged
    on the input. Null text is empty; texts shorter than that lose nothing. Rows of equal id don't take from each
    other. A null doc_id is larger than all others.
    """
    parts = shuffle_partitions(documents.sparkSession)
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))

    def names(batches):
        held: list[list[np.ndarray]] = [[], [], []]
        size = 0
        for batch in slices(batches):
            for i, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                for _, piece in pieces(np.frombuffer(_bytes_of(text), np.uint8)):
                    _, _, gram, reach = kept_positions(Names(piece))
                    for column, x in zip(held, (gram, reach, np.full(len(gram), _document_id(i), np.uint64))):
                        column.append(x)
                    size += len(gram)
            if size >= CHUNK:
                yield from settle(*map(np.concatenate, held), parts, False)
                held, size = [[], [], []], 0
        if size:
            yield from settle(*map(np.concatenate, held), parts, False)

    marks = _ranked(docs.mapInArrow(names, _ROWS), parts, 3)
    windows = _windows(_beside_marks(docs, marks, parts), parts)
    return _removed(_beside_marks(docs, _ranked(windows, parts, 2), parts))
