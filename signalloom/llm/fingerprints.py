"""Document fingerprints by consistent weighted sampling."""

from __future__ import annotations

import hashlib
from collections import Counter
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalloom.llm.common import shuffle_partitions, slices, whole_text

SAMPLES = 64
#: A word of more code points than this counts as its overlapping pieces, so that text without spaces has terms.
LONGEST_WORD = 24
PIECE = 6
#: Terms whose random numbers a task keeps at hand.
KEPT_TERMS = 1 << 15


def terms(text: str) -> Counter:
    """Lower-case words of the text with their counts, which are the weights."""
    found = Counter(text.lower().split())
    for word in [w for w in found if len(w) > LONGEST_WORD]:
        n = found.pop(word)
        for i in range(len(word) - PIECE + 1):
            found[word[i : i + PIECE]] += n
    return found


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of the result depends on every bit of x."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class Sampler:
    """Draws ``samples`` consistent samples of a weighted set.

    For term and sample number, r and c are Gamma(2, 1) and b is uniform, all functions of the term alone. With
    t = floor(ln w / r + b) and y = exp(r (t - b)), the term of the least c / (y e^r) is drawn together with
    its t. Two sets draw alike with the probability of their generalised Jaccard similarity. A weight of one
    has t = 0, so those terms need no arithmetic but the minimum.
    """

    def __init__(self, samples: int = SAMPLES, kept: int = KEPT_TERMS):
        self.samples, self.kept = samples, kept
        self.rows: dict[str, int] = {}
        self.hashes = np.empty(kept, np.uint64)
        self.r, self.b, self.c, self.one = (np.empty((kept, samples), np.float32) for _ in range(4))
        self.step = _mixed(np.arange(1, samples + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))

    def _draw(self, start: int, new: list[str]) -> None:
        h = np.array([xxhash.xxh64_intdigest(t.encode("utf-8", "surrogatepass"), 1) for t in new], np.uint64)
        half, unit = np.float32(0.5), np.float32(2**-32)
        for at in range(0, len(new), 256):
            own = h[at : at + 256]
            rows = slice(start + at, start + at + len(own))
            first = own[:, None] ^ self.step

            def uniform(x: np.ndarray) -> np.ndarray:
                u = x.astype(np.float32)
                u += half  # noqa: B023
                u *= unit  # noqa: B023
                return u

            def gamma(number: int) -> np.ndarray:
                x = _mixed(first + np.uint64(number))  # noqa: B023
                u = uniform(x >> np.uint64(32))
                u *= uniform(x & np.uint64(0xFFFFFFFF))
                np.log(u, out=u)
                return np.negative(u, out=u)

            r, c = gamma(1), np.log(np.maximum(gamma(2), np.float32(1e-30)))
            # Below one, so that a weight of one always has t = 0.
            b = np.minimum(uniform(_mixed(first + np.uint64(3)) >> np.uint64(32)), np.float32(1 - 2**-24))
            self.hashes[rows], self.r[rows], self.b[rows], self.c[rows] = own, r, b, c
            self.one[rows] = c + r * b - r

    def _rows(self, found: list[str]) -> np.ndarray:
        rows = np.fromiter(map(self.rows.get, found, repeat(-1)), np.int64, len(found))
        missing = np.flatnonzero(rows < 0)
        if len(self.rows) + len(missing) > self.kept:
            self.rows, missing = {}, np.arange(len(found))
        new, start = [found[i] for i in missing.tolist()], len(self.rows)
        self.rows.update(zip(new, range(start, start + len(new))))
        self._draw(start, new)
        rows[missing] = np.arange(start, start + len(new))
        return rows

    def __call__(self, text: str) -> np.ndarray:
        """``samples`` numbers of 16 bits; all zero for a text without terms."""
        found = terms(text)
        least = np.full(self.samples, np.inf, np.float32)
        drawn = np.zeros(self.samples, np.uint64)
        every = sorted(found) if len(found) > self.kept else list(found)
        # A longer list of terms is drawn from piece by piece; the least of all pieces wins.
        for at in range(0, len(every), self.kept):
            part = every[at : at + self.kept]
            rows = self._rows(part)
            weight = np.fromiter(map(found.__getitem__, part), np.int64, len(part))
            for some, score, t in self._scores(rows, weight):
                low = score.argmin(axis=0)
                columns = np.arange(self.samples)
                value, h = score[low, columns], self.hashes[some[low]]
                if t is not None:
                    h = h + t[low, columns].astype(np.int64).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                # Of equal scores the smaller hash is drawn, whatever the order of the terms.
                first = (value < least) | (value == least) & (h < drawn)
                least, drawn = np.where(first, value, least), np.where(first, h, drawn)
        if not every:
            return np.zeros(self.samples, np.uint16)
        return (_mixed(drawn) >> np.uint64(48)).astype(np.uint16)

    def _scores(self, rows: np.ndarray, weight: np.ndarray):
        ones, more = rows[weight == 1], rows[weight > 1]
        logs = np.log(weight[weight > 1].astype(np.float32))
        for at in range(0, len(ones), 4096):
            yield ones[at : at + 4096], self.one[ones[at : at + 4096]], None
        for at in range(0, len(more), 4096):
            some = more[at : at + 4096]
            r, b = self.r[some], self.b[some]
            t = np.floor(logs[at : at + 4096, None] / r + b)
            yield some, self.c[some] - r * (t - b) - r, t


def shown(fp: np.ndarray) -> str:
    return fp.astype(">u2").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of equal samples: an estimate of the generalised Jaccard similarity, 1 for equal sets."""
    return float((a == b).mean())


def fingerprinted(documents: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """(doc_id, fingerprint) for every row: four hexadecimal digits a sample. Null and empty texts have all zeros."""

    def run(batches):
        sampler = Sampler(samples)
        for batch in slices(batches):
            fps = [shown(sampler(t)) for t in batch.column("text").to_pylist()]
            yield pa.record_batch({"doc_id": batch.column("doc_id"), "fingerprint": pa.array(fps, pa.string())})

    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    return docs.mapInArrow(run, "doc_id long, fingerprint string")


def beside_next(documents: DataFrame) -> DataFrame:
    """(bucket, ghost, doc_id, tie, packed) in which a row's next one, by descending doc_id, follows it in its task.

    Approximate quantiles of doc_id cut the order into buckets. They are doubles, which not every id is, so the head of
    a bucket, its largest id, is looked up. It is copied to the end of the one before (``ghost``), that of the first to the last. So one shuffle of
    compressed text brings all neighbours together. Null ids come last; rows of equal id follow by ``tie``, a hash
    of the text.
    """
    spark = documents.sparkSession
    parts = shuffle_partitions(spark)
    docs = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"), F.xxhash64(whole_text()).alias("tie")
    )
    ends = docs.agg(F.max("doc_id").alias("top"), F.min(F.when(F.col("doc_id").isNull(), F.col("tie"))).alias("null")).first()
    cuts = docs.approxQuantile("doc_id", [i / parts for i in range(1, parts)], 0.2 / parts) if ends["top"] is not None else []
    edges = np.array(sorted({min(max(int(x), -(1 << 63)), (1 << 63) - 1) for x in cuts}), np.int64)

    def tops(batches):
        for batch in batches:
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64)
            at, most = np.searchsorted(edges, ids), np.full(len(edges) + 1, -(1 << 63), np.int64)
            np.maximum.at(most, at, ids)
            yield pa.record_batch({"at": np.unique(at), "top": most[np.unique(at)]})

    some = docs.select("doc_id").where("doc_id is not null").mapInArrow(tops, "at long, top long")
    heads = np.array(sorted((r["top"] for r in some.groupBy("at").agg(F.max("top").alias("top")).collect()), reverse=True), np.int64)
    null_tie, last = ends["null"], len(heads) - (ends["null"] is None)

    def run(batches):
        pack = zstandard.ZstdCompressor(level=1).compress
        for batch in slices(batches):
            out = []
            ids, ties = batch.column("doc_id").to_pylist(), batch.column("tie").to_pylist()
            for i, tie, text in zip(ids, ties, batch.column("text").to_pylist()):
                blob = pack(text.encode("utf-8", "surrogatepass"))
                bucket = len(heads) if i is None else len(heads) - int(np.searchsorted(heads[::-1], i)) - 1
                out.append((bucket, False, i, tie, blob))
                if i is None:
                    if tie == null_tie:
                        out.append((bucket - 1 if len(heads) else last, True, i, tie, blob))
                elif heads[bucket] == i:
                    out.append(((bucket or last + 1) - 1, True, i, tie, blob))
            columns = list(zip(*out))
            kinds = (pa.int32(), pa.bool_(), pa.int64(), pa.int64(), pa.binary())
            names = ("bucket", "ghost", "doc_id", "tie", "packed")
            yield pa.record_batch({n: pa.array(c, k) for n, c, k in zip(names, columns, kinds)})

    rows = docs.mapInArrow(run, "bucket int, ghost boolean, doc_id long, tie long, packed binary")
    return rows.repartitionById(parts, "bucket").sortWithinPartitions(
        "bucket", "ghost", F.col("doc_id").desc_nulls_last(), "tie"
    )


def compared(documents: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """One row per document with its fingerprint, that of its edited text, and their likeness.

    In the edited text the last third of the code points (rounded down) is replaced by as many from the start of the
    next document by descending doc_id, all of it if it is shorter; after the last document comes the first. Null text
    is empty. Two empty texts are alike (1), an empty and a full one aren't (0). A single row is its own next.
    """

    def run(batches):
        unpack = zstandard.ZstdDecompressor().decompress
        sampler = Sampler(samples)
        rows: list[tuple] = []
        before = None

        def row(own: tuple, following: tuple) -> tuple:
            (_, i, text, fp), (_, _, other, other_fp) = own, following
            cut = len(text) // 3
            edited = text[: len(text) - cut] + other[:cut]
            efp = sampler(edited) if cut else fp
            sha = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()
            return (i, len(text), sha, shown(fp), shown(efp), likeness(fp, efp), likeness(fp, other_fp))

        def out() -> pa.RecordBatch:
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
            names = ("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")
            return pa.record_batch({n: pa.array(c, k) for n, c, k in zip(names, zip(*rows), kinds)})

        for batch in (b.slice(a, 256) for b in batches for a in range(0, b.num_rows, 256)):
            columns = [batch.column(c).to_pylist() for c in ("bucket", "ghost", "doc_id", "packed")]
            for bucket, ghost, i, blob in zip(*columns):
                if ghost and (before is None or before[0] != bucket):
                    continue
                text = unpack(blob).decode("utf-8", "surrogatepass")
                now = (bucket, i, text, sampler(text))
                if before is not None and before[0] == bucket:
                    rows.append(row(before, now))
                before = None if ghost else now
            if len(rows) >= 256:
                yield out()
                rows.clear()
        if rows:
            yield out()

    return beside_next(documents).mapInArrow(
        run,
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double",
    )
