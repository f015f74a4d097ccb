"""Benchmark decontamination: SimHash of item-sized windows, Hamming blocks, exact weighted-shingle similarity."""

from __future__ import annotations

import re
from collections import defaultdict
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalloom.llm.common import slices, whole_text

WORD = re.compile(r"\w+")
SHINGLE = 5
THRESHOLD = 0.8
#: Texts of weighted Jaccard similarity 0.8 differ in 9.7 of 64 bits on average, with a deviation of 2.9.
RADIUS = 20
#: Bytes of benchmark text that go to every task at once; a larger benchmark is searched for in several passes.
BENCHMARK_BYTES = 64 << 20


class WordHashes(dict):
    """Word -> 64-bit hash; forgets all when it has grown large."""

    def __missing__(self, word: str) -> int:
        if len(self) >= 200_000:
            self.clear()
        found = self[word] = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        return found


def shingle_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """64-bit hashes of all runs of n words."""
    if len(words) < n:
        return np.empty(0, np.uint64)
    h = np.zeros(len(words) - n + 1, np.uint64)
    for i in range(n):
        h = h * np.uint64(0x9E3779B97F4A7C15) + words[i : len(words) - n + 1 + i]
        h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def window_fingerprints(hashes: np.ndarray, m: int) -> np.ndarray:
    """SimHash of every run of m shingles: a bit is 1 if set in over half of them."""
    bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).astype(np.int32)
    sums = np.concatenate([np.zeros((1, 64), np.int32), np.cumsum(bits, axis=0, dtype=np.int32)])
    majority = (sums[m:] - sums[:-m]) * 2 > m
    return np.packbits(majority, axis=1).view(">u8").ravel().astype(np.uint64)


def weighted_similarity(a: np.ndarray, b: dict[int, int], size: int) -> float:
    """Sum of the smaller over sum of the larger counts of the shingles of a and b (``size`` in all)."""
    found, counts = np.unique(a, return_counts=True)
    shared = sum(min(n, b.get(h, 0)) for h, n in zip(found.tolist(), counts.tolist()))
    return shared / (len(a) + size - shared)


def blocks_of(radius: int) -> list[tuple[int, int]]:
    """(shift, mask) of radius + 1 blocks that cover 64 bits: within the radius, one block at least is equal."""
    edges = np.linspace(0, 64, radius + 2).astype(int)
    return [(int(a), (1 << int(b - a)) - 1) for a, b in zip(edges, edges[1:])]


@dataclass
class ItemIndex:
    """Benchmark items by number of words, with their shingles and the block index of their fingerprints."""

    radius: int = RADIUS
    shingle: int = SHINGLE
    ids: list[int] = field(default_factory=list)
    counts: list[dict[int, int]] = field(default_factory=list)
    #: (words, shingle length) -> items of that size and their fingerprints.
    sizes: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = field(default_factory=dict)
    #: shingle length -> sorted shingles of all items, and for each the sizes of the items that have it.
    known: dict[int, tuple[np.ndarray, list[set[tuple[int, int]]]]] = field(default_factory=dict)

    def build(self, items: list[tuple[int, str]]) -> ItemIndex:
        """Items without words are left out; equal texts count once, under their smallest id."""
        hashes, seen = WordHashes(), set()
        by_size: dict[tuple[int, int], list[tuple[int, int]]] = defaultdict(list)
        where: dict[int, dict[int, set[tuple[int, int]]]] = defaultdict(lambda: defaultdict(set))
        for item, text in sorted(items):
            words = np.array([hashes[w] for w in WORD.findall(text.lower())], np.uint64)
            if not len(words) or words.tobytes() in seen:
                continue
            seen.add(words.tobytes())
            n = min(self.shingle, len(words))
            own = shingle_hashes(words, n)
            size = (len(words), n)
            by_size[size].append((len(self.ids), int(window_fingerprints(own, len(own))[0])))
            self.ids.append(item)
            self.counts.append(dict(zip(*(x.tolist() for x in np.unique(own, return_counts=True)))))
            for h in own.tolist():
                where[n][h].add(size)
        self.sizes = {
            s: (np.array([i for i, _ in v], np.int64), np.array([f for _, f in v], np.uint64)) for s, v in by_size.items()
        }
        for n, found in where.items():
            order = sorted(found)
            self.known[n] = (np.array(order, np.uint64), [found[h] for h in order])
        return self

    def within(self, fps: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All (position in fps, position in own) whose fingerprints differ in ``radius`` bits at most, by blocks."""
        near = np.zeros((len(fps), len(own)), bool)
        for shift, mask in blocks_of(self.radius):
            a = (fps >> np.uint64(shift)) & np.uint64(mask)
            b = (own >> np.uint64(shift)) & np.uint64(mask)
            for value in np.unique(b):
                near[np.ix_(np.flatnonzero(a == value), np.flatnonzero(b == value))] = True
        at, item = np.nonzero(near)
        close = np.bitwise_count(fps[at] ^ own[item]) <= self.radius
        return at[close], item[close]

    def matches(self, words: np.ndarray, threshold: float) -> dict[int, tuple[float, int, int]]:
        """Item position -> (similarity, first word, words) of its best window in the document.

        A window that is similar enough shares a shingle with its item, so only the windows that hold a
        shingle of an item of their size are fingerprinted; none that could match is passed over. A document
        shorter than an item is one window.
        """
        best: dict[int, tuple[float, int, int]] = {}
        for n, (shingles, sizes) in self.known.items():
            own = shingle_hashes(words, n)
            if not len(own):
                continue
            at = np.minimum(np.searchsorted(shingles, own), len(shingles) - 1)
            hits = np.flatnonzero(shingles[at] == own)
            if not len(hits):
                continue
            places: dict[tuple[int, int], list[int]] = defaultdict(list)
            for i, k in zip(hits.tolist(), at[hits].tolist()):
                for size in sizes[k]:
                    places[size].append(i)
            for size, found in places.items():
                self._windows(own, size, found, threshold, best)
        return best

    def _windows(self, own: np.ndarray, size: tuple[int, int], hits: list[int], threshold: float, best: dict) -> None:
        length, n = size
        m = min(length - n + 1, len(own))
        items, fps = self.sizes[size]
        last = len(own) - m
        # Stretches of window starts around the hits, joined where they meet.
        stretches: list[list[int]] = []
        for i in hits:
            a, b = max(0, min(last, i - m + 1)), min(last, i)
            if stretches and a <= stretches[-1][1] + 1:
                stretches[-1][1] = max(stretches[-1][1], b)
            else:
                stretches.append([a, b])
        for a, b in stretches:
            for start in range(a, b + 1, 4096):
                stop = min(b, start + 4095)
                at, which = self.within(window_fingerprints(own[start : stop + m], m), fps)
                for w, k in zip(at.tolist(), which.tolist()):
                    item = int(items[k])
                    window = own[start + w : start + w + m]
                    total = length - n + 1
                    likeness = weighted_similarity(window, self.counts[item], total)
                    if likeness >= threshold and (item not in best or likeness > best[item][0]):
                        best[item] = (likeness, start + w, m + n - 1)


def item_indices(benchmark: DataFrame, radius: int = RADIUS, most: int = BENCHMARK_BYTES) -> list[ItemIndex]:
    """One index per ``most`` bytes of benchmark text (measured first), each of which is searched for in a pass.

    Null texts, and null ids, are no items.
    """
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("item_id is not null and text is not null")
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    passes = max(1, -(-size // most))
    part = F.pmod(F.xxhash64("text"), F.lit(passes))
    return [
        ItemIndex(radius).build([(r["item_id"], r["text"]) for r in items.where(part == i).collect()]) for i in range(passes)
    ]


def _word_hashes(text: str | None, hashes: WordHashes) -> np.ndarray:
    words = WORD.findall(text.lower()) if text else []
    return np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))


def contaminated(documents: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, radius: int = RADIUS) -> DataFrame:
    """(doc_id, item_id, similarity, first_word, n_words): each item found in each document, at its best window.

    Windows are as long as the item, in words (runs of letters and digits, lower case). The similarity of the
    shingles of five words, repeats counted, is ``threshold`` or more. Shorter items are one shingle. Null
    and empty texts have no rows, repeated documents have rows each; of windows that tie the first is named.
    """
    spark = documents.sparkSession
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    schema = "doc_id long, item_id long, similarity double, first_word long, n_words long"
    out = None
    for index in item_indices(benchmark, radius):
        shared = spark.sparkContext.broadcast(index)

        def run(batches, shared=shared):
            own, hashes = shared.value, WordHashes()
            for batch in slices(batches):
                rows = []
                for i, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                    found = own.matches(_word_hashes(text, hashes), threshold)
                    rows += [(i, own.ids[k], *found[k]) for k in sorted(found)]
                if rows:
                    kinds = (pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64())
                    names = ("doc_id", "item_id", "similarity", "first_word", "n_words")
                    yield pa.record_batch({n: pa.array(c, k) for n, c, k in zip(names, zip(*rows), kinds)})

        found = docs.mapInArrow(run, schema)
        out = found if out is None else out.union(found)
    return out


def decontaminated(documents: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, radius: int = RADIUS) -> DataFrame:
    """The rows of ``documents`` in which no item is found, with all their columns."""
    for index in item_indices(benchmark, radius):
        shared = documents.sparkSession.sparkContext.broadcast(index)

        def run(batches, shared=shared):
            own, hashes = shared.value, WordHashes()
            for batch in slices(batches):
                clean = [not own.matches(_word_hashes(t, hashes), threshold) for t in batch.column("text").to_pylist()]
                yield batch.filter(pa.array(clean, pa.bool_()))

        documents = documents.mapInArrow(run, documents.schema)
    return documents
