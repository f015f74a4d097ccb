"""Toxicity by the nearest labelled examples: exact TF-IDF cosine over a block-max inverted index."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalloom.llm.common import map_batches, slices, whole_text
from signalloom.operators.staging import staged

WORD = re.compile(r"\w+")


@dataclass(frozen=True)
class ToxicityParams:
    """Bounds and weights of the model; the bounds hold for what is learned, never for what is scored."""

    #: Most labelled documents to learn from (those of the smallest hashes); each costs about 20 bytes a term.
    max_labelled: int = 20_000
    neighbours: int = 25
    block: int = 64
    #: Cosine distance at which a neighbour's vote falls to 1/e.
    width: float = 0.3
    #: Votes of the examples' base rate that every score starts from.
    prior_votes: float = 1.0


def held_out(doc_id: Column, modulus: int, remainder: int) -> Column:
    """Whether crc32 of the id as text has this remainder; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % modulus == remainder, F.lit(False))


def labelled_sample(documents: DataFrame, labels: DataFrame, label: str, modulus: int, remainder: int, most: int) -> DataFrame:
    """(doc_id, text, y): labelled documents outside the held-out fold, one row per text.

    At most ``most`` labels are used, those with the smallest md5 of the id, so their ids may be broadcast
    and documents aren't shuffled. Null ids and labels are left out; of conflicting labels of an id the
    larger counts, of equal texts the smallest id.
    """
    ids = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y"))
        .where(F.col("doc_id").isNotNull() & F.col("y").isin(0, 1) & ~held_out(F.col("doc_id"), modulus, remainder))
        .groupBy("doc_id")
        .agg(F.max("y").alias("y"))
        .orderBy(F.md5(F.col("doc_id").cast("string")))
        .limit(most)
    )
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    rows = docs.join(F.broadcast(ids), "doc_id").withColumn("hash", F.sha2("text", 256))
    first = rows.groupBy("hash").agg(F.min(F.struct("doc_id", "y", "text")).alias("r"))
    return first.select("r.doc_id", "r.text", "r.y")


#: A longer word counts as itself and by its beginning of so many letters, which catches inflected and compound forms.
BEGINNING = 5


def words(text: str) -> list[str]:
    return WORD.findall(text.lower())


def terms_of(word: str) -> list[str]:
    return [word, f"{word[:BEGINNING]}*"] if len(word) > BEGINNING else [word]


#: Terms in more than one of so many examples of a part are kept as a table of these, the others as postings.
COMMON = 12
#: Parts of examples of like terms, as far as each would have this many: words of one language are rare in the texts of others.
PARTS, PART = 8, 1024
#: Terms in more than one of so many examples tell the parts apart, as this many examples show.
TELLING, SHOWING = 64, 2000
#: Documents whose words are found at once, and those whose common terms are multiplied at once.
AT_ONCE, MULTIPLIED = 128, 256
#: Terms of a document that are shown, the heaviest; all of them are weighed.
SHOWN = 20


def hash_of(term: str) -> int:
    """Signed 64-bit hash, which stands for the term."""
    h = xxhash.xxh64_intdigest(term.encode("utf-8", "surrogatepass"))
    return h - (1 << 64) if h >> 63 else h


def hashes_of(terms: list[str]) -> np.ndarray:
    """``hash_of`` of many terms, none of which holds a zero character."""
    data = "\0".join(terms).encode("utf-8", "surrogatepass").split(b"\0") if terms else []
    return np.frombuffer(b"".join(map(xxhash.xxh64_digest, data)), ">i8").astype(np.int64)


class Vocabulary:
    """Numbers of all terms: 0, 1, ... for those of the labelled sample, for any other a larger one of 62 bits of its hash.

    ``names`` are those of the sample's terms, in the order of ``hashes``.
    """

    def __init__(self, hashes: np.ndarray, names: pa.Array | None = None):
        order = np.argsort(hashes)
        self.hashes = hashes[order]
        self.names = None if names is None else names.take(pa.array(order))

    def __len__(self) -> int:
        return len(self.hashes)

    def numbers(self, terms: list[str]) -> np.ndarray:
        h = hashes_of(terms)
        i = np.searchsorted(self.hashes, h)
        known = np.append(self.hashes, 0)[i] == h
        return np.where(known & (i < len(self.hashes)), i, len(self.hashes) + (h & ((1 << 62) - 1)))


class Lookup:
    """Numbers of the terms that words count as; forgets all words when it would hold more than ``most``."""

    def __init__(self, terms: Vocabulary, most: int = 200_000):
        self.terms, self.most = terms, most
        self._clear(most)

    def _clear(self, room: int) -> None:
        self.rows: dict[str, int] = {}
        #: Numbers of the beginnings.
        self.names: dict[str, int] = {}
        self.word, self.beginning = np.empty(room, np.int64), np.empty(room, np.int64)

    def _learn(self, found: list[Counter]) -> None:
        every = set().union(*found)
        new = every.difference(self.rows)
        if len(self.rows) + len(new) > self.most:
            new = every
            self._clear(max(self.most, len(new)))
        if not new:
            return
        longer = [w for w in new if len(w) > BEGINNING]
        starts = [w[:BEGINNING] for w in longer]
        new = longer + [w for w in new if len(w) <= BEGINNING]
        fresh = list(set(starts).difference(self.names))
        numbers = self.terms.numbers(new + [f"{x}*" for x in fresh])
        self.names.update(zip(fresh, numbers[len(new) :].tolist()))
        low = len(self.rows)
        self.rows.update(zip(new, range(low, low + len(new))))
        self.word[low : low + len(new)] = numbers[: len(new)]
        self.beginning[low : low + len(new)] = -1
        self.beginning[low : low + len(longer)] = [self.names[x] for x in starts]

    def add_documents(self, texts: list[str], counts: np.ndarray) -> None:
        """Add to ``counts`` in how many of the texts each known term is. Words and beginnings never share a number."""
        found = [Counter(words(text)) for text in texts]
        self._learn(found)
        rows = [np.fromiter(map(self.rows.__getitem__, c), np.int64, len(c)) for c in found]
        terms = [self.word[np.concatenate(rows)]] if rows else []
        terms += [np.unique(self.beginning[r]) for r in rows]
        t = np.concatenate(terms) if terms else np.zeros(0, np.int64)
        np.add.at(counts, t[(t >= 0) & (t < len(counts))], 1)

    def counted(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Term numbers, ascending, and how often each text has them; words that are new are looked up together."""
        found = [Counter(words(text)) for text in texts]
        self._learn(found)
        out = []
        for c in found:
            rows = np.fromiter(map(self.rows.__getitem__, c), np.int64, len(c))
            n = np.fromiter(c.values(), np.int64, len(c))
            starts = self.beginning[rows]
            t, at = np.unique(np.concatenate([self.word[rows], starts[starts >= 0]]), return_inverse=True)
            out.append((t, np.bincount(at, np.concatenate([n, n[starts >= 0]]), len(t)).astype(np.int64)))
        return out


def term_strengths(sample: DataFrame) -> tuple[Vocabulary, np.ndarray]:
    """All terms of the labelled sample, and for each sqrt(1 + G-squared) of its documents' classes.

    G-squared is how much more often than chance one class has the term; no term weighs nothing for it.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        names, ys = [], []
        for text, y in zip(batch.column("text").to_pylist(), batch.column("y").to_pylist()):
            found = {t for w in set(words(text)) for t in terms_of(w)}
            names += found
            ys += [y] * len(found)
        return pa.record_batch({"term": hashes_of(names), "name": pa.array(names, pa.string()), "y": pa.array(ys, pa.int32())})

    n = {r["y"]: r["n"] for r in sample.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    n1, n0 = n.get(1, 0), n.get(0, 0)
    counts = map_batches(sample.select("text", "y"), run, "term long, name string, y int").groupBy("term").agg(
        F.count_if(F.col("y") == 1).alias("a"), F.count_if(F.col("y") == 0).alias("b"), F.min("name").alias("name")
    )
    found = counts.toArrow()
    hashes, a, b = (found.column(c).to_numpy() for c in ("term", "a", "b"))
    order = np.argsort(hashes)
    a, b = a[order].astype(float), b[order].astype(float)

    def part(seen: np.ndarray, x: int) -> np.ndarray:
        return seen * np.log(np.where(seen > 0, seen * (n1 + n0), 1) / np.where(seen > 0, (a + b) * x, 1))

    return Vocabulary(hashes, found.column("name").combine_chunks()), np.sqrt(1 + np.maximum(0, 2 * (part(a, n1) + part(b, n0))))


def _frequencies(rows: DataFrame, terms: Vocabulary, counter: Callable[[], Callable[[pa.RecordBatch, np.ndarray], None]]) -> tuple[int, np.ndarray]:
    """Number of rows, and in how many each term of the sample is, as a task's ``counter`` adds up batches."""

    def run(batches):
        counts, n, add = np.zeros(len(terms), np.int64), 0, counter()
        for batch in batches:
            n += batch.num_rows
            add(batch, counts)
        ids = np.flatnonzero(counts)
        for at in range(0, len(ids), 1 << 16):
            some = ids[at : at + (1 << 16)]
            yield pa.record_batch({"i": some, "n": counts[some]})
        yield pa.record_batch({"i": np.array([-1]), "n": np.array([n])})

    found = rows.mapInArrow(run, "i long, n long").groupBy("i").agg(F.sum("n").alias("n")).toArrow()
    i, n = found.column("i").to_numpy(), found.column("n").to_numpy()
    out = np.zeros(len(terms) + 1, np.int64)
    out[i] = n
    return int(out[-1]), out[:-1]


def document_frequencies(documents: DataFrame, terms: Vocabulary) -> tuple[int, np.ndarray]:
    """Number of documents, and in how many each term of the sample is."""

    def counter():
        lookup = Lookup(terms)

        def add(batch: pa.RecordBatch, counts: np.ndarray) -> None:
            for part in slices([batch]):
                texts = part.column("text").to_pylist()
                for at in range(0, len(texts), AT_ONCE):
                    lookup.add_documents(texts[at : at + AT_ONCE], counts)

        return add

    return _frequencies(documents.select(whole_text().alias("text")), terms, counter)


_PACKER, _UNPACKER = zstandard.ZstdCompressor(), zstandard.ZstdDecompressor()


def pack(t: np.ndarray, n: np.ndarray) -> bytes:
    """Ascending term numbers and their counts, to be stored or sent."""
    return _PACKER.compress(np.concatenate([np.diff(t, prepend=0), n]).astype(np.uint32).tobytes())


def unpack(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    t, n = np.frombuffer(_UNPACKER.decompress(packed), np.uint32).reshape(2, -1).astype(np.int64)
    return np.cumsum(t), n


def counted(documents: DataFrame, terms: Vocabulary) -> DataFrame:
    """(doc_id, packed, rest) of every document: its terms that the sample has, and what all others add to its squared length."""

    def run(batches):
        lookup = Lookup(terms)
        for batch in slices(batches):
            texts, packed, rest = batch.column("text").to_pylist(), [], []
            for at in range(0, len(texts), AT_ONCE):
                for t, n in lookup.counted(texts[at : at + AT_ONCE]):
                    known = np.searchsorted(t, len(terms))
                    packed.append(pack(t[:known], n[:known]))
                    rest.append(float(np.square(1 + np.log(n[known:])).sum()))
            yield pa.record_batch(
                {"doc_id": batch.column("doc_id"), "packed": pa.array(packed, pa.binary()), "rest": pa.array(rest, pa.float64())}
            )

    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    return docs.mapInArrow(run, "doc_id long, packed binary, rest double")


def counted_frequencies(counts: DataFrame, terms: Vocabulary) -> tuple[int, np.ndarray]:
    """``document_frequencies`` of the documents that ``counts`` were made of."""

    def add(batch: pa.RecordBatch, counts: np.ndarray) -> None:
        for packed in batch.column("packed").to_pylist():
            counts[unpack(packed)[0]] += 1

    return _frequencies(counts.select("packed"), terms, lambda: add)


def _ranges(low: np.ndarray, n: np.ndarray) -> np.ndarray:
    """low[0], low[0] + 1, ... (n[0] numbers), low[1], ..."""
    return np.repeat(low - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))


def parted(order: np.ndarray, lengths: np.ndarray, t: np.ndarray, n_terms: int) -> np.ndarray:
    """A part for each example, so that those of a part share terms; no result depends on it, only how fast it is found.

    Spherical k-means of some examples, taken evenly from ``order``, over the terms of middling and high frequency.
    """
    n, k = len(lengths), min(PARTS, len(lengths) // PART)
    none = np.zeros(n, np.int8)
    if k < 2:
        return none
    ends, df = np.cumsum(lengths), np.zeros(n_terms, np.int64)
    for low in range(0, len(t), 1 << 18):
        df += np.bincount(t[low : low + (1 << 18)], minlength=n_terms)
    telling = np.flatnonzero(df * TELLING > n)
    slot = np.full(n_terms, -1, np.int32)
    slot[telling] = np.arange(len(telling))
    weights = np.log((n + 1) / df[telling]).astype(np.float32)

    def unit(examples: np.ndarray) -> np.ndarray:
        own = slot[t[_ranges(ends[examples] - lengths[examples], lengths[examples])]]
        row = np.repeat(np.arange(len(examples)), lengths[examples])
        out = np.zeros((len(examples), len(telling)), np.float32)
        out[row[own >= 0], own[own >= 0]] = weights[own[own >= 0]]
        return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)

    shown = unit(order[:: max(1, n // SHOWING)])
    shown = shown[shown.any(axis=1)]
    if not len(shown):
        return none
    whole = shown.sum(axis=0)
    centres = [shown[np.argmax(shown @ whole)]]
    while len(centres) < k:
        centres.append(shown[np.argmin(np.max(shown @ np.stack(centres).T, axis=1))])
    centres = np.stack(centres)
    for _ in range(6):
        nearest = np.argmax(shown @ centres.T, axis=1)
        for j in np.unique(nearest):
            centres[j] = shown[nearest == j].sum(axis=0)
            centres[j] /= np.linalg.norm(centres[j])
    every = [np.argmax(unit(np.arange(low, min(n, low + 512))) @ centres.T, axis=1) for low in range(0, n, 512)]
    return np.concatenate(every).astype(np.int8)


def _pieces(n: int):
    """Slices of a long column: a whole one of a wider type would be much of a worker's memory."""
    return (slice(low, low + (1 << 16)) for low in range(0, n, 1 << 16))


def _in_lists(values: np.ndarray, low: np.ndarray) -> pa.Array:
    """Lists of ``values``, the i-th from ``low[i]`` to ``low[i + 1]``, as bytes, which are copied fastest."""
    kind = (pa.binary(), np.int32) if len(values) * values.itemsize < 1 << 31 else (pa.large_binary(), np.int64)
    ends = pa.py_buffer(low.astype(kind[1]) * kind[1](values.itemsize))
    return pa.Array.from_buffers(kind[0], len(low) - 1, [None, ends, pa.py_buffer(np.ascontiguousarray(values))])


def _taken(lists: pa.Array, which: np.ndarray, kind: np.dtype) -> np.ndarray:
    """Those lists, one after the other."""
    found = lists.take(pa.array(which))
    data = found.buffers()[2]
    return np.frombuffer(data, kind) if data is not None else np.zeros(0, kind)


class BlockMaxIndex:
    """Postings of labelled examples by term, in blocks of examples with each block's largest weight.

    Examples of like terms form parts. Terms that many examples of a part have are kept as a table of the part instead, in single
    precision; for examples that may be among the k best by this, cosines are made again in double precision. ``search`` adds
    these up, then the lists that hold few postings a block, bounds what the others can add to a block, looks into the blocks
    of the highest bounds and then into all whose bound reaches the k-th best cosine found there, so its result is that of
    a full comparison.

    A posting weighs ``base`` of its term times ``inverse`` of its example, and more only if it is listed again with
    what it has more: most words are once in a text, so that most lists are read without weights.
    """

    #: Blocks to look into before any is passed over.
    FIRST = 4
    #: Postings a block must have on average for a list to be kept in blocks.
    WORTH = 8
    #: Postings that are added up at once, so that long texts take no more memory.
    AT_ONCE = 1 << 18

    def __init__(self, terms: Vocabulary | dict[str, int], weights: np.ndarray, block: int, unknown: float = 1.0):
        self.terms, self.weights, self.block, self.unknown = terms, weights, block, unknown
        self.lookup = Lookup(terms)
        self.base_rate = self.empty_rate = 0.5

    def __getstate__(self):
        """What workers need to lay out the postings again, which is a third of them."""
        kept = ("terms", "weights", "block", "unknown", "base_rate", "empty_rate", "ids", "y", "norms", "starts")
        pack = zstandard.ZstdCompressor().compress
        return {k: getattr(self, k) for k in kept} | {"packed": [(pack(x.tobytes()), x.dtype.str) for x in self.packed]}

    def __setstate__(self, state):
        unpack = zstandard.ZstdDecompressor().decompress
        per_term, at, tf = (np.frombuffer(unpack(x), kind) for x, kind in state.pop("packed"))
        self.__dict__.update(state)
        self.lookup = Lookup(self.terms)
        t = np.repeat(np.arange(len(per_term), dtype=np.int32), per_term)
        where = np.flatnonzero(tf > 1).astype(np.int32)
        columns = [t, at, where, np.log(tf[where].astype(np.float64))]
        del t, at, tf, where
        self._lay_out(columns, self.weights, 1 / self.norms)

    def vectors(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Term numbers and weights of a unit vector of all words of each text; empty if it has none."""
        out = []
        for t, n in self.lookup.counted(texts):
            known = np.searchsorted(t, len(self.weights))
            w = 1 + np.log(n)
            w[:known] *= self.weights[t[:known]]
            w[known:] *= self.unknown
            out.append((t, w / (math.sqrt(float(w @ w)) or 1.0)))
        return out

    def weighed(self, t: np.ndarray, n: np.ndarray, rest: float) -> tuple[np.ndarray, np.ndarray]:
        """The same from ``counted`` rows, all terms that no example has as a single one."""
        w = (1 + np.log(n)) * self.weights[t]
        if rest:
            t, w = np.append(t, len(self.weights)), np.append(w, self.unknown * math.sqrt(rest))
        return t, w / (math.sqrt(float(w @ w)) or 1.0)

    def build(self, examples: list[tuple[int, int, dict[int, float]]]) -> BlockMaxIndex:
        every = [(t, x) for _, _, v in examples for t, x in v.items()]
        self.build_rows(
            np.array([e[0] for e in examples], np.int64), np.array([e[1] for e in examples], np.int64),
            np.array([len(e[2]) for e in examples], np.int64),
            np.array([t for t, _ in every], np.int32), np.array([x for _, x in every], np.float64),
        )
        return self

    def build_counts(self, ids: np.ndarray, y: np.ndarray, lengths: np.ndarray, t: np.ndarray, tf: np.ndarray) -> BlockMaxIndex:
        """From how often examples have their terms. Such an index is made to be sent; it is laid out where it arrives."""
        self._rates(y, lengths)
        part = parted(np.argsort(ids, kind="stable"), lengths, t, len(self.weights))
        start, norms, heaviest = np.cumsum(lengths) - lengths, np.ones(len(ids)), []
        for e in range(len(ids)):
            own = slice(start[e], start[e] + lengths[e])
            w = (1 + np.log(tf[own])) * self.weights[t[own]]
            norms[e] = math.sqrt(float(w @ w)) or 1.0
            heaviest.append(t[own][np.lexsort((t[own], -w))[:4]].tolist())
        full = sorted(np.flatnonzero(lengths).tolist(), key=lambda e: (part[e], heaviest[e], ids[e]))
        self.ids, self.y, self.norms = ids[full], y[full], norms[full]
        self.starts = np.searchsorted(part[full], np.arange(int(part.max(initial=0)) + 2))
        small = lambda x: x.astype(np.min_scalar_type(int(x.max()) if len(x) else 0))
        place = np.zeros(len(ids), np.int32)
        place[full] = np.arange(len(full), dtype=np.int32)
        at = np.repeat(small(place), lengths)
        order = np.lexsort((at, t))
        self.packed = [small(np.bincount(t, minlength=len(self.terms))), at[order], small(tf)[order]]
        return self

    def _rates(self, y: np.ndarray, lengths: np.ndarray) -> None:
        empty = y[lengths == 0]
        self.base_rate = (float(y.sum()) + 0.5) / (len(y) + 1)
        self.empty_rate = (float(empty.sum()) + self.base_rate) / (len(empty) + 1)

    def build_rows(self, ids: np.ndarray, y: np.ndarray, lengths: np.ndarray, t: np.ndarray, w: np.ndarray):
        """From the examples' vectors in one array each of term numbers and weights, ``lengths`` of them an example.

        Examples of like heaviest terms share blocks, which keeps the blocks' bounds low elsewhere.
        """
        self._rates(y, lengths)
        start = np.cumsum(lengths) - lengths

        def heaviest(e: int) -> list[int]:
            own = slice(start[e], start[e] + lengths[e])
            return t[own][np.lexsort((t[own], -w[own]))[:4]].tolist()

        full = sorted(np.flatnonzero(lengths).tolist(), key=lambda e: (heaviest(e), ids[e]))
        self.ids, self.y, n = ids[full], y[full], len(full)
        place = np.zeros(len(ids), np.int32)
        place[full] = np.arange(n, dtype=np.int32)
        self.starts = np.array([0, n])
        at = np.repeat(place, lengths)
        order = np.lexsort((at, t))
        every = np.arange(len(t), dtype=np.int32)
        self._lay_out([t[order], at[order], every, w[order] - 1], np.ones(len(self.weights)), np.ones(n))

    def _lay_out(self, columns: list[np.ndarray], base: np.ndarray, inverse: np.ndarray) -> None:
        """From postings in the order of terms, then of examples, which of them weigh more, and how much more.

        The list is emptied, so that its columns can be freed.
        """
        t, at, where, more = columns
        columns.clear()
        n, n_terms, sizes = len(self.ids), len(base), np.diff(self.starts)
        self.base, self.inverse = base, inverse
        part = np.repeat(np.arange(len(sizes), dtype=np.int8), sizes)
        held = np.zeros((n_terms, len(sizes)), np.int32)
        for some in _pieces(len(t)):
            low = int(t[some][0])
            found = np.bincount((t[some].astype(np.int64) - low) * len(sizes) + part[at[some]])
            held.reshape(-1)[low * len(sizes) : low * len(sizes) + len(found)] += found.astype(np.int32)
        dense = held * COMMON > sizes
        common = np.flatnonzero(dense.any(axis=1))
        self.slot = np.full(n_terms, -1, np.int32)
        self.slot[common] = np.arange(len(common))
        #: Which column of a part's table a common term is, if any, and how much more often than elsewhere the part has it.
        self.columns = np.where(dense[common].T, np.cumsum(dense[common].T, axis=1, dtype=np.int32) - 1, -1)
        often = held[common].T / np.maximum(sizes, 1)[:, None]
        self.shares = often / often.sum(axis=0)
        widths = dense.sum(axis=0)
        offsets = np.append(0, np.cumsum(widths * sizes))
        lengths = (held * ~dense).sum(axis=1)
        del held
        rare, cells = np.empty(len(t), bool), [np.zeros(0, np.int32)]

        def cells_of(t: np.ndarray, at: np.ndarray) -> np.ndarray:
            p = part[at]
            return (offsets[p] + (at - self.starts[p]) * widths[p] + self.columns[p, self.slot[t]]).astype(np.int32)

        for some in _pieces(len(t)):
            rare[some] = dense[t[some], part[at[some]]]
            cells.append(cells_of(t[some][rare[some]], at[some][rare[some]]))
        np.logical_not(rare, out=rare)
        listed = rare[where]
        dense_where = where[~listed]
        again = [cells_of(t[x], at[x]) for x in (dense_where[some] for some in _pieces(len(dense_where)))]
        heavier = 1 + more[~listed]
        if not listed.all():
            more = more[listed]
            where = where[listed]
        before = 0
        for some in _pieces(len(t)):
            a, b = np.searchsorted(where, np.array([some.start, some.stop], np.int32))
            place = np.cumsum(rare[some], dtype=np.int32)
            where[a:b] = before + place[where[a:b] - some.start] - 1
            before += int(place[-1])
        if not rare.all():
            t = t[rare]
            at = at[rare]
        columns += [t, at.astype(np.min_scalar_type(n), copy=False), where, more]
        del t, at, rare, where, more, listed, dense_where
        self._keep_lists(columns, lengths)
        #: What a cell may hold; single precision has to tell these apart.
        self.values = np.unique(np.concatenate([[0.0, 1.0], heavier]))
        single = len(np.unique(self.values.astype(np.float32))) == len(self.values)
        self.rows = np.zeros(int(offsets[-1]), np.float32 if single else np.float64)
        for some in cells:
            self.rows[some] = 1
        low = 0
        for some in again:
            self.rows[some] = heavier[low : low + len(some)]
            low += len(some)
        self.single = self.values.astype(np.float32)
        self._find_by_bits()
        self.room = None
        #: Of each part, its examples by its common terms.
        self.tables = [self.rows[a:b].reshape(size, width) for a, b, size, width in zip(offsets, offsets[1:], sizes, widths)]
        #: Twice what single precision may be off: a rounding for each term of the sum, and five more.
        self.slack = (int(widths.max(initial=0)) + 5) * 2.0**-23

    def _find_by_bits(self) -> None:
        """A table of the values by the first bits that tell them apart, if it is small."""
        bits = self.single[1:].view(np.int32)
        for self.shift in range(20, -1, -1):
            keys = bits >> self.shift
            if (np.diff(keys) > 0).all():
                break
        self.lowest, self.by_bits = int(keys[0]) - 1, None
        if self.rows.dtype == np.float32 and keys[-1] - self.lowest < 1 << 20:
            self.by_bits = np.zeros(int(keys[-1]) - self.lowest + 1)
            self.by_bits[keys - self.lowest] = self.values[1:]

    def _in_full(self, cells: np.ndarray) -> np.ndarray:
        """Cells of the tables in double precision."""
        if self.rows.dtype != np.float32:
            return cells
        if self.by_bits is None:
            return self.values[np.searchsorted(self.single, cells)]
        return self.by_bits[np.maximum((cells.view(np.int32) >> self.shift) - self.lowest, 0)]

    def _keep_lists(self, columns: list[np.ndarray], lengths: np.ndarray) -> None:
        """The lists, those of the postings that weigh more, and the blocks of such as have many postings a block."""
        t, at, where, more = columns
        columns.clear()
        self.low = np.append(0, np.cumsum(lengths)).astype(np.int32)
        self.more_low = np.searchsorted(where, self.low).astype(np.int32)
        self.at, self.more_at, self.more = at, at[where], more
        self.lists, self.more_lists, self.more_weights = (
            _in_lists(x, low) for x, low in ((at, self.low), (self.more_at, self.more_low), (more, self.more_low))
        )
        new = np.ones(len(t), bool)
        for some in _pieces(len(t) - 1):
            a, b = slice(some.start, min(some.stop, len(t) - 1)), slice(some.start + 1, some.stop + 1)
            new[b] = (t[a] != t[b]) | (at[a] // self.block != at[b] // self.block)
        entries = np.zeros(len(lengths), np.int64)
        for some in _pieces(len(t)):
            a = int(t[some][0])
            found = np.bincount(t[some][new[some]] - a)
            entries[a : a + len(found)] += found
        worth = (entries > 0) & (lengths >= self.WORTH * entries)
        for some in _pieces(len(t)):
            new[some] &= worth[t[some]]
        first = np.flatnonzero(new).astype(np.int32)
        last = np.minimum(np.append(first[1:], np.int32(len(t))), self.low[t[first] + 1])
        # A term's entries, one for each block it is in: the block, its largest weight, its postings, those of them that weigh more.
        self.entries = np.append(0, np.cumsum(entries * worth)).astype(np.int32)
        self.blocks, self.first, self.last = at[first] // self.block, first, last
        self.more_first, self.more_last = np.searchsorted(where, first), np.searchsorted(where, last)
        self.most = np.zeros(len(first), np.float32)
        for e, (a, b, c, d) in enumerate(zip(first.tolist(), last.tolist(), self.more_first.tolist(), self.more_last.tolist())):
            w = self.inverse[at[a:b]]
            w[where[c:d] - a] *= 1 + more[c:d]
            self.most[e] = self.base[t[a]] * w.max()
        # A little more than the largest, so that rounding never makes a bound too low.
        self.most *= np.float32(1 + 1e-6)

    def common(self, vectors: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """What the common terms add to the cosine of each vector and example, times the example's length; up to half the ``slack``.

        The next call writes over the result.

        Vectors that share most terms with a part are multiplied together, and all others are, by the columns that any of them has.
        """
        m = len(vectors)
        if self.room is None or len(self.room) < m:
            self.room = np.empty((m, len(self.ids)), self.rows.dtype)
        out = self.room[:m]
        out[:] = 0
        if not m or not len(self.rows):
            return out
        row = np.repeat(np.arange(m), [len(t) for t, _ in vectors])
        t, w = (np.concatenate([v[i] for v in vectors]) for i in (0, 1))
        known = np.flatnonzero(t < len(self.weights))
        known = known[self.slot[t[known]] >= 0]
        row, slot, w = row[known], self.slot[t[known]], w[known] * self.base[t[known]]
        home = np.argmax([np.bincount(row, share[slot], m) for share in self.shares], axis=0)
        for p, (a, b) in enumerate(zip(self.starts, self.starts[1:])):
            column = self.columns[p, slot]
            for here in (home == p, home != p):
                mine = np.flatnonzero(here)
                some = np.flatnonzero(here[row] & (column >= 0))
                if not len(some):
                    continue
                own, place = np.zeros(m, np.int64), np.zeros(self.tables[p].shape[1], np.int64)
                own[mine] = np.arange(len(mine))
                used = np.zeros(len(place), bool)
                used[column[some]] = True
                if used.sum() * 2 > len(used):
                    used[:] = True
                place[used] = np.arange(int(used.sum()))
                q = np.zeros((len(mine), int(used.sum())), self.rows.dtype)
                q[own[row[some]], place[column[some]]] = w[some]
                table = self.tables[p] if used.all() else np.take(self.tables[p], np.flatnonzero(used), axis=1)
                out[mine, a:b] = q @ table.T
        return out

    def listed(self, vectors: list[tuple[np.ndarray, np.ndarray]]):
        """What whole lists add to the cosine of each vector and example, times the example's length."""
        row = np.repeat(np.arange(len(vectors)), [len(t) for t, _ in vectors])
        t, w = (np.concatenate([v[i] for v in vectors]) for i in (0, 1))
        known = np.flatnonzero(t < len(self.weights))
        known = known[self.low[t[known]] < self.low[t[known] + 1]]
        row, t = row[known], t[known]
        x = w[known] * self.base[t]
        n, done, total = (self.low[t + 1] - self.low[t]).astype(np.int64), 0, None
        for some in np.split(np.arange(len(t)), np.flatnonzero(np.diff(np.cumsum(n) // self.AT_ONCE)) + 1) if len(t) else ():
            again = some[self.more_low[t[some]] < self.more_low[t[some] + 1]]
            n_more = (self.more_low[t[again] + 1] - self.more_low[t[again]]).astype(np.int64)
            first, last = int(row[some[0]]), int(row[some[-1]])
            parts = []
            for of, lengths, lists in ((some, n[some], self.lists), (again, n_more, self.more_lists)):
                own = np.append(0, np.cumsum(lengths))[np.searchsorted(row[of], np.arange(first, last + 2))].tolist()
                parts.append((own, _taken(lists, t[of], self.at.dtype), np.repeat(x[of], lengths)))
            parts[1][2][:] *= _taken(self.more_weights, t[again], self.more.dtype)
            for i in range(last - first + 1):
                while done < first + i:
                    yield np.zeros(len(self.ids)) if total is None else total
                    done, total = done + 1, None
                for own, at, each in parts:
                    a, b = own[i], own[i + 1]
                    if a < b:
                        added = np.bincount(at[a:b], each[a:b], len(self.ids))
                        total = added if total is None else total + added
        while done < len(vectors):
            yield np.zeros(len(self.ids)) if total is None else total
            done, total = done + 1, None

    def nearest(self, vectors: list[tuple[np.ndarray, np.ndarray]], k: int, ties: bool = False):
        """``search`` for each vector; what many need is made together."""
        if not len(self.ids):
            yield from ([] for _ in vectors)
            return
        row = np.repeat(np.arange(len(vectors)), [len(t) for t, _ in vectors])
        t, w = (np.concatenate([v[i] for v in vectors]) for i in (0, 1))
        known = np.flatnonzero(t < len(self.weights))
        row, t, w = row[known], t[known], w[known]
        n = self.low[t + 1] - self.low[t]
        in_blocks = np.where(self.entries[t] < self.entries[t + 1], n, -n)
        in_blocks = np.bincount(row, in_blocks, len(vectors)) > 0
        slot = self.slot[t]
        row, slot, x = row[slot >= 0], slot[slot >= 0], (w * self.base[t])[slot >= 0]
        ends = np.searchsorted(row, np.arange(len(vectors) + 1)).tolist()
        for i, (v, common, listed) in enumerate(zip(vectors, self.common(vectors), self.listed(vectors))):
            if in_blocks[i]:
                yield self.search(v, k, common, ties)
                continue
            # To read the weights of so few blocks as it has would save less than it takes.
            listed += common
            listed *= self.inverse
            own = slice(ends[i], ends[i + 1])
            yield self._nearest(listed, None, k, ties, common, slot[own], x[own])

    def search(self, v: dict[int, float] | tuple[np.ndarray, np.ndarray], k: int, common: np.ndarray | None = None,
               ties: bool = False) -> list[tuple[float, int]]:
        """The k examples of the highest cosine as (cosine, position); of equal ones those of the smallest id.

        With ``ties`` all that are equal to the k-th are given too. With ``common`` its blocks are looked into in any case.
        """
        t, w = (np.array(list(v), np.int64), np.array(list(v.values()))) if isinstance(v, dict) else v
        if common is None:
            return next(self.nearest([(t, w)], k, ties))
        rare = t < len(self.weights)
        t, w = t[rare], w[rare]
        x = w * self.base[t]
        slot = self.slot[t]
        exactly = common, slot[slot >= 0], x[slot >= 0]
        rare = self.low[t] < self.low[t + 1]
        t, w, x = t[rare], w[rare], x[rare]
        worth = self.entries[t] < self.entries[t + 1]

        def whole(listed: np.ndarray) -> np.ndarray:
            """The cosines by the common terms and by what whole lists add."""
            return (listed + common) * self.inverse

        cosine = whole(next(self.listed([(t[~worth], w[~worth])])))
        begin, end = self.entries[t[worth]], self.entries[t[worth] + 1]
        spans = list(zip(begin.tolist(), end.tolist()))
        blocks = np.concatenate([self.blocks[a:b] for a, b in spans])
        most = np.concatenate([self.most[a:b] for a, b in spans])
        starts = np.arange(0, len(cosine), self.block)
        rest = np.bincount(blocks, np.repeat(w[worth], end - begin) * most, len(starts))
        bounds = np.maximum.reduceat(cosine, starts) + rest
        into = np.zeros(len(bounds), bool)
        into[np.argsort(-bounds, kind="stable")[: max(self.FIRST, -(-2 * k // self.block))]] = True

        ends = np.cumsum(end - begin)

        def look(into: np.ndarray) -> None:
            mine = np.flatnonzero(into[blocks])
            term = np.searchsorted(ends, mine, "right")
            e = mine + (end - ends)[term]
            for at, low, high, weights in ((self.at, self.first, self.last, None), (self.more_at, self.more_first, self.more_last, self.more)):
                n = (high[e] - low[e]).astype(np.int64)
                i, each = _ranges(low[e], n), np.repeat(x[worth][term], n)
                each = each if weights is None else each * weights[i]
                cosine[:] += np.bincount(at[i], each, len(cosine)) * self.inverse

        def best_of(seen: np.ndarray) -> np.ndarray:
            found = np.flatnonzero(np.repeat(seen, self.block)[: len(cosine)])
            return found[cosine[found] > 0]

        look(into)
        found = best_of(into)
        least = np.partition(cosine[found], -k)[-k] if len(found) >= k else 0.0
        more = ~into & (bounds > 0) & (bounds >= least - self.slack - 1e-9)
        if more.sum() * 4 > len(more):
            # Most lists would be read in pieces; whole ones are read faster.
            return self._nearest(whole(next(self.listed([(t, w)]))), None, k, ties, *exactly)
        if more.any():
            look(more)
            found = best_of(into | more)
        return self._nearest(cosine, found, k, ties, *exactly)

    def _exact(self, cosine: np.ndarray, found: np.ndarray, common: np.ndarray, slot: np.ndarray, weighty: np.ndarray) -> np.ndarray:
        """The cosines of the examples ``found``, with the common terms in double precision."""
        inverse = self.inverse[found]
        out, part = cosine[found] - common[found] * inverse, np.searchsorted(self.starts, found, "right") - 1
        for p in np.unique(part).tolist():
            mine, column = np.flatnonzero(part == p), self.columns[p, slot]
            cells = np.take(np.take(self.tables[p], found[mine] - self.starts[p], axis=0), column[column >= 0], axis=1)
            out[mine] += self._in_full(cells) @ weighty[column >= 0] * inverse[mine]
        return out

    def _nearest(self, cosine: np.ndarray, found: np.ndarray | None, k: int, ties: bool, *exactly: np.ndarray) -> list[tuple[float, int]]:
        """The k best of the examples ``found`` (all without it), as ``search`` gives them."""
        if found is None:
            # The k-th of the largest of each 64 is at most the k-th of all.
            best = cosine[: len(cosine) // 64 * 64].reshape(64, -1).max(axis=0)
            least = np.partition(best, -k)[-k] if len(best) >= k else 0.0
            found = np.flatnonzero(cosine >= max(least - self.slack - 2e-9, np.nextafter(0, 1)))
            if len(found) > k:
                found = found[cosine[found] >= np.partition(cosine[found], -k)[-k] - self.slack - 2e-9]
        cosine = self._exact(cosine, found, *exactly)
        # Rounding keeps the order, so what is equal to the k-th when rounded is not far below it.
        rounded = np.round(cosine, 9)
        if len(found) > k:
            near = rounded >= np.partition(rounded, -k)[-k]
            found, rounded = found[near], rounded[near]
        best = np.lexsort((self.ids[found], -rounded))
        best = best if ties else best[:k]
        return list(zip(rounded[best].tolist(), found[best].tolist()))


def learned(documents: DataFrame, labels: DataFrame, params: ToxicityParams | None = None, label: str = "toxic",
            modulus: int = 5, remainder: int = 0) -> BlockMaxIndex:
    """Terms and index from the labelled sample; document frequencies from all documents."""
    params = params or ToxicityParams()
    sample = staged(labelled_sample(documents, labels, label, modulus, remainder, params.max_labelled), "labelled")
    terms, strengths = term_strengths(sample)
    return indexed(sample, terms, strengths, *document_frequencies(documents, terms), params)


def indexed(sample: DataFrame, terms: Vocabulary, strengths: np.ndarray, n: int, df: np.ndarray, params: ToxicityParams) -> BlockMaxIndex:
    """The index of the written ``sample``, whose terms are in ``df`` of ``n`` documents."""
    weights = (np.log((1 + n) / (1 + df)) + 1) * strengths
    # A term that none of the examples has weighs like one that a single document in as many as there are examples has.
    index = BlockMaxIndex(terms, weights, params.block, math.log(1 + sample.count()) + 1)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = Lookup(terms).counted(batch.column("text").to_pylist())
        return pa.record_batch(
            {
                "doc_id": batch.column("doc_id"),
                "y": batch.column("y"),
                "n": pa.array([len(t) for t, _ in found], pa.int64()),
                "packed": pa.array([pack(t, n) for t, n in found], pa.binary()),
            }
        )

    rows = map_batches(sample, run, "doc_id long, y int, n long, packed binary").toArrow()
    lengths = rows.column("n").to_numpy()
    t, tf = np.empty(int(lengths.sum()), np.int32), np.empty(int(lengths.sum()), np.int32)
    at = 0
    for packed, n in zip(rows.column("packed"), lengths.tolist()):
        t[at : at + n], tf[at : at + n] = unpack(packed.as_py())
        at += n
    ids, y = rows.column("doc_id").to_numpy(), rows.column("y").to_numpy().astype(np.int64)
    del rows
    return index.build_counts(ids, y, lengths, t, tf)


def vote(index: BlockMaxIndex, v: tuple[np.ndarray, np.ndarray], params: ToxicityParams,
         near: list[tuple[float, int]] | None = None) -> tuple[float, list[tuple[float, int]]]:
    """The score of a vector, and its neighbours."""
    if not len(v[0]):
        return index.empty_rate, []
    near = index.search(v, params.neighbours, ties=True) if near is None else near
    w = np.exp(-(1 - np.array([c for c, _ in near])) / params.width)
    y = index.y[np.array([i for _, i in near], np.int64)]
    votes = float(w @ y) + params.prior_votes * index.base_rate
    return votes / (float(w.sum()) + params.prior_votes), near


def votes(index: BlockMaxIndex, vectors: list[tuple[np.ndarray, np.ndarray]], params: ToxicityParams):
    """(score, neighbours) of each vector."""
    for v, near in zip(vectors, index.nearest(vectors, params.neighbours, ties=True) if vectors else ()):
        yield vote(index, v, params, near)


def scored(counts: DataFrame, index: BlockMaxIndex, params: ToxicityParams | None = None) -> DataFrame:
    """(doc_id, score, evidence, terms) for every document, from the ``counted`` terms of its whole text.

    Every word weighs, by its frequency here and in all documents and by how well it tells the classes apart.
    Neighbours vote with their label, weighted by exp(-distance / width); ``prior_votes`` of the examples' base
    rate keep scores of few or distant neighbours near it. A text without words, an empty or a null one included, gets
    the rate among examples without them. ``evidence`` lists up to five neighbours (doc_id, cosine, label), ``terms``
    the ``SHOWN`` heaviest terms met that examples have too. Only text is looked at. Repeated rows score alike.
    """
    params = params or ToxicityParams()
    shared = counts.sparkSession.sparkContext.broadcast(index)
    shape = pa.list_(pa.struct([("doc_id", pa.int64()), ("cosine", pa.float64()), ("label", pa.int32())]))

    def judged(own: BlockMaxIndex, batch: pa.RecordBatch) -> pa.RecordBatch:
        scores, evidence, terms = [], [], []
        packed, rest = batch.column("packed").to_pylist(), batch.column("rest").to_pylist()
        vectors = [own.weighed(*unpack(x), y) for x, y in zip(packed, rest)]
        for (score, near), (t, w) in zip(votes(own, vectors, params), vectors):
            scores.append(score)
            evidence.append([{"doc_id": int(own.ids[i]), "cosine": c, "label": int(own.y[i])} for c, i in near[:5]])
            known = t < len(own.terms)
            terms.append(t[known][np.lexsort((t[known], -w[known]))[:SHOWN]])
        ends = np.cumsum([0, *map(len, terms)]).astype(np.int32)
        names = own.terms.names.take(pa.array(np.concatenate(terms)))
        return pa.record_batch(
            {
                "doc_id": batch.column("doc_id"),
                "score": pa.array(scores, pa.float64()),
                "evidence": pa.array(evidence, shape),
                "terms": pa.ListArray.from_arrays(pa.array(ends), names),
            }
        )

    def run(batches):
        own = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, MULTIPLIED):
                yield judged(own, batch.slice(at, MULTIPLIED))

    return counts.mapInArrow(
        run, "doc_id long, score double, evidence array<struct<doc_id: bigint, cosine: double, label: int>>, terms array<string>"
    )


def toxicity(documents: DataFrame, labels: DataFrame, params: ToxicityParams | None = None) -> DataFrame:
    """(doc_id, held_out, score, predicted, evidence, terms) for every row of ``documents``.

    Without labels there are no examples and every score is the base rate. No rows give no rows.
    """
    params = params or ToxicityParams()
    sample = staged(labelled_sample(documents, labels, "toxic", 5, 0, params.max_labelled), "labelled")
    terms, strengths = term_strengths(sample)
    # Words are found and looked up once; frequencies and scores are made from the counts.
    counts = staged(counted(documents, terms), "counted")
    index = indexed(sample, terms, strengths, *counted_frequencies(counts, terms), params)
    return scored(counts, index, params).select(
        "doc_id",
        held_out(F.col("doc_id"), 5, 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "evidence",
        "terms",
    )


def accepted(documents: DataFrame, labels: DataFrame, params: ToxicityParams | None = None) -> DataFrame:
    """The rows of ``documents`` that aren't predicted toxic, with all their columns.

    Each row is judged by its own text, so rows that share an id may part.
    """
    index = learned(documents, labels, params)
    shared = documents.sparkSession.sparkContext.broadcast((index, params or ToxicityParams()))
    schema = documents.schema

    def run(batches):
        own, p = shared.value
        for batch in slices(batches):
            texts, keep = [text or "" for text in batch.column("text").to_pylist()], []
            for at in range(0, len(texts), AT_ONCE):
                keep += [score < 0.5 for score, _ in votes(own, own.vectors(texts[at : at + AT_ONCE]), p)]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return documents.mapInArrow(run, schema)
