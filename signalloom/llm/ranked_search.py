"""Ranked lexical search: posting lists in blocks of similar documents, skipped by exact bounds."""

from __future__ import annotations

import functools
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from signalloom.llm.common import map_batches, whole_text
from signalloom.operators.staging import staged

#: Terms, in the bytes of UTF-8: a byte above 0x7F is part of a character above U+007F.
TERM = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
#: Distinct terms of the items that are searched in one pass over the documents.
VOCABULARY = 8192
#: Bounds of what an index shard holds: cells of documents times terms, and postings.
CELLS, POSTINGS = 1 << 25, 1 << 20
#: Mean number of documents in a block of a posting list, and the dimensions in which similarity is judged.
BLOCK, SKETCH = 64, 32


def terms_of(text: str) -> list[bytes]:
    """The terms of a text in order, A-Z lower-cased and no other letter."""
    return TERM.findall(text.encode("utf-8", "surrogatepass").lower())


def vectors(documents: DataFrame, vocabulary: list[bytes]) -> DataFrame:
    """(doc_id, n, ids, tfs) of the documents that have a term: their number of terms, and what they hold of the vocabulary."""
    number = {t: i for i, t in enumerate(vocabulary)}
    id_type = documents.schema["doc_id"].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        kept, lengths, sizes, ids, tfs = [], [], [], [], []
        for row, text in enumerate(batch.column("text").to_pylist()):
            words = terms_of(text)
            if not words:
                continue
            found = Counter(map(number.get, words))
            found.pop(None, None)
            kept.append(row)
            lengths.append(len(words))
            sizes.append(len(found))
            ids.extend(found.keys())
            tfs.extend(found.values())
        ends = np.concatenate(([0], np.cumsum(sizes, dtype=np.int64))).astype(np.int32)
        in_lists = lambda x: pa.ListArray.from_arrays(pa.array(ends), pa.array(x, pa.int32()))
        return pa.record_batch(
            {"doc_id": batch.column("doc_id").take(pa.array(kept, pa.int64())), "n": pa.array(lengths, pa.int64()), "ids": in_lists(ids), "tfs": in_lists(tfs)}
        )

    texts = documents.select("doc_id", whole_text().alias("text"))
    return map_batches(texts, run, f"doc_id {id_type}, n long, ids array<int>, tfs array<int>")


def document_frequencies(held: DataFrame, size: int) -> DataFrame:
    """(term, df) over the ids of ``vectors``; each task adds up its own before anything is shuffled."""

    def run(batches):
        total = np.zeros(size, np.int64)
        for batch in batches:
            total += np.bincount(batch.column("ids").flatten().to_numpy(), minlength=size)
        there = np.flatnonzero(total)
        yield pa.record_batch({"term": pa.array(there, pa.int64()), "df": pa.array(total[there])})

    return held.select("ids").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))


class Blocks:
    """One posting list: its documents in blocks of similar ones, and each block's coordinatewise maximum."""

    def __init__(self, shard: Shard, docs: np.ndarray, columns: np.ndarray):
        count = -(-len(docs) // BLOCK)
        if count > 1:
            points = shard.sketch[docs]
            centres = points[np.linspace(0, len(docs) - 1, count).astype(np.int64)]
            nearest = np.argmax(points @ centres.T, axis=1)
            order = np.argsort(nearest, kind="stable")
            docs = docs[order]
            self.starts = np.flatnonzero(np.diff(nearest[order], prepend=-1))
        else:
            self.starts = np.zeros(1, np.int64)
        self.docs, self.ends = docs, np.append(self.starts[1:], len(docs))
        self.summary = np.maximum.reduceat(shard.dense[np.ix_(docs, columns)], self.starts, axis=0)

    def passing(self, columns: np.ndarray, least: float) -> np.ndarray:
        """Documents of the blocks in which one might score ``least``: a block's maxima add up to no less."""
        bound = self.summary[:, columns].sum(axis=1, dtype=np.float64)
        kept = np.flatnonzero(bound >= least)
        if len(kept) == len(self.starts):
            return self.docs
        return np.concatenate([self.docs[a:b] for a, b in zip(self.starts[kept], self.ends[kept])] or [self.docs[:0]])


class Shard:
    """The index of some documents: impacts by document and, per term, the list of documents in blocks."""

    def __init__(self, starts: np.ndarray, ids: np.ndarray, impacts: np.ndarray, searches: Searches):
        self.starts, self.ids, self.impacts, self.searches = starts, ids, impacts, searches
        size, rows = searches.size, np.repeat(np.arange(len(starts) - 1), np.diff(starts))
        # Rounded up, so that sums of maxima stay bounds.
        above = np.nextafter(impacts.astype(np.float32), np.float32(np.inf))
        self.dense = np.zeros((len(starts) - 1, size), np.float32)
        self.dense[rows, ids] = np.where(impacts > 0, above, 0)
        points = self.dense @ searches.directions
        self.sketch = points / np.maximum(np.linalg.norm(points, axis=1, keepdims=True), 1e-30)
        by_term = np.argsort(ids, kind="stable")
        self.docs, self.edges = rows[by_term], np.searchsorted(ids[by_term], np.arange(size + 1))
        self.highest = np.zeros(size, np.float64)
        np.maximum.at(self.highest, ids, self.dense[rows, ids].astype(np.float64))
        self.lists = {
            t: Blocks(self, self.docs[self.edges[t] : self.edges[t + 1]], searches.together[t])
            for t in range(size)
            if self.edges[t] < self.edges[t + 1]
        }

    def scores(self, docs: np.ndarray, asked: np.ndarray) -> np.ndarray:
        """Exact scores of ``docs`` for the terms that ``asked`` marks; every document has at least one term."""
        counts = self.starts[docs + 1] - self.starts[docs]
        first = np.cumsum(counts) - counts
        at = np.repeat(self.starts[docs] - first, counts) + np.arange(counts.sum())
        return np.add.reduceat(np.where(asked[self.ids[at]], self.impacts[at], 0), first)


class Searches:
    """The items of one pass, and for each the best documents found so far in this task."""

    def __init__(self, items: list[np.ndarray], size: int, best: int):
        self.items, self.size, self.best = items, size, best
        self.directions = np.random.default_rng(7).choice(np.float32([-1, 1]), (size, SKETCH))
        # A block of a term's list is only asked about by the items that hold the term.
        beside: list[list] = [[] for _ in range(size)]
        for terms in items:
            for t in terms:
                beside[t].append(terms)
        self.together = [np.unique(np.concatenate(x)) if x else np.zeros(0, np.int64) for x in beside]
        self.places = [{int(t): np.searchsorted(self.together[t], terms) for t in terms} for terms in items]
        none = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool))
        self.found = [none] * len(items)
        self.least = np.ones(len(items))

    def search(self, shard: Shard, doc_ids: np.ndarray, nameless: np.ndarray) -> None:
        for q, terms in enumerate(self.items):
            terms = terms[shard.highest[terms] > 0]
            terms = terms[np.argsort(-shard.highest[terms], kind="stable")]
            rest = np.cumsum(shard.highest[terms][::-1])[::-1]
            asked, seen = np.zeros(self.size, bool), np.zeros(len(doc_ids), bool)
            asked[terms] = True
            for t, most in zip(terms.tolist(), rest):
                # What has only the terms from here on can't reach the last place.
                if most < self.least[q]:
                    break
                docs = shard.lists[t].passing(self.places[q][t], self.least[q])
                docs = docs[~seen[docs]]
                if not len(docs):
                    continue
                seen[docs] = True
                scores = shard.scores(docs, asked)
                enough = scores >= self.least[q]
                if enough.any():
                    self._add(q, scores[enough], doc_ids[docs[enough]], nameless[docs[enough]])

    def _add(self, q: int, scores: np.ndarray, ids: np.ndarray, nameless: np.ndarray) -> None:
        scores, ids, nameless = (np.concatenate(x) for x in zip(self.found[q], (scores, ids, nameless)))
        order = np.lexsort((ids, nameless, -scores))[: self.best]
        self.found[q] = scores[order], ids[order], nameless[order]
        if len(order) == self.best:
            self.least[q] = float(scores[order[-1]])


def _shards(batch: pa.RecordBatch, size: int) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each piece makes a shard of bounded size."""
    postings = np.cumsum(np.diff(batch.column("ids").offsets.to_numpy()))
    start = 0
    while start < batch.num_rows:
        before = postings[start - 1] if start else 0
        end = int(np.searchsorted(postings, before + POSTINGS, side="right"))
        end = max(start + 1, min(end, start + max(1, CELLS // size), batch.num_rows))
        yield batch.slice(start, end - start)
        start = end


def _weights(df: np.ndarray, n_docs: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * x + 1))) for x in df.tolist()], np.int64)


def _one_pass(documents: DataFrame, items: list[tuple], best: int) -> DataFrame:
    """The best documents of each of ``items`` (position, item_id, terms), as (position, item_id, doc_id, score)."""
    vocabulary = sorted({t for _, _, terms in items for t in terms})
    number = {t: i for i, t in enumerate(vocabulary)}
    size = len(vocabulary)
    asked = [np.array(sorted(number[t] for t in terms), np.int64) for _, _, terms in items]
    held = staged(vectors(documents, vocabulary), "vectors")
    totals = held.agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("terms")).first()
    n_docs, n_terms = totals["docs"], totals["terms"]
    df = np.zeros(size, np.int64)
    for r in document_frequencies(held, size).collect():
        df[r["term"]] = r["df"]
    weight = _weights(df, n_docs)
    positions, names = [p for p, _, _ in items], [i for _, i, _ in items]

    def run(batches):
        searches = Searches(asked, size, best)
        id_type = None
        for whole in batches:
            for batch in _shards(whole, size):
                column, ids, tfs = batch.column("doc_id"), batch.column("ids"), batch.column("tfs")
                id_type = column.type
                lengths = np.diff(ids.offsets.to_numpy())
                held_some = np.flatnonzero(lengths)
                if not len(held_some):
                    continue
                starts = np.concatenate(([0], np.cumsum(lengths[held_some])))
                flat, tf = ids.flatten().to_numpy(), tfs.flatten().to_numpy().astype(np.int64)
                n = batch.column("n").to_numpy()
                m = np.repeat(100 - 90 + 90 * n * n_docs // n_terms, lengths)
                impacts = weight[flat] * (1_000_000_000 * tf // (1000 * tf + 8 * m))
                shard = Shard(starts, flat, impacts, searches)
                nameless = column.is_null().to_numpy(zero_copy_only=False)[held_some]
                searches.search(shard, column.fill_null(0).to_numpy()[held_some].astype(np.int64), nameless)
        for q, (scores, ids, nameless) in enumerate(searches.found):
            if len(scores):
                yield pa.record_batch(
                    {
                        "position": pa.array([positions[q]] * len(scores), pa.int64()),
                        "item_id": pa.array([names[q]] * len(scores), item_type),
                        "doc_id": pa.array(ids, id_type, mask=nameless) if id_type == pa.int64() else pa.array(ids, mask=nameless).cast(id_type),
                        "score": pa.array(scores, pa.int64()),
                    }
                )

    item_type = pa.array(names).type
    kinds = f"position long, item_id {_simple(item_type)}, doc_id {held.schema['doc_id'].dataType.simpleString()}, score long"
    return held.mapInArrow(run, kinds)


def _simple(kind: pa.DataType) -> str:
    return {pa.int64(): "long", pa.string(): "string", pa.null(): "long"}[kind]


def ranked(documents: DataFrame, items: DataFrame, best: int = 10) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``best`` highest-scoring documents of each row of ``items`` (item_id, text).

    Documents are turned into vectors over the terms of the items, written once, and indexed where they are: every
    task cuts its documents into shards of bounded size, and each shard keeps, per term, its posting list in blocks
    of documents alike in a random projection of their impacts, with the block's coordinatewise maximum over the
    terms of the items that hold the term. An item goes through its lists from the highest impact down, ends where
    the remaining lists can't lift a document to its last place, and skips a block only if the sum of the block's
    maxima stays below that place. Common terms are spread over all shards, and the best of each task are merged, so
    nothing but ``best`` rows for each item and task is shuffled. Scores are exact integers.

    Items are taken in blocks of ``VOCABULARY`` distinct terms (a single item of more makes smaller shards), one
    pass over the documents each. Items without terms, and null texts of either table, find nothing and are found by
    nothing; such documents don't count in any statistic. Repeated rows are documents, and items, of their own.
    Equal scores are put in order of doc_id, null last. Empty tables give no rows.
    """
    spark = documents.sparkSession
    kind = items.schema["item_id"].dataType.simpleString()
    tokens = F.transform(
        F.regexp_extract_all(F.translate(whole_text(), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(TERM.pattern.decode("ascii")), 0),
        lambda x: F.encode(x, "UTF-8"),
    )
    asked = staged(items.select("item_id", F.array_distinct(tokens).alias("terms")).where(F.size("terms") > 0), "items")
    blocks, block, known = [], [], set()
    for position, row in enumerate(asked.toLocalIterator()):
        terms = {bytes(t) for t in row["terms"]}
        if block and len(known | terms) > VOCABULARY:
            blocks.append(staged(_one_pass(documents, block, best), "found"))
            block, known = [], set()
        block.append((position, row["item_id"], terms))
        known |= terms
    if block:
        blocks.append(staged(_one_pass(documents, block, best), "found"))
    if not blocks:
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    found = functools.reduce(DataFrame.unionByName, blocks)
    place = F.row_number().over(W.partitionBy("position").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last()))
    return found.withColumn("rank", place).where(F.col("rank") <= best).select(F.col("item_id").cast(kind), "rank", "doc_id", "score")
