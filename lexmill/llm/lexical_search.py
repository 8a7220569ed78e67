"""Operator 12, ranked lexical search by an Aho-Corasick scan of the documents.

Terms are runs of ASCII letters and digits and of all other characters outside ASCII, A-Z lower-cased.
No index of documents is made: the terms of all items form one automaton, guarded at both ends so that
only whole terms match, and every task counts term frequencies straight from the texts.

1. A first scan counts documents with terms (N), their terms (L), and for each term of an item the
   documents that hold it (df): sums, one row for each term and task.
2. A second scan scores: a document's counts become whole-number shares, the automaton's outputs
   map each term to the items that hold it, and shares are added by (document, item). A task keeps
   the k best documents of each item and drops what falls below as it goes.
3. The tasks' lists are merged, first in parts and then for each item.

Items go in blocks of at most TERM_BYTES bytes of distinct terms and MOST_ITEMS items, so the automaton
that is broadcast, its counts and the lists of a task have fixed bounds; a larger set of items takes two scans for each
block. A document is scored by its own task, so neither frequent terms nor long texts move.

Defined results: null and empty texts have no terms, do not count in N and are in no list; an item
with null or empty text, or whose terms no document holds, has no rows; items that repeat an id are
items of their own under that id, each with its list; rows that repeat a doc_id are ranked each for
itself, in any order, and a null doc_id comes after the others of its score. An empty table gives no rows; other
columns are not read, so they cannot clash.
"""

from __future__ import annotations

import math
from collections import Counter
from operator import itemgetter

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexmill.llm.hashing import blocks
from lexmill.llm.tables import as_bytes, fresh, keep, release

TOP = 50
#: Bounds of a block of items: bytes of its distinct terms, and items.
TERM_BYTES, MOST_ITEMS = 1 << 20, 10_000
#: Scores that are held at once, and (document, term, item) shares that are added at once.
CELLS, SHARES = 1 << 20, 1 << 20
#: Parts of the lists' first merge.
PARTS = 64
#: Whole numbers below this are exact in doubles.
EXACT = 1 << 53

_GUARD = 10
#: ASCII without letters and digits becomes the guard, A-Z becomes a-z.
_TABLE = bytes(c if c >= 128 or chr(c).isalnum() else _GUARD for c in range(256)).lower()


def guarded(text: bytes) -> bytes:
    return b"\n%b\n" % text.translate(_TABLE)


def terms(text: bytes) -> list[bytes]:
    return guarded(text).split(b"\n")


def n_terms(text: bytes) -> int:
    """The number of terms of a guarded text."""
    inside = np.frombuffer(text, np.uint8) != _GUARD
    return int(np.count_nonzero(inside[1:] & ~inside[:-1]))


class Terms:
    """The distinct terms of a block of items, and the items that hold each."""

    def __init__(self, texts: list[bytes]):
        held: dict[bytes, list[int]] = {}
        for item, text in enumerate(texts):
            for term in dict.fromkeys(terms(text)):
                if term:
                    held.setdefault(term, []).append(item)
        self.words, self.n_items = list(held), len(texts)
        self.edges = np.concatenate([[0], np.cumsum([len(x) for x in held.values()])]).astype(np.int64)
        self.items = np.array([i for x in held.values() for i in x], np.int64)

    def automaton(self) -> ahocorasick.Automaton:
        out = ahocorasick.Automaton()
        for k, word in enumerate(self.words):
            out.add_word(f"\n{word.decode()}\n", k)
        out.make_automaton()
        return out


def _counts(automaton: ahocorasick.Automaton, text: bytes) -> Counter:
    """Occurrences of each term in a guarded text."""
    return Counter(map(itemgetter(1), automaton.iter(text.decode())))


def _frequencies(texts: DataFrame, shared) -> tuple[int, int, np.ndarray]:
    """N, L and the df of each term of the block."""

    def run(batches):
        block = shared.value
        automaton, df, n, total = block.automaton() if block.words else None, np.zeros(len(block.words), np.int64), 0, 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                text = guarded(text)
                size = n_terms(text)
                n, total = n + (size > 0), total + size
                if size and automaton is not None:
                    df[list(_counts(automaton, text))] += 1
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([[-2, -1], some])), pa.array(np.concatenate([[n, total], df[some]]))], names=["term", "n"])
        release()

    found = texts.mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    number = dict(zip(found["term"].to_pylist(), found["n"].to_pylist()))
    return number.get(-2, 0), number.get(-1, 0), np.array([number.get(k, 0) for k in range(len(shared.value.words))], np.int64)


class Best:
    """The k best (score, document) of each item so far."""

    def __init__(self, n_items: int, k: int):
        self.k, self.least = k, np.ones(n_items, np.int64)
        self.held: list[tuple[np.ndarray, ...]] = []
        self.size, self.most = 0, max(4 * k * n_items, 1 << 16)

    def add(self, scores: np.ndarray, ids: np.ndarray, no_id: np.ndarray) -> None:
        """scores (documents x items)."""
        doc, item = np.nonzero(scores >= self.least)
        self.held.append((item, scores[doc, item], no_id[doc], ids[doc]))
        self.size += len(doc)
        if self.size > self.most:
            self.rows()

    def rows(self) -> tuple[np.ndarray, ...]:
        """(item, score, no_id, id); what is not among the first k of its item goes."""
        item, score, no_id, ids = (np.concatenate(c) for c in zip(*self.held)) if self.held else (np.zeros(0, np.int64),) * 4
        order = np.lexsort((ids, no_id, -score, item))
        item, score, no_id, ids = (c[order] for c in (item, score, no_id, ids))
        first = np.searchsorted(item, item)
        place = np.arange(len(item)) - first
        full = place == self.k - 1
        self.least[item[full]] = score[full]
        stays = place < self.k
        self.held = [tuple(c[stays] for c in (item, score, no_id, ids))]
        self.size = int(stays.sum())
        return self.held[0]


def _sums(block: Terms, doc: np.ndarray, term: np.ndarray, share: np.ndarray, n_docs: int, exact: bool) -> np.ndarray:
    """Shares added by (document, item). exact: no sum reaches 2**53, so that doubles hold it."""
    out = np.zeros(n_docs * block.n_items, np.int64)
    wide = np.diff(block.edges)[term]
    for i, j in blocks(wide.tolist(), SHARES):
        size = wide[i:j]
        start = np.repeat(block.edges[term[i:j]] - np.concatenate([[0], np.cumsum(size)[:-1]]), size)
        cell = np.repeat(doc[i:j] * block.n_items, size) + block.items[start + np.arange(len(start))]
        value = np.repeat(share[i:j], size)
        if exact:
            out += np.bincount(cell, value, len(out)).astype(np.int64)
        else:
            np.add.at(out, cell, value)
    return out.reshape(n_docs, block.n_items)


def _ranked(rows: DataFrame, shared, numbers, k: int) -> DataFrame:
    """(item, doc_id, score): each task's k best documents of each item."""

    def run(batches):
        block, (n, total, weight) = shared.value, numbers.value
        automaton, best = block.automaton(), Best(block.n_items, k)
        load = np.zeros(block.n_items, np.int64)
        np.add.at(load, block.items, np.repeat(weight, np.diff(block.edges)))
        exact = int(load.max(initial=0)) < EXACT // 1_000_000
        together = max(1, CELLS // block.n_items)
        for batch in batches:
            texts = [guarded(t) for t in batch.column(1).to_pylist()]
            no_id = np.array(batch.column(0).is_null())
            ids = batch.column(0).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for i in range(0, len(texts), together):
                doc, term, tf, m = [], [], [], []
                for d, text in enumerate(texts[i : i + together]):
                    found = _counts(automaton, text)
                    doc += [d] * len(found)
                    term += found.keys()
                    tf += found.values()
                    m += [50 + 50 * n_terms(text) * n // total] * len(found)
                if not doc:
                    continue
                doc, term, tf, m = (np.array(c, np.int64) for c in (doc, term, tf, m))
                share = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m))
                some = slice(i, i + together)
                best.add(_sums(block, doc, term, share, len(ids[some]), exact), ids[some], no_id[some])
        item, score, no_id, ids = best.rows()
        yield pa.RecordBatch.from_arrays([pa.array(item), pa.array(ids, mask=no_id.astype(bool)), pa.array(score)], names=["item", "doc_id", "score"])
        release()

    return rows.mapInArrow(run, "item long, doc_id long, score long")


def _blocks(items: DataFrame, item: str, text: str):
    """(ids, Terms) of each block. Items come to the driver one at a time and a block is held; both bounds of a block hold for more than one item."""
    ids, texts, seen, size = [], [], set(), 0
    for row in items.select(F.col(item).alias("item"), as_bytes(text).alias("text")).toLocalIterator():
        own = set(terms(bytes(row["text"])))
        more = sum(map(len, own - seen))
        if ids and (size + more > TERM_BYTES or len(ids) == MOST_ITEMS):
            yield ids, Terms(texts)
            ids, texts, seen, size = [], [], set(), 0
            more = sum(map(len, own))
        if any(own):
            ids.append(row["item"])
            texts.append(bytes(row["text"]))
            seen |= own
            size += more
    if ids:
        yield ids, Terms(texts)


def search(docs: DataFrame, items: DataFrame, k: int = TOP, key: str = "doc_id", text: str = "text", item: str = "item_id", query: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of each item, by score and doc_id. key: a whole number."""
    spark = docs.sparkSession
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), as_bytes(text).alias("text"))
    kind = dict(items.dtypes)[item]
    place = fresh(items, "place")
    out = spark.createDataFrame([], f"{place} long, item_id {kind}, doc_id long, score long")
    held = 0
    for ids, block in _blocks(items, item, query):
        shared = spark.sparkContext.broadcast(block)
        n, total, df = _frequencies(rows.select("text"), shared)
        if not total:
            break
        weight = np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)
        found = _ranked(rows, shared, spark.sparkContext.broadcast((n, total, weight)), k)
        names = spark.createDataFrame([(j, held + j, x) for j, x in enumerate(ids)], f"item long, {place} long, item_id {kind}")
        out = out.unionByName(keep(found.join(F.broadcast(names), "item").select(place, "item_id", "doc_id", "score")))
        held += len(ids)
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    part = F.pmod(F.xxhash64("doc_id", "score"), F.lit(PARTS))
    first = out.withColumn("part", part).withColumn("rank", F.row_number().over(Window.partitionBy(place, "part").orderBy(*order))).filter(F.col("rank") <= k)
    last = first.withColumn("rank", F.row_number().over(Window.partitionBy(place).orderBy(*order))).filter(F.col("rank") <= k)
    return last.select(F.col("item_id").alias(item), "rank", F.col("doc_id").alias(key), "score")
