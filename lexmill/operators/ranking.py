"""The best documents of many queries, by BM25 with upper bounds of terms (MaxScore within blocks).

A task takes its documents block by block. In a block every asked term has a greatest share, so a query
whose terms together cannot reach its k-th score so far skips the block; otherwise its terms are
parted into those that together cannot reach it and the others, only documents that hold one of the others are scored, and of
these only those go on that can still reach it. Nothing that could be among the first k is left out, ties included.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from math import log

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexmill.functions.text import text
from lexmill.operators.lexical import B, K1, token_list

#: Queries of a block and their different terms at most (more than one query), and documents of a block.
QUERIES, TERMS, DOCUMENTS = 4096, 200_000, 1024
#: Half a unit of the last decimal that ranks, and room for the order of sums.
ROUNDING = 1e-6


class Asked:
    """A block of queries: their ids, their different terms, and for each query its terms."""

    def __init__(self):
        self.ids: list = []
        self.words: dict[str, int] = {}
        self.terms: list[np.ndarray] = []

    def add(self, qid, tokens: list[str]) -> None:
        self.ids.append(qid)
        self.terms.append(np.array([self.words.setdefault(t, len(self.words)) for t in dict.fromkeys(tokens)], np.int64))

    def weighted(self, df: np.ndarray, n_docs: int, avg_len: float, k1: float = K1, b: float = B) -> Asked:
        self.idf = np.array([log(1 + (n_docs - d + 0.5) / (d + 0.5)) for d in df.tolist()])
        self.avg_len, self.k1, self.b = avg_len, k1, b
        return self


def asked_blocks(queries: DataFrame, qid: str, query: str) -> Iterator[Asked]:
    """Queries come to the driver one at a time, and a block of them is held."""
    rows = queries.groupBy(F.col(qid).alias("qid")).agg(F.array_join(F.collect_list(text(query)), "\n").alias("body"))
    block = Asked()
    for row in rows.toLocalIterator():
        tokens = token_list(row["body"])
        if block.ids and (len(block.ids) == QUERIES or len(block.words) + len(set(tokens) - block.words.keys()) > TERMS):
            yield block
            block = Asked()
        if tokens:
            block.add(row["qid"], tokens)
    if block.ids:
        yield block


def count_asked(texts: DataFrame, asked: Asked) -> tuple[int, int, np.ndarray]:
    """Documents, their tokens (one at least for each), and for each asked term the documents that hold it."""
    shared = texts.sparkSession.sparkContext.broadcast(asked.words)

    def run(batches):
        words, n_docs, total, df = shared.value, 0, 0, np.zeros(len(shared.value), np.int64)
        for batch in batches:
            for body in batch.column(0).to_pylist():
                tokens = token_list(body)
                n_docs, total = n_docs + 1, total + max(1, len(tokens))
                df[[words[t] for t in words.keys() & set(tokens)]] += 1
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([[-2, -1], some])), pa.array(np.concatenate([[n_docs, total], df[some]]))], names=["term", "n"])

    found = texts.mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    number = dict(zip(found["term"].to_pylist(), found["n"].to_pylist()))
    return number.get(-2, 0), number.get(-1, 0), np.array([number.get(k, 0) for k in range(len(asked.words))], np.int64)


def text_blocks(batches, asked: Asked):
    """(documents, lengths, term, document's place, tf) of blocks of (doc, body) rows."""
    for batch in batches:
        docs, bodies = (batch.column(c).to_pylist() for c in range(2))
        for i in range(0, len(docs), DOCUMENTS):
            size, term, place, tf = [], [], [], []
            for k, body in enumerate(bodies[i : i + DOCUMENTS]):
                tokens = token_list(body)
                size.append(max(1, len(tokens)))
                counts = Counter(t for t in tokens if t in asked.words)
                term += [asked.words[t] for t in counts]
                tf += counts.values()
                place += [k] * len(counts)
            yield docs[i : i + DOCUMENTS], np.array(size, np.int64), *(np.array(c, np.int64) for c in (term, place, tf))


def term_blocks(batches, asked: Asked):
    """The same of (doc, len, tokens, tfs) rows, without a Python object for any token."""
    known = pa.array(list(asked.words), pa.string())
    for whole in batches:
        for i in range(0, whole.num_rows, DOCUMENTS):
            batch = whole.slice(i, DOCUMENTS)
            tokens = batch.column(2)
            term = pc.index_in(tokens.flatten(), value_set=known)
            found = np.flatnonzero(term.is_valid().to_numpy(zero_copy_only=False))
            place = np.repeat(np.arange(batch.num_rows), pc.list_value_length(tokens).to_numpy(zero_copy_only=False))
            yield batch.column(0).to_pylist(), batch.column(1).to_numpy(), term.fill_null(0).to_numpy().astype(np.int64)[found], place[found], batch.column(3).flatten().to_numpy()[found]


class Best:
    """The k best (score, doc) of each query so far; documents without an id come first of their score."""

    def __init__(self, n: int, k: int):
        self.k, self.rows, self.least = k, [[] for _ in range(n)], np.full(n, -np.inf)
        self.products = 0

    def add(self, q: int, scores: np.ndarray, docs: list) -> None:
        self.rows[q] = sorted([*self.rows[q], *((-s, d is not None, d) for s, d in zip(scores.tolist(), docs))])[: self.k]
        if len(self.rows[q]) == self.k:
            self.least[q] = -self.rows[q][-1][0]


def score_block(asked: Asked, best: Best, docs: list, size: np.ndarray, term: np.ndarray, place: np.ndarray, tf: np.ndarray) -> None:
    """Adds a block's documents to the best ones of each query that they can reach."""
    if not len(term):
        return
    order = np.argsort(term, kind="stable")
    term, place, tf = term[order], place[order], tf[order]
    share = asked.idf[term] * (tf * (asked.k1 + 1)) / (tf + asked.k1 * (1 - asked.b + asked.b * size[place] / asked.avg_len))
    starts = np.flatnonzero(np.concatenate([[True], term[1:] != term[:-1]]))
    bound = np.zeros(len(asked.words))
    bound[term[starts]] = np.maximum.reduceat(share, starts)
    low, high = np.zeros(len(asked.words), np.int64), np.zeros(len(asked.words), np.int64)
    low[term[starts]], high[term[starts]] = starts, np.append(starts[1:], len(term))
    for q, terms in enumerate(asked.terms):
        terms = terms[bound[terms] > 0]
        least = best.least[q] - ROUNDING
        terms = terms[np.argsort(bound[terms], kind="stable")]
        reach = np.cumsum(bound[terms])
        if not len(terms) or reach[-1] < least:
            continue
        weak = int(np.searchsorted(reach, least))  # so many terms together do not reach it
        total = np.zeros(len(docs))
        for t in terms[weak:].tolist():
            total[place[low[t] : high[t]]] += share[low[t] : high[t]]
        best.products += int((high[terms[weak:]] - low[terms[weak:]]).sum())
        rest = reach[weak - 1] if weak else 0.0
        here = np.flatnonzero((total > 0) & (total + rest >= least))
        if not len(here):
            continue
        for t in terms[:weak].tolist():
            total[place[low[t] : high[t]]] += share[low[t] : high[t]]
        scores = np.round(total[here], 6)
        good = scores >= best.least[q]
        if good.any():
            best.add(q, scores[good], [docs[d] for d in here[good].tolist()])


def best_of_blocks(rows: DataFrame, blocks: Callable, asked: Asked, k: int) -> tuple[DataFrame, Asked]:
    """(place, doc, score): the k best documents of each query in each task; place: of the query in asked."""
    shared = rows.sparkSession.sparkContext.broadcast(asked)

    def run(batches):
        asked = shared.value
        best = Best(len(asked.ids), k)
        for block in blocks(batches, asked):
            score_block(asked, best, *block)
        found = [(q, row[2], -row[0]) for q, rows in enumerate(best.rows) for row in rows]
        place, docs, scores = zip(*found) if found else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(place, pa.int64()), pa.array(docs, kind), pa.array(scores, pa.float64())], names=["place", "doc", "score"])

    doc_type = dict(rows.dtypes)["doc"]
    kind = rows.select("doc").limit(0).toArrow().schema.field(0).type
    return rows.mapInArrow(run, f"place long, doc {doc_type}, score double"), asked


def merged(found: list[tuple[DataFrame, Asked]], docs: DataFrame, queries: DataFrame, doc: str, qid: str, k: int) -> DataFrame:
    """(qid, doc, score, rank) of the tasks' lists."""
    spark, qid_type, doc_type = docs.sparkSession, dict(queries.dtypes)[qid], dict(docs.dtypes)[doc]
    out = spark.createDataFrame([], f"qid {qid_type}, doc {doc_type}, score double")
    for rows, asked in found:
        names = spark.createDataFrame(list(enumerate(asked.ids)), f"place long, qid {qid_type}")
        out = out.unionByName(rows.join(F.broadcast(names), "place").select("qid", "doc", "score"))
    order = Window.partitionBy("qid").orderBy(F.desc("score"), "doc")
    return out.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
