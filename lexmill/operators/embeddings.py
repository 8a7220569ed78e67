"""Change-only ingestion of chunks with vectors, and exact nearest neighbours."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexmill.functions.text import as_column, text
from lexmill.operators import guards

CAP, BATCH, MOST = 1800, 64, 20
#: Queries that are broadcast at once: a block of this many is one pass over the corpus.
QUERY_BLOCK = 4096
#: Rows that a task parts into cells at once, and cells at most.
ROWS, CELLS = 2048, 24


def ingest_rows(chunks: DataFrame, cap: int = CAP) -> DataFrame:
    """chunks with embed_text (cut at cap) and metadata.byeol and content_sha of it; content stays whole."""
    capped = F.substring("content", 1, cap)
    digits = F.regexp_extract(text("metadata.attachment_no"), r"^별표(\d+)", 1)
    byeol = F.when(F.col("metadata.document_type") == "attachment", F.when(digits != "", digits).otherwise("?"))
    return chunks.withColumn("embed_text", capped).withColumn("metadata", F.col("metadata").withField("byeol", byeol).withField("content_sha", content_sha(capped)))


def content_sha(c: Column | str) -> Column:
    return F.substring(F.sha2(text(c).cast("binary"), 256), 1, 16)


def changed_rows(rows: DataFrame, existing: DataFrame, key: str = "chunk_id", sha: str = "content_sha", force: bool = False) -> DataFrame:
    """Rows that are new or whose hash differs, each once however often existing holds its key. Only keys and hashes of the existing table are read."""
    if force:
        return rows
    known = existing.select(F.col(key).alias("_key"), F.col(sha).alias("_sha"))
    return rows.join(known, F.col(key).eqNullSafe(F.col("_key")) & F.col(sha).eqNullSafe(F.col("_sha")), "left_anti")


def last_of_each(rows: DataFrame, key: str = "chunk_id", order: Column | str = "seq") -> DataFrame:
    """Each key's row with the greatest order; of rows with the same order the one with the greater hash. Rows of one key meet
    as one candidate of each task, so a key with very many rows fills none."""
    order = F.col(order) if isinstance(order, str) else order
    whole = F.struct(*rows.columns)
    last = rows.groupBy(F.col(key).alias("_key")).agg(F.max_by(whole, F.struct(order.alias("order"), F.xxhash64(whole).alias("hash"))).alias("_last"))
    return last.select("_last.*")


def upsert(target: DataFrame, source: DataFrame, key: str = "chunk_id", delete_missing: bool = False, order: Column | str | None = None) -> DataFrame:
    """The next version of target: source's rows replace those of the same key, the last by `order`
    winning among several (without an order several are refused); rows that source lacks stay unless
    delete_missing. KeyedTable does the same to a stored table and writes only what changes."""
    columns = target.columns
    source = guards.assert_unique(source, key) if order is None else last_of_each(source, key, order)
    if delete_missing:
        return source.select(columns)
    replaced = source.select(F.col(key).alias("_key"))
    return target.join(replaced, F.col(key).eqNullSafe(F.col("_key")), "left_anti").unionByName(source.select(columns))


def normalize_matrix(m: np.ndarray) -> np.ndarray:
    return m / (np.linalg.norm(m, axis=1, keepdims=True) + 1e-9)


def truncate_normalize(c: Column | str, dim: int) -> Column:
    """The first dim values of a vector, divided by their length plus 1e-9, in double."""
    head = F.transform(F.slice(as_column(c), 1, dim), lambda x: x.cast("double"))
    norm = F.sqrt(F.aggregate(head, F.lit(0.0), lambda s, x: s + x * x)) + 1e-9
    return F.transform(head, lambda x: x / norm)


def hashing_embedder(dim: int = 64) -> Callable[[list[str]], np.ndarray]:
    """A stand-in for a model: signed counts of hashed character trigrams."""

    def embed(texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), dim), np.float32)
        for row, s in zip(out, texts):
            data = np.frombuffer(s.encode(), np.uint8).astype(np.uint32)
            if len(data) >= 3:
                h = (data[:-2] * 65599 + data[1:-1] * 257 + data[2:]) * np.uint32(0x9E3779B1)
                np.add.at(row, (h >> np.uint32(8)) % dim, np.where(h & 1, 1, -1))
        return normalize_matrix(out)

    return embed


def embed(df: DataFrame, column: str, embed_fn: Callable[[list[str]], np.ndarray], out: str = "embedding", prefix: str = "", batch: int = BATCH) -> DataFrame:
    """df with the vectors that embed_fn gives for a text column, batch by batch. prefix: for queries."""
    schema = T.StructType([*df.schema.fields, T.StructField(out, T.ArrayType(T.FloatType()))])
    names = df.columns

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            texts = [prefix + (x or "") for x in frame[column]]
            parts = [np.asarray(embed_fn(texts[k : k + batch]), np.float32) for k in range(0, len(texts), batch)]
            frame[out] = list(np.concatenate(parts)) if parts else []
            yield frame[[*names, out]]

    return df.mapInPandas(run, schema)


def knn(queries: DataFrame, corpus: DataFrame, k: int, qid: str = "qid", doc: str = "doc", vector: str = "embedding", where: Column | None = None, block: int = QUERY_BLOCK) -> DataFrame:
    """(qid, doc, similarity, rank): the k (1 to 20) nearest rows by cosine, for every query, exactly.

    A query meets the rows whose vector has as many values as its own; a vector that is null, empty or holds
    a null or a value that is no number has no neighbours and is none. Queries come to the driver one at a time, in blocks of a
    fixed size, one pass over the corpus each. A task parts its rows into cells around pivots and multiplies
    only those cells with a query that can hold one of its k best by their radius, so k rows for each query and task
    are shuffled and nothing grows with queries x corpus.
    """
    k = max(1, min(MOST, k))
    corpus = corpus if where is None else corpus.filter(where)
    rows = corpus.select(F.col(doc).alias("doc"), F.col(vector).alias("v"))
    spark, doc_type, qid_type = queries.sparkSession, dict(corpus.dtypes)[doc], dict(queries.dtypes)[qid]
    out = spark.createDataFrame([], f"qid {qid_type}, doc {doc_type}, similarity double")
    kinds = out.toArrow().schema
    for asked in _query_blocks(queries.select(F.col(qid).alias("qid"), F.col(vector).alias("v")), block):
        out = out.unionAll(rows.mapInArrow(_nearest(spark.sparkContext.broadcast(asked), k, kinds), out.schema))
    order = Window.partitionBy("qid").orderBy(F.desc("similarity"), "doc")
    return out.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _query_blocks(queries: DataFrame, most: int) -> Iterator[list[tuple[list, np.ndarray]]]:
    """Blocks of queries: (ids, unit vectors) for each number of values."""
    block: dict[int, tuple[list, list]] = {}
    done = lambda: [(ids, normalize_matrix(np.array(vectors, np.float64))) for ids, vectors in block.values()]
    n = 0
    for row in queries.toLocalIterator():
        if row["v"] and all(x is not None and np.isfinite(x) for x in row["v"]):
            ids, vectors = block.setdefault(len(row["v"]), ([], []))
            ids.append(row["qid"])
            vectors.append(row["v"])
            n += 1
        if n == most:
            yield done()
            block, n = {}, 0
    if n:
        yield done()


def vectors_by_size(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, unit vectors) for each number of values; rows without a vector are in none."""
    size = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    starts = np.cumsum(size) - size
    for n in np.unique(size[size > 0]).tolist():
        rows = np.flatnonzero(size == n)
        m = values[starts[rows][:, None] + np.arange(n)]
        good = np.isfinite(m).all(axis=1)
        yield rows[good], normalize_matrix(m[good])


def cells(m: np.ndarray, most: int = CELLS) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """(rows, pivot, radius): the vectors by their nearest pivot, with the greatest angle to it. Pivots lie far from each other."""
    first = [0]
    near = m @ m[0]
    while len(first) < min(most, len(m) // 8):
        first.append(int(near.argmin()))
        near = np.maximum(near, m @ m[first[-1]])
    like = m @ m[first].T
    own = like.argmax(axis=1)
    for c, pivot in enumerate(first):
        if len(rows := np.flatnonzero(own == c)):
            yield rows, m[pivot], float(np.arccos(np.clip(like[rows, c].min(), -1.0, 1.0)))


class Nearest:
    """The k best (similarity, doc) of each query of a block so far."""

    def __init__(self, q: np.ndarray, k: int):
        self.q, self.k, self.least = q, k, np.full(len(q), -np.inf)
        self.held: list[pd.DataFrame] = []
        self.products = 0

    def meet(self, m: np.ndarray, docs: np.ndarray) -> None:
        for rows, pivot, radius in cells(m):
            away = np.arccos(np.clip(self.q @ pivot, -1.0, 1.0))
            # no vector of the cell is nearer than its pivot by more than the radius
            reach = np.cos(np.maximum(away - radius, 0.0))
            asked = np.flatnonzero(reach + 2e-6 >= self.least)
            self.products += len(asked) * len(rows)
            if not len(asked):
                continue
            s = np.round(self.q[asked] @ m[rows].T, 6)
            cut = self.least[asked]
            if len(rows) > self.k:
                cut = np.maximum(cut, np.partition(s, -self.k, axis=1)[:, -self.k])
            at, row = np.nonzero(s >= cut[:, None])
            self.held.append(pd.DataFrame({"q": asked[at], "doc": docs[rows[row]], "s": s[at, row]}))
        self.best()

    def best(self) -> pd.DataFrame:
        if not self.held:
            return pd.DataFrame({"q": [], "doc": [], "s": []})
        every = pd.concat(self.held).sort_values(["q", "s", "doc"], ascending=[True, False, True], na_position="first")
        top = every.groupby("q").head(self.k)
        last = top.groupby("q")["s"].agg(["size", "min"])
        last = last[last["size"] == self.k]
        self.least[last.index.to_numpy(np.int64)] = last["min"]
        self.held = [top]
        return top


def _nearest(shared, k: int, kinds: pa.Schema):
    def run(batches):
        found = {q.shape[1]: (ids, Nearest(q, k)) for ids, q in shared.value}
        for batch in batches:
            # as objects where an id is null, which would turn whole numbers into floats
            docs = np.array(batch.column(0).to_pylist(), object) if batch.column(0).null_count else batch.column(0).to_numpy(zero_copy_only=False)
            for rows, m in vectors_by_size(batch.column(1)):
                for at in range(0, len(rows) if m.shape[1] in found else 0, ROWS):
                    found[m.shape[1]][1].meet(m[at : at + ROWS], docs[rows[at : at + ROWS]])
        for ids, nearest in found.values():
            top = nearest.best()
            if len(top):
                columns = [[ids[i] for i in top["q"].tolist()], top["doc"].tolist(), top["s"].tolist()]
                yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds.types)], schema=kinds)

    return run


def retrieval_units(chunks: DataFrame, annexes: DataFrame, mode: str = "chunk", cap: int = CAP) -> DataFrame:
    """(id, text, law, article, annex): annex chunks, or whole annexes in their place, never both."""
    from lexmill.functions.text import norm_name, squeeze

    number = F.regexp_extract(text("metadata.attachment_no"), r"^별표(\d+)", 1)
    is_annex = F.col("metadata.document_type") == "attachment"
    units = chunks.select(
        F.col("chunk_id").alias("id"), F.substring("content", 1, cap).alias("text"), norm_name("metadata.law_title").alias("law"), F.col("metadata.article").alias("article"),
        F.when(is_annex, F.when(number != "", number).otherwise("?")).otherwise("").alias("annex"), is_annex.alias("_annex"),
    )
    if mode == "chunk":
        return units.drop("_annex")
    kept = annexes.filter(~F.substring("body", 1, 60).rlike(r"삭제\s*(?:&lt;|<)") & (F.length(squeeze("body")) >= 40))
    n = F.regexp_extract("body", r"\[별표\s*(\d+)", 1)
    whole = kept.select(F.col("stem").alias("id"), F.substring("body", 1, cap).alias("text"), norm_name("parent_law").alias("law"), F.lit("").alias("article"), F.when(n != "", n).otherwise("?").alias("annex"))
    return units.filter("not _annex").drop("_annex").unionByName(whole)


def ingest_profile(rows: DataFrame, cap: int = CAP, limit: int | None = None) -> DataFrame:
    """(document_type, n_rows, n_capped, n_ids); limit: the first rows by id, as a dry run shows them."""
    some = rows if limit is None else rows.orderBy("chunk_id").limit(limit)
    return some.groupBy(F.col("metadata.document_type").alias("document_type")).agg(F.count("*").alias("n_rows"), F.count_if(F.length("content") > cap).alias("n_capped"), F.countDistinct("chunk_id").alias("n_ids"))
