"""A stored BM25 index of segments, with deletions, that serves many queries without reading a text again.

Adding documents writes a segment: their different tokens with counts, document by document, and the
number of documents of each token. Documents that were there already are deleted first. A deletion
writes the keys, and what they had added to the tokens' numbers with a minus sign, so that df, idf and
averages are sums over segments and deletions and equal those of an index made anew. Versions are
committed like those of a keyed table (sources.commits): readers see whole ones only.
"""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.operators import ranking
from lexmill.operators.guards import assert_unique
from lexmill.operators.lexical import K1, TOP, B, document_terms, idf
from lexmill.sources.commits import CommitLog


class TextIndex:
    """The index at root. Its documents have keys of one type, none of them null."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.log = spark, root.rstrip("/"), CommitLog(spark, root)

    def create(self, key_type: str = "long") -> TextIndex:
        self.log.commit(1, {"key": key_type, "n_docs": 0, "total": 0, "segments": [], "deletions": []})
        return self

    def _version(self, version: int | None = None) -> tuple[int, dict]:
        number, content = self.log.read(version)
        if content is None:
            raise FileNotFoundError(f"no index at {self.root}")
        return number, content

    def _read(self, folders: list[str], part: str, schema: str) -> DataFrame:
        paths = [f"{self.root}/{f}/{part}" for f in folders]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def documents(self, version: int | None = None) -> DataFrame:
        """(doc, len, tokens, tfs) of the documents that are not deleted."""
        return self._live(self._version(version)[1])

    def _live(self, now: dict) -> DataFrame:
        schema = f"doc {now['key']}, len long, tokens array<string>, tfs array<long>, segment long"
        rows = self._read(now["segments"], "docs", schema)
        gone = self._read(now["deletions"], "docs", f"doc {now['key']}, before long").groupBy("doc").agg(F.max("before").alias("before"))
        if not now["deletions"]:
            return rows.drop("segment")
        return rows.join(gone.withColumnRenamed("doc", "_doc"), (F.col("doc") == F.col("_doc")) & (F.col("segment") < F.col("before")), "left_anti").drop("segment")

    def _put(self, rows: DataFrame, name: str, number: int) -> str:
        folder = f"data/{number}-{uuid.uuid4().hex[:12]}"
        rows.write.parquet(f"{self.root}/{folder}/{name}")
        return folder

    def _counted(self, folder: str, sign: int) -> tuple[int, int]:
        """Writes the token numbers of a folder's documents; the documents and all their tokens."""
        rows = self.spark.read.parquet(f"{self.root}/{folder}/docs")
        df = rows.select(F.explode("tokens").alias("token")).groupBy("token").agg((sign * F.count("*")).alias("df"))
        # in the order of tokens, so that a query's tokens lie in few row groups
        df.repartitionByRange("token").sortWithinPartitions("token").write.parquet(f"{self.root}/{folder}/terms")
        n, total = rows.agg(F.count("*"), F.sum("len")).first()
        return n, total or 0

    def _without(self, now: dict, keys: DataFrame, number: int) -> dict:
        """The content of a version in which the documents of keys (doc) are deleted."""
        found = self._live(now).join(keys.select("doc").distinct(), "doc", "left_semi").withColumn("before", F.lit(number).cast("long"))
        folder = self._put(found, "docs", number)
        n, total = self._counted(folder, -1)
        if not n:
            self.log.delete(folder)
            return now
        return now | {"deletions": [*now["deletions"], folder], "n_docs": now["n_docs"] - n, "total": now["total"] - total}

    def add(self, docs: DataFrame, doc: str = "doc", body: str = "text") -> int:
        """The version with docs, in place of documents of the same keys. Keys must be unique within docs."""
        number, now = self._version()
        rows = document_terms(assert_unique(docs.filter(F.col(doc).isNotNull()), doc), doc, body)
        folder = self._put(rows.withColumn("doc", F.col("doc").cast(now["key"])).withColumn("segment", F.lit(number + 1).cast("long")), "docs", number + 1)
        now = self._without(now, self.spark.read.parquet(f"{self.root}/{folder}/docs"), number + 1)
        n, total = self._counted(folder, 1)
        self.log.commit(number + 1, now | {"segments": [*now["segments"], folder], "n_docs": now["n_docs"] + n, "total": now["total"] + total})
        return number + 1

    def remove(self, keys: DataFrame) -> int:
        """The version without the documents whose key is in keys' first column; unknown keys change nothing."""
        number, now = self._version()
        new = self._without(now, keys.select(F.col(keys.columns[0]).cast(now["key"]).alias("doc")), number + 1)
        if new is now:
            return number
        self.log.commit(number + 1, new)
        return number + 1

    def compact(self) -> int:
        """The version in which one segment holds what is left of all."""
        number, now = self._version()
        folder = self._put(self._live(now).withColumn("segment", F.lit(number + 1).cast("long")), "docs", number + 1)
        n, total = self._counted(folder, 1)
        self.log.commit(number + 1, now | {"segments": [folder], "deletions": [], "n_docs": n, "total": total})
        return number + 1

    def vacuum(self, keep: int = 2) -> list[str]:
        """Removes all but the newest `keep` versions and what only they held."""
        return self.log.forget(keep, lambda content: content["segments"] + content["deletions"])

    def _numbers(self, now: dict) -> DataFrame:
        return self._read(now["segments"] + now["deletions"], "terms", "token string, df long")

    def terms(self, version: int | None = None) -> DataFrame:
        """(token, df, idf) of the tokens that some document holds."""
        _, now = self._version(version)
        df = self._numbers(now).groupBy("token").agg(F.sum("df").alias("df")).filter("df > 0")
        return df.select("token", "df", idf(F.lit(now["n_docs"])).alias("idf"))

    def stats(self, version: int | None = None) -> tuple[int, float]:
        """The number of documents and their average length."""
        _, now = self._version(version)
        return now["n_docs"], now["total"] / max(1, now["n_docs"])

    def topk(self, queries: DataFrame, k: int = TOP, qid: str = "qid", query: str = "text", k1: float = K1, b: float = B, version: int | None = None) -> DataFrame:
        """(qid, doc, score, rank): as lexical.bm25_topk gives them, from the index alone."""
        _, now = self._version(version)
        live, found = self._live(now), []
        for asked in ranking.asked_blocks(queries, qid, query) if now["n_docs"] else ():
            words = self.spark.createDataFrame([(w,) for w in asked.words], "token string")
            numbers = self._numbers(now).join(F.broadcast(words), "token", "left_semi").groupBy("token").agg(F.sum("df").alias("df")).toArrow()
            df = dict(zip(numbers["token"].to_pylist(), numbers["df"].to_pylist()))
            asked.weighted(np.array([df.get(w, 0) for w in asked.words], np.int64), now["n_docs"], now["total"] / now["n_docs"], k1, b)
            found.append(ranking.best_of_blocks(live, ranking.term_blocks, asked, k))
        return ranking.merged(found, live, queries, "doc", qid, k)
