"""Tokens, an inverted index, BM25 and rank fusion.

A query meets only the postings of its own terms, so scoring moves postings and not documents; the
index counts before it shuffles, and AQE splits hot terms in the join.
"""

from __future__ import annotations

import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexmill.functions.text import text

#: Tokens: names such as I-131, words of two letters, numbers, runs of Hangul (fixed values).
TOKEN = r"[A-Za-z]+-\d+[A-Za-z]*|[A-Za-z]{2,}|\d+(?:\.\d+)?|[가-힣]+"
K1, B, RRF_K, TOP = 1.5, 0.75, 60, 100
#: Terms of all queries that are broadcast at most.
MOST_TERMS = 500_000


def _grams(word: Column, n: int) -> Column:
    return F.transform(F.sequence(F.lit(1), F.length(word) - (n - 1)), lambda i: F.substring(word, i, n))


_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _words(c: Column | str) -> Column:
    """A token's letters are ASCII or Hangul, so the text is lower-cased as a whole, A-Z only."""
    return F.translate(text(c), _CAPITALS, _CAPITALS.lower())


def tokenize(c: Column | str) -> Column:
    """Tokens with repeats: Hangul of over two characters as 2- and 3-grams, the rest lower-cased."""
    words = F.regexp_extract_all(_words(c), F.lit(TOKEN), F.lit(0))
    grams = lambda w: F.when(~w.rlike("^[가-힣]{3}"), F.array(w)).otherwise(F.concat(_grams(w, 2), _grams(w, 3)))
    return F.when(_words(c).rlike("[가-힣]{3}"), F.flatten(F.transform(words, grams))).otherwise(words)


def token_count(c: Column | str) -> Column:
    """size(tokenize(c)), without the tokens where no long Hangul is in the text."""
    return F.when(_words(c).rlike("[가-힣]{3}"), F.size(tokenize(c))).otherwise(F.regexp_count(text(c), F.lit(TOKEN)))


_TOKENS = re.compile(TOKEN, re.ASCII)
_LONG = re.compile("[가-힣]{3,}")


def token_list(body: str) -> list[str]:
    """tokenize() of one text, for tasks that count tokens themselves."""
    if body.isascii():
        return _TOKENS.findall(body.lower())
    out = []
    for word in _TOKENS.findall(body):
        if _LONG.fullmatch(word):
            out += [word[i : i + n] for n in (2, 3) for i in range(len(word) - n + 1)]
        else:
            out.append(word.lower())
    return out


def document_terms(docs: DataFrame, doc: str = "doc", body: str = "text") -> DataFrame:
    """(doc, len, tokens, tfs): each document's different tokens with their counts, made where the document lies."""
    rows = docs.select(F.col(doc).alias("doc"), text(body).alias("body"))

    def run(batches):
        for batch in batches:
            size, tokens, tfs = [], [], []
            for body in batch.column(1).to_pylist():
                counts = Counter(token_list(body))
                size.append(max(1, counts.total()))
                tokens.append(list(counts))
                tfs.append(list(counts.values()))
            columns = [pa.array(size, pa.int64()), pa.array(tokens, pa.list_(pa.string())), pa.array(tfs, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["doc", "len", "tokens", "tfs"])

    return rows.mapInArrow(run, f"doc {dict(rows.dtypes)['doc']}, len long, tokens array<string>, tfs array<long>")


def idf(n_docs: Column | str = "n_docs", df: Column | str = "df") -> Column:
    n, d = (F.col(c) if isinstance(c, str) else c for c in (n_docs, df))
    return F.log(1 + (n - d + 0.5) / (d + 0.5))


def bm25_index(docs: DataFrame, doc: str = "doc", body: str = "text") -> tuple[DataFrame, DataFrame, DataFrame]:
    """postings (token, doc, tf, len), terms (token, df, idf) and stats (n_docs, avg_len), as tables of one
    snapshot; text_index.TextIndex stores them, takes changes and answers queries.

    Counts are made before anything is shuffled: df is one sum by token.
    """
    rows = document_terms(docs, doc, body)
    postings = rows.select("doc", "len", F.explode(F.arrays_zip("tokens", "tfs")).alias("t")).select(F.col("t.tokens").alias("token"), "doc", F.col("t.tfs").alias("tf"), "len")
    stats = rows.agg(F.count("*").alias("n_docs"), F.avg("len").alias("avg_len"))
    df = rows.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count("*").alias("df"))
    terms = df.join(F.broadcast(docs.agg(F.count("*").alias("n_docs"))), how="cross").select("token", "df", idf().alias("idf"))
    return postings, terms, stats


def _stats(docs: DataFrame, body: str) -> DataFrame:
    return docs.select(F.greatest(token_count(body), F.lit(1)).alias("len")).agg(F.count("*").alias("n_docs"), F.avg("len").alias("avg_len"))


def bm25_scores(docs: DataFrame, queries: DataFrame, doc: str = "doc", body: str = "text", qid: str = "qid", query: str = "text", k1: float = K1, b: float = B) -> DataFrame:
    """(qid, doc, score) of every document that shares a term with the query.

    Only the terms of queries are indexed: the postings are filtered by a semi-join before counting.
    """
    terms = queries.select(F.col(qid).alias("qid"), F.explode(F.array_distinct(tokenize(query))).alias("token"))
    sized = docs.select(F.col(doc).alias("doc"), tokenize(body).alias("tokens")).withColumn("len", F.greatest(F.size("tokens"), F.lit(1)))
    stats = _stats(docs, body)
    asked = terms.select("token").distinct()
    if asked.limit(MOST_TERMS + 1).count() <= MOST_TERMS:
        asked = F.broadcast(asked)  # tokens that nobody asks for are not shuffled
    postings = sized.select("doc", "len", F.explode("tokens").alias("token")).join(asked, "token", "left_semi")
    postings = postings.groupBy("token", "doc").agg(F.count("*").alias("tf"), F.first("len").alias("len"))
    df = postings.groupBy("token").agg(F.count("*").alias("df"))
    scored = terms.join(df, "token").join(postings, "token").join(F.broadcast(stats), how="cross")
    idf = F.log(1 + (F.col("n_docs") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    part = idf * (F.col("tf") * (k1 + 1)) / (F.col("tf") + k1 * (1 - b + b * F.col("len") / F.col("avg_len")))
    return scored.groupBy("qid", "doc").agg(F.sum(part).alias("score"))


def rank(scores: DataFrame, top: int = TOP, score: Column | None = None, by: tuple[str, ...] = ("qid",)) -> DataFrame:
    """Adds rank (from 1, ties by doc) and keeps the first `top` of each query."""
    score = F.col("score") if score is None else score
    order = Window.partitionBy(*by).orderBy(score.desc(), "doc")
    return scores.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def bm25_topk(docs: DataFrame, queries: DataFrame, k: int = TOP, doc: str = "doc", body: str = "text", qid: str = "qid", query: str = "text", k1: float = K1, b: float = B) -> DataFrame:
    """(qid, doc, score, rank): the first k documents of each query, without the pairs that cannot be among them.

    Queries go in blocks of a fixed size. One scan of the texts counts the asked terms, a second one scores
    block by block of documents under upper bounds (ranking.best_of_blocks), so that k rows for each query and task are shuffled.
    Scores rank at six decimals, so that the order of sums plays no part; rows of one qid are one query.
    """
    from lexmill.operators import ranking

    texts = docs.select(F.col(doc).alias("doc"), text(body).alias("body"))
    found = []
    for asked in ranking.asked_blocks(queries, qid, query):
        n_docs, total, df = ranking.count_asked(texts.select("body"), asked)
        if n_docs:
            found.append(ranking.best_of_blocks(texts, ranking.text_blocks, asked.weighted(df, n_docs, total / n_docs, k1, b), k))
    return ranking.merged(found, docs, queries, doc, qid, k)


def rrf(rankings: DataFrame, weights: DataFrame, k: int = RRF_K, top: int = TOP, depth: int = TOP) -> DataFrame:
    """(weighting, qid, doc, score, rank) over the first `depth` of each list, for rankings (qid, retriever, rank, doc) and weights
    (weighting, retriever, weight): a few rows, one weighting or several in one pass."""
    share = F.col("weight") / (k + F.col("rank"))
    fused = rankings.filter(F.col("rank") <= depth).join(F.broadcast(weights), "retriever").groupBy("weighting", "qid", "doc").agg(F.round(F.sum(share), 9).alias("score"))
    return rank(fused, top, by=("weighting", "qid"))


def assemble_context(rankings: DataFrame, chunks: DataFrame, k: int, cap: int = 20000) -> DataFrame:
    """(qid, context, chunk_ids): the first k chunks numbered and joined, each cut at cap."""
    rows = rankings.filter(F.col("rank") <= k).join(chunks.select(F.col("chunk_id").alias("doc"), "content"), "doc")
    ordered = F.array_sort(F.collect_list(F.struct("rank", "doc", F.substring("content", 1, cap).alias("content"))))
    grouped = rows.groupBy("qid").agg(ordered.alias("r"))
    parts = F.transform("r", lambda x, i: F.concat(F.lit("[자료 "), (i + 1).cast("string"), F.lit("]\n"), x["content"]))
    return grouped.select("qid", F.array_join(parts, "\n\n---\n\n").alias("context"), F.transform("r", lambda x: x["doc"]).alias("chunk_ids"))


def excerpt(rows: DataFrame, key: list[str], body: str = "text", keys: str = "answer_keys", question: str = "question", most: int = 6, width: int = 190) -> DataFrame:
    """(key..., lines): the lines that bear on a question: those with its names or answer keys, at
    most `most` in order, after the first table line; without any, a taste of two."""
    from lexmill.functions.text import has_all, norm_text

    wide = rows.select(*key, keys, question, F.filter(F.split(text(body), "\n"), lambda x: F.trim(x) != "").alias("_lines"))
    is_table = lambda x: F.size(F.split(x, r"\|", -1)) > 2
    wide = wide.withColumn("_head", F.get(F.filter("_lines", is_table), F.lit(0))).withColumn("_head_at", F.array_position("_lines", F.col("_head")) - 1)
    names = F.transform(F.regexp_extract_all(F.col(question), F.lit(r"[A-Za-z]+-\d+[A-Za-z]*|제\d+조(?:의\d+)?|별표\s*\d+"), F.lit(0)), norm_text)
    each = wide.withColumn("_names", F.filter(names, lambda n: n != "")).select("*", F.posexplode("_lines").alias("_at", "_line"))
    each = each.filter(~F.col("_at").eqNullSafe(F.col("_head_at")) & ~F.ltrim("_line").startswith("[수록 항목]"))
    plain = norm_text("_line")
    hits = F.size(F.filter("_names", lambda n: F.contains(plain, n)))
    key_hits = F.transform(keys, lambda k: has_all(F.col("_line"), F.array(k)))
    of_keys = F.when(F.coalesce(F.size(keys), F.lit(0)) == 0, 0).when(F.forall(key_hits, lambda x: x), 2).when(F.exists(key_hits, lambda x: x), 1).otherwise(0)
    cut = F.when(F.length("_line") > width, F.concat(F.substring("_line", 1, width), F.lit("…"))).otherwise(F.col("_line"))
    scored = each.select(*key, "_head", "_at", cut.alias("_cut"), (2 * hits + of_keys).alias("_score"))
    found = scored.groupBy(*key).agg(F.first("_head").alias("_head"), F.max("_score").alias("_top"), F.array_sort(F.collect_list(F.struct(F.col("_at").alias("at"), F.col("_cut").alias("line"), F.col("_score").alias("score")))).alias("_all"))
    strong = F.slice(F.filter("_all", lambda x: x["score"] >= 2), 1, most)
    best = F.slice(F.array_sort("_all", lambda a, b: F.when(a["score"] != b["score"], (b["score"] - a["score"]).cast("int")).otherwise((a["at"] - b["at"]).cast("int"))), 1, 2)
    weak = F.array_sort(F.filter(best, lambda x: x["score"] > 0))
    picked = F.when(F.col("_top") >= 2, strong).when(F.size(weak) > 0, weak).otherwise(F.slice("_all", 1, 2))
    lines = F.transform(picked, lambda x: x["line"])
    head = F.when(F.length("_head") > width, F.concat(F.substring("_head", 1, width), F.lit("…"))).otherwise(F.col("_head"))
    return found.select(*key, F.when(F.col("_head").isNotNull(), F.concat(F.array(head), lines)).otherwise(lines).alias("lines"))
