"""Queries of tokens, BM25, vectors, fusion and recall."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.operators import embeddings as emb
from lexmill.operators import evaluation as ev
from lexmill.operators import lexical as lx
from lexmill.operators.text_index import TextIndex
from lexmill.plans.inputs import RANKINGS, questions, rankings, relevant, table
from lexmill.sources import sinks

_TOKENS = f"list_transform(regexp_extract_all(coalesce(text, ''), '{lx.TOKEN}'), lambda x: lower(x))"


def r7_tokenize(spark: SparkSession, d: str) -> DataFrame:
    t = lx.tokenize("text")
    return table(spark, d, "documents").select("doc_id", F.size(t).alias("n_tokens"), F.size(F.array_distinct(t)).alias("n_distinct"), F.md5(F.array_join(t, " ").cast("binary")).alias("tokens_md5"))


R7 = f"SELECT doc_id, CAST(len({_TOKENS}) AS INTEGER) AS n_tokens, CAST(len(list_distinct({_TOKENS})) AS INTEGER) AS n_distinct, md5(array_to_string({_TOKENS}, ' ')) AS tokens_md5 FROM documents"


def r8_bm25_terms(spark: SparkSession, d: str) -> DataFrame:
    _, terms, _ = lx.bm25_index(table(spark, d, "documents"), "doc_id")
    return terms.select("token", "df", F.round("idf", 6).alias("idf"))


R8 = f"""WITH t AS (SELECT DISTINCT doc_id, unnest({_TOKENS}) AS token FROM documents), n AS (SELECT count(*) AS n FROM documents)
SELECT token, count(*) AS df, round(ln(1 + (any_value(n) - count(*) + 0.5) / (count(*) + 0.5)), 6) AS idf FROM t, n GROUP BY token"""


def r9_bm25_topk(spark: SparkSession, d: str) -> DataFrame:
    return lx.bm25_topk(table(spark, d, "documents"), table(spark, d, "benchmark"), 10, doc="doc_id", qid="item_id")


R9 = f"""WITH sized AS (SELECT doc_id AS doc, {_TOKENS} AS tokens, greatest(len({_TOKENS}), 1) AS len FROM documents),
stats AS (SELECT count(*) AS n_docs, avg(len) AS avg_len FROM sized),
terms AS (SELECT DISTINCT item_id AS qid, unnest({_TOKENS}) AS token FROM benchmark),
postings AS (SELECT doc, len, token, count(*) AS tf FROM (SELECT doc, len, unnest(tokens) AS token FROM sized) GROUP BY ALL),
dfs AS (SELECT token, count(*) AS df FROM postings GROUP BY token),
scores AS (SELECT qid, doc, round(sum(ln(1 + (n_docs - df + 0.5) / (df + 0.5)) * (tf * 2.5) / (tf + 1.5 * (0.25 + 0.75 * len / avg_len))), 6) AS score
  FROM terms JOIN dfs USING (token) JOIN postings USING (token), stats GROUP BY qid, doc),
ranked AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, doc) AS rank FROM scores)
SELECT qid, doc, score, CAST(rank AS INTEGER) AS rank FROM ranked WHERE rank <= 10"""


def _changed_index(spark: SparkSession, d: str) -> TextIndex:
    """An index that was made with other texts for every third document, had these replaced, and lost every 7th."""
    docs = table(spark, d, "documents")
    index = TextIndex(spark, f"{sinks.shared_folder(spark)}/index-{uuid.uuid4().hex}").create()
    index.add(docs.withColumn("text", F.when(F.col("doc_id") % 3 == 0, "stale words").otherwise(F.col("text"))), "doc_id")
    index.add(docs.filter("doc_id % 3 = 0"), "doc_id")
    index.remove(docs.filter("doc_id % 7 = 0").select("doc_id"))
    return index


def r8_index_changes(spark: SparkSession, d: str) -> DataFrame:
    return _changed_index(spark, d).terms().select("token", "df", F.round("idf", 6).alias("idf"))


def r9_index_topk(spark: SparkSession, d: str) -> DataFrame:
    return _changed_index(spark, d).topk(table(spark, d, "benchmark"), 10, "item_id")


R8_CHANGES, R9_INDEX = (sql.replace("FROM documents", "FROM documents WHERE doc_id % 7 != 0") for sql in (R8, R9))


def r3_truncate_normalize(spark: SparkSession, d: str) -> DataFrame:
    v = emb.truncate_normalize("embedding", 16)
    return table(spark, d, "embeddings").select("vec_id", F.round(v[0], 6).alias("first"), F.round(v[15], 6).alias("last"), F.size(v).alias("dim"))


R3 = """WITH h AS (SELECT vec_id, CAST(embedding[1:16] AS DOUBLE[]) AS v FROM embeddings), n AS (SELECT *, sqrt(list_dot_product(v, v)) + 1e-9 AS norm FROM h)
SELECT vec_id, round(v[1] / norm, 6) AS first, round(v[16] / norm, 6) AS last, CAST(len(v) AS INTEGER) AS dim FROM n"""


def r5_knn(spark: SparkSession, d: str) -> DataFrame:
    v = table(spark, d, "embeddings")
    return emb.knn(v.filter("vec_id % 100 = 0"), v, 10, "vec_id", "vec_id")


R5 = f"WITH {RANKINGS} SELECT qid, doc, similarity, CAST(rank AS INTEGER) AS rank FROM nearest WHERE rank <= 10"


def r6_knn_filtered(spark: SparkSession, d: str) -> DataFrame:
    v = table(spark, d, "embeddings")
    return emb.knn(v.filter("vec_id % 100 = 0"), v, 5, "vec_id", "vec_id", where=F.col("label") < 3)


R6 = f"WITH {RANKINGS}, f AS (SELECT qid, doc, similarity, row_number() OVER (PARTITION BY qid ORDER BY similarity DESC, doc) AS rank FROM sims WHERE label < 3) SELECT qid, doc, similarity, CAST(rank AS INTEGER) AS rank FROM f WHERE rank <= 5"


def _weights(spark: SparkSession, weights: list[tuple[str, float, float]]) -> DataFrame:
    return spark.createDataFrame([(n, r, w) for n, a, b in weights for r, w in (("vector", a), ("label", b))], "weighting string, retriever string, weight double")


def r10_rrf(spark: SparkSession, d: str) -> DataFrame:
    return lx.rrf(rankings(spark, d), _weights(spark, [("even", 1.0, 1.0)]), top=10).drop("weighting")


def r11_weight_sweep(spark: SparkSession, d: str) -> DataFrame:
    return lx.rrf(rankings(spark, d), _weights(spark, [("w1", 1.0, 0.1), ("w3", 1.0, 0.3), ("w5", 1.0, 0.5)]), top=5)


def _rrf_sql(weights: str, top: int, columns: str) -> str:
    return f"""WITH {RANKINGS}, w(weighting, retriever, weight) AS (VALUES {weights}),
fused AS (SELECT weighting, qid, doc, round(sum(weight / (60 + rank)), 9) AS score FROM rankings JOIN w USING (retriever) GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY weighting, qid ORDER BY score DESC, doc) AS n FROM fused)
SELECT {columns}qid, doc, score, CAST(n AS INTEGER) AS rank FROM ranked WHERE n <= {top}"""


R10 = _rrf_sql("('even', 'vector', CAST(1.0 AS DOUBLE)), ('even', 'label', CAST(1.0 AS DOUBLE))", 10, "")
R11 = _rrf_sql(", ".join(f"('{n}', '{r}', CAST({w} AS DOUBLE))" for n, b in (("w1", 0.1), ("w3", 0.3), ("w5", 0.5)) for r, w in (("vector", 1.0), ("label", b))), 5, "weighting, ")


def _best(spark: SparkSession, d: str) -> DataFrame:
    return ev.best_ranks(rankings(spark, d), relevant(spark, d), questions(spark, d))


def e5_recall_at_k(spark: SparkSession, d: str) -> DataFrame:
    return ev.recall_at_k(_best(spark, d))


_BEST = f"""{RANKINGS}, qs AS (SELECT vec_id AS qid, CASE WHEN label % 2 = 0 THEN 'provisional' ELSE 'final' END AS status, label FROM embeddings WHERE vec_id % 100 = 0),
rs AS (SELECT DISTINCT retriever FROM rankings), hit AS (SELECT retriever, qid, min(rank) AS best FROM rankings SEMI JOIN relevant USING (qid, doc) GROUP BY ALL),
best AS (SELECT retriever, qid, best FROM qs CROSS JOIN rs LEFT JOIN hit USING (retriever, qid)), ks(k) AS (VALUES (1), (3), (5), (10))"""
E5 = f"WITH {_BEST} SELECT retriever, k, count(*) FILTER (best <= k) AS hits, count(*) AS n, CAST(round_even(100 * count(*) FILTER (best <= k) / count(*), 0) AS INTEGER) AS percent FROM best, ks GROUP BY retriever, k"


def e6_recall_by_subset(spark: SparkSession, d: str) -> DataFrame:
    return ev.recall_by(_best(spark, d), questions(spark, d), F.col("label") == 3)


E6 = f"""WITH {_BEST}, tags AS (SELECT qid, 'all' AS subset FROM qs UNION ALL SELECT qid, 'verified' FROM qs WHERE status != 'provisional'
  UNION ALL SELECT qid, 'provisional' FROM qs WHERE status = 'provisional' AND label != 3 UNION ALL SELECT qid, 'in_corpus' FROM qs WHERE label != 3)
SELECT retriever, subset, k, count(*) FILTER (best <= k) AS hits, count(*) AS n, CAST(round_even(100 * count(*) FILTER (best <= k) / count(*), 0) AS INTEGER) AS percent FROM best JOIN tags USING (qid), ks GROUP BY ALL"""


def e7_rank_delta(spark: SparkSession, d: str) -> DataFrame:
    out = ev.rank_delta(_best(spark, d), "vector", "label")
    return out.select("qid", F.coalesce("best_a", F.lit(0)).alias("best_a"), F.coalesce("best_b", F.lit(0)).alias("best_b"), "delta")


E7 = f"""WITH {_BEST}, w AS (SELECT qid, min(best) FILTER (retriever = 'vector') AS best_a, min(best) FILTER (retriever = 'label') AS best_b FROM best GROUP BY qid)
SELECT qid, CAST(coalesce(best_a, 0) AS INTEGER) AS best_a, CAST(coalesce(best_b, 0) AS INTEGER) AS best_b, CASE WHEN best_a IS NULL AND best_b IS NULL THEN 'both_miss' WHEN best_a IS NOT DISTINCT FROM best_b THEN 'same' WHEN best_b IS NOT NULL AND (best_a IS NULL OR best_b < best_a) THEN 'up' ELSE 'down' END AS delta FROM w"""


def e14_parity(spark: SparkSession, d: str) -> DataFrame:
    r = ev.recall_at_k(_best(spark, d))
    return ev.parity_check(r.filter("retriever = 'vector'"), r.filter("retriever = 'label'"))


E14 = f"""WITH {_BEST}, r AS (SELECT retriever, k, count(*) FILTER (best <= k) AS hits FROM best, ks GROUP BY ALL)
SELECT k, a.hits AS hits_a, b.hits AS hits_b, abs(a.hits - b.hits) <= 1 AS ok FROM (FROM r WHERE retriever = 'vector') a JOIN (FROM r WHERE retriever = 'label') b USING (k) WHERE k IN (1, 3)"""


def e19_ranked_hits(spark: SparkSession, d: str) -> DataFrame:
    return ev.ranked_hits(rankings(spark, d), relevant(spark, d), 5)


E19 = f"WITH {RANKINGS} SELECT qid, doc, retriever, CAST(rank AS INTEGER) AS rank, r.doc IS NOT NULL AS hit FROM rankings LEFT JOIN (SELECT qid, doc FROM relevant) r USING (qid, doc) WHERE rank <= 5".replace("r.doc IS NOT NULL", "r.d IS NOT NULL").replace("(SELECT qid, doc FROM relevant) r", "(SELECT qid, doc, doc AS d FROM relevant) r")


def r12_context(spark: SparkSession, d: str) -> DataFrame:
    ranked = lx.bm25_topk(table(spark, d, "documents"), table(spark, d, "benchmark"), 3, doc="doc_id", qid="item_id")
    chunks = table(spark, d, "documents").select(F.col("doc_id").alias("chunk_id"), F.col("text").alias("content"))
    c = lx.assemble_context(ranked, chunks, 3)
    return c.select("qid", F.md5(F.col("context").cast("binary")).alias("context_md5"), F.array_join(F.col("chunk_ids").cast("array<string>"), ",").alias("ids"))


R12 = R9.replace("SELECT qid, doc, score, CAST(rank AS INTEGER) AS rank FROM ranked WHERE rank <= 10", """, top AS (SELECT qid, rank, doc, left(text, 20000) AS content FROM ranked JOIN documents ON doc = doc_id WHERE rank <= 3)
SELECT qid, md5(string_agg('[자료 ' || rank || ']' || chr(10) || content, chr(10) || chr(10) || '---' || chr(10) || chr(10) ORDER BY rank)) AS context_md5, string_agg(CAST(doc AS VARCHAR), ',' ORDER BY rank) AS ids FROM top GROUP BY qid""")


def r13_excerpt(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    rows = docs.select("doc_id", "text", F.array(F.array(F.lit("the"))).alias("answer_keys"), F.lit("which line of I-131").alias("question"))
    return lx.excerpt(rows, ["doc_id"]).select("doc_id", F.array_join("lines", "\n").alias("lines"))


R13 = """WITH lines AS (SELECT doc_id, unnest(list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: trim(x, ' ') != '')) AS line, generate_subscripts(list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: trim(x, ' ') != ''), 1) AS pos FROM documents),
heads AS (SELECT doc_id, min(pos) AS pos, arg_min(line, pos) AS line FROM lines WHERE length(line) - length(replace(line, '|', '')) > 1 GROUP BY doc_id),
rest AS (SELECT l.doc_id, l.pos, CASE WHEN length(l.line) > 190 THEN left(l.line, 190) || '…' ELSE l.line END AS line, regexp_replace(l.line, '[^가-힣0-9A-Za-z]', '', 'g') AS plain FROM lines l LEFT JOIN heads h ON h.doc_id = l.doc_id AND h.pos = l.pos WHERE h.pos IS NULL AND NOT starts_with(ltrim(l.line, ' '), '[수록 항목]')),
scored AS (SELECT doc_id, pos, line, 2 * CAST(contains(plain, 'I131') AS INTEGER) + 2 * CAST(contains(plain, 'the') AS INTEGER) AS score FROM rest),
placed AS (SELECT *, max(score) OVER (PARTITION BY doc_id) AS top, row_number() OVER (PARTITION BY doc_id, score >= 2 ORDER BY pos) AS n_strong, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS n FROM scored)
SELECT p.doc_id, CASE WHEN any_value(h.line) IS NULL THEN '' WHEN length(any_value(h.line)) > 190 THEN left(any_value(h.line), 190) || '…' || chr(10) ELSE any_value(h.line) || chr(10) END || string_agg(p.line, chr(10) ORDER BY p.pos) AS lines
FROM placed p LEFT JOIN heads h USING (doc_id) WHERE (top >= 2 AND score >= 2 AND n_strong <= 6) OR (top < 2 AND n <= 2) GROUP BY p.doc_id"""


def embedded(spark: SparkSession, d: str) -> DataFrame:
    return emb.embed(table(spark, d, "documents").select("doc_id", "text"), "text", emb.hashing_embedder(32))


def r4_embed(spark: SparkSession, d: str) -> DataFrame:
    """The sign of each value, and the first of the greatest ones: exact, whatever the rounding of a length is."""
    sign = lambda x: F.when(x > 0, "+").when(x < 0, "-").otherwise("0")
    size = F.transform("embedding", lambda x: F.abs(x))
    return embedded(spark, d).select("doc_id", F.size("embedding").alias("dim"), F.array_join(F.transform("embedding", sign), "").alias("signs"), F.array_position(size, F.array_max(size)).cast("int").alias("greatest"))


#: Signed counts of hashed byte trigrams, by 32 bits arithmetic.
R4 = """WITH b AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
grams AS (SELECT doc_id, CAST('0x' || substr(h, 2 * i + 1, 6) AS BIGINT) AS x FROM (SELECT doc_id, h, unnest(generate_series(0, length(h) // 2 - 3)) AS i FROM b WHERE length(h) >= 6)),
hashed AS (SELECT doc_id, ((x >> 16) * 65599 + ((x >> 8) & 255) * 257 + (x & 255)) * 2654435761 % 4294967296 AS h FROM grams),
counts AS (SELECT doc_id, (h >> 8) % 32 AS place, sum(CASE WHEN h & 1 = 1 THEN 1 ELSE -1 END) AS n FROM hashed GROUP BY ALL),
every AS (SELECT doc_id, place, coalesce(n, 0) AS n FROM (SELECT doc_id, unnest(generate_series(0, 31)) AS place FROM documents) LEFT JOIN counts USING (doc_id, place))
SELECT doc_id, CAST(count(*) AS INTEGER) AS dim, string_agg(CASE WHEN n > 0 THEN '+' WHEN n < 0 THEN '-' ELSE '0' END, '' ORDER BY place) AS signs, CAST(arg_min(place, -100 * abs(n) + place / 32.0) + 1 AS INTEGER) AS greatest FROM every GROUP BY doc_id"""


def e12_answerable(spark: SparkSession, d: str) -> DataFrame:
    ranked = lx.bm25_topk(table(spark, d, "documents"), table(spark, d, "benchmark"), 10, doc="doc_id", qid="item_id").withColumn("retriever", F.lit("bm25"))
    asked = table(spark, d, "benchmark").select(F.col("item_id").alias("qid"), F.array(F.array(F.col("text")), F.array(F.lit("absent words"), F.substring("text", 1, 30))).alias("answer_keys"))
    units = table(spark, d, "documents").select(F.col("doc_id").alias("id"), "text")
    return ev.answerable_recall(ranked, asked, units)


_PLAIN = "regexp_replace(coalesce({}, ''), '[^가-힣0-9A-Za-z]', '', 'g')"
E12 = R9.replace("SELECT qid, doc, score, CAST(rank AS INTEGER) AS rank FROM ranked WHERE rank <= 10", f""", near AS (SELECT qid, rank, doc, {_PLAIN.format("d.text")} AS plain, {_PLAIN.format("b.text")} AS whole, {_PLAIN.format("left(b.text, 30)")} AS start FROM ranked JOIN documents d ON doc = d.doc_id JOIN benchmark b ON qid = item_id WHERE rank <= 10),
ks(k) AS (VALUES (1), (3), (5), (10)), joined AS (SELECT qid, k, string_agg(plain, '' ORDER BY rank) AS plain, any_value(whole) AS whole, any_value(start) AS start, bool_or(contains(plain, whole) AND (contains(plain, 'absentwords') OR contains(plain, start))) AS strict FROM near, ks WHERE rank <= k GROUP BY qid, k),
hits AS (SELECT k, count(*) FILTER (strict) AS strict, count(*) FILTER (contains(plain, whole) AND (contains(plain, 'absentwords') OR contains(plain, start))) AS joint FROM joined GROUP BY k)
SELECT 'bm25' AS retriever, 'strict' AS mode, CAST(k AS INTEGER) AS k, strict AS hits, (SELECT count(DISTINCT item_id) FROM benchmark) AS n FROM hits UNION ALL SELECT 'bm25', 'union', CAST(k AS INTEGER), joint, (SELECT count(DISTINCT item_id) FROM benchmark) FROM hits""")


def e13_hit_without_answer(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    ranked = lx.bm25_topk(docs, table(spark, d, "benchmark"), 10, doc="doc_id", qid="item_id").withColumn("retriever", F.lit("bm25"))
    asked = table(spark, d, "benchmark").select(F.col("item_id").alias("qid"), F.array(F.array(F.col("text"))).alias("answer_keys"))
    relevant_ = ranked.filter("rank = 2").select("qid", "doc")
    best = ev.best_ranks(ranked, relevant_, asked)
    return ev.source_hit_answer_miss(ranked, best, asked, docs.select(F.col("doc_id").alias("id"), "text"))


E13 = R9.replace("SELECT qid, doc, score, CAST(rank AS INTEGER) AS rank FROM ranked WHERE rank <= 10", f""", near AS (SELECT qid, rank, {_PLAIN.format("d.text")} AS plain, {_PLAIN.format("b.text")} AS whole FROM ranked JOIN documents d ON doc = d.doc_id JOIN benchmark b ON qid = item_id WHERE rank <= 5)
SELECT 'bm25' AS retriever, qid FROM near GROUP BY qid HAVING max(rank) >= 2 AND NOT contains(string_agg(plain, '' ORDER BY rank), any_value(whole))""")


_NAMES = {f.__name__: f for f in (r3_truncate_normalize, r4_embed, r5_knn, r6_knn_filtered, r7_tokenize, r8_bm25_terms, r8_index_changes, r9_bm25_topk, r9_index_topk, r10_rrf, r11_weight_sweep, r12_context, r13_excerpt, e5_recall_at_k, e6_recall_by_subset, e7_rank_delta, e12_answerable, e13_hit_without_answer, e14_parity, e19_ranked_hits)}
QUERIES = _NAMES
ORACLES = {
    "r3_truncate_normalize": R3, "r4_embed": R4, "r5_knn": R5, "r6_knn_filtered": R6, "r7_tokenize": R7, "r8_bm25_terms": R8, "r8_index_changes": R8_CHANGES, "r9_bm25_topk": R9, "r9_index_topk": R9_INDEX, "r10_rrf": R10, "r11_weight_sweep": R11, "r12_context": R12, "r13_excerpt": R13,
    "e5_recall_at_k": E5, "e6_recall_by_subset": E6, "e7_rank_delta": E7, "e12_answerable": E12, "e13_hit_without_answer": E13, "e14_parity": E14, "e19_ranked_hits": E19,
}
