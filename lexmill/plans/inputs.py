"""Inputs of the queries: the given tables, and documents, feeds and manifests derived from them.

Each derivation has an SQL twin of the same name in upper case, for the oracles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _lines(c: Column | str = "text") -> Column:
    return F.split(F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit("")), "\n", -1)


def statutes(spark: SparkSession, sf_dir: str, new: bool = False) -> DataFrame:
    """(kind, path, stem, raw): each document as a statute whose lines are its articles.

    new: the later snapshot. Every 7th has its first article changed, every 13th one article more,
    every 11th is gone, every 5th has a new version key, every 3rd other quotes only.
    """
    docs = table(spark, sf_dir, "documents")
    k = F.col("doc_id")
    lines = _lines()
    if new:
        docs = docs.filter(k % 11 != 0)
        lines = F.transform(lines, lambda x, i: F.when((i == 0) & (k % 7 == 0), F.concat(x, F.lit(" amended"))).otherwise(x))
        lines = F.when(k % 13 == 0, F.concat(lines, F.array(F.lit("one more")))).otherwise(lines)
    version = F.when((k % 5 == 0) & F.lit(new), k + 1_000_000).otherwise(k).cast("string")
    quote = F.when((k % 3 == 0) & F.lit(new), "'").otherwise("")
    body = F.array_join(F.transform(lines, lambda x, i: F.concat(F.lit("##### 제"), (i + 1).cast("string"), F.lit("조 ("), "source", F.lit(")\n"), x)), "\n")
    title = F.when((k % 7 == 0) & F.lit(new), F.concat(F.lit("form "), "lang")).otherwise(F.concat(F.lit("table "), "lang"))
    second = F.when((k % 13 == 0) & F.lit(new), F.lit("\n- 별표번호: '0002'\n  별표가지번호: '03'\n  별표구분: 서식\n  제목: added\n  파일링크: https://a.example/2\n  PDF링크: https://a.example/2.pdf")).otherwise("")
    raw = F.concat(
        F.lit("---\n제목: "), quote, "source", quote, F.lit("\n법령ID: '"), F.lpad(k.cast("string"), 6, "0"), F.lit("'\n법령MST: "), version,
        F.lit("\n법령구분: 법률\n소관부처:\n- 보건복지부\n공포일자: 2026-01-"), F.lpad((k % 28 + 1).cast("string"), 2, "0"),
        F.lit("\n시행일자: 2026-07-09\n상태: 시행\n출처: "), "lang",
        F.lit("\n첨부파일:\n- 별표번호: '0001'\n  별표가지번호: '00'\n  별표구분: 별표\n  제목: "), title, F.lit("\n  파일링크: https://a.example/"), k.cast("string"), F.lit("\n  PDF링크: ''"), second,
        F.lit("\n---\n"), body, F.lit("\n## 부칙\n제1조 시행한다"), F.when((k % 17 == 0) & F.lit(new), " 다시").otherwise(""),
    )
    return docs.select(F.lit("law").alias("kind"), F.concat(F.lit("law/"), k.cast("string"), F.lit(".md")).alias("path"), k.cast("string").alias("stem"), raw.alias("raw"), "doc_id")


#: Articles of the statutes as (doc_id, pos, article, title, text, line) without any parsing.
ARTICLES = """articles AS (SELECT doc_id, i - 1 AS pos, '제' || i || '조' AS article, source AS title, regexp_replace(line, '^\\s+|\\s+$', '', 'g') AS text, line,
  '##### 제' || i || '조 (' || source || ')' || chr(10) || line AS piece
  FROM (SELECT doc_id, source, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents))"""
NEW_ARTICLES = """new_articles AS (SELECT doc_id, i - 1 AS pos, '제' || i || '조' AS article, source AS title, line,
  '##### 제' || i || '조 (' || source || ')' || chr(10) || line AS piece
  FROM (SELECT doc_id, source, unnest(lines) AS line, generate_subscripts(lines, 1) AS i FROM
    (SELECT doc_id, source, CASE WHEN doc_id % 13 = 0 THEN list_append(changed, 'one more') ELSE changed END AS lines FROM
      (SELECT doc_id, source, list_transform(string_split(coalesce(text, ''), chr(10)), lambda x, i: CASE WHEN i = 1 AND doc_id % 7 = 0 THEN x || ' amended' ELSE x END) AS changed
       FROM documents WHERE doc_id % 11 != 0))))"""


def version_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a feed of versions: the customer is the law, the order its version."""
    orders = table(spark, sf_dir, "orders")
    day = lambda d: F.date_format(d, "yyyyMMdd")
    return orders.select(
        F.lpad(F.col("o_custkey").cast("string"), 6, "0").alias("law_id"), F.col("o_orderkey").cast("string").alias("mst"), day("o_orderdate").alias("promulgate_date"),
        day(F.date_add("o_orderdate", (F.col("o_orderkey") % 400).cast("int"))).alias("enforce_date"), F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("revision_class"),
        F.concat(F.lit("law "), F.col("o_custkey").cast("string")).alias("name"), F.col("o_orderkey").alias("seq"),
        F.concat(F.lit("ministry "), (F.col("o_custkey") % 7).cast("string")).alias("ministry_name"), (F.col("o_orderkey") % 1000).cast("string").alias("promulgate_no"),
    )


FEED = """feed AS (SELECT lpad(CAST(o_custkey AS VARCHAR), 6, '0') AS law_id, CAST(o_orderkey AS VARCHAR) AS mst, strftime(o_orderdate, '%Y%m%d') AS promulgate_date,
  strftime(CAST(o_orderdate AS DATE) + CAST(o_orderkey % 400 AS INTEGER), '%Y%m%d') AS enforce_date, o_orderstatus AS status, o_orderpriority AS revision_class,
  'law ' || o_custkey AS name, o_orderkey AS seq, 'ministry ' || (o_custkey % 7) AS ministry_name, CAST(o_orderkey % 1000 AS VARCHAR) AS promulgate_no FROM orders)"""


def watchlist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as watched laws; every 50th has no id, every 3rd segment letter decides the tier."""
    c = table(spark, sf_dir, "customer")
    core = F.col("c_mktsegment").isin("BUILDING", "MACHINERY")
    return c.select(
        F.concat(F.lit("law "), F.col("c_custkey").cast("string")).alias("name"), F.when(F.col("c_custkey") % 50 == 0, "").otherwise(F.col("c_custkey").cast("string")).alias("law_id"),
        F.when(core, "core").otherwise("peripheral").alias("tier"), F.array(F.lit("제1조"), F.col("c_mktsegment")).alias("watch"), F.col("c_custkey"),
    )


WATCHLIST = """watchlist AS (SELECT 'law ' || c_custkey AS name, CASE WHEN c_custkey % 50 = 0 THEN '' ELSE CAST(c_custkey AS VARCHAR) END AS law_id,
  CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'core' ELSE 'peripheral' END AS tier, '제1조; ' || c_mktsegment AS hints, c_custkey FROM customer)"""


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as attachments of their order's customer's law."""
    rows = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    place = (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("pos")
    shared = F.concat(F.lit("https://a.example/"), (F.col("l_partkey") % 500).cast("string"))
    return rows.select(
        (F.col("o_custkey") % 10 == 0).alias("is_rule"), F.concat(F.lit("law "), F.col("o_custkey").cast("string")).alias("parent"), place, F.col("l_partkey").cast("string").alias("no"),
        F.lpad((F.col("l_linenumber") - 1).cast("string"), 2, "0").alias("branch"), F.when(F.col("l_returnflag") == "N", "별표").otherwise("서식").alias("kind"),
        F.concat(F.lit("제"), F.col("l_linenumber").cast("string"), F.lit("조 "), "l_linestatus", F.when(F.col("l_suppkey") % 4 == 0, " 방사선").otherwise("")).alias("title"),
        F.when(F.col("l_linenumber") % 3 == 0, "").otherwise(shared).alias("file_link"), F.when(F.col("l_linenumber") % 2 == 0, "").otherwise(F.concat(shared, F.lit(".pdf"))).alias("pdf_link"),
    )


MANIFEST = """manifest AS (SELECT o_custkey % 10 = 0 AS is_rule, 'law ' || o_custkey AS parent, l_orderkey * 10 + l_linenumber AS pos, CAST(l_partkey AS VARCHAR) AS no,
  lpad(CAST(l_linenumber - 1 AS VARCHAR), 2, '0') AS branch, CASE WHEN l_returnflag = 'N' THEN '별표' ELSE '서식' END AS kind,
  '제' || l_linenumber || '조 ' || l_linestatus || CASE WHEN l_suppkey % 4 = 0 THEN ' 방사선' ELSE '' END AS title,
  CASE WHEN l_linenumber % 3 = 0 THEN '' ELSE 'https://a.example/' || (l_partkey % 500) END AS file_link,
  CASE WHEN l_linenumber % 2 = 0 THEN '' ELSE 'https://a.example/' || (l_partkey % 500) || '.pdf' END AS pdf_link
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


def rankings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(qid, retriever, rank, doc): every 100th vector asks; 'vector' ranks by cosine, 'label' by how near the ids are."""
    from lexmill.operators import embeddings, lexical

    v = table(spark, sf_dir, "embeddings")
    asked = v.filter("vec_id % 100 = 0")
    near = embeddings.knn(asked, v, 20, "vec_id", "vec_id").select("qid", F.lit("vector").alias("retriever"), "rank", "doc")
    # the other ranking: the ids around the question's own, by distance
    around = asked.select(F.col("vec_id").alias("qid"), F.explode(F.sequence(F.col("vec_id") - 30, F.col("vec_id") + 30)).alias("doc"))
    pairs = around.join(v.select(F.col("vec_id").alias("doc")), "doc")
    by_id = lexical.rank(pairs.select("qid", "doc"), 20, -F.abs(F.col("qid") - F.col("doc"))).select("qid", F.lit("label").alias("retriever"), "rank", "doc")
    return near.unionByName(by_id)


RANKINGS = """sims AS (SELECT q.vec_id AS qid, d.vec_id AS doc, round(list_dot_product(CAST(q.embedding AS DOUBLE[]), CAST(d.embedding AS DOUBLE[]))
    / ((sqrt(list_dot_product(CAST(q.embedding AS DOUBLE[]), CAST(q.embedding AS DOUBLE[]))) + 1e-9) * (sqrt(list_dot_product(CAST(d.embedding AS DOUBLE[]), CAST(d.embedding AS DOUBLE[]))) + 1e-9)), 6) AS similarity, d.label
  FROM embeddings q JOIN embeddings d ON q.vec_id % 100 = 0),
nearest AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY similarity DESC, doc) AS rank FROM sims),
by_id AS (SELECT q.vec_id AS qid, d.vec_id AS doc, row_number() OVER (PARTITION BY q.vec_id ORDER BY abs(q.vec_id - d.vec_id), d.vec_id) AS rank
  FROM embeddings q JOIN embeddings d ON q.vec_id % 100 = 0 AND d.vec_id BETWEEN q.vec_id - 30 AND q.vec_id + 30),
rankings AS (SELECT qid, 'vector' AS retriever, rank, doc FROM nearest WHERE rank <= 20 UNION ALL SELECT qid, 'label', rank, doc FROM by_id WHERE rank <= 20),
relevant AS (SELECT DISTINCT r.qid, r.doc FROM rankings r JOIN embeddings q ON q.vec_id = r.qid JOIN embeddings d ON d.vec_id = r.doc WHERE q.label = d.label AND r.qid != r.doc)"""


def relevant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(qid, doc) of the ranked pairs with one label: judgments of a pool, as many as its rankings."""
    labels = table(spark, sf_dir, "embeddings").select("vec_id", "label")
    pool = rankings(spark, sf_dir).select("qid", "doc").filter("qid != doc").distinct()
    asked = pool.join(labels.withColumnsRenamed({"vec_id": "qid", "label": "asked"}), "qid")
    return asked.join(labels.withColumnRenamed("vec_id", "doc"), "doc").filter("label = asked").select("qid", "doc")


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = table(spark, sf_dir, "embeddings")
    return v.filter("vec_id % 100 = 0").select(F.col("vec_id").alias("qid"), F.when(F.col("label") % 2 == 0, "provisional").otherwise("final").alias("status"), F.col("label"))
