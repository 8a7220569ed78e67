"""Queries of the sources: trees of files, chunk lines, configurations, XML feeds and office files.

Each writes the files of its source from the given tables below the shared folder and reads them
back by the library's reader, or parses records that the tables give.
"""

from __future__ import annotations

import io
import uuid
import zipfile

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexmill.functions import frontmatter as fm
from lexmill.operators import chunking as ck
from lexmill.operators import quality
from lexmill.plans.inputs import table
from lexmill.sources import documents as src
from lexmill.sources import feeds, sinks


def _folder(spark: SparkSession, name: str) -> str:
    return f"{sinks.shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def _cat(*parts: str | Column) -> Column:
    """Names of columns as they are; texts in F.lit."""
    return F.concat(*(F.col(p).cast("string") if isinstance(p, str) else p.cast("string") for p in parts))


def _laws(spark: SparkSession, d: str, new: bool = False) -> DataFrame:
    """(path, raw): suppliers as statutes; new: every 5th has a new version key, every 7th is gone."""
    k, lit = F.col("s_suppkey"), F.lit
    version = F.when((k % 5 == 0) & lit(new), k + 1_000_000).otherwise(k)
    raw = _cat(
        lit("---\n제목: "), "s_name", lit("\n법령ID: '"), F.lpad(k.cast("string"), 6, "0"), lit("'\n법령MST: "), version, lit("\n법령구분: 법률\n소관부처:\n- "),
        F.when(k % 2 == 0, "보건복지부").otherwise("다른 부처"), lit("\n공포일자: 2026-01-02\n시행일자: 2026-07-09\n상태: 시행\n출처: x\n---\n##### 제1조 (목적)\n"), "s_nationkey", lit("\n"),
    )
    rows = table(spark, d, "supplier")
    return (rows.filter(k % 7 != 0) if new else rows).select(_cat(lit("law/n"), "s_nationkey", lit("/법 "), k, lit("+1.md")).alias("path"), raw.alias("raw"))


def s1_read_documents(spark, d) -> DataFrame:
    root = _folder(spark, "laws")
    sinks.write_tree(_laws(spark, d), root)
    docs = src.normalized(src.read_documents(spark, {"law": root}))
    return docs.select("kind", "stem", "doc_id", "doc_title", "version_key", "class", "ministry", "enforce_date", F.md5(F.col("body").cast("binary")).alias("body_md5"))


S1 = """SELECT 'law' AS kind, '법 ' || s_suppkey || '+1' AS stem, lpad(CAST(s_suppkey AS VARCHAR), 6, '0') AS doc_id, s_name AS doc_title, CAST(s_suppkey AS VARCHAR) AS version_key, 'Act' AS class,
CASE WHEN s_suppkey % 2 = 0 THEN 'MOHW' ELSE '다른 부처' END AS ministry, '2026-07-09' AS enforce_date, md5('##### 제1조 (목적)' || chr(10) || s_nationkey || chr(10)) AS body_md5 FROM supplier"""


def s2_read_annexes(spark, d) -> DataFrame:
    root, k, lit = _folder(spark, "annexes"), F.col("s_suppkey"), F.lit
    raw = _cat(lit('---\ntitle: "'), "s_name", lit('"\nparent_law: "law '), "s_nationkey", lit('"\ndelegating_articles: [제'), k % 9 + 1, lit("조제1항, 제"), k % 3 + 1, lit("조]\nparse_note: "), F.when(k % 4 == 0, "math_loss").otherwise("ok"), lit("\nsource_format: hwp\n---\n[별표 1]\n"), "s_nationkey")
    sinks.write_tree(table(spark, d, "supplier").select(_cat(lit("a"), k % 10, lit("/[별표] "), "s_name", lit(".md")).alias("path"), raw.alias("raw")), root)
    rows = src.read_annexes(spark, root)
    return rows.select("stem", "title", "parent_law", F.array_join("delegating_articles", ",").alias("articles"), "parse_note", "source_format", "body")


S2 = """SELECT '[별표] ' || s_name AS stem, s_name AS title, 'law ' || s_nationkey AS parent_law, '제' || (s_suppkey % 9 + 1) || '조' || CASE WHEN s_suppkey % 9 = s_suppkey % 3 THEN '' ELSE ',제' || (s_suppkey % 3 + 1) || '조' END AS articles,
CASE WHEN s_suppkey % 4 = 0 THEN 'math_loss' ELSE 'ok' END AS parse_note, 'hwp' AS source_format, '[별표 1]' || chr(10) || s_nationkey AS body FROM supplier"""


def _part_chunks(spark, d) -> DataFrame:
    lit, no = F.lit, F.array().cast("array<string>")
    rows = table(spark, d, "part").select(
        _cat(lit("annex "), "p_partkey").alias("stem"), F.col("p_name").alias("title"), _cat(lit("[별표 "), "p_size", lit("]\n"), "p_type").alias("body"), F.when(F.col("p_size") % 2 == 0, F.array(lit("제3조"))).otherwise(no).alias("delegating_articles"),
        lit("").alias("parse_note"), F.col("p_partkey").cast("string").alias("doc_id"), F.col("p_brand").alias("doc_title"), *(lit(c).alias(c) for c in ("version_key", "class", "ministry", "enforce_date", "promulgate_date", "status", "source")),
    )
    return ck.annex_chunks(rows)


def s3_s4_chunk_lines(spark, d) -> DataFrame:
    root = _folder(spark, "chunks")
    src.write_chunks(_part_chunks(spark, d), root)
    return src.read_chunks(spark, root).select("chunk_id", F.md5(F.col("content").cast("binary")).alias("content_md5"), "metadata.law_id", "metadata.article", F.size("metadata.delegating_articles").alias("n_articles"))


S3 = """SELECT p_partkey || '#별표' || p_size AS chunk_id, md5('「' || p_brand || '」 별표' || p_size || ' ' || p_name || chr(10) || chr(10) || '[별표 ' || p_size || ']' || chr(10) || p_type) AS content_md5, CAST(p_partkey AS VARCHAR) AS law_id,
CASE WHEN p_size % 2 = 0 THEN '제3조' ELSE '' END AS article, CAST(1 - p_size % 2 AS INTEGER) AS n_articles FROM part"""


def s5_watchlist(spark, d) -> DataFrame:
    """Regions as families and nations as their members, in a configuration; customers by their nation's tier."""
    names = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")).orderBy("n_nationkey").collect()
    lines, regions = [], sorted({(r["r_regionkey"], r["r_name"]) for r in names})
    for key, name in regions:
        lines += ["[[family]]", f'act = "{name}"', 'why = "w"', f'watch_articles = ["제{key + 1}조"]', *(['tier = "peripheral"'] if key % 2 else [])]
        for r in names:
            lines += ["[[family.members]]", f'name = "{r["n_name"]}"', 'type = "law"', f'law_id = "{r["n_nationkey"]}"'] if r["r_regionkey"] == key else []
    for r in names[::5]:
        lines += ["[[admrule]]", f'name = "rule {r["n_name"]}"', f'admrule_id = "{r["n_nationkey"]}"', 'kind = "고시"']
    config = feeds.parse_watchlist("\n".join(lines))
    members, rules = feeds.watchlist_members(spark, config), feeds.watchlist_rules(spark, config)
    rows = table(spark, d, "customer").join(F.broadcast(members.withColumn("c_nationkey", F.col("law_id").cast("int"))), "c_nationkey")
    watched = F.broadcast(rules.select(F.col("admrule_id").cast("int").alias("c_nationkey"), F.col("name").alias("rule")))
    return rows.join(watched, "c_nationkey", "left").groupBy("family", "name", "tier", F.array_join("watch", ",").alias("watch"), F.coalesce("rule", F.lit("")).alias("rule")).agg(F.count("*").alias("n_customers"))


S5 = """SELECT r_name AS family, n_name AS name, CASE WHEN r_regionkey % 2 = 1 THEN 'peripheral' ELSE 'core' END AS tier, '제' || (r_regionkey + 1) || '조' AS watch, CASE WHEN n_nationkey % 5 = 0 THEN 'rule ' || n_name ELSE '' END AS rule, count(*) AS n_customers
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ALL"""


def s6_corrections(spark, d) -> DataFrame:
    """An overlay with an entry for every third nation, applied to what their suppliers' names say."""
    root = _folder(spark, "corrections")
    rule = F.struct(F.lit("Supplier").alias("find"), F.lit("Vendor").alias("replace"), (F.col("n_nationkey") % 2 + 1).alias("expect"))
    entry = F.struct(F.lit("r").alias("reason"), F.lit("hwp").alias("source_format"), F.lit("2026-01-01").alias("date"), F.array(rule).alias("rules"))
    overlay = table(spark, d, "nation").filter("n_nationkey % 3 = 0").agg(F.map_from_entries(F.collect_list(F.struct("n_name", entry))).alias("corrections"))
    sinks.write_tree(overlay.select(F.lit("overlay.json").alias("path"), F.to_json(F.struct("corrections")).alias("raw")), root)
    names = table(spark, d, "supplier").join(table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", F.col("n_name").alias("stem"), F.col("s_name").alias("body"))
    out = quality.apply_corrections(names, feeds.read_corrections(spark, f"{root}/overlay.json"))
    return out.select("s_suppkey", "body", "correction")


S6 = """SELECT s_suppkey, CASE WHEN s_nationkey % 3 = 0 AND s_nationkey % 2 = 0 THEN replace(s_name, 'Supplier', 'Vendor') ELSE s_name END AS body,
CASE WHEN s_nationkey % 3 != 0 THEN '' WHEN s_nationkey % 2 = 0 THEN 'corrected' ELSE 'correction_stale' END AS correction FROM supplier"""


def _tag(name: str, c: Column | str) -> Column:
    return _cat(F.lit(f"<{name}>"), c, F.lit(f"</{name}>"))


def s7_version_feed(spark, d) -> DataFrame:
    root = _folder(spark, "feed")
    o = table(spark, d, "orders")
    xml = _cat(F.lit("<law>"), _tag("법령ID", F.lpad(F.col("o_custkey").cast("string"), 6, "0")), _tag("법령일련번호", "o_orderkey"), _tag("공포일자", F.date_format("o_orderdate", "yyyyMMdd")), _tag("현행연혁코드", "o_orderstatus"), F.when(F.col("o_orderkey") % 2 == 0, _tag("제개정구분명", _cat(F.lit(" "), "o_orderpriority", F.lit(" ")))).otherwise(""), _tag("법령명한글", _cat(F.lit("law &amp; "), "o_custkey")), F.lit("</law>"))
    # pages of 100 and of 3900 order keys in turn, which Spark reads in another order than the feed's
    page = 2 * F.floor(F.col("o_orderkey") / 4000) + F.when(F.col("o_orderkey") % 4000 < 100, 0).otherwise(1)
    some = o.groupBy(page.alias("page")).agg(F.array_sort(F.collect_list(F.struct("o_orderkey", xml.alias("xml")))).alias("laws"))
    laws = F.array_join(F.transform("laws", lambda x: x["xml"]), "")
    sinks.write_tree(some.select(_cat(F.lit("feed"), "page", F.lit(".xml")).alias("path"), _tag("LawSearch", laws).alias("raw")), root)
    feed = feeds.read_version_feed(spark, root).withColumn("seq", F.row_number().over(Window.partitionBy("law_id").orderBy("seq")))
    return feed.select("law_id", "mst", "promulgate_date", "status", "revision_class", "name", "short_name", "seq")


S7 = """SELECT lpad(CAST(o_custkey AS VARCHAR), 6, '0') AS law_id, CAST(o_orderkey AS VARCHAR) AS mst, strftime(o_orderdate, '%Y%m%d') AS promulgate_date, o_orderstatus AS status,
CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority ELSE '' END AS revision_class, 'law & ' || o_custkey AS name, '' AS short_name, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS INTEGER) AS seq FROM orders"""


def s8_rules_xml(spark, d) -> DataFrame:
    o, k = table(spark, d, "orders"), F.col("o_orderkey")
    info = _tag("행정규칙기본정보", _cat(_tag("행정규칙명", _cat(F.lit(" rule "), k, F.lit(" "))), _tag("행정규칙종류", F.lit("고시")), _tag("발령일자", F.date_format("o_orderdate", "yyyyMMdd")), _tag("행정규칙일련번호", k), _tag("현행여부", F.when(k % 3 == 0, "N").otherwise("Y"))))
    xml = _cat(F.lit("<r>"), info, _tag("조문내용", _cat(F.lit("제1조 "), "o_orderstatus")), _tag("조문내용", F.lit(" ")), _tag("조문내용", _cat(F.lit("제2조 "), "o_custkey")), F.when(k % 2 == 0, _tag("부칙", _tag("부칙내용", F.lit("시행")))).otherwise(""), F.lit("</r>"))
    return feeds.rules_from_xml(o.select(xml.alias("xml"))).select("doc_title", "class", "promulgate_date", "enforce_date", "version_key", "current", "body")


S8 = """SELECT 'rule ' || o_orderkey AS doc_title, '고시' AS class, strftime(o_orderdate, '%Y%m%d') AS promulgate_date, '' AS enforce_date, CAST(o_orderkey AS VARCHAR) AS version_key, CASE WHEN o_orderkey % 3 = 0 THEN 'N' ELSE 'Y' END AS current,
'제1조 ' || o_orderstatus || chr(10) || chr(10) || '제2조 ' || o_custkey || CASE WHEN o_orderkey % 2 = 0 THEN chr(10) || chr(10) || '## 부칙' || chr(10) || chr(10) || '시행' ELSE '' END AS body FROM orders"""


def s9_old_new(spark, d) -> DataFrame:
    o, k = table(spark, d, "orders"), F.col("o_orderkey")
    infos = _cat(_tag("구조문_기본정보", _tag("법령일련번호", k)), _tag("신조문_기본정보", _tag("법령일련번호", k + 1)))
    lists = _cat(_tag("구조문목록", _cat(_tag("조문", _cat(F.lit("제1조 "), "o_orderstatus")), F.when(k % 2 == 0, _tag("조문", "o_custkey")).otherwise(""))), _tag("신조문목록", _tag("조문", _cat(F.lit("제1조 "), "o_custkey"))))
    fragments, sides = feeds.read_old_new(o.select(k.alias("mst"), _cat(F.lit("<r>"), infos, lists, F.lit("</r>")).alias("xml")))
    return fragments.join(sides.select("mst", "side", "side_mst"), ["mst", "side"]).select("mst", "side", "seq", "text", "side_mst")


S9 = """SELECT o_orderkey AS mst, 'old' AS side, CAST(0 AS INTEGER) AS seq, '제1조 ' || o_orderstatus AS text, CAST(o_orderkey AS VARCHAR) AS side_mst FROM orders
UNION ALL SELECT o_orderkey, 'old', CAST(1 AS INTEGER), CAST(o_custkey AS VARCHAR), CAST(o_orderkey AS VARCHAR) FROM orders WHERE o_orderkey % 2 = 0
UNION ALL SELECT o_orderkey, 'new', CAST(0 AS INTEGER), '제1조 ' || o_custkey, CAST(o_orderkey + 1 AS VARCHAR) FROM orders"""


def s9_three_way(spark, d) -> DataFrame:
    o, k = table(spark, d, "orders"), F.col("o_orderkey")
    base = lambda n: _tag("법률조문", _cat(_tag("조번호", F.lpad((k % 90 + n).cast("string"), 4, "0")), F.when(k % 3 == 0, _tag("조가지번호", F.lit("02"))).otherwise(""), _tag("시행령조문목록", _cat(_tag("시행령조문", "o_custkey"), _tag("시행령조문", "o_orderstatus"))), F.when(k % 2 == 0, _tag("시행규칙조문목록", _tag("시행규칙조문", "o_orderpriority"))).otherwise("")))
    xml = _cat(F.lit("<r>"), _tag("삼단비교", _cat(base(1), base(2))), F.lit("</r>"))
    return feeds.read_three_way(o.select(k.alias("mst"), xml.alias("xml"))).select("mst", "article_no", "branch", "layer", "seq", "text")


S9_THREE = """WITH a AS (SELECT o_orderkey AS mst, lpad(CAST(o_orderkey % 90 + n AS VARCHAR), 4, '0') AS article_no, CASE WHEN o_orderkey % 3 = 0 THEN '02' ELSE '00' END AS branch, o_custkey, o_orderstatus, o_orderpriority FROM orders, (VALUES (1), (2)) v(n))
SELECT mst, article_no, branch, '시행령' AS layer, CAST(0 AS INTEGER) AS seq, CAST(o_custkey AS VARCHAR) AS text FROM a UNION ALL SELECT mst, article_no, branch, '시행령', CAST(1 AS INTEGER), o_orderstatus FROM a
UNION ALL SELECT mst, article_no, branch, '시행규칙', CAST(0 AS INTEGER), o_orderpriority FROM a WHERE mst % 2 = 0"""


def s11_snapshots(spark, d) -> DataFrame:
    """Two states of a tree whose folder's name recurs inside it, joined by their relative paths."""
    root = _folder(spark, "law")
    for state in ("old", "new"):
        sinks.write_tree(_laws(spark, d, new=state == "new"), f"{root}/{state}/law")
    old, new = src.read_snapshots(spark, {"law": f"{root}/old/law"}, {"law": f"{root}/new/law"})
    both = old.select("kind", "path", F.col("version_key").alias("old_version")).join(new.select("kind", "path", F.col("version_key").alias("new_version")), ["kind", "path"], "full_outer")
    return both.select("kind", "path", F.coalesce("old_version", F.lit("")).alias("old_version"), F.coalesce("new_version", F.lit("")).alias("new_version"))


S11 = """SELECT 'law' AS kind, 'law/n' || s_nationkey || '/법 ' || s_suppkey || '+1.md' AS path, CAST(s_suppkey AS VARCHAR) AS old_version,
CASE WHEN s_suppkey % 7 = 0 THEN '' ELSE CAST(s_suppkey + CASE WHEN s_suppkey % 5 = 0 THEN 1000000 ELSE 0 END AS VARCHAR) END AS new_version FROM supplier"""


def p6_code_maps(spark, d) -> DataFrame:
    c = table(spark, d, "customer")
    name = F.when(F.col("c_custkey") % 3 == 0, "보건복지부").when(F.col("c_custkey") % 3 == 1, F.col("c_mktsegment"))
    return c.select("c_custkey", F.coalesce(fm.map_codes(name, fm.MINISTRIES), F.lit("none")).alias("ministry"), fm.map_codes("c_mktsegment", {"BUILDING": "B"}).alias("segment"))


P6 = """SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN 'MOHW' WHEN 1 THEN c_mktsegment ELSE 'none' END AS ministry, CASE WHEN c_mktsegment = 'BUILDING' THEN 'B' ELSE c_mktsegment END AS segment FROM customer"""


def q8_office_sections(spark, d) -> DataFrame:
    """Suppliers as zipped XML documents of a paragraph and a table; every 9th is damaged."""

    def zipped(batches):
        for batch in batches:
            files = []
            for key, name, nation in zip(*(c.to_pylist() for c in batch.columns)):
                out = io.BytesIO()
                with zipfile.ZipFile(out, "w") as z:
                    z.writestr("Contents/section1.xml", "<s:sec xmlns:s='u'><s:p><s:t>second</s:t></s:p></s:sec>")
                    z.writestr("Contents/section0.xml", f"<sec><p><run><t>{name}</t></run></p><p><tbl><tr><tc><cellSpan colSpan='2' rowSpan='1'/><subList><p><t>{nation}</t></p></subList></tc></tr></tbl></p></sec>")
                files.append(out.getvalue() if key % 9 else out.getvalue()[:50])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(files, pa.binary())], names=["s_suppkey", "content"])

    files = table(spark, d, "supplier").select("s_suppkey", "s_name", "s_nationkey").mapInArrow(zipped, "s_suppkey long, content binary")
    return files.select("s_suppkey", quality.parse_ooxml_sections("content").alias("p")).select("s_suppkey", "p.body", F.col("p.error").isNotNull().alias("failed"))


Q8 = """SELECT s_suppkey, CASE WHEN s_suppkey % 9 = 0 THEN '' ELSE s_name || chr(10) || chr(10) || '<table>' || chr(10) || '<tr>' || chr(10) || '<td colspan="2">' || s_nationkey || '</td>' || chr(10) || '</tr>' || chr(10) || '</table>' || chr(10) || chr(10) || 'second' END AS body, s_suppkey % 9 = 0 AS failed FROM supplier"""

QUERIES = {f.__name__: f for f in (s1_read_documents, s2_read_annexes, s3_s4_chunk_lines, s5_watchlist, s6_corrections, s7_version_feed, s8_rules_xml, s9_old_new, s9_three_way, s11_snapshots, p6_code_maps, q8_office_sections)}
ORACLES = {"s1_read_documents": S1, "s2_read_annexes": S2, "s3_s4_chunk_lines": S3, "s5_watchlist": S5, "s6_corrections": S6, "s7_version_feed": S7, "s8_rules_xml": S8, "s9_old_new": S9, "s9_three_way": S9_THREE, "s11_snapshots": S11, "p6_code_maps": P6, "q8_office_sections": Q8}
