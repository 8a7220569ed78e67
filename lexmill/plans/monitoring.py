"""Queries of version feeds, watchlists, collection plans, reconciliation, history, quality and answers."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.functions import text
from lexmill.operators import audit, embeddings, evaluation, guards, history, monitor, quality, reconcile
from lexmill.operators.keyed_table import KeyedTable
from lexmill.plans.inputs import FEED, MANIFEST, WATCHLIST, manifest, table, version_feed, watchlist
from lexmill.sources import sinks

# --- feed and watchlist -----------------------------------------------------------------------------


def j17_latest_version(spark, d) -> DataFrame:
    return monitor.latest_version(version_feed(spark, d)).select("law_id", "mst", "promulgate_date")


_LATEST = "latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY law_id ORDER BY promulgate_date DESC, seq) AS n FROM feed) WHERE n = 1)"
J17 = f"WITH {FEED}, {_LATEST} SELECT law_id, mst, promulgate_date FROM latest"


def j16_j18_freshness(spark, d) -> DataFrame:
    """Ours: the first version of each customer, the last for every 3rd; every 40th has no file, every 41st a version that the feed lacks."""
    o = table(spark, d, "orders")
    pick = lambda f: f(F.struct("o_orderdate", "o_orderkey"))
    k = F.col("o_custkey")
    ours = o.groupBy("o_custkey").agg(pick(F.min).alias("a"), pick(F.max).alias("b")).filter(k % 40 != 0)
    mine = F.when(k % 3 == 0, F.col("b")).otherwise(F.col("a"))
    ours = ours.select(F.concat(F.lit("law "), k.cast("string")).alias("name"), F.when(k % 41 == 0, "unknown").otherwise(mine["o_orderkey"].cast("string")).alias("version_key"), F.when(k % 41 == 0, "2100-01-01").otherwise(F.date_format(mine["o_orderdate"], "yyyy-MM-dd")).alias("promulgate_date"))
    return monitor.freshness(watchlist(spark, d), ours, version_feed(spark, d))


J16 = f"""WITH {FEED}, {WATCHLIST}, {_LATEST},
firsts AS (SELECT o_custkey, min({{'d': o_orderdate, 'k': o_orderkey}}) AS a, max({{'d': o_orderdate, 'k': o_orderkey}}) AS b FROM orders WHERE o_custkey % 40 != 0 GROUP BY o_custkey),
ours AS (SELECT 'law ' || o_custkey AS name, CASE WHEN o_custkey % 41 = 0 THEN 'unknown' ELSE CAST(CASE WHEN o_custkey % 3 = 0 THEN b.k ELSE a.k END AS VARCHAR) END AS version_key,
  CASE WHEN o_custkey % 41 = 0 THEN '21000101' ELSE strftime(CASE WHEN o_custkey % 3 = 0 THEN b.d ELSE a.d END, '%Y%m%d') END AS own FROM firsts)
SELECT w.name, w.law_id, w.tier, CASE WHEN w.law_id = '' THEN 'NO_ID' WHEN o.version_key IS NULL THEN 'NO_FILE' WHEN l.mst IS NULL THEN 'LOOKUP_FAILED' WHEN l.mst = o.version_key THEN 'SYNC'
  WHEN l.promulgate_date > o.own THEN CASE WHEN tier = 'core' THEN 'STALE(' || l.status || ')' ELSE 'REVIEW: ' || w.hints END
  WHEN o.version_key IN (SELECT mst FROM feed) THEN 'SYNC_PENDING' ELSE 'MISSING' END AS verdict
FROM watchlist w LEFT JOIN ours o ON w.name = o.name LEFT JOIN latest l ON l.law_id = lpad(w.law_id, 6, '0')"""


def j19_review_changed(spark, d) -> DataFrame:
    changed = table(spark, d, "lineitem").join(table(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey")).select(F.concat(F.lit("law "), F.col("o_custkey").cast("string")).alias("name"), F.when(F.col("l_partkey") % 50 == 0, "피폭 기준").otherwise("기타").alias("text"))
    return monitor.review_changed(changed, watchlist(spark, d))


J19 = f"""WITH {WATCHLIST} SELECT 'law ' || o_custkey AS name, CASE WHEN bool_or(l_partkey % 50 = 0) THEN 'REVIEW' ELSE 'SILENT' END AS verdict FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN watchlist w ON w.name = 'law ' || o_custkey AND tier != 'core' GROUP BY o_custkey"""


def j20_pair_check(spark, d) -> DataFrame:
    k = table(spark, d, "part").select(F.col("p_partkey"), F.concat(F.lit("stem "), F.col("p_partkey").cast("string")).alias("stem"))
    return monitor.pair_check(k.filter("p_partkey % 5 != 0"), k.filter("p_partkey % 7 != 0"))


J20 = "SELECT 'stem ' || p_partkey AS stem, CASE WHEN p_partkey % 5 = 0 THEN 'orphaned' ELSE 'unparsed' END AS problem FROM part WHERE (p_partkey % 5 = 0) != (p_partkey % 7 = 0)"


def j21_collection_plan(spark, d) -> DataFrame:
    return monitor.collection_plan(manifest(spark, d), watchlist(spark, d))


_GATED = f"""{MANIFEST}, {WATCHLIST}, gated AS (SELECT m.*, is_rule OR tier = 'core' OR regexp_matches(title, '{monitor.TOPIC}') AS wanted FROM manifest m LEFT JOIN watchlist w ON w.name = m.parent WHERE file_link != '' OR pdf_link != '')"""
J21 = f"""WITH {_GATED}, links AS (SELECT *, file_link AS url, 'original' AS type, 0 AS rank FROM gated WHERE wanted UNION ALL SELECT *, pdf_link, 'pdf', 1 FROM gated WHERE wanted),
n AS (SELECT *, row_number() OVER (PARTITION BY url ORDER BY is_rule, parent, pos, rank) AS n FROM links WHERE url != '')
SELECT url, type, '[' || kind || '] ' || title || '(' || parent || ')' AS base, parent, title FROM n WHERE n = 1"""


def j21_skipped(spark, d) -> DataFrame:
    return monitor.skipped_count(manifest(spark, d), watchlist(spark, d))


J21_SKIPPED = f"WITH {_GATED} SELECT count(*) FILTER (NOT coalesce(wanted, false)) AS n_skipped FROM gated"


def _disk(spark, d) -> DataFrame:
    m = manifest(spark, d).select("pos", F.concat(F.lit("["), "kind", F.lit("] "), "title", F.lit("("), "parent", F.lit(")")).alias("base")).filter("pos % 3 = 0")
    return m.select(F.concat("base", F.when(F.col("pos") % 2 == 0, ".hwp").otherwise(".pdf")).alias("file")).distinct()


def j22_forms_registry(spark, d) -> DataFrame:
    return monitor.forms_registry(manifest(spark, d), watchlist(spark, d), _disk(spark, d))


J22 = f"""WITH {_GATED}, n AS (SELECT *, row_number() OVER (PARTITION BY CASE WHEN file_link != '' THEN file_link ELSE pdf_link END ORDER BY is_rule, parent, pos) AS n FROM gated WHERE wanted AND kind != '별표'),
disk AS (SELECT DISTINCT '[' || kind || '] ' || title || '(' || parent || ')' AS base, pos % 2 = 0 AS hwp FROM manifest WHERE pos % 3 = 0),
r AS (SELECT *, '[' || kind || '] ' || title || '(' || parent || ')' AS base FROM n WHERE n = 1)
SELECT parent, kind, CAST(CAST(no AS INT) AS VARCHAR) || CASE WHEN branch = '00' THEN '' ELSE '의' || CAST(branch AS INT) END AS num, title, regexp_extract(title, '제\\d+조') AS articles, file_link AS orig_url, pdf_link AS pdf_url,
  CASE WHEN EXISTS (SELECT 1 FROM disk WHERE disk.base = r.base AND hwp) THEN base || '.hwp' ELSE '' END AS orig_file, CASE WHEN EXISTS (SELECT 1 FROM disk WHERE disk.base = r.base AND NOT hwp) THEN base || '.pdf' ELSE '' END AS pdf_file FROM r"""


def s13_forms_markdown(spark, d) -> DataFrame:
    return sinks.forms_registry_markdown(j22_forms_registry(spark, d))


S13 = f"""WITH r AS ({J22}), l AS (SELECT parent, kind, num, '| ' || kind || ' | ' || num || ' | ' || title || ' | ' || articles || ' | ' || CASE WHEN orig_url = '' THEN '' ELSE '[원본](' || orig_url || ')' END || ' | ' || CASE WHEN pdf_url = '' THEN '' ELSE '[PDF](' || pdf_url || ')' END || ' |' AS line FROM r)
SELECT parent, '## ' || parent || chr(10) || chr(10) || '| 구분 | 번호 | 제목 | 근거조 | 원본 | PDF |' || chr(10) || '|---|---|---|---|---|---|' || chr(10) || string_agg(line, chr(10) ORDER BY kind, num, line) AS markdown FROM l GROUP BY parent"""


def v9_name_collisions(spark, d) -> DataFrame:
    return guards.name_collisions(monitor.collection_plan(manifest(spark, d), watchlist(spark, d)))


V9 = f"""{J21.split("SELECT url, type")[0]} SELECT base, type, n_urls FROM (SELECT '[' || kind || '] ' || title || '(' || parent || ')' AS base, type, count(DISTINCT url) AS n_urls FROM n WHERE n = 1 GROUP BY ALL) WHERE n_urls > 1"""


def j23_fetch_list(spark, d) -> DataFrame:
    return monitor.fetch_list(watchlist(spark, d))


J23 = f"WITH {WATCHLIST} SELECT name, law_id FROM watchlist WHERE tier = 'core'"


def j24_select_versions(spark, d) -> DataFrame:
    return monitor.select_versions(version_feed(spark, d), name="law 1", promulgated=("19930101", "19961231"), ministry="ministry 3", revision="1-URGENT").select("law_id", "mst", "promulgate_date")


J24 = f"WITH {FEED} SELECT law_id, mst, promulgate_date FROM feed WHERE contains(name, 'law 1') AND promulgate_date BETWEEN '19930101' AND '19961231' AND ministry_name = 'ministry 3' AND revision_class = '1-URGENT'"


def j25_select_rules(spark, d) -> DataFrame:
    s = table(spark, d, "part")
    feed = s.select(F.when(F.col("p_size") % 4 == 0, monitor.GATED_MINISTRY).when(F.col("p_size") % 4 == 1, "질병관리청").otherwise("기타").alias("ministry"), F.concat("p_brand", F.when(F.col("p_size") % 3 == 0, " 의료").otherwise("")).alias("name"), F.col("p_partkey").cast("string").alias("serial"), F.col("p_partkey").alias("seq"))
    return monitor.select_rules(feed)


J25 = """WITH f AS (SELECT CASE p_size % 4 WHEN 0 THEN 'g' WHEN 1 THEN 'k' ELSE 'x' END AS ministry, p_brand || CASE WHEN p_size % 3 = 0 THEN ' 의료' ELSE '' END AS name, p_partkey FROM part)
SELECT name, CAST(max(p_partkey) AS VARCHAR) AS serial FROM f WHERE ministry = 'k' OR (ministry = 'g' AND name LIKE '%의료') GROUP BY name"""


def j26_prefer_source(spark, d) -> DataFrame:
    li = table(spark, d, "lineitem")
    files = li.select(F.concat(F.lit("f"), F.col("l_orderkey").cast("string"), F.when(F.col("l_partkey") % 3 == 0, ".hwpx").when(F.col("l_partkey") % 3 == 1, ".hwp").otherwise(".pdf")).alias("file")).distinct()
    return monitor.prefer_source(files)


J26 = "SELECT 'f' || l_orderkey AS stem, 'f' || l_orderkey || CASE WHEN bool_or(l_partkey % 3 = 0) THEN '.hwpx' ELSE '.hwp' END AS file FROM lineitem WHERE l_partkey % 3 < 2 GROUP BY l_orderkey"

# --- reconciliation ---------------------------------------------------------------------------------


def j9_last_version_change(spark, d) -> DataFrame:
    r = version_feed(spark, d).select(F.col("law_id").alias("path"), "seq", F.col("mst").alias("rev"), F.col("status").alias("version"))
    return reconcile.last_version_change(r, limit=10)


J9 = f"""WITH {FEED}, r AS (SELECT *, row_number() OVER (PARTITION BY law_id ORDER BY seq DESC) AS n FROM feed), p AS (SELECT *, lead(mst) OVER w AS old_rev, lead(status) OVER w AS old_version FROM r WHERE n <= 10 WINDOW w AS (PARTITION BY law_id ORDER BY seq DESC))
SELECT law_id AS path, arg_max(old_rev, seq) AS old_rev, arg_max(mst, seq) AS new_rev FROM p WHERE old_rev IS NOT NULL AND status != old_version GROUP BY law_id"""


def _sets(spark, d) -> tuple[DataFrame, DataFrame]:
    a = F.concat(F.lit("제"), (F.col("l_partkey") % 20 + 1).cast("string"), F.lit("조")).alias("article")
    li = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("mst"), a, "l_partkey")
    return li.filter("l_partkey % 3 != 0"), li.filter("l_partkey % 5 != 0")


def j10_reconcile(spark, d) -> DataFrame:
    return reconcile.reconcile(*_sets(spark, d), ["mst"])


J10 = """WITH s AS (SELECT l_orderkey AS mst, '제' || (l_partkey % 20 + 1) || '조' AS article, bool_or(l_partkey % 3 != 0) AS ours, bool_or(l_partkey % 5 != 0) AS theirs FROM lineitem GROUP BY ALL)
SELECT mst, article, CASE WHEN ours AND theirs THEN 'AGREE' WHEN ours THEN 'SELF_ONLY' ELSE 'API_ONLY' END AS verdict FROM s WHERE ours OR theirs"""


def j10_totals(spark, d) -> DataFrame:
    return reconcile.reconcile_totals(j10_reconcile(spark, d))


J10_TOTALS = f"SELECT verdict, count(*) AS n FROM ({J10}) GROUP BY verdict"


def j11_pair_match(spark, d) -> DataFrame:
    o = table(spark, d, "orders")
    ours = o.select(F.col("o_orderkey").alias("mst"), (F.col("o_orderkey") - 1).cast("string").alias("old_version"))
    theirs = o.select(F.col("o_orderkey").alias("mst"), F.when(F.col("o_orderkey") % 9 == 0, "skipped").otherwise((F.col("o_orderkey") - 1).cast("string")).alias("old_version"))
    return reconcile.pair_match(ours, theirs, ["mst"])


J11 = "SELECT o_orderkey AS mst, o_orderkey % 9 != 0 AS pair_match FROM orders"


def j12_impact(spark, d) -> DataFrame:
    changed = _sets(spark, d)[0]
    edges = table(spark, d, "lineitem").filter("l_partkey % 4 = 0").select(F.col("l_orderkey").alias("mst"), F.concat(F.lit("제"), (F.col("l_partkey") % 20 + 1).cast("string"), F.lit("조")).alias("article"), F.col("l_linestatus").alias("layer"), F.concat(F.lit("제"), F.col("l_suppkey").cast("string"), F.lit("조")).alias("linked"))
    return reconcile.impact(changed, edges, ["mst"]).select("mst", "article", F.coalesce("layer", F.lit("")).alias("layer"), F.array_join("linked", ",").alias("linked"))


J12 = """WITH c AS (SELECT DISTINCT l_orderkey AS mst, '제' || (l_partkey % 20 + 1) || '조' AS article FROM lineitem WHERE l_partkey % 3 != 0),
e AS (SELECT DISTINCT l_orderkey AS mst, '제' || (l_partkey % 20 + 1) || '조' AS article, l_linestatus AS layer, l_suppkey AS n FROM lineitem WHERE l_partkey % 4 = 0)
SELECT mst, article, coalesce(layer, '') AS layer, coalesce(string_agg('제' || n || '조', ',' ORDER BY n), '') AS linked FROM c LEFT JOIN e USING (mst, article) GROUP BY mst, article, layer"""


def _fragments(spark, d) -> DataFrame:
    e = table(spark, d, "events")
    heading = F.concat(F.lit("<P>제"), (F.col("event_id") % 9 + 1).cast("string"), F.lit("조(title)</P> "))
    return e.select((F.col("user_id")).alias("mst"), F.when(F.col("event_id") % 2 == 0, "old").otherwise("new").alias("side"), F.col("event_id").alias("seq"), F.when(F.col("event_type") == "signup", F.concat(heading, "event_type")).otherwise(F.col("event_type")).alias("text"))


_FRAGMENTS = """f AS (SELECT user_id AS mst, CASE WHEN event_id % 2 = 0 THEN 'old' ELSE 'new' END AS side, event_id AS seq, CASE WHEN event_type = 'signup' THEN '<P>제' || (event_id % 9 + 1) || '조(title)</P> ' || event_type ELSE event_type END AS text,
  CASE WHEN event_type = 'signup' THEN '제' || (event_id % 9 + 1) || '조' END AS head FROM events),
g AS (SELECT * FROM (SELECT *, last_value(head IGNORE NULLS) OVER (PARTITION BY mst, side ORDER BY seq ROWS UNBOUNDED PRECEDING) AS article FROM f) WHERE article IS NOT NULL)"""


def j13_group_fragments(spark, d) -> DataFrame:
    return reconcile.group_fragments(_fragments(spark, d), ["mst", "side"])


J13 = f"WITH {_FRAGMENTS} SELECT mst, side, article, seq, text FROM g"


def j14_align(spark, d) -> DataFrame:
    out = reconcile.align_old_new(reconcile.group_fragments(_fragments(spark, d), ["mst", "side"]), ["mst"])
    return out.select("mst", "article", F.array_join("old", "|").alias("old"), F.array_join("new", "|").alias("new"))


J14 = f"WITH {_FRAGMENTS} SELECT mst, article, coalesce(string_agg(text, '|' ORDER BY seq) FILTER (side = 'old'), '') AS old, coalesce(string_agg(text, '|' ORDER BY seq) FILTER (side = 'new'), '') AS new FROM g GROUP BY mst, article"


def j15_three_way(spark, d) -> DataFrame:
    li = table(spark, d, "lineitem")
    links = li.select(F.col("l_orderkey").alias("mst"), F.lpad((F.col("l_partkey") % 200).cast("string"), 4, "0").alias("article_no"), F.lit("00").alias("branch"), F.col("l_linestatus").alias("layer"), F.concat(F.lit("013200제"), F.col("l_suppkey").cast("string"), F.lit("조의"), F.col("l_linenumber").cast("string"), F.lit("(건강)")).alias("text"))
    return reconcile.three_way_edges(links, ["mst"])


J15 = "SELECT DISTINCT l_orderkey AS mst, '제' || (l_partkey % 200) || '조' AS article, l_linestatus AS layer, '제' || l_suppkey || '조의' || l_linenumber AS linked FROM lineitem"

# --- history ------------------------------------------------------------------------------------------


def h1_markers(spark, d) -> DataFrame:
    day = F.date_format("o_orderdate", "yyyy.M.d")
    t = F.concat(F.lit("본문 <"), F.when(F.col("o_orderkey") % 3 == 0, "신설").otherwise("개정"), F.lit(" "), day, F.lit(", 2026.7.9>"))
    out = history.change_markers(table(spark, d, "orders").select(t.alias("text")))
    return out.select("kind", F.date_format("date", "yyyy-MM-dd").alias("date"), "n")


H1 = """WITH m AS (SELECT CASE WHEN o_orderkey % 3 = 0 THEN 'inserted' ELSE 'amended' END AS kind, unnest([strftime(o_orderdate, '%Y-%m-%d'), '2026-07-09']) AS date FROM orders) SELECT kind, date, count(*) AS n FROM m GROUP BY ALL"""


def h2_addenda_history(spark, d) -> DataFrame:
    o = table(spark, d, "orders")
    blocks = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("o_orderkey", "o_orderdate"))), lambda x: F.concat(F.lit("부칙 <제"), x["o_orderkey"].cast("string"), F.lit("호,"), F.date_format(x["o_orderdate"], "yyyy.M.d"), F.lit(">"))), "\n")
    out = history.addenda_history(o.groupBy(F.col("o_custkey").alias("stem")).agg(blocks.alias("body")))
    return out.select("stem", "pos", "number", F.date_format("date", "yyyy-MM-dd").alias("date"), "current")


H2 = """WITH b AS (SELECT o_custkey AS stem, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS pos, CAST(o_orderkey AS VARCHAR) AS number, strftime(o_orderdate, '%Y-%m-%d') AS date FROM orders)
SELECT stem, CAST(pos AS INTEGER) AS pos, number, date, row_number() OVER (PARTITION BY stem ORDER BY date DESC, pos DESC) = 1 AS current FROM b"""


def h3_revision_profile(spark, d) -> DataFrame:
    return history.revision_profile(version_feed(spark, d), top=("1-URGENT",), low=("5-LOW",))


H3 = "SELECT o_orderpriority AS revision_class, count(*) AS n, CASE o_orderpriority WHEN '1-URGENT' THEN 'top' WHEN '5-LOW' THEN 'low' ELSE 'normal' END AS priority FROM orders GROUP BY o_orderpriority"


def h4_lifecycle(spark, d) -> DataFrame:
    return history.lifecycle(version_feed(spark, d), "19960601").select("law_id", "mst", "stage")


H4 = f"WITH {FEED} SELECT law_id, mst, CASE WHEN enforce_date > '19960601' THEN 'pending' WHEN row_number() OVER (PARTITION BY law_id, enforce_date <= '19960601' ORDER BY enforce_date DESC, seq DESC) = 1 THEN 'current' ELSE 'past' END AS stage FROM feed"


def h5_untrusted(spark, d) -> DataFrame:
    diff = version_feed(spark, d).select(F.col("mst").alias("version_key"))
    return history.flag_untrusted(diff, version_feed(spark, d), full="1-URGENT").select("version_key", "trusted")


H5 = "SELECT CAST(o_orderkey AS VARCHAR) AS version_key, o_orderpriority != '1-URGENT' AS trusted FROM orders"


def h6_noise_ratio(spark, d) -> DataFrame:
    return history.noise_ratio(version_feed(spark, d).select(F.col("law_id").alias("path"), "seq", F.col("status").alias("version")))


H6 = f"WITH {FEED}, p AS (SELECT status, lag(status) OVER w AS old, lag(seq) OVER w AS before FROM feed WINDOW w AS (PARTITION BY law_id ORDER BY seq)) SELECT count(*) AS n_changes, count(*) FILTER (status != old) AS n_amendments FROM p WHERE before IS NOT NULL"


def h7_branches(spark, d) -> DataFrame:
    return history.branch_profile(manifest(spark, d))


H7 = f"WITH {MANIFEST} SELECT parent, count(*) AS n_items, count(*) FILTER (branch != '00') AS n_branches FROM manifest GROUP BY parent"

# --- quality ------------------------------------------------------------------------------------------


def q1_corrections(spark, d) -> DataFrame:
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("stem"), F.concat(F.lit("A1 "), F.coalesce("text", F.lit("")), F.when(F.col("doc_id") % 2 == 0, " A1").otherwise("")).alias("body"))
    rule = F.struct(F.lit("A1").alias("find"), F.lit("B2").alias("replace"), F.lit(2).alias("expect"))
    rules = docs.filter("stem % 3 != 0").select("stem", F.array(rule).alias("rules"))
    out = quality.apply_corrections(docs, rules)
    return out.select("stem", "correction", F.md5(F.col("body").cast("binary")).alias("body_md5"))


Q1 = """WITH b AS (SELECT doc_id AS stem, 'A1 ' || coalesce(text, '') || CASE WHEN doc_id % 2 = 0 THEN ' A1' ELSE '' END AS body FROM documents), c AS (SELECT *, (length(body) - length(replace(body, 'A1', ''))) / 2 AS n FROM b)
SELECT stem, CASE WHEN stem % 3 = 0 THEN '' WHEN n = 2 THEN 'corrected' ELSE 'correction_stale' END AS correction, md5(CASE WHEN stem % 3 != 0 AND n = 2 THEN replace(body, 'A1', 'B2') ELSE body END) AS body_md5 FROM c"""


def v8_stale_corrections(spark, d) -> DataFrame:
    return guards.stale_corrections(q1_corrections(spark, d))


V8 = f"SELECT stem FROM ({Q1}) WHERE correction = 'correction_stale'"


def q2_text_len(spark, d) -> DataFrame:
    return table(spark, d, "pages").select("page_id", text.text_len("html").alias("n"))


Q2 = r"SELECT page_id, CAST(length(regexp_replace(regexp_replace(regexp_replace(html, '<[^>]+>', '', 'g'), '[#*|\\_-]', '', 'g'), '[\s\p{Z}]+', '', 'g')) AS INTEGER) AS n FROM pages"


def _pairs(spark, d) -> DataFrame:
    """Documents with a second text: the whole one, of which body lost its second half for every 3rd."""
    docs = table(spark, d, "documents")
    other = F.concat("text", F.lit(" 12 34.5 777 "), F.col("doc_id").cast("string"))
    body = F.when(F.col("doc_id") % 3 == 0, F.substring("text", F.lit(1), (F.length("text") / 2).cast("int"))).otherwise(F.col("text"))
    return docs.select(F.col("doc_id").alias("stem"), body.alias("body"), F.when(F.col("doc_id") % 4 == 3, F.lit(None)).otherwise(other).alias("pdf_text"), F.when(F.col("doc_id") % 2 == 0, "hwp").otherwise("hwpx").alias("source_format"))


_PAIRS = """pairs AS (SELECT doc_id AS stem, CASE WHEN doc_id % 3 = 0 THEN left(text, CAST(floor(length(text) / 2) AS INTEGER)) ELSE text END AS body, CASE WHEN doc_id % 4 = 3 THEN NULL ELSE text || ' 12 34.5 777 ' || doc_id END AS pdf_text, CASE WHEN doc_id % 2 = 0 THEN 'hwp' ELSE 'hwpx' END AS source_format FROM documents)"""


def q3_char_bag(spark, d) -> DataFrame:
    return _pairs(spark, d).filter("pdf_text is not null").select("stem", text.char_bag_diff("pdf_text", "body").alias("n"))


Q3 = f"""WITH {_PAIRS}, a AS (SELECT stem, unnest(string_split(regexp_replace(pdf_text, '[^가-힣0-9A-Za-z]', '', 'g'), '')) AS ch FROM pairs WHERE pdf_text IS NOT NULL), b AS (SELECT stem, unnest(string_split(regexp_replace(body, '[^가-힣0-9A-Za-z]', '', 'g'), '')) AS ch FROM pairs),
ca AS (SELECT stem, ch, count(*) AS n FROM a GROUP BY ALL), cb AS (SELECT stem, ch, count(*) AS n FROM b GROUP BY ALL)
SELECT stem, CAST(sum(greatest(0, ca.n - coalesce(cb.n, 0))) AS INTEGER) AS n FROM ca LEFT JOIN cb USING (stem, ch) GROUP BY stem"""


def q4_num_set(spark, d) -> DataFrame:
    return _pairs(spark, d).select("stem", F.array_join(quality.num_set_diff("pdf_text", "body"), ",").alias("missing"))


_NUMS = lambda c: f"list_distinct(regexp_extract_all(replace(regexp_replace(coalesce({c}, ''), '<[^>]+>', ' ', 'g'), ',', ''), '\\d+\\.\\d+|\\d{{2,}}'))"
Q4 = f"WITH {_PAIRS} SELECT stem, array_to_string(list_sort(list_filter({_NUMS('pdf_text')}, lambda x: NOT list_contains({_NUMS('body')}, x))), ',') AS missing FROM pairs"


def q5_math_loss(spark, d) -> DataFrame:
    """Order lines as expressions, of which some lost the power of ten."""
    li = table(spark, d, "lineitem")
    e = F.concat(F.col("l_quantity").cast("int").cast("string"), F.when(F.col("l_linenumber") == 1, ".58×C/kg").when(F.col("l_linenumber") == 2, ".58×10<sup>-5</sup>").when(F.col("l_linenumber") == 3, ".58×10 C").otherwise(" (D×10)"))
    return li.select("l_orderkey", "l_linenumber", F.size(text.math_loss(e)).alias("n"))


Q5 = "SELECT l_orderkey, l_linenumber, CAST(CASE WHEN l_linenumber = 1 THEN 1 ELSE 0 END AS INTEGER) AS n FROM lineitem"


def q6_audit(spark, d) -> DataFrame:
    return quality.audit_extraction(_pairs(spark, d)).select("stem", "note")


_TEXT_LEN = lambda c: f"length(regexp_replace(regexp_replace(regexp_replace(coalesce({c}, ''), '<[^>]+>', '', 'g'), '[#*|\\\\_-]', '', 'g'), '[\\s\\p{{Z}}]+', '', 'g'))"
_AUDIT = f"""{_PAIRS}, bags AS (SELECT stem, n FROM ({Q3.split("WITH ", 1)[0]}WITH {Q3.split(_PAIRS + ", ", 1)[1]})),
measured AS (SELECT p.*, {_TEXT_LEN("body")} AS mine, {_TEXT_LEN("pdf_text")} AS theirs, coalesce(n, 0) AS chars, length(regexp_replace(body, '[^가-힣0-9A-Za-z]', '', 'g')) AS total,
  len(list_filter({_NUMS("pdf_text")}, lambda x: NOT list_contains({_NUMS("body")}, x))) AS nums FROM pairs p LEFT JOIN bags b ON b.stem = p.stem),
audited AS (SELECT *, CASE WHEN pdf_text IS NULL THEN CASE WHEN mine < 100 THEN 'short_no_pdf' ELSE '' END WHEN theirs > mine * 1.8 AND theirs - mine > 150 THEN 'pdf_fallback' WHEN chars > 120 AND chars > total * 0.15 THEN 'char_diverge' WHEN nums >= 5 THEN 'num_diverge' ELSE '' END AS note FROM measured)"""
Q6 = f"WITH {_AUDIT} SELECT stem, note FROM audited"
Q7 = f"""WITH {_AUDIT}, kept AS (SELECT *, CASE WHEN note = 'pdf_fallback' THEN pdf_text ELSE body END AS t FROM audited)
SELECT source_format, count(*) FILTER (t != '') AS n_ok, count(*) FILTER (t = '') AS n_failed, {", ".join(f"count(*) FILTER (note = '{f}') AS n_{f}" for f in ("pdf_fallback", "char_diverge", "num_diverge", "short_no_pdf", "math_loss", "corrected", "correction_stale"))},
  count(*) FILTER (NOT contains(t, '<table') AND NOT contains(t, '|')) AS n_without_table, round(avg(strlen(t)), 3) AS mean_bytes FROM kept GROUP BY source_format"""


def q7_summary(spark, d) -> DataFrame:
    return quality.extraction_summary(quality.audit_extraction(_pairs(spark, d))).withColumn("mean_bytes", F.round("mean_bytes", 3))


# --- ingestion ------------------------------------------------------------------------------------------


def _ingest(spark, d, edited: bool) -> DataFrame:
    docs = table(spark, d, "documents")
    k = F.col("doc_id")
    docs = docs.filter(k % 11 != 0) if edited else docs.filter(k % 13 != 0)
    content = F.concat(F.when((k % 7 == 0) & F.lit(edited), "x").otherwise(""), "text", F.when((k % 5 == 0) & F.lit(edited) & (F.length("text") > 1800), "after the cap").otherwise(""))
    meta = F.struct(F.lit("attachment").alias("document_type"), F.concat(F.lit("별표"), (k % 4).cast("string")).alias("attachment_no"))
    return embeddings.ingest_rows(docs.select(k.alias("chunk_id"), content.alias("content"), meta.alias("metadata"))).withColumn("content_sha", F.col("metadata.content_sha"))


def r1_ingest_rows(spark, d) -> DataFrame:
    return _ingest(spark, d, False).select("chunk_id", "content_sha", "metadata.byeol", F.length("embed_text").alias("chars"))


R1 = "SELECT doc_id AS chunk_id, left(sha256(left(text, 1800)), 16) AS content_sha, CAST(doc_id % 4 AS VARCHAR) AS byeol, CAST(length(left(text, 1800)) AS INTEGER) AS chars FROM documents WHERE doc_id % 13 != 0"


def r2_changed_rows(spark, d) -> DataFrame:
    return embeddings.changed_rows(_ingest(spark, d, True), _ingest(spark, d, False)).select("chunk_id")


R2 = "SELECT doc_id AS chunk_id FROM documents WHERE doc_id % 11 != 0 AND (doc_id % 13 = 0 OR doc_id % 7 = 0)"


def s10_upsert(spark, d) -> DataFrame:
    """A stored table and one batch in which every third chunk has an earlier and a later edit."""
    old, new = (_ingest(spark, d, edited).drop("metadata").withColumn("seq", F.lit(1)) for edited in (False, True))
    early = new.filter("chunk_id % 3 = 0").withColumn("content", F.lit("early")).withColumn("content_sha", F.lit("early")).withColumn("seq", F.lit(0))
    stored = KeyedTable(spark, f"{sinks.shared_folder(spark)}/upsert-{uuid.uuid4().hex}").create(old.schema, "chunk_id", 16)
    stored.upsert(old, "seq")
    stored.upsert(early.unionByName(new), "seq", "content_sha")
    return stored.read().select("chunk_id", F.md5(F.col("content").cast("binary")).alias("content_md5"))


S10 = """SELECT doc_id AS chunk_id, md5(CASE WHEN doc_id % 11 != 0 AND (doc_id % 13 = 0 OR doc_id % 7 = 0) THEN CASE WHEN doc_id % 7 = 0 THEN 'x' ELSE '' END || text || CASE WHEN doc_id % 5 = 0 AND length(text) > 1800 THEN 'after the cap' ELSE '' END ELSE text END) AS content_md5
FROM documents WHERE doc_id % 13 != 0 OR doc_id % 11 != 0"""


def r15_profile(spark, d) -> DataFrame:
    return embeddings.ingest_profile(_ingest(spark, d, False))


R15 = "SELECT 'attachment' AS document_type, count(*) AS n_rows, count(*) FILTER (length(text) > 1800) AS n_capped, count(DISTINCT doc_id) AS n_ids FROM documents WHERE doc_id % 13 != 0"


def v6_count_check(spark, d) -> DataFrame:
    return guards.count_check(table(spark, d, "documents"), 1000)


V6 = "SELECT count(*) AS n_rows, CAST(1000 AS BIGINT) AS expected, count(*) = 1000 AS ok FROM documents"


def v4_dimensions(spark, d) -> DataFrame:
    v = table(spark, d, "embeddings").select("vec_id", F.when(F.col("vec_id") % 9 == 0, F.slice("embedding", 1, 63)).otherwise(F.col("embedding")).alias("embedding"))
    return guards.wrong_dimension(v, 64).select("vec_id")


V4 = "SELECT vec_id FROM embeddings WHERE vec_id % 9 = 0"


def r14_units(spark, d) -> DataFrame:
    docs = table(spark, d, "documents")
    chunks = docs.select(F.col("doc_id").cast("string").alias("chunk_id"), F.col("text").alias("content"), F.struct(F.when(F.col("doc_id") % 3 == 0, "attachment").otherwise("law").alias("document_type"), F.lit("별표2의1").alias("attachment_no"), F.concat("source", F.lit(" (법)")).alias("law_title"), F.lit("제1조").alias("article")).alias("metadata"))
    annexes = docs.select(F.concat(F.lit("annex "), F.col("doc_id").cast("string")).alias("stem"), F.concat(F.lit("[별표 "), (F.col("doc_id") % 5).cast("string"), F.lit("] "), "text").alias("body"), F.col("source").alias("parent_law"))
    return embeddings.retrieval_units(chunks, annexes, "annex").select("id", "law", "article", "annex", F.length("text").alias("chars"))


R14 = r"""SELECT CAST(doc_id AS VARCHAR) AS id, source || '법' AS law, '제1조' AS article, '' AS annex, CAST(length(left(text, 1800)) AS INTEGER) AS chars FROM documents WHERE doc_id % 3 != 0
UNION ALL SELECT 'annex ' || doc_id, source, '', CAST(doc_id % 5 AS VARCHAR), CAST(length(left(body, 1800)) AS INTEGER) FROM (SELECT *, '[별표 ' || (doc_id % 5) || '] ' || text AS body FROM documents) WHERE length(regexp_replace(body, '[\s\p{Z}]+', '', 'g')) >= 40"""

# --- evaluation and answers -------------------------------------------------------------------------


def e1_norm_name(spark, d) -> DataFrame:
    return table(spark, d, "part").select("p_partkey", text.norm_name(F.concat("p_name", F.lit(" ·(_)ㆍ"), "p_type")).alias("name"))


E1 = r"SELECT p_partkey, regexp_replace(p_name || ' ·(_)ㆍ' || p_type, '[\s_·ㆍ()]', '', 'g') AS name FROM part"


def e2_subsequence(spark, d) -> DataFrame:
    p = table(spark, d, "part")
    short = F.lower(F.substring("p_type", 1, 2))
    return p.select("p_partkey", text.is_subsequence(short, F.lower("p_name")).alias("within"))


E2 = "SELECT p_partkey, lower(p_name) LIKE '%' || substr(lower(p_type), 1, 1) || '%' || substr(lower(p_type), 2, 1) || '%' AS within FROM part"


def _units(spark, d) -> DataFrame:
    p = table(spark, d, "part")
    annex = F.when(F.col("p_size") % 2 == 0, (F.col("p_size") % 7).cast("string")).otherwise("")
    return p.select(F.col("p_partkey").alias("id"), text.norm_name(F.concat(F.lit("의료"), "p_brand", F.lit(" 법"))).alias("law"), F.concat(F.lit("제"), (F.col("p_size") % 5 + 1).cast("string"), F.lit("조")).alias("article"), annex.alias("annex"))


def _expected(spark, d) -> DataFrame:
    s = table(spark, d, "supplier")
    brand = F.concat(F.lit("의료Brand#"), (F.col("s_suppkey") % 5 + 1).cast("string"), (F.col("s_nationkey") % 5 + 1).cast("string"))
    e = F.when(F.col("s_suppkey") % 3 == 0, F.concat(brand, F.lit(" 법 제"), (F.col("s_suppkey") % 5 + 1).cast("string"), F.lit("조"))).when(F.col("s_suppkey") % 3 == 1, F.concat(brand, F.lit("법 별표"), (F.col("s_suppkey") % 7).cast("string"))).otherwise(brand)
    return s.select(F.col("s_suppkey").alias("qid"), F.array(e).alias("expected_sources"))


def e3_match_sources(spark, d) -> DataFrame:
    return evaluation.match_sources(_expected(spark, d), _units(spark, d))


def e4_match_strict(spark, d) -> DataFrame:
    return evaluation.match_sources(_expected(spark, d), _units(spark, d), mode="strict")


E3 = """WITH u AS (SELECT p_partkey AS id, '의료' || p_brand || '법' AS law, '제' || (p_size % 5 + 1) || '조' AS article, CASE WHEN p_size % 2 = 0 THEN CAST(p_size % 7 AS VARCHAR) ELSE '' END AS annex FROM part),
e AS (SELECT s_suppkey AS qid, s_suppkey % 3 AS kind, '의료Brand#' || (s_suppkey % 5 + 1) || (s_nationkey % 5 + 1) AS brand, CASE s_suppkey % 3 WHEN 0 THEN '제' || (s_suppkey % 5 + 1) || '조' ELSE CAST(s_suppkey % 7 AS VARCHAR) END AS n FROM supplier)
SELECT DISTINCT qid, id FROM e JOIN u ON CASE kind WHEN 0 THEN law = brand || '법' AND article = n WHEN 1 THEN law = brand || '법' AND annex = n ELSE starts_with(law, brand) END"""


def _numbers(c: str = "o_orderkey") -> Column:
    n = F.col(c).cast("string")
    return F.concat(F.lit("한도 "), n, F.lit(".5 × 10<sup>-3</sup> mSv, 1,"), F.lpad((F.col(c) % 1000).cast("string"), 3, "0"), F.lit(" Bq, "), (F.col(c) % 9 + 1).cast("string"), F.lit("E+07와 제3조"))


def e8_canon(spark, d) -> DataFrame:
    return table(spark, d, "orders").select("o_orderkey", text.canon(_numbers()).alias("canon"))


E8 = "SELECT o_orderkey, '한도 ' || o_orderkey || '.5e-3 mSv, 1' || lpad(CAST(o_orderkey % 1000 AS VARCHAR), 3, '0') || ' Bq, ' || (o_orderkey % 9 + 1) || 'e7와 제3조' AS canon FROM orders"


def e9_e10_numbers(spark, d) -> DataFrame:
    return table(spark, d, "orders").select("o_orderkey", F.array_join(F.array_sort(text.numbers(_numbers())), "|").alias("numbers"), F.array_join(text.propose_keys(_numbers()), "|").alias("proposed"))


_PROPOSED = "list_sort(list_distinct([o_orderkey || '.5e-3', '1' || lpad(CAST(o_orderkey % 1000 AS VARCHAR), 3, '0'), (o_orderkey % 9 + 1) || 'e7']))"
E9 = f"SELECT o_orderkey, array_to_string(list_sort(list_append({_PROPOSED}, '3')), '|') AS numbers, array_to_string({_PROPOSED}, '|') AS proposed FROM orders"


def e11_has_all(spark, d) -> DataFrame:
    keys = F.array(F.array((F.col("o_custkey") % 9 + 1).cast("string"), F.concat((F.col("o_custkey") % 9 + 1).cast("string"), F.lit("×10^7"))), F.array(F.lit("없는 말"), F.lit("한 도")))
    return table(spark, d, "orders").select("o_orderkey", text.has_all(_numbers(), keys).alias("found"))


E11 = """SELECT o_orderkey, o_custkey % 9 = o_orderkey % 9 OR o_custkey % 9 + 1 = 3 AS found FROM orders"""


def e15_values(spark, d) -> DataFrame:
    return table(spark, d, "orders").select("o_orderkey", F.array_join(text.values(_numbers()), "|").alias("strict"), F.size(text.values(_numbers(), strict=False)).alias("n_loose"))


E15 = f"SELECT o_orderkey, array_to_string({_PROPOSED}, '|') AS strict, CAST(len({_PROPOSED}) AS INTEGER) AS n_loose FROM orders"


def _answers(spark, d) -> DataFrame:
    c = table(spark, d, "conversations").filter("role = 'assistant'")
    n = (F.col("conv_id") % 7 + 10).cast("string")
    cited = F.array((F.col("conv_id") * 100).cast("string"), F.lit("missing"))
    cite = F.when(F.col("turn") % 3 == 0, F.lit("「근거」 법")).otherwise("")
    return c.select(F.concat_ws("-", "conv_id", "turn").alias("qid"), F.when(F.col("conv_id") % 2 == 0, "a").otherwise("b").alias("model"), F.concat(cite, F.lit("\n한도는 "), n, F.lit(" mSv 및 99 Bq")).alias("answer"), cited.alias("chunk_ids"))


def _cited(spark, d) -> DataFrame:
    c = table(spark, d, "conversations").select("conv_id").distinct().filter("conv_id % 5 != 0")
    return c.select((F.col("conv_id") * 100).cast("string").alias("chunk_id"), F.concat(F.lit("표 1.2 | "), (F.col("conv_id") % 14 + 10).cast("string")).alias("content"))


def e16_unsupported(spark, d) -> DataFrame:
    out = audit.unsupported_values(_answers(spark, d), _cited(spark, d))
    return out.select("qid", "model", F.array_join("unsupported", ",").alias("unsupported"))


_ANSWERS = """a AS (SELECT conv_id || '-' || turn AS qid, CASE WHEN conv_id % 2 = 0 THEN 'a' ELSE 'b' END AS model, conv_id, turn FROM conversations WHERE role = 'assistant')"""
E16 = f"WITH {_ANSWERS} SELECT qid, model, CASE WHEN conv_id % 7 = conv_id % 14 THEN '99' ELSE (conv_id % 7 + 10) || ',99' END AS unsupported FROM a WHERE conv_id % 5 != 0"


def e17_format(spark, d) -> DataFrame:
    return audit.format_violations(_answers(spark, d)).select("qid", "model", F.array_join("violations", ",").alias("violations"))


E17 = f"WITH {_ANSWERS} SELECT qid, model, CASE WHEN turn % 3 = 0 THEN '' ELSE 'no_citation' END AS violations FROM a"


def e18_summary(spark, d) -> DataFrame:
    a = _answers(spark, d)
    return audit.audit_summary(audit.unsupported_values(a, _cited(spark, d)), audit.format_violations(a))


E18 = f"WITH {_ANSWERS} SELECT model, count(*) AS n_questions, count(*) FILTER (turn % 3 != 0) AS n_format, count(*) FILTER (conv_id % 5 != 0) AS n_flagged FROM a GROUP BY model"


def v5_missing_keys(spark, d) -> DataFrame:
    q = table(spark, d, "benchmark").select(F.col("item_id").alias("qid"), F.array(F.array(F.when(F.col("item_id") % 2 == 0, "zzqqzz no such").otherwise("the")), F.array(F.lit("98765432109"))).alias("answer_keys"))
    return guards.missing_keys(q, table(spark, d, "documents"))


V5 = "SELECT item_id AS qid, 'zzqqzz no such' AS key FROM benchmark WHERE item_id % 2 = 0 UNION ALL SELECT item_id, '98765432109' FROM benchmark"


def v7_coverage(spark, d) -> DataFrame:
    q = table(spark, d, "benchmark").select("item_id", F.when(F.col("item_id") % 3 == 0, F.array().cast("array<string>")).otherwise(F.array("text")).alias("answer_keys"))
    return guards.eval_coverage(q, F.col("item_id") % 10 == 0)


V7 = "SELECT CASE WHEN item_id % 10 = 0 THEN 'excluded' WHEN item_id % 3 = 0 THEN 'unkeyed' ELSE 'keyed' END AS state, count(*) AS n FROM benchmark GROUP BY ALL"


_PAIRED = {
    "j9_last_version_change": J9, "j10_reconcile": J10, "j10_totals": J10_TOTALS, "j11_pair_match": J11, "j12_impact": J12, "j13_group_fragments": J13, "j14_align": J14, "j15_three_way": J15, "j16_j18_freshness": J16, "j17_latest_version": J17,
    "j19_review_changed": J19, "j20_pair_check": J20, "j21_collection_plan": J21, "j21_skipped": J21_SKIPPED, "j22_forms_registry": J22, "j23_fetch_list": J23, "s13_forms_markdown": S13, "j24_select_versions": J24, "j25_select_rules": J25, "j26_prefer_source": J26,
    "h1_markers": H1, "h2_addenda_history": H2, "h3_revision_profile": H3, "h4_lifecycle": H4, "h5_untrusted": H5, "h6_noise_ratio": H6, "h7_branches": H7,
    "q1_corrections": Q1, "q2_text_len": Q2, "q3_char_bag": Q3, "q4_num_set": Q4, "q5_math_loss": Q5, "q6_audit": Q6, "q7_summary": Q7, "r1_ingest_rows": R1, "r2_changed_rows": R2, "r14_units": R14, "r15_profile": R15, "s10_upsert": S10,
    "v4_dimensions": V4, "v5_missing_keys": V5, "v6_count_check": V6, "v7_coverage": V7, "v8_stale_corrections": V8, "v9_name_collisions": V9,
    "e1_norm_name": E1, "e2_subsequence": E2, "e3_match_sources": E3, "e4_match_strict": E3, "e8_canon": E8, "e9_e10_numbers": E9, "e11_has_all": E11, "e15_values": E15, "e16_unsupported": E16, "e17_format": E17, "e18_summary": E18,
}
QUERIES = {name: globals()[name] for name in _PAIRED}
ORACLES = _PAIRED
