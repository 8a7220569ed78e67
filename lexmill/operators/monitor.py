"""Freshness of watched documents, collection plans, registries and selections from a version feed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexmill.functions import frontmatter as fm
from lexmill.functions.text import ARTICLE_WITH_PARTS, text, zero_fill

#: Topics of the default dialect (fixed values).
TOPIC = "방사선|방사성|원자력|동위원소|핵|피폭|선량"
MEDICAL = "의료|진단|피폭|방사선방호|방사선 안전관리|방사선안전보고서|동위원소|생활주변|방사선원|방사선기기|방사선발생장치|업무대행|누설점검|보안관리|판매자|면허|우주방사선|비상진료"
GATED_MINISTRY, RULE_MINISTRIES = "원자력안전위원회", ("원자력안전위원회", "질병관리청", "보건복지부")
ORIGINAL_PREFERENCE = ("hwpx", "hwp", "doc", "docx")


def latest_version(feed: DataFrame, key: str = "law_id", date: str = "promulgate_date", seq: str = "seq") -> DataFrame:
    """The feed's row with the latest date of each id; the first of the feed wins a tie."""
    first = Window.partitionBy(key).orderBy(F.desc_nulls_last(date), seq)
    return feed.withColumn("_n", F.row_number().over(first)).filter("_n = 1").drop("_n")


def freshness(watchlist: DataFrame, ours: DataFrame, feed: DataFrame) -> DataFrame:
    """(name, law_id, verdict) for watchlist (name, law_id, tier, watch), ours (name, version_key,
    promulgate_date) and feed (law_id, mst, promulgate_date, status, seq).

    Peripheral documents say REVIEW instead of STALE, with their watch hints.
    """
    latest = latest_version(feed).select(F.col("law_id").alias("_id"), F.col("mst").alias("_mst"), F.col("promulgate_date").alias("_date"), F.col("status").alias("_status"))
    known = feed.select(F.col("mst").alias("version_key")).distinct().withColumn("_known", F.lit(True))
    mine = ours.select("name", "version_key", F.regexp_replace(text("promulgate_date"), "-", "").alias("_own"))
    joined = watchlist.withColumn("_id", zero_fill(F.trim(text("law_id")), 6)).join(mine, "name", "left").join(latest, "_id", "left").join(known, "version_key", "left")
    hints = F.concat_ws("; ", F.coalesce("watch", F.array().cast("array<string>")))
    stale = F.when(F.col("tier") == "core", F.concat(F.lit("STALE"), F.when(text("_status") != "", F.concat(F.lit("("), "_status", F.lit(")"))).otherwise(""))).otherwise(F.concat(F.lit("REVIEW"), F.when(hints != "", F.concat(F.lit(": "), hints)).otherwise("")))
    verdict = (
        F.when(F.trim(text("law_id")) == "", "NO_ID")
        .when(F.col("version_key").isNull(), "NO_FILE")
        .when(F.col("_mst").isNull(), "LOOKUP_FAILED")
        .when(F.col("_mst") == F.col("version_key"), "SYNC")
        .when(F.col("_date") > F.col("_own"), stale)
        .when(F.col("_known"), "SYNC_PENDING")
        .otherwise("MISSING")
    )
    return joined.select("name", "law_id", "tier", verdict.alias("verdict"))


def review_changed(changed: DataFrame, watchlist: DataFrame, keywords: str = TOPIC, doc: str = "name", body: str = "text") -> DataFrame:
    """(doc, verdict): peripheral documents with a changed article on topic say REVIEW, others SILENT."""
    peripheral = watchlist.filter("tier != 'core'").select(F.col("name").alias(doc)).distinct()
    hit = F.coalesce(F.bool_or(text(body).rlike(keywords)), F.lit(False))
    return changed.join(peripheral, doc, "left_semi").groupBy(doc).agg(F.when(hit, "REVIEW").otherwise("SILENT").alias("verdict"))


def pair_check(sources: DataFrame, parsed: DataFrame, key: str = "stem") -> DataFrame:
    """(stem, problem): sources that were not parsed and parsed files without a source."""
    a, b = sources.select(key).distinct(), parsed.select(key).distinct()
    return a.join(b, key, "left_anti").withColumn("problem", F.lit("unparsed")).unionByName(b.join(a, key, "left_anti").withColumn("problem", F.lit("orphaned")))


def _gated(manifest: DataFrame, watchlist: DataFrame, topic: str) -> DataFrame:
    """manifest (is_rule, parent, pos, kind, title, file_link, pdf_link) with _wanted; only rows with a link."""
    tier = watchlist.select(F.col("name").alias("parent"), "tier").distinct()
    rows = manifest.join(tier, "parent", "left").filter((text("file_link") != "") | (text("pdf_link") != ""))
    return rows.withColumn("_wanted", F.col("is_rule") | (F.coalesce("tier", F.lit("peripheral")) == "core") | text("title").rlike(topic)).drop("tier")


def collection_plan(manifest: DataFrame, watchlist: DataFrame, topic: str = TOPIC) -> DataFrame:
    """(url, type, base, parent, title): each link once, in the order of folder, file and place."""
    rows = _gated(manifest, watchlist, topic).filter("_wanted")
    base = F.concat(F.lit("["), F.when(text("kind") != "", F.col("kind")).otherwise("별표"), F.lit("] "), fm.sanitize_name("title"), F.lit("("), fm.sanitize_name("parent"), F.lit(")"))
    links = F.array(F.struct(F.col("file_link").alias("url"), F.lit("original").alias("type"), F.lit(0).alias("rank")), F.struct(F.col("pdf_link").alias("url"), F.lit("pdf").alias("type"), F.lit(1).alias("rank")))
    each = rows.select("is_rule", "parent", "pos", "title", base.alias("base"), F.explode(links).alias("l")).select("is_rule", "parent", "pos", "title", "base", "l.*").filter(text("url") != "")
    first = F.min_by(F.struct("type", "base", "parent", "title"), F.struct("is_rule", "parent", "pos", "rank"))
    return each.groupBy("url").agg(first.alias("p")).select("url", "p.*")


def skipped_count(manifest: DataFrame, watchlist: DataFrame, topic: str = TOPIC) -> DataFrame:
    return _gated(manifest, watchlist, topic).agg(F.count_if(~F.col("_wanted")).alias("n_skipped"))


def forms_registry(manifest: DataFrame, watchlist: DataFrame, files: DataFrame, topic: str = TOPIC) -> DataFrame:
    """(parent, kind, num, title, articles, orig_url, pdf_url, orig_file, pdf_file) of forms: annexes
    proper are left out; numbers sort as strings. files: (file) names on disk."""
    rows = _gated(manifest, watchlist, topic).filter((F.col("_wanted")) & (text("kind") != "별표"))
    key = F.when(text("file_link") != "", F.col("file_link")).otherwise(F.col("pdf_link"))
    once = rows.groupBy(key.alias("_url")).agg(F.min_by(F.struct("parent", "kind", "no", "branch", "title", "file_link", "pdf_link"), F.struct("is_rule", "parent", "pos")).alias("r")).select("r.*")
    base = F.concat(F.lit("["), "kind", F.lit("] "), fm.sanitize_name("title"), F.lit("("), fm.sanitize_name("parent"), F.lit(")"))
    named = files.select(F.regexp_replace("file", r"\.[^.]+$", "").alias("base"), F.lower(F.regexp_extract("file", r"\.([^.]+)$", 1)).alias("ext"), "file")
    preference = F.array_position(F.lit(list(ORIGINAL_PREFERENCE)), F.col("ext"))
    found = named.groupBy("base").agg(F.min_by("file", F.when(preference > 0, preference)).alias("orig_file"), F.max(F.when(F.col("ext") == "pdf", F.col("file"))).alias("pdf_file"))
    out = once.withColumn("base", base).join(found, "base", "left")
    return out.select(
        "parent", "kind", fm.manifest_number("no", "branch").alias("num"), "title",
        F.array_join(F.array_distinct(F.regexp_extract_all("title", F.lit(ARTICLE_WITH_PARTS), F.lit(0))), " ").alias("articles"),
        text("file_link").alias("orig_url"), text("pdf_link").alias("pdf_url"), text("orig_file").alias("orig_file"), text("pdf_file").alias("pdf_file"),
    )


def fetch_list(members: DataFrame, everything: bool = False) -> DataFrame:
    return (members if everything else members.filter("tier = 'core'")).select("name", "law_id")


def select_versions(feed: DataFrame, name: str | None = None, promulgated: tuple[str, str] | None = None, effective: tuple[str, str] | None = None, ministry: str | None = None, number: str | None = None, revision: str | None = None, order: tuple[str, ...] = ("law_id", "promulgate_date", "mst")) -> DataFrame:
    """Feed rows that meet every given condition; date ranges include both ends."""
    out = feed
    if name is not None:
        out = out.filter(F.contains("name", F.lit(name)))
    for span, column in ((promulgated, "promulgate_date"), (effective, "enforce_date")):
        if span is not None:
            out = out.filter(F.col(column).between(*span))
    for value, column in ((ministry, "ministry_name"), (number, "promulgate_no"), (revision, "revision_class")):
        if value is not None:
            out = out.filter(F.col(column) == value)
    return out.orderBy(*order)


def select_rules(feed: DataFrame, ministries: tuple[str, ...] = RULE_MINISTRIES, gated: str = GATED_MINISTRY, topic: str = MEDICAL) -> DataFrame:
    """(name, serial): rules of the ministries, one of which needs a topic in the name; the last serial of a name."""
    rows = feed.filter(F.col("ministry").isin(*ministries) & ((F.col("ministry") != gated) | F.col("name").rlike(topic)))
    return rows.groupBy("name").agg(F.max_by("serial", "seq").alias("serial"))


def prefer_source(files: DataFrame, preference: tuple[str, ...] = ("hwpx", "hwp")) -> DataFrame:
    """(stem, file): one source file for each stem, by format."""
    named = files.select(F.regexp_replace("file", r"\.[^.]+$", "").alias("stem"), F.lower(F.regexp_extract("file", r"\.([^.]+)$", 1)).alias("ext"), "file")
    rank = F.array_position(F.lit(list(preference)), F.col("ext"))
    return named.filter(rank > 0).groupBy("stem").agg(F.min_by("file", F.struct(rank, F.col("file"))).alias("file"))
