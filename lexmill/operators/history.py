"""Measures of a corpus's version history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexmill.functions.text import text

#: Inline markers, revision classes and their alert priority in the default dialect (fixed values).
MARKERS = {"개정": "amended", "신설": "inserted", "삭제": "deleted"}
TOP, LOW, FULL = ("전부개정", "제정", "폐지"), ("타법개정",), "전부개정"


def change_markers(articles: DataFrame, body: str = "text", markers: dict[str, str] = MARKERS) -> DataFrame:
    """(kind, date, n): every date of every inline marker such as <개정 2013.8.16, 2026.7.9>."""
    names = "|".join(markers)
    found = articles.select(F.explode(F.regexp_extract_all(text(body), F.lit(rf"<?(?:{names})\s*\.?\s*<?[0-9., ]+>"), F.lit(0))).alias("marker"))
    kind = F.create_map(*(F.lit(x) for pair in markers.items() for x in pair))[F.regexp_extract("marker", f"({names})", 1)]
    dates = F.regexp_extract_all("marker", F.lit(r"\d{4}\.\s*\d{1,2}\.\s*\d{1,2}"), F.lit(0))
    rows = found.select(kind.alias("kind"), F.explode(dates).alias("date"))
    return rows.select("kind", dotted_date("date").alias("date")).groupBy("kind", "date").agg(F.count("*").alias("n"))


def dotted_date(c: Column | str) -> Column:
    """'2026.7.9' as a date; null where it is none."""
    part = lambda g: F.regexp_extract(c, r"(\d{4})\.\s*(\d{1,2})\.\s*(\d{1,2})", g)
    return F.try_to_date(F.concat_ws("-", part(1), F.lpad(part(2), 2, "0"), F.lpad(part(3), 2, "0")), "yyyy-MM-dd")


def addenda_history(docs: DataFrame, key: str = "stem", body: str = "body") -> DataFrame:
    """(key, pos, number, date, current): the <제N호,date> blocks of the addenda; the latest is current."""
    blocks = F.regexp_extract_all(text(body), F.lit(r"<제\s*\d+\s*호\s*,\s*\d{4}\.\s*\d{1,2}\.\s*\d{1,2}\.?>"), F.lit(0))
    rows = docs.select(key, F.posexplode(blocks).alias("pos", "block")).select(key, "pos", F.regexp_extract("block", r"제\s*(\d+)\s*호", 1).alias("number"), dotted_date("block").alias("date"))
    latest = Window.partitionBy(key).orderBy(F.desc_nulls_last("date"), F.desc("pos"))
    return rows.withColumn("current", F.row_number().over(latest) == 1)


def alert_priority(revision: Column | str, top: tuple[str, ...] = TOP, low: tuple[str, ...] = LOW) -> Column:
    revision = F.col(revision) if isinstance(revision, str) else revision
    return F.when(revision.isin(*top), "top").when(revision.isin(*low), "low").otherwise("normal")


def revision_profile(feed: DataFrame, revision: str = "revision_class", top: tuple[str, ...] = TOP, low: tuple[str, ...] = LOW) -> DataFrame:
    """(revision_class, priority, n)."""
    return feed.groupBy(F.col(revision).alias("revision_class")).agg(F.count("*").alias("n")).withColumn("priority", alert_priority("revision_class", top, low))


def lifecycle(feed: DataFrame, as_of: Column | str, key: str = "law_id", effective: str = "enforce_date", seq: str = "seq") -> DataFrame:
    """Adds stage: pending (effective later), current (the latest in effect) or past."""
    as_of = F.lit(as_of) if isinstance(as_of, str) else as_of
    due = F.col(effective) <= as_of
    latest = Window.partitionBy(key, due).orderBy(F.desc(effective), F.desc(seq))
    return feed.withColumn("stage", F.when(~due, "pending").when(F.row_number().over(latest) == 1, "current").otherwise("past"))


def flag_untrusted(diff: DataFrame, feed: DataFrame, version: str = "version_key", full: str = FULL) -> DataFrame:
    """Adds trusted: false where the version is a full revision, whose article diff means little."""
    classes = feed.select(F.col("mst").alias(version), "revision_class").dropDuplicates([version])
    return diff.join(classes, version, "left").withColumn("trusted", ~F.col("revision_class").eqNullSafe(F.lit(full)))


def noise_ratio(history: DataFrame, path: str = "path", seq: str = "seq", version: str = "version") -> DataFrame:
    """(n_changes, n_amendments): file changes after the first of a path, and those with a new version key."""
    order = Window.partitionBy(path).orderBy(seq)
    pairs = history.select(F.lag(seq).over(order).alias("_before"), F.lag(version).over(order).alias("_old"), F.col(version).alias("_new")).filter("_before is not null")
    return pairs.agg(F.count("*").alias("n_changes"), F.count_if(~F.col("_old").eqNullSafe(F.col("_new"))).alias("n_amendments"))


def branch_profile(manifest: DataFrame, key: str = "parent", branch: str = "branch") -> DataFrame:
    """(key, n_items, n_branches)."""
    return manifest.groupBy(key).agg(F.count("*").alias("n_items"), F.count_if(F.col(branch) != "00").alias("n_branches"))
