"""Amendments between two snapshots of a document tree.

The version key decides first, so re-formatted documents leave before any body is parsed; articles
are compared by hash, and bodies are fetched again only for line diffs of articles that changed.
"""

from __future__ import annotations

import difflib

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexmill.functions import frontmatter as fm
from lexmill.functions.text import ARTICLE, sorted_articles, squeeze, strip, text

#: Heading and addenda of the comparison: the heading has three to five marks and may go on (fixed values).
HEADING = r"#{3,5}\s*(제\s*\d+조(?:의\s*\d+)?)\s*(?:\(([^)]*)\))?"
ADDENDA = r"(?:^#{1,6}\s*부\s*칙|^\s*부\s*칙\s*<)"
SOURCE_FORMATS = ("hwp", "hwpx")


def addenda_of(body: Column | str) -> Column:
    """What begins at the first addenda line, stripped; '' without one."""
    return strip(F.regexp_extract(text(body), rf"(?dsm)({ADDENDA}.*)\z", 1))


def article_table(docs: DataFrame, key: list[str], body: str = "body") -> DataFrame:
    """(key..., article, title, pos, md5): one row for each article before the first addenda line.

    The hash covers the heading line; of a repeated number the last one counts.
    """
    before = F.element_at(F.split(text(body), rf"(?dm){ADDENDA}", 2), 1)
    pieces = F.filter(F.split(before, rf"(?dm)(?=^{HEADING})"), lambda p: p.rlike(rf"(?d)\A{HEADING}"))
    rows = docs.select(*key, F.posexplode(pieces).alias("pos", "_piece"))
    rows = rows.select(
        *key, "pos",
        squeeze(F.regexp_extract("_piece", rf"\A{HEADING}", 1)).alias("article"),
        strip(F.regexp_extract("_piece", rf"\A{HEADING}", 2)).alias("title"),
        F.md5(F.regexp_replace("_piece", r"\n\z", "").cast("binary")).alias("md5"),
    )
    return rows.groupBy(*key, "article").agg(F.max_by(F.struct("title", "pos", "md5"), "pos").alias("_last")).select(*key, "article", "_last.*")


def article_changes(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """(key..., article, title, change) with change in changed, added, removed; old and new are article tables."""
    a = old.select(*key, "article", F.col("md5").alias("_old"))
    b = new.select(*key, "article", "title", F.col("md5").alias("_new"))
    both = a.join(b, [*key, "article"], "full_outer")
    change = F.when(F.col("_old").isNull(), "added").when(F.col("_new").isNull(), "removed").when(F.col("_old") != F.col("_new"), "changed")
    return both.select(*key, "article", F.coalesce("title", F.lit("")).alias("title"), change.alias("change")).filter("change is not null")


def diff_articles(old: DataFrame, new: DataFrame, key: list[str], body: str = "body") -> DataFrame:
    """A row for each document of both snapshots: sorted changed, added and removed articles,
    addenda_changed, n_old and n_new, and a map of the titles of these articles (null without any)."""
    a, b = article_table(old, key, body), article_table(new, key, body)
    listed = [sorted_articles(F.collect_list(F.when(F.col("change") == c, F.col("article")))).alias(c) for c in ("changed", "added", "removed")]
    named = F.map_from_entries(F.array_sort(F.collect_list(F.struct("article", "title")))).alias("titles")
    lists = article_changes(a, b, key).groupBy(*key).agg(*listed, named)
    facts = old.select(*key, addenda_of(body).alias("_a")).join(new.select(*key, addenda_of(body).alias("_b")), key)
    counts = a.groupBy(*key).agg(F.count("*").alias("n_old")), b.groupBy(*key).agg(F.count("*").alias("n_new"))
    out = facts.join(lists, key, "left").join(counts[0], key, "left").join(counts[1], key, "left")
    none = F.array().cast("array<string>")
    return out.select(*key, *(F.coalesce(c, none).alias(c) for c in ("changed", "added", "removed")), (F.col("_a") != F.col("_b")).alias("addenda_changed"), F.coalesce("n_old", F.lit(0)).alias("n_old"), F.coalesce("n_new", F.lit(0)).alias("n_new"), "titles")


@F.pandas_udf(T.ArrayType(T.StringType()))
def line_diff(old: pd.Series, new: pd.Series) -> pd.Series:
    """Removed (-) and added (+) lines without context, in the order of a unified diff."""

    def one(a: list[str], b: list[str]) -> list[str]:
        out: list[str] = []
        for _, i, j, k, m in difflib.SequenceMatcher(None, a, b).get_opcodes():
            if a[i:j] != b[k:m]:
                out += [f"-{x}" for x in a[i:j]] + [f"+{x}" for x in b[k:m]]
        return out

    return pd.Series([one((a or "").splitlines(), (b or "").splitlines()) for a, b in zip(old, new)], dtype=object)


def changed_documents(old: DataFrame, new: DataFrame, key: list[str], version: str = "version_key") -> DataFrame:
    """new's rows whose version key is new: neither empty nor the old one. Deleted documents are not
    reported; a document that old lacks is. Adds old_version."""
    a = old.select(*key, F.col(version).alias("old_version"))
    out = new.join(a, key, "left")
    return out.filter((text(version) != "") & ~F.col(version).eqNullSafe(F.col("old_version")))


MANIFEST_KEY = ["kind", "no", "branch"]


def diff_manifest(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """(key..., kind, no, branch, old_title, new_title, change) of attachments, links ignored."""
    pick = lambda df, name: df.select(*key, *MANIFEST_KEY, F.col("title").alias(name))
    both = pick(old, "old_title").join(pick(new, "new_title"), [*key, *MANIFEST_KEY], "full_outer")
    change = F.when(F.col("old_title").isNull(), "added").when(F.col("new_title").isNull(), "removed").when(F.col("old_title") != F.col("new_title"), "retitled")
    return both.withColumn("change", change).filter("change is not null")


def diff_files(old: DataFrame, new: DataFrame, formats: tuple[str, ...] = SOURCE_FORMATS, path: str = "path", content: str = "sha256") -> DataFrame:
    """(path, status A/M/D) of source files by content hash; derived formats are ignored."""
    kept = lambda df, name: df.select(path, F.col(content).alias(name)).filter(F.lower(F.regexp_extract(path, r"\.([^./]+)$", 1)).isin(*formats))
    both = kept(old, "_old").join(kept(new, "_new"), path, "full_outer")
    status = F.when(F.col("_old").isNull(), "A").when(F.col("_new").isNull(), "D").when(F.col("_old") != F.col("_new"), "M")
    return both.select(path, status.alias("status")).filter("status is not null")


def file_change_profile(diff: DataFrame, path: str = "path") -> DataFrame:
    """(status, ext, n)."""
    return diff.groupBy("status", F.lower(F.regexp_extract(path, r"\.([^./]+)$", 1)).alias("ext")).agg(F.count("*").alias("n"))


def amendment_report(old: DataFrame, new: DataFrame, key: tuple[str, ...] = ("kind", "path")) -> DataFrame:
    """One row for each really amended document: versions, dates, article lists with titles, addenda
    flag and attachment changes. Its emptiness is the 'no amendment' answer."""
    key = list(key)
    now = changed_documents(old, new, key)
    keys = now.select(*key).distinct()
    then = old.join(keys, key, "left_semi")
    empty = now.select(*key, F.lit("").alias("body")).join(then.select(*key), key, "left_anti")
    before = then.select(*key, "body").unionByName(empty)
    articles = diff_articles(before, now.select(*key, "body"), key)
    own = {c: f"_doc_{c}" for c in key}  # an attachment has a kind of its own
    items = lambda df: fm.explode_manifest(df.select(*(F.col(c).alias(n) for c, n in own.items()), "header"))
    manifest = diff_manifest(items(then), items(now), [*own.values()])
    attachments = manifest.groupBy(*(F.col(n).alias(c) for c, n in own.items())).agg(F.array_sort(F.collect_list(F.struct(*MANIFEST_KEY, "change", "old_title", "new_title"))).alias("attachments"))
    dates = then.select(*key, F.col("promulgate_date").alias("old_date"))
    out = now.select(*key, "doc_title", "old_version", F.col("version_key").alias("new_version"), F.col("promulgate_date").alias("new_date"))
    return out.join(dates, key, "left").join(articles, key, "left").join(attachments, key, "left")


def attachment_label(kind: str = "kind", no: str = "no", branch: str = "branch") -> Column:
    """별표4의3 [kind]; branch 00 means none."""
    return F.concat(F.lit("별표"), fm.manifest_number(no, branch), F.lit(" ["), F.col(kind), F.lit("]"))
