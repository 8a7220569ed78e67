"""Comparing our own diffs with an authority's, and grouping the authority's fragments by article."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexmill.functions.markup import feed_plain
from lexmill.functions.text import article_from_parts, sorted_articles, text

IN_TEXT = r"(?U)제\s*(\d+)\s*조(?:\s*의\s*(\d+))?"


def first_article(c: Column | str, start: bool = False) -> Column:
    """The first article number of a text ('' for none); start: only where the text begins with it."""
    pattern = ("^" if start else "") + IN_TEXT
    c = text(c)
    return article_from_parts(F.regexp_extract(c, pattern, 1), F.nullif(F.regexp_extract(c, pattern, 2), F.lit("")))


def last_version_change(revisions: DataFrame, path: str = "path", seq: str = "seq", rev: str = "rev", version: str = "version", limit: int = 40) -> DataFrame:
    """(path, old_rev, new_rev): the latest neighbours of the last `limit` revisions whose version differs."""
    latest = Window.partitionBy(path).orderBy(F.desc(seq))
    recent = revisions.withColumn("_n", F.row_number().over(latest)).filter(F.col("_n") <= limit)
    pairs = recent.withColumn("_old_rev", F.lead(rev).over(latest)).withColumn("_old", F.lead(version).over(latest))
    pairs = pairs.filter(F.col("_old_rev").isNotNull() & ~F.col(version).eqNullSafe(F.col("_old")))
    return pairs.groupBy(path).agg(F.max_by(F.struct(F.col("_old_rev").alias("old_rev"), F.col(rev).alias("new_rev")), seq).alias("_p")).select(path, "_p.*")


def reconcile(ours: DataFrame, authority: DataFrame, key: list[str]) -> DataFrame:
    """(key..., article, verdict): AGREE, SELF_ONLY or API_ONLY for each article that either side names."""
    a = ours.select(*key, "article").distinct().withColumn("_ours", F.lit(True))
    b = authority.select(*key, "article").distinct().withColumn("_theirs", F.lit(True))
    both = a.join(b, [*key, "article"], "full_outer")
    verdict = F.when(F.col("_theirs").isNull(), "SELF_ONLY").when(F.col("_ours").isNull(), "API_ONLY").otherwise("AGREE")
    return both.select(*key, "article", verdict.alias("verdict"))


def reconcile_totals(verdicts: DataFrame) -> DataFrame:
    return verdicts.groupBy("verdict").agg(F.count("*").alias("n"))


def pair_match(ours: DataFrame, authority: DataFrame, key: list[str]) -> DataFrame:
    """Whether the authority compared with the same previous version: (key..., pair_match)."""
    a = ours.select(*key, F.col("old_version").alias("_a"))
    return a.join(authority.select(*key, F.col("old_version").alias("_b")), key).select(*key, F.col("_a").eqNullSafe(F.col("_b")).alias("pair_match"))


def impact(changed: DataFrame, edges: DataFrame, key: list[str]) -> DataFrame:
    """(key..., article, layer, linked): the linked articles of every changed article; layer null for none."""
    found = changed.select(*key, "article").distinct().join(edges, [*key, "article"], "left")
    return found.groupBy(*key, "article", "layer").agg(sorted_articles(F.collect_set("linked")).alias("linked"))


def carry_forward(rows: DataFrame, key: list[str], seq: str, value: Column, out: str, parts: int = 16) -> DataFrame:
    """rows with `out`, the last value that is not null at or before each row in the order of seq within its key.

    A record is dealt out at up to `parts` places of seq, so one with a large share of all rows fills no
    task: each stretch is filled by itself, and the rows before its first value take what the stretches
    before it end with. Where seq is no number a record is filled as a whole.
    """
    valued = rows.withColumn(out, value)
    at = F.lit(0)
    if parts > 1 and dict(rows.dtypes)[seq].split("(")[0] in ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal"):
        places = sorted(set(rows.select(F.col(seq).cast("double").alias("s")).approxQuantile("s", [k / parts for k in range(1, parts)], 0.01)))
        at = F.size(F.filter(F.array(*map(F.lit, places)).cast("array<double>"), lambda p: p < F.col(seq).cast("double"))) if places else at
    dealt = valued.withColumn("_part", at)
    so_far = Window.partitionBy(*key, "_part").orderBy(seq).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    filled = dealt.withColumn("_own", F.last(out, ignorenulls=True).over(so_far))
    ends = dealt.groupBy(*key, "_part").agg(F.max_by(out, F.when(F.col(out).isNotNull(), F.col(seq))).alias("_end"))
    before = Window.partitionBy(*key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.withColumn("_before", F.last("_end", ignorenulls=True).over(before)).filter("_before is not null").select(*key, "_part", "_before")
    told = filled.filter("_own is not null").withColumn(out, F.col("_own")).select(*rows.columns, out)
    same = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in (*key, "_part")]
    rest = filled.filter("_own is null").alias("l").join(carried.alias("r"), reduce(and_, same), "left")
    return told.unionByName(rest.select(*(F.col(f"l.{c}") for c in rows.columns), F.col("_before").alias(out)))


def group_fragments(fragments: DataFrame, key: list[str], seq: str = "seq", fragment: str = "text") -> DataFrame:
    """(key..., article, seq, text): a fragment that begins with an article number opens that article;
    fragments before the first one, and empty ones, go. A long record is read by several tasks."""
    plain = fragments.select(*key, seq, F.trim(text(fragment)).alias("text")).filter("text != ''")
    head = F.nullif(first_article(feed_plain("text"), start=True), F.lit(""))
    return carry_forward(plain, key, seq, head, "article").filter("article is not null").select(*key, "article", seq, "text")


def align_old_new(grouped: DataFrame, key: list[str], side: str = "side", seq: str = "seq") -> DataFrame:
    """(key..., article, old, new): the ordered texts of both sides of each article."""
    texts = lambda s: F.transform(F.array_sort(F.collect_list(F.when(F.col(side) == s, F.struct(seq, "text")))), lambda x: x["text"]).alias(s)
    return grouped.groupBy(*key, "article").agg(texts("old"), texts("new"))


def three_way_edges(links: DataFrame, key: list[str], fragment: str = "text") -> DataFrame:
    """(key..., article, layer, linked): distinct articles that the first 40 characters of linked texts name."""
    rows = links.withColumn("linked", first_article(F.substring(feed_plain(fragment), 1, 40))).filter("linked != ''")
    return rows.select(*key, article_from_parts("article_no", "branch").alias("article"), "layer", "linked").filter("article != ''").distinct()
