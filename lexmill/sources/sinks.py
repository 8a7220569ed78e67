"""Text artefacts that other steps consume."""

from __future__ import annotations

import posixpath
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.functions import frontmatter as fm


def shared_folder(spark: SparkSession) -> str:
    """A folder that driver and executors share: spark.checkpoint.dir, or one in the warehouse where that is unset."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_files"
    return found.rstrip("/")


def write_tree(files: DataFrame, root: str, path: str = "path", raw: str = "raw") -> int:
    """One UTF-8 file for each row, at its path below root (any address that Arrow opens); the number of files.

    A task that runs again writes the same files again.
    """

    def run(batches):
        from pyarrow import fs

        system, base = fs.FileSystem.from_uri(re.sub(r"^file:/+", "/", root))
        made: set[str] = set()
        for batch in batches:
            for one, text in zip(*(c.to_pylist() for c in batch.columns)):
                full = posixpath.join(base, one)
                if (folder := posixpath.dirname(full)) not in made:
                    system.create_dir(folder, recursive=True)
                    made.add(folder)
                with system.open_output_stream(full) as f:
                    f.write((text or "").encode())
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["n"])

    return files.select(path, raw).mapInArrow(run, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def _titled(articles: str, suffix: str) -> Column:
    title = lambda a: F.coalesce(F.try_element_at("titles", a), F.lit(""))
    return F.transform(articles, lambda a: F.concat(a, F.when(title(a) != "", F.concat(F.lit("("), title(a), F.lit(")"))).otherwise(""), F.lit(suffix)))


def amended_articles() -> Column:
    """Changed, added and removed articles of a report row, with their titles."""
    return F.concat(_titled("changed", ""), _titled("added", " 신설"), F.transform("removed", lambda a: F.concat(a, F.lit(" 삭제"))))


def attachment_lines() -> Column:
    label = lambda x: F.concat(F.lit("별표"), fm.manifest_number(x["no"], x["branch"]), F.lit(" ["), x["kind"], F.lit("] "))

    def line(x: Column) -> Column:
        return (
            F.when(x["change"] == "added", F.concat(label(x), x["new_title"], F.lit(" — 신설")))
            .when(x["change"] == "removed", F.concat(label(x), x["old_title"], F.lit(" — 삭제")))
            .otherwise(F.concat(label(x), F.lit('개정 — "'), x["old_title"], F.lit('" → "'), x["new_title"], F.lit('"')))
        )

    return F.transform(F.coalesce("attachments", F.array().cast("array<struct<kind: string, no: string, branch: string, change: string, old_title: string, new_title: string>>")), line)


def render_subject(report: DataFrame) -> DataFrame:
    """(subject): one line for a whole report."""
    rows = report.select("doc_title", amended_articles().alias("articles"), F.size(attachment_lines()).alias("n"))
    total = rows.agg(F.count("*").alias("docs"), F.sum("n").alias("n"), F.min_by(F.struct("doc_title", "articles"), "doc_title").alias("one"))
    names = report.select("doc_title").filter("doc_title is not null").orderBy("doc_title").limit(3).agg(F.array_sort(F.collect_list("doc_title")).alias("names"))
    tail = F.when(F.col("n") > 0, F.concat(F.lit(" · 별표 "), F.col("n").cast("string"), F.lit("건"))).otherwise("")
    first = F.array_join(F.slice("one.articles", 1, 2), ", ")
    single = F.concat("one.doc_title", F.lit(" "), F.when(first != "", first).otherwise("부칙"), F.when(F.size("one.articles") > 2, " 외").otherwise(""), F.lit(" 개정"), tail)
    many = F.concat(F.col("docs").cast("string"), F.lit("건 개정 — "), F.array_join(F.transform("names", lambda n: F.element_at(F.split(n, " "), 1)), ", "), tail)
    return total.crossJoin(names).select(F.when(F.col("docs") == 0, "개정 없음").when(F.col("docs") == 1, single).otherwise(many).alias("subject"))


def render_markdown(report: DataFrame) -> DataFrame:
    """(path, markdown): a block for each amended document; write.text puts them in one tree."""
    none = F.lit("(조문 변경 없음)")
    articles = F.array_join(amended_articles(), ", ")
    lines = F.array_compact(F.array(
        F.concat(F.lit("### ["), "kind", F.lit("] "), "doc_title"),
        F.concat(F.lit("- 버전 `"), F.coalesce("old_version", F.lit("")), F.lit("` → `"), "new_version", F.lit("`")),
        F.concat(F.lit("- 개정 조문: "), F.when(articles != "", articles).otherwise(none)),
        F.when(F.col("addenda_changed"), F.lit("- 부칙 변경 있음")),
        F.when(F.size(attachment_lines()) > 0, F.concat(F.lit("- **별표·서식**\n  - "), F.array_join(attachment_lines(), "\n  - "))),
        F.concat(F.lit("- `"), "path", F.lit("`")),
    ))
    return report.select("path", F.array_join(lines, "\n").alias("markdown"))


def forms_registry_markdown(registry: DataFrame) -> DataFrame:
    """(parent, markdown): a table for each parent, its rows by kind and number as strings."""
    link = lambda label, url: F.when(F.col(url) != "", F.concat(F.lit(f"[{label}]("), url, F.lit(")"))).otherwise("")
    cells = ["kind", "num", F.replace("title", F.lit("|"), F.lit("\\|")), "articles", link("원본", "orig_url"), link("PDF", "pdf_url")]
    line = F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |"))
    rows = registry.select("parent", F.struct("kind", "num", line.alias("line")).alias("row"))
    head = F.concat(F.lit("## "), "parent", F.lit("\n\n| 구분 | 번호 | 제목 | 근거조 | 원본 | PDF |\n|---|---|---|---|---|---|\n"))
    grouped = rows.groupBy("parent").agg(F.array_sort(F.collect_list("row")).alias("rows"))
    return grouped.select("parent", F.concat(head, F.array_join(F.transform("rows", lambda r: r["line"]), "\n")).alias("markdown"))
