"""Sources of documents, annexes, chunks and snapshots."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.functions import frontmatter as fm
from lexmill.functions.text import ARTICLE
from lexmill.sources.schemas import CHUNK

#: Header keys of the two document tracks (fixed values).
TRACKS = {
    "law": {"doc_title": "제목", "doc_id": "법령ID", "version_key": "법령MST", "class": "법령구분", "ministry": "소관부처", "enforce_date": "시행일자", "promulgate_date": "공포일자", "status": "상태", "source": "출처"},
    "admin_rule": {"doc_title": "행정규칙명", "doc_id": "행정규칙ID", "version_key": "행정규칙일련번호", "class": "행정규칙종류", "ministry": "소관부처명", "enforce_date": "시행일자", "promulgate_date": "발령일자", "status": "제개정구분", "source": "출처"},
}
_STEM = r"([^/]+)\.[^./]+$"


def decoded(path: Column) -> Column:
    """A file's address with its characters as they are."""
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def file_stem(path: Column) -> Column:
    return F.regexp_extract(decoded(path), _STEM, 1)


def read_text_files(spark: SparkSession, path: str, glob: str = "*.md") -> DataFrame:
    """(path, stem, raw): one row for each file; small files share a task by Spark's file packing."""
    files = spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", True).text(path, wholetext=True)
    return files.select(F.col("_metadata.file_path").alias("path"), file_stem(F.col("_metadata.file_path")).alias("stem"), F.col("value").alias("raw"))


def with_header(files: DataFrame) -> DataFrame:
    return files.withColumn("header", fm.header("raw")).withColumn("body", fm.body("raw"))


def read_documents(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """(kind, path, stem, raw, header, body) of the document trees, by kind."""
    trees = (read_text_files(spark, path).withColumn("kind", F.lit(kind)) for kind, path in paths.items())
    return with_header(reduce(DataFrame.unionByName, trees))


def normalized(docs: DataFrame, tracks: dict[str, dict[str, str]] = TRACKS, ministries: dict[str, str] = fm.MINISTRIES, levels: dict[str, str] = fm.LEVELS) -> DataFrame:
    """docs (kind, header, ...) with doc_title, doc_id, version_key, class, ministry, dates, status and source."""

    def pick(name: str) -> Column:
        read = fm.fm_list_first if name == "ministry" else fm.fm_value
        return reduce(lambda rest, kind: F.when(F.col("kind") == kind, read("header", tracks[kind][name])).otherwise(rest), tracks, F.lit(""))

    out = docs.withColumns({name: pick(name) for name in next(iter(tracks.values()))})
    out = out.withColumn("doc_id", F.when(F.col("doc_id") == "", F.col("version_key")).otherwise(F.col("doc_id")))
    return out.withColumn("ministry", fm.map_codes("ministry", ministries)).withColumn("class", fm.map_codes("class", levels))


def annex_columns(files: DataFrame) -> DataFrame:
    """(stem, title, parent_law, delegating_articles, parse_note, source_format, body) of parsed annexes."""
    rows = with_header(files)
    return rows.select(
        "stem", fm.fm_value("header", "title").alias("title"), fm.fm_value("header", "parent_law").alias("parent_law"),
        F.array_distinct(F.regexp_extract_all(fm.fm_value("header", "delegating_articles"), F.lit(ARTICLE), F.lit(0))).alias("delegating_articles"),
        fm.fm_value("header", "parse_note").alias("parse_note"), fm.fm_value("header", "source_format").alias("source_format"), "body",
    )


def read_annexes(spark: SparkSession, path: str) -> DataFrame:
    return annex_columns(read_text_files(spark, path))


def read_snapshots(spark: SparkSession, old: dict[str, str], new: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """Two states of the same trees, with path relative to its tree so that the states join on it."""

    def state(paths: dict[str, str]) -> DataFrame:
        trees = []
        for kind, path in paths.items():
            tree = re.sub(r"^\w+:/*", "/", path).rstrip("/") + "/"
            full = decoded(F.col("path"))
            relative = F.substr(full, F.call_function("locate", F.lit(tree), full) + len(tree))
            trees.append(with_header(read_text_files(spark, path).withColumn("kind", F.lit(kind))).withColumn("path", relative))
        return normalized(reduce(DataFrame.unionByName, trees))

    return state(old), state(new)


def write_chunks(chunks: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """JSON lines with nested metadata; nulls are written."""
    chunks.write.mode(mode).option("ignoreNullFields", False).json(path)


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CHUNK).json(path)
