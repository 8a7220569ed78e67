"""Sources of watchlists, corrections and XML feeds."""

from __future__ import annotations

import tomllib
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.sources.schemas import CORRECTION, FEED, MEMBER, RULE


def load_watchlist(path: str) -> dict[str, Any]:
    """A configuration file of some dozens of rows, read where the driver runs."""
    with open(path, encoding="utf-8") as f:
        return parse_watchlist(f.read())


def parse_watchlist(config: str) -> dict[str, Any]:
    return tomllib.loads(config)


def watchlist_members(spark: SparkSession, config: dict[str, Any]) -> DataFrame:
    """(family, name, type, law_id, tier, why, watch): members with what they inherit; tier core by default."""
    families = [(f.get("act"), f.get("tier"), f.get("why"), f.get("watch_articles", []), [(m.get("name"), m.get("type"), m.get("law_id")) for m in f.get("members", [])]) for f in config.get("family", [])]
    schema = "act string, tier string, why string, watch array<string>, members array<struct<name: string, type: string, law_id: string>>"
    rows = spark.createDataFrame(families, schema).select(F.col("act").alias("family"), F.coalesce("tier", F.lit("core")).alias("tier"), "why", "watch", F.explode("members").alias("m"))
    return rows.select(*(F.col(f"m.{c}") if c in ("name", "type", "law_id") else F.col(c) for c in (x.split()[0] for x in MEMBER.split(", "))))


def watchlist_rules(spark: SparkSession, config: dict[str, Any]) -> DataFrame:
    names = [x.split()[0] for x in RULE.split(", ")]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in config.get("admrule", [])], RULE)


def read_corrections(spark: SparkSession, path: str) -> DataFrame:
    """(stem, reason, source_format, date, rules) of a correction overlay."""
    schema = f"corrections map<string, struct<{', '.join(f.replace(' ', ': ', 1) for f in CORRECTION.split(', ', 3))}>>"
    return spark.read.schema(schema).json(path, multiLine=True).select(F.explode("corrections").alias("stem", "c")).select("stem", "c.*")


def natural_order(name: Column) -> Column:
    """A string by which names sort with their numbers as numbers: page 9 before page 10."""
    parts = F.regexp_extract_all(name, F.lit(r"\d+|\D+"), F.lit(0))
    return F.array_join(F.transform(parts, lambda p: F.when(p.rlike(r"^\d{1,19}$"), F.lpad(p, 20, "0")).otherwise(p)), "")


def read_version_feed(spark: SparkSession, path: str, row_tag: str = "law") -> DataFrame:
    """The feed's columns by name, trimmed, '' for missing, with seq, which sorts as the feed does: by page (file
    name, numbers as numbers), by place of a split in it, then by record. Spark deals files by size, so the
    order of rows or of row ids alone says nothing about the feed's."""
    schema = ", ".join(f"`{tag}` string" for tag in FEED)
    rows = spark.read.format("xml").option("rowTag", row_tag).schema(schema).load(path)
    seq = F.struct(natural_order(F.col("_metadata.file_path")).alias("page"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("row"))
    return rows.select(*(F.coalesce(F.trim(F.col(f"`{tag}`")), F.lit("")).alias(name) for tag, name in FEED.items()), seq.alias("seq"))


RULE_XML = (
    "`행정규칙기본정보` struct<`행정규칙명`: string, `행정규칙종류`: string, `발령번호`: string, `발령일자`: string, `시행일자`: string, `소관부처명`: string, `담당부서기관명`: string, `행정규칙일련번호`: string, `현행여부`: string>, "
    "`조문내용` array<string>, `부칙` struct<`부칙내용`: array<string>>"
)


def rules_from_xml(df: DataFrame, xml: str = "xml") -> DataFrame:
    """(doc_title, class, promulgate_date, enforce_date, ministry, version_key, current, body) of rule records."""
    r = df.select(F.from_xml(xml, F.lit(RULE_XML)).alias("r"))
    info = lambda k: F.coalesce(F.trim(F.col(f"r.`행정규칙기본정보`.`{k}`")), F.lit(""))
    clean = lambda c: F.filter(F.transform(F.coalesce(F.col(c), F.array().cast("array<string>")), lambda x: F.trim(x)), lambda x: x.isNotNull() & (x != ""))
    addenda = F.array_join(clean("r.`부칙`.`부칙내용`"), "\n")
    body = F.concat(F.array_join(clean("r.`조문내용`"), "\n\n"), F.when(addenda != "", F.concat(F.lit("\n\n## 부칙\n\n"), addenda)).otherwise(""))
    return r.select(info("행정규칙명").alias("doc_title"), info("행정규칙종류").alias("class"), info("발령일자").alias("promulgate_date"), info("시행일자").alias("enforce_date"), info("소관부처명").alias("ministry"), info("행정규칙일련번호").alias("version_key"), info("현행여부").alias("current"), body.alias("body"))


_SIDE = "struct<`조문`: array<string>>"
_SIDE_INFO = "struct<`법령일련번호`: string, `법령ID`: string, `법령명`: string, `공포일자`: string, `시행일자`: string, `공포번호`: string, `제개정구분명`: string, `현행여부`: string>"
OLD_NEW_XML = f"`구조문_기본정보` {_SIDE_INFO}, `신조문_기본정보` {_SIDE_INFO}, `구조문목록` {_SIDE}, `신조문목록` {_SIDE}"


def read_old_new(df: DataFrame, key: str = "mst", xml: str = "xml") -> tuple[DataFrame, DataFrame]:
    """fragments (key, side, seq, text) and infos (key, side, mst, law_id, name, ...) of comparison records."""
    r = df.select(key, F.from_xml(xml, F.lit(OLD_NEW_XML)).alias("r"))
    fragments = [r.select(key, F.lit(side).alias("side"), F.posexplode(f"r.`{tag}목록`.`조문`").alias("seq", "text")) for side, tag in (("old", "구조문"), ("new", "신조문"))]
    names = {"법령일련번호": "side_mst", "법령ID": "law_id", "법령명": "name", "공포일자": "promulgated", "시행일자": "effective", "공포번호": "no", "제개정구분명": "revision", "현행여부": "current"}
    infos = [r.select(key, F.lit(side).alias("side"), *(F.col(f"r.`{tag}_기본정보`.`{k}`").alias(v) for k, v in names.items())) for side, tag in (("old", "구조문"), ("new", "신조문"))]
    return fragments[0].unionByName(fragments[1]), infos[0].unionByName(infos[1])


def read_three_way(df: DataFrame, key: str = "mst", xml: str = "xml", base: str = "법률조문", layers: tuple[str, ...] = ("시행령", "시행규칙", "위임행정규칙", "법률")) -> DataFrame:
    """(key, article_no, branch, title, layer, seq, text): linked texts of each base article."""
    lists = ", ".join(f"`{layer}조문목록`: struct<`{layer}조문`: array<string>>" for layer in layers)
    schema = f"`삼단비교` struct<`{base}`: array<struct<`조번호`: string, `조가지번호`: string, `조제목`: string, {lists}>>>"
    rows = df.select(key, F.explode(F.from_xml(xml, F.lit(schema))["삼단비교"][base]).alias("b"))
    per_layer = F.array(*(F.struct(F.lit(layer).alias("layer"), F.col(f"b.`{layer}조문목록`.`{layer}조문`").alias("texts")) for layer in layers))
    each = rows.select(key, F.col("b.`조번호`").alias("article_no"), F.coalesce("b.`조가지번호`", F.lit("00")).alias("branch"), F.coalesce("b.`조제목`", F.lit("")).alias("title"), F.explode(per_layer).alias("l"))
    return each.select(key, "article_no", "branch", "title", "l.layer", F.posexplode("l.texts").alias("seq", "text"))
