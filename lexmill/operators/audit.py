"""Audits of generated answers against the chunks that they were given."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.functions.text import text, values

#: Format rules: name -> (pattern, whether it must be found) (fixed values).
RULES = {"no_citation": (r"(?m)^「근거」", True), "raw_exponent": (r"\d\s*[Ee][+-]\d|\d\s*×\s*10\s+-?\d", False), "self_correction": (r"오기|정정합니다", False)}


def unsupported_values(answers: DataFrame, chunks: DataFrame, key: tuple[str, ...] = ("qid", "model")) -> DataFrame:
    """(key..., unsupported): values of an answer that none of its chunks holds; answers without any
    chunk that exists are skipped. The numbers of a chunk are found once, however often it is cited."""
    cited = answers.select(*key, F.explode("chunk_ids").alias("chunk_id")).distinct()
    held = chunks.join(cited.select("chunk_id").distinct(), "chunk_id", "left_semi").filter(text("content") != "").select("chunk_id", values("content", strict=False).alias("_v"))
    source = cited.join(held, "chunk_id").groupBy(*key).agg(F.array_distinct(F.flatten(F.collect_list("_v"))).alias("_source"))
    out = answers.select(*key, values("answer").alias("_own")).join(source, list(key))
    return out.select(*key, F.array_sort(F.array_except("_own", "_source")).alias("unsupported"))


def format_violations(answers: DataFrame, key: tuple[str, ...] = ("qid", "model"), rules: dict[str, tuple[str, bool]] = RULES) -> DataFrame:
    """(key..., violations)."""
    broken = [F.when(text("answer").rlike(pattern) != F.lit(needed), F.lit(name)) for name, (pattern, needed) in rules.items()]
    return answers.select(*key, F.array_compact(F.array(*broken)).alias("violations"))


def audit_summary(unsupported: DataFrame, violations: DataFrame, key: tuple[str, ...] = ("qid", "model")) -> DataFrame:
    """(model, n_questions, n_format, n_flagged)."""
    both = violations.join(unsupported, list(key), "left")
    return both.groupBy("model").agg(F.count("*").alias("n_questions"), F.count_if(F.size("violations") > 0).alias("n_format"), F.count_if(F.coalesce(F.size("unsupported"), F.lit(0)) > 0).alias("n_flagged"))
