"""A training-data pipeline over `documents`: five stages, each one operator over all that its predecessor kept.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written and read again before
the next. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.llm import decontaminate, language, near_duplicates, packing, queries, suffix_dedup
from lexmill.llm.tables import columns, drop_kept, keep, named, small_batches

#: Least share of its main language that a kept document has.
MAIN_LANGUAGE = 0.5


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a language of their own (no letters, or no main language), and gives
    the others the language found. The model learns from the labelled rows of docs."""
    small_batches(spark)
    model = language.fit(docs)
    found = language.predict(docs, model, carry=tuple(c for c in docs.columns if c not in ("doc_id", "lang")))
    kept = found.filter((F.col("lang_pred") != language.UNDETERMINED) & (F.col("score") >= MAIN_LANGUAGE))
    return kept.withColumn("lang", F.col("lang_pred")).select(columns(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row, the one with the least id, of each group that similarity of 0.8 over five-word
    shingles links; documents without an id or without words stay, and of rows that repeat both id and
    text one stays. Rows that share an id but not their text are documents of their own."""
    small_batches(spark)
    return near_duplicates.first_of_each(docs, words=near_duplicates.WORDS, percent=near_duplicates.PERCENT)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes repeated substrings from the texts; documents that have no word left go."""
    small_batches(spark)
    out = suffix_dedup.remove_repeats(docs).filter(F.col("text").rlike(r"\S"))
    return out.select(*(F.length("text").cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else named(c) for c in docs.columns))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that overlap with a benchmark item; each row is judged by its own text, whatever its id."""
    small_batches(spark)
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places every token of the kept documents in sequences."""
    small_batches(spark)
    return queries.packed(docs)


STAGES = [
    ("language ID", identify_language),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("suffix-array dedup", drop_repeats),
    ("benchmark decontamination", drop_contaminated),
    ("best-fit packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; each result is written to the shared folder in between."""
    docs, written = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for _, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir))
        drop_kept(spark, *written)
        written = [docs]
    return STAGES[-1][1](spark, docs, sf_dir)


#: The stages hash, sort and tokenize in ways that SQL cannot express; tests compare them with brute force.
ORACLE_SQL = None
