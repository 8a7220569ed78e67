"""Integrity checks that fail loudly. The assert_ functions run a job and raise; the others return rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.functions.text import norm_text, numbers
from lexmill.operators.wordings import standing


class IntegrityError(ValueError):
    """Rows that must not be written."""


def duplicates(df: DataFrame, key: str = "chunk_id") -> DataFrame:
    """(key, n) of keys with several rows."""
    return df.groupBy(key).agg(F.count("*").alias("n")).filter("n > 1")


def duplicate_report(df: DataFrame, key: str = "chunk_id", doc: Column | str = "doc_id", most: int = 8) -> DataFrame:
    """(doc, n_keys, n_surplus): the documents with the most surplus rows (a report of `most` rows)."""
    doc = F.col(doc) if isinstance(doc, str) else doc
    found = df.select(F.col(key), doc.alias("doc")).groupBy(key).agg(F.count("*").alias("n"), F.min("doc").alias("doc")).filter("n > 1")
    return found.groupBy("doc").agg(F.count("*").alias("n_keys"), F.sum(F.col("n") - 1).alias("n_surplus")).orderBy(F.desc("n_surplus"), "doc").limit(most)


def assert_unique(df: DataFrame, key: str = "chunk_id") -> DataFrame:
    """df, or an error that counts the repeated keys and shows some."""
    found = duplicates(df, key)
    some = found.agg(F.count("*").alias("keys"), F.sum(F.col("n") - 1).alias("surplus")).first()
    if some["keys"]:
        samples = [r[key] for r in found.orderBy(F.desc("n"), key).limit(5).collect()]
        raise IntegrityError(f"{some['keys']} repeated values of {key}, {some['surplus']} surplus rows, such as {samples}")
    return df


def empty_documents(docs: DataFrame, articles: DataFrame, key: str = "stem") -> DataFrame:
    """Documents in which no article was found."""
    return docs.join(articles.select(key).distinct(), key, "left_anti")


def wrong_dimension(df: DataFrame, dim: int, vector: str = "embedding") -> DataFrame:
    return df.filter(F.col(vector).isNull() | (F.size(vector) != dim))


def assert_dim(df: DataFrame, dim: int, vector: str = "embedding") -> DataFrame:
    n = wrong_dimension(df, dim, vector).count()
    if n:
        raise IntegrityError(f"{n} vectors have not {dim} dimensions")
    return df


def missing_keys(questions: DataFrame, corpus: DataFrame, qid: str = "qid", keys: str = "answer_keys", body: str = "text") -> DataFrame:
    """(qid, key): answer keys of which no alternative stands in any single text of the corpus.

    Numeric keys meet the numbers of the texts by equality. Wordings are looked for by their rarest
    grams (wordings.standing), in two scans of the corpus however many there are.
    """
    from lexmill.functions.text import canon, strip

    each = questions.select(qid, F.posexplode(keys).alias("_k", "_alternatives")).select(qid, "_k", "_alternatives", F.explode("_alternatives").alias("_one"))
    each = each.withColumn("_c", strip(canon("_one"))).withColumn("_numeric", F.col("_c").rlike(r"^\d+(?:\.\d+)?(?:e-?\d+)?$")).withColumn("_plain", norm_text("_one"))
    present = corpus.select(F.explode(numbers(body)).alias("_c")).distinct()
    by_number = each.filter("_numeric").join(present, "_c", "left_semi").select(qid, "_k")
    wordings = each.filter("not _numeric and _plain is not null").select(F.col("_plain").alias("wording")).distinct()
    found = standing(wordings, corpus.select(norm_text(body).alias("body"))).withColumnRenamed("wording", "_plain")
    by_word = each.filter("not _numeric").join(found, "_plain", "left_semi").select(qid, "_k")
    lost = each.join(by_number.union(by_word).distinct(), [qid, "_k"], "left_anti")
    return lost.groupBy(qid, "_k").agg(F.first(F.array_join("_alternatives", "|")).alias("key")).select(qid, "key")


def count_check(target: DataFrame, expected: int) -> DataFrame:
    """(n_rows, expected, ok)."""
    return target.agg(F.count("*").alias("n_rows")).select("n_rows", F.lit(expected).cast("long").alias("expected"), (F.col("n_rows") == expected).alias("ok"))


def eval_coverage(questions: DataFrame, excluded: Column, keys: str = "answer_keys") -> DataFrame:
    """(state, n): questions that are excluded, keyed or without keys."""
    state = F.when(excluded, "excluded").when(F.coalesce(F.size(keys), F.lit(0)) > 0, "keyed").otherwise("unkeyed")
    return questions.groupBy(state.alias("state")).agg(F.count("*").alias("n"))


def stale_corrections(corrected: DataFrame, key: str = "stem") -> DataFrame:
    return corrected.filter("correction = 'correction_stale'").select(key)


def name_collisions(plan: DataFrame) -> DataFrame:
    """(base, type, n_urls): one file name for several links."""
    return plan.groupBy("base", "type").agg(F.countDistinct("url").alias("n_urls")).filter("n_urls > 1")
