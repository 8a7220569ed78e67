"""Operator 3, language identification as a multilingual mixture.

`fit` counts hashed byte trigrams by language on a bounded sample of labelled texts, as a Spark
aggregation. `predict` gives each whole text its language proportions: expectation-maximisation
over the n-gram likelihoods, with the set of languages chosen by penalised likelihood. The model is
an array of (languages, BUCKETS) numbers, 256 KB for each label value, so what is broadcast grows with
the languages and not with the data. Prediction has no shuffle.

Defined results: a text that is null or has no letter is `und` with score 0; training skips null
texts and null languages; equal texts get equal results; an empty training table makes every text
`und`; only the key and text columns are read, so other columns cannot clash.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.llm.hashing import mix
from lexmill.llm.tables import hash_fraction, named, release

#: Hash buckets of the byte trigrams; labelled texts expected per language.
BUCKETS, SAMPLE_PER_LANGUAGE = 1 << 15, 3000
#: Change of a share at which expectation-maximisation ends; nats that one more language must gain per log of the length.
TOLERANCE, PENALTY = 1e-5, 2.0
UNDETERMINED = "und"

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def trigram_buckets(text: bytes) -> np.ndarray:
    """The bucket of each byte trigram; A-Z lower-cased, digits and ASCII marks read as blanks."""
    a = np.frombuffer(b" " + text + b" ", np.uint8)
    a = np.where((a < 128) & ~(((a | 32) >= 97) & ((a | 32) <= 122)), 32, _LOWER[a]).astype(np.uint32)
    code = (a[:-2] << 16) | (a[1:-1] << 8) | a[2:]
    code = code[(a[1:-1] != 32) | (a[:-2] != 32)]
    return (code * np.uint32(0x9E3779B1)) >> np.uint32(17)


@dataclass
class Model:
    languages: list[str]
    log_p: np.ndarray

    def proportions(self, text: bytes) -> tuple[np.ndarray, float]:
        """The share of each language, and the probability of the best one against the others alone."""
        counts = np.bincount(trigram_buckets(text), minlength=BUCKETS)
        used = np.flatnonzero(counts)
        k = len(self.languages)
        if not len(used):
            return np.full(k, 1 / k), 0.0
        n, log_p = counts[used].astype(float), self.log_p[:, used]
        alone = log_p @ n
        top = log_p.max(axis=0)
        p = np.exp(log_p - top)
        best = int(alone.argmax())
        odds = 1 / np.exp(np.minimum(700, alone - alone[best])).sum() if k < 2 else float(1 / np.exp(np.maximum(-700, alone - alone[best])).sum())
        everything, _ = _em(p, n, np.full(k, 1 / k))
        order = np.argsort(-everything, kind="stable")
        chosen, penal = np.array([best]), PENALTY * np.log(n.sum() + 1)
        shares, gained = np.ones(1), alone[best] - top @ n
        for m in range(2, k + 1):
            more, fit = _em(p[order[:m]], n, np.full(m, 1 / m))
            if fit - gained <= penal:
                break
            chosen, shares, gained = order[:m], more, fit
        out = np.zeros(k)
        out[chosen] = shares
        return out, float(odds)


def _em(p: np.ndarray, n: np.ndarray, share: np.ndarray) -> tuple[np.ndarray, float]:
    change = 1.0
    while change > TOLERANCE:
        of = share @ p
        last, share = share, share * (p @ (n / of)) / n.sum()
        change = np.abs(share - last).max()
    return share, float(np.log(np.maximum(share @ p, 1e-300)) @ n)


def fit(labelled: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", per_language: int = SAMPLE_PER_LANGUAGE) -> Model:
    """Learns from about per_language texts of each language, drawn by the hash of their key."""
    rows = labelled.select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(lang).alias("lang")).filter("text is not null and lang is not null")
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return Model([], np.zeros((0, BUCKETS)))
    share = F.create_map(*(F.lit(x) for lang_, n in sizes.items() for x in (lang_, min(1.0, per_language / n))))
    sample = rows.filter(hash_fraction(F.col("key"), 3) < share[F.col("lang")]).select("lang", F.col("text").cast("binary").alias("text"))

    def count(batches):
        seen: dict[str, np.ndarray] = {}
        for batch in batches:
            for one, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                seen.setdefault(one, np.zeros(BUCKETS, np.int64))
                seen[one] += np.bincount(trigram_buckets(data.as_py()), minlength=BUCKETS)
        for one, counts in seen.items():
            used = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array([one] * len(used)), pa.array(used), pa.array(counts[used])], names=["lang", "bucket", "n"])

    counted = sample.mapInArrow(count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(sizes)
    table = np.full((len(languages), BUCKETS), 0.1)
    table[counted["lang"].map({x: k for k, x in enumerate(languages)}).to_numpy(int), counted["bucket"].to_numpy(int)] += counted["n"].to_numpy(float)
    return Model(languages, np.log(table / table.sum(axis=1, keepdims=True)))


def predict(df: DataFrame, model: Model, key: str = "doc_id", text: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """(key, lang_pred, score, languages): languages holds the chosen set with its proportions.

    The columns named in carry come along under their own names, without a join.
    """
    spark = df.sparkSession
    carried = [f"carried{k}" for k in range(len(carry))]
    shared = spark.sparkContext.broadcast(model)
    out_type = pa.struct([("lang", pa.string()), ("share", pa.float64())])

    def run(batches):
        model = shared.value
        for batch in batches:
            names, scores, sets = [], [], []
            for data, lettered in zip(batch.column(1), batch.column(2).to_pylist()):
                if not lettered or not model.languages:
                    names.append(UNDETERMINED), scores.append(0.0), sets.append([])
                    continue
                share, odds = model.proportions(data.as_py())
                best = int(share.argmax())
                names.append(model.languages[best])
                scores.append(float(min(1.0, max(0.0, share[best] * odds if share[best] == 1 else share[best]))))
                sets.append([{"lang": model.languages[k], "share": float(share[k])} for k in np.argsort(-share, kind="stable") if share[k] > 0])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(sets, pa.list_(out_type)), *batch.columns[3:]], names=["key", "lang_pred", "score", "languages", *carried])
        release()

    rows = df.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"), *(named(c).alias(k) for c, k in zip(carry, carried)))
    rows = rows.select("key", F.col("text").cast("binary").alias("text"), F.col("text").rlike(r"\p{L}").alias("lettered"), *carried)
    schema = f"key {dict(df.dtypes)[key]}, lang_pred string, score double, languages array<struct<lang: string, share: double>>"
    out = rows.mapInArrow(run, ", ".join([schema, *(f"{k} {dict(df.dtypes)[c]}" for c, k in zip(carry, carried))]))
    return out.withColumnsRenamed({"key": key} | dict(zip(carried, carry)))
