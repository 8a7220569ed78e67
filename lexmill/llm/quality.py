"""Operator 6, a compression classifier for text quality.

`fit` builds one zstandard dictionary from good and one from bad labelled texts. The normalised
difference of the two compressed sizes becomes a score by a rising curve, fitted to the shares of good
texts among other labelled texts. The difference is a sum over the text, so its noise grows with the root of the
length, by which it is normalised; nothing else enters the score.
`score` compresses each whole text with both dictionaries: no shuffle, bounded memory.

The sample of labelled rows is bounded: about `per_class` texts of each class, drawn by the hash of
the key, of at most `longest` bytes each and about SAMPLE_BYTES together, however often keys repeat;
half of them build the dictionaries and half calibrate.
Scoring has no bound. Defined results: a null text scores as an empty one, which both dictionaries compress to almost nothing;
labels other than 0 and 1 are ignored; a key with several labels is used once for each of them; without
labelled texts of both classes every score is 0.5; equal texts get equal scores; other columns are
not read, so they cannot clash.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.llm.tables import as_bytes, drop_kept, hash_fraction, keep, listed

PER_CLASS, LONGEST, SAMPLE_BYTES = 2000, 65536, 1 << 26
DICTIONARY_BYTES, LEVEL = 32768, 3
#: Bytes added to lengths, so that the shortest texts do not stand far out.
LEAST = 16
#: Calibrating texts of a bin.
BIN = 40


@dataclass
class Model:
    good: bytes
    bad: bytes
    knots: np.ndarray | None = None
    shares: np.ndarray | None = None

    def compressors(self):
        for raw in (self.good, self.bad):
            one = zstandard.ZstdCompressionDict(raw)
            one.precompute_compress(level=LEVEL)
            yield zstandard.ZstdCompressor(level=LEVEL, dict_data=one, write_content_size=False, write_dict_id=False)


def difference(good, bad, text: bytes) -> float:
    """The difference of the sizes against the root of the length, above 0 where the good dictionary helps more."""
    return (len(bad.compress(text)) - len(good.compress(text))) / np.sqrt(len(text) + LEAST)


def _dictionary(samples: list[bytes]) -> bytes:
    """A trained dictionary, or the texts themselves where there are too few to train one."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICTIONARY_BYTES:]


def _curve(x: np.ndarray, y: np.ndarray, good: float) -> tuple[np.ndarray, np.ndarray]:
    """Knots (difference, share of label 1) of a rising curve: bins of at least BIN rows, and neighbours
    that would fall are pooled. Classes weigh as they are among all labels (good: the share of label 1), however many of each were drawn."""
    order = np.argsort(x, kind="stable")
    x, y = x[order], y[order]
    w = np.where(y == 1, good / max(1, (y == 1).sum()), (1 - good) / max(1, (y == 0).sum()))
    pools: list[list[float]] = []  # weight, weighted x, weighted y
    for part in np.array_split(np.arange(len(x)), max(1, len(x) // BIN)):
        pools.append([w[part].sum(), (w * x)[part].sum(), (w * y)[part].sum()])
        while len(pools) > 1 and pools[-2][2] * pools[-1][0] >= pools[-1][2] * pools[-2][0]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last)]
    weight, at, share = np.array(pools).T
    return at / weight, share / weight


def calibrated(x: np.ndarray, model: Model) -> np.ndarray:
    """The curve between its knots; a hundredth of the score is a logistic curve, so that greater differences always score higher."""
    spread = max(1e-6, float(model.knots[-1] - model.knots[0]))
    return 0.99 * np.interp(x, model.knots, model.shares) + 0.01 / (1 + np.exp(-np.clip(8 * (x - model.knots.mean()) / spread, -30, 30)))


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", per_class: int = PER_CLASS, longest: int = LONGEST) -> Model:
    wanted = labels.select(F.col(key).alias("key"), F.col(label).alias("label")).filter("label in (0, 1) and key is not null")
    sizes = {r["label"]: r["n"] for r in wanted.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        return Model(b"", b"")
    share = F.create_map(*(F.lit(x) for one, n in sizes.items() for x in (one, min(1.0, per_class / n))))
    drawn = wanted.filter(hash_fraction(F.col("key"), 6) < share[F.col("label")]).withColumn("half", hash_fraction(F.col("key"), 7) < 0.5)
    texts = docs.select(F.col(key).alias("key"), F.col(text).cast("binary").alias("text")).filter(F.octet_length("text").between(1, longest))
    found = keep(texts.join(listed(keep(drawn.distinct())), "key").distinct())
    # keys that repeat bring more rows than were drawn: then a share of them by their own hash
    n, size = found.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    share = min(1.0, 4 * per_class / max(1, n), SAMPLE_BYTES / max(1, size))
    rows = found.filter(hash_fraction(F.concat(F.col("key").cast("string"), F.lit(" "), F.xxhash64("text").cast("string")), 8) < share).orderBy("key", "label", "text").collect()
    drop_kept(docs.sparkSession, found)
    parts = {(c, h): [bytes(r["text"]) for r in rows if r["label"] == c and r["half"] == h] for c in (0, 1) for h in (True, False)}
    if not all(parts.values()):
        return Model(b"", b"")
    model = Model(_dictionary(parts[1, True]), _dictionary(parts[0, True]))
    good, bad = model.compressors()
    x = np.array([difference(good, bad, t) for c in (0, 1) for t in parts[c, False]])
    y = np.array([c for c in (0, 1) for _ in parts[c, False]], float)
    model.knots, model.shares = _curve(x, y, sizes[1] / (sizes[0] + sizes[1]))
    return model


def score(df: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, score, predicted, difference)."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model = shared.value
        if model.knots is not None:
            good, bad = model.compressors()
        for batch in batches:
            if not batch.num_rows:
                continue
            if model.knots is None:
                x, p = np.zeros(batch.num_rows), np.full(batch.num_rows, 0.5)
            else:
                x = np.array([difference(good, bad, t.as_py()) for t in batch.column(1)])
                p = calibrated(x, model)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p), pa.array((p >= 0.5).astype(np.int32)), pa.array(x)], names=["key", "score", "predicted", "difference"])

    rows = df.select(F.col(key).alias("key"), as_bytes(text).alias("text"))
    return rows.mapInArrow(run, f"key {dict(df.dtypes)[key]}, score double, predicted int, difference double").withColumnRenamed("key", key)
