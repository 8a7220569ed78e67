"""Which of any number of wordings stand in some text of a corpus, in two scans of it.

A wording stands in a text only if all its grams (GRAM characters in a row; a shorter wording is one
gram) do. The first scan counts the grams of the wordings in the corpus: a wording with a gram that
occurs nowhere is absent, and one of a single gram is decided. The second scan brings the surroundings
of each other wording's rarest gram, and the wording is compared with them. Which grams are asked for reaches
the tasks as a bit map of fixed size; where it fills up, more grams are brought than need be, and none fewer.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Characters of a gram, and bits of the map (8 MB).
GRAM, MAP_BITS = 8, 1 << 26
#: Different grams that a task holds before it passes their counts on.
HELD = 200_000
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def gram_places(text: str, size: int) -> np.ndarray:
    """The bit of each gram of a text."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    out = np.zeros(max(0, len(codes) - size + 1), np.uint64)
    for k in range(size):
        out = (out ^ codes[k : len(out) + k]) * _FACTOR
        out ^= out >> np.uint64(32)
    return (out % np.uint64(MAP_BITS)).astype(np.int64)


def _bit_map(grams: DataFrame) -> np.ndarray:
    """The bit map of a column of grams: MAP_BITS / 64 numbers come to the driver at most."""

    def run(batches):
        for batch in batches:
            at = np.array([gram_places(g, len(g))[0] for g in batch.column(0).to_pylist()], np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(at >> 6), pa.array((np.uint64(1) << (at & 63).astype(np.uint64)).view(np.int64))], names=["word", "bits"])

    words = grams.select("gram").mapInArrow(run, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(MAP_BITS // 64, np.int64)
    out[words["word"].to_numpy()] = words["bits"].to_numpy()
    return out


def _asked(text: str, sizes: list[int], known: np.ndarray):
    """(place, gram) of the text's grams that are on the bit map."""
    for size in sizes:
        at = gram_places(text, size)
        for k in np.flatnonzero(known[at >> 6] >> (at & 63) & 1).tolist():
            yield k, text[k : k + size]


def _grams(wordings: DataFrame) -> DataFrame:
    """(wording, offset, gram) of each wording; offset counts characters from 0."""
    last = F.length("wording") - F.least(F.length("wording"), F.lit(GRAM))
    return wordings.select("wording", F.explode(F.sequence(F.lit(0), last)).alias("offset")).withColumn("gram", F.substr("wording", F.col("offset") + 1, F.lit(GRAM)))


def standing(wordings: DataFrame, texts: DataFrame) -> DataFrame:
    """(wording) of those of wordings (wording) that stand in some row of texts (body); the empty wording stands in every text."""
    spark = texts.sparkSession
    asked = wordings.filter("wording != ''").distinct()
    sizes = [r[0] for r in asked.select(F.least(F.length("wording"), F.lit(GRAM))).distinct().collect()]
    grams = _grams(asked)
    shared = spark.sparkContext.broadcast(_bit_map(grams.select("gram").distinct()))

    def count(batches):
        counts: Counter[str] = Counter()
        for batch in batches:
            for body in batch.column(0).to_pylist():
                counts.update(g for _, g in _asked(body or "", sizes, shared.value))
                if len(counts) > HELD:
                    yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["gram", "n"])
                    counts.clear()
        if counts:
            yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["gram", "n"])

    counts = texts.select("body").mapInArrow(count, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    rarest = F.min(F.struct("n", "gram", "offset")).alias("rarest")
    alive = grams.join(counts, "gram", "left").groupBy("wording").agg(rarest, F.count_if(F.col("n").isNull()).alias("absent")).filter("absent = 0").select("wording", "rarest.gram", "rarest.offset")
    long = alive.filter(F.length("wording") > GRAM)
    size = long.agg(F.max(F.length("wording"))).first()[0]
    found = alive.filter(F.length("wording") <= GRAM).select("wording")
    if size is not None:
        some = spark.sparkContext.broadcast(_bit_map(long.select("gram").distinct()))

        def around(batches):
            for batch in batches:
                rows = {(g, body[max(0, k - size) : k], body[k : k + size]) for body in batch.column(0).to_pylist() if body for k, g in _asked(body, [GRAM], some.value)}
                columns = zip(*rows) if rows else ((),) * 3
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], names=["gram", "before", "after"])

        places = texts.select("body").mapInArrow(around, "gram string, before string, after string")
        fits = F.endswith("before", F.substr("wording", F.lit(1), F.col("offset"))) & F.startswith("after", F.substr("wording", F.col("offset") + 1))
        found = found.union(places.join(long, "gram").filter(fits).select("wording").distinct())
    anything = texts.select(F.lit("").alias("wording")).limit(1)
    return found.union(wordings.filter("wording = ''").distinct().join(anything, "wording", "left_semi"))
