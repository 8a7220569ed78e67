"""Operator 11, phrase collocations by FM-indexes over word ids.

Texts, A-Z lower-cased, are cut at `[.,;:!?\\x0A-\\x0D]` into pieces and these at spaces and tabs into
words. Within a language, a phrase of two or three words that occurs often enough is scored by its
worst cut: 1000000 * a * a / (l * r), where a, l and r count the phrase and both its parts.

1. Each task turns its texts into shards of some SHARD words: word ids of the shard's own vocabulary, with
   a separator between pieces. Vocabularies are summed over all shards; what occurs too seldom becomes a separator.
2. Each shard is indexed: the Burrows-Wheeler transforms of its ids and of their reverse, sorted as deep
   as an extension needs. The index is written, and all phrases are counted from it.
3. Left extension: the last-to-first mapping deals the rows of the words' intervals to the intervals of the
   two-word phrases, which are carried along in the reverse index. Counts are summed across shards.
4. Right extension, in the reverse index, of the phrases that are frequent over all shards, by words that
   make a frequent phrase with the last word (no other can be frequent). Summed across shards again.
5. Scores join the counts of parts; all arithmetic is in whole decimals of 38 digits.

What moves are counts by word ids, and each shard twice; texts never do, and no word or language is gathered in one task.
The first ranks of a language are found in parts, then among the parts' first ones.

Defined results: null and empty texts have no words; a null language is `und`, like that value itself;
repeated rows count each time; ties go by count, then by the phrase's bytes; an empty table gives no
rows; other columns are not read, so they cannot clash. Long texts are cut into several shards where a
piece ends, so a task's memory follows the longest run of words without an end of piece.
"""

from __future__ import annotations

from itertools import count

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexmill.llm.tables import as_bytes, drop_kept, keep, release

LEAST, TOP = 10, 2000
#: A phrase goes if a longer one that holds it has this share of its count, in percent.
INSIDE = 50
#: Words of a shard, bytes of text that are split at once, and parts of a language that are ranked for themselves.
SHARD, SPLIT, PARTS = 1 << 21, 1 << 20, 64
NO_LANGUAGE = "und"

_END = b"\xff"  # in no UTF-8 text
_TABLE = bytes(32 if c == 9 else _END[0] if c in b".,;:!?\n\x0b\x0c\r" else c for c in range(256)).lower()


class Vocabulary(dict):
    """Words to ids; a new word takes the next id."""

    def __init__(self, numbers):
        super().__init__({_END: 0})
        self.numbers = numbers

    def __missing__(self, word: bytes) -> int:
        self[word] = number = next(self.numbers)
        return number


def _stretches(text: bytes):
    """(tokens, whether a piece ends behind them): the text in stretches of about SPLIT bytes, cut behind a piece or else between words."""
    data, start = text.translate(_TABLE), 0
    while start < len(data):
        stop = len(data)
        if stop - start > SPLIT:
            found = [k + 1 for k in (data.find(_END, start + SPLIT, start + 2 * SPLIT), data.find(b" ", start + SPLIT)) if k >= 0]
            stop = found[0] if found else stop
        yield data[start:stop].replace(_END, b" \xff ").split(), stop == len(data) or data[stop - 1] == _END[0]
        start = stop


def _packed(ids: np.ndarray, kind: str) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(ids.astype(kind).tobytes())


def _unpacked(data: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), kind)


def shards(df: DataFrame, text: str, lang: str, size: int = SHARD) -> DataFrame:
    """For each shard one row with its ids (shard, ids), and one with each word (shard, local, lang, word, n)."""
    rows = df.select(F.coalesce(F.col(lang), F.lit(NO_LANGUAGE)).alias("lang"), as_bytes(text).alias("text"))

    def run(batches):
        part, number = TaskContext.get().partitionId(), count()

        def closed(vocabularies, parts):
            shard = part << 32 | next(number)
            ids = np.concatenate(parts)
            n = np.bincount(ids)
            words = [(lang, word, k) for lang, held in vocabularies.items() for word, k in held.items() if k]
            local = np.array([k for _, _, k in words], np.int64)
            columns = [pa.array(np.full(len(words), shard)), pa.array(local), pa.array([x for x, _, _ in words], pa.string()), pa.array([x for _, x, _ in words], pa.binary()).cast(pa.string()), pa.array(n[local])]
            yield pa.RecordBatch.from_arrays([*columns, pa.nulls(len(words), pa.binary())], names=names)
            packed = pa.array([_packed(ids, "<i4")], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array([shard]), pa.nulls(1, pa.int64()), pa.nulls(1, pa.string()), pa.nulls(1, pa.string()), pa.nulls(1, pa.int64()), packed], names=names)

        vocabularies, numbers, parts, held = {}, count(1), [], 0
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for tokens, ends in _stretches(text):
                    if lang not in vocabularies:
                        vocabularies[lang] = Vocabulary(numbers)
                    parts.append(np.fromiter(map(vocabularies[lang].__getitem__, tokens), np.int32, len(tokens)))
                    held += len(tokens)
                    if ends:
                        parts.append(np.zeros(1, np.int32))
                        if held >= size:
                            yield from closed(vocabularies, parts)
                            vocabularies, numbers, parts, held = {}, count(1), [], 0
        if held:
            yield from closed(vocabularies, parts)
        release()

    names = ["shard", "local", "lang", "word", "n", "ids"]
    return rows.mapInArrow(run, "shard long, local long, lang string, word string, n long, ids binary")


# --- the index of a shard ------------------------------------------------------------------------


def transform(ids: np.ndarray) -> np.ndarray:
    """The Burrows-Wheeler transform of ids as a ring, its rows sorted by two words: enough for intervals of two and counts of three."""
    order = np.argsort(ids.astype(np.int64) << 32 | np.roll(ids, -1), kind="stable")
    return ids[order - 1]


def pair_intervals(bwt: np.ndarray) -> tuple[np.ndarray, ...]:
    """(x, y, n, low) of each two-word phrase: its count, and where its interval in the reverse index begins.

    In the order of the last-to-first mapping the rows of one word x lie together, and among them those of one
    next word y: the intervals of x y. In the reverse index the interval of y is divided by x in the same way.
    """
    order = np.argsort(bwt, kind="stable")
    x = bwt[order]
    y = np.repeat(np.arange(int(bwt.max(initial=0)) + 1), np.bincount(bwt))[order]  # a row's first word
    first = np.flatnonzero(np.concatenate([[True], (x[1:] != x[:-1]) | (y[1:] != y[:-1])])) if len(bwt) else np.zeros(0, np.int64)
    n = np.diff(np.append(first, len(bwt)))
    x, y = x[first].astype(np.int64), y[first].astype(np.int64)
    turned = np.lexsort((x, y))
    low = np.empty_like(n)
    low[turned] = np.cumsum(n[turned]) - n[turned]
    real = (x > 0) & (y > 0)
    return x[real], y[real], n[real], low[real]


def right_extensions(reverse: np.ndarray, x: np.ndarray, y: np.ndarray, n: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, ...]:
    """(x, y, z, n): the extensions of these phrases, in the order of x and y, by a word z for which y z is one of them too."""
    which = np.repeat(np.arange(len(n)), n)
    z = reverse[np.repeat(low - np.cumsum(n) + n, n) + np.arange(len(which))].astype(np.int64)
    real = _among(y[which] << 32 | z, x << 32 | y)
    code, n = np.unique(which[real] << 32 | z[real], return_counts=True)
    which, z = code >> 32, code & 0xFFFFFFFF
    return x[which], y[which], z, n


def _among(codes: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    if not len(wanted):
        return np.zeros(len(codes), bool)
    at = np.searchsorted(wanted, codes)
    at[at == len(wanted)] = 0
    return wanted[at] == codes


def _indexed(left: pa.Table, right: pa.Table) -> pa.Table:
    """left: a shard (shard, ids); right: its frequent words (of, local, gid)."""
    ids = _unpacked(left["ids"][0].as_py(), "<i4")
    gids, local = right["gid"].to_numpy(), right["local"].to_numpy()
    order = np.argsort(gids)
    number = np.zeros(int(ids.max(initial=0)) + 1, np.int32)
    number[local[order]] = np.arange(1, len(order) + 1)
    ids = number[ids]
    goes = np.zeros(len(ids), bool)
    goes[1:] = (ids[1:] == 0) & (ids[:-1] == 0)
    ids = ids[~goes]
    packed = [_packed(gids[order], "<i8"), _packed(transform(ids), "<i4"), _packed(transform(ids[::-1]), "<i4")]
    release()
    return pa.table([left["shard"], *(pa.array([p], pa.binary()) for p in packed)], names=["shard", "gids", "bwt", "reverse"])


def _pairs(batches):
    """A shard's phrases (shard, j, x, y, n): j counts them in the order of the index."""
    for batch in batches:
        for shard, gids, bwt in zip(*(batch.column(c).to_pylist() for c in ("shard", "gids", "bwt"))):
            gids = _unpacked(gids, "<i8")
            x, y, n, _ = pair_intervals(_unpacked(bwt, "<i4"))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), shard)), pa.array(np.arange(len(x))), pa.array(gids[x - 1]), pa.array(gids[y - 1]), pa.array(n)], names=["shard", "j", "x", "y", "n"])
    release()


def _triples(left: pa.Table, right: pa.Table) -> pa.Table:
    """left: a shard's index; right: which of its phrases are frequent over all shards (shard, j)."""
    if not left.num_rows or not right.num_rows:
        return pa.table([pa.array([], pa.int64())] * 4, names=["x", "y", "z", "n"])
    gids, bwt, reverse = (_unpacked(left[c][0].as_py(), kind) for c, kind in (("gids", "<i8"), ("bwt", "<i4"), ("reverse", "<i4")))
    some = np.sort(right["j"].to_numpy())
    x, y, z, n = right_extensions(reverse, *(c[some] for c in pair_intervals(bwt)))
    release()
    return pa.table([pa.array(gids[k - 1]) for k in (x, y, z)] + [pa.array(n)], names=["x", "y", "z", "n"])


# --- counts over all shards ----------------------------------------------------------------------


def phrase_counts(df: DataFrame, text: str, lang: str, least: int, shard: int) -> tuple[DataFrame, ...]:
    """Kept tables of what occurs `least` times at least: words (gid, lang, word, f), pairs (x, y, a) and
    triples (x, y, z, a) of gids; and languages (lang, total), the number of all words.

    A word or phrase has one row in a shard, so the rows of one, which a window sums, are as many as shards at most. The
    window leaves each shard its rows, so sums need not be brought back to them by a join.
    """
    spark = df.sparkSession
    cut = keep(shards(df, text, lang, shard))
    vocabulary = cut.filter("word is not null").select("shard", "local", "lang", "word", "n", F.monotonically_increasing_id().alias("uid"))
    totals = keep(vocabulary.groupBy("lang").agg(F.sum("n").alias("total")))
    one = Window.partitionBy("lang", "word")
    summed = vocabulary.withColumn("f", F.sum("n").over(one)).withColumn("gid", F.min("uid").over(one)).filter(F.col("f") >= least)
    known = keep(summed.select(F.col("shard").alias("of"), "local", "gid", (F.col("uid") == F.col("gid")).alias("first"), *(F.when(F.col("uid") == F.col("gid"), F.col(c)).alias(c) for c in ("lang", "word", "f"))))
    words = keep(known.filter("first").select("gid", "lang", "word", "f"))
    ids = cut.filter("ids is not null").select("shard", "ids")
    index = keep(ids.groupBy("shard").cogroup(known.select("of", "local", "gid").groupBy("of")).applyInArrow(_indexed, "shard long, gids binary, bwt binary, reverse binary"))
    drop_kept(spark, cut, known)
    found = index.select("shard", "gids", "bwt").mapInArrow(_pairs, "shard long, j long, x long, y long, n long")
    frequent = keep(found.withColumn("a", F.sum("n").over(Window.partitionBy("x", "y"))).filter(F.col("a") >= least).select("shard", "j", "x", "y", "a"))
    pairs = keep(frequent.select("x", "y", "a").distinct())
    longer = index.groupBy("shard").cogroup(frequent.select(F.col("shard").alias("of"), "j").groupBy("of")).applyInArrow(_triples, "x long, y long, z long, n long")
    triples = keep(longer.groupBy("x", "y", "z").agg(F.sum("n").alias("a")).filter(F.col("a") >= least))
    drop_kept(spark, index, frequent)
    return words, pairs, triples, totals


def _score(a: Column, left: Column, right: Column) -> Column:
    exact = lambda c: c.cast("decimal(19,0)")
    over = exact(a) * exact(a) * F.lit(1_000_000).cast("decimal(7,0)")
    return F.call_function("div", over.cast("decimal(38,0)"), (exact(left) * exact(right)).cast("decimal(38,0)"))


def collocations(df: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, top: int = TOP, inside: int = INSIDE, shard: int = SHARD) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first `top` phrases of two or three words."""
    words, pairs, triples, totals = phrase_counts(df, text, lang, least, shard)
    side = words.select("gid", "word", "f", "lang")
    word = lambda k: side.select(F.col("gid").alias(k), F.col("word").alias(f"w_{k}"), F.col("f").alias(f"f_{k}"), *([F.col("lang")] if k == "x" else []))

    held = triples.select("x", "y", "a").unionByName(triples.select(F.col("y").alias("x"), F.col("z").alias("y"), "a")).groupBy("x", "y").agg(F.max("a").alias("longest"))
    left = pairs.join(held, ["x", "y"], "left").filter(F.col("longest").isNull() | (100 * F.col("longest") < inside * F.col("a")))
    two = left.join(word("x"), "x").join(word("y"), "y")
    two = two.select("lang", F.concat_ws(" ", "w_x", "w_y").alias("phrase"), "a", F.col("f_x").alias("l"), F.col("f_y").alias("r"))
    two = two.withColumn("score", _score(F.col("a"), F.col("l"), F.col("r")))

    heads = pairs.withColumnRenamed("a", "xy")
    tails = pairs.select(F.col("x").alias("y"), F.col("y").alias("z"), F.col("a").alias("yz"))
    three = triples.join(heads, ["x", "y"]).join(tails, ["y", "z"]).join(word("x"), "x").join(word("y"), "y").join(word("z"), "z")
    one, other = _score(F.col("a"), F.col("f_x"), F.col("yz")), _score(F.col("a"), F.col("xy"), F.col("f_z"))
    three = three.withColumn("one", one).withColumn("other", other).withColumn("early", F.col("one") <= F.col("other"))
    pick = lambda a, b: F.when(F.col("early"), F.col(a)).otherwise(F.col(b))
    three = three.select("lang", F.concat_ws(" ", "w_x", "w_y", "w_z").alias("phrase"), "a", pick("f_x", "xy").alias("l"), pick("yz", "f_z").alias("r"), pick("one", "other").alias("score"))

    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(PARTS))
    first = two.unionByName(three).withColumn("part", part).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).filter(F.col("rank") <= top)
    last = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= top)
    return last.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", F.col("total").alias("n"), "score")
