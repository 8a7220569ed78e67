"""Operator 9, benchmark decontamination by spaced-seed hashing.

Fixed masks choose some of a few consecutive words and ignore the others; equal chosen words give
equal hashes even if an ignored word was substituted. The benchmark's hashes are joined with every
position of every training text. A hit counts if some stretch around it is within the limits of
words and similarity; then its whole diagonal is judged, all stretches of aligned words, in which
substitutions are tolerated.

A stretch of 26 words or more within the limits has a shorter one within them (one of its halves),
so stretches up to NEAR words around a hit decide whether a diagonal has any.

The benchmark side travels in blocks of at most BLOCK_BYTES bytes (measured; an item longer than that
is a block of its own), one pass over the texts for each block, so any size of benchmark works and no
broadcast grows with the data. Texts are never shuffled; only verified overlaps, a row for each text
and item, are; `clean` drops texts without any shuffle or join.

Words are runs of letters and digits, lower-cased; in scripts that are written without blanks
(Chinese, Japanese, Thai, Lao, Burmese, Khmer) each character is a word.

Defined results: null and empty texts or items match nothing; items of fewer than SPAN words must
occur whole and unaltered, items without words never match; of a diagonal's stretches within the
limits the one of the best score is reported, or if the best-scored one is beyond them, the one with
the most equal words (then the fewest words, then the first); repeated rows give repeated rows'
overlaps once per key; a null key or item is one like any other; empty tables give no rows. `overlaps`
reads only keys and texts, and `clean` judges each row by its own text and hands its other columns on,
so other columns cannot clash and repeated or null keys play no part.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.llm.hashing import BASE, blocks, mix, span_hashes, word_spans
from lexmill.llm.tables import drop_kept, keep

#: Words that a mask looks at (1) or ignores (0): every stretch of 10 to 25 words with at most a fifth
#: substituted, wherever they are, has one of these (a test enumerates them).
MASKS = ("1111", "11101")
#: Items of fewer words must occur unaltered.
SPAN = 10
#: Aligned words that make an overlap, share of them that must be equal, and the cost of a
#: substituted word in units of an equal one.
MIN_WORDS, MIN_SIMILARITY, SUBSTITUTED = 13, 0.8, 2
#: Equal words that make up for another one at MIN_SIMILARITY, words of the stretches that are looked
#: at around a hit, hits held at once, turns that look at one hit of each diagonal, and hits looked at together.
OTHER = round(MIN_SIMILARITY / (1 - MIN_SIMILARITY))
NEAR, HITS, ASKED, TOGETHER = 2 * MIN_WORDS - 1, 1 << 18, 4, 1 << 14
#: Benchmark bytes of a pass at most.
BLOCK_BYTES = 8_000_000
_BITS = 22

#: Characters of scripts without blanks, and the marks between their words.
_ALONE = re.compile("[\u0e01-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")
_WIDE_MARKS = re.compile("[\u2010-\u205e\u3000-\u303f\uff01-\uff0f\uff1a-\uff20\uff3b-\uff40\uff5b-\uff65]+")

#: Bytes between words: ASCII that is neither a letter nor a digit.
_MARKS = np.ones(256, bool)
_MARKS[48:58] = _MARKS[65:91] = _MARKS[97:123] = _MARKS[128:] = False


def spaced(text: str) -> str:
    """Blanks around each character of a script that is written without them, and for wide marks."""
    if text.isascii():
        return text
    text = _WIDE_MARKS.sub(" ", text)
    return _ALONE.sub(r" \g<0> ", text) if _ALONE.search(text) else text


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of the lower-cased words of all texts, and where each text's words begin."""
    data = [spaced(t).lower().encode("utf-8", "surrogatepass") for t in texts]
    buf = np.frombuffer(b"\n".join(data) + b"\n", np.uint8)
    starts, ends = word_spans(buf, _MARKS)
    edges = np.concatenate([[0], np.cumsum([len(d) + 1 for d in data])])
    return span_hashes(buf, starts, ends), np.searchsorted(starts, edges)


def seeds(words: np.ndarray, mask: str) -> np.ndarray:
    """The hash of the chosen words at each position."""
    n = max(0, len(words) - len(mask) + 1)
    out = np.full(n, np.uint64(int(mask, 2)))
    for k, c in enumerate(mask):
        if c == "1":
            out = out * BASE + words[k : n + k]
    return mix(out)


class Index:
    """The spaced seeds of a block of benchmark items."""

    def __init__(self, ids: list, texts: list[str]):
        self.ids = ids
        self.words, self.edges = word_hashes(texts)
        at = np.arange(len(self.words))
        item = np.searchsorted(self.edges, at, side="right") - 1
        self.tables = []
        lengths = np.diff(self.edges)
        short = sorted({int(n) for n in lengths if 0 < n < SPAN})
        for mask, whole in (*((m, False) for m in MASKS), *(("1" * n, True) for n in short)):
            n, h = len(mask), seeds(self.words, mask)
            fits = at[: len(h)] + n <= self.edges[item[: len(h)] + 1]
            fits &= (lengths[item[: len(h)]] == n) if whole else (lengths[item[: len(h)]] >= SPAN)
            h, places = h[fits], at[: len(h)][fits]
            order = np.argsort(h, kind="stable")
            quick = np.zeros(1 << _BITS, bool)
            quick[h >> np.uint64(64 - _BITS)] = True
            self.tables.append((mask, h[order], places[order], quick))
        self.item = item

    def hits(self, words: np.ndarray):
        """Pairs (position in words, position in the benchmark) that share a seed, HITS at most at a time."""
        for mask, h, places, quick in self.tables:
            s = seeds(words, mask)
            at = np.flatnonzero(quick[s >> np.uint64(64 - _BITS)])
            low, high = np.searchsorted(h, s[at], "left"), np.searchsorted(h, s[at], "right")
            stops = np.cumsum(high - low)
            total = int(stops[-1]) if len(stops) else 0
            for first in range(0, total, HITS):
                n = np.arange(first, min(first + HITS, total))
                k = np.searchsorted(stops, n, side="right")
                yield np.stack([at[k], places[high[k] - stops[k] + n]], axis=1)

    def _near(self, hits: np.ndarray, text: np.ndarray, item: np.ndarray, edges: np.ndarray, words: np.ndarray) -> np.ndarray:
        """Whether each hit lies near a stretch within the limits."""
        around = np.arange(-NEAR, NEAR)
        size = self.edges[item + 1] - self.edges[item]
        good = (size < SPAN) & (hits[:, 0] + size <= edges[text + 1])
        p, q = hits[:, :1] + around, hits[:, 1:] + around
        inside = (p >= edges[text, None]) & (p < edges[text + 1, None]) & (q >= self.edges[item, None]) & (q < self.edges[item + 1, None])
        equal = words[np.where(inside, p, 0)] == self.words[np.where(inside, q, 0)]
        total = np.zeros((len(hits), 2 * NEAR + 1), np.int32)
        np.cumsum(np.where(inside, np.where(equal, 1, -OTHER), -NEAR), axis=1, out=total[:, 1:])
        for n in range(SPAN, NEAR + 1):
            good |= (size >= SPAN) & (n >= np.minimum(MIN_WORDS, size)) & (total[:, n:] >= total[:, :-n]).any(axis=1)
        return good

    def diagonals(self, words: np.ndarray, edges: np.ndarray) -> np.ndarray:
        """(text, item, diagonal) of the hits that lie near a stretch within the limits, sorted.

        A diagonal that is known is asked no more, however many of its places are hits.
        """
        reach = len(words) + len(self.words) + 1
        known = np.zeros(0, np.int64)
        for hits in self.hits(words):
            text = np.searchsorted(edges, hits[:, 0], side="right") - 1
            item = self.item[hits[:, 1]]
            code = (text * len(self.ids) + item) * reach + hits[:, 0] - hits[:, 1] + len(self.words)
            left = np.flatnonzero(~np.isin(code, known))
            for turn in range(ASKED + 1):
                if not len(left):
                    break
                # first one hit of each diagonal, some times over; then all that are left
                asked = left[np.unique(code[left], return_index=True)[1]] if turn < ASKED else left
                parts = [asked[k : k + TOGETHER] for k in range(0, len(asked), TOGETHER)]
                near = np.concatenate([self._near(hits[k], text[k], item[k], edges, words) for k in parts])
                good = np.unique(code[asked[near]])
                known = np.union1d(known, good)
                left = np.setdiff1d(left, asked, assume_unique=True) if turn < ASKED else left[:0]
                left = left[~np.isin(code[left], good)]
        pair, diagonal = known // reach, known % reach - len(self.words)
        return np.stack([pair // max(1, len(self.ids)), pair % max(1, len(self.ids)), diagonal], axis=1)

    def overlaps(self, words: np.ndarray, edges: np.ndarray):
        """(text, item, text's word, item's word, words, equal words): the best stretch of each text and item,
        by most equal words, then first in the text, then first in the item."""
        found = self.diagonals(words, edges)
        t, i, diagonal = found.T
        first = np.maximum(self.edges[i], edges[t] - diagonal)
        size = np.minimum(self.edges[i + 1], edges[t + 1] - diagonal) - first
        # of a text and item the longest diagonals first, then the earliest in the text: what follows can be left out by its length
        order = np.lexsort((first + diagonal, -size, i, t))
        pair, best = None, None
        for t, i, diagonal, first, size in np.stack([t, i, diagonal, first, size], axis=1)[order].tolist():
            if (t, i) != pair:
                if best:
                    yield pair + best
                pair, best = (t, i), None
            if best and (size < best[3] or size == best[3] and first + diagonal - edges[t] > best[0]):
                continue
            whole = int(self.edges[i + 1] - self.edges[i])
            equal = self.words[first : first + size] == words[first + diagonal : first + diagonal + size]
            if whole < SPAN and (size < whole or not equal.all()):
                continue
            if stretch := valid_stretch(equal, min(MIN_WORDS, whole)):
                begin, end = stretch
                one = (int(first + diagonal + begin - edges[t]), int(first + begin - self.edges[i]), end - begin, int(equal[begin:end].sum()))
                if not best or (one[3], -one[0], -one[1]) > (best[3], -best[0], -best[1]):
                    best = one
        if best:
            yield pair + best


def best_stretch(equal: np.ndarray) -> tuple[int, int]:
    """The stretch with the most equal words less SUBSTITUTED for each other word; the first, if several."""
    total = np.concatenate([[0], np.cumsum(np.where(equal, 1, -SUBSTITUTED))])
    low = np.minimum.accumulate(total)
    end = int(np.argmax(total - low))
    return int(np.argmin(total[: end + 1])), end


def valid_stretch(equal: np.ndarray, least: int) -> tuple[int, int] | None:
    """The best stretch if it has at least `least` words and MIN_SIMILARITY; else, of all that have, the
    one with the most equal words, then the fewest words, then the first; None if there is none."""
    same = np.concatenate([[0], np.cumsum(equal)])
    total = (1 + OTHER) * same - OTHER * np.arange(len(same))
    begin, end = best_stretch(equal)
    if end - begin >= least and total[end] >= total[begin]:
        return begin, end
    # for each end the earliest begin within the limit is a record low of the total
    lows = np.flatnonzero(np.diff(np.minimum.accumulate(total), prepend=1) < 0)
    ends = np.arange(least, len(same))
    begins = lows[np.searchsorted(-total[lows], -total[ends])]
    fits = ends - begins >= least
    if not fits.any():
        return None
    begins, ends = begins[fits], ends[fits]
    most = same[ends] - same[begins]
    begins, ends = begins[most == most.max()], ends[most == most.max()]
    begins = np.minimum(np.searchsorted(same, same[begins], side="right") - 1, ends - least)
    k = np.lexsort((begins, ends - begins))[0]
    return int(begins[k]), int(ends[k])


def _passes(benchmark: DataFrame, item: str, item_text: str) -> Iterator[tuple[pa.Array, list[str]]]:
    """The benchmark's different rows in blocks of BLOCK_BYTES at most, or of one row: (items, texts)."""
    rows = benchmark.select(F.col(item).alias("item"), F.col(item_text).alias("text")).filter("text is not null").distinct()
    part = lambda n: F.pmod(F.xxhash64("item", "text"), F.lit(n))
    n = 1
    while True:
        sizes = rows.groupBy(part(n).alias("part")).agg(F.sum(F.octet_length("text")).alias("bytes"), F.count("*").alias("rows"))
        most = sizes.filter("rows > 1").agg(F.max("bytes")).first()[0] or 0
        if most <= BLOCK_BYTES:
            break
        n = max(n + 1, int(n * most / BLOCK_BYTES * 1.2))
    for k in range(n):
        found = rows.filter(part(n) == k).orderBy("item", "text").toArrow()
        if found.num_rows:
            yield found["item"].combine_chunks(), found["text"].to_pylist()


def _found(index: Index, texts: list) -> Iterator[tuple]:
    """(text's number, item's number, ...) of each verified diagonal."""
    texts = [t or "" for t in texts]
    for i, j in blocks([len(t) for t in texts], 1 << 18):
        for t, *rest in index.overlaps(*word_hashes(texts[i:j])):
            yield i + t, *rest


def overlaps(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """(key, item, word_start, item_start, n_words, n_equal, similarity): the best overlap of each text and item."""
    spark = docs.sparkSession
    key_type, item_type = dict(docs.dtypes)[key], dict(benchmark.dtypes)[item]
    schema = f"key {key_type}, item {item_type}, word_start long, item_start long, n_words long, n_equal long"
    names = ["key", "item", "word_start", "item_start", "n_words", "n_equal"]
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))

    def block(items: pa.Array, texts: list[str]) -> DataFrame:
        shared = spark.sparkContext.broadcast((items, texts))

        def run(batches):
            items, texts = shared.value
            index = Index(range(len(texts)), texts)
            for batch in batches:
                if out := list(_found(index, batch.column(1).to_pylist())):
                    at, n, *rest = (pa.array(c, pa.int64()) for c in zip(*out))
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(at), items.take(n), *rest], names=names)

        return rows.mapInArrow(run, schema)

    found = reduce(DataFrame.unionAll, (block(*b) for b in _passes(benchmark, item, item_text)), spark.createDataFrame([], schema))
    best = F.max_by(F.struct("word_start", "item_start", "n_words", "n_equal"), F.struct(F.col("n_equal"), -F.col("word_start"), -F.col("item_start"))).alias("best")
    return found.groupBy("key", "item").agg(best).select(
        F.col("key").alias(key), F.col("item").alias(item if item != key else "benchmark_item"), "best.*", F.round(F.col("best.n_equal") / F.col("best.n_words"), 6).alias("similarity")
    )


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of docs whose texts overlap with no item, with all their columns."""
    at = docs.columns.index(text)

    def without(rows: DataFrame, items: pa.Array, texts: list[str]) -> DataFrame:
        shared = rows.sparkSession.sparkContext.broadcast(texts)

        def run(batches):
            index = Index(range(len(shared.value)), shared.value)
            for batch in batches:
                stays = np.ones(batch.num_rows, bool)
                stays[list({t for t, *_ in _found(index, batch.column(at).to_pylist())})] = False
                yield batch.filter(pa.array(stays))

        return rows.mapInArrow(run, rows.schema)

    # a task holds one block's index, so what one pass leaves is written before the next
    rows, written = docs, None
    for k, block in enumerate(_passes(benchmark, item, item_text)):
        if k:
            before, written = written, keep(rows)
            rows = written
            if before is not None:
                drop_kept(docs.sparkSession, before)
        rows = without(rows, *block)
    return rows
