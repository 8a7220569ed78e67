"""Operator 5, license scans by conditional compression.

Every text is read whole. A template of m words that stands in a text with d differences at most
(words to add or remove) has some q of its consecutive words there unaltered, q = (m - d) / (d + 1)
rounded up, wherever the differences are. So the places that share q words with a template, with the
template's room around them, make the candidate blocks, and none is missed, whatever the templates
say; a text without any such run of words is left at once, and a block may span any number of lines.

The words of a candidate block are compressed plainly and with every template as zstandard raw
dictionary; the bytes that a template saves rank the templates. In this order templates are confirmed
by exact wording differences, all their occurrences, and the first in the rank wins its best stretch.
Sizes are off by a few bytes at times, so the exact wording may refuse a winner: when on the same
words another template has no more differences and no fewer equal words, and is better in one of
them. Stretches that a winner overlaps by more than half go; what is left of the block is compressed
and ranked anew, until no stretch is left. So the rank decides between templates and drops none.

d is a share of the template's words, so short notices must be exact and long texts may have names
and other small changes. There is no shuffle; a task holds one text at a time. The templates are the
caller's parameter and of bounded number.

Defined results: null and empty texts have no blocks; repeated rows repeat; a text has a row for each
stretch that a template is confirmed for, so several for several notices; with `unconfirmed` set, each
line that matches CANDIDATE and that no confirmed stretch touches has a row with its best guess (by the rank)
and the number of differing words; only the key and text are read, so other columns cannot clash.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

import ahocorasick
import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.llm.hashing import shingle_hashes
from lexmill.llm.license_texts import TEMPLATES, TEXTS

#: A line with one of these is a best guess's block; confirmed stretches do not depend on it.
CANDIDATE = r"(?i)licen[cs]e|copyright|all rights reserved|public domain|permission is |permission to use|redistribution and use|free software|as.is\b"
DEFAULT = ((TEMPLATES, 0.0), (TEXTS, 0.1))
LEVEL = 3
_WORD = re.compile(r"[a-z0-9]+")
_SPACED = bytes(c if c < 128 and chr(c).isalnum() else 32 for c in range(256))


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def wording_differences(block: list[str], template: list[str]) -> int:
    """Words to add or remove so that the template stands in the block; words around it are free.

    A semi-global edit distance without substitutions, a row of the table at a time.
    """
    ids = {w: k for k, w in enumerate({*block, *template})}
    return int(_by_end(np.array([ids[w] for w in block], np.int64), np.array([ids[w] for w in template], np.int64)).min())


def differences_within(block: list[str], template: list[str], most: int) -> int | None:
    """The wording differences if they are `most` at most, else None."""
    n = wording_differences(block, template)
    return n if n <= most else None


def _by_end(block: np.ndarray, template: np.ndarray, free: bool = True) -> np.ndarray:
    """For each end in the block the differences of the best stretch that ends there (free), or of the
    whole block up to there."""
    places = np.arange(len(template) + 1)
    row, out = places, np.empty(len(block) + 1, np.int64)
    out[0] = len(template)
    for n, word in enumerate(block.tolist(), 1):
        step = row + 1
        step[0] = 0 if free else n
        step[1:] = np.where(template == word, np.minimum(step[1:], row[:-1]), step[1:])
        row = np.minimum.accumulate(step - places) + places  # a template word that is missing costs one
        out[n] = row[-1]
    return out


class Template:
    def __init__(self, name: str, wording: str, tolerance: float, ids: dict[str, int]):
        self.name, self.wording = name, wording
        self.words = np.array([ids.setdefault(w, len(ids)) for w in words(wording)], np.int64)
        m = len(self.words)
        self.most = int(m * tolerance)
        self.q = max(1, -(-(m - self.most) // (self.most + 1)))
        runs = shingle_hashes(self.words.astype(np.uint64), self.q) if m else np.zeros(0, np.uint64)
        self.seeds, self.first = np.unique(runs, return_index=True)
        self.last = len(runs) - 1 - np.unique(runs[::-1], return_index=True)[1]
        raw = zstandard.ZstdCompressionDict(" ".join(words(wording)).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        self.compressor = zstandard.ZstdCompressor(level=LEVEL, write_content_size=False, dict_data=raw)

    def windows(self, seeds: np.ndarray, n: int) -> list[tuple[int, int]]:
        """Stretches of the text with n words that may hold the template, by where its runs stand in it."""
        out: list[tuple[int, int]] = []
        at = np.flatnonzero(np.isin(seeds, self.seeds))
        run = np.searchsorted(self.seeds, seeds[at])
        begins = np.maximum(0, at - self.last[run] - self.most)
        ends = np.minimum(n, at - self.first[run] + len(self.words) + self.most)
        for a, b in sorted(zip(begins.tolist(), ends.tolist())):
            if out and a < out[-1][1]:
                out[-1] = (out[-1][0], max(b, out[-1][1]))
            else:
                out.append((a, b))
        return out

    def occurrences(self, text: np.ndarray, a: int, b: int):
        """(begin, end, differences) of the stretches in [a, b), the best first, that do not overlap."""
        parts = [(a, b)]
        while parts:
            a, b = parts.pop()
            if b - a < len(self.words) - self.most:
                continue
            found = _by_end(text[a:b], self.words)
            end = int(found.argmin())
            if (n := int(found[end])) > self.most:
                continue
            back = _by_end(text[max(a, a + end - len(self.words) - n) : a + end][::-1], self.words[::-1], free=False)
            begin = a + end - int(np.flatnonzero(back == n)[0])
            yield begin, a + end, n
            parts += [(a + end, b), (a, begin)]


def _covers(one: tuple[int, ...], other: tuple[int, ...]) -> bool:
    """Whether an occurrence overlaps another by more than half of the other."""
    return 2 * (min(one[2], other[2]) - max(one[1], other[1])) > other[2] - other[1]


def _overlapping(found: list[tuple[int, ...]]):
    """Occurrences (template, begin, end, differences) in groups that share words, directly or by others."""
    group, stop = [], 0
    for one in sorted(found, key=lambda f: (f[1], f[2])):
        if group and one[1] >= stop:
            yield group
            group = []
        group.append(one)
        stop = max(stop, one[2]) if len(group) > 1 else one[2]
    if group:
        yield group


class Scanner:
    """Templates: (identifier -> wording, share of the words that may differ) groups."""

    def __init__(self, groups):
        self.ids: dict[str, int] = {}
        self.templates = [Template(k, t, share, self.ids) for texts, share in groups for k, t in texts.items()]
        self.templates = [t for t in self.templates if len(t.words)]
        self.plain = zstandard.ZstdCompressor(level=LEVEL, write_content_size=False)
        # the runs of words by which templates are found: a text with none of them has no block
        self.telling = ahocorasick.Automaton()
        for t in self.templates:
            own = words(t.wording)
            for k in range(len(own) - t.q + 1):
                self.telling.add_word(f" {' '.join(own[k : k + t.q])} ", True)
        self.telling.make_automaton()

    def tells(self, lower: str) -> bool:
        """Whether some run of words by which a template is found stands in the text."""
        plain = b" ".join(lower.encode("utf-8", "surrogatepass").translate(_SPACED).split()).decode()
        return bool(self.templates) and next(self.telling.iter(f" {plain} "), None) is not None

    def bytes_saved(self, block: str, some: Iterable[int]) -> dict[int, int]:
        """The compressed bytes of a block's words that each of some templates saves."""
        data = block.encode()
        alone = len(self.plain.compress(data))
        return {k: alone - len(self.templates[k].compressor.compress(data)) for k in some}

    def ranked(self, block: list[str]) -> tuple[dict[int, int], int]:
        """The compressed bytes that every template saves, most first, of how many."""
        wording = " ".join(block)
        saved = self.bytes_saved(wording, range(len(self.templates)))
        return dict(sorted(saved.items(), key=lambda s: -s[1])), len(self.plain.compress(wording.encode()))

    def equal(self, one: tuple[int, ...]) -> int:
        return len(self.templates[one[0]].words) - one[3]

    def refused(self, one: tuple[int, ...], found: list[tuple[int, ...]]) -> bool:
        """Whether the exact wording speaks for another occurrence on the same words."""
        return any(self.equal(o) >= self.equal(one) and o[3] <= one[3] and (self.equal(o), o[3]) != (self.equal(one), one[3]) and _covers(o, one) for o in found)

    def winners(self, block: list[str], ids: np.ndarray, some: set[int]):
        """(template, begin, end, differences, share of the bytes saved) of a block with templates that may stand in it."""
        parts: list[tuple[int, int, list | None]] = [(0, len(block), None)]
        while parts:
            a, b, found = parts.pop()
            saved, plain = self.ranked(block[a:b])
            if found is None:
                found = [(k, *one) for k in saved if k in some for one in self.templates[k].occurrences(ids, a, b)]
            found.sort(key=lambda f: (-saved[f[0]], -self.equal(f), f))
            best = next((f for f in found if not self.refused(f, found)), None)
            if best:
                yield *best, saved[best[0]] / plain
                left = [f for f in found if not _covers(best, f)]
                parts += [(min(f[1] for f in group), max(f[2] for f in group), group) for group in _overlapping(left)]

    def scan(self, text: str, unconfirmed: bool):
        """(line, last line, identifier, saved, differences, confirmed) in the order of the text."""
        lower = text.lower()
        if not unconfirmed and not self.tells(lower):
            return []
        # words that no template has are one number, which no template has either
        ids = np.array([self.ids.get(w, -1) for w in _WORD.findall(lower)], np.int64)
        line_ends = np.array([m.start() for m in re.finditer("\n", lower)], np.int64)
        seeds = {q: shingle_hashes(ids.astype(np.uint64), q) for q in {t.q for t in self.templates} if q <= len(ids)}
        blocks: list[list[int]] = []  # begin, end and the templates of each candidate block
        for a, b, k in sorted((a, b, k) for k, t in enumerate(self.templates) if t.q in seeds for a, b in t.windows(seeds[t.q], len(ids))):
            if blocks and a < blocks[-1][1]:
                blocks[-1][1] = max(blocks[-1][1], b)
                blocks[-1].append(k)
            else:
                blocks.append([a, b, k])
        if not blocks and not unconfirmed:
            return []
        spans = np.array([m.span() for m in _WORD.finditer(lower)], np.int64).reshape(-1, 2)
        rows, touched = [], set()
        for a, b, *some in blocks:
            block = _WORD.findall(lower[spans[a, 0] : spans[b - 1, 1]])
            for k, begin, end, n, saved in self.winners(block, ids[a:b], set(some)):
                first, last = np.searchsorted(line_ends, [spans[a + begin, 0], spans[a + end - 1, 0]]).tolist()
                touched.update(range(first, last + 1))
                rows.append((first, last, self.templates[k].name, saved, n, True))
        if unconfirmed:
            for k, line in enumerate(text.split("\n")):
                if k not in touched and re.search(CANDIDATE, line):
                    saved, plain = self.ranked(words(line))
                    best = next(iter(saved))
                    near = np.array([self.ids.get(w, -1) for w in words(line)], np.int64)
                    rows.append((k, k, self.templates[best].name, saved[best] / plain, int(_by_end(near, self.templates[best].words).min()), False))
        return sorted(rows)


def license_blocks(df: DataFrame, key: str = "doc_id", text: str = "text", templates=DEFAULT, unconfirmed: bool = False) -> DataFrame:
    """(key, line, last_line, license_id, saved, n_differences, confirmed) for each stretch that a template is confirmed for.

    templates: identifier -> wording, all exact, or groups of them with the share of words that may differ.
    """
    groups = ((templates, 0.0),) if isinstance(templates, Mapping) else templates
    names = ["key", "line", "last_line", "license_id", "saved", "n_differences", "confirmed"]

    def run(batches):
        scanner = Scanner(groups)
        for batch in batches:
            at, rows = [], []
            for k, data in enumerate(batch.column(1)):
                found = scanner.scan(data.as_py(), unconfirmed)
                rows += found
                at += [k] * len(found)
            if rows:
                kinds = [pa.int32(), pa.int32(), pa.string(), pa.float64(), pa.int32(), pa.bool_()]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), *(pa.array(c, t) for c, t in zip(zip(*rows), kinds))], names=names)

    texts = df.select(F.col(key).alias("key"), F.col(text).alias("text")).filter("text is not null")
    out = texts.mapInArrow(run, f"key {dict(df.dtypes)[key]}, line int, last_line int, license_id string, saved double, n_differences int, confirmed boolean")
    return out.withColumnRenamed("key", key)
