"""Names that stand in other names: as a subsequence, a part or a beginning.

The asked names are put in a trie, which every other name walks once, so what comes out are matches
and never pairs that have yet to be compared, however many names share a number.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Characters of the asked names that are broadcast at once (a longer name is alone), and of a suffix by which it is found.
CHARACTERS, SUFFIX = 1 << 20, 64
_NAMES = ""  # a node's entry for the names that end there; all others are characters


class Names:
    """The asked names of one number."""

    def __init__(self):
        self.root: dict = {}
        self.names: list[str] = []
        self._suffixes: list[tuple[str, int]] | None = None

    def add(self, name: str) -> None:
        node = self.root
        for c in name:
            node = node.setdefault(c, {})
        node[_NAMES] = name
        self.names.append(name)

    def subsequences(self, s: str) -> Iterator[str]:
        """The names whose characters stand in s in their order: a step goes behind the next place of its character."""
        stack = [(self.root, 0)]
        while stack:
            node, at = stack.pop()
            for c, below in node.items():
                if c == _NAMES:
                    yield below
                elif (found := s.find(c, at)) >= 0:
                    stack.append((below, found + 1))

    def beginnings(self, s: str, at: int = 0) -> Iterator[str]:
        """The names that stand in s at this place."""
        node = self.root
        for c in s[at:]:
            if (node := node.get(c)) is None:
                return
            if _NAMES in node:
                yield node[_NAMES]

    def parts(self, s: str) -> set[str]:
        """The names that stand anywhere in s."""
        return {name for at in range(len(s)) for name in self.beginnings(s, at)}

    def continued(self, s: str) -> Iterator[str]:
        """The names that begin with s."""
        node = self.root
        for c in s:
            if (node := node.get(c)) is None:
                return
        stack = [node]
        while stack:
            for c, below in stack.pop().items():
                if c == _NAMES:
                    yield below
                else:
                    stack.append(below)

    def holders(self, s: str) -> set[str]:
        """The names that hold s: some suffix of theirs begins with it."""
        if self._suffixes is None:
            self._suffixes = sorted((name[at : at + SUFFIX], k) for k, name in enumerate(self.names) for at in range(len(name)))
        head, found = s[:SUFFIX], set()
        at = bisect_left(self._suffixes, (head, -1))
        while at < len(self._suffixes) and self._suffixes[at][0].startswith(head):
            if s in (name := self.names[self._suffixes[at][1]]):
                found.add(name)
            at += 1
        return found


def _blocks(names: DataFrame) -> Iterator[dict[tuple[str, str], Names]]:
    """Tries by (kind, number). Names come to the driver one at a time and a block of them is held."""
    block, size = {}, 0
    for row in names.toLocalIterator():
        if size and size + len(row["name"]) > CHARACTERS:
            yield block
            block, size = {}, 0
        block.setdefault((row["kind"], row["number"]), Names()).add(row["name"])
        size += len(row["name"])
    if block:
        yield block


def _matches(names: Names, kind: str, law: str, strict: bool) -> set[str]:
    if kind != "law":
        return names.parts(law) if strict else set(names.subsequences(law))
    if strict:
        return names.parts(law) | names.holders(law) if len(law) > 3 else set()
    return {n for n in (*names.beginnings(law), *names.continued(law)) if len(n) >= 2} if len(law) >= 2 else set()


def matched_names(asked: DataFrame, keys: DataFrame, strict: bool) -> DataFrame:
    """(kind, number, name, law) for asked (kind, number, name) and keys (kind, number, law), both without repeats.

    With a number a name matches a law that it is a subsequence of (strict: a part of); without one (kind
    law) where one begins with the other (strict: holds the other). A block of CHARACTERS is one pass over the keys.
    """
    spark = asked.sparkSession
    out = spark.createDataFrame([], "kind string, number string, name string, law string")
    for block in _blocks(asked):
        shared = spark.sparkContext.broadcast(block)

        def run(batches, shared=shared):
            for batch in batches:
                rows = []
                for kind, number, law in zip(*(c.to_pylist() for c in batch.columns)):
                    if law and (names := shared.value.get((kind, number))) is not None:
                        rows += [(kind, number, name, law) for name in _matches(names, kind, law, strict)]
                columns = zip(*rows) if rows else ((),) * 4
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], names=["kind", "number", "name", "law"])

        out = out.unionByName(keys.select("kind", "number", "law").mapInArrow(run, out.schema))
    return out


def by_number(df: DataFrame, *columns: str) -> DataFrame:
    """columns, law, kind and number: three rows for each of df (law, article, annex), less those without a number."""
    each = F.explode(F.array(*(F.struct(F.lit(kind).alias("kind"), number.alias("number")) for kind, number in (("article", F.col("article")), ("annex", F.col("annex")), ("law", F.lit(""))))))
    return df.select(*columns, "law", each.alias("k")).select(*columns, "law", "k.kind", "k.number").filter("kind = 'law' or number != ''")
