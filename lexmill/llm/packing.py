"""Operator 2, best-fit packing of token sequences, bulk-synchronous.

`token_pieces` tokenizes each whole text, ends it with a token and cuts only texts that are longer
than a sequence. `pack` places the pieces:

1. Pieces are range-sorted by length (longest first), and each gets its rank in its length.
2. Supersteps go from the longest length down. In each sweep the documents of a length and the
   open gaps, sorted by size, are matched with their successor: the smallest gap that holds them.
   Several documents want the same gaps; their ranks resolve it, one document for each gap. Gaps
   shrink, and the sweep repeats until the length is placed; what finds no gap opens sequences.
   As lengths and gaps are whole numbers up to the capacity, a sweep works on the counts of each
   size: at most `capacity` counts, however many pieces there are, and its outcome is a list of
   rank intervals (length, ranks) -> (sequences, offset).
3. Each piece takes its place from the interval that holds its rank, in parallel on its partition.

So the driver sees one count for each length and for each part of the range sort, never a piece;
the only shuffle is the range sort of narrow rows. The sorted pieces are written to the shared
folder, so a lost executor repeats neither the tokenizing nor the sort.

Defined results: a null or empty text has one piece, the end token; repeated rows are packed each;
ties of length are ordered by key, piece and checksum (nulls first); an empty table packs into
nothing; only key and text are read, so other columns cannot clash.
"""

from __future__ import annotations

import zlib
from array import array
from collections import defaultdict
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.llm.tables import drop_kept, keep, release

CAPACITY, END_TOKEN = 1024, 2
CACHE_WORDS = 200_000


# --- tokens -------------------------------------------------------------------------------------


class Encoder:
    """Ids of a byte-level BPE, equal to the tokenizers library's, as little-endian bytes.

    The pattern of this vocabulary starts a new word at every single blank or line end between two
    other characters, so a text is cut there and each distinct part is encoded once (a bounded
    cache). Texts with other white space, with blanks side by side or at an end, or with a special
    token's string are encoded whole by the library itself. With the same vocabulary as a file of
    ranks, parts are encoded by tiktoken, which gives the same ids at a lower cost for each call.
    """

    def __init__(self, path: str, ranks_path: str | None = None):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.special = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        encode = self.ids if ranks_path is None else _rank_encoder(ranks_path)
        self.first = _Parts(encode)
        self.rest = _Parts(lambda part: encode(" " + part))
        self.line_end = self.ids("\n")

    def ids(self, text: str) -> bytes:
        return array("I", self.whole.encode(text, add_special_tokens=False).ids).tobytes()

    def text(self, text: str) -> bytes:
        lines = [line.split(" ") for line in text.split("\n")]
        if text.split() != [part for line in lines for part in line] or any(t in text for t in self.special):
            return self.ids(text)
        first, rest = self.first.__getitem__, self.rest.__getitem__
        return self.line_end.join([first(line[0]) + b"".join(map(rest, line[1:])) for line in lines])


def _rank_encoder(path: str):
    import base64

    import public_tokenizers
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    encode = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    return lambda part: array("I", encode(part)).tobytes()


class _Parts(dict):
    def __init__(self, encode):
        self.encode = encode

    def __missing__(self, part: str) -> bytes:
        found = self.encode(part)
        if len(part) < 64 and len(self) < CACHE_WORDS:  # frequent parts come early and stay
            self[part] = found
        return found


@lru_cache(maxsize=2)
def _encoder(path: str, ranks_path: str | None) -> Encoder:
    """One encoder and cache for each Python worker, kept over its tasks."""
    return Encoder(path, ranks_path)


def token_pieces(df: DataFrame, tokenizer_path: str, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY, end: int = END_TOKEN, ranks_path: str | None = None) -> DataFrame:
    """(key, piece, start, length, ids_crc32): the first piece of a long text may be shorter."""

    def run(batches):
        encoder = _encoder(tokenizer_path, ranks_path)
        tail = np.array([end], "<u4").tobytes()
        for batch in batches:
            columns = [[], [], [], [], []]
            for key_, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encoder.text(data.as_py()) + tail
                n = len(ids) // 4
                cuts = [0, *range(n % capacity or capacity, n + 1, capacity)]
                for piece, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    for column, value in zip(columns, (key_, piece, a, b - a, zlib.crc32(ids[4 * a : 4 * b]))):
                        column.append(value)
            kinds = [batch.schema.field(0).type, pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["key", "piece", "start", "length", "ids_crc32"])
        release()

    rows = df.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return rows.mapInArrow(run, f"key {dict(df.dtypes)[key]}, piece int, start long, length long, ids_crc32 long").withColumnRenamed("key", key)


# --- supersteps ---------------------------------------------------------------------------------


def supersteps(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, number of ranks, first sequence, offset) of each matched interval."""
    gaps: dict[int, list[tuple[int, int]]] = defaultdict(list)  # size -> (first sequence, how many)
    opened, out = 0, []
    for length in sorted(counts, reverse=True):
        if not 0 < length <= capacity:
            raise ValueError("a piece is empty or longer than a sequence")
        rank, left = 0, counts[length]
        while left:
            size = next((g for g in range(length, capacity) if gaps[g]), capacity)
            fits = size // length
            if size == capacity:
                wanted = -(-left // fits)
                found = [(opened, wanted)]
                opened += wanted
            else:
                wanted, found = -(-left // fits), []
                while wanted and gaps[size]:
                    first, n = gaps[size].pop()
                    if n > wanted:
                        gaps[size].append((first + wanted, n - wanted))
                        n = wanted
                    found.append((first, n))
                    wanted -= n
            for first, n in found:  # one document for each gap and sweep, by rank
                have = size
                for _ in range(fits):
                    m = min(left, n)
                    if m < n:
                        if have < capacity:
                            gaps[have].append((first + m, n - m))
                        n = m
                    if not m:
                        break
                    out.append((length, rank, m, first, capacity - have))
                    rank, left, have = rank + m, left - m, have - length
                if n and have:
                    gaps[have].append((first, n))
    return out


def pack(pieces: DataFrame, key: str = "doc_id", capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to pieces (key, piece, start, length, ids_crc32)."""
    spark = pieces.sparkSession
    key_type = dict(pieces.dtypes)[key]
    fields = f"key {key_type}, piece int, start long, length long, ids_crc32 long"
    order = [F.col("length").desc(), "key", "piece", "ids_crc32"]
    named = pieces.select(F.col(key).alias("key"), "piece", "start", "length", "ids_crc32")

    def number(batches):
        part, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in batches:
            length = batch.column(3).to_numpy()
            new, back = np.unique(length, return_inverse=True)
            place = np.argsort(back, kind="stable")
            starts = np.searchsorted(back[place], np.arange(len(new)))
            local = np.empty(len(length), np.int64)
            local[place] = np.arange(len(length)) - np.repeat(starts, np.diff([*starts, len(length)]))
            local += seen[length]
            np.add.at(seen, length, 1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(len(length), part, np.int64)), pa.array(local)], names=[*batch.schema.names, "part", "local"])

    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    made = keep(named)
    ranked = keep(made.repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInArrow(number, f"{fields}, part long, local long"))
    drop_kept(spark, made)
    sizes = ranked.groupBy("part", "length").agg(F.count("*").alias("n")).collect()
    counts, before = defaultdict(int), {}
    for r in sorted(sizes, key=lambda r: r["part"]):
        before[r["part"], r["length"]] = counts[r["length"]]
        counts[r["length"]] += r["n"]
    steps: dict[int, np.ndarray] = {}
    for step in supersteps(counts, capacity):
        steps.setdefault(step[0], []).append(step[1:])
    shared = spark.sparkContext.broadcast((before, {k: np.array(v, np.int64) for k, v in steps.items()}))

    def place(batches):
        before, steps = shared.value
        for batch in batches:
            length, part, local = (batch.column(k).to_numpy() for k in (3, 5, 6))
            sequence, offset = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
            for p, n in np.unique(np.stack([part, length], axis=1), axis=0):
                rows = np.flatnonzero((part == p) & (length == n))
                rank, table = local[rows] + before[int(p), int(n)], steps[int(n)]
                step = table[np.searchsorted(table[:, 0], rank, side="right") - 1]
                sequence[rows], offset[rows] = step[:, 2] + rank - step[:, 0], step[:, 3]
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(sequence), pa.array(offset)], names=[*batch.schema.names[:5], "sequence_id", "offset"])

    return ranked.mapInArrow(place, f"{fields}, sequence_id long, offset long").withColumnRenamed("key", key)
