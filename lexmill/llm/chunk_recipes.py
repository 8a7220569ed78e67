"""Operator 13, exact deduplication by content-defined chunk recipes.

Texts are equal when they are identical after each run of white space (space, tab to carriage
return) has become one space.

1. Each normalised text is cut where a rolling hash of its last WINDOW bytes says so, so the cuts
   follow from the text alone and equal stretches give equal chunks wherever they stand. Its recipe is
   the list of its chunks' identifiers, in order, of 8 bytes each. Only recipes move from here on.
2. Texts with different recipes differ. The chunks of texts whose recipe occurs again, and no
   others, are deduplicated by identifier and bytes (summed before the shuffle, so copies do not
   move). An identifier with one content is verified.
3. An identifier with several contents becomes several: each content gets its number, and recipes
   that hold it are written anew with these numbers.
4. Rows with equal verified recipes are one group, whose least key stays. A recipe of very many rows
   meets its group by broadcast (tables.hub_join); no group is gathered anywhere.

A long text is read where it lies; what is shuffled are recipes (8 bytes for some 2 KB of text) and one
copy of each chunk for each task that repeats it. Which recipes occur again reaches the tasks as a bit map
of fixed size: where it has filled up, more chunks are verified than need be, and none fewer.

Defined results: a null text counts as empty, and empty texts are equal to each other; a text of white
space alone is one space, not empty. Rows that repeat a key are rows of their own, one of which stays; a null
key stays only where its whole group has none. An empty table gives no rows; other columns are not read,
so they cannot clash.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexmill.llm.hashing import SPACE, blocks, mix
from lexmill.llm.tables import as_bytes, drop_kept, hub_join, keep, release

#: Bytes of the rolling hash, least and most bytes of a chunk, and bits that are zero at a cut (2 KB apart on average).
WINDOW, LEAST, MOST, CUT_BITS = 32, 512, 16_384, 11
#: Texts normalised at once, in bytes; a longer one is alone.
TOGETHER = 1 << 20
#: Bits of the map of recipes that occur again: 8 MB.
MAP_BITS = 1 << 26

_GEAR = (mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)).astype(np.uint32)


def normalised(texts: list[bytes]) -> tuple[np.ndarray, list[int]]:
    """The texts, one after another, with one space for each run of white space, and where each begins and ends."""
    buf = np.frombuffer(b"".join(texts), np.uint8)
    edges = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    space = SPACE[buf]
    goes = np.zeros(len(buf), bool)
    goes[1:] = space[1:] & space[:-1]
    goes[edges[:-1][edges[:-1] < len(buf)]] = False  # a text's first byte stays, whatever the text before ends with
    stays = ~goes
    out = np.where(space, np.uint8(32), buf)[stays]
    at = np.concatenate([[0], np.cumsum(stays)])
    return out, at[edges].tolist()


def _may_cut(buf: np.ndarray) -> list[int]:
    """Ends of windows whose hash allows a cut behind them."""
    h = _GEAR[buf]
    step = 1
    while step < WINDOW:
        h[step:] = h[step:] + (h[:-step] << np.uint32(step))
        step *= 2
    return (np.flatnonzero(h >> np.uint32(32 - CUT_BITS) == 0) + 1).tolist()


def chunked(texts: list[bytes], bits: int = 64):
    """(normalised text, chunks, identifiers) of each text; identifiers have `bits` bits."""
    low = (1 << bits) - 1
    for i, j in blocks([len(t) for t in texts], TOGETHER):
        buf, edges = normalised(texts[i:j])
        cuts, data = _may_cut(buf), buf.tobytes()
        for a, end in zip(edges, edges[1:]):
            text, chunks, start = data[a:end], [], a
            while start < end:
                k = bisect_left(cuts, start + LEAST)
                stop = min(cuts[k] if k < len(cuts) else end, start + MOST, end)
                chunks.append(data[start:stop])
                start = stop
            yield text, chunks, [xxhash.xxh3_64_intdigest(c) & low for c in chunks]


def _recipe(ids: list[int]) -> bytes:
    return np.array(ids, "<u8").tobytes()


def recipes(df: DataFrame, key: str, text: str, bits: int = 64) -> DataFrame:
    """(key, n_bytes, sha, recipe) of each row."""
    rows = df.select(F.col(key).alias("key"), as_bytes(text).alias("text"))

    def run(batches):
        for batch in batches:
            found = [(len(t), hashlib.sha256(t).hexdigest(), _recipe(ids)) for t, _, ids in chunked(batch.column(1).to_pylist(), bits)]
            n, sha, recipe = zip(*found) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(sha, pa.string()), pa.array(recipe, pa.binary())], names=["key", "n_bytes", "sha", "recipe"])
        release()

    return rows.mapInArrow(run, f"key {dict(rows.dtypes)['key']}, n_bytes long, sha string, recipe binary")


def _place(recipe: bytes) -> int:
    return xxhash.xxh3_64_intdigest(recipe, seed=13) % MAP_BITS


def _bit_map(some: DataFrame) -> np.ndarray:
    """The bit map of a column of recipes: at most MAP_BITS / 64 words come to the driver, whatever the number of recipes."""

    def run(batches):
        for batch in batches:
            at = np.unique(np.array([_place(r) for r in batch.column(0).to_pylist()], np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(at >> 6), pa.array((np.uint64(1) << (at & 63).astype(np.uint64)).view(np.int64))], names=["word", "bits"])

    words = some.select("recipe").mapInArrow(run, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(MAP_BITS // 64, np.int64)
    out[words["word"].to_numpy()] = words["bits"].to_numpy()
    return out


def _chunks(df: DataFrame, key: str, text: str, bits: int, some: DataFrame) -> DataFrame:
    """(key, n_bytes, sha, recipe, ids, chunks) of the rows whose recipe is on the bit map of `some`: all of them, and by chance a few more."""
    shared = df.sparkSession.sparkContext.broadcast(_bit_map(some))
    rows = df.select(F.col(key).alias("key"), as_bytes(text).alias("text"))

    def run(batches):
        known = shared.value
        for batch in batches:
            out = []
            for k, (t, chunks, ids) in enumerate(chunked(batch.column(1).to_pylist(), bits)):
                recipe = _recipe(ids)
                at = _place(recipe)
                if int(known[at >> 6]) >> (at & 63) & 1:
                    out.append((k, len(t), hashlib.sha256(t).hexdigest(), recipe, np.array(ids, np.uint64).view(np.int64).tolist(), chunks))
            for i, j in blocks([r[1] for r in out], TOGETHER):
                at, *columns = zip(*out[i:j])
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), *(pa.array(c, kind) for c, kind in zip(columns, kinds))], names=names)
        release()

    kinds = [pa.int64(), pa.string(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.binary())]
    names = ["key", "n_bytes", "sha", "recipe", "ids", "chunks"]
    return rows.mapInArrow(run, f"key {dict(rows.dtypes)['key']}, n_bytes long, sha string, recipe binary, ids array<long>, chunks array<binary>")


def _distinct_chunks(df: DataFrame, key: str, text: str, bits: int, some: DataFrame) -> DataFrame:
    """(id, chunk): each content once."""
    rows = _chunks(df, key, text, bits, some).select("ids", "chunks")

    def run(batches):
        for batch in batches:
            pairs = dict.fromkeys((i, c) for ids, chunks in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) for i, c in zip(ids, chunks))
            yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in pairs], pa.int64()), pa.array([c for _, c in pairs], pa.binary())], names=["id", "chunk"])

    return rows.mapInArrow(run, "id long, chunk binary").distinct()


def verified(df: DataFrame, key: str = "doc_id", text: str = "text", bits: int = 64) -> DataFrame:
    """(key, n_bytes, sha, recipe, uid), a kept table: recipes are equal where, and only where, the texts are. uid tells rows apart."""
    spark = df.sparkSession
    rows = keep(recipes(df, key, text, bits).withColumn("uid", F.monotonically_increasing_id()))
    again = keep(rows.groupBy("recipe").agg(F.count("*").alias("n")).filter("n > 1").select("recipe"))
    chunks = _distinct_chunks(df, key, text, bits, again)
    odd = keep(chunks.groupBy("id").agg(F.count("*").alias("n")).filter("n > 1").select("id"))
    if odd.isEmpty():
        drop_kept(spark, again, odd)
        return rows
    numbered = keep(chunks.join(odd, "id").withColumn("number", F.row_number().over(Window.partitionBy("id").orderBy("chunk"))))

    def holds(batches):  # one row for each identifier in a recipe
        for batch in batches:
            ids = [np.unique(np.frombuffer(r, "<i8")) for r in batch.column(0).to_pylist()]
            which = np.repeat(np.arange(len(ids)), [len(i) for i in ids])
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(which)), pa.array(np.concatenate(ids) if ids else [], pa.int64())], names=["recipe", "id"])

    mixed = keep(again.mapInArrow(holds, "recipe binary, id long").join(odd, "id", "left_semi").select("recipe").distinct())
    wide = keep(_chunks(df, key, text, bits, mixed).join(mixed, "recipe", "left_semi").withColumn("uid", -1 - F.monotonically_increasing_id()))
    each = wide.select("uid", F.posexplode(F.arrays_zip("ids", "chunks")).alias("at", "one")).select("uid", "at", F.col("one.ids").alias("id"), F.col("one.chunks").alias("chunk"))
    told = each.join(numbered, ["id", "chunk"]).groupBy("uid").agg(F.array_sort(F.collect_list(F.struct("at", "number"))).alias("numbers"))
    numbers = F.to_binary(F.concat_ws("", F.transform("numbers", lambda x: F.lpad(F.hex(x["number"]), 16, "0"))), F.lit("hex"))
    new = wide.join(told, "uid").select("key", "n_bytes", "sha", F.concat("recipe", numbers).alias("recipe"), "uid")
    out = keep(rows.join(mixed, "recipe", "left_anti").select(new.columns).unionByName(new))
    drop_kept(spark, rows, again, odd, numbered, mixed, wide)
    return out


def deduplicate(df: DataFrame, key: str = "doc_id", text: str = "text", bits: int = 64) -> DataFrame:
    """(key, keep, group_size, kept, sha, n_bytes) of each row: keep is the key of the row that stays, sha the hash of
    the normalised text. bits: of a chunk's identifier; fewer only make for more identifiers with several contents."""
    rows = verified(df, key, text, bits)
    # of rows that repeat the least key any one stays; the table is written, so it is one
    first = F.coalesce(F.min_by("uid", "key"), F.min("uid"))
    groups = keep(rows.groupBy("recipe").agg(F.min("key").alias("keep"), first.alias("first"), F.count("*").alias("group_size")))
    out = hub_join(rows, groups, "recipe", "group_size", rows.count())
    return out.select("key", "keep", "group_size", (F.col("uid") == F.col("first")).alias("kept"), "sha", "n_bytes")
