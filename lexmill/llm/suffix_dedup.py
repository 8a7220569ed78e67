"""Operator 1, removal of repeated substrings over a sparse suffix array.

Every byte that lies in a `LENGTH`-byte string which also starts earlier (in a smaller key, or
earlier in the same text) is removed; matches never cross texts, overlaps count, and strings are
judged on the input.

Not every suffix is needed. Each LENGTH-byte window is assigned to an anchor, the position with the
least hash of a SHALLOW-byte string in it (leftmost, if several). Equal windows have their anchors
at the same place, so the windows of one anchor travel together as one piece of text, and only
anchor suffixes are sorted:

1. Anchors are met by hash; those that occur once in all texts go. A hash that recurs within a batch
   needs no counting, so its further occurrences pass by the shuffle's key and a frequent string
   sends one row for each batch.
2. The texts that have recurring anchors are bucketed by key once, and their pieces of text are cut
   out. A piece that a batch has met before is a repeat already and sends only its interval.
3. Deep-shallow sorting: anchor suffixes are put in order by multikey quicksort to the shallow depth
   of SHALLOW bytes; what remains are groups with that common prefix. Small groups are compared
   directly, larger ones are ordered by blind tries, once by what follows the anchor and once by
   what precedes it, backwards. Equal windows are those that share a class in both orders.
4. A group with more than GROUP different pieces is never held: its pieces go by the windows' 128-bit
   hashes to a Spark aggregation that finds each window's first occurrence, so there is no limit. A
   string that very many texts share sends one row for each batch of texts to one task, which streams.

Defined results: null and empty texts have 0 bytes and nothing removed; texts under LENGTH bytes
lose nothing; rows that repeat key and text are one document and get the same result each; different
texts under one key are documents in the order of their SHA-256; null keys come after all others; an
empty table gives no rows; only key and text are read, so other columns cannot clash.
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexmill.llm.hashing import BYTE, MIX_A, MIX_B, blocks, mix
from lexmill.llm.tables import as_bytes, drop_kept, fresh, keep, named, release, shuffles_go, sweep

#: Bytes of a repeated string, of an anchor's own string, and window starts that share an anchor at most.
LENGTH, SHALLOW = 100, 32
SPAN = LENGTH - SHALLOW + 1
#: Different pieces of a group in memory at most; groups up to SMALL are compared pair by pair.
GROUP, SMALL = 20_000, 12
#: Rows that the quicksort does not part any further.
FEW = 64
#: Bits of a position within a block, and window starts of a part of a very long text.
_POSITION = 20
_PART = 1_000_000


# --- anchors ------------------------------------------------------------------------------------


def anchors(buf: np.ndarray, ends: np.ndarray):
    """(hash, anchor, first window, windows) arrays of the runs of windows that share an anchor.

    buf holds whole texts or one part of a text; ends is the end of its text for each byte.
    """
    n = len(buf) - LENGTH + 1
    if n <= 0:
        return (np.zeros(0, np.uint64), *[np.zeros(0, np.int64)] * 3)
    h, step, by = BYTE[buf], 1, MIX_A
    while step < SHALLOW:
        h = h[:-step] * by + h[step:]
        step, by = step * 2, by * MIX_B | np.uint64(1)
    h = mix(h)
    low = np.uint64((1 << _POSITION) - 1)
    least = (h & ~low) | np.arange(len(h), dtype=np.uint64)
    step = 1
    while step * 2 <= SPAN:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    least = np.minimum(least[: n], least[SPAN - step : SPAN - step + n])
    at = (least & low).astype(np.int64)
    valid = np.arange(n) + LENGTH <= ends[:n]
    starts = valid.copy()
    starts[1:] &= (at[1:] != at[:-1]) | ~valid[:-1]
    first = np.flatnonzero(starts)
    stops = valid.copy()
    stops[:-1] &= starts[1:] | ~valid[1:]
    return h[at[first]], at[first], first, np.flatnonzero(stops) - first + 1


def text_anchors(texts: list[bytes]):
    """(text, hash, anchor, first window, windows) over a list of texts, positions within each text."""
    # an empty text would share the block of a long one after it
    full, out = np.array([k for k, t in enumerate(texts) if t], np.int64), []
    texts = [t for t in texts if t]
    for i, j in blocks([len(t) for t in texts], 1 << 17):
        if j == i + 1 and len(texts[i]) > _PART:
            whole = np.frombuffer(texts[i], np.uint8)
            for a in range(0, len(whole) - LENGTH + 1, _PART):
                part = whole[a : a + _PART + LENGTH - 1]
                h, at, first, n = anchors(part, np.full(len(part), len(part)))
                out.append((np.full(len(h), full[i]), h, at + a, first + a, n))
            continue
        sizes = np.array([len(t) for t in texts[i:j]])
        edges = np.concatenate([[0], np.cumsum(sizes)])
        h, at, first, n = anchors(np.frombuffer(b"".join(texts[i:j]), np.uint8), np.repeat(edges[1:], sizes))
        text = np.searchsorted(edges, first, side="right") - 1
        out.append((full[text + i], h, at - edges[text], first - edges[text], n))
    return [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, np.int64)] * 5


#: How a row meets others: it counts, it stands for several of its batch, or it only passes.
ONE, SEVERAL, PASSING = 0, 1, 2


def recurring_anchors(rows: DataFrame) -> DataFrame:
    """(id, anchor) of the anchors whose hash occurs at least twice; anchor packs position and windows."""

    def find(batches):
        for batch in batches:
            ids = batch.column(0).to_numpy()
            with np.errstate(over="ignore"):
                text, h, at, first, n = text_anchors(batch.column(1).to_pylist())
                if not len(h):
                    continue
                _, rep, back, count = np.unique(h, return_index=True, return_inverse=True, return_counts=True)
                kind = np.where(count[back] > 1, PASSING, ONE)
                kind[rep[count > 1]] = SEVERAL
                packed = (at << 18) | ((at - first) << 10) | (n << 2) | kind
                route = np.where(kind == PASSING, mix(h ^ packed.astype(np.uint64) ^ (text.astype(np.uint64) << np.uint64(40))), h)
            yield pa.RecordBatch.from_arrays([pa.array(route.view(np.int64)), pa.array(ids[text]), pa.array(packed)], names=["hash", "id", "anchor"])
        release()

    def meet(batches):
        """Of rows in order of their hash those that have a neighbour with it or stand for several. Only a
        batch's last row may have to wait for the next batch, so no hash is ever held whole."""
        names = ["id", "anchor"]
        before, waiting = None, np.zeros((3, 0), np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            h, ids, anchor = rows = np.concatenate([waiting, [c.to_numpy() for c in batch.columns]], axis=1)
            again = (anchor & 3) > ONE
            same = h[1:] == h[:-1]
            again[1:] |= same
            again[:-1] |= same
            again[0] |= h[0] == before
            waiting = rows[:, -1:] if not again[-1] else rows[:, :0]
            before = h[-1] if again[-1] else None
            yield pa.RecordBatch.from_arrays([pa.array(ids[again]), pa.array(anchor[again] >> 2)], names=names)
        release()

    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = rows.mapInArrow(find, "hash long, id long, anchor long").repartition(parts, "hash").sortWithinPartitions("hash")
    return met.mapInArrow(meet, "id long, anchor long")


# --- pieces -------------------------------------------------------------------------------------


def merged(intervals: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping or touching intervals as one, in order."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(intervals):
        if out and a <= out[-1][1]:
            if b > out[-1][1]:
                out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
    return out


def cut_pieces(texts: DataFrame) -> DataFrame:
    """(route, id, first, windows, left, piece) of the first occurrence of each piece in a batch, and
    with piece null the byte intervals [first, windows) that are repeats already."""

    kinds = [pa.int64()] * 5 + [pa.binary()]

    def run(batches):
        for batch in batches:
            ids, order = batch.column(0).to_numpy(), np.argsort(batch.column(0).to_numpy(), kind="stable").tolist()
            seen: set[bytes] = set()
            for i, j in blocks(pc.binary_length(batch.column(1)).to_numpy()[order].tolist(), 1 << 22):
                rows: list[tuple] = []
                for k in order[i:j]:
                    text, mine, one = batch.column(1)[k].as_py(), [], int(ids[k])
                    for anchor in np.sort(batch.column(2)[k].values.to_numpy()).tolist():
                        at, left, n = anchor >> 16, (anchor >> 8) & 255, anchor & 255
                        first = at - left
                        piece = text[first : first + n - 1 + LENGTH]
                        mark = xxhash.xxh3_128_digest(piece, left)
                        if mark in seen:
                            mine.append((first, first + n - 1 + LENGTH))
                        else:
                            seen.add(mark)
                            rows.append((xxhash.xxh3_64_intdigest(text[at : at + SHALLOW]) - (1 << 63), one, first, n, left, piece))
                    rows += [(xxhash.xxh3_64_intdigest(b"%d %d" % (one, a)) - (1 << 63), one, a, b, -1, None) for a, b in merged(mine)]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["route", "id", "first", "windows", "left", "piece"])
        release()

    return texts.mapInArrow(run, "route long, id long, first long, windows long, left long, piece binary")


class BlindTrie:
    """Orders strings with long common prefixes, reading few of their bytes.

    An insertion descends by the branching bytes alone, compares once with the leaf that it reaches,
    and branches where they first differ.
    """

    def __init__(self, strings: list[bytes]):
        self.strings = strings
        self.root: list | int = 0  # a leaf: the number of its first string; else [depth, {byte: child}]
        self.same: dict[int, list[int]] = {0: [0]}
        for k in range(1, len(strings)):
            self._insert(k)

    def _byte(self, k: int, depth: int) -> int:
        s = self.strings[k]
        return s[depth] if depth < len(s) else -1

    def _insert(self, k: int) -> None:
        node = self.root
        while not isinstance(node, int):
            depth, children = node
            node = children.get(self._byte(k, depth))
            if node is None:
                node = next(iter(children.values()))
        common = common_prefix(self.strings[k], self.strings[node])
        if common == len(self.strings[k]) == len(self.strings[node]):
            self.same[node].append(k)
            return
        self.same[k] = [k]
        parent, node = None, self.root
        while not isinstance(node, int) and node[0] < common:
            parent, node = node, node[1][self._byte(k, node[0])]
        if not isinstance(node, int) and node[0] == common:
            node[1][self._byte(k, common)] = k
            return
        leaf = node
        while not isinstance(leaf, int):
            leaf = next(iter(leaf[1].values()))
        branch = [common, {self._byte(leaf, common): node, self._byte(k, common): k}]
        if parent is None:
            self.root = branch
        else:
            parent[1][self._byte(k, parent[0])] = branch

    def order(self) -> tuple[list[int], list[int]]:
        """The strings in order, and each one's common prefix with the one before."""
        out, shared, stack = [], [], [(self.root, 0)]
        while stack:
            node, depth = stack.pop()
            if isinstance(node, int):
                for n, k in enumerate(self.same[node]):
                    out.append(k)
                    shared.append(depth if n == 0 else len(self.strings[k]))
            else:
                for _, child in sorted(node[1].items(), reverse=True):
                    stack.append((child, node[0]))
                # the least child continues at the depth of this node's own place
                child, _ = stack.pop()
                stack.append((child, depth))
        return out, shared


def common_prefix(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n  # a[:low] equal, a[:high] not
    while high - low > 1:
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low


def shallow_order(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Multikey quicksort of the rows of keys, whose columns hold eight bytes each: the order of the
    rows, and where groups of equal rows begin. Rows are parted by a pivot of one column into smaller,
    equal and larger ones; only the equal ones go on to the next column. Few rows are sorted at once.
    """
    n, depth = keys.shape
    order, done, stack = np.empty(n, np.int64), 0, [(np.arange(n), 0)]
    while stack:
        rows, level = stack.pop()
        if level < depth and len(rows) > FEW:
            word = keys[rows, level]
            pivot = np.sort(word[[0, len(word) // 2, -1]])[1]
            parts = ((word > pivot, level), (word == pivot, level + 1), (word < pivot, level))
            stack += [(rows[mask], at) for mask, at in parts if mask.any()]
            continue
        if level < depth and len(rows) > 1:
            rows = rows[np.lexsort(keys[rows, level:].T[::-1])]
        order[done : done + len(rows)] = rows
        done += len(rows)
    ranked = keys[order]
    return order, np.concatenate([[0], np.flatnonzero((ranked[1:] != ranked[:-1]).any(axis=1)) + 1, [n]])


def repeated_windows(pieces: list[bytes], left: np.ndarray, windows: np.ndarray) -> list[tuple[int, int, int]]:
    """(piece, first, last) runs of window starts, within the piece, that an earlier piece has too.

    The pieces share their anchor string; they are in order of occurrence and no two are equal.
    """
    m = len(pieces)
    if m <= SMALL:
        return _by_pairs(pieces, left, windows)
    after = [p[k:] for p, k in zip(pieces, left.tolist())]
    before = [p[k - 1 :: -1] if k else b"" for p, k in zip(pieces, left.tolist())]
    flagged = np.zeros((m, SPAN), bool)
    orders = []
    for strings in (after, before):
        order, shared = BlindTrie(strings).order()
        orders.append((np.array(order), np.array(shared)))
    index = np.arange(m)
    for back in range(SPAN):  # windows that begin so many bytes before the anchor
        has = (left >= back) & (left - back < windows)
        if has.sum() < 2:
            continue
        label = np.zeros(m, np.int64)
        for (order, shared), depth in zip(orders, (LENGTH - back, back)):
            cls = np.empty(m, np.int64)
            cls[order] = np.cumsum(shared < depth)
            label = label * (m + 1) + cls
        mine = index[has]
        _, first = np.unique(label[mine], return_index=True)
        later = np.ones(len(mine), bool)
        later[first] = False
        flagged[mine[later], left[mine[later]] - back] = True
    out = []
    for k in np.flatnonzero(flagged.any(axis=1)).tolist():
        edge = np.diff(np.concatenate([[0], flagged[k].astype(np.int8), [0]]))
        out += [(k, int(a), int(b) - 1) for a, b in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1))]
    return out


def _by_pairs(pieces, left, windows) -> list[tuple[int, int, int]]:
    out, left, windows = [], left.tolist(), windows.tolist()
    for j in range(1, len(pieces)):
        b, lb, mine = pieces[j], left[j], []
        for i in range(j):
            a, la = pieces[i], left[i]
            r = common_prefix(a[la:], b[lb:])
            if r + min(la, lb) < LENGTH:
                continue
            n = min(la, lb)
            x, y = a[la - n : la], b[lb - n : lb]
            common = n if x == y else common_prefix(x[::-1], y[::-1])
            # windows that begin `back` bytes before the anchor: within both pieces and the match
            most = min(common, n)
            least = max(LENGTH - r, la - windows[i] + 1, lb - windows[j] + 1, 0)
            if least <= most:
                mine.append((lb - most, lb - least + 1))
        out += [(j, a, b - 1) for a, b in merged(mine)]
    return out


def sort_pieces(pieces: DataFrame, most: int = GROUP) -> DataFrame:
    """(id, begin, end, left, piece): repeated byte intervals; with piece set, a piece of a group too
    large to hold, whose windows [begin, end) are still to be judged."""

    kinds = [pa.int64()] * 4 + [pa.binary()]

    def judged(group: list[tuple]):
        """group: (id, first, windows, left, piece) of different pieces in order of occurrence."""
        found = repeated_windows([g[4] for g in group], np.array([g[3] for g in group]), np.array([g[2] for g in group]))
        return ((group[k][0], group[k][1] + a, group[k][1] + b + LENGTH, -1, None) for k, a, b in found)

    def groups(held: list[tuple]):
        """The groups of two and more pieces that share their anchor string."""
        if held:
            keys = np.frombuffer(b"".join(g[4][g[3] : g[3] + SHALLOW] for g in held), ">u8").reshape(len(held), -1)
            order, edges = shallow_order(keys.astype(np.uint64))
            for k in np.flatnonzero(np.diff(edges) > 1).tolist():
                yield [held[i] for i in np.sort(order[edges[k] : edges[k + 1]]).tolist()]

    def run(batches):
        route, met, over, held = None, {}, False, []
        for batch in batches:
            rows: list[tuple] = []
            for r, id_, first, n, left, piece in zip(*(c.to_pylist() for c in batch.columns)):
                if piece is None:
                    rows.append((id_, first, n, -1, None))
                    continue
                if r != route:
                    if len(met) > 1:
                        held += met.values()
                    if len(held) > most:
                        rows += (x for group in groups(held) for x in judged(group))
                        held = []
                    route, met, over = r, {}, False
                if over:
                    rows.append((id_, first, first + n, left, piece))
                elif (left, piece) in met:
                    rows.append((id_, first, first + n - 1 + LENGTH, -1, None))
                else:
                    met[left, piece] = (id_, first, n, left, piece)
                    if len(met) > most:
                        rows += ((g[0], g[1], g[1] + g[2], g[3], g[4]) for g in met.values())
                        met, over = {}, True
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["id", "begin", "end", "left", "piece"])
        if len(met) > 1:
            held += met.values()
        if rows := [x for group in groups(held) for x in judged(group)]:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["id", "begin", "end", "left", "piece"])
        met, held, rows = {}, [], []
        release()

    parts = int(pieces.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = pieces.repartition(parts, "route").sortWithinPartitions("route", "id", "first")
    return met.mapInArrow(run, "id long, begin long, end long, left long, piece binary")


def judge_windows(large: DataFrame) -> DataFrame:
    """(id, begin, end) of repeated windows in the pieces of groups too large to hold."""

    def windows(batches):
        for batch in batches:
            for i, j in blocks(pc.binary_length(batch.column(4)).to_pylist(), 1 << 20):
                marks, ids, at = [], [], []
                for id_, begin, end, piece in zip(*(batch.column(k)[i:j].to_pylist() for k in (0, 1, 2, 4))):
                    marks += [xxhash.xxh3_128_digest(piece[k : k + LENGTH]) for k in range(end - begin)]
                    ids += [id_] * (end - begin)
                    at += range(begin, end)
                both = np.frombuffer(b"".join(marks), np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (both[:, 0], both[:, 1], ids, at)], names=["h", "g", "id", "at"])

    each = keep(large.mapInArrow(windows, "h long, g long, id long, at long"))
    first = each.groupBy("h", "g").agg(F.min(F.struct("id", "at")).alias("first"), F.count("*").alias("n")).filter("n > 1")
    later = each.join(first, ["h", "g"]).filter(F.struct("id", "at") != F.col("first"))
    return later.select("id", F.col("at").alias("begin"), (F.col("at") + LENGTH).alias("end"))


# --- operator -----------------------------------------------------------------------------------


def _cut(rows: DataFrame) -> DataFrame:
    """(id, removed, kept, n_spans) of (id, text, intervals)."""

    def run(batches):
        for batch in batches:
            kept, removed, spans = [], [], []
            for text, found in zip(batch.column(1), batch.column(2)):
                text = text.as_py()
                flat = found.values.flatten() if len(found) else None
                cuts = merged(list(zip(flat[0].to_pylist(), flat[1].to_pylist()))) if flat else []
                edge = [0, *(x for c in cuts for x in c), len(text)]
                kept.append(b"".join(text[a:b] for a, b in zip(edge[::2], edge[1::2])))
                removed.append(len(text) - len(kept[-1]))
                spans.append(len(cuts))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(removed, pa.int64()), pa.array(kept, pa.binary()), pa.array(spans, pa.int64())], names=["id", "n_removed", "kept", "n_spans"])
        release()

    return rows.mapInArrow(run, "id long, n_removed long, kept binary, n_spans long")


def _shortened(rows: DataFrame, most: int, finish) -> DataFrame:
    """finish(id, n_removed, kept, n_spans) of the texts that lose something, for rows (id, text) of unique ids.

    finish is narrow or has shortened texts only; it is written, and the tables that led to it go.
    """
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = keep(recurring_anchors(rows).groupBy("id").agg(F.collect_list("anchor").alias("anchors")))
    name = f"lexmill_texts_{uuid.uuid4().hex}"
    with shuffles_go(spark):
        rows.join(found, "id").write.option("compression", "zstd").bucketBy(parts, "id").saveAsTable(name, format="parquet")
    drop_kept(spark, found)
    texts = spark.table(name)
    judged = keep(sort_pieces(cut_pieces(texts), most))
    intervals = judged.filter("piece is null").select("id", "begin", "end")
    large = judged.filter("piece is not null")
    if not large.isEmpty():
        intervals = intervals.unionByName(judge_windows(large))
    grouped = intervals.groupBy("id").agg(F.collect_list(F.struct("begin", "end")).alias("intervals"))
    out = keep(finish(_cut(texts.select("id", "text").join(grouped, "id").select("id", "text", "intervals"))))
    drop_kept(spark, judged)
    spark.sql(f"DROP TABLE {name}")
    sweep(spark)
    return out


def _tagged(df: DataFrame, key: str, text: str) -> tuple[DataFrame, str, bool]:
    """df with a column that numbers its documents in order, that column's name, and whether each
    document has one row."""
    name = fresh(df, "_document")
    if isinstance(df.schema[key].dataType, (T.LongType, T.IntegerType, T.ShortType)):
        n = df.agg(F.count("*").alias("n"), F.countDistinct(key).alias("different")).first()
        if n["n"] == n["different"]:
            return df.withColumn(name, F.col(key).cast("long")), name, True
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sha = F.unhex(F.sha2(as_bytes(text), 256))
    found = df.select(F.col(key).alias("key"), sha.alias("sha")).distinct()
    order = [F.col("key").isNull(), F.col("key"), F.col("sha")]
    # parts are in order and keep the order of their rows, so these numbers do
    numbers = keep(found.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn(name, F.monotonically_increasing_id()))
    renamed = df.select(*(named(c).alias(f"c{k}") for k, c in enumerate(df.columns)))
    its_key, its_text = (F.col(f"c{df.columns.index(c)}") for c in (key, text))
    joined = renamed.join(numbers, its_key.eqNullSafe(F.col("key")) & (F.unhex(F.sha2(F.coalesce(its_text, F.lit("")).cast("binary"), 256)) == F.col("sha")))
    return keep(joined.select(*(F.col(f"c{k}").alias(c) for k, c in enumerate(df.columns)), name)), name, False


def _cut_texts(tagged: DataFrame, name: str, text: str, once: bool, most: int, finish) -> DataFrame:
    documents = tagged.select(F.col(name).alias("id"), as_bytes(text).alias("text"))
    if not once:
        documents = documents.dropDuplicates(["id"])
    return _shortened(documents, most, finish)


def removed_repeats(df: DataFrame, key: str = "doc_id", text: str = "text", most: int = GROUP) -> DataFrame:
    """(key, n_bytes, n_removed, n_spans, kept_sha256) of each row. most: pieces of a group in memory."""
    tagged, name, once = _tagged(df, key, text)

    def digest(batches):
        for batch in batches:
            digests = [hashlib.sha256(k.as_py()).hexdigest() for k in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(3), pa.array(digests, pa.string())], names=["id", "n_removed", "n_spans", "kept_sha256"])

    changed = _cut_texts(tagged, name, text, once, most, lambda cut: cut.mapInArrow(digest, "id long, n_removed long, n_spans long, kept_sha256 string"))
    data = as_bytes(text)
    facts = tagged.select(F.col(name).alias("id"), F.col(key).alias("key"), F.octet_length(data).cast("long").alias("n_bytes"), F.sha2(data, 256).alias("sha"))
    none = F.lit(0).cast("long")
    return facts.join(changed, "id", "left").select(
        F.col("key").alias(key), "n_bytes", F.coalesce("n_removed", none).alias("n_removed"), F.coalesce("n_spans", none).alias("n_spans"), F.coalesce("kept_sha256", "sha").alias("kept_sha256")
    )


def remove_repeats(df: DataFrame, key: str = "doc_id", text: str = "text", most: int = GROUP) -> DataFrame:
    """df with the repeated substrings gone from its text; a character that lost some of its bytes
    goes whole. Other columns stay as they are."""
    tagged, name, once = _tagged(df, key, text)

    def decode(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([k.as_py().decode("utf-8", "ignore") for k in batch.column(2)], pa.string())], names=["id", "kept"])

    kept = _cut_texts(tagged, name, text, once, most, lambda cut: cut.filter("n_removed > 0").mapInArrow(decode, "id long, kept string"))
    own = fresh(tagged, "_kept")
    joined = tagged.join(kept.select(F.col("id").alias(name), F.col("kept").alias(own)), name, "left")
    return joined.select(*(F.coalesce(own, c).alias(c) if c == text else named(c) for c in df.columns))
