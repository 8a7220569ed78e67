"""Operator 8, an exact N-gram Jaccard join by grouped prefixes.

Words are runs of bytes other than white space, A-Z lower-cased; a document's set holds the 64-bit
hashes of its distinct `words`-word shingles (fewer words: the whole sequence as one). Two
documents link when 100 * intersection >= percent * union.

1. Documents with equal sets become one node (minimum by set, summed before the shuffle).
2. Shingles are ordered by hash, with the most frequent ones of all prefixes last; linked sets share
   a shingle in the prefixes that this order gives. Nodes with identical prefix and size become one
   group, which stands for its members.
3. Prefix shingles of two or more groups make cells. In a cell, group pairs are filtered by an
   upper bound of their intersection (counts of the set in hash ranges, more for larger sets); only a spanning forest
   of the surviving pairs leaves the cell, so a cell's output grows with its rows, not its pairs.
4. The forest's components are candidate clusters. Groups are expanded to their members, whose whole
   sets meet once in their cluster's cell and are verified exactly, walking from set to set so that
   a set that is already linked to another needs no second link.
5. Verified links join the components; each document gets the least key of its component.

A cell or cluster over CELL rows is cut into blocks, and each pair of blocks is a cell of its own,
so no group is gathered in one task; a cell of n rows then costs n / CELL copies of each row, which
only texts that consist of frequent shingles can reach. Nothing is capped: the list of frequent
shingles only orders. Joins on a set with very many copies, or on a component of very many sets,
take that key by broadcast (tables.hub_join). Only groups hold prefixes and counts, and they go once
candidates are known; all later tables are narrow. Shingles are told apart within a pair of documents, and sets
among all, by 64-bit hashes: among 10^10 different sets some three pairs may be taken for equal by chance.

Defined results: null and empty texts have no shingles and stand alone; a row with a null key has a
null component and links with nothing; rows that repeat a key are documents of their own with the
same key (first_of_each tells them apart by their texts); an empty table gives no rows; other columns are not read, so they cannot clash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.llm.graph import components
from lexmill.llm.hashing import BASE, blocks, mix, shingle_hashes, span_hashes, word_spans
from lexmill.llm.tables import as_bytes, columns, drop_kept, fresh, hub_join, keep, listed, release, sweep

WORDS, PERCENT = 5, 80
#: A shingle in so many prefixes is frequent; the list that orders has so many of them at most.
FREQUENT, FREQUENT_LISTED = 64, 500_000
#: Rows of a cell at most, and shingles of a cluster's cell.
CELL, CELL_SHINGLES = 2000, 2_000_000
#: Hash ranges whose counts bound an intersection: about one for 4 to 8 shingles, within these limits.
RANGES, MOST_RANGES, IN_RANGE = 128, 8192, 8


def shingle_sets(texts: list[bytes], words: int):
    """The sorted distinct shingle hashes of each text."""
    for i, j in blocks([len(t) for t in texts], 1 << 18):
        some = [t.lower() for t in texts[i:j]]
        buf = np.frombuffer(b"\n".join(some) + b"\n", np.uint8)
        starts, ends = word_spans(buf)
        hashes = span_hashes(buf, starts, ends)
        edges = np.searchsorted(starts, np.concatenate([[0], np.cumsum([len(t) + 1 for t in some])])).tolist()
        shingles = shingle_hashes(hashes, words) if len(hashes) >= words else hashes[:0]
        for a, b in zip(edges, edges[1:]):
            if b - a >= words:
                s = np.sort(shingles[a : b - words + 1])
                yield s[np.concatenate([[True], s[1:] != s[:-1]])]
            elif b > a:
                whole = np.uint64(b - a)
                for h in hashes[a:b]:
                    whole = mix(np.array([whole * BASE + h]))[0]
                yield np.array([whole], np.uint64)
            else:
                yield hashes[:0]


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def features(rows: DataFrame, words: int, percent: int, frequent: tuple[np.ndarray, np.ndarray] | None) -> DataFrame:
    """(key, mark, n, node, gid, prefix, counts) of each (key, text, mark): node stands for the set, gid for its size and prefix."""
    shared = rows.sparkSession.sparkContext.broadcast(frequent)

    def run(batches):
        known, level = shared.value or (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        for batch in batches:
            n, node, gid, prefix, counts = [], [], [], [], []
            with np.errstate(over="ignore"):
                for s in shingle_sets(batch.column(1).to_pylist(), words):
                    size = len(s)
                    n.append(size)
                    node.append(xxhash.xxh64_intdigest(s.tobytes()) - (1 << 63))
                    length = size - -(-percent * size // 100) + 1 if size else 0
                    if len(known) and size:
                        at = np.searchsorted(known, s)
                        at[at == len(known)] = 0
                        late = np.where(known[at] == s, level[at], 0)
                        if late.any():
                            s = s[np.argsort(late, kind="stable")]
                    prefix.append(_signed(s[:length]))
                    gid.append(xxhash.xxh64_intdigest(s[:length].tobytes(), size) - (1 << 63))
                    ranges = RANGES
                    while ranges < MOST_RANGES and IN_RANGE * ranges < size:
                        ranges *= 2
                    counts.append(np.minimum(np.bincount((s >> np.uint64(65 - ranges.bit_length())).astype(np.int64), minlength=ranges), 255).astype(np.uint8).tobytes())
            offsets = np.concatenate([[0], np.cumsum([len(p) for p in prefix])]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(prefix) if prefix else np.zeros(0, np.int64)))
            numbers = [pa.array(c, pa.int64()) for c in (n, node, gid)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), *numbers, lists, pa.array(counts, pa.binary())], names=["key", "mark", "n", "node", "gid", "prefix", "counts"])
        release()

    return rows.mapInArrow(run, f"key {dict(rows.dtypes)['key']}, mark long, n long, node long, gid long, prefix array<long>, counts binary")


def frequent_shingles(rows: DataFrame, words: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """The shingles in the most prefixes (in the order of hashes), over all documents, and their place in the order."""
    seen = features(rows, words, percent, None).select(F.explode("prefix").alias("shingle"))
    often = keep(seen.groupBy("shingle").agg(F.count("*").alias("df")).filter(F.col("df") >= FREQUENT))
    top = often.orderBy(F.desc("df"), "shingle").limit(FREQUENT_LISTED).toPandas()
    drop_kept(rows.sparkSession, often)
    token, df = top["shingle"].to_numpy(np.int64).view(np.uint64), top["df"].to_numpy(np.int64)
    order = np.argsort(token)
    return token[order], 1 + np.log2(np.maximum(df[order], 1)).astype(np.int64)


# --- cells --------------------------------------------------------------------------------------


def _whole_cells(batches, n_keys: int):
    """Record batches sorted by their first n_keys columns, cut again so that no cell is divided."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(k).to_numpy() for k in range(n_keys)])
        cut = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
        first = [held[-1].column(k)[-1].as_py() for k in range(n_keys)] if held else None
        if held and first != keys[:, 0].tolist():
            yield pa.Table.from_batches(held).combine_chunks()
            held = []
        if len(cut):
            yield pa.Table.from_batches([*held, batch.slice(0, cut[-1])]).combine_chunks()
            held = []
            batch = batch.slice(cut[-1])
        held.append(batch)
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _cells(table: pa.Table, n_keys: int):
    keys = np.stack([table.column(k).to_numpy() for k in range(n_keys)])
    return np.concatenate([[0], np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1, [table.num_rows]])


def forest(size: int, side: np.ndarray, cross: bool, linked):
    """Edges (i, j) of a spanning forest of the link graph; linked(i, others) -> mask of others.

    Across two blocks only pairs of different sides count.
    """
    left = np.arange(size)
    stack: list[int] = []
    while len(left) or stack:
        if stack:
            i = stack.pop()
        else:
            i, left = int(left[0]), left[1:]
        others = left[side[left] != side[i]] if cross else left
        if not len(others):
            if not cross and not len(left):
                return
            continue
        found = others[linked(i, others)]
        if len(found):
            for j in found.tolist():
                yield i, j
            stack += found.tolist()
            left = left[~np.isin(left, found, assume_unique=True)]


def _folded(counts: np.ndarray, ranges: int) -> np.ndarray:
    """Counts of a finer division as those of a coarser one."""
    return counts.reshape(ranges, -1).sum(axis=1, dtype=np.int64)


def _in_blocks(df: DataFrame, cell, node: str, parts) -> DataFrame:
    """Adds bi, bj, side: a row of a cell of `parts` blocks goes to each pair that holds its block."""
    side = F.pmod(F.xxhash64(F.lit(8), F.col(node)), parts).cast("int")
    other = F.explode(F.sequence(F.lit(0), (parts - 1).cast("int")))
    out = df.withColumn("side", side).withColumn("other", other)
    return out.withColumn("bi", F.least("side", "other")).withColumn("bj", F.greatest("side", "other")).drop("other")


def _dealt(df: DataFrame, *cell: str, then: str | None = None) -> DataFrame:
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(parts, *cell).sortWithinPartitions(*cell, *([then] if then else []))


def _once(batches):
    """Without the rows whose cell and node are those of the row before."""
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(c).to_numpy() for c in ("cluster", "bi", "bj", "node")])
        new = np.ones(batch.num_rows, bool)
        new[1:] = (keys[:, 1:] != keys[:, :-1]).any(axis=0)
        new[0] = last is None or (keys[:, 0] != last).any()
        last = keys[:, -1]
        yield batch.filter(pa.array(new))


def candidate_edges(groups: DataFrame, percent: int) -> DataFrame:
    """(a, b): for each shared prefix shingle a spanning forest of the group pairs that may link."""
    shingles = groups.select("gid", F.explode("prefix").alias("shingle"))
    shared = shingles.groupBy("shingle").agg(F.count("*").alias("df")).filter("df > 1")
    met = shingles.join(shared, "shingle").join(groups.select("gid", "n", "counts"), "gid")
    cells = _in_blocks(met, "shingle", "gid", F.ceil(F.col("df") / CELL))
    cells = _dealt(cells.select("shingle", "bi", "bj", "side", "gid", "n", "counts"), "shingle", "bi", "bj")

    def run(batches):
        for table in _whole_cells(batches, 3):
            edges = _cells(table, 3)
            crossed = (table["bi"].to_numpy() != table["bj"].to_numpy())[edges[:-1]]
            side, gid, n = (table[c].to_numpy() for c in ("side", "gid", "n"))
            fine = [np.frombuffer(c, np.uint8) for c in table["counts"].to_pylist()]
            counts = np.stack([c if len(c) == RANGES else _folded(c, RANGES) for c in fine])
            full = np.array([c.max() == 255 for c in fine])
            out_a, out_b = [], []

            def enough(bound, i, j):
                return bound * (100 + percent) >= percent * (n[i] + n[j])

            def may_link(i, j):
                """i: a row or rows; j: rows. By few ranges first, then by as many as both have."""
                bound = np.minimum(np.minimum(counts[i], counts[j]).sum(axis=-1, dtype=np.int64), np.minimum(n[i], n[j]))
                known = ~(full[i] | full[j])
                passed = np.where(known, enough(bound, i, j), enough(np.minimum(n[i], n[j]), i, j))
                i = np.broadcast_to(i, j.shape)
                for k in np.flatnonzero(passed & known).tolist():
                    a, b = fine[i[k]], fine[j[k]]
                    if (ranges := min(len(a), len(b))) > RANGES:
                        passed[k] = enough(int(np.minimum(_folded(a, ranges), _folded(b, ranges)).sum()), i[k], j[k])
                return passed

            two = np.flatnonzero(np.diff(edges) == 2)
            for k in range(0, len(two), 20_000):
                i = edges[two[k : k + 20_000]]
                i = i[~crossed[two[k : k + 20_000]] | (side[i] != side[i + 1])]
                i = i[may_link(i, i + 1)]
                out_a.append(gid[i])
                out_b.append(gid[i + 1])
            for k in np.flatnonzero(np.diff(edges) > 2).tolist():
                low, high = int(edges[k]), int(edges[k + 1])
                pairs = list(forest(high - low, side[low:high], bool(crossed[k]), lambda i, others: may_link(low + i, low + others)))
                if pairs:
                    i, j = np.array(pairs).T
                    out_a.append(gid[low + i])
                    out_b.append(gid[low + j])
            if out_a:
                a, b = np.concatenate(out_a), np.concatenate(out_b)
                once = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(once[:, 0]), pa.array(once[:, 1])], names=["a", "b"])
        release()

    return cells.mapInArrow(run, "a long, b long")


def verified_edges(rows: DataFrame, members: DataFrame, words: int, percent: int) -> DataFrame:
    """(a, b): exact links that join the nodes of each cluster as all its exact links would.

    rows (key, text, mark); members (key, mark, node, n, cluster): one key and text for each node.
    """
    # kept, so that the join below has plain exchanges on both sides and Spark can split a large cluster
    size = keep(members.groupBy("cluster").agg(F.count("*").alias("size"), F.sum("n").alias("total")).filter("size > 1"))
    wanted = members.join(size, "cluster")
    wanted = keep(wanted.select("key", "mark", "node", "cluster", "size", "total"))
    texts = rows.join(listed(wanted), ["key", "mark"])

    def sets(batches):
        for batch in batches:
            with np.errstate(over="ignore"):
                found = [s.tobytes() for s in shingle_sets(batch.column(0).to_pylist(), words)]
            # rows that repeat key and text pass once for each batch
            nodes = batch.column(1).to_pylist()
            first = {node: k for k, node in reversed([*enumerate(nodes)])}
            same = [xxhash.xxh64_intdigest(s) - (1 << 63) == node and first[node] == k for k, (s, node) in enumerate(zip(found, nodes))]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(found, pa.binary())], names=["node", "cluster", "size", "total", "set"]).filter(pa.array(same))
        release()

    with_sets = texts.select("text", "node", "cluster", "size", "total").mapInArrow(sets, "node long, cluster long, size long, total long, set binary")
    parts = F.greatest(F.ceil(F.col("size") / CELL), F.ceil(F.col("total") / CELL_SHINGLES))
    cells = _in_blocks(with_sets, "cluster", "node", parts).select("cluster", "bi", "bj", "side", "node", "set")
    cells = _dealt(cells, "cluster", "bi", "bj", then="node")

    def run(batches):
        for table in _whole_cells(_once(batches), 3):
            edges, out = _cells(table, 3), []
            crossed = (table["bi"].to_numpy() != table["bj"].to_numpy())[edges[:-1]]
            sides, nodes = table["side"].to_numpy(), table["node"].to_numpy()
            for k in range(len(edges) - 1):
                low, high = int(edges[k]), int(edges[k + 1])
                if high - low < 2:
                    continue
                side, node = sides[low:high], nodes[low:high]
                held = [np.frombuffer(table["set"][i].as_py(), np.uint64) for i in range(low, high)]
                n = np.array([len(s) for s in held])

                def linked(i, others):
                    near = (np.minimum(n[i], n[others]) * 100 >= percent * np.maximum(n[i], n[others])).nonzero()[0]
                    mask = np.zeros(len(others), bool)
                    if len(near):
                        some = [held[j] for j in others[near].tolist()]
                        every = np.concatenate(some)
                        at = np.searchsorted(held[i], every)
                        at[at == n[i]] = 0
                        both = np.add.reduceat((held[i][at] == every).astype(np.int64), np.concatenate([[0], np.cumsum(n[others[near]])[:-1]]))
                        mask[near] = both * 100 >= percent * (n[i] + n[others[near]] - both)
                    return mask

                out += [(int(node[i]), int(node[j])) for i, j in forest(len(node), side, bool(crossed[k]), linked)]
            if out:
                a, b = zip(*out)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])
        release()

    return cells.mapInArrow(run, "a long, b long")


# --- operator -----------------------------------------------------------------------------------


def labelled(df: DataFrame, key: str, text: str, words: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """(key, mark, n) of the rows that link with nothing, and (key, mark, n, label, component_id) of the others.

    mark is a hash of the text; label is the component's own number, as different components may
    have the same least key where keys repeat.
    """
    spark = df.sparkSession
    every = df.select(F.col(key).alias("key"), as_bytes(text).alias("text"), F.xxhash64(as_bytes(text)).alias("mark"))
    rows = every.filter("key is not null")
    wide = keep(features(every, words, percent, frequent_shingles(rows, words, percent)))
    base = keep(wide.select("key", "mark", "n", "node", "gid"))
    # sets with one prefix and size are one group, with counts that exclude nothing if its sets differ
    grouped = wide.filter("key is not null and n > 0").groupBy("gid").agg(F.first("n").alias("n"), F.first("prefix").alias("prefix"), F.first("counts").alias("counts"), (F.min("node") != F.max("node")).alias("several"))
    anything = F.lit(bytes([255]) * RANGES)
    groups = keep(grouped.withColumn("counts", F.when(F.col("several"), anything).otherwise(F.col("counts"))))
    drop_kept(spark, wide)
    clusters = components(candidate_edges(groups, percent))
    drop_kept(spark, groups)
    linking = base.filter("key is not null and n > 0")
    nodes = keep(linking.groupBy("node", "n", "gid").agg(F.min(F.struct("key", "mark")).alias("first"), F.count("*").alias("copies")))
    nodes = nodes.select("node", "n", "gid", "first.key", "first.mark", "copies")
    members = nodes.join(clusters.withColumnRenamed("node", "gid"), "gid", "left").select("key", "mark", "node", "n", F.coalesce("component", "gid").alias("cluster"))
    linked = components(verified_edges(rows, keep(members), words, percent))
    joined = keep(nodes.join(linked, "node", "left").select("node", "copies", "key", F.coalesce("component", "node").alias("label")))
    heads = keep(joined.groupBy("label").agg(F.min("key").alias("component_id"), F.count("*").alias("sets")))
    named = keep(hub_join(joined.select("node", "copies", "label"), heads, "label", "sets", joined.count()))
    found = hub_join(linking, named, "node", "copies", base.count())
    return base.filter("key is null or n = 0").select("key", "mark", "n"), found.select("key", "mark", "n", "label", "component_id")


def jaccard_components(df: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(key, n_shingles, component_id) of each row."""
    alone, found = labelled(df, key, text, words, percent)
    names = [F.col("key").alias(key), F.col("n").alias("n_shingles")]
    return alone.select(*names, F.col("key").alias("component_id")).unionByName(found.select(*names, "component_id"))


def first_of_each(df: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """df with one row of each component: the least key's, and of its texts the one with the least hash.

    Rows without a key or without words all stay; of rows that repeat key and text one stays. Texts
    are not shuffled while the rows that go, or that repeat, are a list short enough to broadcast.
    """
    _, found = labelled(df, key, text, words, percent)
    pairs = keep(found.groupBy("label", "key", "mark").agg(F.count("*").alias("rows")))
    best = keep(pairs.groupBy("label").agg(F.min(F.struct("key", "mark")).alias("best"), F.count("*").alias("pairs")))
    told = hub_join(pairs, best, "label", "pairs", pairs.count())
    stays = (F.col("key") == F.col("best.key")) & (F.col("mark") == F.col("best.mark"))
    odd = keep(told.filter(~stays | (F.col("rows") > 1)).select("key", "mark", stays.alias("stays")))
    sweep(df.sparkSession)
    mark, odd_key, odd_mark, stays = (fresh(df, c) for c in ("mark", "odd_key", "odd_mark", "stays"))
    marked = df.withColumn(mark, F.xxhash64(as_bytes(text)))
    side = listed(odd.select(F.col("key").alias(odd_key), F.col("mark").alias(odd_mark), F.col("stays").alias(stays)))
    joined = marked.join(side, (F.col(key) == F.col(odd_key)) & (F.col(mark) == F.col(odd_mark)), "left")
    kept = joined.filter(F.col(stays).isNull()).select(columns(df))
    if odd.filter("stays").isEmpty():
        return kept
    return kept.unionByName(joined.filter(F.col(stays)).dropDuplicates([key, mark]).select(columns(df)))
