import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexmill.llm import graph, hashing, near_duplicates, suffix_dedup
from tests.llm import cases


def brute_repeats(rows):
    seen, out = set(), {}
    for key, text in sorted(rows):
        b = (text or "").encode()
        mask = bytearray(len(b))
        for k in range(len(b) - 99):
            w = b[k : k + 100]
            if w in seen:
                mask[k : k + 100] = b"\1" * 100
            else:
                seen.add(w)
        kept = bytes(x for x, m in zip(b, mask) if not m)
        spans = sum(1 for k, m in enumerate(mask) if m and not (k and mask[k - 1]))
        out[key] = (len(b), sum(mask), spans, hashlib.sha256(kept).hexdigest())
    return out


def as_repeats(df):
    return {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in df.collect()}


def test_repeats_match_brute_force(spark):
    df = cases.frame(spark)
    assert as_repeats(suffix_dedup.removed_repeats(df)) == brute_repeats([(r.doc_id, r.text) for r in df.collect()])


def test_small_limits_give_the_same(spark):
    df = cases.frame(spark, cases.texts(11, 24))
    assert as_repeats(suffix_dedup.removed_repeats(df, most=1)) == brute_repeats([(r.doc_id, r.text) for r in df.collect()])


def test_recurring_anchors_over_batch_edges(spark):
    rng = random.Random(17)
    common = cases.words(rng, 60)[:160]
    rows = [(k, cases.words(rng, 20) + common + cases.words(rng, 20) if k % 3 else common * 3) for k in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute_repeats(rows)
    batch = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        for size in ("1", "2", "7"):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
            assert as_repeats(suffix_dedup.removed_repeats(df)) == want
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("lexmill_texts_")]


def test_groups_too_large_to_hold_give_the_same(spark):
    rng = random.Random(3)
    common = cases.words(rng, 20)[:105]
    rows = [cases.words(rng, 30) + common + cases.words(rng, 30) for _ in range(40)]
    large = [(k, 0, 69, 20, (r.encode())[:168]) for k, r in enumerate(rows)]
    schema = "id long, begin long, end long, left long, piece binary"
    got = {(r.id, r.begin) for r in suffix_dedup.judge_windows(spark.createDataFrame(large, schema)).collect()}
    seen, want = set(), set()
    for k, _, n, _, piece in large:
        for at in range(n):
            w = piece[at : at + 100]
            if w in seen:
                want.add((k, at))
            seen.add(w)
    assert got == want


@pytest.mark.parametrize("seed", range(6))
def test_tries_and_pairs_agree(seed, monkeypatch):
    rng = random.Random(seed)
    anchor = bytes(rng.choice(b"ab") for _ in range(32))
    pieces, left, windows = [], [], []
    for _ in range(30):
        n, before = rng.randint(1, 69), 0
        before = rng.randint(n - 1, 68)
        tail = n - 1 + 100 - before - 32
        p = bytes(rng.choice(b"a" * 9 + b"b") for _ in range(before)) + anchor + bytes(rng.choice(b"a" * 9 + b"b") for _ in range(tail))
        if (before, p) not in [(l, q) for l, q in zip(left, pieces)]:
            pieces.append(p), left.append(before), windows.append(n)
    import numpy as np

    def flags(found):
        return {(k, s) for k, a, b in found for s in range(a, b + 1)}

    seen, want = set(), set()
    for k, (p, l, n) in enumerate(zip(pieces, left, windows)):
        own = {(l - s, p[s : s + 100]) for s in range(n)}
        want |= {(k, s) for s in range(n) if (l - s, p[s : s + 100]) in seen}
        seen |= own
    by_trie = suffix_dedup.repeated_windows(pieces, np.array(left), np.array(windows))
    assert flags(by_trie) == want
    monkeypatch.setattr(suffix_dedup, "SMALL", 100)
    assert flags(suffix_dedup.repeated_windows(pieces, np.array(left), np.array(windows))) == want


def test_empty_texts_before_a_very_long_one(spark):
    rng = random.Random(14)
    long = "".join(rng.choices("abcdefgh ", k=1_200_000))
    long += long[1_100_000:1_100_400] + long[1_060_000:1_060_250]
    for before in (["", None], ["".join(rng.choices("xyz ", k=200_000)), ""]):
        rows = [*before, long, "so " + long[1_150_000:1_150_300], ""]
        df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").coalesce(1)
        got = as_repeats(suffix_dedup.removed_repeats(df))
        assert got == brute_repeats(list(enumerate(rows)))
        assert got[2][1] == 650 and got[3][1] == 300


@pytest.mark.parametrize("few", (1, 64))
def test_shallow_order_sorts(few, monkeypatch):
    import numpy as np

    monkeypatch.setattr(suffix_dedup, "FEW", few)
    rng = np.random.default_rng(few)
    for n, values in ((1, 2), (2, 1), (500, 2), (2000, 5), (700, 1 << 60)):
        keys = rng.integers(0, values, (n, 4)).astype(np.uint64)
        order, edges = suffix_dedup.shallow_order(keys)
        rows = [tuple(r) for r in keys.tolist()]
        assert order.tolist() == sorted(range(n), key=lambda k: (rows[k], k))
        ranked = [rows[k] for k in order]
        assert edges.tolist() == [k for k in range(n) if not k or ranked[k] != ranked[k - 1]] + [n]


def test_blind_trie_orders():
    rng = random.Random(1)
    strings = [bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 12))) for _ in range(200)]
    order, shared = suffix_dedup.BlindTrie(strings).order()
    got = [strings[k] for k in order]
    assert got == sorted(strings)
    assert shared[1:] == [suffix_dedup.common_prefix(a, b) for a, b in zip(got, got[1:])]


def test_repeated_keys_and_nulls(spark):
    t = "x y z " * 40
    rows = [(1, t), (1, t), (1, "other " + t), (None, t), (None, None), (0, "short")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = suffix_dedup.removed_repeats(df).collect()
    assert len(got) == 6
    assert sum(r.n_removed == len(t) for r in got if r.doc_id is None) == 1
    first = [r for r in got if r.doc_id == 1]
    assert first[0].n_bytes and len({(r.n_bytes, r.n_removed) for r in first}) == 2


def test_remove_repeats_keeps_columns(spark):
    df = cases.frame(spark)
    out = suffix_dedup.remove_repeats(df)
    assert out.columns == df.columns
    want = brute_repeats([(r.doc_id, r.text) for r in df.collect()])
    for r in out.collect():
        if r.text is not None and r.text.isascii():
            assert len(r.text) == want[r.doc_id][0] - want[r.doc_id][1]


def test_empty_tables(spark):
    df = cases.empty(spark)
    assert suffix_dedup.removed_repeats(df).count() == 0
    assert near_duplicates.jaccard_components(df).count() == 0


# --- near duplicates --------------------------------------------------------------------------------


def sets_of(rows, n):
    out = {}
    for key, text in rows:
        w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
        out[key] = frozenset(tuple(w[k : k + n]) for k in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])
    return out


def brute_components(rows, n, percent):
    sets = sets_of(rows, n)
    parent = {k: k for k in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {k: (len(sets[k]), find(k)) for k in sets}


@pytest.mark.parametrize("n,percent", [(4, 85), (5, 80)])
def test_components_match_brute_force(spark, n, percent):
    df = cases.frame(spark)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates.jaccard_components(df, words=n, percent=percent).collect()}
    assert got == brute_components([(r.doc_id, r.text) for r in df.collect()], n, percent)


def test_large_cells_are_cut_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(near_duplicates, "CELL", 5)
    monkeypatch.setattr(near_duplicates, "FREQUENT", 3)
    rng = random.Random(5)
    base = cases.words(rng, 100).split(" ")
    rows = []
    for _ in range(40):
        w = list(base)
        w[rng.randrange(100)] = cases.words(rng, 1)
        rows.append(" ".join(w))
    df = cases.frame(spark, rows + cases.texts(9, 12))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates.jaccard_components(df, words=4, percent=85).collect()}
    assert got == brute_components([(r.doc_id, r.text) for r in df.collect()], 4, 85)


def test_long_sets_meet_by_finer_ranges(spark):
    rng = random.Random(6)
    base = cases.words(rng, 5000).split(" ")
    rows = [" ".join(base), " ".join([*base[:2400], "changed", *base[2401:4700]]), cases.words(rng, 5000), cases.words(rng, 4800), " ".join(base[:2500]), cases.words(rng, 1100)]
    df = cases.frame(spark, rows)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates.jaccard_components(df, words=4, percent=85).collect()}
    assert got == brute_components([(r.doc_id, r.text) for r in df.collect()], 4, 85)
    assert got[1][1] == 0 and got[4][1] == 4


def test_null_keys_link_with_nothing(spark):
    df = spark.createDataFrame([(None, "a b c d e f"), (3, "a b c d e f"), (2, "a b c d e f"), (2, "a b c d e f")], "doc_id long, text string")
    got = sorted((r.doc_id or -1, r.component_id) for r in near_duplicates.jaccard_components(df).collect())
    assert got == [(-1, None), (2, 2), (2, 2), (3, 2)]


def test_one_key_for_many_rows(spark):
    """A key that a third of the rows share, with equal and with different texts, does not multiply them."""
    rng = random.Random(23)
    base = cases.words(rng, 40).split(" ")
    near = [" ".join([*base[:k], "other", *base[k + 1 :]]) for k in range(40)]
    rows = [(7, t) for t in near for _ in range(5)] + [(100 + k, t) for k, t in enumerate(near)] + [(200 + k, cases.words(rng, 20)) for k in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = near_duplicates.jaccard_components(df).collect()
    want = brute_components(list(enumerate(t for _, t in rows)), 5, 80)
    assert len(got) == len(rows)
    first = {}
    for k, (_, c) in want.items():
        first[c] = min(first.get(c, 1 << 60), rows[k][0])
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == sorted((rows[k][0], n, first[c]) for k, (n, c) in want.items())
    assert near_duplicates.first_of_each(df).count() == len(first)


def test_one_row_of_each_component_stays(spark):
    a, b, c = ("a b c d e f g", "p q r s t u v", "k l m n o")
    rows = [(None, a, 0), (1, a, 1), (1, a, 1), (2, a, 2), (1, b, 3), (3, b, 4), (3, c, 5), (5, "", 6), (5, "", 7), (6, None, 8), (None, b, 9), (7, c, 10)]
    df = spark.createDataFrame(rows, "doc_id long, text string, mark int").withColumn("stays", F.lit(1)).withColumn("label", F.lit("x"))
    out = near_duplicates.first_of_each(df)
    assert out.columns == df.columns
    assert sorted(r.mark for r in out.collect()) == [0, 1, 3, 5, 6, 7, 8, 9]
    assert near_duplicates.first_of_each(df.limit(0)).count() == 0


def test_long_lists_and_hubs_are_shuffled_or_broadcast_alike(spark, monkeypatch):
    from lexmill.llm import tables

    df = cases.frame(spark)
    want = sorted(r.doc_id for r in near_duplicates.first_of_each(df).collect())
    monkeypatch.setattr(tables, "LISTED", 3)
    monkeypatch.setattr(tables, "LEAST_HUB", 1)
    monkeypatch.setattr(tables, "HUBS", 8)
    assert sorted(r.doc_id for r in near_duplicates.first_of_each(df).collect()) == want
    star = spark.createDataFrame([(0, k) for k in range(1, 300)] + [(k, k + 1) for k in range(300, 310)] + [(299, 305)], "a long, b long")
    assert {r.component for r in graph.components(star).collect()} == {0}


def test_components_of_a_path(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(0, 40)] + [(100, 101)], "a long, b long")
    got = {r.node: r.component for r in graph.components(edges).collect()}
    assert got == {k: 0 for k in range(41)} | {100: 100, 101: 100}


def thue_morse(n):
    word = "a"
    while len(word) < n:
        word += word.translate({97: "b", 98: "a"})
    return word


@pytest.mark.parametrize("n", [1024, 4096])
def test_words_of_a_pattern_and_its_complement_stay_apart(spark, n):
    one = thue_morse(n)
    other = one.translate({97: "b", 98: "a"})
    texts = [f"{one} x y z w", f"{other} x y z w", one, other, one]
    df = cases.frame(spark, texts)
    assert {r.doc_id: r.component_id for r in near_duplicates.jaccard_components(df, words=4, percent=85).collect()} == {0: 0, 1: 1, 2: 2, 3: 3, 4: 2}
    assert sorted(r.doc_id for r in near_duplicates.first_of_each(df).collect()) == [0, 1, 2, 3]


def test_hashes_of_spans():
    rng = np.random.default_rng(0)
    words = sorted({bytes(rng.integers(97, 100, rng.integers(1, 40), dtype=np.uint8)) for _ in range(5000)})
    buf = np.frombuffer(b" ".join(words), np.uint8)
    starts, ends = hashing.word_spans(buf)
    with np.errstate(over="ignore"):
        h = hashing.span_hashes(buf, starts, ends)
        assert len(np.unique(h)) == len(words)
        back = np.frombuffer(b"\n\n".join(reversed(words)), np.uint8)
        assert hashing.span_hashes(back, *hashing.word_spans(back))[::-1].tolist() == h.tolist()
        assert not len(hashing.span_hashes(buf, starts[:0], ends[:0]))


def test_columns_of_any_name_pass_the_stages(spark):
    one = cases.words(random.Random(8), 40)
    df = spark.createDataFrame([(1, one, 0), (1, one + " x", 0), (2, one, 0), (3, "other words", 0)], "doc_id long, text string, `a.b` int")
    odd = ["_document0_kept", "_DOCUMENT0", "_Document", "_kept", "id", "Mark", "c0", "`q`", "_document", "key", "sha"]
    names = [n for n in odd if n.lower() not in ("_document",)]
    df = df.select("*", *(F.lit(7).alias(n) for n in names))
    for out in (suffix_dedup.remove_repeats(df), near_duplicates.first_of_each(df)):
        assert out.columns == df.columns and {r["a.b"] for r in out.collect()} == {0} and {r["_DOCUMENT0"] for r in out.collect()} == {7}
    assert suffix_dedup.remove_repeats(df.filter("text != 'other words'").dropDuplicates(["doc_id"])).count() == 2
