"""Operators 11 to 13 against brute force."""

import hashlib
import math
import random
import re
from collections import Counter

import pytest

from lexmill.llm import chunk_recipes, collocations, lexical_search
from tests.llm import cases

WHITE = re.compile(rb"[\x20\x09-\x0D]+")


# --- exact deduplication ---------------------------------------------------------------------------


def brute_copies(rows):
    plain = [(key, WHITE.sub(b" ", (text or "").encode())) for key, text in rows]
    first, size = {}, Counter(t for _, t in plain)
    for key, t in plain:
        first[t] = min(first.get(t, key), key)
    return {key: (first[t], size[t], key == first[t], hashlib.sha256(t).hexdigest()) for key, t in plain}


def as_copies(df, **how):
    return {r["key"]: (r["keep"], r["group_size"], r["kept"], r["sha"]) for r in chunk_recipes.deduplicate(df, **how).collect()}


def long_texts():
    rng = random.Random(5)
    long = cases.words(rng, 30_000)
    return [*cases.texts(), long, long.replace(" ", " \n\t"), long[:-1], long[:100_000] + "x" + long[100_001:], "a " * 60_000, "a  " * 60_000, " ", "a b", " ", "\n", "", None]


def test_copies_match_brute_force(spark):
    rows = list(enumerate(long_texts()))
    assert as_copies(cases.frame(spark, [t for _, t in rows])) == brute_copies(rows)


@pytest.mark.parametrize("bits", [0, 1, 5])
def test_identifiers_of_several_contents_are_told_apart(spark, bits):
    texts = [t for t in long_texts() if t is None or len(t) < 20_000]
    assert as_copies(cases.frame(spark, texts), bits=bits) == brute_copies(list(enumerate(texts)))


def test_repeated_and_null_keys_of_copies(spark):
    df = spark.createDataFrame([(1, "a b"), (1, "a\tb"), (None, "a b"), (None, "c"), (2, "c"), (None, "d")], "doc_id long, text string")
    got = [tuple(r)[:4] for r in chunk_recipes.deduplicate(df).collect()]
    assert sorted(r[3] for r in got if r[1] == 1) == [False, False, True] and [r[3] for r in got if r[0] == 1 and r[3]] == [True]
    assert {r for r in got if r[1] != 1} == {(2, 2, 2, True), (None, 2, 2, False), (None, None, 1, True)}
    assert chunk_recipes.deduplicate(cases.empty(spark)).count() == 0


def test_cuts_follow_the_text_alone():
    rng = random.Random(2)
    stretch = cases.words(rng, 20_000).encode()
    (_, a, _), (_, b, _) = chunk_recipes.chunked([stretch, cases.words(rng, 500).encode() + b" " + stretch])
    assert b"".join(a) == stretch and max(map(len, a)) <= chunk_recipes.MOST and len(set(a) & set(b)) > 0.8 * len(a)
    assert [list(x[1]) for x in chunk_recipes.chunked([b"x y", stretch, b""])][1] == a


# --- lexical search --------------------------------------------------------------------------------

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def _terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute_search(docs, items, k=50):
    counted = [(key, Counter(_terms(t))) for key, t in docs]
    n, total = sum(1 for _, c in counted if c), sum(sum(c.values()) for _, c in counted)
    out = set()
    for item, text in items:
        scores = []
        asked = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * sum(t in c for _, c in counted) + 1))) for t in set(_terms(text))}
        for key, c in counted:
            m = 50 + 50 * sum(c.values()) * n // total
            score = sum(w * ((1_000_000_000 * c[t]) // (1000 * c[t] + 20 * m)) for t, w in asked.items() if c[t])
            if score > 0:
                scores.append((-score, key))
        out |= {(item, rank + 1, key, -score) for rank, (score, key) in enumerate(sorted(scores)[:k])}
    return out


def search_cases():
    rng = random.Random(9)
    words = [cases.words(rng, 1) for _ in range(40)] + ["É", "é", "日本", "x9"]
    docs = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 60))) for _ in range(150)]
    docs += [None, "", "!!", "_a_b_", "A-b.C", "ab", docs[3], docs[3], docs[4].upper(), "a" * 3000, " ".join(words) * 30]
    items = [(7, "a b"), (1, " ".join(words[:3])), (2, " ".join(words)), (3, None), (4, "!"), (5, "notthere"), (6, "É 日本 x9"), (8, "ab b_a")]
    return docs, items


@pytest.mark.parametrize("bounds", [None, (40, 3), (1, 1)])
def test_search_matches_brute_force(spark, bounds, monkeypatch):
    if bounds:
        monkeypatch.setattr(lexical_search, "TERM_BYTES", bounds[0])
        monkeypatch.setattr(lexical_search, "MOST_ITEMS", bounds[1])
    docs, items = search_cases()
    df = cases.frame(spark, docs).repartition(5)
    table = spark.createDataFrame(items, "item_id long, text string")
    for k in (50, 3):
        got = {tuple(r) for r in lexical_search.search(df, table, k).collect()}
        assert got == brute_search(list(enumerate(docs)), items, k)


def test_search_of_odd_tables(spark):
    items = spark.createDataFrame([(1, "a b"), (1, "a")], "item_id long, text string")
    assert lexical_search.search(cases.empty(spark), items).count() == 0
    docs = spark.createDataFrame([(None, "a"), (3, "a"), (2, "a"), (2, "a"), (9, "z")], "doc_id long, text string")
    assert lexical_search.search(docs, items.limit(0)).count() == 0
    got = sorted((tuple(r)[:3] for r in lexical_search.search(docs, items).collect()), key=str)
    one = [(1, 1, 2), (1, 2, 2), (1, 3, 3), (1, 4, None)]
    assert got == sorted(one * 2, key=str)


def test_large_sums_are_exact():
    block = lexical_search.Terms([b"a b", b"b"])
    import numpy as np

    share = np.array([(1 << 53) + 1, 5, 7], np.int64)
    assert lexical_search._sums(block, np.array([0, 0, 1]), np.array([0, 1, 1]), share, 2, False).tolist() == [[(1 << 53) + 6, 5], [7, 7]]


# --- collocations ----------------------------------------------------------------------------------


def brute_collocations(rows, least, top, inside=50):
    f = {}
    for lang, text in rows:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        held = f.setdefault(lang or "und", Counter())
        for piece in re.split("[.,;:!?\n-\r]", low):
            words = [w for w in re.split("[ \t]+", piece) if w]
            for k in (1, 2, 3):
                held.update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = set()
    for lang, held in f.items():
        n, found = sum(a for p, a in held.items() if len(p) == 1), []
        some = {p: a for p, a in held.items() if len(p) > 1 and a >= least}
        for p, a in some.items():
            if len(p) == 2 and any(len(q) == 3 and p in (q[:2], q[1:]) and 100 * b >= inside * a for q, b in some.items()):
                continue
            score, _, left, right = min((1_000_000 * a * a // (held[p[:k]] * held[p[k:]]), k, held[p[:k]], held[p[k:]]) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), left, right))
        out |= {(lang, rank + 1, p.decode(), -a, left, right, n, -score) for rank, (score, a, p, left, right) in enumerate(sorted(found)[:top])}
    return out


def phrase_cases():
    rng = random.Random(4)
    words = [cases.words(rng, 1) for _ in range(12)] + ["É", "\u00a0", "\x1c", "日本"]
    texts = []
    for _ in range(120):
        texts.append("".join(rng.choice(words) + rng.choice([" ", " ", " ", "  ", "\t", ". ", "\n", ",", ";;"]) for _ in range(rng.randint(0, 80))))
    texts += [None, "", "..", "New York City. " * 30, "new york" * 2, "A b A b A b A b", "x " * 500, texts[3], texts[3]]
    return [(rng.choice(["en", "en", "fr", "und", None]), t) for t in texts]


@pytest.mark.parametrize("shard", [1 << 21, 50, 1])
def test_collocations_match_brute_force(spark, shard):
    rows = phrase_cases()
    df = cases.frame(spark, [t for _, t in rows]).drop("lang")
    langs = spark.createDataFrame([(k, lang) for k, (lang, _) in enumerate(rows)], "doc_id long, lang string")
    df = df.join(langs, "doc_id").repartition(3)
    for least, top in ((3, 2000), (10, 4)):
        got = [tuple(r) for r in collocations.collocations(df, least=least, top=top, shard=shard).collect()]
        assert len(got) == len(set(got)) and set(got) == brute_collocations(rows, least, top)


def test_stretches_give_the_words_of_the_whole(monkeypatch):
    monkeypatch.setattr(collocations, "SPLIT", 16)
    for text in (b"aa bb. cc " * 20, b"a" * 100 + b" b", b"a b c d " * 30, b"", b"...", b"x. " + b"y" * 40):
        whole = text.translate(collocations._TABLE).replace(b"\xff", b" \xff ").split()
        got = list(collocations._stretches(text))
        assert [t for tokens, _ in got for t in tokens] == whole and (not got or got[-1][1])


def test_no_rows_no_collocations(spark):
    assert collocations.collocations(cases.empty(spark)).count() == 0
    assert collocations.collocations(cases.frame(spark, [None, "", "one", "two words"])).count() == 0
