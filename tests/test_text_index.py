import random
from itertools import count
from math import log

import numpy as np
import pytest

from lexmill.operators import guards, lexical, ranking
from lexmill.operators.text_index import TextIndex

WORDS = ["cat", "dog", "emu", "I-131", "Tc-99m", "1.5", "가나다라", "방사선량", "방사", "Yak", "zz", "a"]


def texts(seed, n):
    rng = random.Random(seed)
    out = [" ".join(rng.choices(WORDS, weights=range(12, 0, -1), k=rng.randint(0, 25))) for _ in range(n)]
    return [*out, None, "", "...", out[0], out[0], "cat " * 400]


def frame(spark, rows):
    return spark.createDataFrame([(k, t) for k, t in rows], "doc long, text string").repartition(5)


def brute(rows, queries, k):
    counted = [(key, lexical.token_list(t or "")) for key, t in rows]
    n, avg = len(rows), sum(max(1, len(t)) for _, t in counted) / len(rows)
    out = set()
    for qid, q in queries:
        scores = []
        asked = set(lexical.token_list(q or ""))
        df = {w: sum(w in t for _, t in counted) for w in asked}
        for key, t in counted:
            if asked & set(t):
                s = sum(log(1 + (n - df[w] + 0.5) / (df[w] + 0.5)) * t.count(w) * 2.5 / (t.count(w) + 1.5 * (0.25 + 0.75 * max(1, len(t)) / avg)) for w in asked if w in t)
                scores.append((-round(s, 6), key))
        out |= {(qid, key, -s, r + 1) for r, (s, key) in enumerate(sorted(scores)[:k])}
    return out


QUERIES = [(1, "cat dog cat"), (2, "I-131 방사선량 zz"), (3, None), (4, "absent"), (5, " ".join(WORDS)), (6, "a"), (7, "YAK yak")]


def same(got, want):
    key = lambda r: (r[0], r[3])
    got, want = sorted((tuple(r) for r in got), key=key), sorted(want, key=key)
    assert [(r[0], r[1], r[3]) for r in got] == [(r[0], r[1], r[3]) for r in want]
    assert np.allclose([r[2] for r in got], [r[2] for r in want], atol=2e-6)


def test_tokens_of_both_sides_agree(spark):
    rows = ["I-131 Tc-99m a xy 1.5 가나 방사선량", "가나다라마 ABC-12x 3.14.15 K ſ İx", "", "x-1 é-2 a1 ٣٣ 12.", "방사선,방사선량"]
    df = spark.createDataFrame([(t,) for t in rows], "t string").select("t", lexical.tokenize("t").alias("tokens"))
    for r in df.collect():
        assert sorted(r.tokens) == sorted(lexical.token_list(r.t))


@pytest.mark.parametrize("k", [1, 4, 50])
def test_top_k_against_all_scores(spark, k, monkeypatch):
    rows = list(enumerate(texts(3, 300)))
    q = spark.createDataFrame(QUERIES, "qid long, text string")
    same(lexical.bm25_topk(frame(spark, rows), q, k).collect(), brute(rows, QUERIES, k))
    monkeypatch.setattr(ranking, "QUERIES", 2)
    same(lexical.bm25_topk(frame(spark, rows), q, k).collect(), brute(rows, QUERIES, k))


def test_bounds_leave_work_out_and_nothing_else():
    rng = random.Random(1)
    vocabulary = [f"w{i}" for i in range(400)]
    docs = [" ".join(rng.choices(vocabulary, weights=[1000 / (i + 1) for i in range(400)], k=60)) for _ in range(4000)]
    queries = [(q, " ".join(rng.choices(vocabulary, k=4) + ["w0", "w1", "w2"])) for q in range(10)]
    asked = ranking.Asked()
    for qid, q in queries:
        asked.add(qid, lexical.token_list(q))
    lists = [lexical.token_list(d) for d in docs]
    df = np.array([sum(w in set(t) for t in lists) for w in asked.words])
    asked.weighted(df, len(docs), sum(map(len, lists)) / len(docs))
    best, every = ranking.Best(len(queries), 10), 0
    import pyarrow as pa

    for i in range(0, len(docs), ranking.DOCUMENTS):
        batch = pa.RecordBatch.from_arrays([pa.array(range(i, min(len(docs), i + ranking.DOCUMENTS))), pa.array(docs[i : i + ranking.DOCUMENTS])], names=["doc", "body"])
        for block in ranking.text_blocks([batch], asked):
            every += sum(int(np.isin(block[2], t).sum()) for t in asked.terms)
            ranking.score_block(asked, best, *block)
    assert best.products < 0.6 * every
    same([(q, d, -s, r + 1) for q, rows in enumerate(best.rows) for r, (s, _, d) in enumerate(rows)], brute(list(enumerate(docs)), queries, 10))


def test_changes_give_the_index_made_anew(spark, tmp_path):
    index = TextIndex(spark, str(tmp_path / "i")).create()
    now, made = {}, count()

    def put(rows):
        index.add(frame(spark, rows))
        now.update(rows)

    def drop(keys):
        index.remove(spark.createDataFrame([(k,) for k in keys], "k long"))
        for k in keys:
            now.pop(k, None)

    def check():
        fresh = TextIndex(spark, str(tmp_path / f"fresh{next(made)}")).create()
        fresh.add(frame(spark, list(now.items())))
        told = lambda i: sorted((r.token, r.df, round(r.idf, 9)) for r in i.terms().collect())
        assert told(index) == told(fresh) and index.stats() == fresh.stats()
        q = spark.createDataFrame(QUERIES, "qid long, text string")
        same(index.topk(q, 5).collect(), brute(list(now.items()), QUERIES, 5))

    put(list(enumerate(texts(1, 60))))
    check()
    put([(5, "cat emu"), (200, "dog"), (7, None)])
    drop([1, 2, 3, 999])
    put([(2, "back again zz"), (5, "emu emu")])
    check()
    before = index.log.read()[0]
    assert index.remove(spark.createDataFrame([(12345,)], "k long")) == before
    index.compact()
    check()
    index.vacuum(1)
    check()
    drop(list(now))
    assert index.terms().count() == 0 and index.stats()[0] == 0 and index.topk(spark.createDataFrame(QUERIES, "qid long, text string")).count() == 0


def test_keys_of_an_added_table_are_unique(spark, tmp_path):
    index = TextIndex(spark, str(tmp_path / "i")).create()
    with pytest.raises(guards.IntegrityError):
        index.add(frame(spark, [(1, "a b"), (1, "c d")]))
    index.add(frame(spark, [(None, "nothing"), (1, "cat")]))
    assert index.stats()[0] == 1


def test_tables_of_a_snapshot(spark):
    postings, terms, stats = lexical.bm25_index(frame(spark, [(1, "cat cat dog"), (2, ""), (3, "dog")]))
    assert {tuple(r) for r in postings.select("token", "doc", "tf", "len").collect()} == {("cat", 1, 2, 3), ("dog", 1, 1, 3), ("dog", 3, 1, 1)}
    assert {(r.token, r.df) for r in terms.collect()} == {("cat", 1), ("dog", 2)}
    assert tuple(stats.first()) == (3, pytest.approx(5 / 3))
