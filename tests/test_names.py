import random

import pytest
from pyspark.sql import functions as F

from lexmill.operators import chunking, evaluation, names


def subsequence(short, long):
    at = iter(long)
    return all(c in at for c in short)


def words(seed, n, letters="가나다라법"):
    rng = random.Random(seed)
    return sorted({"".join(rng.choices(letters, k=rng.randint(1, 9))) for _ in range(n)})


def test_walks_against_brute_force():
    trie = names.Names()
    for name in words(1, 300):
        trie.add(name)
    for s in [*words(2, 200), "x", "가" * 80]:
        assert sorted(trie.subsequences(s)) == [n for n in trie.names if subsequence(n, s)]
        assert trie.parts(s) == {n for n in trie.names if n in s}
        assert sorted(trie.beginnings(s)) == [n for n in trie.names if s.startswith(n)]
        assert sorted(trie.continued(s)) == [n for n in trie.names if n.startswith(s)]
        assert trie.holders(s) == {n for n in trie.names if s in n}
    long = names.Names()
    long.add("나" * 70 + "다" + "가" * 100)
    assert long.holders("나" * 70 + "다") and not long.holders("나" * 70 + "라") and long.holders("다" + "가" * 100)


@pytest.mark.parametrize("mode", ["loose", "strict"])
@pytest.mark.parametrize("block", [1 << 20, 12])
def test_sources_against_brute_force(spark, mode, block, monkeypatch):
    monkeypatch.setattr(names, "CHARACTERS", block)
    rng = random.Random(3)
    laws, asked = words(4, 25), words(5, 25)
    units = [(k, law, "제1조", rng.choice(["", "2"])) for k, law in enumerate(laws)] + [(1000 + k, rng.choice(laws), rng.choice(["", "제3조"]), "") for k in range(30)]
    sources = [(q, [rng.choice(asked) + rng.choice([" 제1조", "", " 별표 2", " 제3조의2", " 제1조"]) for _ in range(2)]) for q in range(40)]
    want = set()
    for q, texts in sources:
        for e in (t.replace(" ", "") for t in texts):
            for k, law, article, annex in units:
                if "별표" in e:
                    name, number, kind = *e.split("별표"), "annex"
                elif "제" in e:
                    name, number = e.split("제")
                    number, kind = "제" + (number[:2] if mode == "strict" else number), "article"
                else:
                    name, number, kind = e, "", "law"
                if kind == "law":
                    if mode == "strict":
                        ok = len(law) > 3 and (name in law or law in name)
                    else:
                        ok = min(len(name), len(law)) >= 2 and (law.startswith(name) or name.startswith(law))
                else:
                    ok = number == (article if kind == "article" else annex) and (name in law if mode == "strict" else subsequence(name, law))
                if ok:
                    want.add((q, k))
    q = spark.createDataFrame(sources, "qid long, expected_sources array<string>")
    u = spark.createDataFrame(units, "id long, law string, article string, annex string").repartition(3)
    assert {tuple(r) for r in evaluation.match_sources(q, u, mode=mode).collect()} == want


def test_only_matches_leave_the_trie(spark):
    """All names share 제1조; a name matches its own law alone, and that many rows come out, not names times laws."""
    stems = [f"{k:05}" for k in range(3000)]
    asked = spark.createDataFrame([("article", "제1조", s) for s in stems], "kind string, number string, name string")
    keys = spark.createDataFrame([("article", "제1조", s + "x") for s in stems], "kind string, number string, law string")
    assert names.matched_names(asked, keys, False).count() == 3000


def test_substrings_of_parents_lengths_only(spark):
    parents = spark.createDataFrame([(p, p) for p in ("원자력법", "원자력안전법시행령", "법", "")], "parent_stem string, doc_title string")
    annexes = spark.createDataFrame([("x" * 120 + "원자력안전법시행령 별표", "none"), ("y" * 50 + "원자력법z", "none"), ("zzz", "none"), ("법", "none"), (None, "none"), ("q", "원자력법")], "stem string, parent_law string")
    got = {r.stem: r.parent_stem for r in chunking.attach_parent(annexes, parents).collect()}
    assert got == {"x" * 120 + "원자력안전법시행령 별표": "원자력안전법시행령", "y" * 50 + "원자력법z": "원자력법", "zzz": None, "법": "법", None: None, "q": "원자력법"}
    sizes = parents.select(F.length("parent_stem").alias("_n")).filter("_n > 0").distinct()
    assert chunking.parent_lengths(annexes.select(F.col("stem").alias("_stem")), sizes).groupBy("_stem").count().agg(F.max("count")).first()[0] == 3


@pytest.mark.parametrize("mode", ["loose", "strict"])
def test_matches_go_in_tiles_and_no_pair_is_shuffled(spark, mode, monkeypatch):
    """groups of equal questions and units over several tiles, repeated and null ids, units with several articles."""
    monkeypatch.setattr(evaluation, "SIDE", 3)
    units = [(k, f"법령{k % 2}호법", f"제{k % 3 + 1}조", "1" if k % 2 else "") for k in range(40)] + [(7, "법령0호법", "제9조", "1"), (7, "법령0호법", "제9조", "1"), (None, "법령1호법", "제1조", None), (50, None, "제1조", "1"), (51, "법령1호법", None, "")]
    sources = [(q, [f"법령{q % 2}호법" + (f" 제{q % 3 + 1}조" if q % 4 else ""), f"법령{q % 2}호법 별표 1"]) for q in range(30)] + [(3, ["법령0호법 제9조", "법령0호법"]), (None, ["법령1호법"]), (99, ["없는법"])]
    want = set()
    for q, texts in sources:
        for text in texts:
            name, _, rest = text.partition(" ")
            for k, law, article, annex in units:
                if law == name and (not rest or rest == article or rest == f"별표 {annex}"):
                    want.add((q, k))
    q = spark.createDataFrame(sources, "qid long, expected_sources array<string>")
    u = spark.createDataFrame(units, "id long, law string, article string, annex string").repartition(3)
    out = evaluation.match_sources(q, u, mode=mode)
    got = [tuple(r) for r in out.collect()]
    assert len(got) == len(set(got)) and set(got) == want
    top = out._jdf.queryExecution().sparkPlan().toString().split("Exchange")[0].split("Repartition")[0]
    assert top.count("Generate") == 2 and "Aggregate" not in top and "Join" not in top
