import random

from lexmill.operators import wordings


def test_against_brute_force(spark):
    rng = random.Random(6)
    word = lambda n, letters="가나다ab1": "".join(rng.choices(letters, k=n))
    texts = [word(rng.randint(0, 300)) for _ in range(80)] + [None, "", "ab" * 900, "a" * 500, "😀" * 20 + "끝"]
    held = [t for t in texts if t]
    asked = [word(rng.randint(1, 6)) for _ in range(150)] + [word(rng.randint(7, 30)) for _ in range(100)]
    for _ in range(200):
        t = rng.choice(held)
        at, n = rng.randrange(len(t)), rng.randint(1, 60)
        part = t[at : at + n]
        asked += [part, part[:-1] + "X", "X" + part, part + part]
    asked += ["", "a" * 500, "a" * 501, "ba" * 8, *held[:5], "😀끝", "😀" * 21, None]
    want = {w for w in asked if w is not None and any(w in (t or "") for t in texts)}
    df = spark.createDataFrame([(w,) for w in asked], "wording string").repartition(3)
    corpus = spark.createDataFrame([(t,) for t in texts], "body string").repartition(4)
    got = [r.wording for r in wordings.standing(df, corpus).collect()]
    assert sorted(got) == sorted(want)
    assert wordings.standing(df, corpus.limit(0)).count() == 0 and wordings.standing(df.limit(0), corpus).count() == 0
    assert [r.wording for r in wordings.standing(df.filter("length(wording) <= 8 and wording != ''"), corpus).collect()].__len__() == len({w for w in want if 0 < len(w) <= 8})


def test_a_gram_of_every_text_is_compared_in_its_surroundings(spark):
    corpus = spark.createDataFrame([(f"{k:04}" + "abcdefgh" * 3 + f"{k:04}",) for k in range(300)], "body string")
    asked = [f"{k:04}abcdefgh" for k in range(290, 310)] + [f"abcdefgh{k:04}" for k in range(5)] + ["abcdefghabcdefghx", "habcdefg"]
    df = spark.createDataFrame([(w,) for w in asked], "wording string")
    assert sorted(r.wording for r in wordings.standing(df, corpus).collect()) == sorted([*asked[:10], *asked[20:25], "habcdefg"])
