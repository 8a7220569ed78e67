"""Small documents for the tests: copies, near copies, odd texts and clashing columns."""

import random

CLASHING = ["key", "id", "n", "node", "prefix", "counts", "anchor", "anchors", "piece", "pieces", "page", "length", "lang_pred", "score", "line", "block", "hash", "component", "cluster", "gid", "item", "size", "carried0", "_document0"]


def words(rng, n):
    return " ".join("".join(rng.choice("abcdehinorst") for _ in range(rng.randint(2, 8))) for _ in range(n))


def texts(seed=7, n=60):
    rng = random.Random(seed)
    base = [words(rng, rng.randint(5, 120)) for _ in range(n)]
    common = words(rng, 30)
    out = list(base)
    for k in range(0, n, 4):
        out.append(base[k])  # exact copy
        w = base[k].split(" ")
        for _ in range(max(1, len(w) // 40)):
            w[rng.randrange(len(w))] = "changed"
        out.append(" ".join(w))  # near copy
    out += [words(rng, 20) + "\n" + common + " " + words(rng, 15) for _ in range(8)]
    out += [None, "", " ", "\n\n", "word", "two words", "A B C", "a b c", "é" * 130, "é" * 130, "x" * 400, "ab" * 300, "日本語 テスト 123", "12 34 !!", "a  b \t c", words(rng, 4000)]
    return out


def frame(spark, rows=None, clash=True):
    """(doc_id, text, lang, source, n_chars) and columns with names that operators use inside."""
    rows = texts() if rows is None else rows
    data = [(k, t, "en", "src", len(t or "")) for k, t in enumerate(rows)]
    df = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long")
    if clash:
        from pyspark.sql import functions as F

        df = df.select("*", *(F.lit(None).cast("string").alias(c) for c in CLASHING))
    return df


def empty(spark):
    return frame(spark, [])
