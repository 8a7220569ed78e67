import random
import re

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from lexmill.llm import decontaminate, language, licenses, quality, queries, token_counts, url_filters
from tests.llm import cases

VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")


# --- language ---------------------------------------------------------------------------------------


def test_language_on_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    fold = F.crc32(F.col("doc_id").cast("string")) % 5
    out = language.predict(docs.filter(fold == 0), language.fit(docs.filter(fold != 0)), carry=("lang",))
    right, n = out.agg(F.count_if(F.col("lang") == F.col("lang_pred")), F.count("*")).first()
    assert right >= 0.97 * n


def test_language_mixture_and_odd_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = language.fit(docs)
    en, de = (docs.filter((F.col("lang") == x) & (F.col("n_chars") > 1500)).first().text[:1500] for x in ("en", "de"))
    share, _ = model.proportions((en + "\n" + de).encode())
    assert sorted(model.languages[k] for k in (-share).argsort()[:2]) == ["de", "en"] and 0.3 < share[model.languages.index("de")] < 0.7
    out = {r.doc_id: r for r in language.predict(cases.frame(spark, [None, "", "12 34 !!", "the thing"]), model).collect()}
    assert [out[k].lang_pred for k in range(3)] == ["und"] * 3 and out[3].lang_pred in model.languages
    assert all(0 <= r.score <= 1 for r in out.values())


def test_language_without_training(spark):
    model = language.fit(cases.empty(spark))
    assert {r.lang_pred for r in language.predict(cases.frame(spark), model).collect()} == {"und"}
    assert language.predict(cases.empty(spark), model).count() == 0


def test_shares_match_a_search_over_all_mixtures():
    """The likelihood that expectation-maximisation reaches, against every mixture of a fine grid."""
    import numpy as np

    rng = random.Random(22)
    alphabets = ("abcde", "defgh", "klmno")
    say = lambda k, n: " ".join("".join(rng.choices(alphabets[k], k=5)) for _ in range(n))
    table = np.full((3, language.BUCKETS), 0.1)
    for k in range(3):
        table[k] += np.bincount(language.trigram_buckets(say(k, 3000).encode()), minlength=language.BUCKETS)
    model = language.Model(["a", "b", "c"], np.log(table / table.sum(axis=1, keepdims=True)))
    for parts in ((50, 0, 0), (30, 70, 0), (40, 40, 40), (5, 100, 60), (400, 0, 8)):
        text = " ".join(say(k, n) for k, n in enumerate(parts)).encode()
        counts = np.bincount(language.trigram_buckets(text), minlength=language.BUCKETS)
        p = np.exp(model.log_p)
        fit = lambda share: float(np.log(share @ p) @ counts)
        penal = lambda share: language.PENALTY * np.log(counts.sum() + 1) * (np.count_nonzero(share) - 1)
        grid = [np.array([i, j, 50 - i - j]) / 50 for i in range(51) for j in range(51 - i)]
        best = max(grid, key=lambda share: fit(share) - penal(share))
        share, _ = model.proportions(text)
        assert set(np.flatnonzero(share)) == set(np.flatnonzero(best)) and np.abs(share - best).max() < 0.03
        assert fit(share) - penal(share) >= fit(best) - penal(best) - 0.5


# --- quality ----------------------------------------------------------------------------------------


def test_quality_on_held_out_documents(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    fold = F.crc32(F.col("doc_id").cast("string")) % 3
    model = quality.fit(docs, labels.filter(fold != 1))
    rows = quality.score(docs.join(labels.filter(fold == 1).select("doc_id"), "doc_id", "left_semi"), model).join(labels, "doc_id").collect()
    good, bad = ([r.score for r in rows if r.quality == q] for q in (1, 0))
    auc = sum((g > b) + 0.5 * (g == b) for g in good for b in bad) / (len(good) * len(bad))
    assert auc > 0.98


def test_scores_are_shares_of_good_texts(spark):
    d = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{d}/{t}.parquet") for t in ("documents", "labels"))
    fold = F.crc32(F.col("doc_id").cast("string")) % 3
    model = quality.fit(docs, labels.filter(fold != 1))
    rows = quality.score(docs.join(labels.filter(fold == 1).select("doc_id"), "doc_id", "left_semi"), model).join(labels, "doc_id").collect()
    for k in range(5):
        some = [r for r in rows if 0.2 * k <= r.score < 0.2 * (k + 1) or k == 4 and r.score == 1]
        if len(some) >= 30:
            assert abs(sum(r.quality for r in some) - sum(r.score for r in some)) < 0.12 * len(some), (k, len(some))
    assert sum(r.predicted == r.quality for r in rows) > 0.95 * len(rows)


def test_quality_sample_is_bounded_where_keys_repeat(spark, monkeypatch):
    rng = random.Random(3)
    rows = [(k % 4, cases.words(rng, 30)) for k in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(4)], "doc_id long, quality int")
    seen = []
    built = quality._dictionary
    monkeypatch.setattr(quality, "_dictionary", lambda samples: seen.extend(samples) or built(samples))
    monkeypatch.setattr(quality, "hash_fraction", lambda key, seed=0: F.pmod(F.xxhash64(F.lit(seed), key), F.lit(1000)) / F.lit(1000.0))
    quality.fit(docs, labels, per_class=10)
    assert len(seen) <= 80


def test_quality_score_is_the_calibrated_sizes(spark):
    """Scores of whole and very long texts against the sizes that zstandard gives, computed apart."""
    import numpy as np
    import zstandard

    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    model = quality.fit(docs, labels)
    texts = ["", "word", "x" * 2_000_000, *(r.text for r in docs.limit(40).collect())]
    got = {r.doc_id: r for r in quality.score(cases.frame(spark, texts), model).collect()}
    for k, t in enumerate(texts):
        data = (t or "").encode()
        g, b = (len(zstandard.ZstdCompressor(level=quality.LEVEL, dict_data=zstandard.ZstdCompressionDict(d), write_content_size=False, write_dict_id=False).compress(data)) for d in (model.good, model.bad))
        x, low, high = (b - g) / np.sqrt(len(data) + 16), model.knots[0], model.knots[-1]
        want = 0.99 * np.interp(x, model.knots, model.shares) + 0.01 / (1 + np.exp(-np.clip(8 * (x - model.knots.mean()) / (high - low), -30, 30)))
        assert all(np.diff(model.knots) > 0) and all(np.diff(model.shares) > 0)
        assert abs(got[k].score - want) < 1e-9 and got[k].predicted == int(got[k].score >= 0.5)


def test_quality_edges(spark):
    docs = cases.frame(spark)
    none = quality.fit(docs, spark.createDataFrame([], "doc_id long, quality int"))
    assert {r.score for r in quality.score(docs, none).collect()} == {0.5}
    labels = spark.createDataFrame([(k, k % 2) for k in range(60)] + [(None, 1), (3, None), (4, 7)], "doc_id long, quality int")
    model = quality.fit(docs, labels)
    rows = quality.score(docs, model).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    assert quality.score(cases.empty(spark), model).count() == 0


# --- token counts -----------------------------------------------------------------------------------


def test_counts_are_the_librarys(spark):
    from tokenizers import Tokenizer, models, pre_tokenizers

    vocabulary = token_counts.piece_vocabulary(VOCABULARY)
    library = Tokenizer(models.Unigram(list(vocabulary.pieces), unk_id=0, byte_fallback=True))
    library.pre_tokenizer = pre_tokenizers.Metaspace()
    df = cases.frame(spark, [*cases.texts(), "  a  b", "日本語 漢字\n\t x", "a▁b", "▁", "😀😀 é", "q   "])
    texts = {r.doc_id: r.text or "" for r in df.collect()}
    got = {r.doc_id: r.n_tokens for r in token_counts.token_counts(df, VOCABULARY).collect()}
    assert got == {k: len(library.encode(t).ids) for k, t in texts.items()}
    assert token_counts.token_counts(cases.empty(spark), VOCABULARY).count() == 0


def test_count_ties_and_unknown_runs():
    from tokenizers import Tokenizer, models, pre_tokenizers

    pieces = (("<unk>", 0.0), ("a", -1.0), ("b", -1.0), ("ab", -2.0), ("▁", -1.0), ("▁a", -2.0), ("abc", -2.5), ("é", -3.0))
    library = Tokenizer(models.Unigram(list(pieces), unk_id=0))
    library.pre_tokenizer = pre_tokenizers.Metaspace()
    counter, rng = token_counts.Counter(token_counts.Vocabulary(pieces, byte_fallback=False)), random.Random(0)
    for _ in range(2000):
        t = "".join(rng.choice("abcé x日") for _ in range(rng.randint(0, 12)))
        assert counter.text(t) == len(library.encode(t).ids), t


def test_long_words_are_not_remembered():
    from lexmill.llm.token_counts import CACHE_LENGTH, Counter, piece_vocabulary

    counter = Counter(piece_vocabulary(VOCABULARY))
    long = "x" * 2_000
    assert counter.text(f"a {long} b {long}") == counter.text("a") + 2 * counter.text(long) + counter.text("b")
    assert all(len(w) < CACHE_LENGTH for w in counter.cache)


# --- licenses ---------------------------------------------------------------------------------------


def test_templates_and_changed_texts_without_a_license_word(spark):
    """What is searched is what the templates say: no word is asked for besides."""
    wording = "seven tall ships sail north past cold harbours"
    rows = ["x y " + wording.upper() + " z", "nothing", None, wording]
    got = {(r.doc_id, r.license_id, r.n_differences) for r in licenses.license_blocks(cases.frame(spark, rows), templates={"ships": wording}).collect()}
    assert got == {(0, "ships", 0), (3, "ships", 0)}
    changed = []
    names = [n for n in licenses.TEXTS if n.split("-")[0] in ("MPL", "Unlicense", "Zlib")]
    for name in names:
        text = re.sub(r"(?i)licen[cs]e|copyright|public|permission|redistribut\w*", "thing", licenses.TEXTS[name], count=len(licenses.words(licenses.TEXTS[name])) // 20)
        changed.append(text)
    found = {(r.doc_id, r.license_id) for r in licenses.license_blocks(cases.frame(spark, changed), templates=((licenses.TEXTS, 0.1),)).collect()}
    assert len(names) >= 3 and {(k, n) for k, n in enumerate(names)} <= found


def test_sizes_decide_between_templates_of_equal_words(monkeypatch):
    scanner = licenses.Scanner((({"first": "the quick brown fox jumps", "last": "quick brown fox jumps extraordinarily"}, 0.0),))
    text = "see: the quick brown fox jumps extraordinarily today"
    assert [r[2] for r in scanner.scan(text, False)] == ["last"]  # saves more bytes
    real = scanner.bytes_saved
    monkeypatch.setattr(scanner, "bytes_saved", lambda block, some: dict.fromkeys(real(block, some), 0))
    assert [r[2] for r in scanner.scan(text, False)] == ["first"]


def test_the_rank_by_sizes_comes_first_and_decides(monkeypatch):
    """The exact notice explains more bytes; the other has more equal words, but one is missing."""
    short = "in as by of to or at so no xx"
    groups = (({"long": "of to or at so no incomprehensibilities counterrevolutionaries"}, 0.0), ({"short": short}, 0.1))
    scanner = licenses.Scanner(groups)
    text = "see: " + short[:-3] + " incomprehensibilities counterrevolutionaries today"
    steps = []
    compress, compare = scanner.bytes_saved, licenses.Template.occurrences
    monkeypatch.setattr(scanner, "bytes_saved", lambda block, some: steps.append(sorted(some)) or compress(block, some))
    monkeypatch.setattr(licenses.Template, "occurrences", lambda self, *at: steps.append(self.name) or compare(self, *at))
    assert [r[2] for r in scanner.scan(text, False)] == ["long"]
    assert steps == [[0, 1], "long", "short"]  # every template is compressed with, then all are confirmed as ranked
    monkeypatch.setattr(scanner, "bytes_saved", lambda block, some: dict.fromkeys(some, 0))
    assert [r[2] for r in scanner.scan(text, False)] == ["short"]


def test_the_exact_wording_refuses_winners_and_the_rest_is_ranked_anew(monkeypatch):
    names = ("LGPL-3.0", "GPL-3.0", "AGPL-3.0", "GPL-2.0")
    scanner = licenses.Scanner(((licenses.TEXTS, 0.1),))
    text = "\n".join(licenses.TEXTS[n].replace("useful", "of use") for n in names)
    for sign in (1, 0, -1):  # as they are, none and turned round
        real = licenses.Scanner.bytes_saved
        monkeypatch.setattr(scanner, "bytes_saved", lambda block, some, sign=sign: {k: sign * n for k, n in real(scanner, block, some).items()})
        assert [(r[2], r[4]) for r in scanner.scan(text, False)] == [(n, 3) for n in names]


def test_windows_hold_every_occurrence():
    for seed in range(300):
        rng = random.Random(seed)
        abc = "abcdef"[: rng.randint(2, 6)]
        texts = {str(k): " ".join(rng.choices(abc, k=rng.randint(1, 9))) for k in range(3)}
        scanner = licenses.Scanner(((texts, rng.choice((0.0, 0.2, 0.4))),))
        block = rng.choices(abc, k=rng.randint(1, 30))
        near = {n: brute_differences(block, t.split()) for n, t in texts.items()}
        best = {t.name: near[t.name] for t in scanner.templates if near[t.name] <= t.most}
        found = scanner.scan(" ".join(block), False)
        assert {r[2] for r in found} <= set(best) and bool(found) == bool(best)
        for t in scanner.templates:
            alone = licenses.Scanner((({t.name: t.wording}, t.most / len(t.words)),)).scan(" ".join(block), False)
            assert min((r[4] for r in alone), default=None) == best.get(t.name)


def test_license_blocks(spark):
    rows = ["text\nReleased under the MIT License.\nmore", "LICENSED UNDER CC BY 4.0", "Licensed under CC BY-NC 4.0.", "Released under the MIT Lisence, a licence", None, "", "license"]
    got = {(r.doc_id, r.line): r for r in licenses.license_blocks(cases.frame(spark, rows), unconfirmed=True).collect()}
    assert (got[0, 1].license_id, got[0, 1].confirmed) == ("MIT", True)
    assert got[1, 0].license_id == "CC-BY-4.0" and got[2, 0].license_id == "CC-BY-NC-4.0"
    assert got[3, 0].n_differences == 1 and not got[3, 0].confirmed
    assert licenses.license_blocks(cases.empty(spark)).count() == 0


def test_notices_within_long_lines(spark):
    rng = random.Random(8)
    ids = sorted(licenses.TEMPLATES)
    rows = [cases.words(rng, n) + " " + licenses.TEMPLATES[k] + " " + cases.words(rng, n) for k in ids for n in (5, 2500)]
    rows.append("Released under the MIT License. Licensed under CC BY 4.0. " + cases.words(rng, 30) + " All rights reserved.")
    got = sorted((r.doc_id, r.license_id, r.n_differences) for r in licenses.license_blocks(cases.frame(spark, rows)).collect())
    assert got == [(k, ids[k // 2], 0) for k in range(2 * len(ids))] + [(2 * len(ids), k, 0) for k in ("All-Rights-Reserved", "CC-BY-4.0", "MIT")]


@pytest.mark.parametrize("most", (0, 1, 2, 3))
def test_differences_within(most):
    rng = random.Random(most)
    for _ in range(300):
        block, template = (rng.choices("abcd", k=rng.randint(1, n)) for n in (9, 4))
        n = licenses.wording_differences(block, template)
        assert licenses.differences_within(block, template, most) == (n if n <= most else None)


@pytest.mark.parametrize("block,template,want", [("a b c", "b", 0), ("a x c", "a b c", 2), ("", "a b", 2), ("a b", "", 0)])
def test_wording_differences(block, template, want):
    assert licenses.wording_differences(block.split(), template.split()) == want


def brute_differences(block, template):
    best = list(range(len(template) + 1))
    found = best[-1]
    for w in block:
        row = [0]
        for k, t in enumerate(template, 1):
            row.append(best[k - 1] if w == t else 1 + min(row[k - 1], best[k]))
        best = row
        found = min(found, best[-1])
    return found


@pytest.mark.parametrize("seed", range(4))
def test_differences_match_brute_force(seed):
    rng = random.Random(seed)
    for _ in range(200):
        block, template = (rng.choices("abcde", k=rng.randint(0, n)) for n in (14, 8))
        assert licenses.wording_differences(block, template) == brute_differences(block, template)


def altered(rng, wording, n):
    """The words with n of them removed, doubled by another or put in."""
    out = licenses.words(wording)
    for _ in range(n):
        at = rng.randrange(len(out))
        out[at : at + 1] = rng.choice(([], [out[at], "other"], ["other", out[at]]))
    return out


def test_texts_with_differences_match_brute_force(spark):
    rng = random.Random(31)
    texts = licenses.TEXTS
    rows, want = [], set()
    for k, name in enumerate(sorted(texts)):
        for n in (0, 3, 12, 40):
            body = altered(rng, texts[name], n)
            lines = [" ".join(body[i : i + 9]) for i in range(0, len(body), 9)]
            rows.append("\n".join([cases.words(rng, 20), "A license:", *lines, cases.words(rng, 20)]))
            block = licenses.words(rows[-1])
            near = {other: brute_differences(block, licenses.words(t)) for other, t in texts.items()}
            fits = {o: d for o, d in near.items() if d <= len(licenses.words(texts[o])) // 10}
            if fits:
                best = min(fits, key=lambda o: (fits[o] - len(licenses.words(texts[o])), fits[o]))
                want.add((len(rows) - 1, best, fits[best]))
    found = licenses.license_blocks(cases.frame(spark, rows), templates=((texts, 0.1),)).collect()
    got = {(r.doc_id, r.license_id, r.n_differences) for r in found}
    assert want <= got and len({r.doc_id for r in found} - {d for d, _, _ in want}) == 0
    assert all(r.line >= 1 and r.last_line > r.line for r in found if r.license_id in ("MIT", "BSD-3-Clause", "Apache-2.0"))
    assert any(d for _, _, d in want)


def test_notices_over_line_ends_and_beside_each_other(spark):
    rows = [
        "All rights reserved. This work is licensed under the GNU General Public terms of use.",
        "Released under\nthe MIT License.", "x " * 300_000 + "Licensed under\nCC BY 4.0. " + "y " * 300_000 + "All rights reserved.",
        "MIT\n\n" + licenses.TEXTS["MIT"] + "\n\n" + licenses.TEXTS["MIT"].upper() + "\nReleased under the ISC License.",
    ]
    got = sorted((r.doc_id, r.line, r.last_line, r.license_id, r.n_differences) for r in licenses.license_blocks(cases.frame(spark, rows)).collect())
    n = licenses.TEXTS["MIT"].count("\n")
    assert got == [(0, 0, 0, "All-Rights-Reserved", 0), (1, 0, 1, "MIT", 0), (2, 0, 1, "CC-BY-4.0", 0), (2, 1, 1, "All-Rights-Reserved", 0), (3, 2, 2 + n, "MIT", 0), (3, 4 + n, 4 + 2 * n, "MIT", 0), (3, 5 + 2 * n, 5 + 2 * n, "ISC", 0)]


# --- URL filters ------------------------------------------------------------------------------------


def test_rules_of_one_prefix_in_two_spellings_and_of_equal_times(spark):
    entries = [("prefix", "A.com/x", "add", "2024-01-02"), ("prefix", "a.com/x", "add", "2024-01-01"), ("prefix", "a.com/x", "remove", "2024-01-03"), ("domain", "com", "add", "2024-01-05"), ("domain", "com", "add", "2024-01-06"), ("host", "a.com", "add", "2024-01-06"), ("host", "a.com", "remove", "2024-01-07")]
    listed = spark.createDataFrame(entries, "rule string, value string, action string, dated string")
    captures = [(d, "https://A.com/x/y", f"2024-01-{d:02}") for d in range(1, 9)] + [(20, None, "2024-01-02"), (21, "https://a.com/x", None), (22, "https://b.com/x", "2024-01-05")]
    df = spark.createDataFrame(captures, "page_id long, url string, fetched string")
    got = {r.page_id: (r.n_rules, r.first_rule) for r in url_filters.evaluate(df, listed).collect()}
    spelt, plain = "prefix:A.com/x", "prefix:a.com/x"
    assert got == {1: (1, plain), 2: (2, spelt), 3: (1, spelt), 4: (1, spelt), 5: (2, "domain:com"), 6: (3, "domain:com"), 7: (2, "domain:com"), 8: (2, "domain:com"), 20: (0, None), 21: (0, None), 22: (1, "domain:com")}


def test_url_filters_as_of(spark):
    entries = [("host", "a.example.org", "add", "2024-01-10"), ("host", "a.example.org", "remove", "2024-02-10"), ("domain", "example.com", "add", "2024-01-01"), ("prefix", "p.example.net/x/", "add", "2024-01-01"), ("host", "same.org", "add", "2024-01-01"), ("host", "same.org", "remove", "2024-01-01"), ("host", None, "add", "2024-01-01"), ("host", "n.org", "add", None)]
    captures = [(1, "http://a.example.org/", "2024-01-09"), (2, "http://A.example.org/", "2024-01-10"), (3, "https://a.example.org", "2024-02-10"), (4, "http://www.example.com:80/q", "2024-05-01"), (5, "http://notexample.com/", "2024-05-01"), (6, "http://p.example.net/x/y", "2024-05-01"), (7, "http://p.example.net/y", "2024-05-01"), (8, "http://same.org/", "2024-05-01"), (9, None, "2024-05-01"), (10, "nonsense", "2024-05-01"), (11, "http://www.example.com/", None), (4, "http://www.example.com:80/q", "2024-05-01"), (12, "http://n.org/", "2024-05-01")]
    listed = spark.createDataFrame(entries, "rule string, value string, action string, dated string")
    df = spark.createDataFrame(captures, "page_id long, url string, fetched string").withColumn("host", F.lit("clash")).withColumn("intervals", F.lit(0))
    got = url_filters.evaluate(df, listed).collect()
    assert len(got) == len(captures)
    assert sorted(r.page_id for r in got if r.blocked) == [2, 4, 4, 6]
    assert not any(r.blocked for r in url_filters.evaluate(df, listed.limit(0)).collect())
    assert url_filters.evaluate(df.limit(0), listed).count() == 0


def test_many_prefixes_and_captures_of_one_host(spark, monkeypatch):
    """Against a plain loop over the list, with a host that has many of both."""
    monkeypatch.setattr(url_filters, "PER_TASK", 50)
    rng = random.Random(5)
    day = lambda k: f"2024-{1 + k // 28:02d}-{1 + k % 28:02d}"
    entries = [("prefix", f"big.org/{k % 5000:x}", rng.choice(("add", "add", "remove")), day(rng.randrange(300))) for k in range(20_000)]
    entries += [("domain", "org", "add", day(100)), ("host", "big.org", "add", day(200)), ("prefix", "big.org", "add", day(250)), ("prefix", "other.org/" + "p" * 5000, "add", day(0))]
    captures = [(k, f"https://big.org/{rng.randrange(8000):x}/x" if k % 3 else "https://other.org/" + "p" * rng.choice((4999, 5000, 6000)), day(rng.randrange(330))) for k in range(600)]
    got = {r.page_id: r for r in url_filters.evaluate(spark.createDataFrame(captures, "page_id long, url string, fetched string"), spark.createDataFrame(entries, "rule string, value string, action string, dated string")).collect()}

    changes = {}
    for rule, value, action, dated in entries:
        at = changes.setdefault((rule, value), {})
        at[dated] = max(action, at.get(dated, ""))
    for page, url, fetched in captures:
        host, path = url[8:].split("/", 1)
        active = []
        for (rule, value), dated in changes.items():
            on = [d for d in dated if d <= fetched]
            match = host == value or rule == "domain" and host.endswith("." + value)
            if rule == "prefix":
                match = (host + "/" + path).startswith(value) and host == value.split("/")[0]
            if match and on and dated[max(on)] == "add":
                active.append(f"{rule}:{value}")
        assert (got[page].n_rules, got[page].first_rule, got[page].blocked) == (len(active), min(active, default=None), bool(active)), url[:40]


# --- decontamination --------------------------------------------------------------------------------


def test_overlaps_tolerate_substitutions(spark):
    rng = random.Random(4)
    items = [cases.words(rng, n) for n in (30, 25, 40)] + ["four words only here", None, ""]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string").withColumn("key", F.lit(1))
    swapped = items[0].split(" ")
    swapped[3], swapped[17] = "other", "another"
    rows = [
        cases.words(rng, 50) + " " + items[1].upper() + ", " + cases.words(rng, 9), " ".join(swapped), cases.words(rng, 80), "x " + " ".join(items[2].split(" ")[:16]) + " " + cases.words(rng, 40),
        "so FOUR words, only here!", "four words only", None, "", " ".join(items[2].split(" ")[:8]),
    ]
    got = {(r.doc_id, r.item_id): r for r in decontaminate.overlaps(cases.frame(spark, rows), bench).collect()}
    assert set(got) == {(0, 1), (1, 0), (3, 2), (4, 3)}
    assert got[1, 0].n_words == 30 and got[1, 0].n_equal == 28 and got[0, 1].word_start == 50
    assert decontaminate.overlaps(cases.empty(spark), bench).count() == 0
    assert decontaminate.overlaps(cases.frame(spark, rows), bench.limit(0)).count() == 0


def test_passes_agree(spark, monkeypatch, sf):
    docs, bench = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "benchmark"))
    one = sorted(map(tuple, decontaminate.overlaps(docs, bench).collect()))
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 2500)
    assert 1 < len(list(decontaminate._passes(bench, "item_id", "text"))) < 12
    assert one == sorted(map(tuple, decontaminate.overlaps(docs, bench).collect()))
    dropped = {r.doc_id for r in docs.collect()} - {r.doc_id for r in decontaminate.clean(docs, bench).collect()}
    assert dropped == {r[0] for r in one}


def test_items_of_any_type_and_scripts_without_blanks(spark):
    rng = random.Random(8)
    chinese = "".join(chr(rng.randrange(0x4E00, 0x9FA5)) for _ in range(40))
    items = [(7, chinese), (8, cases.words(rng, 20)), (8, cases.words(rng, 20))]
    rows = ["他说：" + chinese[5:30] + "。", items[1][1] + " and", chinese[:9] + "。" + chinese[20:29], "other"]
    for kind in ("int", "string", "smallint"):
        bench = spark.createDataFrame(items, "item_id int, text string").withColumn("item_id", F.col("item_id").cast(kind))
        out = decontaminate.overlaps(cases.frame(spark, rows), bench)
        assert dict(out.dtypes)["item_id"] == kind
        assert {(r.doc_id, int(r.item_id)) for r in out.collect()} == {(0, 7), (1, 8)}


def test_clean_judges_each_row_by_its_own_text(spark):
    rng = random.Random(9)
    item, other = cases.words(rng, 30), cases.words(rng, 60)
    rows = [(None, item, "a"), (1, item, "b"), (1, other, "c"), (1, other, "c"), (None, None, "d"), (2, "", "e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, item string")
    bench = spark.createDataFrame([(0, item), (None, item), (3, None), (4, " ")], "item_id long, text string")
    out = decontaminate.clean(docs, bench)
    assert out.columns == docs.columns and sorted(r.item for r in out.collect()) == ["c", "c", "d", "e"]
    assert decontaminate.clean(docs, bench.limit(0)).count() == 6 and decontaminate.clean(docs.limit(0), bench).count() == 0
    assert len(decontaminate.overlaps(docs, bench).collect()) == 4


def test_very_long_texts_and_items(spark, monkeypatch):
    rng = random.Random(10)
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 1000)
    item = cases.words(rng, 3000)  # longer than a block
    long = cases.words(rng, 250_000)
    bench = spark.createDataFrame([(0, item), (1, cases.words(rng, 15))], "item_id long, text string")
    got = decontaminate.overlaps(cases.frame(spark, [long + " " + item + " " + long[:500], long]), bench).collect()
    assert [(r.doc_id, r.item_id, r.word_start, r.n_equal) for r in got] == [(0, 0, 250_000, 3000)]


def test_overlaps_match_brute_force(spark, sf):
    import re

    docs, bench = (spark.read.parquet(f"{sf}/{t}.parquet").collect() for t in ("documents", "benchmark"))
    norm = lambda t: " " + " ".join(re.findall(r"[^\x00-\x2f:-@\[-`{-\x7f]+", t.lower())) + " "
    whole = {(d.doc_id, b.item_id) for d in docs for b in bench if norm(b.text) in norm(d.text)}
    got = queries.op9_decontamination(spark, sf).collect()
    assert whole and whole <= {(r.doc_id, r.item_id) for r in got}


def brute_stretch(equal, least):
    n = len(equal)
    fits = [(a, b) for a in range(n) for b in range(a + 1, n + 1) if b - a >= least and 5 * sum(equal[a:b]) >= 4 * (b - a)]
    best = max(((a, b) for a in range(n + 1) for b in range(a, n + 1)), key=lambda x: (3 * sum(equal[x[0] : x[1]]) - 2 * (x[1] - x[0]), -x[1], -x[0]))
    return best if best in fits else max(fits, key=lambda x: (sum(equal[x[0] : x[1]]), x[0] - x[1], -x[0]), default=None)


def test_every_stretch_of_a_diagonal_is_judged():
    import numpy as np

    rng = random.Random(9)
    cases_ = ["1" * 13 + "0" * 6 + "1" * 13 + "0" * 6 + "1" * 13, "1" * 12 + "0" * 7 + "1" * 6 + "0" + "1" * 6, "0110111111", "0" * 30, ""]
    cases_ += ["".join("01"[rng.random() < share] for _ in range(rng.randint(1, 45))) for share in (0.6, 0.75, 0.85) for _ in range(60)]
    for case in cases_:
        equal = np.array([c == "1" for c in case], bool)
        for least in (10, 13):
            got = decontaminate.valid_stretch(equal, least)
            want = brute_stretch(equal.tolist(), least)
            assert (got is None) == (want is None), case
            if want:
                a, b = got
                assert b - a >= least and 5 * equal[a:b].sum() >= 4 * (b - a), case
                assert (b - a, equal[a:b].sum()) == (want[1] - want[0], equal[want[0] : want[1]].sum()), case
    assert decontaminate.valid_stretch(np.array([c == "1" for c in cases_[0]]), 13) and decontaminate.valid_stretch(np.array([c == "1" for c in cases_[1]]), 13)


def test_masks_find_every_substitution_pattern():
    import itertools
    import re

    masks = re.compile("|".join(m.replace("0", ".") for m in decontaminate.MASKS))
    for n in range(decontaminate.SPAN, decontaminate.NEAR + 1):
        for changed in itertools.combinations(range(n), n // 5):
            pattern = ["1"] * n
            for k in changed:
                pattern[k] = "0"
            assert masks.search("".join(pattern)), (n, changed)


def test_substituted_items_match_brute_force(spark):
    rng = random.Random(12)
    vocabulary = [f"w{k}" for k in range(400)]
    items = [rng.choices(vocabulary, k=n) for n in (4, 9, 10, 11, 12, 13, 15, 20, 40, 60) for _ in range(3)]
    rows = []
    for _ in range(120):
        words = rng.choices(vocabulary, k=rng.randint(0, 30))
        for _ in range(2):
            item = rng.choice(items)
            rate = rng.choice((0, 0.1, 0.2, 0.25))
            words += [rng.choice(vocabulary) if rng.random() < rate else w for w in item] + rng.choices(vocabulary, k=rng.randint(0, 9))
        rows.append(words)
    adjacent = items[21][:9] + ["x", "y"] + items[21][11:]
    ends = ["x", *items[6][1:9], "y"]
    rows += [adjacent, ends]

    want = {}
    for d, text in enumerate(rows):
        for i, item in enumerate(items):
            least = min(13, len(item))
            for diagonal in range(-len(item), len(text)):
                equal = [0 <= k + diagonal < len(text) and text[k + diagonal] == w for k, w in enumerate(item)]
                a, b = max(0, -diagonal), min(len(item), len(text) - diagonal)
                if b - a >= least and sum(equal) >= 0.7 * least:
                    if len(item) >= 10 and brute_stretch(equal[a:b], least) or len(item) < 10 and all(equal):
                        want[d, i] = True
    bench = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(items)], "item_id long, text string")
    got = decontaminate.overlaps(cases.frame(spark, [" ".join(t) for t in rows]), bench).collect()
    assert {(r.doc_id, r.item_id) for r in got} == set(want)
    assert (120, 21) in want and (121, 6) in want


def test_five_languages_and_a_small_share():
    import numpy as np

    rng = random.Random(21)
    alphabets = ("abcde", "fghij", "klmno", "pqrst", "uvwxy", "zäöüß")
    say = lambda k, n: " ".join("".join(rng.choices(alphabets[k], k=5)) for _ in range(n))
    table = np.full((6, language.BUCKETS), 0.1)
    for k in range(6):
        table[k] += np.bincount(language.trigram_buckets(say(k, 4000).encode()), minlength=language.BUCKETS)
    model = language.Model([f"l{k}" for k in range(6)], np.log(table / table.sum(axis=1, keepdims=True)))
    shares, _ = model.proportions(" ".join(say(k, 200) for k in range(5)).encode())
    assert np.allclose(shares[:5], 0.2, atol=0.02) and shares[5] == 0
    shares, _ = model.proportions((say(0, 9850) + " " + say(1, 150)).encode())
    assert 0.01 < shares[1] < 0.02 and (shares > 0).sum() == 2


def test_a_text_of_one_word_takes_linear_time(spark):
    import time

    bench = spark.createDataFrame([(1, "la " * 400), (2, "la " * 399 + "li")], "item_id long, text string")
    began = time.time()
    got = sorted(tuple(r) for r in decontaminate.overlaps(cases.frame(spark, ["la " * 100_000, "la " * 12]), bench).collect())
    assert [r[:6] for r in got] == [(0, 1, 0, 0, 400, 400), (0, 2, 0, 0, 399, 399)] and time.time() - began < 120
