import io
import zipfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexmill.operators import audit, embeddings, evaluation, guards, lexical, quality
from lexmill.streaming import incremental


def test_tokens(spark):
    tokens = lambda s: spark.createDataFrame([(s,)], "t string").select(lexical.tokenize("t")).first()[0]
    assert tokens("I-131 Tc-99m a xy 1.5 가나 방사선량") == ["i-131", "tc-99m", "xy", "1.5", "가나", "방사", "사선", "선량", "방사선", "사선량"]
    assert tokens(None) == []


def test_bm25_against_a_loop(spark):
    from math import log

    docs = ["a cat sat", "the cat cat", "dog dog dog", ""]
    df = spark.createDataFrame(list(enumerate(docs)), "doc long, text string")
    q = spark.createDataFrame([(1, "cat dog cat")], "qid long, text string")
    tokens = [[w for w in d.split() if len(w) > 1] for d in docs]
    avg = sum(max(1, len(t)) for t in tokens) / 4
    want = {}
    for term in ("cat", "dog"):
        n = sum(term in t for t in tokens)
        for k, t in enumerate(tokens):
            if c := t.count(term):
                want[k] = want.get(k, 0) + log(1 + (4 - n + 0.5) / (n + 0.5)) * c * 2.5 / (c + 1.5 * (0.25 + 0.75 * max(1, len(t)) / avg))
    got = {r.doc: r.score for r in lexical.bm25_scores(df, q).collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in got)


def test_fusion_of_one_list_keeps_its_order(spark):
    r = spark.createDataFrame([(1, "a", k + 1, d) for k, d in enumerate([5, 3, 9])], "qid long, retriever string, rank int, doc long")
    w = spark.createDataFrame([("w", "a", 0.7)], "weighting string, retriever string, weight double")
    assert [x.doc for x in lexical.rrf(r, w).orderBy("rank").collect()] == [5, 3, 9]


def test_knn_against_numpy(spark):
    rng = np.random.default_rng(0)
    m = rng.normal(size=(300, 16)).astype(np.float32)
    df = spark.createDataFrame([(k, v.tolist(), k % 3) for k, v in enumerate(m)], "doc long, embedding array<float>, part int").repartition(5)
    q = df.filter("doc < 20").select(F.col("doc").alias("qid"), "embedding")
    n = m / np.linalg.norm(m, axis=1, keepdims=True)
    for where, allowed in ((None, np.ones(300, bool)), (F.col("part") == 1, np.arange(300) % 3 == 1)):
        got = embeddings.knn(q, df, 7, where=where, block=8).collect()
        for k in range(20):
            s = np.where(allowed, n @ n[k], -9)
            assert [r.doc for r in sorted((r for r in got if r.qid == k), key=lambda r: r.rank)] == np.argsort(-s, kind="stable")[:7].tolist()


def test_knn_of_vectors_that_are_none(spark):
    nan = float("nan")
    rows = [(1, [1.0, 0.0]), (2, None), (3, [1.0, 0.1, 0.0]), (4, []), (5, [nan, 1.0]), (6, [None, 1.0]), (7, [0.9, 0.1]), (8, [1.0, 0.0]), (None, [0.0, 1.0])]
    df = spark.createDataFrame(rows, "doc long, embedding array<float>").repartition(3)
    got = embeddings.knn(df.withColumnRenamed("doc", "qid"), df, 3, block=2).collect()
    by = {}
    for r in sorted(got, key=lambda r: r.rank):
        by.setdefault(r.qid, []).append(r.doc)
    assert by[1] == by[8] == [1, 8, 7] and by[7] == [7, 1, 8] and by[3] == [3] and by.keys() == {1, 3, 7, 8, None}
    assert embeddings.knn(df.limit(0).withColumnRenamed("doc", "qid"), df, 3).count() == 0 and embeddings.knn(df.withColumnRenamed("doc", "qid"), df.limit(0), 3).count() == 0


def test_cells_leave_products_out_and_no_neighbour(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(40, 24))
    m = embeddings.normalize_matrix(np.concatenate([c + 0.05 * rng.normal(size=(150, 24)) for c in centres]))
    m = m[rng.permutation(len(m))]
    nearest = embeddings.Nearest(m[:50], 5)
    for at in range(0, len(m), 1500):
        nearest.meet(m[at : at + 1500], np.arange(at, at + len(m[at : at + 1500])))
    top = nearest.best()
    for q in range(50):
        s = np.round(m @ m[q], 6)
        assert top[top["q"] == q]["doc"].tolist() == sorted(range(len(m)), key=lambda d: (-s[d], d))[:5]
    assert nearest.products < 0.6 * 50 * len(m)


def test_upsert(spark):
    old = spark.createDataFrame([("a", "1"), ("b", "1"), ("c", "1")], "chunk_id string, content_sha string")
    new = spark.createDataFrame([("a", "1", 1), ("b", "2", 1), ("d", "3", 1), ("d", "4", 2)], "chunk_id string, content_sha string, seq int")
    changed = embeddings.changed_rows(new, old)
    assert sorted(r.chunk_id for r in changed.collect()) == ["b", "d", "d"]
    rows = lambda df: sorted(tuple(r) for r in df.collect())
    assert rows(embeddings.upsert(old, changed, order="seq")) == [("a", "1"), ("b", "2"), ("c", "1"), ("d", "4")]
    assert rows(embeddings.upsert(old, new, order="seq", delete_missing=True)) == [("a", "1"), ("b", "2"), ("d", "4")]
    assert embeddings.changed_rows(new, old, force=True).count() == 4


def test_stream_gives_the_batch_result(spark, tmp_path):
    from lexmill.sources.documents import write_chunks
    from lexmill.sources.schemas import CHUNK

    def chunk(i, text):
        return (i, text, tuple([""] * 5 + ["law"] + [""] * 9 + [[], [], []]))

    write_chunks(spark.createDataFrame([chunk("a", "one"), chunk("b", "two")], CHUNK), str(tmp_path / "in" / "1"))
    target, checkpoint = str(tmp_path / "target"), str(tmp_path / "checkpoint")
    source = str(tmp_path / "in" / "*")
    incremental.ingest_stream(spark, source, target, checkpoint).awaitTermination()
    write_chunks(spark.createDataFrame([chunk("b", "TWO"), chunk("c", "three")], CHUNK), str(tmp_path / "in" / "2"))
    incremental.ingest_stream(spark, source, target, checkpoint).awaitTermination()
    assert sorted((r.chunk_id, r.content) for r in incremental.latest(spark, target).collect()) == [("a", "one"), ("b", "TWO"), ("c", "three")]


def test_vectors(spark):
    df = spark.createDataFrame([("x", "방사선 안전"), ("y", None)], "id string, text string")
    out = embeddings.embed(df, "text", embeddings.hashing_embedder(8), prefix="query: ").collect()
    assert all(len(r.embedding) == 8 for r in out)
    v = spark.createDataFrame([([3.0, 4.0, 9.0],)], "v array<float>").select(embeddings.truncate_normalize("v", 2)).first()[0]
    assert v == pytest.approx([0.6, 0.8])
    with pytest.raises(guards.IntegrityError):
        guards.assert_dim(spark.createDataFrame([([1.0],)], "embedding array<float>"), 2)


def units(spark):
    rows = [(1, "의료법", "제4조", ""), (2, "의료기기법", "제4조", ""), (3, "의료법시행령", "", "3"), (4, "의료분야의방사선안전관리에관한기술기준", "", "2")]
    return spark.createDataFrame(rows, "id long, law string, article string, annex string")


@pytest.mark.parametrize("expected,want", [(["의료법"], {1, 3}), (["의료법 제4조"], {1, 2}), (["의료법 시행령 별표3의2"], {3}), (["의료분야 방사선안전관리 기술기준 별표 2"], {4}), (["의"], set()), ([], set())])
def test_sources(spark, expected, want):
    q = spark.createDataFrame([(1, expected)], "qid long, expected_sources array<string>")
    assert {r.id for r in evaluation.match_sources(q, units(spark)).collect()} == want


def test_strict_sources(spark):
    q = spark.createDataFrame([(1, ["의료법 제4조의2"])], "qid long, expected_sources array<string>")
    assert {r.id for r in evaluation.match_sources(q, units(spark), mode="strict").collect()} == {1}


def test_answerable(spark):
    q = spark.createDataFrame([(1, [["50"], ["차폐"]]), (2, [["없음"]]), (3, [])], "qid long, answer_keys array<array<string>>")
    u = spark.createDataFrame([(1, "50 mSv"), (2, "차폐"), (3, "50 차폐")], "id long, text string")
    r = spark.createDataFrame([(1, "v", 1, 1), (1, "v", 2, 2), (1, "v", 4, 3), (2, "v", 1, 1)], "qid long, retriever string, rank int, doc long")
    got = {(x.mode, x.k): (x.hits, x.n) for x in evaluation.answerable_recall(r, q, u).collect()}
    assert got["strict", 3] == (0, 2) and got["union", 3] == (1, 2) and got["strict", 5] == (1, 2) and got["union", 1] == (0, 2)
    best = evaluation.best_ranks(r, spark.createDataFrame([(2, 1)], "qid long, doc long"), q)
    assert [(x.qid) for x in evaluation.source_hit_answer_miss(r, best, q, u).collect()] == [2]
    assert {(x.qid, x.key) for x in guards.missing_keys(q, u).collect()} == {(2, "없음")}


def test_proposed_keys(spark):
    q = spark.createDataFrame([(1, None, "제3조에 따라 50mSv"), (2, [["x"]], "9")], "qid long, answer_keys array<array<string>>, ground_truth string")
    assert [(r.proposed, r.answer_keys) for r in evaluation.keyed_questions(q).orderBy("qid").collect()] == [(True, [["50"]]), (False, [["x"]])]


def test_excerpt(spark):
    body = "머리 | 값 | 단위\n첫 줄\nI-131 | 50 | Bq\nTc-99m | 50 | Bq\n" + "가" * 300
    df = spark.createDataFrame([(1, body, [["50"]], "I-131 한도"), (2, "가\n나\n다", [], "?"), (3, "", [], "?")], "k long, text string, answer_keys array<array<string>>, question string")
    got = {r.k: r.lines for r in lexical.excerpt(df, ["k"]).collect()}
    assert got[1] == ["머리 | 값 | 단위", "I-131 | 50 | Bq", "Tc-99m | 50 | Bq"] and got[2] == ["가", "나"]


def test_audit(spark):
    answers = spark.createDataFrame([("q1", "m", "「근거」 법\n한도 50mSv, 7 Bq", ["c1", "c2"]), ("q2", "m", "1.2e-3 오기 1E+09", ["none"])], "qid string, model string, answer string, chunk_ids array<string>")
    chunks = spark.createDataFrame([("c1", "표 50 | 8"), ("c2", None)], "chunk_id string, content string")
    bad, form = audit.unsupported_values(answers, chunks), audit.format_violations(answers)
    assert [(r.qid, r.unsupported) for r in bad.collect()] == [("q1", ["7"])]
    assert {r.qid: r.violations for r in form.collect()} == {"q1": [], "q2": ["no_citation", "raw_exponent", "self_correction"]}
    assert tuple(audit.audit_summary(bad, form).first()) == ("m", 2, 1, 1)


def test_corrections_are_all_or_nothing(spark):
    docs = spark.createDataFrame([("a", "x1 x1 y"), ("b", "x1 y"), ("c", "x1")], "stem string, body string")
    rules = spark.createDataFrame([(s, [("x1", "z", 2), ("y", "w", 1)]) for s in "ab"], "stem string, rules array<struct<find: string, replace: string, expect: int>>")
    got = {r.stem: (r.body, r.correction) for r in quality.apply_corrections(docs, rules).collect()}
    assert got == {"a": ("z z w", "corrected"), "b": ("x1 y", "correction_stale"), "c": ("x1", "")}


def test_extraction_flags(spark):
    long = "가나다라" * 100
    rows = [("fallback", "짧다", long), ("chars", long, long + "하" * 200), ("numbers", long, long + " 11 22 33 44 55"), ("short", "x", None), ("lost", long + " 2.58×C/kg", None), ("fine", long, long)]
    df = spark.createDataFrame([(a, b, c, "corrected" if a == "lost" else "") for a, b, c in rows], "stem string, body string, pdf_text string, fix string")
    got = {r.stem: r.note for r in quality.audit_extraction(df, correction="fix").collect()}
    assert got == {"fallback": "pdf_fallback", "chars": "char_diverge", "numbers": "num_diverge", "short": "short_no_pdf", "lost": "corrected+math_loss", "fine": ""}


def test_office_documents(spark):
    xml = "<s xmlns='u'><p><t>첫</t><t> 줄</t></p><p><run><tbl><tr><tc><cellSpan colSpan='2'/><subList><p><t>a</t></p><p><t>b</t></p></subList></tc></tr></tbl></run></p></s>"
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        z.writestr("Contents/section0.xml", xml)
        z.writestr("other.xml", "<x/>")
    df = spark.createDataFrame([(bytearray(buffer.getvalue()),), (bytearray(b"broken"),), (None,)], "content binary")
    got = [r[0] for r in df.select(quality.parse_ooxml_sections("content")).collect()]
    assert got[0].body == '첫 줄\n\n<table>\n<tr>\n<td colspan="2">a\nb</td>\n</tr>\n</table>' and got[0].error is None
    assert got[1].body == "" and got[1].error and got[2].error


def test_whole_texts_are_embedded(spark, sf):
    from lexmill.plans import retrieval

    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = {r.doc_id: r.embedding for r in retrieval.embedded(spark, sf).collect()}
    assert got.keys() == texts.keys() and any(len(t) > embeddings.CAP for t in texts.values())
    embed = embeddings.hashing_embedder(32)
    assert all(np.allclose(got[k], embed([t])[0], atol=1e-6) for k, t in texts.items())


def test_wordings_in_several_passes(spark):
    keys = [[f"word{k}", f"other{k}"] for k in range(9)] + [["", "x"], ["50"]]
    q = spark.createDataFrame([(1, keys)], "qid long, answer_keys array<array<string>>")
    u = spark.createDataFrame([(1, "a word1, word 2"), (2, "OTHER3 other4 word5x"), (3, None), (4, "50 mSv")], "id long, text string")
    assert {r.key for r in guards.missing_keys(q, u).collect()} == {f"word{k}|other{k}" for k in (0, 3, 6, 7, 8)}
    assert guards.missing_keys(q, u.limit(0)).count() == 11


def test_strict_names_match_a_plain_loop(spark):
    import random

    rng = random.Random(2)
    name = lambda: "".join(rng.choices("가나다", k=rng.randint(1, 7)))
    laws, asked = sorted({name() for _ in range(60)}), [name() for _ in range(40)]
    u = spark.createDataFrame([(k, law, "", "") for k, law in enumerate(laws)], "id long, law string, article string, annex string")
    q = spark.createDataFrame([(k, [x]) for k, x in enumerate(asked)], "qid long, expected_sources array<string>")
    want = {(a, b) for a, x in enumerate(asked) for b, law in enumerate(laws) if len(law) > 3 and (x in law or law in x)}
    assert want and {(r.qid, r.id) for r in evaluation.match_sources(q, u, mode="strict").collect()} == want


def test_token_counts_are_the_tokens(spark):
    rows = [("I-131 Tc-99m a xy 1.5 가나 방사선량",), (None,), ("",), ("ABC def 12",), ("가나다라마 x",), ("İstanbul K",)]
    df = spark.createDataFrame(rows, "t string").select(F.size(lexical.tokenize("t")).alias("n"), lexical.token_count("t").alias("m"))
    assert all(r.n == r.m for r in df.collect())
