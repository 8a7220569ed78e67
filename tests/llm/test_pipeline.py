import corpus_pipeline
from lexmill.llm import decontaminate, language, near_duplicates, packing, suffix_dedup
from tests.llm.test_dedup import brute_components, brute_repeats


def test_stages_against_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == [name for name, _ in corpus_pipeline.STAGES] and len(stages) == 5

    one = stages["language ID"](spark, docs, sf)
    assert one.columns == columns and one.count() >= 0.98 * docs.count()

    two = stages["n-gram Jaccard join"](spark, docs, sf)
    want = brute_components([(r.doc_id, r.text) for r in docs.collect()], 5, 80)
    assert two.columns == columns and sorted(r.doc_id for r in two.collect()) == sorted(k for k, (_, c) in want.items() if c == k)

    three = stages["suffix-array dedup"](spark, docs, sf)
    repeats = brute_repeats([(r.doc_id, r.text) for r in docs.collect()])
    left = {r.doc_id: r for r in three.collect()}
    assert three.columns == columns and all(r.n_chars == len(r.text) and r.text.strip() for r in left.values())
    assert {k for k, (n, removed, _, _) in repeats.items() if removed < n - 1} >= set(left)
    for k, (n, removed, _, _) in repeats.items():
        if not removed:
            assert len(left[k].text.encode()) == n

    four = stages["benchmark decontamination"](spark, docs, sf)
    hit = {r.doc_id for r in decontaminate.overlaps(docs, spark.read.parquet(f"{sf}/benchmark.parquet")).collect()}
    assert four.columns == columns and {r.doc_id for r in four.collect()} == {r.doc_id for r in docs.collect()} - hit


def test_run(spark, sf):
    rows = corpus_pipeline.run(spark, sf).collect()
    assert rows and max(r.offset + r.length for r in rows) <= packing.CAPACITY


def test_stages_on_odd_and_empty_tables(spark, sf):
    """Null, repeated and shared ids, null and empty texts, clashing columns: no row is lost or kept by its id."""
    item = spark.read.parquet(f"{sf}/benchmark.parquet").first().text
    own = [" ".join(f"{w}{k}" for k in range(60)) for w in ("a", "b", "c", "d")]
    texts = [(None, own[0]), (1, own[0]), (1, own[0]), (1, own[1]), (2, own[1]), (3, None), (3, ""), (None, item), (4, item), (4, own[2]), (None, own[3]), (None, own[3])]
    docs = spark.createDataFrame([(k, t, "en", "s", len(t or "")) for k, t in texts], "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.selectExpr("*", "monotonically_increasing_id() AS mark", "'x' AS key", "1 AS label", "2 AS item").cache()
    stages = dict(corpus_pipeline.STAGES)

    def left(stage, df=docs):
        out = stages[stage](spark, df, sf)
        assert out.columns == df.columns
        return sorted((r.doc_id or 0, r.text or "") for r in out.collect())

    assert all(t for _, t in left("language ID")) and len(left("language ID")) <= 10
    near = left("n-gram Jaccard join")
    assert near == sorted([(0, own[0]), (1, own[0]), (1, own[1]), (3, ""), (3, ""), (0, item), (4, item), (4, own[2]), (0, own[3]), (0, own[3])])
    assert left("benchmark decontamination") == sorted((k or 0, t or "") for k, t in texts if t != item)
    repeats = left("suffix-array dedup")
    assert [t for _, t in repeats].count(own[0]) == 2 and [t for _, t in repeats].count(own[1]) == 1  # equal id and text are one document
    assert stages["best-fit packing"](spark, docs, sf).count() == len(texts)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), sf).count() == 0, name
