import pytest
from pyspark.sql import functions as F

from lexmill.operators import embeddings, guards
from lexmill.operators.keyed_table import KeyedTable
from lexmill.sources.commits import ConcurrentWrite
from lexmill.streaming import incremental

SCHEMA = "k string, sha string, seq long"


def rows(df):
    return sorted(((r.k, r.sha) for r in df.collect()), key=str)


def table(spark, tmp_path, data, buckets=8):
    df = spark.createDataFrame(data, SCHEMA)
    t = KeyedTable(spark, str(tmp_path / "t")).create(df.schema, "k", buckets)
    t.upsert(df, "seq")
    return t


def test_last_write_wins_within_and_between_batches(spark, tmp_path):
    t = table(spark, tmp_path, [("a", "1", 1), ("a", "3", 3), ("a", "2", 2), ("b", "1", 1), (None, "n", 1)])
    assert rows(t.read()) == sorted([("a", "3"), ("b", "1"), (None, "n")], key=str)
    t.upsert(spark.createDataFrame([("b", "0", 9), ("b", "9", 0), (None, "m", 1), ("c", "1", 1)], SCHEMA), "seq")
    assert rows(t.read()) == sorted([("a", "3"), ("b", "0"), ("c", "1"), (None, "m")], key=str)


def test_one_key_rewrites_one_bucket(spark, tmp_path):
    t = table(spark, tmp_path, [(f"k{i}", "1", 1) for i in range(200)])
    _, before = t.log.read()
    assert len(before["folders"]) == 8
    t.upsert(spark.createDataFrame([("k7", "2", 1)], SCHEMA), sha="sha")
    _, after = t.log.read()
    assert sum(before["folders"][b] != f for b, f in after["folders"].items()) == 1
    assert t.read().count() == 200 and t.read().filter("sha = '2'").count() == 1
    number = t.log.read()[0]
    assert t.upsert(spark.createDataFrame([("k7", "2", 5)], SCHEMA), sha="sha") == number  # unchanged: no new version


def test_rows_without_an_order_must_be_unique(spark, tmp_path):
    t = table(spark, tmp_path, [("a", "1", 1)])
    with pytest.raises(guards.IntegrityError):
        t.upsert(spark.createDataFrame([("b", "1", 1), ("b", "2", 1)], SCHEMA))
    with pytest.raises(guards.IntegrityError):
        embeddings.upsert(t.read(), spark.createDataFrame([("b", "1", 1), ("b", "2", 1)], SCHEMA), "k")
    assert rows(t.read()) == [("a", "1")]


def test_readers_see_whole_versions_only(spark, tmp_path):
    t = table(spark, tmp_path, [("a", "1", 1), ("b", "1", 1)])
    version = t.log.read()[0]
    began = t.read()
    (tmp_path / "t" / "data" / f"{version + 1}-unfinished" / "_bucket=0").mkdir(parents=True)
    (tmp_path / "t" / "_commits" / "waiting-x").write_text("{")
    assert rows(t.read()) == [("a", "1"), ("b", "1")]
    other = KeyedTable(spark, t.root)
    number, now = other.log.read()
    t.upsert(spark.createDataFrame([("a", "2", 1)], SCHEMA), "seq")
    with pytest.raises(ConcurrentWrite):
        other._commit(number, now, {}, None)
    assert rows(began) == [("a", "1"), ("b", "1")] and rows(t.read(version)) == rows(began)
    assert rows(t.read()) == [("a", "2"), ("b", "1")]
    t.vacuum(1)
    assert rows(t.read()) == [("a", "2"), ("b", "1")] and f"{version + 1}-unfinished" not in t.log.names("data")
    with pytest.raises(ConcurrentWrite):
        KeyedTable(spark, t.root).log.commit(t.log.read()[0], {})


def test_delete_missing_and_deletions(spark, tmp_path):
    t = table(spark, tmp_path, [(f"k{i}", "1", 1) for i in range(50)])
    t.delete(spark.createDataFrame([("k3",), ("k4",), ("absent",)], "gone string"))
    assert t.read().count() == 48
    t.upsert(spark.createDataFrame([("x", "1", 1)], SCHEMA), delete_missing=True)
    assert rows(t.read()) == [("x", "1")]
    t.delete(spark.createDataFrame([("x",)], "k string"))
    assert t.read().count() == 0 and t.read().columns == ["k", "sha", "seq"]
    t.upsert(spark.createDataFrame([], SCHEMA), "seq", batch=("s", 4))
    before = t.log.read()[0]
    assert t.upsert(spark.createDataFrame([("y", "1", 1)], SCHEMA), "seq", batch=("s", 4)) == before and t.read().count() == 0


def test_changed_rows_come_once(spark):
    old = spark.createDataFrame([("a", "1"), ("a", "1"), ("a", "2"), ("b", None)], "chunk_id string, content_sha string")
    new = spark.createDataFrame([("a", "3"), ("b", None), ("c", None)], "chunk_id string, content_sha string")
    assert sorted(r.chunk_id for r in embeddings.changed_rows(new, old).collect()) == ["a", "c"]


def test_stream_takes_the_last_row_of_a_chunk(spark, tmp_path):
    from lexmill.sources.documents import write_chunks
    from lexmill.sources.schemas import CHUNK

    def chunk(i, text):
        return (i, text, tuple([""] * 5 + ["law"] + [""] * 9 + [[], [], []]))

    target, source = str(tmp_path / "target"), str(tmp_path / "in" / "*")
    seen = []

    def prepare(df):
        return df.withColumn("vector", F.array(F.length("content").cast("float")))

    for step, data in enumerate([[("a", "one"), ("b", "two"), ("a", "ONE")], [("b", "x"), ("c", "three"), ("b", "TWO")], []]):
        if data:
            write_chunks(spark.createDataFrame([chunk(*c) for c in data], CHUNK).coalesce(1), str(tmp_path / "in" / str(step)))
        incremental.ingest_stream(spark, source, target, str(tmp_path / "checkpoint"), prepare, 4).awaitTermination()
        seen.append(sorted((r.chunk_id, r.content, r.vector) for r in incremental.latest(spark, target).collect()))
    assert seen == [[("a", "ONE", [3.0]), ("b", "two", [3.0])], *[[("a", "ONE", [3.0]), ("b", "TWO", [3.0]), ("c", "three", [5.0])]] * 2]
