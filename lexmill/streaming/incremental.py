"""Change-only ingestion as a stream of chunk files; the target table is the state."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lexmill.operators.embeddings import ingest_rows
from lexmill.operators.keyed_table import BUCKETS, KeyedTable
from lexmill.sources.schemas import CHUNK

#: Where a row stands: by its file's time and name, then by its place in the file.
_PLACE = "struct(_metadata.file_modification_time, _metadata.file_path, _metadata.file_block_start) AS _file"


def ingest_stream(spark: SparkSession, chunks: str, target: str, checkpoint: str, prepare: Callable[[DataFrame], DataFrame] = lambda df: df, buckets: int = BUCKETS) -> StreamingQuery:
    """Each new file of chunks replaces the rows that changed; of several rows of one chunk the last written counts.

    The target is a KeyedTable: a batch writes the buckets it touches, becomes visible as a whole, and
    changes nothing when it is repeated. prepare: adds vectors or other columns to changed rows only.
    """

    def write(batch: DataFrame, number: int) -> None:
        table = KeyedTable(spark, target)
        rows = ingest_rows(batch).withColumn("content_sha", F.col("metadata.content_sha"))
        placed = rows.withColumn("_order", F.struct("_file", F.monotonically_increasing_id().alias("row")))
        if not table.exists():
            table.create(prepare(rows.drop("_file")).schema, "chunk_id", buckets)
        table.upsert(placed, "_order", "content_sha", lambda changed: prepare(changed.drop("_file", "_order")), batch=("stream", number))
        table.vacuum()

    stream = spark.readStream.schema(CHUNK).json(chunks).selectExpr("*", _PLACE)
    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def latest(spark: SparkSession, target: str) -> DataFrame:
    """The newest version that is whole."""
    return KeyedTable(spark, target).read()
