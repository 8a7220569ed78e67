"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def small_batches(spark: SparkSession) -> None:
    """Texts have some KB each, so that Arrow batches of a thousand rows keep a task's memory to some
    MB on both sides, however many operators run in one session."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def as_bytes(name: str) -> Column:
    """A text column as UTF-8; null becomes empty."""
    return F.coalesce(F.col(name), F.lit("")).cast("binary")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share. Set to a folder under the session's warehouse
    only where spark.checkpoint.dir is unset, as in tests."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        found = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_shared"
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


@contextmanager
def shuffles_go(spark: SparkSession) -> Iterator[None]:
    """Within it, the shuffle files of a finished query are deleted at once. For writes only: what
    is written is read from the table, so nothing reads those files again."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def keep(df: DataFrame) -> DataFrame:
    """Cuts lineage: writes df as a table in the shared folder and reads it back.

    Later stages then survive lost executors without recomputing Python work, and several
    readers share one computation.
    """
    path = f"{shared_dir(df.sparkSession)}/kept-{uuid.uuid4().hex}"
    with shuffles_go(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_kept(spark: SparkSession, *frames: DataFrame) -> None:
    """Deletes tables of keep() that no lazy plan needs any more."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for df in frames:
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            if "/kept-" in folder:
                path = jvm.org.apache.hadoop.fs.Path(folder)
                path.getFileSystem(conf).delete(path, True)


#: Rows of a narrow list that goes to every executor at most, and keys that count as hot at most.
LISTED, HUBS, LEAST_HUB = 1_000_000, 4096, 2048


def listed(narrow: DataFrame) -> DataFrame:
    """A narrow kept table as a join side: broadcast if it has LISTED rows at most, else shuffled."""
    return F.broadcast(narrow) if narrow.limit(LISTED + 1).count() <= LISTED else narrow


def hub_level(total: int) -> int:
    """Rows of a key from which it is hot among total rows."""
    return max(LEAST_HUB, total // HUBS)


def hub_join(rows: DataFrame, facts: DataFrame, on: str, weight: str, total: int, hubs: bool | None = None) -> DataFrame:
    """rows joined with facts, which have one row for each `on` and in `weight` the number of its rows.

    A hot key would fill one task, so it comes by broadcast; there are fewer than HUBS such keys. All
    others are shuffled. hubs: whether there is any; None: facts is a kept table, which is asked.
    """
    hot = F.col(weight) > hub_level(total)
    if hubs is False or hubs is None and facts.filter(hot).isEmpty():
        return rows.join(facts, on)
    known = facts.select(on, *(F.col(c).alias(f"{c}_") for c in facts.columns if c != on)).filter(f"{weight}_ > {hub_level(total)}")
    both = rows.join(F.broadcast(known), on, "left")
    by_hub = both.filter(f"{weight}_ is not null").select(*rows.columns, *(F.col(f"{c}_").alias(c) for c in facts.columns if c != on))
    rest = both.filter(f"{weight}_ is null").select(rows.columns).join(facts.filter(~hot), on)
    return by_hub.unionByName(rest)


def sweep(spark: SparkSession) -> None:
    """Lets Spark's cleaner delete the broadcasts and shuffles of finished queries now: it learns from
    the driver's garbage collection what nothing refers to, and an idle driver seldom collects."""
    spark.sparkContext._jvm.System.gc()


def fresh(df: DataFrame, name: str) -> str:
    """A column name that df does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def columns(df: DataFrame, *but: str) -> list[Column]:
    """df's columns as they are, whatever their names hold, without some."""
    return [named(c) for c in df.columns if c not in but]


def named(name: str) -> Column:
    """A column by its exact name: dots and back quotes in it are no syntax."""
    return F.col("`" + name.replace("`", "``") + "`")


def release() -> None:
    """At the end of a task: gives free memory back to the system, as Python workers live on."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def hash_fraction(key: Column, seed: int = 0) -> Column:
    """A number in [0, 1) that depends on the key alone."""
    return F.pmod(F.xxhash64(F.lit(seed), key), F.lit(1_000_000)) / F.lit(1_000_000.0)
