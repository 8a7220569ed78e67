"""A stored table in buckets by key, for upserts that rewrite only the buckets they touch.

A version names one folder for each bucket. An upsert writes its changed rows once, reads the buckets
that these fall into, writes those anew and commits a version that names the new folders beside the
old ones of all other buckets (sources.commits). A reader stays with the version it has begun with.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lexmill.operators.embeddings import changed_rows, last_of_each
from lexmill.operators.guards import assert_unique
from lexmill.sources.commits import CommitLog

#: Buckets of a new table; a bucket should hold some 100 MB to 1 GB.
BUCKETS = 64
_BUCKET = "_bucket"


class KeyedTable:
    """The table at root. A null key is a key like any other."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.log = spark, root.rstrip("/"), CommitLog(spark, root)

    def create(self, schema: StructType, key: str, buckets: int = BUCKETS) -> KeyedTable:
        """Commits an empty first version; ConcurrentWrite where the table exists."""
        self.log.commit(1, {"schema": schema.json(), "key": key, "buckets": buckets, "folders": {}, "batches": {}})
        return self

    def exists(self) -> bool:
        return self.log.read()[1] is not None

    def _version(self, number: int | None = None) -> tuple[int, dict]:
        number, content = self.log.read(number)
        if content is None:
            raise FileNotFoundError(f"no table at {self.root}")
        return number, content

    def _rows(self, content: dict, buckets: list[str] | None = None) -> DataFrame:
        schema = StructType.fromJson(json.loads(content["schema"]))
        paths = [f"{self.root}/{f}" for b, f in content["folders"].items() if buckets is None or b in buckets]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version, the newest committed one by default."""
        return self._rows(self._version(version)[1])

    def _bucket(self, content: dict) -> Column:
        return F.pmod(F.xxhash64(content["key"]), F.lit(content["buckets"])).cast("int").alias(_BUCKET)

    def _write(self, content: dict, rows: DataFrame, number: int) -> dict[str, str]:
        """Writes rows to a new data folder of a version; the folder of each bucket that has some."""
        folder = f"data/{number}-{uuid.uuid4().hex[:12]}"
        rows.withColumn(_BUCKET, self._bucket(content)).write.partitionBy(_BUCKET).parquet(f"{self.root}/{folder}")
        return {n.split("=")[1]: f"{folder}/{n}" for n in self.log.names(folder) if n.startswith(f"{_BUCKET}=")}

    def upsert(self, source: DataFrame, order: Column | str | None = None, sha: str | None = None, prepare: Callable[[DataFrame], DataFrame] = lambda df: df, delete_missing: bool = False, batch: tuple[str, int] | None = None) -> int:
        """The version in which source's rows replace those of their keys.

        order: of several rows of one key the last counts; without it they are refused (IntegrityError).
        sha: a column by which unchanged rows are told; they are not written, and prepare (which adds
        columns such as vectors) does not see them. delete_missing: source is the whole table.
        batch: (name, number) of a sequence; a number that has been written before changes nothing.
        """
        number, now = self._version()
        key, columns = now["key"], StructType.fromJson(json.loads(now["schema"])).names
        if batch is not None and now["batches"].get(batch[0], -1) >= batch[1]:
            return number
        source = assert_unique(source, key) if order is None else last_of_each(source, key, order)
        changed = source if sha is None or delete_missing else changed_rows(source, self._rows(now), key, sha)
        new = self._write(now, prepare(changed).select(columns), number + 1)
        if not new and not delete_missing and batch is None:
            return number
        mixed = [b for b in new if b in now["folders"] and not delete_missing]
        merged = self._write(now, self._merged(now, new, mixed), number + 1) if mixed else {}
        before = {} if delete_missing else now["folders"]
        self._commit(number, now, before | new | merged, batch)
        for b in mixed:
            self.log.delete(new[b])
        return number + 1

    def _merged(self, now: dict, new: dict[str, str], buckets: list[str]) -> DataFrame:
        """The rows of some buckets once those of the same keys in new have replaced them, dealt by bucket."""
        key, fresh = now["key"], self._rows(now | {"folders": new}, buckets)
        old, replaced = self._rows(now, buckets).alias("old"), fresh.select(F.col(key).alias("_key")).alias("new")
        stays = old.join(replaced, F.col(f"old.{key}").eqNullSafe(F.col("new._key")), "left_anti")
        return stays.unionByName(fresh).repartition(len(buckets), self._bucket(now))

    def delete(self, keys: DataFrame) -> int:
        """The version without the rows whose key is among keys' first column; only their buckets are written."""
        number, now = self._version()
        key = now["key"]
        gone = keys.select(F.col(keys.columns[0]).alias(key)).distinct()
        touched = [str(r[0]) for r in gone.select(self._bucket(now)).distinct().collect() if str(r[0]) in now["folders"]]
        if not touched:
            return number
        old, gone = self._rows(now, touched).alias("old"), gone.alias("gone")
        stays = old.join(gone, F.col(f"old.{key}").eqNullSafe(F.col(f"gone.{key}")), "left_anti")
        left = self._write(now, stays.repartition(len(touched), self._bucket(now)), number + 1)
        self._commit(number, now, {b: f for b, f in now["folders"].items() if b not in touched} | left, None)
        return number + 1

    def _commit(self, number: int, now: dict, folders: dict[str, str], batch: tuple[str, int] | None) -> None:
        batches = now["batches"] | ({batch[0]: batch[1]} if batch else {})
        self.log.commit(number + 1, now | {"folders": folders, "batches": batches})

    def vacuum(self, keep: int = 2) -> list[str]:
        """Removes all but the newest `keep` versions and what only they held; returns the removed folders."""
        return self.log.forget(keep, lambda content: content["folders"].values())
