"""Versioned master tables on plain Parquet.

A master is a folder of versions. A version holds rows in hash buckets, as
Parquet partitions: all rows, or only those that a batch added or changed.
Written last, a small ``current`` table names the versions that make up each
bucket, and the number of buckets. A reader takes the newest version that has
its ``current`` table, so a job that dies half-way leaves the previous version
in place; of several rows with one key the newest version's counts. What an
upsert writes grows with its batch, not with the master. An upsert that leaves
a bucket with ``FOLD_AT`` versions folds such buckets into one version each,
and removes the folders that the newest ``KEEP`` versions do not name, so that
files and readers' work stay bounded however many batches come. A reader that
works on an older version than those must start again. The number of buckets is the master's for good:
opened with another, it refuses, and opened without one it takes the stored
one. There is one writer per master.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidewell.operators.dedup import first_per_key
from tidewell.operators.upsert import STATUS, collapse_incoming, merge_with_status, status_counts

BUCKET = "_bucket"
DEFAULT_BUCKETS = 64
#: Versions of a bucket at which an upsert folds it, and finished versions whose data stay for readers that began with them.
FOLD_AT, KEEP = 8, 3


class Master:
    def __init__(self, spark: SparkSession, path: str, schema: StructType, key: str, date_col: str,
                 source_col: str | None = None, buckets: int | None = None):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.key, self.date_col, self.source_col = key, date_col, source_col
        stored = self._places()[1]
        if stored and buckets and stored != buckets:
            raise ValueError(f"the master at {path} has {stored} buckets, not {buckets}")
        self.buckets = stored or buckets or DEFAULT_BUCKETS

    def _files(self):
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.path)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path, jvm

    def versions(self) -> list[int]:
        """Finished versions, oldest first."""
        fs, _, jvm = self._files()
        done = [v for v in self._folders(r"v=(\d+)")
                if fs.exists(jvm.org.apache.hadoop.fs.Path(f"{self.path}/v={v}/current/_SUCCESS"))]
        return sorted(done)

    def _places(self) -> tuple[dict[int, list[int]], int | None]:
        """bucket -> versions of its data, oldest first (few for each of at most ``buckets``), and the stored number of buckets."""
        done = self.versions()
        if not done:
            return {}, None
        rows = self.spark.read.schema("bucket int, version int, buckets int") \
                   .parquet(f"{self.path}/v={done[-1]}/current").collect()
        places: dict[int, list[int]] = {}
        for r in sorted((r["bucket"], r["version"]) for r in rows if r["bucket"] is not None):
            places.setdefault(r[0], []).append(r[1])
        return places, next((r["buckets"] for r in rows), None)

    def _current(self) -> dict[int, list[int]]:
        places, stored = self._places()
        if stored and stored != self.buckets:
            raise ValueError(f"the master at {self.path} has {stored} buckets, not {self.buckets}")
        return places

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def _read(self, places: dict[int, list[int]]) -> DataFrame:
        """Rows of the buckets; only those of several versions are shuffled to find each key's newest row."""
        parts = [self.spark.createDataFrame([], self.schema)] if not places else []
        for many in (False, True):
            paths = [f"{self.path}/v={v}/data/{BUCKET}={b}" for b, vs in sorted(places.items()) for v in vs if (len(vs) > 1) == many]
            if not paths:
                continue
            rows = self.spark.read.schema(self.schema).parquet(*paths)
            if many:
                version = F.regexp_extract("_metadata.file_path", r"/v=(\d+)/data/", 1).cast("int")
                rows = first_per_key(rows.withColumn("_version", version), [self.key], [F.col("_version").desc()]).drop("_version")
            parts.append(rows)
        return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])

    def read(self) -> DataFrame:
        """All rows of the newest version; an absent master is an empty table."""
        return self._read(self._current())

    def _folders(self, pattern: str, *parts: str) -> list[int]:
        """Numbers of the sub-folders whose name fits ``pattern``."""
        fs, _, jvm = self._files()
        folder = jvm.org.apache.hadoop.fs.Path("/".join([self.path, *parts]))
        entries = fs.listStatus(folder) if fs.exists(folder) else []
        names = [entry.getPath().getName() for entry in entries]
        return [int(m.group(1)) for n in names if (m := re.fullmatch(pattern, n))]

    def _write(self, rows: DataFrame) -> int:
        # Unfinished versions keep their number, so that no folder is written twice.
        version = max(self._folders(r"v=(\d+)"), default=0) + 1
        # Rebalancing lets AQE split large buckets over tasks and join small ones.
        (
            rows.withColumn(BUCKET, self._bucket()).hint("rebalance", BUCKET)
            .write.partitionBy(BUCKET).option("compression", "zstd")
            .parquet(f"{self.path}/v={version}/data")
        )
        return version

    def _commit(self, version: int, places: dict[int, list[int]]) -> None:
        rows = [(b, v, self.buckets) for b, vs in sorted(places.items()) for v in vs] or [(None, None, self.buckets)]
        self.spark.createDataFrame(rows, "bucket int, version int, buckets int") \
            .coalesce(1).write.parquet(f"{self.path}/v={version}/current")

    def overwrite(self, rows: DataFrame) -> int:
        """Replace all rows; returns the version written."""
        version = self._write(rows.select(*[
            F.col(f.name).cast(f.dataType) for f in self.schema.fields]))
        held = self._folders(rf"{BUCKET}=(\d+)", f"v={version}", "data")
        self._commit(version, {bucket: [version] for bucket in held})
        return version

    def compact(self, least: int = 2) -> int | None:
        """Fold every bucket of ``least`` versions or more into one; returns the version written, if any."""
        current = self._current()
        split = {b: vs for b, vs in current.items() if len(vs) >= least}
        if not split:
            return None
        version = self._write(self._read(split))
        self._commit(version, {**current, **{b: [version] for b in split}})
        return version

    def _named(self, version: int) -> set[int]:
        """The versions whose data make up a finished version, and itself."""
        rows = self.spark.read.schema("version int").parquet(f"{self.path}/v={version}/current").distinct().collect()
        return {version} | {r[0] for r in rows if r[0] is not None}

    def remove_unused(self, keep: int = KEEP) -> list[int]:
        """Remove the folders that none of the newest ``keep`` finished versions names; returns their numbers.

        Numbers above the newest finished version belong to a write that may
        still run and are left alone.
        """
        done = self.versions()
        if not done:
            return []
        used = set().union(*(self._named(v) for v in done[-max(1, keep):]))
        unused = [v for v in self._folders(r"v=(\d+)") if v < done[-1] and v not in used]
        fs, _, jvm = self._files()
        for version in unused:
            # The mark goes first: a half-removed version must not count as finished.
            fs.delete(jvm.org.apache.hadoop.fs.Path(f"{self.path}/v={version}/current"), True)
            fs.delete(jvm.org.apache.hadoop.fs.Path(f"{self.path}/v={version}"), True)
        return unused

    def upsert(self, incoming: DataFrame, fold_at: int = FOLD_AT) -> dict[str, int]:
        """Merge a batch (one or more rows per key) and return the run's counts.

        ``total`` counts the rows written, one per key of the batch. The counts
        ride on the write itself: stages that run again after a lost executor can raise
        them, the written rows are not affected.
        """
        # Kept, since its buckets are asked for before it is merged.
        batch = collapse_incoming(
            incoming.select(*[c for c in incoming.columns if c in self.schema.names]),
            self.key, self.date_col, self.source_col).persist()
        try:
            # The batch's buckets: at most `buckets` numbers.
            touched = sorted(r[0] for r in batch.select(self._bucket()).distinct().collect())
            if not touched:
                return {"total": 0, "new": 0, "updated": 0, "source_only": 0}
            current = self._current()
            stored = self._read({b: vs for b, vs in current.items() if b in touched}).join(
                batch.select(self.key), self.key, "left_semi").select(*self.schema.names)
            merged = merge_with_status(stored, batch, self.key, self.date_col, self.source_col)
            seen = Observation("upsert")
            version = self._write(merged.observe(seen, *status_counts()).drop(STATUS))
            now = {**current, **{b: [*current.get(b, []), version] for b in touched}}
            self._commit(version, now)
            if any(len(versions) >= fold_at for versions in now.values()):
                self.compact(fold_at)
                self.remove_unused()
            return dict(seen.get)
        finally:
            batch.unpersist()


def write_table(df: DataFrame, path: str) -> None:
    """Write a derived table whole, zstd; fails if the path exists."""
    df.write.option("compression", "zstd").parquet(path)


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}")
