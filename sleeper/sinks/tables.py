"""Keyed Parquet tables with a recorded contract and whole versions.

A table's folder holds

* ``_table.json``: its schema, key and number of buckets, written once when the table is created;
* ``written=<version>-<id>/bucket=<n>/``: the rows of a bucket (by the key's hash) as one version wrote them;
* ``_manifest/<version>.json``: for each bucket the folder that holds its rows as of that version.

A version is current from the moment its manifest appears under its name, by one
rename that fails if another writer was first. Until then nobody reads what was
written for it; a writer that dies leaves the table as it was. The bucket number comes
from the record, never from the session, and rows that do not fit the contract are refused.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sleeper.operators.upsert import upsert
from sleeper.session import materialize
from sleeper.sinks.files import delete_path, list_folders, path_exists

CONTRACT = "_table.json"
MANIFESTS = "_manifest"
#: Folder column of a table's rows: the bucket of their key's hash.
BUCKET = "bucket"


class TableMismatch(ValueError):
    """Rows or a request that do not fit the table's recorded contract."""


class VersionTaken(RuntimeError):
    """Another writer made its version current first; nothing of this one is visible."""


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def publish(spark: SparkSession, path: str, text: str) -> bool:
    """Make a small file appear under ``path`` with all of ``text`` at once; False if there is one already."""
    fs, target = _fs(spark, path)
    fs.mkdirs(target.getParent())
    draft = spark._jvm.org.apache.hadoop.fs.Path(target.getParent(), f"_draft-{uuid.uuid4().hex}")
    stream = fs.create(draft, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    jvm = spark._jvm.org.apache.hadoop.fs
    nothing = spark._sc._gateway.new_array(getattr(jvm, "Options$Rename"), 0)
    where = fs.makeQualified(target)
    try:
        jvm.FileContext.getFileContext(where.toUri(), spark._jsc.hadoopConfiguration()).rename(
            fs.makeQualified(draft), where, nothing)
        return True
    except Py4JJavaError as e:
        fs.delete(draft, False)
        if "FileAlreadyExists" in e.java_exception.getClass().getName():
            return False
        raise


def record_once(spark: SparkSession, path: str, record: dict) -> dict:
    """Write ``record`` as JSON unless there is one; the one that holds from now on."""
    if not path_exists(spark, path):
        publish(spark, path, json.dumps(record, sort_keys=True))
    return json.loads(read_text(spark, path))


def _types(schema: StructType) -> dict[str, str]:
    return {f.name: f.dataType.simpleString() for f in schema.fields}


@dataclass(frozen=True)
class Manifest:
    """One version: per bucket ``{"folder": name, ...}`` with whatever the writer noted of it, and notes of the whole."""

    version: int
    buckets: dict[int, dict]
    notes: dict


class KeyedTable:
    """A table of unique keys; see the module for its folder."""

    def __init__(self, spark: SparkSession, path: str, record: dict):
        self.spark, self.path = spark, path.rstrip("/")
        self.key: list[str] = record["key"]
        self.buckets: int = record["buckets"]
        self.schema = StructType.fromJson(record["schema"])

    # -- contract ------------------------------------------------------------

    @classmethod
    def create_if_absent(cls, spark: SparkSession, path: str, schema: StructType, key: str | list[str],
                         buckets: int = 32) -> KeyedTable:
        """The table at ``path``, made with this contract if there is none. A table that is there keeps its
        number of buckets; another schema or key is refused. A bucket is written by one task: choose
        ``buckets`` for the size that the table will have."""
        keys = [key] if isinstance(key, str) else list(key)
        if missing := [k for k in keys if k not in schema.names]:
            raise TableMismatch(f"key {missing} is no column")
        if BUCKET in schema.names:
            raise TableMismatch(f"the column name {BUCKET} is taken")
        if buckets < 1:
            raise ValueError("a table has one bucket at least")
        wanted = {"key": keys, "buckets": buckets, "schema": json.loads(schema.json())}
        table = cls(spark, path, record_once(spark, f"{path.rstrip('/')}/{CONTRACT}", wanted))
        if table.key != keys:
            raise TableMismatch(f"the table's key is {table.key}, not {keys}")
        table.check_columns(schema)
        return table

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> KeyedTable:
        return cls(spark, path, json.loads(read_text(spark, f"{path.rstrip('/')}/{CONTRACT}")))

    def check_columns(self, schema: StructType) -> None:
        have, want = _types(schema), _types(self.schema)
        if have != want:
            drift = [f"{n}: {want.get(n, 'no column')} expected, {have.get(n, 'no column')} found"
                     for n in sorted(want.keys() | have.keys()) if want.get(n) != have.get(n)]
            raise TableMismatch("; ".join(drift))

    def check_keys(self, rows: DataFrame) -> None:
        """Refuse null and repeated keys."""
        null = F.lit(False)
        for k in self.key:
            null = null | F.col(k).isNull()
        bad = rows.groupBy(*self.key).agg(F.count(F.lit(1)).alias("n")).where((F.col("n") > 1) | null).head(1)
        if bad:
            raise TableMismatch(f"null or repeated key: {bad[0].asDict()}")

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in self.key]), F.lit(self.buckets)).cast("int")

    def bucketed(self, rows: DataFrame) -> DataFrame:
        return rows.select(*self.schema.names, self.bucket().alias(BUCKET))

    # -- versions ------------------------------------------------------------

    def versions(self) -> list[int]:
        if not path_exists(self.spark, f"{self.path}/{MANIFESTS}"):
            return []
        fs, p = _fs(self.spark, f"{self.path}/{MANIFESTS}")
        names = (s.getPath().getName() for s in fs.listStatus(p))
        return sorted(int(m.group(1)) for m in (re.fullmatch(r"(\d+)\.json", n) for n in names) if m)

    def _manifest_path(self, version: int) -> str:
        return f"{self.path}/{MANIFESTS}/{version:012d}.json"

    def manifest(self, version: int | None = None) -> Manifest:
        if version is None:
            version = max(self.versions(), default=0)
        if not version:
            return Manifest(0, {}, {})
        m = json.loads(read_text(self.spark, self._manifest_path(version)))
        return Manifest(version, {int(b): x for b, x in m["buckets"].items()}, m["notes"])

    def read(self, at: Manifest | None = None, buckets: Iterable[int] | None = None) -> DataFrame:
        """The rows of a version (the current one), of some buckets or all."""
        at = at or self.manifest()
        wanted = at.buckets if buckets is None else at.buckets.keys() & set(buckets)
        paths = [f"{self.path}/{at.buckets[b]['folder']}/{BUCKET}={b}" for b in sorted(wanted)]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def write(self, rows: DataFrame) -> str:
        """Write ``rows`` (with BUCKET) for a version that is not current yet; returns its folder."""
        folder = f"written={max(self.versions(), default=0) + 1}-{uuid.uuid4().hex[:8]}"
        rows.repartition(BUCKET).write.option("compression", "snappy").partitionBy(BUCKET).parquet(f"{self.path}/{folder}")
        return folder

    def commit(self, base: Manifest, folder: str, touched: dict[int, dict], notes: dict | None = None) -> Manifest:
        """Make ``base`` with the ``touched`` buckets from ``folder`` the current version. Buckets that hold no
        rows any more have no files and leave the manifest."""
        there = {int(n.split("=")[1]) for n in list_folders(self.spark, f"{self.path}/{folder}") if n.startswith(f"{BUCKET}=")}
        buckets = {b: x for b, x in base.buckets.items() if b not in touched}
        buckets |= {b: {**x, "folder": folder} for b, x in touched.items() if b in there}
        new = Manifest(base.version + 1, buckets, base.notes if notes is None else notes)
        text = json.dumps({"buckets": {str(b): buckets[b] for b in sorted(buckets)}, "notes": new.notes})
        if not publish(self.spark, self._manifest_path(new.version), text):
            delete_path(self.spark, f"{self.path}/{folder}")
            raise VersionTaken(f"version {new.version} of {self.path} was written meanwhile")
        return new

    def vacuum(self, keep: int = 2) -> None:
        """Delete what no one of the last ``keep`` versions reads. Folders of no version (writers at work) stay."""
        versions = self.versions()
        old, kept = [self.manifest(v) for v in versions[:-keep]], [self.manifest(v) for v in versions[-keep:]]
        used = {(x["folder"], b) for m in kept for b, x in m.buckets.items()}
        for folder, b in {(x["folder"], b) for m in old for b, x in m.buckets.items()} - used:
            delete_path(self.spark, f"{self.path}/{folder}/{BUCKET}={b}")
        for folder in {x["folder"] for m in old for x in m.buckets.values()} - {f for f, _ in used}:
            delete_path(self.spark, f"{self.path}/{folder}")
        for m in old:
            delete_path(self.spark, self._manifest_path(m.version))

    # -- upsert --------------------------------------------------------------

    def upsert(self, updates: DataFrame, update_cols: list[str] | None = None) -> Manifest:
        """Insert new keys, update ``update_cols`` (all by default) of those that are there. Only the buckets
        that ``updates`` reaches are read and written. Columns that drift, and null or repeated keys, are
        refused before anything is written."""
        self.check_columns(updates.schema)
        if unknown := set(update_cols or ()) - set(self.schema.names):
            raise TableMismatch(f"no such columns: {sorted(unknown)}")
        rows = materialize(self.bucketed(updates), "updates")
        self.check_keys(rows)
        return self.replace(rows, lambda current, new: upsert(current, new, [BUCKET, *self.key], update_cols))

    def replace(self, rows: DataFrame, merge: Callable[[DataFrame, DataFrame], DataFrame]) -> Manifest:
        """One new version in which the buckets of ``rows`` hold ``merge(their rows so far, rows)``; both have BUCKET."""
        base = self.manifest()
        touched = [r[BUCKET] for r in rows.select(BUCKET).distinct().collect()]  # no more than there are buckets
        if not touched:
            return base
        current = self.bucketed(self.read(base, touched))
        return self.commit(base, self.write(merge(current, rows)), {b: {} for b in touched})
