"""Tables that are changed by key, in versions.

``<path>/data/<id>/bucket=<k>/`` holds rows; ``<path>/log/<version>.json`` names, for each bucket, the
folder with its valid rows, and for each stream the last of its batches that is in. The entry with
the highest number is the table. An entry appears by a rename that fails where the name is taken, so
of two writers one is first and the other reads the new version and tries again; readers see a
version whole or not at all. A change rewrites the buckets it touches, not the table.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKETS = 16
# Times a writer that was overtaken tries again.
ATTEMPTS = 20
_BUCKET, _NEW = "__bucket", "__new"


@dataclass(frozen=True)
class Version:
    number: int = -1
    #: Folder of each bucket that has rows.
    parts: dict[str, str] = field(default_factory=dict)
    #: Last batch of each stream.
    batches: dict[str, int] = field(default_factory=dict)


class VersionedTable:
    """Rows of ``schema``, one per value of ``keys`` (NULL is a value)."""

    def __init__(self, spark: SparkSession, path: str, schema: str | T.StructType, keys: list[str], buckets: int = BUCKETS):
        self.spark, self.path, self.keys, self.buckets = spark, path.rstrip("/"), keys, buckets
        self.schema = spark.createDataFrame([], schema).schema
        self._hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._files = self._hadoop.Path(self.path).getFileSystem(conf)
        self._context = self._hadoop.FileContext.getFileContext(self._files.getUri(), conf)

    # --- reading

    def versions(self) -> list[int]:
        log = self._hadoop.Path(f"{self.path}/log")
        if not self._files.exists(log):
            return []
        names = [f.getPath().getName() for f in self._files.listStatus(log)]
        return sorted(int(n[: -len(".json")]) for n in names if n.endswith(".json"))

    def latest(self) -> Version:
        numbers = self.versions()
        return self.version(numbers[-1]) if numbers else Version()

    def version(self, number: int) -> Version:
        text = self.spark.read.text(self._entry(number), wholetext=True).first()[0]
        return Version(**json.loads(text))

    def before(self, stream: str, batch: int) -> Version:
        """The table as it was when this batch of the stream first came."""
        for number in reversed(self.versions()):
            version = self.version(number)
            if version.batches.get(stream, -1) < batch:
                return version
        return Version()

    def read(self, version: Version | None = None) -> DataFrame:
        """The rows of a version, by default of the latest."""
        return self._rows(version or self.latest()).drop(_BUCKET)

    def _rows(self, version: Version, only: set[str] | None = None) -> DataFrame:
        schema = T.StructType([*self.schema.fields, T.StructField(_BUCKET, T.IntegerType())])
        parts = {k: v for k, v in version.parts.items() if only is None or k in only}
        if not parts:
            return self.spark.createDataFrame([], schema)
        out = None
        # One scan per folder; a folder's buckets are those that are still valid.
        for folder in sorted(set(parts.values())):
            paths = [f"{self.path}/data/{folder}/{_BUCKET}={k}" for k in sorted(parts) if parts[k] == folder]
            rows = self.spark.read.option("basePath", f"{self.path}/data/{folder}").schema(schema).parquet(*paths)
            out = rows if out is None else out.unionAll(rows)
        return out

    def _entry(self, number: int) -> str:
        return f"{self.path}/log/{number:012d}.json"

    # --- changing

    def upsert(
        self,
        changes: DataFrame,
        order: list[str],
        stream: str | None = None,
        batch: int | None = None,
        first_wins: bool = False,
        keep: Column | None = None,
    ) -> Version:
        """Bring in rows; of a key's old and new rows the greatest by ``order`` stays, and the newer
        one of equals (with ``first_wins``: the smallest, and the older one). ``keep`` drops rows for
        which it does not hold, of the buckets that are touched.

        A batch of a stream that is in already, or an earlier one, changes nothing; batches of a
        stream are numbered upwards.
        """
        staged = f"{self.path}/data/{uuid.uuid4().hex}"
        names = self.schema.names
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")
        done = self.latest()
        if stream is not None and done.batches.get(stream, -1) >= batch:
            return done
        own = changes.select(*names).withColumn(_BUCKET, bucket)
        self._reduced(own.withColumn(_NEW, F.lit(True)), order, first_wins).drop(_NEW).write.parquet(staged)
        new = self.spark.read.parquet(staged)
        touched = {str(r[0]) for r in new.select(_BUCKET).distinct().collect()}
        for _ in range(ATTEMPTS):
            done = self.latest()
            if stream is not None and done.batches.get(stream, -1) >= batch:
                return done
            folder = uuid.uuid4().hex
            old = self._rows(done, touched).withColumn(_NEW, F.lit(False))
            both = old.unionByName(new.withColumn(_NEW, F.lit(True)))
            merged = self._reduced(both, order, first_wins).drop(_NEW)
            if keep is not None:
                merged = merged.filter(F.coalesce(keep, F.lit(False)))
            merged.repartition(_BUCKET).write.partitionBy(_BUCKET).parquet(f"{self.path}/data/{folder}")
            there = self._folders(folder)
            parts = {k: v for k, v in done.parts.items() if k not in touched} | dict.fromkeys(there, folder)
            batches = done.batches | ({stream: batch} if stream is not None else {})
            version = Version(done.number + 1, parts, batches)
            if self._commit(version):
                return version
        raise RuntimeError(f"other writers were first {ATTEMPTS} times at {self.path}")

    def _reduced(self, rows: DataFrame, order: list[str], first_wins: bool) -> DataFrame:
        rank = F.struct(*order, _NEW)
        others = [c for c in rows.columns if c not in self.keys]
        pick = F.min_by if first_wins else F.max_by
        best = rows.groupBy(*self.keys).agg(pick(F.struct(*others), rank).alias("__row"))
        return best.select(*self.keys, *[F.col(f"__row.{c}").alias(c) for c in others])

    def _folders(self, folder: str) -> list[str]:
        found = self._files.listStatus(self._hadoop.Path(f"{self.path}/data/{folder}"))
        names = [f.getPath().getName() for f in found if f.isDirectory()]
        return [n.split("=", 1)[1] for n in names if n.startswith(f"{_BUCKET}=")]

    def _commit(self, version: Version) -> bool:
        """Whether the entry could be put in its place."""
        drafted = self._hadoop.Path(f"{self.path}/log/.{uuid.uuid4().hex}.draft")
        out = self._files.create(drafted, False)
        out.write(bytearray(json.dumps(version.__dict__, sort_keys=True).encode()))
        out.close()
        gateway = self.spark.sparkContext._gateway
        none = gateway.new_array(gateway.jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            self._context.rename(drafted, self._hadoop.Path(self._entry(version.number)), none)
        except Exception as error:
            if "FileAlreadyExists" not in str(error):
                raise
            self._files.delete(drafted, False)
            return False
        return True

    def vacuum(self, keep: int = 2) -> None:
        """Delete all versions but the last ``keep``, and the rows that none of those names. No
        writer may be at work, as the rows it has just written are named nowhere yet."""
        numbers = self.versions()
        last = numbers[-max(keep, 1) :]
        needed = {v for n in last for v in self.version(n).parts.values()}
        for number in numbers[: -len(last)]:
            self._files.delete(self._hadoop.Path(self._entry(number)), False)
        data = self._hadoop.Path(f"{self.path}/data")
        for f in self._files.listStatus(data) if self._files.exists(data) else []:
            if f.getPath().getName() not in needed:
                self._files.delete(f.getPath(), True)
