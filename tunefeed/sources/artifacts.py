"""Listing of the files a run left."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tunefeed.session import shared_path, ship_package

# A file system, and the path in it, of a full path.
Opener = Callable[[str], tuple]

_PIECE = 8 << 20
# Schemes under which Spark knows a store by another name than Arrow does.
_SCHEMES = {"s3a": "s3", "s3n": "s3", "s3": "s3", "gs": "gs", "hdfs": "hdfs", "viewfs": "viewfs", "abfs": "abfs", "abfss": "abfss"}


# File systems that this process has opened, by scheme and authority, and what names begin with there.
_opened: dict[tuple[str, str], tuple] = {}


def open_by_scheme(path: str) -> tuple:
    """Arrow's file system for a path, by its scheme; none is a local path. A store is opened
    once per process, not once per file."""
    from urllib.parse import quote

    from pyarrow import fs

    scheme, name = _scheme(path)
    if scheme in ("", "file"):
        return fs.LocalFileSystem(), "/" + name.lstrip("/")
    authority, rest = re.match(r"(//[^/]*)?/*(.*)", name, re.DOTALL).groups()
    key = (_SCHEMES[scheme], authority or "")
    if key not in _opened:
        system, found = fs.FileSystem.from_uri(quote(f"{key[0]}:{name}", safe=":/@=+"))
        _opened[key] = system, found[: len(found) - len(rest)].rstrip("/")
    system, begin = _opened[key]
    return system, f"{begin}/{rest}".rstrip("/") or "/"


def _scheme(path: str) -> tuple[str, str]:
    found = re.match(r"([A-Za-z][\w+.-]*):(.*)", path, re.DOTALL)
    return (found[1].lower(), found[2]) if found else ("", path)


def artifact_manifest(
    spark: SparkSession,
    path: str,
    recursive: bool = True,
    with_hash: bool = False,
    opener: Opener | None = None,
) -> DataFrame:
    """``path``, ``length``, ``modified`` (and ``sha256``) of the files in a folder.

    Flat: regular files of the folder itself. Recursive: the whole tree. All names
    are listed, those with a leading ``_`` or ``.`` too. Folders are listed by tasks,
    one level of the tree after the other; files are hashed by tasks, in pieces, all
    in the same way. ``opener`` serves stores that Arrow does not know by their scheme.
    """
    scheme = _scheme(path)[0]
    if opener is None and scheme not in ("", "file", *_SCHEMES):
        raise ValueError(f"no file system is known for {scheme}: paths; give an opener")
    opener = opener or open_by_scheme
    ship_package(spark)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    base = shared_path(spark, "listing")
    folders = spark.range(1).select(F.lit(path.rstrip("/") or "/").alias("path"))
    levels = 0
    while True:
        schema = "path string, length long, modified timestamp, folder boolean"
        listed = folders.repartition(tasks, "path").mapInPandas(_lister(opener), schema)
        listed.write.parquet(f"{base}/{levels}")
        folders = spark.read.parquet(f"{base}/{levels}").filter("folder").select("path")
        levels += 1
        if not recursive or folders.isEmpty():
            break
    every = spark.read.parquet(*(f"{base}/{i}" for i in range(levels)))
    files = every.filter("NOT folder").drop("folder")
    if not with_hash:
        return files
    schema = "path string, length long, modified timestamp, sha256 string"
    return files.repartition(tasks, "path").mapInPandas(_hasher(opener), schema)


def _lister(opener: Opener) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        for batch in batches:
            for folder in batch["path"]:
                system, name = opener(folder)
                found = [
                    (f"{folder.rstrip('/')}/{x.base_name}", x.size, x.mtime, x.type == fs.FileType.Directory)
                    for x in system.get_file_info(fs.FileSelector(name))
                    if x.type in (fs.FileType.Directory, fs.FileType.File)
                ]
                rows = pd.DataFrame(found, columns=["path", "length", "modified", "folder"])
                rows["modified"] = pd.to_datetime(rows["modified"], utc=True)
                yield rows.astype({"length": "Int64", "folder": "bool"})

    return run


def _hasher(opener: Opener) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def sha256(path: str) -> str:
        system, name = opener(path)
        digest = hashlib.sha256()
        with system.open_input_stream(name) as stream:
            while data := stream.read(_PIECE):
                digest.update(data)
        return digest.hexdigest()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(sha256=[sha256(p) for p in batch["path"]])

    return run


# Pieces a digest is cut into; sums of pieces of 60 bits stay exact in 38 digits.
_PIECES, _HEX = 4, 15


def tree_digest(manifest: DataFrame, root: str) -> DataFrame:
    """The digests of a tree of files and folders, from a manifest with ``sha256``.

    ``name`` (path below ``root``; the root is ``""``), ``parent``, ``depth``, ``folder`` and ``digest``.
    A file's digest is its content's. A folder's is made of its entries' names, kinds and digests, so two
    folders have equal digests if and only if (but for chance) all that is below them is equal.
    Digests are built bottom up, a level of the tree at a time. Entries are added up, not
    listed: each gives a hash, whose pieces are summed, so a folder of any size is summed on the map side.
    """
    path = F.regexp_replace("path", r"^[A-Za-z][\w+.-]*:(//[^/]*)?(?=/)", "")
    base = re.sub(r"^[A-Za-z][\w+.-]*:(//[^/]*)?(?=/)", "", root.rstrip("/"))
    start = len(base) + 2
    files = manifest.select(F.substring(path, F.lit(start), F.length("path")).alias("name"), F.col("sha256").alias("digest"))
    level = files.withColumn("depth", F.size(F.split("name", "/"))).withColumn("folder", F.lit(False))
    stored = shared_path(manifest.sparkSession, "tree")
    level = _with_parent(level)
    level.write.partitionBy("depth").parquet(f"{stored}/files")
    read = manifest.sparkSession.read.schema(level.schema)
    every = read.parquet(f"{stored}/files")
    deepest = every.agg(F.max("depth")).first()[0] or 0
    folders: list[str] = []
    for depth in range(deepest, 0, -1):
        entries = every.filter(F.col("depth") == depth)
        if folders:
            entries = entries.unionByName(read.parquet(folders[-1]))
        made = entries.groupBy("parent").agg(*_sums()).select(
            F.col("parent").alias("name"), _digest().alias("digest"), F.lit(True).alias("folder"), F.lit(depth - 1).alias("depth")
        )
        folders.append(f"{stored}/folders-{depth - 1}")
        _with_parent(made).write.parquet(folders[-1])
    out = every
    for folder in folders:
        out = out.unionByName(read.parquet(folder))
    return out.select("name", "parent", F.col("depth").cast("int").alias("depth"), "folder", "digest")


def _with_parent(rows: DataFrame) -> DataFrame:
    # The parent of the root is NULL; of its entries, "".
    own = F.when(F.col("name").contains("/"), F.expr("left(name, length(name) - length(substring_index(name, '/', -1)) - 1)"))
    parent = F.when(F.col("name") == "", F.lit(None)).otherwise(F.coalesce(own, F.lit("")))
    return rows.withColumn("parent", parent)


def _sums() -> list:
    own = F.substring_index("name", "/", -1)
    entry = F.sha2(F.concat_ws("\x00", own, F.col("folder").cast("string"), F.col("digest")), 256)
    pieces = [F.conv(F.substring(entry, 1 + _HEX * i, _HEX), 16, 10).cast("decimal(20,0)") for i in range(_PIECES)]
    return [F.count(F.lit(1)).alias("n"), *[F.sum(p).alias(f"s{i}") for i, p in enumerate(pieces)]]


def _digest():
    parts = [F.col(c).cast("string") for c in ("n", *[f"s{i}" for i in range(_PIECES)])]
    return F.sha2(F.concat_ws(",", *parts), 256)


def artifact_diff(before: DataFrame, after: DataFrame) -> DataFrame:
    """``name`` and ``change`` (``added``, ``removed``, ``changed``) of the files that two trees differ in.

    From the root down, only folders whose digests differ are looked into: equal subtrees are
    passed over, however large. A name that is a file in one tree and a folder in the other is
    removed (with all below) and added.
    """
    spark = before.sparkSession
    path = shared_path(spark, "diff")
    sides = [t.select("parent", "name", "depth", "folder", "digest") for t in (before, after)]
    out, depth, kind = None, 0, "name string, change string"
    # Folders to look into, and whether each side has them.
    roots = spark.createDataFrame([("",)], "at string")
    while not roots.isEmpty():
        depth += 1
        inside = [
            t.filter(F.col("depth") == depth).join(roots, F.col("parent") == F.col("at"), "left_semi").select(
                "name", F.struct("folder", "digest").alias(side)
            )
            for t, side in zip(sides, "ab")
        ]
        pairs = inside[0].join(inside[1], "name", "full").filter("NOT (a <=> b)")
        pairs.write.parquet(f"{path}/{depth}")
        pairs = spark.read.parquet(f"{path}/{depth}")
        file = {side: F.col(side).isNotNull() & ~F.col(f"{side}.folder") for side in "ab"}
        change = F.when(file["a"] & file["b"], F.array(F.lit("changed"))).otherwise(
            F.array_compact(F.array(F.when(file["a"], F.lit("removed")), F.when(file["b"], F.lit("added"))))
        )
        found = pairs.select("name", F.explode(change).alias("change"))
        out = found if out is None else out.unionAll(found)
        folder = F.coalesce(F.col("a.folder"), F.lit(False)) | F.coalesce(F.col("b.folder"), F.lit(False))
        roots = pairs.filter(folder).select(F.col("name").alias("at"))
    return out if out is not None else spark.createDataFrame([], kind)
