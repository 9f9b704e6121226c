"""Archive members as rows."""

from __future__ import annotations

import re
import tarfile
import zipfile
from collections.abc import Callable, Iterable, Iterator, Sequence

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F

from sheaf.sources.landing import (
    in_landing_window, is_package, list_packages, not_yet_landed,
)

MEMBER_SCHEMA = """
  package_path STRING, member_path STRING, content BINARY, error STRING, harvested_at TIMESTAMP
"""

_ARROW = pa.schema(
    [
        ("package_path", pa.string()),
        ("member_path", pa.string()),
        ("content", pa.binary()),
        ("error", pa.string()),
        ("harvested_at", pa.timestamp("us", tz="UTC")),
    ]
)
# A record batch is handed on once it holds this many bytes.
_BATCH_BYTES = 32 * 1024 * 1024
# A binary value of a batch holds no more.
_MOST_BYTES = 2**31 - 2**20


def _is_safe(name: str) -> bool:
    return not name.startswith("/") and ".." not in name.split("/")


def _members(name: str, stream: pa.NativeFile) -> Iterator[tuple[str, object]]:
    """Names and readers of the regular files in an archive."""
    if name.endswith(".tar"):
        with tarfile.open(fileobj=stream) as archive:
            for info in archive:
                if info.isfile():
                    yield info.name, info.size, lambda info=info: archive.extractfile(info).read()
    else:
        with zipfile.ZipFile(stream) as archive:
            for info in archive.infolist():
                if not info.is_dir():
                    yield info.filename, info.file_size, lambda info=info: archive.read(info)


def _rows(
    path: str, opened: Callable[[], pa.NativeFile], suffixes: Sequence[str]
) -> Iterator[tuple[str, str | None, bytes | None, str | None]]:
    try:
        with opened() as stream:
            for member, size, read in _members(path, stream):
                if suffixes and not member.endswith(tuple(suffixes)):
                    continue
                if not _is_safe(member):
                    yield path, member, None, "unsafe member name"
                    continue
                if size > _MOST_BYTES:
                    yield path, member, None, "member of 2 GB or more"
                    continue
                try:
                    yield path, member, read(), None
                except Exception as problem:
                    yield path, member, None, f"unreadable member: {problem}"
    except Exception as problem:
        yield path, None, None, f"unreadable package: {problem}"


def _file_system(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path as Spark writes it, and the path there."""
    scheme, found, rest = path.partition(":")
    if not found or scheme == "file" or "/" in scheme:
        return fs.LocalFileSystem(), re.sub("^/+", "/", rest) if scheme == "file" else path
    authority, _, inner = rest.removeprefix("//").partition("/")
    system, root = fs.FileSystem.from_uri(f"{scheme}://{authority}/")
    return system, f"{root.rstrip('/')}/{inner}"


def can_open(path: str) -> bool:
    """Whether tasks can open files there themselves; else Spark's reader has to hand them their content."""
    try:
        _file_system(path)
        return True
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError, ImportError):
        return False


def _unpacker(suffixes: Sequence[str], by_path: bool):
    def batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array(c, t) for c, t in zip(zip(*rows), _ARROW.types)]
        return pa.RecordBatch.from_arrays(columns, schema=_ARROW)

    def open_path(path: str) -> pa.NativeFile:
        system, inner = _file_system(path)
        return system.open_input_file(inner)

    def unpack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for packages in batches:
            for path, content, at in zip(*packages.columns):
                path = path.as_py()
                if by_path:
                    # Of an open archive only the members that are taken are held.
                    opened = lambda path=path: open_path(path)
                else:
                    # Archives are read where they lie in the batch, not copied.
                    opened = lambda content=content: pa.BufferReader(content.as_buffer())
                for row in _rows(path, opened, suffixes):
                    held.append((*row, at.as_py()))
                    size += len(row[2] or b"")
                    if size >= _BATCH_BYTES:
                        yield batch(held)
                        held, size = [], 0
        if held:
            yield batch(held)

    return unpack


def unpack(packages: DataFrame, suffixes: Sequence[str] = ()) -> DataFrame:
    """Members of each package, as ``package_path, member_path, content``.

    ``packages`` has ``path`` and perhaps ``harvested_at``; without ``content``
    the tasks open the paths themselves.  Only members with one of the
    suffixes are decompressed; nothing is written to disk.  Packages that
    cannot be read become one row with an ``error``.
    """
    known = "harvested_at" in packages.columns
    at = F.col("harvested_at") if known else F.lit(None).cast("timestamp").alias("harvested_at")
    by_path = "content" not in packages.columns
    content = F.lit(None).cast("binary").alias("content") if by_path else F.col("content")
    return packages.select("path", content, at).mapInArrow(_unpacker(suffixes, by_path), MEMBER_SCHEMA)


def read_packages(
    spark: SparkSession,
    path: str,
    landed: DataFrame | None = None,
    force: bool = False,
    from_date: str | None = None,
    until_date: str | None = None,
) -> DataFrame:
    """Archives to be unpacked, without those already landed or outside the window.

    What is new is settled on a table of names and times.  Its rows are dealt
    out by the bytes of the archives, and the tasks that get them open the
    paths; neither the paths nor any content goes through the driver, and no
    content through a shuffle.  In a store that only Spark can read, its reader
    hands on the content of the archives whose paths are left.
    """
    listing = in_landing_window(list_packages(spark, path), from_date, until_date)
    if landed is not None and not force:
        listing = not_yet_landed(listing, landed)
    if can_open(path):
        return _dealt(listing)
    content = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.{zip,tar}")
        .load(path)
        .withColumnRenamed("modificationTime", "harvested_at")
    )
    archives = in_landing_window(content.where(is_package(F.col("path"))), from_date, until_date)
    return archives if landed is None or force else not_yet_landed(archives, landed)


def _dealt(listing: DataFrame) -> DataFrame:
    """The listing in as many parts as its archives' bytes fill, so that few large ones share none."""
    size = _bytes(listing.sparkSession.conf.get("spark.sql.files.maxPartitionBytes"))
    total = listing.agg(F.sum("length")).first()[0] or 0
    tasks = max(1, -(-total // size), listing.sparkSession.sparkContext.defaultParallelism)
    return listing.repartition(int(tasks), "path")


def _bytes(setting: str) -> int:
    number, unit = re.fullmatch(r"(\d+)([a-z]*)", setting.strip().lower()).groups()
    return int(number) << {"": 0, "b": 0, "k": 10, "m": 20, "g": 30, "t": 40}[unit.removesuffix("b") or unit]


def documents(members: DataFrame) -> DataFrame:
    """Members as a document table with text payloads.

    What could not be read is kept without a payload and with the reason as
    ``landing_error``, and ends in the quarantine.
    """
    location = F.concat_ws("/", "package_path", "member_path")
    return members.select(
        "package_path",
        "member_path",
        location.alias("path"),
        location.alias("doc_id"),
        F.decode("content", "UTF-8").alias("payload"),
        F.col("error").alias("landing_error"),
        "harvested_at",
    )


def stage(documents: DataFrame, path: str) -> DataFrame:
    """Write documents that several parts of a plan read, and read them back.

    Without this every part would open and unpack the archives again.  The
    kinds are partitions: manifests and issues are found without reading
    articles.
    """
    kind = (
        F.when(F.contains("member_path", F.lit("dataset.xml")), "dataset")
        .when(F.contains("payload", F.lit("include-item>")), "issue")
        .otherwise("document")
    )
    documents.withColumn("kind", kind).write.mode("overwrite").partitionBy("kind").parquet(path)
    return documents.sparkSession.read.parquet(path)
