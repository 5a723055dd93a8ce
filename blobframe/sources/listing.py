"""Listing folders as a table, however many files there are.

The folders to be listed are rows. A round deals them out to tasks, each of which streams the
entries of its folders; the folders among them are the rows of the next round. So a tree is listed
in as many rounds as it is deep, by as many tasks as a level has folders, and no list of files passes
through the driver.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from datetime import UTC, datetime
from itertools import islice
from typing import NamedTuple

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blobframe.functions.naming import basename_col
from blobframe.session import measured, store_options
from blobframe.sources.store import UPLOAD_SUFFIX, Store, hadoop_path, inner_path

LISTING = "path string, modificationTime timestamp, length long"
ENTRY_ARROW = pa.schema(
    [
        ("path", pa.string()),
        ("modificationTime", pa.timestamp("us", "UTC")),
        ("length", pa.int64()),
        ("folder", pa.bool_()),
    ]
)
LISTING_BATCH = 10_000
#: Folders that one task lists, if there are more than the session has cores for.
TASK_FOLDERS = 16


class Entry(NamedTuple):
    name: str
    modified: datetime | None
    length: int
    folder: bool


def list_blobs(
    spark: SparkSession, path: str | list[str], glob: str | None = None, recursive: bool = False
) -> DataFrame:
    """``path, modificationTime, length`` of the files at or below ``path``, as a stored table.

    ``path`` may be a folder, a file or a pattern of either; a file that several of them lead to is
    listed as often. Files of zero bytes are listed, and so are names that begin with ``_`` or ``.``.
    Checksum files that Hadoop keeps beside a file, and uploads that are not complete, are not.
    Without ``recursive`` the files of the named folders alone are listed. ``glob`` is a pattern for
    the file's name. The driver resolves ``path``, tasks do the rest.
    """
    roots, files = [], []
    for one in [path] if isinstance(path, str) else path:
        target, system = hadoop_path(spark, one)
        for found in system.globStatus(target) or []:
            name = found.getPath().toString()
            if found.isDirectory():
                roots.append((name,))
            else:
                modified = datetime.fromtimestamp(found.getModificationTime() / 1000, UTC)
                files.append((name, modified, found.getLen()))

    listed = spark.createDataFrame(files, LISTING)
    folders, count, level = spark.createDataFrame(roots, "path string"), len(roots), 0
    while count:
        entries, found = measured(
            entries_of_folders(folders, count), f"level_{level}", folders=F.count_if("folder")
        )
        listed = listed.union(entries.where("not folder").drop("folder"))
        folders = entries.where("folder").select("path")
        count = found["folders"] if recursive else 0
        level += 1
    return named_like(listed, glob)


def named_like(listed: DataFrame, glob: str | None) -> DataFrame:
    """The files whose name, without folders, fits the pattern."""
    if glob is None:
        return listed
    jvm = listed.sparkSession._jvm
    pattern = jvm.org.apache.hadoop.fs.GlobPattern(glob).compiled().pattern()
    return listed.where(F.rlike(basename_col("path"), F.lit(f"^(?:{pattern})$")))


def entries_of_folders(folders: DataFrame, count: int) -> DataFrame:
    """One round: ``path, modificationTime, length, folder`` of what lies in the folders."""
    spark = folders.sparkSession
    options = store_options(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with Store(options) as store:
            for batch in batches:
                for folder in batch.column("path").to_pylist():
                    yield from batches_of_folder(store, folder)

    tasks = max(1, min(count, spark.sparkContext.defaultParallelism), -(-count // TASK_FOLDERS))
    return folders.repartition(tasks).mapInArrow(run, f"{LISTING}, folder boolean")


def batches_of_folder(store: Store, folder: str) -> Iterator[pa.RecordBatch]:
    system, base = store.system(folder), inner_path(folder).rstrip("/")
    entries = stream_of_entries(system, base)
    while part := list(islice(entries, LISTING_BATCH)):
        checksums = checksums_of_files(system, base, part)
        rows = [e for e in part if not e.name.endswith(UPLOAD_SUFFIX) and e.name not in checksums]
        yield pa.RecordBatch.from_pydict(
            {
                "path": [f"{folder.rstrip('/')}/{e.name}" for e in rows],
                "modificationTime": [e.modified for e in rows],
                "length": [e.length for e in rows],
                "folder": [e.folder for e in rows],
            },
            schema=ENTRY_ARROW,
        )


def stream_of_entries(system: pafs.FileSystem, base: str) -> Iterator[Entry]:
    """The entries of a folder; a local one is never held whole, other stores list it at once."""
    if isinstance(system, pafs.LocalFileSystem):
        with os.scandir(base or "/") as found:
            for item in found:
                try:
                    info = item.stat()
                except FileNotFoundError:  # deleted since, or a link to nothing
                    continue
                modified = datetime.fromtimestamp(info.st_mtime, UTC)
                yield Entry(item.name, modified, info.st_size, item.is_dir())
        return
    for info in system.get_file_info(pafs.FileSelector(base)):
        folder = info.type == pafs.FileType.Directory
        yield Entry(info.base_name, info.mtime, 0 if folder else info.size, folder)


def checksums_of_files(system: pafs.FileSystem, base: str, entries: list[Entry]) -> set[str]:
    """Names ``.NAME.crc`` of files that Hadoop keeps beside a file NAME."""
    likely = [e.name for e in entries if e.name.startswith(".") and e.name.endswith(".crc")]
    beside = system.get_file_info([f"{base}/{name[1:-4]}" for name in likely])
    return {name for name, info in zip(likely, beside) if info.type == pafs.FileType.File}
