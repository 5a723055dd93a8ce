"""ZIP archives as tables: the files, their index (no content), and their members."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blobframe.session import materialize, measured, store_options
from blobframe.sources.listing import list_blobs, named_like
from blobframe.sources.packings import current_packing
from blobframe.sources.store import Store, exists, qualify
from blobframe.sources.zipformat import directory

INDEX_SCHEMA = T.StructType(
    [
        T.StructField("archive", T.StringType()),
        T.StructField("offset", T.LongType()),
        T.StructField("member", T.StringType()),
        T.StructField("size", T.LongType()),
        T.StructField("packed", T.LongType()),
        T.StructField("head", T.IntegerType()),
        T.StructField("method", T.IntegerType()),
        T.StructField("crc", T.LongType()),
        T.StructField("flags", T.IntegerType()),
    ]
)
INDEX_ARROW = pa.schema(
    [
        ("archive", pa.string()),
        ("offset", pa.int64()),
        ("member", pa.string()),
        ("size", pa.int64()),
        ("packed", pa.int64()),
        ("head", pa.int32()),
        ("method", pa.int32()),
        ("crc", pa.int64()),
        ("flags", pa.int32()),
    ]
)
# What a task needs to read a member; archive and offset first, so that the order of two such
# structs is the order in which a reader of the archives would come across the members.
PLACE_FIELDS = ["archive", "offset", "head", "packed", "size", "method", "crc", "flags"]

INDEX_BATCH = 20_000
TASK_ARCHIVES = 64


def list_archives(
    spark: SparkSession, path: str | list[str], glob: str | None = None, recursive: bool = False
) -> DataFrame:
    """One row per archive file, whatever its name: ``path, length, modificationTime``.

    Nothing is read from the files. A file of zero bytes is no archive. Of a folder that archives
    were packed into, the archives of its last packing are listed, and no others.
    """
    listed = []
    for one in [path] if isinstance(path, str) else path:
        packing = current_packing(spark, one)
        if packing is None:
            listed.append(list_blobs(spark, one, glob, recursive).where("length > 0"))
        else:
            listed.append(named_like(packing, glob))
    columns = ["path", "length", "modificationTime"]
    return reduce(DataFrame.union, (files.select(*columns) for files in listed))


def archive_index(archives: DataFrame) -> DataFrame:
    """One row per archive member, without content.

    ``archive, offset, member, size`` describe the member, the other columns say how to read it.
    ``offset`` is the position of the member in its archive, so it is unique and ordering by it is
    stream order. Folder entries are left out. A task reads only the directory at the end of each
    archive, as a stream.
    """
    spark = archives.sparkSession
    options = store_options(spark)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with Store(options) as store:
            for batch in batches:
                for path in batch.column("path").to_pylist():
                    rows = []
                    for entry in directory(store.open(path), path):
                        if entry.member.endswith("/"):
                            continue
                        rows.append(entry)
                        if len(rows) == INDEX_BATCH:
                            yield index_batch(path, rows)
                            rows = []
                    if rows:
                        yield index_batch(path, rows)

    # Paths are dealt out by their number, as nothing is read here of what the archives hold.
    archives, found = measured(archives.select("path"), "archives", count=F.count("*"))
    count = found["count"] or 0
    tasks = max(1, min(count, spark.sparkContext.defaultParallelism), -(-count // TASK_ARCHIVES))
    dealt = archives.repartition(tasks) if tasks > 1 else archives.coalesce(1)
    return dealt.mapInArrow(scan, INDEX_SCHEMA)


def index_batch(path: str, rows: list) -> pa.RecordBatch:
    columns = {name: [getattr(row, name) for row in rows] for name in rows[0]._fields}
    columns["archive"] = [path] * len(rows)
    return pa.RecordBatch.from_pydict(columns, schema=INDEX_ARROW)


def refresh_index(
    spark: SparkSession,
    path: str | list[str],
    store: str,
    glob: str | None = None,
    recursive: bool = False,
) -> DataFrame:
    """The index of the archives at ``path``, of which only new and changed ones are read.

    ``store`` is a folder that keeps what earlier calls have read. An archive is known by its path,
    length and modification time; one that has gone, or has changed, no longer counts. Members are
    appended first and the archives they belong to afterwards, under the number of the run, so what
    a failed run has left behind is never looked at. Runs on one store must follow each other.
    """
    members_at, archives_at = f"{store}/members", f"{store}/archives"
    listed = materialize(list_archives(spark, path, glob, recursive), "listed")
    version = ["path", "length", "modificationTime"]

    def known() -> DataFrame:
        if not exists(spark, qualify(spark, archives_at)):
            return spark.createDataFrame([], listed.schema.add("run", "string"))
        return spark.read.parquet(archives_at)

    new = listed.join(known(), version, "left_anti")
    new = materialize(new.dropDuplicates(version), "new")
    if not new.isEmpty():
        run = F.lit(uuid.uuid4().hex).alias("run")
        archive_index(new).select("*", run).write.mode("append").parquet(members_at)
        new.select(*version, run).write.mode("append").parquet(archives_at)
    elif not exists(spark, qualify(spark, members_at)):
        return spark.createDataFrame([], INDEX_SCHEMA)
    current = known().join(listed.dropDuplicates(version), version, "left_semi")
    current = materialize(current.select(F.col("path").alias("archive"), "run"), "current")
    members = spark.read.parquet(members_at)
    return members.join(current, ["archive", "run"], "left_semi").select(*INDEX_SCHEMA.names)
