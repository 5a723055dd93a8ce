"""Blobs to files: one file per row, or many rows packed into ZIP archives.

Tasks write the files where the rows are. Only names, paths and sizes come back, as a stored table.
"""

from __future__ import annotations

import zipfile
from bisect import bisect_right
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from blobframe.session import materialize, measured, store_options
from blobframe.sources.packings import ARCHIVES, new_packing, publish
from blobframe.sources.store import Store, inner_path, qualify

# Fixed value: the earliest time stamp a ZIP entry can carry, so that equal rows give equal bytes.
ENTRY_TIME = (1980, 1, 1, 0, 0, 0)
ARCHIVE_BYTES = 1 << 30
WRITE_BUFFER = 1 << 20
# Until an archive is closed its task keeps some 400 bytes for each member.
ARCHIVE_MEMBERS = 100_000
# Of a batch, rows of about so many bytes at a time become Python objects.
ROWS_BYTES = 1 << 20

EXPORT_ARROW = pa.schema([("name", pa.string()), ("path", pa.string()), ("n_bytes", pa.int64())])
PACK_ARROW = pa.schema(
    [("archive", pa.string()), ("n_members", pa.int64()), ("n_bytes", pa.int64())]
    + [("length", pa.int64()), ("modificationTime", pa.timestamp("us", "UTC"))]
)
PACKED = "archive string, n_members long, n_bytes long, length long, modificationTime timestamp"
#: Content that one task packs, and rows of the table of sizes that one task sorts.
PACK_BYTES = 256 << 20
LANE_BYTES = 1 << 20
RANGE_ROWS = 1 << 20


def export_blobs(
    df: DataFrame,
    name_col: str,
    content_col: str,
    dir: str,
    on_duplicate: str = "error",
    order_by: str | None = None,
) -> DataFrame:
    """Write one file per row below ``dir``; returns ``name, path, n_bytes``.

    A name may hold folders but must not lead out of ``dir``. Two rows of one name are an error,
    noticed when the files are written; ``df`` is evaluated once. With ``on_duplicate="last"`` the
    one that is last by ``order_by`` is written; this looks at ``df`` twice, so remove duplicates
    before contents are attached where you can (:func:`blobframe.export_manifest` does).
    """
    spark = df.sparkSession
    if on_duplicate not in ("error", "last"):
        raise ValueError(f"on_duplicate must be 'error' or 'last', not {on_duplicate!r}")
    rows = df.select(F.col(name_col).alias("name"), F.col(content_col).alias("content"))
    if on_duplicate == "last":
        if order_by is None:
            raise ValueError("on_duplicate='last' needs order_by")
        rows = last_of_each(df, name_col, order_by).select(
            F.col(name_col).alias("name"), F.col(content_col).alias("content")
        )

    target, options = qualify(spark, dir), store_options(spark)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with Store(options) as store:
            for batch in batches:
                written = {"name": [], "path": [], "n_bytes": []}
                for name, content in zip(batch.column("name"), batch.column("content")):
                    name = name.as_py()
                    content = checked_content(name, content.as_py())
                    path = f"{target}/{checked_name(name)}"
                    write_whole(store, path, content)
                    written["name"].append(name)
                    written["path"].append(path)
                    written["n_bytes"].append(len(content))
                yield pa.RecordBatch.from_pydict(written, schema=EXPORT_ARROW)

    written = materialize(
        rows.mapInArrow(write, "name string, path string, n_bytes long"), "exported"
    )
    refuse_duplicates(written)
    return written


def last_of_each(df: DataFrame, name_col: str, order_by: str) -> DataFrame:
    """Rows of ``df`` that no other row of their name comes after.

    The rows meet the names that occur more than once, whose last positions were found from these
    two columns alone.
    """
    repeated = (
        df.groupBy(F.col(name_col).alias("name"))
        .agg(F.count("*").alias("copies"), F.max(order_by).alias("last"))
        .where("copies > 1")
        .select(F.col("name").alias("__name"), F.col("last").alias("__last"))
    )
    repeated = materialize(repeated, "repeated")
    undecided = repeated.where("__last is null").head(1)
    if undecided:
        raise ValueError(f"no row named {undecided[0]['__name']!r} has a value in {order_by}")
    return (
        df.join(repeated, F.col(name_col) == F.col("__name"), "left")
        .where(F.col("__last").isNull() | (F.col(order_by) == F.col("__last")))
        .select(*df.columns)
    )


def refuse_duplicates(names: DataFrame) -> None:
    twice = names.groupBy("name").count().where("count > 1").head(1)
    if twice:
        raise ValueError(f"{twice[0]['count']} rows are named {twice[0]['name']!r}")


def checked_name(name: str | None) -> str:
    if name is None or not {"", ".", ".."}.isdisjoint(name.split("/")):
        raise ValueError(f"{name!r} is no name for a file below the target folder")
    return name


def checked_content(name: str, content) -> bytes:
    if content is None:
        raise ValueError(f"{name!r} has no content")
    return content.encode("utf-8") if isinstance(content, str) else content


def write_whole(store: Store, path: str, content: bytes) -> None:
    upload = store.create(path)
    try:
        upload.stream.write(content)
    except BaseException:
        upload.abandon()
        raise
    upload.finish()


def pack_blobs(
    df: DataFrame,
    name_col: str,
    content_col: str,
    dir: str,
    shards: int | None = None,
    shard_col: str | Column | None = None,
    max_archive_bytes: int = ARCHIVE_BYTES,
    max_members: int = ARCHIVE_MEMBERS,
    size_col: str | None = None,
    task_bytes: int = PACK_BYTES,
) -> DataFrame:
    """Pack rows into ZIP archives below ``dir``; returns ``archive, n_members, n_bytes``.

    By default every partition packs its own rows and no content is shuffled. ``shards`` spreads
    the rows over that many partitions by name. With ``shard_col``, a string, an archive holds rows
    of one value only and is named ``part-<value>-…``; the rows are cut, in the order of (value,
    name), into lanes of about ``task_bytes`` (or ``shards`` lanes of equal bytes), so a value with
    many rows fills several archives in several tasks. The lanes are planned from names and sizes
    alone; the sizes are those of ``size_col``, or else measured, which reads the content once more.

    Members are in name order, and where ``shard_col`` is given the archives, by path, are in the
    order of (value, name). An archive that is full is followed by another. Two members of one name
    in an archive are an error.

    A packing is published when it is complete: from then on :func:`blobframe.list_archives` lists
    its archives for ``dir``, and those alone, whatever was packed there before.
    """
    shard = F.lit("all") if shard_col is None else shard_col
    size = F.octet_length(F.col(content_col)) if size_col is None else F.col(size_col)
    rows = df.select(
        (F.col(shard) if isinstance(shard, str) else shard).alias("shard"),
        F.col(name_col).alias("name"),
        size.cast("long").alias("size"),
        F.col(content_col).alias("content"),
    )
    if shard_col is not None:
        rows = in_lanes(rows, task_bytes, shards)
    elif shards is not None:
        rows = rows.repartition(shards, "name")
    rows = rows.withColumn("task", F.spark_partition_id()).sortWithinPartitions("shard", "name")
    return write_archives(rows, dir, max_archive_bytes, max_members)


def in_lanes(rows: DataFrame, task_bytes: int, lanes: int | None = None) -> DataFrame:
    """``rows`` in partitions that hold successive ranges of (shard, name) of about equal bytes.

    A lane has ``task_bytes``, or less where that keeps all cores busy with LANE_BYTES each at least.
    The ranges come from the table of shards, names and sizes; of it, the first name of every lane
    reaches the driver, one for ``task_bytes`` of content. Content is moved once.
    """
    narrow, seen = measured(
        rows.select("shard", "name", "size"), "sizes", rows=F.count("*"), bytes=F.sum("size")
    )
    total, ranges = seen["bytes"] or 0, max(1, -(-(seen["rows"] or 0) // RANGE_ROWS))
    cores = rows.sparkSession.sparkContext.defaultParallelism
    target = min(task_bytes, max(LANE_BYTES, -(-total // cores)))
    if lanes is not None:
        target = -(-total // lanes)
    target = max(1, target)
    cut = narrow.select("*", F.lit(0).alias("block"))
    if ranges > 1:
        cut = narrow.repartitionByRange(ranges, "shard", "name")
        cut = materialize(cut.select("*", F.spark_partition_id().alias("block")), "cut")
    order = Window.partitionBy("block").orderBy("shard", "name")
    start = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    placed = cut.select("*", start.alias("start"), F.lit(0).cast("long").alias("base"))
    if ranges > 1:
        before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
        bases = cut.groupBy("block").agg(F.sum("size").alias("bytes"))  # a row per RANGE_ROWS rows
        base = F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("base")
        placed = placed.drop("base").join(F.broadcast(bases.select("block", base)), "block")
    lane = F.floor((F.col("base") + F.col("start")) / target)
    firsts = placed.groupBy(lane.alias("lane")).agg(F.min(F.struct("shard", "name")).alias("first"))
    bounds = sorted(tuple(row.first) for row in firsts.select("first").collect())

    @F.pandas_udf("int")
    def lane_of(shard: pd.Series, name: pd.Series) -> pd.Series:
        return pd.Series([max(0, bisect_right(bounds, key) - 1) for key in zip(shard, name)])

    return rows.repartitionById(max(1, len(bounds)), lane_of("shard", "name"))


def write_archives(
    rows: DataFrame, dir: str, max_archive_bytes: int, max_members: int, read=None
) -> DataFrame:
    """Write sorted rows (shard, name, content, task) as a packing of ``dir`` and publish it.

    ``read`` turns the batches of rows into such that hold content, if they do not yet.
    """
    spark = rows.sparkSession
    packing, options = new_packing(spark, dir), store_options(spark)
    target = f"{packing}/{ARCHIVES}"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with Store(options) as store, ArchiveWriter(store, target) as archives:
            for batch in batches if read is None else read(batches):
                for row in rows_of(batch):
                    full = archives.size >= max_archive_bytes or archives.members >= max_members
                    if archives.shard != row["shard"] or full:
                        yield from archives.close()
                        archives.begin(row["shard"], row["task"])
                    archives.add(row["name"], checked_content(row["name"], row["content"]))
                batch = row = None  # free before the next one is read
            yield from archives.close()

    written = materialize(rows.mapInArrow(write, PACKED), "packed")
    publish(spark, dir, packing, written)
    return written.select("archive", "n_members", "n_bytes")


def rows_of(batch: pa.RecordBatch) -> Iterator[dict]:
    """The rows of a batch as dicts, a few at a time."""
    step = max(1, ROWS_BYTES * batch.num_rows // max(1, batch.nbytes))
    for at in range(0, batch.num_rows, step):
        yield from batch.slice(at, step).to_pylist()


class ArchiveWriter:
    """Writes the archives of one task, one at a time and member by member."""

    def __init__(self, store: Store, target: str):
        self.store = store
        self.target = target
        self.shard = None
        self.members = self.size = self.number = 0
        self.upload = self.archive = self.last = None

    def __enter__(self):
        return self

    def __exit__(self, *exc):
        if self.upload is not None:
            self.upload.abandon()

    def begin(self, shard: str, task: int) -> None:
        self.number = self.number + 1 if shard == self.shard else 0
        self.shard = shard
        # Spark's listings pass over names that begin with ``_`` or ``.``; these never do.
        name = "/".join(f"part-{piece}" for piece in checked_name(shard).split("/"))
        # Attempts of one task never write to one name; the published list names those that count.
        attempt = TaskContext.get().attemptNumber() if TaskContext.get() else 0
        again = f".retry{attempt}" if attempt else ""
        self.path = f"{self.target}/{name}-{task:06d}-{self.number:06d}{again}.zip"
        self.upload = self.store.create(self.path, WRITE_BUFFER)
        self.archive = zipfile.ZipFile(self.upload.stream, "w", zipfile.ZIP_DEFLATED)
        self.members = self.size = 0
        self.last = None

    def add(self, name: str, content: bytes) -> None:
        if name == self.last:
            raise ValueError(f"several rows for one archive are named {name!r}")
        self.last = name
        entry = zipfile.ZipInfo(checked_name(name), ENTRY_TIME)
        entry.compress_type = zipfile.ZIP_DEFLATED
        self.archive.writestr(entry, content)
        self.members += 1
        self.size += len(content)

    def close(self) -> Iterator[pa.RecordBatch]:
        if self.upload is None:
            return
        self.archive.close()
        self.upload.finish()
        self.upload = self.archive = None
        file = self.store.system(self.path).get_file_info(inner_path(self.path))
        row = (self.path, self.members, self.size, file.size, file.mtime)
        yield pa.RecordBatch.from_arrays(
            [pa.array([x], f.type) for x, f in zip(row, PACK_ARROW, strict=True)], schema=PACK_ARROW
        )
