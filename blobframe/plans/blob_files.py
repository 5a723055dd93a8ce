"""The way of a manifest to files: scan, resolve, and one file per row or archives of rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blobframe.operators.fetch import MAX_MEMBER_BYTES, NOT_FOUND, content_reader
from blobframe.plans.resolve import content_of, locate_blobs
from blobframe.session import materialize, store_options
from blobframe.sinks.files import (
    ARCHIVE_BYTES,
    ARCHIVE_MEMBERS,
    PACK_BYTES,
    export_blobs,
    in_lanes,
    last_of_each,
    refuse_duplicates,
    write_archives,
)
from blobframe.sources.manifest import read_manifest


def export_manifest(
    spark: SparkSession,
    manifest: DataFrame | str,
    archives: DataFrame | str | list[str],
    name_col: str,
    content_col: str,
    dir: str,
    match: str = "contains",
    sep: str = ",",
    default: bytes | None = NOT_FOUND,
    order_by: str | None = None,
    max_member_bytes: int = MAX_MEMBER_BYTES,
) -> DataFrame:
    """Write the blob of every manifest row to a file named by ``name_col``.

    With ``order_by`` the last row of a name counts. Otherwise two rows of one name are an error.
    Either shows before any content is read. Returns ``name, path, n_bytes``.
    """
    rows = manifest if isinstance(manifest, DataFrame) else read_manifest(spark, manifest, sep)
    located = locate_blobs(rows, archives, [content_col], match)
    if order_by is not None:
        located = materialize(last_of_each(located, name_col, order_by), "last")
    refuse_duplicates(located.select(F.col(name_col).alias("name")))
    resolved = content_of(located, [content_col], default, max_member_bytes)
    return export_blobs(resolved, name_col, content_col, dir)


def pack_manifest(
    spark: SparkSession,
    manifest: DataFrame | str,
    archives: DataFrame | str | list[str],
    name_col: str,
    content_col: str,
    dir: str,
    shard_col: str,
    match: str = "contains",
    sep: str = ",",
    default: bytes | None = NOT_FOUND,
    max_archive_bytes: int = ARCHIVE_BYTES,
    max_members: int = ARCHIVE_MEMBERS,
    max_member_bytes: int = MAX_MEMBER_BYTES,
    task_bytes: int = PACK_BYTES,
) -> DataFrame:
    """Pack the blob of every manifest row into archives, see :func:`blobframe.pack_blobs`.

    What is planned, dealt out and sorted are places, whose sizes are known; content first appears
    in the task that writes the archive. Returns ``archive, n_members, n_bytes``.
    """
    rows = manifest if isinstance(manifest, DataFrame) else read_manifest(spark, manifest, sep)
    place = f"{content_col}__at"
    located = locate_blobs(rows, archives, [content_col], match).select(
        F.col(shard_col).alias("shard"),
        F.col(name_col).alias("name"),
        F.coalesce(F.col(f"`{place}`.size"), F.lit(len(default or b""))).alias("size"),
        F.col(f"`{place}`").alias("content"),
    )
    dealt = in_lanes(located, task_bytes).withColumn("task", F.spark_partition_id())
    dealt = dealt.sortWithinPartitions("shard", "name")
    read = content_reader(["content"], default, max_member_bytes, store_options(spark))
    return write_archives(dealt, dir, max_archive_bytes, max_members, read)
