"""The whole way of a manifest: scan, resolve, append to a table, read the table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from blobframe.operators.fetch import MAX_MEMBER_BYTES, NOT_FOUND, TASK_BYTES
from blobframe.plans.resolve import resolve_blobs
from blobframe.session import release_scratch
from blobframe.sinks.tables import append_partitioned
from blobframe.sources.manifest import read_manifest


def load_blob_table(
    spark: SparkSession,
    manifest: str,
    archives: DataFrame | str | list[str],
    columns: list[str],
    table: str,
    keys: list[str],
    path: str,
    match: str = "contains",
    sep: str = ",",
    default: bytes | None = NOT_FOUND,
    status_col: str | None = None,
    max_member_bytes: int = MAX_MEMBER_BYTES,
    task_bytes: int = TASK_BYTES,
) -> DataFrame:
    """Resolve the manifest file and append the result to ``table``; returns the table.

    The rows of a partition are brought together while they are places, so it gets about one file
    for ``task_bytes`` of content, and content is neither shuffled nor sorted for the write.
    """
    with release_scratch(spark):
        rows = read_manifest(spark, manifest, sep)
        resolved = resolve_blobs(
            rows, archives, columns, match, default, status_col, max_member_bytes,
            task_bytes=task_bytes, gather_by=keys,
        )
        return append_partitioned(resolved, table, keys, path, gather=False)
