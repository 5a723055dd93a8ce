"""Resolving the blob paths of a manifest against the members of ZIP archives."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blobframe.functions.naming import basename_col
from blobframe.functions.schema import quoted
from blobframe.operators.fetch import (
    MAX_MEMBER_BYTES,
    NOT_FOUND,
    TASK_BYTES,
    attach_content,
    place_struct,
)
from blobframe.operators.match import BROADCAST_BYTES, first_match
from blobframe.session import materialize
from blobframe.sources.archive import INDEX_SCHEMA, archive_index, list_archives

FOUND, MISSING, NULL_PATH = "found", "missing", "null_path"


def index_of(spark: SparkSession, archives: DataFrame | str | list[str]) -> DataFrame:
    """The index of ``archives``: paths, a table of files with a ``path`` column, or an index.

    An index is taken as it is, so it should be a stored table; it is otherwise built and stored.
    """
    if not isinstance(archives, DataFrame):
        archives = list_archives(spark, archives)
    if set(INDEX_SCHEMA.names) <= set(archives.columns):
        return archives
    return materialize(archive_index(archives), "index")


def locate_blobs(
    manifest: DataFrame,
    archives: DataFrame | str | list[str],
    columns: list[str],
    match: str = "contains",
    status_col: str | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """``manifest`` with a column ``<column>__at`` per blob column: where its member lies, or NULL.

    No content is read. The result is stored, so it can be filtered, joined and counted at will,
    and turned into content late by :func:`read_located`.
    """
    spark = manifest.sparkSession
    for column in columns:
        if not isinstance(manifest.schema[column].dataType, T.StringType):
            raise TypeError(f"{column} must hold paths, but has {manifest.schema[column].dataType}")

    # A file name has no slash, so a member in a folder of its archive can never match.
    index = index_of(spark, archives).where(~F.contains("member", F.lit("/")))
    paths = [manifest.select(basename_col(column).alias("fn")) for column in columns]
    names = reduce(DataFrame.union, paths).where(F.col("fn").isNotNull()).distinct()
    # Stored, so that the planner knows its size before it decides how the rows meet it.
    places = materialize(first_match(names, index, match, broadcast_bytes), "places")

    located = with_places(manifest, places, columns)
    statuses = {
        status_name(status_col, column, columns): (
            F.when(F.col(column).isNull(), NULL_PATH)
            .when(F.col(f"{column}__at").isNull(), MISSING)
            .otherwise(FOUND)
        )
        for column in columns
        if status_col is not None
    }
    return materialize(located.withColumns(statuses), "located")


def with_places(manifest: DataFrame, places: DataFrame, columns: list[str]) -> DataFrame:
    """The manifest's rows with the places of their file names, where there are such.

    A name has one place, so a partition of rows that one hot name fills can be split at will, as
    adaptive execution does.
    """
    for number, column in enumerate(columns):
        key = f"__fn{number}"
        side = places.select(F.col("fn").alias(key), F.col("place").alias(f"{column}__at"))
        manifest = manifest.withColumn(key, basename_col(manifest[column]))
        manifest = manifest.join(side, key, "left").drop(key)
    return manifest


def status_name(status_col: str, column: str, columns: list[str]) -> str:
    return status_col if len(columns) == 1 else f"{status_col}_{column}"


def read_located(
    located: DataFrame,
    columns: list[str],
    default: bytes | None = NOT_FOUND,
    max_member_bytes: int = MAX_MEMBER_BYTES,
) -> DataFrame:
    """The result of :func:`locate_blobs` with content in place of the paths in ``columns``.

    ``located`` may have been filtered or joined since; it is stored again before it is read.
    """
    stored = materialize(located, "relocated")
    return content_of(stored, columns, default, max_member_bytes)


def content_of(
    located: DataFrame,
    columns: list[str],
    default: bytes | None,
    max_member_bytes: int,
    task_bytes: int = TASK_BYTES,
    gather_by: list[str] | None = None,
) -> DataFrame:
    places = {f"{column}__at" for column in columns}
    kept = [
        F.col(quoted(f"{name}__at")).alias(name) if name in columns else F.col(quoted(name))
        for name in located.columns
        if name not in places
    ]
    placed = located.select(*kept)
    return attach_content(
        placed, columns, default, max_member_bytes, task_bytes, gather_by=gather_by
    )


def resolve_blobs(
    manifest: DataFrame,
    archives: DataFrame | str | list[str],
    columns: list[str],
    match: str = "contains",
    default: bytes | None = NOT_FOUND,
    status_col: str | None = None,
    max_member_bytes: int = MAX_MEMBER_BYTES,
    broadcast_bytes: int = BROADCAST_BYTES,
    task_bytes: int = TASK_BYTES,
    gather_by: list[str] | None = None,
) -> DataFrame:
    """``manifest`` with the paths in ``columns`` replaced by the bytes of the archive members.

    ``match="contains"`` takes the first member, in the order of archives and of members in them,
    whose name occurs in the path's file name; ``match="exact"`` the first of just that name.
    Where nothing matches, the bytes are ``default``. ``status_col`` adds ``found``, ``missing`` or
    ``null_path`` per row (``<status_col>_<column>`` each, if there are several columns).

    The places are found at once, by jobs over names only; content is read when the result is. Sides
    of the match up to ``broadcast_bytes`` are broadcast; a task puts out about ``task_bytes``.
    Rows that are equal in the columns ``gather_by`` come together, for a partitioned write.
    """
    columns = [name for name in manifest.columns if name in columns]
    if not columns:
        return manifest
    located = locate_blobs(manifest, archives, columns, match, status_col, broadcast_bytes)
    return content_of(located, columns, default, max_member_bytes, task_bytes, gather_by)


def archive_members(
    spark: SparkSession,
    archives: DataFrame | str | list[str],
    max_member_bytes: int = MAX_MEMBER_BYTES,
) -> DataFrame:
    """Every member with its content: ``archive, offset, member, size, content``."""
    index = index_of(spark, archives)
    if index is archives:
        index = materialize(index, "index")
    placed = index.select("archive", "offset", "member", "size", place_struct().alias("content"))
    return attach_content(placed, ["content"], None, max_member_bytes)


def fetch_members(
    spark: SparkSession,
    archives: DataFrame | str | list[str],
    wanted: DataFrame,
    max_member_bytes: int = MAX_MEMBER_BYTES,
) -> DataFrame:
    """``archive, offset, member, size, content`` of the members at ``wanted``'s (archive, offset)."""
    index = index_of(spark, archives)
    keys = wanted.select("archive", "offset")
    picked = index.join(keys, ["archive", "offset"], "left_semi")
    return archive_members(spark, picked, max_member_bytes)


def lookup_members(
    names: DataFrame,
    archives: DataFrame | str | list[str],
    name_col: str = "member",
    max_member_bytes: int = MAX_MEMBER_BYTES,
) -> DataFrame:
    """``member, content`` for each distinct name that is some member's full name.

    If several members bear the name, the first in (archive, offset) order counts.
    """
    index = index_of(names.sparkSession, archives)
    asked = names.select(F.col(name_col).alias("fn")).where(F.col("fn").isNotNull()).distinct()
    places = first_match(asked, index, "exact").withColumnsRenamed(
        {"fn": "member", "place": "content"}
    )
    return attach_content(materialize(places, "places"), ["content"], None, max_member_bytes)
