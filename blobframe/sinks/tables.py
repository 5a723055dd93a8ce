"""Partitioned Parquet tables in Spark's catalog, with their data at a given location."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blobframe.functions.schema import catalog_type, quoted, split_schema
from blobframe.sources.store import exists, qualify

log = logging.getLogger(__name__)

#: Partitions that a task writes at once, beyond which Spark sorts its rows by partition.
PARTITION_WRITERS = 64


def quoted_table(name: str) -> str:
    return ".".join(quoted(part) for part in name.split("."))


def text_literal(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        value = str(value).lower()
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def describe_table(spark: SparkSession, name: str) -> dict:
    """``location``, ``external`` and the column lists ``data`` and ``keys`` of a table."""
    keys = {c.name for c in spark.catalog.listColumns(name) if c.isPartition}
    columns = [(f.name, catalog_type(f)) for f in spark.table(name).schema.fields]
    rows = spark.sql(f"DESCRIBE EXTENDED {quoted_table(name)}").collect()
    details = {row.col_name: row.data_type for row in rows}
    return {
        "location": details.get("Location"),
        "external": details.get("Type") == "EXTERNAL",
        "data": [column for column in columns if column[0] not in keys],
        "keys": [column for column in columns if column[0] in keys],
    }


def ensure_table(
    spark: SparkSession,
    name: str,
    schema: T.StructType,
    keys: list[str],
    path: str,
    strict_types: bool = False,
) -> None:
    """Make ``name`` an external Parquet table of this schema at ``path``, partitioned by ``keys``.

    A table that lacks some columns gets them; older files read NULL there. Any other difference
    replaces the definition (the data stays) and registers the partitions found at ``path``; the new
    definition is made under another name first, so one that the catalog refuses changes nothing.
    """
    change, data, by = needed_change(spark, name, schema, keys, path, strict_types)
    location = qualify(spark, path)
    if change != "create":
        log.info("%s already exists", name)
    if change == "add":
        added = [column for column in data if column not in describe_table(spark, name)["data"]]
        spark.sql(f"ALTER TABLE {quoted_table(name)} ADD COLUMNS ({column_list(added)})")
    if change in ("create", "replace"):
        with new_definition(spark, name, data, by, location, change == "replace"):
            pass
    if change == "replace" and keys and exists(spark, location):
        add_partitions(spark, name)


@contextmanager
def new_definition(
    spark: SparkSession, name: str, data, by, location: str, replace: bool
) -> Iterator[None]:
    """Define the table under a name of its own, and rename it to ``name`` at the end of the block.

    What the catalog does not take shows before the block begins; if the block fails, or the table
    cannot be renamed, nothing is left of the definition and an old one stays.
    """
    shadow = f"{name}_{uuid.uuid4().hex}"
    create_table(spark, shadow, data, by, location)
    try:
        yield
        if replace:
            spark.sql(f"DROP TABLE {quoted_table(name)}")
        spark.sql(f"ALTER TABLE {quoted_table(shadow)} RENAME TO {quoted_table(name)}")
    except BaseException:
        spark.sql(f"DROP TABLE IF EXISTS {quoted_table(shadow)}")
        raise


def needed_change(
    spark: SparkSession, name: str, schema: T.StructType, keys: list[str], path: str, strict: bool
) -> tuple[str, list[tuple[str, str]], list[tuple[str, str]]]:
    """``create``, ``none``, ``add`` or ``replace``, and the data and partition columns wanted."""
    data, by = (
        [(field.name, catalog_type(field, strict)) for field in fields]
        for fields in split_schema(schema, keys)
    )
    if not table_exists(spark, name):
        return "create", data, by
    current = describe_table(spark, name)
    placed = current["location"] is not None and same_place(spark, current["location"], path)
    if placed and current["keys"] == by:
        if set(current["data"]) == set(data):
            return "none", data, by
        if set(current["data"]) < set(data):
            return "add", data, by
    if not current["external"]:
        raise ValueError(f"{name} is not external; replacing it would delete its data")
    return "replace", data, by


def same_place(spark: SparkSession, one: str, other: str) -> bool:
    return qualify(spark, one).rstrip("/") == qualify(spark, other).rstrip("/")


def column_list(columns: list[tuple[str, str]]) -> str:
    return ", ".join(f"{quoted(name)} {kind}" for name, kind in columns)


def create_table(spark: SparkSession, name: str, data, keys, location: str) -> None:
    by = f"PARTITIONED BY ({', '.join(quoted(key) for key, _ in keys)}) " if keys else ""
    spark.sql(
        f"CREATE TABLE {quoted_table(name)} ({column_list(data + keys)}) USING parquet "
        f"{by}LOCATION {text_literal(location)}"
    )


def append_files(df: DataFrame, keys: list[str], path: str, gather: bool | None = None) -> None:
    """Append ``df`` to the partitioned Parquet folder at ``path``; no catalog is touched.

    ``gather`` brings the rows of a partition together first, in tasks of like size, so that it gets
    few files; by default this is done unless there are binary columns, as content is not shuffled.
    Rows are not sorted for writing unless a task has very many partitions.
    """
    with partition_writers(df.sparkSession):
        gathered(df, keys, gather).write.partitionBy(*keys).mode("append").parquet(path)


def gathered(df: DataFrame, keys: list[str], gather: bool | None) -> DataFrame:
    if gather is None:
        gather = not any(isinstance(f.dataType, T.BinaryType) for f in df.schema.fields)
    if not gather or not keys:
        return df
    return df.hint("rebalance", *(F.col(quoted(key)) for key in keys))


@contextmanager
def partition_writers(spark: SparkSession, count: int = PARTITION_WRITERS) -> Iterator[None]:
    """Let a task have the files of several partitions open, in place of sorting its rows."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name, None)
    spark.conf.set(name, str(count))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def append_partitioned(
    df: DataFrame,
    table: str,
    keys: list[str],
    path: str,
    strict_types: bool = False,
    gather: bool | None = None,
) -> DataFrame:
    """Append ``df`` at ``path``, see that ``table`` describes it, and register its partitions.

    A new (or replaced) definition is tried before anything is written, and takes the table's name
    after the data, so whatever fails leaves the catalog as it was, and a definition that fails
    leaves no data; it shows every partition found at ``path``. Otherwise the table gets just the
    partitions that this append has written to; nothing else is listed. Returns the table. See
    :func:`append_files` for ``gather``.
    """
    spark = df.sparkSession
    change, data, by = needed_change(spark, table, df.schema, keys, path, strict_types)
    if change in ("create", "replace"):
        location = qualify(spark, path)
        with new_definition(spark, table, data, by, location, change == "replace"):
            append_files(df, keys, path, gather)
        if keys:
            add_partitions(spark, table)
    else:
        ensure_table(spark, table, df.schema, keys, path, strict_types)
        rows = gathered(df, keys, gather).select(*(quoted(c) for c in spark.table(table).columns))
        with partition_writers(spark):
            rows.write.insertInto(table)
    return spark.table(table)


def managed_append(
    df: DataFrame, table: str, keys: list[str], path: str, gather: bool | None = None
) -> DataFrame:
    """The same in one write, which registers just the partitions it has written to."""
    rows = gathered(df, keys, gather)
    with partition_writers(df.sparkSession):
        rows.write.partitionBy(*keys).mode("append").option("path", path).saveAsTable(table)
    return df.sparkSession.table(table)


def add_partition(
    spark: SparkSession, table: str, values: dict, location: str | None = None
) -> None:
    """Register one partition, by default at Spark's own folder name for it."""
    spec = ", ".join(f"{quoted(key)} = {text_literal(value)}" for key, value in values.items())
    at = f" LOCATION {text_literal(location)}" if location is not None else ""
    spark.sql(f"ALTER TABLE {quoted_table(table)} ADD IF NOT EXISTS PARTITION ({spec}){at}")


def add_partitions(spark: SparkSession, table: str) -> None:
    """Register every partition found at the table's location."""
    spark.catalog.recoverPartitions(table)


def show_partitions(spark: SparkSession, table: str) -> DataFrame:
    """One row per registered partition: ``partition``."""
    return spark.sql(f"SHOW PARTITIONS {quoted_table(table)}")


def distinct_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """The combinations of ``keys`` in ``df``; reads no other column."""
    return df.select(*keys).distinct()


def head_rows(df: DataFrame, n: int = 100) -> DataFrame:
    """The first ``n`` rows; ``.show(n, truncate=False)`` prints them."""
    return df.limit(n)
