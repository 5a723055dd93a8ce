"""Scans: delimited manifests and whole blob files."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blobframe.session import store_options
from blobframe.sources.listing import LISTING, list_blobs
from blobframe.sources.store import Store

#: What a task that reads files should read, and what opening one counts.
TASK_BYTES = 128 << 20
FILE_BYTES = 1 << 20


def read_manifest(
    spark: SparkSession,
    path: str | list[str],
    sep: str = ",",
    schema: T.StructType | str | None = None,
    **options,
) -> DataFrame:
    """A delimited file whose header names the columns; every column is a string.

    Without ``schema`` Spark reads the header of one file to learn the names. Name the schema to
    spare that, and for files that carry no header (``header=False``).
    """
    reader = spark.read.option("sep", sep).option("header", True).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


def scan_blobs(
    spark: SparkSession,
    path: str | list[str],
    glob: str | None = None,
    recursive: bool = False,
    task_bytes: int = TASK_BYTES,
) -> DataFrame:
    """One row per file that :func:`list_blobs` lists: ``path, modificationTime, length, content``.

    The files are listed at once; content is read when the result is, by tasks of about
    ``task_bytes`` each. Where no content is wanted, list.
    """
    options = store_options(spark)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with Store(options) as store:
            for batch in batches:
                for at, (file, length) in enumerate(
                    zip(batch.column("path").to_pylist(), batch.column("length").to_pylist())
                ):
                    content = store.open(file).read_at(length, 0) if length else b""
                    columns = [*batch.slice(at, 1).columns, pa.array([content], pa.binary())]
                    names = [*batch.schema.names, "content"]
                    yield pa.RecordBatch.from_arrays(columns, names=names)

    listed = list_blobs(spark, path, glob, recursive)
    total = listed.agg(F.sum(F.col("length") + FILE_BYTES)).first()[0] or 0
    tasks = max(spark.sparkContext.defaultParallelism, -(-total // task_bytes))
    return listed.repartition(tasks).mapInArrow(read, f"{LISTING}, content binary")
