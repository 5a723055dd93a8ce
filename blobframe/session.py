"""Session set-up, object-store settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, Observation, SparkSession

#: Scratch folders made since :func:`release_scratch` was entered, if it was.
made: ContextVar[list[str] | None] = ContextVar("made", default=None)

SCRATCH_CONF = "spark.checkpoint.dir"


def build_session(conf: dict | None = None, metastore: bool = False) -> SparkSession:
    """A session with adaptive execution on and UTC timestamps.

    ``conf`` carries everything that belongs to the deployment, the master included.
    ``metastore=True`` turns on Spark's Hive catalog.
    """
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        **(conf or {}),
    }
    builder = SparkSession.builder
    for key, value in settings.items():
        builder = builder.config(key, value)
    if metastore:
        builder = builder.enableHiveSupport()
    return builder.getOrCreate()


def object_store_conf(
    access_key: str | None = None,
    secret_key: str | None = None,
    endpoint: str | None = None,
    path_style: bool = False,
) -> dict[str, str]:
    """Session settings for ``s3a://`` paths; pass the result to :func:`build_session`.

    Without keys the store's own credential chain (instance role, environment) applies.
    """
    conf = {"spark.hadoop.fs.s3a.path.style.access": str(path_style).lower()}
    if (access_key is None) != (secret_key is None):
        raise ValueError("access_key and secret_key go together")
    if access_key is not None:
        conf["spark.hadoop.fs.s3a.access.key"] = access_key
        conf["spark.hadoop.fs.s3a.secret.key"] = secret_key
    if endpoint is not None:
        conf["spark.hadoop.fs.s3a.endpoint"] = endpoint
    return conf


def store_options(spark: SparkSession) -> dict[str, str]:
    """The ``fs.s3a`` settings of the session, for the tasks that read byte ranges."""
    keys = {
        "access_key": "spark.hadoop.fs.s3a.access.key",
        "secret_key": "spark.hadoop.fs.s3a.secret.key",
        "endpoint": "spark.hadoop.fs.s3a.endpoint",
        "path_style": "spark.hadoop.fs.s3a.path.style.access",
    }
    found = {name: spark.conf.get(key, None) for name, key in keys.items()}
    return {name: value for name, value in found.items() if value is not None}


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder name below the shared folder the session names in ``spark.checkpoint.dir``.

    Only a local session may leave that setting unset; it then gets a folder of this machine.
    """
    base = spark.conf.get(SCRATCH_CONF, None)
    if not base:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError(f"set {SCRATCH_CONF} to a folder all executors share")
        base = tempfile.mkdtemp(prefix="blobframe-")
        spark.conf.set(SCRATCH_CONF, base)
    folder = f"{base.rstrip('/')}/blobframe-{uuid.uuid4().hex}"
    if made.get() is not None:
        made.get().append(folder)
    return f"{folder}/{label}"


@contextmanager
def release_scratch(spark: SparkSession) -> Iterator[None]:
    """Delete, at the end of the block, the scratch tables that were made in it.

    For work that ends in the block: a DataFrame that still has to read one of them is of no use
    afterwards. Without it, scratch tables stay for the retention rules of their folder.
    """
    token = made.set([])
    try:
        yield
    finally:
        folders = made.get()
        made.reset(token)
        for folder in folders:
            target = spark._jvm.org.apache.hadoop.fs.Path(folder)
            conf = spark._jsparkSession.sessionState().newHadoopConf()
            target.getFileSystem(conf).delete(target, True)


def materialize(df: DataFrame, label: str, keep: bool = False) -> DataFrame:
    """Write ``df`` to the scratch folder and return the scan of what was written.

    Cuts the lineage, fixes row positions for good (a rerun task sees the same rows in the same
    order) and gives the planner true sizes instead of guesses through Python functions. With
    ``keep`` the table outlives a block of :func:`release_scratch`.
    """
    path = scratch_dir(df.sparkSession, label)
    if keep and made.get() is not None:
        made.get().pop()
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def measured(df: DataFrame, label: str, **metrics: Column) -> tuple[DataFrame, dict]:
    """:func:`materialize`, and aggregates of the rows, taken while they are written."""
    seen = Observation()
    named = [column.alias(name) for name, column in metrics.items()]
    stored = materialize(df.observe(seen, *named), label)
    found = seen.get
    return stored, {name: found.get(name) for name in metrics}


def observed(df: DataFrame, **metrics: Column) -> dict:
    """Aggregates of all rows of ``df`` by one job, without a shuffle."""
    seen = Observation()
    named = [column.alias(name) for name, column in metrics.items()]
    df.observe(seen, *named).write.format("noop").mode("overwrite").save()
    found = seen.get
    return {name: found.get(name) for name in metrics}
