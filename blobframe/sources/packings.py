"""The packings of a folder: sets of archives, of which the last published one counts.

A packing writes its archives to a subfolder of its own, then the table of what it has written, and
at last a small file that names it. Whoever lists the folder reads that file and that table. So a
packing that fails, or a second one into the same folder, mixes with nothing.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blobframe.session import store_options
from blobframe.sources.store import Store, exists, hadoop_path, qualify

#: Names inside the folder: the file that names the packing, and how its subfolders begin.
CURRENT = "_packing.json"
SUBFOLDER = "packing-"
ARCHIVES, TABLE = "archives", "_table"


def new_packing(spark: SparkSession, folder: str) -> str:
    """The subfolder of a new packing, which nobody sees before it is published."""
    return f"{qualify(spark, folder).rstrip('/')}/{SUBFOLDER}{uuid.uuid4().hex}"


def publish(spark: SparkSession, folder: str, packing: str, written: DataFrame) -> None:
    """Let ``written`` (archive, n_members, n_bytes, length, modificationTime) be the folder's."""
    written.write.parquet(f"{packing}/{TABLE}")
    name = json.dumps({"packing": packing.rpartition("/")[2]}).encode()
    with Store(store_options(spark)) as store:
        upload = store.create(f"{qualify(spark, folder).rstrip('/')}/{CURRENT}")
        upload.stream.write(name)
        upload.finish()


def packing_of(spark: SparkSession, folder: str) -> str | None:
    """The subfolder of the packing that counts, if there is one."""
    if any(c in folder for c in "*?[{"):
        return None
    base = qualify(spark, folder).rstrip("/")
    if not exists(spark, f"{base}/{CURRENT}"):
        return None
    with Store(store_options(spark)) as store:
        handle = store.open(f"{base}/{CURRENT}")
        return f"{base}/{json.loads(handle.read_at(handle.size(), 0))['packing']}"


def current_packing(spark: SparkSession, folder: str) -> DataFrame | None:
    """``path, length, modificationTime`` of the archives of the packing that counts."""
    packing = packing_of(spark, folder)
    if packing is None:
        return None
    written = spark.read.parquet(f"{packing}/{TABLE}")
    return written.select(F.col("archive").alias("path"), "length", "modificationTime")


def drop_old_packings(spark: SparkSession, folder: str) -> int:
    """Delete the packings that do not count, also failed ones; returns how many there were.

    Nobody may be packing into the folder, or still be reading an older packing.
    """
    current = packing_of(spark, folder)
    target, system = hadoop_path(spark, f"{qualify(spark, folder).rstrip('/')}/{SUBFOLDER}*")
    old = [x.getPath() for x in system.globStatus(target) or []]
    old = [path for path in old if current is not None and path.toString() != current]
    for path in old:
        system.delete(path, True)
    return len(old)
