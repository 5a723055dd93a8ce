"""Byte-range reads and single-file writes from inside tasks.

Spark's ``binaryFile`` source hands over whole files. Tasks that need a few members of a large
archive read just those ranges through ``pyarrow.fs`` instead.
"""

from __future__ import annotations

import uuid
from collections import OrderedDict
from collections.abc import Callable

import pyarrow.fs as pafs
from pyspark.sql import SparkSession

OPEN_HANDLES = 8
RENAMING = ("local", "hdfs")
OBJECT_STORES = ("s3", "s3a", "s3n")
# Schemes of stores that were registered, and how their file systems are made.
REGISTERED: dict[str, Callable[[str, dict[str, str]], pafs.FileSystem]] = {}
# How the name ends that a file has while it is not complete; listings pass over these.
UPLOAD_SUFFIX = ".blobframe-upload"


def hadoop_path(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def qualify(spark: SparkSession, path: str) -> str:
    """``path`` with its scheme, as the session's Hadoop settings resolve it."""
    target, system = hadoop_path(spark, path)
    return system.makeQualified(target).toString()


def exists(spark: SparkSession, path: str) -> bool:
    target, system = hadoop_path(spark, path)
    return system.exists(target)


def register_store(scheme: str, make: Callable[[str, dict[str, str]], pafs.FileSystem]) -> None:
    """Let tasks reach paths of a scheme that Arrow does not know.

    ``make`` gets a qualified path and the store options of the session, and returns a file system
    of Arrow's (``PyFileSystem`` wraps others) that takes ``/folder/file``, or ``bucket/key`` for
    the schemes of object stores. It travels with the tasks. The session's Hadoop settings must know
    the scheme too, as the driver looks folders up there.
    """
    REGISTERED[scheme] = make


def open_system(uri: str, options: dict[str, str]) -> pafs.FileSystem:
    scheme = uri.partition(":")[0]
    if scheme in REGISTERED:
        return REGISTERED[scheme](uri, options)
    if scheme == "file":
        return pafs.LocalFileSystem()
    if scheme in OBJECT_STORES:
        args = {}
        if "access_key" in options:
            args.update(access_key=options["access_key"], secret_key=options["secret_key"])
        if "endpoint" in options:
            protocol, found, host = options["endpoint"].rpartition("://")
            args.update(
                endpoint_override=host,
                scheme=protocol if found else "https",
                force_virtual_addressing=options.get("path_style", "false") != "true",
            )
        return pafs.S3FileSystem(**args)
    return pafs.FileSystem.from_uri(uri)[0]


def inner_path(uri: str) -> str:
    """The path of a qualified URI inside its file system: ``bucket/key``, or ``/folder/file``."""
    scheme, _, rest = uri.partition(":")
    if scheme in OBJECT_STORES:
        return rest.lstrip("/")
    if rest.startswith("//"):
        rest = "/" + rest[2:].partition("/")[2]
    return rest


class Store:
    """Open files of one task; closes them when the task's iterator ends, early or not."""

    def __init__(self, options: dict[str, str]):
        self.options = options
        self.systems = {}
        self.folders = set()
        self.files = OrderedDict()

    def __enter__(self):
        return self

    def __exit__(self, *exc):
        for handle in self.files.values():
            handle.close()
        self.files.clear()

    def system(self, uri: str) -> pafs.FileSystem:
        scheme, _, rest = uri.partition(":")
        root = scheme, rest.split("/", 3)[2] if rest.startswith("//") else ""
        if root not in self.systems:
            self.systems[root] = open_system(uri, self.options)
        return self.systems[root]

    def open(self, uri: str):
        """A seekable handle, kept open for the next call."""
        handle = self.files.pop(uri, None)
        if handle is None:
            handle = self.system(uri).open_input_file(inner_path(uri))
            if len(self.files) >= OPEN_HANDLES:
                self.files.popitem(last=False)[1].close()
        self.files[uri] = handle
        return handle

    def create(self, uri: str, buffer_size: int | None = None) -> Upload:
        system, path = self.system(uri), inner_path(uri)
        folder = path.rpartition("/")[0]
        if system.type_name in RENAMING and folder not in self.folders:
            system.create_dir(folder, recursive=True)
            self.folders.add(folder)
        return Upload(system, path, buffer_size)


class Upload:
    """A file that shows up under its name only once it is complete.

    Where files can be renamed, every attempt writes to a name of its own and moves the file when it
    is complete, so an attempt that fails never touches what another one has published, and a rerun
    or speculative task replaces the file by the same bytes. Object stores have no renaming, just
    copies; there the file is written under its name, as nothing is seen of it before it is closed.
    What is given up half-way there has to be closed to be deleted, so two attempts that may fail
    must not write to one name.
    """

    def __init__(self, system: pafs.FileSystem, path: str, buffer_size: int | None = None):
        self.system = system
        self.path = self.target = path
        if system.type_name in RENAMING:
            folder = path.rpartition("/")[0]
            self.target = f"{folder}/.{uuid.uuid4().hex}{UPLOAD_SUFFIX}"
        # By default the stream would compress what goes to a name like ``x.gz``.
        self.stream = system.open_output_stream(
            self.target, compression=None, buffer_size=buffer_size
        )

    def finish(self):
        self.stream.close()
        if self.target != self.path:
            self.system.move(self.target, self.path)

    def abandon(self):
        self.stream.close()
        self.system.delete_file(self.target)
