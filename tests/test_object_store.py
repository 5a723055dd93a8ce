"""Everything that touches files, on a store without renaming and without folders.

The store is a folder of this machine that tasks reach only through a file system in Python, with
the ways of an object store: an object appears when its stream is closed, cannot be renamed, and a
folder is nothing but the beginning of names. The driver sees it as ``viewfs://<bucket>/``.
"""

import io
import os
import sys
import uuid
import zipfile

import pyarrow as pa
import pyarrow.fs as pafs
import pytest
from pyspark import cloudpickle

import blobframe as bf
from blobframe.sources import store


class Objects(pafs.FileSystemHandler):
    def __init__(self, root):
        self.root = root

    def place(self, path):
        return os.path.join(self.root, path.lstrip("/"))

    def info(self, path):
        at = self.place(path)
        if os.path.isdir(at):
            return pafs.FileInfo(path, pafs.FileType.Directory)
        if not os.path.exists(at):
            return pafs.FileInfo(path, pafs.FileType.NotFound)
        size, modified = os.path.getsize(at), os.path.getmtime(at)
        return pafs.FileInfo(path, pafs.FileType.File, size=size, mtime=modified)

    def get_type_name(self):
        return "objects"

    def get_file_info(self, paths):
        return [self.info(path) for path in paths]

    def get_file_info_selector(self, selector):
        assert not selector.recursive
        base = selector.base_dir.rstrip("/")
        return [self.info(f"{base}/{name}") for name in os.listdir(self.place(base))]

    def open_input_file(self, path):
        with open(self.place(path), "rb") as file:
            return pa.PythonFile(io.BytesIO(file.read()), mode="r")

    def open_output_stream(self, path, metadata):
        return pa.PythonFile(Object(self.place(path)), mode="w")

    def delete_file(self, path):
        os.remove(self.place(path))

    def refuse(self, *args, **kwargs):
        raise NotImplementedError("an object store does not do that")

    copy_file = move = create_dir = delete_dir = delete_dir_contents = refuse
    delete_root_dir_contents = normalize_path = open_append_stream = open_input_stream = refuse


class Object(io.BytesIO):
    def __init__(self, place):
        super().__init__()
        self.place = place

    def close(self):
        if not self.closed:
            os.makedirs(os.path.dirname(self.place), exist_ok=True)
            with open(f"{self.place}.part", "wb") as file:
                file.write(self.getvalue())
            os.rename(f"{self.place}.part", self.place)
        super().close()


@pytest.fixture
def objects(spark, tmp_path):
    root = tmp_path / "objects"
    root.mkdir()
    bucket = f"objects{uuid.uuid4().hex}"  # Hadoop remembers the file systems it has made
    name = f"fs.viewfs.mounttable.{bucket}.link./b"
    spark.conf.set(name, f"file:{root}/b")
    (root / "b").mkdir()
    place = str(root)
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    bf.register_store("viewfs", lambda uri, options: pafs.PyFileSystem(Objects(place)))
    yield f"viewfs://{bucket}/b", root / "b"
    del store.REGISTERED["viewfs"]
    cloudpickle.unregister_pickle_by_value(sys.modules[__name__])
    spark.conf.unset(name)


def blobs(spark, rows):
    return spark.createDataFrame(rows, "name string, content binary")


def test_export_and_scan(spark, objects):
    uri, folder = objects
    rows = [("a.bin", b"1"), ("sub/b.bin", b""), ("_c", b"\x00")]
    out = bf.export_blobs(blobs(spark, rows), "name", "content", f"{uri}/out")
    assert {r.path for r in out.collect()} == {f"{uri}/out/{name}" for name, _ in rows}
    found = bf.scan_blobs(spark, f"{uri}/out", recursive=True).collect()
    assert {(r.path, bytes(r.content)) for r in found} == {(f"{uri}/out/{n}", c) for n, c in rows}
    assert not [n for _, _, names in os.walk(folder) for n in names if "upload" in n or "part" in n]
    bf.export_blobs(blobs(spark, [("a.bin", b"22")]), "name", "content", f"{uri}/out")
    assert (folder / "out/a.bin").read_bytes() == b"22"
    with pytest.raises(Exception, match="has no content"):
        bf.export_blobs(blobs(spark, [("a.bin", None)]), "name", "content", f"{uri}/out")
    assert (folder / "out/a.bin").read_bytes() == b"22"


def test_pack_resolve_and_a_second_attempt_that_fails(spark, objects):
    uri, folder = objects
    rows = [(f"m{i}", str(i).encode() * 30) for i in range(40)]
    bf.pack_blobs(blobs(spark, rows), "name", "content", f"{uri}/zips", shards=3)
    with pytest.raises(Exception, match="has no content"):
        bad = blobs(spark, [("m1", b"other"), ("m2", None)]).coalesce(1)
        bf.pack_blobs(bad, "name", "content", f"{uri}/zips")
    assert sum(1 for _, _, names in os.walk(folder) for n in names if n.endswith(".zip")) == 3
    asked = spark.range(50).selectExpr("id", "concat('x/m', id) as filePath")
    got = bf.resolve_blobs(asked, f"{uri}/zips", ["filePath"], match="exact").collect()
    want = {i: dict(rows).get(f"m{i}", b"File Not Found") for i in range(50)}
    assert {r.id: bytes(r.filePath) for r in got} == want
    members = bf.archive_members(spark, f"{uri}/zips").collect()
    assert {(r.member, bytes(r.content)) for r in members} == set(rows)


def test_archives_that_were_put_there(spark, objects):
    uri, folder = objects
    for k in range(3):
        with zipfile.ZipFile(folder / f"{k}.zip", "w") as out:
            out.writestr(f"n{k}", str(k) * 10)
    index = bf.refresh_index(spark, uri, f"{folder}-index", glob="*.zip")
    assert sorted((r.archive, r.member) for r in index.collect()) == [
        (f"{uri}/{k}.zip", f"n{k}") for k in range(3)
    ]
