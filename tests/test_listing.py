"""Listing folders level by level, and the index that follows what is listed."""

import os
import zipfile

import pytest
from pyspark.sql import functions as F

import blobframe as bf
from blobframe.sources import archive


def names(df, base):
    return sorted(r.path.removeprefix(f"file:{base}/") for r in df.select("path").collect())


@pytest.fixture
def tree(tmp_path):
    for name in ("a.bin", "_b", ".c", "sub/d.bin", "sub/_deep/e", "sub/.x/f g.bin", "k=1/h.bin"):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(b"" if name == "_b" else name.encode())
    (tmp_path / ".a.bin.crc").write_bytes(b"x")
    (tmp_path / ".alone.crc").write_bytes(b"x")
    (tmp_path / ".0.blobframe-upload").write_bytes(b"x")
    os.symlink(tmp_path / "nowhere", tmp_path / "broken")
    return tmp_path


def test_every_file_is_listed(spark, tree):
    top = [".alone.crc", ".c", "_b", "a.bin"]
    assert names(bf.list_blobs(spark, str(tree)), tree) == top
    below = ["k=1/h.bin", "sub/.x/f g.bin", "sub/_deep/e", "sub/d.bin"]
    assert names(bf.list_blobs(spark, str(tree), recursive=True), tree) == sorted(top + below)
    found = names(bf.list_blobs(spark, str(tree), glob="*.bin", recursive=True), tree)
    assert found == ["a.bin", "k=1/h.bin", "sub/.x/f g.bin", "sub/d.bin"]


def test_files_and_patterns_can_be_named(spark, tree):
    assert names(bf.list_blobs(spark, f"{tree}/a.bin"), tree) == ["a.bin"]
    assert names(bf.list_blobs(spark, f"{tree}/s*"), tree) == ["sub/d.bin"]
    two = bf.list_blobs(spark, [f"{tree}/sub", f"{tree}/k=1"])
    assert names(two, tree) == ["k=1/h.bin", "sub/d.bin"]
    assert bf.list_blobs(spark, f"{tree}/none").count() == 0


def test_lengths_times_and_contents(spark, tree):
    rows = bf.scan_blobs(spark, str(tree), recursive=True).collect()
    for row in rows:
        path = row.path.removeprefix("file:")
        assert row.length == os.path.getsize(path) == len(row.content)
        with open(path, "rb") as file:
            assert file.read() == bytes(row.content)
        assert abs(row.modificationTime.timestamp() - os.path.getmtime(path)) < 1
    assert len(rows) == 8


def test_a_scan_is_cut_into_tasks_by_bytes(spark, tmp_path):
    for k in range(30):
        (tmp_path / f"{k}").write_bytes(b"x" * 1000)
    scan = bf.scan_blobs(spark, str(tmp_path), task_bytes=3 << 20)
    assert scan.rdd.getNumPartitions() == 11
    assert scan.agg(F.sum(F.octet_length("content"))).first()[0] == 30_000


def test_many_folders_are_listed_by_many_tasks(spark, tmp_path):
    for folder in range(1000):
        path = tmp_path / f"{folder % 10}" / f"{folder}"
        path.mkdir(parents=True, exist_ok=True)
        for file in range(100):
            os.close(os.open(path / f"{file}", os.O_CREAT | os.O_WRONLY))
    listed = bf.list_blobs(spark, str(tmp_path), recursive=True)
    assert listed.count() == 100_000 == listed.select("path").distinct().count()
    # Every task has written one file of the stored listing.
    rows = [r["count"] for r in listed.groupBy(F.input_file_name()).count().collect()]
    assert len(rows) >= 60 and max(rows) <= 3000


def write_zip(path, members):
    with zipfile.ZipFile(path, "w") as out:
        for name, content in members:
            out.writestr(name, content)


def test_only_new_and_changed_archives_are_read_again(spark, tmp_path, monkeypatch):
    read, build = [], archive.archive_index

    def counting(archives):
        read.append(sorted(os.path.basename(r.path) for r in archives.select("path").collect()))
        return build(archives)

    monkeypatch.setattr(archive, "archive_index", counting)
    folder, store = tmp_path / "zips", str(tmp_path / "store")
    folder.mkdir()

    def members():
        index = bf.refresh_index(spark, str(folder), store)
        return sorted((os.path.basename(r.archive), r.member, r.size) for r in index.collect())

    assert members() == [] and read == []
    write_zip(folder / "a.zip", [("x", b"1")])
    write_zip(folder / "b.zip", [("y", b"22")])
    write_zip(folder / "none.zip", [])
    assert members() == [("a.zip", "x", 1), ("b.zip", "y", 2)]
    write_zip(folder / "b.zip", [("y", b"333"), ("z", b"")])
    write_zip(folder / "c.zip", [("x", b"4444")])
    os.remove(folder / "a.zip")
    want = [("b.zip", "y", 3), ("b.zip", "z", 0), ("c.zip", "x", 4)]
    assert members() == want and members() == want
    assert read == [["a.zip", "b.zip", "none.zip"], ["b.zip", "c.zip"]]


def test_what_a_failed_refresh_leaves_is_not_counted(spark, tmp_path):
    store = str(tmp_path / "store")
    write_zip(tmp_path / "a.zip", [("x", b"1")])
    index = bf.archive_index(bf.list_archives(spark, f"{tmp_path}/a.zip"))
    index.select("*", F.lit("failed").alias("run")).write.parquet(f"{store}/members")
    for _ in range(2):
        found = bf.refresh_index(spark, f"{tmp_path}/a.zip", store)
        assert [r.member for r in found.collect()] == ["x"]
