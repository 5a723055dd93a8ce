import os
import tracemalloc
import zipfile

import pyarrow as pa
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import blobframe as bf
from blobframe.sinks import files


def blobs(spark, rows):
    return spark.createDataFrame([(n, c) for n, c in rows], "name string, content binary")


def test_export_writes_one_file_per_row(spark, tmp_path):
    out = tmp_path / "out"
    rows = [("a.bin", b"1"), ("sub/b c.bin", b""), ("ü.bin", b"\x00\xff")]
    summary = bf.export_blobs(blobs(spark, rows), "name", "content", str(out))
    assert {(r.name, r.n_bytes) for r in summary.collect()} == {(n, len(c)) for n, c in rows}
    assert {n: (out / n).read_bytes() for n, _ in rows} == dict(rows)
    assert {r.path for r in summary.collect()} == {f"file:{out}/{n}" for n, _ in rows}
    assert sorted(os.listdir(out)) == sorted(["a.bin", "sub", "ü.bin"])
    scanned = bf.scan_blobs(spark, str(out), recursive=True)
    assert {bytes(r.content) for r in scanned.select("content").collect()} == {b"", b"1", b"\x00\xff"}
    assert bf.scan_blobs(spark, str(out), glob="a.*").count() == 1


def test_export_again_replaces_files(spark, tmp_path):
    for content in (b"one", b"two"):
        bf.export_blobs(blobs(spark, [("a", content)]), "name", "content", str(tmp_path))
    assert (tmp_path / "a").read_bytes() == b"two"


def test_names_do_not_choose_a_compression(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("blobframe.sources.store.RENAMING", ())
    rows = [(f"a.{end}", b"plain") for end in ("gz", "bz2", "zst", "lz4")]
    bf.export_blobs(blobs(spark, rows), "name", "content", str(tmp_path))
    assert {(tmp_path / name).read_bytes() for name, _ in rows} == {b"plain"}


def test_text_is_written_as_utf_8(spark, tmp_path):
    df = spark.createDataFrame([("a", "é")], "name string, content string")
    assert bf.export_blobs(df, "name", "content", str(tmp_path)).first().n_bytes == 2
    assert (tmp_path / "a").read_bytes() == "é".encode()


@pytest.mark.parametrize("name", ["../x", "/etc/x", "a/../../x", ".", "", None, "a/"])
def test_names_must_stay_below_the_folder(spark, tmp_path, name):
    with pytest.raises(Exception, match="is no name for a file"):
        bf.export_blobs(blobs(spark, [(name, b"1")]), "name", "content", str(tmp_path / "out"))


def test_missing_content_is_an_error(spark, tmp_path):
    with pytest.raises(Exception, match="has no content"):
        bf.export_blobs(blobs(spark, [("a", None)]), "name", "content", str(tmp_path))


def test_names_must_differ(spark, tmp_path):
    rows = blobs(spark, [("a", b"1"), ("a", b"2"), ("b", b"3")])
    with pytest.raises(ValueError, match="2 rows are named 'a'"):
        bf.export_blobs(rows, "name", "content", str(tmp_path / "out"))
    with pytest.raises(Exception, match="several rows for one archive are named 'a'"):
        bf.pack_blobs(rows, "name", "content", str(tmp_path / "zips"), shards=2)
    assert not [name for name in os.listdir(tmp_path / "zips") if name.startswith(".")]


def test_one_name_in_two_archives(spark, tmp_path):
    rows = blobs(spark, [("a", b"1"), ("a", b"2")]).withColumn("shard", F.col("content").cast("string"))
    bf.pack_blobs(rows, "name", "content", str(tmp_path), shards=2, shard_col="shard")
    names = spark.createDataFrame([("a",)], "member string")
    assert bytes(bf.lookup_members(names, str(tmp_path)).first().content) == b"1"


def test_last_of_a_name_wins(spark, tmp_path):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("n"), (F.col("id") % 500).cast("string"))).alias("name"),
        F.col("id").cast("string").cast("binary").alias("content"),
        "id",
    )
    summary = bf.export_blobs(df, "name", "content", str(tmp_path), on_duplicate="last", order_by="id")
    want = {r.name: str(r.last) for r in df.groupBy("name").agg(F.max("id").alias("last")).collect()}
    assert summary.count() == len(want)
    assert {n: (tmp_path / n).read_text() for n in want} == want


def test_last_must_be_one_row(spark, tmp_path):
    df = spark.createDataFrame([("a", b"1", 5), ("a", b"2", 5)], "name string, content binary, at int")
    with pytest.raises(ValueError, match="2 rows are named 'a'"):
        bf.export_blobs(df, "name", "content", str(tmp_path), on_duplicate="last", order_by="at")
    with pytest.raises(ValueError, match="needs order_by"):
        bf.export_blobs(df, "name", "content", str(tmp_path), on_duplicate="last")
    with pytest.raises(ValueError, match="'first'"):
        bf.export_blobs(df, "name", "content", str(tmp_path), on_duplicate="first")


def test_manifest_to_files(spark, make_zip, tmp_path):
    path = make_zip([("hive-site.xml", b"<x/>"), ("people.csv", b"a;b")])
    csv = tmp_path / "kv.csv"
    csv.write_text("name,number,filePath\none.xml,1,d/hive-site.xml\ntwo.csv,1,people.csv\nthree,1,q\n")
    out = tmp_path / "out"
    written = bf.export_manifest(spark, str(csv), path, "name", "filePath", str(out))
    assert written.count() == 3
    assert {n: (out / n).read_bytes() for n in os.listdir(out)} == {
        "one.xml": b"<x/>",
        "two.csv": b"a;b",
        "three": b"File Not Found",
    }


def test_last_manifest_row_of_a_name_is_written(spark, make_zip, tmp_path):
    path = make_zip([("x", b"X"), ("y", b"Y")])
    rows = spark.createDataFrame(
        [("a", 1, "x"), ("a", 3, "y"), ("a", 2, "none"), ("b", 1, "x"), ("c", 7, None)],
        "name string, at int, filePath string",
    )
    bf.export_manifest(spark, rows, path, "name", "filePath", str(tmp_path / "out"), order_by="at")
    found = {n: (tmp_path / "out" / n).read_bytes() for n in ("a", "b", "c")}
    assert found == {"a": b"Y", "b": b"X", "c": b"File Not Found"}
    with pytest.raises(ValueError, match="3 rows are named 'a'"):
        bf.export_manifest(spark, rows, path, "name", "filePath", str(tmp_path / "again"))


def archives_below(folder):
    """Paths of the archives of a folder with one packing, in order."""
    found = [os.path.join(at, n) for at, _, names in os.walk(folder) for n in names]
    return sorted(path for path in found if path.endswith(".zip"))


def entries(folder):
    found = {}
    for path in archives_below(folder):
        with zipfile.ZipFile(path) as archive:
            assert archive.testzip() is None
            found[os.path.basename(path)] = [(i.filename, archive.read(i)) for i in archive.infolist()]
    return found


NAME = st.text("abü. ", min_size=1, max_size=6).filter(lambda name: name not in (".", ".."))


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    rows=st.dictionaries(NAME, st.binary(max_size=300), max_size=12),
    shards=st.sampled_from([None, 1, 3]),
)
def test_pack_and_read_back(spark, tmp_path_factory, rows, shards):
    folder = str(tmp_path_factory.mktemp("packed"))
    summary = bf.pack_blobs(blobs(spark, rows.items()), "name", "content", folder, shards=shards)
    assert sum(r.n_members for r in summary.collect()) == len(rows)
    if rows:
        members = bf.archive_members(spark, folder).collect()
        assert {r.member: bytes(r.content) for r in members} == rows
        assert len(members) == len(rows)


def test_members_are_in_name_order_and_archives_end(spark, tmp_path):
    rows = [(f"n{i:03d}", b"x" * 100) for i in range(100)]
    summary = bf.pack_blobs(
        blobs(spark, rows[::-1]).coalesce(1), "name", "content", str(tmp_path), max_archive_bytes=2500
    )
    found = entries(tmp_path)
    assert summary.count() == len(found) == 4
    assert [name for members in found.values() for name, _ in members] == [n for n, _ in rows]
    bf.pack_blobs(blobs(spark, rows).coalesce(1), "name", "content", str(tmp_path / "n"), max_members=30)
    assert [len(members) for members in entries(tmp_path / "n").values()] == [30, 30, 30, 10]


def test_a_large_shard_fills_archives_in_several_tasks(spark, tmp_path):
    df = spark.range(3000).select(
        F.format_string("n%05d", "id").alias("name"),
        F.lit(b"x" * 50).alias("content"),
        F.when(F.col("id") < 2000, "hot").otherwise(F.concat(F.lit("s"), (F.col("id") % 10).cast("string"))).alias("shard"),
    )
    bf.pack_blobs(df, "name", "content", str(tmp_path), shards=6, shard_col="shard")
    found = entries(tmp_path)
    assert len({name.split("-")[2] for name in found if name.startswith("part-hot-")}) >= 3
    assert all(len(members) < 1500 for members in found.values())
    packed = [(name.split("-")[1], member) for name, members in found.items() for member, _ in members]
    assert packed == sorted(packed) and len(packed) == 3000


def test_packing_again_gives_the_same_bytes(spark, tmp_path):
    rows = blobs(spark, [(f"n{i}", str(i).encode() * 40) for i in range(50)])
    for folder in ("one", "two"):
        bf.pack_blobs(rows, "name", "content", str(tmp_path / folder), shards=3)
    one, two = (archives_below(tmp_path / folder) for folder in ("one", "two"))
    assert [os.path.basename(p) for p in one] == [os.path.basename(p) for p in two]
    for path, other in zip(one, two):
        with open(path, "rb") as a, open(other, "rb") as b:
            assert a.read() == b.read()


def test_no_content_is_shuffled_by_default(spark, tmp_path, monkeypatch):
    plans = []

    def keep(df, label):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return store(df, label)

    store = files.materialize

    monkeypatch.setattr(files, "materialize", keep)
    rows = blobs(spark, [("a", b"1")])
    bf.pack_blobs(rows, "name", "content", str(tmp_path))
    bf.export_blobs(rows, "name", "content", str(tmp_path))
    assert len(plans) == 2 and not any("Exchange" in plan for plan in plans)


def test_failed_write_leaves_no_file(spark, tmp_path):
    rows = blobs(spark, [("a", b"1"), ("b", None)]).coalesce(1)
    with pytest.raises(Exception, match="has no content"):
        bf.pack_blobs(rows, "name", "content", str(tmp_path))
    assert not [name for _, _, names in os.walk(tmp_path) for name in names]


def packed_members(spark, folder):
    return sorted((r.member, bytes(r.content)) for r in bf.archive_members(spark, str(folder)).collect())


def test_the_last_packing_of_a_folder_counts(spark, tmp_path):
    first = [(f"a{i}", b"1") for i in range(10)]
    second = [(f"b{i}", b"2") for i in range(5)]
    for rows in (first, second):
        bf.pack_blobs(blobs(spark, rows), "name", "content", str(tmp_path))
        assert packed_members(spark, tmp_path) == sorted(rows)
    assert bf.list_archives(spark, str(tmp_path), glob="*.zip").where("length > 0").count() >= 1
    assert bf.list_archives(spark, str(tmp_path), glob="*.none").count() == 0
    with pytest.raises(Exception, match="has no content"):
        bf.pack_blobs(blobs(spark, [("c", None)]), "name", "content", str(tmp_path))
    assert packed_members(spark, tmp_path) == sorted(second)
    assert bf.drop_old_packings(spark, str(tmp_path)) == 2
    assert packed_members(spark, tmp_path) == sorted(second)


@pytest.mark.parametrize("range_rows", [1 << 20, 700])
def test_lanes_are_ranges_of_about_equal_bytes(spark, monkeypatch, range_rows):
    monkeypatch.setattr(files, "RANGE_ROWS", range_rows)
    rows = spark.range(0, 5000, 1, 7).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 7)).alias("shard"),
        F.format_string("n%05d", F.pmod(F.col("id") * 7919, F.lit(5000))).alias("name"),
        (F.col("id") % 50 + 1).alias("size"),
    )
    for options in ({"task_bytes": 6000}, {"task_bytes": 1, "lanes": 21}):
        lanes = files.in_lanes(rows, **options).withColumn("lane", F.spark_partition_id())
        found = lanes.groupBy("lane").agg(
            F.sum("size").alias("bytes"), F.min(F.struct("shard", "name")).alias("a"),
            F.max(F.struct("shard", "name")).alias("b"), F.count("*").alias("n"),
        ).orderBy("lane").collect()
        assert sum(r.n for r in found) == 5000 and 20 <= len(found) <= 24
        assert max(r.bytes for r in found) <= 6200
        assert all(tuple(one.b) < tuple(other.a) for one, other in zip(found, found[1:]))


def test_sizes_of_a_column_spare_reading_content_twice(spark, tmp_path):
    evaluated = spark.sparkContext.accumulator(0)

    @F.udf("binary")
    def content(name):
        evaluated.add(1)
        return name.encode()

    rows = spark.createDataFrame([(f"n{i:02d}", "s", 3) for i in range(40)], "name string, shard string, n int")
    rows = rows.withColumn("content", content("name"))
    bf.pack_blobs(rows, "name", "content", str(tmp_path), shard_col="shard", size_col="n", task_bytes=30)
    assert evaluated.value == 40
    assert len(packed_members(spark, tmp_path)) == 40 and len(archives_below(tmp_path)) == 4


def test_packing_a_manifest_shuffles_no_content(spark, make_zip, tmp_path, monkeypatch):
    plans = []

    def keep(df, label):
        if label == "packed":
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return store(df, label)

    store = files.materialize
    monkeypatch.setattr(files, "materialize", keep)
    path = make_zip([(f"m{i}", str(i).encode() * 50) for i in range(60)])
    manifest = spark.range(80).selectExpr(
        "concat('f', lpad(id, 2, '0')) as name", "concat('m', id) as filePath", "cast(id % 3 as string) as shard"
    )
    out = bf.pack_manifest(
        spark, manifest, path, "name", "filePath", str(tmp_path / "out"), "shard", match="exact", task_bytes=500
    )
    assert out.agg(F.sum("n_members")).first()[0] == 80
    want = [(f"f{i:02d}", str(i).encode() * 50 if i < 60 else b"File Not Found") for i in range(80)]
    assert packed_members(spark, tmp_path / "out") == want
    assert len(plans) == 1 and "Exchange" not in plans[0].partition("MapInArrow")[0]


def test_duplicate_names_show_before_any_file_is_written(spark, make_zip, tmp_path):
    path = make_zip([("m1", b"1")])
    manifest = spark.sql("select 'same' as name, 'm1' as filePath from range(2)")
    with pytest.raises(ValueError, match="2 rows are named 'same'"):
        bf.export_manifest(spark, manifest, path, "name", "filePath", str(tmp_path / "out"))
    assert not (tmp_path / "out").exists()


def test_the_last_row_of_a_name_needs_an_order(spark):
    rows = spark.sql("select 'a' as name, cast(null as int) as at, 'x' as content from range(2)")
    with pytest.raises(ValueError, match="no row named 'a'"):
        files.last_of_each(rows, "name", "at")


def test_a_packing_task_holds_few_members(spark, tmp_path):
    """By default an archive ends before the list of its members gets long; no member is lost."""
    rows = spark.range(0, 100_001, 1, 1).selectExpr("cast(id as string) as name", "'x' as content")
    packed = bf.pack_blobs(rows, "name", "content", str(tmp_path)).collect()
    assert sorted(r.n_members for r in packed) == [1, 100_000]
    index = bf.archive_index(bf.list_archives(spark, str(tmp_path)))
    assert index.select("member").distinct().count() == 100_001


def test_rows_of_a_batch_become_objects_a_few_at_a_time():
    batch = pa.RecordBatch.from_pydict({"name": [str(k) for k in range(4000)], "content": ["x" * 10_000] * 4000})
    tracemalloc.start()
    try:
        names = [row["name"] for row in files.rows_of(batch)]
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert names == batch.column("name").to_pylist() and peak < 8 << 20
    assert list(files.rows_of(batch.slice(0, 0))) == []
