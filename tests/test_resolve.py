import os
import sys
import tracemalloc
import uuid
from contextlib import contextmanager

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql import types as T

import blobframe as bf
from blobframe.operators import fetch
from blobframe.operators.fetch import attach_content, spread_rows
from blobframe.plans.resolve import with_places
from blobframe.sources import store
from blobframe.sources.archive import INDEX_SCHEMA

MANIFEST = "name string, number string, filePath string"


def manifest(spark, *paths):
    return spark.createDataFrame([(f"r{i}", "1", p) for i, p in enumerate(paths)], MANIFEST)


def contents(df, column="filePath"):
    return {r.name: None if r[column] is None else bytes(r[column]) for r in df.collect()}


def test_two_row_manifest(spark, make_zip, tmp_path):
    csv = tmp_path / "kv.csv"
    csv.write_text("name,number,filePath\nhive-site.xml,1,hive-site.xml\npeople.csv,1,a/b/people.csv\n")
    path = make_zip([("hive-site.xml", b"<x/>"), ("people.csv", b"a;b")])
    rows = bf.read_manifest(spark, str(csv))
    resolved = bf.resolve_blobs(rows, path, ["filePath"])
    assert resolved.schema == bf.with_binary_columns(rows.schema, ["filePath"])
    assert contents(resolved) == {"hive-site.xml": b"<x/>", "people.csv": b"a;b"}


def test_edges_of_contains(spark, make_zip):
    path = make_zip([("people", b"short"), ("people.csv", b"long"), ("dir/n.txt", b"n"), ("b", b"dir b")])
    rows = manifest(
        spark, "x/people.csv.bak", "nope.xin", None, "", "a/b/", "my people (2).csv", "n.txt", "/"
    )
    resolved = bf.resolve_blobs(rows, path, ["filePath"], status_col="status")
    lost = bf.NOT_FOUND
    assert contents(resolved) == {
        "r0": b"short",
        "r1": lost,
        "r2": lost,
        "r3": lost,
        "r4": b"dir b",
        "r5": b"short",
        "r6": lost,
        "r7": lost,
    }
    assert lost == b"File Not Found"
    status = {r.name: r.status for r in resolved.collect()}
    assert status == {
        "r0": "found",
        "r1": "missing",
        "r2": "null_path",
        "r3": "missing",
        "r4": "found",
        "r5": "found",
        "r6": "missing",
        "r7": "missing",
    }


def test_stream_order_decides(spark, make_zip):
    rows = manifest(spark, "people.csv")
    short_first = make_zip([("people", b"short"), ("people.csv", b"long")], "one.zip")
    long_first = make_zip([("people.csv", b"long"), ("people", b"short")], "two.zip")
    assert contents(bf.resolve_blobs(rows, short_first, ["filePath"])) == {"r0": b"short"}
    assert contents(bf.resolve_blobs(rows, long_first, ["filePath"])) == {"r0": b"long"}
    both = bf.resolve_blobs(rows, [long_first, short_first], ["filePath"])
    assert contents(both) == {"r0": b"short"}
    exact = bf.resolve_blobs(rows, short_first, ["filePath"], match="exact")
    assert contents(exact) == {"r0": b"long"}


def test_default_of_choice(spark, make_zip):
    path = make_zip([("a", b"1")])
    rows = manifest(spark, "a", "zzz")
    assert contents(bf.resolve_blobs(rows, path, ["filePath"], default=None)) == {"r0": b"1", "r1": None}
    assert contents(bf.resolve_blobs(rows, path, ["filePath"], default=b"-")) == {"r0": b"1", "r1": b"-"}


def test_two_columns_and_order(spark, make_zip):
    path = make_zip([("a.txt", b"A"), ("b.bin", b"B")])
    rows = spark.createDataFrame([("x/b.bin", 1, "a.txt"), (None, 2, "q")], "one string, n int, two string")
    resolved = bf.resolve_blobs(rows, path, ["two", "one"], status_col="s")
    assert resolved.columns == ["one", "n", "two", "s_one", "s_two"]
    by_n = {r.n: r for r in resolved.collect()}
    assert (bytes(by_n[1].one), bytes(by_n[1].two)) == (b"B", b"A")
    assert (by_n[2].s_one, by_n[2].s_two) == ("null_path", "missing")


def test_no_column_is_no_work(spark, make_zip):
    rows = manifest(spark, "a")
    assert bf.resolve_blobs(rows, "/no/such/folder", ["absent"]) is rows


def test_paths_must_be_strings(spark, make_zip):
    rows = spark.createDataFrame([(1,)], "filePath int")
    with pytest.raises(TypeError, match="filePath must hold paths"):
        bf.resolve_blobs(rows, make_zip([("a", b"1")]), ["filePath"])


def test_no_archive_and_no_row(spark, make_zip):
    rows = manifest(spark, "a")
    assert contents(bf.resolve_blobs(rows, make_zip([]), ["filePath"])) == {"r0": bf.NOT_FOUND}
    assert bf.resolve_blobs(rows.limit(0), make_zip([("a", b"1")], "b.zip"), ["filePath"]).count() == 0


def test_late_reading(spark, make_zip):
    path = make_zip([(f"m{i}", b"x" * i) for i in range(10)])
    located = bf.locate_blobs(manifest(spark, *(f"m{i}" for i in range(10))), path, ["filePath"], "exact")
    assert "filePath" in located.columns
    small = bf.materialize(located.where("filePath__at.size < 3"), "small")
    assert contents(bf.read_located(small, ["filePath"])) == {"r0": b"", "r1": b"x", "r2": b"xx"}


def test_other_column_types_pass_through(spark, make_zip):
    rows = spark.sql(
        "select 'a' as filePath, timestamp'2020-01-01 10:00:00' as ts, timestamp_ntz'2020-01-01 10:00:00' as n, "
        "cast(1.5 as decimal(9,2)) as d, array(1, null) as xs, map('k', struct(1 as v)) as m, date'2020-02-02' as day, "
        "cast(null as string) as nothing"
    )
    resolved = bf.resolve_blobs(rows, make_zip([("a", b"1")]), ["filePath"])
    assert resolved.drop("filePath").collect() == rows.drop("filePath").collect()


def skewed(spark, make_zip, rows=3000):
    """A third of the rows are copies of one row that has a blob, a third lack one."""
    path = make_zip([(f"m{i}", str(i).encode() * 50) for i in range(40)])
    number = F.col("id") % 3
    paths = (
        F.when(number == 0, "m7")
        .when(number == 1, "none")
        .otherwise(F.concat(F.lit("m"), (F.col("id") % 40).cast("string")))
    )
    asked = spark.range(rows).select(F.lit("same").alias("name"), paths.alias("filePath"))
    return asked, bf.locate_blobs(asked, path, ["filePath"], "exact")


def test_hot_members_and_rows_without_one_are_dealt_out(spark, make_zip, monkeypatch):
    asked, located = skewed(spark, make_zip)
    placed = located.select("name", F.col("filePath__at").alias("blob"))
    task_bytes = 200 * (fetch.ROW_BYTES + 50)
    for limit in (fetch.HOT_BROADCAST_ROWS, 0):
        spread = spread_rows(placed, ["blob"], 14, task_bytes, 1 << 20, limit)
        sizes = [r["count"] for r in spread.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 3000 and max(sizes) < 900 and len(sizes) > 8
        got = attach_content(placed, ["blob"], task_bytes=task_bytes)
        want = placed.select(
            F.coalesce(F.col("blob.size"), F.lit(len(bf.NOT_FOUND))).alias("n")
        ).groupBy("n").count()
        have = got.select(F.octet_length("blob").cast("long").alias("n")).groupBy("n").count()
        assert sorted(map(tuple, have.collect())) == sorted(map(tuple, want.collect()))


def test_hot_names_are_split_when_rows_meet_places(spark):
    """Neither side is broadcast; a third of the rows have one name, a third have none."""
    rows = bf.materialize(
        spark.range(0, 60_000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, "hot")
            .when(F.col("id") % 3 == 1, F.concat(F.lit("n"), F.col("id").cast("string")))
            .alias("filePath"),
            F.sha2(F.col("id").cast("string"), 256).alias("other"),
        ),
        "rows",
    )
    names = rows.select(F.col("filePath").alias("fn")).where("fn is not null").distinct()
    places = bf.materialize(names.select("fn", F.struct(F.lit("z").alias("archive")).alias("place")), "p")
    with skewed_joins(spark):
        joined = with_places(rows, places, ["filePath"])
        assert joined.where("filePath__at is not null").count() == 40_000
        joined = joined.select("other", "filePath__at")
        assert len(joined.collect()) == 60_000
        plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "skew=true" in plan


def test_hot_pieces_are_split_when_they_meet_members(spark):
    """Every name holds the member ``hot``; neither side is broadcast."""
    names = spark.range(0, 60_000, 1, 8).select(F.format_string("hot%05d", "id").alias("fn"))
    members = ["hot", *(f"{k:03d}" for k in range(0, 1000, 7))]
    index = [("a.zip", k, m, 1, 1, 1, 0, 0, 0) for k, m in enumerate(members)]
    index = bf.materialize(spark.createDataFrame(index, INDEX_SCHEMA), "index")
    with skewed_joins(spark):
        found = bf.first_match(names, index, broadcast_bytes=0)
        assert {r.place.offset for r in found.collect()} == {0}
        plan = found._jdf.queryExecution().executedPlan().toString()
    assert "skew=true" in plan


def test_rows_of_hot_stretches_are_split_when_they_meet_their_parts(spark, make_zip):
    """A third of the rows want one stretch; the list of hot stretches is not broadcast."""
    asked, located = skewed(spark, make_zip, 60_000)
    placed = bf.materialize(
        located.select(F.uuid().alias("name"), F.col("filePath__at").alias("blob")).repartition(8), "placed"
    )
    with skewed_joins(spark):
        spread = spread_rows(placed, ["blob"], 14, 200 * (fetch.ROW_BYTES + 50), 1 << 20, 0)
        assert len(spread.collect()) == 60_000
        plan = spread._jdf.queryExecution().executedPlan().toString()
    assert "skew=true" in plan


@contextmanager
def skewed_joins(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_a_large_archive_is_read_by_many_tasks(spark, make_zip):
    path = make_zip([(f"m{i:03d}", bytes([i]) * 2000) for i in range(200)], compression=0)
    index = bf.index_of(spark, path)
    placed = index.select("member", F.struct(*fetch.PLACE_FIELDS).alias("content"))
    spread = spread_rows(placed, ["content"], 14, 40_000, 20_000)
    tasks = spread.select(F.spark_partition_id().alias("t"), F.col("content.offset").alias("at"))
    sizes = [r["count"] for r in tasks.groupBy("t").count().collect()]
    assert len(sizes) > 5 and sum(sizes) == 200
    stretches = tasks.groupBy(F.floor(F.col("at") / 20_000)).agg(F.count_distinct("t").alias("n"))
    assert stretches.agg(F.max("n")).first()[0] == 1
    got = attach_content(placed, ["content"], None, task_bytes=40_000, stretch_bytes=20_000)
    assert all(bytes(r.content) == bytes([int(r.member[1:])]) * 2000 for r in got.collect())


def test_content_is_never_shuffled_or_broadcast(spark, make_zip):
    resolved = bf.resolve_blobs(manifest(spark, "a", "b"), make_zip([("a", b"1")]), ["filePath"])
    plan = resolved._jdf.queryExecution().executedPlan().toString()
    above, below = plan.split("MapInArrow")
    assert "Exchange" not in above and "Join" not in plan
    assert below.count("Exchange") == 1


def test_output_is_cut_by_bytes(spark, make_zip, monkeypatch):
    monkeypatch.setattr(fetch, "OUTPUT_BYTES", 1500)
    path = make_zip([(f"m{i}", bytes([i]) * 1000) for i in range(9)])
    got = bf.archive_members(spark, path)
    assert {(r.member, bytes(r.content)) for r in got.collect()} == {
        (f"m{i}", bytes([i]) * 1000) for i in range(9)
    }


def test_limited_read_ends_early(spark, make_zip):
    path = make_zip([(f"m{i}", b"x") for i in range(500)])
    assert len(bf.archive_members(spark, path).limit(3).collect()) == 3


def test_member_of_many_file_names(spark, make_zip):
    """Thousands of file names contain one member's name."""
    path = make_zip([("a.txt", b"A"), ("b.txt", b"B")])
    rows = spark.range(5000).select(
        F.col("id").cast("string").alias("name"),
        F.concat(F.lit("x"), F.col("id").cast("string"), F.lit("a.txt")).alias("filePath"),
    )
    resolved = bf.resolve_blobs(rows, path, ["filePath"])
    assert resolved.where(F.col("filePath") == F.lit(b"A")).count() == 5000
    assert isinstance(resolved.schema["filePath"].dataType, T.BinaryType)


def two_columns(spark, make_zip, rows=600):
    """Two archives; the second column's members lie in the opposite order of the first one's."""
    one = make_zip([(f"a{i:04d}", b"a" * 20 + str(i).encode()) for i in range(rows)], "one.zip")
    two = make_zip([(f"b{i:04d}", b"b" * 20 + str(i).encode()) for i in range(rows)], "two.zip")
    manifest = spark.range(0, rows, 1, 4).selectExpr(
        "id", "if(id % 2 = 0, format_string('a%04d', id), null) as first",
        f"format_string('b%04d', {rows - 1} - id) as second",
    )
    want = {
        i: (b"a" * 20 + str(i).encode() if i % 2 == 0 else b"File Not Found",
            b"b" * 20 + str(rows - 1 - i).encode())
        for i in range(rows)
    }
    return manifest, [one, two], want


def test_every_column_is_read_in_its_own_order(spark, make_zip, tmp_path, monkeypatch):
    """Reads of an archive are counted in files, as they happen in other processes."""
    log = tmp_path / "log"
    log.mkdir()
    opened = store.Store.open

    def counted_open(self, uri):
        if uri not in self.files:
            (log / f"open-{uuid.uuid4().hex}").write_text(uri)
        handle = opened(self, uri)
        return CountedHandle(handle, uri, log) if uri.endswith(".zip") else handle

    manifest, archives, want = two_columns(spark, make_zip)
    located = bf.locate_blobs(manifest, archives, ["first", "second"], "exact")
    monkeypatch.setattr(store.Store, "open", counted_open)
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    try:
        rows = bf.read_located(located, ["first", "second"]).collect()
    finally:
        cloudpickle.unregister_pickle_by_value(sys.modules[__name__])
    assert {r.id: (bytes(r.first), bytes(r.second)) for r in rows} == want
    opens, reads = ([p.read_text() for p in log.glob(f"{kind}-*")] for kind in ("open", "read"))
    for archive in archives:
        assert opens.count(f"file:{archive}") <= 2
        assert reads.count(f"file:{archive}") <= 2


class CountedHandle:
    def __init__(self, handle, uri, log):
        self.handle, self.uri, self.log = handle, uri, log

    def read_at(self, count, at):
        (self.log / f"read-{uuid.uuid4().hex}").write_text(self.uri)
        return self.handle.read_at(count, at)


def test_large_members_of_a_second_column_are_not_shuffled(spark, make_zip):
    manifest, archives, want = two_columns(spark, make_zip, 60)
    located = bf.locate_blobs(manifest, archives, ["first", "second"], "exact")
    placed = located.select("id", F.col("first__at").alias("first"), F.col("second__at").alias("second"))
    for below, joins in ((0, 0), (1 << 20, 1)):
        got = attach_content(placed, ["first", "second"], gather_below=below)
        plan = got._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Join") == joins
        assert {r.id: (bytes(r.first), bytes(r.second)) for r in got.collect()} == want


def test_jobs_of_a_resolve(spark, make_zip):
    path = make_zip([(f"m{i}", str(i).encode()) for i in range(50)])
    asked = bf.materialize(spark.range(200).selectExpr("concat('m', id) as filePath"), "asked")
    spark.sparkContext.setJobGroup("resolve", "counted")
    try:
        resolved = bf.resolve_blobs(asked, path, ["filePath"], match="exact")
        resolved.write.parquet(bf.scratch_dir(spark, "resolved"))
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("resolve")
    finally:
        spark.sparkContext.setJobGroup("other", "not counted")
    assert len(jobs) <= 12


def test_scratch_is_released(spark, make_zip, table_name, tmp_path):
    def folders():
        base = spark.conf.get("spark.checkpoint.dir")
        return {name for name in os.listdir(base) if name.startswith("blobframe-")}

    csv = tmp_path / "kv.csv"
    csv.write_text("name,number,filePath\na,1,x\nb,2,none\n")
    path = make_zip([("x", b"1")])
    before = folders()
    args = (spark, str(csv), path, ["filePath"], table_name, ["number"], str(tmp_path / "t"))
    assert bf.load_blob_table(*args).count() == 2
    assert folders() == before
    with bf.release_scratch(spark):
        assert bf.resolve_blobs(bf.read_manifest(spark, str(csv)), path, ["filePath"]).count() == 2
        assert folders() > before
    assert folders() == before


def test_a_hot_stretch_is_split_by_the_merge_join_too(spark, make_zip):
    """The list of hot stretches is not broadcast; the rows of one of them are in many tasks."""
    asked, located = skewed(spark, make_zip, 6000)
    placed = located.select("name", F.col("filePath__at").alias("blob"))
    spread = spread_rows(placed, ["blob"], 14, 200 * (fetch.ROW_BYTES + 50), 1 << 20, 0)
    plan = spread._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" in plan and "broadcast" not in plan.lower()
    sizes = [r["count"] for r in spread.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 6000 and max(sizes) < 1500


def test_a_default_above_one_batch(spark, make_zip, monkeypatch):
    monkeypatch.setattr(fetch, "OUTPUT_BYTES", 100_000)
    path = make_zip([("x", b"1")])
    asked = spark.range(0, 500, 1, 1).selectExpr("id", "'none' as filePath")
    got = bf.resolve_blobs(asked, path, ["filePath"], match="exact", default=b"d" * 20_000)
    rows = got.select("id", F.octet_length("filePath").alias("n")).collect()
    assert {r.n for r in rows} == {20_000} and sorted(r.id for r in rows) == list(range(500))


def test_content_of_a_second_column_is_not_broadcast(spark, make_zip):
    manifest, archives, want = two_columns(spark, make_zip, 60)
    got = bf.resolve_blobs(manifest, archives, ["first", "second"], "exact")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert {r.id: (bytes(r.first), bytes(r.second)) for r in got.collect()} == want


def test_tasks_are_not_made_smaller_than_is_worth_their_start(spark, make_zip):
    """60,000 rows that put out 64 MB, with tasks of 1 KB asked for."""
    asked, located = skewed(spark, make_zip, 60_000)
    placed = located.select("name", F.col("filePath__at").alias("blob"))
    spread = spread_rows(placed, ["blob"], 14, 1 << 10, 1 << 20)
    cores = spark.sparkContext.defaultParallelism
    assert cores < spread.rdd.getNumPartitions() <= fetch.TASKS_PER_CORE * cores
    got = attach_content(placed, ["blob"], task_bytes=1 << 10)
    want = placed.select(F.coalesce(F.col("blob.size"), F.lit(len(bf.NOT_FOUND))).alias("n"))
    have = got.select(F.octet_length("blob").cast("long").alias("n"))
    assert sorted(map(tuple, have.groupBy("n").count().collect())) == sorted(
        map(tuple, want.groupBy("n").count().collect())
    )


def test_a_reading_task_holds_a_few_megabytes(spark, make_zip):
    """Members of 96 MB in all, in one batch."""
    path = make_zip([(f"m{i:02d}", bytes([i]) * (1 << 20)) for i in range(96)])
    index = bf.index_of(spark, path).orderBy("offset")
    batch = index.select(F.struct(*fetch.PLACE_FIELDS).alias("blob")).toArrow().combine_chunks().to_batches()
    tracemalloc.start()
    try:
        put_out = [part.num_rows for part in fetch.content_reader(["blob"], None, 1 << 30, {})(iter(batch))]
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert sum(put_out) == 96 and peak < 32 << 20
