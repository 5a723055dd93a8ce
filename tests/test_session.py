import pyarrow.fs as pafs
import pytest

import blobframe as bf
from blobframe.session import store_options
from blobframe.sources.store import Store, inner_path, open_system, qualify


def test_object_store_conf():
    conf = bf.object_store_conf("key", "secret", "http://localhost:9", path_style=True)
    assert conf == {
        "spark.hadoop.fs.s3a.access.key": "key",
        "spark.hadoop.fs.s3a.secret.key": "secret",
        "spark.hadoop.fs.s3a.endpoint": "http://localhost:9",
        "spark.hadoop.fs.s3a.path.style.access": "true",
    }
    assert bf.object_store_conf() == {"spark.hadoop.fs.s3a.path.style.access": "false"}
    with pytest.raises(ValueError):
        bf.object_store_conf(access_key="key")


def test_tasks_get_the_store_settings(spark):
    for key, value in bf.object_store_conf("key", "secret", "http://localhost:9", True).items():
        spark.conf.set(key, value)
    try:
        options = store_options(spark)
    finally:
        for key in bf.object_store_conf("key", "secret", "http://localhost:9", True):
            spark.conf.unset(key)
    assert options == {
        "access_key": "key",
        "secret_key": "secret",
        "endpoint": "http://localhost:9",
        "path_style": "true",
    }
    assert isinstance(open_system("s3a://bucket/key", options), pafs.S3FileSystem)
    assert store_options(spark) == {}


@pytest.mark.parametrize(
    "uri, path",
    [
        ("file:/tmp/a b.zip", "/tmp/a b.zip"),
        ("file:///tmp/a", "/tmp/a"),
        ("s3a://bucket/k/a.zip", "bucket/k/a.zip"),
        ("hdfs://host:8020/k/a.zip", "/k/a.zip"),
        ("hdfs:///k/a.zip", "/k/a.zip"),
    ],
)
def test_path_inside_the_store(uri, path):
    assert inner_path(uri) == path


def test_qualify(spark):
    assert qualify(spark, "/tmp/x") == "file:/tmp/x"
    assert qualify(spark, "file:/tmp/x y") == "file:/tmp/x y"


def test_few_handles_stay_open(tmp_path):
    paths = []
    for i in range(20):
        (tmp_path / str(i)).write_bytes(str(i).encode())
        paths.append(f"file:{tmp_path}/{i}")
    with Store({}) as store:
        first = store.open(paths[0])
        assert [store.open(p).read_at(9, 0) for p in paths] == [str(i).encode() for i in range(20)]
        assert first.closed and len(store.files) == 8
        last = store.open(paths[-1])
    assert last.closed


def test_scratch_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    one, two = bf.scratch_dir(spark, "x"), bf.scratch_dir(spark, "x")
    assert one != two and one.startswith(base) and one.endswith("/x")


def test_stored_rows_come_back(spark):
    df = spark.range(10).selectExpr("id", "struct(id as a, 'x' as b) as s")
    stored = bf.materialize(df, "rows")
    assert sorted(stored.collect()) == sorted(df.collect())
    assert "Range" not in stored._jdf.queryExecution().executedPlan().toString()


def test_session_settings(spark):
    session = bf.build_session({"spark.sql.shuffle.partitions": "4"})
    assert session.conf.get("spark.sql.session.timeZone") == "UTC"
    assert session.conf.get("spark.sql.adaptive.enabled") == "true"
