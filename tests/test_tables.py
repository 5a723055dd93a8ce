import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

import blobframe as bf
from blobframe.sinks import tables

PEOPLE = "name;age;job\nAda;30;Developer\nBo;32;tester\nCy;32;Developer\nDi;32;devops\nEd;40;Developer\n"


@pytest.fixture
def people(spark, tmp_path):
    path = tmp_path / "people.csv"
    path.write_text(PEOPLE)
    return bf.read_manifest(spark, str(path), sep=";")


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_all_columns_are_strings(people):
    assert people.schema.simpleString() == "struct<name:string,age:string,job:string>"
    assert people.count() == 5


def test_life_of_a_table(spark, people, table_name, tmp_path):
    """Create, append, register value by value, list."""
    path = str(tmp_path / "t1")
    bf.ensure_table(spark, table_name, people.schema, ["job"], path)
    bf.append_files(people, ["job"], path)
    assert spark.table(table_name).count() == 0
    seen = []
    for row in bf.distinct_keys(people, ["job"]).orderBy("job").collect():
        bf.add_partition(spark, table_name, {"job": row.job})
        seen.append(spark.table(table_name).count())
    assert seen == [3, 4, 5]
    listed = bf.show_partitions(spark, table_name)
    assert rows_of(listed) == [("job=Developer",), ("job=devops",), ("job=tester",)]
    assert rows_of(bf.head_rows(spark.table(table_name))) == rows_of(people)
    assert bf.head_rows(spark.table(table_name), 2).count() == 2


def test_append_registers_everything_and_repeats_rows(spark, people, table_name, tmp_path):
    path = str(tmp_path / "t")
    once = bf.append_partitioned(people, table_name, ["job"], path)
    assert rows_of(once) == rows_of(people)
    twice = bf.append_partitioned(people, table_name, ["job"], path)
    assert rows_of(twice) == rows_of(people.union(people))
    described = bf.describe_table(spark, table_name)
    assert described["external"] and described["location"].endswith("/t")
    assert described["keys"] == [("job", "string")]


def test_a_later_append_registers_what_it_wrote(spark, people, table_name, tmp_path):
    path = str(tmp_path / "t")
    bf.append_partitioned(people.where("job = 'tester'"), table_name, ["job"], path)
    bf.append_files(people.where("job = 'devops'"), ["job"], path)
    stored = bf.append_partitioned(people.where("job = 'Developer'"), table_name, ["job"], path)
    assert rows_of(bf.show_partitions(spark, table_name)) == [("job=Developer",), ("job=tester",)]
    bf.add_partitions(spark, table_name)
    assert rows_of(spark.table(table_name)) == rows_of(people)
    assert stored.columns == people.columns


def test_append_without_keys(spark, people, table_name, tmp_path):
    for _ in range(2):
        stored = bf.append_partitioned(people, table_name, [], str(tmp_path / "t"))
    assert rows_of(stored) == rows_of(people.union(people))


def test_columns_are_matched_by_name(spark, people, table_name, tmp_path):
    path = str(tmp_path / "t")
    bf.append_partitioned(people, table_name, ["job"], path)
    stored = bf.append_partitioned(people.select("job", "age", "name"), table_name, ["job"], path)
    assert rows_of(stored) == rows_of(people.union(people))


def test_adding_a_partition_again_is_no_error(spark, people, table_name, tmp_path):
    bf.append_partitioned(people, table_name, ["job"], str(tmp_path / "t"))
    bf.add_partition(spark, table_name, {"job": "tester"})
    assert bf.show_partitions(spark, table_name).count() == 3


def test_partition_at_another_place(spark, people, table_name, tmp_path):
    bf.append_partitioned(people, table_name, ["job"], str(tmp_path / "t"))
    aside = str(tmp_path / "aside")
    people.limit(1).select(F.lit("Zoe").alias("name"), "age").write.parquet(aside)
    bf.add_partition(spark, table_name, {"job": "o'brien\\"}, location=aside)
    assert rows_of(spark.table(table_name).where("name = 'Zoe'").select("job")) == [("o'brien\\",)]


def test_odd_partition_values(spark, table_name, tmp_path):
    df = spark.createDataFrame(
        [(1, "Developer"), (2, "te/ster"), (3, None), (4, ""), (5, "a=b c%")], "id int, job string"
    )
    stored = bf.append_partitioned(df, table_name, ["job"], str(tmp_path / "t"))
    assert rows_of(stored.where("id < 3 or id = 5")) == [(1, "Developer"), (2, "te/ster"), (5, "a=b c%")]
    assert rows_of(stored.where("id in (3, 4)")) == [(3, None), (4, None)]
    assert "job=te%2Fster" in os.listdir(tmp_path / "t")


def test_keys_keep_their_own_order(spark, table_name, tmp_path):
    df = spark.createDataFrame([(1, "x", 7)], "a int, b string, c int")
    bf.append_partitioned(df, table_name, ["c", "a"], str(tmp_path / "t"))
    assert rows_of(bf.show_partitions(spark, table_name)) == [("c=7/a=1",)]
    assert spark.table(table_name).columns == ["b", "c", "a"]


def test_added_column_reads_null_in_old_files(spark, people, table_name, tmp_path):
    path = str(tmp_path / "t")
    bf.append_partitioned(people.drop("age"), table_name, ["job"], path)
    stored = bf.append_partitioned(people, table_name, ["job"], path)
    assert stored.where("age is null").count() == 5 and stored.where("age is not null").count() == 5


def test_other_changes_replace_the_definition_and_keep_the_data(spark, people, table_name, tmp_path):
    path = str(tmp_path / "t")
    bf.append_partitioned(people, table_name, ["job"], path)
    narrow = T.StructType([f for f in people.schema if f.name != "age"])
    bf.ensure_table(spark, table_name, narrow, ["job"], path)
    assert rows_of(spark.table(table_name)) == rows_of(people.select("name", "job"))
    moved = bf.append_partitioned(people, table_name, ["age"], str(tmp_path / "u"))
    assert rows_of(moved.select("name", "age", "job")) == rows_of(people)
    assert os.listdir(path)


def test_a_managed_table_is_not_replaced(spark, table_name, tmp_path):
    spark.range(3).write.saveAsTable(table_name)
    with pytest.raises(ValueError, match="not external"):
        bf.ensure_table(spark, table_name, T.StructType([T.StructField("x", T.StringType())]), [], str(tmp_path))
    with pytest.raises(ValueError, match="not external"):
        bf.append_partitioned(spark.range(2), table_name, [], str(tmp_path / "t"))
    assert spark.table(table_name).count() == 3 and not (tmp_path / "t").exists()


def test_replaced_before_there_is_data(spark, people, table_name, tmp_path):
    bf.append_partitioned(people, table_name, ["job"], str(tmp_path / "t"))
    bf.ensure_table(spark, table_name, people.schema, ["age"], str(tmp_path / "later"))
    assert spark.table(table_name).count() == 0


def test_same_definition_changes_nothing(spark, people, table_name, tmp_path):
    path = str(tmp_path / "t")
    bf.append_partitioned(people, table_name, ["job"], path)
    bf.ensure_table(spark, table_name, people.schema, ["job"], path)
    assert bf.show_partitions(spark, table_name).count() == 3


def test_unpartitioned_table(spark, people, table_name, tmp_path):
    path = str(tmp_path / "t")
    people.write.parquet(path)
    bf.ensure_table(spark, table_name, people.schema, [], path)
    assert rows_of(spark.table(table_name)) == rows_of(people)


def test_strict_types_fail_before_anything_is_written(spark, table_name, tmp_path):
    df = spark.sql("select 1 as a, date'2020-01-01' as d")
    with pytest.raises(TypeError, match="no type for d: "):
        bf.append_partitioned(df, table_name, ["a"], str(tmp_path / "t"), strict_types=True)
    assert not (tmp_path / "t").exists() and not bf.table_exists(spark, table_name)
    assert rows_of(bf.append_partitioned(df, table_name, ["a"], str(tmp_path / "t")).select("a")) == [(1,)]


def test_managed_append(spark, people, table_name, tmp_path):
    for _ in range(2):
        stored = bf.managed_append(people, table_name, ["job"], str(tmp_path / "t"))
    assert rows_of(stored) == rows_of(people.union(people))
    assert bf.describe_table(spark, table_name)["external"]
    assert bf.show_partitions(spark, table_name).count() == 3


def test_reads_are_pruned(spark, people, table_name, tmp_path):
    stored = bf.append_partitioned(people, table_name, ["job"], str(tmp_path / "t"))
    plan = stored.where("job = 'tester'").select("name")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(job" in plan and "ReadSchema: struct<name:string>" in plan
    keys = bf.distinct_keys(stored, ["job"])._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<>" in keys


def test_blob_table(spark, make_zip, table_name, tmp_path):
    csv = tmp_path / "kv.csv"
    csv.write_text("name,number,filePath\na,1,hive-site.xml\nb,2,x/people.csv\nc,1,none\n")
    path = make_zip([("hive-site.xml", b"<x/>"), ("people.csv", b"a;b")])
    stored = bf.load_blob_table(
        spark, str(csv), path, ["filePath"], table_name, ["number"], str(tmp_path / "t2")
    )
    assert {(r.name, bytes(r.filePath), r.number) for r in stored.collect()} == {
        ("a", b"<x/>", "1"),
        ("b", b"a;b", "2"),
        ("c", b"File Not Found", "1"),
    }
    assert stored.columns == ["name", "filePath", "number"]
    assert rows_of(bf.show_partitions(spark, table_name)) == [("number=1",), ("number=2",)]


def many_keys(spark, make_zip, tmp_path, rows=2000, keys=50):
    csv = tmp_path / "many.csv"
    lines = [f"r{i},{i % keys},m{i % 40}" for i in range(rows)]
    csv.write_text("name,number,filePath\n" + "\n".join(lines) + "\n")
    return str(csv), make_zip([(f"m{i}", str(i).encode() * 50) for i in range(40)])


def files_of(folder):
    return {
        name: [file for file in os.listdir(folder / name) if file.endswith(".parquet")]
        for name in os.listdir(folder)
        if "=" in name
    }


def test_a_partition_gets_one_file_for_a_task_of_content(spark, make_zip, table_name, tmp_path):
    csv, archive = many_keys(spark, make_zip, tmp_path)
    folder = tmp_path / "blobs"
    args = (spark, csv, archive, ["filePath"], table_name, ["number"], str(folder))
    stored = bf.load_blob_table(*args, match="exact")
    assert [len(f) for f in files_of(folder).values()] == [1] * 50
    assert stored.count() == 2000
    bf.load_blob_table(*args, match="exact")  # the second append inserts into the table
    assert [len(f) for f in files_of(folder).values()] == [2] * 50
    counts = stored.groupBy("number").agg(F.count("*"), F.min(F.octet_length("filePath"))).collect()
    assert {r[1] for r in counts} == {80} and min(r[2] for r in counts) == 50


def test_a_hot_partition_gets_several_files(spark, make_zip, table_name, tmp_path):
    csv = tmp_path / "hot.csv"
    lines = [f"r{i},{'hot' if i % 3 else i % 30},{'m7' if i % 2 else f'm{i % 40}'}" for i in range(3000)]
    csv.write_text("name,number,filePath\n" + "\n".join(lines) + "\n")
    archive = make_zip([(f"m{i}", str(i).encode() * 50) for i in range(40)])
    folder = tmp_path / "blobs"
    stored = bf.load_blob_table(
        spark, str(csv), archive, ["filePath"], table_name, ["number"], str(folder), match="exact",
        task_bytes=400 * 1100,
    )
    found = files_of(folder)
    assert len(found.pop("number=hot")) >= 4
    assert all(len(files) == 1 for files in found.values())
    assert stored.count() == 3000


def test_content_is_not_sorted_for_the_write(spark, make_zip, table_name, tmp_path):
    csv, archive = many_keys(spark, make_zip, tmp_path, 200)
    args = (spark, csv, archive, ["filePath"], table_name, ["number"], str(tmp_path / "t"))
    bf.load_blob_table(*args)
    rows = bf.resolve_blobs(bf.read_manifest(spark, csv), archive, ["filePath"], gather_by=["number"])
    rows.select("name", "filePath", "number").createOrReplaceTempView("resolved")
    with tables.partition_writers(spark):
        plan = spark.sql(f"EXPLAIN INSERT INTO {table_name} SELECT * FROM resolved").first()[0]
    assert "Sort" not in plan.partition("MapInArrow")[0]
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters", "0") == "0"


def test_small_rows_are_gathered_for_a_partitioned_append(spark, table_name, tmp_path):
    rows = spark.range(0, 4000, 1, 16).selectExpr("id", "id % 50 as k")
    bf.append_partitioned(rows, table_name, ["k"], str(tmp_path / "t"))
    assert [len(f) for f in files_of(tmp_path / "t").values()] == [1] * 50
    bf.append_files(rows, ["k"], str(tmp_path / "u"), gather=False)
    assert sum(len(f) for f in files_of(tmp_path / "u").values()) > 500


def test_nested_types_with_odd_names(spark, table_name, tmp_path):
    rows = spark.sql(
        "select 1 as k, named_struct('a b', 1, 'c`d', array(named_struct('x,y', 'z'))) as s, "
        "map('m', named_struct('a:b', 2)) as m"
    )
    stored = bf.append_partitioned(rows, table_name, ["k"], str(tmp_path / "t"))
    assert stored.select("k", "s", "m").collect() == rows.collect()
    again = bf.append_partitioned(rows, table_name, ["k"], str(tmp_path / "t"))
    assert again.count() == 2


def test_a_refused_definition_leaves_no_data(spark, table_name, tmp_path):
    rows = spark.sql("select 1 as a, 2 as k")
    for _ in range(2):
        with pytest.raises(AnalysisException):
            bf.append_partitioned(rows, "no_such_database.t", ["k"], str(tmp_path / "t"))
    assert not (tmp_path / "t").exists()
    assert bf.append_partitioned(rows, table_name, ["k"], str(tmp_path / "t")).count() == 1


def test_a_failed_write_keeps_the_old_definition(spark, table_name, tmp_path):
    old = bf.append_partitioned(spark.sql("select 1 as a, 2 as k"), table_name, ["k"], str(tmp_path / "t"))
    bad = spark.sql("select cast(raise_error('no') as string) as b, 2 as k")
    before = {t.name for t in spark.catalog.listTables("default")}
    with pytest.raises(Exception, match="no"):
        bf.append_partitioned(bad, table_name, ["k"], str(tmp_path / "u"))
    assert {t.name for t in spark.catalog.listTables("default")} == before
    assert [tuple(r) for r in spark.table(table_name).collect()] == [(1, 2)] and old.count() == 1
