"""

Every query first brings a given table into the form its operator reads (a manifest file, packed
archives, exported files, a partitioned table) and runs the operator over all of it. Contents are
returned as hashes, since binary columns are poor to compare.
"""

from __future__ import annotations

import os
import sys
import uuid
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.errors import AnalysisException  # noqa: E402
from pyspark.sql import Column, DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

import blobframe as bf  # noqa: E402

try:  # the corpus operators can be left out
    import corpus_pipeline  # noqa: E402
    from blobframe.llm import queries as corpus  # noqa: E402
except ImportError:
    corpus = corpus_pipeline = None


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def new_table() -> str:
    return f"default.t_{uuid.uuid4().hex}"


def sha(column: str | Column) -> Column:
    return F.sha2(F.col(column) if isinstance(column, str) else column, 256)


def micros(column: str) -> Column:
    return F.expr(f"timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', {column})")


def file_name(prefix: str, number: str | Column, suffix: str) -> Column:
    number = F.col(number) if isinstance(number, str) else number
    return F.concat(F.lit(prefix), number.cast("string"), F.lit(suffix))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return docs.withColumn("name", file_name("doc_", "doc_id", ".txt"))


def asked(docs: DataFrame, prefix: str = "", suffix: str = "") -> DataFrame:
    """``doc_id, lang, filePath``: every document is asked for, and beside it a name nobody bears."""
    paths = F.array(
        F.concat(F.lit(prefix), "name", F.lit(suffix)), file_name(f"{prefix}gone_", "doc_id", ".bin")
    )
    return docs.select("doc_id", "lang", F.explode(paths).alias("filePath"))


def packed(df: DataFrame, content: str = "text", **options) -> str:
    """Pack the rows (``name`` and ``content``) into archives; returns their folder.

    A small table is one partition of Parquet, so the rows are spread first.
    """
    folder = bf.scratch_dir(df.sparkSession, "archives")
    options.setdefault("shards", df.sparkSession.sparkContext.defaultParallelism)
    bf.pack_blobs(df, "name", content, folder, **options)
    return folder


def shard_of(archive: str) -> Column:
    return F.regexp_extract(bf.basename_col(archive), r"^part-(.*)-\d+-\d+(?:\.retry\d+)?\.zip$", 1)


def manifest_file(df: DataFrame, sep: str = ",") -> str:
    path = bf.scratch_dir(df.sparkSession, "manifest")
    df.write.option("header", True).option("sep", sep).csv(path)
    return path


# Scans


def manifest_scan(spark, sf_dir):
    rows = table(spark, sf_dir, "customer")
    return bf.read_manifest(spark, manifest_file(rows))


def delimited_scan(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_size")
    return bf.read_manifest(spark, manifest_file(rows, ";"), sep=";")


def control_character_scan(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    path = bf.scratch_dir(spark, "pairs")
    rows.write.option("sep", "\x01").csv(path)
    return bf.read_manifest(
        spark, path, sep="\x01", schema="o_orderkey long, o_orderpriority string", header=False
    )


def blob_scan(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").withColumn("name", file_name("page_", "page_id", ".html"))
    folder = bf.scratch_dir(spark, "pages")
    bf.export_blobs(pages, "name", "html", folder)
    files = bf.scan_blobs(spark, folder, glob="*.html")
    return files.select(
        bf.basename_col("path").alias("name"),
        F.col("length").alias("n_bytes"),
        sha("content").alias("sha"),
    )


def blob_scan_all_names(spark, sf_dir):
    """Names that begin with a letter, ``_`` and ``.`` in turn; every fifth file is empty."""
    turn = (F.col("page_id") % 3).cast("int")
    pages = table(spark, sf_dir, "pages").select(
        F.concat(F.substr(F.lit("p_."), turn + 1, F.lit(1)), F.col("page_id").cast("string")).alias("name"),
        F.when(F.col("page_id") % 5 == 0, "").otherwise(F.col("html")).alias("html"),
    )
    folder = bf.scratch_dir(spark, "pages")
    bf.export_blobs(pages, "name", "html", folder)
    files = bf.scan_blobs(spark, folder)
    return files.select(
        bf.basename_col("path").alias("name"),
        F.col("length").alias("n_bytes"),
        sha("content").alias("sha"),
    )


def listed_tree(spark, sf_dir):
    """A tree of folders, some hidden, with a file for every page."""
    number = F.col("page_id")
    folder = F.concat_ws(
        "/", F.concat(F.lit("d"), F.floor(number / 50).cast("string")),
        F.when(number % 2 == 0, "_even").otherwise(".odd"),
    )
    pages = table(spark, sf_dir, "pages").withColumn("folder", folder)
    path = bf.scratch_dir(spark, "tree")
    bf.export_blobs(pages.withColumn("name", F.concat_ws("/", "folder", number)), "name", "html", path)
    files = bf.list_blobs(spark, path, recursive=True)
    return files.select(
        F.substring_index("path", "/", -3).alias("name"), F.col("length").alias("n_bytes")
    )


def refreshed_index(spark, sf_dir):
    """The archives of one folder are replaced, another folder's are new: the index follows."""
    docs, store = documents(spark, sf_dir), bf.scratch_dir(spark, "index")
    first = packed(docs)
    bf.refresh_index(spark, first, store)
    bf.pack_blobs(docs.withColumn("text", F.concat("text", F.lit("!"))), "name", "text", first)
    pages = table(spark, sf_dir, "pages").withColumn("name", file_name("page_", "page_id", ".html"))
    second = packed(pages, "html")
    return bf.refresh_index(spark, [first, second], store).select("member", "size")


def archive_index(spark, sf_dir):
    files = bf.list_archives(spark, packed(documents(spark, sf_dir)), glob="*.zip")
    return bf.archive_index(files).select("member", "size")


def stream_order(spark, sf_dir):
    """Names in stream order; the archives were packed in the order of (lang, name)."""
    folder = packed(documents(spark, sf_dir), shard_col="lang")
    index = bf.archive_index(bf.list_archives(spark, folder))
    by_shard = index.groupBy(shard_of("archive").alias("lang")).agg(
        F.min(F.struct("archive", "offset", "member"))["member"].alias("first_member"),
        F.max(F.struct("archive", "offset", "member"))["member"].alias("last_member"),
        F.count("*").alias("members"),
    )
    return by_shard


def archive_members(spark, sf_dir):
    members = bf.archive_members(spark, packed(documents(spark, sf_dir)))
    return members.select("member", "size", sha("content").alias("sha"))


def member_lookup(spark, sf_dir):
    names = table(spark, sf_dir, "labels").select(
        file_name("doc_", "doc_id", ".txt").alias("member")
    )
    found = bf.lookup_members(names, packed(documents(spark, sf_dir)))
    return found.select("member", sha("content").alias("sha"))


def fetch_members(spark, sf_dir):
    """Members of the archives that hold labelled documents, picked from the stored index."""
    index = bf.index_of(spark, packed(documents(spark, sf_dir)))
    names = table(spark, sf_dir, "labels").select(
        file_name("doc_", "doc_id", ".txt").alias("member")
    )
    wanted = index.join(names, "member", "left_semi")
    found = bf.fetch_members(spark, index, wanted)
    return found.select("member", "size", sha("content").alias("sha"))


# Resolving


def resolve_exact(spark, sf_dir):
    docs = documents(spark, sf_dir)
    manifest = asked(docs, "in/box/").withColumn("asked", F.col("filePath"))
    resolved = bf.resolve_blobs(manifest, packed(docs), ["filePath"], match="exact")
    return resolved.select("doc_id", "asked", sha("filePath").alias("sha"))


def resolve_odd_shards(spark, sf_dir):
    """Shard values that begin with ``_`` and ``.``: no archive and no document gets lost."""
    docs = documents(spark, sf_dir)
    mark = F.when(F.col("doc_id") % 2 == 0, "_").otherwise(".")
    folder = packed(docs.withColumn("shard", F.concat(mark, "lang")), shard_col="shard")
    manifest = docs.select("doc_id", F.col("name").alias("filePath"))
    resolved = bf.resolve_blobs(manifest, folder, ["filePath"], match="exact", status_col="status")
    return resolved.select("doc_id", "status", sha("filePath").alias("sha"))


def resolve_large_default(spark, sf_dir):
    """Every document is asked for twice, once in vain; a missing one gets 60,000 bytes."""
    docs = documents(spark, sf_dir)
    wanted = F.explode(F.array("name", F.concat("name", F.lit(".lost"))))
    manifest = docs.select("doc_id", wanted.alias("filePath"))
    resolved = bf.resolve_blobs(
        manifest.withColumn("asked", F.col("filePath")),
        packed(docs), ["filePath"], match="exact", default=b"x" * 60_000,
    )
    return resolved.select("doc_id", "asked", sha("filePath").alias("sha"))


def resolve_contains_shuffled(spark, sf_dir):
    """:func:`resolve_contains` by the plan for sides too large to broadcast."""
    return resolve_contains(spark, sf_dir, broadcast_bytes=0)


def resolve_contains(spark, sf_dir, **options):
    """Members ``7.txt`` and ``17.txt`` both answer to ``doc_17.txt.bak``; the first one counts."""
    docs = documents(spark, sf_dir)
    folder = packed(docs.withColumn("name", file_name("", "doc_id", ".txt")), shard_col="lang")
    manifest = asked(docs, "in/box/", ".bak").withColumn("asked", F.col("filePath"))
    resolved = bf.resolve_blobs(manifest, folder, ["filePath"], **options)
    return resolved.select("doc_id", "asked", sha("filePath").alias("sha"))


def resolve_repeated_spread(spark, sf_dir):
    """:func:`resolve_repeated` with tasks of 64 KB, so that stretches are cut in parts."""
    return resolve_repeated(spark, sf_dir, task_bytes=1 << 16)


def resolve_repeated(spark, sf_dir, **options):
    """Many rows per blob: each event asks for the document of its user."""
    manifest = table(spark, sf_dir, "events").select(
        "event_id", file_name("users/doc_", "user_id", ".txt").alias("filePath")
    )
    resolved = bf.resolve_blobs(manifest, packed(documents(spark, sf_dir)), ["filePath"], **options)
    return resolved.select("event_id", sha("filePath").alias("sha"))


def resolve_status(spark, sf_dir):
    docs = documents(spark, sf_dir)
    manifest = asked(docs).withColumn("filePath", F.when(F.col("lang") != "es", F.col("filePath")))
    resolved = bf.resolve_blobs(
        manifest, packed(docs), ["filePath"], match="exact", default=None, status_col="status"
    )
    return resolved.select("doc_id", "status", sha("filePath").alias("sha"))


def resolve_two_columns(spark, sf_dir, first="name"):
    docs = documents(spark, sf_dir)
    pages = table(spark, sf_dir, "pages").select(
        file_name("page_", "page_id", ".html").alias("name"), F.col("html").alias("text")
    )
    folder = packed(docs.select("name", "text").union(pages))
    manifest = docs.select(
        F.expr(first).alias("name"), "lang", "doc_id", file_name("p/page_", "doc_id", ".html").alias("page")
    )
    resolved = bf.resolve_blobs(manifest, folder, ["name", "page"])
    return resolved.select("lang", "doc_id", sha("name").alias("text_sha"), sha("page").alias("page_sha"))


def resolve_second_column(spark, sf_dir):
    """:func:`resolve_two_columns` with nothing asked for in the first column by every other row."""
    return resolve_two_columns(spark, sf_dir, "CASE WHEN doc_id % 2 = 0 THEN name END")


def locate_blobs(spark, sf_dir):
    """Places only: how many bytes each row would get."""
    docs = documents(spark, sf_dir)
    located = bf.locate_blobs(asked(docs), packed(docs), ["filePath"], status_col="status")
    n_bytes = F.coalesce(F.col("filePath__at.size"), F.lit(0)).alias("n_bytes")
    return located.select("doc_id", "status", n_bytes)


# Names and schemas


def basename(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return pages.select("page_id", bf.basename_col("url").alias("name"))


def derive_name(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    named = bf.derive_name(orders, "${o_orderkey}_${o_orderstatus}.jpg", "name")
    return named.select("o_orderkey", "name")


def retype_schema(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    schema = bf.with_binary_columns(docs.schema, ["text", "no_such_column"])
    schema = bf.schema_from_json(bf.schema_to_json(schema))
    retyped = docs.select(*(F.col(f.name).cast(f.dataType) for f in schema.fields))
    return retyped.select(
        "doc_id",
        F.typeof("text").alias("text_type"),
        F.typeof("lang").alias("lang_type"),
        F.octet_length("text").cast("long").alias("n_bytes"),
        sha("text").alias("sha"),
    )


def catalog_types(spark, sf_dir):
    """Each column's catalog type and role, with the number of its values in the table."""
    lines = table(spark, sf_dir, "lineitem")
    odd = F.struct(F.col("l_linenumber").alias("a b"), F.col("l_tax").alias("c`d"))
    lines = lines.withColumns(
        {"odd": odd, "odds": F.array(odd), "odd map": F.create_map("l_shipdate", F.array(odd))}
    )
    keys = ["l_returnflag", "l_linestatus"]
    stored = bf.append_partitioned(lines, new_table(), keys, bf.scratch_dir(spark, "lines"))
    data, partition = bf.split_schema(lines.schema, keys)
    values = stored.agg(*(F.count(f"`{name}`").alias(name) for name in lines.columns))
    rows = [
        F.struct(
            F.lit(field.name).alias("name"),
            F.lit(bf.catalog_type(field)).alias("type"),
            F.lit(field in partition).alias("is_partition"),
            F.col(f"`{field.name}`").alias("n_values"),
        )
        for field in data + partition
    ]
    return values.select(F.inline(F.array(*rows)))


# Tables


def event_rows(df: DataFrame) -> DataFrame:
    return df.select(
        "event_id", "user_id", "event_type", "value", "props", micros("ts").alias("ts_us")
    )


def events_table(spark, sf_dir) -> str:
    name = new_table()
    events = table(spark, sf_dir, "events")
    bf.append_partitioned(events, name, ["event_type"], bf.scratch_dir(spark, "events"))
    return name


def partitioned_append(spark, sf_dir):
    return event_rows(spark.table(events_table(spark, sf_dir)))


def append_twice(spark, sf_dir):
    name, path = new_table(), bf.scratch_dir(spark, "events")
    events = table(spark, sf_dir, "events")
    for _ in range(2):
        stored = bf.append_partitioned(events, name, ["event_type"], path)
    return event_rows(stored)


def single_partition(spark, sf_dir):
    """All data is written, one partition is registered: the table shows that one."""
    events = table(spark, sf_dir, "events")
    name, path = new_table(), bf.scratch_dir(spark, "events")
    bf.append_files(events, ["event_type"], path)
    bf.ensure_table(spark, name, events.schema, ["event_type"], path)
    bf.add_partition(spark, name, {"event_type": "click"})
    return event_rows(spark.table(name))


def described_table(spark, sf_dir):
    """What the catalog says about a table, each column with the number of its values."""
    name = events_table(spark, sf_dir)
    said = bf.describe_table(spark, name)
    values = spark.table(name).agg(*(F.count(column).alias(column) for column, _ in said["data"] + said["keys"]))
    rows = [
        F.struct(
            F.lit(column).alias("name"),
            F.lit(kind).alias("type"),
            F.lit(number >= len(said["data"])).alias("is_partition"),
            F.lit(bf.table_exists(spark, name) and said["external"]).alias("is_external"),
            F.col(column).alias("n_values"),
        )
        for number, (column, kind) in enumerate(said["data"] + said["keys"])
    ]
    return values.select(F.inline(F.array(*rows)))


def show_partitions(spark, sf_dir):
    return bf.show_partitions(spark, events_table(spark, sf_dir))


def distinct_keys(spark, sf_dir):
    return bf.distinct_keys(spark.table(events_table(spark, sf_dir)), ["event_type"])


def pruned_read(spark, sf_dir):
    stored = spark.sql(f"SELECT * FROM {events_table(spark, sf_dir)} WHERE event_type = 'purchase'")
    return event_rows(stored)


def managed_append(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    return bf.managed_append(
        orders, new_table(), ["o_orderstatus"], bf.scratch_dir(spark, "orders")
    )


def failed_append(spark, sf_dir):
    """The catalog refuses the first attempt, which leaves nothing for the second one to double."""
    events, path = table(spark, sf_dir, "events"), bf.scratch_dir(spark, "events")
    try:
        bf.append_partitioned(events, f"none_{uuid.uuid4().hex}.events", ["event_type"], path)
    except AnalysisException:
        pass
    return event_rows(bf.append_partitioned(events, new_table(), ["event_type"], path))


def evolve_table(spark, sf_dir):
    """The second append brings a column the first one did not have."""
    suppliers = table(spark, sf_dir, "supplier")
    name, path = new_table(), bf.scratch_dir(spark, "suppliers")
    bf.append_partitioned(suppliers.drop("s_acctbal"), name, ["s_nationkey"], path)
    stored = bf.append_partitioned(suppliers, name, ["s_nationkey"], path)
    return stored.select("s_suppkey", "s_name", "s_acctbal", "s_nationkey")


def replace_table(spark, sf_dir):
    """The table is defined anew: other columns, other partitioning, another place."""
    customers = table(spark, sf_dir, "customer")
    name = new_table()
    first = customers.select("c_custkey", "c_acctbal", "c_mktsegment")
    bf.append_partitioned(first, name, ["c_mktsegment"], bf.scratch_dir(spark, "first"))
    second = customers.select("c_name", "c_custkey", "c_nationkey")
    return bf.append_partitioned(second, name, ["c_nationkey"], bf.scratch_dir(spark, "second"))


def table_head(spark, sf_dir):
    ordered = table(spark, sf_dir, "orders").orderBy("o_orderkey")
    return bf.head_rows(ordered.select("o_orderkey", "o_custkey", "o_orderstatus"), 100)


# Files


def export_blobs(spark, sf_dir):
    written = bf.export_blobs(
        documents(spark, sf_dir), "name", "text", bf.scratch_dir(spark, "texts")
    )
    return written.select("name", "n_bytes")


def export_last(spark, sf_dir):
    """Every turn of a conversation goes to the conversation's file; the last one stays."""
    turns = table(spark, sf_dir, "conversations").withColumn(
        "name", file_name("conv_", "conv_id", ".txt")
    )
    folder = bf.scratch_dir(spark, "turns")
    bf.export_blobs(turns, "name", "text", folder, on_duplicate="last", order_by="turn")
    files = bf.scan_blobs(spark, folder)
    return files.select(bf.basename_col("path").alias("name"), sha("content").alias("sha"))


def export_manifest(spark, sf_dir):
    """Each event writes the document of its user to the user's file; the last event counts."""
    manifest = table(spark, sf_dir, "events").select(
        "event_id",
        file_name("user_", "user_id", ".txt").alias("name"),
        file_name("users/doc_", "user_id", ".txt").alias("filePath"),
    )
    folder = bf.scratch_dir(spark, "users")
    archives = packed(documents(spark, sf_dir))
    bf.export_manifest(
        spark, manifest, archives, "name", "filePath", folder, order_by="event_id"
    )
    files = bf.scan_blobs(spark, folder, glob="user_*")
    return files.select(bf.basename_col("path").alias("name"), sha("content").alias("sha"))


def pack_blobs(spark, sf_dir):
    archives = bf.pack_blobs(
        documents(spark, sf_dir),
        "name",
        "text",
        bf.scratch_dir(spark, "archives"),
        shard_col="source",
        max_archive_bytes=1 << 20,
    )
    return archives.groupBy(shard_of("archive").alias("source")).agg(
        F.sum("n_members").alias("n_members"), F.sum("n_bytes").alias("n_bytes")
    )


def pack_twice(spark, sf_dir):
    """The second packing of a folder takes the place of the first one."""
    docs, folder = documents(spark, sf_dir), bf.scratch_dir(spark, "archives")
    bf.pack_blobs(docs.withColumn("name", F.concat(F.lit("old_"), "name")), "name", "text", folder)
    bf.pack_blobs(docs, "name", "text", folder, shard_col="lang", task_bytes=1 << 20)
    members = bf.archive_members(spark, folder)
    return members.select("member", "size", sha("content").alias("sha"))


def pack_manifest(spark, sf_dir):
    """From archives to other archives, by language: places are sorted, not content."""
    docs, folder = documents(spark, sf_dir), bf.scratch_dir(spark, "archives")
    manifest = asked(docs).withColumn("member", F.col("filePath"))
    bf.pack_manifest(
        spark, manifest, packed(docs), "member", "filePath", folder, "lang", match="exact",
        task_bytes=1 << 20,
    )
    members = bf.archive_members(spark, folder)
    return members.select(
        shard_of("archive").alias("lang"), "member", "size", sha("content").alias("sha")
    )


def blob_table(spark, sf_dir):
    """Manifest file to catalog table: scan, resolve, append, register, read."""
    stored = stored_blobs(spark, sf_dir)
    return stored.select(
        F.col("doc_id").cast("long").alias("doc_id"), "lang", sha("filePath").alias("sha")
    )


def stored_blobs(spark, sf_dir):
    docs = documents(spark, sf_dir)
    return bf.load_blob_table(
        spark,
        manifest_file(asked(docs, "in/box/")),
        packed(docs),
        columns=["filePath"],
        table=new_table(),
        keys=["lang"],
        path=bf.scratch_dir(spark, "blobs"),
    )


def files_per_partition(spark, sf_dir):
    """The rows of a partition come together before their content is read, so they fill one file."""
    stored = stored_blobs(spark, sf_dir).select("lang", F.input_file_name().alias("file"))
    return stored.groupBy("lang").agg(F.count_distinct("file").alias("n_files"))


def entry(spark: SparkSession) -> DataFrame:
    return blob_table(spark, "/root/testdata/sf0.001")


QUERIES = [
    manifest_scan,
    delimited_scan,
    control_character_scan,
    blob_scan,
    blob_scan_all_names,
    listed_tree,
    archive_index,
    refreshed_index,
    stream_order,
    archive_members,
    member_lookup,
    fetch_members,
    resolve_exact,
    resolve_contains,
    resolve_contains_shuffled,
    resolve_odd_shards,
    resolve_large_default,
    resolve_repeated,
    resolve_repeated_spread,
    resolve_status,
    resolve_two_columns,
    resolve_second_column,
    locate_blobs,
    basename,
    derive_name,
    retype_schema,
    catalog_types,
    partitioned_append,
    append_twice,
    single_partition,
    described_table,
    show_partitions,
    distinct_keys,
    pruned_read,
    managed_append,
    failed_append,
    evolve_table,
    replace_table,
    table_head,
    export_blobs,
    export_last,
    export_manifest,
    pack_blobs,
    pack_twice,
    pack_manifest,
    blob_table,
    files_per_partition,
]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {query.__name__: query for query in QUERIES}
    if corpus is not None:
        found |= {"pipeline": corpus_pipeline.run, **corpus.QUERIES}
    return found


EVENT_ROWS = "event_id, user_id, event_type, value, props, epoch_us(ts) AS ts_us"
LABELLED = "(SELECT * FROM documents WHERE doc_id IN (SELECT doc_id FROM labels))"
EVENT_TYPES = {
    "event_id": "bigint",
    "ts": "timestamp_ntz",
    "user_id": "bigint",
    "event_type": "string",
    "value": "double",
    "props": "string",
}
GONE = "sha256('File Not Found')"
ODD = "struct<`a b`: int, `c``d`: double>"
LINEITEM_TYPES = {
    "l_orderkey": "bigint",
    "l_partkey": "bigint",
    "l_suppkey": "bigint",
    "l_linenumber": "int",
    "l_quantity": "double",
    "l_extendedprice": "double",
    "l_discount": "double",
    "l_tax": "double",
    "l_returnflag": "string",
    "l_linestatus": "string",
    "l_shipdate": "timestamp_ntz",
    "odd": ODD,
    "odds": f"array<{ODD}>",
    "odd map": f"map<timestamp_ntz, array<{ODD}>>",
}


def oracle_sql() -> dict[str, str]:
    found = table_sql()
    if corpus is not None:
        found |= corpus.ORACLE_SQL
    return found


def table_sql() -> dict[str, str]:
    found = plain_sql()
    for query in ("resolve_contains_shuffled", "resolve_repeated_spread"):
        found[query] = found[query.rpartition("_")[0]]  # another plan, the same rows
    return found


def plain_sql() -> dict[str, str]:
    doc_name = "'doc_' || doc_id || '.txt'"
    return {
        "manifest_scan": """
            SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name,
                   CAST(c_nationkey AS VARCHAR) AS c_nationkey,
                   CAST(c_acctbal AS VARCHAR) AS c_acctbal, c_mktsegment
            FROM customer""",
        "delimited_scan": """
            SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, p_brand,
                   CAST(p_size AS VARCHAR) AS p_size
            FROM part""",
        "control_character_scan": "SELECT o_orderkey, o_orderpriority FROM orders",
        "blob_scan": """
            SELECT 'page_' || page_id || '.html' AS name, octet_length(encode(html)) AS n_bytes,
                   sha256(html) AS sha
            FROM pages""",
        "blob_scan_all_names": """
            SELECT substr('p_.', CAST(page_id % 3 AS INT) + 1, 1) || page_id AS name,
                   CASE WHEN page_id % 5 = 0 THEN 0 ELSE octet_length(encode(html)) END AS n_bytes,
                   sha256(CASE WHEN page_id % 5 = 0 THEN '' ELSE html END) AS sha
            FROM pages""",
        "resolve_odd_shards": """
            SELECT doc_id, 'found' AS status, sha256(text) AS sha FROM documents""",
        "resolve_large_default": f"""
            SELECT doc_id, {doc_name} AS asked, sha256(text) AS sha FROM documents
            UNION ALL
            SELECT doc_id, {doc_name} || '.lost', sha256(repeat('x', 60000)) FROM documents""",
        "listed_tree": """
            SELECT 'd' || CAST(floor(page_id / 50) AS BIGINT)
                   || CASE WHEN page_id % 2 = 0 THEN '/_even/' ELSE '/.odd/' END || page_id AS name,
                   octet_length(encode(html)) AS n_bytes
            FROM pages""",
        "refreshed_index": f"""
            SELECT {doc_name} AS member, octet_length(encode(text)) + 1 AS size FROM documents
            UNION ALL
            SELECT 'page_' || page_id || '.html', octet_length(encode(html)) FROM pages""",
        "archive_index": f"""
            SELECT {doc_name} AS member, octet_length(encode(text)) AS size FROM documents""",
        "stream_order": f"""
            SELECT lang, min({doc_name}) AS first_member, max({doc_name}) AS last_member,
                   count(*) AS members
            FROM documents GROUP BY lang""",
        "archive_members": f"""
            SELECT {doc_name} AS member, octet_length(encode(text)) AS size, sha256(text) AS sha
            FROM documents""",
        "member_lookup": f"SELECT {doc_name} AS member, sha256(text) AS sha FROM {LABELLED}",
        "fetch_members": f"""
            SELECT {doc_name} AS member, octet_length(encode(text)) AS size, sha256(text) AS sha
            FROM {LABELLED}""",
        "resolve_exact": f"""
            SELECT doc_id, 'in/box/' || {doc_name} AS asked, sha256(text) AS sha FROM documents
            UNION ALL
            SELECT doc_id, 'in/box/gone_' || doc_id || '.bin', {GONE} FROM documents""",
        "resolve_contains": f"""
            SELECT d.doc_id, 'in/box/doc_' || d.doc_id || '.txt.bak' AS asked,
                   sha256(arg_min(m.text, m.lang || '/' || m.doc_id || '.txt')) AS sha
            FROM documents d
            JOIN documents m ON contains('doc_' || d.doc_id || '.txt.bak', m.doc_id || '.txt')
            GROUP BY d.doc_id
            UNION ALL
            SELECT doc_id, 'in/box/gone_' || doc_id || '.bin', {GONE} FROM documents""",
        "resolve_repeated": """
            SELECT e.event_id, sha256(coalesce(m.text, 'File Not Found')) AS sha
            FROM events e LEFT JOIN documents m ON e.user_id = m.doc_id""",
        "resolve_status": """
            SELECT doc_id, CASE WHEN lang = 'es' THEN 'null_path' ELSE 'found' END AS status,
                   CASE WHEN lang <> 'es' THEN sha256(text) END AS sha
            FROM documents
            UNION ALL
            SELECT doc_id, CASE WHEN lang = 'es' THEN 'null_path' ELSE 'missing' END, NULL
            FROM documents""",
        "resolve_two_columns": """
            SELECT d.lang, d.doc_id, sha256(d.text) AS text_sha,
                   sha256(coalesce(p.html, 'File Not Found')) AS page_sha
            FROM documents d LEFT JOIN pages p ON d.doc_id = p.page_id""",
        "resolve_second_column": """
            SELECT d.lang, d.doc_id,
                   sha256(CASE WHEN d.doc_id % 2 = 0 THEN d.text ELSE 'File Not Found' END) AS text_sha,
                   sha256(coalesce(p.html, 'File Not Found')) AS page_sha
            FROM documents d LEFT JOIN pages p ON d.doc_id = p.page_id""",
        "locate_blobs": """
            SELECT doc_id, 'found' AS status, octet_length(encode(text)) AS n_bytes FROM documents
            UNION ALL SELECT doc_id, 'missing', 0 FROM documents""",
        "basename": """
            SELECT page_id, regexp_extract(rtrim(url, '/'), '[^/]*$') AS name FROM pages""",
        "derive_name": """
            SELECT o_orderkey, o_orderkey || '_' || o_orderstatus || '.jpg' AS name FROM orders""",
        "retype_schema": """
            SELECT doc_id, 'binary' AS text_type, 'string' AS lang_type,
                   octet_length(encode(text)) AS n_bytes, sha256(text) AS sha
            FROM documents""",
        "catalog_types": " UNION ALL ".join(
            f"""
            SELECT '{name}' AS name, '{kind}' AS type,
                   {name in ("l_returnflag", "l_linestatus")} AS is_partition,
                   count({"l_orderkey" if "odd" in name else name}) AS n_values
            FROM lineitem"""
            for name, kind in LINEITEM_TYPES.items()
        ),
        "partitioned_append": f"SELECT {EVENT_ROWS} FROM events",
        "append_twice": f"""
            SELECT {EVENT_ROWS} FROM events UNION ALL SELECT {EVENT_ROWS} FROM events""",
        "single_partition": f"SELECT {EVENT_ROWS} FROM events WHERE event_type = 'click'",
        "described_table": " UNION ALL ".join(
            f"""
            SELECT '{name}' AS name, '{kind}' AS type, {name == "event_type"} AS is_partition,
                   true AS is_external, count({name}) AS n_values
            FROM events"""
            for name, kind in EVENT_TYPES.items()
        ),
        "show_partitions": """
            SELECT DISTINCT 'event_type=' || event_type AS partition FROM events""",
        "distinct_keys": "SELECT DISTINCT event_type FROM events",
        "pruned_read": f"SELECT {EVENT_ROWS} FROM events WHERE event_type = 'purchase'",
        "managed_append": "SELECT o_orderkey, o_orderpriority, o_orderstatus FROM orders",
        "failed_append": f"SELECT {EVENT_ROWS} FROM events",
        "evolve_table": """
            SELECT s_suppkey, s_name, CAST(NULL AS DOUBLE) AS s_acctbal, s_nationkey FROM supplier
            UNION ALL
            SELECT s_suppkey, s_name, s_acctbal, s_nationkey FROM supplier""",
        "replace_table": "SELECT c_name, c_custkey, c_nationkey FROM customer",
        "table_head": """
            SELECT o_orderkey, o_custkey, o_orderstatus FROM orders
            ORDER BY o_orderkey LIMIT 100""",
        "export_blobs": f"""
            SELECT {doc_name} AS name, octet_length(encode(text)) AS n_bytes FROM documents""",
        "export_last": """
            SELECT 'conv_' || conv_id || '.txt' AS name, sha256(arg_max(text, turn)) AS sha
            FROM conversations GROUP BY conv_id""",
        "export_manifest": """
            SELECT DISTINCT 'user_' || e.user_id || '.txt' AS name,
                   sha256(coalesce(m.text, 'File Not Found')) AS sha
            FROM events e LEFT JOIN documents m ON e.user_id = m.doc_id""",
        "pack_blobs": """
            SELECT source, count(*) AS n_members,
                   CAST(sum(octet_length(encode(text))) AS BIGINT) AS n_bytes
            FROM documents GROUP BY source""",
        "pack_twice": f"""
            SELECT {doc_name} AS member, octet_length(encode(text)) AS size, sha256(text) AS sha
            FROM documents""",
        "pack_manifest": f"""
            SELECT lang, {doc_name} AS member, octet_length(encode(text)) AS size,
                   sha256(text) AS sha
            FROM documents
            UNION ALL
            SELECT lang, 'gone_' || doc_id || '.bin', 14, {GONE} FROM documents""",
        "blob_table": f"""
            SELECT doc_id, lang, sha256(text) AS sha FROM documents
            UNION ALL SELECT doc_id, lang, {GONE} FROM documents""",
        "files_per_partition": """
            SELECT lang, CAST(1 AS BIGINT) AS n_files FROM documents GROUP BY lang""",
    }
