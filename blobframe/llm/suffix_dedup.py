"""Remove every byte covered by a string of WIDTH bytes that also starts elsewhere.

Suffixes are ordered by their first WIDTH bytes only, in passes over groups of suffixes with an
equal beginning; groups that are equal after the last pass are the repeated windows. A pass over
all suffixes would be larger than the corpus many times over, so the digits are chosen well:

* First digit: CONTEXT bytes at the window's anchor, the place of least hash among its first
  places. Equal windows have equal anchors at an equal distance, and dozens of neighbouring windows
  share one: one row stands for all suffixes of an anchor.
* Second digit: all bytes of all windows of the anchor. Anchors equal in it have only repeated
  windows. An anchor whose first digit is unique has none. Both are done.
* Third digit, for what the first two leave open, and for one anchor of each second digit: what
  32 neighbouring windows have in common, which is all but 31 bytes on either side.
* Fourth digit: those bytes on either side. Neighbours equal in it have only repeated windows; one
  of them goes on, and none where nothing else has their third digit.
* Last digit: the 31 bytes of each window that its neighbours do not share.

Only hashes and places are shuffled, and of the text what has open anchors or spans, by its own hash.
Equal digits are equal hashes, of 128 bits from the fourth digit on.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blobframe.session import materialize, release_scratch

from .common import BROADCAST_KEYS, as_bytes, settled

WIDTH = 200
CONTEXT = 32
#: Bytes that are hashed and searched for anchors at a time; longer texts go in overlapping pieces.
PIECE = 1 << 20
#: Starts of windows that share a third digit.
BLOCK = 32
THIRD = ["context", "block", "core", "t1", "t2", "anchor", "low", "high", "weight", "around"]
_ROLL = 8  # bytes that decide on an anchor


def anchors(data: bytes, width: int = WIDTH) -> list[tuple[int, int, int]]:
    """(anchor, first start, last start) for every run of windows with the same anchor."""
    n, span = len(data), width - CONTEXT + 1  # places of a window at which an anchor may be
    if n < width:
        return []
    found: list[tuple[int, int, int]] = []
    windows = n - width + 1
    for begin in range(0, windows, PIECE):
        count = min(PIECE, windows - begin)
        raw = np.frombuffer(data, np.uint8, count + span - 1 + _ROLL - 1, begin).astype(np.uint64)
        places = count + span - 1
        key = np.zeros(places, np.uint64)
        for k in range(_ROLL):
            key = (key * np.uint64(0x9E3779B97F4A7C15)) ^ (raw[k : k + places] + np.uint64(k + 1))
        key ^= key >> np.uint64(29)
        key *= np.uint64(0xBF58476D1CE4E5B9)
        # The place in the low bits lets the leftmost of equal hashes win.
        key = (key & ~np.uint64((1 << 24) - 1)) | np.arange(places, dtype=np.uint64)
        reach, least = 1, key
        while reach * 2 <= span:
            least = np.minimum(least[:-reach], least[reach:])
            reach *= 2
        if reach < span:
            least = np.minimum(least[: count], least[span - reach : span - reach + count])
        at = (least & np.uint64((1 << 24) - 1)).astype(np.int64)
        heads = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
        ends = np.r_[heads[1:], count] - 1
        for a, s, e in zip(
            (at[heads] + begin).tolist(), (heads + begin).tolist(), (ends + begin).tolist(), strict=True
        ):
            if found and found[-1][0] == a:  # a run that a piece boundary had cut
                found[-1] = (a, found[-1][1], e)
            else:
                found.append((a, s, e))
    return found


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def digest(data: bytes | memoryview, seed: int) -> int:
    return signed(xxhash.xxh3_64_intdigest(data, seed))


def first_digits(docs: DataFrame, width: int) -> DataFrame:
    """(context, whole, t1, t2, anchor, back, ahead) for every anchor of every text.

    The anchor's windows start from ``back`` bytes before it to ``ahead`` bytes behind that.
    """

    def run(batches):
        for batch in batches:
            columns: list[list] = [[] for _ in range(7)]
            for t1, t2, text in zip(*batch.columns, strict=True):
                data, one, two = as_bytes(text.as_py()), t1.as_py(), t2.as_py()
                for a, s, e in anchors(data, width):
                    row = (
                        digest(data[a : a + CONTEXT], 1), digest(data[s : e + width], a - s),
                        one, two, a, a - s, e - s,
                    )
                    for column, value in zip(columns, row, strict=True):
                        column.append(value)
            names = ["context", "whole", "t1", "t2", "anchor", "back", "ahead"]
            yield pa.record_batch([pa.array(c, pa.int64()) for c in columns], names=names)

    schema = "context long, whole long, t1 long, t2 long, anchor long, back long, ahead long"
    return docs.select("t1", "t2", "text").mapInArrow(run, schema)


def third_digits(open_ones: DataFrame, width: int) -> DataFrame:
    """(context, block, core, t1, t2, anchor, low, high, weight, around) for the open anchors.

    Windows that start in the same BLOCK of bytes before their anchor have all but BLOCK - 1 bytes
    in common. ``core`` is the hash of those, ``around`` the bytes on either side, and low:high are
    the anchor's windows in the block.
    """
    margin = BLOCK - 1

    def run(batches):
        for batch in batches:
            rows: list[tuple] = []
            for t1, t2, text, found in zip(*batch.columns, strict=True):
                data, one, two = as_bytes(text.as_py()), t1.as_py(), t2.as_py()
                for anchor in found.as_py():
                    a, back = anchor["anchor"], anchor["back"]
                    nearest = back - anchor["ahead"]  # of the last window, before the anchor
                    for block in range(nearest // BLOCK, back // BLOCK + 1):
                        begin = a - BLOCK * block
                        end = begin + width - margin
                        left = data[max(0, begin - margin) : begin].rjust(margin, b"\0")
                        right = data[end : end + margin].ljust(margin, b"\0")
                        low = max(0, nearest - BLOCK * block)
                        high = min(margin, back - BLOCK * block)
                        rows.append(
                            (anchor["context"], block, digest(data[begin:end], block), one, two,
                             a, low, high, anchor["weight"], left + right)
                        )
            columns = list(zip(*rows, strict=True)) or [[]] * 10
            types = [pa.int64()] * 9 + [pa.binary()]
            yield pa.record_batch(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=THIRD
            )

    schema = ", ".join(f"{name} long" for name in THIRD[:-1]) + ", around binary"
    return open_ones.select("t1", "t2", "text", "anchors").mapInArrow(run, schema)


def open_spans(third: DataFrame, width: int) -> DataFrame:
    """(t1, t2, start, end) of the repeated windows among those that the third digits stand for.

    A row that stands for several anchors is only a partner to others: its windows are repeated.
    """
    alike = ["context", "block", "core", "low", "high", "around"]
    keys = {f"k{j}": F.xxhash64(F.lit(j), *alike) for j in (1, 2)}
    third = settled(third.withColumns(keys), "third_digits")
    groups = third.groupBy("k1", "k2").agg(
        F.count("*").alias("n"),
        F.sum("weight").alias("weight"),
        F.min(F.struct("t1", "t2", "anchor", *alike)).alias("p"),
    )
    groups = settled(groups, "fourth_digits")
    again = groups.where("n > 1").select("k1", "k2")
    begin = F.col("anchor") - BLOCK * F.col("block")
    equal = third.where("weight = 1").join(again, ["k1", "k2"])
    equal = equal.select(
        "t1", "t2", (begin - F.col("high")).alias("start"), (begin - F.col("low") + width).alias("end")
    )

    digits = ["context", "block", "core"]
    ones = groups.select("weight", "p.*")
    shared = ones.groupBy(*digits).agg(F.count("*").alias("n")).where("n > 1").select(*digits)
    still = settled(ones.join(materialize(shared, "shared_cores"), digits), "open_blocks")
    windows = still.withColumn("i", F.explode(F.sequence("low", "high")))
    window = F.substring("around", BLOCK - F.col("i").cast("int"), F.lit(BLOCK - 1))
    windows = windows.select(
        *(F.xxhash64(F.lit(j), *digits, "i", window).alias(f"q{j}") for j in (1, 2)),
        "t1", "t2", (begin - F.col("i")).alias("start"), "weight",
    )
    twice = windows.groupBy("q1", "q2").agg(F.sum("weight").alias("n")).where("n > 1")
    twice = settled(twice.select("q1", "q2"), "repeated_windows")
    starts = windows.where("weight = 1").join(twice, ["q1", "q2"])
    starts = starts.select("t1", "t2", "start", (F.col("start") + width).alias("end"))
    return equal.union(starts)


def removed_runs(spans: list[dict]) -> list[tuple[int, int]]:
    """Union of (start, end) spans, as maximal runs."""
    runs: list[list[int]] = []
    for start, end in sorted((s["start"], s["end"]) for s in spans):
        if runs and start <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], end)
        else:
            runs.append([start, end])
    return [(a, b) for a, b in runs]


def cut_out(rows: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) from texts and the spans to remove."""

    def run(batches):
        for batch in batches:
            out: list[list] = [[] for _ in range(5)]
            for doc_id, text, spans in zip(*batch.columns, strict=True):
                data = as_bytes(text.as_py())
                runs = removed_runs(spans.as_py() or [])
                kept, at = hashlib.sha256(), 0
                for a, b in runs:
                    kept.update(data[at:a])
                    at = b
                kept.update(data[at:])
                removed = sum(b - a for a, b in runs)
                row = (doc_id.as_py(), len(data), removed, len(runs), kept.hexdigest())
                for column, value in zip(out, row, strict=True):
                    column.append(value)
            types = [pa.int64()] * 4 + [pa.string()]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            yield pa.record_batch(
                [pa.array(c, t) for c, t in zip(out, types, strict=True)], names=names
            )

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return rows.select("doc_id", "text", "spans").mapInArrow(run, schema)


def suffix_dedup(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every row.

    Texts are compared as UTF-8; NULL texts are empty, and texts of fewer than ``width`` bytes
    lose nothing. Rows with equal texts, and repeated rows, are all copies of each other. Rows
    without an id are handled like the others. Other columns are not looked at. An empty table
    gives an empty result. A text that occurs twice and is long enough goes as a whole, so groups
    of copies never meet in the joins that need the text.
    """
    text = F.coalesce("text", F.lit(""))
    hashes = [F.xxhash64(F.lit(k), text).alias(f"t{k}") for k in (1, 2)]
    docs = docs.select(F.col("doc_id").cast("long"), *hashes, text.alias("text"))
    spark = docs.sparkSession
    with release_scratch(spark):
        found = materialize(first_digits(docs, width), "anchors")
        contexts = found.groupBy("context").agg(
            F.count("*").alias("n"), F.min("whole").alias("a"), F.max("whole").alias("b")
        )
        contexts = contexts.where("n > 1").select("context", (F.col("a") != F.col("b")).alias("open"))
        contexts = materialize(contexts, "contexts")
        found = settled(found.join(contexts, "context"), "repeated_contexts", keep=True)
    groups = found.groupBy("context", "whole", "open").agg(
        F.count("*").alias("weight"), F.min(F.struct("t1", "t2", "anchor", "back", "ahead")).alias("p")
    )
    groups = materialize(groups.where("open or weight > 1"), "second_digits")
    # One anchor of each second digit goes on.
    going = groups.where("open").select("context", "weight", "p.*")
    going = going.groupBy("t1", "t2").agg(
        F.collect_list(F.struct("context", "weight", "anchor", "back", "ahead")).alias("anchors")
    )
    going = materialize(going, "open_anchors")
    copies = docs.groupBy("t1", "t2").agg(F.count("*").alias("n")).where("n > 1")
    copies = materialize(copies.select("t1", "t2"), "copies")
    opened = keys_of(going)
    single = docs.join(opened, ["t1", "t2"], "left_semi")
    single = single.groupBy("t1", "t2").agg(F.first("text").alias("text"))
    with release_scratch(spark):
        third = third_digits(single.join(going, ["t1", "t2"]), width)
        spans_of_open = settled(open_spans(third, width), "open_spans", keep=True)
    done = materialize(groups.where("weight > 1").select("context", "whole"), "repeated_digits")
    first = F.col("anchor") - F.col("back")
    runs = found.join(done, ["context", "whole"])
    runs = runs.select(
        "t1", "t2", first.alias("start"), (first + F.col("ahead") + width).alias("end")
    )
    runs = runs.join(copies, ["t1", "t2"], "left_anti")
    opened = spans_of_open.join(copies, ["t1", "t2"], "left_anti")
    spans = runs.union(opened).groupBy("t1", "t2").agg(
        F.collect_list(F.struct("start", "end")).alias("spans")
    )
    spans = settled(spans, "spans")
    # Texts that are copies go whole, those without a span stay: neither needs a join by its text.
    marks = keys_of(spans).select("t1", "t2", F.lit(False).alias("copied"))
    marks = marks.union(copies.select("t1", "t2", F.lit(True).alias("copied")))
    marks = materialize(marks, "marks")
    marks = F.broadcast(marks) if marks.count() <= BROADCAST_KEYS else marks
    marked = docs.join(marks, ["t1", "t2"], "left")
    n = F.octet_length("text").cast("long")
    whole = F.array(F.struct(F.lit(0).cast("long").alias("start"), n.alias("end")))
    rest = marked.where("copied is null or copied")
    rest = rest.withColumn("spans", F.when(F.col("copied") & (n >= width), whole))
    cut = marked.where("not copied").join(spans, ["t1", "t2"])
    columns = ["doc_id", "text", "spans"]
    return cut_out(rest.select(columns).union(cut.select(columns)))


def keys_of(stored: DataFrame) -> DataFrame:
    """The texts (t1, t2) of a stored table with a row for each; broadcast if they are not many."""
    keys = stored.select("t1", "t2")
    return F.broadcast(keys) if stored.count() <= BROADCAST_KEYS else keys
