"""Exact Jaccard join of documents as sets of word shingles, and the groups it links.

1. Every document becomes a set of hashed shingles; equal sets are one node from here on.
2. Index: sets of similar size are cut by the same rule into more blocks than a linked pair can
   have differences, and some to spare for blocks that are empty, so a linked pair shares a whole
   block that is filled. The lists of equal blocks tie sets into clusters that no link leaves, for
   every class of sizes apart. Only hashes of filled blocks are shuffled, and what does not share a
   whole block with anything is skipped. Shingles that a sample shows to be common all go to one
   block: a stock phrase that has a block to itself would tie every two sets that hold it. The
   hashes are shuffled once, in a few bytes, and stored nowhere: each list ties all its places to
   the least. Where a task has many texts with a block, only the least of their places goes on.
3. Clusters are joined exactly, cut into chunks of bounded size, one task for a pair of chunks, in
   rounds that deal out about as many shingles as the clusters have, however many pairs there are. The
   sets of a chunk are in an index of lists ordered by size, and the part of a list that cannot
   reach the threshold is skipped. A set that is close to one whose overlaps are known gets its own
   by adding and taking off the lists of the differing shingles alone. A task returns a forest of
   the links that it finds, not all pairs.
4. Components of the forests, by large and small stars.
"""

from __future__ import annotations

import functools
import itertools

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blobframe.session import materialize, release_scratch

from .common import BROADCAST_KEYS, BROADCAST_ROWS, as_bytes, settled

SHINGLE = 3
PERCENT = 90
#: Blocks more than the differences of a linked pair, as a share of these; makes up for blocks that
#: are empty.
SPARE = 0.05
#: One text in so many tells which shingles are common: those of COMMON_TEXTS of them. If these are
#: more than COMMON_SHINGLES, only the most frequent are. Which ones are changes no result.
COMMON_SAMPLE = 8
COMMON_TEXTS = 2
COMMON_SHINGLES = 1 << 20
#: Bits of a place's name, and bits of a block's hash that are shuffled besides those of its bucket.
PLACE_BITS, BLOCK_BITS = 48, 40
#: Blocks that are sorted before they are shuffled, blocks that a bucket has, about, and most bits of
#: a bucket's number.
PACKED, BUCKET, BUCKET_BITS = 1 << 19, 1 << 18, 16
#: Shingles dealt out at a time, as a multiple of those of all clusters; at least so many.
ROUND, ROUND_SHINGLES = 1.25, 1 << 24
SET_COLUMNS = ["doc_id", "t1", "t2", "n_shingles", "node", "check", "v0", "v1", "b0", "b1"]
#: Shingles of the sets that one chunk holds at most (a single larger set is a chunk of its own).
CHUNK_SHINGLES = 1 << 18

ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, width: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the shingles of ``width`` lower-cased words.

    Fewer words are one shingle; none give an empty set.
    """
    words = as_bytes(text).lower().split()  # of bytes: just A-Z, and just the six breaks
    if not words:
        return np.empty(0, np.uint64)
    digest = xxhash.xxh3_64_intdigest
    known = {w: digest(w) for w in set(words)}
    hashes = np.fromiter((known[w] for w in words), np.uint64, len(words))
    n = max(1, len(words) - width + 1)
    total = np.full(n, min(len(words), width), np.uint64)
    for k in range(min(len(words), width)):
        total = mixed(total * ODD[k % 3] + hashes[k : k + n])
    return np.unique(total)


def size_classes(percent: int, limit: int = 1 << 40) -> np.ndarray:
    """Smallest sizes of the classes: a set's partners are in its own class or in a neighbour."""
    starts = [1]
    while starts[-1] < limit:
        starts.append(starts[-1] * 100 // percent + 1)
    return np.array(starts)


def most_differences(largest: int, percent: int) -> int:
    """How many shingles two linked sets can differ in, if the smaller has ``largest`` at most."""
    both = largest + largest * 100 // percent
    return both * (100 - percent) // (100 + percent)


def block_hashes(
    shingles: np.ndarray, starts: np.ndarray, percent: int, common: np.ndarray | None = None
) -> list[tuple[int, np.ndarray]]:
    """(class, hashes of the set's filled blocks) where it may be the smaller or the larger one.

    A linked pair has more equal blocks than there are spare ones. So if no more of a set's blocks
    are empty than are spare, one of the equal blocks is filled, whatever the other set is like. If
    more are empty, the set is also cut by a second rule, a third one and so on, until that holds;
    the two sets of a pair share every rule up to the first that suits one of them. The first rule
    puts all of the ``common`` shingles (sorted) into one block, whatever they are.

    Where a class can have sets too small for that, every shingle is a block.
    """
    found = []
    frequent = np.zeros(len(shingles), bool)
    if common is not None and len(common):
        frequent = common[np.searchsorted(common[:-1], shingles)] == shingles
    own = int(np.searchsorted(starts, len(shingles), "right")) - 1
    for at in {own, max(own - 1, 0)}:
        differences = most_differences(int(starts[at + 1]) - 1, percent)
        if differences == 0:
            continue  # only equal sets link
        if starts[at] < 2 * (differences + 1):
            found.append((at, mixed(shingles + np.uint64(at << 40))))
            continue
        spare = 1 + int(np.ceil(SPARE * (differences + 1)))
        blocks = differences + 1 + spare
        keys = []
        for rule in itertools.count():
            place = (mixed(shingles + np.uint64(rule)) if rule else shingles) % np.uint64(blocks)
            if rule == 0:
                place[frequent] = 0
            sums = np.zeros(blocks, np.uint64)
            np.add.at(sums, place, mixed(shingles + ODD[0]))
            filled = np.flatnonzero(np.bincount(place.astype(np.int64), minlength=blocks))
            number = filled.astype(np.uint64) + np.uint64(rule << 32)
            keys.append(mixed(sums[filled] + number * ODD[1] + np.uint64(at << 40)))
            if blocks - len(filled) <= spare:
                break
        found.append((at, np.concatenate(keys)))
    return found


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def common_shingles(docs: DataFrame, width: int) -> np.ndarray:
    """Sorted hashes of shingles that several of a sample of the different texts hold."""

    def run(batches):
        for batch in batches:
            sets = [shingle_set(t.as_py(), width) for t in batch.column("text")]
            found = np.concatenate([np.empty(0, np.uint64), *sets])
            yield pa.record_batch([pa.array(signed(found))], names=["shingle"])

    sample = docs.where(F.pmod("t1", F.lit(COMMON_SAMPLE)) == 0).dropDuplicates(["t1", "t2"])
    counted = sample.select("text").mapInArrow(run, "shingle long").groupBy("shingle")
    counted = counted.agg(F.count("*").alias("n")).where(F.col("n") >= COMMON_TEXTS)
    counted = settled(counted.withColumn("power", F.floor(F.log2("n"))), "common")
    least, room = None, COMMON_SHINGLES
    for power, n in counted.groupBy("power").count().orderBy(F.desc("power")).collect():
        if n > room:
            break
        least, room = power, room - n
    if least is None:
        return np.empty(0, np.uint64)
    # As Arrow: rows of Python objects would take the driver some 500 bytes a shingle.
    found = counted.where(F.col("power") >= least).select("shingle").toArrow()["shingle"]
    return np.sort(found.to_numpy().view(np.uint64))


def sets_of_batches(width: int, percent: int, common: np.ndarray | None):
    """What makes batches of :func:`set_of_documents`, of some PACKED blocks, of batches of texts."""
    starts = size_classes(percent)
    types = [pa.int64()] * 8 + [pa.list_(pa.int64())] * 2

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) or [[]] * 10
        arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
        return pa.record_batch(arrays, names=SET_COLUMNS)

    def run(batches):
        for batch in batches:
            rows, seen, held = [], {}, 0
            for doc_id, t1, t2, text in zip(*batch.columns, strict=True):
                shingles = shingle_set(text.as_py(), width)
                node = check = None
                places: list[tuple] = []
                if len(shingles):
                    node = int(signed(mixed(shingles).sum(keepdims=True))[0])
                    check = int(signed(mixed(shingles ^ ODD[2]).sum(keepdims=True))[0])
                    known = seen.get((node, check, len(shingles)))
                    new = block_hashes(shingles, starts, percent, common) if known is None else []
                    for at, hashes in new:
                        name = mixed(np.array([node % (1 << 64)], np.uint64) ^ np.uint64(at << 40))
                        places.append((int(name[0] >> np.uint64(64 - PLACE_BITS)), signed(hashes)))
                        held += len(hashes)
                    places = places if known is None else known
                    seen[node, check, len(shingles)] = [(name, []) for name, _ in places]
                (v0, b0), (v1, b1) = (places + [(None, [])] * 2)[:2]
                row = (doc_id.as_py(), t1.as_py(), t2.as_py(), len(shingles), node, check)
                rows.append((*row, v0, v1, b0, b1))
                if held >= PACKED:
                    yield batch_of(rows)
                    rows, held = [], 0
            yield batch_of(rows)

    return run


def set_of_documents(
    docs: DataFrame, width: int, percent: int, common: np.ndarray | None = None
) -> DataFrame:
    """Per document: its text's hashes, the set's size and hashes, and its places in the index.

    A place is the set in one size class: v0 and v1 name it, b0 and b1 are the hashes of its blocks.
    These are left empty where an earlier row of the same batch has the same set. A name is a hash of
    PLACE_BITS bits. Sets that share one by chance are compared in vain; only two that also link would
    be missed, if no other set or class ties them.
    """
    lists = "b0 array<long>, b1 array<long>"
    return docs.select("doc_id", "t1", "t2", "text").mapInArrow(
        sets_of_batches(width, percent, common), f"{longs(SET_COLUMNS[:-2])}, {lists}"
    )


def longs(names: list[str]) -> str:
    return ", ".join(f"{name} long" for name in names)


def with_text_hashes(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select(
        F.col("doc_id").cast("long"),
        F.xxhash64(F.lit(1), text).alias("t1"),
        F.xxhash64(F.lit(2), text).alias("t2"),
        text.alias("text"),
    )


def both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def star(edges: DataFrame, large: bool, label: str) -> DataFrame:
    """One round of large stars (hang larger neighbours on the least one) or of small stars."""
    near = both_ways(edges) if large else edges.select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    )
    least = near.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select("u", F.least("u", "m").alias("m"))
    near, least = materialize(near, f"{label}_near"), materialize(least, f"{label}_least")
    met = near.join(least, "u")
    if large:
        out = met.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        hung = met.where(F.col("v") != F.col("m")).select(
            F.col("v").alias("u"), F.col("m").alias("v")
        )
        out = hung.union(least.select("u", F.col("m").alias("v")))
    return materialize(out.where(F.col("u") != F.col("v")).distinct(), label)


def components(edges: DataFrame, label: str) -> DataFrame:
    """``node`` and ``root`` (the least node of its component) for every node that has an edge.

    Rounds of large and small stars until every edge ends at a root, O(log² n) of them.
    """
    edges = settled(
        edges.where(F.col("u") != F.col("v"))
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct(),
        f"{label}_edges",
    )
    turn = 0
    while True:
        state = edges.agg(
            F.count("*").alias("n"),
            F.count_distinct("u").alias("d"),
        ).first()
        hubs = edges.join(edges.select(F.col("v").alias("u")).distinct(), "u", "left_semi")
        if state["n"] == state["d"] and hubs.isEmpty():
            break
        edges = star(edges, True, f"{label}_large_{turn}")
        edges = star(edges, False, f"{label}_small_{turn}")
        turn += 1
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)


class Forest:
    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        a, b = self.root(i), self.root(j)
        self.up[max(a, b)] = min(a, b)
        return a != b


def link_chunks(
    sets: list[np.ndarray], first: np.ndarray | None, percent: int
) -> list[tuple[int, int]]:
    """A forest of the links among ``sets``.

    ``first`` marks the sets of the first of two chunks, if links within either are other tasks'.
    Overlaps are exact counts: from the index for some sets, and for a set close to the one before
    it from that one's by the differing shingles.
    """
    sizes = np.array([len(s) for s in sets])
    order = np.argsort(sizes, kind="stable")
    sets, sizes = [sets[i] for i in order], sizes[order]
    first = None if first is None else first[order]
    tokens = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), sizes)
    by_token = np.argsort(tokens, kind="stable")  # lists keep the order of sizes
    tokens, owner = tokens[by_token], owner[by_token]
    heads = np.flatnonzero(np.r_[True, tokens[1:] != tokens[:-1]])
    lists, ends = tokens[heads], np.r_[heads[1:], len(tokens)]

    def ranges(shingles: np.ndarray) -> list[tuple[int, int]]:
        at = np.searchsorted(lists, shingles)
        return list(zip(heads[at].tolist(), ends[at].tolist(), strict=True))

    def gather(shingles: np.ndarray, low: int, high: int) -> np.ndarray:
        """How many of ``shingles`` each of the sets low:high holds."""
        parts = []
        for a, b in ranges(shingles):
            held = owner[a:b]
            i, j = np.searchsorted(held, (low, high))
            if j > i:
                parts.append(held[i:j])
        if not parts:
            return np.zeros(high - low, np.int64)
        return np.bincount(np.concatenate(parts) - low, minlength=high - low)

    forest, links = Forest(len(sets)), []
    known, low, high = None, 0, 0  # the set whose overlaps with the sets low:high are in counts
    counts = np.zeros(0, np.int64)
    for i, n in enumerate(sizes.tolist()):
        reach = int(np.searchsorted(sizes, n * 100 // percent, "right"))
        if reach <= i + 1:
            continue
        shared = None
        if known is not None and low <= i < high:
            shared = int(counts[i - low])
        if shared is not None and n + sizes[known] - 2 * shared < n // 2:
            new = np.setdiff1d(sets[i], sets[known], assume_unique=True)
            gone = np.setdiff1d(sets[known], sets[i], assume_unique=True)
            derived = counts[i - low :] + gather(new, i, high) - gather(gone, i, high)
            if reach > high:
                derived = np.r_[derived, gather(sets[i], high, reach)]
            counts, low, high = derived, i, max(high, reach)
        else:
            counts, low, high = gather(sets[i], i, reach), i, reach
        known = i
        inter = counts[: reach - i]
        union = n + sizes[i:reach] - inter
        linked = 100 * inter >= percent * union
        linked[0] = False
        if first is not None:
            linked &= first[i] != first[i:reach]
        for j in np.flatnonzero(linked).tolist():
            if forest.join(i, i + j):
                links.append((int(order[i]), int(order[i + j])))
    return links


def member_sets(members: DataFrame, width: int) -> DataFrame:
    """The set of every member; members: cluster, node, chunk, chunks, text."""

    def shingled(batches):
        for batch in batches:
            sets = [signed(shingle_set(t.as_py(), width)) for t in batch.column("text")]
            keep = [batch.column(c) for c in ("root", "node", "chunk", "chunks")]
            yield pa.record_batch(
                [*keep, pa.array(sets, pa.list_(pa.int64()))],
                names=["root", "node", "chunk", "chunks", "shingles"],
            )

    return members.select("root", "node", "chunk", "chunks", "text").mapInArrow(
        shingled, "root long, node long, chunk long, chunks long, shingles array<long>"
    )


def rounds_of(weights: list[tuple[int, int]], room: float) -> list[tuple[int, int]]:
    """First and last steps of rounds that deal out about ``room`` shingles each, at most.

    ``weights`` are numbers of chunks, and the shingles of the clusters that have so many. At step k
    each chunk of a cluster meets the one k further on, as in a ring: twice dealt, but at the step 0
    and at half of the ring once. A step that is too large alone has a round to itself.
    """
    chunks, shingles = (np.array(x, np.float64) for x in zip(*weights, strict=True))
    rounds, left = [], 0.0
    for k in range(int(chunks.max()) // 2 + 1):
        times = np.where(2 * k < chunks, 2 if k else 1, np.where(2 * k == chunks, 1, 0))
        dealt = float((times * shingles).sum())
        if not rounds or dealt > left:
            rounds.append((k, k))
            left = room - dealt
        else:
            rounds[-1] = (rounds[-1][0], k)
            left -= dealt
    return rounds


def linked_sets(sets: DataFrame, percent: int, first: int, last: int) -> DataFrame:
    """Edges (u, v) of forests of the links between chunks that meet from step first to last."""
    sets = sets.where(F.floor(F.col("chunks") / 2) >= first)
    steps = F.sequence(
        F.lit(first).cast("long"), F.least(F.lit(last), F.floor(F.col("chunks") / 2)).cast("long")
    )

    def met(other):
        return F.struct(F.least("chunk", other).alias("a"), F.greatest("chunk", other).alias("b"))

    others = F.array_distinct(
        F.concat(
            F.transform(steps, lambda k: met(F.pmod(F.col("chunk") + k, F.col("chunks")))),
            F.transform(steps, lambda k: met(F.pmod(F.col("chunk") - k, F.col("chunks")))),
        )
    )
    dealt = sets.select("root", "node", "chunk", "shingles", F.explode(others).alias("_pair"))
    dealt = dealt.select("root", "node", "chunk", "shingles", "_pair.a", "_pair.b")

    def links(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        sets = [x.view(np.uint64) for x in group["shingles"]]
        first = None if key[1] == key[2] else (group["chunk"] == key[1]).to_numpy()
        found = link_chunks(sets, first, percent)
        nodes = group["node"].to_numpy()
        return pd.DataFrame(
            {"u": [nodes[i] for i, _ in found], "v": [nodes[j] for _, j in found]}, dtype="int64"
        )

    return dealt.groupBy("root", "a", "b").applyInPandas(links, "u long, v long")


def planes(x: np.ndarray, width: int) -> bytes:
    """The lowest ``width`` bytes of 64-bit numbers, all first bytes before all second ones.

    Bytes that are zero in all numbers then take nothing once they are compressed.
    """
    return x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def unplaned(parts: list[bytes], width: int) -> np.ndarray:
    found = []
    for part in parts:
        x = np.zeros((len(part) // width, 8), np.uint8)
        x[:, :width] = np.frombuffer(part, np.uint8).reshape(width, -1).T
        found.append(x.reshape(-1).view("<u8"))
    return np.concatenate(found)


def tied(keys: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, ...]:
    """The different keys, in order, the least place of each, and (u, v) of places tied to it."""
    order = np.argsort(keys)
    keys, places = keys[order], places[order]
    heads = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    least = np.minimum.reduceat(places, heads)
    sizes = np.diff(np.r_[heads, len(keys)])
    shared = np.repeat(sizes > 1, sizes)  # few are
    u, v = places[shared], np.repeat(least[sizes > 1], sizes[sizes > 1])
    edges = np.unique(np.stack([u[u != v], v[u != v]], axis=1), axis=0)
    return keys[heads], least, edges[:, 0], edges[:, 1]


def packed_blocks(kept: list[str], bits: int):
    """What makes rows for :func:`ties` of batches of sets.

    The rows of sets go on without their blocks. Those of PACKED blocks or more are sorted into
    1 << ``bits`` buckets; of equal ones the least place goes there, and the others are tied to it.
    """
    types = [("bucket", pa.int32()), *((c, pa.int64()) for c in [*kept, "u", "v"])]
    types = pa.schema([*types, ("blocks", pa.binary()), ("places", pa.binary())])

    def rows(**columns) -> pa.RecordBatch:
        none = [None] * len(columns["bucket"])
        return pa.record_batch([pa.array(columns.get(t.name, none), t.type) for t in types], schema=types)

    def sorted_in(blocks: list[np.ndarray], places: list[np.ndarray]):
        keys, places, u, v = tied(mixed(np.concatenate(blocks)), np.concatenate(places))
        yield rows(bucket=np.arange(len(u)) % (1 << bits), u=u, v=v)
        ends = [len(keys)]
        if bits:
            ends = np.searchsorted(keys >> np.uint64(64 - bits), np.arange(1 << bits), "right")
        keys = (keys << np.uint64(bits)) >> np.uint64(64 - BLOCK_BITS)
        found, low = [], 0
        for bucket, high in enumerate(ends):
            if high > low:
                block, place = planes(keys[low:high], BLOCK_BITS // 8), planes(places[low:high], 8)
                found.append((bucket, block, place))
            low = high
        bucket, blocks, places = zip(*found, strict=True)
        yield rows(bucket=bucket, blocks=blocks, places=places)

    def run(batches):
        blocks, places, n = [], [], 0
        for batch in batches:
            columns = {c: batch.column(c) for c in kept}
            yield rows(bucket=np.arange(batch.num_rows) % (1 << bits), **columns)
            for k in (0, 1):
                filled = batch.column(f"b{k}")
                values = filled.flatten().to_numpy().view(np.uint64)
                sizes = filled.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
                names = batch.column(f"v{k}").fill_null(0).to_numpy(zero_copy_only=False)
                blocks.append(values)
                places.append(np.repeat(names, sizes))
                n += len(values)
            if n >= PACKED:
                yield from sorted_in(blocks, places)
                blocks, places, n = [], [], 0
        if n:
            yield from sorted_in(blocks, places)

    schema = f"bucket int, {longs([*kept, 'u', 'v'])}, blocks binary, places binary"
    return run, schema


def ties(packed: DataFrame, kept: list[str]) -> DataFrame:
    """The sets' rows without blocks, and rows with ``u`` and ``v``: places that share a block.

    One shuffle, of a few bytes for a block that several texts can share. A task holds a bucket.
    """
    out = [*kept, "u", "v"]

    def run(batches):
        last, blocks, places = None, [], []

        def edges():
            _, _, u, v = tied(unplaned(blocks, BLOCK_BITS // 8), unplaned(places, 8).view(np.int64))
            none = [pa.nulls(len(u), pa.int64())] * len(kept)
            return pa.record_batch([*none, pa.array(u), pa.array(v)], names=out)

        for batch in batches:
            full = batch.filter(batch.column("blocks").is_valid())
            yield batch.filter(batch.column("blocks").is_null()).select(out)
            for bucket, block, place in zip(*full.select(["bucket", "blocks", "places"]).columns, strict=True):
                if bucket.as_py() != last and blocks:
                    yield edges()
                    blocks, places = [], []
                last = bucket.as_py()
                blocks.append(block.as_py())
                places.append(place.as_py())
        if blocks:
            yield edges()

    return packed.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, longs(out))


def tied_places(sets: DataFrame, bits: int = 4) -> DataFrame:
    """``place, root``: the clusters of places that share blocks, but for single ones."""
    run, schema = packed_blocks(["v0", "v1"], bits)
    return clusters_of(ties(sets.select("v0", "v1", "b0", "b1").mapInArrow(run, schema), ["v0", "v1"]))


def clusters_of(tied: DataFrame) -> DataFrame:
    edges = tied.where(F.col("u").isNotNull()).select("u", "v")
    return components(edges, "clusters").withColumnRenamed("node", "place")


def sets_and_ties(
    docs: DataFrame, width: int, percent: int, common: np.ndarray | None, bits: int
) -> DataFrame:
    """:func:`ties` of :func:`set_of_documents`, whose blocks are nowhere stored."""
    kept = SET_COLUMNS[:-2]
    sets, (packed, schema) = sets_of_batches(width, percent, common), packed_blocks(kept, bits)
    docs = docs.select("doc_id", "t1", "t2", "text")
    return ties(docs.mapInArrow(lambda batches: packed(sets(batches)), schema), kept)


def bucket_bits(docs: DataFrame) -> int:
    """Bits of a bucket's number. A block for every twelve characters or so: six are a word."""
    characters = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    return min(BUCKET_BITS, int(np.ceil(np.log2(max(1, characters / 12 / BUCKET)))))


def jaccard_groups(
    docs: DataFrame, percent: int = PERCENT, width: int = SHINGLE, chunk: int = CHUNK_SHINGLES
) -> DataFrame:
    """doc_id, n_shingles and component_id (least doc_id of those reachable by links) of all rows.

    See :func:`grouped_rows` for what counts and for the odd cases.
    """
    grouped = grouped_rows(docs, percent, width, chunk)
    return grouped.select("doc_id", "n_shingles", "component_id")


def grouped_rows(
    docs: DataFrame, percent: int = PERCENT, width: int = SHINGLE, chunk: int = CHUNK_SHINGLES
) -> DataFrame:
    """doc_id, t1, t2, n_shingles, component_id and group_id of all rows.

    t1 and t2 are hashes of the text. Rows have the same group_id if links reach from one to the
    other, whether they have ids or not; it is NULL where the set is empty. component_id is the
    least doc_id of those reachable by links.

    Two documents link when 100 * intersection >= percent * union of their shingle sets. NULL and
    empty texts have empty sets and link with nothing: their component is their own id. Repeated
    rows each give a row. Rows without an id take part, and get the least id of their component,
    if it has one. Other columns are not looked at. An empty table gives an empty result.

    Clusters of near copies are compared in chunks of a bounded number of shingles, so no task
    holds a whole cluster, however large, and a bounded share of all pairs is on disk at once; exact copies are one node from the start.
    """
    docs = with_text_hashes(docs)
    with release_scratch(docs.sparkSession):  # the ties, once they have told the clusters
        common = common_shingles(docs, width)
        tied = settled(sets_and_ties(docs, width, percent, common, bucket_bits(docs)), "ties")
        clusters = settled(clusters_of(tied), "clusters", keep=True)
        sets = tied.where(F.col("u").isNull()).drop("u", "v")
        sets = settled(sets, "sets", keep=True)

    full = sets.where(F.col("node").isNotNull())
    placed = full.withColumn("place", F.explode(F.array_compact(F.array("v0", "v1"))))
    nodes = placed.groupBy("node", "check", "n_shingles", "place").agg(
        F.min(F.struct("t1", "t2")).alias("text"), F.min("doc_id").alias("least_id")
    )
    nodes = materialize(nodes.join(_measured(clusters), "place"), "nodes")
    members = nodes.select(
        "root", "n_shingles", F.xxhash64("node", "check").alias("uid"), "text.t1", "text.t2"
    )
    chunks = F.greatest(
        F.lit(1), F.ceil(F.sum("n_shingles") / F.lit(float(chunk)))
    ).cast("long")
    weights = materialize(
        members.groupBy("root").agg(chunks.alias("chunks"), F.sum("n_shingles").alias("shingles")),
        "weights",
    )
    heavy = weights.groupBy("chunks").agg(F.sum("shingles")).collect() or [(1, 0)]
    room = max(ROUND * sum(shingles for _, shingles in heavy), ROUND_SHINGLES)
    rounds = rounds_of(heavy, room)
    members = members.join(_measured(weights.drop("shingles")), "root")
    members = members.withColumn("chunk", F.pmod("uid", "chunks")).withColumnRenamed("uid", "node")
    members = materialize(members, "members")
    wanted = materialize(members.select("t1", "t2").distinct(), "wanted_texts")
    few = wanted.count() <= BROADCAST_KEYS
    wanted = F.broadcast(wanted) if few else wanted
    texts = docs.join(wanted, ["t1", "t2"], "left_semi")
    texts = texts.groupBy("t1", "t2").agg(F.first("text").alias("text"))
    members = members.join(texts, ["t1", "t2"])
    filled = member_sets(members, width)
    with release_scratch(docs.sparkSession):
        if len(rounds) > 1 or not few:  # the shuffled texts go before sets are dealt out
            filled = settled(filled, "member_sets")
        links = [settled(linked_sets(filled, percent, *steps), "links", keep=True) for steps in rounds]
    links = functools.reduce(DataFrame.union, links)
    groups = materialize(components(links, "groups"), "groups")

    named = nodes.select(
        "node", "check", "n_shingles", "least_id", F.xxhash64("node", "check").alias("uid")
    ).distinct().join(_measured(groups.withColumnRenamed("node", "uid").withColumnRenamed("root", "group")), "uid")
    least = materialize(
        named.groupBy("group").agg(F.min("least_id").alias("component_id")), "components"
    )
    named = named.join(_measured(least), "group").select(
        "node", "check", "n_shingles", "component_id", "group"
    )
    alone = full.groupBy("node", "check", "n_shingles").agg(F.min("doc_id").alias("_least"))
    single = materialize(
        alone.join(_measured(named), ["node", "check", "n_shingles"], "left").select(
            "node",
            "check",
            "n_shingles",
            F.coalesce("component_id", "_least").alias("component_id"),
            F.coalesce("group", F.xxhash64("node", "check")).alias("group_id"),
        ),
        "labels",
    )
    rows = sets.select("doc_id", "t1", "t2", "n_shingles", "node", "check")
    out = rows.join(single, ["node", "check", "n_shingles"], "left")
    component = F.coalesce("component_id", "doc_id").alias("component_id")
    return out.select("doc_id", "t1", "t2", "n_shingles", component, "group_id")


def _measured(stored: DataFrame) -> DataFrame:
    """Broadcast a stored table if it is small."""
    return F.broadcast(stored) if stored.count() <= BROADCAST_ROWS else stored
