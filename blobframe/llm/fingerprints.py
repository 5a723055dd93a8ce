"""SimHash fingerprints of documents, and exact search within a Hamming radius.

Every run of five words votes on 64 bits with its hash, as often as it occurs. Votes are summed two
bits to a number, so a text costs 32 sums. Near fingerprints are found through tables of permuted
blocks: 64 bits in six blocks, of which three at least are equal in fingerprints that differ in up
to three bits; each choice of three is a table. Native columns only.
"""

from __future__ import annotations

import math
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from blobframe.session import materialize

from .common import join_measured, words_of

SHINGLE = 5
BITS = 64
RADIUS = 3
SPARE_BLOCKS = 3
#: Documents in a range of ids within which the next document is looked up, and most such ranges.
#: Beyond 200 million documents ranges grow; at 10 billion one has 100,000, which a task sorts.
RANGE_ROWS = 2000
MOST_RANGES = 100_000
_PAIR = 0x0000000100000001


def term_hashes(words: str) -> Column:
    """Hashes of the runs of five words in a column; fewer words are one run, none give none."""
    size = F.size(words)
    starts = F.slice(words, 1, F.when(size == 0, 0).otherwise(F.greatest(size - SHINGLE + 1, F.lit(1))))
    following = lambda i: [F.get(words, i + k) for k in range(1, SHINGLE)]
    return F.transform(starts, lambda word, i: F.xxhash64(word, *following(i)))


def vote(df: DataFrame, keys: list[str], hashed: str) -> DataFrame:
    """Fingerprint (long) of each group of ``keys`` from the rows' hashes (NULL: no vote)."""
    sums = [
        F.sum(F.shiftrightunsigned(hashed, i).bitwiseAND(F.lit(_PAIR))).alias(f"_v{i}")
        for i in range(BITS // 2)
    ]
    voted = df.groupBy(*keys).agg(F.count(hashed).alias("_n"), *sums)
    bits = []
    for i in range(BITS // 2):
        low = F.col(f"_v{i}").bitwiseAND(F.lit(0xFFFFFFFF))
        high = F.shiftrightunsigned(f"_v{i}", 32)
        for place, count in ((i, low), (i + 32, high)):
            won = F.coalesce(2 * count > F.col("_n"), F.lit(False))
            bits.append(F.when(won, F.shiftleft(F.lit(1).cast("long"), place)).otherwise(F.lit(0)))
    total = bits[0].cast("long")
    for bit in bits[1:]:
        total = total.bitwiseOR(bit.cast("long"))
    return voted.select(*keys, total.alias("fingerprint"))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal bits."""
    return (BITS - F.bit_count(a.bitwiseXOR(b))) / float(BITS)


def block_masks(radius: int = RADIUS, spare: int = SPARE_BLOCKS) -> list[int]:
    """Masks of the tables: ``spare`` of ``radius + spare`` blocks each, as signed 64-bit numbers."""
    blocks = radius + spare
    edges = [BITS * k // blocks for k in range(blocks + 1)]
    block = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:], strict=False)]
    masks = [sum(block[i] for i in kept) for kept in combinations(range(blocks), spare)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def within_radius(
    queries: DataFrame, fingerprints: DataFrame, radius: int = RADIUS
) -> DataFrame:
    """All pairs (query, fingerprint, distance) of distinct fingerprints up to ``radius`` apart.

    Both sides have a column ``fingerprint`` (long); NULL ones match nothing. Every pair is found,
    and once: by the first table whose blocks are all equal.
    """
    masks = F.array(*[F.lit(m).cast("long") for m in block_masks(radius)])

    def tables(df: DataFrame, name: str) -> DataFrame:
        df = df.select("fingerprint").where(F.col("fingerprint").isNotNull()).distinct()
        keyed = F.transform(
            masks,
            lambda m, i: F.struct(i.alias("t"), F.col("fingerprint").bitwiseAND(m).alias("key")),
        )
        rows = df.withColumn("_k", F.explode(keyed))
        return rows.select(F.col("fingerprint").alias(name), "_k.t", "_k.key")

    differing = F.col("query").bitwiseXOR(F.col("fingerprint"))
    met = tables(queries, "query").join(tables(fingerprints, "fingerprint"), ["t", "key"])
    distance = F.bit_count(differing)
    first = F.forall(F.slice(masks, 1, F.col("t")), lambda m: differing.bitwiseAND(m) != 0)
    return met.where((distance <= radius) & first).select(
        "query", "fingerprint", distance.alias("distance")
    )


def id_ranges(docs: DataFrame) -> tuple[list[int], list[int]]:
    """Upper bounds of ranges of ids with about RANGE_ROWS rows, and the first id of each range.

    Both have at most MOST_RANGES entries. A bound is an id, so no range but the last can be empty.
    """
    ids = docs.where(F.col("doc_id").isNotNull())
    rows = ids.count()
    n = max(1, min(MOST_RANGES, rows // RANGE_ROWS))
    bounds: list[int] = []
    if n > 1:
        shares = [k / n for k in range(1, n)]
        bounds = sorted(set(ids.agg(F.percentile_approx("doc_id", shares, 10 * n)).first()[0]))
    placed = ids.select("doc_id", range_of(bounds).alias("r"))
    firsts = placed.groupBy("r").agg(F.min("doc_id").alias("f")).orderBy("r").collect()
    return bounds, [r["f"] for r in firsts]


def numbers(values: list[int]) -> Column:
    """An array literal, however long."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def range_of(bounds: list[int]) -> Column:
    """How many bounds are below the id: whole blocks of them first, then those of the next block."""
    if not bounds:
        return F.lit(0)
    step = math.isqrt(len(bounds)) + 1
    below = lambda these: F.size(F.filter(these, lambda b: b < F.col("doc_id")))
    last_ones = bounds[step - 1 :: step]
    skipped = below(numbers(last_ones)) * step if last_ones else F.lit(0)
    return skipped + below(F.slice(numbers(bounds), skipped + 1, F.lit(step)))


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness.

    The edited text has its last quarter (rounded down) replaced by as many code points from the
    start of the next document by id (after the last: the first). Returns doc_id, n_chars,
    edited_sha256, the two fingerprints (long) and that of the next document.

    Texts are shuffled once, by range of ids; the first document of a range is also dealt to the
    range before it. NULL texts are empty. Rows with equal ids are ordered by a hash of their text.
    Rows without an id have no next document and only lose their last quarter. A lone document is
    its own next one. Other columns are not looked at. An empty table gives an empty result.
    """
    docs = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    )
    bounds, firsts = id_ranges(docs)
    n_ranges = max(1, len(firsts))
    docs = docs.withColumn("_home", range_of(bounds))
    guest_of = F.lit(None).cast("int")
    if firsts:  # the first document of the first range is also dealt to the last one
        leads = F.get(numbers(firsts), F.col("_home")) == F.col("doc_id")
        guest_of = F.when(leads, F.pmod(F.col("_home") - 1, F.lit(n_ranges)).cast("int"))
    lost = -1 - F.pmod(F.xxhash64("text"), F.lit(n_ranges)).cast("int")
    home = F.when(F.col("doc_id").isNull(), lost).otherwise(F.col("_home"))
    places = F.array_compact(
        F.array(
            F.struct(home.alias("r"), F.lit(False).alias("guest")),
            F.when(guest_of.isNotNull(), F.struct(guest_of.alias("r"), F.lit(True).alias("guest"))),
        )
    )
    dealt = docs.withColumn("_p", F.explode(places)).select(
        "doc_id", "text", F.col("_p.r").alias("_r"), F.col("_p.guest").alias("_guest")
    )
    order = Window.partitionBy("_r").orderBy("_guest", "doc_id", F.xxhash64("text"))
    following = F.when(F.col("doc_id").isNotNull(), F.lead("text").over(order))
    dealt = dealt.withColumns({"_next": following, "_row": F.row_number().over(order)})
    n = F.length("text")
    tail = F.floor(n / 4).cast("int")
    edited = F.concat(
        F.substr("text", F.lit(1), n - tail),
        F.substr(F.coalesce("_next", F.lit("")), F.lit(1), tail),
    )
    keys = ["_r", "_row", "_guest", "doc_id", "n_chars", "edited_sha256"]
    df = dealt.select(
        "_r", "_row", "_guest", "doc_id", "text", n.cast("long").alias("n_chars"),
        F.when(~F.col("_guest"), edited).alias("_edited"),
    )
    df = df.select(
        *keys[:5],
        F.sha2(F.col("_edited").cast("binary"), 256).alias("edited_sha256"),
        words_of(F.col("text")).alias("_w0"),
        words_of(F.coalesce("_edited", F.lit(""))).alias("_w1"),
    )
    df = df.withColumns({f"_h{k}": term_hashes(f"_w{k}") for k in (0, 1)})
    entry = lambda k, h: F.struct(F.lit(k).alias("k"), h.alias("h"))
    nothing = F.lit(None).cast("long")
    votes = F.concat(
        F.array(entry(0, nothing), entry(1, nothing)),
        F.transform("_h0", lambda h: entry(0, h)),
        F.transform("_h1", lambda h: entry(1, h)),
    )
    rows = df.select(*keys, F.explode(votes).alias("_v")).select(
        *keys, F.col("_v.k").alias("_k"), F.col("_v.h").alias("_h")
    )
    voted = vote(rows, [*keys, "_k"], "_h")
    of = lambda k: F.max(F.when(F.col("_k") == k, F.col("fingerprint")))
    both = voted.groupBy(*keys).agg(of(0).alias("fingerprint"), of(1).alias("edited_fingerprint"))
    by_row = Window.partitionBy("_r").orderBy("_row")
    next_one = F.when(F.col("doc_id").isNotNull(), F.lead("fingerprint").over(by_row))
    both = both.withColumn("next_fingerprint", next_one).where(~F.col("_guest"))
    return both.drop("_r", "_row", "_guest")


def spelled(fingerprint: Column) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))


def document_fingerprints(docs: DataFrame, every: int = 100, radius: int = RADIUS) -> DataFrame:
    """Fingerprints and likenesses, and for ids divisible by ``every`` how many documents are near.

    ``n_near`` counts the documents whose fingerprint differs in up to ``radius`` bits, the document
    itself among them; equal fingerprints are looked up once. See :func:`edited_fingerprints`.
    """
    found = materialize(edited_fingerprints(docs), "fingerprints")
    counts = found.groupBy("fingerprint").agg(F.count("*").alias("_docs"))
    asked = found.where(F.col("doc_id") % every == 0)
    near = within_radius(asked, found, radius)
    near = join_measured(near, counts, ["fingerprint"], "fingerprint_counts")
    near = near.groupBy(F.col("query").alias("fingerprint")).agg(F.sum("_docs").alias("n_near"))
    out = join_measured(found, near, ["fingerprint"], "near_fingerprints")
    next_one = F.coalesce("next_fingerprint", F.lit(0).cast("long"))
    return out.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        spelled(F.col("fingerprint")).alias("fingerprint"),
        spelled(F.col("edited_fingerprint")).alias("edited_fingerprint"),
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), next_one).alias("near_next"),
        F.when(F.col("doc_id") % every == 0, F.col("n_near")).alias("n_near"),
    )
