"""Mix sources to target weights with a multivariate-hypergeometric splitting tree.

Each source's documents are put in a random order and cut into blocks of equal words. The target of
a source is a whole number of its blocks. A binary tree over the output shards splits the vector of
block quotas, each split drawn from the multivariate hypergeometric distribution, until every shard
knows how many blocks of each source it takes. Shards then take disjoint runs of the permuted
blocks, and each is shuffled locally.

Positions in the random order come from two levels (cells of the hash, rows of a cell), so no task
ever holds a whole source.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from blobframe.session import materialize
from blobframe.sinks.tables import quoted

from .common import BROADCAST_ROWS, join_measured, square_bits, top_bits

WEIGHTS = (5, 2, 1)
RATIO = 1.5
MAX_REPEATS = 2
BLOCK_WORDS = 1 << 16
MIN_BLOCKS = 512
SHARD_WORDS = 1 << 22
MIN_SHARDS = 16
SEED = 20240229
CHOICE = {"size_col": "size", "source_col": "source", "id_col": "doc_id"}


def source_targets(sizes: DataFrame, weights=WEIGHTS, ratio=RATIO, repeats=MAX_REPEATS) -> DataFrame:
    """Targets of sources (``_none``, ``_source``, ``source_size``, ``n_docs``), one row for each.

    Weights repeat over the sources by code point, NULL last. The targets share ``ratio`` of all
    words; what exceeds ``repeats`` times a source's size goes to the others by weight. With the
    sources ordered by the level at which they fill up, that is one running sum. The table has a
    row per source, so it is ordered in one task.
    """
    everything = Window.partitionBy()
    by_name = Window.partitionBy().orderBy("_none", "_source")
    turn = F.row_number().over(by_name) - 1
    cap = F.lit(float(repeats)) * F.col("source_size")
    df = sizes.withColumn("rank", turn.cast("long"))
    weight = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int")
    )
    df = df.withColumns({"_weight": weight, "_cap": cap})
    df = df.withColumns(
        {
            "_full_at": F.col("_cap") / F.col("_weight"),
            "_wanted": F.lit(float(ratio)) * F.sum("source_size").over(everything),
        }
    )
    filling = Window.partitionBy().orderBy("_full_at", "rank")
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    onward = filling.rowsBetween(0, Window.unboundedFollowing)
    level = (F.col("_wanted") - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))) / F.sum(
        "_weight"
    ).over(onward)
    df = df.withColumn("_level", level)
    held = F.max(F.when(F.col("_level") <= F.col("_full_at"), F.col("_level"))).over(everything)
    df = df.withColumn("_held", held)
    target = F.least("_cap", F.coalesce(F.col("_held") * F.col("_weight"), F.col("_cap")))
    return df.withColumn("target", target).select(*sizes.columns, "rank", "target")


def log_factorial(n: Column) -> Column:
    """ln n!: exact up to 20, Stirling's series beyond (error below 1e-9)."""
    x = F.greatest(n, F.lit(1)).cast("double")
    series = x * F.log(x) - x + 0.5 * F.log(2 * math.pi * x) + 1 / (12 * x) - 1 / (360 * x * x * x)
    small = F.log(F.factorial(F.least(n, F.lit(20)).cast("int")).cast("double"))
    return F.when(n <= 20, small).otherwise(series)


def hypergeometric(uniform: Column, marked: Column, total: Column, draws: Column) -> Column:
    """How many of ``marked`` among ``total`` are in ``draws``: the quantile at ``uniform``."""
    least = F.greatest(F.lit(0).cast("long"), draws - (total - marked))
    most = F.least(marked, draws)
    mean = draws * marked / F.greatest(total, F.lit(1))
    spread = F.sqrt(mean * (1 - marked / F.greatest(total, F.lit(1)))) + 1
    low = F.greatest(least, F.floor(mean - 9 * spread))
    high = F.least(most, F.ceil(mean + 9 * spread))

    def chance(k: Column) -> Column:
        ways = log_factorial(marked) - log_factorial(k) - log_factorial(marked - k)
        rest = total - marked
        ways += log_factorial(rest) - log_factorial(draws - k) - log_factorial(rest - draws + k)
        return F.exp(
            ways - log_factorial(total) + log_factorial(draws) + log_factorial(total - draws)
        )

    start = F.struct(F.lit(0.0).alias("p"), F.lit(None).cast("long").alias("k"))

    def step(state: Column, k: Column) -> Column:
        p = state["p"] + chance(k)
        return F.struct(
            p.alias("p"),
            F.coalesce(state["k"], F.when(p >= uniform, k)).cast("long").alias("k"),
        )

    found = F.aggregate(F.sequence(low, high), start, step, lambda s: s["k"])
    return F.coalesce(found, most).cast("long")


def uniform_of(*keys: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(F.lit(SEED), *keys), 11) / float(1 << 53)


def split_once(nodes: DataFrame) -> DataFrame:
    """Split every node (``first``, ``width``, ``quotas``) in two halves of equal shards."""
    total = F.aggregate("quotas", F.lit(0).cast("long"), lambda a, q: a + q)
    none = F.array().cast("array<bigint>")
    start = F.struct(
        total.alias("pool"), F.floor(total / 2).cast("long").alias("draws"), none.alias("out")
    )

    def take(state: Column, entry: Column) -> Column:
        uniform = uniform_of(F.col("first"), F.col("width"), entry["i"])
        drawn = hypergeometric(uniform, entry["q"], state["pool"], state["draws"])
        after = lambda k: F.struct(
            (state["pool"] - entry["q"]).alias("pool"),
            (state["draws"] - k).alias("draws"),
            F.concat(state["out"], F.array(k)).alias("out"),
        )
        return F.get(F.transform(F.array(drawn), after), F.lit(0))

    entries = F.transform("quotas", lambda q, i: F.struct(q.alias("q"), i.alias("i")))
    left = F.aggregate(entries, start, take, lambda s: s["out"])
    half = F.col("width") / 2
    nodes = nodes.withColumn("_left", left)
    right = F.zip_with("quotas", "_left", lambda q, k: q - k)
    halves = F.array(
        F.struct(F.col("first").alias("first"), F.col("_left").alias("quotas")),
        F.struct((F.col("first") + half).cast("long").alias("first"), right.alias("quotas")),
    )
    return nodes.select(half.cast("long").alias("width"), F.explode(halves).alias("n")).select(
        "n.first", "width", "n.quotas"
    )


def shard_blocks(sources: DataFrame, shards: int) -> DataFrame:
    """``rank, block, shard``: which shard takes a block, for every block that is taken.

    One row travels down the tree, with one number per source; ``shards`` is a power of two.
    """
    nodes = sources.agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("rank", "quota"))), lambda x: x["quota"]
        ).alias("quotas")
    ).select(F.lit(0).cast("long").alias("first"), F.lit(shards).cast("long").alias("width"), "quotas")
    for level in range(shards.bit_length() - 1):
        nodes = materialize(split_once(nodes), f"tree_{level}")
    leaves = nodes.select("first", F.posexplode("quotas").alias("place", "q")).where("q > 0")
    upto = Window.partitionBy("place").orderBy("first").rowsBetween(Window.unboundedPreceding, 0)
    leaves = leaves.withColumn("cut", F.sum("q").over(upto))
    blocks = F.explode(F.sequence(F.col("cut") - F.col("q"), F.col("cut") - 1))
    return leaves.select(
        F.col("place").cast("long").alias("rank"), blocks.alias("block"), F.col("first").alias("shard")
    )


def choose_copies(
    docs: DataFrame,
    size_col: str = "size",
    source_col: str = "source",
    id_col: str = "doc_id",
    weights=WEIGHTS,
    ratio: float = RATIO,
    shards: int | None = None,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """Add ``source_size``, ``target`` and ``copies`` (shard and order of each) to every document.

    Taken are whole documents, at most twice each: the first pass over a source takes them in the
    order of a hash, the second one in the opposite order. A document belongs to the block in which
    its middle lies. NULL sizes count as 0; documents of size 0 are never taken. NULL sources are
    one source. Rows equal in id, source and size are interchangeable. Reruns agree. An empty table
    gives an empty result. Columns named like a result are replaced.
    """
    results = ("source_size", "target", "copies")
    kept = [c for c in docs.columns if c not in results]
    docs = docs.select(
        F.struct(*(F.col(quoted(c)) for c in kept)).alias("_row"),  # no name can clash in there
        F.col(id_col).alias("_id"),
        F.coalesce(F.col(size_col), F.lit(0)).cast("long").alias("_size"),
        F.col(source_col).isNull().alias("_none"),
        F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("_source"),
    )
    docs = docs.withColumn("_h", F.xxhash64(F.lit(SEED), "_id", "_none", "_source", "_size"))
    source = ["_none", "_source"]
    total = docs.agg(F.count("*").alias("n"), F.sum("_size").alias("s")).first()
    bits = square_bits(total["n"])
    docs = docs.withColumn("_cell", top_bits(F.col("_h"), bits))
    cells = materialize(
        docs.groupBy(*source, "_cell").agg(
            F.sum("_size").alias("_cell_size"),
            F.sum((F.col("_size") > 0).cast("long")).alias("_cell_docs"),
        ),
        "cells",
    )
    before = Window.partitionBy(*source).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    bases = cells.select(
        *source, "_cell", F.coalesce(F.sum("_cell_size").over(before), F.lit(0)).alias("_base")
    )
    sizes = cells.groupBy(*source).agg(
        F.sum("_cell_size").alias("source_size"), F.sum("_cell_docs").alias("n_docs")
    )
    blocks = F.greatest(
        F.lit(1),
        F.least(
            F.col("n_docs"),
            F.greatest(F.ceil(F.col("source_size") / block_words), F.lit(MIN_BLOCKS)),
        ),
    ).cast("long")
    sources = source_targets(sizes, weights, ratio).withColumn("blocks", blocks)
    quota = F.round(F.col("target") * F.col("blocks") / F.greatest("source_size", F.lit(1)))
    sources = materialize(sources.withColumn("quota", quota.cast("long")), "sources")
    if shards is None:
        wanted = max(MIN_SHARDS, math.ceil(ratio * (total["s"] or 0) / SHARD_WORDS))
        shards = 1 << (wanted - 1).bit_length()
    taken = materialize(shard_blocks(sources, shards), "taken")

    docs = join_measured(docs, bases, [*source, "_cell"], "bases")
    order = Window.partitionBy(*source, "_cell").orderBy("_h", "_id")
    inside = F.sum("_size").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_size")
    docs = docs.withColumn("_middle", F.col("_base") + inside + F.col("_size") / 2)
    docs = join_measured(docs, sources.drop("n_docs", "quota"), source, "quotas")
    per_word = F.col("blocks") / F.greatest("source_size", F.lit(1))
    last = F.col("blocks") - 1
    first_pass = F.least(last, F.floor(F.col("_middle") * per_word))
    second_pass = F.col("blocks") + F.least(
        last, F.floor((F.col("source_size") - F.col("_middle")) * per_word)
    )
    passes = [p.cast("long") for p in (first_pass, second_pass)]
    # A block that no shard takes, and a document without words, finds no shard.
    docs = docs.withColumns({f"_block{k}": F.when(F.col("_size") > 0, p) for k, p in enumerate(passes)})
    few = F.broadcast(taken) if taken.count() <= BROADCAST_ROWS else taken
    for k in range(len(passes)):
        side = few.select("rank", F.col("block").alias(f"_block{k}"), F.col("shard").alias(f"_shard{k}"))
        docs = docs.join(side, ["rank", f"_block{k}"], "left")
    copies = [
        F.when(
            F.col(f"_shard{k}").isNotNull(),
            F.struct(
                F.col(f"_shard{k}").alias("shard"),
                F.xxhash64(F.lit(SEED), F.col("_h"), F.lit(k)).alias("order"),
            ),
        )
        for k in range(len(passes))
    ]
    copies = F.array_compact(F.array(*copies)).alias("copies")
    return docs.select("_row.*", "source_size", "target", copies)


def mix_sources(docs: DataFrame, slices: int = 4, **options) -> DataFrame:
    """The mix itself: every taken copy of every document, dealt to its shard and shuffled there.

    A shard is ``slices`` runs of partitions, each in random order. Returns the columns of ``docs``
    and ``shard``. See :func:`choose_copies` for the options and the odd cases.
    """
    rows = docs.select(
        F.struct(*(F.col(quoted(c)) for c in docs.columns if c != "shard")).alias("row"),
        *(F.col(options.pop(key, default)).alias(default) for key, default in CHOICE.items()),
    )
    picked = choose_copies(rows, **options)
    copies = picked.select("row", F.explode("copies").alias("copy"))
    copies = copies.select("row", "copy.*", F.pmod("copy.order", F.lit(slices)).alias("slice"))
    copies = copies.repartition("shard", "slice").sortWithinPartitions("shard", "slice", "order")
    return copies.select("row.*", "shard")
