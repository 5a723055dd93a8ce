"""Finding, for each file name, the first archive member that answers to it.

Both ways of matching are equi-joins. ``exact`` looks the name itself up. ``contains`` looks up
pieces of the name, each as long as some member name, so a member matches exactly if its name occurs
in the file name; no pair of a name and a member is formed that does not match.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blobframe.operators.fetch import place_struct
from blobframe.session import materialize, observed

# In-memory bytes up to which a side is broadcast, and what a row takes beyond its text.
BROADCAST_BYTES = 64 << 20
ROW_OVERHEAD = 200
# Pieces are looked up by their beginnings first if there are more lengths than this per beginning.
LENGTHS_PER_ANCHOR = 2


def first_match(
    names: DataFrame,
    index: DataFrame,
    match: str = "contains",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """``fn, place`` for every name in ``names`` (one column ``fn``, distinct) that has a match.

    ``place`` is that of the first matching member in the order of (archive, offset). ``index`` is
    read several times, so it should be stored.
    """
    if match not in ("exact", "contains"):
        raise ValueError(f"match must be 'exact' or 'contains', not {match!r}")

    sizes = observed(
        index,
        # Lengths of member names, of which the ZIP format allows 65,536.
        lengths=F.collect_set(F.char_length("member")),
        bytes=F.sum(F.octet_length("member") + F.octet_length("archive") + ROW_OVERHEAD),
    )
    lengths = sorted(sizes["lengths"] or [])
    if not lengths:
        no_place = F.lit(None).cast(index.select(place_struct()).schema[0].dataType)
        return names.select("fn", no_place.alias("place")).where(F.lit(False))

    anchors = anchor_lengths(lengths)
    by_beginning = match == "contains" and len(lengths) > LENGTHS_PER_ANCHOR * len(anchors)

    if sizes["bytes"] <= broadcast_bytes:
        asked = pieces(names, match, lengths)
        if by_beginning:
            asked = likely_pieces(names, F.broadcast(beginnings(index, anchors)), anchors)
        best = F.broadcast(first_of_each(index))
        found = asked.join(best, F.col("piece") == F.col("member"))
        # A name is looked up once if it must be equal.
        return found.select("fn", "place") if match == "exact" else first_of(found)

    names = materialize(names, "names")
    asked = pieces(names, match, lengths)
    if piece_bytes(names, match, lengths) <= broadcast_bytes:
        # Few pieces against a large index: the index is sifted where it lies, not shuffled.
        wanted = F.broadcast(asked.select(F.col("piece").alias("member")).distinct())
        kept = first_of_each(index.join(wanted, "member", "left_semi"))
        return first_of(asked.join(F.broadcast(kept), F.col("piece") == F.col("member")))

    if by_beginning:
        starts = materialize(beginnings(index, anchors), "beginnings")
        size = F.sum(F.octet_length("beginning") + 4 * F.size("lengths") + ROW_OVERHEAD)
        small = starts.agg(size).first()[0] <= broadcast_bytes
        asked = likely_pieces(names, F.broadcast(starts) if small else starts.hint("merge"), anchors)
    # Stored, so that a piece common to many names can be split; below an aggregate it could not.
    best = materialize(first_of_each(index), "best").hint("merge")
    return first_of(asked.join(best, F.col("piece") == F.col("member")))


def first_of_each(index: DataFrame) -> DataFrame:
    """One row per member name; a name found in many archives is cut down before the shuffle."""
    return index.groupBy("member").agg(F.min(place_struct()).alias("place"))


def first_of(found: DataFrame) -> DataFrame:
    return found.groupBy("fn").agg(F.min("place").alias("place"))


def pieces(names: DataFrame, match: str, lengths: list[int]) -> DataFrame:
    """``fn, piece``: what to look up for each name."""
    if match == "exact":
        return names.select("fn", F.col("fn").alias("piece"))
    return pieces_at(names, lengths).select("fn", "piece")


def pieces_at(names: DataFrame, lengths: list[int]) -> DataFrame:
    """``fn, at, piece``: every piece of one of the lengths, and where it begins."""
    cuts = names.select("fn", F.explode(fitting(lengths, F.char_length("fn"))).alias("n"))
    starts = F.sequence(F.lit(1), F.char_length("fn") - F.col("n") + 1)
    return cuts.select("fn", "n", F.explode(starts).alias("at")).select(
        "fn", "at", F.substr("fn", "at", "n").alias("piece")
    )


def fitting(lengths: list[int], length: Column) -> Column:
    return F.filter(F.lit(lengths), lambda n: n <= length)


def piece_bytes(names: DataFrame, match: str, lengths: list[int]) -> int:
    """About how much memory the pieces of all names would take."""
    by_length = names.groupBy(F.char_length("fn").alias("length")).agg(
        F.count("*").alias("names"), F.sum(F.octet_length("fn")).alias("bytes")
    )
    count = F.lit(1)
    if match == "contains":
        count = F.aggregate(
            fitting(lengths, F.col("length")),
            F.lit(0).cast("long"),
            lambda total, n: total + F.col("length") - n + 1,
        )
    cost = count * (2 * F.col("bytes") + ROW_OVERHEAD * F.col("names"))
    return by_length.agg(F.sum(cost)).first()[0] or 0


def anchor_lengths(lengths: list[int]) -> list[int]:
    """For every power of two, the shortest length from there up to the next."""
    shortest = {}
    for length in sorted(lengths, reverse=True):
        shortest[length.bit_length()] = length
    return sorted(shortest.values())


def beginnings(index: DataFrame, anchors: list[int]) -> DataFrame:
    """``beginning, lengths``: how long the member names are that begin so.

    Of each name its first characters count, as many as the longest anchor that fits.
    """
    length = F.char_length("member")
    anchor = F.array_max(F.filter(F.lit(anchors), lambda n: n <= length))
    starts = index.select(F.substr("member", F.lit(1), anchor).alias("beginning"), length.alias("n"))
    return starts.groupBy("beginning").agg(F.collect_set("n").alias("lengths"))


def likely_pieces(names: DataFrame, starts: DataFrame, anchors: list[int]) -> DataFrame:
    """``fn, piece`` like :func:`pieces`, but only where a member name begins and so long."""
    spots = pieces_at(names, anchors).withColumnRenamed("piece", "beginning")
    cuts = spots.join(starts, "beginning").select("fn", "at", F.explode("lengths").alias("n"))
    fits = F.col("at") + F.col("n") - 1 <= F.char_length("fn")
    return cuts.where(fits).select("fn", F.substr("fn", "at", "n").alias("piece"))
