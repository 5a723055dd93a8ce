"""Best-fit packing of documents' tokens into sequences, by exact-complement hashing.

Packing depends on lengths alone, and there are at most ``capacity`` of them. So the plan is made
from the histogram of lengths: single, pair and triple sums of lengths that are still available are
looked up to fill the gap beside a long piece exactly; what remains is packed best-fit. The plan
names, for every length, which ranks of its pieces go to which sequences. Pieces get their rank
from two levels (cells of a hash, rows of a cell), so a length that many pieces share is no
bottleneck, and no document passes through the driver.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from blobframe.session import materialize

from .common import join_measured, square_bits, top_bits

CAPACITY = 2048
#: Texts of these characters alone take the quick way to the same ids; see :func:`Encoder.encode`.
PLAIN_TEXT = re.compile("[\t\n\r\x20-\x7eÀ-ÖØ-öø-ɏ]*")
LETTERS = "A-Za-zÀ-ÖØ-öø-ɏ"
#: The tokenizer's own cutting pattern, restricted to the characters above.
PLAIN_PIECES = re.compile(
    f"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTERS}]+| ?[0-9]+| ?[^\\s0-9{LETTERS}]+|\\s+(?!\\S)|\\s+"
)
SPECIAL = "<|endoftext|>"
CACHED_PIECES = 300_000
PIECE_FIELDS = [
    ("doc_id", pa.int64()),
    ("piece", pa.int32()),
    ("start", pa.int64()),
    ("length", pa.int64()),
    ("ids_crc32", pa.int64()),
]
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit numbers, followed by the end id.

    The tokenizer cuts a text into pieces and encodes each on its own. Texts of plain characters
    are cut with an equivalent pattern of the standard library, and each piece is encoded once and
    remembered; all other texts, and those that spell the special token, go to the tokenizer whole.
    """

    def __init__(self, vocabulary: str, ranks: str, pattern: str, end: int = 0):
        import tiktoken
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(vocabulary)
        with open(ranks, "rb") as lines:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.single = tiktoken.Encoding(
            "pieces", pat_str=pattern, mergeable_ranks=table, special_tokens={}
        )
        self.end = np.array([end], "<u4").tobytes()
        self.known: dict[str, bytes] = {}

    def encode(self, text: str) -> bytes:
        if not PLAIN_TEXT.fullmatch(text) or SPECIAL in text:
            ids = self.whole.encode(text, add_special_tokens=False).ids
            return np.array(ids, "<u4").tobytes() + self.end
        known = self.known
        pieces = PLAIN_PIECES.findall(text)
        for piece in {p for p in pieces if p not in known}:
            known[piece] = np.array(self.single.encode_ordinary(piece), "<u4").tobytes()
        out = b"".join([known[piece] for piece in pieces])
        if len(known) > CACHED_PIECES:
            known.clear()
        return out + self.end


def cut(n: int, capacity: int) -> Iterator[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``n`` ids; only the first may be shorter."""
    first = n % capacity or capacity
    yield 0, first
    for start in range(first, n, capacity):
        yield start, capacity


def encode_pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of every document: doc_id, piece, start, length, ids_crc32. NULL texts are empty.

    ``vocabulary`` names a file of the public tokenizers; its ranks lie beside it.
    """

    def run(batches):
        import public_tokenizers

        encoder = Encoder(
            public_tokenizers.path(vocabulary),
            public_tokenizers.path(vocabulary.rsplit(".", 1)[0] + ".tiktoken"),
            public_tokenizers.PATTERN,
        )
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                ids = encoder.encode(text.as_py() or "")
                pieces = cut(len(ids) // 4, capacity)
                rows += [
                    (doc_id.as_py(), i, at, n, zlib.crc32(memoryview(ids)[4 * at : 4 * (at + n)]))
                    for i, (at, n) in enumerate(pieces)
                ]
            columns = list(zip(*rows, strict=True)) or [[]] * len(PIECE_FIELDS)
            yield pa.record_batch(
                [pa.array(c, t) for c, (_, t) in zip(columns, PIECE_FIELDS, strict=True)],
                names=[name for name, _ in PIECE_FIELDS],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, PIECES)


def consume(counts: np.ndarray, lengths: tuple[int, ...], plan: list) -> int:
    """Pack as many sequences of just these lengths as the counts allow."""
    need = {x: lengths.count(x) for x in lengths}
    times = min(int(counts[x]) // k for x, k in need.items())
    if times > 0:
        for x, k in need.items():
            counts[x] -= k * times
        plan.append((lengths, times))
    return times


def fill_exactly(
    counts: np.ndarray, length: int, capacity: int, plan: list, most: int = 3
) -> None:
    """Fill the gap beside ``length`` with up to ``most`` available lengths of just that sum."""
    gap = capacity - length
    if gap and counts[gap]:
        consume(counts, (length, gap), plan)
    if counts[length] and gap >= 2 and most >= 2:
        a = np.arange(gap - 1, (gap - 1) // 2, -1)
        for x in a[(counts[a] > 0) & (counts[gap - a] > 0)]:
            consume(counts, (length, int(x), int(gap - x)), plan)
            if not counts[length]:
                return
    if counts[length] and gap >= 3 and most >= 3:
        for x in np.flatnonzero(counts[: gap - 1])[::-1]:
            rest = gap - int(x)
            b = np.arange(min(int(x), rest - 1), (rest - 1) // 2, -1)
            for y in b[(counts[b] > 0) & (counts[rest - b] > 0)]:
                consume(counts, (length, int(x), int(y), int(rest - y)), plan)
                if not counts[length]:
                    return


def best_fit(counts: np.ndarray, capacity: int, plan: list) -> None:
    """Pack what remains: longest first, each into the fullest sequence that has room."""
    open_bins: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    for length in range(capacity, 0, -1):
        left = int(counts[length])
        while left:
            room = min((g for g in open_bins if g >= length), default=None)
            if room is None:
                each = capacity // length
                times = left // each
                if times:
                    open_bins.setdefault(capacity - each * length, []).append(
                        ((length,) * each, times)
                    )
                if left % each:
                    few = (length,) * (left % each)
                    open_bins.setdefault(capacity - len(few) * length, []).append((few, 1))
                break
            held, times = open_bins[room].pop()
            if not open_bins[room]:
                del open_bins[room]
            each = min(room // length, max(1, left // times))
            used = min(times, left // each)
            if used < times:
                open_bins.setdefault(room, []).append((held, times - used))
            after = room - each * length
            open_bins.setdefault(after, []).append((held + (length,) * each, used))
            left -= each * used
        counts[length] = 0
    for bins in open_bins.values():
        plan += bins


def packing_plan(histogram: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """(lengths, how many sequences of just these); the lengths' counts come from ``histogram``.

    Of the plans that fill gaps exactly by up to three, two, one and no lengths, the one with the
    fewest sequences.
    """
    plans = []
    for most in (3, 2, 1, 0):
        counts = np.zeros(capacity + 1, np.int64)
        for length, n in histogram.items():
            counts[length] = n
        plan: list[tuple[tuple[int, ...], int]] = []
        consume(counts, (capacity,), plan)
        for length in range(capacity - 1, 0, -1):
            if counts[length] and most:
                fill_exactly(counts, length, capacity, plan, most)
        best_fit(counts, capacity, plan)
        plans.append(plan)
    return min(plans, key=lambda plan: sum(times for _, times in plan))


def plan_by_length(plan: list) -> list[tuple]:
    """Per length: the first rank of each run of pieces, and the run's first sequence and offset."""
    runs: dict[int, list[tuple[int, int, int]]] = {}
    taken: dict[int, int] = {}
    sequence = 0
    for lengths, times in plan:
        offset = 0
        for length in lengths:
            rank = taken.get(length, 0)
            runs.setdefault(length, []).append((rank, sequence, offset))
            taken[length] = rank + times
            offset += length
        sequence += times
    return [(length, *map(list, zip(*found, strict=True))) for length, found in runs.items()]


def rank_in_length(pieces: DataFrame) -> DataFrame:
    """Add ``rank``: a number from 0 without gaps among the pieces of the same length."""
    bits = square_bits(pieces.count())
    key = F.xxhash64("doc_id", "piece", "ids_crc32")
    pieces = pieces.withColumn("_cell", top_bits(key, bits))
    cells = pieces.groupBy("length", "_cell").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("length").orderBy("_cell")
    base = F.sum("_n").over(before.rowsBetween(Window.unboundedPreceding, -1))
    bases = cells.select("length", "_cell", F.coalesce(base, F.lit(0)).alias("_base"))
    pieces = join_measured(pieces, bases, ["length", "_cell"], "ranks")
    inside = Window.partitionBy("length", "_cell").orderBy("doc_id", "piece", "ids_crc32")
    rank = F.col("_base") + F.row_number().over(inside) - 1
    return pieces.withColumn("rank", rank).drop("_cell", "_base")


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to stored pieces that have a ``length`` up to ``capacity``.

    The driver holds the histogram of lengths and the plan, which ``capacity`` bounds. Equal pieces
    are interchangeable. An empty table gives an empty result.
    """
    spark = pieces.sparkSession
    histogram = {r[0]: r[1] for r in pieces.groupBy("length").count().collect()}
    rows = plan_by_length(packing_plan(histogram, capacity))
    plan = spark.createDataFrame(
        rows, "length long, starts array<long>, sequences array<long>, offsets array<long>"
    )
    placed = rank_in_length(pieces).join(F.broadcast(plan), "length", "left")
    run = F.size(F.filter("starts", lambda s: s <= F.col("rank"))) - 1
    placed = placed.withColumn("_run", run)
    at = lambda name: F.get(F.col(name), F.col("_run"))
    return placed.withColumns(
        {"sequence_id": at("sequences") + F.col("rank") - at("starts"), "offset": at("offsets")}
    ).drop("_run", "rank", "starts", "sequences", "offsets")


def pack_documents(
    docs: DataFrame, vocabulary: str = "byte_bpe_50k.json", capacity: int = CAPACITY
) -> DataFrame:
    """Cut, encode and pack all documents: one row per piece, with its place in a sequence.

    NULL and empty texts are pieces of the end id alone. Repeated rows are packed as often as they
    occur. Other columns are not looked at. Texts are encoded once: the pieces' lengths and
    checksums are stored before they are ranked.
    """
    pieces = materialize(encode_pieces(docs, vocabulary, capacity), "pieces")
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    return pack(pieces, capacity).select(*columns)
