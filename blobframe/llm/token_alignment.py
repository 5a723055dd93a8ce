"""Alignment of two tokenizers' tokens by the hash sets of their cumulative ends.

A text's tokens of either kind end at byte offsets. A dictionary from end to index is made for each
kind; the keys they share, sorted, slice both id lists into groups, and every token of one kind in a
group is linked with every token of the other.

How many documents hold a pair linked is counted over the corpus, and every document needs the
counts of its own pairs again. So the documents of a task are dealt into blocks of bounded size when
they are encoded; a block says once which pairs it holds and in how many documents, and the counts
of all blocks travel back to the block, so that a pair that nearly every document holds is a row per
block and nothing is gathered by pair that grows with the documents.
"""

from __future__ import annotations

import base64
import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from blobframe.session import materialize

from .packing import PLAIN_TEXT

VOCABULARY_A = "byte_bpe_50k.json"
VOCABULARY_B = "piece_bpe_32k.model"
#: A block is full at so many distinct pairs, counted per document; one larger document is a block.
BLOCK_PAIRS = 1 << 18
NONE = np.empty(0, np.int64)
#: Pairs are one number: A's id times this, plus B's id.
B_IDS = 1 << 32

DOCUMENTS = (
    "block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, "
    "groups_sha256 string, pairs array<long>, times array<int>"
)
DOCUMENTS_ARROW = pa.schema(
    [(c, pa.int64()) for c in ("block", "doc_id", "n_a", "n_b", "n_groups", "n_links")]
    + [("groups_sha256", pa.string())]
    + [("pairs", pa.list_(pa.int64())), ("times", pa.list_(pa.int32()))]
)


def byte_of_letter() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for.

    Printable bytes stand for themselves; the others follow from 256 on, in order.
    """
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in shown}
    hidden = [b for b in range(256) if b not in set(shown)]
    return letters | {chr(256 + k): b for k, b in enumerate(hidden)}


class ByteTokenizer:
    """Byte-level BPE: ids of a text, and the bytes of every id.

    The vocabulary also comes as ranks for a quicker library, which takes texts of plain characters;
    there the two cut alike. Others, and those that may spell a special token, go to the tokenizer.
    """

    def __init__(self, path: str, ranks: str, pattern: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.whole.encode_special_tokens = True
        letters = byte_of_letter()
        vocabulary = self.whole.get_vocab(with_added_tokens=True)
        with open(path) as lines:
            added = {t["id"] for t in json.load(lines)["added_tokens"]}
        self.bytes = [b""] * (max(vocabulary.values()) + 1)
        for entry, number in vocabulary.items():
            whole = number in added
            self.bytes[number] = entry.encode() if whole else bytes(letters[c] for c in entry)
        with open(ranks, "rb") as lines:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.plain = tiktoken.Encoding(
            "plain", pat_str=pattern, mergeable_ranks=table, special_tokens={}
        )

    def encode(self, text: str) -> np.ndarray:
        if PLAIN_TEXT.fullmatch(text) and "<|" not in text:
            return self.plain.encode_to_numpy(text).astype(np.int64)
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, np.int64)


class PieceTokenizer:
    """Sentence pieces: ids of a text, to which it adds a space in front, and the bytes of every id."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = []
        for number in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(number)
            byte = self.model.is_byte(number)
            self.bytes.append(
                bytes([int(piece[1:-1], 16)]) if byte else piece.replace("▁", " ").encode()
            )

    def encode(self, text: str) -> np.ndarray:
        return np.array(self.model.encode(text), np.int64)


def written_ids(count: int, suffixes: str) -> np.ndarray:
    """The decimal ids with each of two suffixes, at id * 2 + number of the suffix."""
    return np.array([f"{k}{s}" for k in range(count) for s in suffixes], dtype=object)


class Aligner:
    def __init__(self, a: ByteTokenizer, b: PieceTokenizer):
        self.a, self.b = a, b
        for kind in (a, b):
            kind.table = np.array(kind.bytes, dtype=object)
        self.sizes = [np.array([len(x) for x in kind.bytes]) for kind in (a, b)]
        self.written = [
            written_ids(len(kind.bytes), ends) for kind, ends in ((a, ",|"), (b, ",;"))
        ]

    def tokens(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids of either kind; none where the tokens' bytes are not a space and the text."""
        data = b" " + text.encode()
        a, b = self.a.encode(" " + text), self.b.encode(text)
        for kind, ids in ((self.a, a), (self.b, b)):
            if b"".join(kind.table[ids].tolist()) != data:
                return NONE, NONE
        return a, b

    def cuts(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many tokens of either kind end up to each byte offset where both do."""
        ends_a, ends_b = (np.cumsum(s[ids]).tolist() for s, ids in zip(self.sizes, (a, b)))
        index_a = dict(zip(ends_a, range(1, len(ends_a) + 1)))
        index_b = dict(zip(ends_b, range(1, len(ends_b) + 1)))
        shared = list(filter(index_b.__contains__, index_a))  # both in ascending order
        found = [np.fromiter(map(x.__getitem__, shared), np.int64) for x in (index_a, index_b)]
        return np.stack(found)

    def align(self, text: str | None) -> tuple:
        """n_a, n_b, n_groups, n_links, groups_sha256, distinct linked pairs and their links."""
        a, b = self.tokens(text) if text else (NONE, NONE)
        if not len(a) or not len(b):
            return 0, 0, 0, 0, "", NONE, NONE
        ends = self.cuts(a, b)
        starts = np.c_[np.zeros(2, np.int64), ends[:, :-1]]
        (n_a, n_b), groups = ends - starts, ends.shape[1]
        digest = hashlib.sha256(self.groups_text(a, b, ends, n_a, n_b).encode()).hexdigest()
        # Each A token of a group meets the group's B tokens, which lie side by side.
        times, first = np.repeat(n_b, n_a), np.repeat(starts[1], n_a)
        before = np.cumsum(times) - times
        links = int(before[-1] + times[-1])
        met = b[np.arange(links) + np.repeat(first - before, times)]
        pairs, counts = np.unique(np.repeat(a, times) * B_IDS + met, return_counts=True)
        return len(a), len(b), groups, links, digest, pairs, counts

    def groups_text(self, a, b, ends, n_a, n_b) -> str:
        """``a1,a2|b1;a3|b2,b3``: the groups' ids in order."""
        last_a, last_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        last_a[ends[0] - 1] = last_b[ends[1] - 1] = 1
        out = np.empty(len(a) + len(b), dtype=object)
        before_b, through_a = np.repeat(ends[1] - n_b, n_a), np.repeat(ends[0], n_b)
        out[np.arange(len(a)) + before_b] = self.written[0][2 * a + last_a]
        out[np.arange(len(b)) + through_a] = self.written[1][2 * b + last_b]
        return "".join(out.tolist())[:-1]


def byte_tokenizer(vocabulary: str) -> ByteTokenizer:
    """From a file of the public tokenizers, beside which its ranks lie."""
    import public_tokenizers

    ranks = vocabulary.rsplit(".", 1)[0] + ".tiktoken"
    paths = (public_tokenizers.path(name) for name in (vocabulary, ranks))
    return ByteTokenizer(*paths, public_tokenizers.PATTERN)


def aligned_documents(docs: DataFrame, vocabulary_a: str, vocabulary_b: str) -> DataFrame:
    """A row per document with its block and its pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import public_tokenizers

        aligner = Aligner(
            byte_tokenizer(vocabulary_a),
            PieceTokenizer(public_tokenizers.path(vocabulary_b)),
        )
        task, number, held, rows = TaskContext.get().partitionId(), 0, 0, []

        def whole() -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True)) or [[]] * len(DOCUMENTS_ARROW)
            arrays = [pa.array(c, f.type) for c, f in zip(columns, DOCUMENTS_ARROW, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, schema=DOCUMENTS_ARROW)

        for batch in batches:
            for doc_id, text in zip(*batch.columns, strict=True):
                row = aligner.align(text.as_py())
                rows.append(((task << 32) + number, doc_id.as_py(), *row))
                held += len(row[-1])
                if held >= BLOCK_PAIRS:
                    yield whole()
                    number, held, rows = number + 1, 0, []
        yield whole()

    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return texts.mapInArrow(run, DOCUMENTS)


def pairs_of_blocks(stored: DataFrame) -> DataFrame:
    """``block, pair, docs``: in how many documents of the block a pair is linked.

    A block lies in one file, row by row, so nothing is shuffled; one that a task does not see whole
    is counted in parts.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blocks = batch.column("block").to_numpy()
            edges = np.r_[0, np.flatnonzero(blocks[1:] != blocks[:-1]) + 1, len(blocks)]
            for begin, end in zip(edges, edges[1:]):
                held = batch.column("pairs").slice(begin, end - begin).flatten().to_numpy()
                pairs, docs = np.unique(held, return_counts=True)
                block = np.full(len(pairs), blocks[begin] if len(blocks) else 0)
                yield pa.RecordBatch.from_pydict({"block": block, "pair": pairs, "docs": docs})

    return stored.select("block", "pairs").mapInArrow(count, "block long, pair long, docs long")


def judge(left: pa.Table, right: pa.Table) -> pa.Table:
    """The documents of a block with what the corpus says about their pairs."""
    order = np.argsort(right.column("pair").to_numpy())
    pair, total, best = (right.column(c).to_numpy()[order] for c in ("pair", "total", "best"))
    lists = left.column("pairs").combine_chunks()
    at = np.searchsorted(pair, lists.flatten().to_numpy())
    times = left.column("times").combine_chunks().flatten().to_numpy()
    sizes = lists.value_lengths().to_numpy()
    row = np.repeat(np.arange(len(sizes)), sizes)
    n_best, count_sum = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    if len(at):
        np.add.at(count_sum, row, times * total[at])
        np.add.at(n_best, row, times * (total[at] == best[at]))
    kept = left.drop_columns(["block", "pairs", "times"])
    return kept.append_column("n_best", pa.array(n_best)).append_column(
        "count_sum", pa.array(count_sum)
    )


def token_alignment(
    docs: DataFrame, vocabulary_a: str = VOCABULARY_A, vocabulary_b: str = VOCABULARY_B
) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, groups_sha256, n_best, count_sum of every row.

    A's tokens are those of a space and the text, B's those of the text, to which it adds the space
    itself. A link is a pair of an A and a B token of one group. A pair's count is the number of
    documents that hold it linked; n_best are the links whose count is the highest of their A id,
    count_sum the sum of the counts over the links.

    NULL and empty texts, and texts that either kind cannot spell, have no tokens: zeros and ''.
    Repeated rows each give a row and count as documents of their own, as do rows without an id.
    Other columns are not looked at. An empty table gives an empty result. A very long text is a
    block of its own; its distinct pairs must fit a task.
    """
    stored = materialize(aligned_documents(docs, vocabulary_a, vocabulary_b), "aligned")
    held = materialize(pairs_of_blocks(stored), "pairs_of_blocks")
    totals = held.groupBy("pair").agg(F.sum("docs").alias("total"))
    of_a = F.floor(F.col("pair") / F.lit(B_IDS)).alias("a")
    totals = materialize(totals.select("pair", of_a, "total"), "totals")
    best = materialize(totals.groupBy("a").agg(F.max("total").alias("best")), "best")
    judged = materialize(totals.join(best, "a").select("pair", "total", "best"), "judged")
    back = held.select("block", "pair").join(judged, "pair")  # two rows of a pair say the same
    out = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long"
    return stored.groupBy("block").cogroup(back.groupBy("block")).applyInArrow(judge, out)
