"""Ranked lexical search by pipelined term partitioning.

Terms have owners by how common they are. Items travel in bundles: a bundle is one row per slice of
the documents, with its items' terms and a sparse accumulator per item and document. The bundles
pass the owners one after the other, rarest terms first; at each, a cogroup brings them the
postings of that owner's terms, whose integer contributions are added. What is left at the last
owner is selected.

On the way an accumulator goes if even the largest contributions of all terms still to come cannot
lift it to the tenth best of its slice, which the tenth best of all documents never falls below. So
the result is exact, and the many documents that share common words alone are never carried.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from blobframe.session import materialize

from .common import BROADCAST_ROWS, as_bytes

TOP = 10
#: Items of one bundle, and about how many documents a slice has.
BUNDLE = 256
SLICE = 8192
#: The owners: a term belongs to the first whose share of the documents it does not exceed.
OWNERS = (0.001, 0.01, 0.1, 1.0)
#: Letters and digits of ASCII and everything beyond ASCII, as UTF-8 bytes.
TERM = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
#: Every document with a term has a posting of this one, which no text holds.
ANY = b""
POSTING_BATCH = 200_000
LAST_ID = (1 << 63) - 1

STATE = (
    "bundle long, slice long, q_item array<long>, q_tid array<long>, q_tf array<long>, "
    "q_owner array<int>, q_most array<long>, a_item array<long>, a_row array<long>, "
    "a_doc array<long>, a_score array<long>"
)
STATE_ARROW = pa.schema(
    [("bundle", pa.int64()), ("slice", pa.int64())]
    + [(c, pa.list_(pa.int64())) for c in ("q_item", "q_tid", "q_tf")]
    + [("q_owner", pa.list_(pa.int32())), ("q_most", pa.list_(pa.int64()))]
    + [(c, pa.list_(pa.int64())) for c in ("a_item", "a_row", "a_doc", "a_score")]
)


def terms_of(text: str | None) -> list[bytes]:
    return TERM.findall(as_bytes(text).lower())  # of bytes: A-Z alone


def term_rows(texts: DataFrame, id_col: str, any_term: bool) -> DataFrame:
    """``row, id, n, term, tf`` per text and distinct term; ``row`` tells repeated rows apart.

    With ``any_term`` a text with terms also has a row of the term ANY.
    """
    schema = pa.schema(
        [("row", pa.int64()), ("id", pa.int64()), ("n", pa.int64())]
        + [("term", pa.string()), ("tf", pa.int64())]
    )

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        sizes = [len(counted) for *_, counted in rows]
        repeated = [np.repeat(np.arange(len(rows)), sizes)]
        columns = [pa.array([r[k] for r in rows], pa.int64()).take(repeated[0]) for k in range(3)]
        terms = pa.array([t for *_, counted in rows for t in counted], pa.binary())
        tfs = pa.array([c for *_, counted in rows for c in counted.values()], pa.int64())
        return pa.RecordBatch.from_arrays([*columns, terms.cast(pa.string()), tfs], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, held = [], 0
            for row, id_, text in zip(*batch.columns, strict=True):
                counted = Counter(terms_of(text.as_py()))
                n = counted.total()
                if n and any_term:
                    counted[ANY] = 1
                rows.append((row.as_py(), id_.as_py(), n, counted))
                held += len(counted)
                if held > POSTING_BATCH:
                    yield batch_of(rows)
                    rows, held = [], 0
            yield batch_of(rows)

    rows = texts.select(
        F.monotonically_increasing_id(), F.col(id_col).cast("long"), F.col("text").cast("string")
    )
    return rows.mapInArrow(run, "row long, id long, n long, term string, tf long")


def narrow(stored: DataFrame) -> DataFrame:
    """Broadcast a stored table of terms if it has few rows; its terms may be long, so by bytes too."""
    size = F.sum(F.octet_length("term")) if "term" in stored.columns else F.lit(0)
    rows, held = stored.agg(F.count("*"), size).first()
    return F.broadcast(stored) if rows <= BROADCAST_ROWS and (held or 0) < 32 << 20 else stored


def top_rows(
    item: np.ndarray, q: dict, acc: dict, postings: dict, owner: int, top: int, last: bool
) -> dict:
    """The accumulators of one bundle and slice after this owner's postings were added."""
    rows, index = np.unique(np.concatenate([acc["row"], postings["row"]]), return_inverse=True)
    docs = np.empty(len(rows), np.int64)
    docs[index] = np.concatenate([acc["doc"], postings["doc"]])
    held, posted = index[: len(acc["row"])], index[len(acc["row"]) :]
    order = np.argsort(postings["tid"], kind="stable")
    tid, posted, adds = postings["tid"][order], posted[order], postings["adds"][order]
    out = {"item": [], "row": [], "doc": [], "score": []}
    for one in item:
        score = np.zeros(len(rows), np.int64)
        mine = acc["item"] == one
        score[held[mine]] = acc["score"][mine]
        asked = q["item"] == one
        for term, tf in zip(*(q[c][asked & (q["owner"] == owner)] for c in ("tid", "tf"))):
            low, high = np.searchsorted(tid, (term, term + 1))
            score[posted[low:high]] += tf * adds[low:high]  # a document has a term once
        found = np.flatnonzero(score)
        if len(found) > top:
            later = asked & (q["owner"] > owner)
            rest = int((q["tf"][later] * q["most"][later]).sum())
            least = np.partition(score[found], -top)[-top]
            found = found[score[found] + rest >= least]
            if last:
                found = found[np.lexsort((rows[found], docs[found], -score[found]))[:top]]
        for name, values in (("row", rows[found]), ("doc", docs[found]), ("score", score[found])):
            out[name].append(values)
        out["item"].append(np.full(len(found), one))
    return {k: np.concatenate(v) if v else np.empty(0, np.int64) for k, v in out.items()}


def pass_owner(bundles: DataFrame, postings: DataFrame, owner: int, top: int) -> DataFrame:
    """The bundles once they have met the postings of this owner's terms."""

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        at = {c: left.column(c)[0] for c in left.column_names}
        values = {c: at[c].values.to_numpy() for c in at if c not in ("bundle", "slice")}
        q = {c[2:]: values[c] for c in values if c.startswith("q_")}
        acc = {c[2:]: values[c] for c in values if c.startswith("a_")}
        add = {c: right.column(c).to_numpy() for c in ("row", "doc", "tid", "adds")}
        last = owner == len(OWNERS) - 1
        kept = top_rows(np.unique(q["item"]), q, acc, add, owner, top, last)
        columns = [at["bundle"].as_py(), at["slice"].as_py()]
        columns += [values[c] for c in STATE_ARROW.names if c.startswith("q_")]
        columns += [kept[c] for c in ("item", "row", "doc", "score")]
        arrays = [pa.array([c], f.type) for c, f in zip(columns, STATE_ARROW, strict=True)]
        return pa.Table.from_arrays(arrays, schema=STATE_ARROW)

    keys = ["bundle", "slice"]
    mine = postings.where(F.col("owner") == owner).drop("owner")
    return bundles.groupBy(keys).cogroup(mine.groupBy(keys)).applyInArrow(meet, STATE)


def ranked_search(
    docs: DataFrame,
    items: DataFrame,
    top: int = TOP,
    bundle_items: int = BUNDLE,
    slice_docs: int = SLICE,
) -> DataFrame:
    """The ``top`` documents for every item: item_id, rank, doc_id, score (above 0, whole numbers).

    docs: doc_id, text; items: item_id, text. Equal scores are ranked by ascending doc_id, documents
    without an id after the others (2^63 - 1 is no id). Rows that repeat are documents, or items, of
    their own. NULL and empty texts have no terms: such documents are never found, and such items
    find nothing, like all items if no document has a term. Other columns are not looked at. Texts
    are taken whole, whatever their length.
    """
    asked = materialize(term_rows(items, "item_id", False), "items")
    found = term_rows(docs, "doc_id", True)
    words = materialize(
        asked.select("term").distinct().union(asked.sparkSession.range(1).select(F.lit("").alias("term"))),
        "vocabulary",
    )
    found = materialize(found.join(narrow(words), "term"), "postings")
    n_docs, n_terms = found.where("term = ''").agg(F.count("*"), F.sum("n")).first()
    n_docs, n_terms = n_docs, max(n_terms or 0, 1)

    length = 25 + F.expr(f"(75 * n * {n_docs}L) div {n_terms}L")
    impact = F.expr("(1000000000 * tf) div (1000 * tf + 8 * m)")
    found = found.where("term != ''").withColumn("m", length)
    found = found.select("row", F.coalesce("id", F.lit(LAST_ID)).alias("doc"), "term", impact.alias("impact"))
    known = found.groupBy("term").agg(F.count("*").alias("df"), F.max("impact").alias("most"))
    weight = F.floor(1000 * F.log((2.0 * n_docs + 2) / (2.0 * F.col("df") + 1)))
    owner = F.lit(len(OWNERS) - 1)
    for number, share in reversed(list(enumerate(OWNERS[:-1]))):
        owner = F.when(F.col("df") <= share * n_docs, number).otherwise(owner)
    known = known.select(
        "term", owner.alias("owner"), weight.alias("w"), (F.col("most") * weight).alias("most"),
        F.monotonically_increasing_id().alias("tid"),
    )
    known = materialize(known, "terms")

    n_items = asked.select("row").distinct().count()
    n_bundles, n_slices = -(-n_items // bundle_items), max(1, -(-n_docs // slice_docs))
    bundle = F.pmod(F.xxhash64("row"), F.lit(max(n_bundles, 1)))
    query = materialize(
        asked.join(narrow(known), "term").select(
            bundle.alias("bundle"), F.col("row").alias("item"), "tid", "tf", "owner", "w", "most"
        ),
        "queries",
    )
    parts = ("item", "tid", "tf", "owner", "most")
    packed = F.collect_list(F.struct(*parts)).alias("q")
    none = F.array().cast("array<long>")
    bundles = query.groupBy("bundle").agg(packed).select(
        "bundle", *(F.col(f"q.{c}").alias(f"q_{c}") for c in parts),
        *(none.alias(f"a_{c}") for c in ("item", "row", "doc", "score")),
    )
    slices = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_slices - 1).cast("long")))
    bundles = bundles.withColumn("slice", slices).select(*STATE_ARROW.names)

    wanted = materialize(query.select("tid", "bundle").distinct(), "wanted")
    postings = found.join(narrow(known.select("term", "tid", "owner", "w")), "term").select(
        "row", "doc", "tid", "owner", (F.col("w") * F.col("impact")).alias("adds"),
        F.pmod(F.xxhash64("row"), F.lit(n_slices)).alias("slice"),
    )
    postings = postings.join(narrow(wanted), "tid")
    for number in range(len(OWNERS)):
        bundles = pass_owner(bundles, postings, number, top)

    best = bundles.select(F.explode(F.arrays_zip("a_item", "a_row", "a_doc", "a_score")).alias("a"))
    best = best.select("a.a_item", "a.a_row", "a.a_doc", F.col("a.a_score").alias("score"))
    order = Window.partitionBy("a_item").orderBy(F.desc("score"), "a_doc", "a_row")
    best = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    named = materialize(asked.select(F.col("row").alias("a_item"), F.col("id").alias("item_id")).distinct(), "named")
    doc_id = F.when(F.col("a_doc") != LAST_ID, F.col("a_doc"))
    return best.join(narrow(named), "a_item").select("item_id", "rank", doc_id.alias("doc_id"), "score")
