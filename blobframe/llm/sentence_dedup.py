"""Remove sentences that lie in a run of consecutive sentences seen before, anywhere in the corpus.

Every run of SPAN sentences, or of so many more that it has MIN_WORDS words, is hashed; runs are
counted globally with their first place, and every other place of a repeated run loses its sentences. First means least document id, then position.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blobframe.session import materialize, release_scratch

from .common import BREAK, BREAK_CHARACTERS, settled

SPAN = 3
#: Words that a run has at least: stock phrases and one-word sentences recur by themselves.
MIN_WORDS = 15
#: A sentence with what separates it from the next: all of a text's sentences are the text.
SENTENCE = r"(?s).+?(?:[.!?]++(?=\s)\s*+|\n\s*+|$)"


def sentences(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(SENTENCE), F.lit(0))


def plain(sentence: Column) -> Column:
    """A sentence without outer white space, inner white space as one blank."""
    return F.trim(F.regexp_replace(sentence, BREAK, " "))


def sentence_dedup(docs: DataFrame, span: int = SPAN, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, n_sentences, n_removed, removed (positions) and text (what is kept) of every row.

    Sentences without a word character are carried along and never start a comparison. NULL and
    empty texts keep nothing and lose nothing. A text with fewer than ``span`` sentences is one
    run. A run of fewer than ``min_words`` words goes on until it has them; where the
    text ends before, it is not compared. Rows equal in id and text are one document. Rows without an id come after all others.
    Other columns are not looked at. An empty table gives an empty result.

    Runs travel as hashes, documents as their id and a hash of the text. Runs are counted first;
    only repeated ones, which are few, have their places compared and come back as spans of
    sentences. A frequent run is aggregated before it is shuffled.
    """
    text = F.coalesce("text", F.lit(""))
    hashed = F.xxhash64(F.lit(1), text).alias("t1")
    docs = docs.select(F.col("doc_id").cast("long"), hashed, text.alias("text"))
    parts = docs.select("doc_id", "t1", sentences(F.col("text")).alias("s"))
    numbered = F.filter(
        F.transform("s", lambda x, i: F.struct(plain(x).alias("x"), i.alias("i"))),
        lambda x: F.length(F.translate(x["x"], BREAK_CHARACTERS, "")) > 0,
    )
    counted = F.transform(
        numbered,
        lambda x: F.struct(x["x"].alias("x"), x["i"].alias("i"), F.size(F.split(x["x"], " ")).alias("n")),
    )
    parts = parts.select("doc_id", "t1", counted.alias("p"))
    size = F.size("p")
    starts = F.slice("p", 1, F.when(size == 0, 0).otherwise(F.greatest(size - (span - 1), F.lit(1))))

    at = lambda j, k: F.get("p", j + k)

    def longer(j: Column) -> Column:
        """Sentences of a run that needs more than ``span``; NULL if the text has too few words."""
        wide = F.sequence(F.lit(span + 1), F.lit(max(span, min_words) + 1))
        words = lambda m: F.aggregate(
            F.slice("p", j + 1, m), F.lit(0), lambda n, x: n + x["n"]
        )
        return F.get(F.filter(wide, lambda m: words(m) >= min_words), F.lit(0))

    def run_at(x: Column, j: Column) -> Column:
        words = sum((F.coalesce(at(j, k)["n"], F.lit(0)) for k in range(1, span)), x["n"])
        m = F.when(words >= min_words, span).otherwise(longer(j))
        return F.struct(x["x"].alias("x"), x["i"].alias("first"), j.alias("j"), m.alias("m"))

    def hashed(r: Column) -> Column:
        j, m = r["j"], r["m"]
        more = F.xxhash64(F.transform(F.slice("p", j + 1, m), lambda x: x["x"]))
        plain_run = F.xxhash64(r["x"], *[at(j, k)["x"] for k in range(1, span)])
        return F.struct(
            F.when(m == span, plain_run).otherwise(more).alias("run"),
            r["first"].alias("first"),
            F.get("p", F.least(j + m, size) - 1)["i"].alias("last"),
        )

    runs = F.filter(F.transform(starts, run_at), lambda r: r["m"].isNotNull())
    runs = F.transform(runs, hashed)
    rows = parts.select("doc_id", "t1", F.explode(runs).alias("r")).select(
        "doc_id", "t1", "r.run", "r.first", "r.last"
    )
    with release_scratch(docs.sparkSession):  # the runs, once the repeated ones are known
        rows = materialize(rows, "runs")
        # Rows that are one document are counted twice here, and drop out where places are compared.
        counted = rows.groupBy("run").agg(F.count("*").alias("n"))
        repeated = settled(counted.where("n > 1").select("run"), "repeated_runs")
        met = settled(rows.join(repeated, "run"), "met", keep=True)
    place = F.struct(F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("d"), "t1", "first")
    firsts = materialize(met.groupBy("run").agg(F.min(place).alias("_place")), "first_places")
    met = met.join(firsts, "run").where(place != F.col("_place"))
    gone = met.groupBy("doc_id", "t1").agg(F.collect_set(F.struct("first", "last")).alias("met"))
    covered = F.flatten(F.transform("met", lambda r: F.sequence(r["first"], r["last"])))
    gone = settled(
        gone.select("doc_id", "t1", F.array_sort(F.array_distinct(covered)).alias("removed")),
        "removed_sentences",
    )
    missing = F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("_d")
    left = docs.select("doc_id", "text", missing, "t1")
    right = gone.select(missing, "t1", "removed")
    out = left.join(right, ["_d", "t1"], "left")
    out = out.select(
        "doc_id",
        F.coalesce("removed", F.array().cast("array<int>")).alias("removed"),
        "text",
    ).withColumn("_s", sentences(F.col("text")))
    kept = F.array_join(F.filter("_s", lambda x, i: ~F.array_contains("removed", i)), "")
    return out.select(
        "doc_id",
        F.size("_s").cast("long").alias("n_sentences"),
        F.size("removed").cast("long").alias("n_removed"),
        "removed",
        F.when(F.size("removed") > 0, kept).otherwise(F.col("text")).alias("text"),
    )
