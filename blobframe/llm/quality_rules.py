"""Quality rules per document, and a verdict on each host from the failures of its documents.

The failures of every rule are counted per host (a pre-aggregated shuffle). The failure rates of a
rule are shrunk towards an empirical beta prior of that rule; a host is rejected if one of them is
far above the corpus's, and the few that are rejected are joined back to their documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blobframe.session import materialize
from blobframe.sinks.tables import quoted

from .common import BREAK_CHARACTERS, join_measured, words_of

WINDOW = 5
MIN_WORDS = 10
MAX_REPEATED_PERCENT = 20
MAX_SYMBOLS_PER_WORD = 0.1
MAX_DUPLICATE_LINES = 0.3
#: A host may fail a rule as often as the corpus does, and in this share of the other documents.
HOST_MARGIN = 0.4
#: Weight of the prior, in documents, when hosts do not differ at all.
STRONGEST_PRIOR = 1e6

SYMBOLS = "#*$%&|<>"
STATISTICS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def repeated_words(df: DataFrame, words: str, out: str) -> DataFrame:
    """Add the number of words that lie in a window of five words found twice or more in ``words``.

    Windows are compared by a 64-bit hash. Only texts with some repeated window are sorted.
    """
    size = F.size(words)
    window = F.when(
        size >= WINDOW,
        F.transform(
            F.slice(words, 1, F.greatest(size - (WINDOW - 1), F.lit(0))),
            lambda word, i: F.xxhash64(word, *[F.get(words, i + k) for k in range(1, WINDOW)]),
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    df = df.withColumn("_windows", window)
    repeats = F.size(F.array_distinct("_windows")) < F.size("_windows")
    order = F.array_sort(
        F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    )
    df = df.withColumn("_sorted", F.when(repeats, order)).drop("_windows")
    found = F.filter(
        "_sorted",
        lambda x, j: F.coalesce(F.get("_sorted", j - 1)["h"] == x["h"], F.lit(False))
        | F.coalesce(F.get("_sorted", j + 1)["h"] == x["h"], F.lit(False)),
    )
    df = df.withColumn("_starts", F.array_sort(F.transform(found, lambda x: x["i"])))
    covered = F.transform(
        "_starts",
        lambda x, j: F.least(F.lit(WINDOW), F.coalesce(F.get("_starts", j + 1) - x, F.lit(WINDOW))),
    )
    total = F.aggregate(covered, F.lit(0).cast("long"), lambda a, x: a + x)
    return df.withColumn(out, F.coalesce(total, F.lit(0).cast("long"))).drop("_sorted", "_starts")


def text_statistics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Replace the text by n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words.

    A NULL text has no words. Texts are handled whole, in one pass, without a shuffle.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    keep = [F.col(c) for c in docs.columns if c != text_col and c not in STATISTICS]
    has_word = lambda line: F.length(F.translate(line, BREAK_CHARACTERS, "")) > 0
    df = docs.select(
        *keep,
        words_of(text).alias("_words"),
        F.length(F.translate(text, BREAK_CHARACTERS, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.filter(F.split(text, "\n", -1), has_word).alias("_lines"),
    )
    df = df.withColumns(
        {
            "n_words": F.size("_words").cast("long"),
            "n_lines": F.size("_lines").cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        }
    ).drop("_lines")
    return repeated_words(df, "_words", "n_repeat_words").drop("_words")


def base_failure() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words")
    )


def failures() -> dict[str, Column]:
    """The rules: too few words, too many repeated words, symbols or repeated lines."""
    return {
        "few_words": F.col("n_words") < MIN_WORDS,
        "repeats": 100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"),
        "symbols": F.col("n_symbols") > MAX_SYMBOLS_PER_WORD * F.col("n_words"),
        "dup_lines": F.col("n_dup_lines") > MAX_DUPLICATE_LINES * F.col("n_lines"),
    }


def beta_priors(hosts: DataFrame, rules: list[str]) -> dict[str, tuple[float, float]]:
    """For every rule, moments of the hosts' failure rates as the two counts of a beta distribution.

    The variance that comes from small hosts alone is taken off. One row reaches the driver.
    """
    sums = [F.sum("docs").alias("n")]
    for rule in rules:
        rate = F.col(rule) / F.col("docs")
        noise = rate * (1 - rate) / F.col("docs")
        sums.append(F.sum(rule).alias(f"f_{rule}"))
        sums.append((F.var_pop(rate) - F.avg(noise)).alias(f"v_{rule}"))
    row = hosts.agg(*sums).first()
    priors = {}
    for rule in rules:
        if not row["n"]:
            priors[rule] = 0.5, 0.5
            continue
        mean, variance = row[f"f_{rule}"] / row["n"], row[f"v_{rule}"] or 0.0
        weight = STRONGEST_PRIOR
        if variance > 0:
            weight = max(1.0, min(STRONGEST_PRIOR, mean * (1 - mean) / variance - 1))
        priors[rule] = mean * weight, (1 - mean) * weight
    return priors


def host_verdicts(rated: DataFrame, keys: list[str], margin: float = HOST_MARGIN) -> DataFrame:
    """One row per host: docs, the failures of each rule, its shrunk rate_<rule>, and host_kept."""
    rules = list(failures())
    counts = [F.sum(F.col(rule).cast("long")).alias(rule) for rule in rules]
    hosts = materialize(rated.groupBy(*keys).agg(F.count("*").alias("docs"), *counts), "hosts")
    far = F.lit(False)
    rates = {}
    for rule, (a, b) in beta_priors(hosts, rules).items():
        rates[f"rate_{rule}"] = (F.col(rule) + F.lit(a)) / (F.col("docs") + F.lit(a + b))
        mean = a / (a + b)
        far = far | (F.col(f"rate_{rule}") > F.lit(mean + margin * (1 - mean)))
    return hosts.withColumns(rates).withColumn("host_kept", ~far)


def quality_rules(
    docs: DataFrame,
    host_col: str = "source",
    text_col: str = "text",
    host_margin: float = HOST_MARGIN,
) -> DataFrame:
    """Rate every document and its host; returns the other columns, the statistics, ``base_failed``,
    the rules (whether the document fails each), ``host_kept`` and ``kept``, without the text.

    NULL texts have no words and fail. Documents without a host form one host. Repeated rows count
    as often as they occur. Columns named like a result are replaced. An empty table gives an empty
    result. Texts are read once: the statistics are stored before hosts are counted.
    """
    rules = failures()
    results = [*STATISTICS, "n_lines", "base_failed", *rules, "host_kept", "kept"]
    kept = [c for c in docs.columns if c != text_col and (c not in results or c == host_col)]
    # In a struct no name of theirs can clash with one of ours.
    rows = docs.select(
        F.struct(*(F.col(quoted(c)) for c in kept)).alias("row"),
        F.coalesce(F.col(host_col).cast("string"), F.lit("")).alias("host"),
        F.col(host_col).isNull().alias("no_host"),
        F.col(text_col).alias("text"),
    )
    rated = text_statistics(rows, "text").withColumn("base_failed", base_failure())
    rated = materialize(rated.withColumns(rules), "rated")
    keys = ["host", "no_host"]
    bad = host_verdicts(rated, keys, host_margin).where("not host_kept")
    judged = join_measured(rated, bad.select(*keys, "host_kept"), keys, "rejected_hosts")
    judged = judged.withColumn("host_kept", F.coalesce("host_kept", F.lit(True)))
    judged = judged.withColumn("kept", ~F.col("base_failed") & F.col("host_kept"))
    return judged.select("row.*", *(c for c in results if c not in kept))
