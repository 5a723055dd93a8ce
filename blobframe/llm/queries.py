"""One query per corpus operator, over its whole tables, and SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import functions as F

from .common import table, words_of
from .embedding_forest import near_duplicates
from .fingerprints import document_fingerprints
from .jaccard_join import jaccard_groups
from .mixing import choose_copies
from .packing import pack_documents
from .pii import find_private
from .quality_cnn import quality_scores
from .quality_rules import STATISTICS, quality_rules
from .ranked_search import ranked_search
from .sentence_dedup import sentence_dedup
from .suffix_dedup import suffix_dedup
from .token_alignment import token_alignment
from .toxicity import toxicity_scores


def op1_fingerprints(spark, sf_dir):
    return document_fingerprints(table(spark, sf_dir, "documents"))


def op2_quality_rules(spark, sf_dir):
    rated = quality_rules(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return rated.select("doc_id", *STATISTICS, "base_failed", "kept")


def sized(docs):
    """Documents with the number of their words in place of the text."""
    words = F.size(words_of(F.coalesce("text", F.lit("")))).cast("long")
    return docs.select("doc_id", "source", words.alias("size"))


def op3_mixing(spark, sf_dir):
    from blobframe.session import materialize

    docs = materialize(sized(table(spark, sf_dir, "documents")), "sized")
    mixed = choose_copies(docs)
    taken = F.col("size") * F.size("copies")
    return mixed.select("doc_id", "size", "source_size", "target", taken.alias("taken"))


def op4_suffix_dedup(spark, sf_dir):
    return suffix_dedup(table(spark, sf_dir, "documents"))


def op5_private_data(spark, sf_dir):
    found = find_private(table(spark, sf_dir, "documents").select("doc_id", "text"))
    counts = ["n_email", "n_ip", "n_card", "n_phone"]
    return found.select("doc_id", *counts, "base_sha256", "spans", "n_terms")


def op6_quality_cnn(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality_scores(docs, table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted")


def op7_sentence_dedup(spark, sf_dir):
    found = sentence_dedup(table(spark, sf_dir, "documents"))
    return found.withColumn("removed", F.array_join(F.col("removed").cast("array<string>"), ","))


def op8_packing(spark, sf_dir):
    return pack_documents(table(spark, sf_dir, "documents"))


def op9_jaccard_join(spark, sf_dir):
    return jaccard_groups(table(spark, sf_dir, "documents"))


def op10_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity_scores(docs, table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted")


def op11_token_alignment(spark, sf_dir):
    return token_alignment(table(spark, sf_dir, "documents"))


def op12_embedding_dedup(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "embeddings"))


def op13_ranked_search(spark, sf_dir):
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_fingerprints": op1_fingerprints,
    "op2_quality_rules": op2_quality_rules,
    "op3_mixing": op3_mixing,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_private_data": op5_private_data,
    "op6_quality_cnn": op6_quality_cnn,
    "op7_sentence_dedup": op7_sentence_dedup,
    "op8_packing": op8_packing,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_toxicity": op10_toxicity,
    "op11_token_alignment": op11_token_alignment,
    "op12_embedding_dedup": op12_embedding_dedup,
    "op13_ranked_search": op13_ranked_search,
}

RANKED_SEARCH_SQL = r"""
WITH found AS (
  SELECT doc_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents),
asked AS (
  SELECT item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark),
queries AS (SELECT item_id, term, count(*)::BIGINT AS q FROM asked GROUP BY ALL),
lengths AS (SELECT doc_id, count(*)::BIGINT AS n FROM found GROUP BY ALL),
total AS (SELECT count(*)::BIGINT AS big_n, sum(n)::BIGINT AS big_l FROM lengths),
postings AS (
  SELECT doc_id, term, count(*)::BIGINT AS tf FROM found
  WHERE term IN (SELECT term FROM queries) GROUP BY ALL),
weights AS (
  SELECT term, floor(1000 * ln((2 * big_n + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM postings, total GROUP BY term, big_n),
scores AS (
  SELECT item_id, doc_id, sum(q * w * ((1000000000 * tf)
      // (1000 * tf + 8 * (100 - 75 + ((75 * n * big_n) // big_l)))))::BIGINT AS score
  FROM queries JOIN weights USING (term) JOIN postings USING (term) JOIN lengths USING (doc_id), total
  GROUP BY ALL)
SELECT item_id,
  (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INTEGER AS rank,
  doc_id, score
FROM scores WHERE score > 0
QUALIFY rank <= 10
"""

def rates_sql(rule: str) -> str:
    """Whether a host's failures of the rule, shrunk to the beta prior, are far above the corpus's."""
    return f"""
      SELECT source, ({rule} + mean * weight) / (docs + weight) > mean + 0.4 * (1 - mean) AS far
      FROM hosts, (
        SELECT mean, CASE WHEN spread <= 0 THEN 1e6
          ELSE least(1e6, greatest(1.0, mean * (1 - mean) / spread - 1)) END AS weight
        FROM (
          SELECT sum({rule}) / sum(docs) AS mean,
            var_pop({rule} / docs) - avg({rule} / docs * (1 - {rule} / docs) / docs) AS spread
          FROM hosts))"""


QUALITY_RULES_SQL = rf"""
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t FROM documents),
split AS (
  SELECT r, doc_id, source, t,
    list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM texts),
windows AS (
  SELECT r, i, words[i:i + 4] AS five
  FROM (SELECT r, words, unnest(range(1, len(words) - 3)) AS i FROM split WHERE len(words) >= 5)),
repeated AS (
  SELECT r, i FROM windows QUALIFY count(*) OVER (PARTITION BY r, five) > 1),
covered AS (
  SELECT r, count(DISTINCT place) AS n
  FROM (SELECT r, unnest(range(i, i + 5)) AS place FROM repeated) GROUP BY r),
counted AS (
  SELECT s.r, doc_id, source, len(words)::BIGINT AS n_words,
    length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    len(lines)::BIGINT AS n_lines,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    coalesce(c.n, 0)::BIGINT AS n_repeat_words
  FROM split s LEFT JOIN covered c ON s.r = c.r),
rated AS (
  SELECT *, n_words < 10 AS few_words, 100 * n_repeat_words > 20 * n_words AS repeats,
    n_symbols > 0.1 * n_words AS symbols, n_dup_lines > 0.3 * n_lines AS dup_lines
  FROM counted),
hosts AS (
  SELECT source, count(*)::DOUBLE AS docs, sum(few_words::INT)::DOUBLE AS few_words,
    sum(repeats::INT)::DOUBLE AS repeats, sum(symbols::INT)::DOUBLE AS symbols,
    sum(dup_lines::INT)::DOUBLE AS dup_lines
  FROM rated GROUP BY source),
verdicts AS (
  SELECT source, bool_or(far) AS rejected FROM (
    {" UNION ALL ".join(map(rates_sql, ("few_words", "repeats", "symbols", "dup_lines")))})
  GROUP BY source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  few_words OR repeats AS base_failed, NOT (few_words OR repeats) AND NOT rejected AS kept
FROM rated JOIN verdicts v ON rated.source IS NOT DISTINCT FROM v.source
"""

JACCARD_JOIN_SQL = r"""
WITH RECURSIVE texts AS (
  SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
  FROM documents),
shingles AS (
  SELECT DISTINCT r, words[i:i + 2] AS shingle
  FROM (SELECT r, words, unnest(range(1, greatest(len(words) - 1, 2))) AS i
        FROM texts WHERE len(words) > 0)),
sizes AS (SELECT r, count(*) AS n FROM shingles GROUP BY r),
shared AS (
  SELECT a.r AS u, b.r AS v, count(*) AS inter
  FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.r <> b.r GROUP BY ALL),
links AS (
  SELECT u, v FROM shared JOIN sizes x ON x.r = u JOIN sizes y ON y.r = v
  WHERE 100 * inter >= 90 * (x.n + y.n - inter)),
reached AS (
  SELECT r AS u, r AS v FROM texts
  UNION SELECT reached.u, links.v FROM reached JOIN links ON links.u = reached.v)
SELECT t.doc_id, coalesce(any_value(n), 0)::BIGINT AS n_shingles, min(o.doc_id) AS component_id
FROM reached JOIN texts t ON t.r = reached.u JOIN texts o ON o.r = reached.v
LEFT JOIN sizes ON sizes.r = t.r
GROUP BY t.r, t.doc_id
"""

EMBEDDING_DEDUP_SQL = """
WITH RECURSIVE vectors AS (
  SELECT row_number() OVER () AS r, vec_id, embedding::DOUBLE[] AS e,
    embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0 AS usable
  FROM embeddings),
links AS (
  SELECT a.r AS u, b.r AS v FROM vectors a
  JOIN vectors b ON a.r <> b.r AND a.usable AND b.usable AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
reached AS (
  SELECT r AS u, r AS v FROM vectors
  UNION SELECT reached.u, links.v FROM reached JOIN links ON links.u = reached.v),
counts AS (SELECT u, count(*) AS n FROM links GROUP BY u)
SELECT t.vec_id, coalesce(any_value(n), 0)::BIGINT AS n_links, min(o.vec_id) AS component_id,
  t.vec_id = min(o.vec_id) AS kept
FROM reached JOIN vectors t ON t.r = reached.u JOIN vectors o ON o.r = reached.v
LEFT JOIN counts ON counts.u = t.r
GROUP BY t.r, t.vec_id
"""

SENTENCE_DEDUP_SQL = r"""
WITH cut AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''),
    '(?s).+?(?:[.!?]+[\x20\x09-\x0D]+|\n[\x20\x09-\x0D]*|$)') AS s
  FROM documents),
sentences AS (
  SELECT doc_id, unnest(range(len(s))) AS i, unnest(s) AS sentence FROM cut),
worded AS (
  SELECT doc_id, i, trim(regexp_replace(sentence, '[\x20\x09-\x0D]+', ' ', 'g')) AS x
  FROM sentences),
counted AS (
  SELECT doc_id, i, x, len(string_split(x, ' ')) AS n,
    row_number() OVER (PARTITION BY doc_id ORDER BY i) AS j,
    count(*) OVER (PARTITION BY doc_id) AS size
  FROM worded WHERE x <> ''),
steps AS (
  SELECT a.doc_id, a.i AS first_i, b.i AS last_i, b.x, b.j - a.j + 1 AS k, b.j = b.size AS at_end,
    sum(b.n) OVER (PARTITION BY a.doc_id, a.j ORDER BY b.j) AS words
  FROM counted a JOIN counted b
    ON a.doc_id = b.doc_id AND b.j BETWEEN a.j AND a.j + 15 AND a.j <= greatest(a.size - 2, 1)),
lengths AS (
  SELECT doc_id, first_i, min(k) AS m FROM steps
  WHERE words >= 15 AND (k >= 3 OR at_end) GROUP BY ALL),
runs AS (
  SELECT doc_id, first_i, max(last_i) AS last_i, list(x ORDER BY k) AS run
  FROM steps JOIN lengths USING (doc_id, first_i) WHERE k <= m GROUP BY ALL),
later AS (
  SELECT doc_id, first_i, last_i FROM runs
  QUALIFY row_number() OVER (PARTITION BY run ORDER BY doc_id, first_i) > 1),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(first_i, last_i + 1)) AS i FROM later),
marked AS (
  SELECT s.doc_id, s.i, s.sentence, g.i IS NOT NULL AS lost
  FROM sentences s LEFT JOIN gone g ON s.doc_id = g.doc_id AND s.i = g.i)
SELECT c.doc_id, len(c.s)::BIGINT AS n_sentences, count(*) FILTER (lost)::BIGINT AS n_removed,
  coalesce(string_agg(m.i::VARCHAR, ',' ORDER BY m.i) FILTER (lost), '') AS removed,
  coalesce(string_agg(sentence, '' ORDER BY m.i) FILTER (NOT lost), '') AS text
FROM cut c LEFT JOIN marked m ON c.doc_id = m.doc_id
GROUP BY c.doc_id, c.s
"""

ORACLE_SQL = {
    "op2_quality_rules": QUALITY_RULES_SQL,
    "op7_sentence_dedup": SENTENCE_DEDUP_SQL,
    "op9_jaccard_join": JACCARD_JOIN_SQL,
    "op12_embedding_dedup": EMBEDDING_DEDUP_SQL,
    "op13_ranked_search": RANKED_SEARCH_SQL,
}
