"""What the operators move and hold, on rows that made them grow faster than their input."""

import os
import random
from collections import Counter

from blobframe.llm import common, pii, sentence_dedup
from blobframe.llm import jaccard_join as jaccard

PHRASE = "all rights reserved under the terms of this licence as it stands today"


def with_a_stock_phrase(n, seed=5):
    """Unlike texts of 150 to 159 words, each with the same phrase in it; every tenth is nearly copied."""
    made = random.Random(seed)
    texts = []
    for i in range(n):
        words = [f"w{made.randrange(10**9)}" for _ in range(made.randrange(150, 160))]
        at = made.randrange(len(words))
        texts.append(" ".join([*words[:at], PHRASE, *words[at:]]))
        if i % 10 == 0:
            texts.append(texts[-1].replace(words[3], "other"))
    return texts


def test_a_stock_phrase_ties_few_sets(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "COMMON_SAMPLE", 1)
    texts = [t for i, t in enumerate(with_a_stock_phrase(200)) if i % 11 != 1]  # without near copies
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    docs = jaccard.with_text_hashes(docs)
    common = jaccard.common_shingles(docs, 5)
    assert len(common) == len(PHRASE.split()) - 4
    tied = jaccard.tied_places(jaccard.set_of_documents(docs, 5, 80, common)).count()
    before = jaccard.tied_places(jaccard.set_of_documents(docs, 5, 80)).count()
    assert tied < before / 5 and before > 50


def test_common_shingles_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "COMMON_SAMPLE", 1)
    made = random.Random(8)
    texts = with_a_stock_phrase(60) + [PHRASE, PHRASE + " and", PHRASE + " and so on", "", None, "one"]
    for _ in range(60):  # whole texts of common shingles, and copies of others with some words changed
        words = made.choice(texts[:66]).split()
        for _ in range(made.randrange(1, 4)):
            words[made.randrange(len(words))] = f"x{made.randrange(4)}"
        texts.append(" ".join(words))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets = [set(jaccard.shingle_set(t, 5).tolist()) for t in texts]
    root = list(range(len(texts)))
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                low, high = sorted((root[i], root[j]))
                root = [low if r == high else r for r in root]
    want = Counter((i, len(s), r) for i, (s, r) in enumerate(zip(sets, root, strict=True)))
    assert len(set(root)) < len(texts) - 20
    got = jaccard.jaccard_groups(docs, 80, 5)
    assert Counter(map(tuple, got.collect())) == want
    monkeypatch.setattr(jaccard, "COMMON_SHINGLES", 3)
    assert len(jaccard.common_shingles(jaccard.with_text_hashes(docs), 5)) <= 3
    assert Counter(map(tuple, jaccard.jaccard_groups(docs, 80, 5).collect())) == want


def test_blocks_are_shuffled_once(spark, monkeypatch):
    """Also where many blocks are shared by three places or more, which had them joined with all."""
    monkeypatch.setattr(jaccard, "BROADCAST_ROWS", 0)
    passed = []
    real = jaccard.components
    monkeypatch.setattr(jaccard, "components", lambda e, label: passed.append(e) or real(e, label))
    lists = {1: [10, 11], 2: [11, 13, 12], 3: [20], 4: [20, 21, 21, 22], 5: [30], 6: [-5, 12]}
    entries = [(p, b) for b, places in lists.items() for p in places]
    rows = [(p, [b], None, []) if b % 2 else (None, [], p, [b]) for p, b in entries]
    sets = spark.createDataFrame(rows, "v0 long, b0 array<long>, v1 long, b1 array<long>")
    got = Counter(tuple(r) for r in jaccard.tied_places(sets).select("place", "root").collect())
    assert got == Counter([(p, -5) for p in (-5, 10, 11, 12, 13)] + [(p, 20) for p in (20, 21, 22)])
    plan = passed[0]._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 1


def test_equal_sets_of_a_batch_carry_their_blocks_once(spark):
    text = " ".join(f"w{k}" for k in range(150))
    rows = [(k, text if k % 2 else text.upper()) for k in range(20)] + [(20, text + " more")]
    docs = jaccard.with_text_hashes(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1))
    sets = sorted(jaccard.set_of_documents(docs, 5, 80).collect())
    assert len({(r.node, r.check, r.v0, r.v1) for r in sets[:20]}) == 1 and sets[0].v0 is not None
    assert [bool(r.b0) for r in sets] == [True] + [False] * 19 + [True]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.component_id for r in jaccard.jaccard_groups(docs, 80, 5).collect()} == {0}


def test_common_shingles_are_no_python_rows_in_the_driver(spark, monkeypatch):
    def refused(self):
        raise AssertionError("rows of Python objects")

    monkeypatch.setattr(jaccard, "COMMON_SAMPLE", 1)
    monkeypatch.setattr(type(spark.range(1)), "toPandas", refused)
    docs = spark.createDataFrame([(0, "a b c d e"), (1, "a b c d e f"), (2, "x")], "doc_id long, text string")
    found = jaccard.common_shingles(jaccard.with_text_hashes(docs), 5)
    assert found.dtype == "uint64" and found.tolist() == jaccard.shingle_set("a b c d e", 5).tolist()


def private_texts(n=60, seed=4):
    made = random.Random(seed)
    texts = []
    for i in range(n):
        words = [f"w{chr(97 + made.randrange(20))}x{chr(97 + made.randrange(20))}" for _ in range(30)]
        owner = i % 5
        words += [f"who{chr(97 + owner)}", f"p{chr(97 + owner)}@site{owner % 2}.org"]
        made.shuffle(words)
        texts.append(" ".join(words))
    return [*texts, texts[0], texts[1], "", None, "no data"]


def test_words_meet_entities_of_their_own_text_alone(spark):
    rows = [(1, 0, "alpha beta", ["e1"]), (2, 0, "alpha", ["e2"]), (3, 0, "alpha gamma", ["e1", "e1"])]
    hits = spark.createDataFrame(rows, "t1 long, t2 long, text string, entities array<string>")
    known = [("alpha", f"e{k}", False) for k in range(1, 40)] + [("beta", "e2", True)]
    pairs = spark.createDataFrame(known, "term string, entity string, removed boolean")
    got = pii.told_words(hits, pairs)
    assert sorted(map(tuple, got.collect())) == [(k, 0, "alpha", False) for k in (1, 2, 3)]


def test_private_data_is_the_same_however_tables_are_joined(spark, monkeypatch):
    docs = spark.createDataFrame(list(enumerate(private_texts())), "doc_id long, text string")
    few = Counter(map(str, pii.find_private(docs).collect()))
    assert sum("term" in row for row in few) > 5
    monkeypatch.setattr(common, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(pii, "BROADCAST_ROWS", 0)
    assert Counter(map(str, pii.find_private(docs).collect())) == few
    monkeypatch.setattr(pii, "BROADCAST_KEYS", 0)
    assert Counter(map(str, pii.find_private(docs).collect())) == few


def test_many_wanted_terms_are_joined_with_sums(spark, monkeypatch):
    monkeypatch.setattr(pii, "BROADCAST_ROWS", 0)
    docs = spark.createDataFrame([(k % 3, 0, f"same words {k % 3}") for k in range(9)], "t1 long, t2 long, text string")
    wanted = spark.createDataFrame([("same",), ("other",)], "term string")
    n, counted = pii.term_counts(docs, wanted)
    assert (n, [tuple(r) for r in counted.collect()]) == (3, [("same", 3)])
    plan = counted._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join Inner") < plan.index("Aggregate [term")


def test_places_of_repeated_runs_alone_are_compared(spark, monkeypatch):
    stored = {}
    for name in ("settled", "materialize"):
        real = getattr(sentence_dedup, name)

        def seen(df, label, *args, real=real, **options):
            out = stored[label] = real(df, label, *args, **options)
            return out

        monkeypatch.setattr(sentence_dedup, name, seen)
    word = lambda k: " ".join(f"s{k}w{i}" for i in range(6)) + ". "
    texts = ["".join(word(100 * d + k) for k in range(20)) for d in range(6)]
    texts[3] = texts[3] + "".join(word(5 + k) for k in range(4))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.removed for r in sentence_dedup.sentence_dedup(docs).collect()}
    assert got == {d: [20, 21, 22, 23] if d == 3 else [] for d in range(6)}
    assert stored["met"].count() == 4  # two runs of three sentences, at two places each
    assert stored["removed_sentences"].count() == 1
    folder = stored["runs"].inputFiles()[0].removeprefix("file:").rsplit("/", 1)[0]
    assert not os.path.exists(folder)
