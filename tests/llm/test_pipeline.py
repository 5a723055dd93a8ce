"""The corpus pipeline's stages on a small fixture."""

import os
import random
from collections import Counter

import numpy as np

import corpus_pipeline as cp
from blobframe.llm import jaccard_join as jj
from blobframe.llm import stages
from blobframe.llm.jaccard_join import jaccard_groups
from blobframe.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def test_stages_keep_columns_and_rows_they_should(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept, columns = docs, docs.columns
    sizes = []
    for _, stage in cp.STAGES[:-1]:
        out = stage(spark, kept, SF)
        assert out.columns == columns
        kept = cp.materialize(out, "test_stage")
        sizes.append(kept.count())
    assert sizes[0] <= docs.count() and sizes[1] <= sizes[0] and sizes[2] == sizes[1]
    packed = cp.STAGES[-1][1](spark, kept, SF)
    assert packed.select("doc_id").distinct().count() == kept.select("doc_id").distinct().count()
    text = " ".join(r.text for r in kept.select("text").collect())
    assert "@" not in text or "<EMAIL>" in text
    assert [name for name, _ in cp.STAGES] == ["toxicity", "jaccard_join", "pii", "mixing", "packing"]


def test_every_operator_has_a_query():
    assert {int(name[2:].split("_")[0]) for name in QUERIES} == set(range(1, 14))
    assert set(ORACLE_SQL) <= set(QUERIES) and os.path.isdir(SF)


def made_text(rng, n):
    return " ".join(f"w{rng.randrange(10**9)}" for _ in range(n))


def test_unlinked_documents_stay_whatever_their_ids(spark):
    rng = random.Random(2)
    texts = [made_text(rng, 40) for _ in range(5)]
    rows = list(zip([None, None, 5, 5, 6], texts))
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], DOCUMENTS)
    kept = stages.one_of_each_group(spark, docs, SF)
    assert sorted(r.text for r in kept.collect()) == sorted(texts)


def test_one_row_of_each_group_stays(spark):
    rng = random.Random(3)
    base, other = made_text(rng, 60), made_text(rng, 60)
    near = base.rsplit(" ", 1)[0] + " end"
    rows = [(4, near), (3, base), (3, base), (None, base), (9, near), (None, other), (None, other)]
    rows += [(20, None), (21, ""), (21, ""), (22, " \n"), (None, None), (30, base + " " + other)]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], DOCUMENTS)
    kept = [(r.doc_id, r.text) for r in stages.one_of_each_group(spark, docs, SF).collect()]
    want = [(3, base), (None, other), (20, None), (21, ""), (21, ""), (22, " \n"), (None, None)]
    assert Counter(kept) == Counter([*want, (30, base + " " + other)])


def test_texts_that_share_a_passage_are_not_linked(spark):
    rng = random.Random(4)
    passage = made_text(rng, 60)
    texts = [f"{made_text(rng, 50)} {passage} {made_text(rng, 50 + k % 9)}" for k in range(120)]
    texts += [texts[0].replace("w1", "w2", 2)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    groups = {r.doc_id: r.component_id for r in jaccard_groups(docs, 80, 5).collect()}
    assert groups.pop(120) == 0
    assert all(i == c for i, c in groups.items())


def test_hashed_blocks_of_linked_sets_meet():
    """Any two sets that link share a block, at every threshold and size; no block is empty."""
    rng = random.Random(5)
    for percent in (10, 50, 80, 90):
        starts = jj.size_classes(percent)
        for _ in range(400):
            a = {rng.getrandbits(64) for _ in range(rng.randrange(1, 120))}
            b = set(a)
            while 100 * len(a & b) >= percent * len(a | b):
                last = set(b)
                if rng.random() < 0.5 and len(b) > 1:
                    b.discard(rng.choice(sorted(b)))
                else:
                    b.add(rng.getrandbits(64))
            if a == last:
                continue
            one, two = (
                dict(jj.block_hashes(np.array(sorted(x), np.uint64), starts, percent)) for x in (a, last)
            )
            assert any(set(one[k].tolist()) & set(two[k].tolist()) for k in one if k in two)


def test_every_stage_takes_odd_tables(spark):
    odd = DOCUMENTS + ", _words int, size int, shard string, row int, base string, copies int, `a.b` int"
    rest = ("en", "s", 1, 1, 2, "x", 3, "y", 4, 5)
    rng = random.Random(6)
    texts = [None, "", "mail me at a@b.example.com", made_text(rng, 3000), made_text(rng, 30)]
    rows = [(k, t, *rest) for k, t in enumerate(texts)] + [(None, texts[4], *rest)] * 2
    rows += [(4, texts[4], *rest), (50, "x " * 50, None, None, None, *rest[3:])]
    docs = spark.createDataFrame(rows, odd)
    for name, stage in cp.STAGES[:-1]:
        got = cp.materialize(stage(spark, docs, SF), "odd")
        assert got.columns == docs.columns, name
        assert got.where("shard != 'x' or row != 3").isEmpty() and not got.isEmpty(), name
        assert stage(spark, docs.limit(0), SF).count() == 0, name
    packed = cp.STAGES[-1][1](spark, docs, SF)
    assert packed.count() >= len(rows)
    assert cp.STAGES[-1][1](spark, docs.limit(0), SF).count() == 0
