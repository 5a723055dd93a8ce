"""What the Jaccard join stores, on rows that made its disk grow faster than its input."""

import os
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa

from blobframe.llm import jaccard_join as jaccard


def stored_sizes(monkeypatch):
    """Bytes of every table that the join stores, by its label."""
    sizes = defaultdict(list)
    for name in ("settled", "materialize"):
        real = getattr(jaccard, name)

        def seen(df, label, *args, real=real, **options):
            out = real(df, label, *args, **options)
            files = [f.removeprefix("file:") for f in out.inputFiles()]
            sizes[label].append(sum(os.path.getsize("/" + f.lstrip("/")) for f in files))
            return out

        monkeypatch.setattr(jaccard, name, seen)
    return sizes


def unlike(n, words, seed):
    made = random.Random(seed)
    return [" ".join(f"w{made.randrange(10**9)}" for _ in range(words)) for _ in range(n)]


def linked(texts, width, percent):
    """doc_id and the least id that links reach, by all pairs."""
    sets = [set(jaccard.shingle_set(t, width).tolist()) for t in texts]
    root = list(range(len(texts)))
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                low, high = sorted((root[i], root[j]))
                root = [low if r == high else r for r in root]
    return dict(enumerate(root))


def test_blocks_are_stored_nowhere(spark, monkeypatch):
    sizes = stored_sizes(monkeypatch)
    texts = unlike(300, 400, 1)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in jaccard.jaccard_groups(docs, 80, 5).collect()}
    assert got == {i: i for i in range(300)}
    blocks = 8 * sum(
        len(hashes)
        for t in texts
        for _, hashes in jaccard.block_hashes(jaccard.shingle_set(t, 5), jaccard.size_classes(80), 80)
    )
    assert max(max(x) for x in sizes.values()) < blocks / 4


def test_a_block_is_shuffled_in_a_few_bytes_and_once_a_batch():
    run, _ = jaccard.packed_blocks(["v0", "v1"], 3)
    made = np.random.default_rng(2)
    own = [made.integers(0, 1 << 63, 500) for _ in range(40)]
    shared = made.integers(0, 1 << 63, 100)
    lists = pa.array([np.r_[x, shared] for x in own], pa.list_(pa.int64()))
    nulls = pa.nulls(40, pa.int64())
    empty = pa.array([[]] * 40, pa.list_(pa.int64()))
    columns = [pa.array(range(40), pa.int64()), nulls, lists, empty]
    rows = list(run([pa.record_batch(columns, names=["v0", "v1", "b0", "b1"])]))
    rows = [r for batch in rows for r in batch.to_pylist()]
    packed = [r for r in rows if r["blocks"] is not None]
    assert len(packed) == 8 and {r["bucket"] for r in packed} == set(range(8))
    assert sum(len(r["blocks"]) for r in packed) == 5 * (40 * 500 + 100)
    places = jaccard.unplaned([r["places"] for r in packed], 8)
    assert Counter(places.tolist()) == {0: 600} | dict.fromkeys(range(1, 40), 500)
    assert sorted((r["u"], r["v"]) for r in rows if r["u"] is not None) == [(k, 0) for k in range(1, 40)]
    assert sorted(r["v0"] for r in rows if r["v0"] is not None) == list(range(40))


def test_places_are_tied_in_any_batches_and_buckets(spark, monkeypatch):
    made = random.Random(3)
    rows = [(k * (-1) ** k, [made.randrange(600) for _ in range(2)], None, []) for k in range(1, 301)]
    root = {p: p for p, *_ in rows}
    holders = defaultdict(set)
    for p, blocks, *_ in rows:
        for b in blocks:
            holders[b].add(p)
    for places in holders.values():
        reached = {root[p] for p in places}
        root = {p: min(reached) if r in reached else r for p, r in root.items()}
    sizes = Counter(root.values())
    want = {p: r for p, r in root.items() if sizes[r] > 1}
    sets = spark.createDataFrame(rows, "v0 long, b0 array<long>, v1 long, b1 array<long>").repartition(5)
    for packed, bits in ((1 << 20, 0), (7, 4)):
        monkeypatch.setattr(jaccard, "PACKED", packed)
        got = jaccard.tied_places(sets, bits).select("place", "root").collect()
        assert dict(map(tuple, got)) == want


def test_every_two_chunks_meet_in_one_round():
    made = random.Random(4)
    for _ in range(200):
        weights = [(made.randrange(1, 30), made.randrange(1, 1000)) for _ in range(made.randrange(1, 6))]
        weights = list(dict(weights).items())
        total = sum(w for _, w in weights)
        rounds = jaccard.rounds_of(weights, 2 * total)
        steps = [k for low, high in rounds for k in range(low, high + 1)]
        assert steps == list(range(max(c for c, _ in weights) // 2 + 1))
        for low, high in rounds:
            dealt = 0
            for chunks, weight in weights:
                pairs = {tuple(sorted((c, (c + k) % chunks))) for c in range(chunks) for k in range(low, high + 1) if k <= chunks // 2}
                dealt += weight / chunks * sum(len(set(p)) for p in pairs)
            assert dealt <= 2 * total + 1e-6


def test_a_cluster_of_many_chunks_is_not_dealt_out_at_once(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "ROUND_SHINGLES", 0)
    dealt = []
    real = jaccard.linked_sets

    def seen(sets, *args):
        dealt.append(args[1:])
        return real(sets, *args)

    monkeypatch.setattr(jaccard, "linked_sets", seen)
    made = random.Random(5)
    base = unlike(1, 60, 6)[0].split()
    texts = unlike(10, 60, 7)
    for k in range(40):  # a chain of near copies: each differs a little more from the first
        base[made.randrange(60)] = f"x{k}"
        texts.append(" ".join(base))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = linked(texts, 3, 80)
    assert len(set(want.values())) < 30
    got = {r.doc_id: r.component_id for r in jaccard.jaccard_groups(docs, 80, 3, chunk=400).collect()}
    assert got == want and len(dealt) > 1 and dealt[0][0] == 0
