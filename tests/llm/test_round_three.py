"""Token alignment, the embedding forest and ranked search, against plain versions of them."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from blobframe.llm import embedding_forest as forest
from blobframe.llm import ranked_search as search
from blobframe.llm import token_alignment as alignment

TEXTS = [
    "The cat sat on the mat, 12345 times.",
    "The cat sat on the mat, 12345 times.",
    "Größe und Straße <|endoftext|> <s> </s> <unk>",
    "tab\tand\nlines\r\n  two  blanks ",
    "emoji 😀 and 漢字, ñandú",
    "literal ▁ mark",
    "nul \x00 byte",
    " ",
    "",
    None,
    "word " * 3000,
    "x" * 5000,
]


@pytest.fixture(scope="module")
def aligner():
    import public_tokenizers

    return alignment.Aligner(
        alignment.byte_tokenizer(alignment.VOCABULARY_A),
        alignment.PieceTokenizer(public_tokenizers.path(alignment.VOCABULARY_B)),
    )


def plainly_aligned(aligner, text):
    """Ids and groups by walking both token lists at once; None where there are no tokens."""
    if not text:
        return None
    a = aligner.a.whole.encode(" " + text, add_special_tokens=False).ids
    b = aligner.b.model.encode(text)
    bytes_a, bytes_b = [aligner.a.bytes[i] for i in a], [aligner.b.bytes[i] for i in b]
    data = (" " + text).encode()
    if b"".join(bytes_a) != data or b"".join(bytes_b) != data:
        return None
    groups, at, end = [], [0, 0], [0, 0]
    while at[0] < len(a):
        group = [[], []]
        while True:
            k = 0 if not group[0] or (group[1] and end[0] < end[1]) else 1
            ids, parts = ((a, bytes_a), (b, bytes_b))[k]
            group[k].append(ids[at[k]])
            end[k] += len(parts[at[k]])
            at[k] += 1
            if group[0] and group[1] and end[0] == end[1]:
                break
        groups.append(group)
    return a, b, groups


def test_alignment_is_that_of_a_plain_walk(spark, aligner):
    rows = [(i, t, "x", 1) for i, t in enumerate(TEXTS)] + [(None, TEXTS[0], "x", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, pairs string, block long")
    plain = [plainly_aligned(aligner, t) for _, t, *_ in rows]
    links = [[(p, q) for ga, gb in x[2] for p in ga for q in gb] if x else [] for x in plain]
    counts = Counter(pair for each in links for pair in set(each))
    best = {}
    for (a, _), n in counts.items():
        best[a] = max(best.get(a, 0), n)
    want = []
    for (doc_id, *_), aligned, each in zip(rows, plain, links, strict=True):
        if aligned is None:
            want.append((doc_id, 0, 0, 0, 0, "", 0, 0))
            continue
        a, b, groups = aligned
        text = ";".join("|".join(",".join(map(str, ids)) for ids in group) for group in groups)
        digest = hashlib.sha256(text.encode()).hexdigest()
        n_best = sum(counts[pair] == best[pair[0]] for pair in each)
        total = sum(counts[pair] for pair in each)
        want.append((doc_id, len(a), len(b), len(groups), len(each), digest, n_best, total))
    got = [tuple(row) for row in alignment.token_alignment(docs).collect()]
    assert Counter(got) == Counter(want)
    assert alignment.token_alignment(docs.limit(0)).count() == 0


def test_alignment_does_not_depend_on_blocks(spark, monkeypatch):
    docs = spark.createDataFrame(list(enumerate(TEXTS * 3)), "doc_id long, text string")
    whole = Counter(map(tuple, alignment.token_alignment(docs).collect()))
    monkeypatch.setattr(alignment, "BLOCK_PAIRS", 5)
    assert Counter(map(tuple, alignment.token_alignment(docs).collect())) == whole


def test_both_libraries_give_the_same_ids(spark, aligner):
    texts = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()
    for (text,) in texts:
        whole = aligner.a.whole.encode(text, add_special_tokens=False).ids
        assert aligner.a.encode(text).tolist() == whole
    made = random.Random(3)
    letters = "ab cDé'sñ 01.,!  \n\t-ü"
    for _ in range(300):
        text = "".join(made.choice(letters) for _ in range(made.randrange(1, 60)))
        whole = aligner.a.whole.encode(text, add_special_tokens=False).ids
        assert aligner.a.encode(text).tolist() == whole


def linked(rows, cosine=0.95):
    """n_links and component by comparing all pairs."""
    usable = {}
    for k, (_, vec) in enumerate(rows):
        if vec and all(x is not None and math.isfinite(x) for x in vec) and any(vec):
            unit = np.array(vec, float) / np.abs(vec).max()
            usable[k] = unit / np.linalg.norm(unit)
    links = {k: [] for k in range(len(rows))}
    for i, one in usable.items():
        for j, other in usable.items():
            if i < j and len(one) == len(other) and one @ other >= cosine:
                links[i].append(j)
                links[j].append(i)
    out, seen = {}, set()
    for k in links:
        if k in seen:
            continue
        todo, group = [k], {k}
        while todo:
            new = set(links[todo.pop()]) - group
            group |= new
            todo += new
        seen |= group
        least = min((rows[i][0] for i in group if rows[i][0] is not None), default=None)
        for i in group:
            out[i] = least
    return [
        (rows[k][0], len(links[k]), out[k], out[k] is not None and out[k] == rows[k][0])
        for k in range(len(rows))
    ]


def near(base, cosine, made):
    other = made.standard_normal(len(base))
    other -= other @ base * base
    other /= np.linalg.norm(other)
    return cosine * base + math.sqrt(1 - cosine**2) * other


def vectors():
    made = np.random.default_rng(5)
    base = made.standard_normal((120, 16))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    vecs = [v.tolist() for v in base]
    vecs += [near(base[k], 0.955 + k / 1000, made).tolist() for k in range(30)]
    vecs += [near(base[40], 0.99, made).tolist() for _ in range(60)]  # one ball
    vecs += [near(base[41], 0.975, made).tolist() for _ in range(40)]  # wider than one
    vecs += [vecs[50]] * 5 + [(3 * base[50]).tolist(), (1e200 * base[51]).tolist()]
    vecs += [None, [], [0.0] * 16, [math.nan] * 16, [None] * 16, [1.0] * 15 + [math.inf]]
    vecs += [[1.0, 0.0], [0.99, 0.01], [-0.0, 1.0], [0.0, 1.0]]
    return [(None if k == 45 else k, v) for k, v in enumerate(vecs)]


def test_forest_links_what_all_pairs_link(spark):
    rows = vectors()
    columns = "vec_id long, embedding array<double>, cell long, node string"
    table = spark.createDataFrame([(*r, 1, "x") for r in rows], columns)
    got = [tuple(r) for r in forest.near_duplicates(table, leaf=16).collect()]
    want = linked(rows)
    by_id = {r[0]: r for r in want}
    assert sorted(r[0] or -1 for r in got) == sorted(r[0] or -1 for r in want)
    assert all(r[1] <= by_id[r[0]][1] for r in got)  # no link that is not one
    assert sum(r[1] for r in got) >= 0.98 * sum(r[1] for r in want)
    assert sum(r != by_id[r[0]] for r in got) <= 0.05 * len(want)


def test_forest_is_exact_if_one_leaf_holds_all(spark):
    rows = vectors()
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [tuple(r) for r in forest.near_duplicates(table, trees=1, leaf=1000).collect()]
    assert Counter(got) == Counter(linked(rows))


def test_forest_of_nothing(spark):
    table = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert forest.near_duplicates(table).count() == 0
    table = spark.createDataFrame([(4, None)], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in forest.near_duplicates(table).collect()] == [(4, 0, 4, True)]


def test_a_cell_shrinks_whatever_it_holds():
    uids, same = np.arange(1000), np.zeros((1000, 2), np.float32)
    low, high = forest.fit(uids, same, 2, 0.1)
    parts = forest.split(uids, same, low, high)
    assert max(len(rows) for _, rows in parts) <= 350
    assert len(np.unique(np.concatenate([rows for _, rows in parts]))) == 1000


def plainly_ranked(docs, items):
    """item_id, rank, doc_id, score by scoring every document for every item."""
    word = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    terms = [(i, word.findall((t or "").translate(lower))) for i, t in docs]
    terms = [(i, t) for i, t in terms if t]
    n_docs, length = len(terms), sum(len(t) for _, t in terms)
    df = Counter(t for _, each in terms for t in set(each))
    out = []
    for item_id, text in items:
        asked, scored = word.findall((text or "").translate(lower)), []
        for doc_id, each in terms:
            held, m = Counter(each), 25 + 75 * len(each) * n_docs // length
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                * ((1000000000 * held[t]) // (1000 * held[t] + 8 * m))
                for t in asked
                if t in held
            )
            if score > 0:
                scored.append((-score, doc_id is None, doc_id))
        scored.sort(key=lambda s: (s[0], s[1], s[2] or 0))
        out += [(item_id, k + 1, s[2], -s[0]) for k, s in enumerate(scored[:10])]
    return out


def found(docs, items, **options):
    return Counter(map(tuple, search.ranked_search(docs, items, **options).collect()))


@pytest.mark.parametrize("options", [{}, {"bundle_items": 2, "slice_docs": 7}])
def test_search_ranks_like_scoring_everything(spark, options):
    made = random.Random(9)
    common = ["the", "The", "of", "Straße", "x1"]
    rare = [f"w{k}é" for k in range(150)]
    text = lambda n: " ".join(made.choice(common if made.random() < 0.5 else rare) for _ in range(n))
    docs = [(k, text(made.randrange(1, 40))) for k in range(300)]
    docs += [(400 + k, docs[7][1]) for k in range(40)]  # equal scores
    docs += [(7, docs[7][1]), (500, None), (501, ""), (502, " .,\t"), (None, docs[7][1])]
    docs += [(503, "the " * 20000 + "w1é")]
    items = [(k, text(12)) for k in range(9)] + [(3, docs[7][1]), (None, "w1é"), (20, None), (21, "none!")]
    table = spark.createDataFrame([(*d, "t", 1) for d in docs], "doc_id long, text string, term string, row long")
    asked = spark.createDataFrame([(*i, 2) for i in items], "item_id long, text string, tid long")
    assert found(table, asked, **options) == Counter(plainly_ranked(docs, items))


def test_search_in_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert not found(empty, items)
    assert not found(items.withColumnRenamed("item_id", "doc_id"), items.limit(0))
