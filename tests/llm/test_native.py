"""The operators in native columns against brute force."""

import collections
import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from blobframe.llm.fingerprints import document_fingerprints, within_radius
from blobframe.llm.mixing import choose_copies, hypergeometric, mix_sources
from blobframe.llm.pii import find_private, sanitise
from blobframe.llm.quality_rules import quality_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, source string"
ODD_TEXTS = [
    None, "", " ", "\n\n", "one", "a b c d", "\ta  b\x0bc\x1cd e f", "ü" * 30,
    "x y z q r " * 40, "same line\nsame line\n \nother\nsame line", "#*$%&|<> a" * 3,
]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    words = ["alpha", "beta", "gamma", "delta", "épsilon", "zeta#", "eta|", "theta."]
    made = [" ".join(rng.choices(words, k=rng.randint(1, 60))) for _ in range(40)]
    made[7] = made[3]
    made.append("\n".join(made[:3] + made[:2]))
    made.append("lang " * 3000)
    return ODD_TEXTS + made


def repeated(words):
    seen = collections.Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = set()
    for i in range(len(words) - 4):
        if seen[tuple(words[i : i + 5])] > 1:
            covered |= set(range(i, i + 5))
    return len(covered)


def test_quality_statistics(spark, texts):
    df = spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)], DOCS)
    got = {r.doc_id: r for r in quality_rules(df).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        words = WORD.findall(t or "")
        lines = [x for x in (t or "").split("\n") if WORD.search(x)]
        n, n_repeat = len(words), repeated(words)
        want = (
            n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in t or ""),
            len(lines) - len(set(lines)), n_repeat, n < 10 or 100 * n_repeat > 20 * n,
        )
        r = got[i]
        assert want == (
            r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed
        ), t


def test_bad_hosts_lose_their_documents(spark):
    good = "every word of this text is here just once and no more than that"
    rows = [(i, good, "good") for i in range(40)] + [(100 + i, "bad", "bad") for i in range(39)]
    rows += [(200, good, "bad"), (201, good, None), (202, "few", None), (203, good, "new")]
    got = {r.doc_id: r for r in quality_rules(spark.createDataFrame(rows, DOCS)).collect()}
    assert got[0].kept and got[203].kept and not got[200].kept and not got[200].host_kept
    assert not got[202].kept and len(got) == len(rows)


def test_quality_of_nothing_and_clashing_columns(spark):
    odd = ", kept string, _words string, host int, row int, `a.b` int, docs int, _lines int"
    empty = spark.createDataFrame([], DOCS + odd)
    assert quality_rules(empty).count() == 0
    one = spark.createDataFrame([(1, None, None, "k", "w", 2, 3, 4, 5, 6, "x")] * 2, DOCS + odd + ", n_words string")
    got = quality_rules(one).collect()
    assert [(r.n_words, r.kept, r._words, r.host, r.row, r["a.b"], r.docs, r._lines) for r in got] == [
        (0, False, "w", 2, 3, 4, 5, 6)
    ] * 2


def test_host_rates_are_those_of_a_plain_model(spark):
    import random
    from collections import defaultdict

    made = random.Random(8)
    rows = []
    for k in range(900):
        host = k % 9 if k % 50 else None
        words = [f"w{made.randrange(10**6)}" for _ in range(made.randrange(4, 40))]
        if made.random() < (0.9 if host == 3 else 0.1):
            words += ["#### %%"] * 12
        if made.random() < (0.05 * (host or 0)):
            words += "over and over and once more".split() * 5
        text = " ".join(words)
        if made.random() < (0.8 if host == 5 else 0.02):
            text += "\nsame line" * 20
        rows.append((k, text, None if host is None else f"h{host}"))
    got = {r.doc_id: r for r in quality_rules(spark.createDataFrame(rows, DOCS)).collect()}
    rules = ["few_words", "repeats", "symbols", "dup_lines"]
    hosts = defaultdict(list)
    for k, _, host in rows:
        hosts[host].append([got[k][rule] for rule in rules])
    bad = set()
    for at in range(4):
        rates = {h: sum(f[at] for f in each) / len(each) for h, each in hosts.items()}
        mean = sum(f[at] for each in hosts.values() for f in each) / len(rows)
        centre = sum(rates.values()) / len(rates)
        spread = sum((r - centre) ** 2 for r in rates.values()) / len(rates)
        spread -= sum(r * (1 - r) / len(hosts[h]) for h, r in rates.items()) / len(rates)
        weight = 1e6 if spread <= 0 else min(1e6, max(1.0, mean * (1 - mean) / spread - 1))
        for host, each in hosts.items():
            rate = (sum(f[at] for f in each) + mean * weight) / (len(each) + weight)
            if rate > mean + 0.4 * (1 - mean):
                bad.add(host)
    assert {"h3", "h5"} <= bad and len(bad) < 6
    for k, _, host in rows:
        assert got[k].host_kept == (host not in bad)
        assert got[k].kept == (not got[k].base_failed and host not in bad)


def test_hypergeometric_is_the_exact_quantile(spark):
    from math import comb

    cases = [(u, m, t, d) for u in (0.01, 0.3, 0.5, 0.99) for m, t, d in [(5, 12, 6), (0, 9, 4), (30, 80, 40), (9, 9, 3)]]
    df = spark.createDataFrame(cases, "u double, m long, t long, d long")
    got = [r[0] for r in df.select(hypergeometric(*map(F.col, "umtd"))).collect()]
    for (u, m, t, d), k in zip(cases, got, strict=True):
        p, want = 0.0, None
        for j in range(max(0, d - t + m), min(m, d) + 1):
            p += comb(m, j) * comb(t - m, d - j) / comb(t, d)
            if want is None and p >= u - 1e-12:
                want = j
        assert k == want


def test_mixing_meets_its_targets(spark):
    rng = random.Random(5)
    rows = [(i, rng.randint(0, 300), rng.choice(["a", "a", "a", "b", "c", "d", None])) for i in range(900)]
    df = spark.createDataFrame(rows, "doc_id long, size long, source string")
    first = choose_copies(df, shards=8).collect()
    assert sorted(map(str, first)) == sorted(map(str, choose_copies(df, shards=8).collect()))
    taken, sizes, targets = collections.Counter(), collections.Counter(), {}
    for r in first:
        assert len(r.copies) <= 2
        taken[r.source] += r["size"] * len(r.copies)
        sizes[r.source] += r["size"]
        targets[r.source] = r.target
        assert r.source_size == sum(s for _, s, x in rows if x == r.source)
    names = sorted((s for s in sizes if s), key=str) + [None]
    weights = dict(zip(names, [5, 2, 1, 5, 2], strict=True))
    want, free, left = {}, set(names), 1.5 * sum(sizes.values())
    while free:
        share = {s: left * weights[s] / sum(weights[x] for x in free) for s in free}
        over = {s for s in free if share[s] > 2 * sizes[s]}
        want |= {s: 2.0 * sizes[s] if s in over else share[s] for s in over or free}
        left -= sum(2 * sizes[s] for s in over)
        free = free - over if over else set()
    for s in names:
        assert targets[s] == pytest.approx(want[s])
        assert abs(taken[s] - targets[s]) <= 300
    assert {c.shard for r in first for c in r.copies} == set(range(8))
    mixed = mix_sources(df, shards=8)
    assert mixed.columns == [*df.columns, "shard"]
    assert mixed.count() == sum(len(r.copies) for r in first)


def test_mixing_odd_tables(spark):
    schema = "doc_id long, size long, source string, target string"
    assert choose_copies(spark.createDataFrame([], schema)).count() == 0
    rows = [(None, None, None, "x"), (1, 0, "a", "y"), (1, 0, "a", "y")]
    got = choose_copies(spark.createDataFrame(rows, schema)).collect()
    assert [(len(r.copies), r.target) for r in got] == [(0, 0.0)] * 3


PATTERNS = [
    re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    re.compile(r"[0-9]([\x20-]?[0-9])+"),
    re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
]


def passes(kind, hit):
    digits = re.sub("[^0-9]", "", hit)
    if kind == 1:
        return all(int(x) <= 255 for x in hit.split("."))
    if kind == 2:
        total = sum(
            sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(reversed(digits))
        )
        return 14 <= len(digits) <= 19 and total % 10 == 0
    return kind == 0 or 10 <= len(digits) <= 15


def test_private_data_matches_the_patterns(spark):
    rng = random.Random(11)
    parts = ["a.b@c.de", "@", "x@y", ".", "..", "1.2.3.4", "256.1.1.1", "0001.002.03.255", "+1 (499) 555-6503",
             "4111 1111 1111 1111", "4111-1111-1111-1112", " ", "-", "+", "é𝒳", "_%", "9", "00", "a@b.c_d@e.f", "mail"]
    texts = [None, ""] + ["".join(rng.choices(parts, k=rng.randint(1, 25))) for _ in range(400)]
    texts.append("7 " * 4000 + "a@" + "b." * 3000 + "c")
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in find_private(df).collect()}
    for i, t in enumerate(texts):
        spans = [
            (m.start(), k, m.end())
            for k, p in enumerate(PATTERNS)
            for m in p.finditer(t or "")
            if passes(k, m.group())
        ]
        names = ["email", "ip", "card", "phone"]
        text = ",".join(f"{names[k]}:{a}:{b}" for a, k, b in sorted(spans))
        assert got[i].base_sha256 == hashlib.sha256(text.encode()).hexdigest(), t
        counts = collections.Counter(k for _, k, _ in spans)
        assert [got[i][f"n_{n}"] for n in names] == [counts[k] for k in range(4)]


def test_disclosing_terms_are_masked(spark):
    secret = "Zorblatt writes from ann@corp.org about the day number"
    rows = [(i, f"{secret} {i}", "s") for i in range(6)]
    rows += [(100 + i, f"about the day nobody writes from here {i}", "s") for i in range(60)]
    rows += [(300, None, None), (301, "", "s")]
    df = spark.createDataFrame(rows, DOCS)
    got = {r.doc_id: r.text for r in sanitise(df).collect()}
    assert "ann@corp.org" not in got[0] and "<EMAIL>" in got[0] and "Zorblatt" not in got[0]
    assert "about the day" in got[0] and got[100] == rows[6][1] and got[300] is None
    assert sanitise(df).columns == df.columns
    spans = {r.doc_id: r.spans for r in find_private(df).collect()}
    assert "term:0:8" in spans[0] and spans[100] == ""
    assert sanitise(spark.createDataFrame([], DOCS + ", base string")).count() == 0


def test_fingerprints_and_edited_texts(spark, texts):
    rows = [(i * 7, t, "s") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, DOCS)
    got = {r.doc_id: r for r in document_fingerprints(df, every=7).collect()}
    known = {k: int(r.fingerprint, 16) for k, r in got.items()}
    for k, (i, t, _) in enumerate(rows):
        t, after = t or "", rows[(k + 1) % len(rows)]
        cut = len(t) // 4
        edited = t[: len(t) - cut] + (after[1] or "")[:cut]
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        apart = bin(known[i] ^ known[after[0]]).count("1")
        assert r.near_next == pytest.approx((64 - apart) / 64)
        assert r.n_near == sum(bin(known[i] ^ x).count("1") <= 3 for x in known.values())
    by_text = collections.defaultdict(set)
    for i, t, _ in rows:
        by_text[t or ""].add(got[i].fingerprint)
    assert all(len(x) == 1 for x in by_text.values())


def test_fingerprints_across_ranges(spark, monkeypatch):
    monkeypatch.setattr("blobframe.llm.fingerprints.RANGE_ROWS", 10)
    rows = [(i * i, f"text number {i} with some words in it", "s") for i in range(100)]
    got = document_fingerprints(spark.createDataFrame(rows, DOCS).repartition(7)).collect()
    assert len(got) == 100
    for r in got:
        k = int(r.doc_id**0.5 + 0.5)
        t, after = rows[k][1], rows[(k + 1) % 100][1]
        cut = len(t) // 4
        want = t[: len(t) - cut] + after[:cut]
        assert r.edited_sha256 == hashlib.sha256(want.encode()).hexdigest()


def test_fingerprints_of_odd_tables(spark):
    assert document_fingerprints(spark.createDataFrame([], DOCS)).count() == 0
    rows = [(None, "no id here", "s")] * 2 + [(5, "lone text of a few words", None)]
    got = document_fingerprints(spark.createDataFrame(rows, DOCS)).collect()
    assert len(got) == 3 and {r.near_next for r in got if r.doc_id == 5} == {1.0}


def test_every_near_fingerprint_is_found(spark):
    rng = random.Random(2)
    base = [rng.getrandbits(64) for _ in range(30)]
    for x in base[:20]:
        near = x
        for bit in rng.sample(range(64), rng.randint(0, 5)):
            near ^= 1 << bit
        base.append(near)
    signed = [x - (1 << 64) if x >> 63 else x for x in base]
    df = spark.createDataFrame([(x,) for x in signed], "fingerprint long")
    got = {(r[0], r[1]) for r in within_radius(df, df).collect()}
    want = {(a, b) for a, x in zip(signed, base, strict=True) for b, y in zip(signed, base, strict=True)
            if bin(x ^ y).count("1") <= 3}
    assert got == want


def test_disclosure_shares_are_those_of_a_plain_model(spark):
    import math
    import random
    import re
    from collections import defaultdict

    made = random.Random(4)
    common, rare = ["the", "of", "and", "to"], [f"q{chr(97 + k)}{chr(97 + j)}" for k in range(12) for j in range(5)]
    hits = [f"u{k}@mail{k % 3}.example.com" for k in range(20)] + [f"10.{k % 4}.7.{k}" for k in range(20)]
    texts = []
    for k in range(160):
        words = [made.choice(common if made.random() < 0.6 else rare) for _ in range(6)]
        if k % 3 == 0:
            hit = hits[k % len(hits)]
            words.insert(3, hit)
            words[2] = f"near{'mail' if '@' in hit else 'net'}" if k % 2 else words[2]
        texts.append(" ".join(words))
    texts += texts[:30]  # copies count once

    def entities(hit):
        if "@" in hit:
            return [f"value:email:{hit}", f"group:email:{hit.split('@')[1]}", "kind:email"]
        return [f"value:ip:{hit}", f"group:ip:{'.'.join(hit.split('.')[:2])}", "kind:ip"]

    held, met, occurs = defaultdict(set), defaultdict(set), defaultdict(set)
    for text in set(texts):
        found = re.search(r"\S+@\S+|\d+\.\d+\.\d+\.\d+", text)
        for term in set(re.findall(r"[^\W\d_]{2,}", text)):
            occurs[term].add(text)
        if found:
            around = text[: found.start()] + " " + text[found.end() :]
            for entity in entities(found.group()):
                held[entity].add(text)
                for term in re.findall(r"[^\W\d_]{2,}", around):
                    met[term, entity].add(text)
    n, want = len(set(texts)), {}
    for (term, entity), where in met.items():
        if len(where) >= 2:
            a, b, c = len(occurs[term]), len(held[entity]), len(where)
            share = math.log2(c * n / (a * b)) / math.log2(n / b)
            if share >= 0.5:
                want[term, entity] = share >= 0.9
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], DOCS)
    assert len(want) > 5 and len(set(want.values())) == 2
    shown = {}
    for text in set(texts):
        found = re.search(r"\S+@\S+|\d+\.\d+\.\d+\.\d+", text)
        if found:
            shown[text] = sum(
                any((m.group(), e) in want for e in entities(found.group()))
                for m in re.finditer(r"[^\W\d_]{2,}", text)
                if m.end() <= found.start() or m.start() >= found.end()
            )
    got = {r.doc_id: r.n_terms for r in find_private(docs).collect()}
    assert got == {i: shown.get(t, 0) for i, t in enumerate(texts)}


def test_many_ranges_cost_little_more_than_few(spark):
    import time

    from pyspark.sql import functions as F

    from blobframe.llm.fingerprints import range_of

    ids = spark.range(0, 200_000, 1, 4).withColumnRenamed("id", "doc_id")
    seconds = {}
    for n in (10, 10_000):
        bounds = [k * 200_000 // n for k in range(1, n)]
        placed = ids.select("doc_id", range_of(bounds).alias("r"))
        want = F.ceil(F.col("doc_id") * n / F.lit(200_000)) - 1
        assert placed.where(F.col("r") != F.greatest(want, F.lit(0))).isEmpty()
        begin = time.perf_counter()
        placed.agg(F.sum("r")).collect()
        seconds[n] = time.perf_counter() - begin
    assert seconds[10_000] < 6 + 5 * seconds[10]


def test_fingerprints_are_signed_votes(spark):
    """Every vote recounted: bits of the hashes of all runs of five words, as often as they occur."""
    from pyspark.sql import functions as F

    words = "a b c d e f g a b c d e f g x y a b c d e".split()
    texts = [" ".join(words), "one two", "", "lone"]
    rows = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], DOCS)
    got = {r.doc_id: int(r.fingerprint, 16) for r in document_fingerprints(rows).collect()}
    for i, text in enumerate(texts):
        split = text.split()
        runs = [split[j : j + 5] for j in range(max(1, len(split) - 4))] if split else []
        want = 0
        if runs:
            columns = [F.xxhash64(*[F.lit(w) for w in run], *[F.lit(None).cast("string")] * (5 - len(run))) for run in runs]
            hashes = [h % (1 << 64) for h in spark.range(1).select(*columns).first()]
            for bit in range(64):
                ones = sum(h >> bit & 1 for h in hashes)
                want |= (2 * ones > len(hashes)) << bit
        assert got[i] == want, i


def test_a_million_shards_do_not_ride_on_documents(spark):
    from blobframe.llm.mixing import choose_copies

    rows = [(i, f"s{i % 3}", 10 + i % 7) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, size long")
    mixed = choose_copies(docs, shards=1 << 20)
    got = mixed.collect()
    assert set(mixed.columns) == {"doc_id", "source", "size", "source_size", "target", "copies"}
    taken = sum(r["size"] * len(r.copies) for r in got)
    assert abs(taken - 1.5 * sum(s for *_, s in rows)) < 0.2 * taken
    assert all(0 <= c.shard < 1 << 20 for r in got for c in r.copies)


def test_clashing_columns_of_the_mix(spark):
    from blobframe.llm.mixing import choose_copies, mix_sources

    odd = ", _h int, _none int, blocks int, quota int, cuts int, _row int, rank int, `a.b` int, slice int"
    docs = spark.createDataFrame(
        [(i, "s", 5, 1, 2, 3, 4, 5, 6, 7, 8, 9) for i in range(20)],
        "doc_id long, source string, size long" + odd,
    )
    for r in choose_copies(docs).collect():
        assert tuple(r)[3:12] == (1, 2, 3, 4, 5, 6, 7, 8, 9)
    mixed = mix_sources(docs)
    assert mixed.columns == [*docs.columns, "shard"]
    assert all(tuple(r)[3:12] == (1, 2, 3, 4, 5, 6, 7, 8, 9) for r in mixed.collect())


def test_words_anywhere_in_a_text_disclose_its_values(spark):
    """Far from the value, beyond another value, and in a text of its own copies."""
    far = "lorem ipsum " * 30
    rows = [(i, f"Zorblatt {far}{i} ann@corp.org x bob@corp.org {far}{i} Quuxly", "s") for i in range(6)]
    rows += [(10, rows[0][1], "s")]
    rows += [(100 + i, f"{far} {i}", "s") for i in range(60)]
    got = {r.doc_id: r for r in find_private(spark.createDataFrame(rows, DOCS)).collect()}
    for i, text, _ in rows[:7]:
        end = text.index("Quuxly")
        assert got[i].n_terms == 2 and got[i].n_email == 2
        assert got[i].spans.startswith("term:0:8,email:") and got[i].spans.endswith(f",term:{end}:{end + 6}")
    assert {got[100 + i].spans for i in range(60)} == {""}
