"""Every way to find the first match, against a plain loop."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import blobframe as bf
from blobframe.operators import match as m
from blobframe.sources.archive import INDEX_SCHEMA

WORD = st.text(alphabet="ab.ü", min_size=1, max_size=5)
FILE_NAME = st.text(alphabet="ab.ü", max_size=9)


def index_of(spark, members):
    """Members as (archive, offset, name), the rest of an index row made up."""
    rows = [(a, o, n, 1, 1, 1, 0, 0, 0) for a, o, n in members]
    return spark.createDataFrame(rows, INDEX_SCHEMA)


def by_loop(names, members, match):
    first = {}
    for name in set(names):
        for archive, offset, member in sorted(members):
            if member == name if match == "exact" else member in name:
                first[name] = archive, offset
                break
    return first


def by_spark(spark, names, members, match, **options):
    asked = spark.createDataFrame([(n,) for n in set(names)], "fn string")
    rows = bf.first_match(asked, index_of(spark, members), match, **options).collect()
    assert len(rows) == len({row.fn for row in rows})
    return {row.fn: (row.place.archive, row.place.offset) for row in rows}


BRANCHES = {
    "index is broadcast": {},
    "pieces are broadcast": {"between": True},
    "both are shuffled": {"broadcast_bytes": 0},
}


def options_for(branch, members):
    options = dict(BRANCHES[branch])
    if options.pop("between", False):
        # Just too little for the index, which has been padded, and enough for the pieces.
        options["broadcast_bytes"] = len(members) * m.ROW_OVERHEAD
    return options


@pytest.mark.parametrize("branch", BRANCHES)
@pytest.mark.parametrize("match", ["contains", "exact"])
@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(words=st.lists(WORD, min_size=1, max_size=12), names=st.lists(FILE_NAME, min_size=1, max_size=8))
def test_first_match_is_what_a_loop_finds(spark, branch, match, words, names):
    members = [(f"z{i % 3}", i, word) for i, word in enumerate(words)]
    if branch == "pieces are broadcast":
        members += [("zz", i, f"no such name {i}") for i in range(300)]
    found = by_spark(spark, names, members, match, **options_for(branch, members))
    assert found == by_loop(names, members, match)


@pytest.mark.parametrize("branch", ["index is broadcast", "both are shuffled"])
@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(words=st.lists(WORD, min_size=1, max_size=12), names=st.lists(FILE_NAME, min_size=1, max_size=8))
def test_looking_up_beginnings_first_finds_the_same(spark, monkeypatch, branch, words, names):
    monkeypatch.setattr(m, "LENGTHS_PER_ANCHOR", 0)
    members = [(f"z{i % 3}", i, word) for i, word in enumerate(words + ["", "aba" * 9])]
    found = by_spark(spark, names, members, "contains", **options_for(branch, members))
    assert found == by_loop(names, members, "contains")


def test_anchors():
    assert m.anchor_lengths([1, 2, 3, 5, 6, 7, 20, 31, 32]) == [1, 2, 5, 20, 32]
    assert m.anchor_lengths([0, 9]) == [0, 9]


def test_beginnings_leave_few_pieces(spark):
    names = spark.range(500).select(F.concat(F.lit("other-"), F.col("id").cast("string"), F.lit(".dat")).alias("fn"))
    members = [("z", i, f"{'x' * (i % 8)}member-{i}.bin") for i in range(400)]
    index = index_of(spark, members)
    lengths = sorted({len(name) for _, _, name in members})
    anchors = m.anchor_lengths(lengths)
    few = m.likely_pieces(names, m.beginnings(index, anchors), anchors)
    assert len(lengths) > 8 and few.count() == 0
    some = names.select(F.concat("fn", F.lit("-xxmember-10.bin")).alias("fn"))
    assert 0 < m.likely_pieces(some, m.beginnings(index, anchors), anchors).count() < 500 * 20


def test_stream_order_and_archive_order(spark):
    members = [("b", 0, "people"), ("a", 50, "people.csv"), ("a", 90, "people")]
    assert by_spark(spark, ["people.csv.bak"], members, "contains") == {"people.csv.bak": ("a", 50)}
    assert by_spark(spark, ["people"], members, "exact") == {"people": ("a", 90)}


def test_case_matters_and_an_empty_name_matches_all(spark):
    members = [("z", 5, "People"), ("z", 9, "")]
    assert by_spark(spark, ["people", ""], members, "contains") == {"people": ("z", 9), "": ("z", 9)}


def test_empty_index(spark):
    assert by_spark(spark, ["a"], [], "contains") == {}


def test_unknown_way_to_match(spark):
    with pytest.raises(ValueError, match="glob"):
        by_spark(spark, ["a"], [("z", 0, "a")], "glob")


def test_a_name_in_many_archives_is_cut_down_before_the_join(spark):
    """A third of all members bear one name; the join sees one row of it."""
    members = [(f"z{i:05d}", 0, "README") for i in range(2000)] + [("z", i, f"m{i}") for i in range(100)]
    assert by_spark(spark, ["README", "my-README.md"], members, "contains", broadcast_bytes=0) == {
        "README": ("z00000", 0),
        "my-README.md": ("z00000", 0),
    }


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_pair_join_in_any_plan(spark, monkeypatch):
    members = [("z", i, f"member-{i}") for i in range(50)]
    names = spark.createDataFrame([("my member-7",), ("x",)], "fn string")
    for per_anchor in (0, 2):
        monkeypatch.setattr(m, "LENGTHS_PER_ANCHOR", per_anchor)
        for options in ({}, {"broadcast_bytes": 50 * m.ROW_OVERHEAD}, {"broadcast_bytes": 0}):
            plan = plan_of(bf.first_match(names, index_of(spark, members), "contains", **options))
            assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert "SortMergeJoin" in plan
