"""Merge, ranking and snapshot operators, also with one video holding most rows."""

import random
from collections import defaultdict

import pytest

from reelgauge.operators import joins
from reelgauge.operators import merge as M
from reelgauge.operators import ranking as R
from reelgauge.operators import snapshots as P

SCHEMA = "video_key string, author string, text string, published_at string, arrival_seq bigint"


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA)


@pytest.fixture
def previous(spark):
    return frame(spark, [
        ("a", "ann", "hi", "2025-01-02T00:00:00Z", 0), ("a", "bob", "yo", "2025-01-01T00:00:00Z", 1),
        ("gone", "cy", "x", "2025-01-01T00:00:00Z", 0), ("fail", "di", "x", "2025-01-01T00:00:00Z", 0),
    ])


@pytest.fixture
def new(spark):
    return frame(spark, [
        ("a", "ann", "hi", "2025-01-01T23:59:59Z", 10), ("a", "ann", "hi", "2025-01-02T00:00:00Z", 11),
        ("a", "ann", "hi", "2025-01-02T00:00:01Z", 12), ("b", "eve", "x", "2020-01-01T00:00:00Z", 13),
    ])


def test_only_strictly_newer_rows_are_added_and_nothing_is_deduplicated(previous, new, rows):
    merged = M.merge_comments(previous, new)
    assert rows(merged, "video_key", "arrival_seq", "is_new") == [
        ("a", 0, False), ("a", 1, False), ("a", 2, True), ("b", 0, True),
        ("fail", 0, False), ("gone", 0, False),
    ]
    assert rows(M.merge_counts(merged)) == [
        ("a", 3, 1), ("b", 1, 1), ("fail", 1, 0), ("gone", 1, 0),
    ]


def test_merging_the_same_batch_again_adds_nothing(previous, new):
    once = M.merge_comments(previous, new).drop("is_new")
    assert M.merge_comments(once, new).where("is_new").count() == 0


def test_listed_and_failed_videos(spark, previous, new, rows):
    listed = spark.createDataFrame([("a",), ("fail",), ("a",)], "video_key string")
    failed = spark.createDataFrame([("fail",)], "video_key string")
    carried = M.merge_comments(previous, new, listed, failed)
    assert {r[0] for r in rows(carried)} == {"a", "fail"}
    dropped = M.merge_comments(previous, new, listed, failed, on_missing="drop")
    assert {r[0] for r in rows(dropped)} == {"a"}
    assert {r[0] for r in rows(M.of_unlisted_videos(previous, listed))} == {"gone"}
    with pytest.raises(ValueError):
        M.merge_comments(previous, new, on_missing="other")


def test_marks_ignore_missing_times(spark, rows):
    data = [("a", "x", "t", None, 0), ("a", "x", "t", "2025", 1), ("b", "x", "t", None, 0)]
    marks = M.high_water_marks(frame(spark, data))
    assert rows(marks) == [("a", "2025"), ("b", "")]
    fresh = M.newer_than_mark(frame(spark, [("b", "x", "t", "2001", 5)]), marks)
    assert fresh.count() == 1


def skewed(seed, n=4000):
    """Rows with a third in one video, many equal times, hours and seconds."""
    pick = random.Random(seed)
    data = []
    for i in range(n):
        key = "hot" if pick.random() < 0.34 else f"v{pick.randrange(40)}"
        hour = 12 if pick.random() < 0.7 else pick.randrange(24)
        time = f"2025-01-0{pick.randrange(1, 4)}T{hour:02d}:00:{pick.randrange(3):02d}"
        time = None if pick.random() < 0.02 else time + pick.choice(["Z", ".5Z", ""])
        data.append((key, "a", "t", time, i * 7 - 900))
    return data


@pytest.mark.parametrize("cap", [1, 5, 60, 900, 5000])
@pytest.mark.parametrize("bits", [3, 18])
def test_newest_per_key_equals_a_sort(spark, rows, cap, bits):
    data = skewed(cap)
    by_key = defaultdict(list)
    for r in data:
        by_key[r[0]].append(r)
    want = []
    for group in by_key.values():
        order = sorted(group, key=lambda r: r[4])
        want += sorted(order, key=lambda r: r[3] or "", reverse=True)[:cap]
    got = R.newest_per_key(frame(spark, data), cap, block_bits=bits)
    assert rows(got) == sorted(want, key=repr)


@pytest.mark.parametrize("bits", [0, 4, 18])
def test_row_index_equals_enumeration(spark, rows, bits):
    data = skewed(1)
    want, seen = [], defaultdict(int)
    for r in sorted(data, key=lambda r: r[4]):
        want.append((r[0], r[4], seen[r[0]]))
        seen[r[0]] += 1
    got = R.with_row_index(frame(spark, data), block_bits=bits)
    assert rows(got, "video_key", "arrival_seq", "row_index") == sorted(want, key=repr)
    page = R.index_page(got, 10, 5)
    assert rows(page.where("video_key = 'hot'"), "row_index") == [(i,) for i in range(10, 15)]


def test_lookup_join_is_the_same_beyond_the_broadcast_limit(spark, rows):
    big = frame(spark, skewed(2))
    small = spark.createDataFrame([("hot", 1), ("v3", 2), ("none", 3)], "video_key string, n int")
    for how in ("inner", "left", "left_semi", "left_anti"):
        near = joins.join_lookup(big, small, "video_key", how)
        far = joins.join_lookup(big, small, "video_key", how, limit_bytes=0)
        assert rows(near) == rows(far)


def test_kept_lookups_are_released(spark, previous, new):
    spark.catalog.clearCache()
    with joins.release_after():
        M.merge_comments(previous, new, cap=1).count()
        assert spark.sparkContext._jsc.getPersistentRDDs().size() > 0
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == 0


def test_measured_bytes_counts_contents(spark):
    one = spark.createDataFrame([("ab", [1.0, 2.0], [[1.0], [2.0, 3.0]])], "s string, a array<double>, n array<array<double>>")
    size = joins.measured_bytes(one)
    assert size == 32 + 2 + 16 + 24
    assert joins.measured_bytes(one.union(one)) == 2 * size
    assert joins.measured_bytes(one.limit(0)) == 0


def test_snapshots(spark, rows):
    data = spark.createDataFrame(
        [("20250101_000000", 1), ("20250103_000000", 2), ("20250102_000000", 3), ("20250103_000000", 4)],
        "snapshot string, n int",
    )
    assert rows(P.latest_snapshot(data), "n") == [(2,), (4,)]
    assert rows(P.keep_latest(data, 2), "n") == [(2,), (3,), (4,)]
    assert rows(P.pinned_snapshot(data, "20250101_000000"), "n") == [(1,)]
    assert P.latest_snapshot(data.limit(0)).count() == 0
    assert rows(P.snapshots(data))[-1] == ("20250103_000000", 2)


def test_comments_at_the_time_of_the_mark(spark, rows):
    old = frame(spark, [("v", "a", "x", "2025", 0), ("v", "a", "x", "2025", 1), ("v", "b", "y", "2024", 2), ("w", "a", "x", None, 0)])
    new = frame(spark, [
        ("v", "a", "x", "2025", 0), ("v", "a", "x", "2025", 1), ("v", "a", "x", "2025", 2), ("v", "c", "x", "2025", 3),
        ("v", "b", "y", "2024", 4), ("v", None, "x", "2025", 5), ("v", "x", None, "2025", 6), ("w", "a", "x", None, 0), ("w", "n", "x", None, 1), ("n", "a", "x", "2020", 0),
    ])
    once = M.merge_comments(old, new, equal_times="compare")
    added = rows(once.where("is_new"), "video_key", "author", "text", "arrival_seq")
    assert added == sorted([("v", "a", "x", 3), ("v", "c", "x", 4), ("v", None, "x", 5), ("v", "x", None, 6), ("w", "n", "x", 1), ("n", "a", "x", 0)], key=repr)
    again = M.merge_comments(once.drop("is_new"), new, equal_times="compare")
    assert again.where("is_new").count() == 0 and again.count() == once.count()
