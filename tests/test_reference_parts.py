"""Paging by index, retention, time widths, coherence."""

import itertools
import math

import numpy as np
from pyspark.sql import functions as F

from reelgauge import jobs
from reelgauge.functions.values import iso_width
from reelgauge.operators import ranking as R
from reelgauge.operators.coherence import topic_coherence
from reelgauge.operators.videos import published_within
from reelgauge.schemas import COMMENT_ROW
from reelgauge.sources import comments as C
from reelgauge.sources import parts as PT


def test_pages_by_block_index(spark, tmp_path):
    random = np.random.default_rng(2)
    numbers = {v: sorted(random.choice(5000, 700, replace=False).tolist()) for v in ("a", "b")}
    rows = [("x", "t", 0, "", v, "s", int(n)) for v, all_ in numbers.items() for n in all_]
    root = str(tmp_path / "comments")
    C.write_comments(spark.createDataFrame(rows, COMMENT_ROW), root)
    stored = C.read_comments(spark, root)
    index = R.block_index(stored, block_bits=8)
    for start, size in ((0, 10), (95, 300), (690, 50), (700, 5), (0, 0)):
        page = R.indexed_page(stored, index, "a", start, size, block_bits=8)
        got = sorted((r["row_index"], r["arrival_seq"]) for r in page.collect())
        assert got == list(enumerate(numbers["a"]))[start:start + size]
    assert R.indexed_page(stored, index, "none", 0, 5).count() == 0
    page = R.indexed_page(stored, index, "a", 95, 3, block_bits=8)
    plan = spark._jvm.PythonSQLUtils.explainString(page._jdf.queryExecution(), "formatted")
    pushed = [line for line in plan.splitlines() if line.startswith("PushedFilters") and "arrival_seq" in line]
    assert any("GreaterThanOrEqual(arrival_seq" in line for line in pushed), plan


def test_retention_deletes_older_snapshots_only(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(jobs, "get_session", lambda name: spark)
    root = tmp_path / "comments"
    for name in ("20250101_000000", "20250102_000000", "20250103_000000"):
        C.write_comments(spark.createDataFrame([("x", "t", 0, "", "v", name, 0)], COMMENT_ROW), str(root))
    (root / "notes").mkdir()
    assert C.drop_older(spark, str(root), 0) == [] and C.drop_older(spark, str(root), 5) == []
    jobs.main(["retain", "--comments", str(root), "--run-id", "x", "--keep", "2"])
    assert sorted(p.name for p in root.iterdir() if p.is_dir()) == ["notes", "snapshot=20250102_000000", "snapshot=20250103_000000"]


def test_times_of_different_width(spark):
    times = ["2025-01-01T00:00:00Z", "2025-01-01T00:00:00.5Z", "2025-01-01T00:00:00.123456789Z", "2025-01", None, "2025-01-01T00:00:00"]
    frame = spark.createDataFrame([(t,) for t in times], "published_at string")
    got = [r[0] for r in frame.select(iso_width("published_at")).collect()]
    assert got == ["2025-01-01T00:00:00.000000Z", "2025-01-01T00:00:00.500000Z", "2025-01-01T00:00:00.123456Z", "2025-01", None, "2025-01-01T00:00:00.000000Z"]
    as_of = F.to_timestamp_ntz(F.lit("2025-01-11 00:00:00"))
    kept = {r[0] for r in published_within(frame, as_of, 10).collect()}
    assert kept == {times[1], times[2]}  # the very second is not after itself


def test_coherence_by_enumeration(spark):
    random = np.random.default_rng(5)
    words = list("abcdefg")
    rows = [("v", i, list(random.choice(words, random.integers(1, 6)))) for i in range(80)] + [("w", 0, ["a", "b"]), ("w", 1, ["a", "b"])]
    topics = [("v", 0, ["c", "a", "b"]), ("v", 1, ["g", "f", "e", "d"]), ("v", 2, ["a"]), ("w", 0, ["b", "a"]), ("v", 3, ["a", "zzz"])]
    got = topic_coherence(
        spark.createDataFrame(rows, "video_key string, arrival_seq bigint, tokens array<string>"),
        spark.createDataFrame(topics, "video_key string, topic int, words array<string>"),
    ).collect()
    want = {}
    for video, topic, terms in topics:
        docs = [set(t) for v, _, t in rows if v == video]
        values = []
        for a, b in itertools.combinations(terms, 2):
            p = [sum(x <= d for d in docs) / len(docs) for x in ({a}, {b}, {a, b})]
            values.append(-1.0 if not p[2] else 1.0 if p[2] == 1 else math.log(p[2] / p[0] / p[1]) / -math.log(p[2]))
        if values:
            want[video, topic] = (sum(values) / len(values), len(values))
    found = {(r["video_key"], r["topic"]): (r["coherence"], r["pairs"]) for r in got}
    assert found.keys() == want.keys()
    assert all(math.isclose(found[k][0], want[k][0], abs_tol=1e-9) and found[k][1] == want[k][1] for k in want)


def test_runs_write_their_additions_only(spark, tmp_path):
    root = str(tmp_path / "c")

    def rows(first, n, video="v"):
        return spark.createDataFrame([("a", f"text {i} " * 20, 0, "", f"{video}{i % 7}", "s", i) for i in range(first, first + n)], COMMENT_ROW)

    def size():
        return sum(p.stat().st_size for p in (tmp_path / "c" / "parts").rglob("*.parquet"))

    def numbers(snapshot=None):
        got = PT.read_snapshot(spark, root, snapshot)
        assert got.columns == COMMENT_ROW.names
        return sorted(r["arrival_seq"] for r in got.collect())

    assert PT.previous_snapshot(spark, root, "r1").count() == 0
    PT.add_snapshot(spark, root, "r1", rows(0, 20_000))
    whole = size()
    PT.add_snapshot(spark, root, "r2", rows(20_000, 200))
    assert size() - whole < 0.05 * whole
    assert numbers() == list(range(20_200)) and numbers("r1") == list(range(20_000))
    assert PT.previous_snapshot(spark, root, "r2").count() == 20_000
    (tmp_path / "c" / "parts" / "unfinished").mkdir()  # a part that no commit names
    dropped = spark.createDataFrame([("v3",)], "video_key string")
    PT.add_snapshot(spark, root, "r3", rows(20_200, 10), dropped)
    assert numbers() == [i for i in range(20_200) if i % 7 != 3] + list(range(20_200, 20_210))
    PT.add_snapshot(spark, root, "r4", rows(20_210, 1), compact_share=0.0)  # compacts
    assert PT.commits(spark, root).where("snapshot = 'r4'").count() == 1
    assert numbers() == [*numbers("r3"), 20_210]
    PT.add_snapshot(spark, root, "r4", rows(20_210, 2))  # the run again
    assert numbers() == [*numbers("r3"), 20_210, 20_211]
