"""Hard negatives against all scores."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from colsieve.llm import hard_negatives as hard

SCHEMA = "vec_id long, embedding array<float>, label int"
COLUMNS = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def expected(rows, is_anchor):
    kept = []
    for vec, e, label in rows:
        if label is None or e is None or any(x is None or not math.isfinite(x) for x in e):
            continue
        kept.append((vec, [math.floor(256 * float(np.float32(x))) for x in e], label))
    last = lambda v: (v is None, v or 0)
    out = []
    for a, (av, ae, al) in enumerate(kept):
        if av is None or not is_anchor(av):
            continue
        scored = [(sum(x * y for x, y in zip(ae, e)), v, label) for k, (v, e, label) in enumerate(kept) if k != a]
        scored.sort(key=lambda s: (-s[0], last(s[1])))
        for ps, pv, _ in [s for s in scored if s[2] == al][:5]:
            found = [s for s in scored if s[2] != al and 50 * ps <= 100 * s[0] <= 95 * ps][:3]
            out += [(av, pv, k + 1, nv, ps, ns) for k, (ns, nv, _) in enumerate(found)]
    return sorted(out, key=repr)


def got(df, every=5):
    found = hard.mine(df, F.col("vec_id") % every == 0)
    assert tuple(found.columns) == COLUMNS
    return sorted((tuple(r) for r in found.collect()), key=repr)


def vectors(n, dims=16, seed=3, labels=4):
    rng = np.random.default_rng(seed)
    return [(k, [float(x) for x in (rng.normal(size=dims) + 1).astype(np.float32)], int(rng.integers(labels))) for k in range(n)]


def test_all_windows(spark):
    rows = vectors(300)
    assert got(spark.createDataFrame(rows, SCHEMA)) == expected(rows, lambda v: v % 5 == 0) != []


def test_awkward_rows(spark):
    rows = vectors(60)
    rows += [(None, rows[7][1], 1), (None, rows[8][1], 0), (70, None, 1), (75, rows[3][1], None), (80, [math.nan] * 16, 1),
             (85, [1.0, None] * 8, 1), (90, [math.inf] * 16, 0), (95, [], 0), (100, rows[5][1][:4], 0), (105, rows[6][1] + [9.0], 1)]
    rows += [(10, rows[10][1], rows[10][2])] * 3 + [(200 + k, rows[4][1], k % 3) for k in range(30)]  # repeated rows and a hot vector
    frame = spark.createDataFrame(rows, SCHEMA)
    want = expected(rows, lambda v: v % 5 == 0)
    assert got(frame) == got(frame.repartition(6)) == want
    extra = frame.withColumns({n: F.current_date() for n in ("anchor", "score", "number", "slot", "seg", "rank", "position")})
    assert got(extra) == want


def test_small_segments_and_many_rounds(spark, monkeypatch):
    rows = vectors(200, seed=8)
    monkeypatch.setattr(hard, "SEGMENT_ROWS", 16)
    monkeypatch.setattr(hard, "ANCHOR_BYTES", 16 * 8 * 15)
    assert got(spark.createDataFrame(rows, SCHEMA)) == expected(rows, lambda v: v % 5 == 0)


def test_scores_beyond_doubles(spark):
    rng = np.random.default_rng(1)
    rows = [(k, [float(np.float32(x * 1e5)) for x in rng.normal(size=8) + 2], k % 2) for k in range(40)]
    assert got(spark.createDataFrame(rows, SCHEMA)) == expected(rows, lambda v: v % 5 == 0)


def test_nothing_to_find(spark):
    assert got(spark.createDataFrame([], SCHEMA)) == []
    assert got(spark.createDataFrame([(1, [1.0], 1), (5, [1.0], 2)], SCHEMA)) == []
    assert got(spark.createDataFrame([(5, [0.0], 1), (6, [0.0], 1), (7, [0.0], 2)], SCHEMA)) == [(5, 6, 1, 7, 0, 0)]


@pytest.mark.parametrize("score,window", [(100, (50, 95)), (101, (51, 95)), (0, (0, 0)), (-10, (-5, -10))])
def test_windows(score, window):
    assert hard.window_of(score) == window


def test_bounds_drop_candidates(spark):
    """The bitmap shrinks before the last column is read, and what stays has exact scores."""
    rng = np.random.default_rng(5)
    columns = np.floor(256 * rng.normal(size=(32, 500)))
    segment = hard.Segment({
        "seg": 1, "ids": np.arange(500).tobytes(), "labels": ["a"], "label_at": [0, 500], "columns": [c.tobytes() for c in columns],
        "least": columns.min(1), "most": columns.max(1), "anchors": np.zeros(500, bool).tobytes()})
    vector = np.floor(256 * np.where(np.arange(32) < 4, 4.0, 0.01))
    scan, sizes = hard.Scan(segment, vector, 0, 500), []
    exact = vector @ columns
    for low, high in scan.steps():
        assert (low <= exact[scan.alive]).all() and (exact[scan.alive] <= high).all()
        scan.keep(high >= np.sort(low)[-5])
        sizes.append(len(scan.alive))
    assert sizes[0] < 50 and (scan.score == exact[scan.alive]).all()
