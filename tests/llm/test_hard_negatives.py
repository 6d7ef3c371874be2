import math
import random

import numpy as np
import pytest

from tidemill.llm import hard_negatives as m
from tidemill.llm.hard_negatives import ANSWER, Cells, directions, hard_negatives, scores_of, stretch


def brute(rows, every=100, positives=5, negatives=10):
    seen = {}
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        row = (label, [math.floor(256 * float(x)) for x in v])
        seen[i] = min(row, seen.get(i, row))
    out = []
    dot = lambda a, b: sum(x * y for x, y in zip(a, b, strict=False))
    for i, (label, v) in seen.items():
        if i % every:
            continue
        scored = sorted((-dot(v, w), j, other) for j, (other, w) in seen.items() if j != i)
        for score, j, other in [s for s in scored if s[2] == label][:positives]:
            fits = [s for s in scored if s[2] != label and 30 * -score <= 100 * -s[0] <= 90 * -score]
            out += [(i, j, r, n, -score, -s) for r, (s, n, _) in enumerate(fits[:negatives], 1)]
    return sorted(out)


SCHEMA = "vec_id long, embedding array<float>, label int"


def vectors(count=900, size=12, seed=1, clusters=6):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(clusters, size))
    rows = []
    for i in range(count):
        v = centers[i % clusters] + rng.normal(size=size) * rng.choice([0.2, 1.0])
        v = (v * rng.choice([0.3, 1.0, 2.0])).astype(np.float32)
        rows.append((i, [float(x) for x in v], int(rng.choice(4, p=[0.55, 0.2, 0.15, 0.1]))))
    return rows


def result(spark, rows, schema=SCHEMA, **options):
    df = spark.createDataFrame(rows, schema) if isinstance(rows, list) else rows
    return sorted(map(tuple, hard_negatives(spark, df, **options).collect()))


@pytest.mark.parametrize("block_bytes", [32 << 20, 256 * 12 * 8])
def test_equals_brute_force(spark, monkeypatch, block_bytes):
    monkeypatch.setattr(m, "BLOCK_BYTES", block_bytes)
    rows = vectors()
    want = brute(rows, every=20)
    assert len(want) > 500 and result(spark, rows, every=20) == want


def test_ties_and_one_common_vector(spark):
    rows = vectors(300, 5, 2)
    same = [0.5, 0.25, -0.5, 1.0, 0.0]
    rows = [(i, same if i % 3 == 0 else v, label) for i, v, label in rows]
    rows += [(1000 + i, [0.25, 0.0, 0.0, 0.25, 0.0], i % 2) for i in range(60)]
    assert result(spark, rows, every=25) == brute(rows, every=25)


def test_odd_rows(spark):
    rows = vectors(120, 4, 3) + [
        (None, [1.0, 1.0, 1.0, 1.0], 1),
        (200, None, 1),
        (300, [1.0, None, 1.0, 1.0], 1),
        (400, [1.0, float("nan"), 1.0, 1.0], 1),
        (500, [1.0, float("inf"), 1.0, 1.0], 1),
        (600, [1.0, 1.0, 1.0, 1.0], None),
        (700, [1.0, 1.0], 1),
        (800, [], 0),
        (900, [0.0, 0.0, 0.0, 0.0], 2),
        (1000, [1.0, 1.0, 1.0, 1.0, 2.0], 1),
        (-100, [1.0, 0.5, 1.0, 1.0], 1),
        (20, [9.0, 9.0, 9.0, 9.0], 3),
        (20, [9.0, 9.0, 9.0, 9.0], 3),
    ]
    docs = spark.createDataFrame(rows, SCHEMA)
    for name in ("cell", "block", "v", "row", "norm", "angle", "ask", "low", "id", "score", "rank"):
        docs = docs.selectExpr("*", f"'other' AS {name}")
    assert result(spark, docs, every=20) == brute(rows, every=20)


def test_empty_table_and_lone_anchor(spark):
    assert result(spark, spark.createDataFrame([], SCHEMA)) == []
    assert result(spark, [(100, [1.0, 2.0], 1), (3, [1.0, 1.0], 2)]) == []


def test_large_components_stay_exact(spark):
    rng = random.Random(4)
    rows = [(i, [rng.uniform(-1, 1) * 10.0 ** rng.randint(3, 6) for _ in range(6)], i % 2) for i in range(150)]
    assert result(spark, rows, "vec_id long, embedding array<double>, label int", every=30) == brute(rows, every=30)
    huge = [(i, [1e300 * (1 + i)], i % 2) for i in range(4)]
    assert {r[-1] for r in result(spark, huge, "vec_id long, embedding array<double>, label int", every=2)} <= {m.MOST}


def test_scores_are_integers_whatever_their_size():
    a, b = np.array([[2**40 + 1, 3]]), np.array([[2**20 + 1, -5], [1, 1]])
    assert scores_of(a, b).tolist() == [[(2**40 + 1) * (2**20 + 1) - 15, 2**40 + 4]]
    assert scores_of(a * 2**20, b * 2**20).tolist()[0][0] == m.MOST


def test_bounds_hold_every_score():
    rng = np.random.default_rng(5)
    rows, anchors = rng.integers(-300, 300, (400, 8)), rng.integers(-300, 300, (30, 8))
    fixed = directions(rows, 5)
    angles = lambda v: np.arccos(np.clip(v @ fixed.T / np.linalg.norm(v, axis=1)[:, None], -1, 1)).astype(np.float32)
    theirs, own, lengths = angles(rows), angles(anchors), np.linalg.norm(rows, axis=1)
    cell = theirs.argmin(axis=1)
    counted = Cells(
        np.bincount(cell, minlength=5),
        np.array([(lengths[cell == c].min(), lengths[cell == c].max()) for c in range(5)]),
        np.array([np.column_stack([theirs[cell == c].min(axis=0), theirs[cell == c].max(axis=0)]) for c in range(5)]),
    )
    norm = np.linalg.norm(anchors, axis=1)
    low, high = counted.bounds(norm, own.astype(np.float64))
    scores = scores_of(anchors, rows)
    assert (scores >= low[:, cell]).all() and (scores <= high[:, cell]).all()
    for least, most in ((-(10**9), 10**9), (20_000, 60_000), (-60_000, -20_000), (-5_000, 5_000)):
        for r in range(5):
            mine = theirs[:, r].astype(np.float64)
            window = np.full(30, float(least)), np.full(30, float(most))
            begin, end = stretch(norm, own[:, r].astype(np.float64), *window, lengths.min(), lengths.max())
            fits = (scores >= least) & (scores <= most)
            assert (~fits | ((mine >= begin[:, None]) & (mine <= end[:, None]))).all()


def test_clustered_rows_are_not_all_scored(spark):
    """Anchors reach few cells once their windows are known."""
    rng = np.random.default_rng(6)
    centers = np.eye(16)[:8]
    rows = [(i, [float(x) for x in centers[i % 8] + rng.normal(size=16) * 0.02], i % 16) for i in range(1600)]
    measured, cells, _, _ = m.with_angles(spark, spark.createDataFrame(rows, SCHEMA))
    some = measured.limit(50).toPandas()
    norm, angles = some["norm"].to_numpy(), np.array(some["angles"].tolist(), np.float64)
    _, high = cells.bounds(norm, angles)
    assert ((high >= 0.5 * 65536) & (cells.rows > 0)).sum(axis=1).mean() < 6
    assert ANSWER.startswith("anchor_id")
