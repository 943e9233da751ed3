"""Nearest neighbours against brute force."""

import numpy as np
import pytest

from bantin.llm import neighbours as N


def brute(rows, every=50, k=5):
    size = 4 if rows and len(rows[0][1] or []) == 4 else None
    items = [(i, np.array(v, float)) for i, v in rows if i is not None and v and None not in v and (size is None or len(v) == size)]
    items = [(i, v) for i, v in items if np.isfinite(v).all() and v.any()]
    out = []
    for q in sorted({i for i, _ in items if i % every == 0}):
        best = {}
        for own in (v for i, v in items if i == q):
            for i, v in items:
                if i != q:
                    s = (v * own).sum() / (np.sqrt((v * v).sum()) * np.sqrt((own * own).sum()))
                    best[i] = max(best.get(i, -2), s)
        for rank, (s, i) in enumerate(sorted((-s, i) for i, s in best.items())[:k], 1):
            out.append((q, rank, i, round(-s, 9)))
    return out


def plain(df):
    return sorted((r.query_id, r.rank, r.vec_id, round(r.score, 9)) for r in df.collect())


def test_odd_rows_exactly(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=4).round(3).tolist()) for i in range(120)]
    rows += [(i, [1.0, 2.0, 3.0, 4.0]) for i in range(200, 230)]  # one hot vector: ties
    rows += [(300, None), (350, []), (400, [0.0] * 4), (450, [1.0, None, 0.0, 0.0]), (500, [float("nan"), 1.0, 1.0, 1.0]), (550, [float("inf"), 1.0, 1.0, 1.0])]
    rows += [(None, [1.0, 1.0, 1.0, 1.0]), (600, [1.0, 2.0]), (200, [1.0, 2.0, 3.0, 4.0]), (7, [4.0, 3.0, 2.0, 1.0])]
    frame = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<double>, id long, part int").repartition(3)
    assert plain(N.nearest(frame)) == brute(rows)
    few = rows[:3] + [(50, [1.0, 0.0, 0.0, 0.0])]
    assert plain(N.nearest(spark.createDataFrame(few, "vec_id long, embedding array<double>"))) == brute(few)
    assert N.nearest(frame.limit(0)).collect() == []


@pytest.mark.parametrize("blocks", [False, True])
def test_recall_in_parts(spark, monkeypatch, blocks):
    if blocks:
        monkeypatch.setattr(N, "_BLOCK_ROWS", 40)
        monkeypatch.setattr(N, "_BLOCK_QUERIES", 7)
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(30, 16))
    x = np.concatenate([centres[rng.integers(0, 30, 2500)] + 0.4 * rng.normal(size=(2500, 16)), np.tile(centres[0], (1200, 1))])
    rows = list(enumerate(x.tolist()))
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    got = N.nearest(frame, sample=1024, parts=8)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    hits, found = 0, got.collect()
    by = {}
    for r in found:
        by.setdefault(r.query_id, []).append(r)
    assert set(by) == set(range(0, len(x), 50))
    for q, rs in by.items():
        s = unit @ unit[q]
        s[q] = -9
        least = np.sort(s)[-5]
        assert len(rs) == 5 and sorted(r.rank for r in rs) == [1, 2, 3, 4, 5]
        for r in rs:
            assert abs(s[r.vec_id] - r.score) < 1e-12
            hits += r.score >= least - 1e-12
    assert hits / (5 * len(by)) >= 0.9


def test_parts_are_balanced():
    rng = np.random.default_rng(3)
    x = N._unit(np.concatenate([rng.normal(size=(300, 8)), 3 + rng.normal(size=(900, 8))]))
    label = N.balanced_parts(x, N.neighbour_graph(x, 10), 6)
    assert np.bincount(label, minlength=6).max() <= np.ceil(1.1 * 200)


@pytest.mark.parametrize("folder", ["sf0.01", "sf0.1"])
def test_recall_of_the_query(spark, folder):
    rows = N.op7_nearest_neighbours(spark, f"/root/testdata/{folder}").collect()
    t = spark.read.parquet(f"/root/testdata/{folder}/embeddings.parquet").collect()
    x, ids = np.array([r.embedding for r in t], float), np.array([r.vec_id for r in t])
    x = N._unit(x)
    hits = 0
    for r in rows:
        s = x @ x[np.flatnonzero(ids == r.query_id)[0]]
        s[ids == r.query_id] = -9
        hits += r.score >= np.sort(s)[-5] - 1e-9
    assert len(rows) == 5 * (ids % 50 == 0).sum() and hits / len(rows) >= 0.9
