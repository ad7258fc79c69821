"""Clustering with tightened bounds against plain rounds over all vectors."""

import hashlib

import numpy as np
import pytest

from lossgrid.llm import drift
from lossgrid.llm.common import prepared

VECTORS = "vec_id bigint, embedding array<float>, cluster string, distance int"


def plain(rows):
    """Rows of the result by the definition, in Python integers."""
    kept = []
    for vec_id, x in rows:
        if x is not None and len(x) == 64 and all(v is not None and np.isfinite(v) for v in x):
            kept.append((vec_id, [int(np.floor(64 * float(np.float32(v)))) for v in x]))
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    centers = [q for _, q in order[:16]]

    def nearest(q):
        return min((sum((a - b) ** 2 for a, b in zip(q, c)), i) for i, c in enumerate(centers))

    for _ in range(3):
        groups = {}
        for _, q in kept:
            groups.setdefault(nearest(q)[1], []).append(q)
        for i, members in groups.items():
            centers[i] = [sum(v) // len(members) for v in zip(*members)]
    final = [(vec_id, *nearest(q)[::-1]) for vec_id, q in kept]
    inertia = {}
    for _, i, d in final:
        inertia[i] = inertia.get(i, 0) + d
    total = sum(inertia.values())
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centers]
    return [(v, i, d, inertia[i], total, names[i]) for v, i, d in final]


def found(session, rows):
    df = session.createDataFrame([(i, x, "c", 1) for i, x in rows], VECTORS)
    return [tuple(r) for r in drift.op12(df.repartition(3)).collect()]


@pytest.fixture(scope="module")
def session(spark):
    return prepared(spark)


def test_rows_equal_plain_rounds(session):
    rng = np.random.default_rng(1)
    middles = rng.normal(0, 2, (9, 64))
    rows = [(i, (middles[i % 9] + rng.normal(0, 0.3, 64)).tolist()) for i in range(500)]
    rows += [(600 + i, rows[3][1]) for i in range(80)] + [(5, rows[5][1])] * 2  # copies, and a row repeated
    rows += [(None, rows[8][1]), (700, None), (701, [1.0] * 63), (702, [None, *[1.0] * 63]), (703, [float("nan"), *[1.0] * 63]), (704, [float("inf"), *[0.0] * 63]), (705, [0.0] * 64), (706, [])]
    assert sorted(found(session, rows), key=repr) == sorted(plain(rows), key=repr)


def test_few_and_no_vectors(session):
    few = [(i, [float(i)] * 64) for i in range(5)] + [(9, [0.0] * 64)]
    assert sorted(found(session, few)) == sorted(plain(few))
    assert found(session, [(1, None)]) == []
    assert found(session, []) == []


def test_large_components(session):
    rng = np.random.default_rng(4)
    rows = [(i, (rng.normal(0, 3e5, 64)).tolist()) for i in range(60)]
    assert sorted(found(session, rows)) == sorted(plain(rows))
    with pytest.raises(Exception, match="too large"):
        found(session, [(1, [1e30] * 64)])


def test_loosening_holds_for_all_points_of_a_sphere_and_is_less_than_the_drift():
    rng = np.random.default_rng(6)
    less = 0
    for dims in (2, 3, 8):
        for _ in range(60):
            old = rng.normal(0, 4, (4, dims))
            new = old + rng.normal(0, rng.choice([0.05, 0.5, 4]), old.shape)
            radius = rng.uniform(0.1, 3, 4)
            loose = drift.loosening(old, new, radius)
            way = rng.normal(size=(4000, dims))
            way /= np.linalg.norm(way, axis=1)[:, None]
            for i in range(4):
                points = old[i] + way * radius[i] * np.sqrt(rng.random((4000, 1)))
                lost = np.linalg.norm(points[:, None] - old, axis=2) - np.linalg.norm(points[:, None] - new, axis=2)
                assert (lost.max(axis=0) <= loose[i] + 1e-9).all()
            drifts = np.linalg.norm(new - old, axis=1)
            assert (loose <= drifts * 1.00001 + 1e-12).all()
            less += (loose < 0.9 * drifts).sum()
    assert less > 500
    still = drift.loosening(np.ones((2, 3)), np.ones((2, 3)), np.ones(2))
    assert (still == 0).all()


def test_bounds_spare_scans(session):
    rng = np.random.default_rng(7)
    middles = rng.normal(0, 5, (16, 64))
    rows = [(i, (middles[i % 16] + rng.normal(0, 0.2, 64)).tolist(), "c", 1) for i in range(2000)]
    state, _ = drift.clusters(drift.lattice(session.createDataFrame(rows, VECTORS)))
    assert state.selectExpr("avg(scans)").first()[0] < 3
