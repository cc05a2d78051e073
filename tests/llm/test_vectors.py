"""Near-duplicate vectors against all pairs of a label."""

from __future__ import annotations

import math

import numpy as np
import pytest

from tripwright.llm import vectors
from tripwright.llm.vectors import count_needed, near_vectors, plan_of

DDL = "vec_id long, embedding array<double>, label int, key string, team string, n long"


def brute(rows, cosine=0.98):
    fit = {}
    for k, (_, v, label) in enumerate(rows):
        if label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            x = np.array(v) / np.abs(v).max()
            fit[k] = (label, x / np.linalg.norm(x))
    near = {k: set() for k in range(len(rows))}
    keys = sorted(fit)
    for i in keys:
        for j in keys:
            if i < j and fit[i][0] == fit[j][0] and len(fit[i][1]) == len(fit[j][1]) and fit[i][1] @ fit[j][1] >= cosine:
                near[i].add(j)
                near[j].add(i)
    out = []
    for k, (vec_id, *_) in enumerate(rows):
        seen, todo = {k}, [k]
        while todo:
            for j in near[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        least = min(ids, default=None)
        out.append((vec_id, len(near[k]), least, vec_id is not None and vec_id == least))
    return sorted(out, key=str)


def found(spark, rows, **more):
    df = spark.createDataFrame([(*r, "k", "t", 1) for r in rows], DDL).repartition(5)
    return sorted((tuple(r) for r in near_vectors(df, **more).collect()), key=str)


def families(seed, dimension, n=40, noise=0.1):
    draw = np.random.default_rng(seed)
    rows = []
    for k in range(n):
        base = draw.standard_normal(dimension)
        for _ in range(int(draw.integers(1, 7))):
            own = base + noise * float(draw.random()) * draw.standard_normal(dimension)
            rows.append((len(rows) * 3 % 101 + 7 * k, (own * float(draw.choice([1, 40]))).tolist(), k % 3))
    return rows


ODD = [
    (500, None, 1), (501, [], 1), (502, [0.0] * 8, 1), (503, [1.0, None] * 4, 1), (504, [float("nan")] * 8, 1),
    (505, [float("inf")] + [1.0] * 7, 1), (506, [1.0] * 8, None), (507, [1.0] * 8, 1), (507, [1.0] * 8, 1), (None, [1.0] * 8, 1),
    (508, [3.0] * 8, 1), (509, [1.0] * 7, 1), (510, [1e300] * 8, 1), (511, [1e-300] * 8, 1), (512, [-1.0] * 8, 1), (None, [2.0, -1.0] * 4, 2),
    (513, [1.0], 1), (514, [5.0], 1), (515, [-1.0], 1), (516, [0.0, 1.0], 1), (517, [-0.0, 1.0], 1),
]


@pytest.mark.parametrize(("seed", "dimension"), [(1, 8), (2, 64), (3, 2)])
def test_equals_all_pairs(spark, seed, dimension):
    rows = families(seed, dimension) + ODD
    assert found(spark, rows) == brute(rows)


def test_cells_tables_and_blocks_give_the_same(spark, monkeypatch):
    """A label large enough for cells, a cell large enough for blocks."""
    draw = np.random.default_rng(4)
    base = draw.standard_normal(16)
    rows = families(5, 16, n=60) + [(2000 + k, (base + 0.08 * draw.standard_normal(16)).tolist(), 0) for k in range(70)]
    rows += [(3000 + k, base.tolist(), 0) for k in range(30)]
    assert plan_of(50_000)[0] > 3

    def shallow(n):
        return (2, 12) if n > 20 else (0, 1)

    # Python workers read the module anew, so the plan is changed where the driver sends it from.
    monkeypatch.setattr(vectors, "plan_of", shallow)
    assert found(spark, rows, block=16) == brute(rows)


def test_recall_right_at_the_cosine(spark):
    """Pairs a hair above the cosine, in a label of many cells: nearly all are found, none below."""
    draw = np.random.default_rng(6)
    rows = []
    for k in range(3000):
        u, w = draw.standard_normal((2, 24))
        u /= np.linalg.norm(u)
        w -= (w @ u) * u
        w /= np.linalg.norm(w)
        cosine = 0.9801 if k % 2 else 0.9799
        rows += [(2 * k, u.tolist(), 0), (2 * k + 1, (cosine * u + math.sqrt(1 - cosine**2) * w).tolist(), 0)]
    got = found(spark, rows)
    linked = {r[0] for r in got if r[1]}
    above = {x for k in range(1, 3000, 2) for x in (2 * k, 2 * k + 1)}
    assert linked <= above and len(linked) >= 0.998 * len(above)


def test_needed_counts_are_calibrated():
    assert all(1 <= count_needed(dimension) < vectors.DIRECTIONS for dimension in (2, 16, 64))
    depth, tables = plan_of(10**9)
    assert depth > plan_of(10**6)[0] and tables < 100


def test_empty_table(spark):
    assert found(spark, []) == []
