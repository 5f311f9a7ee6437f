import numpy as np
import pytest

from incidentflow.llm import mtree


def brute(rows, k=10):
    whole = {(i, tuple(int(np.floor(1024 * float(np.float32(x)))) for x in v)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v)}
    out = []
    for q, qv in whole:
        if q % 100 == 0:
            best = sorted((-sum(a * b for a, b in zip(qv, v)), i) for i, v in whole if i != q and len(v) == len(qv))[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    return sorted(out)


@pytest.mark.parametrize("pages, blocks", [(4096, 4096), (60, 2)])
def test_search_equals_brute_force(spark, pages, blocks):
    pick = np.random.default_rng(5)
    rows = [(i, pick.normal(0, 1, 8).astype(np.float32).tolist()) for i in range(700)]
    rows += [(1000 + i, rows[7][1]) for i in range(400)]  # a very common vector: ties go to the smaller id
    rows += [(2000, None), (2001, [1.0] * 3), (2100, [0.5] * 3), (2002, [None] * 8), (2003, [float("nan")] * 8), (2004, [float("inf")] * 8), (None, [1.0] * 8), (2005, []), (5, rows[5][1])]
    vectors = mtree.integer_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    got = mtree.top_k(vectors, vectors.where("id % 100 = 0"), page_rows=pages, query_rows=blocks)
    assert sorted(map(tuple, got.collect())) == brute(rows)


def test_bounds_spare_distances(monkeypatch):
    pick = np.random.default_rng(1)
    centers = pick.normal(0, 3000, (20, 16))
    points = np.concatenate([c + pick.normal(0, 20, (200, 16)) for c in centers]).astype(np.int64)
    tree = mtree.MTree(np.arange(len(points)), points)
    seen = []
    real = mtree.np.lexsort
    monkeypatch.setattr(mtree.np, "lexsort", lambda keys: (seen.append(len(keys[0])), real(keys))[1])
    tree.search(-1, points[5], 10)
    assert sum(seen) < len(points) / 2


def test_nothing_to_search(spark):
    vectors = mtree.integer_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>"))
    assert mtree.top_k(vectors, vectors).count() == 0
    one = mtree.integer_vectors(spark.createDataFrame([(100, [1.0, 2.0])], "vec_id long, embedding array<float>"))
    assert mtree.top_k(one, one).count() == 0
