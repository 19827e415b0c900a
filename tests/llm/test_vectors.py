"""Embedding operators against plain versions of all pairs."""

import math

import numpy as np
import pytest

from brute import union_find
from pairloom.llm import embedding_links as L
from pairloom.llm import hard_negatives as H
from pairloom.llm import vectors as V

DDL = "vec_id long, label int, embedding array<double>, node string, vec int"


def rows_of(spark, rows):
    return spark.createDataFrame([(i, label, None if v is None else [None if x is None else float(x) for x in v], "x", 1) for i, label, v in rows], DDL)


def odd_vectors(seed=0, dim=6, n=160):
    """Clusters, copies, scaled copies, ties, other lengths, huge and tiny numbers, nulls and repeated ids."""
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((12, dim))
    rows = [(i, int(rng.integers(3)), (centres[i % 12] + rng.standard_normal(dim) * rng.choice([0.02, 0.2, 0.5])).tolist()) for i in range(n)]
    rows += [(200 + i, 1, rows[5][2]) for i in range(30)] + [(300 + i, 1, [x * 2.0**i for x in rows[5][2]]) for i in range(5)]
    rows += [(400, 1, [1e200] * dim), (401, 1, [1e-200] * dim), (402, 1, [1e200] * (dim - 1) + [-1e200])]
    rows += [(500, 1, None), (501, 1, [0.0] * dim), (502, 1, [math.nan] * dim), (503, 1, [math.inf] * dim), (504, 1, [None] * dim), (505, 1, [])]
    rows += [(506, None, rows[5][2]), (507, 1, [1.0, 0.0]), (508, 1, [1.0, 0.01]), (None, 1, rows[5][2]), (None, 2, [0.5] * dim)]
    return rows + [(7, 1, rows[9][2]), (8, rows[8][1], rows[8][2]), (8, rows[8][1], rows[8][2])]


def plain_links(rows, threshold):
    def usable(label, v):
        return label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)

    def unit(v):
        top = max(map(abs, v))
        v = [x / top for x in v]
        return np.array(v) / math.sqrt(sum(x * x for x in v))

    units = [unit(v) if usable(label, v) else None for _, label, v in rows]
    links = {k: [] for k in range(len(rows))}
    for a in range(len(rows)):
        for b in range(a):
            fits = units[a] is not None and units[b] is not None and rows[a][1] == rows[b][1] and len(units[a]) == len(units[b])
            if fits and float(units[a] @ units[b]) >= threshold:
                links[a].append(b)
                links[b].append(a)
    found = union_find(range(len(rows)), [(a, b) for a in links for b in links[a]])
    least = {}
    for k, (i, _, _) in enumerate(rows):
        least[found[k]] = min((x for x in (i, least.get(found[k])) if x is not None), default=None)
    return sorted((repr(i), len(links[k]), repr(least[found[k]]), i is not None and i == least[found[k]]) for k, (i, _, _) in enumerate(rows))


@pytest.mark.parametrize(("threshold", "block"), [(0.93, 7), (0.93, 8192), (0.5, 16)])
def test_links_of_odd_vectors(spark, threshold, block):
    rows = odd_vectors()
    got = L.near_vectors(rows_of(spark, rows), threshold, block).collect()
    assert sorted((repr(r["vec_id"]), r["n_links"], repr(r["component_id"]), r["kept"]) for r in got) == plain_links(rows, threshold)


def test_links_of_nothing(spark):
    empty = rows_of(spark, odd_vectors()).limit(0)
    assert L.near_vectors(empty).count() == 0
    only = [(1, 1, None), (2, None, [1.0])]
    assert sorted(map(tuple, L.near_vectors(rows_of(spark, only)).collect())) == [(1, 0, 1, True), (2, 0, 2, True)]


def test_quantisation_bounds_hold():
    rng = np.random.default_rng(1)
    for dim in (1, 3, 64, 700):
        a, b = L.unit(rng.standard_normal((40, dim)) * rng.exponential(size=(40, 1))), L.unit(rng.standard_normal((50, dim)))
        parts, others = L.quantised(a), L.quantised(b)
        exact, upper = a @ b.T, L._sides(*parts)[0] @ L._sides(*others)[1].T
        assert (upper + L.rounding(dim) >= exact).all() and (upper - exact).max() < 0.1
        # Rows that meet a block in any order and slice are bounded alike.
        assert np.abs(parts[0]).max() <= L.LEVELS


def test_sign_code_bounds_hold():
    rng = np.random.default_rng(2)
    for dim in (1, 5, 64, 130):
        base, asked = np.floor(256 * rng.standard_normal((60, dim))), np.floor(256 * rng.standard_normal((9, dim)))
        base[3], asked[2], asked[4] = 0, 0, base[7]
        estimate, low, high = H.score_bounds(asked, *H.sign_codes(base))
        exact = asked @ base.T
        assert (low <= exact).all() and (exact <= high).all() and (low <= estimate).all()
        if dim == 64:
            # The intervals say something: near rows stand out.
            assert (high - low).mean() < 1.5 * np.sqrt((asked**2).sum(1)).max() * np.sqrt((base**2).sum(1)).max()


def test_products_are_exact():
    a, b = np.array([[2.0**40, 1.0], [3.0, -4.0], [2.0**62, 2.0**62]]), np.array([[2.0**22, 1.0], [-2.0**62, 5.0]])
    want = [[min(max(sum(int(x) * int(y) for x, y in zip(r, s)), V.LEAST), V.MOST) for s in b.tolist()] for r in a.tolist()]
    assert V.products(a, b).tolist() == want
    assert V.products(a[:0], b).shape == (0, 2)


def plain_mined(rows, positives=5, negatives=3, low=50, high=95):
    def ints(v):
        return [math.floor(256 * x) for x in v] if v is not None and all(x is not None and math.isfinite(x) for x in v) else None

    rows = [(i, label, ints(v)) for i, label, v in rows if i is not None and label is not None and ints(v) is not None]
    anchors = {}
    for i, label, v in rows:
        if i % 5 == 0:
            key = (label, len(v), np.array(v, "<f8").tobytes())
            anchors[i] = min(anchors.get(i, (key, v)), (key, v), key=lambda x: x[0])
    out = []
    clip = lambda x: min(max(x, V.LEAST), V.MOST)
    for a, ((label, dim, _), v) in anchors.items():
        scores = [(clip(sum(x * y for x, y in zip(v, w))), i, other) for i, other, w in rows if i != a and len(w) == dim]
        best = sorted((-s, i) for s, i, other in scores if other == label)[:positives]
        for rank, (s, i) in enumerate(best, 1):
            inside = sorted((-t, j) for t, j, other in scores if other != label and 100 * t >= -s * low and 100 * t <= -s * high)
            out += [(a, i, rank, n, j, -s, -t) for n, (t, j) in enumerate(inside[:negatives], 1)]
    return sorted(out)


@pytest.mark.parametrize(("block", "seed"), [(7, 0), (4096, 0), (16, 4)])
def test_mined_negatives(spark, block, seed):
    rows = odd_vectors(seed) + [(405, 1, [1e200] * 6), (410, 2, [-1e150] * 6)]
    rows += [(600, 1, [4e4] * 6), (605, 1, [5e4] * 6), (610, 2, [3e4] * 6), (615, 2, [2.0**40] * 6), (620, 1, [2.0**41] * 6)]
    from pyspark.sql import functions as F

    mined = H.mine(rows_of(spark, rows), F.col("vec_id") % 5 == 0, block=block)
    columns = ["anchor_id", "positive_id", "positive_rank", "rank", "negative_id", "positive_score", "negative_score"]
    want = plain_mined(rows)
    assert len(want) > 100 and sorted(map(tuple, mined.select(*columns).collect())) == want


def test_mining_nothing(spark):
    from pyspark.sql import functions as F

    rows = rows_of(spark, odd_vectors())
    assert H.mine(rows.limit(0), F.col("vec_id") % 5 == 0).count() == 0
    assert H.mine(rows, F.lit(False)).count() == 0
    assert H.mine(rows.where("label = 1"), F.col("vec_id") % 5 == 0).count() == 0
