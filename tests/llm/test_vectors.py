"""The operators on embeddings against plain versions on small tables with nulls, ties, repeats and clashing columns."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from arborflow.llm import embdup, negatives, whitening

SCHEMA = "vec_id long, embedding array<double>, label int, dim int, x string, key string, rank int, n long, part string"
NAN, INF = float("nan"), float("inf")


def rows_of(vectors):
    return [(i, v, label, 1, "x", "k", 2, 3, "p") for i, v, label in vectors]


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(4)
    centres = rng.standard_normal((6, 7))
    out = [(k, (centres[k % 6] + rng.normal(0, [0.01, 0.12, 0.5][k % 3], 7)).tolist(), k % 3 if k % 11 else None) for k in range(150)]
    out += [(150 + k, out[3][1], 0) for k in range(20)] + [(3, out[3][1], 0), (3, out[4][1], 0)]
    out += [(200, None, 1), (201, [0.0] * 7, 1), (202, [1.0, None] + [0.0] * 5, 1), (203, [NAN, *[1.0] * 6], 1), (204, [INF, *[1.0] * 6], 1), (205, [], 1), (206, [1.0, 2.0], 1)]
    out += [(207, [x * 1e-3 for x in out[3][1]], 0)]
    return out


def sound(v):
    return v is not None and len(v) == 7 and all(c is not None and math.isfinite(c) for c in v)


def test_whitening_against_eigenvectors(spark, vectors):
    good = [(i, v) for i, v, _ in vectors if sound(v)]
    x = np.array([[math.floor(1024 * c) + 100000 for c in v] for _, v in good])
    n, total = len(x), x.sum(axis=0)
    centred = x - total / n
    values, turn = np.linalg.eigh(centred.T @ centred / n)
    values, turn = values[::-1], turn[:, ::-1]
    got = whitening.whiten(spark.createDataFrame(rows_of(vectors), SCHEMA).repartition(5), top=4).collect()
    assert len(got) == 4 * n and got[0].identity_error < 1e-10 and {r.n for r in got} == {n}
    deviation = sorted((i, int(d)) for (i, _), d in zip(good, ((n * x - total) ** 2).sum(axis=1), strict=True))
    for k in range(4):
        of = sorted((r for r in got if r.component == k + 1), key=lambda r: (r.vec_id, r.deviation))
        assert [(r.vec_id, r.deviation) for r in of] == deviation
        assert abs(of[0].explained - values[k] / values.sum()) < 1e-12
        want = sorted((i, d, w) for (i, _), d, w in zip(good, ((n * x - total) ** 2).sum(axis=1), centred @ turn[:, k] / math.sqrt(values[k]), strict=True))
        a, b = np.array([r.whitened for r in of]), np.array([w for *_, w in want])
        assert min(np.abs(a - b).max(), np.abs(a + b).max()) < 1e-8


def test_whitening_in_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK", 3)
    rng = np.random.default_rng(1)
    turn = np.linalg.qr(rng.standard_normal((20, 20)))[0]
    data = rng.standard_normal((80, 20)) * np.linspace(9, 1, 20) @ turn
    x = np.floor(data * 1024) + 100000
    rows = spark.createDataFrame([(r.tolist(),) for r in x.astype(int)], "x array<long>")
    components, deviations, trace = whitening.bidiagonal(rows, x.mean(axis=0), 80, 5)
    values, want = np.linalg.eigh(np.cov(x.T, bias=True))
    assert np.allclose(deviations**2, values[::-1][:5], rtol=1e-12) and np.isclose(trace, values.sum())
    assert np.allclose(np.abs((components * want[:, ::-1][:, :5]).sum(axis=0)), 1, atol=1e-12)


def test_whitening_without_variance(spark):
    def run(data):
        return whitening.whiten(spark.createDataFrame([(k, v, 0) for k, v in enumerate(data)], "vec_id long, embedding array<double>, label int")).collect()

    assert run([]) == [] and run([[1.0, 2.0]]) == [] and run([[1.0, 2.0]] * 5) == [] and run([None, []]) == []
    line = run([[0.0, 0.0], [1.0, 1.0], [None, 1.0], [3.0, 3.0]])
    assert {r.component for r in line} == {1} and abs(line[0].explained - 1) < 1e-12 and line[0].identity_error < 1e-12
    big = run([[1e300, 0.0], [-1e300, 1.0], [5.0, 2.0]])
    assert {r.vec_id for r in big if r.deviation is None} == {0, 1}


def plain_links(vectors, least):
    count, reach = [0] * len(vectors), [{k} for k in range(len(vectors))]
    for a, (_, v, la) in enumerate(vectors):
        for b, (_, w, lb) in enumerate(vectors):
            if a != b and la is not None and la == lb and v and w and len(v) == len(w) and all(c is not None and math.isfinite(c) for c in v + w) and any(v) and any(w):
                x, y = np.array(v), np.array(w)
                if (x @ y) / math.sqrt((x @ x) * (y @ y)) >= least:
                    count[a] += 1
                    reach[a].add(b)
    changed = True
    while changed:
        grown = [set().union(*(reach[b] for b in r)) for r in reach]
        changed, reach = grown != reach, grown
    out = []
    for k, (i, _, _) in enumerate(vectors):
        ids = [vectors[b][0] for b in reach[k] if vectors[b][0] is not None]
        name = min(ids) if ids else None
        out.append((i, count[k], name, name == i))
    return sorted(out, key=str)


@pytest.mark.parametrize("sizes", [(2048, 8192, 1024), (16, 5, 2)])
def test_embedding_links_against_all_pairs(spark, vectors, monkeypatch, sizes):
    for name, size in zip(("CELL_ROWS", "BLOCK_ROWS", "TILE"), sizes, strict=True):
        monkeypatch.setattr(embdup, name, size)
    rows = [*vectors, (None, vectors[7][1], 1), (208, vectors[8][1], None)]
    got = embdup.link(spark.createDataFrame(rows_of(rows), SCHEMA).repartition(3)).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain_links(rows, 0.98)
    assert embdup.link(spark.createDataFrame([], SCHEMA)).count() == 0


def test_bounds_of_tiles_hold():
    rng = np.random.default_rng(2)
    for dim in (1, 3, 64, 1100):
        x = embdup.unit(rng.standard_normal((60, dim)) * 10.0 ** rng.integers(-150, 150, (60, 1)))
        x[30:] = embdup.unit(x[:30] + rng.normal(0, 0.2 / math.sqrt(dim), (30, dim)))
        small, scale, missed = embdup.quantised(x)
        off = np.abs(embdup.products(small, small) * scale[:, None] * scale - x @ x.T)
        assert (off <= missed[:, None] + missed + missed[:, None] * missed + embdup.SLACK).all()
        q = embdup.quantised(x)
        for least in (0.9, 0.98):
            clear = np.abs(x @ x.T - least) > 1e-12
            assert (embdup.linked(x, x, q, q, least) == (x @ x.T >= least))[clear].all()


def test_trees_of_links():
    rng = np.random.default_rng(3)
    for _ in range(20):
        a, b = rng.integers(0, 50, 40), rng.integers(0, 50, 40)
        parent = np.arange(50)
        embdup.forest(parent, a, b)
        want = list(range(50))
        for _ in range(50):
            for x, y in zip(a, b, strict=True):
                want[x] = want[y] = min(want[x], want[y])
        assert parent.tolist() == want


def plain_negatives(rows, step, positives, top, low, high):
    good = [(k, i, np.array([math.floor(256 * c) for c in v]), label) for k, (i, v, label) in enumerate(rows) if i is not None and label is not None and sound(v)]
    out = []
    for k, i, x, label in good:
        if i % step == 0:
            scored = sorted((-int(x @ y), j, m, other == label) for m, j, y, other in good if m != k)
            for s, j, _, same in [r for r in scored if r[3]][:positives]:
                found = [r for r in scored if not r[3] and low * -s <= 100 * -r[0] <= high * -s][:top]
                out += [(i, j, rank + 1, r[1], -s, -r[0]) for rank, r in enumerate(found)]
    return sorted(out)


@pytest.mark.parametrize("sizes", [(128, 16, 4096, 8192, 4096), (4, 2, 16, 3, 2)])
def test_hard_negatives_against_all_pairs(spark, vectors, monkeypatch, sizes):
    for name, size in zip(("LEAF", "FAN", "LEAST_TREE", "REQUESTS", "PAGE"), sizes, strict=True):
        monkeypatch.setattr(negatives, name, size)
    rows = [*vectors, (None, vectors[7][1], 1), (210, vectors[1][1], 2), (10, vectors[1][1], 2)]
    df = spark.createDataFrame(rows_of(rows), SCHEMA).repartition(3)
    got = negatives.mine(df, F.col("vec_id") % 10 == 0, positives=4, top=3)
    assert sorted(map(tuple, got.collect())) == plain_negatives(rows, 10, 4, 3, 80, 100)


def test_hard_negatives_of_few_rows(spark):
    def run(data):
        return negatives.mine(spark.createDataFrame(data, "vec_id long, embedding array<double>, label string"), F.col("vec_id") == 0).collect()

    assert run([]) == [] and run([(0, [1.0], "a")]) == [] and run([(0, [1.0], "a"), (1, [1.0], "a")]) == [] and run([(0, None, "a"), (1, [1.0], None)]) == []
    big = [(0, [1e300, 1.0], "a"), (1, [1e300, 0.0], "a"), (2, [9e299, 0.0], "b"), (3, [-1e300, 0.0], "b")]
    assert [(r.positive_id, r.negative_id, r.rank) for r in run(big)] == [(1, 2, 1)]


def test_packing_keeps_every_row_and_labels_apart():
    rng = np.random.default_rng(0)
    x, labels = rng.integers(-200, 200, (1000, 5)), rng.integers(0, 3, 1000)
    order = negatives.packed(x, labels)
    assert sorted(order.tolist()) == list(range(1000)) and (np.diff(labels[order]) >= 0).all()
    low, high = negatives.intervals(x[:50], np.minimum(x[:50], x[50:100]), np.maximum(x[:50], x[50:100]))
    inside = negatives.inner(x[:50], x[50:100])
    assert (np.diag(low) <= np.diag(inside)).all() and (np.diag(inside) <= np.diag(high)).all()
