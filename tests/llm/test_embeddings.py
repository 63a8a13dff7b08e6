"""Hard negatives and whitening against brute force on tables with nulls, repeated rows, shared ids and clashing names."""

import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from shiftlake.llm import negatives, whitening
from shiftlake.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, label int, score double, v string, x int, n string"


def table(spark, rows):
    """Extra columns have names that the operators use themselves."""
    return spark.createDataFrame([(i, v, y, 1.0, "a", 2, "b") for i, v, y in rows], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(5)
    real = [(i, [float(np.float32(c)) for c in rng.normal(0, 0.4, 6)], int(rng.integers(0, 4))) for i in range(300)]
    same = [(300 + i, [0.5, 0.25, 0.0, -0.5, 0.125, 1.0], i % 3) for i in range(150)]  # ties: a third share one vector
    odd = [
        (500, None, 1), (501, [1.0, None, 0.0, 0.0, 0.0, 0.0], 1), (502, [math.nan] * 6, 2), (503, [math.inf] + [0.0] * 5, 2),
        (504, [0.5] * 6, None), (None, [0.5] * 6, 1), (510, [0.25, 0.5], 1), (520, [], 2), (530, [0.0] * 6, 3), (540, [-0.5] * 6, 3),
        (0, [0.75] * 6, 2), (7, [0.5] * 6, 0),  # ids used twice
    ]
    return real + real[:20] + same + odd


def usable(rows, scale, need):
    out = set()
    for i, v, y in rows:
        if v is not None and all(c is not None and math.isfinite(c) for c in v) and (not need or (i is not None and y is not None)):
            out.add((i, y, tuple(math.floor(scale * c) for c in v) + (0,) * (6 - len(v))))
    return out


def brute_negatives(rows, k=5):
    kept, out = sorted(usable(rows, 256, True)), []
    for a, label, v in (r for r in kept if r[0] % 10 == 0):
        scored = sorted((-sum(p * q for p, q in zip(v, w)), i, y) for i, y, w in kept if i != a)
        for s, i, _ in [x for x in scored if x[2] == label][:k]:
            found = [x for x in scored if x[2] != label and 80 * -s <= 100 * -x[0] <= 100 * -s][:k]
            out += [(a, i, r, x[1], -s, -x[0]) for r, x in enumerate(found, 1)]
    return sorted(out)


@pytest.mark.parametrize("block_rows, round_anchors, depth", [(8192, 4096, 32), (64, 10, 1), (7, 4096, 2)])
def test_hard_negatives(spark, rows, monkeypatch, block_rows, round_anchors, depth):
    monkeypatch.setattr(negatives, "FIRST_DEPTH", depth)
    out = negatives.mine_hard_negatives(table(spark, rows), F.col("vec_id") % 10 == 0, block_rows=block_rows, round_anchors=round_anchors)
    assert sorted(map(tuple, out.collect())) == brute_negatives(rows)


def test_hard_negatives_of_little(spark):
    for some in ([], [(1, [0.5], 1)], [(0, None, 1)], [(0, [], 1), (1, [], 2), (2, [], 1)], [(0, [1.0], 1), (2, [1.0], 2)]):
        out = negatives.mine_hard_negatives(table(spark, some), F.col("vec_id") % 10 == 0).collect()
        assert sorted(map(tuple, out)) == brute_negatives([(i, None if v is None else v + [0.0] * (6 - len(v)), y) for i, v, y in some])


def test_scan_stops_early():
    """Clustered vectors: the threshold ends the scan before all rows are met, and nothing is lost."""
    rng = np.random.default_rng(3)
    v = rng.integers(-20, 20, (4000, 6))
    v[:40] += np.array([200, -200, 100, 0, 0, 50])
    cells = {"n": 4000, "dims": 6, "ids": np.arange(4000).tobytes(), "labels": np.zeros(4000, np.int64).tobytes(), "vectors": v.tobytes(),
             "lists": np.ascontiguousarray(np.argsort(v, axis=0, kind="stable").T.astype(np.uint32)).tobytes()}
    block, best, met = negatives.Lists(cells, np.float64), negatives.Best(1, 5), []

    def take(rows, scores):
        met.extend(rows)
        best.add(0, scores, block.ids[rows])

    block.scan(v[0], block.thresholds(v[:1])[0], take, lambda: best.score[0, -1])
    assert len(met) == len(set(met)) < 2000
    scores = v @ v[0]
    assert best.id[0].tolist() == np.lexsort((np.arange(4000), -scores))[:5].tolist()


def exact_covariance(fit):
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    z = [[n * c - s for c, s in zip(x, sums)] for x in fit]
    dims = len(sums)
    return n, sums, [[Fraction(sum(r[i] * r[j] for r in z), n**3) for j in range(dims)] for i in range(dims)]


def test_whitening(spark, rows):
    out = whitening.whiten(table(spark, rows), components=4).collect()
    kept = [(i, tuple(math.floor(64 * c) + 1_000_000 for c in v) + (1_000_000,) * (6 - len(v)))
            for i, v, _ in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    n, sums, covariance = exact_covariance(sorted({x for _, x in kept}))
    e, axes = np.linalg.eigh(np.array(covariance, float))
    e, axes = e[::-1], axes[:, ::-1]
    trace = float(sum(covariance[i][i] for i in range(6)))
    assert len(out) == 4 * len(kept) and {r.n for r in out} == {n}
    got = {}
    for r in out:
        assert r.explained == pytest.approx(e[r.component - 1] / trace, rel=1e-9) and 0 <= r.identity_error < 1e-9
        got.setdefault((r.vec_id, int(r.deviation)), {})[r.component] = r.whitened
    want = {}
    for i, x in kept:
        z = [n * c - s for c, s in zip(x, sums)]
        want[i, sum(c * c for c in z)] = np.array([float(Fraction(c, n)) for c in z]) @ axes / np.sqrt(e)
    assert got.keys() == want.keys()
    signs = {}
    for key, w in want.items():
        for c in range(1, 5):
            assert abs(got[key][c]) == pytest.approx(abs(w[c - 1]), abs=1e-8)
            if abs(w[c - 1]) > 1e-6:
                signs.setdefault(c, set()).add(np.sign(got[key][c] * w[c - 1]))
    assert all(len(s) == 1 for s in signs.values())


def test_whitening_of_large_components(spark):
    """Sums that pass 64 bits stay exact."""
    some = [(i, [float(v) for v in x], 0) for i, x in enumerate([(2.0**40, -(2.0**39)), (0.0, 5.0), (-(2.0**41), 7.0), (3.0, 2.0**38), (2.0**40, 1.0)])]
    out = whitening.whiten(table(spark, some)).collect()
    fit = [tuple(math.floor(64 * c) + 1_000_000 for c in v) for _, v, _ in some]
    n, sums, _ = exact_covariance(fit)
    assert {r.vec_id: int(r.deviation) for r in out} == {i: sum((n * c - s) ** 2 for c, s in zip(x, sums)) for i, x in enumerate(fit)}
    assert max(r.identity_error for r in out) < 1e-6


def test_whitening_of_little(spark):
    one = [(k, [0.5, 0.5], 1) for k in range(4)]
    for some in ([], [(1, None, 1)], [(1, [], 1)], one):
        assert whitening.whiten(table(spark, some)).collect() == []
    flat = whitening.whiten(table(spark, one + [(9, [0.75, 0.5], 1), (None, [0.25, 0.5], 1)])).collect()
    assert {r.component for r in flat} == {1} and None in {r.vec_id for r in flat} and len(flat) == 6


def test_square_sums():
    rng = np.random.default_rng(1)
    for top in (3, 1 << 19, 1 << 21, 1 << 45, 1 << 61):
        y = rng.integers(-top, top, (50, 3))
        assert whitening.square_sums(y) == [sum(int(v) ** 2 for v in c) for c in y.T] == whitening.square_sums(y.astype(object))


def test_registered(spark):
    out = QUERIES["op13_whitening"](spark, SF)
    assert dict(out.dtypes) == {"vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double", "explained": "double", "identity_error": "double"}
    assert out.select("component").distinct().count() == 16
    out = QUERIES["op11_hard_negatives"](spark, SF)
    assert dict(out.dtypes) == {k: "int" if k == "rank" else "bigint" for k in ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")}
