import math

import numpy as np
import pytest

from parlance.operators import warping


def plain(x, y, band):
    d = [[math.inf] * (len(y) + 1) for _ in range(len(x) + 1)]
    d[0][0] = 0.0
    for i, a in enumerate(x):
        for j, b in enumerate(y):
            if abs(i - j) <= band:
                d[i + 1][j + 1] = (a - b) ** 2 + min(d[i][j + 1], d[i][j], d[i + 1][j])
    return d[-1][-1]


@pytest.mark.parametrize("band", [0, 1, 3, 40])
def test_distances_and_bounds(band):
    rng = np.random.default_rng(band)
    for n, m in ((1, 1), (7, 7), (9, 12), (12, 9), (20, 20)):
        x, items = rng.normal(size=n), rng.normal(size=(15, m))
        want = np.array([plain(x, y, band) for y in items])
        assert np.allclose(warping.warped(x, items, band), want)
        assert (warping.bounds(x, items, band) <= want + 1e-12).all()


def test_search_is_that_of_all_pairs(spark):
    rng = np.random.default_rng(5)
    t = np.linspace(0, 6, 30)
    rows = [(k, None if k == 7 else k % 3, (np.sin(t * (1 + k % 5) + rng.uniform(0, 0.5)) + 0.1 * rng.normal(size=30))[: 30 - (k % 4 == 1)].tolist()) for k in range(240)]
    rows += [(900, 0, None), (901, 0, []), (902, 1, [1.0, None]), (903, 1, [float("nan")] * 30), (904, 2, [0.0] * 5), (905, 0, rows[0][2]), (906, 0, rows[0][2])]
    items = spark.createDataFrame(rows, "item_id long, kind int, series array<double>").repartition(6)
    queries = items.filter("item_id % 20 = 0 OR item_id IN (7, 903)").withColumnRenamed("item_id", "query_id")
    got = warping.nearest_warped(queries, items, "kind", 4, 3, slice_rows=25).collect()
    usable = [(i, k, s) for i, k, s in rows if k is not None and s and None not in s and not any(map(math.isnan, s))]
    for q, kind, x in (u for u in usable if u[0] % 20 == 0):
        want = sorted((d, i) for i, k, s in usable if k == kind and i != q and math.isfinite(d := plain(x, s, 3)))[:4]
        mine = sorted((r["rank"], r["item_id"], r["distance"]) for r in got if r["query_id"] == q)
        assert [i for _, i, _ in mine] == [i for _, i in want]
        assert np.allclose([d for _, _, d in mine], [math.sqrt(d) for d, _ in want])
    assert {r["query_id"] for r in got} == {i for i, _, _ in usable if i % 20 == 0}
    whole = warping.nearest_warped(queries, items, "kind", 4, 3).collect()
    assert {(r["query_id"], r["item_id"], r["rank"]) for r in whole} == {(r["query_id"], r["item_id"], r["rank"]) for r in got}
    assert sum(r["compared"] for r in whole) < 0.6 * sum(r["candidates"] for r in whole)
    assert warping.nearest_warped(queries.limit(0), items, "kind", 4, 3).count() == warping.nearest_warped(queries, items.limit(0), "kind", 4, 3).count() == 0


def test_many_items_are_compared_at_a_time(monkeypatch):
    """Exact distances are taken for hundreds of items a call, with those given up that can't be among the nearest."""
    rng = np.random.default_rng(3)
    items, x = rng.normal(size=(4000, 32)), rng.normal(size=32)
    every = warping.warped(x, items, 4)
    want = sorted(zip(every.tolist(), range(4000), strict=True))[:5]
    calls, plain = [], warping.warped
    monkeypatch.setattr(warping, "warped", lambda *given: calls.append(len(given[1])) or plain(*given))
    best, compared = warping.nearest_in(x, items, 5, 4)
    assert best == want and compared == sum(calls) and len(calls) < 12
    limit = want[-1][0]
    cut = plain(x, items, 4, limit)
    assert np.array_equal(cut[every <= limit], every[every <= limit]) and np.isinf(cut).sum() > 3000


def test_single_precision_gives_up_nothing_that_counts():
    """Large, tiny, close and equal values; queries together, lengths that differ, items left out."""
    rng = np.random.default_rng(11)
    for scale, n, m in ((1.0, 24, 24), (1e150, 24, 24), (1e-160, 24, 22), (1.0, 20, 24)):
        base = rng.normal(size=m) + 1000
        items = np.concatenate([base + 1e-9 * rng.normal(size=(300, m)), rng.normal(size=(900, m)), np.repeat(base[None, :], 3, 0)]) * scale
        xs = np.concatenate([[np.resize(items[r], n) for r in (0, 7, 400, 1200)], rng.normal(size=(3, n)) * scale])
        skip = np.zeros((len(xs), len(items)), bool)
        skip[[0, 1, 2], [0, 7, 400]] = True
        best, compared = warping.nearest_of(xs, items, 5, 4, skip)
        for x, found, s in zip(xs, best, skip, strict=True):
            every = warping.warped(x, items, 4)
            want = sorted((d, r) for r, d in enumerate(every.tolist()) if not s[r] and np.isfinite(d))[:5]
            assert found == want
    assert max(compared[4:]) < 200


def test_paths_are_followed_for_many_items_at_a_time(monkeypatch):
    """A query meets 4,096 items in few steps, of which few take an exact distance."""
    rng = np.random.default_rng(12)
    items, xs = rng.normal(size=(4096, 64)), rng.normal(size=(8, 64))
    steps, plain = [], warping.path_costs
    monkeypatch.setattr(warping, "path_costs", lambda *given: steps.append(given[1].shape[1]) or plain(*given))
    best, compared = warping.nearest_of(xs, items, 5, 6, np.zeros((8, 4096), bool))
    assert len(steps) <= 10 and sum(compared) < 0.1 * 8 * 4096 and all(len(b) == 5 for b in best)
