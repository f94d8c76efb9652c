import numpy as np
import pytest

from acreage.llm import components, projections, topk

LAYOUT = "vec_id long, embedding array<float>, label int, v double, node long"
NAN, INF = float("nan"), float("inf")


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0, 1.5, 3) for i, v in rows], LAYOUT)


ODD = [(900, None), (901, [0.0, 0.0]), (902, [NAN, 1.0]), (903, [INF, 1.0]), (904, [None, 1.0]), (905, []), (None, [1.0, 1.0]), (906, [1e30, 1e30]), (907, [1e-30, 1e-30])]


def vectors(seed=0, size=400, dim=8):
    rnd = np.random.default_rng(seed)
    middles = rnd.normal(size=(30, dim))
    points = middles[rnd.integers(0, 30, size)] + rnd.normal(size=(size, dim)) * 0.12
    points[:60] = points[0]
    return [(i, [float(x) for x in p]) for i, p in enumerate(points.astype(np.float32))]


def brute_links(rows):
    ids = [i for i, _ in rows]
    ok = [v is not None and i is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) for i, v in rows]
    links = {k: set() for k in range(len(rows))}
    for a in range(len(rows)):
        for b in range(a):
            if ok[a] and ok[b] and len(rows[a][1]) == len(rows[b][1]):
                x, y = (np.array(rows[k][1], np.float32).astype(float) for k in (a, b))
                if (x / np.abs(x).max()) @ (y / np.abs(y).max()) >= 0.95 * np.linalg.norm(x / np.abs(x).max()) * np.linalg.norm(y / np.abs(y).max()):
                    links[a].add(b)
                    links[b].add(a)
    out = []
    for k in range(len(rows)):
        seen, todo = {k}, [k]
        while todo:
            for other in links[todo.pop()] - seen:
                seen.add(other)
                todo.append(other)
        least = min((ids[s] for s in seen if ids[s] is not None), default=None)
        out.append((ids[k], len(links[k]), least, ids[k] == least))
    return sorted(out, key=str)


@pytest.mark.parametrize("block", [16, 2048])
def test_links_and_components_against_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(projections, "BLOCK", block)
    rows = vectors() + ODD + [(950, [1.0, 2.0, 3.0]), (951, [1.0, 2.0, 3.0]), (950, [1.0, 2.0, 3.0])]
    got = projections.near_duplicates(table(spark, rows)).select("vec_id", "n_links", "component_id", "kept")
    assert sorted(map(tuple, got.collect()), key=str) == brute_links(rows)


def crowded(seed, others, pairs, level=0.85):
    """Vectors of mutual cosine ``level``, the first of which have partners at 0.955."""
    rnd = np.random.default_rng(seed)
    middle = np.zeros(64)
    middle[0] = 1
    points = rnd.normal(size=(others, 64))
    points[:, 0] = 0
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    points = np.sqrt(level) * middle + np.sqrt(1 - level) * points
    beside = rnd.normal(size=(pairs, 64))
    beside -= (beside * points[:pairs]).sum(1, keepdims=True) * points[:pairs]
    beside /= np.linalg.norm(beside, axis=1, keepdims=True)
    return np.concatenate([points, 0.955 * points[:pairs] + np.sqrt(1 - 0.955**2) * beside]).astype(np.float32)


def test_recall_among_near_neighbours_that_are_not_linked(spark):
    """One crowded place, and twelve of them in different directions."""
    one = crowded(3, 9000, 600)
    rnd = np.random.default_rng(8)
    turned = [crowded(20 + k, 700, 50) @ np.linalg.qr(rnd.normal(size=(64, 64)))[0] for k in range(12)]
    for points in (one, np.concatenate(turned).astype(np.float32)):
        units = points.astype(float) / np.linalg.norm(points.astype(float), axis=1, keepdims=True)
        links = units @ units.T >= 0.95
        want = links.sum(1) - 1
        assert (want > 0).sum() >= 1200 and (want == 0).sum() > 6000
        got = projections.near_duplicates(table(spark, list(enumerate(points.tolist())))).collect()
        found = np.zeros(len(points), int)
        component = np.zeros(len(points), int)
        for r in got:
            found[r.vec_id], component[r.vec_id] = r.n_links, r.component_id
        assert (found <= want).all() and found.sum() >= 0.99 * want.sum()
        a, b = np.nonzero(np.triu(links, 1))
        assert (component[a] == component[b]).mean() >= 0.99


def test_more_rounds_where_windows_are_narrow(spark, monkeypatch):
    monkeypatch.setattr(projections, "WINDOW", 2)
    monkeypatch.setattr(projections, "ROWS", 32)
    rows = vectors(4) + [(950, [1.0, 2.0, 3.0]), (951, [1.0, 2.0, 3.1])]
    got = projections.near_duplicates(table(spark, rows)).select("vec_id", "n_links", "component_id", "kept")
    assert sorted(map(tuple, got.collect()), key=str) == brute_links(rows)


@pytest.mark.parametrize("block, ring", [(7, 0.05), (40, 0.3)])
def test_links_of_large_components_are_counted_in_blocks(spark, monkeypatch, block, ring):
    monkeypatch.setattr(projections, "BLOCK", block)
    monkeypatch.setattr(projections, "RING", ring)
    rnd = np.random.default_rng(6)
    # A chain along an arc, whose ends are far apart, and a crowd of near copies.
    turns = np.linspace(0, 2.4, 160)
    arc = [[float(np.cos(t)), float(np.sin(t)), 0.05 * float(rnd.normal())] for t in turns]
    crowd = [[float(x) for x in [0, 0, -1] + rnd.normal(size=3) * 0.02] for _ in range(150)]
    rows = list(enumerate(arc + crowd + crowd[:5]))
    got = projections.near_duplicates(table(spark, rows)).select("vec_id", "n_links", "component_id", "kept")
    assert sorted(map(tuple, got.collect()), key=str) == brute_links(rows)


def test_empty_tables(spark):
    assert projections.near_duplicates(table(spark, [])).count() == 0
    assert topk.search(table(spark, [])).count() == 0


def brute_top(rows, every, k):
    part = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            part[i] = [int(np.floor(64 * float(np.float32(x)))) for x in v]
    out = []
    for q, x in part.items():
        if q % every == 0:
            scored = sorted((-sum(a * b for a, b in zip(x, y)), i) for i, y in part.items() if i != q)
            out += [(q, r, i, -s) for r, (s, i) in enumerate(scored[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("queries, power, most", [(16_384, 15, 500_000), (3, 4, 500_000), (3, 5, 0)])
def test_search_against_all_products(spark, monkeypatch, queries, power, most):
    for name, value in (("QUERIES", queries), ("BLOCK_POWER", power), ("MOST_STRETCHES", most)):
        monkeypatch.setattr(topk, name, value)
    rows = vectors(1, 150) + [r for r in ODD if r[0] != 906] + [(-20, [1.0] * 8), (1000, [2.0]), (1001, [-50.0] * 8)]
    got = topk.search(table(spark, rows)).select("query_id", "rank", "vec_id", "score")
    assert sorted(map(tuple, got.collect())) == brute_top(rows, 20, 20)


def test_a_query_goes_only_to_blocks_that_may_hold_its_best(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_POWER", 5)
    monkeypatch.setattr(topk, "ANNULUS", 32)
    rnd = np.random.default_rng(12)
    # Equal norms and well-parted groups: other groups cannot reach the k-th best of a query's own.
    points = np.repeat(np.eye(12), 100, axis=0) * 30 + rnd.normal(size=(1200, 12)) * 0.2
    rows = topk.whole_numbers(table(spark, list(enumerate(points.astype(np.float32).tolist()))), 64)
    pivots = np.eye(12) * 30 * 64
    index = topk.build(rows, pivots, 4)
    asked = topk.seeds(index, 20, 5, 12)
    going = topk.dealt(asked, index, pivots, 1).groupBy("vec_id").count()
    blocks = index.select("block").distinct().count()
    assert blocks >= 30 and going.agg({"count": "avg"}).first()[0] < blocks / 3


def test_repeated_query_ids_with_different_vectors(spark):
    rows = [(20, [3.0, 1.0]), (20, [1.0, 5.0]), (20, [1.0, 5.0]), (1, [2.0, 0.0]), (2, [0.0, 2.0]), (2, [0.0, 2.0])]
    got = topk.search(table(spark, rows)).orderBy("rank").collect()
    assert [(r.query_id, r.vec_id, r.score) for r in got] == [(20, 2, 40960), (20, 2, 40960), (20, 1, 8192)]


def test_fewer_rows_than_k_and_ties(spark):
    rows = [(i, [1.0, 1.0]) for i in range(25)]
    got = topk.search(table(spark, rows)).orderBy("query_id", "rank").collect()
    assert [r.vec_id for r in got] == [*range(1, 21), *range(20)]
    assert topk.search(table(spark, rows[:1])).count() == 0


def test_products_beyond_the_exact_range_of_doubles():
    big = float(2**30 + 1)
    assert topk.products(np.array([[big, 3.0]]), np.array([[big, 1.0]])).tolist() == [[int(big) ** 2 + 3]]


def test_components_of_stars_chains_and_loops(spark):
    links = [(0, i) for i in range(1, 200)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5000, 5000), (6000, 6001), (6001, 6000)]
    frame = spark.createDataFrame(links, "a long, b long")
    roots = {r.node: r.root for r in components.components(frame).collect()}
    assert len({roots[i] for i in range(200)}) == 1 and len({roots[1000 + i] for i in range(61)}) == 1
    assert roots[6000] == roots[6001] and 5000 not in roots and len(set(roots.values())) == 3
    assert components.components(frame.limit(0)).count() == 0
