"""Embedding links against all pairs: clusters, copies, odd vectors, regions that split."""

import numpy as np
from conftest_llm import SF, plain_components
from groundsheet.llm import flat_graph, neighbours
from groundsheet.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int, key string, rep int"


def vectors(seed, n=900, groups=6, size=40):
    draw = np.random.default_rng(seed)
    x = draw.normal(size=(n, 16))
    for k in range(groups):
        centre = draw.normal(size=16)
        x[k * size : (k + 1) * size] = centre + draw.normal(scale=0.25 + 0.02 * k, size=(size, 16))
    x[n - 30 :] = x[5]  # copies
    x[n - 40 : n - 30] = 3 * x[6]  # one direction, other lengths
    return [(k, v.astype(np.float32).tolist(), k % 2 if k % 50 else None, "x", 1) for k, v in enumerate(x)]


def plain(rows, threshold=0.93):
    good = [(i, np.array(v, np.float64), lab) for i, v, lab, *_ in rows if i is not None and lab is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    pairs, links = [], dict.fromkeys((r[0] for r in rows), 0)
    for a, (i, x, p) in enumerate(good):
        for j, y, q in good[:a]:
            if p == q and len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= threshold:
                pairs.append((i, j))
                links[i] += 1
                links[j] += 1
    return links, plain_components(pairs, [r[0] for r in rows if r[0] is not None])


def found(spark, rows):
    return sorted(map(tuple, neighbours.link_vectors(spark.createDataFrame(rows, SCHEMA).repartition(5), 0.93).collect()), key=str)


def wanted(rows):
    links, top = plain(rows)
    return sorted(((i, links[i], top[i], top[i] == i) for i, *_ in rows if i is not None), key=str)


def test_all_links(spark):
    rows = vectors(1)
    assert found(spark, rows) == wanted(rows)


def test_regions_that_split(spark, monkeypatch):
    """Small regions: copies in several regions count once, links keep to the threshold, recall stays high."""
    monkeypatch.setattr(neighbours, "REGION_ROWS", 120)
    rows = vectors(2)
    links, _ = plain(rows)
    got = {r[0]: r[1] for r in found(spark, rows)}
    assert all(got[i] <= links[i] for i in got) and sum(got.values()) >= 0.9 * sum(links.values())


def test_group_larger_than_a_block_is_whole(spark, monkeypatch):
    """One dense group of near, but unequal, copies several times larger than a block: every link counts."""
    monkeypatch.setattr(neighbours, "REGION_ROWS", 120)
    draw = np.random.default_rng(4)
    x = draw.normal(size=(1000, 64))
    x[:700] = draw.normal(size=64) + draw.normal(scale=0.22, size=(700, 64))
    rows = [(k, v.astype(np.float32).tolist(), 1 if k % 40 else 2, "x", 1) for k, v in enumerate(x)]
    links, _ = plain(rows)
    assert sum(n > 500 for n in links.values()) > 500
    assert found(spark, rows) == wanted(rows)


def test_odd_vectors(spark):
    rows = [
        (1, [1.0, 0.0], 1, "x", 1), (2, [1.0, 0.1], 1, "x", 1), (3, [0.0, 0.0], 1, "x", 1), (4, None, 1, "x", 1),
        (5, [float("nan"), 1.0], 1, "x", 1), (6, [float("inf"), 1.0], 1, "x", 1), (7, [None, 1.0], 1, "x", 1),
        (8, [1.0, 0.0], None, "x", 1), (9, [1.0, 0.0, 0.0], 1, "x", 1), (10, [], 1, "x", 1), (11, [1.0, 0.0], 2, "x", 1),
        (12, [2.0, 0.0], 1, "x", 1), (12, [2.0, 0.0], 1, "x", 1), (13, [1e-30, 0.0], 1, "x", 1), (14, [-1.0, -0.0], 1, "x", 1),
    ]
    got = found(spark, rows + [(None, [1.0, 0.0], 1, "x", 1)])
    assert (None, 0, None, False) in got
    by = {r[0]: r[1:] for r in got}
    for i in (3, 4, 5, 6, 7, 8, 9, 10, 11, 14):
        assert by[i] == (0, i, True)
    assert by[1] == (4, 1, True) and by[2] == (4, 1, False) and by[12] == (4, 1, False) and by[13] == (4, 1, False)
    assert found(spark, []) == []


def test_graph_search_recalls():
    draw = np.random.default_rng(3)
    x = draw.normal(size=(3000, 32))
    x[:600] = draw.normal(size=32) + draw.normal(scale=0.2, size=(600, 32))
    x /= np.linalg.norm(x, axis=1)[:, None]
    graph, medoids = flat_graph.build(x, np.arange(3000))
    a, b = flat_graph.search(x, graph, medoids, np.arange(0, 3000, 20), 0.93, flat_graph.BEAM)
    true = {(i, j) for i, j in zip(*np.nonzero(x[::20] @ x.T >= 0.93), strict=True)}
    assert len(true & set(zip(a, b, strict=True))) >= 0.99 * len(true)


def test_audit_falls_back_to_all_pairs(monkeypatch):
    monkeypatch.setattr(flat_graph, "search", lambda *a: (np.empty(0, int), np.empty(0, int)))
    x = np.eye(50)[np.arange(300) % 50]
    pairs = {(i, j) for a, b in flat_graph.near_pairs(x, np.arange(300), 0.93) for i, j in zip(a, b, strict=True)}
    assert len(pairs) == 300 * 6


def test_whole_table(spark):
    table = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    got = sorted(map(tuple, QUERIES["op3_embedding_links"](spark, SF).collect()), key=str)
    assert got == wanted(table)
