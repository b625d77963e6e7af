"""Components against plain relabelling, on chains, stars, cliques and noise."""

import random

from conftest_llm import plain_components
from groundsheet.llm.components import components


def test_components(spark):
    draw = random.Random(3)
    edges = [(k, k + 1) for k in range(40)] + [(100, 100 + k) for k in range(60)] + [(999 - k, 998 - k) for k in range(50)]
    edges += [(draw.randrange(2000, 2200), draw.randrange(2000, 2200)) for _ in range(150)] + [(5, 5), (7, None), (None, None)]
    frame = spark.createDataFrame(edges + edges[:30], "a long, b long")
    whole = [(a, b) for a, b in edges if a is not None and b is not None]
    linked = {x for a, b in whole if a != b for x in (a, b)}
    want = plain_components(whole, linked)
    assert {r.node: r.root for r in components(frame, "a", "b").collect()} == want


def test_no_edges(spark):
    assert components(spark.createDataFrame([(1, 1)], "a long, b long"), "a", "b").collect() == []
