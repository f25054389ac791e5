"""Connected components: the smallest node of each, whatever the shape, in few rounds."""

import random

import reelhouse.llm.common as common

SHAPE = "src long, dst long"


def components(pairs):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in pairs:
        if a is not None and b is not None and a != b:
            a, b = sorted((find(a), find(b)))
            root[b] = a
    return {x: find(x) for x in root}


def roots(spark, pairs, parts=6):
    found = common.connected(spark.createDataFrame(pairs, SHAPE).repartition(parts)).collect()
    assert len(found) == len({r["node"] for r in found})
    return {r["node"]: r["root"] for r in found}


def test_shapes_copies_and_missing_ends(spark, monkeypatch):
    monkeypatch.setattr(common, "EDGES_AT_ONCE", 16)
    rng = random.Random(3)
    chain = [(i, i + 1) for i in range(100)]
    star = [(1000, 1000 + i) for i in range(1, 60)]
    cloud = [(rng.randrange(2000, 2200), rng.randrange(2000, 2200)) for _ in range(180)]
    odd = [(-5, 7000), (None, 3), (4, None), (9000, 9000)]
    pairs = [p if rng.random() < 0.5 else p[::-1] for p in chain + star + cloud + odd + star]
    assert roots(spark, pairs) == components(pairs)
    assert roots(spark, [(None, None), (5, 5)]) == {}


def test_stars_need_no_round(spark, monkeypatch):
    """Edges that already lead to their roots are written once; no round is run just to see that nothing moves."""
    runs, write = [], common.written
    monkeypatch.setattr(common, "written", lambda *a, **k: runs.append(a[1]) or write(*a, **k))
    pairs = [(100 * k, 100 * k + i) for k in range(5) for i in range(1, 30)]
    assert roots(spark, pairs) == components(pairs)
    assert runs == ["edges"]
