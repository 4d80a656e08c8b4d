import random

from weftline.llm import components
from weftline.llm.components import groups_of_pairs


def union_find(pairs):
    up = {}

    def top(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x

    for a, b in pairs:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    return {x: top(x) for x in list(up)}


def groups(spark, pairs):
    df = spark.createDataFrame([(a, b, 0, 0) for a, b in pairs], "a long, b long, n long, p long")
    rows = groups_of_pairs(df, "a", "b").collect()
    got = {r.node: r.group_id for r in rows}
    assert len(got) == len(rows)
    return got


def test_shapes_against_union_find(spark):
    random.seed(4)
    path = [(i, i + 1) for i in range(1, 120)]
    random.shuffle(path)
    shapes = [path, [(1, i) for i in range(2, 200)], [(500, i) for i in range(1, 200)], [(random.randint(1, 300), random.randint(301, 600)) for _ in range(200)], [(9, 3), (3, 9), (9, 3)]]
    for pairs in shapes:
        assert groups(spark, pairs) == union_find(pairs)


def test_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(components, "BROADCAST_ROWS", 0)
    random.seed(6)
    pairs = [(random.randint(1, 80), random.randint(1, 80)) for _ in range(60)]
    assert groups(spark, pairs) == union_find([p for p in pairs if p[0] != p[1]])


def test_nulls_loops_and_nothing(spark):
    assert groups(spark, [(None, 1), (2, None), (3, 3)]) == {}
    assert groups(spark, []) == {}
    assert groups(spark, [(5, 5), (-4, 5), (5, -4)]) == {-4: -4, 5: -4}
