import numpy as np

from weftline.llm import ann
from weftline.llm.ann import Hnsw, most_similar


def brute(ids, x, k):
    x = x.astype(np.float64)
    x = x / np.sqrt((x * x).sum(axis=1, keepdims=True))
    s = np.round(x @ x.T, 9)
    np.fill_diagonal(s, -np.inf)
    return {(int(ids[i]), int(ids[j])) for i in range(len(x)) for j in np.lexsort((ids, -s[i]))[:k]}


def run(spark, rows, k=10, size=8):
    df = spark.createDataFrame(rows, "event_id long, embedding array<float>, id long, v string")
    return most_similar(df, "event_id", "embedding", k, size)


def test_graph_finds_what_brute_force_finds():
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(60, 32))
    x = (centres[rng.integers(0, 60, 3000)] + 0.4 * rng.normal(size=(3000, 32))).astype(np.float32)
    x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
    found, _ = Hnsw(x).search(x, 64)
    s = x @ x.T
    hits = [len(set(f[:11]) & set(np.argsort(-r)[:11])) / 11 for f, r in zip(found, s, strict=True)]
    assert np.mean(hits) >= 0.95


def test_shards_and_salting_keep_the_recall(spark, monkeypatch):
    monkeypatch.setattr(ann, "SHARD_ROWS", 60)
    monkeypatch.setattr(ann, "OVERFULL", 1)
    monkeypatch.setattr(ann, "VISITORS", 150)
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(12, 8))
    x = (centres[np.minimum(rng.integers(0, 30, 600), 11)] + 0.2 * rng.normal(size=(600, 8))).astype(np.float32)
    ids = np.arange(1000, 1600)
    got = {(r.q, r.c) for r in run(spark, [(int(i), v.tolist(), 1, "x") for i, v in zip(ids, x, strict=True)]).collect()}
    want = brute(ids, x, 10)
    assert len(got) == len(want) and len(got & want) / len(want) >= 0.9


def test_copies_ties_and_unusable_vectors(spark):
    a, b = [1.0] + [0.0] * 7, [0.0, 2.0] + [0.0] * 6
    rows = [(i, a, 0, "") for i in range(1, 31)] + [(50, b, 0, ""), (51, None, 0, ""), (52, [0.0] * 8, 0, ""), (53, [1.0], 0, ""), (54, [float("nan")] + [1.0] * 7, 0, ""), (55, [1.0, None] + [0.0] * 6, 0, ""), (None, a, 0, ""), (56, [float("inf")] * 8, 0, "")]
    got = {}
    for r in run(spark, rows, k=3).collect():
        got.setdefault(r.q, []).append((r.c, r.sim))
    assert set(got) == {*range(1, 31), 50}
    assert sorted(got[1]) == [(2, 1.0), (3, 1.0), (4, 1.0)] and sorted(got[30]) == [(1, 1.0), (2, 1.0), (3, 1.0)]
    assert sorted(c for c, _ in got[50]) == [1, 2, 3]


def test_empty_and_single(spark):
    assert run(spark, []).count() == 0
    assert run(spark, [(1, [1.0] * 8, 0, "")]).count() == 0


def test_exact_answers_of_a_stated_query_set(spark, monkeypatch):
    rng = np.random.default_rng(3)
    x = np.repeat(rng.normal(size=(40, 8)), 3, axis=0)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)] + [(900, None), (901, [0.0] * 8), (None, [1.0] * 8)], "id long, v array<double>").repartition(3)
    monkeypatch.setattr(ann, "QUERY_ROWS", 10)
    got = {}
    for r in ann.exact_similar(df, "id", "v", df.filter("id % 5 = 0"), 4, 8).collect():
        got.setdefault(r.q, set()).add(r.c)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    for q in range(0, 120, 5):
        sims = np.round(unit @ unit[q], 12)
        want = sorted((c for c in range(120) if c != q), key=lambda c: (-sims[c], c))[:4]
        assert got[q] == set(want)
    assert set(got) == set(range(0, 120, 5))
    assert ann.exact_similar(df, "id", "v", df.filter("id = 901"), 4, 8).count() == 0
