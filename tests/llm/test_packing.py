import random
from collections import defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st

from weftline.llm.packing import count_tokens, fullest, min_bin_slack, pack


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 60), st.dictionaries(st.integers(1, 60), st.integers(1, 4), max_size=6))
def test_fullest_is_the_best_subset_sum(capacity, histogram):
    lengths = sorted(histogram, reverse=True)
    counts = [histogram[n] for n in lengths]
    sums = {0}
    for n, c in histogram.items():
        sums = {s + n * k for s in sums for k in range(c + 1) if s + n * k <= capacity}
    chosen = fullest(capacity, lengths, counts)
    assert sum(lengths[i] * t for i, t in chosen) == max(sums)
    assert all(t <= counts[i] for i, t in chosen)


@settings(max_examples=40, deadline=None)
@given(st.dictionaries(st.integers(1, 50), st.integers(1, 30), max_size=20))
def test_patterns_use_every_item_once(histogram):
    used = defaultdict(int)
    for bins, combination in min_bin_slack(50, histogram):
        assert bins > 0 and sum(n * t for n, t in combination) <= 50
        for n, t in combination:
            used[n] += bins * t
    assert used == histogram


def packed(spark, tokens, capacities):
    items = spark.createDataFrame([(i, t, "x", 1) for i, t in tokens], "item long, tokens long, kind string, n int")
    sizes = spark.createDataFrame(capacities, "container_kind string, capacity long")
    return pack(items, sizes, "container_kind", "capacity").collect()


def test_whole_items_in_full_containers(spark):
    random.seed(2)
    tokens = [(i, random.choice([0, 3, 7, 7, 7, 50, 99, 100, 101, 250, 300])) for i in range(400)] + [(None, 5), (1, 7), (1, 7)]
    rows = packed(spark, tokens, [("s", 100), ("l", 120), ("none", None), ("zero", 0)])
    for kind, cap in (("s", 100), ("l", 120)):
        mine = [r for r in rows if r.container_kind == kind]
        load, of = defaultdict(int), defaultdict(int)
        for r in mine:
            load[r.container_no] += r.tokens
            of[r.item] += r.tokens
            assert (r.container_no == 0) == (r.tokens == 0)
        want = defaultdict(int)
        for i, t in tokens:
            want[i] += t
        assert of == want and max(load.values()) <= cap
        assert len(mine) == sum(max(1, -(-t // cap)) for _, t in tokens)  # cut only where the capacity is exceeded
        total = sum(t for _, t in tokens)
        assert len(load) - 1 <= -(-total // cap) * 1.05 + 1
    assert {r.container_kind for r in rows} == {"s", "l"}


def test_a_kind_with_two_capacities_and_very_many_kinds(spark):
    rows = packed(spark, [(1, 4), (2, 6)], [("s", 10), ("s", 5), ("s", 10), (None, 6)])
    got = sorted((r.container_kind or "", r.capacity, r.container_no, r.item, r.piece_no, r.tokens) for r in rows)
    assert [g for g in got if g[:2] == ("s", 10)] == [("s", 10, 1, 1, 0, 4), ("s", 10, 1, 2, 0, 6)]
    assert [g[3:] for g in got if g[:2] == ("s", 5)] == [(2, 0, 5), (1, 0, 4), (2, 1, 1)] and len([g for g in got if g[0] == ""]) == 2
    assert len(packed(spark, [(1, 4)], [(f"k{i}", 10 + i) for i in range(1200)])) == 1200


def test_places_found_by_binary_search(spark):
    rows = packed(spark, [(i, 1 + i % 97) for i in range(3000)], [("s", 100)])
    load = defaultdict(int)
    for r in rows:
        load[r.container_no] += r.tokens
    assert len(rows) == 3000 and max(load.values()) <= 100 and sum(load.values()) == sum(1 + i % 97 for i in range(3000))


def test_nothing_to_pack(spark):
    assert packed(spark, [], [("s", 10)]) == [] and packed(spark, [(1, 2)], []) == []


def test_tokens_of_whole_texts(spark):
    df = spark.createDataFrame([(1, "a b", 0), (2, "", 0), (3, None, 0), (2**60 + 1, "word " * 30_000, 0)], "id long, text string, item int")
    got = {r.item: r.tokens for r in count_tokens(df, "id", "text").collect()}
    assert got[1] == 2 and got[2] == got[3] == 0 and got[2**60 + 1] >= 30_000
