import math
import random

import numpy as np

from weftline.llm import leakage
from weftline.llm.leakage import RUN, SHARE, SHINGLE, align, common, leaked_items, least_places, stretch, stretches, words_of

random.seed(9)
VOCABULARY = [f"{a}{b}{c}" for a in ("ka", "lo", "mi", "nu") for b in ("ser", "tan", "vel", "dor", "pim") for c in ("a", "et", "ion", "us")]
ITEM = [random.choice(VOCABULARY) for _ in range(60)]
OTHER = [random.choice(VOCABULARY) for _ in range(60)]
NOISE = [f"noise{i}" for i in range(300)]


def found(spark, docs, items):
    d = spark.createDataFrame([(i, t, 0, 0) for i, t in docs], "doc_id long, text string, item long, row int")
    e = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, doc long")
    return {(r.doc_id, r.item_id) for r in leaked_items(d, "doc_id", "text", e, "item_id", "text").collect()}


def test_whole_half_edited_and_broken_passages(spark):
    half = ITEM[10:44]
    edited = [w if k % 9 else "changed" for k, w in enumerate(ITEM)]
    docs = [
        (1, " ".join(NOISE[:50] + ITEM + NOISE[50:80])),
        (2, " ".join(NOISE[:20] + half + NOISE[20:40]).upper()),
        (3, " ".join(edited)),
        (4, " ".join(ITEM[:30]) + "\n\n- 7 -\n\n¶ 3 " + ", ".join(ITEM[30:])),
        (5, " ".join(w[:3] + "-\n" + w[3:] if k % 12 == 5 else w for k, w in enumerate(ITEM))),
        (6, " ".join(NOISE[:80] + ITEM[:14] + NOISE[80:160])),
        (7, " ".join(NOISE)),
        (8, " ".join(OTHER)),
        (9, " ".join(random.sample(ITEM, 60))),
    ]
    assert found(spark, docs, [(100, " ".join(ITEM)), (101, " ".join(ITEM))]) == {(d, i) for d in (1, 2, 3, 4, 5) for i in (100, 101)}


def test_characters_where_no_spaces_are_written(spark):
    item = "".join(chr(0x4E00 + random.randrange(4000)) for _ in range(80))
    assert found(spark, [(1, "前言。" + item[20:70] + "后记"), (2, item[:18])], [(1, item)]) == {(1, 1)}


def test_nulls_empties_copies_and_long_texts(spark):
    text = " ".join(ITEM)
    docs = [(1, None), (2, ""), (None, text), (3, text), (3, text), (4, "filler " * 200_000 + text)]
    assert found(spark, docs[3:4], [(1, "other " * 9), (1, text)]) == {(3, 1)}
    assert found(spark, docs, [(1, text), (2, None), (3, ""), (None, text), (4, "too short")]) == {(3, 1), (4, 1)}
    assert found(spark, [], [(1, text)]) == set() and found(spark, docs, []) == set()


def test_alignment():
    a = np.arange(40)
    assert abs(align(a, a) - 1) < 1e-9 and align(a, np.arange(100, 140)) == 0.0
    assert align(a, np.concatenate([a[:20], np.full(6, -1), a[20:]])) > 0.9
    assert words_of("Da-\nmals, IST 3x") == ["damals", "ist", "3x"]


def test_a_whole_passage_with_dense_scattered_edits(spark):
    item = [f"w{i}" for i in range(100)]
    edited = ["changed" if k % 16 in (4, 9, 15) else w for k, w in enumerate(item)]  # runs of 4, 4 and 5
    docs = [(1, " ".join(NOISE[:90] + edited + NOISE[90:120])), (2, " ".join(NOISE[:60] + item[:20] + NOISE[60:150]))]
    assert found(spark, docs, [(1, " ".join(item))]) == {(1, 1)}


def test_frequent_shingles_left_out_of_the_prefix_lose_nothing(spark):
    item = [f"w{i}" for i in range(104)]
    runs = [item[26 * k : 26 * k + 5] for k in range(4)]  # only these four shingles are shared, and they are frequent
    edited = ["changed" if k % 26 in (5, 10, 15, 20, 25) else w for k, w in enumerate(item)]
    docs = [(1, " ".join(edited))] + [(i, " ".join(NOISE[:60] + runs[i % 4] + runs[(i + 1) % 4])) for i in range(2, 30)]
    assert found(spark, docs, [(1, " ".join(item))]) == {(1, 1)}


def test_bounds():
    # whatever m words stand, cut into runs by one edit place for every RUN of them, so many shingles are shared
    rng = np.random.default_rng(4)
    for n in range(8, 200):
        m = math.ceil(SHARE * n)
        cuts = np.sort(rng.choice(np.arange(1, m), m // RUN, replace=False)) if m // RUN else np.zeros(0, int)
        runs = np.diff(np.concatenate([[0], cuts, [m]]))
        assert np.maximum(runs - SHINGLE + 1, 0).sum() >= least_places(n) or least_places(n) == 1
    for _ in range(50):
        a, b = rng.integers(0, 12, 30), rng.integers(-1, 12, 50)
        assert align(a, b) * len(a) <= common(a.tolist(), b.tolist()) + 1e-9
    assert common([1, 2, 3, 4], [9, 1, 3, 3, 4, 2]) == 3


def test_alignments_side_by_side_are_those_one_by_one(monkeypatch):
    rng = np.random.default_rng(5)
    items = [rng.integers(0, 9, n) for n in (1, 7, 30, 30, 2100)] + [np.zeros(0, int), rng.integers(0, 9, 5)]
    docs = [rng.integers(0, 9, n) for n in (4, 80, 40, 0, 60, 9, 3)]
    assert stretches(items, docs) == [stretch(a, b) for a, b in zip(items, docs, strict=True)]


def test_edits_of_one_word_in_four_to_ten_at_any_length(spark):
    items, docs, want = [], [], set()
    for i, n in enumerate((8, 12, 20, 60, 150)):
        item = [f"x{i}y{k}" for k in range(n)]
        items.append((i, " ".join(item)))
        for rate in range(4, 11):
            docs.append((10 * i + rate, " ".join(NOISE[:40] + [w if (k + 1) % rate else "changed" for k, w in enumerate(item)] + NOISE[40:80])))
            want.add((10 * i + rate, i))
    assert found(spark, docs, items) == want


def test_items_in_blocks_give_what_one_block_gives(spark, monkeypatch):
    items = [(i, " ".join(f"x{i}y{k}" for k in range(20))) for i in range(6)]
    docs = [(i, " ".join(NOISE[:30]) + " " + t) for i, t in items] + [(9, items[0][1] + " " + items[5][1])]
    whole = found(spark, docs, items)
    monkeypatch.setattr(leakage, "BLOCK_WORDS", 40)
    assert len(whole) == 8 and found(spark, docs, items) == whole


def test_half_of_the_words_stand_whatever_the_edits_cost(spark):
    item = [f"w{i}" for i in range(100)]
    part = ["changed" if k % 9 == 8 else w for k, w in enumerate(item[20:78])]  # 52 words stand, the score is 0.46
    docs = [(1, " ".join(NOISE[:90] + part + NOISE[90:120])), (2, " ".join(NOISE[:60] + item[20:64] + NOISE[60:150]))]
    assert found(spark, docs, [(1, " ".join(item))]) == {(1, 1)}
