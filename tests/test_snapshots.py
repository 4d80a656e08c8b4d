from datetime import datetime, timedelta

from weftline.operators.snapshots import snapshot_changes

T = datetime(2026, 1, 1)
SCHEMA = "snapshot_no int, ex long, sid string, title string, label string, received timestamp, pos long, change string, _at int"
ARGS = ("snapshot_no", ["ex", "sid"], ["title", "label"], ["received", "pos"])


def rows(spark, data):
    df = spark.createDataFrame([(s, e, i, t, lb, None if h is None else T + timedelta(hours=h), p, "x", 1) for p, (s, e, i, t, lb, h) in enumerate(data)], SCHEMA)
    return sorted(map(tuple, snapshot_changes(df, *ARGS).collect()), key=str)


def test_added_removed_changed_and_clashing_columns(spark):
    got = rows(spark, [(1, 1, "a", "t", "x", 0), (1, 1, "b", "t", "x", 0), (2, 1, "b", "u", "x", 0), (2, 1, "c", "t", "x", 0), (2, 2, "b", "t", "x", 0)])
    assert got == sorted([(2, 1, "a", "removed"), (2, 1, "b", "changed"), (2, 1, "c", "added"), (2, 2, "b", "added")], key=str)


def test_white_space_and_composition_are_no_change_but_case_is(spark):
    got = rows(spark, [(1, 1, "a", "café  x ", "Yes", 0), (2, 1, "a", "café x", "Yes", 0), (1, 1, "b", "t", "Yes", 0), (2, 1, "b", "t", "yes", 0)])
    assert got == [(2, 1, "b", "changed")]


def test_latest_copy_counts_ties_go_to_the_later_row_and_null_times_are_oldest(spark):
    got = rows(spark, [(1, 1, "a", "t", "x", 0), (2, 1, "a", "old", "x", 5), (2, 1, "a", "t", "x", 5), (2, 1, "a", "older", "x", None)])
    assert got == []


def test_nulls_are_values_and_keys(spark):
    got = rows(spark, [(1, 1, "a", None, "x", 0), (2, 1, "a", "t", "x", 0), (1, None, None, "t", None, 0), (2, None, None, "t", None, 0), (None, 1, "z", "t", "x", 0)])
    assert got == [(2, 1, "a", "changed")]


def test_missing_snapshot_numbers_and_empty_table(spark):
    assert rows(spark, [(1, 1, "a", "t", "x", 0), (4, 1, "a", "t", "x", 0)]) == []
    assert rows(spark, [(1, 1, "a", "t", "x", 0)]) == []
    assert rows(spark, []) == []


def test_hot_record(spark):
    many = [(1, 1, "a", f"t{i}", "x", i % 7) for i in range(400)] + [(2, 1, "a", "t", "x", 0), (1, 1, "b", "l" * 100_000, "x", 0), (2, 1, "b", "l" * 100_000, "x", 0)]
    assert rows(spark, many) == [(2, 1, "a", "changed")]
