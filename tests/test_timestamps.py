from datetime import datetime, timezone

from weftline.operators import timestamps as ts
from weftline.operators.timestamps import normalise_instants


def us(*a):
    return int(datetime(*a, tzinfo=timezone.utc).timestamp() * 1_000_000)


def run(spark, data):
    """data: (source, text, order, zone)"""
    df = spark.createDataFrame([(s, i, t, o, z, "x", "y") for i, (s, t, o, z) in enumerate(data)], "source string, pos long, text string, ord string, zone string, _s string, cands string")
    return {r.pos: r.epoch_us for r in normalise_instants(df, "text", ["source"], ["pos"], "ord", "zone").collect()}


NY, LON = ("MDY", "America/New_York"), ("DMY", "Europe/London")


def test_notations(spark):
    cases = [
        ("2026-05-03T10:00:00Z", NY, us(2026, 5, 3, 10)),
        ("2026-05-03t10:00:00.123456789z", NY, us(2026, 5, 3, 10) + 123456),
        ("2026-05-03 10:00:00,5+0530", NY, us(2026, 5, 3, 4, 30) + 500_000),
        ("2026-05-03", NY, us(2026, 5, 3, 4)),
        ("05/03/2026 7:00 PM", NY, us(2026, 5, 3, 23)),
        ("05/03/2026 12:00 AM", LON, us(2026, 3, 5)),
        ("03.05.2026 13:00", LON, us(2026, 5, 3, 12)),
        ("20260503-2359", LON, us(2026, 5, 3, 22, 59)),
        ("20260503T235900Z", NY, us(2026, 5, 3, 23, 59)),
        ("20260503", ("YMD", "UTC"), us(2026, 5, 3)),
        ("1795644000", NY, 1795644000 * 10**6),
        ("1779919200.5", NY, 1779919200 * 10**6 + 500_000),
        ("1754776800000", NY, 1754776800 * 10**6),
        ("1755820740000000", NY, 1755820740 * 10**6),
        ("Jan 27, 2026, 7:00 PM ET", LON, us(2026, 1, 28)),
        ("August 27, 2025, 3:00 PM PT", LON, us(2025, 8, 27, 22)),
        ("19 Dec 2025 15:59 PST", LON, us(2025, 12, 19, 23, 59)),
        ("14 Jun 2027 10:00 EST", LON, us(2027, 6, 14, 15)),
        ("17 Jan 2026 00:59 BST", NY, us(2026, 1, 16, 23, 59)),
        ("Sun, 03 May 2026 03:30:00 +0530", NY, us(2026, 5, 2, 22)),
        ("13-MAR-2025 23:59", LON, us(2025, 3, 13, 23, 59)),
        ("2027-02-02T16:00:00[America/Los_Angeles]", NY, us(2027, 2, 3)),
        ("2027-03-14 21:00:00 Asia/Tokyo", NY, us(2027, 3, 14, 12)),
        ("  2026-08-26T24:00:00Z\n", NY, us(2026, 8, 27)),
    ]
    got = run(spark, [("a" + str(i), t, *z) for i, (t, z, _) in enumerate(cases)])
    for i, (t, _, want) in enumerate(cases):
        assert got.get(i) == want, (t, got.get(i), want)


def test_clock_changes(spark):
    # twice: first occurrence; skipped: moved on by the gap
    got = run(spark, [("a", "2025-11-02 01:30", *NY), ("b", "2026-03-08 02:30", *NY), ("c", "2026-03-29 01:30", *LON)])
    assert got == {0: us(2025, 11, 2, 5, 30), 1: us(2026, 3, 8, 7, 30), 2: us(2026, 3, 29, 1, 30)}


def test_no_dates(spark):
    assert run(spark, [("a", t, *NY) for t in (None, "", "TBD", "25:61", "2026-02-30", "2026-13-01", "0000-00-00 00:00:00", "2026-05-03 25:00", "x" * 100_000, "2026-05-03 10:00 XYZQ", "2026-05-03 10:00 Nowhere/Land")]) == {}
    assert run(spark, []) == {}


def test_viterbi_settles_what_no_declaration_settles(spark):
    # no declared order: the unambiguous neighbours and the flow of time decide
    days = ["13/04/2026", "14/04/2026", "04/05/2026", "05/05/2026", "20/05/2026"]
    got = run(spark, [("a", t, None, "UTC") for t in days])
    assert got == {i: us(2026, int(t[3:5]), int(t[:2])) for i, t in enumerate(days)}
    days = ["04/13/2026", "04/14/2026", "05/04/2026", "05/05/2026"]
    got = run(spark, [("b", t, None, "UTC") for t in days])
    assert got == {i: us(2026, int(t[:2]), int(t[3:5])) for i, t in enumerate(days)}


def test_a_null_source_is_a_source(spark):
    days = ["13/04/2026", "04/05/2026", "20/05/2026"]
    got = run(spark, [(None, t, None, "UTC") for t in days])
    assert got == {i: us(2026, int(t[3:5]), int(t[:2])) for i, t in enumerate(days)}


def test_blocks_give_what_one_block_gives(spark, monkeypatch):
    data = [("a", f"{d:02d}/{m:02d}/2026", None, "UTC") for m in range(1, 13) for d in (m, 5, 12, 13, 28)]
    whole = run(spark, data)
    monkeypatch.setattr(ts, "BLOCK", 3)
    assert run(spark, data) == whole


def test_declared_order_beats_any_neighbourhood(spark):
    got = run(spark, [("a", "20/05/2026", *NY), ("a", "05/06/2026", *NY), ("a", "21/05/2026", *NY)])
    assert got[1] == us(2026, 5, 6, 4)


def test_zone_names_in_any_case_and_long_texts(spark):
    cases = [
        ("2026-03-01 10:00 Africa/Dar_es_Salaam", us(2026, 3, 1, 7)),
        ("2026-03-01 10:00 AMERICA/ARGENTINA/BUENOS_AIRES", us(2026, 3, 1, 13)),
        ("2026-03-01 10:00 (America/Port-au-Prince)", us(2026, 3, 1, 15)),
        ("2026-03-01 10:00 etc/gmt+5", us(2026, 3, 1, 15)),
        ("2026-03-01T10:00+09:00[Asia/Tokyo]", us(2026, 3, 1, 1)),
        (" " * 300 + "2026-03-01 10:00Z" + "\u00a0\n" * 300, us(2026, 3, 1, 10)),
    ]
    got = run(spark, [("a", t, *NY) for t, _ in cases])
    assert got == {i: want for i, (_, want) in enumerate(cases)}


def test_every_zone_of_the_database_gives_an_instant(spark):
    names = [z for z in ts.zone_names(spark) if "/" in z]
    assert len(names) > 400 and len(run(spark, [("a", f"2026-03-01 10:00 {z.upper()}", *NY) for z in names])) == len(names)


def test_unknown_home_zone_is_utc_and_no_error(spark):
    assert run(spark, [("a", "2026-03-01 10:00", "MDY", "Mars/Phobos"), ("a", "2026-03-01 " + "/a" * 20_000, *NY)]) == {0: us(2026, 3, 1, 10)}


def test_null_and_repeated_orders_are_cut_by_count(spark, monkeypatch):
    monkeypatch.setattr(ts, "BLOCK", 4)
    days = ["13/04/2026"] + ["04/05/2026"] * 30 + ["20/05/2026"]
    df = spark.createDataFrame([("a", None, i, t, None, "UTC") for i, t in enumerate(days)], "source string, pos long, nr long, text string, ord string, zone string")
    got = normalise_instants(df, "text", ["source"], ["pos", "nr"], "ord", "zone").collect()
    assert len(got) == 32 and all(r.epoch_us == us(2026, int(days[r.nr][3:5]), int(days[r.nr][:2])) for r in got)


def test_other_notations_between_do_not_hide_the_habit(spark):
    days = ["13/04/2026", "2026-04-20", "04/05/2026", "1795644000", "June 3, 2026", "20/05/2026"]
    assert run(spark, [("a", t, None, "UTC") for t in days])[2] == us(2026, 5, 4)
