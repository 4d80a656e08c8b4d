

import pytest

from weftline import cli
from weftline.sources import paged
from weftline.sources.paged_example import feed





def test_pages_follow_cursors_pace_and_repeat():
    calls, naps = [], []

    def shaky(cursor):
        calls.append(cursor)
        if len(calls) in (2, 3):
            raise paged.Refused(503)
        return feed(cursor)

    got = list(paged.pages(shaky, 0.5, 5, naps.append))
    assert [p for p, _ in got] == list(range(6)) and calls == [None, "1", "1", "1", "2"] and max(naps) > 1
    with pytest.raises(paged.Refused):
        list(paged.pages(lambda c: (_ for _ in ()).throw(paged.Refused(404)), 0, 5, naps.append))


def test_data_source(spark):
    spark.dataSource.register(paged.PagedSource)
    df = spark.read.format("paged").option("fetch", "weftline.sources.paged_example:feed").option("interval", "0").load()
    assert df.columns == ["position", "body"] and df.count() == 6


def test_cli(tmp_path, data, capsys):
    assert cli.main(["list"]) == 0 and "p4_found" in capsys.readouterr().out
    assert cli.main(["run", "nothing"]) == 2
    assert cli.main(["run", "title_key", data, str(tmp_path / "out"), "json"]) == 0
    assert list((tmp_path / "out").glob("*.json"))
    for stage, parts in (("entities", {"events", "listings", "specs", "stale_listings"}), ("stale", {"tracker", "stale"})):
        assert cli.main(["stage", stage, data, str(tmp_path / stage)]) == 0
        assert parts <= {p.name for p in (tmp_path / stage).iterdir()}
    assert cli.main(["stage", "nothing", data, str(tmp_path / "x")]) == 2
