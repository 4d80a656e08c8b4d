from weftline.llm.linkage import BITS, CHUNK_BITS, CHUNKS, RADIUS, dates_of, label_of, match_contracts, near, numbers_of, parsed, vocabulary


def matched(spark, rows):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "exchange_id long, sid string, title string, label string, description string, expiry string, chunk int, day string")
    return {(r.sid_a, r.sid_b): r.confidence for r in match_contracts(df).collect()}


def test_parts():
    assert (BITS, CHUNKS) == (CHUNK_BITS * (RADIUS + 1), RADIUS + 1)
    assert dates_of("x by aug 5, 2027?")[0] == dates_of("x 5 august 2027")[0] == dates_of("2027-08-05 x")[0] == "2027-08-05"
    assert dates_of("vote in septmber 2026")[0] == "2026-09"
    assert numbers_of("above $1.8k")[0] == numbers_of("1,800 dollars")[0] == [1800.0]
    assert label_of("25° to 26°", set()) == label_of("25–26 °C", set()) == label_of("25 - 26C", set()) == ("range", "25:26")
    assert label_of("-4 - -3C", set()) == ("range", "-4:-3")
    assert label_of("Regezibor, Nils", set())[1] == label_of("N. Regezibor", set())[1] == "regezibor"
    assert label_of("Mapi Athletic wins", {"mapi", "athletic"}) == label_of("MAPI", {"mapi", "athletic"}) == ("side", "mapi")
    assert near("tomer", "toemr") and near("hidil", "hiil") and not near("hidil", "hol")
    assert parsed(None, None, None, None) == ("", "", "none", "", [], None, {}, "")
    assert parsed("Who wins the maor vote in Kati Sisal", "Yes", "About the mayor of Kati Sisal", None)[4:7] == (["in", "kati", "mayor", "sisal", "the", "vote", "who", "wins"], ["about", "kati", "mayor", "of", "sisal", "the"], {"who": 2, "wins": 0, "the": 0, "maor": 0, "vote": 0, "in": 0, "kati": 1, "sisal": 1})


BASE = [
    (1, "a1", "Will Zika Delix launch its satellite phone by 2025-09-13?", "No", "d", "2025-09-13T00:00:00Z"),
    (2, "b1", "Zika Delix satellite phne released before end of Sep 13, 2025", "NO ", None, "TBD"),
    (3, "c1", "Zika Delix: satellite phone out by 14 Oct 2025", "No", None, None),
    (3, "c2", "Zika Delix: satellite phone out by 13 Sep 2025", "Yes", None, None),
    (1, "a2", "Who is the next mayor of Toror Toham in June 2026?", "Nils Regezibor", "Settles on the next mayor of Toror Toham.", None),
    (2, "b2", "Who will win the Toror Toham mayor vote in June 2026?", "Regezibor, N.", "On the next mayor of Toror Toham.", None),
    (2, "b3", "Who will win the Toror Toham governor vote in June 2026?", "Regezibor, N.", "On the next governor of Toror Toham.", None),
    (1, "a4", "Deki Sifem above $1.8k at close Jan 8 2027", "yes", None, None),
    (3, "c4", "Above 1,800 dollars: Deki Sifem closing price, 2027-01-08", "Y", None, None),
    (2, "b4", "Above 1,805 dollars: Deki Sifem closing price, 2027-01-08", "Y", None, None),
]


def test_same_outcome_only(spark):
    got = matched(spark, BASE)
    assert set(got) == {("a1", "b1"), ("a2", "b2"), ("a4", "c4")}
    assert all(0 < c <= 1 for c in got.values()) and got["a4", "c4"] > 0.5


def test_wording_is_learned_and_not_listed(spark):
    rows = [(1, "a", "Will Zorblax close the Quuxford harbour by March 3, 2026?", "Yes", None, None), (2, "b", "Zorblax shuts Quuxford harbour by March 3, 2026", "Yes", None, None), (3, "c", "Will Quuxford harbour be shut down by Zorblax by 3 March 2026?", "Yes", None, None)]
    assert set(matched(spark, rows)) == {("a", "b"), ("a", "c"), ("b", "c")}
    other = (2, "d", "Zorblax shuts Rellmouth harbour by March 3, 2026", "Yes", None, None)
    assert set(matched(spark, [rows[0], other])) == set()


def test_vocabulary_learns_from_descriptions_capitals_and_frequent_neighbours(spark):
    seen = [("mayor", 1, 0), ("vote", 0, 0), ("the", 1, 0), ("kati", 1, 1)]
    rows = [(seen, ["mayor", "the", "kati"])] * 12 + [([("speaker", 1, 0), ("race", 0, 0), ("the", 1, 0), ("vite", -1, 0)], ["speaker", "the"])]
    df = spark.createDataFrame(rows, "seen array<struct<word:string,told:int,capital:int>>, about array<string>")
    got = {r.word: r.meant for r in vocabulary(df).collect()}
    assert got == {"mayor": "mayor", "kati": "kati", "speaker": "speaker"}  # "vite" stands for the common "vote", which words the question


def test_nulls_copies_long_texts_and_nothing(spark):
    long = "Zika Delix " + "wordy " * 20_000 + "by 2025-09-13"
    rows = [(1, "n", None, None, None, None), (None, "m", "T 2026-01-01", "Yes", None, None), (2, None, "T", "Yes", None, None), (1, "l", long, "Yes", long, long), (2, "k", long, "Yes", None, ""), (3, "k2", long, "Yes", None, "")]
    assert set(matched(spark, rows)) == {("l", "k"), ("l", "k2"), ("k", "k2")}
    same = [(1, f"a{i}", "Zika Delix out by 2025-09-13", "Yes", None, None) for i in range(50)] + [(2, f"b{i}", "Delix Zika released 13 Sep 2025", "yes", None, None) for i in range(50)]
    assert set(matched(spark, same)) == {("a0", "b0")}
    assert matched(spark, []) == {}
