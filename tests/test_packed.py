from weftline.operators.packed import split_packed


def split(spark, data):
    df = spark.createDataFrame([(i, "s", a, b, "x") for i, (a, b) in enumerate(data)], "id long, source string, outcomes string, tokens string, value string")
    got: dict = {}
    for r in split_packed(df, ["id"], "source", ["outcomes", "tokens"]).collect():
        got.setdefault((r.id, r.field), {})[r.value_pos] = r.value
    return {k: [v[i] for i in range(len(v))] for k, v in got.items()}


def test_notations(spark):
    cases = [
        ('["Yes", "No"]', '["11", "22"]', ["Yes", "No"]),
        ("['Yes', \"Kel'ra\"]", "11|22", ["Yes", "Kel'ra"]),
        ('{"The \\"M\\" list",Yes}', "11;22", ['The "M" list', "Yes"]),
        ("Yes; No;", "11\t22", ["Yes", "No"]),
        ("Maybe, early\tOther", "11, 22", ["Maybe, early", "Other"]),
        ("No/void / Yes; late", "{11,22}", ["No/void", "Yes; late"]),
        ('"The ""M"" list",A & B', "11\n22", ['The "M" list', "A & B"]),
        ('["Yes; late", "No/void"]', "1|2", ["Yes; late", "No/void"]),
        ("A, B; C | D", "1|2|3|4", ["A", "B", "C", "D"]),
        ("Win", '["11"]', ["Win"]),
        ('["Yes", null, "", "No"]', "[11, 22]", ["Yes", "No"]),
    ]
    got = split(spark, [(a, b) for a, b, _ in cases])
    for i, (_, _, want) in enumerate(cases):
        assert got[i, "outcomes"] == want, cases[i]
        assert len(got[i, "tokens"]) == len(want), cases[i]


def test_open_texts_follow_what_the_source_shows(spark):
    clear = [('["Yes, early", "No"]', "1|2")] * 5
    got = split(spark, [*clear, ("Yes, early;No", "1|2")])
    assert got[5, "outcomes"] == ["Yes, early", "No"]


def test_nothing_in_nothing_out(spark):
    assert split(spark, [(None, None), ("", "[]"), ("  ", "{}")]) == {}
    assert split(spark, []) == {}


def test_very_long_text_and_repeated_rows(spark):
    n = 20_000
    text = "|".join(f"v{i}" for i in range(n))
    got = split(spark, [(text, None), (text, None)])
    assert got[0, "outcomes"] == got[1, "outcomes"] and len(got[0, "outcomes"]) == n
