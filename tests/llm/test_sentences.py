import pytest
from pyspark.sql import functions as F

from weftline.llm.sentences import sentence_units


def units(spark, text, wrapped=False):
    df = spark.createDataFrame([(1, text, wrapped, "x")], "doc_id long, text string, w boolean, _m string")
    rows = sentence_units(df, ["doc_id"], "text", F.col("w")).orderBy("unit_no").collect()
    return [text[r.sent_start : r.sent_end] for r in rows]


CASES = [
    ["Counsel for Mr. Razeld relied on s. 32(5) of the Act, i.e. the notice rule.", "We think not!", "The judge (Hon. H.L. Lejar, sitting alone) heard Jori... and reserved."],
    ["It was sent to desk@razeld.example and posted at www.docket.example/v6.2.", "The award of $215.6 million was cut by 42.71 per cent."],
    ["See Jihist v. Nesald, 762 Ost. App. 803, 37–108 (App. Div. 1961).", "The debtor was Zejist Corp.", "Did Jado Simold Inc. act in time?"],
    ["At 9:23 a.m. on May. 7, 2019, the agent of Rana Inc. called.", "No. 65, Pier St., is held since May.", "7 days later it was shut."],
    ["The parties agreed that “the vessel is lost! It cannot be found.”", "It held rotor, paddock, etc.", "10 days later the gate was shut at 5 p.m."],
    ["„Nach 115 Tagen war der Pfeiler versiegelt. Denn: Wer zahlt, muss prüfen lassen“, erklärte Frau Hopold.", "Dies gilt z. B. für die Miete (vgl. Rn. 41 ff.), nicht aber für das 3. Obergeschoss.", "Am 11. Mai 2022 zahlte die Ganar GmbH & Co. KG rd. 23.613,23 Euro.", "Der Umbau stammt vom 1.7.2009."],
    ["« Ni le devis n'avait été déposé ; le tunnel semblait perdu. » a déclaré le témoin.", "Le n° 53 (v. M. D. Resist) fut fermé à 9 h. 21.", "Est-ce suffisant ?", "La S.A. Gefast a saisi la cour le 1er mai 2017 (cf. p. 86)."],
    ["¡No consta prueba alguna!", "¿Por qué fue perdido?", "La pieza vino de las Islas, vía EE. UU., en 2015.", "La empresa Rebir S.L. recurrió (núm. 26/2020)."],
    ["डॉ. तिशाल ने 27 जून को उत्तर दिया।", "अनुबंध 50 दिन बाद समाप्त हुआ|", "क्या गवाह को सूचना मिली थी?", "धारा 61 है।"],
    ["رفضت المحكمة طلب د. سالف وفق المادة 12، وبقي العقد قائماً.", "هل علم الوكيل بذلك؟", "دفع المستأجر مبلغ 58.24 ألف."],
    ["ตามมาตรา 7 วรรค 2 ศาลรับคำร้องไว้", "ค่าเสียหาย 77.21 ล้านบาทเหมาะสมแล้ว", "จำเลยได้ขายสะพาน"],
]


@pytest.mark.parametrize("want", CASES)
def test_sentences_with_spaces_between(spark, want):
    assert units(spark, " ".join(want)) == want


def test_addresses_files_and_decimals_stay_whole(spark):
    text = "See https://example.org/Page.Html?x=1.Then for more. Next one. Mail Jo.Doe@post.Example.Org today! Open readme.Md of v1.Beta (at www.Site.Example/A.B).Then 3.5 and 1.250,5 hold. Done"
    want = ["See https://example.org/Page.Html?x=1.Then for more.", "Next one.", "Mail Jo.Doe@post.Example.Org today!", "Open readme.Md of v1.Beta (at www.Site.Example/A.B).", "Then 3.5 and 1.250,5 hold.", "Done"]
    assert units(spark, text) == want


def test_abbreviations_belong_to_a_language(spark):
    rows = [(1, " DE ", "Er zahlte rd. Hundert. Ende."), (2, "en", "He took the rd. Hundred. End."), (3, None, "Er zahlte rd. Hundert. Ende."), (4, "xx", "Er zahlte rd. Hundert. Ende.")]
    df = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    got = sentence_units(df, ["doc_id"], "text", F.lit(False), F.col("lang")).groupBy("doc_id").count().collect()
    assert {r.doc_id: r["count"] for r in got} == {1: 2, 2: 3, 3: 2, 4: 2}


def test_scripts_without_spaces(spark):
    zh = ["以下两项成立：（一）水闸有效；（二）期限未过。", "证人称：“若桥梁早已登记，共有的保险就不必再转让。另查明无关。”", "被告是否知情？", "原告主张保险已灭失……但未举证。"]
    assert units(spark, "".join(zh)) == zh
    ja = ["証人は「湿った窯だけが譲渡された。よく覚えている。」と述べた。", "これは相当か？", "船舶（以下「本件塀」という。）は失われた。"]
    assert units(spark, "".join(ja)) == ja


def test_lines_paragraphs_numbers_and_missing_spaces(spark):
    web = "Norvale High Court\nA v. B Corp.\n¶ 1 The levee was lost.See Giro.\nIII. COSTS\n(2) Done"
    assert units(spark, web) == ["Norvale High Court", "A v. B Corp.", "¶ 1 The levee was lost.", "See Giro.", "III. COSTS", "(2) Done"]
    scan = "Norvale High Court\n\n1. In our view, the\nlevee was lost. It\nwas.\n \n- 2 -\n\nThe end"
    assert units(spark, scan, True) == ["Norvale High Court", "1. In our view, the\nlevee was lost.", "It\nwas.", "- 2 -", "The end"]


def test_nothing_long_and_odd_texts(spark):
    assert units(spark, None) == [] and units(spark, "") == [] and units(spark, " \n\t ") == []
    assert units(spark, "no end") == ["no end"]
    one = "The lease began in 1979. "
    assert units(spark, one * 20_000) == [one.strip()] * 20_000
    assert units(spark, "(" * 5000 + "a. B" + "“" * 5000) != []
    assert units(spark, "A\r\nB. C") == ["A", "B.", "C"]
    assert units(spark, "x" * 1_000_000) == ["x" * 1_000_000]


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string, w boolean")
    assert sentence_units(df, ["doc_id"], "text", F.col("w")).count() == 0
