"""Sentence units of texts in any of the corpus's scripts, in SQL expressions.

Full stops that end nothing (decimals, web and mail addresses, names of files, initials, abbreviations, ordinals, list
numbers) and terminators inside quotations and brackets are replaced by private-use placeholders, one
code point for one, so every offset still holds. Then the text is cut after script-specific
terminators and at hard line breaks, and the units are read from the untouched text by offset, which
restores whatever was masked.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.session import once

_MASK, _CUT = "\ue000", "\ue00f"
_SPACE = " \n\t\r\f\v\u00a0\u2002\u2003\u2009\u202f\u3000\ufeff"

# Fixed values, by language: abbreviations after which a sentence never ends, and those after which none ends before a number. What is under
# '' holds in every language, as citations and names of parties cross them; a text of no known language is read with all of them.
ALWAYS = {
    "": "Dr Prof Cf cf v vs c Bros Capt Hon Art",
    "en": "Mr Mrs Ms App Sup Civ e\\.g i\\.e Ost Nor",
    "de": "Drs Vgl vgl rd bzw Abs Rn Nr ca ggf sog z d\\.h u\\.a Ost Nor",
    "fr": "Mme Mlle Civ",
    "es": "Sr Sra Srta Dra EE",
}
BEFORE_NUMBER = {
    "": "No Nos no nos Fig fig Figs s ss S p pp P art arts Art n vol Vol Jan Feb Mar Apr Jun Jul Aug Sep Sept Oct Nov Dec",
    "en": "Ct Div Rep h ch Ch sec Sec para Para",
    "de": "Rdn Ziff Kap Bd",
    "fr": "al h",
    "es": "núm Núm nº pág págs",
}
LANGUAGES = ("en", "de", "fr", "es")
#: Endings of file names.
FILES = "pdf docx? xlsx? pptx? txt md csv json xml html? jpe?g png gif zip gz py js"
_MONTHS = "Januar|Februar|März|April|Mai|Juni|Juli|August|September|Oktober|November|Dezember"
_ARTICLES = "das|dem|den|des|der|die|im|am|zum|zur|vom|ein|eine|einen|einem|einer|ab|bis|seit|Am|Das|Dem|Den|Der|Die|Im|Zum|Vom"


def _behind(words: str) -> str:
    return rf"(?<=(?<![\p{{L}}\d])(?:{'|'.join(words.split())})\.)"


def _words(lists: dict[str, str], lang: str | None) -> str:
    return " ".join(dict.fromkeys(" ".join(v for k, v in lists.items() if not k or lang in (None, k)).split()))


def stop_pattern(lang: str | None = None) -> str:
    """A full stop that ends no sentence, in one language or (None) in any of them."""
    german = [rf"(?<=(?<![\d.,])\d{{1,2}}\.)(?=\s?(?:{_MONTHS}))", rf"(?<=\b(?:{_ARTICLES})\s\d{{1,2}}\.)(?=\s\p{{L}})"] if lang in (None, "de") else []
    return "\\.(?:" + "|".join(
        [
            # decimals, names of files and versions
            r"(?<=\d\.)(?=\d)",
            rf"(?<=[\w-]\.)(?=(?i:{'|'.join(FILES.split())})(?![\p{{L}}\d]))",
            r"(?<=\b[vV]\d{1,3}\.)(?=\p{L})",
            _behind(_words(ALWAYS, lang)),
            _behind(_words(BEFORE_NUMBER, lang)) + r"(?=\s?[\d(§])",
            # months in full are abbreviated only in dates
            r"(?<=\b(?:March|April|May|June|July)\.)(?=\s\d{1,2},\s\d{4})",
            # initials: a single capital before a capital, a bracket, a redaction or a number
            r"(?<=(?<![\p{L}\d])\p{Lu}\.)(?<!N\.N\.)(?=\s?[\p{Lu}\[█…\d])",
            r"(?<=N\.N\.)(?=\s(?:Inc|Corp|Ltd|LLC|Bros|Co\b|GmbH|S\.))",
            # Co. KG
            r"(?<=\bCo\.)(?=\s?KG)",
            # numbers and letters of headings and paragraphs at the start of a line
            r"(?<=(?:^|\n)\s{0,8}(?:[IVXLC]{1,6}|\p{Lu}|\d{1,4})\.)",
            # ordinals
            *german,
            # ./.
            r"(?=/\.)",
            r"(?<=\./\.)",
            # Devanagari knows the full stop only in abbreviations; a single Arabic letter is a title
            r"(?<=[ऀ-ॿ]\.)",
            r"(?<=(?:^|[\s(«\"])\p{IsArabic}\.)",
        ]
    ) + ")"


#: Web and mail addresses: every terminator inside, up to the next white space or closing mark.
ADDRESS = r"((?:https?://|\bwww(?=\.)|(?<=\w)@|(?!^)\G)[^\s.!?)\]»”]*+)[.!?](?=[^\s)\]»”])|(?<=\w)\.(?=[\w.+-]{1,64}@)"
# classes ask one range first, so that letters of most scripts cost one comparison
_OPEN = r"(\[«[\u2010-\uffff&&[\u201c\u201e\u300c\u300e\uff08]]"
_GROUPS = [r"\([^()\n]*+\)", r"\[[^\[\]\n]*+\]", r"«[^«»\n]*+»", "「[^「」\\n]*+」", "『[^『』\\n]*+』", "（[^（）\\n]*+）"]
#: A text in pieces: quotations and brackets as wholes, what stands between them, and openers that nothing closes.
PIECES = "(" + "|".join([rf"[^{_OPEN}]++", r"“[^“”\n]*+”", *_GROUPS, r"[\s\S]"]) + ")"
#: The same for texts with „…“, whose closing mark opens elsewhere.
PIECES_LOW = "(" + "|".join([rf"[^{_OPEN}]++", r"„[^„“\n]*+“", *_GROUPS, r"[\s\S]"]) + ")"


def _masked_groups(text: Column, pieces: str) -> Column:
    """Masks the terminators inside quotations and brackets, all but one right before the closing mark."""
    inner = lambda p: F.regexp_replace(p, r"[.!?؟。！？](?!\s?.$)", _MASK)
    group = lambda p: F.when(F.left(p, F.lit(1)).isin(*"([«“„「『（"), inner(p)).otherwise(p)
    return F.array_join(F.transform(F.regexp_extract_all(text, F.lit(pieces), F.lit(1)), group), "")


_START = r"[\p{Lu}\p{Lt}\d“„«¿¡\"(\[¶█§•–—\p{IsArabic}\p{IsCyrillic}\p{IsDevanagari}]"
_GO = r"(?=\s+" + _START + r"|\s*(?:\n|$)|(?<=[\p{Ll}\d)\]”»“][.!?؟]{1,3}[”»“)\]]{0,2})(?:[“„«¿¡]|\p{Lu}[\p{Ll}\s’']))"


def _cut_pattern(closers: str) -> str:
    return r"(?=[\n.!?|\u061f\u0964\u0965\u2026\u3002\uff01\uff1f])(?:" + "|".join(
        [
            r"\n",
            rf"[.!?؟…]++(?:\s?»|[{closers}])*+{_GO}",
            r"[।॥]|(?<=[ऀ-ॿ])\|",
            r"[。！？]++(?![”」』）。！？])|[。！？]++[”」』）]++(?![，、；：とはがをの。])",
        ]
    ) + ")"


#: Thai: a space between two Thai letters.
THAI = r"(?<=[\u0e00-\u0e7f]) +(?=[\u0e00-\u0e7f])"


def sentence_units(df: DataFrame, keys: list[str], text: str, wrapped: Column, lang: Column | None = None) -> DataFrame:
    """Rows ``(*keys, unit_no, sent_start, sent_end)``: code point offsets of every unit, outer white space left out.

    ``wrapped`` says per row whether a single line break only stands for a space (an empty line
    still ends a unit); ``lang`` is its language's code, whatever its case, with all languages' abbreviations where it is unknown. Null and blank texts give no rows; a text without terminators is one unit per
    line or paragraph; repeated rows each give their units; very long texts are cut whole.
    """
    raw = F.col(text)
    reserved = raw.contains(_MASK) | raw.contains(_CUT) | raw.contains("\r")
    t = F.when(reserved, F.translate(raw, _MASK + _CUT + "\r", "?? ")).otherwise(raw)
    joined = F.when(F.coalesce(wrapped, F.lit(False)), F.regexp_replace(t, r"(?<!\n)\n(?![^\S\n]*\n)", " ")).otherwise(t)
    low = F.col("_t").contains("„")
    code = F.lower(F.trim(lang)) if lang is not None else F.lit(None).cast("string")
    stage = df.select(*keys, joined.alias("_t"), code.alias("_lang")).filter(F.col(text).isNotNull())
    addressed = F.col("_t").contains("://") | F.col("_t").contains("www.") | F.col("_t").contains("@")
    stage = stage.withColumn("_m", F.when(addressed, F.regexp_replace("_t", ADDRESS, "$1" + _MASK)).otherwise(F.col("_t")))
    masked = F.regexp_replace("_m", stop_pattern(), _MASK)
    for one in LANGUAGES if lang is not None else ():
        masked = F.when(F.col("_lang") == one, F.regexp_replace("_m", stop_pattern(one), _MASK)).otherwise(masked)
    stage = stage.withColumn("_m", F.when(F.col("_m").contains("."), masked).otherwise(F.col("_m")))
    stage = stage.withColumn("_m", F.when(low, _masked_groups(F.col("_m"), PIECES_LOW)).otherwise(_masked_groups(F.col("_m"), PIECES)))
    cut = F.when(low, F.regexp_replace("_m", _cut_pattern(r"”“’\")\]"), "$0" + _CUT)).otherwise(F.regexp_replace("_m", _cut_pattern(r"”’\")\]"), "$0" + _CUT))
    stage = stage.withColumn("_m", cut)
    marked = F.when(F.col("_m").rlike(r"[\u0e00-\u0e7f] "), F.regexp_replace("_m", THAI, "$0" + _CUT)).otherwise(F.col("_m"))
    pieces = once(stage.select(*keys, "_m"), _p=F.split(marked, _CUT))
    lengths = F.transform(
        F.col("_p"),
        lambda p: F.struct(F.length(p).alias("n"), (F.length(p) - F.length(F.ltrim(p, F.lit(_SPACE)))).alias("lead"), F.length(F.trim(p, F.lit(_SPACE))).alias("core")),
    )
    sized = once(pieces.select(*keys, "_p"), _l=lengths).select(*keys, "_l")
    block = 64
    ns = F.transform("_l", lambda x: x["n"])
    sized = once(sized, _n=ns)
    number = F.floor((F.size("_n") + block - 1) / block).cast("int")
    sums = F.transform(F.sequence(F.lit(0), number - 1), lambda b: F.aggregate(F.slice("_n", b * block + 1, F.lit(block)), F.lit(0), lambda s, x: s + x))
    sized = once(sized, _b=sums)
    sized = once(sized, _at=F.transform(F.sequence(F.lit(0), F.size("_b") - 1), lambda b: F.aggregate(F.slice("_b", F.lit(1), b), F.lit(0), lambda s, x: s + x)))
    units = F.transform(
        "_l",
        lambda x, i: F.struct(
            (F.get("_at", F.floor(i / F.lit(block)).cast("int")) + F.aggregate(F.slice("_n", i - i % block + 1, i % block), F.lit(0), lambda s, y: s + y) + x["lead"]).alias("sent_start"),
            x["core"].alias("core"),
        ),
    )
    rows = sized.select(*keys, F.posexplode(F.filter(units, lambda x: x["core"] > 0)).alias("unit_no", "_u"))
    return rows.select(*keys, "unit_no", F.col("_u.sent_start").alias("sent_start"), (F.col("_u.sent_start") + F.col("_u.core")).alias("sent_end"))
