"""Matching contracts of different venues without a shared key.

What a title is about is learned from the table itself, not from a list. A word identifies a contract
where descriptions repeat it and mention it seldom otherwise (``P(described | in title)`` above its share of all
descriptions, times ``P(in title | described)``), or where it is capitalised inside titles that are not written in capitals
throughout; other words only word the question. Slips of the pen go to the word of the own description, or to a far more
frequent common word, one edit away. The q-grams of the identifying words and of the label's core go into a fixed bit vector. Pairs
within ``RADIUS`` bits are found exactly by multi-index Hamming hashing: the vector is cut into ``RADIUS + 1`` chunks, and two
vectors that differ in at most ``RADIUS`` bits agree in at least one chunk. Day, numbers and label class
must agree exactly (another day or threshold is another contract), so they are part of every
bucket's key. Close pairs are scored by field-weighted Dice, the score becomes a confidence, and pairs from ``LEAST`` on are held to an
exact check: every identifying word has its partner.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.session import small, written

RADIUS = 12
CHUNK_BITS = 16
CHUNKS = RADIUS + 1
BITS = CHUNKS * CHUNK_BITS
#: Weights of title, label, expiry and description in the score.
WEIGHTS = (0.5, 0.3, 0.1, 0.1)
#: Logistic curve from score to confidence, fitted on the close pairs of one table and held to those of another (README), and the confidence from which on
#: pairs are held to the exact check.
SLOPE, MIDDLE, LEAST = 70.0, 0.81, 0.02
#: A word identifies from this weight on. Weights lean on PRIOR observations at the word's share of capitals, and at REST where its case tells nothing.
IDENTIFIES, PRIOR, REST = 0.5, 6.0, 0.7
#: A common word so many times as frequent as one an edit away is what that one was meant to be.
MEANT = 10

_MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")
_MON = r"([a-z]{3,10})\.?"
_DATES = (
    (re.compile(r"\b(\d{4})[-/.](\d{1,2})[-/.](\d{1,2})\b"), "ymd"),
    (re.compile(rf"\b(\d{{1,2}})(?:st|nd|rd|th)?\s+(?:of\s+)?{_MON},?\s+(\d{{4}})\b"), "dmy"),
    (re.compile(rf"\b{_MON}\s+(\d{{1,2}})(?:st|nd|rd|th)?,?\s+(\d{{4}})\b"), "mdy"),
    (re.compile(rf"\b{_MON},?\s+(\d{{4}})\b"), "my"),
)
_NUMBER = re.compile(r"(?<![\w.])[$€£]?\s*(\d{1,3}(?:,\d{3})+(?:\.\d+)?|\d+(?:\.\d+)?)\s?(k|m|bn|b|thousand|million|billion)?\b")
_SCALE = {"k": 1e3, "thousand": 1e3, "m": 1e6, "million": 1e6, "b": 1e9, "bn": 1e9, "billion": 1e9}
_RANGE = re.compile(r"^\D{0,12}?([-−]?\d+(?:\.\d+)?)\s*[°º]?\s*[cf]?\s*(?:-|–|—|to|bis)\s*([-−]?\d+(?:\.\d+)?)\s*[°º]?\s*[cf]?\D{0,3}$")
_WORD = re.compile(r"[^\W_]+(?:['’][^\W_]+)?")
_YES, _NO = {"yes", "y", "true", "ja", "oui"}, {"no", "n", "false", "nein", "non"}


def near(a: str, b: str, most: int = 1) -> bool:
    """Whether the edit distance (with swaps of neighbours) is at most ``most``."""
    if a == b:
        return True
    if abs(len(a) - len(b)) > most:
        return False
    before, row = None, list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        cur = [i]
        for j, y in enumerate(b, 1):
            v = min(row[j] + 1, cur[-1] + 1, row[j - 1] + (x != y))
            if before is not None and j > 1 and x == b[j - 2] and a[i - 2] == y:
                v = min(v, before[j - 2] + 1)
            cur.append(v)
        if min(cur) > most:
            return False
        before, row = row, cur
    return row[-1] <= most


@lru_cache(maxsize=1 << 16)
def _month(word: str) -> int:
    """1 to 12, or 0; a misspelt long name still counts."""
    for i, m in enumerate(_MONTHS, 1):
        if word == m or word == m[:3] or word == m[:4] and len(m) > 4 or len(word) > 3 and len(m) > 4 and near(word, m):
            return i
    return 0


@lru_cache(maxsize=1 << 20)
def _slip(word: str, other: str) -> bool:
    return near(word, other)


def plain(text: str) -> str:
    """Lower case, compatibility forms, no accents, single spaces."""
    if text.isascii():
        return " ".join(text.lower().split())
    text = unicodedata.normalize("NFKD", text)
    return " ".join("".join(c for c in text if not unicodedata.combining(c)).lower().split())


def dates_of(text: str) -> tuple[str, str]:
    """The day (or month) that a text names, as YYYY-MM-DD or YYYY-MM, and the text without it; '' where it names none."""
    for pattern, order in _DATES:
        for m in pattern.finditer(text):
            g = m.groups()
            at = {c: g[i] for i, c in enumerate(order)}
            y, mo, d = at["y"], at["m"], at.get("d", 0)
            month = int(mo) if str(mo).isdigit() else _month(mo)
            if 1 <= month <= 12 and int(d) <= 31:
                day = f"{int(y):04d}-{month:02d}" + (f"-{int(d):02d}" if d else "")
                return day, f"{text[: m.start()]} {text[m.end() :]}"
    return "", text


def numbers_of(text: str) -> tuple[list[float], str]:
    found = [float(m[1].replace(",", "")) * _SCALE.get(m[2] or "", 1.0) for m in _NUMBER.finditer(text)]
    return sorted(set(found)), _NUMBER.sub(" ", text)


def label_of(label: str, title_words: set[str]) -> tuple[str, str]:
    """Class and core of an outcome label: yes/no, a number range, a side named in the title, or a person's surname."""
    t = plain(label)
    m = _RANGE.match(t)
    if m:
        return "range", "{:g}:{:g}".format(*(float(x.replace("−", "-")) for x in m.groups()))
    if re.search(r"\d", t):
        found, rest = numbers_of(t)
        words = sorted(w for w in _WORD.findall(rest) if w not in {"c", "f"})
        return "number", " ".join([*(f"{x:g}" for x in found), *words])
    words = _WORD.findall(t)
    if len(words) == 1 and words[0] in _YES | _NO:
        return ("yes" if words[0] in _YES else "no"), ""
    words = [w for w in words if w not in {"to", "win", "wins", "the", "will", "winner"}] or words
    if not words:
        return "none", t
    for w in words:
        if w in title_words or len(w) >= 4 and any(near(w, x) for x in title_words):
            return "side", w
    return "name", max(words, key=lambda w: (len(w), w))


def _words(text: str) -> list[str]:
    return [w for w in _WORD.findall(text) if len(w) > 1]


def parsed(title: str | None, label: str | None, description: str | None, expiry: str | None) -> tuple:
    """(day, numbers, label class, label core, words of title, words of description or null, capitals, day of expiry); capitals holds 1 or 0 for title words whose case tells something, 2 for first words."""
    t = plain(title or "")
    day, rest = dates_of(t)
    of, about = dates_of(plain(description or ""))
    expires = dates_of(plain(expiry or ""))[0]
    found, rest = numbers_of(rest)
    words = set(_words(rest))
    told = set(_words(numbers_of(about)[1])) if description else None
    kind, core = label_of(label or "", words)
    if told:
        left = [v for v in told if len(v) >= 4 and v not in words]
        meant = {w: next((v for v in left if abs(len(v) - len(w)) < 2 and _slip(w, v)), w) for w in words if len(w) >= 4 and w not in told}
        words = {meant.get(w, w) for w in words}
    raw = [w for w in re.findall(_WORD, title or "") if w[0].isalpha() and not _month(w.lower())]
    capitals = {}
    if sum(w.islower() for w in raw[1:]) >= sum(w[0].isupper() for w in raw[1:]) > 0:
        # the first word's capital says nothing (2)
        capitals = {raw[0].lower(): 2} | {w.lower(): int(w[0].isupper()) for w in raw[1:] if not (w.isupper() and len(w) > 1)}
    return day or of or expires, " ".join(f"{x:g}" for x in found), kind, core, sorted(words), sorted(told) if told is not None else None, capitals, expires


@lru_cache(maxsize=1 << 18)
def _bits(word: str, mark: str) -> tuple[int, ...]:
    """Bits of the q-grams (two letters) of a padded word; a fixed polynomial hash, alike in every process."""
    padded = f"^{word}$"
    out = []
    for i in range(len(padded) - 1):
        h = 2166136261
        for c in f"{mark}{padded[i : i + 2]}":
            h = (h ^ ord(c)) * 16777619 & 0xFFFFFFFF
        out.append((h ^ h >> 15) % BITS)
    return tuple(out)


#: Chunks per whole number in which vectors are kept.
PER_WORD = 3
WORDS = -(-CHUNKS // PER_WORD)


def _vector(bits: set[int]) -> list[int]:
    out = [0] * WORDS
    for b in bits:
        chunk, at = divmod(b, CHUNK_BITS)
        out[chunk // PER_WORD] |= 1 << at + CHUNK_BITS * (chunk % PER_WORD)
    return out


def parse(pdf: pd.DataFrame) -> pd.DataFrame:
    rows = []
    for title, label, description, expiry in zip(pdf["title"], pdf["label"], pdf["description"], pdf["expiry"], strict=True):
        day, numbers, kind, core, words, told, capitals, expires = parsed(title, label, description, expiry)
        exact = core if kind in ("range", "number") else ""
        mine = _vector({*_bits(core, "l")}) if kind in ("side", "name") else [0] * WORDS
        at = set(told or ())
        rows.append((f"{day}|{kind}|{exact}|{numbers}", core, words, [-1 if told is None else int(w in at) for w in words], [capitals.get(w, -1) for w in words], told, expires, *mine))
    out = pd.DataFrame(rows, columns=["must", "core", "word", "told", "capital", "about", "expires", *(f"l{i}" for i in range(WORDS))])
    return pd.concat([pdf[["exchange_id", "sid"]].reset_index(drop=True), out], axis=1)


PARSED = "exchange_id bigint, sid string, must string, core string, word array<string>, told array<int>, capital array<int>, about array<string>, expires string, " + ", ".join(f"l{i} bigint" for i in range(WORDS))


def vocabulary(rows: DataFrame) -> DataFrame:
    """(word, meant, loose, w0..): every title word that identifies a contract with the word it stands for and that word's q-grams as bits; a loose one was only seen
    as first word of titles and in no contract with a description, so nothing tells whether it is a name."""
    seen = rows.select(F.inline("seen"))
    title = seen.groupBy("word").agg(F.count(F.lit(1)).alias("df"), F.count_if(F.col("told") >= 0).alias("t"), F.count_if(F.col("told") == 1).alias("td"), F.count_if(F.col("capital").isin(0, 1)).alias("cn"), F.count_if(F.col("capital") == 1).alias("c"), F.count_if(F.col("capital") == 2).alias("first"))
    described = rows.select(F.explode("about").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("d"))
    n = rows.select(F.count("about")).scalar()
    stats = title.join(described, "word", "left").withColumn("base", F.coalesce(F.col("d") / n, F.lit(0.0)))
    capital = (F.col("c") + 0.25) / (F.col("cn") + 0.5)
    held = F.greatest((F.col("td") / F.nullif(F.col("t"), F.lit(0)) - F.col("base")) / (1 - F.col("base") + 1e-9), F.lit(0.0)) * F.coalesce(F.col("td") / F.col("d"), F.lit(0.0))
    lean = F.when(F.col("cn") > 0, capital).otherwise(REST)
    support = (F.coalesce(F.col("t") * held, F.lit(0.0)) + PRIOR * lean) / (F.col("t") + PRIOR)
    loose = (F.col("cn") == 0) & (F.col("t") == 0) & (F.col("first") > 0)
    stats = written(stats.select("word", "df", loose.alias("loose"), (F.col("cn") > 0).alias("cased"), capital.alias("capital"), F.greatest(support, F.coalesce(held, F.lit(0.0)) * F.col("t") / (F.col("t") + 0.5), F.when(F.col("cn") > 0, capital).otherwise(0.0)).alias("weight")))
    # words one letter apart share a word with one letter left out (or are it themselves)
    long = stats.filter(F.length("word") >= 4)
    outs = F.concat(F.array("word"), F.transform(F.sequence(F.lit(1), F.length("word")), lambda i: F.concat(F.substring("word", F.lit(1), i - 1), F.substring("word", i + 1, F.length("word")))))
    rare = long.select(F.col("word"), "df", F.explode(F.array_distinct(outs)).alias("part"))
    common = long.filter((F.col("cased")) & (F.col("capital") < 0.5) & (F.col("df") >= MEANT)).select(F.col("word").alias("other"), F.col("df").alias("often"), F.explode(F.array_distinct(outs)).alias("part"))
    letters = lambda c: F.array_sort(F.split(c, ""))
    apart = F.levenshtein("word", "other")
    close = rare.join(common, "part").filter(F.col("df") * MEANT <= F.col("often")).filter((apart == 1) | (apart == 2) & (F.length("word") == F.length("other")) & (letters("word") == letters("other")))
    meant = close.groupBy("word").agg(F.max_by("other", F.struct("often", "other")).alias("meant"))
    weights = stats.select(F.col("word").alias("meant"), "weight", "loose")
    every = stats.select("word").join(meant, "word", "left").withColumn("meant", F.coalesce("meant", "word")).join(weights, "meant")

    def bits(batches):  # noqa: ANN001, ANN202
        for pdf in batches:
            vectors = [_vector(set(_bits(w, "t"))) for w in pdf["meant"]]
            yield pdf.assign(**{f"w{i}": [v[i] for v in vectors] for i in range(WORDS)})

    return every.filter(F.col("weight") >= IDENTIFIES).select("word", "meant", "loose").mapInPandas(bits, "word string, meant string, loose boolean, " + ", ".join(f"w{i} bigint" for i in range(WORDS)))


def _sum(parts: list[Column]) -> Column:
    total = parts[0]
    for p in parts[1:]:
        total = total + p
    return total


def _dice(x: str) -> Column:
    a, b = [F.col(f"{x}{i}_a") for i in range(WORDS)], [F.col(f"{x}{i}_b") for i in range(WORDS)]
    both = _sum([F.bit_count(p.bitwiseAND(q)) for p, q in zip(a, b, strict=True)])
    total = _sum([F.bit_count(p) for p in [*a, *b]])
    return F.when(total > 0, 2.0 * both / total)


def _same_words(a: pd.Series, b: pd.Series, loose_a: pd.Series, loose_b: pd.Series, core_a: pd.Series, core_b: pd.Series) -> pd.Series:
    """Exact check of a close pair: every word but loose ones has its partner (up to a slip of the pen), and so has the label."""

    def paired(x: list[str], y: list[str], free: set[str]) -> bool:
        left, right = [w for w in x if w not in set(y)], [w for w in y if w not in set(x)]
        for w in left:
            hit = next((v for v in right if near(w, v, 1 if len(w) < 8 else 2)), None)
            if hit is not None:
                right.remove(hit)
            elif w not in free:
                return False
        return all(v in free for v in right)

    return pd.Series(
        [paired(list(x), list(y), {*f, *g}) and (p == q or min(len(p), len(q)) >= 4 and near(p, q, 1 if len(p) < 8 else 2)) for x, y, f, g, p, q in zip(a, b, loose_a, loose_b, core_a, core_b, strict=True)],
        dtype=bool,
    )


TEXTS = ["title", "label", "description", "expiry"]


def copies(contracts: DataFrame) -> DataFrame:
    """Rows ``(exchange_id, sid, head)``: every contract with the lowest id among those of its exchange with the very same texts."""
    rows = contracts.select("exchange_id", "sid", *TEXTS).filter("exchange_id is not null and sid is not null")
    alike = F.struct(*TEXTS)
    marked = rows.select("exchange_id", "sid", F.sha2(F.to_json(alike, {"ignoreNullFields": "false"}), 256).alias("alike"))
    heads = marked.groupBy("exchange_id", "alike").agg(F.min("sid").alias("head"))
    return marked.join(heads, ["exchange_id", "alike"]).select("exchange_id", "sid", "head").distinct()


def match_contracts(contracts: DataFrame) -> DataFrame:
    """Pairs ``(exchange_id_a, sid_a, exchange_id_b, sid_b, confidence)`` of different venues, each pair once.

    ``contracts`` has exchange_id, sid, title, label, description, expiry, one row per contract; other columns are
    never read. Contracts of one exchange with the very same texts are matched through the lowest of their ids, as ``copies``
    gives it. Rows without exchange, id or identifying words have nothing to be matched by and give no pairs; null
    labels form a class of their own, and so do contracts that name no day; ties all match each other; texts are
    read whole; an empty table gives no pairs.
    """
    rows = contracts.select("exchange_id", "sid", *TEXTS).filter("exchange_id is not null and sid is not null")
    rows = rows.groupBy("exchange_id", *TEXTS).agg(F.min("sid").alias("sid"))
    rows = rows.mapInPandas(lambda it: map(parse, it), PARSED).withColumn("seen", F.arrays_zip("word", "told", "capital")).drop("word", "told", "capital")
    rows = written(rows.withColumn("nr", F.monotonically_increasing_id()))
    ws = [f"w{i}" for i in range(WORDS)]
    of = rows.select("nr", F.explode("seen.word").alias("word")).join(small(written(vocabulary(rows))), "word")
    of = of.groupBy("nr").agg(F.sort_array(F.collect_set("meant")).alias("words"), F.collect_set(F.when(F.col("loose"), F.col("meant"))).alias("loose"), *[F.bit_or(w).alias(w) for w in ws])
    titled = of.join(rows.drop("seen"), "nr")
    # title's bits for the score, all bits for the search
    facts = written(titled.select("nr", "exchange_id", "sid", "must", "core", "words", "loose", "about", "expires", *[F.col(f"w{i}").alias(f"t{i}") for i in range(WORDS)], *[F.col(f"w{i}").bitwiseOR(F.col(f"l{i}")).alias(f"w{i}") for i in range(WORDS)]))
    chunk = lambda i: F.shiftrightunsigned(f"w{i // PER_WORD}", CHUNK_BITS * (i % PER_WORD)).bitwiseAND(F.lit((1 << CHUNK_BITS) - 1))
    # a vector folded to one number: no two are further apart when folded, so most far pairs end here
    fold = F.col(ws[0])
    for i, w in enumerate(ws[1:], 1):
        fold = fold.bitwiseXOR(F.shiftleft(w, 13 * i).bitwiseOR(F.shiftrightunsigned(w, 64 - 13 * i)))
    buckets = facts.select("nr", "exchange_id", "must", fold.alias("fold"), F.posexplode(F.array(*[chunk(i) for i in range(CHUNKS)])).alias("chunk", "value"))
    # buckets hold numbers only; a key is one hash, and what it might mix up is told apart below, where keys and vectors themselves are compared
    buckets = buckets.select(F.xxhash64("must", "chunk", "value").alias("key"), "exchange_id", "nr", "fold")
    left, right = buckets.toDF("key", "ea", "nr_a", "fa"), buckets.toDF("key", "eb", "nr_b", "fb")
    near_enough = (F.col("ea") < F.col("eb")) & (F.bit_count(F.col("fa").bitwiseXOR(F.col("fb"))) <= RADIUS)
    close = left.join(right, (left["key"] == right["key"]) & near_enough).select("nr_a", "nr_b").distinct()
    vectors = facts.select("nr", "must", *ws)
    for side in ("a", "b"):
        close = close.join(vectors.select(*[F.col(c).alias(f"{c}_{side}") for c in vectors.columns]), f"nr_{side}")
    apart = _sum([F.bit_count(F.col(f"{w}_a").bitwiseXOR(F.col(f"{w}_b"))) for w in ws])
    both = close.filter((F.col("must_a") == F.col("must_b")) & (apart <= RADIUS)).select("nr_a", "nr_b")
    told = facts.drop("must", *ws)
    for side in ("a", "b"):
        both = both.join(told.select(*[F.col(c).alias(f"{c}_{side}") for c in told.columns]), f"nr_{side}")
    check = F.pandas_udf(_same_words, T.BooleanType())
    title = F.coalesce(_dice("t"), F.lit(0.0))
    label = F.when(F.col("core_a") == F.col("core_b"), 1.0).otherwise(1 - F.levenshtein("core_a", "core_b") / F.greatest(F.length("core_a"), F.length("core_b"), F.lit(1)))
    expiry = F.when((F.col("expires_a") == "") | (F.col("expires_b") == ""), 0.5).when(F.col("expires_a") == F.col("expires_b"), 1.0).otherwise(0.3)
    shared = F.size(F.array_intersect("about_a", "about_b"))
    about = F.coalesce(2.0 * shared / F.nullif(F.size("about_a") + F.size("about_b"), F.lit(0)), F.lit(0.7))
    about = F.when(F.col("about_a").isNull() | F.col("about_b").isNull(), 0.7).otherwise(about)
    score = WEIGHTS[0] * title + WEIGHTS[1] * label + WEIGHTS[2] * expiry + WEIGHTS[3] * about
    scored = both.withColumn("confidence", 1 / (1 + F.exp(-SLOPE * (score - MIDDLE)))).filter(F.col("confidence") >= LEAST)
    return scored.filter(check("words_a", "words_b", "loose_a", "loose_b", "core_a", "core_b")).select("exchange_id_a", "sid_a", "exchange_id_b", "sid_b", "confidence")
