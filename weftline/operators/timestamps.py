"""Mixed timestamp texts to instants in UTC.

Every text gives an array of all its valid interpretations (order of day, month and year;
count or calendar digits; zone). Each has a cost of its own: 0 where it follows what the
source declares, ``VIOLATION`` where it does not. A Viterbi pass over each source's record
order adds ``SWITCH`` where the format changes between neighbours and ``BACK`` where time runs
backward, and the cheapest sequence wins. As a row takes part in two transitions at most, an
interpretation that costs more than 2 * (SWITCH + BACK) above the row's cheapest can never be on the
cheapest path and is dropped before the pass; so a row whose source declares its
convention is settled at once, and the pass decides what no declaration settles. All-number dates
of a source, whose order of day and month is one habit, form a chain of their own, so that texts in other notations
between them do not hide what their neighbours say.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.functions.text import BLANKS
from weftline.session import cut, once

VIOLATION, SWITCH, BACK = 100.0, 1.0, 0.5
#: Records per block of the Viterbi pass; blocks are joined through their boundary states.
BLOCK = 8192

# Zone letters in their US, British, central European or Japanese sense, minutes east of UTC.
ZONE_MINUTES = {
    "Z": 0, "UTC": 0, "UT": 0, "GMT": 0, "WET": 0, "BST": 60, "WEST": 60, "CET": 60, "CEST": 120, "EET": 120, "EEST": 180, "JST": 540,
    "EST": -300, "EDT": -240, "CST": -360, "CDT": -300, "MST": -420, "MDT": -360, "PST": -480, "PDT": -420,
}
# US zones with their clock changes.
ZONE_REGIONS = {"ET": "America/New_York", "CT": "America/Chicago", "MT": "America/Denver", "PT": "America/Los_Angeles"}
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")

_TIME = r"(?:[t ,]+|\s+at\s+)(\d{1,2}):(\d{2})(?::(\d{2})(?:[.,](\d+))?)?\s*(?:(am|pm|a\.m\.|p\.m\.)(?![a-z]))?"
_NAME = r"[a-z_]+(?:/[a-z0-9_+-]+){1,3}"
_ZONE = rf"\s*(z|\(?[a-z]{{1,5}}\)?|(?:utc|gmt)?[-+−]\d{{1,2}}(?::?\d{{2}})?(?:\[{_NAME}\])?|[\[(]?{_NAME}[\])]?|\[utc\]|\[[a-z]{{1,5}}\])?"
_MONTH = r"(jan|feb|mar|apr|may|jun|jul|aug|sept?|oct|nov|dec)[a-z]*\.?"
_DAY = r"(?:(?:mon|tue|wed|thu|fri|sat|sun)[a-z]*\.?,?\s+)?"
#: shape -> (pattern, groups of year, month, day, hour, minute, second, fraction, half of day, zone)
SHAPES = {
    "ymd": (rf"(?i)^(\d{{4}})[-/.](\d{{1,2}})[-/.](\d{{1,2}})(?:{_TIME})?{_ZONE}$", (1, 2, 3, 4, 5, 6, 7, 8, 9)),
    "compact": (r"(?i)^(\d{4})(\d{2})(\d{2})[t\- ](\d{2}):?(\d{2})(?::?(\d{2})(?:[.,](\d+))?)?" + _ZONE + "$", (1, 2, 3, 4, 5, 6, 7, 0, 8)),
    "digits": (r"^(\d{4})(\d{2})(\d{2})(?:(\d{2})(\d{2})(\d{2})?)?$", (1, 2, 3, 4, 5, 6, 0, 0, 0)),
    "numeric": (rf"(?i)^(\d{{1,2}})[-/.](\d{{1,2}})[-/.](\d{{4}})(?:{_TIME})?{_ZONE}$", (3, 1, 2, 4, 5, 6, 7, 8, 9)),
    "dmony": (rf"(?i)^{_DAY}(\d{{1,2}})(?:st|nd|rd|th)?[-\s]+{_MONTH}[-,\s]+(\d{{4}})(?:{_TIME})?{_ZONE}$", (3, 2, 1, 4, 5, 6, 7, 8, 9)),
    "mondy": (rf"(?i)^{_DAY}{_MONTH}\s+(\d{{1,2}})(?:st|nd|rd|th)?,?\s+(\d{{4}})(?:{_TIME})?{_ZONE}$", (3, 1, 2, 4, 5, 6, 7, 8, 9)),
}


def _local_us(y: Column, m: Column, d: Column, hh: Column, mi: Column, ss: Column, us: Column, half: Column) -> Column:
    """Wall time as microseconds since 1970-01-01 00:00 of the same wall clock; null unless date and time are real (24:00 is the next day's start)."""
    plain = F.when(hh.between(0, 23) | (hh == 24) & (mi == 0) & (ss == 0), hh)
    h = F.when(half == "", plain).when(hh.between(1, 12), hh % 12 + F.when(half == "p", 12).otherwise(0))
    first = F.when(y.between(1, 9999) & m.between(1, 12), F.make_date(y, m, F.lit(1)))
    real = (d >= 1) & (d <= F.day(F.last_day(first))) & mi.between(0, 59) & ss.between(0, 59)
    days = F.unix_date(first).cast("long") + d - 1
    return F.when(real, (((days * 24 + h) * 60 + mi) * 60 + ss) * F.lit(1_000_000).cast("long") + us)


def zone_names(spark: SparkSession) -> list[str]:
    """All names of the zone database as Spark knows it."""
    return sorted(spark._jvm.java.time.ZoneId.getAvailableZoneIds())


_SEP = "\u0001"


def with_interpretations(df: DataFrame, text: str, order: str, home: str, out: str) -> DataFrame:
    """``df`` with all valid readings of ``text`` in ``out``: array of (fmt, cost, epoch_us).

    ``order`` is the source's declared order ('MDY', 'DMY', 'YMD' or null), ``home`` its zone (null or no name of
    the zone database: UTC is assumed, at a cost). The work is staged in projections so that each text is matched
    against one pattern, once.
    """
    s = F.trim(F.col(text), F.lit(BLANKS))
    stage = df.withColumn("_s", s)
    parts = F.lit(None).cast("array<string>")
    for shape, (pattern, at) in reversed(SHAPES.items()):
        groups = _SEP.join([shape, *(f"${i}" if i else "" for i in at)])
        parts = F.when(F.col("_s").rlike(GUARDS[shape]), F.split(F.regexp_replace("_s", pattern, groups), _SEP)).otherwise(parts)
    stage = stage.withColumn("_p", parts)
    field = lambda i: F.when(F.size("_p") == 10, F.col("_p")[i])
    number = lambda i: field(i).try_cast("int")
    month = F.coalesce(number(2), F.nullif(F.array_position(F.array(*[F.lit(m) for m in MONTHS]), F.lower(F.substring(field(2), 1, 3))), F.lit(0)).cast("int"))
    # an offset before a region decides
    z = F.upper(F.regexp_replace(F.regexp_replace(field(9), r"(?<=\d)\[.*", ""), r"[\[\]()]", ""))
    stage = stage.select(
        *df.columns,
        "_s",
        field(0).alias("_shape"),
        number(1).alias("_y"),
        month.alias("_m"),
        number(3).alias("_d"),
        *[F.coalesce(number(i), F.lit(0)).alias(n) for i, n in ((4, "_hh"), (5, "_mi"), (6, "_ss"))],
        F.coalesce(F.rpad(F.substring(F.nullif(field(7), F.lit("")), 1, 6), 6, "0").try_cast("int"), F.lit(0)).alias("_us"),
        F.lower(F.substring(field(8), 1, 1)).alias("_half"),
        z.alias("_z"),
    )
    names = zone_names(df.sparkSession)
    places = F.create_map(*[F.lit(x) for z in names if "/" in z for x in (z.lower(), z)])
    at_home = F.when(F.col(home).isin(names), F.col(home))
    letters = F.create_map(*[F.lit(x) for kv in ZONE_MINUTES.items() for x in kv])
    regions = F.create_map(*[F.lit(x) for kv in ZONE_REGIONS.items() for x in kv])
    offset = r"^(?:UTC|GMT)?([-+−])(\d{1,2}?):?(\d{2})?$"
    part = lambda i: F.regexp_extract("_z", offset, i)
    east = F.when(part(1) == "+", 1).otherwise(-1) * (part(2).try_cast("int") * 60 + F.coalesce(part(3).try_cast("int"), F.lit(0)))
    numeric = F.col("_shape") == "numeric"
    time = [F.col(c) for c in ("_hh", "_mi", "_ss", "_us", "_half")]
    stage = stage.select(
        *df.columns,
        "_s",
        "_shape",
        F.coalesce(F.try_element_at(letters, F.col("_z")), F.when(F.col("_z").rlike(r"\d"), F.when(east.between(-1080, 1080), east))).alias("_east"),
        F.when(F.col("_z") == "", F.coalesce(at_home, F.lit("UTC"))).when(F.col("_z").contains("/"), F.try_element_at(places, F.lower("_z"))).otherwise(F.try_element_at(regions, F.col("_z"))).alias("_region"),
        F.when((F.col("_z") == "") & at_home.isNull(), VIOLATION).otherwise(0.0).alias("_assumed"),
        _local_us(F.col("_y"), F.col("_m"), F.col("_d"), *time).alias("_as"),
        F.when(numeric, _local_us(F.col("_y"), F.col("_d"), F.col("_m"), *time)).alias("_swapped"),
        F.regexp_extract("_s", r"^(\d+)(?:\.(\d*))?$", 1).alias("_number"),
        F.rpad(F.substring(F.regexp_extract("_s", r"^(\d+)(?:\.(\d*))?$", 2), 1, 6), 6, "0").try_cast("int").alias("_fraction"),
    )

    def instant(local: str) -> Column:
        """A doubled wall time of a region is its first occurrence, a skipped one moves on by the gap: the rule of to_utc_timestamp."""
        by_region = F.unix_micros(F.to_utc_timestamp(F.timestamp_micros(F.col(local)), F.col("_region")))
        return F.when(F.col("_east").isNotNull(), F.col(local) - F.col("_east").cast("long") * 60_000_000).when(F.col("_region").isNotNull(), by_region)

    def declared(fmt: str) -> Column:
        return F.when(numeric & (F.upper(F.col(order)) != fmt), VIOLATION).otherwise(0.0) + F.col("_assumed")

    reading = lambda fmt, cost, us: F.struct(fmt.alias("fmt"), cost.alias("cost"), us.alias("epoch_us"))
    found = [
        reading(F.when(numeric, "MDY").otherwise(F.col("_shape")), declared("MDY"), instant("_as")),
        reading(F.lit("DMY"), declared("DMY"), instant("_swapped")),
    ]
    # a count by its shape: 9 to 11 digits are seconds, 12 to 14 milliseconds, 15 to 17 microseconds;
    # 8, 12 and 14 digits that make a calendar date or time are rather that
    width = F.length("_number")
    n = F.when(width <= 17, F.col("_number").try_cast("long"))
    for name, low, high, unit in (("s", 9, 11, 1_000_000), ("ms", 12, 14, 1_000), ("us", 15, 17, 1)):
        us = F.when(width.between(low, high), n * F.lit(unit).cast("long") + (F.coalesce("_fraction", F.lit(0)) if name == "s" else 0))
        found.append(reading(F.lit(name), F.when(F.col("_as").isNotNull(), VIOLATION).otherwise(0.0), us))
    return once(stage, **{out: F.filter(F.array(*found), lambda x: x["epoch_us"].isNotNull())}).select(*df.columns, out)


GUARDS = {
    "ymd": r"^\d{4}[-/.]",
    "compact": r"^\d{8}\D",
    "digits": r"^(?:\d{8}|\d{12}|\d{14})$",
    "numeric": r"^\d{1,2}[-/.]\d{1,2}[-/.]\d{4}",
    "dmony": r"^(?:[A-Za-z]+\.?,?\s+)?\d{1,2}(?:st|nd|rd|th)?[-\s]+[A-Za-z]",
    "mondy": r"(?i)^(?:[a-z]+\.?,?\s+)?[a-z]+\.?\s+\d",
}


def prune(cands: Column) -> Column:
    """Drops readings that can never be on the cheapest path, and repeated ones (same instant and format)."""
    low = F.array_min(F.transform(cands, lambda x: x["cost"]))
    kept = F.filter(cands, lambda x: x["cost"] <= low + 2 * (SWITCH + BACK))
    instants = F.array_distinct(F.transform(kept, lambda x: x["epoch_us"]))
    return F.when(F.size(instants) == 1, F.slice(kept, 1, 1)).otherwise(kept)


def _step(prev: list, cur: list, costs: list[list[float]]) -> tuple[list[list[float]], list[list[int]]]:
    """Extends path costs (one row per entry state) from the states ``prev`` to ``cur``; with back pointers."""
    move = [[SWITCH * (p["fmt"] != c["fmt"]) + BACK * (c["epoch_us"] < p["epoch_us"]) + c["cost"] for c in cur] for p in prev]
    out, back = [], []
    for row in costs:
        tries = [min((row[i] + move[i][j], i) for i in range(len(prev))) for j in range(len(cur))]
        out.append([v for v, _ in tries])
        back.append([i for _, i in tries])
    return out, back


def _identity(n: int) -> list[list[float]]:
    return [[0.0 if i == j else float("inf") for j in range(n)] for i in range(n)]


def _block_transfer(pdf: pd.DataFrame) -> list[list[float]]:
    """Costs from each state of the block's first row to each of its last."""
    states = list(pdf["cands"])
    costs = _identity(len(states[0]))
    for a, b in zip(states, states[1:], strict=False):
        costs, _ = _step(a, b, costs)
    return costs


def _through(costs: list, matrix: list) -> tuple[list[list[float]], list[list[int]]]:
    """Path costs carried through a block (min-plus product), with the state each came in by."""
    out, by = [], []
    for row in costs:
        tries = [min((row[k] + matrix[k][j], k) for k in range(len(row))) for j in range(len(matrix[0]))]
        out.append([v for v, _ in tries])
        by.append([k for _, k in tries])
    return out, by


def _chain_transfer(firsts: list, lasts: list, matrices: list) -> list[list[float]]:
    """The transfer of neighbouring blocks taken as one."""
    costs = _identity(len(firsts[0]))
    for i, m in enumerate(matrices):
        costs, _ = _through(costs, m)
        if i + 1 < len(firsts):
            costs, _ = _step(lasts[i], firsts[i + 1], costs)
    return costs


def _chain_states(firsts: list, lasts: list, matrices: list, start: int | None = None, end: int | None = None) -> list[tuple[int, int]]:
    """The states in which the cheapest path enters and leaves each of neighbouring blocks, its two ends given or free."""
    costs = [[c["cost"] if start in (None, k) else float("inf") for k, c in enumerate(firsts[0])]]
    came, moved = [], []
    for i, m in enumerate(matrices):
        costs, by = _through(costs, m)
        came.append(by[0])
        if i + 1 < len(firsts):
            costs, back = _step(lasts[i], firsts[i + 1], costs)
            moved.append(back[0])
    state = end if end is not None else min(range(len(costs[0])), key=lambda j: costs[0][j])
    out = []
    for i in reversed(range(len(firsts))):
        entry = came[i][state]
        out.append((entry, state))
        if i:
            state = moved[i - 1][entry]
    return out[::-1]


def choose(df: DataFrame, source: Sequence[str], order: Sequence[str], cands: str) -> DataFrame:
    """``df`` with ``epoch_us`` in place of ``cands``: the readings on the cheapest path through each source.

    Rows of chains in which anything is open are sorted by source and record order and cut into blocks of
    ``BLOCK`` by count, so no task walks more than that and their parts, whatever the values of ``order``; as many blocks make a
    run; of the runs there is one row each. Only blocks with an open row are walked through.
    """
    rows = once(df.filter(F.size(cands) > 0), **{cands: prune(F.col(cands))})
    # the chain as one key that is never null
    numbers = F.exists(cands, lambda x: x["fmt"].isin("MDY", "DMY"))
    rows, seen = cut(rows.withColumn("_k", F.to_json(F.struct(*source, numbers.alias("_numbers")))), open=F.size(cands) > 1)
    plain = [c for c in df.columns if c != cands]
    settled = rows.filter(F.size(cands) == 1).select(*plain, F.col(cands)[0]["epoch_us"].alias("epoch_us"))
    if not seen["open"]:
        return settled
    chains = rows.groupBy("_k").agg(F.max(F.size(cands)).alias("_most")).filter("_most > 1").select("_k")
    place = ["_k", *order, "_t"]
    rows = rows.withColumn("_t", F.monotonically_increasing_id()).join(chains, "_k", "left_semi")
    # a row's number holds its partition in the high bits, so that blocks follow each other in order
    rows = cut(rows.repartitionByRange(*place).sortWithinPartitions(*place).withColumn("_b", F.floor(F.monotonically_increasing_id() / BLOCK)))
    keys = ["_k", "_b"]
    at = F.struct(*order, "_t")
    blocks = rows.groupBy(*keys).agg(F.max(F.size(cands)).alias("_open"), F.min_by(cands, at).alias("_first"), F.max_by(cands, at).alias("_last"))
    open_blocks = blocks.filter("_open > 1").select(*keys)
    walked = rows.join(open_blocks, keys, "left_semi")
    kinds = dict(df.dtypes)
    key_ddl = "_k string, _b bigint"

    def transfer(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values([*order, "_t"], na_position="first").rename(columns={cands: "cands"})
        return pd.DataFrame([{**{k: pdf[k].iloc[0] for k in keys}, "_m": _block_transfer(pdf)}])

    matrices = walked.groupBy(*keys).applyInPandas(transfer, f"{key_ddl}, _m array<array<double>>")
    # one row per block from here: first and last states and, where open, the costs between them
    chain = blocks.join(matrices, keys, "left").select(*keys, "_first", "_last", "_m", F.floor(F.col("_b") / BLOCK).alias("_r"))

    def parts(pdf: pd.DataFrame) -> tuple[list, list, list]:
        return list(pdf["_first"]), list(pdf["_last"]), [m if m is not None else [[0.0]] for m in pdf["_m"]]

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_b")
        firsts, lasts, ms = parts(pdf)
        return pd.DataFrame([{"_k": pdf["_k"].iloc[0], "_r": pdf["_r"].iloc[0], "_first": firsts[0], "_last": lasts[-1], "_m": _chain_transfer(firsts, lasts, ms)}])

    def link_runs(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_r")
        states = _chain_states(*parts(pdf))
        return pdf[["_k", "_r"]].assign(_rin=[a for a, _ in states], _rout=[b for _, b in states])

    def link_blocks(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_b")
        states = _chain_states(*parts(pdf), int(pdf["_rin"].iloc[0]), int(pdf["_rout"].iloc[0]))
        return pdf[keys].assign(_in=[a for a, _ in states], _out=[b for _, b in states])

    state = dict(rows.dtypes)[cands]
    runs = chain.groupBy("_k", "_r").applyInPandas(run, f"_k string, _r bigint, _first {state}, _last {state}, _m array<array<double>>")
    run_ends = runs.groupBy("_k").applyInPandas(link_runs, f"_k string, _r bigint, _rin int, _rout int")
    ends = chain.join(run_ends, ["_k", "_r"]).groupBy("_k", "_r").applyInPandas(link_blocks, f"{key_ddl}, _in int, _out int")
    out_ddl = ", ".join([*(f"`{c}` {kinds[c]}" for c in plain), "_n int", "epoch_us bigint"])

    def walk(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values([*order, "_t"], na_position="first").reset_index(drop=True)
        states = list(pdf[cands])
        start, end = int(pdf["_in"].iloc[0]), int(pdf["_out"].iloc[0])
        costs = [[0.0 if j == start else float("inf") for j in range(len(states[0]))]]
        backs = []
        for a, b in zip(states, states[1:], strict=False):
            costs, back = _step(a, b, costs)
            backs.append(back[0])
        picks = [end]
        for back in reversed(backs):
            picks.append(back[picks[-1]])
        picks.reverse()
        out = pdf[plain].copy()
        out["_n"] = [len(s) for s in states]
        out["epoch_us"] = [s[p]["epoch_us"] for s, p in zip(states, picks, strict=True)]
        return out

    picked = walked.join(ends, keys).groupBy(*keys).applyInPandas(walk, out_ddl).filter("_n > 1")
    return settled.unionByName(picked.select(*plain, "epoch_us"))


def normalise_instants(df: DataFrame, text: str, source: Sequence[str], order: Sequence[str], date_order: str, home_zone: str) -> DataFrame:
    """Rows ``(*source, *order, epoch_us)``; texts that state no real date give no row.

    Null and empty texts state none, whatever stands around a date but white space makes it none, however long; ties in ``order`` are broken
    by its further columns and then as they come; a null in ``source`` is a source of its own, a null in ``order`` comes before all others; an empty table gives
    an empty one; other columns are never read, repeated rows each give theirs.
    """
    df = df.select(*source, *order, text, date_order, home_zone)
    cands = with_interpretations(df, text, date_order, home_zone, "_cands").drop(text, date_order, home_zone)
    return choose(cands, source, order, "_cands")
