"""Several values packed in one field: one row per value with its position.

A text either delimits itself (JSON list, quoted list, brace list) or its delimiter has to be
inferred. Candidates are scored on piece-count consistency (with the fields that must hold as
many values), on the regularity of the piece types (equal kind, pieces that occur as whole
values elsewhere in the source) and on how often the source uses the candidate where it is
the only possible one. Nothing here depends on a list of known values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.functions.text import BLANKS
from weftline.session import cut, once

#: name -> regex class or sequence that separates pieces; in order of preference at equal scores.
DELIMITERS = {"tab": r"\t", "line": r"\n", "bar": r"\|", "semicolon": ";", "comma": ",", "slash": r" / ", "mixed": r"; |, | \| "}
#: What must stand in a text for a delimiter to part it; for the mixed one two of these.
SIGNS = {"tab": "\t", "line": "\n", "bar": "|", "semicolon": ";", "comma": ",", "slash": " / "}
_MIXED = ("; ", ", ", " | ")

# quantifiers are possessive throughout: they loop where others recurse, so very long texts do no harm
_QUOTED = r'"(?:[^"\\]++|\\.|"")*+"'


def _pieces(c: Column, name: str) -> Column:
    d = DELIMITERS[name]
    if name == "slash":
        return F.split(c, d)
    if name == "mixed":
        return F.regexp_extract_all(c, F.lit(rf'((?:{_QUOTED}|(?!{d}|\| )[^"])++)'), F.lit(1))
    return F.regexp_extract_all(c, F.lit(rf'((?:[^"{d}]++|{_QUOTED}|"(?=[^"]*+$))++)'), F.lit(1))


def _bare(p: Column) -> Column:
    return F.trim(p, F.lit(BLANKS))


def _unquoted(t: Column) -> Column:
    """One pair of quotes and the escapes inside it off a trimmed piece."""
    inner = F.substring(t, F.lit(2), F.length(t) - 2)
    double = F.regexp_replace(F.regexp_replace(inner, '""', '"'), r"\\(.)", "$1")
    single = F.regexp_replace(inner, r"\\(.)", "$1")
    quoted = F.when(t.rlike(rf"(?s)^{_QUOTED}$"), _bare(double)).when(t.rlike(r"(?s)^'(?:[^'\\]++|\\.)*+'$"), _bare(single)).otherwise(t)
    return F.when(t.startswith('"') | t.startswith("'"), quoted).otherwise(t)


def _cleaned(pieces: Column) -> Column:
    """Pieces without outer white space, quotes and escapes; empty ones left out. Each step is a pass of its own, so nothing is worked out twice."""
    return F.filter(F.transform(F.transform(pieces, _bare), _unquoted), lambda x: x.isNotNull() & (x != ""))


def _self_delimited(c: Column) -> Column:
    """Values of a text that shows its own structure, else null."""
    t = _bare(c)
    body = F.substring(t, F.lit(2), F.length(t) - 2)
    listed = F.regexp_extract_all(body, F.lit(r"""((?:[^,'"]++|'(?:[^'\\]++|\\.)*+'|"(?:[^"\\]++|\\.)*+"|['"])++)"""), F.lit(1))
    braced = F.filter(
        F.regexp_extract_all(body, F.lit(r'((?:[^,"]++|"(?:[^"\\]++|\\.)*+")++)'), F.lit(1)), lambda x: F.upper(F.trim(x)) != "NULL"
    )
    json = F.from_json(t, "array<string>")
    return (
        F.when(t == "", F.array().cast("array<string>"))
        .when(
            t.rlike(r"(?s)^\[.*\]$"),
            F.when(json.isNotNull() & ~t.rlike(r"(?s)^\[\s*'"), _trimmed(json)).otherwise(_cleaned(listed)),
        )
        .when(t.rlike(r"(?s)^\{.*\}$"), _cleaned(braced))
    )


def _trimmed(values: Column) -> Column:
    return F.filter(F.transform(values, _bare), lambda x: x.isNotNull() & (x != ""))


def _all_numbers(values: Column) -> Column:
    return F.forall(values, lambda x: x.rlike(r"^\d+$"))


def split_packed(df: DataFrame, keys: Sequence[str], source: str, fields: Sequence[str]) -> DataFrame:
    """Rows ``(*keys, field, value_pos, value)`` of the packed ``fields`` of ``df``, position from 0.

    The fields of one row should hold equally many values; that is the consistency that is
    scored. Null and empty texts give no rows, empty pieces are no values and take no position,
    a text without any fitting delimiter is one value. ``keys`` name a row; repeated rows with
    unlike keys each stand for themselves. Other columns are never read; an empty table gives no rows.
    """
    src, ids = F.col(source), [F.col(k) for k in keys]
    # one stage after the other, so that what a later one reads twice is worked out once
    base = once(df.select(*ids, src.alias("_source"), *[F.col(f) for f in fields]), **{f"_own_{f}": _self_delimited(F.col(f)) for f in fields})
    base = once(base, **{f"_c_{f}": F.when(F.col(f"_own_{f}").isNull() & F.col(f).isNotNull(), _splits(F.col(f))) for f in fields})
    base = once(base, **{f"_c_{f}": _whole(F.col(f), F.col(f"_c_{f}")) for f in fields})
    base = once(base, **{f"_c_{f}": _regular(F.col(f"_c_{f}")) for f in fields})

    def others(f: str) -> Column:
        """Counts that the other fields allow: exact where they delimit themselves, else those of their candidates."""
        allowed = [
            F.when(F.col(o).isNull(), F.array().cast("array<int>"))
            .when(F.col(f"_own_{o}").isNotNull(), F.array(F.size(F.col(f"_own_{o}"))))
            .otherwise(F.transform(F.col(f"_c_{o}"), lambda x: F.size(x["values"])))
            for o in fields
            if o != f
        ]
        return F.flatten(F.array(*allowed)) if allowed else F.array().cast("array<int>")

    rows = base.select(
        *ids,
        "_source",
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(f).alias("field"), F.col(f"_own_{f}").alias("_own"), F.col(f"_c_{f}").alias("_cand"), others(f).alias("_allowed"))
                    for f in fields
                ]
            )
        ),
    ).filter(F.col("_own").isNotNull() | F.col("_cand").isNotNull())
    fitting = F.filter(F.col("_cand"), lambda x: F.array_contains(F.col("_allowed"), F.size(x["values"])))
    rows = rows.withColumn("_cand", F.when(F.size(fitting) > 0, fitting).otherwise(F.col("_cand")))
    # an unsplit text counts only where no delimiter gives a fitting number of pieces
    parted = F.filter(F.col("_cand"), lambda x: x["by"] != "none")
    rows = rows.withColumn("_cand", F.when(F.size(parted) > 0, parted).otherwise(F.col("_cand")))
    # five plans read what the candidates are; they are worked out once
    rows = cut(once(rows, _cand=F.col("_cand"))).withColumn("_open", F.size("_cand") > 1)

    clear = rows.filter(~F.coalesce(F.col("_open"), F.lit(False))).select(*ids, "_source", "field", F.coalesce("_own", F.col("_cand")[0]["values"]).alias("_values"), F.when(F.col("_own").isNull(), F.col("_cand")[0]["by"]).alias("_by"))
    # only texts that stay open meet the statistics of their source: how many of a candidate's
    # pieces occur as whole values in clear texts, and how often the source uses the delimiter
    tie = F.xxhash64(*ids, F.col("field"))
    opened = rows.filter("_open").select(*ids, "_source", "field", tie.alias("_row"), F.posexplode("_cand").alias("_no", "_x"))
    pieces = opened.select("_source", "field", *ids, "_row", "_no", F.explode("_x.values").alias("_piece"))
    known = (
        clear.select("_source", "field", F.explode("_values").alias("_piece"))
        .join(pieces.select("_source", "field", "_piece").distinct(), ["_source", "field", "_piece"], "left_semi")
        .groupBy("_source", "field", "_piece")
        .agg(F.count(F.lit(1)).alias("_times"))
    )
    used = clear.filter(F.col("_by").isNotNull() & (F.size("_values") > 1)).groupBy("_source", "field", "_by").agg(F.count(F.lit(1)).alias("_used"))
    regular = (
        pieces.join(known, ["_source", "field", "_piece"], "left")
        .groupBy(*ids, "_source", "field", "_no")
        .agg(F.sum(F.coalesce(F.log2(1 + F.col("_times")), F.lit(0.0))).alias("_known"), F.sum(F.when(F.col("_times").isNull(), 1).otherwise(0)).alias("_unknown"))
    )
    scored = (
        opened.withColumn("_by", F.col("_x.by"))
        .join(used, ["_source", "field", "_by"], "left")
        .withColumnsRenamed({k: f"_k{i}" for i, k in enumerate(keys)})
        .join(
            regular.withColumnsRenamed({k: f"_r{i}" for i, k in enumerate(keys)} | {"_source": "_rs", "field": "_rf", "_no": "_rn"}),
            F.expr(" and ".join([f"_k{i} <=> _r{i}" for i in range(len(keys))] + ["_source <=> _rs", "field = _rf", "_no = _rn"])),
            "left",
        )
    )
    key_names = [f"_k{i}" for i in range(len(keys))]
    rank = F.struct(-F.coalesce(F.col("_unknown"), F.lit(0)), F.coalesce(F.col("_known"), F.lit(0.0)), F.coalesce(F.col("_used"), F.lit(0)), -F.col("_x.nr"))
    chosen = (
        scored.groupBy(*key_names, "field")
        .agg(F.max_by(F.col("_x.values"), rank).alias("_values"))
        .withColumnsRenamed({f"_k{i}": k for i, k in enumerate(keys)})
    )
    done = clear.select(*ids, "field", "_values").unionByName(chosen.select(*ids, "field", "_values"))
    return done.select(*ids, "field", F.posexplode("_values").alias("value_pos", "value"))


def _splits(c: Column) -> Column:
    """The splits that the delimiters in a text give: array of (by, nr, values), the unsplit text always among them."""
    found = []
    for nr, name in enumerate(DELIMITERS):
        if name == "mixed":
            there = sum((c.contains(x).cast("int") for x in _MIXED[1:]), c.contains(_MIXED[0]).cast("int")) > 1
        else:
            there = c.contains(SIGNS[name])
        found.append(F.when(there, F.struct(F.lit(name).alias("by"), F.lit(nr).alias("nr"), _cleaned(_pieces(c, name)).alias("values"))))
    found.append(F.struct(F.lit("none").alias("by"), F.lit(len(DELIMITERS)).alias("nr"), F.transform(F.transform(F.array(c), _bare), _unquoted).alias("values")))
    trailing = F.rtrim(c).rlike(r"[|;,]$")
    return F.filter(
        F.array(*found),
        lambda x: x.isNotNull() & ((F.size(x["values"]) > 1) | (x["by"] == "none") | trailing & x["by"].isin("bar", "semicolon", "comma") & (F.size(x["values"]) == 1)),
    )


def _whole(c: Column, split: Column) -> Column:
    """A piece that still holds a tab or line break is none."""
    whole = F.filter(split, lambda x: (x["by"] != "none") & ~F.exists(x["values"], lambda v: v.contains("\t") | v.contains("\n")))
    return F.when((c.contains("\t") | c.contains("\n")) & (F.size(whole) > 0), whole).otherwise(split)


def _regular(split: Column) -> Column:
    """Most regular of all: every piece is a number; then no other reading counts."""
    regular = F.filter(split, lambda x: _all_numbers(x["values"]))
    return F.when(F.size(regular) > 0, F.slice(regular, 1, 1)).otherwise(split)
