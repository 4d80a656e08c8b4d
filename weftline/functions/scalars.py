"""Scalar functions of contract resolution, as Column to Column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from weftline.functions.text import BLANKS

SEPARATOR = "\u0000"


def slug(text: Column, most: int | None = None) -> Column:
    """Lower case letters and digits, words joined by hyphens."""
    kept = F.trim(F.regexp_replace(F.lower(text), r"[^a-z0-9\s]", ""))
    joined = F.regexp_replace(kept, r"\s+", "-")
    return joined if most is None else F.left(joined, F.lit(most))


def security_symbol(title: Column, outcome: Column, expiry: Column) -> Column:
    """TITLE[-YYYYMMDDTHH]-OUTCOME as slugs, the title's cut at 80; the hour part only where the expiry is set."""
    return F.upper(F.concat_ws("-", slug(title, 80), F.date_format(expiry, "yyyyMMdd'T'HH"), slug(outcome)))


def parse_utc(text: Column) -> Column:
    """ISO text as an instant; without a zone it is UTC; null where it is none (a bare year is none)."""
    t = F.trim(text)
    return F.when(t.rlike(r"^\d{4}-\d{2}-\d{2}([T ].*)?$"), t.try_cast("timestamp"))


def expiry_close(a: Column, b: Column, tolerance_s: int) -> Column:
    """Both null: true; one null: false; else whether they are at most the tolerance apart."""
    apart = F.abs(F.unix_micros(a) - F.unix_micros(b)) <= F.lit(tolerance_s * 1_000_000)
    return F.when(a.isNull() & b.isNull(), True).when(a.isNull() | b.isNull(), False).otherwise(apart)


def contract_hash(*parts: Column) -> Column:
    """Change detection: the first 16 hex digits of SHA-256 over the parts, null as empty text."""
    return F.left(F.sha2(F.concat_ws(SEPARATOR, *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]), 256), F.lit(16))


def title_key(title: Column) -> Column:
    return F.left(F.sha2(title, 256), F.lit(6))


def _side(title: Column, labels: Column) -> Column:
    return F.concat_ws(SEPARATOR, title, F.array_join(F.array_sort(labels), "|"))


def pair_key(model: Column, title_a: Column, labels_a: Column, title_b: Column, labels_b: Column) -> Column:
    """Hash of two titled label lists under a model that does not depend on their order (nor on the labels')."""
    a, b = _side(title_a, labels_a), _side(title_b, labels_b)
    return F.sha2(F.concat_ws(SEPARATOR, model, F.least(a, b), F.greatest(a, b)), 256)


def first_is_a(title_a: Column, labels_a: Column, title_b: Column, labels_b: Column) -> Column:
    """Orientation in which a symmetric entry is stored."""
    return _side(title_a, labels_a) <= _side(title_b, labels_b)


def canonical_key(model: Column, exchange: Column, native: Column) -> Column:
    return F.sha2(F.concat_ws(SEPARATOR, model, exchange.cast("string"), native), 256)


def strip_code_fences(text: Column) -> Column:
    """What stands inside a fenced block; unfenced text as it is; outer white space of any kind is off."""
    bare = lambda c: F.trim(c, F.lit(BLANKS))
    t = bare(text)
    return F.when(t.startswith("```"), bare(F.regexp_extract(t, r"(?s)^```[^\n]*\n(.*?)(?:\n?```\s*)?$", 1))).otherwise(t)


def embedding_text(title: Column, description: Column) -> Column:
    return F.when(F.coalesce(description, F.lit("")) != "", F.concat(title, F.lit(". "), F.left(description, F.lit(200)))).otherwise(title)


def cosine(a: Column, b: Column) -> Column:
    """In double precision; 0 where a vector is all zero."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    norm = F.sqrt(dot(a, a) * dot(b, b))
    return F.when(norm > 0, dot(a, b) / norm).otherwise(0.0)


def native_key(exchange: Column, native: Column) -> Column:
    return F.concat_ws(":", exchange.cast("string"), native)


def split_native_key(key: Column) -> tuple[Column, Column]:
    """(exchange_id, native id); the native id may hold colons."""
    parts = F.split(key, ":", 2)
    return parts[0].try_cast("long"), F.get(parts, F.lit(1))


def or_default(text: Column, default: str) -> Column:
    """Null and empty text give the default."""
    return F.coalesce(F.nullif(text, F.lit("")), F.lit(default))


def title_case(text: Column) -> Column:
    """Every run of letters with a capital first, whatever stands between the runs."""
    return F.array_join(F.transform(F.regexp_extract_all(text, F.lit("([A-Za-z]+|[^A-Za-z]+)"), F.lit(1)), F.initcap), "")


def key_values(text: Column) -> Column:
    """``k:v|k:v`` as a map; the last of a repeated key wins, parts without a colon are left out."""
    parts = F.filter(F.split(F.coalesce(text, F.lit("")), r"\|"), lambda p: p.contains(":"))
    pairs = F.transform(parts, lambda p: F.struct(F.trim(F.substring_index(p, ":", 1)).alias("key"), F.trim(F.regexp_replace(p, "^[^:]*:", "")).alias("value")))
    last = F.filter(pairs, lambda x, i: ~F.exists(F.slice(pairs, i + 2, F.greatest(F.size(pairs) - i - 1, F.lit(0))), lambda y: y["key"] == x["key"]))
    return F.map_from_entries(last)
