"""Text functions shared by operators (JVM side unless said otherwise)."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: White space of any kind, no-break and zero-width included; trimming by this list is linear whatever a text's length.
BLANKS = "".join(chr(c) for c in (*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000, 0xFEFF))


@F.pandas_udf(T.StringType())
def _nfc(s: pd.Series) -> pd.Series:
    return s.map(lambda x: x if x is None or x.isascii() else unicodedata.normalize("NFC", x))


def nfc(c: Column) -> Column:
    """Canonical composition; Spark has no built-in for it, so an Arrow-batched UDF does it."""
    return _nfc(c)


def squeeze(c: Column) -> Column:
    """Outer white space off, every run of inner white space (no-break space included) to one space; null stays null."""
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def strip_all(c: Column) -> Column:
    """Outer white space of any kind off."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")
