"""Text cleaners."""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Callable
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# The characters that count as blanks at the ends of a text.
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0"
    "\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# The 27 states.
STATES = (
    "AC", "AL", "AP", "AM", "BA", "CE", "DF", "ES", "GO", "MA", "MT", "MS", "MG", "PA",
    "PB", "PR", "PE", "PI", "RJ", "RN", "RO", "RS", "RR", "SC", "SE", "SP", "TO",
)

# Fixed value: the shape of an address that passes the basic check.
EMAIL_BASIC = r"(?U)^[^\s@]+@[^\s@]+\.[^\s@]+$"


def once(c: Column, body: Callable[[Column], Column]) -> Column:
    """``body(c)`` with ``c`` in the plan once.

    Spark repeats an expression wherever a column built from it is used, and again in each
    filter it pushes down. A check of 27 digits would repeat its input 27 times.
    """
    return F.get(F.transform(F.array(c), body), F.lit(0))


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(BLANKS))


def digits(c: Column) -> Column:
    """Only the digits; '' when there are none. Text that is all digits is not rewritten."""
    return F.when(c.rlike(r"^[0-9]*\z"), c).otherwise(F.regexp_replace(c, "[^0-9]+", ""))


def digits_or_null(c: Column) -> Column:
    return F.nullif(digits(c), F.lit(""))


def blank_to_null(c: Column) -> Column:
    return F.nullif(strip(c), F.lit(""))


def digits_of_length(c: Column, n: int) -> Column:
    kept = F.regexp_replace(c, "[^0-9]+", "")
    return F.when(c.rlike(rf"^[0-9]{{{n}}}\z"), c).when(F.length(kept) == n, kept)


def state(c: Column, allowed: tuple[str, ...] = STATES) -> Column:
    s = F.upper(strip(c))
    return F.when(s.isin(*allowed), s)


def decimal_comma(c: Column, precision: int = 18, scale: int = 2) -> Column:
    """'1.234,56' -> 1234.56. Every dot goes, so '1000.50' reads as 100050."""
    plain = F.replace(F.replace(strip(c), F.lit("."), F.lit("")), F.lit(","), F.lit("."))
    return plain.try_cast(f"decimal({precision},{scale})")


def ymd_date(c: Column) -> Column:
    """'20240101' -> date; anything else, or a day that does not exist, -> null."""
    return F.try_to_date(c, "yyyyMMdd")


def email(c: Column) -> Column:
    t = F.lower(strip(c))
    return F.when(t.rlike(EMAIL_BASIC), t)


_LABEL = "[A-Za-z0-9](?:[A-Za-z0-9-]{0,61}[A-Za-z0-9])?"
_LAST = "[A-Za-z0-9][A-Za-z0-9-]{0,61}[A-Za-z0-9]"
EMAIL_STRICT = (
    r"(?U)^[A-Za-z0-9_%+-]+(?:\.[A-Za-z0-9_%+-]+)*"
    rf"@\s*(?:{_LABEL}\.)+{_LAST}\.*\z"
)


def email_strict(c: Column) -> Column:
    """One '@'; dots only between local parts; a domain of two or more legal labels.

    The domain becomes lower case and loses dots at its end.
    """
    t = strip(c)
    domain = F.rtrim(F.lower(strip(F.substring_index(t, "@", -1))), F.lit("."))
    clean = F.concat(F.substring_index(t, "@", 1), F.lit("@"), domain)
    return F.when(t.rlike(EMAIL_STRICT), clean)


def email_both(c: Column) -> Column:
    """The basic rule, then the strict one: all lower case."""
    t = F.lower(strip(c))
    return F.when(t.rlike(EMAIL_BASIC) & t.rlike(EMAIL_STRICT), F.rtrim(t, F.lit(".")))


@lru_cache(maxsize=1)
def _unaccented() -> tuple[str, str]:
    """Letters of the Latin, Greek and Cyrillic blocks whose compatibility form is one
    letter plus marks, and those letters."""
    source, target = [], []
    for block in ((0x00A0, 0x0530), (0x1E00, 0x2000), (0x2100, 0x2150)):
        for code in range(*block):
            ch = chr(code)
            bare = [x for x in unicodedata.normalize("NFKD", ch) if not unicodedata.combining(x)]
            if len(bare) == 1 and bare[0] != ch:
                source.append(ch)
                target.append(bare[0])
    return "".join(source), "".join(target)


def name_key(c: Column) -> Column:
    """Key for matching names: trimmed, lower case, without accents."""
    source, target = _unaccented()
    return F.regexp_replace(F.translate(F.lower(strip(c)), source, target), r"\p{Mn}", "")


@lru_cache(maxsize=1)
def _combining_marks() -> dict[int, None]:
    return {i: None for i in range(sys.maxunicode) if unicodedata.combining(chr(i))}


def name_key_exact(c: Column) -> Column:
    """``name_key`` for scripts outside the Latin, Greek and Cyrillic blocks (Arrow UDF)."""

    @F.pandas_udf(StringType())
    def key(s: pd.Series) -> pd.Series:
        bare = s.str.strip().str.lower().str.normalize("NFKD")
        return bare.str.translate(_combining_marks())

    return key(c)
