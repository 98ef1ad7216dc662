"""Area codes and phone numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

AREA_LENGTHS = (2, 3)
PHONE_LENGTHS = (8, 11)


def area_code(c: Column) -> Column:
    return F.when(F.length(c).isin(*AREA_LENGTHS), c)


def phone(c: Column) -> Column:
    return F.when(F.length(c).between(*PHONE_LENGTHS), c)


def e164(area: Column, number: Column, country: str = "55") -> Column:
    """+<country><area><number> when both parts are all digits and of legal length."""
    shortest, longest = PHONE_LENGTHS
    legal = area.rlike(r"^[0-9]{2,3}\z") & number.rlike(rf"^[0-9]{{{shortest},{longest}}}\z")
    return F.when(legal, F.concat(F.lit(f"+{country}"), area, number))
