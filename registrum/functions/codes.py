"""Activity codes, code lists and their array literals."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from registrum.functions.text import digits, digits_of_length, once, strip


def _or_null(items: Column) -> Column:
    return once(items, lambda x: F.when(F.size(x) > 0, x))


def activity_code(c: Column, length: int = 7) -> Column:
    return digits_of_length(c, length).try_cast("int")


def split_list(c: Column) -> Column:
    """Parts between ';' or ',', trimmed, blanks dropped; none -> null."""
    # One plain character to split at costs less than a pattern.
    parts = F.transform(F.split(F.replace(c, F.lit(";"), F.lit(",")), ","), strip)
    return _or_null(F.filter(parts, lambda x: x != ""))


def codes_in(items: Column, length: int = 7) -> Column:
    """Of an array of texts, those with exactly ``length`` digits; order and repeats kept."""
    return _or_null(F.filter(F.transform(items, digits), lambda x: F.length(x) == length))


def code_list(c: Column, length: int = 7) -> Column:
    """Codes of '{a,b}' (commas only) or 'a;b,c'."""
    braced = r"(?s)^\{.*\}\z"
    parts = once(
        strip(c),
        lambda t: F.when(t.rlike(braced), F.split(t, ",")).otherwise(F.split(t, "[;,]")),
    )
    return codes_in(parts, length)


def code_set(items: Column) -> Column:
    """Distinct codes in ascending order; one that is no integer makes the list null."""
    numbers = F.transform(items, lambda x: x.try_cast("int"))
    in_order = F.array_sort(F.array_distinct(numbers))
    return once(
        in_order,
        lambda x: F.when((F.size(x) > 0) & ~F.exists(x, lambda n: n.isNull()), x),
    )


def is_array_literal(c: Column) -> Column:
    return (c.startswith("{") & c.endswith("}")) | (c == "")


def array_items(c: Column) -> Column:
    """Texts inside '{a,b}', empty ones skipped; not braced -> null."""
    t = strip(c)
    body = F.regexp_extract(t, r"(?s)^\{(.*)\}\z", 1)
    items = F.filter(F.split(body, ","), lambda x: x != "")
    return F.when(t.startswith("{") & t.endswith("}"), items)


def code_set_of_literal(c: Column) -> Column:
    return code_set(array_items(c))


def array_literal(items: Column) -> Column:
    return F.concat(F.lit("{"), F.array_join(items.cast("array<string>"), ","), F.lit("}"))
