"""Tax ids of persons (11 digits) and companies (14 digits).

The digit sums are short array expressions, which keeps plans small: unrolled, a company id
would take more than a hundred expressions.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from registrum.functions.text import digits, digits_of_length, once

# Weights of the digits before each of the two check digits.
PERSON_WEIGHTS = (
    (10, 9, 8, 7, 6, 5, 4, 3, 2),
    (11, 10, 9, 8, 7, 6, 5, 4, 3, 2),
)
COMPANY_WEIGHTS = (
    (5, 4, 3, 2, 9, 8, 7, 6, 5, 4, 3, 2),
    (6, 5, 4, 3, 2, 9, 8, 7, 6, 5, 4, 3, 2),
)


def _digit_sum(ds: Column, weights: tuple[int, ...]) -> Column:
    factors = F.expr(f"array({', '.join(map(str, weights))})")
    terms = F.zip_with(F.slice(ds, 1, len(weights)), factors, lambda d, w: d * w)
    return F.aggregate(terms, F.lit(0), lambda total, term: total + term)


def check_digit(ds: Column, weights: tuple[int, ...]) -> Column:
    """Modulo-11 digit of the leading digits: a remainder of 0 or 1 gives 0."""
    return (11 - _digit_sum(ds, weights) % 11) % 11 % 10


def _sums_agree(x: Column, weights: tuple[tuple[int, ...], ...]) -> Column:
    """Whether an id of the right length, all digits, ends in its check digits."""
    n = len(weights[1]) + 1
    repeated = F.replace(x, F.substring(x, 1, 1), F.lit("")) == ""

    def judge(ds: Column) -> Column:
        first = F.get(ds, F.lit(n - 2)) == check_digit(ds, weights[0])
        return first & (F.get(ds, F.lit(n - 1)) == check_digit(ds, weights[1]))

    return ~repeated & once(F.split(x, "").cast("array<int>"), judge)


def _valid(c: Column, weights: tuple[tuple[int, ...], ...]) -> Column:
    shape = rf"^[0-9]{{{len(weights[1]) + 1}}}\z"
    return once(
        c,
        lambda x: F.when(x.rlike(shape), _sums_agree(x, weights)).when(
            x.isNotNull(), F.lit(False)
        ),
    )


def person_id_valid(c: Column) -> Column:
    return _valid(c, PERSON_WEIGHTS)


def company_id_valid(c: Column) -> Column:
    return _valid(c, COMPANY_WEIGHTS)


def full_id(*parts: Column) -> Column:
    """Digits of all parts in a row; a missing part adds nothing."""
    return F.concat(*[F.coalesce(digits(p), F.lit("")) for p in parts])


def invalid_company_id(*parts: Column) -> Column:
    """True for a complete id with wrong check digits; incomplete ids are not judged."""
    return invalid_whole_id(full_id(*parts))


def invalid_whole_id(whole: Column) -> Column:
    return once(whole, lambda x: (F.length(x) == 14) & ~company_id_valid(x))


def person_id(c: Column) -> Column:
    return once(
        digits_of_length(c, 11), lambda d: F.when(_sums_agree(d, PERSON_WEIGHTS), d)
    )


def any_tax_id(c: Column) -> Column:
    """The digits of a valid person or company id, else null."""

    def judge(d: Column) -> Column:
        person = (F.length(d) == 11) & _sums_agree(d, PERSON_WEIGHTS)
        company = (F.length(d) == 14) & _sums_agree(d, COMPANY_WEIGHTS)
        return F.when(person | company, d)

    return once(digits(c), judge)


def mask_person_id(c: Column) -> Column:
    """Hides the first three and the last two of eleven digits."""
    d = digits_of_length(c, 11)
    return F.concat(F.lit("***"), F.substring(d, 4, 6), F.lit("**"))
