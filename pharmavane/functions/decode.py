"""Scalar transforms of the cleaning layer, as pure column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pharmavane.functions import codes

_OLDEST_DATE = "19000101"
_PARTIAL_DATE = r"^\d{4}(\d{2}(\d{2})?)?$"
_WEIGHT_PATTERN = r"^\d+(\.\d+)?$"


def decode(code: Column, labels: dict) -> Column:
    """Label of a code, from a literal map; an unlisted or null code gives null."""
    return F.create_map(*[F.lit(x) for pair in labels.items() for x in pair])[code]


def scale(value: Column, unit: Column, factors: dict) -> Column:
    """``value * multiplier / divisor`` for the row's unit, in double precision."""
    pairs = {k: f if isinstance(f, tuple) else (f, 1) for k, f in factors.items()}
    multiplier = decode(unit, {k: float(m) for k, (m, _) in pairs.items()})
    divisor = decode(unit, {k: float(d) for k, (_, d) in pairs.items()})
    return value.cast("double") * multiplier / divisor


def age_group(code: Column) -> Column:
    return decode(code, codes.AGE_GROUPS)


def sex(code: Column) -> Column:
    return decode(code, codes.SEXES)


def serious(code: Column) -> Column:
    """True, false, or null for any code but 1 and 2."""
    return decode(code, codes.SERIOUS)


def flag(code: Column) -> Column:
    """True only for code 1; everything else, null included, is false."""
    return code.eqNullSafe(1)


def age_years(age: Column, unit: Column) -> Column:
    return scale(age, unit, codes.AGE_TO_YEARS).cast("float")


def valid_weight(weight: Column) -> Column:
    """Keep weights whose printed form is plain digits, optionally with decimals."""
    return F.when(weight.cast("string").rlike(_WEIGHT_PATTERN), weight)


def complete_date(text: Column) -> Column:
    """Fill a missing month or day with 01; other lengths are left as they are."""
    return (
        F.when(F.length(text) == 4, F.concat(text, F.lit("0101")))
        .when(F.length(text) == 6, F.concat(text, F.lit("01")))
        .otherwise(text)
    )


def floor_date(text: Column) -> Column:
    """Null for dates before 1900, compared as text (they are typing errors)."""
    return F.when(text >= _OLDEST_DATE, text)


def compact_date(text: Column) -> Column:
    """A ``yyyyMMdd`` text as a date; anything else gives null."""
    return F.try_to_date(text, "yyyyMMdd")


def partial_date(text: Column) -> Column:
    """``compact_date(floor_date(complete_date(text)))`` in one short expression.

    The cast itself reads 'yyyy' and 'yyyy-MM' as the first day, and the text
    is named few times, which keeps the generated code small enough to compile.
    """
    parts = [
        F.substring(text, 1, 4),
        F.nullif(F.substring(text, 5, 2), F.lit("")),
        F.nullif(F.substring(text, 7, 2), F.lit("")),
    ]
    return F.when(
        text.rlike(_PARTIAL_DATE) & (text >= _OLDEST_DATE[:4]),
        F.concat_ws("-", *parts).try_cast("date"),
    )


def route(code: Column) -> Column:
    return decode(code, codes.ROUTES)


def dose_mg(number: Column, unit: Column, factors: dict = codes.DOSE_TO_MG) -> Column:
    return scale(number, unit, factors)


def duration_days(number: Column, unit: Column) -> Column:
    return scale(number, unit, codes.DURATION_TO_DAYS)


def recurrence(code: Column) -> Column:
    return decode(code, codes.RECURRENCE)


def outcome(code: Column) -> Column:
    return decode(code, codes.OUTCOMES)


def year_of_text(text: Column) -> Column:
    """Year from the first four characters of a date text; null unless four digits."""
    head = F.substring(text, 1, 4)
    return F.when(head.rlike(r"^\d{4}$"), head.try_cast("int"))


def age_band(age: Column) -> Column:
    """Bands of the older population. Ages are fractional: 65 <= age < 71, and so on."""
    return (
        F.when(age >= 81, "81+").when(age >= 71, "71-80").when(age >= 65, "65-70")
    )
