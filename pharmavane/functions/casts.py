"""Casts that turn a bad value into null instead of failing the job.

They give what a non-ANSI Spark cast gives, whatever the session's ANSI
setting, so the caller's session is left alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_DECIMAL = r"^\s*(?<sign>[+-]?)(?<whole>\d*)\.\d*\s*$"


def string_to_int(c: Column) -> Column:
    """'12' and '12.7' give 12, '.5' gives 0, '1e3' and overflow give null.

    The plain cast settles almost every value; the pattern, which cuts the
    decimals off, runs only on the values it leaves null.
    """
    whole = F.regexp_replace(c, _DECIMAL, "${sign}0${whole}")
    return F.coalesce(c.try_cast("int"), whole.try_cast("int"))


def to_int(df: DataFrame, name: str) -> Column:
    """Integer form of a column whose type may have drifted between files."""
    if isinstance(df.schema[name].dataType, T.StringType):
        return string_to_int(F.col(name))
    return F.col(name).try_cast("int")


def to_float(c: Column | str) -> Column:
    return _col(c).try_cast("float")


def to_string(c: Column | str) -> Column:
    return _col(c).cast("string")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c
