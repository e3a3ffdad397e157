"""Parsing of display names, sizes and object paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def year_token(display_name: Column) -> Column:
    """First token of the trimmed name; a missing name gives ''."""
    return F.split_part(F.trim(F.coalesce(display_name, F.lit(""))), F.lit(" "), F.lit(1))


def year_quarter(display_name: Column) -> Column:
    """First two tokens joined: '2016 Q4 (part 1 of 2)' gives '2016Q4'."""
    return F.concat_ws("", F.slice(F.split(display_name, " "), 1, 2))


def part_total(display_name: Column) -> Column:
    """Number of parts: '(part 11 of 23)' gives 23."""
    return F.regexp_extract(display_name, r"(\d+)\)?$", 1).try_cast("int")


def size_or_default(size: Column) -> Column:
    """Size in MB; -1 where it is missing."""
    return F.coalesce(size.try_cast("double"), F.lit(-1.0))


def part_name(ordinal: Column, total: Column) -> Column:
    return F.format_string("drug-event-part-%d-of-%d", ordinal, total)


def path_year(path: Column) -> Column:
    """Fourth segment of ``data/pq/{entity}/{year}/{file}``."""
    return F.split_part(path, F.lit("/"), F.lit(4))


def path_stem(path: Column) -> Column:
    """Last segment up to its first dot."""
    return F.split_part(F.split_part(path, F.lit("/"), F.lit(-1)), F.lit("."), F.lit(1))


def year_list(years: str | None) -> list[str] | None:
    """'2004, 2005' as a list; None or '' means all years."""
    picked = [y.strip() for y in (years or "").split(",")]
    return [y for y in picked if y] or None
