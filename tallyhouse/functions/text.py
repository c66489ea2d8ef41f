"""String expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def full_name(first: Column, last: Column, separator: str = " ") -> Column:
    """Both parts around the separator; a missing part counts as empty and the separator stays.

    ``F.concat`` alone would turn the whole name into null when one part is null.
    """
    empty = F.lit("")
    return F.concat(F.coalesce(first, empty), F.lit(separator), F.coalesce(last, empty))


def like_literal(text: str) -> str:
    """``text`` for use inside a LIKE pattern, with its wildcards taken literally."""
    return text.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_")


def begins_with_any_case(column: Column, prefix: str) -> Column:
    return column.ilike(like_literal(prefix) + "%")
