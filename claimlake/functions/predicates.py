"""Row predicates and scalar helpers."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from claimlake.functions.cols import as_col

# Fixed value that must equal the reference's: text that counts as missing.
NULL_SENTINEL = "null"


def quarantine_flag(required: Iterable[str | Column],
                    sentinels: Mapping[str, Sequence[str]] | None = None) -> Column:
    """TRUE when any required column is NULL or a sentinel text.

    Rows are only flagged, never dropped. Sentinels compare lower-cased
    (``lower(firstname) = 'null'``). The flag is never NULL: a NULL test
    result counts as "not quarantined", exactly as ``CASE WHEN`` does.
    """
    conds = [as_col(c).isNull() for c in required]
    for name, values in (sentinels or {}).items():
        lowered = F.lower(as_col(name))
        conds.extend(lowered == F.lit(v.lower()) for v in values)
    if not conds:
        return F.lit(False)
    return F.when(reduce(lambda a, b: a | b, conds), F.lit(True)).otherwise(F.lit(False))


def changed(pairs: Iterable[tuple[Column, Column]], null_safe: bool = False) -> Column:
    """Does any tracked column differ between the two sides?

    ``null_safe=False`` keeps the reference's ``!=`` chain (S1): a value going
    to or from NULL is not a change. The chain's NULL result is read as
    FALSE, like a MERGE condition. ``null_safe=True`` uses IS DISTINCT FROM.
    """
    if null_safe:
        terms = [~a.eqNullSafe(b) for a, b in pairs]
    else:
        terms = [a != b for a, b in pairs]
    if not terms:
        return F.lit(False)
    return F.coalesce(reduce(lambda x, y: x | y, terms), F.lit(False))


def changed_between(left: str, right: str, cols: Iterable[str], null_safe: bool = False) -> Column:
    """B12 over two aliased DataFrames, e.g. ``changed_between('t', 's', cols)``."""
    return changed(((F.col(f"{left}.{c}"), F.col(f"{right}.{c}")) for c in cols), null_safe)


def in_year(c: str | Column, year: int) -> Column:
    """``year(c) = year`` written as a half-open range.

    A range keeps both bounds pushable to the parquet scan (row-group
    min/max pruning), which ``year(c) = y`` is not.
    """
    col = as_col(c)
    return (col >= F.lit(_dt.date(year, 1, 1))) & (col < F.lit(_dt.date(year + 1, 1, 1)))


def month_key(c: str | Column) -> Column:
    """``date_format(c, 'yyyyMM')`` as text."""
    return F.date_format(as_col(c), "yyyyMM")


def month_number(c: str | Column) -> Column:
    """``year * 100 + month`` as an int: the same grouping as ``month_key``,
    without formatting text for every row."""
    col = as_col(c)
    return F.year(col) * 100 + F.month(col)


def month_text(n: str | Column) -> Column:
    """``month_number`` back to the ``yyyyMM`` text (4-digit years)."""
    return F.lpad(as_col(n).cast("string"), 6, "0")


def is_publishable(current: str | Column | None = "is_current",
                   clean: str | Column | None = "is_quarantined") -> Column:
    """``is_current = true AND is_quarantined = false`` (NULL fails both)."""
    conds = []
    if current is not None:
        conds.append(as_col(current) == F.lit(True))
    if clean is not None:
        conds.append(as_col(clean) == F.lit(False))
    return reduce(lambda a, b: a & b, conds) if conds else F.lit(True)


def money_sum(c: str | Column, money_type: str | None = "decimal(18,2)") -> Column:
    """Sum of a money column.

    Summing through a decimal makes the total exact and independent of the
    order rows arrive in (partial + final aggregation, any partitioning), then
    returns ``double`` like the reference's column type. ``money_type=None``
    sums the raw doubles.
    """
    col = as_col(c)
    if money_type is None:
        return F.sum(col)
    return F.sum(col.cast(money_type)).cast("double")
