"""Key and label expressions (B5, B11, I1, I2). All return JVM-side Columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from claimlake.functions.cols import as_col

# Fixed values that must equal the reference's: hospital source code ->
# provider id prefix, and the prefix used for every other (or NULL) source.
PROVIDER_PREFIX = {"hos-a": "H1-"}
PROVIDER_PREFIX_DEFAULT = "H2-"
KEY_SEPARATOR = "-"


def surrogate_key(*cols: str | Column, sep: str = KEY_SEPARATOR) -> Column:
    """``id-datasource``. NULL in any part gives a NULL key.

    ``concat`` (not ``concat_ws``) keeps the NULL-in/NULL-out rule, so a row
    with a missing id can never match another row on this key (S2).
    """
    parts: list[Column] = []
    for i, c in enumerate(cols):
        if i:
            parts.append(F.lit(sep))
        parts.append(as_col(c).cast("string"))
    return F.concat(*parts)


def prefixed_key(value: str | Column, source: str | Column,
                 mapping: dict[str, str] | None = None,
                 default: str = PROVIDER_PREFIX_DEFAULT) -> Column:
    """Prefix an id by its source system.

    Sources not in ``mapping`` -- NULL included, since ``NULL = 'hos-a'`` is
    not true -- take ``default`` (S8).
    """
    mapping = PROVIDER_PREFIX if mapping is None else mapping
    src = as_col(source)
    v = as_col(value).cast("string")
    expr = None
    for code, prefix in mapping.items():
        branch = F.concat(F.lit(prefix), v)
        expr = F.when(src == code, branch) if expr is None else expr.when(src == code, branch)
    fallback = F.concat(F.lit(default), v)
    return fallback if expr is None else expr.otherwise(fallback)


def display_name(first: str | Column, last: str | Column) -> Column:
    """``first || ' ' || last``; a missing part (e.g. no provider) gives NULL."""
    return F.concat(as_col(first), F.lit(" "), as_col(last))
