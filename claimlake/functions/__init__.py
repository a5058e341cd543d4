"""Column expressions: keys, flags, change tests, date ranges."""

from claimlake.functions.keys import display_name, prefixed_key, surrogate_key
from claimlake.functions.predicates import (
    changed,
    changed_between,
    in_year,
    is_publishable,
    money_sum,
    month_key,
    quarantine_flag,
)

__all__ = [
    "changed",
    "changed_between",
    "display_name",
    "in_year",
    "is_publishable",
    "money_sum",
    "month_key",
    "prefixed_key",
    "quarantine_flag",
    "surrogate_key",
]
