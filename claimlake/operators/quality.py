"""Quality flags and de-duplication."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlake.functions.predicates import quarantine_flag

# Fixed values that must equal the reference's required columns per entity
# (a NULL in any of them quarantines the row) and its sentinel texts.
REQUIRED = {
    "transactions": ("EncounterID", "PatientID", "TransactionID", "VisitDate"),
    "encounters": ("EncounterID", "PatientID"),
    "patients": ("SRC_PatientID", "DOB", "FirstName"),
    "providers": ("ProviderID", "DeptID"),
}
# Our choice (the reference has no builder for these two tables).
REQUIRED.update({
    "departments": ("DeptID", "Name"),
    "cptcodes": ("cpt_codes", "procedure_code_descriptions"),
})
SENTINELS = {"patients": {"FirstName": ("null",)}}


def flag_quarantine(df: DataFrame, required: Iterable[str],
                    sentinels: Mapping[str, Sequence[str]] | None = None,
                    name: str = "is_quarantined") -> DataFrame:
    """Add the quarantine flag; every row is kept."""
    return df.withColumn(name, quarantine_flag(list(required), sentinels))


def quarantined_first(df: DataFrame, flag: str = "is_quarantined") -> DataFrame:
    """Flagged rows first (a review listing).

    A sort on a two-valued flag alone would range-partition every row into
    at most two tasks; a row hash as tie-breaker lets the range partitioner
    spread each half over all tasks (order within a flag is unspecified
    anyway).
    """
    tie = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    return df.orderBy(F.col(f"`{flag}`").desc_nulls_last(), tie)


def latest_per_key(df: DataFrame, key: str | Sequence[str], order_by: str | Sequence[str]) -> DataFrame:
    """Keep the newest row per key (largest ``order_by``; ties broken by the
    whole row, so the choice is deterministic).

    Written as ``max(struct(order, row))`` per key, which Spark aggregates
    partially on the map side: a hot key (say a third of all rows) is
    reduced to one row per task before the shuffle instead of being sorted
    in one task as a window would. Rows whose key is (or holds) NULL match no
    other row (S2): all of them are kept.
    """
    keys = [key] if isinstance(key, str) else list(key)
    order = [order_by] if isinstance(order_by, str) else list(order_by)
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = F.struct(*[F.col(f"`{c}`") for c in order], *[F.col(f"`{c}`") for c in rest])
    known = reduce(Column.__and__, [F.col(f"`{c}`").isNotNull() for c in keys])
    best = df.filter(known).groupBy(*keys).agg(F.max(packed).alias("__best"))
    best = best.select(*keys, *[F.col(f"__best.`{c}`").alias(c) for c in order + rest]).select(df.columns)
    return best.unionByName(df.filter(~known))
