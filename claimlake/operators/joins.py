"""Dimension joins with a checked broadcast."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Upper bounds for shipping a dimension to every executor. Rows and bytes are
# both measured by a distributed count, never guessed from file sizes.
DEFAULT_BROADCAST_ROWS = 2_000_000
DEFAULT_BROADCAST_BYTES = 256 * 1024 * 1024

_FIXED_WIDTH = {
    T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.DateType: 4,
    T.FloatType: 4, T.LongType: 8, T.DoubleType: 8, T.TimestampType: 8,
    T.TimestampNTZType: 8, T.DecimalType: 16,
}


@dataclass(frozen=True)
class SizeProbe:
    rows: int
    bytes: int
    bounded: bool


def payload_bytes(df: DataFrame) -> Column:
    """Payload bytes of a row: real lengths of variable-width values, the width of the others."""
    total = F.lit(0).cast("long")
    for field in df.schema.fields:
        dt = field.dataType
        c = F.col(f"`{field.name}`")
        if isinstance(dt, (T.StringType, T.BinaryType)):
            w = F.coalesce(F.octet_length(c), F.lit(0)).cast("long")
        elif type(dt) in _FIXED_WIDTH:
            w = F.lit(_FIXED_WIDTH[type(dt)]).cast("long")
        else:  # nested: measure its JSON text
            w = F.coalesce(F.octet_length(F.to_json(c)), F.lit(0)).cast("long")
        total = total + w
    return total


def _probe_agg(df: DataFrame, tag: int) -> DataFrame:
    # A plain aggregate: each task counts its own rows and bytes (partial
    # aggregation) and only those partial sums are shuffled. A limit inside a
    # plan would instead funnel up to partitions x limit rows into one task.
    return df.select(payload_bytes(df).alias("__w")).agg(
        F.lit(tag).alias("tag"), F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum("__w"), F.lit(0)).cast("long").alias("bytes"))


def probe_sizes(dfs: list[DataFrame], max_rows: int = DEFAULT_BROADCAST_ROWS,
                max_bytes: int = DEFAULT_BROADCAST_BYTES) -> list[SizeProbe]:
    """Measure rows and payload bytes of each DataFrame, all in one job.

    Variable-width values are measured with ``octet_length``; fixed-width
    ones use their width. Only the probed columns are read, and each task
    reduces its rows to one partial count before the shuffle. This is the
    proof a broadcast needs: a bound on the data actually shipped, not an
    estimate from file sizes.
    """
    probes = [_probe_agg(df, i) for i, df in enumerate(dfs)]
    union = probes[0]
    for p in probes[1:]:
        union = union.unionByName(p)
    got = {r["tag"]: (int(r["rows"]), int(r["bytes"])) for r in union.collect()}
    return [SizeProbe(rows, size, rows <= max_rows and size <= max_bytes)
            for rows, size in (got[i] for i in range(len(dfs)))]


def probe_size(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS,
               max_bytes: int = DEFAULT_BROADCAST_BYTES) -> SizeProbe:
    """``probe_sizes`` for one DataFrame."""
    return probe_sizes([df], max_rows, max_bytes)[0]


def checked_broadcast(dim: DataFrame, mode: str = "auto",
                      max_rows: int = DEFAULT_BROADCAST_ROWS,
                      max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Broadcast ``dim`` only when its measured size is within bounds.

    ``mode``: ``auto`` (measure), ``never`` (shuffle join; AQE may still
    switch at run time from real shuffle sizes), ``always`` (caller vouches
    for the bound, e.g. a fixed code list).
    """
    if mode == "always":
        return F.broadcast(dim)
    if mode == "never":
        return dim
    if mode != "auto":
        raise ValueError(f"unknown broadcast mode {mode!r}")
    return F.broadcast(dim) if probe_size(dim, max_rows, max_bytes).bounded else dim


def with_dim(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str,
             how: str = "left", broadcast: str = "auto",
             max_rows: int = DEFAULT_BROADCAST_ROWS,
             max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """``fact LEFT JOIN dim ON dim.dim_key = fact.fact_key``.

    A fact row without a dimension row is kept with NULL attributes. Column
    names of ``dim`` other than the key must not collide with ``fact``'s;
    project the dimension to what the report needs first (that also keeps
    the broadcast small).
    """
    side = checked_broadcast(dim, broadcast, max_rows, max_bytes)
    return fact.join(side, fact[fact_key] == side[dim_key], how)
