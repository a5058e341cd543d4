"""Common data model: renames, conformed projections, unions, store casts
(A12, B1-B5, H1-H3, I9-I11)."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimlake.functions.keys import surrogate_key


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """B2: rename columns ``{old: new}``; others unchanged."""
    return df.withColumnsRenamed(dict(mapping))


def conform(df: DataFrame, mapping: Mapping[str, str | Column]) -> DataFrame:
    """Project ``df`` onto the common model ``{target: source column or expr}``.

    The output has exactly the mapping's columns, in its order, so two
    sources with different column names come out with one shape.
    """
    return df.select(*[(F.col(f"`{s}`") if isinstance(s, str) else s).alias(t)
                       for t, s in mapping.items()])


def union_sources(*dfs: DataFrame, by: str = "name", allow_missing: bool = False) -> DataFrame:
    """H1 / H2 / H3: bag union (``UNION ALL``) of per-source DataFrames.

    ``by="name"`` (default) matches columns by name, so a source that
    reorders its columns cannot misalign (S11). ``by="position"`` keeps the
    reference's ``SELECT * UNION ALL SELECT *`` behaviour; the first input
    names the columns.
    """
    if not dfs:
        raise ValueError("union_sources needs at least one DataFrame")
    if by == "name":
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), dfs)
    if by == "position":
        return reduce(lambda a, b: a.union(b), dfs)
    raise ValueError(f"unknown union mode {by!r}")


def with_source_key(df: DataFrame, id_col: str, key_name: str | None = None,
                    src_name: str | None = None, datasource: str = "datasource") -> DataFrame:
    """Put ``concat(id, '-', datasource)`` ahead of the other columns.

    ``key_name`` defaults to ``id_col`` (the id is replaced by the key and
    the raw id kept as ``src_name``, default ``SRC_<id_col>``).
    """
    key_name = key_name or id_col
    src_name = src_name or f"SRC_{id_col}"
    rest = [F.col(f"`{c}`") for c in df.columns if c != id_col]
    return df.select(surrogate_key(id_col, datasource).alias(key_name),
                     F.col(f"`{id_col}`").alias(src_name), *rest)


def conform_to(df: DataFrame, schema: T.StructType, by: str = "position") -> DataFrame:
    """Shape a query result like an ``INSERT INTO t SELECT ...``.

    ``by="position"``: the i-th column goes to the i-th table column, whatever
    its name (the fact query selects ``FK_Patient_ID`` into ``FK_PatientID``).
    ``by="name"``: matched by name, case-insensitively. Each value is cast to
    the table type (int -> string, date -> timestamp, ...). Casts follow the
    session's ANSI setting: a value that does not fit raises rather than
    wrapping (I9 keeps NPI as ``long`` for that reason).
    """
    fields = schema.fields
    if by == "position":
        if len(df.columns) != len(fields):
            raise ValueError(f"{len(df.columns)} columns for a {len(fields)}-column table")
        src = [F.col(f"`{c}`") for c in df.columns]
    elif by == "name":
        lookup = {c.lower(): c for c in df.columns}
        missing = [f.name for f in fields if f.name.lower() not in lookup]
        if missing:
            raise ValueError(f"columns missing: {missing}")
        src = [F.col(f"`{lookup[f.name.lower()]}`") for f in fields]
    else:
        raise ValueError(f"unknown mode {by!r}")
    return df.select(*[c.cast(f.dataType).alias(f.name) for c, f in zip(src, fields)])
