"""Historised tables: SCD type 2 and the registry upsert.

All operators are pure ``DataFrame -> DataFrame``: they return the table's
new content and leave writing to ``claimlake.sources.tables``.

Scale notes
-----------
* A batch meets the table in two joins and no window: current rows that met
  a changed batch row expire (pass 1), and batch rows whose key has no
  current row left are inserted (pass 2). Both passes give one new version
  in one write (the reference runs two MERGE statements and two commits).
* The batch is measured first (rows and real bytes). A batch that fits a
  broadcast is joined map-side: the table is never shuffled, and is read
  twice (whole rows once, key and tracked columns of current rows once).
  A larger batch whose keys fit sends only the current rows with those
  keys through a shuffle; beyond that all current rows are shuffled.
* History rows (``is_current`` false or NULL) are never shuffled.
* NULL keys never match (S2). They are inserted map-side, outside of any
  shuffle, so copies of one junk row cannot crowd a join task.
* A key repeated in the batch (S6) is found by a hash aggregate, folded
  map-side; no operator here buffers the rows of one key.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimlake.functions.packing import pack
from claimlake.functions.predicates import changed

_T, _S = "__t", "__s"
_SRC = "__s_"


@dataclass(frozen=True)
class Audit:
    """Names of the SCD2 bookkeeping columns of one table."""

    current: str = "is_current"
    inserted: str = "audit_insertdate"
    modified: str = "audit_modifieddate"


# Fixed values that must equal the reference's bookkeeping column names.
TX_AUDIT = Audit("is_current", "audit_insertdate", "audit_modifieddate")  # transactions, encounters
PATIENT_AUDIT = Audit("is_current", "inserted_date", "modified_date")
NPI_AUDIT = Audit("is_current_flag", "inserted_date", "updated_date")


def _ts(value, dtype) -> Column:
    """The batch time as a literal of the target column's type.

    A naive ``datetime`` for a ``timestamp_ntz`` column is built from its
    text, so it does not pass through the Python process's local zone.
    """
    if isinstance(value, Column):
        return value.cast(dtype)
    if isinstance(value, _dt.datetime) and isinstance(dtype, T.TimestampNTZType) and value.tzinfo is None:
        return F.to_timestamp_ntz(F.lit(value.isoformat(sep=" ")))
    return F.lit(value).cast(dtype)


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def duplicate_check(keys: DataFrame, key: str, shape: T.StructType, what: str) -> DataFrame:
    """A branch with no rows that raises when a key occurs twice in ``keys``.

    The count is a hash aggregate (partial counts per task, then per key),
    so a key holding a third of all rows is folded map-side and no task ever
    buffers its rows. Union the result into the output so it runs with it.
    """
    counts = keys.groupBy(_c(key)).agg(F.count(F.lit(1)).alias("__cnt"))
    raised = counts.where(F.when(F.col("__cnt") > 1, F.raise_error(F.concat(
        F.lit(f"{what}: several source rows for key "), _c(key).cast("string")))).isNull())
    return raised.where(F.col("__cnt") < 0).select(
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in shape.fields])


def _check_columns(target: DataFrame, source: DataFrame, audit: Audit | None) -> list[str]:
    tcols = set(target.columns)
    missing = [c for c in source.columns if c not in tcols]
    if missing:
        raise ValueError(f"source columns not in target: {missing}")
    if audit is not None:
        for c in (audit.current, audit.inserted, audit.modified):
            if c not in tcols:
                raise ValueError(f"target lacks bookkeeping column {c!r}")
    return list(source.columns)


def _tracked(source: DataFrame, key: str, tracked: Sequence[str] | None) -> list[str]:
    return [c for c in source.columns if c != key] if tracked is None else list(tracked)


def _is_current(audit: Audit) -> Column:
    """``current = TRUE``; NULL counts as history."""
    return F.coalesce(_c(audit.current) == F.lit(True), F.lit(False))


def _new_rows(target_fields: T.StructType, business: list[str], audit: Audit, ts,
              prefix: str = "") -> list[Column]:
    """Target-shaped columns for source rows inserted as current at ``ts``."""
    types = {f.name: f.dataType for f in target_fields.fields}
    vals = {audit.current: F.lit(True), audit.modified: _ts(ts, types[audit.modified]),
            audit.inserted: _ts(ts, types[audit.inserted])}
    out = []
    for f in target_fields.fields:
        c = f.name
        if c in vals:
            out.append(vals[c].alias(c))
        elif c in business:
            out.append(_c(prefix + c).cast(f.dataType).alias(c))
        else:
            out.append(F.lit(None).cast(f.dataType).alias(c))
    return out


def scd2_initial(source: DataFrame, target_schema: T.StructType,
                 ts: _dt.datetime | _dt.date | Column, audit: Audit = TX_AUDIT,
                 key: str | None = None) -> DataFrame:
    """First load of an empty SCD2 table: every row becomes current at ``ts``.

    Equal to ``scd2_apply`` onto an empty table, without any join. With
    ``key`` a non-NULL key that occurs twice raises, as it does in every
    later load (S6); without it the caller vouches for the keys.
    """
    names = {f.name for f in target_schema.fields}
    missing = [c for c in source.columns if c not in names]
    if missing:
        raise ValueError(f"source columns not in target: {missing}")
    out = source.select(*_new_rows(target_schema, list(source.columns), audit, ts))
    if key is None:
        return out
    keys = source.filter(_c(key).isNotNull()).select(key)
    return out.unionByName(duplicate_check(keys, key, out.schema, "scd2_initial"))


@dataclass(frozen=True)
class _Batch:
    """A batch ready to meet the table: ``rows`` (columns prefixed, non-NULL
    keys, a broadcast if ``whole``) and, if they fit, its broadcast ``keys``."""

    rows: DataFrame
    keys: DataFrame | None
    whole: bool


def _built_bytes(rows: int, payload: int, width: int) -> int:
    """Size of a broadcast hash table: the payload, and per row a key copy,
    pointers and eight bytes a column."""
    return 2 * payload + rows * (96 + 8 * width)


@dataclass(frozen=True)
class BatchSize:
    """Rows with a key, their payload and that of their keys, as counted where the batch was written."""

    rows: int
    bytes: int
    key_bytes: int


def size_metrics(source: DataFrame, key: str) -> list[Column]:
    """Aggregates to observe while a batch is written: the fields of its ``BatchSize``."""
    from claimlake.operators.joins import payload_bytes

    keyed = _c(key).isNotNull()
    total = lambda df: F.coalesce(F.sum(F.when(keyed, payload_bytes(df))), F.lit(0))
    return [F.count(F.when(keyed, F.lit(1))).alias("rows"), total(source).alias("bytes"), total(source.select(key)).alias("key_bytes")]


def _measured(source: DataFrame, key: str, business: list[str], mode: str, max_rows: int,
              max_bytes: int, size: BatchSize | None = None) -> _Batch:
    if mode not in ("auto", "never"):
        raise ValueError(f"unknown key_broadcast {mode!r}")
    keyed = source.filter(_c(key).isNotNull())
    rows = keyed.select(*[_c(c).alias(_SRC + c) for c in business])
    if mode == "never":
        return _Batch(rows, None, False)
    from claimlake.operators.joins import SizeProbe, probe_sizes

    keys = keyed.select(_c(key).alias("__bk"))
    if size is None:
        all_rows, only_keys = probe_sizes([rows, keys])
    else:
        all_rows, only_keys = (SizeProbe(size.rows, b, True) for b in (size.bytes, size.key_bytes))

    def fits(p, width: int) -> bool:
        return p.rows <= max_rows and _built_bytes(p.rows, p.bytes, width) <= max_bytes

    if fits(all_rows, len(business)):
        return _Batch(F.broadcast(rows), F.broadcast(keys), True)
    return _Batch(rows, F.broadcast(keys) if fits(only_keys, 1) else None, False)


def _split(target: DataFrame, batch: _Batch, key: str, audit: Audit) -> tuple[DataFrame | None, DataFrame]:
    """(rows that pass by, rows that meet the batch)."""
    if batch.whole:  # joined map-side: all rows go through one scan
        return None, target
    live = _is_current(audit) & _c(key).isNotNull()
    if batch.keys is None:
        return target.filter(~live), target.filter(live)
    hit = (_c(key) == F.col("__bk")) & _is_current(audit)
    return target.join(batch.keys, hit, "left_anti"), target.filter(live).join(batch.keys, hit, "left_semi")


def _expire(target: DataFrame, batch: _Batch, key: str, diff: Column, audit: Audit, ts: Column,
            unique: bool) -> DataFrame:
    """Pass 1: the whole table, current rows that met a changed batch row expired.

    One outer join does it. ``unique``: batch keys are unique (checked or
    vouched for). Otherwise the join is on changed batch rows, and a branch
    without rows raises if a current row meets several of them.
    """
    passed, rows = _split(target, batch, key, audit)
    vals = {audit.current: F.lit(False), audit.modified: ts}
    cols = target.columns
    match = (_c(key) == _c(_SRC + key)) & _is_current(audit)
    # a row that met several changed batch rows comes out several times, but then the run fails
    hit = _c(_SRC + key).isNotNull() & (diff if unique else F.lit(True))
    out = rows.join(batch.rows, match if unique else match & diff, "left").select(*[
        (F.when(hit, vals[c]).otherwise(_c(c)) if c in vals else _c(c)).alias(c) for c in cols])
    if not unique:
        met = (rows.filter(_is_current(audit)).withColumn("__row", F.monotonically_increasing_id())
               .join(batch.rows, match & diff).groupBy("__row")
               .agg(F.count(F.lit(1)).alias("__cnt"), F.min(_c(key)).alias("__key")))
        raised = met.where(F.when(F.col("__cnt") > 1, F.raise_error(F.concat(
            F.lit("scd2: several source rows match the current row for key "),
            F.col("__key").cast("string")))).isNull())
        out = out.unionByName(raised.where(F.col("__cnt") < 0).select(
            *[F.lit(None).cast(f.dataType).alias(f.name) for f in target.schema.fields]))
    return out if passed is None else passed.select(cols).unionByName(out)


def _without(source: DataFrame, key: str, keys: DataFrame, bounded: bool) -> DataFrame:
    """Source rows whose key is not among ``keys`` (column ``__ck``); NULL keys never are.

    ``bounded``: the distinct ``keys`` are among those of a batch measured to
    fit, so they are broadcast and no row of the source is shuffled.
    Otherwise NULL keys bypass the join's shuffle.
    """
    hit = _c(key) == F.col("__ck")
    if bounded:
        return source.join(F.broadcast(keys.distinct()), hit, "left_anti")
    return (source.filter(_c(key).isNotNull()).join(keys, hit, "left_anti")
            .unionByName(source.filter(_c(key).isNull())))


MAX_KEY_ROWS = 4_000_000
MAX_BUILT_BYTES = 256 * 1024 * 1024


def scd2_apply(target: DataFrame, source: DataFrame, key: str,
               tracked: Sequence[str] | None = None,
               ts: _dt.datetime | _dt.date | Column | None = None,
               audit: Audit = TX_AUDIT, null_safe: bool = False,
               on_duplicate: str = "error", null_keys: str = "insert",
               key_broadcast: str = "auto", max_key_rows: int = MAX_KEY_ROWS,
               max_key_bytes: int = MAX_BUILT_BYTES) -> DataFrame:
    """D5 (= D1 then D2, and D3): apply one batch to an SCD2 table.

    * matched current row, tracked columns changed (B12, NULL-unsafe by
      default, S1): old row expires (``current`` false, ``modified`` = ts)
      and the source row becomes a new current version;
    * matched and unchanged: nothing happens;
    * source key without a current row (new, or only history): inserted as
      current with both audit times = ts;
    * current rows whose key is absent from the batch stay current (S7);
    * NULL source keys never match and are inserted again each run (S2).

    A table written by the original two-pass loads can hold several current
    rows for one key: each changed one expires, and the new version is
    inserted only if none of them stays current.

    ``on_duplicate``: ``error`` raises when a non-NULL key occurs twice in
    the batch (S6); ``merge`` behaves like the reference's two MERGE passes:
    it raises only when several batch rows would change the same current row,
    and inserts every copy of a key without a current row; ``unchecked``
    trusts the caller (e.g. after ``latest_per_key``). ``null_keys``:
    ``insert`` (the reference's behaviour) or ``skip`` (NULL-key batch rows
    are not loaded).

    ``key_broadcast``: ``auto`` measures the batch (one distributed count,
    run when this is called) against ``max_key_rows`` and the size that its
    broadcast table would have (``max_key_bytes``): see the scale notes
    above. ``never`` shuffles.
    """
    if ts is None:
        raise ValueError("ts (the batch time) is required; pass one value per run")
    if on_duplicate not in ("error", "merge", "unchecked"):
        raise ValueError(f"unknown on_duplicate {on_duplicate!r}")
    if null_keys not in ("insert", "skip"):
        raise ValueError(f"unknown null_keys {null_keys!r}")
    business = _check_columns(target, source, audit)
    types = {f.name: f.dataType for f in target.schema.fields}
    batch = _measured(source, key, business, key_broadcast, max_key_rows, max_key_bytes)
    diff = F.coalesce(changed(((_c(c), _c(_SRC + c).cast(types[c])) for c in _tracked(source, key, tracked)),
                              null_safe), F.lit(False))
    out = _expire(target, batch, key, diff, audit, _ts(ts, types[audit.modified]),
                  unique=on_duplicate != "merge")

    # Pass 2: keys that keep a current row need no new version.
    _, rows = _split(target, batch, key, audit)
    match = _c(key) == _c(_SRC + key)
    live = rows.filter(_is_current(audit))
    if on_duplicate == "merge":  # a row that meets a changed and an unchanged copy expires
        live = live.join(batch.rows, match & diff, "left_anti")
    stays = live.join(batch.rows, match & ~diff, "left_semi").select(_c(key).alias("__ck"))
    fresh = source if null_keys == "insert" else source.filter(_c(key).isNotNull())
    fresh = _without(fresh, key, stays, batch.keys is not None)
    out = out.unionByName(fresh.select(*_new_rows(target.schema, business, audit, ts)))
    if on_duplicate == "error":
        keys = source.filter(_c(key).isNotNull()).select(key)
        out = out.unionByName(duplicate_check(keys, key, target.schema, "scd2_apply"))
    return out


def scd2_current(current: DataFrame, source: DataFrame, key: str,
                 tracked: Sequence[str] | None = None,
                 ts: _dt.datetime | _dt.date | Column | None = None,
                 audit: Audit = TX_AUDIT, null_safe: bool = False, on_duplicate: str = "error",
                 key_broadcast: str = "auto", max_key_rows: int = MAX_KEY_ROWS,
                 max_key_bytes: int = MAX_BUILT_BYTES, size: BatchSize | None = None) -> DataFrame:
    """D5 for a table that keeps its current rows apart, one per key.

    ``current`` holds current rows only, no key twice and none NULL (as
    ``claimlake.sources.history_table`` stores them). Returns the rows kept,
    the rows expired now and the new rows; the result of ``scd2_apply`` is
    these and the untouched history.

    One join gives kept, expired and changed rows: a changed row comes out
    twice, as its expired self and as the batch's. A batch that fits a
    broadcast needs one more scan, of the key column alone, for the keys that
    the table lacks; a larger one is full-outer-joined, so that only the batch
    is shuffled (packed) if ``current`` is bucketed by ``key``. ``on_duplicate``:
    ``error`` or ``unchecked``. ``size``: of the batch, if it was counted as
    it was written; otherwise the batch is measured.
    """
    if ts is None:
        raise ValueError("ts is required")
    if on_duplicate not in ("error", "unchecked"):
        raise ValueError(f"on_duplicate {on_duplicate!r} needs scd2_apply")
    business = _check_columns(current, source, audit)
    types = {f.name: f.dataType for f in current.schema.fields}
    batch = _measured(source, key, business, key_broadcast, max_key_rows, max_key_bytes, size)
    diff = F.coalesce(changed(((_c(c), _c(_SRC + c).cast(types[c])) for c in _tracked(source, key, tracked)),
                              null_safe), F.lit(False))
    if batch.whole:
        joined = current.join(batch.rows, _c(key) == _c(_SRC + key), "left")
    else:
        packed, whole = pack(batch.rows, keep=[_SRC + key])
        joined = current.join(packed, _c(key) == _c(_SRC + key), "full_outer").select(
            *[_c(c) for c in current.columns], *[c.alias(name) for name, c in whole.items()])
    mine, theirs = _c(key).isNotNull(), _c(_SRC + key).isNotNull()
    copies = F.when(mine & theirs & diff, F.array(F.lit(0), F.lit(1))).when(mine, F.array(F.lit(0))).otherwise(F.array(F.lit(1)))
    rows = joined.select("*", (theirs & diff).alias("__gone"), F.explode(copies).alias("__new"))
    fresh = _new_rows(current.schema, business, audit, ts, _SRC)
    gone = {audit.current: F.lit(False), audit.modified: _ts(ts, types[audit.modified])}
    out = rows.select(*[
        F.when(F.col("__new") == 1, new).when(F.col("__gone"), gone.get(c, _c(c))).otherwise(_c(c)).alias(c)
        for c, new in zip(current.columns, fresh)])
    if batch.whole:
        seen = current.select(_c(key).alias("__ck")).join(batch.keys, F.col("__ck") == F.col("__bk"), "left_semi")
        new = _without(source, key, seen, True)
    else:
        new = source.filter(_c(key).isNull())
    out = out.unionByName(new.select(*_new_rows(current.schema, business, audit, ts)))
    if on_duplicate == "error":
        keys = source.filter(_c(key).isNotNull()).select(key)
        out = out.unionByName(duplicate_check(keys, key, current.schema, "scd2_current"))
    return out


def scd2_expire(target: DataFrame, source: DataFrame, key: str,
                tracked: Sequence[str] | None = None,
                ts: _dt.datetime | _dt.date | Column | None = None,
                audit: Audit = TX_AUDIT, null_safe: bool = False, key_broadcast: str = "auto",
                max_key_rows: int = MAX_KEY_ROWS, max_key_bytes: int = MAX_BUILT_BYTES) -> DataFrame:
    """First MERGE pass -- expire current rows whose tracked columns changed.

    Returns the whole table; nothing is inserted. Several source rows that
    would change one current row raise, as a conditional MERGE does (S6);
    repeated keys without a current row are left to the insert pass. The
    batch is measured as in ``scd2_apply``.
    """
    if ts is None:
        raise ValueError("ts is required")
    business = _check_columns(target, source, None)
    types = {f.name: f.dataType for f in target.schema.fields}
    batch = _measured(source, key, business, key_broadcast, max_key_rows, max_key_bytes)
    diff = F.coalesce(changed(((_c(c), _c(_SRC + c).cast(types[c])) for c in _tracked(source, key, tracked)),
                              null_safe), F.lit(False))
    return _expire(target, batch, key, diff, audit, _ts(ts, types[audit.modified]), unique=False)


def scd2_insert(target: DataFrame, source: DataFrame, key: str,
                ts: _dt.datetime | _dt.date | Column | None = None,
                audit: Audit = TX_AUDIT, key_broadcast: str = "auto") -> DataFrame:
    """Second MERGE pass -- insert source rows that have no current row.

    Unmatched duplicates are all inserted, as the reference's insert-only
    MERGE does. NULL keys never match, so they are always inserted (S2).
    """
    if ts is None:
        raise ValueError("ts is required")
    business = _check_columns(target, source, audit)
    new = unmatched(source, target, key, current=audit.current, key_broadcast=key_broadcast)
    return target.unionByName(new.select(*_new_rows(target.schema, business, audit, ts)))


def unmatched(source: DataFrame, target: DataFrame, key: str, current: str | None = "is_current",
              key_broadcast: str = "auto", max_key_rows: int = MAX_KEY_ROWS,
              max_key_bytes: int = MAX_BUILT_BYTES) -> DataFrame:
    """C4: source rows with no (current) target row on ``key``: an anti-join.

    NULL source keys match nothing and are always returned. If the source's
    keys are measured to fit a broadcast, the target's keys are first
    reduced map-side to those of the source; only beyond that bound are all
    (current) target keys shuffled.
    """
    tgt = target if current is None else target.filter(_c(current) == F.lit(True))
    keys = tgt.filter(_c(key).isNotNull()).select(_c(key).alias("__ck"))
    batch = _measured(source, key, [key], key_broadcast, max_key_rows, max_key_bytes)
    if batch.keys is not None:
        keys = keys.join(batch.keys, F.col("__ck") == F.col("__bk"), "left_semi")
    return _without(source, key, keys, batch.keys is not None)


def upsert_flagged(target: DataFrame, source: DataFrame, key: str,
                   tracked: Sequence[str] = ("code_description",),
                   updates: Mapping[str, str] | None = None,
                   flag: str = "is_current_flag", flag_value: bool = False,
                   on_duplicate: str = "error") -> DataFrame:
    """The registry MERGE -- update in place, insert unseen keys.

    Matching ignores the flag. A matched row whose tracked columns changed
    takes the ``updates`` columns from the source (default: the tracked
    columns plus ``updated_date``) and its flag is set to ``flag_value``
    (FALSE in the reference: S3). Unseen keys are inserted as the source
    row. Unmatched target rows stay as they are.
    """
    business = _check_columns(target, source, None)
    updates = dict(updates or {c: c for c in (*tracked, "updated_date") if c in business})
    out_cols = target.columns
    types = {f.name: f.dataType for f in target.schema.fields}
    has_key = _c(key).isNotNull()

    def as_target(prefix: str) -> list[Column]:
        return [(_c(prefix + c).cast(types[c]) if c in business else F.lit(None).cast(types[c])).alias(c)
                for c in out_cols]

    untouched = target.filter(~has_key).select(out_cols)
    src_null = source.filter(~has_key).select(*as_target(""))
    tgt = target.filter(has_key).withColumn(_T, F.lit(True))
    src = source.filter(has_key).select(*[_c(c).alias(_SRC + c) for c in business])
    src = src.withColumn(_S, F.lit(True))
    j = tgt.join(src, tgt[key] == src[_SRC + key], "full_outer")

    only_src = F.col(_T).isNull()
    hit = F.col(_S).isNotNull() & F.col(_T).isNotNull() & changed(
        (_c(c), _c(_SRC + c).cast(types[c])) for c in tracked)
    cols = []
    for c, from_src in zip(out_cols, as_target(_SRC)):
        if c == flag:
            upd = F.lit(flag_value)
        elif c in updates:
            upd = _c(_SRC + updates[c]).cast(types[c])
        else:
            upd = _c(c)
        cols.append(F.when(only_src, from_src).when(hit, upd).otherwise(_c(c)).alias(c))
    out = untouched.unionByName(j.select(*cols)).unionByName(src_null)
    if on_duplicate == "error":
        out = out.unionByName(duplicate_check(src.select(_SRC + key), _SRC + key, target.schema,
                                               "upsert_flagged"))
    return out


def snapshot(df: DataFrame, current: str = "is_current") -> DataFrame:
    """The current rows of a historised table."""
    return df.filter(_c(current) == F.lit(True))


def versions_per_key(df: DataFrame, key: str, name: str = "n_versions") -> DataFrame:
    """``count(*)`` per key, largest first."""
    return (df.groupBy(key).agg(F.count(F.lit(1)).alias(name))
            .orderBy(F.col(name).desc(), F.col(key).asc_nulls_last()))


def rows_per_source_key(df: DataFrame, keys: Iterable[str], counted: str,
                        name: str = "n_rows") -> DataFrame:
    """E5: ``count(counted)`` (NULLs skipped) per source id and source, descending."""
    keys = list(keys)
    return (df.groupBy(*keys).agg(F.count(_c(counted)).alias(name))
            .orderBy(F.col(name).desc(), *[F.col(k).asc_nulls_last() for k in keys]))
