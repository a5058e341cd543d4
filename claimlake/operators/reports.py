"""The two charge reports (E1, E2 with C1, C2, E3, G1, I2, I4, I5).

Plan choice, made per call from measured dimension sizes:

* dimensions within the broadcast bound (the normal case: providers and
  departments are thousands of rows against billions of facts): both dims
  are broadcast, joined map-side to the fact, and one partial + final
  aggregation groups by the report keys -- a single, tiny shuffle;
* otherwise the fact is first aggregated per ``FK_ProviderID`` (and month),
  which shrinks it to at most providers x months rows before any join, and
  only that result meets the dimensions in shuffle joins.

Either way a provider holding a third of all facts costs nothing extra:
map-side partial aggregation folds it before the shuffle. Money sums go
through ``decimal(18,2)`` so partial sums are exact and order-independent.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlake.functions.keys import display_name
from claimlake.functions.predicates import in_year, month_number, month_text
from claimlake.operators.joins import (
    DEFAULT_BROADCAST_BYTES,
    DEFAULT_BROADCAST_ROWS,
    probe_sizes,
    with_dim,
)

MONEY = "decimal(18,2)"


def _provider_side(providers: DataFrame) -> DataFrame:
    return providers.select(
        F.col("ProviderID").alias("__pid"),
        display_name("FirstName", "LastName").alias("Provider_Name"),
        F.col("DeptID").alias("__pdept"),
    )


def _department_side(departments: DataFrame) -> DataFrame:
    return departments.select(F.col("Dept_Id").alias("__did"), F.col("Name").alias("Dept_Name"))


def _sum(c: str | Column, money_type: str | None) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.sum(col if money_type is None else col.cast(money_type))


def _finish(c: Column, money_type: str | None) -> Column:
    return c if money_type is None else c.cast("double")


def _report(fact: DataFrame, providers: DataFrame, departments: DataFrame,
            extra_keys: dict[str, Column], measures: dict[str, str],
            money_type: str | None, broadcast: str, max_rows: int, max_bytes: int) -> DataFrame:
    prov, dept = _provider_side(providers), _department_side(departments)
    if broadcast == "auto":
        small = all(p.bounded for p in probe_sizes([prov, dept], max_rows, max_bytes))
        mode = "always" if small else "never"
    else:
        mode = broadcast
    keys = ["Provider_Name", "Dept_Name", *extra_keys]
    if mode == "always":
        base = fact.select(F.col("FK_ProviderID"), *[e.alias(k) for k, e in extra_keys.items()],
                           *[F.col(src).alias(out) for out, src in measures.items()])
        x = with_dim(base, prov, "FK_ProviderID", "__pid", broadcast="always")
        x = with_dim(x, dept, "__pdept", "__did", broadcast="always")
        return x.groupBy(*keys).agg(*[_finish(_sum(m, money_type), money_type).alias(m)
                                      for m in measures])
    # Pre-aggregate the fact per provider key before it meets the dimensions.
    per_fk = fact.groupBy(F.col("FK_ProviderID"), *[e.alias(k) for k, e in extra_keys.items()]).agg(
        *[_sum(src, money_type).alias(out) for out, src in measures.items()])
    x = with_dim(per_fk, prov, "FK_ProviderID", "__pid", broadcast=mode)
    x = with_dim(x, dept, "__pdept", "__did", broadcast=mode)
    return x.groupBy(*keys).agg(*[_finish(F.sum(m), money_type).alias(m) for m in measures])


def charges_by_provider(fact: DataFrame, providers: DataFrame, departments: DataFrame,
                        money_type: str | None = MONEY, broadcast: str = "auto",
                        max_rows: int = DEFAULT_BROADCAST_ROWS,
                        max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Total charge per provider name and department name.

    ``fact LEFT JOIN provider ON ProviderID = FK_ProviderID LEFT JOIN
    department ON Dept_Id = provider.DeptID`` (the department is reached
    through the provider, C2). Facts without a provider land in the NULL
    name / NULL department group; namesakes in one department merge (S15).
    """
    return _report(fact, providers, departments, {}, {"Total_Charge_Amt": "Amount"},
                   money_type, broadcast, max_rows, max_bytes)


def monthly_charges(fact: DataFrame, providers: DataFrame, departments: DataFrame, year: int,
                    money_type: str | None = MONEY, broadcast: str = "auto",
                    max_rows: int = DEFAULT_BROADCAST_ROWS,
                    max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Charge and paid totals per provider, department and ``yyyyMM`` month
    of ``ServiceDate`` in ``year``, ordered by provider name then month (G1).

    The year test is a half-open date range, so it reaches the parquet scan.
    """
    fact = fact.filter(in_year("ServiceDate", year))
    # Group on an int month; the yyyyMM text is made once per output row.
    out = _report(fact, providers, departments, {"__month": month_number("ServiceDate")},
                  {"Total_Charge_Amt": "Amount", "Total_Paid_Amt": "PaidAmount"},
                  money_type, broadcast, max_rows, max_bytes)
    out = out.select("Provider_Name", "Dept_Name", month_text("__month").alias("YYYYMM"),
                     "Total_Charge_Amt", "Total_Paid_Amt")
    return out.orderBy(F.col("Provider_Name").asc_nulls_first(), F.col("YYYYMM").asc_nulls_first())
