"""A tiny two-hospital data set in the source shapes (FIXTURES.md), with the
edge cases the reports and jobs must handle."""

import datetime as dt

from claimlake.sources.schemas import BRONZE_DDL

D = dt.date


def departments(spark):
    return spark.createDataFrame([
        ("DEPT001", "Cardiology", "hos-a"), ("DEPT002", "Oncology", "hos-a"),
        ("DEPT001", "Cardiology", "hos-b"), ("DEPT003", None, "hos-b"),  # no name: quarantined
    ], BRONZE_DDL["departments"])


def providers(spark):
    return spark.createDataFrame([
        ("H1-PROV0001", "Ann", "Lee", "Cardio", "DEPT001", 1234567890, "hos-a"),
        ("H1-PROV0002", "Bob", "Roy", "Onco", "DEPT002", 3000000001, "hos-a"),   # NPI above 2^31
        ("H2-PROV0001", "Ann", "Lee", "Cardio", "DEPT001", 1234567891, "hos-b"),  # namesake, same dept name
        ("H2-PROV0002", "Cy", "Fox", "Gen", "DEPT009", 1234567892, "hos-b"),     # dept not loaded
        ("H2-PROV0003", "Di", "Ng", "Gen", None, 1234567893, "hos-b"),           # no dept: quarantined
    ], BRONZE_DDL["providers"])


def _tx(tid, enc, pat, prov, dept, service, amount, paid, ds, visit=None):
    visit = visit or service
    return (tid, enc, pat, prov, dept, visit, service, service, "Routine", amount, "Insurance", paid,
            "CLM" + tid, "PAY1", 99213, "I10.1", "Commercial", None, None, service, service, ds)


def transactions(spark):
    return spark.createDataFrame([
        _tx("T1", "E1", "P1", "PROV0001", "DEPT001", D(2024, 1, 1), 100.10, 80.00, "hos-a"),
        _tx("T2", "E2", "P2", "PROV0001", "DEPT001", D(2024, 1, 15), 200.20, 0.00, "hos-a"),
        _tx("T3", "E3", "P3", "PROV0002", "DEPT002", D(2023, 12, 31), 300.30, 300.30, "hos-a"),  # not 2024
        _tx("T1", "E9", "P9", "PROV0001", "DEPT001", D(2024, 12, 31), 50.05, 50.05, "hos-b"),    # namesake
        _tx("T2", "E8", "P8", "PROV0002", "DEPT009", D(2024, 2, 1), 10.00, 5.00, "hos-b"),       # no dept row
        _tx("T3", "E7", "P7", "PROV0404", "DEPT001", D(2024, 2, 2), 7.00, 7.00, "hos-b"),        # no provider
        _tx("T4", None, "P7", "PROV0001", "DEPT001", D(2024, 3, 3), 999.00, 0.00, "hos-b"),      # quarantined
        _tx("T5", "E6", "P6", "PROV0001", "DEPT001", D(2025, 1, 1), 1.00, 1.00, "hos-b"),        # next year
    ], BRONZE_DDL["transactions"])
