"""Hand-written contract rows that hold every edge case the tests need."""

from __future__ import annotations

from datetime import date as D
from decimal import Decimal

from hirelens.plans.warehouse import Warehouse
from hirelens.schemas import CONTRACT

ROWS = {
    "applicants": [
        ("P1", "  Referral ", D(2024, 1, 1), Decimal("3.5"), " PhD", True),
        ("P2", "   ", D(2024, 1, 2), Decimal("0"), None, None),
        ("P3", "\tagency", D(2024, 1, 3), None, "master", False),
    ],
    "requisitions": [
        # filled twice, once late
        ("R1", "Data", "Senior", "Berlin", 40, D(2024, 1, 1), "M1", "C1"),
        # never filled
        ("R2", "Data", "mid", "remote", 40, D(2024, 1, 10), "M1", "C1"),
        # filled before it opened
        ("R3", "Sales", "staff", "reno", 40, D(2024, 3, 1), "M2", "C1"),
        # no recruiter
        ("R4", "Sales", "junior", None, 40, D(2024, 1, 1), "M2", None),
        # the recruiter's only requisition
        ("R5", "Sales", "junior", "austin", 40, D(2024, 1, 1), "M2", "C2"),
    ],
    "applications": [
        ("A1", "P1", "R1", D(2024, 1, 5), "offer", "hired"),
        ("A2", "P2", "R1", D(2024, 1, 6), "offer", "hired"),
        ("A3", "P3", "R2", D(2024, 2, 20), "screen", " Withdrawn"),
        ("A4", "P1", "R2", D(2024, 3, 5), "onsite", "rejected"),
        ("A5", "P1", "R3", D(2024, 3, 2), "offer", "hired"),
        ("A6", "P2", "R4", D(2024, 1, 2), "offer", "rejected"),
        ("A7", "P2", "R5", D(2024, 1, 2), "offer", "rejected"),
        ("A8", "P9", "R9", D(2024, 1, 2), "applied", "in_progress"),
    ],
    "stage_history": [
        ("A1", "Applied", D(2024, 1, 5), D(2024, 1, 8)),
        ("A2", "applied", D(2024, 1, 6), D(2024, 1, 7)),
        ("A2", "applied ", D(2024, 1, 7), D(2024, 1, 20)),
        ("A2", "Screen", D(2024, 1, 20), D(2024, 1, 21)),
        ("A3", "applied", D(2024, 2, 20), D(2024, 3, 2)),
    ],
    "interviews": [
        ("I1", "A1", 1, "V1", D(2024, 1, 9), True, 1, "  ok "),
        ("I2", "A1", 2, "V1", D(2024, 1, 12), False, 2, "   "),
        ("I3", "A1", 2, "V2", D(2024, 1, 12), None, 2, None),
        ("I4", "A2", 1, "V1", D(2024, 1, 22), True, 5, "Great"),
    ],
    "offers": [
        ("O1", "A1", D(2024, 1, 20), Decimal("90000"), Decimal("100000"), D(2024, 1, 25), "Accepted"),
        ("O2", "A2", D(2024, 1, 25), Decimal("89996"), Decimal("100000"), D(2024, 1, 26), "accepted"),
        ("O3", "A5", D(2024, 3, 3), Decimal("100"), Decimal("0"), D(2024, 3, 4), "accepted"),
        ("O4", "A6", D(2024, 1, 5), Decimal("100"), None, D(2024, 1, 6), "declined"),
        ("O5", "A7", D(2024, 1, 5), Decimal("100"), Decimal("100"), D(2024, 1, 20), "expired"),
    ],
    "hires": [
        ("H1", "O1", D(2024, 2, 1)),
        ("H2", "O2", D(2024, 3, 1)),
        ("H3", "O3", D(2024, 2, 1)),
    ],
}


def contract(spark, **replace):
    rows = {**ROWS, **replace}
    return {name: spark.createDataFrame(rows[name], CONTRACT[name]) for name in CONTRACT}


def warehouse(spark, **replace) -> Warehouse:
    return Warehouse(spark, contract(spark, **replace))


def by(df, key):
    return {row[key]: row for row in df.collect()}
