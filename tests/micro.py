"""The hand-computed micro fixture: every edge case once (expected values in test_micro.py)."""

from __future__ import annotations

from decimal import Decimal

from goldleaf.spec import SOURCE_SCHEMAS

D = Decimal

ROWS = {
    "branch": [("B1", "Gangnam"), ("B2", "Mapo")],
    "member": [("M1", "pw1", "Kim"), ("M2", "pw2", "Lee")],
    "pizzatypes": [("T1", "Margherita", "Classic", None), ("T2", "Garden", "Veggie", None),
                   ("T3", "Plain", "Classic", None)],
    "topping": [("P1", "Cheese"), ("P2", "Basil")],
    # P9 has no topping row; T3 has no bridge row
    "pizzatypetopping": [("T1", "P1"), ("T1", "P2"), ("T2", "P1"), ("T2", "P9")],
    # TX_m points at an item type that does not exist
    "pizza": [("T1_s", "T1", "S", D("10.00")), ("T1_l", "T1", "L", D("15.50")), ("T2_m", "T2", "M", D("12.25")),
              ("T3_m", "T3", "M", D("9.00")), ("TX_m", "TX", "M", D("8.00"))],
    "orders": [(1, "2015-01-03", "11:38:36", "M1", "B1"), (2, "2015-01-05", "11:57:40", None, None),
               (3, "2015-02-01", "20:00:00", "M9", "B2"), (4, "2015-02-02", "12:12:12", "M2", "B9")],
    "orderdetail": [("1", 1, "T1_s", 2), ("2", 1, "T2_m", 1), ("3", 2, "T1_l", 1), ("4", 3, "T3_m", 3),
                    ("5", 4, "TX_m", 1), ("6", 99, "T1_s", 1), ("7", 4, "T2_m", 0), ("8", None, "T1_s", 1)],
}


def micro_tables(spark, drop_lines=()):
    out = {}
    for name, rows in ROWS.items():
        if name == "orderdetail":
            rows = [r for r in rows if r[0] not in set(drop_lines)]
        out[name] = spark.createDataFrame(rows, SOURCE_SCHEMAS[name])
    return out
