"""Hand-made operational tables after the reference's scenario rows.

Base rows are invented (the original ships none); the added rows follow the
original's test inserts: new sales ABC/CDE and rental FGH, new products
(also one id in both price lists), new stores and customers, late sales
NEWST and rental NEWRT, and price/name/vendor edits."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal as Dec

from starloom import schema as S
from starloom.sources import Sources

D = dt.date

REGION = [("N", "North"), ("C", "Central"), ("T", "Tundra")]
STORE = [("S4", "13676", "C"), ("S7", "13677", "N"), ("S10", "14000", "C")]
CUSTOMER = [("6-7-888", "Ann", "13699"), ("3-4-555", "Bob", "14001"), ("1-2-333", "Cy", "13677"),
            ("7-8-999", "Dee", "20000")]
VENDOR = [("OA", "Outdoor Adventures"), ("PG", "Pure Gear"), ("WL", "Wilderness Limited")]
CATEGORY = [("CY", "Cycling"), ("EL", "Electronics"), ("FW", "Footwear")]
PRODUCT = [("1X2", "Bike", Dec("100.00"), "OA", "CY"), ("2X4", "Shoe", Dec("20.00"), "PG", "FW"),
           ("1X3", "Charger", Dec("15.00"), "WL", "EL"), ("1X4", "Helmet", Dec("50.00"), "OA", "CY"),
           ("4X2", "Pump", Dec("12.00"), "PG", "CY")]
RENTAL = [("1X1", "Tent", "OA", "CY", Dec("10.00"), Dec("50.00")),
          ("2X2", "Kayak", "PG", "CY", Dec("20.00"), Dec("100.00")),
          ("1X4", "Helmet", "OA", "CY", Dec("5.00"), Dec("25.00")),
          ("3X3", "Stove", "WL", "EL", Dec("3.00"), Dec("18.00"))]
BASE_SALES = [("T1", "6-7-888", "S4", D(2025, 3, 20)), ("T2", "7-8-999", "S10", D(2025, 3, 19))]
BASE_SOLD = [("1X2", "T1", 1), ("2X4", "T2", 2)]
BASE_RENTALS = [("R1", "3-4-555", "S7", D(2025, 3, 20))]
BASE_RENTVIA = [("1X1", "R1", "D", 2)]
# new sales and rentals (picked up by the daily refresh)
NEW_SALES = [("ABC", "1-2-333", "S10", D(2025, 3, 25)), ("CDE", "6-7-888", "S4", D(2025, 3, 26))]
NEW_SOLD = [("1X2", "ABC", 2), ("2X4", "ABC", 5), ("1X3", "CDE", 6), ("1X2", "CDE", 3)]
NEW_RENTALS = [("FGH", "3-4-555", "S7", D(2025, 3, 26))]
NEW_RENTVIA = [("1X1", "FGH", "D", 5), ("2X2", "FGH", "W", 6)]
# late: dated before the mark, entered after the daily refresh
LATE_SALES = [("NEWST", "6-7-888", "S4", D(2025, 3, 20))]
LATE_SOLD = [("1X3", "NEWST", 6)]
LATE_RENTALS = [("NEWRT", "3-4-555", "S7", D(2025, 3, 20))]
LATE_RENTVIA = [("1X1", "NEWRT", "D", 5), ("2X2", "NEWRT", "W", 6)]

INITIAL_AS_OF = dt.datetime(2025, 3, 21, 2, 0, 0)
DAILY_AS_OF = dt.datetime(2025, 3, 27, 2, 0, 0)


def make_sources(spark, **rows) -> Sources:
    defaults = {"salestransaction": BASE_SALES, "soldvia": BASE_SOLD, "rentaltransaction": BASE_RENTALS,
                "rentvia": BASE_RENTVIA, "product": PRODUCT, "rentalproducts": RENTAL, "customer": CUSTOMER,
                "store": STORE, "region": REGION, "vendor": VENDOR, "category": CATEGORY}
    defaults.update(rows)
    return Sources(**{k: spark.createDataFrame(v, S.SOURCE_SCHEMAS[k]) for k, v in defaults.items()})
