"""Label expressions: order-count labels, score reversal, segment lookups.

All lookups are literal ``CASE``/map expressions evaluated inside codegen; no
join, no Python UDF.
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for right results.
# Segment name -> RFM codes (names spelled exactly as published, including
# "Low Spent-Churn  Best Customer" with two spaces).
SEGMENT_CODES = {
    "High Spending-New Customer": [131, 132, 141, 142],
    "Low Spending-New Customer": [133, 134, 143, 144],
    "High Spending-Loyal Customer": [111, 112, 121, 122],
    "Low Spending-Loyal Customer": [113, 114, 123, 124],
    "High Spending-Potential Loyalist": [211, 212, 221, 222],
    "Low Spending-Potential Loyalist": [213, 214, 223, 224],
    "High Spending-Promising Customer": [231, 232, 241, 242],
    "Low Spending Promising Customer": [233, 234, 243, 244],
    "High Spent-Attention Seekers": [311, 312, 321, 322],
    "Low Spent-Attention Seeker": [313, 314, 323, 324],
    "High Spent-Likely to Churn": [331, 332, 341, 342],
    "Low Spent-Likely to Churn": [333, 334, 343, 344],
    "High Spent-Churn Best Customer": [411, 412, 421, 422],
    "Low Spent-Churn  Best Customer": [413, 414, 423, 424],
    "Churn Customer": [431, 432, 433, 434, 441, 442, 443, 444],
}
# Quadrant -> segments.
QUADRANT_SEGMENTS = {
    "Platinum": ["High Spending-Loyal Customer", "High Spending-Potential Loyalist",
                 "Low Spending-Loyal Customer"],
    "Gold": ["High Spending-New Customer", "Low Spending-New Customer",
             "High Spending-Promising Customer", "Low Spending-Potential Loyalist"],
    "Silver": ["Low Spending Promising Customer", "High Spent-Attention Seekers",
               "Low Spent-Attention Seeker", "High Spent-Likely to Churn",
               "Low Spent-Likely to Churn"],
    "Bronze": ["High Spent-Churn Best Customer", "Low Spent-Churn  Best Customer",
               "Churn Customer"],
}
# Other fixed label texts.
ORDER_LABELS = {1: "1 Order", 2: "2 Orders", 3: "3 Orders"}
ORDER_LABEL_MORE = "4+ Orders"
WIN_BACK = ("returned", "not_returned")
CHURN = ("churn", "active")
SPEND_CLASS = ("Major Spend", "Tail Spend")          # share > 20 -> first
CONTRACT = ("Contract Available", "Contract Not Available")
PO = ("PO Available", "PO Not Available")
VENDOR_CLASS = ("Single Vendor", "Between 1 and 5", "More than 5")
PO_CLASS = ("Single PO", "Between 1 and 12", "More than 12")
FIRST_YEAR = "1st Year of Purchase for the item"
RANGE_SELECTION = ("> 50 times - Exclude", "Include")  # index > 5000 -> first
# ---------------------------------------------------------------------------


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def order_count_label(n: Column | str) -> Column:
    """1, 2, 3 orders by name, everything else ``4+ Orders``."""
    n = _c(n)
    expr = F.when(n == 1, ORDER_LABELS[1])
    for k in (2, 3):
        expr = expr.when(n == k, ORDER_LABELS[k])
    return expr.otherwise(ORDER_LABEL_MORE)


def reverse_score(c: Column | str) -> Column:
    """1<->4, 2<->3."""
    return (F.lit(5) - _c(c)).cast("int")


def _map_literal(pairs) -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(pairs)])


SEGMENT_MAP = [(code, seg) for seg, codes in SEGMENT_CODES.items() for code in codes]
QUADRANT_MAP = [(seg, quad) for quad, segs in QUADRANT_SEGMENTS.items() for seg in segs]


def segment_of(rfm_int: Column | str) -> Column:
    """3-digit RFM code to customer segment (64 codes, 15 segments)."""
    return F.try_element_at(_map_literal(SEGMENT_MAP), _c(rfm_int).cast("int"))


def quadrant_of(segment: Column | str) -> Column:
    """Segment to Platinum / Gold / Silver / Bronze."""
    return F.try_element_at(_map_literal(QUADRANT_MAP), _c(segment))
