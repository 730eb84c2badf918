"""Hand-made rows in the warehouse schemas (FIXTURES.md section 3)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ledgerlens.schemas import PURCHASE_ORDER, RAW_ORDERS, conform


def ts(day: str, hour: int = 12) -> dt.datetime:
    return dt.datetime.fromisoformat(day) + dt.timedelta(hours=hour)


def raw_orders(spark, rows: list[dict]):
    """Order lines; unspecified columns get harmless defaults."""
    base = {"company_id": "t0", "customer_id": 1, "ship2_name": "n", "ship2_city": "X",
            "ship2_country": "X", "unit_price": 10.0, "unit_quantity": 1.0,
            "unit_of_measure": "EA", "payment_method": "card", "supplier_id": 1,
            "item_desc": "item"}
    full = []
    for i, r in enumerate(rows):
        x = dict(base)
        x.setdefault("order_no", i + 1)
        x.update(r)
        x.setdefault("price", x["unit_price"] * x["unit_quantity"])
        full.append(x)
    cols = sorted({k for r in full for k in r})
    df = spark.createDataFrame([tuple(r.get(c) for c in cols) for r in full], schema=_schema(cols))
    return conform(df, RAW_ORDERS).drop("index")


def purchase_order(spark, rows: list[dict]):
    base = {"company_id": "t0", "qty_ordered": 1.0, "unit_price": 10.0,
            "date_created": ts("2020-01-10"), "vendor_name": "v1", "vendor_id": 1,
            "item_description": "item", "contract_number": None, "po_no": 1}
    full = []
    for i, r in enumerate(rows):
        x = dict(base)
        x.update(r)
        x.setdefault("price", x["unit_price"] * x["qty_ordered"])
        x.setdefault("year", x["date_created"].year)
        x.setdefault("index", i)
        full.append(x)
    cols = sorted({k for r in full for k in r})
    df = spark.createDataFrame([tuple(r.get(c) for c in cols) for r in full], schema=_schema(cols))
    return conform(df, PURCHASE_ORDER)


def _schema(cols):
    types = {f.name: f.dataType.simpleString() for f in list(RAW_ORDERS) + list(PURCHASE_ORDER)}
    return ", ".join(f"{c} {types.get(c, 'string')}" for c in cols)


def rows_by(df, key):
    return {r[key]: r for r in df.collect()}


def col(df, name, order=None):
    d = df.orderBy(*(order or [name])) if order else df
    return [r[name] for r in d.select(name).collect()]


__all__ = ["ts", "raw_orders", "purchase_order", "rows_by", "col", "F"]
