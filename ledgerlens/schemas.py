"""Declared schemas of the warehouse tables (S11) and ``conform``.

The reference infers column types from pandas dtypes at write time; here
the base tables have explicit StructTypes and inputs are cast to them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (DoubleType, IntegerType, LongType, StringType, StructField,
                               StructType, TimestampNTZType)

from .session import TENANT


def _s(*fields: tuple[str, object]) -> StructType:
    return StructType([StructField(n, t(), True) for n, t in fields])


RAW_ORDERS = _s(
    (TENANT, StringType), ("order_no", LongType), ("date_created", TimestampNTZType),
    ("customer_id", LongType), ("ship2_name", StringType), ("ship2_email_address", StringType),
    ("ship2_add1", StringType), ("ship2_add2", StringType), ("ship2_add3", StringType),
    ("ship2_city", StringType), ("ship2_country", StringType), ("unit_price", DoubleType),
    ("unit_quantity", DoubleType), ("unit_of_measure", StringType),
    ("payment_method", StringType), ("supplier_id", LongType), ("sales_tax", DoubleType),
    ("sales_cost", DoubleType), ("item_desc", StringType),
    *[(f"class_id{i}", StringType) for i in range(1, 6)],
    *[(f"price{i}", DoubleType) for i in range(1, 11)],
    ("price", DoubleType), ("index", LongType))

PURCHASE_ORDER = _s(
    (TENANT, StringType), ("po_no", LongType), ("qty_ordered", DoubleType),
    ("qty_received", DoubleType), ("unit_price", DoubleType), ("date_created", TimestampNTZType),
    ("date_last_modified", TimestampNTZType), ("item_description", StringType),
    ("unit_of_measure", StringType), ("contract_number", StringType), ("vendor_id", LongType),
    ("ship2_name", StringType), ("ship2_add1", StringType), ("ship2_add2", StringType),
    ("ship2_city", StringType), ("ship2_state", StringType), ("ship2_country", StringType),
    ("ship2_zip", StringType), ("location_id", LongType), ("vendor_name", StringType),
    ("price", DoubleType), ("year", IntegerType), ("index", LongType))

TABLES = {"raw_orders": RAW_ORDERS, "purchase_order": PURCHASE_ORDER}


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Select the schema's columns in order, cast to their types;
    missing columns become typed nulls, extra columns are dropped."""
    have = {c.lower(): c for c in df.columns}
    return df.select(*[
        (F.col(have[f.name.lower()]) if f.name.lower() in have else F.lit(None))
        .cast(f.dataType).alias(f.name)
        for f in schema.fields])
