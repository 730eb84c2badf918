"""Sales cleaning (C1-C15): ``raw_orders`` -> ``sales``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions.dates import add_calendar, shift_hours, timestamp_of
from ..session import TENANT

# C1 + C2: source column -> sales column, in the reference's projection order.
SALES_SOURCE = [
    ("ship2_city", "city"), ("ship2_country", "country_iso2"), ("date_created", "created_at"),
    ("ship2_email_address", "email"), ("item_desc", "name"), ("unit_quantity", "qty_ordered"),
    ("order_no", "order_id"), ("customer_id", "customer_id"), ("price", "total"),
    ("supplier_id", "supplier_id"), ("unit_price", "unit_price"),
    ("unit_of_measure", "unit_of_measure"), ("payment_method", "method"),
]
IDENTITY = [dst for _, dst in SALES_SOURCE]
CALENDAR = ["year", "month", "week", "day", "dayofweek", "dayofyear", "just_date",
            "year_month", "month_abbr", "day_abbr", "hour", "quater", "session"]
SALES_COLUMNS = [TENANT, "city", "country_iso2", "date_created", "email", "name", "qty_ordered",
                 "order_id", "customer_id", "total", "supplier_id", "unit_price",
                 "unit_of_measure", "method", *CALENDAR]
SHIFT_HOURS = -8  # -5 h then -3 h


def project_sales(raw: DataFrame) -> DataFrame:
    """C1 + C2: rename and keep the 13 sales columns (plus the tenant)."""
    return raw.select(TENANT, *[F.col(src).alias(dst) for src, dst in SALES_SOURCE])


def drop_sentinel_dates(df: DataFrame, c: str = "created_at") -> DataFrame:
    """C4: text dates equal to ``'None'`` are dropped (no-op on typed input)."""
    if isinstance(df.schema[c].dataType, StringType):
        return df.filter(F.col(c).isNull() | (F.col(c) != "None"))
    return df


def clean_sales(raw: DataFrame) -> DataFrame:
    """C1-C15 on the warehouse ``raw_orders`` table."""
    df = project_sales(raw).dropDuplicates()                       # C3 (whole row)
    df = drop_sentinel_dates(df)                                   # C4
    df = df.withColumn("created_at", shift_hours(timestamp_of(df, "created_at"), SHIFT_HOURS))
    df = df.filter(F.col("created_at").isNotNull() & F.col("email").isNotNull())  # C7
    df = add_calendar(df, "created_at")                            # C6, C8-C14
    df = df.withColumns({                                          # C15
        "total": F.col("total").cast("double"),
        "method": F.col("method").cast("string"),
    })
    return df.withColumnRenamed("created_at", "date_created").select(*SALES_COLUMNS)


def calendar_of(df: DataFrame, ts: str) -> DataFrame:
    """C6 + C8-C14 on any timestamp column (used on ``events.ts``)."""
    return add_calendar(df, ts)
