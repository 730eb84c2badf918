"""Published form of a table: dates as ISO text, as the reference stores them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType


def publish(df: DataFrame, nullable_ints: tuple[str, ...] = ()) -> DataFrame:
    """Dates become ISO text; ``nullable_ints`` (integer keys that may be
    missing, e.g. ``po_no``) become double, the type the reference's tables
    give them once NaN appears."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, DateType):
            out.append(F.date_format(f.name, "yyyy-MM-dd").alias(f.name))
        elif f.name in nullable_ints:
            out.append(F.col(f.name).cast("double").alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)
