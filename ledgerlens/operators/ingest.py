"""Loading: initial full load and high-watermark incremental pulls.

One job serves every tenant: the watermark, the surrogate key and the
status are computed per ``company_id``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import timestamp_of
from ..session import TENANT, per_tenant
from ..sources.extract import with_line_amount
from .ordering import written_row_number

COMPLETED, NOTHING_NEW = "completed", "no recent data"


def history_cutoff(df: DataFrame, cutoff: str, ts: str = "date_created") -> DataFrame:
    """I3 + I4: parse the timestamp and keep rows on or after ``cutoff``."""
    return (df.withColumn(ts, timestamp_of(df, ts))
            .filter(F.col(ts) >= F.lit(cutoff).cast("timestamp_ntz")))


def prepare_orders(extract: DataFrame, cutoff: str | None = None) -> DataFrame:
    """I1 + I3 (+ I4 when ``cutoff``): line amount and parsed timestamp."""
    df = with_line_amount(extract, "unit_quantity")
    df = df.withColumn("date_created", timestamp_of(df, "date_created"))
    return history_cutoff(df, cutoff) if cutoff else df


def prepare_purchases(extract: DataFrame, cutoff: str | None = None) -> DataFrame:
    """I2 + I3 (+ I4 when ``cutoff``): line amount, timestamp and year."""
    df = with_line_amount(extract, "qty_ordered")
    df = df.withColumn("date_created", timestamp_of(df, "date_created"))
    if cutoff:
        df = history_cutoff(df, cutoff)
    return df.withColumn("year", F.year("date_created"))


def surrogate_index(df: DataFrame, order: Sequence[str], start: DataFrame | None = None,
                    name: str = "index") -> DataFrame:
    """Number rows ``start + 0, 1, ...`` per tenant in ``order``, which begins
    with the business key. The rows are shuffled and written once; the result reads
    that copy, so it need not be materialized again.

    ``start`` holds ``(company_id, next_index)``; tenants missing from it
    start at 0 (the initial load numbers from 0 like a reset row index).
    """
    numbered = written_row_number(df, order, [TENANT], "_ll_rn")
    if start is not None:
        numbered = numbered.join(per_tenant(start), TENANT, "left")
    else:
        numbered = numbered.withColumn("next_index", F.lit(None).cast("bigint"))
    return numbered.withColumn(
        name, F.coalesce(F.col("next_index"), F.lit(0)) + F.col("_ll_rn") - 1
    ).drop("_ll_rn", "next_index")


def watermark(df: DataFrame, key: str, name: str = "watermark") -> DataFrame:
    """I8: ``max(key)`` per tenant."""
    return df.groupBy(TENANT).agg(F.max(key).alias(name))


def next_index(target: DataFrame, name: str = "index") -> DataFrame:
    return target.groupBy(TENANT).agg((F.max(name) + 1).alias("next_index"))


def incremental_delta(source: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Source rows whose ``key`` is above the tenant's target watermark.

    A tenant with no rows in the target takes everything. Lines added later
    to an already pulled key are not picked up (same as the reference).
    """
    wm = watermark(target, key, "_ll_wm")
    return (source.join(per_tenant(wm), TENANT, "left")
            .filter(F.col("_ll_wm").isNull() | (F.col(key) > F.col("_ll_wm")))
            .drop("_ll_wm"))


def incremental_load(source: DataFrame, target: DataFrame, key: str,
                     order: Sequence[str]) -> DataFrame:
    """I5/I6 + I7: new rows with ``index`` continuing the target's."""
    delta = incremental_delta(source, target, key)
    return surrogate_index(delta, order, next_index(target))


def ingest_status(source: DataFrame, target: DataFrame, key: str, step: str) -> DataFrame:
    """I8 + I9: per tenant ``(step, source_max, target_max, n_new, status)``.

    ``status`` is ``completed`` when there is something new, which is the
    gate downstream jobs check; otherwise ``no recent data``. Source and target
    are each read once.
    """
    tgt = watermark(target, key, "target_max")
    new = F.col("target_max").isNull() | (F.col(key) > F.col("target_max"))
    src = source.select(TENANT, key).join(per_tenant(tgt), TENANT, "left").groupBy(TENANT).agg(
        F.max(key).alias("source_max"), F.max("target_max").alias("target_max"), F.count_if(new).alias("n_new"))
    gone = tgt.join(src.select(TENANT), TENANT, "left_anti").select(
        TENANT, F.lit(None).cast(src.schema["source_max"].dataType).alias("source_max"), "target_max",
        F.lit(0).cast("bigint").alias("n_new"))
    return src.unionByName(gone).select(
        TENANT, F.lit(step).alias("step"), "source_max", "target_max", "n_new",
        F.when(F.col("n_new") > 0, COMPLETED).otherwise(NOTHING_NEW).alias("status"))
