"""Daily series for forecasting (F1-F6): aggregate, densify, fill, extend."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import last_full_month_end
from ..functions.rounding import money_sum
from ..session import TENANT

HORIZON = 90


def _full_months(daily: DataFrame) -> DataFrame:
    """Days up to the end of the tenant's last full month. The window is over
    one row per tenant-day, so it is bounded by the calendar, and the cut costs
    no second scan of the lines."""
    last = F.max("ds").over(Window.partitionBy(TENANT))
    return daily.withColumn("_ll_cut", last_full_month_end(last)).filter(F.col("ds") <= F.col("_ll_cut")).drop("_ll_cut")


def daily_sales(sales: DataFrame) -> DataFrame:
    """full months only, ``sum(total)`` per day, no gap filling."""
    lines = sales.select(TENANT, F.to_date("date_created").alias("ds"), "total").filter(F.col("ds").isNotNull())
    return _full_months(lines.groupBy(TENANT, "ds").agg(
        F.coalesce(money_sum("total"), F.lit(0.0)).alias("y")))


def daily_orders(summary: DataFrame) -> DataFrame:
    """full months only, ``count(order_id)`` per day."""
    lines = summary.select(TENANT, F.to_date("date_created").alias("ds"), "order_id").filter(F.col("ds").isNotNull())
    return _full_months(lines.groupBy(TENANT, "ds").agg(F.count("order_id").cast("double").alias("y")))


def daily_churn(summary: DataFrame) -> DataFrame:
    """rows labelled ``churn`` per day (no month cut)."""
    df = summary.filter(F.col("churn_label") == "churn").select(
        TENANT, F.to_date("date_created").alias("ds"))
    return df.filter(F.col("ds").isNotNull()).groupBy(TENANT, "ds").agg(
        F.count(F.lit(1)).cast("double").alias("y"))


def densify(series: DataFrame) -> DataFrame:
    """F4 + F5: every day between a tenant's first and last day; gaps get the
    mean of the observed days. The calendar is one row per tenant-day."""
    span = series.groupBy(TENANT).agg(F.min("ds").alias("_ll_lo"), F.max("ds").alias("_ll_hi"),
                                      F.avg("y").alias("_ll_mean"))
    cal = span.select(TENANT, "_ll_mean", F.explode(
        F.sequence("_ll_lo", "_ll_hi", F.expr("INTERVAL 1 DAY"))).alias("ds"))
    return (cal.join(series, [TENANT, "ds"], "left")
            .select(TENANT, "ds", F.coalesce("y", "_ll_mean").alias("y")))


def future_frame(series: DataFrame, horizon: int = HORIZON) -> DataFrame:
    """history days plus the next ``horizon`` days (``y`` null there)."""
    last = series.groupBy(TENANT).agg(F.max("ds").alias("_ll_hi"))
    ahead = last.select(TENANT, F.explode(F.sequence(
        F.date_add("_ll_hi", 1), F.date_add("_ll_hi", horizon),
        F.expr("INTERVAL 1 DAY"))).alias("ds"))
    return series.select(TENANT, "ds", "y").unionByName(
        ahead.withColumn("y", F.lit(None).cast("double")))
