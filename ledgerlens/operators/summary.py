"""Customer summary (E1-E14): ``sales`` -> ``sales_summary``.

Per-row statistics over a customer's history are computed at the
customer-day grain and joined back once, so a customer holding a third of
all rows never lands in one task: the windows of a customer run over its
distinct purchase days, and the counts are partial (map-side combined)
aggregations. Lines are shuffled once, by customer-day, where a rank in the
day finds its first row and the statistics of the day are joined.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions.labels import CHURN, WIN_BACK, order_count_label
from ..session import TENANT, per_tenant
from .sales import IDENTITY

# Total order inside a customer's day (D1): timestamp, order, item, rest of row.
TIE_BREAK = ["date_created", "order_id", "name", "qty_ordered", "unit_price", "total",
             "customer_id", "supplier_id", "unit_of_measure", "method", "city", "country_iso2"]
# A customer's day. The email leads, because a sort compares its first bytes first.
DAY = ["email", "created_at", TENANT]
SUMMARY_EXTRA = ["created_at", "interval", "min", "max", "len", "mean", "std_", "avg_diff",
                 "win_back", "new_customer", "min_c", "max_c", "diff", "avg_day", "avg_metric",
                 "recent_order", "churn_label", "freq_pur", "repeat_customer"]
STD_FACTOR = 1.4


def valid_dates(sales: DataFrame, c: str = "date_created") -> DataFrame:
    """Drop rows whose date text is shorter than 7 characters (or null)."""
    if isinstance(sales.schema[c].dataType, StringType):
        return sales.filter(F.length(c) >= 7)
    return sales.filter(F.col(c).isNotNull())


def customer_days(df: DataFrame) -> DataFrame:
    """Per (tenant, email, day): rows, and the gap to the previous purchase
    day of the same customer (0 for the first day)."""
    days = df.groupBy(*DAY).agg(F.count(F.lit(1)).alias("_ll_rows"))
    w = Window.partitionBy(TENANT, "email").orderBy("created_at")
    return days.withColumn(
        "_ll_gap",
        F.coalesce(F.datediff("created_at", F.lag("created_at").over(w)), F.lit(0)).cast("bigint"))


def sales_summary(sales: DataFrame, last_day: DataFrame | None = None) -> DataFrame:
    """E1-E14 on ``sales``; output = sales columns + the summary columns.

    ``last_day`` (company_id, last_day) is the tenant's last day of sales where it
    is known already (written with the table); else it is taken from the rows.
    """
    df = valid_dates(sales)
    df = df.withColumn("created_at", F.to_date("date_created")).filter(
        F.col("created_at").isNotNull() & F.col("email").isNotNull())
    df = df.withColumn("year", F.year("created_at"))                       # E2

    days = customer_days(df)
    # E4/E5 over the customer's days (a window bounded by the number of
    # purchase days): interval is the day gap on the first row of each day
    # and 0 on the others, so its sums come from the gaps alone.
    cust = Window.partitionBy(TENANT, "email")
    days = days.withColumns({
        "min": F.min("created_at").over(cust), "max": F.max("created_at").over(cust),
        "len": F.sum("_ll_rows").over(cust), "_ll_s": F.sum("_ll_gap").over(cust),
        "_ll_q": F.sum(F.col("_ll_gap") * F.col("_ll_gap")).over(cust)})
    n = F.col("len").cast("double")
    s = F.col("_ll_s").cast("double")
    # sample variance (n*Q - S^2) / (n(n-1)) in exact integer arithmetic
    num = (F.col("len").cast("decimal(38,0)") * F.col("_ll_q").cast("decimal(38,0)")
           - F.col("_ll_s").cast("decimal(38,0)") * F.col("_ll_s").cast("decimal(38,0)"))
    den = F.col("len").cast("decimal(38,0)") * (F.col("len") - 1).cast("decimal(38,0)")
    std = F.when(F.col("len") > 1,
                 F.sqrt(num.cast("double") / den.cast("double"))).otherwise(F.lit(None))
    if last_day is None:
        last_day = df.groupBy(TENANT).agg(F.max("just_date").alias("last_day"))
    last = last_day.select(TENANT, F.col("last_day").alias("_ll_last"))        # E11
    day_stats = (days.join(per_tenant(last), TENANT)
                 .withColumn("mean", s / n)
                 .withColumn("std_", F.coalesce(F.lit(STD_FACTOR) * std, F.lit(0.0)))
                 .withColumn("diff", F.datediff("max", "min").cast("double"))      # E9
                 .withColumn("avg_day", F.col("diff") / n)                         # E10
                 .withColumn("avg_metric", F.col("avg_day") * 2)
                 .withColumn("recent_order", F.datediff("_ll_last", "max").cast("bigint"))
                 .drop("_ll_s", "_ll_q", "_ll_last", "_ll_rows"))

    # rows equal to the day's first one share its rank
    ranked = df.withColumn("_ll_nth", F.rank().over(Window.partitionBy(*DAY).orderBy(*TIE_BREAK)))
    out = ranked.join(day_stats, DAY)
    out = out.withColumn(                                                     # E3
        "interval",
        F.when(F.col("_ll_nth") == 1, F.col("_ll_gap")).otherwise(F.lit(0)).cast("bigint"))
    out = out.withColumns({
        "avg_diff": F.abs(F.col("interval") - F.col("mean")),                # E6
        "new_customer": (F.col("created_at") == F.col("min")).cast("int"),    # E8
        "min_c": F.col("min"), "max_c": F.col("max"),
        "freq_pur": order_count_label("len"),                                # E13
    })
    out = out.withColumns({
        "win_back": F.when(((F.col("len") > 2) & (F.col("avg_diff") > F.col("std_")))   # E7
                           | ((F.col("len") == 2) & (F.col("interval") > 0)), WIN_BACK[0])
        .otherwise(WIN_BACK[1]),
        "churn_label": F.when(F.col("recent_order") > F.col("avg_metric"), CHURN[0])  # E12
        .otherwise(CHURN[1]),
        "repeat_customer": (F.col("freq_pur") == "4+ Orders").cast("int"),    # E14
    })
    keep = [c for c in sales.columns]
    return out.select(*keep, *SUMMARY_EXTRA)


__all__ = ["sales_summary", "customer_days", "valid_dates", "IDENTITY"]
