"""The daily refresh: every derived table, all tenants, in one application.

Same graph as the reference's scheduler, expressed as DataFrame
dependencies:

    raw_orders -> sales -> sales_summary -> rfm, rfm_one -> summ_rfm
                       |                 -> churn / order forecasts
                       -> sales_forecasting, gap churn
                       -> cohort_half/retention_half, cohort_year/retention_year
    purchase_order -> vendor_spend_analysis -> vendor_deals

Tables read by several jobs are written once and read back (never
recomputed); every table is replaced as a whole, partitioned by
``company_id``, so re-running a refresh is idempotent and a tenant without
rows is gone. Given a list of tenants, only theirs are read and replaced.
The last day of each tenant's sales, which several jobs compare with, comes from
the footers of the written ``sales`` files.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import cohort as H
from ..operators import forecast as FC
from ..operators import rfm as R
from ..operators import series as FS
from ..operators import vendor as V
from ..operators.churn_gap import gap_churn
from ..operators.sales import clean_sales
from ..operators.summary import sales_summary
from ..session import TENANT, only_read
from ..sources.sinks import write_append, write_overwrite, write_tenants
from ..sources.tables import footer_maxima, path_exists, read_partitioned


class Warehouse:
    """Parquet tables under one root, partitioned by tenant."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.timings: dict[str, float] = {}

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def write(self, name: str, build: Callable[[], DataFrame],
              sort_within: list[str] | None = None, tenants: list[str] | None = None,
              key: str | None = None) -> DataFrame:
        """Build (some operators run eager steps while building) and write.

        With ``tenants`` only theirs are replaced, and only theirs are returned. A large
        input is written in passes by ``key``. Tables that the build wrote on the way go
        when the result is written.
        """
        def run() -> DataFrame:
            if tenants is None:
                write_overwrite(build(), self.path(name), sort_within, key=key)
            else:
                write_tenants(build(), self.path(name), tenants, sort_within, key)
            return self.read(name, tenants)

        t = time.perf_counter()
        out = only_read(run)
        self.timings[name] = round(time.perf_counter() - t, 3)
        return out

    def append(self, name: str, build: Callable[[], DataFrame]) -> None:
        def run() -> DataFrame:
            write_append(build(), self.path(name))
            return self.read(name)

        only_read(run)

    def has(self, name: str) -> bool:
        return path_exists(self.spark, self.path(name))

    def read(self, name: str, tenants: list[str] | None = None) -> DataFrame:
        df = read_partitioned(self.spark, self.path(name))
        return df if tenants is None else df.where(F.col(TENANT).isin(list(tenants)))

    def maxima(self, name: str, *columns: str) -> dict[str, dict]:
        """Per-tenant maxima of columns, from file footers (none: no table yet)."""
        return footer_maxima(self.spark, self.path(name), columns) if self.has(name) else {}

    def last_days(self, name: str = "sales", column: str = "just_date") -> DataFrame:
        """``(company_id, last_day)`` without a scan of the rows."""
        rows = [(t, m[column]) for t, m in self.maxima(name, column).items()]
        return self.spark.createDataFrame(rows, f"{TENANT} string, last_day date")


def refresh_sales(wh: Warehouse, raw_orders: DataFrame, only: Callable[[str], bool] = lambda name: True,
                  cohort_start: str | None = None, cohort_end: str | None = None,
                  tenants: list[str] | None = None) -> None:
    """Every table derived from ``raw_orders``."""
    def write(name: str, build: Callable[[], DataFrame], key: str | None = None) -> DataFrame:
        return wh.write(name, build, tenants=tenants, key=key)

    sales = write("sales", lambda: clean_sales(raw_orders), "order_id")
    last = wh.last_days()
    summary = write("sales_summary", lambda: sales_summary(sales, last), "email")
    if only("rfm"):
        rfm = write("rfm", lambda: R.rfm_table(sales, summary))
        write("rfm_one", lambda: R.rfm_table(sales, summary, trailing_days=365, last_day=last))
        write("summ_rfm", lambda: R.summary_with_segments(rfm, summary), "email")
    if only("cohort"):
        for months, tag in ((H.HALF_MONTHS, "half"), (H.YEAR_MONTHS, "year")):
            counts = write(f"cohort_{tag}", lambda m=months: H.cohort_counts(
                H.cohort_data(sales, m, cohort_start, cohort_end), m))
            write(f"retention_{tag}", lambda m=months, c=counts: H.retention(c, m))
    if only("forecast"):
        write("sales_forecasting", lambda: FC.forecast(FC.forecast_features(
            FS.future_frame(FS.daily_sales(sales)))))
        write("churn_forecasting", lambda: FC.forecast(FC.forecast_features(
            FS.future_frame(FS.densify(FS.daily_churn(summary))))))
        write("order_forecasting", lambda: FC.forecast(FC.forecast_features(
            FS.future_frame(FS.densify(FS.daily_orders(summary))))))
    if only("gap_churn"):
        write("gap_churn", lambda: gap_churn(sales, last))


def refresh_vendors(wh: Warehouse, purchase_order: DataFrame, only: Callable[[str], bool] = lambda name: True,
                    tenants: list[str] | None = None) -> None:
    """Every table derived from ``purchase_order``."""
    if only("vendor"):
        vsa = wh.write("vendor_spend_analysis", lambda: V.vendor_spend_analysis(purchase_order),
                       sort_within=["date_created"], tenants=tenants, key=V.ITEM)
        wh.write("vendor_deals", lambda: V.vendor_deals(vsa, sort=False), tenants=tenants, key=V.ITEM)


def refresh(wh: Warehouse, raw_orders: DataFrame, purchase_order: DataFrame,
            only: Callable[[str], bool] = lambda name: True,
            cohort_start: str | None = None, cohort_end: str | None = None) -> dict[str, float]:
    """Rebuild every derived table from the two loaded base tables.

    ``cohort_start`` and ``cohort_end`` are the scan bounds of the scheduled
    cohort job (H1).
    """
    refresh_sales(wh, raw_orders, only, cohort_start, cohort_end)
    refresh_vendors(wh, purchase_order, only)
    return wh.timings
