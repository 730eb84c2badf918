"""Query catalog: every registered query as ``(spark, sf_dir) -> DataFrame``.

Each query reads the whole test tables through the stand-ins and runs the
library's operators on them. Dates are published as ISO text.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import add_calendar
from ..functions.labels import quadrant_of, segment_of
from ..functions.rounding import half_even, money_sum
from ..operators import cohort as H
from ..operators import forecast as FC
from ..operators import ingest as I
from ..operators import rfm as R
from ..operators import series as FS
from ..operators import vendor as V
from ..operators.churn_gap import gap_churn
from ..operators.sales import SALES_COLUMNS, clean_sales, drop_sentinel_dates
from ..operators.summary import SUMMARY_EXTRA, sales_summary, valid_dates
from ..session import TENANT, bounded, ensure_checkpoint_dir, materialize, only_read, per_tenant, scratch
from ..sources import sinks as K
from ..sources import standins as S
from ..sources.extract import order_extract, purchase_extract
from ..sources.tables import read_partitioned
from .publish import publish

Query = Callable[[SparkSession, str], DataFrame]

HISTORY_CUTOFF = "1997-01-01"   # I4 parameter (the reference's 2017 would drop all test rows)
# target state of the incremental-load queries: share of each tenant's key range
# that is loaded; nothing new for MACHINERY, nothing loaded for HOUSEHOLD
SNAPSHOT_SHARES = {"AUTOMOBILE": 0.25, "BUILDING": 0.5, "FURNITURE": 0.75, "MACHINERY": 1.0}
COHORT_RUN_DAY = "2001-08-01"   # H1: scan [run day - 400 d, run day]
COHORT_SCAN_DAYS = 400
TRAILING_DAYS = 365             # R2
Z_DIGITS = 8                    # published z-scores
FORECAST_DIGITS = 6             # published forecasts


# -- shared inputs -------------------------------------------------------------
# The reference stores sales, sales_summary and purchase_order as tables that
# several jobs read; queries built on them start from a copy written once under
# the checkpoint folder the same way.
def _sales(spark: SparkSession, sf: str, multi: bool = False) -> DataFrame:
    return materialize(clean_sales(S.raw_orders(spark, sf, multi_tenant=multi)), key="order_id")


def _dated_sales(spark: SparkSession, sf: str, multi: bool = False) -> tuple[DataFrame, DataFrame]:
    """``sales`` written by tenant, as the refresh does, and each tenant's last day
    from its footers."""
    from .refresh import Warehouse
    wh = Warehouse(spark, f"{ensure_checkpoint_dir(spark)}/warehouse-{uuid.uuid4().hex}")
    scratch(spark, wh.root)
    return wh.write("sales", lambda: clean_sales(S.raw_orders(spark, sf, multi_tenant=multi)), key="order_id"), wh.last_days()


def _summary(spark: SparkSession, sf: str, sales: DataFrame | None = None,
             multi: bool = False, last: DataFrame | None = None) -> DataFrame:
    def make() -> DataFrame:
        known = (sales, last) if sales is not None else _dated_sales(spark, sf, multi)
        return materialize(sales_summary(*known), key="email")

    return only_read(make)


def _summary_once(spark: SparkSession, sf: str, multi: bool = False) -> DataFrame:
    """``sales_summary`` for a query that reads it once: no copy unless it takes passes."""
    return only_read(lambda: bounded(sales_summary(*_dated_sales(spark, sf, multi)), "email"))


def _po(spark: SparkSession, sf: str, multi: bool = False) -> DataFrame:
    return S.purchase_order(spark, sf, multi_tenant=multi)  # numbered, hence written already


def _vsa(spark: SparkSession, sf: str, multi: bool = False) -> DataFrame:
    return V.vendor_spend_analysis(_po(spark, sf, multi))  # each query reads it once: no copy


# -- sources and loading ---------------------------------------------------------
def q_order_extract(spark, sf):
    """S1 over the ERP stand-ins."""
    return order_extract(*S.erp_order_tables(spark, sf))


def q_purchase_extract(spark, sf):
    """S2 + I2."""
    return I.prepare_purchases(purchase_extract(*S.erp_purchase_tables(spark, sf)))


def q_history_cutoff(spark, sf):
    """I1 + I3 + I4."""
    return S.raw_orders(spark, sf, cutoff=HISTORY_CUTOFF)


def q_surrogate_index(spark, sf):
    """I11 + I7: initial full load of raw_orders with its 0-based index."""
    return S.raw_orders(spark, sf, with_index=True, cutoff=HISTORY_CUTOFF)


def _loaded(src: DataFrame, key: str) -> DataFrame:
    """Rows of the target: those up to the tenant's cut, a share of its highest
    key, and those without a key. A tenant not in SNAPSHOT_SHARES has no target."""
    top = src.groupBy(TENANT).agg(F.max(key).alias("_ll_top"))
    share = F.create_map(*(F.lit(x) for pair in SNAPSHOT_SHARES.items() for x in pair))[F.col(TENANT)]
    cut = per_tenant(top.select(TENANT, F.floor(F.col("_ll_top") * share).alias("_ll_cut")))
    return (src.join(cut, TENANT).filter(F.col("_ll_cut").isNotNull()
                                         & (F.col(key).isNull() | (F.col(key) <= F.col("_ll_cut")))).drop("_ll_cut"))


def _order_snapshot(spark, sf):
    """Source and target of the tenants; target + delta = source."""
    src = materialize(I.prepare_orders(order_extract(*S.erp_order_tables(spark, sf, multi_tenant=True))), key="order_no")
    return src, I.surrogate_index(_loaded(src, "order_no"), S.ORDER_INDEX_ORDER)


def _po_snapshot(spark, sf):
    src = materialize(S.purchase_order(spark, sf, multi_tenant=True, with_index=False), key="po_no")
    return src, I.surrogate_index(_loaded(src, "po_no"), S.PURCHASE_INDEX_ORDER)


def _landed(rows: DataFrame, key: str, new: bool) -> DataFrame:
    """First or second day's share of the headers (see SNAPSHOT_SHARES)."""
    top = rows.groupBy(TENANT).agg(F.max(key).alias("_ll_top"))
    share = F.create_map(*(F.lit(x) for pair in SNAPSHOT_SHARES.items() for x in pair))[F.col(TENANT)]
    cut = per_tenant(top.select(TENANT, F.floor(F.col("_ll_top") * share).alias("_ll_cut")))
    old = F.col("_ll_cut").isNotNull() & (F.col(key) <= F.col("_ll_cut"))
    return rows.join(cut, TENANT).where(~old if new else old).drop("_ll_cut")


def two_days(spark, sf, only: Callable[[str], bool]):
    """Two deliveries and two daily runs; the warehouse, the second day's status and
    the files of every table before and after it."""
    from .daily import daily_run
    from .refresh import Warehouse
    root = f"{ensure_checkpoint_dir(spark)}/daily-{uuid.uuid4().hex}"
    wh = Warehouse(spark, f"{root}/warehouse")
    S.land(spark, sf, f"{root}/landing", lambda rows, key: _landed(rows, key, False))
    daily_run(wh, f"{root}/landing", only)
    tables = list(wh.timings)
    before = {t: K.tenant_files(spark, wh.path(t)) for t in tables}
    S.land(spark, sf, f"{root}/landing", lambda rows, key: _landed(rows, key, True))
    status = daily_run(wh, f"{root}/landing", only)
    return wh, status, before, {t: K.tenant_files(spark, wh.path(t)) for t in tables}


def q_daily_run_summary(spark, sf):
    """I5 + I7 + I8 + I9: ``sales_summary`` of every tenant after two daily runs."""
    wh, *_ = two_days(spark, sf, lambda group: False)
    return publish(wh.read("sales_summary").select(*SALES_COLUMNS, *SUMMARY_EXTRA))


def q_daily_run_items(spark, sf):
    """I6 + I9: spend per item of every tenant after two daily runs."""
    wh, *_ = two_days(spark, sf, lambda group: group == "vendor")
    return (wh.read("vendor_spend_analysis").groupBy(TENANT, "item_description")
            .agg(F.count("index").alias("lines"), F.max("index").alias("last_index"), money_sum("price").alias("spend"),
                 F.max("spend_class").alias("spend_class"), F.max("no_of_pos").alias("no_of_pos")))


def q_daily_run_status(spark, sf):
    """I8 + I9: the second day's status rows."""
    return publish(two_days(spark, sf, lambda group: False)[1], ("target_max",))


def q_daily_run_files(spark, sf):
    """Per table and tenant, what the second day did to its files."""
    _, _, before, after = two_days(spark, sf, lambda group: group in ("vendor", "gap_churn"))
    rows = [(t, folder.split("=", 1)[1], "new" if folder not in before[t] else
             "kept" if before[t][folder] == files else "rebuilt")
            for t, folders in after.items() for folder, files in folders.items()]
    return spark.createDataFrame(rows, f"table string, {TENANT} string, files string")


def q_incremental_completeness(spark, sf):
    """I5 + I6: per tenant, lines of source, target and delta (target + delta = source)."""
    parts = []
    for step, key, (src, target) in (("recent_order", "order_no", _order_snapshot(spark, sf)),
                                     ("recent_vendor", "po_no", _po_snapshot(spark, sf))):
        named = [(src, "source"), (target, "target"), (I.incremental_delta(src, target, key), "delta")]
        parts += [df.groupBy(TENANT).agg(F.count(F.lit(1)).alias("lines"))
                  .select(TENANT, F.lit(step).alias("step"), F.lit(part).alias("part"), "lines") for df, part in named]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def q_incremental_orders(spark, sf):
    """I5 + I7 + I8: new order lines above the watermark, index continued."""
    src, target = _order_snapshot(spark, sf)
    return I.incremental_load(src, target, "order_no", S.ORDER_INDEX_ORDER)


def q_incremental_pos(spark, sf):
    """I6 + I7 + I8 for purchase-order lines."""
    src, target = _po_snapshot(spark, sf)
    return publish(I.incremental_load(src, target, "po_no", S.PURCHASE_INDEX_ORDER), ("po_no",))


def q_ingest_status(spark, sf):
    """I8 + I9: status row per tenant and step."""
    orders = only_read(lambda: materialize(I.ingest_status(*_order_snapshot(spark, sf), "order_no", "recent_order")))
    pos = only_read(lambda: materialize(I.ingest_status(*_po_snapshot(spark, sf), "po_no", "recent_vendor")))
    return publish(orders.unionByName(pos), ("target_max",))


def q_append_with_key(spark, sf):
    """S6 + S7 + S10: a doubled incremental batch, delivered twice, is appended once."""
    held = []

    def load() -> DataFrame:  # numbered on from the target, no longer in need of the source
        src, target = _order_snapshot(spark, sf)
        held.append(target)
        return I.incremental_load(src, target, "order_no", S.ORDER_INDEX_ORDER)

    def make() -> DataFrame:
        delta, target = only_read(load), held[0]
        root = f"{ensure_checkpoint_dir(spark)}/warehouse-{uuid.uuid4().hex}"
        scratch(spark, root)
        path = f"{root}/raw_orders"
        K.write_overwrite(target, path)
        for _ in range(2):
            K.append_with_key(delta.unionByName(delta), path, "index")
        rows = read_partitioned(spark, path).select(*delta.columns)
        return bounded(rows.join(target.select(TENANT, "index"), [TENANT, "index"], "left_anti").select(*delta.columns), "index")

    return only_read(make)


def q_append_null_keys(spark, sf):
    """Purchase lines keyed by their PO number; those without one are rejected."""
    po = S.purchase_order(spark, sf, with_index=False)
    return publish(K.rows_to_append(po, None, "po_no", S.PURCHASE_INDEX_ORDER), ("po_no",))


def q_blank_columns(spark, sf):
    """Headers with a blank column name."""
    _, hdr, _ = S.erp_order_tables(spark, sf)
    return K.name_blank_columns(hdr.select(TENANT, "order_no", "ship2_name").toDF(TENANT, "order_no", "  "))


def q_text_dates(spark, sf):
    """C4 + E1 on order dates that came as text, some ``None`` and some cut short."""
    _, hdr, _ = S.erp_order_tables(spark, sf)
    day = F.date_format("date_created", "yyyy-MM-dd")
    text = (F.when(F.col("order_no") % 7 == 0, F.lit("None")).when(F.col("order_no") % 11 == 0, F.substring(day, 1, 6))
            .when(F.col("order_no") % 13 != 0, day))
    rows = hdr.select(TENANT, "order_no", text.alias("date_created"))
    kept = drop_sentinel_dates(rows, "date_created")
    return kept.select(*kept.columns, F.lit("sentinel").alias("step")).unionByName(
        valid_dates(kept).select(*kept.columns, F.lit("valid").alias("step")))


def q_dedupe_columns(spark, sf):
    """An expression join keeps both ``order_no`` columns; the first wins."""
    line, hdr, _ = S.erp_order_tables(spark, sf)
    return K.remove_dup_columns(line.join(hdr, line.order_no == hdr.order_no, "inner"))


def q_warehouse_roundtrip(spark, sf):
    """S4 + S5: daily sales written for all tenants twice, the second time
    without one of them, and read back; ids are read as they were written."""
    from .refresh import Warehouse
    wh = Warehouse(spark, f"{ensure_checkpoint_dir(spark)}/warehouse-{uuid.uuid4().hex}")
    daily = FS.daily_sales(_sales(spark, sf, multi=True)).withColumn(
        TENANT, F.lpad(F.ascii(TENANT).cast("string"), 4, "0"))  # ids such as 0065: all digits
    daily = materialize(daily.groupBy(TENANT, "ds").agg(money_sum("y").alias("y")))
    wh.write("daily", lambda: daily)
    return publish(wh.write("daily", lambda: daily.filter(F.col(TENANT) != "0077")))


# -- sales -------------------------------------------------------------------------
def q_sales_clean(spark, sf):
    """raw_orders -> sales."""
    return publish(_sales(spark, sf))


def q_sales_replay_dedupe(spark, sf):
    """A re-delivered extract (every line twice) cleans to the same sales."""
    raw = S.raw_orders(spark, sf)
    return publish(clean_sales(raw.unionByName(raw)))


def q_tenant_sales(spark, sf):
    """Sales for every tenant in one job."""
    return publish(_sales(spark, sf, multi=True))


def q_schema_conform(spark, sf):
    """The loaded raw_orders cast to its declared schema."""
    from ..schemas import RAW_ORDERS, conform
    return conform(S.raw_orders(spark, sf, with_index=True), RAW_ORDERS)


# -- every job for all tenants at once (I10) -------------------------------------
def q_tenant_sales_summary(spark, sf):
    return publish(_summary_once(spark, sf, multi=True))


def q_tenant_rfm_segments(spark, sf):
    sales, last = _dated_sales(spark, sf, multi=True)
    return publish(R.rfm_table(sales, sales_summary(sales, last), clusters=False))  # read once: no copy


def q_tenant_cohort_year(spark, sf):
    m = H.YEAR_MONTHS
    return H.cohort_counts(H.cohort_data(_sales(spark, sf, multi=True), m), m)


def q_tenant_vendor_deals(spark, sf):
    return only_read(lambda: V.vendor_deals(_vsa(spark, sf, multi=True)))


def q_tenant_order_forecast(spark, sf):
    """F9 for every tenant in one job."""
    daily = FS.densify(FS.daily_orders(_summary(spark, sf, multi=True)))
    return _published_forecast(FC.forecast_features(FS.future_frame(daily)))


def _events_calendar(spark, sf):
    ev = S.read_table(spark, sf, "events").select("event_id", "ts")
    return add_calendar(ev, "ts")


def q_sales_dateparts(spark, sf):
    """C6 + C8-C13 on events.ts (timestamps with a time of day)."""
    return publish(_events_calendar(spark, sf).drop("session"))


def q_sales_session(spark, sf):
    """C12 + C14 on events.ts."""
    return _events_calendar(spark, sf).select("event_id", "ts", "hour", "session")


# -- customer summary and churn -------------------------------------------------------
def q_sales_summary(spark, sf):
    """E1-E14."""
    return publish(_summary_once(spark, sf))


def q_winback(spark, sf):
    """Rows per win-back label and customer length."""
    return (_summary(spark, sf).groupBy(TENANT, "win_back", "freq_pur")
            .agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("email").alias("customers")))


CUSTOMER_LEVEL = ["min_c", "max_c", "len", "diff", "avg_day", "avg_metric", "recent_order",
                  "churn_label", "freq_pur", "repeat_customer"]


def q_sparse_labels(spark, sf):
    """E7 + E12-E14 where customers have few lines: every label occurs."""
    raw = S.raw_orders(spark, sf).withColumn("ship2_email_address", F.concat(
        "ship2_email_address", F.lit("#"), (F.col("order_no") % 29).cast("string")))
    summary = materialize(sales_summary(materialize(clean_sales(raw))))
    return summary.groupBy(TENANT, "freq_pur", "repeat_customer", "win_back", "churn_label").agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct("email").alias("customers"))


def q_churn_labels(spark, sf):
    """E9-E12 at customer grain."""
    return publish(_summary(spark, sf).select(TENANT, "email", *CUSTOMER_LEVEL[:8]).distinct())


def q_repeat_customers(spark, sf):
    """E13 + E14: customers per frequency label."""
    cust = _summary(spark, sf).select(TENANT, "email", "freq_pur", "repeat_customer").distinct()
    return cust.groupBy(TENANT, "freq_pur", "repeat_customer").agg(
        F.count(F.lit(1)).alias("customers"))


def q_gap_churn(spark, sf):
    """G1-G4."""
    return publish(gap_churn(*_dated_sales(spark, sf)))


# -- RFM ----------------------------------------------------------------------------
def q_rfm_base(spark, sf):
    """R1, R3-R6."""
    return R.rfm_base(_sales(spark, sf))


def q_rfm_scaled(spark, sf):
    """Standardised logs (published to 8 places)."""
    z = R.rfm_scaled(R.rfm_base(_sales(spark, sf)))
    return z.select(TENANT, "email", *[half_even(c, Z_DIGITS).alias(c) for c in R.SCALED])


def q_rfm_scores(spark, sf):
    """R9-R12."""
    return R.rfm_scores(R.rfm_base(_sales(spark, sf))).select(*R.RFM_COLUMNS[:14])


def q_rfm_segments(spark, sf):
    """The rfm table without the cluster column."""
    sales = _sales(spark, sf)
    return publish(R.rfm_table(sales, sales_summary(sales), clusters=False))  # read once: no copy


def q_rfm_one(spark, sf):
    """R2 + R1-R16 on the trailing 365 days."""
    sales, last = _dated_sales(spark, sf)
    summary = sales_summary(sales, last)  # read once: no copy
    return publish(R.rfm_table(sales, summary, TRAILING_DAYS, clusters=False, last_day=last))


def q_rfm_clusters(spark, sf):
    """K-means cluster per customer."""
    sales = _sales(spark, sf)
    return R.rfm_clusters(R.rfm_scaled(R.rfm_base(sales))).select(
        TENANT, "email", "cluster", "cluster_converged")


def q_tenant_rfm_clusters(spark, sf):
    """R8 for every tenant in the same rounds."""
    sales = _sales(spark, sf, multi=True)
    return R.rfm_clusters(R.rfm_scaled(R.rfm_base(sales))).select(
        TENANT, "email", "cluster", "cluster_converged")


def rfm_quadrants(sales: DataFrame) -> DataFrame:
    """Minimum slice: customers and spend per quadrant."""
    scores = R.rfm_scores(R.rfm_base(sales))
    return (scores.withColumn("quad_segment", quadrant_of(segment_of("rfm_int")))
            .groupBy(TENANT, "quad_segment")
            .agg(F.count(F.lit(1)).alias("customers"), money_sum("monetary").alias("monetary")))


def q_rfm_quadrants(spark, sf):
    return rfm_quadrants(_sales(spark, sf))


def q_cardinality_check(spark, sf):
    """Emails occurring more than once in rfm (expected: none)."""
    sales = _sales(spark, sf)
    rfm = R.rfm_table(sales, sales_summary(sales), clusters=False)
    return R.cardinality_violations(rfm, [TENANT, "email"])


def q_cardinality_broken(spark, sf):
    """A segment table in which some customers occur again."""
    sales = _sales(spark, sf)
    rfm = R.rfm_segments(R.rfm_scores(R.rfm_base(sales)), _summary(spark, sf, sales)).select(TENANT, "email", "cust_segment")
    again = rfm.where(F.col("email").rlike("^c[0-9]*3@"))
    return R.cardinality_violations(rfm.unionByName(again).unionByName(again.where(F.col("email").rlike("^c[0-9]*33@"))),
                                    [TENANT, "email"])


def q_summ_rfm(spark, sf):
    """J1."""
    held = []

    def segments() -> DataFrame:  # they read the summary, but not the lines
        sales = _sales(spark, sf)
        held.append(_summary(spark, sf, sales))
        return R.rfm_table(sales, held[0], clusters=False)

    return publish(only_read(lambda: bounded(R.summary_with_segments(only_read(segments), held[0]), "email")))


# -- cohorts ------------------------------------------------------------------------
def q_cohort_half_data(spark, sf):
    """H1-H9 (7-month window)."""
    return H.cohort_data(_sales(spark, sf), H.HALF_MONTHS)


def q_cohort_half(spark, sf):
    return H.cohort_counts(H.cohort_data(_sales(spark, sf), H.HALF_MONTHS), H.HALF_MONTHS)


def q_cohort_year(spark, sf):
    return H.cohort_counts(H.cohort_data(_sales(spark, sf), H.YEAR_MONTHS), H.YEAR_MONTHS)


def q_retention_half(spark, sf):
    m = H.HALF_MONTHS
    return H.retention(H.cohort_counts(H.cohort_data(_sales(spark, sf), m), m), m)


def q_retention_year(spark, sf):
    m = H.YEAR_MONTHS
    return H.retention(H.cohort_counts(H.cohort_data(_sales(spark, sf), m), m), m)


def q_cohort_avg_sales(spark, sf):
    """H12."""
    return H.cohort_avg_sales(H.cohort_data(_sales(spark, sf), H.HALF_MONTHS))


def q_cohort_year_scan(spark, sf):
    """H1 with the run-day bounds of the scheduled job."""
    import datetime as dt
    end = dt.date.fromisoformat(COHORT_RUN_DAY)
    start = (end - dt.timedelta(days=COHORT_SCAN_DAYS)).isoformat()
    m = H.YEAR_MONTHS
    return H.cohort_counts(H.cohort_data(_sales(spark, sf), m, start, COHORT_RUN_DAY), m)


# -- series and forecasts ------------------------------------------------------------
def q_daily_sales(spark, sf):
    return publish(FS.daily_sales(_sales(spark, sf)))


def q_daily_orders(spark, sf):
    return publish(FS.daily_orders(_summary(spark, sf)))


def q_daily_churn(spark, sf):
    return publish(FS.daily_churn(_summary(spark, sf)))


def q_densify_orders(spark, sf):
    return publish(FS.densify(FS.daily_orders(_summary(spark, sf))))


def q_densify_churn(spark, sf):
    return publish(FS.densify(FS.daily_churn(_summary(spark, sf))))


def q_future_frame(spark, sf):
    return publish(FS.future_frame(FS.densify(FS.daily_orders(_summary(spark, sf)))))


def _order_features(spark, sf):
    return FC.forecast_features(FS.future_frame(FS.densify(FS.daily_orders(_summary(spark, sf)))))


def q_forecast_features(spark, sf):
    return publish(_order_features(spark, sf))


def _published_forecast(features: DataFrame) -> DataFrame:
    out = FC.forecast(features)
    return publish(out.select(TENANT, "ds", *(half_even(c, FORECAST_DIGITS).alias(c) for c in FC.OUTPUT[2:])))


def q_forecast_gram(spark, sf):
    """sums of the normal equations of the order forecast, entry by entry."""
    gram = FC.normal_equations(_order_features(spark, sf))
    rows = gram.select(TENANT, F.posexplode("gram").alias("i", "row"))
    return rows.select(TENANT, F.col("i").cast("bigint").alias("i"), F.posexplode("row").alias("j", "total")).withColumn(
        "j", F.col("j").cast("bigint"))


def q_sales_forecast(spark, sf):
    """F7."""
    return _published_forecast(FC.forecast_features(FS.future_frame(FS.daily_sales(_sales(spark, sf)))))


def q_churn_forecast(spark, sf):
    """F8."""
    daily = FS.densify(FS.daily_churn(_summary(spark, sf)))
    return _published_forecast(FC.forecast_features(FS.future_frame(daily)))


def q_order_forecast(spark, sf):
    """F9."""
    return _published_forecast(_order_features(spark, sf))


# -- vendors ----------------------------------------------------------------------------
def q_vendor_item_spend(spark, sf):
    """V1-V3."""
    return V.item_spend(_po(spark, sf))


def q_vendor_flags(spark, sf):
    """V4 + V5 on every PO line."""
    po = _po(spark, sf)
    return publish(po.select(TENANT, "index", "contract_number", "po_no",
                             V.contract_flag().alias("contract"), V.po_flag().alias("po")),
                   ("po_no",))


def q_vendor_classes(spark, sf):
    """V6-V8 at item grain."""
    return _vsa(spark, sf).select(TENANT, V.ITEM, "no_of_vendors", "vendor_class", "no_of_pos",
                                  "po_class").distinct()


def q_sparse_vendor_classes(spark, sf):
    """V4 + V6-V8 where items have few lines: every class occurs, and the contract ``0``."""
    po = S.purchase_order(spark, sf)
    day = F.dayofyear("date_created")
    po = po.withColumns({
        "item_description": F.concat("item_description", F.lit(" #"), (day * F.when(day % 3 == 0, 1).otherwise(0)).cast("string")),
        "contract_number": F.when(day % 5 == 0, F.lit(" 0 ")).otherwise(F.col("contract_number"))})
    return V.vendor_spend_analysis(po).groupBy(TENANT, "vendor_class", "po_class", "contract", "po", "spend_class").agg(
        F.count(F.lit(1)).alias("lines"), F.countDistinct("item_description").alias("items"))


def q_vendor_spend_analysis(spark, sf):
    """V1-V8."""
    return publish(_vsa(spark, sf), ("po_no",))


def q_vendor_price_book(spark, sf):
    """V9 + V10."""
    return V.price_book(_vsa(spark, sf))


def q_vendor_deal_rows(spark, sf):
    """V11-V14 + O3/O4."""
    return V.deal_rows(V.price_book(_vsa(spark, sf)))


def q_vendor_item_rollup(spark, sf):
    """V15."""
    return V.item_rollup(V.deal_rows(V.price_book(_vsa(spark, sf))))


def q_vendor_vendor_rollup(spark, sf):
    """V16 + V17."""
    return V.vendor_rollup(V.deal_rows(V.price_book(_vsa(spark, sf))))


def q_vendor_deals(spark, sf):
    """V9-V17."""
    return only_read(lambda: V.vendor_deals(_vsa(spark, sf)))


QUERIES: dict[str, Query] = {
    name[2:]: fn for name, fn in sorted(globals().items())
    if name.startswith("q_") and callable(fn)
}
