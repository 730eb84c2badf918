"""Vendor spend (V1-V8) and vendor deals.

All per-item and per-vendor figures are single grouped aggregations joined
back to the rows. Items whose measured size is small are broadcast, so the lines
stay where they are; otherwise AQE splits hot items on the row side. The only global orders - cumulative spend share
and the row number ``s_no`` - use the range-partitioned helpers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.labels import (CONTRACT, FIRST_YEAR, PO, PO_CLASS, RANGE_SELECTION,
                                SPEND_CLASS, VENDOR_CLASS)
from ..functions.rounding import from_micros, half_even, micros_sum, money_avg, money_sum
from ..session import TENANT, bounded, materialize, only_read, per_tenant
from .ordering import global_row_number, global_running_sum

ITEM = "item_description"
MAJOR_SHARE = 20          # cumulative share above which an item is "Major Spend"
ITEM_BYTES = 16 << 20     # items up to this size are broadcast to the lines; more join by shuffle
ITEM_ROW = 100            # bytes of an item's figures beside its texts
EXCLUDE_INDEX = 5000      # price index above which a row is excluded
VSA_EXTRA = ["contract", "po", "spend_class", "no_of_vendors", "vendor_class", "no_of_pos",
             "po_class"]


def contract_flag(c: str = "contract_number") -> F.Column:
    """V4: no contract number (null, blank or ``0``) -> not available."""
    missing = F.col(c).isNull() | (F.trim(F.col(c)) == "") | (F.trim(F.col(c)) == "0")
    return F.when(missing, CONTRACT[1]).otherwise(CONTRACT[0])


def po_flag(c: str = "po_no") -> F.Column:
    """V5."""
    return F.when(F.col(c).isNull(), PO[1]).otherwise(PO[0])


def vendor_class(n: str = "no_of_vendors") -> F.Column:
    """V7: 0 -> null."""
    c = F.col(n)
    return (F.when(c == 1, VENDOR_CLASS[0]).when((c > 1) & (c <= 5), VENDOR_CLASS[1])
            .when(c > 5, VENDOR_CLASS[2]))


def po_class(n: str = "no_of_pos") -> F.Column:
    """V8."""
    c = F.col(n)
    return (F.when(c == 1, PO_CLASS[0]).when((c > 1) & (c <= 12), PO_CLASS[1])
            .when(c > 12, PO_CLASS[2]))


def item_figures(po: DataFrame) -> DataFrame:
    """V1, V6, V8: spend and counts per item, in one aggregation, written once."""
    return materialize(po.filter(F.col(ITEM).isNotNull()).groupBy(TENANT, ITEM).agg(
        F.coalesce(micros_sum("price"), F.lit(0).cast("decimal(38,0)")).alias("_ll_spend"),
        F.count("vendor_name").alias("no_of_vendors"),                   # V6
        F.count("po_no").alias("no_of_pos")), key=ITEM)                  # V8


def _bytes(figures: DataFrame, name: str = ITEM) -> int:
    """About what the written figures of the items (or of what ``name`` names) take in memory."""
    texts = sum(F.coalesce(F.octet_length(c), F.lit(0)) for c in (TENANT, name))
    return figures.agg(F.sum(texts + ITEM_ROW)).first()[0] or 0


def item_spend(po: DataFrame, figures: DataFrame | None = None) -> DataFrame:
    """V1 + V2 + V3 (class only): per item spend, cumulative share, class.

    ``figures`` of the items (``item_figures``) where they are known already.
    """
    items = (item_figures(po) if figures is None else figures).select(TENANT, ITEM, "_ll_spend")
    total = items.groupBy(TENANT).agg(F.sum("_ll_spend").alias("_ll_total"))
    ranked = global_running_sum(items, "_ll_spend", ["_ll_spend", ITEM], [TENANT], "_ll_cum")
    ranked = ranked.join(per_tenant(total), TENANT)
    share = F.when(F.col("_ll_total") != 0, half_even(
        F.lit(100.0) * (from_micros(F.col("_ll_cum")) / from_micros(F.col("_ll_total"))), 2))
    return ranked.select(TENANT, ITEM, from_micros(F.col("_ll_spend")).alias("spend"),
                         share.alias("cum_share"),
                         F.when(share > MAJOR_SHARE, SPEND_CLASS[0]).otherwise(SPEND_CLASS[1])
                         .alias("spend_class"))


def vendor_spend_analysis(po: DataFrame) -> DataFrame:
    """V1-V8: every PO line of an item that has at least one PO, with flags
    and classes; lines without item are dropped (inner joins of the reference)."""
    figures = item_figures(po)
    counts = figures.filter(F.col("no_of_pos") > 0).drop("_ll_spend")     # V8 inner join
    items = item_spend(po, figures).select(TENANT, ITEM, "spend_class").join(counts, [TENANT, ITEM])
    df = po.join(F.broadcast(items) if _bytes(figures) <= ITEM_BYTES else items, [TENANT, ITEM], "inner")
    # texts are made after the join, not shuffled for it
    df = df.withColumns({"contract": contract_flag(), "po": po_flag(),   # V4, V5
                         "vendor_class": vendor_class(), "po_class": po_class()})
    return df.select(*po.columns, *VSA_EXTRA)


def price_book(vsa: DataFrame) -> DataFrame:
    """V9 + V10: off-contract price per (item, vendor, year) and item band."""
    nc = vsa.filter((F.col("contract") == CONTRACT[1]) & F.col(ITEM).isNotNull()
                    & F.col("vendor_name").isNotNull() & F.col("year").isNotNull())
    book = nc.groupBy(TENANT, ITEM, "vendor_name", "year").agg(
        half_even(money_avg("unit_price"), 1).alias("unit_price"),
        half_even(money_sum("price"), 1).alias("price"))
    book = materialize(book, key=ITEM)  # read again for the bands
    book = book.withColumns({"disc_factor": F.lit(1).cast("bigint")})
    book = book.withColumn("adjusted_price", F.col("unit_price") * F.col("disc_factor"))
    band = book.groupBy(TENANT, ITEM).agg(
        F.min("unit_price").alias("min_price"), F.max("unit_price").alias("max_price"),
        F.count("unit_price").alias("item_count"), F.min("year").alias("min_year"))
    return bounded(book.join(band, [TENANT, ITEM]), ITEM)


def deal_rows(book: DataFrame) -> DataFrame:
    """V11-V14 + O3/O4: variance, index, labels, extra cost, ``s_no``."""
    pos = F.col("min_price") > 0
    df = book.withColumns({
        "ppv": F.when(pos, half_even(F.col("max_price") / F.col("min_price") * 100, 0))
        .otherwise(0).cast("bigint"),
        "vendor_price_index": F.when(pos, half_even(
            F.col("adjusted_price") / F.col("min_price") * 100, 0)).otherwise(0).cast("bigint"),
    })
    df = df.withColumns({
        "purchase_period": F.when(F.col("year") == F.col("min_year"), FIRST_YEAR)
        .otherwise(F.col("year").cast("string")),
        "best_quote_score": (F.col("vendor_price_index") == 100).cast("bigint"),
        "range_selection": F.when(F.col("vendor_price_index") > EXCLUDE_INDEX, RANGE_SELECTION[0])
        .otherwise(RANGE_SELECTION[1]),
        "extra_cost": F.when(pos, half_even(F.col("price") / F.col("unit_price")
                                            * (F.col("adjusted_price") - F.col("min_price")), 1))
        .otherwise(F.lit(0.0)),
    })
    order = [F.col("item_count").desc(), F.col("vendor_name").desc(), F.col("year").desc(),
             F.col(ITEM).asc()]
    df = global_row_number(df, order, [TENANT], "s_no")
    return df.withColumn("s_no", F.col("s_no") - 1).drop("item_count")


def item_rollup(rows: DataFrame) -> DataFrame:
    """Per item over ``Include`` rows."""
    inc = rows.filter(F.col("range_selection") == RANGE_SELECTION[1])
    return inc.groupBy(TENANT, ITEM).agg(
        money_avg("min_price").alias("avg_min_price_itm"),
        money_avg("unit_price").alias("avg_unit_price_itm"),
        F.avg("vendor_price_index").alias("avg_vendor_price_index_itm"),
        F.avg("ppv").alias("avg_ppv_itm"),
        F.count("range_selection").alias("cnt_range_itm"),
        money_sum("extra_cost").alias("tot_extra_cost_itm"),
        money_sum("price").alias("tot_price_itm"))


def vendor_rollup(rows: DataFrame) -> DataFrame:
    """V16 + V17: per vendor over ``Include`` rows, rounded as published."""
    inc = rows.filter(F.col("range_selection") == RANGE_SELECTION[1])
    agg = inc.groupBy(TENANT, "vendor_name").agg(
        half_even(money_avg("min_price"), 1).alias("avg_min_price_vnd"),
        half_even(money_avg("unit_price"), 1).alias("avg_unit_price_vnd"),
        half_even(F.avg("vendor_price_index"), 0).alias("avg_vendor_price_index_vnd"),
        half_even(F.avg("ppv"), 0).alias("avg_ppv_vnd"),
        F.sum("best_quote_score").cast("double").alias("sum_score"),
        F.count("range_selection").alias("cnt_range_vnd"),
        half_even(money_sum("extra_cost"), 1).alias("tot_extra_cost_vnd"),
        half_even(money_sum("price"), 1).alias("tot_price_vnd"))
    return agg.withColumn("good_score", half_even(
        F.col("sum_score") / F.col("cnt_range_vnd") * 100, 0).cast("bigint"))


def vendor_deals(vsa: DataFrame, sort: bool = True) -> DataFrame:
    """The published ``vendor_deals`` table."""
    rows = only_read(lambda: deal_rows(price_book(vsa)))
    vendors = materialize(vendor_rollup(rows))
    out = rows.join(item_rollup(rows), [TENANT, ITEM], "inner").join(
        F.broadcast(vendors) if _bytes(vendors, "vendor_name") <= ITEM_BYTES else vendors, [TENANT, "vendor_name"], "inner")
    cols = [TENANT, ITEM, "vendor_name", "year", "unit_price", "price", "disc_factor",
            "adjusted_price", "min_price", "max_price", "min_year", "ppv", "vendor_price_index",
            "purchase_period", "best_quote_score", "range_selection", "extra_cost", "s_no",
            "avg_min_price_itm", "avg_unit_price_itm", "avg_vendor_price_index_itm",
            "avg_ppv_itm", "cnt_range_itm", "tot_extra_cost_itm", "tot_price_itm",
            "avg_min_price_vnd", "avg_unit_price_vnd", "avg_vendor_price_index_vnd",
            "avg_ppv_vnd", "sum_score", "cnt_range_vnd", "tot_extra_cost_vnd", "tot_price_vnd",
            "good_score"]
    out = out.select(*cols)
    if sort:  # O3: bounded by item x vendor x year, not by order volume
        out = only_read(lambda: bounded(out, ITEM)).orderBy(F.col(TENANT), F.col("cnt_range_itm").desc(),
                          F.col("vendor_price_index").desc(), F.col(ITEM).desc(),
                          F.col("vendor_name").desc())
    return out
