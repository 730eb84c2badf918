"""ERP-shaped stand-in tables built from the provided test tables.

These only rename and shape columns (FIXTURES.md section 2); every step of a
job runs in the operators on top of them. Tenant tags live on the headers:
``'t0'`` for the single-tenant tables, the customer's market segment for the
multi-tenant ones.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ingest import prepare_orders, prepare_purchases, surrogate_index
from ..session import TENANT
from .extract import ORDER_EXTRACT_COLUMNS, PURCHASE_EXTRACT_COLUMNS, order_extract, purchase_extract
from .sinks import write_rows
from .tables import read_table

SINGLE_TENANT = "t0"


def _tenant(multi: bool) -> F.Column:
    return (F.col("c_mktsegment") if multi else F.lit(SINGLE_TENANT)).alias(TENANT)


def _null(t: str) -> F.Column:
    return F.lit(None).cast(t)


def _headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read_table(spark, sf_dir, "orders")
    customer = read_table(spark, sf_dir, "customer")
    nation = read_table(spark, sf_dir, "nation")
    return (orders.join(customer, orders.o_custkey == customer.c_custkey, "left")
            .join(nation, F.col("c_nationkey") == nation.n_nationkey, "left"))


def _item_desc() -> F.Column:
    return F.concat_ws(" ", "p_name", "p_brand")


def erp_order_tables(spark: SparkSession, sf_dir: str, multi_tenant: bool = False):
    """``(oe_line, oe_hdr, inv_mast)``."""
    li = read_table(spark, sf_dir, "lineitem")
    oe_line = li.select(
        F.col("l_orderkey").alias("order_no"), F.col("l_partkey").alias("inv_mast_uid"),
        F.col("l_suppkey").alias("supplier_id"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"),
        F.col("l_quantity").alias("unit_quantity"), F.col("l_linestatus").alias("unit_of_measure"),
        F.col("l_tax").alias("sales_tax"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("sales_cost"))
    oe_hdr = _headers(spark, sf_dir).select(
        _tenant(multi_tenant), F.col("o_orderkey").alias("order_no"),
        F.col("o_orderdate").alias("date_created"), F.col("o_custkey").alias("customer_id"),
        F.col("c_name").alias("ship2_name"),
        F.when(F.col("o_custkey") % 97 == 0, _null("string"))
        .otherwise(F.concat(F.lit("c"), F.col("o_custkey").cast("string"), F.lit("@example.com")))
        .alias("ship2_email_address"),
        _null("string").alias("ship2_add1"), _null("string").alias("ship2_add2"),
        _null("string").alias("ship2_add3"),
        F.col("n_name").alias("ship2_city"), F.col("n_name").alias("ship2_country"),
        F.col("o_orderpriority").alias("payment_method"))
    part = read_table(spark, sf_dir, "part")
    inv_mast = part.select(
        F.col("p_partkey").alias("inv_mast_uid"), _item_desc().alias("item_desc"),
        F.col("p_brand").alias("class_id1"), F.col("p_type").alias("class_id2"),
        F.col("p_size").cast("string").alias("class_id3"), _null("string").alias("class_id4"),
        _null("string").alias("class_id5"), F.col("p_retailprice").alias("price1"),
        *[_null("double").alias(f"price{i}") for i in range(2, 11)])
    return oe_line, oe_hdr, inv_mast


def erp_purchase_tables(spark: SparkSession, sf_dir: str, multi_tenant: bool = False):
    """``(po_line, po_hdr, vendor)``; the test lines carry their own supplier."""
    li = read_table(spark, sf_dir, "lineitem")
    part = read_table(spark, sf_dir, "part")
    po_line = li.join(part, li.l_partkey == part.p_partkey, "left").select(
        F.col("l_orderkey").alias("po_no"), F.col("l_quantity").alias("qty_ordered"),
        F.col("l_quantity").alias("qty_received"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"),
        F.col("l_shipdate").alias("date_created"), F.col("l_shipdate").alias("date_last_modified"),
        _item_desc().alias("item_description"), F.col("l_linestatus").alias("unit_of_measure"),
        F.when(F.col("l_returnflag") == "N", _null("string"))
        .when(F.col("l_linenumber") == 7, F.lit(""))
        .otherwise(F.concat(F.lit("C-"), F.col("l_suppkey").cast("string")))
        .alias("contract_number"),
        F.col("l_suppkey").alias("vendor_id"))
    po_hdr = _headers(spark, sf_dir).select(
        _tenant(multi_tenant), F.col("o_orderkey").alias("po_no"),
        F.col("c_name").alias("ship2_name"), _null("string").alias("ship2_add1"),
        _null("string").alias("ship2_add2"), F.col("n_name").alias("ship2_city"),
        _null("string").alias("ship2_state"), F.col("n_name").alias("ship2_country"),
        _null("string").alias("ship2_zip"), F.col("c_nationkey").cast("bigint").alias("location_id"))
    vendor = read_table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("vendor_id"), F.col("s_name").alias("vendor_name"))
    return po_line, po_hdr, vendor


def land(spark: SparkSession, sf_dir: str, root: str, part: Callable[[DataFrame, str], DataFrame]) -> None:
    """A day's delivery of the ERP tables: appended under ``root``, partitioned by
    tenant; ``part(rows, key)`` chooses the rows of tables that carry a key."""
    for tables, names, key in ((erp_order_tables(spark, sf_dir, True), ("oe_line", "oe_hdr", "inv_mast"), "order_no"),
                               (erp_purchase_tables(spark, sf_dir, True), ("po_line", "po_hdr", "vendor"), "po_no")):
        line, header, lookup = tables
        chosen = part(header, key)
        write_rows(chosen, f"{root}/{names[1]}", "append")
        write_rows(line.join(chosen.select(TENANT, key), key), f"{root}/{names[0]}", "append")
        lookup.write.mode("overwrite").parquet(f"{root}/{names[2]}.parquet")


# Order of the surrogate key: the business key, then every other column.
ORDER_INDEX_ORDER = [*ORDER_EXTRACT_COLUMNS, "price"]
PURCHASE_INDEX_ORDER = [*PURCHASE_EXTRACT_COLUMNS, "price", "year"]


def raw_orders(spark: SparkSession, sf_dir: str, multi_tenant: bool = False,
               with_index: bool = False, cutoff: str | None = None) -> DataFrame:
    """Warehouse ``raw_orders``: S1 + I1 + I3 (+ I4, + I7 ``index``)."""
    df = prepare_orders(order_extract(*erp_order_tables(spark, sf_dir, multi_tenant)), cutoff)
    return surrogate_index(df, ORDER_INDEX_ORDER) if with_index else df


def purchase_order(spark: SparkSession, sf_dir: str, multi_tenant: bool = False,
                   with_index: bool = True, cutoff: str | None = None) -> DataFrame:
    """Warehouse ``purchase_order``: S2 + I2 + I3 (+ I4, + I7 ``index``).

    Stand-in rule (FIXTURES): every 50th PO number is missing, so lines
    without a PO occur.
    """
    df = prepare_purchases(purchase_extract(*erp_purchase_tables(spark, sf_dir, multi_tenant)),
                           cutoff)
    df = df.withColumn("po_no", F.when(F.col("po_no") % 50 == 0, F.lit(None).cast("bigint"))
                       .otherwise(F.col("po_no")))
    return surrogate_index(df, PURCHASE_INDEX_ORDER) if with_index else df
