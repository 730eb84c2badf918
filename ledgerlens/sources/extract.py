"""ERP extracts (S1, S2): line table joined to its header and lookup.

A table that carries ``company_id`` is joined per tenant; a table without it
is shared by all tenants (e.g. one item master).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import TENANT

ORDER_EXTRACT_COLUMNS = [
    "order_no", "date_created", "customer_id", "ship2_name", "ship2_email_address",
    "ship2_add1", "ship2_add2", "ship2_add3", "ship2_city", "ship2_country",
    "unit_price", "unit_quantity", "unit_of_measure", "payment_method", "supplier_id",
    "sales_tax", "sales_cost", "item_desc",
    "class_id1", "class_id2", "class_id3", "class_id4", "class_id5",
    *[f"price{i}" for i in range(1, 11)],
]

PURCHASE_EXTRACT_COLUMNS = [
    "po_no", "qty_ordered", "qty_received", "unit_price", "date_created",
    "date_last_modified", "item_description", "unit_of_measure", "contract_number",
    "vendor_id", "ship2_name", "ship2_add1", "ship2_add2", "ship2_city", "ship2_state",
    "ship2_country", "ship2_zip", "location_id", "vendor_name",
]


def _keys(left: DataFrame, right: DataFrame, key: str) -> list[str]:
    both = TENANT in left.columns and TENANT in right.columns
    return [TENANT, key] if both else [key]


def _extract(line: DataFrame, header: DataFrame, lookup: DataFrame, key: str, lookup_key: str) -> DataFrame:
    """``line ⋈ header`` on ``key``, ``⟕ lookup`` on ``lookup_key``.

    The lookup comes first where the line holds its key, so a large lookup makes
    narrow lines be shuffled, not lines with all columns of their header.
    """
    first = lookup_key in line.columns and (TENANT in line.columns or TENANT not in lookup.columns)
    if first:
        line = line.join(lookup, _keys(line, lookup, lookup_key), "left")
    full = line.join(header, _keys(line, header, key), "inner")
    return full if first else full.join(lookup, _keys(full, lookup, lookup_key), "left")


def order_extract(oe_line: DataFrame, oe_hdr: DataFrame, inv_mast: DataFrame) -> DataFrame:
    """``oe_line ⋈ oe_hdr`` on order_no, ``⟕ inv_mast`` on inv_mast_uid."""
    return _extract(oe_line, oe_hdr, inv_mast, "order_no", "inv_mast_uid").select(TENANT, *ORDER_EXTRACT_COLUMNS)


def purchase_extract(po_line: DataFrame, po_hdr: DataFrame, vendor: DataFrame) -> DataFrame:
    """``po_line ⋈ po_hdr`` on po_no, ``⟕ vendor`` on vendor_id.

    ``vendor_id`` is read from whichever side holds it (the header in the
    ERP layout; the line when a PO mixes vendors).
    """
    return _extract(po_line, po_hdr, vendor, "po_no", "vendor_id").select(TENANT, *PURCHASE_EXTRACT_COLUMNS)


def with_line_amount(df: DataFrame, qty: str = "unit_quantity") -> DataFrame:
    """I1 (sales, ``qty=unit_quantity``) / I2 (PO, ``qty=qty_ordered``)."""
    return df.withColumn("price", F.col("unit_price") * F.col(qty))
