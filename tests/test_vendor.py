from pyspark.sql import functions as F

from ledgerlens.operators import vendor as V
from ledgerlens.session import settings

from .helpers import purchase_order, ts


def test_item_without_po_dropped_and_flags(spark):
    po = purchase_order(spark, [
        {"item_description": "nopo", "po_no": None},
        {"item_description": "nopo", "po_no": None, "contract_number": "C-1"},
        {"item_description": "ok", "po_no": 5, "contract_number": " "},
        {"item_description": "ok", "po_no": 6, "contract_number": "0"},
        {"item_description": "ok", "po_no": None, "contract_number": "C-9"},
        {"item_description": None, "po_no": 8}])
    vsa = V.vendor_spend_analysis(po).collect()
    assert {r.item_description for r in vsa} == {"ok"} and len(vsa) == 3
    assert sorted(r.contract for r in vsa) == ["Contract Available", "Contract Not Available",
                                               "Contract Not Available"]
    assert sorted(r.po for r in vsa) == ["PO Available", "PO Available", "PO Not Available"]
    assert {(r.no_of_vendors, r.vendor_class, r.no_of_pos, r.po_class) for r in vsa} == \
        {(3, "Between 1 and 5", 2, "Between 1 and 12")}


def test_cumulative_share_and_tied_spend(spark):
    po = purchase_order(spark, [{"item_description": i, "unit_price": p, "po_no": 1}
                                for i, p in [("b", 10.0), ("a", 10.0), ("c", 80.0)]])
    s = {r.item_description: r for r in V.item_spend(po).collect()}
    # ascending spend, ties by item: a (10%), b (20%), c (100%)
    assert (s["a"].cum_share, s["b"].cum_share, s["c"].cum_share) == (10.0, 20.0, 100.0)
    assert (s["a"].spend_class, s["b"].spend_class, s["c"].spend_class) == \
        ("Tail Spend", "Tail Spend", "Major Spend")


def test_lines_are_not_shuffled_for_few_items(spark, monkeypatch):
    rows = [{"item_description": i, "po_no": n} for i, n in [("a", 1), ("a", 1), ("b", None), ("b", 2), (None, 3), ("c", None)]]
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}):
        po = purchase_order(spark, rows)
        few = V.vendor_spend_analysis(po)
        few_plan, few_rows = few._jdf.queryExecution().executedPlan().toString(), few.collect()
        monkeypatch.setattr(V, "ITEM_BYTES", 0)
        many = V.vendor_spend_analysis(po)
        many_plan, many_rows = many._jdf.queryExecution().executedPlan().toString(), many.collect()
    lines = [p.split("\n")[1:4] for p in (few_plan, many_plan)]
    assert any("BroadcastHashJoin" in x for x in lines[0]) and not any("BroadcastHashJoin" in x for x in lines[1])
    assert sorted(map(str, few_rows)) == sorted(map(str, many_rows)) and len(few_rows) == 4


def _deals_po(spark, rows):
    return V.vendor_spend_analysis(purchase_order(spark, rows))


def test_min_price_zero_and_excluded_vendor(spark):
    rows = [
        # item z: min price rounds to 0.0 -> ppv 0, index 0, extra 0, Include
        {"item_description": "z", "vendor_name": "v1", "unit_price": 0.04},
        {"item_description": "z", "vendor_name": "v2", "unit_price": 3.0},
        # item p: v3 always > 50x the cheapest -> excluded everywhere
        {"item_description": "p", "vendor_name": "v1", "unit_price": 1.0},
        {"item_description": "p", "vendor_name": "v3", "unit_price": 60.0},
        {"item_description": "p", "vendor_name": "v2", "unit_price": 1.5, "qty_ordered": 2.0},
    ]
    vsa = _deals_po(spark, rows)
    rows_ = {(r.item_description, r.vendor_name): r for r in V.deal_rows(V.price_book(vsa)).collect()}
    z = rows_[("z", "v2")]
    assert (z.min_price, z.ppv, z.vendor_price_index, z.extra_cost, z.range_selection) == \
        (0.0, 0, 0, 0.0, "Include")
    p3 = rows_[("p", "v3")]
    assert p3.vendor_price_index == 6000 and p3.range_selection == "> 50 times - Exclude"
    p2 = rows_[("p", "v2")]
    assert (p2.vendor_price_index, p2.ppv, p2.extra_cost) == (150, 6000, 1.0)
    assert sorted(r.s_no for r in rows_.values()) == list(range(5))
    deals = V.vendor_deals(vsa).collect()
    assert "v3" not in {r.vendor_name for r in deals}
    v1 = [r for r in deals if r.vendor_name == "v1"]
    assert {r.purchase_period for r in v1} == {"1st Year of Purchase for the item"}
    assert {(r.sum_score, r.cnt_range_vnd, r.good_score) for r in v1} == {(1.0, 2, 50)}
