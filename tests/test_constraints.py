"""Checks inside the write, pruned appends, and stand-ins in which every label occurs."""

import pytest

from ledgerlens.functions.labels import PO_CLASS, VENDOR_CLASS, WIN_BACK
from ledgerlens.operators import rfm as R
from ledgerlens.plans.catalog import QUERIES
from ledgerlens.sources import sinks as K
from ledgerlens.sources import tables as T

SF = "/root/testdata/sf0.001"


def test_broken_cardinality_stops_the_join(spark):
    seg = spark.createDataFrame([("t0", "a", "x", "p"), ("t0", "b", "y", "q")], "company_id string, email string, cust_segment string, quad_segment string")
    summary = spark.createDataFrame([("t0", "a", 1), ("t0", "a", 2), ("t0", "c", 3)], "company_id string, email string, v int")
    got = sorted(tuple(r) for r in R.summary_with_segments(seg, summary).collect() if r.v is not None)
    assert got == [("t0", "a", "x", "p", 1), ("t0", "a", "x", "p", 2), ("t0", "c", None, None, 3)]
    broken = R.summary_with_segments(seg.unionByName(seg.where("email = 'a'")), summary)
    with pytest.raises(Exception, match="merge keys are not unique: t0, a"):
        broken.collect()
    with pytest.raises(Exception, match="not unique"):
        broken.write.format("noop").mode("overwrite").save()


def test_append_reads_only_what_can_hold_its_keys(spark, tmp_path):
    path = str(tmp_path / "t")
    old = spark.createDataFrame([("a", k, "old") for k in range(50)] + [("b", k, "old") for k in range(9)], "company_id string, k long, v string")
    K.write_overwrite(old, path)
    batch = spark.createDataFrame([("a", k, "new") for k in (49, 50, 51, 51, None)], "company_id string, k long, v string")
    new = K.rows_to_append(batch, T.read_partitioned(spark, path), "k")
    plan = new._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(k,49)" in plan and "LessThanOrEqual(k,51)" in plan and "PartitionFilters: [isnotnull(company_id" in plan
    for _ in range(2):
        K.append_with_key(batch, path, "k")
    back = T.read_partitioned(spark, path).where("company_id = 'a' AND k >= 49").select("k", "v").collect()
    assert sorted(map(tuple, back)) == [(49, "old"), (50, "new"), (51, "new")]
    K.append_with_key(batch.limit(0), path, "k")
    assert T.read_partitioned(spark, path).count() == 61


def test_every_label_occurs(spark):
    rows = QUERIES["sparse_labels"](spark, SF).collect()
    assert {r.freq_pur for r in rows} == {"1 Order", "2 Orders", "3 Orders", "4+ Orders"}
    assert {r.win_back for r in rows if r.freq_pur == "2 Orders"} == set(WIN_BACK)   # the branch of two rows
    assert {r.churn_label for r in rows} == {"churn", "active"} and {r.repeat_customer for r in rows} == {0, 1}
    rows = QUERIES["sparse_vendor_classes"](spark, SF).collect()
    assert {r.vendor_class for r in rows} == set(VENDOR_CLASS) and {r.po_class for r in rows} == set(PO_CLASS)
