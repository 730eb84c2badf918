"""Tables written in passes: the same rows, with less held on disk at a time."""

import os

import pytest
from pyspark.sql import functions as F

from ledgerlens import session
from ledgerlens.operators.ordering import written_row_number
from ledgerlens.operators.summary import sales_summary
from ledgerlens.operators.vendor import vendor_deals
from ledgerlens.session import bounded, ensure_checkpoint_dir, in_passes, materialize, only_read, passes_of
from ledgerlens.sources.sinks import append_with_key, write_overwrite, write_tenants

from . import helpers as H


@pytest.fixture
def passes(monkeypatch):
    monkeypatch.setattr(session, "PASS_BYTES", 1)


def written(df):
    return df.sparkSession.read.parquet(os.path.dirname(materialize(df).inputFiles()[0]))


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def local_path(place):
    return place.toString().removeprefix("file:")


KEYED = [("a", 1), ("a", 1), ("a", None), ("b", None), ("b", 7), ("b", 8), ("a", 9), ("c", 2), ("c", 3)]


def keyed(spark):
    return written(spark.createDataFrame(KEYED, "company_id string, k long").withColumn("v", F.col("k").cast("string")))


def test_shuffle_files_go_when_the_table_is_written(spark, monkeypatch):
    seen = []
    real = session.settings
    monkeypatch.setattr(session, "settings", lambda s, values: seen.append(dict(values)) or real(s, values))
    materialize(spark.range(9).repartition(3))
    assert seen == [session.FREED] and list(session.FREED.values()) == ["true"]


def test_passes_hold_every_row_once(spark, passes):
    df = keyed(spark)
    assert passes_of(df) == session.MOST_PASSES
    parts = list(in_passes(df, "k"))
    assert len(parts) == session.MOST_PASSES
    assert rows(materialize(df, key="k")) == rows(df) == rows(bounded(df, "k"))
    assert sum(p.count() for p in parts) == len(KEYED)


def test_rows_from_python_have_no_size(spark):
    assert passes_of(spark.createDataFrame(KEYED, "company_id string, k long")) == 1


@pytest.mark.parametrize("order", [["k", "v"], ["v", "k"]])
def test_numbers_do_not_depend_on_passes(spark, monkeypatch, order):
    df = keyed(spark)
    once = rows(written_row_number(df, order, ["company_id"]))
    monkeypatch.setattr(session, "PASS_BYTES", 1)
    assert rows(written_row_number(df, order, ["company_id"])) == once
    assert [r[3] for r in once if r[0] == "b"] == [2, 3, 1] and len(once) == len(KEYED)


def test_numbers_where_every_key_is_null(spark, passes):
    df = written(spark.createDataFrame([("a", None, "x"), ("a", None, "y")], "company_id string, k long, v string"))
    assert [r[3] for r in rows(written_row_number(df, ["k", "v"], ["company_id"]))] == [1, 2]


def test_append_in_passes_adds_each_key_once(spark, passes, tmp_path):
    path = f"{tmp_path}/t"
    df = keyed(spark)
    write_overwrite(df.where("k = 7"), path)
    for _ in range(2):
        append_with_key(df.unionByName(df), path, "k", ["v"])
    got = rows(spark.read.parquet(path).select("company_id", "k"))
    assert got == sorted({x for x in KEYED if x[1] is not None}, key=repr)


def test_overwrite_in_passes_replaces_the_table(spark, passes, tmp_path):
    path, df = f"{tmp_path}/t", keyed(spark)
    write_overwrite(df, path, key="k")
    write_overwrite(df.where("company_id != 'c'"), path, key="k")
    assert rows(spark.read.parquet(path).select("company_id", "k")) == sorted((x for x in KEYED if x[0] != "c"), key=repr)
    write_tenants(df.where("k = 8"), path, ["b"], key="k")
    assert spark.read.parquet(path).where("company_id = 'b'").count() == 1
    assert os.listdir(tmp_path) == ["t"]


def test_tables_not_read_go_with_their_scope(spark):
    kept = []

    def make():
        first = materialize(spark.range(5))
        kept.extend(session.passing[-1])
        return materialize(first.where("id > 1"))

    out = only_read(make)
    assert out.count() == 3
    assert not os.path.exists(local_path(kept[0])) and os.path.isdir(os.path.join(
        ensure_checkpoint_dir(spark).removeprefix("file:"), "tables"))


def test_summary_in_passes(spark, monkeypatch):
    from ledgerlens.operators.sales import clean_sales
    raw = H.raw_orders(spark, [{"ship2_email_address": f"c{k % 3}", "date_created": H.ts(f"2020-01-{1 + k:02d}")} for k in range(9)])
    sales = written(clean_sales(raw))
    once = rows(sales_summary(sales))
    monkeypatch.setattr(session, "PASS_BYTES", 1)
    assert rows(materialize(sales_summary(sales), key="email")) == once and len(once) == 9


def test_vendor_deals_in_passes_are_the_same_and_sorted(spark, monkeypatch):
    from ledgerlens.operators.vendor import vendor_spend_analysis
    po = written(H.purchase_order(spark, [
        {"item_description": f"i{k % 4}", "vendor_name": f"v{k % 3}", "unit_price": 5.0 + k, "po_no": k} for k in range(24)]))
    once = [tuple(r) for r in vendor_deals(vendor_spend_analysis(po)).collect()]
    monkeypatch.setattr(session, "PASS_BYTES", 1)
    assert [tuple(r) for r in vendor_deals(vendor_spend_analysis(po)).collect()] == once and once
