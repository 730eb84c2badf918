import re

from pyspark.sql import functions as F

from ledgerlens.operators import ingest as I
from ledgerlens.session import settings
from ledgerlens.sources import sinks as K
from ledgerlens.sources.extract import _extract
from ledgerlens.sources.standins import ORDER_INDEX_ORDER
from ledgerlens.sources.tables import read_partitioned

from .helpers import raw_orders, ts


def _lines(spark, orders):
    return raw_orders(spark, [{"order_no": o, "ship2_email_address": "a@x",
                               "date_created": ts("2020-01-01"), "item_desc": f"i{k}"}
                              for o, k in orders])


def test_incremental_then_nothing_new(spark):
    full = _lines(spark, [(1, 0), (1, 1), (2, 0), (3, 0)])
    target = I.surrogate_index(full, ORDER_INDEX_ORDER)
    assert sorted(r["index"] for r in target.collect()) == [0, 1, 2, 3]
    source = full.unionByName(_lines(spark, [(4, 0), (5, 0), (6, 0)]))       # +3 new orders
    delta = I.incremental_load(source, target, "order_no", ORDER_INDEX_ORDER)
    got = sorted((r.order_no, r["index"]) for r in delta.collect())
    assert got == [(4, 4), (5, 5), (6, 6)]                                    # index continues
    target2 = target.unionByName(delta)
    assert I.incremental_load(source, target2, "order_no", ORDER_INDEX_ORDER).count() == 0
    st = {r.step: r for r in I.ingest_status(source, target2, "order_no", "recent_order").collect()}
    assert (st["recent_order"].n_new, st["recent_order"].status) == (0, "no recent data")


def test_late_line_on_old_order_is_not_picked_up(spark):
    target = I.surrogate_index(_lines(spark, [(5, 0)]), ORDER_INDEX_ORDER)
    source = _lines(spark, [(5, 0), (5, 1), (3, 0)])
    assert I.incremental_delta(source, target, "order_no").count() == 0


def test_new_tenant_takes_everything(spark):
    target = I.surrogate_index(_lines(spark, [(5, 0)]), ORDER_INDEX_ORDER)
    other = _lines(spark, [(1, 0), (2, 0)]).withColumn("company_id", F.lit("t1"))
    delta = I.incremental_load(other, target, "order_no", ORDER_INDEX_ORDER)
    assert sorted((r.company_id, r["index"]) for r in delta.collect()) == [("t1", 0), ("t1", 1)]


def test_history_cutoff(spark):
    df = raw_orders(spark, [{"date_created": ts("2016-12-31")}, {"date_created": ts("2017-01-01")}])
    assert I.history_cutoff(df, "2017-01-01").count() == 1


def test_append_with_key_is_idempotent(spark):
    target = spark.createDataFrame([("t0", 1, "a"), ("t0", 2, "b")], "company_id string, k long, v string")
    batch = spark.createDataFrame([("t0", 2, "b"), ("t0", 3, "c"), ("t0", 3, "c"), ("t0", None, "n")],
                                  "company_id string, k long, v string")
    new = K.rows_to_append(batch, target, "k")
    assert sorted(r.k for r in new.collect()) == [3]
    assert K.rows_to_append(new, target.unionByName(new), "k").count() == 0


def test_append_shuffles_whole_rows_once(spark):
    def exchanges(df):
        df.collect()
        return re.findall(r"Exchange hashpartitioning\(([^\n]*)", df._jdf.queryExecution().executedPlan().toString().split(
            "== Initial Plan ==")[0])

    schema = "company_id string, k long, v string"
    target = spark.createDataFrame([("t0", 1, "a"), ("t0", 2, "b")], schema)
    batch = spark.createDataFrame([("t0", 2, "b"), ("t0", 3, "c"), ("t0", 3, "c"), (None, 3, "n")], schema)
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}):
        new = K.rows_to_append(batch, target, "k")
        assert sorted((str(r.company_id), r.k) for r in new.collect()) == [("None", 3), ("t0", 3)]
        assert len(exchanges(new)) == 3   # the rows, the batch's keys and the target's
        assert exchanges(K.rows_to_append(target, target, "k")) == []


def test_extract_joins_the_lookup_to_the_narrow_lines(spark):
    line = spark.createDataFrame([(1, 7, 2.0), (1, 8, 3.0), (2, None, 4.0)], "k long, u long, q double")
    header = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3)], "company_id string, k long")
    lookup = spark.createDataFrame([(7, "x")], "u long, d string")
    out = _extract(line, header, lookup, "k", "u")
    assert sorted((r.company_id, r.k, r.q, str(r.d)) for r in out.collect()) == [
        ("a", 1, 2.0, "x"), ("a", 1, 3.0, "None"), ("b", 2, 4.0, "None")]
    top = re.search(r"Join (\w+)", out._jdf.queryExecution().optimizedPlan().toString())
    assert top.group(1) == "Inner"    # the header is joined last
    own = spark.createDataFrame([("a", 7, "x"), ("b", 7, "y")], "company_id string, u long, d string")
    out = _extract(line, header, own, "k", "u")   # a lookup per tenant waits for the header's tenant
    assert sorted((r.company_id, r.k, r.q, str(r.d)) for r in out.collect()) == [
        ("a", 1, 2.0, "x"), ("a", 1, 3.0, "None"), ("b", 2, 4.0, "None")]


def test_duplicate_and_blank_columns(spark):
    a = spark.createDataFrame([(1, "x")], "id long, v string")
    b = spark.createDataFrame([(1, "y")], "ID long, w string")
    j = K.remove_dup_columns(a.join(b, a.id == b.ID))
    assert j.columns == ["id", "v", "w"] and j.first().v == "x"
    blank = spark.createDataFrame([(1, 2)], "a long, b long").toDF("a", " ")
    assert K.name_blank_columns(blank).columns == ["a", "nocolname"]


def test_overwrite_replaces_the_table(spark, tmp_path):
    df = spark.createDataFrame([("t0", 1), ("t1", 2)], "company_id string, x long")
    path = str(tmp_path / "tbl")

    def held():
        return sorted(tuple(r) for r in read_partitioned(spark, path).select("company_id", "x").collect())

    K.write_overwrite(df, path)
    K.write_overwrite(df, path)
    assert held() == [("t0", 1), ("t1", 2)]
    K.write_overwrite(df.filter("company_id = 't1'").withColumn("x", F.lit(5).cast("long")), path, tenants_only=True)
    assert held() == [("t0", 1), ("t1", 5)]                       # t0 is left as it is
    K.write_overwrite(df.filter("company_id = 't1'"), path)
    assert held() == [("t1", 2)]                                  # t0 has no rows: gone


def test_tenant_ids_are_read_as_written(spark, tmp_path):
    ids = ["007", "7", "0042", "2020-01-01", "1e3", None]
    df = spark.createDataFrame([(t, i) for i, t in enumerate(ids)], "company_id string, x long")
    path = str(tmp_path / "tbl")
    K.write_overwrite(df, path)
    back = read_partitioned(spark, path)
    assert dict(back.dtypes)["company_id"] == "string"
    assert {r.x: r.company_id for r in back.collect()} == dict(enumerate(ids))


def test_target_plus_delta_is_the_source(spark):
    from ledgerlens.plans.catalog import q_incremental_completeness
    rows = {}
    for r in q_incremental_completeness(spark, "/root/testdata/sf0.001").collect():
        rows.setdefault((r.company_id, r.step), {})[r.part] = r.lines
    assert len(rows) == 10
    assert all(v.get("target", 0) + v.get("delta", 0) == v["source"] for v in rows.values())
    assert {k for k, v in rows.items() if not v.get("delta")} == {("MACHINERY", "recent_order"), ("MACHINERY", "recent_vendor")}
    assert {k[0] for k, v in rows.items() if not v.get("target")} == {"HOUSEHOLD"}
