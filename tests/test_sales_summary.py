import math

from pyspark.sql import functions as F

from ledgerlens.operators.churn_gap import gap_churn
from ledgerlens.operators.sales import clean_sales
from ledgerlens.operators.summary import sales_summary, valid_dates

from .helpers import raw_orders, ts


def _summary(spark, rows):
    return sales_summary(clean_sales(raw_orders(spark, rows)))


def test_clean_sales_shift_dedupe_and_nulls(spark):
    dup = {"ship2_email_address": "a@x", "date_created": ts("2020-01-10"), "order_no": 7}
    rows = [dup, dict(dup),                                           # exact duplicate line
            {"ship2_email_address": None, "date_created": ts("2020-01-10")},
            {"ship2_email_address": "b@x", "date_created": None}]
    s = clean_sales(raw_orders(spark, rows)).collect()
    assert len(s) == 1
    r = s[0]
    assert str(r.date_created) == "2020-01-10 04:00:00" and r.hour == 4
    assert r.session == "Late Night" and str(r.just_date) == "2020-01-10"


def test_text_dates_sentinel_blank_and_short(spark):
    rows = [{"ship2_email_address": "a@x", "date_created": "None"},
            {"ship2_email_address": "a@x", "date_created": ""},
            {"ship2_email_address": "a@x", "date_created": "2020-03-01 12:00:00"}]
    raw = raw_orders(spark, [{"ship2_email_address": "z"}]).limit(0)
    text = raw.withColumn("date_created", F.col("date_created").cast("string"))
    df = text.unionByName(spark.createDataFrame(
        [("t0", r["date_created"], r["ship2_email_address"]) for r in rows],
        "company_id string, date_created string, ship2_email_address string"),
        allowMissingColumns=True)
    out = clean_sales(df).collect()
    assert [str(r.date_created) for r in out] == ["2020-03-01 04:00:00"]
    short = spark.createDataFrame([("2020",), ("2020-01-01 00:00:00",), (None,)], "date_created string")
    assert valid_dates(short).count() == 1                           # E1


def test_one_row_customer(spark):
    rows = [{"ship2_email_address": "one@x", "date_created": ts("2020-01-01")},
            {"ship2_email_address": "last@x", "date_created": ts("2020-02-01")}]
    r = {x.email: x for x in _summary(spark, rows).collect()}
    one = r["one@x"]
    assert (one.interval, one.std_, one.diff, one.avg_metric, one.new_customer) == (0, 0.0, 0.0, 0.0, 1)
    assert one.win_back == "not_returned" and one.churn_label == "churn"
    assert r["last@x"].churn_label == "active" and r["last@x"].recent_order == 0


def test_two_row_customer(spark):
    rows = [{"ship2_email_address": "a@x", "date_created": ts("2020-01-01"), "order_no": 1},
            {"ship2_email_address": "a@x", "date_created": ts("2020-01-11"), "order_no": 2}]
    out = sorted(_summary(spark, rows).collect(), key=lambda r: r.order_id)
    assert [r.interval for r in out] == [0, 10] and {r.len for r in out} == {2}
    assert [r.win_back for r in out] == ["not_returned", "returned"]
    assert [r.new_customer for r in out] == [1, 0]


def test_equal_gaps(spark):
    rows = [{"ship2_email_address": "a@x", "date_created": ts(d), "order_no": i}
            for i, d in enumerate(["2020-01-01", "2020-01-11", "2020-01-21"])]
    out = sorted(_summary(spark, rows).collect(), key=lambda r: r.order_id)
    assert [r.interval for r in out] == [0, 10, 10]
    assert math.isclose(out[0].mean, 20 / 3)
    assert math.isclose(out[0].std_, 1.4 * math.sqrt(100 / 3))       # 8.083
    assert [round(r.avg_diff, 3) for r in out] == [6.667, 3.333, 3.333]
    assert {r.win_back for r in out} == {"not_returned"}
    assert {r.freq_pur for r in out} == {"3 Orders"} and {r.repeat_customer for r in out} == {0}


def test_same_day_rows_only_first_carries_gap(spark):
    rows = [{"ship2_email_address": "a@x", "date_created": ts("2020-01-01"), "order_no": 1},
            {"ship2_email_address": "a@x", "date_created": ts("2020-01-05", 9), "order_no": 3},
            {"ship2_email_address": "a@x", "date_created": ts("2020-01-05", 8), "order_no": 9},
            {"ship2_email_address": "a@x", "date_created": ts("2020-01-05", 8), "order_no": 2,
             "item_desc": "zzz"}]
    out = {(r.order_id): r.interval for r in _summary(spark, rows).collect()}
    # earliest timestamp, then lowest order_id, is the day's first row
    assert out == {1: 0, 2: 4, 9: 0, 3: 0}


def test_gap_churn(spark):
    rows = [{"ship2_email_address": "a@x", "date_created": ts(d), "order_no": i}
            for i, d in enumerate(["2020-01-01", "2020-01-01", "2020-01-03", "2020-01-08"])]
    rows.append({"ship2_email_address": "b@x", "date_created": ts("2020-03-01"), "order_no": 99})
    g = {(r.email, str(r.just_date)): r for r in gap_churn(clean_sales(raw_orders(spark, rows))).collect()}
    a = g[("a@x", "2020-01-01")]
    assert a["count"] == 2 and a.avg_days_order == 2.0       # gaps 0,2,5 -> mean 2.33 -> 2
    assert a.avg_rate == 4.0 and a.churn_label == "churn"
    assert {r.churn_label_latest for k, r in g.items() if k[0] == "a@x"} == {"churn"}
    assert g[("b@x", "2020-03-01")].churn_label == "active"


def test_rows_equal_to_the_first_share_its_gap_and_lines_are_shuffled_once(spark):
    line = {"ship2_email_address": "a@x", "supplier_id": None}
    rows = [{**line, "date_created": ts("2020-01-01"), "order_no": 1},
            {**line, "date_created": ts("2020-01-05"), "order_no": 2},
            {**line, "date_created": ts("2020-01-05"), "order_no": 2, "supplier_id": 3}]
    sales = clean_sales(raw_orders(spark, rows))
    twice = sales.unionByName(sales)
    out = sorted((r.order_id, r.supplier_id or 0, r.interval) for r in sales_summary(twice).collect())
    assert out == [(1, 0, 0)] * 2 + [(2, 0, 4)] * 2 + [(2, 3, 0)] * 2     # a null supplier comes first
    plan = sales_summary(sales)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan
