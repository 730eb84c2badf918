import datetime as dt

from pyspark.sql import functions as F

from ledgerlens.operators import cohort as H
from ledgerlens.operators import rfm as R
from ledgerlens.operators.sales import clean_sales
from ledgerlens.operators.summary import sales_summary

from .helpers import raw_orders, ts


def _sales(spark, rows):
    return clean_sales(raw_orders(spark, rows))


def test_rank_bins_n6_not_ntile(spark):
    rows = [{"ship2_email_address": f"e{i}@x", "date_created": ts("2020-01-01"), "order_no": 100 * i + j,
             "unit_price": float(10 + i)} for i in range(1, 7) for j in range(i)]
    sc = {r.email: r for r in R.rfm_scores(R.rfm_base(_sales(spark, rows))).collect()}
    # frequencies 1..6 -> qcut bins 1,1,2,3,4,4 -> reversed F = 4,4,3,2,1,1
    assert [sc[f"e{i}@x"].f for i in range(1, 7)] == [4, 4, 3, 2, 1, 1]


def test_frequency_ties_by_email(spark):
    rows = [{"ship2_email_address": e, "date_created": ts("2020-01-01"), "order_no": k * 10 + j}
            for k, e in enumerate(["d@x", "a@x", "c@x", "b@x"]) for j in range(2)]
    sc = {r.email: r.f for r in R.rfm_scores(R.rfm_base(_sales(spark, rows))).collect()}
    assert [sc[e] for e in ["a@x", "b@x", "c@x", "d@x"]] == [4, 3, 2, 1]


def test_zero_and_negative_spend_removed(spark):
    rows = [{"ship2_email_address": "neg@x", "date_created": ts("2020-01-01"), "unit_price": -5.0},
            {"ship2_email_address": "zero@x", "date_created": ts("2020-01-01"), "unit_price": 0.0},
            {"ship2_email_address": "ok@x", "date_created": ts("2020-01-02"), "unit_price": 3.0}]
    base = R.rfm_base(_sales(spark, rows))
    assert [r.email for r in base.collect()] == ["ok@x"]
    assert base.first().recency == 1


def test_rfm_properties(spark):
    rows = [{"ship2_email_address": f"e{i % 37}@x", "date_created": ts("2020-01-01") + dt.timedelta(days=i % 50),
             "order_no": i, "unit_price": float(1 + (i * 7) % 13)} for i in range(400)]
    sales = _sales(spark, rows)
    rfm = R.rfm_table(sales, sales_summary(sales), clusters=False)
    out = rfm.collect()
    assert len(out) == len({r.email for r in out}) == 37
    assert all(1 <= x <= 4 for r in out for x in (r.r, r.f, r.m))
    assert all(r.cust_segment and r.quad_segment for r in out)
    assert R.cardinality_violations(rfm, ["company_id", "email"]).count() == 0


def _scaled(spark, rows):
    return spark.createDataFrame([(t, e, *map(float, z)) for t, e, z in rows],
                                 "company_id string, email string, recency_z double, frequency_z double, monetary_z double")


def test_kmeans_separates_blobs_of_every_tenant(spark):
    import random
    rnd = random.Random(0)
    rows = []
    for t, n in (("t0", 40), ("t1", 7)):
        for j, c in enumerate(R.KMEANS_START):
            rows += [(t, f"{j}-{i}", [x * 3 + rnd.gauss(0, 0.2) for x in c]) for i in range(n)]
    out = R.rfm_clusters(_scaled(spark, rows)).collect()
    assert len(out) == len(rows) and all(r.cluster_converged for r in out)
    assert all(r.cluster == int(r.email[0]) for r in out)


def test_kmeans_few_customers_and_round_limit(spark):
    rows = [("t0", "a", (0, 0, 0)), ("t0", "b", (0, 0, 0)), ("t1", "a", (1, 2, 3))]
    out = R.rfm_clusters(_scaled(spark, rows)).collect()
    assert len(out) == 3 and len({r.cluster for r in out if r.company_id == "t0"}) == 1
    limited = R.rfm_clusters(_scaled(spark, [("t0", f"e{i}", (i / 7, -i / 5, i / 3)) for i in range(30)]), rounds=1)
    assert {r.cluster_converged for r in limited.collect()} == {False}
    assert R.rfm_clusters(_scaled(spark, [])).count() == 0


def _cohort_rows(spark, spec):
    rows = []
    for email, days in spec.items():
        for i, d in enumerate(days):
            rows.append({"ship2_email_address": email, "date_created": ts(d), "order_no": hash((email, i)) % 10**9})
    return _sales(spark, rows)


def test_window_start_january_and_february_end(spark):
    for last, start6, start12 in [("2021-02-15", "2020-07-01", "2020-01-01"),
                                  ("2021-03-10", "2020-08-01", "2020-02-01")]:
        sales = _cohort_rows(spark, {"a@x": ["2019-06-01", last], "b@x": ["2020-12-31"]})
        for months, start in ((6, start6), (12, start12)):
            rows = H.cohort_rows(sales, months).agg(F.min("just_date"), F.max("just_date")).first()
            assert str(rows[1]) == "2020-12-31"          # the running month is cut (H2)
            lo = H.cohort_rows(_cohort_rows(spark, {"c@x": [start, "2020-12-31", last]}), months)
            assert str(lo.agg(F.min("just_date")).first()[0]) == start


def test_sparse_cohort_and_retention(spark):
    sales = _cohort_rows(spark, {"a@x": ["2020-01-05", "2020-03-05"], "b@x": ["2020-01-07"],
                                 "c@x": ["2020-01-09"], "z@x": ["2020-04-02"]})
    counts = H.cohort_counts(H.cohort_data(sales, 6), 6)
    r = {x.cohortmonth: x for x in counts.collect()}["2020-01"]
    assert (r.new_customer, r.days_30, r.days_60) == (3.0, None, 1.0)
    ret = {x.cohortmonth: x for x in H.retention(counts, 6).collect()}["2020-01"]
    assert ret.new_customer == 100.0 and abs(ret.days_60 - 33.3) < 1e-9 and ret.days_30 is None


def test_month_zero_counts_sum_to_customers(spark):
    spec = {f"e{i}@x": [f"2020-0{1 + i % 6}-1{i % 9}", f"2020-0{1 + (i * 5) % 7}-0{1 + i % 8}"]
            for i in range(40)}
    sales = _cohort_rows(spark, spec)
    data = H.cohort_data(sales, 6)
    month0 = data.filter("cohort_index = 0").agg(F.sum("customer_count")).first()[0]
    assert month0 == H.cohort_rows(sales, 6).select("email").distinct().count()
