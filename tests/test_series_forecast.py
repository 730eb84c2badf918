import datetime as dt
import math

from pyspark.sql import functions as F

from ledgerlens.operators import forecast as FC
from ledgerlens.operators import series as FS


def _series(spark, n=400, gaps=()):
    start = dt.date(2020, 1, 1)
    rows = []
    for i in range(n):
        if i in gaps:
            continue
        d = start + dt.timedelta(days=i)
        y = 50 + 0.5 * i + 10 * math.sin(2 * math.pi * (d - dt.date(1970, 1, 1)).days / 7)
        rows.append(("t0", d, y))
    return spark.createDataFrame(rows, "company_id string, ds date, y double")


def test_densify_fills_with_mean(spark):
    s = spark.createDataFrame([("t0", dt.date(2020, 1, 1), 2.0), ("t0", dt.date(2020, 1, 4), 4.0)],
                              "company_id string, ds date, y double")
    out = sorted(FS.densify(s).collect(), key=lambda r: r.ds)
    assert [r.y for r in out] == [2.0, 3.0, 3.0, 4.0]


def test_future_frame_horizon(spark):
    s = _series(spark, 30)
    f = FS.future_frame(s)
    assert f.count() == 120 and f.filter(F.col("y").isNull()).count() == 90


def test_forecast_properties_and_recovery(spark):
    s = _series(spark, 400)
    out = FC.forecast(FC.forecast_features(FS.future_frame(FS.densify(s)))).toPandas()
    assert len(out) == 400 + 90
    assert ((out.yhat - (out.trend + out.additive_terms)).abs() < 1e-6).all()
    assert (out.yhat_lower <= out.yhat).all() and (out.yhat <= out.yhat_upper).all()
    hist = out[out.y.notna()]
    assert (hist.y - hist.yhat).abs().mean() < 1.0                    # linear + weekly recovered
    fut = out[out.y.isna()].sort_values("ds")
    assert fut.trend.iloc[-1] > fut.trend.iloc[0]                     # trend continues upward


def test_forecast_per_tenant_in_one_job(spark):
    a = _series(spark, 60)
    b = _series(spark, 20).withColumn("company_id", F.lit("t1"))
    out = FC.forecast(FC.forecast_features(FS.future_frame(a.unionByName(b))))
    counts = {r.company_id: r["count"] for r in out.groupBy("company_id").count().collect()}
    assert counts == {"t0": 150, "t1": 110}
