"""Exact selection against a full sort, with limits that force every level."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerlens.operators import rfm as R
from ledgerlens.operators import selection as Q


@pytest.mark.parametrize("rows,cuts", [(100_000, 255), (40, 7), (3, 3)])
def test_rows_at_ranks(spark, monkeypatch, rows, cuts):
    monkeypatch.setattr(Q, "SELECT_ROWS", rows)
    monkeypatch.setattr(Q, "CUTS", cuts)
    rnd = random.Random(cuts)
    data = [("a", rnd.choice([1.0, 2.0, 2.5, 1e9, rnd.random()]), f"c{k}@é.com") for k in range(400)]
    data += [("b", 5.0, "x" * (k % 7) + str(k)) for k in range(60)] + [("c", 1.5, "one")]
    df = spark.createDataFrame(data, "company_id string, v double, email string").repartition(3)
    ranks = {"a": [1, 57, 200, 399, 400], "b": [1, 30, 60], "c": [1]}
    wanted = spark.createDataFrame([(t, sum(x == t for x, *_ in data), k, r) for t, rs in ranks.items() for k, r in enumerate(rs)],
                                   "company_id string, _ll_n long, _ll_k int, _ll_rank long")
    got = {(r.company_id, r._ll_k): (r.v, r.email) for r in Q.rows_at_ranks(df, "v", "email", wanted).collect()}
    byte_order = {t: sorted(((v, e) for x, v, e in data if x == t), key=lambda p: (p[0], p[1].encode())) for t in ranks}
    assert got == {(t, k): byte_order[t][r - 1] for t, rs in ranks.items() for k, r in enumerate(rs)}


@pytest.mark.parametrize("rows", [100_000, 5])
def test_score_bins_equal_those_of_full_ranks(spark, monkeypatch, rows):
    monkeypatch.setattr(Q, "SELECT_ROWS", rows)
    rnd = random.Random(5)
    data = [(t, f"e{k}", rnd.randrange(1, 9), rnd.randrange(1, 4), float(rnd.randrange(1, 30)))
            for t, n in (("a", 101), ("b", 40), ("c", 1), ("d", 3)) for k in range(n)]
    base = spark.createDataFrame(data, "company_id string, email string, recency long, frequency long, monetary double")
    df = R.rfm_scores(base)
    n = F.count(F.lit(1)).over(Window.partitionBy("company_id"))
    for c in ("frequency", "monetary"):
        rank = F.row_number().over(Window.partitionBy("company_id").orderBy(c, "email"))
        df = df.withColumn(f"want_{c[0]}", 5 - (1 + sum(((rank - 1) * 4 > (n - 1) * k).cast("int") for k in (1, 2, 3))))
    assert df.where("f != want_f OR m != want_m").count() == 0 and df.count() == len(data)


def test_scores_plan_has_no_range_exchange(spark):
    from ledgerlens.plans.catalog import QUERIES
    plan = QUERIES["rfm_scores"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "Scan ExistingRDD" not in plan
