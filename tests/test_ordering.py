import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerlens.operators import ordering
from ledgerlens.operators.ordering import (global_row_number, global_running_sum, row_number_by_key,
                                           written_row_number)


def _data(spark, n=3000):
    rnd = random.Random(3)
    # one hot tenant with most rows, plus small ones; many value ties
    rows = [("hot" if rnd.random() < 0.7 else f"t{rnd.randint(1, 5)}", rnd.randint(0, 20),
             f"e{i:05d}", rnd.randint(1, 100)) for i in range(n)]
    return spark.createDataFrame(rows, "g string, v int, k string, x int").repartition(7)


def test_row_number_equals_single_partition_window(spark):
    df = _data(spark)
    got = global_row_number(df, ["v", "k"], ["g"], "rn").select("g", "k", "rn")
    want = df.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy("v", "k")))
    assert sorted(got.collect()) == sorted(want.select("g", "k", "rn").collect())


def test_row_number_descending_no_groups(spark):
    df = _data(spark, 500)
    got = global_row_number(df, [F.col("v").desc(), "k"], [], "rn").select("k", "rn")
    want = df.withColumn("rn", F.row_number().over(Window.orderBy(F.col("v").desc(), "k")))
    assert sorted(got.collect()) == sorted(want.select("k", "rn").collect())


def test_running_sum_equals_window(spark):
    df = _data(spark)
    got = global_running_sum(df, F.col("x").cast("decimal(38,0)"), ["v", "k"], ["g"], "cs")
    w = Window.partitionBy("g").orderBy("v", "k").rowsBetween(Window.unboundedPreceding, 0)
    want = df.withColumn("cs", F.sum(F.col("x").cast("decimal(38,0)")).over(w))
    assert sorted(got.select("g", "k", "cs").collect()) == \
        sorted(want.select("g", "k", "cs").collect())


def _key_rows(spark, pad=""):
    # a hot key, a null key, other keys of one or two rows and repeated rows
    rows = [("t", k // 2, f"e{k:04d}", pad) for k in range(400)] + [("t", 7, f"h{k:04d}", pad) for k in range(500)]
    rows += [("u", None, f"n{k:04d}", pad) for k in range(300)] + [("u", 3, None, pad), ("u", 3, "x", pad)]
    return spark.createDataFrame(rows, "g string, k int, r string, pad string").repartition(5)


def test_row_number_by_key_equals_window(spark, monkeypatch):
    df = _key_rows(spark)
    want = sorted(map(str, df.withColumn("n", F.row_number().over(Window.partitionBy("g").orderBy("k", "r"))).collect()))
    for limit, broadcast in ((10_000, 100), (100, 100), (100, 1), (1, 100)):   # all in tasks, hot keys ranged
        monkeypatch.setattr(ordering, "KEY_ROWS", limit)
        monkeypatch.setattr(ordering, "BROADCAST_KEYS", broadcast)
        got = row_number_by_key(df, ["k"], ["r"], ["g"], "n")
        assert got.columns == ["g", "k", "r", "pad", "n"]
        assert sorted(map(str, got.collect())) == want, (limit, broadcast)
    assert row_number_by_key(df.limit(0), ["k"], ["r"], ["g"], "n").count() == 0


def test_row_number_by_key_writes_narrow_rows_only(spark, tmp_path):
    import os

    from ledgerlens.session import ensure_checkpoint_dir
    root = ensure_checkpoint_dir(spark).removeprefix("file:")

    def written():
        return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(root) for f in names)

    path = f"{tmp_path}/rows"
    rnd = F.concat_ws("", *(F.sha2(F.concat(F.col("r"), F.lit(i)), 512) for i in range(8)))
    _key_rows(spark).where("k IS NULL OR k != 7").withColumn("pad", rnd).write.parquet(path)
    size = sum(os.path.getsize(f"{path}/{f}") for f in os.listdir(path))
    start = written()
    assert row_number_by_key(spark.read.parquet(path), ["k"], ["r"], ["g"], "n").count() == 700
    assert written() - start < size / 10


def test_written_row_number_equals_window_and_reads_its_input_once(spark, tmp_path):
    df = _key_rows(spark)
    want = sorted(map(str, df.withColumn("n", F.row_number().over(Window.partitionBy("g").orderBy("k", "r"))).collect()))
    got = written_row_number(df, ["k", "r"], ["g"], "n")
    assert got.columns == ["g", "k", "r", "pad", "n"]
    assert sorted(map(str, got.collect())) == want
    assert written_row_number(df.limit(0), ["k", "r"], ["g"], "n").count() == 0
    # what is read later is the written copy: its input may be gone by then
    path = f"{tmp_path}/rows"
    df.write.parquet(path)
    got = written_row_number(spark.read.parquet(path), ["k", "r"], ["g"], "n")
    assert path not in " ".join(got.inputFiles()) and got.count() == df.count()


def test_ranged_rows_are_written_compressed(spark):
    """What the helpers keep between ranging and counting is parquet, not rows as they are in memory."""
    import os

    from ledgerlens.session import ensure_checkpoint_dir
    root = ensure_checkpoint_dir(spark).removeprefix("file:")

    def written():
        return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(root) for f in names)

    df = spark.range(50_000).selectExpr("id AS k", "repeat('x', 400) AS pad", "'g' AS g")
    for call in (lambda: global_row_number(df, ["k"], ["g"], "n"),
                 lambda: global_running_sum(df, F.col("k").cast("decimal(38,0)"), ["k"], ["g"], "s")):
        start = written()
        assert call().count() == 50_000
        assert written() - start < 50_000 * 100
