from ledgerlens.operators.ingest import prepare_orders
from ledgerlens.sources.standins import ORDER_INDEX_ORDER
from ledgerlens.streaming.ingest import start_incremental_ingest

from .helpers import raw_orders, ts


def _drop(spark, path, orders):
    df = raw_orders(spark, [{"order_no": o, "ship2_email_address": "a@x",
                             "date_created": ts("2020-01-01"), "item_desc": f"i{k}"}
                            for o, k in orders]).drop("price")
    df.coalesce(1).write.mode("append").parquet(path)
    return df.schema


def _run(spark, land, schema, target, ckpt):
    q = start_incremental_ingest(spark, land, schema, target, "order_no", ORDER_INDEX_ORDER,
                                 ckpt, prepare=lambda df: prepare_orders(df))
    q.awaitTermination(120)
    return sorted((r["index"], r.order_no) for r in spark.read.parquet(target).collect())


def test_stream_appends_each_line_once(spark, tmp_path):
    land, target, ckpt = (str(tmp_path / x) for x in ("land", "target", "ckpt"))
    schema = _drop(spark, land, [(1, 0), (1, 1), (2, 0)])
    assert _run(spark, land, schema, target, ckpt) == [(0, 1), (1, 1), (2, 2)]
    _drop(spark, land, [(3, 0), (2, 5), (1, 1)])    # a new order, a late line on order 2, a repeated line
    assert _run(spark, land, schema, target, ckpt) == [(0, 1), (1, 1), (2, 2), (3, 2), (4, 3)]
    assert _run(spark, land, schema, target, ckpt) == [(0, 1), (1, 1), (2, 2), (3, 2), (4, 3)]
    # a new checkpoint replays every file and adds nothing
    assert _run(spark, land, schema, target, str(tmp_path / "again")) == [(0, 1), (1, 1), (2, 2), (3, 2), (4, 3)]
