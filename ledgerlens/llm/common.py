"""Helpers the operators share: written intermediates, size-checked broadcast,
connected components."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import session
from ..session import settings

#: A side is broadcast only after its rows were counted and are at most this many.
BROADCAST_ROWS = 500_000

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def materialize(df: DataFrame) -> DataFrame:
    """``df`` written once and read back; the shuffle files of the plan go as
    soon as it is written, as nothing reads them again."""
    with settings(df.sparkSession, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}):
        return session.materialize(df)


def finished(make: Callable[[], DataFrame]) -> DataFrame:
    """What ``make`` returns, written; the tables that ``materialize`` wrote on
    the way are deleted. Nothing else that reads them may leave ``make``."""
    session.passing.append([])
    try:
        out = materialize(make())
    finally:
        written = session.passing.pop()
    if session.passing:
        session.passing[-1].append(written[-1])
    conf = out.sparkSession.sparkContext._jsc.hadoopConfiguration()
    for place in written[:-1]:
        place.getFileSystem(conf).delete(place, True)
    return out


def lower_ascii(col):
    """Lower-case A-Z only."""
    return F.translate(col, UPPER, LOWER)


def broadcast_if_small(df: DataFrame, rows: int | None = None) -> DataFrame:
    """Hint a broadcast only where the (already written) frame was counted and
    is small; beyond the bound Spark joins it by a shuffle."""
    n = df.count() if rows is None else rows
    return F.broadcast(df) if n <= BROADCAST_ROWS else df


def numbered(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` with a row number ``name`` that stays the same whenever the
    frame is read again.

    Rows of a plan without an exchange (a file scan and what is done row by
    row) sit in the same partitions each time. Behind a shuffle or a join that
    adaptive execution may re-plan they need not, so there the numbered rows
    are written once and read back.
    """
    out = docs.withColumn(name, F.monotonically_increasing_id())
    plan = docs._jdf.queryExecution().executedPlan().toString()
    moves = ("AdaptiveSparkPlan", "Exchange", "Sample", "Limit", "Coalesce")
    return materialize(out) if any(x in plan for x in moves) else out


def _written(df: DataFrame) -> tuple[DataFrame, tuple]:
    out = materialize(df)
    row = out.agg(F.count(F.lit(1)).alias("n"),
                  F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0)).alias("h")
                  ).first()
    return out, (row["n"], int(row["h"]))


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node on an edge; component is the smallest
    node id reachable.

    Distributed union-find by alternating large-star and small-star rounds
    until the edge set is a set of stars: each round is two grouped minima
    (combined map-side, so a hub costs one row per task) and two joins that
    AQE may split. Every round is written as parquet under the checkpoint
    folder, so a lost executor costs one round at most. Empty input gives an
    empty result; loops and repeated edges are ignored.
    """
    e = (edges.where(F.col(a) != F.col(b))
         .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    e, state = _written(e)
    while state[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(low, "u").where("v > u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        large = materialize(large)
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").where("v != m")
                 .select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        e, now = _written(small)
        if now == state:
            break
        state = now
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
