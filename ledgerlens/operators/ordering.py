"""Global order statistics without a single-partition window.

``Window.orderBy`` with no ``partitionBy`` moves every row into one task.
Instead rows are range-partitioned on the sort keys, numbered inside each
partition, and shifted by the row counts of the earlier partitions of the
same group. The range partitioning comes from sampling, so the numbered
frame is written (compressed, under ``spark.checkpoint.dir``) before the
per-partition counts are read from it: a recomputation could sample other
boundaries.

``order`` must end in a unique tie-break, otherwise counts stay right but
the order among exact ties is arbitrary.

Wide rows need not go that way: ``row_number_by_key`` ranges only (key, count)
rows and joins the first number of each key back to the rows, which reads its input
three times; ``written_row_number`` reads it once and leaves a numbered copy.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DatetimeType, NumericType

from ..session import FREED, materialize, materialize_parts, passes_of, settings

_PID, _MID, _N, _BASE, _OFF, _CUM = "_ll_pid", "_ll_mid", "_ll_n", "_ll_base", "_ll_off", "_ll_in"
_KEY, _IN = "_ll_key", "_ll_rank"

KEY_ROWS = 10_000           # rows of one key numbered in one task; larger keys are ranged
BROADCAST_KEYS = 100_000    # larger keys that are broadcast, more join by shuffle
SORT_BYTES = "16m"          # shuffled bytes of wide rows that one task sorts


def _cols(xs: Sequence[Column | str]) -> list[Column]:
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def _ranged(df: DataFrame, order: Sequence[Column | str], groups: Sequence[str]) -> DataFrame:
    keys = [*_cols(groups), *_cols(order)]
    return df.repartitionByRange(*keys).sortWithinPartitions(*keys)


def _offsets(stats: DataFrame, groups: Sequence[str], value: str) -> DataFrame:
    # stats has one row per (partition, group) present in it: at most
    # #partitions + #groups rows, so broadcasting it is bounded.
    spec = Window.partitionBy(*groups) if groups else Window
    w = spec.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    return stats.withColumn(_OFF, F.coalesce(F.sum(value).over(w), F.lit(0)))


def global_row_number(df: DataFrame, order: Sequence[Column | str],
                      groups: Sequence[str] = (), name: str = "row_number") -> DataFrame:
    """1-based position of each row in ``order`` within its ``groups``."""
    numbered = materialize(_ranged(df, order, groups)
                           .withColumn(_PID, F.spark_partition_id())
                           .withColumn(_MID, F.monotonically_increasing_id()))
    stats = numbered.groupBy(_PID, *groups).agg(
        F.count(F.lit(1)).alias(_N), F.min(_MID).alias(_BASE))
    stats = _offsets(stats, groups, _N).drop(_N)
    out = numbered.join(F.broadcast(stats), [_PID, *groups])
    return out.withColumn(name, F.col(_MID) - F.col(_BASE) + F.col(_OFF) + 1).drop(
        _PID, _MID, _BASE, _OFF)


def global_running_sum(df: DataFrame, value: Column | str, order: Sequence[Column | str],
                       groups: Sequence[str] = (), name: str = "running_sum") -> DataFrame:
    """Inclusive running sum of ``value`` in ``order`` within ``groups``.

    Use an exact type (decimal) for ``value`` when the result is compared.
    """
    v = F.col(value) if isinstance(value, str) else value
    ranged = materialize(_ranged(df.withColumn(_N, v), order, groups)
                         .withColumn(_PID, F.spark_partition_id()))
    inside = Window.partitionBy(_PID, *groups).orderBy(*_cols(order)).rowsBetween(
        Window.unboundedPreceding, 0)
    local = ranged.withColumn(_CUM, F.sum(_N).over(inside))
    stats = _offsets(ranged.groupBy(_PID, *groups).agg(F.sum(_N).alias("_ll_s")), groups, "_ll_s")
    out = local.join(F.broadcast(stats.drop("_ll_s")), [_PID, *groups])
    return out.withColumn(name, F.col(_CUM) + F.col(_OFF)).drop(_PID, _N, _CUM, _OFF)


def row_number_by_key(df: DataFrame, key: Sequence[str], rest: Sequence[Column | str],
                      groups: Sequence[str] = (), name: str = "row_number") -> DataFrame:
    """1-based position of each row in ``key`` then ``rest`` within its ``groups``.

    The rows are counted per key; running sums over these narrow rows give the
    number before each key. The wide rows are shuffled once, by key, for the join
    and for the rank inside the key alike; nothing of them is written. Keys of
    more than ``KEY_ROWS`` rows (a null key, say) leave before that shuffle and
    are ranged on ``rest``. Null keys are equal and come first.
    """
    keys = [*groups, *key]
    named = df.withColumn(_KEY, F.struct(*keys))   # a struct equals another with nulls in the same places
    counts = named.groupBy(_KEY).agg(F.count(F.lit(1)).cast("decimal(38,0)").alias("_ll_rows"))
    counts = materialize(counts.select(_KEY, "_ll_rows"))
    plain = counts.select(_KEY, "_ll_rows", *(F.col(f"{_KEY}.{k}").alias(k) for k in keys))
    before = global_running_sum(plain, "_ll_rows", key, groups, _BASE).select(
        _KEY, "_ll_rows", (F.col(_BASE) - F.col("_ll_rows")).cast("bigint").alias(_BASE))
    large = counts.where(F.col("_ll_rows") > KEY_ROWS).select(_KEY)
    n = large.count()
    ranked = named
    if n:
        large = F.broadcast(large) if n <= BROADCAST_KEYS else large
        ranked = named.join(large, _KEY, "left_anti")
    inside = Window.partitionBy(_KEY).orderBy(*_cols(rest))
    ranked = ranked.join(before.drop("_ll_rows"), _KEY).withColumn(_IN, F.row_number().over(inside))
    if n:
        hot = named.join(large, _KEY, "left_semi")
        hot = global_row_number(hot, rest, [_KEY], _IN)
        first = before.where(F.col("_ll_rows") > KEY_ROWS).drop("_ll_rows")
        hot = hot.join(F.broadcast(first) if n <= BROADCAST_KEYS else first, _KEY)
        ranked = ranked.unionByName(hot.select(*ranked.columns))
    return ranked.withColumn(name, F.col(_IN) + F.col(_BASE)).select(*df.columns, name)


def _key_ranges(df: DataFrame, key: str) -> Iterator[DataFrame]:
    """``df`` in ascending ranges of ``key`` (nulls first), one for each pass it is
    written in; a key that has no quantiles (text) makes one range."""
    n = passes_of(df) if isinstance(df.schema[key].dataType, (NumericType, DatetimeType)) else 1
    cuts = []
    if n > 1:
        with settings(df.sparkSession, FREED):
            cuts = df.agg(F.percentile_approx(key, [k / n for k in range(1, n)], 10_000)).first()[0]
        cuts = sorted(set(cuts or []))
    if not cuts:
        yield df
        return
    c = F.col(key)
    yield df.where(c.isNull() | (c <= F.lit(cuts[0])))
    for low, high in zip(cuts, cuts[1:]):
        yield df.where((c > F.lit(low)) & (c <= F.lit(high)))
    yield df.where(c > F.lit(cuts[-1]))


def written_row_number(df: DataFrame, order: Sequence[str], groups: Sequence[str] = (), name: str = "row_number") -> DataFrame:
    """1-based position of each row in ``order`` within its ``groups``, for wide rows
    that come from joins.

    ``df`` is shuffled and written once: rows are ranged on all of ``order`` (so the
    rows of one key, the null key say, may lie in several partitions) and written as
    parquet with their place in the partition. What comes back is a scan of that copy
    with the counts of earlier partitions added: a reader of a few columns opens only
    these, and the rows need not be written again to be read more than once. A large
    input goes in passes, a range of the first column of ``order`` each, so only a
    pass's shuffle files are held beside the copy.
    """
    def ranged() -> Iterator[DataFrame]:
        for k, part in enumerate(_key_ranges(df, order[0])):
            yield _ranged(part, order, groups).withColumns(
                {_PID: F.spark_partition_id() + F.lit(k << 24), _MID: F.monotonically_increasing_id()})

    # small partitions, because a task sorts whole rows in memory
    with settings(df.sparkSession, {"spark.sql.adaptive.advisoryPartitionSizeInBytes": SORT_BYTES}):
        written = materialize_parts(ranged())
    stats = written.groupBy(_PID, *groups).agg(F.count(F.lit(1)).alias(_N), F.min(_MID).alias(_BASE))
    stats = materialize(_offsets(stats, groups, _N).drop(_N))
    out = written.join(F.broadcast(stats), [_PID, *groups])
    return out.withColumn(name, F.col(_MID) - F.col(_BASE) + F.col(_OFF) + 1).select(*df.columns, name)
