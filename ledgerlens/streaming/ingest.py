"""High-watermark incremental load as a Structured Streaming job.

New extract files land in a folder; each micro-batch keeps the lines that the
target table does not hold (by their whole business key, so a late line of an
order already loaded is taken), continues the surrogate ``index`` and appends
them. Repeating a batch after a failure, also after a partly committed
append, adds only what is missing.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators.ingest import next_index, surrogate_index
from ..session import TENANT
from ..sources.sinks import write_append
from ..sources.tables import path_exists, read_partitioned


def _target(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    if path_exists(spark, path):  # any other failure to read it is an error
        return read_partitioned(spark, path)
    return like.limit(0).withColumn("index", F.lit(None).cast("bigint"))


def missing_lines(rows: DataFrame, target: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Rows whose business key (tenant, ``key`` and the columns of ``order``)
    is not in the target; the join is on tenant and key, the rest is compared."""
    held = target.select(TENANT, *dict.fromkeys([key, *order])).alias("t")
    same = (F.col(f"s.{TENANT}") == F.col(f"t.{TENANT}")) & F.col(f"s.{key}").eqNullSafe(F.col(f"t.{key}"))
    for c in order:
        same = same & F.col(f"s.{c}").eqNullSafe(F.col(f"t.{c}"))
    return rows.alias("s").join(held, same, "left_anti")


def start_incremental_ingest(spark: SparkSession, landing_dir: str, schema: StructType,
                             target_path: str, key: str, order: Sequence[str],
                             checkpoint_location: str,
                             prepare: Callable[[DataFrame], DataFrame] = lambda df: df,
                             available_now: bool = True,
                             processing_time: str | None = None) -> StreamingQuery:
    """Start the stream; ``prepare`` applies I1-I4 to each batch."""

    def load_batch(batch: DataFrame, epoch_id: int) -> None:
        rows = prepare(batch)
        target = _target(spark, target_path, rows)
        new = surrogate_index(missing_lines(rows, target, key, order), order, next_index(target))
        write_append(new, target_path)

    stream = spark.readStream.schema(schema).parquet(landing_dir)
    writer = (stream.writeStream.foreachBatch(load_batch)
              .option("checkpointLocation", checkpoint_location))
    writer = (writer.trigger(availableNow=True) if available_now
              else writer.trigger(processingTime=processing_time or "1 minute"))
    return writer.start()
