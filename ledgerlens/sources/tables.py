"""Readers (S3, S4): parquet tables by name, or a JDBC query source; per-tenant
maxima from file footers and reads above per-tenant watermarks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import TENANT, per_tenant, settings


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Warehouse table by name (parquet in tests, any path in deployment)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_INFER = "spark.sql.sources.partitionColumnTypeInference.enabled"


def read_partitioned(spark: SparkSession, path: str) -> DataFrame:
    """A table partitioned by tenant, with its ids as text (``007`` stays ``007``).

    Folder names carry no type, so ids that look like numbers or dates would
    be read as such; inference is off while the table's schema is resolved.
    """
    with settings(spark, {_INFER: "false"}):
        return spark.read.parquet(path)


#: Tenants are read in at most this many groups of similar watermarks, so a plan
#: stays small however many tenants there are.
WATERMARK_GROUPS = 32


def footer_maxima(spark: SparkSession, path: str, columns: Sequence[str]) -> dict[str, dict]:
    """I8: ``{company_id: {column: max}}`` of a table partitioned by tenant.

    Maxima come from the statistics in the Parquet footers: the aggregate is
    pushed into the scan, so no column data is read, and one row a tenant comes
    back. A file without statistics (a column that is all null) makes Spark
    refuse that; the columns themselves are then read.
    """
    def run(pushed: bool) -> list:
        with settings(spark, {_INFER: "false", "spark.sql.parquet.aggregatePushdown": str(pushed).lower(),
                               "spark.sql.sources.useV1SourceList": "" if pushed else "parquet"}):
            df = spark.read.parquet(path)
            return df.groupBy(TENANT).agg(*(F.max(c).alias(c) for c in columns)).collect()

    try:
        rows = run(True)
    except (Py4JJavaError, PySparkException) as e:
        if "No min/max found" not in str(e):
            raise
        rows = run(False)
    return {r[TENANT]: {c: r[c] for c in columns} for r in rows}


def read_above(spark: SparkSession, path: str, key: str, marks: Mapping[str, int | None]) -> DataFrame:
    """Rows of the tenants in ``marks`` whose ``key`` is above the tenant's
    mark (no mark: all its rows).

    Tenants are sorted by mark and cut into at most ``WATERMARK_GROUPS`` groups. A
    group is one scan whose partition filter names its tenants and whose pushed
    filter is the group's lowest mark as a literal, so row groups of old keys are
    skipped by their statistics and other tenants' files are not opened; every file
    is read once. Where a group holds several marks each row is then held against
    its own tenant's.
    """
    table = read_partitioned(spark, path)
    parts = []
    unmarked = sorted(t for t, m in marks.items() if m is None)
    if unmarked:
        parts.append(table.where(F.col(TENANT).isin(unmarked)))
    order = sorted((m, t) for t, m in marks.items() if m is not None)
    size = max(1, -(-len(order) // WATERMARK_GROUPS))
    for k in range(0, len(order), size):
        group = order[k:k + size]
        rows = table.where(F.col(TENANT).isin([t for _, t in group]) & (F.col(key) > F.lit(group[0][0])))
        if group[-1][0] > group[0][0]:
            own = spark.createDataFrame([(t, m) for m, t in group], f"{TENANT} string, _ll_mark bigint")
            rows = rows.join(per_tenant(own), TENANT).where(F.col(key) > F.col("_ll_mark")).drop("_ll_mark")
        parts.append(rows.select(*table.columns))
    return reduce(DataFrame.unionByName, parts) if parts else table.where(F.lit(False))


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def read_jdbc_query(spark: SparkSession, url: str, query: str, *,
                    partition_column: str | None = None, lower_bound: int | None = None,
                    upper_bound: int | None = None, num_partitions: int | None = None,
                    properties: dict[str, str] | None = None) -> DataFrame:
    """S3: external query source, read in parallel slices of ``partition_column``.

    The reference pulls the whole result into one process; here each of
    ``num_partitions`` tasks reads one key range. Credentials come from
    ``properties`` supplied by the caller, never from this package.
    """
    reader = spark.read.format("jdbc").option("url", url)
    if partition_column:
        # partitioned reads need dbtable; wrap the query as a derived table
        reader = (reader.option("dbtable", f"({query}) src")
                  .option("partitionColumn", partition_column)
                  .option("lowerBound", str(lower_bound))
                  .option("upperBound", str(upper_bound))
                  .option("numPartitions", str(num_partitions or 1)))
    else:
        reader = reader.option("query", query)
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    return reader.load()
