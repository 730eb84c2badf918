"""Table sinks (S5-S10): overwrite, append with key."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import FREED, TENANT, in_passes, passes_of, settings
from .tables import path_exists, read_partitioned


def remove_dup_columns(df: DataFrame) -> DataFrame:
    """Keep the first of several columns sharing a name (case-insensitive)."""
    seen: set[str] = set()
    keep: list[int] = []
    for i, name in enumerate(df.columns):
        if name.lower() not in seen:
            seen.add(name.lower())
            keep.append(i)
    if len(keep) == len(df.columns):
        return df
    tmp = [f"_ll_c{i}" for i in range(len(df.columns))]
    renamed = df.toDF(*tmp)
    return renamed.select(*[F.col(tmp[i]).alias(df.columns[i]) for i in keep])


def name_blank_columns(df: DataFrame, filler: str = "nocolname") -> DataFrame:
    """A blank column name becomes ``nocolname``."""
    return df.toDF(*[filler if not c.strip() else c for c in df.columns])


def drop_null_keys(df: DataFrame, key: str) -> DataFrame:
    """S7."""
    return df.filter(F.col(key).isNotNull())


def parts_to_append(df: DataFrame, target: DataFrame | None, key: str, order: list[str] | None = None,
                    dealt: bool = True) -> Iterator[DataFrame]:
    """``rows_to_append`` in the passes that a large batch is written in (one if not
    ``dealt``). Passes share no key, so what one appends changes nothing for the next."""
    df = drop_null_keys(df, key)
    named = F.struct(TENANT, key).alias("_ll_key")  # null tenants are equal to each other; join and choice share one shuffle
    new = None
    if target is not None:
        span = df.agg(F.min(key).alias("low"), F.max(key).alias("high"), F.collect_set(TENANT).alias("tenants")).first()
        if span["low"] is None:  # an empty batch
            yield df
            return
        held = target.select(TENANT, key).where(F.col(TENANT).isin(span["tenants"]) & F.col(key).between(span["low"], span["high"]))
        keys = df.select(named).distinct()
        new = keys.join(held.select(named), "_ll_key", "left_anti")
        if new.isEmpty():
            yield df.limit(0)
            return
    for part in in_passes(df.withColumn("_ll_key", named), "_ll_key" if dealt else None):
        if new is not None:
            part = part.join(new, "_ll_key", "left_semi")
        if order:
            w = Window.partitionBy("_ll_key").orderBy(*order)
            part = part.withColumn("_ll_rn", F.row_number().over(w)).filter("_ll_rn = 1").drop("_ll_rn")
        else:
            part = part.dropDuplicates(["_ll_key"])
        yield part.drop("_ll_key")


def rows_to_append(df: DataFrame, target: DataFrame | None, key: str,
                   order: list[str] | None = None) -> DataFrame:
    """S6 + S10: insert-ignore on ``(company_id, key)``.

    Null keys are rejected, one row per key is kept (the first in ``order``
    when given), and keys already in the target are skipped. Only the part of the
    target that can hold such keys is read: the batch's tenants and its range of
    keys are literals in the target's scan, so a batch of new keys skips every row
    group by its statistics. The keys alone are compared; whole rows are shuffled
    once, for the choice of one row a key, and not at all if no key is new. ``df``
    is read more than once and must give the same rows each time (a written batch).
    """
    return next(parts_to_append(df, target, key, order, dealt=False))


def write_rows(df: DataFrame, path: str, mode: str, sort_within: list[str] | None = None, key: str | None = None,
               **options: str) -> None:
    """Rows into partition folders of their tenants; with ``key`` a large input goes in passes.
    A pass's shuffle files go when it is written."""
    with settings(df.sparkSession, FREED):
        for part in in_passes(df, key):
            part = part.sortWithinPartitions(*sort_within) if sort_within else part
            part.write.mode(mode).options(compression="zstd", **options).partitionBy(TENANT).parquet(path)
            mode = "append"


def write_overwrite(df: DataFrame, path: str, sort_within: list[str] | None = None,
                    tenants_only: bool = False, key: str | None = None) -> None:
    """Replace the table; tenants without rows in ``df`` are gone.

    ``tenants_only`` replaces the tenants present in ``df`` and leaves the
    others as they are (a refresh of a few tenants). Rows that go in passes (by
    ``key``) are written beside the table and take its place when all are there.
    """
    if tenants_only:
        write_rows(df, path, "overwrite", sort_within, partitionOverwriteMode="dynamic")
    elif key is None or passes_of(df) == 1:
        write_rows(df, path, "overwrite", sort_within, partitionOverwriteMode="static")
    else:
        beside = f"{path}__new_{uuid.uuid4().hex}"
        write_rows(df, beside, "append", sort_within, key)
        fs, Path = _file_system(df.sparkSession, path), df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path
        fs.delete(Path(path), True)
        fs.rename(Path(beside), Path(path))


def _file_system(spark, path: str):
    jvm = spark.sparkContext._jvm
    return jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def tenant_folder(spark, tenant: str) -> str:
    """Name of a tenant's partition folder, as Spark writes it."""
    return spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString(TENANT, tenant)


def tenant_files(spark, path: str) -> dict[str, list[str]]:
    """Data files (name and time of writing) of each partition folder of a table."""
    jvm, fs = spark.sparkContext._jvm, _file_system(spark, path)
    out: dict[str, list[str]] = {}
    root = jvm.org.apache.hadoop.fs.Path(path)
    for folder in fs.listStatus(root) if fs.exists(root) else []:
        if folder.isDirectory() and folder.getPath().getName().startswith(TENANT + "="):
            out[folder.getPath().getName()] = sorted(
                f"{f.getPath().getName()} {f.getModificationTime()}" for f in fs.listStatus(folder.getPath())
                if f.getPath().getName().endswith(".parquet"))
    return out


def write_tenants(df: DataFrame, path: str, tenants: list[str], sort_within: list[str] | None = None,
                  key: str | None = None) -> None:
    """S5 for some tenants: their folders are replaced by what ``df`` holds of
    them (gone if it holds nothing); the files of all others stay untouched.

    Rows are written beside the table first; folders are then exchanged by
    renaming, so a failed job leaves the table as it was.
    """
    spark = df.sparkSession
    Path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    beside = f"{path}__new_{uuid.uuid4().hex}"
    write_rows(df.where(F.col(TENANT).isin(list(tenants))), beside, "append", sort_within, key)
    fs = _file_system(spark, path)
    fs.mkdirs(Path(path))
    for t in tenants:
        folder = tenant_folder(spark, t)
        old, new = Path(f"{path}/{folder}"), Path(f"{beside}/{folder}")
        if fs.exists(old):
            fs.delete(old, True)
        if fs.exists(new):
            fs.rename(new, old)
    fs.delete(Path(beside), True)


def write_append(df: DataFrame, path: str) -> None:
    """S6 write side: append new rows to the tenant partitions."""
    write_rows(df, path, "append")


def append_with_key(df: DataFrame, path: str, key: str, order: list[str] | None = None) -> None:
    """S6 + S7 + S10: append the rows whose ``(company_id, key)`` the table lacks.

    A batch delivered again adds nothing. A large batch goes in passes,
    which share no key; what a broken job left out is added when the batch is delivered again.
    """
    spark = df.sparkSession
    target = read_partitioned(spark, path) if path_exists(spark, path) else None
    for part in parts_to_append(df, target, key, order):
        write_append(part, path)
