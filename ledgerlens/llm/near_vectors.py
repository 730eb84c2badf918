"""Embedding near-dedup by random-hyperplane sign hashing.

Each vector gets one signature per table: the signs of its products with
``bits`` fixed random hyperplanes. Vectors that agree on a whole signature in
some table meet, their cosine is computed exactly (float64 matrix products),
and pairs at or above the threshold are links. The number of tables follows
from ``bits`` so that a pair exactly at the threshold meets with probability
``RECALL`` at every input size; bits grow with the logarithm of the input, so
buckets keep their size.

Identical vectors are one class (counted, not paired). A bucket over ``BLOCK``
vectors is split into blocks and worked off in block pairs, so no group grows
with the data. A pair is counted only in the first table where it meets, so
``n_links`` is a count of distinct vectors; only labels of the components
inside a block leave the task, never the pairs.

Cases: null, empty, zero or non-finite vectors (or ones with null elements)
link with nothing and are kept; vectors of different lengths never link;
repeated rows are vectors of their own; empty input gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import connected_components, materialize

RECALL = 0.995
BLOCK = 1024
TARGET_BUCKET = 32
SEED = 8121


def hashing(n: int, threshold: float) -> tuple[int, int]:
    """(bits, tables) for n distinct vectors."""
    bits = max(4, math.ceil(math.log2(max(n, 1) / TARGET_BUCKET + 1)))
    agree = 1 - math.acos(threshold) / math.pi
    return bits, max(1, math.ceil(math.log(1 - RECALL) / math.log(1 - agree**bits)))


def _planes(dim: int, bits: int, tables: int) -> np.ndarray:
    return np.random.Generator(np.random.Philox(SEED + dim)).standard_normal((dim, bits * tables))


def _unit(flat: np.ndarray, dim: int) -> np.ndarray:
    x = np.asarray(flat, np.float64).reshape(-1, dim)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _signer(bits: int, tables: int):
    weights = 1 << np.arange(bits, dtype=np.int64)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        for batch in batches:
            rows = batch.column("vec")
            dims = np.asarray(rows.value_lengths())
            for dim in np.unique(dims):
                part = batch.filter(pa.array(dims == dim))
                x = _unit(part.column("vec").flatten().to_numpy(zero_copy_only=False), dim)
                if dim not in planes:
                    planes[dim] = _planes(int(dim), bits, tables)
                sig = ((x @ planes[dim] > 0).reshape(len(x), tables, bits) * weights).sum(2)
                yield pa.RecordBatch.from_pydict({
                    "cid": part.column("cid"), "mult": part.column("mult"), "dim": pa.array(np.full(len(x), dim, np.int32)),
                    "sigs": pa.FixedSizeListArray.from_arrays(pa.array(sig.ravel()), tables).cast(pa.list_(pa.int64())),
                    "vec": pa.array([r.tobytes() for r in x], pa.binary())})

    return sign


def _labels(adj: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Smallest id reachable inside the block."""
    lab = ids.copy()
    while True:
        new = np.minimum(lab, np.where(adj, lab[None, :], np.iinfo(np.int64).max).min(1, initial=np.iinfo(np.int64).max))
        if (new == lab).all():
            return lab
        lab = new


def _linker(threshold: float):
    def link(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        t, i, j = key[0].as_py(), key[3].as_py(), key[4].as_py()
        ids = table.column("cid").to_numpy()
        x = np.frombuffer(b"".join(table.column("vec").to_pylist()), np.float64).reshape(len(ids), -1)
        sigs = np.array(table.column("sigs").to_pylist())
        block, mult = table.column("block").to_numpy(), table.column("mult").to_numpy()
        adj = x @ x.T >= threshold
        np.fill_diagonal(adj, False)
        if i != j:
            adj &= block[:, None] != block[None, :]
        for earlier in range(t):
            s = sigs[:, earlier]
            adj &= s[:, None] != s[None, :]
        n = adj @ mult
        has = n > 0
        lab = _labels(adj[np.ix_(has, has)], ids[has])
        return pa.table({"cid": ids[has], "n": n[has].astype(np.int64), "label": lab})

    return link


def near_vectors(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding",
                 threshold: float = 0.9) -> DataFrame:
    """vec_id, n_links, component_id, kept per input row."""
    x = vectors.select(F.col(vec_id).alias("id"), F.col(embedding).alias("vec"))
    inf = F.lit(float("inf"))
    good = (F.forall("vec", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < inf))
            & F.exists("vec", lambda e: e != 0))
    x = materialize(x.withColumn("ok", F.coalesce(good, F.lit(False)))
                    .withColumns({"k1": F.xxhash64("vec"), "k2": F.xxhash64(F.lit(7), "vec")}))
    classes = materialize(x.where("ok").groupBy("k1", "k2").agg(
        F.min("id").alias("cid"), F.count(F.lit(1)).alias("mult"), F.any_value("vec").alias("vec")))
    bits, tables = hashing(classes.count(), threshold)
    signed = materialize(classes.select("cid", "mult", "vec").mapInArrow(
        _signer(bits, tables), "cid long, mult long, dim int, sigs array<long>, vec binary"))
    met = signed.select("*", F.posexplode("sigs").alias("tab", "sig"))
    buckets = met.groupBy("tab", "dim", "sig").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    buckets = buckets.withColumn("blocks", F.ceil(F.col("size") / BLOCK))
    placed = met.join(buckets, ["tab", "dim", "sig"]).withColumn(
        "block", F.pmod(F.xxhash64("cid"), F.col("blocks")))
    pairs = placed.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("_o"))
    pairs = pairs.select("tab", "dim", "sig", F.least("block", "_o").alias("i"), F.greatest("block", "_o").alias("j"),
                         "block", "cid", "mult", "sigs", "vec")
    found = materialize(pairs.groupBy("tab", "dim", "sig", "i", "j").applyInArrow(
        _linker(threshold), "cid long, n long, label long"))
    links = found.groupBy("cid").agg(F.sum("n").alias("n"))
    comp = connected_components(found, "cid", "label")
    known = (classes.select("k1", "k2", "cid", "mult").join(links, "cid", "left")
             .join(comp.withColumnRenamed("node", "cid"), "cid", "left")
             .select("k1", "k2", F.lit(True).alias("ok"),
                     (F.coalesce("n", F.lit(0)) + F.col("mult") - 1).alias("n_links"),
                     F.coalesce("component", "cid").alias("component_id")))
    return (x.select("id", "k1", "k2", "ok").join(known, ["k1", "k2", "ok"], "left")
            .select(F.col("id").alias(vec_id), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
                    F.coalesce("component_id", "id").alias("component_id"))
            .withColumn("kept", F.col(vec_id) == F.col("component_id")))
