"""A corpus pipeline: classify, drop repeated lines, keep one of near copies,
mask personal data, pack. Each stage works on all its predecessor kept.

Null and empty texts pass every stage but the first (an empty text has quality
0); an empty table passes all; columns beyond those of ``documents`` are kept
up to the last stage. ``n_chars`` follows the text.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm import line_dedup, ngram_join, packing, pii, quality_knn
from ledgerlens.llm.common import broadcast_if_small, finished
from ledgerlens.llm.queries import table, tokenizer_file


#: Words a packing task remembers.
PACK_WORDS = 250_000


def _measured(docs: DataFrame, names: list[str]) -> DataFrame:
    sized = docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in names else docs
    return sized.select(*names)


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality classifier: documents scored below the limit go."""
    scored = quality_knn.with_scores(docs, table(spark, sf_dir, "labels"))
    return scored.where(F.col(quality_knn.SCORE) >= quality_knn.LIMIT).select(*docs.columns)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Line dedup: of similar lines the first stays; a document all of whose
    lines were dropped (a copy) goes with them."""
    left = line_dedup.line_dedup(docs).where("n_lines = 0 OR n_dropped < n_lines")
    return _measured(left, docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join: the document with the smallest id of each group stays."""
    copies = finished(lambda: ngram_join.ngram_join(docs).where("doc_id != component_id").select("doc_id").distinct())
    return docs.join(broadcast_if_small(copies), "doc_id", "left_anti").select(*docs.columns)


def mask_private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """PII: spans found become their kind in angle brackets."""
    return _measured(pii.mask(docs), docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Best-fit packing: the place of every piece in a sequence. Tasks give their
    encoder back, so the workers' memory is free for the first stage of a next run."""
    return packing.pack(packing.token_pieces(docs, tokenizer_file("word_bpe_49k.json"), keep_ids=False,
                                             cached=PACK_WORDS, shared=False))


STAGES = [("quality classifier", keep_good), ("line dedup", drop_lines), ("n-gram Jaccard join", drop_copies),
          ("PII", mask_private), ("best-fit packing", pack)]

#: Iterative fits and byte-pair encoding are not SQL; tested in tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again;
    the other tables of a stage go with its end."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = finished(partial(stage, spark, docs, sf_dir))
    return docs
