"""Registered queries of the operators, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (
    fingerprints,
    html_text,
    line_dedup,
    near_vectors,
    ngram_join,
    packing,
    periodic_runs,
    piece_lattice,
    pii,
    quality_knn,
    quality_rules,
    spelling_variants,
    url_filter,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_file(name: str) -> str:
    """Path of a public vocabulary file (installed on every node)."""
    import public_tokenizers
    return public_tokenizers.path(name)


#: Fixed rules of the URL query: (host, path, verdict).
URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
             ("net", "/es/", "block"), ("net", "/fr/", "block")]


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_join(table(spark, sf_dir, "documents"))


def op2_piece_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    known = piece_lattice.load_pieces(spark, tokenizer_file("piece_bpe_32k.model"))
    return piece_lattice.text_digests(piece_lattice.encode_texts(docs, *known))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = quality_rules.text_counts(table(spark, sf_dir, "documents"))
    return quality_rules.host_rules(counts).drop("source")


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.filter_urls(pages, rules).drop("url")


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.html_text(table(spark, sf_dir, "pages"))


def op7_quality_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_knn.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors.near_vectors(table(spark, sf_dir, "embeddings"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return packing.pack(packing.token_pieces(docs, tokenizer_file("word_bpe_49k.json"), keep_ids=False))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digests(pii.pii_spans(table(spark, sf_dir, "documents").select("doc_id", "text")))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return spelling_variants.spelling_variants(spelling_variants.word_counts(docs, spelling_variants.respelled))


def op12_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.next_texts(table(spark, sf_dir, "documents"))


#: Digest columns of the periodic-run query.
RUN_FIELDS = ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return periodic_runs.periodic_runs(docs, fields=RUN_FIELDS, order=periodic_runs.rewritten)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_ngram_join, op2_piece_lattice, op3_quality_rules, op4_url_filter, op5_line_dedup, op6_html_text,
                              op7_quality_knn, op8_near_vectors, op9_packing, op10_pii, op11_spelling_variants, op12_fingerprints,
                              op13_periodic_runs)}
