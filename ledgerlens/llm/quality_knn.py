"""Quality classifier by nearest-neighbour voting in a latent-semantic space.

Terms of a text are its byte trigrams after folding bytes to classes (lower
and upper case letters, digits, white space, each other sign), hashed to
``TERMS`` columns, and a few counted traits (repeated words, repeated
five-word windows, repeated lines). Document frequencies are counted over all
documents. A bounded sample of labelled rows (``LABELLED``, by hash of the id)
gives the term matrix whose leading singular vectors span the latent space.
The labelled latent vectors (at most LABELLED x RANK numbers) are broadcast;
every document's cosine with each of them is computed in blocks, and its
nearest ``NEIGHBOURS`` vote with their similarity as weight.

Labels are learnt only from ids whose CRC-32 is not 0 modulo ``FOLDS``; the
label, language, source and id are never inputs of a score.

Cases: null or empty text, or one without any term, scores 0; without labelled
rows every other text scores 0.5; null labels are not learnt from; repeated rows
are all scored; empty input gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if_small, materialize
from .quality_rules import _lines, _repeated
from .textarrays import Words, chunks

TERMS = 1024
TRAITS = 4
LABELLED = 3000     # bound of the labelled sample
RANK = 48
NEIGHBOURS = 15
SHARPNESS = 4       # votes are weighted with similarity ** SHARPNESS
FOLDS = 5
LIMIT = 0.3
SCORE = "quality_score"
BLOCK = 128

_CLASS = np.arange(256, dtype=np.uint8)
_CLASS[ord("a"):ord("z") + 1] = ord("a")
_CLASS[128:] = ord("a")
_CLASS[ord("A"):ord("Z") + 1] = ord("A")
_CLASS[ord("0"):ord("9") + 1] = ord("0")
_CLASS[[9, 11, 12, 13]] = 32


def _terms(texts: list[bytes]) -> np.ndarray:
    """Log term frequencies, one row per text."""
    w = Words(texts)
    c = _CLASS[w.buf].astype(np.uint32)
    h = (c[:-2] * np.uint32(0x9E3779B1) ^ c[1:-1] * np.uint32(0x85EBCA77) ^ c[2:] * np.uint32(0xC2B2AE3D))
    h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    column = (h >> np.uint32(12)) % TERMS
    doc = np.repeat(np.arange(len(texts)), np.diff(w.at))[:len(column)]
    inside = np.arange(len(column)) < (w.at[1:] - 3)[doc]  # the last byte of a text is the separator
    tf = np.bincount(doc[inside] * TERMS + column[inside], minlength=len(texts) * TERMS).reshape(-1, TERMS)
    again = np.zeros(len(w.hash), bool)
    if len(again) > 1:
        again[1:] = (w.hash[1:] == w.hash[:-1]) & (w.doc[1:] == w.doc[:-1])
    total = np.append(0, np.cumsum(again))
    n = w.counts()
    lines = np.array([_lines(t) for t in texts]).reshape(-1, 2)
    traits = np.stack([total[w.first[1:]] - total[w.first[:-1]], _repeated(w),
                       lines[:, 1] * n / np.maximum(lines[:, 0], 1), np.where(n < 10, 10, 0)], axis=1)
    return np.log1p(np.concatenate([tf, traits], axis=1)).astype(np.float32)


def _blocks(batch: pa.RecordBatch, column: str = "text"):
    for rows, texts in chunks(batch, column):
        for k in range(0, len(texts), BLOCK):
            yield rows.slice(k, BLOCK), _terms(texts[k:k + BLOCK])


def _document_frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    df = np.zeros(TERMS + TRAITS, np.int64)
    for batch in batches:
        for _, x in _blocks(batch):
            df += (x > 0).sum(0)
    yield pa.RecordBatch.from_pydict({"term": pa.array(np.arange(len(df))), "df": pa.array(df)})


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, x in _blocks(batch):
            yield pa.RecordBatch.from_pydict({
                "doc_id": rows.column("doc_id").cast(pa.string()), "label": rows.column("label"), "x": pa.array([r.tobytes() for r in x], pa.binary())})


def _unit(x: np.ndarray) -> np.ndarray:
    size = np.sqrt((x * x).sum(1, keepdims=True))
    return np.divide(x, size, out=np.zeros_like(x), where=size > 0)


def latent_space(x: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """terms x RANK: idf weights times the leading right singular vectors."""
    a = _unit(x * idf).astype(np.float64)
    _, v = np.linalg.eigh(a.T @ a)
    return (idf[:, None] * v[:, ::-1][:, :RANK]).astype(np.float32)


def vote(latent: np.ndarray, known: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Similarity-weighted share of label 1 among each row's nearest."""
    cos = latent @ known.T
    k = min(NEIGHBOURS, cos.shape[1])
    near = np.argpartition(-cos, k - 1, axis=1)[:, :k]
    least = np.take_along_axis(cos, near, 1).min(1, keepdims=True)
    for row in np.flatnonzero((cos >= least).sum(1) > k):  # equally near: those of the smallest ids
        near[row] = np.argsort(-cos[row], kind="stable")[:k]
    weight = np.maximum(np.take_along_axis(cos, near, 1), 0).astype(np.float64) ** SHARPNESS
    total = weight.sum(1)
    return np.divide((weight * labels[near]).sum(1), total, out=np.full(len(total), 0.5), where=total > 0)


def _scorer(space: np.ndarray, known: np.ndarray, labels: np.ndarray, text: str):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, x in _blocks(batch, text):
                out = np.full(len(x), 0.5) if not len(known) else vote(_unit(x @ space), known, labels)
                out[~(x[:, :TERMS] > 0).any(1)] = 0.0
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(out, pa.float64())], [*rows.schema.names, SCORE])

    return score


def held_out(doc_id):
    return F.crc32(doc_id.cast("string")) % FOLDS == 0


def with_scores(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
                label: str = "quality") -> DataFrame:
    """``docs`` with their score in a column ``SCORE`` (replaced if there)."""
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    freq = (texts.select("text").mapInArrow(_document_frequencies, "term long, df long")
            .groupBy("term").agg(F.sum("df").alias("df")).toPandas())  # TERMS + TRAITS rows
    df = np.zeros(TERMS + TRAITS)
    df[freq["term"]] = freq["df"]
    learnt = (labels.select(F.col(doc_id).alias("doc_id"), F.col(label).cast("double").alias("label"))
              .where(F.col("label").isNotNull() & ~held_out(F.col("doc_id")))
              .groupBy("doc_id").agg(F.min("label").alias("label"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(LABELLED))
    learnt = materialize(learnt)
    # at most LABELLED rows, in the order of their ids; of rows sharing an id the smallest text counts
    known_texts = texts.join(broadcast_if_small(learnt), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    sample = (known_texts.mapInArrow(_features, "doc_id string, label double, x binary").toPandas()
              .sort_values("doc_id", kind="stable"))
    n = float(df.max(initial=0))
    idf = (np.log((n + 1) / (df + 1)) + 1).astype(np.float32)
    x = np.frombuffer(b"".join(sample["x"]), np.float32).reshape(-1, TERMS + TRAITS)
    space = latent_space(x, idf)
    known = _unit(x @ space)
    passed = docs.drop(SCORE)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in passed.schema)
    return passed.mapInArrow(
        _scorer(space, known, sample["label"].to_numpy(np.float64), text), f"{fields}, {SCORE} double")


def quality_scores(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
                   label: str = "quality") -> DataFrame:
    """doc_id, held_out, score, predicted per input row."""
    scored = with_scores(docs.select(doc_id, text), labels, doc_id, text, label)
    return scored.select(doc_id, held_out(F.col(doc_id)).alias("held_out"), F.col(SCORE).alias("score"),
                         (F.col(SCORE) >= LIMIT).cast("int").alias("predicted"))
