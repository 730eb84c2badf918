"""Quality rules judged per host with an empirical beta prior.

``text_counts`` measures each text in tasks (numpy over whole texts).
``host_rules`` counts rule failures by host, shrinks each host's failure rate
with a beta prior whose two parameters are fitted to the hosts by the method
of moments, marks hosts whose shrunk rate exceeds ``HOST_LIMIT``, and joins the
host verdict back: on a marked host a document must also pass the stricter
limits, elsewhere the ordinary ones. A clean document passes both, so a host's
name alone never drops it.

Cases: null or empty text has all counts 0 and fails the base rule; a null
host is a host of its own; one host, or hosts with equal rates, give a prior
as strong as the pooled sample; empty input gives an empty result; repeated
rows are all judged and returned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize
from .textarrays import SHINGLE, Words, chunks

SYMBOLS = b"#*$%&|<>"
HOST_LIMIT = 0.5
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True


def _per_text(flags: np.ndarray, at: np.ndarray) -> np.ndarray:
    total = np.append(0, np.cumsum(flags))
    return total[at[1:]] - total[at[:-1]]


def _repeated(words: Words) -> np.ndarray:
    """Words of each text inside a five-word window that occurs again in it."""
    at, h = words.windows()
    doc = words.doc[at]
    order = np.lexsort((h, doc))
    same = (h[order][1:] == h[order][:-1]) & (doc[order][1:] == doc[order][:-1])
    twice = np.append(same, False) | np.append(False, same) if len(order) else np.zeros(0, bool)
    cover = np.zeros(len(words.hash) + SHINGLE + 1, np.int64)
    hit = at[order[twice]]
    np.add.at(cover, hit, 1)
    np.add.at(cover, hit + SHINGLE, -1)
    return _per_text(np.cumsum(cover)[:len(words.hash)] > 0, words.first)


def _lines(text: bytes) -> tuple[int, int]:
    lines = [x for x in text.split(b"\n") if x.strip(b" \t\n\x0b\x0c\r")]
    return len(lines), len(lines) - len(set(lines))


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, texts in chunks(batch, "_text"):
            w = Words(texts)
            lead = (w.buf & 0xC0) != 0x80
            gap = w.buf <= 0x20
            gap &= (w.buf == 0x20) | ((w.buf >= 9) & (w.buf <= 13))
            lines = [_lines(t) for t in texts]
            got = {"n_words": w.counts(), "word_chars": _per_text(lead & ~gap, w.at),
                   "n_symbols": _per_text(_SYMBOL[w.buf], w.at),
                   "n_dup_lines": np.array([x[1] for x in lines], np.int64),
                   "n_repeat_words": _repeated(w), "n_lines": np.array([x[0] for x in lines], np.int64)}
            kept = {n: rows.column(n) for n in rows.schema.names if n != "_text"}
            yield pa.RecordBatch.from_pydict(
                kept | {k: pa.array(np.asarray(v, np.int64)) for k, v in got.items()})


def text_counts(docs: DataFrame, text: str = "text", keys: tuple[str, ...] = ("doc_id", "source")) -> DataFrame:
    """``keys`` with the six counts of each row's whole text."""
    few = docs.select(*keys, F.col(text).alias("_text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in few.schema if f.name != "_text")
    return few.mapInArrow(_measure, schema + "".join(f", {c} long" for c in COUNTS))


def _fails(factor: int) -> dict:
    """Rule failures; a factor of 2 halves the limits on symbols, lines and repeats."""
    c = F.col
    return {
        "symbols": c("n_symbols") * 10 * factor > c("n_words"),
        "lines": c("n_dup_lines") * 10 * factor > c("n_lines") * 3,
        "repeats": c("n_repeat_words") * 100 * factor > c("n_words") * 20,
        "word_size": (c("word_chars") < c("n_words") * 2) | (c("word_chars") > c("n_words") * 20),
    }


def _any(conditions: dict):
    out = F.lit(False)
    for x in conditions.values():
        out = out | x
    return out


def host_rules(counts: DataFrame, host: str = "source") -> DataFrame:
    """``counts`` with base_failed, host_rejected and kept."""
    base = (F.col("n_words") < 10) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20)
    counts = materialize(counts.withColumn("base_failed", base)
                         .withColumn("_failed", base | _any(_fails(1)))
                         .withColumn("_strict", base | _any(_fails(2))))
    hosts = materialize(counts.groupBy(F.col(host).alias("_host")).agg(
        F.count(F.lit(1)).alias("_n"), F.count_if("_failed").alias("_k")))
    rate = F.col("_k") / F.col("_n")
    fit = hosts.agg(F.avg(rate).alias("m"), F.var_samp(rate).alias("v"), F.sum("_n").alias("n")).first()
    m, v, n = fit["m"] or 0.0, fit["v"] or 0.0, float(fit["n"] or 0)
    strength = max(m * (1 - m) / v - 1, 0.0) if v > 0 else n
    strength = min(strength, n)
    shrunk = (F.col("_k") + F.lit(m * strength)) / (F.col("_n") + F.lit(strength))
    verdicts = hosts.select("_host", (shrunk > HOST_LIMIT).alias("host_rejected"))
    return (counts.join(verdicts, F.col(host).eqNullSafe(F.col("_host")), "left")
            .withColumn("kept", ~F.when(F.col("host_rejected"), F.col("_strict")).otherwise(F.col("_failed")))
            .drop("_host", "_failed", "_strict"))
