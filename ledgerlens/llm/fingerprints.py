"""Document fingerprints from content-defined chunks.

A text's UTF-8 bytes are cut where a gear hash of the last ``WINDOW`` bytes says
so: a place of the strict mask ends a chunk of ``SMALLEST`` to ``NORMAL`` bytes, a
place of the loose mask one of ``NORMAL`` to ``LARGEST`` (normalised chunking: sizes
gather around the normal one); the longest chunk is cut without a mask. As the
hash sees only the bytes before a place, text put in or taken out moves no cut
beyond the next few.

The fingerprint is the set of (40-bit digest, length) of the chunks, as Base64
of six bytes each in ascending order. The likeness of two fingerprints is the
length of the chunks both hold over the length of the shorter one's: 1 where the
smaller set is contained in the other, 0 where they share nothing.

``next_texts`` pairs every document with the one that follows it in descending
id order (the last with the first) by one shuffle of the texts: ids are cut into
ranges at quantiles, a range's first row is also sent to the range before it, and
each range is read in order, one row behind another.

Cases: a null text counts as empty; an empty text has the empty fingerprint, which
is like another empty one (1) and like no other (0); equal texts have equal
fingerprints; a text shorter than a chunk is one chunk. Rows that share an id
follow each other by their text's hash; a null id comes last. A single row
follows itself. An empty table gives an empty result. Only the two named columns
are read. Memory: slices of about 1 MB of text, or one pair of longer texts.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .textarrays import mix

SMALLEST, NORMAL, LARGEST = 8, 24, 128
STRICT, LOOSE = 0b111111, 0b1111     # bits of a place's hash that must be 0
WINDOW = 16
SLICE_BYTES = 1 << 20
RANGES = 4                           # ranges of ids for each shuffle partition

_rng = np.random.Generator(np.random.Philox(20250611))
_GEAR = _rng.integers(0, 1 << 32, 257, dtype=np.uint64).astype(np.uint32)
_GEAR[256] = 0                       # the gap before a text adds nothing to its hashes
_BYTE = _rng.integers(1, 1 << 63, 257, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_POWER = np.multiply.accumulate(np.full(LARGEST + 1, _STEP))


def _gear(buf: np.ndarray) -> np.ndarray:
    """Mixed hash of the ``WINDOW`` values up to each place."""
    h = _GEAR[buf]
    reach = 1
    while reach < WINDOW:  # h over 1, 2, 4, ... values: gear sums shifted one bit a place
        h[reach:] += h[:-reach] << np.uint32(reach)
        reach *= 2
    h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    return (h ^ (h >> np.uint32(13))) >> np.uint32(8)


def _places(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the loose and of the strict mask; a chunk ends behind its last byte."""
    h = _gear(buf)
    loose = np.flatnonzero((h & np.uint32(LOOSE)) == 0) + 1
    return loose, loose[(h[loose - 1] & np.uint32(STRICT)) == 0]


def _after(starts: np.ndarray, strict: np.ndarray, loose: np.ndarray) -> np.ndarray:
    """Where the chunk that begins at each start ends, text ends apart."""
    far = np.iinfo(np.int64).max
    a = np.append(strict, far)[np.searchsorted(strict, starts + SMALLEST)]
    b = np.append(loose, far)[np.searchsorted(loose, starts + NORMAL)]
    return np.where(a < starts + NORMAL, a, np.minimum(b, starts + LARGEST))


def chunk_sets(texts: list[bytes]) -> list[np.ndarray]:
    """Per text the sorted distinct chunks as digest << 8 | length."""
    gap = np.full(WINDOW, 256, np.uint16)
    parts: list[np.ndarray] = []
    begin = np.zeros(len(texts), np.int64)
    at = 0
    for t, text in enumerate(texts):
        parts += [gap, np.frombuffer(text, np.uint8).astype(np.uint16)]
        begin[t] = at + WINDOW
        at += WINDOW + len(text)
    buf = np.concatenate([*parts, gap])
    end = begin + np.array([len(t) for t in texts], np.int64)
    loose, strict = _places(buf)
    # ends of the chunks that begin at every possible place but forced cuts
    known = np.unique(np.concatenate([begin, loose]))
    follow = dict(zip(known.tolist(), _after(known, strict, loose).tolist(), strict=True))
    starts: list[int] = []
    count = []
    for b, e in zip(begin.tolist(), end.tolist(), strict=True):
        before = len(starts)
        while b < e:
            starts.append(b)
            step = follow.get(b)
            if step is None:
                step = follow[b] = int(_after(np.array([b]), strict, loose)[0])
            b = step
        count.append(len(starts) - before)
    first = np.append(0, np.cumsum(count))
    if not starts:
        return [np.zeros(0, np.uint64) for _ in texts]
    s = np.array(starts)
    last = np.zeros(len(s), bool)
    last[first[1:][np.diff(first) > 0] - 1] = True
    stop = np.append(s[1:], 0)
    stop[last] = end[np.diff(first) > 0]
    size = stop - s
    # a chunk's digest: its bytes times powers of the place in the chunk
    total = int(size.sum())
    inside = np.arange(total) - np.repeat(np.cumsum(size) - size, size)
    value = _BYTE[buf[np.repeat(s, size) + inside]] * _POWER[inside]
    digest = mix(np.add.reduceat(value, np.cumsum(size) - size) + size.astype(np.uint64))
    chunk = (digest >> np.uint64(24)) << np.uint64(8) | size.astype(np.uint64)
    out = []
    for a, b in zip(first[:-1], first[1:], strict=True):
        c = np.sort(chunk[a:b])
        out.append(c[np.append(True, c[1:] != c[:-1])] if len(c) else c)
    return out


def to_text(chunks: np.ndarray) -> str:
    """The fingerprint as text: Base64 of six bytes a chunk."""
    raw = chunks.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 2:]
    return base64.b64encode(raw.tobytes()).decode()


def from_text(fingerprint: str) -> np.ndarray:
    raw = np.frombuffer(base64.b64decode(fingerprint), np.uint8).reshape(-1, 6)
    return np.pad(raw, ((0, 0), (2, 0))).reshape(-1).view(">u8").astype(np.uint64)


def weight(chunks: np.ndarray) -> int:
    return int((chunks & np.uint64(255)).sum())


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Length shared over the length of the shorter set; two empty ones are alike."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = a[np.isin(a, b, assume_unique=True)] if len(a) <= len(b) else b[np.isin(b, a, assume_unique=True)]
    return weight(both) / min(weight(a), weight(b))


def _head(text: bytes, points: int) -> bytes:
    """The first ``points`` code points (all, if there are fewer)."""
    if points >= len(text):
        return text
    lead = np.flatnonzero((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)
    return text if points >= len(lead) else text[:lead[points]]


def code_points(text: bytes) -> int:
    return int(np.count_nonzero((np.frombuffer(text, np.uint8) & 0xC0) != 0x80))


def half_replaced(text: bytes, following: bytes) -> bytes:
    """``text`` with the last half of its code points replaced by as many of the
    next document's first (or all of them)."""
    n = code_points(text)
    return _head(text, n - n // 2) + _head(following, n // 2)


# -- plain fingerprints ------------------------------------------------------
def _slices(batch: pa.RecordBatch, columns: list[str]) -> Iterator[tuple[pa.RecordBatch, list[list[bytes]]]]:
    """Slices of a batch of about ``SLICE_BYTES`` of text (or one longer row)."""
    texts = [[x or b"" for x in batch.column(c).cast(pa.large_binary()).to_pylist()] for c in columns]
    start = size = 0
    for k in range(batch.num_rows + 1):
        size += sum(len(t[k]) for t in texts) if k < batch.num_rows else SLICE_BYTES
        if k == batch.num_rows or size > SLICE_BYTES and k > start:
            if k > start:
                yield batch.slice(start, k - start), [t[start:k] for t in texts]
            start, size = k, sum(len(t[k]) for t in texts) if k < batch.num_rows else 0


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, (texts,) in _slices(batch, ["text"]):
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), pa.array([code_points(t) for t in texts], pa.int64()),
                 pa.array([to_text(c) for c in chunk_sets(texts)])], ["doc_id", "n_chars", "fingerprint"])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_chars (code points) and fingerprint per input row."""
    few = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = few.schema["doc_id"].dataType.simpleString()
    return few.mapInArrow(_fingerprints, f"doc_id {kind}, n_chars bigint, fingerprint string").withColumnRenamed("doc_id", doc_id)


# -- each document beside its next one ---------------------------------------
def _range_of(doc_id, cuts: list):
    """How many of the descending ``cuts`` are above the id (null: all), by binary search."""
    steps = [1 << k for k in reversed(range(len(cuts).bit_length()))]
    if not cuts:
        return F.lit(0)
    above = lambda n: F.coalesce(doc_id < F.get(F.lit(cuts), n - 1), F.lit(True))
    return F.aggregate(F.lit(steps), F.lit(0), lambda n, step: F.when(
        (n + step <= len(cuts)) & above(n + step), n + step).otherwise(n))


def in_order(docs: DataFrame, ranges: int) -> DataFrame:
    """Rows (doc_id, tie, text) with ``range`` (of descending ids) and ``ahead``:
    true in the copy of a range's first row that ends the range before it."""
    rows = docs.withColumn("tie", F.xxhash64("text"))
    marks = [k / ranges for k in range(1, ranges)]
    cuts = rows.agg(F.percentile_approx("doc_id", F.array(*map(F.lit, marks)) if marks else F.lit([0.5]), 10_000).alias("c")).first()["c"]
    cuts = sorted({c for c in cuts or []}, reverse=True) if marks else []
    rows = rows.withColumn("range", _range_of(F.col("doc_id"), cuts))
    key = F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", "tie")
    firsts = rows.groupBy("range").agg(F.max(key).alias("top"))  # one row a range
    ring = Window.orderBy("range")                               # over at most ``ranges`` rows
    firsts = firsts.select("range", "top", F.coalesce(
        F.lag("range").over(ring), F.max("range").over(Window.partitionBy())).alias("before"))
    marked = rows.join(F.broadcast(firsts), "range")
    places = F.when(key == F.col("top"), F.array(
        F.struct("range", F.lit(False).alias("ahead")), F.struct(F.col("before").alias("range"), F.lit(True).alias("ahead"))
    )).otherwise(F.array(F.struct("range", F.lit(False).alias("ahead"))))
    sent = marked.select("doc_id", "tie", "text", F.explode(places).alias("p")).select("doc_id", "tie", "text", "p.*")
    return sent.repartition("range").sortWithinPartitions("range", "ahead", F.desc_nulls_last("doc_id"), F.desc("tie"))


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each row with the one behind it in its range; rows ahead only follow."""
    held = None     # (range, doc_id, text, chunks) of the row still without its next one
    for batch in batches:
        for rows, (texts,) in _slices(batch, ["text"]):
            sets = chunk_sets(texts)
            pairs = []
            for r, i, ahead, t, c in zip(rows.column("range").to_pylist(), rows.column("doc_id").to_pylist(),
                                         rows.column("ahead").to_pylist(), texts, sets, strict=True):
                if held and held[0] == r:
                    pairs.append((held, t, c))
                held = None if ahead else (r, i, t, c)
            if not pairs:
                continue
            edited = [half_replaced(h[2], t) for h, t, _ in pairs]
            changed = chunk_sets(edited)
            out = {
                "doc_id": pa.array([h[1] for h, _, _ in pairs], rows.schema.field("doc_id").type),
                "n_chars": pa.array([code_points(h[2]) for h, _, _ in pairs], pa.int64()),
                "edited_sha256": [hashlib.sha256(e).hexdigest() for e in edited],
                "fingerprint": [to_text(h[3]) for h, _, _ in pairs],
                "edited_fingerprint": [to_text(c) for c in changed],
                "near_edited": [likeness(h[3], c) for (h, _, _), c in zip(pairs, changed, strict=True)],
                "near_next": [likeness(h[3], c) for h, _, c in pairs]}
            yield pa.RecordBatch.from_pydict(out)


def next_texts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", ranges: int | None = None) -> DataFrame:
    """Per row: its fingerprint, that of its text with the second half replaced
    from the next document, and the likeness of its own to this and to the next
    document's."""
    spark = docs.sparkSession
    few = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    kind = few.schema["doc_id"].dataType.simpleString()
    placed = in_order(few, ranges or RANGES * int(spark.conf.get("spark.sql.shuffle.partitions")))
    return placed.select("range", "ahead", "doc_id", "text").mapInArrow(
        _compare, f"doc_id {kind}, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
                  "near_edited double, near_next double").withColumnRenamed("doc_id", doc_id)
