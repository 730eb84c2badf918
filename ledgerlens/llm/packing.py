"""Best-fit packing of tokenised documents into fixed-length sequences.

Documents become pieces of at most ``capacity`` tokens. Which piece *lengths*
share a sequence is planned on the histogram of lengths (at most ``capacity``
numbers, whatever the corpus holds) by best-two-fit: a bin is filled greedily
with the longest length that fits; if a gap is left, the bin's shortest
document is replaced by the two unpacked lengths that fill the widened gap
most tightly. A pattern is used as often as the histogram allows at once, so
the plan has a few thousand rows. Pieces are then numbered within their
length (salted, so that a length shared by most pieces is many small groups)
and joined to the plan.

Cases: null or empty text is one piece holding only the end id; a text of more
than ``capacity`` tokens is cut, every other piece stays whole; rows that
share a doc_id are packed each on its own; empty input gives an empty result.
"""

from __future__ import annotations

import os
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize
from .textarrays import chunks

END_ID = 0
CACHED_WORDS = 800_000   # words a worker remembers before it forgets
ENCODED_BYTES = 4 << 20  # text encoded at a time
RANKED = 500_000         # pieces of one length numbered in one group, about

_loaded: dict[str, tuple] = {}


class WordEncoder:
    """Ids of whole texts, each distinct word encoded once per worker.

    Exact for the tokenizer of this pattern, which drops white space and lets
    no token or normalisation reach across it: texts are cut at spaces and
    line feeds, a part in Latin-1 is lower-cased and cut by the tokenizer's
    own pattern, and what is left is encoded by the tokenizer. Any other part
    goes to the tokenizer as it is.
    """

    #: Fixed: the split pattern of the tokenizer file.
    PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

    def __init__(self, path: str, cached: int = CACHED_WORDS):
        self.cached = cached
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import regex
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.special = tuple(t.content for t in self.tokenizer.get_added_tokens_decoder().values())
        leads = {x[0] for x in self.special}
        self.lead = leads.pop() if len(leads) == 1 else ""
        self.split = regex.compile(self.PATTERN).findall
        # byte-level alphabet: bytes that are no visible sign get letters from 256 on
        shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
        self.signs = {b: 256 + k for k, b in enumerate(sorted({*range(256)} - shown))}
        # number of each word; its ids are ids[first[number]:first[number + 1]]
        self.number: dict[str, int] = {}
        self.pieces: dict[str, bytes] = {}
        self.ids, self.first = array("I"), array("q", [0])
        self.uses = np.zeros(0, np.int32)

    def _forget(self) -> None:
        """Keep the words that came again, if they are fewer than half."""
        first, ids = np.array(self.first), np.array(self.ids, np.uint32)
        keep = np.flatnonzero(self.uses > 1)
        keep = keep if len(keep) < self.cached // 2 else keep[:0]
        names = list(self.number)
        self.number = {names[k]: i for i, k in enumerate(keep)}
        parts = [ids[first[k]:first[k + 1]] for k in keep]
        self.ids = array("I", b"".join(x.tobytes() for x in parts))
        self.first = array("q", np.cumsum([0] + [len(x) for x in parts]).astype(np.int64).tobytes())
        self.uses = np.zeros(len(keep), np.int32)
        self.pieces = {}

    def _encode(self, parts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(parts, add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in found]

    def _merge(self, pieces: list[str]) -> list[bytes]:
        """Ids of the tokenizer's own pieces: only the merges are left to do."""
        tokenize, signs = self.tokenizer.model.tokenize, self.signs
        plain = (p if p.isascii() and p.isprintable() else p.encode().decode("latin-1").translate(signs) for p in pieces)
        return [array("I", [t.id for t in tokenize(p)]).tobytes() for p in plain]

    def _cut(self, word: str) -> list[str] | None:
        """The tokenizer's own pieces of a plain word (None: not plain)."""
        if not (word.isascii() or max(word) <= "\xff"):
            return None
        if self.lead in word and any(x in word for x in self.special):
            return None
        word = word.lower()
        return [word] if word.isalpha() else self.split(word)

    def _learn(self, words: list[str]) -> None:
        cut = [self._cut(w) if w else [] for w in words]
        whole = [w for w, parts in zip(words, cut, strict=True) if parts is None]
        known = dict(zip(whole, self._encode(whole), strict=True))
        new = list({p for parts in cut if parts for p in parts} - self.pieces.keys())
        self.pieces.update(zip(new, self._merge(new), strict=True))
        piece = self.pieces.__getitem__
        for w, parts in zip(words, cut, strict=True):
            self.ids.frombytes(known[w] if parts is None else b"".join(map(piece, parts)))
            self.number[w] = len(self.first) - 1
            self.first.append(len(self.ids))

    def __call__(self, texts: list[bytes]) -> list[np.ndarray]:
        column = pa.array(texts, pa.large_binary()).cast(pa.large_string())
        parts = pc.split_pattern(pc.replace_substring(column, "\n", " "), " ")
        coded = parts.flatten().dictionary_encode()
        words, at = coded.dictionary.to_pylist(), coded.indices.to_numpy()
        if max(len(self.number), len(self.pieces)) > self.cached:
            self._forget()
        self._learn([w for w in words if w not in self.number])
        which = np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))
        self.uses = np.append(self.uses, np.zeros(len(self.number) - len(self.uses), np.int32))
        self.uses[which] += 1
        first = np.array(self.first)
        start = first[which][at]
        each = first[which + 1][at] - start
        end = np.cumsum(each)
        total = int(end[-1]) if len(end) else 0
        ids = np.array(self.ids, np.uint32)[np.arange(total) + np.repeat(start - (end - each), each)]
        bounds = np.append(0, end)[np.asarray(parts.offsets)]
        return [ids[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


def _encoder(path: str) -> WordEncoder:
    if path not in _loaded:
        _loaded[path] = WordEncoder(path)
    return _loaded[path]


def _cutter(path: str, capacity: int, keep_ids: bool, cached: int, shared: bool):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(path) if shared else WordEncoder(path, cached)
        for batch in batches:
            for rows, texts in chunks(batch, "text", ENCODED_BYTES):
                out: dict[str, list] = {k: [] for k in ("doc_id", "piece", "start", "length", "ids_crc32")}
                kept = []
                for doc, ids in zip(rows.column("doc_id").to_pylist(), encode(texts), strict=True):
                    ids = np.append(ids, np.uint32(END_ID)).astype("<u4")
                    for piece, start in enumerate(range(0, len(ids), capacity)):
                        part = ids[start:start + capacity]
                        for k, v in zip(out, (doc, piece, start, len(part), zlib.crc32(part.tobytes())), strict=True):
                            out[k].append(v)
                        kept.append(part)
                if keep_ids:
                    out["ids"] = pa.array(kept, pa.list_(pa.uint32())).cast(pa.list_(pa.int64()))
                yield pa.RecordBatch.from_pydict(
                    {k: v if k == "ids" else pa.array(v, pa.int32() if k == "piece" else pa.int64())
                     for k, v in out.items()})

    return cut


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = 2048, keep_ids: bool = True,
                 doc_id: str = "doc_id", text: str = "text", cached: int = CACHED_WORDS, shared: bool = True) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 and (if asked) the ids.

    A reused worker keeps its encoder and up to ``CACHED_WORDS`` words for its next
    task; with ``shared`` false every task has its own of ``cached`` words and gives
    it back, which costs time and leaves memory to what runs after it.
    """
    few = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    return few.mapInArrow(_cutter(tokenizer, capacity, keep_ids, cached, shared), schema + ", ids array<long>" * keep_ids)


# -- the plan ---------------------------------------------------------------

def _below(left: np.ndarray) -> np.ndarray:
    """At x the longest length <= x that is left (0: none)."""
    return np.maximum.accumulate(np.where(left > 0, np.arange(len(left)), 0))


def _two(left: np.ndarray, gap: int) -> tuple[int, int]:
    """The two lengths left whose sum is largest within the gap."""
    a = np.flatnonzero(left[:gap] > 0)
    a = a[a > 0]
    if not len(a):
        return 0, 0
    b = _below(left)[gap - a]
    alone = (b == a) & (left[a] < 2)
    fewer = np.maximum.accumulate(np.where(left > 0, np.arange(len(left)), 0))
    b = np.where(alone, fewer[np.maximum(a - 1, 0)], b)
    best = int(np.argmax(np.where(b > 0, a + b, 0)))
    return (int(a[best]), int(b[best])) if b[best] > 0 else (0, 0)


def best_two_fit(counts: dict[int, int], capacity: int) -> list[tuple[list[int], int]]:
    """Patterns (lengths of one bin, number of such bins) that use up counts."""
    left = np.zeros(capacity + 1, np.int64)
    for size, n in counts.items():
        left[size] = n
    plan = []
    while left.any():
        was = left.copy()
        bin_, gap = [], capacity
        while gap and (size := int(_below(left)[gap])):
            take = min(gap // size, int(left[size]))
            bin_ += [size] * take
            left[size] -= take
            gap -= take * size
        if gap:
            least = bin_[-1]
            a, b = _two(left, gap + least)
            if a + b > least:
                bin_[-1:] = sorted((a, b), reverse=True)
                left[least] += 1
        sizes, used = np.unique(bin_, return_counts=True)
        times = int((was[sizes] // used).min())
        was[sizes] -= used * times
        left = was
        plan.append((sorted(bin_, reverse=True), times))
    return plan


def plan_rows(plan: list[tuple[list[int], int]]) -> list[tuple]:
    """(length, first rank, end rank, per bin, first bin, offset) of each run."""
    ranks: dict[int, int] = {}
    rows, bins = [], 0
    for lengths, times in plan:
        offset = 0
        for size in sorted(set(lengths), reverse=True):
            per = lengths.count(size)
            start = ranks.get(size, 0)
            ranks[size] = start + per * times
            rows.append((size, start, ranks[size], per, bins, offset))
            offset += per * size
        bins += times
    return rows


def pack(pieces: DataFrame, capacity: int = 2048) -> DataFrame:
    """``pieces`` (doc_id, piece, length, ...) with sequence_id and offset.

    Pieces that agree in doc_id, piece and ids are interchangeable.
    """
    spark = pieces.sparkSession
    pieces = materialize(pieces)
    sized = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    salts = max(8, -(-max(sized.values(), default=0) // RANKED))
    salted = pieces.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)))
    upto = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = salted.groupBy("length", "_salt").agg(F.count(F.lit(1)).alias("_n")).select(
        "length", "_salt", F.coalesce(F.sum("_n").over(upto), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("length", "_salt").orderBy("doc_id", "piece", "ids_crc32")
    ranked = (salted.withColumn("_rank", F.row_number().over(inside) - 1)
              .join(offsets, ["length", "_salt"]).withColumn("_rank", F.col("_rank") + F.col("_before")))
    runs = spark.createDataFrame(plan_rows(best_two_fit(sized, capacity)),
                                 "length long, _from long, _to long, _per long, _bin long, _offset long")
    at = F.col("_rank") - F.col("_from")
    # the plan: at most a few runs per pattern, bounded by the capacity
    return (ranked.alias("p").join(F.broadcast(runs).alias("r"), "length")
            .where("_rank >= _from AND _rank < _to")
            .withColumn("sequence_id", F.col("_bin") + F.floor(at / F.col("_per")))
            .withColumn("offset", F.col("_offset") + F.pmod(at, F.col("_per")) * F.col("length"))
            .select(*(F.col(f"p.{c}") for c in pieces.columns), "sequence_id", "offset"))
