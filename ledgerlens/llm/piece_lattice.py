"""SentencePiece encoding and decoding by a lattice of pieces.

Texts are cut at spaces into words, each with its meta spaces in front (the
model's dummy prefix and escaped white space). The lattice of a word has an edge
for every substring that is a piece; the pieces stand in a tree of characters, and
the search from a position ends where no piece goes on. A character that is no piece by itself gets an
edge to its byte pieces. The best scores go forward over the edges and the last
piece to each position goes back (Viterbi), in time linear to the word.

``encode_texts`` encodes whole texts where they stand: an Arrow task looks its
words up among those its worker has met (``CACHED`` words of up to ``LONG`` characters) and
builds the lattice of the others, so nothing is shuffled or written. ``word_table``
encodes each distinct word of a corpus once, by the same lattice; ``encode`` joins
such a table to the occurrences: the ``FREQUENT`` most frequent words are
broadcast, the rest join by shuffle.

The path is the one of highest total score under the scores of the model file
(ties: the shorter last piece loses), as in the unigram model of SentencePiece;
a model file that was trained by merges gives its pieces other scores, so its
ids differ from merge-order encoding, but decode to the same text.

Cutting before a run of spaces is exact because no piece has a meta space
behind another character: ``load_pieces`` checks that and raises otherwise.

Cases: null or empty text has no token; a run of spaces belongs to the word
behind it and survives the round trip; a meta space in the text decodes to a
space, as in the library, so such a text does not round-trip; repeated rows are
all returned; empty input gives an empty result. Memory of a task: slices of about
1 MB of text, or one longer text, and the cache.
"""

from __future__ import annotations

import re
import uuid
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructType

from .common import materialize
from .textarrays import chunks

SPACE = "▁"
FREQUENT = 65_536   # words broadcast; the bound of that table
UNKNOWN = -2e9      # score of an edge to byte pieces, below every piece
LONG = 64           # characters; longer words are not remembered
CACHED = 800_000    # words a worker remembers

_RUNS = re.compile(f"{SPACE}+[^{SPACE}]*")


def load_pieces(spark: SparkSession, model: str) -> tuple[DataFrame, DataFrame, int, int]:
    """(piece, id, score) to encode with, (id, bytes) to decode with, the id of
    byte 0 and the longest piece."""
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=model)
    ids = [i for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
    rows = [(sp.id_to_piece(i), i, float(sp.get_score(i))) for i in ids if not sp.is_byte(i)]
    if any(" " in p or SPACE in p.lstrip(SPACE) for p, _, _ in rows):
        raise ValueError("a piece reaches across a space")
    zero = sp.piece_to_id("<0x00>")
    raw = [(i, bytes([i - zero])) if sp.is_byte(i) else (i, sp.id_to_piece(i).encode()) for i in ids]
    return (spark.createDataFrame(rows, "piece string, id int, score double"),
            spark.createDataFrame(raw, "id int, raw binary"), zero, max(len(r[0]) for r in rows))


def words(text):
    """Array of a text's words, each with the meta spaces before it."""
    plain = F.transform(F.split(text, " "), lambda w: F.concat(F.lit(SPACE), w))
    runs = F.split(F.concat(F.lit(SPACE), F.translate(text, " ", SPACE)), f"(?<=[^{SPACE}])(?={SPACE})")
    has_runs = text.contains("  ") | text.startswith(" ") | text.contains(SPACE)
    return F.when(F.length(text) > 0, F.when(has_runs, runs).otherwise(plain))


def _tree(pieces: list[tuple]) -> dict[str, tuple]:
    """The pieces as a tree: character -> (children, id or -1, score)."""
    top: dict = {}
    for piece, i, score in pieces:
        level = top
        for c in piece[:-1]:
            level = level.setdefault(c, [{}, -1, 0.0])[0]
        level.setdefault(piece[-1], [{}, -1, 0.0])[1:] = i, score
    fixed = lambda level: {c: (fixed(below), i, score) for c, (below, i, score) in level.items()}
    return fixed(top)


def _best_path(word: str, top: dict[str, tuple], zero: int, longest: int) -> list[int]:
    """Ids of the path of highest score; of equal ones the last piece is the longer."""
    n = len(word)
    best, back, last = [0.0] + [float("-inf")] * n, [0] * (n + 1), [-1] * (n + 1)
    for start in range(n):
        so_far, level, end = best[start], top, start
        for c in word[start:start + longest]:
            edge = level.get(c)
            if edge is None:
                break
            end += 1
            level, i, score = edge
            if i >= 0:
                score += so_far
                if score > best[end]:
                    best[end], back[end], last[end] = score, start, i
            if not level:
                break
        # byte pieces: below any piece, so they stand only where the character is none
        if so_far + UNKNOWN > best[start + 1]:
            best[start + 1], back[start + 1], last[start + 1] = so_far + UNKNOWN, start, -1
    ids, at = [], n
    while at:
        if last[at] >= 0:
            ids.append(last[at])
        else:
            ids += [zero + b for b in reversed(word[back[at]:at].encode())]
        at = back[at]
    return ids[::-1]


class _Words(dict):
    """(ids as 32-bit integers, decoded) of a word, both words without their first
    meta space, made when it is first asked for."""

    def __init__(self, pieces: list[tuple], letters: dict[int, bytes], zero: int, longest: int):
        self.top, self.letters, self.zero, self.longest = _tree(pieces), letters, zero, longest

    def __missing__(self, word: str) -> tuple[bytes, str]:
        ids = _best_path(SPACE + word, self.top, self.zero, self.longest)
        back = b"".join(map(self.letters.__getitem__, ids)).decode("utf-8", "replace")[1:]
        got = array("i", ids).tobytes(), word if back == word else back
        if len(word) <= LONG:
            if len(self) >= CACHED:
                self.clear()
            self[word] = got
        return got


_held: dict[str, _Words] = {}


def _task_words(token: str, shared: Broadcast, zero: int, longest: int) -> _Words:
    """The words of an encoder; a reused worker keeps those of the last one for its next task."""
    if token not in _held:
        _held.clear()
        _held[token] = _Words(*shared.value, zero, longest)
    return _held[token]


def _encoder(pieces: DataFrame, raw: DataFrame, zero: int, longest: int) -> Callable[[], _Words]:
    """What gives a task its ``_Words``."""
    # the vocabulary is bounded by the model file
    shared = pieces.sparkSession.sparkContext.broadcast((
        [(r.piece, r.id, r.score) for r in pieces.collect()], {r.id: bytes(r.raw) for r in raw.collect()}))
    token, get = uuid.uuid4().hex, _task_words
    return lambda: get(token, shared, zero, longest)


def _id_lists(parts: list[bytes]) -> pa.Array:
    ends = np.zeros(len(parts) + 1, np.int32)
    np.cumsum(np.fromiter(map(len, parts), np.int32, len(parts)) // 4, out=ends[1:])
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(parts), np.int32)))


def _text_words(text: str) -> list[str]:
    """As ``words``, without the first meta space of each."""
    if not text:
        return []
    if "  " in text or text.startswith(" ") or SPACE in text:
        return [w[1:] for w in _RUNS.findall(SPACE + text.replace(" ", SPACE))]
    return text.split(" ")


def encode_texts(docs: DataFrame, pieces: DataFrame, raw: DataFrame, zero: int, longest: int,
                 keys: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """``keys``, ids (an array for each word of the text), decoded (the text they
    decode to) and round_trip (is that the text?), one row per row of ``docs``."""
    make = _encoder(pieces, raw, zero, longest)
    rows = docs.select(*keys, F.col(text).alias("_text"))
    names = [*keys, "ids", "decoded", "round_trip"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = make()
        for batch in batches:
            for part, bodies in chunks(batch, "_text"):
                bodies = [b.decode() for b in bodies]
                each = [[known[w] for w in _text_words(t)] for t in bodies]
                ends = pa.array(np.cumsum([0] + [len(e) for e in each]), pa.int32())
                ids = pa.ListArray.from_arrays(ends, _id_lists([i for e in each for i, _ in e]))
                back = [" ".join([w for _, w in e]).replace(SPACE, " ") for e in each]
                same = [x == t for x, t in zip(back, bodies)]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(k) for k in range(len(keys))), ids, pa.array(back, pa.string()), pa.array(same, pa.bool_())], names)

    schema = StructType(rows.schema.fields[:-1]).add("ids", ArrayType(ArrayType(IntegerType()))).add(
        "decoded", "string").add("round_trip", "boolean")
    return rows.mapInArrow(run, schema)


def text_digests(encoded: DataFrame, keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns of ``digests`` from the rows of ``encode_texts``."""
    places = F.transform("ids", lambda x, at: F.xxhash64(at, x))
    return encoded.select(
        *keys, F.size(F.flatten("ids")).cast("long").alias("n_tokens"),
        F.aggregate(places, F.lit(0).cast("long"), lambda acc, h: acc.bitwiseXOR(h)).alias("ids_digest"), "round_trip")


def encode_words(distinct: DataFrame, pieces: DataFrame, raw: DataFrame, zero: int, longest: int) -> DataFrame:
    """``distinct`` (uid, word, n) with ids (array of int) and decoded."""
    make = _encoder(pieces, raw, zero, longest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = make()
        for batch in batches:
            found = [known[w[1:]] for w in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, _id_lists([i for i, _ in found]), pa.array([SPACE + w for _, w in found], pa.string())],
                ["uid", "word", "n", "ids", "decoded"])

    rows = distinct.select("uid", "word", "n")
    return rows.mapInArrow(run, StructType([*rows.schema.fields]).add("ids", ArrayType(IntegerType())).add("decoded", "string"))


def word_table(docs: DataFrame, pieces: DataFrame, raw: DataFrame, zero: int, longest: int,
               text: str = "text") -> DataFrame:
    """word, uid, n (occurrences), ids and decoded of every distinct word."""
    counted = docs.select(F.explode(words(F.col(text))).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    counted = materialize(counted.withColumn("uid", F.monotonically_increasing_id()))
    return materialize(encode_words(counted, pieces, raw, zero, longest))


def encode(docs: DataFrame, table: DataFrame, keys: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """``keys``, literal (does the text hold a meta space?), at (word number),
    word, ids, decoded: one row per word of each text; a text without words is
    one row with nulls."""
    literal = F.coalesce(F.col(text).contains(SPACE), F.lit(False)).alias("literal")
    each = docs.select(*keys, literal, F.posexplode_outer(words(F.col(text))).alias("at", "word"))
    frequent = materialize(table.orderBy(F.desc("n"), "word").limit(FREQUENT).select("word", "ids", "decoded"))
    met = each.join(F.broadcast(frequent), "word", "left")
    rare = each.join(F.broadcast(frequent.select("word")), "word", "left_anti").where("word IS NOT NULL")
    rest = table.select("word", "ids", "decoded").join(F.broadcast(frequent.select("word")), "word", "left_anti")
    return met.where("word IS NULL OR ids IS NOT NULL").unionByName(rare.join(rest, "word"))


def texts(encoded: DataFrame, keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keys``, ids and the decoded text of each text, from the rows of ``encode``."""
    rows = encoded.groupBy(*keys).agg(F.array_sort(F.collect_list(F.when(
        F.col("word").isNotNull(), F.struct("at", "ids", "decoded")))).alias("w"))
    text = F.replace(F.array_join(F.col("w.decoded"), ""), F.lit(SPACE), F.lit(" "))
    return rows.select(*keys, F.flatten(F.col("w.ids")).alias("ids"), F.substring(text, F.lit(2), F.length(text)).alias("text"))


def digests(encoded: DataFrame, keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Per text: number of tokens, an order-sensitive digest of the ids, and
    whether it decodes to itself (all words do, and no meta space of the text
    becomes a space)."""
    return encoded.groupBy(*keys).agg(
        F.sum(F.coalesce(F.size("ids"), F.lit(0)).cast("long")).alias("n_tokens"),
        F.coalesce(F.bit_xor(F.when(F.col("word").isNotNull(), F.xxhash64("at", "ids"))), F.lit(0).cast("long")).alias("ids_digest"),
        F.coalesce(F.bool_and((F.col("decoded") == F.col("word")) & ~F.col("literal")), F.lit(True)).alias("round_trip"))
