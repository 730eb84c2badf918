"""Periodic runs of words by block convolution.

A run is a stretch of words with smallest period q, at least ``max(24, 3 * q)``
words long, that no neighbouring word extends. Per text:

1. Dyadic scales: at scale B (8, 16, 32, ...) the text is cut into blocks of B
   words, which look for periods of B to 2B - 1 words (1 to 15 at the first
   scale). Every run of such a period holds a whole aligned block whose copy, one
   period later, lies in the run too, so no run is missed.
2. Only a block each word of which comes again within the longest period of the
   scale can have a copy there; the others are passed over (a necessary
   condition, nothing is lost).
3. For the rest, the sum of squared differences between the block and every
   place of its following window is computed for all places at once:
   sum(a^2) + sum(b^2) - 2 * sum(ab), the last by a number-theoretic transform
   modulo a prime. Words stand as whole numbers small enough that the sums stay
   below the prime, so the arithmetic is exact; zero means no mismatch.
4. Each distance with no mismatch seeds an extension to both sides, word by
   word. A stretch is kept if it is long enough and its period is its smallest.

Blocks are stacked over all texts of a chunk, so transforms run on matrices.
Words are compared by 64-bit hashes of their bytes. Memory: one chunk of about
1 MB of text, or one longer text; transforms take ``CELLS`` numbers at a time.

Cases: a null, empty or blank text has no words and no run; repeated rows are
each answered; runs may overlap; ties of the strongest run: the smallest start,
then period; an empty table gives an empty result. Only the two named columns
are read. A null id is no number, so its text is not rewritten by
``rewritten``.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textarrays import Words, chunks

LEAST, TIMES = 24, 3            # a run has LEAST words and TIMES periods
BASE = 8                        # block of the first scale
PRIME, ROOT = 2013265921, 31    # 15 * 2**27 + 1 and a primitive root
CELLS = 1 << 18
#: Row numbers of a chunk are int64; no word comes again: this far away.
NEVER = np.int64(1) << 60

Run = tuple[int, int, int]      # start, end, period


@lru_cache(maxsize=64)
def _roots(size: int, inverse: bool) -> tuple[np.ndarray, ...]:
    """Powers of the root of unity for each level of a transform."""
    w = pow(ROOT, (PRIME - 1) // size, PRIME)
    if inverse:
        w = pow(w, PRIME - 2, PRIME)
    levels = []
    while size > 1:
        half = size // 2
        powers = np.ones(half, np.uint64)
        done, step = 1, w
        while done < half:  # w^0 .. w^(done - 1), then times w^done
            more = min(done, half - done)
            powers[done:done + more] = powers[:more] * np.uint64(step) % np.uint64(PRIME)
            done, step = done + more, step * step % PRIME
        levels.append(powers)
        size, w = half, w * w % PRIME
    return tuple(levels)


def ntt(x: np.ndarray) -> np.ndarray:
    """Transform of each row (length a power of two), in bit-reversed order."""
    p = np.uint64(PRIME)
    rows, size = x.shape
    x = x.copy()
    for w in _roots(size, False):
        half = len(w)
        v = x.reshape(rows, -1, 2, half)
        a, b = v[:, :, 0], v[:, :, 1]
        total = a + b
        apart = (a + p - b) * w % p
        v[:, :, 0], v[:, :, 1] = total % p, apart
    return x


def intt(x: np.ndarray) -> np.ndarray:
    """Inverse of ``ntt``."""
    p = np.uint64(PRIME)
    rows, size = x.shape
    x = x.copy()
    for w in reversed(_roots(size, True)):
        half = len(w)
        v = x.reshape(rows, -1, 2, half)
        a, b = v[:, :, 0], v[:, :, 1] * w % p
        total, apart = (a + b) % p, (a + p - b) % p
        v[:, :, 0], v[:, :, 1] = total, apart
    return x * np.uint64(pow(size, PRIME - 2, PRIME)) % p


def mismatches(block: np.ndarray, window: np.ndarray) -> np.ndarray:
    """Per row: sums of squared differences between ``block`` and each place of
    the (not shorter) ``window``. Exact while the sums are below ``PRIME``."""
    b, n = block.shape[1], window.shape[1]
    size = 1 << (n - 1).bit_length()
    x = np.zeros((len(block), size), np.uint64)
    y = np.zeros_like(x)
    x[:, :b] = block[:, ::-1]
    y[:, :n] = window
    product = intt(ntt(x) * ntt(y) % np.uint64(PRIME))[:, b - 1:n].astype(np.int64)
    squares = np.cumsum(np.pad(window.astype(np.int64) ** 2, ((0, 0), (1, 0))), axis=1)
    own = (block.astype(np.int64) ** 2).sum(1, keepdims=True)
    return (own + squares[:, b:] - squares[:, :-b] - 2 * product) % PRIME


def _next_same(word: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Distance of each word to its next occurrence in the same text."""
    out = np.full(len(word), NEVER)
    order = np.lexsort((np.arange(len(word)), word, doc))
    same = (word[order[1:]] == word[order[:-1]]) & (doc[order[1:]] == doc[order[:-1]])
    out[order[:-1][same]] = (order[1:] - order[:-1])[same]
    return out


def _reach(same: Callable[[int, int], np.ndarray], most: int) -> int:
    """How many of the next ``most`` places agree, looking at more each time."""
    done, step = 0, 64
    while done < most:
        part = same(done, min(done + step, most))
        bad = np.flatnonzero(~part)
        if len(bad):
            return done + int(bad[0])
        done, step = done + len(part), step * 4
    return most


def _extended(w: np.ndarray, s: int, d: int) -> tuple[int, int]:
    """The longest stretch around s .. s + d whose words d apart agree."""
    left = _reach(lambda a, b: w[s - b:s - a][::-1] == w[s - b + d:s - a + d][::-1], s)
    right = _reach(lambda a, b: w[s + a:s + b] == w[s + a + d:s + b + d], len(w) - d - s)
    return s - left, s + right + d


def _primitive(w: np.ndarray, start: int, end: int, q: int) -> bool:
    """No smaller period: in a stretch of three periods it would divide q."""
    rest, p = q, 2
    while rest > 1:
        if p * p > rest:
            p = rest
        if rest % p == 0:
            part = q // p
            if (w[start:end - part] == w[start + part:end]).all():
                return False
            while rest % p == 0:
                rest //= p
        p += 1
    return True


class _Text:
    """Runs of one text as the scales find them."""

    def __init__(self, words: np.ndarray):
        self.words = words
        self.runs: list[Run] = []
        self.tried: dict[int, tuple[int, int]] = {}   # period: last stretch extended

    def seed(self, s: int, size: int, d: int) -> None:
        done = self.tried.get(d)
        if done and done[0] <= s and s + size + d <= done[1]:
            return
        start, end = _extended(self.words, s, d)
        self.tried[d] = start, end
        if (end - start >= max(LEAST, TIMES * d) and (start, end, d) not in self.runs
                and _primitive(self.words, start, end, d)):
            self.runs.append((start, end, d))


def _seeds(ids: np.ndarray, stop: np.ndarray, starts: np.ndarray, size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, distances) of blocks and the places their copies begin."""
    near, far = (1 if size == BASE else size), 2 * size - 1
    most = int(((PRIME - 1) // size) ** 0.5)  # squared differences of a block sum up to less than PRIME
    step = max(1, CELLS // (4 * size))
    for k in range(0, len(starts), step):
        s, e = starts[k:k + step], stop[k:k + step]
        at = s[:, None] + near + np.arange(far - near + size)
        inside = at < e[:, None]
        window = np.where(inside, ids[np.where(inside, at, 0)] % most, 0).astype(np.uint64)
        block = (ids[s[:, None] + np.arange(size)] % most).astype(np.uint64)
        zero = mismatches(block, window) == 0
        zero &= s[:, None] + near + np.arange(far - near + 1) + size <= e[:, None]
        row, place = np.nonzero(zero)
        yield k + row, place + near


def find_runs(word: np.ndarray, first: np.ndarray) -> list[list[Run]]:
    """Runs of each text, by start then period; text t's words are
    ``word[first[t]:first[t + 1]]``."""
    count = np.diff(first)
    doc = np.repeat(np.arange(len(count)), count)
    gap = _next_same(word, doc)
    ids = np.unique(word, return_inverse=True)[1].astype(np.int64)
    texts: dict[int, _Text] = {}
    size, blocks = BASE, count // BASE
    owner = np.repeat(np.arange(len(count)), blocks)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    worst = gap[(first[owner] + place * BASE)[:, None] + np.arange(BASE)].max(1) if len(owner) else np.zeros(0, np.int64)
    while len(owner):
        may = np.flatnonzero(worst <= 2 * size - 1)
        starts, stop = first[owner[may]] + place[may] * size, first[owner[may] + 1]
        for rows, distances in _seeds(ids, stop, starts, size):
            keep = _not_covered(texts, owner[may][rows], starts[rows], distances, size, first)
            for t, s, d in zip(owner[may][rows[keep]], starts[rows[keep]], distances[keep], strict=True):
                if t not in texts:
                    texts[t] = _Text(ids[first[t]:first[t + 1]])
                texts[t].seed(int(s - first[t]), size, int(d))
        # blocks of the next scale are pairs of these; a text needs three periods of its smallest
        size *= 2
        even = (place % 2 == 0) & (place + 1 < blocks[owner])
        pair = np.flatnonzero(even)
        worst = np.maximum(worst[pair], worst[pair + 1]) if len(pair) else np.zeros(0, np.int64)
        owner, place, blocks = owner[pair], place[pair] // 2, blocks // 2
        long = count[owner] >= TIMES * size
        owner, place, worst = owner[long], place[long], worst[long]
        blocks = np.where(count >= TIMES * size, blocks, 0)
    return [sorted(texts[t].runs, key=lambda r: (r[0], r[2])) if t in texts else [] for t in range(len(count))]


def _not_covered(texts: dict[int, _Text], owner: np.ndarray, s: np.ndarray, d: np.ndarray, size: int,
                 first: np.ndarray) -> np.ndarray:
    """Seeds whose distance is no multiple of the period of a run already found
    around them (such a stretch has the shorter period throughout)."""
    keep = np.ones(len(s), bool)
    cut = np.append(np.flatnonzero(np.diff(owner, prepend=-1)), len(owner))
    for a, b in zip(cut[:-1], cut[1:], strict=True):
        text = texts.get(owner[a])
        if text is None:
            continue
        at = s[a:b] - first[owner[a]]
        for start, end, q in text.runs:
            lo, hi = np.searchsorted(at, [start, end])
            if lo < hi:
                part = slice(a + lo, a + hi)
                keep[part] &= (d[part] % q != 0) | (at[lo:hi] + size + d[part] > end)
    return keep


# -- per text ---------------------------------------------------------------
def rewritten(doc_id: int | None, n: int) -> np.ndarray:
    """Which word of the text stands at each place: every tenth text, by the
    checksum of its id, repeats a stretch of its words up to its end."""
    at = np.arange(n)
    if doc_id is None or not n:
        return at
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return at
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    at[a:] = a + (at[a:] - a) % p
    return at


def as_they_are(doc_id: int | None, n: int) -> np.ndarray:
    return np.arange(n)


def strongest(runs: list[Run]) -> Run | None:
    """The run with the greatest length / period (ties: start, then period)."""
    best = None
    for r in sorted(runs, key=lambda r: (r[0], r[2])):
        if best is None or (r[1] - r[0]) * best[2] > (best[1] - best[0]) * r[2]:
            best = r
    return best


def kept_words(n: int, runs: list[Run]) -> np.ndarray:
    """False for words that repeat an earlier period of a run."""
    edge = np.zeros(n + 1, np.int64)
    for start, end, q in runs:
        edge[start + q] += 1
        edge[end] -= 1
    return np.cumsum(edge)[:n] == 0


_FIELDS = {"n_words": pa.int64(), "runs": pa.list_(pa.list_(pa.int64())), "n_runs": pa.int64(), "start": pa.int64(),
           "length": pa.int64(), "period": pa.int64(), "exponent_milli": pa.int64(), "runs_sha256": pa.string(),
           "collapsed": pa.large_string(), "collapsed_sha256": pa.string()}
_SQL = {"runs": "array<array<bigint>>", "runs_sha256": "string", "collapsed": "string", "collapsed_sha256": "string"}


def _answers(fields: tuple[str, ...], order: Callable[[int | None, int], np.ndarray]):
    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in chunks(batch, "text"):
                ids = rows.column("doc_id")
                w = Words(texts)
                count = w.counts()
                place = [w.first[t] + order(i, int(count[t])) for t, i in enumerate(ids.to_pylist())]
                place = np.concatenate([*place, np.zeros(0, np.int64)]).astype(np.int64)
                found = find_runs(w.hash[place], w.first)
                out: dict[str, list] = {f: [] for f in _FIELDS}
                raw = w.buf.tobytes()
                for t, runs in enumerate(found):
                    best = strongest(runs)
                    out["n_words"].append(int(count[t]))
                    out["runs"].append([[s, e - s, q] for s, e, q in runs])
                    out["n_runs"].append(len(runs))
                    out["start"].append(best and best[0])
                    out["length"].append(best and best[1] - best[0])
                    out["period"].append(best and best[2])
                    out["exponent_milli"].append(best and 1000 * (best[1] - best[0]) // best[2])
                    listed = "".join(f"{s},{e - s},{q}\n" for s, e, q in runs)
                    out["runs_sha256"].append(hashlib.sha256(listed.encode()).hexdigest())
                    mine = place[w.first[t]:w.first[t + 1]]
                    if not runs and (np.diff(mine) == 1).all():
                        text = b" ".join(texts[t].split())
                    else:
                        mine = mine[kept_words(len(mine), runs)]
                        text = b" ".join(raw[a:b] for a, b in zip(w.start[mine].tolist(), w.end[mine].tolist(), strict=True))
                    out["collapsed"].append(text if "collapsed" in fields else None)
                    out["collapsed_sha256"].append(hashlib.sha256(text).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [ids, *(pa.array(out[f], pa.large_binary()).cast(pa.large_string()) if f == "collapsed"
                            else pa.array(out[f], _FIELDS[f]) for f in fields)], ["doc_id", *fields])

    return answer


def periodic_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                  fields: tuple[str, ...] = tuple(_FIELDS),
                  order: Callable[[int | None, int], np.ndarray] = as_they_are) -> DataFrame:
    """doc_id and ``fields`` per input row: runs (start, length, period by start,
    then period), the strongest one, and the text without the repeated periods
    (a word goes if any run holds it after that run's first period).

    ``order(doc_id, n)`` says which word stands at each of the n places.
    """
    few = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = few.schema["doc_id"].dataType.simpleString()
    schema = ", ".join([f"doc_id {kind}", *(f"{f} {_SQL.get(f, 'bigint')}" for f in fields)])
    return few.mapInArrow(_answers(fields, order), schema).withColumnRenamed("doc_id", doc_id)
