"""Words that differ by one letter, found in a trie of letter counts.

A word's vector holds how often each letter group occurs in it (the letters a to z,
then the other letters in ``POOLED`` groups). Words arranged by successive counts
form a trie. A word one inserted, deleted or replaced letter away has at most one
letter too many and one too few, so a depth-first search that spends a surplus
and a deficit budget of one each reaches all of them; the words at the leaves
reached are verified letter by letter. Of a pair only the word whose first
deviating count is the smaller searches, so each pair is met once.

The trie is shared out in Spark: nodes holding more than a limit of words are split
level by level (only their sizes go to the driver; at most ``TOP`` nodes of a level
are that large), every word is sent to the subtrees its budgets can reach, and each
subtree is searched in one task. Words with the very same vector that exceed the
limit are dealt over blocks, which every word reaching them visits. What comes out
is reduced to one row a word and subtree before it is shuffled.

The form of a word is its near word of most occurrences (ties: the smallest in
code-point order) if it has ``TIMES`` times as many; roots follow forms by pointer
doubling, which ends as counts grow along every form.

Cases: null, empty or wordless texts give no word; a null id counts as empty text in
the checksum that spells some words differently; repeated rows count each time; very
long words are compared whole; counts above ``MOST`` stand as ``MOST`` in vectors, which
only widens the search; an empty table gives an empty result. Only the two named
columns are read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if_small, materialize

SHORTEST, RAREST, TIMES = 6, 5, 5
HELD = 200_000               # distinct words counted before they are sent on
NODE_WORDS, TOP = 16_384, 4096
POOLED, MOST = 6, 200
PAIRS = 1 << 18              # verified at a time
LEAF = 1 << 13               # words times searchers compared at once
WIDTH = 48                   # longer words are verified one by one
#: Order of the levels: frequent letters first.
LETTERS = "eaitnrsoulcdmphgbvfqywkzxj"
LEVELS = len(LETTERS) + POOLED

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_LEVEL = np.array([LETTERS.index(chr(b)) if chr(b) in LETTERS else len(LETTERS) + b % POOLED for b in range(256)])
_RUN = re.compile("[a-zÀ-ÿ]{%d,}" % SHORTEST)


# -- words --------------------------------------------------------------------
def as_they_are(prefix: int, word: str) -> str:
    return word


def respelled(prefix: int, word: str) -> str:
    """Every 199th (document, word), by checksum, loses one letter."""
    h = zlib.crc32(word.encode(), prefix)
    if h % 199:
        return word
    k = h % len(word)
    return word[:k] + word[k + 1:]


def _counter(spell: Callable[[int, str], str]):
    def flush(total: dict[str, int]) -> pa.RecordBatch:
        words = [w for w in total if len(w) >= SHORTEST]
        return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array([total[w] for w in words], pa.int64())], ["word", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, int] = {}
        for batch in batches:
            for i, text in zip(batch.column("doc_id"), batch.column("text"), strict=True):
                if not text.is_valid:
                    continue
                i = i.as_py()
                prefix = zlib.crc32(f"{'' if i is None else i}:".encode())
                runs = _RUN.findall(text.as_py().encode().translate(_LOWER).decode())
                for word, n in Counter(runs).items():
                    word = spell(prefix, word)
                    total[word] = total.get(word, 0) + n
                if len(total) > HELD:
                    yield flush(total)
                    total = {}
        yield flush(total)

    return count


def word_counts(docs: DataFrame, spell: Callable[[int, str], str] = as_they_are,
                doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """word and n (occurrences) of every word long and frequent enough."""
    few = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return (few.mapInArrow(_counter(spell), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
            .where(F.col("n") >= RAREST))


# -- vectors ------------------------------------------------------------------
def vectors(words: list[str]) -> np.ndarray:
    """Letter-group counts of the words (all letters are Latin-1)."""
    raw = [w.encode("latin-1") for w in words]
    owner = np.repeat(np.arange(len(raw)), [len(r) for r in raw])
    level = _LEVEL[np.frombuffer(b"".join(raw), np.uint8)]
    counts = np.bincount(owner * LEVELS + level, minlength=len(raw) * LEVELS).reshape(-1, LEVELS)
    return np.minimum(counts, MOST).astype(np.uint8)


def _paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each word with its vector as text, one character a level."""
    for batch in batches:
        v = vectors(batch.column("word").to_pylist()) + np.uint8(48)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array([r.tobytes().decode("latin-1") for r in v], pa.string())], [*batch.schema.names, "path"])


def _top(words: DataFrame, limit: int) -> dict[str, int]:
    """Size of every node that lies under nodes of more than ``limit`` words."""
    top = {"": words.count()}
    wide, depth = [""] if top[""] > limit else [], 0
    while wide and depth < LEVELS:
        depth += 1
        inside = words.where(F.substring("path", 1, depth - 1).isin(wide)) if depth > 1 else words
        sizes = {r["node"]: r["n"] for r in inside.groupBy(F.substring("path", 1, depth).alias("node"))
                 .agg(F.count(F.lit(1)).alias("n")).collect()}
        top |= sizes
        wide = [node for node, n in sizes.items() if n > limit]
    return top


def _sender(top: dict[str, int], limit: int):
    """Each word to the subtree it lives in and to those its budgets can reach."""
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {"node": [], "block": [], "home": [], "word": [], "n": []}
            for word, n, path in zip(*(batch.column(c).to_pylist() for c in ("word", "n", "path")), strict=True):
                stack = [("", 0, 0)]
                while stack:
                    node, surplus, deficit = stack.pop()
                    depth = len(node)
                    if top[node] > limit and depth < LEVELS:
                        here = path[depth]
                        steps = [(here, surplus, deficit)]
                        if not surplus:
                            steps.append((chr(ord(here) + 1), 1, deficit))
                        elif not deficit:
                            steps.append((chr(ord(here) - 1), surplus, 1))
                        stack += [(node + c, s, d) for c, s, d in steps if node + c in top]
                        continue
                    blocks = -(-top[node] // limit)
                    lives = zlib.crc32(word.encode()) % blocks if path.startswith(node) else -1
                    for block in range(blocks):
                        for k, v in zip(out, (node, block, block == lives, word, n), strict=True):
                            out[k].append(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out["node"], pa.string()), pa.array(out["block"], pa.int32()), pa.array(out["home"], pa.bool_()),
                 pa.array(out["word"], pa.string()), pa.array(out["n"], pa.int64())], list(out))

    return send


# -- search in one subtree ----------------------------------------------------
def _candidates(trie: np.ndarray, vec: np.ndarray, rank: np.ndarray, home_rank: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows of the sorted ``trie``, searchers) whose counts are within the budgets;
    a searcher meets only words ranked behind it. Depth first; searchers at a node go
    down together, and small nodes are compared whole."""
    none = np.zeros(len(vec), np.int8)
    stack = [(0, len(trie), 0, np.arange(len(vec)), none, none)]
    while stack:
        lo, hi, level, who, surplus, deficit = stack.pop()
        if (hi - lo) * len(who) <= LEAF or level == LEVELS:
            step = max(1, LEAF // (hi - lo))
            for k in range(0, len(who), step):
                part = who[k:k + step]
                d = trie[lo:hi, None, level:].astype(np.int16) - vec[None, part, level:]
                more = np.maximum(d, 0).sum(2) + surplus[None, k:k + step]
                less = np.maximum(-d, 0).sum(2) + deficit[None, k:k + step]
                row, at = np.nonzero((more <= 1) & (less <= 1) & (home_rank[lo:hi, None] > rank[None, part]))
                if len(row):
                    yield row + lo, part[at]
            continue
        values, begin = np.unique(trie[lo:hi, level], return_index=True)
        own = vec[who, level].astype(np.int16)
        for v, a, b in zip(values.tolist(), begin, [*begin[1:], hi - lo], strict=True):
            apart = v - own
            may = np.flatnonzero((apart == 0) | (apart == 1) & (surplus == 0) | (apart == -1) & (surplus == 1) & (deficit == 0))
            if len(may):
                stack.append((lo + int(a), lo + int(b), level + 1, who[may],
                              surplus[may] + (apart[may] == 1), deficit[may] + (apart[may] == -1)))


def one_edit(a: bytes, b: bytes) -> bool:
    """Exactly one letter inserted, deleted or replaced."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    n = min(len(a), len(b))
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    front = np.append(np.flatnonzero(x[:n] != y[:n]), n)[0]
    back = np.append(np.flatnonzero(x[::-1][:n] != y[::-1][:n]), n)[0]
    return bool(front + back >= max(len(a), len(b)) - 1)


class _Letters:
    """Words as padded rows from the left and from the right."""

    def __init__(self, raw: list[bytes]):
        self.raw = raw
        self.size = np.array([len(r) for r in raw])
        cut = [r[:WIDTH] for r in raw]
        self.left = np.frombuffer(b"".join(r.ljust(WIDTH, b"\0") for r in cut), np.uint8).reshape(-1, WIDTH)
        self.right = np.frombuffer(b"".join(r[::-1].ljust(WIDTH, b"\0") for r in cut), np.uint8).reshape(-1, WIDTH)

    def near(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        n, short = np.maximum(self.size[a], self.size[b]), np.minimum(self.size[a], self.size[b])
        ends = []
        for side in (self.left, self.right):
            apart = side[a] != side[b]
            ends.append(np.minimum(np.where(apart.any(1), apart.argmax(1), WIDTH), short))
        out = (n - short <= 1) & (ends[0] + ends[1] >= n - 1)
        for k in np.flatnonzero(n > WIDTH):
            out[k] = one_edit(self.raw[a[k]], self.raw[b[k]])
        return out


def near_pairs(words: list[str], home: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i, j) of near words, j at home: each found from one side only."""
    vec = vectors(words)
    letters = _Letters([w.encode("latin-1") for w in words])
    text = np.array(sorted(range(len(words)), key=words.__getitem__))
    order = text[np.lexsort(vec[text].T[::-1])]      # by vector, then by word
    rank = np.empty(len(words), np.int64)
    rank[order] = np.arange(len(words))
    lives = order[home[order]]
    left, right, held, done = [], [], 0, []
    for row, who in _candidates(vec[lives], vec, rank, rank[lives]):
        left.append(who)
        right.append(lives[row])
        held += len(row)
        if held > PAIRS:
            a, b = np.concatenate(left), np.concatenate(right)
            ok = letters.near(a, b)
            done.append((a[ok], b[ok]))
            left, right, held = [], [], 0
    a, b = np.concatenate([*left, np.zeros(0, np.int64)]).astype(int), np.concatenate([*right, np.zeros(0, np.int64)]).astype(int)
    ok = letters.near(a, b) if len(a) else np.zeros(0, bool)
    done.append((a[ok], b[ok]))
    return np.concatenate([x for x, _ in done]), np.concatenate([y for _, y in done])


def _search(group: pa.Table) -> pa.Table:
    """Per word of a subtree and its visitors: near words found here, and the best."""
    words, n = group.column("word").to_pylist(), group.column("n").to_numpy()
    a, b = near_pairs(words, group.column("home").to_numpy(zero_copy_only=False).astype(bool))
    x, y = np.concatenate([a, b]), np.concatenate([b, a])
    place = np.empty(len(words), np.int64)
    place[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
    order = np.lexsort((place[y], -n[y], x))
    x, y = x[order], y[order]
    first = np.flatnonzero(np.diff(x, prepend=-1))
    count = np.diff(np.append(first, len(x)))
    return pa.table({"word": pa.array([words[k] for k in x[first]], pa.string()), "near": pa.array(count, pa.int64()),
                     "best_n": pa.array(n[y[first]], pa.int64()), "best": pa.array([words[k] for k in y[first]], pa.string())})


# -- forms and roots ----------------------------------------------------------
def _roots(forms: DataFrame) -> DataFrame:
    """word and root of every word with a form: each round a pointer leads on as
    far again as it already does."""
    at = materialize(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = at.select(F.col("word").alias("root"), F.col("root").alias("on"))
        step = materialize(at.join(ahead, "root", "left").select("word", F.coalesce("on", "root").alias("root"),
                                                                F.col("on").isNotNull().alias("moved")))
        at = step.select("word", "root")
        if step.where("moved").isEmpty():
            return at


def spelling_variants(counted: DataFrame, node_words: int | None = None) -> DataFrame:
    """word, n, n_near, form, form_n and root of each row (word, n) of ``counted``.

    Words hold only Latin-1 letters and occur once each.
    """
    words = materialize(counted.select("word", "n").mapInArrow(_paths, "word string, n long, path string"))
    limit = node_words or max(NODE_WORDS, words.count() // TOP)
    sent = words.mapInArrow(_sender(_top(words, limit), limit), "node string, block int, home boolean, word string, n long")
    met = (sent.groupBy("node", "block").applyInArrow(_search, "word string, near long, best_n long, best string")
           .groupBy("word").agg(F.sum("near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("less"), "best")).alias("b")))
    close = F.col("b.less") <= -TIMES * F.col("n")
    out = materialize(words.select("word", "n").join(met, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(close, F.col("b.best")).alias("form"),
        F.when(close, -F.col("b.less")).alias("form_n")))
    roots = _roots(out.where("form IS NOT NULL"))
    return out.join(broadcast_if_small(roots), "word", "left").withColumn("root", F.coalesce("root", "word"))
