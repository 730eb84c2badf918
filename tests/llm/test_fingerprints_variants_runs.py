"""Spelling variants, document fingerprints and periodic runs against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from ledgerlens.llm import fingerprints as G
from ledgerlens.llm import oracle
from ledgerlens.llm import periodic_runs as P
from ledgerlens.llm import spelling_variants as V
from ledgerlens.llm.queries import op11_spelling_variants, op12_fingerprints, op13_periodic_runs
from ledgerlens.llm.textarrays import mix

ODD = [None, "", " \n ", "one", "a b\tc", "x" * 50_000, "w " * 5_000, "日本語 テキスト\r\n日本語", "\x0b\x0cq\x1cq\x85q\xa0q",
       "café café ÉCOLE école×÷", "rotor rotors " * 40]
SF = "/root/testdata/sf0.001"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "other", len(t or "")) for i, t in rows], "doc_id long, text string, word string, start int")


# -- spelling variants ---------------------------------------------------------
def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def variants_brute(rows, respell):
    n = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if respell and h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    n = {w: c for w, c in n.items() if len(w) >= 6 and c >= 5}
    near = {w: [v for v in n if v != w and one_edit(v, w)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= 5 * n[w] else None
    out = {}
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (n[w], len(near[w]), form[w], n[form[w]] if form[w] else None, root)
    return out


def as_variants(df):
    rows = df.collect()
    assert len({r.word for r in rows}) == len(rows)
    return {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in rows}


@pytest.mark.parametrize("node_words", [None, 7])
def test_variants(spark, node_words, monkeypatch):
    rnd = random.Random(11)
    words = list({"".join(rnd.choice("abcéÿ×") for _ in range(rnd.choice([5, 6, 7]))) for _ in range(250)})
    words += ["z" * 60, "z" * 61, "z" * 30 + "y" + "z" * 29, "abcdef", "abcdfe", "abcde"]
    rows = list(enumerate(ODD)) + [(None, "Abcdef ABCDEF")] * 4
    rows.append((900, "chainone " * 150 + "chainones " * 30 + "chainoness " * 6))
    for i in range(120):
        rows.append((1000 + i // 2, " ".join(w for w in rnd.choices(words, [1 / (k + 1) for k in range(len(words))], k=60))))
    monkeypatch.setattr(V, "HELD", 50)
    docs = frame(spark, rows)
    assert as_variants(V.spelling_variants(V.word_counts(docs), node_words)) == variants_brute(rows, False)
    exp = variants_brute(rows, True)
    assert as_variants(V.spelling_variants(V.word_counts(docs, V.respelled), node_words)) == exp
    assert any(v[4] != (v[2] or k) for k, v in exp.items())      # some root is more than one form away


def test_variants_of_one_letter_vector(spark):
    """More words of one vector than a node may hold are dealt over blocks."""
    words = list({"".join(p) for p in (random.Random(k).sample("abcdef", 6) for k in range(200))})
    counted = spark.createDataFrame([(w, 5) for w in words] + [(w + "x", 30) for w in words[:50]], "word string, n long")
    got = as_variants(V.spelling_variants(counted, 16))
    for w in words:
        near = [v for v in words if one_edit(v, w)] + [v + "x" for v in words[:50] if one_edit(v + "x", w)]
        assert got[w][:2] == (5, len(near)) and got[w][2] == (w + "x" if w in words[:50] else got[w][2])
    assert V.spelling_variants(counted.limit(0)).count() == 0
    assert V.spelling_variants(counted.limit(1)).first().root is not None


def test_variants_query_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    sql = con.execute(oracle.OP11)
    names = [c[0] for c in sql.description]
    want = sorted(tuple(r) for r in sql.fetchall())
    got = sorted(tuple(r[c] for c in names) for r in op11_spelling_variants(spark, SF).collect())
    assert got == want and got


# -- fingerprints ------------------------------------------------------------------
def chunks_brute(text):
    low = (1 << 32) - 1
    cut = []
    for i in range(len(text)):
        v = sum(int(G._GEAR[text[i - k]]) << k for k in range(G.WINDOW) if i >= k) & low
        v = ((v ^ (v >> 15)) * 0x2C1B3C6D) & low
        cut.append((v ^ (v >> 13)) >> 8)
    out, s = set(), 0
    while s < len(text):
        e = s + 1
        while e < len(text) and e - s < G.LARGEST:
            n = e - s
            if n >= G.SMALLEST and cut[e - 1] & (G.STRICT if n < G.NORMAL else G.LOOSE) == 0:
                break
            e += 1
        value, power = 0, 1
        for b in text[s:e]:
            power = power * int(G._STEP) % (1 << 64)
            value = (value + int(G._BYTE[b]) * power) % (1 << 64)
        digest = int(mix(np.array([(value + e - s) % (1 << 64)], np.uint64))[0])
        out.add((digest >> 24 << 8) | (e - s))
        s = e
    return sorted(out)


def test_chunks_against_one_by_one():
    rnd = random.Random(4)
    for _ in range(40):
        texts = [bytes(rnd.choice(rnd.choice([b"ab cde", b"a", bytes(range(256))])) for _ in range(rnd.choice([0, 1, 7, 8, 9, 40, 300, 900])))
                 for _ in range(rnd.randrange(1, 6))]
        sets = G.chunk_sets(texts)
        assert [s.tolist() for s in sets] == [chunks_brute(t) for t in texts]
        assert all((G.from_text(G.to_text(s)) == s).all() for s in sets)


def test_cuts_resist_shifts():
    rnd = random.Random(8)
    text = " ".join("".join(rnd.choice("abcdefghij") for _ in range(rnd.randrange(2, 9))) for _ in range(800)).encode()
    a, b, c = G.chunk_sets([text, text[:2000] + b"something put in" + text[2000:], bytes(reversed(text))])
    assert G.likeness(a, b) > 0.97 and G.likeness(a, c) < 0.05 and G.likeness(a, a) == 1
    inside = G.chunk_sets([text[1000:2500]])[0]
    assert G.likeness(inside, a) > 0.9                                     # containment, not resemblance


def next_brute(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0), reverse=True)
    out = {}
    for k, (i, text) in enumerate(rows):
        text, follow = text or "", rows[(k + 1) % len(rows)][1] or ""
        edited = text[:len(text) - len(text) // 2] + follow[:len(text) // 2]
        s, e, f = (chunks_brute(t.encode()) for t in (text, edited, follow))

        def like(a, b):
            if not a or not b:
                return float(len(a) == len(b))
            return sum(x & 255 for x in set(a) & set(b)) / min(sum(x & 255 for x in a), sum(x & 255 for x in b))
        out[i] = (len(text), hashlib.sha256(edited.encode()).hexdigest(), like(s, e), like(s, f))
    return out


@pytest.mark.parametrize("ranges", [1, 2, 13])
def test_next_texts(spark, ranges, monkeypatch):
    monkeypatch.setattr(G, "SLICE_BYTES", 3000)
    rnd = random.Random(ranges)
    texts = [t for t in ODD if t is None or len(t) < 2000]
    rows = [(7 * k - 50, rnd.choice(texts) if k % 3 == 0 else "".join(rnd.choice("abc déf日") for _ in range(rnd.randrange(400))))
            for k in range(90)] + [(None, "a text without an id")]
    rnd.shuffle(rows)
    got = {r.doc_id: (r.n_chars, r.edited_sha256, r.near_edited, r.near_next)
           for r in G.next_texts(frame(spark, rows).repartition(5), ranges=ranges).collect()}
    assert got == next_brute(rows)


def test_next_texts_of_few_and_repeated_rows(spark):
    one = G.next_texts(frame(spark, [(3, "alone here")])).collect()
    assert len(one) == 1 and one[0].near_next == 1 and one[0].edited_sha256 == hashlib.sha256(b"alonealone").hexdigest()
    again = G.next_texts(frame(spark, [(1, "same text")] * 40 + [(2, "x")] * 3), ranges=4).collect()
    assert len(again) == 43 and len({r.fingerprint for r in again if r.doc_id == 1}) == 1
    assert G.next_texts(frame(spark, [(1, "x")]).limit(0)).count() == 0
    plain = {r.doc_id: r for r in G.fingerprints(frame(spark, list(enumerate(ODD)))).collect()}
    assert plain[0].fingerprint == plain[1].fingerprint == "" and plain[5].n_chars == 50_000
    nulls = G.next_texts(frame(spark, [(None, "a"), (None, None), (5, "b")])).collect()
    assert sorted(r.n_chars for r in nulls) == [0, 1, 1]


def test_fingerprint_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = op12_fingerprints(spark, SF).collect()
    short = [(i, t) for i, t in rows]
    texts = dict(rows)
    order = sorted(texts, reverse=True)
    follow = {i: texts[order[(k + 1) % len(order)]] for k, i in enumerate(order)}
    assert len(got) == len(short)
    for r in got:
        t = texts[r.doc_id]
        edited = t[:len(t) - len(t) // 2] + follow[r.doc_id][:len(t) // 2]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert r.near_next == G.likeness(G.from_text(r.fingerprint), G.chunk_sets([follow[r.doc_id].encode()])[0])
        assert r.near_edited == G.likeness(G.from_text(r.fingerprint), G.from_text(r.edited_fingerprint))
        assert r.near_edited > 0.3 or len(t) < 400


# -- periodic runs -------------------------------------------------------------------
def runs_brute(w):
    n, runs = len(w), set()
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and w[i] == w[i + q]:
                i += 1
            end = i + q
            if end - start >= max(24, 3 * q) and not any(w[start:end - p] == w[start + p:end] for p in range(1, q)):
                runs.add((start, end, q))
    return sorted(runs, key=lambda r: (r[0], r[2]))


def sequences(rnd, many):
    for _ in range(many):
        w = []
        for _ in range(rnd.randrange(0, 7)):
            letters = rnd.choice([1, 2, 3, 50])
            unit = [rnd.randrange(letters) for _ in range(rnd.randrange(1, 40))]
            w += (unit * rnd.randrange(1, 60))[:rnd.randrange(1, 160)]
        yield w


def test_runs_against_brute_force():
    rnd = random.Random(6)
    for _ in range(40):
        texts = list(sequences(rnd, rnd.randrange(1, 6)))
        word = np.array([x for w in texts for x in w], np.uint64)
        assert P.find_runs(word, np.cumsum([0] + [len(w) for w in texts])) == [runs_brute(w) for w in texts]


def test_sums_of_squares_are_exact():
    rng = np.random.default_rng(3)
    for b, n, most in ((8, 22, 11_000), (64, 127, 3000), (512, 1023, 1900)):
        block, window = rng.integers(0, most, (3, b), dtype=np.uint64), rng.integers(0, most, (3, n), dtype=np.uint64)
        want = [[int(((block[r].astype(int) - window[r, k:k + b].astype(int)) ** 2).sum()) for k in range(n - b + 1)] for r in range(3)]
        assert max(map(max, want)) < P.PRIME and P.mismatches(block, window).tolist() == want


def test_long_texts_of_one_word_or_one_period():
    n = 60_000
    assert P.find_runs(np.zeros(n, np.uint64), np.array([0, n])) == [[(0, n, 1)]]
    w = np.tile(np.random.default_rng(1).integers(0, 90, 5000), 6).astype(np.uint64)
    assert P.find_runs(w, np.array([0, len(w)])) == [[(0, len(w), 5000)]]


def runs_of_text(doc_id, text, rewrite):
    w = [x.decode() for x in re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())]
    if rewrite and w and doc_id is not None and zlib.crc32(str(doc_id).encode()) % 10 == 0:
        g = zlib.crc32(str(doc_id).encode()) // 10
        a = g % len(w)
        p = 1 + (len(w) - a) // (3 + g % 8)
        w = w[:a] + [w[a + (i - a) % p] for i in range(a, len(w))]
    runs = runs_brute(w)
    best = min(runs, key=lambda r: (-(r[1] - r[0]) / r[2], r[0], r[2]), default=None)
    kept = " ".join(x for i, x in enumerate(w) if not any(s + q <= i < e for s, e, q in runs))
    listed = "".join(f"{s},{e - s},{q}\n" for s, e, q in runs)
    return (len(runs), *((best[0], best[1] - best[0], best[2], 1000 * (best[1] - best[0]) // best[2]) if best else (None,) * 4),
            hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def digest_rows(df):
    return sorted(((r.doc_id, r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.runs_sha256, r.collapsed_sha256)
                   for r in df.collect()), key=str)


def test_runs_of_odd_texts(spark):
    rnd = random.Random(12)
    rows = [(i, t) for i, t in enumerate(ODD) if t is None or len(t) < 20_000] + [(None, "a " * 30), (0, "a b " * 13), (0, "a b " * 13)]
    rows += [(100 + k, rnd.choice(" \n\t").join(f"w{x}" for x in w)) for k, w in enumerate(sequences(rnd, 60))]
    for rewrite in (False, True):
        got = P.periodic_runs(frame(spark, rows).repartition(3), order=P.rewritten if rewrite else P.as_they_are)
        assert digest_rows(got) == sorted(((i, *runs_of_text(i, t, rewrite)) for i, t in rows), key=str)
    full = P.periodic_runs(frame(spark, [(1, "x " + "a b " * 20 + "y")])).first()
    assert full.runs == [[1, 40, 2]] and full.collapsed == "x a b y" and full.n_words == 42
    assert P.periodic_runs(frame(spark, rows).limit(0)).count() == 0


def test_runs_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    short = [(i, t) for i, t in rows if len(t) < 6000]
    got = {r[0]: r for r in digest_rows(op13_periodic_runs(spark, SF))}
    assert len(got) == len(rows) and all(got[i] == (i, *runs_of_text(i, t, True)) for i, t in short)
