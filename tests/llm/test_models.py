"""SentencePiece lattice, quality classifier, packing, pipeline."""

import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import packing, piece_lattice, quality_knn
from ledgerlens.llm.queries import op7_quality_knn

from . import brute

WORDS = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


# -- SentencePiece lattice --------------------------------------------------
def _viterbi(word, score, zero):
    best = [(0.0, None)] + [None] * len(word)
    for end in range(1, len(word) + 1):
        for start in range(max(0, end - 16), end):
            piece = word[start:end]
            got = score.get(piece)
            if got is None and end == start + 1:
                got = (-1, piece_lattice.UNKNOWN)
            if got and best[start] is not None:
                total = best[start][0] + got[1]
                if best[end] is None or total > best[end][0]:
                    best[end] = (total, (start, got[0]))
    ids, at = [], len(word)
    while at:
        start, i = best[at][1]
        ids += [i] if i >= 0 else [zero + b for b in reversed(word[start:at].encode())]
        at = start
    return ids[::-1]


TEXTS = [None, "", " ", "Hello  world\nthing ", "naïve ﬁ 日本語 \U0001f600!", "   lead", "a" * 300, "the and of to in", "▁x ▁",
         "tab\there", "\x00\x7f", "x" * 17 + "      " + "y", "\n".join(["line", "\U0001f600" * 300, "日本語の文です。" * 60]),
         "".join(random.Random(4).choice("abcdefghijklmnopqrstuvwxyzABC0123456789+/é") for _ in range(1500))]


def test_lattice_is_viterbi_and_round_trips(spark):
    pieces, raw, zero, longest = known = piece_lattice.load_pieces(spark, PIECES)
    score = {r.piece: (r.id, r.score) for r in pieces.collect()}
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").withColumn("word", F.lit("clash")).drop("word")
    table = piece_lattice.word_table(docs, *known)
    for r in table.collect():
        assert r.ids == _viterbi(r.word, score, zero), r.word
        assert r.decoded == r.word
    rows = {r.doc_id: r for r in piece_lattice.texts(piece_lattice.encode(docs, table)).collect()}
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    for i, t in enumerate(TEXTS):
        if t:
            assert rows[i].text == t.replace("▁", " ")
            assert sp.decode(rows[i].ids).lstrip() == t.replace("▁", " ").lstrip()
    digest = {r.doc_id: r for r in piece_lattice.digests(piece_lattice.encode(docs, table)).collect()}
    assert all(r.round_trip != (TEXTS[i] is not None and "▁" in TEXTS[i]) for i, r in digest.items()) and digest[0].n_tokens == 0
    assert digest[3].n_tokens == len(rows[3].ids)


def test_lattice_of_frequent_and_rare_words_agree(spark, monkeypatch):
    known = piece_lattice.load_pieces(spark, PIECES)
    docs = spark.createDataFrame([(0, "a b a c a b"), (1, "c rare"), (1, "c rare")], "doc_id long, text string")
    table = piece_lattice.word_table(docs, *known)
    all_frequent = sorted(map(tuple, piece_lattice.encode(docs, table).select("doc_id", "at", "word").collect()))
    monkeypatch.setattr(piece_lattice, "FREQUENT", 1)
    mixed = sorted(map(tuple, piece_lattice.encode(docs, table).select("doc_id", "at", "word").collect()))
    assert mixed == all_frequent and len(mixed) == 10
    none = docs.limit(0)
    assert piece_lattice.digests(piece_lattice.encode(none, piece_lattice.word_table(none, *known))).count() == 0


def test_lattice_of_a_long_text_without_spaces(spark):
    """Time is linear: 100,000 characters take seconds, squared they would take hours."""
    import time
    pieces, _, zero, _ = known = piece_lattice.load_pieces(spark, PIECES)
    score = {r.piece: (r.id, r.score) for r in pieces.collect()}
    rnd = random.Random(5)
    text = "".join(rnd.choice("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/") for _ in range(100_000))
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    start = time.time()
    row = piece_lattice.word_table(docs, *known).first()
    assert time.time() - start < 100
    assert row.decoded == row.word == "▁" + text and row.ids == _viterbi(row.word, score, zero)


def test_lattice_of_whole_texts_is_that_of_their_words(spark):
    """Rows of ``encode_texts`` agree with the joined words, and no word is shuffled or written for them."""
    known = piece_lattice.load_pieces(spark, PIECES)
    texts = [*TEXTS, "a  ", "b ", " ▁", "Hello  world\nthing ", None]
    docs = spark.createDataFrame([(i if i % 5 else None, i, t) for i, t in enumerate(texts)], "doc_id long, rid long, text string")
    keys = ("rid", "doc_id")
    whole = piece_lattice.encode_texts(docs, *known, keys)
    assert "Exchange" not in whole._jdf.queryExecution().executedPlan().toString()
    joined = piece_lattice.encode(docs, piece_lattice.word_table(docs, *known), keys)
    ids = {r.rid: (r.ids or [], r.text or "") for r in piece_lattice.texts(joined, keys).collect()}
    rows = whole.collect()
    assert len(rows) == len(texts)
    assert all((sum(r.ids, []), r.decoded) == ids[r.rid] for r in rows)
    want = sorted(map(tuple, piece_lattice.digests(joined, keys).collect()), key=lambda r: r[0])
    got = piece_lattice.text_digests(whole, keys)
    assert sorted(map(tuple, got.collect()), key=lambda r: r[0]) == want
    assert piece_lattice.encode_texts(docs.limit(0), *known, keys).count() == 0


def test_lattice_cache_does_not_change_ids(spark, monkeypatch):
    known = piece_lattice.load_pieces(spark, PIECES)
    words = ["the", "and", "of", "the", "x" * 100, "the", "▁a", ""]
    plain = piece_lattice._encoder(*known)()
    want = [plain[w] for w in words]
    monkeypatch.setattr(piece_lattice, "CACHED", 2)
    small = piece_lattice._encoder(*known)()
    assert [small[w] for w in words] == want and len(small) <= 2


# -- quality classifier -----------------------------------------------------
def test_classifier_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = op7_quality_knn(spark, sf).collect()
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    test = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert sum(p == q for p, q in test) / len(test) >= 0.95
    good = [p for p, q in test if q == 1]
    assert sum(good) / len(good) >= 0.98


def test_classifier_odd_rows(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "some words here"), (3, "some words here"), (4, "x")],
                                 "doc_id long, text string").withColumn("quality_score", F.lit("clash"))
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = sorted((r.doc_id, r.score) for r in quality_knn.quality_scores(docs, none).collect())
    assert got == [(1, 0.0), (2, 0.0), (3, 0.5), (3, 0.5), (4, 0.5)] or got[-1][1] in (0.0, 0.5)
    unlabelled = spark.createDataFrame([(3, None, 0), (77, 1, 0)], "doc_id long, quality int, toxic int")
    assert quality_knn.quality_scores(docs, unlabelled).count() == 5
    assert quality_knn.quality_scores(docs.limit(0), none).count() == 0


# -- packing ----------------------------------------------------------------
@pytest.mark.parametrize("seed", range(6))
def test_plan_uses_everything_once(seed):
    rnd = random.Random(seed)
    counts = Counter(min(100, max(1, int(rnd.lognormvariate(3, 1)))) for _ in range(rnd.choice([1, 5, 200, 5000])))
    plan = packing.best_two_fit(dict(counts), 100)
    used = Counter()
    for lengths, times in plan:
        assert 0 < sum(lengths) <= 100
        for x in lengths:
            used[x] += times
    assert used == counts
    bins, bound = sum(n for _, n in plan), -(-sum(k * v for k, v in counts.items()) // 100)
    assert bins <= bound * 1.25 + 1
    assert packing.best_two_fit({}, 100) == []


def test_two_documents_replace_the_smallest():
    # greedy gives 60 + 30 (gap 10); 60 + (25 + 15) is full
    assert [60, 25, 15] in [p for p, _ in packing.best_two_fit({60: 1, 30: 1, 25: 1, 15: 1}, 100)]


def _check_packed(rows, capacity):
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


def test_packing_is_whole_and_exact(spark):
    from tokenizers import Tokenizer
    tk = Tokenizer.from_file(WORDS)
    texts = ["", None, "Hello world", "x " * 900, "É’s naïve <|endoftext|> \x1c\x00 İ ΣΑΣ 'S", "word " * 40, "word " * 40]
    texts += [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    pieces = packing.token_pieces(docs, WORDS, capacity=256)
    by_doc = {}
    for r in pieces.collect():
        by_doc.setdefault(r.doc_id, []).append(r)
    for i, t in enumerate(texts):
        got = sorted(by_doc[i], key=lambda r: r.piece)
        ids = [x for r in got for x in r.ids]
        assert ids == tk.encode(t or "", add_special_tokens=False).ids + [0]
        assert [r.start for r in got] == list(range(0, len(ids), 256)) and all(len(r.ids) == r.length for r in got)
        assert all(zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in got)
    packed = packing.pack(pieces, 256).collect()
    assert sorted((r.doc_id, r.piece, r.ids_crc32) for r in packed) == sorted((r.doc_id, r.piece, r.ids_crc32) for v in by_doc.values() for r in v)
    total = sum(r.length for r in packed)
    assert _check_packed(packed, 256) <= -(-total // 256) * 1.1 + 1
    assert packing.pack(packing.token_pieces(docs.limit(0), WORDS), 256).count() == 0


def test_hot_length_is_numbered_in_parts(spark, monkeypatch):
    monkeypatch.setattr(packing, "RANKED", 10)
    docs = spark.createDataFrame([(i % 50, "same text") for i in range(300)], "doc_id long, text string")
    packed = packing.pack(packing.token_pieces(docs, WORDS, 16, keep_ids=False), 16).collect()
    assert len(packed) == 300 and _check_packed(packed, 16) == 60


# -- pipeline ---------------------------------------------------------------
def _masked(text):
    spans, out, at = brute.base_spans(text), [], 0
    for start, _, kind, end in sorted(spans, key=lambda s: (s[0], -s[3])):
        if end <= at:
            continue
        out.append(text[at:start] if start > at else "")
        if start >= at:
            out.append(f"<{kind.upper()}>")
        at = end
    return "".join(out) + text[at:]


def test_pipeline_against_plain_stages(spark):
    import corpus_pipeline as P
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    packed = P.run(spark, sf).collect()
    scores = quality_knn.quality_scores(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    good = {r.doc_id for r in scores.collect() if r.predicted}
    rows = sorted((r.doc_id, r.text) for r in docs.collect() if r.doc_id in good)
    assert 0 < len(rows) < docs.count()
    lines = [(d, t) for (d, _), (t, _) in zip(rows, brute.line_dedup(rows), strict=True)]
    lines = [(d, t) for (d, t), (_, was) in zip(lines, rows, strict=True) if t.strip() or not was.strip()]
    groups = brute.ngram_join(lines)
    left = [(d, _masked(t)) for d, t in lines if groups[d][1] == d]
    from tokenizers import Tokenizer
    tk = Tokenizer.from_file(WORDS)
    want = Counter()
    for d, t in left:
        ids = tk.encode(t, add_special_tokens=False).ids + [0]
        for k in range(0, len(ids), 2048):
            want[d, k // 2048, zlib.crc32(np.array(ids[k:k + 2048], "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.ids_crc32) for r in packed) == want
    _check_packed(packed, 2048)


def test_stages_take_odd_tables(spark):
    import corpus_pipeline as P
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    odd = docs.limit(0).unionByName(spark.createDataFrame(
        [(1, None, None, None, None), (2, "", "en", "s", 0), (3, "one line of text\nanother line of text", "en", "s", 1)] * 2, docs.schema))
    odd = odd.withColumn("rid", F.lit(1)).withColumn("score", F.lit("x"))
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, odd, sf)
        assert out.columns == odd.columns, name
        assert {r.doc_id for r in out.collect()} <= {1, 2, 3}
        assert stage(spark, odd.limit(0), sf).count() == 0, name
    assert P.STAGES[-1][1](spark, odd.limit(0), sf).count() == 0
