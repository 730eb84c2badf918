"""N-gram join, embedding near-dedup and components against brute force."""

import random

import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import near_vectors as NV
from ledgerlens.llm.common import connected_components
from ledgerlens.llm.ngram_join import ngram_join

from . import brute


def _texts():
    rnd = random.Random(3)
    vocab = [f"w{i}" for i in range(400)] + ["The", "É", "naïve"]
    shared = " ".join(rnd.choice(vocab) for _ in range(25))
    base = [" ".join(rnd.choice(vocab) for _ in range(rnd.randint(30, 90))) for _ in range(12)]
    rows = []
    for k in range(130):
        words = rnd.choice(base).split()
        for _ in range(rnd.choice([0, 0, 1, 2, 6])):
            words[rnd.randrange(len(words))] = rnd.choice(vocab)
        text = " ".join(words)
        if k % 3 == 0:
            text = shared + "\n" + text        # one passage in a third of the rows: a long list
        rows.append((k, text.upper() if k % 7 == 0 else text))
    rows += [(200, None), (201, ""), (202, " \n\t "), (203, "one two"), (204, "ONE  two"), (205, "one two three four five"),
             (206, "a b c d e " * 3000), (207, "a b c d e " * 2999)]
    rnd.shuffle(rows)
    return rows


def test_ngram_join_is_exact(spark):
    rows = _texts()
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_shingles", F.lit("clash"))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join(docs.repartition(5)).collect()}
    want = brute.ngram_join(rows)
    assert got == want
    assert len({c for _, c in want.values()}) < len(rows) - 40      # the case does link
    assert got[200] == (0, 200) and got[203][1] == got[204][1] == 203


def test_ngram_join_empty_and_repeated_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert ngram_join(empty).count() == 0
    only_blank = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert sorted(map(tuple, ngram_join(only_blank).collect())) == [(1, 0, 1), (2, 0, 2)]
    twice = spark.createDataFrame([(5, "a b c d e f")] * 2 + [(9, "a b c d e f")], "doc_id long, text string")
    assert sorted(map(tuple, ngram_join(twice).collect())) == [(5, 2, 5), (5, 2, 5), (9, 2, 5)]


def _vectors():
    rnd = random.Random(5)
    rows = []
    for k in range(40):
        c = [rnd.gauss(0, 1) for _ in range(16)]
        for _ in range(rnd.choice([1, 2, 6])):
            rows.append([x + rnd.gauss(0, 0.18) for x in c])
    rows += [list(rows[0])] * 5 + [[2 * x for x in rows[0]]]
    out = [(i, v) for i, v in enumerate(rows)]
    out += [(900, None), (901, []), (902, [0.0] * 16), (903, [float("nan")] * 16), (904, [None] * 16),
            (905, [float("inf")] + [1.0] * 15), (906, [1.0, 2.0]), (907, [1.0, 2.0])]
    return out


@pytest.mark.parametrize("block", [1024, 3])
def test_near_vectors_match_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(NV, "BLOCK", block)       # 3: every bucket is split into blocks
    rows = _vectors()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("label", F.lit(1))
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in NV.near_vectors(df).collect()}
    want = {i: (n, c, i == c) for i, n, c in brute.near_vectors(rows)}
    links = sum(n for n, _, _ in want.values())
    assert links > 60 and set(got) == set(want)
    found = sum(n for n, _, _ in got.values())
    assert 0.9 * links <= found <= links          # measured recall; no false link
    assert all(got[i][0] <= want[i][0] for i in want)
    for i in range(900, 906):
        assert got[i] == (0, i, True)
    assert got[906] == (1, 906, True) and got[907] == (1, 906, False)


def test_near_vectors_recall_on_the_test_table(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "embedding").collect()]
    import numpy as np
    x = np.array([v for _, v in rows], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = (x @ x.T >= 0.9).sum(1) - 1
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    got = {r.vec_id: r.n_links for r in NV.near_vectors(df).collect()}
    assert len(got) == len(rows)
    assert all(got[v] <= n for (v, _), n in zip(rows, near, strict=True))
    assert sum(got.values()) >= 0.9 * near.sum()


def test_near_vectors_empty(spark):
    assert NV.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_components(spark):
    rnd = random.Random(1)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(220)]
    edges += [(i, i + 1) for i in range(1000, 1100)] + [(5000, 5000 + i) for i in range(1, 200)] + [(7, 7), (3, 4), (4, 3)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    linked = {x for a, b in edges if a != b for x in (a, b)}
    want = brute.components(linked, [(a, b) for a, b in edges if a != b])
    assert got == want
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
