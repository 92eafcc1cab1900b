"""Ranked search against brute force, and the bit-sliced sums by themselves."""

import math
import random
import re

import numpy as np
import pytest

from quire.llm import lexical

SCHEMA = "doc_id bigint, text string, q int, n int, score string"
WORDS = ["alpha", "Beta", "gam-ma", "δελτα", "ß", "x1", "The", "the", "of"]


def terms(text):
    return re.findall(lexical.PATTERN, "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k):
    own = [(d, terms(t)) for d, t in docs]
    n_docs, n_terms = sum(bool(t) for _, t in own), sum(len(t) for _, t in own)
    df = {}
    for _, t in own:
        for x in set(t):
            df[x] = df.get(x, 0) + 1
    out = []
    for i, text in items:
        asked = set(terms(text))
        scored = []
        for d, t in own:
            m = 10 + 90 * len(t) * n_docs // max(n_terms, 1)
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[x] + 1))) * (1_000_000_000 * t.count(x) // (1000 * t.count(x) + 8 * m)) for x in asked if x in t)
            if s > 0:
                scored.append((-s, d is None, d or 0, d))
        out += [(i, r + 1, x[3], -x[0]) for r, x in enumerate(sorted(scored, key=lambda x: x[:3])[:k])]
    return sorted(out, key=str)


def made(n):
    r = random.Random(3)
    docs = [(i, " ".join(r.choices(WORDS, k=r.randint(0, 30))) + (f" rare{i % 17}" if i % 3 == 0 else "")) for i in range(n)]
    return docs + [(n, None), (n + 1, ""), (n + 2, "-- --"), (7, docs[7][1]), (7, docs[7][1]), (None, "alpha rare5"), (n + 3, "the " * 50_000), (n + 4, "é" * 20_000)] + [(n + 10 + i, "alpha of rare3") for i in range(40)]


ITEMS = [(1, "alpha Beta rare3 rare5"), (2, "nothing here fits?"), (3, None), (4, ""), (5, "THE of the δελτα"), (5, "THE of the δελτα"), (6, "rare3"), (None, "ß x1")]


@pytest.mark.parametrize(("k", "batch"), [(10, 100_000), (3, 4)])
def test_against_brute_force(spark, monkeypatch, k, batch):
    monkeypatch.setattr(lexical, "BLOCK", 70)
    rows = made(300)
    docs = spark.createDataFrame([(*r, 1, 1, "s") for r in rows], SCHEMA).repartition(3)
    items = spark.createDataFrame([(*r, 1) for r in ITEMS], "item_id int, text string, rank int")
    got = lexical.search(docs, items, k, batch).collect()
    assert sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in got), key=str) == brute(rows, dict.fromkeys(ITEMS), k)


def test_empty(spark):
    docs, items = spark.createDataFrame([], SCHEMA), spark.createDataFrame([], "item_id int, text string")
    assert lexical.search(docs, items).collect() == []
    assert lexical.search(docs, spark.createDataFrame([(1, "a")], items.schema)).collect() == []
    assert lexical.search(spark.createDataFrame([(1, "a", 1, 1, "")], SCHEMA), items).collect() == []


def test_sums_of_slices():
    r = np.random.default_rng(1)
    given = r.integers(0, 1 << 33, (5, 3, 128)).astype(np.uint64)
    given[:, :, r.random(128) < 0.5] = 0
    given[:, 1, :100] = 7  # ties
    sums = np.zeros((36, 3, 2), np.uint64)
    for x in given:
        lexical.add(sums, np.array([np.packbits(((x >> np.uint64(j)) & lexical.ONE).astype(np.uint8), axis=1, bitorder="little").view(np.uint64) for j in range(33)]))
    total = given.sum(0)
    for q, places in enumerate(lexical.best(sums, 10)):
        want = [i for i in sorted(range(128), key=lambda i: (-int(total[q, i]), i)) if total[q, i]][:10]
        assert sorted(places.tolist()) == sorted(want)


def test_long_products():
    n = np.array([1, 4_000_000_000])
    assert lexical.norm(n, 30_000_000_000, 10_000_000_000_000).tolist() == [10 + 90 * int(x) * 30_000_000_000 // 10_000_000_000_000 for x in n]


def test_index_rows(spark):
    """The index as a table: every posting's impact stands in its block's slices."""
    rows = made(100)
    docs = spark.createDataFrame([(*r, 1, 1, "s") for r in rows], SCHEMA).repartition(2)
    found = lexical.postings(docs, [b"alpha", b"rare5"]).cache()
    index = lexical.build(found, lexical.weights(found, [b"alpha", b"rare5"])).collect()
    seen = 0
    for b in index:
        for t, a, z in zip(b["terms"], b["first"], b["first"][1:], strict=False):
            bits = np.bitwise_or.reduce([np.frombuffer(x, np.uint64)[a:z] for x in b["slices"]])
            seen += int(np.bitwise_count(bits).sum())
    assert seen == sum(len({"alpha", "rare5"} & set(terms(t))) for _, t in rows)
