"""The n-gram model against one counted in memory."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from quire.llm import kneser_ney

SCHEMA = "doc_id bigint, text string, score double, held_out string"


def tokens(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")), None]


def discounts(counts):
    n = [sum(c == i for c in counts.values()) for i in range(5)]
    if min(n[1:4]) > 0:
        y = n[1] / (n[1] + 2 * n[2])
        d = [0, 1 - 2 * y * n[2] / n[1], 2 - 3 * y * n[3] / n[2], 3 - 4 * y * n[4] / n[3]]
        if all(0 < d[i] <= i for i in (1, 2, 3)):
            return d
    return [0, 0.5, 1.0, 1.5]


def brute(train, order):
    grams = {order: Counter()}
    raw = Counter()
    for text in train:
        t = ["<"] * (order - 1) + tokens(text)
        raw.update(t[order - 1 :])
        grams[order].update(tuple(t[i - order + 1 : i + 1]) for i in range(order - 1, len(t)))
    for k in range(order - 1, 0, -1):
        grams[k] = Counter(g[1:] for g in grams[k + 1])
    d = {k: discounts(grams[k]) for k in grams}
    by = {k: defaultdict(list) for k in grams}
    for k in grams:
        for g, c in grams[k].items():
            by[k][g[:-1]].append(c)

    def p(context, w):
        out = 1 / (len(raw) + 1)
        for k in range(1, order + 1):
            ctx = tuple(context[len(context) - k + 1 :])
            own = by[k].get(ctx)
            if own:
                c = grams[k][(*ctx, w)]
                out = max(c - d[k][min(c, 3)], 0) / sum(own) + sum(d[k][min(x, 3)] for x in own) / sum(own) * out
        return out

    def of(text):
        t = ["<"] * (order - 1) + tokens(text)
        own = t[order - 1 :]
        base = sum(math.log10((raw[w] + 1) / (sum(raw.values()) + len(raw) + 1)) for w in own)
        return len(own), sum(raw[w] > 0 for w in own), sum(raw.values()), base, sum(math.log10(p(t[i - order + 1 : i], t[i])) for i in range(order - 1, len(t)))

    return of, p, raw


def made(n, seed=1):
    r = random.Random(seed)
    words = ["The", "the", "of", "é", *(f"w{i}" for i in range(40))]
    return [" ".join(r.choices(words, [30, 30, 10, 5] + [1] * 40, k=r.randint(0, 40))) for _ in range(n)] + ["the cat sat on the mat"] * 5 + [None, "", " \n", "x" * 5000, "the " * 3000]


@pytest.mark.parametrize("order", [1, 2, 3])
def test_against_counts_in_memory(spark, monkeypatch, order):
    monkeypatch.setattr(kneser_ney, "COUNTED", 700)
    train, new = made(120), [*made(20, 2), "never seen words", "the cat sat", "W3 OF É"]
    docs = spark.createDataFrame([(i, t, 0.0, "a") for i, t in enumerate(train)], SCHEMA).repartition(3)
    m = kneser_ney.fit(docs, order)
    assert order == 1 or len(m.frequent) > 1
    got = kneser_ney.score(spark.createDataFrame([(i, t, 0.0, "a") for i, t in enumerate(new)], SCHEMA), m).collect()
    of, _, _ = brute(train, order)
    for r in got:
        n, known, total, base, score = of(new[r["doc_id"]])
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (n, known, total)
        assert r["base_score"] == pytest.approx(base, rel=1e-9) and r["score"] == pytest.approx(score, rel=1e-9)
    assert len(got) == len(new)


def test_probabilities_add_up(spark):
    train = made(60)
    m = kneser_ney.fit(spark.createDataFrame([(i, t, 0.0, "a") for i, t in enumerate(train)], SCHEMA))
    vocabulary = sorted({w for t in train for w in tokens(t) if w}) + ["unheard-of"]
    arrays = kneser_ney.Arrays(m)
    for before in ("the", "w3", "nobody"):
        import pyarrow as pa

        word, contexts, start = kneser_ney.sequences(pa.array([f"{before} {w}" for w in vocabulary]), 2)
        p, _ = kneser_ney.token_scores(m, arrays, word, contexts)
        end, _ = kneser_ney.token_scores(m, arrays, *kneser_ney.sequences(pa.array([before]), 2)[:2])
        assert float(np.sum(p[start[:-1] + 1]) + end[1]) == pytest.approx(1, abs=1e-9)


def test_empty(spark):
    none = spark.createDataFrame([], SCHEMA)
    m = kneser_ney.fit(none)
    assert kneser_ney.score(none, m).collect() == []
    (r,) = kneser_ney.score(spark.createDataFrame([(1, "a b", 0.0, "")], SCHEMA), m).collect()
    assert (r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) == (3, 0, 0, 0.0, 0.0)
