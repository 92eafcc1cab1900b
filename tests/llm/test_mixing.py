"""The mix against brute-force apportionment and water filling, with a source too small for a block and tied seats."""

import random

import pytest
from pyspark.sql import functions as F

from quire.llm import mixing


def by_quotients(weights, seats):
    got = [0] * len(weights)
    for _ in range(seats if sum(weights) else 0):
        got[max(range(len(weights)), key=lambda i: (weights[i] / (2 * got[i] + 1), -i))] += 1
    return got


def filled(sizes, weights, repeats):
    """Targets by repeated sharing: who is above its cap stays at it, and the rest is shared again."""
    target, free, left = [0.0] * len(sizes), set(range(len(sizes))), float(sum(sizes))
    while free:
        total = sum(weights[i] for i in free)
        over = [i for i in free if left * weights[i] / total > repeats * sizes[i]]
        if not over:
            for i in free:
                target[i] = left * weights[i] / total
            break
        for i in over:
            target[i] = repeats * sizes[i]
        left -= sum(target[i] for i in over)
        free -= set(over)
    return target


def test_seats(spark):
    rng = random.Random(3)
    cases = [([rng.choice((0, 1, 2, 5, 100, 10**6)) for _ in range(rng.randint(1, 12))], rng.choice((0, 1, 3, 50, 400))) for _ in range(60)]
    rows = [(g, i, w, seats) for g, (ws, seats) in enumerate(cases) for i, w in enumerate(ws)]
    df = spark.createDataFrame(rows, "g int, i int, w bigint, seats bigint")
    got = {(r["g"], r["i"]): r["n"] for r in mixing.apportion(df, ["g"], "w", "seats", ["i"], "n").collect()}
    for g, (ws, seats) in enumerate(cases):
        assert [got[g, i] for i in range(len(ws))] == by_quotients(ws, seats), (ws, seats)


@pytest.mark.parametrize("shard_docs", [3, 16384])
def test_targets_are_met(spark, shard_docs):
    rng = random.Random(5)
    spread = {"a": (40, 300), "b": (1, 5), "c": (30, 2), None: (7, 50), "d": (200, 1000), "e": (3, 0), "f": (1, 64)}
    rows, words = [], {}
    for source, (n, most) in spread.items():
        for _ in range(n):
            size = most if n == 1 else rng.randint(0, most)
            rows.append((len(rows), source, " ".join(["w"] * size) or None, 1))
            words[source] = words.get(source, 0) + size
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, text string, _id int").repartition(3)
    got = mixing.mix(docs, shard_docs=shard_docs).collect()
    order = sorted((s for s in spread if s), key=str) + [None]
    want = dict(zip(order, filled([words[s] for s in order], [(1, 2, 3)[i % 3] for i in range(len(order))], 3), strict=True))
    source_of, taken = {r[0]: r[1] for r in rows}, {}
    for r in got:
        assert 0 <= r["taken"] <= 3 * r["size"] and r["source_size"] == words[source_of[r["doc_id"]]]
        assert abs(r["target"] - want[source_of[r["doc_id"]]]) < 1e-6
        taken[source_of[r["doc_id"]]] = taken.get(source_of[r["doc_id"]], 0) + r["taken"]
    assert len(got) == len(rows) and all(abs(taken[s] - want[s]) <= 0.5 for s in order)
    assert sorted(map(tuple, got)) == sorted(map(tuple, mixing.mix(docs.repartition(5), shard_docs=shard_docs).collect()))


def test_mixed_keeps_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "a b c", "x", 5, 6, 7), (None, "d", None, 5, 6, 7)], "doc_id bigint, text string, source string, _id int, _times int, _TURN int")
    got = mixing.mixed(docs)
    assert got.columns == docs.columns and {tuple(r)[3:] for r in got.collect()} == {(5, 6, 7)}
    assert mixing.mixed(docs.where(F.lit(False))).collect() == []
