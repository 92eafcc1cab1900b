"""Fingerprints: order, insertion, deletion and wrapping of the sums, and the report of edits against brute force."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from quire.llm import fingerprint as P


def vectors(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "k int, text string")
    return {r["k"]: r["vector"] for r in P.vector(df, ["k"], "text").collect()}


def test_multisets(spark):
    long = "x" * 200 + "y" * 100
    texts = ["alpha one\nbeta two", "beta two\nalpha one", "beta two\n\nalpha one\n", "alpha one", "beta two", "alpha one\nalpha one\nbeta two", "", None, long, "y" * 100 + "x" * 200, long[64:128] + long[:64] + long[128:]]
    v = vectors(spark, texts)
    assert v[0] == v[1] == v[2] and v[6] == v[7] == [0] * 74
    assert len({tuple(v[i]) for i in (0, 3, 4, 5, 6, 8, 9)}) == 7
    df = spark.createDataFrame([(v[0], v[3], v[4], v[5])], "ab array<bigint>, a array<bigint>, b array<bigint>, aab array<bigint>")
    c = F.col
    r = df.select(P.add(c("a"), c("b")).alias("sum"), P.subtract(c("ab"), c("a")).alias("less"), P.add(c("ab"), c("a")).alias("more"), P.subtract(P.subtract(c("a"), c("b")), c("a")).alias("below"), P.add(P.subtract(P.subtract(c("a"), c("b")), c("a")), c("b")).alias("none")).first()
    assert r["sum"] == v[0] and r["less"] == v[4] and r["more"] == v[5] and r["none"] == [0] * 74
    assert all(0 <= x < 1 << 32 for x in r["below"])


def test_wrapping(spark):
    """Sums that have passed the modulus still show likeness, and what is added can be taken out again."""
    rng = random.Random(1)
    a = "\n".join(f"line {rng.random()}" for _ in range(300))
    v = vectors(spark, [a, a + "\nmore", "\n".join(f"other {rng.random()}" for _ in range(300))])
    many = 1 << 26  # so many copies of each paragraph
    big = [[x * many % (1 << 32) for x in v[i]] for i in range(3)]
    df = spark.createDataFrame([(v[0], v[1], v[2], *big)], "a array<bigint>, b array<bigint>, c array<bigint>, x array<bigint>, y array<bigint>, z array<bigint>")
    like = lambda p, q: P.likeness(F.col(p), F.col(q))
    near, far, same = df.select(like("a", "b"), like("a", "c"), like("x", "x")).first()
    assert near > 0.95 and far < 0.4 and same == 1
    assert df.select(P.subtract(P.add(F.col("x"), F.col("y")), F.col("y")).alias("v")).first()["v"] == big[0]


@pytest.mark.parametrize("bucket_bytes", [400, 5000, 1 << 20])
def test_report(spark, bucket_bytes):
    rng = random.Random(8)
    text = lambda: "".join(rng.choice("ab é\n😀") for _ in range(rng.choice((0, 1, 2, 3, 50, 300)))) or None
    rows = [(i, text()) for i in rng.sample(range(-500, 10**6), 120)]
    rows += [(rows[0][0], "again"), (None, "no id")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    got = P.edit_report(docs, bucket_bytes).collect()
    line = sorted(((i is not None, i or 0, t or "") for i, t in rows), reverse=True)
    want = []
    for (has, i, t), (_, _, following) in zip(line, line[1:] + line[:1], strict=True):
        cut = len(t) // 3
        edited = t[: len(t) - cut] + following[:cut]
        want.append((i if has else None, len(t), hashlib.sha256(edited.encode()).hexdigest()))
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted(((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got), key=key) == sorted(want, key=key)
    print_of = {i if has else None: t for has, i, t in line if i != rows[0][0]}
    by_text = {}
    for r in got:
        if r["doc_id"] in print_of:
            by_text.setdefault(print_of[r["doc_id"]], set()).add(r["fingerprint"])
    assert all(len(x) == 1 for x in by_text.values())
    for r in got:
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 and len(r["fingerprint"]) == 592
