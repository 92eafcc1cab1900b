"""Near duplicates against brute force where all members of a component have the same size and prefix."""

import random

import pytest

from quire.llm import jaccard_join


def brute(rows, k, num, den):
    """The smallest document that links reach, for each document."""
    sets = {i: {tuple(w[at : at + k]) for at in range(len(w) - k + 1)} for i, w in rows}
    comp = {i: i for i in sets}
    for a in sorted(sets):
        for b in sets:
            if a < b and den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b]):
                old, new = max(comp[a], comp[b]), min(comp[a], comp[b])
                comp = {i: new if c == old else c for i, c in comp.items()}
    return comp


@pytest.mark.parametrize(("k", "num", "n", "at", "then"), [(3, 90, 62, (20, 40), 54), (5, 80, 14, (12,), 0)])
def test_members_of_one_group(spark, k, num, n, at, then):
    """A is unlike B and C, which are alike: in some of these families all three have one prefix that nothing else shares."""
    rng = random.Random(11)
    rows = []
    for family in range(40):
        a = [f"w{rng.randrange(10**9)}" for _ in range(n)]
        b = [f"x{family}y{i}" if i in at else w for i, w in enumerate(a)]
        c = [f"z{family}" if i == then else w for i, w in enumerate(b)]
        rows += [(3 * family + i, w) for i, w in enumerate((a, b, c))]
    want = brute(rows, k, num, 100)
    assert sum(want[i] == i - 1 for i in range(2, len(rows), 3)) == 40
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id bigint, text string")
    got = {r["doc_id"]: r["component_id"] for r in jaccard_join.jaccard_components(docs, k, num, 100).collect()}
    assert got == want
