"""The Merkle manifest against a tree built in memory, and through ranges cut anywhere."""

import hashlib
import zlib

import pytest

from quire.llm import merkle

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, k string, leaf int"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(r, lower=False):
    text = r[1] if not lower or r[1] is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in r[1])
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (r[0], r[3], r[2], r[4], text)))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i : i + 16]) for i in range(0, len(out[-1]), 16)])
    return out


def path(tree, i):
    for nodes in tree[:-1]:
        a = i // 16 * 16
        yield nodes[a:i], nodes[i + 1 : a + 16]
        i //= 16


def brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[3], []).append(r)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: levels([leaf(r) for r in sorted(groups[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))]) for s in order}
    top = levels([trees[s][-1][0] for s in order])
    out = []
    for g, s in enumerate(order):
        for i, r in enumerate(sorted(groups[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))):
            steps = [*path(trees[s], i), *path(top, g)]
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
            f = leaf(r, hit)
            for left, right in steps:
                f = h(*left, f, *right)
            out.append((r[0], leaf(r), trees[s][-1][0], top[-1][0], h(*(x for left, right in steps for x in left + right)), f, f == top[-1][0]))
    return sorted(out, key=str)


def made(n):
    rows = [(i, None if i % 11 == 0 else f"Text {i} Über" if i % 7 else f"plain {i}", "en" if i % 3 else None, "hot" if i % 3 else (None if i % 5 == 0 else f"s{i % 40}"), i if i % 4 else None) for i in range(n)]
    return [*rows, (3, "again", "en", "hot", 1), (3, "again", "en", "hot", 1), (None, "", "en", "hot", 0), (None, "x", "de", "lone", 2), (5, "X" * 100_000, "de", "", 1)]


@pytest.mark.parametrize("n", [0, 12, 700])
def test_against_a_tree_in_memory(spark, n):
    rows = made(n)
    docs = spark.createDataFrame([(*r, "k", 1) for r in rows], SCHEMA).repartition(5)
    lowered = {"text": merkle.F.translate(docs["text"], merkle.UPPER, merkle.LOWER)}
    got = merkle.report(docs, lowered, merkle.F.crc32(docs["doc_id"].cast("string").cast("binary")) % 5 == 0).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)


def test_empty_and_one(spark):
    assert merkle.report(spark.createDataFrame([], SCHEMA)).collect() == []
    (one,) = merkle.report(spark.createDataFrame([(1, "a", "en", "s", 1, "", 0)], SCHEMA)).collect()
    assert one["leaf"] == one["subroot"] == one["root"] == one["folded_root"] and one["proof_sha256"] == h()


@pytest.mark.parametrize("cut", [1, 7, 16, 100, 4000])
def test_ranges_cut_anywhere(cut):
    """Nodes made within ranges and edges left over give every node of the tree once, whatever the ranges."""
    n = 1000
    leaves = [h(str(i)) for i in range(n)]
    want = {(level, i): d for level, nodes in enumerate(levels(leaves)) for i, d in enumerate(nodes) if level}
    out = []
    for a in range(0, n, cut):
        r = merkle.Range("k", n, out)
        part = leaves[a : a + cut]
        for b in range(0, len(part), 13):
            r.push(0, a + b, part[b : b + 13])
        r.close()
    have = {(x[2], x[3]): x[4].hex() for x in out if x[5] is not None}
    assert len(have) == sum(x[5] is not None for x in out)
    edges = {(x[2], x[3]): x[4].hex() for x in out if x[5] is None}
    for level in range(3):
        for up in {i // 16 for (at, i) in edges if at == level}:
            kids = [edges.get((level, i)) for i in range(up * 16, min(up * 16 + 16, len(levels(leaves)[level])))]
            assert None not in kids and (level + 1, up) not in have
            have[level + 1, up] = h(*kids)
            edges[level + 1, up] = have[level + 1, up]
    assert have == want
