"""Removal of repeated windows against brute force, by either way of grouping."""

import re

import pytest

from quire.llm import common, substring_dedup


def brute(rows, window):
    """For each (doc_id, text): words, words removed, kept text."""
    split = {i: re.findall(common.WORD, t or "") for i, t in rows}
    first = {}
    for i in sorted(split):
        for at in range(len(split[i]) - window + 1):
            first.setdefault(tuple(split[i][at : at + window]), i)
    out = {}
    for i, w in split.items():
        gone = set()
        for at in range(len(w) - window + 1):
            if first[tuple(w[at : at + window])] < i:
                gone.update(range(at, at + window))
        out[i] = (len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone))
    return out


@pytest.mark.parametrize(("hot", "flush"), [(2000, 1 << 20), (2, 1 << 20), (3, 100)])
def test_brute(spark, monkeypatch, hot, flush):
    monkeypatch.setattr(substring_dedup, "FLUSH", flush)
    docs = common.table(spark, "/root/testdata/sf0.001", "documents")
    want = brute([tuple(r) for r in docs.select("doc_id", "text").collect()], 13)
    got = substring_dedup.remove_repeats(docs.repartition(7), hot=hot).collect()
    assert {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_text"]) for r in got} == want
    assert len(got) == len(want) and sum(n for _, n, _ in want.values()) > 0


def test_words_whose_polynomials_are_equal(spark):
    """The doubling sequence of a and b and its complement are different words: nothing is removed, nothing linked."""
    from quire.llm import jaccard_join

    rest, rows = " ".join(f"w{i}" for i in range(12)), []
    for size in (1024, 2048):
        word = "a"
        while len(word) < size:
            word += word.translate(str.maketrans("ab", "ba"))
        rows += [(len(rows) + 1, f"{word} {rest}"), (len(rows) + 2, f"{word.translate(str.maketrans('ab', 'ba'))} {rest}")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert all(r["n_removed"] == 0 for r in substring_dedup.remove_repeats(docs).collect())
    pairs = spark.createDataFrame([(i, t.split()[0] + " x") for i, t in rows], "doc_id bigint, text string")
    assert all(r["component_id"] == r["doc_id"] for r in jaccard_join.jaccard_components(pairs, 1, 50, 100).collect())
