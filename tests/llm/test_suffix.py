"""Repeated passages against brute force: several holders of short passages in different surroundings."""

import random
import re

import pytest

from quire.llm import common, substring_dedup, suffix_dedup, windows


def brute(rows, passage):
    """The spans of each document that are covered by runs which a smaller document has too."""
    first, out = {}, set()
    for i, text in sorted(rows):
        words = text.split()
        spans = []
        for at in range(len(words) - passage + 1):
            run = tuple(words[at : at + passage])
            if first.setdefault(run, i) < i:
                if spans and at <= spans[-1][1]:
                    spans[-1][1] = at + passage
                else:
                    spans.append([at, at + passage])
        out |= {(i, *s) for s in spans}
    return out


@pytest.mark.parametrize(("hot", "flush", "chunk", "batch"), [(2000, 1 << 20, 1 << 25, 2000), (3, 200, 1 << 25, 7), (2000, 1 << 20, 3000, 1), (5, 100, 1, 2000)])
def test_holders(spark, monkeypatch, hot, flush, chunk, batch):
    monkeypatch.setattr(substring_dedup, "FLUSH", flush)
    monkeypatch.setattr(windows.chunks, "__defaults__", (chunk,))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    rng = random.Random(7)
    fresh = lambda n: [f"w{rng.randrange(10**9)}" for _ in range(n)]
    rows = []
    for holders in (3, 10, 50):
        for length in (49, 50, 51, 55, 60, 70, 84):
            shared = fresh(length)
            rows += [(len(rows) + i, " ".join(fresh(rng.randrange(60)) + shared + fresh(rng.randrange(60)))) for i in range(holders)]
    # two documents share 50 words; decoys share 46 of them on one side, and what surrounds them, with the later one
    core, ahead, behind = fresh(50), fresh(60), fresh(60)
    rows.append((len(rows), " ".join(fresh(40) + core + fresh(40))))
    rows.append((len(rows), " ".join(ahead + core + behind)))
    rows += [(len(rows) + i, " ".join(fresh(9) + core[4:] + behind)) for i in range(8)]
    rows += [(len(rows) + i, " ".join(ahead + core[:46] + fresh(9))) for i in range(8)]
    # one passage twice in a document, one of equal words, and one in a text of its own
    rows += [(len(rows), " ".join(core + fresh(3) + core)), (len(rows) + 1, "same " * 200), (len(rows) + 2, "same " * 120), (len(rows) + 3, " ".join(core))]
    period = fresh(3)
    rows += [(len(rows) + i, " ".join(fresh(i) + period * rng.randrange(20, 60) + fresh(i))) for i in range(12)]
    rows = [(i, t) for i, t in zip(rng.sample(range(10**6), len(rows)), (t for _, t in rows), strict=True)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    try:
        got = suffix_dedup.repeated_passages(docs, hot=hot).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    assert {(r["doc_id"], r["start"], r["stop"]) for r in got} == brute(rows, 50)
    text = {i: t.split() for i, t in rows}
    for r in got:
        assert r["other_id"] < r["doc_id"] and text[r["other_id"]][r["other_start"] :][:50] == text[r["doc_id"]][r["start"] :][:50]


def test_recall_on_documents(spark):
    docs = common.table(spark, "/root/testdata/sf0.001", "documents")
    rows = [(r["doc_id"], r["text"] or "") for r in docs.select("doc_id", "text").collect()]
    split = [(i, " ".join(re.findall(common.WORD, t))) for i, t in rows]
    got = {(r["doc_id"], r["start"], r["stop"]) for r in suffix_dedup.repeated_passages(docs).collect()}
    assert got == brute(split, 50) and got
