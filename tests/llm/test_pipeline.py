"""The pipeline on edge rows with clashing columns, on an empty table, and against its stages' own rules."""

import corpus_pipeline

from quire.llm import common

PROSE = [" ".join(f"w{i}x{j}" for j in range(60)) for i in range(12)]
EXTRA = {"_id": 1, "_times": 2, "_copy": 3, "_gone": 4, "_kept_id": 5, "_sha": 6, "words": 7, "n": 8, "size": 9, "unit": 10, "t": 11, "id": 12, "key": 13}
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, " + ", ".join(f"{c} int" for c in EXTRA)


def row(i, text, source="a"):
    return (i, text, "en", source, 0, *EXTRA.values())


ROWS = [
    row(1, None), row(2, ""), row(3, " \t"), row(None, "no id one"), row(None, "no id two"), *[row(10 + i, t, "ab"[i % 2]) for i, t in enumerate(PROSE)],
    row(40, PROSE[0]), row(41, PROSE[0] + " tail"), row(42, "you idiot moron scum stupid trash"), row(43, PROSE[5]), row(43, PROSE[5]), row(44, "word " * 20000, None),
]


def folder(spark, tmp_path, rows):
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(10, 0), (42, 1)], "doc_id bigint, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    return str(tmp_path)


def test_edge_rows(spark, tmp_path):
    sf_dir = folder(spark, tmp_path, ROWS)
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, sf_dir)
        assert kept.columns == docs.columns, name
        rows = kept.collect()
        ids = [r["doc_id"] for r in rows]
        assert {tuple(r)[5:] for r in rows} == {tuple(EXTRA.values())}
        if name == "toxicity":
            assert 42 not in ids and len(ids) == len(ROWS) - 1
        if name == "exact dedup":
            assert sorted(i for i in ids if i is not None) == [1, 3, *range(10, 22), 41, 44] and ids.count(None) == 2
        if name == "n-gram jaccard join":
            assert sorted(i for i in ids if i is not None) == [1, 3, *range(10, 22), 44] and ids.count(None) == 2
        docs = spark.createDataFrame(rows, docs.schema)
    got = corpus_pipeline.run(spark, sf_dir).collect()
    assert got and {r["doc_id"] for r in got} <= {None, 1, 3, *range(10, 22), 44} and all(len(r["ids"]) > 0 for r in got if r["doc_id"] not in (1, None))


def test_empty_table(spark, tmp_path):
    assert corpus_pipeline.run(spark, folder(spark, tmp_path, [])).collect() == []


