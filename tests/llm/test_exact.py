"""The rows that stay when exact copies go."""

from quire.llm import exact_dedup


def test_rows_without_id_and_shared_ids(spark):
    rows = [(None, "first", "a"), (None, "second", "a"), (None, "second", "b"), (1, "one", "a"), (1, "other", "a"), (1, "one", "a"), (2, "one", "a"), (2, "mine", "a"), (3, None, "a"), (4, "", "a")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(3)
    got = exact_dedup.drop_copies(docs)
    assert got.columns == docs.columns
    want = [(None, "first", "a"), (None, "second", "a"), (None, "second", "b"), (1, "one", "a"), (1, "other", "a"), (2, "mine", "a"), (3, None, "a")]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))
