"""Every operator on nulls, empty and long texts, repeated rows, an empty table and clashing extra columns."""

import re

import pytest

from quire.llm import exact_dedup, fingerprint, jaccard_join, langid, licenses, mixing, sentencepieces, substring_dedup, suffix_dedup, toxicity

PASSAGE = " ".join(f"passage{i}" for i in range(60))
ROWS = [
    (1, None, None, None), (2, "", "en", "a"), (3, " \t\n", "en", "a"), (4, "one", "en", None), (5, f"x y z {PASSAGE} u v w", "en", "a"),
    (6, f"other start {PASSAGE} other end", "en", "b"), (7, "one", "de", "b"), (7, "one", "de", "b"), (8, "Long " * 30000, "en", "a"), (None, "one", "en", "a"),
    (9, "Über Größe ▁ 😀 straße", "de", "c"), (10, "x" * 20000, "en", "c"),
]
SCHEMA = "doc_id bigint, text string, lang string, source string, n bigint, words string, target string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, 1, "w", "t") for r in ROWS], SCHEMA).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def rows(df):
    return sorted(df.collect(), key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0))


def test_exact(docs, empty):
    got = {r["doc_id"]: r for r in rows(exact_dedup.exact_groups(docs, 4, 4))}
    assert len(rows(exact_dedup.exact_groups(docs))) == len(ROWS)
    assert (got[7]["keep_id"], got[7]["group_size"], got[7]["kept"]) == (4, 3, False) and got[1]["kept"] and got[2]["keep_id"] == 1 and got[3]["keep_id"] == 3
    assert got[None]["keep_id"] is None and got[None]["kept"]
    assert rows(exact_dedup.exact_groups(empty)) == []


def test_jaccard(docs, empty):
    got = {r["doc_id"]: r for r in rows(jaccard_join.jaccard_components(docs, 3, 90, 100))}
    assert got[1]["n_shingles"] == got[2]["n_shingles"] == 0 and got[2]["component_id"] == 2 and got[7]["component_id"] == 4 and got[8]["n_shingles"] == 1
    assert rows(jaccard_join.jaccard_components(empty)) == []


def test_passages(docs, empty):
    got = {r["doc_id"]: r for r in rows(substring_dedup.remove_repeats(docs))}
    assert len(rows(substring_dedup.remove_repeats(docs))) == len(ROWS)
    assert got[6]["n_removed"] == 60 and got[6]["kept_text"] == "other start other end" and got[5]["n_removed"] == 0 and got[8]["n_removed"] == 0 and got[1]["n_words"] == 0
    assert rows(substring_dedup.remove_repeats(empty)) == []
    (found,) = rows(suffix_dedup.repeated_passages(docs))
    assert (found["doc_id"], found["start"], found["stop"], found["other_id"], found["other_start"]) == (6, 2, 62, 5, 3)
    assert rows(suffix_dedup.repeated_passages(empty)) == []


def test_pieces_and_languages(docs, empty):
    assert all(r["lossless"] for r in sentencepieces.encode_report(docs).collect())
    encoded = sentencepieces.encode(docs)
    assert sorted(r["text"] for r in sentencepieces.decode(encoded).collect()) == sorted(r[1] or "" for r in ROWS)
    model = langid.fit(docs)
    got = {r["doc_id"]: r for r in rows(langid.predict(docs, model))}
    assert got[1]["lang_pred"] == got[3]["lang_pred"] == "und" and got[8]["lang_pred"] == "en" and all(0 <= r["score"] <= 1 for r in got.values())
    assert rows(langid.predict(empty, langid.fit(empty))) == [] and rows(sentencepieces.encode(empty)) == []


def test_mix_and_fingerprints(docs, empty):
    got = rows(mixing.mix(docs))
    assert len(got) == len(ROWS) and all(r["taken"] <= 3 * r["size"] for r in got)
    assert abs(sum({r["source_size"]: r["target"] for r in got}.values()) - sum(r["size"] for r in got)) < 1e-6
    assert rows(mixing.mix(empty)) == [] and mixing.mixed(docs).columns == docs.columns
    got = rows(fingerprint.edit_report(docs, 1000))
    by_text = {}
    for r, (_, text, *_rest) in zip(rows(fingerprint.edit_report(docs)), sorted(ROWS, key=lambda r: (r[0] is None, r[0] or 0)), strict=True):
        by_text.setdefault(text or "", set()).add(r["fingerprint"])
    assert all(len(v) == 1 for v in by_text.values()) and len(got) == len(ROWS)
    assert rows(fingerprint.edit_report(empty)) == []


def test_toxicity_and_licences(spark, docs, empty):
    labels = spark.createDataFrame([(2, 0), (4, None), (5, 1)], "doc_id bigint, toxic int")
    got = toxicity.scored(docs, toxicity.fit(docs, labels)).collect()
    assert len(got) == len(ROWS) and all(0 <= r["score"] <= 1 for r in got)
    extra = spark.createDataFrame([(1, "Released under the MIT License.\nplain words"), (2, "a license for fishing"), (3, None)], "doc_id bigint, text string")
    found = {r["doc_id"]: r for r in rows(licenses.scan(extra))}
    assert found[1]["families"] == "MIT" and found[1]["n_paragraphs"] == 1 and found[2]["families"] == "" and found[3]["n_paragraphs"] == 0
    assert rows(licenses.scan(empty)) == [] and len(rows(licenses.scan(docs))) == len(ROWS)


def test_piece_draws_follow_the_lattice(spark):
    """Sampled segmentations of one word come in the proportions of their probabilities."""
    from quire.llm import lattice as L

    v = L.load()
    p = L.zipf(v, 0.3)
    lat = L.build([" the"], v)
    alpha, _, _ = L.forward(lat, p[None])
    import numpy as np

    n = 20000
    pieces, count, stop = L.sample(lat, alpha[0], None, p, np.zeros(n, np.int64), np.arange(n).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    seen = {}
    for i in range(n):
        key = tuple(pieces[stop[i] - count[i] : stop[i]].tolist())
        seen[key] = seen.get(key, 0) + 1
    weight = {k: np.prod([p[i] for i in k]) for k in seen}
    total = sum(weight.values())
    for k, c in seen.items():
        assert abs(c / n - weight[k] / total) < 0.02
    assert all(re.sub("", "", "".join(v.pieces[i] for i in k)) == " the" for k in seen)
