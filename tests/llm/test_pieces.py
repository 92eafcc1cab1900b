"""Pieces and languages: exact round trips, draws that don't depend on batches, texts without spaces, executors without this package."""

import itertools
import pickle
import random
import subprocess
import sys

import numpy as np
import pyarrow as pa
import pytest
from pyspark import cloudpickle

from quire.llm import common, langid, sentencepieces
from quire.llm import lattice as L


@pytest.fixture(scope="module")
def vocabulary():
    return L.load()


def segmentations(unit, v):
    """All ways to cut a unit into pieces, as lists of ids."""
    known = {p: i for i, p in enumerate(v.pieces) if p}
    for cuts in itertools.product((0, 1), repeat=len(unit) - 1):
        edges = [0, *[i + 1 for i, c in enumerate(cuts) if c], len(unit)]
        parts = [unit[a:b] for a, b in itertools.pairwise(edges)]
        if all(p in known for p in parts):
            yield [known[p] for p in parts]


def test_sums_and_expectations(vocabulary):
    """Forward sums and expected uses against all segmentations, with blocks shorter than the units."""
    v, p = vocabulary, L.zipf(vocabulary, 0.5)
    units, weight = [" the", " other", " thereafter", " a"], np.array([1.0, 2.0, 3.0, 4.0])
    total, use = [], np.zeros(len(p))
    for u, w in zip(units, weight, strict=True):
        ways = list(segmentations(u, v))
        chance = np.array([np.prod(p[x]) for x in ways])
        total.append(np.log(chance.sum()))
        for x, c in zip(ways, chance / chance.sum(), strict=True):
            np.add.at(use, x, w * c)
    for block, tiny, long in ((8, 1e-60, 256), (3, 1e9, 256), (3, 1e9, 5), (8, 1e-60, 1)):
        old, (L.BLOCK, L.TINY, L.LONG) = (L.BLOCK, L.TINY, L.LONG), (block, tiny, long)
        try:
            lat = L.build(units, v)
            order = np.empty(len(units))
            order[lat.where] = weight
            np.testing.assert_allclose(L.forward(lat, p[None])[1][0][lat.where], total, rtol=1e-9)
            np.testing.assert_allclose(L.expected(lat, p, order), use, atol=1e-9)
        finally:
            L.BLOCK, L.TINY, L.LONG = old


def test_round_trip_and_batches(spark):
    rng = random.Random(2)
    texts = ["", " ", "  a  b ", "x" * 3000, "▁ ▁", "日本語のテキスト" * 50, "tab\tand\nline", None, "\x00é😀"] + ["".join(rng.choice("ab ü\n中 ") for _ in range(rng.randint(1, 400))) for _ in range(150)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    want = {r["doc_id"]: r["ids"] for r in sentencepieces.encode(docs).collect()}
    back = {r["doc_id"]: r["text"] for r in sentencepieces.decode(sentencepieces.encode(docs)).collect()}
    assert [back[i] for i in range(len(texts))] == [t or "" for t in texts]
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(key)
    try:
        spark.conf.set(key, "7")
        assert {r["doc_id"]: r["ids"] for r in sentencepieces.encode(docs.repartition(5)).collect()} == want
    finally:
        spark.conf.set(key, old)


def test_texts_without_spaces(spark):
    rng = random.Random(4)
    kinds = {"zh": "的一是不了人我在有他这中大来上国个到说们", "ja": "のにはをたがでてとしれさあるいなかもすま"}
    rows = [(i, lang, "".join(rng.choice(signs) for _ in range(80))) for i, (lang, signs) in enumerate([x for x in kinds.items() for _ in range(60)])]
    docs = spark.createDataFrame(rows, "doc_id bigint, lang string, text string")
    model = langid.fit(docs.where("doc_id % 2 = 0"))
    got = {r["doc_id"]: r["lang_pred"] for r in langid.predict(docs, model).collect()}
    assert [got[i] for i, _, _ in rows] == [lang for _, lang, _ in rows]


def test_held_out_languages_and_batches(spark):
    docs = common.table(spark, "/root/testdata/sf0.01", "documents")
    model = langid.fit(docs, common.crc_mod(docs["doc_id"], 3) != 1)
    got = langid.predict(docs.repartition(3), model)
    rows = got.join(docs.select("doc_id", "lang"), "doc_id").where("held_out and lang is not null and lang_pred <> 'und'").collect()
    assert len(rows) > 200 and sum(r["lang"] == r["lang_pred"] for r in rows) > 0.97 * len(rows)
    again = {r["doc_id"]: r["score"] for r in langid.predict(docs.repartition(7), model).collect()}
    assert {r["doc_id"]: r["score"] for r in got.collect()} == again


def test_executors_need_no_package(vocabulary, tmp_path):
    """The kernels and what is broadcast to them run in an interpreter that can't import this package."""

    class Held:
        def __init__(self, value):
            self.value = value

    p = L.zipf(vocabulary)
    for kernel, names in ((sentencepieces._encode, ["doc_id", "key", "text"]),):
        sent = pickle.dumps((L.plain(vocabulary), p))  # as a broadcast is
        cloudpickle.register_pickle_by_value(sys.modules[__name__])
        (tmp_path / "job").write_bytes(cloudpickle.dumps((lambda sent, k=kernel: k(Held(pickle.loads(sent)), 1, False))))
        (tmp_path / "sent").write_bytes(sent)
        batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([5]), pa.array([" some text"])], names)
        (tmp_path / "batch").write_bytes(pickle.dumps(batch))
        run = "import pickle, sys; f = lambda n: open(sys.argv[1] + '/' + n, 'rb').read(); k = pickle.loads(f('job'))(f('sent')); print(sum(b.num_rows for b in k([pickle.loads(f('batch'))]))); assert 'quire' not in sys.modules"
        out = subprocess.run([sys.executable, "-c", run, str(tmp_path)], cwd=tmp_path, env={"PATH": "/usr/bin:/bin"}, capture_output=True, text=True)
        assert out.stdout.strip() == "1", out.stderr


RARE = "".join(chr(c) for c in range(0x3400, 0x3400 + 200))


@pytest.mark.parametrize("run", [RARE[:30], RARE, RARE * 25, "\U0001FAE0" * 200, "\U00020000" * 300])
def test_runs_of_rare_characters(vocabulary, run):
    """Sums stay finite and equal those of the parts; what follows such a run is drawn from the lattice and differs between keys."""
    v, p = vocabulary, L.zipf(vocabulary, 0.3)
    n_bytes = len(run[0].encode())
    lone = sum(L.build([c], v).ids[0, 0] > len(v.pieces) for c in set(run))
    assert lone == len(set(run))
    p = p.copy()
    p[[vocabulary.pieces.index(x) for x in ("the", "th", "he", "t", "h", "e")]] = 0.3, 0.1, 0.1, 0.5, 0.4, 0.3
    both = np.stack([p, L.zipf(vocabulary, 1.0)])
    lat = L.build([f" the{run}", " the"], v)
    _, logs, _ = L.forward(lat, both)
    whole, short = logs[:, lat.where[0]], logs[:, lat.where[1]]
    np.testing.assert_allclose(whole, short + len(run) * np.log(both[:, len(v.pieces) + n_bytes]), rtol=1e-9)
    use = L.expected(lat, p, np.ones(2))
    assert np.isfinite(use).all() and use[len(v.pieces) + n_bytes] == pytest.approx(len(run), rel=1e-6)
    unit = f" {run}the"
    lat = L.build([unit], v)
    alpha, _, shift = L.forward(lat, p[None])
    n = 20000 if len(run) < 1000 else 300
    pieces, count, stop = L.sample(lat, alpha[0], shift, p, np.zeros(n, np.int64), common.mix(np.arange(n)))
    seen = {}
    for i in range(n):
        own = pieces[stop[i] - count[i] : stop[i]]
        tail = tuple(own[len(run) + 1 :].tolist())
        seen[tail] = seen.get(tail, 0) + 1
        assert (own[1 : len(run) + 1] == [-1 - ord(c) for c in run]).all() if i < 3 else True
    ways = {tuple(x): np.prod(p[x]) for x in segmentations("the", v)}
    assert set(seen) <= set(ways)
    for k, w in ways.items():
        want = n * w / sum(ways.values())
        assert abs(seen.get(k, 0) - want) < 5 * want**0.5 + 3


def test_languages_with_rare_characters(spark):
    """A foreign run in a text, or in the training texts, leaves scores finite and the language right."""
    english = ["the house and the garden of the king", "a man went to the city with his friend", "there is nothing that the people want"]
    french = ["la maison et le jardin du roi", "un homme est allé dans la ville avec son ami", "il n'y a rien que les gens veulent"]
    rows = [(i, t, lang) for i, (t, lang) in enumerate([(f"{t} {i}", "en") for i in range(20) for t in english] + [(f"{t} {i}", "fr") for i in range(20) for t in french])]
    train = spark.createDataFrame([*rows, (900, f"the {RARE} king", "en"), (901, "本" * 500, "fr")], "doc_id bigint, text string, lang string")
    model = langid.fit(train)
    assert np.isfinite(model.p).all()
    given = [(1, f"the people of {RARE[:30]} want the garden", "en"), (2, f"les gens {RARE * 25} dans la ville", "fr"), (3, "the man " + "😀" * 200 + " and the friend", "en"), (4, RARE * 25, None), (5, "日" * 5000 + " the king of the city", "en")]
    got = langid.predict(spark.createDataFrame([(i, t) for i, t, _ in given], "doc_id bigint, text string"), model).collect()
    for r in got:
        assert 0 <= r["score"] <= 1 and r["score"] == r["score"]
        assert given[r["doc_id"] - 1][2] in (None, r["lang_pred"])


def test_a_million_characters_without_a_space(vocabulary):
    import time

    v = vocabulary
    text = " " + "".join(chr(0x4E00 + (i * i) % 3000) for i in range(400_000)) + "thecat" * 100_000
    began = time.time()
    pieces, count = sentencepieces._draw(v, L.zipf(v), pa.array([text], pa.large_string()), np.array([7], np.uint64))
    ids, _ = sentencepieces.expand(pieces, v.byte_base, count)
    assert sentencepieces.decode_ids(ids.tolist(), sentencepieces.byte_table(v)) == text[1:] and time.time() - began < 60
