"""Language identification by segmentation-marginalised unigrams.

Each language has its own probabilities of the pieces of a fixed public vocabulary; the probability of a word is the sum over
all its segmentations, by the forward algorithm. They are estimated by expectation-maximisation over the words of a bounded
sample of labelled documents for each language (`fit_docs`), long words and texts without spaces included. A text's score is the sum over all of its words, each word's once
computed for a batch.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C
from . import lattice as L

C.by_value(__name__)

FIT_DOCS, ROUNDS, PRIOR = 600, 3, 500.0
WORDS_A_CALL = 500_000


class Model:
    def __init__(self, langs: list[str], p: np.ndarray, prior: np.ndarray):
        self.langs, self.p, self.prior = langs, p, prior


def fit(docs: DataFrame, train: Column | None = None, model: str = L.DEFAULT_MODEL, fit_docs: int = FIT_DOCS, rounds: int = ROUNDS) -> Model:
    """Estimate from text and lang of rows that meet `train`: about fit_docs documents of each language, chosen by a hash of the id."""
    v = L.load(model)
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    rows = rows.where(train) if train is not None else rows
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    langs = sorted(sizes)
    if not langs:
        return Model([], np.zeros((0, len(v.pieces) + 5)), np.zeros(0))
    take = F.create_map(*[F.lit(x) for lang in langs for x in (lang, min(1.0, fit_docs / sizes[lang]))])
    part = F.pmod(F.coalesce(F.xxhash64("doc_id"), F.lit(0)), F.lit(1_000_000)) / 1e6
    words = rows.where(part <= F.element_at(take, F.col("lang"))).select("lang", F.explode(C.words(F.col("text"))).alias("w")).groupBy("lang", "w").count().toArrow()
    lang, unit, n = words["lang"].to_numpy(), words["w"].to_pylist(), words["count"].to_numpy().astype(float)
    start = L.zipf(v)
    normal = len(v.pieces)
    p = np.tile(start, (len(langs), 1))
    everywhere = np.zeros(normal)
    own = []
    for i, name in enumerate(langs):
        at = np.flatnonzero(lang == name)
        lat = L.build([" " + unit[j] for j in at], v)
        weight = np.empty(len(at))
        weight[lat.where] = n[at]
        own.append((lat, weight))
    for step in range(rounds):
        counts = [L.expected(lat, p[i], weight)[:normal] for i, (lat, weight) in enumerate(own)]
        everywhere = sum(c / max(c.sum(), 1) for c in counts) / len(langs)
        everywhere = (everywhere + 0.01 * start[:normal]) / 1.01
        # the same share of every language, so that pieces which none has learned tell nothing
        share = PRIOR / (sum(c.sum() for c in counts) / len(langs) + PRIOR)
        p = L.with_fallback(np.stack([(1 - share) * c / max(c.sum(), 1e-300) + share * everywhere for c in counts]))
    total = np.array([sizes[x] for x in langs], float)
    return Model(langs, p, np.log(total / total.sum()))


def _predict(shared):
    def run(batches):
        fields, langs, p, prior = shared.value
        v = L.Vocabulary(*fields)
        for whole in batches:
            for b in _parts(whole):
                column = b.column("words")
                off = column.offsets.to_numpy().astype(np.int64)
                z = np.repeat(prior[:, None], b.num_rows, 1)
                # each row is summed by itself, a longer one in steps, so its score doesn't depend on its neighbours
                for at in range(off[0], off[-1], WORDS_A_CALL):
                    to = min(at + WORDS_A_CALL, int(off[-1]))
                    coded = column.values.slice(at, to - at).dictionary_encode()
                    lat = L.build([" " + w for w in coded.dictionary.to_pylist()], v)
                    _, logs, _ = L.forward(lat, p)
                    each = logs[:, lat.where][:, coded.indices.to_numpy()]
                    own = np.clip(off, at, to) - at
                    full = np.flatnonzero(np.diff(own))
                    z[:, full] += np.add.reduceat(each, own[:-1][full], 1)
                z = np.exp(z - z.max(0)) if len(langs) else z
                best = z.argmax(0) if len(langs) else None
                known = b.column("known").to_pylist()
                lang = ["und" if best is None or not k else langs[i] for i, k in zip(best if best is not None else known, known, strict=True)]
                top = z.max(0) / z.sum(0) if best is not None else np.zeros(b.num_rows)
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), pa.array(lang, pa.string()), pa.array(np.where(np.array(known, bool), top, 0.0))], ["doc_id", "held_out", "lang_pred", "score"])

    return run


def _parts(batch: pa.RecordBatch):
    ends = batch.column("words").offsets.to_numpy().astype(np.int64)
    ends = ends - ends[0]
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(ends, ends[at] + WORDS_A_CALL, "right")) - 1)
        yield batch.slice(at, to - at)
        at = to


def predict(docs: DataFrame, model: Model, vocabulary: str = L.DEFAULT_MODEL) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row of docs, from the whole text: the likeliest language and its posterior.

    Texts that are null or hold no letter are `und` with score 0, and so is everything when nothing was learned. Ties go to the
    language that comes first by code point. Rows that repeat are scored alike; an empty table gives no rows.
    """
    spark = docs.sparkSession
    C.small_batches(spark)
    shared = spark.sparkContext.broadcast((L.plain(L.load(vocabulary)), model.langs, model.p, model.prior))
    text = docs["text"]
    rows = docs.select("doc_id", (C.crc_mod(docs["doc_id"], 3) == 1).alias("held_out"), F.coalesce(text.rlike("\\p{L}"), F.lit(False)).alias("known"), C.words(text).alias("words"))
    return rows.mapInArrow(_predict(shared), "doc_id bigint, held_out boolean, lang_pred string, score double")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`predict` over all documents, learned from those whose crc32 modulo 3 isn't 1."""
    docs = C.table(spark, sf_dir, "documents")
    return predict(docs, fit(docs, C.crc_mod(F.col("doc_id"), 3) != 1))
