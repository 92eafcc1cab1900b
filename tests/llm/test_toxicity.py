"""The label model on votes drawn from known rates and correlations, and held-out quality on the documents."""

import numpy as np
from pyspark.sql import functions as F

from quire.llm import common, toxicity


def auc(score, label):
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(score))
    rank[order] = np.arange(len(score))
    for s in np.unique(score):  # ties share their mean rank
        rank[score == s] = rank[score == s].mean()
    n = label.sum()
    return (rank[label == 1].sum() - n * (n - 1) / 2) / (n * (len(label) - n))


def test_label_model_finds_rates_and_correlations():
    rng = np.random.default_rng(3)
    y = rng.random(6000) < 0.3
    votes = np.stack([rng.random(len(y)) < np.where(y, a, b) for a, b in ((0.7, 0.05), (0.6, 0.1), (0.5, 0.05), (0.65, 0.15), (0.3, 0.25))], 1)
    copies = np.stack([np.where(rng.random(len(y)) < 0.95, votes[:, 4], ~votes[:, 4]) for _ in range(4)], 1)  # a weak voter, repeated
    votes = np.concatenate([votes, copies], 1).astype(np.float32)
    q, parent = toxicity.label_model(votes, toxicity.first_guess(votes))
    assert abs(q.mean() - 0.3) < 0.05 and ((q > 0.5) == y).mean() > 0.9
    assert {frozenset((i, p)) for i, p in enumerate(parent) if p >= 0} <= {frozenset((i, j)) for i in range(4, 9) for j in range(4, 9)} and (parent >= 0).sum() >= 4


def test_a_voter_outside_the_forest():
    rng = np.random.default_rng(4)
    y = rng.random(3000) < 0.2
    weak = [rng.random(len(y)) < np.where(y, 0.4, 0.05) for _ in range(4)]
    wrong = rng.random(len(y)) < 0.05  # the label errs now and then
    votes = np.stack([*weak, y ^ wrong], 1).astype(np.float32)
    q, parent = toxicity.label_model(votes, (toxicity.first_guess(votes[:, :4]) + 0.1 + 0.8 * votes[:, 4]) / 2, lone=1)
    assert parent[-1] < 0 and ((q > 0.5) == y).mean() > 0.94 and 0.1 < q[wrong & y].mean() > q[wrong & ~y].mean() - 0.5


def test_held_out(spark):
    sf = "/root/testdata/sf0.1"
    got = toxicity.op5_toxicity(spark, sf).join(common.table(spark, sf, "labels"), "doc_id").where("held_out").collect()
    score, label, predicted = (np.array([r[c] for r in got]) for c in ("score", "toxic", "predicted"))
    # some toxic documents of this table hold nothing that the labelled rows tell apart
    assert auc(score, label) > 0.9 and predicted[label == 1].mean() > 0.65 and predicted[label == 0].mean() < 0.01


def test_script_without_spaces(spark):
    rows = [(i, ("你这个蠢货滚开" if i % 3 == 0 else "今天天气很好啊") + "的" * (i % 5), i % 3 == 0) for i in range(240)]
    docs = spark.createDataFrame([(i, t, 1) for i, t, _ in rows], "doc_id bigint, text string, _id int")
    labels = spark.createDataFrame([(i, int(x)) for i, _, x in rows if i < 180], "doc_id bigint, toxic int")
    got = {r["doc_id"]: r["predicted"] for r in toxicity.scored(docs, toxicity.fit(docs, labels)).collect()}
    assert all(got[i] == x for i, _, x in rows)
    left = toxicity.drop_toxic(docs, labels)
    assert left.columns == docs.columns and 0 < left.count() <= 160
    assert toxicity.drop_toxic(docs.where(F.lit(False)), labels).collect() == []
