"""Toxicity by weak supervision.

Voters are lexicon entries (a small public list, and words and stems that labelled training rows show to go with the label) and
patterns of writing that use no label. Training rows are dealt into folds, and an entry votes on a row only if the other folds
alone show it, so no row's label has a part in its own votes. The label given to a row is one more voter, which may err like the
others. A generative label model with a hidden class estimates by expectation-maximisation how often each voter fires in either
class, and how voters depend on each other: once the class is known, the strongest correlations that are left make a forest, and
a voter's rate then depends on the class and on its neighbour's vote. A linear classifier is trained on the model's posterior
labels and applied to whole texts with built-in functions only. Fitting takes a bounded sample of labelled rows (`fit_rows`).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

#: Fixed public words that start the lexicon.
SEED_WORDS = ("clown", "disgusting", "idiot", "loser", "moron", "pathetic", "scum", "stupid", "trash", "worthless")
FIT_ROWS, FOLDS = 10_000, 5
#: Lengths of the first letters of a word that are entries of their own, and standard errors of the bound that an entry must pass.
STEMS, ERRORS = (4, 5, 6), 2.0
#: Correlations, given the class, that the label model takes up.
CORRELATED = 0.2
#: Scripts whose words aren't set apart: their pairs of characters count as words.
CLOSED = "\\p{IsHan}\\p{IsHiragana}\\p{IsKatakana}\\p{IsThai}\\p{IsLao}\\p{IsKhmer}\\p{IsMyanmar}"


def letters(text: Column) -> Column:
    """The runs of letters of the whole text, in lower case, and the pairs of characters of scripts without spaces."""
    t = F.lower(F.coalesce(text, F.lit("")))
    pairs = F.when(t.rlike(f"[{CLOSED}]"), F.regexp_extract_all(t, F.lit(f"(?=([{CLOSED}]{{2}}))"), F.lit(1)))
    return F.concat(F.split(t, "[^\\p{L}]+"), F.coalesce(pairs, F.array().cast("array<string>")))


def patterns(text: Column) -> dict[str, Column]:
    """Voters that know no words of the lexicon: shouting, addressing someone, masked words, drawn-out letters."""
    t = F.coalesce(text, F.lit(""))
    return {
        "cries": F.length(t) - F.length(F.replace(t, F.lit("!"), F.lit(""))) >= 3,
        "shouts": t.rlike("\\b\\p{Lu}{3,} \\p{Lu}{3,}\\b"),
        "addresses": t.rlike("(?i)\\byou(?:'re| are| all)\\b"),
        "masks": t.rlike("\\p{L}[*#@$%]{2,}"),
        "draws out": t.rlike("(\\p{L})\\1{3,}"),
    }


def entries(text: Column) -> Column:
    """What the lexicon is held against: the different words of a text, and their stems, marked by a hyphen."""
    words = F.array(F.struct(F.array_distinct(letters(text)).alias("w")))
    with_stems = lambda s: F.concat(s["w"], *[F.transform(F.filter(s["w"], lambda x, n=n: F.length(x) > n), lambda x, n=n: F.concat(F.left(x, F.lit(n)), F.lit("-"))) for n in STEMS])
    return F.array_distinct(F.transform(words, with_stems)[0])


@dataclass
class Model:
    lexicon: list[str]
    weights: list[float]
    patterns: list[float]
    bias: float


def _hits(text: Column, lexicon: list[str]) -> Column:
    return F.array_intersect(entries(text), F.array(*map(F.lit, lexicon)))


def forest(corr: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Each voter's parent (-1: none) and tree in the maximum spanning forest of the correlations above `least`."""
    m = len(corr)
    i, j = np.nonzero(np.triu(corr > least, 1))
    root, near = list(range(m)), [[] for _ in range(m)]

    def find(x):
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    for e in np.argsort(-corr[i, j], kind="stable"):
        a, b = find(int(i[e])), find(int(j[e]))
        if a != b:
            root[a] = b
            near[i[e]].append(int(j[e]))
            near[j[e]].append(int(i[e]))
    parent, tree = np.full(m, -1), np.full(m, -1)
    for start in range(m):
        queue = [] if tree[start] >= 0 else [start]
        while queue:
            x = queue.pop()
            tree[x] = start
            for y in near[x]:
                if tree[y] < 0 and y != parent[x]:
                    parent[y] = x
                    queue.append(y)
    return parent, tree


def _correlations(votes: np.ndarray, classes: list[np.ndarray]) -> np.ndarray:
    """How far voters go together within the classes; classes holds each one's share of every row."""
    cov = sum(((votes - r) * w[:, None]).T @ (votes - r) for w in classes for r in [(votes.T @ w + 0.5) / (w.sum() + 1)]) / len(votes)
    scale = np.sqrt(np.diag(cov)) + 1e-9
    return np.abs(cov) / np.outer(scale, scale)


def first_guess(votes: np.ndarray) -> np.ndarray:
    """A posterior from counting votes: voters that mostly fire together have one vote between them."""
    _, tree = forest(_correlations(votes, [np.ones(len(votes))]), 0.7)
    each = np.bincount(tree, minlength=votes.shape[1])[tree]
    return 1 - 0.8 / (1 + (votes / each).sum(1)) - 0.15


def label_model(votes: np.ndarray, start: np.ndarray, lone: int = 0, rounds: int = 30) -> tuple[np.ndarray, np.ndarray]:
    """Posterior of class 1 for each row of 0/1 votes, and each voter's parent in the forest of correlations.

    start: a first guess of the posterior, which also tells the classes apart. The last `lone` voters depend on the class only.
    """
    votes = votes.astype(np.float32)
    q = np.clip(start.astype(float), 0.01, 0.99)
    for step in range(rounds):
        if step in (0, 5, 15):
            corr = _correlations(votes, [q, 1 - q])
            corr[:, len(corr) - lone :] = 0
            parent, _ = forest(corr, CORRELATED if step else 0.5)
            other = np.where(parent >= 0, votes[:, parent], np.float32(0))
            both = votes * other
        z = np.full(len(votes), np.log((q.sum() + 1) / (len(q) - q.sum() + 1)))
        for w, sign in ((q, 1.0), (1 - q, -1.0)):
            fired, given, together, total = votes.T @ w, other.T @ w, both.T @ w, w.sum()
            rate = (fired + 0.5) / (total + 1)
            # a voter's rate where its parent is silent, and where it fires, drawn towards its rate in the class
            p0, p1 = (fired - together + 2 * rate) / (total - given + 2), (together + 2 * rate) / (given + 2)
            yes0, no0, yes1, no1 = np.log(p0), np.log1p(-p0), np.log(p1), np.log1p(-p1)
            z += sign * (no0.sum() + votes @ (yes0 - no0) + other @ (no1 - no0) + both @ (yes1 - no1 - yes0 + no0))
        q = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    return q, parent


def linear(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 40) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels by damped Newton steps; the bias isn't penalised."""
    # rows of equal votes are one, with their mean label and their number
    x, group, n = np.unique(x, axis=0, return_inverse=True, return_counts=True)
    y = np.bincount(group.ravel(), y) / n
    x1 = np.column_stack([x, np.ones(len(x))])
    w, pen = np.zeros(x1.shape[1]), np.full(x1.shape[1], ridge)
    pen[-1] = 1e-3
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x1 @ w, -30, 30)))
        h = (x1 * (n * (p * (1 - p) + 1e-4))[:, None]).T @ x1 + np.diag(pen)
        step = np.linalg.solve(h, x1.T @ (n * (y - p)) - pen * w)
        w += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return w[:-1], float(w[-1])


def fit(docs: DataFrame, labels: DataFrame, train: Column | None = None, fit_rows: int = FIT_ROWS) -> Model:
    """Fit on at most fit_rows of labels (doc_id, toxic) that meet `train`, those with the smallest hash of the id.

    Labels other than 0 and 1 are left out. With too few rows, or none that any lexicon entry marks, the public words alone
    decide. Columns of docs other than doc_id and text are ignored, whatever their names.
    """
    ids = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
    ids = ids.where(train) if train is not None else ids
    ids = ids.groupBy(F.col("doc_id").alias("id")).agg(F.max("toxic").cast("int").alias("toxic")).orderBy(F.xxhash64("id"), "id").limit(fit_rows)
    ids = ids.withColumn("fold", F.pmod(C.digest(F.col("id"), 1), F.lit(FOLDS)).cast("int"))
    sample = docs.select("doc_id", "text").join(F.broadcast(ids), F.col("doc_id") == F.col("id")).select("fold", "toxic", "text")
    spread = sample.select("fold", "toxic", F.explode(entries(F.col("text"))).alias("word")).where("length(word) > 1")
    in_fold = [F.col("fold") == f for f in range(FOLDS)]
    counts = spread.groupBy("word").agg(
        F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("k"),
        F.array(*[F.count_if(x) for x in in_fold]).alias("ns"), F.array(*[F.coalesce(F.sum(F.when(x, F.col("toxic"))), F.lit(0)) for x in in_fold]).alias("ks"),
    )

    def shown(k: Column, n: Column) -> Column:
        """Whether the lower bound of the share of toxic rows among those with the entry (Wilson) is at least a half."""
        z2 = ERRORS**2
        k, n = k.cast("double"), n.cast("double")
        share = k / n
        low = (share + z2 / (2 * n) - ERRORS * F.sqrt(share * (1 - share) / n + z2 / (4 * n * n))) / (1 + z2 / n)
        return F.coalesce((n > 0) & (F.when(n > 0, low) >= 0.5), F.lit(False))

    without = F.array(*[shown(F.col("k") - F.col("ks")[f], F.col("n") - F.col("ns")[f]) for f in range(FOLDS)])
    mined = counts.select("word", shown(F.col("k"), F.col("n")).alias("all"), without.alias("without")).where(F.col("all") | F.array_contains("without", True)).collect()
    lexicon = sorted({*SEED_WORDS, *(r["word"] for r in mined)})
    at = {w: i for i, w in enumerate(lexicon)}
    votes_in, last = np.zeros((FOLDS, len(lexicon)), bool), np.zeros(len(lexicon), bool)
    for r in mined:
        votes_in[:, at[r["word"]]], last[at[r["word"]]] = r["without"], r["all"]
    public = [at[w] for w in SEED_WORDS]
    votes_in[:, public] = last[public] = True
    marks = patterns(F.col("text"))
    rows = sample.select("fold", "toxic", _hits(F.col("text"), lexicon).alias("hits"), F.array(*[c.cast("int") for c in marks.values()]).alias("marks")).collect()
    votes = np.zeros((len(rows), len(lexicon) + len(marks)), np.float32)
    for i, r in enumerate(rows):
        votes[i, [j for j in (at[w] for w in r["hits"]) if votes_in[r["fold"], j]]] = 1
        votes[i, len(lexicon) :] = r["marks"]
    found = votes[:, : len(lexicon)].any(1).sum()
    if len(rows) < 20 or not 2 <= found <= len(rows) - 2:
        return Model(list(SEED_WORDS), [3.0] * len(SEED_WORDS), [0.0] * len(marks), -2.0)
    given = np.array([r["toxic"] for r in rows], np.float32)
    start = (first_guess(votes[:, : len(lexicon)]) + 0.1 + 0.8 * given) / 2
    q, _ = label_model(np.column_stack([votes, given]), start, lone=1)
    w, bias = linear(votes, q)
    keep = np.flatnonzero(last)
    return Model([lexicon[i] for i in keep], w[keep].tolist(), w[len(lexicon) :].tolist(), bias)


def score(text: Column, model: Model) -> Column:
    """The classifier's probability of label 1, from the whole text; null and empty texts have no votes."""
    weight = F.map_from_arrays(F.array(*map(F.lit, model.lexicon)), F.array(*map(F.lit, model.weights)))
    z = F.aggregate(_hits(text, model.lexicon), F.lit(model.bias), lambda a, w: a + F.element_at(weight, w))
    for fires, w in zip(patterns(text).values(), model.patterns, strict=True):
        z = z + F.when(fires, w).otherwise(0.0)
    return 1 / (1 + F.exp(-z))


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of docs; rows that repeat are scored alike. Other columns are ignored; an empty table gives no rows."""
    out = docs.select("doc_id", (C.crc_mod(docs["doc_id"], 5) == 0).alias("held_out"), score(docs["text"], model).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def train_rows(doc_id: Column) -> Column:
    return C.crc_mod(doc_id, 5) != 0


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs without the rows that the classifier, fitted on the labels, scores at 0.5 or more.

    Null and empty texts and rows without doc_id are scored like others. All columns stay, whatever their names; an empty table
    stays empty.
    """
    model = fit(docs, labels, train_rows(F.col("doc_id")))
    return docs.where(score(docs["text"], model) < 0.5)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`scored` over all documents, fitted on labels whose crc32 of doc_id modulo 5 isn't 0."""
    docs, labels = C.table(spark, sf_dir, "documents"), C.table(spark, sf_dir, "labels")
    return scored(docs, fit(docs, labels, train_rows(F.col("doc_id"))))
