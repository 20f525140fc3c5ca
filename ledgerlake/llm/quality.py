"""Quality classifier by co-training of two views.

One logistic regression sees what a text looks like, the other only what is known about the page
(source, language, size).  Both start from the labelled documents; in each round a view hands the
pool's documents that it is surest about, of each class by rank, to the other view as pseudo-labels.  A
pseudo-label weighs as much as its giver ranks held-out documents better than chance, so a view that
knows little teaches little.  At the end both views are calibrated on labelled documents that neither
was trained on, and a last regression over the two calibrated logits gives the score.

Scale: the fit sees at most ``MAX_LABELLED`` labelled documents and a pool of ``POOL`` unlabelled
ones, chosen by the hash of their id; their feature rows are collected, whatever the corpus' size.
Scoring is one pass over all documents and whole texts, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import first_by_hash

#: Bounds of what is collected to fit the classifier: documents with a label, and without one.
MAX_LABELLED, POOL = 8000, 4000
ROUNDS = 4
#: One of so many pool documents more a round is handed on by each view, in the classes' proportion.
HANDED = 16
THRESHOLD = 0.5
META_BUCKETS = 32

TEXT_FEATURES = 128 + 9
META_FEATURES = 2 * META_BUCKETS + 4


def text_features(texts: pd.Series) -> np.ndarray:
    """Per text: shares of ASCII bytes, non-ASCII share, and what its words look like.  Null is empty."""
    out = np.zeros((len(texts), TEXT_FEATURES), dtype=np.float32)
    for k, text in enumerate(texts):
        if not isinstance(text, str) or not text:
            continue
        raw = np.frombuffer(text.encode("utf-8", "replace"), dtype=np.uint8)
        shares = np.bincount(raw, minlength=256) / len(raw)
        words = text.split()
        n = max(1, len(words))
        distinct = len(set(words))
        out[k, :128] = np.sqrt(shares[:128])
        out[k, 128:] = (shares[128:].sum(), np.log1p(len(raw)), np.log1p(len(words)), len(text) / n / 10, distinct / n,
                        sum(map(str.__eq__, words, words[1:])) / n, text.count("\n") / n, shares[65:91].sum(),
                        shares[33:48].sum() + shares[58:65].sum() + shares[91:97].sum() + shares[123:127].sum())
    return out


def _bucket(values: pd.Series) -> np.ndarray:
    """A stable bucket of a text value; null is a value of its own."""
    return (pd.util.hash_array(values.fillna("\0").astype(str).to_numpy(dtype=object), hash_key="0123456789abcdef")
            % META_BUCKETS).astype(int)


def meta_features(source: pd.Series, lang: pd.Series, n_chars: pd.Series) -> np.ndarray:
    out = np.zeros((len(source), META_FEATURES), dtype=np.float32)
    rows = np.arange(len(source))
    out[rows, _bucket(source)] = 1
    out[rows, META_BUCKETS + _bucket(lang)] = 1
    size = pd.to_numeric(n_chars).to_numpy(dtype=float, na_value=-1.0)
    known = size >= 0
    log = np.log1p(np.where(known, size, 0))
    out[:, -4], out[:, -3], out[:, -2], out[:, -1] = known, log / 10, (log / 10) ** 2, known & (size < 200)
    return out


class Linear(NamedTuple):
    """A logistic regression on standardised features."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float

    def logit(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.scale) @ self.weights + self.bias


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit_linear(x: np.ndarray, y: np.ndarray, penalty: float = 1.0, steps: int = 12, weight: np.ndarray | None = None) -> Linear:
    """Newton steps for the penalised likelihood of weighted rows."""
    x, y = x.astype(float), y.astype(float)
    mean, scale = x.mean(0), x.std(0) + 1e-3
    weight = np.ones(len(x)) if weight is None else weight
    z = np.hstack([(x - mean) / scale, np.ones((len(x), 1))])
    w = np.zeros(z.shape[1])
    ridge = np.full(z.shape[1], penalty)
    ridge[-1] = 1e-6
    for _ in range(steps):
        p = sigmoid(z @ w)
        curve = (z * (weight * np.maximum(p * (1 - p), 1e-4))[:, None]).T @ z + np.diag(ridge)
        w = w - np.linalg.solve(curve, z.T @ (weight * (p - y)) + ridge * w)
    return Linear(mean, scale, w[:-1], float(w[-1]))


class Model(NamedTuple):
    text: Linear
    meta: Linear
    calibrate: tuple[Linear, Linear]
    combine: Linear
    #: Pseudo-labels (of class 0, of class 1) that the text and the metadata view were fitted on.
    handed: tuple[tuple[int, int], tuple[int, int]] = ((0, 0), (0, 0))

    def views(self, text: np.ndarray, meta: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Calibrated probability of each view, and the combined score."""
        logits = [c.logit(v.logit(x)[:, None]) for c, v, x in zip(self.calibrate, (self.text, self.meta), (text, meta))]
        return sigmoid(logits[0]), sigmoid(logits[1]), sigmoid(self.combine.logit(np.clip(np.stack(logits, 1), -12, 12)))


def ranking(score: np.ndarray, y: np.ndarray) -> float:
    """How much better than chance a score tells the classes apart: 1 always, 0 as chance does or worse."""
    rank = pd.Series(score).rank().to_numpy()
    ones = y > 0.5
    n1, n0 = ones.sum(), (~ones).sum()
    area = (rank[ones].sum() - n1 * (n1 + 1) / 2) / (n1 * n0)
    return float(max(0.0, 2 * area - 1))


def surest(score: np.ndarray, count: int, share: float) -> tuple[np.ndarray, np.ndarray]:
    """Places of the least and of the greatest scores, ``count`` at the most together and at least one of
    each if there are two, ``share`` of them greatest; ties in the order given."""
    count = min(count, len(score))
    ones = min(max(round(count * share), 1), max(count - 1, 0))
    order = np.argsort(score, kind="stable")
    return order[:count - ones], order[len(order) - ones:]


def co_train(text: np.ndarray, meta: np.ndarray, label: np.ndarray, handed: int = HANDED) -> Model | None:
    """``label`` is 1, 0 or NaN (pool).  None without both classes."""
    known = ~np.isnan(label)
    if len(set(label[known])) < 2:
        return None
    order = np.flatnonzero(known)
    held = order[::4] if min((label[order[::4]] == c).sum() for c in (0, 1)) >= 5 else order
    train = np.setdiff1d(order, held) if len(held) < len(order) else order
    pool = np.flatnonzero(~known)
    views = (text, meta)
    nothing = np.zeros(0, int)
    given = [(nothing, nothing, 0.0)] * 2     # documents of class 0 and 1 that each view got, and their weight
    models: list[Linear] = []
    for turn in range(ROUNDS + 1):
        models = []
        for x, (zeros, ones, weight) in zip(views, given):
            rows = np.concatenate([train, zeros, ones])
            y = np.concatenate([label[train], np.zeros(len(zeros)), np.ones(len(ones))])
            models.append(fit_linear(x[rows], y, weight=np.where(np.arange(len(rows)) < len(train), 1.0, weight)))
        if turn < ROUNDS:
            for me, other in ((0, 1), (1, 0)):
                low, high = surest(models[me].logit(views[me][pool]), len(pool) * (turn + 1) // handed, label[train].mean())
                # how far a view is to be trusted shows on what it was not trained on
                given[other] = (pool[low], pool[high], ranking(models[me].logit(views[me][held]), label[held]))
    raw = [m.logit(x[held]) for m, x in zip(models, views)]
    scales = [fit_linear(r[:, None], label[held]) for r in raw]
    both = np.clip(np.stack([s.logit(r[:, None]) for s, r in zip(scales, raw)], 1), -12, 12)
    return Model(models[0], models[1], (scales[0], scales[1]), fit_linear(both, label[held]),
                 tuple((len(zeros), len(ones)) for zeros, ones, _ in given))


def training_rows(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id",
                  max_labelled: int = MAX_LABELLED, pool: int = POOL) -> pd.DataFrame:
    """Feature rows of the bounded sample: columns text, meta (arrays) and label."""
    marks = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(id_col).agg(
        F.max(F.col(label_col).cast("double")).alias("label"))
    ids = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id")).distinct()
    marked = first_by_hash(ids.join(marks.withColumnRenamed(id_col, "id"), "id"), "id", max_labelled)
    rest = first_by_hash(ids.join(marks.select(F.col(id_col).alias("id")), "id", "left_anti"), "id", pool)
    sample = marked.unionByName(rest.withColumn("label", F.lit(None).cast("double")))
    rows = docs.select(F.col(id_col).alias("id"), *(c.alias(n) for n, c in zip(INPUTS, inputs(docs)))).join(
        F.broadcast(sample), "id").dropDuplicates(["id"])

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"id": b["id"], "label": b["label"], "text": list(text_features(b["text"])),
                                "meta": list(meta_features(b["source"], b["lang"], b["n_chars"]))})

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInPandas(features, f"id {kind}, label double, text array<float>, meta array<float>").toPandas().sort_values(
        "id", ignore_index=True)


INPUTS = ("text", "source", "lang", "n_chars")


def inputs(docs: DataFrame) -> list[Column]:
    """The columns that the views read; one that the table lacks counts as null."""
    kinds = {"n_chars": "double"}
    return [(F.col(c) if c in docs.columns else F.lit(None)).cast(kinds.get(c, "string")) for c in INPUTS]


def fit(docs: DataFrame, labels: DataFrame, **bounds) -> Model | None:
    rows = training_rows(docs, labels, **bounds)
    if rows.empty:
        return None
    return co_train(np.stack(rows["text"]), np.stack(rows["meta"]), rows["label"].to_numpy(dtype=float))


def scorer(docs: DataFrame, model: Model | None) -> Column:
    """A column struct<score, text_score, meta_score> over the rows of ``docs``."""
    @F.pandas_udf("struct<score double, text_score double, meta_score double>")
    def score(text: pd.Series, source: pd.Series, lang: pd.Series, n_chars: pd.Series) -> pd.DataFrame:
        if model is None:
            t = m = s = np.full(len(text), THRESHOLD)
        else:
            t, m, s = model.views(text_features(text), meta_features(source, lang, n_chars))
        return pd.DataFrame({"score": s, "text_score": t, "meta_score": m}).round(6)

    return score(*inputs(docs))


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", **bounds) -> DataFrame:
    """(id, score, text_score, meta_score, kept), one row per row of ``docs``.

    ``score`` is the probability of good quality, ``kept`` says that it is at least ``THRESHOLD``.
    A null text counts as empty, null metadata are a value of their own.  Without labels of both
    classes every score is the threshold and every document is kept.  Of a repeated id in ``labels``
    the larger label counts; repeated documents are scored each.  Texts are read whole, however long;
    an empty table gives no rows, and further columns of any name are not read.
    """
    model = fit(docs, labels, id_col=id_col, **bounds)
    return docs.select(F.col(id_col), scorer(docs, model).alias("judged")).select(
        id_col, "judged.score", "judged.text_score", "judged.meta_score", (F.col("judged.score") >= THRESHOLD).alias("kept"))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that the classifier keeps, all columns as they are."""
    model = fit(docs, labels, id_col=id_col)
    return docs.where(scorer(docs, model)["score"] >= THRESHOLD)
