"""Toxicity by weak supervision.

Voters are lexicon entries (a word occurs) and patterns (a word with a certain
beginning occurs, or two or three different ones do), found in a bounded sample of labelled rows: those that mark
toxic texts far more often than others.  From there on labels are not used.  A
generative model of the voters' votes, fitted by expectation-maximisation,
estimates how often each voter fires on toxic and on clean texts; the
correlations that are left between voters given the label discount voters that
repeat each other.  Its posterior labels train a logistic regression over word
and pattern features, which scores every text.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.llm.common import claim_worker, filter_slices, fold, map_slices, materialize, texts_of

#: Labelled documents fitted on, at most.  The sizes of the two models, their strongest voters and features, are
#: parameters of the classifier; they do not depend on the size of the table.
SAMPLE, VOTERS, FEATURES = 12_000, 160, 700
#: A voter marks this many toxic rows of the sample and this share of the rows it marks is toxic, at least.
LEAST_ROWS, LEAST_SHARE, THRESHOLD, EM_STEPS = 4, 0.7, 0.7, 30
PREFIXES, CACHE_ENTRIES, ROWS_AT_ONCE = (3, 4, 5, 6, 7), 300_000, 1000
_WORD = re.compile(r"[^\W\d_]+")


def features_of(text: str) -> set[str]:
    """Words in lower case; their beginnings with as many ``*`` as different words share them, up to three."""
    words = set(_WORD.findall(text.lower()))
    out = set(words)
    for k in PREFIXES:
        for p, n in Counter(w[:k] for w in words if len(w) > k).items():
            out.update(p + "*" * i for i in range(1, min(n, 3) + 1))
    return out


class LabelModel:
    """Generative model of unipolar votes with a latent label, and discounts for correlated voters.

    A voter that does not fire abstains; that none fires is one more vote.
    """

    def __init__(self, votes: np.ndarray, prior: float):
        v = votes.astype(float)
        fired = v.sum(axis=1)
        none = fired == 0
        # to begin with, a text is the likelier toxic the more voters fire
        q = np.where(none, prior / 10, 1 - 0.5 ** np.minimum(fired, 20))
        for step in range(EM_STEPS):
            self.pi = float(np.clip(q.mean(), 0.005, 0.5))
            t, c = q.sum(), (1 - q).sum()
            self.on_toxic = (q @ v + 0.2) / (t + 2)
            self.on_clean = np.minimum(((1 - q) @ v + 0.2) / (c + 20), self.on_toxic / 1.5)
            self.silent = float(np.log((q @ none + 0.5) / (t + 1)) - np.log(((1 - q) @ none + 0.5) / (c + 1)))
            if step % 10 == 0:
                self.discount = self._discount(v, q)
            q = self.predict(votes)
        self.posterior = q

    def _discount(self, v: np.ndarray, q: np.ndarray) -> np.ndarray:
        """One over the number of voters that say the same, given the label."""
        total = np.zeros((v.shape[1],) * 2)
        for weight, rate in ((q, self.on_toxic), (1 - q, self.on_clean)):
            e = (v - rate) * np.sqrt(weight)[:, None]
            total += e.T @ e
        sd = np.sqrt(np.maximum(np.diag(total), 1e-9))
        self.correlation = total / np.outer(sd, sd)
        return 1 / np.maximum((np.clip(self.correlation, 0, 1) ** 2).sum(axis=1), 1)

    def predict(self, votes: np.ndarray) -> np.ndarray:
        """P(toxic | votes)."""
        fire = np.log(self.on_toxic / self.on_clean) * self.discount
        z = np.log(self.pi / (1 - self.pi)) + votes @ fire + self.silent * (votes.sum(axis=1) == 0)
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def logistic(x: np.ndarray, target: np.ndarray, penalty: float = 0.5, steps: int = 12) -> tuple[np.ndarray, float]:
    """Weights and intercept for soft targets, by Newton steps with an L2 penalty; wide numbers are held for some rows at a time."""
    w = np.zeros(x.shape[1] + 1)
    ridge = np.full(len(w), penalty)
    ridge[-1] = 1e-3
    for _ in range(steps):
        grad, hess = -ridge * w, np.diag(ridge)
        for at in range(0, len(x), ROWS_AT_ONCE):
            part = x[at : at + ROWS_AT_ONCE]
            xb = np.hstack([part.astype(float), np.ones((len(part), 1))])
            p = 1 / (1 + np.exp(-np.clip(xb @ w, -30, 30)))
            grad += xb.T @ (target[at : at + ROWS_AT_ONCE] - p)
            hess += xb.T @ (xb * (p * (1 - p))[:, None])
        w = w + np.linalg.solve(hess, grad)
    return w[:-1], float(w[-1])


class Scorer:
    """A linear classifier over features; one copy per worker remembers words."""

    def __init__(self, names: list[str], weights: np.ndarray, intercept: float):
        self.index, self.weights, self.intercept = {f: i for i, f in enumerate(names)}, weights, intercept
        #: by beginning: the features for one, two and three different words, -1 where there is none
        self.patterns: dict[str, tuple[int, int, int]] = {}
        for f in names:
            p = f.rstrip("*")
            if p != f:
                self.patterns[p] = tuple(self.index.get(p + "*" * i, -1) for i in (1, 2, 3))
        self.memory: dict[str, tuple] = {}

    def __getstate__(self):
        return self.__dict__ | {"memory": {}}

    def hits(self, text: str) -> set[int]:
        """The classifier's features of a text."""
        memory, index, patterns = self.memory, self.index, self.patterns
        if len(memory) > CACHE_ENTRIES:
            memory.clear()
        out: set[int] = set()
        shared: Counter = Counter()
        for w in set(_WORD.findall(text.lower())):
            found = memory.get(w)
            if found is None:
                found = memory[w] = (index.get(w, -1), tuple(w[:k] for k in PREFIXES if len(w) > k and w[:k] in patterns))
            if found[0] >= 0:
                out.add(found[0])
            if found[1]:
                shared.update(found[1])
        for p, n in shared.items():
            out.update(i for i in patterns[p][: min(n, 3)] if i >= 0)
        return out

    def scores(self, batch: pa.RecordBatch) -> list[float]:
        claim_worker("toxicity")
        return [self.score(t) for t in texts_of(batch)]

    def score(self, text: str) -> float:
        z = self.intercept + sum(self.weights[i] for i in sorted(self.hits(text)))
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def fit(docs: DataFrame, labels: DataFrame) -> Scorer:
    """A classifier from at most ``SAMPLE`` labelled documents outside the held-out fold.

    Of rows that repeat a labelled doc_id the smallest text is learned from, so
    the sample is bounded whatever repeats.  Without toxic rows in the sample nothing is ever toxic (score 0).
    """
    draw = F.xxhash64("doc_id")
    known = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & (fold() != 1)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    drawn = known.orderBy(draw, "doc_id").limit(SAMPLE)
    rows = docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id")  # SAMPLE rows of labels
    sample = materialize(rows.groupBy("doc_id", "toxic").agg(F.min("text").alias("text")).select("doc_id", "text", "toxic"), "labelled")

    def count(batch: pa.RecordBatch) -> dict:
        sums = {0: Counter(), 1: Counter()}
        for text, toxic in zip(texts_of(batch), batch.column(2).to_pylist(), strict=True):
            sums[int(toxic > 0)].update(features_of(text))
        names = list(sums[0].keys() | sums[1].keys())
        return {"feature": names, "toxic": [sums[1][f] for f in names], "clean": [sums[0][f] for f in names]}

    found = map_slices(sample.select("doc_id", "text", "toxic"), count, "feature string, toxic long, clean long").groupBy("feature").agg(F.sum("toxic").alias("t"), F.sum("clean").alias("c"))
    found = materialize(found.filter(F.col("t") + F.col("c") >= LEAST_ROWS), "features")
    n_toxic, n_clean = sample.agg(F.count_if(F.col("toxic") > 0), F.count_if(F.col("toxic") <= 0)).first()
    if not n_toxic:
        return Scorer([], np.zeros(0), -40.0)
    rate_t, rate_c = (F.col("t") + 0.5) / (n_toxic + 1), (F.col("c") + 0.5) / (n_clean + 1)
    # how far the rates differ, in deviations of their difference
    found = found.withColumn("z", (rate_t - rate_c) / F.sqrt(rate_t / n_toxic + rate_c / max(n_clean, 1)))
    mined = found.orderBy(F.abs("z").desc(), "feature").limit(FEATURES).collect()
    voters = found.filter((F.col("t") >= LEAST_ROWS) & (F.col("t") >= LEAST_SHARE * (F.col("t") + F.col("c")))).orderBy(F.desc("z"), "feature").limit(VOTERS).collect()
    names = list(dict.fromkeys([r["feature"] for r in voters] + [r["feature"] for r in mined]))
    if not voters:
        return Scorer([], np.zeros(0), -40.0)
    blank = Scorer(names, np.zeros(len(names)), 0.0)
    sent = docs.sparkSession.sparkContext.broadcast(blank)
    rows = map_slices(sample.select("doc_id", "text"), lambda b: {"doc_id": b.column(0), "hits": [sorted(sent.value.hits(t)) for t in texts_of(b)]}, "doc_id long, hits array<int>").toArrow()
    x = np.zeros((rows.num_rows, len(names)), np.float32)
    hits = rows.column("hits").combine_chunks()
    x[np.repeat(np.arange(rows.num_rows), hits.value_lengths().to_numpy()), hits.flatten().to_numpy()] = 1
    model = LabelModel(x[:, : len(voters)], n_toxic / (n_toxic + n_clean))
    weights, intercept = logistic(x, model.posterior)
    return Scorer(names, weights, intercept)


def score(docs: DataFrame, labels: DataFrame, fitted: Scorer | None = None) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of each row.

    Labels are learned from the rows outside the held-out fold
    (``crc32(doc_id as text) mod 3 = 1``); scores see the text only.  Null text
    counts as empty and has the score of a text without features.  Repeated rows
    are scored each; of repeated labels the largest counts.  A score equal to
    the threshold is toxic.  A text of any length is read whole.  Other columns are
    ignored.  An empty table gives no rows; without usable labels all scores
    are 0.
    """
    sent = docs.sparkSession.sparkContext.broadcast(fitted or fit(docs, labels))  # bounded by FEATURES

    def run(batch: pa.RecordBatch) -> dict:
        scores = sent.value.scores(batch)
        return {"doc_id": batch.column(0), "held_out": batch.column(1), "score": scores, "predicted": [int(s >= THRESHOLD) for s in scores]}

    return map_slices(docs.select("doc_id", (fold() == 1).alias("held_out"), "text"), run, "doc_id long, held_out boolean, score double, predicted int")


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the texts predicted toxic.

    One pass; null text is judged as empty, repeated rows are judged each, the
    other columns travel along.
    """
    sent = docs.sparkSession.sparkContext.broadcast(fit(docs, labels))
    return filter_slices(docs, lambda b: [s < THRESHOLD for s in sent.value.scores(b)])
