"""Toxicity by a classifier chain of linear models on word presence."""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.sources.storage import materialized

_PLACES = 1 << 40
_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> set[str]:
    """Distinct lower-case words of a whole text, and the stems (first four and five letters) of longer ones."""
    words = set(_WORD.findall(text.lower()))
    return words | {w[:n] + "*" for w in words for n in (4, 5) if len(w) > n}


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 25) -> np.ndarray:
    """Ridge-penalised logistic regression by Newton steps; the last weight is the intercept."""
    design = np.hstack([x, np.ones((len(x), 1), x.dtype)])
    penalty = np.full(design.shape[1], ridge)
    penalty[-1] = 1e-6
    w = np.zeros(design.shape[1])
    for _ in range(rounds):
        p = _sigmoid(design @ w)
        gradient = design.T @ (y - p) - penalty * w
        hessian = (design * (p * (1 - p) + 1e-9)[:, None]).T @ design + np.diag(penalty)
        step = np.linalg.solve(hessian, gradient)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


def _predict(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return _sigmoid(x @ w[:-1] + w[-1])


@dataclass
class Chain:
    """One linear model per category, each on words and the logits of the categories before it."""

    categories: list[str]
    vocabulary: list[str] = field(default_factory=list)
    weights: list[np.ndarray] = field(default_factory=list)
    threshold: float = 1.0

    def score(self, words: np.ndarray) -> np.ndarray:
        """Probabilities (documents x categories) from word presence (documents x vocabulary)."""
        x, out = words, []
        for w in self.weights:
            p = _predict(x, w)
            out.append(p)
            x = np.hstack([x, p[:, None]])
        return np.stack(out, axis=1) if out else np.zeros((len(words), 0))


def fit_chain(words: np.ndarray, labels: np.ndarray, groups: np.ndarray, chain: Chain, folds: int = 3) -> np.ndarray:
    """Train ``chain`` and return the out-of-fold probabilities.

    ``labels`` holds a column per category (-1: unknown, not trained on).  Each
    model is trained on words and the earlier categories' out-of-fold
    probabilities, so that it sees them as wrong as they will be on new documents;
    the model that is kept is trained on all rows.  ``groups`` (hashes of texts)
    keep copies of one text in one fold.
    """
    fold = groups % folds
    x, outs = words, []
    for c in range(labels.shape[1]):
        y, known = labels[:, c].astype(float), labels[:, c] >= 0
        held = np.zeros(len(x))
        for f in range(folds):
            train = known & (fold != f)
            if train.any() and (fold == f).any():
                held[fold == f] = _predict(x[fold == f], fit_logistic(x[train], y[train]))
        chain.weights.append(fit_logistic(x[known], y[known]) if known.any() else np.zeros(x.shape[1] + 1))
        outs.append(held)
        x = np.hstack([x, held[:, None]])
    return np.stack(outs, axis=1)


def choose_words(sample: DataFrame, labels: list[str], most: int, least_docs: int = 5, z_least: float = 4.0) -> list[str]:
    """Words whose share among a category's documents is off by ``z_least`` deviations or more, the strongest first.

    ``sample``: w (distinct words) and one 0/1/null column per category.
    """
    n = [F.count(c).alias(f"n_{c}") for c in labels]
    hits = [F.coalesce(F.sum(c), F.lit(0)).alias(f"k_{c}") for c in labels]
    rates = sample.agg(*[F.coalesce(F.avg(c), F.lit(0.0)).alias(c) for c in labels]).first()
    words = sample.select(F.explode("w").alias("word"), *labels).groupBy("word").agg(F.count("*").alias("df"), *n, *hits)

    def z(c: str) -> Column:
        mean, spread = F.col(f"n_{c}") * rates[c], F.col(f"n_{c}") * rates[c] * (1 - rates[c])
        return F.abs(F.col(f"k_{c}") - mean) / F.sqrt(spread + 0.5)

    best = words.filter(F.col("df") >= least_docs).withColumn("z", F.round(F.greatest(*[z(c) for c in labels], F.lit(0.0)), 6))
    return [r.word for r in best.filter(F.col("z") >= z_least).orderBy(F.desc("z"), "word").limit(most).collect()]


def presence(rows: Iterable[set[str]], count: int, vocabulary: list[str]) -> np.ndarray:
    """Which words of the vocabulary stand in each of ``count`` documents; holds one document's words at a time."""
    place = {w: i for i, w in enumerate(vocabulary)}
    out = np.zeros((count, len(vocabulary)), np.float64)
    known = place.keys()
    for i, r in enumerate(rows):
        for w in known & r:
            out[i, place[w]] = 1.0
    return out


def train(
    documents: DataFrame, labels: DataFrame, categories: dict[str, Column], verdict: str, doc_id: str = "doc_id", text: str = "text",
    sample: int = 8000, vocabulary: int = 300, folds: int = 3, precision: float = 0.98, seed: int = 13,
) -> Chain:
    """Fit the chain on a bounded sample of labelled documents.

    ``categories`` maps names, in chain order, to 0/1/null columns of ``labels``.
    The sample is the ``sample`` labelled documents with the smallest seeded hash;
    it and ``vocabulary`` bound what the driver holds, whatever the table's size.
    The verdict's threshold is the lowest out-of-fold probability from which on
    ``precision`` of the documents have the label, 0.2 at least and 0.5 at most, so
    that label noise cannot let known positives pass.

    Several label rows of one document count as their largest value; labels of
    unknown documents, null ids and null labels are not trained on.  Without any
    labelled document the chain is empty and rejects nothing.
    """
    known = labels.select(F.col(doc_id).alias("id"), *[c.cast("int").alias(f"y{i}") for i, c in enumerate(categories.values())]).filter("id IS NOT NULL")
    known = known.groupBy("id").agg(*[F.max(f"y{i}").alias(f"y{i}") for i in range(len(categories))])
    texts = documents.select(F.col(doc_id).alias("id"), F.col(text).alias("t"))
    place = F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(_PLACES))
    named = texts.select("id").join(known, "id")
    # about twice the sample is ordered, not every partition's first rows; what is left out cannot be among the smallest
    share = min(1.0, 2 * sample / max(named.count(), 1))
    ids = named.filter(place <= int(share * _PLACES)).orderBy(place, "id").limit(sample).distinct()

    @F.pandas_udf("array<string>")
    def tokens(batch: pd.Series) -> pd.Series:
        return pd.Series([sorted(words_of(t or "")) for t in batch])

    chain, columns = Chain(list(categories)), [f"y{i}" for i in range(len(categories))]
    picked = materialized(texts.join(ids, "id").select(*columns, F.xxhash64("t").alias("h"), tokens(F.col("t")).alias("w")), "labelled")
    chain.vocabulary = choose_words(picked, columns, vocabulary)
    words = F.array(*[F.lit(w) for w in chain.vocabulary]).cast("array<string>")
    rows = picked.select(*columns, "h", F.array_intersect("w", words).alias("w")).orderBy("h", *columns).limit(sample).collect()
    if not rows:
        return chain
    y = np.asarray([[-1 if r[c] is None else r[c] for c in columns] for r in rows])
    groups = np.asarray([r.h for r in rows], np.int64) >> 1
    held = fit_chain(presence((set(r.w) for r in rows), len(rows), chain.vocabulary), y, groups, chain, folds)
    c = chain.categories.index(verdict)
    chain.threshold = min(lowest_threshold(held[y[:, c] >= 0, c], y[y[:, c] >= 0, c], precision), 0.5)
    return chain


def lowest_threshold(p: np.ndarray, y: np.ndarray, precision: float) -> float:
    """Lowest probability, 0.2 at least, at and above which ``precision`` of the rows are positive; 1.1 if none is."""
    order = np.argsort(-p, kind="stable")
    share = np.cumsum(y[order]) / np.arange(1, len(p) + 1)
    last = np.append(p[order][1:] != p[order][:-1], True)[: len(p)]
    good = np.flatnonzero((share >= precision) & last & (p[order] >= 0.2))
    return float(p[order][good[-1]]) if len(good) else 1.1


def score(df: DataFrame, chain: Chain, verdict: str, text: str = "text") -> DataFrame:
    """Add ``p_<category>`` for each category and ``rejected``.

    Whole texts are read; null and empty texts have no words.  Every row is kept,
    repeated ones too; an empty table gives an empty result; columns that carry a
    result name are replaced.
    """
    names = [f"p_{c}" for c in chain.categories]
    if not chain.weights:
        return df.select(*[c for c in df.columns if c not in (*names, "rejected")], *[F.lit(0.0).alias(n) for n in names], F.lit(False).alias("rejected"))

    @F.pandas_udf("array<double>")
    def run(texts: pd.Series) -> pd.Series:
        x = presence((words_of(t or "") for t in texts), len(texts), chain.vocabulary)
        return pd.Series(list(chain.score(x)))

    kept = [c for c in df.columns if c not in (*names, "rejected")]
    at = chain.categories.index(verdict)
    scored = df.select(F.struct(*kept).alias("row"), run(F.col(text)).alias("p"))
    return scored.select(
        *[F.col("row")[c].alias(c) for c in kept], *[F.col("p")[i].alias(n) for i, n in enumerate(names)],
        (F.col("p")[at] >= chain.threshold).alias("rejected"),
    )
