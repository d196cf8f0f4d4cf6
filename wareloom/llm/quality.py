"""A quality classifier: an additive model with pairwise interactions.

Built-in functions turn each whole text into a few numbers. Shallow trees are
boosted in cycles, one feature after the other, and add up to one lookup table
per feature; the strongest pairs of features then get tables of their own.
Scoring is a sum of table entries.

The model learns from at most ``FIT_ROWS`` labelled documents, chosen by a hash
of their id; rows whose ``crc32(doc_id as text) % 5`` is 0 are held out. Labels,
``doc_id``, ``lang`` and ``source`` are no features.

Nulls and edge cases: a null text counts as empty; an empty text gets the score
of its (zero) features; labels that are null are left out; without labels every
score is 0.5, with one kind of label all scores lean to it; rows are never
merged; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import pandas_udf

FIT_ROWS = 20_000
THRESHOLD = 0.3
FOLDS = 5

BINS = 32
PAIR_BINS = 8
ROUNDS = 120
PAIRS = 6
PAIR_ROUNDS = 60
RATE = 0.1
#: Weight that pulls the leaves of small bins to 0.
SHRINK = 5.0


def _share(text: str, pattern: str) -> Column:
    return F.regexp_count(F.col(text), F.lit(pattern)) / F.greatest(F.col("_chars"), F.lit(1))


def with_features(rows: DataFrame, text: str) -> tuple[DataFrame, list[str]]:
    """``rows`` with one double column per feature of a text column, and the features' names."""
    full = rows.withColumn("_body", F.coalesce(text, F.lit("")))
    full = full.withColumns({
        "_chars": F.char_length("_body"), "_words": F.filter(F.split("_body", r"\s+"), lambda w: w != ""),
        "_lines": F.filter(F.split("_body", "\n"), lambda line: F.btrim(line) != ""),
    })
    n = F.size("_words")
    per_word = F.greatest(n, F.lit(1))
    made = {
        "chars": F.log1p("_chars"),
        "words": F.log1p(n),
        "word_length": (F.col("_chars") - n) / per_word,
        "distinct": F.size(F.array_distinct("_words")) / per_word,
        "upper": _share("_body", r"\p{Lu}"),
        "letters": _share("_body", r"\p{L}"),
        "digits": _share("_body", r"\p{N}"),
        "symbols": _share("_body", r"[^\p{L}\p{N}\s.,;:'?!-]"),
        "marks": _share("_body", r"[!?]"),
        "stops": F.regexp_count("_body", F.lit(r"[.]")) / per_word,
        "commas": F.regexp_count("_body", F.lit(",")) / per_word,
        "repeats": F.regexp_count("_body", F.lit(r"(?<!\S)(\S++)\s\1(?!\S)")) / per_word,
        "line_words": n / F.greatest(F.size("_lines"), F.lit(1)),
        "distinct_lines": F.size(F.array_distinct("_lines")) / F.greatest(F.size("_lines"), F.lit(1)),
    }
    full = full.select("*", *[value.cast("double").alias(name) for name, value in made.items()])
    return full.drop("_body", "_chars", "_words", "_lines"), list(made)


@dataclass
class Additive:
    """Tables of an additive model over binned features."""

    names: list[str]
    edges: list[np.ndarray]
    coarse: list[np.ndarray]
    base: float
    tables: list[np.ndarray]
    pairs: list[tuple[int, int]]
    pair_tables: list[np.ndarray]

    def score(self, columns: list[np.ndarray]) -> np.ndarray:
        total = np.full(len(columns[0]), self.base)
        for values, edges, table in zip(columns, self.edges, self.tables):
            total += table[np.searchsorted(edges, values, side="right")]
        for (a, b), table in zip(self.pairs, self.pair_tables):
            total += table[np.searchsorted(self.coarse[a], columns[a], side="right"),
                           np.searchsorted(self.coarse[b], columns[b], side="right")]
        return 1 / (1 + np.exp(-total))


def _edges(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1]))


def _cuts(gradient: np.ndarray, weight: np.ndarray, depth: int) -> np.ndarray:
    """Leaf values, by bin, of the best tree of ``depth`` over ordered bins."""
    whole = gradient.sum() / (weight.sum() + SHRINK)
    if depth == 0 or len(gradient) < 2:
        return np.full(len(gradient), whole)
    left_g, left_w = np.cumsum(gradient)[:-1], np.cumsum(weight)[:-1]
    right_g, right_w = gradient.sum() - left_g, weight.sum() - left_w
    at = int(np.argmax(left_g ** 2 / (left_w + SHRINK) + right_g ** 2 / (right_w + SHRINK))) + 1
    return np.concatenate([_cuts(gradient[:at], weight[:at], depth - 1), _cuts(gradient[at:], weight[at:], depth - 1)])


def _quarters(gradient: np.ndarray, weight: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and leaf values of the best cut of a two-way table into four quarters."""
    best, values = -1.0, np.zeros_like(gradient)
    sums = [np.cumsum(np.cumsum(x, 0), 1) for x in (gradient, weight)]
    for a in range(gradient.shape[0] - 1):
        for b in range(gradient.shape[1] - 1):
            parts = [(s[a, b], s[a, -1] - s[a, b], s[-1, b] - s[a, b], s[-1, -1] - s[a, -1] - s[-1, b] + s[a, b])
                     for s in sums]
            gain = sum(g * g / (w + SHRINK) for g, w in zip(*parts))
            if gain > best:
                best = gain
                leaf = [g / (w + SHRINK) for g, w in zip(*parts)]
                values = np.zeros_like(gradient)
                values[:a + 1, :b + 1], values[:a + 1, b + 1:] = leaf[0], leaf[1]
                values[a + 1:, :b + 1], values[a + 1:, b + 1:] = leaf[2], leaf[3]
    return best, values


def fit(names: list[str], features: np.ndarray, labels: np.ndarray) -> Additive:
    """Boost on a sample: ``features`` has a row per document."""
    count = len(names)
    edges = [_edges(features[:, j], BINS) if len(features) else np.array([]) for j in range(count)]
    coarse = [_edges(features[:, j], PAIR_BINS) if len(features) else np.array([]) for j in range(count)]
    share = (labels.sum() + 0.5) / (len(labels) + 1)
    model = Additive(names, edges, coarse, float(np.log(share / (1 - share))),
                     [np.zeros(len(e) + 1) for e in edges], [], [])
    if len(np.unique(labels)) < 2:
        return model
    at = [np.searchsorted(edges[j], features[:, j], side="right") for j in range(count)]
    total = np.full(len(labels), model.base)

    def residuals():
        p = 1 / (1 + np.exp(-total))
        return labels - p, p * (1 - p)

    for _ in range(ROUNDS):
        for j, table in enumerate(model.tables):
            g, w = residuals()
            step = RATE * _cuts(np.bincount(at[j], g, len(table)), np.bincount(at[j], w, len(table)), 2)
            table += step
            total += step[at[j]]

    rough = [np.searchsorted(coarse[j], features[:, j], side="right") for j in range(count)]
    shape = [len(c) + 1 for c in coarse]

    def two_way(a, b):
        g, w = residuals()
        cell, size = rough[a] * shape[b] + rough[b], shape[a] * shape[b]
        return (np.bincount(cell, g, size).reshape(shape[a], shape[b]),
                np.bincount(cell, w, size).reshape(shape[a], shape[b]))

    gains = sorted(((_quarters(*two_way(a, b))[0], a, b) for a in range(count) for b in range(a)), reverse=True)
    model.pairs = [(a, b) for _, a, b in gains[:PAIRS]]
    model.pair_tables = [np.zeros((shape[a], shape[b])) for a, b in model.pairs]
    for _ in range(PAIR_ROUNDS):
        for (a, b), table in zip(model.pairs, model.pair_tables):
            step = RATE * _quarters(*two_way(a, b))[1]
            table += step
            total += step[rough[a], rough[b]]
    return model


def held_out() -> Column:
    return F.crc32(F.col("doc_id").cast("string")) % FOLDS == 0


def train(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Additive:
    """Fit on the labelled documents outside the held-out fold; at most ``fit_rows`` reach the driver."""
    known = labels.select("doc_id", F.col("quality").cast("double").alias("_label"))
    known = known.where(F.col("_label").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id", "_label").limit(fit_rows)
    place = F.xxhash64("doc_id", "text")
    drawn = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("_label", place.alias("_place"), "text")
    full, names = with_features(drawn, "text")
    # Surplus rows, where ids repeat, go by hash: by label, one of the labels would go first.
    ordered = full.select("_label", "_place", *names).orderBy("_place", "_label", *names)
    rows = ordered.limit(fit_rows).drop("_place").toPandas().to_numpy(float)
    return fit(names, rows[:, 1:], rows[:, 0])


def scorer(model: Additive):
    @pandas_udf("double")
    def score(features: pd.DataFrame) -> pd.Series:
        return pd.Series(model.score([features[name].to_numpy(float) for name in model.names]))
    return score


def with_score(docs: DataFrame, model: Additive) -> DataFrame:
    """``row, score``: each row of ``docs`` as a struct, and the score of its whole text.

    Only the features go through Python.
    """
    rows = docs.select(F.struct("*").alias("row"))
    full, names = with_features(rows.withColumn("_text", F.col("row.text")), "_text")
    return full.select("row", scorer(model)(F.struct(*names)).alias("score"))


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document."""
    scored = with_score(docs.select("doc_id", "text"), train(docs, labels)).select("row.doc_id", "score")
    return scored.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the documents the model rejects."""
    return with_score(docs, train(docs, labels)).where(F.col("score") >= threshold).select("row.*")
