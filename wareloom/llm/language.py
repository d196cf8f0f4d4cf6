"""Language identification by character language models.

Each language has an interpolated Kneser-Ney model of characters. Its n-grams
lie in sorted arrays of 64-bit hashes, shared by the languages, with one column
of log-probabilities per language. A text gets the language with the lowest
cross-entropy per character; a text that even the best model finds too unlikely
is rejected, by a limit set on texts the models have not seen.

The models learn from at most ``FIT_DOCS`` documents of each language, chosen by
a hash of their id; rows whose ``crc32(doc_id as text) % 3`` is 1 are held out.
``doc_id``, ``lang`` and ``source`` play no part in a prediction.

Nulls and edge cases: a text that is null or has no letters is ``und`` with
score 0; without any document to learn from every text is; ties go to the
language that sorts first; rows are never merged; an empty table gives an empty
result. Other characters than letters count as one blank between words.
"""

from __future__ import annotations

import sys
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

ORDER = 4
FIT_DOCS = 400
#: Of these, the share that only sets the rejection limits.
CALIBRATION = 5
FOLDS = 3
#: Parts of a language that are cut to the limit on their own.
PARTS = 32
DISCOUNT = 0.75
#: How much better per character a language must be to be e times as credible.
SHARPNESS = 8.0
UNKNOWN = "und"
#: Characters worked on at a time, whatever the lengths of the texts.
BLOCK = 1 << 20


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Lower-case letter of each code point, 0 for anything that is none."""
    table = np.zeros(sys.maxunicode + 1, np.uint32)
    for code in range(sys.maxunicode + 1):
        c = chr(code)
        if c.isalpha():
            low = c.lower()
            table[code] = ord(low) if len(low) == 1 else code
    return table


def symbols(text: str) -> np.ndarray:
    """Code points of the letters in lower case, words parted and framed by one 0; empty without letters."""
    plain = _letters()[np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")]
    if not plain.any():
        return np.zeros(0, np.uint32)
    plain = np.concatenate([[0], plain, [0]]).astype(np.uint32)
    blank = plain == 0
    return plain[~(blank & np.concatenate([[False], blank[:-1]]))]


_MIX = np.uint64(0x9E3779B97F4A7C15)


def _step(hashes: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Hashes of n-grams grown by one character on the left."""
    grown = (hashes ^ (codes.astype(np.uint64) + np.uint64(1))) * _MIX
    return grown ^ (grown >> np.uint64(29))


def hashes(grams: np.ndarray) -> np.ndarray:
    """One hash per row of code points, read from the last character to the first."""
    made = np.full(len(grams), grams.shape[1], np.uint64)
    for column in range(grams.shape[1] - 1, -1, -1):
        made = _step(made, grams[:, column])
    return made


@dataclass
class Level:
    """n-grams of one order: sorted hashes and log-probabilities of their last character, a column per language."""

    grams: np.ndarray
    logs: np.ndarray
    #: Contexts of this order and the log of the weight they leave to shorter ones.
    contexts: np.ndarray
    weights: np.ndarray


@dataclass
class Models:
    languages: list[str]
    levels: list[Level]
    unseen: np.ndarray
    limits: np.ndarray

    def entropies(self, codes: np.ndarray) -> np.ndarray:
        """Cross-entropy per character of one text under each language."""
        total = np.zeros(len(self.languages))
        history = np.concatenate([np.zeros(ORDER - 1, np.uint32), codes])
        for begin in range(0, len(codes), BLOCK):
            window = history[begin:begin + BLOCK + ORDER - 1]
            total += self._logs(np.lib.stride_tricks.sliding_window_view(window, ORDER)).sum(0)
        return -total / len(codes)

    def _logs(self, grams: np.ndarray) -> np.ndarray:
        logs = np.zeros((len(grams), len(self.languages)))
        open_rows = np.arange(len(grams))
        for order in range(ORDER, 0, -1):
            level, own = self.levels[order - 1], grams[open_rows, ORDER - order:]
            at, found = _find(level.grams, hashes(own))
            logs[open_rows[found]] += level.logs[at[found]]
            open_rows, own = open_rows[~found], own[~found]
            if not len(open_rows):
                return logs
            if order > 1:
                at, found = _find(level.contexts, hashes(own[:, :-1]))
                logs[open_rows[found]] += level.weights[at[found]]
        logs[open_rows] += self.unseen
        return logs


def _find(table: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(table):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(table, wanted), len(table) - 1)
    return at, table[at] == wanted


def build(counts: dict[str, tuple[np.ndarray, np.ndarray]]) -> Models:
    """Models from the counts of the longest n-grams: code points, a row each, and how often they occur.

    Shorter n-grams count the different characters seen before them.
    """
    languages = sorted(counts)
    grams = {lang: counts[lang][0] for lang in languages}
    seen = {lang: counts[lang][1].astype(float) for lang in languages}
    by_order = {}
    for order in range(ORDER, 0, -1):
        by_order[order] = {lang: (grams[lang], seen[lang]) for lang in languages}
        for lang in languages:
            grams[lang], number = np.unique(grams[lang][:, 1:], axis=0, return_counts=True)
            seen[lang] = number.astype(float)

    characters = {lang: len(by_order[1][lang][0]) + 1 for lang in languages}
    unseen = np.log([1 / characters[lang] for lang in languages])
    levels, lower = [], None
    for order in range(1, ORDER + 1):
        every = np.unique(np.concatenate([by_order[order][lang][0] for lang in languages]), axis=0)
        contexts = np.unique(every[:, :-1], axis=0)
        keys, context_keys = hashes(every), hashes(contexts)
        context_of = np.argsort(context_keys)[np.searchsorted(np.sort(context_keys), hashes(every[:, :-1]))]
        probability, weight = np.zeros((len(every), len(languages))), np.ones((len(contexts), len(languages)))
        sort = np.argsort(keys)
        for n, lang in enumerate(languages):
            own, number = by_order[order][lang]
            amount = np.zeros(len(every))
            amount[sort[np.searchsorted(keys[sort], hashes(own))]] = number
            total = np.bincount(context_of, amount, len(contexts))
            kinds = np.bincount(context_of, amount > 0, len(contexts))
            known = total > 0
            weight[known, n] = DISCOUNT * kinds[known] / total[known]
            shorter = np.full(len(every), np.exp(unseen[n])) if order == 1 else lower(every[:, 1:])[:, n]
            kept = np.maximum(amount - DISCOUNT, 0) / np.maximum(total, 1)[context_of]
            probability[:, n] = kept + weight[context_of, n] * shorter
        if order == 1:
            unseen = unseen + np.log(weight[0])
        context_sort = np.argsort(context_keys)
        levels.append(Level(keys[sort], np.log(probability)[sort].astype(np.float32),
                            context_keys[context_sort], np.log(weight)[context_sort].astype(np.float32)))

        def lower(wanted, level=levels[-1]):
            # Every suffix of a known n-gram is known.
            return np.exp(level.logs[np.searchsorted(level.grams, hashes(wanted))].astype(float))
    return Models(languages, levels, unseen, np.full(len(languages), np.inf))


def _counter(batches):
    """``lang, gram, times`` of one task's documents."""
    counted: Counter = Counter()
    for batch in batches:
        for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist()):
            codes = symbols(text or "")
            if len(codes):
                history = np.concatenate([np.zeros(ORDER - 1, np.uint32), codes])
                grams, times = np.unique(np.lib.stride_tricks.sliding_window_view(history, ORDER), axis=0, return_counts=True)
                counted.update({(lang, gram.tobytes()): int(n) for gram, n in zip(grams.astype("<u4"), times)})
    if counted:
        langs, grams = zip(*counted)
        yield pa.RecordBatch.from_arrays(
            [pa.array(langs, pa.string()), pa.array(grams, pa.binary()), pa.array(list(counted.values()), pa.int64())],
            ["lang", "gram", "times"])


def held_out() -> Column:
    return F.crc32(F.col("doc_id").cast("string")) % FOLDS == 1


def sample(docs: DataFrame, fit_docs: int = FIT_DOCS) -> DataFrame:
    """``doc_id, lang, text, part`` of the documents to learn from; part 0 sets the limits."""
    can = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    draw = F.xxhash64("doc_id")
    # A language is cut down in parts first, so however many tasks hold some of it, few rows meet in one.
    part = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(PARTS))
    within = F.row_number().over(Window.partitionBy("lang", "_part").orderBy(draw, "doc_id"))
    cut = can.select("doc_id", "lang", part.alias("_part")).withColumn("_within", within).where(F.col("_within") <= fit_docs)
    place = F.row_number().over(Window.partitionBy("lang").orderBy(draw, "doc_id"))
    chosen = cut.select("doc_id", "lang", place.alias("place")).where(F.col("place") <= fit_docs)
    chosen = chosen.select("doc_id", "lang", (F.col("place") % CALIBRATION).alias("part")).distinct()
    return docs.select("doc_id", "lang", "text").join(F.broadcast(chosen), ["doc_id", "lang"])


def train(docs: DataFrame, fit_docs: int = FIT_DOCS) -> Models:
    """Learn the models and the limits. What reaches the driver is bounded by the sample, not by the table."""
    drawn = sample(docs, fit_docs)
    counted = (
        drawn.where(F.col("part") != 0).select("text", "lang").mapInArrow(_counter, "lang string, gram binary, times long")
        .groupBy("lang", "gram").agg(F.sum("times").alias("times")).toPandas()
    )
    counts = {
        lang: (np.frombuffer(b"".join(rows["gram"]), "<u4").reshape(-1, ORDER), rows["times"].to_numpy())
        for lang, rows in counted.groupby("lang")}
    if not counts:
        return Models([], [], np.zeros(0), np.zeros(0))
    models = build(counts)
    judged = drawn.where(F.col("part") == 0).select("lang", "text").mapInArrow(
        _judge(models, ["lang"]), f"lang string, {_VERDICT}")
    own = judged.where(F.col("lang") == F.col("lang_pred")).groupBy("lang").agg(
        F.avg("entropy").alias("mean"), F.coalesce(F.stddev("entropy"), F.lit(0.0)).alias("spread")).collect()
    limits = {row["lang"]: row["mean"] + max(6 * row["spread"], 0.5) for row in own}
    models.limits = np.array([limits.get(lang, np.inf) for lang in models.languages])
    return models


_VERDICT = "lang_pred string, score double, entropy double, rejected boolean"


def _judge(models: Models, keep: list[str]) -> Callable:
    def one(text):
        codes = symbols(text or "")
        if not len(codes) or not models.languages:
            return UNKNOWN, 0.0, None, True
        entropies = models.entropies(codes)
        best = int(np.argmin(entropies))
        credible = np.exp(-SHARPNESS * (entropies - entropies[best]))
        return models.languages[best], 1 / credible.sum(), entropies[best], bool(entropies[best] > models.limits[best])

    def run(batches):
        kinds = [pa.string(), pa.float64(), pa.float64(), pa.bool_()]
        for batch in batches:
            made = [one(text.as_py()) for text in batch.column("text")]
            columns = zip(*made) if made else [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(name) for name in keep), *(pa.array(c, k) for c, k in zip(columns, kinds))],
                [*keep, "lang_pred", "score", "entropy", "rejected"])
    return run


def identify(docs: DataFrame, models: Models) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, entropy, rejected`` of every document.

    ``score`` is the best language's share of the credibility of all;
    ``rejected`` tells texts that are in none of the languages.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(held_out(), F.lit(False)).alias("held_out"), "text")
    return rows.mapInArrow(_judge(models, ["doc_id", "held_out"]), f"doc_id long, held_out boolean, {_VERDICT}")
