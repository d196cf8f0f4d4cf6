"""Audit of what filters remove, in every order they can be applied in.

Each document has a mask with one bit for each filter it fails. Built-in
functions work the masks out and count them per part, so that a part comes to
at most ``2 ** n`` weighted masks, whatever its size. From these a task builds
one decision diagram per part: a level per filter, an edge for passing and one
for failing, equal nodes shared, and every node weighted with the documents
below it. Swapping two neighbouring levels touches the nodes of the upper one
only, and a walk through all orders by such swaps visits each once. The steps
of an order lie along the path on which all filters are passed: the weight of a
failing edge there is what the step removes, that of the passing edge what it
keeps.

Nulls and edge cases: a null text counts as empty; a null part is the empty
string, and so shares the part of that name; a row without an id neither is a
copy by id nor makes others one, and has no label; rows that share an id and a
text are no copies of each other, as neither id is smaller; of several labels
for one document the largest counts; a table without rows has no parts and
gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from wareloom.session import stage

# The blanks between words, and the thresholds of the filters.
BLANKS = " \t\n\x0b\f\r"
MIN_WORDS, MIN_DISTINCT_PERCENT, MAX_UPPER_PERCENT = 200, 50, 3
FILTERS = "ABCDE"
#: What a weight counts: documents, documents of good quality, toxic documents.
WEIGHTS = ("n", "good", "toxic")

SCHEMA = ("part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
          "good_lost long, toxic_lost long, shapley long")


def failures(text: Column) -> dict[str, Column]:
    """Whether a text fails A (too short), B (repetitive), C (too many capitals), D (symbols)."""
    blanks = f"[{BLANKS}]+"
    words = F.split(F.btrim(text, F.lit(BLANKS)), blanks)
    # An empty text splits into one empty word.
    n_words = F.size(F.filter(words, lambda word: word != ""))
    distinct = F.size(F.array_remove(F.array_distinct(words), ""))
    capitals = F.octet_length(F.regexp_replace(text, "[^A-Z]+", ""))
    return {
        "A": n_words < MIN_WORDS,
        "B": 100 * distinct < MIN_DISTINCT_PERCENT * n_words,
        "C": 100 * capitals.cast("long") > MAX_UPPER_PERCENT * F.char_length(text),
        "D": text.rlike("[#$%&*|]"),
    }


def _mask(flags: dict[str, Column], order: str = FILTERS) -> Column:
    bits = [F.when(flags[f], 1 << n).otherwise(0) for n, f in enumerate(order) if f in flags]
    return reduce(Column.__add__, bits)


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, body, part, mask, rows, good, toxic``: equal rows once, texts as digests, filter E still open."""
    text = F.coalesce("text", F.lit(""))
    read = docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), text.alias("text"))
    rows = read.select("doc_id", "part", F.unhex(F.sha2("text", 256)).alias("body"), _mask(failures(F.col("text"))).alias("mask"))
    narrow = rows.groupBy("doc_id", "body", "part", "mask").agg(F.count(F.lit(1)).alias("rows"))
    marks = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("_labelled")).agg(
        (F.max("quality") == 1).alias("good"), (F.max("toxic") == 1).alias("toxic"))
    return narrow.join(marks, F.col("doc_id") == F.col("_labelled"), "left").select(
        "doc_id", "body", "part", "mask", "rows",
        F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"))


def weighted_masks(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, mask, n, good, toxic``: the documents of each part with each set of failed filters.

    A text that many documents share comes to one row per part and label
    before its smallest id is looked for, which alone passes filter E.
    """
    cells = judged(docs, labels).groupBy("body", "mask", "part", "good", "toxic").agg(
        F.sum("rows").alias("rows"), F.min("doc_id").alias("least"), F.min_by("rows", "doc_id").alias("rows_of_least"),
        F.sum(F.when(F.col("doc_id").isNull(), F.col("rows")).otherwise(0)).alias("rows_without_id"))
    least = F.min("least").over(Window.partitionBy("body"))
    first = F.when(F.col("least") == least, F.col("rows_of_least")).otherwise(0) + F.col("rows_without_id")
    firsts = cells.withColumn("firsts", first)
    copies_bit = 1 << FILTERS.index("E")
    split = firsts.select("part", "good", "toxic", F.inline(F.array(
        F.struct("mask", F.col("firsts").alias("rows")),
        F.struct((F.col("mask") + copies_bit).alias("mask"), (F.col("rows") - F.col("firsts")).alias("rows")))))
    return split.where(F.col("rows") > 0).groupBy("part", "mask").agg(
        F.sum("rows").alias("n"), F.sum(F.when(F.col("good"), F.col("rows")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic"), F.col("rows")).otherwise(0)).alias("toxic"))


class Diagram:
    """A weighted decision diagram over masks, whose levels can be swapped.

    A node is a number; ``parts[node]`` are its passing and failing child and
    ``weight[node]`` the documents below it. The leaves are one node per weight.
    """

    def __init__(self, masks: dict[int, tuple[int, ...]], filters: str):
        self.order = list(filters)
        self.none = (0,) * len(WEIGHTS)
        self.parts: list[tuple[int, int] | None] = []
        self.weight: list[tuple[int, ...]] = []
        self._known: dict = {}
        self.root = self._build(masks, 0, 0)

    def _node(self, children: tuple[int, int] | None, weight: tuple[int, ...]) -> int:
        key = children or weight
        if key not in self._known:
            self._known[key] = len(self.parts)
            self.parts.append(children)
            self.weight.append(weight)
        return self._known[key]

    def _join(self, passed: int, failed: int) -> int:
        total = tuple(a + b for a, b in zip(self.weight[passed], self.weight[failed]))
        return self._node((passed, failed), total)

    def _build(self, masks: dict, level: int, prefix: int) -> int:
        if level == len(self.order):
            return self._node(None, masks.get(prefix, self.none))
        return self._join(self._build(masks, level + 1, prefix), self._build(masks, level + 1, prefix | 1 << level))

    def swap(self, level: int) -> None:
        """Exchange the filters of ``level`` and the one below it."""
        seen: dict[int, int] = {}

        def rebuilt(node: int, depth: int) -> int:
            if node not in seen:
                passed, failed = self.parts[node]
                if depth < level:
                    seen[node] = self._join(rebuilt(passed, depth + 1), rebuilt(failed, depth + 1))
                else:
                    (pp, pf), (fp, ff) = self.parts[passed], self.parts[failed]
                    seen[node] = self._join(self._join(pp, fp), self._join(pf, ff))
            return seen[node]

        self.root = rebuilt(self.root, 0)
        self.order[level], self.order[level + 1] = self.order[level + 1], self.order[level]

    def all_passing(self) -> Iterator[tuple[str, tuple[int, ...], tuple[int, ...]]]:
        """``(filter, weight kept, weight removed)`` down the path on which every filter is passed."""
        node = self.root
        for name in self.order:
            passed, failed = self.parts[node]
            yield name, self.weight[passed], self.weight[failed]
            node = passed


def adjacent_swaps(n: int) -> Iterator[int]:
    """Levels to swap, one after the other, so that every order of ``n`` levels is visited once."""
    if n < 2:
        return
    inner = adjacent_swaps(n - 1)
    down = True
    while True:
        yield from (range(n - 2, -1, -1) if down else range(n - 1))
        step = next(inner, None)
        if step is None:
            return
        # The last level has come to one end; the others are swapped beside it.
        yield step + 1 if down else step
        down = not down


def audit_part(masks: dict[int, tuple[int, ...]], filters: str = FILTERS) -> list[tuple]:
    """``(order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley)`` of one part."""
    diagram = Diagram(masks, filters)
    steps: dict[str, list] = {}
    failing: dict[str, int] = {}
    alone: dict[str, int] = {}
    total = dict.fromkeys(filters, 0)
    swaps = adjacent_swaps(len(filters))
    while True:
        path = list(diagram.all_passing())
        steps["".join(diagram.order)] = path
        for name, _, removed in path:
            total[name] += removed[0]
        # A filter applied first removes all that fail it, one applied last those that fail nothing else.
        failing[path[0][0]], alone[path[-1][0]] = path[0][2][0], path[-1][2][0]
        level = next(swaps, None)
        if level is None:
            break
        diagram.swap(level)
    return [
        (order, step, kept[0], removed[0], failing[name] - removed[0], alone[name], removed[1], removed[2], total[name])
        for order, path in steps.items() for step, (name, kept, removed) in enumerate(path, 1)
    ]


def _audit(group: pd.DataFrame) -> pd.DataFrame:
    masks = {int(row.mask): (int(row.n), int(row.good), int(row.toxic)) for row in group.itertuples()}
    rows = [(group["part"].iloc[0], *row) for row in audit_part(masks)]
    return pd.DataFrame(rows, columns=[field.split()[0] for field in SCHEMA.split(", ")])


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Counts of every step of every order of the filters, per part. A part reaches its task as at most 32 rows."""
    masks = stage(weighted_masks(docs, labels))
    return masks.groupBy("part").applyInPandas(_audit, SCHEMA)
