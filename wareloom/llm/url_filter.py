"""Judging URLs by rules and, where no rule fits, by gradient-boosted trees.

The trees see lexical features: lengths, depth, ratios, entropy, parameter
counts, and statistics of the host's suffix over the table. None of them tells
a verdict, or the top-level domain that a rule may name. They learn from
labelled URLs, or else from those that the rules judge, at most ``FIT_ROWS``
distinct ones, chosen by hash.

Nulls and edge cases: a null URL, or one without ``://``, has an empty host and
path, fits no rule and is judged by the trees like any other; rows are never
merged or dropped; if the rules judge nothing, the others are allowed, and if
they all say the same, the others get that verdict; an empty table gives an
empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from wareloom.llm.common import is_small
from wareloom.session import stage

#: (host and path, verdict)
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
FIT_ROWS = 20_000
TREES = 12
DEPTH = 3


def host_of(url: Column) -> Column:
    """Between the first ``://`` and the next ``/``, ``?`` or ``#``, A-Z in lower case; empty without ``://``."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://[^/?#]*([^?#]*)", 1)


def rule_for(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict."""
    def fits(rule):
        rule_host, slash, rule_path = rule.partition("/")
        return ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(slash + rule_path)

    longest = sorted(rules, key=lambda rule: -len(rule[0]))
    nothing = F.lit(None).cast("string")
    return tuple(
        reduce(lambda rest, rule: F.when(fits(rule[0]), rule[n]).otherwise(rest), reversed(longest), nothing)
        for n in (0, 1))


def _entropy(text: Column) -> Column:
    """Shannon entropy of the characters, in bits; 0 for an empty text."""
    size = F.char_length(text)
    shares = F.transform(
        F.array_distinct(F.split(text, "")),
        lambda c: (size - F.char_length(F.replace(text, c, F.lit("")))) / F.greatest(size, F.lit(1)))
    return -F.coalesce(F.aggregate(shares, F.lit(0.0), lambda total, p: total + F.when(p > 0, p * F.log2(p)).otherwise(0.0)),
                       F.lit(0.0))


LEXICAL = {
    "f_length": lambda url, host, path: F.char_length(url),
    "f_host_length": lambda url, host, path: F.char_length(host),
    "f_labels": lambda url, host, path: F.size(F.split(host, r"\.")),
    "f_depth": lambda url, host, path: F.char_length(path) - F.char_length(F.replace(path, F.lit("/"), F.lit(""))),
    "f_segment": lambda url, host, path: F.char_length(F.split_part(path, F.lit("/"), F.lit(2))),
    "f_digits": lambda url, host, path: F.regexp_count(url, F.lit("[0-9]")) / F.greatest(F.char_length(url), F.lit(1)),
    "f_entropy": lambda url, host, path: _entropy(url),
    "f_parameters": lambda url, host, path: F.regexp_count(url, F.lit(r"[?&][^=&#]+=")),
    "f_hyphens": lambda url, host, path: F.regexp_count(url, F.lit("[-_]")),
    "f_fragment": lambda url, host, path: url.contains("#").cast("int"),
}
SUFFIX = ("f_suffix_urls", "f_suffix_hosts", "f_suffix_length", "f_suffix_parameters")
FEATURES = (*LEXICAL, *SUFFIX)


def _parsed(urls: DataFrame, *keep: str) -> DataFrame:
    return urls.select(*keep, "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))


def lexical(urls: DataFrame) -> DataFrame:
    """``urls`` (with ``url``, ``host``, ``path``) with the lexical features and the suffix of the host, its last three labels.

    Rules name one or two labels, so the suffix is longer than what they say.
    """
    url = F.coalesce("url", F.lit(""))
    return urls.select("*", *[make(url, F.col("host"), F.col("path")).cast("double").alias(name)
                              for name, make in LEXICAL.items()],
                       F.substring_index("host", ".", -3).alias("_suffix"))


def suffix_statistics(rows: DataFrame) -> DataFrame:
    """``_suffix`` and what its URLs are like: their number, hosts, mean length and mean number of parameters; no verdicts."""
    return rows.groupBy("_suffix").agg(
        F.log1p(F.count(F.lit(1))).alias("f_suffix_urls"), F.log1p(F.approx_count_distinct("host")).alias("f_suffix_hosts"),
        F.avg("f_length").alias("f_suffix_length"), F.avg("f_parameters").alias("f_suffix_parameters"))


def _attach(rows: DataFrame, statistics: DataFrame) -> DataFrame:
    """Left join that moves ``rows`` only if the suffixes are too many to broadcast; noughts for a suffix not in the table."""
    small = is_small(statistics)
    return rows.join(F.broadcast(statistics) if small else statistics, "_suffix", "left").fillna(0.0, list(SUFFIX))


def learn(labelled: DataFrame, statistics: DataFrame, fit_rows: int = FIT_ROWS):
    """A function that adds ``score``, the probability of a block, to rows with the features.

    ``labelled`` has ``url, verdict``; rows without a verdict are left out, a
    URL counts once, and as blocked where its rows say both.
    """
    known = labelled.where(F.col("verdict").isNotNull()).groupBy("url").agg(
        F.max(F.col("verdict") == "block").cast("double").alias("label"))
    drawn = known.orderBy(F.xxhash64("url"), "url").limit(fit_rows)
    sample = stage(_attach(lexical(_parsed(drawn, "label")), statistics).select("label", *FEATURES))
    labels = sorted(row.label for row in sample.select("label").distinct().collect())
    if len(labels) < 2:
        fixed = labels[0] if labels else 0.0
        return lambda rows: rows.withColumn("score", F.lit(fixed))
    assembler = VectorAssembler(inputCols=list(FEATURES), outputCol="_features")
    trees = GBTClassifier(featuresCol="_features", labelCol="label", maxIter=TREES, maxDepth=DEPTH, stepSize=0.2, seed=7)
    model = trees.fit(assembler.transform(sample).select("label", "_features").coalesce(4))
    return lambda rows: model.transform(assembler.transform(rows)).withColumn(
        "score", F.element_at(vector_to_array("probability"), 2))


def judge(pages: DataFrame, rules=RULES, fit_rows: int = FIT_ROWS, labelled: DataFrame | None = None) -> DataFrame:
    """``page_id, url, host, path, rule, verdict, score``; ``score`` is the trees' probability of a block.

    The trees learn from ``labelled`` (``url, verdict``), or else from the URLs
    that the rules judge.
    """
    rule, verdict = rule_for(F.col("host"), F.col("path"), rules)
    rows = lexical(_parsed(pages, "page_id").select("*", rule.alias("rule"), verdict.alias("verdict")))
    statistics = stage(suffix_statistics(rows))
    score = learn(rows if labelled is None else labelled, statistics, fit_rows)
    guessed = F.when(F.col("score") >= 0.5, "block").otherwise("allow")
    return score(_attach(rows, statistics)).select(
        "page_id", "url", "host", "path", "rule", F.coalesce("verdict", guessed).alias("verdict"), "score")
