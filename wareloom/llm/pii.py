"""Personal data and the terms that give it away.

Patterns find the protected entities. How strongly a term reveals an entity is
estimated from the corpus: with documents as events, the pointwise mutual
information of entity and term, over the information content of the entity.
It is 1 where the term only occurs together with the entity. In the documents
that hold the entity, every occurrence of such a term is generalised from
``GENERALISE`` on, and removed from ``REMOVE`` on. Evidence needs ``SUPPORT``
documents. Terms that are too common to reveal any entity are left out before
terms and entities meet; those that stand in the same documents meet as one.

A term is a word of at least ``LETTERS`` letters, wherever it stands in the
text. Entities are compared in lower case, numbers by their digits.
``neighbours`` gives the terms within ``REACH`` code points only, for callers
who want those; ``protect`` has no such window.

Nulls and edge cases: a null text counts as empty; an empty text has no spans;
all statistics count rows that share text and ``doc_id`` once, and such rows
get the same result; rows are never merged; an empty table gives an empty
result. Spans are in code points, their end exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from wareloom.llm.common import is_small
from wareloom.session import stage

GENERALISE = 0.6
REMOVE = 0.9
SUPPORT = 2
REACH = 64
LETTERS = 3

#: Kinds in the order they are listed where spans begin together.
KINDS = ("email", "ip", "card", "phone", "generalise", "remove")

# Each gives the matches of the plain pattern beside it. A match of the plain pattern begins where a run begins
# or where the last match ended; saying so keeps long runs without a match linear.
PATTERNS = {
    # [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    # [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    # [0-9]([\x20-]?[0-9])+
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    # \+[0-9][\x20().0-9-]+[0-9]
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must hold for the pattern to be worth a try.
NEEDS = {"email": "@", "ip": ".", "card": None, "phone": "+"}

_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
_TERM = rf"\p{{L}}{{{LETTERS},}}+"

_SPANS = "array<struct<start:int,stop:int,value:string,before:string,after:string>>"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _valid(kind: str, value: Column) -> Column:
    digits = F.length(_digits(value))
    return {
        "email": F.lit(True),
        "ip": value.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$"),
        "card": digits.between(14, 19) & F.call_function("luhn_check", _digits(value)),
        "phone": digits.between(10, 15),
    }[kind]


#: Matches in a block: adding to an array copies it, so the places are worked out block by block.
_BLOCK = 256


def _with_places(df: DataFrame, text: str, pattern: str, out: str, needs: str | None = None, reach: int = 0) -> DataFrame:
    """``df`` with the places of all matches of a pattern in a text column.

    They follow from the lengths of the matches and of the texts between them.
    Each comes with a stretch of text on either side.
    """
    nothing = F.array().cast("array<string>")
    body = F.col(text)
    found, gaps = F.regexp_extract_all(body, F.lit(pattern), F.lit(0)), F.split(body, pattern, -1)
    if needs:
        found = F.when(F.contains(body, F.lit(needs)), found).otherwise(nothing)
    rows = df.withColumn("_matches", found)
    rows = rows.withColumn("_gaps", F.when(F.size("_matches") > 0, gaps).otherwise(nothing))
    rows = rows.withColumn("_blocks", F.expr(
        f"if(size(_matches) = 0, cast(array() as array<int>), sequence(0, (size(_matches) - 1) div {_BLOCK}))"))
    last = f"least(b * {_BLOCK} + {_BLOCK}, size(_matches)) - 1"
    length = "char_length(_gaps[i]) + char_length(_matches[i])"
    rows = rows.withColumn("_begins", F.expr(
        "aggregate(_blocks, array(0), (acc, b) -> concat(acc, array(element_at(acc, -1) +"
        f" aggregate(sequence(b * {_BLOCK}, {last}), 0, (total, i) -> total + {length}))))"))
    start = "acc.at + char_length(_gaps[i])"
    span = (f"named_struct('start', {start}, 'stop', acc.at + {length}, 'value', _matches[i],"
            f" 'before', right(_gaps[i], {reach + 1}), 'after', left(_gaps[i + 1], {reach + 1}))")
    return rows.withColumn(out, F.expr(
        f"flatten(transform(_blocks, b -> aggregate(sequence(b * {_BLOCK}, {last}),"
        f" named_struct('at', _begins[b], 'spans', cast(array() as {_SPANS})),"
        f" (acc, i) -> named_struct('at', acc.at + {length}, 'spans', concat(acc.spans, array({span}))),"
        f" acc -> acc.spans)))")).drop("_matches", "_gaps", "_blocks", "_begins")


def mentions(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """``doc_id, key, spans, text``: the valid matches of all kinds with their surroundings.

    ``key`` is the text's hash; ``text`` is null where there is no match.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("_text"))
    for kind, pattern in PATTERNS.items():
        rows = _with_places(rows, "_text", pattern, f"_{kind}", NEEDS[kind], reach)

    def named(number, kind):
        good = F.filter(f"_{kind}", lambda s: _valid(kind, s["value"]))
        entity = (lambda v: F.lower(v)) if kind in ("email", "ip") else _digits
        return F.transform(good, lambda s: F.struct(
            s["start"].alias("start"), F.lit(number).alias("kind"), s["stop"].alias("stop"),
            F.concat(F.lit(f"{kind}:"), entity(s["value"])).alias("entity"), s["before"].alias("before"), s["after"].alias("after")))

    every = F.concat(*[named(number, kind) for number, kind in enumerate(PATTERNS)])
    sorted_rows = rows.select("doc_id", F.xxhash64("_text").alias("key"), F.array_sort(every).alias("spans"), "_text")
    return sorted_rows.select("doc_id", "key", "spans", F.when(F.size("spans") > 0, F.col("_text")).alias("text"))


def neighbours(found: DataFrame, reach: int = REACH) -> DataFrame:
    """``doc_id, key, entity, term, start, stop``: the terms near each mention."""
    rows = found.select("doc_id", "key", F.explode("spans").alias("s")).select("doc_id", "key", "s.*")
    sides = []
    for side in ("before", "after"):
        placed = _with_places(rows.select("doc_id", "key", "entity", "start", "stop", side), side, _TERM, "_terms")
        begin = F.col("start") - F.char_length(side) if side == "before" else F.col("stop")
        cut = F.char_length(side) > reach
        terms = placed.select("doc_id", "key", "entity", begin.alias("begin"), cut.alias("cut"),
                              F.char_length(side).alias("length"), F.explode_outer("_terms").alias("t"))
        # A word at the far edge may be cut off.
        whole = F.col("t.start") > 0 if side == "before" else F.col("t.stop") < F.col("length")
        sides.append(terms.where(F.col("t").isNotNull() & (~F.col("cut") | whole)).select(
            "doc_id", "key", "entity", F.lower("t.value").alias("term"), (F.col("begin") + F.col("t.start")).alias("start"),
            (F.col("begin") + F.col("t.stop")).alias("stop")))
    return sides[0].union(sides[1])


def _documents(rows: DataFrame, *columns: str) -> DataFrame:
    """Number of documents of each combination of ``columns``."""
    once = rows.groupBy(*columns, "doc_id", "key").agg(F.lit(1).alias("one"))
    return once.groupBy(*columns).agg(F.count(F.lit(1)).alias("documents"))


def _terms(text: str) -> Column:
    """The distinct terms of a text."""
    every = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(_TERM), F.lit(0))
    return F.array_distinct(F.transform(every, lambda word: F.lower(word)))


def _sets(rows: DataFrame, column: str, held: str) -> DataFrame:
    """``column`` with the number and the two digests of the documents that hold it, as the struct ``held``.

    ``rows`` name each document once for each value. Values with equal structs
    stand in the same documents.
    """
    return rows.groupBy(column).agg(F.struct(
        F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("doc_id", "key")).alias("a"),
        F.bit_xor(F.xxhash64(F.lit(1), "key", "doc_id")).alias("b")).alias(held))


def _entity_documents(found: DataFrame) -> DataFrame:
    rows = found.select("doc_id", "key", F.explode("spans.entity").alias("entity"))
    return rows.groupBy("doc_id", "key", "entity").agg(F.lit(1).alias("one")).drop("one")


def _term_counts(docs: DataFrame, found: DataFrame, terms: DataFrame) -> DataFrame:
    """``term, with_term``: the number of documents that hold each of ``terms``, of rows with equal id and text only one."""
    again = stage(found.groupBy(F.col("doc_id").alias("_doc"), F.col("key").alias("_key")).agg(
        F.count(F.lit(1)).alias("times")).where(F.col("times") > 1))
    if is_small(again):
        again = F.broadcast(again)
    rows = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("key"), "text")
    single = rows.join(again, _same_document("_doc", "_key"), "left_anti")
    several = rows.join(again, _same_document("_doc", "_key"), "left_semi").dropDuplicates(["doc_id", "key"])
    held = single.union(several).select(F.explode_outer(_terms("text")).alias("term"))
    held = held.join(F.broadcast(terms) if is_small(terms) else terms, "term")
    # Counted before any shuffle by term, as some terms are in most documents.
    return held.groupBy("term").agg(F.count(F.lit(1)).alias("with_term"))


def _total(found: DataFrame) -> Column:
    """The number of documents, those of equal id and text counted once."""
    return F.lit(found.select("doc_id", "key").distinct().count()).cast("double")


def _disclosure(total: Column, together: Column, with_entity: Column, with_term: Column) -> Column:
    """Mutual information over the entity's information; null for an entity that all documents hold."""
    information = F.log(total / with_entity)
    return F.when(information > 0, F.log(total * together / (with_entity * with_term)) / information)


def disclosures(docs: DataFrame, found: DataFrame, near: DataFrame, support: int = SUPPORT) -> DataFrame:
    """``entity, term, disclosure`` of the pairs in ``near`` with enough support."""
    together = stage(_documents(near, "entity", "term").where(F.col("documents") >= support))
    entities = _documents(_entity_documents(found), "entity").withColumnRenamed("documents", "with_entity")
    counted = _term_counts(docs, found, together.select("term").distinct())
    value = _disclosure(_total(found), F.col("documents"), F.col("with_entity"), F.col("with_term"))
    joined = together.join(entities, "entity").join(counted, "term")
    return joined.select("entity", "term", value.alias("disclosure")).where("disclosure is not null")


def _same_document(doc: str, key: str) -> Column:
    return F.col("doc_id").eqNullSafe(F.col(doc)) & (F.col("key") == F.col(key))


def _holders(found: DataFrame, support: int) -> DataFrame:
    """``doc_id, key, entities, text``: the documents that hold entities with support, each once.

    ``entities`` are the structs of ``_sets``: entities that stand in the same documents count as one.
    """
    rows = stage(_entity_documents(found))
    sets = stage(_sets(rows, "entity", "held").where(F.col("held.n") >= support))
    listed = rows.join(sets, "entity").groupBy(F.col("doc_id").alias("_doc"), F.col("key").alias("_key")).agg(
        F.collect_set("held").alias("entities"))
    texts = found.where(F.col("text").isNotNull()).select("doc_id", "key", "text").dropDuplicates(["doc_id", "key"])
    return texts.join(listed, _same_document("_doc", "_key")).select("doc_id", "key", "entities", "text")


def _possible_terms(docs: DataFrame, found: DataFrame, terms: DataFrame, total: Column, generalise: float, support: int) -> DataFrame:
    """``term, words``: the terms that can reach ``generalise`` with some entity; ``words`` is alike for those that stand alike.

    Of a term that ``n`` holders have, and ``m`` documents altogether, the
    disclosure is the largest for an entity that just these n documents hold.
    """
    sets = stage(_sets(terms, "term", "held").where(F.col("held.n") >= support))
    counted = sets.join(_term_counts(docs, found, sets.select("term")), "term")
    rest = F.log(F.col("with_term") / F.col("held.n"))
    possible = rest <= (1 - generalise) * F.log(total / F.col("held.n")) + 1e-9
    return counted.where(possible).select("term", F.struct("held", "with_term").alias("words"))


def _pairs(termed: DataFrame) -> DataFrame:
    """``doc_id, key, words, entity``: the kinds of terms and entities of each document."""
    once = termed.groupBy("doc_id", "key", "words").agg(F.first("entities").alias("entities"))
    return once.select("doc_id", "key", "words", F.explode("entities").alias("entity"))


def telling_terms(docs: DataFrame, found: DataFrame, generalise: float = GENERALISE, support: int = SUPPORT) -> DataFrame:
    """``doc_id, key, start, stop, disclosure``: every occurrence of the terms that reveal an entity of their document."""
    holders = stage(_holders(found, support))
    # The outer forms keep Spark from working out terms and places a second time to test for empty ones.
    terms = holders.select("doc_id", "key", "entities", F.explode_outer(_terms("text")).alias("term")).where("term is not null")
    total = _total(found)
    possible = stage(_possible_terms(docs, found, terms, total, generalise, support))
    termed = stage(terms.join(F.broadcast(possible) if is_small(possible) else possible, "term"))
    pairs = _pairs(termed)
    # A document's kinds are distinct, so rows are documents.
    counted = pairs.groupBy("entity", "words").agg(F.count(F.lit(1)).alias("documents")).where(F.col("documents") >= support)
    value = _disclosure(total, F.col("documents"), F.col("entity.n"), F.col("words.with_term"))
    telling = stage(counted.select("entity", "words", value.alias("disclosure")).where(F.col("disclosure") >= generalise))
    best = pairs.join(F.broadcast(telling) if is_small(telling) else telling, ["entity", "words"]).groupBy(
        F.col("doc_id").alias("_doc"), F.col("key").alias("_key"), F.col("words").alias("_words")).agg(
        F.max("disclosure").alias("disclosure"))
    marked = stage(termed.join(best, _same_document("_doc", "_key") & (F.col("words") == F.col("_words"))).select(
        "_doc", "_key", F.col("term").alias("_term"), "disclosure"))
    # The texts are looked through for places only where they hold such a term.
    some = marked.select("_doc", "_key").distinct()
    texts = holders.join(some, _same_document("_doc", "_key"), "left_semi").select("doc_id", "key", "text")
    placed = _with_places(texts, "text", _TERM, "_places").select("doc_id", "key", F.explode_outer("_places").alias("t"))
    words = placed.where("t is not null").select("doc_id", "key", F.lower("t.value").alias("term"), "t.start", "t.stop")
    return words.join(marked, _same_document("_doc", "_key") & (F.col("term") == F.col("_term"))).select(
        "doc_id", "key", "start", "stop", "disclosure")


def protect(docs: DataFrame, generalise: float = GENERALISE, remove: float = REMOVE, support: int = SUPPORT) -> DataFrame:
    """``doc_id, key, spans, base``: all spans of every document, and those of the patterns alone.

    Spans are structs of start, kind (a place in ``KINDS``) and stop, in order.
    """
    found = stage(mentions(docs, 0))
    marked = (
        telling_terms(docs, found, generalise, support)
        .withColumn("kind", F.when(F.col("disclosure") >= remove, KINDS.index("remove")).otherwise(KINDS.index("generalise")))
        .groupBy(F.col("doc_id").alias("_doc"), F.col("key").alias("_key"))
        .agg(F.collect_list(F.struct("start", "kind", "stop")).alias("_more"))
    )
    base = F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["stop"].alias("stop")))
    rows = found.select("doc_id", "key", base.alias("base")).join(marked, _same_document("_doc", "_key"), "left")
    apart = F.filter("_more", lambda m: ~F.exists(
        "base", lambda b: (b["start"] < m["stop"]) & (m["start"] < b["stop"])))
    spans = F.when(F.col("_more").isNull(), F.col("base")).otherwise(F.array_sort(F.concat("base", apart)))
    return rows.select("doc_id", "key", spans.alias("spans"), "base")


def as_text(spans: str, kinds=KINDS) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    names = F.array(*[F.lit(kind) for kind in kinds])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["stop"].cast("string"))), ",")


def count_of(kind: str) -> Column:
    number = KINDS.index(kind)
    return F.size(F.filter("base", lambda s: s["kind"] == number)).cast("long")


def sanitise(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` with entities and generalised terms replaced by their kind, and removed terms gone.

    Where spans overlap the one that begins first counts.
    """
    found = protect(docs).select(F.col("doc_id").alias("_doc"), F.col("key").alias("_key"), "spans").dropDuplicates(["_doc", "_key"])
    rows = docs.select("doc_id", "text").withColumn("_hash", F.xxhash64(F.coalesce("text", F.lit(""))))
    rows = rows.join(found, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("_hash") == F.col("_key")))
    kept = rows.withColumn("_kept", F.expr(
        "aggregate(spans, cast(array() as array<struct<start:int,kind:int,stop:int>>),"
        " (kept, s) -> if(size(kept) = 0 or kept[size(kept) - 1].stop <= s.start, concat(kept, array(s)), kept))"))
    marks = ", ".join("''" if kind == "remove" else f"'[{'TERM' if kind == 'generalise' else kind.upper()}]'" for kind in KINDS)
    pieces = F.expr(
        f"concat(transform(_kept, (s, i) -> concat(substring(text, if(i = 0, 0, _kept[i - 1].stop) + 1,"
        f" s.start - if(i = 0, 0, _kept[i - 1].stop)), array({marks})[s.kind])),"
        f" array(substring(text, _kept[size(_kept) - 1].stop + 1)))")
    return kept.select("doc_id", F.when(F.size("_kept") > 0, F.array_join(pieces, "")).otherwise(F.col("text")).alias("text"))
