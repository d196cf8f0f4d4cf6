"""SpotSigs document fingerprints.

A signature is an anchor, one of the common words below, with the chain of the
content words that follow it. A document's fingerprint is the set of its
signatures. Fingerprints are compared by Jaccard; for near pairs they are
partitioned by set length, and only sets whose lengths allow the wanted
similarity and that share one of their first signatures are compared.

Nulls and edge cases: a null text counts as empty; a text without signatures
has one made of all its words, or of the text itself where it has none, so
equal texts always have equal fingerprints; a null ``doc_id`` sorts first, rows
that share a ``doc_id`` follow each other by text; rows are never merged; an
empty table gives an empty result; the only document is its own next one.
"""

from __future__ import annotations

from math import log

from pyspark.sql import Column, DataFrame, Window, functions as F

from wareloom.llm.common import words

# Common words of English, French, German and Spanish.
ANCHORS = (
    "a an and are as at be by for from in is it of on or that the this to was what with "
    "au avec dans de des du elle en est et la le les ou par pour que qui sur un une "
    "das dem den der die ein eine für im ist mit nicht sich und von zu "
    "como con del el es esa eso las lo los no para por se su").split()
#: Content words in a signature.
CHAIN = 2
SIMILARITY = 0.8
#: Documents in a block are those whose ids agree but for so many last bits.
BITS = 10

_END = "\x01"


def with_signatures(df: DataFrame, text: str, out: str, chain: int = CHAIN) -> DataFrame:
    """``df`` with the array of the distinct signatures of a text column, in ascending order."""
    anchors = "|".join(ANCHORS)
    spoken = F.array_join(words(F.col(text)), " ")
    marked = df.withColumn("_spoken", spoken).withColumn(
        # Anchors are tied to the content word that follows: "the\1of\1word".
        "_tied", F.split(F.regexp_replace("_spoken", f"(?<![^ ])({anchors})(?: |$)", f"$1{_END}"), " "))
    tied = marked.withColumn("_content", F.transform("_tied", lambda t: F.substring_index(t, _END, -1)))
    # The last place may hold anchors without a content word.
    places = F.sequence(F.lit(0), F.size("_content") - F.lit(chain))

    def signatures(place):
        own = F.get("_tied", place)
        follow = F.slice("_content", place + 1, chain)
        front = F.split(own, _END)
        return F.when(
            own.contains(_END) & (F.element_at(follow, -1) != ""),
            F.transform(F.slice(front, 1, F.size(front) - 1), lambda anchor: F.xxhash64(anchor, follow)),
        ).otherwise(F.array().cast("array<bigint>"))

    found = tied.withColumn("_found", F.when(
        F.size("_content") >= chain, F.flatten(F.transform(places, signatures))).otherwise(F.array().cast("array<bigint>")))
    whole = F.array(F.xxhash64(F.when(F.col("_spoken") != "", F.col("_spoken")).otherwise(F.coalesce(F.col(text), F.lit("")))))
    made = F.when(F.size("_found") > 0, F.array_sort(F.array_distinct("_found"))).otherwise(whole)
    return found.withColumn(out, made).drop("_spoken", "_tied", "_content", "_found")


def likeness(left: str, right: str) -> Column:
    """Jaccard similarity of two columns of signatures."""
    shared = F.size(F.array_intersect(left, right))
    return shared / (F.size(left) + F.size(right) - shared)


def as_text(signatures: str) -> Column:
    return F.array_join(F.transform(signatures, lambda s: F.lower(F.hex(s))), ",")


def _followers(heads: DataFrame, bits: int) -> DataFrame:
    """``block, head, follower``: the head of the next block that has one, null after the last.

    Blocks are grouped by all but their last bits, again and again, so no
    window ever sees more than ``2 ** BITS`` rows.
    """
    if bits <= 0:
        return heads.withColumn("follower", F.lead("head").over(Window.partitionBy(F.lit(0)).orderBy("block")))
    parent = F.shiftright("block", BITS)
    beside = heads.withColumn("above", parent).withColumn(
        "beside", F.lead("head").over(Window.partitionBy("above").orderBy("block")))
    above = _followers(heads.groupBy(parent.alias("block")).agg(F.min("head").alias("head")), bits - BITS).select(
        F.col("block").alias("above"), F.col("follower").alias("later"))
    return beside.join(above, "above", "left").select("block", "head", F.coalesce("beside", "later").alias("follower"))


def with_next(docs: DataFrame, chain: int = CHAIN) -> DataFrame:
    """``doc_id, text, signatures, next_text, next_signatures``, the next document by ascending ``doc_id``.

    Texts move once, to blocks of close ids. Only the first text of each block
    moves again, to the block before.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    texts = texts.withColumn("place", F.coalesce("doc_id", F.lit(-(1 << 63)))).withColumn("block", F.shiftright("place", BITS))
    firsts = texts.groupBy("block").agg(F.min("place").alias("head"), F.min_by("text", F.struct("place", "text")).alias("head_text"))
    heads = firsts.select("block", "head")
    follow = _followers(heads, 64 - 2 * BITS)
    first_of_all = F.coalesce("follower", heads.agg(F.min("head")).scalar())
    later = follow.select("block", first_of_all.alias("follower")).join(
        firsts.select(F.col("head").alias("follower"), "head_text"), "follower")
    later = with_signatures(later, "head_text", "head_signatures", chain).select("block", "head_text", "head_signatures")
    order = Window.partitionBy("block").orderBy("place", "text")
    signed = with_signatures(texts, "text", "signatures", chain)
    led = signed.withColumns({
        "led_text": F.lead("text").over(order), "led_signatures": F.lead("signatures").over(order)})
    return led.join(later, "block", "left").select(
        "doc_id", "text", "signatures", F.coalesce("led_text", "head_text").alias("next_text"),
        F.coalesce("led_signatures", "head_signatures").alias("next_signatures"))


def edited(docs: DataFrame, chain: int = CHAIN) -> DataFrame:
    """Fingerprints of documents and of their edited texts, and how alike they are.

    The edit puts the beginning of the next document in place of the last
    quarter of the text.
    """
    quarter = F.floor(F.col("n_chars") / 4).cast("int")
    rows = with_next(docs, chain).withColumn("n_chars", F.char_length("text").cast("long"))
    kept = F.substring("text", F.lit(1), (F.col("n_chars") - quarter).cast("int"))
    rows = rows.withColumn("edited", F.concat(kept, F.substring("next_text", F.lit(1), quarter)))
    rows = with_signatures(rows, "edited", "edited_signatures", chain)
    return rows.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), as_text("signatures").alias("fingerprint"),
        as_text("edited_signatures").alias("edited_fingerprint"),
        likeness("signatures", "edited_signatures").alias("near_edited"),
        likeness("signatures", "next_signatures").alias("near_next"))


def near_pairs(docs: DataFrame, similarity: float = SIMILARITY, chain: int = CHAIN) -> DataFrame:
    """``left_id, right_id, likeness`` of documents with different fingerprints that are alike.

    Documents with equal fingerprints are stood for by the smallest id. Two sets
    of the wanted similarity lie in the same or in neighbouring length
    partitions, and share one of their first ``n - ceil(similarity * n) + 1``
    signatures.
    """
    signed = with_signatures(docs.select("doc_id", "text"), "text", "signatures", chain)
    sets = signed.groupBy("signatures").agg(F.min("doc_id").alias("id")).withColumn("n", F.size("signatures"))
    part = F.floor(F.log(F.col("n").cast("double")) / log(1 / similarity)).cast("int")
    front = F.slice("signatures", 1, F.col("n") - F.ceil(F.col("n") * similarity).cast("int") + 1)
    rows = sets.select("id", "n", "signatures", part.alias("part"), F.explode_outer(front).alias("s"))
    small = rows.select(F.col("id").alias("left_id"), F.col("n").alias("left_n"), F.col("s"),
                        F.explode(F.array("part", F.col("part") + 1)).alias("part"), F.col("signatures").alias("left"))
    large = rows.select(F.col("id").alias("right_id"), F.col("n").alias("right_n"), "s", "part", F.col("signatures").alias("right"))
    ordered = (F.col("left_n") < F.col("right_n")) | ((F.col("left_n") == F.col("right_n")) & (F.col("left_id") < F.col("right_id")))
    met = small.join(large, ["s", "part"]).where(ordered & (F.col("left_n") >= F.col("right_n") * similarity))
    # A pair is compared where its first shared signature is.
    first = F.array_min(F.array_intersect("left", "right")) == F.col("s")
    alike = met.where(first).select("left_id", "right_id", likeness("left", "right").alias("likeness"))
    return alike.where(F.col("likeness") >= similarity)
