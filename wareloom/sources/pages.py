"""Captured web pages: listings, pagination and product pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from wareloom.functions import html
from wareloom.functions.urls import resolve_url
from wareloom.operators.keyed import keep_first, keep_last
from wareloom.session import stage
from wareloom.sources.feeds import ordinal

#: Ranks of a path that are joined at a time.
RANK_PART = 1024


def page_contents(pages: DataFrame, rules: dict = html.PRODUCT_RULES, item: str = html.LISTING_ITEM,
                  item_link=html.ITEM_LINK, next_link: str = html.NEXT_LINK) -> DataFrame:
    """``url, capture_seq, links, next_link, fields``: all that is read from each captured page, in one pass.

    Runs before any join, so page bodies are read once where they lie and only
    what was read is shuffled. Pages without a body give no row.
    """
    found = html.extract_page(F.col("html"), rules, item, item_link, next_link)
    return pages.where(F.col("html").isNotNull() & F.col("url").isNotNull()).select(
        "url", "capture_seq", found.alias("found")).select("url", "capture_seq", "found.*")


def latest_captures(contents: DataFrame) -> DataFrame:
    """The last capture of each URL; chosen among the narrow rows read from the pages."""
    return keep_last(contents, "url", ["capture_seq"])


def listing_outline(contents: DataFrame) -> DataFrame:
    """``url, links, next_url`` of every page that has any of them; ``links`` as they stand in the page."""
    return contents.select("url", "links", resolve_url(F.col("url"), F.col("next_link")).alias("next_url")).where(
        (F.size("links") > 0) | F.col("next_url").isNotNull())


def link_rows(outline: DataFrame) -> DataFrame:
    """``url, pos, link``, one row per listing item with a usable link, resolved against its page."""
    rows = outline.select("url", F.posexplode("links").alias("pos", "href"))
    return rows.select("url", "pos", resolve_url(F.col("url"), F.col("href")).alias("link"))


def page_edges(outline: DataFrame) -> DataFrame:
    """``url, next_url`` where a page names another page as its next one."""
    return outline.where(F.col("next_url").isNotNull() & (F.col("next_url") != F.col("url"))).select("url", "next_url")


def _follow(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``url, path, rank`` of pages whose way ends, and ``url, least`` of those on a ring.

    ``rows`` are ``url, at, rank, done, least``: where one step leads, or the
    page itself where none does. Steps double in length each round. A round
    brings more ways to their end as long as there are any, and once neither
    that nor the least page on a ring changes, the rest are rings.
    """
    rows, before = stage(rows), None
    while True:
        left = rows.where(~F.col("done")).agg(F.count(F.lit(1)), F.count_if("changed")).first()
        if left[0] == 0 or (before == left[0] and left[1] == 0):
            ended = rows.where("done").select("url", F.col("at").alias("path"), "rank")
            return ended, rows.where(~F.col("done")).select("url", "least")
        before = left[0]
        far = rows.select(*[F.col(c).alias(f"far_{c}") for c in rows.columns])
        on = rows.where(~F.col("done")).join(far, F.col("at") == F.col("far_url"))
        least = F.least("least", "far_least")
        moved = on.select(
            "url", F.col("far_at").alias("at"), (F.col("rank") + F.col("far_rank")).alias("rank"), F.col("far_done").alias("done"),
            least.alias("least"), (least != F.col("least")).alias("changed"))
        # Dealt out anew, or the number of files would double with each round.
        rows = stage(rows.where("done").unionByName(moved).repartition("url"))


def _single_steps(nodes: DataFrame, steps: DataFrame) -> DataFrame:
    """Rows for ``_follow``: each page with its step, if it has one."""
    joined = nodes.select("url").join(steps.select("url", "to"), "url", "left")
    none = F.col("to").isNull()
    return joined.select("url", F.coalesce("to", "url").alias("at"), F.when(none, 0).otherwise(1).cast("long").alias("rank"),
                         none.alias("done"), F.col("url").alias("least"), F.lit(True).alias("changed"))


def rank_pages(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``url, path, rank`` of each page, and ``path, next_path, entry``: which page of which path follows a path's end.

    Pages fall into paths, named by their last page; the rank counts down to
    it. Of pages that name the same next one, one goes on in its path, and the
    others' paths end before it. A ring is opened at its least page. Both are
    worked out from the edges alone, whatever walks there are, in as many
    rounds as the longest path has doublings.
    """
    # A page that names several next pages goes on with one of them.
    steps = stage(edges.groupBy("url").agg(F.min("next_url").alias("to")))
    nodes = steps.select("url").union(steps.select("to")).distinct()
    kept = steps.groupBy("to").agg(F.min("url").alias("url"))
    ranks, rings = _follow(_single_steps(nodes, kept))
    if not rings.isEmpty():
        opened = kept.join(rings, "url").where(F.col("to") != F.col("least")).select("url", "to")
        ranks = ranks.unionByName(_follow(_single_steps(rings, opened))[0])
    ranks = stage(ranks)
    ends = ranks.where(F.col("rank") == 0).select("path")
    after = steps.join(ends, F.col("url") == F.col("path")).select("path", F.col("to").alias("first"))
    entries = ranks.select(F.col("url").alias("first"), F.col("path").alias("next_path"), F.col("rank").alias("entry"))
    return ranks, stage(after.join(entries, "first").select("path", "next_path", "entry"))


def _path_ends(starts: DataFrame, jumps: DataFrame) -> DataFrame:
    """``walk, path, hop``: the ends of paths that a walk goes beyond, once each, with the hop of the page that follows."""
    leaving = jumps.select("path")
    reached = stage(starts.join(leaving, "path", "left_semi").select("walk", "path", (F.col("entry") + 1).alias("hop")))
    steps = stage(jumps.join(leaving.withColumnRenamed("path", "to"), F.col("next_path") == F.col("to")).select(
        "path", "to", (F.col("entry") + 1).alias("length")))
    while True:
        further = reached.join(steps, "path").select("walk", F.col("to").alias("path"), (F.col("hop") + F.col("length")).alias("hop"))
        new = stage(further.join(reached, ["walk", "path"], "left_anti"))
        if new.isEmpty():
            return reached
        reached = stage(keep_first(reached.union(new), ["walk", "path"], ["hop"]))
        far = steps.select(F.col("path").alias("to"), F.col("to").alias("farther"), F.col("length").alias("more"))
        steps = stage(steps.join(far, "to").select("path", F.col("farther").alias("to"), (F.col("length") + F.col("more")).alias("length")))


def pagination_chain(edges: DataFrame, seeds: DataFrame, max_pages: int | None = None) -> DataFrame:
    """``seed columns, hop, page_url``: the pages walked from each start URL, one row per page.

    The walk ends where no new page follows, so a loop ends where it closes.
    A walk is a few ranges of ranks, one for each path it takes; only these
    depend on the seeds, and pages are joined to them at the end, some ranks
    at a time. ``max_pages`` cuts chains; see ``cut_chains``.
    """
    ranks, jumps = rank_pages(edges)
    named = [F.col(c) for c in seeds.columns if c != "url"]
    walks = stage(seeds.select(F.monotonically_increasing_id().alias("walk"), *named, "url"))
    starts = stage(walks.join(ranks, "url").select("walk", "path", F.col("rank").alias("entry"), F.lit(0).cast("long").alias("hop")))
    ranges = starts
    if not jumps.isEmpty():
        entered = _path_ends(starts, jumps).join(jumps, "path").select("walk", F.col("next_path").alias("path"), "entry", "hop")
        ranges = starts.unionByName(entered)
    # A path entered once more, as loops are, leads to the place where it was entered first.
    by_path = Window.partitionBy("walk", "path").orderBy("hop")
    closes = F.when(F.row_number().over(by_path) > 1,
                    F.col("hop") + F.greatest(F.col("entry") - F.first("entry").over(by_path), F.lit(0)))
    limit = F.least(F.min("closes").over(Window.partitionBy("walk")), F.lit(max_pages).cast("long"))
    ranges = ranges.withColumn("closes", closes).withColumn("limit", limit)
    low = F.greatest(F.lit(0).cast("long"), F.coalesce(F.col("hop") + F.col("entry") + 1 - F.col("limit"), F.lit(0)))
    ranges = ranges.withColumn("low", low).where(F.col("low") <= F.col("entry"))
    part = F.expr(f"rank div {RANK_PART}")
    parts = F.expr(f"sequence(low div {RANK_PART}, entry div {RANK_PART})")
    placed = ranges.select("walk", "path", "entry", "hop", "low", F.explode(parts).alias("part"))
    found = placed.join(ranks.withColumn("part", part), ["path", "part"]).where(F.col("rank").between(F.col("low"), F.col("entry")))
    pages = found.select("walk", (F.col("hop") + F.col("entry") - F.col("rank")).alias("hop"), F.col("url").alias("page_url"))
    # Start pages that no edge touches are walks of one page.
    alone = walks.join(ranks, "url", "left_anti").select(*named, F.lit(0).cast("long").alias("hop"), F.col("url").alias("page_url"))
    chains = walks.drop("url").join(pages, "walk").select(*named, "hop", "page_url").unionByName(alone)
    return chains.withColumn("hop", F.col("hop").cast("int"))


def cut_chains(chain: DataFrame, edges: DataFrame, max_pages: int) -> DataFrame:
    """Seed columns of the chains that ``max_pages`` has cut, with the page that would follow."""
    steps = edges.groupBy("url").agg(F.min("next_url").alias("next_url"))
    last = chain.where(F.col("hop") == max_pages - 1)
    return last.join(steps, F.col("page_url") == F.col("url")).drop("url", "hop", "page_url")


def first_seen(links: DataFrame, group: list[str], link: str = "link", order: str = "ordinal") -> DataFrame:
    """Each link once per group, with the position where it was first seen."""
    return links.groupBy(*group, link).agg(F.min(order).alias(order))


def category_links(outline: DataFrame, chain: DataFrame) -> DataFrame:
    """``seed_no, category, link, ordinal``: distinct links of each category, from the pages its chain has."""
    found = chain.join(link_rows(outline), F.col("page_url") == F.col("url"))
    return first_seen(
        found.withColumn("ordinal", ordinal(F.col("hop"), F.col("pos"))), ["seed_no", "category"])


def product_fields(contents: DataFrame) -> DataFrame:
    """``url`` and one column per rule."""
    return contents.select("url", "fields.*")


def missing_pages(links: DataFrame, contents: DataFrame) -> DataFrame:
    """Links that have no captured page. ``contents`` stored in buckets of the URL are not shuffled."""
    captured = contents.select("url")
    return links.join(captured, links["link"] == captured["url"], "left_anti")
