"""A crawl that follows links round by round (H9 with the filters of H8, F1, F3, J4, H10).

Every host is crawled breadth first from its seeds. A round joins the frontier
with narrow page figures (texts stay where they were read) and decides in the
original's order what each page does next: a forbidden page is skipped; a page
in another script is dropped with its links; a blank page, one in another
language and one whose content was seen are not saved, but their links count; the
others are saved until the host has its budget, and nothing of a host's queue
behind that page is visited.

Places in a host's queue are paths of link positions, compared as arrays, so the
order of a round needs no sort of a host: the budget is a rank over the few new
pages of each host, cut early in every task, and a page is visited if it stands
no later than the one that fills the budget. A hub page or a host with a third
of all pages is an equal-key join that Spark can split. Rounds are written
tables, at most ``max_depth`` + 1 of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera import fixed
from tessera.session import stored


def crawl_links(pages: DataFrame, links: DataFrame, seeds: DataFrame, seen: DataFrame | None = None,
                per_host: int = fixed.CRAWL_MAX_PAGES, max_depth: int = fixed.CRAWL_MAX_DEPTH) -> DataFrame:
    """(page_id, host, depth, saved, place) of every page visited; ``place`` counts
    the saved pages of a host, null for others.

    ``pages``: page_id, host, allowed, filled, script, language (booleans) and
    content_hash, one row a page; ``links``: src, pos, dst (page ids; those to
    another host, to unknown pages and to pages queued before are not followed);
    ``seeds``: page_id, pos; ``seen``: content_hash of earlier cycles. Content
    is new if neither ``seen`` nor an earlier page of the same host has it; hosts
    do not wait for one another.
    """
    edges = links.select("src", "pos", "dst")
    old = seen.select("content_hash").distinct().withColumn("old", F.lit(True)) if seen is not None else None
    known = stored(pages.select("page_id", "host", "allowed", "filled", "script", "language", "content_hash"), "crawl-pages")
    at = F.array(F.col("pos").cast("int"))
    queued = stored(seeds.groupBy("page_id").agg(F.min(at).alias("at")), "crawl-seeds")
    frontier, visits, full = queued, None, None
    for depth in range(max_depth + 1):
        state = frontier.join(known, "page_id").where("allowed")
        if full is not None:
            state = state.join(full, "host", "left_anti")
        if old is not None:
            state = state.join(old, "content_hash", "left")
        state = stored(state.withColumn("good", F.col("filled") & F.col("script") & F.col("language")
                                        & (F.col("old").isNull() if old is not None else F.lit(True))), "crawl-state")
        new = state.where("good").groupBy("host", "content_hash").agg(F.min(F.struct("at", "page_id")).alias("first"))
        if visits is not None:
            saved = visits.where("saved")
            new = new.join(saved.select("host", "content_hash"), ["host", "content_hash"], "left_anti")
            had = saved.groupBy("host").agg(F.count("*").cast("int").alias("had"))
        # more than the budget is never needed of a host: the rank is cut in each task before the shuffle
        rank = F.row_number().over(Window.partitionBy("host").orderBy("first"))
        new = new.withColumn("rank", rank).where(F.col("rank") <= per_host)
        if visits is not None:
            new = new.join(had, "host", "left").withColumn("rank", F.col("rank") + F.coalesce("had", F.lit(0)))
        new = new.where(F.col("rank") <= per_host)
        new = stored(new.select("host", F.col("first.at").alias("saved_at"), F.col("first.page_id").alias("page_id"), "rank"), "crawl-new")
        ends = new.where(F.col("rank") == per_host).select("host", F.col("saved_at").alias("end"))
        visited = state.join(ends, "host", "left").where("end is null or at <= end").join(
            new.select("page_id", F.col("rank").alias("place")), "page_id", "left")
        visited = stored(visited.select("page_id", "host", F.lit(depth).alias("depth"), F.col("place").isNotNull().alias("saved"), "place",
                                        "content_hash", "at", (~F.col("filled") | F.col("script")).alias("follow")), "crawl-visited")
        visits = visited if visits is None else visits.unionByName(visited)
        full = ends.select("host") if full is None else full.unionByName(ends.select("host"))
        if depth == max_depth:
            break
        found = (visited.where("follow").join(full, "host", "left_anti").select(F.col("page_id").alias("src"), "host", "at")
                 .join(edges, "src").select(F.col("dst").alias("page_id"), "host", F.concat("at", F.array(F.col("pos").cast("int"))).alias("at"))
                 .groupBy("page_id", "host").agg(F.min("at").alias("at")))
        found = found.join(known.select("page_id", "host"), ["page_id", "host"]).join(queued, "page_id", "left_anti").select("page_id", "at")
        frontier = stored(found, "crawl-frontier")
        if frontier.isEmpty():
            break
        queued = queued.unionByName(frontier)
    return visits.select("page_id", "host", "depth", "saved", "place")
