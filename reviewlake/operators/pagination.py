"""Pagination chain (J3): from each start page follow ``next`` links.

A recursive CTE walks one link per round and is capped by Spark
(``spark.sql.cteRecursionLevelLimit``, ``spark.sql.cteRecursionRowLimit``).
Here the reach doubles every round: with every page within 2^k steps of a
start known, a jump table of 2^k steps gives the next 2^k pages, and the jump
table joined with itself the one of 2^(k+1) steps. A chain of length L needs
about log2(L) rounds. A page is kept once per start, at its smallest step, so
several chains may share pages, and a cycle ends when a round finds no page
that its start hasn't reached. Each round is written to the scratch folder,
so a lost executor repeats one round only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlake.session import written


def start_pages(links: DataFrame, url: str = "url", next_url: str = "next_url") -> DataFrame:
    """Pages that no link names: the starts if no URL list gives them."""
    named = links.where(F.col(next_url).isNotNull()).select(F.col(next_url).alias(url))
    return links.where(F.col(url).isNotNull()).select(url).distinct().join(named, url, "left_anti")


def pagination_chain(links: DataFrame, starts: DataFrame | None = None, url: str = "url",
                     next_url: str = "next_url") -> DataFrame:
    """``links(url, next_url)`` and ``starts(url)`` -> ``(root_url, url, page_no)``.

    A start has ``page_no`` 1 (if ``links`` holds the page). Without ``starts``
    every page without a predecessor is one. Of several next links of a page the
    smallest counts; a link to a page that ``links`` doesn't hold ends the chain."""
    pages = links.where(F.col(url).isNotNull())
    known = written(pages.groupBy(F.col(url).alias("u")).agg(F.min(next_url).alias("v")), "links")
    first = start_pages(links, url, next_url) if starts is None else starts.select(url).distinct()
    first = first.join(known.select(F.col("u").alias(url)), url, "left_semi")
    reached = written(first.select(F.col(url).alias("root"), F.col(url).alias("u"), F.lit(0).cast("long").alias("step")), "chain")
    jump = known.where("v IS NOT NULL").join(known.select(F.col("u").alias("v")), "v", "left_semi").select("u", "v")
    span = 1
    while True:
        ahead = reached.join(jump, "u").select("root", F.col("v").alias("u"), (F.col("step") + span).alias("step"))
        new = written(ahead.groupBy("root", "u").agg(F.min("step").alias("step"))
                      .join(reached.select("root", "u"), ["root", "u"], "left_anti"), "chain")
        if new.isEmpty():
            break
        reached = reached.unionByName(new)
        span *= 2
        jump = written(jump.select("u", F.col("v").alias("w")).join(
            jump.select(F.col("u").alias("w"), "v"), "w").select("u", "v"), "jump")
    return reached.select(F.col("root").alias("root_url"), F.col("u").alias(url),
                          (F.col("step") + 1).cast("int").alias("page_no"))
