"""Breadth-first crawl of a link graph that is already fetched."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.shared import written


def page_links(pages: DataFrame, title: Column, html: Column) -> DataFrame:
    """Edges (source, target) of the pages' own links, without repeats."""
    targets = F.regexp_extract_all(html, F.lit(r'<a href="/([^"#]+)"'), F.lit(1))
    return pages.select(title.alias("source"), F.explode(targets).alias("target")).distinct()


def crawl(edges: DataFrame, seeds: DataFrame, max_depth: int, max_pages: int | None = None) -> DataFrame:
    """title and depth of what is reached from seeds (`title`) in at most max_depth links.

    One join per level; only the frontier is joined. With max_pages, titles are taken by depth, then
    title, as a crawl that visits a level in order does. Seeds that do not exist count as visited.
    """
    visited = seeds.select("title").distinct().withColumn("depth", F.lit(0))
    frontier = visited
    for depth in range(1, max_depth + 1):
        found = edges.join(frontier.select(F.col("title").alias("source")), "source").select(F.col("target").alias("title")).distinct()
        frontier = found.join(visited.select("title"), "title", "left_anti").withColumn("depth", F.lit(depth))
        if depth < max_depth:
            frontier = written(frontier, "frontier")
            if frontier.isEmpty():
                break
        visited = visited.unionByName(frontier)
    return visited if max_pages is None else visited.orderBy("depth", "title").limit(max_pages)


def crawl_seeds(edges: DataFrame, seeds: DataFrame, max_depth: int) -> DataFrame:
    """seed, title and depth: a crawl from each title of `seeds` (`title`) of its own, so that a page reached from two seeds comes twice."""
    tagged = edges.select("source", "target")
    visited = seeds.select(F.col("title").alias("seed"), "title").distinct().withColumn("depth", F.lit(0))
    frontier = visited
    for depth in range(1, max_depth + 1):
        found = tagged.join(frontier.select("seed", F.col("title").alias("source")), "source").select("seed", F.col("target").alias("title")).distinct()
        frontier = written(found.join(visited.select("seed", "title"), ["seed", "title"], "left_anti").withColumn("depth", F.lit(depth)), "frontier")
        if frontier.isEmpty():
            break
        visited = visited.unionByName(frontier)
    return visited


def crawl_index(visited: DataFrame) -> DataFrame:
    """A row per first character of titles (prefix): the sorted titles and their number."""
    return visited.groupBy(F.substring("title", 1, 1).alias("prefix")).agg(F.array_sort(F.collect_set("title")).alias("titles"), F.countDistinct("title").alias("pages"))
