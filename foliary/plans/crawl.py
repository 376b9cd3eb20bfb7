"""Breadth-first crawl as level-wide joins: frontier, fetch, links, unseen links."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foliary.functions import urls
from foliary.operators.manifests import running_total
from foliary.plans.tables import written
from foliary.sources.html import is_html, links_of
from foliary.sources.net import crawlable, robots_allowed


@dataclass(frozen=True)
class CrawlRules:
    max_pages: int = 50
    max_depth: int = 0
    domain_lock: bool = True
    respect_robots: bool = True
    user_agent: str = "foliary"


def crawl(spark: SparkSession, start_url: str, web: DataFrame, rules: CrawlRules = CrawlRules(), robots: DataFrame | None = None) -> DataFrame:
    """(url, depth, crawl_order, skip_reason) in breadth-first order.

    ``web`` stands for the network: (url, body, content_type, final_url
    nullable). ``robots`` is (origin, robots). Pages fetched, forbidden by
    robots, missing or off the domain use up the budget; pages off the section,
    print pages and repeats of a final address do not. Print pages are left out,
    their links are followed. Each level is a few joins, and its rows are
    written out; the driver keeps counts only.
    """
    if rules.max_pages < 1:
        raise ValueError("the page budget must be 1 or more")
    if not crawlable(start_url):
        raise ValueError(f"policy forbids {start_url!r}")
    start = spark.range(1).select(urls.normalize_url(F.lit(start_url)).alias("url")).withColumn("key", urls.dedup_key(F.col("url")))
    first = start.first()["url"]
    host = first.split("/")[2]
    scope = spark.range(1).select(urls.section_scope(F.lit(first)).alias("s")).first()["s"]
    # Keys of all addresses are made once; bodies are fetched by address for each level's hits only.
    keyed = web.select(urls.dedup_key(F.col("url")).alias("key"), F.col("url").alias("page_url"), urls.normalize_url(F.coalesce("final_url", "url")).alias("final"))
    keys = written(keyed.groupBy("key").agg(F.min(F.struct("page_url", "final")).alias("p")).select("key", "p.*"), "crawl")
    bodies = web.select(F.col("url").alias("page_url"), "body", "content_type").dropDuplicates(["page_url"])
    seen = start.select("key")
    emitted: DataFrame | None = None
    frontier = start.select("url", "key", F.lit(0).cast("bigint").alias("rank"))
    results: DataFrame | None = None
    used = 0
    for depth in range(rules.max_depth + 1):
        hit = written(frontier.join(keys, "key", "left").join(bodies, "page_url", "left"), "crawl")
        if robots is not None and rules.respect_robots:
            origin = F.concat(urls.scheme(F.col("url")), F.lit("://"), urls.authority(F.col("url")))
            told = hit.withColumn("origin", origin).join(robots, "origin", "left").withColumn("allowed", robots_allowed(F.col("robots"), F.col("url"), rules.user_agent))
        else:
            told = hit.withColumn("allowed", F.lit(True))
        final_key = F.coalesce(urls.dedup_key(F.col("final")), F.col("key"))
        off_domain = F.lit(rules.domain_lock) & (urls.authority(F.col("final")) != host)
        off_scope = F.lit(rules.domain_lock and scope is not None) & ~urls.within_scope(F.col("final"), F.lit(scope or ""))
        what = F.when(~F.col("allowed"), "robots").when(F.col("body").isNull(), "missing").when(off_domain, "domain").when(off_scope, "scope").when(urls.is_print_page(F.col("final"), F.col("body")), "print").otherwise("page")
        level = told.withColumn("what", what).withColumn("final_key", final_key)
        if emitted is not None:
            level = level.join(emitted.select("final_key", F.lit(True).alias("before")), "final_key", "left")
            level = level.withColumn("what", F.when((F.col("what") == "page") & F.coalesce("before", F.lit(False)), "repeat").otherwise(F.col("what"))).drop("before")
        again = F.row_number().over(Window.partitionBy("final_key", "what").orderBy("rank"))
        level = level.withColumn("what", F.when((F.col("what") == "page") & (again > 1), "repeat").otherwise(F.col("what")))
        costs = F.when(F.col("what").isin("page", "robots", "missing", "domain"), 1).otherwise(0)
        # The budget is used in rank order; ranks beyond the last that counts are cut.
        level = written(level.withColumn("costs", costs), "crawl")
        level = running_total(level, "rank", F.col("costs"), "spent").where(F.col("spent") + used < rules.max_pages)
        level = written(level.withColumn("depth", F.lit(depth)), "crawl")
        shown = level.where("costs = 1").select(F.when(F.col("what") == "page", F.col("final")).otherwise(F.col("url")).alias("url"), "depth", (F.col("spent") + used).cast("int").alias("crawl_order"), F.when(F.col("what") != "page", F.col("what")).alias("skip_reason"))
        results = shown if results is None else results.unionByName(shown)
        kept = level.where("what = 'page'").select("final_key")
        emitted = kept if emitted is None else emitted.unionByName(kept)
        used += level.agg(F.coalesce(F.sum("costs"), F.lit(0)).alias("n")).first()["n"]
        if used >= rules.max_pages or depth == rules.max_depth:
            break
        open_pages = level.where(F.col("what").isin("page", "print") & is_html(F.col("content_type"), F.col("body")))
        found = open_pages.select("rank", F.posexplode(links_of("body", "final")).alias("pos", "url"))
        if rules.domain_lock:
            found = found.where(urls.authority(F.col("url")) == host)
            if scope is not None:
                found = found.where(urls.within_scope(F.col("url"), F.lit(scope)))
        fresh = found.withColumn("key", urls.dedup_key(F.col("url")))
        seen = written(seen.unionByName(level.select(F.col("final_key").alias("key"))).distinct(), "crawl")
        fresh = fresh.join(seen, "key", "left_anti").groupBy("key").agg(F.min(F.struct("rank", "pos", "url")).alias("m"))
        fresh = written(fresh.select("m.url", "key", F.col("m.rank").alias("parent"), F.col("m.pos").alias("pos")), "crawl")
        offsets = running_total(fresh.groupBy("parent").agg(F.count("*").alias("n")), "parent", F.col("n"), "before").select("parent", "before")
        inner = F.row_number().over(Window.partitionBy("parent").orderBy("pos")) - 1
        frontier = written(fresh.withColumn("inner", inner).join(offsets, "parent").select("url", "key", (F.col("before") + F.col("inner")).alias("rank")), "crawl")
        if frontier.isEmpty():
            break
        seen = seen.unionByName(frontier.select("key"))
    return results
