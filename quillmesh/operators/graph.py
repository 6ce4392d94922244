"""Fixpoints: breadth-first search over links, and event lineage."""

from __future__ import annotations

from functools import reduce
from itertools import count

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillmesh.functions import urls
from quillmesh.storage import materialize, small_side


def reach(edges: DataFrame, roots: DataFrame, most_depth: int) -> DataFrame:
    """``node, depth`` of nodes within ``most_depth`` edges (src, dst) of the roots (node).

    One join a level; visited nodes go by an anti join; the driver only asks whether a level is empty.
    """
    level = materialize(roots.select("node").distinct().withColumn("depth", F.lit(0)), "level")
    visited = [level]
    for depth in range(1, most_depth + 1):
        found = edges.join(small_side(level.select(F.col("node").alias("src"))), "src").select(F.col("dst").alias("node")).distinct()
        seen = reduce(DataFrame.unionByName, visited).select("node")
        level = materialize(found.join(seen, "node", "left_anti").withColumn("depth", F.lit(depth)), "level")
        if level.isEmpty():
            break
        visited.append(level)
    return reduce(DataFrame.unionByName, visited)


def crawl(captured: DataFrame, links: DataFrame, root: str, most_depth: int = 2, most_artifacts: int = 50, mode: str = "simple", most_hops: int = 1000) -> DataFrame:
    """Bounded crawl over captured responses (url, http_status) and their links (url, position,
    link, is_pagination, is_resource): ``url, depth, wave, outcome, parent``.

    * mode "simple": links of pages at most at ``most_depth``; pagination keeps its page's depth; off-host
      links and links beyond the budget are recorded as rejected; the budget counts acquired pages.
    * mode "wave": only pages above ``most_depth`` are read, off-host links and links beyond the
      budget vanish, the budget counts attempts.

    A page's place in line is (its parent's place, the link's position). Pages that aren't captured,
    or have a status from 400 on, are attempted and fail. Each wave is one Spark job.
    """
    if mode not in ("simple", "wave"):
        raise ValueError("mode is simple or wave")
    simple = mode == "simple"
    spark = captured.sparkSession
    normal = urls.normalise_simple if simple else urls.normalise_wave
    pages = captured.select(normal(F.col("url")).alias("url"), (F.coalesce("http_status", F.lit(200)) < 400).alias("ok")).dropDuplicates(["url"])
    usable = links.where("NOT is_resource").select(normal(F.col("url")).alias("parent"), "position", normal(F.col("link")).alias("url"), "is_pagination")
    host = urls.domain(F.lit(root))
    start = spark.range(1).select(F.posexplode(urls.seeds(F.lit(root))).alias("place", "url")).select("place", normal(F.col("url")).alias("url"), F.lit(0).alias("depth"), F.lit(None).cast("string").alias("parent"))
    queue, waves, spent, last = materialize(start, "queue"), [], 0, -1
    for wave in count():
        if wave == most_hops:
            raise RuntimeError(f"the crawl hasn't ended after {most_hops} waves")
        first = Window.partitionBy("url").orderBy("place")
        fresh = queue.withColumn("__n", F.row_number().over(first)).where("__n = 1").drop("__n")
        if waves:
            fresh = fresh.join(reduce(DataFrame.unionByName, waves).select("url"), "url", "left_anti")
        judged = fresh.join(pages, "url", "left").withColumn("on_host", urls.domain(F.col("url")) == host).withColumn("ok", F.coalesce("ok", F.lit(False)))
        counted = (F.col("on_host") & F.col("ok")) if simple else F.col("on_host")
        # a wave is at most what is left of the site; its places are made dense for the budget
        before = F.coalesce(F.sum(counted.cast("int")).over(Window.orderBy("place").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        within = before + spent < most_artifacts
        outcome = F.when(~F.col("on_host"), "off_host").when(~within, "over_budget").when(F.col("ok"), "acquired").otherwise("failed")
        done = judged.withColumn("outcome", outcome)
        if not simple:
            done = done.where(F.col("outcome").isin("acquired", "failed"))
        done = materialize(done.select("url", "depth", F.lit(wave).alias("wave"), "outcome", "parent", "place"), "wave")
        size, used, last_place = done.agg(F.count(F.lit(1)), F.count_if(F.col("outcome") == "acquired") if simple else F.count(F.lit(1)), F.max("place")).first()
        if not size:
            break
        waves.append(done)
        spent, last = spent + used, max(last, last_place)
        read = done.where("outcome = 'acquired'") if simple else done.where((F.col("outcome") == "acquired") & (F.col("depth") < most_depth))
        deeper = F.when(F.col("is_pagination"), F.col("from_depth")).otherwise(F.col("from_depth") + 1)
        out = read.select(F.col("url").alias("parent"), F.col("depth").alias("from_depth"), F.col("place").alias("from_place")).join(usable, "parent")
        out = out.withColumn("depth", deeper).where(F.col("depth") <= most_depth)
        place = F.row_number().over(Window.orderBy("from_place", "position")) + last
        queue = materialize(out.select(place.cast("int").alias("place"), "url", "depth", "parent"), "queue")
    if not waves:
        return start.select("url", "depth", F.lit(0).alias("wave"), F.lit("").alias("outcome"), "parent").limit(0)
    return reduce(DataFrame.unionByName, waves).drop("place")


def lineage(events: DataFrame) -> DataFrame:
    """``run_id, event_id, depth, path`` of events reachable from an event without parent in their
    run; ordering by path gives a pre-order walk. Orphans and cycles are left out.

    Pointer doubling: each event knows its path below an ancestor, and takes over that ancestor's own
    path, so that rounds are the logarithm of the depth. An event that ends in no root after as many
    rounds as the number of events allows is in a cycle or hangs on one.
    """
    state = materialize(events.select("run_id", "event_id", F.col("parent_event_id").alias("above"), F.array("event_id").alias("path")), "lineage")
    for _ in range(max(1, state.count()).bit_length() + 1):
        open_ = state.where("above IS NOT NULL")
        if open_.isEmpty():
            break
        heads = state.select("run_id", F.col("event_id").alias("above"), F.col("above").alias("next"), F.col("path").alias("head"))
        # the join drops events whose ancestor isn't there
        moved = open_.join(heads, ["run_id", "above"]).select("run_id", "event_id", F.col("next").alias("above"), F.concat("head", "path").alias("path"))
        state = materialize(state.where("above IS NULL").unionByName(moved), "lineage")
    return state.where("above IS NULL").select("run_id", "event_id", (F.size("path") - 1).alias("depth"), "path")
