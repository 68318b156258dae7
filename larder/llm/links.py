"""Groups from links: which candidates to verify, and connected components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.llm.tables import deleted, scratch, written


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(v, c) for each end of ``edges`` (a, b): c is the least id reachable.

    Union-find as joins: a large step links all neighbours above a node to its least neighbour, a small step those below
    it, until nothing changes. Rounds grow with the logarithm of the longest chain. Each round is written and the one
    before it deleted.
    """
    with scratch():
        now = _settled(edges, max_rounds)
        return written(now.select(F.col("u").alias("v"), F.col("m").alias("c")).union(now.select("m", "m").distinct()), "components", outlives=True)


def _settled(edges: DataFrame, max_rounds: int) -> DataFrame:
    now = written(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("m")).distinct(), "union-find")
    before = None
    for _ in range(max_rounds):
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("u", "m").cast("decimal(38,0)"))).first()
        if tuple(mark) == before:
            break
        before = tuple(mark)
        both = now.select("u", F.col("m").alias("v")).union(now.select(F.col("m").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("m"))
        up = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), "m").distinct()
        low = up.groupBy("u").agg(F.min("m").alias("low"))
        down = up.join(low, "u").select(F.explode(F.array(F.struct("u", F.col("low").alias("m")), F.struct(F.col("m").alias("u"), F.col("low").alias("m")))).alias("x"))
        last, now = now, written(down.select("x.u", "x.m").where("u <> m").distinct(), "union-find")
        deleted(last)
    else:
        raise RuntimeError(f"components not settled after {max_rounds} rounds")
    return now


def linked_groups(buckets: DataFrame, fits: Column, verified, rounds: int = 3, enough=None) -> DataFrame:
    """Components (v, c) of all links between members of common buckets; vertices without links are left out.

    ``buckets``: token, v, n, l. ``verified(pairs)`` returns the pairs (a, b) that link, ``fits`` compares n with n2. Two
    members are a candidate if they share as many buckets as the less demanding ``l`` of both, and if ``enough(shared)`` holds
    for their n, l, n2, l2 and the number of buckets they share; it must not turn false where ``shared`` grows.

    Large groups are mostly connected by a few rounds in which each member meets one hub, the one it shares most buckets
    with. What is left are candidates across components; these are verified all, so no link is lost. With no ``rounds`` all
    candidates are.
    """
    known, links = None, None
    with scratch():
        for k in range(rounds):
            found = written(verified(hub_pairs(buckets, known, fits, k)), "links")
            links = found if links is None else links.union(found)
            last, known = known, components(links)
            deleted(last)
        found = written(verified(crossing_pairs(buckets, known, fits, enough)), "links")
        links = found if links is None else links.union(found)
        return written(components(links), "groups", outlives=True)


def _unsettled(buckets: DataFrame, known: DataFrame | None) -> DataFrame:
    """Buckets with members of several components, each row with its component."""
    if known is None:
        return buckets.withColumn("c", F.col("v"))
    placed = buckets.join(known, "v", "left").withColumn("c", F.coalesce("c", "v"))
    mixed = placed.groupBy("token").agg(F.min("c").alias("c1"), F.max("c").alias("c2")).where("c1 <> c2").select("token")
    return placed.join(mixed, "token", "left_semi")


def hub_pairs(buckets: DataFrame, known: DataFrame | None, fits: Column, k: int) -> DataFrame:
    """(a, b): at most one pair for each member b, with the hub a of another component that shares most buckets.

    A bucket's hub is its least member by a hash that differs from round to round ``k``, or by itself at first.
    """
    rows = _unsettled(buckets, known)
    rank = F.xxhash64("v", F.lit(k)) if k else F.lit(0)
    hubs = rows.groupBy("token").agg(F.min(F.struct(rank.alias("rank"), "v", "n", "l", "c")).alias("hub"))
    met = rows.join(hubs, "token").select(
        F.col("hub.v").alias("a"), F.col("v").alias("b"), "n", F.col("hub.n").alias("n2"), F.least("l", "hub.l").alias("l"), "c", F.col("hub.c").alias("c2")
    )
    pairs = met.where("a <> b AND c <> c2").where(fits).groupBy("a", "b").agg(F.count("*").alias("shared"), F.max("l").alias("l"))
    best = pairs.where("shared >= l").groupBy("b").agg(F.max(F.struct("shared", "a")).alias("best"))
    return best.select(F.col("best.a").alias("a"), "b")


def crossing_pairs(buckets: DataFrame, known: DataFrame | None, fits: Column, enough=None) -> DataFrame:
    """All candidates (a, b) of different components. No pair shares more buckets than either member is left with."""
    of_member = Window.partitionBy("v")
    left = written(_unsettled(buckets, known).withColumn("left", F.count("*").over(of_member)), "unsettled")
    right = left.select("token", F.col("v").alias("v2"), F.col("n").alias("n2"), F.col("l").alias("l2"), F.col("c").alias("c2"), F.col("left").alias("left2"))
    met = left.join(right, "token").where("v < v2 AND c <> c2").where(fits).where(F.least("left", "left2") >= F.least("l", "l2"))
    if enough is not None:
        met = met.where(enough(F.least("left", "left2")))
    judged = ("l", "l2") if enough is None else ("n", "l", "n2", "l2")
    pairs = met.groupBy(F.col("v").alias("a"), F.col("v2").alias("b")).agg(
        F.count("*").alias("shared"), *(F.first(x).alias(x) for x in judged)
    )
    pairs = pairs.where("shared >= least(l, l2)")
    return (pairs if enough is None else pairs.where(enough(F.col("shared")))).select("a", "b")
