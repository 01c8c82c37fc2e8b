"""Groups of linked nodes, found by rounds of large and small stars over the edges.

Each round hangs a node's larger neighbours, then its smaller ones, on the smallest it knows. The
edges stay as many as before at most, and the rounds grow with the logarithm of a group's longest
chain. A counted, bounded number of edges is worked on in one task, where the same operations need no
shuffle; beyond it they are dealt out by node, and no group is ever gathered in one place. Only
DataFrame operations are used.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from remanente.llm.common import written


#: Edges up to which one task works on them all, without shuffles; more are dealt out by node.
ONE_TASK = 500_000


def _state(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    )


def _with_least(edges: DataFrame, one_task: bool) -> DataFrame:
    """Adds m, the smallest b of each a. Dealt out, no task gets all edges of a node that has many."""
    if one_task:
        return edges.withColumn("m", F.min("b").over(Window.partitionBy("a")))
    return edges.join(edges.groupBy("a").agg(F.min("b").alias("m")), "a")


def _both(one: tuple[Column, Column], other: tuple[Column, Column]) -> Column:
    """Two edges (a, b) of each row, without reading it twice as a union does."""
    return F.explode(F.array(*[F.struct(a.alias("a"), b.alias("b")) for a, b in (one, other)]))


def _stars(now: DataFrame, one_task: bool) -> DataFrame:
    """Edges (a, b), b < a, after a large and a small star at every node."""
    a, b, m = F.col("a"), F.col("b"), F.col("m")
    both = now.select(_both((a, b), (b, a)).alias("e")).select("e.a", "e.b")
    large = _with_least(both, one_task).where("b > a").select(b.alias("a"), F.least(a, m).alias("b"))
    large = large.distinct() if one_task else written(large.distinct(), "edges")
    small = _with_least(large, one_task).select(_both((b, m), (a, m)).alias("e"))
    small = small.select("e.a", "e.b").where("a <> b").distinct()
    return small if one_task else written(small, "edges")


def components(edges: DataFrame) -> DataFrame:
    """node, label: the smallest node of its group, for every node of an edge (a, b).

    An edge between a node and itself, a repeated or a null one adds nothing; no edges, no rows.
    """
    low, high = F.least("a", "b"), F.greatest("a", "b")
    now = written(
        edges.where(F.col("a") != F.col("b")).select(high.alias("a"), low.alias("b")).distinct(),
        "edges",
    )
    before, state = None, _state(now)
    while state != before and state[0]:
        one_task = state[0] <= ONE_TASK
        now = _stars(now.coalesce(1) if one_task else now, one_task)
        now = written(_stars(now, True), "edges") if one_task else _stars(now, False)
        before, state = state, _state(now)
    both = _both((F.col("a"), F.col("b")), (F.col("b"), F.col("b")))
    now = now.coalesce(1) if state[0] <= ONE_TASK else now
    labels = now.select(both.alias("e")).select(F.col("e.a").alias("node"), F.col("e.b").alias("label"))
    return written(labels.distinct(), "labels")


#: Keys that a member of an open bucket names, so that pairs are seldom compared in several buckets.
FIRST_KEYS = 8

Part = Callable[[str], Column]
#: Whether two members of a bucket may be linked, and the linked ones among pairs (a, b) of nodes.
Fits = Callable[[Part, Part], Column]
Confirmed = Callable[[DataFrame], DataFrame]


def _pairs(left: DataFrame, right: DataFrame, fits: Fits, also: Column | None = None) -> DataFrame:
    names = [F.col(c).alias(f"{c}_b") for c in right.columns if c != "key"]
    near = fits(F.col, lambda c: F.col(f"{c}_b")) & (F.col("node") != F.col("node_b"))
    near = near if also is None else near & also
    found = left.join(right.select("key", *names), "key").where(near)
    return found.select(F.col("node").alias("a"), F.col("node_b").alias("b")).distinct()


def star_links(members: DataFrame, fits: Fits, confirmed: Confirmed) -> DataFrame:
    """Confirmed pairs (a, b) of each member with the smallest node of its bucket.

    ``members`` has key, node and what ``fits`` reads; ``fits`` must hold for every pair that can be
    linked.
    """
    least = members.groupBy("key").agg(F.min("node").alias("node"))
    firsts = members.join(least, ["key", "node"])
    return written(confirmed(_pairs(members, firsts, fits)), "links")


def first_met(one: Part, other: Part) -> Column:
    """Whether no smaller key is among the first ones (``firsts``) of both members.

    The smallest key that two members share always passes, so that a pair is compared there at
    least, and seldom more often, however few of its keys a member names.
    """
    return F.coalesce(
        F.array_min(F.array_intersect(one("firsts"), other("firsts"))) >= one("key"), F.lit(True)
    )


def first_keys(keys: Column) -> Column:
    return F.slice(F.sort_array(keys), 1, FIRST_KEYS)


def bucket_groups(
    members: DataFrame,
    links: DataFrame,
    fits: Fits,
    confirmed: Confirmed,
    step: int = 16,
    known: DataFrame | None = None,
) -> DataFrame:
    """node, label: groups of nodes by ``links`` and all further links within buckets.

    ``known`` has node and what else ``fits`` reads, which only members of open buckets get.

    Members still in other groups are compared with one in ``spread`` of their bucket, ``spread``
    falling by ``step`` in each round and from below ``step`` squared to 1 (with few left out, a round
    would cost as much as the last one): at the end every fitting pair of a bucket has been compared
    or is in one group. So a bucket of many linked nodes costs few comparisons, and no pair is lost.
    """
    columns, left, spread = members.columns, members, None
    while True:
        labels = components(links)
        if spread == 1:
            return labels
        placed = left.select(*columns).join(labels, "node", "left")
        placed = placed.withColumn("label", F.coalesce("label", "node"))
        mixed = placed.groupBy("key").agg(
            F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("size")
        )
        several = written(mixed.where("low < high").select("key", "size"), "open")
        most = several.agg(F.max("size")).first()[0]
        if most is None:
            return labels
        left = placed.join(several.select("key"), "key")
        left = written(left if known is None else left.join(known, "node"), "buckets")
        last = spread is not None and min(spread, most) < step * step
        spread = 1 if last else max(1, (most if spread is None else min(spread, most)) // step)
        chosen = left.where(F.pmod(F.xxhash64("node"), F.lit(spread)) == 0)
        apart = F.col("label") != F.col("label_b")
        if spread == 1:
            apart &= F.col("node") > F.col("node_b")
        more = confirmed(_pairs(left, chosen, fits, apart))
        groups = labels.select(F.col("node").alias("a"), F.col("label").alias("b"))
        links = written(groups.union(more), "links")
