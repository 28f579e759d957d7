"""Connected components by alternating large-star and small-star, and exact linking of buckets."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ratesheet.llm.common import dropped, written

#: Pairs of the last step that are made and verified at once, unless there are more members than this.
PAIRS_AT_ONCE = 4_000_000
#: Parts that these are made in at most.
MOST_PARTS = 64

Verify = Callable[[DataFrame], DataFrame]


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the node's smallest neighbour or itself."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    return (
        both.join(least, "a")
        .where("b > a")
        .select(F.greatest("b", F.least("a", "m")).alias("a"), F.least("a", "m").alias("b"))
        .where("a <> b")
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of them. Edges point down."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    joined = edges.join(least, "a")
    return (
        joined.select(F.col("b").alias("a"), F.col("m").alias("b"))
        .unionByName(least.select("a", F.col("m").alias("b")))
        .where("a <> b")
        .distinct()
    )


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (a, b: bigint): the smallest node it reaches.

    Each round is written to the shared folder. A hot node's edges are met by partial sums and
    by joins whose large partitions Spark splits; nothing of the graph reaches the driver but a
    count and a checksum a round. Loops and repeated edges do no harm; no edges, no rows.
    """
    down = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    edges = written(edges.where("a <> b").select(*down).distinct(), "edges")
    seen = None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(state) == seen or state[0] == 0:
            break
        seen = tuple(state)
        last, edges = edges, written(_small_star(_large_star(edges)), "edges")
        dropped(last)
    stars = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return stars.unionByName(roots)


def linked_components(members: DataFrame, verify: Verify) -> DataFrame:
    """(node, component) under all verified links between nodes that share a key.

    ``members`` has (key, node, low, high, size, apart): a link of a node is only possible to a node
    whose size lies from ``low`` to ``high``; ``apart`` tells how little it has in common with
    others, and the least apart leads its bucket. ``verify`` keeps the pairs (a, b) that are links. The answer
    is that of testing all pairs of every bucket, without listing them:

    1. members whose bucket holds no size in their range are left out;
    2. each member is tested against the leader of its bucket (ties: another one in another bucket);
    3. components of those links are taken;
    4. buckets that lie in one component are done. In the others, the members outside the
       bucket's largest component are tested against the members of other components.

    Pairs inside a component can't change it, so no link between components is missed. The pairs of
    step 4 may be many times the members, so they are made in parts, by key; each part's shuffle
    files are gone before the next.
    """
    sizes = members.groupBy("key").agg(F.min("size").alias("least"), F.max("size").alias("most"))
    able = members.join(sizes, "key").where("low <= most and high >= least").drop("least", "most")
    leaders = (
        able.groupBy("key")
        .agg(
            F.min(F.struct("apart", F.col("node").bitwiseXOR(F.col("key")).alias("x"))).alias("l"),
            F.count(F.lit(1)).alias("n"),
        )
        .where("n > 1")
        .select("key", F.col("l.x").bitwiseXOR(F.col("key")).alias("leader"))
    )
    shared = written(able.drop("apart").join(leaders, "key").distinct(), "shared")
    pair = F.least("node", "leader").alias("a"), F.greatest("node", "leader").alias("b")
    star = written(verify(shared.where("node <> leader").select(*pair).distinct()), "links")
    first = components(star)
    placed = written(
        shared.drop("leader")
        .join(first, "node", "left")
        .withColumn("c", F.coalesce("component", "node"))
        .drop("component"),
        "placed",
    )
    dropped(shared, first)
    open_keys = placed.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo < hi")
    still = placed.join(open_keys.select("key"), "key")
    big = (
        still.groupBy("key", "c")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("key")
        .agg(F.max(F.struct("n", "c"))["c"].alias("big"))
    )
    still = written(still.join(big, "key"), "still")
    dropped(placed)
    # A pair that meets in several buckets is made in the one with the smallest key only.
    keys = written(still.groupBy("node").agg(F.collect_set("key").alias("keys")), "keys")
    counts = still.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("c") != F.col("big")).alias("x"))
    n, pairs = counts.agg(F.sum("n"), F.sum(F.col("n").cast("double") * F.col("x"))).first()
    parts = min(MOST_PARTS, 1 + int((pairs or 0) / max(PAIRS_AT_ONCE, n or 0)))
    more = []
    for k in range(parts):
        part = still.where(F.pmod(F.xxhash64("key"), F.lit(parts)) == k).join(keys, "node")
        small = part.where("c <> big").select(
            "key", *[F.col(v).alias(f"x_{v}") for v in ("node", "c", "low", "high", "size", "keys")]
        )
        cross = (
            small.join(part, "key")
            .where("x_c <> c and (c = big or x_node < node)")
            .where("size between x_low and x_high and x_size between low and high")
            .where("key = array_min(array_intersect(keys, x_keys))")
            .select(F.least("x_node", "node").alias("a"), F.greatest("x_node", "node").alias("b"))
            .distinct()
        )
        more.append(written(verify(cross), "links"))
    found = components(reduce(DataFrame.unionByName, more, star))
    dropped(star, *more, still, keys)
    return found
