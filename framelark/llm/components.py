"""Connected components of a link table by alternating large-star and small-star rounds.

Every round rewires each node to the smallest neighbour it sees; the number of links never grows, and the
rounds are logarithmic in the size of a component. Nothing is collected: a round is two aggregations and
two joins over a written table.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framelark.llm.common import cut


HUB_ROWS = 100_000  # links of one node that may meet in a task


def _with_least(both: DataFrame, least: DataFrame, hub_rows: int | None) -> DataFrame:
    """Links with the least neighbour m of their node a. A hub's links are dealt into slices, and its m, one row, goes to each."""
    if hub_rows is None:
        return both.join(least, "a")
    hubs = cut(both.groupBy("a").count().filter(F.col("count") > hub_rows).select("a", F.ceil(F.col("count") / hub_rows).cast("int").alias("slices")))
    if hubs.isEmpty():
        return both.join(least, "a")
    # There are at most (links / hub_rows) hubs.
    slices = F.coalesce("slices", F.lit(1))
    dealt = both.join(hubs, "a", "left").select("a", "b", F.pmod(F.xxhash64("b"), slices).cast("int").alias("slice"))
    spread = least.join(hubs, "a", "left").select("a", "m", F.explode(F.sequence(F.lit(0), slices - 1)).alias("slice"))
    return dealt.join(spread, ["a", "slice"]).drop("slice")


def _star(links: DataFrame, larger: bool, hub_rows: int | None) -> DataFrame:
    if larger:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    seen = _with_least(both, least, hub_rows)
    moved = seen.filter("b > a").select(F.col("m").alias("a"), "b") if larger else seen.filter("b <> m").select(F.col("m").alias("a"), "b")
    if not larger:
        moved = moved.unionByName(least.select(F.col("m").alias("a"), F.col("a").alias("b")))
    return moved.filter("a <> b").distinct()


def components(links: DataFrame, hub_rows=HUB_ROWS) -> DataFrame:
    """(node, root): the smallest node of the component, for every node but the roots themselves and loners.

    links: columns a and b of one orderable type; direction, repeats and loops do not matter, nulls are
    dropped. An empty table gives an empty one.
    """
    rows = links.filter("a is not null and b is not null and a <> b")
    now = cut(rows.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    state = None
    while True:
        count = F.struct(F.count("*"), F.expr("sum(cast(xxhash64(a, b) as decimal(38, 0)))"))
        new = now.agg(count.alias("s")).first()["s"]
        if new == state or new[0] == 0:
            return now.select(F.col("b").alias("node"), F.col("a").alias("root"))
        state = new
        # Too few links in all for a hub need no look at each node; a large star may double them.
        looked = hub_rows if 2 * new[0] > hub_rows else None
        now = cut(_star(_star(now, True, looked), False, looked))
