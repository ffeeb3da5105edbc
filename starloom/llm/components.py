"""Connected components of a distributed set of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import stored


def _signature(links: DataFrame) -> tuple:
    total = F.sum(F.xxhash64("high", "low").cast("decimal(38,0)"))
    return tuple(links.agg(F.count("*"), total).first())


def _large_star(links: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest of its neighbourhood."""
    both = links.select(F.col("high").alias("node"), F.col("low").alias("other")).union(
        links.select(F.col("low").alias("node"), F.col("high").alias("other"))
    )
    least = both.groupBy("node").agg(F.least("node", F.min("other")).alias("least"))
    # Written, so that the join has an exchange of its own and Spark may split a hub.
    least = stored(least, "least")
    larger = both.where("other > node").join(least, "node")
    return larger.select(F.col("other").alias("high"), F.col("least").alias("low")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    least = stored(links.groupBy("high").agg(F.min("low").alias("least")), "least")
    joined = links.join(least, "high")
    moved = joined.select(F.col("low").alias("high"), F.col("least").alias("low"))
    own = least.select("high", F.col("least").alias("low"))
    return moved.union(own).where("high > low").distinct()


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for all nodes with a link but the roots; a root is a component's least node.

    ``links`` has two columns of one type. Self-links and repeated links do not matter. Stars
    are formed alternately around least neighbours until nothing changes, which takes a number
    of rounds that grows with the logarithm of a component's diameter. Each round is written to
    the shared folder.
    """
    first, second = (F.col(f"`{name}`") for name in links.columns)
    now = stored(
        links.select(F.greatest(first, second).alias("high"), F.least(first, second).alias("low"))
        .where("high > low")
        .distinct(),
        "links",
    )
    before = _signature(now)
    while before[0]:
        now = stored(_small_star(_large_star(now)), "links")
        after = _signature(now)
        if after == before:
            break
        before = after
    return now.select(F.col("high").alias("node"), F.col("low").alias("root"))
