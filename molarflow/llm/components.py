"""Connected components of a link table by alternating large-star and small-star rounds.

Every round is two joins on node ids with the aggregated side written first, so a
hub's links are a skewed join that AQE can split; nothing is collected. A round's
result is checkpointed in the shared folder, which cuts the lineage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from molarflow.llm.common import checkpointed


def _digest(links: DataFrame):
    return tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, root) for each node of the links (a, b: bigint); root is the smallest
    node of the component. Nulls and self links are ignored; no links, no rows."""
    links = checkpointed(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                         .distinct())
    seen = _digest(links)
    while seen[0]:
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = checkpointed(both.groupBy("a").agg(F.least("a", F.min("b")).alias("m")))
        large = checkpointed(both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                             .distinct())
        low = checkpointed(large.groupBy("a").agg(F.min("b").alias("m")))
        small = (large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .union(low.select("a", F.col("m").alias("b"))).distinct())
        links = checkpointed(small)
        now = _digest(links)
        if now == seen:
            break
        seen = now
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")) \
        .union(links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
