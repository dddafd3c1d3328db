"""Connected components of a table of links, by alternating large and small stars.

Each round points every node at the smallest node it knows. Before the first round each
partition joins the links it holds, so that long chains inside one partition cost no
round. Links and labels stay in Spark; rounds end when the links stop changing.
"""

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..sources.scratch import materialise


class Forest:
    """Union-find whose roots are the smallest members."""

    def __init__(self):
        self.up: dict = {}

    def root(self, x):
        up = self.up
        top = x
        while (above := up.get(top, top)) != top:
            top = above
        while x != top:
            up[x], x = top, up.get(x, x)
        return top

    def join(self, a, b) -> bool:
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        self.up[max(a, b)] = min(a, b)
        return True


def _local(batches):
    forest = Forest()
    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            forest.join(a, b)
    nodes = list(forest.up)
    for i in range(0, len(nodes), 100_000):
        part = nodes[i : i + 100_000]
        yield pa.RecordBatch.from_arrays(
            [pa.array(part, pa.int64()), pa.array([forest.root(x) for x in part], pa.int64())],
            ["node", "low"],
        )


def _stars(links: DataFrame) -> DataFrame:
    both = links.union(links.select(F.col("low").alias("node"), F.col("node").alias("low")))
    least = both.groupBy("node").agg(F.min("low").alias("other")).select("node", F.least("node", "other").alias("m"))
    large = both.join(least, "node").where("low > node").select(F.col("low").alias("node"), F.col("m").alias("low"))
    large = large.where("node <> low").distinct()
    least = large.groupBy("node").agg(F.min("low").alias("m"))
    small = large.join(least, "node").select("node", "low", "m")
    return (
        small.select(F.explode(F.array(F.struct("node", F.col("m").alias("low")), F.struct(F.col("low").alias("node"), F.col("m").alias("low")))).alias("x"))
        .select("x.*")
        .where("node <> low")
        .distinct()
    )


def _state(links: DataFrame):
    return links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("node", "low"))).first()


def components(links: DataFrame, name: str = "links") -> DataFrame:
    """``(node, low)`` for links of two bigint columns: the smallest node reachable.

    Nodes that are their own component, and links with a null end, aren't listed.
    """
    a, b = links.columns
    links = links.select(F.greatest(a, b).alias("node"), F.least(a, b).alias("low")).where(
        F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))
    )
    links = materialise(links.mapInArrow(_local, "node bigint, low bigint").distinct(), name)
    state = _state(links)
    while state[0]:
        links = materialise(_stars(links), name)
        if (after := _state(links)) == state:
            break
        state = after
    return links
