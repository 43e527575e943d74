"""Connected components of links, by alternating large-star and small-star rounds.

Links never come together in one place. Each task first replaces its own links by a spanning
forest (union-find over what it holds), then every round moves a link (node, neighbour) to the
smallest neighbour, by grouped minima and joins. A node with very many links costs one aggregated
row; the minima are written tables, so both sides of a join come straight from a shuffle and Spark
splits a hub's links by size over several tasks. Rounds are written to the shared folder, and end when one
changes nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import durable

_LINK = "a long, b long"


class UnionFind:
    """Roots are smallest members."""

    def __init__(self) -> None:
        self.up: dict[int, int] = {}

    def find(self, x: int) -> int:
        root = x
        while (y := self.up.get(root, root)) != root:
            root = y
        while (y := self.up.get(x, x)) != root:
            self.up[x] = root
            x = y
        return root

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        self.up[max(a, b)] = min(a, b)
        return True


def _forest(batches: Iterator[pa.RecordBatch], most: int = 1_000_000) -> Iterator[pa.RecordBatch]:
    """(node, root) of what each task holds, in portions of bounded memory."""
    links = UnionFind()

    def rows():
        nodes = [x for x in links.up if links.find(x) != x]
        return pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array([links.find(x) for x in nodes], pa.int64())], ["a", "b"])

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            links.join(a, b)
        if len(links.up) >= most:
            yield rows()
            links = UnionFind()
    yield rows()


def components(links: DataFrame) -> DataFrame:
    """From links (a, b): node, component (its smallest member), for the nodes that have a link to another one."""
    now = durable(links.select("a", "b").filter("a <> b").mapInArrow(_forest, _LINK), "forest")
    before = None
    while True:
        # large star: neighbours above a node go to the smallest of its neighbourhood
        both = now.union(now.select("b", "a"))
        least = durable(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a"), F.least("a", "m").alias("m")), "least")
        large = durable(both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), "large")
        # small star: a node and its neighbours below it go to the smallest of these
        down = durable(large.groupBy("a").agg(F.min("b").alias("m")), "down")
        small = large.join(down, "a").select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct(F.col("a"), F.col("m").alias("b")))).alias("x")).select("x.a", "x.b").filter("a <> b").distinct()
        now = durable(small, "stars")
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component"))
        before = state
