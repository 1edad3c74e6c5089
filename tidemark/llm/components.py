"""Connected components of an edge table, by alternating stars."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.arrays import released
from tidemark.llm.tables import cut

TASK_EDGES = 20_000  # edges that a task joins at a time; no more than these are left to a single one


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, component) of all nodes in ``edges`` (a, b): the smallest node that can be reached.

    Each task first draws its own edges together. Then each round hangs every node on its
    smallest neighbour, once over larger and once over smaller neighbours, until nothing
    changes; rounds grow with the logarithm of the nodes. As soon as ``TASK_EDGES`` edges
    or fewer are left, one task joins them, so that a small table takes no rounds. Each
    round is a written table; only two sums come to the driver. NULLs and loops are no
    edges. A hub is aggregated before the shuffle and joined as a skewed key.
    """
    pairs = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    now = cut(_joined(pairs), name)
    mark = _mark(now)
    while mark[0] > TASK_EDGES:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        smallest = cut(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), name)
        large = both.where("v > u").join(smallest, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = cut(large.distinct(), name)
        smallest = cut(large.groupBy("u").agg(F.min("v").alias("m")), name)
        small = large.join(smallest, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = cut(small.union(smallest.select("u", F.col("m").alias("v"))).distinct(), name)
        before, mark = mark, _mark(now)
        if mark == before:
            roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
    return cut(_joined(now.coalesce(1), roots=True).withColumnsRenamed({"u": "node", "v": "component"}), name)


def _joined(edges: DataFrame, roots: bool = False) -> DataFrame:
    """Each node of up to ``TASK_EDGES`` edges of a task with the smallest one that these reach, and that one with itself if ``roots``."""
    most = 2 * TASK_EDGES
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in edges.schema])

    def stars(parent: dict, kinds: list[pa.DataType]) -> pa.RecordBatch:
        rows = [(node, _root(parent, node)) for node in parent]
        rows = [r for r in rows if roots or r[0] != r[1]]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kinds[i]) for i in range(2)], ["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent, kinds = {}, []
        for batch in batches:
            kinds = [c.type for c in batch.columns]
            for u, v in zip(*(c.to_pylist() for c in batch.columns)):
                u, v = _root(parent, u), _root(parent, v)
                if u < v:
                    parent[v] = u
                elif v < u:
                    parent[u] = v
                if len(parent) >= most:
                    yield stars(parent, kinds)
                    parent = {}
        if parent:
            yield stars(parent, kinds)

    return edges.mapInArrow(released(run), schema)


def _root(parent: dict, node):
    """The smallest node joined with ``node`` so far; new nodes are put in."""
    above = parent.setdefault(node, node)
    while above != node:
        parent[node] = parent[above]
        node, above = above, parent[above]
    return node


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
    return row.n, row.s
