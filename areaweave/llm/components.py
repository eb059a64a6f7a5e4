"""Connected components of a graph given by its edges, by repeated star contraction.

A round starts inside the tasks: each contracts the edges it holds, so that chains and cliques that
lie together become stars at once. Then each vertex links its larger neighbours to the smallest
vertex it touches (large star), and its smaller neighbours and itself to the smallest of them
(small star). Only minima are aggregated, combined before the shuffle; the joins are left to AQE, which splits a
vertex with very many edges. Every round's edges go to the shared scratch folder; the number of
edges and an order-free sum of their hashes, which tell whether anything changed, are all that reaches
the driver.

A round has as many tasks as its edges need, `TASK_EDGES` each. Where one is enough, its contraction
is the answer and nothing is left to exchange.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areaweave.llm.work import stored

TASK_EDGES = 1 << 18


def contracted(a, b) -> tuple[np.ndarray, np.ndarray]:
    """Each vertex of these edges but the smallest of its component, and that one."""
    codes, names = pd.factorize(np.concatenate([a, b]), sort=True)
    one, other = codes[:len(a)], codes[len(a):]
    root = np.arange(len(names))
    while True:
        least = np.minimum(root[one], root[other])
        before = root.copy()
        for ends in (one, other):
            # Roots are hooked as well as the vertices, so whole trees move at once.
            np.minimum.at(root, root[ends], least)
            np.minimum.at(root, ends, least)
        root = root[root]
        if (root == before).all():
            far = np.flatnonzero(root != np.arange(len(root)))
            return names[far], names[root[far]]


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Columns: a, b. In parts of at most `TASK_EDGES` edges."""
    held, size, schema = [], 0, None

    def part() -> pa.RecordBatch:
        rows = pa.Table.from_batches(held)
        a, b = contracted(rows["a"].to_numpy(), rows["b"].to_numpy())
        return pa.RecordBatch.from_arrays(
            [pa.array(a, schema[0].type), pa.array(b, schema[1].type)], names=["a", "b"])

    for batch in batches:
        schema = batch.schema
        for start in range(0, batch.num_rows, TASK_EDGES):
            piece = batch.slice(start, TASK_EDGES)
            if held and size + piece.num_rows > TASK_EDGES:
                yield part()
                held, size = [], 0
            held.append(piece)
            size += piece.num_rows
    if size:
        yield part()


def _mark(edges: DataFrame):
    """Number of edges, and a sum over them that does not depend on their order."""
    return edges.agg(F.count(F.lit(1)).alias("n"),
                     F.sum(F.xxhash64("a", "b").cast("decimal(38, 0)")).alias("sum")).first()


def components(edges: DataFrame) -> DataFrame:
    """`edges`: columns a, b. Returns vertex, component: the smallest vertex reachable, for all
    vertices with an edge to another."""
    now = stored(edges.select("a", "b").where("a <> b"), "edges")
    kinds = ", ".join(f"{name} {kind}" for name, kind in now.dtypes)
    mark = _mark(now)
    while True:
        tasks = max(1, -(-mark.n // TASK_EDGES))
        local = stored(now.coalesce(tasks).mapInArrow(_contract, kinds), "edges")
        if tasks == 1:
            now = local
            break
        both = local.union(local.select("b", "a").toDF("a", "b"))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = both.where("b > a").join(least, "a").select(
            F.col("b").alias("a"), F.col("m").alias("b"))
        # Small star: each vertex and its smaller neighbours point at the smallest of these.
        small = large.groupBy("a").agg(F.min("b").alias("m"))
        linked = large.join(small, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where(
            "a <> b").union(small.select("a", F.col("m").alias("b"))).distinct()
        now, before = stored(linked, "edges"), mark
        mark = _mark(now)
        if mark == before:
            break
    return now.select(F.col("a").alias("vertex"), F.col("b").alias("component")).union(
        now.select("b").distinct().select("b", "b"))
