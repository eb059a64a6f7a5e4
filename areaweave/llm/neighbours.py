"""Approximate nearest neighbours by a robust-pruned directed graph.

Distinct vectors are dealt over shards by a hash: of about `SHARD` vectors while there are few, then
of more, so that the visits of queries to shards grow less than with the square of the rows. Each
shard builds a graph:
vectors enter in batches, a greedy search from the shard's centre proposes neighbours, and pruning
keeps a near one only if no neighbour kept before is closer to it by the factor `ALPHA`, so edges
point in diverse directions; edges back are added and pruned alike. A beam search then answers
every query in every shard, and the best of all shards are merged.

Every usable row is in the index; equal vectors are one vertex that stands for their smallest
ids, as many as a result can hold, so a vector with any number of copies costs one vertex.

Defined results: vectors that are NULL, empty, zero or hold a NULL or non-finite component, and
rows with a NULL id, are neither queries nor candidates. Vectors of other lengths than the query
are no candidates. Rows that repeat an id are one candidate with its best score, and one query
each distinct vector. Ties go to the smaller id. An empty table gives an empty result. Extra
columns are not read.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from areaweave.llm.vectors import matrix, unit, usable
from areaweave.llm.work import stored, table

NEAREST = 5
EVERY = 50
SHARD = 4096
SHARDS = 24
WIDEST = 65_536
SHARD_VALUES = 1 << 24
TASKS = 2000
DEGREE = 32
BUILD_BEAM = 64
BEAM = 128
ALPHA = 1.2
BATCH = 512
PRUNED = 1 << 22  # components, and products of pairs, that are held while pruning


def search(rows: np.ndarray, graph: np.ndarray, start: int, queries: np.ndarray, beam: int,
           wide: int = 4) -> tuple[np.ndarray, np.ndarray]:
    """Beam search for all queries at once. `graph`: neighbours per row, each once, -1 where none.
    Returns the best `beam` rows of each query, nearest first, and their likeness (-inf where none)."""
    many, places = len(queries), len(rows) + 1
    found = np.full((many, beam), -1, np.int32)
    found[:, 0] = start
    near = np.full((many, beam), -np.inf, rows.dtype)
    near[:, 0] = queries @ rows[start]
    open_ = np.zeros((many, beam), bool)
    open_[:, 0] = True
    # The first place of each query stands for no neighbour.
    met = np.zeros((many, places), bool)
    met[:, [0, start + 1]] = True
    met = met.reshape(-1)
    live = np.arange(many)
    while len(live):
        # The nearest few not yet expanded, one of each query after the other; `found` is kept in
        # order. What is no better than the last place is met and left out.
        last, turn, parts = near[:, -1].copy(), live, []
        for _ in range(wide):
            slot = open_[turn].argmax(axis=1)
            some = open_[turn, slot]
            turn, slot = turn[some], slot[some]
            if not len(turn):
                break
            open_[turn, slot] = False
            n = graph[found[turn, slot]]
            code = n + (turn * places + 1)[:, None]
            fresh = (~met.take(code)).ravel().nonzero()[0]
            met[code.take(fresh)] = True
            n, q = n.take(fresh), turn.take(fresh // graph.shape[1])
            like = np.einsum("ij,ij->i", queries.take(q, axis=0), rows.take(n, axis=0))
            better = (like > last.take(q)).nonzero()[0]
            parts.append((q[better], n[better], like[better]))
        q, n, like = (np.concatenate(part) for part in zip(*parts, strict=True))
        if len(q):
            # Lay the new ones out beside the old ones of their query and keep the best.
            by = np.argsort(q, kind="stable")
            q, n, like = q[by], n[by], like[by]
            mine, firsts, counts = np.unique(q, return_index=True, return_counts=True)
            width = beam + int(counts.max())
            row = np.repeat(np.arange(len(mine)), counts)
            column = beam + np.arange(len(q)) - np.repeat(firsts, counts)
            all_n = np.full((len(mine), width), -1, np.int32)
            all_l = np.full((len(mine), width), -np.inf, rows.dtype)
            all_o = np.zeros((len(mine), width), bool)
            all_n[:, :beam], all_l[:, :beam], all_o[:, :beam] = found[mine], near[mine], open_[mine]
            all_n[row, column], all_l[row, column], all_o[row, column] = n, like, True
            best = np.argsort(-all_l, axis=1, kind="stable")[:, :beam]
            found[mine] = np.take_along_axis(all_n, best, axis=1)
            near[mine] = np.take_along_axis(all_l, best, axis=1)
            open_[mine] = np.take_along_axis(all_o, best, axis=1)
        live = live[open_[live].any(axis=1)]
    return found, near


def prune(rows: np.ndarray, own: np.ndarray, proposed: np.ndarray, degree: int) -> np.ndarray:
    """Neighbours kept of those proposed (-1: none) for each of `own`."""
    wide = proposed.shape[1]
    step = max(1, PRUNED // (wide * max(wide, rows.shape[1])))
    if len(own) > step:
        return np.concatenate([prune(rows, own[at:at + step], proposed[at:at + step], degree)
                               for at in range(0, len(own), step)])
    there = (proposed >= 0) & (proposed != own[:, None])
    at = np.where(there, proposed, 0)
    vectors = rows[at]
    far = np.where(there, 2 - 2 * (vectors @ rows[own][:, :, None])[:, :, 0], np.inf)
    between = ALPHA * ALPHA * (2 - 2 * (vectors @ vectors.transpose(0, 2, 1)))
    kept = np.full((len(own), degree), -1, np.int32)
    every = np.arange(len(own))
    for slot in range(degree):
        pick = far.argmin(axis=1)
        some = np.isfinite(far[every, pick])
        if not some.any():
            break
        picked = at[every, pick]
        kept[some, slot] = picked[some]
        gone = (between[every, pick] <= far) | (at == picked[:, None])
        far[some[:, None] & gone] = np.inf
    return kept


def build(rows: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM) -> tuple[np.ndarray, int]:
    """The graph over unit vectors, and the row that searches start from."""
    start = int((rows @ rows.mean(axis=0)).argmax())
    graph = np.full((len(rows), 2 * degree), -1, np.int32)
    order = np.random.default_rng(0).permutation(len(rows))
    order = np.concatenate([[start], order[order != start]])
    done = 1
    while done < len(rows):
        batch = order[done:done + min(max(done, 16), BATCH)]
        found, _ = search(rows, graph, start, rows[batch], beam)
        # Rows that enter together cannot find one another in the graph; the batch is small.
        alike = rows[batch] @ rows[batch].T
        np.fill_diagonal(alike, -np.inf)
        mates = batch[np.argsort(-alike, axis=1)[:, :min(8, len(batch))]]
        graph[batch, :degree] = prune(rows, batch, np.concatenate([found, mates], axis=1), degree)
        # Edges back that are not there yet, into free places; a full row is pruned with all that
        # point to it.
        tail = np.repeat(batch, degree)
        head = graph[batch, :degree].ravel()
        new = (head >= 0) & ~(graph[head] == tail[:, None]).any(axis=1)
        tail, head = tail[new], head[new]
        by = np.argsort(head, kind="stable")
        tail, head = tail[by], head[by]
        nodes, first, many = np.unique(head, return_index=True, return_counts=True)
        held = (graph[nodes] >= 0).sum(axis=1)
        wide = int((held + many).max(initial=0))
        all_ = np.full((len(nodes), max(wide, 2 * degree)), -1)
        all_[:, :2 * degree] = graph[nodes]
        # Places in use come first in every row.
        all_ = -np.sort(-all_, axis=1)
        row = np.repeat(np.arange(len(nodes)), many)
        all_[row, held[row] + np.arange(len(head)) - first[row]] = tail
        full = held + many > 2 * degree
        graph[nodes[~full]] = all_[~full, :2 * degree]
        if full.any():
            graph[nodes[full]] = -1
            graph[nodes[full], :degree] = prune(rows, nodes[full], all_[full], degree)
        done += len(batch)
    return graph, start


def _answer(group: pa.Table, nearest: int) -> pa.Table:
    """One shard: vertices have `ids`, queries have a `query`."""
    is_query = group.column("ids").is_null().to_numpy()
    vertices = group.filter(pa.array(~is_query))
    asked = group.filter(pa.array(is_query))
    schema = pa.schema([("query", pa.int64()), ("query_hash", pa.int64()), ("id", pa.int64()),
                        ("score", pa.float64())])
    if not len(vertices) or not len(asked):
        return schema.empty_table()
    original = matrix(vertices.column("vector"))
    rows = unit(original).astype(np.float32)
    graph, start = build(rows)
    lists = vertices.column("ids").combine_chunks()
    ends, names = lists.offsets.to_numpy(), lists.values.to_numpy()
    size = np.linalg.norm(original, axis=1)
    queries, hashes = (asked.column(n).to_numpy() for n in ("query", "hash"))
    # A larger shard is searched with a wider beam, which keeps the recall.
    beam = min(int(BEAM * max(1.0, len(rows) / SHARD) ** 0.5), len(rows))
    out = []
    for at in range(0, len(asked), BATCH):
        part = matrix(asked.column("vector").slice(at, BATCH))
        places, _ = search(rows, graph, start, unit(part).astype(np.float32), beam,
                           max(4, beam // 32))
        score = np.full(places.shape, -np.inf)
        for i, length in enumerate(np.linalg.norm(part, axis=1)):
            some = places[i][places[i] >= 0]
            score[i, :len(some)] = original[some] @ part[i] / (size[some] * length)
        # The query's own vertex, then ties with the last place, are not to be cut off.
        cut = -np.sort(-score, axis=1)[:, min(nearest, beam - 1)]
        who, slot = np.nonzero((score >= cut[:, None]) & (places >= 0))
        place = places[who, slot]
        count = ends[place + 1] - ends[place]
        within = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        name = names[np.repeat(ends[place], count) + within]
        who, value = np.repeat(who, count), np.repeat(score[who, slot], count)
        other = name != queries[at + who]
        who = at + who[other]
        out.append((queries[who], hashes[who], name[other], value[other]))
    return pa.table([pa.array(np.concatenate(c), t)
                     for c, t in zip(zip(*out, strict=True), schema.types, strict=True)],
                    schema=schema)


def _shards() -> Column:
    """Shards for `rows` vectors of a `length`: of about `SHARD` vectors up to `SHARDS`, then larger
    ones up to `WIDEST` vectors and `SHARD_VALUES` components, since each query visits each shard."""
    widest = F.least(F.lit(WIDEST), F.greatest(F.lit(SHARD), F.floor(SHARD_VALUES / F.col("length"))))
    return F.greatest(F.ceil(F.col("rows") / widest), F.least(F.ceil(F.col("rows") / SHARD), F.lit(SHARDS)))


def nearest_neighbours(
    embeddings: DataFrame, key: str = "vec_id", vector: str = "embedding",
    every: int = EVERY, nearest: int = NEAREST,
) -> DataFrame:
    """For each row whose id `every` divides: `query_id`, `rank` from 1, the id and `score` of its
    nearest rows by cosine. Queries visit every shard, as asked of this operator: their rows are
    the query set times the number of shards."""
    own = embeddings.where(usable(vector) & F.col(key).isNotNull()).select(
        F.col(key).cast("bigint").alias("id"), F.col(vector).alias("vector"))
    hashed = own.withColumn("hash", F.xxhash64("vector")).withColumn("length", F.size("vector"))
    # The smallest ids of each vector: Spark cuts each task's rows down before the shuffle.
    few = F.row_number().over(Window.partitionBy("length", "hash", "vector").orderBy("id"))
    vertices = stored(
        hashed.distinct().withColumn("few", few).where(F.col("few") <= nearest + 1)
        .groupBy("length", "hash", "vector").agg(F.collect_list("id").alias("ids")), "vertices")
    lengths = vertices.groupBy("length").agg(F.count(F.lit(1)).alias("rows")).select(
        "length", _shards().cast("int").alias("shards"))
    # Shards are few and long: most get a task of their own, and small ones are not put together.
    tasks = min(TASKS, 8 * (lengths.agg(F.sum("shards")).first()[0] or 1))
    dealt = vertices.join(lengths, "length").select(
        "length", F.pmod("hash", "shards").cast("int").alias("shard"), "vector", "ids",
        F.lit(None).cast("bigint").alias("query"), "hash")
    asked = hashed.where(F.pmod("id", F.lit(every)) == 0).distinct().join(
        lengths, "length").select(
        "length", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"), "vector",
        F.lit(None).cast("array<bigint>").alias("ids"), F.col("id").alias("query"), "hash")
    found = dealt.union(asked).repartition(tasks, "length", "shard").groupBy(
        "length", "shard").applyInArrow(
        lambda group: _answer(group, nearest), "query bigint, query_hash bigint, id bigint, "
        "score double")
    once = found.groupBy("query", "query_hash", "id").agg(F.max("score").alias("score"))
    place = F.row_number().over(
        Window.partitionBy("query", "query_hash").orderBy(F.desc("score"), "id"))
    return once.withColumn("rank", place).where(F.col("rank") <= nearest).select(
        F.col("query").alias("query_id"), "rank", F.col("id").alias(key), "score")


def op6_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(table(spark, sf_dir, "embeddings"))
