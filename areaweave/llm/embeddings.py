"""Embedding near-dedup with an inverted multi-index.

Unit vectors are cut in two halves, each with a codebook of its own, learnt from a bounded sample;
the product of the codebooks is a grid of cells. A vector is at home in one cell and visits other
cells by rising distance to their borders, summed over the halves (the multi-sequence order),
until no further cell can hold a partner. The border distance is a lower bound, so with the whole
radius as reach every pair is met: recall 1. A `recall` below 1 stops the traversal earlier, where
a partner in a random direction lies closer with that probability. Pairs met are verified on the
original vectors in double precision.

Equal vectors are one point with a number of copies. Pairs are not returned: each task counts
partners and returns one star per group.

Defined results: vectors that are NULL, empty, zero or hold a NULL or non-finite component, and
vectors with a NULL label, link with nothing: 0 links, their own component. Vectors of different
lengths do not link. Repeated rows link with one another like any equal vectors; a NULL id is never
the smallest. An empty table gives an empty result. Extra columns are not read.
"""

from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from areaweave.llm.components import components
from areaweave.llm.simhash import star
from areaweave.llm.vectors import matrix, unit, usable
from areaweave.llm.work import stored, table

COSINE = 0.98
RECALL = 1.0
SAMPLE = 10_000
"""Vectors that the codebooks are learnt from, at most."""
CELL = 64
"""Vectors aimed at in a cell of the fullest label."""
MAX_CODES = 256
BLOCK = 2048
ROUNDS = 8


def codebook(rows: np.ndarray, codes: int) -> np.ndarray:
    """Centres by k-means from evenly spaced rows."""
    centres = rows[np.linspace(0, len(rows) - 1, codes).astype(int)].copy()
    for _ in range(ROUNDS):
        near = (rows @ centres.T - (centres ** 2).sum(axis=1) / 2).argmax(axis=1)
        for code in range(codes):
            mine = rows[near == code]
            if len(mine):
                centres[code] = mine.mean(axis=0)
    return centres


def borders(rows: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centre of each row, and the distance to the border of every other cell."""
    far = ((rows[:, None, :] - centres) ** 2).sum(axis=2) if len(rows) * len(centres) < 1 << 16 \
        else (rows ** 2).sum(axis=1)[:, None] - 2 * rows @ centres.T + (centres ** 2).sum(axis=1)
    own = far.argmin(axis=1)
    gap = np.linalg.norm(centres[:, None, :] - centres, axis=2)[own]
    lead = far - far[np.arange(len(rows)), own][:, None]
    with np.errstate(divide="ignore", invalid="ignore"):
        bound = np.where(gap > 0, lead / (2 * gap), 0.0)
    return own, np.maximum(bound, 0)


def visits(rows: np.ndarray, books: list[np.ndarray], reach: float):
    """Per row, in order of the summed borders: the cells within reach that come after the home
    cell (each pair is met once). Yields (row, first code, home, second codes)."""
    half = rows.shape[1] // 2
    (own1, far1), (own2, far2) = (
        borders(part, book) for part, book in zip((rows[:, :half], rows[:, half:]), books,
                                                  strict=True))
    slack = 1e-9
    for i in range(len(rows)):
        room = reach * reach - far1[i] ** 2 + slack
        for first in np.flatnonzero((room >= 0) & (np.arange(len(room)) >= own1[i])):
            near = np.flatnonzero(far2[i] ** 2 <= room[first])
            after = near[(first > own1[i]) | (near > own2[i])]
            home = first == own1[i]
            if home or len(after):
                order = after[np.argsort(far2[i][after], kind="stable")]
                yield i, int(first), int(own2[i]) if home else -1, order


def _reach(cosine: float, recall: float, length: int) -> float:
    radius = float(np.sqrt(2 - 2 * cosine))
    if recall >= 1:
        return radius
    return radius * min(1.0, NormalDist().inv_cdf(recall) / np.sqrt(length))


def _meet(vectors: np.ndarray, weights: np.ndarray, home: np.ndarray, seconds: list,
          cosine: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Weighted partners of each row, and the edges of stars that join them."""
    size = np.linalg.norm(vectors, axis=1)
    links = np.zeros(len(vectors), np.int64)
    guests: dict[int, list[int]] = {}
    for i, codes in enumerate(seconds):
        for code in codes:
            guests.setdefault(int(code), []).append(i)
    ends = [], []
    for code in np.unique(home[home >= 0]):
        here = np.flatnonzero(home == code)
        others = np.array(guests.get(int(code), []), np.int64)
        for at in range(0, len(here), BLOCK):
            mine = here[at:at + BLOCK]
            for rows, inner in ((here, True), (others, False)):
                for b in range(0, len(rows), BLOCK):
                    part = rows[b:b + BLOCK]
                    alike = (vectors[mine] @ vectors[part].T) / (
                        size[mine][:, None] * size[part])
                    hit = alike >= cosine
                    if inner:
                        hit &= mine[:, None] != part
                    links[mine] += hit @ weights[part]
                    if not inner:
                        links[part] += weights[mine] @ hit
                    x, y = np.nonzero(hit)
                    if len(x):
                        a, c = star(mine[x], part[y])
                        ends[0].append(a)
                        ends[1].append(c)
    if not ends[0]:
        return links, np.zeros(0, np.int64), np.zeros(0, np.int64)
    return links, *star(np.concatenate(ends[0]), np.concatenate(ends[1]))


def _linked_points(points: DataFrame, cosine: float, recall: float) -> DataFrame:
    """`points`: point, kind (what must be equal), vector, n. Returns point, links, other: per
    task and point its partners met there, and the point it hangs on."""
    most = points.groupBy("kind").count().agg(F.max("count")).first()[0] or 0
    # The usual length: the codebooks serve vectors of that length, others share one cell.
    sizes = points.groupBy(F.size("vector").alias("size")).count().orderBy(
        F.desc("count"), "size").limit(1).collect()
    length = sizes[0]["size"] if sizes else 0
    sample = points.where(F.size("vector") == length).orderBy(F.xxhash64("point")).limit(
        SAMPLE).select("vector").toArrow()
    codes = int(min(MAX_CODES, max(1, np.ceil(np.sqrt(most / CELL)))))
    books = []
    if length >= 2 and codes > 1:
        rows = unit(matrix(sample.column(0)))
        half = length // 2
        books = [codebook(part, min(codes, len(rows))) for part in
                 (rows[:, :half], rows[:, half:])]
    reach = _reach(cosine, recall, max(length, 1))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column("vector")
            usual = np.array([len(v) == length for v in vectors]) & bool(books)
            which = np.flatnonzero(usual)
            found = [(int(i), 0, 0, []) for i in np.flatnonzero(~usual)]
            if len(which):
                rows = unit(matrix(vectors.take(pa.array(which))))
                found += [(int(which[i]), *rest) for i, *rest in visits(rows, books, reach)]
            part = batch.take(pa.array([f[0] for f in found], pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*part.columns, pa.array([f[1] for f in found], pa.int32()),
                 pa.array([f[2] for f in found], pa.int32()),
                 pa.array([list(f[3]) for f in found], pa.list_(pa.int32()))],
                names=["point", "kind", "vector", "n", "cell", "home", "seconds"])

    def meet(group: pa.Table) -> pa.Table:
        names = group.column("point").to_numpy()
        home = group.column("home").to_numpy()
        links, a, b = _meet(
            matrix(group.column("vector")), group.column("n").to_numpy(), home,
            group.column("seconds").to_pylist(), cosine)
        other = names.copy()
        other[a] = names[b]
        some = links > 0
        return pa.table({"point": pa.array(names[some], pa.string()), "links": links[some],
                         "other": pa.array(other[some], pa.string())})

    given = points.select("point", "kind", "vector", "n")
    schema = ", ".join(f"`{name}` {kind}" for name, kind in given.dtypes)
    sent = given.mapInArrow(send, f"{schema}, cell int, home int, seconds array<int>")
    return sent.groupBy("kind", "cell").applyInArrow(
        meet, "point string, links bigint, other string")


def embedding_groups(
    embeddings: DataFrame, key: str = "vec_id", vector: str = "embedding",
    label: str = "label", cosine: float = COSINE, recall: float = RECALL,
) -> DataFrame:
    """Per row: the key, `n_links`, `component_id` and `kept`."""
    own = embeddings.select(F.col(key).alias("key"), F.col(vector).alias("vector"),
                            F.col(label).alias("label"))
    links_any = usable("vector") & F.col("label").isNotNull()
    kind = F.concat_ws(":", F.size("vector"), F.col("label").cast("string"))
    named = own.select("key", F.when(links_any, F.md5(F.concat_ws(
        "|", kind, F.col("vector").cast("string")))).alias("point"),
        F.when(links_any, kind).alias("kind"), "vector")
    points = stored(named.where("point IS NOT NULL").groupBy("point").agg(
        F.first("kind").alias("kind"), F.first("vector").alias("vector"),
        F.count(F.lit(1)).alias("n"), F.min("key").alias("least")), "vectors")
    met = stored(_linked_points(points, cosine, recall), "links")
    counted = met.groupBy("point").agg(F.sum("links").alias("links"))
    member = components(met.select(F.col("point").alias("a"), F.col("other").alias("b")))
    grouped = points.drop("vector", "kind").join(
        member.withColumnRenamed("vertex", "point"), "point", "left").withColumn(
        "component", F.coalesce("component", "point"))
    least = grouped.groupBy("component").agg(F.min("least").alias("component_id"))
    facts = grouped.join(least, "component").join(counted, "point", "left").select(
        "point", "component_id", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("links"))
    joined = named.select("key", "point").join(facts, "point", "left")
    component = F.coalesce("component_id", "key")
    return joined.select(
        F.col("key").alias(key), F.coalesce("links", F.lit(0)).alias("n_links"),
        component.alias("component_id"), F.col("key").eqNullSafe(component).alias("kept"))


def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_groups(table(spark, sf_dir, "embeddings"))


OP1_SQL = """
WITH RECURSIVE v AS (
    SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
    WHERE label IS NOT NULL
), links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
        ON a.label = b.label AND a.vec_id <> b.vec_id
        AND list_cosine_similarity(a.e, b.e) >= 0.98
), reach AS (
    SELECT vec_id AS a, vec_id AS b FROM embeddings
    UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), least AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
many AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT l.vec_id, coalesce(m.n, 0) AS n_links, l.component_id, l.vec_id = l.component_id AS kept
FROM least l LEFT JOIN many m ON l.vec_id = m.vec_id
"""
