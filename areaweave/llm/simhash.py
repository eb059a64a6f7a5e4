"""SimHash near-dedup with vantage-point trees.

Texts get 64-bit fingerprints; equal ones are one point. A vantage-point tree over a bounded
sample of the points splits the space by Hamming distance: a point goes home to one shard, and as
a probe to every other shard that the triangle bound cannot rule out. Each shard goes on with a
tree of its own down to small leaves, where points are compared bit by bit. So every pair within
`max_bits` is met, whatever the tree looks like; the sample only decides how even the shards are.
A shard returns no pairs but a star for each group it sees, so a ball of near copies costs rows in
proportion to its points.

Defined results: a NULL text, or one without words, has fingerprint zero and is linked like any
other. A NULL key is never the smallest of its group; a group of NULL keys has a NULL component.
Repeated rows are all returned. An empty table gives an empty result. Extra columns are not read.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from areaweave.llm.components import components
from areaweave.llm.work import giving_back, stored, table

SHINGLE = 3
MAX_BITS = 2
SEED = 42
SHARD_POINTS = 20_000
"""Points of a shard aimed at, up to MAX_SHARDS shards."""
MAX_SHARDS = 4096
SAMPLE_PER_SHARD = 64
"""Sampled points per shard for the upper tree; at most MAX_SHARDS times this many in all."""
LEAF = 512
BLOCK = 1 << 15
"""Shingles whose bits are counted at one time."""


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """Bits that are set in over half of the hashes of the shingles; ASCII letters lower-cased."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    count = max(1, len(words) - shingle + 1)
    tally = np.zeros(64, np.int64)
    for at in range(0, count, BLOCK):
        hashes = np.array(
            [xxh64_intdigest(b" ".join(words[i:i + shingle]), SEED)
             for i in range(at, min(count, at + BLOCK))], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        tally += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * tally > count, bitorder="little").view("<u8")[0])


def _signed(values: list[int]) -> np.ndarray:
    return np.array(values, np.uint64).view(np.int64)


def fingerprints(texts: DataFrame, key: str, text: str, shingle: int = SHINGLE) -> DataFrame:
    """Per row: key and point, the fingerprint as a signed number."""
    kind = texts.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(1).cast(pa.binary())
            found = _signed([fingerprint(v.as_py(), shingle) for v in values])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found)],
                                             names=["key", "point"])

    return texts.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(
        giving_back(run), f"key {kind}, point bigint")


# --- vantage-point trees ---------------------------------------------------------------------


def distance(points: np.ndarray, other) -> np.ndarray:
    return np.bitwise_count(points ^ other).astype(np.int16)


def vantage(points: np.ndarray, reach: int) -> tuple[int, int] | None:
    """(vantage point, radius): of a few points, the one whose median radius leaves the fewest
    near the border. None if no radius splits the points well."""
    best = None
    for other in points[np.linspace(0, len(points) - 1, 5).astype(int)]:
        far = distance(points, other)
        radius = int(np.median(far))
        inside = np.count_nonzero(far <= radius)
        border = np.count_nonzero(abs(far - radius) <= reach)
        worst = max(inside, len(points) - inside) + border
        if best is None or worst < best[0]:
            best = (worst, int(other), radius)
    return best[1:] if best and best[0] < 1.6 * len(points) else None


def split(points: np.ndarray, home: np.ndarray, centre: int, radius: int, reach: int):
    """Indices and home flags of what goes inside and outside. Points at home inside that may
    have partners outside go there as probes; probes go wherever they may have partners."""
    far = distance(points, np.uint64(centre))
    inside = far <= radius
    to_in = np.where(home, inside, far <= radius + reach)
    to_out = np.where(home & ~inside, True, far > radius - reach)
    return (np.flatnonzero(to_in), home[to_in]), (
        np.flatnonzero(to_out), (home & ~inside)[to_out])


def plant(sample: np.ndarray, shards: int, reach: int, first: int = 0):
    """A tree over the sample: (centre, radius, inner, outer), or the number of a shard."""
    if shards <= 1 or len(sample) < 4 or (found := vantage(sample, reach)) is None:
        return first
    inside = distance(sample, np.uint64(found[0])) <= found[1]
    half = shards // 2
    return (*found, plant(sample[inside], half, reach, first),
            plant(sample[~inside], shards - half, reach, first + half))


def route(tree, points: np.ndarray, home: np.ndarray, reach: int, rows: np.ndarray):
    """(shard, rows, home flags) for each shard reached."""
    if not len(points):
        return
    if isinstance(tree, int):
        yield tree, rows, home
        return
    centre, radius, inner, outer = tree
    for part, (at, flags) in zip((inner, outer), split(points, home, centre, radius, reach),
                                 strict=True):
        yield from route(part, points[at], flags, reach, rows[at])


def star(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The edges replaced by one from each vertex to the smallest of its component."""
    names, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = ends[:len(a)], ends[len(a):]
    label = np.arange(len(names))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        for side in (x, y):
            np.minimum.at(new, label[side], low)
            np.minimum.at(new, side, low)
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    other = label != np.arange(len(names))
    return names[other], names[label[other]]


def links(points: np.ndarray, home: np.ndarray, reach: int):
    """Stars that join all points within `reach`, of which at least one is at home here."""
    if not home.any():
        return
    found = vantage(points[home], reach) if np.count_nonzero(home) > LEAF else None
    if found:
        for at, flags in split(points, home, *found, reach):
            yield from links(points[at], flags, reach)
        return
    own = points[home]
    for i in range(0, len(own), LEAF):
        block = own[i:i + LEAF]
        a, b = [], []
        for j in range(0, len(points), 16 * LEAF):
            x, y = np.nonzero(distance(block[:, None], points[None, j:j + 16 * LEAF]) <= reach)
            far = block[x] != points[j + y]
            a.append(block[x[far]])
            b.append(points[j + y[far]])
        a, b = np.concatenate(a), np.concatenate(b)
        if len(a):
            yield star(a, b)


def near_points(points: DataFrame, reach: int = MAX_BITS) -> DataFrame:
    """`points`: distinct `point`s. Returns edges a, b that connect all within `reach` bits."""
    count = points.count()
    shards = min(MAX_SHARDS, -(-count // SHARD_POINTS))
    sample = [row[0] for row in points.orderBy(F.xxhash64("point")).limit(
        shards * SAMPLE_PER_SHARD).collect()] if shards > 1 else []
    tree = plant(np.array(sample, np.int64).view(np.uint64), shards, reach)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(0).to_numpy(zero_copy_only=False)
            for shard, rows, home in route(tree, own.view(np.uint64), np.ones(len(own), bool),
                                           reach, np.arange(len(own))):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(rows), shard)), pa.array(own[rows]), pa.array(home)],
                    names=["shard", "point", "home"])

    def search(group: pa.Table) -> pa.Table:
        own = group.column("point").to_numpy().view(np.uint64)
        home = group.column("home").to_numpy()
        stars = list(links(own, home, reach))
        a, b = (np.concatenate([s[i] for s in stars]) if stars else np.zeros(0, np.uint64)
                for i in (0, 1))
        a, b = star(a, b) if len(a) else (a, b)
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

    sent = points.select("point").mapInArrow(send, "shard bigint, point bigint, home boolean")
    return sent.groupBy("shard").applyInArrow(search, "a bigint, b bigint")


def simhash_groups(
    texts: DataFrame, key: str = "doc_id", text: str = "text",
    shingle: int = SHINGLE, max_bits: int = MAX_BITS,
) -> DataFrame:
    """Per row: the key, `fingerprint` (16 hex digits) and `component_id`: the smallest key that
    links of at most `max_bits` differing bits reach."""
    found = stored(fingerprints(texts, key, text, shingle), "fingerprints")
    points = stored(found.groupBy("point").agg(F.min("key").alias("least")), "points")
    member = components(near_points(points, max_bits))
    grouped = points.join(member.withColumnRenamed("vertex", "point"), "point", "left").select(
        "point", "least", F.coalesce("component", "point").alias("component"))
    smallest = grouped.groupBy("component").agg(F.min("least").alias("component_id"))
    classes = grouped.join(smallest, "component").select("point", "component_id")
    return found.join(classes, "point").select(
        F.col("key").alias(key),
        F.lower(F.lpad(F.hex("point"), 16, "0")).alias("fingerprint"), "component_id")


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(table(spark, sf_dir, "documents"))
