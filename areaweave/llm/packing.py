"""Best-fit packing of token sequences by linear grouping.

Lengths are at most the capacity, so how many pieces have which length is a bounded table. From
it alone a plan is made: large lengths are sorted and cut into groups of equal cardinality, each
rounded up to its longest; a linear program over these few sizes (columns made by a knapsack)
says how often each configuration is used; actual lengths are put in for the rounded ones, which
gives room back; and what is left, small lengths above all, goes best-fit into the gaps. Bins
that look alike are planned together, so the plan's size does not depend on the number of pieces.
Each piece then finds its bin from its rank among the pieces of its length.

Defined results: a NULL text is empty, so its document is the end token alone. Rows are packed as
they are: repeated rows, and repeated or NULL keys, are pieces of their own. An empty table gives
an empty result. Extra columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from areaweave.llm import tokens
from areaweave.llm.work import giving_back, stored, table

CAPACITY = 1024
END = 2
GROUPS = (1000, 4000)
"""Numbers of groups tried; the plan with the fewest bins is taken. Groups that round to the same
length are one size, so there are never more sizes than lengths."""
ROUNDS = 40
COLUMNS = 40
"""Rounds of column generation at most, and columns taken in one round."""
SMALL = 16
"""Lengths up to capacity / SMALL take no part in the configurations."""
RANKED_ROWS = 200_000
"""Pieces of one length that a task ranks at a time, on average."""


# --- documents to pieces -------------------------------------------------------------------


def cut(length: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces: one if it fits; else all are full but the first."""
    first = (length - 1) % capacity + 1
    starts = [0, *range(first, length, capacity)]
    return [(s, (first if s == 0 else capacity)) for s in starts]


def _pieces_of(batch: pa.RecordBatch, encode: tokens.UnitEncoder, end: int, capacity: int):
    rows: list[list] = [[], [], [], [], []]
    closing = np.uint32(end).tobytes()
    texts = ((value.as_py() or "") for value in batch.column(1))

    def finish(number: int, parts: list[bytes]) -> None:
        ids = b"".join(parts) + closing
        for piece, (start, length) in enumerate(cut(len(ids) // 4, capacity)):
            for column, value in zip(rows, (
                    number, piece, start, length,
                    zlib.crc32(memoryview(ids)[4 * start:4 * (start + length)])), strict=True):
                column.append(value)

    open_number, parts = 0, []
    for group in tokens.balanced(texts, encode.units, tokens.BATCH_BYTES):
        found = encode.look_up([p for _, pieces in group for p in pieces])
        at = 0
        for number, pieces in group:
            while open_number < number:
                finish(open_number, parts)
                open_number, parts = open_number + 1, []
            parts.append(b"".join(found[at:at + len(pieces)]))
            at += len(pieces)
    while open_number < batch.num_rows:
        finish(open_number, parts)
        open_number, parts = open_number + 1, []
    return rows


def _encoded(batches: Iterator[pa.RecordBatch], encode: tokens.UnitEncoder, end: int,
             capacity: int) -> Iterator[pa.RecordBatch]:
    types = (pa.int32(), pa.int64(), pa.int64(), pa.int64())
    for batch in batches:
        row, *others = _pieces_of(batch, encode, end, capacity)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(pa.array(row, pa.int64())),
             *[pa.array(v, t) for v, t in zip(others, types, strict=True)]],
            names=["key", "piece", "start", "length", "ids_crc32"])


def token_pieces(
    documents: DataFrame, key: str = "doc_id", text: str = "text",
    vocabulary: str = tokens.VOCABULARY, end: int = END, capacity: int = CAPACITY,
    cached_units: int = tokens.CACHED_UNITS, forget: bool = False,
) -> DataFrame:
    """Encode each text, end it with `end` and cut it: key, piece, start, length, ids_crc32.
    `cached_units`: what a worker may remember, memory against time; `forget`: not beyond a task."""
    kind = documents.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokens.encoder(vocabulary, bytes, cached_units)
        yield from _encoded(batches, encode, end, capacity)
        if forget:
            encode.kept.clear()

    return documents.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(
        giving_back(run), f"key {kind}, piece int, start bigint, length bigint, ids_crc32 bigint"
    ).withColumnRenamed("key", key)


# --- the plan, from the number of pieces of each length ------------------------------------


@dataclass
class Kind:
    """`count` bins alike: (length, how many of it in each bin) in order, and the room left."""

    count: int
    room: int
    items: list[tuple[int, int]] = field(default_factory=list)


def _knapsack(sizes: np.ndarray, worth: np.ndarray, capacity: int):
    """For every room, the most worth that fits and the size (ascending) to take first, or -1."""
    best = np.zeros(capacity + 1)
    taken = np.full(capacity + 1, -1)
    usable = np.searchsorted(sizes, np.arange(capacity + 1), side="right")
    for room in range(int(sizes[0]), capacity + 1):
        value = worth[:usable[room]] + best[room - sizes[:usable[room]]]
        j = value.argmax()
        if value[j] > best[room - 1] + 1e-12:
            best[room], taken[room] = value[j], j
        else:
            best[room] = best[room - 1]
    return best, taken


def _column(sizes: np.ndarray, taken: np.ndarray, first: int, capacity: int) -> np.ndarray:
    used = np.zeros(len(sizes))
    used[first] = 1
    room = capacity - sizes[first]
    while room > 0:
        if taken[room] < 0:
            room -= 1
        else:
            used[taken[room]] += 1
            room -= sizes[taken[room]]
    return used


def _greedy(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> np.ndarray:
    """Columns to start from: fill a bin with the longest sizes still wanted and use it until
    one of them is met. Sizes are met one after the other, so the columns form a basis."""
    left, columns = demand.copy(), np.zeros((len(sizes), len(sizes)))
    while (left > 0).any():
        used, room = np.zeros(len(sizes)), capacity
        while (fit := np.flatnonzero((left > 0) & (sizes <= room))).size:
            used[fit[-1]] += room // sizes[fit[-1]]
            room %= sizes[fit[-1]]
        times = np.full(len(sizes), np.inf)
        np.divide(left, used, out=times, where=used > 0)
        met = int(times.argmin())
        left = np.maximum(left - used * times[met], 0)
        left[met] = 0
        columns[:, met] = used
    for j in np.flatnonzero(columns.diagonal() == 0):
        columns[:, j] = 0
        columns[j, j] = capacity // sizes[j]
    return columns


def configurations(sizes: np.ndarray, demand: np.ndarray, capacity: int):
    """(uses, sizes taken) of the linear program min sum(uses) with the demand met, by column
    generation: the dual values price new columns through the knapsack, for each size the best
    column that holds it. Every step keeps a feasible solution, so stopping early only costs
    bins."""
    columns = _greedy(sizes, demand, capacity)
    inverse = np.linalg.inv(columns)
    for _ in range(ROUNDS):
        worth = np.maximum(inverse.sum(axis=0), 0)
        best, taken = _knapsack(sizes, worth, capacity)
        with_each = worth + best[capacity - sizes]
        if with_each.max() <= 1 + 1e-7:
            break
        for first in np.argsort(-with_each)[:COLUMNS]:
            new = _column(sizes, taken, first, capacity)
            if inverse.sum(axis=0) @ new <= 1 + 1e-7:
                continue
            uses, change = np.maximum(inverse @ demand, 0), inverse @ new
            ratio = np.full(len(sizes), np.inf)
            np.divide(uses, change, out=ratio, where=change > 1e-9)
            out = int(ratio.argmin())
            if not np.isfinite(ratio[out]):
                continue
            columns[:, out] = new
            pivot = inverse[out] / change[out]
            inverse -= np.outer(change, pivot)
            inverse[out] = pivot
        inverse = np.linalg.inv(columns)
    uses = inverse @ demand
    return [(float(u), columns[:, j].astype(int)) for j, u in enumerate(uses) if u > 1e-9]


def _groups(counts: np.ndarray, large: range, groups: int) -> list[list[list[int]]]:
    """Runs [length, count], longest first, of each group of equal cardinality."""
    total = int(counts[large.start:large.stop].sum())
    out: list[list[list[int]]] = [[] for _ in range(groups)]
    rank = 0
    for length in reversed(large):
        left = int(counts[length])
        while left:
            group = rank * groups // total
            # The first rank of the next group is the least r with r * groups // total > group.
            take = min(left, -(-(group + 1) * total // groups) - rank)
            out[group].append([length, take])
            rank, left = rank + take, left - take
    return [runs for runs in out if runs]


def _substitute(groups, configs) -> list[Kind]:
    """Put actual lengths, longest first, for the rounded sizes; uses are rounded down."""
    kinds = []
    for uses, used in configs:
        count = int(uses + 1e-6)
        parts = [Kind(count, CAPACITY)] if count else []
        for group, times in enumerate(used):
            for _ in range(int(times)):
                runs, parts = groups[group], _fill(groups[group], parts)
                groups[group] = [r for r in runs if r[1]]
        kinds.extend(parts)
    return kinds


def _fill(runs: list[list[int]], parts: list[Kind]) -> list[Kind]:
    """Give each bin of `parts` one piece from `runs`, as far as they go."""
    filled = []
    at = 0
    for part in parts:
        left = part.count
        while left and at < len(runs):
            length, there = runs[at]
            if not there:
                at += 1
                continue
            take = min(left, there)
            filled.append(Kind(take, part.room - length, [*part.items, (length, 1)]))
            runs[at][1] -= take
            left -= take
        if left:
            filled.append(Kind(left, part.room, part.items))
    return filled


def _best_fit(kinds: list[Kind], counts: np.ndarray, capacity: int) -> list[Kind]:
    """Put the lengths in `counts`, longest first, where the least room is left."""
    by_room: dict[int, list[Kind]] = {}
    for kind in kinds:
        by_room.setdefault(kind.room, []).append(kind)
    for length in range(capacity, 0, -1):
        left = int(counts[length])
        for room in range(length, capacity + 1):
            while left and by_room.get(room):
                kind = by_room[room].pop()
                each = room // length
                whole = min(kind.count, left // each)
                for bins, many in ((whole, each), (1, left - whole * each)):
                    if bins and many and kind.count and many <= each:
                        kind.count -= bins
                        left -= bins * many
                        by_room.setdefault(room - many * length, []).append(
                            Kind(bins, room - many * length, [*kind.items, (length, many)]))
                if kind.count:
                    by_room[room].append(kind)
        each = capacity // length
        for bins, many in ((left // each, each), (1, left % each)):
            if bins and many:
                by_room.setdefault(capacity - many * length, []).append(
                    Kind(bins, capacity - many * length, [(length, many)]))
    return [kind for same in by_room.values() for kind in same]


def plan_bins(counts: np.ndarray, capacity: int = CAPACITY, tried=GROUPS) -> list[Kind]:
    """Kinds of bins that hold counts[n] pieces of each length n, up to the capacity."""
    large = range(capacity // SMALL + 1, capacity)
    best: list[Kind] | None = None
    total = int(counts[large.start:large.stop].sum())
    for wanted in tried:
        left = counts.copy()
        kinds: list[Kind] = []
        if wanted and total:
            groups = _groups(counts, large, min(wanted, total))
            sizes, place = np.unique([runs[0][0] for runs in groups], return_inverse=True)
            merged: list[list[list[int]]] = [[] for _ in sizes]
            for runs, at in zip(groups, place, strict=True):
                merged[at].extend(runs)
            demand = np.array([sum(n for _, n in runs) for runs in merged], float)
            kinds = _substitute(merged, configurations(sizes, demand, capacity))
            for kind in kinds:
                for length, many in kind.items:
                    left[length] -= kind.count * many
            kinds = [kind for kind in kinds if kind.items]
        kinds = _best_fit(kinds, left, capacity)
        if best is None or sum(k.count for k in kinds) < sum(k.count for k in best):
            best = kinds
    return best


def _runs(kinds: list[Kind]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, end rank, per bin, first bin, offset) for each item of each kind."""
    out, ranks, first = [], {}, 0
    for kind in kinds:
        offset = 0
        for length, many in kind.items:
            start = ranks.get(length, 0)
            ranks[length] = start + kind.count * many
            out.append((length, start, ranks[length], many, first, offset))
            offset += length * many
        first += kind.count
    return out


# --- pieces to bins -------------------------------------------------------------------------


def _ranked(pieces: DataFrame, counts: DataFrame, order: list[str]) -> DataFrame:
    """Add `rank`, from 0, among the pieces of a length. A length is ranked in shards, as many
    as its count asks for, and the shards before are added up: no length has to fit one task."""
    shards = F.ceil(F.col("n") / RANKED_ROWS).cast("int")
    sized = pieces.join(F.broadcast(counts.select("length", shards.alias("shards"))), "length")
    dealt = sized.withColumn("shard", F.pmod(F.xxhash64(*order), F.col("shards")))
    per_shard = dealt.groupBy("length", "shard").agg(F.count("*").alias("held"))
    before = per_shard.select("length", "shard", F.coalesce(F.sum("held").over(
        Window.partitionBy("length").orderBy("shard")
        .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    within = F.row_number().over(
        Window.partitionBy("length", "shard").orderBy(*[F.col(c) for c in order]))
    return dealt.withColumn("within", within).join(before, ["length", "shard"]).withColumn(
        "rank", F.col("before") + F.col("within") - 1).drop("within", "before", "shard", "shards")


def pack(pieces: DataFrame, order: list[str], capacity: int = CAPACITY) -> DataFrame:
    """Add `sequence_id` (from 0) and `offset` to pieces with a `length` of 1 to `capacity`.
    `order`: columns that tell pieces apart; equal rows are interchangeable.

    The driver gets one count per length, at most `capacity` numbers, and the plan sent back is
    bounded by the capacity alone; both broadcasts are therefore small at any size of input.
    """
    spark = pieces.sparkSession
    counted = pieces.groupBy("length").agg(F.count("*").alias("n")).collect()
    counts = np.zeros(capacity + 1, np.int64)
    for row in counted:
        counts[row["length"]] = row["n"]
    runs = spark.createDataFrame(
        _runs(plan_bins(counts, capacity)),
        "length bigint, first bigint, end bigint, many bigint, bin bigint, at bigint")
    lengths = spark.createDataFrame([tuple(row) for row in counted], "length bigint, n bigint")
    ranked = _ranked(pieces, lengths, order)
    nth = F.col("rank") - F.col("first")
    placed = ranked.join(F.broadcast(runs.withColumnRenamed("length", "run_length")),
                         (F.col("length") == F.col("run_length"))
                         & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("end")))
    return placed.select(
        *pieces.columns,
        (F.col("bin") + F.floor(nth / F.col("many"))).alias("sequence_id"),
        (F.col("at") + F.pmod(nth, F.col("many")) * F.col("length")).alias("offset"))


def pack_documents(documents: DataFrame, key: str = "doc_id", text: str = "text",
                   cached_units: int = tokens.CACHED_UNITS, forget: bool = False) -> DataFrame:
    """Encode, cut and pack whole documents."""
    pieces = stored(token_pieces(
        documents, key, text, cached_units=cached_units, forget=forget), "pieces")
    return pack(pieces, [key, "piece", "start", "ids_crc32"])


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))
