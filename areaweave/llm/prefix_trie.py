"""Conversation prefix trie by ternary search trees, one per range shard.

Turns are dictionary-encoded: equal (role, text) pairs share one number, found by their SHA-256, so
that texts are read once and never shuffled. A conversation is then a sequence of numbers.
Sequences are sorted and cut into ranges (equal ones may be in several). A task builds a ternary
search tree of its range by inserting the median first, then the medians of the halves, and goes
through the nodes from the last to the first, so that each comes after all below it, adding up
members, leaves and savings.

Only prefixes of a range's first or last sequence can occur in other ranges as well. These boundary
nodes leave the task as partial sums and are merged in groups of `FAN` neighbouring ranges, again
and again: in each round all nodes but those along the group's own two borders become final, so a
merging task sees at most `FAN` times two paths, however many ranges there are.

A node's `node` is a SHA-256 over the numbers of its turns, `parent` that of the node above.
Conversations that end in a boundary node travel as short texts of ids, in order, and are digested
as a stream: a node where very many end costs time in one task, as SHA-256 has to go through them one
after the other, but no memory.

Defined results: rows without a conversation number belong to none and are left out. Turns of a
conversation go by `turn`, NULL first, equal ones by the SHA-256 of their contents. A NULL role or
text counts as empty. An empty table has no node, not even a root. A conversation is one row of
numbers, 12 bytes a turn, and the only thing that grows with the longest one. Extra columns are not
read.
"""

from __future__ import annotations

import hashlib
import struct
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from areaweave.llm.work import stored, table

SHARD_TURNS = 1 << 19
FAN = 64
ENDS_BYTES = 4096
"""Length of one text of ids."""

ROOT = hashlib.sha256(b"").digest()
NOTHING = hashlib.sha256(b"").hexdigest()
_NONE = -1
_NO_CONV = (1 << 63) - 1


def encoded(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
            text: str = "text") -> DataFrame:
    """conv_id, ids (a number per turn, in order) and sizes (UTF-8 bytes of their texts)."""
    said = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role, text)]
    mark = F.unhex(F.sha2(F.concat(F.octet_length(said[0]).cast("string"), F.lit(":"), *said), 256))
    rows = stored(turns.where(F.col(f"`{conv}`").isNotNull()).select(
        F.col(f"`{conv}`").cast("bigint").alias("conv_id"), F.col(f"`{turn}`").alias("turn"),
        mark.alias("mark"), F.octet_length(said[1]).alias("size")), "turns")
    # Numbered while written, so that they are what they are from then on.
    numbers = stored(rows.select("mark").distinct().withColumn(
        "id", F.monotonically_increasing_id()), "turn-numbers")
    ordered = F.sort_array(F.collect_list(F.struct("turn", "mark", "id", "size")))
    return rows.join(numbers, "mark").groupBy("conv_id").agg(ordered.alias("turns")).select(
        "conv_id", F.col("turns.id").alias("ids"), F.col("turns.size").alias("sizes"))


class TernaryTree:
    """Nodes are prefixes, in order of creation: a node comes after the one above it. `same` leads
    to the tree of what follows the node, `low` and `high` to other numbers at its place."""

    def __init__(self):
        self.number, self.low, self.same, self.high, self.up = (array("q") for _ in range(5))
        self.least, self.members, self.size, self.depth = (array("q") for _ in range(4))
        self.name: list[bytes] = []
        self.ends: dict[int, list[int]] = {}
        self._add(_NONE, 0, 0)

    def _add(self, up: int, number: int, size: int) -> int:
        for links in (self.low, self.same, self.high):
            links.append(_NONE)
        self.least.append(_NO_CONV)
        self.up.append(up)
        self.number.append(number)
        self.members.append(0)
        self.size.append(size)
        self.depth.append(self.depth[up] + 1 if up != _NONE else 0)
        self.name.append(ROOT if up == _NONE else below(self.name[up], number))
        return len(self.up) - 1

    def _next(self, node: int, number: int, size: int) -> int:
        links, place = self.same, node
        while (at := links[place]) != _NONE:
            here = self.number[at]
            if number == here:
                return at
            links, place = (self.low if number < here else self.high), at
        links[place] = new = self._add(node, number, size)
        return new

    def insert(self, ids, sizes, convs: list[int]) -> None:
        """A sequence and the conversations that have it, in order."""
        node = 0
        for number, size in zip(ids, sizes, strict=True):
            node = self._next(node, number, size)
        self.ends[node] = convs

    def path(self, ids) -> list[int]:
        nodes = [0]
        for number in ids:
            nodes.append(self._next(nodes[-1], number, 0))
        return nodes

    def gather(self, border: set[int]) -> tuple[array, array, array]:
        """Children, leaves and savings below each node, the node itself and nodes on the border
        not counted; fills `members` and `least`."""
        children, leaves, saved = (array("q", bytes(8 * len(self.up))) for _ in range(3))
        for node in range(len(self.up) - 1, -1, -1):
            convs = self.ends.get(node)
            if convs:
                self.members[node] += len(convs)
                self.least[node] = min(self.least[node], convs[0])
            up = self.up[node]
            if up == _NONE:
                continue
            self.members[up] += self.members[node]
            self.least[up] = min(self.least[up], self.least[node])
            if node not in border:
                children[up] += 1
                leaves[up] += leaves[node] or 1
                saved[up] += saved[node] + (self.members[node] - 1) * self.size[node]
        return children, leaves, saved


def below(name: bytes, number: int) -> bytes:
    return hashlib.sha256(name + struct.pack(">q", number)).digest()


def medians_first(n: int) -> Iterator[int]:
    """All places below n, the median first, then those of the halves."""
    spans = [(0, n)]
    for start, stop in spans:
        if start < stop:
            middle = (start + stop) // 2
            yield middle
            spans += [(start, middle), (middle + 1, stop)]


_NODE = ("node binary, parent binary, depth bigint, size bigint, conv_id bigint, n_convs bigint, "
         "n_children bigint, n_leaves bigint, saved_tokens bigint")
_FOUND = f"kind int, shard bigint, first boolean, last boolean, {_NODE}, parent_conv_id bigint, ends string"
_INNER, _BORDER, _ENDS = 0, 1, 2


def _shard_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Columns: conv_id, ids, sizes, sorted by ids and conv_id."""
    shard = TaskContext.get().partitionId()
    sequences: list[tuple[np.ndarray, np.ndarray, list[int]]] = []
    for batch in batches:
        convs = batch.column(0).to_pylist()
        ids, sizes = (batch.column(c).flatten().to_numpy() for c in (1, 2))
        ends = np.cumsum(batch.column(1).value_lengths().to_numpy()).tolist()
        start = 0
        for conv, end in zip(convs, ends, strict=True):
            own = ids[start:end]
            if sequences and np.array_equal(sequences[-1][0], own):
                sequences[-1][2].append(conv)
            else:
                sequences.append((own, sizes[start:end], [conv]))
            start = end
    if not sequences:
        return
    tree = TernaryTree()
    for i in medians_first(len(sequences)):
        ids, sizes, convs = sequences[i]
        tree.insert(ids.tolist(), sizes.tolist(), convs)
    first, last = (set(tree.path(sequences[i][0].tolist())) for i in (0, -1))
    border = first | last
    children, leaves, saved = tree.gather(border)
    inner = [n for n in range(len(tree.up)) if n not in border]
    outer = sorted(border)

    def rows(nodes: list[int], kind: int, ends: list) -> pa.RecordBatch:
        up = [tree.up[n] for n in nodes]
        known = [u != _NONE and u not in border for u in up]
        whole = kind == _INNER
        columns = {
            "kind": pa.array([kind] * len(nodes), pa.int32()),
            "shard": pa.array([shard] * len(nodes), pa.int64()),
            "first": pa.array([n in first for n in nodes], pa.bool_()),
            "last": pa.array([n in last for n in nodes], pa.bool_()),
            "node": pa.array([tree.name[n] for n in nodes], pa.binary()),
            "parent": pa.array([tree.name[u] if u != _NONE else None for u in up], pa.binary()),
            **{name: pa.array(values, pa.int64()) for name, values in {
                "depth": [tree.depth[n] for n in nodes],
                "size": [tree.size[n] for n in nodes],
                "conv_id": [tree.least[n] for n in nodes],
                "n_convs": [tree.members[n] for n in nodes],
                "n_children": [children[n] for n in nodes],
                "n_leaves": [(leaves[n] or 1) if whole else leaves[n] for n in nodes],
                "saved_tokens": [
                    saved[n] + ((tree.members[n] - 1) * tree.size[n] if whole else 0)
                    for n in nodes],
                "parent_conv_id": [
                    tree.least[u] if k else None for u, k in zip(up, known, strict=True)],
            }.items()},
            "ends": pa.array(ends, pa.string()),
        }
        order = [c.split()[0] for c in _FOUND.split(", ")]
        return pa.RecordBatch.from_arrays([columns[c] for c in order], names=order)

    for start in range(0, len(inner), 10_000):
        part = inner[start:start + 10_000]
        yield rows(part, _INNER, [
            hashlib.sha256(",".join(map(str, tree.ends[n])).encode()).hexdigest()
            if n in tree.ends else NOTHING for n in part])
    yield rows(outer, _BORDER, [None] * len(outer))
    step = ENDS_BYTES // 8
    for n in outer:
        convs = tree.ends.get(n, [])
        for start in range(0, len(convs), 1000 * step):
            cut = range(start, min(start + 1000 * step, len(convs)), step)
            yield rows([n] * len(cut), _ENDS, [",".join(map(str, convs[i:i + step])) for i in cut])


def _merge(last_round: bool):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        """The boundary nodes of some neighbouring ranges. Nodes along the border of them all stay
        partial, unless no other ranges are left."""
        first, last = (side & (rows["shard"] == end) & (not last_round) for side, end in (
            (rows["first"], rows["shard"].min()), (rows["last"], rows["shard"].max())))
        rows = rows.assign(shard=rows["group"], first=first, last=last)
        met = rows.groupby("node", sort=False).agg({
            "shard": "first", "first": "max", "last": "max", "parent": "first", "depth": "first",
            "size": "first", "conv_id": "min", "n_convs": "sum", "n_children": "sum",
            "n_leaves": "sum", "saved_tokens": "sum"})
        at = {name: i for i, name in enumerate(met.index)}
        up = [at.get(p, _NONE) for p in met["parent"]]
        partial = (met["first"] | met["last"]).to_numpy()
        children, leaves, saved, members, size = (met[c].to_numpy().copy() for c in (
            "n_children", "n_leaves", "saved_tokens", "n_convs", "size"))
        for i in np.argsort(-met["depth"].to_numpy(), kind="stable"):
            if partial[i]:
                continue
            leaves[i] = leaves[i] or 1
            saved[i] += (members[i] - 1) * size[i]
            if up[i] != _NONE:
                children[up[i]] += 1
                leaves[up[i]] += leaves[i]
                saved[up[i]] += saved[i]
        met = met.assign(n_children=children, n_leaves=leaves, saved_tokens=saved,
                         kind=np.where(partial, _BORDER, _INNER))
        return met.reset_index()[[c.split()[0] for c in _MERGED.split(", ")]]

    return run


_MERGED = f"kind int, shard bigint, first boolean, last boolean, {_NODE}"


def _merged(found: DataFrame, shards: int) -> DataFrame:
    """The boundary nodes, whole."""
    columns = [c.split()[0] for c in _MERGED.split(", ")]
    partial = found.where(f"kind = {_BORDER}").select(*columns)
    whole: DataFrame | None = None
    while True:
        shards = -(-shards // FAN)
        step = stored(partial.withColumn("group", F.expr(f"shard DIV {FAN}")).groupBy(
            "group").applyInPandas(_merge(shards == 1), _MERGED), "boundary")
        done = step.where(f"kind = {_INNER}")
        whole = done if whole is None else whole.unionByName(done)
        if shards == 1:
            return whole
        partial = step.where(f"kind = {_BORDER}")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Columns: node, shard, ends; the rows of a node come together and in order."""
    now, digest = None, None

    def row():
        return pa.RecordBatch.from_arrays(
            [pa.array([now], pa.binary()), pa.array([digest.hexdigest()])], names=["node", "sha256"])

    for batch in batches:
        for node, ends in zip(batch.column(0).to_pylist(), batch.column(2), strict=True):
            if node != now:
                if digest:
                    yield row()
                now, digest = node, hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(ends.as_py().encode())
    if digest:
        yield row()


def prefix_trie(sequences: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """The nodes of the trie over rows of conv_id, ids and sizes, as `encoded` gives them: node,
    parent, depth, conv_id (smallest member), parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256 (of the members that end there)."""
    rows = stored(sequences.select("conv_id", "ids", "sizes"), "sequences")
    turns = rows.agg(F.sum(F.size("ids") + 1)).first()[0] or 0
    shards = max(1, -(-turns // shard_turns))
    placed = rows.repartitionByRange(shards, "ids", "conv_id").sortWithinPartitions("ids", "conv_id")
    found = stored(placed.mapInArrow(_shard_nodes, _FOUND), "nodes")
    # What a range is numbered by is its place among all partitions, which may be more than asked.
    numbered = found.agg(F.max("shard")).first()[0] or 0
    border = _merged(found, numbered + 1)
    ends = found.where(f"kind = {_ENDS}").select("node", "shard", "ends", F.expr(
        "CAST(split_part(ends, ',', 1) AS BIGINT) AS first_conv"))
    digests = ends.repartition("node").sortWithinPartitions("node", "shard", "first_conv").select(
        "node", "shard", "ends").mapInArrow(_digests, "node binary, sha256 string")
    whole = ["node", "parent", "depth", "conv_id", "n_convs", "n_children", "n_leaves",
             "saved_tokens"]
    inner = found.where(f"kind = {_INNER}").select(
        *whole, "parent_conv_id", F.col("ends").alias("ends_sha256"))
    outer = border.join(digests, "node", "left").select(
        *whole, F.lit(None).cast("bigint").alias("parent_conv_id"),
        F.coalesce("sha256", F.lit(NOTHING)).alias("ends_sha256"))
    # Only below a boundary node is the parent's smallest member not yet known.
    names = border.select(F.col("node").alias("parent"), F.col("conv_id").alias("above"))
    open_ = inner.where("parent_conv_id IS NULL").unionByName(outer)
    named = open_.join(names, "parent", "left").withColumn("parent_conv_id", F.col("above"))
    return inner.where("parent_conv_id IS NOT NULL").unionByName(named.drop("above")).select(
        *whole[:4], "parent_conv_id", *whole[4:], "ends_sha256")


def conversation_trie(turns: DataFrame, conv: str = "conv_id", turn: str = "turn",
                      role: str = "role", text: str = "text") -> DataFrame:
    """The prefix trie of conversations given turn by turn."""
    return prefix_trie(encoded(turns, conv, turn, role, text))


def rebuilt(sequences: DataFrame) -> DataFrame:
    """Each conversation's first turns taken from conversation c - c % 5: of that one the first h
    turns, then its own after its first h, where h = crc32(c) % 9."""
    base = sequences.where("conv_id % 5 = 0").select(
        F.col("conv_id").alias("base"), F.col("ids").alias("base_ids"),
        F.col("sizes").alias("base_sizes"))
    own = sequences.select("*", F.expr("conv_id - conv_id % 5 AS base"),
                           F.expr("CAST(crc32(CAST(conv_id AS STRING)) % 9 AS INT) AS h"))
    joined = own.join(base, "base", "left")

    def spliced(column: str, kind: str) -> str:
        return (f"concat(coalesce(slice(base_{column}, 1, h), CAST(array() AS ARRAY<{kind}>)), "
                f"slice({column}, h + 1, size({column}))) AS {column}")

    return joined.selectExpr("conv_id", spliced("ids", "BIGINT"), spliced("sizes", "INT"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = encoded(table(spark, sf_dir, "conversations"))
    return prefix_trie(rebuilt(turns)).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        "ends_sha256")


OP13_SQL = r"""
WITH turns AS (
    SELECT conv_id, turn, CAST(strlen(coalesce(text, '')) AS BIGINT) AS size,
        sha256(CAST(strlen(coalesce(role, '')) AS VARCHAR) || ':' || coalesce(role, '')
            || coalesce(text, '')) AS mark
    FROM conversations WHERE conv_id IS NOT NULL
), own AS (
    SELECT conv_id, list(mark ORDER BY turn NULLS FIRST, mark) AS marks,
        list(size ORDER BY turn NULLS FIRST, mark) AS sizes,
        -- CRC-32, bit by bit: -1 stands for one shift, other numbers are the next byte.
        CAST(xor(list_reduce(list_concat([4294967295], flatten(list_transform(
            string_split(CAST(conv_id AS VARCHAR), ''),
            lambda c: [CAST(ascii(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
            lambda a, b: CASE WHEN b >= 0 THEN xor(a, b)
                ELSE xor(a >> 1, 3988292384 * (a & 1)) END), 4294967295) % 9 AS INTEGER) AS h
    FROM turns GROUP BY conv_id
), rebuilt AS (
    SELECT o.conv_id, list_concat(coalesce(b.marks[1:o.h], []), o.marks[o.h + 1:]) AS marks,
        list_concat(coalesce(b.sizes[1:o.h], []), o.sizes[o.h + 1:]) AS sizes
    FROM own o LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 5
), prefixes AS (
    SELECT conv_id, depth, len(marks) AS total, array_to_string(marks[1:depth], ' ') AS node,
        CASE WHEN depth > 0 THEN array_to_string(marks[1:depth - 1], ' ') END AS parent,
        coalesce(sizes[depth], 0) AS size
    FROM (SELECT *, unnest(range(0, len(marks) + 1)) AS depth FROM rebuilt)
), nodes AS (
    SELECT node, any_value(parent) AS parent, any_value(depth) AS depth, any_value(size) AS size,
        min(conv_id) AS conv_id, count(*) AS n_convs,
        sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)
            FILTER (total = depth), '')) AS ends_sha256
    FROM prefixes GROUP BY node
), children AS (
    SELECT parent AS node, count(*) AS n FROM nodes WHERE parent IS NOT NULL GROUP BY parent
), valued AS (
    SELECT n.*, coalesce(c.n, 0) AS n_children, (n.n_convs - 1) * n.size AS saved
    FROM nodes n LEFT JOIN children c USING (node)
), subtrees AS (
    SELECT p.node, CAST(sum(CASE WHEN v.n_children = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_leaves,
        CAST(sum(v.saved) AS BIGINT) AS saved_tokens
    FROM valued v JOIN prefixes p ON p.conv_id = v.conv_id AND p.depth <= v.depth
    GROUP BY p.node
)
SELECT v.conv_id, v.depth, u.conv_id AS parent_conv_id, v.n_convs, v.n_children, s.n_leaves,
    s.saved_tokens, v.ends_sha256
FROM valued v JOIN subtrees s USING (node) LEFT JOIN nodes u ON u.node = v.parent
"""
