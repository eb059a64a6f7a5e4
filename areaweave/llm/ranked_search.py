"""Ranked lexical search by NRA ("no random access") over shards of documents.

One pass over the texts keeps, per document, its number of terms and how often each searched term
occurs. From these come the corpus statistics and with them the impact of each posting: what the
term adds to the document's score. Every task then goes through its documents in shards of a
bounded number of postings. A shard's postings are sorted by term and falling impact; the lists of
an item's terms are read from the front, block by block, and each document met has a lower bound
(what was read of it) and an upper bound (the impacts next in the lists it was not yet met in come
on top). Reading ends when nothing unread can reach the k-th score any more, equal scores included,
and every document left has equal bounds, so that membership, ties and scores are final. A task
passes the k-th score it has on to its next shard and returns k rows per item; these meet in one
small ranking.

The items are the stated query set: they go through the driver in blocks of a bounded number of
terms (`BLOCK_TERMS`; an item of more terms is a block of its own), each block with its own pass
over the documents.

Defined results: a NULL, empty or term-free text is no document and no item; the longest text is
read whole, in pieces cut between terms. Rows that repeat a key are documents of their own, as are
rows without one, which come last among equal scores; repeated items are ranked one by one. Empty
tables give an empty result. Extra columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from areaweave.llm.work import byte_slices, stored, table

BEST = 10
BLOCK_TERMS = 500_000
"""Terms of items that are looked for in one pass; a bound on what goes to each task."""
SHARD_POSTINGS = 1 << 20
SHARD_CELLS = 1 << 26
"""Documents of a shard times the terms of the longest item."""
FIRST_READ = 64
"""Postings read from each list in the first round; the double in each further one."""
PIECE = 1 << 20
"""Bytes of text held as terms at one time."""

_FLAT = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80
    else 0x20 for b in range(256))


def term_lists(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text in order, in lists of at most `PIECE` bytes of text."""
    flat = text.translate(_FLAT)
    start = 0
    while len(flat) - start > PIECE:
        cut = flat.rfind(b" ", start, start + PIECE)
        if cut <= start:
            cut = flat.find(b" ", start + PIECE)
        if cut < 0:
            break
        yield flat[start:cut].split()
        start = cut
    yield flat[start:].split()


@dataclass(frozen=True)
class Item:
    key: int | None
    terms: np.ndarray
    times: np.ndarray


@dataclass(frozen=True)
class Block:
    """Items and the numbers of their terms."""

    numbers: dict[bytes, int]
    items: list[Item]


def item_blocks(rows: Iterator[tuple[int | None, str | None]], limit: int) -> Iterator[Block]:
    numbers: dict[bytes, int] = {}
    items: list[Item] = []
    held = 0
    for key, text in rows:
        times = Counter()
        for words in term_lists((text or "").encode()):
            times.update(words)
        if not times:
            continue
        if items and held + len(times) > limit:
            yield Block(numbers, items)
            numbers, items, held = {}, [], 0
        found = [numbers.setdefault(term, len(numbers)) for term in times]
        items.append(Item(key, np.array(found), np.array(list(times.values()), np.int64)))
        held += len(times)
    if items:
        yield Block(numbers, items)


_COUNTED = "key bigint, n_terms bigint, terms array<int>, times array<int>"


def _lists(parts: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    flat = np.concatenate([*parts, np.empty(0, np.int32)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))


def _count(numbers: dict[bytes, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Columns: key, text."""
        get, none = numbers.get, repeat(-1)
        for batch in batches:
            for part in byte_slices(batch, 1, PIECE):
                sizes, terms, times = [], [], []
                for text in part.column(1).cast(pa.binary()):
                    size, found = 0, []
                    for words in term_lists(text.as_py() or b""):
                        size += len(words)
                        codes = np.fromiter(map(get, words, none), np.int32, len(words))
                        found.append(codes[codes >= 0])
                    code, often = np.unique(np.concatenate(found), return_counts=True)
                    sizes.append(size)
                    terms.append(code)
                    times.append(often)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(sizes, pa.int64()), _lists(terms), _lists(times)],
                    names=["key", "n_terms", "terms", "times"])

    return run


class Shard:
    """The impact-sorted posting lists of some documents."""

    def __init__(self, batches: list[pa.RecordBatch], weights: np.ndarray, docs: int, total: int):
        rows = pa.Table.from_batches(batches).combine_chunks()
        keys = rows["key"].combine_chunks()
        self.keys = keys.fill_null(0).to_numpy(zero_copy_only=False)
        self.nameless = keys.is_null().to_numpy(zero_copy_only=False)
        n = rows["n_terms"].to_numpy()
        scale = 25 + 75 * n * docs // total
        lists = rows["terms"].combine_chunks()
        term = lists.flatten().to_numpy()
        often = rows["times"].combine_chunks().flatten().to_numpy().astype(np.int64)
        counts = lists.value_lengths().to_numpy()
        doc = np.repeat(np.arange(len(n)), counts)
        impact = weights[term] * (1_000_000_000 * often // (1000 * often + 8 * scale[doc]))
        some = np.flatnonzero(impact)
        order = some[np.lexsort([doc[some], -impact[some], term[some]])]
        self.doc, self.impact = doc[order], impact[order]
        self.starts = np.searchsorted(term[order], np.arange(len(weights) + 1))

    def best(self, item: Item, k: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents, by place, that may be among the k best, and their whole scores. Any document
        left out scores below `floor` or below k others."""
        at, end = self.starts[item.terms], self.starts[item.terms + 1]
        has = end > at
        at, end, times = at[has], end[has], item.times[has]
        lower = np.zeros(len(self.keys), np.int64)
        met = np.zeros((len(self.keys), len(at)), bool)
        step = FIRST_READ
        while True:
            ahead = np.zeros(len(at), np.int64)
            for j in np.flatnonzero(at < end):
                stop = min(at[j] + step, end[j])
                docs = self.doc[at[j]:stop]
                lower[docs] += times[j] * self.impact[at[j]:stop]
                met[docs, j] = True
                at[j] = stop
                if stop < end[j]:
                    ahead[j] = times[j] * self.impact[stop]
            unread = int(ahead.sum())
            kth = int(np.partition(lower, -k)[-k]) if len(lower) >= k else 0
            kth = max(kth, floor, 1)
            if unread < kth:
                near = np.flatnonzero(lower + unread >= kth)
                missing = np.where(met[near], 0, ahead).sum(axis=1)
                near, missing = (x[lower[near] + missing >= kth] for x in (near, missing))
                if not missing.any():
                    return near, lower[near]
            step *= 2


def _shards(batches: Iterator[pa.RecordBatch], widest: int) -> Iterator[list[pa.RecordBatch]]:
    """Cut the rows so that postings and documents of a shard are bounded."""
    rows = max(1, SHARD_CELLS // widest)
    held, postings, docs = [], 0, 0
    for batch in batches:
        ends = np.cumsum(batch.column(2).value_lengths().to_numpy(zero_copy_only=False))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = int(np.searchsorted(ends, before + SHARD_POSTINGS - postings, side="right"))
            stop = min(max(stop, start + (not held)), start + rows - docs)
            if stop > start:
                held.append(batch.slice(start, stop - start))
                postings, docs = postings + int(ends[stop - 1] - before), docs + stop - start
                start = stop
            if start < batch.num_rows:
                yield held
                held, postings, docs = [], 0, 0
    if held:
        yield held


_FOUND = "item int, item_key bigint, key bigint, score bigint"


def _search(items: list[Item], weights: np.ndarray, docs: int, total: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        empty = (np.empty(0, np.int64), np.empty(0, bool), np.empty(0, np.int64))
        best = [empty] * len(items)
        widest = max(len(item.terms) for item in items)
        for rows in _shards(batches, widest):
            shard = Shard(rows, weights, docs, total)
            for i, item in enumerate(items):
                floor = int(best[i][2][-1]) if len(best[i][2]) == k else 0
                near, score = shard.best(item, k, floor)
                if not len(near):
                    continue
                both = [np.concatenate(pair) for pair in zip(
                    best[i], (shard.keys[near], shard.nameless[near], score), strict=True)]
                order = np.lexsort([both[0], both[1], -both[2]])[:k]
                best[i] = tuple(column[order] for column in both)
        sizes = [len(b[0]) for b in best]
        if sum(sizes):
            keys, nameless, score = (np.concatenate(c) for c in zip(*best, strict=True))
            item_keys = pa.array([item.key for item in items], pa.int64())
            number = np.repeat(np.arange(len(items), dtype=np.int32), sizes)
            yield pa.RecordBatch.from_arrays(
                [pa.array(number), item_keys.take(pa.array(number)),
                 pa.array(keys, mask=nameless), pa.array(score)],
                names=["item", "item_key", "key", "score"])

    return run


def _best_of_block(docs: DataFrame, block: Block, k: int) -> DataFrame:
    counted = stored(docs.mapInArrow(_count(block.numbers), _COUNTED).where("n_terms > 0"), "terms")
    size = counted.agg(F.count(F.lit(1)).alias("docs"), F.sum("n_terms").alias("total")).first()
    weights = np.zeros(len(block.numbers), np.int64)
    # One number per searched term: bounded by the block.
    for row in counted.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        ratio = (2 * size.docs + 2) / (2 * row["count"] + 1)
        weights[row.term] = math.floor(1000 * math.log(ratio))
    found = counted.mapInArrow(
        _search(block.items, weights, size.docs, size.total or 1, k), _FOUND)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("key"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def ranked_search(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text",
                  item_key: str = "item_id", item_text: str = "text", k: int = BEST,
                  block_terms: int = BLOCK_TERMS) -> DataFrame:
    """The `k` best documents of each item: item_id, rank, doc_id, score. Keys are whole numbers."""
    spark = docs.sparkSession
    texts = docs.select(F.col(f"`{key}`").cast("bigint").alias("key"),
                        F.col(f"`{text}`").alias("text"))
    asked = items.select(F.col(f"`{item_key}`").cast("bigint"), F.col(f"`{item_text}`"))
    result = spark.createDataFrame([], f"{_FOUND}, rank int")
    for n, block in enumerate(item_blocks(map(tuple, asked.toLocalIterator()), block_terms)):
        found = _best_of_block(texts, block, k)
        result = result.unionByName(found) if n else found
    return result.select(F.col("item_key").alias("item_id"), "rank", F.col("key").alias("doc_id"),
                         "score")


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP12_SQL = r"""
WITH docs AS (
    SELECT row_number() OVER () AS no, doc_id, regexp_extract_all(translate(
        coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
    FROM documents
), items AS (
    SELECT row_number() OVER () AS item, item_id, regexp_extract_all(translate(
        coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
    FROM benchmark
), sizes AS (
    SELECT count(*) AS docs, CAST(sum(len(terms)) AS BIGINT) AS total FROM docs WHERE len(terms) > 0
), tf AS (
    SELECT no, term, count(*) AS tf FROM (SELECT no, unnest(terms) AS term FROM docs)
    GROUP BY no, term
), asked AS (
    SELECT item, term, count(*) AS times FROM (SELECT item, unnest(terms) AS term FROM items)
    GROUP BY item, term
), weights AS (
    SELECT term, CAST(floor(1000 * ln(
        CAST(2 * any_value(docs) + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
    FROM tf, sizes GROUP BY term
), scaled AS (
    SELECT no, doc_id, 25 + (75 * CAST(len(terms) AS BIGINT) * docs) // total AS m
    FROM docs, sizes WHERE len(terms) > 0
), scores AS (
    SELECT item, no, any_value(doc_id) AS doc_id,
        CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
    FROM asked JOIN tf USING (term) JOIN weights USING (term) JOIN scaled USING (no)
    GROUP BY item, no
), ranked AS (
    SELECT item, doc_id, score, CAST(row_number() OVER (
        PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank
    FROM scores WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked JOIN items USING (item) WHERE rank <= 10
"""
