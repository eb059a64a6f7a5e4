"""Substring dedup by difference-cover anchors.

A window of `WINDOW` words is removed where its words also start a window in a row with a smaller
key. Hashing every window for a shuffle is not needed: sub-windows ("anchors") of 7 words are
hashed only at positions whose remainder modulo 7 is 1, 2 or 4. Any two remainders reach one of
these pairs by the same shift of at most 6, so two equal windows of 13 words always share an
anchor at the same place in both. Only windows around an anchor that two rows share are then
hashed in full and compared.

A batch is gone through in slices of `SLICE` bytes of text, a longer text alone, so the words held
at one time do not depend on the batch or on how long its texts are.

Hot passages: within a slice equal anchors and equal windows are combined before the shuffle. A
row that is not the smallest of its slice is settled on the spot; per slice one row for each hash
goes on, so a passage that a third of all rows holds is one row per slice. What is settled for a
row goes on as runs of neighbouring places. Of rows with one text only the smallest key is compared:
in the others every window is a repeat. Rows that repeat a key and text count once.

A row goes by one number, a hash of its key and text; where windows are compared and removed the
key goes with it.

Defined results: a NULL or empty text has no words; a NULL key is neither smaller nor greater
than another, so such rows stay whole and remove nothing. Rows with equal keys do not remove one
another's words; each is judged against smaller keys. Extra columns are kept; output columns
replace input columns of their names. An empty table gives an empty result.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType
from xxhash import xxh3_64_intdigest, xxh64_intdigest

from areaweave.llm.work import byte_slices, free_name, give_back, giving_back, table

WINDOW = 13
PERIOD = 7
COVER = (1, 2, 4)
"""Differences of these numbers modulo the period give every remainder."""
ANCHOR = WINDOW - PERIOD + 1
SLICE = 2 << 20
_ODD = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
ANCHOR_BITS = 48
"""Bits of an anchor's hash that are compared. Anchors only say where to look, so a chance hit costs
a few windows; windows are compared by 64 bits of one hash and 32 of another, of the words anew."""


class Words:
    """The words of the texts of a batch, one after the other."""

    def __init__(self, texts: pa.Array):
        split = [(value or b"").split() for value in texts.cast(pa.binary()).to_pylist()]
        self.words = [word for row in split for word in row]
        self.counts = np.array([len(row) for row in split], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.counts)])
        self.row = np.repeat(np.arange(len(split)), self.counts)
        self.place = np.arange(len(self.words)) - self.starts[self.row]
        self.left = self.counts[self.row] - self.place
        self.codes = self.coded(xxh64_intdigest)

    def coded(self, digest) -> np.ndarray:
        return np.fromiter(map(digest, self.words), np.uint64, len(self.words))

    def hashes(self, at: np.ndarray, length: int, odd: int, codes: np.ndarray) -> np.ndarray:
        """Hashes of the `length` words from each of `at` on."""
        total = np.zeros(len(at), np.uint64)
        for step in range(length):
            total = total * np.uint64(odd) + codes[at + step]
        total ^= total >> np.uint64(32)
        return (total * np.uint64(odd)).view(np.int64)

    def anchor_hashes(self, at: np.ndarray) -> np.ndarray:
        whole = self.hashes(at, ANCHOR, _ODD[0], self.codes).view(np.uint64)
        return (whole >> np.uint64(64 - ANCHOR_BITS)).astype(np.int64)

    def anchors(self) -> np.ndarray:
        chosen = np.isin(self.place % PERIOD, COVER) & (self.left >= ANCHOR)
        return np.flatnonzero(chosen & (self.counts[self.row] >= WINDOW))


def _settle(hashes: list[np.ndarray], keys: np.ndarray):
    """Sort by hash, then key. Returns the order, and in that order: whether the row has
    the smallest key of its hash, and whether the hash has several keys."""
    order = np.lexsort([keys, *hashes])
    new = np.ones(len(order), bool)
    for h in hashes:
        new[1:] &= h[order][1:] == h[order][:-1]
    new[1:] = ~new[1:]
    group = np.cumsum(new) - 1
    sorted_keys = keys[order]
    least = sorted_keys[np.flatnonzero(new)][group] if len(order) else sorted_keys
    smallest = sorted_keys == least
    several = np.zeros(group[-1] + 1 if len(order) else 0, bool)
    several[group[~smallest]] = True
    return order, smallest, several[group] if len(order) else several


# `settled` has runs, as `_runs` writes them. What differs from row to row stands together: the rest
# is what the row before had, which a shuffle compresses well.
_ANCHORS = "h1 bigint, text_hash bigint, settled array<int>"
_WINDOWS = "h1 bigint, h2 bigint, key bigint, text_hash bigint, settled array<int>"
"""`h2`: the place, then 32 bits of the second hash; as one number it is sent in fewer bytes."""
_LOW = 0x7FFFFFFF


def _found(batch: pa.RecordBatch, schema: str, row, settled, **values) -> pa.RecordBatch:
    """Rows to compare by hash, then rows with what is settled for a row. These need no comparison;
    they stand under a hash of text and key, so that copies of one text are spread."""
    known = np.array(list(settled), np.int64)
    marks = batch.column(1).to_numpy()
    salt = (_keys(batch)[known].astype(np.uint64) * np.uint64(_ODD[0])).view(np.int64)
    both = np.concatenate([row, known])
    columns = {
        "key": batch.column(0).take(pa.array(both)),
        "text_hash": pa.array(marks[both]),
        "settled": pa.array([None] * len(row) + list(settled.values()), pa.list_(pa.int32())),
    }
    for name, found in values.items():
        rest = marks[known] ^ salt if name == "h1" else np.zeros(len(known), found.dtype)
        columns[name] = pa.array(np.concatenate([found, rest]))
    names = [c.split()[0] for c in schema.split(", ")]
    return pa.RecordBatch.from_arrays([columns[name] for name in names], names=names)


def _short(codes: np.ndarray) -> np.ndarray:
    """What tells the shared anchors of one text from its others, well enough to look there."""
    return (codes & _LOW).astype(np.int32)


def _runs(row: np.ndarray, place: np.ndarray) -> dict[int, np.ndarray]:
    """By row: the runs of neighbouring places, first and end of each. They are written as
    -1 - n, to stand beside single numbers. `row` and `place` are in order."""
    if not len(row):
        return {}
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (place[1:] != place[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(row)) - 1
    pairs = np.column_stack([-1 - place[first], -2 - place[last]]).astype(np.int32)
    owner = row[first]
    cuts = np.flatnonzero(np.diff(owner)) + 1
    return {int(k): part.ravel() for k, part in zip(
        owner[np.concatenate([[0], cuts])], np.split(pairs, cuts), strict=True)}


def _single_and_runs(told: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The single numbers, and the firsts and ends of the runs."""
    pairs = -1 - told[told < 0].astype(np.int64)
    return told[told >= 0], pairs[::2], pairs[1::2]


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Columns: key, mark, text, ...; one of the rows that repeat a key and mark."""
    for batch in batches:
        for part in byte_slices(batch, 2, SLICE):
            row = np.rec.fromarrays([_keys(part), part.column(1).to_numpy()])
            first = np.unique(row, return_index=True)[1]
            yield part if len(first) == len(row) else part.take(pa.array(np.sort(first)))


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Columns: key, mark, text."""
    for batch in _slices(batches):
        words = Words(batch.column(2))
        at = words.anchors()
        if not len(at):
            continue
        owner = words.row[at]
        pairs, which = np.unique(np.rec.fromarrays(
            [words.anchor_hashes(at), owner], names="code,row"), return_inverse=True)
        codes, row = pairs["code"], pairs["row"]
        order, smallest, several = _settle([codes], _keys(batch)[row])
        # Shared within the slice: known for all its rows. The smallest still stands for the
        # slice, since rows elsewhere may have the same anchor.
        shared = np.zeros(len(pairs), bool)
        shared[order] = several
        shared = np.flatnonzero(shared[which])
        number = shared - np.searchsorted(at, words.starts)[owner[shared]]
        codes, row = codes[order], row[order]
        one = _in_row_order(smallest, row)
        yield _found(batch, _ANCHORS, row[one], _runs(owner[shared], number), h1=codes[one])


def _in_row_order(chosen: np.ndarray, row: np.ndarray) -> np.ndarray:
    """The chosen places, those of a row together: a shuffle compresses its repeated key well."""
    at = np.flatnonzero(chosen)
    return at[np.argsort(row[at], kind="stable")]


def _keys(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column(0).to_numpy(zero_copy_only=False)


def _window_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Columns: key, mark, text, what is known of its shared anchors."""
    for batch in _slices(batches):
        words = Words(batch.column(2))
        at = words.anchors()
        codes = _short(words.anchor_hashes(at))
        shared = np.zeros(len(at), bool)
        cuts = np.searchsorted(at, words.starts)
        for row, known in enumerate(batch.column(3)):
            lo, hi = cuts[row], cuts[row + 1]
            single, firsts, ends = _single_and_runs(known.values.to_numpy())
            shared[lo:hi] = np.isin(codes[lo:hi], _short(single))
            for first, end in zip(firsts.tolist(), ends.tolist(), strict=True):
                shared[lo + first:lo + end] = True
        # The window starts from which a shared anchor is reached.
        hit = at[shared]
        cover = np.zeros(len(words.words) + 1, np.int64)
        np.add.at(cover, np.maximum(hit - (WINDOW - ANCHOR), words.starts[words.row[hit]]), 1)
        np.add.at(cover, hit + 1, -1)
        at = np.flatnonzero((np.cumsum(cover[:-1]) > 0) & (words.left >= WINDOW))
        if not len(at):
            continue
        row, place = words.row[at], words.place[at]
        h1 = words.hashes(at, WINDOW, _ODD[0], words.codes)
        h2 = words.hashes(at, WINDOW, _ODD[1], words.coded(xxh3_64_intdigest)).astype(np.int32)
        order, smallest, _ = _settle([h1, h2], _keys(batch)[row])
        gone = np.sort(order[~smallest])
        settled = _runs(row[gone], place[gone])
        one = order[_in_row_order(smallest, row[order])]
        yield _found(batch, _WINDOWS, row[one], settled, h1=h1[one],
                     h2=place[one] << 32 | h2[one].astype(np.int64) & 0xFFFFFFFF)


def _strip(text: bytes | None, starts) -> tuple[str, int, int]:
    """The kept words joined by a blank, the number of words and of removed words."""
    words = (text or b"").split()
    if starts is None or not len(starts):
        return b" ".join(words).decode(), len(words), 0
    cover = np.zeros(len(words) + 1, np.int64)
    single, firsts, ends = _single_and_runs(starts)
    ends = np.minimum(ends, len(words) - WINDOW + 1)
    firsts, ends = firsts[firsts < ends], ends[firsts < ends]
    np.add.at(cover, np.concatenate([single, firsts]), 1)
    np.add.at(cover, np.concatenate([single + WINDOW, ends - 1 + WINDOW]), -1)
    gone = np.cumsum(cover[:-1]) > 0
    kept = [word for word, out in zip(words, gone.tolist(), strict=True) if not out]
    return b" ".join(kept).decode(), len(words), int(gone.sum())


_STRIPPED = StructType([StructField("kept", StringType()), StructField("n_words", LongType()),
                        StructField("n_removed", LongType())])


def _stripped(parts: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    yield from _stripped_parts(parts)
    give_back()


def _stripped_parts(parts: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    """Text and places of windows to remove. In slices, so that only their words are objects."""
    for text, starts in parts:
        batch = pa.RecordBatch.from_arrays([text, starts], names=["text", "starts"])
        done = []
        for part in byte_slices(batch, 0, SLICE):
            rows = [_strip(t.as_py(), s.values.to_numpy() if s.is_valid else None)
                    for t, s in zip(part.column(0).cast(pa.binary()), part.column(1), strict=True)]
            done.append(pa.StructArray.from_arrays(
                [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(
                    (pa.string(), pa.int64(), pa.int64()))], names=_STRIPPED.names))
        yield pa.concat_arrays(done) if done else pa.array([], pa.struct(
            [("kept", pa.string()), ("n_words", pa.int64()), ("n_removed", pa.int64())]))


def repeated_windows(texts: DataFrame, key: str, text: str, mark: str, firsts: DataFrame
                     ) -> DataFrame:
    """`mark`: a column with a hash of key and text; `firsts`: the marks of the rows to compare, as
    `first_mark`. Per key and mark (`text_hash`): `starts`, the places of the windows to remove,
    single ones and runs. Keys are whole numbers."""
    row = [F.col(f"`{key}`"), F.col(f"`{mark}`")]
    given = [row[0].cast("bigint").alias("key"), row[1].alias("text_hash"),
             F.col(f"`{text}`").alias("text")]
    several = F.count(F.lit(1)).over(Window.partitionBy("h1"))
    short = F.col("h1").bitwiseAND(F.lit(_LOW).cast("bigint")).cast("int")  # as _short does
    # A hash with rows of several slices is shared, and so is what a slice settled.
    first = texts.join(firsts.select("first_mark"), row[1] == F.col("first_mark"), "left_semi")
    anchors = first.select(*given).mapInArrow(giving_back(_anchor_rows), _ANCHORS).withColumn(
        "several", several).where("several > 1 OR settled IS NOT NULL")
    shared = anchors.groupBy(F.col("text_hash").alias("shared_mark")).agg(F.flatten(F.collect_list(
        F.coalesce("settled", F.array(short)))).alias("shared"))
    # Dealt by the first hash alone, so that the second is not sent a second time.
    second = F.col("h2").bitwiseAND(F.lit(0xFFFFFFFF))
    least = F.min("key").over(Window.partitionBy("h1", second))
    windows = texts.join(shared, row[1] == F.col("shared_mark")).select(*given, "shared").mapInArrow(
        giving_back(_window_rows), _WINDOWS).repartition("h1").withColumn("least", least).where(
        "settled IS NOT NULL OR least < key")
    return windows.groupBy("key", "text_hash").agg(F.flatten(F.collect_list(
        F.coalesce("settled", F.array(F.shiftright("h2", 32).cast("int"))))).alias("starts"))


def substring_dedup(texts: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of `texts` with `kept_text`, `n_words` and `n_removed`.

    The texts themselves are shuffled once: both joins deal them by a hash of key and text, and
    Spark uses the first exchange again where no further columns are carried along."""
    taken = ("kept_text", "n_words", "n_removed")
    kept = [c for c in texts.columns if c in (key, text) or c.lower() not in taken]
    mark, result = free_name(kept, "text_mark"), free_name(kept, "result")
    number, same = F.col(f"`{key}`").cast("bigint"), F.xxhash64(F.col(f"`{text}`"))
    whole = texts.select(*[F.col(f"`{c}`") for c in kept], F.xxhash64(number, same).alias(mark))
    keyed = whole.where(F.col(f"`{key}`").isNotNull())
    # Of equal texts, told by two hashes, the smallest key stands for all.
    firsts = keyed.select(number.alias("number"), same.alias("same"),
                          F.xxhash64(F.lit(1), F.col(f"`{text}`")).alias("again")
                          ).groupBy("same", "again").agg(F.min("number").alias("number")).select(
        F.xxhash64("number", "same").alias("first_mark"), "number")
    found = repeated_windows(keyed, key, text, mark, firsts)
    own, hashed, starts = (free_name([*kept, mark], n) for n in ("own", "hashed", "starts"))
    told = firsts.join(found, (F.col("first_mark") == F.col("text_hash")) & (
        F.col("number").bitwiseXOR(F.col("key")) == 0), "left").select(
        F.col("number").alias(own), F.col("first_mark").alias(hashed),
        F.coalesce("starts", F.array().cast("array<int>")).alias(starts))
    joined = keyed.join(
        told,
        # The key is compared, but not dealt by: all joins use one exchange of the texts.
        (F.col(mark) == F.col(hashed)) & (number.bitwiseXOR(F.col(own)) == 0), "left"
    ).withColumn(starts, F.coalesce(F.col(starts), F.array(F.lit(-1), F.lit(-1 - _LOW))))
    nameless = whole.where(F.col(f"`{key}`").isNull()).withColumn(
        starts, F.lit(None).cast("array<int>"))
    columns = [F.col(f"`{c}`") for c in (*kept, starts)]
    strip = F.arrow_udf(_stripped, _STRIPPED)
    done = joined.select(*columns).union(nameless.select(*columns)).withColumn(
        result, strip(F.col(f"`{text}`"), F.col(starts)))
    return done.select(*[F.col(f"`{c}`") for c in kept],
                       F.col(result)["kept"].alias("kept_text"),
                       F.col(result)["n_words"].alias("n_words"),
                       F.col(result)["n_removed"].alias("n_removed"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring_dedup(docs).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


OP8_SQL = r"""
WITH words AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
    FROM documents
), windows AS (
    SELECT doc_id, i, array_to_string(words[i:i + 12], ' ') AS w
    FROM (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS i FROM words)
), starts AS (
    SELECT doc_id, i FROM (
        SELECT doc_id, i, min(doc_id) OVER (PARTITION BY w) AS least FROM windows)
    WHERE least < doc_id
), gone AS (
    SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i FROM starts
), each AS (
    SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM words
), kept AS (
    SELECT e.doc_id, count(g.i) AS n_removed,
        coalesce(string_agg(e.word, ' ' ORDER BY e.i) FILTER (g.i IS NULL), '') AS kept
    FROM each e LEFT JOIN gone g ON e.doc_id = g.doc_id AND e.i = g.i GROUP BY e.doc_id
)
SELECT w.doc_id, CAST(len(w.words) AS BIGINT) AS n_words,
    coalesce(k.n_removed, 0) AS n_removed, sha256(coalesce(k.kept, '')) AS kept_sha256
FROM words w LEFT JOIN kept k ON w.doc_id = k.doc_id
"""
