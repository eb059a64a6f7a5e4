"""SentencePiece encoding and decoding as a relational lattice.

Texts are cut where no piece of the model reaches across: between words, and between any two
characters that stand side by side in no piece. The distinct parts of all texts become lattices:
substrings up to the longest piece are exploded and joined to the piece table by equality, and the
matches, the edges, are grouped by part. A Spark higher-order `aggregate` then folds each lattice.
For unigram models it is Viterbi: the best path to every position in turn. For BPE models, whose
scores are merge ranks and not probabilities, the best path of the lattice is not the encoding;
there the fold goes through the edges, highest score and leftmost first, and merges two symbols
wherever an edge spans just these. One pass is enough, since every piece of the model is what its
own text is encoded to.

Texts themselves are not shuffled. They are dealt into blocks of about `BLOCK` characters; a block
is its distinct parts and, for each text, their numbers in order, so a part that every text has is
one row per block. Blocks are compressed and written once, by one exchange, from which both their
parts and, in the end, their texts are taken. The ids of the parts return to their blocks as
compressed runs, one per block and task, and the blocks are then spelt out.

A block that is lost is made anew, which gives the same one if its texts come in the same order, as
those of files do; store other texts first.

Parts longer than `LATTICE` characters do not fit the fold's state; the library encodes those by the
same model.

Defined results: a NULL or empty text has no ids and decodes to an empty string. Repeated rows and
repeated or NULL keys come back each with their ids. An empty table gives an empty result. Extra
columns are not read.
"""

import itertools
import json
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from areaweave.llm.work import giving_back, table

MODEL = public_tokenizers.path("piece_bpe_32k.model")
LATTICE = 62
"""Longest part that is folded: its borders are the bits of one number."""
BLOCK = 1 << 24
"""Characters of a block; a longer text is a block of its own."""
SENT, ANSWERED = 1 << 16, 1 << 18
"""Parts of a batch on their way out, and at most about so many held on their way back."""
CUT, PUT = 1 << 14, 1 << 18
"""Words of a block that are cut into parts, and that are put into texts, at one time."""
BLANK = "▁"
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, USER, BYTE = 1, 2, 4, 6
UNKNOWN_PENALTY = 10.0
"""What an unknown character scores below the worst piece, as the library has it."""


@dataclass(frozen=True)
class Pieces:
    """A model's table: (piece, id, score) that texts can use, what ids stand for in hex, the
    ids of bytes, the id of unknown characters, and the kind of model."""

    usable: tuple[tuple[str, int, float], ...]
    meaning: tuple[str, ...]
    byte_ids: tuple[int, ...]
    unknown: int
    kind: int
    prefix: bool

    @property
    def longest(self) -> int:
        return max(len(piece) for piece, _, _ in self.usable)

    @property
    def neighbours(self) -> frozenset[str]:
        """Every two characters that stand side by side in a piece."""
        return frozenset(piece[i:i + 2] for piece, _, _ in self.usable
                         for i in range(len(piece) - 1))


@lru_cache(maxsize=2)
def read_model(path: str) -> Pieces:
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as file:
        model.ParseFromString(file.read())
    normal = model.normalizer_spec
    if normal.precompiled_charsmap or normal.remove_extra_whitespaces:
        raise ValueError("only models that take the text as it is are supported")
    if model.trainer_spec.model_type not in (UNIGRAM, BPE):
        raise ValueError("only unigram and BPE models are supported")
    usable, meaning, byte_ids, unknown = [], [], {}, 0
    for number, piece in enumerate(model.pieces):
        if piece.type == BYTE:
            byte_ids[int(piece.piece[3:5], 16)] = number
            meaning.append(piece.piece[3:5])
            continue
        if piece.type in (NORMAL, USER):
            usable.append((piece.piece, number, piece.score))
            if BLANK in piece.piece.lstrip(BLANK):
                raise ValueError("pieces over several words are not supported")
            meaning.append(piece.piece.encode().hex())
            continue
        if piece.type == UNKNOWN:
            unknown = number
        meaning.append(" ⁇ ".encode().hex() if piece.type == UNKNOWN else "")
    return Pieces(tuple(usable), tuple(meaning), tuple(byte_ids[b] for b in sorted(byte_ids)),
                  unknown, model.trainer_spec.model_type, normal.add_dummy_prefix)


def _unknown_ids(char: Column, pieces: Pieces) -> Column:
    """Ids of a character that no piece has: its bytes, or the unknown id."""
    if len(pieces.byte_ids) < 256:
        return F.array(F.lit(pieces.unknown))
    ids = F.array(*[F.lit(i) for i in pieces.byte_ids])
    code = F.hex(F.encode(char, "UTF-8"))
    return F.transform(
        F.sequence(F.lit(1), F.length(code) - 1, F.lit(2)),
        lambda at: F.element_at(
            ids, F.conv(F.substring(code, at, F.lit(2)), 16, 10).cast("int") + 1))


def lattices(words: DataFrame, table_: DataFrame, pieces: Pieces) -> DataFrame:
    """`words`: distinct `word`s. Adds `edges`: start, end, score and ids of each substring that
    is a piece, and of each character that is none. The piece table is the model's, of a size
    that does not depend on the texts, and is broadcast."""
    size = F.length("word")
    spans = words.withColumn("s", F.explode(F.sequence(F.lit(0), size - 1))).withColumn(
        "e", F.explode(F.sequence(F.col("s") + 1, F.least(size, F.col("s") + pieces.longest))))
    cut = spans.withColumn("piece", F.expr("substring(word, s + 1, e - s)"))
    joined = cut.join(F.broadcast(table_), "piece", "left").where(
        F.col("id").isNotNull() | (F.col("e") - F.col("s") == 1))
    worst = min(score for _, _, score in pieces.usable) - UNKNOWN_PENALTY
    edge = F.struct(
        "s", "e", F.coalesce("score", F.lit(worst)).alias("score"),
        F.when(F.col("id").isNotNull(), F.array("id")).otherwise(
            _unknown_ids(F.col("piece"), pieces)).alias("ids"))
    return joined.groupBy("word").agg(F.collect_list(edge).alias("edges"))


def _let(value: Column, body) -> Column:
    """`body` of a value that is worked out once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def viterbi(edges: Column, length: Column) -> Column:
    """Ids of the path with the highest sum of scores; ties go to the greater ids."""
    start = F.array(F.struct(F.lit(0.0).alias("score"), F.array().cast("array<int>").alias("ids")))

    def step(best: Column, at: Column) -> Column:
        ways = F.transform(
            F.filter(edges, lambda d: d["e"] == at),
            lambda d: _let(F.element_at(best, d["s"] + 1), lambda b: F.struct(
                (b["score"] + d["score"]).alias("score"),
                F.concat(b["ids"], d["ids"]).alias("ids"))))
        return F.concat(best, F.array(F.array_max(ways)))

    return F.aggregate(F.sequence(F.lit(1), length), start, step,
                       lambda best: F.element_at(best, -1)["ids"])


def _power(exponent: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), exponent)


def merged(edges: Column, length: Column) -> Column:
    """Ids after merging adjacent symbols, the highest scoring and leftmost first. The state is
    one number whose bits are the symbols' borders; a merge clears the border between two."""

    def ends(edge: Column) -> Column:
        return _power(edge["s"]).bitwiseOR(_power(edge["e"]))

    def inner(edge: Column) -> Column:
        return _power(edge["e"]) - _power(edge["s"] + 1)

    def step(borders: Column, edge: Column) -> Column:
        two = (borders.bitwiseAND(edge["ends"]) == edge["ends"]) & (
            F.bit_count(borders.bitwiseAND(edge["inner"])) == 1)
        return F.when(two, borders.bitwiseAND(F.bitwise_not(edge["inner"]))).otherwise(borders)

    def ids(borders: Column) -> Column:
        last = F.filter(edges, lambda d: borders.bitwiseAND(
            ends(d).bitwiseOR(inner(d))) == ends(d))
        return F.flatten(F.transform(F.array_sort(last), lambda d: d["ids"]))

    longer = F.filter(edges, lambda d: d["e"] - d["s"] > 1)
    order = F.array_sort(F.transform(longer, lambda d: F.struct(
        (-d["score"]).alias("cost"), d["s"].alias("s"), ends(d).alias("ends"),
        inner(d).alias("inner"))))
    return F.aggregate(order, _power(length) - 1 + _power(length), step, ids)


def encode_words(words: DataFrame, model: str) -> DataFrame:
    """Distinct `word`s of at most `LATTICE` characters with their `ids`."""
    pieces = read_model(model)
    known = words.sparkSession.createDataFrame(
        list(pieces.usable), "piece string, id int, score double")
    fold = viterbi if pieces.kind == UNIGRAM else merged
    return lattices(words, known, pieces).select(
        "word", fold(F.col("edges"), F.length("word")).alias("ids"))


def _library_ids(processor, part: str, prefix: bool) -> list[int]:
    """The library puts a blank before a text. A part that starts with one gives it up for that;
    before another a line break is put, which no piece holds, and its ids are taken off."""
    if not prefix:
        return processor.encode(part)
    if part.startswith(BLANK):
        return processor.encode(part[1:]) if part != BLANK else processor.encode("\n" + part)[2:]
    return processor.encode("\n" + part)[len(processor.encode("\n")):]


# --- texts to blocks and back ---------------------------------------------------------------


def _word_finder(prefix: str):
    """Splits a text at blanks. A word has its blanks in front, the first of all words `prefix`."""
    words = re.compile(f"{BLANK}*[^{BLANK}]+|{BLANK}+").findall

    def find(text: str) -> list[str]:
        """The words without their first blank, if a prefix gives each of them one."""
        plain = text.split(" ") if prefix else [""]
        if "" not in plain:
            return plain
        found = words(prefix + text.replace(" ", BLANK)) if text else []
        return [word[1:] for word in found] if prefix else found

    return find


def _part_finder(pieces: Pieces):
    """Cuts words where two characters stand side by side in no piece."""
    chars = sorted({c for pair in pieces.neighbours for c in pair})
    number = np.zeros(0x110000, np.int32)
    number[[ord(c) for c in chars]] = np.arange(1, len(chars) + 1)
    together = np.zeros((len(chars) + 1, len(chars) + 1), bool)
    pairs = np.array([[ord(c) for c in pair] for pair in pieces.neighbours], np.int64).reshape(-1, 2)
    together[number[pairs[:, 0]], number[pairs[:, 1]]] = True

    def cut(words: list[str]) -> tuple[list[str], np.ndarray]:
        """The parts of all words, and how many each has."""
        if not words:
            return [], np.zeros(0, np.int64)
        whole = "".join(words)
        codes = number[np.frombuffer(whole.encode("utf-32-le"), "<u4")]
        first = np.ones(len(codes), bool)
        first[1:] = ~together[codes[:-1], codes[1:]]
        begins = np.concatenate([[0], np.cumsum([len(word) for word in words], dtype=np.int64)[:-1]])
        first[begins] = True
        starts = np.flatnonzero(first)
        parts = [whole[a:b] for a, b in itertools.pairwise([*starts.tolist(), len(whole)])]
        return parts, np.add.reduceat(first, begins, dtype=np.int64)

    return cut


def _squeezed(values: np.ndarray) -> bytes:
    """Small numbers as four planes of bytes, of which the upper ones compress to almost nothing."""
    planes = values.astype("<u4", copy=False).view(np.uint8).reshape(-1, 4).T.tobytes()
    return pa.compress(planes, "zstd", asbytes=True)


def _planes(squeezed: bytes, size: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(squeezed, 4 * size, "zstd"), np.uint8).reshape(4, -1)


def _numbers(planes: np.ndarray) -> np.ndarray:
    return planes.T.copy().view("<u4").ravel()


def _restored(squeezed: bytes, size: int) -> np.ndarray:
    return _numbers(_planes(squeezed, size))


def _packed(row: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, row.schema, options=pa.ipc.IpcWriteOptions(
            compression="zstd")) as writer:
        writer.write_batch(row)
    return sink.getvalue().to_pybytes()


def _unpacked(packed: pa.BinaryScalar, *fields: int) -> list[pa.ListScalar | pa.BinaryScalar]:
    """The values of a packed row in these fields."""
    options = pa.ipc.IpcReadOptions(included_fields=list(fields))
    with pa.ipc.open_stream(packed.as_buffer(), options=options) as reader:
        return [column[0] for column in reader.read_next_batch().columns]


PARTS, KEYS, HASHES, SIZES, NUMBERS = range(5)


class _Block:
    """Texts as numbers of their words, until the block is full."""

    def __init__(self):
        self.numbers: dict[str, int] = defaultdict()
        self.numbers.default_factory = self.numbers.__len__
        self.texts: list[np.ndarray] = []
        self.keys, self.hashes, self.size = [], [], 0

    def add(self, key, digest: int, words: list[str], size: int) -> None:
        self.texts.append(np.fromiter(map(self.numbers.__getitem__, words), np.int32, len(words)))
        self.keys.append(key)
        self.hashes.append(digest)
        self.size += size

    def row(self, number: int, cut, key_type: pa.DataType, blank: str = "") -> pa.RecordBatch:
        """Words, each with a `blank` put back, become parts, the most frequent with the smallest
        numbers. Words are cut, and put into texts, some at a time, and what is done with is let
        go, so that little stands beside the block itself."""
        words = list(self.numbers)
        self.numbers.clear()
        parts: dict[str, int] = defaultdict()
        parts.default_factory = parts.__len__
        flat, runs = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
        for at in range(0, len(words), CUT):
            found, many = cut([blank + word for word in words[at:at + CUT]])
            flat.append(np.fromiter(map(parts.__getitem__, found), np.int32, len(found)))
            runs.append(many)
        del words
        flat, runs = np.concatenate(flat), np.concatenate(runs)
        borders = np.cumsum([len(t) for t in self.texts], dtype=np.int64)
        chosen = np.concatenate([np.zeros(0, np.int32), *self.texts])
        self.texts.clear()
        times = np.zeros(len(runs), np.int64)
        for at in range(0, len(chosen), PUT):
            times += np.bincount(chosen[at:at + PUT], minlength=len(times))
        order = np.argsort(-np.bincount(flat, np.repeat(times, runs), len(parts)), kind="stable")
        place = np.empty(len(parts), np.uint32)
        place[order] = np.arange(len(parts), dtype=np.uint32)
        names = list(parts)
        parts.clear()
        flat, offsets = place[flat], np.concatenate([[0], np.cumsum(runs)])
        sequence, upto, done = np.empty(times @ runs, np.uint32), np.zeros(len(borders), np.int64), 0
        for at in range(0, len(chosen), PUT):
            some, ends = _gathered(flat, offsets, chosen[at:at + PUT])
            sequence[done:done + len(some)] = some
            inside = (borders > at) & (borders <= at + PUT)
            upto[inside] = done + ends[borders[inside] - at - 1]
            done += len(some)
        sizes = np.diff(upto, prepend=0).astype(np.int32)
        packed = _packed(pa.RecordBatch.from_arrays([
            pa.array([[names[i] for i in order]], pa.list_(pa.string())),
            pa.array([self.keys], pa.list_(key_type)),
            pa.array([self.hashes], pa.list_(pa.int64())),
            pa.array([sizes], pa.list_(pa.int32())),
            pa.array([_squeezed(sequence)], pa.binary()),
        ], names=["parts", "keys", "hashes", "sizes", "numbers"]))
        return pa.RecordBatch.from_arrays(
            [pa.array([number], pa.int64()), pa.array([packed], pa.binary())],
            names=["block", "packed"])


def _gathered(values: np.ndarray, offsets: np.ndarray, chosen: np.ndarray):
    """The runs values[offsets[i]:offsets[i + 1]] for each i of `chosen`, one after the other, and
    where each ends."""
    lengths = np.diff(offsets)[chosen]
    ends = np.cumsum(lengths)
    first = np.repeat(offsets[:-1][chosen] - (ends - lengths), lengths)
    return values[first + np.arange(len(first))], ends


def _counts(sizes, ends: np.ndarray) -> np.ndarray:
    """From the number of runs of each text and their ends: the number of values of each text."""
    upto = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])]
    return np.diff(upto)


def blocks_of(texts: DataFrame, key: str, text: str, pieces: Pieces) -> DataFrame:
    """One row per block; `hashes` are those of the texts, as a decoded text should have them."""
    plain = F.coalesce(F.replace(F.col(f"`{text}`"), F.lit(BLANK), F.lit(" ")), F.lit(""))
    prefix = BLANK if pieces.prefix else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, cut = _word_finder(prefix), _part_finder(pieces)
        number, block = TaskContext.get().partitionId() << 32, _Block()
        for batch in batches:
            key_type = batch.schema.field(0).type
            for at in range(batch.num_rows):
                value = batch.column(2)[at].as_py()
                if block.texts and block.size + len(value) > BLOCK:
                    yield block.row(number, cut, key_type, prefix)
                    number, block = number + 1, _Block()
                block.add(batch.column(0)[at].as_py(), batch.column(1)[at].as_py(), find(value),
                          len(value))
        if block.texts:
            yield block.row(number, cut, key_type, prefix)

    return texts.select(F.col(f"`{key}`").alias("key"), F.xxhash64(plain).alias("hash"),
                        plain.alias("text")).mapInArrow(
        giving_back(run), "block bigint, packed binary")


def _parts(batches: Iterator[pa.RecordBatch], above: int):
    """Of each block: its number, and the places and words of its parts of more than `above`
    characters, some at a time."""
    for batch in batches:
        for number, packed in zip(*batch.columns, strict=True):
            words = _unpacked(packed, PARTS)[0].values
            places = np.flatnonzero(pc.utf8_length(words).to_numpy() > above).astype(np.int32)
            for at in range(0, len(places), SENT):
                some = pa.array(places[at:at + SENT])
                yield pa.array(np.full(len(some), number.as_py())), some, words.take(some)


def parts_of(blocks: DataFrame) -> DataFrame:
    """`block`, `place` and `word` of each part."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in _parts(batches, 0):
            yield pa.RecordBatch.from_arrays(list(columns), names=["block", "place", "word"])

    return blocks.mapInArrow(giving_back(run), "block bigint, place int, word string")


def _long_ids(batches: Iterator[pa.RecordBatch], model: str, prefix: bool, longest: int):
    import sentencepiece

    processor = sentencepiece.SentencePieceProcessor(model_file=model)
    for numbers, places, words in _parts(batches, longest):
        ids = [_library_ids(processor, word.as_py(), prefix) for word in words]
        yield pa.RecordBatch.from_arrays(
            [numbers, places, pa.array(ids, pa.list_(pa.int32()))],
            names=["block", "place", "ids"])


def answer_long(blocks: DataFrame, model: str) -> DataFrame:
    """The answers with the library's ids of all parts of more than `LATTICE` characters. They
    are put together where they are made, since each step in Python has workers of its own."""
    prefix, longest = read_model(model).prefix, LATTICE

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _answers(_long_ids(batches, model, prefix, longest))

    return blocks.mapInArrow(giving_back(run), _ANSWER)


_ANSWER = "own bigint, n_parts int, n_ids int, places binary, counts binary, ids binary"


def _answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Columns: block, place and ids of parts. Those of one block become one row, by place."""
    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= ANSWERED:
            yield _answer(held)
            held, rows = [], 0
    if rows:
        yield _answer(held)


def _answer(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    blocks, places, ids = (
        pa.concat_arrays(columns)
        for columns in zip(*(batch.columns for batch in batches), strict=True))
    blocks, places = blocks.to_numpy(), places.to_numpy()
    order = np.lexsort((places, blocks))
    offsets = ids.offsets.to_numpy().astype(np.int64)
    flat, ends = _gathered(ids.values.to_numpy(), offsets, order)
    blocks, places, upto = blocks[order], places[order], np.concatenate([[0], ends])
    starts = [0, *(np.flatnonzero(np.diff(blocks)) + 1), len(blocks)]
    found = [
        (blocks[a], b - a, upto[b] - upto[a], _squeezed(np.diff(places[a:b], prepend=0)),
         _squeezed(np.diff(upto[a:b + 1])), _squeezed(flat[upto[a]:upto[b]]))
        for a, b in itertools.pairwise(starts)]
    types = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
    names = ["own", "n_parts", "n_ids", "places", "counts", "ids"]
    return pa.RecordBatch.from_arrays(
        [pa.array(column, kind) for column, kind in zip(zip(*found, strict=True), types,
                                                        strict=True)], names=names)


def _collected(answers: list[dict]):
    """The ids of a block's parts, by place, and where those of each part begin."""
    lengths = np.zeros(sum(a["n_parts"] for a in answers), np.int64)
    runs = []
    for a in answers:
        places = np.cumsum(_restored(a["places"], a["n_parts"]), dtype=np.int64)
        counts = _restored(a["counts"], a["n_parts"]).astype(np.int64)
        lengths[places] = counts
        runs.append((places, counts, _restored(a["ids"], a["n_ids"])))
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    flat = np.zeros(offsets[-1], np.int32)
    for places, counts, ids in runs:
        first = np.repeat(offsets[places] - (np.cumsum(counts) - counts), counts)
        flat[first + np.arange(len(first))] = ids
    return flat, offsets


def _spelt_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Columns: packed blocks, and the answers for their parts."""
    for batch in batches:
        for packed, known in zip(*batch.columns, strict=True):
            keys, hashes, sizes, squeezed = _unpacked(packed, KEYS, HASHES, SIZES, NUMBERS)
            held = sizes.values.to_numpy().astype(np.int64)
            upto = np.concatenate([[0], np.cumsum(held)])
            planes = _planes(squeezed.as_buffer(), int(upto[-1]))
            flat, offsets = _collected(known.as_py() or [])
            start = 0
            while start < len(held):
                # As many texts as have `ANSWERED` parts together, and one at least.
                stop = max(start + 1, int(np.searchsorted(upto, upto[start] + ANSWERED, "right")) - 1)
                numbers = _numbers(planes[:, upto[start]:upto[stop]])
                ids, ends = _gathered(flat, offsets, numbers)
                counts = _counts(held[start:stop], ends)
                begins = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [keys.values.slice(start, stop - start), hashes.values.slice(start, stop - start),
                     pa.ListArray.from_arrays(begins, pa.array(ids))],
                    names=["key", "text_hash", "ids"])
                start = stop


def encode_texts(texts: DataFrame, key: str = "doc_id", text: str = "text",
                 model: str = MODEL) -> DataFrame:
    """Per row: the key, the `ids`, and `text_hash`, the `xxhash64` of the text with plain
    blanks (empty for NULL)."""
    pieces = read_model(model)
    kind = texts.schema[key].dataType.simpleString()
    # All uses read both columns of a block, which lets Spark use the exchange again.
    blocks = blocks_of(texts, key, text, pieces).repartition("block")
    # Dealt by part once: the distinct parts are taken from the rows they are joined back to. The
    # same columns and filters on both sides let Spark use this exchange again, too.
    dealt = parts_of(blocks).where((F.length("word") <= LATTICE) & F.col("block").isNotNull()
                                   ).repartition("word")
    distinct = dealt.groupBy("word").agg(F.min("block").alias("b"), F.min("place").alias("p")
                                         ).where("b IS NOT NULL AND p IS NOT NULL")
    ids = encode_words(distinct.select("word"), model)
    answers = dealt.join(ids, "word").select("block", "place", "ids").mapInArrow(
        giving_back(_answers), _ANSWER).union(answer_long(blocks, model))
    known = answers.groupBy("own").agg(
        F.collect_list(F.struct(*answers.columns[1:])).alias("known"))
    whole = blocks.join(known, F.col("block") == F.col("own"), "left").select("packed", "known")
    spelt = whole.mapInArrow(
        giving_back(_spelt_out), f"key {kind}, text_hash bigint, ids array<int>")
    return spelt.withColumnRenamed("key", key)


def _meanings(pieces: Pieces) -> Column:
    """What each id stands for, blanks put back. A byte on its own need not be a valid string."""
    runs = []
    numbered = enumerate(pieces.meaning)
    for single, run in itertools.groupby(numbered, lambda at: at[0] in pieces.byte_ids):
        texts = [bytes.fromhex(code) for _, code in run]
        runs.append(
            F.array(*[F.lit(byte).cast("string") for byte in texts]) if single else F.from_json(
                F.lit(json.dumps([t.decode().replace(BLANK, " ") for t in texts])), "array<string>"))
    return F.concat(*runs)


def decode(ids: str, model: str = MODEL) -> Column:
    """The text of ids: their bytes one after the other, blanks put back."""
    pieces = read_model(model)
    meaning = _meanings(pieces)
    whole = F.make_valid_utf8(
        F.array_join(F.transform(F.col(ids), lambda i: F.element_at(meaning, i + 1)), ""))
    if not pieces.prefix:
        return whole
    return _let(whole, lambda text: F.when(
        F.startswith(text, F.lit(" ")), F.substring(text, F.lit(2), F.length(text))).otherwise(text))


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = encode_texts(table(spark, sf_dir, "documents"))
    return encoded.select("doc_id", "ids", F.size("ids").alias("n_tokens"),
                          (F.xxhash64(decode("ids")) == F.col("text_hash")).alias("round_trip"))
