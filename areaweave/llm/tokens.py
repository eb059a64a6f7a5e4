"""Token counts: batch encoding in Arrow functions that return lengths only.

Texts are cut into units at places where the tokenizer cuts in any case, so the ids of a text are
those of its units one after the other. Units are taken in batches balanced by bytes, whatever
the number or length of the texts they come from; only units not seen shortly before are encoded.

Defined results: a NULL text counts as empty (0 bytes, 0 tokens), an empty table gives an empty
result, repeated rows and repeated or NULL keys come back as they are, one row per input row.
Extra columns are not read.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from areaweave.llm.work import table

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
BATCH_BYTES = 1 << 20
"""Text that is held as units at one time."""
CACHED_UNITS = 1_000_000
"""Units a Python worker remembers; memory only, results do not depend on it."""
LONG_UNIT = 4096
JOINED = 64
"""Units encoded as one text."""

# White space before a blank or a line break: the pre-tokenizer treats such a run as a whole.
_RUN = re.compile(r"\s[ \n]")
_UNITS = re.compile(r"\s*\S+|\s+\Z")
_LETTER_DIGIT = re.compile(r"(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])")
_MARK = "\0"
_BLANK = "Ġ"


@lru_cache(maxsize=4)
def load(path: str):
    # A task has one core: the library's own threads would take those of other tasks.
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@lru_cache(maxsize=4)
def cuts_at_blanks(path: str) -> bool:
    """Whether a text may be cut before white space that follows something else: true of the
    byte-level pre-tokenizer whose pattern takes white space only at the start of a piece,
    without a normalizer, if no special string holds white space or letters next to digits."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    step = spec.get("pre_tokenizer") or {}
    return bool(
        spec.get("normalizer") is None and step.get("type") == "ByteLevel"
        and step.get("use_regex") and not step.get("add_prefix_space")
        and not any(
            re.search(r"\s", t["content"]) or _LETTER_DIGIT.search(t["content"])
            or t["lstrip"] or t["rstrip"] or t["single_word"]
            for t in spec.get("added_tokens", [])))


def units(text: str) -> list[str]:
    """Pieces of the text whose ids, one after the other, are the ids of the text."""
    if _RUN.search(text):
        pieces = _UNITS.findall(text)
    elif _MARK in text:
        first, *rest = text.split(" ")
        pieces = [first, *[" " + piece for piece in rest]]
    else:
        pieces = text.replace(" ", _MARK + " ").replace("\n", _MARK + "\n").split(_MARK)
    if len(text) > LONG_UNIT and len(max(pieces, key=len, default="")) > LONG_UNIT:
        pieces = [p for piece in pieces
                  for p in (_LETTER_DIGIT.split(piece) if len(piece) > LONG_UNIT else [piece])]
    return pieces


@lru_cache(maxsize=4)
def starts_with_blank(path: str) -> np.ndarray:
    """By id: whether its token starts with a blank, which byte-level tokens show by a letter."""
    vocabulary = load(path).get_vocab(with_added_tokens=True)
    starts = np.zeros(max(vocabulary.values()) + 1, bool)
    starts[[number for token, number in vocabulary.items() if token.startswith(_BLANK)]] = True
    return starts


def encode_units(path: str, wanted: list[str]) -> Iterator[tuple[str, bytes]]:
    """Each unit with its ids. Units of a blank and a word are encoded many at a time: in their
    ids one after the other, a token that starts with a blank starts a unit."""
    alone, words = [], []
    for unit in wanted:
        is_word = unit[:1] == " " and not unit[1:2].isspace() and not unit[-1].isspace()
        (words if is_word and cuts_at_blanks(path) else alone).append(unit)
    parts = [words[first:first + JOINED] for first in range(0, len(words), JOINED)]
    # The fast form leaves out the places in the text, which nobody asks for.
    joined = load(path).encode_batch_fast(["".join(p) for p in parts], add_special_tokens=False)
    for part, ids in zip(parts, map(packed_ids, joined), strict=True):
        cuts = 4 * np.flatnonzero(starts_with_blank(path)[np.frombuffer(ids, np.uint32)])
        if len(cuts) == len(part):
            ends = cuts.tolist()
            yield from ((unit, ids[a:b]) for unit, a, b in zip(
                part, ends, [*ends[1:], len(ids)], strict=True))
        else:
            alone += part
    encoded = load(path).encode_batch_fast(alone, add_special_tokens=False)
    yield from zip(alone, map(packed_ids, encoded), strict=True)


class UnitEncoder:
    """Encodes units and keeps what `measure` makes of their ids, 4 bytes each."""

    def __init__(self, path: str, measure: Callable, limit: int = CACHED_UNITS):
        self.path, self.measure, self.limit = path, measure, limit
        self.kept: dict[str, object] = {}

    def units(self, text: str) -> list[str]:
        return units(text) if cuts_at_blanks(self.path) else [text]

    def look_up(self, pieces: list[str]) -> list:
        found = list(map(self.kept.get, pieces))
        if None not in found:
            return found
        at = [i for i, value in enumerate(found) if value is None]
        missing = list({pieces[i] for i in at})
        new = {unit: self.measure(ids) for unit, ids in encode_units(self.path, missing)}
        if len(self.kept) + len(new) > self.limit:
            self.kept.clear()
        self.kept.update(new)
        for i in at:
            found[i] = new[pieces[i]]
        return found


def packed_ids(encoding) -> bytes:
    """The ids as unsigned 32-bit numbers, lowest byte first."""
    ids = array("I", encoding.ids)
    return ids.tobytes()


def n_ids(ids: bytes) -> int:
    return len(ids) // 4


@lru_cache(maxsize=8)
def encoder(path: str, measure: Callable, limit: int = CACHED_UNITS) -> UnitEncoder:
    return UnitEncoder(path, measure, limit)


def balanced(texts: Iterator[str], cut: Callable[[str], list[str]], limit: int):
    """Lists of (text number, its units in order) with about `limit` characters each; a long
    text goes on in the next list."""
    held: list[tuple[int, list[str]]] = []
    size = 0
    for number, text in enumerate(texts):
        pieces = cut(text)
        if size + len(text) <= limit:
            held.append((number, pieces))
            size += len(text)
            continue
        start = 0
        for end, piece in enumerate(pieces, 1):
            size += len(piece)
            if size > limit:
                held.append((number, pieces[start:end]))
                yield held
                held, size, start = [], 0, end
        if start < len(pieces):
            held.append((number, pieces[start:]))
    if held:
        yield held


def _counts(batch: pa.RecordBatch, path: str) -> np.ndarray:
    encode = encoder(path, n_ids)
    texts = ((value.as_py() or "") for value in batch.column(1))
    totals = np.zeros(batch.num_rows, np.int64)
    for group in balanced(texts, encode.units, BATCH_BYTES):
        lengths = encode.look_up([piece for _, pieces in group for piece in pieces])
        sums = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
        ends = np.cumsum([len(pieces) for _, pieces in group])
        per_part = np.diff(sums[np.concatenate([[0], ends])])
        np.add.at(totals, [number for number, _ in group], per_part)
    return totals


def count_tokens(
    texts: DataFrame, key: str = "doc_id", text: str = "text",
    vocabulary: str = VOCABULARY, limit: int = 512,
) -> DataFrame:
    """Per row: the key, `n_bytes` of UTF-8, `n_tokens` as the tokenizer gives them without
    special tokens added, and `over_limit`. Map-only: no row is shuffled."""
    kind = texts.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(_counts(batch, vocabulary))],
                names=["key", "n_bytes", "n_tokens"])

    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint")
    counted = texts.select(F.col(key).alias("key"), F.col(text).alias("text"), size.alias("n")
                           ).mapInArrow(run, f"key {kind}, n_bytes bigint, n_tokens bigint")
    return counted.select(
        F.col("key").alias(key), "n_bytes", "n_tokens",
        (F.col("n_tokens") > limit).alias("over_limit"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"))
