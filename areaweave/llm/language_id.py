"""Language identification by the nearest of several centroids per language.

A text is a vector over character n-grams of one to three letters within words, word borders
included: 1 + ln(count) times the inverse document frequency, normalised to length one. Per language the vectors
of the learnt texts are clustered (spherical k-means); a text gets the language of the centroid
with the largest cosine. It is rejected where that cosine is below what nearly all learnt texts
of the cluster have.

Letters are numbered: the most frequent ones of the sample each for itself, the rest by blocks of
256 code points, so an n-gram is a number below 128 cubed and is looked up in one table, without
hashing. N-grams look back two letters only, so a text of any length is counted whole, piece by piece.

Learning takes at most `SAMPLE` texts of each of the `LANGUAGES` most frequent languages, chosen by a hash
of key and text; the letters, the n-grams, their frequencies and the vectors are worked out by tasks over that
sample, and what reaches the driver is bounded by `LETTERS`, `FEATURES`, `CLUSTERS` and
`LANGUAGES`. Scoring reads every text once and is map-only.

Defined results: a text that is NULL or has no letter is `und` with score 0, and so is every text
if nothing could be learnt. A text with letters but no known n-gram gets the most frequent learnt
language with score 0, rejected. Equal cosines go to the language, then the cluster, that sorts first. Rows that
repeat a key count as rows of their own; rows without a key are learnt from. Extra columns are kept.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

from areaweave.llm.work import byte_slices, free_name, stored, table

SAMPLE = 1000
LANGUAGES = 400
LETTERS = 95
BASE = 128
FEATURES = 1500
"""N-grams taken of each language: those most of its learnt texts have."""
CLUSTERS = 4
ROUNDS = 12
LEAST = 0.05
REJECTED = 0.01
"""Share of a cluster's own texts that its rejection distance leaves out."""
PIECE = 1 << 18
"""Code points counted at one time."""
UNKNOWN = "und"


@lru_cache(maxsize=1)
def _folded() -> np.ndarray:
    """Per code point: the small letter it stands for, 0 if it is no letter."""
    found = np.zeros(0x110000, np.uint32)
    for code in range(0x110000):
        char = chr(code)
        if char.isalpha():
            found[code] = ord(char.lower()[0])
    return found


@lru_cache(maxsize=2)
def _symbols(letters: tuple[int, ...]) -> np.ndarray:
    """Per code point: 0 for none, the letter's place from 1 on, or the number of its block."""
    folded = _folded()
    rest = BASE - 1 - LETTERS
    found = np.where(folded > 0, 1 + LETTERS + (folded >> 8) % rest, 0).astype(np.uint8)
    place = np.zeros(0x110000, np.uint8)
    place[list(letters)] = np.arange(1, len(letters) + 1)
    own = place[folded]
    return np.where(own > 0, own, found).astype(np.uint8)


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def ngrams(symbols: np.ndarray, start: int) -> np.ndarray:
    """Numbers of the n-grams that end at `start` or later: one letter, two with at least one
    letter, three with a letter in the middle. A 0 on each side is the border of the text."""
    s = symbols.astype(np.int32)
    one = s[start:]
    two = s[start - 1:-1] * BASE + one
    three = s[start - 2:-2] * (BASE * BASE) + two
    middle = s[start - 1:-1] > 0
    return np.concatenate([
        one[one > 0], BASE + two[two > 0], BASE + BASE * BASE + three[middle]])


N_CODES = BASE + BASE * BASE + BASE ** 3


def pieces(text: str, symbols: np.ndarray) -> Iterator[tuple[np.ndarray, bool]]:
    """The n-grams of a text, piece by piece, and whether the piece has a letter."""
    before = np.zeros(2, np.uint8)
    for at in range(0, len(text), PIECE):
        part = symbols[_codes(text[at:at + PIECE])]
        end = np.zeros(1 if at + PIECE >= len(text) else 0, np.uint8)
        yield ngrams(np.concatenate([before, part, end]), 2), bool(part.any())
        before = np.concatenate([before, part])[-2:]


@dataclass(frozen=True)
class Model:
    letters: tuple[int, ...]
    codes: np.ndarray
    """The n-grams known, in rising order."""
    idf: np.ndarray
    languages: tuple[str, ...]
    of: np.ndarray
    """Language of each centroid, by place."""
    centroids: np.ndarray
    near: np.ndarray
    """Cosine below which a centroid rejects."""
    usual: int
    """The language most learnt texts have."""

    def table(self) -> np.ndarray:
        places = np.full(N_CODES, len(self.codes), np.int32)
        places[self.codes] = np.arange(len(self.codes))
        return places


def _vectors(texts: list[str | None], symbols: np.ndarray, places: np.ndarray, idf: np.ndarray):
    """One normalised row per text, and whether it has a letter."""
    width = len(idf) + 1
    counts = np.zeros((len(texts), width))
    letter = np.zeros(len(texts), bool)
    for row, text in enumerate(texts):
        for found, any_letter in pieces(text or "", symbols):
            counts[row] += np.bincount(places[found], minlength=width)
            letter[row] |= any_letter
    counts = counts[:, :-1]
    some = counts > 0
    return _unit(np.where(some, 1 + np.log(np.where(some, counts, 1)), 0) * idf), letter


def _unit(rows: np.ndarray) -> np.ndarray:
    size = np.linalg.norm(rows, axis=-1, keepdims=True)
    return np.divide(rows, size, out=np.zeros_like(rows), where=size > 0)


def cluster(rows: np.ndarray, k: int, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means from seeds chosen farthest first: centroids, and each row's own. A
    cluster of less than `LEAST` of the rows is noise and dissolved."""
    seeds = [int(np.argmax(rows @ rows.mean(axis=0)))]
    nearest = rows @ rows[seeds[0]]
    while len(seeds) < k and nearest.min() < 1 - 1e-9:
        seeds.append(int(np.argmin(nearest)))
        nearest = np.maximum(nearest, rows @ rows[seeds[-1]])
    centroids = rows[seeds]
    own = np.argmax(rows @ centroids.T, axis=1)
    for _ in range(rounds):
        centroids = _unit(np.stack([
            rows[own == c].sum(axis=0) if (own == c).any() else centroids[c]
            for c in range(len(centroids))]))
        again = np.argmax(rows @ centroids.T, axis=1)
        if (again == own).all():
            break
        own = again
    size = np.bincount(own, minlength=len(centroids))
    centroids = centroids[size >= min(LEAST * len(rows), size.max())]
    return centroids, np.argmax(rows @ centroids.T, axis=1)


def _batches(step: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, 1, 4 * PIECE):
                yield from step(part)

    return run


def _letter_counts(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    folded, total = _folded(), np.zeros(0x110000, np.int64)
    for text in part.column(1):
        whole = text.as_py()
        for at in range(0, len(whole), PIECE):
            code, times = np.unique(folded[_codes(whole[at:at + PIECE])], return_counts=True)
            total[code] += times
    code = np.flatnonzero(total[1:]) + 1
    yield pa.RecordBatch.from_arrays(
        [pa.array(code), pa.array(total[code])], names=["code", "times"])


def _ngram_counts(letters: tuple[int, ...]):
    def run(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        symbols = _symbols(letters)
        for lang, text in zip(part.column(0), part.column(1), strict=True):
            found = [np.unique(codes) for codes, _ in pieces(text.as_py(), symbols)]
            codes = np.unique(np.concatenate(found))
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang.as_py()] * len(codes), pa.string()), pa.array(codes, pa.int32())],
                names=["lang", "code"])

    return run


def _sample_vectors(letters: tuple[int, ...], codes: np.ndarray, idf: np.ndarray):
    model = Model(letters, codes, idf, (), *[np.empty(0)] * 3, 0)

    def run(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        symbols, places = _symbols(letters), model.table()
        for start in range(0, part.num_rows, 64):
            some = part.slice(start, 64)
            rows, _ = _vectors(some.column(1).to_pylist(), symbols, places, idf)
            yield pa.RecordBatch.from_arrays(
                [some.column(0), pa.array([r.tobytes() for r in rows.astype(np.float32)])],
                names=["lang", "vector"])

    return run


def _centroids(clusters: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        vectors = np.stack([np.frombuffer(v, np.float32) for v in sorted(rows["vector"])])
        vectors = vectors.astype(np.float64)
        centres, own = cluster(vectors, clusters)
        cosine = (vectors * centres[own]).sum(axis=1)
        near = [float(np.quantile(cosine[own == c], REJECTED)) if (own == c).any() else 0.0
                for c in range(len(centres))]
        return pd.DataFrame({
            "lang": rows["lang"].iloc[0], "cluster": range(len(centres)), "near": near,
            "centre": [c.tobytes() for c in centres]})

    return run


def learn(docs: DataFrame, key: str, text: str, lang: str, sample: int = SAMPLE,
          features: int = FEATURES, clusters: int = CLUSTERS) -> Model | None:
    """Fit to the rows of `docs` that have a language and a letter; None without any."""
    rows = docs.select(F.col(f"`{lang}`").alias("lang"), F.col(f"`{text}`").alias("text"),
                       F.xxhash64(F.col(f"`{key}`"), F.col(f"`{text}`")).alias("mark")).where(
        F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    many = {r["lang"]: r["count"] for r in docs.select(F.col(f"`{lang}`").alias("lang")).where(
        "lang IS NOT NULL").groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(
        LANGUAGES).collect()}
    if not many:
        return None
    # Twice the wanted share by hash, so that few rows reach the exact cut.
    share = F.element_at(F.create_map(*[F.lit(x) for name, n in many.items()
                                        for x in (name, min(1.0, 2 * sample / n))]), F.col("lang"))
    drawn = rows.where(F.pmod("mark", F.lit(1 << 30)) < share * (1 << 30))
    order = Window.partitionBy("lang").orderBy(F.pmod("mark", F.lit(1 << 30)), "mark", "text")
    chosen = stored(drawn.withColumn("place", F.row_number().over(order)).where(
        F.col("place") <= sample).select("lang", "text"), "languages")
    counts = chosen.mapInArrow(_batches(_letter_counts), "code bigint, times bigint")
    letters = tuple(r.code for r in counts.groupBy("code").agg(F.sum("times").alias("times")).orderBy(
        F.desc("times"), "code").limit(LETTERS).collect())
    seen = stored(chosen.mapInArrow(_batches(_ngram_counts(letters)), "lang string, code int").groupBy(
        "lang", "code").agg(F.count(F.lit(1)).alias("texts")), "language-ngrams")
    best = Window.partitionBy("lang").orderBy(F.desc("texts"), "code")
    wanted = seen.withColumn("place", F.row_number().over(best)).where(
        F.col("place") <= features).select("code").distinct()
    known = seen.join(wanted, "code").groupBy("code").agg(F.sum("texts").alias("texts")).orderBy(
        "code").collect()
    total = chosen.count()
    if not known:
        return None
    codes = np.array([r.code for r in known])
    idf = np.array([math.log((1 + total) / (1 + r.texts)) + 1 for r in known])
    vectors = chosen.mapInArrow(
        _batches(_sample_vectors(letters, codes, idf)), "lang string, vector binary")
    found = vectors.groupBy("lang").applyInPandas(
        _centroids(clusters), "lang string, cluster int, near double, centre binary").orderBy(
        "lang", "cluster").collect()
    languages = tuple(sorted({r.lang for r in found}))
    usual = max(languages, key=lambda name: (many[name], name))
    return Model(letters, codes, idf, languages, np.array([languages.index(r.lang) for r in found]),
                 np.stack([np.frombuffer(r.centre, np.float64) for r in found]),
                 np.array([r.near for r in found]), languages.index(usual))


def predict(texts: list[str | None], model: Model, places: np.ndarray):
    """Language, cosine and rejection of each text."""
    rows, letter = _vectors(texts, _symbols(model.letters), places, model.idf)
    cosine = rows @ model.centroids.T
    best = np.argmax(cosine, axis=1)
    score = np.clip(cosine[np.arange(len(best)), best], 0, 1)
    found = np.where(score > 0, model.of[best], model.usual)
    return ([model.languages[f] if some else UNKNOWN for f, some in zip(found, letter, strict=True)],
            np.where(letter, score, 0.0), ~letter | (score < model.near[best]) | (score == 0))


_RESULT = StructType([StructField("lang_pred", StringType()), StructField("score", DoubleType()),
                      StructField("rejected", BooleanType())])


def identify(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """The rows of `docs` with `lang_pred`, `score` (0 to 1) and `rejected`. Map-only."""
    taken = [f.name for f in _RESULT]
    kept = [c for c in docs.columns if c == text or c.lower() not in taken]
    columns = [F.col(f"`{c}`") for c in kept]
    if model is None:
        return docs.select(*columns, F.lit(UNKNOWN).alias("lang_pred"),
                           F.lit(0.0).alias("score"), F.lit(True).alias("rejected"))

    def run(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        places = model.table()
        for part in parts:
            found = [predict(part.iloc[at:at + 128].tolist(), model, places)
                     for at in range(0, len(part), 128)]
            yield pd.DataFrame({
                "lang_pred": [name for names, _, _ in found for name in names],
                "score": np.concatenate([np.empty(0), *[s for _, s, _ in found]]),
                "rejected": np.concatenate([np.empty(0, bool), *[r for _, _, r in found]])})

    result = free_name(kept, "result")
    scored = docs.withColumn(result, F.pandas_udf(run, _RESULT)(F.col(f"`{text}`")))
    return scored.select(*columns, *[F.col(result)[name].alias(name) for name in taken])


def held_out(key: str) -> Column:
    """True for a quarter of the keys, whose languages are never learnt."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 4 == 2, F.lit(False))


def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = learn(docs.where(~held_out("doc_id")), "doc_id", "text", "lang")
    return identify(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score", "rejected")
