"""Toxicity: a linear-chain conditional random field tags toxic words.

Labels are given per document, so training words get theirs in two steps. First, words and word
beginnings that stand in toxic texts far more often than in clean ones (by the log-likelihood
ratio, over different neighbours, so that copies of one text count once) become cues; a word of a
toxic text with a cue is labelled toxic. Then a chain with two states is fitted to sequences of
labelled words by gradient ascent. A text is scored by forward-backward over the whole text: the marginals of all its
words give the expected number of toxic words and the most certain one, which a logistic
curve, fitted to the document labels, turns into a score; words with a marginal of one half or
more are the offending spans.

Fitting uses at most `TRAIN_TOXIC` + `TRAIN_CLEAN` labelled texts, taken by the hash of their key,
of at most `TRAIN_CHARS` characters each and `TRAIN_ALL_CHARS` of one label, and learns from every
sequence of these; scoring reads every text whole, however long, in sequences of `LENGTH` words.
Of rows that repeat a key one text is learnt from, the one with the smallest hash; a text with
both labels is learnt as clean. The model does not depend on the order of rows.

Defined results: a NULL text is empty; a text without words scores as its lack of cues says,
near 0. Without labelled texts of both kinds the score is the share of toxic labels (0 without
labels). Repeated rows and repeated or NULL keys are scored each on its own. An empty table gives
an empty result. Extra columns are kept; output columns replace input columns of their names.
"""

import json
import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType, DoubleType, LongType, StructField, StructType,
)

from areaweave.llm.work import byte_slices, free_name, give_back, table

TRAIN_TOXIC = 3000
TRAIN_CLEAN = 6000
TRAIN_CHARS = 65_536
TRAIN_ALL_CHARS = 32_000_000
"""Characters of all texts of one label that the model is fitted to."""
CUE = 25.0
"""Log-likelihood ratio from which a word or beginning is a cue."""
LIFT = 20.0
"""How much more often than in clean texts a cue stands in toxic ones."""
BEGINNINGS = (3, 4, 5, 6)
LENGTH = 64
"""Words in a sequence; texts are learnt from, and gone through, in sequences of this length."""
STEPS = 100
FIT_ROWS = 2048
KEPT_WORDS = 300_000
GROUP_WORDS = 500_000
SLICE = 1 << 20
"""Bytes of text that are scored, or of the sample tagged, at one time."""
_WORD = re.compile(r"\w+")


def features(word: str) -> list[str]:
    word = word.lower()
    return ["=" + word, *(word[:n] for n in BEGINNINGS if len(word) >= n)]


def _ratio(toxic: int, clean: int, all_toxic: int, all_clean: int) -> float:
    share = (toxic + clean) / (all_toxic + all_clean)
    parts = ((toxic, all_toxic * share), (clean, all_clean * share))
    size = 2 * sum(n * np.log(n / expected) for n, expected in parts if n)
    return size if toxic / all_toxic > clean / all_clean else -size


def _middles(coded: list[np.ndarray], place: np.ndarray, many: int) -> np.ndarray:
    """How often each word stands between two others, equal neighbours counting once."""
    line = np.zeros(2 + sum(len(codes) + 2 for codes in coded), np.int32)
    at = 3
    for codes in coded:
        line[at:at + len(codes)] = place[codes]
        at += len(codes) + 2
    before, middle, after = line[:-2], line[1:-1], line[2:]
    order = np.lexsort((after, before, middle))
    new = np.ones(len(order), bool)
    new[1:] = False
    for side in (before, middle, after):
        side = side[order]
        new[1:] |= side[1:] != side[:-1]
    return np.bincount(middle[order[new]], minlength=many)


def cues(words: list[str], coded: list[np.ndarray], labels: list[int]) -> set[str]:
    """Words and beginnings that mark toxic texts. An occurrence counts by its neighbours.
    `coded`: each text as the numbers of its `words`."""
    number = {"": 0}
    place = np.array([number.setdefault(w.lower(), len(number)) for w in words], np.int32)
    counts, totals = [], []
    for wanted in (0, 1):
        times = _middles([codes for codes, label in zip(coded, labels, strict=True)
                          if label == wanted], place, len(number))
        count = Counter()
        for word, n in zip(number, times.tolist(), strict=True):
            if n and word:
                for f in features(word):
                    count[f] += n
        counts.append(count)
        totals.append(max(1, int(times[1:].sum())))
    return {f for f, n in counts[1].items()
            if n / totals[1] >= LIFT * counts[0][f] / totals[0]
            and _ratio(n, counts[0][f], totals[1], totals[0]) >= CUE}


def _ways(score: np.ndarray, there: np.ndarray, chain: np.ndarray, first: np.ndarray,
          last: np.ndarray) -> tuple:
    """Forward-backward over rows of words, `first` being the states before each row and `last`
    what the words after it say of its last state. Returns P(toxic) and the parts of it."""
    rows, length = score.shape
    emit = np.stack([np.zeros_like(score), score], axis=2)
    step = np.exp(chain)
    lift = np.exp(emit - emit.max(axis=2, keepdims=True))
    ahead = np.zeros((rows, length, 2))
    back = np.ones((rows, length, 2))
    now = first
    for t in range(length):
        new = (now @ step) * lift[:, t]
        new /= new.sum(axis=1, keepdims=True)
        now = np.where(there[:, t, None], new, now)
        ahead[:, t] = now
    later = last
    for t in range(length - 1, -1, -1):
        back[:, t] = later
        new = (later * lift[:, t]) @ step.T
        new /= new.sum(axis=1, keepdims=True)
        later = np.where(there[:, t, None], new, later)
    both = ahead * back
    both /= both.sum(axis=2, keepdims=True)
    return both[:, :, 1] * there, ahead, back, lift, step


def marginals(score: np.ndarray, there: np.ndarray, chain: np.ndarray) -> tuple:
    """Forward-backward over rows of words. `score`: how much each word speaks for toxic;
    `chain`[i, j]: from state i to j; the first word comes from state 0. Returns P(toxic) of each
    word and P(from i to j) of each step, 0 where no word is."""
    rows = len(score)
    toxic, ahead, back, lift, step = _ways(
        score, there, chain, np.tile([1.0, 0.0], (rows, 1)), np.ones((rows, 2)))
    before = np.concatenate([np.tile([1.0, 0.0], (rows, 1, 1)), ahead[:, :-1]], axis=1)
    moves = before[:, :, :, None] * step * (lift * back)[:, :, None, :]
    moves /= moves.sum(axis=(2, 3), keepdims=True)
    return toxic, moves * there[:, :, None, None]


def _products(score: np.ndarray, there: np.ndarray, chain: np.ndarray) -> np.ndarray:
    """What each row of words makes of the states before it: the product of its steps, scaled."""
    step = np.exp(chain)
    emit = np.stack([np.zeros_like(score), score], axis=2)
    lift = np.exp(emit - emit.max(axis=2, keepdims=True))
    now = np.tile(np.eye(2), (len(score), 1, 1))
    for t in range(score.shape[1]):
        new = (now @ step) * lift[:, None, t]
        new /= new.max(axis=(1, 2), keepdims=True)
        now = np.where(there[:, t, None, None], new, now)
    return now


def _borders(products: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The states before each sequence, and what comes after it says of its last state, along
    the sequences of each text."""
    first, last = np.tile([1.0, 0.0], (len(owner), 1)), np.ones((len(owner), 2))
    same = np.flatnonzero(owner[1:] == owner[:-1])
    for i in same.tolist():
        now = first[i] @ products[i]
        first[i + 1] = now / now.sum()
    for i in same[::-1].tolist():
        now = products[i + 1] @ last[i + 1]
        last[i] = now / now.sum()
    return first, last


def _lessons(split: Iterable[list[str]], labels: list[int]) -> tuple:
    """All sequences of the texts to learn from, a row each: the names of features, where words
    are and which are toxic, the cells and numbers of the words' features, and how often each
    sequence stands. Sequences of words without a feature differ by their length only, so each
    length of these is one row. Words are held as numbers, each text's as it is gone through."""
    number: dict[str, int] = defaultdict()
    number.default_factory = number.__len__
    coded = [np.fromiter(map(number.__getitem__, words), np.int32, len(words)) for words in split]
    words = list(number)
    number.clear()
    found = cues(words, coded, labels)
    marked = np.array([not found.isdisjoint(features(w)) for w in words], bool)
    seen = np.zeros(len(words), bool)
    for codes, label in zip(coded, labels, strict=True):
        if label:
            seen[codes] = True
    names = sorted({f for i in np.flatnonzero(seen & marked) for f in features(words[i])})
    place = {f: i for i, f in enumerate(names)}
    many, flat = np.zeros(len(words), np.int64), []
    for i, w in enumerate(words):
        known = [place[f] for f in features(w) if f in place]
        many[i] = len(known)
        flat += known
    del words
    sequences, toxic, featureless = [], [], Counter()
    for codes, label in zip(coded, labels, strict=True):
        told = many[codes] > 0
        for s in range(0, len(codes), LENGTH):
            part = codes[s:s + LENGTH]
            if told[s:s + LENGTH].any():
                sequences.append(part)
                toxic.append(bool(label))
            else:
                featureless[len(part)] += 1
    times = np.array([1] * len(sequences) + list(featureless.values()), float)
    lengths = np.array([len(part) for part in sequences] + list(featureless), np.int64)
    there = np.arange(LENGTH) < lengths[:, None]
    held = np.concatenate([np.zeros(0, np.int32), *sequences])
    truth = np.zeros(there.shape, bool)
    truth[:len(sequences)][there[:len(sequences)]] = marked[held]
    truth[:len(sequences)] &= np.array(toxic, bool)[:, None]
    cells = np.flatnonzero(there[:len(sequences)])[many[held] > 0]
    held = held[many[held] > 0]
    counts = many[held]
    first = (np.cumsum(many) - many)[held] - (np.cumsum(counts) - counts)
    which = np.array(flat, np.int64)[np.repeat(first, counts) + np.arange(counts.sum())]
    return names, there, truth, np.repeat(cells, counts), which, times


def _steps_of(truth: np.ndarray, there: np.ndarray, times: np.ndarray) -> np.ndarray:
    """The steps from i to j in all rows as labelled, some rows at once."""
    wanted = np.zeros((2, 2))
    for now in _some(np.arange(len(truth))):
        after = truth[now].astype(float)
        before = np.concatenate([np.zeros((len(now), 1)), after[:, :-1]], axis=1)
        moved = np.stack([np.stack([(1 - before) * (1 - after), (1 - before) * after], -1),
                          np.stack([before * (1 - after), before * after], -1)], -2)
        wanted += np.einsum("r,rtij->ij", times[now], moved * there[now][:, :, None, None])
    return wanted


def _expected(score: np.ndarray, there: np.ndarray, chain: np.ndarray, times: np.ndarray) -> tuple:
    """P(toxic) of each word, in place of its score, and the steps from i to j expected in all
    rows, each as often as `times` says. Some rows at once, so that memory does not grow with
    their number."""
    moves = np.zeros((2, 2))
    for i in range(0, len(score), FIT_ROWS):
        now = slice(i, i + FIT_ROWS)
        score[now], steps = marginals(score[now], there[now], chain)
        moves += np.einsum("r,rtij->ij", times[now], steps)
    return score, moves


def fit(texts: list[str], labels: list[int], shares: tuple[float, float]) -> dict:
    """The model of labelled texts. `shares`: of all clean and toxic labels, the part that
    `texts` holds, which the logistic curve makes up for."""
    names, there, truth, at, which, times = _lessons(map(_WORD.findall, texts), labels)
    rows = len(there)
    weight, bias, chain = np.zeros(len(names)), -8.0, np.zeros((2, 2))
    wanted = _steps_of(truth, there, times)
    size = np.full(len(names), 1e-8), 1e-8, np.full((2, 2), 1e-8)
    score = np.zeros((rows, LENGTH))
    for _ in range(STEPS if rows else 0):
        score.fill(bias)
        np.add.at(score.reshape(-1), at, weight[which])
        toxic, moves = _expected(score, there, chain, times)
        miss = np.subtract(truth, toxic, out=score)
        miss *= there
        miss *= times[:, None]
        slope = (np.bincount(which, miss.reshape(-1)[at], len(names)) - 0.05 * weight,
                 miss.reshape(-1).sum(), wanted - moves)
        size = tuple(s + g * g for s, g in zip(size, slope, strict=True))
        weight, bias, chain = (v + 0.7 * g / np.sqrt(s) for v, g, s in zip(
            (weight, bias, chain), slope, size, strict=True))
    del score, there, truth, at, which
    model = {"names": names, "weight": weight.tolist(), "bias": float(bias),
             "chain": chain.tolist(), "curve": [0.0, 0.0, -9.0]}
    kept: dict = {}
    inputs = np.array([_inputs(top, total) for group in _groups(texts)
                       for top, total, _ in _tag(group, model, kept)])
    model["curve"] = _curve(inputs.reshape(-1, 2), np.array(labels, float), shares)
    return model


def _groups(texts: list[str]) -> Iterator[list[list[str]]]:
    """The words of the texts, those of about `SLICE` characters at one time."""
    held, size = [], 0
    for text in texts:
        held.append(_WORD.findall(text))
        size += len(text)
        if size >= SLICE:
            yield held
            held, size = [], 0
    if held:
        yield held


def _inputs(top: float, total: float) -> tuple[float, float]:
    top = min(max(top, 1e-5), 1 - 1e-5)
    return float(np.log(top / (1 - top))), float(np.log1p(total))


def _curve(inputs: np.ndarray, labels: np.ndarray, shares: tuple[float, float]) -> list[float]:
    """Logistic regression by Newton steps, with rows weighted back to all labels."""
    x = np.column_stack([inputs, np.ones(len(inputs))])
    part = np.where(labels == 1, 1 / max(shares[1], 1e-9), 1 / max(shares[0], 1e-9))
    part *= len(labels) / part.sum()
    w = np.zeros(3)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (part * (labels - p)) - 0.5 * w
        bend = (x * (part * p * (1 - p))[:, None]).T @ x + 0.5 * np.eye(3)
        w = w + np.linalg.solve(bend, slope)
    return w.tolist()


def _word_score(word: str, weights: dict[str, float]) -> float:
    return sum(weights.get(f, 0.0) for f in features(word))


def _tag(split: list[list[str]], model: dict, kept: dict | None):
    """Per text: the highest marginal, the sum of marginals, and the numbers of the words with a
    marginal of one half or more."""
    weights = dict(zip(model["names"], model["weight"], strict=True))
    kept = {} if kept is None else kept
    chain = np.array(model["chain"])
    product, parts = _plain(model["bias"], tuple(map(tuple, model["chain"])))
    words = [w for text in split for w in text]
    new = set(words).difference(kept)
    if len(kept) + len(new) > KEPT_WORDS:
        kept.clear()
        new = set(words)
    kept.update((w, _word_score(w, weights)) for w in new)
    scores = np.fromiter(map(kept.__getitem__, words), float, len(words))
    counts = np.array([len(text) for text in split], np.int64)
    starts = np.concatenate([[0], np.cumsum(counts)])
    # The chain runs over whole texts, in sequences. Those of words that no feature speaks about
    # all look alike but for their length and their borders.
    lengths, firsts, owner = [], [], []
    for i, n in enumerate(counts):
        for s in range(0, int(n), LENGTH):
            firsts.append(starts[i] + s)
            lengths.append(min(LENGTH, int(n) - s))
            owner.append(i)
    firsts, lengths, owner = (np.array(v, np.int64) for v in (firsts, lengths, owner))
    top, total = np.zeros(len(split)), np.zeros(len(split))
    told = np.concatenate([[0], np.cumsum(scores != 0)])
    active = told[firsts + lengths] > told[firsts] if len(firsts) else np.zeros(0, bool)
    spots: list[list[int]] = [[] for _ in split]
    products = product[lengths]

    def held(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cells = firsts[rows][:, None] + np.arange(LENGTH)
        there = np.arange(LENGTH) < lengths[rows][:, None]
        score = np.where(there, scores[np.minimum(cells, len(scores) - 1)], 0) + model["bias"]
        return there, score

    def note(toxic: np.ndarray, rows: np.ndarray) -> None:
        np.maximum.at(top, owner[rows], toxic.max(axis=1))
        np.add.at(total, owner[rows], toxic.sum(axis=1))
        for r, t in zip(*np.nonzero(toxic >= 0.5), strict=True):
            text = owner[rows[r]]
            spots[text].append(int(firsts[rows[r]] + t - starts[text]))

    joined = np.zeros(len(owner), bool)
    if len(owner):
        joined[1:] |= owner[1:] == owner[:-1]
        joined[:-1] |= owner[1:] == owner[:-1]
    for rows in _some(np.flatnonzero(active & joined)):
        there, score = held(rows)
        products[rows] = _products(score, there, chain)
    first, last = _borders(products, owner)
    alone = ~active & ~joined
    single = parts[:, :, 0].sum(axis=2) / product[:, 0].sum(axis=1)[:, None]
    np.maximum.at(top, owner[alone], single.max(axis=1)[lengths[alone]])
    np.add.at(total, owner[alone], single.sum(axis=1)[lengths[alone]])
    for rows in _some(np.flatnonzero(~active & joined)):
        way = np.einsum("ri,rtij,rj->rt", first[rows], parts[lengths[rows]], last[rows])
        way /= np.einsum("ri,rij,rj->r", first[rows], product[lengths[rows]], last[rows])[:, None]
        note(way, rows)
    for rows in _some(np.flatnonzero(active)):
        there, score = held(rows)
        note(_ways(score, there, chain, first[rows], last[rows])[0], rows)
    return list(zip(top.tolist(), total.tolist(), spots, strict=True))


def _some(rows: np.ndarray) -> Iterator[np.ndarray]:
    for i in range(0, len(rows), FIT_ROWS):
        yield rows[i:i + FIT_ROWS]


@lru_cache(maxsize=4)
def _plain(bias: float, chain: tuple) -> tuple[np.ndarray, np.ndarray]:
    """Of a featureless sequence of each length: the product of its steps, and for each of its
    words the part of this that goes through toxic."""
    step = np.exp(np.array(chain)) * np.exp([0.0, bias])
    step /= np.abs(np.linalg.eigvals(step)).max()
    powers = [np.eye(2)]
    for _ in range(LENGTH):
        powers.append(powers[-1] @ step)
    parts = np.zeros((LENGTH + 1, LENGTH, 2, 2))
    for n in range(LENGTH + 1):
        for t in range(n):
            parts[n, t] = np.outer(powers[t + 1][:, 1], powers[n - 1 - t][1])
    return np.array(powers), parts


def _score(texts: list[str], model: str | dict, kept: dict | None = None
           ) -> list[tuple[float, list[dict]]]:
    """`kept`: scores of words met before, which a task passes on."""
    model = json.loads(model) if isinstance(model, str) else model
    if "constant" in model:
        return [(model["constant"], []) for _ in texts]
    out = []
    held: list[list[str]] = []
    size, first = 0, 0
    for i, text in enumerate(texts):
        held.append(_WORD.findall(text))
        size += len(held[-1])
        if size >= GROUP_WORDS or i + 1 == len(texts):
            for n, (top, total, spots) in enumerate(_tag(held, model, kept)):
                a, b = _inputs(top, total)
                x = model["curve"][0] * a + model["curve"][1] * b + model["curve"][2]
                out.append((float(1 / (1 + np.exp(-np.clip(x, -30, 30)))),
                            _spans(texts[first + n], spots)))
            held, size, first = [], 0, i + 1
    return out


def _spans(text: str, spots: list[int]) -> list[tuple[int, int]]:
    if not spots:
        return []
    wanted = set(spots)
    return [m.span() for i, m in enumerate(_WORD.finditer(text)) if i in wanted]


_RESULT = StructType([
    StructField("score", DoubleType()),
    StructField("spans", ArrayType(StructType([
        StructField("start", LongType()), StructField("end", LongType())])))])


def _scored(parts: Iterator[pa.Array], model: str) -> Iterator[pa.Array]:
    """Score and spans of each text. In slices, so that only their words are objects."""
    loaded, words = json.loads(model), {}
    kind = pa.struct([("score", pa.float64()), ("spans", pa.list_(
        pa.struct([("start", pa.int64()), ("end", pa.int64())])))])
    for part in parts:
        batch = pa.RecordBatch.from_arrays([part], names=["text"])
        done = []
        for some in byte_slices(batch, 0, SLICE):
            rows = _score([t or "" for t in some.column(0).to_pylist()], loaded, words)
            done.append(pa.array([{"score": score, "spans": [
                {"start": a, "end": b} for a, b in spans]} for score, spans in rows], kind))
        yield pa.concat_arrays(done) if done else pa.array([], kind)


def train(documents: DataFrame, labels: DataFrame, key: str, text: str, label: str) -> str:
    """Fit to labelled texts; returns the model as text, of a size bounded by the sample. The
    keys of the sample are chosen among the labels alone and then looked up in the documents;
    there are no more of them than the two limits, so they are broadcast."""
    known = labels.select(F.col(key).alias("key"), F.col(label).cast("int").alias("label")).where(
        "key IS NOT NULL AND label IN (0, 1)").groupBy("key").agg(F.max("label").alias("label"))
    many = {row["label"]: row["count"] for row in known.groupBy("label").count().collect()}
    if len(many) < 2:
        return json.dumps({"constant": float(many.get(1, 0) > 0)})
    limits = {0: TRAIN_CLEAN, 1: TRAIN_TOXIC}
    chosen = [known.where(F.col("label") == v).orderBy(F.xxhash64("key"), "key").limit(n)
              for v, n in limits.items()]
    # Of rows that repeat a key, the text with the smallest hash: whatever order they come in,
    # the model is the same. Then texts in the order of their keys' hashes, to a bounded length.
    sample = documents.select(F.col(key).alias("key"), F.col(text).alias("text")).where(
        (F.length("text") > 0) & (F.length("text") <= TRAIN_CHARS)
    ).join(F.broadcast(chosen[0].union(chosen[1])), "key").groupBy("key", "label").agg(
        F.min_by("text", F.struct(F.xxhash64("text"), F.length("text"))).alias("text"))
    upto = F.sum(F.length("text")).over(
        Window.partitionBy("label").orderBy(F.xxhash64("key"), "key"))
    bounded = sample.withColumn("upto", upto).where(F.col("upto") <= TRAIN_ALL_CHARS).drop("upto")
    shares = tuple(min(1.0, limits[v] / many[v]) for v in (0, 1))

    def learn(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # One row per text: copies teach nothing new; of two labels of one text, clean holds.
        rows = pd.concat(list(frames)).sort_values(["label", "text"]).drop_duplicates("text")
        texts, marks = rows["text"].tolist(), rows["label"].tolist()
        del rows
        if len(set(marks)) == 2:
            model = fit(texts, marks, shares)
        else:
            model = {"constant": float(many[1] / (many[0] + many[1]))}
        del texts, marks
        give_back()
        yield pd.DataFrame({"model": [json.dumps(model)]})

    found = bounded.coalesce(1).mapInPandas(learn, "model string").collect()
    return found[0]["model"] if found else json.dumps({"constant": 0.0})


def score_toxicity(documents: DataFrame, model: str, text: str = "text") -> DataFrame:
    """The rows of `documents` with `score` (0 to 1) and `spans`, the character places of the
    offending words. Map-only."""
    kept = [c for c in documents.columns if c == text or c.lower() not in ("score", "spans")]

    def run(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from _scored(parts, model)
        give_back()

    result = free_name(kept, "result")
    scored = documents.withColumn(result, F.arrow_udf(run, _RESULT)(F.col(f"`{text}`")))
    return scored.select(*[F.col(f"`{c}`") for c in kept],
                         F.col(result)["score"].alias("score"),
                         F.col(result)["spans"].alias("spans"))


def held_out(key: str):
    """True for a fifth of the keys, whose labels are never learnt."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 5 == 0, F.lit(False))


def learnt(documents: DataFrame, labels: DataFrame) -> str:
    return train(documents, labels.where(~held_out("doc_id")), "doc_id", "text", "toxic")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = learnt(docs, table(spark, sf_dir, "labels"))
    scored = score_toxicity(docs, model)
    return scored.select(
        "doc_id", held_out("doc_id").alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))
