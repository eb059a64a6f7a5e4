"""Ranked search, language identification and the prefix trie against brute force, and odd rows."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from areaweave.llm import language_id, prefix_trie, ranked_search, work

SMALL = "/root/testdata/sf0.001"
LONG = "wörter und Zahlen 12 " * 500_000


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    work.visible(spark)


# --- ranked search ---------------------------------------------------------------------------


def search_terms(text):
    lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower)


def ranked(docs, items, k=10):
    """The contract, document by document."""
    words = [(key, Counter(search_terms(text))) for key, text in docs]
    words = [(key, count) for key, count in words if count]
    size, total = len(words), sum(sum(c.values()) for _, c in words)
    df = Counter(term for _, count in words for term in count)
    rows = []
    for item, text in items:
        asked = Counter(search_terms(text))
        found = []
        for key, count in words:
            m = 25 + 75 * sum(count.values()) * size // total
            score = sum(
                times * math.floor(1000 * math.log((2 * size + 2) / (2 * df[t] + 1)))
                * (10**9 * count[t] // (1000 * count[t] + 8 * m)) for t, times in asked.items()
                if t in count)
            if score > 0:
                found.append((-score, key is None, key or 0, key))
        rows += [(item, i, f[3], -f[0]) for i, f in enumerate(sorted(found)[:k], 1)]
    return sorted(rows, key=str)


def collected(df):
    return sorted(map(tuple, df.collect()), key=str)


def random_text(rng, words, most):
    return " ".join(rng.choice(words) for _ in range(rng.randrange(most)))


@pytest.mark.parametrize("block_terms", [500_000, 3])
def test_ranked_search_odd_rows(spark, block_terms):
    docs = [(1, "Apple pear"), (2, "apple-pear!"), (2, "apple pear"), (None, "apple pear"), (3, None),
            (4, ""), (5, "...\n"), (6, "äpfel Äpfel 12"), (7, "pear"), (8, LONG + " apple"),
            (9, "apple pear " * 30), (-1, "apple pear")]
    docs += [(100 + i, f"filler {i}") for i in range(30)]
    items = [(1, "apple APPLE pear"), (2, "äpfel 12"), (2, "äpfel 12"), (None, "pear"), (3, None),
             (4, ""), (5, "nowhere"), (6, "wörter apple")]
    table = spark.createDataFrame(
        [(k, t, 1, "x", 0) for k, t in docs],
        "doc_id LONG, text STRING, rank INT, score STRING, item_id INT").repartition(5)
    asked = spark.createDataFrame([(k, t, 1) for k, t in items], "item_id LONG, text STRING, doc_id INT")
    found = ranked_search.ranked_search(table, asked, block_terms=block_terms)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert collected(found) == ranked(docs, items)


def test_ranked_search_of_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id LONG, text STRING")
    items = spark.createDataFrame([(1, "a")], "item_id LONG, text STRING")
    assert ranked_search.ranked_search(docs, items).collect() == []
    some = spark.createDataFrame([(1, "a")], "doc_id LONG, text STRING")
    assert ranked_search.ranked_search(some, items.limit(0)).collect() == []


@pytest.mark.parametrize("seed", range(6))
def test_bounds_over_shards(monkeypatch, seed):
    """Small shards, lists read two postings at a time, many ties."""
    monkeypatch.setattr(ranked_search, "SHARD_POSTINGS", [20, 1 << 20][seed % 2])
    monkeypatch.setattr(ranked_search, "SHARD_CELLS", [1 << 26, 60][seed % 2])
    monkeypatch.setattr(ranked_search, "FIRST_READ", 2)
    rng = random.Random(seed)
    words = [f"w{int(rng.paretovariate(0.6))}" for _ in range(60)]
    docs = [(i, random_text(rng, words, 12)) for i in range(300)]
    items = [(i, random_text(rng, words, 15)) for i in range(20)]
    (block,) = ranked_search.item_blocks(iter(items), 10**6)
    rows = pa.RecordBatch.from_pydict(
        {"key": pa.array([k for k, _ in docs], pa.int64()), "text": [t for _, t in docs]})
    counted = list(ranked_search._count(block.numbers)(iter([rows.slice(0, 90), rows.slice(90)])))
    counted = [b.filter(pa.compute.greater(b.column(1), 0)) for b in counted]
    sizes = np.concatenate([b.column(1).to_numpy() for b in counted])
    df = np.bincount(np.concatenate([b.column(2).flatten().to_numpy() for b in counted]),
                     minlength=len(block.numbers))
    weights = np.array([math.floor(1000 * math.log((2 * len(sizes) + 2) / (2 * d + 1))) for d in df])
    search = ranked_search._search(block.items, weights, len(sizes), int(sizes.sum()), 5)
    found = [(r["item_key"], r["key"], r["score"]) for b in search(iter(counted)) for r in b.to_pylist()]
    assert sorted(found) == sorted((i, d, s) for i, _, d, s in ranked(docs, items, 5))


def test_long_texts_are_cut_between_terms(monkeypatch):
    monkeypatch.setattr(ranked_search, "PIECE", 10)
    for text in ("aa bb cc dd ee ff gg", "a" * 35 + " b " + "c" * 12, "ÄÄÄÄÄ ÄÄÄÄÄÄ ä", "", "   "):
        words = [w.decode() for part in ranked_search.term_lists(text.encode()) for w in part]
        assert words == search_terms(text)


# --- language identification -------------------------------------------------------------------


LETTERS = tuple(map(ord, "abcdefghijklmnopqrstuvwxyzäé"))


def plain_ngrams(text):
    """N-grams of letters within words, by plain strings."""
    found = Counter()
    for word in "".join(c.lower()[0] if c.isalpha() else " " for c in text).split():
        found.update(word)
        found.update((f" {word} "[i:i + 2]) for i in range(len(word) + 1))
        found.update((f" {word} "[i:i + 3]) for i in range(len(word)))
    return found


@pytest.mark.parametrize("piece", [1, 2, 3, 7, 1 << 18])
@pytest.mark.parametrize("text", ["a", "ab c", "Ab,ÄB  éab1b\n", "日本語 ab", "x" * 40, "", "12 -"])
def test_ngrams_piece_by_piece(monkeypatch, piece, text):
    monkeypatch.setattr(language_id, "PIECE", piece)
    symbols = language_id._symbols(LETTERS)
    parts = list(language_id.pieces(text, symbols))
    codes = Counter(c for found, _ in parts for c in found.tolist())

    def code(gram):
        number = 0
        for char in gram:
            number = number * language_id.BASE + int(symbols[ord(char)])
        return number + sum(language_id.BASE ** n for n in range(1, len(gram)))

    expected = Counter()
    for gram, n in plain_ngrams(text).items():
        expected[code(gram)] += n
    assert codes == expected
    assert any(some for _, some in parts) == any(c.isalpha() for c in text)


def test_prediction_by_plain_cosines():
    rng = random.Random(3)
    texts = [random_text(rng, ["abba", "bald", "äcker", "café", "x"], 30) + " a" for _ in range(40)]
    grams = sorted({g for t in texts for g in plain_ngrams(t)})[:60]
    symbols = language_id._symbols(LETTERS)

    def code(gram):
        number = 0
        for char in gram:
            number = number * language_id.BASE + int(symbols[ord(char)])
        return number + sum(language_id.BASE ** n for n in range(1, len(gram)))

    grams.sort(key=code)
    idf = np.array([1 + rng.random() for _ in grams])

    def vector(text):
        count = plain_ngrams(text)
        raw = [(1 + math.log(count[g])) * w if count[g] else 0.0 for g, w in zip(grams, idf, strict=True)]
        size = math.sqrt(sum(x * x for x in raw))
        return [x / size if size else 0.0 for x in raw]

    centres = np.array([vector(t) for t in texts[:4]])
    model = language_id.Model(LETTERS, np.array([code(g) for g in grams]), idf, ("p", "q"),
                              np.array([0, 0, 1, 1]), centres, np.array([0.9, 0.1, 0.9, 0.1]), 1)
    names, scores, rejected = language_id.predict(texts, model, model.table())
    for text, name, score, out in zip(texts, names, scores, rejected, strict=True):
        cosines = [sum(a * b for a, b in zip(vector(text), c, strict=True)) for c in centres]
        best = max(range(4), key=lambda i: cosines[i])
        assert math.isclose(score, min(1, cosines[best]), abs_tol=1e-9)
        near = [c for c in cosines if math.isclose(c, cosines[best], abs_tol=1e-9)]
        if len(near) == 1:
            assert name == ("p", "p", "q", "q")[best]
            assert out == (cosines[best] < model.near[best])


def test_clusters_find_groups():
    rng = np.random.default_rng(0)
    middles = np.eye(3, 20)
    rows = language_id._unit(np.repeat(middles, 30, axis=0) + 0.05 * rng.normal(size=(90, 20)))
    centres, own = language_id.cluster(rows, 3)
    assert len(centres) == 3 and all(len(set(own[i:i + 30])) == 1 for i in (0, 30, 60))
    assert len(language_id.cluster(np.repeat(rows[:1], 5, axis=0), 4)[0]) == 1
    noisy = np.concatenate([rows, language_id._unit(rng.normal(size=(1, 20)))])
    assert len(language_id.cluster(noisy, 4)[0]) == 3


def test_held_out_languages(spark):
    found = language_id.op11_language_id(spark, SMALL).alias("f").join(
        spark.read.parquet(f"{SMALL}/documents.parquet").alias("d"), "doc_id").where("held_out")
    rows = found.select("lang", "lang_pred").collect()
    assert len(rows) > 30 and sum(r.lang == r.lang_pred for r in rows) >= 0.97 * len(rows)


def test_language_odd_rows(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "lang")
    model = language_id.learn(docs, "doc_id", "text", "lang")
    rows = [(1, None), (2, ""), (3, "12 -- !"), (4, "the this that"), (4, "the this that"),
            (None, "der die das"), (5, "Это другой язык"), (6, "die der und " * 800_000), (7, "日")]
    odd = spark.createDataFrame([(k, t, "a", 5) for k, t in rows],
                                "doc_id LONG, text STRING, score STRING, result INT")
    found = language_id.identify(odd, model)
    assert found.columns == ["doc_id", "text", "result", "lang_pred", "score", "rejected"]
    by_text = defaultdict(set)
    for r in found.collect():
        assert 0 <= r.score <= 1 and r.result == 5
        by_text[r.text].add((r.lang_pred, r.rejected))
    assert all(by_text[t] == {("und", True)} for t in (None, "", "12 -- !"))
    assert {n for n, _ in by_text["the this that"]} == {"en"}
    assert {n for n, _ in by_text["der die das"]} == {"de"}
    assert {n for n, _ in by_text["die der und " * 800_000]} == {"de"}
    for other in ("Это другой язык", "日"):
        assert {out for _, out in by_text[other]} == {True}
        assert {n for n, _ in by_text[other]} <= {"de", "en", "es", "fr"}


def test_nothing_to_learn(spark):
    rows = spark.createDataFrame([(1, "a", None), (2, None, "en"), (3, "12", "en")],
                                 "doc_id LONG, text STRING, lang STRING")
    for docs in (rows, rows.limit(0)):
        model = language_id.learn(docs, "doc_id", "text", "lang")
        assert model is None
        assert {r.lang_pred for r in language_id.identify(docs, model).collect()} <= {"und"}


def test_copies_and_order_do_not_change_the_model(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "lang")
    models = [language_id.learn(d, "doc_id", "text", "lang", sample=20)
              for d in (docs, docs.orderBy(F.rand(1)).repartition(7))]
    assert models[0].letters == models[1].letters
    assert (models[0].codes == models[1].codes).all()
    assert np.allclose(models[0].centroids, models[1].centroids)


# --- prefix trie ----------------------------------------------------------------------------------


def plain_trie(sequences):
    """sequences: conv -> list of (role, text)."""
    members, ends = defaultdict(list), defaultdict(list)
    for conv, turns in sorted(sequences.items()):
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(conv)
        ends[tuple(turns)].append(conv)
    children = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for path, convs in members.items():
        own = (len(convs) - 1) * len(path[-1][1].encode()) if path else 0
        for d in range(len(path) + 1):
            leaves[path[:d]] += path not in children
            saved[path[:d]] += own
    return sorted((
        convs[0], len(p), members[p[:-1]][0] if p else None, len(convs), children[p], leaves[p],
        saved[p], hashlib.sha256(",".join(map(str, ends[p])).encode()).hexdigest())
        for p, convs in members.items())


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
           "ends_sha256"]
SCHEMA = "conv_id LONG, turn LONG, role STRING, text STRING, depth INT, ids STRING, mark INT"


def nodes(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()))


@pytest.mark.parametrize("shard_turns,fan", [(1 << 19, 64), (60, 3), (9, 2)])
def test_trie_over_ranges(spark, monkeypatch, shard_turns, fan):
    """A third of the conversations are copies, another third share their first turns."""
    monkeypatch.setattr(prefix_trie, "FAN", fan)
    rng = random.Random(fan)
    talks = {}
    for conv in range(-5, 115):
        if conv % 3 == 0:
            turns = [("u", "hello"), ("a", "hi")]
        elif conv % 3 == 1:
            turns = [("u", "hello")] + [("a", rng.choice("xyz")) for _ in range(rng.randrange(4))]
        else:
            turns = [(rng.choice("ua"), rng.choice(["é", "", "long text", "z"]))
                     for _ in range(rng.randrange(1, 6))]
        talks[conv] = turns
    talks[500] = [("u", "hello")] + [("a", str(i % 7)) for i in range(60)]
    rows = [(c, i, r, t, 1, "x", 0) for c, turns in talks.items() for i, (r, t) in enumerate(turns)]
    rng.shuffle(rows)
    encoded = prefix_trie.encoded(spark.createDataFrame(rows, SCHEMA))
    assert nodes(prefix_trie.prefix_trie(encoded, shard_turns)) == plain_trie(talks)


def test_trie_odd_rows(spark):
    rows = [(1, 0, "u", "a"), (1, 1, None, None), (2, None, "u", "a"), (2, 0, None, ""),
            (None, 0, "u", "a"), (3, 0, "u", "a"), (3, 0, "u", "a"), (4, 0, "ua", ""), (5, 0, "u", "a")]
    table = spark.createDataFrame([(*r, 1, "x", 0) for r in rows], SCHEMA)
    a, none = ("u", "a"), ("", "")
    talks = {1: [a, none], 2: [a, none], 3: [a, a], 4: [("ua", "")], 5: [a]}
    assert nodes(prefix_trie.conversation_trie(table)) == plain_trie(talks)
    assert prefix_trie.conversation_trie(table.limit(0)).collect() == []
    long = spark.createDataFrame([(1, 0, "u", LONG, 1, "x", 0), (2, 0, "u", LONG, 1, "x", 0)], SCHEMA)
    assert nodes(prefix_trie.conversation_trie(long)) == plain_trie({1: [("u", LONG)], 2: [("u", LONG)]})


def test_turnless_conversations(spark):
    """Conversation 7 takes its first turns from 5, which is not there, and has no more itself."""
    import zlib

    turns = {7: 1, 10: 3, 11: 9, 12: 2, 15: 2}
    rows = [(c, i, "u", f"{c}-{i % 2}", 1, "x", 0) for c, n in turns.items() for i in range(n)]
    talks = {}
    own = {c: [("u", f"{c}-{i % 2}") for i in range(n)] for c, n in turns.items()}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        talks[c] = own.get(c - c % 5, [])[:h] + own[c][h:]
    encoded = prefix_trie.encoded(spark.createDataFrame(rows, SCHEMA))
    assert nodes(prefix_trie.prefix_trie(prefix_trie.rebuilt(encoded))) == plain_trie(talks)


def test_medians_come_first():
    assert list(prefix_trie.medians_first(7)) == [3, 1, 5, 0, 2, 4, 6]
    tree = prefix_trie.TernaryTree()
    for i in prefix_trie.medians_first(1023):
        tree.insert([i], [1], [i])
    depth, at = Counter(), [(tree.same[0], 1)]
    for node, level in at:
        depth[level] += 1
        at += [(n, level + 1) for n in (tree.low[node], tree.high[node]) if n >= 0]
    assert max(depth) == 10 and sum(depth.values()) == 1023
