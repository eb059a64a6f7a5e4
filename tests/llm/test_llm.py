"""The operators against brute force, libraries and hand-made cases."""

import hashlib
import itertools
import random
import re
import tracemalloc
import zlib

import compare
import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from areaweave.llm import (
    embeddings, entries, html_text, neighbours, packing, pieces, simhash, substrings, tokens,
    toxicity, urls, work,
)
from areaweave.llm import components as component_rounds
from areaweave.llm.components import components

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    work.visible(spark)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet").collect()


def roots(n, links):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


@pytest.mark.parametrize("name", sorted(entries.ORACLE_SQL))
def test_sql(spark, name):
    con = compare.duck(SMALL)
    df = entries.QUERIES[name](spark, SMALL)
    assert compare.differences(df, con, entries.ORACLE_SQL[name]) == []
    con.close()


@pytest.mark.parametrize("task_edges", [1 << 18, 40])
def test_components(spark, monkeypatch, task_edges):
    monkeypatch.setattr(component_rounds, "TASK_EDGES", task_edges)
    rng = random.Random(1)
    links = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)]
    links += [(300 + i, 301 + i) for i in range(30)] + [(350, 340 + i) for i in range(30)] * 2
    rng.shuffle(links)
    root = roots(400, links)
    touched = {x for a, b in links if a != b for x in (a, b)}
    found = components(spark.createDataFrame(links, "a bigint, b bigint")).collect()
    assert len(found) == len(touched)
    assert {r.vertex: r.component for r in found} == {x: root[x] for x in touched}


def test_components_of_texts_and_of_nothing(spark):
    links = [("c", "b"), ("b", "d"), ("x", "x"), ("z", "y")]
    found = components(spark.createDataFrame(links, "a string, b string")).collect()
    assert sorted(map(tuple, found)) == [("b", "b"), ("c", "b"), ("d", "b"), ("y", "y"), ("z", "y")]
    assert components(spark.createDataFrame([], "a string, b string")).collect() == []


@pytest.mark.parametrize("seed", range(5))
def test_contraction_of_one_task(seed):
    rng = random.Random(seed)
    links = [(rng.randrange(-50, 150), rng.randrange(-50, 150)) for _ in range(40 * seed + 20)]
    root = roots(200, [(a + 50, b + 50) for a, b in links])
    a, b = component_rounds.contracted(*(np.array(c) for c in zip(*links, strict=True)))
    assert len(set(a.tolist())) == len(a)
    touched = {x for pair in links for x in pair}
    assert dict(zip(a.tolist(), b.tolist(), strict=True)) == {
        x: root[x + 50] - 50 for x in touched if root[x + 50] - 50 != x}


# --- 1 -------------------------------------------------------------------------------------


def test_embeddings_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 1, "x"), (2, [1.0, 0.0], 1, "x"), (2, [2.0, 0.01], 1, "x"),
            (3, [1.0, 0.0], 2, "x"), (4, [1.0, 0.0], None, "x"), (5, None, 1, "x"),
            (6, [0.0, 0.0], 1, "x"), (7, [nan, 1.0], 1, "x"), (8, [inf, 1.0], 1, "x"),
            (9, [None, 1.0], 1, "x"), (10, [], 1, "x"), (11, [1.0, 0.0, 0.0], 1, "x"),
            (None, [0.0, 1.0], 1, "x")]
    df = spark.createDataFrame(
        rows, "vec_id bigint, embedding array<float>, label int, n_links string")
    got = sorted(((r.vec_id, r.n_links, r.component_id) for r in
                  embeddings.embedding_groups(df).collect()), key=str)
    want = [(1, 2, 1), (2, 2, 1), (2, 2, 1)] + [(i, 0, i) for i in range(3, 12)]
    assert got == sorted([*want, (None, 0, None)], key=str)
    assert embeddings.embedding_groups(df.limit(0)).count() == 0


def test_embeddings_on_a_grid(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "CELL", 8)
    rng = np.random.default_rng(0)
    base = rng.normal(size=(300, 16))
    near = base[:150] + rng.normal(size=(150, 16)) * rng.choice([0.1, 0.2, 0.25], (150, 1))
    rows = np.concatenate([base, near]).astype(np.float32)
    cosine = embeddings.unit(rows.astype(float))
    linked = cosine @ cosine.T >= 0.98
    np.fill_diagonal(linked, False)
    df = spark.createDataFrame([(i, r.tolist(), 0) for i, r in enumerate(rows)],
                               "vec_id bigint, embedding array<float>, label int")
    root = roots(len(rows), np.argwhere(linked).tolist())
    found = {r.vec_id: (r.n_links, r.component_id)
             for r in embeddings.embedding_groups(df).collect()}
    assert found == {i: (int(linked[i].sum()), root[i]) for i in range(len(rows))}


# --- 2 -------------------------------------------------------------------------------------


def test_pieces_as_the_library(spark, docs, monkeypatch):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    rows = [(r.doc_id, r.text) for r in docs[:30]]
    rows += [(900, None), (901, ""), (902, " "), (903, "  a  b "), (904, "日本 😀\x00x\n\n y"),
             (905, "q" * 90 + " z"), (907, "a" * 62 + " " + "b" * 63),
             (908, " " * 100 + "x" + " " * 200), (909, "x1y2.z\n" * 20), (906, "▁▁ x"), (None, "hello"), (None, "hello")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id bigint, text string, ids int")
    monkeypatch.setattr(pieces, "BLOCK", 5000)
    found = pieces.encode_texts(df).withColumn("back", pieces.decode("ids")).withColumn(
        "same", F.xxhash64("back") == F.col("text_hash")).collect()
    expected = [(key, library.encode(text or "")) for key, text in rows]
    assert sorted(((r.doc_id, list(r.ids)) for r in found), key=repr) == sorted(expected, key=repr)
    for row in found:
        assert row.same
        assert row.back == library.decode(list(row.ids))
    assert pieces.encode_texts(df.limit(0)).count() == 0


def test_blocks_and_parts_are_exchanged_once(spark, docs, monkeypatch):
    """Blocks are not stored besides, and what returns to them is one row per block and task."""
    monkeypatch.setattr(pieces, "BLOCK", 5000)
    df = spark.createDataFrame([(r.doc_id, r.text) for r in docs], "doc_id bigint, text string")
    found = pieces.encode_texts(df)
    assert len(found.collect()) == len(docs)
    plan = found._jdf.queryExecution().executedPlan().toString()
    plan = plan[:plan.index("== Initial Plan ==")]
    assert "FileScan" not in plan
    blocks, words = (len(re.findall(rf"[+]- Exchange hashpartitioning\({c}#", plan))
                     for c in ("block", "word"))
    assert (blocks, words) == (1, 1)


def test_a_task_has_one_python_worker(spark):
    """Where rows of two kinds are answered, none goes from Python to Python."""
    found = pieces.encode_texts(spark.createDataFrame([(1, "a b")], "doc_id bigint, text string"))
    plan = found._jdf.queryExecution().sparkPlan().toString()
    assert "Union" in plan and not re.search(r"MapInArrow[^\n]*\n[ :+|-]*Union", plan)


def _most_held(run) -> int:
    """Bytes that `run` holds at most beside what was there before."""
    tracemalloc.start()
    try:
        run()
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def _block(texts: int, words: int):
    block, rng = pieces._Block(), random.Random(9)
    for key in range(texts):
        block.add(key, key, [f"w{rng.randrange(50)}" for _ in range(words)], 3 * words)
    return block


def test_blocks_are_made_in_slices(monkeypatch):
    cut = pieces._part_finder(pieces.read_model(pieces.MODEL))
    row = _block(40, 7).row(5, cut, pa.int64(), pieces.BLANK)
    empty = pieces._Block()
    empty.add(1, 1, [], 0)
    none = empty.row(5, cut, pa.int64(), pieces.BLANK)
    monkeypatch.setattr(pieces, "CUT", 3)
    monkeypatch.setattr(pieces, "PUT", 14)
    assert _block(40, 7).row(5, cut, pa.int64(), pieces.BLANK).equals(row)
    found = pieces._unpacked(none.column(1)[0], pieces.PARTS, pieces.SIZES)
    assert [v.as_py() for v in found] == [[], [0]]


def test_a_block_takes_little_memory():
    words = 1_000_000
    block = _block(1000, words // 1000)
    cut = pieces._part_finder(pieces.read_model(pieces.MODEL))
    assert _most_held(lambda: block.row(0, cut, pa.int64(), pieces.BLANK)) < 60 * words


def test_answers_are_one_row_per_block():
    batch = pa.RecordBatch.from_arrays([
        pa.array([7, 3, 7, 3], pa.int64()), pa.array([1, 0, 0, 900], pa.int32()),
        pa.array([[5], [70000, 2], [], [1]], pa.list_(pa.int32()))], names=["block", "place", "ids"])
    rows = [r for b in pieces._answers([batch.slice(0, 3), batch.slice(3)]) for r in b.to_pylist()]
    assert [(r["own"], r["n_parts"], r["n_ids"]) for r in rows] == [(3, 2, 3), (7, 2, 1)]
    flat, offsets = pieces._collected(rows[1:])
    assert (list(flat), list(offsets)) == ([5], [0, 0, 1])


@pytest.mark.parametrize("part", ["q" * 70, "x" + "a" * 80, "▁" * 70, "▁" * 70 + "a", "▁" + "q" * 70])
def test_long_parts(part):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    # A line break is in no piece, so what follows it is encoded for itself.
    text = "a\n" + part.replace("▁", " ")
    assert library.encode(text) == library.encode("a\n") + pieces._library_ids(library, part, True)


def test_pieces_are_their_own_encoding():
    """What the single pass over the edges rests on."""
    scores = {piece: score for piece, _, score in pieces.read_model(pieces.MODEL).usable}
    for piece in scores:
        symbols = list(piece)
        while len(symbols) > 1:
            ways = [(-scores[a + b], i) for i, (a, b) in enumerate(itertools.pairwise(symbols))
                    if a + b in scores]
            assert ways, piece
            at = min(ways)[1]
            symbols[at:at + 2] = [symbols[at] + symbols[at + 1]]


def test_viterbi(spark):
    table = [("a", 0, -1.0), ("b", 1, -1.5), ("ab", 2, -2.0), ("ba", 3, -2.2),
             ("aba", 4, -2.4), ("bb", 5, -9.0)]
    model = pieces.Pieces(tuple(table), ("",) * 6, (), 9, pieces.UNIGRAM, False)
    words = ["".join(w) for n in range(1, 5) for w in itertools.product("abc", repeat=n)]
    lattice = pieces.lattices(
        spark.createDataFrame([(w,) for w in words], "word string"),
        spark.createDataFrame(table, "piece string, id int, score double"), model)
    found = lattice.select("word", pieces.viterbi(
        F.col("edges"), F.length("word")).alias("ids")).collect()
    known = {p: (s, i) for p, i, s in table}

    def best(word):
        ways = [(best(word[:-n])[0] + s, best(word[:-n])[1] + [i])
                for n in range(1, len(word) + 1)
                for s, i in [known.get(word[-n:], (-19.0, 9))]
                if n == 1 or word[-n:] in known]
        return max(ways) if word else (0.0, [])

    assert {r.word: list(r.ids) for r in found} == {w: best(w)[1] for w in words}


# --- 3 -------------------------------------------------------------------------------------


def plain_fingerprint(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles] if words else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash(spark, docs):
    rows = [(r.doc_id, r.text) for r in docs]
    rows += [(900, None), (901, ""), (None, "x y z"), (902, "Un É\xa0b"), (903, "x  Y\nz"),
             (903, "x y z")]
    df = spark.createDataFrame([(*r, 0) for r in rows], "doc_id bigint, text string, point int")
    prints = [plain_fingerprint(t) for _, t in rows]
    root = roots(len(rows), [(i, j) for i in range(len(rows)) for j in range(i)
                             if (prints[i] ^ prints[j]).bit_count() <= 2])
    least = {}
    for (key, _), r in zip(rows, root, strict=True):
        if key is not None:
            least[r] = min(least.get(r, key), key)
    want = [(k, f"{p:016x}", least.get(r)) for (k, _), p, r in zip(rows, prints, root, strict=True)]
    got = [tuple(r) for r in simhash.simhash_groups(df).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert simhash.simhash_groups(df.limit(0)).count() == 0


@pytest.mark.parametrize("ball", [False, True])
def test_vantage_points_in_several_shards(spark, monkeypatch, ball):
    monkeypatch.setattr(simhash, "SHARD_POINTS", 200)
    monkeypatch.setattr(simhash, "LEAF", 32)
    rng = np.random.default_rng(2)
    points = np.full(800, 5, np.uint64) if ball else rng.integers(0, 2**64, 800, np.uint64)
    moved = points.copy()
    for _ in range(5 if ball else 2):
        moved ^= np.uint64(1) << rng.integers(0, 64, 800).astype(np.uint64)
    points = np.unique(np.concatenate([points, moved]))
    near = np.argwhere(simhash.distance(points[:, None], points[None, :]) <= 2)
    root = roots(len(points), near.tolist())
    df = spark.createDataFrame([(int(p),) for p in points.view(np.int64)], "point bigint")
    place = {int(p): i for i, p in enumerate(points.view(np.int64))}
    edges = [(place[r.a], place[r.b]) for r in simhash.near_points(df).collect()]
    assert roots(len(points), edges) == root


# --- 4 -------------------------------------------------------------------------------------


def test_marginals():
    rng = np.random.default_rng(0)
    score, chain = rng.normal(size=(2, 5)), rng.normal(size=(2, 2))
    there = np.ones((2, 5), bool)
    there[1, 3:] = False
    toxic, _ = toxicity.marginals(score, there, chain)
    for r in range(2):
        n = int(there[r].sum())
        weight = {y: np.exp(sum(score[r, t] * y[t] + chain[(0, *y)[t], y[t]] for t in range(n)))
                  for y in itertools.product((0, 1), repeat=n)}
        want = sum(w * np.array(y) for y, w in weight.items()) / sum(weight.values())
        assert np.allclose(toxic[r, :n], want)


def test_chain_crosses_sequences():
    model = {"names": ["=bad", "=poor"], "weight": [6.0, 2.5], "bias": -4.0,
             "chain": [[1.0, -1.0], [-1.0, 1.5]]}
    rng = random.Random(3)
    split = [[rng.choice(["tau"] * 9 + ["bad", "poor"]) for _ in range(n)]
             for n in (0, 1, 63, 64, 65, 128, 300, 20)]
    split += [["tau"] * n for n in (1, 64, 200)]
    split += [["tau"] * 130 + ["bad", "poor"] + ["tau"] * 130,
              ["tau"] * 61 + ["bad"] * 3 + ["poor", "poor"] + ["tau"] * 70]
    for words, (top, total, spots) in zip(split, toxicity._tag(split, model, None), strict=True):
        score = np.array([[{"bad": 6.0, "poor": 2.5}.get(w, 0) - 4.0 for w in words]])
        whole, _ = toxicity.marginals(score, score == score, np.array(model["chain"]))
        assert np.isclose(top, whole.max(initial=0)) and np.isclose(total, whole.sum())
        assert sorted(spots) == np.flatnonzero(whole[0] >= 0.5).tolist()


def test_toxicity_held_out(spark):
    found = toxicity.op4_toxicity(spark, "/root/testdata/sf0.01")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = found.join(labels, "doc_id").where("held_out").collect()
    right = [r.predicted == r.toxic for r in rows]
    assert sum(right) / len(right) > 0.95
    assert sum(r.predicted for r in rows if r.toxic) >= 0.8 * sum(r.toxic for r in rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_toxicity_odd_rows(spark):
    rows = [(1, None, 1), (2, "", 2), (None, "some text", 3), (3, "a " * 9000, 4)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, score int")
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    model = toxicity.learnt(df, none)
    assert [r.score for r in toxicity.score_toxicity(df, model).collect()] == [0.0] * 4
    few = spark.createDataFrame([(1, 1), (3, 0), (4, None), (None, 1)], "doc_id bigint, toxic int")
    model = toxicity.train(df, few, "doc_id", "text", "toxic")
    assert toxicity.score_toxicity(df, model).count() == 4


def test_toxic_spans():

    rng = random.Random(4)
    words = ["alpha", "beta", "gamma", "delta", "rho", "tau"]
    texts = [" ".join(rng.choice(words) for _ in range(30)) for _ in range(80)]
    labels = [i % 2 for i in range(80)]
    texts = [t.replace(" ", " badword ", 3) if y else t for t, y in zip(texts, labels, strict=True)]
    model = toxicity.json.dumps(toxicity.fit(texts, labels, (1.0, 1.0)))
    (hit, spans), (clean, none) = toxicity._score(["tau badwords rho", "tau rho tau"], model)
    assert hit > clean and spans == [(4, 12)] and none == []


def test_fit_and_scores_take_little_memory():
    rng = random.Random(5)
    words = [f"word{i}" for i in range(3000)]
    texts = [" ".join(["badword"] * (i % 2) + rng.choices(words, k=2000)) for i in range(400)]
    labels = [i % 2 for i in range(400)]
    assert _most_held(lambda: toxicity.fit(texts, labels, (1.0, 1.0))) < 32 * 2000 * 400
    model = toxicity.json.dumps(toxicity.fit(texts[:50], labels[:50], (1.0, 1.0)))
    part = pa.array([*texts, None])
    rows = []
    held = _most_held(lambda: rows.extend(toxicity._scored(iter([part]), model)))
    assert held < 40 * 2000 * 400
    assert [(r["score"], [(s["start"], s["end"]) for s in r["spans"]])
            for r in rows[0].to_pylist()] == toxicity._score([*texts, ""], model)


def test_packing_forgets_after_a_task(spark):
    docs = spark.createDataFrame([(1, "some words")], "doc_id bigint, text string").coalesce(1)
    whole = packing.token_pieces(docs).collect()
    assert packing.token_pieces(docs, cached_units=77, forget=True).collect() == whole


def test_clean_texts_are_learnt(spark):
    split = [["tau"] * 70, ["badge"] * 3, ["badword", "tau"] * 40]
    *_, times = toxicity._lessons(split, [0, 0, 1])
    assert times.sum() == 2 + 1 + 2
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{name}.parquet")
                    for name in ("documents", "labels"))
    model = toxicity.learnt(docs, labels)
    unseen = docs.join(labels.where(toxicity.held_out("doc_id")), "doc_id")
    rows = toxicity.score_toxicity(unseen, model).collect()
    toxic, clean = ([r for r in rows if r.toxic == v] for v in (1, 0))
    assert sum(r.score >= 0.5 for r in toxic) >= 0.9 * len(toxic)
    assert sum(r.score >= 0.5 for r in clean) <= 0.01 * len(clean)
    assert sum(len(r.spans) > 0 for r in clean) <= 0.03 * len(clean)


# --- 5 and 7 -------------------------------------------------------------------------------


def library_ids(text):
    return tokens.load(tokens.VOCABULARY).encode(text or "", add_special_tokens=False).ids


ODD_TEXTS = [None, "", " ", "  a  b ", "a\n\n b\t", "<|endoftext|> x<|endoftext|>", "I'll 's' 12ab",
             "日本語 テキスト", "x1" * 4000, "w " * 5000, "a\u3000b \x85c", "end  "]


def test_units():
    rng = random.Random(1)
    bits = [" ", "  ", "\n", "\t", "a", "The", "1", "42", "'s", "'", "!!", "<|endoftext|>", "é",
            "\u180e", "\u3000", "\x85", "\x1c", "日本", "😀", "ab12" * 1100, "\r\n", "\xa0"]
    assert tokens.cuts_at_blanks(tokens.VOCABULARY)
    for _ in range(500):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(0, 9)))
        cut = [i for unit in tokens.units(text) for i in library_ids(unit)]
        assert cut == library_ids(text), text


def test_units_joined(monkeypatch):
    monkeypatch.setattr(tokens, "JOINED", 7)
    rng = random.Random(2)
    bits = [" ", "\n", "\t", "a", "The", "42", "'s", "!!", "<|endoftext|>", "Ġ", "é", "\u180e",
            "\u3000", "\x85", "\x1c", "日本", "😀", "\xa0", "\0"]
    wanted = {"".join(rng.choice([[], [" "]])) + "".join(
        rng.choice(bits) for _ in range(rng.randint(0, 5))) for _ in range(2000)}
    units = sorted({unit for text in wanted for unit in tokens.units(text)})
    found = dict(tokens.encode_units(tokens.VOCABULARY, units))
    assert set(found) == set(units)
    for unit in units:
        assert np.frombuffer(found[unit], np.uint32).tolist() == library_ids(unit), unit


def test_token_counts(spark, docs, monkeypatch):
    rows = [(r.doc_id, r.text) for r in docs] + [(900 + i, t) for i, t in enumerate(ODD_TEXTS)]
    df = spark.createDataFrame([(*r, 0) for r in rows], "doc_id bigint, text string, n_bytes int")
    found = {r.doc_id: r for r in tokens.count_tokens(df).collect()}
    for key, text in rows:
        n = len(library_ids(text))
        assert tuple(found[key]) == (key, len((text or "").encode()), n, n > 512)
    assert tokens.count_tokens(df.limit(0)).count() == 0


def test_packing(spark, docs, monkeypatch):
    monkeypatch.setattr(packing, "RANKED_ROWS", 7)
    rows = [(r.doc_id, r.text) for r in docs] + [(900 + i, t) for i, t in enumerate(ODD_TEXTS)]
    df = spark.createDataFrame([(*r, 0) for r in rows], "doc_id bigint, text string, length int")
    found = packing.pack_documents(df).collect()
    by_key, bins = {}, {}
    for r in found:
        by_key.setdefault(r.doc_id, []).append(r)
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for key, text in rows:
        ids = np.array([*library_ids(text), 2], "<u4")
        at = 0
        for n, r in enumerate(sorted(by_key[key], key=lambda r: r.piece)):
            assert (r.piece, r.start) == (n, at) and (n == 0 or r.length == 1024)
            assert r.ids_crc32 == zlib.crc32(ids[at:at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    total = sum(r.length for r in found)
    for held in bins.values():
        ends = [0, *itertools.accumulate(n for _, n in sorted(held))]
        assert [o for o, _ in sorted(held)] == ends[:-1] and ends[-1] <= 1024
    assert len(bins) <= 1.03 * -(-total // 1024) + 1
    empty = packing.pack_documents(df.limit(0))
    assert empty.count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_plan(seed):
    rng = np.random.default_rng(seed)
    lengths = [rng.integers(1, 1025, 3000), rng.integers(300, 700, 3000),
               rng.choice([1024, 700, 330, 20], 900), rng.integers(1, 60, 50)][seed]
    counts = np.bincount(lengths, minlength=1025)
    kinds = packing.plan_bins(counts)
    held = np.zeros(1025, int)
    for kind in kinds:
        assert kind.count > 0 and 0 <= kind.room == 1024 - sum(n * m for n, m in kind.items)
        for length, many in kind.items:
            held[length] += many * kind.count
    assert (held == counts).all()


# --- 6 -------------------------------------------------------------------------------------


def test_neighbours(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "SHARD", 150)
    rng = np.random.default_rng(3)
    rows = rng.normal(size=(400, 24)).astype(np.float32)
    rows[100:140] = rows[100]
    listed = [(i, r.tolist()) for i, r in enumerate(rows)]
    listed += [(500, None), (550, [0.0] * 24), (600, [float("nan")] * 24), (None, [1.0] * 24),
               (650, [1.0, 2.0]), (0, rows[0].tolist())]
    df = spark.createDataFrame([(*r, 0) for r in listed],
                               "vec_id bigint, embedding array<float>, rank int")
    found = neighbours.nearest_neighbours(df).collect()
    unit = neighbours.unit(rows.astype(float))
    right = 0
    for q in range(0, 400, 50):
        score = unit @ unit[q]
        score[q] = -2
        want = np.lexsort((np.arange(400), -score.round(12)))[:5]
        got = sorted((r["rank"], r.vec_id, r.score) for r in found if r.query_id == q)
        assert [g[0] for g in got] == [1, 2, 3, 4, 5]
        assert all(abs(score[v] - s) < 1e-12 for _, v, s in got)
        right += len(set(want) & {g[1] for g in got})
    assert right >= 0.9 * 40
    assert {r.query_id for r in found} == set(range(0, 400, 50))
    assert neighbours.nearest_neighbours(df.limit(0)).count() == 0


def test_neighbours_shards(spark):
    """Twelve times the vectors are not twelve times the shards that every query visits."""
    sizes = spark.createDataFrame(
        [(64, 4096), (64, 51_282), (64, 615_384), (64, 15_000_000), (4096, 20_000), (2, 1)],
        "length int, rows bigint")
    shards = {(r[0], r[1]): r[2] for r in sizes.select("length", "rows", neighbours._shards()).collect()}
    assert list(shards.values()) == [1, 13, 24, 229, 5, 1]


def test_neighbours_graph():
    """No neighbour comes twice, and the places that leaves are used."""
    rng = np.random.default_rng(5)
    rows = neighbours.unit(rng.normal(size=(1500, 16))).astype(np.float32)
    rows[200:203] = rows[200]
    graph, start = neighbours.build(rows)
    for n, row in enumerate(graph):
        there = row[row >= 0].tolist()
        assert len(there) == len(set(there)) and n not in there
    found, near = neighbours.search(rows, graph, start, rows[:200], 64)
    assert all(len(set(f)) == 64 for f in found.tolist()) and (np.diff(near, axis=1) <= 0).all()
    want = np.argsort(-(rows[:200] @ rows.T), axis=1)[:, :6]
    right = sum(len(set(w) & set(f[:6])) for w, f in zip(want.tolist(), found.tolist(), strict=True))
    assert right >= 0.99 * want.size


# --- 8 -------------------------------------------------------------------------------------


def plain_dedup(rows):
    least = {}
    split = [(k, (t or "").encode().split(), n) for k, t, n in rows]
    for key, words, _ in split:
        for i in range(len(words) - 12 if key is not None else 0):
            window = tuple(words[i:i + 13])
            least[window] = min(least.get(window, key), key)
    out = []
    for key, words, n in split:
        gone = [False] * len(words)
        for i in range(len(words) - 12 if key is not None else 0):
            if least[tuple(words[i:i + 13])] < key:
                gone[i:i + 13] = [True] * 13
        kept = b" ".join(w for w, g in zip(words, gone, strict=True) if not g)
        out.append((n, len(words), sum(gone), kept.decode()))
    return out


def test_substrings(spark):
    rng = random.Random(3)
    base = [[rng.choice("abcdefgh") for _ in range(40)] for _ in range(6)]
    rows = []
    for i in range(120):
        at = rng.randrange(30)
        words = [rng.choice("abcdefgh") for _ in range(rng.randrange(12))]
        words += base[rng.randrange(6)][at:at + rng.randrange(10, 30)]
        rows.append((rng.randrange(80), " ".join(words), i))
    rows += [(None, " ".join(base[0]), 200), (5, None, 201), (6, "", 202),
             (7, "q " * 3000, 203), (8, "q\t" * 40, 204), (8, "q\t" * 40, 205)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, starts int").repartition(5)
    got = [(r.starts, r.n_words, r.n_removed, r.kept_text)
           for r in substrings.substring_dedup(df).collect()]
    assert sorted(got) == sorted(plain_dedup(rows))
    assert substrings.substring_dedup(df.limit(0)).count() == 0


def test_settled_copies_are_spread():
    text = " ".join(f"w{i}" for i in range(40))
    whole = pa.RecordBatch.from_pydict(
        {"key": range(200), "text_hash": [77] * 200, "text": [text] * 200})
    found = pa.Table.from_batches(substrings._anchor_rows(iter([whole]))).to_pylist()
    settled = [r for r in found if r["settled"] is not None]
    assert len(settled) == 200 and len({r["h1"] for r in settled}) == 200
    anchors = [r["h1"] for r in found if r["settled"] is None]
    whole = whole.append_column("known", pa.array([anchors] * 200))
    found = pa.Table.from_batches(substrings._window_rows(iter([whole]))).to_pylist()
    settled = [r for r in found if r["settled"] is not None]
    assert len(settled) == 199 and len({(r["h1"], r["h2"]) for r in settled}) == 199
    assert {r["text_hash"] for r in found} == {77}


def test_cover():
    assert {(a - b) % substrings.PERIOD for a in substrings.COVER for b in substrings.COVER} == set(
        range(substrings.PERIOD))


# --- 9 -------------------------------------------------------------------------------------

PAGES = [
    (None, ""), ("", ""), ("<p", ""), ("plain words", "plain words"),
    ("<nav><a>Home</a></nav><article><h1>T &amp; U</h1><p>One\n two<br>three<p>Four</article>"
     "<footer>&copy; x</footer>", "T & U\nOne two three\nFour"),
    ("<article><p>Before.</p><div class='ad'>Buy!</div><p>After.</p>"
     "<section id=comments><p>Reader says</p></section></article>", "Before.\nAfter."),
    ("<body><div id=menu><a>A</a></div><div>The story&nbsp;goes on.</div><p>And on.</p>"
     "<form><label>Mail</label></form><div class=sidebar>Side</div><aside>More</aside>"
     "<p><a>link</a></p>", "The story goes on.\nAnd on."),
    ("<article><p>Cut off &am", "Cut off &am"),
    ("<script>var t='<p>no</p>'</script><!-- <p>no</p> --><main><p>a < b</p></main>", "a < b"),
]


@pytest.mark.parametrize("page, text", PAGES)
def test_main_text(page, text):
    assert html_text.main_text(page) == text


LONG = [" ".join([f"{w} goes on and on"] * 9) for w in ("This", "That", "Here", "There")]


@pytest.mark.parametrize("page, text", [
    (f"<article><p>{LONG[0]}</article><article><p>{LONG[1]}<p>Yes.</article>",
     [LONG[0], LONG[1], "Yes."]),
    (f"<p>{LONG[0]}</p><article><p>{LONG[1]}</p><p>{LONG[2]}</p></article><p>Call us.</p>",
     LONG[:3]),
    (f"<p>{LONG[0]}" + "<p><a>A menu</a>" * 3 + f"<p>Side.{'<p><a>B</a>' * 3}<p>{LONG[1]}",
     LONG[:2]),
    (f"<p>{LONG[0]}</p><p>{LONG[1]}</p><div class=ad><p>x</p><p>y</p></div><form><p>Mail<p>me"
     f"</form><p>The end.</p>", [*LONG[:2], "The end."]),
    ("<p>A</p><div class=ad><div><p>x</p></div><p>y</p></div><p>B</p>", ["A", "B"]),
], ids=["two articles", "text before an article", "menus between", "noise between",
        "nested advert"])
def test_text_surges(page, text):
    assert html_text.main_text(page) == "\n".join(text)


BODY = f"<p>{LONG[0]}</p><p>{LONG[1]}</p>"


@pytest.mark.parametrize("page, whole", [
    (f"<div class='elementor-widget-container'><article>{BODY}</article></div>", True),
    (f"<div class='elementor-widget-container'>{BODY}</div>", True),
    (f"<div class='has-sidebar'>{BODY}</div>", True),
    (f"<p>{LONG[2]}<p>{LONG[3]}<div class='no-sidebar content'><p>{LONG[0]}</div>", None),
    (f"<div id='search-result'><div class=ad>{LONG[3]}</div><main>{BODY}</main></div>", True),
    (f"<article><div class=widget><div class=share>Tell</div>{BODY}</div></article>", True),
    (f"<article>{BODY}</article><div class=related><article>{LONG[2][:60]}</article></div>", True),
    (f"<article>{BODY}</article><div class=sidebar><p>{LONG[2] * 9}</div>", True),
    (f"{BODY}<ol id=comments><article class=comment><p>{LONG[2] * 9}</article></ol>", True),
    (f"<div class='ad'>{BODY}</div><article></article>", False),
])
def test_noise_names_of_wrappers(page, whole):
    want = [LONG[2], LONG[3], LONG[0]] if whole is None else LONG[:2] if whole else []
    assert html_text.main_text(page) == "\n".join(want)


def test_extraction(spark):
    df = spark.createDataFrame([(i, p, "x") for i, (p, _) in enumerate(PAGES)],
                               "page_id int, html string, n_chars string")
    found = {r.page_id: (r.text, r.n_chars) for r in html_text.extract_text(df).collect()}
    assert found == {i: (t, len(t)) for i, (_, t) in enumerate(PAGES)}
    assert html_text.extract_text(df.limit(0)).count() == 0
    real = html_text.op9_html_extraction(spark, SMALL)
    assert real.count() > 0 and real.columns == ["page_id", "url", "text", "n_chars"]


# --- 10 ------------------------------------------------------------------------------------


def test_urls(spark):
    cases = [("http://a.net/x.com /en/", None, "allow"), (None, None, "allow"),
             ("nope", None, "allow"), ("HTTP://WWW.Example.COM/en/x?y", "www.example.com/en/",
                                       "allow"),
             ("https://b.example.com/en/1", "example.com/en/", "block"), ("://", None, "allow"),
             ("http://com/", "com/", "allow"), ("x://net/es/#a", "net/es/", "block"),
             ("http://xnet/es/", None, "allow"), ("http://foo.net/es", None, "allow"),
             ("http://casino.org/", None, "block"), ("http://a.org/" + "b" * 9000, None, "allow")]
    df = spark.createDataFrame([(i, u, "x") for i, (u, _, _) in enumerate(cases)] * 2,
                               "page_id int, url string, host string")
    found = urls.judge_urls(df).collect()
    assert len(found) == 2 * len(cases)
    for r in found:
        assert (r.url, r.rule, r.verdict) == cases[r.page_id]
    assert urls.judge_urls(df.limit(0)).count() == 0


def test_many_rules(spark):
    rules = [urls.Rule("block", f"site{i}.org", f"/p{i % 7}") for i in range(300)]
    df = spark.createDataFrame([(f"http://www.site{i}.org/p{i % 5}x",) for i in range(300)],
                               "url string")
    found = {r.url: r.rule for r in urls.judge_urls(df, rules=rules, patterns=()).collect()}
    assert found == {f"http://www.site{i}.org/p{i % 5}x":
                     f"site{i}.org/p{i % 7}" if i % 5 == i % 7 else None for i in range(300)}


# --- the pipeline --------------------------------------------------------------------------


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    extra = spark.createDataFrame(
        [(None, None, "en", "s", 0), (5000, "", "en", "s", 0), (5001, None, None, None, None)],
        docs.schema)
    now = docs.union(extra).withColumn("point", F.lit(1))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {(r.doc_id, r.text) for r in now.collect()}
        out = work.stored(stage(spark, now, SMALL), name)
        assert out.columns == now.columns
        after = out.collect()
        if name == "toxicity":
            assert {(r.doc_id, r.text) for r in after} <= before and len(after) > 100
        elif name == "simhash_near_dedup":
            groups = simhash.simhash_groups(now).collect()
            assert sorted(r.doc_id for r in after if r.doc_id is not None) == sorted(
                {g.component_id for g in groups if g.doc_id == g.component_id} - {None})
            assert sum(r.doc_id is None for r in after) == 1
        else:
            plain = plain_dedup([(k, t, k) for k, t in before])
            text = dict(before)
            want = {n: kept if gone else text[n] for n, _, gone, kept in plain if kept or not gone}
            assert {r.doc_id: r.text for r in after} == want
        now = out
    packed = corpus_pipeline.STAGES[-1][1](spark, now, SMALL).collect()
    assert {r.doc_id for r in packed} == {r.doc_id for r in now.collect()}


def test_near_copies_with_repeated_numbers(spark):
    rng = random.Random(7)
    a, b, c = (" ".join(f"w{rng.randrange(9999)}" for _ in range(80)) for _ in range(3))
    rows = [(1, a, "x"), (2, a, "x"), (2, b, "x"), (3, b, "x"), (4, c, "y"), (4, c, "x"),
            (None, c, "x"), (None, c, "x")]
    for mixed in (rows, rows[::-1]):
        docs = spark.createDataFrame(mixed, "doc_id bigint, text string, version string")
        kept = corpus_pipeline.drop_near_copies(spark, docs.repartition(3), SMALL)
        assert kept.columns == docs.columns
        assert sorted(map(tuple, kept.collect()), key=str) == sorted(
            [(1, a, "x"), (2, b, "x"), (4, c, "x"), (None, c, "x"), (None, c, "x")], key=str)


def test_digest_of_kept_text(spark):
    rows = substrings.op8_substring_dedup(spark, SMALL).collect()
    assert all(re.fullmatch("[0-9a-f]{64}", r.kept_sha256) for r in rows)
    assert hashlib.sha256(b"").hexdigest() not in {
        r.kept_sha256 for r in rows if r.n_words > r.n_removed}


def peak(run) -> int:
    import tracemalloc

    tracemalloc.start()
    try:
        run()
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_memory_of_a_large_batch_of_windows():
    """Twelve MB of text in one batch take little more than a slice of it does."""
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdefgh", k=5)) for _ in range(5000)]
    texts = [" ".join(rng.choices(words, k=700)) for _ in range(3000)]
    rows = pa.record_batch([
        pa.array(range(3000), pa.int64()), pa.array([hash(t) for t in texts], pa.int64()),
        pa.array(texts)], names=["key", "text_hash", "text"])
    assert rows.nbytes > 12e6
    assert peak(lambda: [len(b) for b in substrings._anchor_rows(iter([rows]))]) < 100e6


def test_repeated_rows_count_once_in_a_slice():
    text = " ".join(f"w{i}" for i in range(40))
    rows = pa.record_batch([
        pa.array([7] * 200, pa.int64()), pa.array([5] * 200, pa.int64()), pa.array([text] * 200)],
        names=["key", "text_hash", "text"])
    (found,) = substrings._anchor_rows(iter([rows]))
    assert found.num_rows == len(substrings.Words(pa.array([text])).anchors())


def test_settled_runs():
    rng = random.Random(5)
    for _ in range(50):
        at = np.array(sorted(rng.sample(range(60), rng.randrange(1, 40))))
        row, place = at // 20, at % 20
        runs = substrings._runs(row, place)
        got = {}
        for r, told in runs.items():
            single, first, end = substrings._single_and_runs(told)
            assert not len(single)
            got[r] = [p for a, b in zip(first, end, strict=True) for p in range(a, b)]
        assert got == {r: place[row == r].tolist() for r in set(row.tolist())}


def test_short_end_behind_links():
    story = "<p>" + "A sentence of the story that goes on for some time. " * 4 + "</p>"
    links = "<ul>" + "".join(f"<li><a href=/{i}>Link {i}</a></li>" for i in range(4)) + "</ul>"
    page = (f"<body><div>Site</div>{links}<div>{story * 3}{links}<p>Copyright law changed.</p>"
            f"{links}<p>The end.</p></div>{links}<p>Copyright 2020 by X</p></body>")
    got = html_text.main_text(page).split("\n")
    assert got[3:] == ["Copyright law changed.", "The end."] and len(got) == 5


def test_toxic_model_does_not_depend_on_order(spark):
    rng = random.Random(6)
    rows, labels = [], []
    for i in range(120):
        words = [rng.choice(["tree", "house", "road", "water", "stone"]) for _ in range(30)]
        if i % 3 == 0:
            words[5:5] = ["vile", "brute"]
        rows.append((i % 100, " ".join(words)))  # some ids repeat, with other texts
        labels.append((i % 100, int(i % 3 == 0)))
    toxic = spark.createDataFrame(labels, "doc_id bigint, toxic int")
    models = set()
    for turn in range(2):
        rng.shuffle(rows)
        docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(1 + 3 * turn)
        models.add(toxicity.train(docs, toxic, "doc_id", "text", "toxic"))
    assert len(models) == 1
    assert toxicity.train(docs.limit(0), toxic, "doc_id", "text", "toxic")
