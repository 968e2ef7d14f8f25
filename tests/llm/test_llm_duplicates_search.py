"""Near duplicates, repeated strings, benchmark passages and neighbours by brute force."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from reviewlab.llm import ann, decontaminate, graph, minhash, suffixes


def text_of(rng, n, words=4000):
    return " ".join(f"w{rng.randrange(words)}" for _ in range(n))


def edited(rng, text, share):
    return " ".join(f"e{rng.random()}" if rng.random() < share else w for w in text.split())


def shingles(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def plain_components(rows, size, percent):
    sets = [shingles(t, size) for _, t in rows]
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                root[max(top(i), top(j))] = min(top(i), top(j))
    least = {}
    for i, (id, _) in enumerate(rows):
        least[top(i)] = min(least.get(top(i), id), id)
    return {(id, t): (len(sets[i]), least[top(i)]) for i, (id, t) in enumerate(rows)}


@pytest.fixture(scope="module")
def family():
    rng = random.Random(6)
    bases = [text_of(rng, n) for n in (5, 9, 30, 200)]
    texts = [None, "", " \t\n", "one", "ONE", "one two", "Ünï ünï", "x " * 2000, "x " * 2001, "a\x0bb\xa0c"]
    for base in bases:
        texts += [base, base.upper(), base, *[edited(rng, base, s / 300) for s in range(12)]]
    for base in bases[2:]:
        family = [edited(rng, base, 0.03) for _ in range(25)]
        texts += family + [" ".join(t.split()[k:]) for k, t in enumerate(family)]
    return [(k * 3 + 1, t) for k, t in enumerate(rng.sample(texts, len(texts)))]


@pytest.mark.parametrize(("words", "block"), [(4, 256), (5, 4)])
def test_components_are_those_of_all_pairs(spark, family, words, block, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", block)
    docs = spark.createDataFrame(
        [(i, t, "n", 1) for i, t in family], "doc_id bigint, text string, key string, component_id int"
    )
    rows = minhash.near_duplicates(docs, words=words).collect()
    want = plain_components(family, words, 80)
    assert len(rows) == len(family)
    texts = dict(family)
    for r in rows:
        assert (r.n_shingles, r.component_id) == want[(r.doc_id, texts[r.doc_id])]
        assert r.kept == (r.doc_id == r.component_id)
    kept = minhash.deduplicated(docs, words=words)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for (i, _), (_, c) in want.items() if i == c}


def test_rows_without_an_id_equal_rows_and_no_rows(spark):
    text = "one two three four five six"
    rows = [(None, text), (None, text), (7, text), (7, text), (9, text), (8, None), (8, None), (5, "other")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = Counter((r.doc_id, r.component_id, r.kept) for r in minhash.near_duplicates(docs).collect())
    assert found == Counter({(None, None, True): 2, (7, 7, True): 2, (9, 7, False): 1, (8, 8, True): 2, (5, 5, True): 1})
    kept = Counter(r.doc_id for r in minhash.deduplicated(docs).collect())
    assert kept == Counter({None: 1, 7: 1, 8: 1, 5: 1})
    assert minhash.near_duplicates(docs.where("false")).count() == 0


def test_two_texts_under_one_id_are_judged_apart(spark):
    rng = random.Random(4)
    a, b, c = (text_of(rng, 60) for _ in range(3))
    rows = [(5, a), (5, b), (3, a + " more"), (8, c), (8, c + " more"), (9, b.upper()), (2, "one"), (2, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = minhash.near_duplicates(docs).select("doc_id", "component_id", F.col("text_hash"), "kept")
    hashed = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")).distinct()
    got = {(r.doc_id, r.text): (r.component_id, r.kept) for r in found.join(hashed, ["doc_id", "text_hash"]).collect()}
    assert sorted(got.pop((8, t))[1] for t in (c, c + " more")) == [False, True]
    assert got == {
        (5, a): (3, False), (5, b): (5, True), (3, a + " more"): (3, True), (9, b.upper()): (5, False),
        (2, "one"): (2, True), (2, None): (2, True),
    }
    kept = {(r.doc_id, r.text) for r in minhash.deduplicated(docs).collect()}
    assert {(i, t) for i, t in kept if i != 8} == {(5, b), (3, a + " more"), (2, "one"), (2, None)}
    assert len(kept) == 5


def test_components_of_chains_stars_and_nothing(spark):
    links = [(i, i + 1) for i in range(20)] + [(100, i) for i in range(101, 140)] + [(5, 5), (7, 6)]
    found = {r.node: r.root for r in graph.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert found == {i: 0 for i in range(21)} | {i: 100 for i in range(100, 140)}
    assert graph.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def plain_repeats(bodies, length):
    seen = Counter(b[j : j + length] for b in bodies for j in range(len(b) - length + 1))
    out = []
    for b in bodies:
        gone = bytearray(len(b))
        for j in range(len(b) - length + 1):
            if seen[b[j : j + length]] > 1:
                gone[j : j + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        out.append((len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def repeating(rng):
    passage = text_of(rng, 60)
    parts = [text_of(rng, 40) for _ in range(6)]
    return [
        None,
        "",
        "short",
        "é" * 99 + "a",
        "é" * 100,
        "é" * 100,
        passage,
        passage + parts[0],
        parts[1] + passage[3:] + parts[2],
        parts[1][:150] + passage[50:300] + parts[3],
        passage[100:299],
        passage[100:300] + "!",
        "z" * 5000,
        "ab" * 700 + parts[4] + "ab" * 120,
        parts[5] + " " + parts[5],
        *[edited(rng, passage, 0.02) for _ in range(40)],
        *["line of text " * 20 + str(i) for i in range(30)],
    ]


@pytest.mark.parametrize("block", [512, 12])
def test_bytes_removed_are_those_of_all_strings(spark, block, monkeypatch):
    monkeypatch.setattr(suffixes, "BLOCK", block)
    texts = repeating(random.Random(9))
    docs = spark.createDataFrame(
        [(i, t, 1, "d") for i, t in enumerate(texts)], "doc_id bigint, text string, n int, doc string"
    )
    rows = suffixes.without_repeats(docs).orderBy("doc_id").collect()
    want = plain_repeats([(t or "").encode() for t in texts], 200)
    assert [tuple(r)[1:] for r in rows] == want


def test_equal_rows_and_missing_ids_repeat_each_other(spark):
    long = text_of(random.Random(1), 80)
    rows = [(1, long), (1, long), (None, long + "x"), (None, text_of(random.Random(2), 80)), (2, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = Counter(tuple(r) for r in suffixes.without_repeats(docs).collect())
    want = plain_repeats([(t or "").encode() for _, t in rows], 200)
    assert found == Counter((i, *w) for (i, _), w in zip(rows, want, strict=True))
    assert suffixes.without_repeats(docs.where("false")).count() == 0


def test_texts_longer_than_a_chunk(monkeypatch):
    rng = random.Random(3)
    body = np.frombuffer(text_of(rng, 3000).encode(), np.uint8)
    whole = suffixes.anchors(body)
    monkeypatch.setattr(suffixes, "CHUNK", 1000)
    parts = suffixes.anchors(body)
    assert all((a == b).all() for a, b in zip(whole, parts, strict=True))


def test_deep_shallow_order_is_the_byte_order():
    rng = random.Random(2)
    for shallow in (0, 2, 50):
        strings = [bytes(rng.choice(b"ab") for _ in range(rng.randrange(12))) for _ in range(200)]
        strings += [b"a" * 60 + s for s in strings]
        order = suffixes.deep_shallow(strings, shallow)
        assert sorted(order) == list(range(len(strings)))
        assert [strings[i] for i in order] == sorted(strings)


def plain_scores(items, query):
    words = [re.findall(r"\w+", (q + " " + a).lower()) for _, q, a in items]
    mean = sum(map(len, words)) / len(words)
    df = Counter(w for d in words for w in set(d))
    out = {}
    for (i, _, _), d in zip(items, words, strict=True):
        tf = Counter(d)
        gain = {
            w: np.log(1 + (len(words) - df[w] + 0.5) / (df[w] + 0.5))
            * n
            * (decontaminate.K1 + 1)
            / (n + decontaminate.K1 * (1 - decontaminate.B + decontaminate.B * len(d) / mean))
            for w, n in tf.items()
        }
        out[i] = sum(g for w, g in gain.items() if w in query) / sum(gain.values())
    return out


def test_wand_returns_every_item_above_the_threshold():
    rng = random.Random(7)
    items = [(i, text_of(rng, rng.randrange(3, 40), 90), text_of(rng, 4, 90)) for i in range(50)]
    index = decontaminate.index_of(items)
    for threshold in (0.05, 0.2, 0.5, 0.9):
        for _ in range(30):
            query = {f"w{rng.randrange(110)}" for _ in range(rng.randrange(1, 60))}
            hashes = decontaminate._words(" ".join(sorted(query)))
            passage, term = index.passages(hashes)
            found = {}
            if len(term):
                terms = np.unique(term)
                found = {index.ids[i]: s for i, s in index.wand(terms, threshold)}
            scores = plain_scores(items, query)
            assert found == pytest.approx({i: s for i, s in scores.items() if s >= threshold})


ITEMS = [
    (1, "What is the colour of the tall old house on the hill by the river? It is a very pale shade of green, they say."),
    (2, "How many steps lead down to the cellar of the third shop on market street? Forty two of them, and then one more."),
    (3, None),
    (4, ""),
    (5, "one two"),
    (2, "How many steps lead down to the cellar of the third shop on market street? Forty two of them, and then one more."),
]


def test_passages_are_found_wherever_they_stand(spark):
    rng = random.Random(8)
    one, two = ITEMS[0][1], ITEMS[1][1]
    noise = text_of(rng, 400)
    docs = {
        0: None,
        1: "",
        2: noise,
        3: noise + " " + one + " " + noise,
        4: noise[:301] + " " + two.upper().replace(",", " -- ") + noise,
        5: one.split("?")[0] + "? " + noise,
        6: one + " " + two,
        7: " ".join(one.split()[::-1]),
        8: noise * 30 + " " + one,
        9: "say one two three",
        10: one.split("? ")[1],
    }
    df = spark.createDataFrame([(k, v, 0) for k, v in docs.items()], "doc_id int, text string, item int")
    items = spark.createDataFrame(ITEMS, "item_id int, text string")
    for index_bytes in (1 << 20, 120):
        hits = decontaminate.hits(F.col("text"), items, index_bytes=index_bytes)
        found = {r.doc_id: {h.item for h in r.h} for r in df.select("doc_id", hits.alias("h")).collect()}
        assert found == {0: set(), 1: set(), 2: set(), 3: {1}, 4: {2}, 5: set(), 6: {1, 2}, 7: set(), 8: {1}, 9: {5}, 10: set()}
    assert df.where("false").select(decontaminate.hits(F.col("text"), items)).count() == 0
    none = df.select(decontaminate.hits(F.col("text"), items.where("false")).alias("h"))
    assert all(r.h == [] for r in none.collect())


def test_items_of_one_text_are_found_with_their_end_changed(spark):
    words = text_of(random.Random(5), 58).split()
    short = " ".join(words) + ". Ñ."
    twelve = " ".join(words[:40]) + ". " + " ".join(f"v{i}" for i in range(12))
    items = spark.createDataFrame([(1, short), (2, twelve)], "item_id int, text string")
    texts = [" ".join(words)]  # the last sentence is cut
    for text in (short, twelve):
        for k in range(1, 6):
            changed = text.split()
            changed[-k] = "other"
            texts.append(" ".join(changed))
    texts += [" ".join(words[:25]), text_of(random.Random(6), 60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    hits = decontaminate.hits(F.col("text"), items)
    found = {r.doc_id: {h.item for h in r.h} for r in docs.select("doc_id", hits.alias("h")).collect()}
    assert all(1 in found[k] for k in range(6)) and all(2 in found[k] for k in range(6, 11))
    assert found[11] == found[12] == set()


def test_items_with_question_and_answer(spark):
    items = spark.createDataFrame([(1, "a b c d e f g", "h i j k l m")], "item_id int, q string, a string")
    docs = spark.createDataFrame([("x a b c d e f g h i j k l m",), ("a b c d e f g",)], "text string")
    hits = decontaminate.hits(F.col("text"), items, question="q", answer="a")
    assert [len(r.h) for r in docs.select(hits.alias("h")).collect()] == [1, 0]


def neighbours(rows, k):
    out = {}
    for i, v in rows:
        if i % 20 == 0:
            scores = sorted((-float(np.dot(v, w)), j) for j, w in rows if j != i)
            out[i] = scores[:k]
    return out


def test_nearest_of_a_graph_is_nearly_that_of_all_rows(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(8, 16))
    points = centres[rng.integers(0, 8, 3000)] + rng.normal(size=(3000, 16)) * rng.uniform(0.2, 2, (3000, 1))
    rows = [(i, p.tolist()) for i, p in enumerate(points)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    found = ann.nearest(df, df.where("vec_id % 20 = 0"), shard_rows=1000).collect()
    want = neighbours(rows, 20)
    got = {}
    for r in found:
        got.setdefault(r.query_id, []).append((r["rank"], r.id, r.score))
        assert r.score == pytest.approx(float(np.dot(points[r.query_id], points[r.id])), rel=1e-12)
    assert set(got) == set(want) and all([x[0] for x in sorted(v)] == list(range(1, 21)) for v in got.values())
    hits = sum(len({j for _, j in want[q]} & {x[1] for x in got[q]}) for q in want)
    assert hits / (20 * len(want)) >= 0.95


@pytest.mark.parametrize("largest", [1e3, 1e200])
def test_nearest_where_lengths_span_many_powers_of_ten(spark, largest):
    rng = np.random.default_rng(2)
    points = rng.normal(size=(2000, 16))
    lengths = 10 ** rng.uniform(-3, 3, (2000, 1))
    lengths[:3] = 1e3
    # All but three long vectors lie in the other half, so that short ones are wanted as well.
    points[:, 0] = -np.abs(points[:, 0])
    points[3::10, 0] *= -1
    lengths[3:] = np.where(points[3:, :1] > 0, lengths[3:] / 1e3, lengths[3:])
    points *= lengths * (largest / 1e3)
    rows = [(i, p.tolist()) for i, p in enumerate(points)]
    asked = [(i, (p / np.abs(p).max()).tolist()) for i, p in enumerate(points) if i % 20 == 0]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    queries = spark.createDataFrame(asked, "vec_id bigint, embedding array<double>")
    got = {}
    for r in ann.nearest(df, queries).collect():
        got.setdefault(r.query_id, set()).add(r.id)
    hits = 0
    for i, q in asked:
        order = [j for j in np.argsort(-(points @ np.array(q)), kind="stable") if j != i]
        hits += len(got[i] & set(order[:20]))
    assert hits / (20 * len(asked)) >= 0.95


def test_graphs_reach_short_vectors_beside_a_long_one():
    rng = np.random.default_rng(3)
    points = rng.normal(size=(1500, 16))
    points[0] *= 1e4
    graph, _ = ann.build(ann.one_length(points))
    assert (graph >= 0).sum(axis=1).mean() > 4


def test_equal_vectors_ties_and_vectors_that_take_no_part(spark):
    rows = [(i, [1.0, 0.0]) for i in range(50)] + [(i, [float(i), 1.0]) for i in range(60, 66)]
    rows += [(100, None), (120, [0.0, 0.0]), (140, [None, 1.0]), (160, [float("nan"), 1.0]), (180, [float("inf"), 1.0])]
    rows += [(None, [1.0, 0.0]), (200, [1.0, 2.0, 3.0]), (201, [1.0, 1.0, 1.0]), (0, [1.0, 0.0])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id bigint, embedding array<double>, rank int")
    found = ann.nearest(df, df.where("vec_id % 20 = 0").dropDuplicates(["vec_id"]), k=20).collect()
    got = {}
    for r in sorted(found, key=lambda r: r["rank"]):
        got.setdefault(r.query_id, []).append(r.id)
    assert set(got) == {0, 20, 40, 60, 200}
    assert got[0] == [*range(65, 59, -1), *range(1, 15)]
    assert got[20] == [*range(65, 59, -1), 0, 0, *range(1, 13)] or got[20] == [*range(65, 59, -1), *range(14)]
    assert got[60][:5] == [65, 64, 63, 62, 61] and got[200] == [201]
    assert ann.nearest(df.where("false"), df.where("false")).count() == 0
