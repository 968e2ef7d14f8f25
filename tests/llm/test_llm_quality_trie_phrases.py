"""Quality by attention, the prefix trie and phrases, against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from reviewlab.llm import catalog, collocations, quality, trie

DOCS = "doc_id bigint, text string, lang string, score double, passage int"


# --- quality -----------------------------------------------------------------------------------


def plain_score(model, text):
    """Passage by passage, trigram by trigram."""
    data = list((text or "").encode())
    n = max(1, math.ceil(len(data) / quality.PASSAGE))
    bags = np.zeros((n, quality.BINS))
    for i in range(len(data)):
        part = next(k for k in range(n) if k * len(data) // n <= i < (k + 1) * len(data) // n)
        three = [data[j] if 0 <= j < len(data) else 32 for j in (i - 1, i, i + 1)]
        for kind, table in enumerate((quality.LETTERS, quality.SHAPES)):
            a, b, c = (int(table[x]) for x in three)
            h = (a * 65537 + b * 257 + c) * 2654435761 % 2**32
            bags[part, (h >> 22) + kind * quality.BINS // 2] += 1
    x = np.sqrt(bags / np.maximum(bags.sum(axis=1, keepdims=True), 1))
    h = np.tanh(x @ model.e + model.e0)
    s = (np.tanh(h @ model.v) / (1 + np.exp(-(h @ model.u)))) @ model.w
    a = np.exp(s) / np.exp(s).sum()
    return 1 / (1 + np.exp(-((a @ h) @ model.c + model.b[0]))), int(s.argmax()), a.max()


def test_scores_are_those_of_the_formula():
    model = quality.Model.drawn(3)
    rng = random.Random(3)
    for text in (None, "", "x", "ÄÖ ß\n", "word " * 300, "".join(rng.choice("aB3 $é") for _ in range(5000))):
        got = model.score(None if text is None else np.frombuffer(text.encode(), np.uint8))
        want = plain_score(model, text)
        assert got[1] == want[1] and np.allclose((got[0], got[2]), (want[0], want[2]), atol=1e-5)


def test_blocks_of_any_size_count_the_same():
    text = np.frombuffer(b"some text of several passages " * 200, np.uint8)
    whole = np.concatenate(list(quality.blocks(text)))
    assert len(whole) == quality.passages(text) and whole.sum() == 2 * len(text)
    assert np.array_equal(whole, np.concatenate(list(quality.blocks(text, together=1))))


def test_slopes_are_those_of_small_steps():
    model = quality.Model.drawn(1)
    for name in ("e", "e0", "v", "u", "w", "c", "b"):
        setattr(model, name, getattr(model, name).astype(np.float64))
    rng = np.random.default_rng(2)
    x = quality.encoded(rng.integers(0, 3, (7, quality.BINS))).astype(float)
    first, y = np.array([0, 3, 4]), np.array([1.0, 0.0, 0.5])

    def loss():
        h, _, _, s = model.passage(x)
        a = np.exp(s)
        a /= np.add.reduceat(a, first)[[0, 0, 0, 1, 2, 2, 2]]
        p = quality.sigmoid(np.add.reduceat(a[:, None] * h, first) @ model.c + model.b)
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()

    for part, slope in zip(model.parts(), quality.slopes(model, x, first, y)):
        for at in [tuple(rng.integers(0, n) for n in part.shape) for _ in range(4)]:
            part[at] += 1e-4
            up = loss()
            part[at] -= 2e-4
            down = loss()
            part[at] += 1e-4
            assert abs((up - down) / 2e-4 - slope[at]) < 1e-5


def test_one_bad_passage_decides_and_every_row_is_scored(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("aeiounrst") for _ in range(5))
    rows, labels = [], []
    for i in range(240):
        words = [word() for _ in range(rng.randrange(40, 400))]
        if i % 3 == 0:
            at = rng.randrange(len(words))
            words[at:at] = [word().upper() + "$$$" for _ in range(60)]
        rows.append((i, " ".join(words), "en", 0.0, 1))
        labels.append((i, int(i % 3 != 0)))
    rows += [(900, None, None, None, None), (901, "", "x", 1.0, 2), (901, "", "x", 1.0, 2), (None, "a", "y", 0.5, 3)]
    labels += [(None, 1), (3, None)]
    docs = spark.createDataFrame(rows, DOCS)
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int")
    model = quality.fit(docs.where("doc_id % 4 <> 2"), marks)
    found = docs.select("doc_id", quality.scored(F.col("text"), model).alias("f")).collect()
    assert len(found) == len(rows) and all(0 <= r.f.score <= 1 for r in found)
    held = [r for r in found if r.doc_id is not None and r.doc_id < 240 and r.doc_id % 4 == 2]
    assert sum((r.f.score >= 0.5) == (r.doc_id % 3 != 0) for r in held) >= 0.95 * len(held)
    again = quality.fit(docs.repartition(5).where("doc_id % 4 <> 2"), marks)
    assert all(np.allclose(a, b, atol=1e-3) for a, b in zip(model.parts(), again.parts()))
    assert quality.fit(docs, marks.where("false")) is None and quality.fit(docs.where("false"), marks) is None
    none = docs.select(quality.scored(F.col("text"), None).alias("f")).select("f.*").distinct().collect()
    assert [tuple(r) for r in none] == [(0.5, 0, 1.0)]


# --- trie --------------------------------------------------------------------------------------


def plain_trie(sequences):
    """``sequences``: id to a list of (role, text)."""
    members, ends = defaultdict(list), defaultdict(list)
    for c, seq in sequences.items():
        for d in range(len(seq) + 1):
            members[tuple(seq[:d])].append(c)
        ends[tuple(seq)].append(c)
    members[()] = members.get((), [])
    children = Counter(k[:-1] for k in members if k)
    leaves, saved = Counter(), Counter()
    for k, own in members.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += not children[k]
            saved[k[:d]] += (len(own) - 1) * len(k[-1][1].encode()) if k else 0
    rows = []
    for k, own in members.items():
        digest = hashlib.sha256(",".join(map(str, sorted(ends.get(k, [])))).encode()).hexdigest()
        parent = min(members[k[:-1]]) if k else None
        rows.append((min(own, default=None), len(k), parent, len(own), children[k], leaves[k], saved[k], digest))
    return sorted(rows, key=str)


def made_conversations(seed, n=60):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        for turn in range(rng.randrange(0, 12)):
            text = rng.choice(["a", "b", "é"]) if turn < 9 else "tail"
            rows.append((c, turn, rng.choice(["user", "user", "bot"]) if turn > 2 else "user", text if c % 7 else "same"))
    rows += [(3, None, None, None), (3, None, "user", None), (5, 1, "user", "a"), (5, 1, "user", "a"), (None, 1, "x", "y")]
    rows += [(400 + k, t, "user", "long") for k in range(3) for t in range(70 + k)]
    return rng.sample(rows, len(rows))


TURNS = "conv_id bigint, turn bigint, role string, text string, depth int, h1 string, place int"


def in_order(rows):
    found = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            found[c].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [(r, t) for *_, r, t in sorted(own)] for c, own in found.items()}


@pytest.mark.parametrize(("batches", "seed"), [(1, 1), (3, 2), (5, 3)])
def test_trie_is_that_of_all_prefixes(spark, batches, seed):
    rows = made_conversations(seed)
    table = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], TURNS).repartition(6)
    turns = trie.placed(table, "conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(900,), (901,)], "conv bigint")
    found = trie.nodes(turns, turns.select("conv").union(extra), batches)
    want = plain_trie(in_order(rows) | {900: [], 901: []})
    assert sorted((tuple(r) for r in found.collect()), key=str) == want


def test_query_rebuilds_conversations(spark, tmp_path):
    rows = made_conversations(9, 40)
    spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").write.parquet(
        str(tmp_path / "conversations.parquet")
    )
    turns = in_order(rows)
    rebuilt = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        rebuilt[c] = turns.get(c - c % 5, [])[:h] + own[h:]
    found = catalog.op12_trie(spark, str(tmp_path)).collect()
    assert sorted((tuple(r) for r in found), key=str) == plain_trie(rebuilt)


def test_trie_of_nothing_is_its_root(spark):
    turns = trie.placed(spark.createDataFrame([], TURNS), "conv_id", "turn", "role", "text")
    rows = trie.nodes(turns, turns.select("conv")).collect()
    assert [tuple(r) for r in rows] == plain_trie({})


def test_running_values_go_on_over_tasks_and_batches(spark):
    rows = spark.range(2000).selectExpr(
        "if(id < 1500, 7, id % 5) as conv", "xxhash64(id) as h1", "xxhash64(id, 1) as h2", "id as bytes", "id as at"
    )
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 64)
    try:
        found = trie.running(rows, ["at"]).orderBy("conv", "at").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    source = {(r.conv, r.at): r for r in rows.collect()}
    conv, place, xor, total = None, 0, 0, 0
    for r in found:
        if r.conv != conv:
            conv, place, xor, total = r.conv, 0, 0, 0
        place, xor, total = place + 1, xor ^ source[(r.conv, r.at)].h1, total + r.at
        assert (r.place, r.h1, r.sum) == (place, xor, total)


def test_two_fattest(spark):
    pairs = [(a, b) for a in range(-1, 40) for b in range(max(a, 0) + 1, 41)]
    df = spark.createDataFrame(pairs, "a bigint, b bigint")
    for r in df.select("a", "b", trie.two_fattest(F.col("a"), F.col("b")).alias("f")).collect():
        assert r.f == max(range(max(r.a, 0) + 1, r.b + 1), key=lambda x: x & -x)


# --- phrases -----------------------------------------------------------------------------------


def plain_phrases(rows, least, longest, top):
    f, total = Counter(), Counter()
    for text, lang in rows:
        lang = lang or "und"
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower):
            words = re.findall("[^\x20\x09]+", piece)
            total[lang] += len(words)
            for size in range(1, longest + 1):
                for i in range(len(words) - size + 1):
                    f[lang, tuple(words[i : i + size])] += 1
    good = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    gone = set()
    for (lang, words), a in good.items():
        for size in range(2, len(words)):
            for i in range(len(words) - size + 1):
                part = lang, words[i : i + size]
                if 100 * a >= 100 * good[part]:
                    gone.add(part)
    found = defaultdict(list)
    for (lang, words), a in good.items():
        if (lang, words) in gone:
            continue
        cuts = [(1000 * a * total[lang] // (f[lang, words[:k]] * f[lang, words[k:]]), k) for k in range(1, len(words))]
        score, k = min(cuts)
        found[lang].append((-score, -a, " ".join(words).encode(), f[lang, words[:k]], f[lang, words[k:]]))
    return sorted(
        (lang, i, phrase.decode(), -a, l, r, total[lang], -s)
        for lang, own in found.items()
        for i, (s, a, phrase, l, r) in enumerate(sorted(own)[:top], 1)
    )


def made_texts(seed):
    rng = random.Random(seed)
    common = ["the", "of", "Ünd", "a"]
    rare = [f"w{i}" for i in range(40)]
    fixed = [rng.sample(rare, k) for k in (2, 3, 4, 5, 5)] + [["bank", "of", "w3"], ["w1", "w1", "w1"]]
    rows = []
    for i in range(120):
        words = []
        for _ in range(rng.randrange(5, 60)):
            words += rng.choice(fixed) if rng.random() < 0.3 else [rng.choice(common * 6 + rare)]
            if rng.random() < 0.15:
                words.append(rng.choice([",", ". ", "!\n", "\x0b;", "\t \t"]))
        text = " ".join(words)
        rows.append((text.upper() if i % 9 == 0 else text, ["en", "fr", None, "und"][i % 4]))
    return rows + [(None, "en"), ("", None), (" \t. ", "xx"), ("w1 w1 w1 w1 " * 300, "en"), ("one", "yy")] * 2


@pytest.mark.parametrize(("least", "top", "first", "seed"), [(3, 5, 4, 1), (2, 40, 1, 2), (6, 2000, 8000, 3), (4, 1, 2, 4)])
def test_phrases_are_those_of_all_phrases(spark, least, top, first, seed, monkeypatch):
    monkeypatch.setattr(collocations, "CHUNK", 37)
    monkeypatch.setattr(collocations, "SLICE", 50)
    monkeypatch.setattr(collocations, "TOGETHER", 700)
    rows = made_texts(seed)
    docs = spark.createDataFrame([(*r, 1, "x", 0) for r in rows], "text string, lang string, f int, g string, score int")
    found = collocations.mined(docs.repartition(3), least=least, top=top, first=first).collect()
    assert sorted(tuple(r) for r in found) == plain_phrases(rows, least, 5, top)


def test_no_texts_and_no_candidates(spark):
    docs = spark.createDataFrame([("one two three", "en")], "text string, lang string")
    assert collocations.mined(docs).count() == 0
    assert collocations.mined(docs.where("false")).columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def test_best_first_leaves_frequent_words_alone(spark, monkeypatch):
    expanded = []
    real = collocations._grown_round

    def watched(words, vocabulary, band, *rest):
        expanded.append(band.count())
        return real(words, vocabulary, band, *rest)

    monkeypatch.setattr(collocations, "_grown_round", watched)
    rows = made_texts(5)
    docs = spark.createDataFrame(rows, "text string, lang string")
    found = collocations.mined(docs, least=3, top=2, first=6).collect()
    assert sorted(tuple(r) for r in found) == plain_phrases(rows, 3, 5, 2)
    words = {(lang or "und", w) for t, lang in rows for w in re.findall("[^\x20\x09.,;:!?\x0a-\x0d]+", (t or "").lower())}
    assert sum(expanded) < len(words)


def test_words_that_are_names_of_languages_are_words_like_others(spark):
    texts = ["de en es. en de und", "es de en, und und de", "de de en en es es", "en es; de es und"]
    rows = [(t, lang) for lang in ("de", "en", "es", None) for t in texts]
    docs = spark.createDataFrame(rows, "text string, lang string")
    found = collocations.mined(docs, least=1, top=50).collect()
    assert sorted(tuple(r) for r in found) == plain_phrases(rows, 1, 5, 50)
