import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from acreage.llm import phrases, ranking, toxicity

# phrases


def plain_collocations(rows, most=3, least=10, top=2000, contained=50):
    """(lang, rank, phrase, a, l, r, n, score) by counting every phrase."""
    counts, sizes = {}, Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        own = counts.setdefault(lang, Counter())
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", low):
            words = [w for w in re.split("[ \t]+", piece) if w]
            sizes[lang] += len(words)
            for k in range(len(words)):
                for d in range(1, most + 1):
                    if k + d <= len(words):
                        own[tuple(words[k : k + d])] += 1
    out = []
    for lang, own in counts.items():
        frequent = {p: a for p, a in own.items() if len(p) > 1 and a >= least}
        longest = Counter()
        for p, a in frequent.items():
            for d in range(2, len(p)):
                for k in range(len(p) - d + 1):
                    longest[p[k : k + d]] = max(longest[p[k : k + d]], a)
        found = []
        for p, a in frequent.items():
            if longest[p] and 100 * longest[p] >= contained * a:
                continue
            score, _, left, right = min((1000000 * a * a // (own[p[:k]] * own[p[k:]]), k, own[p[:k]], own[p[k:]]) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, p, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, sizes[lang], -score))
    return sorted(out)


@pytest.fixture(scope="module")
def crowded_texts():
    rng = random.Random(11)
    words = ["a", "B", "the", "the", "the", "of", "ñu", "x\x00y", "long" * 30, "é", "z."]
    rows = [(" ".join(rng.choice(words) for _ in range(rng.randrange(1, 60))), rng.choice(["en", "de", None, "en\0"])) for _ in range(120)]
    # one text over and over, and one phrase that makes up much of everything
    return rows + [("the same text, again; and AGAIN\tthe same", "en")] * 40 + [("the of " * 2000, "en"), (None, "fr"), ("", "fr"), (" .,\n", None)]


@pytest.mark.parametrize(("route_bytes", "most"), [(1 << 20, 3), (300, 3), (300, 5)])
def test_collocations(spark, crowded_texts, monkeypatch, route_bytes, most):
    monkeypatch.setattr(phrases, "PORTION_BYTES", 2000)
    monkeypatch.setattr(phrases, "STRIDE", 2)
    docs = spark.createDataFrame(crowded_texts, "text string, lang string").selectExpr("*", "1 AS n", "'x' AS phrase", "2 AS route", "3 AS a").repartition(3)
    got = sorted(tuple(r) for r in phrases.collocations(docs, most, route_bytes=route_bytes, top=30).collect())
    assert got == plain_collocations(crowded_texts, most, top=30)


def test_collocations_of_odd_rows(odd_docs, odd_rows, no_docs):
    got = sorted(tuple(r) for r in phrases.collocations(odd_docs, least=2).collect())
    assert got == plain_collocations([(r[1], r[2]) for r in odd_rows], least=2)
    assert phrases.collocations(no_docs).count() == 0


@pytest.mark.parametrize("least", [1, 3, 10])
def test_equal_partitions_are_counts(least):
    rng = np.random.default_rng(least)
    keys = (rng.integers(0, 12, (3, 4000)) ** 2 // 9).astype(np.int32)
    weights, marked = rng.integers(1, 4, 4000), np.zeros(4000, dtype=np.int8)
    marked[:5] = 2
    got = {}
    for depth, at, total in phrases.equal_partitions(keys, weights, least, marked):
        for k, n in zip(at, total):
            got[tuple(keys[:depth, k].tolist())] = int(n)
    want = Counter()
    for column, n in zip(keys.T.tolist(), weights.tolist()):
        for d in (1, 2, 3):
            want[tuple(column[:d])] += n
    kept = {tuple(keys[:d, k].tolist()) for k in range(5) for d in (1, 2)}
    assert got == {p: n for p, n in want.items() if n >= least or p in kept}
    assert list(phrases.equal_partitions(np.zeros((3, 0), np.int32), np.zeros(0, np.int64), 1, np.zeros(0, np.int8))) == []


@pytest.mark.parametrize("scale", [1, 1 << 30])
def test_distinct_suffixes(scale):
    rng = np.random.default_rng(2)
    codes = rng.integers(0, 5, 300) * scale
    rows, counts = phrases.distinct_suffixes(codes, 3)
    want = Counter()
    for k in np.flatnonzero(codes):
        own = [int(codes[k]), *([0, 0])]
        for d in (1, 2):
            if own[d - 1] == 0 or k + d >= len(codes):
                break
            own[d] = int(codes[k + d])
        want[tuple(own)] += 1
    assert dict(zip(map(tuple, rows.T.tolist()), counts.tolist())) == want
    assert list(map(tuple, rows.T.tolist())) == sorted(want)


# ranking


def plain_ranking(docs, items, k=10):
    find = lambda t: [w.lower() if w.isascii() else re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in re.findall("[0-9A-Za-z\x80-\U0010ffff]+", t or "")]
    held = [(d, Counter(w)) for d, w in ((d, find(t)) for d, t in docs) if w]
    n_docs, n_terms = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(w for _, c in held for w in c)
    out = []
    for item, text in set(items):
        scored = []
        for doc, c in held:
            m = 25 + (75 * sum(c.values()) * n_docs) // n_terms
            score = sum(ranking.weight(n_docs, df[w]) * ((1_000_000_000 * c[w]) // (1000 * c[w] + 8 * m)) for w in find(text) if w in c)
            if score > 0:
                scored.append((-score, doc is not None, doc or 0))
        out += [(item, rank, d if there else None, -s) for rank, (s, there, d) in enumerate(sorted(scored)[:k], 1)]
    return Counter(out)


@pytest.mark.parametrize("postings", [1, 500, 1 << 20])
def test_ranking(spark, prose, monkeypatch, postings):
    monkeypatch.setattr(ranking, "BLOCK_POSTINGS", postings)
    rng = random.Random(4)
    pool = prose(80, 3, 40).split()
    docs = [(k % 150, " ".join(rng.choices(pool, weights=range(80, 0, -1), k=rng.randrange(1, 60)))) for k in range(200)]
    docs += [(500 + k, docs[0][1]) for k in range(15)] + [(None, docs[1][1]), (None, docs[1][1]), (900, None), (901, ""), (902, "Ünï-código 7x")]
    items = [(k, " ".join(rng.choices(pool, k=rng.randrange(1, 25)))) for k in range(25)]
    items += [(25, docs[0][1]), (26, ""), (27, None), (28, "ÜNÏ ünï Código 7X nothing"), (0, "other text of item zero " + pool[3]), (None, pool[5]), (29, "absent words")]
    frame = spark.createDataFrame(docs, "doc_id int, text string").selectExpr("*", "1 AS n", "'x' AS terms", "2 AS item_id", "3 AS score").repartition(4)
    asked = spark.createDataFrame([*items, items[3]], "item_id int, text string").selectExpr("*", "1 AS doc_id", "2 AS rank")
    got = Counter(tuple(r) for r in ranking.search(frame, asked).collect())
    assert got == plain_ranking(docs, items)
    # in blocks of items
    monkeypatch.setattr(ranking, "BLOCK_BYTES", 300)
    assert Counter(tuple(r) for r in ranking.search(frame, asked, k=3).collect()) == plain_ranking(docs, items, 3)


def test_ranking_of_odd_rows(spark, odd_docs, odd_rows, no_docs):
    items = [(1, odd_rows[0][1]), (2, odd_rows[8][1])]
    asked = spark.createDataFrame(items, "item_id bigint, text string")
    got = Counter(tuple(r) for r in ranking.search(odd_docs, asked).collect())
    assert got == plain_ranking([(r[0], r[1]) for r in odd_rows], items)
    assert ranking.search(no_docs, asked).count() == 0 and ranking.search(odd_docs, asked.limit(0)).count() == 0


# toxicity


@pytest.fixture(scope="module")
def spoken(spark, prose):
    """Texts that are toxic by a word, or only by two words that follow each other with one between them."""
    rng, rows, labels = random.Random(6), [], []
    for k in range(900):
        words, toxic = prose(rng.randrange(20, 60), k, 150).split(), k % 3 == 0
        if toxic and k % 2:
            for _ in range(3):
                words[rng.randrange(len(words))] = "Vile!"
        for _ in range(3):
            at = rng.randrange(len(words) - 2)
            words[at : at + 3] = ["go", words[at + 1], "home"] if toxic and k % 2 == 0 else ["home", words[at + 1], "go"]
        rows.append((k, " ".join(words)))
        labels.append((k, int(toxic)))
    return spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(labels, "doc_id bigint, toxic int")


def test_toxicity_on_held_out_documents(spoken):
    docs, labels = spoken
    learned = toxicity.without_held_out(labels)
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 3 != 1 for r in learned.collect())
    model = toxicity.fit(docs, learned)
    assert 0 < len(model.weights) < 2000
    scored = {r["doc_id"]: r["score"] for r in toxicity.judged(docs, learned).collect()}
    out = [k for k in scored if zlib.crc32(str(k).encode()) % 3 == 1]
    toxic, clean = [scored[k] for k in out if k % 3 == 0], [scored[k] for k in out if k % 3]
    assert sum(s >= 0.7 for s in toxic) >= 0.9 * len(toxic) and sum(s >= 0.7 for s in clean) <= 0.01 * len(clean)
    # how the input is split does not matter
    again = toxicity.fit(docs.repartition(7), learned.repartition(3))
    assert np.array_equal(model.coordinates, again.coordinates) and np.array_equal(model.weights, again.weights)


def test_toxicity_of_odd_rows(spark, spoken, odd_docs, odd_rows, no_docs):
    labels = spoken[1].withColumnRenamed("toxic", "toxic").selectExpr("*", "'x' AS text", "1 AS score")
    bad = spark.createDataFrame([(None, 1), (1, None), (2, 1), (2, 0)], "doc_id bigint, toxic int").selectExpr("*", "'x' AS text", "1 AS score")
    rows = toxicity.judged(odd_docs, labels.unionByName(bad)).collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(r[0] for r in odd_rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in rows)
    assert len({r["score"] for r in rows if r["doc_id"] in (3, 4, 5)}) == 1
    # without labels nothing is learned, and a document labelled both ways counts as toxic
    blank = toxicity.judged(odd_docs, labels.limit(0)).collect()
    assert {r["score"] for r in blank} == {0.5}
    assert toxicity.judged(no_docs, labels).count() == 0


def test_ftrl_step_follows_the_formula():
    state, z, n = toxicity.State.fresh(), Counter(), Counter()
    steps = [([1, 2, 3], 1), ([2, 5], 0), ([1, 3, 7], 1), ([2, 3], 1)] * 12
    for at, toxic in steps:
        at = [*at, 1 << toxicity.BITS]
        weight = {}
        for k in at:
            pull = 0.0 if k == 1 << toxicity.BITS else toxicity.L1
            rate = (toxicity.BETA + n[k] ** 0.5) / toxicity.ALPHA + toxicity.L2
            weight[k] = 0.0 if abs(z[k]) <= pull else -(z[k] - (pull if z[k] > 0 else -pull)) / rate
        gradient = 1 / (1 + np.exp(-sum(weight.values()))) - toxic
        for k in at:
            sigma = ((n[k] + gradient**2) ** 0.5 - n[k] ** 0.5) / toxicity.ALPHA
            z[k] += gradient - sigma * weight[k]
            n[k] += gradient**2
        state.learn(np.array(at), toxic)
    for k in z:
        assert state.z[k] == pytest.approx(z[k], abs=1e-3) and state.n[k] == pytest.approx(n[k], abs=1e-3)


def test_features_are_words_pairs_and_skips():
    docs, at = toxicity.features([b"One two. three, FOUR", b"", b"one", b"two one"])
    per = Counter(docs.tolist())
    assert per == {0: 4 + 3 + 2 + 1, 2: 1, 3: 2 + 1}
    own = [set(at[docs == k].tolist()) for k in range(4)]
    assert own[2] < own[0] and own[2] < own[3] and len(own[3] & own[0]) == 2
    _, long = toxicity.features([b"w " * 5000])
    assert len(set(long.tolist())) == 4
    assert F is not None
