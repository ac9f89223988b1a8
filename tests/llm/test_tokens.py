import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from acreage.llm import packing, rans
from acreage.llm.tokens import WordEncoder, default_tokenizer
from acreage.session import fresh_folder


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(default_tokenizer())


def ids_of(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


def test_words_encode_as_whole_texts(tokenizer, prose):
    encoder = WordEncoder(default_tokenizer())
    texts = [
        prose(200, 3),
        "don't, x'S ÉLAN! é́ 12.5%) <|startoftext|>x <|ENDOFTEXT|>! a b \x1c ẞ İI ΑΣ. ʼn ǅ",
        "naïve-Ω (a)?! ... --- 'tis the's",
        "",
    ]
    for text in texts * 2:
        assert np.frombuffer(encoder.encode(text.encode()), encoder.dtype).tolist() == ids_of(tokenizer, text)[:-1]


def test_cache_generations_do_not_change_ids(tokenizer, prose, monkeypatch):
    monkeypatch.setattr("acreage.llm.tokens.CACHE_WORDS", 20)
    encoder = WordEncoder(default_tokenizer())
    for seed in range(5):
        text = prose(100, seed, 10)
        assert np.frombuffer(encoder.encode(text.encode()), encoder.dtype).tolist() == ids_of(tokenizer, text)[:-1]


@pytest.mark.parametrize("weights", [None, [5.0, 1.0, 0.0]])
def test_deal_fills_windows_in_proportion(weights):
    sizes = np.array([900, 90, 1010])
    takes = packing.deal(sizes, np.array(weights or sizes, dtype=float), 100)
    assert takes.sum(axis=0).tolist() == sizes.tolist() and (takes >= 0).all()
    assert (takes.sum(axis=1) == 100).all()
    if weights is None:
        # what a queue has had never strays from its share by a whole token
        fair = np.outer(np.arange(1, len(takes) + 1), sizes / sizes.sum() * 100)
        assert np.abs(np.cumsum(takes, axis=0) - fair).max() < 1 + 1e-6
    else:
        assert takes[:5, 0].tolist() == [84, 83, 83, 84, 83] or abs(takes[:5, 0].sum() - 417) <= 2
        assert takes[0, 2] == 0


def test_deal_with_more_queues_than_tokens_in_a_window():
    sizes = np.array(random.Random(1).choices(range(1, 9), k=50))
    takes = packing.deal(sizes, sizes.astype(float), 10)
    assert takes.sum(axis=0).tolist() == sizes.tolist()
    assert (takes[:-1].sum(axis=1) == 10).all()


@pytest.mark.parametrize("lane_windows", [2, 512])
def test_pack_covers_every_token_once(odd_docs, odd_rows, tokenizer, lane_windows):
    rows = packing.pack(odd_docs, window=64, lane_windows=lane_windows).collect()
    want = Counter((doc, tuple(ids_of(tokenizer, text))) for doc, text, *_ in odd_rows)
    sequences, tokens = defaultdict(list), Counter()
    for r in rows:
        ids = np.frombuffer(r["ids"], "<u2")
        assert len(ids) == r["length"] and crc(ids) == r["ids_crc32"]
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        tokens[r["doc_id"], r["doc_tokens"], r["start"], bytes(r["ids"])] += 1
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 64
    lengths = Counter()
    for (doc, whole, _, ids), n in tokens.items():
        lengths[doc, whole] += n * len(ids) // 2
    expected = Counter()
    for (doc, ids), n in want.items():
        expected[doc, len(ids)] += n * len(ids)
    assert lengths == expected
    # a single long document, in order
    long = sorted((r["start"], bytes(r["ids"])) for r in rows if r["doc_id"] == 6)
    assert np.frombuffer(b"".join(x for _, x in long), "<u2").tolist() == ids_of(tokenizer, odd_rows[8][1])


def test_pack_empty(no_docs):
    assert packing.pack(no_docs).count() == 0


@pytest.mark.parametrize("size", [0, 1, 5, rans.LANES, rans.LANES * 3 + 7, rans.LANES * rans.CHECKPOINT * 2 + 11])
def test_code_round_trip_and_checkpoints(size):
    rng = np.random.default_rng(size)
    ids = np.minimum(rng.geometric(0.05, size), 3000)
    symbols, counts = np.unique(np.concatenate([ids, [1, 70000]]), return_counts=True)
    code = rans.Code.of(symbols, counts)
    assert code.freqs.sum() == 1 << rans.SCALE_BITS and code.freqs.min() >= 1
    coded = code.encode(ids)
    assert code.decode(size, *coded).tolist() == ids.tolist()
    step = rans.LANES * rans.CHECKPOINT
    for mark in range(len(coded[2]) // 8):
        part = code.decode(size, *coded, start=mark, stop=mark + 1)
        assert part.tolist() == ids[mark * step : (mark + 1) * step].tolist()
    if size > 1000:
        # close to the entropy once the states are written off
        p = np.bincount(ids) / size
        entropy = -sum(x * np.log2(x) for x in p if x) * size / 8
        assert len(coded[1]) < entropy * 1.02 + 4 * rans.LANES


def test_damaged_block_is_noticed():
    ids = np.arange(100_000) ** 2 % 3001
    code = rans.Code.of(*np.unique(ids, return_counts=True))
    states, words, marks, sums = code.encode(ids)
    damaged = bytearray(words)
    for k in range(100, 140):
        damaged[k] ^= 255
    with pytest.raises(ValueError, match="checksum"):
        code.decode(len(ids), states, bytes(damaged), marks, sums)


def test_token_files_round_trip(spark, odd_docs, odd_rows, tokenizer, monkeypatch):
    monkeypatch.setattr(rans, "BLOCK_TOKENS", 100)
    folder = fresh_folder(spark, "files")
    rans.write_tokens(odd_docs, folder)
    rows = rans.read_tokens(spark, folder).orderBy("start").collect()
    assert [r["doc_id"] for r in rows] == sorted((r[0] for r in odd_rows), key=lambda x: (x is not None, x))
    at = 0
    for r in rows:
        assert r["start"] == at and len(r["ids"]) == 4 * r["n_tokens"]
        at += r["n_tokens"]
    got = Counter((r["doc_id"], zlib.crc32(bytes(r["ids"]))) for r in rows)
    assert got == Counter((doc, crc(ids_of(tokenizer, text))) for doc, text, *_ in odd_rows)


def test_token_files_empty(spark, no_docs):
    folder = fresh_folder(spark, "files")
    rans.write_tokens(no_docs, folder)
    assert rans.read_tokens(spark, folder).agg(F.count("*")).first()[0] == 0
