import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from quire.llm import tokens
from quire.llm.eliasfano import EliasFano, token_files
from quire.llm.packing import best_fit, cut, pack_documents

PATH = P.path("byte_bpe_50k.json")


def plain(texts):
    t = Tokenizer.from_file(PATH)
    return [t.encode(x or "", add_special_tokens=False).ids for x in texts]


def odd_texts(seed=1):
    rnd = random.Random(seed)
    bits = ["the", "ciónllas.", "it's", "we'll", "x\ny", "\n", " ", "  ", "\t", "3rd", "12,5", " ", "​", "᠎", "é",
            "日本語", "👍🏽", "<|endoftext|>", "x<|endoftext|>y", "<|endoftext|> ", "\x1c", "\x85", " ", "á", "'s", "!!", "\r\n", "", "﻿", "\x00"]
    texts = [" ".join(rnd.choice(bits) for _ in range(rnd.randint(0, 30))) for _ in range(400)]
    texts += ["".join(rnd.choice(bits) for _ in range(rnd.randint(0, 30))) for _ in range(200)]
    return texts + [None, "", " ", "  ", " a", "a ", "a  b", "\n a", "a \n b", "x" * 3000, "w " * 5000]


@pytest.mark.parametrize("size", [40, 1_000_000])
def test_chunked_ids_equal_plain_encoding(monkeypatch, size):
    monkeypatch.setattr(tokens, "SLICE", size)
    monkeypatch.setattr(tokens, "KEEP", 20)
    texts = odd_texts()
    enc = tokens.ChunkEncoder(PATH)
    for _ in range(2):
        assert [np.frombuffer(r, enc.dtype).tolist() for r in enc.encode(texts)] == plain(texts)


@pytest.mark.parametrize("n,top", [(0, 1), (1, 0), (1, 2**40), (200, 100), (1000, 10**6), (777, 2**62)])
def test_elias_fano_round_trip(n, top):
    rnd = random.Random(n)
    v = sorted(rnd.randint(0, top) for _ in range(n))
    ef = EliasFano.of(np.array(v, np.uint64))
    assert ef.values().tolist() == v
    assert [ef.select(i) for i in range(n)] == v
    if n >= 200:
        bits = 8 * (len(ef.low) + len(ef.high))
        assert bits <= n * (2 + max(0, np.log2(max(top, 1) / n)) + 1) + 64


def frame(spark, rows):
    return spark.createDataFrame([(*r, 0, b"x") for r in rows], "doc_id long, text string, segment int, ids binary")


def test_files_round_trip(spark):
    rows = [(3 * i - 50, t) for i, t in enumerate(odd_texts(2))] + [(4, "same"), (4, "same"), (4, "other"), (None, "no id"),
                                                                    (2**62, "far"), (-2**62, None)]
    random.Random(0).shuffle(rows)
    want, at = [], 0
    for (i, t), ids in sorted(zip(rows, plain([t for _, t in rows])),
                              key=lambda x: (x[0][0] is not None, x[0][0] or 0, (x[0][1] or "").encode())):
        ids = np.array([*ids, 0], "<u4")
        want.append((i, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    got = token_files(frame(spark, rows), PATH, 0, max_docs=50, max_ids=2000).collect()
    got = sorted(((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got), key=lambda r: r[1])
    assert got == want


def test_files_empty(spark):
    assert token_files(frame(spark, []), PATH, 0).count() == 0


def check_packing(rows, got, capacity):
    ids = {}
    for (i, _), x in zip(rows, plain([t for _, t in rows])):
        ids.setdefault(i, []).append([*x, 2])
    by_seq, by_doc = {}, {}
    for r in got:
        by_seq.setdefault(r.sequence_id, []).append(r)
        by_doc.setdefault(r.doc_id, []).append(r)
    for seq in by_seq.values():
        seq.sort(key=lambda r: r.offset)
        assert [r.offset for r in seq] == [sum(x.length for x in seq[:k]) for k in range(len(seq))]
        assert sum(r.length for r in seq) <= capacity
    for i, versions in ids.items():
        want = []
        for x in versions:
            at = 0
            for k, n in enumerate(cut(len(x), capacity)):
                want.append((k, at, n, zlib.crc32(np.array(x[at:at + n], "<u4").tobytes())))
                at += n
        assert sorted((r.piece, r.start, r.length, r.ids_crc32) for r in by_doc[i]) == sorted(want)
    assert set(by_doc) == set(ids)
    return len(by_seq)


@pytest.mark.parametrize("fan_in", [50_000, 60])
def test_packing(spark, fan_in):
    rnd = random.Random(4)
    rows = [(i, "word " * rnd.choice([1, 3, 10, 60, 63, 64, 65, 127, 128, 200, 1000])) for i in range(300)]
    rows += [(7, "again"), (7, "again"), (None, "no id"), (None, None), (900, "")]
    got = pack_documents(frame(spark, rows), PATH, 2, capacity=64, slack=1, fan_in=fan_in).collect()
    n = check_packing(rows, got, 64)
    total = sum(r.length for r in got)
    assert n <= 1.05 * -(-total // 64) + 3


def test_packing_empty(spark):
    assert pack_documents(frame(spark, []), PATH, 2).count() == 0


def test_best_fit_is_tight():
    assert best_fit([6, 5, 4, 4, 1], 10) == [[0, 2], [1, 3, 4]]
    assert cut(10, 4) == [2, 4, 4] and cut(8, 4) == [4, 4] and cut(4, 4) == [4] and cut(1, 4) == [1]
