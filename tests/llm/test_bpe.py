"""BPE against the tiktoken library, and round trips."""

import base64
import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from inkwell.llm import bpe
from tests.llm.helpers import documents

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def own():
    return bpe.encoder(PATH, public_tokenizers.PATTERN)


def texts(n=600):
    rng = random.Random(8)
    bits = ["the", " The", "ing", "'s", "'LL", "'re", " ", "  ", "\n", "\t", "\r\n", "\x0b", "\x1c", "\x85", "\xa0", "\u3000", "1", "²", "½", "½9", "é", "ß", "ñandú", "Дом", "日本語", "🙂", "👩‍👧", "é", "ʼ", "_", "--", "<|endoftext|>", "#$%", "x" * 40, "\x00", "İ", "ﬁ", "ª", "µ", "÷"]
    return ["".join(rng.choice(bits) for _ in range(rng.randrange(25))) for _ in range(n)]


def test_ids_equal_the_library(own, library):
    many = texts()
    got = list(own.encode_batch(many))
    for t, ids in zip(many, got, strict=True):
        assert ids == library.encode_ordinary(t), t
        assert own.decode(ids) == t.encode()


def test_long_pre_tokens(own, library):
    rng = random.Random(9)
    for t in ("a" * 30_000, "".join(rng.choice("abcdeortin") for _ in range(50_000)), " " * 20_000, "é" * 9_999, "ab" * 20_000 + "c"):
        assert own.encode(t) == library.encode_ordinary(t)


def test_queue_gives_the_least_rank():
    rng, q, held = random.Random(1), bpe.RankQueue(50_257), set()
    for _ in range(3000):
        if held and rng.random() < 0.5:
            assert q.least() == min(held)
            held.discard(q.least())
            q.take(q.least())
        else:
            r = rng.randrange(50_257)
            if r not in held:
                q.fresh(r, 0)
                held.add(r)
    while held:
        assert q.least() == min(held)
        held.discard(q.least())
        q.take(q.least())
    assert q.least() == -1


def test_cache_may_be_dropped(library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE", 3)
    monkeypatch.setattr(bpe, "TOGETHER", 5)
    e = bpe.Encoder(PATH, public_tokenizers.PATTERN)
    for at in range(0, 60, 7):
        part = texts(60)[at : at + 7]
        assert list(e.encode_batch(part)) == [library.encode_ordinary(t) for t in part]


def test_rows(spark, library):
    rows = [(k, t) for k, t in enumerate(texts(80))] + [(100, None), (101, ""), (3, "again"), (102, "word " * 200_000)]
    got = bpe.round_trip(documents(spark, rows, ("ids", "n_tokens")), PATH, public_tokenizers.PATTERN).collect()
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = []
    for i, t in rows:
        ids = library.encode_ordinary(t or "")
        want.append((i, len(ids), sha(" ".join(map(str, ids)).encode()), sha((t or "").encode())))
    assert sorted((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == sorted(want)
    assert bpe.round_trip(documents(spark, []), PATH, public_tokenizers.PATTERN).collect() == []
    ids = {r.doc_id: r.ids for r in bpe.round_trip(documents(spark, rows[:5]), PATH, public_tokenizers.PATTERN, with_ids=True).collect()}
    assert ids == {i: library.encode_ordinary(t) for i, t in rows[:5]}
