"""Byte-level BPE by a hierarchical-bitmap rank queue.

The symbols of a text stand in a linked list. Every pair that can merge lies in
the bucket of its merge's rank; a bitmap over the ranks, with a bitmap over its
words and another over those, tells the least rank that is not empty by three
find-first-set steps. A merge takes the leftmost position of that bucket, joins
the two symbols and files the new pairs left and right; entries whose pair has
changed since are stale and skipped. Each merge costs the same however long the
list is, so a pre-token of millions of bytes is no special case.

The pre-tokens of several texts that are not yet in the cache share one list,
with walls between them, so that short ones don't pay for a queue each.

Defined cases: a null text is empty; an empty text has no ids, hashes are those
of the empty string; strings of special tokens are ordinary text; the leftmost
of equal ranks merges first; repeated rows are answered one by one; an empty
table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterable
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from inkwell.llm.common import only, out, texts
from inkwell.session import ship, table

#: Pre-tokens that a worker remembers, and the longest of them in code points.
CACHE, LONGEST = 400_000, 64
#: Pre-tokens that are merged in one list.
TOGETHER = 4_096

# Letters of the fast pattern, ASCII and Latin-1, and what isn't covered by it.
_LATIN = "A-Za-zªµºÀ-ÖØ-öø-ÿ"
_BEYOND = re.compile("[\x1c-\x1f\x85²³¹¼-¾Ā-\U0010ffff]")


_BLANK = r"[ \t-\r\xa0]"
#: The pattern's matches in Latin text.
split_latin = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LATIN}]+| ?[0-9]+| ?[^ \t-\r\xa0{_LATIN}0-9]+|{_BLANK}+(?![^ \t-\r\xa0])|{_BLANK}+").findall


def latin_only(text: str) -> bool:
    return not _BEYOND.search(text)


class RankQueue:
    """Buckets of positions by rank under three levels of bitmaps of 64 bits."""

    __slots__ = ("buckets", "low", "middle", "top")

    def __init__(self, ranks: int):
        n = (ranks >> 6) + 1
        self.buckets: dict[int, list[int]] = {}
        self.low, self.middle, self.top = [0] * n, [0] * ((n >> 6) + 1), 0

    def fresh(self, rank: int, position: int) -> None:
        """Begin a bucket."""
        self.buckets[rank] = [position]
        self._mark(rank)

    def _mark(self, rank: int) -> None:
        a = rank >> 6
        b = a >> 6
        self.low[a] |= 1 << (rank & 63)
        self.middle[b] |= 1 << (a & 63)
        self.top |= 1 << b

    def least(self) -> int:
        """The least rank that has positions, or -1."""
        if not self.top:
            return -1
        b = (self.top & -self.top).bit_length() - 1
        w = self.middle[b]
        a = b << 6 | (w & -w).bit_length() - 1
        w = self.low[a]
        return a << 6 | (w & -w).bit_length() - 1

    def put_back(self, rank: int, positions: list[int]) -> None:
        if positions:
            self.buckets[rank] = positions
            self._mark(rank)

    def take(self, rank: int) -> list[int]:
        """Take a bucket out. No merge files a pair of its own rank: what it makes is longer."""
        a = rank >> 6
        self.low[a] &= ~(1 << (rank & 63))
        if not self.low[a]:
            b = a >> 6
            self.middle[b] &= ~(1 << (a & 63))
            if not self.middle[b]:
                self.top &= ~(1 << b)
        return self.buckets.pop(rank)


class Encoder:
    """Ranks, the pairs that make each, and a cache of pre-tokens."""

    def __init__(self, path: str, pattern: str):
        self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in open(path, "rb") if line.strip())}
        self.bytes_of = {i: t for t, i in self.ranks.items()}
        self.size = max(self.bytes_of) + 1
        self.byte_ids = [self.ranks[bytes([b])] for b in range(256)]
        # left id * (size + 1) + right id -> id of the two joined
        self.pairs: dict[int, int] = {}
        for token, i in self.ranks.items():
            for cut in range(1, len(token)):
                left, right = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if left is not None and right is not None:
                    self.pairs[left * (self.size + 1) + right] = i
        self.pattern = regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))
        self.decimal = [str(i) for i in range(self.size)]
        self.cache: dict[str, tuple[int, ...]] = {}

    def split(self, text: str) -> list[str]:
        """The matches of the pattern; Latin text takes an equal, faster one."""
        return self.pattern.findall(text) if _BEYOND.search(text) else split_latin(text)

    def merge(self, pieces: list[bytes]) -> list[tuple[int, ...]]:
        """Ids of every piece, by one queue over all of them."""
        wall, stride, get = self.size, self.size + 1, self.pairs.get
        byte_ids, ranks = self.byte_ids, self.ranks
        done: list[tuple[int, ...]] = []
        sym: list[int] = []
        starts: list[tuple[int, int]] = []
        for k, piece in enumerate(pieces):
            whole = ranks.get(piece)
            done.append((whole,) if whole is not None else ())
            if whole is None:
                starts.append((k, len(sym)))
                sym += [byte_ids[b] for b in piece]
                sym.append(wall)
        if not starts:
            return done
        n = len(sym)
        prev, after = list(range(-1, n - 1)), list(range(1, n + 1))
        queue = RankQueue(self.size)
        buckets, fresh = queue.buckets, queue.fresh
        # the rank of the pair that begins at each position
        held = [get(a * stride + b) for a, b in zip(sym, sym[1:] + [wall], strict=True)]
        for p, r in enumerate(held):
            if r is not None:
                if r in buckets:
                    buckets[r].append(p)
                else:
                    fresh(r, p)
        while (rank := queue.least()) >= 0:
            bucket = queue.take(rank)
            bucket.sort()
            left = rank * stride
            for at, p in enumerate(bucket):
                if held[p] != rank:
                    continue  # stale
                q = after[p]
                z = after[q]
                sym[p] = rank
                held[q] = None
                after[p] = z
                prev[z] = p  # a wall stands behind the last symbol
                held[p] = r = get(left + sym[z])
                if r is not None:
                    if r in buckets:
                        buckets[r].append(p)
                    else:
                        fresh(r, p)
                lower = r
                o = prev[p]  # -1 at the first: the last symbol, which is a wall
                held[o] = r = get(sym[o] * stride + rank)
                if r is not None:
                    if r in buckets:
                        buckets[r].append(o)
                    else:
                        fresh(r, o)
                    if lower is None or r < lower:
                        lower = r
                if lower is not None and lower < rank:
                    queue.put_back(rank, bucket[at + 1 :])
                    break
        for k, p in starts:
            ids = []
            while (i := sym[p]) != wall:
                ids.append(i)
                p = after[p]
            done[k] = tuple(ids)
        return done

    def encode_batch(self, many: list[str]) -> Iterable[list[int]]:
        """Ids of each text."""
        split = [self.split(t) for t in many]
        cache = self.cache
        if len(cache) > CACHE:
            cache.clear()
        new = list({w for words in split for w in words if w not in cache})
        extra: dict[str, tuple[int, ...]] = {}
        for at in range(0, len(new), TOGETHER):
            part = new[at : at + TOGETHER]
            for w, ids in zip(part, self.merge([w.encode() for w in part]), strict=True):
                (cache if len(w) <= LONGEST else extra)[w] = ids
        find = cache.__getitem__ if not extra else lambda w: cache.get(w) or extra[w]
        for words in split:
            yield list(chain.from_iterable(map(find, words)))

    def encode(self, text: str) -> list[int]:
        return next(iter(self.encode_batch([text])))

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


_ENCODERS: dict[tuple[str, str], Encoder] = {}


def encoder(path: str, pattern: str) -> Encoder:
    """One encoder for a worker process, so that its cache lasts."""
    key = (path, pattern)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(path, pattern)
    return _ENCODERS[key]


_ARROW = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])
_WITH_IDS = _ARROW.append(pa.field("ids", pa.list_(pa.int32())))
_DDL = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def round_trip(docs: DataFrame, path: str, pattern: str, with_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode every text, decode the ids: doc_id, n_tokens, both hashes and perhaps the ids."""
    ship(docs.sparkSession)
    schema, ddl = (_WITH_IDS, _DDL + ", ids array<int>") if with_ids else (_ARROW, _DDL)

    def run(batches):
        e = encoder(path, pattern)
        for part, all_texts in texts(batches):
            n, ids_hash, text_hash, all_ids = [], [], [], []
            for ids in e.encode_batch([(t or b"").decode("utf-8", "replace") for t in all_texts]):
                n.append(len(ids))
                ids_hash.append(hashlib.sha256(" ".join(map(e.decimal.__getitem__, ids)).encode()).hexdigest())
                text_hash.append(hashlib.sha256(e.decode(ids)).hexdigest())
                if with_ids:
                    all_ids.append(pa.array(ids, pa.int32()))
            yield out(schema, {"doc_id": part.column(0), "n_tokens": n, "ids_sha256": ids_hash, "decoded_sha256": text_hash, "ids": all_ids})

    return only(docs, doc_id=id_col, text=text_col).mapInArrow(run, ddl)


def op5_bpe_round_trip(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
