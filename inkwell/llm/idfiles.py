"""Token-id files: documents' ids in blocks of an adaptive range coder (`idcoder`).

A file is a Parquet table in the shared folder, one row a segment: whole
documents in order, the number of ids of each, and the blocks. Spark's
committer makes the write whole when executors are lost. Documents are dealt
and sorted by id, so partitions, segments and documents follow each other; a
segment knows the ids before it in its partition, and prefix sums over the
partitions' totals give places in the whole stream.

A long text is turned to ids piece by piece, cut where the tokenizer's pattern
begins a match whatever stands around, and its ids are coded as they come; a
long segment is read a group of blocks at a time.

Defined cases: a null text is empty and has the end id alone; rows that repeat
an id stand in an order that a hash of their texts decides, then the texts; null
ids come first; an added token in a text is what the library, as it is loaded,
makes of it; a document longer than a segment ends a segment; an empty table
gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import json
import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from inkwell.llm.common import only, out, texts
from inkwell.llm.idcoder import decoded_groups, encode_blocks
from inkwell.session import ship, shared_dir, table

#: Ids after which a segment ends with its document.
SEGMENT = 1 << 22
#: Bytes of a long text that are turned to ids at once.
PIECE = 1 << 22
#: Texts that are turned to ids at once, of PIECE bytes at most: of more texts, fewer pre-tokens are looked up again.
ROWS = 1 << 14
#: Pre-tokens that a worker remembers (twice as many before the ones used last stay), and bytes of one with its length.
CACHE, WIDTH = 400_000, 24
#: Unknown pre-tokens that the library's model is asked for in one call.
TOGETHER = 64
END = 2

# Classes of Latin-1 characters in the tokenizer's pattern: others, letters, numbers, blanks.
_OTHER, _LETTER, _NUMBER, _BLANK, _WALL = range(5)
_CLASS = np.array([_LETTER if (c := chr(k)).isalpha() else _NUMBER if c.isnumeric() else _BLANK if k in (*range(9, 14), 32, 133, 160) else _OTHER for k in range(256)], np.uint8)
#: Before the blank between two letters a match begins, whatever stands around.
_SAFE = re.compile(rb"[A-Za-z](?= [A-Za-z])")
# The endings that the pattern keeps with their apostrophe.
_ENDINGS = (b"s", b"t", b"re", b"ve", b"m", b"ll", b"d")


def split_latin(text: np.ndarray, walls: np.ndarray) -> np.ndarray:
    """Where the pattern's matches begin in Latin-1 texts that stand one behind the other.

    walls: the place behind each text, where any character stands; it counts
    as a match of its own. The pattern in words: runs of letters, of numbers
    or of other marks take one blank before them; an apostrophe that begins a
    match takes an ending; blanks are a match but for the last before a match.
    """
    kind = _CLASS[text]
    kind[walls] = _WALL
    starts = np.ones(len(text), bool)
    np.not_equal(kind[1:], kind[:-1], out=starts[1:])
    blank = kind == _BLANK
    # the last blank before something of a text is a match of its own, or, if a space, part of the next
    last = np.flatnonzero(blank[:-1] & ~blank[1:] & (kind[1:] != _WALL))
    starts[last] = True
    starts[last[text[last] == 32] + 1] = False
    marks = np.flatnonzero(text == 39)
    marks = marks[starts[marks]]
    if len(marks):
        padded = np.append(text, np.zeros(2, np.uint8))
        for ending in _ENDINGS:
            found = marks
            for k, c in enumerate(ending, 1):
                found = found[padded[found + k] == c]
            if len(found):
                starts[found + 1] = False
                ends = found + len(ending) + 1
                starts[ends] = True
    starts[walls] = True
    return np.flatnonzero(starts)


def pieces(text: bytes, size: int = PIECE) -> Iterator[bytes]:
    """A long text in pieces whose ids, one behind the other, are those of the text."""
    at = 0
    while len(text) - at > size and (m := _SAFE.search(text, at + size)):
        yield text[at : m.end()]
        at = m.end()
    yield text[at:]


class _Memory:
    """Short words and their ids: found by a hash, compared by all bytes. Of too many, the ones used last stay."""

    def __init__(self):
        self.hashes, self.places = np.zeros(1, np.uint64), np.zeros(1, np.int64)  # ascending, and where the word of each stands
        self.words = np.zeros((1, WIDTH // 8), np.uint64)  # the first is no word
        self.n, self.first, self.used, self.now = np.zeros(1, np.int64), np.zeros(1, np.int64), np.zeros(1, np.int64), 0
        self.ids = np.empty(0, "<u4")

    @staticmethod
    def rows(lengths: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Words that stand one behind the other as rows of WIDTH bytes, the last their length, and which are short enough."""
        short = lengths < WIDTH
        rows = np.zeros((len(lengths), WIDTH), np.uint8)
        rows[(np.arange(WIDTH) < lengths[:, None]) & short[:, None]] = text if short.all() else text[np.repeat(short, lengths)]
        rows[:, -1] = np.minimum(lengths, 255)
        return rows.view(np.uint64), short

    @staticmethod
    def _hashed(rows: np.ndarray) -> np.ndarray:
        h = np.zeros(len(rows), np.uint64)
        for column in rows.T:
            h = (h ^ column) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        return h

    def find(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The place of each word, and whether it is the word's."""
        h = self._hashed(rows)
        order = np.argsort(h)
        at = np.empty(len(h), np.int64)
        at[order] = np.searchsorted(self.hashes, h[order])
        at = self.places.take(at, mode="clip")
        known = (self.words.take(at, 0) == rows).all(1)
        self.now += 1
        self.used[at[known]] = self.now
        return at, known

    def add(self, rows: np.ndarray, ids: np.ndarray, n: np.ndarray) -> None:
        """New words; of two with one hash the first stays, the other remains unknown."""
        h, which = np.unique(self._hashed(rows), return_index=True)
        at = np.searchsorted(self.hashes, h)
        new = self.hashes.take(at, mode="clip") != h
        self.hashes, self.places = np.insert(self.hashes, at[new], h[new]), np.insert(self.places, at[new], which[new] + len(self.n))
        self.words, self.n, self.ids = np.concatenate([self.words, rows]), np.concatenate([self.n, n]), np.concatenate([self.ids, ids])
        self.used = np.append(self.used, np.full(len(n), self.now))
        if len(self.n) > 2 * CACHE:
            keep = np.zeros(len(self.n), bool)
            keep[np.argpartition(-self.used, CACHE)[:CACHE]] = True
            stay = keep[self.places]
            self.hashes, self.places = self.hashes[stay], (np.cumsum(keep) - 1)[self.places[stay]]
            self.words, self.ids, self.n, self.used = self.words[keep], self.ids[np.repeat(keep, self.n)], self.n[keep], self.used[keep]
        self.first = np.cumsum(self.n) - self.n


class Tokenizer:
    """Ids by the tokenizers library, as it is loaded.

    Texts in Latin-1 that hold no added token are split here, all texts of a
    batch at once; each distinct pre-token then asks the library's model once
    for a while, many in one call. Any other text goes to the library whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer as Library

        self.library = Library.from_file(path)
        self.added = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.memory = _Memory()
        # byte-level alphabet: bytes that print stand for themselves, the others for code points from 256 on
        others = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or b >= 174)]
        self.alphabet = np.arange(256, dtype="<u2")
        self.alphabet[others] = 256 + np.arange(len(others))
        self.joint, self.joint_id = self._joint()

    def _joint(self) -> tuple[bytes | None, int]:
        """A byte of ASCII that no merge of the model holds, and its id: merges don't reach from one side of it to the other."""
        model = json.loads(self.library.to_str())["model"]
        if model["type"] == "BPE" and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")):
            merged = set("".join(map("".join, model["merges"])))
            for b, c in enumerate(map(chr, self.alphabet[:128].tolist())):
                if c not in merged and c in model["vocab"]:
                    return bytes([b]), model["vocab"][c]
        return None, -1

    def _made(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of pre-tokens by the library's model, many in one call with the joint behind each, and how many each has."""
        ids: list[int] = []
        for a in range(0, len(words), TOGETHER):
            some = words[a : a + TOGETHER]
            joined = self.joint and self.joint.join([*some, b""])
            if joined and joined.count(self.joint) == len(some):
                ids += self._asked(joined)
                continue
            for word in some:  # the joint within a word ends nothing
                ids += [-2 if x == self.joint_id else x for x in self._asked(word)]
                ids.append(self.joint_id)
        made = np.array(ids, np.int64)
        ends = np.flatnonzero(made == self.joint_id)
        made = np.delete(made, ends)
        made[made == -2] = self.joint_id
        return made.astype("<u4"), np.diff(ends, prepend=-1) - 1

    def _asked(self, text: bytes) -> list[int]:
        """What the library's model makes of a text in Latin-1."""
        mapped = self.alphabet[np.frombuffer(text.decode("latin-1").encode(), np.uint8)].tobytes().decode("utf-16-le")
        return [x.id for x in self.library.model.tokenize(mapped)]

    def encode_batch(self, many: list[str], end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one behind the other, each with the end id, and how many each has."""
        tail = np.array([] if end is None else [end], "<u4")
        plain: dict[int, bytes] = {}
        for k, t in enumerate(many):
            if not any(a in t for a in self.added):
                try:
                    plain[k] = t.encode("latin-1")
                except UnicodeEncodeError:
                    continue
        ids, lengths = self._plain(list(plain.values()), tail)
        if len(plain) == len(many):
            return ids, lengths
        cut = dict(zip(plain, np.split(ids, np.cumsum(lengths)[:-1]), strict=True)) if plain else {}
        each = [cut[k] if k in cut else np.concatenate([np.array(self.library.encode(t, add_special_tokens=False).ids, "<u4"), tail]) for k, t in enumerate(many)]
        return np.concatenate(each), np.array([len(x) for x in each], np.int64)

    def _plain(self, many: list[bytes], tail: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not many:
            return np.empty(0, np.uint32), np.empty(0, np.int64)
        joined = b"\n".join(many) + b"\n"
        walls = np.cumsum([len(t) + 1 for t in many]) - 1
        starts = split_latin(np.frombuffer(joined, np.uint8), walls)
        offsets = np.append(starts, len(joined)).astype(np.int32)
        words = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(joined)]).dictionary_encode()
        _, cuts, distinct = words.dictionary.buffers()
        size = len(words.dictionary)
        cuts, distinct = np.frombuffer(cuts, np.int32)[: size + 1], np.frombuffer(distinct, np.uint8)
        rows, short = _Memory.rows(np.diff(cuts), distinct[: cuts[-1]])
        memory = self.memory
        at, known = memory.find(rows)
        unknown = np.flatnonzero(~known)
        whole = distinct.tobytes()
        made, n_made = self._made([whole[a:z] for a, z in zip(cuts[unknown].tolist(), cuts[unknown + 1].tolist(), strict=True)])
        # what is remembered, what is new, the end id
        pool = np.concatenate([memory.ids, made, tail])
        first, counts = np.append(memory.first.take(at), len(pool) - len(tail)), np.append(memory.n.take(at), len(tail))
        first[unknown], counts[unknown] = len(memory.ids) + np.cumsum(n_made) - n_made, n_made
        kept = short[unknown]
        memory.add(rows[unknown[kept]], made[np.repeat(kept, n_made)], n_made[kept])
        at_wall = np.searchsorted(starts, walls)
        which = words.indices.to_numpy().astype(np.int64)
        which[at_wall] = size
        n = counts.take(which)
        ends = np.cumsum(n)
        at = np.repeat((first.take(which) - (ends - n)).astype(np.int32), n)
        at += np.arange(len(at), dtype=np.int32)
        ids = pool.take(at)
        return ids, np.diff(ends[at_wall], prepend=0)


_TOKENIZERS: dict[str, Tokenizer] = {}


def tokenizer(path: str) -> Tokenizer:
    """One tokenizer for a worker process, so that its cache lasts."""
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = Tokenizer(path)
    return _TOKENIZERS[path]


_FILE = pa.schema([("part", pa.int32()), ("segment", pa.int32()), ("before", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("n_ids", pa.int64()), ("blocks", pa.list_(pa.binary()))])
_FILE_DDL = "part int, segment int, before long, doc_ids array<long>, lengths array<long>, n_ids long, blocks array<binary>"


class _Segment:
    """The row under way: documents that ended, their blocks, and ids that wait to be coded."""

    def __init__(self, part: int):
        self.part, self.number, self.before = part, 0, 0
        self._begin()

    def _begin(self) -> None:
        self.doc_ids, self.lengths, self.blocks, self.held, self.waiting, self.total = [], [], [], [], 0, 0

    def add(self, ids: np.ndarray) -> None:
        self.held.append(ids)
        self.waiting += len(ids)
        self.total += len(ids)
        if self.waiting >= SEGMENT:
            self._code()

    def _code(self) -> None:
        if self.waiting:
            self.blocks += encode_blocks(np.concatenate(self.held))
            self.held, self.waiting = [], 0

    def end(self, doc_id: int | None, length: int) -> bool:
        """A document ends; whether the segment does too."""
        self.doc_ids.append(doc_id)
        self.lengths.append(length)
        return self.total >= SEGMENT

    def row(self) -> pa.RecordBatch:
        self._code()
        done = {"part": [self.part], "segment": [self.number], "before": [self.before], "doc_ids": [self.doc_ids], "lengths": [self.lengths], "n_ids": [self.total], "blocks": [self.blocks]}
        self.number, self.before = self.number + 1, self.before + self.total
        self._begin()
        return out(_FILE, done)


def write_ids(docs: DataFrame, path: str, to: str, end: int = END, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write every document's ids, with the end id, in ascending order of doc_id."""
    ship(docs.sparkSession)

    def run(batches):
        t, segment = tokenizer(path), _Segment(TaskContext.get().partitionId())
        for batch, all_texts in texts(batches, rows=ROWS):
            doc_ids = batch.column(0).to_pylist()
            for a, z in _runs([len(x or b"") for x in all_texts]):
                if z - a == 1:
                    n = 0
                    for piece in pieces(all_texts[a] or b""):
                        ids, _ = t.encode_batch([piece.decode("utf-8", "replace")])
                        n += len(ids)
                        segment.add(ids)
                    segment.add(np.array([end], np.uint32))
                    if segment.end(doc_ids[a], n + 1):
                        yield segment.row()
                    continue
                ids, lengths = t.encode_batch([(x or b"").decode("utf-8", "replace") for x in all_texts[a:z]], end)
                at = 0
                for doc_id, n in zip(doc_ids[a:z], lengths.tolist(), strict=True):
                    segment.add(ids[at : at + n])
                    at += n
                    if segment.end(doc_id, n):
                        yield segment.row()
        if segment.doc_ids:
            yield segment.row()

    d = only(docs, doc_id=id_col, text=text_col)
    dealt = d.repartitionByRange(F.col("doc_id"), F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"), "text")
    dealt.mapInArrow(run, _FILE_DDL).write.parquet(to)


def _runs(sizes: list[int]) -> Iterator[tuple[int, int]]:
    """Runs of texts of PIECE bytes at most, or one longer text."""
    a, total = 0, 0
    for k, n in enumerate(sizes):
        if k > a and total + n > PIECE:
            yield a, k
            a, total = k, 0
        total += n
    if sizes:
        yield a, len(sizes)


_READ = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])


def read_checks(spark, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document in the files."""
    files = spark.read.schema(_FILE_DDL).parquet(path)
    # one row a partition of the write: as many as its shuffle had, whatever the input
    totals = files.groupBy("part").agg(F.sum("n_ids").alias("n"))
    earlier = F.sum("n").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    parts = totals.select("part", F.coalesce(earlier, F.lit(0)).alias("of_part"))
    placed = files.join(F.broadcast(parts), "part").select("doc_ids", "lengths", (F.col("of_part") + F.col("before")).alias("start"), "blocks")

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                doc_ids, lengths, start = (batch.column(c)[k].as_py() for c in range(3))
                ends, checks, d, seen = np.cumsum(lengths), [0] * len(lengths), 0, 0
                for ids in decoded_groups(batch.column(3)[k].as_py()):
                    ids, at = ids.astype("<u4"), 0
                    while at < len(ids) and d < len(lengths):
                        n = min(len(ids) - at, int(ends[d]) - seen)
                        checks[d] = zlib.crc32(ids[at : at + n], checks[d])
                        at, seen = at + n, seen + n
                        d += seen == ends[d]
                    if at < len(ids):
                        break
                if d < len(lengths) or at < len(ids):
                    raise ValueError("a segment has other ids than its documents")
                yield out(_READ, {"doc_id": doc_ids, "start": start + ends - lengths, "n_tokens": lengths, "ids_crc32": checks})

    return placed.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op7_token_id_files(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    to = f"{shared_dir(spark)}/inkwell/ids-{uuid.uuid4().hex}"
    write_ids(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), to)
    return read_checks(spark, to)
