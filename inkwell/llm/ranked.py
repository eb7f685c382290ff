"""Ranked lexical search by a bit-sliced impact index.

1. Index: each task packs its documents, whole texts, into blocks of bounded
   size, sorted by id. A block is one row of a table in the shared folder: its
   ids and sizes, and its terms with the documents that hold them and how
   often. Every term of every row is indexed; no text moves.
2. Statistics: document counts of the queries' terms, and the corpus's
   documents and words, are sums over the blocks' counts.
3. Search: queries travel in batches of bounded size to the blocks. A block
   raises the postings of a query's terms to bitmaps, one for each bit of the
   impacts (bit p of document d's impact is bit d of bitmap p). Impacts add up
   in carry arithmetic, a machine word of documents at once, for all queries
   of a group together. The best k are found from the most significant bitmap
   down: as long as the documents that have the bit are too many they are all
   that can win, else they have won; ties go by ascending id.
4. A task folds its blocks' winners; two ranks (by query and part, then by
   query) merge the tasks'.

Defined cases: a null text has no terms; each row is a document and each row of
the queries is a query, so repeated ids are answered row by row; of equal
scores the smaller id comes first, null ids last; queries without known terms
and documents without score give no rows; empty tables give no rows; extra
columns are ignored.
"""

from __future__ import annotations

import heapq
import math
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from inkwell.llm.common import WORD_TABLE, only, out, texts
from inkwell.session import materialize, shared_dir, ship, table

TOP = 10
#: A block ends with so many documents or so many bytes of text.
BLOCK_DOCS, BLOCK_BYTES = 8192, 16 << 20
#: Terms of the queries that travel to the tasks at once (a single query may exceed it).
BATCH_TERMS = 1 << 17
#: Queries that add up together, and their terms that are raised to bitmaps at once.
TOGETHER, STEPS = 64, 16
#: Parts in which a query's winners are ranked before they meet.
PARTS = 64

INDEX = "ids array<long>, sizes array<long>, terms array<binary>, held array<int>, places array<int>, times array<int>, n_docs long, n_words long"
_INDEX = pa.schema(
    [("ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())), ("terms", pa.list_(pa.binary()))]
    + [(c, pa.list_(pa.int32())) for c in ("held", "places", "times")]
    + [("n_docs", pa.int64()), ("n_words", pa.int64())]
)


def terms_of(text: bytes | None) -> list[bytes]:
    """The terms of a text in order."""
    return (text or b"").translate(WORD_TABLE).split()


class _Block:
    """Documents of a block that is being filled."""

    def __init__(self):
        self.ids, self.sizes, self.bytes, self.vocabulary = [], [], 0, {}
        self.terms, self.times, self.distinct = [], [], []

    def add(self, doc_id: int | None, text: bytes | None) -> None:
        counts = Counter(terms_of(text))
        v = self.vocabulary
        self.ids.append(doc_id)
        self.sizes.append(sum(counts.values()))
        self.bytes += len(text or b"")
        self.terms.append(np.fromiter((v.setdefault(t, len(v)) for t in counts), np.int32, len(counts)))
        self.times.append(np.fromiter(counts.values(), np.int32, len(counts)))
        self.distinct.append(len(counts))

    def full(self) -> bool:
        return len(self.ids) >= BLOCK_DOCS or self.bytes >= BLOCK_BYTES

    def row(self) -> pa.RecordBatch:
        """The block with its documents by ascending id (nulls last) and its postings by term and document."""
        order = sorted(range(len(self.ids)), key=lambda k: (self.ids[k] is None, self.ids[k] or 0, k))
        place = np.empty(len(order), np.int32)
        place[order] = np.arange(len(order), dtype=np.int32)
        terms, places, times = np.concatenate(self.terms), np.repeat(place, self.distinct), np.concatenate(self.times)
        by = np.lexsort((places, terms))
        return out(
            _INDEX,
            {
                "ids": [[self.ids[k] for k in order]],
                "sizes": [[self.sizes[k] for k in order]],
                "terms": [list(self.vocabulary)],
                "held": [np.bincount(terms, minlength=len(self.vocabulary)).astype(np.int32)],
                "places": [places[by]],
                "times": [times[by]],
                "n_docs": [sum(n > 0 for n in self.sizes)],
                "n_words": [sum(self.sizes)],
            },
        )


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The index (INDEX) of all rows, a row for each block, in the shared folder."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = _Block()
        for part, all_texts in texts(batches):
            for doc_id, text in zip(part.column(0).to_pylist(), all_texts, strict=True):
                block.add(doc_id, text)
                if block.full():
                    yield block.row()
                    block = _Block()
        if block.ids:
            yield block.row()

    spark = docs.sparkSession
    path = f"{shared_dir(spark)}/inkwell/impact_index-{uuid.uuid4().hex}"
    blocks = only(docs, doc_id=id_col, text=text_col).mapInArrow(run, INDEX)
    # a row group each: neither writer nor reader decodes more than a block at once, and files of many blocks are dealt to several tasks
    blocks.write.option("parquet.block.row.count.limit", "1").parquet(path)
    return spark.read.schema(INDEX).parquet(path)


def queries_of(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """query, item_id, terms array<binary>: each row's distinct terms, written so that its number stays."""
    ship(items.sparkSession)
    schema = pa.schema([("query", pa.int64()), ("item_id", pa.int64()), ("terms", pa.list_(pa.binary()))])

    def run(batches):
        for part, all_texts in texts(batches):
            yield out(schema, {"query": part.column(0), "item_id": part.column(1), "terms": [sorted(set(terms_of(t))) for t in all_texts]})

    rows = only(items, item_id=id_col, text=text_col).select(F.monotonically_increasing_id().alias("query"), "item_id", "text")
    return materialize(rows.mapInArrow(run, "query long, item_id long, terms array<binary>"), "queries")


def weigh(queries: DataFrame, index: DataFrame) -> tuple[DataFrame, int, int]:
    """(query, item_id, terms, dfs of the terms that some document holds; N; L)."""
    n, words = index.agg(F.sum("n_docs"), F.sum("n_words")).first()
    wanted = queries.select("query", F.explode("terms").alias("term"))
    held = index.select(F.explode(F.arrays_zip("terms", "held")).alias("e")).select(F.col("e.terms").alias("term"), F.col("e.held").alias("held"))
    df = held.join(wanted.select("term").distinct(), "term", "left_semi").groupBy("term").agg(F.sum("held").alias("df"))
    listed = wanted.join(df, "term").groupBy("query").agg(F.array_sort(F.collect_list(F.struct("term", "df"))).alias("t"))
    weighed = queries.select("query", "item_id").join(listed, "query").select("query", "item_id", F.col("t.term").alias("terms"), F.col("t.df").alias("dfs"))
    return materialize(weighed, "weighed"), n or 0, words or 0


def weight(df: int, n: int) -> int:
    return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


def impacts(weights: np.ndarray, times: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What a term adds to a document's score, in whole numbers."""
    t = times.astype(np.int64)
    return weights * ((1_000_000_000 * t) // (1000 * t + 8 * m))


def lengths(sizes: np.ndarray, n: int, words: int) -> np.ndarray:
    """m of documents of these sizes; exact where 64 bits don't hold the product."""
    if not len(sizes) or not words:
        return np.full(len(sizes), 10, np.int64)
    if 90 * n * int(sizes.max()) < 1 << 62:
        return 10 + (90 * n * sizes.astype(np.int64)) // words
    return np.array([10 + 90 * n * s // words for s in sizes.tolist()], np.int64)


def sliced(terms: np.ndarray, places: np.ndarray, values: np.ndarray, n_terms: int, words: int) -> np.ndarray:
    """[bit, term, word]: the bitmaps of values; terms and places ascend."""
    bits = int(values.max(initial=0)).bit_length()
    s = np.zeros((bits, n_terms, words), np.uint64)
    if len(values):
        word = places >> 6
        first = np.flatnonzero(np.r_[True, (np.diff(terms) != 0) | (np.diff(word) != 0)])
        shift, v = (places & 63).astype(np.uint64), values.astype(np.uint64)
        for p in range(bits):
            s[p, terms[first], word[first]] = np.bitwise_or.reduceat((v >> np.uint64(p) & np.uint64(1)) << shift, first)
    return s


def add(total: np.ndarray, rows: int, more: np.ndarray) -> None:
    """total[:, :rows] += more, both [bit, query, word], by full adders; total has room for the carry."""
    carry = np.zeros_like(total[0, :rows])
    for p, b in enumerate(more):
        a = total[p, :rows]
        half = a ^ b
        total[p, :rows], carry = half ^ carry, (a & b) | (carry & half)
    for p in range(len(more), len(total)):
        if not carry.any():
            break
        a = total[p, :rows]
        total[p, :rows], carry = a ^ carry, a & carry


def best(total: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(sure, tied): bitmaps [query, word] of the documents among the best k, and of those that tie for what is left."""
    tied = np.bitwise_or.reduce(total, 0)
    sure = np.zeros_like(tied)
    for plane in total[::-1]:
        with_bit = tied & plane
        n = np.bitwise_count(sure | with_bit).sum(1, dtype=np.int64)
        over = (n > k)[:, None]
        sure = np.where(over, sure, sure | with_bit)
        tied = np.where(over, with_bit, tied & ~plane)
    return sure, tied


def _places(bitmap: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))


class Block:
    """One block of the index, open for search."""

    def __init__(self, ids: list, sizes: np.ndarray, terms: list[bytes], held: np.ndarray, places: np.ndarray, times: np.ndarray, n: int, words: int):
        self.ids, self.places, self.times = ids, places, times
        self.term = {t: k for k, t in enumerate(terms)}
        self.starts = np.r_[0, np.cumsum(held, dtype=np.int64)]
        self.m = lengths(sizes, n, words)
        self.words = -(-len(ids) // 64)

    def postings(self, terms: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(position in terms, place, impact) of the postings of terms."""
        n = self.starts[terms + 1] - self.starts[terms]
        of = np.repeat(np.arange(len(terms)), n)
        at = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n) + self.starts[terms][of]
        places = self.places[at]
        return of, places, impacts(weights[of], self.times[at], self.m[places])

    def search(self, queries: list[tuple[list[bytes], list[int]]], k: int) -> Iterator[list[tuple[int, int]]]:
        """For each query (terms, weights) its best (place, score), best first."""
        known = [[(self.term[t], w) for t, w in zip(*q, strict=True) if w and t in self.term] for q in queries]
        for at in range(0, len(known), TOGETHER):
            group = known[at : at + TOGETHER]
            order = sorted(range(len(group)), key=lambda i: -len(group[i]))
            total = self._added([group[i] for i in order])
            sure, tied = best(total, k)
            found = {i: self._chosen(total[:, row], sure[row], tied[row], k) for row, i in enumerate(order)}
            yield from (found[i] for i in range(len(group)))

    def _added(self, group: list[list[tuple[int, int]]]) -> np.ndarray:
        """[bit, query, word] of the sums of a group, longest query first."""
        highest = max((sum(w for _, w in q) for q in group), default=0) * 1_000_000  # no impact exceeds weight * 10^6
        total = np.zeros((max(1, highest.bit_length()), len(group), self.words), np.uint64)
        longest = len(group[0]) if group else 0
        for low in range(0, longest, STEPS):
            part = [q[low : low + STEPS] for q in group]
            weights = dict(x for q in part for x in q)
            terms = np.array(sorted(weights), np.int64)
            of, places, values = self.postings(terms, np.array([weights[t] for t in terms.tolist()], np.int64))
            s = sliced(of, places, values, len(terms), self.words)
            row = {t: i for i, t in enumerate(terms.tolist())}
            for step in range(max(map(len, part))):
                picked = [row[q[step][0]] for q in part if len(q) > step]
                add(total, len(picked), s[:, picked])
        return total

    def _chosen(self, planes: np.ndarray, sure: np.ndarray, tied: np.ndarray, k: int) -> list[tuple[int, int]]:
        won = _places(sure)
        places = np.r_[won, _places(tied)[: k - len(won)]]
        bits = planes[:, places >> 6] >> (places & 63).astype(np.uint64) & np.uint64(1)
        scores = (bits.astype(np.int64) << np.arange(len(planes))[:, None]).sum(0)
        return sorted(zip(places.tolist(), scores.tolist(), strict=True), key=lambda x: (-x[1], x[0]))


def _open(batch: pa.RecordBatch, row: int, n: int, words: int) -> Block:
    whole = lambda c: batch.column(c)[row].values.to_numpy(zero_copy_only=False)
    return Block(batch.column("ids")[row].as_py(), whole("sizes"), batch.column("terms")[row].as_py(), whole("held"), whole("places"), whole("times"), n, words)


def _batches(weighed: DataFrame) -> Iterator[list]:
    """The queries in runs of about BATCH_TERMS terms; no more than one run is on the driver."""
    held, terms = [], 0
    for r in weighed.toLocalIterator():
        if held and terms + len(r["terms"]) > BATCH_TERMS:
            yield held
            held, terms = [], 0
        held.append(r)
        terms += len(r["terms"])
    if held:
        yield held


_FOUND = pa.schema([("query", pa.int64()), ("item_id", pa.int64()), ("part", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])


def _searched(index: DataFrame, rows: list, n: int, words: int, k: int) -> DataFrame:
    """Each task's best k of every query of a batch."""
    queries = [(bytes_of(r["terms"]), [weight(df, n) for df in r["dfs"]]) for r in rows]
    held = index.sparkSession.sparkContext.broadcast((queries, [(r["query"], r["item_id"]) for r in rows]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, names = held.value
        tops = [[] for _ in asked]
        part = 0
        for batch in batches:
            for row in range(batch.num_rows):
                block = _open(batch, row, n, words)
                part = hash(block.ids[0])
                for i, found in enumerate(block.search(asked, k)):
                    if found:
                        mine = [(-score, block.ids[p] is None, block.ids[p] or 0) for p, score in found]
                        tops[i] = heapq.nsmallest(k, tops[i] + mine)
        flat = [(*names[i], part % PARTS, None if no_id else doc_id, -score) for i, top in enumerate(tops) for score, no_id, doc_id in top]
        if flat:
            yield out(_FOUND, dict(zip(_FOUND.names, zip(*flat, strict=True), strict=True)))

    found = index.select("ids", "sizes", "terms", "held", "places", "times").mapInArrow(run, "query long, item_id long, part long, doc_id long, score long")
    return materialize(found, "found")


def bytes_of(values: list) -> list[bytes]:
    return [bytes(v) for v in values]


def search(docs: DataFrame, items: DataFrame, k: int = TOP, doc_id: str = "doc_id", doc_text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """item_id, rank, doc_id, score: each item's k highest-scoring documents."""
    return search_index(build_index(docs, doc_id, doc_text), queries_of(items, item_id, item_text), k)


def search_index(index: DataFrame, queries: DataFrame, k: int = TOP) -> DataFrame:
    """The same of an index that is already there and of queries_of."""
    weighed, n, words = weigh(queries, index)
    found = index.sparkSession.createDataFrame([], "query long, item_id long, part long, doc_id long, score long")
    for rows in _batches(weighed):
        found = found.unionByName(_searched(index, rows, n, words, k))
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    rank = F.row_number()
    of_part = found.withColumn("rank", rank.over(W.partitionBy("query", "part").orderBy(*order))).where(F.col("rank") <= k)
    ranked = of_part.withColumn("rank", rank.over(W.partitionBy("query").orderBy(*order))).where(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")


def op11_ranked_search(spark, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_TERMS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
OP11_SQL = rf"""
WITH d AS (SELECT doc_id, {_TERMS} AS ts FROM documents),
p AS (SELECT doc_id, len(ts)::BIGINT AS n, t, count(*) AS tf FROM (SELECT doc_id, ts, unnest(ts) AS t FROM d) GROUP BY doc_id, ts, t),
c AS (SELECT count(*) FILTER (len(ts) > 0) AS nn, sum(len(ts))::BIGINT AS ll FROM d),
w AS (SELECT t, floor(1000 * ln((2 * nn + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM p, c GROUP BY t, nn),
q AS (SELECT DISTINCT item_id, t FROM (SELECT item_id, unnest({_TERMS}) AS t FROM benchmark)),
s AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * nn) // ll))))::BIGINT AS score
  FROM q JOIN p USING (t) JOIN w USING (t), c GROUP BY item_id, doc_id),
r AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, doc_id, score FROM s WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM r WHERE rank <= 10
"""
