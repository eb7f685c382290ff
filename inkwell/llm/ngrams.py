"""N-gram Jaccard join by a count-vector R-tree.

A document's set holds the hashes of its distinct word n-grams. Two documents
link when their sets' Jaccard similarity reaches num / den.

1. Nodes: each text's set size and digest. Equal sets are one node, named by
   the smallest id.
2. Families: sizes fall into ranges; a range cuts the hash space into parts, so
   many that two linked sets must share whole parts. Each text names its
   longest parts (as many as the most that can differ, and one), and texts that
   name the same part are joined, by a star, to one family. No link leaves a
   family, and a family holds hardly more than near copies. A task folds
   repeated parts before the shuffle: of a part it sends its first text, and
   writes the links of the others to that one as they are. Parts chain texts of
   little in common to families that grow faster than the input; where it costs
   less, a family of several leaves is dealt out by its parts instead, of those
   with the same texts one. A link shares a part, so none is lost.
3. R-tree: in a family, the hashes of a set fall into GROUPS groups; the counts
   by group are its point. The points are packed into a tree whose nodes hold
   the largest counts and the range of sizes below. Two nodes, or two points,
   can link only when the sum over the groups of the smaller of both counts
   reaches the overlap that the similarity asks for; pairs that pass are
   verified on their sets, unless other links connect them already. A large
   family is cut into leaves of bounded size and joined leaf by leaf.
4. Components of the verified links.

Defined cases: a text without words, or null, has an empty set and is linked
with nothing; a text with fewer than n words has its whole sequence as one
n-gram; rows that repeat an id are one node, with the links of each, whichever
of its texts are equal to another id's; a row without id is a document that
links join like any other, so others may reach an id through it, and its
component is the smallest id that it reaches, null where that is none; an empty
table gives no rows; extra columns are ignored; long texts are read whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkwell.llm.common import LOWER_TABLE, SEEDS, filter_of, may_hold, named_rows, only, out, place, texts, without_rows
from inkwell.llm.graph import components
from inkwell.session import materialize, ship, table

#: Words of an n-gram and least similarity, where nothing else is asked for.
WORDS, NUM, DEN = 5, 80, 100
#: Coordinates of a point, and children of a node of the tree.
GROUPS, FAN = 24, 16
#: Points and hashes of a leaf of a large family, at most (one set may be larger).
LEAF_POINTS, LEAF_HASHES = 512, 1 << 20
#: Rows of parts that a task folds at once, and words whose hashes it remembers.
FOLD, WORDS_HELD = 1 << 18, 150_000

_M1, _M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_S31, _S29 = np.uint64(31), np.uint64(29)


class _WordHashes(dict):
    """A worker's memory of the hashes of words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORDS_HELD:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


_HASHES = _WordHashes()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> _S31) * _M2
    return (x ^ x >> _S29) * _M3


def ngram_set(text: bytes | None, n: int) -> np.ndarray:
    """The sorted distinct hashes of a text's word n-grams."""
    words = (text or b"").translate(LOWER_TABLE).split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
    width = min(n, len(words))
    total = h[: len(h) - width + 1] + np.uint64(width)
    for k in range(1, width):
        total = _mixed(total) + h[k : len(h) - width + 1 + k]
    return np.unique(_mixed(total))


def difference(size: int, num: int, den: int) -> int:
    """Hashes that may lie in one of two linked sets alone, one of them of this size."""
    return size * (den - num) // num


class Ranges:
    """Ranges of set sizes; a set's partners lie in its own range and its neighbours."""

    def __init__(self, num: int, den: int):
        self.num, self.den, self.bounds = num, den, [(1, 1)]

    def _grow(self, size: int) -> None:
        while self.bounds[-1][1] < size:
            low = self.bounds[-1][1] + 1
            self.bounds.append((low, low * self.den**2 // self.num**2))

    def of(self, size: int) -> list[tuple[int, int]]:
        """(range, parts that it cuts the hashes into), for its own and perhaps the next."""
        largest = size * self.den // self.num
        self._grow(largest)
        low, high = 0, len(self.bounds) - 1
        while low < high:
            middle = (low + high) // 2
            low, high = (low, middle) if self.bounds[middle][1] >= size else (middle + 1, high)
        mine = [low] if largest <= self.bounds[low][1] else [low, low + 1]
        return [(k, difference(self.bounds[k][1], self.num, self.den) * 3 // 2 + 2) for k in mine]


def parts_of(s: np.ndarray, ranges: Ranges) -> np.ndarray:
    """The names of the parts by which a set finds its partners.

    Of m parts at most d differ between linked sets, so of each set's first
    d + 1, in an order that the parts alone decide, one is the same in both.
    """
    named = []
    want = difference(len(s), ranges.num, ranges.den) + 1
    for k, m in ranges.of(len(s)):
        edges = np.searchsorted(s, (np.arange(m, dtype=np.uint64) * np.uint64((1 << 64) // m)))
        count = np.diff(edges, append=len(s))
        full = np.flatnonzero(count)
        names = np.zeros(m, np.uint64)
        names[full] = np.add.reduceat(_mixed(s), edges[full])
        names = _mixed(names + _mixed(np.arange(1, m + 1, dtype=np.uint64) * _M1 + np.uint64(k)))
        order = np.argsort((names >> np.uint64(20)) - (np.minimum(count, 4095).astype(np.uint64) << np.uint64(44)) + np.uint64(4095 << 44))
        named.append(names[order[:want]])
    return np.concatenate(named)


class UnionFind:
    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        a, b = self.root(i), self.root(j)
        if a == b:
            return False
        self.up[max(a, b)] = min(a, b)
        return True


class CountTree:
    """Points of counts, packed by size into nodes of FAN; row 0 is the points' level."""

    def __init__(self, sets: list[np.ndarray], num: int, den: int):
        self.num, self.den = num, den
        counts = np.array([np.bincount((s & np.uint64(0xFFFFFF)) % np.uint64(GROUPS), minlength=GROUPS) for s in sets])
        sizes = counts.sum(1)
        self.order = np.lexsort((*counts.T[::-1], sizes))
        self.levels = [(counts[self.order], sizes[self.order], sizes[self.order])]
        while len(self.levels[-1][1]) > FAN:
            most, low, high = self.levels[-1]
            cut = np.arange(0, len(low), FAN)
            self.levels.append((np.maximum.reduceat(most, cut), np.minimum.reduceat(low, cut), np.maximum.reduceat(high, cut)))

    def _may_link(self, level: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        most, low, high = self.levels[level]
        overlap = np.minimum(most[i], most[j]).sum(1)
        enough = (self.num + self.den) * overlap >= self.num * (low[i] + low[j])
        return enough & (self.num * low[j] <= self.den * high[i]) & (self.num * low[i] <= self.den * high[j])

    def pairs(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs i < j of points (by their place in `order`) that the bound lets pass."""
        top = len(self.levels) - 1
        i, j = np.triu_indices(len(self.levels[top][1]))
        todo = [(top, i, j)]
        while todo:
            level, i, j = todo.pop()
            if len(i) > 1 << 14:
                half = len(i) // 2
                todo += [(level, i[:half], j[:half]), (level, i[half:], j[half:])]
                continue
            good = self._may_link(level, i, j)
            i, j = i[good], j[good]
            if not level:
                yield i[i < j], j[i < j]
            elif len(i):
                n = len(self.levels[level - 1][1])
                a = np.repeat(i[:, None] * FAN + np.arange(FAN), FAN, 1).ravel()
                b = np.tile(j[:, None] * FAN + np.arange(FAN), (1, FAN)).ravel()
                there = (a <= b) & (a < n) & (b < n)
                todo.append((level - 1, a[there], b[there]))


def tree_join(sets: list[np.ndarray], num: int, den: int, sides: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Verified links that connect what is linked, as a forest.

    sides: with it, only pairs of different sides are looked at.
    """
    tree, known, links = CountTree(sets, num, den), UnionFind(len(sets)), []
    for i, j in tree.pairs():
        for a, b in zip(tree.order[i].tolist(), tree.order[j].tolist(), strict=True):
            if (sides is not None and sides[a] == sides[b]) or known.root(a) == known.root(b):
                continue
            x, y = (sets[a], sets[b]) if len(sets[a]) < len(sets[b]) else (sets[b], sets[a])
            at = np.searchsorted(y, x)
            at[at == len(y)] = 0
            both = int((y[at] == x).sum())
            if den * both >= num * (len(x) + len(y) - both):
                known.join(a, b)
                links.append((a, b))
    return links


def _nodes(d: DataFrame, n: int) -> DataFrame:
    """doc_id, n_ngrams, digest of every row."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_ngrams", pa.int64()), ("digest", pa.binary())])

    def run(batches):
        for part, all_texts in texts(batches):
            sets = [ngram_set(t, n) for t in all_texts]
            yield out(schema, {"doc_id": part.column(0), "n_ngrams": [len(s) for s in sets], "digest": [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]})

    return d.mapInArrow(run, "doc_id long, n_ngrams long, digest binary")


_PART = pa.schema([("part", pa.int64()), ("doc_id", pa.int64()), ("other", pa.int64())])


def _folded(part: np.ndarray, doc: np.ndarray) -> pa.RecordBatch:
    """One row a part, with its least document; rows with `other` join the rest to it."""
    order = np.lexsort((doc, part))
    part, doc = part[order], doc[order]
    new = np.ones(len(part), bool)
    new[1:] = part[1:] != part[:-1]
    first = doc[np.flatnonzero(new)[np.cumsum(new) - 1]]
    keep = new | (doc != first)
    return out(_PART, {"part": part[keep], "doc_id": doc[keep], "other": pa.array(first[keep], pa.int64(), mask=new[keep])})


def _parts(d: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """part, doc_id, other: what each task names, folded within the task."""

    def run(batches):
        ranges, held, docs, rows, seen = Ranges(num, den), [], [], 0, set()
        for part, all_texts in texts(batches):
            for doc_id, t in zip(part.column(0).to_pylist(), all_texts, strict=True):
                s = ngram_set(t, n)
                if not len(s):
                    continue
                digest = hashlib.blake2b(s.tobytes(), digest_size=16).digest()
                if digest in seen:  # an equal set of this task has named the same parts
                    continue
                seen.add(digest)
                names = parts_of(s, ranges)
                held.append(names)
                docs.append(np.full(len(names), doc_id, np.int64))
                rows += len(names)
            if rows >= FOLD:
                yield _folded(np.concatenate(held).view(np.int64), np.concatenate(docs))
                held, docs, rows = [], [], 0
            if len(seen) > 100_000:
                seen.clear()
        if rows:
            yield _folded(np.concatenate(held).view(np.int64), np.concatenate(docs))

    return d.mapInArrow(run, "part long, doc_id long, other long")


def _stars(parts: DataFrame) -> DataFrame:
    """part, a, b: the documents that name a part, each with the first of them."""
    schema = pa.schema([("part", pa.int64()), ("a", pa.int64()), ("b", pa.int64())])

    def run(batches):
        last = centre = None
        for batch in batches:
            if not batch.num_rows:
                continue
            linked = batch.filter(batch.column(2).is_valid())
            if linked.num_rows:
                yield out(schema, {"part": linked.column(0), "a": linked.column(1), "b": linked.column(2)})
            batch = batch.filter(batch.column(2).is_null())
            if not batch.num_rows:
                continue
            part, doc = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            new = np.ones(len(part), bool)
            new[1:] = part[1:] != part[:-1]
            centres = doc[np.flatnonzero(new)].copy()
            if last is not None and part[0] == last:
                centres[0] = centre
            mine = centres[np.cumsum(new) - 1]
            last, centre = part[-1], mine[-1]
            far = mine != doc
            if far.any():
                yield out(schema, {"part": part[far], "a": doc[far], "b": mine[far]})

    dealt_by = F.when(F.col("other").isNull(), F.col("part")).otherwise(F.col("doc_id"))
    return parts.repartition(dealt_by).sortWithinPartitions("part", "doc_id").mapInArrow(run, "part long, a long, b long")


def _leaves(members: DataFrame, *keys: str) -> DataFrame:
    """Leaves of bounded size of each group of members (with n, their hashes), and the hashes that their join moves."""
    leaves = F.greatest(F.ceil(F.count(F.lit(1)) / LEAF_POINTS), F.ceil(F.sum("n") / LEAF_HASHES)).cast("long")
    return materialize(members.groupBy(*keys).agg(leaves.alias("leaves"), F.sum("n").alias("all")).withColumn("cost", F.col("leaves") * F.col("all")), "leaves")


def _groups(families: DataFrame, stars: DataFrame, by_id: DataFrame, sizes: DataFrame) -> DataFrame:
    """family, leaves, node: groups of bounded leaves that hold both ends of every link.

    A group is a family, or a part that several of a large family's nodes name.
    """
    members = materialize(families.join(sizes, "node").select(F.col("label").alias("family"), "node", "n"), "members")
    cut = _leaves(members, "family")
    whole = members.join(cut, "family").select("family", "leaves", "node")
    large = materialize(cut.where("leaves > 1").select("family", "cost"), "large")
    if large.isEmpty():
        return whole
    theirs = members.join(large, "family").join(by_id, "node").select(F.col("doc_id").alias("doc"), F.col("family").alias("of"), "node", "n")
    named = stars.select("part", F.explode(F.array("a", "b")).alias("doc")).join(theirs, "doc")
    named = materialize(named.select("of", "part", "node", "n").distinct(), "named")
    # parts that the same nodes name are one group
    nodes = [F.sum(F.xxhash64("node", F.lit(seed)).cast("decimal(20,0)")).alias(f"nodes_{seed}") for seed in SEEDS]
    told = named.groupBy("of", "part").agg(F.count(F.lit(1)).alias("k"), *nodes).where("k > 1")
    once = told.groupBy("of", "k", *[f"nodes_{seed}" for seed in SEEDS]).agg(F.min("part").alias("part"))
    groups = materialize(named.join(once.select("of", "part"), ["of", "part"]), "groups")
    parts = _leaves(groups, "of", "part")
    costs = parts.groupBy("of").agg(F.sum("cost").alias("by_parts"))
    dealt = materialize(large.withColumnRenamed("family", "of").join(costs, "of").where("by_parts < cost").select("of"), "dealt")
    by_part = groups.join(dealt, "of").join(parts, ["of", "part"]).select(F.xxhash64("of", "part").alias("family"), "leaves", "node")
    return whole.join(dealt.withColumnRenamed("of", "family"), "family", "left_anti").unionByName(by_part)


def _sets(members: DataFrame, n: int) -> DataFrame:
    """family, leaves, doc_id, hashes (binary) of the members' texts, once for each of a member's groups."""
    groups = pa.list_(pa.struct([("family", pa.int64()), ("leaves", pa.int64())]))
    schema = pa.schema([("groups", groups), ("doc_id", pa.int64()), ("hashes", pa.binary())])

    def run(batches):
        for part, all_texts in texts(batches):
            yield out(schema, {"groups": part.column(0).cast(groups), "doc_id": part.column(1), "hashes": [ngram_set(t, n).tobytes() for t in all_texts]})

    sets = members.select("groups", "doc_id", "text").mapInArrow(run, "groups array<struct<family: long, leaves: long>>, doc_id long, hashes binary")
    return sets.select(F.explode("groups").alias("g"), "doc_id", "hashes").select("g.family", "g.leaves", "doc_id", "hashes")


def _links(sets: DataFrame, num: int, den: int) -> DataFrame:
    """a, b: verified links, from an R-tree join of each two leaves of a family."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    leaf = F.pmod(F.xxhash64("doc_id"), F.col("leaves"))
    spread = sets.withColumn("leaf", leaf).withColumn("with", F.explode(F.sequence(F.lit(0).cast("long"), F.col("leaves") - 1)))
    keyed = spread.select("family", F.least("leaf", "with").alias("i"), F.greatest("leaf", "with").alias("j"), "leaf", "doc_id", "hashes")

    def run(group: pa.Table) -> pa.Table:
        ids = group.column("doc_id").to_pylist()
        found = []
        if len(ids) > 1:
            sides = None if group.column("i")[0] == group.column("j")[0] else group.column("leaf").to_numpy()
            found = tree_join([np.frombuffer(b, np.uint64) for b in group.column("hashes").to_pylist()], num, den, sides)
        return pa.Table.from_batches([out(schema, {"a": [ids[x] for x, _ in found], "b": [ids[y] for _, y in found]})])

    return keyed.groupBy("family", "i", "j").applyInArrow(run, "a long, b long")


def _of_one_id(by_id: DataFrame) -> DataFrame:
    """a, b: links between the nodes of the texts under one id."""
    ends = by_id.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("most")).where("a <> most").drop("most")
    return by_id.join(ends, "doc_id").where("node <> a").select("a", F.col("node").alias("b")).distinct()


def _names_of_null(d: DataFrame) -> Column:
    """A long that stands for the id of a row without one: a hash of its text, which no id has and other texts don't share."""
    nulls = d.where("doc_id is null").select(F.coalesce("text", F.lit("")).alias("t"))
    seed = 0
    while True:
        name = F.xxhash64(F.coalesce("text", F.lit("")), F.lit(seed))
        mine = materialize(nulls.select(F.xxhash64("t", F.lit(seed)).alias("doc_id"), F.sha2("t", 256).alias("sha")).distinct(), "unnamed")
        twice = mine.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        if twice.isEmpty() and d.select("doc_id").join(mine, "doc_id", "left_semi").isEmpty():
            return name
        seed += 1


def jaccard_components(docs: DataFrame, n: int = WORDS, num: int = NUM, den: int = DEN, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: doc_id, n_ngrams, component_id (the smallest id that links reach)."""
    ship(docs.sparkSession)
    d = only(docs, doc_id=id_col, text=text_col)
    if d.where("doc_id is null").isEmpty():
        return _components(d, n, num, den)
    name = _names_of_null(d)
    unnamed = d.where("doc_id is null").select(name.alias("name")).distinct()
    # rows without id take part under names of their own; then each component is named by its ids alone
    named = d.withColumn("doc_id", F.coalesce("doc_id", name))
    found = materialize(_components(named, n, num, den), "components")
    found = found.join(unnamed.select(F.col("name").alias("doc_id"), F.lit(True).alias("no_id")), "doc_id", "left").withColumn("id", F.when(F.col("no_id").isNull(), F.col("doc_id")))
    least = materialize(found.groupBy("component_id").agg(F.min("id").alias("least")), "least")
    return found.join(least, "component_id").select(F.col("id").alias("doc_id"), "n_ngrams", F.col("least").alias("component_id"))


def _components(d: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """The same of doc_id, text without null ids."""
    plain = materialize(_nodes(d, n), "nodes")
    named = plain.where("n_ngrams > 0")
    # written, so that the join's sides are plain exchanges and Spark may split a group of copies
    first = materialize(named.groupBy("digest").agg(F.min("doc_id").alias("node"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"), "equal")
    copied = F.when(F.col("n_ngrams") > 0, F.col("node"))
    nodes = materialize(plain.join(first, "digest", "left").select("doc_id", "n_ngrams", F.coalesce(copied, "doc_id").alias("node")), "nodes")
    by_id = nodes.where("n_ngrams > 0").select("doc_id", "node").distinct()

    stars = materialize(_stars(_parts(d, n, num, den)), "stars")
    at_a = by_id.select(F.col("doc_id").alias("a"), F.col("node").alias("na"))
    at_b = by_id.select(F.col("doc_id").alias("b"), F.col("node").alias("nb"))
    families = components(stars.select("a", "b").distinct().join(at_a, "a").join(at_b, "b"), "na", "nb")

    sizes = nodes.where("doc_id = node and n_ngrams > 0").groupBy("node").agg(F.max("n_ngrams").alias("n"))
    groups = _groups(families, stars, by_id, sizes).groupBy("node").agg(F.collect_list(F.struct("family", "leaves")).alias("groups"))
    members = materialize(groups.select(F.col("node").alias("doc_id"), "groups"), "members")
    held, words = filter_of(members, "doc_id")
    their_texts = d.where(may_hold(F.col("doc_id"), held, words)).join(members, "doc_id")
    found = _links(_sets(their_texts, n), num, den).unionByName(_of_one_id(by_id))
    labels = components(materialize(found, "verified")).withColumnRenamed("label", "component")
    return nodes.join(labels, "node", "left").select("doc_id", "n_ngrams", F.coalesce("component", "node").alias("component_id"))


def keep_one_of_each(docs: DataFrame, n: int = WORDS, num: int = NUM, den: int = DEN) -> DataFrame:
    """One row of each component, with docs' columns: the smallest id, ids that are null last.

    The components are those of rows, so rows under one id stay or go by their
    own texts; of equal ids in a component one row stays. Rows without words
    stay.
    """
    rows, row = named_rows(docs)
    found = jaccard_components(rows, n, num, den, id_col=row).where("n_ngrams > 0")
    linked = found.where("doc_id <> component_id").select("doc_id", "component_id")
    several = linked.select(F.col("component_id").alias("doc_id"), "component_id").distinct()
    ids = rows.select(F.col(row).alias("doc_id"), place(F.col("doc_id"), F.col(row)).alias("place"))
    placed = materialize(linked.unionByName(several).join(ids, "doc_id"), "placed")
    first = materialize(placed.groupBy("component_id").agg(F.min("place").alias("first")), "first")
    gone = placed.join(first, "component_id").where(F.col("place.row") != F.col("first.row")).select(F.col("doc_id").alias(row))
    return without_rows(rows, row, gone, docs.columns)


def op8_ngram_jaccard_join(spark, sf_dir: str) -> DataFrame:
    found = jaccard_components(table(spark, sf_dir, "documents"), 3, 90, 100)
    return found.withColumnRenamed("n_ngrams", "n_shingles")


OP8_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id AS id, coalesce(doc_id::HUGEINT, 36893488147419103232 + row_number() OVER ()) AS doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
s AS (
  SELECT id, doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
         ELSE list_distinct(list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])) END AS sh
  FROM w),
e AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS g FROM s),
p AS (
  SELECT a.doc_id AS x, b.doc_id AS y
  FROM e a JOIN e b ON a.g = b.g AND a.doc_id <> b.doc_id AND 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
r AS (
  SELECT doc_id AS x, doc_id AS y FROM w
  UNION
  SELECT r.x, p.y FROM r JOIN p ON r.y = p.x)
SELECT s.id AS doc_id, len(s.sh)::BIGINT AS n_shingles, CASE WHEN m.component_id < 36893488147419103232 THEN m.component_id END::BIGINT AS component_id
FROM s JOIN (SELECT x, min(y) AS component_id FROM r GROUP BY x) m ON s.doc_id = m.x
"""
