"""Merkle manifest of a dataset: a trie over radix ranks, in DataFrame operations.

1. Leaves: every row is hashed where it lies. Rows of one language, id and leaf
   are one entry with a count; only ids and digests move.
2. Ranks: an entry's place in its language comes from histograms of the digits
   of its key: three of sixteen bits and two of eight for the id, then the
   leaf's first sixteen, for ids that stand for many texts. A digit's start is
   the start of its prefix and what its lesser siblings count. A window holds
   the siblings of one prefix: 65,536 and the nulls at most, 256 where ids are
   dense; nothing is sorted as a whole.
3. Trie: a rank's digits in base FANOUT name its node on every level. Leaves
   meet by their longest common prefix, LEVELS digits short (a cell of 512); a
   cell is reduced level by level and its top goes on to the cell above, so a
   third of all rows in one language spreads over its cells. The languages'
   subroots are the leaves of a last trie, ranked by their names.
4. Proofs: from the root down each cell hands its children the siblings on
   their way to the root; at the leaves the way is hashed (proof) and walked
   with the leaf as it is found (folded root). Ways of leaves don't move.

Defined cases: each null column is `-`; null ids come first; rows of equal
language and id ascend by leaf, and equal rows stand side by side; each row is a
leaf of its own, repeated ones too; a null language is a language, first of all;
a lone leaf is its subroot, and a lone subroot the root; an empty table gives no
rows; extra columns are ignored; long texts are hashed whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from inkwell.llm.common import only
from inkwell.llm.rules import let
from inkwell.session import materialize, table

FANOUT, LEVELS = 8, 3
CELL = FANOUT**LEVELS
#: Cells that a repeated entry covers are spelled out in two steps of this width.
SPREAD = 4096
#: The first digit of rows without id, below all others.
NO_ID = -(1 << 15) - 1
#: An entry's key from its longest digit group to the whole: the id's prefixes, the id, the leaf's start, the leaf.
DIGITS = ["p48", "p32", "p16", "p8", "id", "l16", "leaf"]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def field(value: Column) -> Column:
    """A value as it enters a leaf: its length in bytes, a colon and its text; `-` for null."""
    s = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def digest(text: Column) -> Column:
    return F.sha2(text, 256)


def leaf_of(doc_id: Column, source: Column, lang: Column, n_chars: Column, text: Column) -> Column:
    return digest(F.concat(*[field(c) for c in (doc_id, source, lang, n_chars, text)]))


def entries_of(rows: DataFrame, found: Column) -> DataFrame:
    """k and DIGITS of the leaves with their count c and, where it differs, the leaf of the text that is found.

    rows: doc_id, source, lang, n_chars, text. k is the language's name in an order that puts null first.
    """
    columns = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    changed = ~found.eqNullSafe(F.col("text"))
    i = F.col("doc_id")
    leaves = rows.select(
        F.coalesce(F.concat(F.lit("="), "lang"), F.lit("-")).alias("k"),
        *[F.coalesce(F.shiftright(i, bits), F.lit(NO_ID)).cast("long").alias(f"p{bits}") for bits in (48, 32, 16, 8)],
        F.coalesce(i, F.lit(0)).cast("long").alias("id"),
        leaf_of(*columns, F.col("text")).alias("leaf"),
        F.when(changed, leaf_of(*columns, found)).alias("found"),
    )
    keyed = leaves.withColumn("l16", F.substring("leaf", 1, 4))
    return materialize(keyed.groupBy("k", *DIGITS).agg(F.count(F.lit(1)).alias("c"), F.min("found").alias("found")), "entries")


def with_ranks(entries: DataFrame) -> DataFrame:
    """entries with their first rank in their language (start) and the language's leaves (m)."""
    counts = [entries]
    for j in range(len(DIGITS) - 1, 0, -1):
        counts.insert(0, counts[0].groupBy("k", *DIGITS[:j]).agg(F.sum("c").alias("c")))
    starts = counts[0].groupBy("k").agg(F.sum("c").alias("m")).withColumn("start", F.lit(0).cast("long"))
    for j, level in enumerate(counts):
        prefix = ["k", *DIGITS[:j]]
        lesser = F.sum("c").over(W.partitionBy(*prefix).orderBy(DIGITS[j]).rowsBetween(W.unboundedPreceding, -1))
        placed = level.withColumn("lesser", F.coalesce(lesser, F.lit(0))).join(starts, prefix)
        rest = [c for c in level.columns if c not in (*prefix, DIGITS[j], "c")]
        starts = placed.select(*prefix, DIGITS[j], *rest, *(["c"] if level is entries else []), "m", (F.col("start") + F.col("lesser")).alias("start"))
    return starts


def cells_of(ranked: DataFrame) -> DataFrame:
    """k, cell, m, items: the leaves of CELL ranks as array<struct<node, doc_id, found>>."""
    width = CELL * SPREAD
    first, last = F.col("start"), F.col("start") + F.col("c") - 1
    wide = ranked.withColumn("block", F.explode(F.sequence(F.floor(first / width), F.floor(last / width))))
    low, high = F.greatest(first, F.col("block") * width), F.least(last, (F.col("block") + 1) * width - 1)
    each = wide.withColumn("cell", F.explode(F.sequence(F.floor(low / CELL), F.floor(high / CELL))))
    at, to = F.greatest(first, F.col("cell") * CELL), F.least(last, (F.col("cell") + 1) * CELL - 1)
    doc_id = F.when(F.col("p48") != NO_ID, F.col("id"))
    piece = F.struct(at.alias("at"), (to - at + 1).cast("int").alias("n"), F.struct(F.col("leaf").alias("node"), doc_id.alias("doc_id"), "found").alias("leaf"))
    pieces = F.array_sort(F.collect_list(piece))
    copies = F.flatten(F.transform(pieces, lambda p: F.array_repeat(p["leaf"], p["n"])))
    return each.groupBy("k", "cell").agg(F.max("m").alias("m"), copies.alias("items"))


def runs(nodes: Column) -> Column:
    """The nodes above: the hash of every FANOUT of them."""
    last = F.floor((F.size(nodes) - 1) / FANOUT).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda k: digest(F.array_join(F.slice(nodes, k * FANOUT + 1, F.lit(FANOUT)), "")))


def depth(m: Column) -> Column:
    """Levels that a cell is reduced by, where its level has m nodes in all."""
    d = F.lit(0)
    for level in range(LEVELS):
        d = F.when(m > FANOUT**level, level + 1).otherwise(d)
    return d


def reduced(cells: DataFrame, name: str) -> DataFrame:
    """cells with the nodes of the levels between (l0, l1, l2) and their top, written."""
    d = depth(F.col("m"))
    c = cells.withColumn("l0", F.transform("items", lambda x: x["node"]))
    for level in range(1, LEVELS + 1):
        c = c.withColumn(f"l{level}", F.when(d >= level, runs(F.col(f"l{level - 1}"))))
    top = F.coalesce(*[F.get(f"l{level}", F.lit(0)) for level in range(LEVELS, -1, -1)])
    return materialize(c.withColumn("top", top).drop(f"l{LEVELS}"), name)


def tries(cells: DataFrame, most: int, name: str) -> list[DataFrame]:
    """The cells of all levels from the leaves up; the last has one cell for each k. most: leaves of the largest k."""
    levels = [reduced(cells, name)]
    while most > CELL:
        most = -(-most // CELL)
        below = levels[-1].select("k", F.floor(F.col("cell") / CELL).alias("up"), "cell", F.col("top").alias("node"), F.ceil(F.col("m") / CELL).alias("m"))
        items = F.array_sort(F.collect_list(F.struct("cell", "node")))
        levels.append(reduced(below.groupBy("k", F.col("up").alias("cell")).agg(F.max("m").alias("m"), items.alias("items")), name))
    return levels


def _way(i: Column) -> Column:
    """The steps of item i inside its cell, then the cell's own: array<struct<left, right>>."""

    def step(nodes: Column, at: Column) -> Column:
        low = at - at % FANOUT
        left = F.slice(nodes, low + 1, at - low)
        right = F.slice(nodes, at + 2, low + (FANOUT - 1) - at)
        return F.struct(F.array_join(left, "").alias("left"), F.array_join(right, "").alias("right"))

    none = F.array().cast("array<struct<left:string,right:string>>")
    inside = [F.when(depth(F.col("m")) > level, F.array(step(F.col(f"l{level}"), F.floor(i / FANOUT**level).cast("int")))).otherwise(none) for level in range(LEVELS)]
    return F.concat(*inside, F.col("way"))


def handed_down(levels: list[DataFrame], ways: DataFrame) -> DataFrame:
    """The cells of the leaves with the way from each to the root. ways: k, way and what goes with k."""
    more = [c for c in ways.columns if c not in ("k", "way")]
    above = ways.withColumn("cell", F.lit(0).cast("long"))
    for level in reversed(levels[1:]):
        children = F.transform("items", lambda x, i: F.struct(x["cell"].alias("cell"), _way(i).alias("way")))
        above = level.join(above, ["k", "cell"]).select("k", *more, F.inline(children))
    return levels[0].join(above, ["k", "cell"])


def ranked_names(subroots: DataFrame) -> DataFrame:
    """k, subroot, rank: by name. Names are dealt by range; only a count a part is summed."""
    held = materialize(subroots.repartitionByRange("k").sortWithinPartitions("k").withColumn("at", F.monotonically_increasing_id()), "names")
    part, own = F.shiftright("at", 33), F.col("at").bitwiseAND((1 << 33) - 1)
    rows = held.select("k", "subroot", part.alias("part"), own.alias("own"))
    before = F.sum("n").over(W.partitionBy(F.lit(1)).orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    parts = rows.groupBy("part").agg(F.count(F.lit(1)).alias("n")).select("part", F.coalesce(before, F.lit(0)).alias("before"))
    return rows.join(parts, "part").select("k", "subroot", (F.col("own") + F.col("before")).alias("rank"))


def _root(subroots: DataFrame) -> DataFrame:
    """k, subroot, way, root of every language."""
    names = materialize(ranked_names(subroots), "subroots")
    n = names.count()
    item = F.struct("rank", F.struct(F.col("subroot").alias("node"), F.col("k").alias("name")).alias("x"))
    items = F.transform(F.array_sort(F.collect_list(item)), lambda i: i["x"])
    cells = names.groupBy(F.lit("").alias("k"), F.floor(F.col("rank") / CELL).alias("cell")).agg(F.lit(n).cast("long").alias("m"), items.alias("items"))
    levels = tries(cells, n, "names_trie")
    none = F.array().cast("array<struct<left:string,right:string>>")
    top = levels[-1].select("k", none.alias("way"), F.col("top").alias("root"))
    listed = F.transform("items", lambda x, i: F.struct(x["name"].alias("k"), x["node"].alias("subroot"), _way(i).alias("way")))
    return materialize(handed_down(levels, top).select("root", F.inline(listed)), "ways")


def fold(start: Column, way: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(way, start, lambda node, s: digest(F.concat(s["left"], node, s["right"])))


def proof(way: Column) -> Column:
    """The hash of the siblings, level by level."""
    return digest(F.array_join(F.transform(way, lambda s: F.concat(s["left"], s["right"])), ""))


def manifest(docs: DataFrame, found: Column | None = None, id_col: str = "doc_id", source_col: str = "source", lang_col: str = "lang", chars_col: str = "n_chars", text_col: str = "text") -> DataFrame:
    """One row a document: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    found: the text that stands there now, an expression over doc_id, source,
    lang, n_chars and text; without it every document stands as it was hashed.
    """
    rows = only(docs, doc_id=id_col, source=source_col, lang=lang_col, n_chars=chars_col, text=text_col)
    rows = rows.withColumns({"doc_id": F.col("doc_id").cast("long"), "lang": F.col("lang").cast("string"), "text": F.col("text").cast("string")})
    entries = entries_of(rows, F.col("text") if found is None else found)
    ranked = materialize(with_ranks(entries), "ranked")
    most = ranked.agg(F.max("m")).first()[0] or 0
    levels = tries(cells_of(ranked), most, "trie")
    ways = _root(levels[-1].select("k", F.col("top").alias("subroot")))
    cells = handed_down(levels, ways)

    def of(x: Column, i: Column) -> Column:
        return let(_way(i), lambda way: F.struct(x["doc_id"].alias("doc_id"), x["node"].alias("leaf"), proof(way).alias("proof_sha256"), fold(F.coalesce(x["found"], x["node"]), way).alias("folded_root")))

    each = cells.select("subroot", "root", F.inline(F.transform("items", of)))
    return each.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def op12_merkle_manifest(spark, sf_dir: str) -> DataFrame:
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, F.lit(False))
    found = F.when(tampered, F.translate("text", UPPER, LOWER)).otherwise(F.col("text"))
    return manifest(table(spark, sf_dir, "documents"), found)


def _sql(levels: int = 6, tops: int = 3) -> str:
    """The same by joins of every level with itself, for FANOUT**levels rows a language."""
    value = lambda c: f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')"
    leaf = lambda text: "sha256(" + " || ".join(map(value, ("doc_id", "source", "lang", "n_chars", text))) + ")"
    bit = lambda x: f"CASE WHEN {x} % 2 = 1 THEN xor({x} >> 1, 3988292384) ELSE {x} >> 1 END"
    steps = ", ".join(f"b{k + 1} AS (SELECT i, {bit('v')} AS v FROM b{k})" for k in range(8))
    parts = [
        "RECURSIVE b0 AS (SELECT range::BIGINT AS i, range::BIGINT AS v FROM range(256))",
        steps,
        "crc_table AS MATERIALIZED (SELECT list(v ORDER BY i) AS v FROM b8)",
        "ids AS (SELECT DISTINCT doc_id, doc_id::VARCHAR AS s FROM documents WHERE doc_id IS NOT NULL)",
        """crc AS (
  SELECT doc_id, s, 1 AS pos, 4294967295::BIGINT AS c FROM ids
  UNION ALL
  SELECT doc_id, s, pos + 1, xor(c >> 8, v[(xor(c, ascii(s[pos])::BIGINT) & 255) + 1]) FROM crc, crc_table WHERE pos <= length(s))""",
        "odd AS (SELECT doc_id FROM crc WHERE pos = length(s) + 1 AND xor(c, 4294967295) % 3 = 0)",
        f"""d AS (
  SELECT doc_id, lang, {leaf("text")} AS leaf, {leaf("found")} AS found
  FROM (SELECT d.*, CASE WHEN odd.doc_id IS NOT NULL THEN translate(text, '{UPPER}', '{LOWER}') ELSE text END AS found FROM documents d LEFT JOIN odd ON d.doc_id = odd.doc_id))""",
        "a0 AS (SELECT row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY lang) AS m, coalesce('=' || lang, '-') AS k, leaf AS h, doc_id, leaf, found AS f, '' AS proof FROM d)",
    ]
    node = lambda at, to: f"{to} AS (SELECT k, i // 8 AS i, (any_value(m) + 7) // 8 AS m, CASE WHEN any_value(m) = 1 THEN any_value(h) ELSE sha256(string_agg(h, '' ORDER BY i)) END AS h FROM {at} GROUP BY k, i // 8)"
    side = lambda at, to: f"""{to} AS (
  SELECT x.k, x.i, x.m, coalesce(string_agg(y.h, '' ORDER BY y.i) FILTER (y.i < x.i), '') AS l, coalesce(string_agg(y.h, '' ORDER BY y.i) FILTER (y.i > x.i), '') AS r
  FROM {at} x JOIN {at} y ON x.k = y.k AND x.i // 8 = y.i // 8 GROUP BY x.k, x.i, x.m)"""  # noqa: E731
    walk = lambda at, s, to, keep: f"""{to} AS (
  SELECT {keep}, a.k, a.i // 8 AS i, CASE WHEN s.m = 1 THEN a.f ELSE sha256(l || a.f || r) END AS f, CASE WHEN s.m = 1 THEN a.proof ELSE a.proof || l || r END AS proof
  FROM {at} a JOIN {s} s ON a.k = s.k AND a.i = s.i)"""  # noqa: E731
    parts.append("n0 AS (SELECT k, i, m, h FROM a0)")
    for j in range(levels):
        parts += [side(f"n{j}", f"s{j}"), node(f"n{j}", f"n{j + 1}"), walk(f"a{j}", f"s{j}", f"a{j + 1}", "a.doc_id, a.leaf")]
    parts.append(f"t0 AS (SELECT '' AS k, row_number() OVER (ORDER BY k) - 1 AS i, count(*) OVER () AS m, h, k AS name FROM n{levels})")
    parts.append(f"z0 AS (SELECT a.doc_id, a.leaf, t.h AS subroot, t.k, t.i, a.f, a.proof FROM a{levels} a JOIN t0 t ON a.k = t.name)")
    for j in range(tops):
        parts += [side(f"t{j}", f"u{j}"), node(f"t{j}", f"t{j + 1}"), walk(f"z{j}", f"u{j}", f"z{j + 1}", "a.doc_id, a.leaf, a.subroot")]
    return "WITH " + ",\n".join(parts) + f"\nSELECT doc_id, leaf, subroot, h AS root, sha256(proof) AS proof_sha256, f AS folded_root, f = h AS verified FROM z{tops} JOIN t{tops} USING (k)"


OP12_SQL = _sql()
