"""Quality classifier: histogram gradient-boosted trees over document statistics.

Each text is read once and turned to a row of statistics. Trees grow level by
level on binned statistics with logistic loss; a finished ensemble lies in flat
arrays (feature, threshold, value), which numpy walks for all rows at once.

Learning reads a bounded sample: at most MAX_SAMPLE labels of ids outside the
held-out fifth, the first in the order of a hash of id and label; only their
statistics come to the driver, those of one text an id (the least statistics,
where an id repeats).

Defined cases: a null text is empty, and its statistics are zeros; with no
labels, or labels of one kind, the score is the share of label 1 (0.5 without
any); an id with several labels learns from each; null labels and labels of null ids
are left out; documents without id are scored like any other;
repeated rows are answered one by one; an empty table gives no rows; extra
columns are ignored.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell.llm.common import held_out, only, out, texts
from inkwell.session import materialize, ship, table

MAX_SAMPLE = 20_000
THRESHOLD = 0.3
TREES, DEPTH, BINS, RATE = 120, 4, 64, 0.1
LEAST = 20.0
STATS = (
    "bytes", "words", "word_length", "longest_word", "upper", "digits", "symbols", "exclamations", "points", "commas",
    "pipes", "other_marks", "beyond_ascii", "distinct_words", "top_word", "short_words", "lines", "line_length",
    "repeated_lines", "longest_line", "ends_with_mark", "capitalised", "repeated_pairs", "braces", "at_and_slash",
    "words_with_symbol", "top_byte",
)
_UPPER = bytes(range(65, 91))
_OTHER = b"\"'`;:?-_=+~^\\()"


def statistics(text: bytes | None) -> list[float]:
    """One text's row of STATS."""
    t = text or b""
    if not t:
        return [0.0] * len(STATS)
    n = len(t)
    by_byte = np.bincount(np.frombuffer(t, np.uint8), minlength=256)
    words = t.split()
    w = max(1, len(words))
    seen = Counter(words)
    lines = [x for x in t.split(b"\n") if x.strip()]
    k = max(1, len(lines))
    share = lambda chars: float(by_byte[list(chars)].sum()) / n
    lengths = list(map(len, words)) or [0]
    return [
        np.log1p(n), np.log1p(len(words)), sum(lengths) / w, np.log1p(max(lengths)), share(_UPPER), share(b"0123456789"),
        share(b"#*$%&<>"), share(b"!"), share(b"."), share(b","), share(b"|"), share(_OTHER), float(by_byte[128:].sum()) / n,
        len(seen) / w, seen.most_common(1)[0][1] / w if seen else 0.0, sum(x <= 3 for x in lengths) / w, np.log1p(len(lines)), n / k,
        1 - len(set(lines)) / k, np.log1p(max(map(len, lines), default=0)), sum(x.rstrip().endswith((b".", b"!", b"?", b":")) for x in lines) / k,
        sum(x[:1].isupper() for x in words) / w, 1 - len(set(zip(words, words[1:]))) / max(1, len(words) - 1), share(b"{}[]"), share(b"@/"),
        sum(not x.isalnum() and x.isascii() for x in words) / w, float(by_byte[97:].max()) / n,
    ]


class Trees:
    """A boosted ensemble of complete trees in flat arrays."""

    def __init__(self, start: float, feature: np.ndarray, cut: np.ndarray, value: np.ndarray):
        self.start, self.feature, self.cut, self.value = start, feature, cut, value

    @classmethod
    def constant(cls, share: float) -> Trees:
        share = min(max(share, 1e-3), 1 - 1e-3)
        return cls(float(np.log(share / (1 - share))), np.zeros((0, 2**DEPTH - 1), int), np.zeros((0, 2**DEPTH - 1)), np.zeros((0, 2**DEPTH)))

    @classmethod
    def grow(cls, x: np.ndarray, y: np.ndarray, trees: int = TREES) -> Trees:
        if len(y) == 0 or y.min() == y.max():
            return cls.constant(float(y.mean()) if len(y) else 0.5)
        rows, cols = x.shape
        cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(cols)]
        binned = np.stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(cuts)], 1)
        model = cls.constant(float(y.mean()))
        f = np.full(rows, model.start)
        feature, cut, value = [], [], []
        for _ in range(trees):
            p = 1 / (1 + np.exp(-f))
            g, h = p - y, p * (1 - p)
            node = np.zeros(rows, int)
            tree_f, tree_c = np.zeros(2**DEPTH - 1, int), np.full(2**DEPTH - 1, np.inf)
            for level in range(DEPTH):
                first, width = 2**level - 1, 2**level
                best = np.full(width, 1e-9)
                pick = np.zeros((width, 2), int)
                for j in range(cols):
                    key = node * BINS + binned[:, j]
                    gs = np.bincount(key, g, width * BINS).reshape(width, BINS)
                    hs = np.bincount(key, h, width * BINS).reshape(width, BINS)
                    ns = np.bincount(key, minlength=width * BINS).reshape(width, BINS)
                    gl, hl, nl = gs.cumsum(1), hs.cumsum(1), ns.cumsum(1)
                    ga, ha, na = gl[:, -1:], hl[:, -1:], nl[:, -1:]
                    gain = gl**2 / (hl + 1) + (ga - gl) ** 2 / (ha - hl + 1) - ga**2 / (ha + 1)
                    gain[(nl < LEAST) | (na - nl < LEAST)] = 0
                    gain = gain[:, : len(cuts[j])]
                    if gain.shape[1]:
                        at = gain.argmax(1)
                        top = gain[np.arange(width), at]
                        better = top > best
                        best[better] = top[better]
                        pick[better] = np.stack([np.full(width, j), at], 1)[better]
                split = best > 1e-9
                tree_f[first : first + width] = pick[:, 0]
                tree_c[first : first + width] = [cuts[j][b] if s else np.inf for (j, b), s in zip(pick, split, strict=True)]
                right = split[node] & (binned[np.arange(rows), pick[node, 0]] > pick[node, 1])
                node = node * 2 + right
            gs, hs = np.bincount(node, g, 2**DEPTH), np.bincount(node, h, 2**DEPTH)
            leaf = -RATE * gs / (hs + 1)
            f += leaf[node]
            feature.append(tree_f)
            cut.append(tree_c)
            value.append(leaf)
        return cls(model.start, np.array(feature), np.array(cut), np.array(value))

    def scores(self, x: np.ndarray) -> np.ndarray:
        """All rows through each tree, level by level."""
        f, rows = np.full(len(x), self.start), np.arange(len(x))
        for feature, cut, value in zip(self.feature, self.cut, self.value, strict=True):
            at = np.zeros(len(x), int)
            for _ in range(DEPTH):
                at = 2 * at + 1 + (x[rows, feature[at]] > cut[at])
            f += value[at - (2**DEPTH - 1)]
        return 1 / (1 + np.exp(-f))


def with_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, stats array<double>: every text read once, written to the shared folder."""
    ship(docs.sparkSession)
    schema = pa.schema([("doc_id", pa.int64()), ("stats", pa.list_(pa.float64()))])

    def run(batches):
        for part, all_texts in texts(batches):
            yield out(schema, {"doc_id": part.column(0), "stats": [statistics(t) for t in all_texts]})

    return materialize(only(docs, doc_id=id_col, text=text_col).mapInArrow(run, "doc_id long, stats array<double>"), "stats")


def learn(stats: DataFrame, labels: DataFrame, sample: int = MAX_SAMPLE) -> Trees:
    """Trees from a bounded sample of labelled rows outside the held-out fifth."""
    known = labels.where("quality is not null and doc_id is not null").select("doc_id", "quality").where(~held_out(F.col("doc_id"))).distinct()
    known = materialize(known.join(stats.select("doc_id"), "doc_id", "left_semi"), "labelled")
    spot = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.col("quality"), F.lit("quality")), F.lit(1 << 40))
    below = int(min(1.0, 2 * sample / max(1, known.count())) * (1 << 40))
    chosen = materialize(known.where(spot <= below).orderBy(spot, "doc_id", "quality").limit(sample), "chosen")
    rows = stats.join(chosen, "doc_id").groupBy("doc_id", "quality").agg(F.min("stats").alias("stats")).collect()
    rows.sort(key=lambda r: (r["doc_id"], r["quality"]))
    if not rows:
        return Trees.constant(0.5)
    return Trees.grow(np.array([r["stats"] for r in rows]), np.array([float(r["quality"] == 1) for r in rows]))


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted: one row a document."""
    spark = docs.sparkSession
    stats = with_statistics(docs, id_col, text_col)
    held = spark.sparkContext.broadcast(learn(stats, labels))
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()), ("predicted", pa.int32())])

    def run(batches):
        for batch in batches:
            x = batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(STATS))
            s = held.value.scores(x)
            yield out(schema, {"doc_id": batch.column(0), "held_out": batch.column(1), "score": pa.array(s), "predicted": pa.array((s >= THRESHOLD).astype(np.int32))})

    return stats.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "stats").mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def op9_quality_score(spark, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
