"""Language identification by error-correcting output codes.

Each language gets a codeword of bits. For every bit a binary classifier over
hashed byte trigrams predicts whether a text belongs to the languages with
that bit set. A text takes the language whose codeword has the least loss:
each bit's logistic loss counts by how well that bit's classifier did in
on rows that its training did not see. Where the second best is nearly as good,
the text is ambiguous.

Learning reads a bounded sample: about PER_LANG documents a language, fewer
where many languages share MAX_SAMPLE, chosen by a hash of id and text among
those with text and language outside the held-out fifth. Their whole texts are
turned to counts where they lie, and only these, DIM numbers a row at most, come
to the driver. The weights, bits x DIM floats, are the broadcast.

Defined cases: a null text, an empty one or one without letters is `und` with
score 0; without any labelled language every text is `und`; with one language
every text with a letter is that language with score 1; equal losses go to the
first language by name; long texts are read whole, in pieces that count as the
whole does; a document without id is learned from and answered like any other;
repeated rows are answered one by one; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from inkwell.llm.common import held_out, only, out, texts
from inkwell.session import materialize, ship, table

#: Expected documents of a language in the training sample at most, and of all languages.
PER_LANG, MAX_SAMPLE = 500, 4_000
#: Bytes of the window that is learned from beside each whole text; every so many-th row of a language measures trust.
WINDOW, KEPT = 100, 5
DIM = 1 << 12
#: Bytes of a long text that are turned to trigrams at once.
PIECE = 1 << 20
#: Share by which the best language must lead the second, else it is ambiguous.
MARGIN = 0.05
UND = "und"

_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))
_ASCII_LETTER = re.compile(rb"[A-Za-z]")
_LETTER = regex.compile(r"\p{L}")


def has_letter(text: bytes | None) -> bool:
    return bool(text) and bool(_ASCII_LETTER.search(text) or (not text.isascii() and _LETTER.search(text.decode("utf-8", "replace"))))


def trigrams(padded: bytes) -> np.ndarray:
    """A hash below DIM for each three bytes."""
    a = np.frombuffer(padded, np.uint8).astype(np.uint32)
    h = a[:-2] * np.uint32(0x9E3779B1) ^ a[1:-1] * np.uint32(0x85EBCA6B) ^ a[2:] * np.uint32(0xC2B2AE35)
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x2C1B3C6D)
    return h >> np.uint32(20)


def counts(text: bytes) -> np.ndarray:
    """How often each trigram hash stands in the lower-cased text with a blank at either end."""
    padded = b" " + text.translate(_TABLE) + b" "
    total = np.zeros(DIM, np.int64)
    for at in range(0, len(padded) - 2, PIECE):
        total += np.bincount(trigrams(padded[at : at + PIECE + 2]), minlength=DIM)
    return total


def window(text: bytes) -> bytes | None:
    """A stretch of a longer text, so that short texts are learned too."""
    if len(text) <= 2 * WINDOW:
        return None
    at = zlib.crc32(text) % (len(text) - WINDOW)
    return text[at : at + WINDOW]


def shares(n: np.ndarray) -> np.ndarray:
    return n / np.maximum(1, n.sum(-1, keepdims=True))


def codewords(n: int, seed: int = 5) -> np.ndarray:
    """n rows of +1 and -1, far from each other in many columns.

    Up to five languages take all splits in two; more take columns drawn with a
    fixed seed, the best of many draws by the least distance of two rows.
    """
    if n <= 1:
        return np.ones((n, 1))
    if n <= 5:
        cols = [[1] + [1 if k >> i & 1 else -1 for i in range(n - 1)] for k in range(2 ** (n - 1) - 1)]
        return np.array(cols, float).T
    rng, width, best, far = np.random.default_rng(seed), 4 * int(np.ceil(np.log2(n))) + 7, None, -1
    for _ in range(200):
        m = rng.choice([-1.0, 1.0], (n, width))
        if np.abs(m.sum(0)).max() == n:
            continue
        d = ((m[:, None] != m[None]).sum(2) + np.eye(n, dtype=int) * width).min()
        if d > far:
            best, far = m, d
    return best


class Codes:
    """Languages, codewords, trigram weights and the trust in each bit."""

    def __init__(self, langs: list[str], words: np.ndarray, weights: np.ndarray, bias: np.ndarray, trust: np.ndarray):
        self.langs, self.words, self.weights, self.bias, self.trust = langs, words, weights.astype(np.float32), bias, trust

    @classmethod
    def learn(cls, samples: list[tuple[np.ndarray, np.ndarray | None, str]], rounds: int = 150) -> Codes:
        """samples: counts of a whole text, of its window if it has one, and the language."""
        langs = sorted({lang for *_, lang in samples})
        words = codewords(len(langs))
        if len(langs) < 2:
            return cls(langs, words, np.zeros((DIM, words.shape[1])), np.zeros(words.shape[1]), np.ones(words.shape[1]))
        where, nth = {lang: i for i, lang in enumerate(langs)}, Counter()
        rows, y, kept = [], [], []
        for whole, part, lang in samples:
            nth[lang] += 1
            for n in (whole, part):
                if n is not None:
                    rows.append(n)
                    y.append(where[lang])
                    kept.append(nth[lang] % KEPT == 0)
        x = np.empty((len(rows), DIM), np.float32)
        for k, n in enumerate(rows):
            x[k] = shares(n) * 30
        y, kept = np.array(y), np.array(kept)
        share = np.bincount(y, minlength=len(langs))
        weigh = (len(y) / (len(langs) * share[y])).astype(np.float32)
        bits = words[y].astype(np.float32)
        w, b = cls._fit(x[~kept], bits[~kept], weigh[~kept], rounds)
        told = kept if kept.any() else ~kept
        right = ((x[told] @ w + b > 0) == (bits[told] > 0)).astype(np.float64) * weigh[told, None]
        wrong = np.clip(1 - right.sum(0) / weigh[told].sum(), 1e-3, 0.499)
        trust = np.log((1 - wrong) / wrong)
        return cls(langs, words, w * 30, b, trust / trust.sum())

    @staticmethod
    def _fit(x: np.ndarray, bits: np.ndarray, weigh: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
        """A logistic classifier for each bit."""
        w, b = np.zeros((DIM, bits.shape[1]), np.float32), np.zeros(bits.shape[1], np.float32)
        m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), np.zeros_like(b), np.zeros_like(b)
        for t in range(1, rounds + 1):
            f = x @ w + b
            g = -bits / (1 + np.exp(np.clip(bits * f, -30, 30))) * weigh[:, None] / len(x)
            gw, gb = x.T @ g + 1e-6 * w, g.sum(0)
            m, v, mb, vb = 0.9 * m + 0.1 * gw, 0.99 * v + 0.01 * gw**2, 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb**2
            step = 0.1 * np.sqrt(1 - 0.99**t) / (1 - 0.9**t)
            w -= step * m / (np.sqrt(v) + 1e-8)
            b -= step * mb / (np.sqrt(vb) + 1e-8)
        return w, b

    def bits(self, text: bytes) -> np.ndarray:
        """The classifiers' values for the whole text."""
        return shares(counts(text)) @ self.weights + self.bias

    def decode(self, f: np.ndarray) -> tuple[str, float, bool]:
        """Language, score and whether the second best is nearly as good."""
        loss = (np.log1p(np.exp(np.clip(-self.words * f, -30, 30))) * self.trust).sum(1)
        p = np.exp(-(loss - loss.min()) * 4)
        p /= p.sum()
        order = np.argsort(-p, kind="stable")
        return self.langs[order[0]], float(p[order[0]]), bool(len(p) > 1 and p[order[0]] - p[order[1]] < MARGIN)

    def predict(self, text: bytes | None) -> tuple[str, float, bool]:
        if not self.langs or not has_letter(text):
            return UND, 0.0, True
        if len(self.langs) == 1:
            return self.langs[0], 1.0, False
        return self.decode(self.bits(text))


def training_sample(d: DataFrame, per_lang: int = PER_LANG) -> list[tuple[np.ndarray, np.ndarray | None, str]]:
    """Counts of a bounded sample of labelled texts, per_lang of each language at most.

    Many languages share MAX_SAMPLE, one text each at least. Rows that repeat id
    and text are one, and each language's are taken in the order of a hash, so
    no language is lost to another's repeated rows and reruns agree.
    """
    known = d.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id"))).select("doc_id", "lang", "text")
    spot = F.xxhash64(F.col("doc_id").cast("string"), "text", F.lit("langid"))
    spots = materialize(known.select("lang", spot.alias("spot")).distinct(), "spots")
    each = spots.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    wanted = max(1, min(per_lang, MAX_SAMPLE // max(1, each.count())))
    order = F.pmod("spot", F.lit(1 << 40))
    # a hash below twice the wanted share takes part, so that the ranks meet few rows
    near = spots.join(each.select("lang", (F.lit(2.0 * wanted) / F.col("n")).alias("chance")), "lang").where(order / F.lit(float(1 << 40)) <= F.col("chance"))
    ranked = near.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(order, "spot")))
    chosen = materialize(ranked.where(F.col("rank") <= wanted).select("lang", "spot"), "chosen")
    # at most MAX_SAMPLE pairs, or one a language
    held = known.withColumn("spot", spot).join(F.broadcast(chosen), ["lang", "spot"])
    parts = ("at", "n", "window_at", "window_n")
    schema = pa.schema([("lang", pa.string()), ("spot", pa.int64()), *[(c, pa.binary()) for c in parts]])

    def run(batches):
        seen = set()
        for part, all_texts in texts(batches):
            got: dict[str, list] = {f.name: [] for f in schema}
            for lang, mine, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), all_texts, strict=True):
                if (lang, mine) in seen:
                    continue
                seen.add((lang, mine))
                got["lang"].append(lang)
                got["spot"].append(mine)
                for piece, name in ((t, ""), (window(t), "window_")):
                    n = counts(piece) if piece is not None else None
                    at = np.flatnonzero(n) if n is not None else None
                    got[f"{name}at"].append(at.astype(np.int32).tobytes() if n is not None else None)
                    got[f"{name}n"].append(n[at].astype(np.int64).tobytes() if n is not None else None)
            yield out(schema, got)

    counted = held.select("lang", "spot", "text").mapInArrow(run, "lang string, spot long, at binary, n binary, window_at binary, window_n binary")
    found = materialize(counted.dropDuplicates(["lang", "spot"]), "sample")

    def dense(at, n):
        if at is None:
            return None
        full = np.zeros(DIM, np.int64)
        full[np.frombuffer(at, np.int32)] = np.frombuffer(n, np.int64)
        return full

    rows = [(r["lang"], r["spot"], dense(r["at"], r["n"]), dense(r["window_at"], r["window_n"])) for r in found.toLocalIterator()]
    return [(n, window_n, lang) for lang, _, n, window_n in sorted(rows, key=lambda r: r[:2])]


_ARROW = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64()), ("ambiguous", pa.bool_())])


def identify(docs: DataFrame, model: Codes | None = None, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """doc_id, held_out, lang_pred, score, ambiguous: one row a document."""
    spark = docs.sparkSession
    ship(spark)
    d = only(docs, doc_id=id_col, lang=lang_col, text=text_col)
    held = spark.sparkContext.broadcast(model or Codes.learn(training_sample(d)))

    def run(batches):
        codes = held.value
        for part, all_texts in texts(batches):
            got = [codes.predict(t) for t in all_texts]
            yield out(_ARROW, {"doc_id": part.column(0), "held_out": part.column(1), "lang_pred": [g[0] for g in got], "score": [g[1] for g in got], "ambiguous": [g[2] for g in got]})

    return d.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text").mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double, ambiguous boolean")


def keep_identified(docs: DataFrame) -> DataFrame:
    """The rows of docs whose language is told, with docs' columns.

    Rejected: `und` and ambiguous texts. Prediction runs beside the row, so
    nothing is joined back.
    """
    spark = docs.sparkSession
    ship(spark)
    held = spark.sparkContext.broadcast(Codes.learn(training_sample(only(docs, doc_id="doc_id", lang="lang", text="text"))))
    text = next(c for c in docs.columns if c.lower() == "text")

    def run(batches):
        codes = held.value
        for part, all_texts in texts(batches, text):
            keep = [not codes.predict(t)[2] for t in all_texts]
            yield part.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def op2_language_id(spark, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))
