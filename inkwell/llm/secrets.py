"""Secret scans: fixed patterns, and a character network over further candidates.

Base patterns always report. Beside them every run of at least MIN_LEN
characters of secret-like alphabets is a candidate. A small convolutional
network in numpy reads every candidate, base ones too, with its surrounding
characters and says how likely it is a secret. The network is trained on
labelled findings that a seeded generator makes (the tables hold none): random
keys in several alphabets, hexadecimal of both cases, UUIDs and letters of one
case, against words, names, paths, numbers and repeated characters, both in
contexts of either kind. Each of these kinds of runs has a threshold of its own,
calibrated on findings that training doesn't see: the largest that keeps RECALL
of the kind's secrets.

Candidates longer than the window are read in overlapping windows, and the
largest value counts, so none is cut.

Defined cases: a null text is empty and has no spans; spans of different kinds
may overlap, candidates that overlap a base span are not reported again;
offsets are code points, ends exclusive; ties in start follow the order of the
kinds; repeated rows are answered one by one; an empty table gives no rows;
extra columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import re
import string

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from inkwell.llm.common import only, out, texts
from inkwell.session import ship, table

# The base patterns, in the order of the kinds.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "network")

#: Runs of this length and more are candidates.
MIN_LEN = 16
CANDIDATE = re.compile(r"[A-Za-z0-9+/_.=-]{16,}")
#: Characters before, of, and after a candidate in one window.
BEFORE, OF, AFTER = 24, 40, 8
WIDTH = BEFORE + OF + AFTER
RECALL = 0.98
FILTERS, KERNEL, GROUPS = 32, 5, 36

# Classes of characters that the network tells apart: letters without their case, and groups of others.
_CLASSES = [*(a + a.upper() for a in string.ascii_lowercase), string.digits, "+/", "_-", ".", "=", ":\"'", " \t\n", "(){}[]<>,;", "#$%&|*!?@"]
_CLASS = np.full(0x250, GROUPS - 1, np.uint8)
for _i, _c in enumerate(_CLASSES):
    for _ch in _c:
        _CLASS[ord(_ch)] = _i


#: Kinds of runs, each with a threshold: UUIDs, hexadecimal digits with a letter, letters of one case, all others.
RUNS = ("uuid", "hex", "one_case", "mixed")
_UUID = re.compile(r"[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}", re.IGNORECASE | re.ASCII)
_HEXISH = re.compile(r"(?=[0-9]*[A-Fa-f])(?:[0-9a-f]+|[0-9A-F]+)", re.ASCII)
_ONE_CASE = re.compile(r"[.=_/+-]*(?:[a-z]+|[A-Z]+)[.=_/+-]*")


def run_kind(body: str) -> int:
    """The place in RUNS of a candidate's characters."""
    if _UUID.search(body):
        return 0
    return 1 if _HEXISH.fullmatch(body) else 2 if _ONE_CASE.fullmatch(body) else 3


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base patterns, in order."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def candidates(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in CANDIDATE.finditer(text)]


def windows(text: str, start: int, end: int) -> list[str]:
    """The windows over one candidate and its surroundings, each WIDTH long."""
    before = text[max(0, start - BEFORE) : start].rjust(BEFORE, "\n")
    after = text[end : end + AFTER].ljust(AFTER, "\n")
    body = text[start:end]
    if len(body) <= OF:
        return [before + body.ljust(OF, "\0") + after]
    cuts = [*range(0, len(body) - OF, OF // 2), len(body) - OF]
    return [before + body[c : c + OF] + after for c in cuts]


def encode(ws: list[str]) -> np.ndarray:
    """(n, WIDTH, GROUPS + 4): class, inside or not, repeat of the last, shares of distinct characters and vowels, upper case."""
    codes = np.frombuffer("".join(ws).encode("utf-32-le"), np.uint32).reshape(len(ws), WIDTH)
    classes = np.where(codes < len(_CLASS), _CLASS[np.minimum(codes, len(_CLASS) - 1)], GROUPS - 1)
    x = np.zeros((len(ws), WIDTH, GROUPS + 4), np.float32)
    np.put_along_axis(x[:, :, :GROUPS], classes[:, :, None].astype(np.int64), 1, 2)
    x[codes == 0] = 0
    x[:, BEFORE : BEFORE + OF, GROUPS] = 1
    x[:, :, GROUPS + 3] = (codes >= 65) & (codes <= 90)
    x[:, 1:, GROUPS + 1] = codes[:, 1:] == codes[:, :-1]
    inside = codes[:, BEFORE : BEFORE + OF]
    s = np.sort(inside, 1)
    distinct = (s[:, 1:] != s[:, :-1]).sum(1) / np.maximum(1, (inside != 0).sum(1))
    vowels = np.isin(inside, np.frombuffer("aeiouAEIOU".encode("utf-32-le"), np.uint32)).sum(1) / np.maximum(1, (inside != 0).sum(1))
    x[:, :BEFORE, GROUPS + 2] = distinct[:, None]
    x[:, BEFORE:, GROUPS + 2] = vowels[:, None]
    return x


class Network:
    """Convolution, maximum and mean over inside and surroundings, one unit."""

    def __init__(self, conv: np.ndarray, cbias: np.ndarray, w: np.ndarray, b: float, thresholds: np.ndarray | None = None):
        self.conv, self.cbias, self.w, self.b = conv, cbias, w, b
        self.thresholds = np.full(len(RUNS), 0.5) if thresholds is None else thresholds

    def _hidden(self, x):
        cols = np.lib.stride_tricks.sliding_window_view(x, KERNEL, axis=1).transpose(0, 1, 3, 2)
        cols = cols.reshape(len(x), WIDTH - KERNEL + 1, -1)
        return cols, np.maximum(0, cols @ self.conv + self.cbias)

    @staticmethod
    def _pooled(h):
        a, z = BEFORE, BEFORE + OF - KERNEL + 1
        inside = h[:, a:z]
        return np.concatenate([h[:, :a].max(1), inside.mean(1), inside.max(1), h[:, z:].max(1)], 1)

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self._pooled(self._hidden(x)[1]) @ self.w + self.b, -30, 30)))

    @classmethod
    def train(cls, x: np.ndarray, y: np.ndarray, rounds: int = 8, seed: int = 3) -> Network:
        rng = np.random.default_rng(seed)
        size = KERNEL * x.shape[2]
        p = [rng.normal(0, size**-0.5, (size, FILTERS)).astype(np.float32), np.zeros(FILTERS, np.float32), rng.normal(0, 0.1, 4 * FILTERS).astype(np.float32), np.zeros(1, np.float32)]
        m, v, t = [np.zeros_like(q) for q in p], [np.zeros_like(q) for q in p], 0
        a, z = BEFORE, BEFORE + OF - KERNEL + 1
        for _ in range(rounds):
            for part in np.array_split(rng.permutation(len(y)), max(1, len(y) // 128)):
                net = cls(p[0], p[1], p[2], p[3][0])
                cols, h = net._hidden(x[part])
                pooled = cls._pooled(h)
                e = ((1 / (1 + np.exp(-np.clip(pooled @ p[2] + p[3][0], -30, 30)))) - y[part]) / len(part)
                gp = e[:, None] * p[2]
                gh = np.zeros_like(h)
                rows, fs = np.arange(len(part))[:, None], np.arange(FILTERS)[None]
                gh[rows, h[:, :a].argmax(1), fs] += gp[:, :FILTERS]
                gh[:, a:z] += gp[:, None, FILTERS : 2 * FILTERS] / (z - a)
                gh[rows, a + h[:, a:z].argmax(1), fs] += gp[:, 2 * FILTERS : 3 * FILTERS]
                gh[rows, z + h[:, z:].argmax(1), fs] += gp[:, 3 * FILTERS :]
                gh *= h > 0
                flat = cols.reshape(-1, size)
                g = [flat.T @ gh.reshape(-1, FILTERS), gh.sum((0, 1)), pooled.T @ e, np.array([e.sum()])]
                t += 1
                for i in range(4):
                    m[i] = 0.9 * m[i] + 0.1 * g[i]
                    v[i] = 0.999 * v[i] + 0.001 * g[i] ** 2
                    p[i] = (p[i] - 0.004 * (m[i] / (1 - 0.9**t)) / (np.sqrt(v[i] / (1 - 0.999**t)) + 1e-8)).astype(np.float32)
        return cls(p[0], p[1], p[2], float(p[3][0]))

    def calibrate(self, values: np.ndarray, y: np.ndarray, kinds: np.ndarray, recall: float = RECALL) -> Network:
        """For each kind the largest threshold that keeps `recall` of its secrets by their values; 0.5 where there are none."""
        for kind in range(len(RUNS)):
            found = np.sort(values[(y == 1) & (kinds == kind)])
            self.thresholds[kind] = found[int((1 - recall) * len(found))] if len(found) else 0.5
        return self

    def reports(self, body: str, value: float) -> bool:
        return value >= self.thresholds[run_kind(body)]


def labelled_findings(n: int, seed: int) -> tuple[list[tuple[str, int, int]], np.ndarray]:
    """Seeded texts, each with the span of one candidate, and whether it is a secret."""
    rng = np.random.default_rng(seed)
    pick = lambda a: a[int(rng.integers(len(a)))]
    rand = lambda alphabet, k: "".join(alphabet[i] for i in rng.integers(0, len(alphabet), k))
    alnum = string.ascii_letters + string.digits
    syllables = ["th", "er", "an", "on", "re", "ti", "es", "en", "at", "ed", "nd", "ou", "le", "la", "que", "der", "ein", "ung", "con", "ment", "tion", "aire", "ado", "key", "set", "get", "user", "data", "list", "path"]
    word = lambda: "".join(pick(syllables) for _ in range(int(rng.integers(1, 5))))
    clusters = ["sch", "ch", "lich", "heit", "keit", "nicht", "ung", "zu", "be", "er", "en", "ein", "ver", "ge", "te", "st", "pf", "tz", "und", "die", "schaft", "ber", "chen", "str", "ie"]
    long_word = lambda: "".join(pick(pick([syllables, clusters])) for _ in range(int(rng.integers(6, 11))))
    german = lambda: "".join(pick(clusters) for _ in range(int(rng.integers(5, 11))))
    secret = [
        lambda: rand(alnum, int(rng.integers(20, 60))),
        lambda: rand(alnum + "+/", 4 * int(rng.integers(6, 16))) + pick(["", "=", "=="]),
        lambda: rand(alnum + "_-", int(rng.integers(22, 64))),
        lambda: pick(["ghp_", "sk_live_", "xoxb-", "glpat-", "key-", "AIza"]) + rand(alnum, int(rng.integers(20, 40))),
        lambda: rand(string.ascii_uppercase + string.digits, int(rng.integers(20, 40))),
        lambda: ".".join(rand(alnum + "_-", int(rng.integers(16, 40))) for _ in range(3)),
        lambda: rand(string.ascii_letters, int(rng.integers(16, 40))),
    ]
    hexed = [
        lambda: rand("0123456789abcdef", int(rng.integers(16, 24))),
        lambda: rand("0123456789ABCDEF", int(rng.integers(16, 65))),
    ]
    uuid = [
        lambda: pick([str, str.upper])("-".join(rand("0123456789abcdef", k) for k in (8, 4, 4, 4, 12))),
    ]
    one_case = [
        lambda: rand(pick([string.ascii_lowercase, string.ascii_uppercase]), int(rng.integers(16, 40))),
    ]
    plain = [
        lambda: "_".join(word() for _ in range(int(rng.integers(3, 7)))) + str(int(rng.integers(10))),
        lambda: "".join(word().capitalize() for _ in range(int(rng.integers(4, 8)))),
        lambda: "/".join(word() for _ in range(int(rng.integers(3, 7)))) + f"/{int(rng.integers(2030))}",
        lambda: rand(string.digits, int(rng.integers(16, 30))),
        lambda: "-".join(rand(string.digits, 4) for _ in range(int(rng.integers(4, 6)))),
        lambda: pick("=-_.x0aA") * int(rng.integers(16, 60)) + pick(["1", "aB"]),
        lambda: ".".join(word() for _ in range(int(rng.integers(3, 6)))) + ".v" + rand(string.digits, 2),
        lambda: (word() + word().upper() + word() + word() + str(int(rng.integers(100)))).ljust(16, "e"),
        lambda: f"20{rand('012', 2)}-0{rand('123456789', 1)}-1{rand(string.digits, 1)}T{rand('01', 2)}:00".replace(":", ".") + ".000",
        lambda: (word() * 8)[:20] + rand(string.digits, 2),
        lambda: long_word() + pick(["", ".", ".", "s"]),
        lambda: pick([str.lower, str.upper, str.capitalize])(long_word()) + pick(["", "."]),
        lambda: pick([str.lower, str.capitalize])(german()) + pick(["", ".", ".", "s"]),
        lambda: pick("-=_./").join(word() for _ in range(int(rng.integers(4, 9)))),
        lambda: pick("-=_./+") * int(rng.integers(16, 80)),
        lambda: "-".join(pick("0af") * k for k in (8, 4, 4, 4, 12)),
        lambda: pick(["0123456789abcdef", "deadbeef", "cafebabe", "facade00", "ABCDEF"]) * 4,
        lambda: (rand("0123456789", 1) + pick("abcdef")) * int(rng.integers(8, 16)),
    ]
    found, y = [], []
    for k in range(n):
        is_secret = k % 2
        body = pick(pick([secret, secret, hexed, uuid, one_case]) if is_secret else plain)()
        while len(body) < MIN_LEN:
            body += body
        hint = pick(["key = ", "Authorization: Bearer ", "credential: ", "auth=", "private_key: \"", "client_id='"])
        prose = " ".join(word() for _ in range(5)) + " "
        before = prose + (hint if rng.random() < (0.5 if is_secret else 0.1) else "")
        after = pick([" ", ".\n", "\"\n", ", "]) + word()
        found.append((before + body + after, len(before), len(before) + len(body)))
        y.append(is_secret)
    return found, np.array(y, np.float32)


@functools.lru_cache(maxsize=1)
def trained() -> Network:
    """The network, trained once in a process; reruns agree."""
    found, y = labelled_findings(12000, 17)
    cut = len(y) * 3 // 5
    net = Network.train(encode([windows(*f)[0] for f in found[:cut]]), y[:cut])
    held = np.array([values(t, [(a, b)], net)[0] for t, a, b in found[cut:]])
    return net.calibrate(held, y[cut:], np.array([run_kind(t[a:b]) for t, a, b in found[cut:]]))


def values(text: str, spans: list[tuple[int, int]], net: Network) -> list[float]:
    """The network's value of each span: the largest over its windows."""
    best = np.zeros(len(spans))
    ws = ((i, w) for i, span in enumerate(spans) for w in windows(text, *span))
    while part := list(itertools.islice(ws, 1024)):
        np.maximum.at(best, [i for i, _ in part], net.scores(encode([w for _, w in part])))
    return best.tolist()


def scan(text: str, net: Network) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]], list[float]]:
    """Base spans, all spans of one text, and the network's value of each of these."""
    base = base_spans(text)
    more = apart(candidates(text), base)
    valued = values(text, [(s, e) for s, _, e in base] + more, net)
    kept = [(c[0], 3, c[1]) for c, p in zip(more, valued[len(base) :], strict=True) if net.reports(text[c[0] : c[1]], p)]
    by_span = dict(zip([*base, *[(s, 3, e) for s, e in more]], valued, strict=True))
    spans = sorted(base + kept)
    return base, spans, [by_span[x] for x in spans]


def apart(found: list[tuple[int, int]], base: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """The candidates that overlap no base span; both are in order of start."""
    kept, at, reach = [], 0, -1
    for start, end in found:
        while at < len(base) and base[at][0] < end:
            reach = max(reach, base[at][2])
            at += 1
        if start >= reach:
            kept.append((start, end))
    return kept


def said(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


_ARROW = pa.schema([("doc_id", pa.int64()), ("n_assign", pa.int64()), ("n_access", pa.int64()), ("n_hex", pa.int64()), ("base_sha256", pa.string()), ("spans", pa.string()), ("scores", pa.string())])


def scan_secrets(docs: DataFrame, net: Network | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, scores (of the spans, in their order): one row a document."""
    spark = docs.sparkSession
    ship(spark)
    held = spark.sparkContext.broadcast(net or trained())

    def run(batches):
        network = held.value
        for part, all_texts in texts(batches):
            got: dict[str, list] = {f.name: [] for f in _ARROW}
            for t in all_texts:
                base, spans, scores = scan((t or b"").decode("utf-8", "replace"), network)
                kinds = [k for _, k, _ in base]
                for i, name in enumerate(("n_assign", "n_access", "n_hex")):
                    got[name].append(kinds.count(i))
                got["base_sha256"].append(hashlib.sha256(said(base).encode()).hexdigest())
                got["spans"].append(said(spans))
                got["scores"].append(",".join(f"{x:.3f}" for x in scores))
            got["doc_id"] = part.column(0)
            yield out(_ARROW, got)

    return only(docs, doc_id=id_col, text=text_col).mapInArrow(run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, scores string")


def op4_secret_scan(spark, sf_dir: str) -> DataFrame:
    return scan_secrets(table(spark, sf_dir, "documents"))
