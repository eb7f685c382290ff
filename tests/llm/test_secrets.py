"""Secret scans: base patterns by plain code, the network on findings it hasn't seen."""

import hashlib
import random
import re

import numpy as np

from inkwell.llm import secrets
from tests.llm.helpers import documents


def plain_base(text):
    """Leftmost, not overlapping within a kind; by hand, without the module's expressions."""
    found, low = [], text
    names = ["password", "passwd", "secret", "token", "api_key", "apikey"]
    at = 0
    while at < len(low):
        hit = next((n for n in names if "".join(c.lower() if c.isascii() else c for c in low[at : at + len(n)]) == n), None)
        m = re.compile("[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)").match(text, at + len(hit)) if hit else None
        if m:
            if len(m[1]) >= 6:
                found.append((at, 0, m.end()))
            at = m.end()
        else:
            at += 1
    for kind, first, chars, least in ((1, "AKIA", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", 20), (2, "", "0123456789abcdef", 24)):
        at = 0
        while at < len(text):
            end = at + len(first)
            while text.startswith(first, at) and end < len(text) and text[end] in chars:
                end += 1
            if text.startswith(first, at) and end > at + len(first):
                if end - at >= least:
                    found.append((at, kind, end))
                at = end
            else:
                at += 1
    return sorted(found)


def texts(n=400):
    rng = random.Random(2)
    bits = ["password", "PassWd", "api_key", "apikey", "token", "secret", "Secret", '"', "'", " ", "  ", ":", "=", "AKIA", "ABCD1234EFGH5678", "deadbeef00112233", "4455667788", "é", "\n", "x", "tokentoken=abc", "key-9_8.7", "İ", "ſecret=abcdefgh", "K"]
    return ["".join(rng.choice(bits) for _ in range(rng.randrange(30))) for _ in range(n)]


def test_base_spans():
    for t in texts():
        assert secrets.base_spans(t) == plain_base(t), t


def test_rows(spark):
    rows = [(k, t) for k, t in enumerate(texts(60))] + [(100, None), (101, ""), (102, "w " * 300_000 + "token: abcdef1"), (3, "again")]
    got = secrets.scan_secrets(documents(spark, rows, ("spans", "n_hex"))).collect()
    assert sorted(r.doc_id for r in got) == sorted(r[0] for r in rows)
    want = sorted((i, hashlib.sha256(",".join(f"{secrets.KINDS[k]}:{s}:{e}" for s, k, e in plain_base(t or "")).encode()).hexdigest()) for i, t in rows)
    assert sorted((r.doc_id, r.base_sha256) for r in got) == want
    for r in got:
        spans = [x.split(":") for x in r.spans.split(",") if x]
        assert sum(x[0] != "network" for x in spans) == r.n_assign + r.n_access + r.n_hex
        assert len(spans) == len([x for x in r.scores.split(",") if x])
    assert secrets.scan_secrets(documents(spark, [])).collect() == []


def test_network_on_new_findings():
    net = secrets.trained()
    found, y = secrets.labelled_findings(1500, 99)
    p = np.array([secrets.values(t, [(a, b)], net)[0] for t, a, b in found])
    said = np.array([net.reports(t[a:b], v) for (t, a, b), v in zip(found, p, strict=True)])
    assert said[y == 1].mean() > 0.95 and said[y == 0].mean() < 0.05
    kinds = np.array([secrets.run_kind(t[a:b]) for t, a, b in found])
    assert (secrets.Network.calibrate(net, p[y == 0], np.zeros((y == 0).sum()), kinds[y == 0]).thresholds == 0.5).all()
    secrets.trained.cache_clear()


def test_recall_of_every_kind():
    """Findings that neither training nor calibration has seen, in a bare context; and what stands in plain text."""
    net, rng = secrets.trained(), random.Random(12)
    rand = lambda alphabet, k: "".join(rng.choice(alphabet) for _ in range(k))
    lower, upper, digits = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
    made = {
        "uuid": lambda: rng.choice([str, str.upper])("-".join(rand("0123456789abcdef", k) for k in (8, 4, 4, 4, 12))),
        "hex of 20": lambda: rand("0123456789abcdef", 20),
        "upper-case hex of 32": lambda: rand("0123456789ABCDEF", 32),
        "lower-case letters": lambda: rand(lower, rng.randrange(16, 40)),
        "upper-case letters": lambda: rand(upper, rng.randrange(16, 40)),
        "mixed": lambda: rand(lower + upper + digits, rng.randrange(20, 50)),
        "like an access key": lambda: rand(upper + digits, 20),
    }
    for kind, make in made.items():
        got = []
        for _ in range(400):
            body, before = make(), rng.choice(["key = ", "the value is ", "credential: "])
            text = before + body + rng.choice([" ", "\n", ", then"])
            got.append(net.reports(body, secrets.values(text, [(len(before), len(before) + len(body))], net)[0]))
        assert np.mean(got) > 0.93, (kind, np.mean(got))


PLAIN = [
    "internationalization", "counterrevolutionaries", "Donaudampfschifffahrt", "electroencephalograph", "UNCONSTITUTIONALLY.", "well-being-of-children", "src/main/java/org/example", "getElementsByClassName", "configuration_settings_file",
    "2026-09-14T08.00.00.000", "1234567890123456", "0000000000000000", "================", "----------------------", "aaaaaaaaaaaaaaaaaaaa", "www.example.com/news/business", "user_account_list_path", "thisisaverylongword", "Rechtsschutzversicherung", "00000000-0000-0000-0000-000000000000",
    "anticonstitutionnellement", "responsabilidades", "desafortunadamente", "../../images/header/logo", "version-1.2.3-release-candidate", "HTTP_INTERNAL_SERVER_ERROR", "4111-1111-1111-1111", "deadbeefdeadbeef",
]


def test_plain_words_by_hand():
    """A list by hand of what is no secret: hardly any is reported."""
    net = secrets.trained()
    said = [w for w in PLAIN if secrets.scan(f"He wrote {w} in the report and went on.", net)[1]]
    assert len(said) <= 3, said


def test_long_candidates_are_read_whole():
    net = secrets.trained()
    rng = random.Random(5)
    key = "".join(rng.choice("abcdefghijkmnpqrstuvwxyzABCDEFGHJKLMNPQRSTUVWXYZ23456789") for _ in range(60))
    text = "value " + "x" * 5000 + key + " end"
    _, spans, _ = secrets.scan(text, net)
    assert spans == [(6, 3, 6 + 5000 + 60)]


def test_overlaps_are_not_reported_twice():
    base = [(0, 0, 10), (2, 2, 30), (50, 1, 60)]
    assert secrets.apart([(5, 20), (25, 40), (30, 45), (45, 51), (60, 70)], base) == [(30, 45), (60, 70)]


def test_runs_of_one_case_are_read():
    text = "x " + "qzxvkjwpqmzxrtbvkq" + " understandingly-" + " " + "-" * 20
    assert secrets.candidates(text) == [(2, 20), (21, 37), (38, 58)]
    net = secrets.trained()
    found, y = secrets.labelled_findings(3000, 99)
    of_one = [secrets.run_kind(t[a:b]) == secrets.RUNS.index("one_case") for t, a, b in found]
    p = np.array([secrets.values(t, [(a, b)], net)[0] for (t, a, b), one in zip(found, of_one, strict=True) if one])
    y = y[np.array(of_one)]
    assert (y == 1).sum() > 50 and (y == 0).sum() > 50
    bar = net.thresholds[secrets.RUNS.index("one_case")]
    assert (p[y == 1] >= bar).mean() > 0.93
    assert (p[y == 0] >= bar).mean() < 0.06


def test_convolution_against_a_loop():
    net = secrets.trained()
    found, _ = secrets.labelled_findings(3, 7)
    x = secrets.encode([secrets.windows(*f)[0] for f in found])
    for row, score in zip(x, net.scores(x), strict=True):
        hidden = []
        for at in range(secrets.WIDTH - secrets.KERNEL + 1):
            window = row[at : at + secrets.KERNEL].ravel()
            hidden.append([max(0.0, sum(float(v) * float(w) for v, w in zip(window, net.conv[:, k], strict=True)) + float(net.cbias[k])) for k in range(secrets.FILTERS)])
        a, z = secrets.BEFORE, secrets.BEFORE + secrets.OF - secrets.KERNEL + 1
        column = lambda rows, how: [how([r[k] for r in rows]) for k in range(secrets.FILTERS)]  # noqa: B023, E731
        mean = lambda v: sum(v) / len(v)
        pooled = column(hidden[:a], max) + column(hidden[a:z], mean) + column(hidden[a:z], max) + column(hidden[z:], max)
        total = sum(v * float(w) for v, w in zip(pooled, net.w, strict=True)) + net.b
        assert abs(1 / (1 + np.exp(-total)) - score) < 1e-4
