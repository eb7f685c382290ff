"""Quality rules against plain Python."""

import random
import re
from collections import Counter, defaultdict

from inkwell.llm import rules
from tests.llm.helpers import documents

WORD = re.compile("[^\x20\x09-\x0d]+")


def measures(t):
    t = t or ""
    words = WORD.findall(t)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    twice = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if twice[w] > 1 for k in range(5)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), len(re.findall("[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered)


def normal(x):
    return " ".join(WORD.findall("".join(c.lower() if c.isascii() else c for c in x)))


def plain(rows, share=rules.SHARE, least=rules.LEAST, most=rules.MOST, remains=0.5):
    held, hosts = defaultdict(set), Counter(r[3] for r in rows)
    for k, r in enumerate(rows):
        for x in (r[1] or "").split("\n"):
            if WORD.search(x):
                held[r[3], normal(x)].add(k)
    often = {key for key, docs in held.items() if len(docs) >= most or len(docs) >= least and len(docs) > share * hosts[key[0]]}
    out, left = [], []
    for i, t, _, host in rows:
        n, chars, symbols, dup, rep = measures(t)
        failed = n < 10 or 100 * rep > 20 * n
        gone = sum(len(WORD.findall(x)) for x in (t or "").split("\n") if WORD.search(x) and (host, normal(x)) in often)
        out.append((i, n, chars, symbols, dup, rep, failed, gone, not failed and n - gone >= remains * n))
        left.append((i, None if t is None else "\n".join(x for x in t.split("\n") if not WORD.search(x) or (host, normal(x)) not in often)))
    return sorted(out, key=str), sorted(left, key=str)


def table(n=250):
    rng, rows = random.Random(4), []
    for i in range(n):
        lines = [" ".join(rng.choice(["alpha", "beta", "Gamma", "é", "#", "a|b", "x", "y", "z"]) for _ in range(rng.randrange(12))) for _ in range(rng.randrange(7))]
        if rng.random() < 0.3:
            lines.insert(rng.randrange(len(lines) + 1), rng.choice(["Share this  page now", "share THIS page\tnow", "all rights reserved by the owner of this site and its many friends"]))
        rows.append((i, "\n".join(lines), "en", rng.choice(["a", "a", "b", None])))
    long = " ".join(f"w{k}" for k in range(60_000))
    return rows + [(1000, None, "en", "a"), (1001, "", "en", None), (1002, " \n\t", "en", "a"), (3, "again the same id", "en", "b"), (1003, long, "en", "a"), (1004, "r " * 50_000, "en", "a"), (1005, "\x1c \x85 a\x0bb\x0cc", "en", "a")]


def found(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "n_removed_words", "kept").collect()), key=str)


def test_against_plain(spark):
    rows = table()
    d = documents(spark, rows, ("host", "row", "lines", "line")).repartition(3)
    assert found(rules.apply_rules(d, 0.05, 5)) == plain(rows, 0.05, 5)[0]
    assert found(rules.apply_rules(d)) == plain(rows)[0]
    assert sorted((tuple(r) for r in rules.without_frequent_lines(d, 0.05, 5).collect()), key=str) == plain(rows, 0.05, 5)[1]


def test_one_line_in_a_third_of_all_rows(spark):
    rows = [(i, ("Hot line of seven words in here\n" if i % 3 == 0 else "") + " ".join(f"w{i}x{k}" for k in range(12 if i % 2 else 4)), "en", "s") for i in range(600)]
    got = found(rules.apply_rules(documents(spark, rows)))
    assert got == plain(rows)[0]
    assert {r[-1] for r in got if r[0] % 6 == 0} == {False} and {r[-1] for r in got if r[0] % 6 == 3} == {True}


def test_a_count_is_enough_however_large_the_host(spark):
    """A line of 30 documents goes from a host of 400 and from one of 31, a line of 9 from a host of 50 alone."""
    words = lambda i: " ".join(f"w{i}x{k}" for k in range(12))
    rows = [(i, ("Thirty hold this line of words\n" if i < 30 else "Nine hold this one\n" if i < 39 else "") + words(i), "en", "large") for i in range(400)]
    rows += [(1000 + i, "Thirty hold this line of words\n" * (i < 30) + words(i), "en", "small") for i in range(31)]
    rows += [(2000 + i, "Nine hold this one\n" * (i < 9) + words(i), "en", "middle") for i in range(50)]
    got = found(rules.apply_rules(documents(spark, rows)))
    assert got == plain(rows)[0]
    gone = {r[0] for r in got if r[7]}
    assert gone == {*range(30), *range(1000, 1030), *range(2000, 2009)}


def test_repeated_windows_at_their_bounds(spark):
    texts = ["a b c d e", "a b c d e a b c d e", "a a a a a a", "a b c d e x a b c d e f a b c d", "a b c d", "p q r s t u v p q r s t u v"]
    got = {r.doc_id: r.n_repeat_words for r in rules.apply_rules(documents(spark, list(enumerate(texts)))).collect()}
    assert got == {k: measures(t)[4] for k, t in enumerate(texts)}


def test_no_rows(spark):
    assert rules.apply_rules(documents(spark, [])).collect() == []
