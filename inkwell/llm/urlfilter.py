"""URL filters: rules, and gradient-boosted trees on lexical features for what no rule decides.

1. Rules are expressions over host and path; of those that fit the longest
   decides.
2. Labelled URLs are the URLs that rules decide (or a table of the user's).
   Half of them, by a hash of the URL, give suffix statistics: how often the
   last label of a host, its last two, and these with the path's first segment
   were blocked, each in a table of SUFFIXES hashed places. The other half, up to PER_LABEL distinct URLs of
   each label, in the order of the hash, trains the trees. Statistics cover all
   rows of their half; how common a suffix is counts all URLs.
3. Trees (those of the quality classifier) read a row of FEATURES for each URL:
   lengths, depth, digit ratio, entropy, parameters and the suffix's
   statistics. A URL is blocked where its score is at least THRESHOLD.

Defined cases: a null URL or one without :// has empty host and path, fits no
rule and is scored like any other; an empty path fits no rule, as each rule's
path begins with a slash; without labels, or with labels of one kind, the score
is the share of blocked labels (0.5 without any); repeated rows are answered one
by one; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkwell.llm.common import only, out, texts
from inkwell.llm.quality import Trees
from inkwell.session import materialize, ship, table

#: Distinct URLs of each label that the trees learn from, at most.
PER_LABEL = 10_000
#: Places of the tables of suffix statistics.
SUFFIXES = 1 << 12
#: Labelled URLs that the mean counts for, in the statistics of a suffix.
PRIOR = 8.0
THRESHOLD = 0.5
#: The suffixes that are counted: last label, last two labels, last two with the first segment.
KINDS = ("suffix", "site", "section")
FEATURES = (
    "url_length", "host_length", "path_length", "longest_label", "labels", "depth", "longest_segment", "mean_segment", "digits", "host_digits",
    "path_digits", "host_entropy", "path_entropy", "parameters", "query_length", "fragment", "hyphens", "marks", "upper", "beyond_ascii",
    "vowels", "distinct_in_host", "secure", "ends_with_slash", "extension", "first_segment", "first_label",
    "suffix_blocked", "suffix_share", "site_blocked", "site_share", "section_blocked", "section_share",
)


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


# The rules of the query.
RULES = [Rule("allow", "com", "/"), Rule("block", "example.com", "/en/"), Rule("allow", "www.example.com", "/en/"), Rule("block", "net", "/es/"), Rule("block", "net", "/fr/")]

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    """What follows the first :// up to a slash, a question mark or a hash, A-Z lower-cased; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def longest_rule(host: Column, path: Column, rules: list[Rule]) -> Column:
    """struct<name, verdict> of the longest rule that fits; of equally long ones that of the longer host, then block."""
    chosen = F.lit(None).cast("struct<name:string,verdict:string>")
    for r in sorted(rules, key=lambda r: (len(r.name), len(r.host), r.verdict == "block")):
        fits = ((host == r.host) | F.endswith(host, F.lit(f".{r.host}"))) & F.startswith(path, F.lit(r.path))
        chosen = F.when(fits, F.struct(F.lit(r.name).alias("name"), F.lit(r.verdict).alias("verdict"))).otherwise(chosen)
    return chosen


def suffix(host: Column, labels: int) -> Column:
    """The last labels of a host."""
    return F.substring_index(host, ".", -labels)


def place(value: Column) -> Column:
    """The hashed place of a suffix."""
    return F.pmod(F.xxhash64(value), F.lit(SUFFIXES)).cast("int")


def places(host: Column, path: Column) -> dict[str, Column]:
    """The hashed places of a URL's suffixes, by KINDS."""
    site = suffix(host, 2)
    return dict(zip(KINDS, map(place, (suffix(host, 1), site, F.concat(site, F.substring_index(path, "/", 2)))), strict=True))


def _entropy(counts: np.ndarray) -> float:
    n = counts.sum()
    p = counts[counts > 0] / n if n else counts[:0]
    return float(-(p * np.log2(p)).sum())


def lexical(url: bytes | None) -> list[float]:
    """The features of a URL that stand in the URL itself; those of its suffixes come after."""
    u = url or b""
    head, _, fragment = u.partition(b"#")
    before, _, query = head.partition(b"?")
    scheme, sep, rest = before.partition(b"://")
    host, _, path = rest.partition(b"/") if sep else (b"", b"", b"")
    host = host.lower()
    path = b"/" + path if rest[len(host) :] else b""
    count = lambda s: np.bincount(np.frombuffer(s, np.uint8), minlength=256)
    whole, h, p = count(u), count(host), count(path)
    segments = [s for s in path.split(b"/") if s]
    labels = host.split(b".") if host else []
    lengths = list(map(len, segments)) or [0]
    share = lambda c, low, high: float(c[low:high].sum()) / max(1, c.sum())
    parameters = [x for x in query.split(b"&") if x]
    return [
        len(u), len(host), len(path), max(map(len, labels), default=0), len(labels), len(segments), max(lengths), sum(lengths) / len(lengths),
        share(whole, 48, 58), share(h, 48, 58), share(p, 48, 58), _entropy(h), _entropy(p), len(parameters), len(query), len(fragment),
        float(h[45]), float(whole[33:45].sum() + whole[59:65].sum()), share(whole, 65, 91), share(whole, 128, 256),
        float(h[list(b"aeiou")].sum()) / max(1, len(host)), float((h > 0).sum()) / max(1, len(host)), float(scheme.lower() == b"https"),
        float(path.endswith(b"/")), float(len(segments[-1].rpartition(b".")[2]) if segments and b"." in segments[-1] else 0), float(len(segments[0]) if segments else 0), float(len(labels[0]) if labels else 0),
    ]


def rows_of(urls: list, at: list[np.ndarray], statistics: np.ndarray) -> np.ndarray:
    """The whole matrix of FEATURES. at: places by KINDS; statistics: [kind, blocked or share, place]."""
    own = np.array([lexical(u) for u in urls], float).reshape(len(urls), len(FEATURES) - 2 * len(KINDS))
    return np.column_stack([own, *[s[where] for kind, where in zip(statistics, at, strict=True) for s in kind]])


def suffix_statistics(pages: DataFrame, labelled: DataFrame) -> np.ndarray:
    """[kind, (share blocked, smoothed by the mean; log of the share of all URLs), place]: bounded tables.

    pages: the places (KINDS) of all URLs. labelled: places and blocked of the labelled URLs that teach them.
    """
    found = np.zeros((len(KINDS), 2, SUFFIXES))
    for i, by in enumerate(KINDS):
        known = labelled.groupBy(by).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("blocked").cast("long")).alias("b"))
        common = pages.groupBy(by).agg(F.count(F.lit(1)).alias("n"))
        ns, bs, cs = np.zeros(SUFFIXES), np.zeros(SUFFIXES), np.zeros(SUFFIXES)
        for r in known.collect():  # SUFFIXES rows at most
            ns[r[by]], bs[r[by]] = r["n"], r["b"]
        for r in common.collect():
            cs[r[by]] = r["n"]
        n, blocked = ns.sum(), bs.sum()
        mean = blocked / n if n else 0.5
        found[i, 0] = (bs + PRIOR * mean) / (ns + PRIOR)
        found[i, 1] = np.log2((cs + 1) / (cs.sum() + 1))
    return found


def teaches(url: Column) -> Column:
    """True for the half of the URLs that gives suffix statistics; the other trains the trees."""
    return F.pmod(F.xxhash64(url, F.lit("half")), F.lit(2)) == 0


def training_urls(labelled: DataFrame, per_label: int = PER_LABEL) -> DataFrame:
    """url, KINDS, blocked: distinct URLs, per_label of each label at most, in the order of their hash.

    labelled: the same columns. A hash below twice the wanted share takes part, so tasks hand on few rows.
    """
    spot = F.pmod(F.xxhash64("url", F.lit("spot")), F.lit(1 << 40))
    distinct = materialize(labelled.distinct().withColumn("spot", spot), "labelled")
    counts = {r["blocked"]: r["n"] for r in distinct.groupBy("blocked").agg(F.count(F.lit(1)).alias("n")).collect()}
    drawn = []
    for label, n in sorted(counts.items()):
        below = int(min(1.0, 2 * per_label / n) * (1 << 40))
        drawn.append(distinct.where((F.col("blocked") == label) & (F.col("spot") <= below)).orderBy("spot", "url").limit(per_label))
    return reduce(DataFrame.union, drawn, distinct.limit(0)).drop("spot")


def learn(places: DataFrame, labelled: DataFrame) -> tuple[Trees, np.ndarray]:
    """The trees and the suffix statistics. places: KINDS of all URLs; labelled: url, KINDS, blocked."""
    statistics = suffix_statistics(places, labelled.where(teaches(F.col("url"))))
    rows = sorted(training_urls(labelled.where(~teaches(F.col("url")))).collect(), key=lambda r: (r["url"], r["blocked"]))
    x = rows_of([r["url"].encode() for r in rows], [np.array([r[k] for r in rows], int) for k in KINDS], statistics)
    return Trees.grow(x, np.array([float(r["blocked"]) for r in rows])), statistics


def filter_urls(pages: DataFrame, rules: list[Rule], labels: DataFrame | None = None, threshold: float = THRESHOLD, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row a page: page_id, host, path, rule, verdict, score (the trees' for blocking).

    labels: url, blocked; without them the URLs that rules decide are the labelled ones.
    """
    ship(pages.sparkSession)
    urls = only(pages, page_id=id_col, url=url_col)
    parts = urls.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    placed = parts.withColumns({"rule": longest_rule(F.col("host"), F.col("path"), rules), **places(F.col("host"), F.col("path"))})
    if labels is None:
        labelled = placed.where("rule is not null").withColumn("blocked", F.col("rule.verdict") == "block")
    else:
        known = labels.where("url is not null and blocked is not null").select("url", F.col("blocked").cast("boolean").alias("blocked"))
        labelled = known.withColumns(places(host_of(F.col("url")), path_of(F.col("url"))))
    held = pages.sparkSession.sparkContext.broadcast(learn(placed.select(*KINDS), labelled.select("url", *KINDS, "blocked")))
    schema = pa.schema([("page_id", pa.int64()), ("host", pa.string()), ("path", pa.string()), ("rule", pa.string()), ("verdict", pa.string()), ("score", pa.float64())])

    def run(batches):
        trees, statistics = held.value
        for part, all_urls in texts(batches, "url"):
            whole = lambda c, p=part: p.column(p.schema.get_field_index(c))
            score = trees.scores(rows_of(all_urls, [whole(k).to_numpy() for k in KINDS], statistics))
            said = [v or ("block" if s >= threshold else "allow") for v, s in zip(whole("said").to_pylist(), score.tolist(), strict=True)]
            yield out(schema, {"page_id": whole("page_id"), "host": whole("host"), "path": whole("path"), "rule": whole("rule"), "verdict": said, "score": pa.array(score)})

    asked = placed.select("page_id", "url", "host", "path", F.col("rule.name").alias("rule"), F.col("rule.verdict").alias("said"), *KINDS)
    return asked.mapInArrow(run, "page_id long, host string, path string, rule string, verdict string, score double")


def op13_url_filter(spark, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages"), RULES)
