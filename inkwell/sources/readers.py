"""Readers: staged articles, annotations, state and statuses, and web pages."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from inkwell.functions import text
from inkwell.session import ship
from inkwell.sources.keyed import Keyed

STAGED = (
    "source_name string, section_name string, source_url string, final_url string, canonical_url string, headline string, subheadline string, author string, "
    "published_at string, article_text string, word_count int, retrieved_at string, content_hash string, fetch_method string, article_version string, "
    "collection_status string, intake_status string, collection_run_date string, collection_window_start string, collection_window_end string, collection_mode string, "
    "listing_headline string, listing_published_at string, listing_excerpt string, validation struct<valid:boolean,errors:array<string>,warnings:array<string>>"
)
ANALYSIS = (
    "article_id string, processed_at string, input_file string, source_name string, section_name string, headline string, published_at string, source_url string, "
    "canonical_url string, content_hash string, article_version string, collection_status string, intake_status string, collection_run_date string, rules_version string, "
    "financial_score double, financial_label string, pr_score double, pr_label string, article_type_hint string, gate_decision string, institutions array<string>, "
    "matched_financial_terms array<struct<name:string,terms:array<string>>>, matched_pr_terms array<struct<name:string,terms:array<string>>>, pr_counter_signals array<string>, reasons array<string>"
)
ANNOTATIONS = "source_url string, human_label string, review_notes string"
STATE = "url string, source_url string, headline string, content_hash string, published_at string, first_seen_at string, last_seen_at string, last_fetched_at string, version_number long"
STATUS = (
    "run_id string, started_at string, completed_at string, source_key string, source_name string, section_name string, execution_status string, health_status string, "
    "content_status string, collection_mode string, window_start string, window_end string, candidate_urls long, articles_requiring_fetch long, new_articles long, "
    "late_discoveries long, changed_articles long, unchanged_articles long, wrong_date_skipped long, missing_date long, invalid_extraction long, fetch_failures long, "
    "recent_duplicates long, error_type string, error_message string, status_written_at string"
)


#: Parts that a state is dealt to by its URLs.
BUCKETS = 64


def raw_pages(root: str) -> Keyed:
    """Pages as they came, one a version of an article and run date."""
    return Keyed(root, "article_id string, version_name string, html string", ("source", "run_date"), ("article_id", "version_name"))


def staged(root: str) -> Keyed:
    """Staged articles, one a version of a page and run date."""
    return Keyed(root, STAGED, ("source", "run_date"), ("canonical_url", "article_version"), "json")


def analyses(root: str) -> Keyed:
    """Results of scoring, one an article and run date."""
    return Keyed(root, ANALYSIS, ("run_date", "source_slug"), ("article_id",), "json")


def state(root: str) -> Keyed:
    """A collection's state, one row a URL."""
    return Keyed(root, STATE, ("bucket",), ("url",))


def bucket(url: Column) -> Column:
    return F.pmod(F.xxhash64(url), F.lit(BUCKETS)).cast("string")


def state_of(spark: SparkSession, root: str, urls: DataFrame) -> DataFrame:
    """The rows (STATE) of the buckets that the given urls fall in."""
    touched = sorted(r[0] for r in urls.select(bucket(F.col("url"))).distinct().collect())  # BUCKETS rows at most
    return state(root).read(spark, bucket=touched).drop("bucket", "w", "file", "mtime")


def read_staged(spark: SparkSession, root: str, sources: list[str], one_a_file: bool = True) -> DataFrame:
    """Staged article files of the sources' folders, with source, path, mtime and corrupt.

    one_a_file: each file is one article; else root is the table that
    sinks.write_staged keeps, and sources may be given as its folders are named
    (source=NAME). A file (a line) that isn't a JSON object is a row with
    corrupt set, which the job leaves out instead of failing.
    """
    if not one_a_file:
        named = {s.removeprefix("source="): s for s in sources}
        said = F.create_map(*[F.lit(x) for pair in named.items() for x in pair])
        rows = staged(root).read(spark, source=list(named)).withColumn("source", said[F.col("source")])
        nothing = F.coalesce("headline", "article_text", "source_url", "canonical_url").isNull()
        return rows.withColumnRenamed("file", "path").withColumn("corrupt", nothing).drop("w", "run_date")
    found = (
        spark.read.option("recursiveFileLookup", True).option("multiLine", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").option("pathGlobFilter", "*.json")
        .schema(f"{STAGED}, _corrupt string")
        .json([f"{root}/{s}" for s in sources])
    )
    path = F.col("_metadata.file_path")
    source = F.element_at(F.filter(text.path_parts(path), lambda p: p.isin(sources)), 1)
    # a field of another type than the schema's leaves the rest of its record
    unread = F.col("_corrupt").isNotNull() & F.coalesce("headline", "article_text", "source_url", "canonical_url").isNull()
    return found.select("*", path.alias("path"), F.col("_metadata.file_modification_time").alias("mtime"), source.alias("source"), unread.alias("corrupt")).drop("_corrupt")


def _or_empty(spark: SparkSession, read, schema: str) -> DataFrame:
    try:
        return read()
    except AnalysisException:  # no such path
        return spark.createDataFrame([], schema)


def read_annotations(spark: SparkSession, path: str) -> DataFrame:
    """Human labels of a review file with their order in it; no file, no rows."""
    schema = f"{ANNOTATIONS}, place long"

    def read():
        csv = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
        named = {c.lstrip("\ufeff"): c for c in csv.columns}
        columns = [F.col(f"`{named[c]}`").alias(c) if c in named else F.lit(None).cast("string").alias(c) for c in ("source_url", "human_label", "review_notes")]
        return csv.select(*columns, F.monotonically_increasing_id().alias("place"))

    return _or_empty(spark, read, schema)


def read_state(spark: SparkSession, path: str) -> DataFrame:
    return _or_empty(spark, lambda: spark.read.schema(STATE).parquet(path), STATE)


def read_statuses(spark: SparkSession, path: str) -> DataFrame:
    return _or_empty(spark, lambda: spark.read.schema(STATUS).json(path), STATUS)


# Statuses that are tried again.
RETRIED = {408, 425, 429, 500, 502, 503, 504}
PAGE = "url string, final_url string, status_code int, html string, content_type string, fetch_method string, error string"


def page(url: str, attempts: int = 3, delay: float = 1.5, timeout: float = 30) -> tuple:
    """One page; the last failure is a row with its error, not an exception."""
    import time
    from http.client import HTTPException
    from urllib.error import HTTPError
    from urllib.request import Request, urlopen

    error = status = None
    for attempt in range(1, attempts + 1):
        try:
            with urlopen(Request(url, headers={"User-Agent": "Mozilla/5.0", "Accept": "text/html"}), timeout=timeout) as r:
                return url, r.geturl(), r.status, r.read().decode(r.headers.get_content_charset() or "utf-8", "replace"), r.headers.get_content_type(), "httpx", None
        except HTTPError as e:
            error, status = str(e), e.code
            if e.code not in RETRIED:
                break
        except (ValueError, LookupError) as e:  # no URL, or a character set that isn't one
            error = f"{type(e).__name__}: {e}"
            break
        except (OSError, HTTPException) as e:
            error = f"{type(e).__name__}: {e}"
        if attempt < attempts:
            time.sleep(delay * 2 ** (attempt - 1))
    return url, None, status, None, None, "httpx", error


def fetch_pages(found: DataFrame, url: str = "url", partitions: int | None = None, attempts: int = 3, delay: float = 1.5, timeout: float = 30) -> DataFrame:
    """Pages (PAGE) of a column of URLs, each distinct one fetched once, where its row lies.

    URLs are dealt by themselves, to `partitions` tasks where that is given, so
    no list of them meets the driver. The result should be written once: a
    second action would fetch again.
    """
    ship(found.sparkSession)

    def run(batches):
        import pandas as pd

        for batch in batches:
            yield pd.DataFrame([page(u, attempts, delay, timeout) for u in batch["url"]], columns=[c.split()[0] for c in PAGE.split(", ")]).astype({"status_code": "Int32"})

    urls = found.select(F.col(url).alias("url")).where("url is not null").distinct()
    dealt = urls.repartition(partitions, "url") if partitions else urls
    return dealt.mapInPandas(run, PAGE)


class _Part(InputPartition):
    def __init__(self, urls: list[str]):
        self.urls = urls


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.urls = [u for u in options.get("urls", "").split("\n") if u]
        self.how = int(options.get("attempts", 3)), float(options.get("delay", 1.5)), float(options.get("timeout", 30))
        self.width = int(options.get("partitions", 8))

    def partitions(self):
        return [_Part(self.urls[k :: self.width]) for k in range(min(self.width, len(self.urls)))]

    def read(self, partition):
        for url in partition.urls:
            yield page(url, *self.how)


class WebPages(DataSource):
    """spark.read.format("web_pages").option("urls", "one\\na line"): fetched pages.

    Redirects are followed; statuses in RETRIED and transport errors are tried
    again with a doubling delay, other client errors are not.
    """

    @classmethod
    def name(cls) -> str:
        return "web_pages"

    def schema(self) -> str:
        return PAGE

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)


def register_web_pages(spark: SparkSession) -> None:
    """Make the web_pages format known to a session and its workers."""
    ship(spark)
    spark.dataSource.register(WebPages)
