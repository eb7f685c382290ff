"""Jobs from the command line.

python -m inkwell stage1 --date 2026-09-14 --staged DIR --sources a,b --rules FILE --analyses DIR --review DIR
python -m inkwell collect --day 2026-09-14 --source daily_ft --sections DIR --state DIR --raw DIR --staged DIR --statuses DIR [--pages DIR]
python -m inkwell run --day 2026-09-14 --registry FILE --state DIR --raw DIR --staged DIR --statuses DIR --summaries DIR
python -m inkwell window --day 2026-09-14

collect: --sections holds section pages (page, html) as Parquet; --pages, where
it is given, fetched articles (url, final_url, html), else they are fetched.
run: all active sources of a registry, from their section URLs on; the exit
code is 1 where a source failed.
"""

from __future__ import annotations

import argparse
import uuid
from datetime import UTC, datetime
from zoneinfo import ZoneInfo

from pyspark.sql import SparkSession

from inkwell.functions.dates import LOCAL
from inkwell.plans import collection, crawl, stage1
from inkwell.session import materialize
from inkwell.sources import sinks
from inkwell.sources.readers import read_staged
from inkwell.sources.rules import load_registry, load_rules


def main() -> None:
    today = datetime.now(ZoneInfo(LOCAL)).date().isoformat()
    parser = argparse.ArgumentParser(prog="inkwell", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    jobs = parser.add_subparsers(dest="job", required=True)
    score = jobs.add_parser("stage1", help="score the articles of one publication date")
    score.add_argument("--date", default=today)
    for name in ("--staged", "--sources", "--rules", "--analyses", "--review"):
        score.add_argument(name, required=True)
    score.add_argument("--lines", action="store_true", help="staged files hold an article a line, as collect leaves them")
    gather = jobs.add_parser("collect", help="run one source from its section pages to stored articles")
    gather.add_argument("--day", default=today)
    gather.add_argument("--pages")
    for name in ("--source", "--sections", "--state", "--raw", "--staged", "--statuses"):
        gather.add_argument(name, required=True)
    everything = jobs.add_parser("run", help="run all active sources of a registry from their section URLs to stored articles")
    everything.add_argument("--day", default=today)
    for name in ("--registry", "--state", "--raw", "--staged", "--statuses", "--summaries"):
        everything.add_argument(name, required=True)
    window = jobs.add_parser("window", help="the publication dates that a run on a day scores")
    window.add_argument("--day", default=today)
    a = parser.parse_args()
    if a.job == "window":
        print(*stage1.window_dates_of(a.day), sep="\n")
        return
    spark = SparkSession.builder.appName("inkwell").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    if a.job == "collect":
        collect(spark, a)
        return
    if a.job == "run":
        raise SystemExit(run(spark, a))
    sources = a.sources.split(",")
    counts = stage1.run(spark, a.staged, sources, a.date, load_rules(a.rules), a.analyses, a.review, not a.lines).first().asDict()
    print(counts)
    if not any(counts.values()):
        stage1.available_dates(read_staged(spark, a.staged, sources, not a.lines)).orderBy("source", "date").show(1000, truncate=False)


def collect(spark: SparkSession, a: argparse.Namespace) -> None:
    """A failing source leaves its status; the state moves only after a run that ended."""
    now = datetime.now(UTC)
    run_id = f"{now.astimezone(ZoneInfo(LOCAL)):%Y%m%d_%H%M%S}_{uuid.uuid4().hex[:8]}"
    pages = spark.read.parquet(a.pages) if a.pages else None

    def job():
        return collection.run_stored(spark, a.source, spark.read.parquet(a.sections), a.state, a.day, now.isoformat(timespec="seconds"), run_id, a.raw, a.staged, pages)

    statuses = collection.run_sources(spark, {a.source: job}, run_id)
    sinks.write_statuses(statuses, a.statuses)
    statuses.show(truncate=False, vertical=True)


def run(spark: SparkSession, a: argparse.Namespace) -> int:
    """All active sources; what each came to is stored before the job says how it ended."""
    now = datetime.now(UTC)
    run_id = f"{now.astimezone(ZoneInfo(LOCAL)):%Y%m%d_%H%M%S}_{uuid.uuid4().hex[:8]}"
    statuses = materialize(crawl.run_registry(spark, load_registry(spark, a.registry), a.state, a.raw, a.staged, a.day, now.isoformat(timespec="seconds"), run_id), "run")
    crawl.write_run(statuses, a.statuses, a.summaries)
    statuses.show(1000, truncate=False, vertical=True)
    return 0 if statuses.where("execution_status <> 'SUCCESS'").isEmpty() else 1


if __name__ == "__main__":
    main()
