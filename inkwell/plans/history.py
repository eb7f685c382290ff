"""Queries over conversations as article versions and events as sightings."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell.functions import dates, text
from inkwell.operators import chain, selection, validation, versions
from inkwell.session import shared_dir, stream, table
from inkwell.streaming import sightings

NOW = "2024-01-31 00:00:00"


def fetches(spark, sf_dir: str) -> DataFrame:
    """Turns as fetches of an article; every third turn repeats the one before."""
    c = table(spark, sf_dir, "conversations")
    return c.select("conv_id", "turn", text.content_hash(F.concat(F.col("conv_id"), F.lit("/"), F.col("turn") - F.when(F.col("turn") % 3 == 2, 1).otherwise(0))).alias("content_hash"))


def change_detection(spark, sf_dir):
    return versions.with_changes(fetches(spark, sf_dir), "conv_id", "turn").select("conv_id", "turn", "status")


def version_counter(spark, sf_dir):
    v = versions.with_changes(fetches(spark, sf_dir), "conv_id", "turn")
    return v.select("conv_id", "turn", "version_number", text.version_name(F.col("version_number")).alias("version_name"))


def intake_status(spark, sf_dir):
    """Published dates follow the id; the run day is Monday 2026-09-14."""
    v = versions.with_changes(fetches(spark, sf_dir), "conv_id", "turn")
    published = F.when(F.col("conv_id") % 9 != 0, F.date_sub(F.lit("2026-09-14").cast("date"), (F.col("conv_id") % 4).cast("int")))
    return v.select("conv_id", "turn", validation.intake_status(published, F.col("status"), F.lit("2026-09-14").cast("date")).alias("intake_status"))


def latest_version(spark, sf_dir):
    c = table(spark, sf_dir, "conversations").select("conv_id", F.floor(F.col("turn") / 2).alias("version"), (F.col("turn") % 2).alias("modified"), "role", "turn")
    return versions.latest(c, ["conv_id"], "version", "modified", "role").select("conv_id", "version", "turn")


def state_snapshot(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("user_id", "ts", F.when(F.col("event_type") == "error", "").otherwise(F.col("event_type")).alias("headline"))
    return versions.seen_state(e, "user_id", "ts", "headline")


def state_merge(spark, sf_dir):
    """Two runs' snapshots merged give the whole's snapshot."""
    e = table(spark, sf_dir, "events").select("user_id", "ts", F.when(F.col("event_type") == "error", "").otherwise(F.col("event_type")).alias("headline"))
    cut = F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    return versions.merge_state(*[versions.seen_state(part, "user_id", "ts", "headline") for part in (e.where(F.col("ts") < cut), e.where(F.col("ts") >= cut))], "user_id")


def recheck_gate_stateless(spark, sf_dir):
    """The state's last fetch is each user's last click; the gate at a fixed time."""
    e = table(spark, sf_dir, "events")
    users = e.select("user_id").distinct()
    clicks = e.where("event_type = 'click'").groupBy("user_id").agg(F.max("ts").alias("ts"))
    state = clicks.select("user_id", F.lit(True).alias("known"), F.when(F.col("user_id") % 10 == 3, "").when(F.col("user_id") % 10 == 4, "yesterday").otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")).alias("last_fetched_at"))
    state = state.where("user_id % 10 <> 5")
    return users.join(state, "user_id", "left").select("user_id", validation.fetch_reason(F.col("known"), F.col("last_fetched_at"), F.lit("2024-01-30 12:00:00").cast("timestamp")).alias("reason"))


def recheck_chain(spark, sf_dir):
    chain = versions.fetch_chain(table(spark, sf_dir, "events").select("user_id", "ts"), "user_id", "ts", 6.0)
    return chain.groupBy("user_id").agg(F.count_if("fetched").alias("fetches"), F.count(F.lit(1)).alias("sightings"), F.max(F.when(F.col("fetched"), F.col("ts"))).cast("timestamp_ntz").alias("last_fetch"))


def recheck_chain_hot_keys(spark, sf_dir):
    """The fetches of few keys with very many sightings, the types of events, each walked block by block."""
    seen = table(spark, sf_dir, "events").select("event_type", "ts")
    walked = chain.fetch_chain_of_all(seen, "event_type", "ts", 6.0, hot_rows=100)
    return walked.where("fetched").select("event_type", F.col("ts").cast("timestamp_ntz").alias("ts"))


def stream_fetch_gate(spark, sf_dir):
    """The re-fetch chain as a stream: all events that are there, state by user."""
    events = stream(spark, sf_dir, "events")
    to = f"{shared_dir(spark)}/inkwell/gate-{uuid.uuid4().hex}"
    gate = sightings.gate_each(to, "user_id", "ts", 6.0)
    events.select("user_id", "ts").writeStream.foreachBatch(gate).option("checkpointLocation", f"{to}/progress").trigger(availableNow=True).start().awaitTermination()
    out = spark.read.schema(sightings.FETCHED).parquet(f"{to}/out")
    return out.groupBy(F.col("key").cast("long").alias("user_id")).agg(F.count_if("fetched").alias("fetches"), F.count(F.lit(1)).alias("sightings"))


def _staged(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    k = F.col("conv_id")
    published = F.when(k % 4 == 0, F.concat(F.lit("2026-09-1"), (F.col("turn") % 5).cast("string"), F.lit("T10:00:00+05:30"))).when(k % 4 == 1, "not a date")
    path = F.concat(F.lit("staged/"), F.col("role"), F.lit("/2026-09-14/"), k.cast("string"), F.lit("/v001.json"))
    return c.select("conv_id", "turn", "role", published.alias("published_at"), F.when(k % 4 != 3, F.when(F.col("turn") % 2 == 0, "2026-09-14").otherwise("2026-09-13")).alias("collection_run_date"), path.alias("path"))


def _matched(spark, sf_dir):
    m = selection.match_method(F.col("published_at"), F.col("collection_run_date"), text.path_date(F.col("path")), F.lit("2026-09-14"))
    return _staged(spark, sf_dir).withColumn("method", m)


def target_date_match(spark, sf_dir):
    return _matched(spark, sf_dir).select("conv_id", "turn", "method")


def match_method_counts(spark, sf_dir):
    return selection.match_counts(_matched(spark, sf_dir), by=["role"])


def article_identities(spark, sf_dir):
    s = _staged(spark, sf_dir)
    url = F.when(F.col("conv_id") % 3 == 0, F.concat(F.lit("https://x.example/"), F.col("conv_id")))
    return s.select("conv_id", "turn", text.article_identity(F.col("role"), F.lit(""), url, F.col("path")).alias("identity"), text.article_version(F.lit(None).cast("string"), F.col("path")).cast("long").alias("version"))


QUERIES = {
    f.__name__: f
    for f in (
        change_detection, version_counter, intake_status, latest_version, state_snapshot, state_merge, recheck_gate_stateless, recheck_chain, recheck_chain_hot_keys, stream_fetch_gate, target_date_match, match_method_counts, article_identities,
    )
}

_FETCHES = """f AS (
  SELECT conv_id, turn, sha256(conv_id || '/' || (turn - CASE WHEN turn % 3 = 2 THEN 1 ELSE 0 END)) AS h FROM conversations),
l AS (SELECT *, lag(h) OVER (PARTITION BY conv_id ORDER BY turn) AS before FROM f),
s AS (SELECT *, CASE WHEN before IS NULL THEN 'NEW' WHEN before <> h THEN 'CHANGED' ELSE 'UNCHANGED' END AS status FROM l)"""
_SEEN = "SELECT user_id, min(ts) AS first_seen_at, max(ts) AS last_seen_at, arg_max(event_type, ts) FILTER (event_type <> 'error') AS headline, count(*) AS sightings FROM events GROUP BY user_id"
_CHAIN = """
WITH RECURSIVE f AS (
  SELECT user_id, min(ts) AS ts FROM events GROUP BY user_id
  UNION ALL
  SELECT f.user_id, min(e.ts) AS ts FROM f JOIN events e ON e.user_id = f.user_id AND e.ts >= f.ts + INTERVAL 6 HOUR GROUP BY f.user_id),
n AS (SELECT user_id, count(*) AS fetches, max(ts) AS last_fetch FROM f GROUP BY user_id),
s AS (SELECT user_id, count(*) AS sightings FROM events GROUP BY user_id)"""
_METHOD = """m AS (
  SELECT conv_id, turn, role, CASE WHEN conv_id % 4 = 0 THEN CASE WHEN turn % 5 = 4 THEN 'published_at' END
         WHEN conv_id % 4 <> 3 AND turn % 2 = 0 THEN 'collection_run_date_fallback' ELSE 'path_date_fallback' END AS method
  FROM conversations)"""

ORACLES = {
    "change_detection": f"WITH {_FETCHES} SELECT conv_id, turn, status FROM s",
    "version_counter": f"""
WITH {_FETCHES}, v AS (SELECT conv_id, turn, sum(CASE WHEN status = 'UNCHANGED' THEN 0 ELSE 1 END) OVER (PARTITION BY conv_id ORDER BY turn)::BIGINT AS version_number FROM s)
SELECT *, 'v' || lpad(version_number::VARCHAR, 3, '0') AS version_name FROM v""",
    "intake_status": f"""
WITH {_FETCHES}
SELECT conv_id, turn, CASE WHEN status = 'CHANGED' THEN 'UPDATED_ARTICLE' WHEN status = 'UNCHANGED' THEN 'EXISTING_ARTICLE'
       WHEN conv_id % 9 = 0 THEN 'NEW_DATE_UNKNOWN' WHEN conv_id % 4 > 0 THEN 'LATE_DISCOVERY' ELSE 'NEW_TODAY' END AS intake_status
FROM s""",
    "latest_version": "SELECT conv_id, turn // 2 AS version, turn FROM conversations QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn // 2 DESC, turn % 2 DESC, role) = 1",
    "state_snapshot": _SEEN,
    "state_merge": _SEEN,
    "recheck_gate_stateless": """
WITH u AS (SELECT DISTINCT user_id FROM events), c AS (SELECT user_id, max(ts) AS ts FROM events WHERE event_type = 'click' AND user_id % 10 <> 5 GROUP BY user_id)
SELECT u.user_id, CASE WHEN c.ts IS NULL THEN 'NEW' WHEN u.user_id % 10 = 3 THEN 'NEVER_FETCHED' WHEN u.user_id % 10 = 4 THEN 'INVALID_FETCH_TIME'
       WHEN epoch_us(TIMESTAMP '2024-01-30 12:00:00') - epoch_us(c.ts) >= 21600000000 THEN 'RECHECK' ELSE 'RECENTLY_FETCHED' END AS reason
FROM u LEFT JOIN c ON u.user_id = c.user_id""",
    "recheck_chain": _CHAIN + " SELECT n.user_id, fetches, s.sightings, last_fetch FROM n JOIN s ON n.user_id = s.user_id",
    "recheck_chain_hot_keys": """
WITH RECURSIVE f AS (
  SELECT event_type, min(ts) AS ts FROM events WHERE event_type IS NOT NULL GROUP BY event_type
  UNION ALL
  SELECT f.event_type, min(e.ts) AS ts FROM f JOIN events e ON e.event_type = f.event_type AND e.ts >= f.ts + INTERVAL 6 HOUR GROUP BY f.event_type)
SELECT event_type, ts FROM f""",
    "stream_fetch_gate": _CHAIN + " SELECT n.user_id, fetches, s.sightings FROM n JOIN s ON n.user_id = s.user_id",
    "target_date_match": f"WITH {_METHOD} SELECT conv_id, turn, method FROM m",
    "match_method_counts": f"""
WITH {_METHOD} SELECT role, count(*) AS scanned, count(method) AS matched, count(*) FILTER (method = 'published_at') AS published_at,
  count(*) FILTER (method = 'collection_run_date_fallback') AS collection_run_date_fallback, count(*) FILTER (method = 'path_date_fallback') AS path_date_fallback FROM m GROUP BY role""",
    "article_identities": """
SELECT conv_id, turn, role || '|' || CASE WHEN conv_id % 3 = 0 THEN 'https://x.example/' || conv_id ELSE conv_id::VARCHAR END AS identity, 1::BIGINT AS version FROM conversations""",
}
